"""Token ids of whole texts by a tokenizer file, with a bounded cache of text parts per Python worker."""

from __future__ import annotations

import array
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The cache holds two generations of so many parts (about 200 bytes each): when the new one is full the old
# one goes. Parts longer than this many characters are not kept.
CACHE_PARTS = 500_000
CACHE_CHARS = 48

# Texts that are encoded together have about so many bytes, which makes their distinct words few.
SLICE_BYTES = 1 << 22

# The same as below for all white space of Unicode.
SPACE_THEN_SPACE = r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)"
_SPACE_THEN_TEXT = re.compile(r" (?=\S)")
_SPACE_THEN_SPACE = re.compile(r" (?:\s|$)")


def split_at_space(text: str) -> list[str]:
    """Parts between spaces and line ends, for tokenizers that drop white space."""
    return text.replace("\n", " ").split(" ")


def split_before_space(text: str) -> list[str]:
    """Parts that begin with the space before a word, for tokenizers that join a space to the word after it.

    Such a tokenizer always begins a token at a space that is followed by text, so the ids of the parts
    are the ids of the whole.
    """
    first, *rest = _SPACE_THEN_TEXT.split(text) if _SPACE_THEN_SPACE.search(text) else text.split(" ")
    return [first, *(" " + part for part in rest)]


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def _gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``pool`` one after the other."""
    before = np.cumsum(sizes) - sizes
    return pool[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class Encoder:
    """Encodes texts as little-endian ids of ``dtype``.

    The words of a batch are split and made distinct in Arrow, only distinct ones are looked up or tokenized, and
    the ids of all words are gathered by one take. Strings of special tokens become these tokens, as in
    the library; with ``plain_specials`` they are ordinary text. Fewer ``cache_parts`` take less memory and more time.
    """

    def __init__(self, path: str, split=split_before_space, plain_specials: bool = False, cache_parts: int = CACHE_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        specials = [] if plain_specials else [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(re.escape(s) for s in specials)
        self.split, self.cache_parts = split, cache_parts
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.spaced = split is split_before_space
        self.tails = {sign: self._bytes([token.id for token in self.model.tokenize(sign)]) for sign in ".,"}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return array.array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()

    def _word(self, part: str) -> str | None:
        """A part of Latin letters as the model's own word; else None.

        For these it is known how the tokenizer normalises and cuts them, also with a full stop or comma behind
        them, which saves half the time.
        """
        if len(part) > CACHE_CHARS:
            return None
        led = self.spaced and part[:1] == " "
        word = part[1:] if led else part
        if not word.isalpha():
            return None
        if not self.spaced:
            word = word.lower()
        if not word.isascii():
            if max(word) > "\xff":
                return None
            word = "".join([BYTE_LETTERS[b] for b in word.encode()])
        return BYTE_LETTERS[32] + word if led else word

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts."""
        if len(self.cache) > self.cache_parts:
            self.cache, self.older = {}, self.cache
        cache, older, tails, tokenize = self.cache, self.older, self.tails, self.model.tokenize
        found = [cache.get(part) for part in parts]
        others = []
        for i, ids in enumerate(found):
            if ids is not None:
                continue
            part = parts[i]
            if (ids := older.get(part)) is None:
                tail = tails.get(part[-1:])
                base = part if tail is None else part[:-1]
                if (word := self._word(base)) is None:
                    others.append(i)
                    continue
                ids = None if tail is None else cache.get(base)
                if ids is None:
                    ids = self._bytes([token.id for token in tokenize(word)])
                if tail is not None:
                    cache[base] = ids
                    ids += tail
            found[i] = cache[part] = ids
        encoded = self.tokenizer.encode_batch_fast([parts[i] for i in others], add_special_tokens=False)
        for i, ids in zip(others, encoded, strict=True):
            found[i] = self._bytes(ids.ids)
            if len(parts[i]) <= CACHE_CHARS:
                cache[parts[i]] = found[i]
        return found

    def _parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All words between spaces, whether a space belongs before each, and the number of words of each text."""
        if self.split is split_at_space:
            texts = pc.replace_substring(texts, "\n", " ")
        lists = pc.split_pattern(texts, " ")
        counts = np.asarray(lists.value_lengths(), dtype=np.int64)
        words, led = lists.flatten(), np.zeros(int(counts.sum()), dtype=bool)
        if self.split is split_before_space:
            led[:] = True
            led[np.cumsum(counts) - counts] = False
        return words, led, counts

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Texts that are not simply words between single spaces, or that hold special tokens."""
        whole = np.zeros(len(texts), dtype=bool)
        if self.special:
            whole |= np.asarray(pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False), dtype=bool)
        return whole

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each."""
        column = pa.array([text or "" for text in texts], pa.large_string())
        whole = self._whole(column)
        irregular = np.zeros(len(texts), dtype=bool)
        if self.split is split_before_space:
            irregular = np.asarray(pc.match_substring_regex(column, SPACE_THEN_SPACE).to_numpy(zero_copy_only=False), dtype=bool) & ~whole
        simple = ~whole & ~irregular
        # Whole texts are one part each, irregular ones are split by the pattern; both stand after the simple ones.
        words, led, counts = self._parts(column.filter(pa.array(simple)))
        extra = [[texts[i]] if whole[i] else self.split(texts[i]) for i in np.flatnonzero(~simple)]
        words = pa.chunked_array([words, pa.array([part for parts in extra for part in parts], words.type)]).combine_chunks()
        led = np.concatenate([led, np.zeros(len(words) - len(led), dtype=bool)])
        counts = np.concatenate([counts, np.array([len(parts) for parts in extra], dtype=np.int64)])
        coded = words.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64) * 2 + led
        used = np.flatnonzero(np.bincount(code, minlength=2 * len(coded.dictionary)))
        distinct = coded.dictionary.take(pa.array(used >> 1)).to_pylist()
        found = self._ids_of([" " + part if lead else part for part, lead in zip(distinct, (used & 1).tolist(), strict=True)])
        width = self.dtype.itemsize
        sizes = np.array([len(ids) for ids in found], dtype=np.int64) // width
        pool = np.frombuffer(b"".join(found), dtype=self.dtype)
        place = np.empty(2 * len(coded.dictionary), dtype=np.int64)
        place[used] = np.arange(len(used))
        at = place[code]
        ids = _gathered(pool, (np.cumsum(sizes) - sizes)[at], sizes[at])
        ends = np.concatenate([[0], np.cumsum(sizes[at])])[np.cumsum(counts)]
        n = np.diff(np.concatenate([[0], ends]))
        if not simple.all():
            # Back into the order of the texts.
            order = np.argsort(np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)]))
            ids, n = _gathered(ids, (np.cumsum(n) - n)[order], n[order]), n[order]
        return ids, n

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        ids, n = self.encode(texts)
        data, cuts = ids.tobytes(), [0, *(np.cumsum(n) * self.dtype.itemsize).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, split=split_before_space, cache_parts: int = CACHE_PARTS) -> Encoder:
    """The encoder of this Python worker for a tokenizer file."""
    key = (path, split.__name__, cache_parts)
    if key not in _encoders:
        _encoders[key] = Encoder(path, split, cache_parts=cache_parts)
    return _encoders[key]


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``limit`` bytes together (one text at least)."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(low, high - low)
        low = high
