"""Array helpers against plain Python."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from reviewmill.llm import chat, huffman, language_model, packing, tokens, words
from reviewmill.llm.elias_fano import EliasFano, Level

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abAB09 .,\n\té中", max_size=40)), max_size=12)


def plain_words(text):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", folded)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    expected = [plain_words(t) for t in texts]
    for size in (1, 3, 5):
        got = {}
        for begin, _, keys, rows, counts in words.shingle_sets(pa.array(texts, pa.string()), size):
            for k, r, c in zip(keys, rows, counts):
                got.setdefault(begin + int(r), {})[int(k)] = int(c)
        seen = {}
        for i, found in enumerate(expected):
            runs = [tuple(found[j : j + size]) for j in range(len(found) - size + 1)] if len(found) >= size else [tuple(found)] * bool(found)
            mine = got.get(i, {})
            assert sorted(mine.values()) == sorted(runs.count(r) for r in set(runs))
            for key in mine:
                seen.setdefault(key, set()).add(i)
        for key, holders in seen.items():
            sets = [{tuple(expected[i][j : j + size]) for j in range(len(expected[i]) - size + 1)} or {tuple(expected[i])} for i in holders]
            assert set.intersection(*sets), key


def test_a_giant_word_and_many_slices():
    column = pa.array(["x" * 5_000_000, "a b", "x" * 5_000_000])
    parts = [words.words(data, offsets) for _, data, offsets in words.slices(column)]
    hashes = np.concatenate([p[0] for p in parts])
    assert len(hashes) == 4 and hashes[0] == hashes[3] != hashes[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=400), st.integers(1, 40))
def test_huffman_round_trip(ids, every):
    ids = np.array(ids)
    counts = np.bincount(ids)
    lengths = huffman.code_lengths(counts)
    used = lengths[lengths > 0].astype(float)
    assert (2.0**-used).sum() <= 1 and used.max() <= huffman.MAX_LENGTH
    payload, checkpoints = huffman.encode(ids, lengths, huffman.canonical_codes(lengths), every)
    (back,) = huffman.decode([payload], [len(ids)], [checkpoints], huffman.decoding_table(lengths), every)
    assert (back == ids).all()


def test_huffman_lengths_are_the_best_within_the_limit():
    fibonacci = [1, 1]
    while len(fibonacci) < 24:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    lengths = huffman.code_lengths(np.array(fibonacci))
    assert lengths.max() == huffman.MAX_LENGTH
    assert (2.0 ** -lengths.astype(float)).sum() == 1
    # Without a limit in reach it is Huffman's code: 1, 2, 3, ... bits.
    assert sorted(huffman.code_lengths(np.array(fibonacci[:10]))) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones((1 << 16) + 1, dtype=np.int64), 16)


def test_more_ids_than_16_bits_tell_apart():
    ids = np.random.default_rng(4).integers(0, 200_000, 300_000)
    ids[:250_000] %= 70_000
    lengths = huffman.code_lengths(np.bincount(ids))
    assert 16 < lengths.max() <= huffman.length_limit(int((lengths > 0).sum()))
    payload, checkpoints = huffman.encode(ids, lengths, huffman.canonical_codes(lengths), 256)
    (back,) = huffman.decode([payload], [len(ids)], [checkpoints], huffman.decoding_table(lengths), 256)
    assert (back == ids).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 48) - 1), max_size=200), st.lists(st.integers(0, (1 << 48) - 1), max_size=50))
def test_elias_fano_and_trie_level(values, others):
    keys = np.unique(np.array(values, dtype=np.uint64))
    coded = EliasFano.from_buffer(np.frombuffer(EliasFano.encode(keys, 48).to_bytes(), dtype=np.uint8))
    assert (coded.decode() == keys).all()
    wide = EliasFano.encode(keys << np.uint64(14), 62)
    assert (wide.decode() == keys << np.uint64(14)).all()
    level = Level.from_buffer(np.frombuffer(Level.build(keys, np.zeros(len(keys), np.uint8), 24, 40).to_bytes(), dtype=np.uint8))
    asked = np.concatenate([keys, np.array(others, dtype=np.uint64)])
    expected = [int(np.searchsorted(keys, a)) if a in keys else -1 for a in asked]
    assert coded.find(asked).tolist() == expected == level.find(asked).tolist()


def test_a_context_with_very_many_successors():
    draw = np.random.default_rng(2)
    keys = np.unique(np.concatenate([(7 << 24) + draw.integers(0, 1 << 24, 60_000), draw.integers(0, 1 << 48, 5_000)]).astype(np.uint64))
    level = Level.build(keys, np.zeros(len(keys), np.uint8), 24, 40)
    assert (level.find(keys) == np.arange(len(keys))).all()
    others = ((7 << 24) + draw.integers(0, 1 << 24, 60_000)).astype(np.uint64)
    assert ((level.find(others) >= 0) == np.isin(others, keys)).all()


@pytest.mark.parametrize("name, split", [("byte_bpe_50k.json", tokens.split_before_space), ("word_bpe_49k.json", tokens.split_at_space)])
@pytest.mark.parametrize("plain", [False, True])
def test_parts_give_the_ids_of_the_whole(name, split, plain):
    """The library's ids, special strings included; or with these as ordinary text."""
    from tokenizers import Tokenizer

    encoder = tokens.Encoder(public_tokenizers.path(name), split, plain)
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.encode_special_tokens = plain
    pieces = st.sampled_from(list("abcXYZ .,!?  \n\t0189éèßüÉªºµÿñ_-@#<|>ΣİſK中́\x1c\x85 ") + ["'s", "'ll", " the", " and.", "<|endoftext|>", "<|startoftext|>", "<|endof", "🙂", "\xa0", "\u2003", "  ", " \n"])

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(pieces, max_size=40).map("".join), max_size=5))
    def check(texts):
        got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder(texts)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]

    check()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="a<|\\turnextd>\n", max_size=12), st.text(alphabet="a<|\\turnextd>\n", max_size=30)), max_size=4))
def test_turns_are_read_back(turns):
    assert chat.parsed("".join(chat.rendered(r, t) for r, t in turns)) == turns


def sent(chunk: int, keys: list[int], counts: list[int]) -> dict:
    numbers = np.array(keys, dtype=np.uint64)
    return {
        "shard": 0,
        "chunk": chunk,
        "keys": EliasFano.encode(numbers, 62).to_bytes(),
        "counts": language_model._packed(np.array(counts), "<u8"),
        "asked": language_model._packed_bits(np.ones(len(keys), dtype=bool)),
        "context": None,
        "lower": None,
    }


@pytest.mark.parametrize(("values", "dtype", "planes"), [([], "<u8", 1), ([0, 7, 255], "<u8", 1), ([256, 1], "<u8", 2), ([1 << 63, 5], "<u8", 8), ([65535, 3], "<u2", 2)])
def test_only_planes_in_use_are_packed(values, dtype, planes):
    """All eight planes of small counts were packed."""
    packed = language_model._packed(np.array(values, dtype=dtype), dtype)
    assert language_model._unpacked(packed, dtype).tolist() == values
    assert len(zlib.decompress(packed[1:])) == planes * len(values)


def test_counts_beyond_32_bits_and_words_of_one_chunk():
    rows = [sent(1, [5, 9, 12], [3_000_000_000, 1, 0]), sent(2, [5, 11, 12], [3_000_000_000, 7, 0])]
    table = pa.Table.from_pylist(rows, schema=language_model.SENT)
    first, second, total = language_model._answer(1, language_model.Settings())(table).to_pylist()
    assert language_model._unpacked(first["counts"], "<u8").tolist() == [6_000_000_000, 1, 0]
    assert language_model._unpacked(second["counts"], "<u8").tolist() == [6_000_000_000, 7, 0]
    assert [language_model._unpacked_bits(a["alone"], 3).tolist() for a in (first, second)] == [[False, True, False]] * 2
    assert (total["n"], total["v"]) == (6_000_000_008, 3)


def test_contexts_with_equal_first_bits_stay_apart():
    context, word = 0xABCDEF << 16, 77
    keys = np.array([((context | c) << 24) | word for c in (1, 2, 3)], dtype=np.uint64)
    level = Level.build(keys, np.zeros(3, np.uint8), language_model.WORD_BITS, language_model.CONTEXT_BITS)
    assert level.find(keys).tolist() == [0, 1, 2]
    assert level.find(np.array([((context | 4) << 24) | word], dtype=np.uint64)).tolist() == [-1]


def test_packing_of_the_pipeline_keeps_few_parts_in_a_worker(monkeypatch):
    """A worker kept up to a million parts (and those of a slice of 4 MB), beside the memory of the other stages."""
    texts = [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(500)]
    batch = pa.record_batch([pa.array(range(500), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    monkeypatch.setattr(packing, "TaskContext", type("One", (), {"get": lambda: type("Task", (), {"partitionId": lambda: 0})}))
    monkeypatch.setattr(tokens, "_encoders", {})
    asked = {}

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            asked["run"] = run
            return self

        def withColumn(self, name, column):
            return self

    monkeypatch.setattr(corpus_pipeline.F, "crc32", lambda name: None)
    corpus_pipeline.packed(None, Docs(), "")
    most = 0
    for _ in asked["run"](iter([batch])):
        (encoder,) = tokens._encoders.values()
        most = max(most, len(encoder.cache) + len(encoder.older))
    assert 0 < most <= 400_000


def test_small_caches_and_slices_give_the_same_pieces(monkeypatch):
    texts = [" ".join(f"word{(i * j) % 97}, {j}" for j in range(40)) for i in range(60)] + ["", None, "a  b <|endoftext|> \u00e9t\u00e9"]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    monkeypatch.setattr(packing, "TaskContext", type("One", (), {"get": lambda: type("Task", (), {"partitionId": lambda: 0})}))
    path = public_tokenizers.path("byte_bpe_50k.json")

    def pieces(cache_parts, slice_bytes):
        monkeypatch.setattr(tokens, "_encoders", {})
        run = packing._pack(path, tokens.split_before_space, 0, packing.Limits(), False, cache_parts, slice_bytes)
        return [row for out in run(iter([batch])) for row in out.to_pylist()]

    assert pieces(5, 500) == pieces(tokens.CACHE_PARTS, tokens.SLICE_BYTES)
