"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation within each format.

A value is read as a number among all values of its format (same kind, length and character classes),
permuted, and written in the same format. The permutation depends on the key and the format only, so equal
values get equal pseudonyms in all documents and different values different ones. It is a keyed
rotation seen through a Feistel permutation, so no value stays as it is.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROUNDS = 8
CACHE = 1 << 14
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
LATIN = "".join(chr(c) for c in range(0xE0, 0x100) if c != 0xF7)
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", LATIN)
HEX = ("0123456789abcdef", "0123456789ABCDEF")

# One alternative per kind; what a kind does not accept after validation stays as it is.
PATTERN = re.compile(
    r"""(?P<email>[\w.%+-]+(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+))
    |(?<![\w])(?P<hex>[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\w])
    |(?<![\w])(?P<secret>(?:AKIA|ASIA|ghp_|gho_|sk-|xox[bp]-)[A-Za-z0-9_-]{16,})
    |(?<![\w])(?P<iban>[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![\w])
    |(?<![\w.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![\w]|\.[0-9])
    |(?<![\w])(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![\w])
    |(?<![\w])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])
    |(?P<phone>(?:\+[0-9]{1,3}[ .-]?|(?<![\w]))(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![\w])
    |(?<![\w])(?P<card>[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w])
    |(?P<number>\+[0-9](?:(?:[ .-](?![0-9]{4}-[0-9]{2}-[0-9]{2}(?![\w])))?\(?[0-9]\)?){7,14})(?![\w])""",
    re.VERBOSE,
)
# An account in groups of four, looked for before all others; its end may be any group.
GROUPED_IBAN = re.compile(r"(?<![\w])[A-Z]{2}[0-9]{2}(?:[ -][A-Z0-9]{4}){2,7}(?:[ -][A-Z0-9]{1,3})?(?![\w])")
_WORTH_A_LOOK = re.compile(r"[0-9@]")


class Permutation:
    """A keyed permutation of ``0 .. size - 1`` without fixed points (for a size of 2 or more)."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.key, self.size = hashlib.blake2b(f"{kind}:{size}".encode(), key=key, digest_size=32).digest(), size
        self.left = math.isqrt(max(size - 1, 0)) + 1
        self.right = -(-size // self.left)
        self.turn = 1 + self._f(0, 0, size - 1) if size > 2 else 1

    def _f(self, step: int, value: int, modulus: int) -> int:
        data = step.to_bytes(1, "big") + value.to_bytes((value.bit_length() + 7) // 8 + 1, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big") % modulus

    def _rounds(self, value: int, sign: int) -> int:
        while True:
            a, b = divmod(value, self.right)
            for step in range(1, ROUNDS + 1) if sign > 0 else range(ROUNDS, 0, -1):
                if step % 2:
                    a = (a + sign * self._f(step, b, self.left)) % self.left
                else:
                    b = (b + sign * self._f(step, a, self.right)) % self.right
            value = a * self.right + b
            if value < self.size:  # the two halves may hold a little more than the format
                return value

    def __call__(self, value: int) -> int:
        if self.size < 2:
            return value
        return self._rounds((self._rounds(value, -1) + self.turn) % self.size, 1)


def _mixed(text: str, alphabets: list[str | None]) -> tuple[int, int]:
    """The value as a number in mixed radix, and how many there are."""
    value, size = 0, 1
    for letter, alphabet in zip(text, alphabets, strict=True):
        if alphabet:
            value, size = value * len(alphabet) + alphabet.index(letter), size * len(alphabet)
    return value, size


def _written(value: int, text: str, alphabets: list[str | None]) -> str:
    out = list(text)
    for i in range(len(text) - 1, -1, -1):
        if alphabets[i]:
            value, digit = divmod(value, len(alphabets[i]))
            out[i] = alphabets[i][digit]
    return "".join(out)


def luhn(digits: str) -> int:
    """The check digit that belongs after ``digits``."""
    doubled = [int(d) * (2 if i % 2 == 0 else 1) for i, d in enumerate(reversed(digits))]
    return -sum(d - 9 if d > 9 else d for d in doubled) % 10


class Pseudonyms:
    """Pseudonyms under one key; a key of 16 to 64 secret bytes."""

    def __init__(self, key: bytes):
        self.key = key
        self.permutation: Callable = lru_cache(CACHE)(lambda kind, size: Permutation(key, kind, size))
        self.of = lru_cache(CACHE)(self._of)

    def _by_class(self, kind: str, text: str, alphabets: list[str | None]) -> str:
        value, size = _mixed(text, alphabets)
        shape = "".join("x" if a is None else str(len(a) % 10) for a in alphabets)
        fixed = "".join(c for c, a in zip(text, alphabets, strict=True) if a is None)
        return _written(self.permutation(f"{kind}:{shape}:{fixed}", size)(value), text, alphabets)

    def _digits(self, kind: str, text: str, valid: Callable[[str], bool] = lambda text: True, keep: int = 0) -> str | None:
        """All digits but the first ``keep`` characters permuted, again and again until the value is valid."""
        if not valid(text):
            return None
        alphabets = [CLASSES[0] if c in CLASSES[0] and i >= keep else None for i, c in enumerate(text)]
        new = self._by_class(kind, text, alphabets)
        while not valid(new):
            new = self._by_class(kind, new, alphabets)
        return new

    def _of(self, kind: str, text: str) -> str | None:
        """The pseudonym of a value, or None if the value is none of its kind."""
        return getattr(self, f"_{kind}")(text)

    def _email(self, text: str) -> str:
        return self._by_class("email", text, [next((c for c in CLASSES if letter in c), None) for letter in text])

    def _hex(self, text: str) -> str | None:
        if text.isdigit() and len(text) <= 19:
            return None
        alphabet = HEX[1] if text.upper() == text and not text.isdigit() else HEX[0]
        return self._by_class("hex", text, [alphabet] * len(text))

    def _secret(self, text: str) -> str:
        fixed = re.match("AKIA|ASIA|ghp_|gho_|sk-|xox[bp]-", text).end()
        return self._by_class("secret", text, [next((c for c in CLASSES if x in c), None) if i >= fixed else None for i, x in enumerate(text)])

    def _iban(self, text: str) -> str | None:
        def check(country: str, account: str) -> int:
            return 98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97

        plain = re.sub("[ -]", "", text)
        country, account = plain[:2], plain[4:]
        if not 11 <= len(account) <= 30 or int(plain[2:4]) != check(country, account):
            return None
        new = self._by_class("iban" + country, account, [CLASSES[0] if c.isdigit() else CLASSES[2] for c in account])
        written = iter(f"{country}{check(country, new):02d}{new}")
        return "".join(c if c in " -" else next(written) for c in text)

    def _ip(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        low = [{1: 0, 2: 10, 3: 100}[len(p)] for p in parts]
        sizes = [{1: 10, 2: 90, 3: 156}[len(p)] for p in parts]
        value = 0
        for p, start, size in zip(parts, low, sizes, strict=True):
            value = value * size + int(p) - start
        value = self.permutation("ip:" + ".".join(map(str, low)), math.prod(sizes))(value)
        out = []
        for start, size in zip(reversed(low), reversed(sizes), strict=True):
            value, digit = divmod(value, size)
            out.append(str(start + digit))
        return ".".join(reversed(out))

    def _date(self, text: str) -> str | None:
        separator = next(c for c in text if not c.isdigit())
        parts = text.split(separator)
        # Year first, month first with slashes, day first with dots.
        order = {"-": (0, 1, 2), "/": (2, 0, 1), ".": (2, 1, 0)}[separator]
        try:
            day = datetime.date(*(int(parts[i]) for i in order)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        permute, lengths = self.permutation("date", LAST_DAY - FIRST_DAY + 1), [len(p) for p in parts]
        while True:
            day = permute(day - FIRST_DAY) + FIRST_DAY
            date = datetime.date.fromordinal(day)
            new = [""] * 3
            for i, value in zip(order, (date.year, date.month, date.day), strict=True):
                new[i] = str(value).zfill(lengths[i])
            if [len(p) for p in new] == lengths:
                return separator.join(new)

    def _ssn(self, text: str) -> str | None:
        return self._digits("ssn", text, lambda t: t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00" and t[7:] != "0000")

    def _phone(self, text: str) -> str:
        """The country code stays."""
        local = re.search(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$", text).start()
        return self._digits("phone", text, keep=local)

    def _number(self, text: str) -> str:
        """The country code stays if it stands alone, else its first digit."""
        code = re.match(r"\+[0-9]{1,3}(?=[ .(-])", text)
        return self._digits("phone", text, keep=code.end() if code else 2)

    def _card(self, text: str) -> str:
        """The payload is permuted; a right check digit stays right, a wrong one as wrong as it was.

        Numbers that fail the check are changed, too: a mistyped card number is still a private one.
        """
        payload = re.sub("[^0-9]", "", text)[:-1]
        off = (int(text[-1]) - luhn(payload)) % 10
        new = self._by_class("card", text[:-1], [CLASSES[0] if c in CLASSES[0] else None for c in text[:-1]])
        return new + str((luhn(re.sub("[^0-9]", "", new)) + off) % 10)

    def replace(self, text: str | None) -> tuple[str | None, int]:
        """The text with pseudonyms, and how many values were replaced."""
        if not text or not _WORTH_A_LOOK.search(text):
            return text, 0
        count = 0

        def one(match: re.Match) -> str:
            nonlocal count
            new = self.of(match.lastgroup, match.group())
            if new is None:
                return match.group()
            count += 1
            return new

        parts, at = [], 0
        for match in self._grouped_ibans(text):
            parts += [PATTERN.sub(one, text[at : match[0]]), match[2]]
            at, count = match[1], count + 1
        return "".join([*parts, PATTERN.sub(one, text[at:])]), count

    def _grouped_ibans(self, text: str) -> Iterator[tuple[int, int, str]]:
        """Begin, end and pseudonym of each account in groups; of several valid ends the last."""
        at = 0
        while match := GROUPED_IBAN.search(text, at):
            at, found = match.start() + 1, match.group()
            while len(found) > 15:
                if new := self.of("iban", found):
                    at = match.start() + len(found)
                    yield match.start(), at, new
                    break
                found = found[: max(found.rfind(" "), found.rfind("-"), 0)]


_workers: dict[bytes, Pseudonyms] = {}


def _replace(index: int, counted: bool, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = _workers.setdefault(key, Pseudonyms(key))
        for batch in batches:
            results = [pseudonyms.replace(text) for text in batch.column(index).to_pylist()]
            arrays, names = list(batch.columns), list(batch.schema.names)
            arrays[index] = pa.array([text for text, _ in results], pa.string())
            if counted:
                arrays.append(pa.array([n for _, n in results], pa.int32()))
                names.append("_replaced")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def pseudonymize(docs: DataFrame, key: bytes, column: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``column``, other columns as they are; ``count`` names a column with the
    number of replaced values (it must not be there yet).

    E-mail names (the domain stays), phone numbers (3-3-4, or after a + in any groups of 8 to 15 digits), card-like
    numbers of 13 to 19 digits, IPv4 addresses, bank accounts (IBAN, also in groups of four), US social security numbers, calendar dates from 1900 to 2099, and secrets (hex strings
    of 32 to 128 digits, keys with a known prefix). What fails its check (an octet above 255, a 31 June)
    stays, except that numbers like cards keep their check digit right or wrong. Null stays null. Lengths
    stay the same. Rows are handled one by one, so nothing is shuffled.
    """
    if count is not None and count in docs.columns:
        raise ValueError(f"column {count} is there already")
    fields = [T.StructField(f.name, T.StringType() if f.name == column else f.dataType) for f in docs.schema.fields]
    if count is not None:
        fields.append(T.StructField(count, T.IntegerType()))
    return docs.mapInArrow(_replace(docs.columns.index(column), count is not None, key), T.StructType(fields))
