"""Format-preserving pseudonyms for personal data.

Mail addresses, telephone numbers, card and account numbers, IPv4 addresses,
IBANs, social security numbers, dates and quoted or assigned secrets are
found by patterns and validated (octets, month lengths, check digits). A
value's variable characters are one number below the size of its format; a
keyed Feistel network permutes the numbers of that format, walking on until
the result is valid in the same way. Equal values thus get equal pseudonyms
in every document, different values different ones, and separators, length
and validity stay.

Dates in figures are read month first with a slash and day first with other
separators; if that's no date, the other way round (25/12/1990, 12-25-1990).
One day has one pseudonym in all styles of the first reading; dates of the
other reading are a format of their own and aren't linked with them.

A text of any length is read in time linear in it: mail addresses are sought
from their sign, and a value of more than ``WIDE`` variable characters is
permuted in blocks of that width, each keyed by the block before it, forwards
and then backwards, so that every character counts for all of them.

Defined cases: null and empty texts stay as they are; a text without a find
is returned unchanged; columns other than the text are not touched.
"""

from __future__ import annotations

import calendar
import datetime
import functools
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.llm.common import prepare


# The setting that names the key, and the key where it is unset (as in tests).
KEY_SETTING = "spark.qaspark.pseudonym.secret"
DEFAULT_KEY = "qaspark-pseudonym-key"
ROUNDS = 8
# Characters permuted as one number.
WIDE = 256
# Longer values aren't kept with their pseudonyms.
KEPT_CHARS = 256
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX_LOWER, _HEX_UPPER = _DIGITS + "abcdef", _DIGITS + "ABCDEF"


def _round_value(right: bytes, i: int, key: bytes) -> bytes:
    """Keyed pseudo-random bytes of one round, at least as many as ``right``
    has: above 64, the most a BLAKE2b digest has, a digest of any length."""
    if len(right) <= 64:
        return hashlib.blake2b(right + bytes([i]), key=key, digest_size=min(64, len(right) + 8)).digest()
    return hashlib.shake_256(key + bytes([i]) + right).digest(len(right) + 8)


def permute(value: int, size: int, key: bytes, valid: Callable[[int], bool] = lambda _: True) -> int:
    """Keyed permutation of the valid numbers below ``size``: a balanced
    Feistel network over the next even number of bits, walked until the
    number is below ``size`` and valid (``value`` itself is both)."""
    half = max(1, math.ceil(max(size - 1, 1).bit_length() / 2))
    mask = (1 << half) - 1
    width = (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            left, right = right, left ^ (int.from_bytes(_round_value(right.to_bytes(width, "big"), i, key), "big") & mask)
        value = (left << half) | right
        if value < size and valid(value):
            return value


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _alphabet(c: str) -> str | None:
    return next((a for a in (_DIGITS, _LOWER, _UPPER) if c in a), None)


def _characters(text: str, key: bytes, kind: str, valid: Callable[[str], bool] | None = None, fixed: int = 0, hexadecimal: bool = False) -> str:
    """Permute the letters and digits of ``text`` after the first ``fixed``
    characters within their classes; ``valid`` judges whole results, of at
    most ``WIDE`` such characters."""
    if hexadecimal:
        upper = any(c in "ABCDEF" for c in text)
        slots = [(i, _HEX_UPPER if upper else _HEX_LOWER) for i in range(fixed, len(text))]
    else:
        slots = [(i, a) for i, c in enumerate(text) if i >= fixed and (a := _alphabet(c))]
    shape = f"{kind}:" + "".join(a[-1] if (a := _alphabet(c)) else c for c in text[fixed:])
    salted = hashlib.blake2b(shape.encode("utf-8", "surrogatepass"), key=key, digest_size=32).digest()
    out = list(text)
    if len(slots) <= WIDE:
        _permute_slots(out, slots, salted, valid)
        return "".join(out)
    blocks = [slots[i : i + WIDE] for i in range(0, len(slots), WIDE)]
    for turn, order in ((b"f", blocks), (b"b", blocks[::-1])):
        before = b""
        for block in order:
            _permute_slots(out, block, hashlib.blake2b(turn + before, key=salted, digest_size=32).digest())
            before = "".join(out[i] for i, _ in block).encode()
    return "".join(out)


def _permute_slots(out: list[str], slots: list[tuple[int, str]], key: bytes, valid: Callable[[str], bool] | None = None) -> None:
    """Permute the characters of ``out`` at ``slots``, in place, as one number."""
    size = math.prod(len(a) for _, a in slots)
    number = 0
    for i, a in slots:
        number = number * len(a) + a.index(out[i])

    def put(n: int) -> None:
        for i, a in reversed(slots):
            n, r = divmod(n, len(a))
            out[i] = a[r]

    def holds(n: int) -> bool:
        put(n)
        return valid("".join(out))

    put(permute(number, size, key, holds) if valid else permute(number, size, key))


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _email(m: re.Match, key: bytes) -> str:
    whole = m.group()
    name, _, last = whole.rpartition(".")
    return _characters(name, key, "email") + "." + last


def _phone(m: re.Match, key: bytes) -> str | None:
    text = m.group()
    if not 7 <= len(_digits(text)) <= 15:
        return None
    start = re.match(r"\+\d{1,3}(?=[\s.(-])", text)
    return _characters(text, key, "phone", fixed=start.end() if start else 0)


def _card(m: re.Match, key: bytes) -> str | None:
    text = m.group()
    digits = _digits(text)
    if not 13 <= len(digits) <= 19:
        return None
    good = luhn(digits)
    return _characters(text, key, f"card{good}", lambda t: luhn(_digits(t)) == good)


# Least and most octet of each number of digits.
_OCTETS = {1: (0, 9), 2: (10, 99), 3: (100, 255)}


def _ip(m: re.Match, key: bytes) -> str | None:
    parts = m.group().split(".")
    if any(not _OCTETS[len(x)][0] <= int(x) <= _OCTETS[len(x)][1] for x in parts):
        return None
    number = 0
    for x in parts:
        low, high = _OCTETS[len(x)]
        number = number * (high - low + 1) + int(x) - low
    shape = "ip" + "".join(str(len(x)) for x in parts)
    size = math.prod(_OCTETS[len(x)][1] - _OCTETS[len(x)][0] + 1 for x in parts)
    number = permute(number, size, hashlib.blake2b(shape.encode(), key=key, digest_size=32).digest())
    out = []
    for x in reversed(parts):
        low, high = _OCTETS[len(x)]
        number, r = divmod(number, high - low + 1)
        out.append(str(low + r))
    return ".".join(reversed(out))


def _ssn(m: re.Match, key: bytes) -> str | None:
    ok = lambda t: t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00" and t[7:] != "0000"
    return _characters(m.group(), key, "ssn", ok) if ok(m.group()) else None


def _iban(m: re.Match, key: bytes) -> str | None:
    text = m.group()
    if not iban_ok(text):
        return None
    # the check digits follow from the account part, which is permuted
    account = _characters(text[4:], key, "iban" + text[:2])
    rest = int("".join(str(int(c, 36)) for c in account + text[:2] + "00")) % 97
    return f"{text[:2]}{98 - rest:02d}{account}"


_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _is_date(year: int, month: int, day: int) -> bool:
    return 1900 <= year <= 2099 and 1 <= month <= 12 and 1 <= day <= calendar.monthrange(year, month)[1]


def _date(m: re.Match, key: bytes) -> str | None:
    """Year first; else month first with a slash, day first with other
    separators, and the other way round if that's no date. Dates read the
    other way round, whose day is over 12, are permuted among themselves, so
    that no result can be read as one of the first reading."""
    text = m.group()
    a, sep, b, c = re.fullmatch(r"(\d+)([-/.])(\d+)[-/.](\d+)", text).groups()
    year_first, month_first, other = len(a) == 4, sep == "/", False
    if year_first:
        year, month, day = int(a), int(b), int(c)
    else:
        year, month, day = (int(c), int(a), int(b)) if month_first else (int(c), int(b), int(a))
        if not _is_date(year, month, day):
            month, day, month_first, other = day, month, not month_first, True
    if not _is_date(year, month, day):
        return None
    n = datetime.date(year, month, day).toordinal() - _FIRST
    valid = lambda n: not other or datetime.date.fromordinal(_FIRST + n).day > 12
    salted = hashlib.blake2b(b"date over 12" if other else b"date", key=key, digest_size=32).digest()
    new = datetime.date.fromordinal(_FIRST + permute(n, _LAST - _FIRST + 1, salted, valid))
    if year_first:
        return f"{new.year}{sep}{new.month:02d}{sep}{new.day:02d}"
    first, second = (new.month, new.day) if month_first else (new.day, new.month)
    return f"{first:02d}{sep}{second:02d}{sep}{new.year}"


def _secret(m: re.Match, key: bytes) -> str:
    text = m.group("secret")
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text) is not None
    new = _characters(text, key, "secret", hexadecimal=hexadecimal)
    return m.group()[: m.start("secret") - m.start()] + new + m.group()[m.end("secret") - m.start() :]


def _bare_secret(m: re.Match, key: bytes) -> str:
    text = m.group()
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        return _characters(text, key, "secret", hexadecimal=True)
    return text[:4] + _characters(text[4:], key, "bare")


# In order of precedence; an earlier kind takes the characters it matches,
# unless they don't hold for it: then later kinds are tried from there on.
KINDS = {
    "secret": (
        r"""(?:(?i:token|secret|passw(?:or)?d|api[_-]?key|key)["']?\s*[=:]\s*["']?(?P<secret>[A-Za-z0-9+/_-]{16,}))""",
        _secret,
    ),
    "bare_secret": (
        r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])",
        _bare_secret,
    ),
    "email": (r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", _iban),
    "date": (
        r"(?<![\d.])(?:(?:19|20)\d{2}(?P<d1>[-/.])\d{2}(?P=d1)\d{2}|\d{2}(?P<d2>[-/.])\d{2}(?P=d2)(?:19|20)\d{2})(?![\d]|\.\d)",
        _date,
    ),
    "ip": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _ip),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "card": (r"(?<!\d)\d(?:\d{12,18}|\d{3}(?:[ -]\d{4}){3})(?!\d)", _card),
    "phone": (
        r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{3,4}){1,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
        _phone,
    ),
}


_MAIL = list(KINDS).index("email")
_MAIL_CHARS = _LOWER + _UPPER + _DIGITS + "._%+-"
_MAIL_REST = re.compile(KINDS["email"][0][KINDS["email"][0].index("@") :], re.ASCII)
_MAIL_START = re.compile("[A-Za-z0-9]")


@functools.lru_cache(maxsize=1)
def _pattern() -> re.Pattern:
    """Every kind but mail addresses, whose name could start at each
    character of a long run."""
    return re.compile("|".join(f"(?P<k_{k}>{p})" for k, (p, _) in KINDS.items() if k != "email"), re.ASCII)


class _Finds:
    """The finds of a text from left to right, of equal starts the earlier
    kind. What is found ahead is kept, so that no part is searched twice."""

    def __init__(self, text: str):
        self._text = text
        self._other = _pattern().search(text)
        # the sign of the next address, and the first character it may start at
        self._sign, self._low = -1, 0
        self._to_next_sign()

    def _to_next_sign(self) -> None:
        """To the next sign that a domain follows (-1: none)."""
        while True:
            last = self._sign
            self._sign = self._text.find("@", last + 1)
            if self._sign < 0:
                return
            if _MAIL_REST.match(self._text, self._sign):
                before = self._text[last + 1 : self._sign]
                self._low = last + 1 + len(before.rstrip(_MAIL_CHARS))
                return

    def _mail(self, at: int) -> int:
        """Start of the next address from ``at`` on, or -1."""
        while self._sign >= 0:
            first = _MAIL_START.search(self._text, max(at, self._low), self._sign)
            if first:
                self._low = first.start()
                return self._low
            self._to_next_sign()
        return -1

    def next(self, at: int) -> tuple[str, re.Match] | None:
        """Kind and match of the first find that starts at ``at`` or later."""
        if self._other and self._other.start() < at:
            self._other = _pattern().search(self._text, at)
        other, mail = self._other, self._mail(at)
        kind = next(k for k in KINDS if k != "email" and other.group(f"k_{k}") is not None) if other else None
        if mail >= 0 and (not other or mail < other.start() or (mail == other.start() and list(KINDS).index(kind) > _MAIL)):
            return "email", _kind_pattern("email").match(self._text, mail)
        return (kind, other) if other else None


@functools.cache
def _kind_pattern(kind: str) -> re.Pattern:
    return re.compile(KINDS[kind][0], re.ASCII)


# Every kind holds a digit, a mail sign, an assignment, a prefix or a run of
# figures from a to f; texts without any are passed on without a search.
_MAY = re.compile(r"[0-9@]|(?i:token|secret|passw|key)|sk-|gh[pousr]_|AKIA|[a-f]{32}|[A-F]{32}")


class Pseudonyms:
    """Replaces the finds of texts; keeps recent values' pseudonyms."""

    def __init__(self, key: str):
        self._key = hashlib.blake2b(key.encode(), digest_size=32).digest()
        self._known: dict = {}

    def replace(self, text: str | None) -> tuple[str | None, dict]:
        if not text or not _MAY.search(text):
            return text, {}
        counts: dict[str, int] = {}

        out, done, at, finds = [], 0, 0, _Finds(text)
        while found := finds.next(at):
            kind, m, new = self._read(text, *found)
            if new is None:
                at = m.start() + 1
                continue
            counts[kind] = counts.get(kind, 0) + 1
            out += [text[done : m.start()], new]
            done = at = m.end()
        return "".join([*out, text[done:]]), counts

    def _read(self, text: str, first: str, m: re.Match) -> tuple[str, re.Match, str | None]:
        """A find under the first kind that holds for it, or with None."""
        new = self._pseudonym(first, m)
        if new is None:
            for kind in list(KINDS)[list(KINDS).index(first) + 1 :]:
                again = _kind_pattern(kind).match(text, m.start())
                if again and (new := self._pseudonym(kind, again)) is not None:
                    return kind, again, new
        return first, m, new

    def _pseudonym(self, kind: str, m: re.Match) -> str | None:
        value = m.group()
        if len(value) > KEPT_CHARS:
            return KINDS[kind][1](m, self._key)
        if (kind, value) not in self._known:
            if len(self._known) > 100_000:
                self._known.clear()
            self._known[kind, value] = KINDS[kind][1](m, self._key)
        return self._known[kind, value]


def _udf(key: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = Pseudonyms(key)
        for texts in batches:
            done = [names.replace(t) for t in texts]
            yield pd.DataFrame({"text": [t for t, _ in done], "finds": [list(c.items()) for _, c in done]})

    return run


def with_pseudonyms(docs: DataFrame, text_col: str = "text", key: str | None = None, finds_col: str | None = None) -> DataFrame:
    """``docs`` with the text column's personal data replaced; with
    ``finds_col``, also the number of replaced values by kind. Without a key
    the session's setting ``KEY_SETTING`` counts."""
    prepare(docs.sparkSession)
    key = key or docs.sparkSession.conf.get(KEY_SETTING, DEFAULT_KEY)
    run = F.pandas_udf(_udf(key), "text string, finds array<struct<kind:string,n:int>>")
    out = docs.withColumn("_pii", run(F.col(text_col)))
    named = [F.col("_pii.text").alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if finds_col:
        named.append(F.map_from_entries("_pii.finds").alias(finds_col))
    return out.select(*named)
