"""Format-preserving pseudonyms for personal data.

Card numbers (with a valid check digit), dates of the calendar, telephone numbers, addresses of the
network and of mail are found by pattern, validated, and moved by a keyed permutation of all values of
their format: a Feistel network over the numbers below the format's size, walked on until it falls
inside. Equal values get equal pseudonyms in all documents, different ones different pseudonyms; who
holds the key can go back.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import free_name, with_python

KINDS = ("email", "ip", "date", "phone", "card")
ROUNDS = 10
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
#: Days up to the twelfth and after it: with slashes or dots and the month first, only the latter cannot be read day first.
HALVES = {
    late: [k for k in range(FIRST_DAY, LAST_DAY + 1) if (datetime.date.fromordinal(k).day > 12) == late]
    for late in (False, True)
}
_HOST = re.compile(r"(?:[\w-]+\.)+[^\W\d_]{2,}")
_IP = re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)", re.A)
_DATE = re.compile(r"(?<![\w./-])(?:(\d{4})-(\d{2})-(\d{2})|(\d{1,2})([./])(\d{1,2})\5(\d{4}))(?!\w)", re.A)
_PHONE = re.compile(r"(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<!\w)\(\d{3}\) ?\d{3}-\d{4}(?!\w)", re.A)
_CARD = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])", re.A)
_TRUNK = re.compile(r"\(\d\)", re.A)
_NUMBER = re.compile(r"\d", re.A)
# The calling codes of two digits. Those that begin with 1 or 7 have one digit, all others three.
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split()
)


def _round(key: bytes, tweak: str, k: int, value: int) -> int:
    data = f"{tweak}:{k}:{value}".encode()
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=32).digest(), "big")


def permuted(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """The keyed permutation of the numbers below ``size`` (or its inverse) at x."""
    if size < 2:
        return x
    side = math.isqrt(size - 1) + 1
    while True:
        left, right = divmod(x, side)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = (right - _round(key, tweak, k, left)) % side, left
            else:
                left, right = right, (left + _round(key, tweak, k, right)) % side
        x = left * side + right
        if x < size:
            return x


def luhn(digits: str) -> int:
    """The check digit of a number without it."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _put(text: str, digits: str) -> str:
    """The text with its digits, in order, replaced."""
    each = iter(digits)
    return _NUMBER.sub(lambda _: next(each), text)


def _number(x: str, key: bytes, tweak: str, back: bool) -> str:
    return str(permuted(int(x), 10 ** len(x), key, f"{tweak}{len(x)}", back)).zfill(len(x))


def card(found: str, key: bytes, back: bool = False) -> str | None:
    digits = re.sub(r"\D", "", found)
    if luhn(digits[:-1]) != int(digits[-1]):
        return None
    new = _number(digits[:-1], key, "card", back)
    return _put(found, new + str(luhn(new)))


def country_code(digits: str) -> str:
    """The calling code that the digits of an international number begin with."""
    return digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


def phone(found: str, key: bytes, back: bool = False) -> str | None:
    """Digits after the calling code are permuted, whatever parts the number: all spellings of it get one pseudonym.

    A number in brackets without a calling code is one of code 1. A single digit in brackets, as the
    (0) that is dialled from inside a country, stays and is not part of the number.
    """
    aside = _TRUNK.search(found)
    before, kept, after = (found[: aside.start()], aside[0], found[aside.end() :]) if aside else (found, "", "")
    digits = re.sub(r"\D", "", before + after)
    code = country_code(digits) if found[0] == "+" else "1"
    skipped = len(code) if found[0] == "+" else 0
    national = digits[skipped:]
    if not 6 <= len(national) <= 14:
        return None
    new = digits[:skipped] + _number(national, key, f"phone+{code}:", back)
    cut = len(re.sub(r"\D", "", before))
    return _put(before, new[:cut]) + kept + _put(after, new[cut:])


def ip(found: str, key: bytes, back: bool = False) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255 or any(str(int(p)) != p for p in found.split(".")):
        return None
    new = permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip", back)
    return ".".join(map(str, new.to_bytes(4, "big")))


def date(found: str, key: bytes, back: bool = False) -> str | None:
    """Dates of 1900 to 2099; with slashes or dots the day comes first where that is a date, else the month.

    One permutation serves all spellings, so a date is linked across them. Days after the twelfth of a month
    are permuted among themselves, and so are the others: an image can be spelled as its date was and read back.
    """
    m = _DATE.fullmatch(found)
    tries = [(m[1], m[2], m[3])] if m[1] else [(m[7], m[6], m[4])] + ([(m[7], m[4], m[6])] if int(m[4]) <= 12 else [])
    for turn, (year, month, day) in enumerate(tries):
        try:
            ordinal = datetime.date(int(year), int(month), int(day)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= ordinal <= LAST_DAY:
            return None
        late = int(day) > 12
        half = HALVES[late]
        image = half[permuted(bisect.bisect_left(half, ordinal), len(half), key, "late date" if late else "date", back)]
        new = datetime.date.fromordinal(image)
        if m[1]:
            return new.isoformat()
        first, second = (new.day, new.month) if turn == 0 else (new.month, new.day)
        return f"{first:0{len(m[4])}d}{m[5]}{second:0{len(m[6])}d}{m[5]}{new.year:04d}"
    return None


def _alphabet(c: str) -> tuple[int, int]:
    """First code point and size of the class that a character stays in; size 1: it stays itself."""
    for first, size in ((48, 10), (97, 26), (65, 26), (0xF8, 8), (0xE0, 23), (0xD8, 7), (0xC0, 23)):
        if first <= ord(c) < first + size:
            return first, size
    return ord(c), 1


def email(found: str, key: bytes, back: bool = False) -> str | None:
    """Letters and digits before the last two labels are permuted together, each within its class."""
    labels = found.split(".")
    tail = labels[-2:] if found.rindex("@") < len(found) - len(".".join(labels[-2:])) - 1 else labels[-1:]
    head = found[: len(found) - len(".".join(tail))]
    classes = [_alphabet(c) for c in head]
    size = math.prod(s for _, s in classes)
    x = 0
    for c, (first, s) in zip(head, classes, strict=True):
        x = x * s + (ord(c) - first)
    form = "".join(chr(first) if s > 1 else c for c, (first, s) in zip(head, classes, strict=True))
    x = permuted(x, size, key, f"email:{form}", back)
    out = []
    for first, s in reversed(classes):
        x, k = divmod(x, s)
        out.append(chr(first + k))
    return "".join(reversed(out)) + ".".join(tail)


_MAKE = {"email": email, "ip": ip, "date": date, "phone": phone, "card": card}


def _mails(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    while at >= 0:
        start = at
        while start and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        host = _HOST.match(text, at + 1)
        if start < at and host:
            yield start, host.end()
        at = text.find("@", at + 1)


def findings(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of validated values, left to right; where two overlap, the kind first in KINDS stands."""
    text = text or ""
    found = [(*s, "email") for s in _mails(text)]
    if _NUMBER.search(text):
        for kind, pattern in (("ip", _IP), ("date", _DATE), ("phone", _PHONE), ("card", _CARD)):
            found += [(*m.span(), kind) for m in pattern.finditer(text)]
    out: list[tuple[int, int, str]] = []
    for kind in KINDS:
        mine, free_from = [], 0
        starts = [start for start, _, _ in out]
        for start, end, _ in (f for f in found if f[2] == kind):
            # Spans in out are apart and in order, so only the last that begins before this one's end can meet it.
            before = bisect.bisect_left(starts, end) - 1
            clear = start >= free_from and (before < 0 or out[before][1] <= start)
            if clear and _MAKE[kind](text[start:end], b"-") is not None:
                mine.append((start, end, kind))
                free_from = end
        out = sorted(out + mine)
    return out


def pseudonymised(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, list[str]]:
    """The text with every finding moved (or moved back), and the kinds found; NULL stays NULL."""
    if text is None:
        return None, []
    out, at, kinds = [], 0, []
    for start, end, kind in findings(text):
        out += [text[at:start], _MAKE[kind](text[start:end], key, back)]
        at = end
        kinds.append(kind)
    return "".join(out) + text[at:], kinds


def pseudonyms(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and a count for each kind (n_email, ...).

    Every row stays with all its columns; NULL texts stay NULL, empty ones empty. Whether a value is
    found does not depend on other rows, so repeated rows are changed alike. A column that has the
    name of a count already raises.
    """
    name, kinds = free_name(docs, "__text"), free_name(docs, "__kinds")

    def make():
        return lambda texts: (pseudonymised(t, key, back) for t in texts)

    out = with_python(docs, ["text"], f"`{name}` string, `{kinds}` array<string>", make, drop=["text"])
    columns = [F.col(f"`{c}`") if c != "text" else F.col(f"`{name}`").alias("text") for c in docs.columns]
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return out.select(*columns, *counts)
