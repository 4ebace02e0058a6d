"""Format-preserving pseudonyms for personal data: validated numbers and dates are keyed-permuted within their format.

A value is a tuple of digits in mixed radices; a Feistel network with modular addition permutes the two halves'
values, keyed by BLAKE2. Whatever is not a digit or letter stays, check digits are computed anew, and values that would
be invalid are permuted again until valid (cycle walking), so a pseudonym is valid where its original was. The same
value has the same pseudonym in every document, task and run with the key, and two values never share one.

Cards (Luhn), account numbers (mod 97), social security numbers (allowed ranges, with dashes), phone numbers (3-3-4, behind
a country code in any grouping, or behind an area code with 0), addresses (four octets, or eight groups), dates (in figures, or with an
English month name) and e-mail names in the alphabets listed below are covered; strings that fail validation are left alone, and so are
bare runs of nine or ten digits, which may be anything. A date or number written in two ways has one pseudonym,
written in the same two ways; an address of eight groups comes back written out.

Defined cases: null stays null with no finds, empty stays empty; overlapping matches go to the first and longest kind;
repeated rows get equal results; bytes that are not UTF-8 stay; texts of any length are read whole; other columns pass through.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shared import unused
from skyledger.llm.texts import blocks, raw

ROUNDS = 10
# Month names, and the countries' codes of one and two digits; all others have three.
MONTHS = "January February March April May June July August September October November December".split()
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
KINDS = ("email", "card", "account", "ssn", "phone", "address", "date")
# The formats that are recognised.
_EMAIL = r"(?P<email>[^\W_][\w.+%-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
_NUMBERS = (
    r"(?P<account>(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<address>(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d))"
    r"|(?P<date>(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\w/]|[.-]\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w))"
    r"|(?P<card>(?<![\w])\d(?:[ -]?\d){12,18}(?!\w))"
    r"|(?P<abroad>(?<![\w+])\+\d{1,3}(?:[ ./-]?\(?\d{1,4}\)?){2,6}(?!\w))"
    r"|(?P<trunk>(?<![\w.,/+-])(?:\(0\d{1,4}\)[ ./-]?\d{3,8}|0[1-9]\d{1,3}[ /-]\d{3,8})(?:[ -]\d{2,5}){0,2}(?![\w.,/-]*\d))"
    r"|(?P<address6>(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){2}(?:[0-9A-Fa-f]{0,4}:){0,5}[0-9A-Fa-f]{1,4}(?![\w:.]))"
    r"|(?P<named>(?<!\w)(?:\d{1,2} %(m)s,? \d{4}|%(m)s \d{1,2},? \d{4})(?!\w))" % {"m": "(?:%s)" % "|".join(m if m[:3] == m else f"{m}|{m[:3]}" for m in MONTHS)}
)
_PLAIN = re.compile(_NUMBERS)
_MAILED = re.compile(_EMAIL + "|" + _NUMBERS)
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")
_PLACE = {c: (a, i) for a in _ALPHABETS for i, c in enumerate(a)}
# First and last letter of other alphabets, each permuted within itself.
_SCRIPTS = "αω ΑΡ ΣΩ ая АЯ את ءغ في अह กฮ ぁゖ ァヺ 一龥 가힣".split()


def _place(c: str) -> tuple[int, int, int] | None:
    """Size of a character's alphabet, its place in it, and the code point of the first (or -1)."""
    if c in _PLACE:
        alphabet, i = _PLACE[c]
        return len(alphabet), i, -1
    for first, last in _SCRIPTS:
        if first <= c <= last:
            return ord(last) - ord(first) + 1, ord(c) - ord(first), ord(first)
    return None


class Cipher:
    """Keyed permutations of tuples of digits with given radices."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, turn: int, value: int, size: int) -> int:
        said = f"{kind}|{turn}|{size}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=32).digest(), "big")

    def permute(self, kind: str, digits: list[int], radices: list[int], sign: int = 1) -> list[int]:
        """The pseudonym of ``digits``; with ``sign`` -1 the digits of a pseudonym."""
        half = len(digits) // 2
        sizes, values = [], []
        for part, radix in ((digits[:half], radices[:half]), (digits[half:], radices[half:])):
            size = value = 1
            value = 0
            for d, r in zip(part, radix):
                value, size = value * r + d, size * r
            sizes.append(size)
            values.append(value)
        shape = f"{kind}|{','.join(map(str, radices))}"
        for turn in range(ROUNDS) if sign > 0 else reversed(range(ROUNDS)):
            to = turn % 2
            values[to] = (values[to] + sign * self._round(shape, turn, values[1 - to], sizes[to])) % sizes[to]
        out = []
        for value, radix in zip(values, (radices[:half], radices[half:])):
            part = []
            for r in reversed(radix):
                value, d = divmod(value, r)
                part.append(d)
            out += part[::-1]
        return out

    def walk(self, kind: str, digits: list[int], radices: list[int], valid: Callable[[list[int]], bool]) -> list[int]:
        """Permute until valid again: a permutation of the valid values."""
        while True:
            digits = self.permute(kind, digits, radices)
            if valid(digits):
                return digits


def luhn_sum(digits: list[int]) -> int:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))


def _refilled(text: str, digits: list[int]) -> str:
    rest = iter(digits)
    return "".join(str(next(rest)) if c.isdecimal() else c for c in text)


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c.isdecimal()]


def card(cipher: Cipher, text: str) -> str | None:
    d = _digits(text)
    if luhn_sum(d) % 10 or not any(d):
        return None
    body = cipher.walk("card", d[:-1], [10] * (len(d) - 1), any)
    return _refilled(text, [*body, -luhn_sum([*body, 0]) % 10])


def account(cipher: Cipher, text: str) -> str | None:
    plain = text.replace(" ", "")
    rest = lambda body: int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    if not 15 <= len(plain) <= 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    body = _alphabetic(cipher, "account", plain[4:])
    out = iter(plain[:2] + f"{98 - rest(body):02d}" + body)
    return "".join(c if c == " " else next(out) for c in text)


def ssn(cipher: Cipher, text: str) -> str | None:
    def valid(d: list[int]) -> bool:
        area = d[0] * 100 + d[1] * 10 + d[2]
        return area not in (0, 666) and area < 900 and any(d[3:5]) and any(d[5:])

    d = _digits(text)
    return _refilled(text, cipher.walk("ssn", d, [10] * 9, valid)) if valid(d) else None


def phone(cipher: Cipher, text: str) -> str | None:
    """Country code or the 0 before an area code stay, and the exchange 555, which is never anyone's."""
    d = _digits(text)
    if text[0] == "+":
        size = next((n for n in (1, 2) if "".join(map(str, d[:n])) in CODES), 3)
    else:
        size = int(d[0] == 0 and len(d) != 10 or text.startswith(("0", "(0")))
    code, number = d[:size], d[size:]
    if not 6 <= len(number) <= 13 or len(d) > 15:
        return None
    if len(number) == 10 and number[3:6] == [5, 5, 5]:
        p = cipher.permute("phone 555", number[:3] + number[6:], [10] * 7)
        return _refilled(text, code + p[:3] + [5, 5, 5] + p[3:])
    if len(number) == 10:
        return _refilled(text, code + cipher.walk("phone", number, [10] * 10, lambda p: p[3:6] != [5, 5, 5]))
    return _refilled(text, code + cipher.walk("phone", number, [10] * len(number), lambda p: (p[0] == 0) == (number[0] == 0)))


def address(cipher: Cipher, text: str) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    return ".".join(map(str, cipher.permute("address", octets, [256] * 4)))


def address6(cipher: Cipher, text: str) -> str | None:
    """All eight groups, written out; what has no digit or is no address is left alone."""
    try:
        groups = [int(x, 16) for x in ipaddress.IPv6Address(text).exploded.split(":")]
    except ValueError:
        return None
    if not re.search(r"\d", text):
        return None
    return ":".join(f"{x:x}" for x in cipher.permute("address6", groups, [1 << 16] * 8))


_EARLY, _LATE = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _moved(cipher: Cipher, day: int) -> dt.date:
    if _EARLY <= day <= _LATE:  # a domain about as large as the window keeps the walk short
        n = _LATE - _EARLY + 1
        p = cipher.walk("date", list(divmod(day - _EARLY, 271)), [271, 271], lambda p: p[0] * 271 + p[1] < n)
        return dt.date.fromordinal(_EARLY + p[0] * 271 + p[1])
    joined = lambda p: p[0] * 2000 + p[1]
    valid = lambda p: 0 < joined(p) <= dt.date.max.toordinal() and not _EARLY <= joined(p) <= _LATE
    return dt.date.fromordinal(joined(cipher.walk("other date", list(divmod(day, 2000)), [1827, 2000], valid)))


def named(cipher: Cipher, text: str) -> str | None:
    """A date with the month's English name, in full or three letters."""
    month, (day, year) = re.search("[A-Za-z]+", text)[0], re.findall(r"\d+", text)
    k = next(i for i, m in enumerate(MONTHS) if m.startswith(month))
    try:
        new = _moved(cipher, dt.date(int(year), k + 1, int(day)).toordinal())
    except ValueError:
        return None
    name = MONTHS[new.month - 1]
    out = re.sub("[A-Za-z]+", name if month == MONTHS[k] and len(month) > 3 else name[:3] if len(month) == 3 and month != "May" else name, text)
    day_at = re.search(r"\d+", out)
    out = f"{out[: day_at.start()]}{new.day}{out[day_at.end() :]}"
    return f"{out[:-4]}{new.year:04d}"


def date(cipher: Cipher, text: str) -> str | None:
    """Dates of 1900 to 2099 stay in these years, others outside them."""
    parts = [int(x) for x in re.split(r"\D", text)]
    mark = next(c for c in text if not c.isdecimal())
    orders = [(0, 1, 2)] if parts[0] > 31 or len(text.split(mark)[0]) == 4 else [(2, 1, 0), (2, 0, 1)]
    for y, m, d in orders:
        try:
            day = dt.date(parts[y], parts[m], parts[d]).toordinal()
        except ValueError:
            continue
        new = _moved(cipher, day)
        out = {y: new.year, m: new.month, d: new.day}
        widths = [len(x) for x in text.split(mark)]
        return mark.join(f"{out[i]:0{4 if i == y else widths[i] if widths[i] == 2 else 1}d}" for i in range(3))
    return None


def _alphabetic(cipher: Cipher, kind: str, text: str) -> str:
    places = [(i, c, *place) for i, c in enumerate(text) if (place := _place(c))]
    if not places:
        return text
    new = cipher.permute(kind, [v for _, _, _, v, _ in places], [n for _, _, n, _, _ in places])
    out = list(text)
    for (i, c, _, _, first), v in zip(places, new):
        out[i] = chr(first + v) if first >= 0 else _PLACE[c][0][v]
    return "".join(out)


def email(cipher: Cipher, text: str) -> str | None:
    name, _, host = text.partition("@")
    return f"{_alphabetic(cipher, 'email|' + host.lower(), name)}@{host}" if any(map(_place, name)) else None


_RULES: dict[str, Callable[[Cipher, str], str | None]] = {
    "email": email, "card": card, "account": account, "ssn": ssn, "phone": phone, "address": address, "date": date,
    "abroad": phone, "trunk": phone, "address6": address6, "named": named,
}


_KIND = {"abroad": "phone", "trunk": "phone", "address6": "address", "named": "date"}


def rewritten(cipher: Cipher, text: str) -> tuple[str, list[int]]:
    """The text with pseudonyms, and how many of each kind."""
    counts = [0] * len(KINDS)

    def replace(m: re.Match) -> str:
        new = _RULES[m.lastgroup](cipher, m.group())
        if new is None:
            return m.group()
        counts[KINDS.index(_KIND.get(m.lastgroup, m.lastgroup))] += 1
        return new

    return (_MAILED if "@" in text else _PLAIN).sub(replace, text), counts


def pseudonymised(docs: DataFrame, key: str, *, text: str = "text", found: str = "found") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a struct ``found`` of counts by kind."""
    secret = key.encode()

    def rewrite(column: pa.Array) -> pa.Array:
        cipher = Cipher(secret)
        texts, counts = [], []
        for part in blocks(pa.RecordBatch.from_arrays([column], ["text"])):
            body, rows = raw(part.column(0))
            digit = np.concatenate([[0], np.cumsum((body >= 0x30) & (body <= 0x39) | (body == 0x40))])
            for t, maybe in zip(part.column(0).to_pylist(), np.diff(digit[rows]) > 0):
                if maybe:  # what is not UTF-8 stays as it is
                    t, n = rewritten(cipher, t.decode("utf-8", "surrogateescape"))
                    t = t.encode("utf-8", "surrogateescape")
                texts.append(t)
                counts.append(n if maybe else [0] * len(KINDS))
        flat = np.array(counts, np.int64).reshape(-1, len(KINDS))
        columns = [pa.array(texts, pa.binary()), *[pa.array(np.ascontiguousarray(flat[:, k])) for k in range(len(KINDS))]]
        return pa.StructArray.from_arrays(columns, ["text", *KINDS])

    said = unused(docs, "_rewritten")
    kinds = ", ".join(f"{k}:bigint" for k in KINDS)
    out = docs.withColumn(said, F.arrow_udf(rewrite, f"struct<text:binary, {kinds}>")(F.col(text).cast("binary")))
    counts = F.struct(*[F.col(f"{said}.{k}").alias(k) for k in KINDS]).alias(found)
    return out.select(*[F.col(f"{said}.text").cast("string").alias(text) if c == text else F.col(c) for c in docs.columns], counts)
