"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its shape, validated (Luhn, mod 97, octets, calendar), and its variable characters are
permuted by a keyed Feistel network inside the set of valid values of that format: digits stay digits, check
digits are made anew, dates stay dates written alike (order, separators, one or two digits), separators and lengths
stay (but for addresses, whose four numbers may get longer or shorter). Long numbers that are no valid card stay
none, so that no two values share a pseudonym. Dates with slashes are read as month/day/year and, where that is no
date, as day/month/year. The permutation depends on key, kind and format only, so equal values get equal
pseudonyms in all documents and rows, and the key undoes them.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import ipaddress
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KEY_SETTING = "spark.lotmill.pii.key"  # session setting with the secret; the fallback is for tests only

RESULT = "text string, spans array<struct<kind: string, start: int, length: int>>"
CANDIDATE = r"[0-9@]|[0-9a-fA-F]{32}"

_SHAPES = re.compile(
    r"(?P<email>(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|(?P<secret>(?<![0-9A-Za-z])[0-9a-fA-F]{32,128}(?![0-9A-Za-z]))"
    r"|(?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z]))"
    r"|(?P<date>(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![\w/-]))"
    r"|(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9]))"
    r"|(?P<phone>(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![\w])"
    r"|(?<![\w+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![\w])|(?<![\w+.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\w])"
    r"|(?<![\w+.-])0[0-9]{2,4}[ /-][0-9]{5,8}(?![\w]))"
    r"|(?P<ssn>(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<number>(?<![\w.+-])(?:[0-9]{12,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,3})?)(?![\w]))", re.ASCII)  # fmt: skip
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # up to the end of 2099


def permute(x: int, n: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """Keyed permutation of 0 .. n - 1: a Feistel network on two halves a x b >= n, walked until it is inside."""
    if n < 2:
        return x
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)

    def f(i: int, half: int, most: int) -> int:
        data = f"{tweak}|{n}|{i}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=32).digest()) % most if n < 1 << 200 else int.from_bytes(hashlib.shake_256(key + data).digest(n.bit_length() // 8 + 16)) % most

    while True:
        left, right = divmod(x, b)
        for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            sign = -1 if inverse else 1
            if i % 2:
                right = (right + sign * f(i, left, b)) % b
            else:
                left = (left + sign * f(i, right, a)) % a
        x = left * b + right
        if x < n:
            return x


def _permute_symbols(value: str, alphabets: list[str], key: bytes, tweak: str, inverse: bool) -> str:
    """Permute a string whose i-th character is one of ``alphabets[i]``."""
    x = 0
    for c, alphabet in zip(value, alphabets, strict=True):
        x = x * len(alphabet) + alphabet.index(c)
    x = permute(x, math.prod(map(len, alphabets)), key, tweak, inverse)
    out = []
    for alphabet in reversed(alphabets):
        x, c = divmod(x, len(alphabet))
        out.append(alphabet[c])
    return "".join(reversed(out))


_DIGITS, _LOWER, _UPPER, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def _chars(value: str, key: bytes, tweak: str, inverse: bool, hexadecimal: bool = False) -> str:
    """Permute letters and digits of a string inside their class; all other characters stay."""
    classes = [_HEX if hexadecimal and c in _HEX else _DIGITS if c in _DIGITS else _LOWER if c in _LOWER else _UPPER if c in _UPPER else c for c in value]
    return _permute_symbols(value, classes, key, tweak, inverse)


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` + it valid."""
    total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(digits)))
    return -total % 10


def _iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in f"{body}{country}00")
    return f"{98 - int(number) % 97:02d}"


def _refill(shape: str, symbols: str) -> str:
    """Put new symbols where ``shape`` has letters or digits."""
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def classify(kind: str, value: str) -> str | None:
    """The kind of a value after validation, or None if it is none."""
    bare = re.sub(r"[ -]", "", value)
    if kind == "ip":
        try:
            return "ip" if ipaddress.ip_address(value) else None
        except ValueError:
            return None
    if kind == "date":
        return "date" if _dated(value) is not None else None
    if kind == "iban":
        return "iban" if 15 <= len(bare) <= 34 and _iban_check(bare[:2], bare[4:]) == bare[2:4] else None
    if kind == "ssn":
        return "ssn" if value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00" and value[7:] != "0000" else None
    if kind == "number":
        return "card" if 13 <= len(bare) <= 19 and luhn(bare[:-1]) == int(bare[-1]) else "account"
    if kind == "phone":
        return "phone" if 7 <= len(re.sub(r"\D", "", value)) <= 15 else None
    if kind == "secret":
        return "secret" if re.search(r"[0-9]", value) and (value == value.lower() or value == value.upper()) else None
    return kind


def _read(value: str, order: str) -> int | None:
    """The day number of a date whose parts are in ``order`` (of y, m, d), or None if it is none."""
    parts = dict(zip(order, map(int, re.split(r"[-./]", value)), strict=True))
    try:
        day = datetime.date(parts["y"], parts["m"], parts["d"]).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    return day if 0 <= day < _DAYS else None


def _dated(value: str) -> tuple[int, str] | None:
    """Day number and order of the parts; dates with slashes are month first wherever that is a date."""
    orders = ("ymd",) if "-" in value else ("dmy",) if "." in value else ("mdy", "dmy")
    return next(((day, order) for order in orders if (day := _read(value, order)) is not None), None)


def _written(day: int, order: str, shape: str) -> str:
    """The date in the order, separators and (at least) the widths of ``shape``."""
    date = datetime.date.fromordinal(day + _FIRST_DAY)
    parts = iter((date.year, date.month, date.day)["ymd".index(c)] for c in order)
    return re.sub(r"[0-9]+", lambda m: f"{next(parts):0{len(m.group())}d}", shape)


def _new_date(value: str, key: bytes, inverse: bool) -> str:
    """Walks the permutation of all days until the date is written in the same shape and read in the same order."""
    day, order = _dated(value)
    shape = re.sub(r"[0-9]", "0", value)
    full = shape in ("0000-00-00", "00.00.0000", "00/00/0000") and (order != "dmy" or "." in value)
    tweak = "date" if full else f"date|{order}|{shape}"
    while True:
        day = permute(day, _DAYS, key, tweak, inverse)
        new = _written(day, order, shape)
        if len(new) == len(shape) and re.sub(r"[0-9]", "0", new) == shape and _dated(new) == (day, order):
            return new


def pseudonym(kind: str, value: str, key: bytes, inverse: bool = False) -> str:
    """The pseudonym of a validated value (or, with ``inverse``, the value of a pseudonym)."""
    bare = re.sub(r"[^0-9A-Za-z]", "", value)
    tweak = f"{kind}|{len(bare)}"
    if kind == "date":
        return _new_date(value, key, inverse)
    if kind == "ip":
        return str(ipaddress.ip_address(permute(int(ipaddress.ip_address(value)), 1 << 32, key, "ip", inverse)))
    if kind == "card":
        new = _chars(bare[:-1], key, tweak, inverse)
        return _refill(value, new + str(luhn(new)))
    if kind == "iban":
        new = _chars(bare[4:], key, tweak + bare[:2], inverse)
        return _refill(value, bare[:2] + _iban_check(bare[:2], new) + new)
    if kind == "ssn":
        x = (int(bare[:3]) - 1 - (int(bare[:3]) > 666)) * 99 * 9999 + (int(bare[3:5]) - 1) * 9999 + int(bare[5:]) - 1
        x = permute(x, 898 * 99 * 9999, key, "ssn", inverse)
        area = x // (99 * 9999) + 1
        return f"{area + (area >= 666):03d}-{x // 9999 % 99 + 1:02d}-{x % 9999 + 1:04d}"
    if kind == "phone":
        lead = re.match(r"\+[0-9]{1,3}(?=[ .(-])", value)
        lead = lead.group() if lead else "0" if re.fullmatch(r"0[0-9]{2,4}[ /-][0-9]{5,8}", value) else ""
        return lead + _refill(value[len(lead):], _chars(re.sub(r"\D", "", value[len(lead):]), key, f"phone|{lead}", inverse))
    if kind == "email":
        local, _, domain = value.partition("@")
        return f"{_chars(local, key, f'email|{domain}', inverse)}@{domain}"
    if kind == "secret":
        new = _chars(value.lower(), key, tweak, inverse, hexadecimal=True)
        return new if value == value.lower() else new.upper()
    while True:  # an account stays outside the numbers that cards are permuted in
        bare = _chars(bare, key, tweak, inverse)
        if kind != "account" or classify("number", bare) == "account":
            return _refill(value, bare)


@functools.lru_cache(100_000)
def _cached(kind: str, value: str, key: bytes) -> str:
    return pseudonym(kind, value, key)


def replace(text: str, key: bytes) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and kind, start and length of each in the new text."""
    out, spans, at, size = [], [], 0, 0
    for m in _SHAPES.finditer(text):
        kind = classify(m.lastgroup, m.group())
        if kind:
            new = _cached(kind, m.group(), key)
            out += [text[at:m.start()], new]
            size += m.start() - at
            spans.append({"kind": kind, "start": size, "length": len(new)})
            size += len(new)
            at = m.end()
    return "".join([*out, text[at:]]), spans


def secret_key(spark) -> bytes:
    return spark.conf.get(KEY_SETTING, "only for tests").encode()


def pseudonymised(text: Column, key: bytes) -> Column:
    """Struct (text, spans): null text gives null text and no spans; texts without a candidate skip Python."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(None, []) if t is None or t != t else replace(t, key) for t in batch], columns=["text", "spans"])

    found = F.pandas_udf(run, RESULT)(F.when(text.rlike(CANDIDATE), text))
    return F.struct(F.coalesce(found["text"], text).alias("text"), found["spans"].alias("spans"))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; with ``spans_col`` also what was replaced (an existing column of
    that name is replaced). Row count, order of columns and all other columns stay; null and empty texts stay."""
    rest = docs.drop(spans_col) if spans_col else docs
    rows = rest.select(F.struct("*").alias("_row"), pseudonymised(F.col(text_col).cast("string"), key).alias("_new"))
    columns = [F.col("_new.text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in rest.columns]
    return rows.select(*columns, *([F.col("_new.spans").alias(spans_col)] if spans_col else []))
