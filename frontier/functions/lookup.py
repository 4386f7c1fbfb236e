"""Bounded lookup tables inside a plan, and character references.

A table travels as one folded literal, an array of small maps: the bucket of a key is one
CRC, and a probe compares the few keys of that bucket, whatever the size of the table."""

from __future__ import annotations

import html
import json
import zlib
from collections.abc import Mapping
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable
    (keeps large sub-expressions from being copied into every reference)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.element_at(F.transform(F.array(value), body), 1)


class LookupTable:
    """String keys to values of one SQL type, for use in Column expressions."""

    KEYS_PER_BUCKET = 6

    def __init__(self, entries: Mapping[str, object], value_type: str):
        self.buckets = 1 << max(0, (len(entries) // self.KEYS_PER_BUCKET).bit_length())
        maps: list[dict[str, object]] = [{} for _ in range(self.buckets)]
        for key, value in entries.items():
            maps[zlib.crc32(key.encode()) % self.buckets][key] = value
        self._json, self._type = json.dumps(maps), f"array<map<string,{value_type}>>"

    def table(self) -> Column:
        """The whole table, for :func:`let` where it is probed more than once."""
        return F.from_json(F.lit(self._json), self._type)

    def get(self, key: Column, table: Column | None = None) -> Column:
        """The value of ``key``, NULL if it isn't in the table."""
        table = self.table() if table is None else table
        bucket = (F.pmod(F.crc32(key.cast("binary")), F.lit(self.buckets)) + 1).cast("int")
        return F.try_element_at(F.try_element_at(table, bucket), key)


@lru_cache(maxsize=1)
def _names() -> LookupTable:
    return LookupTable(html5, "string")


@lru_cache(maxsize=1)
def _replaced() -> LookupTable:
    """Numbers that the HTML standard reads as another character, by the standard library's rule."""
    odd = {str(n): html.unescape(f"&#{n};") for n in range(0x80, 0xA0)}
    return LookupTable({n: c for n, c in odd.items() if c != chr(int(n))}, "string")


_NUMBER = r"&#(?:[0-9]{1,9}|[xX][0-9a-fA-F]{1,7});?"
#: In text a name may lack its semicolon; in an attribute it then must not go on with a
#: letter, a digit or "=" (a query such as ``?a=1&copy=2`` stays as it is).
_TEXT_REF = rf"{_NUMBER}|&[A-Za-z][A-Za-z0-9]*+;?"
_ATTRIBUTE_REF = rf"{_NUMBER}|&[A-Za-z][A-Za-z0-9]*+(?:;|(?![=A-Za-z0-9]))"
_LONGEST_BARE_NAME = max(len(k) for k in html5 if not k.endswith(";"))


def _number_char(ref: Column) -> Column:
    digits = F.regexp_extract(ref, r"^&#([xX]?[0-9a-fA-F]+)", 1)
    code = F.when(F.lower(digits).startswith("x"), F.conv(F.substring(digits, 2, 16), 16, 10)).otherwise(digits).cast("bigint")

    def body(n):
        bad = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(bad, F.lit("�")).otherwise(F.coalesce(_replaced().get(n.cast("string")), char))

    return let(code, body)


def _decode(ref: Column) -> Column:
    name = F.substring(ref, 2, 64)

    def named(table: Column) -> Column:
        """The whole name, else the longest beginning that is a name without semicolon, then what follows it."""
        tries = [F.concat(_names().get(F.substring(name, 1, k), table), F.substring(name, k + 1, 64)) for k in range(_LONGEST_BARE_NAME, 1, -1)]
        return F.coalesce(_names().get(name, table), *tries, ref)

    return F.when(ref.startswith("&#"), _number_char(ref)).otherwise(let(_names().table(), named))


def html_unescape(text, attribute: bool = False) -> Column:
    """Decode all character references, numeric and named, as HTML does."""
    text = F.col(text) if isinstance(text, str) else text
    pattern = _ATTRIBUTE_REF if attribute else _TEXT_REF

    def body(t):
        refs = F.transform(F.regexp_extract_all(t, F.lit(pattern), 0), lambda r: let(r, _decode))
        both = F.arrays_zip(F.split(t, pattern).alias("p"), refs.alias("r"))
        return F.array_join(F.transform(both, lambda z: F.concat(F.coalesce(z["p"], F.lit("")), F.coalesce(z["r"], F.lit("")))), "")

    return let(text, lambda t: F.when(t.contains("&"), body(t)).otherwise(t))
