"""In-row lookup in a small dictionary.

A literal map is scanned entry by entry, so the dictionary is split into hash buckets first:
one crc32 picks the bucket, the scan covers a handful of entries. No join, no shuffle.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lookup(entries: dict, kind: str) -> Callable[[Column], Column]:
    n = 1
    while n * 4 < len(entries):
        n *= 2
    buckets: list[dict] = [{} for _ in range(n)]
    for term, value in entries.items():
        buckets[zlib.crc32(term.encode("utf-8")) % n][term] = value
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")

    def find(token: Column) -> Column:
        slot = F.pmod(F.crc32(token), F.lit(n)).cast("int")
        return F.try_element_at(F.get(table, slot), token)

    return find


def dictionary_lookup(entries: dict[str, float]) -> Callable[[Column], Column]:
    """Return token -> value (double, null when absent) for a dictionary."""
    return _lookup({term: float(value) for term, value in entries.items()}, "double")


def text_lookup(entries: dict[str, str]) -> Callable[[Column], Column]:
    """Return token -> text (null when absent) for a dictionary."""
    return _lookup(entries, "string")


def dictionary_from(df: DataFrame, term: str, value: str) -> dict[str, float]:
    """Read a lexicon table into a dictionary. A lexicon is a user's input that does not grow with the reviews."""
    return {r[0]: float(r[1]) for r in df.select(term, value).collect()}
