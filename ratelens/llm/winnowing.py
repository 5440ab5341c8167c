"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; of each window of `window` hashes the smallest is chosen, the rightmost
of equals, and kept with its position. Two texts that share k + window - 1 code points in a row share a chosen hash.
A text shorter than k is one gram; an empty or null text has the empty fingerprint. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points per gram and grams per window, both powers of two: a shared passage of 23 code points is always seen, and about
#: two hashes of nine are kept, so that short texts have enough of them to be compared.
GRAM, WINDOW = 16, 8
_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Fingerprint:
    hashes: np.ndarray
    positions: np.ndarray

    def text(self) -> str:
        """The chosen hashes in order of position, eight hex digits each."""
        return self.hashes.astype(">u4").tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        """Share of the distinct chosen hashes that both have; 1 for two empty fingerprints."""
        a, b = np.unique(self.hashes), np.unique(other.hashes)
        if not len(a) and not len(b):
            return 1.0
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both / (len(a) + len(b) - both)


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> Fingerprint:
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return Fingerprint(np.zeros(0, np.uint32), np.zeros(0, np.int64))
    h = points.astype(np.uint64) + np.uint64(1)
    size, factor = 1, _STEP
    while size < gram and size < len(h):  # a gram of 2n is two grams of n
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = size * 2, factor * factor % 2**64
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    # Hash above, distance to the end below: the minimum is the smallest hash and, of equals, the rightmost.
    key = (h & ~_LOW) | np.arange(len(h) - 1, -1, -1, dtype=np.uint64)
    size = 1
    while size < window and len(key) > size:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    chosen = key[np.concatenate([[True], key[1:] != key[:-1]])] if size >= window else np.array([key.min()])
    return Fingerprint((chosen >> np.uint64(32)).astype(np.uint32), len(h) - 1 - (chosen & _LOW).astype(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, hashes and positions of every text. Other columns are ignored."""

    def run(batches):
        for batch in batches:
            prints = [winnow(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([p.hashes.astype(np.int64) for p in prints], pa.list_(pa.int64())),
                pa.array([p.positions for p in prints], pa.list_(pa.int64())),
            ], ["doc_id", "hashes", "positions"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


def _edges(docs: DataFrame, parts: int) -> tuple[list[int], dict[int, int]]:
    """Cuts of the doc_id range, and for the largest id of each part the part above it (of the highest: the lowest)."""
    q = docs.agg(F.percentile_approx("doc_id", [(i + 1) / parts for i in range(parts - 1)] or [1.0], 10_000)).first()[0] or []
    cuts = sorted(set(q[: parts - 1]))
    tops = docs.groupBy(_part(cuts).alias("part")).agg(F.max("doc_id").alias("top")).orderBy("part").collect()  # one row a part
    return cuts, {r["top"]: tops[(i + 1) % len(tops)]["part"] for i, r in enumerate(tops)}


def _part(cuts: list[int]) -> Column:
    at = F.expr(f"array({', '.join(f'{c}L' for c in cuts)})") if cuts else F.array().cast("array<bigint>")
    return F.size(F.filter(at, lambda c: c < F.col("doc_id"))).cast("int")


def with_next(docs: DataFrame, parts: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows dealt into `parts` ranges of doc_id, each sorted downwards; the first row of a lower range follows its last."""
    cuts, above = _edges(docs.select("doc_id"), parts)
    part = _part(cuts)
    tops = F.expr(f"map({', '.join(f'{k}L, {v}' for k, v in above.items())})") if above else F.create_map().cast("map<bigint,int>")
    lent = F.try_element_at(tops, F.col("doc_id"))
    both = F.array(F.struct(part.alias("part"), F.lit(False).alias("lent")), F.struct(lent.alias("part"), F.lit(True).alias("lent")))
    spread = docs.select("doc_id", "text", F.inline(F.when(lent.isNull(), F.slice(both, 1, 1)).otherwise(both)))
    return spread.repartition(len(cuts) + 1, "part").sortWithinPartitions("part", "lent", F.desc("doc_id"), "text"), above


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
          "near_next double, n_hashes int")
_EDITED = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_hashes", pa.int32()),
])


def edited_fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint of every text, of the text with its last third overwritten by the start of the next one, and likenesses.

    Next is the following row in descending order of doc_id (null ids go last), after the last one the first. Texts are
    shuffled once, into ranges of doc_id that are streamed row by row; only the top row of each range goes to two ranges.
    """
    plain = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread, _ = with_next(plain, parts)

    def pairs(batches) -> Iterator[tuple]:
        held = None
        for batch in batches:
            for part, lent, doc, text in zip(*(batch.column(c).to_pylist() for c in ("part", "lent", "doc_id", "text"))):
                now = (part, lent, doc, text, winnow(text))
                if held and held[0] == part and not held[1]:
                    yield held, now
                held = now if not (lent and held and held[0] == part and held[1]) else held

    def run(batches):
        rows = []
        for (_, _, doc, text, own), (_, _, _, after, other) in pairs(batches):
            cut = len(text) // 3
            edited = text[: len(text) - cut] + after[:cut]
            print_ = winnow(edited)
            rows.append((doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.text(), print_.text(),
                         own.likeness(print_), own.likeness(other), len(own.hashes)))
            if len(rows) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _EDITED)], schema=_EDITED)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _EDITED)], schema=_EDITED)

    out = spread.mapInArrow(run, EDITED)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(2**63)), F.col("doc_id")))
