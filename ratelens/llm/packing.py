"""Best-fit packing planned over the histogram of lengths.

Texts become token ids with an end id; longer ones are cut into pieces of `capacity` tokens. How many pieces there are of
each length is all that best-fit needs: it runs over counts on the driver (at most `capacity` of them) and yields blocks of
planned slots, each for the pieces of one length with ranks from a to b. Pieces are then ranked within their length and
take the slots of their rank.

With `order`, two columns of the input (a group that sorts, such as a file, and a row number in it), pieces of one length are
ranked in that order and sequences are numbered by their first piece. Without it the order is that of a hash.

A null text is an empty one: its only token is the end id. Equal rows are packed each. An empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import ranked
from ratelens.llm.tokens import crc32_of, encoder
from ratelens.session import materialise

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
#: Ranks within one length stay below this, so that (length, rank) fits one sortable number.
_RANKS = 1 << 44


@dataclass(frozen=True)
class Plan:
    """Blocks of slots, sorted by (length, first rank): rank r of a block goes to sequence base + (r - first) % width."""

    keys: np.ndarray
    widths: np.ndarray
    bases: np.ndarray
    offsets: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length * _RANKS + rank
        at = np.searchsorted(self.keys, key, "right") - 1
        turn = key - self.keys[at]
        return self.bases[at] + turn % self.widths[at], self.offsets[at] + turn // self.widths[at] * length


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over lengths: pieces go where the least room is left that still holds them.

    Sequences with equal content are one group (how many, what they hold), and a group is split when only some of its
    members get a piece. So the work and the plan depend on the number of lengths and not of pieces.
    """
    groups: dict[int, list[tuple[int, tuple]]] = {}  # room left -> [(number of sequences, ((length, copies), ...))]
    rooms = 0  # bit r: some group has r tokens of room left

    def put(room: int, n: int, content: tuple) -> None:
        nonlocal rooms
        if n:
            groups.setdefault(room, []).append((n, content))
            rooms |= 1 << room

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                n, content = groups[room].pop()
                if not groups[room]:
                    rooms &= ~(1 << room)
            else:
                room, content = capacity, ()
                n = -(-left // (capacity // length))
            most = room // length
            full = min(n, left // most)
            put(room - most * length, full, (*content, (length, most)))
            left -= full * most
            n -= full
            if left and n:
                put(room - left * length, 1, (*content, (length, left)))
                left, n = 0, n - 1
            if content:
                put(room, n, content)
    blocks, base, ranks = [], 0, dict.fromkeys(counts, 0)
    for room in sorted(groups):
        for n, content in groups[room]:
            offset = 0
            for length, copies in content:
                blocks.append((length * _RANKS + ranks[length], n, base, offset))
                ranks[length] += n * copies
                offset += length * copies
            base += n
    blocks.sort()
    cols = np.array(blocks, np.int64).reshape(-1, 4).T
    return Plan(*(np.ascontiguousarray(c) for c in cols), sequences=base)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, order: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per piece: where it starts in its document's ids, how long it is, and the crc32 of its ids.

    `order` adds its columns as `file` and `row`.
    """
    more = [] if order is None else [("file", pa.string()), ("row", pa.int64())]
    schema = pa.schema([*_PIECES, *more])

    def cut(batches):
        codec = encoder(tokenizer)
        for batch in batches:
            owner, cols = [], ([], [], [], [])
            for k, ids in enumerate(codec.encode_all(batch.column("text").to_pylist())):
                ids = np.append(ids, np.uint32(end_id))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    owner.append(k)
                    for col, v in zip(cols, (piece, start, len(part), crc32_of(part))):
                        col.append(v)
            taken = batch.column("doc_id").take(pa.array(owner, pa.int64()))
            kept = [batch.column(name).take(pa.array(owner, pa.int64())).cast(kind) for name, kind in more]
            yield pa.RecordBatch.from_arrays([taken, *(pa.array(c, f.type) for c, f in zip(cols, list(_PIECES)[1:])), *kept], schema=schema)

    place = [] if order is None else [order[0].cast("string").alias("file"), order[1].cast("long").alias("row")]
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *place)
    return plain.mapInArrow(cut, PIECES if order is None else f"{PIECES}, file string, row long")


def _positions(cut: DataFrame) -> DataFrame:
    """Add `_at`, the number of a piece's row over all files, and `_key`, which spreads it over the 64-bit numbers."""
    files = sorted((r["file"], r["n"]) for r in cut.groupBy("file").agg((F.max("row") + 1).alias("n")).collect())  # one row a file
    starts, total = [], 0
    for name, n in files:
        starts.append((name, total))
        total += n
    at = F.broadcast(cut.sparkSession.createDataFrame(starts, "file string, _start long"))
    spread = (F.col("_at") / F.lit(max(total, 1)) * F.lit(2.0**64) - F.lit(2.0**63)).cast("long")
    return cut.join(at, "file").withColumn("_at", F.col("_start") + F.col("row")).withColumn("_key", spread).drop("file", "row", "_start")


def _numbered(placed: DataFrame) -> DataFrame:
    """Sequences numbered by their first piece in order."""
    first = placed.groupBy("sequence_id").agg(F.min(F.struct("_key", "_at", "piece", "doc_id", "ids_crc32")).alias("f"))
    ranks = ranked(first.select("sequence_id", "f.*", F.lit(0).alias("_all")), ["_all"], "_key", ["_at", "piece", "sequence_id"], "_number")
    return placed.join(ranks.select("sequence_id", "_number"), "sequence_id").select(*_PIECES.names, F.col("_number").cast("long").alias("sequence_id"), "offset")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, order: tuple[Column, Column] | None = None) -> DataFrame:
    """All pieces with `sequence_id` and `offset`: gapless sequences of at most `capacity` tokens, as few as best-fit gives."""
    cut = materialise(pieces(docs, tokenizer, end_id, capacity, order), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    plan = best_fit(counts, capacity)
    if order is None:
        keyed, ties = cut.withColumn("_key", F.xxhash64("doc_id", "piece")), ["doc_id", "piece", "ids_crc32"]
    else:
        keyed, ties = _positions(cut), ["_at", "piece"]
    ranks = ranked(keyed, ["length"], "_key", ties, "_rank")
    ranks = ranks.drop("_key") if order is None else ranks
    kept = [] if order is None else [("_at", pa.int64()), ("_key", pa.int64())]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = plan.place(length, rank) if len(length) else (length, length)
            cols = [batch.column(name) for name in (*_PIECES.names, *(name for name, _ in kept))]
            names = [*_PIECES.names, *(name for name, _ in kept), "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names)

    placed = ranks.mapInArrow(place, f"{PIECES}{''.join(f', {name} long' for name, _ in kept)}, sequence_id long, offset long")
    return placed if order is None else _numbered(placed)
