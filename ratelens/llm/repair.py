"""Token ids in grammar-compressed files (Re-Pair), readable from any document on.

Documents are put in ascending order of `doc_id` and cut into shards of whole documents. In each shard, frequent pairs of
neighbouring ids are replaced by new symbols, again and again, until no pair repeats or the two-byte symbols are used up; a
pair never reaches over the end of a document. A round takes the pairs at least a 32nd as frequent as the most frequent
one, chosen so that no id is the first of one pair and the second of another (a pair of equal ids has its id for
itself and is counted and replaced from the left of a run on): their places never overlap, so it is the same as one
replacement after the other. A shard's row keeps the rules (left, right, length when expanded), the symbols and how many ids
and symbols each document has. Lengths tell where every symbol's ids go, so that one document is decoded from its own symbols
and the rules that they use.

A null text is an empty one: its only id is the end id. Rows with equal or null ids are kept each (null first). An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelens.llm.tokens import crc32_of, encoder

#: Ids per shard, about: a shard is closed by the document that reaches it.
SHARD_IDS = 1_000_000
#: First new symbol; ids of the tokenizer are below.
BASE = 49_408
#: Symbols that two bytes can tell apart: rules stop there.
SYMBOLS = 1 << 16
#: A round takes pairs at least one part in so many as frequent as the most frequent one.
NEAR_TOP = 32
#: A rule as it is stored.
RULE = np.dtype([("left", "<u2"), ("right", "<u2"), ("length", "<u4")])

SHARDS = "part int, shard int, doc_ids array<long>, doc_tokens array<long>, doc_symbols array<long>, n_tokens long, rules binary, symbols binary"
_SHARDS = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("doc_symbols", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("rules", pa.binary()), ("symbols", pa.binary()),
])


def pair_places(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the places of all pairs within documents. In a run of equal ids, every second one from its start."""
    inside = np.ones(len(ids), bool)
    inside[ends] = False
    inside = inside[:-1]
    equal = np.flatnonzero(inside & (ids[:-1] == ids[1:]))
    if len(equal):
        k = np.arange(len(equal))
        begins = np.concatenate([[True], equal[1:] != equal[:-1] + 1])
        inside[equal[(k - np.maximum.accumulate(np.where(begins, k, 0))) % 2 == 1]] = False
    return inside


def frequent_pairs(keys: np.ndarray, room: int) -> list[tuple[int, int]]:
    """Pairs (as two bytes and two bytes) that repeat, none of which can overlap another. Ties go to the smaller ids."""
    ordered = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    n = np.diff(np.append(at, len(ordered)))
    often = np.flatnonzero(n >= max(2, int(n.max()) // NEAR_TOP))
    often = often[np.argsort(-n[often], kind="stable")]
    firsts, seconds, doubles, out = set(), set(), set(), []
    for key in ordered[at[often]].tolist():
        a, b = divmod(key, SYMBOLS)
        if a in seconds or b in firsts or a in doubles or b in doubles or (a == b and (a in firsts or b in seconds)):
            continue
        if a == b:
            doubles.add(a)
        else:
            firsts.add(a)
            seconds.add(b)
        out.append((a, b))
        if len(out) == room:
            break
    return out


def compress(ids: np.ndarray, ends: np.ndarray, base: int = BASE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, ends and rules (left, right, length). ends: places of the last id of each document, in order."""
    rules: list[tuple[int, int, int]] = []
    length = np.ones(SYMBOLS, np.int64)
    ids = ids.astype(np.uint16)
    while base + len(rules) < SYMBOLS:
        inside = pair_places(ids, ends)
        keys = (ids[:-1].astype(np.uint32) << 16) | ids[1:]
        pairs = frequent_pairs(keys[inside], SYMBOLS - base - len(rules)) if inside.any() else []
        if not pairs:
            break
        chosen = np.array(pairs, np.uint32)
        left, right = np.zeros(SYMBOLS, bool), np.zeros(SYMBOLS, bool)
        left[chosen[:, 0]], right[chosen[:, 1]] = True, True
        places = np.flatnonzero(left[ids[:-1]] & right[ids[1:]] & inside)
        wanted = (chosen[:, 0] << 16) | chosen[:, 1]
        order = np.argsort(wanted)
        found = np.minimum(np.searchsorted(wanted[order], keys[places]), len(wanted) - 1)
        hit = wanted[order][found] == keys[places]
        places, found = places[hit], found[hit]
        new = base + len(rules) + order[found]
        for a, b in pairs:
            k = base + len(rules)
            length[k] = length[a] + length[b]
            rules.append((a, b, int(length[k])))
        ids[places] = new
        ids = np.delete(ids, places + 1)
        ends = ends - np.searchsorted(places + 1, ends, "right")
    return ids, ends, np.array(rules, RULE)


class Decoder:
    """Expands symbols of one shard."""

    def __init__(self, rules: np.ndarray, base: int = BASE):
        self.base, self.left, self.right = base, rules["left"], rules["right"]
        self.sizes = np.concatenate([np.ones(base, np.int64), rules["length"].astype(np.int64)])

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of the symbols. Each symbol's place is known from the lengths; only rules that occur are looked at."""
        sizes = self.sizes[symbols]
        at = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.uint32)
        while len(symbols):
            rule = symbols >= self.base
            out[at[~rule]] = symbols[~rule]
            at, k = at[rule], symbols[rule].astype(np.int64) - self.base
            left, right = self.left[k], self.right[k]
            at = np.concatenate([at, at + self.sizes[left]])
            symbols = np.concatenate([left, right])
        return out


def decode_document(row: dict, k: int) -> np.ndarray:
    """Ids of document k of a shard's row, from its own symbols and the rules that they use."""
    rules, symbols = np.frombuffer(row["rules"], RULE), np.frombuffer(row["symbols"], "<u2")
    start = sum(row["doc_symbols"][:k])
    return Decoder(rules)(symbols[start : start + row["doc_symbols"][k]])


def _shard(part: int, shard: int, doc_ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
    tokens = np.array([len(t) for t in texts], np.int64)
    symbols, ends, rules = compress(np.concatenate(texts), np.cumsum(tokens) - 1)
    per_doc = np.diff(ends, prepend=-1)
    return pa.RecordBatch.from_pydict({
        "part": [part], "shard": [shard], "doc_ids": [doc_ids], "doc_tokens": [tokens.tolist()], "doc_symbols": [per_doc.tolist()],
        "n_tokens": [int(tokens.sum())], "rules": [rules.tobytes()], "symbols": [symbols.astype("<u2").tobytes()],
    }, schema=_SHARDS)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encode every text, append the end id and write the compressed shards in ascending order of doc_id.

    Symbols are two bytes each: ids and rules together stay under 65,536.
    """

    def encode(batches):
        codec, part, shard = encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, texts, total = [], [], 0
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), codec.encode_all(batch.column("text").to_pylist())):
                doc_ids.append(doc)
                texts.append(np.append(ids, np.uint32(end_id)))
                total += len(texts[-1])
                if total >= SHARD_IDS:
                    yield _shard(part, shard, doc_ids, texts)
                    shard, doc_ids, texts, total = shard + 1, [], [], 0
        if doc_ids:
            yield _shard(part, shard, doc_ids, texts)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(encode, SHARDS).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents read back from the files: doc_id, start (ids before it in the whole order), n_tokens, ids_crc32."""
    files = spark.read.schema(SHARDS).parquet(path)
    one = "part int, shard int, doc_id long, before long, n_tokens long, ids_crc32 long"

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = Decoder(np.frombuffer(row["rules"], RULE))(np.frombuffer(row["symbols"], "<u2"))
                n = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), row["part"]), pa.int32()), pa.array(np.full(len(n), row["shard"]), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(ends - n), pa.array(n),
                    pa.array([crc32_of(ids[a:b]) for a, b in zip(ends - n, ends)], pa.int64()),
                ], ["part", "shard", "doc_id", "before", "n_tokens", "ids_crc32"])

    sizes = files.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # one row per partition that was written
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("part").alias("_p"), F.col("shard").alias("_s"), F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_shard_start"))
    starts = starts.join(parts, F.col("_p") == F.col("_part"))
    docs = files.mapInArrow(decode, one).join(starts, (F.col("part") == F.col("_p")) & (F.col("shard") == F.col("_s")))
    return docs.select("doc_id", (F.col("_part_start") + F.col("_shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
