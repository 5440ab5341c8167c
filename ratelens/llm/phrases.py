"""Collocations counted on a prefix-free parse.

A text is a row of words, with a full stop as the token between its pieces. Wherever the hash of a few tokens in a row is a
trigger, a chunk ends with these tokens and the next one begins with them, so that neighbours overlap by as many tokens as the
longest phrase has, less one. What is between triggers depends on the words only: passages that occur in many documents give
the same chunks. The distinct chunks and how often the parse has them are the dictionary; phrases are counted in the dictionary,
weighted. A phrase belongs to the chunk in which it starts outside the overlap at the end, so it is counted once.

Only phrases with a least count matter, and no phrase is more frequent than a part of it. So words are counted first, then pairs
of frequent words (by hash), and the dictionary is cut to stretches in which all neighbours are frequent pairs; there, phrases
of all lengths are counted as strings. A task tells frequent words and pairs by a bitmap of fixed size: where two hashes share a
bit, a rare pair may stay in a stretch, but no phrase is lost and no count changes.

Null texts are empty and have no words; a null group is `und`. Repeated rows count each. An empty table gives no rows. Columns
other than group and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.session import materialise

#: Words of the longest phrase, least count, tokens between two triggers on average.
LONGEST, LEAST, CHUNK = 5, 100, 64
#: 64-bit words of a bitmap of frequent hashes (16 MB). A parameter of memory: counts do not depend on it.
SLOTS = 1 << 21
#: Bits of a pair's hash that are added up: two pairs that share them are counted as one, which lets rare pairs through.
PAIR_BITS = 40
#: Bytes parsed at a time; longer words are hashed on their own.
GROUP_BYTES, LONG_WORD = 1 << 20, 1 << 16

_SEPARATOR = ord(".")
_CLEAN = bytes(_SEPARATOR if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

_rng = np.random.default_rng(5)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FAR = GROUP_BYTES + LONG_WORD + 1
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_FAR, _STEP))])
_BACK = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_FAR, np.uint64(pow(int(_STEP), -1, 2**64))))])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _then(h: np.ndarray, following: np.ndarray) -> np.ndarray:
    return _mix(h * _STEP + following)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the tokens data[starts : ends]."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    for low in range(0, int(starts[-1]) + 1, GROUP_BYTES):
        a, b = np.searchsorted(starts, [low, low + GROUP_BYTES])
        if a == b:
            continue
        s = starts[a:b] - low
        e = np.where(ends[a:b] - starts[a:b] > LONG_WORD, starts[a:b], ends[a:b]) - low
        part = data[low : low + int(e.max())]
        so_far = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[part] * _POWERS[: len(part)])])
        out[a:b] = _mix((so_far[e] - so_far[s]) * _BACK[s])
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def tokens(raw: bytes) -> list[bytes]:
    """Words of a text, ASCII capitals lowered, and full stops for whatever parts its pieces."""
    return raw.translate(_CLEAN).replace(b".", b" . ").split()


def _groups(texts: list[bytes]) -> Iterator[range]:
    low, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= GROUP_BYTES:
            yield range(low, i + 1)
            low, size = i + 1, 0
    if low < len(texts):
        yield range(low, len(texts))


def _chunks_of(texts: list[bytes], overlap: int, chunk: int) -> tuple[list[int], list[bytes], list[bool]]:
    """Chunks of some texts: whose it is, its tokens with blanks between, and whether it is the text's last."""
    words, ends = [], [0]
    for t in texts:
        words += tokens(t)
        ends.append(len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    begins = stops - sizes
    h = hashes(np.frombuffer(joined, np.uint8), begins, stops)
    windows = max(0, len(words) - overlap + 1)
    rolled = h[:windows]
    for k in range(1, overlap):
        rolled = _then(rolled, h[k : k + windows])
    trigger = np.zeros(len(words) + 1, bool)
    trigger[:windows] = rolled % np.uint64(chunk) == 0
    for a, b in zip(ends, ends[1:]):  # windows that begin in a text end there too; a text's first chunk needs no trigger
        trigger[max(a, b - overlap + 1) : b] = False
        trigger[a] = b > a
    first = np.flatnonzero(trigger[:-1])
    owner = np.searchsorted(np.array(ends[1:]), first, "right")
    last = np.append(owner[1:] != owner[:-1], True)[: len(first)]
    until = np.where(last, np.array(ends[1:])[owner], np.append(first[1:], 0)[: len(first)] + overlap)
    cuts = [joined[a:b] for a, b in zip(begins[first].tolist(), stops[until - 1].tolist())]
    return owner.tolist(), cuts, last.tolist()


def dictionary(docs: DataFrame, group: str = "lang", text: str = "text", overlap: int = LONGEST - 1, chunk: int = CHUNK) -> DataFrame:
    """Distinct chunks (grp, chunk, last) and n, how often the parse of all texts has them."""

    def parse(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in _groups(texts):
                owner, cuts, last = _chunks_of(texts[part.start : part.stop], overlap, chunk)
                whose = batch.column("grp").slice(part.start, len(part)).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([whose, pa.array(cuts, pa.binary()).cast(pa.string()), pa.array(last, pa.bool_())], ["grp", "chunk", "last"])

    plain = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    chunks = plain.mapInArrow(parse, "grp string, chunk string, last boolean")
    return materialise(chunks.groupBy("grp", "chunk", "last").agg(F.count(F.lit(1)).alias("n")), "chunks")


@dataclass(frozen=True)
class _Parsed:
    """The tokens of a batch of chunks."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    chunk: np.ndarray
    hash: np.ndarray
    word: np.ndarray
    owned: np.ndarray
    pair: np.ndarray

    def weights(self, batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("n").to_numpy()[self.chunk]


def _parsed(batch: pa.RecordBatch, overlap: int) -> _Parsed:
    chunks = batch.column("chunk").cast(pa.binary()).to_pylist()
    joined = b" ".join(chunks)
    data = np.frombuffer(joined, np.uint8)
    ends = np.append(np.flatnonzero(data == 0x20), len(data))
    starts = np.append(0, ends[:-1] + 1)
    begins = np.cumsum([0, *(len(c) + 1 for c in chunks)])
    chunk = np.searchsorted(begins, starts, "right") - 1
    counts = np.bincount(chunk, minlength=len(chunks))
    place = np.arange(len(starts)) - (np.cumsum(counts) - counts)[chunk]
    owned = place < counts[chunk] - np.where(np.array(batch.column("last").to_pylist(), bool), 0, overlap)[chunk]
    word = (ends - starts != 1) | (data[starts] != _SEPARATOR)
    names, which = np.unique(np.array(batch.column("grp").to_pylist(), object), return_inverse=True)
    seeds = np.array([int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "little") for g in names], np.uint64)[which]
    pair = np.zeros(len(starts), bool)
    pair[:-1] = word[:-1] & word[1:] & (chunk[:-1] == chunk[1:])
    return _Parsed(joined, starts, ends, chunk, _then(seeds[chunk], hashes(data, starts, ends)), word, owned, pair)


def _pair_keys(p: _Parsed, at: np.ndarray) -> np.ndarray:
    return _then(p.hash[at], p.hash[at + 1])


def _bit(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys % np.uint64(SLOTS)).astype(np.int64), (keys >> np.uint64(30)) % np.uint64(64)


def _bitmap(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Slots and bits of a column `key` of hashes. At most SLOTS rows come to the driver."""

    def bits(batches):
        for batch in batches:
            slot, bit = _bit(batch.column("key").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array((np.uint64(1) << bit).view(np.int64))], ["slot", "bits"])

    got = keys.select("key").mapInArrow(bits, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    return got.column("slot").to_numpy(), got.column("bits").to_numpy()


class _Filter:
    """Tells whether hashes may be in a bitmap."""

    def __init__(self, slots: np.ndarray, bits: np.ndarray):
        self.bits = np.zeros(SLOTS, np.uint64)
        self.bits[slots] = bits.view(np.uint64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot, bit = _bit(keys)
        return (self.bits[slot] >> bit) & np.uint64(1) == 1


def _words(chunks: DataFrame, overlap: int) -> DataFrame:
    """All words (grp, phrase) and how often they occur, a."""
    each = F.split("chunk", " ")
    own = F.slice(each, F.lit(1), F.size(each) - F.when(F.col("last"), 0).otherwise(overlap))
    rows = chunks.select("grp", "n", F.explode(own).alias("phrase")).filter(F.col("phrase") != ".")
    return materialise(rows.groupBy("grp", "phrase").agg(F.sum("n").alias("a")), "words")


def _frequent_pairs(chunks: DataFrame, words: tuple[np.ndarray, np.ndarray], overlap: int, least: int) -> DataFrame:
    """Hashes `key` of the pairs of frequent words that occur often enough, added up over the dictionary."""

    def run(batches):
        known = _Filter(*words)
        for batch in batches:
            if not batch.num_rows:
                continue
            p = _parsed(batch, overlap)
            often = p.word & known(p.hash)
            at = np.flatnonzero(p.pair & p.owned & often & np.append(often[1:], False))
            keys, n = _pair_keys(p, at) % np.uint64(1 << PAIR_BITS), p.weights(batch)[at]
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            sums = np.add.reduceat(n, begin) if len(begin) else n
            yield pa.RecordBatch.from_arrays([pa.array(keys[begin].view(np.int64)), pa.array(sums, pa.int64())], ["key", "n"])

    return chunks.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _stretches(chunks: DataFrame, pairs: tuple[np.ndarray, np.ndarray], overlap: int) -> DataFrame:
    """Runs of words (grp, stretch) whose neighbours are frequent pairs; phrases that start at its first `own` words are counted n times."""

    def run(batches):
        known = _Filter(*pairs)
        for batch in batches:
            if not batch.num_rows:
                continue
            p = _parsed(batch, overlap)
            good = p.pair.copy()
            at = np.flatnonzero(good)
            good[at] = known(_pair_keys(p, at))
            before = np.append(False, good[:-1])
            first, last = np.flatnonzero(good & ~before), np.flatnonzero(good & ~np.append(good[1:], False)) + 1
            own = np.append(0, np.cumsum(p.owned))
            starts_here = own[last + 1] - own[first]  # owned tokens come first in a chunk
            keep = starts_here > 0
            first, last, starts_here = first[keep], last[keep], starts_here[keep]
            text = [p.data[a:b] for a, b in zip(p.starts[first].tolist(), p.ends[last].tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("grp").take(pa.array(p.chunk[first])), pa.array(text, pa.binary()).cast(pa.string()), pa.array(starts_here, pa.int64()),
                pa.array(p.weights(batch)[first], pa.int64()),
            ], ["grp", "stretch", "own", "n"])

    rows = chunks.mapInArrow(run, "grp string, stretch string, own long, n long")
    return rows.groupBy("grp", "stretch", "own").agg(F.sum("n").alias("n"))


def _word_keys(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                one = pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("phrase"), pa.array([True] * batch.num_rows)], ["grp", "chunk", "last"])
                yield pa.RecordBatch.from_arrays([pa.array(_parsed(one, 0).hash.view(np.int64))], ["key"])

    return words.select("grp", "phrase").mapInArrow(run, "key long")


def frequent_phrases(docs: DataFrame, group: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Phrases (grp, phrase, words, a) of 1 to `longest` words that occur at least `least` times, and (grp, n): words in all."""
    if longest < 2:
        raise ValueError("longest must be 2 or more")
    overlap = longest - 1
    chunks = dictionary(docs, group, text, overlap, chunk)
    words = _words(chunks, overlap)
    totals = words.groupBy("grp").agg(F.sum("a").alias("n"))
    single = words.filter(F.col("a") >= least)
    pairs = _bitmap(_frequent_pairs(chunks, _bitmap(_word_keys(single)), overlap, least))
    cut = _stretches(chunks, pairs, overlap).withColumn("w", F.split("stretch", " "))

    def from_word(i: Column) -> Column:
        return F.transform(F.sequence(F.lit(2), F.least(F.lit(longest), F.size("w") - i)), lambda k: F.struct(k.alias("words"), F.array_join(F.slice("w", i + 1, k), " ").alias("phrase")))

    starts = F.sequence(F.lit(0), F.least(F.col("own").cast("int") - 1, F.size("w") - 2))
    each = cut.select("grp", "n", F.explode(F.flatten(F.transform(starts, from_word))).alias("p"))
    many = each.groupBy("grp", "p.phrase", "p.words").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    every = single.select("grp", "phrase", F.lit(1).alias("words"), "a").unionByName(many.select("grp", "phrase", "words", "a"))
    return materialise(every, "phrases"), totals


def collocations(
    docs: DataFrame, group: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST, absorb: int = 100, top: int = 2000, chunk: int = CHUNK
) -> DataFrame:
    """The best phrases of each group: (group), rank, phrase, a, l, r, n, score.

    A phrase of two or more words that occurs a times is cut in two parts that occur l and r times; its score is the least
    floor(1000 a n / (l r)) of its cuts. A phrase inside a longer one that occurs at least `absorb` percent as often is left out.
    """
    every, totals = frequent_phrases(docs, group, text, longest, least, chunk)
    found = every.filter(F.col("words") > 1).withColumn("w", F.split("phrase", " "))
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("w", F.lit(1), k), " ").alias("left"), F.array_join(F.slice("w", k + 1, F.col("words") - k), " ").alias("right"))))
    cuts = found.select("grp", "phrase", "a", cut.alias("c")).select("grp", "phrase", "a", "c.*")
    left = every.select("grp", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = every.select("grp", F.col("phrase").alias("right"), F.col("a").alias("r"))
    counted = cuts.join(left, ["grp", "left"]).join(right, ["grp", "right"]).join(totals, "grp")
    wide = {c: f"cast({c} as decimal(20, 0))" for c in "alrn"}  # products of two keep 38 digits
    score = F.expr(f"(({wide['a']} * {wide['n']}) * 1000) div ({wide['l']} * {wide['r']})")
    least_cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    scored = counted.groupBy("grp", "phrase", "a", "n").agg(least_cut).select("grp", "phrase", "a", "n", "best.score", "best.l", "best.r")
    # Parts of longer phrases, each with the count of the longer one that is nearest to its own.
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))))
    inside = found.filter(F.col("words") > 2).select("grp", F.col("a").alias("longer"), F.explode(parts).alias("phrase"))
    inside = inside.groupBy("grp", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, ["grp", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < absorb * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select(F.col("grp").alias(group), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
