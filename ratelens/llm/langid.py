"""Language identification by compression.

For each language a dictionary of raw text is gathered from labelled documents. A text is reduced to its lower-case letters
and single spaces, so that capitals, digits and signs say nothing, and cut into chunks; every chunk is compressed with each language's dictionary, and the language with the fewest bytes in all wins. The text is rejected if
the runner-up needs hardly more bytes, or if it has no letter at all.

Null texts and texts without a letter get `und` with score 0 and are rejected. Equal texts get equal answers; ties go to
the first language in order of name. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import ranked
from ratelens.llm.tokens import forget

#: The model's sample: so many documents per language (those with the smallest hash of their id), and of each of them at
#: most so many characters, from its middle. The only bound in this operator; prediction reads whole texts.
SAMPLE_DOCS, SAMPLE_CHARS = 600, 1000
#: Bytes compressed at a time, so that a long text is judged by the dictionaries and not by its own beginning.
CHUNK_BYTES = 4096
LEVEL = 6
#: A text is rejected if the second language needs less than this share more bytes.
MARGIN = 0.002

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case letters of a text, runs of anything else as one space."""
    return _NOT_LETTERS.sub(" ", text.lower())


def fit(labelled: DataFrame, docs: int = SAMPLE_DOCS, size: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionary of every language: middles of the sampled documents. Rows without text or label are left out."""
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    narrow = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("_order"))
    picked = ranked(narrow, ["lang"], "_order", ["doc_id"], "rank").filter(F.col("rank") < docs).select("doc_id", "lang", "rank")
    picked = F.broadcast(picked.groupBy("doc_id", "lang").agg(F.min("rank").alias("rank")))  # at most `docs` rows a language
    start = F.greatest(F.lit(1), ((F.length("text") - size) / 2).cast("int"))
    middle = rows.join(picked, ["doc_id", "lang"]).select("lang", "rank", F.substring(F.col("text"), start, F.lit(size)).alias("text"))
    sample = middle.groupBy("lang", "rank").agg(F.min("text").alias("text")).orderBy("lang", F.desc("rank")).collect()  # one text a picked id
    model: dict[str, bytes] = {}
    for r in sample:  # at most `docs` short texts a language
        model[r["lang"]] = model.get(r["lang"], b"") + letters(r["text"]).encode("utf-8", "surrogatepass") + b" "
    return model


def identify(docs: DataFrame, model: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """The rows with lang_pred, score and rejected added (input columns of these names are replaced).

    score is the share by which the runner-up is larger, 0 to 1.
    """
    names = sorted(model)
    added = [("lang_pred", pa.string()), ("score", pa.float64())]

    def run(batches):
        import zstandard

        forget()
        codecs = []
        for name in names:
            words = zstandard.ZstdCompressionDict(model[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            codecs.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False))
        for batch in batches:
            best, score = [], []
            for text in batch.column("text").to_pylist():
                if not codecs or text is None or not any(map(str.isalpha, text)):
                    best.append("und")
                    score.append(0.0)
                    continue
                raw = letters(text).encode("utf-8", "surrogatepass")
                chunks = [raw[i : i + CHUNK_BYTES] for i in range(0, len(raw), CHUNK_BYTES)]
                sizes = np.array([sum(len(c.compress(x)) for x in chunks) for c in codecs])
                order = np.argsort(sizes, kind="stable")
                best.append(names[order[0]])
                score.append(1.0 - sizes[order[0]] / sizes[order[1]] if len(sizes) > 1 else 1.0)
            cols = [pa.array(v, t) for v, (_, t) in zip((best, score), added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *[n for n, _ in added]])

    kept = docs.drop("lang_pred", "score", "rejected").withColumn("text", F.col("text").cast("string"))
    fields = [f for f in kept.schema.fields]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(run, schema).withColumn("rejected", (F.col("lang_pred") == "und") | (F.col("score") < margin))


def predict(docs: DataFrame, model: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return identify(plain, model, margin).drop("text")


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by the crc32 of the id as text (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
