"""Registered queries of the corpus operators, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import chat, chosen_path, content_sort, langid, mixing, multi_index, packing, phrases, pii, repair, sharding, turn_repair, winnowing
from ratelens.llm.common import table
from ratelens.session import scratch_path

#: Key of the surrogates; a deployment sets its own.
PII_KEY = "replace-in-deployment"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            CHECK_SQL[fn.__name__] = sql
        return fn

    return register


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op1_chosen_path_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are alike by 85 %."""
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query()
def op2_pfair_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's turn in a mixture in which sources weigh as the square root of their size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.balanced_weights(docs), seed=2)


@query()
def op3_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as ids in grammar-compressed files, read back."""
    path = scratch_path(spark, "token-files")
    repair.write_shards(table(spark, sf_dir, "documents"), path, word_bpe(), end_id=1)
    return repair.read_documents(spark, path)


@query()
def op4_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product of every twentieth vector."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)


@query()
def op5_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.filter(~held))
    found = langid.predict(docs, model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op6_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 2048 tokens as best-fit needs."""
    return packing.pack(table(spark, sf_dir, "documents"), word_bpe(), end_id=0, capacity=2048)


@query()
def op7_matrix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled uniformly into 40 shards whose row counts are at most one apart."""
    path = scratch_path(spark, "shards")
    sharding.write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), path, 40, seed=7)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size, crc = (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    return sharding.read_shards(spark, path).select("doc_id", size, crc, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, key=PII_KEY)


def _chat_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    controls = ", ".join(quoted(c) for c in chat.CONTROL)
    escaped = "replace(text, '\\', '\\\\')"
    for c in chat.CONTROL:
        escaped = f"replace({escaped}, {quoted(c)}, {quoted(c[0] + chr(92) + c[1:])})"
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, len(list_filter([{controls}], lambda c: contains(text, c))) > 0 AS held, {escaped} AS changed FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(chat.START) + 1 + len(chat.END)} + length(role) + CASE WHEN held THEN {len(chat.ESCAPED)} + length(changed) ELSE length(text) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query(_chat_sql())
def op9_grammar_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what is read back from the formatted text."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(talk.unionByName(own))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.under_mask(F.col("formatted"), chat.loss_mask(F.col("turns")))
    read = done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), loss.alias("loss"), "formatted")
    return read.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op10_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike they are."""
    return winnowing.edited_fingerprints(table(spark, sf_dir, "documents"))


def _phrases_sql(longest: int = 5) -> str:
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT grp, {k} AS words, array_to_string(w[i:i+{k - 1}], ' ') AS phrase FROM (SELECT grp, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})"
        for k in range(1, longest + 1)
    )
    return f"""
WITH pieces AS (
  SELECT grp, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS grp, unnest(string_split_regex(translate(coalesce(text, ''), '{capitals}', '{small}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)
), counts AS (
  SELECT grp, words, phrase, count(*) AS a FROM ({grams}) GROUP BY ALL
), totals AS (SELECT grp, sum(a) AS n FROM counts WHERE words = 1 GROUP BY grp
), often AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE a >= 100
), cuts AS (SELECT grp, phrase, a, w, unnest(range(1, words)) AS k FROM often WHERE words > 1
), scored AS (
  SELECT c.grp, c.phrase, c.a, n, k, l.a AS l, r.a AS r,
    (1000::HUGEINT * c.a::HUGEINT * n::HUGEINT) // (l.a::HUGEINT * r.a::HUGEINT) AS score
  FROM cuts c JOIN totals USING (grp)
  JOIN often l ON l.grp = c.grp AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN often r ON r.grp = c.grp AND r.phrase = array_to_string(c.w[k+1:], ' ')
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY grp, phrase ORDER BY score, k) = 1
), parts AS (
  SELECT grp, array_to_string(w[i:i+k-1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT grp, a, w, k, unnest(range(1, words - k + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS k FROM often WHERE words > 2))
  GROUP BY ALL
)
SELECT b.grp AS lang, row_number() OVER (PARTITION BY b.grp ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best b LEFT JOIN parts p ON p.grp = b.grp AND p.phrase = b.phrase
WHERE p.longer IS NULL OR 100 * p.longer < 100 * a
QUALIFY rank <= 2000
"""


@query(_phrases_sql())
def op11_prefix_free_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def damaged(talk: DataFrame) -> DataFrame:
    """Rows of conversations, one fifth of them damaged by a hash of conversation and turn; nulls are one space."""
    said = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(said["conv_id"], F.lit(":"), said["turn"]).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(said["text"], "[.!?]", "")).otherwise(said["text"])
    role = F.when(fault == 4, "user").otherwise(said["role"])
    rows = talk.filter(fault != 0)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1)))).drop("col")


@query()
def op12_weighted_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, and their cheapest repair."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = turn_repair.repair_conversations(damaged(talk)).withColumnRenamed("conv_id", "_id")
    every = talk.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    said = F.array_join(F.transform(F.coalesce("repaired", F.array().cast("array<struct<role:string,text:string>>")), lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(said, 256).alias("repaired_sha256"))


@query("""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op13_content_sort_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, the one of its text that stays and whether it is this one."""
    return content_sort.mark(table(spark, sf_dir, "documents"))
