"""Review-shaped views over the test tables, in Spark and as check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.labels import agreement
from ratelens.functions.sentiment import Rules
from ratelens.functions.text import words
from ratelens.operators.cleaning import drop_invalid_ids
from ratelens.operators.features import feature_matrix, with_divergence, with_sentiment
from ratelens.operators.terms import raw_tokens
from ratelens.plans.registry import view
from ratelens.session import materialise

# Invented valences for frequent tokens of the test corpus.
LEXICON = {
    "rewh": 2.1, "orre": 1.4, "ing": 0.9, "ble": 1.2, "tion": 1.6, "than": 1.1, "ther": 0.8, "only": 0.5,
    "rely": 1.9, "thing": 0.7, "reed": 1.3, "erin": 1.0, "then": 0.6, "ered": 1.5, "oned": 0.4, "die": 1.2,
    "und": 0.9, "que": 1.1, "les": 1.3, "los": 1.0,
    "thatin": -1.5, "ononst": -2.2, "inoran": -1.8, "orantion": -2.0, "hehely": -1.2, "thth": -1.7, "thon": -0.9,
    "thhe": -1.1, "thha": -2.5, "thre": -1.4, "thnt": -0.6, "thed": -1.9, "thin": -1.0, "thor": -2.1, "thea": -0.8,
    "ein": -1.3, "der": -0.7, "des": -1.0, "ver": -1.2, "den": -0.9,
}
BOOSTERS = {"and": 0.293, "of": 0.293, "un": 0.293, "by": -0.293, "le": -0.293}
NEGATORS = frozenset(("on", "la", "von", "is"))
CONTRAST = "for"
# Phrases of the test corpus that stand for idioms and the other phrase rules.
IDIOMS = {"die der": 1.5, "de que": -2.0, "la des": 2.0, "und der und": -1.4, "rewh rewh rewh": 2.8, "der in": 0.4}
PHRASE_BOOSTERS = {"und und": -0.293, "der der": 0.293, "the nd": -0.293}
RULES = Rules(
    LEXICON, BOOSTERS, NEGATORS, CONTRAST, IDIOMS, PHRASE_BOOSTERS, refusal="que", refusal_joined=("la", "der"), stress="to", stress_with=("the", "de"),
    certain=("la", "a"), least="en", least_after=("de", "to"), hedge=("die", "in"),
)

# Word classes of the test corpus.
WORD_CLASS = {
    "the": "article", "la": "article", "le": "article", "der": "article", "die": "article", "los": "article",
    "and": "conjunction", "und": "conjunction", "que": "conjunction",
    "of": "preposition", "by": "preposition", "on": "preposition", "von": "preposition", "for": "preposition",
    "with": "preposition", "in": "preposition",
}

COMPUTED_AT = "2024-01-01T00:00:00Z"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def text_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """rt: reviews over documents, with broken ids."""
    d, n = F.col("doc_id"), F.col("n_chars")
    days = (d * 37 % 750).cast("int")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.when(d % 97 == 0, "#NAME?").otherwise(F.concat(F.lit("r"), d.cast("string"))).alias("review_id"),
        F.concat(F.lit("u"), (d % 211).cast("string")).alias("user_id"),
        F.when(d % 89 == 0, "#NAME?").otherwise(F.col("source")).alias("business_id"),
        (n % 5 + 1).cast("int").alias("stars"), (n % 7).cast("int").alias("useful"),
        (n % 3).cast("int").alias("funny"), (n % 4).cast("int").alias("cool"), "text",
        F.date_add(F.lit("2020-01-01").cast("date"), days).cast("timestamp_ntz").alias("date"),
    )


def clean_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return drop_invalid_ids(text_reviews(spark, sf))


def number_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """rn: reviews at volume over orders, with a stand-in text score."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("r"), k.cast("string")).alias("review_id"), F.concat(F.lit("u"), c.cast("string")).alias("user_id"),
        F.concat(F.lit("b"), (k % 400).cast("string")).alias("business_id"),
        ((c + k) % 5 + 1).cast("int").alias("stars"), (k % 7).cast("int").alias("useful"),
        (k % 3).cast("int").alias("funny"), (k % 4).cast("int").alias("cool"),
        F.floor(F.col("o_totalprice") / 1000.0).cast("int").alias("review_length_words"),
        ((k * 7919 % 2001 - 1000).cast("double") / F.lit(1000.0)).alias("vader_compound"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date"),
    )


def number_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Topic per review at volume: the largest line number of the order, orders without lines have none."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg((F.max("l_linenumber") - 2).cast("int").alias("topic_id")).select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("review_id"), "topic_id",
        (F.col("topic_id") == -1).cast("int").alias("is_topic_outlier"),
    )


def document_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Topic per document from the embedding labels: not every document has a vector, label 0 is the outlier."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.concat(F.lit("r"), F.col("vec_id").cast("string")).alias("review_id"),
        (F.col("label") - 1).alias("topic_id"), (F.col("label") == 0).cast("int").alias("is_topic_outlier"),
    )


def scored_text(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned text reviews with the plain lexicon score."""
    return with_sentiment(clean_reviews(spark, sf), RULES, plain=True)


def ruled_text(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned text reviews with the rule-based score."""
    return with_sentiment(clean_reviews(spark, sf), RULES)


def scored_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return with_divergence(number_reviews(spark, sf))


def text_features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_matrix(scored_text(spark, sf), document_topics(spark, sf), keep=("date", "user_id"), need=("stars",))


def ruled_features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_matrix(ruled_text(spark, sf), document_topics(spark, sf), keep=("date", "user_id"), need=("stars",))


def number_features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_matrix(scored_numbers(spark, sf), number_topics(spark, sf), keep=("date", "user_id"), need=("stars",))


def label_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Cached labels per review; every key occurs twice and the first row wins. Some labels are missing."""
    base = table(spark, sf, "labels").select(
        F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("review_id"),
        F.when(F.col("doc_id") % 50 != 0, F.col("quality")).alias("primary_label"),
        (1 - F.col("toxic")).alias("comparator_label"), F.col("quality").alias("zero_shot_label"),
        F.when(F.col("doc_id") % 50 != 0, F.col("quality")).alias("few_shot_label"),
    )
    first = base.withColumn("ord", F.lit(0))
    second = base.withColumns({"ord": F.lit(1), "primary_label": 1 - F.col("comparator_label")})
    return first.unionByName(second).withColumn(
        "multi_model_agreement", agreement(F.col("primary_label"), F.col("comparator_label"))
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Truth from the stars, prediction from the cached quality label, one row per binary review."""
    lab = table(spark, sf, "labels").select("doc_id", F.when(F.col("doc_id") % 50 != 0, F.col("quality")).alias("y_pred"), "toxic")
    r = clean_reviews(spark, sf).filter(F.col("stars") != 3)
    return r.join(lab, "doc_id").select("review_id", (F.col("stars") > 3).cast("int").alias("y_true"), "y_pred",
                                        (1 - F.col("toxic")).alias("y_other"), "text")


def binary_documents(spark: SparkSession, sf: str, tokens: Callable[[Column], Column] = raw_tokens) -> DataFrame:
    """Cleaned reviews without the middle star, with tokens, label and split.

    Written once, in place: the text is read once however often the tokens are, and no token array is shuffled.
    """
    from ratelens.operators.sampling import stratified_split

    r = clean_reviews(spark, sf).filter(F.col("stars") != 3).select(
        "doc_id", (F.col("stars") > 3).cast("int").alias("y"), tokens(F.col("text")).alias("tokens")
    )
    return materialise(stratified_split(r, "y", "doc_id"), "binary-documents")


def word_lists(df: DataFrame) -> DataFrame:
    return df.withColumn("tokens", words(F.lower("text")))


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(d: dict, cols: str) -> str:
    rows = ", ".join(f"({quote(k)}, {quote(v) if isinstance(v, str) else f'{v}::DOUBLE'})" for k, v in d.items())
    return f"SELECT * FROM (VALUES {rows}) AS t({cols})"


view("rt", """SELECT doc_id, CASE WHEN doc_id % 97 = 0 THEN '#NAME?' ELSE 'r' || doc_id END AS review_id,
  'u' || (doc_id % 211) AS user_id, CASE WHEN doc_id % 89 = 0 THEN '#NAME?' ELSE source END AS business_id,
  CAST(1 + n_chars % 5 AS INTEGER) AS stars, CAST(n_chars % 7 AS INTEGER) AS useful,
  CAST(n_chars % 3 AS INTEGER) AS funny, CAST(n_chars % 4 AS INTEGER) AS cool, text,
  TIMESTAMP '2020-01-01' + to_days(CAST(doc_id * 37 % 750 AS INTEGER)) AS date FROM documents""")
view("rtc", "SELECT * FROM rt WHERE review_id <> '#NAME?' AND business_id <> '#NAME?'", "rt")
view("rn", """SELECT 'r' || o_orderkey AS review_id, 'u' || o_custkey AS user_id, 'b' || (o_orderkey % 400) AS business_id,
  CAST(1 + (o_custkey + o_orderkey) % 5 AS INTEGER) AS stars, CAST(o_orderkey % 7 AS INTEGER) AS useful,
  CAST(o_orderkey % 3 AS INTEGER) AS funny, CAST(o_orderkey % 4 AS INTEGER) AS cool,
  CAST(floor(o_totalprice / 1000.0::DOUBLE) AS INTEGER) AS review_length_words,
  CAST(o_orderkey * 7919 % 2001 - 1000 AS DOUBLE) / 1000.0::DOUBLE AS vader_compound, o_orderdate AS date FROM orders""")
view("rntopics", """SELECT 'r' || l_orderkey AS review_id, CAST(max(l_linenumber) - 2 AS INTEGER) AS topic_id
  FROM lineitem GROUP BY l_orderkey""")
view("dtopics", "SELECT vec_id AS doc_id, 'r' || vec_id AS review_id, CAST(label - 1 AS INTEGER) AS topic_id FROM embeddings")
view("lex", values(LEXICON, "term, valence"))
view("boosters", values(BOOSTERS, "term, weight"))
view("negators", "SELECT * FROM (VALUES " + ", ".join(f"({quote(n)})" for n in sorted(NEGATORS)) + ") AS t(term)")
view("wordclass", values(WORD_CLASS, "term, word_class"))
view("atok", "SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents")
view("plainsum", """SELECT doc_id, sum(valence) AS s FROM atok JOIN lex USING (term) GROUP BY doc_id""", "atok", "lex")


def _divergence(source: str) -> str:
    return f"""SELECT *, abs(vader_compound - normalized_stars) AS sentiment_star_divergence,
  CASE WHEN abs(vader_compound - normalized_stars) > 1.0::DOUBLE THEN 1 ELSE 0 END AS suspicious
  FROM (SELECT *, (stars::DOUBLE - 3.0::DOUBLE) / 2.0::DOUBLE AS normalized_stars FROM {source})"""


view("plainscore", """SELECT r.*, round(coalesce(p.s, 0.0::DOUBLE) / sqrt(coalesce(p.s, 0.0::DOUBLE) * coalesce(p.s, 0.0::DOUBLE) + 15.0::DOUBLE), 4) AS vader_compound
  FROM rtc r LEFT JOIN plainsum p USING (doc_id)""", "rtc", "plainsum")
view("scored", _divergence("plainscore"), "plainscore")
view("rns", _divergence("rn"), "rn")

# The published sentiment rules over positions, one step per look-back distance.
view("rtok", r"""SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS w0
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS ws FROM rtc)""", "rtc")
_P = r"!-/:-@\[-`{-~"
view("rword", f"""SELECT doc_id, pos, w, lower(w) AS low, (upper(w) = w AND lower(w) <> w) AS up FROM (
  SELECT doc_id, pos, CASE WHEN length(core) <= 2 THEN w0 ELSE core END AS w
  FROM (SELECT *, regexp_replace(w0, '^[{_P}]+|[{_P}]+$', '', 'g') AS core FROM rtok))""", "rtok")
view("rctx", """SELECT *, lag(low, 1) OVER p AS l1, lag(low, 2) OVER p AS l2, lag(low, 3) OVER p AS l3,
  lead(low, 1) OVER p AS f1, lead(low, 2) OVER p AS f2, lag(up, 1) OVER p AS u1, lag(up, 2) OVER p AS u2, lag(up, 3) OVER p AS u3,
  (count(*) FILTER (WHERE up) OVER d > 0 AND count(*) FILTER (WHERE up) OVER d < count(*) OVER d) AS mixed,
  min(pos) FILTER (WHERE low = '""" + CONTRAST + """') OVER d AS cut
  FROM rword WINDOW p AS (PARTITION BY doc_id ORDER BY pos), d AS (PARTITION BY doc_id)""", "rword")
def _any(column: str, words: tuple[str, ...]) -> str:
    return f"coalesce({column} IN ({', '.join(map(quote, words))}), false)"


view("idioms", values(IDIOMS, "phrase, valence"))
view("phraseboosts", values(PHRASE_BOOSTERS, "phrase, weight"))
_NO = quote(RULES.refusal)
view("rhit", f"""SELECT * EXCLUDE raw, raw + CASE WHEN mixed AND up THEN CASE WHEN raw > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0.0::DOUBLE END AS v0 FROM (
  SELECT c.*, CASE WHEN l1 = {_NO} OR l2 = {_NO} OR (l3 = {_NO} AND {_any('l1', RULES.refusal_joined)}) THEN valence * -0.74::DOUBLE
    WHEN low = {_NO} AND f1 IN (SELECT term FROM lex) THEN 0.0::DOUBLE ELSE valence END AS raw
  FROM rctx c JOIN lex ON lex.term = c.low WHERE c.low NOT IN (SELECT term FROM boosters))""", "rctx", "lex", "boosters")


def _step(k: int) -> str:
    damp = {1: "1.0", 2: "0.95", 3: "0.9"}[k]
    v, l, u = f"v{k - 1}", f"l{k}", f"u{k}"
    near, without, doubt = _any("l1", RULES.stress_with), *map(quote, RULES.certain)
    stressed = {1: "false", 2: f"l2 = {quote(RULES.stress)} AND {near}", 3: f"(l3 = {quote(RULES.stress)} AND {_any('l2', RULES.stress_with)}) OR {near}"}[k]
    certain = {1: "false", 2: f"l2 = {without} AND l1 = {doubt}", 3: f"l3 = {without} AND (l2 = {doubt} OR l1 = {doubt})"}[k]
    return f"""SELECT h.*, CASE WHEN {l} IS NULL OR {l} IN (SELECT term FROM lex) THEN {v} ELSE
    ({v} + CASE WHEN b.weight IS NULL THEN 0.0::DOUBLE ELSE (CASE WHEN {v} < 0 THEN -b.weight ELSE b.weight END
      + CASE WHEN mixed AND {u} THEN CASE WHEN {v} > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0.0::DOUBLE END) * {damp}::DOUBLE END)
    * CASE WHEN {stressed} THEN 1.25::DOUBLE WHEN {certain} THEN 1.0::DOUBLE
      WHEN {l} IN (SELECT term FROM negators) OR contains({l}, 'n''t') THEN -0.74::DOUBLE ELSE 1.0::DOUBLE END END AS v{k}
  FROM rhit{k - 1 if k > 1 else ''} h LEFT JOIN boosters b ON b.term = {l}"""


def _one(table: str, column: str, *parts: str) -> str:
    return f"(SELECT {column} FROM {table} WHERE phrase = " + " || ' ' || ".join(parts) + ")"


_IDIOM = ", ".join(_one("idioms", "valence", *p.split()) for p in ("low f1 f2", "low f1", "l1 low", "l2 l1 low", "l2 l1", "l3 l2 l1", "l3 l2"))
_MORE = " + ".join(f"coalesce({_one('phraseboosts', 'weight', *p.split())}, 0.0::DOUBLE)" for p in ("l3 l2 l1", "l3 l2", "l2 l1"))
view("rhit1", _step(1), "rhit", "negators")
view("rhit2", _step(2), "rhit1")
view("rhit3", _step(3), "rhit2")
view("rhit4", f"SELECT *, CASE WHEN l3 IS NULL OR l3 IN (SELECT term FROM lex) THEN v3 ELSE coalesce({_IDIOM}, v3) + {_MORE} END AS v4 FROM rhit3", "rhit3", "idioms", "phraseboosts")
view("rhit5", f"""SELECT *, CASE WHEN low = {quote(RULES.hedge[0])} AND f1 = {quote(RULES.hedge[1])} THEN 0.0::DOUBLE
    WHEN l1 = {quote(RULES.least)} AND l1 NOT IN (SELECT term FROM lex) AND NOT {_any('l2', RULES.least_after)} THEN v4 * -0.74::DOUBLE ELSE v4 END AS v5 FROM rhit4""", "rhit4")
view("rsum", """SELECT doc_id, sum(CASE WHEN cut IS NULL OR pos = cut THEN v5 WHEN pos < cut THEN v5 * 0.5::DOUBLE ELSE v5 * 1.5::DOUBLE END) AS s
  FROM rhit5 GROUP BY doc_id""", "rhit5")
view("rtotal", """SELECT r.*, coalesce(s, 0.0::DOUBLE) + sign(coalesce(s, 0.0::DOUBLE)) * (
    least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE
    + CASE WHEN q <= 1 THEN 0.0::DOUBLE WHEN q <= 3 THEN q * 0.18::DOUBLE ELSE 0.96::DOUBLE END) AS t
  FROM (SELECT *, length(text) - length(replace(text, '?', '')) AS q FROM rtc) r LEFT JOIN rsum USING (doc_id)""", "rtc", "rsum")
view("rulescore", "SELECT *, round(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, t / sqrt(t * t + 15.0::DOUBLE))), 4) AS vader_compound FROM rtotal", "rtotal")
view("ruled", _divergence("rulescore"), "rulescore")

_WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))"


def _features(source: str, topics: str, length: str) -> str:
    return f"""SELECT s.review_id, s.business_id, s.user_id, s.stars, s.useful, s.funny, s.cool, CAST({length} AS INTEGER) AS review_length_words,
  s.vader_compound, s.sentiment_star_divergence, s.suspicious, coalesce(t.topic_id, -1) AS topic_id,
  CASE WHEN coalesce(t.topic_id, -1) = -1 THEN 1 ELSE 0 END AS is_topic_outlier, s.suspicious AS suspicious_label, s.date
  FROM {source} s LEFT JOIN {topics} t ON t.review_id = s.review_id"""


view("rfeat", _features("ruled", "dtopics", _WORDS), "ruled", "dtopics")
view("tfeat", _features("scored", "dtopics", _WORDS), "scored", "dtopics")
view("nfeat", _features("rns", "rntopics", "review_length_words"), "rns", "rntopics")


def trust_sql(source: str, min_reviews: int = 10, key: str = "business_id") -> str:
    """Trust score of a feature view whose label is the score, all measures unrounded."""
    return f"""SELECT *, raw_avg_stars - adjusted_stars AS manipulation_delta FROM (
  SELECT {key} AS business_id, count(review_id) AS review_count, avg(stars::DOUBLE) AS raw_avg_stars,
    avg(CASE WHEN suspicious > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS suspicion_pct,
    avg(suspicious::DOUBLE) AS mean_suspicion_score,
    CASE WHEN sum(1 - suspicious) > 0 THEN sum(stars * (1 - suspicious))::DOUBLE / nullif(sum(1 - suspicious), 0)::DOUBLE
         ELSE avg(stars::DOUBLE) END AS adjusted_stars,
    min(date) AS date_min, max(date) AS date_max, avg(sentiment_star_divergence) AS mean_divergence,
    avg(is_topic_outlier::DOUBLE) AS topic_outlier_pct
  FROM {source} GROUP BY {key} HAVING count(review_id) >= {min_reviews})"""


view("ttrust", trust_sql("tfeat"), "tfeat")
view("rtrust", trust_sql("rfeat"), "rfeat")
view("ntrust", trust_sql("nfeat"), "nfeat")
view("utrust", trust_sql("nfeat", 1, "user_id"), "nfeat")


def covered_sql(source: str) -> str:
    return f"""SELECT *, CASE WHEN rv <= 100 THEN 'volume' ELSE 'delta' END AS covered_by FROM (
  SELECT *, row_number() OVER (ORDER BY review_count DESC, business_id) AS rv,
    row_number() OVER (ORDER BY manipulation_delta DESC, business_id) AS rd FROM {source}) WHERE rv <= 100 OR rd <= 10"""


view("ncovered", covered_sql("ntrust"), "ntrust")
view("tcovered", covered_sql("ttrust"), "ttrust")
view("cache", """SELECT 'r' || doc_id AS review_id, CASE WHEN ord = 1 THEN toxic WHEN doc_id % 50 = 0 THEN NULL ELSE quality END AS primary_label,
  1 - toxic AS comparator_label, quality AS zero_shot_label, CASE WHEN doc_id % 50 <> 0 THEN quality END AS few_shot_label, ord
  FROM labels, (VALUES (0), (1)) AS o(ord)""")
view("preds", """SELECT review_id, CASE WHEN stars > 3 THEN 1 ELSE 0 END AS y_true, CASE WHEN l.doc_id % 50 <> 0 THEN quality END AS y_pred,
  1 - toxic AS y_other, text FROM rtc JOIN labels l USING (doc_id) WHERE stars <> 3""", "rtc")
view("bdocs", """SELECT doc_id, y, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT doc_id, y, row_number() OVER (PARTITION BY y ORDER BY md5(doc_id || ':42'), doc_id) AS rn, count(*) OVER (PARTITION BY y) AS n
  FROM (SELECT doc_id, CASE WHEN stars > 3 THEN 1 ELSE 0 END AS y FROM rtc WHERE stars <> 3))""", "rtc")
STOP = "('the', 'and', 'that', 'for', 'was', 'with', 'this', 'are', 'from')"
view("ctok", f"SELECT doc_id, term FROM atok WHERE length(term) >= 3 AND term NOT IN {STOP}", "atok")
view("btok", f"SELECT doc_id, y, split, term FROM bdocs JOIN atok USING (doc_id) WHERE length(term) >= 2 AND term NOT IN {STOP}", "bdocs", "atok")


def py_round_sql(x: str, digits: int) -> str:
    """Round on the exact value: the decimal expansion of a double, ties to even."""
    s = f"{10 ** digits}.0::DOUBLE"
    s2 = f"{2 * 10 ** digits}.0::DOUBLE"
    hi = f"((134217729.0::DOUBLE * ({x})) - ((134217729.0::DOUBLE * ({x})) - ({x})))"
    f = f"floor(({x}) * {s})"
    off = f"(({hi} * {s2} - ({f} * 2.0::DOUBLE + 1.0::DOUBLE)) + (({x}) - {hi}) * {s2})"
    return (f"(CASE WHEN {off} > 0 THEN {f} + 1.0::DOUBLE WHEN {off} < 0 THEN {f} "
            f"ELSE 2.0::DOUBLE * ceil({f} / 2.0::DOUBLE) END / {s})")


def dec_text_sql(x: str, digits: int) -> str:
    return f"regexp_replace(regexp_replace(CAST(CAST({x} AS DECIMAL(28,{digits})) AS VARCHAR), '0+$', ''), '\\.$', '.0')"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round result columns so that the order of summation does not show."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
