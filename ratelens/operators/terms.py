"""Term statistics: tokens, vocabularies, count and TF-IDF vectors, naive Bayes as aggregates.

Term tables stay long (document, term, value) and are never densified. Vocabularies are joined by term and may
have any size; whether one is sent to all tasks is decided by its measured size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.text import STOP_WORDS, alpha_tokens, capitalised_spans, pad_truncate, sentences


def clean_tokens(text: Column, min_length: int = 3, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-cased alphabetic tokens of a minimum length without stop words, as an array."""
    return F.filter(alpha_tokens(text), lambda t: (F.length(t) >= min_length) & ~t.isin(*stop_words))


def raw_tokens(text: Column) -> Column:
    """Pieces between non-letters of the lower-cased text, blanks included: cheap to build and to explode.

    Conditions on terms are applied after the explode, in generated code, not inside the array.
    """
    return F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+")


def keep_terms(min_length: int = 3, stop_words: Sequence[str] = STOP_WORDS) -> Callable[[Column], Column]:
    """The same condition as clean_tokens, as a predicate on an exploded term."""
    return lambda t: (F.length(t) >= min_length) & ~t.isin(*stop_words)


def any_term(t: Column) -> Column:
    return t != ""


def token_summary(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Number of kept and of distinct kept tokens per document; computed in the row."""
    toks = docs.select(key, clean_tokens(F.col(text), **options).alias("t"))
    return toks.select(key, F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"))


def sentence_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(key, F.size(sentences(F.col(text))).alias("n_sentences"))


def top_per_group(counts: DataFrame, group: str, term: str, n: str, k: int) -> DataFrame:
    """The k largest rows of each group with their rank. Spark trims each task to k before the shuffle."""
    w = Window.partitionBy(group).orderBy(F.desc(n), term)
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def topk_terms(docs: DataFrame, group: str, k: int, tokens: Column, keep: Callable[[Column], Column] = any_term) -> DataFrame:
    counts = docs.select(group, F.explode(tokens).alias("term")).filter(keep(F.col("term"))).groupBy(group, "term").agg(F.count("*").alias("n"))
    return top_per_group(counts, group, "term", "n", k)


def term_class_topk(docs: DataFrame, classes: dict[str, str], group: str, k: int, text: str = "text") -> DataFrame:
    """Top-k terms per (group, word class) for a small table of classified words."""
    pairs = docs.select(group, F.explode(alpha_tokens(F.col(text))).alias("term")).filter(
        F.col("term").isin(*classes)
    ).groupBy(group, "term").agg(F.count("*").alias("n"))
    pairs_of = F.create_map(*[F.lit(x) for kv in classes.items() for x in kv])
    labelled = pairs.withColumn("word_class", pairs_of[F.col("term")])
    w = Window.partitionBy(group, "word_class").orderBy(F.desc("n"), "term")
    return labelled.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def entity_mentions(docs: DataFrame, label: str, text: str = "text") -> DataFrame:
    """Counts of capitalised spans with the label of the document they occur in."""
    return docs.select(F.col(label).alias("label"), F.explode(capitalised_spans(F.col(text))).alias("entity")).groupBy(
        "entity", "label"
    ).agg(F.count("*").alias("n"))


def entity_topk(mentions: DataFrame, k: int = 20) -> DataFrame:
    """Most mentioned entities, each with its most frequent label (ties: smallest label)."""
    per = mentions.groupBy("entity").agg(
        F.sum("n").alias("n"), F.min_by("label", F.struct((-F.col("n")).alias("c"), "label")).alias("majority_label")
    )
    return per.orderBy(F.desc("n"), "entity").limit(k)


def entity_majority_label(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("entity").agg(
        F.min_by("label", F.struct((-F.col("n")).alias("c"), "label")).alias("majority_label"),
        F.max("n").alias("n_majority"), F.sum("n").alias("n"),
    )


def vocabulary(docs: DataFrame, max_features: int, min_df: int = 1, tokens: str = "tokens",
               keep: Callable[[Column], Column] = any_term) -> DataFrame:
    """The most frequent terms with total and document frequency.

    Each document emits its tokens followed by its distinct tokens; the position tells them apart, so both
    frequencies come from one grouped sum on the term and there is no shuffle by document.
    """
    flat = docs.select(F.size(tokens).alias("n"), F.posexplode(F.concat(tokens, F.array_distinct(tokens))).alias("pos", "term"))
    freq = flat.filter(keep(F.col("term"))).groupBy("term").agg(
        F.count_if(F.col("pos") < F.col("n")).alias("total"), F.count_if(F.col("pos") >= F.col("n")).alias("df")
    )
    return freq.filter(F.col("df") >= min_df).orderBy(F.desc("total"), "term").limit(max_features)


def count_vectors(docs: DataFrame, vocab: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Term frequencies per document, restricted to the vocabulary.

    Tokens outside the vocabulary are dropped by the join, before anything is counted.
    """
    flat = docs.select(key, F.explode(tokens).alias("term"))
    kept = flat.join(vocab.select("term"), "term", "left_semi")
    return kept.groupBy(key, "term").agg(F.count("*").alias("tf"))


def tfidf_vectors(docs: DataFrame, vocab: DataFrame, key: str, n_docs: Column, tokens: str = "tokens",
                  sublinear: bool = True) -> DataFrame:
    """Sublinear tf times smooth idf, each document scaled to unit length."""
    tf = count_vectors(docs, vocab, key, tokens)
    idf = vocab.select("term", (F.ln((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
    scale = (F.ln("tf") + 1.0) if sublinear else F.col("tf").cast("double")
    raw = tf.join(idf, "term").select(key, "term", "tf", (scale * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "tf", (F.col("w") / norm).alias("weight"))


def mean_weights(vectors: DataFrame, n_docs: Column) -> DataFrame:
    """Mean weight per term over all documents, absent entries counting 0."""
    return vectors.groupBy("term").agg((F.sum("weight")).alias("s")).select(
        "term", (F.col("s") / n_docs).alias("mean_weight")
    )


def density(vectors: DataFrame, n_docs: Column, n_terms: Column) -> DataFrame:
    """Stored entries and their share of the full documents x terms matrix."""
    return vectors.agg(F.count("*").alias("nnz")).select(
        "nnz", n_docs.alias("n_docs"), n_terms.alias("n_terms"),
        (F.col("nnz") / (n_docs * n_terms).cast("double")).alias("density"),
    )


def top_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Terms that are in only one of two top lists, with the list they come from."""
    left = a.select("term").join(b.select("term"), "term", "left_anti").withColumn("only_in", F.lit("counts"))
    right = b.select("term").join(a.select("term"), "term", "left_anti").withColumn("only_in", F.lit("tfidf"))
    return left.unionByName(right)


def word_index(docs: DataFrame, num_words: int, tokens: str = "tokens") -> DataFrame:
    """Ids of the most frequent words: 0 is padding, 1 unknown, words from 2. Ids stay below num_words."""
    top = vocabulary(docs, num_words - 2, 1, tokens)
    rank = F.row_number().over(Window.orderBy(F.desc("total"), "term"))  # at most num_words rows
    return top.select("term", (rank + 1).alias("word_id"), F.col("total").alias("n"))


def token_sequences(docs: DataFrame, index: DataFrame, key: str, length: int = 100, tokens: str = "tokens") -> DataFrame:
    """Fixed-length id sequences: unknown words are 1, short texts are padded with 0 at the end."""
    flat = docs.select(key, F.size(tokens).alias("n_tokens"), F.posexplode_outer(F.slice(tokens, 1, length)).alias("pos", "term"))
    ids = flat.join(index.select("term", "word_id"), "term", "left").withColumn(
        "word_id", F.when(F.col("term").isNotNull(), F.coalesce("word_id", F.lit(1)))
    )
    seq = ids.groupBy(key, "n_tokens").agg(
        F.array_sort(F.collect_list(F.when(F.col("word_id").isNotNull(), F.struct("pos", "word_id")))).alias("s")
    )
    return seq.select(key, "n_tokens", pad_truncate(F.transform("s", lambda p: p["word_id"]), length).alias("ids"))


def nb_log_prob(train: DataFrame, vocab: DataFrame, label: str, key: str, tokens: str = "tokens") -> DataFrame:
    """Log probability of each vocabulary term in class 0 and 1 with add-one smoothing: one row per term."""
    known = vocab.select("term")
    per = train.select(label, F.explode(tokens).alias("term")).join(known, "term", "left_semi").groupBy("term").agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    sums = per.agg(F.struct(F.sum("n0").alias("s0"), F.sum("n1").alias("s1"), F.count("*").alias("v")).alias("x")).scalar()
    staged = per.withColumn("x", sums)

    def lp(n: str, s: str) -> Column:
        return F.ln((F.col(n) + 1.0) / (F.col(f"x.{s}") + F.col("x.v")).cast("double"))

    return staged.select("term", lp("n0", "s0").alias("log_prob_0"), lp("n1", "s1").alias("log_prob_1"))


def nb_weight_log_prob(vectors: DataFrame, labels: DataFrame, vocab: DataFrame, label: str, key: str) -> DataFrame:
    """As nb_log_prob, from weighted vectors (such as TF-IDF) instead of counts."""
    y, w = F.col(label), F.col("weight")
    per = vectors.join(labels.select(key, label), key).groupBy("term").agg(
        F.sum(F.when(y == 0, w).otherwise(0.0)).alias("n0"), F.sum(F.when(y == 1, w).otherwise(0.0)).alias("n1")
    )
    per = vocab.select("term").join(per, "term", "left").select("term", F.coalesce("n0", F.lit(0.0)).alias("n0"), F.coalesce("n1", F.lit(0.0)).alias("n1"))
    staged = per.withColumn("x", per.agg(F.struct(F.sum("n0").alias("s0"), F.sum("n1").alias("s1"), F.count("*").alias("v")).alias("x")).scalar())

    def lp(n: str, s: str) -> Column:
        return F.ln((F.col(n) + 1.0) / (F.col(f"x.{s}") + F.col("x.v")))

    return staged.select("term", lp("n0", "s0").alias("log_prob_0"), lp("n1", "s1").alias("log_prob_1"))


def nb_weight_predict(docs: DataFrame, vectors: DataFrame, log_prob: DataFrame, priors: DataFrame, key: str) -> DataFrame:
    """Class scores of documents from weighted vectors; documents without known terms get the priors. Ties go to class 0."""
    p = priors.select(F.struct("prior_0", "prior_1").alias("p")).scalar()
    per = vectors.join(log_prob, "term").groupBy(key).agg(
        F.sum(F.col("weight") * F.col("log_prob_0")).alias("s0"), F.sum(F.col("weight") * F.col("log_prob_1")).alias("s1"))
    summed = docs.select(key).join(per, key, "left").withColumn("p", p)
    scored = summed.select(key, (F.coalesce("s0", F.lit(0.0)) + F.col("p.prior_0")).alias("score_0"), (F.coalesce("s1", F.lit(0.0)) + F.col("p.prior_1")).alias("score_1"))
    return scored.withColumn("predicted", F.when(F.col("score_1") > F.col("score_0"), 1).otherwise(0))


def nb_priors(train: DataFrame, label: str) -> DataFrame:
    n = F.count("*").cast("double")
    return train.agg(F.ln(F.count_if(F.col(label) == 0) / n).alias("prior_0"), F.ln(F.count_if(F.col(label) == 1) / n).alias("prior_1"))


def nb_predict(docs: DataFrame, log_prob: DataFrame, priors: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Class scores per document; documents without known terms get the priors. Ties go to class 0."""
    p = priors.select(F.struct("prior_0", "prior_1").alias("p")).scalar()
    flat = docs.select(key, F.explode_outer(tokens).alias("term"))
    summed = flat.join(log_prob, "term", "left").groupBy(key).agg(
        F.coalesce(F.sum("log_prob_0"), F.lit(0.0)).alias("s0"), F.coalesce(F.sum("log_prob_1"), F.lit(0.0)).alias("s1")
    ).withColumn("p", p)
    scored = summed.select(key, (F.col("s0") + F.col("p.prior_0")).alias("score_0"), (F.col("s1") + F.col("p.prior_1")).alias("score_1"))
    return scored.withColumn("predicted", F.when(F.col("score_1") > F.col("score_0"), 1).otherwise(0))


def nb_top_terms(log_prob: DataFrame, k: int = 15) -> DataFrame:
    """The k most probable terms of each class."""
    long = log_prob.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), F.col("term"), F.col(f"log_prob_{c}").alias("log_prob")) for c in (0, 1)
    ])))
    return top_per_group(long, "class", "term", "log_prob", k)


def ctfidf(docs: DataFrame, group: str, tokens: str = "tokens", keep: Callable[[Column], Column] = any_term) -> DataFrame:
    """Class-based TF-IDF: term count in the class times ln(1 + mean class size / term count)."""
    tf = docs.select(group, F.explode(tokens).alias("term")).filter(keep(F.col("term"))).groupBy(group, "term").agg(F.count("*").alias("tf"))
    mean_size = tf.agg((F.sum("tf") / F.count_distinct(group).cast("double")).alias("a")).scalar()
    freq = tf.groupBy("term").agg(F.sum("tf").alias("f"))
    return tf.join(freq, "term").select(
        group, "term", "tf", (F.col("tf") * F.ln(F.lit(1.0) + mean_size / F.col("f"))).alias("weight")
    )
