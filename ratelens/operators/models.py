"""Model fits on Spark ML and on plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.clustering import LDA, BisectingKMeans
from pyspark.ml.feature import PCA, Bucketizer, CountVectorizer, CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.config import FEATURES, GBT_DEPTH, GBT_ROUNDS, GBT_STEP, NO_TOPIC, SEED
from ratelens.operators.evaluation import binary_metrics
from ratelens.operators.sampling import stratified_split
from ratelens.operators.scoring import label_as_score
from ratelens.operators.terms import vocabulary
from ratelens.session import materialise


#: Buckets of a feature, as many as boosted trees tell apart.
BUCKETS = 32


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    cast = df.withColumns({f"_f_{c}": F.col(c).cast("double") for c in columns})
    return VectorAssembler(inputCols=[f"_f_{c}" for c in columns], outputCol="features").transform(cast).drop(
        *[f"_f_{c}" for c in columns]
    )


def is_degenerate(features: DataFrame, label: str = "suspicious_label") -> bool:
    """True when only one class (or no row) is present. One row is read."""
    low, high = features.agg(F.min(label), F.max(label)).first()
    return low == high


@dataclass(frozen=True)
class SuspicionModel:
    """Boosted trees over the numbers of the buckets that the features are in."""

    buckets: Bucketizer
    trees: GBTClassificationModel

    @property
    def featureImportances(self):
        return self.trees.featureImportances


def feature_buckets(df: DataFrame, columns: Sequence[str] = FEATURES) -> Bucketizer:
    """Buckets of every feature: one for each value if there are few, else between its quantiles, as boosted trees cut it themselves."""
    plain = df.select([F.col(c).cast("double").alias(c) for c in columns])
    sizes = plain.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few, many = [c for c in columns if sizes[c] <= BUCKETS], [c for c in columns if sizes[c] > BUCKETS]
    borders = {}
    if few:  # at most about BUCKETS values each
        values = plain.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in few]).first()
        borders |= {c: values[c][1:] for c in few}
    if many:
        borders |= dict(zip(many, plain.approxQuantile(many, [k / BUCKETS for k in range(1, BUCKETS)], 0.001)))
    splits = [[-float("inf"), *(sorted(set(borders[c])) or [0.0]), float("inf")] for c in columns]
    return Bucketizer(splitsArray=splits, inputCols=[f"_d_{c}" for c in columns], outputCols=[f"_b_{c}" for c in columns])


def _in_buckets(df: DataFrame, buckets: Bucketizer, columns: Sequence[str]) -> DataFrame:
    cast = df.withColumns({f"_d_{c}": F.col(c).cast("double") for c in columns})
    return buckets.transform(cast).drop(*[f"_d_{c}" for c in columns])


def bucketed_rows(features: DataFrame, buckets: Bucketizer, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Rows whose features are in the same buckets, with one label, as one row with their number as weight."""
    placed = _in_buckets(features, buckets, columns)
    return placed.groupBy(*[f"_b_{c}" for c in columns], F.col("suspicious_label").cast("double").alias("label")).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def fit_suspicion(features: DataFrame, rounds: int = GBT_ROUNDS, depth: int = GBT_DEPTH, step: float = GBT_STEP,
                  seed: int = SEED) -> SuspicionModel:
    """Boosted trees on the nine features. The label is a function of two of them: accuracy is circular.

    Trees see buckets only, so rows that are alike in them are fitted as one with a weight: rounds work on as many rows as there are
    combinations of buckets, however many there were.
    """
    buckets = feature_buckets(features)
    rows = materialise(bucketed_rows(features, buckets), "bucketed-features")
    data = VectorAssembler(inputCols=[f"_b_{c}" for c in FEATURES], outputCol="features").transform(rows).select("features", "label", "weight")
    return SuspicionModel(buckets, GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, weightCol="weight").fit(data))


def score_suspicion(features: DataFrame, model: SuspicionModel | None) -> DataFrame:
    """Add suspicion_score: the model's probability, or the label when there is no model."""
    if model is None:
        return label_as_score(features)
    names = [f"_b_{c}" for c in FEATURES]
    placed = VectorAssembler(inputCols=names, outputCol="features").transform(_in_buckets(features, model.buckets, FEATURES)).drop(*names)
    return model.trees.transform(placed).withColumn("suspicion_score", F.get(vector_to_array("probability"), F.lit(1))).withColumn(
        "predicted", F.col("prediction").cast("int")
    ).drop("features", "rawPrediction", "probability", "prediction")


def fit_and_score(features: DataFrame, rounds: int = GBT_ROUNDS, depth: int = GBT_DEPTH
                  ) -> tuple[DataFrame, SuspicionModel | None, DataFrame | None]:
    """Fit on the training part, score every row, measure on the test part.

    The features are written once first: fitting takes several passes, and none should score text again.
    """
    features = materialise(features, "features")
    if is_degenerate(features):
        return label_as_score(features), None, None
    split = stratified_split(features, "suspicious_label", "review_id")
    model = fit_suspicion(split.filter(F.col("split") == "train"), rounds, depth)
    scored = score_suspicion(split, model)
    metrics = binary_metrics(scored.filter(F.col("split") == "test"), "suspicious_label", "predicted")
    return scored, model, metrics


def feature_importance(scored: DataFrame, model: SuspicionModel, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Importances as rows, largest first, next to the number of rows they were fitted on."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.lit(float(v)).alias("importance"))
             for c, v in zip(columns, model.featureImportances.toArray())]
    return scored.agg(F.count("*").alias("n_rows")).select(F.inline(F.array(*pairs)), "n_rows").orderBy(
        F.desc("importance"), "feature"
    )


def linear_svm(train: DataFrame, test: DataFrame, text_tokens: str, label: str, max_features: int = 1000,
               min_df: int = 2, max_iter: int = 2000, idf: bool = False) -> DataFrame:
    """Linear SVM on sparse count (or TF-IDF) vectors; accuracy and F1 of the test part."""
    from pyspark.ml.feature import IDF, Normalizer

    words = [r["term"] for r in vocabulary(train, max_features, min_df, text_tokens).collect()]  # max_features rows, ties by term
    cv = CountVectorizerModel.from_vocabulary(words, inputCol=text_tokens, outputCol="counts")
    tr, te, column = cv.transform(train), cv.transform(test), "counts"
    if idf:
        weights = IDF(inputCol="counts", outputCol="weighted").fit(tr)
        scale = Normalizer(inputCol="weighted", outputCol="scaled")
        tr, te, column = scale.transform(weights.transform(tr)), scale.transform(weights.transform(te)), "scaled"
    model = LinearSVC(featuresCol=column, labelCol="_y", maxIter=max_iter).fit(tr.withColumn("_y", F.col(label).cast("double")))
    out = model.transform(te.withColumn("_y", F.col(label).cast("double")))
    return binary_metrics(out.withColumn("_p", F.col("prediction").cast("int")), label, "_p")


def logistic_fit(df: DataFrame, columns: Sequence[str], label: str, max_iter: int = 5000, tol: float = 1e-8):
    """Logistic regression to convergence; `summary.objectiveHistory` holds the loss of every step."""
    data = assemble(df, columns).select("features", F.col(label).cast("double").alias("label"))
    return LogisticRegression(maxIter=max_iter, tol=tol).fit(data)


def linear_fit(df: DataFrame, columns: Sequence[str], target: str, max_iter: int = 5000, tol: float = 1e-9):
    """Least squares by Spark's solver; `summary` holds mean squared error and R squared."""
    data = assemble(df, columns).select("features", F.col(target).cast("double").alias("label"))
    return LinearRegression(maxIter=max_iter, tol=tol).fit(data)


def linear_closed_form(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """One-feature least squares from mergeable moments."""
    xd, yd = x.cast("double"), y.cast("double")
    return df.agg(
        F.count("*").alias("n"), F.regr_slope(yd, xd).alias("slope"), F.regr_intercept(yd, xd).alias("intercept"),
        F.regr_r2(yd, xd).alias("r2"),
    )


def lda_topics(docs: DataFrame, tokens: str, ks: Sequence[int], vocab: int = 1000, max_iter: int = 20, words: int = 5,
               seed: int = SEED) -> list[tuple]:
    """LDA for several topic counts: (k, log perplexity, topic, its first words)."""
    data = CountVectorizer(inputCol=tokens, outputCol="features", vocabSize=vocab, minDF=2).fit(docs)
    names, vectors = data.vocabulary, materialise(data.transform(docs).select("features"), "lda")
    out = []
    for k in ks:
        model = LDA(k=k, maxIter=max_iter, seed=seed, optimizer="online").fit(vectors)
        fit = float(model.logPerplexity(vectors))
        out += [(k, fit, r["topic"], [names[i] for i in r["termIndices"]]) for r in model.describeTopics(words).collect()]
    return out


def topic_clusters(vectors: DataFrame, key: str, vec: str, k: int = 15, min_size: int = 15, components: int = 5,
                   spread: float = 3.0, seed: int = SEED) -> DataFrame:
    """Clusters of embedding vectors with outliers as -1.

    PCA, then bisecting k-means; clusters below the minimum size, and rows that lie more than `spread` standard
    deviations farther from their centre than their cluster's rows do on average, become outliers.
    """
    data = vectors.select(key, array_to_vector(F.transform(vec, lambda x: x.cast("double"))).alias("v"))
    reduced = materialise(PCA(k=components, inputCol="v", outputCol="features").fit(data).transform(data).select(key, "features"), "reduced")
    model = BisectingKMeans(k=k, seed=seed, minDivisibleClusterSize=float(min_size)).fit(reduced)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    placed = model.transform(reduced).withColumn("x", vector_to_array("features")).withColumn("c", F.get(centres, F.col("prediction")))
    dist = F.aggregate(F.zip_with("x", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    placed = placed.select(key, "prediction", F.sqrt(dist).alias("d"))
    size = placed.groupBy("prediction").agg(F.count("*").alias("size"), (F.avg("d") + spread * F.stddev_pop("d")).alias("cut"))
    joined = placed.join(F.broadcast(size), "prediction")  # at most k rows
    outlier = (F.col("size") < min_size) | (F.col("d") > F.col("cut"))
    topic = F.when(outlier, NO_TOPIC).otherwise(F.col("prediction"))
    return joined.select(key, topic.alias("topic_id"), (topic == NO_TOPIC).cast("int").alias("is_topic_outlier"))


def apply_scorer(df: DataFrame, column: str, scorer, out: str = "score") -> DataFrame:
    """Score a text column with a user's batch function (list of text -> list of float), in Arrow batches.

    The extension point for external models: one call per batch on the executors.
    """
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType(), True)])

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: [float(x) for x in scorer(pdf[column].fillna("").tolist())]})

    return df.mapInPandas(run, schema)


def apply_answers(df: DataFrame, column: str, ask, out: str) -> DataFrame:
    """Answers of a user's batch function (list of prompts -> list of texts), in Arrow batches on the executors."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType(), True)])

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: list(ask(pdf[column].fillna("").tolist()))})

    return df.mapInPandas(run, schema)
