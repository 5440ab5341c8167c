"""Constants shared by the operators. Everything here is a default; callers may override."""

from __future__ import annotations

# Review table layout.
REVIEW_COLUMNS = (
    "review_id", "user_id", "business_id",
    "stars", "useful", "funny", "cool",
    "text", "date",
)

# Ids written by a broken spreadsheet export. Rows carrying one are dropped.
INVALID_IDS = ("#NAME?",)

# Scoring thresholds.
DIVERGENCE_THRESHOLD = 1.0
SUSPICION_CUTOFF = 0.5
MIN_REVIEWS = 10
TOP_N = 10
COVERAGE_BY_VOLUME = 100
ANCHOR_COUNT = 5
ANCHOR_MIN_STARS = 4.0

# Three-way classification of a record.
OPEN_DELTA = 0.85
OPEN_SUSPICION = 0.75
HYBRID_OUTLIER = 0.70

# Defaults used where a topic assignment is absent.
NO_TOPIC = -1
NO_TOPIC_OUTLIER = 1

# Boosted-tree parameters.
GBT_ROUNDS = 100
GBT_DEPTH = 6
GBT_STEP = 0.1
SEED = 42

# Feature columns of the classifier, in order.
FEATURES = (
    "stars", "useful", "funny", "cool",
    "review_length_words",
    "vader_compound", "sentiment_star_divergence",
    "topic_id", "is_topic_outlier",
)

# Record metadata defaults (job parameters, not part of any computation).
SCHEMA_VERSION = "review-trust-1.0"
TENANT_ID = "default-tenant"
DATA_SOURCE = "review_table"
MODELS = {
    "sentiment": {"name": "lexicon rules", "version": "lexicon-1"},
    "topic": {"name": "embedding clusters", "version": "bisecting-kmeans-1"},
    "classifier": {
        "name": "boosted trees",
        "version": "gbt-1",
        "label_proxy": "sentiment_star_divergence > 1.0",
    },
}
LIMITATIONS = (
    "A review counts as suspicious when its sentiment and its stars lie far apart; nobody has confirmed any of them.",
    "Model accuracy is not evidence: the label is computed from two of the model's inputs.",
    "Sentiment comes from a word list supplied by the user and from rules, not from reading.",
    "Samples and splits follow a hash of the key, so another key gives another sample.",
    "Topic outliers are cut by distance within a cluster; another cut gives other shares.",
)
ANCHOR_LIMITATION = (
    "Made before topics, labels and model were run: their evidence is null or rests on the divergence flag."
)
