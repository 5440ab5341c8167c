"""Reading 0/1 labels out of free-text answers, and rendering the prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default prompt; `{text}` is replaced by the review.
ZERO_SHOT = 'Decide whether this review is positive or negative. Answer with one word.\nReview: "{text}"\nAnswer:'
FEW_SHOT = (
    "Decide whether a review is positive or negative. Answer with one word.\n"
    'Review: "Cold food and a rude waiter."\nAnswer: negative\n'
    'Review: "The best meal in years."\nAnswer: positive\n'
    'Review: "{text}"\nAnswer:'
)


def parse_strict(answer: Column) -> Column:
    """Letters of the first line: 'positive' anywhere or 'pos' is 1, else 'negative'/'neg' is 0, else null."""
    first = F.substring_index(F.lower(F.trim(F.regexp_replace(answer, r"^\s+", ""))), "\n", 1)
    s = F.regexp_replace(first, "[^a-z]", "")
    return (
        F.when(F.contains(s, F.lit("positive")) | (s == "pos"), 1)
        .when(F.contains(s, F.lit("negative")) | (s == "neg"), 0)
        .cast("int")
    )


def parse_window(answer: Column, width: int = 50) -> Column:
    """First characters: one of the two words alone decides, then a lone 1 or 0, else null."""
    s = F.substring(F.lower(F.regexp_replace(answer, r"^\s+|\s+$", "")), 1, width)
    pos, neg = F.contains(s, F.lit("positive")), F.contains(s, F.lit("negative"))
    one, zero = s.rlike(r"\b1\b"), s.rlike(r"\b0\b")
    return (
        F.when(pos & ~neg, 1).when(neg & ~pos, 0)
        .when(one & ~zero, 1).when(zero & ~one, 0)
        .cast("int")
    )


def render(template: str, text: Column) -> Column:
    """Fill `{text}` in a prompt template."""
    head, _, tail = template.partition("{text}")
    return F.concat(F.lit(head), F.coalesce(text, F.lit("")), F.lit(tail))


def agreement(primary: Column, comparator: Column) -> Column:
    """True only when the primary label is known and equals the comparator's."""
    return F.coalesce(primary.isNotNull() & primary.eqNullSafe(comparator), F.lit(False))
