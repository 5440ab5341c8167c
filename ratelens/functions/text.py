"""Text expressions. All are built-in JVM expressions over the whole text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate words (Unicode white space and the ASCII separators).
WHITESPACE = r"(?U)[\s\x1C-\x1F]+"

# Stop words of the corpus profile.
STOP_WORDS = ("the", "and", "that", "for", "was", "with", "this", "are", "from")


def words(text: Column) -> Column:
    """White-space separated words; null text gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITESPACE), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def alpha_tokens(text: Column) -> Column:
    """Maximal runs of a-z in the lower-cased text, in order."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+"), "")


def clean_text(text: Column) -> Column:
    """Lower case, anything but a-z and white space to a blank, blanks collapsed."""
    kept = F.regexp_replace(F.lower(text), r"[^a-z\s]", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def is_nonempty(text: Column) -> Column:
    return F.coalesce(F.length(F.regexp_replace(text, WHITESPACE, "")) > 0, F.lit(False))


def preview(text: Column, n: int, mark: str = "...") -> Column:
    """First n characters, with a mark when something was left out."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(mark))).otherwise(text)


def sentences(text: Column) -> Column:
    """Split after a run of end marks followed by white space."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[.!?]+\s+")
    return F.filter(parts, lambda s: F.length(F.regexp_replace(s, r"[\s.!?]", "")) > 0)


def capitalised_spans(text: Column) -> Column:
    """Runs of capitalised ASCII words joined by single blanks."""
    return F.regexp_extract_all(text, F.lit(r"\b[A-Z][a-z]+(?: [A-Z][a-z]+)*\b"), F.lit(0))


def pad_truncate(ids: Column, length: int, pad: int = 0) -> Column:
    """Cut or right-pad an integer array to a fixed length."""
    padded = F.concat(ids, F.array_repeat(F.lit(pad), length))
    return F.slice(padded, 1, length)
