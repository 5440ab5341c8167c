"""Number helpers whose results must not depend on the engine's rounding mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelens.functions.bind import bind


def round_half_even_exact(x: str, digits: int) -> str:
    """SQL text: round as correctly-rounded decimal output does, on the exact binary value, ties to even.

    `round` works on the shortest decimal form of a double and takes ties upwards, so 4.0625 at three
    digits differs. The sign of (x - tie) is computed without error by splitting x into two halves
    (Dekker 1971); every product below is exact in double arithmetic.
    """
    scale, twice = f"{10 ** digits}D", f"{2 * 10 ** digits}D"
    high = "(134217729D * v.x - (134217729D * v.x - v.x))"
    off = f"({high} * {twice} - (v.f * 2D + 1D)) + (v.x - {high}) * {twice}"
    settled = bind(off, "o", f"(case when o > 0 then v.f + 1D when o < 0 then v.f else v.f + pmod(v.f, 2D) end) / {scale}")
    return bind(f"named_struct('x', {x}, 'f', cast(floor(({x}) * {scale}) as double))", "v", settled)


def decimal_text(x: str, digits: int) -> str:
    """SQL text: shortest plain decimal form of a value rounded to `digits` places, with at least one decimal."""
    return rf"regexp_replace(regexp_replace(cast(cast({x} as decimal(28,{digits})) as string), '0+$', ''), r'\.$', '.0')"


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0 when the denominator is 0."""
    return F.coalesce(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))
