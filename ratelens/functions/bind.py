"""Evaluate an expression once and use it several times inside one SQL expression."""

from __future__ import annotations


def bind(value: str, name: str, use: str) -> str:
    """SQL text of `use` with `name` standing for `value`, which is computed once per row.

    Catalyst copies a repeated sub-expression into every place that mentions it; nested rounding and
    serialisation rules would grow exponentially. A lambda variable keeps the expression linear.
    """
    return f"get(transform(array({value}), {name} -> {use}), 0)"
