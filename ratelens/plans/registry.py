"""Registry of named queries. Each may carry the SQL that a second engine runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, sql: str, *needs: str) -> None:
    """Register a named sub-select for check SQL with the sub-selects it builds on."""
    VIEWS[name] = (needs, sql)


def with_views(needs: tuple[str, ...], body: str) -> str:
    """Prefix a statement with the sub-selects it needs, dependencies first."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in VIEWS[name][0]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    if not order:
        return body
    recursive = "RECURSIVE " if body.lstrip().startswith("RECURSIVE") else ""
    body = body.lstrip().removeprefix("RECURSIVE").lstrip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    joiner = ",\n" if body.startswith("+") else "\n"
    return f"WITH {recursive}{ctes}{joiner}{body.removeprefix('+')}"


def query(name: str, sql: str | None = None, *needs: str) -> Callable[[Query], Query]:
    """Register a query. A statement starting with `+` continues the list of sub-selects."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECK_SQL[name] = with_views(needs, sql)
        return fn

    return register
