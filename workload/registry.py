"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import SQL_VIEWS, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_VIEW = re.compile(r"\bv_\w+")


def with_views(body: str) -> str:
    """``body`` preceded by the view definitions it needs, each after those it uses."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _VIEW.findall(text):
            if name not in ordered and name in SQL_VIEWS:
                visit(SQL_VIEWS[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    start = "WITH RECURSIVE " if body.startswith("WITH RECURSIVE ") else "WITH "
    views = start + ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in ordered)
    own = body.removeprefix(start)
    return f"{views}\n{body}" if own == body else f"{views},\n{own}"


def query(key: str, sql: str | None = None):
    """Register a function from :class:`Views` to a DataFrame under ``key``."""

    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(Views(spark, folder))
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return build

    return register
