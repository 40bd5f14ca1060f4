"""Named queries over the given tables, each with SQL for the same result where there is one.

A query is a function ``(spark, folder) -> DataFrame``; ``QUERIES`` and ``SQL`` of every module
are put together here.
"""

from __future__ import annotations

from hybridflow.plans import daily, elements, joins, learning, records, words

MODULES = (elements, records, words, joins, learning, daily)


def all_queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
