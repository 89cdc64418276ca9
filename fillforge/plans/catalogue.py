"""All queries of the library, by name."""

from __future__ import annotations

from fillforge.plans import market_queries, rollup_queries, stream_queries, table_queries

ALL = {**rollup_queries.QUERIES, **market_queries.QUERIES, **stream_queries.QUERIES, **table_queries.QUERIES}


def queries() -> dict:
    return {name: query for name, (query, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
