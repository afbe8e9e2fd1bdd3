"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, plus the
equivalent DuckDB SQL over the raw tables where one exists."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from bidmill.plans import (core, changefeed, requests_q, payloads_q,  # noqa: F401
                               tables_q, scalars_q, streaming_q, maintain_q,
                               rejects_q, pricing_q)
