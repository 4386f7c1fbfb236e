"""Registry of end-to-end queries over the driver tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` plus, where the operator can
be written in ANSI SQL, the equivalent DuckDB SQL over the same parquet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, oracle: str | None = None, headline: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        if headline:
            HEADLINE.append(name)
        fn.query_name = name
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
