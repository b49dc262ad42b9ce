"""Queries on the driver's tables and, for each, the same result in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from calloom.session import tune
from calloom.sources import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name`` with its DuckDB text."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(tune(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def shared(t: Tables, sql: str, *names: str) -> DataFrame:
    """Run SQL that both engines read alike; ``{orders}`` stands for the table orders."""
    return t.spark.sql(sql, **{name: t[name] for name in names})


def plain(sql: str, *names: str) -> str:
    """The same SQL for DuckDB, where the tables are views of their own names."""
    return sql.format(**{name: name for name in names})
