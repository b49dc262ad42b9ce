"""Shop dimension and calendar utilisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def by_weekday(date: Column, columns: Mapping[int, str]) -> Column:
    """The column of the row's weekday (1 = Sunday .. 7 = Saturday); null for a day not in the map."""
    day = F.dayofweek(date)
    chain = None
    for number, name in columns.items():
        chain = F.when(day == number, F.col(name)) if chain is None else chain.when(day == number, F.col(name))
    return chain


def utilisation_flag(used: Column, units: Column, per_unit: Column, limit: float = 0.5) -> Column:
    """1 if more than ``limit`` of the capacity (units times per unit) is used; 0 without use or capacity."""
    total = F.try_multiply(units, per_unit)
    return (
        F.when(used == 0, 0)
        .when(per_unit == 0, 0)
        .when(F.try_divide(used, total) > limit, 1)
        .otherwise(0)
    )


def enrich_dim(dim: DataFrame, members: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """Left join a membership table (one row per key) and add rule columns.

    Rules may use ``member`` (true where the membership table has the key) and its columns.
    """
    listed = members.withColumn("member", F.lit(True))
    joined = dim.join(listed, key, "left").withColumn("member", F.coalesce("member", F.lit(False)))
    extra = [c for c in members.columns if c != key]
    return joined.withColumns(dict(rules)).drop("member", *extra)
