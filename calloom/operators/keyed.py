"""Per-key values next to every row, without a window over the whole key.

A window puts all rows of a key into one task. Where the value is a plain aggregate, it is cheaper and
safe for hot keys to aggregate first (combined before the shuffle) and join the one row per key back:
the join side with a hot key is split at run time, see ``calloom.session``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Stand-ins for null in key columns, by type; a flag column tells them from real values.
STAND_INS = {
    T.StringType: "", T.BooleanType: "false", T.ByteType: "0", T.ShortType: "0", T.IntegerType: "0",
    T.LongType: "0", T.FloatType: "0", T.DoubleType: "0", T.DecimalType: "0", T.DateType: "1970-01-01",
    T.TimestampType: "1970-01-01 00:00:00", T.TimestampNTZType: "1970-01-01 00:00:00",
}


class Key:
    """Key columns under names of their own in which null equals null, for grouping, windows and joins alike.

    All three then share one hash partitioning of plain columns, and no step shuffles again.
    """

    def __init__(self, df: DataFrame, by: Sequence[str | Column], prefix: str = "__k"):
        fields = df.select(*[F.col(c) if isinstance(c, str) else c for c in by]).schema.fields
        self.columns: dict[str, Column] = {}
        self.ascending: list[Column] = []
        self.descending: list[Column] = []
        for n, (part, field) in enumerate(zip(by, fields)):
            column, name = F.col(part) if isinstance(part, str) else part, f"{prefix}{n}"
            stand_in = STAND_INS.get(type(field.dataType))
            if stand_in is None:
                self.columns[name] = F.struct(column)
            elif field.nullable:
                self.columns[name] = F.coalesce(column, F.lit(stand_in).cast(field.dataType))
                self.columns[f"{name}_null"] = column.isNull()
                self.ascending.append(F.col(f"{name}_null").desc())
                self.descending.append(F.col(f"{name}_null").asc())
            else:
                self.columns[name] = column
            self.ascending.append(F.col(name).asc())
            self.descending.append(F.col(name).desc())

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    def on(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.columns)


def attach(df: DataFrame, by: Sequence[str | Column], source: DataFrame | None = None,
           keep: Callable[[DataFrame], DataFrame] = lambda df: df, **aggregates: Column) -> DataFrame:
    """Add aggregates over the rows that share the key ``by``; null keys form a group of their own.

    ``source`` is an earlier form of the same rows to aggregate from. Steps on one table that all
    aggregate from it read it once each, instead of each repeating all steps before. ``keep`` may write the one row per key,
    e.g. ``session.stage``: few keys are then broadcast by their measured size, and the many rows are not shuffled.
    """
    source = df if source is None else source
    if not by:
        return attach_total(df, source, **aggregates)
    key = Key(source, by)
    per_key = keep(key.on(source).groupBy(*key.names).agg(*[agg.alias(name) for name, agg in aggregates.items()]))
    kept = [c for c in df.columns if c not in aggregates]
    return key.on(df).select(*key.names, *kept).join(per_key, key.names).select(*kept, *aggregates)


def attach_total(df: DataFrame, source: DataFrame | None = None, **aggregates: Column) -> DataFrame:
    """Add aggregates over all rows. They are one row, computed once as a scalar subquery."""
    source = df if source is None else source
    row = source.agg(F.struct(*[agg.alias(name) for name, agg in aggregates.items()]).alias("row"))
    rows = df.withColumn("__row", row.scalar())
    return rows.withColumns({name: F.col("__row")[name] for name in aggregates}).drop("__row")


def pick_by(order: Sequence[str], values: Sequence[str], last: bool = False) -> Column:
    """Aggregate: the values of the first (or last) row in ``order``, as a struct named by column."""
    ranked = F.struct(F.struct(*order).alias("order"), F.struct(*values).alias("row"))
    return (F.max(ranked) if last else F.min(ranked))["row"]


def conditional_counts(df: DataFrame, by: Sequence[str], counts: Mapping[str, Column] | None = None,
                       sums: Mapping[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """Per key, count rows for which each condition holds and sum values under a condition.

    ``counts`` maps a name to a condition, ``sums`` to (condition, value). A sum without any qualifying
    row is null.
    """
    columns = [F.count(F.when(p, 1)).alias(name) for name, p in (counts or {}).items()]
    columns += [F.sum(F.when(p, v)).alias(name) for name, (p, v) in (sums or {}).items()]
    return df.groupBy(*by).agg(*columns)


def with_totals(df: DataFrame, grains: Mapping[str, tuple[Sequence[str], str]],
                source: DataFrame | None = None,
                keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add sums over wider groups: ``{name: (group columns, summed column)}``.

    Sums over the same group share one aggregation; ``source`` and ``keep`` are those of ``attach``.
    """
    groups: dict[tuple[str, ...], dict[str, Column]] = {}
    for name, (by, column) in grains.items():
        groups.setdefault(tuple(by), {})[name] = F.sum(column)
    source = df if source is None else source
    for by, aggregates in groups.items():
        df = attach(df, list(by), source, keep, **aggregates)
    return df


def lookup(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct lookup rows with a usable (not null, not empty) key."""
    return df.filter(F.col(key).isNotNull() & (F.col(key) != "")).select(*columns).distinct()


def first_id(df: DataFrame, key: str, id_: str, name: str | None = None) -> DataFrame:
    """The smallest id per key; rows without key or id do not count."""
    known = df.filter(F.col(key).isNotNull() & F.col(id_).isNotNull())
    return known.groupBy(key).agg(F.min(id_).alias(name or id_))


def latest_of_type(df: DataFrame, type_column: str, type_: str, key: str, date: str, name: str) -> DataFrame:
    """The latest date of the rows of one type per key."""
    return df.filter(F.col(type_column) == type_).groupBy(key).agg(F.max(date).alias(name))


def count_ids(df: DataFrame, by: Sequence[str | Column], id_: str | Column, counts: Mapping[str, Column | None],
              sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Per key, count the different ids among the rows for which each condition holds (None: all), and sum values.

    Rows are reduced to one per key and id, with a flag for each condition, and then the flags are counted. Several
    distinct counts next to each other would copy every row once for each of them before the shuffle. Null ids do
    not count, but their rows are summed; a key without any id has count 0.
    """
    held = {name: F.lit(True) if p is None else F.coalesce(p, F.lit(False)) for name, p in counts.items()}
    keys = df.select(*by).columns
    id_ = F.col(id_) if isinstance(id_, str) else id_
    per_id = df.groupBy(*by, id_.alias("__id")).agg(
        *[F.bool_or(p).alias(name) for name, p in held.items()],
        *[F.sum(value).alias(name) for name, value in (sums or {}).items()],
    )
    known = F.col("__id").isNotNull()
    return per_id.groupBy(*keys).agg(
        *[F.count_if(known & F.col(name)).alias(name) for name in counts],
        *[F.sum(name).alias(name) for name in sums or {}],
    )


def kpis_by_dim(facts: DataFrame, dimension: DataFrame, key: str, by: Mapping[str, Column],
                kpis: Mapping[str, Column], id_: str | None = None,
                counts: Mapping[str, Column | None] | None = None) -> DataFrame:
    """Aggregate facts by attributes of the dimension row they belong to; unmatched rows drop out.

    ``kpis`` are aggregates; with ``id_`` they are the values to sum, next to ``counts`` of different ids.
    """
    groups, rows = [c.alias(name) for name, c in by.items()], facts.join(dimension, key)
    if id_ is not None:
        return count_ids(rows, groups, id_, counts or {}, kpis)
    return rows.groupBy(*groups).agg(*[c.alias(n) for n, c in kpis.items()])
