"""Sources and sinks: named tables from a Parquet folder or a catalog, and materialised reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from calloom.functions.calendar import Date, as_date
from calloom.session import drop_folder, folder_exists, stage


class Tables:
    """Named input tables, read lazily: ``tables["orders"]`` or ``tables.orders``.

    ``folder`` holds one Parquet file or directory per table; without it the names are looked up in the
    session catalog. ``frames`` overrides single tables, e.g. with the output of another report.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        frames: Mapping[str, DataFrame] | None = None,
    ):
        self.spark = spark
        self.folder = folder
        self._frames = dict(frames or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if self.folder:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                self._frames[name] = self.spark.table(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def with_frames(self, **frames: DataFrame) -> "Tables":
        """The same tables with some replaced or added."""
        return Tables(self.spark, self.folder, {**self._frames, **frames})


def write_report(report: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Materialise a report. Partition by its date where it has a date grain, so readers can prune."""
    if partition_by:
        # few files per date; a date far larger than the rest is split over several writers at run time
        report = report.hint("rebalance", F.col(partition_by))
        report.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        report.write.mode("overwrite").parquet(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a materialised report back for the reports built on it; a partition column is read last.

    With the report's ``schema`` a partition column keeps its type, and a report without rows can be read too.
    """
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def fingerprints(report: DataFrame, by: str) -> DataFrame:
    """(by, n, total, mixed): the number of rows per partition and two sums of their 64-bit hashes.

    Partitions with the same rows, in any order, agree; partitions that differ do so unless both sums collide.
    Values are hashed as JSON text, so NaN equals itself, and a sum of doubles that came out a last digit apart differs.
    """
    row = F.to_json(F.struct(*sorted(c for c in report.columns if c != by)), {"ignoreNullFields": "false"})
    wide = "decimal(38,0)"
    return report.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(row).cast(wide)).alias("total"),
        F.sum(F.xxhash64(F.lit(1), row).cast(wide)).alias("mixed"))


def refresh_report(report: DataFrame, path: str, partition_by: str, low: Date | None = None,
                   high: Date | None = None) -> DataFrame:
    """Bring a written report up to date by rewriting only those of its dates whose rows changed.

    The new rows are computed once and compared with the written ones date by date; dates that differ replace theirs,
    dates without rows any more are removed, all others keep their files. Without a written report all is written. So a
    late fact, a longer trailing window or a new next event rewrites just what it reaches, without a rule for each report.

    ``low`` and ``high`` (both included) say that nothing outside can have changed: only those dates are compared, and
    computed as far as the report's plan lets Spark push the filter down; rows without a date are then outside. The written
    report must be partitioned by the same column. The result has one row per rewritten or removed date (null is one of
    them), with the number of rows before and after.
    """
    spark, date = report.sparkSession, F.col(partition_by)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (date >= as_date(low))
    if high is not None:
        inside = inside & (date <= as_date(high))
    if report.schema[partition_by].dataType != T.DateType():
        raise ValueError(f"{partition_by} is not a date")
    rows = stage(report.filter(inside))
    before = folder_exists(spark, path)
    new = fingerprints(rows, partition_by).withColumnRenamed("n", "rows_after")
    if before:
        written = spark.read.schema(report.schema).parquet(path).filter(inside)
    else:
        written = spark.createDataFrame([], report.schema)
    old = fingerprints(written, partition_by).withColumnRenamed("n", "rows_before")
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{partition_by}").eqNullSafe(F.col(f"n.{partition_by}")), "full")
    # a side without rows has no count, so its date is told apart from a date that is null
    place = F.when(F.col("rows_after").isNotNull(), F.col(f"n.{partition_by}")).otherwise(F.col(f"o.{partition_by}"))
    same = F.col("o.total").eqNullSafe(F.col("n.total")) & F.col("o.mixed").eqNullSafe(F.col("n.mixed"))
    same = same & F.col("rows_before").eqNullSafe(F.col("rows_after"))
    # written before anything is replaced, as it reads what will be replaced
    changed = stage(both.filter(~same).select(
        place.alias(partition_by), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows_before", "rows_after")]))

    wanted = changed.filter("rows_after > 0").select(date.alias("__date"))
    fresh = rows.join(wanted, date.eqNullSafe(F.col("__date")), "left_semi").hint("rebalance", date)
    if not before or not wanted.isEmpty():
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    # a row per calendar date at most
    for row in changed.filter("rows_after = 0").select(date.cast("string")).toLocalIterator():
        folder = f"{partition_by}={row[0] if row[0] is not None else '__HIVE_DEFAULT_PARTITION__'}"
        drop_folder(spark, f"{path}/{folder}")
    return changed


def duplicate_keys(tables: "Tables", keys: Mapping[str, str]) -> DataFrame:
    """(table, key, n) of the keys that stand on several rows, where ``keys`` names each table's column.

    Planned tables are joined by date or week: two rows of one week double every day of it. Null keys meet no row and
    are not listed.
    """
    found = None
    for name, key in keys.items():
        rows = tables[name].filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key"))
        rows = rows.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit(name).alias("table"), "key", "n")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        raise ValueError("no tables named")
    return found
