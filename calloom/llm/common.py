"""Small pieces that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none if it is null or blank."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def crc_bucket(key: Column, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % buckets


def text_batches(batches: Iterator, column: str = "text") -> Iterator[tuple]:
    """(batch, texts) of Arrow batches, null texts as empty ones."""
    for batch in batches:
        yield batch, [text or "" for text in batch.column(column).to_pylist()]


#: Entries of a table that are broadcast: the most frequent ones, of at most ``HOT_LENGTH`` characters. A fixed size.
HOT, HOT_LENGTH = 1 << 17, 64


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def hot_rows(table: DataFrame, item: str, total: str, limit: int = HOT) -> DataFrame:
    """The rows of the most frequent short items, ``limit`` at most.

    A histogram of totals, some hundred rows, gives the total from which on there are no more than that.
    """
    short = table.filter((F.length(item) <= HOT_LENGTH) & (F.col(total) > 0))
    step = F.floor(F.log2(total) * 16).cast("int")
    least, count = None, 0
    for row in short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        count += row["count"]
        if count > limit:
            break
        least = row["step"]
    return short.filter(step >= least if least is not None else F.lit(False))


def hottest(table: DataFrame, item: str, total: str, *values: str) -> list:
    """Columns (item, values) of the most frequent short items, ``HOT`` at most."""
    rows = hot_rows(table, item, total).select(item, *values).toPandas()
    return [rows[name].tolist() for name in (item, *values)]


def first_of_each(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The n first rows of each group in ``order``, with their ``__rank``.

    Rows are ranked in 64 parts of a group first: what meets in one task is 64 n rows, however large the group is.
    """
    parts = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(64)))
    for by in ([group, "__part"], [group]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        parts = parts.withColumn("__rank", rank).filter(F.col("__rank") <= n)
    return parts.drop("__part")


def row_keys(count: int, first: int) -> range:
    """Numbers for the rows of a batch, unique over all tasks of a stage and the same when a task runs again."""
    from pyspark import TaskContext

    base = (TaskContext.get().partitionId() << 40) + first
    return range(base, base + count)


def add_rest(rows: DataFrame, table: DataFrame, item: str, sums: dict[str, Column]) -> DataFrame:
    """Add to columns of ``rows`` what the items in their array ``rest`` (structs of item, n) amount to.

    The rest holds items that were not broadcast, so no item has many rows here. ``sums`` are expressions of n and
    of the columns of ``table``, null where an item is not in it; ``rows`` have a unique ``_key``.
    """
    rest = rows.select("__key", F.explode("__rest").alias("__entry")).select("__key", F.col("__entry.item").alias(item), "__entry.n")
    found = rest.join(table, item, "left").groupBy("__key").agg(*(F.sum(e).alias(f"__{name}") for name, e in sums.items()))
    whole = rows.drop("__rest").join(found, "__key", "left")
    changed = {name: F.col(name) + F.coalesce(F.col(f"__{name}"), F.lit(0)) for name in sums}
    return whole.withColumns(changed).drop("__key", *(f"__{name}" for name in sums))
