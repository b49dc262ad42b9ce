"""Ordered per-key values (row numbers, neighbours, running maxima) that stay parallel for hot keys.

A window ``partitionBy(key).orderBy(..)`` sorts a whole key in one task. Here a key is cut into slices along
the row order, and one exchange by (key, slice) serves both halves of a prefix scan:

1. rows are numbered and carried inside (key, slice);
2. one summary row per (key, slice) holds its size and its edge rows, and a window over these few
   summaries gives what enters a slice from the slices before and after it;
3. the summaries are joined back on (key, slice), the partitioning the rows already have.

Slices are either expressions that do not decrease along the order, e.g. the hour of the ordering timestamp, or a
table of boundaries taken from the data (``boundaries``), which bounds slices whatever the values are: a key with all
rows at one moment, or with ids far apart, is cut like any other.

The result equals the plain window. The order must be total, else row numbers are arbitrary as in any
engine. Nulls sort first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window, functions as F

from calloom.functions.calendar import hour_number
from calloom.operators.keyed import Key
from calloom.session import stage

ID_SLICE = 1_000_000
#: Rows of a slice, about, where boundaries are taken from the data, and sampled rows for each.
SLICE_ROWS, SAMPLED = 1_000_000, 4


def hours(ts: str) -> Column:
    """Slice a timestamp by hour."""
    return hour_number(F.col(ts))


def id_range(id_: str, width: int = ID_SLICE) -> Column:
    """Slice a numeric id by ranges of ``width``; unique ids bound a slice to ``width`` rows."""
    return F.floor(F.col(id_) / width)


def boundaries(df: DataFrame, by: Sequence[str], order: Sequence[str], rows: int = SLICE_ROWS) -> DataFrame:
    """Slice boundaries of heavy keys, for ``ordered(slices=..)`` on the same rows, key and order.

    One in ``rows / SAMPLED`` rows is sampled by a hash of its order, read from the columns of key and order alone; every
    ``SAMPLED``-th sampled row of a key is a boundary. So a slice has about ``rows`` rows, keys with far fewer are not in
    the table, and the table is a millionth of the rows. It is written at once, as its measured size decides how it is joined.
    """
    key, place = Key(df, by), F.struct(*order)
    rare = F.pmod(F.xxhash64(*order), F.lit(max(1, rows // SAMPLED))) == 0
    sample = key.on(df).filter(rare).groupBy(*key.names).agg(F.sort_array(F.collect_list(place)).alias("__cuts"))
    every = F.filter("__cuts", lambda _, n: n % SAMPLED == SAMPLED - 1)
    return stage(sample.withColumn("__cuts", every).filter(F.size("__cuts") > 0))


def sliced(df: DataFrame, by: Sequence[str], order: Sequence[str], cuts: DataFrame, name: str) -> DataFrame:
    """Add the number of a row's slice: how many boundaries of its key lie at or before it."""
    key, place = Key(df, by), F.struct(*order)
    number = F.coalesce(F.size(F.filter("__cuts", lambda cut: cut <= F.col("__place"))), F.lit(0))
    rows = key.on(df).withColumn("__place", place).join(cuts, key.names, "left")
    return rows.select(*df.columns, number.alias(name))


def _shared(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows dealt by ``names``, twice, from one exchange.

    Spark reuses an exchange only where both uses need the same columns. A metric over all columns above it keeps either
    use from dropping some.
    """
    dealt = df.repartition(*names)
    every = F.max(F.hash(*df.columns)).alias("rows")
    return dealt.observe(f"rows {uuid4().hex}", every), dealt.observe(f"cells {uuid4().hex}", every)


def ordered(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    slices: Sequence[Column] | DataFrame,
    *,
    row_number: str | None = None,
    row_number_desc: str | None = None,
    total: str | None = None,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    running_max: Mapping[str, str] | None = None,
    running_sum: Mapping[str, str] | None = None,
    coming_min: Mapping[str, str] | None = None,
    key_sum: Mapping[str, str] | None = None,
    key_max: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ordered values per key.

    ``slices`` cut a key: expressions that do not decrease along ``order`` (lexicographically), or a table from
    ``boundaries``. ``lag``, ``lead``, ``running_max``, ``running_sum``, ``coming_min``, ``key_sum`` and ``key_max`` (over
    the whole key) map a new column to its source column; running values include the row, and so does the minimum of the
    coming rows.
    """
    lag, lead, running_max = dict(lag or {}), dict(lead or {}), dict(running_max or {})
    running_sum, key_sum, key_max = dict(running_sum or {}), dict(key_sum or {}), dict(key_max or {})
    coming_min = dict(coming_min or {})
    numbered = bool(row_number or row_number_desc or lag or lead)

    columns = df.columns
    if isinstance(slices, DataFrame):
        df = sliced(df, by, order, slices, "__slice")
        slices = [F.col("__slice")]
    key, cut = Key(df, by), Key(df, slices, "__s")
    names = [*key.names, *cut.names]
    rows, cell_rows = _shared(cut.on(key.on(df)), names)
    row = Window.partitionBy(*names).orderBy(*order)
    upto = row.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    carried = sorted({*lag.values(), *lead.values()})
    edge = F.struct(F.struct(*order).alias("order"), F.struct(*carried).alias("row")) if carried else None
    summary = [F.count(F.lit(1)).alias("n")]
    if lead:
        summary.append(F.min(edge)["row"].alias("first"))
    if lag:
        summary.append(F.max(edge)["row"].alias("last"))
    summary += [F.max(src).alias(f"max_{name}") for name, src in {**running_max, **key_max}.items()]
    summary += [F.min(src).alias(f"min_{name}") for name, src in coming_min.items()]
    summary += [F.sum(src).alias(f"sum_{name}") for name, src in {**running_sum, **key_sum}.items()]

    whole = Window.partitionBy(*key.names)
    by_slice = whole.orderBy(*cut.ascending)
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    cells = cell_rows.groupBy(*names).agg(*summary)
    incoming = {
        "__n": F.col("n"),
        "__skip": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "__total": F.sum("n").over(whole),
    }
    if lag:
        incoming["__prev"] = F.lag("last").over(by_slice)
    if lead:
        incoming["__next"] = F.lead("first").over(by_slice)
    for name in running_max:
        incoming[f"__max_{name}"] = F.max(f"max_{name}").over(before)
    # read backwards, as a frame that ends with the partition would be computed anew for every row
    after = whole.orderBy(*cut.descending).rowsBetween(Window.unboundedPreceding, -1)
    for name in coming_min:
        incoming[f"__min_{name}"] = F.min(f"min_{name}").over(after)
    for name in running_sum:
        incoming[f"__sum_{name}"] = F.sum(f"sum_{name}").over(before)
    for name in key_sum:
        incoming[f"__key_{name}"] = F.sum(f"sum_{name}").over(whole)
    for name in key_max:
        incoming[f"__key_{name}"] = F.max(f"max_{name}").over(whole)
    cells = cells.select(*names, *[c.alias(name) for name, c in incoming.items()])

    local = {}
    if numbered:
        local["__rn"] = F.row_number().over(row)
    for name, src in lag.items():
        local[f"__lag_{name}"] = F.lag(src).over(row)
    for name, src in lead.items():
        local[f"__lead_{name}"] = F.lead(src).over(row)
    for name, src in running_max.items():
        local[f"__run_{name}"] = F.max(src).over(upto)
    back = Window.partitionBy(*names).orderBy(*[F.col(c).desc() for c in order])
    back = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, src in coming_min.items():
        local[f"__low_{name}"] = F.min(src).over(back)
    for name, src in running_sum.items():
        local[f"__cum_{name}"] = F.sum(src).over(upto)
    rows = rows.withColumns(local).join(cells, names)

    new = {}
    if row_number:
        new[row_number] = F.col("__skip") + F.col("__rn")
    if row_number_desc:
        new[row_number_desc] = F.col("__total") - F.col("__skip") - F.col("__rn") + 1
    if total:
        new[total] = F.col("__total")
    for name, src in lag.items():
        new[name] = F.when(F.col("__rn") == 1, F.col("__prev")[src]).otherwise(F.col(f"__lag_{name}"))
    for name, src in lead.items():
        new[name] = F.when(F.col("__rn") == F.col("__n"), F.col("__next")[src]).otherwise(F.col(f"__lead_{name}"))
    for name in running_max:
        new[name] = F.greatest(f"__max_{name}", f"__run_{name}")
    for name in coming_min:
        new[name] = F.least(f"__min_{name}", f"__low_{name}")
    for name in running_sum:
        before_sum, here = F.col(f"__sum_{name}"), F.col(f"__cum_{name}")
        new[name] = F.coalesce(before_sum + here, before_sum, here)
    for name in [*key_sum, *key_max]:
        new[name] = F.col(f"__key_{name}")
    kept = [c for c in columns if c not in new]
    return rows.select(*kept, *[c.alias(name) for name, c in new.items()])
