"""Merging fact aggregates, allocating spend, recoding classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from calloom.operators.keyed import attach


def merge_facts(first: DataFrame, others: Mapping[str, DataFrame], keys: Sequence[str],
                chain: bool = False) -> DataFrame:
    """Merge fact aggregates that have one row per key combination.

    The result equals full outer joins of each other fact on the keys of ``first``: where ``first`` has the
    keys, all facts share one row; where it has not, each fact keeps a row of its own. Keys with a null
    never match. With ``chain`` facts also share a row where ``first`` lacks it.

    Instead of one shuffle per outer join, with all unmatched rows meeting on null keys, the facts are
    stacked and grouped once; groups that must not merge are unfolded again.
    """
    facts = {"__first": first, **others}
    measures = {name: [c for c in fact.columns if c not in keys] for name, fact in facts.items()}
    every = [c for columns in measures.values() for c in columns]
    stacked = None
    for name, fact in facts.items():
        part = fact.select(*keys, F.lit(1).alias(f"__in_{name}"), *measures[name])
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    present = [f"__in_{name}" for name in facts]
    # one row per key and fact, so max only picks the value
    groups = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in [*present, *every]])

    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    merged = complete if chain else complete & F.col("__in___first").isNotNull()

    def row(kept: Sequence[str]) -> Column:
        return F.struct(*[
            (F.col(c) if c in kept else F.lit(None).cast(groups.schema[c].dataType)).alias(c) for c in every
        ])

    alone = F.array(*[F.when(F.col(f"__in_{name}") == 1, row(columns)) for name, columns in measures.items()])
    unfolded = F.filter(alone, lambda r: r.isNotNull())
    rows = groups.select(*keys, F.explode(F.when(merged, F.array(row(every))).otherwise(unfolded)).alias("__row"))
    return rows.select(*keys, *[F.col("__row")[c].alias(c) for c in every])


def allocate(df: DataFrame, amounts: Sequence[str], weight: str, part: str, grains: Sequence[Sequence[str]],
             spend: str | None = None, shares: Sequence[str] = ()) -> DataFrame:
    """Split amounts that stand undivided on every ``part`` (e.g. device) of a group.

    ``grains`` are group columns from fine to coarse. An amount is split by the part's share of the weight
    in the first grain that has any weight, else equally over the parts that carry ``spend`` in the finest
    grain. The amount columns are replaced; ``shares`` names columns for the share per grain and the equal
    share, if they are wanted. Shares are aggregates joined back, so a large group is not
    gathered in one task.
    """
    spend = spend or amounts[0]
    rows = df
    for n, grain in enumerate(grains):
        rows = attach(rows, list(grain), df, **{f"__all{n}": F.sum(weight)})
        rows = attach(rows, [*grain, part], df, **{f"__part{n}": F.sum(weight)})
    carries = F.col(spend).isNotNull()
    rows = attach(rows, list(grains[0]), df, __parts=F.count_distinct(F.when(carries, F.col(part))))
    equal = F.when(carries, F.try_divide(F.lit(1), F.col("__parts")))
    ratios = [F.try_divide(f"__part{n}", f"__all{n}") for n in range(len(grains))]
    share = None
    for n, ratio in enumerate(ratios):
        known = F.col(f"__all{n}").isNotNull()
        share = F.when(known, ratio) if share is None else share.when(known, ratio)
    rows = rows.withColumns({"__share": share.otherwise(equal), **dict(zip(shares, [*ratios, equal]))})
    rows = rows.withColumns({c: F.col(c) * F.col("__share") for c in amounts})
    return rows.select(*df.columns, *shares)


def recode(column: Column, classes: Mapping[str, str]) -> Column:
    """Replace class names found in the map, keep the others."""
    chain = None
    for old, new in classes.items():
        chain = F.when(column == old, new) if chain is None else chain.when(column == old, new)
    return chain.otherwise(column) if chain is not None else column
