"""Mixing sources to target weights: token weights are raked to marginals, then documents are sampled.

Iterative proportional fitting runs on the cells of a table, the token sums by source, language and topic; a sweep scales
all cells of each source to the source's target, then languages, then topics. ``SWEEPS`` sweeps are done, in parts that are
staged in the shared folder. A document's chance is its cell's weight per token, scaled so that the tokens expected in
the sample are ``BUDGET`` of all, with chances held to 1; the scale is found by a few sums over the cells. A document is
kept if a uniform number made of its id's MD5 is below its chance, so the same documents are kept in every run.

All of it is DataFrame functions. Rows are summed per cell before the shuffle; the join back is by cell, where Spark
splits a cell that holds a third of all rows if the table of cells is too large to broadcast.

Targets are shares by value. Where none are given, they are the shares found, raised to ``TEMPER`` and scaled to sum to 1,
which takes from large groups and gives to small ones. Defined cases: null sources, languages and ids are values of
their own; a value that given targets leave out has target 0, and its documents are not sampled; targets of values
that do not occur are left out; texts without words weigh nothing and share their cell's chance; a cell without tokens
has chance 0; an empty table gives an empty result; repeated ids share their fate; input columns named like a result
are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from calloom.llm.common import words
from calloom.session import stage

DIMENSIONS = ("source", "lang", "topic")
SWEEPS, STAGED_SWEEPS = 12, 4
TEMPER = 0.5
BUDGET = 0.7

#: Topics by what a text holds: the first that applies.
TOPICS = {"legal": ("icensed under", "rights reserved"), "table": (" | ",), "contact": ("@",), "shout": ("!! ",)}
OTHER_TOPIC = "prose"


def topic(text: Column) -> Column:
    """A plain rule for the topic of a text; any other column can be given instead."""
    found = F.lit(OTHER_TOPIC)
    for name, marks in reversed(TOPICS.items()):
        held = F.lit(False)
        for mark in marks:
            held = held | F.contains(text, F.lit(mark))
        found = F.when(F.coalesce(held, F.lit(False)), F.lit(name)).otherwise(found)
    return found


def _total(frame: DataFrame, value: Column) -> float:
    return float(frame.agg(F.sum(value)).first()[0] or 0.0)


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """Adds ``weight`` to cells (source, lang, topic, tokens): tokens scaled to the targets, in shares of 1."""
    total = _total(cells, F.col("tokens"))
    frame = cells.withColumn("weight", F.col("tokens") / F.lit(total or 1.0))
    for name in DIMENSIONS:
        given = (targets or {}).get(name)
        if given is None:
            shares = cells.groupBy(name).agg((F.sum("tokens") / F.lit(total or 1.0)).alias("share"))
            norm = _total(shares, F.pow("share", F.lit(TEMPER)))
            share = F.sum("weight").over(Window.partitionBy(name))
            goal = F.pow(share, F.lit(TEMPER)) / F.lit(norm or 1.0)
        else:
            found = {row[0] for row in cells.select(name).filter(F.col(name).isin(list(given))).distinct().collect()}
            used = {value: share for value, share in given.items() if value in found}
            norm = sum(used.values()) or 1.0
            goal = F.lit(0.0)
            for value, share in used.items():
                goal = F.when(F.col(name) == value, F.lit(share / norm)).otherwise(goal)
        frame = frame.withColumn(f"__{name}", goal)
    frame = stage(frame)
    for first in range(0, sweeps, STAGED_SWEEPS):
        for _ in range(min(STAGED_SWEEPS, sweeps - first)):
            for name in DIMENSIONS:
                now = F.sum("weight").over(Window.partitionBy(name))
                scaled = F.when(now > 0, F.col("weight") * F.col(f"__{name}") / now).otherwise(F.lit(0.0))
                frame = frame.withColumn("weight", scaled)
        frame = stage(frame)
    return frame.drop(*(f"__{name}" for name in DIMENSIONS))


def calibrate(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Adds ``probability`` to raked cells: weight per token, scaled to ``budget`` of all tokens, 1 at most."""
    cells = cells.withColumn("__rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0)))
    wanted = budget * _total(cells, F.col("tokens"))
    scale, certain = 0.0, -1
    while True:
        # cells whose chance is 1 at this scale give all their tokens; the others share the rest
        full = F.col("__rate") * scale >= 1
        sums = cells.agg(
            F.count_if(full), F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0))
        ).first()
        if sums[0] <= certain or not sums[2]:
            break
        certain, scale = sums[0], max(wanted - float(sums[1]), 0.0) / sums[2]
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("__rate") * scale)).drop("__rate")


def uniform(key: Column) -> Column:
    """A number in [0, 1) made of a key's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double") / 16**13


def mix(
    docs: DataFrame, key: str = "doc_id", targets: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET
) -> DataFrame:
    """Adds probability and kept to rows with source, lang, topic and n_tokens."""
    docs = docs.drop("probability", "kept")
    cells = docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    chances = stage(calibrate(rake(stage(cells), targets), budget).select(*DIMENSIONS, "probability"))
    cell = chances.select(*(F.col(name).alias(f"__{name}") for name in DIMENSIONS), "probability")
    same = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in DIMENSIONS]
    joined = docs.join(cell, same, "left").drop(*(f"__{name}" for name in DIMENSIONS))
    return joined.withColumn("kept", uniform(F.col(key)) < F.col("probability"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds topic and n_tokens (words) of each whole text."""
    docs = docs.drop("topic", "n_tokens")
    return docs.withColumns({"topic": topic(F.col(text)), "n_tokens": F.size(words(F.col(text))).cast("long")})


def oracle_sql(sweeps: int = SWEEPS, budget: float = BUDGET) -> str:
    """The same in SQL, with the scale found by sums over cells in order of their rates."""
    held = " ".join(
        f"when {' or '.join(f'contains(text, {mark!r})' for mark in marks)} then '{name}'" for name, marks in TOPICS.items()
    )
    steps = [
        f"""d as (select doc_id, source, lang, case {held} else '{OTHER_TOPIC}' end as topic,
            cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as n_tokens from documents)""",
        "w0 as (select source, lang, topic, sum(n_tokens) as tokens, "
        "sum(n_tokens) / (select sum(n_tokens) from d) as weight from d group by all)",
    ]
    for name in DIMENSIONS:
        steps.append(
            f"g_{name} as (select {name}, pow(s, {TEMPER}) / sum(pow(s, {TEMPER})) over () as goal "
            f"from (select {name}, sum(weight) as s from w0 group by {name}))"
        )
    last = "w0"
    for sweep in range(sweeps):
        for name in DIMENSIONS:
            this = f"w{sweep + 1}_{name}"
            steps.append(
                f"{this} as (select w.* replace (weight * g.goal / sum(weight) over (partition by w.{name}) as weight) "
                f"from {last} w join g_{name} g on w.{name} is not distinct from g.{name})"
            )
            last = this
    steps += [
        f"r as (select *, weight / tokens as rate from {last} where tokens > 0)",
        """c as (select *, coalesce(sum(tokens) over before, 0) as full_tokens, 1 - coalesce(sum(weight) over before, 0) as left_weight
            from r window before as (order by rate desc, source, lang, topic rows between unbounded preceding and 1 preceding))""",
        f"""s as (select max(scale) as scale from (
            select rate, ({budget} * (select sum(tokens) from r) - full_tokens) / left_weight as scale from c) where rate * scale < 1)""",
    ]
    return f"""with {', '.join(steps)}
        select doc_id, d.source, d.lang, d.topic, n_tokens, round(least(1.0, rate * (select scale from s)), 6) as probability,
               cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 13) as bigint) / 16.0 ** 13
                   < least(1.0, rate * (select scale from s)) as kept
        from d join r on d.source is not distinct from r.source and d.lang is not distinct from r.lang and d.topic = r.topic"""
