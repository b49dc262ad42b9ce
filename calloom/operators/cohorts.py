"""Event funnels, cohort dates, triggers and conversion credit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from calloom.functions.text import first_match
from calloom.operators.keyed import Key, attach
from calloom.operators.ordered import ordered


def prop(props: str, key: str) -> Column:
    """Greatest value of the entries with ``key`` in an array of (key, value) structs."""
    return F.array_max(F.transform(F.filter(props, lambda entry: entry["key"] == key), lambda entry: entry["value"]))


def pivot_props(df: DataFrame, props: str, keys: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """One column per property key, filled with the greatest value seen for the key ``by``."""
    single = df.withColumns({f"__{name}": prop(props, key) for name, key in keys.items()})
    spread = attach(single, by, **{name: F.max(f"__{name}") for name in keys})
    return spread.drop(*[f"__{name}" for name in keys])


def funnel_stage(df: DataFrame, event: str, names: Mapping[str, tuple[int, str]], type_: str) -> DataFrame:
    """Rank and label an event by its name, and number its type by the trailing digit of the text (else 1).

    Adds ``email_event_rank``, ``email_event``, ``email_type_rank`` and the two "rank - text" forms. An
    event without a name in the map has neither rank nor label.
    """
    rank, label = None, None
    for name, (number, text) in names.items():
        hit = F.col(event) == name
        rank = F.when(hit, number) if rank is None else rank.when(hit, number)
        label = F.when(hit, text) if label is None else label.when(hit, text)
    digit = first_match(F.right(F.col(type_), F.lit(1)), "([0-9])")
    return df.withColumns({
        "email_event_rank": rank,
        "email_event": label,
        "email_type_rank": F.coalesce(digit.cast("int"), F.lit(1)),
    }).withColumns({
        "email_type_concat": F.concat(F.col("email_type_rank").cast("string"), F.lit(" - "), F.col(type_)),
        "email_event_concat": F.concat(
            F.col("email_event_rank").cast("string"), F.lit(" - "), F.col("email_event")),
    })


def cohort_date(df: DataFrame, by: Sequence[str], condition: Column, date: str,
                name: str = "cohort_date", source: DataFrame | None = None) -> DataFrame:
    """First date on which the condition held for the key, on every row of the key."""
    return attach(df, by, source, **{name: F.min(F.when(condition, F.col(date)))})


def rerun_cohort_date(df: DataFrame, by: Sequence[str], condition: Column, date: str, order: Sequence[str],
                      classic: str = "cohort_date", name: str = "cohort_date_alt",
                      source: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Cohort date of a repeated campaign run, and the classic one.

    The second date on which the condition held for the key (the first, if it held once), valid from the
    first such row on. Rows on or after that date get it, earlier ones the classic date, rows before the
    first such row none. ``order`` starts with ``date`` and is total per key. A row stands ``weight`` times.
    Rows without a date are none for which the condition holds.

    The first two of these rows tell both dates. Each task passes on two rows of a key, so a hot key is no window.
    """
    place, source = F.struct(*order), df if source is None else source
    key = Key(source, by)
    nth = F.row_number().over(Window.partitionBy(*key.names).orderBy("__place"))
    first_two = (
        key.on(source).filter(condition & F.col(date).isNotNull())
        .select(*key.names, place.alias("__place"), F.col(date).alias("__day"),
                (F.col(weight) if weight else F.lit(1)).alias("__weight"))
        .withColumn("__nth", nth).filter(F.col("__nth") <= 2)
    )
    first, last = F.min(F.struct("__nth", "__place", "__day", "__weight")), F.max(F.struct("__nth", "__day"))
    start = first_two.groupBy(*key.names).agg(first.alias("__first"), last["__day"].alias("__last")).select(
        *key.names, F.col("__first")["__place"].alias("__from"), F.col("__first")["__day"].alias("__day"),
        F.when(F.col("__first")["__weight"] > 1, F.col("__first")["__day"]).otherwise(F.col("__last")).alias("__rerun"),
    )
    rows = key.on(df).join(start, key.names, "left")
    carried = F.when(place >= F.col("__from"), F.col("__rerun"))
    value = F.when(F.col(date) >= carried, carried).when(F.col(date) < carried, F.col("__day"))
    return rows.withColumns({classic: F.col("__day"), name: value}).drop(*key.names, "__from", "__day", "__rerun")


def sequence_events(df: DataFrame, by: Sequence[str], order: Sequence[str], slices: Sequence[Column],
                    asc: str = "user_event_rank_asc", desc: str = "user_event_rank_desc",
                    weight: str | None = None) -> DataFrame:
    """Number the rows of a key from the first and from the last.

    A row that stands ``weight`` times is unfolded at the end: ranks are running sums of weights, so copies never
    meet each other. ``weight`` is then not in the result.
    """
    if weight is None:
        return ordered(df, by, order, slices, row_number=asc, row_number_desc=desc)
    rows = ordered(df, by, order, slices, running_sum={"__upto": weight}, key_sum={"__all": weight})
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(weight).cast("long"))))
    number = F.col("__upto") - F.col(weight) + F.col("__copy")
    return rows.withColumns({asc: number, desc: F.col("__all") - number + 1}).drop(weight, "__upto", "__all", "__copy")


def trigger_dates(df: DataFrame, triggers: Mapping[str, Column], by: Sequence[str], date: str,
                  order: Sequence[str], slices: Sequence[Column], next_date: str | None = None) -> DataFrame:
    """Per trigger: its date on rows that are triggers, and the date on the next row (null if that is none).

    Adds ``<name>_trigger_event_date`` and ``next_<name>_trigger_event_date``; ``next_date`` names a column
    for the date of the next row of any kind.
    """
    marks = {f"{n}_trigger_event_date": F.when(p, F.col(date)) for n, p in triggers.items()}
    marked = df.withColumns(marks)
    following = {f"next_{n}_trigger_event_date": f"{n}_trigger_event_date" for n in triggers}
    if next_date:
        following[next_date] = date
    return ordered(marked, by, order, slices, lead=following)


def attribute_conversion(trigger: str, next_trigger: str, target: str, days: int = 30) -> Column:
    """1 if the target date falls between the trigger and the next one, or, without a next trigger, on or
    after the trigger and at most ``days`` later."""
    start, end, hit = F.col(trigger), F.col(next_trigger), F.col(target)
    bounded = start.isNotNull() & end.isNotNull() & hit.between(start, end)
    open_ended = end.isNull() & (hit >= start) & (F.datediff(hit, start) <= days)
    return F.when(bounded | open_ended, 1).otherwise(0)


def single_credit(df: DataFrame, flag: str, by: Sequence[str], order: Sequence[str | Column],
                  name: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """Leave the flag on one row per key: the greatest in ``order`` among the flagged rows."""
    place = F.struct(*order)
    best = attach(df, by, source, __best=F.max(F.when(F.col(flag) == 1, place)))
    credited = F.when((F.col(flag) == 1) & (place == F.col("__best")), 1).otherwise(0)
    return best.withColumn(name or flag, credited).drop("__best")
