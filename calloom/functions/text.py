"""Text expressions: labelled fields, phone numbers, opening hours, rule flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A telephone number in a form text, and an international number of up to four digit groups.
PHONE_CHARSET = "+0-9"
SPACED_PHONE = r"(\+[0-9]*(?: *[0-9]+){0,3})"
CLOCK = r"^([01][0-9]|2[0-3]):[0-5][0-9]$"


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Captured text of the first match, null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def extract_after_label(text: Column, label: str, charset: str = PHONE_CHARSET) -> Column:
    """The run of ``charset`` characters right after ``label`` and one space."""
    return first_match(text, rf"\Q{label}\E ([{charset}]+)")


def normalise_phone(phone: Column, source: Column | None = None,
                    spaced: str = "aircall", plain: str = "aspect") -> Column:
    """Join the digit groups of an international number.

    With ``source``, only numbers of the ``spaced`` source are joined; the ``plain`` source already
    writes them without spaces; any other source has no usable number.
    """
    joined = F.regexp_replace(first_match(phone, SPACED_PHONE), " +", "")
    if source is None:
        return joined
    return F.when(source == plain, phone).when(source == spaced, joined)


def clock_seconds(text: Column) -> Column:
    """``hh:mm`` as seconds of day, null where the text is no such time."""
    hours, minutes = F.substring(text, 1, 2), F.substring(text, 4, 2)
    return F.when(text.rlike(CLOCK), hours.cast("int") * 3600 + minutes.cast("int") * 60)


def parse_slots(df: DataFrame, columns: Mapping[str, str], max_slots: int = 2) -> DataFrame:
    """Opening-hour texts ``hh:mm-hh:mm, hh:mm-hh:mm`` as seconds of day.

    ``columns`` maps an output prefix to the text column. Adds ``<prefix>_<slot>_start`` and ``_end``;
    a slot that is absent or unreadable is null.
    """
    parsed = {}
    for prefix, name in columns.items():
        slots = F.split(F.col(name), ", ")
        for slot in range(max_slots):
            text = F.get(slots, F.lit(slot))
            parsed[f"{prefix}_{slot + 1}_start"] = clock_seconds(F.substring(text, 1, 5))
            parsed[f"{prefix}_{slot + 1}_end"] = clock_seconds(F.substring(text, 7, 5))
    return df.withColumns(parsed)


def slot_minutes(prefix: str, max_slots: int = 2) -> Column:
    """Open minutes over the slots of one day; an incomplete slot counts 0."""
    total = F.lit(0)
    for slot in range(1, max_slots + 1):
        start, end = F.col(f"{prefix}_{slot}_start"), F.col(f"{prefix}_{slot}_end")
        total = F.try_add(total, F.coalesce(F.floor((end - start) / 60), F.lit(0)).cast("int"))
    return total


def ends_with_any(text: Column, endings: Sequence[str]) -> Column:
    """Whether the text ends with one of the given endings; null text is false."""
    hit = F.lit(False)
    for ending in endings:
        hit = hit | F.coalesce(text.like(f"%{ending}"), F.lit(False))
    return hit


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def rule_flags(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One 0/1 column per named rule."""
    return df.withColumns({name: flag(rule) for name, rule in rules.items()})
