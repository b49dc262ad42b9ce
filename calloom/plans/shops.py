"""Shop dimension and the alert on shops whose calendars are blocked."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from calloom.functions.calendar import day_name
from calloom.functions.text import parse_slots, slot_minutes
from calloom.operators.shops import by_weekday, enrich_dim, utilisation_flag
from calloom.sources import Tables

# dayofweek number (1 = Sunday) of the days on which shops open
OPEN_DAYS = {2: "monday", 3: "tuesday", 4: "wednesday", 5: "thursday", 6: "friday", 7: "saturday"}


def shop_dimension(tables: Tables, excluded_lead: str | None = None, inactive_text: str = "%inaktiv%",
                   extra_flags: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per shop: address, opening slots in seconds of day, status, pilot and exclusion flags.

    Pilot shops under the district lead ``excluded_lead`` are excluded too. ``extra_flags`` adds further
    0/1 rules over the shop columns.
    """
    slots = {f"{day}_open_time": f"{day}_open_time" for day in OPEN_DAYS.values()}
    shops = parse_slots(tables["dim_shop_overview"], slots).drop(*slots.values())
    led = F.lit(False) if excluded_lead is None else F.col("district_lead") == excluded_lead
    rules = {
        "full_address": F.concat("address", F.lit(" "), "postal_code", F.lit(" "), "city"),
        "active_status": F.when(F.lower("active_status").like(inactive_text), "Inactive").otherwise("Active"),
        "pilot_shop_flag": F.when(F.col("member"), 1).otherwise(0),
        "excluded_shop_flag": F.when(F.col("__excluded") == 1, 1).when(F.col("member") & led, 1).otherwise(0),
    }
    rules |= {name: F.when(rule, 1).otherwise(0) for name, rule in (extra_flags or {}).items()}
    pilots = tables["dim_pilot_shop"].select("shop_id", F.col("excluded_shop_flag").alias("__excluded"))
    return enrich_dim(shops, pilots, "shop_id", rules)


def blocker_alert(tables: Tables, shop_dim: DataFrame, test_lead: str = "Test, Test") -> DataFrame:
    """Per shop and calendar date: open and blocked minutes, and whether over half the capacity is blocked."""
    shops = shop_dim.filter((F.col("district_lead") != test_lead) & (F.col("active_status") == "Active"))
    minutes = {f"{day}_minutes": slot_minutes(f"{day}_open_time") for day in OPEN_DAYS.values()}
    shops = shops.select(
        "shop_id", "district_lead", "region_lead", *[m.alias(name) for name, m in minutes.items()])
    entries = tables["fact_shop_calendar_entry_summary"].join(shops, "shop_id")
    on_day = by_weekday(F.col("entry_date"), {number: f"{day}_minutes" for number, day in OPEN_DAYS.items()})
    rows = entries.select(
        "shop_id", "district_lead", "region_lead", "entry_date", day_name(F.col("entry_date")).alias("entry_weekday"),
        on_day.alias("open_duration"), "blocker_duration", "customer_service_duration", "num_studios_in_use",
        "num_studios",
    ).distinct()
    studios, opened = F.col("num_studios"), F.col("open_duration")
    return rows.withColumns({
        "total_open_duration": F.try_multiply(studios, opened),
        "share_blocked_weighed_50_flag": utilisation_flag(F.col("blocker_duration"), studios, opened, 0.5),
    })
