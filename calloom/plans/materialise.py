"""All reports written out in the order in which they read each other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from calloom.functions.calendar import Date
from calloom.plans.agent_performance import agent_performance
from calloom.plans.call_performance import call_performance
from calloom.plans.capacity_plan import capacity_plan
from calloom.plans.crm import crm_events, crm_report
from calloom.plans.demand_forecast import demand_forecast
from calloom.plans.market_fit import market_fit
from calloom.plans.shops import blocker_alert, shop_dimension
from calloom.plans.vocabulary import AGENT_POSITION
from calloom.plans.workforce_days import workforce_days
from calloom.session import staged
from calloom.sources import Tables, duplicate_keys, read_report, refresh_report, write_report


#: Reports with a row grain of one date or finer, and their date column: what ``refresh`` rewrites by date.
DATES = {
    "workforce_days": "date", "call_performance": "ticket_date", "agent_performance": "reporting_date",
    "demand_forecast": "date", "market_fit": "date",
}
#: Tables that the forecast joins by date or week and takes as they are, and their keys.
PLANNED = {
    "fact_ccc_shrinkage_actuals": "date", "fact_planned_ccc_staffing": "reporting_week",
    "fact_planned_marketing_spend": "date", "fact_planned_ccc_productivity_shrinkage": "reporting_week",
}


def materialise(tables: Tables, folder: str, as_of: Date, start: Date = "2019-08-01",
                gaps: Sequence[tuple[Date, Date]] = (), shop_options: Mapping | None = None,
                excluded_campaign: str | None = None, forecast_start: Date = "2020-09-01",
                forecast_months: int = 12, ahead_days: int = 180, country: str = "DE",
                position: str = AGENT_POSITION, capacity_days: int = 30, refresh: bool = False,
                unique_plans: bool = False) -> dict[str, DataFrame]:
    """Write the ten reports under ``folder`` and return them as read back.

    A report built on another reads the written table, so each is computed once. ``start`` is where the agents' dates
    begin, ``forecast_start`` where those of the forecast do; ``ahead_days`` is how far positions are looked up ahead,
    for agents of one ``country`` and ``position``, and ``capacity_days`` how far the capacity plan goes. The reports of
    ``DATES`` are partitioned by date. Intermediate tables are removed as each report is done.

    With ``refresh``, those that are there already have only the dates rewritten whose rows changed
    (``sources.refresh_report``); the others are small or carry numbers along a whole user, and are written whole. With
    ``unique_plans``, a planned table with two rows for a date or week, which would double its days, is an error.
    """
    if unique_plans:
        double = duplicate_keys(tables, PLANNED).orderBy("table", "key").limit(10).collect()
        if double:
            raise ValueError("several rows for " + ", ".join(f"{row.key} in {row.table}" for row in double))
    done: dict[str, DataFrame] = {}

    def put(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        date, path = DATES.get(name), f"{folder}/{name}"
        with staged(tables.spark):
            report = build()
            if refresh and date:
                refresh_report(report, path, date)
            else:
                write_report(report, path, date)
        # a partition column is read back last
        done[name] = read_report(tables.spark, path, report.schema).select(*report.columns)
        return done[name]

    shops = put("shop_dimension", lambda: shop_dimension(tables, **(shop_options or {})))
    put("blocker_alert", lambda: blocker_alert(tables, shops))
    mails = put("crm_events", lambda: crm_events(tables))
    put("crm_report", lambda: crm_report(tables, mails))
    workforce = put("workforce_days", lambda: workforce_days(tables, as_of, start, ahead_days, country, position))
    calls = put("call_performance", lambda: call_performance(tables, gaps))
    put("agent_performance", lambda: agent_performance(tables, calls, workforce, as_of, start))
    forecast = put("demand_forecast", lambda: demand_forecast(
        tables, calls, as_of, forecast_start, forecast_months, excluded_campaign=excluded_campaign))
    put("capacity_plan", lambda: capacity_plan(tables, forecast, workforce, as_of, capacity_days, position))
    put("market_fit", lambda: market_fit(tables))
    return done
