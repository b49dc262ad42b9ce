"""Daily figures per agent of the contact centre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from calloom.functions.calendar import Date, as_date, iso_week, month_key, seconds_of_day, within
from calloom.operators.attribution import cancelled, interval_conversions
from calloom.operators.forecast import mask_to_window, trailing_rate
from calloom.operators.keyed import conditional_counts, pick_by, with_totals
from calloom.operators.ordered import ordered
from calloom.operators.snapshots import dedupe_status, first_version, reset_after
from calloom.operators.spine import MONTH, entity_spine, pack_months
from calloom.plans import vocabulary as v
from calloom.session import stage, stage_of
from calloom.sources import Tables

APPOINTMENTS_PER_HOUR_TARGET = 0.8


def worked_hours(workforce: DataFrame) -> DataFrame:
    """Planned, worked and sick hours per agent and date."""
    hours, type_ = F.col("day_productivity_hours"), F.col("type")
    rows = conditional_counts(
        workforce, ["date", "employee"],
        sums={"planned_hours": (F.lit(True), hours), "worked_hours": (type_ == "Presence", hours),
              "sickness_hours": ((type_ == "Absence") & (F.col("absence_type") == "Sick"), hours)})
    return rows.withColumnRenamed("employee", "agent_name")


def call_counts(tables: Tables, performance: DataFrame) -> DataFrame:
    """Calls per agent and date, outbound ones also by type of the tickets they were made for.

    A call counts once per ticket it belongs to. The tickets are counted per call before the join.
    """
    call = ["call_id", "call_date", "call_start_time"]
    types = {f"__{name}": F.col("ticket_type") == text for name, text in v.TICKET_TYPES.items()}
    tickets = conditional_counts(
        performance.dropna(subset=call), call, counts={"__tickets": F.lit(True), **types})
    rows = tables["fact_call_main"].join(tickets, call, "left")
    times = F.coalesce("__tickets", F.lit(1))
    known, out = F.col("call_id").isNotNull(), F.col("call_type") == "Outbound"
    inbound = F.sum(F.when(known & (F.col("call_type") == "Inbound"), times))
    rows = stage(rows.select("agent_name", "call_date", "call_id", "call_type", "call_total_time", "__tickets", *types))
    zero = F.lit(0).cast("long")
    return rows.groupBy("agent_name", F.col("call_date").alias("date")).agg(
        F.coalesce(inbound, zero).alias("num_inbound_calls"),
        F.coalesce(F.sum(F.when(known & out, times)), zero).alias("num_outbound_calls"),
        *[
            F.coalesce(F.sum(F.when(out, F.col(f"__{name}"))), zero).alias(f"num_outbound_calls_{name}")
            for name in v.TICKET_TYPES
        ],
        F.sum(F.when(out, F.col("call_total_time") * times)).alias("call_duration_outbound_calls"),
    )


def booked_appointments(tables: Tables) -> DataFrame:
    """Appointments that count: one per customer, date and shop, and per customer a year apart.

    A ticket's appointment starts with its first update; customer, date and shop are those of its last.
    An appointment is credited to the agent of its first update. Columns: customer, agent, start, date,
    time (seconds of day), shop, and start of the customer's next counted appointment.
    """
    updates = tables["fact_ticket_update"].filter(
        (F.col("test_flag") == 0) & (F.col("lead_flag") == 1)
        & F.col("contact_reason").isin(*v.APPOINTMENT_REASONS)
        & F.col("appointment_date").isNotNull() & F.col("customer_id").isNotNull() & (F.col("agent_name") != "")
    ).withColumn("appointment_time", seconds_of_day(F.col("appointment_start_time")))
    order = ["updated_at", "created_at", "agent_name", "customer_id", "appointment_date", "appointment_time", "shop_id"]
    tickets = updates.groupBy("zendesk_ticket_id").agg(
        pick_by(order, ["updated_at", "agent_name", "appointment_time"]).alias("first"),
        pick_by(order, ["customer_id", "appointment_date", "shop_id"], last=True).alias("last"),
    ).select(
        "zendesk_ticket_id", "first.updated_at", "first.agent_name", "first.appointment_time",
        F.to_date("first.updated_at").alias("appointment_start"),
        "last.customer_id", "last.appointment_date", "last.shop_id")
    # without a shop there is no appointment id, and all such tickets share one
    id_ = F.concat(F.col("customer_id").cast("string"), F.lit("-"), F.col("appointment_date").cast("string"),
                   F.lit("-"), F.col("shop_id").cast("string"))
    booked = first_version(
        tickets.withColumn("appointment_id", id_), ["appointment_id"], ["updated_at", "zendesk_ticket_id"])
    line, month = ["appointment_start", "zendesk_ticket_id"], [F.trunc("appointment_start", "month")]
    counted = reset_after(booked, ["customer_id"], "appointment_start", 12, line, month)
    counted = counted.filter(F.col("accepted_flag") == 1)
    counted = ordered(counted, ["customer_id"], line, month, lead={"next_valid_appointment_created_date": "appointment_start"})
    return counted.drop("accepted_flag", "appointment_id", "updated_at", "zendesk_ticket_id")


def appointment_outcomes(tables: Tables) -> DataFrame:
    """Customers per agent and date of booking: appointments, cancellations, no-shows, screenings, sales."""
    booked = stage(booked_appointments(tables))
    slot = ["customer_id", "appointment_date", "appointment_time"]
    result, raw = F.col("contact_result"), F.col("contact_reason_raw")
    noted = tables["fact_ticket_update"].filter(
        (F.col("test_flag") == 0) & (F.col("qualified_flag") == 1)
        & F.col("appointment_date").isNotNull() & F.col("customer_id").isNotNull()
    ).groupBy("customer_id", "appointment_date",
              seconds_of_day(F.col("appointment_start_time")).alias("appointment_time")).agg(
        F.max(cancelled(result, v.CANCELLED_RESULTS, raw, v.CANCELLED_TEXT)).alias("__noted"))
    kept = tables["fact_appointment_main"].filter(
        (F.col("post_lead_flag") == 1) & (F.col("appointment_type") == v.SALES_APPOINTMENT)
    ).groupBy("customer_id", "appointment_date",
              seconds_of_day(F.col("appointment_start_time")).alias("appointment_time"), "shop_id").agg(
        F.max("cancelled_flag").alias("__cancelled"), F.max("no_show_flag").alias("__no_show"))
    group = ["customer_id", "agent_name", "appointment_start", "next_valid_appointment_created_date"]
    called_off = F.when((F.col("__cancelled") == 1) | (F.col("__noted") == 1), 1).otherwise(0)
    rows = stage(
        booked.join(noted, slot, "left").join(kept, [*slot, "shop_id"], "left")
        .groupBy(*group).agg(F.max(called_off).alias("cancelled_flag"), F.max("__no_show").alias("no_show_flag"))
    )
    span = ("customer_id", "appointment_start", "next_valid_appointment_created_date")
    screenings = tables["fact_screening_main"].filter(F.col("post_lead_flag") == 1)
    rows = stage(interval_conversions(
        rows, screenings, *span, "screening_date", maxima={"has_qscreen": "qualified_flag"}))
    sales = tables["fact_sales_main"].filter((F.col("post_lead_flag") == 1) & (F.col("hea_quantity_invoiced") > 0))
    rows = interval_conversions(rows, sales, *span, "first_invoice_date", flag="has_sale",
                                sums={"cus_net_sales_hea_only": "total_net_sales_hea_in_eur"})
    # counted appointments of a customer start on different dates, so rows are customers here
    return rows.groupBy("agent_name", F.col("appointment_start").alias("date")).agg(
        F.count("customer_id").alias("num_cust_sched_app"),
        F.count(F.when(F.col("cancelled_flag") == 1, 1)).alias("num_cust_cancellation"),
        F.count(F.when(F.col("no_show_flag") == 1, 1)).alias("num_cust_no_show"),
        F.count(F.when(F.col("has_qscreen") == 1, 1)).alias("num_cust_qscreen"),
        F.count(F.when(F.col("has_sale") == 1, 1)).alias("num_cust_sale"),
        F.sum("cus_net_sales_hea_only").alias("cus_net_sales_hea_only"),
    )


def daily_facts(tables: Tables, performance: DataFrame, workforce: DataFrame) -> DataFrame:
    """Hours, calls and outcomes on one row per agent and date with any of them."""
    parts = [lambda: worked_hours(workforce), lambda: call_counts(tables, performance), lambda: appointment_outcomes(tables)]
    # one after the other, so that the disk holds the shuffle files of one at a time
    hours, calls, outcomes = (stage_of(tables.spark, part) for part in parts)
    rows = hours.unionByName(calls, allowMissingColumns=True).unionByName(outcomes, allowMissingColumns=True)
    measures = [c for c in rows.columns if c not in ("agent_name", "date")]
    return rows.groupBy("agent_name", "date").agg(*[F.sum(c).alias(c) for c in measures])


def agent_performance(tables: Tables, performance: DataFrame, workforce: DataFrame, as_of: Date,
                      start: Date = "2019-08-01") -> DataFrame:
    """One row per date and agent master row, from ``start`` to the day before ``as_of``.

    Totals and trailing rates are taken before superfluous master rows are left out. Agents by dates are many rows and most
    of them empty, so they are never shuffled: facts are packed by agent and month, what holds for an agent or a team is
    joined to the master rows, what holds for a month to the packed facts, and only then the months spread into dates.
    """
    spark, last = tables.spark, F.date_sub(as_date(as_of), 1)
    masters = tables["dim_agent_main"].select(
        F.concat("first_name", F.lit(" "), "last_name").alias("agent_name"), F.col("email").alias("agent_email"),
        F.col("status").alias("agent_status"), F.col("team").alias("agent_team")).distinct()
    names = masters.filter((F.col("agent_status") != "Exclude") & F.col("agent_name").isNotNull()).select(
        "agent_name").distinct()
    # an agent's master rows are the same on every date
    masters = stage(dedupe_status(
        names.join(masters, "agent_name"), ["agent_name"], "agent_name", "agent_status",
        ["agent_email", "agent_team", "agent_status"]))
    facts = stage_of(spark, lambda: pack_months(
        stage(daily_facts(tables, performance, workforce)), "agent_name").withColumn(
        "reporting_month", month_key(F.col(MONTH))))

    def on_dates(entities: DataFrame, packed: DataFrame, first: Date | Column = start) -> DataFrame:
        rows = entity_spine(entities, first, last, facts=packed.drop("reporting_month"), on="agent_name")
        return rows.withColumns({"reporting_week": iso_week(F.col("date")), "reporting_month": month_key(F.col("date"))})

    days = on_dates(masters, facts)
    facts = stage_of(spark, lambda: with_totals(facts, {
        "worked_hours_month": (["reporting_month", "agent_name"], "worked_hours")}, source=days))

    grains = {"": [], "_team": ["agent_team"], "_agent": ["agent_name"]}
    prefix = "rolling_average_"
    recent = {f"{prefix}outbound_calls_hour": ("num_outbound_calls", "worked_hours"),
              f"{prefix}num_cus_appointment_hour": ("num_cust_sched_app", "worked_hours")}
    settled = {f"{prefix}qualified_screening_ratio": ("num_cust_qscreen", "num_cust_sched_app"),
               f"{prefix}qualified_screening_sales_ratio": ("num_cust_sale", "num_cust_qscreen")}
    shown: dict[str, Column] = {}
    rated = masters
    for rates, oldest, newest in ((recent, 29, 0), (settled, 50, 22)):
        inside = within(F.col("date"), as_of, oldest, newest)
        window = on_dates(masters, facts, F.greatest(as_date(start), F.date_sub(as_date(as_of), oldest)))
        rated = trailing_rate(rated, rates, inside, grains, source=window,
                              zero=[f"{prefix}qualified_screening_sales_ratio_agent"])
        shown |= {f"{name}{suffix}": inside for name in rates for suffix in grains}
    rated = stage(rated)

    rows = on_dates(rated.filter(F.col("exclude_data_flag") == 0), facts)
    rows = with_totals(rows, {
        "num_cust_sched_app_total": (["date"], "num_cust_sched_app"),
        "num_cust_qscreen_total": (["date"], "num_cust_qscreen"),
        "num_cust_sale_total": (["date"], "num_cust_sale"),
        "worked_hours_total": (["date"], "worked_hours"),
    }, source=days, keep=stage)
    for name, inside in shown.items():
        rows = mask_to_window(rows, [name], inside)

    sums = [
        "call_duration_outbound_calls", "num_outbound_calls",
        *[f"num_outbound_calls_{name}" for name in v.TICKET_TYPES], "num_inbound_calls", "num_cust_sched_app",
        "num_cust_cancellation", "num_cust_no_show", "num_cust_qscreen", "num_cust_sale", "cus_net_sales_hea_only",
        "worked_hours", "worked_hours_month", "planned_hours", "sickness_hours", "num_cust_sched_app_total",
        "num_cust_qscreen_total", "num_cust_sale_total", "worked_hours_total",
    ]
    # facts are summed per agent and date, and master rows are distinct: each row is the only one of its date and master
    # row, hence the sum and the maximum of its group
    summed = rows.agg(*[F.sum(c).alias(c) for c in sums]).schema
    return rows.select(
        F.col("date").alias("reporting_date"), "reporting_week", "reporting_month", "agent_name", "agent_email",
        "agent_status", "agent_team", F.lit(APPOINTMENTS_PER_HOUR_TARGET).alias("num_cust_sched_app_hour_target"),
        *[F.col(field.name).cast(field.dataType) for field in summed], *shown)
