"""CRM mail events and their conversions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from calloom.functions.calendar import age_days, monday_week, month_key
from calloom.operators.cohorts import (
    attribute_conversion, funnel_stage, rerun_cohort_date, sequence_events, single_credit,
    trigger_dates,
)
from calloom.operators.keyed import first_id, latest_of_type, lookup
from calloom.operators.ordered import id_range, ordered
from calloom.plans import vocabulary as v
from calloom.session import stage
from calloom.sources import Tables

EVENT_KEYS = ["user_email", "event_date", "event_timestamp", "event_type", "event_name"]


def values_of(entries: str, key: str):
    """All values of a key in an array of (key, value) structs."""
    return F.transform(F.filter(entries, lambda e: e["key"] == key), lambda e: e["value"])


def crm_events(tables: Tables) -> DataFrame:
    """One row per mail event of a user and mail type, with cohort dates and sequence numbers.

    An event has as many rows as its user properties and parameters make: per distinct parameter value one
    base row, repeated for every parameter of every event with the same user, time, type and name. These
    copies are carried as a weight, and unfolded once cohorts and sequence numbers are known.
    """
    mails = tables["events"].filter(F.col("event_category").isin(*v.MAIL_CATEGORIES)).select(
        "event_date", "event_timestamp", "event_name", "event_category", "event_type", "user_id",
        values_of("user_properties", "emailAddress").alias("emails"),
        values_of("user_properties", "firstName").alias("first_names"),
        values_of("user_properties", "lastName").alias("last_names"),
        F.transform("event_params", lambda p: F.when(p["key"] == "emailName", p["value"])).alias("mail_types"),
    )
    # events are matched by these keys, so an event without one of them has no row
    addressed = mails.select("*", F.explode("emails").alias("user_email")).dropna(subset=EVENT_KEYS)

    base = addressed.select(
        "event_date", "event_timestamp", "event_name", F.col("event_category").alias("crm_category"), "event_type",
        F.explode("mail_types").alias("email_type"), "user_email", F.col("user_id").alias("clang_uuid"),
    ).distinct()
    copies = addressed.groupBy(*EVENT_KEYS).agg(
        F.sum(F.size("mail_types") * F.size("emails")).alias("copies"),
        F.max(F.array_max("first_names")).alias("first_name"),
        F.max(F.array_max("last_names")).alias("last_name"),
    )
    names = copies.groupBy("user_email").agg(
        F.max("first_name").alias("user_first_name"), F.max("last_name").alias("user_last_name"))
    rows = base.join(copies.select(*EVENT_KEYS, "copies"), EVENT_KEYS)
    rows = rows.join(names, "user_email", "left").withColumn("activity_date", F.col("event_date").cast("date"))

    rows = stage(funnel_stage(rows, "event_name", v.MAIL_STAGES, "email_type"))
    order = ["activity_date", "email_type_rank", "email_event_rank", "clang_uuid", "event_timestamp", "event_type",
             "crm_category", "email_type", "event_name"]
    by, sent = ["user_email", "email_type"], F.col("email_event_rank") == 1
    rows = rerun_cohort_date(rows, by, sent, "activity_date", order, weight="copies")
    rows = sequence_events(rows, ["user_email"], order, [F.col(c) for c in order[:3]], weight="copies")
    return rows.select(
        "activity_date", "cohort_date", "cohort_date_alt", "crm_category", "event_type", "email_type_rank",
        "email_type", "email_type_concat", "email_event_rank", "email_event", "email_event_concat", "user_email",
        "user_first_name", "user_last_name", "clang_uuid", "user_event_rank_asc", "user_event_rank_desc",
    )


def crm_report(tables: Tables, events: DataFrame) -> DataFrame:
    """Mail events of the campaigns with lead age and the appointments and tests they led to."""
    type_, mail, day = F.col("event_type"), F.col("email_type"), F.col("activity_date")
    rows = events.filter(type_.isin(*v.APPOINTMENT_CAMPAIGNS) | (mail == v.TEST_REMINDER_MAIL))
    rows = rows.drop("cohort_date").withColumnRenamed("cohort_date_alt", "cohort_date")
    cohort = F.col("cohort_date")
    rows = rows.withColumns({
        "activity_reporting_week": monday_week(day),
        "activity_reporting_month": month_key(day),
        "cohort_reporting_week": monday_week(cohort),
        "cohort_reporting_month": month_key(cohort),
        "exclude_data_flag": F.when(cohort.isNull(), 0).otherwise(1),
        "days_sent_to_open": F.when(F.col("email_event_rank") == 2, F.datediff(day, cohort)),
        "days_sent_to_clicked": F.when(F.col("email_event_rank") == 3, F.datediff(day, cohort)),
    })
    slices = [id_range("user_event_rank_asc")]
    # within a date the event number already orders by type rank, event rank and user id
    mails = rows
    rows = ordered(rows, ["user_email", "activity_date"], ["user_event_rank_asc"], slices,
                   row_number_desc="user_event_date_rank_desc")
    rows = trigger_dates(
        rows,
        {"oht": mail.isin(*v.TEST_MAILS) | (type_ == v.RETARGET_CAMPAIGN),
         "appointment": type_.isin(*v.APPOINTMENT_CAMPAIGNS)},
        ["user_email"], "activity_date", ["user_event_rank_asc"], slices, next_date="next_email_event_date",
    )

    # a lead known under several e-mails counts once per date: the e-mail is not reported
    leads = tables["fact_lead_main"].select(
        F.col("uuid").alias("clang_uuid"), F.to_date("lead_date").alias("lead_date"))
    leads = lookup(leads, ["clang_uuid", "lead_date"], "clang_uuid")
    tickets = tables["fact_ticket_main"].filter(
        (F.col("test_flag") == 0) & ~F.col("contact_result").isin(*v.UNUSABLE_RESULTS))
    customers = first_id(tickets.withColumnRenamed("email", "user_email"), "user_email", "customer_id")
    scheduled = latest_of_type(
        tables["fact_appointment_main"], "appointment_type", v.SALES_APPOINTMENT, "customer_id",
        "appointment_created_at", "last_created")
    scheduled = scheduled.select("customer_id", F.to_date("last_created").alias("last_appointment_scheduled_date"))
    tests = tables["fact_oht_results"].filter(F.col("oht_test_rank_desc") == 1).select(
        F.col("email").alias("user_email"), F.col("date_created").alias("oht_date")).distinct()

    rows = (
        rows.join(leads, "clang_uuid", "left")
        .join(customers, "user_email", "left")
        .join(scheduled, "customer_id", "left")
        .join(tests, "user_email", "left")
    )
    rows = rows.withColumns({
        "lead_age_days": age_days(cohort, F.col("lead_date")),
        "post_crm_appointment_flag": attribute_conversion(
            "appointment_trigger_event_date", "next_appointment_trigger_event_date", "last_appointment_scheduled_date"),
        "post_crm_oht_flag": attribute_conversion(
            "oht_trigger_event_date", "next_oht_trigger_event_date", "oht_date"),
    })
    latest = ["activity_date", -F.col("user_event_date_rank_desc"), "lead_date", "oht_date", "user_event_rank_asc"]
    rows = flagged = stage(rows)
    for flag in ("post_crm_appointment_flag", "post_crm_oht_flag"):
        rows = single_credit(rows, flag, ["user_email"], latest, source=flagged)
    to_scheduled = F.when(
        F.col("post_crm_appointment_flag") == 1, F.datediff("last_appointment_scheduled_date", "cohort_date"))
    return rows.withColumn("days_sent_to_appointment_scheduled", to_scheduled).select(
        "activity_date", "crm_category", "event_type", "email_type_rank", "email_type", "email_type_concat",
        "email_event_rank", "email_event", "email_event_concat", "user_email", "user_first_name", "user_last_name",
        "clang_uuid", "user_event_rank_asc", "user_event_rank_desc",
        F.col("cohort_date").alias("cohort_date_alt"), "cohort_date", "activity_reporting_week",
        "activity_reporting_month", "cohort_reporting_week", "cohort_reporting_month", "next_email_event_date",
        "user_event_date_rank_desc", "exclude_data_flag", "days_sent_to_open", "days_sent_to_clicked", "lead_date",
        "lead_age_days", "customer_id", "last_appointment_scheduled_date", "oht_date", "post_crm_appointment_flag",
        "days_sent_to_appointment_scheduled", "post_crm_oht_flag",
    )
