"""Spend, sessions, leads and sales by channel, campaign, form and device."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from calloom.functions.calendar import iso_week, month_key
from calloom.operators.keyed import count_ids, kpis_by_dim
from calloom.operators.marketing import allocate, merge_facts, recode
from calloom.operators.spine import each_class
from calloom.plans import vocabulary as v
from calloom.session import stage
from calloom.sources import Tables

GROUP = ["marketing_channel", "campaign", "lead_form_type", "lead_form_mode"]
KEYS = ["date", *GROUP, "device_type"]


def acquisition() -> dict:
    """The keys of a customer: how and when the customer was won."""
    source = {
        "marketing_channel": "acquisition_marketing_channel", "campaign": "acquisition_marketing_campaign",
        "lead_form_type": "acquisition_form_type", "lead_form_mode": "acquisition_form_mode",
        "device_type": "acquisition_device_type",
    }
    return {"date": F.to_date("first_lead_date"), **{name: F.col(src) for name, src in source.items()}}


def market_fit(tables: Tables) -> DataFrame:
    """One row per date, channel, campaign, form type, form mode and device, with spend split over devices."""
    qualified = F.col("qualified_flag") == 1
    lead_table = tables["uk_fact_lead_main"]
    leads = count_ids(lead_table.withColumnRenamed("lead_date", "date"), KEYS, "lead_id",
                      {"num_leads": None, "num_qualified_leads": qualified})
    spend = tables["uk_fact_daily_marketing_activity"].groupBy("date", *GROUP).agg(
        F.sum("marketing_costs_in_eur").alias("marketing_spend"), F.sum("num_clicks").alias("num_clicks"))
    spend = each_class(spend, lead_table, "device_type")
    pages = tables["uk_dim_landing_pages"].select("landing_page", "lead_form_type", "lead_form_mode")
    sessions = tables["uk_fact_session_main"].withColumn("device_type", recode(F.col("device_type"), v.DEVICE_CLASSES))
    sessions = sessions.filter(F.col("device_type").isin(*v.DEVICES)).join(pages, "landing_page", "left")
    sessions = sessions.groupBy(*KEYS).agg(F.count_distinct("session_id").alias("num_sessions"))
    booked = tables["uk_fact_ticket_main"].filter(
        F.col("appointment_type_raw").isin(*v.APPOINTMENT_CODES) & F.col("appointment_date").isNotNull()
    ).withColumnRenamed("created_date", "date").groupBy(*KEYS).agg(
        F.count_distinct("ccc_ticket_id").alias("num_scheduled_appointments"))
    customers = tables["uk_dim_customer"]
    screenings = kpis_by_dim(
        tables["uk_fact_screening_main"].filter(F.col("post_lead_flag") == 1), customers, "customer_id", acquisition(),
        {}, "screening_id", {"num_screenings": None, "num_qualified_screenings": qualified})
    sales = kpis_by_dim(
        tables["uk_fact_sales_main"].filter(F.col("post_lead_flag") == 1), customers, "customer_id", acquisition(),
        {"num_invoices": F.count_distinct(F.when(F.col("hea_quantity_invoiced") > 0, F.col("invoice_id"))),
         "total_net_sales_hea_in_eur": F.sum("total_net_sales_hea_in_eur"),
         "total_net_sales_in_eur": F.sum("total_net_sales_in_eur")})

    rows = merge_facts(
        leads, {"spend": spend, "sessions": sessions, "booked": booked, "screenings": screenings, "sales": sales}, KEYS)
    rows = rows.withColumns({
        "reporting_week": iso_week(F.col("date")), "reporting_month": month_key(F.col("date"))})
    return allocate(
        stage(rows), ["marketing_spend", "num_clicks"], "num_leads", "device_type",
        [["date", *GROUP], ["reporting_month", *GROUP]], spend="marketing_spend",
        shares=["device_type_share_day", "device_type_share_month", "device_type_share_raw"])
