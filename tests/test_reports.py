"""The reports on small hand-made tables, with results worked out by hand."""

import datetime as dt

import pytest
from conftest import day, values
from pyspark.sql import functions as F

from calloom import plans
from calloom.operators.forecast import carry_backlog
from calloom.sources import read_report, write_report

WEEK = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]


@pytest.fixture(scope="module")
def shops(table, tables):
    hours = {"monday": "09:00-12:00, 13:00-18:00", "tuesday": "10:00-16:00", "wednesday": "nach Vereinbarung"}
    columns = ("shop_id string, address string, postal_code string, city string, district_lead string, "
               "region_lead string, active_status string, " + ", ".join(f"{d}_open_time string" for d in WEEK))
    slots = [hours.get(d) for d in WEEK]
    return tables(
        dim_shop_overview=table(
            columns, ["1", "A 1", "10115", "Berlin", "Lead", "R", "aktiv", *slots],
            ["2", "B 2", "20095", "Hamburg", "Boss", "R", "INAKTIV", *slots],
            ["3", "C 3", "80331", "Munich", "Test, Test", "R", "aktiv", *slots],
            ["4", "D 4", "50667", "Cologne", "Boss", "R", "aktiv", *slots]),
        dim_pilot_shop=table("shop_id string, excluded_shop_flag int", ["1", 1], ["2", 0], ["4", 0]),
        fact_shop_calendar_entry_summary=table(
            "shop_id string, entry_date date, blocker_duration long, customer_service_duration double, "
            "num_studios_in_use int, num_studios int",
            ["1", "2021-01-04", 481, 0.0, 1, 2], ["1", "2021-01-04", 481, 0.0, 1, 2], ["1", "2021-01-05", 360, 0.0, 1, 2],
            ["1", "2021-01-06", 50, 0.0, 1, 2], ["1", "2021-01-10", 50, 0.0, 1, 2], ["2", "2021-01-04", 900, 0.0, 1, 1],
            ["3", "2021-01-04", 900, 0.0, 1, 1], ["9", "2021-01-04", 900, 0.0, 1, 1]))


def test_shop_dimension(shops):
    rows = plans.shop_dimension(shops, excluded_lead="Boss", extra_flags={"north_flag": F.col("city") == "Hamburg"})
    assert values(rows, "shop_id", "active_status", "pilot_shop_flag", "excluded_shop_flag", "north_flag") == [
        ("1", "Active", 1, 1, 0), ("2", "Inactive", 1, 1, 1), ("3", "Active", 0, 0, 0), ("4", "Active", 1, 1, 0)]
    first = rows.filter("shop_id = 1").first()
    assert first.full_address == "A 1 10115 Berlin"
    assert (first.monday_open_time_2_start, first.monday_open_time_2_end) == (13 * 3600, 18 * 3600)
    assert first.tuesday_open_time_2_start is None and first.wednesday_open_time_1_start is None


def test_blocker_alert(shops):
    rows = plans.blocker_alert(shops, plans.shop_dimension(shops))
    assert values(rows, "entry_date", "entry_weekday", "open_duration", "total_open_duration",
                  "share_blocked_weighed_50_flag") == [
        (day("2021-01-10"), "Sunday", None, None, 0), (day("2021-01-04"), "Monday", 480, 960, 1),
        (day("2021-01-05"), "Tuesday", 360, 720, 0), (day("2021-01-06"), "Wednesday", 0, 0, 0)]


@pytest.fixture(scope="module")
def mails(spark):
    def event(date, name, uuid="u1", mail="CRM N.3", campaign="Retarget CRM", email="m@x", hour=0, category="CRM Email"):
        return (date, dt.datetime.fromisoformat(date) + dt.timedelta(hours=hour), name, category, campaign, uuid,
                [("emailAddress", email), ("firstName", "Ann")], [("emailName", mail)])

    entries = "array<struct<key string, value string>>"
    return spark.createDataFrame([
        event("2021-01-01", "email_sent"), event("2021-01-02", "email_opened"), event("2021-01-10", "email_sent"),
        event("2021-01-12", "email_clicked"), event("2021-01-12", "email_sent", email="n@x", uuid="u2"),
        event("2021-01-12", "email_sent", category="Other"),
    ], f"event_date string, event_timestamp timestamp_ntz, event_name string, event_category string, event_type string, "
       f"user_id string, user_properties {entries}, event_params {entries}")


def test_crm_events(tables, mails):
    rows = plans.crm_events(tables(events=mails)).filter("user_email = 'm@x'")
    assert values(rows, "user_event_rank_asc", "user_event_rank_desc", "email_event_rank", "cohort_date",
                  "cohort_date_alt", "email_type_concat", "user_first_name") == [
        (1, 4, 1, day("2021-01-01"), day("2021-01-01"), "3 - CRM N.3", "Ann"),
        (2, 3, 2, day("2021-01-01"), day("2021-01-01"), "3 - CRM N.3", "Ann"),
        (3, 2, 1, day("2021-01-01"), day("2021-01-10"), "3 - CRM N.3", "Ann"),
        (4, 1, 3, day("2021-01-01"), day("2021-01-10"), "3 - CRM N.3", "Ann")]


@pytest.mark.parametrize(("created", "credits"), [("2021-02-11 08:00:00", 1), ("2021-02-12 08:00:00", 0)])
def test_crm_report_credits_thirty_days_once(table, tables, mails, created, credits):
    # the last mail of m@x is of 2021-01-12: 30 days later counts, 31 days later does not
    source = tables(
        events=mails,
        fact_lead_main=table("uuid string, email string, lead_date timestamp_ntz", ["u1", "m@x", "2020-12-30 10:00:00"],
                             ["", "q@x", "2020-12-30 10:00:00"]),
        fact_ticket_main=table("email string, customer_id long, test_flag int, contact_result string", ["m@x", 7, 0, "ok"],
                               ["m@x", 9, 0, "ok"], ["m@x", 1, 0, "duplicate"], ["m@x", 2, 0, None]),
        fact_appointment_main=table("customer_id long, appointment_type string, appointment_created_at timestamp_ntz",
                                    [7, "Sales", created], [7, "Service", "2021-06-01 00:00:00"]),
        fact_oht_results=table("email string, date_created date, oht_test_rank_desc int", ["n@x", "2021-01-12", 1],
                               ["n@x", "2021-01-01", 2]))
    rows = plans.crm_report(source, plans.crm_events(source))
    mine = rows.filter("user_email = 'm@x'")
    assert mine.filter("post_crm_appointment_flag = 1").count() == credits
    if credits:
        assert values(mine.filter("post_crm_appointment_flag = 1"), "user_event_rank_asc",
                      "days_sent_to_appointment_scheduled", "lead_age_days", "customer_id") == [(4, 32, 11, 7)]
    assert rows.agg(F.sum("post_crm_oht_flag")).first()[0] == 1
    assert mine.filter("email_event_rank = 2").first().days_sent_to_open == 1


def test_workforce_days(table, tables):
    shift = ("load_date date, date date, start timestamp_ntz, end timestamp_ntz, employee string, employee_id string, "
             "position string, total_hours double, status string")
    source = tables(
        time_off_request=table(
            "load_date date, start_date date, end_date date, employee string, employee_id string, paid_hours double, "
            "type string, status string",
            ["2021-01-20", "2021-01-14", "2021-01-15", "Ann", "1", 16.0, "Sick", "Approved"],
            ["2021-01-19", "2021-01-14", "2021-01-14", "Ann", "1", 99.0, "Sick", "Approved"],
            ["2021-01-20", "2021-01-15", "2021-01-15", "Bob", "2", 8.0, "Holiday", "Pending"],
            ["2021-01-20", "2021-01-16", "2021-01-15", "Ann", "1", 8.0, "Holiday", "Approved"]),
        schedule=table(
            shift, ["2021-01-10", "2021-01-11", "2021-01-11 08:00:00", "2021-01-11 16:30:00", "Ann", "1", "CCC Agent", 8.0, "Published"],
            ["2021-01-09", "2021-01-11", "2021-01-11 09:00:00", "2021-01-11 16:30:00", "Ann", "1", "Teamleader", 7.0, "Published"],
            ["2021-01-10", "2021-01-11", "2021-01-11 08:00:00", "2021-01-11 12:00:00", "Bob", "2", "Teamleader", 4.0, "Published"],
            ["2021-01-18", "2021-01-18", "2021-01-18 08:00:00", "2021-01-18 12:00:00", "Cyd", "3", "Guest", 4.0, "Published"],
            ["2020-05-04", "2020-05-04", "2020-05-04 08:00:00", "2020-05-04 12:00:00", "Cyd", "3", "CCC Agent (UK)", 4.0, "Published"],
            ["2021-01-18", "2021-01-18", "2021-01-18 08:00:00", "2021-01-18 12:00:00", "Ann", "1", "CCC Agent", 4.0, "Draft"]),
        dim_agent_main=table("full_name string, country string", ["Ann", "DE"], ["Ann", "DE"], ["Bob", "DE"], ["Cyd", "DE"]))
    rows = plans.workforce_days(source, "2021-02-01", start="2020-05-01")
    assert values(rows, "employee", "date", "type", "day_productivity_hours", "start_time", "absence_total_period_days") == [
        # both absence days are of the second load; the half-month edge lies between them
        ("Ann", day("2021-01-11"), "Presence", 8.0, "08:00:00", None),
        ("Ann", day("2021-01-14"), "Absence", 8.0, None, 2.0), ("Ann", day("2021-01-15"), "Absence", 8.0, None, 2.0),
        # an agent only in another year, found as the last resort
        ("Cyd", day("2020-05-04"), "Presence", 4.0, "08:00:00", None),
        ("Cyd", day("2021-01-18"), "Presence", 4.0, "08:00:00", None)]


TICKET = ("zendesk_ticket_id long, phone_number string, description string, created_at timestamp_ntz, "
          "no_show_updated_at timestamp_ntz, contact_reason_raw string, contact_result string")
TICKET_REST = {
    "customer_key": 1, "customer_id": 1, "ticket_type": "Lead", "lead_flag": 1, "qualified_flag": 1, "phone_ticket_flag": 0,
    "pilot_flag": 0, "test_flag": 0, "contact_reason": "Hearing Test Only", "contact_result_specific": None,
    "created_during_business_hours": 1, "ticket_status": "Closed", "email": "m@x"}


@pytest.fixture(scope="module")
def call_tables(table, tables):
    tickets = table(
        TICKET, [1, "+4930111", "Telefon: +4930111", "2021-01-10 10:00:00", None, None, None],
        [2, "+4930111", None, "2021-01-12 10:00:00", "2021-01-13 00:00:00", None, None],
        [3, "+4930111", None, "2021-01-14 10:00:00", None, None, None],
        [4, "+4930222", "Telefon: +4930333", "2021-01-12 10:00:00", None, None, None],
        [5, "anonymous", None, "2021-01-12 10:00:00", None, None, None],
        [6, "+4930111", None, "2021-01-13 10:00:00", None, "x Datensatz doppelt", None],
        [7, "+4930444", None, "2020-12-01 00:00:00", None, None, None])
    for name, value in TICKET_REST.items():
        literal = F.lit(value) if value is not None else F.lit(None).cast("string")
        tickets = tickets.withColumn(name, literal)
    tickets = tickets.withColumns({"last_updated_at": F.col("created_at"), "appointment_date": F.to_date("created_at")})
    calls = table(
        "call_id long, call_timestamp timestamp_ntz, call_type string, interaction_flag int, source string, "
        "customer_phone_no string, agent_name string",
        [1, "2021-01-01 00:00:00", "Inbound", 1, "aspect", "+49999", "Ann"],
        [2, "2021-01-10 09:30:00", "Outbound", 0, "aircall", "+49 30 111", "Ann"],
        [3, "2021-01-10 12:00:00", "Outbound", 1, "aspect", "+4930111", "Ann"],
        [4, "2021-01-12 09:30:00", "Inbound", 1, "aspect", "+4930111", "Bob"],
        [5, "2021-01-13 10:00:00", "Outbound", 1, "aspect", "+4930111", "Bob"],
        [6, "2021-02-13 10:00:00", "Outbound", 1, "aspect", "+4930111", "Bob"],
        [7, "2021-01-13 10:00:00", "Outbound", 0, "aspect", "+4930333", "Bob"],
        [8, "2021-01-13 11:00:00", "Outbound", 0, "aircall", "+4930333", "Bob"],
        [9, "2021-01-12 11:00:00", "Outbound", 0, "fax", "+4930222", "Bob"])
    calls = calls.withColumns({
        "call_date": F.to_date("call_timestamp"), "call_start_time": F.col("call_timestamp"),
        "call_end_time": F.col("call_timestamp"), "call_total_time": F.lit(60.0), "call_hold_time": F.lit(None).cast("double"),
        "call_talk_time": F.lit(30.0), "load_date": F.lit("2021-03-01").cast("date")})
    updates = table(
        "zendesk_ticket_id long, updated_at timestamp_ntz, no_show_updated_at timestamp_ntz, contact_reason string, "
        "appointment_date date",
        [2, "2021-01-14 00:00:00", "2021-01-13 00:00:00", "Hearing Test Only", "2021-01-20"],
        [1, "2021-01-14 00:00:00", None, "Hearing Test Only", "2021-01-20"])
    return tables(fact_ticket_main=tickets, fact_call_main=calls, fact_ticket_update=updates)


def test_call_performance(call_tables):
    rows = plans.call_performance(call_tables, gaps=[("2021-01-14", "2021-01-14")])
    got = values(rows, "zendesk_ticket_id", "call_id", "call_rank_asc", "outbound_call_rank_asc", "total_calls",
                 "post_no_show_call_flag")
    assert got == [
        # calls before (within the hour), in and after the tickets of one number; several calls make every
        # ticket of it a "first" one, so call 4 reaches back into ticket 1 and ahead to ticket 2
        (1, 2, 1, 1, 3, 0), (1, 3, 2, 2, 3, 0), (1, 4, 3, None, 3, 0),
        (2, 4, 1, None, 2, 0), (2, 5, 2, 1, 2, 1),
        (3, 6, 1, 1, 1, 0),
        # the form number differs: matched as written, in either system
        (4, 7, 1, 1, 2, 0), (4, 8, 2, 2, 2, 0),
        (5, None, None, None, None, None), (6, None, None, None, None, None), (7, None, None, None, None, None)]
    first = {r.zendesk_ticket_id: r for r in rows.filter("call_rank_asc = 1 or call_id is null").collect()}
    assert first[1].first_time_to_call == dt.datetime(2021, 1, 10, 9, 30) and first[1].first_time_to_call_sec is None
    assert first[1].first_time_to_interaction_sec == 7200 and first[1].first_time_to_interaction_days == 0.1
    assert first[2].post_no_show_appointment_flag == 1 and first[1].post_no_show_appointment_flag == 0
    assert [first[n].phone_number_ticket_rank_asc for n in (1, 3, 4, 6)] == [1, 3, 1, 1]
    assert [first[n].outside_call_data_range_flag for n in (1, 3, 7)] == [0, 1, 1]
    assert first[6].duplicate_flag == 1 and first[1].ticket_reporting_week == "2021-W01"


def test_agent_performance(table, tables, call_tables):
    update = ("zendesk_ticket_id long, agent_name string, created_at timestamp_ntz, updated_at timestamp_ntz, customer_id long, "
              "appointment_date date, appointment_start_time timestamp_ntz, shop_id string, contact_result string, "
              "contact_reason_raw string")

    def booking(ticket, agent, updated, customer, date, result=None, raw=None):
        return [ticket, agent, updated, updated, customer, date, f"{date} 10:00:00", "s1", result, raw]

    updates = table(
        update, booking(1, "Ann A", "2020-01-10 09:00:00", 1, "2020-01-20", None, "Termin abgesagt"),
        booking(1, "Bob B", "2020-01-11 09:00:00", 1, "2020-01-20"),
        booking(2, "Ann A", "2021-01-08 09:00:00", 1, "2021-01-18"),     # 364 days after: does not count
        booking(3, "Bob B", "2022-01-09 09:00:00", 1, "2022-01-19"),     # 366 days after the previous: counts
        booking(4, "Ann A", "2022-01-09 09:00:00", 2, "2022-01-19", "other", "Termin abgesagt"),
    ).withColumns({"test_flag": F.lit(0), "lead_flag": F.lit(1), "qualified_flag": F.lit(1),
                   "contact_reason": F.lit("Hearing Test Only")})
    full_name = F.concat("agent_name", F.lit(" "), F.left("agent_name", F.lit(1)))
    source = call_tables.with_frames(
        fact_call_main=call_tables["fact_call_main"].withColumn("agent_name", full_name),
        fact_ticket_update=updates,
        dim_agent_main=table(
            "first_name string, last_name string, email string, status string, team string",
            ["Ann", "A", "a@x", "Active", "T"], ["Ann", "A", "old@x", "Inactive", "T"], ["Bob", "B", "b@x", "Inactive", "T"],
            ["Bob", "B", "c@x", "Inactive", "T"], ["Cyd", "C", "d@x", "Exclude", "T"]),
        fact_appointment_main=table(
            "customer_id long, appointment_type string, appointment_date date, appointment_start_time timestamp_ntz, "
            "shop_id string, cancelled_flag int, no_show_flag int, post_lead_flag int",
            [2, "Sales", "2022-01-19", "2022-01-19 10:00:00", "s1", 0, 1, 1]),
        fact_screening_main=table("customer_id long, screening_date date, qualified_flag int, post_lead_flag int",
                                  [1, "2022-01-08", 1, 1], [2, "2022-01-08", 1, 1]),
        fact_sales_main=table(
            "customer_id long, first_invoice_date date, total_net_sales_hea_in_eur double, hea_quantity_invoiced int, "
            "post_lead_flag int", [1, "2022-01-09", 500.0, 1, 1], [1, "2022-01-10", 50.0, 0, 1]))
    performance = table("call_id long, call_date date, call_start_time timestamp_ntz, ticket_type string",
                        [6, "2021-02-13", "2021-02-13 10:00:00", "Lead"], [6, "2021-02-13", "2021-02-13 10:00:00", "Reminder"])
    workforce = table("date date, employee string, type string, absence_type string, day_productivity_hours double",
                      ["2022-01-09", "Ann A", "Presence", None, 8.0], ["2022-01-09", "Ann A", "Absence", "Sick", 2.0])
    rows = plans.agent_performance(source, performance, workforce, "2022-01-20", start="2019-12-31")
    # one row per date and agent: of two inactive master rows the first stays, beside an active one the inactive goes
    assert values(rows.filter("reporting_date = '2022-01-10'"), "agent_name", "agent_email") == [("Ann A", "a@x"), ("Bob B", "b@x")]
    shown = ["num_cust_sched_app", "num_cust_cancellation", "num_cust_no_show", "num_cust_qscreen", "num_cust_sale"]
    booked = rows.filter("num_cust_sched_app is not null")
    assert values(booked, "reporting_date", "agent_name", *shown, "cus_net_sales_hea_only") == [
        # the screening of the day before customer 1's next counted booking still belongs to the first one
        (day("2020-01-10"), "Ann A", 1, 1, 0, 1, 0, None),
        (day("2022-01-09"), "Ann A", 1, 0, 1, 0, 0, None), (day("2022-01-09"), "Bob B", 1, 0, 0, 0, 1, 500.0)]
    calls = rows.filter("num_outbound_calls_lead > 0").first()
    assert (calls.reporting_date, calls.num_outbound_calls, calls.num_outbound_calls_reminder) == (day("2021-02-13"), 2, 1)
    assert calls.call_duration_outbound_calls == 120.0
    last = rows.filter("reporting_date = '2022-01-09' and agent_name = 'Ann A'").first()
    assert (last.planned_hours, last.worked_hours, last.sickness_hours) == (10.0, 8.0, 2.0)
    # totals and rates are taken before the superfluous master rows go, so a double agent counts twice
    assert last.num_cust_sched_app_total == 4 and last.rolling_average_num_cus_appointment_hour == 4 / 16
    assert last.rolling_average_num_cus_appointment_hour_agent == 2 / 16
    assert last.rolling_average_qualified_screening_ratio is None


def test_market_fit_splits_spend(table, tables):
    keys = "marketing_channel string, campaign string, lead_form_type string, lead_form_mode string"
    group = ["Web", "C", "Short", "Online"]
    lead = f"lead_date date, lead_id long, {keys}, device_type string, qualified_flag int"
    customer = ("customer_id long, first_lead_date timestamp_ntz, acquisition_marketing_channel string, "
                "acquisition_marketing_campaign string, acquisition_form_type string, acquisition_form_mode string, "
                "acquisition_device_type string")
    source = tables(
        uk_fact_lead_main=table(
            lead, ["2021-01-01", 1, *group, "Mobile", 1], ["2021-01-01", 2, *group, "Mobile", 0],
            ["2021-01-01", 3, *group, "Mobile", 0], ["2021-01-01", 4, *group, "Desktop", 0]),
        uk_fact_daily_marketing_activity=table(
            f"date date, {keys}, marketing_costs_in_eur double, num_clicks long", ["2021-01-01", *group, 100.0, 8],
            ["2021-01-02", *group, 40.0, 4], ["2021-02-01", *group, 10.0, 2]),
        uk_fact_session_main=table(
            "date date, marketing_channel string, campaign string, landing_page string, device_type string, session_id long",
            ["2021-01-01", "Web", "C", "p", "Smartphone", 1], ["2021-01-01", "Web", "C", "p", "Mobile", 1],
            ["2021-01-01", "Web", "C", "p", "Console", 2]),
        uk_dim_landing_pages=table("landing_page string, lead_form_type string, lead_form_mode string", ["p", "Short", "Online"]),
        uk_fact_ticket_main=table(
            f"created_date date, ccc_ticket_id long, {keys}, device_type string, appointment_type_raw string, "
            "appointment_date date", ["2021-01-01", 1, *group, "Mobile", "fha", "2021-01-09"],
            ["2021-01-01", 2, *group, "Mobile", "other", "2021-01-09"]),
        uk_dim_customer=table(customer, [1, "2021-01-01 10:00:00", *group, "Tablet"]),
        uk_fact_screening_main=table("customer_id long, screening_id long, qualified_flag int, post_lead_flag int", [1, 1, 1, 1]),
        uk_fact_sales_main=table(
            "customer_id long, invoice_id long, hea_quantity_invoiced int, total_net_sales_in_eur double, "
            "total_net_sales_hea_in_eur double, post_lead_flag int", [1, 1, 1, 9.0, 5.0, 1]))
    rows = plans.market_fit(source)
    assert values(rows.filter("marketing_spend is not null"), "date", "device_type", "marketing_spend", "num_clicks") == [
        (day("2021-01-01"), "Desktop", 25.0, 2.0), (day("2021-01-01"), "Mobile", 75.0, 6.0),
        (day("2021-01-02"), "Desktop", 10.0, 1.0), (day("2021-01-02"), "Mobile", 30.0, 3.0),
        (day("2021-02-01"), "Desktop", 5.0, 1.0), (day("2021-02-01"), "Mobile", 5.0, 1.0)]
    # screenings and sales of a device without leads keep a row each
    assert rows.filter("device_type = 'Tablet'").count() == 2
    mobile = rows.filter("device_type = 'Mobile' and date = '2021-01-01'").first()
    assert (mobile.num_leads, mobile.num_sessions, mobile.num_scheduled_appointments) == (3, 1, 1)


def test_capacity_order_is_by_week_text(table):
    """Across New Year the left-over runs by week number as text: week 01 comes before week 53."""
    df = table("weeknum string, daynum int, w double, g double", ["53", 4, 1.0, 5.0], ["01", 1, 2.0, 7.0])
    rows = carry_backlog(df, "w", "g", ["weeknum", "daynum"], "c")
    assert values(rows, "weeknum", "c") == [("01", 2.0), ("53", 8.0)]


def test_report_is_written_and_read_back(spark, table, tmp_path):
    report = table("date date, n int", ["2021-01-01", 1], ["2021-01-02", 2])
    write_report(report, str(tmp_path / "r"), partition_by="date")
    assert values(read_report(spark, str(tmp_path / "r")), "date", "n") == values(report)
    write_report(report, str(tmp_path / "plain"))
    assert read_report(spark, str(tmp_path / "plain")).count() == 2
