"""U01-U32: snapshots, slots, cohorts, calendar, phones, calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from calloom.functions import calendar as cal, text
from calloom.operators import attribution as att, cohorts as coh, keyed, shops, snapshots as snap
from calloom.operators.ordered import id_range
from calloom.operators.spine import half_month_spine
from checks.registry import plain, query, shared


def order_day():
    return F.to_date("o_orderdate")


@query("u01_latest_snapshot", """
select o_custkey, o_orderkey, o_orderstatus, cast(o_orderdate as date) as order_date
from (select *, max(o_orderdate) over (partition by o_custkey) as newest from orders)
where o_orderdate = newest
""")
def _(t):
    rows = snap.latest_snapshot(t.orders, ["o_custkey"], "o_orderdate")
    return rows.select("o_custkey", "o_orderkey", "o_orderstatus", order_day().alias("order_date"))


@query("u02_explode_period", """
with p as (
  select o_orderkey, cast(o_orderdate as date) as first_day, o_totalprice, cast(o_orderkey % 10 as integer) as n
  from orders)
select o_orderkey, first_day + cast(i as integer) as date, n as total_days, round(o_totalprice / n, 6) as day_amount
from (select *, unnest(range(n)) as i from p)
""")
def _(t):
    periods = t.orders.select(
        "o_orderkey", "o_totalprice", order_day().alias("start"),
        F.date_add(order_day(), (F.col("o_orderkey") % 10).cast("int") - 1).alias("end"),
    )
    rows = snap.explode_period(periods, "start", "end", "o_totalprice")
    return rows.select("o_orderkey", "date", "total_days", F.round("day_amount", 6).alias("day_amount"))


HALF = """strftime(o_orderdate, '%Y-%m') || case when extract(day from o_orderdate) < 15 then '-01' else '-15' end"""


@query("u03_half_month", f"""
select {HALF} as half_month, count(*) as n from orders group by 1
""")
def _(t):
    return t.orders.groupBy(cal.half_month(order_day()).alias("half_month")).agg(F.count("*").alias("n"))


PRIORITIES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


@query("u04_fallback_rank", f"""
with best as (
  select o_custkey, {HALF} as half_month, min(cast(left(o_orderpriority, 1) as integer)) as own
  from orders group by 1, 2),
halves as (
  select distinct strftime(d, '%Y-%m') || case when extract(day from d) < 15 then '-01' else '-15' end as half_month,
    strftime(d, '%Y-%m') as month, strftime(d, '%Y') as year
  from (select unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as d)),
base as (select c.o_custkey, h.* from halves h, (select distinct o_custkey from orders) c),
found as (
  select b.*, best.own,
    min(own) over (partition by b.o_custkey, b.month) as in_month,
    min(own) over (partition by b.o_custkey, b.year) as in_year,
    min(own) over (partition by b.o_custkey) as ever
  from base b left join best on best.o_custkey = b.o_custkey and best.half_month = b.half_month)
select o_custkey, half_month, month, '2-HIGH' as position
from found where coalesce(own, in_month, in_year, ever) = 2
""")
def _(t):
    customers = t.orders.select("o_custkey").distinct()
    base = half_month_spine(customers, "1995-01-01", "2001-12-31")
    ranks = t.orders.select(
        "o_custkey", cal.half_month(order_day()).alias("half_month"),
        snap.rank_of(F.col("o_orderpriority"), PRIORITIES).alias("rank"),
    )
    rows = snap.fallback_rank(base, ranks, "o_custkey", "rank")
    labelled = rows.withColumn("position", snap.label_of(F.col("best_rank"), {v: k for k, v in PRIORITIES.items()}))
    return labelled.filter(F.col("position") == "2-HIGH").select("o_custkey", "half_month", "month", "position")


@query("u05_union_typed", """
select 'Purchase' as type, user_id, cast(ts as date) as day, value as amount, cast(null as varchar) as reason
from events where event_type = 'purchase'
union all
select 'Error', user_id, cast(ts as date), cast(null as double), props from events where event_type = 'error'
""")
def _(t):
    day = F.to_date("ts").alias("day")
    bought = t.events.filter(F.col("event_type") == "purchase").select("user_id", day, F.col("value").alias("amount"))
    failed = t.events.filter(F.col("event_type") == "error").select("user_id", day, F.col("props").alias("reason"))
    layout = {"user_id": "bigint", "day": "date", "amount": "double", "reason": "string"}
    return snap.union_typed({"Purchase": bought, "Error": failed}, layout)


# opening hours from order keys: one slot, two slots, a closing hour past midnight, free text, none
SLOTS = """
select o_orderkey, o_orderdate,
  case
    when o_orderstatus = 'F' then lpad(cast(o_orderkey % 12 + 6 as varchar(2)), 2, '0') || ':00-'
      || lpad(cast(o_orderkey % 12 + 14 as varchar(2)), 2, '0') || ':30'
    when o_orderstatus = 'O' then '08:30-12:15, ' || cast(o_orderkey % 4 + 13 as varchar(2)) || ':05-19:00'
    when o_orderpriority = '1-URGENT' then 'by appointment'
    when o_orderpriority = '2-HIGH' then '9:00-12:00, 14:00-18:00'
  end as hours
from {orders}
"""


def clock(part: str, start: int) -> str:
    text_ = f"substring({part}, {start}, 5)"
    return f"""case when regexp_full_match({text_}, '([01][0-9]|2[0-3]):[0-5][0-9]')
      then cast(substring({text_}, 1, 2) as integer) * 3600 + cast(substring({text_}, 4, 2) as integer) * 60 end"""


SLOT_TIMES = f"""
with s as ({plain(SLOTS, 'orders')}), p as (select *, string_split(hours, ', ') as parts from s),
times as (select o_orderkey, o_orderdate,
  {clock('parts[1]', 1)} as open_1_start, {clock('parts[1]', 7)} as open_1_end,
  {clock('parts[2]', 1)} as open_2_start, {clock('parts[2]', 7)} as open_2_end from p)
"""


@query("u06_parse_slots", SLOT_TIMES + """
select o_orderkey, open_1_start, open_1_end, open_2_start, open_2_end from times
""")
def _(t):
    return text.parse_slots(shared(t, SLOTS, "orders"), {"open": "hours"}).drop("hours", "o_orderdate")


@query("u07_slot_minutes", SLOT_TIMES + """
select o_orderkey, coalesce((open_1_end - open_1_start) // 60, 0) + coalesce((open_2_end - open_2_start) // 60, 0)
  as open_minutes
from times
""")
def _(t):
    parsed = text.parse_slots(shared(t, SLOTS, "orders"), {"open": "hours"})
    return parsed.select("o_orderkey", text.slot_minutes("open").alias("open_minutes"))


WEEKDAYS = {2: "mon", 3: "tue", 4: "wed", 5: "thu", 6: "fri", 7: "sat"}


@query("u08_by_weekday", """
select o_orderkey, round(o_totalprice * case extract(dow from o_orderdate)
  when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 4 when 5 then 5 when 6 then 6 end, 2) as amount
from orders
""")
def _(t):
    wide = t.orders.withColumns({name: F.col("o_totalprice") * (day - 1) for day, name in WEEKDAYS.items()})
    return wide.select("o_orderkey", F.round(shops.by_weekday(F.col("o_orderdate"), WEEKDAYS), 2).alias("amount"))


@query("u09_utilisation_flag", """
select l_orderkey, l_linenumber, l_quantity, cast(l_linenumber % 3 * 20 as double) as per_unit,
  case when l_quantity = 0 or l_linenumber % 3 = 0 then 0
    when l_quantity / (l_linenumber * (l_linenumber % 3 * 20)) > cast(0.5 as double) then 1 else 0 end as flag
from lineitem
""")
def _(t):
    per_unit = (F.col("l_linenumber") % 3 * 20).cast("double")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", per_unit.alias("per_unit"))
    return rows.withColumn("flag", shops.utilisation_flag(
        F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.col("per_unit")))


@query("u10_pivot_props", """
select event_id, user_id, max(json_extract_string(props, '$.k')) over (partition by user_id) as k_value,
  max(json_extract_string(props, '$.absent')) over (partition by user_id) as absent
from events
""")
def _(t):
    entries = F.map_entries(F.from_json("props", "map<string,string>"))
    rows = t.events.select("event_id", "user_id", entries.alias("entries"))
    spread = coh.pivot_props(rows, "entries", {"k_value": "k", "absent": "absent"}, ["user_id"])
    return spread.drop("entries")


STAGES = {"error": (0, "Failed"), "signup": (1, "Signed up"), "view": (2, "Viewed"), "click": (3, "Clicked")}
TYPED = """
select event_id, user_id, event_type, ts, cast(ts as date) as day,
  case when event_type = 'view' then event_type else 'mail ' || cast(event_id % 4 as varchar(1)) end as mail_type
from {events}
"""


@query("u11_funnel_stage", f"""
with e as ({plain(TYPED, 'events')}),
s as (select *,
  case event_type when 'error' then 0 when 'signup' then 1 when 'view' then 2 when 'click' then 3 end
    as email_event_rank,
  case event_type when 'error' then 'Failed' when 'signup' then 'Signed up' when 'view' then 'Viewed'
    when 'click' then 'Clicked' end as email_event,
  case when right(mail_type, 1) between '0' and '9' then cast(right(mail_type, 1) as integer) else 1 end
    as email_type_rank
  from e)
select event_id, email_event_rank, email_event, email_type_rank,
  email_type_rank || ' - ' || mail_type as email_type_concat,
  email_event_rank || ' - ' || email_event as email_event_concat
from s
""".replace("case when right(mail_type, 1) between", "case when mail_type <> 'view' and right(mail_type, 1) between"))
def _(t):
    rows = coh.funnel_stage(shared(t, TYPED, "events"), "event_type", STAGES, "mail_type")
    return rows.drop("user_id", "event_type", "ts", "day", "mail_type")


@query("u12_cohort_date", """
select event_id, min(case when event_type = 'signup' then cast(ts as date) end) over (partition by user_id)
  as cohort_date
from events
""")
def _(t):
    rows = coh.cohort_date(
        t.events.withColumn("day", F.to_date("ts")), ["user_id"], F.col("event_type") == "signup", "day")
    return rows.select("event_id", "cohort_date")


@query("u13_rerun_cohort_date", f"""
with e as ({plain(TYPED, 'events')}),
n as (select *,
  min(case when event_type = 'signup' then day end) over (partition by user_id, mail_type) as cohort_date,
  case when event_type = 'signup' then coalesce(lead(day) over (
    partition by user_id, mail_type, event_type = 'signup' order by day, ts, event_id), day) end as next_date
  from e),
c as (select *, first_value(next_date ignore nulls) over (partition by user_id, mail_type order by day, ts, event_id
  rows between unbounded preceding and current row) as carried from n)
select event_id, cohort_date,
  case when day >= carried then carried when day < carried then cohort_date end as cohort_date_alt
from c
""")
def _(t):
    by, sent = ["user_id", "mail_type"], F.col("event_type") == "signup"
    rows = coh.rerun_cohort_date(shared(t, TYPED, "events"), by, sent, "day", ["day", "ts", "event_id"])
    return rows.select("event_id", "cohort_date", "cohort_date_alt")


@query("u14_sequence_events", """
select event_id, user_id,
  row_number() over (partition by user_id order by cast(ts as date), event_type, event_id) as user_event_rank_asc,
  row_number() over (partition by user_id order by cast(ts as date) desc, event_type desc, event_id desc)
    as user_event_rank_desc
from events
""")
def _(t):
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    numbered = coh.sequence_events(rows, ["user_id"], ["day", "event_type", "event_id"], [F.col("day")])
    return numbered.drop("event_type", "day")


TRIGGERS = """
with m as (select event_id, user_id, ts, cast(ts as date) as day,
  case when event_type = 'click' then cast(ts as date) end as click_trigger_event_date,
  max(case when event_type = 'purchase' then cast(ts as date) end) over (partition by user_id) as bought
  from events),
t as (select *, lead(click_trigger_event_date) over (partition by user_id order by ts, event_id)
  as next_click_trigger_event_date from m),
f as (select *, case
  when next_click_trigger_event_date is not null then case when bought between click_trigger_event_date
    and next_click_trigger_event_date then 1 else 0 end
  when bought >= click_trigger_event_date and date_diff('day', click_trigger_event_date, bought) <= 5 then 1
  else 0 end as converted from t)
"""


def triggered(t):
    rows = t.events.withColumn("day", F.to_date("ts"))
    rows = coh.trigger_dates(
        rows, {"click": F.col("event_type") == "click"}, ["user_id"], "day", ["ts", "event_id"],
        [F.date_trunc("hour", "ts")])
    last = keyed.latest_of_type(rows, "event_type", "purchase", "user_id", "day", "bought")
    rows = rows.join(last, "user_id", "left")
    return rows.withColumn("converted", coh.attribute_conversion(
        "click_trigger_event_date", "next_click_trigger_event_date", "bought", days=5))


@query("u15_trigger_dates", TRIGGERS + """
select event_id, click_trigger_event_date, next_click_trigger_event_date from t
""")
def _(t):
    return triggered(t).select("event_id", "click_trigger_event_date", "next_click_trigger_event_date")


@query("u16_attribute_conversion", TRIGGERS + "select event_id, bought, converted from f")
def _(t):
    return triggered(t).select("event_id", "bought", "converted")


@query("u17_single_credit", TRIGGERS + """
select event_id, credit, case when credit = 1 then date_diff('day', day, bought) end as days_to_conversion
from (select *, case when converted = 1 and row_number() over (
  partition by user_id, converted order by day desc, event_id desc) = 1 then 1 else 0 end as credit from f)
""")
def _(t):
    rows = coh.single_credit(triggered(t), "converted", ["user_id"], ["day", "event_id"], "credit")
    days = F.when(F.col("credit") == 1, F.datediff("bought", "day").cast("long"))
    return rows.select("event_id", "credit", days.alias("days_to_conversion"))


@query("u18_first_id", "select o_custkey, min(o_orderkey) as first_order from orders group by 1")
def _(t):
    return keyed.first_id(t.orders, "o_custkey", "o_orderkey", "first_order")


@query("u19_latest_of_type", """
select o_custkey, max(cast(o_orderdate as date)) as last_date from orders where o_orderstatus = 'F' group by 1
""")
def _(t):
    rows = t.orders.withColumn("day", order_day())
    return keyed.latest_of_type(rows, "o_orderstatus", "F", "o_custkey", "day", "last_date")


@query("u20_age_days", """
with s as (select l_orderkey, cast(min(l_shipdate) as date) as shipped from lineitem group by 1)
select o_orderkey, shipped,
  cast(case when cast(o_orderdate as date) <= shipped then date_diff('day', cast(o_orderdate as date), shipped) end
    as integer) as age_days,
  cast(date_diff('day', cast(o_orderdate as date), shipped) as integer) as days_to_ship
from orders left join s on l_orderkey = o_orderkey
""")
def _(t):
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.to_date(F.min("l_shipdate")).alias("shipped"))
    rows = t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select(
        "o_orderkey", "shipped", cal.age_days(F.col("shipped"), order_day()).alias("age_days"),
        cal.days_between(F.col("shipped"), order_day()).alias("days_to_ship"))


@query("u21_iso_week", """
select strftime(o_orderdate, '%G-W%V') as reporting_week, count(*) as n from orders group by 1
""")
def _(t):
    return t.orders.groupBy(cal.iso_week(order_day()).alias("reporting_week")).agg(F.count("*").alias("n"))


@query("u22_monday_week", """
select strftime(o_orderdate, '%Y-W%W') as reporting_week, count(*) as n from orders group by 1
""")
def _(t):
    return t.orders.groupBy(cal.monday_week(order_day()).alias("reporting_week")).agg(F.count("*").alias("n"))


@query("u23_month_key", """
select strftime(o_orderdate, '%Y-%m') as reporting_month, count(*) as n from orders group by 1
""")
def _(t):
    return t.orders.groupBy(cal.month_key(order_day()).alias("reporting_month")).agg(F.count("*").alias("n"))


@query("u24_extract_after_label", r"""
select doc_id, nullif(regexp_extract(text, '\+1 ([()0-9]+)', 1), '') as area,
  nullif(regexp_extract(text, 'the ([a-z]+)', 1), '') as word
from documents
""")
def _(t):
    return t.documents.select(
        "doc_id", text.extract_after_label(F.col("text"), "+1", "()0-9").alias("area"),
        text.extract_after_label(F.col("text"), "the", "a-z").alias("word"))


PHONES = """
select c_custkey, case when c_nationkey < 5 then 'aspect' when c_nationkey < 20 then 'aircall' else 'other' end
    as source,
  case when c_mktsegment = 'BUILDING' then '+49 30 ' || cast(c_custkey % 1000 as varchar(9)) || ' '
      || cast(c_custkey as varchar(9)) || ' 77'
    when c_mktsegment = 'MACHINERY' then '+4930' || cast(c_custkey as varchar(9))
    when c_mktsegment = 'HOUSEHOLD' then '+44  20 ' || cast(c_custkey as varchar(9))
    when c_mktsegment = 'FURNITURE' then '030 ' || cast(c_custkey as varchar(9))
    else 'ext. +1 ' || cast(c_custkey as varchar(9)) end as phone
from {customer}
"""


@query("u25_normalise_phone", rf"""
with p as ({plain(PHONES, 'customer')}),
g as (select *, regexp_extract(phone, '(\+[0-9]*)', 1) as g1,
  regexp_extract(phone, '\+[0-9]* *([0-9]*)', 1) as g2,
  regexp_extract(phone, '\+[0-9]* *[0-9]* *([0-9]*)', 1) as g3,
  regexp_extract(phone, '\+[0-9]* *[0-9]* *[0-9]* *([0-9]*)', 1) as g4 from p)
select c_custkey, case source when 'aspect' then phone when 'aircall' then nullif(g1 || g2 || g3 || g4, '') end
  as number
from g
""")
def _(t):
    return shared(t, PHONES, "customer").select(
        "c_custkey", text.normalise_phone(F.col("phone"), F.col("source")).alias("number"))


@query("u26_match_two_keys", """
with l as (select o_orderkey, o_custkey,
  dense_rank() over (partition by o_custkey order by o_orderkey) as order_rank from orders)
select o_orderkey, order_rank, 'first' as matched_on, c_custkey, c_name
from l left join customer on c_custkey = o_custkey
union all
select o_orderkey, order_rank, 'second', c_custkey, c_name
from l left join customer on c_custkey = o_orderkey where o_orderkey <> o_custkey
""")
def _(t):
    ranked = att.rank_ids(
        t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "o_orderkey", [id_range("o_orderkey")],
        "order_rank")
    rows = att.match_two_keys(
        ranked, t.customer.select("c_custkey", "c_name"), "o_custkey", "o_orderkey", "c_custkey")
    return rows.drop("o_custkey")


CALLS = """
with tickets as (
  select o_custkey, o_orderkey, o_orderdate + to_minutes(cast(o_orderkey * 7 % 1440 as integer)) as created
  from orders),
calls as (
  select o.o_custkey, l_orderkey, l_linenumber, l_partkey, l_returnflag,
    l_shipdate + to_minutes(cast(l_partkey * 7 % 1440 as integer)) as called
  from lineitem join orders o on l_orderkey = o.o_orderkey),
bounds as (select *,
  coalesce(lead(created) over w, created) as next_start, coalesce(lag(created) over w, created) as previous_start,
  max(created) over (partition by o_custkey) as last_start
  from tickets window w as (partition by o_custkey order by created, o_orderkey)),
assigned as (select b.*, c.* exclude (o_custkey) from bounds b join calls c on c.o_custkey = b.o_custkey
  where (created = previous_start and called between created - interval 60 minute and next_start)
    or (created > previous_start and created < last_start and called between created and next_start)
    or (created = last_start and called > created))
"""


def tickets_and_calls(t):
    def minutes(key):
        return F.make_dt_interval(mins=(F.col(key) * 7 % 1440).cast("int"))

    tickets = t.orders.select("o_custkey", "o_orderkey", (F.col("o_orderdate") + minutes("o_orderkey")).alias("created"))
    calls = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        (F.col("l_shipdate") + minutes("l_partkey")).alias("called"))
    return tickets, calls


def assigned(t):
    tickets, calls = tickets_and_calls(t)
    bounds = att.ticket_intervals(tickets, ["o_custkey"], "created", "o_orderkey")
    return att.assign_interval(
        bounds, calls, ["o_custkey"], "created", "called", F.col("created") == F.col("previous_start"))


@query("u27_assign_interval", CALLS + """
select o_custkey, o_orderkey, l_orderkey, l_linenumber, l_partkey, created, called from assigned
""")
def _(t):
    return assigned(t).select(
        "o_custkey", "o_orderkey", "l_orderkey", "l_linenumber", "l_partkey", "created", "called")


@query("u28_time_to_first", """
with f as (select l.*, o_orderdate, min(case when l_returnflag = 'R' then l_shipdate end) over (partition by l_orderkey)
  as first_return from lineitem l join orders on l_orderkey = o_orderkey)
select l_orderkey, l_linenumber, l_partkey, cast(first_return as date) as first_return,
  case when first_return >= o_orderdate then date_diff('second', o_orderdate, first_return) end as first_return_sec,
  round(case when first_return >= o_orderdate then date_diff('second', o_orderdate, first_return) end
    / 60 / 60 / 24, 1) as first_return_days
from f
""")
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = att.time_to_first(
        rows, ["l_orderkey"], "o_orderdate", "l_shipdate", F.col("l_returnflag") == "R", "first_return")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("first_return").alias("first_return"),
        "first_return_sec", "first_return_days")


LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("u29_call_ranks", f"""
with r as (select *, row_number() over w as call_rank_asc,
  case when l_returnflag = 'R' then row_number() over (
    partition by l_orderkey, l_returnflag = 'R' order by {', '.join(LINE_ORDER)}) end as outbound_call_rank_asc
  from lineitem window w as (partition by l_orderkey order by {', '.join(LINE_ORDER)}))
select l_orderkey, l_partkey, call_rank_asc, outbound_call_rank_asc,
  max(call_rank_asc) over (partition by l_orderkey) as total_calls,
  max(outbound_call_rank_asc) over (partition by l_orderkey) as total_outbound_calls
from r
""")
def _(t):
    rows = att.call_ranks(
        t.lineitem, ["l_orderkey"], LINE_ORDER, [F.date_trunc("month", "l_shipdate")], F.col("l_returnflag") == "R")
    return rows.select("l_orderkey", "l_partkey", "call_rank_asc", "outbound_call_rank_asc", "total_calls",
                       "total_outbound_calls")


@query("u30_coverage_flag", """
with s as (select max(l_shipdate) as latest, min(l_shipdate) as earliest from lineitem where l_returnflag = 'R')
select o_orderkey, case when o_orderdate > latest or o_orderdate < earliest
  or cast(o_orderdate as date) between date '1998-10-27' and date '1998-11-06' then 1 else 0 end as outside_flag
from orders, s
""")
def _(t):
    returned = t.lineitem.filter(F.col("l_returnflag") == "R")
    rows = att.coverage_flag(
        t.orders, "o_orderdate", returned, "l_shipdate", [("1998-10-27", "1998-11-06")], "outside_flag")
    return rows.select("o_orderkey", "outside_flag")


@query("u31_rule_flags", """
select o_orderkey,
  case when o_orderpriority like '%LOW' or o_orderstatus = 'P' then 1 else 0 end as duplicate_flag,
  case when o_orderpriority like '%URGENT' or o_orderstatus = 'O' then 0 else 1 end as valid_flag,
  case when o_orderstatus in ('F', 'O') and o_orderpriority not in ('5-LOW') and o_totalprice is not null
    then 1 else 0 end as closed_flag
from orders
""")
def _(t):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    rows = text.rule_flags(t.orders, {
        "duplicate_flag": priority.like("%LOW") | (status == "P"),
        "valid_flag": ~(priority.like("%URGENT") | (status == "O")),
        "closed_flag": status.isin("F", "O") & ~priority.isin("5-LOW") & F.col("o_totalprice").isNotNull(),
    })
    return rows.select("o_orderkey", "duplicate_flag", "valid_flag", "closed_flag")


@query("u32_after_event_flag", """
select l_orderkey, l_partkey, l_linenumber, case when l_shipdate > limit_date then 1 else 0 end as after_flag,
  max(case when l_shipdate > limit_date and l_returnflag = 'R' then 1 else 0 end) over (partition by l_orderkey)
    as any_returned_after
from (select l.*, case when o_orderstatus <> 'P' then o_orderdate + interval 30 day end as limit_date
  from lineitem l join orders on l_orderkey = o_orderkey)
""")
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "limit_date", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("interval 30 days")))
    rows = rows.withColumn("after_flag", att.after_event_flag("l_shipdate", "limit_date"))
    returned = F.when(F.col("l_returnflag") == "R", F.col("after_flag")).otherwise(0)
    rows = keyed.attach(rows, ["l_orderkey"], any_returned_after=F.max(returned))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "after_flag", "any_returned_after")
