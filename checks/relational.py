"""The plain building blocks: sources, projections, filters, joins, aggregates, windows, functions."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from calloom.functions import calendar as cal, text
from calloom.operators import forecast as fc, keyed
from calloom.operators.attribution import rank_ids
from calloom.operators.ordered import id_range, ordered
from calloom.operators.spine import entity_spine
from calloom.session import checkpoint_dir
from calloom.sources import read_report, write_report
from checks.registry import query


def order_day():
    return F.to_date("o_orderdate")


def shipments(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


# sources and sinks

@query("s01_scan_table", "select n_nationkey, n_name, n_regionkey from nation")
def _(t):
    return t.nation


@query("s02_report_chain", """
with d as (select cast(o_orderdate as date) as date, o_orderstatus as status, count(*) as n from orders group by 1, 2)
select strftime(date, '%Y-%m') as month, status, cast(sum(n) as bigint) as n from d group by 1, 2
""")
def _(t):
    daily = t.orders.groupBy(order_day().alias("date"), F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n")).withColumn("month", cal.month_key(F.col("date")))
    path = f"{checkpoint_dir(t.spark)}/orders_per_day_{uuid.uuid4().hex}"
    write_report(daily, path, partition_by="month")
    # partition values come back typed by inference, so the month is taken from the date again
    back = read_report(t.spark, path).withColumn("month", cal.month_key(F.col("date")))
    return back.groupBy("month", "status").agg(F.sum("n").alias("n"))


@query("s03_date_list", """
select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day))
  as date) as date from orders
""")
def _(t):
    limits = t.orders.agg(F.min(order_day()).alias("low"), F.max(order_day()).alias("high"))
    return limits.select(F.explode(cal.days(F.col("low"), F.col("high"))).alias("date"))


@query("s04_unnest_entries", """
select event_id, 'k' as key, json_extract_string(props, '$.k') as value from events
""")
def _(t):
    entries = F.map_entries(F.from_json("props", "map<string,string>"))
    return t.events.select("event_id", F.inline(entries))


@query("s05_distinct_values", "select distinct c_mktsegment as segment, c_nationkey as nation from customer")
def _(t):
    return t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).distinct()


# projections and filters

@query("p01_projection", """
select o_orderkey as id, o_custkey, cast(o_totalprice as bigint) * 0 + 1 as one, 'order' as kind,
  cast(null as varchar) as note, cast(null as date) as closed,
  case when o_orderstatus = 'F' then 'done' when o_orderstatus = 'O' then 'open' else 'other' end as state,
  case when o_orderpriority = '1-URGENT' then 1 end as urgent
from orders
""")
def _(t):
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_orderkey").alias("id"), "o_custkey", F.lit(1).cast("long").alias("one"), F.lit("order").alias("kind"),
        F.lit(None).cast("string").alias("note"), F.lit(None).cast("date").alias("closed"),
        F.when(status == "F", "done").when(status == "O", "open").otherwise("other").alias("state"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).alias("urgent"))


@query("p02_star_and_replace", """
select * exclude (c_name) replace (c_acctbal * 2 as c_acctbal), lower(c_mktsegment) as segment from customer
""")
def _(t):
    rows = t.customer.select("*", F.lower("c_mktsegment").alias("segment")).drop("c_name")
    return rows.withColumn("c_acctbal", F.col("c_acctbal") * 2)


@query("p09_filters", """
select o_orderkey from orders
where o_orderstatus <> 'P' and o_totalprice >= 1000 and o_totalprice < 400000 and o_custkey > 5
  and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW') and o_orderpriority not in ('2-HIGH')
  and o_orderpriority like '%-%' and o_orderpriority not like '%URGENT'
  and cast(o_orderdate as date) between date '1996-01-01' and date '2000-12-31' and o_custkey is not null
""")
def _(t):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return t.orders.filter(
        (F.col("o_orderstatus") != "P") & (price >= 1000) & (price < 400000) & (F.col("o_custkey") > 5)
        & priority.isin("1-URGENT", "2-HIGH", "5-LOW") & ~priority.isin("2-HIGH")
        & priority.like("%-%") & ~priority.like("%URGENT")
        # compared as timestamps, so that the limits reach the scan
        & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")) & F.col("o_custkey").isNotNull()
    ).select("o_orderkey")


@query("p15_precedence", """
select event_id, case when event_type = 'click' and value > 10 or event_type = 'view' and value <= 10 then 1 else 0 end
  as hit, case when coalesce(case when event_type <> 'error' then event_type in ('click') end, props like '%1%') then 1
  else 0 end as either
from events
""")
def _(t):
    kind, value = F.col("event_type"), F.col("value")
    known = F.when(kind != "error", kind.isin("click"))
    return t.events.select(
        "event_id", text.flag(((kind == "click") & (value > 10)) | ((kind == "view") & (value <= 10))).alias("hit"),
        text.flag(F.coalesce(known, F.col("props").like("%1%"))).alias("either"))


# joins

@query("j01_left_join", """
select o_orderkey, c_name, c_mktsegment from orders left join customer on c_custkey = o_custkey and c_acctbal > 0
""")
def _(t):
    rich = t.customer.filter(F.col("c_acctbal") > 0)
    return t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "c_name", "c_mktsegment")


@query("j02_left_join_two_keys", """
with d as (select o_custkey, cast(o_orderdate as date) as day, count(*) as n from orders group by 1, 2)
select l_orderkey, l_linenumber, l_partkey, n
from lineitem join orders o on o_orderkey = l_orderkey
left join d on d.o_custkey = o.o_custkey and d.day = cast(l_shipdate as date)
""")
def _(t):
    daily = t.orders.groupBy("o_custkey", order_day().alias("day")).agg(F.count("*").alias("n"))
    rows = shipments(t).withColumn("day", F.to_date("l_shipdate"))
    return rows.join(daily, ["o_custkey", "day"], "left").select("l_orderkey", "l_linenumber", "l_partkey", "n")


@query("j03_full_join", """
with a as (select cast(o_orderdate as date) as day, count(*) as orders from orders where o_orderstatus = 'F' group by 1),
b as (select cast(l_shipdate as date) as day, count(*) as lines from lineitem where l_returnflag = 'R' group by 1)
select coalesce(a.day, b.day) as day, orders, lines from a full join b on a.day = b.day
""")
def _(t):
    orders = t.orders.filter("o_orderstatus = 'F'").groupBy(order_day().alias("day")).agg(F.count("*").alias("orders"))
    lines = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        F.count("*").alias("lines"))
    return orders.join(lines, "day", "full")


@query("j04_right_join_made_inner", """
select c_custkey, o_orderkey from orders right join customer on c_custkey = o_custkey where o_totalprice > 300000
""")
def _(t):
    dear = t.orders.filter(F.col("o_totalprice") > 300000)
    return dear.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "o_orderkey")


@query("j05_left_join_made_inner", """
select s_suppkey, n_name from supplier left join nation on n_nationkey = s_nationkey where n_regionkey = 2
""")
def _(t):
    near = t.nation.filter(F.col("n_regionkey") == 2)
    return t.supplier.join(near, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")


@query("j06_join_one_row", """
select o_orderkey, round(o_totalprice / (select max(o_totalprice) from orders), 8) as part from orders
""")
def _(t):
    most = t.orders.agg(F.max("o_totalprice")).scalar()
    return t.orders.select("o_orderkey", F.round(F.col("o_totalprice") / most, 8).alias("part"))


@query("j07_spine_by_entities", """
select s_suppkey, cast(d as date) as date
from supplier, (select unnest(generate_series(date '2001-01-01', date '2001-03-31', interval 1 day)) as d)
""")
def _(t):
    return entity_spine(t.supplier.select("s_suppkey"), "2001-01-01", "2001-03-31")


@query("j10_join_own_history", """
with f as (select o_custkey, o_orderdate, min(o_orderkey) as first_key from orders group by 1, 2)
select a.o_orderkey, f.first_key from orders a left join f on f.o_custkey = a.o_custkey and f.o_orderdate = a.o_orderdate
""")
def _(t):
    first = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.min("o_orderkey").alias("first_key"))
    return t.orders.join(first, ["o_custkey", "o_orderdate"], "left").select("o_orderkey", "first_key")


# aggregates

@query("a01_grouped_aggregates", """
select l_returnflag, l_linestatus, cast(sum(l_quantity) as bigint) as quantity, count(*) as n,
  count(case when l_tax > 0.05 then l_orderkey end) as taxed,
  cast(sum(case when l_discount > 0.05 then l_quantity end) as bigint) as reduced,
  count(distinct l_orderkey) as orders, count(distinct case when l_quantity > 40 then l_orderkey end) as big_orders,
  count(distinct case when l_quantity < 5 then l_partkey end) as small_parts,
  max(case when l_quantity = 50 then 1 else 0 end) as any_full, min(case when l_quantity > 0 then 1 else 0 end) as all_some,
  min(l_extendedprice) as least, max(l_extendedprice) as most,
  max(case when l_shipdate >= date '2001-01-01' then l_extendedprice end) as most_recent,
  round(sum(l_quantity) / nullif(count(case when l_linenumber > 6 then 1 end), 0), 6) as ratio
from lineitem group by 1, 2
""")
def _(t):
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    since = F.lit("2001-01-01").cast("timestamp_ntz")
    by = ["l_returnflag", "l_linestatus"]
    orders = keyed.count_ids(t.lineitem, by, "l_orderkey", {"orders": None, "big_orders": quantity > 40})
    return t.lineitem.groupBy(*by).agg(
        F.sum("l_quantity").cast("long").alias("quantity"), F.count("*").alias("n"),
        F.count(F.when(F.col("l_tax") > 0.05, F.col("l_orderkey"))).alias("taxed"),
        F.sum(F.when(F.col("l_discount") > 0.05, quantity)).cast("long").alias("reduced"),
        F.count_distinct(F.when(quantity < 5, F.col("l_partkey"))).alias("small_parts"),
        F.max(text.flag(quantity == 50)).alias("any_full"), F.min(text.flag(quantity > 0)).alias("all_some"),
        F.min(price).alias("least"), F.max(price).alias("most"),
        F.max(F.when(F.col("l_shipdate") >= since, price)).alias("most_recent"),
        F.round(F.try_divide(F.sum("l_quantity"), F.count(F.when(F.col("l_linenumber") > 6, 1))), 6).alias("ratio"),
    ).join(orders, by)


@query("a10_group_by_all_columns", """
select user_id, event_type, cast(ts as date) as day, count(*) as n from events group by all
""")
def _(t):
    rows = t.events.select("user_id", "event_type", F.to_date("ts").alias("day"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query("a11_distinct", "select distinct o_custkey, o_orderstatus from orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query("a13_global_aggregate", """
select count(*) as n, max(o_orderkey) as last_key, count(distinct o_custkey) as customers,
  round(sum(case when o_orderstatus = 'O' then 1 else 0 end) / 6, 6) as open_per_day from orders
""")
def _(t):
    return t.orders.agg(
        F.count("*").alias("n"), F.max("o_orderkey").alias("last_key"), F.count_distinct("o_custkey").alias("customers"),
        F.round(F.try_divide(F.sum(text.flag(F.col("o_orderstatus") == "O")), F.lit(6)), 6).alias("open_per_day"))


# windows; those over a whole key are spread or aggregated, see calloom.operators

@query("w01_row_number", """
select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as nth,
  case when o_orderstatus = 'F' then row_number() over (partition by o_custkey, o_orderstatus = 'F'
    order by o_orderdate, o_orderkey) end as nth_finished,
  case when o_orderstatus = 'F' and row_number() over (partition by o_custkey, o_orderstatus = 'F'
    order by o_orderdate desc, o_orderkey desc) = 1 then 1 else 0 end as last_finished
from orders
""")
def _(t):
    rows = t.orders.withColumn("done", F.col("o_orderstatus") == "F")
    order, slices = ["o_orderdate", "o_orderkey"], [F.trunc("o_orderdate", "year")]
    numbered = ordered(rows, ["o_custkey"], order, slices, row_number="nth")
    numbered = ordered(numbered, ["o_custkey", "done"], order, slices, row_number="n", row_number_desc="m")
    return numbered.select(
        "o_orderkey", "nth", F.when(F.col("done"), F.col("n")).alias("nth_finished"),
        text.flag(F.col("done") & (F.col("m") == 1)).alias("last_finished"))


@query("w04_dense_rank", """
select l_orderkey, l_partkey, l_linenumber, dense_rank() over (partition by l_suppkey order by l_orderkey) as order_rank
from lineitem
""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    return rank_ids(rows, ["l_suppkey"], "l_orderkey", [id_range("l_orderkey")], "order_rank").drop("l_suppkey")


@query("w06_lag_lead", """
select event_id, lag(value) over w as previous, lead(event_type) over w as following
from events window w as (partition by user_id order by ts, event_id)
""")
def _(t):
    rows = ordered(
        t.events, ["user_id"], ["ts", "event_id"], [F.to_date("ts")], lag={"previous": "value"},
        lead={"following": "event_type"})
    return rows.select("event_id", "previous", "following")


DAYS = """
with d as (select cast(o_orderdate as date) as date, count(*) as n, cast(sum(o_custkey) as bigint) as keys,
  sum(case when o_orderpriority = '1-URGENT' then 1 end) as urgent from orders group by 1)
"""


def per_day(t):
    return t.orders.groupBy(order_day().alias("date")).agg(
        F.count("*").alias("n"), F.sum("o_custkey").alias("keys"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent"))


@query("w07_daily_lags_and_frames", DAYS + """
select date, lag(n, 1) over a as lag_1, lag(n, 6) over a as lag_6, lead(n, 8) over z as lead_8,
  cast(sum(n) over (order by date rows between 28 preceding and 1 preceding) as bigint) as trailing,
  cast(sum(n) over (order by date rows between 49 preceding and 22 preceding) as bigint) as shifted,
  (select max_by(urgent, date) from d where urgent is not null)::bigint as last_urgent
from d window a as (order by date), z as (order by date desc)
""")
def _(t):
    rows = per_day(t)
    by_date, backwards = Window.orderBy("date"), Window.orderBy(F.desc("date"))
    rows = fc.carry_forward(rows.withColumn("every", F.lit(1)), {"last_urgent": "urgent"}, "date", "every")
    return rows.select(
        "date", F.lag("n", 1).over(by_date).alias("lag_1"), F.lag("n", 6).over(by_date).alias("lag_6"),
        F.lead("n", 8).over(backwards).alias("lead_8"), fc.trailing_sum("n", "date", 28, 1).alias("trailing"),
        fc.trailing_sum("n", "date", 49, 22).alias("shifted"), "last_urgent")


@query("w12_key_aggregates", """
select event_id, round(sum(value) over u, 2) as total, count(value) over u as n, max(ts) over u as latest,
  min(case when event_type = 'click' then ts end) over u as first_click,
  case when event_type = 'view' then min(ts) over (partition by user_id, event_type = 'view') end as first_view,
  max(value) over () as most, min(value) over () as least, count(event_id) over () as everything,
  first_value(event_type) over (partition by user_id order by event_type) as first_type
from events window u as (partition by user_id)
""")
def _(t):
    rows = keyed.attach(
        t.events, ["user_id"], total=F.round(F.sum("value"), 2), n=F.count("value"), latest=F.max("ts"),
        first_click=F.min(F.when(F.col("event_type") == "click", F.col("ts"))),
        view=F.min(F.when(F.col("event_type") == "view", F.col("ts"))), first_type=F.min("event_type"))
    rows = keyed.attach_total(
        rows, t.events, most=F.max("value"), least=F.min("value"), everything=F.count("event_id"))
    first_view = F.when(F.col("event_type") == "view", F.col("view")).alias("first_view")
    return rows.select("event_id", "total", "n", "latest", "first_click", first_view, "most", "least", "everything",
                       "first_type")


@query("w13_conditional_partition_sum", """
select o_orderkey, case when o_orderdate >= date '2000-01-01' then cast(sum(o_custkey) over (
  partition by o_orderdate >= date '2000-01-01', o_orderpriority) as bigint) end as recent
from orders
""")
def _(t):
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    rows = keyed.attach(t.orders, ["o_orderpriority"], recent=F.sum(F.when(late, F.col("o_custkey"))))
    return rows.select("o_orderkey", F.when(late, F.col("recent")).alias("recent"))


@query("w17_distinct_over_partition", """
select o_orderkey, count(distinct o_custkey) over (partition by o_orderpriority) as customers,
  round(avg(o_custkey) over (partition by o_orderpriority), 6) as mean_key from orders
""")
def _(t):
    rows = keyed.attach(
        t.orders, ["o_orderpriority"], customers=F.count_distinct("o_custkey"), mean_key=F.round(F.avg("o_custkey"), 6))
    return rows.select("o_orderkey", "customers", "mean_key")


@query("o02_top_one_per_key", """
select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey
  order by o_orderdate desc, o_orderkey desc) as nth from orders) where nth = 1
""")
def _(t):
    last = t.orders.groupBy("o_custkey").agg(
        keyed.pick_by(["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"], last=True).alias("last"))
    return last.select("o_custkey", "last.o_orderkey", "last.o_totalprice")


@query("o04_ranked_source_filter", """
with r as (select c_custkey, dense_rank() over (partition by c_nationkey order by c_custkey) as place from customer)
select c_custkey from r where place = 1
""")
def _(t):
    ranked = rank_ids(t.customer.select("c_custkey", "c_nationkey"), ["c_nationkey"], "c_custkey",
                      [id_range("c_custkey")], "place")
    return ranked.filter(F.col("place") == 1).select("c_custkey")


# functions

@query("f01_arithmetic", """
select l_orderkey, l_partkey, l_linenumber, l_quantity / nullif(l_tax, 0) as divided,
  l_quantity * l_extendedprice as multiplied, l_quantity + l_extendedprice as added,
  l_quantity - l_extendedprice as subtracted, round(l_quantity / 8, 1) as rounded, -(l_quantity - 1) / 4 as signed,
  coalesce(case when l_tax > 0.04 then l_tax end, l_discount, 0) as filled
from lineitem
""")
def _(t):
    quantity, price, tax = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.try_divide(quantity, tax).alias("divided"),
        F.try_multiply(quantity, price).alias("multiplied"), F.try_add(quantity, price).alias("added"),
        F.try_subtract(quantity, price).alias("subtracted"), F.round(quantity / 8, 1).alias("rounded"),
        (-(quantity - 1) / 4).alias("signed"),
        F.coalesce(F.when(tax > 0.04, tax), F.col("l_discount"), F.lit(0.0)).alias("filled"))


@query("f07_strings", r"""
select o_orderkey, o_orderstatus || '-' || o_orderkey as joined, o_orderstatus || nullif(o_orderpriority, '5-LOW') as gap,
  lower(o_orderpriority) as small, substring(o_orderpriority, 3, 4) as part, string_split(o_orderpriority, '-')[2] as word,
  string_split(o_orderpriority, '-')[3] as missing, right(o_orderpriority, 1) as tail,
  nullif(regexp_extract(o_orderpriority, '([0-9])-H', 1), '') as digit, cast(o_orderkey as varchar) as key_text,
  cast(left(o_orderpriority, 1) as bigint) as level
from orders
""")
def _(t):
    priority = F.col("o_orderpriority")
    words = F.split(priority, "-")
    return t.orders.select(
        "o_orderkey", F.concat("o_orderstatus", F.lit("-"), "o_orderkey").alias("joined"),
        F.concat("o_orderstatus", F.nullif(priority, F.lit("5-LOW"))).alias("gap"), F.lower(priority).alias("small"),
        F.substring(priority, 3, 4).alias("part"), F.get(words, F.lit(1)).alias("word"),
        F.get(words, F.lit(2)).alias("missing"), F.right(priority, F.lit(1)).alias("tail"),
        text.first_match(priority, "([0-9])-H").alias("digit"), F.col("o_orderkey").cast("string").alias("key_text"),
        F.left(priority, F.lit(1)).cast("long").alias("level"))


@query("f15_dates", """
with d as (select o_orderkey, o_orderdate as ts, cast(o_orderdate as date) as day from orders)
select o_orderkey, day, cast(extract(dow from day) + 1 as integer) as weekday, cast(isodow(day) as integer) as iso_day,
  cast(extract(day from day) as integer) as dom, cast(extract(year from day) as integer) as year,
  strftime(day, '%G-W%V') as iso_week, strftime(day, '%Y-W%W') as monday_week, strftime(day, '%Y-%m') as month,
  day + 30 as later, day - 30 as earlier, cast(day + interval 12 month as date) as next_year,
  cast(day + interval 1 month as date) as next_month, ts - interval 60 minute as hour_before,
  cast(date_diff('day', day, date '2001-06-01') as integer) as age, len(generate_series(day, day + 3, interval 1 day))::integer
    as n_days
from d
""")
def _(t):
    day, ts = order_day(), F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", day.alias("day"), F.dayofweek(day).alias("weekday"), cal.iso_weekday(day).alias("iso_day"),
        F.dayofmonth(day).alias("dom"), F.year(day).alias("year"), cal.iso_week(day).alias("iso_week"),
        cal.monday_week(day).alias("monday_week"), cal.month_key(day).alias("month"), F.date_add(day, 30).alias("later"),
        F.date_sub(day, 30).alias("earlier"), F.add_months(day, 12).alias("next_year"),
        F.add_months(day, 1).alias("next_month"), (ts - F.expr("interval 60 minutes")).alias("hour_before"),
        F.datediff(cal.as_date("2001-06-01"), day).alias("age"),
        F.size(cal.days(day, F.date_add(day, 3))).alias("n_days"))


@query("f16_times", """
select event_id, cast(extract(hour from ts) * 3600 + extract(minute from ts) * 60 + extract(second from ts) as integer)
    as seconds, strftime(ts, '%H:%M:%S') as clock,
  date_diff('second', timestamp '2024-01-01 00:00:00.9', ts) as since
from events
""")
def _(t):
    seconds = cal.seconds_of_day(F.col("ts"))
    start = F.lit("2024-01-01 00:00:00.9").cast("timestamp_ntz")
    return t.events.select(
        "event_id", seconds.alias("seconds"), cal.time_text(seconds).alias("clock"),
        cal.seconds_between(F.col("ts"), start).alias("since"))
