"""What the plans must not contain, and what must reach the scans."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from calloom.operators import attribution as att, keyed
from calloom.operators.ordered import hours, ordered
from calloom.operators.spine import entity_spine, pack_months
from calloom.session import checkpoint_dir, folder_exists, stage, stage_of
from checks import catalog

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# their windows run over one row per calendar date
DAILY = {"u45", "u46", "u47", "u48", "u49", "u56", "w07", "r08", "r09"}
# a result of one row
GLOBAL = {"a13", "s03", "u55"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# reports write intermediate tables while they are built; their own plan is what is left
@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_no_products_no_python_no_single_task(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    if name.split("_")[0] not in DAILY | GLOBAL:
        outside = re.sub(r"Subquery .*", "", text, flags=re.S)
        assert "SinglePartition" not in outside


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.QUERIES["p09_filters"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", text)
    assert "ReadSchema" in text and "o_orderstatus" in text
    text = plan(catalog.QUERIES["u18_first_id"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", text)


def test_an_aggregate_is_combined_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(keyed.attach(orders, ["o_orderstatus"], n=F.count("*")))
    assert "partial_count" in text and "Window" not in text


def test_a_key_is_never_one_window(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(ordered(events, ["user_id"], ["ts", "event_id"], [hours("ts")], row_number="n"))
    # the windows over rows are cut by key and slice; the one over keys alone reads the slice summaries
    assert len(re.findall(r"hashpartitioning\(__k0#\d+L?, __k0_null#\d+, __s0#\d+, __s0_null#\d+", text)) >= 2
    assert re.search(r"Window \[row_number\(\).*?\], \[__k0#\d+L?, __k0_null#\d+, __s0#\d+, __s0_null#\d+\]", text)


@pytest.mark.parametrize("name", ["w01_row_number", "w06_lag_lead", "u14_sequence_events", "u29_call_ranks", "u41_reset_after"])
def test_ordered_rows_and_summaries_share_one_scan_and_exchange(spark, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("name", ["a01_grouped_aggregates", "u60_kpis_by_dim", "r08_demand_forecast", "r10_market_fit"])
def test_distinct_counts_copy_no_rows(spark, name):
    assert "Expand" not in plan(catalog.QUERIES[name](spark, SF_DIR))


def test_fallbacks_need_no_window(spark):
    assert "Window" not in plan(catalog.QUERIES["u04_fallback_rank"](spark, SF_DIR))


def test_cohorts_pass_on_two_rows_of_a_key(spark):
    text = plan(catalog.QUERIES["u13_rerun_cohort_date"](spark, SF_DIR))
    assert text.count("Scan parquet") <= 2 and re.search(r"WindowGroupLimit .*, 2, Partial", text)


def test_assignment_joins_by_equality_only(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderdate")
    calls = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_custkey", F.col("o_orderdate").alias("at"))
    spans = att.ticket_intervals(orders, ["o_custkey"], "o_orderdate", "o_orderkey")
    rows = att.assign_interval(spans, calls, ["o_custkey"], "o_orderdate", "at", F.lit(True))
    # each lookup has the key and a moment: never all tickets of a key
    for keys in re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[(.*?)\]", plan(rows)):
        assert "," in keys, keys


def test_stages_live_in_the_checkpoint_folder(spark):
    rows = stage(spark.range(10).withColumn("k", F.col("id") % 3))
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) in rows.inputFiles()[0] and rows.count() == 10


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {name for name in names if name.startswith("shuffle_")}


def test_a_stage_frees_what_was_shuffled_for_it(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = shuffle_files(spark), spark.conf.get(name)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    done = [stage(rows), stage(rows)]
    for _ in range(50):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(name) == kept
    assert [copy.agg(F.sum("n")).first()[0] for copy in done] == [499500, 499500]


def test_a_stage_of_steps_leaves_its_result_only(spark):
    made = []

    def build():
        rows = stage(spark.range(10))
        made.append(os.path.dirname(rows.inputFiles()[0]))
        return rows.withColumn("n", F.col("id") * 2)

    assert stage_of(spark, build).agg(F.sum("n")).first()[0] == 90
    assert not folder_exists(spark, made[0])


def test_agents_by_dates_are_not_shuffled(spark):
    text = plan(catalog.QUERIES["r07_agent_performance"](spark, SF_DIR))
    above, spread, _ = text.partition("Generate inline")
    assert spread and "hashpartitioning" not in above


def test_packed_facts_meet_a_spine_as_joined_ones(spark, table):
    agents = table("a string, m int", ["x", 1], ["x", 2], ["y", 3], [None, 4])
    facts = table("a string, date date, n int, h double", ["x", "2021-01-31", 1, 0.5], ["x", "2021-02-01", None, 1.5],
                  ["x", "2021-02-01", 2, None], ["z", "2021-02-01", 9, 9.0], ["x", "2021-03-03", 9, 9.0],
                  ["x", "2021-01-29", 9, 9.0], [None, "2021-02-01", 9, 9.0], ["y", None, 9, 9.0])
    for first, last in (("2021-01-30", "2021-03-02"), ("2021-02-01", "2021-02-01"), ("2021-02-02", "2021-02-01")):
        want = entity_spine(agents, first, last).join(facts, ["a", "date"], "left")
        got = entity_spine(agents, first, last, facts=pack_months(facts, "a"), on="a").select(*want.columns)
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_the_forecast_joins_written_facts(spark, table):
    from calloom.plans.demand_forecast import actuals
    from calloom.sources import Tables
    from checks.domain import domain

    calls = table("agent_name string, call_id long, call_type string, interaction_flag int, call_date date",
                  ["Ann", 1, "Outbound", 1, "1999-03-01"])
    days = actuals(domain(Tables(spark, SF_DIR)), calls, "2000-06-01", "1995-01-01", 12, None)
    # one fact's shuffles at a time: each is a small table before the next is made
    assert "lineitem.parquet" not in plan(days)
    assert days.filter("date = '1999-03-01'").first().act_outbound_calls_reached == 1


def test_a_capacity_plan_leaves_its_reports_only(spark):
    from calloom import plans
    from calloom.sources import Tables
    from checks.domain import AS_OF, START, domain

    d, before = domain(Tables(spark, SF_DIR)), shuffle_files(spark)
    with plans.shared_reports(spark) as reports:
        calls = reports.get(plans.call_performance, d)
        forecast = reports.get(plans.demand_forecast, d, performance=calls, as_of=AS_OF, start=START)
        workforce = reports.get(plans.workforce_days, d, as_of=AS_OF, start=START)
        rows = plans.capacity_plan(d, forecast, workforce, AS_OF)
        for _ in range(50):  # they go in the background
            if not (left := shuffle_files(spark) - before):
                break
            time.sleep(0.2)
        assert not left and len(os.listdir(reports.folder.removeprefix("file:"))) == 3
        assert rows.count() == 31
