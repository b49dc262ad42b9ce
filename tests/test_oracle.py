"""Every registered query against DuckDB, on the smallest tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import catalog
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_duckdb(spark, con, name):
    verdict = compare(spark, con, name, SF_DIR)
    assert re.match(r"ok \d", verdict), verdict


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) and set(catalog.QUERIES) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["date", "event_type", "reporting_week", "n", "total"] and not rows.isEmpty()


def test_reports_written_in_order_equal_the_queries(spark, tmp_path):
    from calloom import plans
    from calloom.session import stage_folder
    from calloom.sources import Tables, refresh_report
    from checks.domain import AS_OF, START, domain
    from checks.reports import GAPS

    tables, folder = domain(Tables(spark, SF_DIR)), stage_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    done = plans.materialise(
        tables, str(tmp_path), AS_OF, START, gaps=GAPS, excluded_campaign="%SPECIAL%", forecast_start=START,
        refresh=True)
    # nothing is left of the intermediate tables
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before
    calls = plans.call_performance(tables, GAPS)
    want = {
        "demand_forecast": plans.demand_forecast(tables, calls, AS_OF, START, excluded_campaign="%SPECIAL%"),
        "workforce_days": plans.workforce_days(tables, AS_OF, START),
        "call_performance": calls,
        "crm_events": plans.crm_events(tables),
        "market_fit": plans.market_fit(tables),
    }
    assert len(done) == 10
    for name, report in want.items():
        assert done[name].columns == report.columns
        got, expected = (rows.withColumns({
            c: F.round(c, 6) for c, kind in rows.dtypes if kind == "double"}) for rows in (done[name], report))
        assert got.count() == expected.count() > 0, name
        assert got.exceptAll(expected).isEmpty(), name
    # a refresh finds nothing to rewrite, and leaves the files alone
    def written(name):
        folder = tmp_path / name
        return {(str(f), f.stat().st_mtime_ns) for f in folder.rglob("*.parquet")}

    before = {name: written(name) for name in ("workforce_days", "call_performance")}
    assert refresh_report(want["workforce_days"], str(tmp_path / "workforce_days"), "date").isEmpty()
    assert refresh_report(want["call_performance"], str(tmp_path / "call_performance"), "ticket_date").isEmpty()
    assert all(before[name] == written(name) and before[name] for name in before)
    # the capacity plan reads the dates from its day on only
    plan = plans.capacity_plan(tables, done["demand_forecast"], done["workforce_days"], AS_OF)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= ", text)


def test_the_forecast_has_a_start_of_its_own():
    import inspect

    from calloom.plans import demand_forecast, materialise

    start = inspect.signature(materialise).parameters["forecast_start"].default
    assert start == inspect.signature(demand_forecast).parameters["start"].default == "2020-09-01"
