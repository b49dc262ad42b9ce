"""Reports shared in a session, refreshed by date, and checks of planned tables."""

import os

import pytest
from pyspark.sql import functions as F

from calloom import plans
from calloom.session import drop_stages, folder_exists, stage, staged
from calloom.sources import Tables, duplicate_keys, read_report, refresh_report, write_report
from tests.conftest import day, values


def per_date(tables, at_least=0):
    rows = tables["facts"].filter(F.col("n") >= at_least)
    return rows.groupBy("date").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))


def counting(build):
    """The function, and a list that grows with each call of it."""
    calls = []

    def run(tables, **arguments):
        calls.append(arguments)
        return build(tables, **arguments)

    return run, calls


def files(path):
    """The data files of each partition, with their times."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(os.path.relpath(folder, path), set()).add((name, os.stat(f"{folder}/{name}").st_mtime_ns))
    return found


def write(table, path, *rows):
    table("date date, n int", *rows).write.mode("overwrite").parquet(path)


def test_a_report_is_computed_once_for_the_same_tables_and_arguments(spark, table, tmp_path):
    write(table, f"{tmp_path}/facts.parquet", ["2021-01-01", 1], ["2021-01-02", 2])
    write(table, f"{tmp_path}/other.parquet", ["2021-01-01", 1])
    build, calls = counting(per_date)
    with plans.shared_reports(spark) as reports:
        first = reports.get(build, Tables(spark, str(tmp_path)))
        # other Tables on the same files, and a change of a table that the report does not read
        write(table, f"{tmp_path}/other.parquet", ["2021-01-01", 9])
        again = reports.get(build, Tables(spark, str(tmp_path)))
        assert values(first) == values(again) == [(day("2021-01-01"), 1, 1), (day("2021-01-02"), 2, 1)]
        assert len(calls) == 1
        assert reports.get(build, Tables(spark, str(tmp_path)), at_least=2).count() == 1
        assert reports.get(build, Tables(spark, str(tmp_path)), at_least=1).count() == 2
        assert len(calls) == 3
        # a report is an argument like any other
        outer, outer_calls = counting(lambda tables, per_day: per_day.agg(F.sum("n").alias("n")))
        for _ in range(2):
            rows = reports.get(outer, Tables(spark, str(tmp_path)), per_day=reports.get(build, Tables(spark, str(tmp_path))))
            assert values(rows) == [(3,)]
        assert len(outer_calls) == 1 and len(calls) == 3
        folder = reports.folder
        assert folder_exists(spark, folder)
    assert not folder_exists(spark, folder)


def test_a_rewritten_table_and_a_dropped_folder_make_a_report_anew(spark, table, tmp_path):
    write(table, f"{tmp_path}/facts.parquet", ["2021-01-01", 1])
    build, calls = counting(per_date)
    with staged(spark), plans.shared_reports(spark) as reports:
        assert values(reports.get(build, Tables(spark, str(tmp_path))), "n") == [(1,)]
        write(table, f"{tmp_path}/facts.parquet", ["2021-01-01", 5])
        assert values(reports.get(build, Tables(spark, str(tmp_path))), "n") == [(5,)]
        drop_stages(spark)
        assert values(reports.get(build, Tables(spark, str(tmp_path))), "n") == [(5,)]
    assert len(calls) == 3


def test_intermediate_tables_of_a_shared_report_are_removed(spark, table, tmp_path):
    write(table, f"{tmp_path}/facts.parquet", ["2021-01-01", 1])
    seen = []

    def build(tables):
        rows = stage(tables["facts"])
        seen.append(os.path.dirname(rows.inputFiles()[0]))
        return rows.groupBy("date").count()

    with plans.shared_reports(spark) as reports:
        assert reports.get(build, Tables(spark, str(tmp_path))).count() == 1
        assert not folder_exists(spark, seen[0])


def test_refresh_rewrites_the_dates_that_changed_and_no_other(spark, table, tmp_path):
    path, schema = str(tmp_path / "r"), "date date, k string, n double"
    old = [["2021-01-01", "a", 1.0], ["2021-01-01", "b", None], ["2021-01-02", "a", 2.0], ["2021-01-03", "a", 3.0],
           [None, "x", float("nan")], ["2021-01-04", "gone", 4.0]]
    assert values(refresh_report(table(schema, *old), path, "date"), "date", "rows_before", "rows_after") == sorted(
        [(day("2021-01-01"), 0, 2), (day("2021-01-02"), 0, 1), (day("2021-01-03"), 0, 1), (day("2021-01-04"), 0, 1),
         (None, 0, 1)], key=repr)
    before = files(path)
    # another order of rows; one value changed, one copy more, one date gone, one new
    new = [["2021-01-01", "b", None], ["2021-01-01", "a", 1.0], ["2021-01-02", "a", 2.5], ["2021-01-03", "a", 3.0],
           ["2021-01-03", "a", 3.0], [None, "x", float("nan")], ["2021-01-05", "a", 5.0]]
    changed = refresh_report(table(schema, *new), path, "date")
    assert values(changed, "date", "rows_before", "rows_after") == [
        (day("2021-01-02"), 1, 1), (day("2021-01-03"), 1, 2), (day("2021-01-04"), 1, 0), (day("2021-01-05"), 0, 1)]
    after = files(path)
    kept = {"date=2021-01-01", "date=__HIVE_DEFAULT_PARTITION__"}
    assert {p for p in after if before.get(p) == after[p]} == kept
    assert set(after) == kept | {"date=2021-01-02", "date=2021-01-03", "date=2021-01-05"}
    got = read_report(spark, path, table(schema, *new).schema)
    want = table(schema, *new)  # compared with NaN as a number
    assert values(got.fillna(-1.0), "date", "k", "n") == values(want.fillna(-1.0)) and got.count() == len(new)
    # nothing changed: nothing is written
    assert refresh_report(table(schema, *new), path, "date").isEmpty() and files(path) == after
    # the null date goes too
    rows = [row for row in new if row[0]]
    assert values(refresh_report(table(schema, *rows), path, "date")) == [(None, 1, 0)]
    assert "date=__HIVE_DEFAULT_PARTITION__" not in files(path)


def test_refresh_within_limits_leaves_the_rest(spark, table, tmp_path):
    path, schema = str(tmp_path / "r"), "date date, n int"
    write_report(table(schema, *[[f"2021-01-0{n}", n] for n in range(1, 6)]), path, "date")
    new = table(schema, *[[f"2021-01-0{n}", n * 10] for n in range(1, 6)])
    changed = refresh_report(new, path, "date", low="2021-01-02", high="2021-01-03")
    assert values(changed, "date") == [(day("2021-01-02"),), (day("2021-01-03"),)]
    assert [n for _, n in values(read_report(spark, path), "date", "n")] == [1, 20, 30, 4, 5]


def test_refresh_of_reports_without_rows(spark, table, tmp_path):
    path, schema = str(tmp_path / "r"), "date date, n int"
    none, one = table(schema, ["2021-01-01", 1]).limit(0), table(schema, ["2021-01-01", 1])
    assert refresh_report(none, path, "date").isEmpty()
    assert read_report(spark, path, none.schema).isEmpty()
    assert values(refresh_report(one, path, "date")) == [(day("2021-01-01"), 0, 1)]
    assert values(refresh_report(none, path, "date")) == [(day("2021-01-01"), 1, 0)]
    assert read_report(spark, path, none.schema).isEmpty()
    with pytest.raises(ValueError):
        refresh_report(one, path, "n")


def test_one_days_facts_refresh_the_dates_they_reach(spark, table, tmp_path):
    """A trailing sum over three dates: a late fact rewrites its date and the two after it, as a full build would have them."""

    def trailing(facts):
        reach = facts.select(F.explode(F.sequence("date", F.date_add("date", 2))).alias("date"), "n")
        return reach.groupBy("date").agg(F.sum("n").alias("n"))

    path = str(tmp_path / "r")
    facts = [[f"2021-01-{n:02d}", n] for n in range(1, 20)]
    write_report(trailing(table("date date, n int", *facts)), path, "date")
    late = trailing(table("date date, n int", *facts, ["2021-01-10", 100]))
    changed = refresh_report(late, path, "date")
    assert values(changed, "date") == [(day(f"2021-01-{n}"),) for n in (10, 11, 12)]
    assert values(read_report(spark, path), "date", "n") == values(late)


def test_planned_tables_have_one_row_per_key(spark, table, tmp_path):
    source = Tables(spark, frames={
        "plan": table("week string, n int", ["w1", 1], ["w1", 2], ["w2", 1], [None, 1], [None, 2]),
        "spend": table("date date, n int", ["2021-01-01", 1], ["2021-01-02", 1])})
    assert values(duplicate_keys(source, {"plan": "week", "spend": "date"})) == [("plan", "w1", 2)]
    assert duplicate_keys(source, {"spend": "date"}).isEmpty()
    with pytest.raises(ValueError):
        duplicate_keys(source, {})
    weeks, days = table("reporting_week string", ["w1"], ["w1"]), table("date date", ["2021-01-01"])
    frames = {"fact_ccc_shrinkage_actuals": days, "fact_planned_ccc_staffing": weeks, "fact_planned_marketing_spend": days,
              "fact_planned_ccc_productivity_shrinkage": weeks.distinct()}
    with pytest.raises(ValueError, match="w1 in fact_planned_ccc_staffing"):
        plans.materialise(Tables(spark, frames=frames), str(tmp_path), "2021-01-01", unique_plans=True)
    assert not os.listdir(tmp_path)
