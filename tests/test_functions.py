import datetime as dt

import duckdb
from conftest import values
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from calloom.functions import calendar as cal, text


def test_weeks_at_year_ends(table):
    df = table("d date", ["2020-12-31"], ["2021-01-01"], ["2021-01-03"], ["2021-01-04"], ["2024-12-30"], [None])
    d = F.col("d")
    rows = values(df.select(d, cal.iso_week(d), cal.monday_week(d), cal.half_month(d)))
    assert rows[0] == (None, None, None, None)
    assert [r[1:3] for r in rows[1:]] == [
        ("2020-W53", "2020-W52"), ("2020-W53", "2021-W00"), ("2020-W53", "2021-W00"), ("2021-W01", "2021-W01"),
        ("2025-W01", "2024-W53")]


def test_half_month_edge(table):
    df = table("d date", ["2021-02-14"], ["2021-02-15"])
    assert values(df.select(cal.half_month(F.col("d")))) == [("2021-02-01",), ("2021-02-15",)]


def test_reversed_period_has_no_days(table):
    df = table("a date, b date", ["2021-01-02", "2021-01-01"], ["2021-01-01", "2021-01-01"], [None, "2021-01-01"])
    assert values(df.select(F.explode(cal.days(F.col("a"), F.col("b"))))) == [(dt.date(2021, 1, 1),)]


def test_seconds_between_counts_boundaries(table):
    df = table("a timestamp_ntz, b timestamp_ntz", ["2021-01-01 00:00:00.900", "2021-01-01 00:00:01.100"],
               ["2021-03-28 01:30:00", "2021-03-28 03:30:00"], ["2021-01-02 00:00:00", "2021-01-01 23:59:00"])
    assert values(df.select(cal.seconds_between(F.col("b"), F.col("a")))) == [(-60,), (1,), (7200,)]


def test_age_days(table):
    df = table("cohort date, lead date", ["2021-01-10", "2021-01-01"], ["2021-01-10", "2021-01-10"],
               ["2021-01-10", "2021-01-11"], ["2021-01-10", None])
    assert values(df.select(cal.age_days(F.col("cohort"), F.col("lead")))) == [(0,), (9,), (None,), (None,)]


def test_slots(table):
    df = table("h string", ["09:00-12:30, 13:00-18:15"], ["10:00-24:00"], ["9:00-12:00"], ["by appointment"], [None])
    parsed = text.parse_slots(df, {"o": "h"}).withColumn("m", text.slot_minutes("o")).drop("h")
    assert values(parsed) == [
        (32400, 45000, 46800, 65700, 525), (36000, None, None, None, 0), (None, None, None, None, 0),
        (None, None, None, None, 0), (None, None, None, None, 0)]


def test_spaced_phone_keeps_all_groups(table):
    df = table("p string, s string", ["+49 30 123 456 789", "aircall"], ["+4930123", "aircall"], ["+49 30", "aspect"],
               ["030 123", "aircall"], ["+49 30", "other"], [None, "aircall"])
    # at most four groups; the fifth is dropped
    assert values(df.select(text.normalise_phone(F.col("p"), F.col("s")))) == [
        ("+49 30",), ("+4930123",), ("+4930123456",), (None,), (None,), (None,)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="+0123 x", max_size=18), min_size=20, max_size=60))
def test_phone_equals_the_group_by_group_reading(spark, phones):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(phones)], "i int, p string")
    got = dict(df.select("i", text.normalise_phone(F.col("p"))).collect())
    con = duckdb.connect()
    con.execute("create table t (i int, p varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(phones)))
    group = r"regexp_extract(p, '\+[0-9]*{} *([0-9]*)', 1)"
    later = " || ".join(group.format(" *[0-9]*" * n) for n in range(3))
    want = dict(con.execute(rf"select i, nullif(regexp_extract(p, '(\+[0-9]*)', 1) || {later}, '') from t").fetchall())
    assert got == want


def test_form_number(table):
    df = table("d string", ["Anfrage Telefon: +4930-1"], ["Telefon:+49"], ["kein"], [None])
    rows = values(df.select(text.extract_after_label(F.col("d"), "Telefon:")))
    assert rows == [("+4930",), (None,), (None,), (None,)]


def test_time_text(table):
    df = table("s int", [0], [86399], [None])
    assert values(df.select(cal.time_text(F.col("s")))) == [("00:00:00",), ("23:59:59",), (None,)]


def test_round_scaled_on_ties(table):
    df = table("s long", [21_129_120], [254_880], [-12_960], [None])
    from calloom.functions.numbers import round_scaled
    rows = values(df.select(round_scaled(F.col("s") / 60 / 60 / 24)))
    # 244.55 and -0.15 lie on a tie; 2.95 becomes 2.9499999999999997 on the way
    assert rows == [(-0.2,), (2.9,), (244.6,), (None,)]
