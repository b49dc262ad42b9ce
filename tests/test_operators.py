import datetime as dt
import random

import pandas as pd
import pytest
from conftest import day, values
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from calloom.operators import attribution as att, cohorts as coh, forecast as fc, keyed, marketing as mk, snapshots as snap
from calloom.operators.ordered import boundaries, ordered, sliced
from calloom.operators.spine import densify, each_class, half_month_spine, horizon

row = st.tuples(st.sampled_from(["a", "a", "a", "b", None]), st.one_of(st.none(), st.integers(0, 40)),
                st.one_of(st.none(), st.integers(-5, 5)))


@settings(max_examples=12, deadline=None)
@given(st.lists(row, min_size=1, max_size=50))
def test_ordered_equals_plain_windows(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, k string, x int, v int")
    got = ordered(
        df, ["k"], ["x", "id"], [F.floor(F.col("x") / 7)], row_number="n", row_number_desc="m", total="t",
        lag={"p": "v"}, lead={"q": "v"}, running_max={"rm": "v"}, running_sum={"rs": "v"}, key_sum={"ks": "v"},
        key_max={"km": "v"}, coming_min={"cm": "v"})
    w, k = Window.partitionBy("k").orderBy("x", "id"), Window.partitionBy("k")
    upto, coming = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.select(
        "*", F.row_number().over(w).alias("n"), (F.count("*").over(k) + 1 - F.row_number().over(w)).alias("m"),
        F.count("*").over(k).alias("t"), F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("q"),
        F.max("v").over(upto).alias("rm"), F.sum("v").over(upto).alias("rs"), F.sum("v").over(k).alias("ks"),
        F.max("v").over(k).alias("km"), F.min("v").over(coming).alias("cm"))
    assert values(got, *want.columns) == values(want)


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_attach_equals_a_window(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, k string, x int, v int")
    got = keyed.attach(df, ["k", "x"], s=F.sum("v"), n=F.count("*"), d=F.count_distinct("v"))
    w = Window.partitionBy("k", "x")
    want = df.select("*", F.sum("v").over(w).alias("s"), F.count("*").over(w).alias("n"),
                     F.size(F.collect_set("v").over(w)).cast("long").alias("d"))
    assert values(got, *want.columns) == values(want)


def brute_assignment(tickets, calls):
    """Every ticket against every call of its key, straight from the rule."""
    out, hour = [], dt.timedelta(minutes=60)
    for key in {t[0] for t in tickets}:
        line = sorted((t for t in tickets if t[0] == key), key=lambda t: (t[2], t[1]))
        last = line[-1][2]
        for n, (_, id_, start) in enumerate(line):
            before, after = (line[n - 1][2] if n else start), (line[n + 1][2] if n + 1 < len(line) else start)
            for call in (c for c in calls if c[0] == key):
                at = call[2]
                if ((start == before and start - hour <= at <= after) or (before < start < last and start <= at <= after)
                        or (start == last and at > start)):
                    out.append((key, id_, call[1]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_assign_interval_equals_brute_force(spark, seed):
    rng, base = random.Random(seed), dt.datetime(2021, 1, 1)

    def at():
        return base + dt.timedelta(minutes=15 * rng.randrange(60))

    tickets = [(rng.choice("aab"), i, at()) for i in range(14)]
    calls = [(rng.choice("aabc"), i, at()) for i in range(60)]
    left = spark.createDataFrame(tickets, "k string, ticket int, start timestamp_ntz")
    right = spark.createDataFrame([*calls, (None, 99, base)], "k string, call int, ts timestamp_ntz")
    spans = att.ticket_intervals(left, ["k"], "start", "ticket")
    got = att.assign_interval(spans, right, ["k"], "start", "ts", F.col("start") == F.col("previous_start"))
    assert values(got, "k", "ticket", "call") == sorted(brute_assignment(tickets, calls), key=repr)


def test_hot_key_stays_whole(spark):
    """A key with nearly all rows gives the same numbers as a small one, over many slices."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"), (F.col("id") * 7919 % 20_000).alias("x"))
    got = ordered(df, ["k"], ["x"], [F.floor(F.col("x") / 500)], row_number="n", lag={"p": "x"}).filter("k = -1")
    check = got.agg(F.count("*"), F.max("n"), F.count_distinct("n"), F.count("p")).first()
    assert tuple(check) == (19_600, 19_600, 19_600, 19_599)
    assert got.filter("p >= x").isEmpty()


@pytest.mark.parametrize("place", ["at one moment", "far apart", "with nulls"])
def test_boundaries_cut_a_heavy_key_whatever_its_values(spark, place):
    """Rows of one key at one moment, with ids far apart, or without a time: slices stay small, numbers stay those of a window."""
    when = {"at one moment": F.lit("2021-01-01 10:00"), "far apart": F.lit("2021-01-01 10:00"), "with nulls": F.lit(None)}[place]
    id_ = F.col("id") * 1_000_003_000_007 if place == "far apart" else F.col("id")
    df = spark.range(30_000).select(
        F.when(F.col("id") % 100 == 0, F.col("id")).when(F.col("id") % 100 > 2, F.lit(-1)).alias("k"),
        when.cast("timestamp_ntz").alias("ts"), id_.alias("id"), (F.col("id") % 17).alias("v")).repartition(4)
    cuts = boundaries(df, ["k"], ["ts", "id"], rows=2000)
    sizes = sliced(df, ["k"], ["ts", "id"], cuts, "slice").groupBy("k", "slice").count()
    assert sizes.agg(F.max("count")).first()[0] < 8000 and sizes.filter("k = -1").count() > 4
    assert cuts.count() <= 2  # the heavy key, and perhaps the null key with its 600 rows
    got = ordered(df, ["k"], ["ts", "id"], cuts, row_number="n", lag={"p": "v"}, running_sum={"s": "v"}, coming_min={"c": "id"})
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.select("*", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"), F.sum("v").over(w).alias("s"),
                     F.col("id").alias("c"))
    assert sorted(got.columns) == sorted(want.columns)
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_interval_conversions_equal_every_day_against_every_start(spark):
    rng, first = random.Random(4), dt.date(2020, 1, 1)

    def on(n):
        return first + dt.timedelta(days=n)

    base = []
    for key in ["a", "b", "c", None]:
        starts = sorted(rng.sample(range(300), 6))
        # the last row is open; one start ends before the next begins, one is shared by two rows
        ends = [on(starts[1] - 1), *map(on, starts[2:]), None]
        base += [(key, f"{key}{i}", on(s), e) for i, (s, e) in enumerate(zip(starts, ends))]
        base.append((key, f"{key}x", on(starts[2]), on(starts[3])))
    facts = [(rng.choice(["a", "b", "z", None]), on(rng.randrange(-20, 320)), rng.randrange(9)) for _ in range(400)] + [("a", None, 1)]
    rows = att.interval_conversions(
        spark.createDataFrame(base, "k string, id string, s date, e date"), spark.createDataFrame(facts, "k string, d date, v int"),
        "k", "s", "e", "d", flag="any", maxima={"most": "v"}, sums={"all": "v"})
    want = []
    for key, id_, s, e in base:
        met = [v for k, d, v in facts if k is not None and k == key and d is not None and d >= s and (e is None or d < e)]
        want.append((key, id_, s, e, int(bool(met)), max(met, default=None), sum(met) if met else None))
    assert values(rows, "k", "id", "s", "e", "any", "most", "all") == sorted(want, key=repr)


def test_a_key_of_many_days_and_starts_is_linear(spark):
    """100,000 days and 1,000 starts of one key: no pair of day and start is formed but those that hold."""
    days = spark.range(100_000).select(F.lit("a").alias("k"), F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    step = F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") * 100).cast("int"))
    base = spark.range(1000).select(F.lit("a").alias("k"), step.alias("s"),
                                    F.when(F.col("id") < 999, F.date_add(step, 100)).alias("e"))
    rows = att.interval_conversions(base, days.withColumn("v", F.lit(1)), "k", "s", "e", "d", sums={"n": "v"})
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and not any(sign in line for line in joins for sign in ("<", ">"))
    assert {tuple(r) for r in rows.groupBy("n").count().collect()} == {(100, 1000)}


def test_explode_period_conserves_the_amount(table):
    df = table("id int, a date, b date, h double", [1, "2021-01-30", "2021-02-02", 32.0], [2, "2021-01-02", "2021-01-01", 8.0])
    rows = snap.explode_period(df, "a", "b", "h")
    assert values(rows, "id", "date", "total_days", "day_amount") == [
        (1, day(d), 4, 8.0) for d in ("2021-01-30", "2021-01-31", "2021-02-01", "2021-02-02")]


def test_latest_snapshot_keeps_ties(table):
    df = table("d date, load int, v string", ["2021-01-01", 1, "old"], ["2021-01-01", 2, "x"], ["2021-01-01", 2, "y"],
               ["2021-01-02", 1, "z"], [None, 1, "n"])
    assert values(snap.latest_snapshot(df, ["d"], "load"), "v") == [("n",), ("x",), ("y",), ("z",)]


def test_fallback_by_half_month_month_year_ever(table):
    base = table("e string, half_month string, month string, year string",
                 *[("a", h, h[:7], h[:4]) for h in ("2020-01-01", "2021-01-01", "2021-01-15", "2021-03-01", "2022-01-01")],
                 ("b", "2021-01-01", "2021-01", "2021"))
    ranks = table("e string, half_month string, rank int", ["a", "2021-01-15", 4], ["a", "2021-01-15", 3],
                  ["a", "2020-01-01", 1], ["a", "2021-01-01", None])
    rows = snap.fallback_rank(base, ranks, "e", "rank")
    assert values(rows, "e", "half_month", "best_rank") == [
        ("a", "2020-01-01", 1), ("a", "2021-01-01", 3), ("a", "2021-01-15", 3), ("a", "2021-03-01", 3),
        ("a", "2022-01-01", 1), ("b", "2021-01-01", None)]


def test_double_master_rows(table):
    df = table("n string, s string, m string", ["1", "Active", "a"], ["2", "Active", "a"], ["2", "Inactive", "b"],
               ["3", "Inactive", "b"], ["3", "Inactive", "a"], ["4", "Active", "a"], ["4", "Active", "b"],
               ["5", "Active", "a"], ["5", "Inactive", "b"], ["5", "Inactive", "c"])
    rows = snap.dedupe_status(df, ["n"], "n", "s", ["m"])
    assert values(rows.filter("exclude_data_flag = 1"), "n", "m") == [("2", "b"), ("3", "b")]


def test_reset_counts_from_the_previous_row(table):
    df = table("c int, d date, id int", [1, "2021-01-01", 1], [1, "2021-12-31", 2], [1, "2022-06-01", 3],
               [1, "2023-06-01", 4], [2, "2020-02-29", 5], [2, "2021-02-28", 6])
    rows = snap.reset_after(df, ["c"], "d", 12, ["d", "id"], [F.trunc("d", "month")])
    # the third is over a year after the first, but not after the rejected second
    assert values(rows.filter("accepted_flag = 1"), "id") == [(1,), (4,), (5,), (6,)]


def test_conversion_window(table):
    df = table("t date, n date, x date", ["2021-01-01", None, "2021-01-31"], ["2021-01-01", None, "2021-02-01"],
               ["2021-01-01", "2021-06-01", "2021-05-01"], ["2021-01-01", "2021-02-01", "2021-02-02"],
               [None, "2021-02-01", "2021-01-02"], ["2021-01-01", None, "2020-12-31"])
    flags = df.withColumn("f", coh.attribute_conversion("t", "n", "x"))
    assert values(flags.filter("f = 1"), "x") == [(day("2021-01-31"),), (day("2021-05-01"),)]


def test_rerun_cohort(table):
    df = table("u string, d date, stage int, id int", ["u", "2021-01-01", 2, 1], ["u", "2021-01-02", 1, 2],
               ["u", "2021-01-03", 2, 3], ["u", "2021-01-05", 1, 4], ["u", "2021-01-06", 2, 5], ["u", "2021-01-09", 1, 6],
               ["w", "2021-01-02", 1, 7], ["w", "2021-01-03", 3, 8])
    sent = F.col("stage") == 1
    rows = coh.rerun_cohort_date(coh.cohort_date(df, ["u"], sent, "d"), ["u"], sent, "d", ["d", "id"])
    second, first = day("2021-01-05"), day("2021-01-02")
    assert values(rows, "id", "cohort_date_alt") == [
        (1, None), (2, first), (3, first), (4, second), (5, second), (6, second), (7, first), (8, first)]


@pytest.mark.parametrize("seed", range(3))
def test_weighted_numbering_equals_unfolded_copies(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("uvw"), day(f"2021-01-{rng.randint(1, 9):02}"), n, rng.random() < 0.4, rng.choice([1, 1, 2, 5]))
            for n in range(60)]
    df = spark.createDataFrame(rows, "u string, d date, id int, sent boolean, copies int")
    unfolded = df.select("*", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copies")
    got = coh.rerun_cohort_date(df, ["u"], F.col("sent"), "d", ["d", "id"], weight="copies")
    got = coh.sequence_events(got, ["u"], ["d", "id"], [F.col("d")], weight="copies")
    want = coh.rerun_cohort_date(unfolded, ["u"], F.col("sent"), "d", ["d", "id", "copy"])
    want = coh.sequence_events(want, ["u"], ["d", "id", "copy"], [F.col("d")])
    # by hand: the second sent row's date from the first sent row on
    for u in "uvw":
        sent = sorted((r[1], r[2]) for r in rows if r[0] == u and r[3] for _ in range(r[4]))
        for r in got.filter(F.col("u") == u).collect():
            assert r["cohort_date"] == (sent[0][0] if sent else None)
            rerun = sent[min(1, len(sent) - 1)][0] if sent and (r["d"], r["id"]) >= sent[0] else None
            assert r["cohort_date_alt"] == (None if rerun is None else rerun if r["d"] >= rerun else sent[0][0])
    names = ["id", "cohort_date", "cohort_date_alt", "user_event_rank_asc", "user_event_rank_desc"]
    assert values(got, *names) == values(want, *names)


def test_ids_are_counted_in_two_steps(spark, table):
    df = table("g string, id string, q int, eur int", ["a", "x", 1, 1], ["a", "x", 0, 2], ["a", "y", 0, 4], ["a", None, 1, 8],
               [None, "x", None, 16], [None, "x", 1, 32], ["b", None, 1, 64])
    rows = keyed.count_ids(df, ["g"], "id", {"n": None, "held": F.col("q") == 1}, {"eur": F.col("eur")})
    assert values(rows, "g", "n", "held", "eur") == values(
        df.groupBy("g").agg(F.count_distinct("id").alias("n"), F.count_distinct(F.when(F.col("q") == 1, F.col("id"))).alias("held"),
                            F.sum("eur").alias("eur")), "g", "n", "held", "eur")
    assert "Expand" not in rows._jdf.queryExecution().executedPlan().toString()


def test_one_credit_per_key(table):
    df = table("u string, d date, id int, f int", ["u", "2021-01-01", 1, 1], ["u", "2021-01-02", 2, 1],
               ["u", "2021-01-02", 3, 1], ["u", "2021-01-05", 4, 0], ["w", "2021-01-01", 5, 0])
    assert values(coh.single_credit(df, "f", ["u"], ["d", "id"]).filter("f = 1"), "id") == [(3,)]


def test_interval_conversions_end_the_day_before(table):
    base = table("c int, s date, n date", [1, "2021-01-01", "2021-02-01"], [1, "2021-02-01", None], [2, "2021-01-01", None])
    facts = table("c int, d date, q int, eur double", [1, "2021-01-31", 1, 5.0], [1, "2021-01-31", 0, 7.0],
                  [1, "2021-02-01", 0, 9.0], [1, "2020-12-31", 1, 1.0], [1, None, 1, 1.0])
    rows = att.interval_conversions(base, facts, "c", "s", "n", "d", flag="any", maxima={"q": "q"}, sums={"eur": "eur"})
    assert values(rows, "c", "s", "any", "q", "eur") == [
        (1, day("2021-01-01"), 1, 1, 12.0), (1, day("2021-02-01"), 1, 0, 9.0), (2, day("2021-01-01"), 0, None, None)]


def test_cancel_text_counts_only_without_a_code(table):
    df = table("r string, t string", ["appointment_cancelled", None], ["other", "Termin abgesagt"], [None, "Termin abgesagt"],
               [None, None])
    flags = df.select(att.cancelled(F.col("r"), ["appointment_cancelled"], F.col("t"), "%Termin abgesagt%"))
    assert values(flags) == [(0,), (0,), (1,), (1,)]


def literal_backlog(workloads, gaps):
    """The carry rule read term by term: how much of the last six days' gaps reaches each day."""
    out = []
    for i, load in enumerate(workloads):
        g = [gaps[i - n] if i - n >= 0 else None for n in range(1, 7)]
        total = load + (g[0] if g[0] is not None and g[0] > 0 else 0)
        for k in range(2, 7):
            known = g[:k]
            if None in known:
                continue
            if known[-1] > 0 and sum(known[:-1]) <= 0 and sum(known) > 0:
                total += sum(known)
            if all(x > 0 for x in known):
                total += known[-1]
        out.append((i, total))
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(-6, 6)), min_size=1, max_size=40))
def test_carry_backlog(spark, days):
    df = spark.createDataFrame([(i, float(w), float(g)) for i, (w, g) in enumerate(days)], "i int, w double, g double")
    got = fc.carry_backlog(df, "w", "g", ["i"], "c")
    assert values(got, "i", "c") == sorted(literal_backlog([w for w, _ in days], [g for _, g in days]), key=repr)


def test_six_positive_gaps_all_arrive(table):
    df = table("i int, w double, g double", *[(i, 1.0, 1.0) for i in range(8)])
    assert [r.c for r in fc.carry_backlog(df, "w", "g", ["i"], "c").orderBy("i").collect()] == [1, 2, 3, 4, 5, 6, 7, 7]


def test_carry_forward_takes_the_last_known_value(table):
    df = table("d date, fc_flag int, a double", ["2021-01-01", 0, 1.0], ["2021-01-02", 0, 2.0], ["2021-01-03", 0, None],
               ["2021-01-04", 1, None])
    rows = fc.carry_forward(df, {"f": "a"}, "d")
    assert [r.f for r in rows.orderBy("d").collect()] == [1.0, 2.0, None, 2.0]


def test_spread_backlog_leaves_sunday_out(table):
    df = table("at timestamp_ntz, n int", ["2021-01-06 10:00:00", 6], ["2020-12-31 00:00:00", 6], ["2020-12-30 23:59:00", 9])
    rows = fc.spread_backlog(df, "at", "n", "2021-01-06", name="b")
    assert [(r.daynum, r.b) for r in rows.orderBy("date").collect()] == [
        (3, 2.0), (4, 2.0), (5, 2.0), (6, 2.0), (7, 0.0), (1, 2.0), (2, 2.0)]


def test_merge_facts_equals_full_joins(spark):
    rng = random.Random(5)

    def fact(name):
        keys = {(rng.choice(["x", "y", "z", None]), rng.choice([1, 2, 3, None])) for _ in range(7)}
        return spark.createDataFrame([(*k, rng.randrange(100)) for k in keys], f"a string, b int, {name} int")

    first, second, third = fact("f"), fact("s"), fact("t")
    first.createOrReplaceTempView("f1")
    second.createOrReplaceTempView("f2")
    third.createOrReplaceTempView("f3")
    want = spark.sql("""
        select coalesce(f1.a, f2.a, f3.a) as a, coalesce(f1.b, f2.b, f3.b) as b, f, s, t
        from f1 full join f2 on f1.a = f2.a and f1.b = f2.b full join f3 on f1.a = f3.a and f1.b = f3.b""")
    assert values(mk.merge_facts(first, {"s": second, "t": third}, ["a", "b"])) == values(want)


def test_allocation_keeps_the_spend(table):
    df = table("d date, m string, dev string, spend double, leads long",
               ["2021-01-01", "2021-01", "A", 100.0, 3], ["2021-01-01", "2021-01", "B", 100.0, 1],
               ["2021-01-02", "2021-01", "A", 40.0, None], ["2021-01-02", "2021-01", "B", 40.0, None],
               ["2021-02-01", "2021-02", "A", 10.0, None], ["2021-02-01", "2021-02", "B", 10.0, None])
    rows = mk.allocate(df, ["spend"], "leads", "dev", [["d"], ["m"]])
    assert values(rows, "d", "dev", "spend") == [
        (day("2021-01-01"), "A", 75.0), (day("2021-01-01"), "B", 25.0), (day("2021-01-02"), "A", 30.0),
        (day("2021-01-02"), "B", 10.0), (day("2021-02-01"), "A", 5.0), (day("2021-02-01"), "B", 5.0)]


def test_densify_counts(table):
    entities = table("e string", ["a"], ["b"])
    facts = table("e string, date date, n int", ["a", "2021-01-02", 5])
    rows = densify(entities, "2021-01-01", "2021-01-03", facts, ["e", "date"], zero=["n"])
    assert rows.count() == 6 and rows.agg(F.sum("n")).first()[0] == 5


def test_horizon_flags(spark):
    rows = values(horizon(spark, "2021-01-30", "2021-01-31", 1))
    assert (day("2021-01-30"), 1, 0) in rows and (day("2021-01-31"), 0, 1) in rows
    assert max(r[0] for r in rows) == day("2021-02-28")


def test_half_month_spine_touches_both_ends(table):
    rows = half_month_spine(table("e string", ["a"]), "2021-01-14", "2021-02-10")
    assert values(rows, "half_month") == [("2021-01-01",), ("2021-01-15",), ("2021-02-01",)]


def test_each_class_has_no_limit(spark, table):
    rows = each_class(table("i int", [1]), table("c string", ["x"], ["y"], [None], ["x"]), "c")
    assert values(rows, "c") == [("x",), ("y",), (None,)]
    many = spark.range(1_500).select(F.col("id").cast("string").alias("c"))
    rows = each_class(table("i int, c string", [1, "own"], [2, None], [2, None]), many.union(many), "c")
    assert rows.columns == ["i", "c"] and rows.count() == 3 * 1_500 and rows.distinct().count() == 2 * 1_500


def test_pivot_props_sees_every_value_of_a_key(spark):
    rows = spark.createDataFrame(
        [(1, [("e", "a"), ("e", "z"), ("f", "q")]), (1, [("e", "m")]), (2, [("f", None)]), (3, None)],
        "id int, props array<struct<key string, value string>>")
    assert values(coh.pivot_props(rows, "props", {"e": "e", "f": "f"}, ["id"]), "id", "e", "f") == [
        (1, "z", "q"), (1, "z", "q"), (2, None, None), (3, None, None)]


def test_a_plan_with_two_rows_in_a_week_gives_two(table):
    days = table("date string, week string", ["d1", "w"], ["d2", "w"], ["d3", "x"])
    plan = table("week string, hours double, rate double", ["w", 7.0, 0.5], ["w", 14.0, 0.6])
    rows = fc.weekly_to_daily(days, plan, "week", {"h": "hours"}, whole={"r": "rate"})
    assert values(rows, "date", "h", "r") == [
        ("d1", 1.0, 0.5), ("d1", 2.0, 0.6), ("d2", 1.0, 0.5), ("d2", 2.0, 0.6), ("d3", None, None)]


def test_trailing_rate_at_three_grains(spark):
    pdf = pd.DataFrame({"d": [1, 2, 3, 3], "g": ["x", "x", "x", "y"], "n": [10, 1, 2, 0], "m": [1, 2, 2, 0]})
    df = spark.createDataFrame(pdf)
    rows = fc.trailing_rate(df, {"r": ("n", "m")}, F.col("d") >= 2, {"": [], "_g": ["g"]}, zero=["r_g"])
    assert values(rows, "d", "g", "r", "r_g") == [
        (1, "x", 0.75, 0.75), (2, "x", 0.75, 0.75), (3, "x", 0.75, 0.75), (3, "y", 0.75, 0.0)]


def test_assign_interval_on_a_hot_key_equals_duckdb(spark):
    """Most tickets and calls share one key; DuckDB forms all pairs and applies the rule."""
    import duckdb

    rng, base = random.Random(11), dt.datetime(2021, 1, 1)
    tickets = [("hot" if rng.random() < 0.9 else rng.choice("ab"), i, base + dt.timedelta(minutes=rng.randrange(40_000)))
               for i in range(500)]
    calls = [("hot" if rng.random() < 0.9 else rng.choice("ab"), i, base + dt.timedelta(minutes=rng.randrange(41_000)))
             for i in range(3_000)]
    left = spark.createDataFrame(tickets, "k string, ticket int, start timestamp_ntz")
    right = spark.createDataFrame(calls, "k string, call int, ts timestamp_ntz")
    spans = att.ticket_intervals(left, ["k"], "start", "ticket")
    got = att.assign_interval(spans, right, ["k"], "start", "ts", F.col("start") == F.col("previous_start"))
    t, c = pd.DataFrame(tickets, columns=["k", "ticket", "start"]), pd.DataFrame(calls, columns=["k", "call", "ts"])  # noqa: F841
    want = duckdb.sql("""
        with b as (select *, coalesce(lead(start) over w, start) as nxt, coalesce(lag(start) over w, start) as prv,
          max(start) over (partition by k) as lst from t window w as (partition by k order by start, ticket))
        select b.k, ticket, call from b join c on c.k = b.k
        where (start = prv and ts between start - interval 60 minute and nxt)
          or (start > prv and start < lst and ts between start and nxt) or (start = lst and ts > start)""").fetchall()
    assert values(got, "k", "ticket", "call") == sorted(want, key=repr)
