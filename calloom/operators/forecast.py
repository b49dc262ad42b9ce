"""Demand forecast and staffing on daily rows.

Windows without a partition appear here only: their input has one row per calendar date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from calloom.functions.calendar import Date, as_date, days, iso_weekday, within
from calloom.functions.numbers import round_scaled
from calloom.operators.keyed import attach


def trailing_sum(column: str, order: str, oldest: int, newest: int) -> Column:
    """Sum over the rows from ``oldest`` to ``newest`` rows before the current one."""
    return F.sum(column).over(Window.orderBy(order).rowsBetween(-oldest, -newest))


def trailing_ratio(num: str, den: str, order: str, oldest: int = 28, newest: int = 1) -> Column:
    """Ratio of two sums over the same trailing rows."""
    return shifted_ratio(num, den, order, (oldest, newest), (oldest, newest))


def shifted_ratio(num: str, den: str, order: str, num_rows: tuple[int, int], den_rows: tuple[int, int]) -> Column:
    """Ratio of two sums, each over its own trailing rows (oldest, newest)."""
    return F.try_divide(trailing_sum(num, order, *num_rows), trailing_sum(den, order, *den_rows))


def carry_forward(df: DataFrame, columns: Mapping[str, str], order: str, forecast: str = "fc_flag") -> DataFrame:
    """``{new: source}``: the source on past rows, its last known value on forecast rows."""
    known = {
        new: F.max_by(F.struct(src), F.when(F.col(src).isNotNull(), F.col(order)))[src]
        for new, src in columns.items()
    }
    last = df.agg(F.struct(*[value.alias(new) for new, value in known.items()]).alias("last"))
    rows = df.withColumn("__last", last.scalar())
    return rows.withColumns({
        new: F.when(F.col(forecast) == 1, F.col("__last")[new]).otherwise(F.col(src))
        for new, src in columns.items()
    }).drop("__last")


def shift_demand(order: str, demand: str, rows: int, *factors: str) -> Column:
    """Demand of ``rows`` rows earlier times the factors of the current row, 0 where unknown."""
    value = F.lag(demand, rows).over(Window.orderBy(order))
    for factor in factors:
        value = value * F.col(factor)
    return F.coalesce(value, F.lit(0.0))


# call kinds in the order in which their workloads are added up
CALL_KINDS = ("appointment", "reminder", "noshow", "followup", "second_followup")


def lead_demand(df: DataFrame) -> DataFrame:
    """Leads, qualified leads and appointment calls that the planned spend buys."""
    leads = F.col("fc_marketing_costs") / F.col("fc_cost_per_lead")
    return df.withColumns({
        "fc_leads": leads,
        "fc_qualified_leads": leads * F.col("fc_cr_lead_to_qlead"),
        "fc_appointment_calls": leads * F.col("fc_lead_to_lead_tickets_called_ratio")
        * F.col("fc_lead_tickets_called_reached_share"),
    })


def follow_on_calls(df: DataFrame, order: str = "date") -> DataFrame:
    """Reminder, no-show and follow-up calls caused by the qualified leads of earlier days."""
    to_appointment, reached = "fc_cr_lead_ticket_called_reached_to_scheduled_appointment", "fc_call_reached_share"
    demand = "fc_qualified_leads"
    return df.withColumns({
        "fc_reminder_calls": shift_demand(order, demand, 8, to_appointment, reached),
        "fc_noshow_calls": shift_demand(order, demand, 10, to_appointment, "fc_no_show_rate", reached),
        "fc_followup_calls": shift_demand(order, demand, 10, to_appointment, reached),
        "fc_second_followup_calls": shift_demand(
            order, demand, 20, to_appointment, "fc_cr_screening_to_qscreening", "fc_cr_qscreening_to_trial", reached),
    })


def staffing_model(df: DataFrame) -> DataFrame:
    """Call attempts, outbound and inbound calls, workload hours and required staff.

    The hours per person divide the result after the absence rate has been taken out.
    """
    reached = sum((F.col(f"fc_{kind}_calls") for kind in CALL_KINDS[1:]), F.col("fc_appointment_calls"))
    df = df.withColumn("fc_call_attempts", reached * F.col("fc_call_attempt_ratio"))
    outbound = reached + F.col("fc_call_attempts")
    inbound = outbound * F.col("fc_inbound_call_ratio")
    seconds = F.col("fc_aht_s_appointment_call") * F.col("fc_appointment_calls")
    for kind in CALL_KINDS[1:]:
        seconds = seconds + F.col(f"fc_aht_s_{kind}_call") * F.col(f"fc_{kind}_calls")
    seconds = seconds + F.col("fc_aht_s_call_attempt") * F.col("fc_call_attempts")
    seconds = seconds + F.col("fc_aht_s_inbound_call") * inbound
    workload = seconds / 60 / 60
    agents = F.col("act_num_agents")
    needed = (
        workload / F.col("fc_occupancy")
        + agents * F.col("fc_training_quality_h")
        + agents * F.col("fc_meeting_h")
        + F.col("fc_other_shrinkage_h")
    )
    present = 1 - (F.col("fc_sickness_rate") + F.col("fc_holiday_rate"))
    return df.withColumns({
        "fc_outbound_calls": outbound,
        "fc_inbound_calls": inbound,
        "fc_workload_h": workload,
        "fc_required_fte": F.try_divide(needed, present) / F.col("act_fte_h_day"),
    })


def weekly_to_daily(df: DataFrame, plan: DataFrame, week: str, columns: Mapping[str, str],
                    days_per_week: int = 7, whole: Mapping[str, str] | None = None) -> DataFrame:
    """Join a weekly plan and spread ``{new: weekly column}`` evenly over the days of the week.

    ``whole`` maps columns that hold as they are on each day. The plan is joined once: a week with several rows in it
    gives each of its days that many.
    """
    daily = [(F.col(src) / days_per_week).alias(new) for new, src in columns.items()]
    same = [F.col(src).alias(new) for new, src in (whole or {}).items()]
    return df.join(plan.select(week, *same, *daily), week, "left")


def workdays_only(weekly: Column, weekday: Column, workdays: int = 5) -> Column:
    """A weekly amount on Monday to Friday, 0 on other days."""
    return F.when(weekday <= workdays, F.try_divide(weekly, F.lit(workdays))).otherwise(0.0)


def weekday_share(df: DataFrame, ts: str, id_: str, as_of: Date, oldest: int = 29, newest: int = 1) -> DataFrame:
    """Share of each weekday (``daynum``, 1 = Monday) in the ids of the last days."""
    recent = df.filter(within(F.to_date(F.col(ts)), as_of, oldest, newest) & F.col(id_).isNotNull())
    total = recent.agg(F.count(id_)).scalar()
    by_day = recent.groupBy(iso_weekday(F.col(ts)).alias("daynum")).agg(F.count_distinct(id_).alias("__n"))
    return by_day.select("daynum", (F.col("__n") / total).alias("daynum_share"))


def disaggregate(df: DataFrame, week: str, weekday: str, amount: str, share: DataFrame, name: str) -> DataFrame:
    """Spread the total of a week over its days by weekday share."""
    rows = attach(df, [week], __week=F.sum(amount)).join(share, weekday, "left")
    return rows.withColumn(name, F.try_multiply(F.col("__week"), F.col("daynum_share"))).drop("__week")


# Share of planned hours open for lead tickets (at most, by default), share of calls reached.
MAX_SHARE, DEFAULT_SHARE, REACHED_RATE = 0.8, 0.7, 0.8


def capacity(df: DataFrame, planned: str, shrinkage: str, sickness: str, occupancy: str, handling_h: str,
             backlog: str, max_share: float = MAX_SHARE, default_share: float = DEFAULT_SHARE,
             reached: float = REACHED_RATE) -> DataFrame:
    """Tickets that the planned hours can take, at the greatest and at the default share, net of the backlog.

    Adds ``max_capacity_lead_tickets_total`` and ``default_capacity_lead_tickets_total``. Unknown hours are 0.
    """
    hours, sick, busy = F.col(planned), 1 - F.col(sickness), F.col(occupancy)
    at_most = F.try_multiply(F.try_multiply(F.try_multiply(hours, F.lit(max_share)), sick), busy)
    usual = F.try_subtract(F.try_multiply(hours, F.lit(default_share)), F.col(shrinkage))
    usual = F.try_multiply(F.try_multiply(usual, sick), busy)

    def tickets(available: Column) -> Column:
        handled = F.try_divide(F.coalesce(available, F.lit(0.0)), F.col(handling_h))
        new = F.try_subtract(F.try_divide(handled, F.lit(reached)), F.try_divide(F.col(backlog), F.lit(reached)))
        return round_scaled(new)

    return df.withColumns({
        "max_capacity_lead_tickets_total": tickets(at_most),
        "default_capacity_lead_tickets_total": tickets(usual),
    })


def spread_backlog(open_work: DataFrame, created: str, amount: str, as_of: Date, max_age: int = 6,
                   workdays: int = 6, name: str = "current_num_backlog_lead_tickets_day") -> DataFrame:
    """Open work of at most ``max_age`` days, spread over the next seven days except Sunday."""
    recent = open_work.filter(F.datediff(as_date(as_of), F.to_date(F.col(created))) <= max_age)
    total = recent.agg(F.try_divide(F.sum(amount), F.lit(workdays)).alias("__each"))
    week = days(as_date(as_of), F.date_add(as_date(as_of), 6))
    rows = total.select("__each", F.explode(week).alias("date")).withColumn("daynum", iso_weekday(F.col("date")))
    share = F.when(F.col("daynum") <= workdays, F.col("__each")).otherwise(0.0)
    return rows.select("date", "daynum", share.alias(name))


def carry_backlog(df: DataFrame, workload: str, gap: str, order: Sequence[str], name: str,
                  depth: int = 6) -> DataFrame:
    """Add to each day's workload what the previous days could not handle.

    With g(n) the gap n rows before and s(k) = g(1) + .. + g(k), a day gets, for each k of 2 .. ``depth``,
    the rest s(k) if g(k) > 0, s(k-1) <= 0 and s(k) > 0, or all of g(k) if every gap since was positive;
    and g(1) if positive. Terms with an unknown gap are 0.
    """
    by_order = Window.orderBy(*order)
    rows = df.withColumns({f"__g{n}": F.lag(gap, n).over(by_order) for n in range(1, depth + 1)})
    total = F.col(workload)
    for k in range(depth, 1, -1):
        newer = F.col(f"__g{k - 1}")
        for n in range(k - 2, 0, -1):
            newer = newer + F.col(f"__g{n}")
        oldest = F.col(f"__g{k}")
        rest = oldest
        for n in range(k - 1, 0, -1):
            rest = rest + F.col(f"__g{n}")
        unbroken = oldest > 0
        for n in range(1, k):
            unbroken = unbroken & (F.col(f"__g{n}") > 0)
        total = total + F.when((oldest > 0) & (newer <= 0) & (rest > 0), rest).otherwise(0.0)
        total = total + F.when(unbroken, oldest).otherwise(0.0)
    total = total + F.when(F.col("__g1") > 0, F.col("__g1")).otherwise(0.0)
    return rows.withColumn(name, total).drop(*[f"__g{n}" for n in range(1, depth + 1)])


def trailing_rate(df: DataFrame, rates: Mapping[str, tuple[str, str]], inside: Column,
                  grains: Mapping[str, Sequence[str]], zero: Sequence[str] = (),
                  source: DataFrame | None = None) -> DataFrame:
    """Ratios of sums over the rows where ``inside`` holds, next to every row, at several grains.

    ``rates`` maps a name to (numerator, denominator); ``grains`` maps a suffix to group columns, none for
    the whole. The rows inside are summed once at the finest grain, and those sums are rolled up. Columns
    listed in ``zero`` are 0 instead of null where either sum is 0.
    """
    measures = sorted({c for pair in rates.values() for c in pair})
    finest = list(dict.fromkeys(c for by in grains.values() for c in by))
    base = (df if source is None else source).filter(inside).groupBy(*finest).agg(*[F.sum(c).alias(c) for c in measures])
    for suffix, by in grains.items():
        ratios = {}
        for name, (num, den) in rates.items():
            ratio = F.try_divide(F.sum(num), F.sum(den))
            if f"{name}{suffix}" in zero:
                ratio = F.when((F.sum(num) == 0) | (F.sum(den) == 0), 0.0).otherwise(ratio)
            ratios[f"{name}{suffix}"] = ratio
        if by:
            rolled = base.groupBy(F.struct(*by).alias("__grain")).agg(*[c.alias(n) for n, c in ratios.items()])
            df = df.withColumn("__grain", F.struct(*by)).join(rolled, "__grain", "left").drop("__grain")
        else:
            whole = base.agg(F.struct(*[c.alias(n) for n, c in ratios.items()]).alias("r"))
            df = df.withColumn("__rates", whole.scalar())
            df = df.withColumns({n: F.col("__rates")[n] for n in ratios}).drop("__rates")
    return df


def mask_to_window(df: DataFrame, columns: Sequence[str], inside: Column) -> DataFrame:
    """Blank the columns on rows outside the window."""
    return df.withColumns({c: F.when(inside, F.col(c)) for c in columns})

