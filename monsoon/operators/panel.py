"""Dense monthly panels with zero and return semantics, and calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monsoon.functions import lunar
from monsoon.functions.dates import calendar_parts, cyclic, month_diff, month_start, weekdays
from monsoon.schema import PAIR
from monsoon.sources.stages import Guards, repeats


def spine(df: DataFrame, keys: list[str], end: str, first: str = "first_observed_month") -> DataFrame:
    """A row for each month from an entity's first to end; entities that begin after end have none."""
    last = F.lit(end).cast("date")
    starts = df.groupBy(*keys).agg(F.min("month").alias(first)).where(F.col(first) <= last)
    return starts.select(*keys, first, F.explode(F.sequence(F.col(first), last, F.expr("interval 1 month"))).alias("month"))


def _to_date(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def pair_panel(fact: DataFrame, base: DataFrame, branch: DataFrame, end: str) -> DataFrame:
    """base code x branch x month, dense from the pair's first observation.

    A month without a sales row is a zero; a month with returns only has no target.  Lifecycle columns look at no later
    month.  One exchange on the pair serves the spine's join and all windows.
    """
    df = spine(fact, PAIR, end).join(fact, [*PAIR, "month"], "left")
    seen = F.col("observed_source_row_count").isNotNull()
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("gross_positive_m2", "negative_m2", "net_m2", "total_amount_audit")}
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("source_line_count", "observed_source_row_count", "observed_bravo_count")}
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("observed_positive", "observed_explicit_zero", "observed_negative")}
    df = df.withColumns({"source_row_observed": seen, **zero, **counts, **flags, "observation_status": F.coalesce("observation_status", F.lit("IMPLICIT_ZERO_NO_SOURCE_ROW"))})
    returns = F.col("observation_status") == "NEGATIVE_ONLY"
    explicit = F.col("observation_status") == "EXPLICIT_ZERO_ONLY"
    df = df.withColumns({
        "actual_observed": F.lit(True), "actual_positive": F.col("observed_positive"), "actual_explicit_zero": explicit, "actual_negative_only": returns, "target_available": ~returns,
        "actual_gross_m2": F.when(~returns, F.col("gross_positive_m2")),
        "zero_semantics": F.when(~F.col("source_row_observed"), "OBSERVED_ZERO_IMPLICIT").when(explicit, "OBSERVED_ZERO").when(returns, "NEGATIVE_ONLY_GROSS_ZERO").otherwise("OBSERVED_NONZERO_OR_MIXED"),
    })
    return lifecycle(df).join(base, "base_sku", "left").join(branch, "branch_code", "left")


def lifecycle(df: DataFrame) -> DataFrame:
    w, month = _to_date(PAIR), F.col("month")
    positive = F.when(F.col("actual_positive"), month)
    df = df.withColumns({
        "last_observed_month_to_date": F.last(F.when(F.col("actual_observed"), month), ignorenulls=True).over(w), "last_positive_month_to_date": F.last(positive, ignorenulls=True).over(w),
        "first_positive_month_to_date": F.min(positive).over(w), "observed_month_count_to_date": F.count_if("actual_observed").over(w), "positive_month_count_to_date": F.count_if("actual_positive").over(w),
    })
    return df.withColumns({f"months_since_{c}": month_diff(month, F.col(f"{c}_month" if c == "first_observed" else f"{c}_month_to_date")) for c in ("first_observed", "first_positive", "last_observed", "last_positive")})


def guarded_panel(panel: DataFrame, guards: Guards) -> DataFrame:
    """The pair panel with its contract observed: one row a pair and month, no gaps, no look ahead, returns without a target."""
    before = F.lag("month").over(Window.partitionBy(*PAIR).orderBy("month"))
    marked = panel.withColumns({"_repeat": repeats(PAIR, "month"), "_gap": before.isNotNull() & (F.add_months(before, 1) < F.col("month"))})
    seen = guards.watch(marked, {
        "row_repeated": F.col("_repeat"), "month_missing": F.col("_gap"), "looks_ahead": F.col("first_positive_month_to_date") > F.col("month"), "before_first_observation": F.col("month") < F.col("first_observed_month"),
        "returns_with_target": F.col("actual_negative_only") & (F.col("target_available") | F.col("actual_gross_m2").isNotNull()),
    }, some=True)
    return seen.drop("_repeat", "_gap")


def positive_events(fact: DataFrame) -> DataFrame:
    """The fact with new_positive_pair and reactivated_pair (positive again after a gap of two months at least)."""
    whole = Window.partitionBy(*PAIR)
    before = whole.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    positive = F.col("gross_positive_m2") > 0
    marked = fact.withColumns({"_first": F.min(F.when(positive, F.col("month"))).over(whole), "_previous": F.max(F.when(positive, F.col("month"))).over(before)})
    gap = month_diff(F.col("month"), F.col("_previous"))
    return marked.withColumns({
        "positive_pair": positive, "new_positive_pair": positive & (F.col("month") == F.col("_first")), "reactivated_pair": positive & F.coalesce(gap >= 2, F.lit(False)), "positive_gap_months": F.when(positive, gap),
    }).drop("_first", "_previous")


def branch_month(fact: DataFrame) -> DataFrame:
    """Sums, counts and concentration of a branch's month, in one aggregation."""
    events = positive_events(fact)
    amount = F.when(F.col("gross_positive_m2") > 0, F.col("gross_positive_m2"))
    rank = F.row_number().over(Window.partitionBy("branch_code", "month").orderBy(F.desc("gross_positive_m2"), "base_sku"))
    events = events.withColumns({"_x": amount, "_rank": rank})
    share = lambda k: F.sum(F.when(F.col("_rank") <= k, F.col("_x"))) / F.sum("_x")
    return events.groupBy("branch_code", "month").agg(
        F.sum("gross_positive_m2").alias("branch_gross_m2"), F.sum("negative_m2").alias("branch_negative_m2"), F.sum("net_m2").alias("branch_net_m2"),
        F.countDistinct("base_sku").alias("observed_pair_count"), F.count_if("positive_pair").alias("positive_pair_count"), F.count_if(F.col("observation_status") == "EXPLICIT_ZERO_ONLY").alias("explicit_zero_pair_count"),
        F.count_if(F.col("observation_status") == "NEGATIVE_ONLY").alias("negative_only_pair_count"), F.sum("observed_bravo_count").alias("observed_bravo_count"),
        F.count_if("new_positive_pair").alias("new_positive_pair_count"), F.count_if("reactivated_pair").alias("reactivated_pair_count"),
        share(1).alias("pair_top1_share"), share(5).alias("pair_top5_share"), share(10).alias("pair_top10_share"), (F.sum(F.col("_x") * F.col("_x")) / (F.sum("_x") * F.sum("_x"))).alias("pair_hhi"),
    ).withColumns({
        "observed_base_sku_count": F.col("observed_pair_count"), "positive_base_sku_count": F.col("positive_pair_count"), "new_positive_sku_count": F.col("new_positive_pair_count"),
        "sku_top1_share": F.col("pair_top1_share"), "sku_top5_share": F.col("pair_top5_share"),
    })


SHARES = ("pair_top1_share", "pair_top5_share", "pair_top10_share", "pair_hhi", "sku_top1_share", "sku_top5_share")


def branch_panel(fact: DataFrame, branch: DataFrame, end: str) -> DataFrame:
    """branch x month, dense; months without sales are zeros, their shares null."""
    months = branch_month(fact)
    sums = ("branch_gross_m2", "branch_negative_m2", "branch_net_m2")
    counts = [c for c in months.columns if c.endswith("_count")]
    df = spine(months, ["branch_code"], end, "branch_first_observed_month").join(months, ["branch_code", "month"], "left")
    df = df.withColumn("branch_source_row_observed", F.col("observed_pair_count").isNotNull())
    df = df.withColumns({**{c: F.coalesce(c, F.lit(0.0)) for c in sums}, **{c: F.coalesce(c, F.lit(0)) for c in counts}})
    df = df.withColumns({"branch_observed": F.lit(True), "branch_positive": F.col("branch_gross_m2") > 0})
    w = _to_date(["branch_code"])
    df = df.withColumns({"branch_observed_month_count_to_date": F.count_if("branch_observed").over(w), "branch_positive_month_count_to_date": F.count_if("branch_positive").over(w)})
    return df.join(branch, "branch_code", "left")


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    months = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))).alias("month"))
    return months.withColumns(calendar_parts(F.col("month")))


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """year, tet and kings: a row for each year, from the lunisolar calendar (a driver-side table of a few years)."""
    return spark.createDataFrame([(y, lunar.new_year(y), lunar.kings_day(y)) for y in range(first_year, last_year + 1)], "year int, tet date, kings date")


def lunar_middles(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """target_month with the lunar month of its 15th and whether that is a leap month."""
    rows = [(dt.date(y, m, 1), *lunar.to_lunar(dt.date(y, m, 15))[1::2]) for y in range(first_year, last_year + 1) for m in range(1, 13)]
    return spark.createDataFrame(rows, "target_month date, target_lunar_month_mid int, target_lunar_month_mid_is_leap boolean")


def target_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """What is known in advance of each month: parts, working days, nominal holidays, lunar month, distance from the lunar new year."""
    days = holidays(spark, first_year - 1, last_year + 1)
    month = F.col("target_month")
    this = days.select(F.col("year").alias("target_year"), "tet", "kings")
    near = [days.select((F.col("year") - shift).alias("target_year"), F.col("tet").alias(name)) for shift, name in ((-1, "tet_before"), (1, "tet_after"))]
    df = lunar_middles(spark, first_year, last_year).withColumn("target_year", F.year(month)).join(F.broadcast(this), "target_year")
    for x in near:
        df = df.join(F.broadcast(x), "target_year")
    middle = F.date_add(month, 14)
    in_tet, in_kings = month_start(F.col("tet")) == month, month_start(F.col("kings")) == month
    number = F.month(month)
    events = in_tet.cast("int") + in_kings.cast("int") + number.isin(1, 4, 5, 9).cast("int")
    nominal = F.when(in_tet, 5).otherwise(0) + in_kings.cast("int") + number.isin(1, 4, 5).cast("int") + F.when(number == 9, 2).otherwise(0)
    month_sin, month_cos = cyclic(number, 12)
    lunar_sin, lunar_cos = cyclic(F.col("target_lunar_month_mid"), 12)

    def days_to(later: bool) -> Column:
        gaps = [F.datediff(F.col(c), middle) if later else F.datediff(middle, F.col(c)) for c in ("tet_before", "tet", "tet_after")]
        return F.array_min(F.filter(F.array(*gaps), lambda x: x >= 0))

    return df.select(
        "target_month", number.alias("target_month_num"), F.quarter(month).alias("target_quarter"), "target_year", F.dayofmonth(F.last_day(month)).alias("target_days_in_month"),
        month_sin.alias("target_month_sin"), month_cos.alias("target_month_cos"), weekdays(month).alias("target_weekday_count"), events.alias("target_public_holiday_event_count"),
        nominal.alias("target_statutory_holiday_nominal_days"), F.greatest(F.lit(0), weekdays(month) - nominal).alias("target_working_days_proxy"), "target_lunar_month_mid", "target_lunar_month_mid_is_leap",
        lunar_sin.alias("target_lunar_month_sin"), lunar_cos.alias("target_lunar_month_cos"), F.when(in_tet, F.dayofmonth("tet")).otherwise(0).alias("target_tet_day_of_month"),
        days_to(True).alias("target_days_to_next_tet_from_midmonth"), days_to(False).alias("target_days_since_prev_tet_from_midmonth"), in_tet.alias("target_is_tet_month"),
        (F.add_months(month, 1) == month_start(F.col("tet"))).alias("target_is_pre_tet_month"), (F.add_months(month, -1) == month_start(F.col("tet"))).alias("target_is_post_tet_month"),
    )
