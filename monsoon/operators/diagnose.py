"""Where errors come from: demand events, rounding, granularity, zeros, and agreement of two runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monsoon.functions.metrics import bias_ratio, diagnosis_row, floor0, wape
from monsoon.operators.scores import LEVELS, Y, _levels, _sets
from monsoon.schema import DataError, assert_none, assert_unique
from monsoon.sources.stored import store


# Names of demand events and rounding policies, in order of precedence.
EVENTS = (
    "actual_zero",
    "first_positive_known_pair",
    "reactivation_gap_6plus",
    "reactivation_gap_3_5",
    "reactivation_gap_1_2",
    "spike_3x_plus",
    "spike_2x_3x",
    "ongoing_positive",
)
POLICIES = ("raw", "round_nearest_1m2", "ceil_1m2")


@dataclass(frozen=True)
class EventRules:
    """Gaps in months since the last positive one, spikes as multiples of the mean positive month."""

    medium_gap_months: int = 3
    long_gap_months: int = 6
    moderate_spike_ratio: float = 2.0
    extreme_spike_ratio: float = 3.0
    min_spike_actual_m2: float = 1.0


def demand_event(rules: EventRules = EventRules()) -> Column:  # noqa: B008
    """The kind of a row's demand, by the first case that holds."""
    y, n, gap, mean = F.coalesce(F.col(Y), F.lit(0.0)), F.coalesce(F.col("pair_positive_count_to_origin"), F.lit(0)), F.col("months_since_last_positive"), F.col("pair_mean_positive_m2_to_origin")
    # months at the target, not at the origin, since the last positive one
    times = y / F.nullif(mean, F.lit(0.0))
    large = y >= rules.min_spike_actual_m2
    cases = (y <= 0, n <= 0, gap >= rules.long_gap_months, gap >= rules.medium_gap_months, gap >= 1, large & (times >= rules.extreme_spike_ratio), large & (times >= rules.moderate_spike_ratio), F.lit(True))
    return F.coalesce(*[F.when(case, name) for case, name in zip(cases, EVENTS, strict=True)])


def diagnosis(df: DataFrame, pred: str) -> DataFrame:
    """Metrics overall and by horizon, segment, event and event x horizon, with shares of all demand and under-forecast."""
    sets = {"OVERALL": [], "HORIZON": ["horizon"], "BEHAVIOR": ["segment"], "EVENT": ["event"], "EVENT_HORIZON": ["event", "horizon"]}
    rows = _levels(df, sets, [], diagnosis_row(F.col(Y), F.col(pred)))
    # a handful of rows, the overall one among them
    total = rows.where("level = 'OVERALL'").select(F.col("actual_sum").alias("_a"), F.col("underforecast_sum").alias("_u"))
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0.0))
    return rows.join(F.broadcast(total), how="cross").withColumns({"share_of_total_actual": share("actual_sum", "_a"), "share_of_total_underforecast": share("underforecast_sum", "_u")}).drop("_a", "_u")


def origin_events(df: DataFrame, pred: str) -> DataFrame:
    return df.groupBy("forecast_origin", "event").agg(*diagnosis_row(F.col(Y), F.col(pred)))


def rounded(x: Column, policy: str) -> Column:
    x = floor0(F.coalesce(x, F.lit(0.0)))
    return dict(zip(POLICIES, (x, F.floor(x + 0.5).cast("double"), F.ceil(x).cast("double")), strict=True))[policy]


def _policies(df: DataFrame, pred: str, keys: Sequence[str]) -> DataFrame:
    every = F.array(*[F.struct(F.lit(p).alias("policy"), rounded(F.col(pred), p).alias("value")) for p in POLICIES])
    return df.select(*keys, Y, floor0(F.coalesce(F.col(pred), F.lit(0.0))).alias("raw"), F.explode(every).alias("p")).select(*keys, Y, "raw", "p.policy", "p.value")


def rounding_months(df: DataFrame, pred: str) -> DataFrame:
    rows = _policies(df, pred, [])
    return rows.groupBy("policy").agg(
        *diagnosis_row(F.col(Y), F.col("value")), F.sum(F.col("value") - F.col("raw")).alias("added_m2"), F.avg((F.abs(F.col("value") - F.col("raw")) > 1e-9).cast("double")).alias("changed_row_rate"),
        F.avg(((F.col("raw") > 0) & (F.col("raw") < 1)).cast("double")).alias("raw_between_0_and_1_rate"),
    )


def rounding_windows(df: DataFrame, pred: str) -> DataFrame:
    """Three-month sums by level, rounded before the sum at the pair's month, or after it at the level's total."""
    keys = ["base_sku", "branch_code", "forecast_origin"]
    whole = Window.partitionBy(*keys)
    full = df.withColumns({"_n": F.count("*").over(whole), "_s": F.sum("horizon").over(whole)}).where("_n = 3 and _s = 6")
    before = _levels(_policies(full, pred, keys), LEVELS, ["policy"], [F.sum(Y).alias("y"), F.sum("value").alias("v")]).withColumn("stage", F.lit("BEFORE"))
    totals = _levels(full, LEVELS, [], [F.sum(Y).alias("y"), F.sum(floor0(F.col(pred))).alias("x")])
    after = totals.select("*", F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), rounded(F.col("x"), p).alias("v")) for p in POLICIES[1:]])).alias("p"))
    after = after.select("level", "y", "p.policy", "p.v", F.lit("AFTER").alias("stage"))
    rows = before.select("level", "y", "policy", "v", "stage").unionByName(after)
    return rows.groupBy("stage", "level", "policy").agg(*diagnosis_row(F.col("y"), F.col("v")))


def on_grid(x: Column, step: float) -> Column:
    """Near a multiple of step, by an absolute and a relative tolerance."""
    s = x / step
    return F.abs(s - F.rint(s)) <= 1e-8 + 1e-5 * F.abs(F.rint(s))


# Shares by grid and quantiles of positive actual demand.
STEPS = {"share_exact_integer_m2": 1.0, "share_on_0_1_m2_grid": 0.1, "share_on_0_01_m2_grid": 0.01, "share_on_0_001_m2_grid": 0.001}
QUANTILES = {"p01_positive_m2": 0.01, "p05_positive_m2": 0.05, "median_positive_m2": 0.5, "p95_positive_m2": 0.95}


def granularity(df: DataFrame, y: str = Y) -> DataFrame:
    """On which grids positive actual demand lies, and how it is spread; one row, without positive demand of nulls."""
    x = F.col(y)
    return df.where(x > 0).agg(
        F.count("*").alias("n_positive_actual_rows"),
        F.sum(x).alias("actual_sum_m2"),
        *[F.avg(on_grid(x, step).cast("double")).alias(name) for name, step in STEPS.items()],
        F.min(x).alias("min_positive_m2"),
        *[F.percentile(x, F.lit(q)).alias(name) for name, q in QUANTILES.items()],
    )


def fractions(df: DataFrame, y: str = Y, top: int = 50) -> DataFrame:
    """The most frequent fractional parts (three places) of positive values: a report of `top` rows."""
    part = F.pmod(F.col(y), F.lit(1.0))
    part = F.bround(F.when(F.abs(part - 1) < 1e-9, 0.0).otherwise(part), 3)
    positive = df.where(F.col(y) > 0)
    counts = positive.groupBy(part.alias("fractional_part_3dp")).agg(F.count("*").alias("n_rows"))
    total = positive.agg(F.count("*").alias("_t"))
    return counts.join(F.broadcast(total), how="cross").select("fractional_part_3dp", "n_rows", (F.col("n_rows") / F.col("_t")).alias("row_rate")).orderBy(F.desc("n_rows"), "fractional_part_3dp").limit(top)


def zero_positive(long: DataFrame) -> DataFrame:
    """What each model says on rows without and with demand, overall and by horizon."""
    y, p = F.col(Y), floor0(F.col("pred"))
    zero, pos = y == 0, y > 0
    of = lambda c, x: F.when(c, x)
    rate = lambda c, x: F.avg(F.when(c, x.cast("double")))
    return _sets(long, [["model"], ["model", "horizon"]], [
        F.count("*").alias("n_rows"), F.count_if(zero).alias("n_zero"), F.count_if(pos).alias("n_positive"), F.avg(of(zero, p)).alias("mean_pred_on_zero"), F.sum(of(zero, p)).alias("forecast_on_zero"),
        rate(zero, p > 1e-9).alias("zero_false_positive_rate"), rate(zero, p >= 1).alias("zero_pred_ge_1_rate"), F.avg(of(pos, p)).alias("mean_pred_on_positive"), rate(pos, p <= 1e-9).alias("positive_missed_rate"),
        wape(of(pos, y), of(pos, p)).alias("positive_wape"), F.sum(of(pos, p - y)).alias("positive_bias"), bias_ratio(of(pos, y), of(pos, p)).alias("positive_bias_ratio"),
    ])


def probability(df: DataFrame) -> DataFrame:
    """How the chance and the size of the two-part forecast fit, overall and by horizon."""
    y, p, q = F.col(Y), F.col("p_positive"), F.col("q_positive")
    pos = y > 0
    return _sets(df, [[], ["horizon"]], [
        F.count("*").alias("n_rows"), F.avg(pos.cast("double")).alias("positive_rate"), F.avg(p).alias("mean_p"), F.avg(F.when(pos, p)).alias("mean_p_positive"), F.avg(F.when(~pos, p)).alias("mean_p_zero"),
        F.avg(F.pow(p - pos.cast("double"), 2)).alias("brier"), wape(F.when(pos, y), F.when(pos, q)).alias("q_wape_positive"), bias_ratio(F.when(pos, y), F.when(pos, q)).alias("q_bias_ratio_positive"),
    ])


def _bucket_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """A row for each bucket of keys: its rows, and for the keys and each column a sum of hashes that any order gives."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    hashes = [F.xxhash64(*keys), *[F.xxhash64(*keys, F.lit(c), c, F.col(c).isNull()) for c in columns]]
    halves = [F.sum(half).alias(f"h{i}_{k}") for i, h in enumerate(hashes) for k, half in enumerate((h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)))]
    sums = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), *halves)
    return sums.select("bucket", "n", F.array(*[F.col(f"h{i}_{k}") for i in range(len(hashes)) for k in (0, 1)]).alias("sums"))


def parity(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], atol: float = 1e-9, buckets: int = 4096) -> DataFrame:
    """For each column, the rows on which two frames differ; rows that one of them lacks count under `grain`.

    Compared top down: sums of hashes by bucket of keys first, in one aggregation a frame, then the rows of differing buckets only
    are joined.  Doubles may differ by atol; a bucket in which they do so by less is joined and found alike.  Nulls are equal.
    """
    spark, kinds = left.sparkSession, dict(left.dtypes)
    a, b = (_bucket_sums(df, keys, columns, buckets) for df in (left, right))
    both = a.select("bucket", "n", "sums").join(b.select(F.col("bucket").alias("b_"), F.col("n").alias("m"), F.col("sums").alias("t")), F.col("bucket") == F.col("b_"), "full_outer")
    same = F.col("n").eqNullSafe(F.col("m")) & F.col("sums").eqNullSafe(F.col("t"))
    judged = store(both.select(F.coalesce("bucket", "b_").alias("bucket"), "n", same.alias("same")), "buckets")  # a row a bucket
    alike = judged.where("same").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()[0]
    differ = F.broadcast(judged.where("not same").select("bucket"))

    def rows(df: DataFrame, name: str) -> DataFrame:
        mine = df.select(*keys, F.struct(*columns).alias(name), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"))
        return mine.join(differ, "bucket", "left_semi").drop("bucket")

    joined = rows(left, "_a").join(rows(right, "_b"), list(keys), "full_outer")

    def differs(c: str) -> Column:
        x, y = F.col(f"_a.{c}"), F.col(f"_b.{c}")
        equal = (F.abs(x - y) <= atol) | (x.isNull() & y.isNull()) if kinds[c] in ("double", "float") else x.eqNullSafe(y)
        return ~F.coalesce(equal, F.lit(False)) & F.col("_a").isNotNull() & F.col("_b").isNotNull()

    bad = {"grain": F.col("_a").isNull() | F.col("_b").isNull(), **{c: differs(c) for c in columns}}
    wide = joined.agg(F.count("*").alias("n"), *[F.count_if(x).alias(f"bad{i}") for i, x in enumerate(bad.values())])
    found = F.array(*[F.struct(F.lit(c).alias("column"), (F.col("n") + alike).alias("n_rows"), F.col(f"bad{i}").alias("mismatches")) for i, c in enumerate(bad)])
    return wide.select(F.explode(found).alias("c")).select("c.*")


def align(challenger: DataFrame, reference: DataFrame, keys: Sequence[str], pred: str, y: str = Y, guard: bool = True) -> DataFrame:
    """Both models' predictions on the same rows; guard raises on repeated or missing keys and on different actuals."""
    a = challenger.select(*keys, F.col(y).alias("_y"), F.lit(True).alias("_in_a"), *[c for c in challenger.columns if c.startswith(("pred_", "p_", "q_"))])
    b = reference.select(*keys, F.col(y).alias(y), F.col(pred).alias(pred), F.lit(True).alias("_in_b"))
    both = a.join(b, list(keys), "full_outer")
    if guard:
        assert_unique(a, keys, "challenger")
        assert_unique(b, keys, "reference")
        assert_none(both, "_in_a is null or _in_b is null", "the two runs have different rows")
        assert_none(both, F.abs(F.col("_y") - F.col(y)) > 1e-9, "the two runs have different actuals")
    return both.where("_in_a and _in_b").drop("_y", "_in_a", "_in_b")


def comparison_review(monthly: DataFrame, windows: DataFrame, zero: DataFrame, revision: DataFrame, reference: str, challenger: str) -> dict:
    """What a reviewer decides on: both models' main figures and their differences; nothing is promoted by itself."""
    def of(df: DataFrame, column: str, where: str) -> dict[str, float | None]:
        return {r["model"]: r[column] for r in df.where(where).select("model", column).collect()}

    figures = {
        "monthly_wape": of(monthly, "wape", "horizon is null and segment is null"), "wape_3m_pair": of(windows, "wape_3m", "level = 'PAIR'"),
        "zero_false_positive_rate": of(zero, "zero_false_positive_rate", "horizon is null"), "revision_ratio": of(revision, "revision_ratio", "level = 'PAIR' and transition = 'H2_TO_H1'"),
    }
    out = {}
    for name, by in figures.items():
        if reference not in by or challenger not in by:
            raise DataError(f"{name} lacks a model")
        a, b = by[reference], by[challenger]
        out[name] = {"reference": a, "challenger": b, "difference": None if a is None or b is None else b - a}
    return {"figures": out, "decision": "REVIEW_REQUIRED", "auto_promoted": False}
