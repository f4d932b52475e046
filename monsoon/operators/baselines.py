"""Naive, seasonal, averaging and intermittent-demand baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monsoon.functions.metrics import floor0
from monsoon.schema import PAIR


def simple_baselines() -> dict[str, Column]:
    """From pair lags; nulls count as zero before averaging."""
    lag = lambda n: F.coalesce(F.col(f"pair_lag_{n}"), F.lit(0.0))
    return {"pred_naive_1": floor0(lag(1)), "pred_seasonal_12": floor0(lag(12)), "pred_ma_3": floor0((lag(1) + lag(2) + lag(3)) / 3)}


def intermittent_states(panel: DataFrame, alpha: float = 0.1, beta: float = 0.1, keep: tuple[str, ...] = ()) -> DataFrame:
    """Croston-SBA and TSB after every month of a pair; months without a target leave the state as it is.

    The recursions have closed forms in running sums: with n the index among available months and k among positive ones, an
    exponentially smoothed value is (1 - a)^k times the running sum of a (1 - a)^-i x_i (the first without its factor a).  So
    one window order serves all, with no fold and no grouped Python.  Columns in keep stay beside the states, so that features
    over the same windows need no join.
    """
    w = Window.partitionBy(*PAIR).orderBy("month")
    run, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    y = F.col("actual_gross_m2")
    positive = F.col("target_available") & (y > 0)
    a, b = F.lit(1 - alpha), F.lit(1 - beta)
    read = dict.fromkeys([*PAIR, "month", "target_available", "actual_gross_m2", *keep])
    df = panel.select(*read).withColumns({
        "_n": F.count_if("target_available").over(run), "_k": F.count_if(F.coalesce(positive, F.lit(False))).over(run), "_pos": F.coalesce(positive, F.lit(False)),
    })
    df = df.withColumn("_gap", F.col("_n") - F.coalesce(F.max(F.when(F.col("_pos"), F.col("_n"))).over(before), F.lit(0)))
    first = F.col("_k") == 1

    def smoothed(x: Column) -> Column:
        term = F.when(F.col("_pos"), F.when(first, x / a).otherwise(alpha * x * F.pow(a, -F.col("_k"))))
        return F.pow(a, F.col("_k")) * F.sum(term).over(run)

    chance = F.when(F.col("_pos"), F.when(first, F.pow(b, -F.col("_n")) / F.col("_n")).otherwise(beta * F.pow(b, -F.col("_n"))))
    df = df.withColumns({"_z": smoothed(y), "_p": smoothed(F.col("_gap").cast("double")), "_c": F.pow(b, F.col("_n")) * F.sum(chance).over(run)})
    some = F.col("_k") >= 1
    return df.select(
        *PAIR, "month", *keep, F.when(some, (1 - alpha / 2) * F.col("_z") / F.greatest(F.col("_p"), F.lit(1e-12))).otherwise(0.0).alias("pred_croston_sba"),
        F.when(some, F.col("_c") * F.col("_z")).otherwise(0.0).alias("pred_tsb"),
    )


def soft_expected(p: Column, q: Column) -> Column:
    """Chance times quantity: a missing chance is 0, others are cut to 0..1; a missing or infinite quantity is 0."""
    inf = float("inf")
    chance = F.when(p.isNull() | F.isnan(p), 0.0).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
    quantity = F.when(q.isNull() | F.isnan(q) | (F.abs(q) == inf), 0.0).otherwise(F.greatest(q, F.lit(0.0)))
    return chance * quantity


EXPERTS = ("naive_1", "seasonal_12", "ma_3", "croston_sba", "tsb", "soft")
PREDS = tuple(f"pred_{e}" for e in EXPERTS)


def predictions(df: DataFrame) -> DataFrame:
    """All experts on a supervised panel with features and states; soft is the analytic rate x mean size."""
    p, q = F.col("pair_positive_rate_to_origin"), F.col("pair_mean_positive_m2_to_origin")
    return df.withColumns({**simple_baselines(), "p_positive": F.coalesce(p, F.lit(0.0)), "q_positive": F.coalesce(q, F.lit(0.0)), "pred_soft": soft_expected(p, q)})
