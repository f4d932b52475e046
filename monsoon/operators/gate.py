"""Behaviour segments, expert gates and hurdle thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monsoon.functions.metrics import wape, zero_false_positive_rate
from monsoon.operators.scores import Y, melt


@dataclass(frozen=True)
class Behaviour:
    adi: float = 1.32
    cv2: float = 0.49
    least_positive: int = 1
    min_rows: int = 50
    min_calibration_rows: int = 100
    thresholds: tuple[float, ...] = tuple(round(0.05 * i, 2) for i in range(20))
    tolerance: float = 1e-9


#: The experts that a segment may choose from, in the order in which ties are settled.
ALLOWED = {
    "regular": ("soft", "naive_1", "seasonal_12", "ma_3"),
    "intermittent": ("soft", "croston_sba", "tsb", "naive_1"),
    "very_sparse": ("soft", "croston_sba", "tsb", "naive_1"),
}
#: The same where experts are chosen on calibration rows.
CALIBRATION_ALLOWED = {
    "regular": ("soft", "ma_3", "naive_1", "seasonal_12"),
    "intermittent": ("soft", "ma_3", "croston_sba", "tsb", "naive_1"),
    "very_sparse": ("soft", "croston_sba", "tsb", "naive_1"),
}
# Where an expert was chosen.
SEGMENT, SEGMENT_FALLBACK = "SEGMENT_PRIMARY", "HORIZON_PRIMARY_FALLBACK"
CALIBRATION, CALIBRATION_FALLBACK = "CALIBRATION_SEGMENT", "CALIBRATION_HORIZON_FALLBACK"


def behaviour_segment(conf: Behaviour = Behaviour()) -> Column:  # noqa: B008
    """very_sparse with few positives or undefined statistics, regular where both are low, else intermittent."""
    n, adi, cv2 = F.col("pair_positive_count_to_origin"), F.col("pair_adi_target_available_to_origin"), F.col("pair_cv2_positive_to_origin")
    return F.when((n <= conf.least_positive) | adi.isNull() | cv2.isNull(), "very_sparse").when((adi < conf.adi) & (cv2 < conf.cv2), "regular").otherwise("intermittent")


def gate(
    scored: DataFrame, experts: Sequence[str], conf: Behaviour = Behaviour(), by: Sequence[str] = (), allowed: dict[str, Sequence[str]] | None = None, min_rows: int | None = None, sources: tuple[str, str] = (SEGMENT, SEGMENT_FALLBACK)  # noqa: B008
) -> DataFrame:
    """The expert of least WAPE for each horizon and segment (and each value of by), of those that the segment may use.

    A segment of fewer than min_rows rows (by default conf.min_rows) chooses by its horizon's rows.  Ties go by the order of
    the segment's list; a segment that allowed doesn't name may use all.  The phase whose rows are given decides what the
    gate may know.
    """
    by, least = list(by), conf.min_rows if min_rows is None else min_rows
    lists = {s: [e for e in of if e in experts] for s, of in (allowed or {}).items()}
    names = F.array(*[F.lit(e) for e in experts])
    own = F.coalesce(*[F.when(F.col("segment") == s, F.array(*[F.lit(e) for e in of])) for s, of in lists.items() if of], names) if lists else names
    errors = melt(scored, [*by, "horizon", "segment", Y], [f"pred_{e}" for e in experts])
    # sums by segment give those of the horizon
    parts = errors.groupBy(*by, "horizon", "segment", "model").agg(F.sum(F.abs(F.col(Y) - F.greatest("pred", F.lit(0.0)))).alias("e"), F.sum(F.abs(Y)).alias("y"), F.count("*").alias("n_rows"))
    whole = parts.groupBy(*by, "horizon", "model").agg(F.sum("e").alias("whole_e"), F.sum("y").alias("whole_y"))
    scores = parts.join(whole, [*by, "horizon", "model"])
    small = F.col("n_rows") < least
    error, actual = F.when(small, F.col("whole_e")).otherwise(F.col("e")), F.when(small, F.col("whole_y")).otherwise(F.col("y"))
    scores = scores.withColumns({"w": error / F.nullif(actual, F.lit(0.0)), "place": F.array_position(own, F.col("model"))})
    finite = F.col("w").isNotNull() & (F.col("place") > 0)
    best = scores.groupBy(*by, "horizon", "segment").agg(
        F.max("n_rows").alias("n_rows"),
        F.min_by(F.when(finite, F.col("model")), F.when(finite, F.struct(F.round("w", 12), "place"))).alias("expert"),
    )
    return best.withColumn("gate_source", F.when(F.col("n_rows") < least, sources[1]).otherwise(sources[0]))


def gates_by_origin(calibration: DataFrame, experts: Sequence[str], conf: Behaviour = Behaviour()) -> DataFrame:  # noqa: B008
    """The experts of each origin, chosen on its calibration rows."""
    return gate(calibration, experts, conf, ["origin"], CALIBRATION_ALLOWED, conf.min_calibration_rows, (CALIBRATION, CALIBRATION_FALLBACK))


def apply_gate(df: DataFrame, choice: DataFrame, experts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """df with pred_gated: the chosen expert's prediction, 0 where there is none.  choice is gate()'s small table."""
    picked = F.coalesce(*[F.when(F.col("expert") == e, F.col(f"pred_{e}")) for e in experts], F.lit(0.0))
    return df.join(F.broadcast(choice.select(*by, "horizon", "segment", "expert")), [*by, "horizon", "segment"], "left").withColumn("pred_gated", picked)


def choice_frequency(choices: DataFrame) -> DataFrame:
    return choices.groupBy("horizon", "segment", "expert").agg(F.count("*").alias("n_origins"))


def hurdle(p: Column, q: Column, threshold: Column) -> Column:
    return F.when(p < threshold, 0.0).otherwise(p * q)


def threshold_grid(df: DataFrame, conf: Behaviour = Behaviour()) -> DataFrame:  # noqa: B008
    """WAPE and false positives of every threshold of the grid by horizon, in one pass over the rows."""
    grid = F.array(*[F.lit(t) for t in conf.thresholds])
    rows = df.select("horizon", Y, "p_positive", "q_positive", F.explode(grid).alias("threshold"))
    pred = hurdle(F.col("p_positive"), F.col("q_positive"), F.col("threshold"))
    return rows.groupBy("horizon", "threshold").agg(wape(F.col(Y), pred).alias("wape"), zero_false_positive_rate(F.col(Y), pred).alias("zero_false_positive_rate"))


def threshold_choice(grid: DataFrame, conf: Behaviour = Behaviour()) -> DataFrame:  # noqa: B008
    """Least WAPE (within the tolerance), then least false positives, then the largest threshold."""
    least = grid.groupBy("horizon").agg(F.min("wape").alias("least"))
    near = grid.join(F.broadcast(least), "horizon").where(F.col("wape") <= F.col("least") + conf.tolerance)
    order = F.struct(F.coalesce("zero_false_positive_rate", F.lit(float("inf"))), -F.col("threshold"))
    return near.groupBy("horizon").agg(F.min_by(F.struct("threshold", "wape", "zero_false_positive_rate"), order).alias("b")).select("horizon", "b.*")
