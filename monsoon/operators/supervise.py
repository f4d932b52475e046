"""Origin x horizon panels, split roles and origin-honest phases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monsoon.schema import DataError

HORIZONS = (1, 2, 3)


def expand(df: DataFrame, keys: list[str], targets: dict[str, str]) -> DataFrame:
    """A row for each origin and horizon, with values of the month ahead.

    The panel is dense, so the value h months ahead is the h-th next row: no self-join and no exchange beyond the panel's
    own.  targets maps columns to their names as targets; they are dropped under their own names.
    """
    w = Window.partitionBy(*keys).orderBy("month")
    ahead = [F.struct(F.lit(h).alias("horizon"), *[F.lead(c, h).over(w).alias(n) for c, n in targets.items()]) for h in HORIZONS]
    rows = df.withColumn("_ahead", F.array(*ahead)).withColumnRenamed("month", "forecast_origin").drop(*targets)
    rows = rows.withColumn("_t", F.explode("_ahead"))
    return rows.select(*[c for c in rows.columns if c not in ("_ahead", "_t")], "_t.*").withColumn("target_month", F.add_months("forecast_origin", F.col("horizon")))


PAIR_TARGETS = {
    "actual_gross_m2": "target_actual_gross_m2", "actual_positive": "target_actual_positive", "actual_negative_only": "target_actual_negative_only", "target_available": "target_available", "zero_semantics": "target_zero_semantics",
}
BRANCH_TARGETS = {"branch_gross_m2": "target_branch_gross_m2", "branch_observed": "target_branch_observed", "branch_positive": "target_branch_positive"}


def with_split(df: DataFrame, train_end: str, validation_origin: str, available: Column) -> DataFrame:
    """TRAIN up to train_end, OFFICIAL_VALIDATION from the one origin; other rows go.  Masks also need a target."""
    train = F.col("target_month") <= F.lit(train_end).cast("date")
    valid = F.col("forecast_origin") == F.lit(validation_origin).cast("date")
    role = F.when(train, "TRAIN").when(valid, "OFFICIAL_VALIDATION")
    has = F.coalesce(available, F.lit(False))
    return df.withColumn("split_role", role).where("split_role is not null").withColumns({
        "historical_train_mask": (F.col("split_role") == "TRAIN") & has, "official_validation_mask": (F.col("split_role") == "OFFICIAL_VALIDATION") & has, "horizon_label": F.concat(F.lit("h"), F.col("horizon").cast("string")),
    })


def with_calendar(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """calendar has a row for each month of some years, a bounded table."""
    return df.join(F.broadcast(calendar), "target_month", "left")


def pair_dev_panel(origin: DataFrame, calendar: DataFrame, train_end: str, validation_origin: str) -> DataFrame:
    """origin is pair_origin_features with the target columns kept."""
    rows = expand(origin, ["base_sku", "branch_code"], PAIR_TARGETS).where(F.col("forecast_origin") <= F.lit(validation_origin).cast("date"))
    return with_calendar(with_split(rows, train_end, validation_origin, F.col("target_available")), calendar)


def branch_dev_panel(origin: DataFrame, panel: DataFrame, calendar: DataFrame, train_end: str, validation_origin: str) -> DataFrame:
    values = panel.select("branch_code", "month", *BRANCH_TARGETS)
    rows = expand(origin.join(values, ["branch_code", "month"]), ["branch_code"], BRANCH_TARGETS).where(F.col("forecast_origin") <= F.lit(validation_origin).cast("date"))
    return with_calendar(with_split(rows, train_end, validation_origin, F.col("target_branch_observed")), calendar)


def universes(df: DataFrame, guard: bool = False) -> dict[str, DataFrame]:
    """train, val_all and val_primary (current and known pairs); guard raises if one is empty."""
    val = df.where("official_validation_mask and target_available")
    out = {"train": df.where("historical_train_mask and target_available"), "val_all": val, "val_primary": val.where(primary())}
    if guard and (empty := [k for k, v in out.items() if v.isEmpty()]):
        raise DataError(f"empty universe {empty}")
    return out


def primary() -> Column:
    return F.coalesce(F.col("target_available") & F.col("current_production_forecast_mask") & F.col("known_pair_asof_origin"), F.lit(False))


def rolling_origins(spark: SparkSession, first: str, last: str, frozen_start: str, longest: int = 3) -> DataFrame:
    """Monthly origins; one whose last target would lie in the frozen period goes."""
    months = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("origin"))
    return months.where(F.add_months("origin", longest) < F.lit(frozen_start).cast("date"))


def rolling_panel(origin: DataFrame, calendar: DataFrame, frozen_start: str) -> DataFrame:
    """The supervised panel of the backtest: every origin and horizon before the frozen period."""
    rows = expand(origin, ["base_sku", "branch_code"], PAIR_TARGETS)
    return with_calendar(rows.where((F.col("target_month") < F.lit(frozen_start).cast("date")) & F.col("target_available").isNotNull()), calendar)


PHASES = ("FIT", "CAL", "EVAL")


def origin_phases(panel: DataFrame, origins: DataFrame, phases: Sequence[str] = PHASES) -> DataFrame:
    """Each row once for every origin and phase that it serves, of the phases asked for.

    FIT is before the last three closed months, CAL in them (primary rows only), EVAL from the origin itself on later months
    (primary).  origins is a small table of months; its months become an array, so that rows are exploded and not joined.
    """
    months = sorted(r.origin for r in origins.select("origin").distinct().collect())
    if not months:
        return panel.withColumns({"origin": F.lit(None).cast("date"), "phase": F.lit(None).cast("string")}).where("false")
    target, known, main = F.col("target_month"), F.coalesce(F.col("target_available"), F.lit(False)), primary()

    def phase(o: Column) -> Column:
        rules = {
            "FIT": known & (target < F.add_months(o, -2)),
            "CAL": main & target.between(F.add_months(o, -2), o),
            "EVAL": main & (F.col("forecast_origin") == o) & (target > o),
        }
        return F.coalesce(*[F.when(rules[name], name) for name in PHASES if name in phases], F.lit(None))

    served = F.filter(F.transform(F.array(*[F.lit(o) for o in months]), lambda o: F.struct(o.alias("origin"), phase(o).alias("phase"))), lambda s: s.phase.isNotNull())
    return panel.withColumn("_s", F.explode(served)).select(*panel.columns, "_s.origin", "_s.phase")


def split_audit(phases: DataFrame) -> DataFrame:
    return phases.groupBy("origin", "phase", "horizon").agg(F.count("*").alias("n_rows"), F.min("target_month").alias("min_target"), F.max("target_month").alias("max_target"))


def fit_calibration(panel: DataFrame, origin: str) -> dict[str, DataFrame]:
    """Rows for the fit at one origin, by phase."""
    o = F.lit(origin).cast("date")
    known = panel.where((F.col("target_month") <= o) & F.col("target_available"))
    start = F.add_months(o, -2)
    return {"FIT": known.where(F.col("target_month") < start), "CAL": known.where((F.col("target_month") >= start) & primary())}


def prospective(origin: DataFrame, calendar: DataFrame, forecast_origin: str) -> DataFrame:
    """The rows to forecast: production pairs at the origin, for each horizon."""
    rows = origin.where((F.col("month") == F.lit(forecast_origin).cast("date")) & F.col("current_production_forecast_mask")).withColumnRenamed("month", "forecast_origin")
    rows = rows.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in HORIZONS])))
    return with_calendar(rows.withColumn("target_month", F.add_months("forecast_origin", F.col("horizon"))), calendar)


def cutoff_guard(panel: DataFrame, origin: str) -> DataFrame:
    last = panel.agg(F.max("month").cast("string")).first()[0]
    if last != origin:
        raise DataError(f"the panel ends in {last}, not at the origin {origin}")
    return panel
