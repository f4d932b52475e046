"""The locked forecast of one origin, and its later scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monsoon.functions.metrics import metric_row
from monsoon.operators.boost import Boosters
from monsoon.operators.scores import Y
from monsoon.operators.validate import prediction_guards
from monsoon.schema import PAIR, DataError
from monsoon.sources.runs import content_digest
from monsoon.sources.store import RunStore
from monsoon.sources.tables import write_parquet

KEYS = [*PAIR, "forecast_origin", "target_month", "horizon"]


def forecast_frame(scored: DataFrame, pred: str) -> DataFrame:
    return scored.select(*KEYS, "p_positive", F.col("q_positive").alias("pred_positive_quantity"), F.col(pred).alias("forecast_m2"))


def forecast_summary(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("horizon").agg(
        F.count("*").alias("n_rows"), F.countDistinct("base_sku").alias("n_sku"), F.countDistinct("branch_code").alias("n_branch"), F.sum("forecast_m2").alias("forecast_sum"), F.avg("forecast_m2").alias("forecast_mean"),
        F.avg("p_positive").alias("mean_p"), F.avg("pred_positive_quantity").alias("mean_q"),
    )


def safety(forecast: DataFrame, origin: str, horizons: Sequence[int] = (1, 2, 3)) -> dict[str, bool]:
    row = prediction_guards(forecast.withColumnRenamed("pred_positive_quantity", "q_positive"), "forecast_m2", KEYS).first().asDict()
    day = F.lit(origin).cast("date")
    odd = forecast.where((F.col("forecast_origin") != day) | ~F.col("horizon").isin(*horizons) | (F.col("target_month") != F.add_months(day, F.col("horizon"))))
    row |= {"one_origin": odd.isEmpty(), "not_empty": row.pop("n_rows") > 0}
    return row


def lock(forecast: DataFrame, root: str | Path, run_id: str, origin: str, now: dt.datetime | None = None, models: Boosters | None = None) -> str:
    """Publishes a forecast once, with its models, summary, digest and safety, all of what was written; the run's path.

    root is on a file system that every executor reaches.  Raises if a check fails, or if the id has been published, by another
    writer at the same time too; nothing is published then.
    """
    spark = forecast.sparkSession
    run = RunStore(spark, root).begin(run_id)
    write_parquet(forecast, run.at("forecast"))
    forecast = spark.read.parquet(run.at("forecast"))
    checks = safety(forecast, origin)
    if not all(checks.values()):
        run.abandon()
        raise DataError(f"unsafe forecast: {[k for k, v in checks.items() if not v]}")
    if models:
        models.save(spark, run.at("models"))
    digest = content_digest(forecast, KEYS + ["forecast_m2"]).first()
    summary = [r.asDict() for r in forecast_summary(forecast).collect()]
    return run.finish(status="PASS", origin=origin, locked_at=now or dt.datetime.now(dt.UTC), rows=digest.n_rows, digest=digest.digest, safety=checks, models=bool(models), summary=summary)


def score_vintage(forecast: DataFrame, panel: DataFrame) -> DataFrame:
    """Metrics by horizon once the target months are closed; months still open or without a target are left out."""
    actual = panel.where("target_available").select(*PAIR, F.col("month").alias("target_month"), F.col("actual_gross_m2").alias(Y))
    return forecast.join(actual, [*PAIR, "target_month"]).groupBy("horizon").agg(*metric_row(F.col(Y), F.col("forecast_m2")))
