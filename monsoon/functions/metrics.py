"""Forecast metrics as aggregate columns over an actual y and a prediction p."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = 1e-9


def floor0(p: Column) -> Column:
    """Not below zero; null stays null."""
    return F.when(p.isNotNull(), F.greatest(p, F.lit(0.0)))


def wape(y: Column, p: Column) -> Column:
    return F.sum(F.abs(y - floor0(p))) / F.nullif(F.sum(F.abs(y)), F.lit(0.0))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - floor0(p)))


def bias(y: Column, p: Column) -> Column:
    return F.sum(floor0(p) - y)


def bias_ratio(y: Column, p: Column) -> Column:
    return bias(y, p) / F.nullif(F.sum(F.abs(y)), F.lit(0.0))


def zero_false_positive_rate(y: Column, p: Column) -> Column:
    """Of rows without demand, the share with a prediction; predictions aren't floored here."""
    return F.avg(F.when(y <= ZERO, (p > ZERO).cast("double")))


def positive_wape(y: Column, p: Column) -> Column:
    return F.sum(F.when(y > 0, F.abs(y - floor0(p)))) / F.nullif(F.sum(F.when(y > 0, y)), F.lit(0.0))


def brier(y: Column, p: Column) -> Column:
    return F.avg(F.pow(p - (y > 0).cast("double"), 2))


def metric_row(y: Column, p: Column) -> list[Column]:
    return [
        F.count("*").alias("n_rows"), wape(y, p).alias("wape"), mae(y, p).alias("mae"), bias(y, p).alias("bias"), bias_ratio(y, p).alias("bias_ratio"),
        zero_false_positive_rate(y, p).alias("zero_false_positive_rate"), positive_wape(y, p).alias("positive_wape"),
    ]


def diagnosis_row(y: Column, p: Column) -> list[Column]:
    """Metrics with nulls as zero, and the sums of under- and over-forecast."""
    y, p = F.coalesce(y, F.lit(0.0)), floor0(F.coalesce(p, F.lit(0.0)))
    return [
        F.count("*").alias("n_rows"), F.sum(y).alias("actual_sum"), F.sum(p).alias("forecast_sum"), wape(y, p).alias("wape"), mae(y, p).alias("mae"), bias(y, p).alias("bias"),
        bias_ratio(y, p).alias("bias_ratio"), F.sum(F.greatest(y - p, F.lit(0.0))).alias("underforecast_sum"), F.sum(F.greatest(p - y, F.lit(0.0))).alias("overforecast_sum"),
    ]
