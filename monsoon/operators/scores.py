"""Scoreboards over predictions: levels, origins, windows of three months, revisions and stability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monsoon.functions.dates import month_diff
from monsoon.functions.metrics import bias, bias_ratio, floor0, mae, metric_row, wape

Y = "target_actual_gross_m2"


def melt(df: DataFrame, keys: Sequence[str], preds: Sequence[str]) -> DataFrame:
    """model and pred rows from one column for each expert."""
    return df.select(*keys, *preds).unpivot(list(keys), list(preds), "model", "pred").withColumn("model", F.regexp_replace("model", "^pred_", ""))


def _sets(df: DataFrame, sets: list[list[str]], aggs: list) -> DataFrame:
    every = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in every]).agg(*aggs)


def scoreboard(long: DataFrame, dims: Sequence[str] = ("horizon", "segment")) -> DataFrame:
    """Metrics by model, and by model and each dimension; a dimension not in use is null.  One pass for all."""
    return _sets(long, [["model"], *[["model", d] for d in dims]], metric_row(F.col(Y), F.col("pred")))


def by_origin(long: DataFrame) -> DataFrame:
    sets = [["forecast_origin", "model"], ["forecast_origin", "model", "horizon"]]
    return _sets(long, sets, metric_row(F.col(Y), F.col("pred")))


def by_universe(df: DataFrame, pred: Column, main: Column) -> DataFrame:
    """Metrics by horizon for each universe of a validation: val_all, all its rows, and val_primary, those that main holds for."""
    rows = df.select("horizon", Y, pred.alias("pred"), F.explode(F.array_compact(F.array(F.lit("val_all"), F.when(main, "val_primary")))).alias("universe"))
    return _sets(rows, [["universe"], ["universe", "horizon"]], metric_row(F.col(Y), F.col("pred")))


def branch_aggregate(long: DataFrame) -> DataFrame:
    """WAPE after summing each branch's target month."""
    sums = long.groupBy("model", "branch_code", "target_month").agg(F.sum(Y).alias("y"), F.sum("pred").alias("p"))
    return sums.groupBy("model").agg(wape(F.col("y"), F.col("p")).alias("branch_wape"))


def complete_windows(df: DataFrame, preds: Sequence[str]) -> DataFrame:
    """Sums over three months of pairs and origins that have each horizon just once."""
    sums = df.groupBy("base_sku", "branch_code", "forecast_origin").agg(
        F.count("*").alias("n"), F.countDistinct("horizon").alias("d"), F.sum("horizon").alias("s"), F.sum(Y).alias("actual_3m_m2"), *[F.sum(floor0(F.col(p))).alias(f"{p}_3m") for p in preds]
    )
    return sums.where("n = 3 and d = 3 and s = 6").drop("n", "d", "s")


def window_coverage(df: DataFrame) -> DataFrame:
    sums = df.groupBy("base_sku", "branch_code", "forecast_origin").agg((F.count("*") == 3).alias("whole"))
    return sums.agg(F.count("*").alias("total_windows"), F.count_if("whole").alias("complete_windows"), F.count_if(~F.col("whole")).alias("incomplete_windows"), F.avg(F.col("whole").cast("double")).alias("complete_rate"))


LEVELS = {"PAIR": ["base_sku", "branch_code", "forecast_origin"], "BASE_SKU": ["base_sku", "forecast_origin"], "BRANCH": ["branch_code", "forecast_origin"], "PORTFOLIO": ["forecast_origin"]}


def _levels(df: DataFrame, levels: dict[str, list[str]], keys: list[str], aggs: list) -> DataFrame:
    """df aggregated by grouping sets with a column for the level's name."""
    every = list(dict.fromkeys(c for s in levels.values() for c in s))
    grouped = df.groupingSets([[F.col(c) for c in [*keys, *s]] for s in levels.values()], *[F.col(c) for c in [*keys, *every]]).agg(F.grouping_id().alias("_g"), *aggs)
    name = F.lit(None).cast("string")
    for level, own in levels.items():
        bits = sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in own)
        name = F.when(F.col("_g") == bits, level).otherwise(name)
    return grouped.withColumn("level", name).drop("_g")


def cumulative(windows: DataFrame, preds: Sequence[str], per_origin: bool = False) -> DataFrame:
    """Three-month metrics by level and model: windows are summed by level and origin first."""
    values = [f"{p}_3m" for p in preds]
    rolled = _levels(windows, LEVELS, [], [F.sum("actual_3m_m2").alias("y"), *[F.sum(v).alias(v) for v in values]])
    long = rolled.unpivot(["level", "forecast_origin", "y"], values, "model", "p").withColumn("model", F.regexp_replace("model", "^pred_|_3m$", ""))
    keys = ["level", "model", *(["forecast_origin"] if per_origin else [])]
    y, p = F.col("y"), F.col("p")
    return long.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), wape(y, p).alias("wape_3m"), mae(y, p).alias("mae_3m"), bias(y, p).alias("bias_3m"), bias_ratio(y, p).alias("bias_ratio_3m"), F.sum(y).alias("actual_sum"), F.sum(floor0(p)).alias("forecast_sum")
    )


REVISION_SCHEMA = "base_sku string, branch_code string, target_month date, transition string, model string, old_pred double, new_pred double, revision double"


def revisions(df: DataFrame, preds: Sequence[str]) -> DataFrame:
    """A row for each pair, target and model whose forecast was made again one month later; none gives the same columns.

    Forecasts of one target follow each other by origin, so the earlier one is the row before: one exchange, no self-join.
    """
    keys = ["base_sku", "branch_code", "target_month"]
    before = F.lag(F.struct(F.col("forecast_origin").alias("o"), F.col("horizon").alias("h"), *preds)).over(Window.partitionBy(*keys).orderBy("forecast_origin"))
    rows = df.select(*keys, "forecast_origin", "horizon", F.struct(*preds).alias("new"), before.alias("old"))
    both = rows.where((F.col("old.h") == F.col("horizon") + 1) & (month_diff(F.col("forecast_origin"), F.col("old.o")) == 1)).withColumn("h", F.col("old.h"))
    models = F.array(*[F.struct(F.lit(p.removeprefix("pred_")).alias("model"), F.col(f"old.{p}").alias("old_pred"), F.col(f"new.{p}").alias("new_pred")) for p in preds])
    rows = both.select(*keys, F.concat(F.lit("H"), F.col("h"), F.lit("_TO_H"), F.col("h") - 1).alias("transition"), F.explode(models).alias("m"))
    return rows.select(*keys, "transition", "m.*", (F.col("m.new_pred") - F.col("m.old_pred")).alias("revision"))


def revision_summary(rows: DataFrame) -> DataFrame:
    """By pair, and by base code with branches summed first."""
    base = rows.groupBy("base_sku", "target_month", "transition", "model").agg(F.sum("old_pred").alias("old_pred"), F.sum("revision").alias("revision"))
    both = rows.select(F.lit("PAIR").alias("level"), "transition", "model", "old_pred", "revision").unionByName(base.select(F.lit("BASE_SKU").alias("level"), "transition", "model", "old_pred", "revision"))
    size = F.abs(F.col("revision"))
    return both.groupBy("level", "transition", "model").agg(
        F.count("*").alias("n_rows"), F.avg(size).alias("revision_mae"), (F.sum(size) / F.nullif(F.sum(F.abs("old_pred")), F.lit(0.0))).alias("revision_ratio"), F.sum("revision").alias("signed_revision")
    )


def stability(origin_scores: DataFrame, cumulative_scores: DataFrame) -> DataFrame:
    """How a model's monthly WAPE holds over origins, how often it wins one, and its three-month WAPE; best first."""
    whole = origin_scores.where("horizon is null")
    rank = F.row_number().over(Window.partitionBy("forecast_origin").orderBy(F.col("wape").asc_nulls_last(), "model"))
    stats = whole.withColumn("win", (rank == 1) & F.col("wape").isNotNull()).groupBy("model").agg(
        F.count("*").alias("n_origins"), F.avg("wape").alias("mean_wape"), F.median("wape").alias("median_wape"), F.stddev_pop("wape").alias("std_wape"), F.avg(F.abs("bias_ratio")).alias("mean_abs_bias"),
        F.max(F.abs("bias_ratio")).alias("max_abs_bias"), F.avg((F.col("bias_ratio") < 0).cast("double")).alias("under_forecast_rate"), F.count_if("win").alias("wins"),
    )
    level = lambda name: cumulative_scores.where(F.col("level") == name).select("model", F.col("wape_3m").alias(f"wape_3m_{name.lower()}"))
    return stats.join(level("PAIR"), "model", "left").join(level("BASE_SKU"), "model", "left")


def best_first(stable: DataFrame) -> DataFrame:
    return stable.orderBy("median_wape", "mean_abs_bias")
