"""Origin-safe features: lags, rolling and expanding statistics of pairs, base codes, tile sizes and branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monsoon.functions.dates import month_diff, ratio
from monsoon.schema import PAIR

LAGS = (1, 2, 3, 6, 12)
WINDOWS = (3, 6, 12)


def _w(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("month")


def lags(value: str, prefix: str, keys: list[str]) -> dict[str, Column]:
    """lag_1 is the origin month itself."""
    return {f"{prefix}_lag_{n}": F.lag(value, n - 1).over(_w(keys)) if n > 1 else F.col(value) for n in LAGS}


def rolling(value: str | Column, keys: list[str], w: int, op: str) -> Column:
    """Over the last w rows with the current one; nulls are skipped; std (of the population) needs two values."""
    frame = _w(keys).rowsBetween(1 - w, 0)
    value = F.col(value) if isinstance(value, str) else value
    if op == "std":
        return F.when(F.count(value).over(frame) >= 2, F.stddev_pop(value).over(frame))
    return {"mean": F.avg, "sum": F.sum, "max": F.max, "count": F.count}[op](value).over(frame)


def pair_features(panel: DataFrame) -> DataFrame:
    """The pair's own lags, rolling and expanding features; all windows share one partitioning and order."""
    y = "actual_gross_m2"
    to_date = _w(PAIR).rowsBetween(Window.unboundedPreceding, 0)
    positive = F.when(F.col("actual_positive"), F.col(y))
    cols: dict[str, Column] = lags(y, "pair", PAIR)
    for w in WINDOWS:
        cols |= {f"pair_roll_{w}_{op}": rolling(y, PAIR, w, op) for op in ("mean", "sum", "std")}
        cols[f"pair_roll_{w}_target_available_count"] = rolling(F.col("target_available").cast("int"), PAIR, w, "sum")
        cols[f"pair_roll_{w}_positive_count"] = rolling(F.col("actual_positive").cast("int"), PAIR, w, "sum")
        cols[f"pair_roll_{w}_calendar_count"] = rolling(F.lit(1), PAIR, w, "count")
    cols |= {
        "pair_history_length_months": month_diff(F.col("month"), F.col("first_observed_month")) + 1, "pair_target_available_count_to_origin": F.count_if("target_available").over(to_date),
        "pair_observed_source_month_count_to_origin": F.col("observed_month_count_to_date"), "pair_positive_count_to_origin": F.col("positive_month_count_to_date"),
        "pair_last_positive_m2_to_origin": F.last(positive, ignorenulls=True).over(to_date), "pair_peak_positive_m2_to_origin": F.max(positive).over(to_date),
        "_sum": F.coalesce(F.sum(positive).over(to_date), F.lit(0.0)), "_squares": F.coalesce(F.sum(positive * positive).over(to_date), F.lit(0.0)),
    }
    df = panel.withColumns(cols)
    n, available = F.col("pair_positive_count_to_origin"), F.col("pair_target_available_count_to_origin")
    mean = ratio(F.col("_sum"), n)
    variance = F.greatest(ratio(F.col("_squares"), n) - mean * mean, F.lit(0.0))
    df = df.withColumns({
        **{f"pair_roll_{w}_coverage": ratio(F.col(f"pair_roll_{w}_target_available_count"), F.col(f"pair_roll_{w}_calendar_count")) for w in WINDOWS},
        "pair_positive_rate_to_origin": ratio(n, available), "pair_mean_positive_m2_to_origin": mean, "pair_peak_share_to_origin": ratio(F.col("pair_peak_positive_m2_to_origin"), F.col("_sum")),
        "pair_adi_target_available_to_origin": ratio(available, n), "pair_cv2_positive_to_origin": F.when((n >= 2) & (mean > 0), variance / F.nullif(mean * mean, F.lit(0.0))),
    })
    return df.drop("_sum", "_squares")


def sku_features(panel: DataFrame) -> DataFrame:
    """A base code over all its branches; a sum of nulls alone is null."""
    key = ["base_sku"]
    df = panel.groupBy("base_sku", "month").agg(
        F.sum("actual_gross_m2").alias("sku_global_gross_m2"), F.count_if("target_available").alias("sku_target_available_branch_count"), F.count_if("actual_positive").alias("sku_positive_branch_count"),
        F.countDistinct("branch_code").alias("sku_known_branch_count_to_origin"), F.count("first_positive_month_to_date").alias("sku_ever_positive_branch_count_to_origin"),
    )
    observed = (F.col("sku_target_available_branch_count") > 0).cast("int")
    positive = (F.coalesce("sku_global_gross_m2", F.lit(0.0)) > 0).cast("int")
    cols = lags("sku_global_gross_m2", "sku_global", key)
    cols |= {f"sku_global_roll_{w}_{op}": rolling("sku_global_gross_m2", key, w, op) for w in WINDOWS for op in ("mean", "sum")}
    cols |= {
        "sku_global_positive_rate_12m": ratio(rolling(positive, key, 12, "sum"), rolling(observed, key, 12, "sum")), "sku_target_available_branch_count_lag_1": F.col("sku_target_available_branch_count"),
        "sku_positive_branch_count_lag_1": F.col("sku_positive_branch_count"), "cross_branch_penetration_to_origin": ratio(F.col("sku_ever_positive_branch_count_to_origin"), F.col("sku_known_branch_count_to_origin")),
    }
    return df.withColumns(cols).drop("sku_global_gross_m2", "sku_target_available_branch_count", "sku_positive_branch_count")


def size_features(panel: DataFrame) -> DataFrame:
    """A tile size in a branch; a null size has none."""
    key = ["branch_code", "tile_size_code"]
    df = panel.where("tile_size_code is not null").groupBy(*key, "month").agg(
        F.sum("actual_gross_m2").alias("size_branch_gross_m2"), F.count_if("target_available").alias("size_branch_target_available_sku_count_lag_1"), F.count_if("actual_positive").alias("size_branch_positive_sku_count_lag_1")
    )
    cols = lags("size_branch_gross_m2", "size_branch", key) | {f"size_branch_roll_{w}_mean": rolling("size_branch_gross_m2", key, w, "mean") for w in WINDOWS}
    return df.withColumns(cols).drop("size_branch_gross_m2")


SNAPSHOTS = {c: f"{c}_snapshot" for c in ("brand", "product_group", "price_group", "factory_code", "pull_source", "region", "branch_brand")}
PAIR_PREFIXES = ("pair_", "months_since_", "sku_", "cross_branch_", "size_branch_")


def pair_origin_features(panel: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All features known at each origin, with masks and snapshots; raw targets are left out unless in keep."""
    df = pair_features(panel).join(sku_features(panel), ["base_sku", "month"], "left").join(size_features(panel), ["branch_code", "tile_size_code", "month"], "left")
    df = df.withColumnsRenamed({k: v for k, v in SNAPSHOTS.items() if k in df.columns}).withColumns({
        "current_production_forecast_mask": F.coalesce(F.col("base_current_active") & F.col("branch_current_active"), F.lit(False)), "known_pair_asof_origin": F.lit(True), "feature_information_max_month": F.col("month"),
    })
    meta = [*PAIR, "month", "feature_information_max_month", "known_pair_asof_origin", "current_production_forecast_mask", "tile_size_code", "base_group1", "base_group2", "base_group3", "base_group4", *SNAPSHOTS.values()]
    meta = [c for c in meta if c in df.columns]
    return df.select(*meta, *[c for c in df.columns if c.startswith(PAIR_PREFIXES) and c not in meta], *keep)


def branch_origin_features(panel: DataFrame) -> DataFrame:
    key, y = ["branch_code"], "branch_gross_m2"
    to_date = _w(key).rowsBetween(Window.unboundedPreceding, 0)
    cols: dict[str, Column] = lags(y, "branch", key)
    for w in WINDOWS:
        cols |= {f"branch_roll_{w}_{op}": rolling(y, key, w, op) for op in ("mean", "sum", "std")}
        cols[f"branch_roll_{w}_observed_count"] = rolling(F.col("branch_observed").cast("int"), key, w, "sum")
        cols[f"branch_roll_{w}_coverage"] = ratio(rolling(F.col("branch_observed").cast("int"), key, w, "sum"), rolling(F.lit(1), key, w, "count"))
    observed, positive = F.col("branch_observed_month_count_to_date"), F.col("branch_positive_month_count_to_date")
    cols |= {
        "branch_history_length_months": month_diff(F.col("month"), F.col("branch_first_observed_month")) + 1, "branch_observed_month_count_to_origin": observed, "branch_positive_month_count_to_origin": positive,
        "branch_positive_rate_to_origin": ratio(positive, observed),
        "months_since_last_branch_positive": month_diff(F.col("month"), F.last(F.when(F.col("branch_positive"), F.col("month")), ignorenulls=True).over(to_date)),
        **{f"branch_{c}_lag_1": F.col(c) for c in ("observed_pair_count", "positive_pair_count", "explicit_zero_pair_count", "negative_only_pair_count", "new_positive_pair_count", "reactivated_pair_count", "pair_top1_share", "pair_top5_share", "pair_top10_share", "pair_hhi")},
        "branch_average_m2_per_positive_pair_lag_1": ratio(F.col(y), F.col("positive_pair_count")), "branch_positive_pair_count_roll_3_mean": rolling("positive_pair_count", key, 3, "mean"),
        "branch_new_positive_pair_count_roll_3_mean": rolling("new_positive_pair_count", key, 3, "mean"),
    }
    df = panel.withColumns(cols)
    return df.select(
        "branch_code", "month", F.col("month").alias("feature_information_max_month"), F.coalesce("branch_current_active", F.lit(False)).alias("current_production_forecast_mask"),
        F.col("region").alias("region_snapshot"), F.col("branch_brand").alias("branch_brand_snapshot"), *cols,
    )
