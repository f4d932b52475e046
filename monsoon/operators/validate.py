"""Validation suites as frames of checks, audits of the dataset, and prediction guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monsoon.functions.text import clean
from monsoon.schema import PAIR, DataError, duplicates

Check = tuple[str, DataFrame]


def _violations(df: DataFrame, name: str, bad: Column) -> DataFrame:
    return df.agg(F.count_if(bad).alias("violations")).select(F.lit(name).alias("check"), "violations")


def unique_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return duplicates(df, keys).agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def subset_check(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_anti").agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def validate_core(bridge: DataFrame, base: DataFrame, branch: DataFrame, obs: DataFrame, fact: DataFrame, pair: DataFrame, places: DataFrame) -> DataFrame:
    """check, violations and status of the dataset's grains, signs, zero semantics, origin safety and reconciliation."""
    total = lambda df, name: df.agg(F.coalesce(F.sum("gross_positive_m2"), F.lit(0.0)).alias(f"{name}_p"), F.coalesce(F.sum("negative_m2"), F.lit(0.0)).alias(f"{name}_n"))
    sums = total(obs.where("row_disposition = 'MODELING_VALID'"), "o").join(total(fact, "f"), how="cross")
    implicit = F.col("zero_semantics") == "OBSERVED_ZERO_IMPLICIT"
    checks = [
        unique_check(bridge, ["bravo_sku"], "bridge_unique"), unique_check(base, ["base_sku"], "dim_base_unique"), unique_check(branch, ["branch_code"], "dim_branch_unique"),
        unique_check(obs, ["bravo_sku", "branch_code", "month"], "observation_unique"), unique_check(fact, [*PAIR, "month"], "fact_unique"), unique_check(pair, [*PAIR, "month"], "pair_panel_unique"),
        unique_check(places, ["branch_code", "month"], "branch_panel_unique"), subset_check(fact, base, "base_sku", "fact_base_known"), subset_check(fact, branch, "branch_code", "fact_branch_known"),
        _violations(fact, "fact_signs", (F.col("gross_positive_m2") < 0) | (F.col("negative_m2") > 0)), _violations(pair, "implicit_zero_is_zero", implicit & ((F.col("actual_gross_m2") != 0) | ~F.col("target_available"))),
        _violations(pair, "negative_only_has_no_target", F.col("actual_negative_only") & (F.col("target_available") | F.col("actual_gross_m2").isNotNull())),
        _violations(pair, "first_positive_is_origin_safe", F.col("first_positive_month_to_date") > F.col("month")), _violations(pair, "starts_at_first_observation", F.col("month") < F.col("first_observed_month")),
        _violations(sums, "positive_reconciles", F.abs(F.col("o_p") - F.col("f_p")) > 1e-8), _violations(sums, "negative_reconciles", F.abs(F.col("o_n") - F.col("f_n")) > 1e-8),
    ]
    return _all(checks)


def _all(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


#: Values that a feature frame must not hold.
FORBIDDEN = ("actual_gross_m2", "gross_positive_m2", "net_m2", "negative_m2", "total_amount_audit")


def leaking(columns: Sequence[str], forbidden: Sequence[str] = FORBIDDEN, parts: Sequence[str] = ()) -> list[str]:
    """Candidates that are forbidden, by name or by a part of it."""
    return sorted(c for c in columns if c in forbidden or any(p in c for p in parts))


def validate_features(pair: DataFrame, origin_limit: str, frozen_start: str) -> DataFrame:
    """Checks of a development panel: grain, information, alignment, frozen months, masks and carried peaks."""
    day = lambda s: F.lit(s).cast("date")
    keys = ["forecast_origin", "target_month", "horizon", *PAIR]
    return _all([
        unique_check(pair, keys, "grain_unique"), _violations(pair, "information_up_to_origin", F.col("feature_information_max_month") > F.col("forecast_origin")),
        _violations(pair, "horizon_aligned", F.add_months("forecast_origin", F.col("horizon")) != F.col("target_month")), _violations(pair, "no_frozen_target", F.col("target_month") >= day(frozen_start)),
        _violations(pair, "origin_up_to_limit", F.col("forecast_origin") > day(origin_limit)), _violations(pair, "validation_origin_locked", F.col("official_validation_mask") & (F.col("forecast_origin") != day(origin_limit))),
        _violations(pair, "returns_have_no_target", F.col("target_actual_negative_only") & (F.col("historical_train_mask") | F.col("official_validation_mask"))),
        _violations(pair, "peak_is_carried", (F.col("pair_positive_count_to_origin") > 0) & F.col("pair_peak_positive_m2_to_origin").isNull()),
        _violations(pair, "calendar_known", F.col("target_working_days_proxy").isNull()),
    ])


def calendar_purity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each calendar column, the months in which it isn't one value."""
    per = df.groupBy("target_month").agg(*[(F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
    return per.agg(*[F.count_if(F.col(c) > 1).alias(c) for c in columns]).unpivot([], list(columns), "column", "impure_months")


def prediction_guards(df: DataFrame, pred: str, keys: Sequence[str]) -> DataFrame:
    """One row of booleans: no nulls, chances in 0..1, nothing negative, forecast = chance x size, unique keys."""
    p, q, f = F.col("p_positive"), F.col("q_positive"), F.col(pred)
    ok = df.agg(
        (F.count_if(p.isNull() | q.isNull() | f.isNull()) == 0).alias("no_null"), (F.count_if((p < 0) | (p > 1)) == 0).alias("probability_in_range"), (F.count_if((q < 0) | (f < 0)) == 0).alias("nothing_negative"),
        (F.count_if(F.abs(f - p * q) > 1e-9) == 0).alias("forecast_is_product"), F.count("*").alias("n_rows"),
    )
    return ok.join(duplicates(df, keys).agg((F.count("*") == 0).alias("keys_unique")), how="cross")


def require_pass(checks: DataFrame) -> DataFrame:
    failed = [r["check"] for r in checks.where("status <> 'PASS'").collect()]
    if failed:
        raise DataError(f"validation failed: {failed}")
    return checks


# ---- audits

def source_profile(sales: DataFrame) -> DataFrame:
    return sales.groupBy(clean(F.col("unit")).alias("unit")).agg(F.count("*").alias("n_rows"), F.min("month").alias("min_month"), F.max("month").alias("max_month"), F.countDistinct("bravo_sku").alias("n_sku"), F.countDistinct("branch_code").alias("n_branch"))


def null_blank_report(df: DataFrame, table: str) -> DataFrame:
    """Nulls and blanks of every column."""
    columns = df.columns
    wide = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns], *[F.count_if(F.trim(F.col(c).cast("string")) == "").alias(f"b_{c}") for c in columns])
    rows = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(c).alias("field"), F.col("n").alias("n_rows"), F.col(f"n_{c}").alias("null_count"), F.col(f"b_{c}").alias("blank_count")) for c in columns])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def duplicate_report(frames: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    out = None
    for name, df, keys in frames:
        one = duplicates(df, keys).agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("duplicate_rows")).select(F.lit(name).alias("table"), "duplicate_groups", "duplicate_rows")
        out = one if out is None else out.unionByName(one)
    return out


def mapping_audit(obs: DataFrame) -> DataFrame:
    return obs.groupBy("primary_exclusion_reason").agg(F.count("*").alias("n_rows"), F.sum("gross_positive_m2").alias("gross_m2"), F.sum("negative_m2").alias("negative_m2"))


def structure_audit(bridge: DataFrame) -> DataFrame:
    return bridge.groupBy("mapping_status", "modeling_exclusion_reason", "base_group_count", "structure_valid", "is_l1").agg(F.count("*").alias("n_sku"), F.countDistinct("base_sku").alias("n_base"))


def channel_profile(obs: DataFrame) -> DataFrame:
    """Rows and gross quantity by channel relation, with its share of all."""
    rows = obs.where("row_disposition = 'MODELING_VALID'").groupBy("channel_relation_snapshot").agg(F.count("*").alias("n_rows"), F.sum("gross_positive_m2").alias("gross_m2"))
    total = rows.agg(F.sum("gross_m2").alias("_t"))
    return rows.join(F.broadcast(total), how="cross").withColumn("gross_share", F.col("gross_m2") / F.nullif(F.col("_t"), F.lit(0.0))).drop("_t")


def attribute_conflicts(bridge: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Base codes whose item codes disagree on a field, with the values."""
    long = bridge.where("base_sku is not null").unpivot(["base_sku"], list(fields), "field", "value")
    return long.groupBy("base_sku", "field").agg(F.countDistinct("value").alias("n_values"), F.array_join(F.array_sort(F.collect_set("value")), " | ").alias("values")).where("n_values > 1")


def reconciliation(obs: DataFrame, fact: DataFrame) -> DataFrame:
    side = lambda df, n: df.agg(F.sum("gross_positive_m2").alias(f"{n}_positive"), F.sum("negative_m2").alias(f"{n}_negative"), F.count("*").alias(f"{n}_rows"))
    both = side(obs.where("row_disposition = 'MODELING_VALID'"), "source").join(side(fact, "fact"), how="cross")
    return both.withColumn("reconciled", (F.abs(F.col("source_positive") - F.col("fact_positive")) <= 1e-8) & (F.abs(F.col("source_negative") - F.col("fact_negative")) <= 1e-8))


def panel_semantics(pair: DataFrame) -> DataFrame:
    return pair.groupBy("zero_semantics").agg(F.count("*").alias("n_rows"), F.count_if("target_available").alias("n_available"), F.count_if("actual_positive").alias("n_positive"), F.sum("actual_gross_m2").alias("gross_m2"))


def panel_counts(pair: DataFrame, places: DataFrame) -> DataFrame:
    """track, item and n: what each panel holds, and rows that would leak (which should be none)."""
    only = F.col("actual_negative_only")
    pairs = pair.agg(
        F.count("*").alias("rows"), F.countDistinct(*PAIR).alias("known_pairs"), F.count_if("actual_observed").alias("actual_observed_rows"), F.count_if(~F.col("actual_observed")).alias("missing_unknown_rows"),
        F.count_if(only).alias("negative_only_rows"), F.count_if(only & F.col("target_available")).alias("negative_only_target_available_rows"),
        F.count_if(only & F.col("actual_gross_m2").isNotNull()).alias("negative_only_nonnull_actual_target_rows"), F.count_if(F.col("first_positive_month_to_date") > F.col("month")).alias("future_first_positive_visibility_rows"),
    )
    branches = places.agg(
        F.count("*").alias("rows"), F.countDistinct("branch_code").alias("branches_with_history"), F.count_if("branch_observed").alias("observed_branch_months"), F.count_if(~F.col("branch_observed")).alias("missing_branch_months"),
        F.count_if("branch_positive").alias("positive_branch_months"),
    )
    long = lambda df, track: df.unpivot([], df.columns, "item", "n").select(F.lit(track).alias("track"), "item", "n")
    return long(pairs, "PAIR").unionByName(long(branches, "BRANCH"))


def key_report(frames: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows and distinct keys of each table."""
    out = None
    for name, df, keys in frames:
        one = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")).select(F.lit(name).alias("table"), "n_rows", "n_keys")
        out = one if out is None else out.unionByName(one)
    return out
