"""Masters and sales to bridge, dimensions, classified observations and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monsoon.functions.dates import to_date, to_number
from monsoon.functions.text import base_sku_parts, channel_relation, clean, observation_status, status, unit
from monsoon.schema import assert_none, assert_unique, require_columns
from monsoon.sources.stages import Guards

STABLE = ["product_group", "brand", "price_group", "factory_code", "pull_source"]
ATTRIBUTES = [*STABLE, "branch_channel", "sku_name", "factory_sku", "sale_sku", "replacement_sku"]
NATURAL_KEY = ["bravo_sku", "branch_code", "unit_norm", "month"]
FACT_KEY = ["base_sku", "branch_code", "month"]


def bridge(master: DataFrame) -> DataFrame:
    """One row for each item code: its base code's parts, status, mapping and reason of exclusion."""
    require_columns(master, ["bravo_sku", "base_sku", "master_status"], "master_sku")
    attributes = [clean(F.col(c)).alias(c) for c in ATTRIBUTES if c in master.columns]
    df = master.select(clean(F.col("bravo_sku")).alias("bravo_sku"), clean(F.col("base_sku")).alias("base_sku"), status(F.col("master_status")).alias("current_sku_status"), *attributes)
    df = df.withColumns(base_sku_parts(F.col("base_sku")))
    reason = F.when(F.col("base_sku").isNull(), "UNMAPPED").when(~F.col("structure_valid"), "INVALID_STRUCTURE").when(~F.col("is_l1"), "NON_L1").otherwise("ELIGIBLE")
    return df.withColumns({
        "mapping_status": F.when(F.col("base_sku").isNull(), "UNMAPPED").otherwise("MAPPED"),
        "modeling_exclusion_reason": reason,
        "modeling_universe_valid": reason == "ELIGIBLE",
    })


def dim_base(bridge_df: DataFrame) -> DataFrame:
    """One row for each eligible base code: variants by status and the attributes on which all its codes agree.

    Raises, when run, if two codes of a base disagree on an attribute.
    """
    valid = bridge_df.where("modeling_universe_valid")
    single = [
        F.when(F.min(c) != F.max(c), F.raise_error(F.concat(F.lit(f"BASE_ATTRIBUTE_CONFLICT {c} "), F.min("base_sku"))).cast("string")).otherwise(F.max(c)).alias(c)
        for c in STABLE if c in bridge_df.columns
    ]
    of = lambda s: F.count_if(F.col("current_sku_status") == s)
    return valid.groupBy("base_sku").agg(
        *[F.min(c).alias(c) for c in ("base_group1", "base_group2", "base_group3", "base_group4", "tile_size_code")], F.countDistinct("bravo_sku").alias("variant_count"),
        of("active").alias("active_variant_count"), of("inactive").alias("inactive_variant_count"), of("unknown").alias("unknown_variant_count"),
        (of("active") > 0).alias("base_current_active"), (F.countDistinct("current_sku_status") > 1).alias("mixed_status"), *single,
    )


def dim_branch(master: DataFrame) -> DataFrame:
    require_columns(master, ["branch_code", "master_status"], "master_channel")
    current = status(F.col("master_status"))
    kept = [clean(F.col(c)).alias(n) for c, n in (("branch_name", "branch_name"), ("region", "region"), ("brand", "branch_brand")) if c in master.columns]
    return master.select(clean(F.col("branch_code")).alias("branch_code"), *kept, current.alias("branch_current_status"), (current == "active").alias("branch_current_active"))


def prepare_sales(sales: DataFrame, guard: bool = False, guards: Guards | None = None) -> DataFrame:
    """Sales with clean keys and coerced values; guard raises on months that don't begin on day 1 and on repeated keys.

    guards observe months in the job that reads the sales, with no pass of their own; repeated keys are observed on the fact.
    """
    require_columns(sales, ["bravo_sku", "branch_code", "unit", "month", "total_quantity", "total_amount", "line_count"], "sales_monthly")
    df = sales.select(
        clean(F.col("bravo_sku")).alias("bravo_sku"), clean(F.col("branch_code")).alias("branch_code"), unit(F.col("unit")).alias("unit_norm"), to_date(F.col("month")).alias("month"),
        to_number(F.col("total_quantity")).alias("qty"), to_number(F.col("total_amount")).alias("amount"), F.coalesce(F.col("line_count").try_cast("bigint"), F.lit(0)).alias("line_count_num"),
    )
    missing = F.col("bravo_sku").isNull() | F.col("branch_code").isNull() | F.col("unit_norm").isNull() | F.col("month").isNull() | F.col("qty").isNull()
    df = df.withColumn("invalid_required_field", missing).withColumn(
        "high_level_bucket", F.when(missing, "INVALID_REQUIRED_FIELD").when(F.col("unit_norm") == "M2", "M2_PENDING").otherwise("NON_M2")
    )
    if guards:
        df = guards.watch(df, {"month_not_aligned": F.dayofmonth("month") != 1}, some=True)
    if guard:
        assert_none(df, "dayofmonth(month) <> 1", "a month doesn't begin on day 1")
        assert_unique(df.where(~F.col("invalid_required_field")), NATURAL_KEY, "SOURCE_DUPLICATE_REVIEW_REQUIRED: sales")
    return df


def observation(sales: DataFrame, bridge_df: DataFrame, branches: DataFrame, guard: bool = False, guards: Guards | None = None) -> DataFrame:
    """Valid M2 sales with their masters, reason of exclusion, sign split and channel relation.

    Masters join by key with no hint: the optimiser broadcasts them where their size allows.
    """
    m2 = prepare_sales(sales, guard, guards).where((F.col("unit_norm") == "M2") & ~F.col("invalid_required_field"))
    codes = bridge_df.select("bravo_sku", "base_sku", "mapping_status", "modeling_exclusion_reason", "current_sku_status", "branch_channel", F.lit(True).alias("has_sku"))
    places = branches.select("branch_code", "region", "branch_brand", "branch_current_status", F.lit(True).alias("has_branch"))
    df = m2.join(codes, "bravo_sku", "left").join(places, "branch_code", "left")
    reason = (
        F.when(F.col("has_sku").isNull(), "UNMATCHED_MASTER").when(F.col("mapping_status") == "UNMAPPED", "UNMAPPED")
        .when(F.col("modeling_exclusion_reason").isin("INVALID_STRUCTURE", "NON_L1"), F.col("modeling_exclusion_reason"))
        .when(F.col("has_branch").isNull(), "UNMATCHED_BRANCH").otherwise("ELIGIBLE")
    )
    q = F.col("qty")
    return df.select(
        "bravo_sku", "base_sku", "branch_code", "month", F.when(F.col("has_sku").isNull(), "UNMATCHED_MASTER").otherwise(F.col("mapping_status")).alias("mapping_status"),
        F.when(F.col("has_branch").isNull(), "UNMATCHED_BRANCH").otherwise("MAPPED").alias("branch_mapping_status"), reason.alias("primary_exclusion_reason"),
        F.when(reason == "ELIGIBLE", "MODELING_VALID").otherwise("EXCLUDED").alias("row_disposition"), F.greatest(q, F.lit(0.0)).alias("gross_positive_m2"),
        F.least(q, F.lit(0.0)).alias("negative_m2"), q.alias("net_m2"), F.col("amount").alias("total_amount_audit"), F.col("line_count_num").alias("source_line_count"),
        (q > 0).alias("observed_positive"), (q == 0).alias("observed_explicit_zero"), (q < 0).alias("observed_negative"), observation_status(q > 0, q == 0, q < 0).alias("observation_status"),
        channel_relation(F.col("branch_channel"), F.col("branch_brand")).alias("channel_relation_snapshot"), "current_sku_status", "branch_current_status",
    )


def fact(obs: DataFrame) -> DataFrame:
    """Valid observations by base code, branch and month; a sum without values is 0."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).alias(c)
    any_ = lambda c: F.bool_or(c).alias(c)
    grouped = obs.where("row_disposition = 'MODELING_VALID'").groupBy(*FACT_KEY).agg(
        total("gross_positive_m2"), total("negative_m2"), total("net_m2"), total("total_amount_audit"), F.sum("source_line_count").alias("source_line_count"),
        F.count("*").alias("observed_source_row_count"), F.countDistinct("bravo_sku").alias("observed_bravo_count"), any_("observed_positive"), any_("observed_explicit_zero"), any_("observed_negative"),
    )
    return grouped.withColumn("observation_status", observation_status(F.col("observed_positive"), F.col("observed_explicit_zero"), F.col("observed_negative")))


def guarded_fact(fact: DataFrame, guards: Guards) -> DataFrame:
    """The fact with its contract observed: keys are known, an item code has one row a branch and month, signs hold.

    The fact counts rows and distinct item codes anyway, so repeated source keys show without a grouping of their own.
    """
    return guards.watch(fact, {
        "key_missing": F.col("base_sku").isNull() | F.col("branch_code").isNull() | F.col("month").isNull(), "source_key_repeated": F.col("observed_source_row_count") > F.col("observed_bravo_count"),
        "wrong_sign": (F.col("gross_positive_m2") < 0) | (F.col("negative_m2") > 0),
    }, some=True)
