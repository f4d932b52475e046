import datetime as dt

import pytest
from pyspark.sql import functions as F

from monsoon.functions.text import base_sku_parts, channel_relation, clean, fold, observation_status, status
from monsoon.operators import dataset, panel
from monsoon.schema import DataError, assert_unique, checked_join, require_columns

SALES = "bravo_sku string, branch_code string, unit string, month string, total_quantity string, total_amount double, line_count bigint"


def masters(spark):
    sku = spark.createDataFrame(
        [("01.L1.3060.A", "01.L1.3060.X", "active"), ("01.L1.3060.B", " 01.L1.3060.X ", "Vô hiệu hóa"), ("bad", "01.L1", "x"), ("none", None, "active"), ("l2", "01.L2.3060.Y", "active")],
        "bravo_sku string, base_sku string, master_status string",
    ).withColumns({c: F.lit("a") for c in ("product_group", "brand", "price_group", "factory_code", "pull_source", "branch_channel")})
    channel = spark.createDataFrame([("001", "B1", "R", "UNIS", "Hoạt động")], "branch_code string, branch_name string, region string, brand string, master_status string")
    return dataset.bridge(sku), dataset.dim_branch(channel)


def build(spark, rows, end="2025-04-01"):
    bridge, branch = masters(spark)
    sales = spark.createDataFrame([(s, b, "m2 ", m, q, 1.0, 1) for s, b, m, q in rows], SALES)
    obs = dataset.observation(sales, bridge, branch, guard=True)
    fact = dataset.fact(obs)
    return obs, fact, panel.pair_panel(fact, dataset.dim_base(bridge), branch, end), panel.branch_panel(fact, branch, end)


def test_variants_of_one_month_add_up_and_the_inactive_one_stays(spark):
    _, fact, _, _ = build(spark, [("01.L1.3060.A", "001", "2025-01-01", "10"), ("01.L1.3060.B", "001", "2025-01-01", "-2"), ("01.L1.3060.B", "001", "2025-03-01", "4")])
    rows = {str(r.month): r for r in fact.collect()}
    first = rows["2025-01-01"]
    assert (first.gross_positive_m2, first.negative_m2, first.net_m2, first.observed_bravo_count, first.observation_status) == (10, -2, 8, 2, "MIXED_POSITIVE_NEGATIVE")
    assert len(rows) == 2


def test_missing_explicit_and_negative_months(spark):
    _, _, pairs, places = build(spark, [("01.L1.3060.A", "001", "2025-01-01", "-5"), ("01.L1.3060.A", "001", "2025-03-01", "7"), ("01.L1.3060.A", "001", "2025-04-01", "0")])
    rows = {str(r.month): r for r in pairs.collect()}
    jan, feb, mar, apr = (rows[f"2025-0{i}-01"] for i in (1, 2, 3, 4))
    assert (jan.target_available, jan.actual_gross_m2, jan.first_positive_month_to_date, jan.zero_semantics) == (False, None, None, "NEGATIVE_ONLY_GROSS_ZERO")
    assert (feb.target_available, feb.actual_gross_m2, feb.zero_semantics, feb.source_row_observed) == (True, 0.0, "OBSERVED_ZERO_IMPLICIT", False)
    assert (mar.months_since_first_positive, mar.positive_month_count_to_date, mar.first_positive_month_to_date) == (0, 1, dt.date(2025, 3, 1))
    assert (apr.zero_semantics, apr.months_since_last_positive) == ("OBSERVED_ZERO", 1)
    feb_place = {str(r.month): r for r in places.collect()}["2025-02-01"]
    assert (feb_place.branch_gross_m2, feb_place.branch_observed, feb_place.branch_source_row_observed, feb_place.pair_hhi) == (0.0, True, False, None)


def test_exclusions(spark):
    obs, _, _, _ = build(spark, [("01.L1.3060.A", "001", "2025-01-01", "1"), ("01.L1.3060.A", "009", "2025-01-01", "1"), ("bad", "001", "2025-01-01", "1"), ("none", "001", "2025-01-01", "1"), ("l2", "001", "2025-01-01", "1"), ("?", "001", "2025-01-01", "1")])
    found = {(r.bravo_sku, r.branch_code): r.primary_exclusion_reason for r in obs.collect()}
    assert found == {("01.L1.3060.A", "001"): "ELIGIBLE", ("01.L1.3060.A", "009"): "UNMATCHED_BRANCH", ("bad", "001"): "INVALID_STRUCTURE", ("none", "001"): "UNMAPPED", ("l2", "001"): "NON_L1", ("?", "001"): "UNMATCHED_MASTER"}


def test_bad_values_become_null_and_guards_raise(spark):
    sales = spark.createDataFrame([("a", "001", "M2", "2025-13-01", "1", 1.0, 1), ("a", "001", "M2", "2025-01-01", "x", 1.0, None), ("a", " ", "KG", "2025-01-01", "1", 1.0, 1)], SALES)
    assert [r.high_level_bucket for r in dataset.prepare_sales(sales).collect()] == ["INVALID_REQUIRED_FIELD"] * 3
    with pytest.raises(DataError, match="day 1"):
        dataset.prepare_sales(spark.createDataFrame([("a", "1", "M2", "2025-01-02", "1", 1.0, 1)], SALES), guard=True)
    with pytest.raises(DataError, match="SOURCE_DUPLICATE"):
        dataset.prepare_sales(spark.createDataFrame([("a", "1", "M2", "2025-01-01", "1", 1.0, 1)] * 2, SALES), guard=True)


def test_conflicting_attributes_raise(spark):
    bridge, _ = masters(spark)
    odd = bridge.withColumn("brand", F.col("bravo_sku"))
    with pytest.raises(Exception, match="BASE_ATTRIBUTE_CONFLICT"):
        dataset.dim_base(odd).collect()


def test_text_functions(spark):
    df = spark.createDataFrame([("  Hoạt động ", "A+CH1", "ch1", "01.L1.30x.A"), ("Đã", "CH2", "CH1", None)], "a string, c string, b string, s string")
    rows = df.select(clean(F.col("a")).alias("clean"), fold(F.col("a")).alias("fold"), status(F.col("a")).alias("status"), channel_relation(F.col("c"), F.col("b")).alias("relation"), *[v.alias(k) for k, v in base_sku_parts(F.col("s")).items()]).collect()
    assert (rows[0].clean, rows[0].fold, rows[0].status, rows[0].relation, rows[0].structure_valid, rows[0].is_l1) == ("Hoạt động", "hoat dong", "active", "COMBO_MATCH", False, True)
    assert (rows[1].fold, rows[1].status, rows[1].relation, rows[1].base_group_count, rows[1].is_l1) == ("da", "unknown", "CROSS_CHANNEL", 0, False)
    flags = spark.createDataFrame([(p, z, n) for p in (True, False) for z in (True, False) for n in (True, False)], "p boolean, z boolean, n boolean")
    assert len({r[0] for r in flags.select(observation_status(F.col("p"), F.col("z"), F.col("n"))).collect()}) == 8


def test_schema_guards(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b int")
    with pytest.raises(DataError):
        assert_unique(df, ["a", "b"])
    with pytest.raises(DataError):
        require_columns(df, ["a", "z"])
    with pytest.raises(DataError):
        checked_join(df, df, ["a"], validate="m:1")


def test_an_entity_after_the_end_has_no_month(spark):
    df = spark.createDataFrame([("x", dt.date(2025, 6, 1))], "k string, month date")
    assert panel.spine(df, ["k"], "2025-05-01").count() == 0
