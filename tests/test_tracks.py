import dataclasses
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from monsoon import schema
from monsoon.operators import select, track, tweedie
from monsoon.operators.scores import Y
from monsoon.schema import DataError

D = dt.date


def test_keys_are_normalised(spark):
    df = spark.createDataFrame([("2025-01-01", "2"), ("2025-02-01", "3.0")], "forecast_origin string, horizon string")
    assert [tuple(r) for r in schema.normalise_keys(df).collect()] == [(D(2025, 1, 1), 2), (D(2025, 2, 1), 3)]
    for bad in ("2.5", "x", None):
        with pytest.raises(Exception, match="no whole number"):
            schema.normalise_keys(spark.createDataFrame([(bad,)], "horizon string")).collect()
    assert schema.first_known(spark.createDataFrame([(None, None), ("v", None)], "a string, b string"), ["a", "b", "c"]) == {"a": "v", "b": None, "c": None}


def test_profiles_count_nulls_and_values(spark):
    df = spark.createDataFrame([(1, 0.5, None), (2, None, None), (2, 0.5, None)], "a int, b double, c string")
    assert {r.feature_name: (round(r.missing_rate, 3), r.n_unique) for r in select.column_profile(df, df.columns).collect()} == {"a": (0.0, 2), "b": (0.333, 1), "c": (1.0, 0)}
    assert {(r.missing_rate, r.n_unique) for r in select.column_profile(df.where("false"), df.columns).collect()} == {(None, 0)}


def test_correlations_skip_missing_values_and_constants(spark):
    rows = [(1e6 + i, None if i == 3 else 2.0 * i, float(i * i % 7), 5.0) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(3)
    found = {(r.feature_a, r.feature_b): r.correlation for r in select.correlations(df, ["a", "b", "c", "k"], 0.0).collect()}
    local = df.toPandas().corr()
    assert set(found) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert all(v == pytest.approx(local.loc[p], abs=1e-9) for p, v in found.items()) and found["a", "b"] == pytest.approx(1)
    assert select.correlations(df.where("false"), ["a", "b"]).count() == 0 and select.correlations(df, ["a"]).count() == 0


def _panel(spark):
    rows = [
        (f"S{i}", str(i % 5), D(2025, 1 + (i % 2) * 5, 1), h, D(2025, 1 + (i % 2) * 5 + h, 1), float(i % 4 * 10 * h), True, i % 2 == 0, i % 2 == 1, i % 8 != 1, True, float(i % 4), float(i % 4), 1.0, "north" if i % 3 else "south", 6 + h)
        for i in range(120) for h in (1, 2, 3)
    ]
    return spark.createDataFrame(rows, f"base_sku string, branch_code string, forecast_origin date, horizon int, target_month date, {Y} double, target_available boolean, historical_train_mask boolean, official_validation_mask boolean, current_production_forecast_mask boolean, known_pair_asof_origin boolean, pair_lag_1 double, pair_copy double, pair_const double, region_snapshot string, target_month_num int")


def test_a_track_is_selected_and_checked(spark):
    df = _panel(spark).persist()
    found = track.inventory({"PAIR": df})
    roles = {r.feature_name: (r.role, r.initial_model_candidate) for r in found.collect()}
    assert roles["pair_lag_1"] == ("MODEL_CANDIDATE_STAGE6_REVIEW", True) and roles["region_snapshot"][0] == "QA_SNAPSHOT_METADATA"
    assert roles[Y] == ("TARGET_OR_EVAL", False) and roles["base_sku"][0] == "IDENTITY_OR_CONTROL" and roles["current_production_forecast_mask"][0] == "QA_OR_AUXILIARY"
    as_text = found.withColumn("initial_model_candidate", F.when(F.col("initial_model_candidate"), " True").otherwise("no"))
    assert track.candidates_of(as_text, "PAIR", df) == track.candidates_of(found, "PAIR", df) == ["horizon", "pair_lag_1", "pair_copy", "pair_const", "target_month_num"]
    conf = select.Screen(min_selected=1, max_rows=1000)
    result = track.select_track(df, found, "PAIR", Y, {"lag": ["pair_lag"]}, "2026-01-01", conf, trees=3, repeats=1)
    assert result.kept == ["horizon", "pair_lag_1", "target_month_num"] and {"horizon", "pair_lag_1"} <= set(result.selected)
    assert result.rows == {"train": 180, "primary": 135, "secondary": 180} and result.primary["ALL"] < 0.5
    quality = {r.feature_name: (r.static_status, r.selected, r.family) for r in result.quality.collect()}
    assert quality["pair_copy"] == ("DROP_EXACT_DUPLICATE", False, "other") and quality["pair_lag_1"] == ("PASS_STATIC", True, "lag")
    checks = lambda *a: {r.check: r.violations for r in track.validate_selection(result, *a).collect()}
    assert len(checks(1, ["target_month_num"])) == 11 and not any(checks(1, ["target_month_num"]).values())
    assert checks(99)["nonempty_selected_list"] == 99 - len(result.selected) and checks(1)["calendar_v013_candidates_seen"] == len(track.CALENDAR) - 1
    spoiled = dataclasses.replace(result, quality=result.quality.withColumn("selected", F.lit(True)), rows=result.rows | {"secondary": 1, "primary": 0})
    failed = {r.check: r.violations for r in track.validate_selection(spoiled, 1, ["target_month_num"]).where("status = 'FAIL'").collect()}
    assert failed == {"selected_subset_static_kept": 2, "no_exact_duplicate_selected": 1, "no_constant_selected": 1, "primary_validation_nonempty": 1}
    for frame, start, match in ((df.where("historical_train_mask"), "2026-01-01", "primary"), (df, "2025-06-01", "frozen"), (df.withColumn("pair_lag_1", F.lit(math.inf)), "2026-01-01", "pair_lag_1")):
        with pytest.raises(DataError, match=match):
            track.select_track(frame, found, "PAIR", Y, {}, start, conf)


def test_tweedie_gives_the_means_of_categories(spark, tmp_path):
    """With categories alone the model is saturated, so its forecasts are the categories' means."""
    rows = [(c, m * (0.5 + i % 3 * 0.5), "p") for c, m in (("a", 10.0), ("b", 100.0), (None, 1.0)) for i in range(60)]
    df = spark.createDataFrame(rows, f"c string, {Y} double, pred_tweedie string").withColumn("features_", F.lit("clash"))
    conf = tweedie.Tweedie(numeric=(), categories=("c",), penalties=(0.0,))
    model = tweedie.fit_tweedie(df.drop("features_"), df.drop("features_").where("false"), conf)
    asked = df.drop("pred_tweedie", "features_")
    means = {r.c: r.p for r in model.transform(asked).groupBy("c").agg(F.avg("pred_tweedie").alias("p")).collect()}
    assert means == {"a": pytest.approx(10, rel=1e-3), "b": pytest.approx(100, rel=1e-3), None: pytest.approx(1, rel=1e-3)}
    assert model.transform(asked.withColumn("c", F.lit("unseen"))).where("pred_tweedie is null or pred_tweedie < 0").isEmpty()
    model.save(f"file://{tmp_path}/t")
    again = tweedie.TweedieModel.load(f"file://{tmp_path}/t")
    assert again.conf == conf and sorted(r.pred_tweedie for r in again.transform(asked).collect()) == sorted(r.pred_tweedie for r in model.transform(asked).collect())
    with pytest.raises(DataError, match="no positive"):
        tweedie.fit_tweedie(asked.where("false"), asked, conf)
    with pytest.raises(DataError, match="columns"):
        tweedie.fit_tweedie(asked, asked, tweedie.Tweedie(numeric=(), categories=("c",), max_columns=2))
    assert tweedie.split_features(asked.withColumn("horizon", F.lit(1)), ["horizon", "c", Y, "none"]) == ([Y], ["c"])
    with pytest.raises(DataError, match="usable"):
        tweedie.split_features(asked, ["none"])
