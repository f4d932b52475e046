import datetime as dt

import pytest
from pyspark.sql import functions as F

from monsoon.operators import baselines, diagnose, gate, scores, select, supervise, validate
from monsoon.schema import DataError

KEYS = "base_sku string, branch_code string, forecast_origin date, horizon int, target_month date, target_actual_gross_m2 double"
D = dt.date


def test_soft_expected(spark):
    rows = [(0.1, 100.0), (0.7, 50.0), (1.2, 20.0), (-1.0, 30.0), (float("nan"), 40.0), (0.5, float("inf"))]
    got = [r[0] for r in spark.createDataFrame(rows, "p double, q double").select(baselines.soft_expected(F.col("p"), F.col("q"))).collect()]
    assert got == pytest.approx([10, 35, 20, 0, 0, 0])


def test_behaviour_segments(spark):
    df = spark.createDataFrame([(5, 1.1, 0.1), (5, 1.1, 0.9), (5, 2.0, 0.1), (1, 1.0, 0.0), (3, None, 0.1)], "pair_positive_count_to_origin bigint, pair_adi_target_available_to_origin double, pair_cv2_positive_to_origin double")
    assert [r[0] for r in df.select(gate.behaviour_segment()).collect()] == ["regular", "intermittent", "intermittent", "very_sparse", "very_sparse"]


def test_complete_windows_and_revision(spark):
    a = [("A", "1", D(2025, 1, 1), h, D(2025, 1 + h, 1), y, p) for h, y, p in ((1, 10.0, 11.0), (2, 20.0, 20.0), (3, 30.0, 30.0))]
    b = [("B", "1", D(2025, 1, 1), h, D(2025, 1 + h, 1), 1.0, 1.0) for h in (1, 2)]
    df = spark.createDataFrame(a + b, KEYS + ", pred_m double")
    whole = scores.complete_windows(df, ["pred_m"]).collect()
    assert [(r.base_sku, r.actual_3m_m2, r.pred_m_3m) for r in whole] == [("A", 60.0, 61.0)]
    assert scores.window_coverage(df).first().complete_windows == 1
    levels = {r.level: r.wape_3m for r in scores.cumulative(scores.complete_windows(df, ["pred_m"]), ["pred_m"]).collect()}
    assert levels == {k: pytest.approx(1 / 60) for k in scores.LEVELS}
    again = spark.createDataFrame([("A", "1", D(2025, 2, 1), 1, D(2025, 3, 1), 20.0, 5.0)], KEYS + ", pred_m double")
    rows = scores.revisions(df.unionByName(again), ["pred_m"])
    summary = {(r.level, r.transition): r for r in scores.revision_summary(rows).collect()}
    assert (summary["PAIR", "H2_TO_H1"].revision_mae, summary["PAIR", "H2_TO_H1"].signed_revision) == (15.0, -15.0)
    none = scores.revisions(df.where("false"), ["pred_m"])
    assert none.count() == 0 and [f.split()[0] for f in scores.REVISION_SCHEMA.split(", ")] == none.columns


def test_a_small_segment_takes_its_horizons_expert(spark):
    rows = [(1, "regular", 10.0, 10.0, 0.0)] * 5 + [(1, "very_sparse", 10.0, 0.0, 10.0)] * 2
    df = spark.createDataFrame(rows, "horizon int, segment string, target_actual_gross_m2 double, pred_a double, pred_b double")
    found = {r.segment: (r.expert, r.gate_source) for r in gate.gate(df, ["a", "b"], gate.Behaviour(min_rows=3)).collect()}
    assert found == {"regular": ("a", "SEGMENT_PRIMARY"), "very_sparse": ("a", "HORIZON_PRIMARY_FALLBACK")}
    gated = gate.apply_gate(df, gate.gate(df, ["a", "b"], gate.Behaviour(min_rows=1)), ["a", "b"])
    assert [r.pred_gated for r in gated.select("pred_gated").distinct().collect()] == [10.0]


def test_thresholds_can_give_exact_zeros_and_prefer_the_largest(spark):
    df = spark.createDataFrame([(1, 0.0, 0.3, 10.0), (1, 9.0, 0.9, 10.0)], "horizon int, target_actual_gross_m2 double, p_positive double, q_positive double")
    choice = gate.threshold_choice(gate.threshold_grid(df)).first()
    assert choice.threshold == 0.9 and choice.wape == 0 and choice.zero_false_positive_rate == 0


def test_demand_events_and_rounding(spark):
    rows = [(0.0, 3, 0, 10.0), (10.0, 0, None, None), (20.0, 2, 6, 10.0), (30.0, 2, 3, 10.0), (40.0, 2, 1, 10.0), (300.0, 3, 0, 100.0), (200.0, 3, 0, 100.0), (100.0, 3, 0, 100.0)]
    df = spark.createDataFrame(rows, "target_actual_gross_m2 double, pair_positive_count_to_origin bigint, months_since_last_positive int, pair_mean_positive_m2_to_origin double")
    assert [r[0] for r in df.select(diagnose.demand_event()).collect()] == ["actual_zero", "first_positive_known_pair", "reactivation_gap_6plus", "reactivation_gap_3_5", "reactivation_gap_1_2", "spike_3x_plus", "spike_2x_3x", "ongoing_positive"]
    values = spark.createDataFrame([(x,) for x in (0.1, 0.49, 0.5, 1.49, 1.5)], "x double")
    assert [r[0] for r in values.select(diagnose.rounded(F.col("x"), "round_nearest_1m2")).collect()] == [0, 0, 1, 1, 2]


def test_phases_are_honest(spark):
    rows = [("A", "1", D(2025, m, 1) if m else None, h, D(2025, m + h, 1), 1.0, True, m % 2 == 0, True) for m in range(1, 9) for h in (1, 2, 3)]
    df = spark.createDataFrame(rows, KEYS + ", target_available boolean, current_production_forecast_mask boolean, known_pair_asof_origin boolean")
    origins = spark.createDataFrame([(D(2025, 6, 1),)], "origin date")
    found = supervise.origin_phases(df, origins).collect()
    fit, cal, ev = ([r for r in found if r.phase == p] for p in ("FIT", "CAL", "EVAL"))
    assert max(r.target_month for r in fit) == D(2025, 3, 1) and {r.target_month for r in cal} <= {D(2025, m, 1) for m in (4, 5, 6)} and all(r.current_production_forecast_mask for r in cal)
    assert {(r.forecast_origin, r.horizon) for r in ev} == {(D(2025, 6, 1), h) for h in (1, 2, 3)}
    parts = supervise.fit_calibration(df, "2025-06-01")
    assert parts["FIT"].agg(F.max("target_month")).first()[0] == D(2025, 3, 1) and parts["CAL"].agg(F.min("target_month")).first()[0] == D(2025, 4, 1)
    assert [str(r.origin) for r in supervise.rolling_origins(spark, "2025-01-01", "2025-04-01", "2025-06-01").collect()] == ["2025-01-01", "2025-02-01"]


def test_universes_leave_out_the_inactive(spark):
    df = spark.createDataFrame([(False, True, True, i % 3 > 0, True) for i in range(30)], "historical_train_mask boolean, official_validation_mask boolean, target_available boolean, current_production_forecast_mask boolean, known_pair_asof_origin boolean")
    parts = supervise.universes(df)
    assert (parts["val_all"].count(), parts["val_primary"].count()) == (30, 20)
    with pytest.raises(DataError):
        supervise.universes(df, guard=True)


def test_alignment_raises(spark):
    a = spark.createDataFrame([("A", 1.0, 1.0), ("B", 2.0, 1.0)], "k string, target_actual_gross_m2 double, pred_a double")
    b = a.select("k", "target_actual_gross_m2", F.lit(3.0).alias("pred_b"))
    assert diagnose.align(a, b, ["k"], "pred_b").count() == 2
    with pytest.raises(DataError, match="rows"):
        diagnose.align(a, b.where("k = 'A'"), ["k"], "pred_b")
    with pytest.raises(DataError, match="actuals"):
        diagnose.align(a, b.withColumn("target_actual_gross_m2", F.lit(1.0)), ["k"], "pred_b")


def test_screen(spark):
    df = spark.createDataFrame([(i, float(i % 7) if i % 5 else None, 1.0, None if i else 1.0) for i in range(40)], "id int, a double, const double, sparse double").withColumn("b", F.col("a"))
    found = {r.feature_name: (r.static_status, r.duplicate_of) for r in select.static_screen(df, ["a", "b", "const", "sparse"], ["id"]).collect()}
    assert found == {"a": ("PASS_STATIC", None), "b": ("DROP_EXACT_DUPLICATE", "a"), "const": ("DROP_CONSTANT", None), "sparse": ("DROP_MISSING_RATE", None)}
    perm = spark.createDataFrame([("ALL", "horizon", -0.1), ("ALL", "x", 0.1), ("h1", "y", 0.01), ("ALL", "z", 0.0)], "scope string, feature_name string, importance_wape_mean double")
    reasons = {r.feature_name: r.reason for r in select.choose_features(perm, select.Screen(min_selected=1)).collect()}
    assert reasons == {"horizon": "MANDATORY_FOR_POOLED", "x": "PERMUTATION_IMPORTANCE", "y": "PERMUTATION_IMPORTANCE", "z": "NOT_SELECTED"}
    assert select.family_of("pair_lag_1", {"lag": ["pair_lag_"]}) == "lag"


def test_leaking_columns():
    assert validate.leaking(["pair_lag_1", "net_m2", "future_target"], parts=("target",)) == ["future_target", "net_m2"]


def test_models_by_horizon_are_saved_and_loaded(spark, tmp_path):
    from monsoon.operators import ml

    # demand is 10 x horizon for pairs with a positive last month, none for others
    rows = [(f"p{i}", h, phase, float(i % 2), 10.0 * h * (i % 2), D(2025, 1, 1)) for i in range(120) for h in (1, 2, 3) for phase in ("FIT", "CAL")]
    df = spark.createDataFrame(rows, "base_sku string, horizon int, phase string, pair_lag_1 double, target_actual_gross_m2 double, target_month date")
    conf = ml.TwoPart(features=("pair_lag_1",), max_trees=3, depth=2, min_fit_positive=10, min_cal_positive=10)
    models = ml.fit_horizons(df.where("phase = 'FIT'"), df.where("phase = 'CAL'"), conf=conf)
    models.save(f"file://{tmp_path}/m")
    again = ml.HorizonModels.load(f"file://{tmp_path}/m", (1, 2, 3))
    asked = df.where("phase = 'CAL'")
    one, two = (sorted((r.base_sku, r.horizon, r.p_positive, r.q_positive, r.pred_two_part) for r in m.transform(asked).collect()) for m in (models, again))
    assert one == two and again.models[2].conf == conf and again.models[2].audit == models.models[2].audit
    for sku, h, p, q, forecast in one:
        assert forecast == pytest.approx(p * q) and q == pytest.approx(10 * h, rel=1e-3) and (p > 0.7) == (int(sku[1:]) % 2 == 1)
    assert models.audit(spark).count() == 3
    with pytest.raises(DataError, match="too few"):
        ml.fit_horizons(df.where("phase = 'FIT'"), df.where("false"), conf=conf)


def test_capped_samples_are_exact_and_in_proportion(spark):
    rows = [(i, "a" if i % 3 else "b" if i % 2 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, s string")
    got = select.capped_sample(df, ["s"], ["k"], 100)
    assert got.columns == ["k", "s"] and sorted((r.s or "", r["count"]) for r in got.groupBy("s").count().collect()) == [("", 17), ("a", 67), ("b", 16)]
    assert sorted(r.k for r in got.collect()) == sorted(r.k for r in select.capped_sample(df.repartition(7), ["s"], ["k"], 100).collect())
    assert select.capped_sample(df, ["s"], ["k"], 5000).count() == 3000 and select.capped_sample(df.where("false"), ["s"], ["k"], 5).count() == 0


def test_a_segment_only_uses_its_own_experts(spark):
    rows = [(1, s, 10.0, 10.0, 4.0) for s in ("regular", "very_sparse") for _ in range(5)]
    df = spark.createDataFrame(rows, "horizon int, segment string, target_actual_gross_m2 double, pred_a double, pred_b double")
    found = gate.gate(df, ["a", "b"], gate.Behaviour(min_rows=3), allowed={"regular": ("a", "b"), "very_sparse": ("b",)})
    assert {r.segment: r.expert for r in found.collect()} == {"regular": "a", "very_sparse": "b"}
