import datetime as dt

import pytest
from pyspark.sql import functions as F

from monsoon.functions import lunar
from monsoon.operators import baselines, features, panel, supervise

MONTHS = [dt.date(2025 + (7 + i) // 12, (7 + i) % 12 + 1, 1) for i in range(8)]
FIRST = [10.0, 0.0, None, 0.0, 20.0, 30.0, 0.0, 40.0]
SECOND = [5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0]


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [("S", b, m, y, y is not None, (y or 0) > 0, y is None, MONTHS[0], "3060", True) for b, ys in (("001", FIRST), ("002", SECOND)) for m, y in zip(MONTHS, ys, strict=True)]
    df = spark.createDataFrame(rows, "base_sku string, branch_code string, month date, actual_gross_m2 double, target_available boolean, actual_positive boolean, actual_negative_only boolean, first_observed_month date, tile_size_code string, base_current_active boolean")
    df = df.withColumns({"actual_observed": F.lit(True), "zero_semantics": F.lit("x"), "branch_current_active": F.col("branch_code") == "001"})
    return panel.lifecycle(df)


def at(df, branch, month):
    return df.where((F.col("branch_code") == branch) & (F.col("month") == F.lit(month))).first()


def test_lags_rolls_and_expanding(pairs):
    df = features.pair_features(pairs).persist()
    last = at(df, "001", MONTHS[7])
    assert (last.pair_lag_1, last.pair_lag_2, last.pair_lag_3, last.pair_lag_6) == (40.0, 0.0, 30.0, None)
    assert last.pair_roll_3_mean == pytest.approx(70 / 3) and last.pair_roll_6_target_available_count == 5 and last.pair_roll_6_coverage == pytest.approx(5 / 6)
    quiet = at(df, "001", MONTHS[6])
    assert (quiet.pair_peak_positive_m2_to_origin, quiet.pair_last_positive_m2_to_origin) == (30.0, 30.0) and quiet.pair_peak_share_to_origin == pytest.approx(0.5)
    assert quiet.pair_mean_positive_m2_to_origin == pytest.approx(20) and quiet.pair_adi_target_available_to_origin == pytest.approx(2) and quiet.pair_cv2_positive_to_origin == pytest.approx((1400 / 3 - 400) / 400)
    first = at(df, "001", MONTHS[0])
    assert first.pair_roll_3_std is None and first.pair_cv2_positive_to_origin is None and first.pair_history_length_months == 1


def test_cross_branch_and_masks(pairs):
    df = features.pair_origin_features(pairs)
    row = at(df, "001", MONTHS[0])
    assert (row.sku_known_branch_count_to_origin, row.sku_global_lag_1, row.cross_branch_penetration_to_origin, row.size_branch_lag_1) == (2, 15.0, 1.0, 10.0)
    assert row.current_production_forecast_mask and not at(df, "002", MONTHS[0]).current_production_forecast_mask
    assert "actual_gross_m2" not in df.columns


def test_horizons_look_ahead_and_masks_need_a_target(spark, pairs):
    origin = features.pair_origin_features(pairs, keep=tuple(supervise.PAIR_TARGETS))
    dev = supervise.pair_dev_panel(origin, panel.target_calendar(spark, 2025, 2026), "2025-12-01", "2025-12-01").persist()
    rows = {(r.branch_code, str(r.forecast_origin), r.horizon): r for r in dev.collect()}
    one = rows["001", "2025-08-01", 1]
    assert (one.target_actual_gross_m2, one.split_role, one.historical_train_mask, str(one.target_month)) == (0.0, "TRAIN", True, "2025-09-01")
    assert not rows["001", "2025-08-01", 2].historical_train_mask
    assert rows["001", "2025-12-01", 3].official_validation_mask and ("001", "2025-11-01", 2) not in rows
    assert all(r.feature_information_max_month <= r.forecast_origin for r in rows.values())


def test_lunar_anchors():
    assert [lunar.new_year(y) for y in (2024, 2025, 2026)] == [dt.date(2024, 2, 10), dt.date(2025, 1, 29), dt.date(2026, 2, 17)]
    assert [lunar.kings_day(y) for y in (2024, 2025, 2026)] == [dt.date(2024, 4, 18), dt.date(2025, 4, 7), dt.date(2026, 4, 26)]
    assert lunar.to_lunar(dt.date(2023, 4, 1)) == (11, 2, 2023, True)
    for year in range(1950, 2050):
        table = lunar.months(year, year)
        assert all(29 <= (b.start - a.start).days <= 30 for a, b in zip(table, table[1:], strict=False))


def test_target_calendar(spark):
    rows = {str(r.target_month): r for r in panel.target_calendar(spark, 2024, 2026).collect()}
    pick = lambda m: (rows[m].target_public_holiday_event_count, rows[m].target_statutory_holiday_nominal_days, rows[m].target_weekday_count, rows[m].target_working_days_proxy)
    assert pick("2024-04-01") == (2, 2, 22, 20) and pick("2025-01-01") == (2, 6, 23, 17)
    assert rows["2025-09-01"].target_statutory_holiday_nominal_days == 2 and rows["2025-09-01"].target_working_days_proxy == 20
    assert (rows["2026-05-01"].target_statutory_holiday_nominal_days, rows["2026-05-01"].target_working_days_proxy) == (1, 20)
    assert rows["2026-02-01"].target_days_to_next_tet_from_midmonth == 2 and rows["2026-01-01"].target_is_pre_tet_month and rows["2026-03-01"].target_is_post_tet_month


def fold(values, alpha=0.1, beta=0.1):
    """The recursions month by month."""
    n = since = 0
    z = p = c = None
    out = []
    for y in values:
        if y is not None:
            n, since = n + 1, since + 1
            if z is None:
                if y > 0:
                    z, p, c, since = y, float(n), 1.0 / n, 0
            else:
                c += beta * ((y > 0) - c)
                if y > 0:
                    z, p, since = z + alpha * (y - z), p + alpha * (since - p), 0
        out.append((0.0, 0.0) if z is None else ((1 - alpha / 2) * z / p, c * z))
    return out


@pytest.mark.parametrize("values", [[0, 0, 10, 0, 0, 20, 0], [0, 10, None, 0], [5, 0, None, None, 3, 2, 0, 0, 9], [0, 0], [None, 4, 4]])
def test_intermittent_states_equal_the_recursion(spark, values):
    rows = [("S", "B", dt.date(2020 + i // 12, i % 12 + 1, 1), None if y is None else float(y), y is not None) for i, y in enumerate(values)]
    df = spark.createDataFrame(rows, "base_sku string, branch_code string, month date, actual_gross_m2 double, target_available boolean")
    got = [(r.pred_croston_sba, r.pred_tsb) for r in baselines.intermittent_states(df).orderBy("month").collect()]
    assert got == [(pytest.approx(a), pytest.approx(b)) for a, b in fold(values)]
