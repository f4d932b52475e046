"""All queries of the demand engine over the driver's tables, with their DuckDB texts."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from monsoon import oracle
from monsoon.functions import metrics
from monsoon.operators import boost, panel
from monsoon.plans.stages import TARGETS, Demand
from monsoon.schema import PAIR
from monsoon.sources import digests
from monsoon.sources.stored import shared_dir, store


@dataclass(frozen=True)
class Query:
    run: Callable[[Demand], DataFrame]
    #: The last SELECT over oracle.CTES; None where SQL can't express the query.
    sql: str | None = None
    #: Doubles that are compared to six places.
    close: tuple[str, ...] = ()


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None, close: tuple[str, ...] = ()) -> Callable:
    def put(run: Callable[[Demand], DataFrame]) -> Callable[[Demand], DataFrame]:
        CATALOG[name] = Query(run, sql, close)
        return run

    return put


def _rounded(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, DoubleType)] if columns == ("*",) else columns
    # the shift keeps short decimals, which lie half way, from falling to either side
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in names}) if names else df


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: _rounded(q.run(Demand(spark, sf_dir)), q.close)

    return {name: bind(q) for name, q in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle.rounded(q.sql, list(q.close)) if q.close else oracle.sql(q.sql) for name, q in CATALOG.items() if q.sql}


AMOUNT = ("total_amount_audit",)

query("master_sku", "SELECT * FROM master_sku")(lambda d: d.sources.master_sku)
query("master_channel", "SELECT * FROM master_channel")(lambda d: d.sources.master_channel)
query("sales_monthly", "SELECT * FROM sales", ("total_amount",))(lambda d: d.sources.sales)
query("bridge", "SELECT *, modeling_exclusion_reason = 'ELIGIBLE' AS modeling_universe_valid FROM bridge")(lambda d: d.bridge)
query("dim_base", "SELECT * FROM dim_base")(lambda d: d.dim_base)
query("dim_branch", "SELECT * FROM dim_branch")(lambda d: d.dim_branch)
query("bravo_observation", "SELECT * FROM obs", AMOUNT)(lambda d: d.observation)
query("fact", "SELECT * FROM fact", AMOUNT)(lambda d: d.fact)

_PANEL = [
    *PAIR, "month", "first_observed_month", "source_row_observed", "gross_positive_m2", "negative_m2", "net_m2", "total_amount_audit", "source_line_count", "observed_source_row_count", "observed_bravo_count",
    "actual_observed", "actual_positive", "actual_explicit_zero", "actual_negative_only", "target_available", "actual_gross_m2", "zero_semantics", "observation_status", "tile_size_code", "base_current_active", "region", "branch_brand", "branch_current_active",
]
_LIFE = [
    *PAIR, "month", "first_positive_month_to_date", "last_positive_month_to_date", "observed_month_count_to_date", "positive_month_count_to_date", "months_since_first_observed", "months_since_first_positive", "months_since_last_observed",
    "months_since_last_positive",
]
query("pair_panel", f"SELECT {', '.join(_PANEL)} FROM pair_panel", AMOUNT)(lambda d: d.pair_panel.select(_PANEL))
query("pair_lifecycle", f"SELECT {', '.join(_LIFE)} FROM pair_panel")(lambda d: d.pair_panel.select(_LIFE))
query("positive_events", "SELECT base_sku, branch_code, month, positive_pair, new_positive_pair, reactivated_pair, positive_gap_months FROM events")(
    lambda d: panel.positive_events(d.fact).select(*PAIR, "month", "positive_pair", "new_positive_pair", "reactivated_pair", "positive_gap_months")
)
query("branch_month", "SELECT * FROM branch_month", panel.SHARES)(lambda d: panel.branch_month(d.fact))
query("branch_panel", "SELECT * FROM branch_panel", panel.SHARES)(lambda d: d.branch_panel)
query("calendar", "SELECT m::DATE AS month, month(m)::INTEGER AS month_num, quarter(m)::INTEGER AS quarter, year(m)::INTEGER AS year, day(last_day(m))::INTEGER AS days_in_month FROM unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-11-01', INTERVAL 1 MONTH)) r(m)")(
    lambda d: panel.calendar(d.spark, d.calendar.start, d.calendar.panel_end)
)
query("target_calendar", "SELECT * FROM target_calendar", ("target_month_sin", "target_month_cos", "target_lunar_month_sin", "target_lunar_month_cos"))(lambda d: d.target_calendar)

# ---- features

_ROLLED = [f"pair_roll_{w}_{op}" for w in (3, 6, 12) for op in ("mean", "sum", "std", "coverage")]
_EXPANDED = ["pair_positive_rate_to_origin", "pair_mean_positive_m2_to_origin", "pair_peak_share_to_origin", "pair_adi_target_available_to_origin", "pair_cv2_positive_to_origin"]
_LAGGED = [f"pair_lag_{n}" for n in (1, 2, 3, 6, 12)]
_COUNTED = [f"pair_roll_{w}_{c}_count" for w in (3, 6, 12) for c in ("target_available", "positive", "calendar")]
_WHOLE = ["pair_history_length_months", "pair_target_available_count_to_origin", "pair_observed_source_month_count_to_origin", "pair_positive_count_to_origin", "pair_last_positive_m2_to_origin", "pair_peak_positive_m2_to_origin"]


def _features(name: str, columns: list[str], close: list[str]) -> None:
    from monsoon.operators import features

    keys = [*PAIR, "month"]
    query(name, f"SELECT {', '.join(keys + columns)} FROM pair_f", tuple(close))(lambda d: features.pair_features(d.pair_panel).select(*keys, *columns))


_features("pair_lags", _LAGGED, [])
_features("pair_rolling", _ROLLED + _COUNTED, _ROLLED)
_features("pair_expanding", _WHOLE + _EXPANDED, _EXPANDED)


def _more_features() -> None:
    from monsoon.operators import features

    sku = tuple(f"sku_global_roll_{w}_{op}" for w in (3, 6, 12) for op in ("mean", "sum")) + ("sku_global_positive_rate_12m", "cross_branch_penetration_to_origin")
    query("sku_features", "SELECT * FROM sku_f", sku)(lambda d: features.sku_features(d.pair_panel))
    query("size_features", "SELECT * FROM size_f", tuple(f"size_branch_roll_{w}_mean" for w in (3, 6, 12)))(lambda d: features.size_features(d.pair_panel))
    branch = [f"branch_roll_{w}_{op}" for w in (3, 6, 12) for op in ("mean", "sum", "std", "coverage")] + [
        "branch_positive_rate_to_origin", "branch_average_m2_per_positive_pair_lag_1", "branch_positive_pair_count_roll_3_mean", "branch_new_positive_pair_count_roll_3_mean", *[f"branch_pair_{x}_lag_1" for x in ("top1_share", "top5_share", "top10_share", "hhi")]]
    query("branch_features", "SELECT * FROM branch_f", tuple(branch))(lambda d: d.branch_origin)


_more_features()

# ---- supervision, baselines and scores


def _evaluation() -> None:
    from monsoon.operators import baselines, diagnose, gate, scores, supervise
    from monsoon.oracle import EXPERTS, METRICS, P0, PREDS, diagnosis
    from monsoon.oracle import gate as gate_sql

    metrics = ("wape", "mae", "bias", "bias_ratio", "zero_false_positive_rate", "positive_wape")
    long_keys = ["base_sku", "branch_code", "forecast_origin", "target_month", "horizon", "segment", "event", scores.Y]

    def long(d: Demand) -> DataFrame:
        return scores.melt(d.evaluation, long_keys, PREDS)

    # the flagship: a moving average's errors by horizon, over all rows with a target
    query(
        "flagship_ma3_wape",
        f"SELECT horizon, {METRICS} FROM (SELECT horizon, target_actual_gross_m2 AS y, pred_ma_3 AS pred FROM roll WHERE target_available) GROUP BY 1", metrics,
    )(lambda d: d.rolling.where("target_available").groupBy("horizon").agg(*scores.metric_row(F.col(scores.Y), F.col("pred_ma_3"))))

    dev_keys = [*PAIR, "forecast_origin", "target_month", "horizon"]
    dev_sql = """
      SELECT f.base_sku, f.branch_code, f.month AS forecast_origin, (f.month + h * INTERVAL 1 MONTH)::DATE AS target_month, h::INTEGER AS horizon, t.actual_gross_m2 AS target_actual_gross_m2, t.actual_positive AS target_actual_positive,
        t.actual_negative_only AS target_actual_negative_only, t.target_available, t.zero_semantics AS target_zero_semantics, CASE WHEN f.month + h * INTERVAL 1 MONTH <= DATE '2001-08-01' THEN 'TRAIN' ELSE 'OFFICIAL_VALIDATION' END AS split_role,
        coalesce(f.base_current_active AND f.branch_current_active, false) AS current_production_forecast_mask, 'h' || h AS horizon_label, c.target_working_days_proxy, c.target_is_tet_month, f.pair_lag_1, s.sku_global_lag_1, z.size_branch_lag_1, f.tile_size_code, f.brand AS brand_snapshot
      FROM pair_f f CROSS JOIN (VALUES (1), (2), (3)) x(h) LEFT JOIN pair_panel t ON t.base_sku = f.base_sku AND t.branch_code = f.branch_code AND t.month = (f.month + h * INTERVAL 1 MONTH)::DATE
      LEFT JOIN sku_f s ON s.base_sku = f.base_sku AND s.month = f.month LEFT JOIN size_f z ON z.branch_code = f.branch_code AND z.tile_size_code = f.tile_size_code AND z.month = f.month
      LEFT JOIN target_calendar c ON c.target_month = (f.month + h * INTERVAL 1 MONTH)::DATE
      WHERE f.month <= DATE '2001-08-01' AND (f.month + h * INTERVAL 1 MONTH <= DATE '2001-08-01' OR f.month = DATE '2001-08-01')"""
    dev_cols = [*dev_keys, *supervise.PAIR_TARGETS.values(), "split_role", "current_production_forecast_mask", "horizon_label", "target_working_days_proxy", "target_is_tet_month", "pair_lag_1", "sku_global_lag_1", "size_branch_lag_1", "tile_size_code", "brand_snapshot"]
    query("pair_dev_panel", dev_sql)(lambda d: d.pair_dev.select(dev_cols))
    query("split_counts", f"SELECT split_role, horizon, count(*) AS n_rows, count(*) FILTER (target_available) AS n_available, min(target_month) AS min_target, max(target_month) AS max_target FROM ({dev_sql}) GROUP BY ALL")(
        lambda d: d.pair_dev.groupBy("split_role", "horizon").agg(F.count("*").alias("n_rows"), F.count_if("target_available").alias("n_available"), F.min("target_month").alias("min_target"), F.max("target_month").alias("max_target"))
    )
    query("universes", f"""SELECT split_role AS universe, count(*) AS n_rows, count(*) FILTER (current_production_forecast_mask) AS n_current FROM ({dev_sql}) WHERE target_available GROUP BY 1""")(
        lambda d: supervise.universes(d.pair_dev)["train"].unionByName(supervise.universes(d.pair_dev)["val_all"]).groupBy(F.col("split_role").alias("universe")).agg(F.count("*").alias("n_rows"), F.count_if("current_production_forecast_mask").alias("n_current"))
    )
    query(
        "branch_dev_panel",
        """SELECT f.branch_code, f.month AS forecast_origin, (f.month + h * INTERVAL 1 MONTH)::DATE AS target_month, h::INTEGER AS horizon, t.branch_gross_m2 AS target_branch_gross_m2, t.branch_observed AS target_branch_observed, t.branch_positive AS target_branch_positive,
          CASE WHEN f.month + h * INTERVAL 1 MONTH <= DATE '2001-08-01' THEN 'TRAIN' ELSE 'OFFICIAL_VALIDATION' END AS split_role, f.branch_lag_12, f.branch_history_length_months
        FROM branch_f f CROSS JOIN (VALUES (1), (2), (3)) x(h) LEFT JOIN branch_panel t ON t.branch_code = f.branch_code AND t.month = (f.month + h * INTERVAL 1 MONTH)::DATE
        WHERE f.month <= DATE '2001-08-01' AND (f.month + h * INTERVAL 1 MONTH <= DATE '2001-08-01' OR f.month = DATE '2001-08-01')""",
    )(lambda d: d.branch_dev.select("branch_code", "forecast_origin", "target_month", "horizon", *supervise.BRANCH_TARGETS.values(), "split_role", "branch_lag_12", "branch_history_length_months"))
    query("rolling_origins", "SELECT origin FROM origins")(lambda d: d.origins)
    query("origin_split_audit", "SELECT origin, phase, horizon, count(*) AS n_rows, min(target_month) AS min_target, max(target_month) AS max_target FROM phases GROUP BY ALL")(lambda d: supervise.split_audit(d.phases))
    query("fit_calibration_split", """SELECT CASE WHEN target_month < DATE '2001-06-01' THEN 'FIT' ELSE 'CAL' END AS phase, horizon, count(*) AS n_rows, max(target_month) AS max_target FROM roll
        WHERE target_month <= DATE '2001-08-01' AND target_available AND (target_month < DATE '2001-06-01' OR is_primary) GROUP BY ALL""")(
        lambda d: _phase_counts(supervise.fit_calibration(d.rolling, d.calendar.validation_origin))
    )
    query("prospective_frames", """SELECT f.base_sku, f.branch_code, f.month AS forecast_origin, h::INTEGER AS horizon, (f.month + h * INTERVAL 1 MONTH)::DATE AS target_month, pair_lag_1 FROM pair_f f, (VALUES (1), (2), (3)) x(h)
        WHERE f.month = DATE '2001-11-01' AND base_current_active AND branch_current_active""")(
        lambda d: supervise.prospective(d.pair_origin, d.target_calendar, d.calendar.panel_end).select(*PAIR, "forecast_origin", "horizon", "target_month", "pair_lag_1")
    )
    query("croston_tsb_state", "SELECT * FROM states", ("pred_croston_sba", "pred_tsb"))(lambda d: d.states)
    query("intermittent_baselines", "SELECT base_sku, branch_code, forecast_origin, horizon, pred_croston_sba, pred_tsb FROM ev", ("pred_croston_sba", "pred_tsb"))(
        lambda d: d.evaluation.select(*PAIR, "forecast_origin", "horizon", "pred_croston_sba", "pred_tsb")
    )
    query("soft_expected", "SELECT base_sku, branch_code, forecast_origin, horizon, p_positive, q_positive, pred_soft FROM ev", ("p_positive", "q_positive", "pred_soft"))(
        lambda d: d.evaluation.select(*PAIR, "forecast_origin", "horizon", "p_positive", "q_positive", "pred_soft")
    )
    query("behavior_segment", "SELECT base_sku, branch_code, forecast_origin, horizon, segment FROM ev")(lambda d: d.evaluation.select(*PAIR, "forecast_origin", "horizon", "segment"))
    query("demand_event", "SELECT base_sku, branch_code, forecast_origin, horizon, event FROM ev")(lambda d: d.evaluation.select(*PAIR, "forecast_origin", "horizon", "event"))
    query("baseline_scoreboard", f"SELECT model, horizon, segment, {METRICS} FROM long GROUP BY GROUPING SETS ((model), (model, horizon), (model, segment))", metrics)(lambda d: scores.scoreboard(long(d)))
    query("by_origin", f"SELECT forecast_origin, model, horizon, {METRICS} FROM long GROUP BY GROUPING SETS ((forecast_origin, model), (forecast_origin, model, horizon))", metrics)(lambda d: scores.by_origin(long(d)))
    query("branch_aggregate_wape", "SELECT model, sum(abs(y - p)) / nullif(sum(y), 0) AS branch_wape FROM (SELECT model, branch_code, target_month, sum(y) AS y, sum(pred) AS p FROM long GROUP BY 1, 2, 3) GROUP BY 1", ("branch_wape",))(
        lambda d: scores.branch_aggregate(long(d))
    )
    sums = ", ".join(f"sum({p}) AS {p}_3m" for p in PREDS)
    windows = f"SELECT base_sku, branch_code, forecast_origin, sum(target_actual_gross_m2) AS actual_3m_m2, {sums} FROM ev GROUP BY 1, 2, 3 HAVING count(*) = 3 AND count(DISTINCT horizon) = 3"
    query("complete_3m", windows, tuple(f"{p}_3m" for p in PREDS))(lambda d: scores.complete_windows(d.evaluation, PREDS))
    query("window_coverage", "SELECT count(*) AS total_windows, count(*) FILTER (n = 3) AS complete_windows, count(*) FILTER (n <> 3) AS incomplete_windows, avg((n = 3)::INT) AS complete_rate FROM (SELECT count(*) AS n FROM ev GROUP BY base_sku, branch_code, forecast_origin)", ("complete_rate",))(
        lambda d: scores.window_coverage(d.evaluation)
    )
    w_long = f"UNPIVOT (SELECT base_sku, branch_code, forecast_origin, actual_3m_m2 AS y, {', '.join(f'pred_{e}_3m AS {e}' for e in EXPERTS)} FROM ({windows})) ON {', '.join(EXPERTS)} INTO NAME model VALUE p"
    levels = {"PAIR": "base_sku, branch_code, forecast_origin", "BASE_SKU": "base_sku, forecast_origin", "BRANCH": "branch_code, forecast_origin", "PORTFOLIO": "forecast_origin"}
    rolled = " UNION ALL ".join(f"SELECT '{n}' AS level, forecast_origin, model, sum(y) AS y, sum(p) AS p FROM ({w_long}) GROUP BY {k}, model" for n, k in levels.items())
    w_metrics = "count(*) AS n_rows, sum(abs(y - p)) / nullif(sum(abs(y)), 0) AS wape_3m, avg(abs(y - p)) AS mae_3m, sum(p - y) AS bias_3m, sum(p - y) / nullif(sum(abs(y)), 0) AS bias_ratio_3m, sum(y) AS actual_sum, sum(p) AS forecast_sum"
    w_close = ("wape_3m", "mae_3m", "bias_3m", "bias_ratio_3m", "forecast_sum")
    query("cumulative_3m", f"SELECT level, model, {w_metrics} FROM ({rolled}) GROUP BY 1, 2", w_close)(lambda d: scores.cumulative(scores.complete_windows(d.evaluation, PREDS), PREDS))
    query("cumulative_3m_by_origin", f"SELECT level, model, forecast_origin, {w_metrics} FROM ({rolled}) GROUP BY 1, 2, 3", w_close)(lambda d: scores.cumulative(scores.complete_windows(d.evaluation, PREDS), PREDS, True))
    revised = """SELECT base_sku, branch_code, target_month, 'H' || horizon || '_TO_H' || h AS transition, model, pred AS old_pred, p AS new_pred, p - pred AS revision
      FROM (SELECT *, lead(pred) OVER w AS p, lead(horizon) OVER w AS h FROM long WINDOW w AS (PARTITION BY base_sku, branch_code, target_month, model ORDER BY horizon DESC)) WHERE h = horizon - 1"""
    query("revision_detail", revised, ("old_pred", "new_pred", "revision"))(lambda d: scores.revisions(d.evaluation, PREDS))
    r_metrics = "count(*) AS n_rows, avg(abs(revision)) AS revision_mae, sum(abs(revision)) / nullif(sum(abs(old_pred)), 0) AS revision_ratio, sum(revision) AS signed_revision"
    query(
        "revision", f"""WITH r AS ({revised}) SELECT 'PAIR' AS level, transition, model, {r_metrics} FROM r GROUP BY ALL UNION ALL
          SELECT 'BASE_SKU', transition, model, {r_metrics} FROM (SELECT base_sku, target_month, transition, model, sum(old_pred) AS old_pred, sum(revision) AS revision FROM r GROUP BY ALL) GROUP BY ALL""",
        ("revision_mae", "revision_ratio", "signed_revision"),
    )(lambda d: scores.revision_summary(scores.revisions(d.evaluation, PREDS)))
    query(
        "stability", f"""WITH o AS (SELECT forecast_origin, model, {METRICS} FROM long GROUP BY 1, 2), w AS (SELECT *, row_number() OVER (PARTITION BY forecast_origin ORDER BY wape NULLS LAST, model) = 1 AS win FROM o),
          c AS (SELECT level, model, {w_metrics} FROM ({rolled}) GROUP BY 1, 2)
          SELECT w.model, count(*) AS n_origins, avg(wape) AS mean_wape, median(wape) AS median_wape, stddev_pop(wape) AS std_wape, avg(abs(bias_ratio)) AS mean_abs_bias, max(abs(bias_ratio)) AS max_abs_bias, avg((bias_ratio < 0)::INT) AS under_forecast_rate,
            count(*) FILTER (win) AS wins, any_value(p.wape_3m) AS wape_3m_pair, any_value(b.wape_3m) AS wape_3m_base_sku
          FROM w LEFT JOIN c p ON p.model = w.model AND p.level = 'PAIR' LEFT JOIN c b ON b.model = w.model AND b.level = 'BASE_SKU' GROUP BY 1""",
        ("mean_wape", "median_wape", "std_wape", "mean_abs_bias", "max_abs_bias", "under_forecast_rate", "wape_3m_pair", "wape_3m_base_sku"),
    )(lambda d: scores.stability(scores.by_origin(long(d)), scores.cumulative(scores.complete_windows(d.evaluation, PREDS), PREDS)))

    # gates and thresholds
    query("gate_validation", gate_sql("long", "", 50, gate.ALLOWED, (gate.SEGMENT, gate.SEGMENT_FALLBACK)))(lambda d: gate.gate(d.evaluation, EXPERTS, allowed=gate.ALLOWED))
    by_origin = gate_sql("cal_long", "origin, ", 100, gate.CALIBRATION_ALLOWED, (gate.CALIBRATION, gate.CALIBRATION_FALLBACK))
    query("gate_calibration", by_origin)(lambda d: d.calibration_choices)
    query("gate_choice_frequency", f"SELECT horizon, segment, expert, count(*) AS n_origins FROM ({by_origin}) GROUP BY ALL")(lambda d: gate.choice_frequency(d.calibration_choices))
    query(
        "gated_scores", f"SELECT horizon, {METRICS} FROM (SELECT l.horizon, l.y, l.pred FROM long l JOIN ({by_origin}) g ON g.origin = l.forecast_origin AND g.horizon = l.horizon AND g.segment = l.segment AND g.expert = l.model) GROUP BY 1", metrics,
    )(lambda d: gate.apply_gate(supervise.origin_phases(d.rolling, d.origins, ["EVAL"]), d.calibration_choices, EXPERTS, ["origin"]).groupBy("horizon").agg(*scores.metric_row(F.col(scores.Y), F.col("pred_gated"))))
    hurdle = "CASE WHEN p_positive < threshold THEN 0 ELSE p_positive * q_positive END"
    grid = f"""SELECT horizon, threshold, sum(abs(y - pred)) / nullif(sum(y), 0) AS wape, avg(CASE WHEN y <= 1e-9 THEN (pred > 1e-9)::INT END) AS zero_false_positive_rate
      FROM (SELECT horizon, threshold, target_actual_gross_m2 AS y, {hurdle} AS pred FROM ev, (SELECT unnest([{', '.join(str(round(0.05 * i, 2)) for i in range(20))}]::DOUBLE[]) AS threshold)) GROUP BY 1, 2"""
    query("threshold_grid", grid, ("wape", "zero_false_positive_rate"))(lambda d: gate.threshold_grid(d.evaluation))
    query("threshold_choice", f"""WITH g AS ({grid}) SELECT horizon, threshold, wape, zero_false_positive_rate FROM (SELECT g.*, row_number() OVER (PARTITION BY horizon ORDER BY zero_false_positive_rate NULLS LAST, threshold DESC) AS n
        FROM g JOIN (SELECT horizon, min(wape) AS least FROM g GROUP BY 1) USING (horizon) WHERE wape <= least + 1e-9) WHERE n = 1""", ("wape", "zero_false_positive_rate"))(
        lambda d: gate.threshold_choice(gate.threshold_grid(d.evaluation))
    )

    # diagnosis
    e_metrics = diagnosis("coalesce(target_actual_gross_m2, 0)", "greatest(coalesce(pred_soft, 0), 0)")
    e_close = ("forecast_sum", "wape", "mae", "bias", "bias_ratio", "underforecast_sum", "overforecast_sum")
    cube = " UNION ALL ".join(
        f"SELECT '{n}' AS level, {h} AS horizon, {s} AS segment, {e} AS event, {e_metrics} FROM ev GROUP BY ALL"
        for n, h, s, e in (("OVERALL", "NULL::INTEGER", "NULL::VARCHAR", "NULL::VARCHAR"), ("HORIZON", "horizon", "NULL", "NULL"), ("BEHAVIOR", "NULL", "segment", "NULL"), ("EVENT", "NULL", "NULL", "event"), ("EVENT_HORIZON", "horizon", "NULL", "event"))
    )
    query("diagnosis", f"""WITH c AS ({cube}) SELECT c.*, actual_sum / nullif((SELECT actual_sum FROM c WHERE level = 'OVERALL'), 0) AS share_of_total_actual,
        underforecast_sum / nullif((SELECT underforecast_sum FROM c WHERE level = 'OVERALL'), 0) AS share_of_total_underforecast FROM c""", (*e_close, "share_of_total_actual", "share_of_total_underforecast"))(lambda d: diagnose.diagnosis(d.evaluation, "pred_soft"))
    query("origin_event", f"SELECT forecast_origin, event, {e_metrics} FROM ev GROUP BY 1, 2", e_close)(lambda d: diagnose.origin_events(d.evaluation, "pred_soft"))
    value = "CASE policy WHEN 'raw' THEN {0} WHEN 'round_nearest_1m2' THEN floor({0} + 0.5) ELSE ceil({0}) END"
    months = f"SELECT base_sku, branch_code, forecast_origin, horizon, target_actual_gross_m2 AS y, pred_soft AS raw, policy, {value.format('pred_soft')} AS v FROM ev, (VALUES ('raw'), ('round_nearest_1m2'), ('ceil_1m2')) x(policy)"
    query("rounding_month", f"SELECT policy, {diagnosis('y', 'v')}, sum(v - raw) AS added_m2, avg((abs(v - raw) > 1e-9)::INT) AS changed_row_rate, avg((raw > 0 AND raw < 1)::INT) AS raw_between_0_and_1_rate FROM ({months}) GROUP BY 1", (*e_close, "added_m2", "changed_row_rate", "raw_between_0_and_1_rate"))(
        lambda d: diagnose.rounding_months(d.evaluation, "pred_soft")
    )
    full = f"SELECT * FROM ({months}) QUALIFY count(*) OVER (PARTITION BY base_sku, branch_code, forecast_origin, policy) = 3"
    before = " UNION ALL ".join(f"SELECT 'BEFORE' AS stage, '{n}' AS level, policy, sum(y) AS y, sum(v) AS v FROM m GROUP BY {k}, policy" for n, k in levels.items())
    after = " UNION ALL ".join(f"SELECT 'AFTER' AS stage, '{n}' AS level, policy, y, {value.format('x')} AS v FROM (SELECT sum(y) AS y, sum(raw) AS x FROM m WHERE policy = 'raw' GROUP BY {k}), (VALUES ('round_nearest_1m2'), ('ceil_1m2')) p(policy)" for n, k in levels.items())
    query("rounding_3m", f"WITH m AS ({full}) SELECT stage, level, policy, {diagnosis('y', 'v')} FROM ({before} UNION ALL {after}) GROUP BY 1, 2, 3", e_close)(lambda d: diagnose.rounding_windows(d.evaluation, "pred_soft"))
    actual = "SELECT target_actual_gross_m2 AS y FROM ev WHERE target_actual_gross_m2 > 0"
    grids = ", ".join(f"avg((abs(y / {step} - round_even(y / {step}, 0)) <= 1e-8 + 1e-5 * abs(round_even(y / {step}, 0)))::INT) AS {name}" for name, step in diagnose.STEPS.items())
    quantiles = ", ".join(f"quantile_cont(y, {q}) AS {name}" for name, q in diagnose.QUANTILES.items())
    query("granularity", f"SELECT count(*) AS n_positive_actual_rows, sum(y) AS actual_sum_m2, {grids}, min(y) AS min_positive_m2, {quantiles} FROM ({actual})", ("actual_sum_m2", *diagnose.STEPS, "min_positive_m2", *diagnose.QUANTILES))(
        lambda d: diagnose.granularity(d.evaluation)
    )
    query("fraction_freq", f"SELECT fractional_part_3dp, n_rows, n_rows / (SELECT count(*) FROM ({actual})) AS row_rate FROM (SELECT round(y - floor(y), 3) AS fractional_part_3dp, count(*) AS n_rows FROM ({actual}) GROUP BY 1) ORDER BY n_rows DESC, fractional_part_3dp LIMIT 50", ("row_rate",))(
        lambda d: diagnose.fractions(d.evaluation)
    )
    query(
        "zero_positive", f"""SELECT model, horizon, count(*) AS n_rows, count(*) FILTER (y = 0) AS n_zero, count(*) FILTER (y > 0) AS n_positive, avg({P0}) FILTER (y = 0) AS mean_pred_on_zero, sum({P0}) FILTER (y = 0) AS forecast_on_zero,
          avg(({P0} > 1e-9)::INT) FILTER (y = 0) AS zero_false_positive_rate, avg(({P0} >= 1)::INT) FILTER (y = 0) AS zero_pred_ge_1_rate, avg({P0}) FILTER (y > 0) AS mean_pred_on_positive, avg(({P0} <= 1e-9)::INT) FILTER (y > 0) AS positive_missed_rate,
          sum(abs(y - {P0})) FILTER (y > 0) / nullif(sum(y) FILTER (y > 0), 0) AS positive_wape, sum({P0} - y) FILTER (y > 0) AS positive_bias, sum({P0} - y) FILTER (y > 0) / nullif(sum(y) FILTER (y > 0), 0) AS positive_bias_ratio
          FROM long GROUP BY GROUPING SETS ((model), (model, horizon))""",
        ("mean_pred_on_zero", "forecast_on_zero", "zero_false_positive_rate", "zero_pred_ge_1_rate", "mean_pred_on_positive", "positive_missed_rate", "positive_wape", "positive_bias", "positive_bias_ratio"),
    )(lambda d: diagnose.zero_positive(long(d)))
    query(
        "probability_diag", """SELECT horizon, count(*) AS n_rows, avg((y > 0)::INT) AS positive_rate, avg(p) AS mean_p, avg(p) FILTER (y > 0) AS mean_p_positive, avg(p) FILTER (NOT y > 0) AS mean_p_zero, avg((p - (y > 0)::INT) * (p - (y > 0)::INT)) AS brier,
          sum(abs(y - q)) FILTER (y > 0) / nullif(sum(y) FILTER (y > 0), 0) AS q_wape_positive, sum(q - y) FILTER (y > 0) / nullif(sum(y) FILTER (y > 0), 0) AS q_bias_ratio_positive
          FROM (SELECT horizon, target_actual_gross_m2 AS y, p_positive AS p, q_positive AS q FROM ev) GROUP BY GROUPING SETS ((), (horizon))""",
        ("positive_rate", "mean_p", "mean_p_positive", "mean_p_zero", "brier", "q_wape_positive", "q_bias_ratio_positive"),
    )(lambda d: diagnose.probability(d.evaluation))
    query("universe_scores", f"""WITH v AS (SELECT h AS horizon, t.actual_gross_m2 AS y, (coalesce(pair_lag_1, 0) + coalesce(pair_lag_2, 0) + coalesce(pair_lag_3, 0)) / 3 AS pred, coalesce(f.base_current_active AND f.branch_current_active, false) AS main
        FROM pair_f f, (VALUES (1), (2), (3)) x(h), pair_panel t WHERE f.month = DATE '2001-08-01' AND t.base_sku = f.base_sku AND t.branch_code = f.branch_code AND t.month = (f.month + h * INTERVAL 1 MONTH)::DATE AND t.target_available),
      u AS (SELECT *, 'val_all' AS universe FROM v UNION ALL SELECT *, 'val_primary' FROM v WHERE main) SELECT universe, horizon, {METRICS} FROM u GROUP BY GROUPING SETS ((universe), (universe, horizon))""", metrics)(
        lambda d: scores.by_universe(supervise.universes(d.pair_dev, guard=True)["val_all"], baselines.simple_baselines()["pred_ma_3"], supervise.primary())
    )
    own = [*_LAGGED, *_ROLLED, *_COUNTED, *_WHOLE, *_EXPANDED]
    train = "SELECT f.*, h AS horizon, (f.month + h * INTERVAL 1 MONTH)::DATE AS target_month FROM pair_f f, (VALUES (1), (2), (3)) x(h) WHERE f.month + h * INTERVAL 1 MONTH <= DATE '2001-08-01'"

    def parity_sql(counts: dict[str, str]) -> str:
        cases = " ".join(f"WHEN '{c}' THEN (SELECT count(*) FROM r WHERE {w})" for c, w in counts.items())
        names = ", ".join(f"('{c}')" for c in ["grain", *own])
        return f"""WITH r AS ({train}) SELECT c AS "column", (SELECT count(*) FROM r) AS n_rows, {f'CASE c {cases} ELSE 0 END' if cases else '0'}::BIGINT AS mismatches FROM (VALUES {names}) x(c)"""

    def parity(d: Demand, spoil: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """The backtest's features against the development panel's, which are made another way: all columns, all origins."""
        frames = (f.where(F.col("target_month") <= F.lit(d.calendar.train_end).cast("date")).select(*dev_keys, *own) for f in (d.pair_dev, d.rolling))
        return diagnose.parity(next(frames), spoil(next(frames)), dev_keys, own)

    query("parity_audit", parity_sql({}))(parity)
    query("parity_audit_spoiled", parity_sql({
        "grain": "branch_code = '005'", "pair_lag_1": "branch_code <> '005' AND month(target_month) = 3 AND pair_lag_1 IS NOT NULL", "pair_roll_12_std": "branch_code <> '005' AND horizon = 2 AND pair_roll_12_std IS NOT NULL",
    }))(lambda d: parity(d, lambda df: df.where("branch_code <> '005'").withColumns({
        "pair_lag_1": F.when(F.month("target_month") == 3, F.col("pair_lag_1") + 1).otherwise(F.col("pair_lag_1")), "pair_roll_12_std": F.when(F.col("horizon") != 2, F.col("pair_roll_12_std")),
    })))
    query("alignment", "SELECT base_sku, branch_code, forecast_origin, target_month, horizon, target_actual_gross_m2, pred_soft, pred_ma_3 FROM ev", ("pred_soft", "pred_ma_3"))(
        lambda d: diagnose.align(d.evaluation.select(*dev_keys, scores.Y, "pred_soft"), supervise.origin_phases(d.rolling, d.origins, ["EVAL"]).select(*dev_keys, scores.Y, "pred_ma_3"), dev_keys, "pred_ma_3")
    )
    sides = lambda q, v: f"(SELECT {v} FROM ({q}) WHERE model = 'ma_3') AS a, (SELECT {v} FROM ({q}) WHERE model = 'soft') AS b"
    figures = {
        "monthly_wape": sides(f"SELECT model, {METRICS} FROM long GROUP BY 1", "wape"), "wape_3m_pair": sides(f"SELECT model, {w_metrics} FROM ({rolled}) WHERE level = 'PAIR' GROUP BY 1", "wape_3m"),
        "zero_false_positive_rate": sides(f"SELECT model, {METRICS} FROM long GROUP BY 1", "zero_false_positive_rate"),
        "revision_ratio": sides(f"SELECT model, {r_metrics} FROM ({revised}) WHERE transition = 'H2_TO_H1' GROUP BY 1", "revision_ratio"),
    }
    review = " UNION ALL ".join(f"SELECT '{n}' AS figure, a AS reference, b AS challenger, b - a AS difference, 'REVIEW_REQUIRED' AS decision FROM (SELECT {q})" for n, q in figures.items())
    query("comparison_review", review, ("reference", "challenger", "difference"))(lambda d: _review(d, diagnose, scores, long(d), PREDS))
    assert baselines.PREDS == PREDS


def _review(d: Demand, diagnose, scores, long: DataFrame, preds: list[str]) -> DataFrame:
    """What a reviewer decides on, of the analytic two-part forecast against the moving average."""
    board, windows = scores.scoreboard(long), scores.cumulative(scores.complete_windows(d.evaluation, preds), preds)
    found = diagnose.comparison_review(board, windows, board.where("segment is null"), scores.revision_summary(scores.revisions(d.evaluation, preds)), "ma_3", "soft")
    rows = [(n, x["reference"], x["challenger"], x["difference"], found["decision"]) for n, x in found["figures"].items()]
    return d.spark.createDataFrame(rows, "figure string, reference double, challenger double, difference double, decision string")


def _phase_counts(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        one = df.groupBy(F.lit(name).alias("phase"), "horizon").agg(F.count("*").alias("n_rows"), F.max("target_month").alias("max_target"))
        out = one if out is None else out.unionByName(one)
    return out


_evaluation()

# ---- validation, audits, selection, models and vintage


def _control() -> None:
    from monsoon.operators import baselines, challenger, scores, select, supervise, track, tweedie, validate, vintage
    from monsoon.sources import runs

    query("source_profile", "SELECT unit, count(*) AS n_rows, min(month) AS min_month, max(month) AS max_month, count(DISTINCT bravo_sku) AS n_sku, count(DISTINCT branch_code) AS n_branch FROM sales GROUP BY 1")(lambda d: validate.source_profile(d.sources.sales))
    fields = {
        "master_sku": ("master_sku", "bravo_sku base_sku master_status product_group brand price_group factory_code pull_source branch_channel"),
        "master_channel": ("master_channel", "branch_code branch_name region brand master_status"),
        "sales_monthly": ("sales", "bravo_sku branch_code unit month total_quantity total_amount line_count"),
    }
    blanks = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS field, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS null_count, count(*) FILTER (trim({c}::VARCHAR) = '') AS blank_count FROM {of}"""
        for t, (of, names) in fields.items() for c in names.split()
    )
    query("null_blank_report", blanks)(lambda d: reduce(DataFrame.unionByName, [validate.null_blank_report(getattr(d.sources, of).select(*names.split()), t) for t, (of, names) in fields.items()]))
    tables = (("sales_monthly", "sales", ["bravo_sku", "branch_code", "unit", "month"]), ("master_sku", "master_sku", ["bravo_sku"]), ("fact", "fact", [*PAIR, "month"]))

    def frames(d: Demand) -> list:
        return [(n, f, k) for (n, _, k), f in zip(tables, (d.sources.sales, d.sources.master_sku, d.fact), strict=True)]

    query("duplicate_report", " UNION ALL ".join(f"""SELECT '{n}' AS "table", count(*) AS duplicate_groups, coalesce(sum(c), 0)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS c FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1)""" for n, t, k in tables))(
        lambda d: validate.duplicate_report(frames(d))
    )
    query("key_report", " UNION ALL ".join(f"""SELECT '{n}' AS "table", coalesce(sum(c), 0)::BIGINT AS n_rows, count(*) AS n_keys FROM (SELECT count(*) AS c FROM {t} GROUP BY {', '.join(k)})""" for n, t, k in tables))(lambda d: validate.key_report(frames(d)))
    query("mapping_audit", "SELECT primary_exclusion_reason, count(*) AS n_rows, sum(gross_positive_m2) AS gross_m2, sum(negative_m2) AS negative_m2 FROM obs GROUP BY 1")(lambda d: validate.mapping_audit(d.observation))
    query("structure_audit", "SELECT mapping_status, modeling_exclusion_reason, base_group_count, structure_valid, is_l1, count(*) AS n_sku, count(DISTINCT base_sku) AS n_base FROM bridge GROUP BY ALL")(lambda d: validate.structure_audit(d.bridge))
    query("channel_profile", "SELECT channel_relation_snapshot, count(*) AS n_rows, sum(gross_positive_m2) AS gross_m2, sum(gross_positive_m2) / sum(sum(gross_positive_m2)) OVER () AS gross_share FROM obs WHERE row_disposition = 'MODELING_VALID' GROUP BY 1", ("gross_share",))(
        lambda d: validate.channel_profile(d.observation)
    )
    attributes = ["product_group", "brand", "price_group", "factory_code", "pull_source", "branch_channel", "current_sku_status"]
    query("attribute_conflicts", " UNION ALL ".join(
        f"SELECT base_sku, '{c}' AS field, count(DISTINCT {c}) AS n_values, string_agg(DISTINCT {c}, ' | ' ORDER BY {c}) AS \"values\" FROM bridge WHERE base_sku IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {c}) > 1" for c in attributes
    ))(lambda d: validate.attribute_conflicts(d.bridge, attributes))
    counts = {
        "PAIR": ("pair_panel", {
            "rows": "true", "actual_observed_rows": "actual_observed", "missing_unknown_rows": "NOT actual_observed", "negative_only_rows": "actual_negative_only",
            "negative_only_target_available_rows": "actual_negative_only AND target_available", "negative_only_nonnull_actual_target_rows": "actual_negative_only AND actual_gross_m2 IS NOT NULL",
            "future_first_positive_visibility_rows": "first_positive_month_to_date > month",
        }),
        "BRANCH": ("branch_panel", {"rows": "true", "observed_branch_months": "branch_observed", "missing_branch_months": "NOT branch_observed", "positive_branch_months": "branch_positive"}),
    }
    counted = [f"SELECT '{t}' AS track, '{n}' AS item, count(*) FILTER ({w}) AS n FROM {of}" for t, (of, items) in counts.items() for n, w in items.items()]
    counted += ["SELECT 'PAIR', 'known_pairs', count(DISTINCT (base_sku, branch_code)) FROM pair_panel", "SELECT 'BRANCH', 'branches_with_history', count(DISTINCT branch_code) FROM branch_panel"]
    query("panel_counts", " UNION ALL ".join(counted))(lambda d: validate.panel_counts(d.pair_panel, d.branch_panel))
    query("reconciliation", """SELECT s.*, f.*, abs(source_positive - fact_positive) <= 1e-8 AND abs(source_negative - fact_negative) <= 1e-8 AS reconciled
        FROM (SELECT sum(gross_positive_m2) AS source_positive, sum(negative_m2) AS source_negative, count(*) AS source_rows FROM obs WHERE row_disposition = 'MODELING_VALID') s, (SELECT sum(gross_positive_m2) AS fact_positive, sum(negative_m2) AS fact_negative, count(*) AS fact_rows FROM fact) f""")(
        lambda d: validate.reconciliation(d.observation, d.fact)
    )
    query("panel_semantics", "SELECT zero_semantics, count(*) AS n_rows, count(*) FILTER (target_available) AS n_available, count(*) FILTER (actual_positive) AS n_positive, sum(actual_gross_m2) AS gross_m2 FROM pair_panel GROUP BY 1")(lambda d: validate.panel_semantics(d.pair_panel))
    _checks(validate, vintage)

    lags = lambda of: [f"{of}_lag_{n}" for n in (1, 2, 3, 6, 12)]
    rolls = lambda of, ops: [f"{of}_roll_{w}_{op}" for w in (3, 6, 12) for op in ops]
    spread = ("mean", "sum", "std", "coverage")
    doubles = [
        *lags("pair"), *rolls("pair", spread), "pair_positive_rate_to_origin", "pair_mean_positive_m2_to_origin", "pair_peak_share_to_origin", "pair_adi_target_available_to_origin", "pair_cv2_positive_to_origin",
        "pair_last_positive_m2_to_origin", "pair_peak_positive_m2_to_origin",
    ]
    whole = [*rolls("pair", ("target_available_count", "positive_count", "calendar_count")), *(f"pair_{c}" for c in ("history_length_months", "target_available_count_to_origin", "observed_source_month_count_to_origin", "positive_count_to_origin"))]
    b_doubles = [*lags("branch"), *rolls("branch", spread), "branch_positive_rate_to_origin", *(f"branch_pair_{c}_lag_1" for c in ("top1_share", "top5_share", "top10_share", "hhi"))]
    b_whole = [*rolls("branch", ("observed_count",)), "branch_history_length_months", "branch_observed_month_count_to_origin", "branch_positive_month_count_to_origin", "months_since_last_branch_positive"]
    # doubles are profiled at six places, as sums in another order differ beyond
    tracks = {"PAIR": ("pair_f", ["base_sku", "branch_code", "month", *whole], doubles), "BRANCH": ("branch_f", ["branch_code", "month", "region_snapshot", "branch_brand_snapshot", *b_whole], b_doubles)}

    def profiled(d: Demand, name: str) -> DataFrame:
        frame = _own(d) if name == "PAIR" else d.branch_origin
        return frame.select(*tracks[name][1], *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in tracks[name][2]])

    def described(name: str, table: str, c: str, value: str) -> str:
        listed = lambda names: ", ".join(f"'{x}'" for x in names)
        kind = f"""CASE WHEN '{c}' IN ({listed(track.TARGETS)}) THEN '{track.TARGET}' WHEN ends_with('{c}', '_snapshot') THEN '{track.SNAPSHOT}' WHEN '{c}' IN ({listed((*doubles, *whole, *b_doubles, *b_whole))}) THEN '{track.CANDIDATE}'
          WHEN '{c}' IN ({listed(track.CONTROL)}) THEN '{track.CONTROLS}' ELSE '{track.OTHER}' END"""
        timing = f"CASE {kind} {' '.join(f"WHEN '{r}' THEN '{t}'" for r, t in track.TIMING.items())} END"
        return f"SELECT '{name}' AS track, '{c}' AS feature_name, {kind} AS role, {kind} = '{track.CANDIDATE}' AS initial_model_candidate, {timing} AS timing_status, avg(({c} IS NULL)::INT) AS missing_rate, count(DISTINCT {value}) AS n_unique FROM {table}"

    query("feature_inventory", " UNION ALL ".join(described(name, of, c, f"round({c} + 1e-9, 6)" if c in real else c) for name, (of, plain, real) in tracks.items() for c in (*plain, *real)), ("missing_rate",))(
        lambda d: track.inventory({name: profiled(d, name) for name in tracks}).drop("dtype")
    )
    query("duplicate_map", "SELECT 'copy_of_lag' AS feature_name, 'pair_lag_1' AS duplicate_of UNION ALL SELECT 'actual', 'pair_lag_1'")(
        lambda d: select.duplicate_map(_own(d).withColumns({"copy_of_lag": F.col("pair_lag_1"), "actual": F.col("actual_gross_m2")}), ["pair_lag_1", "pair_lag_12", "copy_of_lag", "actual", "pair_roll_12_positive_count"], [*PAIR, "month"])
    )
    query("static_screen", """SELECT *, CASE WHEN missing_rate > 0.95 THEN 'DROP_MISSING_RATE' WHEN n_unique <= 1 THEN 'DROP_CONSTANT' WHEN duplicate_of IS NOT NULL THEN 'DROP_EXACT_DUPLICATE' ELSE 'PASS_STATIC' END AS static_status FROM (
        SELECT 'pair_lag_1' AS feature_name, avg((pair_lag_1 IS NULL)::INT) AS missing_rate, count(DISTINCT pair_lag_1) AS n_unique, NULL::VARCHAR AS duplicate_of FROM pair_f UNION ALL
        SELECT 'copy_of_lag', avg((pair_lag_1 IS NULL)::INT), count(DISTINCT pair_lag_1), 'pair_lag_1' FROM pair_f UNION ALL SELECT 'one', 0, 1, NULL UNION ALL SELECT 'none', 1, 0, NULL)""", ("missing_rate",))(
        lambda d: select.static_screen(_own(d).withColumns({"copy_of_lag": F.col("pair_lag_1"), "one": F.lit(1), "none": F.lit(None).cast("double")}), ["pair_lag_1", "copy_of_lag", "one", "none"], [*PAIR, "month"])
    )
    numbers = [*doubles, *whole]
    corr = ", ".join(f'corr({a}, {b}) AS "{a}|{b}"' for i, a in enumerate(numbers) for b in numbers[i + 1 :])
    query("correlation_review", f"""SELECT split_part(k, '|', 1) AS feature_a, split_part(k, '|', 2) AS feature_b, correlation FROM (UNPIVOT (SELECT {corr} FROM pair_f) ON COLUMNS(*) INTO NAME k VALUE correlation)
        WHERE NOT isnan(correlation) AND abs(correlation) >= 0.995""", ("correlation",))(lambda d: select.correlations(_own(d), numbers))
    query("capped_sample", """WITH r AS (SELECT base_sku, branch_code, month, actual_positive, md5(concat_ws('|', base_sku, branch_code, month, '42')) AS h FROM pair_f),
        n AS (SELECT actual_positive, 5000 * count(*)::BIGINT AS x, sum(count(*)) OVER () AS t FROM r GROUP BY 1),
        q AS (SELECT actual_positive, x // t + (row_number() OVER (ORDER BY x % t DESC, actual_positive) <= 5000 - sum(x // t) OVER ())::INT AS take FROM n)
        SELECT base_sku, branch_code, month, actual_positive FROM (SELECT r.*, take, row_number() OVER (PARTITION BY actual_positive ORDER BY h, base_sku, branch_code, month) AS i FROM r JOIN q USING (actual_positive)) WHERE i <= take""")(
        lambda d: select.capped_sample(_own(d).select(*PAIR, "month", "actual_positive"), ["actual_positive"], [*PAIR, "month"], 5000)
    )
    scored = [*_LAGGED, "pair_roll_12_mean", "pair_peak_share_to_origin"]
    corr = ", ".join(f"round(abs(corr(z.{c}, z.y)), 9) AS {c}" for c in scored)
    scopes = " UNION ALL ".join(f"SELECT '{n}' AS s, 0.0::DOUBLE AS horizon, {corr} FROM z WHERE {w}" for n, w in (("ALL", "true"), ("h1", "h = 1"), ("h2", "h = 2"), ("h3", "h = 3")))
    ahead = "SELECT f.*, h, t.actual_gross_m2 AS y FROM pair_f f, (VALUES (1), (2), (3)) x(h), pair_panel t WHERE t.base_sku = f.base_sku AND t.branch_code = f.branch_code AND t.month = (f.month + h * INTERVAL 1 MONTH)::DATE AND t.target_available"
    query("feature_choice", f"""WITH z AS ({ahead}), w AS ({scopes}), i AS (UNPIVOT w ON horizon, {", ".join(scored)} INTO NAME f VALUE v)
        SELECT feature_name, best, row_number() OVER (ORDER BY best DESC, feature_name)::INTEGER AS rank, reason <> 'NOT_SELECTED' AS selected, reason FROM (SELECT *, CASE WHEN feature_name = 'horizon' THEN 'MANDATORY_FOR_POOLED' WHEN best > 0.0005 THEN 'PERMUTATION_IMPORTANCE'
        WHEN row_number() OVER (ORDER BY best DESC, feature_name) <= 2 THEN 'MIN_FEATURE_FLOOR' ELSE 'NOT_SELECTED' END AS reason FROM (SELECT f AS feature_name, max(v) AS best FROM i GROUP BY 1))""", ("best",))(
        lambda d: select.choose_features(_importance_by_scope(d, scored), select.Screen(min_selected=2))
    )
    query("permutation_importance")(lambda d: _importance(d, challenger, supervise, select))
    query("family_ablation")(lambda d: _ablation(d, challenger, supervise))

    query("two_part_forecast")(lambda d: _two_part(d, challenger, supervise))
    query("hurdle_forecast")(lambda d: _hurdle(d, challenger, supervise))
    query("prospective_forecast")(lambda d: _prospective_fit(d, challenger, supervise, vintage))
    query("rolling_two_part")(lambda d: _rolling_scored(d, challenger)[1])
    query("rolling_two_part_audit")(lambda d: _rolling_audit(d, challenger))
    query("tweedie_scoreboard")(lambda d: _tweedie_scores(d, challenger, tweedie, scores, supervise))
    soft = "SELECT f.*, h, coalesce(pair_positive_rate_to_origin, 0) AS p, coalesce(pair_mean_positive_m2_to_origin, 0) AS q FROM pair_f f, (VALUES (1), (2), (3)) x(h) WHERE f.month = DATE '2001-11-01' AND base_current_active AND branch_current_active"
    query("forecast_summary", f"SELECT h::INTEGER AS horizon, count(*) AS n_rows, count(DISTINCT base_sku) AS n_sku, count(DISTINCT branch_code) AS n_branch, sum(p * q) AS forecast_sum, avg(p * q) AS forecast_mean, avg(p) AS mean_p, avg(q) AS mean_q FROM ({soft}) GROUP BY 1", ("forecast_sum", "forecast_mean", "mean_p", "mean_q"))(
        lambda d: vintage.forecast_summary(_vintage(d, vintage, supervise, baselines))
    )
    query("content_digest")(lambda d: runs.content_digest(d.fact))
    query("changed_parts")(_changed_parts)
    assert scores.Y in supervise.PAIR_TARGETS.values()


def _checks(validate, vintage) -> None:
    """Validation suites on the right frames and on spoiled ones, whose violations aren't zero."""
    twice = lambda t, k: f"SELECT count(*) AS v FROM (SELECT 1 FROM {t} GROUP BY {k} HAVING count(*) > 1)"
    bad = lambda t, c: f"SELECT count(*) FILTER ({c}) AS v FROM {t}"
    lost = lambda a, b, k: f"SELECT count(DISTINCT {k}) AS v FROM {a} WHERE {k} NOT IN (SELECT {k} FROM {b})"
    table = lambda checks: " UNION ALL ".join(f"""SELECT '{n}' AS "check", v AS violations, CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({q})""" for n, q in checks.items())

    def core(fact: str, pair: str, bridge: str) -> str:
        apart = lambda c: f"SELECT (abs((SELECT sum({c}) FROM obs WHERE row_disposition = 'MODELING_VALID') - (SELECT sum({c}) FROM {fact})) > 1e-8)::BIGINT AS v"
        return table({
            "bridge_unique": twice(bridge, "bravo_sku"),
            "dim_base_unique": twice("dim_base", "base_sku"),
            "dim_branch_unique": twice("dim_branch", "branch_code"),
            "observation_unique": twice("obs", "bravo_sku, branch_code, month"),
            "fact_unique": twice(fact, "base_sku, branch_code, month"),
            "pair_panel_unique": twice(pair, "base_sku, branch_code, month"),
            "branch_panel_unique": twice("branch_panel", "branch_code, month"),
            "fact_base_known": lost(fact, "dim_base", "base_sku"),
            "fact_branch_known": lost(fact, "dim_branch", "branch_code"),
            "fact_signs": bad(fact, "gross_positive_m2 < 0 OR negative_m2 > 0"),
            "implicit_zero_is_zero": bad(pair, "zero_semantics = 'OBSERVED_ZERO_IMPLICIT' AND (actual_gross_m2 <> 0 OR NOT target_available)"),
            "negative_only_has_no_target": bad(pair, "actual_negative_only AND (target_available OR actual_gross_m2 IS NOT NULL)"),
            "first_positive_is_origin_safe": bad(pair, "first_positive_month_to_date > month"),
            "starts_at_first_observation": bad(pair, "month < first_observed_month"),
            "positive_reconciles": apart("gross_positive_m2"),
            "negative_reconciles": apart("negative_m2"),
        })

    def of(d: Demand, fact: DataFrame, pair: DataFrame, bridge: DataFrame) -> DataFrame:
        return validate.validate_core(bridge, d.dim_base, d.dim_branch, d.observation, fact, pair, d.branch_panel)

    query("validate_core", core("fact", "pair_panel", "bridge"))(lambda d: of(d, d.fact, d.pair_panel, d.bridge))
    spoiled = """WITH bad_fact AS (SELECT * REPLACE (CASE WHEN month(month) = 6 THEN -1 - gross_positive_m2 ELSE gross_positive_m2 END AS gross_positive_m2, CASE WHEN month(month) = 7 THEN 'X' ELSE base_sku END AS base_sku) FROM fact),
      bad_pair AS (SELECT * REPLACE (CASE WHEN month(month) = 3 THEN 5 ELSE actual_gross_m2 END AS actual_gross_m2, CASE WHEN month(month) = 4 THEN (month + INTERVAL 1 MONTH)::DATE ELSE first_observed_month END AS first_observed_month) FROM pair_panel),
      bad_bridge AS (SELECT * FROM bridge UNION ALL SELECT * FROM bridge WHERE is_l1)"""
    wrong = lambda c, m, x: F.when(F.month("month") == m, x).otherwise(F.col(c))
    query("validate_core_spoiled", f"{spoiled} {core('bad_fact', 'bad_pair', 'bad_bridge')}")(
        lambda d: of(
            d,
            d.fact.withColumns({"gross_positive_m2": wrong("gross_positive_m2", 6, -1 - F.col("gross_positive_m2")), "base_sku": wrong("base_sku", 7, F.lit("X"))}),
            d.pair_panel.withColumns({"actual_gross_m2": wrong("actual_gross_m2", 3, F.lit(5.0)), "first_observed_month": wrong("first_observed_month", 4, F.add_months("month", 1))}),
            d.bridge.unionByName(d.bridge.where("is_l1")),
        )
    )
    query(
        "calendar_purity",
        """SELECT 'target_working_days_proxy' AS "column", count(*) FILTER (n > 1) AS impure_months FROM (SELECT count(DISTINCT target_working_days_proxy) + max((target_working_days_proxy IS NULL)::INT) AS n FROM target_calendar GROUP BY target_month)
        UNION ALL SELECT 'target_is_tet_month', count(*) FILTER (n > 1) FROM (SELECT count(DISTINCT target_is_tet_month) + max((target_is_tet_month IS NULL)::INT) AS n FROM target_calendar GROUP BY target_month)""",
    )(lambda d: validate.calendar_purity(d.pair_dev, ["target_working_days_proxy", "target_is_tet_month"]))
    query("calendar_purity_spoiled", """SELECT 'branch_code' AS "column", count(*) FILTER (n > 1) AS impure_months FROM (SELECT count(DISTINCT branch_code) AS n FROM pair_panel GROUP BY month)""")(
        lambda d: validate.calendar_purity(d.pair_panel.withColumnRenamed("month", "target_month"), ["branch_code"])
    )
    guards = """SELECT count(*) FILTER (p IS NULL OR q IS NULL OR f IS NULL) = 0 AS no_null, count(*) FILTER (p < 0 OR p > 1) = 0 AS probability_in_range, count(*) FILTER (q < 0 OR f < 0) = 0 AS nothing_negative,
      count(*) FILTER (abs(f - p * q) > 1e-9) = 0 AS forecast_is_product, count(*) AS n_rows, count(DISTINCT (base_sku, branch_code, forecast_origin, target_month, horizon)) = count(*) AS keys_unique"""
    query("prediction_guards", f"{guards} FROM (SELECT *, p_positive AS p, q_positive AS q, pred_soft AS f FROM ev)")(lambda d: validate.prediction_guards(d.evaluation, "pred_soft", vintage.KEYS))
    query("prediction_guards_spoiled", f"{guards} FROM (SELECT *, p_positive + 1 AS p, q_positive AS q, CASE WHEN horizon = 2 THEN NULL ELSE pred_soft END AS f FROM ev)")(
        lambda d: validate.prediction_guards(d.evaluation.withColumns({"p_positive": F.col("p_positive") + 1, "pred_soft": F.when(F.col("horizon") != 2, F.col("pred_soft"))}), "pred_soft", vintage.KEYS)
    )
    dev = """SELECT f.*, h, (f.month + h * INTERVAL 1 MONTH)::DATE AS target FROM pair_f f, (VALUES (1), (2), (3)) x(h) WHERE f.month <= DATE '2001-08-01' AND (f.month + h * INTERVAL 1 MONTH <= DATE '2001-08-01' OR f.month = DATE '2001-08-01')"""

    def stage(frame: str) -> str:
        """Counts on a frame with columns target (as given), info, peak and days."""
        return frame + table({
            "grain_unique": twice("bad", "month, target, h, base_sku, branch_code"), "information_up_to_origin": bad("bad", "info > month"), "horizon_aligned": bad("bad", "(month + h * INTERVAL 1 MONTH)::DATE <> target"),
            "no_frozen_target": bad("bad", "target >= DATE '2001-12-01'"), "origin_up_to_limit": bad("bad", "month > DATE '2001-08-01'"), "validation_origin_locked": bad("bad", "false"), "returns_have_no_target": bad("bad", "false"),
            "peak_is_carried": bad("bad", "pair_positive_count_to_origin > 0 AND peak IS NULL"), "calendar_known": bad("bad", "days IS NULL"),
        })

    fine = f"WITH bad AS (SELECT d.*, d.month AS info, pair_peak_positive_m2_to_origin AS peak, target_working_days_proxy AS days FROM ({dev}) d JOIN target_calendar c ON c.target_month = d.target) "
    query("validate_features", stage(fine))(lambda d: validate.validate_features(d.pair_dev, d.calendar.validation_origin, d.calendar.frozen_start))
    spoilt = f"""WITH g AS ({dev}), t AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE branch_code = '003'),
      bad AS (SELECT * REPLACE (CASE WHEN h = 3 THEN (target + INTERVAL 1 MONTH)::DATE ELSE target END AS target), CASE WHEN month(month) = 2 THEN (month + INTERVAL 1 MONTH)::DATE ELSE month END AS info,
        CASE WHEN h <> 1 THEN pair_peak_positive_m2_to_origin END AS peak, CASE WHEN h <> 2 THEN 1 END AS days FROM t) """

    def spoiled_features(d: Demand) -> DataFrame:
        twice_in = d.pair_dev.unionByName(d.pair_dev.where("branch_code = '003'"))
        return validate.validate_features(twice_in.withColumns({
            "target_month": F.when(F.col("horizon") == 3, F.add_months("target_month", 1)).otherwise(F.col("target_month")), "feature_information_max_month": F.when(F.month("forecast_origin") == 2, F.add_months("forecast_origin", 1)).otherwise(F.col("forecast_origin")),
            "pair_peak_positive_m2_to_origin": F.when(F.col("horizon") != 1, F.col("pair_peak_positive_m2_to_origin")), "target_working_days_proxy": F.when(F.col("horizon") != 2, 1),
        }), d.calendar.validation_origin, d.calendar.frozen_start)

    query("validate_features_spoiled", stage(spoilt))(spoiled_features)


def _changed_parts(d: Demand) -> DataFrame:
    """The parts of the stored sales that a comparison of digests names where a byte in the middle of each file has changed."""
    files = digests.contents(d.spark, f"{d.sf_dir}/lineitem.parquet")
    spoiled = files
    for i, byte in enumerate(("00", "FF")):
        at = F.floor(F.col("length") / 2) + i - F.col("at")
        inside = at.between(0, F.octet_length("content") - 1)
        spoiled = spoiled.withColumn("content", F.when(inside, F.overlay("content", F.unhex(F.lit(byte)), (at + 1).cast("int"), F.lit(1))).otherwise(F.col("content")))
    # digests are small; a comparison reads them more than once
    return digests.changes(*(store(digests.part_digests(f, 1 << 16), "digests") for f in (files, spoiled)))


def _importance_by_scope(d: Demand, columns: list[str]) -> DataFrame:
    """scope, feature_name and how closely each feature goes with demand, over all rows and by horizon; the horizon itself has 0."""
    rows = d.rolling.where("target_available").withColumn("scope", F.explode(F.array(F.lit("ALL"), F.concat(F.lit("h"), F.col("horizon")))))
    wide = rows.groupBy("scope").agg(*[F.round(F.abs(F.corr(c, "target_actual_gross_m2")), 9).alias(c) for c in columns], F.lit(0.0).alias("horizon"))
    return wide.unpivot(["scope"], ["horizon", *columns], "feature_name", "importance_wape_mean")


def _own(d: Demand) -> DataFrame:
    from monsoon.operators import features

    return features.pair_features(d.pair_panel)


def _vintage(d: Demand, vintage, supervise, baselines) -> DataFrame:
    frame = supervise.prospective(d.pair_origin, d.target_calendar, d.calendar.panel_end)
    p, q = F.coalesce("pair_positive_rate_to_origin", F.lit(0.0)), F.coalesce("pair_mean_positive_m2_to_origin", F.lit(0.0))
    return vintage.forecast_frame(frame.withColumns({"p_positive": p, "q_positive": q, "pred_soft": baselines.soft_expected(p, q)}), "pred_soft")


def _origin(day: str) -> dt.date:
    return dt.date.fromisoformat(day)


def _ahead(d: Demand, supervise) -> DataFrame:
    """What the models of the validation origin are judged on: its primary rows."""
    return d.rolling.where((F.col("forecast_origin") == F.lit(d.calendar.validation_origin).cast("date")) & supervise.primary())


_SCORED = [*PAIR, "forecast_origin", "target_month", "horizon", "target_actual_gross_m2"]


_PARTS = (boost.DEMAND, boost.OCCURRENCE, boost.QUANTITY)


def _validation(d: Demand, challenger, supervise) -> tuple[boost.Boosters, DataFrame]:
    """Direct models of all horizons and parts at the validation origin, and what they say of its primary rows."""
    models = d.models("validation", lambda: challenger.fit(d.rolling, [_origin(d.calendar.validation_origin)], _PARTS))
    return models, challenger.predict(models, _ahead(d, supervise), F.col("forecast_origin"), _PARTS)


def _two_part(d: Demand, challenger, supervise) -> DataFrame:
    return _validation(d, challenger, supervise)[1].select(*_SCORED, "p_positive", "q_positive", "pred_two_part")


def _hurdle(d: Demand, challenger, supervise) -> DataFrame:
    models, scored = _validation(d, challenger, supervise)
    return challenger.hurdle_forecast(models, store(scored, "scored")).select(*PAIR, "horizon", "threshold", "pred_hurdle")


def _prospective_fit(d: Demand, challenger, supervise, vintage) -> DataFrame:
    """The forecast of the panel's end, locked together with its models, as it is read back."""
    end = _origin(d.calendar.panel_end)
    models = d.models("prospective", lambda: challenger.fit(d.rolling, [end]))
    frame = challenger.predict(models, supervise.prospective(d.pair_origin, d.target_calendar, d.calendar.panel_end), F.col("forecast_origin"))
    run = vintage.lock(vintage.forecast_frame(frame, "pred_two_part"), f"{shared_dir(d.spark)}/vintages", f"v-{uuid.uuid4().hex}", d.calendar.panel_end, models=models)
    return d.spark.read.parquet(f"{run}/forecast")


def _rolling_origins(d: Demand) -> list[dt.date]:
    return sorted(r.origin for r in d.origins.collect())


def _rolling_scored(d: Demand, challenger) -> tuple[boost.Boosters, DataFrame]:
    """Models of all origins of the backtest, and every evaluation row with what those of its origin and horizon say."""
    models = d.models("rolling", lambda: challenger.fit(d.rolling, _rolling_origins(d)))
    return models, challenger.judged(models, d.rolling, _rolling_origins(d))


def _rolling_audit(d: Demand, challenger) -> DataFrame:
    """Each origin's and horizon's models: their trees, rows and losses, with scores on the evaluation rows beside the moving average."""
    models, scored = _rolling_scored(d, challenger)
    y, p = F.col("target_actual_gross_m2"), F.col("pred_two_part")
    plain = d.evaluation.select(*_SCORED[:-1], "pred_ma_3")
    judged = scored.join(plain, _SCORED[:-1]).groupBy("forecast_origin", "horizon").agg(
        F.count("*").alias("n_rows"), metrics.wape(y, p).alias("wape"), metrics.wape(y, F.col("pred_ma_3")).alias("wape_ma_3"), metrics.brier(y, F.col("p_positive")).alias("brier")
    )
    key = F.split("model", r"\|")
    fitted = models.audit(d.spark).select(F.to_date(F.concat(key[0], F.lit("-01"))).alias("forecast_origin"), "horizon", "part", "trees", "fit_rows", "cal_rows", "fit_positive", "cal_positive", "loss_before", "loss_after")
    return fitted.join(judged, ["forecast_origin", "horizon"])


def _tweedie_scores(d: Demand, challenger, tweedie, scores, supervise) -> DataFrame:
    """Errors by horizon of boosted Tweedie trees, the generalised linear model and the moving average on the same held-out rows."""
    scored = _validation(d, challenger, supervise)[1]
    phases = supervise.fit_calibration(challenger.with_size(d.rolling), d.calendar.validation_origin)
    conf = tweedie.Tweedie(numeric=challenger.FEATURES, categories=challenger.CATEGORIES, penalties=(0.01,))
    linear = [tweedie.fit_tweedie(*(phases[k].where(F.col("horizon") == h) for k in ("FIT", "CAL")), conf).transform(scored.where(F.col("horizon") == h)) for h in supervise.HORIZONS]
    both = reduce(DataFrame.unionByName, linear)
    long = scores.melt(both, ["horizon", scores.Y], ["pred_boosted", "pred_tweedie", "pred_ma_3"])
    return long.groupBy("model", "horizon").agg(*scores.metric_row(F.col(scores.Y), F.col("pred")))


def _importance(d: Demand, challenger, supervise, select) -> DataFrame:
    """Every feature of the direct model, judged on all primary rows of the validation origin."""
    models, scored = _validation(d, challenger, supervise)
    features = [*challenger.FEATURES, *challenger.CATEGORIES]
    rows = scored.select("forecast_origin", "horizon", "target_actual_gross_m2", *features)
    return select.permutation_table(rows, features, lambda df: challenger.demand(models, df), "target_actual_gross_m2", {"ALL": "true", **{f"h{h}": f"horizon = {h}" for h in supervise.HORIZONS}})


#: Families of features by the beginnings of their names.
FAMILIES = {
    "lag": ["pair_lag_"], "rolling": ["pair_roll_"], "history": ["pair_positive_rate", "pair_mean_positive", "pair_adi", "pair_history", "months_since_"], "calendar": ["target_month_num"], "place_and_size": ["branch_code", "tile_size_code"],
}


def _ablation(d: Demand, challenger, supervise) -> DataFrame:
    """What leaving out each family costs on all primary rows of the validation origin; all models are grown in the same passes."""
    origin = _origin(d.calendar.validation_origin)
    models = d.models("ablation", lambda: challenger.fit_ablation(d.rolling, origin, FAMILIES))
    return challenger.ablation(models, _ahead(d, supervise), FAMILIES)


_control()
