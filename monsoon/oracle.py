"""Independent DuckDB texts for the catalog's queries: one chain of common table expressions and a last SELECT for each."""

from __future__ import annotations

import datetime as dt
import re

from monsoon.functions import lunar

_TILE = "CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN '3060' WHEN 'ECONOMY' THEN '4040' WHEN 'MEDIUM' THEN '6060' WHEN 'SMALL' THEN '3030' WHEN 'LARGE' THEN '8080' WHEN 'PROMO' THEN '1020' END"
_CLEAN = r"nullif(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '')"


def _status(c: str) -> str:
    fold = f"replace(strip_accents(lower({_CLEAN.format(c)})), 'đ', 'd')"
    return f"CASE WHEN {fold} IN ('active', 'hoat dong') THEN 'active' WHEN {fold} IN ('inactive', 'vo hieu hoa') THEN 'inactive' ELSE 'unknown' END"


def _observed(p: str, z: str, n: str) -> str:
    return (
        f"CASE WHEN {p} AND {z} AND {n} THEN 'MIXED_ALL' WHEN {p} AND {n} THEN 'MIXED_POSITIVE_NEGATIVE' WHEN {p} AND {z} THEN 'MIXED_ZERO_POSITIVE' WHEN {z} AND {n} THEN 'MIXED_ZERO_NEGATIVE' "
        f"WHEN {p} THEN 'POSITIVE_ONLY' WHEN {n} THEN 'NEGATIVE_ONLY' WHEN {z} THEN 'EXPLICIT_ZERO_ONLY' ELSE 'NO_SIGNAL' END"
    )


def _diff(a: str, b: str) -> str:
    return f"((year({a}) - year({b})) * 12 + month({a}) - month({b}))::INTEGER"


def _lags(value: str, prefix: str) -> str:
    return ", ".join(f"{f'lag({value}, {n - 1}) OVER o' if n > 1 else value} AS {prefix}_lag_{n}" for n in (1, 2, 3, 6, 12))


_FRAMES = ", ".join(f"w{w} AS (PARTITION BY {{k}} ORDER BY month ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)" for w in (3, 6, 12))
_WINDOW = "WINDOW o AS (PARTITION BY {k} ORDER BY month), t AS (PARTITION BY {k} ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), " + _FRAMES


def _holidays() -> str:
    rows = ", ".join(f"({y}, DATE '{lunar.new_year(y)}', DATE '{lunar.kings_day(y)}')" for y in range(1994, 2004))
    return f"VALUES {rows}"


def _middles() -> str:
    rows = []
    for y in range(1995, 2003):
        for m in range(1, 13):
            _, month, _, leap = lunar.to_lunar(dt.date(y, m, 15))
            rows.append(f"(DATE '{y}-{m:02}-01', {month}, {str(leap).lower()})")
    return f"VALUES {', '.join(rows)}"


CTES: dict[str, str] = {
    "master_sku": f"""
      SELECT 'P' || p_partkey AS bravo_sku, CASE WHEN p_size = 49 THEN NULL WHEN p_size = 50 THEN nn || '.L1' ELSE nn || '.' || CASE WHEN p_type LIKE 'PROMO%' THEN 'L2' ELSE 'L1' END || '.' || tile || '.B' || nn END AS base_sku,
        CASE WHEN p_partkey % 7 = 0 OR nn::INT % 10 = 3 THEN 'inactive' WHEN p_partkey % 11 = 0 THEN 'Vô hiệu hóa' WHEN p_partkey % 2 = 0 THEN ' Hoạt động ' ELSE 'active' END AS master_status,
        'GACH' AS product_group, p_brand AS brand, tile AS price_group, 'F' || nn AS factory_code, NULL::VARCHAR AS pull_source,
        CASE p_partkey % 5 WHEN 1 THEN 'BAN CHUNG' WHEN 2 THEN 'CH1+CH2' WHEN 3 THEN 'HANG CT' WHEN 4 THEN 'CH1' END AS branch_channel
      FROM (SELECT *, lpad(regexp_extract(p_brand, '([0-9]+)', 1), 2, '0') AS nn, {_TILE} AS tile FROM part)""",
    "master_channel": """
      SELECT lpad(n_nationkey::VARCHAR, 3, '0') AS branch_code, n_name AS branch_name, r_name AS region, 'CH' || (n_nationkey % 4) AS brand, CASE WHEN n_nationkey % 6 = 5 THEN 'inactive' ELSE 'Hoạt động' END AS master_status
      FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24""",
    "sales": """
      SELECT 'P' || l_partkey AS bravo_sku, lpad(s_nationkey::VARCHAR, 3, '0') AS branch_code, CASE WHEN l_linenumber = 7 THEN 'KG' ELSE 'M2' END AS unit, date_trunc('month', l_shipdate)::DATE AS month,
        sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity WHEN l_discount = 0 THEN 0 ELSE l_quantity END)::DOUBLE AS total_quantity, sum(l_extendedprice)::DOUBLE AS total_amount, count(*) AS line_count
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
    "bridge": f"""
      SELECT *, CASE WHEN base_sku IS NULL THEN 'UNMAPPED' ELSE 'MAPPED' END AS mapping_status,
        CASE WHEN base_sku IS NULL THEN 'UNMAPPED' WHEN NOT structure_valid THEN 'INVALID_STRUCTURE' WHEN NOT is_l1 THEN 'NON_L1' ELSE 'ELIGIBLE' END AS modeling_exclusion_reason
      FROM (SELECT bravo_sku, base_sku, {_status('master_status')} AS current_sku_status, product_group, brand, price_group, factory_code, pull_source, branch_channel,
          CASE WHEN base_sku IS NULL THEN 0 ELSE len(g) END::INTEGER AS base_group_count, g[1] AS base_group1, g[2] AS base_group2, g[3] AS base_group3, g[4] AS base_group4, g[3] AS tile_size_code,
          base_sku IS NOT NULL AND len(g) = 4 AND regexp_full_match(g[1], '[0-9]+') AND regexp_full_match(g[3], '[0-9]+') AS structure_valid, coalesce(g[2] = 'L1', false) AS is_l1
        FROM (SELECT *, string_split(base_sku, '.') AS g FROM master_sku))""",
    "dim_base": """
      SELECT base_sku, min(base_group1) AS base_group1, min(base_group2) AS base_group2, min(base_group3) AS base_group3, min(base_group4) AS base_group4, min(tile_size_code) AS tile_size_code,
        count(DISTINCT bravo_sku) AS variant_count, count(*) FILTER (current_sku_status = 'active') AS active_variant_count, count(*) FILTER (current_sku_status = 'inactive') AS inactive_variant_count,
        count(*) FILTER (current_sku_status = 'unknown') AS unknown_variant_count, count(*) FILTER (current_sku_status = 'active') > 0 AS base_current_active, count(DISTINCT current_sku_status) > 1 AS mixed_status,
        max(product_group) AS product_group, max(brand) AS brand, max(price_group) AS price_group, max(factory_code) AS factory_code, max(pull_source) AS pull_source
      FROM bridge WHERE modeling_exclusion_reason = 'ELIGIBLE' GROUP BY base_sku""",
    "dim_branch": f"""
      SELECT branch_code, branch_name, region, brand AS branch_brand, {_status('master_status')} AS branch_current_status, {_status('master_status')} = 'active' AS branch_current_active FROM master_channel""",
    "obs": f"""
      SELECT s.bravo_sku, b.base_sku, s.branch_code, s.month, coalesce(b.mapping_status, 'UNMATCHED_MASTER') AS mapping_status, CASE WHEN d.branch_code IS NULL THEN 'UNMATCHED_BRANCH' ELSE 'MAPPED' END AS branch_mapping_status,
        CASE WHEN b.bravo_sku IS NULL THEN 'UNMATCHED_MASTER' WHEN b.modeling_exclusion_reason <> 'ELIGIBLE' THEN b.modeling_exclusion_reason WHEN d.branch_code IS NULL THEN 'UNMATCHED_BRANCH' ELSE 'ELIGIBLE' END AS primary_exclusion_reason,
        CASE WHEN b.modeling_exclusion_reason = 'ELIGIBLE' AND d.branch_code IS NOT NULL THEN 'MODELING_VALID' ELSE 'EXCLUDED' END AS row_disposition,
        greatest(total_quantity, 0.0) AS gross_positive_m2, least(total_quantity, 0.0) AS negative_m2, total_quantity AS net_m2, total_amount AS total_amount_audit, line_count AS source_line_count,
        total_quantity > 0 AS observed_positive, total_quantity = 0 AS observed_explicit_zero, total_quantity < 0 AS observed_negative,
        {_observed('total_quantity > 0', 'total_quantity = 0', 'total_quantity < 0')} AS observation_status,
        CASE WHEN branch_channel IS NULL OR branch_brand IS NULL THEN 'UNKNOWN' WHEN branch_channel = branch_brand THEN 'EXACT_MATCH' WHEN branch_channel = 'BAN CHUNG' THEN 'COMMON' WHEN branch_channel = 'HANG CT' THEN 'PROJECT'
          WHEN branch_channel LIKE '%+%' AND list_contains(string_split(branch_channel, '+'), branch_brand) THEN 'COMBO_MATCH' ELSE 'CROSS_CHANNEL' END AS channel_relation_snapshot,
        b.current_sku_status, d.branch_current_status
      FROM sales s LEFT JOIN bridge b USING (bravo_sku) LEFT JOIN dim_branch d ON d.branch_code = s.branch_code WHERE unit = 'M2'""",
    "fact": f"""
      SELECT *, {_observed('observed_positive', 'observed_explicit_zero', 'observed_negative')} AS observation_status FROM (
        SELECT base_sku, branch_code, month, sum(gross_positive_m2) AS gross_positive_m2, sum(negative_m2) AS negative_m2, sum(net_m2) AS net_m2, coalesce(sum(total_amount_audit), 0) AS total_amount_audit,
          sum(source_line_count)::BIGINT AS source_line_count, count(*) AS observed_source_row_count, count(DISTINCT bravo_sku) AS observed_bravo_count,
          bool_or(observed_positive) AS observed_positive, bool_or(observed_explicit_zero) AS observed_explicit_zero, bool_or(observed_negative) AS observed_negative
        FROM obs WHERE row_disposition = 'MODELING_VALID' GROUP BY 1, 2, 3)""",
    "pair_dense": """
      SELECT f.base_sku, f.branch_code, first_observed_month, m::DATE AS month FROM (SELECT base_sku, branch_code, min(month) AS first_observed_month FROM fact GROUP BY 1, 2) f,
        unnest(generate_series(first_observed_month::TIMESTAMP, TIMESTAMP '2001-11-01', INTERVAL 1 MONTH)) r(m)""",
    "pair_base": """
      SELECT d.*, f.observed_source_row_count IS NOT NULL AS source_row_observed, coalesce(gross_positive_m2, 0) AS gross_positive_m2, coalesce(negative_m2, 0) AS negative_m2, coalesce(net_m2, 0) AS net_m2,
        coalesce(total_amount_audit, 0) AS total_amount_audit, coalesce(source_line_count, 0) AS source_line_count, coalesce(f.observed_source_row_count, 0) AS observed_source_row_count,
        coalesce(observed_bravo_count, 0) AS observed_bravo_count, coalesce(observed_positive, false) AS actual_positive, coalesce(observation_status, 'IMPLICIT_ZERO_NO_SOURCE_ROW') AS observation_status
      FROM pair_dense d LEFT JOIN fact f USING (base_sku, branch_code, month)""",
    "pair_panel": f"""
      SELECT p.*, {_diff('month', 'first_observed_month')} AS months_since_first_observed, {_diff('month', 'first_positive_month_to_date')} AS months_since_first_positive, 0 AS months_since_last_observed,
        {_diff('month', 'last_positive_month_to_date')} AS months_since_last_positive, b.* EXCLUDE (base_sku), d.* EXCLUDE (branch_code)
      FROM (SELECT *, true AS actual_observed, observation_status = 'EXPLICIT_ZERO_ONLY' AS actual_explicit_zero, observation_status = 'NEGATIVE_ONLY' AS actual_negative_only, observation_status <> 'NEGATIVE_ONLY' AS target_available,
          CASE WHEN observation_status <> 'NEGATIVE_ONLY' THEN gross_positive_m2 END AS actual_gross_m2,
          CASE WHEN NOT source_row_observed THEN 'OBSERVED_ZERO_IMPLICIT' WHEN observation_status = 'EXPLICIT_ZERO_ONLY' THEN 'OBSERVED_ZERO' WHEN observation_status = 'NEGATIVE_ONLY' THEN 'NEGATIVE_ONLY_GROSS_ZERO' ELSE 'OBSERVED_NONZERO_OR_MIXED' END AS zero_semantics,
          min(month) FILTER (actual_positive) OVER t AS first_positive_month_to_date, max(month) FILTER (actual_positive) OVER t AS last_positive_month_to_date,
          count(*) OVER t AS observed_month_count_to_date, count(*) FILTER (actual_positive) OVER t AS positive_month_count_to_date
        FROM pair_base WINDOW t AS (PARTITION BY base_sku, branch_code ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) p
      LEFT JOIN dim_base b ON b.base_sku = p.base_sku LEFT JOIN dim_branch d ON d.branch_code = p.branch_code""",
    "events": f"""
      SELECT f.*, gross_positive_m2 > 0 AS positive_pair, coalesce(new_positive_pair, false) AS new_positive_pair, coalesce(reactivated_pair, false) AS reactivated_pair, positive_gap_months FROM fact f
      LEFT JOIN (SELECT base_sku, branch_code, month, lag(month) OVER q IS NULL AS new_positive_pair, coalesce({_diff('month', 'lag(month) OVER q')} >= 2, false) AS reactivated_pair, {_diff('month', 'lag(month) OVER q')} AS positive_gap_months
        FROM fact WHERE gross_positive_m2 > 0 WINDOW q AS (PARTITION BY base_sku, branch_code ORDER BY month)) USING (base_sku, branch_code, month)""",
    "branch_month": """
      SELECT branch_code, month, sum(gross_positive_m2) AS branch_gross_m2, sum(negative_m2) AS branch_negative_m2, sum(net_m2) AS branch_net_m2, count(DISTINCT base_sku) AS observed_pair_count,
        count(*) FILTER (positive_pair) AS positive_pair_count, count(*) FILTER (observation_status = 'EXPLICIT_ZERO_ONLY') AS explicit_zero_pair_count, count(*) FILTER (observation_status = 'NEGATIVE_ONLY') AS negative_only_pair_count,
        sum(observed_bravo_count)::BIGINT AS observed_bravo_count, count(*) FILTER (new_positive_pair) AS new_positive_pair_count, count(*) FILTER (reactivated_pair) AS reactivated_pair_count,
        sum(x) FILTER (r <= 1) / sum(x) AS pair_top1_share, sum(x) FILTER (r <= 5) / sum(x) AS pair_top5_share, sum(x) FILTER (r <= 10) / sum(x) AS pair_top10_share, sum(x * x) / (sum(x) * sum(x)) AS pair_hhi,
        count(DISTINCT base_sku) AS observed_base_sku_count, count(*) FILTER (positive_pair) AS positive_base_sku_count, count(*) FILTER (new_positive_pair) AS new_positive_sku_count,
        sum(x) FILTER (r <= 1) / sum(x) AS sku_top1_share, sum(x) FILTER (r <= 5) / sum(x) AS sku_top5_share
      FROM (SELECT *, CASE WHEN positive_pair THEN gross_positive_m2 END AS x, row_number() OVER (PARTITION BY branch_code, month ORDER BY gross_positive_m2 DESC, base_sku) AS r FROM events) GROUP BY 1, 2""",
}


def _branch_panel() -> str:
    sums = ("branch_gross_m2", "branch_negative_m2", "branch_net_m2")
    counts = ("observed_pair_count", "positive_pair_count", "explicit_zero_pair_count", "negative_only_pair_count", "observed_bravo_count", "new_positive_pair_count", "reactivated_pair_count", "observed_base_sku_count", "positive_base_sku_count", "new_positive_sku_count")
    shares = ("pair_top1_share", "pair_top5_share", "pair_top10_share", "pair_hhi", "sku_top1_share", "sku_top5_share")
    filled = ", ".join([f"coalesce({c}, 0) AS {c}" for c in (*sums, *counts)] + list(shares))
    return f"""
      SELECT p.*, true AS branch_observed, branch_gross_m2 > 0 AS branch_positive, count(*) OVER t AS branch_observed_month_count_to_date, count(*) FILTER (branch_gross_m2 > 0) OVER t AS branch_positive_month_count_to_date, d.* EXCLUDE (branch_code)
      FROM (SELECT s.*, observed_pair_count IS NOT NULL AS branch_source_row_observed, {filled}
        FROM (SELECT branch_code, branch_first_observed_month, m::DATE AS month FROM (SELECT branch_code, min(month) AS branch_first_observed_month FROM branch_month GROUP BY 1),
          unnest(generate_series(branch_first_observed_month::TIMESTAMP, TIMESTAMP '2001-11-01', INTERVAL 1 MONTH)) r(m)) s LEFT JOIN branch_month b USING (branch_code, month)) p
      LEFT JOIN dim_branch d ON d.branch_code = p.branch_code WINDOW t AS (PARTITION BY p.branch_code ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


CTES["branch_panel"] = _branch_panel()


def _pair_features() -> str:
    k = "base_sku, branch_code"
    rolls = ", ".join(
        f"avg(actual_gross_m2) OVER w{w} AS pair_roll_{w}_mean, sum(actual_gross_m2) OVER w{w} AS pair_roll_{w}_sum, CASE WHEN count(actual_gross_m2) OVER w{w} >= 2 THEN stddev_pop(actual_gross_m2) OVER w{w} END AS pair_roll_{w}_std, "
        f"count(*) FILTER (target_available) OVER w{w} AS pair_roll_{w}_target_available_count, count(*) FILTER (actual_positive) OVER w{w} AS pair_roll_{w}_positive_count, count(*) OVER w{w} AS pair_roll_{w}_calendar_count, "
        f"count(*) FILTER (target_available) OVER w{w} / (count(*) OVER w{w})::DOUBLE AS pair_roll_{w}_coverage"
        for w in (3, 6, 12)
    )
    return f"""
      SELECT *, pair_positive_count_to_origin / nullif(pair_target_available_count_to_origin, 0)::DOUBLE AS pair_positive_rate_to_origin, ps / nullif(pair_positive_count_to_origin, 0) AS pair_mean_positive_m2_to_origin,
        pair_peak_positive_m2_to_origin / nullif(ps, 0) AS pair_peak_share_to_origin, pair_target_available_count_to_origin / nullif(pair_positive_count_to_origin, 0)::DOUBLE AS pair_adi_target_available_to_origin,
        CASE WHEN pair_positive_count_to_origin >= 2 AND ps > 0 THEN greatest(pq / pair_positive_count_to_origin - (ps / pair_positive_count_to_origin) * (ps / pair_positive_count_to_origin), 0) / ((ps / pair_positive_count_to_origin) * (ps / pair_positive_count_to_origin)) END AS pair_cv2_positive_to_origin
      FROM (SELECT *, {_lags('actual_gross_m2', 'pair')}, {rolls}, {_diff('month', 'first_observed_month')} + 1 AS pair_history_length_months, count(*) FILTER (target_available) OVER t AS pair_target_available_count_to_origin,
          observed_month_count_to_date AS pair_observed_source_month_count_to_origin, positive_month_count_to_date AS pair_positive_count_to_origin, last_value(x IGNORE NULLS) OVER t AS pair_last_positive_m2_to_origin, max(x) OVER t AS pair_peak_positive_m2_to_origin,
          coalesce(sum(x) OVER t, 0) AS ps, coalesce(sum(x * x) OVER t, 0) AS pq FROM (SELECT *, CASE WHEN actual_positive THEN actual_gross_m2 END AS x FROM pair_panel) {_WINDOW.format(k=k)})"""


def _sku_features() -> str:
    rolls = ", ".join(f"avg(g) OVER w{w} AS sku_global_roll_{w}_mean, sum(g) OVER w{w} AS sku_global_roll_{w}_sum" for w in (3, 6, 12))
    return f"""
      SELECT base_sku, month, {_lags('g', 'sku_global')}, {rolls}, count(*) FILTER (g > 0) OVER w12 / nullif(count(*) FILTER (a > 0) OVER w12, 0)::DOUBLE AS sku_global_positive_rate_12m, a AS sku_target_available_branch_count_lag_1,
        p AS sku_positive_branch_count_lag_1, n AS sku_known_branch_count_to_origin, e AS sku_ever_positive_branch_count_to_origin, e / nullif(n, 0)::DOUBLE AS cross_branch_penetration_to_origin
      FROM (SELECT base_sku, month, sum(actual_gross_m2) AS g, count(*) FILTER (target_available) AS a, count(*) FILTER (actual_positive) AS p, count(DISTINCT branch_code) AS n, count(first_positive_month_to_date) AS e FROM pair_panel GROUP BY 1, 2)
      {_WINDOW.format(k='base_sku')}"""


def _size_features() -> str:
    rolls = ", ".join(f"avg(g) OVER w{w} AS size_branch_roll_{w}_mean" for w in (3, 6, 12))
    return f"""
      SELECT branch_code, tile_size_code, month, {_lags('g', 'size_branch')}, {rolls}, a AS size_branch_target_available_sku_count_lag_1, p AS size_branch_positive_sku_count_lag_1
      FROM (SELECT branch_code, tile_size_code, month, sum(actual_gross_m2) AS g, count(*) FILTER (target_available) AS a, count(*) FILTER (actual_positive) AS p FROM pair_panel WHERE tile_size_code IS NOT NULL GROUP BY 1, 2, 3)
      {_WINDOW.format(k='branch_code, tile_size_code')}"""


def _branch_features() -> str:
    rolls = ", ".join(
        f"avg(branch_gross_m2) OVER w{w} AS branch_roll_{w}_mean, sum(branch_gross_m2) OVER w{w} AS branch_roll_{w}_sum, CASE WHEN count(*) OVER w{w} >= 2 THEN stddev_pop(branch_gross_m2) OVER w{w} END AS branch_roll_{w}_std, "
        f"count(*) OVER w{w} AS branch_roll_{w}_observed_count, 1.0::DOUBLE AS branch_roll_{w}_coverage"
        for w in (3, 6, 12)
    )
    same = ", ".join(f"{c} AS branch_{c}_lag_1" for c in ("observed_pair_count", "positive_pair_count", "explicit_zero_pair_count", "negative_only_pair_count", "new_positive_pair_count", "reactivated_pair_count", "pair_top1_share", "pair_top5_share", "pair_top10_share", "pair_hhi"))
    return f"""
      SELECT branch_code, month, month AS feature_information_max_month, branch_current_active AS current_production_forecast_mask, region AS region_snapshot, branch_brand AS branch_brand_snapshot, {_lags('branch_gross_m2', 'branch')}, {rolls},
        {_diff('month', 'branch_first_observed_month')} + 1 AS branch_history_length_months, branch_observed_month_count_to_date AS branch_observed_month_count_to_origin, branch_positive_month_count_to_date AS branch_positive_month_count_to_origin,
        branch_positive_month_count_to_date / branch_observed_month_count_to_date::DOUBLE AS branch_positive_rate_to_origin, {_diff('month', 'max(month) FILTER (branch_positive) OVER t')} AS months_since_last_branch_positive, {same},
        branch_gross_m2 / nullif(positive_pair_count, 0) AS branch_average_m2_per_positive_pair_lag_1, avg(positive_pair_count) OVER w3 AS branch_positive_pair_count_roll_3_mean, avg(new_positive_pair_count) OVER w3 AS branch_new_positive_pair_count_roll_3_mean
      FROM branch_panel {_WINDOW.format(k='branch_code')}"""


CTES |= {
    "pair_f": _pair_features(), "sku_f": _sku_features(), "size_f": _size_features(), "branch_f": _branch_features(),
    "holidays(year, tet, kings)": _holidays(), "middles(target_month, lm, leap)": _middles(),
    "target_calendar": """
      SELECT target_month, month(target_month)::INTEGER AS target_month_num, quarter(target_month)::INTEGER AS target_quarter, year(target_month)::INTEGER AS target_year, day(last_day(target_month))::INTEGER AS target_days_in_month,
        sin(2 * pi() * (month(target_month) - 1) / 12) AS target_month_sin, cos(2 * pi() * (month(target_month) - 1) / 12) AS target_month_cos, wd::INTEGER AS target_weekday_count, ev::INTEGER AS target_public_holiday_event_count,
        nd::INTEGER AS target_statutory_holiday_nominal_days, greatest(0, wd - nd)::INTEGER AS target_working_days_proxy, lm::INTEGER AS target_lunar_month_mid, leap AS target_lunar_month_mid_is_leap,
        sin(2 * pi() * (lm - 1) / 12) AS target_lunar_month_sin, cos(2 * pi() * (lm - 1) / 12) AS target_lunar_month_cos, CASE WHEN it THEN day(tet) ELSE 0 END::INTEGER AS target_tet_day_of_month,
        nx::INTEGER AS target_days_to_next_tet_from_midmonth, pv::INTEGER AS target_days_since_prev_tet_from_midmonth, it AS target_is_tet_month, (target_month + INTERVAL 1 MONTH)::DATE = date_trunc('month', tet)::DATE AS target_is_pre_tet_month,
        (target_month - INTERVAL 1 MONTH)::DATE = date_trunc('month', tet)::DATE AS target_is_post_tet_month
      FROM (SELECT m.*, h.tet, date_trunc('month', h.tet)::DATE = target_month AS it,
          (SELECT count(*) FROM unnest(generate_series(target_month::TIMESTAMP, last_day(target_month)::TIMESTAMP, INTERVAL 1 DAY)) r(d) WHERE isodow(d) < 6) AS wd,
          (date_trunc('month', h.tet)::DATE = target_month)::INT + (date_trunc('month', h.kings)::DATE = target_month)::INT + (month(target_month) IN (1, 4, 5, 9))::INT AS ev,
          5 * (date_trunc('month', h.tet)::DATE = target_month)::INT + (date_trunc('month', h.kings)::DATE = target_month)::INT + CASE month(target_month) WHEN 1 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 1 WHEN 9 THEN 2 ELSE 0 END AS nd,
          (SELECT min(x.tet - (target_month + 14)) FROM holidays x WHERE x.tet >= target_month + 14) AS nx, (SELECT min(target_month + 14 - x.tet) FROM holidays x WHERE x.tet <= target_month + 14) AS pv
        FROM middles m JOIN holidays h ON h.year = year(target_month))""",
}


def _states() -> str:
    run = "(PARTITION BY base_sku, branch_code ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
      SELECT base_sku, branch_code, month, CASE WHEN k >= 1 THEN 0.95 * z / greatest(p, 1e-12) ELSE 0 END AS pred_croston_sba, CASE WHEN k >= 1 THEN c * z ELSE 0 END AS pred_tsb
      FROM (SELECT *, pow(0.9, k) * sum(CASE WHEN pos THEN CASE WHEN k = 1 THEN y / 0.9 ELSE 0.1 * y * pow(0.9, -k) END END) OVER r AS z,
          pow(0.9, k) * sum(CASE WHEN pos THEN CASE WHEN k = 1 THEN gap / 0.9 ELSE 0.1 * gap * pow(0.9, -k) END END) OVER r AS p,
          pow(0.9, n) * sum(CASE WHEN pos THEN CASE WHEN k = 1 THEN pow(0.9, -n) / n ELSE 0.1 * pow(0.9, -n) END END) OVER r AS c
        FROM (SELECT *, n - coalesce(max(CASE WHEN pos THEN n END) OVER (PARTITION BY base_sku, branch_code ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gap
          FROM (SELECT base_sku, branch_code, month, actual_gross_m2 AS y, coalesce(target_available AND actual_gross_m2 > 0, false) AS pos, count(*) FILTER (target_available) OVER r AS n,
              count(*) FILTER (target_available AND actual_gross_m2 > 0) OVER r AS k FROM pair_panel WINDOW r AS {run}))
        WINDOW r AS {run})"""


EXPERTS = ("naive_1", "seasonal_12", "ma_3", "croston_sba", "tsb", "soft")
PREDS = tuple(f"pred_{e}" for e in EXPERTS)
_ROLL = """
  SELECT f.base_sku, f.branch_code, f.month AS forecast_origin, h::INTEGER AS horizon, t.month AS target_month, t.actual_gross_m2 AS target_actual_gross_m2, t.target_available,
    f.base_current_active AND f.branch_current_active AND t.target_available AS is_primary, f.pair_positive_count_to_origin AS n, f.months_since_last_positive AS gap, f.pair_mean_positive_m2_to_origin AS mean_pos,
    CASE WHEN f.pair_positive_count_to_origin <= 1 OR f.pair_adi_target_available_to_origin IS NULL OR f.pair_cv2_positive_to_origin IS NULL THEN 'very_sparse' WHEN f.pair_adi_target_available_to_origin < 1.32 AND f.pair_cv2_positive_to_origin < 0.49 THEN 'regular' ELSE 'intermittent' END AS segment,
    coalesce(pair_lag_1, 0) AS pred_naive_1, coalesce(pair_lag_12, 0) AS pred_seasonal_12, (coalesce(pair_lag_1, 0) + coalesce(pair_lag_2, 0) + coalesce(pair_lag_3, 0)) / 3 AS pred_ma_3, s.pred_croston_sba, s.pred_tsb,
    coalesce(pair_positive_rate_to_origin, 0) AS p_positive, coalesce(pair_mean_positive_m2_to_origin, 0) AS q_positive, coalesce(pair_positive_rate_to_origin, 0) * coalesce(pair_mean_positive_m2_to_origin, 0) AS pred_soft
  FROM pair_f f JOIN states s ON s.base_sku = f.base_sku AND s.branch_code = f.branch_code AND s.month = f.month, (VALUES (1), (2), (3)) x(h), pair_panel t
  WHERE t.base_sku = f.base_sku AND t.branch_code = f.branch_code AND t.month = (f.month + h * INTERVAL 1 MONTH)::DATE"""
_EVENT = """
  CASE WHEN coalesce(target_actual_gross_m2, 0) <= 0 THEN 'actual_zero' WHEN n <= 0 THEN 'first_positive_known_pair' WHEN gap >= 6 THEN 'reactivation_gap_6plus' WHEN gap >= 3 THEN 'reactivation_gap_3_5' WHEN gap >= 1 THEN 'reactivation_gap_1_2'
    WHEN target_actual_gross_m2 >= 1 AND target_actual_gross_m2 / nullif(mean_pos, 0) >= 3 THEN 'spike_3x_plus' WHEN target_actual_gross_m2 >= 1 AND target_actual_gross_m2 / nullif(mean_pos, 0) >= 2 THEN 'spike_2x_3x' ELSE 'ongoing_positive' END"""
CTES |= {
    "states": _states(),
    "roll": f"SELECT *, {_EVENT} AS event FROM ({_ROLL})",
    "ev": "SELECT * FROM roll WHERE is_primary AND forecast_origin BETWEEN DATE '2000-09-01' AND DATE '2001-08-01'",
    "long": f"UNPIVOT (SELECT base_sku, branch_code, forecast_origin, target_month, horizon, segment, event, target_actual_gross_m2 AS y, {', '.join(f'{p} AS {e}' for p, e in zip(PREDS, EXPERTS, strict=True))} FROM ev) ON {', '.join(EXPERTS)} INTO NAME model VALUE pred",
    "origins": "SELECT m::DATE AS origin FROM unnest(generate_series(TIMESTAMP '2000-09-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) r(m) WHERE (m + INTERVAL 3 MONTH)::DATE < DATE '2001-12-01'",
    "phases": """
      SELECT * FROM (SELECT o.origin, r.*, CASE WHEN target_month < (origin - INTERVAL 2 MONTH)::DATE AND target_available THEN 'FIT' WHEN target_month BETWEEN (origin - INTERVAL 2 MONTH)::DATE AND origin AND is_primary THEN 'CAL'
          WHEN forecast_origin = origin AND target_month > origin AND is_primary THEN 'EVAL' END AS phase FROM roll r JOIN origins o ON target_month <= origin OR forecast_origin = origin) WHERE phase IS NOT NULL""",
    "cal_long": f"UNPIVOT (SELECT origin, horizon, segment, target_actual_gross_m2 AS y, {', '.join(f'{p} AS {e}' for p, e in zip(PREDS, EXPERTS, strict=True))} FROM phases WHERE phase = 'CAL') ON {', '.join(EXPERTS)} INTO NAME model VALUE pred",
}

def gate(source: str, by: str, rows: int, allowed: dict[str, tuple[str, ...]], sources: tuple[str, str]) -> str:
    """SELECT text of the chosen experts; source has horizon, segment, y, model and pred, by is empty or ends in a comma."""
    k = by.rstrip(", ")
    on = f"{k}, " if k else ""
    may = ", ".join(f"('{s}', '{e}', {i})" for s, of in allowed.items() for i, e in enumerate(of))
    return f"""WITH s AS (SELECT {on}horizon, segment, count(*) AS n_rows FROM {source} WHERE model = 'soft' GROUP BY ALL),
      rows_of AS (SELECT {', '.join(f's.{x}' for x in (*([k] if k else []), 'horizon', 'segment', 'n_rows'))}, m.model, m.place, l.y, l.pred FROM s JOIN (VALUES {may}) m(segment, model, place) USING (segment)
        JOIN {source} l ON {f'l.{k} = s.{k} AND ' if k else ''}l.horizon = s.horizon AND l.model = m.model AND (s.n_rows < {rows} OR l.segment = s.segment)),
      w AS (SELECT {on}horizon, segment, n_rows, model, place, round(sum(abs(y - greatest(pred, 0))) / nullif(sum(abs(y)), 0), 12) AS w FROM rows_of GROUP BY ALL)
      SELECT {on}horizon, segment, n_rows, (arg_min({{'model': model}}, (w, place)) FILTER (w IS NOT NULL)).model AS expert, CASE WHEN n_rows < {rows} THEN '{sources[1]}' ELSE '{sources[0]}' END AS gate_source FROM w GROUP BY ALL"""


P0 = "greatest(pred, 0)"
METRICS = f"""count(*) AS n_rows, sum(abs(y - {P0})) / nullif(sum(abs(y)), 0) AS wape, avg(abs(y - {P0})) AS mae, sum({P0} - y) AS bias, sum({P0} - y) / nullif(sum(abs(y)), 0) AS bias_ratio,
  avg(CASE WHEN y <= 1e-9 THEN (pred > 1e-9)::INT END) AS zero_false_positive_rate, sum(CASE WHEN y > 0 THEN abs(y - {P0}) END) / nullif(sum(CASE WHEN y > 0 THEN y END), 0) AS positive_wape"""


def diagnosis(y: str, p: str) -> str:
    return f"""count(*) AS n_rows, sum({y}) AS actual_sum, sum({p}) AS forecast_sum, sum(abs({y} - {p})) / nullif(sum(abs({y})), 0) AS wape, avg(abs({y} - {p})) AS mae, sum({p} - {y}) AS bias, sum({p} - {y}) / nullif(sum(abs({y})), 0) AS bias_ratio,
  sum(greatest({y} - {p}, 0)) AS underforecast_sum, sum(greatest({p} - {y}, 0)) AS overforecast_sum"""


#: What several others read is computed once.
_ONCE = ("obs", "fact", "pair_panel", "pair_f", "states", "roll", "phases")


def sql(last: str) -> str:
    """What the last SELECT reads of the chain, directly or through others, and that SELECT."""
    names = {name.split("(")[0]: name for name in CTES}
    reads = lambda text: {n for n in names if re.search(rf"\b{n}\b", text)}
    needed, new = set(), reads(last)
    while new:
        needed |= new
        new = set().union(*(reads(CTES[names[n]]) for n in new)) - needed
    chain = ",\n".join(f"{name} AS {'MATERIALIZED ' if short in _ONCE else ''}({CTES[name]})" for short, name in names.items() if short in needed)
    # a last SELECT may have expressions of its own
    return f"WITH {chain}\nSELECT * FROM ({last})" if chain else f"SELECT * FROM ({last})"


def rounded(last: str, columns: list[str]) -> str:
    """The last SELECT with doubles rounded to six places."""
    return sql(f"SELECT * REPLACE ({', '.join(f'round({c} + 1e-9, 6) AS {c}' for c in columns)}) FROM ({last})")
