"""Feature inventories and the selection of one track's features."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.functions.metrics import wape
from monsoon.operators import select
from monsoon.schema import PAIR, DataError, require_columns

# Columns by name, as contracts and stored inventories have them.
TARGETS = (
    "target_actual_gross_m2", "target_branch_gross_m2", "target_available", "target_actual_observed", "target_actual_positive", "target_actual_negative_only", "target_zero_semantics", "target_branch_observed",
    "target_branch_positive",
)
CONTROL = (
    *PAIR, "forecast_origin", "target_month", "split_role", "horizon_label", "dataset_version", "feature_version", "feature_information_max_month", "known_pair_asof_origin", "historical_train_mask",
    "official_validation_mask",
)
CALENDAR = (
    "target_month_num", "target_quarter", "target_year", "target_days_in_month", "target_month_sin", "target_month_cos", "target_weekday_count", "target_public_holiday_event_count",
    "target_statutory_holiday_nominal_days", "target_working_days_proxy", "target_lunar_month_mid", "target_lunar_month_mid_is_leap", "target_lunar_month_sin", "target_lunar_month_cos", "target_tet_day_of_month",
    "target_days_to_next_tet_from_midmonth", "target_days_since_prev_tet_from_midmonth", "target_is_tet_month", "target_is_pre_tet_month", "target_is_post_tet_month",
)
#: Beginnings of the names of features known at the origin.
KNOWN = ("pair_", "months_since_", "sku_", "cross_branch_", "size_branch_", "branch_")
# Roles of columns, whether a model may use them, and what their time is.
TARGET, SNAPSHOT, CANDIDATE, CONTROLS, OTHER = "TARGET_OR_EVAL", "QA_SNAPSHOT_METADATA", "MODEL_CANDIDATE_STAGE6_REVIEW", "IDENTITY_OR_CONTROL", "QA_OR_AUXILIARY"
TIMING = {TARGET: "TARGET_MONTH_ONLY", SNAPSHOT: "BLOCKED_PENDING_TIMING_REVIEW", CANDIDATE: "ORIGIN_SAFE_OR_KNOWN_FUTURE", CONTROLS: "CONTROL", OTHER: "REVIEW"}


def rules(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    """precedence, role, pattern of names, initial_model_candidate and timing_status: the first rule that fits a column's name holds."""
    one_of = lambda names: f"^(?:{'|'.join(re.escape(n) for n in names)})$" if names else "^$"
    patterns = {TARGET: one_of(TARGETS), SNAPSHOT: "_snapshot$", CANDIDATE: one_of(candidates), CONTROLS: one_of(CONTROL), OTHER: ""}
    rows = [(i, role, pattern, role == CANDIDATE, TIMING[role]) for i, (role, pattern) in enumerate(patterns.items())]
    return spark.createDataFrame(rows, "precedence int, role string, pattern string, initial_model_candidate boolean, timing_status string")


def roles(columns: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """columns (a row a feature_name) with role, initial_model_candidate and timing_status, by a join with the few rules."""
    table = F.broadcast(rules(columns.sparkSession, candidates))
    fits = columns.select("feature_name").join(table, F.expr("feature_name rlike pattern"))
    first = fits.groupBy("feature_name").agg(F.min_by(F.struct("role", "initial_model_candidate", "timing_status"), "precedence").alias("r")).select("feature_name", "r.*")
    return columns.join(first, "feature_name")


def default_candidates(df: DataFrame) -> list[str]:
    """`horizon`, the calendar and what is known at the origin."""
    own = [c for c in df.columns if c.startswith(KNOWN) and c not in (*TARGETS, *CONTROL) and not c.endswith("_snapshot")]
    return [c for c in ("horizon", *CALENDAR) if c in df.columns] + own


def inventory(frames: dict[str, DataFrame], candidates: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """track, feature_name, dtype, role, initial_model_candidate, timing_status, missing_rate and n_unique of every column.

    One pass over each track's frame; of an empty one missing_rate is null.
    """
    out = None
    for track, df in frames.items():
        may = (candidates or {}).get(track) or default_candidates(df)
        names = df.sparkSession.createDataFrame([(track, c, kind) for c, kind in df.dtypes], "track string, feature_name string, dtype string")
        order = ["track", "feature_name", "dtype", "role", "initial_model_candidate", "timing_status"]
        one = roles(names, may).join(F.broadcast(select.column_profile(df, df.columns)), "feature_name", "left").select(*order, "missing_rate", "n_unique")
        out = one if out is None else out.unionByName(one)
    return out


def candidates_of(found: DataFrame, track: str, df: DataFrame) -> list[str]:
    """Columns of df that the inventory (a row for each column; flags may be text) marks as the track's candidates."""
    flag = F.lower(F.trim(F.col("initial_model_candidate").cast("string"))) == "true"
    names = {r.feature_name for r in found.where((F.col("track") == track) & flag).select("feature_name").collect()}
    return [c for c in df.columns if c in names]


@dataclass(frozen=True)
class TrackResult:
    track: str
    candidates: list[str]
    kept: list[str]
    selected: list[str]
    quality: DataFrame
    correlation: DataFrame
    importance: DataFrame
    ablation: DataFrame
    #: WAPE by scope on the primary rows and on all validation rows.
    primary: dict[str, float | None]
    secondary: dict[str, float | None]
    rows: dict[str, int]


SCOPES = {"ALL": "true", **{f"h{h}": f"horizon = {h}" for h in (1, 2, 3)}}


def select_track(
    df: DataFrame, found: DataFrame, track: str, y: str, families: dict[str, Sequence[str]], frozen_start: str, conf: select.Screen = select.Screen(), trees: int = 20, repeats: int = 2  # noqa: B008
) -> TrackResult:
    """Which candidates a track keeps: static screen, correlations, a screening model, importance, ablation and choice.

    df is a development panel.  Fits on its training rows and judges importance and families on the primary validation rows
    (current production, for pairs also known ones), of each a stratified sample of conf.max_rows at most, a documented bound;
    screen, correlations and both WAPE figures are over all rows.  Raises without rows of either
    kind, with a frozen target, with infinite features or targets that aren't finite, or if the screen leaves nothing.
    """
    require_columns(df, ["current_production_forecast_mask", *(["known_pair_asof_origin"] if track == "PAIR" else [])], track)
    available = F.coalesce(F.col("target_available" if "target_available" in df.columns else "target_branch_observed"), F.lit(False))
    main = F.coalesce(F.col("current_production_forecast_mask") & (F.col("known_pair_asof_origin") if track == "PAIR" else F.lit(True)), F.lit(False))
    train, whole = df.where(F.col("historical_train_mask") & available), df.where(F.col("official_validation_mask") & available)
    val = whole.where(main)
    names = candidates_of(found, track, df)
    kinds = dict(df.dtypes)
    real = [c for c in names if kinds[c] in ("double", "float")]
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    used = F.col("historical_train_mask") & available
    judged = F.col("official_validation_mask") & available
    checks = df.agg(
        F.count_if(used).alias("train"), F.count_if(judged).alias("secondary"), F.count_if(judged & main).alias("primary"), F.count_if(F.col("target_month") >= F.lit(frozen_start).cast("date")).alias("frozen"),
        F.count_if((used | judged) & (F.col(y).isNull() | bad(F.col(y)))).alias("target"), *[F.count_if(used & (F.abs(F.col(c)) == float("inf"))).alias(f"f{i}") for i, c in enumerate(real)],
    ).first().asDict()
    infinite = [c for i, c in enumerate(real) if checks[f"f{i}"]]
    if not checks["train"] or not checks["primary"]:
        raise DataError(f"{track}: no training rows or no primary validation rows")
    if checks["frozen"] or checks["target"] or infinite:
        raise DataError(f"{track}: {checks['frozen']} frozen targets, {checks['target']} targets that are not finite, infinite values in {infinite}")

    static = select.static_screen(train, names, [c for c in ("base_sku", "branch_code", "forecast_origin", "horizon") if c in df.columns], conf).persist()
    passed = {r.feature_name for r in static.where("static_status = 'PASS_STATIC'").collect()}
    kept = [c for c in names if c in passed]
    if not kept:
        raise DataError(f"{track}: the static screen leaves nothing")
    texts = [c for c in kept if kinds[c] == "string"]
    numbers = [c for c in kept if c not in texts]
    keys = [c for c in (*PAIR, "forecast_origin", "horizon") if c in df.columns]
    sample = select.capped_sample(train, ["horizon"], keys, conf.max_rows, conf.seed).persist()
    model = select.screening_model(sample, numbers, texts, y, trees)
    score = lambda rows: model(rows).agg(*[wape(F.when(F.expr(w), F.col(y)), F.when(F.expr(w), F.col("prediction"))).alias(k) for k, w in SCOPES.items()]).first().asDict()
    judge = select.capped_sample(val, ["horizon"], keys, conf.max_rows, conf.seed).persist()
    importance = select.permutation_table(judge, kept, model, y, SCOPES, repeats)
    ablation = select.family_ablation(sample, judge, numbers, families, y, trees, texts)
    decision = select.choose_features(importance, conf)
    selected = [r.feature_name for r in decision.where("selected").orderBy("rank").collect()]
    quality = static.join(decision, "feature_name", "left").na.fill(False, ["selected"])
    named = df.sparkSession.createDataFrame([(c, select.family_of(c, families)) for c in names], "feature_name string, family string")
    result = TrackResult(
        track, names, kept, selected, quality.join(F.broadcast(named), "feature_name", "left"), select.correlations(train, numbers, conf.correlation), importance, ablation, score(val), score(whole),
        {k: checks[k] for k in ("train", "primary", "secondary")},
    )
    sample.unpersist()
    judge.unpersist()
    return result


#: Names that no selection may hold, whatever their role.
UNSAFE = rf"_snapshot$|^target_(?:actual|branch)|^(?:{'|'.join(('target_available', *PAIR, 'forecast_origin', 'target_month'))})$"


def validate_selection(result: TrackResult, least: int, calendar: Sequence[str] = CALENDAR) -> DataFrame:
    """check, violations and status of a selection, from one aggregation over its quality table."""
    chosen, status, name = F.coalesce("selected", F.lit(False)), F.col("static_status"), F.col("feature_name")
    whole, rows = result.primary["ALL"], result.rows
    short = lambda n, found: F.greatest(F.lit(n) - found, F.lit(0))
    # The names of the checks.
    checks = {
        "nonempty_selected_list": short(least, F.count_if(chosen)),
        "selected_subset_static_kept": F.count_if(chosen & (status != "PASS_STATIC")),
        "no_constant_selected": F.count_if(chosen & (status == "DROP_CONSTANT")),
        "no_high_missing_selected": F.count_if(chosen & (status == "DROP_MISSING_RATE")),
        "no_exact_duplicate_selected": F.count_if(chosen & (status == "DROP_EXACT_DUPLICATE")),
        "horizon_present_for_pooled": short(1, F.count_if(chosen & (name == "horizon"))),
        "validation_wape_finite": F.lit(int(whole is None or not math.isfinite(whole))),
        "primary_validation_nonempty": F.lit(int(rows["primary"] < 1)),
        "secondary_validation_not_smaller": F.lit(max(rows["primary"] - rows["secondary"], 0)),
        "calendar_v013_candidates_seen": short(len(calendar), F.count_if(name.isin(*calendar))),
        "no_target_or_snapshot_selected": F.count_if(chosen & name.rlike(UNSAFE)),
    }
    wide = result.quality.agg(*[x.cast("long").alias(c) for c, x in checks.items()])
    return wide.unpivot([], list(checks), "check", "violations").withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
