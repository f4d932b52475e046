"""Boosted demand models: two parts over all rolling origins, direct Tweedie, the hurdle with its fallback.

Every model is one job of a common fit (see boost): a dozen origins, three horizons and two parts take as many passes as one model.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monsoon.functions.metrics import wape
from monsoon.operators import boost
from monsoon.operators.baselines import soft_expected
from monsoon.operators.boost import DEMAND, OCCURRENCE, QUANTITY, Boost, Boosters, Job
from monsoon.operators.gate import Behaviour, hurdle, threshold_choice, threshold_grid
from monsoon.operators.scores import Y
from monsoon.operators.supervise import HORIZONS, primary
from monsoon.schema import PAIR, DataError

#: What the models see unless told otherwise: the pair's history and the calendar of the target month; region and size of the item.
FEATURES = (
    "pair_lag_1", "pair_lag_2", "pair_lag_3", "pair_lag_12", "pair_roll_3_mean", "pair_roll_12_mean", "pair_roll_12_positive_count", "pair_positive_rate_to_origin", "pair_mean_positive_m2_to_origin",
    "pair_adi_target_available_to_origin", "months_since_last_positive", "pair_history_length_months", "target_month_num",
)
CATEGORIES = ("branch_code", "tile_size_code")


@dataclass(frozen=True)
class Rules:
    """Positive rows that the quantity part needs in both phases."""

    min_fit_positive: int = 500
    min_cal_positive: int = 50


def with_size(panel: DataFrame) -> DataFrame:
    """tile_size_code from the item's code where the panel doesn't have it."""
    return panel if "tile_size_code" in panel.columns else panel.withColumn("tile_size_code", F.get(F.split("base_sku", r"\."), F.lit(2)))


def _month(day: dt.date) -> int:
    return day.year * 12 + day.month


def _key(origin: Column, horizon: Column, part: str) -> Column:
    return F.concat_ws("|", F.date_format(origin, "yyyy-MM"), horizon.cast("string"), F.lit(part))


def jobs(origins: Sequence[dt.date], horizons: Sequence[int] = HORIZONS, parts: Sequence[str] = (OCCURRENCE, QUANTITY)) -> list[Job]:
    """FIT is before the last three months closed at the origin, CAL is these."""
    return [Job(f"{o:%Y-%m}|{h}|{p}", h, p, _month(o) - 2, _month(o)) for o in origins for h in horizons for p in parts]


def fit(
    panel: DataFrame, origins: Sequence[dt.date], parts: Sequence[str] = (OCCURRENCE, QUANTITY), rules: Rules = Rules(), conf: Boost = Boost(),  # noqa: B008
    numeric: Sequence[str] = FEATURES, categories: Sequence[str] = CATEGORIES, horizons: Sequence[int] = HORIZONS,
) -> Boosters:
    """Models of all origins, horizons and parts.  Bins come from rows that every origin's FIT has.

    Raises for a quantity part with too few positive rows; without a demand part to fall back to, at least.
    """
    known = with_size(panel).where(F.coalesce(F.col("target_available"), F.lit(False)))
    first = F.lit(min(origins))
    binned = boost.binning(known.where(F.col("target_month") < F.add_months(first, -2)), numeric, categories, conf)

    def enough(job: Job, counts: dict) -> None:
        if job.part == QUANTITY and DEMAND not in parts and not _enough(counts, rules):
            raise DataError(f"too few positive rows for {job.key}: {counts}")

    return boost.fit(known, binned, jobs(origins, horizons, parts), primary(), conf, require=enough)


def _enough(counts: dict, rules: Rules) -> bool:
    return counts["fit_positive"] >= rules.min_fit_positive and counts["cal_positive"] >= rules.min_cal_positive


def predict(models: Boosters, rows: DataFrame, origin: Column, parts: Sequence[str] = (OCCURRENCE, QUANTITY)) -> DataFrame:
    """rows with p_positive and q_positive, their product pred_two_part, and pred_boosted for the parts there are, each from the
    models of the row's origin and horizon."""
    names = {OCCURRENCE: "p_positive", QUANTITY: "q_positive", DEMAND: "pred_boosted"}
    rows = with_size(rows).drop(*names.values())
    out = models.transform(rows, {names[p]: _key(origin, F.col("horizon"), p) for p in parts})
    return out.withColumn("pred_two_part", soft_expected(F.col("p_positive"), F.col("q_positive"))) if OCCURRENCE in parts and QUANTITY in parts else out


def judged(models: Boosters, panel: DataFrame, origins: Sequence[dt.date]) -> DataFrame:
    """What the models of every origin say of its evaluation rows: primary ones from the origin on later months."""
    rows = panel.where(F.col("forecast_origin").isin(*origins) & primary() & (F.col("target_month") > F.col("forecast_origin")))
    keys = [*PAIR, "forecast_origin", "target_month", "horizon", Y]
    return predict(models, rows, F.col("forecast_origin")).select(*keys, "p_positive", "q_positive", "pred_two_part")


def demand(models: Boosters, rows: DataFrame) -> DataFrame:
    """rows with prediction, the direct model's demand."""
    return models.transform(rows, {"prediction": _key(F.col("forecast_origin"), F.col("horizon"), DEMAND)})


def fit_ablation(panel: DataFrame, origin: dt.date, families: dict[str, Sequence[str]], conf: Boost = Boost(), numeric: Sequence[str] = FEATURES, categories: Sequence[str] = CATEGORIES) -> Boosters:  # noqa: B008
    """Direct models of all horizons with all features and without each family; families go by the beginnings of names.

    They are grown together, from the same bins and sums, so a family costs no pass of its own."""
    known = with_size(panel).where(F.coalesce(F.col("target_available"), F.lit(False)))
    binned = boost.binning(known.where(F.col("target_month") < F.add_months(F.lit(origin), -2)), numeric, categories, conf)
    whole = jobs([origin], parts=(DEMAND,))
    fewer = [replace(j, key=f"{j.key}|{f}", without=tuple(n for n in binned.names if n.startswith(tuple(starts)))) for f, starts in families.items() for j in whole]
    return boost.fit(known, binned, [*whole, *fewer], primary(), conf)


def ablation(models: Boosters, rows: DataFrame, families: dict[str, Sequence[str]]) -> DataFrame:
    """family, scope (ALL or a horizon), n_rows, n_features left out, wape_full, wape_without and delta_wape on the rows."""
    own = _key(F.col("forecast_origin"), F.col("horizon"), DEMAND)
    left_out = {f: sum(n.startswith(tuple(starts)) for n in models.binned.names) for f, starts in families.items()}
    scored = models.transform(with_size(rows), {"_full": own, **{f"_{f}": F.concat(own, F.lit(f"|{f}")) for f in families}})
    long = scored.select("horizon", Y, "_full", F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(n).alias("n_features"), F.col(f"_{f}").alias("pred")) for f, n in left_out.items()])).alias("x"))
    errors = [F.count("*").alias("n_rows"), wape(F.col(Y), F.col("_full")).alias("wape_full"), wape(F.col(Y), F.col("pred")).alias("wape_without")]
    rows = long.select("horizon", Y, "_full", "x.*").groupingSets([[F.col("family"), F.col("n_features")], [F.col("family"), F.col("n_features"), F.col("horizon")]], F.col("family"), F.col("n_features"), F.col("horizon")).agg(*errors)
    scope = F.coalesce(F.concat(F.lit("h"), F.col("horizon")), F.lit("ALL"))
    return rows.select("family", scope.alias("scope"), "n_rows", "n_features", "wape_full", "wape_without", (F.col("wape_without") - F.col("wape_full")).alias("delta_wape"))


def hurdle_forecast(models: Boosters, scored: DataFrame, rules: Rules = Rules(), conf: Behaviour = Behaviour()) -> DataFrame:  # noqa: B008
    """pred_hurdle and threshold: zero where the chance is below the threshold chosen on the rows themselves.

    A horizon whose quantity model has too few positive rows takes the direct model's demand and has no threshold.  scored has all
    three parts; models those of one origin.
    """
    poor = [m.job.horizon for m in models.models.values() if m.job.part == QUANTITY and m.audit["fit_positive"] < rules.min_fit_positive]
    choice = threshold_choice(threshold_grid(scored.where(~F.col("horizon").isin(*poor)) if poor else scored, conf), conf)
    joined = scored.join(F.broadcast(choice.select("horizon", "threshold")), "horizon", "left")
    product = hurdle(F.col("p_positive"), F.col("q_positive"), F.coalesce("threshold", F.lit(0.0)))
    return joined.withColumn("pred_hurdle", F.when(F.col("horizon").isin(*poor), F.col("pred_boosted")).otherwise(product) if poor else product)
