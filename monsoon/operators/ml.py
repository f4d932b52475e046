"""Two-part and hurdle forecasts with Spark ML's trees."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.operators.baselines import soft_expected
from monsoon.operators.gate import hurdle
from monsoon.operators.scores import Y
from monsoon.schema import DataError

FEATURES = (
    "pair_lag_1", "pair_lag_2", "pair_lag_3", "pair_lag_12", "pair_roll_3_mean", "pair_roll_12_mean", "pair_roll_12_positive_count", "pair_positive_rate_to_origin", "pair_mean_positive_m2_to_origin",
    "pair_adi_target_available_to_origin", "months_since_last_positive", "pair_history_length_months",
)


@dataclass(frozen=True)
class TwoPart:
    features: tuple[str, ...] = FEATURES
    max_trees: int = 20
    depth: int = 4
    min_fit_positive: int = 500
    min_cal_positive: int = 50
    seed: int = 42


def target_scale(df: DataFrame, least: float = 1.0) -> float:
    """The largest positive target, `least` at least."""
    return max(least, df.agg(F.max(F.greatest(F.col(Y), F.lit(0.0)))).first()[0] or 0.0)


def prepared(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Nulls become -1 with an indicator beside them, since Spark's trees take no nulls."""
    values = {f"x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in features}
    return df.withColumns({**values, **{f"n_{c}": F.col(c).isNull().cast("double") for c in features}})


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[p + c for c in features for p in ("x_", "n_")], outputCol="features_")


@dataclass
class TwoPartModel:
    conf: TwoPart
    occurrence: GBTClassificationModel
    quantity: GBTRegressionModel
    smearing: float
    audit: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """df with p_positive, q_positive and pred_two_part."""
        ready = _assembler(self.conf.features).transform(prepared(df, self.conf.features))
        with_p = self.occurrence.setProbabilityCol("probability_").setRawPredictionCol("raw_").setPredictionCol("class_").transform(ready)
        with_q = self.quantity.setPredictionCol("logq_").transform(with_p)
        p: Column = vector_to_array("probability_")[1]
        q = F.exp("logq_") * self.smearing
        helpers = [c for c in with_q.columns if c not in df.columns]
        out = with_q.withColumns({"_p": p, "_q": q}).drop(*helpers)
        return out.withColumnsRenamed({"_p": "p_positive", "_q": "q_positive"}).withColumn("pred_two_part", soft_expected(F.col("p_positive"), F.col("q_positive")))

    def save(self, path: str) -> None:
        """Both models, the smearing factor, the configuration and the audit under path, which must not exist."""
        self.occurrence.write().save(f"{path}/occurrence")
        self.quantity.write().save(f"{path}/quantity")
        rest = json.dumps({"conf": asdict(self.conf), "smearing": self.smearing, "audit": self.audit}, sort_keys=True)
        SparkSession.getActiveSession().createDataFrame([(rest,)], "value string").coalesce(1).write.text(f"{path}/rest")

    @staticmethod
    def load(path: str) -> TwoPartModel:
        """What save() has written."""
        rest = json.loads(SparkSession.getActiveSession().read.text(f"{path}/rest").first().value)
        conf = TwoPart(**rest["conf"] | {"features": tuple(rest["conf"]["features"])})
        return TwoPartModel(conf, GBTClassificationModel.load(f"{path}/occurrence"), GBTRegressionModel.load(f"{path}/quantity"), rest["smearing"], rest["audit"])


def fit_two_part(fit: DataFrame, cal: DataFrame, conf: TwoPart = TwoPart()) -> TwoPartModel:  # noqa: B008
    """The number of trees is chosen on the calibration rows; then both parts are fit again, at that size, on all rows.

    Occurrence is a boosted classifier; quantity a boosted regression of log demand on positive rows, with a smearing factor
    for the mean.  Raises if either part has too few positive rows.
    """
    features = ["features_"]
    ready = lambda df: _assembler(conf.features).transform(prepared(df, conf.features)).withColumns({"label_": (F.col(Y) > 0).cast("double"), "logy_": F.log(F.greatest(F.col(Y), F.lit(1e-6)))}).select(*features, "label_", "logy_", Y)
    both = ready(fit).withColumn("valid_", F.lit(False)).unionByName(ready(cal).withColumn("valid_", F.lit(True))).persist()
    counts = {r.valid_: r.n for r in both.where("label_ = 1").groupBy("valid_").agg(F.count("*").alias("n")).collect()}
    if counts.get(False, 0) < conf.min_fit_positive or counts.get(True, 0) < conf.min_cal_positive:
        raise DataError(f"too few positive rows to fit: {counts}")
    classifier = GBTClassifier(featuresCol="features_", labelCol="label_", maxDepth=conf.depth, maxIter=conf.max_trees, seed=conf.seed)
    regressor = GBTRegressor(featuresCol="features_", labelCol="logy_", maxDepth=conf.depth, maxIter=conf.max_trees, seed=conf.seed)
    positive = both.where("label_ = 1")
    n_p = classifier.copy().setValidationIndicatorCol("valid_").fit(both).getNumTrees
    n_q = regressor.copy().setValidationIndicatorCol("valid_").fit(positive).getNumTrees
    occurrence, quantity = classifier.setMaxIter(n_p).fit(both), regressor.setMaxIter(n_q).fit(positive)
    smear = quantity.transform(positive).agg(F.sum(Y) / F.sum(F.exp("prediction"))).first()[0]
    both.unpersist()
    return TwoPartModel(conf, occurrence, quantity, float(smear or 1.0), {"trees_occurrence": n_p, "trees_quantity": n_q, "positive_fit": counts.get(False, 0), "positive_cal": counts.get(True, 0)})


@dataclass
class HorizonModels:
    """A two-part model for each horizon."""

    models: dict[int, TwoPartModel]

    def transform(self, df: DataFrame) -> DataFrame:
        """df with the predictions of its horizon's model; rows of other horizons go."""
        return reduce(DataFrame.unionByName, [m.transform(df.where(F.col("horizon") == h)) for h, m in self.models.items()])

    def save(self, path: str) -> None:
        for h, model in self.models.items():
            model.save(f"{path}/h{h}")

    @staticmethod
    def load(path: str, horizons: Sequence[int]) -> HorizonModels:
        return HorizonModels({h: TwoPartModel.load(f"{path}/h{h}") for h in horizons})

    def audit(self, spark: SparkSession) -> DataFrame:
        """horizon, trees of both parts, positive rows of both phases, smearing."""
        rows = [(h, *(m.audit[k] for k in ("trees_occurrence", "trees_quantity", "positive_fit", "positive_cal")), m.smearing) for h, m in self.models.items()]
        return spark.createDataFrame(rows, "horizon int, trees_occurrence int, trees_quantity int, positive_fit long, positive_cal long, smearing double")


def fit_horizons(fit: DataFrame, cal: DataFrame, horizons: Sequence[int] = (1, 2, 3), conf: TwoPart = TwoPart()) -> HorizonModels:  # noqa: B008
    """A direct model for each horizon, from its rows of both phases."""
    return HorizonModels({h: fit_two_part(fit.where(F.col("horizon") == h), cal.where(F.col("horizon") == h), conf) for h in horizons})


def hurdle_prediction(df: DataFrame, choice: DataFrame) -> DataFrame:
    """pred_hurdle: zero below the horizon's threshold; choice is threshold_choice's small table."""
    return df.join(F.broadcast(choice.select("horizon", "threshold")), "horizon", "left").withColumn("pred_hurdle", hurdle(F.col("p_positive"), F.col("q_positive"), F.coalesce("threshold", F.lit(0.0))))
