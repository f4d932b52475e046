"""Direct Tweedie regression with categories: a generalised linear model with a log link."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.functions.metrics import wape
from monsoon.operators.ml import FEATURES, target_scale
from monsoon.operators.scores import Y
from monsoon.schema import DataError


@dataclass(frozen=True)
class Tweedie:
    numeric: tuple[str, ...] = FEATURES
    categories: tuple[str, ...] = ()
    power: float = 1.5
    penalties: tuple[float, ...] = (0.001, 0.01, 0.1)
    max_iter: int = 25
    #: Spark's solver takes 4096 columns; categories count with all their values.
    max_columns: int = 4000


def split_features(df: DataFrame, features: Sequence[str], direct: bool = True) -> tuple[list[str], list[str]]:
    """Numeric features and categories (strings) of those that df has; a direct model drops `horizon`.  Raises if none is left."""
    kinds = dict(df.dtypes)
    use = [f for f in features if f in kinds and not (direct and f == "horizon")]
    if not use:
        raise DataError("no usable feature in the frame")
    return [f for f in use if kinds[f] != "string"], [f for f in use if kinds[f] == "string"]


def _ready(df: DataFrame, conf: Tweedie) -> DataFrame:
    """Numbers on a signed log scale, so that the log link sees elasticities; nulls are 0 with an indicator, null categories a value."""
    value = lambda c: F.signum(F.col(c).cast("double")) * F.log1p(F.abs(F.col(c).cast("double")))
    new = {f"x_{c}": F.coalesce(value(c), F.lit(0.0)) for c in conf.numeric} | {f"n_{c}": F.col(c).isNull().cast("double") for c in conf.numeric}
    return df.withColumns(new | {f"s_{c}": F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in conf.categories})


@dataclass
class TweedieModel:
    conf: Tweedie
    prepare: PipelineModel
    model: GeneralizedLinearRegressionModel
    scale: float
    penalty: float

    def transform(self, df: DataFrame) -> DataFrame:
        """df with pred_tweedie, never negative.  A category unseen in the fit is one value of its own."""
        out = self.model.setPredictionCol("tweedie_").transform(self.prepare.transform(_ready(df, self.conf)))
        return out.withColumn("_pred", F.greatest(F.col("tweedie_") * self.scale, F.lit(0.0))).select(*df.columns, F.col("_pred").alias("pred_tweedie"))

    def save(self, path: str) -> None:
        """Preparation, model, configuration, scale and penalty under path, which must not exist."""
        self.prepare.write().save(f"{path}/prepare")
        self.model.write().save(f"{path}/model")
        rest = json.dumps({"conf": asdict(self.conf), "scale": self.scale, "penalty": self.penalty}, sort_keys=True)
        SparkSession.getActiveSession().createDataFrame([(rest,)], "value string").coalesce(1).write.text(f"{path}/rest")

    @staticmethod
    def load(path: str) -> TweedieModel:
        """What save() has written."""
        rest = json.loads(SparkSession.getActiveSession().read.text(f"{path}/rest").first().value)
        conf = Tweedie(**{k: tuple(v) if isinstance(v, list) else v for k, v in rest["conf"].items()})
        return TweedieModel(conf, PipelineModel.load(f"{path}/prepare"), GeneralizedLinearRegressionModel.load(f"{path}/model"), rest["scale"], rest["penalty"])


def fit_tweedie(fit: DataFrame, cal: DataFrame, conf: Tweedie = Tweedie()) -> TweedieModel:  # noqa: B008
    """The penalty of least WAPE on the calibration rows; then the model is fit again, with it, on all rows.

    Categories are those of the fit rows; the target is divided by its greatest value there.  Rows without a target are left
    out, negative targets are 0.  Raises without a positive fit row, or if the categories have too many values.
    """
    known = lambda df: df.where(F.col(Y).isNotNull() & ~F.isnan(Y))
    fit, cal = known(fit), known(cal)
    if fit.where(F.col(Y) > 0).isEmpty():
        raise DataError("no positive row to fit")
    scale = target_scale(fit)
    numbers = [p + c for c in conf.numeric for p in ("x_", "n_")]
    index = [StringIndexer(inputCol=f"s_{c}", outputCol=f"i_{c}", handleInvalid="keep") for c in conf.categories]
    hot = [OneHotEncoder(inputCol=f"i_{c}", outputCol=f"o_{c}") for c in conf.categories]
    assemble = VectorAssembler(inputCols=[*numbers, *[f"o_{c}" for c in conf.categories]], outputCol="features_")
    indexed = Pipeline(stages=index).fit(_ready(fit, conf))
    width = len(numbers) + sum(len(s.labels) for s in indexed.stages)
    if width > conf.max_columns:
        raise DataError(f"{width} columns with all values of the categories, {conf.max_columns} allowed")
    prepare = Pipeline(stages=[*indexed.stages, *hot, assemble]).fit(_ready(fit, conf))
    ready = lambda df: prepare.transform(_ready(df, conf)).select("features_", Y, (F.greatest(F.col(Y), F.lit(0.0)) / scale).alias("label_"))
    both = ready(fit).withColumn("_cal", F.lit(False)).unionByName(ready(cal).withColumn("_cal", F.lit(True))).persist()

    def solve(rows: DataFrame, penalty: float) -> GeneralizedLinearRegressionModel:
        family = GeneralizedLinearRegression(family="tweedie", variancePower=conf.power, linkPower=0.0, featuresCol="features_", labelCol="label_")
        return family.setRegParam(penalty).setMaxIter(conf.max_iter).fit(rows)

    def loss(penalty: float) -> float:
        scored = solve(both.where("not _cal"), penalty).transform(both.where("_cal"))
        found = scored.agg(wape(F.col(Y), F.greatest(F.col("prediction") * scale, F.lit(0.0))).alias("w")).first().w
        return float("inf") if found is None or found != found else found

    best = min(conf.penalties, key=loss) if len(conf.penalties) > 1 else conf.penalties[0]
    model = solve(both, best)
    both.unpersist()
    return TweedieModel(conf, prepare, model, scale, best)
