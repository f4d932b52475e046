"""Feature screening: profiles, duplicates, correlation, importance, ablation and choice."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monsoon.functions.metrics import wape


@dataclass(frozen=True)
class Screen:
    max_missing: float = 0.95
    min_gain: float = 0.0005
    min_selected: int = 20
    mandatory: tuple[str, ...] = ("horizon",)
    correlation: float = 0.995
    max_rows: int = 180_000
    seed: int = 42


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """missing_rate and n_unique of each column, in one pass over df.

    Rows become (column, value) and are counted by value before any exchange, so what moves is a row for each distinct
    value of a task.  Of an empty frame missing_rate is null.
    """
    kinds, columns = dict(df.dtypes), list(columns)
    real = {c for c in columns if kinds[c] in ("double", "float")}
    cell = lambda i, c: F.struct(F.lit(i).alias("i"), (F.col(c).cast("double") if c in real else F.lit(None).cast("double")).alias("d"), (F.lit(None).cast("string") if c in real else F.col(c).cast("string")).alias("s"))
    values = df.select(F.explode(F.array(*[cell(i, c) for i, c in enumerate(columns)])).alias("v")).groupBy("v.i", "v.d", "v.s").agg(F.count("*").alias("n"))
    none = F.col("d").isNull() & F.col("s").isNull()
    facts = values.groupBy("i").agg((F.coalesce(F.sum(F.when(none, F.col("n"))), F.lit(0)) / F.sum("n")).alias("missing_rate"), F.count_if(~none).alias("n_unique"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "i int, feature_name string")
    # a row for each column
    return names.join(F.broadcast(facts), "i", "left").select("feature_name", "missing_rate", F.coalesce("n_unique", F.lit(0).cast("long")).alias("n_unique"))


def duplicate_map(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Columns equal to an earlier one on every row, nulls being equal: feature_name and duplicate_of.

    A column's fingerprint is the sum of hashes of key and value over all rows, so no pair of columns is compared.
    """
    # integers and doubles of one value must agree
    value = lambda c: F.col(c).cast("double") if dict(df.dtypes)[c] in ("int", "bigint", "double", "float") else F.col(c).cast("string")
    prints = df.agg(*[F.sum(F.xxhash64(*keys, F.coalesce(value(c).cast("string"), F.lit("\0"))).cast("decimal(38,0)")).alias(c) for c in columns])
    long = prints.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("feature_name"), F.col(c).alias("f")) for i, c in enumerate(columns)])).alias("r")).select("r.*")
    first = F.min_by("feature_name", "i").over(Window.partitionBy("f"))
    return long.withColumn("duplicate_of", first).where("feature_name <> duplicate_of").select("feature_name", "duplicate_of")


def static_screen(df: DataFrame, columns: Sequence[str], keys: Sequence[str], conf: Screen = Screen()) -> DataFrame:  # noqa: B008
    """Why each column is dropped before any model: missing, constant or an exact duplicate; else it passes."""
    joined = column_profile(df, columns).join(duplicate_map(df, columns, keys), "feature_name", "left")
    status = F.when(F.col("missing_rate") > conf.max_missing, "DROP_MISSING_RATE").when(F.col("n_unique") <= 1, "DROP_CONSTANT").when(F.col("duplicate_of").isNotNull(), "DROP_EXACT_DUPLICATE").otherwise("PASS_STATIC")
    return joined.withColumn("static_status", status)


def correlations(df: DataFrame, columns: Sequence[str], least: float = 0.995) -> DataFrame:
    """Pairs of columns whose Pearson correlation, over rows with both, is at least `least` in size; constants have none.

    One pass for the columns' means, which keep the sums small, and one for all pairs: a matrix product per Arrow batch gives
    every pair's counts, sums and products, and a task sends each pair once.  Nulls and NaN count as missing.
    """
    schema = "feature_a string, feature_b string, correlation double"
    columns = list(columns)
    k = len(columns)
    if k < 2:
        return df.sparkSession.createDataFrame([], schema)
    values = df.select(*[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)])
    means = [m or 0.0 for m in values.agg(*[F.avg(c).alias(c) for c in values.columns]).first()]
    centre = np.array(means)
    upper = np.triu_indices(k, 1)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(upper[0])))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            has = ~np.isnan(x)
            x, m = np.where(has, x - centre, 0.0), has.astype(float)
            # rows are a's side, columns b's
            for at, (left, right) in enumerate(((m, m), (x, m), (m, x), (x * x, m), (m, x * x), (x, x))):
                sums[at] += (left.T @ right)[upper]
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), *[pa.array(s) for s in sums]], names=["a", "b", "n", "sa", "sb", "saa", "sbb", "sab"])

    parts = values.mapInArrow(moments, "a int, b int, n double, sa double, sb double, saa double, sbb double, sab double")
    s = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.col("n")
    va, vb, cov = F.col("saa") - F.col("sa") * F.col("sa") / n, F.col("sbb") - F.col("sb") * F.col("sb") / n, F.col("sab") - F.col("sa") * F.col("sb") / n
    # what rounding leaves of a constant column is no variance
    varies = (va > 1e-12 * F.col("saa")) & (vb > 1e-12 * F.col("sbb"))
    name = lambda c: F.element_at(F.array(*[F.lit(x) for x in columns]), F.col(c) + 1)
    found = s.where(n > 0).select(name("a").alias("feature_a"), name("b").alias("feature_b"), F.when(varies, cov / F.sqrt(va * vb)).alias("correlation"))
    return found.where(F.abs("correlation") >= least)


def capped_sample(df: DataFrame, strata: Sequence[str], keys: Sequence[str], max_rows: int, seed: int = 42) -> DataFrame:
    """Just max_rows rows (all, if there are fewer) for fitting a model, the same at any partitioning.

    Each stratum gives its share, what is left over going to the largest remainders; within it, rows of the least hashes of
    the key.  Hashes are counted by their first digits first, so only the rows of one bucket of each stratum, a 4096th of
    its rows, are ranked.  Nulls are a stratum of their own.  Keys should be unique: of rows that repeat one, any may stay.
    """
    strata = list(strata)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    rows = df.withColumn("_h", F.md5(text)).withColumn("_b", F.substring("_h", 1, 3))
    counts = rows.groupBy(*strata, "_b").agg(F.count("*").alias("_n"))
    # a row for each stratum
    share = counts.groupBy(*strata).agg(F.sum("_n").alias("_s")).withColumn("_t", F.sum("_s").over(Window.partitionBy()))
    whole = F.floor(F.col("_s") * max_rows / F.col("_t")).cast("long")
    share = share.withColumns({"_q": whole, "_r": F.col("_s") * max_rows % F.col("_t")})
    more = F.row_number().over(Window.orderBy(F.desc("_r"), *strata)) <= max_rows - F.sum("_q").over(Window.partitionBy())
    share = share.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(strata)], F.least("_s", F.col("_q") + more.cast("long")).alias("_take"))
    same = lambda other: [F.col(c).eqNullSafe(F.col(f"{other}{i}")) for i, c in enumerate(strata)]
    filled = F.sum("_n").over(Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    buckets = counts.withColumn("_c", filled).join(F.broadcast(share), reduce(and_, same("_k"), F.lit(True)))
    buckets = buckets.withColumn("_in", F.least("_n", F.col("_take") - F.col("_c") + F.col("_n"))).where("_in > 0")
    # a row for each stratum and 4096th of the hashes
    buckets = buckets.select(*[F.col(c).alias(f"_j{i}") for i, c in enumerate(strata)], F.col("_b").alias("_jb"), "_in", (F.col("_in") == F.col("_n")).alias("_all"))
    chosen = rows.join(F.broadcast(buckets), reduce(and_, same("_j"), F.col("_b") == F.col("_jb")))
    edge = chosen.where("not _all").withColumn("_i", F.row_number().over(Window.partitionBy(*strata, "_b").orderBy("_h", *keys))).where("_i <= _in")
    return chosen.where("_all").select(*df.columns).unionByName(edge.select(*df.columns))


#: Rows of which one task numbers about as many.
GROUP = 20_000


def permutation_table(df: DataFrame, features: Sequence[str], predict, y: str, scopes: dict[str, str], repeats: int = 2, seed: int = 7) -> DataFrame:
    """How much WAPE rises when a feature's values change places: scope, feature_name, importance_wape_mean and _std.

    For each repeat, two numberings of the rows by different hashes give every row a partner, within random groups of some ten
    thousand rows, so that no task numbers all; a copy of the row for each feature takes that feature's value from the partner, and
    one pass of the model judges all copies.  Scopes go by the rows as they were.  A scope without demand has nulls.
    """
    features = list(features)
    base = df.withColumn("_row", F.monotonically_increasing_id()).persist()
    groups = base.count() // GROUP + 1
    group = lambda s: F.pmod(F.xxhash64("_row", F.lit(-s)), F.lit(groups)).cast("int")
    number = lambda s, r: F.row_number().over(Window.partitionBy(group(s)).orderBy(F.xxhash64("_row", F.lit(r))))
    inside = {f"_in_{k}": F.expr(w) for k, w in scopes.items()}

    def errors(scored: DataFrame, keys: list[str]) -> DataFrame:
        within = lambda k, c: F.when(F.col(f"_in_{k}"), F.col(c))
        return scored.groupBy(*keys).agg(*[wape(within(k, y), within(k, "prediction")).alias(k) for k in scopes])

    copies = []
    for repeat in range(repeats):
        s = seed + repeat + 1
        moved = base.select(group(s).alias("_g"), number(s, s).alias("_at"), F.struct(*features).alias("_moved"))
        pairs = base.withColumns({**inside, "_g": group(s), "_at": number(s, s + 100)}).join(moved, ["_g", "_at"])
        each = pairs.withColumn("_f", F.explode(F.array(*[F.lit(i) for i in range(len(features))])))
        copies.append(each.withColumns({c: F.when(F.col("_f") == i, F.col("_moved")[c]).otherwise(F.col(c)) for i, c in enumerate(features)} | {"_repeat": F.lit(repeat)}))
    after = errors(predict(reduce(DataFrame.unionByName, copies)), ["_f", "_repeat"])
    before = errors(predict(base.withColumns(inside)), []).select(*[F.col(k).alias(f"_before_{k}") for k in scopes])
    # a row for each feature and repeat, beside the one row of the model on rows as they are
    gains = after.join(F.broadcast(before), how="cross").select("_f", F.explode(F.array(*[F.struct(F.lit(k).alias("scope"), (F.col(k) - F.col(f"_before_{k}")).alias("gain")) for k in scopes])).alias("g"))
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("_f") + 1)
    table = gains.groupBy(F.col("g.scope").alias("scope"), name.alias("feature_name")).agg(F.avg("g.gain").alias("importance_wape_mean"), F.stddev_pop("g.gain").alias("importance_wape_std"))
    rows = table.collect()
    base.unpersist()
    return df.sparkSession.createDataFrame(rows, "scope string, feature_name string, importance_wape_mean double, importance_wape_std double")


def screening_model(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], y: str, trees: int = 20):
    """A boosted-tree pipeline with one-hot categories; nulls are a value of their own.  The frame's columns stay as they are."""
    values = {f"_x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in numeric} | {f"_s_{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in categories}
    prepare = lambda d: d.withColumns(values)
    stages = [x for c in categories for x in (StringIndexer(inputCol=f"_s_{c}", outputCol=f"_i_{c}", handleInvalid="keep"), OneHotEncoder(inputCol=f"_i_{c}", outputCol=f"_o_{c}"))]
    assembler = VectorAssembler(inputCols=[*[f"_x_{c}" for c in numeric], *[f"_o_{c}" for c in categories]], outputCol="_x", handleInvalid="keep")
    model = Pipeline(stages=[*stages, assembler, GBTRegressor(featuresCol="_x", labelCol=y, predictionCol="_prediction", maxIter=trees, maxDepth=4, seed=42)]).fit(prepare(df))
    return lambda d: model.transform(prepare(d)).select(*d.columns, F.greatest("_prediction", F.lit(0.0)).alias("prediction"))


def family_of(feature: str, families: dict[str, Sequence[str]]) -> str:
    """The first family with a pattern that equals or begins the feature's name."""
    return next((name for name, patterns in families.items() if any(feature == p or feature.startswith(p) for p in patterns)), "other")


def family_ablation(train: DataFrame, test: DataFrame, features: Sequence[str], families: dict[str, Sequence[str]], y: str, trees: int = 10, categories: Sequence[str] = ()) -> DataFrame:
    """WAPE lost by leaving out each family and fitting again, overall and by horizon."""
    def fit_score(columns: Sequence[str]) -> dict[str, float]:
        scored = screening_model(train, [c for c in columns if c not in categories], [c for c in columns if c in categories], y, trees)(test)
        rows = scored.groupingSets([[], [F.col("horizon")]], F.col("horizon")).agg(wape(F.col(y), F.col("prediction")).alias("w")).collect()
        return {"ALL" if r.horizon is None else f"h{r.horizon}": r.w for r in rows}

    features = [*features, *categories]
    whole, rows = fit_score(features), []
    for family in dict.fromkeys(family_of(f, families) for f in features):
        rest = [f for f in features if family_of(f, families) != family]
        if rest:
            rows += [(family, scope, w, w - whole[scope]) for scope, w in fit_score(rest).items()]
    return train.sparkSession.createDataFrame(rows, "family string, scope string, wape_without double, delta_wape double")


def choose_features(importance: DataFrame, conf: Screen = Screen()) -> DataFrame:  # noqa: B008
    """feature_name, best, rank, selected and reason: gain in any scope, the floor by rank, and what is mandatory."""
    wide = importance.groupBy("feature_name").pivot("scope", ["ALL", "h1", "h2", "h3"]).avg("importance_wape_mean")
    best = wide.withColumn("best", F.coalesce(F.greatest("ALL", "h1", "h2", "h3"), F.lit(float("-inf"))))
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("best"), "feature_name")))  # a row for each feature
    reason = (
        F.when(F.col("feature_name").isin(*conf.mandatory), "MANDATORY_FOR_POOLED").when(F.col("best") > conf.min_gain, "PERMUTATION_IMPORTANCE")
        .when(F.col("rank") <= conf.min_selected, "MIN_FEATURE_FLOOR").otherwise("NOT_SELECTED")
    )
    return ranked.select("feature_name", "best", "rank", (reason != "NOT_SELECTED").alias("selected"), reason.alias("reason"))
