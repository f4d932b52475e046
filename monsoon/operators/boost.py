"""Boosted trees for sparse demand: Tweedie and logistic loss, categories, and many models grown in one pass over the rows.

A model knows a row by the bins of its features only, so rows of equal bins, horizon and phase are one weighted row with a count,
a count of positives and a sum of demand, made by an aggregation in Spark: gradients, Hessians and losses are linear in these.
All models (origins, horizons, parts, and for each the selecting and the final fit) grow level by level together: a task adds up
sums by model, node, feature and bin over its blocks of weighted rows, the sums are shuffled by model and node and added, and best
splits follow from them; the driver sees a row a node.  FIT is a prefix in time, so one order of a block serves every origin.

The number of trees of each model is that of least loss on its calibration rows.  The final fit over all rows grows beside the
selecting one; as boosting adds trees without changing those before, its first so many trees are the fit of that size.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.operators.scores import Y
from monsoon.schema import DataError
from monsoon.sources.stored import store

DEMAND, OCCURRENCE, QUANTITY = "demand", "occurrence", "quantity"


@dataclass(frozen=True)
class Boost:
    rate: float = 0.3
    max_trees: int = 25
    depth: int = 4
    #: Bins of a feature, the first one for missing or unseen values.
    bins: int = 32
    l2: float = 1.0
    min_rows: int = 20
    #: Of the Tweedie loss, between 1 and 2.
    power: float = 1.5
    #: Trees without a better loss on the calibration rows after which a model stops.
    patience: int = 3
    #: Hessian that a category's gradient is weighed against in the order of categories.
    smooth: float = 10.0
    #: Trees after which the state is written, which cuts its lineage.
    cut: int = 10


@dataclass(frozen=True)
class Job:
    """A model: the horizon and part it is for, FIT before the month fit_end, CAL from it to cal_end (numbers of months)."""

    key: str
    horizon: int
    part: str
    fit_end: int
    cal_end: int
    #: Features that the model may not split on.
    without: tuple[str, ...] = ()


def month_number(month: Column) -> Column:
    return F.year(month) * 12 + F.month(month)


# ---- bins


@dataclass(frozen=True)
class Binning:
    """Cut points of numbers and values of categories; bin 0 is for missing numbers, and for null and unseen categories."""

    numeric: tuple[tuple[str, tuple[float, ...]], ...]
    categories: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def names(self) -> list[str]:
        return [n for n, _ in (*self.numeric, *self.categories)]

    def columns(self) -> list[Column]:
        return [F.col(n).cast("double").alias(f"x{i}") for i, (n, _) in enumerate(self.numeric)] + [F.col(n).cast("string").alias(f"c{i}") for i, (n, _) in enumerate(self.categories)]

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        """Bins by feature and row."""
        out = np.zeros((len(self.names), batch.num_rows), np.uint8)
        for i, (_, cuts) in enumerate(self.numeric):
            column = batch.column(f"x{i}")
            x = column.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            out[i] = np.where(np.isnan(x), 0, np.searchsorted(np.asarray(cuts, float), x, "left") + 1)
        for i, (_, values) in enumerate(self.categories):
            column = batch.column(f"c{i}")
            at = pa.compute.index_in(column, value_set=pa.array(values, column.type)).fill_null(-1).to_numpy(zero_copy_only=False)
            out[len(self.numeric) + i] = at + 1
        return out


def binning(df: DataFrame, numeric: Sequence[str], categories: Sequence[str] = (), conf: Boost = Boost()) -> Binning:  # noqa: B008
    """Bins from the rows of df, which should be those that every FIT has: zero and quantiles of what is not zero; of categories
    the most frequent values (the rest, which shares bin 0, has few rows each)."""
    n = conf.bins - 3
    shares = [(i + 1) / (n + 1) for i in range(n)]
    value = lambda c: F.col(c).cast("double")
    known = lambda c: F.when(~F.isnan(value(c)) & (value(c) != 0), value(c))
    found = df.agg(*[F.percentile_approx(known(c), shares, 10_000).alias(c) for c in numeric]).first() if numeric else None
    cuts = tuple((c, tuple(sorted({0.0, *(found[c] or [])}))) for c in numeric)
    values = []
    for c in categories:
        rows = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "v").limit(conf.bins - 1).collect()
        values.append((c, tuple(r.v for r in rows)))
    return Binning(cuts, tuple(values))


# ---- weighted rows

_ROWS = "horizon int, month int, main boolean, bins binary, n long, n_pos long, demand double"


def weighted_rows(df: DataFrame, binned: Binning, jobs: Sequence[Job], main: Column, target: str = Y) -> DataFrame:
    """horizon, month, main, bins with n rows, n_pos positive ones and their demand.

    df has horizon, target_month, the target and the features.  Rows without a target, or after the last calibration month, go;
    negative targets count as 0.  Months that every FIT has are one.  main tells the rows that may calibrate.
    """
    first, last = min(j.fit_end for j in jobs), max(j.cal_end for j in jobs)
    month, y = month_number(F.col("target_month")), F.col(target).cast("double")
    rows = df.where(y.isNotNull() & ~F.isnan(y) & (month <= last) & F.col("horizon").isin(*sorted({j.horizon for j in jobs})))
    early = month < first
    rows = rows.select(F.col("horizon").cast("int").alias("horizon"), F.when(early, first - 1).otherwise(month).cast("int").alias("month"), (early | F.coalesce(main, F.lit(False))).alias("main"), F.greatest(y, F.lit(0.0)).alias("y"), *binned.columns())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            head = np.stack([batch.column(c).cast(pa.int32()).to_numpy(zero_copy_only=False) for c in ("horizon", "month", "main")], 1).astype(np.int32)
            keys = np.ascontiguousarray(np.concatenate([head.view(np.uint8).reshape(len(head), -1), binned.of(batch).T], 1))
            unique, group = np.unique(keys.view(f"V{keys.shape[1]}").ravel(), return_inverse=True)
            y_ = batch.column("y").to_numpy(zero_copy_only=False)
            parts = unique.view(np.uint8).reshape(len(unique), -1)
            h, m, ok = np.ascontiguousarray(parts[:, :12]).view(np.int32).T
            total = lambda w: np.bincount(group, w, len(unique))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(m), pa.array(ok == 1), pa.array([r.tobytes() for r in parts[:, 12:]], pa.binary()), pa.array(total(np.ones(len(y_))).astype(np.int64)), pa.array(total(y_ > 0).astype(np.int64)), pa.array(total(y_))],
                names=["horizon", "month", "main", "bins", "n", "n_pos", "demand"],
            )

    packed = rows.mapInArrow(pack, _ROWS)
    return packed.groupBy("horizon", "month", "main", "bins").agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos"), F.sum("demand").alias("demand"))


# ---- trees: nodes 0; 1, 2; 3, 4, 5, 6...


@dataclass
class Tree:
    feature: np.ndarray  # of each node, -1 for a leaf
    left: np.ndarray  # by node and bin, whether a row goes left
    value: np.ndarray

    @staticmethod
    def empty(depth: int, bins: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int16), np.zeros((n, bins), bool), np.zeros(n))

    def node(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row after `depth` steps."""
        at, rows = np.zeros(bins.shape[1], np.int32), np.arange(bins.shape[1])
        for _ in range(depth):
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                break
            go = self.left[at, bins[np.maximum(feature, 0), rows]]
            at = np.where(inner, 2 * at + 2 - go, at)
        return at


def derivatives(part: str, power: float, score: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and Hessians of weighted rows: n rows with targets that add up to y, all of one score."""
    if part == OCCURRENCE:
        p = 1 / (1 + np.exp(-score))
        return n * p - y, n * p * (1 - p)
    a, b = np.exp((1 - power) * score), np.exp((2 - power) * score)
    return n * b - y * a, (2 - power) * n * b - (1 - power) * y * a


def loss(part: str, power: float, score: np.ndarray, n: np.ndarray, y: np.ndarray) -> float:
    if part == OCCURRENCE:
        return float(np.sum(n * np.logaddexp(0, score) - y * score))
    return float(np.sum(n * np.exp((2 - power) * score) / (2 - power) - y * np.exp((1 - power) * score) / (1 - power)))


def histogram(bins: np.ndarray, node: np.ndarray, nodes: int, width: int, weights: Sequence[np.ndarray]) -> np.ndarray:
    """Sums of each weight by node, feature and bin; rows whose node is negative are left out."""
    inside = node >= 0
    if not inside.all():
        bins, node, weights = bins[:, inside], node[inside], [w[inside] for w in weights]
    out = np.empty((nodes, len(bins), width, len(weights)))
    base = node.astype(np.int64) * width
    for f, b in enumerate(bins):
        at = base + b
        for k, w in enumerate(weights):
            out[:, f, :, k] = np.bincount(at, w, nodes * width).reshape(nodes, width)
    return out


def best_splits(sums: np.ndarray, categorical: Sequence[bool], conf: Boost, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each node the feature (-1 where no split gains), bins that go left, and the sums on both sides, from sums by node, feature
    and bin of gradient, Hessian and count.

    Numbers are cut in their order, with missing values (bin 0) on the better side.  Categories are ordered by gradient over
    Hessian, which makes the best of all subsets a prefix.  Bins without rows go where most rows do; of numbers, those between two
    cuts are on the far side.  Of equal gains the first feature and cut counts.  allowed says by node which features may split it.
    """
    nodes, features, width, _ = sums.shape
    which = np.asarray(categorical, bool)
    used, total = sums[..., 2] > 0, sums[:, 0].sum(1)
    ratio = np.where(used, sums[..., 0] / (sums[..., 1] + conf.smooth), np.inf)
    by_ratio = np.argsort(ratio, axis=2, kind="stable")
    natural = np.broadcast_to(np.arange(width), (nodes, features, width))
    orders = np.stack([np.where(which[:, None], by_ratio, o) for o in (natural, np.roll(natural, -1, 2))], 2)  # missing values first, then last
    left = np.cumsum(np.take_along_axis(sums[:, :, None], orders[..., None], 3), 3)[:, :, :, :-1]
    right = total[:, None, None, None] - left
    score = lambda x: x[..., 0] ** 2 / (x[..., 1] + conf.l2)
    with np.errstate(all="ignore"):  # sides without rows
        gain = score(left) + score(right) - score(total)[:, None, None, None]
    gain[(left[..., 2] < max(conf.min_rows, 1)) | (right[..., 2] < max(conf.min_rows, 1)) | ~np.isfinite(gain)] = 0
    if allowed is not None:
        gain[~allowed] = 0
    gain = gain.reshape(nodes, -1)
    top = gain.max(1)
    at = np.argmax(gain >= (top * (1 - 1e-9) - 1e-12)[:, None], 1)
    feature, order, cut = np.unravel_index(at, (features, 2, width - 1))
    k = np.arange(nodes)
    place = np.argsort(orders[k, feature, order], 1)  # of each bin in the order
    mask = place <= cut[:, None]
    a, b = left[k, feature, order, cut], right[k, feature, order, cut]
    empty = ~used[k, feature] & (which[feature][:, None] | (np.arange(width) == 0))
    mask = np.where(empty, (a[:, 2] >= b[:, 2])[:, None], mask)
    none = top <= 1e-9
    return np.where(none, -1, feature), mask, np.where(none[:, None], total, a), np.where(none[:, None], total, b)


def best_split(sums: np.ndarray, categorical: Sequence[bool], conf: Boost) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """best_splits for one node."""
    feature, mask, a, b = best_splits(sums[None], categorical, conf)
    return int(feature[0]), mask[0], a[0], b[0]


# ---- the fit in Spark

_STATE = "horizon int, month binary, main binary, bins binary, n binary, n_pos binary, demand binary, scores binary"


@dataclass(frozen=True)
class _Block:
    """Weighted rows of one horizon, by month, with a score a model (two a job: selecting and final fit)."""

    bins: np.ndarray
    month: np.ndarray
    main: np.ndarray
    n: np.ndarray
    n_pos: np.ndarray
    demand: np.ndarray
    scores: np.ndarray

    def rows(self, job: Job, scale: float, final: bool) -> tuple[np.ndarray | slice, np.ndarray, np.ndarray]:
        """A fit's rows, their counts and sums of targets."""
        end = int(np.searchsorted(self.month, job.fit_end, "left"))
        at = slice(0, end)
        if final:
            stop = int(np.searchsorted(self.month, job.cal_end, "right"))
            at = np.concatenate((np.arange(end), end + np.flatnonzero(self.main[end:stop])))
        return self._weights(job, scale, at)

    def held_out(self, job: Job, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        end, stop = (int(np.searchsorted(self.month, m, side)) for m, side in ((job.fit_end, "left"), (job.cal_end, "right")))
        return self._weights(job, scale, end + np.flatnonzero(self.main[end:stop]))

    def _weights(self, job: Job, scale: float, at: np.ndarray | slice) -> tuple[np.ndarray | slice, np.ndarray, np.ndarray]:
        if job.part == OCCURRENCE:
            return at, self.n[at], self.n_pos[at]
        if job.part == QUANTITY:
            at = np.arange(len(self.n))[at]
            at = at[self.n_pos[at] > 0]
        return at, (self.n_pos if job.part == QUANTITY else self.n)[at], self.demand[at] / scale

    def used(self, job: Job) -> np.ndarray | slice:
        """The rows whose scores a job's models need."""
        return np.flatnonzero(self.n_pos > 0) if job.part == QUANTITY else slice(None)


def _blocks(rows: DataFrame, jobs: Sequence[Job], starts: dict[str, tuple[float, float]], parts: int) -> DataFrame:
    """Weighted rows as blocks of a horizon, sorted by month, each model's score being its start."""
    by_horizon = {h: [j for j in jobs if j.horizon == h] for h in {j.horizon for j in jobs}}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            horizon, month = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("horizon", "month"))
            out = []
            for h in np.unique(horizon):
                at = np.flatnonzero(horizon == h)
                at = at[np.argsort(month[at], kind="stable")]
                take = batch.take(pa.array(at))
                bins = np.frombuffer(b"".join(take.column("bins").to_pylist()), np.uint8).reshape(len(at), -1).T
                own = by_horizon[int(h)]
                scores = np.repeat([starts[j.key][0] for j in own], 2)[:, None] + np.zeros(len(at))
                number = lambda c: take.column(c).to_numpy(zero_copy_only=False).astype(float).tobytes()  # noqa: B023, E731
                out.append((int(h), month[at].astype(np.int32).tobytes(), take.column("main").to_numpy(zero_copy_only=False).tobytes(), bins.tobytes(), number("n"), number("n_pos"), number("demand"), scores.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*out, strict=True))], names=[c.split()[0] for c in _STATE.split(", ")])

    return rows.repartition(parts).mapInArrow(build, _STATE)


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, int, _Block]]:
    column = {n: batch.column(n) for n in batch.schema.names}
    for i in range(batch.num_rows):
        raw = {n: c[i].as_py() for n, c in column.items()}
        n = np.frombuffer(raw["n"])
        yield i, raw["horizon"], _Block(
            np.frombuffer(raw["bins"], np.uint8).reshape(-1, len(n)), np.frombuffer(raw["month"], np.int32), np.frombuffer(raw["main"], bool), n, np.frombuffer(raw["n_pos"]), np.frombuffer(raw["demand"]),
            np.frombuffer(raw["scores"]).reshape(-1, len(n)),
        )


@dataclass
class _Growing:
    """All models of a fit: model 2 j is the selecting fit of job j, model 2 j + 1 the final one."""

    jobs: list[Job]
    starts: dict[str, tuple[float, float]]  # score before the first tree, scale of the target
    names: list[str]  # of features
    categorical: list[bool]
    conf: Boost

    def of(self, horizon: int) -> list[tuple[int, int, Job]]:
        """Place in the block's scores, number of the model, job."""
        own = [(j, job) for j, job in enumerate(self.jobs) if job.horizon == horizon]
        return [(2 * i + k, 2 * j + k, job) for i, (j, job) in enumerate(own) for k in (0, 1)]

    def update(self, state: DataFrame, trees: dict[int, Tree]) -> DataFrame:
        """state with what the trees add to the scores."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = []
                for _, horizon, block in _read(batch):
                    new = block.scores.copy()
                    for place, model, job in self.of(horizon):
                        if model in trees:
                            at = block.used(job)
                            new[place, at] += trees[model].value[trees[model].node(block.bins[:, at], self.conf.depth)]
                    scores.append(new.tobytes())
                yield batch.set_column(batch.schema.get_field_index("scores"), "scores", pa.array(scores, pa.binary()))

        return state.mapInArrow(run, _STATE)

    def sums(self, state: DataFrame, trees: dict[int, Tree], level: int, judge: bool) -> DataFrame:
        """model, node and its sums by feature and bin; with judge also the losses on calibration rows, as node -1."""
        conf, nodes = self.conf, 2**level

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for _, horizon, block in _read(batch):
                    for place, model, job in self.of(horizon):
                        scale, score = self.starts[job.key][1], block.scores[place]
                        if judge and model % 2 == 0:
                            at, n, y = block.held_out(job, scale)
                            held[model] = held.get(model, 0) + np.array([loss(job.part, conf.power, score[at], n, y), n.sum()])
                        if model not in trees:
                            continue
                        at, n, y = block.rows(job, scale, bool(model % 2))
                        g, h = derivatives(job.part, conf.power, score[at], n, y)
                        bins = block.bins[:, at]
                        node = trees[model].node(bins, level) - (nodes - 1)  # negative in leaves of higher levels
                        here = histogram(bins, node, nodes, conf.bins, (g, h, n))
                        total[model] = total[model] + here if model in total else here
            rows = [(model, k, by_node[k].tobytes()) for model, by_node in total.items() for k in range(nodes) if by_node[k, 0, :, 2].any()] + [(model, -1, x.tobytes()) for model, x in held.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["model", "node", "sums"])

        return state.mapInArrow(run, "model int, node int, sums binary")

    def splits(self, sums: DataFrame, parts: int) -> list:
        """A row for each node: its best split and the sums on both sides; for node -1 the loss and its rows."""
        conf, categorical = self.conf, self.categorical
        may = np.array([[n not in job.without for n in self.names] for job in self.jobs])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for model, node, raw in zip(*(batch.column(c).to_pylist() for c in ("model", "node", "sums")), strict=True):
                    x = np.frombuffer(raw)
                    total[model, node] = total[model, node] + x if (model, node) in total else x
            rows = [(model, node, -1, b"", x.tolist(), []) for (model, node), x in total.items() if node < 0]
            keys = [key for key in total if key[1] >= 0]
            for some in (keys[i : i + 64] for i in range(0, len(keys), 64)):
                found = best_splits(np.stack([total[key].reshape(len(categorical), conf.bins, 3) for key in some]), categorical, conf, may[[key[0] // 2 for key in some]])
                rows += [(*key, int(feature), mask.tobytes(), a.tolist(), b.tolist()) for key, feature, mask, a, b in zip(some, *found, strict=True)]
            if rows:
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["model", "node", "feature", "left_bins", "a", "b"])

        return sums.repartition(parts, "model", "node").mapInArrow(run, "model int, node int, feature int, left_bins binary, a array<double>, b array<double>").collect()

    def grow(self, state: DataFrame, models: Sequence[int], judge: bool, parts: int) -> tuple[dict[int, Tree], dict[int, tuple[float, float]]]:
        """The next tree of each model, level by level, and the losses before it on calibration rows."""
        conf = self.conf
        trees = {m: Tree.empty(conf.depth, conf.bins) for m in models}
        losses: dict[int, tuple[float, float]] = {}
        for level in range(conf.depth if models else 1):
            first, grew = 2**level - 1, False
            for r in self.splits(self.sums(state, trees, level, judge and level == 0), parts):
                if r.node < 0:
                    losses[r.model] = tuple(r.a)
                    continue
                tree, at = trees[r.model], first + r.node
                weight = lambda s: -conf.rate * s[0] / (s[1] + conf.l2)
                if r.feature < 0:
                    tree.value[at] = weight(r.a)
                else:
                    tree.feature[at], tree.left[at] = r.feature, np.frombuffer(r.left_bins, bool)
                    tree.value[2 * at + 1], tree.value[2 * at + 2] = weight(r.a), weight(r.b)
                    grew = True
            if not grew:
                break
        return trees, losses


@dataclass
class Booster:
    """A fitted model: a score before the first tree, a scale, and trees."""

    job: Job
    start: float
    scale: float
    trees: list[Tree]
    audit: dict = field(default_factory=dict)

    def predict(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Demand, or for an occurrence its chance."""
        score = np.full(bins.shape[1], self.start)
        for tree in self.trees:
            score += tree.value[tree.node(bins, depth)]
        return 1 / (1 + np.exp(-score)) if self.job.part == OCCURRENCE else self.scale * np.exp(score)


@dataclass
class Boosters:
    binned: Binning
    conf: Boost
    models: dict[str, Booster]

    def transform(self, df: DataFrame, outputs: dict[str, Column]) -> DataFrame:
        """df with a column for each output: the prediction of the model whose key its expression names, null where there is none."""
        names, columns = list(outputs), df.columns
        if set(names) & set(columns):
            raise DataError(f"{sorted(set(names) & set(columns))} are columns already")
        whole = df.select(F.struct(*[F.col(c) for c in columns]).alias("row"), *[outputs[n].cast("string").alias(f"k{i}") for i, n in enumerate(names)], *self.binned.columns())
        row_type = whole.schema["row"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, out = self.binned.of(batch), []
                for i in range(len(names)):
                    keys = batch.column(f"k{i}").dictionary_encode()
                    code, found = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False), np.full(batch.num_rows, np.nan)
                    for k, key in enumerate(keys.dictionary.to_pylist()):
                        if key in self.models:
                            at = np.flatnonzero(code == k)
                            found[at] = self.models[key].predict(bins[:, at], self.conf.depth)
                    out.append(pa.array(found, mask=np.isnan(found)))
                yield pa.RecordBatch.from_arrays([batch.column("row"), *out], names=["row", *(f"o{i}" for i in range(len(names)))])

        scored = whole.mapInArrow(run, f"row {row_type}, " + ", ".join(f"o{i} double" for i in range(len(names))))
        return scored.select("row.*", *[F.col(f"o{i}").alias(n) for i, n in enumerate(names)])

    def audit(self, spark: SparkSession) -> DataFrame:
        """key, horizon, part, trees, rows and positive rows of both phases, and the loss on calibration rows without and with trees."""
        rows = [(k, m.job.horizon, m.job.part, len(m.trees), *(m.audit[x] for x in ("fit_rows", "cal_rows", "fit_positive", "cal_positive", "loss_before", "loss_after"))) for k, m in self.models.items()]
        return spark.createDataFrame(rows, "model string, horizon int, part string, trees int, fit_rows long, cal_rows long, fit_positive long, cal_positive long, loss_before double, loss_after double")

    def save(self, spark: SparkSession, path: str) -> None:
        """A line for the bins and one for each model under path, which must not exist."""
        lines = [("", json.dumps({"binned": asdict(self.binned), "conf": asdict(self.conf)}))]
        for key, m in self.models.items():
            trees = [{"feature": t.feature.tolist(), "left": [np.flatnonzero(x).tolist() for x in t.left], "value": t.value.tolist()} for t in m.trees]
            lines.append((key, json.dumps({"job": asdict(m.job), "start": m.start, "scale": m.scale, "trees": trees, "audit": m.audit})))
        spark.createDataFrame(lines, "key string, model string").write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosters:
        """What save() has written."""
        lines = {r.key: json.loads(r.model) for r in spark.read.parquet(path).collect()}
        head, conf = lines.pop(""), None
        conf = Boost(**head["conf"])
        fixed = lambda pairs: tuple((n, tuple(v)) for n, v in pairs)
        models = {}
        for key, x in lines.items():
            trees = []
            for t in x["trees"]:
                tree = Tree(np.array(t["feature"], np.int16), np.zeros((len(t["feature"]), conf.bins), bool), np.array(t["value"]))
                for node, bins in enumerate(t["left"]):
                    tree.left[node, bins] = True
                trees.append(tree)
            models[key] = Booster(Job(**x["job"] | {"without": tuple(x["job"]["without"])}), x["start"], x["scale"], trees, x["audit"])
        return Boosters(Binning(fixed(head["binned"]["numeric"]), fixed(head["binned"]["categories"])), conf, models)


def _start(rows: DataFrame, jobs: Sequence[Job]) -> tuple[dict[str, tuple[float, float]], dict[str, dict]]:
    """Scores before the first tree, scales and counts, from sums by month cumulated for every job."""
    sums = rows.groupBy("horizon", "month", "main").agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos"), F.sum("demand").alias("demand")).collect()
    starts, audits = {}, {}
    for job in jobs:
        fit = [r for r in sums if r.horizon == job.horizon and r.month < job.fit_end]
        cal = [r for r in sums if r.horizon == job.horizon and job.fit_end <= r.month <= job.cal_end and r.main]
        n, n_pos, demand = (sum(r[c] for r in fit) for c in ("n", "n_pos", "demand"))
        audits[job.key] = {"fit_rows": n, "cal_rows": sum(r.n for r in cal), "fit_positive": n_pos, "cal_positive": sum(r.n_pos for r in cal)}
        if not n_pos or (job.part == OCCURRENCE and n_pos == n):
            # one value throughout: nothing to learn
            starts[job.key] = (0.0, 0.0) if job.part != OCCURRENCE else (30.0 if n_pos else -30.0, 0.0)
        elif job.part == OCCURRENCE:
            starts[job.key] = (float(np.log(n_pos / (n - n_pos))), 1.0)
        else:
            starts[job.key] = (0.0, demand / (n_pos if job.part == QUANTITY else n))
    return starts, audits


def fit(df: DataFrame, binned: Binning, jobs: Sequence[Job], main: Column, conf: Boost = Boost(), target: str = Y, require: Callable[[Job, dict], None] = lambda job, counts: None) -> Boosters:  # noqa: B008
    """Models of all jobs over the rows of df, grown together; see weighted_rows for what df needs.  require sees each job's counts
    (fit_rows, cal_rows, fit_positive, cal_positive) before anything is grown, and may raise.

    A job whose FIT has no positive row, or only positive ones for an occurrence, is a constant.  Without calibration rows a job
    gets max_trees trees.  Raises without jobs, or if keys repeat.
    """
    if not jobs or len({j.key for j in jobs}) < len(jobs):
        raise DataError("jobs need keys of their own")
    spark = df.sparkSession
    parts = max(1, spark.sparkContext.defaultParallelism)
    rows = store(weighted_rows(df, binned, jobs, main, target), "weighted")
    starts, audits = _start(rows, jobs)
    for job in jobs:
        require(job, audits[job.key])
    learn = [j for j in jobs if starts[j.key][1] > 0]
    growing = _Growing(learn, starts, binned.names, [False] * len(binned.numeric) + [True] * len(binned.categories), conf)
    state = store(_blocks(rows, learn, starts, max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))), "boost") if learn else None
    grown: dict[int, list[Tree]] = {m: [] for m in range(2 * len(learn))}
    losses: dict[int, list[float]] = {j: [] for j in range(len(learn))}
    active = set(losses)
    stale = None
    for number in range(conf.max_trees + 1):
        if not active:
            break
        models = [2 * j + k for j in sorted(active) for k in (0, 1)] if number < conf.max_trees else []
        trees, found = growing.grow(state, models, True, parts)
        if stale is not None:
            stale.unpersist()  # the state after it has been read whole
        for j in list(active):
            value, n = found.get(2 * j, (0.0, 0.0))
            losses[j].append(value / n if n else -float(number))  # without calibration rows each tree counts as better
            if len(losses[j]) - 1 - int(np.argmin(losses[j])) >= conf.patience:
                active.discard(j)
        trees = {m: t for m, t in trees.items() if m // 2 in active}
        if not trees:
            break
        for m, t in trees.items():
            grown[m].append(t)
        stale, state = state, growing.update(state, trees)
        state = store(state, "boost") if (number + 1) % conf.cut == 0 else state.persist()
    for df_ in (stale, state):
        if df_ is not None:
            df_.unpersist()
    out = {}
    for j, job in enumerate(learn):
        best = int(np.argmin(losses[j]))
        audit = audits[job.key] | {"loss_before": losses[j][0], "loss_after": losses[j][best]}
        out[job.key] = Booster(job, *starts[job.key], grown[2 * j + 1][:best], audit)
    for job in jobs:
        if job.key not in out:
            out[job.key] = Booster(job, *starts[job.key], [], audits[job.key] | {"loss_before": 0.0, "loss_after": 0.0})
    return Boosters(binned, conf, out)
