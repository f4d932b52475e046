"""Near-duplicate vectors by collision counting over many one-dimensional projections.

Unit vectors are projected on `projections` random directions.  The window around a query holds the vectors whose
projection differs by at most `width`; a pair is a candidate if it lies in the window of the first projection, the anchor
(`reach` wide), and collides in at least `needed` of all windows.  reach, width and needed are calibrated: the difference of
two unit vectors at the threshold is normal along a random direction with a known deviation, so the chance that such a pair
leaves the anchor's window or has fewer collisions is known, and kept below `miss`.  Candidates are verified by their cosine
in double precision.

Equal vectors are one node with a weight.  Nodes lie in blocks, ranges of the sorted anchor projection; blocks within reach
of each other meet, and there each slice of queries meets the sorted vectors of its window.  A pair of blocks is one row and
gives counts of links for each vector and a spanning forest of the links it found, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of, map_batches, rekey
from monsoon.llm.components import components


@dataclass(frozen=True)
class Collisions:
    """Blocks hold `block` vectors and about `block_bytes` of their components at most, fewer where there would be less than
    `least_blocks`; a task holds two blocks."""

    threshold: float = 0.95
    projections: int = 24
    deviations: float = 2.2
    miss: float = 1e-3
    block: int = 32768
    block_bytes: int = 64_000_000
    least_blocks: int = 12
    seed: int = 11

    @property
    def _deviation(self) -> float:
        return math.sqrt(2 - 2 * self.threshold)

    @property
    def width(self) -> float:
        return self.deviations * self._deviation

    @property
    def reach(self) -> float:
        """The anchor's window, which a pair at the threshold leaves with probability miss / 2."""
        return NormalDist().inv_cdf(1 - self.miss / 4) * self._deviation

    @property
    def needed(self) -> int:
        """The most collisions that a pair at the threshold still reaches with probability 1 - miss / 2."""
        p = math.erf(self.deviations / math.sqrt(2))
        tail, n = 0.0, self.projections
        for k in range(n + 1):
            tail += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if tail > self.miss / 2:
                return k
        return n

    def directions(self, dim: int) -> np.ndarray:
        return np.random.default_rng(self.seed).standard_normal((dim, self.projections))


def _matrix(raw: list[bytes], dim: int) -> np.ndarray:
    m = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    return m / np.linalg.norm(m, axis=1)[:, None]


_STEPS = 1000  # a width in steps of the projections as 16-bit numbers
_TILE = 128, 2048


def block_pair(x: np.ndarray, y: np.ndarray | None, conf: Collisions) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (rows of x, rows of y) of two blocks of unit vectors; of one block, if y is None, each pair once.

    Both blocks come in any order and are sorted by the anchor here; collisions are counted tile by tile.
    """
    own = y is None
    y = x if own else y
    directions = conf.directions(x.shape[1])
    px, py = (x @ directions).T, (y @ directions).T
    ox, oy = np.argsort(px[0], kind="stable"), np.argsort(py[0], kind="stable")
    px, py, x, y = px[:, ox], py[:, oy], x[ox], y[oy]
    reach, spare = conf.reach * (1 + 1e-9) + 1e-9, conf.projections - conf.needed
    # two steps more, as both ends are rounded
    wide = _STEPS + 2
    qx, qy = (np.clip(np.floor(p / conf.width * _STEPS), -30_000, 30_000).astype(np.int16) for p in (px, py))
    qx = (qx + np.int16(wide)).view(np.uint16)
    qy = qy.view(np.uint16)
    head = min(conf.projections, max(8, conf.projections // 2))
    gap, over, missed = np.empty(_TILE, np.uint16), np.empty(_TILE, bool), np.empty(_TILE, np.uint8)
    for at in range(0, len(x), _TILE[0]):
        stop = min(at + _TILE[0], len(x))
        first = at if own else int(np.searchsorted(py[0], px[0, at] - reach))
        last = int(np.searchsorted(py[0], px[0, stop - 1] + reach, "right"))
        for left in range(first, last, _TILE[1]):
            right = min(left + _TILE[1], last)
            shape = slice(0, stop - at), slice(0, right - left)
            g, o, m = gap[shape], over[shape], missed[shape]
            m[:] = 0
            for j in range(head):
                # wraps round below zero, so that one comparison tells both sides
                np.subtract(qx[j, at:stop, None], qy[j, None, left:right], out=g)
                np.greater(g, np.uint16(2 * wide), out=o)
                np.add(m, o.view(np.uint8), out=m)
            i, k = np.nonzero(m <= spare)
            if not len(i):
                continue
            count = m[i, k]
            i, k = i + at, k + left
            for j in range(head, conf.projections):
                count = count + ((qx[j, i] - qy[j, k]) > np.uint16(2 * wide))
                live = count <= spare
                i, k, count = i[live], k[live], count[live]
            live = np.abs(px[0, i] - py[0, k]) <= reach
            if own:
                live &= i < k
            i, k = i[live], k[live]
            for s in range(0, len(i), 100_000):
                a, b = i[s : s + 100_000], k[s : s + 100_000]
                link = np.einsum("ij,ij->i", x[a], y[b]) >= conf.threshold
                if link.any():
                    yield ox[a[link]], oy[b[link]]


def _pairs(conf: Collisions):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            sides = []
            for name in ("xs", "ys") if row["ys"] is not None else ("xs",):
                sides.append((np.array([v["row"] for v in row[name]], np.int64), _matrix([v["raw"] for v in row[name]], row["dim"])))
            ids = np.concatenate([s[0] for s in sides])
            weight = np.concatenate([np.array([v["copies"] for v in row[name]], np.int64) for name in ("xs", "ys") if row[name] is not None])
            shift = len(sides[0][0]) if len(sides) > 1 else 0
            degree = np.zeros(len(ids), np.int64)
            parent = np.arange(len(ids))
            for a, b in block_pair(sides[0][1], sides[1][1] if shift else None, conf):
                b = b + shift
                np.add.at(degree, a, weight[b])
                np.add.at(degree, b, weight[a])
                _hook(parent, a, b)
            linked = np.flatnonzero(degree)
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(degree[linked]), pa.array(ids[parent[linked]])], ["row", "links", "to"])

    return run


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins a[i] with b[i] in a forest in which every node points to its root."""
    while len(a):
        p, q = parent[a], parent[b]
        apart = p != q
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        if len(a):
            np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]


def near_vectors(spark: SparkSession, table: DataFrame, conf: Collisions | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each row of table: id, n_links (long), component_id (the least id reachable), kept (id is component_id).

    Vectors that are null, empty, zero or hold nulls, NaN or infinities link with nothing; nor do vectors of different
    dimensions.  Rows that repeat an id are vectors of their own (and link if near).  A null id is only its component's id
    if all its ids are null.  An empty table gives no rows; other columns aren't read.
    """
    conf = conf or Collisions()
    scratch = Scratch(spark, "vectors")
    vec = _col_of(vec_col).cast("array<double>")
    rows = table.select(_col_of(id_col).alias("id"), vec.alias("v"), F.monotonically_increasing_id().alias("n"))
    # rows get numbers in random order, as components() likes them
    rows = scratch.table(rows.select("id", "v", F.xxhash64("n").alias("row")), "rows")
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    good = rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite).where(F.exists("v", lambda x: x != 0))

    def raw(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out, first, dims = [], [], []
        for v in batch.column(1).to_pylist():
            a = np.array(v, np.float64)
            a = a / np.abs(a).max()  # no overflow in its norm
            out.append(a.tobytes())
            dims.append(len(a))
            first.append(float(a @ conf.directions(len(a))[:, 0] / np.linalg.norm(a)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32()), pa.array(first, pa.float64())], ["row", "raw", "dim", "p"])

    packed = scratch.table(map_batches(good.select("row", "v"), raw, "row long, raw binary, dim int, p double", 1024).withColumns({"h1": F.xxhash64("raw"), "h2": F.xxhash64(F.lit(1), "raw")}), "packed")
    # equal vectors are one node, the row of the least number
    alike = packed.groupBy("dim", "h1", "h2").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    alike = scratch.table(alike, "alike")
    nodes = packed.join(alike.select(rekey(F.col("node")).alias("k"), "copies"), rekey(F.col("row")) == F.col("k")).select("row", "raw", "dim", "p", "copies")
    # blocks are equal shares of the anchor's projection
    marks = [i / 256 for i in range(1, 256)]
    cuts = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.percentile_approx("p", marks, 10000).alias("q"))
    most = F.greatest(F.lit(1), F.least(F.lit(conf.block), F.floor(F.lit(conf.block_bytes) / (8 * F.col("dim")))))
    n = F.greatest(F.ceil(F.col("n") / most), F.least(F.lit(conf.least_blocks), F.ceil(F.col("n") / F.lit(256)))).alias("blocks")
    cuts = scratch.table(cuts.select(F.col("dim").alias("d"), n, "q"), "cuts")
    # vectors are dealt by their random number over all the shares that their projection reaches: one, or with ties those
    # from the first to the last quantile equal to it
    first, last = F.size(F.filter("q", lambda x: x < F.col("p"))), F.size(F.filter("q", lambda x: x <= F.col("p")))
    below = (first + (last - first + 1) * F.pmod(F.col("row"), F.lit(1_000_000)) / 1e6) / (len(marks) + 1)
    block = F.least(F.floor(below * F.col("blocks")), F.col("blocks") - 1).cast("long").alias("block")
    placed = nodes.join(cuts, F.col("dim") == F.col("d")).select("row", "raw", "dim", "p", "copies", block)
    blocks = placed.groupBy("dim", "block").agg(F.collect_list(F.struct("row", "raw", "copies")).alias("vs"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    blocks = scratch.table(blocks, "blocks")
    other = blocks.select(F.col("dim").alias("e"), F.col("block").alias("other"), F.col("lo").alias("from"), F.col("hi").alias("to"))
    near = (F.col("block") <= F.col("other")) & (F.col("from") <= F.col("hi") + conf.reach) & (F.col("lo") <= F.col("to") + conf.reach)
    mates = scratch.table(blocks.select("dim", "block", "lo", "hi").join(other, (F.col("dim") == F.col("e")) & near).select("dim", "block", "other"), "mates")
    one, two = (blocks.select(rekey(F.col("block")).alias(f"b{i}"), F.col("dim").alias(f"d{i}"), F.col("vs").alias(v)) for i, v in ((1, "xs"), (2, "ys")))
    joined = mates.join(one, (F.col("dim") == F.col("d1")) & (rekey(F.col("block")) == F.col("b1"))).join(two, (F.col("dim") == F.col("d2")) & (rekey(F.col("other")) == F.col("b2")))
    rows_in = joined.select("dim", "xs", F.when(F.col("block") != F.col("other"), F.col("ys")).alias("ys"))
    links = scratch.table(map_batches(rows_in, _pairs(conf), "row long, links long, to long", 1), "links")
    labels = components(scratch, links.select(F.col("row").alias("a"), F.col("to").alias("b")))
    counted = links.groupBy("row").agg(F.sum("links").alias("links")).select(rekey(F.col("row")).alias("k"), "links")
    named = labels.select(rekey(F.col("node")).alias("j"), "root")
    of_node = alike.withColumn("k", rekey(F.col("node"))).join(counted, "k", "left").withColumn("j", F.col("k")).join(named, "j", "left")
    of_node = of_node.select(F.col("h1").bitwiseXOR(F.lit(1)).alias("g1"), F.col("h2").alias("g2"), F.col("dim").alias("gd"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    same = (rekey(F.col("h1")) == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("dim") == F.col("gd"))
    of_row = packed.join(of_node, same).select(rekey(F.col("row")).alias("k"), "links", "root")
    of = rows.select("id", "row").withColumn("k", rekey(F.col("row"))).join(of_row, "k", "left")
    of = scratch.table(of.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "row").alias("root")), "named")
    least = of.groupBy("root").agg(F.min("id").alias("component_id")).select(rekey(F.col("root")).alias("k"), "component_id")
    out = of.withColumn("k", rekey(F.col("root"))).join(least, "k").select("id", "n_links", "component_id")
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
