"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text gets the set of its k-word shingles (64-bit hashes) and a signature of min-wise hashes.  Equal sets are
   one node from here on, so copies never meet as pairs.
2. Bands of the signature put nodes into buckets.  Pairs of nodes in a bucket are candidates.
3. A candidate's signatures are compared batch by batch.  After n values of which m agree, the similarity has a
   Beta(m + 1, n - m + 1) posterior; where it gives the threshold a probability below `miss`, the pair is pruned.
4. Survivors are verified exactly on their full sets; verified links give connected components.

Only components are returned, so pairs whose nodes are already connected need no test.  In a bucket of at most `small`
nodes all pairs are tested.  In a larger one, a few rounds first compare all nodes with a pivot, which connects most of a
large group of near copies at linear cost; then each node outside the bucket's largest component meets all nodes of the
other components, block against block inside a task (no pair becomes a row, no bucket is cut), so no link between
components is lost.  A pair of blocks is one row of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, map_batches, rekey, utf8
from monsoon.llm.components import components
from monsoon.llm.textcode import shingle_sets

_rng = np.random.default_rng(20240607)
_FLIP = _rng.integers(0, 2**32, 512, dtype=np.uint32)[:, None]
_ODD = (_rng.integers(0, 2**31, 512, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SHIFT = np.uint64(32)


@dataclass(frozen=True)
class MinHash:
    """k-word shingles; links have share_num / share_den of similarity at least; a pair at the threshold is missed by the
    bands or by pruning with a probability of band_miss and of miss a look at most."""

    k: int = 5
    share_num: int = 80
    share_den: int = 100
    hashes: int = 128
    batch: int = 16
    band_miss: float = 1e-5
    miss: float = 1e-6
    small: int = 16
    block: int = 128
    block_bytes: int = 8_000_000
    salts: int = 32
    pivots: int = 2

    @property
    def threshold(self) -> float:
        return self.share_num / self.share_den

    @property
    def rows(self) -> int:
        """The most rows a band can have at band_miss."""
        fit = [r for r in range(1, 33) if (1 - self.threshold**r) ** (self.hashes // r) <= self.band_miss]
        return max(fit, default=1)

    def least_matches(self) -> list[tuple[int, int]]:
        """(n, m) by batch: with fewer than m of n values equal, the posterior of the threshold is below miss."""
        grid = (np.arange(20000) + 0.5) / 20000
        out = []
        for n in range(self.batch, self.hashes + 1, self.batch):
            for m in range(n + 1):
                log_density = m * np.log(grid) + (n - m) * np.log1p(-grid)
                density = np.exp(log_density - log_density.max())
                if density[grid >= self.threshold].sum() / density.sum() >= self.miss:
                    break
            out.append((n, m))
        return out


def signature(values: np.ndarray, hashes: int) -> np.ndarray:
    """The min-wise hashes of a set of 64-bit hashes."""
    high = (values >> _SHIFT).astype(np.uint32)[None, :]
    out = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for at in range(0, high.shape[1], 4096):
        np.minimum(out, ((high[:, at : at + 4096] ^ _FLIP[:hashes]) * _ODD[:hashes]).min(axis=1), out=out)
    return out


def _node(values: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit keys of a set."""
    a = np.bitwise_xor.reduce(values * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(len(values))
    b = np.add.reduce(values ^ (values >> np.uint64(29)), dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sign(conf: MinHash, kind: pa.DataType):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b, n, sig = [], [], [], []
        for values in shingle_sets(utf8(batch.column(1)), conf.k):
            x, y = _node(values) if len(values) else (0, 0)
            a.append(x)
            b.append(y)
            n.append(len(values))
            sig.append(signature(values, conf.hashes).tobytes() if len(values) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(kind), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), batch.column(1), batch.column(2)],
            ["id", "k1", "k2", "n_shingles", "sig", "text", "row"],
        )

    return run


def _sets(conf: MinHash):
    """The set and signature of each text, under its node's key."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sig, out = [], []
        for values in shingle_sets(utf8(batch.column(0)), conf.k):
            sig.append(signature(values, conf.hashes).tobytes())
            out.append(values.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sig, pa.binary()), pa.array(out, pa.binary())], ["node", "sig", "values"])

    return run


def _agree(left: np.ndarray, right: np.ndarray, looks: list[tuple[int, int]]) -> np.ndarray:
    """Equal values of each row of two signature tables, -1 where a look prunes the row."""
    matches = np.zeros(len(left), np.int32)
    live, done = np.arange(len(left)), 0
    for n, least in looks:
        matches[live] += (left[live, done:n] == right[live, done:n]).sum(axis=1, dtype=np.int32)
        out = matches[live] < least
        matches[live[out]] = -1
        live, done = live[~out], n
    return matches


def _prune(conf: MinHash):
    looks = conf.least_matches()

    def table(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, conf.hashes)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        matches = _agree(table(batch.column(2)), table(batch.column(3)), looks)
        keep = pa.array(matches >= 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(matches[matches >= 0], pa.int32())], ["a", "b", "matches"]
        )

    return run


def _linked(a: np.ndarray, b: np.ndarray, conf: MinHash) -> bool:
    if min(len(a), len(b)) * conf.share_den < conf.share_num * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return both * conf.share_den >= conf.share_num * (len(a) + len(b) - both)


def _verify(conf: MinHash):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = [[np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3)]
        keep = pa.array([_linked(x, y, conf) for x, y in zip(*sets, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return run


def _blocks(conf: MinHash):
    """Links between the components of two blocks of one bucket, at most one for each pair of components."""
    looks, rows = conf.least_matches(), conf.rows
    bands = conf.hashes // rows

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for row in batch.to_pylist():
            side = []
            for items in (row["xs"], row["ys"]):
                sig = np.frombuffer(b"".join(x["sig"] for x in items), np.uint32).reshape(-1, conf.hashes)
                side.append((items, sig, np.array([x["comp"] for x in items], np.int64)))
            (xs, x_sig, x_comp), (ys, y_sig, y_comp) = side
            root: dict[int, int] = {}

            def find(c: int, root=root) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            for i, x in enumerate(xs):
                other = np.flatnonzero(y_comp != x_comp[i])
                if not len(other):
                    continue
                matches = _agree(np.broadcast_to(x_sig[i], (len(other), conf.hashes)), y_sig[other], looks)
                live = matches >= 0
                other, matches = other[live], matches[live]
                # a pair is the business of the first band in which it meets
                same = (y_sig[other, : bands * rows] == x_sig[i, : bands * rows]).reshape(len(other), bands, rows).all(axis=2)
                mine = same.argmax(axis=1) == row["band"] if len(other) else np.empty(0, bool)
                other, matches = other[mine], matches[mine]
                values = np.frombuffer(x["values"], np.uint64)
                for j in other[np.argsort(-matches, kind="stable")]:
                    p, q = find(int(x_comp[i])), find(int(y_comp[j]))
                    if p != q and _linked(values, np.frombuffer(ys[j]["values"], np.uint64), conf):
                        root[max(p, q)] = min(p, q)
                        out_a.append(x["node"])
                        out_b.append(ys[j]["node"])
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return run


class _Linker:
    """Holds the nodes' sets, the links found and the components they give."""

    def __init__(self, scratch: Scratch, conf: MinHash, sets: DataFrame):
        self.scratch, self.conf, self.sets = scratch, conf, sets
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        """Adds links, as edges between the components so far."""
        new = self.scratch.table(links.select("a", "b"), "links")
        if new.isEmpty():
            return
        self.links = new if self.links is None else self.links.unionByName(new)
        self.labels = components(self.scratch, self.links)

    def comp(self, df: DataFrame, node: str, out: str) -> DataFrame:
        """df with the component of its column node as column out."""
        if self.labels is None:
            return df.withColumn(out, F.col(node))
        named = self.labels.select(rekey(F.col("node")).alias("_k"), F.col("root").alias("_r"))
        return df.withColumn("_k", rekey(F.col(node))).join(named, "_k", "left").withColumn(out, F.coalesce("_r", node)).drop("_k", "_r")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b, ...), those in different components."""
        return self.comp(self.comp(pairs, "a", "_ca"), "b", "_cb").where("_ca <> _cb").drop("_ca", "_cb")

    def _beside(self, pairs: DataFrame, value: str) -> DataFrame:
        for side in ("a", "b"):
            own = self.sets.select(rekey(F.col("node")).alias("_k"), F.col(value).alias(f"{value}_{side}"))
            pairs = pairs.withColumn("_k", rekey(F.col(side))).join(own, "_k").drop("_k")
        return pairs

    def pruned(self, pairs: DataFrame) -> DataFrame:
        beside = self._beside(pairs.select("a", "b"), "sig").select("a", "b", "sig_a", "sig_b")
        return map_batches(beside, _prune(self.conf), "a long, b long, matches int", 4096)

    def verified(self, pairs: DataFrame) -> DataFrame:
        beside = self._beside(pairs.select("a", "b"), "values").select("a", "b", "values_a", "values_b")
        return map_batches(beside, _verify(self.conf), "a long, b long")

    def test(self, pairs: DataFrame, rest: bool) -> None:
        """Tests distinct pairs: of each node the most similar first; the others only if asked for and still needed."""
        live = self.scratch.table(self.pruned(pairs), "live")
        score = F.col("matches").cast("long") * F.lit(1 << 40) + F.shiftrightunsigned(F.xxhash64("a"), 24)
        best = live.withColumn("score", score).groupBy("b").agg(F.max("score").alias("score"))
        first = live.withColumn("score", score).withColumn("k", rekey(F.col("b"))).join(
            best.select(rekey(F.col("b")).alias("k"), F.col("score").alias("top")), "k").where("score = top").select("a", "b")
        self.add(self.verified(first))
        if rest:
            self.add(self.verified(self.apart(live)))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, conf: MinHash | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: id, n_shingles (long), component_id (the least id that links reach), kept (id is component_id).

    A null or empty text, or one of white space only, has no shingle and links with nothing; so does an empty table's
    result have no rows.  A null id is never a component's id unless all its ids are null (component_id is null then, and
    all of them are kept).  Rows that repeat an id and a text get the same result; rows with one id and different texts are
    judged by their texts.  Other columns of docs are not read and may have any names.
    """
    conf = conf or MinHash()
    scratch = Scratch(spark, "minhash")
    kind = docs.select(id_col).schema[0].dataType
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    from pyspark.sql.pandas.types import to_arrow_type

    signed = scratch.table(
        map_batches(plain, _sign(conf, to_arrow_type(kind)), f"id {kind.simpleString()}, k1 long, k2 long, n_shingles long, sig binary, text string, row long"), "signatures"
    )
    nodes = scratch.table(
        signed.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("id").alias("id"), F.min("row").alias("row"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles")),
        "nodes",
    )

    # buckets of two nodes at least
    bands, width = conf.hashes // conf.rows, conf.rows * 4
    keys = F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(F.lit(i), F.substring("sig", i * width + 1, width)).alias("key")) for i in range(bands)])
    banded = nodes.select(F.col("k1").alias("node"), "n_shingles", F.explode(keys).alias("b")).select("node", "n_shingles", "b.band", "b.key")
    sizes = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(rekey(F.col("key")).alias("k"), "n")
    members = scratch.table(banded.withColumn("k", rekey(F.col("key"))).join(sizes, "k").select("key", "band", "node", "n_shingles", "n"), "members")

    wanted = nodes.join(members.select("node").distinct().select(rekey(F.col("node")).alias("k")), rekey(F.col("k1")) == F.col("k"), "left_semi")
    # a node's set is made from one row, whatever rows share its id or its text
    wanted = wanted.select(F.col("row").alias("want"), "k1")
    texts = signed.select("row", "text").join(wanted, F.col("row") == F.col("want")).select("text", "k1")
    sets = scratch.table(map_batches(texts, _sets(conf), "node long, sig binary, values binary"), "sets")
    linker = _Linker(scratch, conf, sets)

    # small buckets: all pairs
    small = members.where(F.col("n") <= conf.small).select(rekey(F.col("key")).alias("k"), "node")
    pairs = small.alias("x").join(small.alias("y"), (F.col("x.k") == F.col("y.k")) & (F.col("x.node") < F.col("y.node")))
    linker.test(scratch.table(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "pairs"), rest=True)

    # large buckets: pivots, then the rest block by block
    large = members.where(F.col("n") > conf.small)
    if not large.isEmpty():
        for turn in range(conf.pivots):
            flip = F.lit(int(_rng_flip(turn)))
            pivot = large.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(flip)).alias("p")).select(rekey(F.col("key")).alias("k"), F.col("p").bitwiseXOR(flip).alias("a"))
            star = large.select(rekey(F.col("key")).alias("k"), F.col("node").alias("b")).join(pivot, "k").where("a <> b").select("a", "b").distinct()
            linker.test(scratch.table(linker.apart(star), "stars"), rest=False)
        linker.add(_across(scratch, conf, linker, large, sets))

    return _result(signed, nodes, linker)


def _rng_flip(turn: int) -> np.int64:
    return np.random.default_rng(turn + 7).integers(-(2**63), 2**63, dtype=np.int64)


def _across(scratch: Scratch, conf: MinHash, linker: _Linker, large: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components of large buckets: nodes outside a bucket's largest component against all."""
    placed = scratch.table(linker.comp(large, "node", "comp"), "placed")
    size = F.lit(8) * F.col("n_shingles") + F.lit(4 * conf.hashes + 100)
    counts = placed.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum(size).alias("bytes"))
    top = counts.groupBy("key").agg(F.count("*").alias("comps"), F.max(F.struct("c", "comp", "bytes")).alias("top"), F.sum("c").alias("n"), F.sum("bytes").alias("bytes"))

    def blocks(count, held):
        return F.greatest(F.ceil(count / F.lit(conf.block)), F.ceil(held / F.lit(conf.block_bytes)))

    # blocks of a bounded number of nodes and of about block_bytes
    top = top.where("comps > 1").select(
        rekey(F.col("key")).alias("k"),
        F.col("top.comp").alias("main"),
        blocks(F.col("n"), F.col("bytes")).alias("y_blocks"),
        blocks(F.col("n") - F.col("top.c"), F.col("bytes") - F.col("top.bytes")).alias("x_blocks"),
    )
    open_ = placed.withColumn("k", rekey(F.col("key"))).join(scratch.table(top, "tops"), "k").select("k", "band", "node", "comp", "main", "x_blocks", "y_blocks")
    own = sets.select(rekey(F.col("node")).alias("kn"), "sig", "values")
    full = open_.withColumn("kn", rekey(F.col("node"))).join(own, "kn").drop("kn")
    # the bucket's key is salted by its blocks: each block of the smaller side goes to all salts, each of all nodes to one
    salts = F.least(F.col("y_blocks"), F.lit(conf.salts))
    item = F.collect_list(F.struct("node", "comp", "sig", "values"))
    ys = full.groupBy("k", "band", F.pmod(F.xxhash64("node"), F.col("y_blocks")).alias("block"), salts.alias("salts")).agg(item.alias("ys"))
    xs = full.where("comp <> main").groupBy("k", "band", F.pmod(F.xxhash64("node"), F.col("x_blocks")).alias("block"), salts.alias("salts")).agg(item.alias("xs"))
    xs, ys = scratch.table(xs, "rest"), scratch.table(ys, "blocks")
    xs = xs.select("band", "xs", rekey(F.col("k")).alias("j"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    ys = ys.select("ys", rekey(F.col("k")).alias("j"), F.pmod(F.col("block"), F.col("salts")).alias("salt"))
    return map_batches(xs.join(ys, ["j", "salt"]).select("band", "xs", "ys"), _blocks(conf), "a long, b long", 1)


def _result(signed: DataFrame, nodes: DataFrame, linker: _Linker) -> DataFrame:
    named = linker.comp(nodes.select(F.col("k1"), F.col("k2"), F.col("id")), "k1", "root")
    least = named.groupBy("root").agg(F.min("id").alias("component_id")).select(rekey(F.col("root")).alias("k"), "component_id")
    of = named.withColumn("k", rekey(F.col("root"))).join(least, "k").select(rekey(F.col("k1")).alias("j1"), F.col("k2").alias("j2"), "component_id")
    rows = signed.select("id", "n_shingles", rekey(F.col("k1")).alias("j1"), F.col("k2").alias("j2"))
    alone = rows.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    linked = rows.where("n_shingles > 0").join(of, ["j1", "j2"]).select("id", "n_shingles", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
