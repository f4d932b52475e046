"""A Merkle manifest of a dataset: a tree of hashes for each group of rows, one over the groups, and a proof for every row.

1. Leaves are hashed in SQL and written; from here on only hashes move.
2. They are range-sorted by group and id.  Counts of each range's first and last group give every leaf its number in its group.
3. In each range all complete, aligned subtrees are built.  What is left at the ragged edges, at most 2 * (fan - 1) nodes a level,
   range and group, is shuffled by coordinate (group, level, number of the parent), and the upper levels are finished level by level.
4. A group's last node is its subroot; the tree over the subroots is built the same way by coordinates.
5. The families of siblings above the ranges go back to the ranges that lie below them, whose tasks give the proofs.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import groupby

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch
from monsoon.llm.ranges import ranges, ranked


@dataclass(frozen=True)
class Manifest:
    fan: int = 16
    #: Leaves of a range, on average; a task holds a range's hashes.
    leaves: int = 100_000
    #: Keys a range that are sampled for its bounds.
    sample: int = 40
    #: Also return the proof itself: the siblings before and after the path's node, level by level.
    proofs: bool = False


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(columns: Iterable[Column]) -> Column:
    """The hash of a row: each value as its length in bytes, a colon and its text, a null as a hyphen."""

    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


# ---- one run of a group's nodes: [(number of the first node, nodes)] from the leaves up


def grow(first: int, nodes: list[str], total: int, fan: int) -> list[tuple[int, list[str]]]:
    """The levels that follow from nodes number first.. of a level of `total`: a parent is there if all its children are."""
    levels = [(first, nodes)]
    while total > 1 and nodes:
        end, parents = first + len(nodes), -(-total // fan)
        low, high = -(-first // fan), parents if end == total else end // fan
        nodes = [digest(*nodes[fan * j - first : min(fan * (j + 1), total) - first]) for j in range(low, high)]
        first, total = low, parents
        levels.append((first, nodes))
    return levels


def ragged(levels: list[tuple[int, list[str]]], total: int, fan: int) -> Iterator[tuple[int, int, str, int]]:
    """level, number, hash and the level's total of the nodes whose parent is not in levels; the top node has none."""
    for level, (first, nodes) in enumerate(levels):
        up_first, up = levels[level + 1] if level + 1 < len(levels) else (0, [])
        end = first + len(nodes)
        left, right = (min(end, up_first * fan), max(first, (up_first + len(up)) * fan)) if up else (end, end)
        for j in (*range(first, left), *range(right, end)):
            yield level, j, nodes[j - first], total
        total = -(-total // fan)


def fold(node: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that follows from a node and the siblings before and after it, level by level."""
    for before, after in path:
        node = digest(before, node, after)
    return node


# ---- in Spark


def _name(group: str | None) -> tuple[bool, str]:
    """A group in the order of groups: null before all names."""
    return group is not None, group or ""


def _key(r) -> tuple:
    # null ids last; equal rows are spread by their number
    return (*_name(r.group), r.id is None, 0 if r.id is None else r.id, r.leaf, r.row)


@dataclass(frozen=True)
class _Bounds:
    """Ranges of keys: range i holds what is above bound i - 1 and not above bound i.  What is sent back has the key (-1, range)."""

    bounds: list[tuple]

    def __call__(self, key: tuple) -> int:
        return key[1] if key[0] == -1 else bisect_left(self.bounds, key)

    def of_group(self, name: tuple[bool, str]) -> range:
        """All ranges that may hold leaves of a group."""
        return range(bisect_left(self.bounds, name), bisect_right(self.bounds, name, key=lambda b: b[:2]) + 1)


def _sorted(leaves: DataFrame, n_rows: int, conf: Manifest) -> tuple[RDD, _Bounds, int]:
    """Leaves dealt to ranges, sorted in each; the bounds come from a sample of keys, so that a recomputed range is the same."""
    parts = max(ranges(leaves.sparkSession), -(-n_rows // conf.leaves))
    share = min(1.0, conf.sample * parts / n_rows)
    sample = sorted(_key(r) for r in leaves.select("group", "id", "leaf", "row").sample(share, seed=11).collect())
    bounds = _Bounds(sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else [])
    rows = leaves.rdd.map(lambda r: (_key(r), (r.id, r.claimed)))
    return rows.repartitionAndSortWithinPartitions(parts, bounds), bounds, parts


def _groups(rows: Iterable) -> Iterator:
    return groupby(rows, key=lambda row: row[0][:2])


def _edges(index: int, rows: Iterator) -> Iterator[tuple]:
    """range, its first and last group with their numbers of leaves there, and whether they are one run."""
    counts = [(group, sum(1 for _ in run)) for group, run in _groups(rows)]
    if counts:
        yield index, counts[0], counts[-1], len(counts) == 1


@dataclass
class _Layout:
    """From a row a range: the number of its first leaf, and of the groups at the ranges' edges their totals and spans
    (number of the first leaf, of the one after the last, range)."""

    offsets: dict[int, int]
    totals: dict[tuple, int]
    spans: dict[tuple, list[tuple[int, int, int]]]

    @staticmethod
    def of(edges: list[tuple]) -> _Layout:
        out, last, end = _Layout({}, {}, {}), None, 0
        for index, (head, n), (tail, m), one in sorted(edges):
            start = end if head == last else 0
            out.offsets[index] = start
            for group, a, b in [(head, start, start + n)] + ([] if one else [(tail, 0, m)]):
                out.totals[group] = b
                out.spans.setdefault(group, []).append((a, b, index))
            last, end = tail, start + n if one else m
        return out

    def runs(self, index: int, rows: Iterator) -> Iterator[tuple]:
        """group, number of the first leaf, the group's total and the rows of each run of a range."""
        for i, (group, run) in enumerate(_groups(rows)):
            here = list(run)
            yield group, self.offsets[index] if i == 0 else 0, self.totals.get(group, len(here)), here

    def deepest(self, fan: int) -> int:
        """Levels of the largest group that lies in several ranges; others are whole in theirs."""
        return max((_levels(self.totals[g], fan) for g, spans in self.spans.items() if len(spans) > 1), default=0)


def _levels(total: int, fan: int) -> int:
    n = 0
    while total > 1:
        total, n = -(-total // fan), n + 1
    return n


def _parents(families: DataFrame, fan: int) -> DataFrame:
    return families.select(
        "group", (F.col("level") + 1).alias("level"), F.col("parent").alias("number"), F.sha2(F.array_join("kids", ""), 256).alias("hash"), F.ceil(F.col("total") / fan).alias("total")
    )


def _families(scratch: Scratch, nodes: DataFrame, fan: int, top: int) -> tuple[list[DataFrame], DataFrame]:
    """From nodes (group, level, number, hash, total) the families of each level (group, level, parent, kids, total), and all
    nodes that are alone on their level, the roots."""
    families, below = [], nodes.where("false")
    for level in range(top):
        here = nodes.where(F.col("level") == level).unionByName(below)
        # an array of no more kids than the fan
        kids = F.transform(F.array_sort(F.collect_list(F.struct("number", "hash"))), lambda k: k.hash).alias("kids")
        grown = here.where("total > 1").groupBy("group", F.floor(F.col("number") / fan).alias("parent"), "total").agg(kids)
        families.append(scratch.table(grown.withColumn("level", F.lit(level)), f"families-{level}"))
        below = _parents(families[-1], fan)
    return families, reduce(DataFrame.unionByName, [nodes, *[_parents(f, fan) for f in families]]).where("total = 1")


def _tails(scratch: Scratch, subroots: DataFrame, fan: int) -> tuple[str, DataFrame]:
    """The root, and for each group its subroot with the siblings before and after its path's nodes up to the root."""
    ordered = ranked(scratch, subroots, [F.col("group").asc_nulls_first()], "subroots").withColumn("number", F.col("rank") - 1).drop("rank")
    total = ordered.count()
    nodes = ordered.select(F.lit(None).cast("string").alias("group"), F.lit(0).alias("level"), "number", "hash", F.lit(total).cast("long").alias("total"))
    families, top = _families(scratch, nodes, fan, _levels(total, fan))
    out = ordered.select("group", F.col("hash").alias("subroot"), "number", F.array().cast("array<struct<before:string,after:string>>").alias("path"))
    for level, family in enumerate(families):
        out = out.join(family.select(F.col("parent").alias("p"), "kids"), F.floor(F.col("number") / fan ** (level + 1)) == F.col("p"))
        mine = F.pmod(F.floor(F.col("number") / fan**level), F.lit(fan)).cast("int")
        around = F.struct(F.array_join(F.slice("kids", F.lit(1), mine), "").alias("before"), F.array_join(F.slice("kids", mine + 2, F.lit(fan)), "").alias("after"))
        out = out.withColumn("path", F.concat("path", F.array(around))).drop("p", "kids")
    return top.first().hash, out.select("group", "subroot", "path")


def _proofs(index: int, items: Iterator, layout: _Layout, root: str, conf: Manifest) -> Iterator[tuple]:
    """Proofs of a range's leaves; what was sent back comes before the leaves."""
    fan, tails, above = conf.fan, {}, {}

    def leaves() -> Iterator:
        for key, x in items:
            if key[0] != -1:
                yield key, x
            elif x[0] == "tail":
                tails[x[1]] = x[2], x[3]
            else:
                above[x[1], x[2], x[3]] = x[4]

    for group, first, total, rows in layout.runs(index, leaves()):
        levels, sizes = grow(first, [key[4] for key, _ in rows], total, fan), [total]
        while sizes[-1] > 1:
            sizes.append(-(-sizes[-1] // fan))
        subroot, tail = tails[group]

        def siblings(level: int, number: int, group=group, levels=levels, sizes=sizes) -> tuple[str, str]:
            parent = number // fan
            up_first, up = levels[level + 1] if level + 1 < len(levels) else (0, [])
            if up_first <= parent < up_first + len(up):
                at, nodes = levels[level]
                kids = nodes[parent * fan - at : min((parent + 1) * fan, sizes[level]) - at]
            else:
                kids = above[group, level, parent]
            mine = number - parent * fan
            return "".join(kids[:mine]), "".join(kids[mine + 1 :])

        upper, rest, of = tail, "", None
        for number, (key, (ident, claimed)) in enumerate(rows, first):
            if of != number // fan:  # above the leaves, a family's members have the same path
                of = number // fan
                upper = [siblings(level, number // fan**level) for level in range(1, len(sizes) - 1)] + tail
                rest = "".join(before + after for before, after in upper)
            own = [siblings(0, number)] if total > 1 else []
            folded = fold(claimed or key[4], own + upper)
            proof = digest(*[part for pair in own for part in pair], rest)
            yield ident, key[1] if key[0] else None, key[4], subroot, root, proof, folded, folded == root, own + upper if conf.proofs else None


def manifest(spark: SparkSession, leaves: DataFrame, conf: Manifest = Manifest()) -> DataFrame:  # noqa: B008
    """id, group, leaf, subroot, root, proof_sha256, folded_root, verified and (null unless asked for) proof of every leaf.

    leaves has id, group (string), leaf (hex) and claimed: the leaf that is put to the proof, null for the leaf itself.  A group's
    leaves ascend by id, null ids last, equal ids by their hash; a null group is one of its own and the first.  Equal rows are leaves
    of their own.  Runs of `fan` nodes, the last one being shorter, become the hash of their concatenated hex digests until one is
    left; a lone leaf is its group's subroot.  Subroots, in the order of their groups' bytes, become the root likewise.  proof_sha256
    is the hash of all siblings in order, of nothing where there are none.  An empty table gives an empty one.
    """
    scratch = Scratch(spark, "merkle")
    kind = leaves.schema["id"].dataType.simpleString()
    schema = f"id {kind}, `group` string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, proof array<struct<before:string,after:string>>"
    written = scratch.table(leaves.select("id", "group", "leaf", "claimed").withColumn("row", F.monotonically_increasing_id()), "leaves")
    n_rows = written.count()
    if not n_rows:
        return spark.createDataFrame([], schema)
    ordered, bounds, parts = _sorted(written, n_rows, conf)
    layout = _Layout.of(ordered.mapPartitionsWithIndex(_edges).collect())  # a row a range
    fan = conf.fan

    def edge_nodes(index: int, rows: Iterator) -> Iterator[tuple]:
        for group, first, total, run in layout.runs(index, rows):
            for level, number, node, of in ragged(grow(first, [key[4] for key, _ in run], total, fan), total, fan):
                yield group[1] if group[0] else None, level, number, node, of

    nodes = spark.createDataFrame(ordered.mapPartitionsWithIndex(edge_nodes), "`group` string, level int, number long, hash string, total long", verifySchema=False)
    families, alone = _families(scratch, scratch.table(nodes, "ragged"), fan, layout.deepest(fan))
    root, tails = _tails(scratch, scratch.table(alone.select("group", "hash"), "alone"), fan)

    def down(r) -> Iterator[tuple]:
        """A family goes to the ranges that hold leaves below it."""
        group, width = _name(r.group), fan ** (r.level + 1)
        for first, end, index in layout.spans.get(group, ()):
            if first < (r.parent + 1) * width and end > r.parent * width:
                yield (-1, index), ("family", group, r.level, r.parent, list(r.kids))

    def back(r) -> Iterator[tuple]:
        for index in bounds.of_group(_name(r.group)):
            yield (-1, index), ("tail", _name(r.group), r.subroot, [(x.before, x.after) for x in r.path])

    sent = reduce(RDD.union, [scratch.table(tails, "tails").rdd.flatMap(back), *[f.rdd.flatMap(down) for f in families]])
    # dealt by the same function, so the union is range by range and moves nothing
    both = sent.partitionBy(parts, bounds).union(ordered)
    if both.getNumPartitions() != ordered.getNumPartitions():
        raise RuntimeError("what was sent back does not meet its ranges")
    return spark.createDataFrame(both.mapPartitionsWithIndex(lambda i, items: _proofs(i, items, layout, root, conf)), schema, verifySchema=False)
