"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target of words by its weight, twice its own words at most; what is above is shared again among the others.
A source's whole words are taken as often as they fit (complete epochs).  For the rest its documents are put in the order of
exponential keys, -ln(u) / quality with u from a hash of the id, and taken from the least key on until the budget is used up;
the document on the limit is cut there.  The order comes from a range sort over (source, key), its running sums from sums in
each range plus what the ranges before hold of the same source, so that no task holds a source.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of
from monsoon.llm.ranges import in_ranges, ranges, ranked

WORD = r"[^\x20\x09-\x0D]+"
_BITS = 52  # of the hash that make u; 13 hex digits


@dataclass(frozen=True)
class Mix:
    #: Of the sources in their order, repeating.
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    #: Words of the mix, in percent of all words.
    percent: int = 150
    #: Times its words that a source gives at most.
    most: int = 2
    seed: int = 42
    #: Up to so many sources their targets are broadcast, else joined.
    broadcast_sources: int = 50_000


def targets(scratch: Scratch, sizes: DataFrame, conf: Mix) -> DataFrame:
    """source, source_size, weight and target; sizes has source and source_size, a row a source.

    Sources are weighed in the order of their code points, null last.  The level, words a unit of weight, rises until no
    source above its limit gets more than it; each round is one sum over the sources.
    """
    ordered = ranked(scratch, sizes, [F.col("source").asc_nulls_last()], "sources")
    cycle = F.array(*[F.lit(float(w)) for w in conf.weights])
    weighed = scratch.table(ordered.withColumn("weight", F.get(cycle, F.pmod(F.col("rank") - 1, F.lit(len(conf.weights))).cast("int"))).drop("rank"), "weighed")
    limit = F.col("source_size") * float(conf.most)
    wanted = conf.percent * (weighed.agg(F.sum("source_size")).first()[0] or 0) / 100
    level, full = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > limit
        r = weighed.agg(F.count_if(above).alias("n"), F.sum(F.when(above, limit)).alias("fixed"), F.sum(F.when(~above, F.col("weight"))).alias("share")).first()
        if r.n == full or not r.share:
            break
        full, level = r.n, (wanted - (r.fixed or 0.0)) / r.share
    return weighed.withColumn("target", F.least(F.lit(level) * F.col("weight"), limit))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds running, the sum of size over the rows of the same source so far, the row itself left out; rows come by source."""
    last, total = (False, None), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        source, size = batch.column("source"), batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
        changed = np.ones(len(size), bool)
        if len(size) > 1:
            a, b = source[1:], source[:-1]
            same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | (a.is_null().to_numpy(zero_copy_only=False) & b.is_null().to_numpy(zero_copy_only=False))
            changed[1:] = ~same
        first = (True, source[0].as_py())
        if first == last:
            changed[0] = False
        before = np.concatenate(([0], np.cumsum(size)))
        starts = np.flatnonzero(changed)
        run = np.searchsorted(starts, np.arange(len(size)), "right") - 1
        # rows before the batch's first change go on with the sum of the batch before
        base = np.where(run >= 0, -before[starts[np.maximum(run, 0)]] if len(starts) else 0, total)
        running = before[:-1] + base
        last, total = (True, source[len(size) - 1].as_py()), int(running[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(running)], names=[*batch.schema.names, "running"])


def mix(spark: SparkSession, docs: DataFrame, conf: Mix = Mix(), id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", quality: Column | None = None, ratings: DataFrame | None = None) -> DataFrame:  # noqa: B008
    """row, id, source, size, source_size, target, copies (whole ones), cut (words of one more) and taken of every row of docs.

    quality is a positive column of docs, or ratings a table of id and quality with a row an id, which is joined when texts have
    become sizes; documents without any have 1, as have those whose quality is null or isn't positive.  Null and empty texts have
    no words and none are taken.  Rows are judged by themselves, whatever rows share their id; null ids share one u, and are
    ordered last among equal keys.  A null source is one of its own.  Equal tables give equal results.  Empty ones give none.
    """
    scratch = Scratch(spark, "mix")
    own = F.lit(None).cast("double") if quality is None else quality.cast("double")
    keyed = docs.select(_col_of(id_col).alias("id"), _col_of(source_col).cast("string").alias("source"), _col_of(text_col).cast("string").alias("text"), own.alias("quality"))
    return _mixed(scratch, keyed.withColumn("row", F.monotonically_increasing_id()), conf, ratings)


def _mixed(scratch: Scratch, keyed: DataFrame, conf: Mix, ratings: DataFrame | None = None) -> DataFrame:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{conf.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, _BITS // 4), 16, 10).cast("double")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = scratch.table(keyed.select("row", "id", "source", size.alias("size"), "quality"), "sized")  # texts are read once
    if ratings is not None:
        rated = ratings.where("id is not null").select(F.col("id").alias("rated"), F.col("quality").alias("rating"))
        sized = sized.join(rated, F.col("id") == F.col("rated"), "left").withColumn("quality", F.coalesce("rating", "quality")).drop("rated", "rating")
    good = F.when(F.col("quality") > 0, F.col("quality")).otherwise(1.0)
    sized = sized.select("row", "id", "source", "size", (-F.log((h + 0.5) / float(1 << _BITS)) / good).alias("key"))
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("id").asc_nulls_last(), F.col("row")]

    def running(df: DataFrame) -> DataFrame:
        return df.mapInArrow(_running, df.withColumn("running", F.lit(0).cast("long")).schema)

    ordered = in_ranges(scratch, sized, order, "ordered", running)
    sums = scratch.table(ordered.groupBy("part", "source").agg(F.sum("size").alias("size"), F.min("place").alias("first")), "sums")
    found = targets(scratch, sums.groupBy("source").agg(F.sum("size").alias("source_size")), conf)
    found = scratch.table(found.select(F.col("source").alias("of"), "source_size", "target"), "targets")

    # a range may begin with the rest of a source; what the ranges before hold of it is known from a row a range
    edges = sums.groupBy("part").agg(F.min_by(F.struct("source", "size"), "first").alias("head"), F.max_by(F.struct("source", "size"), "first").alias("tail"), F.count("*").alias("n")).collect()
    rows, last, total = [], None, 0
    for e in sorted(edges, key=lambda e: e.part):
        carried = total if last == (e.head.source,) else 0
        rows.append((e.part, e.head.source, carried))
        last, total = (e.tail.source,), e.tail.size + (carried if e.n == 1 else 0)
    heads = scratch.spark.createDataFrame(rows, "part int, head string, carried long")

    found = F.broadcast(found) if found.count() <= conf.broadcast_sources else found
    joined = ordered.join(F.broadcast(heads), "part").join(found, F.col("source").eqNullSafe(F.col("of")))
    before = F.col("running") + F.when(F.col("source").eqNullSafe(F.col("head")), F.col("carried")).otherwise(0)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    joined = joined.withColumn("epochs", epochs)
    budget = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5)
    joined = joined.withColumn("rest", F.greatest(F.lit(0), F.least(F.col("size"), budget - before)))
    whole = (F.col("rest") == F.col("size")) & (F.col("size") > 0)
    return joined.select(
        "row", "id", "source", "size", "source_size", "target", (F.col("epochs") + whole.cast("long")).alias("copies"), F.when(whole, 0).otherwise(F.col("rest")).cast("long").alias("cut"),
        (F.col("epochs") * F.col("size") + F.col("rest")).alias("taken"),
    )


def mixture(spark: SparkSession, docs: DataFrame, conf: Mix = Mix(), id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", quality: Column | None = None, ratings: DataFrame | None = None) -> DataFrame:  # noqa: B008
    """The mix itself: a row for each copy, with the columns of docs as struct `doc`, copy (1, 2...) and text; the copy that the
    budget cuts has the first words of its text, joined by spaces."""
    scratch = Scratch(spark, "mix")
    own = F.lit(None).cast("double") if quality is None else quality.cast("double")
    whole = docs.select(
        F.struct(*[_col_of(c) for c in docs.columns]).alias("doc"), _col_of(id_col).alias("id"), _col_of(source_col).cast("string").alias("source"), _col_of(text_col).cast("string").alias("text"), own.alias("quality")
    )
    whole = scratch.table(whole.withColumn("row", F.monotonically_increasing_id()), "rows")
    taken = _mixed(scratch, whole.drop("doc"), conf, ratings).where("taken > 0").select("row", "copies", "cut")
    copies = F.explode(F.sequence(F.lit(1), (F.col("copies") + (F.col("cut") > 0).cast("long")).cast("int")))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("cut").cast("int")), " ")
    rows = whole.select("row", "doc", "text").join(taken, "row").withColumn("copy", copies)
    return rows.select("doc", "copy", F.when(F.col("copy") > F.col("copies"), first).otherwise(F.col("text")).alias("text"))
