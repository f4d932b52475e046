"""Removal of repeated passages by overlapping windows of consecutive lines; DataFrame functions only.

Every window of `window` consecutive lines gets a 128-bit hash.  A window that occurs more than once, anywhere in the
table, stays at its first occurrence (least id, then least position); at each later one its lines are covered, covered
positions are merged into runs, and the runs go.  Windows overlap, so a repeated passage of any number of lines from
`window` up goes as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of, rekey


def _hashed(lines: str, seed: int) -> Column:
    # no default argument in the lambda: a second parameter would be the index
    return F.transform(lines, lambda x: F.xxhash64(F.lit(seed), x))


def dedup_lines(spark: SparkSession, docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs with its columns, as struct `doc`, and text (what is left), n_lines, n_removed (both int).

    Lines end at line feeds and are compared exactly.  A text of fewer than `window` lines (so an empty one, which is one
    empty line) has no window and stays; a null text stays null and has 0 lines.  Rows that repeat an id and a text count
    as one document and get the same result; of rows with one id and different texts, the order is by a hash of the text.
    Null ids come last.  Columns of docs may have any names, since they stay inside the struct.
    """
    scratch = Scratch(spark, "linededup")
    text, ident = _col_of(text_col).cast("string"), _col_of(id_col)
    # ident is null for rows without an id; last tells them from any id
    keyed = [ident.isNull().alias("last"), ident.alias("ident"), F.xxhash64(text).alias("digest")]

    lines = docs.select(*keyed, F.split(text, "\n", -1).alias("lines")).where(F.size("lines") >= window)
    hashed = lines.select("last", "ident", "digest", *[_hashed("lines", s).alias(f"h{s}") for s in (1, 2)])
    count = F.size("h1") - (window - 1)
    parts = F.arrays_zip(*[F.slice(f"h{s}", i + 1, count).alias(f"h{s}_{i}") for s in (1, 2) for i in range(window)])
    exploded = hashed.select("last", "ident", "digest", F.posexplode(parts).alias("pos", "w"))
    names = {s: [f"w.h{s}_{i}" for i in range(window)] for s in (1, 2)}
    windows = scratch.table(
        exploded.select("last", "ident", "digest", "pos", F.xxhash64(*names[1]).alias("a"), F.xxhash64(*names[2]).alias("b")), "windows"
    )

    first = windows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("last", "ident", "digest", "pos")).alias("first")).where("n > 1")
    first = first.select(rekey(F.col("a")).alias("a"), "b", "first")
    later = windows.withColumn("a", rekey(F.col("a"))).join(first, ["a", "b"]).where(~F.struct("last", "ident", "digest", "pos").eqNullSafe(F.col("first")))
    starts = later.groupBy("last", "ident", "digest").agg(F.sort_array(F.collect_set("pos")).alias("starts"))
    starts = scratch.table(starts, "starts").select(F.col("last").alias("l"), F.col("ident").alias("i"), F.col("digest").alias("d"), "starts")

    rows = docs.select(F.struct(*[_col_of(c) for c in docs.columns]).alias("doc"), *keyed, text.alias("text"))
    on = (F.col("last") == F.col("l")) & F.col("ident").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d"))
    # always sorted and merged, so that the plan does not change with the size of starts
    joined = rows.join(starts.hint("merge"), on, "left").select("doc", "text", "starts", F.split("text", "\n", -1).alias("lines"))

    # runs of covered lines: one begins where the one before has ended, and ends where the next one begins later
    last_at = F.size("starts") - 1
    begins = F.filter("starts", lambda x, i: (i == 0) | (F.get("starts", i - 1) + window < x))
    ends = F.transform(F.filter("starts", lambda x, i: (i == last_at) | (F.get("starts", i + 1) > x + window)), lambda x: x + window)
    runs = joined.select("doc", "text", "lines", begins.alias("begins"), ends.alias("ends"))
    # what is kept lies between the runs
    n = F.size("lines")
    kept_from = F.concat(F.array(F.lit(0)), F.col("ends"))
    kept_to = F.concat(F.col("begins"), F.array(n))
    gaps = F.zip_with(kept_from, kept_to, lambda s, e: F.slice("lines", s + 1, e - s))
    covered = F.aggregate(F.zip_with("begins", "ends", lambda s, e: e - s), F.lit(0), lambda x, y: x + y)
    return runs.select(
        "doc",
        F.when(F.col("begins").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(n).alias("n_lines"),
        F.coalesce(covered, F.lit(0)).alias("n_removed"),
    )
