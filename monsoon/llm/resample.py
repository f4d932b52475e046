"""Importance resampling toward a target distribution over hashed n-grams; DataFrame functions only.

1. Every text's runs of 1 to n words are exploded and hashed into buckets (crc32 modulo); documents and target texts give a
   count a bucket.
2. A bucket's gain is the floored, scaled logarithm of its smoothed share in the target over that in the documents.
3. The gain table, a row a bucket, is broadcast; a document's weight is the sum of its features' gains.
4. Weight plus Gumbel noise from a hash of the id is the score: the highest scores are a sample without replacement with
   probabilities in proportion to the weights' exponentials.  Ranks come from a range sort with an offset a range.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of
from monsoon.llm.ranges import ranked

#: Runs of digits, letters and whatever is not ASCII, in texts whose A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Resample:
    n: int = 3
    buckets: int = 10_000
    seed: int = 42
    #: Drawn: share_num of share_den documents of min_words words at least.
    share_num: int = 5
    share_den: int = 100
    min_words: int = 20


def words(text: Column) -> Column:
    """The words of a text; of a null text none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), 0)


def _features(rows: DataFrame, keep: list[str], conf: Resample) -> DataFrame:
    """keep, gram and bucket of each feature of the array `words`; runs beyond a text's end have nulls, as have texts without words.

    Runs are made position by position: what a task holds is one text's words, not all its runs."""
    at = rows.select(*keep, "words", F.posexplode_outer("words").alias("at", "word"))
    run, runs = F.col("word"), [F.col("word")]
    for i in range(1, conf.n):
        run = F.concat(run, F.lit(" "), F.get("words", F.col("at") + i))  # null beyond the end
        runs.append(run)
    grams = at.select(*keep, F.explode(F.array(*runs)).alias("gram"))
    return grams.select(*keep, "gram", F.pmod(F.crc32(F.col("gram").cast("binary")), F.lit(conf.buckets)).cast("int").alias("bucket"))


def bucket_counts(rows: DataFrame, text: Column, conf: Resample = Resample()) -> DataFrame:  # noqa: B008
    """bucket and n, the number of features in it; a row a bucket at most."""
    return _features(rows.select(words(text).alias("words")), [], conf).where("gram is not null").groupBy("bucket").agg(F.count("*").alias("n"))


def gains(scratch: Scratch, docs: DataFrame, target: DataFrame, conf: Resample) -> DataFrame:
    """bucket and gain for every bucket that docs use; both frames have `text`.  No more rows than buckets."""
    ours = scratch.table(bucket_counts(docs, F.col("text"), conf).withColumnRenamed("n", "s"), "documents")
    theirs = scratch.table(bucket_counts(target, F.col("text"), conf).withColumnRenamed("n", "t"), "target")
    total = lambda df, c: float(df.agg(F.sum(c)).first()[0] or 0)
    s_all, t_all = total(ours, "s"), total(theirs, "t")
    s, t = F.col("s").cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    share = ((t + 1.0) * F.lit(s_all + conf.buckets)) / ((s + 1.0) * F.lit(t_all + conf.buckets))
    return ours.join(F.broadcast(theirs), "bucket", "left").select("bucket", F.floor(1000.0 * F.log(share)).alias("gain"))


def _noise(ident: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _scored(scratch: Scratch, keyed: DataFrame, target: DataFrame, conf: Resample) -> DataFrame:
    """row, id, n_words, n_features, weight and score of every row of keyed (row, id, text)."""
    table = gains(scratch, keyed, target, conf)
    sized = keyed.select("row", "id", words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    features = _features(sized, ["row", "id", "n_words"], conf).join(F.broadcast(table), "bucket", "left")
    # a row's features lie together, so that what is shuffled is a row a document
    sums = features.groupBy("row", "id", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    return sums.withColumn("score", F.col("weight") + _noise(F.col("id"), conf.seed))


def importance(spark: SparkSession, docs: DataFrame, target: DataFrame, conf: Resample = Resample(), id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:  # noqa: B008
    """row, id, n_words, n_features, weight, score and rank of every row of docs; rank is null for those not drawn.

    Null and empty texts, and those without a word, have no features and weight 0 and are never drawn (they have too few
    words).  A row is judged by itself: rows that repeat an id and a text get the same score.  Ties of scores go to the smaller
    id, null ids last, then to the row that comes first; null ids share the noise of an empty id.  Without target texts, or for
    empty tables, shares are smoothed ones and nothing fails.  Columns beyond id and text are not read.
    """
    scratch = Scratch(spark, "resample")
    keyed = docs.select(_col_of(id_col).alias("id"), _col_of(text_col).alias("text")).withColumn("row", F.monotonically_increasing_id())
    return _drawn(scratch, keyed, target.select(_col_of(target_col).alias("text")), conf)


def _drawn(scratch: Scratch, keyed: DataFrame, target: DataFrame, conf: Resample) -> DataFrame:
    scored = scratch.table(_scored(scratch, keyed, target, conf), "scored")
    eligible = scored.where(F.col("n_words") >= conf.min_words)
    drawn = conf.share_num * eligible.count() // conf.share_den
    placed = ranked(scratch, eligible, [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")])
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(scored.where(F.col("n_words") < conf.min_words).withColumn("rank", F.lit(None).cast("long")))


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, conf: Resample = Resample(), id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:  # noqa: B008
    """The drawn rows of docs with all their columns, as struct `doc`, and weight, score and rank."""
    scratch = Scratch(spark, "resample")
    whole = docs.select(F.struct(*[_col_of(c) for c in docs.columns]).alias("doc"), _col_of(id_col).alias("id"), _col_of(text_col).alias("text"))
    whole = scratch.table(whole.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = _drawn(scratch, whole.select("row", "id", "text"), target.select(_col_of(target_col).alias("text")), conf).where("rank is not null")
    return whole.select("row", "doc").join(found.select("row", "weight", "score", "rank"), "row").drop("row")
