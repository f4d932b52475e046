"""Token totals for every context limit from one exact histogram of encoded lengths.

Each document is encoded once (whole).  Documents are counted by length; suffix sums over the histogram then answer,
for any limit, how many documents are longer, how many tokens all have, and how many are left when each is cut at the
limit.  Suffix sums go by two levels, blocks of lengths and lengths within a block, so that no task holds all lengths.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of, map_batches

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-tokenisation that this public vocabulary is defined with (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Longer runs of white space are cut off by hand, as the pattern's look-ahead takes stack for each of their characters.
RUN = 500
_BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)


@lru_cache(2)
def _encoding(data: bytes):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(encoding, text: str) -> int:
    """How many tokens the text has.

    A run of n blanks before anything else is one piece of n - 1 blanks, and the last blank goes with what follows; at the
    text's end it is one piece.
    """
    count = at = 0
    for run in _BLANKS.finditer(text):
        stop = run.end() - (run.end() < len(text))
        count += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : stop]))
        at = stop
    return count + len(encoding.encode_ordinary(text[at:] if at else text))


def _lengths(data: bytes):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(data)
        yield pa.RecordBatch.from_arrays([pa.array([0 if t is None else token_count(encoding, t) for t in batch.column(0).to_pylist()], pa.int64())], ["n_tokens"])

    return run


def lengths(docs: DataFrame, ranks: str = DEFAULT_RANKS, text_col: str = "text") -> DataFrame:
    """n_tokens of each row of docs; a null text has 0, as an empty one."""
    with open(ranks, "rb") as file:
        data = file.read()
    return map_batches(docs.select(_col_of(text_col).cast("string").alias("text")), _lengths(data), "n_tokens long", 128)


def histogram(spark: SparkSession, docs: DataFrame, ranks: str = DEFAULT_RANKS, text_col: str = "text", block: int = 1024) -> DataFrame:
    """For each encoded length that occurs: n_tokens, n_docs, docs_longer, tokens_longer, docs_up_to, truncated_tokens, total_tokens, quantile.

    docs_longer and tokens_longer are over documents of more than n_tokens; truncated_tokens is what all documents have
    when cut at n_tokens; docs_up_to counts those that fit whole; quantile is their share.  An empty table gives no rows.
    """
    scratch = Scratch(spark, "tokencounts")
    counts = lengths(docs, ranks, text_col).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    counts = scratch.table(counts.withColumn("block", F.floor(F.col("n_tokens") / block)), "histogram")
    # as many rows as blocks of lengths: the longest text's tokens / block
    per_block = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_block.select(
        F.col("block").alias("b"), F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(Window.partitionBy()).alias("all_docs"), F.sum("t").over(Window.partitionBy()).alias("all_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    joined = counts.join(blocks, F.col("block") == F.col("b"))
    longer = joined.select(
        "n_tokens", "n_docs", "all_docs", "all_tokens",
        (F.col("docs_after") + F.coalesce(F.sum("n_docs").over(within), F.lit(0))).alias("docs_longer"),
        (F.col("tokens_after") + F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")).over(within), F.lit(0))).alias("tokens_longer"),
    )
    up_to = F.col("all_docs") - F.col("docs_longer")
    return longer.select(
        "n_tokens", "n_docs", "docs_longer", "tokens_longer", up_to.alias("docs_up_to"),
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_tokens"),
        F.col("all_tokens").alias("total_tokens"), (up_to / F.col("all_docs")).alias("quantile"),
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, docs_longer, total_tokens, truncated_tokens for given limits, from histogram()'s rows: one pass, with
    sums for each limit.  Without rows in hist, or without limits, there are none."""
    n, docs = F.col("n_tokens"), F.col("n_docs")
    of = [
        F.struct(
            F.lit(int(x)).cast("long").alias("context_limit"),
            F.sum(F.when(n > int(x), docs).otherwise(0)).alias("docs_longer"),
            F.sum(n * docs).alias("total_tokens"),
            F.sum(F.least(n, F.lit(int(x)).cast("long")) * docs).alias("truncated_tokens"),
        )
        for x in limits
    ]
    none = "context_limit long, docs_longer long, total_tokens long, truncated_tokens long"
    if not of:
        return hist.sparkSession.createDataFrame([], none)
    return hist.agg(F.array(*of).alias("of")).select(F.inline("of")).where("total_tokens is not null")
