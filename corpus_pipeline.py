"""The corpus pipeline: STAGES are applied in order to documents, each over all that the one before kept.

Stages read the columns in COLUMNS, which may hold nulls; others are left out, so their names may clash with anything.  A
row is judged by itself, whatever rows share its id.  Rows that repeat an id and a text are alike for all stages but
near_dedup, which keeps one of them.  Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm import decontam, langid, linededup, minhash, pieces
from monsoon.llm.common import Scratch, rekey, source

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised; those rejected, without text or without a letter go.

    The model learns from all labelled documents but those of the test fold; without any label it would reject all, and
    then all with a letter stay.
    """
    model, threshold = langid.train(spark, docs.where(~langid.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    whole = docs.select(F.struct(*[c for c in COLUMNS if c != "text"]).alias("doc"), "text")
    return langid.predict(spark, whole, model, threshold, id_col="doc").where("not rejected").select("id.*", "text").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later occurrences of repeated passages; documents of which nothing is left go.  Null and empty texts stay,
    and n_chars is that of what is left."""
    left = linededup.dedup_lines(spark, docs.select(*COLUMNS))
    text = F.col("text")
    return left.where((F.length(F.trim(text)) > 0) | (F.col("n_removed") == 0)).select(
        "doc.doc_id", text, "doc.lang", "doc.source", F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("doc.n_chars")).alias("n_chars")
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the row with the least id stays, one without
    an id only if all lack it; of rows with this id, one."""
    scratch = Scratch(spark, "kept")
    key = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", F.monotonically_increasing_id().alias("row"))
    keyed = scratch.table(docs.select(*COLUMNS, key.alias("key")), "keyed")
    found = minhash.near_duplicates(spark, keyed, id_col="key")
    gone = scratch.table(found.where("not kept").select(F.col("id.row").alias("gone")), "gone")
    return keyed.join(gone, rekey(F.col("key.row")) == rekey(F.col("gone")), "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item: rows with the id, which may be null, and the text of a leak.  Null texts
    leak nothing; without benchmark items all stay."""
    found = decontam.leaks(spark, docs, source(spark, sf_dir, "benchmark"))
    leaked = Scratch(spark, "leaked").table(found.select(F.col("id").alias("gone"), F.col("digest").alias("leak")).distinct(), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("gone")) & (F.xxhash64("text") == F.col("leak")) & F.col("text").isNotNull()
    return docs.join(leaked, same, "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens: doc_id, n_tokens, ids and round_trip, null for null texts; a row for each row."""
    return pieces.encode(spark, docs).select(F.col("id").alias("doc_id"), "n_tokens", "ids", "round_trip")


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]
#: Language models, the field of near-duplicates and the encoder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
