"""Digests of stored files, made by executors: a tree over parts, files and buckets of files, which names what has changed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PART = 1 << 22
BUCKETS = 256
#: Files of at most so many bytes are read as one row.
WHOLE = 1 << 24
_MARK = b"\xef\xbb\xbf"
#: Spark's text reader unpacks files of these names, so they are read as one row, of 2 GB at most.
_PACKED = ("gz", "bz2", "deflate", "snappy", "lz4", "zst")


def _inner(path: str) -> tuple[Column, Column]:
    """A file's path below path, and whether it counts, by column `path`."""
    root = path.rstrip("/").split("://")[-1].split(":", 1)[-1]
    name = F.element_at(F.split("path", "/"), -1)
    at = F.locate(root, F.col("path"))
    inner = F.when(at > 0, F.expr(f"substring(path, locate('{root}', path) + {len(root)})")).otherwise(F.col("path"))
    inner = F.when(F.length(inner) > 0, F.regexp_replace(inner, "^/+", "")).otherwise(name)
    return inner, ~F.substring(name, 1, 1).isin(".", "_")


def _joined(piece: int):
    """The bytes of consecutive lines again, cut where a file's offset is a multiple of piece and where a block ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, now = bytearray(), 0, None  # held are the bytes of block `now` from offset `at` on

        def row(n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([at], pa.int64()), pa.array([bytes(held[:n])], pa.binary())], ["file", "length", "at", "content"])

        def closed() -> Iterator[pa.RecordBatch]:
            if now:
                if at + len(held) != now[3]:
                    raise ValueError(f"{now[0]} has changed while it was read")
                if held:
                    yield row(len(held))

        for batch in batches:
            file, begin, last = batch.column(0), batch.column(2), batch.num_rows - 1
            other = pc.or_(pc.not_equal(file.slice(1), file.slice(0, last)), pc.not_equal(begin.slice(1), begin.slice(0, last)))
            edges = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if s == e:
                    continue
                key = tuple(batch.column(i)[s].as_py() for i in range(4))
                if key != now:
                    yield from closed()
                    held, at, now = bytearray(_MARK if batch.column(4)[s].as_py() else b""), key[2], key
                held += b"\n".join(batch.column(5).slice(s, e - s).to_pylist()) + b"\n"
                if at + len(held) == now[1] + 1:  # the file's last line has no line feed
                    del held[-1:]
                while (n := piece - at % piece) <= len(held):
                    yield row(n)
                    at += n
                    del held[:n]
        yield from closed()

    return run


def _by_lines(read, files: DataFrame, path: str, whole: int, piece: int) -> DataFrame:
    """Files of any length, which the text reader cuts into blocks, each of the lines that begin in it.

    A first pass adds up the lines' lengths, so that a block's offset is known.  The reader leaves out a byte order mark at
    a file's beginning; the sum tells.
    """
    text = read.format("text").option("lineSep", "\n").load(path)
    meta = lambda c: F.col(f"_metadata.{c}")
    lines = text.where((meta("file_size") > whole) & ~meta("file_name").rlike(rf"\.({'|'.join(_PACKED)})$")).select(
        meta("file_path").alias("uri"), meta("file_block_start").alias("block"), F.col("value").cast("binary").alias("line")
    )
    inner, counts = _inner(path)
    names = files.where(counts & (F.col("length") > whole)).select(meta("file_path").alias("uri"), inner.alias("file"), "length")
    blocks = lines.groupBy("uri", "block").agg(F.sum(F.octet_length("line") + F.lit(1).cast("long")).alias("n")).join(names, "uri")
    own = Window.partitionBy("uri")
    lost = F.col("length") - F.sum("n").over(own)  # -1 where the last line has no line feed
    marked = lost.isin(2, 3)
    checked = F.when(lost.isin(-1, 0) | marked, marked).otherwise(F.raise_error(F.concat("file", F.lit(" has changed while it was read"))).cast("boolean"))
    end = F.least(F.sum("n").over(own.orderBy("block")) + F.when(F.col("marked"), len(_MARK)).otherwise(0), F.col("length"))
    blocks = blocks.withColumn("marked", checked).withColumn("end", end)
    begin = F.coalesce(F.lag("end").over(own.orderBy("block")), F.lit(0).cast("long"))
    blocks = blocks.withColumn("begin", begin).select("uri", "block", "file", "length", "begin", "end", (F.col("marked") & (F.col("begin") == 0)).alias("mark"))
    # a row a block, however long its lines
    rows = lines.join(F.broadcast(blocks), ["uri", "block"]).select("file", "length", "begin", "end", "mark", "line")
    return rows.mapInArrow(_joined(piece), "file string, length long, at long, content binary")


def contents(spark: SparkSession, path: str, whole: int = WHOLE, piece: int = PART) -> DataFrame:
    """file (its path below path), length, at and content: the bytes of every data file below path, from offset at on.

    A file of at most `whole` bytes is a row, a longer one has rows of at most `piece` bytes.  Hidden files, whose names begin
    with a dot or an underscore, and empty ones, which Spark doesn't read, don't count.
    """
    read = lambda: spark.read.option("recursiveFileLookup", "true")
    whole = max(whole, len(_MARK))  # of a mark alone the text reader makes no line
    files = read().format("binaryFile").load(path)
    packed = read().option("pathGlobFilter", f"*.{{{','.join(_PACKED)}}}").format("binaryFile").load(path)
    inner, counts = _inner(path)
    # conditions on the length alone, which the reader checks before it reads a file
    rows = files.where(F.col("length") <= whole).unionByName(packed.where(F.col("length") > whole))
    rows = rows.where(counts).select(inner.alias("file"), "length", F.lit(0).cast("long").alias("at"), "content")
    return rows.unionByName(_by_lines(read(), files, path, whole, piece))


def part_digests(files: DataFrame, part: int = PART) -> DataFrame:
    """file, part (from 0), n_bytes and digest of every part of at most `part` bytes.

    Parts that lie within one row of files are hashed there; only those that rows share have their bytes exchanged.
    """
    size = F.octet_length("content")
    number = lambda at: F.floor(at / part)
    numbers = F.sequence(number(F.col("at")), F.greatest(number(F.col("at") + size - 1), number(F.col("at"))))

    def cut(p: Column) -> Column:
        begin = F.greatest(p * part - F.col("at"), F.lit(0))
        stop = F.least((p + 1) * part - F.col("at"), size)
        return F.struct(p.alias("part"), (F.col("at") + begin).alias("begin"), F.substring("content", (begin + 1).cast("int"), (stop - begin).cast("int")).alias("piece"))

    # cut before they become rows, each of which would carry the whole content
    rows = files.select("file", "length", F.explode(F.transform(numbers, cut)).alias("x")).select("file", "length", "x.*").withColumn("n", F.octet_length("piece"))
    complete = (F.col("begin") == F.col("part") * part) & (F.col("begin") + F.col("n") == F.least((F.col("part") + 1) * part, F.col("length")))
    hashed = rows.select("file", "part", "n", F.when(complete, F.sha2("piece", 256)).alias("digest"), F.when(~complete, F.struct("begin", "piece")).alias("rest"))
    joined = F.aggregate(F.array_sort(F.collect_list("rest")), F.lit("").cast("binary"), lambda x, y: F.concat(x, y.piece))
    return hashed.groupBy("file", "part").agg(F.sum("n").cast("int").alias("n_bytes"), F.coalesce(F.max("digest"), F.sha2(joined, 256)).alias("digest"))


def file_digests(parts: DataFrame) -> DataFrame:
    """file, n_bytes, n_parts and digest: the hash of its parts' digests in order, of which a file has a few hundred."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("part", "digest"))), lambda p: p.digest)
    return parts.groupBy("file").agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_parts"), F.sha2(F.array_join(ordered, ""), 256).alias("digest"))


def bucket_digests(files: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n_files and digest: the hash of names and digests of the files that a hash of their names puts there, by name."""
    entry = F.struct("file", F.concat_ws(":", F.octet_length("file").cast("string"), F.col("file"), F.col("digest")).alias("entry"))
    rows = files.select(F.pmod(F.crc32(F.col("file").cast("binary")), F.lit(buckets)).cast("int").alias("bucket"), entry.alias("e"))
    ordered = F.transform(F.array_sort(F.collect_list("e")), lambda e: e.entry)
    return rows.groupBy("bucket").agg(F.count("*").alias("n_files"), F.sha2(F.array_join(ordered, "\n"), 256).alias("digest"))


def root_digest(buckets: DataFrame) -> DataFrame:
    """One row: n_files and digest over the buckets in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("bucket", "digest"))), lambda b: F.concat_ws(":", b.bucket.cast("string"), b.digest))
    return buckets.agg(F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"), F.sha2(F.array_join(ordered, "\n"), 256).alias("digest"))


def tree(spark: SparkSession, path: str, part: int = PART) -> DataFrame:
    """The digest of all below path: the same for the same files, however the read is split."""
    return root_digest(bucket_digests(file_digests(part_digests(contents(spark, path), part))))


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """file, part and change (CHANGED, ADDED or REMOVED) of the parts whose digests differ, from two frames of part digests.

    Compared top down: files of equal digests never have their parts compared.
    """
    old, new = (file_digests(x).select("file", F.col("digest").alias(n)) for x, n in ((before, "a"), (now, "b")))
    differ = old.join(new, "file", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("file")
    old, new = (x.join(differ, "file", "left_semi").select("file", "part", F.col("digest").alias(n)) for x, n in ((before, "a"), (now, "b")))
    both = old.join(new, ["file", "part"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("file", "part", F.when(F.col("a").isNull(), "ADDED").when(F.col("b").isNull(), "REMOVED").otherwise("CHANGED").alias("change"))


def verify(spark: SparkSession, path: str, expected: DataFrame, part: int = PART) -> None:
    """Raises, naming some of the parts, unless the files below path have the part digests that were recorded."""
    found = changes(expected, part_digests(contents(spark, path), part)).orderBy("file", "part").limit(5).collect()
    if found:
        raise ValueError(f"{path} has changed: {[(r.file, r.part, r.change) for r in found]}")
