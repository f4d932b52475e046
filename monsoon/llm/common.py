"""Shared tables, Arrow batching and reading of inputs for the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a local session gets a temporary one; on a cluster, whose machines don't share theirs, it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        base = context.getCheckpointDir()
        if not base:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="monsoon-")
            context.setCheckpointDir(base)
    return base.rstrip("/")


class Scratch:
    """Tables of one operator run in the shared folder: each write cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df_or_path) -> None:
        """Deletes a table that nothing reads any more."""
        paths = [df_or_path] if isinstance(df_or_path, str) else sorted({f.rsplit("/", 1)[0] for f in df_or_path.inputFiles()})
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in paths:
            if path.split(":", 1)[-1].lstrip("/").startswith(self.root.split(":", 1)[-1].lstrip("/")):
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _col_of(name: str) -> Column:
    """The column of this very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def rekey(column: Column) -> Column:
    """The key under another name for the optimiser: a join on it gets its own exchanges, which adaptive execution may
    split where one key holds many rows; an exchange left over from an aggregation could not be split."""
    return column.bitwiseXOR(F.lit(1))


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which freed memory goes back to the system: workers are kept, and with them what they once needed, beside
    those of the next stage."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError, TypeError):
            pass  # only some C libraries have it

    return whole


_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that Spark sends a worker at a time: of 10,000, its default, texts of usual lengths take 100 MB and more on both sides.
RECORDS = 2048


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str, rows: int = 256) -> DataFrame:
    """mapInArrow over slices of at most `rows` rows, so that a worker's memory doesn't depend on the batch size set; a session's
    setting of more than RECORDS is lowered to it."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_RECORDS)) <= RECORDS:
        conf.set(_RECORDS, RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield from function(batch.slice(at, rows))

    return df.mapInArrow(trimmed(run), schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()
