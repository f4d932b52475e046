"""Stored stages: bucketed tables that later windows and joins read without an exchange, and guards that cost no pass.

A stage is written once a session for the same input files.  What must hold is counted while it is written, by metrics that the
job itself observes; a stage that breaks a guard is dropped and its reader gets an error.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from monsoon.schema import DataError
from monsoon.sources.stored import shared_dir

_made: dict[tuple, str] = {}
_lock = threading.RLock()


class Guards:
    """Conditions that no row may meet, counted where watch() stands in a plan whenever the plan runs.

    check() raises after the action; it is an error to ask before one.
    """

    def __init__(self, name: str):
        self.name, self._seen = name, []

    def watch(self, df: DataFrame, bad: dict[str, Column], some: bool = False) -> DataFrame:
        """df with these conditions observed; with some, a frame without rows is a violation too."""
        seen = Observation(f"{self.name}-{uuid.uuid4().hex}")
        self._seen.append((seen, some))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in bad.items()])

    def counts(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for seen, some in self._seen:
            found = dict(seen.get)
            n = found.pop("n_rows")
            out |= found | ({"no_rows": int(n == 0)} if some else {})
        return out

    def check(self) -> None:
        broken = {k: n for k, n in self.counts().items() if n}
        if broken:
            raise DataError(f"{self.name}: {broken}")


def repeats(keys: Sequence[str], order: str) -> Column:
    """Whether a row repeats the key and order of another: a window over what later windows need too, so no exchange of its own."""
    return F.coalesce(F.lag(order).over(Window.partitionBy(*keys).orderBy(order)) == F.col(order), F.lit(False))


def bucketed(df: DataFrame, name: str, keys: Sequence[str], order: str, guards: Guards | None = None, buckets: int | None = None) -> str:
    """The name of df as a table bucketed by keys, sorted by keys and order, in the shared folder; raises and leaves nothing if a guard breaks."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"monsoon_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/stages/{table}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys, order).option("path", path).option("compression", "zstd").saveAsTable(table)
    try:
        if guards:
            guards.check()
    except DataError:
        spark.sql(f"DROP TABLE {table}")
        raise
    return table


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Names, lengths and times of the files below paths."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.getFileStatus(p).isFile():
            found = [fs.getFileStatus(p)]
        else:
            files, found = fs.listFiles(p, True), []
            while files.hasNext():
                found.append(files.next())
        out += sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in found)
    return tuple(out)


def once(spark: SparkSession, inputs: tuple, name: str, build: Callable[[], str], there: Callable[[str], bool] = lambda made: True) -> str:
    """What build gave for these inputs at its first use in a session; built again if it is no longer there."""
    key = (spark.sparkContext.applicationId, inputs, name)
    with _lock:
        if key not in _made or not there(_made[key]):
            _made[key] = build()
        return _made[key]


def stage(spark: SparkSession, inputs: tuple, name: str, build: Callable[[], str]) -> DataFrame:
    """The stage of this name over these inputs; build writes its table and gives its name."""
    return spark.table(once(spark, inputs, name, build, spark.catalog.tableExists))
