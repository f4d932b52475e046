"""Scans and sinks."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

READ_ONLY = "SET SESSION CHARACTERISTICS AS TRANSACTION READ ONLY"


def jdbc_options(url: str, table: str, **more: str) -> dict[str, str]:
    """Options of a full-table scan whose session is read-only before its first statement."""
    return {"url": url, "dbtable": table, "sessionInitStatement": READ_ONLY, "fetchsize": "10000"} | more


def read_jdbc(spark: SparkSession, url: str, table: str, probe: str | None = "SELECT current_setting('transaction_read_only') AS state", **more: str) -> DataFrame:
    """A table of a database; unless probe is None, fails at once if the session isn't read-only.

    partitionColumn, lowerBound, upperBound and numPartitions spread the scan over tasks.
    """
    if probe:
        options = {k: v for k, v in jdbc_options(url, table, **more).items() if k not in ("dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
        state = spark.read.format("jdbc").options(**options, query=probe).load().first()[0]
        if str(state).lower() not in ("on", "true", "1"):
            raise PermissionError("the database session is not read-only")
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **more)).load()


class Database:
    """A JDBC source that is read in one state: opened read-only, cut at the source's own quantiles, each cut a task.

    freeze and thaw are statements that keep the source's state, or let it go, while tasks read: a database that exports snapshots
    gives one to every session (`snapshot` is the statement that adopts it, with {} for its name); one that can be switched to
    read-only access is switched.
    """

    def __init__(self, spark: SparkSession, url: str, driver: str, freeze: Sequence[str] = (), thaw: Sequence[str] = (), snapshot: tuple[str, str] | None = None, session: str | None = READ_ONLY):
        self.spark, self.url, self.driver = spark, url, driver
        self._freeze, self._thaw, self._snapshot, self._session = freeze, thaw, snapshot, session

    def _connect(self):
        jvm = self.spark._jvm
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.driver)
        return jvm.java.sql.DriverManager.getConnection(self.url)

    def execute(self, *statements: str) -> None:
        connection = self._connect()
        try:
            for text in statements:
                connection.createStatement().execute(text)
        finally:
            connection.close()

    def bounds(self, table: str, column: str, parts: int, limit: str = "OFFSET {} ROWS FETCH NEXT 1 ROWS ONLY") -> list[str]:
        """Values of column that cut the table in parts of about as many rows; the source's own, so the driver sees a value a part."""
        connection = self._connect()
        try:
            def one(query: str):
                rows = connection.createStatement().executeQuery(query)
                return rows.getString(1) if rows.next() else None

            n = int(one(f"SELECT count({column}) FROM {table}"))
            cuts = [one(f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL ORDER BY {column} {limit.format(n * i // parts)}") for i in range(1, parts)] if n else []
        finally:
            connection.close()
        return list(dict.fromkeys(c for c in cuts if c is not None))

    @staticmethod
    def predicates(column: str, cuts: Sequence[str], quote: bool) -> list[str]:
        """Conditions that hold every row in just one: nulls in the first."""
        literal = lambda c: "'" + c.replace("'", "''") + "'" if quote else c
        if not cuts:
            return ["1 = 1"]
        first, last = f"{column} < {literal(cuts[0])} OR {column} IS NULL", f"{column} >= {literal(cuts[-1])}"
        return [first, *[f"{column} >= {literal(a)} AND {column} < {literal(b)}" for a, b in zip(cuts, cuts[1:], strict=False)], last]

    @contextmanager
    def reading(self) -> Iterator[Callable[..., DataFrame]]:
        """Within it the source keeps its state; what it gives reads a table: (table, column, parts) -> DataFrame."""
        self.execute(*self._freeze)
        holder, init = None, self._session
        try:
            if self._snapshot:
                export, adopt = self._snapshot
                holder = self._connect()
                holder.setAutoCommit(False)
                rows = holder.createStatement().executeQuery(export)
                rows.next()
                init = adopt.format(rows.getString(1))

            def read(table: str, column: str, parts: int = 8) -> DataFrame:
                kind = dict(self._frame(f"(SELECT {column} FROM {table} WHERE 1 = 0) t", None, init).dtypes)
                quote = next(iter(kind.values())) in ("string", "date", "timestamp")
                return self._frame(table, self.predicates(column, self.bounds(table, column, parts), quote), init)

            yield read
        finally:
            if holder is not None:
                holder.close()
            self.execute(*self._thaw)

    def _frame(self, table: str, predicates: Sequence[str] | None, init: str | None) -> DataFrame:
        more = {"driver": self.driver, "fetchsize": "10000"} | ({"sessionInitStatement": init} if init else {})
        if predicates is None:
            return self.spark.read.format("jdbc").options(url=self.url, dbtable=table, **more).load()
        return self.spark.read.jdbc(self.url, table, predicates=list(predicates), properties=more)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """UTF-8 with a header, with or without a byte order mark; never inferred."""
    return spark.read.csv(path, header=True, schema=schema, encoding="UTF-8", enforceSchema=True)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Never overwrites."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """A report in one part; df must be a report's few rows, not data."""
    (df.orderBy(*order_by) if order_by else df).coalesce(1).write.mode("errorifexists").csv(path, header=True)


def write_json(value: object, path: str | Path) -> None:
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str), encoding="utf-8")


def flatten(value: dict, prefix: str = "") -> dict[str, object]:
    """Nested keys joined by dots."""
    out: dict[str, object] = {}
    for key, item in value.items():
        out |= flatten(item, f"{prefix}{key}.") if isinstance(item, dict) else {f"{prefix}{key}": item}
    return out


def schema_dump(df: DataFrame) -> dict:
    return df.schema.jsonValue()
