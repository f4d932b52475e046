"""Schema guards: required columns, unique grains, and joins with a checked cardinality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = ["base_sku", "branch_code"]


class DataError(ValueError):
    """A frame breaks a contract."""


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "frame") -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise DataError(f"{name} misses columns {missing}")
    return df


def normalise_keys(df: DataFrame) -> DataFrame:
    """Origin and target months as dates and horizons as integers, of those that df has; what is neither raises when it is read."""
    months = {c: F.col(c).cast("date") for c in ("forecast_origin", "target_month") if c in df.columns}
    if "horizon" not in df.columns:
        return df.withColumns(months) if months else df
    number = F.col("horizon").cast("string").try_cast("double")
    whole = F.when(number == F.floor(number), number.cast("int")).otherwise(F.raise_error(F.concat(F.lit("horizon is no whole number: "), F.coalesce(F.col("horizon").cast("string"), F.lit("null")))).cast("int"))
    return df.withColumns({**months, "horizon": whole})


def first_known(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """A value that isn't null of each column (of those that hold one value throughout, it), or None; reads no more than it must."""
    row = lambda c: df.where(F.col(c).isNotNull()).select(c).first()
    return {c: found[0] if c in df.columns and (found := row(c)) else None for c in columns}


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, nulls being equal, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "frame") -> DataFrame:
    sample = duplicates(df, keys).limit(20).collect()
    if sample:
        raise DataError(f"{name} is not unique on {list(keys)}: {[r.asDict() for r in sample[:3]]}")
    return df


def assert_none(df: DataFrame, condition, message: str) -> DataFrame:
    """Raises if a row meets the condition."""
    if not df.where(condition).isEmpty():
        raise DataError(message)
    return df


def assert_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise DataError(message)
    return df


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", validate: str = "m:1") -> DataFrame:
    """A join after a check of the sides that `validate` (1:1, 1:m, m:1) wants unique."""
    if validate.startswith("1"):
        assert_unique(left, on, "left side")
    if validate.endswith("1"):
        assert_unique(right, on, "right side")
    return left.join(right, list(on), how)
