"""Change windows and high-water marks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType


def _bound(df: DataFrame, column: str, value) -> Column:
    """The bound as a literal of the column's own type, so that the scan can evaluate the comparison."""
    zoneless = isinstance(df.schema[column].dataType, TimestampNTZType)
    if zoneless and isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    value = value if isinstance(value, Column) else F.lit(value)
    return value.cast("timestamp_ntz") if zoneless else value


def change_window(df: DataFrame, column: str | None, start=None, end=None) -> DataFrame:
    """Rows with ``start < column <= end``. A missing bound is open; without a column all rows are taken.

    Plain comparisons, which Parquet scans and JDBC sources evaluate themselves.
    """
    if column is None:
        return df
    # Times that a source delivers as text are compared as times; what cannot be read is in no window.
    text = isinstance(df.schema[column].dataType, StringType)
    value = F.try_to_timestamp(column) if text else F.col(column)
    if start is not None:
        df = df.filter(value > _bound(df, column, start))
    if end is not None:
        df = df.filter(value <= _bound(df, column, end))
    return df


def high_water_mark(df: DataFrame, column: str = "ingested_at") -> DataFrame:
    """One row with the highest value seen, null for an empty table."""
    return df.agg(F.max(column).alias("high_water_mark"))


def last_loaded(df: DataFrame, column: str = "ingested_at"):
    return high_water_mark(df, column).first()["high_water_mark"]


def bound_text(spark: SparkSession, value) -> str | None:
    """A bound as timestamp text in the session's time zone, for a source that takes the window as SQL."""
    if value is None:
        return None
    value = value if isinstance(value, Column) else F.lit(value)
    return spark.range(1).select(value.cast("string").alias("bound")).first()["bound"]
