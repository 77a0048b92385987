"""Tables kept as one partition for each day of a time column, so that a change rewrites the days it touches.

Plain Parquet under Spark's dynamic partition overwrite. A write replaces whole days in one job: the new files are
written aside and put in place when the job commits; days without new rows keep their files. A day that loses its last
row has to be written as well, so each rewritten day gets one marker row, which readers leave out.

A job that dies while Spark puts days in place leaves some new and some old days. Running it again with the same
changes repairs that: rows are removed by key wherever they are found, and put in once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.upsert import upsert

#: Columns that only the files have.
DAY, MARKER = "_day", "_marker"


@dataclass(frozen=True)
class DayTable:
    """``column`` is the time (timestamp, date, or text readable as one) whose day is the partition; it may be null.

    Tables with few rows a day can be kept by ``month`` or ``year``; the partition is then named by its first day.
    """

    path: str
    column: str
    unit: str = "day"

    def __post_init__(self):
        if self.unit not in ("day", "month", "year"):
            raise ValueError(f"unknown unit {self.unit!r}")


def exists(spark: SparkSession, table: DayTable) -> bool:
    days = spark._jvm.org.apache.hadoop.fs.Path(table.path, f"{DAY}=*")
    return bool(days.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(days))


def _files(spark: SparkSession, table: DayTable) -> DataFrame:
    """All rows with their day, markers included."""
    stored = spark.read.parquet(table.path)
    return stored.withColumn(DAY, F.col(DAY).cast("date"))


def read(spark: SparkSession, table: DayTable) -> DataFrame:
    return _files(spark, table).filter(F.col(MARKER).isNull()).drop(DAY, MARKER)


def last_time(spark: SparkSession, table: DayTable):
    """The highest value of the table's time column, None without any, read from the last day that has rows."""
    days = _files(spark, table).filter(F.col(MARKER).isNull() & F.col(DAY).isNotNull()).agg(F.max(DAY)).first()[0]
    if days is None:
        return None
    last = _files(spark, table).filter(F.col(MARKER).isNull() & (F.col(DAY) == F.lit(days)))
    return last.agg(F.max(table.column)).first()[0]


def _day_of(df: DataFrame, table: DayTable) -> Column:
    text = df.schema[table.column].dataType.typeName() == "string"
    day = (F.try_to_timestamp(table.column) if text else F.col(table.column)).cast("date")
    return day if table.unit == "day" else F.trunc(day, table.unit)


def _replace_days(table: DayTable, rows: DataFrame, days: DataFrame) -> None:
    """Write ``rows`` as the whole content of their days and of ``days``; all other days stay as they are."""
    clash = {DAY, MARKER} & set(rows.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    dated = rows.withColumns({MARKER: F.lit(None).cast("boolean"), DAY: _day_of(rows, table)})
    markers = days.select(DAY, F.lit(True).alias(MARKER))
    whole = dated.unionByName(markers, allowMissingColumns=True)
    # Days of any size: large ones are dealt to several tasks, small ones share a task, by their measured bytes.
    writer = whole.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(table.path)


def _known_days(spark: SparkSession, table: DayTable) -> DataFrame:
    """Days that have files, from the partition folders alone."""
    return _files(spark, table).select(DAY).distinct()


def write(spark: SparkSession, table: DayTable, df: DataFrame) -> None:
    """Replace the whole table. The old rows stay until the job commits."""
    nothing = spark.range(1).select(F.lit(None).cast("date").alias(DAY))
    days = nothing.union(_known_days(spark, table)).distinct() if exists(spark, table) else nothing
    _replace_days(table, df, days)


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], nulls_match: bool) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & (left[k].eqNullSafe(right[k]) if nulls_match else left[k] == right[k])
    return match


def _days_with(spark: SparkSession, table: DayTable, wanted: DataFrame, nulls_match: bool) -> list:
    """Days that hold a row with one of the keys ``wanted``, from a join of the key columns alone."""
    keys = wanted.columns
    held = _files(spark, table).filter(F.col(MARKER).isNull()).select(*keys, DAY)
    hit = held.join(wanted, _on(held, wanted, keys, nulls_match), "left_semi")
    return [r[0] for r in hit.select(DAY).distinct().toLocalIterator()]  # a calendar's size at most


def _in_days(days: Sequence) -> Column:
    """Pruned to partition folders when the scan is planned."""
    found = F.col(DAY).isin(*[d for d in days if d is not None])
    return found | F.col(DAY).isNull() if None in days else found


def _changed_days(table: DayTable, rows: DataFrame, days: Sequence) -> list:
    new = rows.select(_day_of(rows, table).alias(DAY)).distinct()
    return sorted({*days, *(r[0] for r in new.toLocalIterator())}, key=lambda d: (d is None, d))


def _as_days(spark: SparkSession, days: Sequence) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], f"{DAY} date")


def replace(spark: SparkSession, table: DayTable, gone: DataFrame, rows: DataFrame, nulls_match: bool = True) -> list:
    """Take out all rows with a key in ``gone`` (the key columns), put in ``rows``. Returns the days written.

    Both are read more than once: hand in written tables. Rows whose day changes leave the old one.
    """
    keys = gone.columns
    days = _changed_days(table, rows, _days_with(spark, table, gone, nulls_match))
    if not days:
        return []
    held = _files(spark, table).filter(F.col(MARKER).isNull() & _in_days(days)).drop(MARKER, DAY)
    left = held.join(gone, _on(held, gone, keys, nulls_match), "left_anti")
    types = {f.name: f.dataType for f in held.schema}
    missing = [c for c in rows.columns if c not in types]
    if missing:
        raise ValueError(f"columns the table lacks: {sorted(missing)}")
    new = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])
    _replace_days(table, left.unionByName(new, allowMissingColumns=True), _as_days(spark, days))
    return days


def merge(
    spark: SparkSession, table: DayTable, changes: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None
) -> list:
    """``operators.upsert`` into the table, over the touched days only. Returns the days written.

    Changes with all columns of the table take the place of the rows they match, so the rows need no join. Others
    are merged value by value; where such a change moves a row to another day, repeat it only after a run that ended.
    Null keys match nothing.
    """
    full = update is None and set(changes.columns) == set(read(spark, table).columns)
    wanted = changes.select(*keys).dropna().distinct()
    if full:
        twice = changes.select(*keys).dropna().groupBy(*keys).count().filter("count > 1").select(*keys)
        if not twice.isEmpty() and _days_with(spark, table, twice, nulls_match=False):
            raise ValueError("several changes for one target row")
        return replace(spark, table, wanted, changes, nulls_match=False)
    days = _days_with(spark, table, wanted, nulls_match=False)
    held = _files(spark, table).filter(F.col(MARKER).isNull() & _in_days(days)).drop(MARKER, DAY)
    merged = upsert(held, changes, keys, update)
    days = _changed_days(table, merged, days)
    if not days:
        return []
    # New rows may fall on days that hold no match: their other rows stay too.
    rest = _files(spark, table).filter(F.col(MARKER).isNull() & _in_days(days))
    touched = _days_with(spark, table, wanted, nulls_match=False)
    beside = rest.filter(~F.coalesce(_in_days(touched), F.lit(False))).drop(MARKER, DAY)
    _replace_days(table, merged.unionByName(beside), _as_days(spark, days))
    return days


def compact(spark: SparkSession, table: DayTable) -> list:
    """Rewrite the days that have more than one file. Returns them."""
    files = _files(spark, table).groupBy(DAY).agg(F.count_distinct("_metadata.file_path").alias("n"))
    days = [r[0] for r in files.filter("n > 1").select(DAY).toLocalIterator()]
    if days:
        held = _files(spark, table).filter(F.col(MARKER).isNull() & _in_days(days)).drop(MARKER, DAY)
        _replace_days(table, held, _as_days(spark, days))
    return days
