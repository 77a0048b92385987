"""Statements for tables in the Delta format, for sessions that have that catalog extension.

The Parquet lake of ``larder.sources.lake`` needs no extension; these do the same work through the
format's own commands, which rewrite only the touched files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_CHANGES = "larder_changes"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge_statement(
    path: str, source: str, columns: Sequence[str], keys: Sequence[str], update: Sequence[str] | None = None
) -> str:
    pairs = " AND ".join(f"t.{_quoted(k)} = s.{_quoted(k)}" for k in keys)
    assigned = ", ".join(f"{_quoted(c)} = s.{_quoted(c)}" for c in (columns if update is None else update))
    names = ", ".join(_quoted(c) for c in columns)
    values = ", ".join(f"s.{_quoted(c)}" for c in columns)
    return (
        f"MERGE INTO delta.{_quoted(path)} t USING {source} s ON {pairs} "
        f"WHEN MATCHED THEN UPDATE SET {assigned} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def merge(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None
) -> None:
    changes.createOrReplaceTempView(_CHANGES)
    spark.sql(merge_statement(path, _CHANGES, changes.columns, keys, update))


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.sql(f"DESCRIBE HISTORY delta.{_quoted(path)}")


def restore(spark: SparkSession, path: str, version: int) -> None:
    spark.sql(f"RESTORE TABLE delta.{_quoted(path)} TO VERSION AS OF {int(version)}")


def compact(spark: SparkSession, path: str) -> None:
    spark.sql(f"OPTIMIZE delta.{_quoted(path)}")
