"""File scans by format name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Schema = StructType | str | None


def _csv(spark: SparkSession, path, schema: Schema, **options) -> DataFrame:
    """Header row first; without a schema every column is text."""
    reader = spark.read.options(**{"header": True, **options})
    return (reader.schema(schema) if schema else reader).csv(path)


def _json(spark: SparkSession, path, schema: Schema, **options) -> DataFrame:
    """Whole-document JSON. Such a file is one task; pass ``multiLine=False`` for line-delimited files."""
    reader = spark.read.options(**{"multiLine": True, **options})
    return (reader.schema(schema) if schema else reader).json(path)


def _columnar(kind: str):
    def scan(spark: SparkSession, path, schema: Schema, **options) -> DataFrame:
        return spark.read.format(kind).options(**options).load(path)

    return scan


SCANS = {
    "csv": _csv,
    "json": _json,
    "geojson": _json,
    "parquet": _columnar("parquet"),
    "delta": _columnar("delta"),
}


def scan(spark: SparkSession, kind: str, path: str | list[str], schema: Schema = None, **options) -> DataFrame:
    """Read ``path`` as csv, json, geojson, parquet or delta."""
    kind = kind.lower()
    if kind not in SCANS:
        raise ValueError(f"unsupported file type {kind!r}")
    return SCANS[kind](spark, path, schema, **options)


def write_mode(loadtype: str, mode: str | None = None) -> str:
    """An explicit mode wins; a full load overwrites, any other appends."""
    return mode or ("overwrite" if loadtype == "full" else "append")
