"""Helpers shared by the operators: written intermediate tables, folds, and columns by name."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.shared import scratch


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, and lost executors don't matter."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables that ``stored`` returned and that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, Spark removes the shuffle files of each query at its end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids fall in fold 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def labelled(docs: DataFrame, labels: DataFrame, mark: str) -> DataFrame:
    """(doc_id, text, label) of the documents whose label is 0 or 1, one row per document and label row."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(mark).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1))
    return docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
