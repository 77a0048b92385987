"""Dropped files as a stream: each file is taken in once, and merged by key.

Spark's file source keeps which files it has seen in the progress folder. A run takes what is new and ends
(``availableNow``); one that dies is taken up where it was, and the micro-batch that was under way is merged again, which
changes nothing as merging is by key. The file list replaces the change window: late rows of a new file count, but
an older row never displaces a newer one, in whatever order files arrive.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.operators.clean import drop_repeats
from larder.plans import jobs
from larder.sources import lake
from larder.tables import table

#: Files of one micro-batch at most; what is left goes into the next.
FILES_AT_ONCE = 1000


def newest(held: DataFrame, changes: DataFrame, keys: Sequence[str], prefer: Sequence[Column | str]) -> DataFrame:
    """The changes with each key once, the row that comes first by ``prefer``; keys whose stored row does are left out.

    Of the stored rows only those with a key among the changes are compared.
    """
    rivals = held.join(changes.select(*keys).distinct(), list(keys), "left_semi").select(*changes.columns)
    both = changes.withColumn("_stored", F.lit(False)).unionByName(rivals.withColumn("_stored", F.lit(True)))
    # Equal rows: the stored one stays, so a micro-batch that is repeated changes nothing.
    return drop_repeats(both, keys, [*prefer, F.desc("_stored")]).filter(~F.col("_stored")).drop("_stored")


def follow(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    take: Callable[[DataFrame], None],
    progress: str,
    files_at_once: int = FILES_AT_ONCE,
) -> None:
    """Hand all new CSV files below ``path``, a glob, to ``take`` in micro-batches, and return.

    A header that differs from the schema fails the run instead of filling the wrong columns.
    """
    stream = (
        spark.readStream.schema(schema)
        .options(header=True, enforceSchema=False, maxFilesPerTrigger=files_at_once)
        .csv(path)
    )

    def batch(rows: DataFrame, _: int) -> None:
        rows = rows.persist()  # read once, though a merge looks at its changes several times
        try:
            take(rows)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start().awaitTermination()


def text_schema(name: str) -> str:
    """The columns of a dropped file of this table, all as text."""
    fields = StructType.fromDDL(table(name).schema).fieldNames()
    return ", ".join(f"{f} string" for f in fields)


def follow_landing(target: jobs.Lake, root: str, name: str, files_at_once: int = FILES_AT_ONCE) -> None:
    """Clean and merge what was dropped for a raw table since the last run, into its stored table."""
    spec = table(name)

    def take(rows: DataFrame) -> None:
        changes = jobs.cleaned(name, rows)
        if target.has(name):
            changes = jobs.written(changes, f"{target.table(name).folder}/delta/{lake.today()}/landed.parquet")
            order = jobs.preference(name, changes.drop("ingested_at"))
            changes = newest(target.read(name), changes, spec.key, order)
        jobs.store(target, name, changes, "delta")

    path = lake.landing_path(root, name, "full", runtype=target.runtype)
    follow(target.spark, path, text_schema(name), take, f"{target.table(name).folder}/progress", files_at_once)
