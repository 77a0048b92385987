"""Batch jobs: seed the source, load raw tables, derive products, publish, maintain.

Failures propagate to the caller. ``Lake`` says where a job runs; the Spark session is the caller's.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.menu import lines_to_json
from larder.operators.clean import clean_table
from larder.operators.upsert import upsert
from larder.plans.changes import ROW_WISE, affected_keys, product_keys, rows_of
from larder.plans.registry import derive, sources_of
from larder.sources import daily, lake
from larder.sources.files import scan
from larder.sources.jdbc import Database, Window
from larder.streaming.incremental import bound_text, change_window, last_loaded
from larder.tables import DIMENSIONS, PUBLISHED, SEEDED, TABLES, table

log = logging.getLogger(__name__)

#: Rows of a table, given its name and the bounds of its change window, each of which may be None. A source
#: may return more than the window holds, but all of it.
Fetch = Callable[[str, object, object], DataFrame]

#: What a store returns: the new version, the days a merge wrote, or nothing for a whole write by days.
Stored = lake.Version | list | None


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    runtype: str = "prod"

    def table(self, name: str) -> lake.LakeTable:
        return lake.lake_table(self.root, name, self.runtype)

    def days(self, name: str) -> daily.DayTable | None:
        """Where a table partitioned by days is kept; None for one that is kept as a whole."""
        column = table(name).day_column
        return daily.DayTable(f"{self.table(name).folder}/days", column) if column else None

    def has_days(self, name: str) -> bool:
        days = self.days(name)
        return days is not None and daily.exists(self.spark, days)

    def read(self, name: str) -> DataFrame:
        """The table now; one that was stored before it was kept by days is read from its versions."""
        return daily.read(self.spark, self.days(name)) if self.has_days(name) else lake.read(self.spark, self.table(name))

    def has(self, name: str) -> bool:
        return self.has_days(name) or lake.exists(self.spark, self.table(name))

    def commit(self, name: str, df: DataFrame) -> Stored:
        """Replace the whole table."""
        days = self.days(name)
        return daily.write(self.spark, days, df) if days else lake.commit(self.spark, self.table(name), df)


def database_fetch(spark: SparkSession, database: Database) -> Fetch:
    """Reads from the database, which evaluates the change window itself; of text times it evaluates their days."""

    def fetch(name: str, start=None, end=None) -> DataFrame:
        column, bounds = table(name).change_column, (bound_text(spark, start), bound_text(spark, end))
        return database.read(spark, table=name, window=Window(column, *bounds) if column else None)

    return fetch


def merge_into(target: Lake, name: str, changes: DataFrame, update=None) -> Stored:
    """Stage the changes, then merge them into the current table by its key; by days, only touched ones are written."""
    staged = lake.stage(target.spark, target.table(name), changes)
    if target.has_days(name):
        return daily.merge(target.spark, target.days(name), staged, table(name).key, update)
    return target.commit(name, upsert(target.read(name), staged, table(name).key, update))


def store(target: Lake, name: str, df: DataFrame, loadtype: str) -> Stored:
    """Full loads replace the table; others are merged by key where there is a table to merge into."""
    if loadtype != "full" and target.has(name):
        return merge_into(target, name, df)
    return target.commit(name, df)


def effective_loadtype(name: str, loadtype: str) -> str:
    """What a load of this table does: facts without a change window are always loaded in full."""
    return loadtype if table(name).incremental or name in DIMENSIONS else "full"


def high_water(target: Lake, name: str):
    """Up to where the table's changes were loaded; of a table kept by days of its change column one day is read."""
    column = table(name).change_column
    if target.has_days(name) and table(name).day_column == column:
        return daily.last_time(target.spark, target.days(name))
    return last_loaded(target.read(name), column)


def preference(name: str, df: DataFrame) -> list[Column | str]:
    """Of rows with one key the latest stays, then the least by a hash of the row, so a rerun repeats it.

    Only rows whose hashes are equal too are told apart by their other columns.
    """
    spec = table(name)
    latest = [F.desc(spec.change_column)] if spec.change_column else []
    others = [c for c in df.columns if c not in spec.rules.unique_by and c != spec.change_column]
    return [*latest, F.xxhash64(*others), *others] if others else latest


def cleaned(name: str, source: DataFrame) -> DataFrame:
    return clean_table(source, table(name).rules, prefer=preference(name, source))


def load_raw(target: Lake, name: str, fetch: Fetch, loadtype: str = "full", until=None) -> Stored:
    """Extract, clean and store one raw table.

    Only tables marked incremental are cut to the change window above the stored high-water mark of
    their change column; all others are fetched whole. The window goes to the source, and is applied to
    what it returns.
    """
    spec, loadtype = table(name), effective_loadtype(name, loadtype)
    start = end = None
    if loadtype == "delta" and spec.incremental:
        start = high_water(target, name) if target.has(name) else None
        end = F.current_timestamp() if until is None else until
    source = change_window(fetch(name, start, end), spec.change_column, start, end)
    log.info("loading %s, %s", name, loadtype)
    return store(target, name, cleaned(name, source), loadtype)


def load_dimensions(
    target: Lake, fetch: Fetch, loadtype: str = "full", names: Iterable[str] = DIMENSIONS, at_once: int = 3
) -> dict[str, Stored]:
    """Load dimensions side by side as independent Spark jobs, each in a scheduler pool of its own.

    A failing table does not stop the others; all failures are raised together at the end.
    """

    def load(name: str) -> lake.Version:
        target.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return load_raw(target, name, fetch, loadtype)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {n: pool.submit(load, n) for n in names}
    failures = [(n, f.exception()) for n, f in running.items() if f.exception()]
    if failures:
        raise ExceptionGroup("dimension load failed: " + ", ".join(n for n, _ in failures), [e for _, e in failures])
    return {n: f.result() for n, f in running.items()}


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def enrich(target: Lake, name: str, loadtype: str = "full", **options) -> Stored:
    """Derive one product; the exploded order lines are derived before enriched sales.

    A full load replaces the product. A delta load of a row-wise product (``plans.changes``) derives the rows whose
    inputs were loaded after the product, and puts them in place by key; all others follow from their whole inputs.
    Deleted inputs leave no trace to follow and need a full load.
    """
    if name == "fact_sales_enriched":
        enrich(target, "fact_sales_items", loadtype)
    tables = {n: target.read(n) for n in sources_of(name)}
    if loadtype == "full" or name not in ROW_WISE or not target.has_days(name):
        return target.commit(name, derive(name, tables, **options))
    product = target.read(name)
    mark = last_loaded(product)
    changes = {n: df if mark is None else df.filter(F.col("ingested_at") > mark) for n, df in tables.items()}
    keys = written(affected_keys(name, tables, changes, product), f"{target.table(name).folder}/delta/{lake.today()}/keys.parquet")
    rows = lake.stage(target.spark, target.table(name), rows_of(name, tables, keys, **options))
    return daily.replace(target.spark, target.days(name), product_keys(name, keys), rows)


def publish(
    target: Lake, database: Database, names: Iterable[str] = ("all",), mode: str = "overwrite"
) -> list[str]:
    """Write whole enriched tables to the reporting database, each into its schema."""
    names = list(names)
    chosen = list(PUBLISHED) if names == ["all"] else names
    unknown = [n for n in chosen if n not in PUBLISHED]
    if unknown:
        raise ValueError(f"not published: {unknown}")
    for name in chosen:
        database.write(target.read(name), name, mode, TABLES[name].publish_schema)
    return chosen


def seed_frame(spark: SparkSession, name: str, path: str, **options) -> DataFrame:
    """One source table from its JSON file, nested columns as JSON text."""
    df = scan(spark, "json", path, table(name).schema, **options)
    nested = [f.name for f in df.schema if f.dataType.typeName() == "array"]
    return df.withColumns({n: lines_to_json(n) for n in nested}) if nested else df


def seed(spark: SparkSession, folder: str, database: Database) -> None:
    """Fill the source database from JSON files, parents before children."""
    for name in SEEDED:
        frame = seed_frame(spark, name, f"{folder.rstrip('/')}/{name}.json")
        database.write(frame, name, TABLES[name].seed_mode)


def maintain(target: Lake, layer: str, names: Iterable[str] | None = None, file_bytes: int = 1 << 30) -> list[str]:
    """Compact the stored tables of a layer, or the named ones."""
    chosen = list(names) if names else [n for n, t in TABLES.items() if t.layer == layer]
    present = [n for n in chosen if target.has(n)]
    for name in present:
        if target.has_days(name):
            daily.compact(target.spark, target.days(name))
        else:
            lake.compact(target.spark, target.table(name), file_bytes)
    return present
