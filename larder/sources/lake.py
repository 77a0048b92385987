"""Layered Parquet lake.

A table lives under ``<root>/<layer folder>/<table>/``::

    current/base=<b>/v=<n>/              versions; the table is all versions of its highest base
    delta/<YYYY-MM-DD>/<table>.parquet   the batch staged on that day
    current/<table>.delta                the same table in Delta format, where a lake has that instead

An overwrite, merge, restore or compaction writes the whole table as the first version of a new
base; an append adds only its batch. A version counts once Spark has put its ``_SUCCESS`` marker, so
readers never see a half-written one, a failed job can simply run again, and no job overwrites the
files it reads. One writer per table at a time is assumed; conflicting commits are not detected.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.sources.files import scan, write_mode
from larder.tables import TABLES

# Folder of each layer, and of non-production runs.
LAYER_FOLDERS = {
    "raw": "Raw",
    "input": "Input/Borough",
    "enrich": "Enrich/Enriched",
    "system": "System/BalancingResults",
}
SANDBOX = "Sandbox"
LANDING = "DataSource"


def today() -> str:
    return date.today().isoformat()


def area(root: str, runtype: str = "prod") -> str:
    """Where a run keeps its data: the root, or its sandbox for trial runs."""
    return f"{root.rstrip('/')}/{SANDBOX}" if runtype == "dev" else root.rstrip("/")


@dataclass(frozen=True)
class Version:
    base: int
    number: int


@dataclass(frozen=True)
class LakeTable:
    """One table of the lake: ``LakeTable(root, "raw", "fact_sales")``."""

    root: str
    layer: str
    name: str
    runtype: str = "prod"

    def __post_init__(self):
        if self.layer not in LAYER_FOLDERS:
            raise ValueError(f"unknown layer {self.layer!r}")
        if self.runtype not in ("prod", "dev"):
            raise ValueError(f"unknown runtype {self.runtype!r}")

    @property
    def folder(self) -> str:
        return f"{area(self.root, self.runtype)}/{LAYER_FOLDERS[self.layer]}/{self.name}"

    @property
    def current(self) -> str:
        return f"{self.folder}/current"

    @property
    def delta_path(self) -> str:
        return f"{self.current}/{self.name}.delta"

    def staged(self, day: str | None = None) -> str:
        return f"{self.folder}/delta/{day or today()}/{self.name}.parquet"

    def path(self, version: Version) -> str:
        return f"{self.current}/base={version.base}/v={version.number}"


def landing_path(root: str, name: str, loadtype: str, day: str | None = None, runtype: str = "prod") -> str:
    """Dropped CSV files: all days for a full load, else one day."""
    folder = "*" if loadtype == "full" else day or today()
    return f"{area(root, runtype)}/{LANDING}/{folder}/{name}.csv"


def input_path(root: str, file_name: str, runtype: str = "prod") -> str:
    """A file handed in as it is, such as a GeoJSON document."""
    return f"{area(root, runtype)}/{LAYER_FOLDERS['input']}/{file_name}"


def read_landing(
    spark: SparkSession,
    root: str,
    name: str,
    loadtype: str,
    day: str | None = None,
    schema=None,
    runtype: str = "prod",
) -> DataFrame:
    return scan(spark, "csv", landing_path(root, name, loadtype, day, runtype), schema)


def lake_table(root: str, name: str, runtype: str = "prod") -> LakeTable:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return LakeTable(root, TABLES[name].layer, name, runtype)


def _entries(spark: SparkSession, folder: str, prefix: str) -> dict[int, object]:
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    names = {s.getPath().getName(): s.getPath() for s in fs.listStatus(path)}
    return {int(n[len(prefix):]): p for n, p in names.items() if n.startswith(prefix)}


def versions(spark: SparkSession, table: LakeTable) -> list[Version]:
    """Committed versions, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    for base, folder in _entries(spark, table.current, "base=").items():
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for number, path in _entries(spark, folder.toString(), "v=").items():
            if fs.exists(hadoop.Path(path, "_SUCCESS")):
                found.append(Version(base, number))
    return sorted(found, key=lambda v: v.number)


def exists(spark: SparkSession, table: LakeTable) -> bool:
    return bool(versions(spark, table))


def _scan_versions(spark: SparkSession, table: LakeTable, chosen: list[Version]) -> DataFrame:
    return spark.read.option("basePath", table.current).parquet(*[table.path(v) for v in chosen])


def read(spark: SparkSession, table: LakeTable, number: int | None = None) -> DataFrame:
    """The table now, or as of an earlier version number."""
    known = versions(spark, table)
    at = [v for v in known if number is None or v.number == number]
    if not at:
        raise ValueError(f"no {'data' if number is None else f'version {number}'} in {table.current}")
    last = at[-1]
    chosen = [v for v in known if v.base == last.base and v.number <= last.number]
    return _scan_versions(spark, table, chosen).drop("base", "v")


def read_tables(
    spark: SparkSession, root: str, names, runtype: str = "prod", kind: str = "parquet"
) -> dict[str, DataFrame]:
    """Named current tables as a dictionary of lazy DataFrames, from either table format."""
    found = {n: lake_table(root, n, runtype) for n in names}
    if kind == "delta":
        return {n: scan(spark, "delta", t.delta_path) for n, t in found.items()}
    return {n: read(spark, t) for n, t in found.items()}


def commit(spark: SparkSession, table: LakeTable, df: DataFrame, mode: str = "overwrite") -> Version:
    """Write ``df`` as the whole table, or with mode append as an addition to it."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown write mode {mode!r}")
    known = versions(spark, table)
    last = known[-1] if known else None
    number = last.number + 1 if last else 0
    new = Version(last.base if mode == "append" and last else number, number)
    df.write.mode("overwrite").parquet(table.path(new))
    return new


def stage(spark: SparkSession, table: LakeTable, df: DataFrame, day: str | None = None) -> DataFrame:
    """Write the day's batch and read it back: later steps neither recompute nor re-fetch it."""
    df.write.mode("overwrite").parquet(table.staged(day))
    return spark.read.parquet(table.staged(day))


def write(
    spark: SparkSession,
    table: LakeTable,
    df: DataFrame,
    loadtype: str = "full",
    mode: str | None = None,
    day: str | None = None,
) -> Version:
    """Stage the batch of the day, then commit it: a full load replaces the table, any other appends."""
    return commit(spark, table, stage(spark, table, df, day), write_mode(loadtype, mode))


def history(spark: SparkSession, table: LakeTable) -> DataFrame:
    """``(version, base, record_count)`` of the table at each version, from one footer-only scan."""
    per_version = (
        _scan_versions(spark, table, versions(spark, table))
        .groupBy(F.col("base"), F.col("v").alias("version"))
        .agg(F.count(F.lit(1)).alias("added"))
    )
    # One row per version: a table's version list, not its data.
    so_far = Window.partitionBy("base").orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    return per_version.select("version", "base", F.sum("added").over(so_far).alias("record_count"))


def restore(spark: SparkSession, table: LakeTable, number: int) -> Version:
    """Make an earlier version current again, as a new version."""
    return commit(spark, table, read(spark, table, number))


def compact(spark: SparkSession, table: LakeTable, file_bytes: int = 1 << 30) -> Version:
    """Rewrite the table with files of about ``file_bytes``, without a shuffle.

    The scan itself packs small files into tasks of the wanted size and splits larger ones; every
    task then writes one file. The packing options are set on a separate session.
    """
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.parquet.outputTimestampType", "spark.sql.parquet.compression.codec"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.files.maxPartitionBytes", str(file_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    return commit(session, table, read(session, table))


