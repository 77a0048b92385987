"""The corpus pipeline: quality, near duplicates, benchmark passages, source mix, shards.

Every stage takes (spark, docs, sf_dir), works on all rows it is given, and returns the columns of
``documents``; the last one adds shard and slot. ``run`` writes each stage's rows as Parquet in the shared
folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import quality
from larder.llm.contamination import contaminated
from larder.llm.mixing import mix_sources
from larder.llm.near_dup import near_duplicates
from larder.llm.sharding import shard_records
from larder.llm.stages import stored
from larder.llm.training import train_fold

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the ranking learned from the labels of four folds in five. Rows with null text score as empty."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), train_fold(5, 0))
    scored = quality.score_quality(docs, model, keep=("doc_id", "lang", "source", "n_chars", "text"))
    return scored.filter(F.col("score") >= quality.PASS).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id; rows that repeat an id are one document.

    Documents are linked by five-word shingles and a similarity of 0.8. Rows without id are kept.
    """
    dropped = stored(near_duplicates(docs, shingle_words=5, percent=80).filter("NOT kept").select("doc_id").distinct())
    dropped = dropped.toDF("_dropped")
    kept = docs.join(dropped, F.col("doc_id") == F.col("_dropped"), "left_anti").select(*COLUMNS)
    repeated = stored(docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id").toDF("_again"))
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, F.col("doc_id") == F.col("_again"), "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, F.col("doc_id") == F.col("_again"), "left_anti").union(again)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; rows without id go only if an equal one holds a passage."""
    # A row is known by its id, one without id by its text.
    digest = F.when(F.col("doc_id").isNull(), F.sha2(F.col("text").cast("binary"), 256))
    named = docs.select(F.struct("doc_id", digest.alias("digest")).alias("row"), "text")
    found = contaminated(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_column="row")
    leaks = stored(found.select("row.doc_id", "row.digest").distinct()).toDF("_leak", "_digest")
    same = F.col("doc_id").eqNullSafe(F.col("_leak")) & digest.eqNullSafe(F.col("_digest"))
    return docs.join(leaks, same, "left_anti").select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts toward source weights that grow with the root of a source's size."""
    return mix_sources(docs, power=0.5).select(*COLUMNS)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard of eight and their slot in it."""
    return shard_records(docs.select(*COLUMNS), shards=8)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("source mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier and the shuffles are outside SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
