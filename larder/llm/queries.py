"""The queries of this package over the test tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, conversations, lm, quality, rules, search, secrets, sharding, toxicity
from larder.llm.contamination import contaminated
from larder.llm.lines import fuzzy_lines
from larder.llm.mixing import mix_sources
from larder.llm.near_dup import near_duplicates
from larder.llm.quality import score_quality
from larder.llm.stages import fold
from larder.llm.training import train_fold
from larder.sources.shared import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    versions = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), "text")
    found = secrets.scan_secrets(versions, scratch(spark))
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("found", lambda f: f["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in kinds],
        secrets.digest(secrets.joined_spans(base)).alias("base_sha256"),
        secrets.joined_spans(F.col("found")).alias("spans"),
    )


@query("op3_minhash_near_dedup")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), shingle_words=2, percent=80)


@query("op7_bradley_terry_quality")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.learn(docs, table(spark, sf, "labels"), train_fold(5, 0))
    return score_quality(docs, model).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.PASS).cast("int").alias("predicted"),
    )


@query("op2_kneser_ney_toxicity")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scorer = toxicity.learn(docs, table(spark, sf, "labels"), train_fold(4, 2))
    return toxicity.score_toxicity(docs, scorer).select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op4_log_bilinear_scores")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    scored = lm.score_texts(table(spark, sf, "documents"), fold("doc_id", 5) != 1)
    return scored.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), *scored.columns[1:])


@query("op6_divergence_rules")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf, "documents"))


@query("op8_two_pass_sharding")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard_records(table(spark, sf, "documents"), shards=8)
    content = F.coalesce("text", F.lit("")).cast("binary")
    return placed.select(
        "doc_id",
        sharding.text_bytes(F.col("text")).alias("size"),
        F.crc32(content).cast("long").alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        sharding.shard_of(F.col("doc_id"), 9).alias("grown_shard"),
    )


@query("op9_simhash_decontamination")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# Means here are below 16, so one hashed number decides each document.
MIXED_SQL = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(n) FROM counts) * sqrt(n) / (SELECT sum(sqrt(n)) FROM counts) / n AS rate FROM counts
),
below AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM rates, range(97) AS t(k)
),
units AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':mix:1'), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents
),
counted AS (
  SELECT *, (SELECT count(*) FROM below AS b WHERE b.source IS NOT DISTINCT FROM units.source AND units.u >= b.p) AS n
  FROM units
)
SELECT doc_id, text, lang, source, n_chars, unnest(range(n))::INT AS copy FROM counted
"""


@query("op5_poisson_mixing", MIXED_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents"))


@query("op10_fuzzy_line_dedup")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return fuzzy_lines(table(spark, sf, "documents"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.repair_report(conversations.damaged(table(spark, sf, "conversations")))


@query("op12_byte_bpe_round_trip")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = bpe.encode_texts(table(spark, sf, "documents").select("doc_id", "text"), vocabulary).drop("text")
    return bpe.decode_ids(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# Terms of a document are counted by (document, term); ids of the test tables are unique.
RANKED_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
),
counted AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted JOIN (SELECT DISTINCT term FROM wanted) USING (term), totals GROUP BY term, docs
),
hits AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))) AS impact
  FROM counted JOIN weights USING (term) JOIN sizes USING (doc_id), totals
),
scored AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM wanted JOIN hits USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""


@query("op13_ranked_search", RANKED_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return search.rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
