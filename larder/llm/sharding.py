"""Shards in random order by a two-pass external shuffle.

First pass: every record goes to one of its shard's buckets, sized for memory, by seeded hashes. Second
pass: each bucket is shuffled in memory (Fisher-Yates with the bucket's seed) and written. A shard is a
fixed run of buckets, so its order is the order of its buckets and of places within them.

A shard follows from id and number of shards alone: the shard with the highest hash of (id, shard) wins.
With one more shard, a record either keeps its shard or goes to the new one.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larder.llm.stages import stored

BUCKET_BYTES = 16 << 20
LAW = "key"


def shard_of(key: Column, shards: int, seed: str = "shard") -> Column:
    """The shard whose hash with the key is highest; a null key is a key like others."""
    named = F.coalesce(key.cast("string"), F.lit(""))
    draws = [F.struct(F.xxhash64(named, F.lit(f"{seed}:{s}")).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return reduce(lambda a, b: F.greatest(a, b), draws)["s"].cast("int") if shards > 1 else F.lit(0)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text and one more; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _shuffled(seed: int):
    def shuffle(table: pa.Table) -> pa.Table:
        shard, bucket = table["shard"][0].as_py(), table["bucket"][0].as_py()
        # Rows arrive in any order; ids and content put them in one order first, so that a rerun repeats it.
        order = pa.compute.sort_indices(table, sort_keys=[(c, "ascending") for c in ("key", "crc", "tie")]).to_numpy()
        order = np.random.default_rng([seed, shard, bucket]).permutation(order)
        return table.take(pa.array(order)).append_column("place", pa.array(np.arange(len(order))))

    return shuffle


def _buckets_of(groups: DataFrame, shards: int, bucket_bytes: int) -> list[int]:
    """How many buckets each shard is scattered into: by its own bytes, since one id may hold much of the input."""
    sizes = {r["shard"]: r["bytes"] for r in groups.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    return [max(1, -(-int(sizes.get(s, 0)) // bucket_bytes)) for s in range(shards)]


def _copies_apart(rows: DataFrame, groups: DataFrame, bucket_bytes: int) -> DataFrame:
    """``rows`` with ``copy``: a number that tells apart the rows of a large group of one id and text, else 0.

    Equal rows are counted, which combines before the shuffle, and written out again as often, each with its number.
    """
    large = stored(groups.filter((F.col("n") > 1) & (F.col("bytes") > bucket_bytes // 4)).select(F.col("same").alias("_same")))
    if large.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("bigint"))
    met = F.col("same") == F.col("_same")
    usual = rows.join(large, met, "left_anti").withColumn("copy", F.lit(0).cast("bigint"))
    several = rows.join(large, met, "left_semi").groupBy(*rows.columns).agg(F.count("*").alias("n"))
    numbered = several.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("i"))
    return usual.unionByName(numbered.withColumn("copy", F.xxhash64("tie", "i")).drop("i"))


def shard_records(
    docs: DataFrame,
    shards: int = 8,
    seed: int = 17,
    bucket_bytes: int = BUCKET_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All columns of all records and their ``shard`` and ``slot``: the place in the shard, gapless from 0.

    Records are written to the shared folder bucket by bucket, in shuffled order, and read back. Null and
    empty texts have size 1. Records with null or repeated ids are kept each; those of one id share a
    shard. Those of one id and text share a bucket too, unless together they exceed a quarter of
    one: then they are scattered over the shard like others. Records equal in id and text come in the order of
    a hash of their other columns. Columns already named ``shard`` or ``slot`` are replaced, all others
    keep their names and values. A single text larger than a bucket is a bucket's content by itself. An
    empty table gives an empty one.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    key, text = F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.coalesce(F.col(text_column), F.lit(""))
    others = [c for c in columns if c != text_column]
    # A row is one column from here on, so that no other column has the name of one of its own.
    rows = docs.select(
        F.struct(*columns).alias("row"),
        shard_of(F.col(id_column), shards).alias("shard"),
        key.alias("key"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(key, text).alias("same"),
        F.xxhash64(F.to_json(F.struct(*others)), text).alias("tie"),
    )
    size = text_bytes(F.col(f"row.`{text_column}`"))
    groups = stored(rows.groupBy("shard", "same").agg(F.sum(size).alias("bytes"), F.count("*").alias("n")))
    buckets = F.array(*[F.lit(n).cast("bigint") for n in _buckets_of(groups, shards, bucket_bytes)])
    bucket = F.pmod(F.xxhash64("same", "copy", F.lit(seed)), F.get(buckets, F.col("shard"))).cast("int").alias("bucket")
    placed = _copies_apart(rows, groups, bucket_bytes).select("row", "shard", bucket, "key", "crc", "tie")
    scattered = placed.groupBy("shard", "bucket").applyInArrow(_shuffled(seed), StructType([*placed.schema, StructField("place", LongType())]))
    written = stored(scattered.select("row", "shard", "bucket", "place"))
    counts = written.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    # Buckets are few rows, however long their texts: a running sum over those of a shard.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    offsets = stored(counts.select(F.col("shard").alias("_s"), F.col("bucket").alias("_b"), offset))
    placed = written.join(offsets, (F.col("shard") == F.col("_s")) & (F.col("bucket") == F.col("_b")))
    return placed.select("row.*", "shard", (F.col("offset") + F.col("place")).alias("slot"))
