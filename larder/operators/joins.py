"""Join helpers.

Facts meet dimensions by plain left joins on raw dimension scans: Spark broadcasts a dimension
only when its size is under ``spark.sql.autoBroadcastJoinThreshold``, and otherwise the adaptive
skew-join rule splits hot partitions. That rule does not apply when one side is an aggregate, which
is what ``join_back`` is for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup(
    left: DataFrame, dimension: DataFrame, on: str, *columns: str, renamed: Mapping[str, str] | None = None
) -> DataFrame:
    """Left join that takes only the named dimension columns."""
    wanted = dimension.select(on, *columns).withColumnsRenamed(dict(renamed or {}))
    return left.join(wanted, on, "left")


def join_back(rows: DataFrame, per_key: DataFrame, on: str) -> DataFrame:
    """``rows`` left join ``per_key``, an aggregate of them, where one key or null may own a large share of ``rows``.

    The adaptive skew rule splits a join only where both sides are shuffled for the join itself, which an
    aggregate by the same key is not. So the aggregate's few rows of a key are packed once more by a struct
    of the key, whose hash is another, and unpacked after the join. Rows with repeated keys in ``per_key``
    come out once for each, as in any left join.
    """
    payload = [c for c in per_key.columns if c != on]
    packed = (
        per_key.filter(F.col(on).isNotNull())
        .groupBy(F.struct(F.col(on).alias("k")).alias("_key"))
        .agg(F.collect_list(F.struct(*payload)).alias("_matches"))
    )
    joined = rows.join(packed, F.col(on) == F.col("_key.k"), "left")
    joined = joined.select(*rows.columns, F.explode_outer("_matches").alias("_match"))
    return joined.select(*rows.columns, *[F.col("_match")[c].alias(c) for c in payload])


def keep_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Select the named columns that exist, in the given order."""
    return df.select(*[n for n in names if n in df.columns])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
