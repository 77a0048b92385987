"""Merge a change set into a table by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None
) -> DataFrame:
    """Target after the merge.

    A matched row takes the change's values, nulls included, for all its columns or those in
    ``update``; a change without a partner is inserted as a whole; other target rows stay. Null
    keys never match. Two changes for one target row fail the job.

    The target is only ever the streamed side of a left join, so Spark broadcasts a change set under
    its size threshold and does not shuffle the target at all; a larger one meets it in a sort-merge
    join on the key. Grouping by the key as one struct makes both sides of that join plain shuffles,
    the form in which adaptive execution splits hot or missing target keys. Known keys are found from
    the key columns alone. ``changes`` is read several times: hand in a written table, not a plan that
    gives new rows each time.
    """
    missing = [c for c in [*changes.columns, *keys] if c not in target.columns]
    missing += [c for c in [*(update or []), *keys] if c not in changes.columns]
    if missing:
        raise ValueError(f"columns not on both sides of the merge: {sorted(set(missing))}")
    changes = changes.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in changes.columns])
    updated = [c for c in changes.columns if update is None or c in update]

    per_key = (
        changes.dropna(subset=list(keys))
        .groupBy(F.struct(*keys).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_copies"), *[F.first(c).alias(f"_new_{c}") for c in updated])
    )
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col("_key")[k])
    clash = F.raise_error(F.lit("several changes for one target row"))
    checked = F.when(F.col("_copies") > 1, clash.cast("boolean")).otherwise(F.col("_copies").isNotNull())
    merged = target.join(per_key, match, "left").withColumn("_matched", checked)
    after = merged.select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in target.columns
        ]
    )

    known = target.select(*keys).join(changes.select(*keys), list(keys), "left_semi")
    known = known.select(F.struct(*keys).alias("_key")).distinct().select("_key.*")
    inserts = changes.join(known, list(keys), "left_anti")
    return after.unionByName(inserts, allowMissingColumns=True)
