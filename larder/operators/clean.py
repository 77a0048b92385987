"""Rule-driven table cleaning.

The step order is part of the contract: a duplicate is removed before values are validated, so an
invalid duplicate may displace a valid one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larder.operators.ranking import top_per_group
from larder.tables import CleaningRules


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip spaces (not tabs) around every string column in one projection."""
    return df.select(*[F.trim(c).alias(c) if is_text(df, c) else F.col(c) for c in df.columns])


def cast_columns(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Lenient casts: what cannot be read as the target type becomes null."""

    def converted(name: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.try_to_timestamp(name) if is_text(df, name) else F.col(name)
        if kind in ("double", "int"):
            return F.col(name).try_cast(kind)
        if kind == "string":
            return F.col(name).cast("string")
        raise ValueError(f"unsupported cast {kind!r} for column {name!r}")

    return df.withColumns({n: converted(n, k) for n, k in casts.items()}) if casts else df


def require(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep rows whose mandatory columns are present, and not empty where they are text."""
    for name in names:
        df = df.filter(F.col(name).isNotNull())
        if is_text(df, name):
            df = df.filter(F.col(name) != "")
    return df


def drop_repeats(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key. ``prefer`` is the order whose first row survives, making the choice repeatable.

    The ranked form keeps a single row per key and task before the shuffle, so a key repeated in a
    large share of the rows stays cheap.
    """
    if not keys:
        return df
    if prefer is None:
        return df.dropDuplicates(list(keys))
    return top_per_group(df, keys, prefer)


def keep_allowed(df: DataFrame, allowed: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows whose values are listed; a missing value is not listed."""
    for name, values in allowed.items():
        df = df.filter(F.col(name).isin(*values))
    return df


def flag_anomalies(df: DataFrame, anomalies: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Add ``<column>_anomaly_flag``; rows stay, and a missing value is no anomaly."""

    def flag(name: str, bounds: Mapping[str, float]) -> Column:
        hit = F.lit(False)
        for side, bound in bounds.items():
            if side not in ("gt", "lt"):
                raise ValueError(f"unknown anomaly bound {side!r} for column {name!r}")
            hit = hit | (F.col(name) > bound if side == "gt" else F.col(name) < bound)
        return F.coalesce(hit, F.lit(False))

    return df.withColumns({f"{n}_anomaly_flag": flag(n, b) for n, b in anomalies.items()}) if anomalies else df


def stamp(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    return df.withColumn("ingested_at", F.current_timestamp() if ingested_at is None else ingested_at)


def clean_table(
    df: DataFrame,
    rules: CleaningRules,
    ingested_at: Column | None = None,
    prefer: Sequence[Column | str] | None = None,
) -> DataFrame:
    """trim, cast, mandatory, unique, allowed, anomaly flags, load time."""
    return (
        df.transform(trim_strings)
        .transform(cast_columns, rules.casts)
        .transform(require, rules.mandatory)
        .transform(drop_repeats, rules.unique_by, prefer)
        .transform(keep_allowed, rules.allowed)
        .transform(flag_anomalies, rules.anomalies)
        .transform(stamp, ingested_at)
    )
