"""Most frequent value of several attributes per key, in one pass.

Ranking every attribute on its own reads the fact once per attribute and shuffles it twice. Here a
row is unpivoted into (attribute, value) pairs, counted per key in the map tasks, and the winners
of all attributes are picked in one second aggregation over the already small counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute_counts(df: DataFrame, key: str, attributes: Mapping[str, Column], counted: str) -> DataFrame:
    """Rows ``(key, attribute, value, n, n_rows)``; values are text, ``n`` counts non-null ``counted``."""
    narrow = df.select(key, counted, *[a.cast("string").alias(n) for n, a in attributes.items()])
    return (
        narrow.unpivot([key, counted], list(attributes), "attribute", "value")
        .groupBy(key, "attribute", "value")
        .agg(F.count(counted).alias("n"), F.count(F.lit(1)).alias("n_rows"))
    )


def winner(attribute: str, count: str = "n", value: Column | None = None) -> Column:
    """Aggregate over attribute counts: struct (n, value) of the most frequent, lowest value on ties."""
    value = F.col("value") if value is None else value
    ranked = F.struct((-F.col(count)).alias("minus_n"), value.alias("value"))
    return F.min(F.when(F.col("attribute") == attribute, ranked))


def largest_first(*measures: str) -> list[Column]:
    """Descending order as ascending sort fields, missing measures last."""
    return [f for m in measures for f in (F.col(m).isNull(), -F.col(m))]
