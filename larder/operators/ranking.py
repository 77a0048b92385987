"""Windows, rankings and paging.

Two families:

* ``window_spec`` with ``top_per_group``: rank and keep the first rows. Spark trims each group to
  the wanted rows in every map task (WindowGroupLimit), so hot groups never travel.
* ``running`` and ``moving``: every row keeps a frame result. A plain window would sort a whole
  group in one task; here a group is cut along its order into segments, which are processed in
  parallel, and small per-segment summaries carry the state across. The result equals the plain
  window. By default the segments are the even parts of a range partitioning by group and order, so
  that a group of any share of the rows is spread accordingly and a small group stays whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from larder.operators.ordering import before, bounds, part_of, sort_keys
from larder.sources.shared import checkpointed


def window_spec(
    partition_by: Sequence[Column | str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    frame: tuple[int, int] | None = None,
) -> WindowSpec:
    """Window from optional partition columns, order columns and a (start, end) row frame."""
    spec = Window.partitionBy(*(partition_by or []))
    if order_by:
        spec = spec.orderBy(*order_by)
    return spec.rowsBetween(*frame) if frame else spec


def top_per_group(
    df: DataFrame, by: Sequence[Column | str], order: Sequence[Column | str], rows: int = 1
) -> DataFrame:
    """The first ``rows`` rows of each group; the order should end in a unique column."""
    rank = F.row_number().over(window_spec(by, order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= rows).drop("_rank")


def page(
    df: DataFrame, order: Sequence[Column | str], number: int, size: int, shallow: int = 10_000, parts: int = 64
) -> DataFrame:
    """Rows ``[number * size, (number + 1) * size)`` in the given order, which should end in a unique column.

    For pages within the first ``shallow`` rows every task keeps only the rows up to the end of the page. A deeper one
    is approached by counting: bounds drawn from a sample cut the order into ``parts``, one pass over the order columns
    counts the rows of each, and the page lies in one or a few of them; that stretch is cut again until it holds
    few rows. Only these are sorted, and the conditions on them are plain comparisons that reach the scan.
    """
    first, last = number * size, (number + 1) * size
    if last <= shallow:
        return df.orderBy(*order).offset(first).limit(size)
    keys = sort_keys(order)
    ordered = [k.column for k in keys]
    stretch, rows, skipped = df, df.count(), 0
    if first >= rows:
        return df.limit(0)
    while rows > shallow:
        cuts = bounds(stretch, keys, parts, rows)
        if not cuts:
            break  # all sampled rows have one order value
        counted = dict(map(tuple, stretch.groupBy(part_of(df, keys, cuts)).count().collect()))
        earlier = [0, *accumulate(counted.get(i, 0) for i in range(len(cuts) + 1))]
        low = max(i for i, n in enumerate(earlier[:-1]) if n <= first - skipped)
        high = min(i for i, n in enumerate(earlier) if i > low and n >= min(last - skipped, rows))
        if earlier[high] - earlier[low] == rows:
            break  # rows with one order value, or a page as long as the stretch
        if low:
            stretch = stretch.filter(~before(df, keys, cuts[low - 1]))
        if high <= len(cuts):
            stretch = stretch.filter(before(df, keys, cuts[high - 1]))
        skipped, rows = skipped + earlier[low], earlier[high] - earlier[low]
    return stretch.orderBy(*ordered).offset(first - skipped).limit(size)


#: More parts than these would make the plan's expressions too long; they are fixed by a checkpoint instead.
MOST_LITERAL_PARTS = 256


def _segmented(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], segment: Column | None
) -> DataFrame:
    if segment is not None:
        return df.withColumn("_segment", segment)
    # Every use of the segments must see the same bounds: they are literals, from one sample of the order columns.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts <= MOST_LITERAL_PARTS:
        keys = sort_keys([*by, *order])
        return df.withColumn("_segment", part_of(df, keys, bounds(df, keys, parts)))
    ranged = df.repartitionByRange(*by, *order)
    return checkpointed(ranged.withColumn("_segment", F.spark_partition_id()))


def _seeded(df: DataFrame, seeds: DataFrame) -> DataFrame:
    """Rows together with the carried rows, which sort before the rows of their segment."""
    return df.withColumn("_seed", F.lit(False)).unionByName(
        seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True
    )


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    segment: Column | None = None,
) -> DataFrame:
    """Cumulative sums over each group in order, one output column per entry of ``sums``.

    Use ``F.lit(1)`` as a value to number the rows. The total of the earlier segments enters each
    segment as one extra first row.

    Data already held in fine steps of its order can name the step as ``segment``, say the hour of
    the timestamp, and save the range partitioning. It must not decrease along ``order`` within a
    group, and rows with equal order values must share it.
    """
    keys = [*by, "_segment"]
    values = {n: f"_value_{n}" for n in sums}
    base = _segmented(df.withColumns({values[n]: v for n, v in sums.items()}), by, order, segment)

    earlier = window_spec(by, ["_segment"], (Window.unboundedPreceding, -1))
    position = F.row_number().over(window_spec(by, ["_segment"]))
    seeds = (
        base.groupBy(*keys)
        .agg(*[F.sum(v).alias(v) for v in values.values()])
        .withColumns({**{v: F.sum(v).over(earlier) for v in values.values()}, "_position": position})
        .filter(F.col("_position") > 1)
        .drop("_position")
    )
    inside = window_spec(keys, [F.desc("_seed"), *order], (Window.unboundedPreceding, Window.currentRow))
    return (
        _seeded(base, seeds)
        .withColumns({n: F.sum(v).over(inside) for n, v in values.items()})
        .filter(~F.col("_seed"))
        .drop("_seed", "_segment", *values.values())
    )


def moving(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    preceding: int,
    aggregates: Mapping[str, Column],
    segment: Column | None = None,
) -> DataFrame:
    """Aggregates over the current row and up to ``preceding`` earlier rows of its group.

    ``segment`` as in ``running``; ``order`` names columns that identify a row of its group. Each
    segment borrows the last rows of the segments before it, ``preceding`` in all at most, as rows.
    """
    keys = [*by, "_segment"]
    base = _segmented(df, by, order, segment)

    # One row for each segment of a group: how many rows of the group come before it, and how many up to its end.
    earlier = window_spec(by, ["_segment"], (Window.unboundedPreceding, -1))
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    spans = sizes.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    # A segment lends its last rows to those later ones of its group that begin within ``preceding`` rows of its end.
    ends = spans.select(*[F.col(k).alias(f"_from{i}") for i, k in enumerate(keys)], (F.col("_start") + F.col("_rows")).alias("_end"))
    same = F.lit(True)
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_from{i}"))
    gap = (F.col("_start") - F.col("_end")).alias("_gap")
    later = F.col("_segment") > F.col(f"_from{len(by)}")
    lent = spans.join(ends, same & later & (F.col("_start") - F.col("_end") < preceding))
    loans = lent.select(*[f"_from{i}" for i in range(len(keys))], F.col("_segment").alias("_to"), gap)
    from_end = F.row_number().over(window_spec(keys, [F.desc(c) for c in order]))
    tails = base.withColumn("_rank", from_end).filter(F.col("_rank") <= preceding)
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_from{i}"))
    seeds = (
        tails.join(loans, match & (F.col("_rank") + F.col("_gap") <= preceding))
        .withColumn("_segment", F.col("_to"))
        .select(*base.columns)
    )
    inside = window_spec(keys, [F.desc("_seed"), *order], (-preceding, Window.currentRow))
    return (
        _seeded(base, seeds)
        .withColumns({n: a.over(inside) for n, a in aggregates.items()})
        .filter(~F.col("_seed"))
        .drop("_seed", "_segment")
    )
