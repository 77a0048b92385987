"""Mixing sources to target weights by Poisson replication.

A source of n documents with target weight w of a mix of N documents has mean repetition rate N * w / n.
Each document is repeated a Poisson number of times with that mean, found by inverting the distribution at
a number in [0, 1) hashed from the seed and the document. Copies are then shuffled globally.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.stages import stored

#: A mean above this is a sum of equal parts no larger, each inverted at a hash of its own.
LARGEST_PART = 16.0
#: Of a mean up to 16, more than 96 repetitions are rarer than the resolution of a hashed number.
MOST_OF_PART = 96


def unit(key: Column, *marks: object) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 of a key and marks; null keys count as empty."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), *[m if isinstance(m, Column) else F.lit(str(m)) for m in marks])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / float(1 << 52)


def poisson(u: Column, mean: Column) -> Column:
    """The least k whose cumulated probability is above ``u``, for means up to ``LARGEST_PART``."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("below"), F.lit(0).alias("k"))
    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_OF_PART)),
        start,
        lambda s, k: F.when(
            u >= s["below"],
            F.struct((s["p"] * mean / k).alias("p"), (s["below"] + s["p"] * mean / k).alias("below"), k.alias("k")),
        ).otherwise(s),
        lambda s: s["k"],
    )
    return F.when(u < F.exp(-mean), 0).otherwise(end)


def repetitions(key: Column, mean: Column, seed: str) -> Column:
    """How often a document with this key is repeated: Poisson distributed with the mean."""
    parts = F.greatest(F.ceil(mean / LARGEST_PART), F.lit(1)).cast("int")
    counts = F.transform(F.sequence(F.lit(1), parts), lambda i: poisson(unit(key, seed, i.cast("string")), mean / parts))
    return F.aggregate(counts, F.lit(0), lambda acc, k: acc + k)


def source_rates(docs: DataFrame, source: str, weights: Mapping[str, float] | None, power: float, size: float) -> DataFrame:
    """(source, rate) of each source: its mean repetition rate.

    Without weights, targets are counts to a power under one, which lifts small sources. A source that
    ``weights`` leaves out has weight 0. Weights are scaled to sum to one over the sources present.
    """
    counts = docs.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_n"))
    if weights is None:
        target = F.pow(F.col("_n").cast("double"), F.lit(power))
    else:
        target = F.lit(0.0)
        for name, weight in weights.items():
            target = F.when(F.col("_source") == name, float(weight)).otherwise(target)
    counts = stored(counts.withColumn("_target", target))
    total = counts.agg(F.sum("_n").alias("n"), F.sum("_target").alias("t")).first()
    mixed, targets = float(total["n"] or 0) * size, float(total["t"] or 0.0) or 1.0
    return stored(counts.select("_source", (F.lit(mixed) * F.col("_target") / F.lit(targets) / F.col("_n")).alias("_rate")))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    power: float = 0.5,
    size: float = 1.0,
    seed: str = "mix",
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """All columns of the repeated documents, and ``copy`` from 0, in a globally shuffled order.

    ``size`` is the size of the mix as a multiple of the input. A null source is a source of its own. The
    number of repetitions follows from the seed and the id, for rows without id from the seed and a digest of
    the text (null: that of an empty one): rows that repeat an id are repeated alike, and so are rows
    without id of one text. Else texts are not looked at, and the column may be absent. A column already named
    ``copy`` is replaced, all others keep their names and values. An empty table gives an empty one.

    Partitions are dealt by a hash of seed, id and copy, and each is sorted by another such hash.
    How many partitions there are, and with it the order, is the session's choice.
    """
    columns = [c for c in docs.columns if c != "copy"]
    digest = F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary")) if text_column in columns else F.lit("")
    key = F.coalesce(F.col(id_column).cast("string"), digest)
    rates = source_rates(docs, source_column, weights, power, size)
    # A row is one column from here on, so that no other column has the name of one of its own.
    rows = docs.select(F.struct(*columns).alias("row"), F.col(source_column).alias("_source_of"), key.alias("_key"))
    # The rates come from a written table, so adaptive execution can broadcast a small one or split a hot source.
    joined = rows.join(rates, F.col("_source_of").eqNullSafe(F.col("_source")))
    joined = joined.withColumn("_count", repetitions(F.col("_key"), F.col("_rate"), seed)).filter("_count > 0")
    dealt = joined.select("row", "_key", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("copy"))
    place = F.concat_ws(":", "_key", F.col("copy").cast("string"), F.lit(seed))
    dealt = dealt.select("row", "copy", F.xxhash64(place).alias("_deal"), F.xxhash64(place, F.lit("order")).alias("_order"))
    return dealt.repartition("_deal").sortWithinPartitions("_order").select("row.*", "copy")
