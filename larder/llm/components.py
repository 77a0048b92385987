"""Connected components of a graph too large for one machine: contraction along random orders of the vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.stages import stored

#: Rounds that share an order: a star needs two, one to meet in its least leaf and one to end there.
ROUNDS_OF_ORDER = 2


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``edges`` (a, b); a component is named by its least vertex.

    Each round, every vertex points to the first of itself and its neighbours in a hashed order, and edges are
    renamed to what their ends point to. Orders change with the rounds and are unrelated to names, so
    that about half of a chain disappears in the first round of an order, however its vertices are named:
    the expected rounds are logarithmic in the number of vertices. The least vertex names a component at the end.

    Tables of a round are written, so that joins read plain files, whose hot keys the adaptive skew rule
    can split; what a vertex points to is combined before it is shuffled. Nulls take no part; loops name
    their vertex. An empty table gives an empty one.
    """
    edges = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    both = stored(edges.union(edges.select("b", "a")).distinct())
    rounds = []
    while True:
        order = F.lit(len(rounds) // ROUNDS_OF_ORDER)
        place = lambda c: F.struct(F.xxhash64(c, order).alias("at"), F.col(c).alias("name"))
        first = F.least(place("a"), F.min(place("b")))["name"]
        parents = stored(both.groupBy("a").agg(first.alias("parent")).withColumnRenamed("a", "vertex"))
        rounds.append(parents)
        left, right = parents.toDF("_a", "_pa"), parents.toDF("_b", "_pb")
        renamed = both.join(left, F.col("a") == F.col("_a")).select(F.col("_pa").alias("a"), "b")
        renamed = renamed.join(right, F.col("b") == F.col("_b")).select("a", F.col("_pb").alias("b"))
        both = stored(renamed.filter("a <> b").distinct())
        if both.isEmpty():
            break
    result = rounds[0]
    for parents in rounds[1:]:
        onward = parents.toDF("_v", "_p")
        result = stored(
            result.join(onward, F.col("parent") == F.col("_v"), "left").select(
                "vertex", F.coalesce("_p", "parent").alias("parent")
            )
        )
    names = stored(result.groupBy(F.col("parent").alias("_p")).agg(F.min("vertex").alias("component")))
    return result.join(names, F.col("parent") == F.col("_p")).select("vertex", "component")
