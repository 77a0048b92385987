"""Links between members of shared buckets, verified on full sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.components import components
from larder.llm.stages import discard, stored

Expand = Callable[[Column], Column]


def _as_is(column: Column) -> Column:
    return column


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, expand: Expand) -> DataFrame:
    """Pairs (a, b) whose full sets have ``100 * shared >= percent * united``."""
    a = sets.select(F.col("_id").alias("_ia"), F.col("_set").alias("_sa"), F.col("_n").alias("_na"))
    b = sets.select(F.col("_id").alias("_ib"), F.col("_set").alias("_sb"), F.col("_n").alias("_nb"))
    joined = pairs.join(a, F.col("a") == F.col("_ia")).join(b, F.col("b") == F.col("_ib"))
    shared = F.size(F.array_intersect(expand(F.col("_sa")), expand(F.col("_sb"))))
    return joined.filter((100 + percent) * shared >= percent * (F.col("_na") + F.col("_nb"))).select("a", "b")


def _apart_pairs(groups: DataFrame, sets: DataFrame, percent: int, expand: Expand) -> DataFrame:
    """Pairs (a, b) of one group, in different components, that may reach the similarity.

    ``groups`` has (leader, id, n, component, home): home is the leader's component. Members differ from
    their leader in a set of elements each, their delta. Two members differ in what only one of their
    deltas holds, so the similarity needs an overlap of the deltas that grows with their sizes, and sizes that are near. Elements
    are taken in the order of how few deltas of the group hold them; then two deltas with that overlap
    share one of their first elements, the delta's size less the overlap plus one of each, and the first one
    shared leaves room for the rest of the overlap. What nearly all members share comes last, and so a
    large group is not paired with itself.
    """
    mine = sets.select(F.col("_id").alias("_ia"), F.col("_set").alias("_sa"))
    head = sets.select(F.col("_id").alias("_ib"), F.col("_set").alias("_sb"))
    deltas = groups.join(mine, F.col("id") == F.col("_ia")).join(head, F.col("leader") == F.col("_ib"))
    deltas = deltas.withColumn("_sa", expand(F.col("_sa"))).withColumn("_sb", expand(F.col("_sb")))
    delta = F.concat(F.array_except("_sa", "_sb"), F.array_except("_sb", "_sa"))
    deltas = deltas.select("leader", "id", "n", "component", "home", delta.alias("delta"))
    deltas = stored(deltas.withColumn("d", F.size("delta")))
    away = F.col("component") != F.col("home")
    bounds = stored(
        deltas.groupBy(F.col("leader").alias("_l")).agg(
            F.min("d").alias("any"),
            F.min(F.when(away, F.col("d"))).alias("away"),
            F.max("d").alias("most"),
            F.max(F.when(away, F.col("d"))).alias("most_away"),
            F.max("n").alias("longest"),
        )
    )
    # |x only or y only| <= (n_x + n_y) * (100 - p) / (100 + p); the overlap is half of what the deltas have more.
    other = F.least(F.col("longest"), F.floor(F.col("n") * 100 / percent))
    allowed = (F.col("n") + other) * (100 - percent) / (100 + percent)
    # Deltas whose sizes differ by more than that can't meet either, so a large one needs nearly all of another.
    least = F.greatest(F.when(away, F.col("any")).otherwise(F.col("away")), F.col("d") - allowed)
    needed = F.greatest(F.ceil((F.col("d") + least - allowed) / 2 - 1e-9), F.lit(1))
    able = deltas.join(bounds, F.col("leader") == F.col("_l")).withColumn("needed", needed)
    able = able.filter((F.col("needed") <= F.col("d")) & (F.col("needed") <= F.when(away, F.col("most")).otherwise(F.col("most_away"))))
    able = stored(able.select("leader", "id", "n", "component", "delta", "d", "needed"))
    discard(deltas, bounds)
    elements = able.select("leader", "id", F.explode("delta").alias("e"))
    held = elements.groupBy(F.col("leader").alias("_l"), F.col("e").alias("_e")).agg(F.count("*").alias("held"))
    held = stored(held.filter("held > 1"))
    common = elements.join(held, (F.col("leader") == F.col("_l")) & (F.col("e") == F.col("_e")))
    listed = common.groupBy(F.col("leader").alias("_l"), F.col("id").alias("_i")).agg(
        F.array_sort(F.collect_list(F.struct("held", "e"))).alias("shared")
    )
    listed = stored(listed)
    discard(held)
    firsts = able.join(listed, (F.col("leader") == F.col("_l")) & (F.col("id") == F.col("_i")))
    # Elements that no other delta holds come before all others and use up their places.
    places = F.col("d") - F.col("needed") + 1 - (F.col("d") - F.size("shared"))
    firsts = firsts.filter(places > 0).select(
        "leader", "id", "n", "component", "d", F.size("shared").alias("_k"),
        F.posexplode(F.slice("shared", 1, places.cast("int"))).alias("_at", "s"),
    )
    # What can still be shared after this element.
    firsts = stored(firsts.select("leader", F.col("s.e").alias("e"), "id", "n", "component", "d", (F.col("_k") - F.col("_at")).alias("rest")))
    discard(able, listed)
    left, right = firsts.toDF("_la", "_ea", "a", "na", "ca", "da", "ra"), firsts.toDF("_lb", "_eb", "b", "nb", "cb", "db", "rb")
    overlap = F.col("da") + F.col("db") - (F.col("na") + F.col("nb")) * (100 - percent) / (100 + percent)
    met = (F.col("_la") == F.col("_lb")) & (F.col("_ea") == F.col("_eb")) & (F.col("a") < F.col("b"))
    met = met & (2 * F.least("ra", "rb") >= overlap - 1e-9)
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return left.join(right, met & (F.col("ca") != F.col("cb")) & fits).select("a", "b").distinct()


def links(
    buckets: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, expand: Expand = _as_is
) -> DataFrame:
    """Edges (a, b) that connect whatever pairs of a shared bucket with Jaccard ``percent`` or more connect.

    ``buckets`` has (bucket, id). ``sets_of`` gives (_id, _set), distinct hashes, for a table of ids; where
    ``expand`` is given, ``_set`` is a shorter form from which it makes that set. Members of a bucket are
    first compared with one leader, the member in most shared buckets, which is near the middle of a group
    of near copies. Only pairs of one bucket whose members are still in different
    components, and whose differences from their leader allow the similarity, are then compared.
    """
    ends = buckets.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    shared = stored(ends.filter("first <> last").select(F.col("bucket").alias("_b")))
    several = buckets.join(shared, F.col("bucket") == F.col("_b"), "left_semi").select("bucket", "id").distinct()
    several = stored(several)
    sets = sets_of(several.select("id").distinct())
    sets = stored(sets.withColumn("_n", F.size(expand(F.col("_set")))))
    known = several.groupBy(F.col("id").alias("_d")).agg(F.count("*").alias("degree"))
    sizes = sets.select("_id", F.col("_n").alias("n")).join(known, F.col("_id") == F.col("_d")).drop("_d")
    sizes = stored(sizes)
    members = stored(several.join(sizes, F.col("id") == F.col("_id")).select("bucket", "id", "n", "degree"))
    heads = members.groupBy("bucket").agg(F.min(F.struct(-F.col("degree"), "id", "n")).alias("h"))
    heads = stored(heads.select(F.col("bucket").alias("_b"), F.col("h.id").alias("leader"), F.col("h.n").alias("nb")))
    led = members.join(heads, F.col("bucket") == F.col("_b")).filter(F.col("id") != F.col("leader"))
    led = stored(led.select("leader", "id", "n", "nb").distinct())
    discard(shared, several, sizes, members, heads)
    stars = led.filter(100 * F.least("n", "nb") >= percent * F.greatest("n", "nb"))
    edges = stored(_verified(stars.select(F.col("leader").alias("a"), F.col("id").alias("b")), sets, percent, expand))
    joined = stored(components(edges))

    # Groups of one leader whose other members are in several components.
    named = led.join(joined.toDF("_v", "_c"), F.col("id") == F.col("_v"), "left")
    named = named.select("leader", "id", "n", F.coalesce("_c", "id").alias("component"))
    named = named.join(joined.toDF("_v", "_c"), F.col("leader") == F.col("_v"), "left")
    named = stored(named.select("leader", "id", "n", "component", F.coalesce("_c", "leader").alias("home")))
    split = named.groupBy(F.col("leader").alias("_l")).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    split = stored(split.filter("lo <> hi").select("_l"))
    groups = stored(named.join(split, F.col("leader") == F.col("_l"), "left_semi"))
    discard(led, joined, named, split)
    pairs = stored(_apart_pairs(groups, sets, percent, expand))
    linked = stored(edges.union(_verified(pairs, sets, percent, expand)))
    discard(groups, sets, edges, pairs)
    return linked
