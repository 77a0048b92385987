"""Merge, windows and joins: semantics, properties, plan shapes and hot keys."""

from __future__ import annotations

import random
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from larder.operators.joins import fill_defaults, join_back, keep_present, lookup
from larder.operators.ranking import moving, page, running, top_per_group, window_spec
from larder.operators.upsert import upsert

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- merge ---------------------------------------------------------------------------------------

ROW = "k string, a int, b string"


def test_upsert_cases(spark, rows):
    target = spark.createDataFrame([("x", 1, "old"), ("keep", 2, "old"), (None, 3, "old")], ROW)
    changes = spark.createDataFrame([("x", None, "new"), ("fresh", 5, "new"), (None, 6, "new")], ROW)
    assert rows(upsert(target, changes, ["k"])) == [
        ("fresh", 5, "new"), ("keep", 2, "old"), ("x", None, "new"), (None, 3, "old"), (None, 6, "new"),
    ]


def test_upsert_subset_updates_some_and_inserts_all(spark, rows):
    target = spark.createDataFrame([("x", 1, "old")], ROW)
    changes = spark.createDataFrame([("x", 9, "new"), ("y", 5, "new")], ROW)
    assert rows(upsert(target, changes, ["k"], update=["b"])) == [("x", 1, "new"), ("y", 5, "new")]


def test_upsert_fills_target_columns_the_change_lacks(spark, rows):
    target = spark.createDataFrame([("x", 1, "old")], ROW)
    changes = spark.createDataFrame([("x", 7), ("y", 8)], "k string, a int")
    assert rows(upsert(target, changes, ["k"])) == [("x", 7, "old"), ("y", 8, None)]


def test_upsert_on_two_keys_and_repeated_target_rows(spark, rows):
    schema = "k string, n int, v int"
    target = spark.createDataFrame([("x", 1, 0), ("x", 1, 5), ("x", 2, 0)], schema)
    changes = spark.createDataFrame([("x", 1, 9)], schema)
    assert rows(upsert(target, changes, ["k", "n"])) == [("x", 1, 9), ("x", 1, 9), ("x", 2, 0)]


def test_upsert_rejects_two_changes_for_one_row_only(spark, rows):
    target = spark.createDataFrame([("x", 1, "old")], ROW)
    twice = spark.createDataFrame([("x", 2, "a"), ("x", 3, "b")], ROW)
    with pytest.raises(Exception, match="several changes"):
        upsert(target, twice, ["k"]).collect()
    fresh = spark.createDataFrame([("y", 2, "a"), ("y", 3, "b")], ROW)
    assert rows(upsert(target, fresh, ["k"])) == [("x", 1, "old"), ("y", 2, "a"), ("y", 3, "b")]


def test_upsert_needs_known_columns(spark):
    target = spark.createDataFrame([("x", 1, "old")], ROW)
    with pytest.raises(ValueError, match="extra"):
        upsert(target, target.withColumn("extra", F.lit(1)), ["k"])
    with pytest.raises(ValueError, match="id"):
        upsert(target, target, ["id"])


def test_small_changes_leave_the_target_unshuffled(spark, tmp_path):
    spark.range(200_000).select(F.col("id").alias("k"), F.lit("v").alias("v")).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(5, "w")], "k bigint, v string").write.parquet(str(tmp_path / "c"))
    target, changes = (spark.read.parquet(str(tmp_path / n)) for n in "tc")
    text = plan(upsert(target, changes, ["k"]))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # Only the changes and the matched keys are regrouped, each by its own aggregate.
    assert len(moved) == 2 and "FullOuter" not in text


keyed = st.dictionaries(st.integers(0, 30), st.integers(), max_size=20)


@quick
@given(target=keyed, changes=keyed)
def test_upsert_properties(spark, rows, target, changes):
    schema = "k long, v long"
    clip = {k: max(min(v, 2**60), -(2**60)) for k, v in target.items()}
    new = {k: max(min(v, 2**60), -(2**60)) for k, v in changes.items()}
    left, right = (spark.createDataFrame(list(d.items()), schema) for d in (clip, new))
    merged = upsert(left, right, ["k"])
    assert dict(map(tuple, merged.collect())) == {**clip, **new}
    assert rows(upsert(merged, right, ["k"])) == rows(merged)


# --- windows -------------------------------------------------------------------------------------


def events(spark, seed: int, n: int = 400):
    """A third of the rows has one key; another part has none."""
    pick = random.Random(seed)
    start = datetime(2025, 1, 1)
    data = [
        (pick.choice(["hot", "hot", "a", "b", None]), start + timedelta(hours=pick.randint(0, 240)), i, pick.choice([None, *range(-5, 50)]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "k string, ts timestamp, id int, v int").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("segment", ["range", "day"])
def test_running_equals_the_plain_window(spark, rows, seed, segment):
    df, segment = events(spark, seed), None if segment == "range" else F.to_date("ts")
    spec = window_spec(["k"], ["ts", "id"], (Window.unboundedPreceding, 0))
    plain = df.withColumns({"total": F.sum("v").over(spec), "number": F.row_number().over(window_spec(["k"], ["ts", "id"]))})
    ours = running(df, ["k"], ["ts", "id"], {"total": F.col("v"), "number": F.lit(1)}, segment)
    assert ours.columns == plain.columns
    assert rows(ours) == rows(plain)


@pytest.mark.parametrize(("seed", "preceding", "segment"), [(1, 1, "range"), (2, 2, "day"), (3, 7, "range"), (4, 7, "day")])
def test_moving_equals_the_plain_window(spark, rows, seed, preceding, segment):
    df, segment = events(spark, seed, 150), None if segment == "range" else F.to_date("ts")
    aggregates = {"total": F.sum("v"), "n": F.count(F.lit(1)), "low": F.min("v")}
    spec = window_spec(["k"], ["ts", "id"], (-preceding, 0))
    plain = df.withColumns({n: a.over(spec) for n, a in aggregates.items()})
    ours = moving(df, ["k"], ["ts", "id"], preceding, aggregates, segment)
    assert ours.columns == plain.columns
    assert rows(ours) == rows(plain)


def test_running_spreads_a_hot_group(spark):
    key = F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(60_000).select(key.alias("k"), "id")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        numbered = running(df, ["k"], ["id"], {"n": F.lit(1)})
        parts = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
        # Every part of the ranges holds a segment of its own, of which none is near the hot group's size.
        ranged = df.repartitionByRange("k", "id").groupBy(F.spark_partition_id().alias("p")).count()
        assert max(r["count"] for r in ranged.collect()) < 12_000
        assert sum(parts) == 60_000 and max(parts) < 40_000
        hot = numbered.filter("k = -1").agg(F.max("n"), F.count_distinct("n"))
        assert tuple(hot.first()) == (40_000, 40_000)
    finally:
        spark.conf.unset(setting)


def test_top_per_group_trims_before_the_shuffle(spark, rows):
    df = events(spark, 4)
    top = top_per_group(df, ["k"], ["ts", "id"], rows=2)
    assert plan(top).count("WindowGroupLimit") == 2
    full = df.withColumn("r", F.row_number().over(window_spec(["k"], ["ts", "id"]))).filter("r <= 2").drop("r")
    assert rows(top) == rows(full)


def test_page_needs_no_global_window(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("g", F.col("id") % 3)
    pages = [r.id for n in range(4) for r in page(df, ["g", F.desc("id")], n, 100).collect()]
    assert pages == [r.id for r in df.orderBy("g", F.desc("id")).limit(400).collect()]
    assert "Window" not in plan(page(df, ["id"], 2, 10))
    assert page(df, ["id"], 10, 100).count() == 0


@pytest.mark.parametrize("shallow", [1, 40])
def test_deep_pages_equal_slices_of_the_sorted_rows(spark, shallow):
    """Both directions, both places of nulls, and ties of the leading column."""
    df = events(spark, 12, 300)
    for order in ([F.desc("k"), "id"], ["v", F.desc("ts"), "id"], [F.asc_nulls_last("v"), F.desc("id")], [F.desc_nulls_first("k"), F.desc("ts"), "id"]):
        whole = [tuple(r) for r in df.orderBy(*order).collect()]
        for number, size in ((0, 7), (5, 7), (29, 10), (1, 150), (40, 10)):
            got = page(df, order, number, size, shallow=shallow, parts=5).collect()
            assert list(map(tuple, got)) == whole[number * size : (number + 1) * size]


def test_a_deep_page_sorts_only_its_stretch(spark, tmp_path):
    spark.range(0, 60_000, 1, 8).select(F.col("id"), (F.col("id") * 7919 % 60_000).alias("n")).write.parquet(str(tmp_path / "t"))
    deep = page(spark.read.parquet(str(tmp_path / "t")), [F.desc("n")], 500, 100, shallow=2000)
    assert [r.n for r in deep.collect()] == list(range(59_999 - 50_000, 59_999 - 50_100, -1))
    text = plan(deep)
    limit = int(text.split("TakeOrderedAndProject(limit=")[1].split(",")[0]) if "TakeOrderedAndProject" in text else 0
    assert limit <= 2000 + 100
    assert "LessThanOrEqual(n" in text and "GreaterThan(n" in text  # the stretch is cut by the scan


def test_pages_without_a_unique_order(spark):
    df = spark.range(500).select((F.col("id") * 0).alias("same"))
    assert page(df, ["same"], 3, 100, shallow=10).count() == 100
    assert page(df.limit(0), ["same"], 3, 100, shallow=10).count() == 0
    with pytest.raises(ValueError, match="by name"):
        page(df, [F.col("same") + 1], 3, 100, shallow=10)


def test_wide_frames_without_checkpoint_or_arrays(spark, rows):
    key = F.when(F.col("id") % 3 > 0, F.lit("hot"))
    df = spark.range(0, 20_000, 1, 6).select(key.alias("k"), "id", (F.col("id") * 31 % 101).alias("v"))
    aggregates = {"total": F.sum("v"), "n": F.count(F.lit(1)), "low": F.min("v")}
    spec = window_spec(["k"], ["id"], (-2000, 0))
    before = spark.sparkContext.getCheckpointDir()
    ours = moving(df, ["k"], ["id"], 2000, aggregates)
    assert spark.sparkContext.getCheckpointDir() == before
    assert rows(ours) == rows(df.withColumns({n: a.over(spec) for n, a in aggregates.items()}))
    assert "collect_list" not in plan(ours) and "Scan ExistingRDD" not in plan(ours)


def test_more_parts_than_literals_are_fixed_by_a_checkpoint(spark, rows, monkeypatch):
    from larder.operators import ranking

    monkeypatch.setattr(ranking, "MOST_LITERAL_PARTS", 2)
    df = events(spark, 5, 120)
    ours = moving(df, ["k"], ["ts", "id"], 9, {"total": F.sum("v")})
    assert rows(ours) == rows(df.withColumn("total", F.sum("v").over(window_spec(["k"], ["ts", "id"], (-9, 0)))))


def test_window_spec_without_parts(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    out = df.select("n", F.sum("n").over(window_spec(order_by=["n"], frame=(-1, 0))).alias("s")).orderBy("n")
    assert [r.s for r in out.collect()] == [1, 3, 5]


# --- joins ---------------------------------------------------------------------------------------


def test_join_back_equals_the_plain_join(spark, rows):
    df = events(spark, 9)
    per_key = df.filter("k <> 'b'").groupBy("k").agg(F.count("id").alias("n"), F.sum("v").alias("total"))
    repeated = per_key.union(per_key.withColumn("total", F.col("total") + 1))
    for side in (per_key, repeated, per_key.limit(0)):
        plain = df.join(side, "k", "left").select(*df.columns, "n", "total")
        ours = join_back(df, side, "k")
        assert ours.columns == plain.columns
        assert rows(ours) == rows(plain)


@contextmanager
def small_skew_limits(spark):
    """No broadcasts, and partitions count as skewed from 256 kB."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {c: spark.conf.get(c, None) for c in limits}
    try:
        for c, v in limits.items():
            spark.conf.set(c, v)
        yield
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


@pytest.fixture
def hot_rows(spark, tmp_path):
    """A third of the rows has one key."""
    key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 5000)
    spark.range(300_000).select(key.alias("k"), F.uuid().alias("v")).write.parquet(str(tmp_path / "rows"))
    spark.range(5000).select(F.col("id").alias("k"), F.uuid().alias("v")).write.parquet(str(tmp_path / "keys"))
    return spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "keys"))


def test_hot_partitions_of_a_dimension_join_are_split(spark, hot_rows):
    many, keys = hot_rows
    with small_skew_limits(spark):
        joined = lookup(many, keys.withColumnRenamed("v", "name"), "k", "name")
        assert len(joined.collect()) == 300_000
        assert "skew=true" in plan(joined)


def test_hot_target_keys_of_a_large_merge_are_split(spark, hot_rows):
    target, changes = hot_rows
    with small_skew_limits(spark):
        merged = upsert(target, changes, ["k"])
        assert len({r.v for r in merged.collect()}) == 5000
        outer = next(line for line in plan(merged).splitlines() if "LeftOuter" in line)
        assert "skew=true" in outer


def test_lookup_takes_only_named_columns(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    dim = spark.createDataFrame([(1, "one", "x")], "id int, name string, other string")
    assert rows(lookup(left, dim, "id", "name", renamed={"name": "label"})) == [(1, "a", "one"), (2, "b", None)]


def test_keep_present_and_fill(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, b int, c string")
    assert keep_present(df, ["c", "z", "a"]).columns == ["c", "a"]
    assert tuple(fill_defaults(df, {"b": 0, "c": "none"}).first()) == (1, 0, "none")
