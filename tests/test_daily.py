"""Tables by day: merges rewrite touched days only."""

from __future__ import annotations

import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from larder.operators.upsert import upsert
from larder.sources import daily

SCHEMA = "k int, ts timestamp, v string"
DAYS = [datetime(2025, 11, d, 8) for d in (1, 2, 3)]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    found = daily.DayTable(str(tmp_path / "t"), "ts")
    daily.write(spark, found, frame(spark, (1, DAYS[0], "a"), (2, DAYS[0], "b"), (3, DAYS[1], "c"), (4, DAYS[2], "d"), (5, None, "e")))
    return found


def files(table):
    return {(folder, name) for folder, _, names in os.walk(table.path) for name in names if name.endswith(".parquet")}


def of_day(found, day):
    return {f for f in found if f[0].endswith(day)}


def content(spark, table):
    return sorted(map(tuple, daily.read(spark, table).collect()))


def test_untouched_days_keep_their_files(spark, table):
    before = files(table)
    days = daily.merge(spark, table, frame(spark, (3, DAYS[1], "C"), (9, DAYS[1], "new")), ["k"])
    assert days == [date(2025, 11, 2)]
    after = files(table)
    for day in ("2025-11-01", "2025-11-03", "__HIVE_DEFAULT_PARTITION__"):
        assert of_day(before, day) == of_day(after, day) != set()
    assert not of_day(before, "2025-11-02") & of_day(after, "2025-11-02")
    assert [r for r in content(spark, table) if r[0] in (3, 9)] == [(3, DAYS[1], "C"), (9, DAYS[1], "new")]


def test_moved_and_undated_rows(spark, table):
    """The last row of a day leaves it, an undated row gets a day, a dated one loses it."""
    days = daily.merge(spark, table, frame(spark, (4, DAYS[0], "moved"), (5, DAYS[1], "dated"), (3, None, "undated")), ["k"])
    assert days == [date(2025, 11, 1), date(2025, 11, 2), date(2025, 11, 3), None]
    assert sorted(map(tuple, daily.read(spark, table).select("k", "v").collect())) == [(1, "a"), (2, "b"), (3, "undated"), (4, "moved"), (5, "dated")]
    assert daily.read(spark, table).filter(F.to_date("ts") == "2025-11-03").count() == 0


def test_scan_is_pruned_to_the_touched_days(spark, table):
    held = daily._files(spark, table).filter(daily._in_days([date(2025, 11, 2)]))
    text = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "_day" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert held.select("_metadata.file_path").distinct().count() == 1


def test_merge_equals_upsert(spark, table):
    whole = daily.read(spark, table)
    rows = [(1, DAYS[2], None), (2, None, "B"), (7, DAYS[1], "x"), (None, DAYS[0], "no key"), (8, None, "y"), (10, datetime(2026, 1, 1), "far")]
    for columns, update in ((["k", "ts", "v"], None), (["k", "v"], None), (["k", "ts", "v"], ["v"])):
        copy = daily.DayTable(table.path + "-" + "".join(columns) + str(bool(update)), "ts")
        shutil.copytree(table.path, copy.path)
        changes = frame(spark, *rows).select(*columns)
        expected = sorted(map(tuple, upsert(whole, changes, ["k"], update).collect()), key=str)
        daily.merge(spark, copy, changes, ["k"], update)
        assert sorted(map(tuple, daily.read(spark, copy).collect()), key=str) == expected


def test_a_run_that_died_between_days_is_repaired_by_the_next(spark, table, tmp_path):
    """Spark had put the new day in place, but not yet the day that the row left."""
    changes = frame(spark, (1, DAYS[1], "moved"))
    old = tmp_path / "old"
    shutil.copytree(table.path, old)
    daily.merge(spark, table, changes, ["k"])
    done = content(spark, table)
    shutil.rmtree(os.path.join(table.path, "_day=2025-11-01"))
    shutil.copytree(old / "_day=2025-11-01", os.path.join(table.path, "_day=2025-11-01"))
    assert len(content(spark, table)) == len(done) + 1
    daily.merge(spark, table, changes, ["k"])
    assert content(spark, table) == done


def test_replace_matches_null_keys_and_several_rows(spark, tmp_path):
    table = daily.DayTable(str(tmp_path / "r"), "ts")
    daily.write(spark, table, frame(spark, (1, DAYS[0], "a"), (1, DAYS[1], "b"), (None, DAYS[0], "c"), (2, DAYS[2], "d")))
    gone = spark.createDataFrame([(1,), (None,)], "k int")
    daily.replace(spark, table, gone, frame(spark, (1, DAYS[0], "A"), (1, DAYS[0], "A")))
    assert content(spark, table) == [(1, DAYS[0], "A"), (1, DAYS[0], "A"), (2, DAYS[2], "d")]
    assert daily.replace(spark, table, gone.limit(0), frame(spark)) == []


def test_whole_writes_empty_tables_and_reserved_names(spark, table):
    daily.write(spark, table, frame(spark, (6, DAYS[1], "only")))
    assert content(spark, table) == [(6, DAYS[1], "only")]
    daily.write(spark, table, frame(spark))
    assert content(spark, table) == [] and daily.read(spark, table).schema.simpleString() == frame(spark).schema.simpleString()
    daily.merge(spark, table, frame(spark, (1, None, "x")), ["k"])
    assert content(spark, table) == [(1, None, "x")]
    with pytest.raises(ValueError, match="reserved"):
        daily.write(spark, table, frame(spark).withColumn("_day", F.lit(1)))


def test_two_changes_for_one_row_fail(spark, table):
    before = files(table)
    with pytest.raises(ValueError, match="several changes"):
        daily.merge(spark, table, frame(spark, (1, DAYS[0], "x"), (1, DAYS[0], "y")), ["k"])
    assert files(table) == before
    daily.merge(spark, table, frame(spark, (50, DAYS[0], "x"), (50, DAYS[0], "y")), ["k"])
    assert daily.read(spark, table).filter("k = 50").count() == 2


def test_compaction_rewrites_days_with_several_files(spark, table):
    extra = frame(spark, (20, DAYS[0], "z")).withColumns({"_marker": F.lit(None).cast("boolean"), "_day": F.to_date("ts")})
    extra.write.mode("append").partitionBy("_day").parquet(table.path)
    before = files(table)
    assert daily.compact(spark, table) == [date(2025, 11, 1)]
    after = files(table)
    assert len(of_day(after, "2025-11-01")) == 1 and of_day(before, "2025-11-03") == of_day(after, "2025-11-03")
    assert daily.read(spark, table).count() == 6


def test_last_time_reads_one_day(spark, table):
    assert daily.last_time(spark, table) == DAYS[2]
    daily.merge(spark, table, frame(spark, (4, DAYS[0], "moved")), ["k"])  # the last day has no rows now
    assert daily.last_time(spark, table) == DAYS[1]
    daily.write(spark, table, frame(spark, (1, None, "undated")))
    assert daily.last_time(spark, table) is None
