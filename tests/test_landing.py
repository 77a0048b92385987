"""Dropped files as a stream: every file once, whatever happens to a run."""

from __future__ import annotations

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larder import __main__ as cli
from larder.plans import jobs
from larder.sources import lake
from larder.streaming import landing

HEADER = "order_id,outlet_id,customer_id,order_ts,order_menu_details,total_order_price,payment_mode,order_type,high_value_flag\n"


def order(key, day, price, mode="Cash"):
    return f"{key},OUT1,C1,2025-11-{day:02d}T08:00:00,,{price},{mode},Dine-In,false\n"


def drop(root, day, *orders):
    folder = root / "DataSource" / f"2025-11-{day:02d}"
    folder.mkdir(parents=True)
    (folder / "fact_sales.csv").write_text(HEADER + "".join(orders))


DROPS = {
    10: [order("A", 10, 1), order("B", 10, 2), order("BAD", 10, 9, "Shells")],
    11: [order("B", 11, 3), order("C", 11, 4), order("C", 10, 40)],
    12: [order("A", 9, 100), order("D", 12, 5), order("C", 11, 4)],  # an older row of A comes late
}


def prices(target):
    return {r.order_id: r.total_order_price for r in target.read("fact_sales").collect()}


def test_runs_take_each_file_once_and_equal_a_batch(spark, tmp_path):
    target, root = jobs.Lake(spark, str(tmp_path / "lake")), tmp_path / "drop"
    for day in (10, 11):
        drop(root, day, *DROPS[day])
        landing.follow_landing(target, str(root), "fact_sales")
    assert prices(target) == {"A": 1, "B": 3, "C": 4}
    drop(root, 12, *DROPS[12])
    landing.follow_landing(target, str(root), "fact_sales", files_at_once=1)
    expected = {"A": 1, "B": 3, "C": 4, "D": 5}
    assert prices(target) == expected

    files = sorted(glob.glob(f"{target.days('fact_sales').path}/*/*.parquet"))
    landing.follow_landing(target, str(root), "fact_sales")  # nothing new
    assert sorted(glob.glob(f"{target.days('fact_sales').path}/*/*.parquet")) == files

    batch = jobs.Lake(spark, str(tmp_path / "batch"))
    fetch = lambda name, *_: lake.read_landing(spark, str(root), name, "full")
    jobs.load_raw(batch, "fact_sales", fetch, "full")
    assert prices(batch) == expected
    columns = [c for c in batch.read("fact_sales").columns if c != "ingested_at"]
    sort = lambda t: sorted(map(str, t.read("fact_sales").select(*columns).collect()))
    assert sort(target) == sort(batch)


@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_run_that_dies_is_taken_up_again(spark, tmp_path, monkeypatch, moment):
    """Before a merge nothing is stored; after it the micro-batch is merged again."""
    target, root = jobs.Lake(spark, str(tmp_path / "lake")), tmp_path / "drop"
    for day, rows in DROPS.items():
        drop(root, day, *rows)
    real, calls = jobs.store, []

    def dying(*args):
        calls.append(args[1])
        if moment == "after" or len(calls) != 2:
            real(*args)
        if len(calls) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "store", dying)
    with pytest.raises(Exception, match="lost"):
        landing.follow_landing(target, str(root), "fact_sales", files_at_once=1)
    landing.follow_landing(target, str(root), "fact_sales", files_at_once=1)
    assert len(calls) == 4  # three files, one of them twice
    assert prices(target) == {"A": 1, "B": 3, "C": 4, "D": 5}
    assert target.read("fact_sales").count() == 4


def test_an_unexpected_header_fails_the_run(spark, tmp_path):
    target, root = jobs.Lake(spark, str(tmp_path / "lake")), tmp_path / "drop"
    folder = root / "DataSource" / "2025-11-10"
    folder.mkdir(parents=True)
    (folder / "dim_outlet.csv").write_text("outlet_name,outlet_id\nNorth,OUT1\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.follow_landing(target, str(root), "dim_outlet")
    assert not target.has("dim_outlet")


def test_command_line_follows_a_dimension(spark, tmp_path):
    args = ["follow", "--table", "dim_outlet", "--root", str(tmp_path / "lake"), "--landing", str(tmp_path / "drop")]
    for day, name in ((10, "North"), (11, "South")):
        folder = tmp_path / "drop" / "DataSource" / f"2025-11-{day}"
        folder.mkdir(parents=True)
        (folder / "dim_outlet.csv").write_text(f"outlet_id,outlet_name\n OUT{day}, {name}\n")
        cli.main(args)
    stored = jobs.Lake(spark, str(tmp_path / "lake")).read("dim_outlet")
    assert {(r.outlet_id, r.outlet_name) for r in stored.collect()} == {("OUT10", "North"), ("OUT11", "South")}


def test_newest_prefers_the_stored_row_of_equals(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, t timestamp, v string")
    one, two = datetime(2025, 1, 1), datetime(2025, 1, 2)
    held = rows((1, two, "held"), (2, one, "held"), (3, one, "same"))
    changes = rows((1, one, "older"), (2, two, "newer"), (3, one, "same"), (4, one, "new"), (4, two, "new again"))
    got = {tuple(r) for r in landing.newest(held, changes, ["k"], [F.desc("t"), "v"]).collect()}
    assert got == {(2, two, "newer"), (4, two, "new again")}
