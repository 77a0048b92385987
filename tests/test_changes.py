"""Products by change equal products from scratch."""

from __future__ import annotations

import glob
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larder.plans import jobs
from larder.plans.changes import ROW_WISE, affected_keys, refreshed, row_wise
from larder.plans.registry import derive
from tests.shop import build, frames

NOW = "2026-01-01"


def stock(rng):
    return [
        {"outlet_id": f"OUT{rng.randrange(1, 5)}", "stock_item": item, "available_quantity": float(rng.randrange(200)),
         "unit_of_measure": rng.choice([None, "kg"]), "stock_date": day}
        for item in ("salt", "oil", "rice") for day in (datetime(2025, 11, 10), datetime(2025, 11, 11), None)
    ]


def before_and_after(spark):
    rng = random.Random(3)
    old = build(orders=80)
    old["fact_stock"] = list({(r["outlet_id"], r["stock_item"], r["stock_date"]): r for r in stock(rng)}.values())
    new = {n: [dict(r) for r in rows] for n, rows in old.items()}
    touched = {n: [] for n in new}

    def change(name, i, **values):
        new[name][i].update(values)
        touched[name].append(new[name][i])

    change("fact_sales", 3, order_ts=datetime(2026, 3, 1))
    change("fact_sales", 4, order_menu_details=None)
    change("fact_kitchen", 5, chef_id="CH1", cooking_end=datetime(2026, 3, 1))
    change("dim_chef", 2, chef_name="Renamed")
    change("dim_outlet", 0, outlet_name="Moved")
    change("dim_stock_item", 1, unit_of_measure="piece")
    change("fact_stock", 0, available_quantity=None)
    for name in ("fact_sales", "fact_kitchen", "fact_stock"):  # a removed row and a new one
        gone = new[name].pop()
        touched[name].append(gone)
        fresh = dict(new[name][1], **({"order_id": "FRESH"} if "order_id" in gone else {"stock_item": "oil", "outlet_id": "OUT2", "stock_date": datetime(2027, 1, 1)}))
        new[name].append(fresh)
        touched[name].append(fresh)
    return frames(spark, old), frames(spark, new), frames(spark, touched)


@pytest.mark.parametrize("name", list(ROW_WISE))
@pytest.mark.parametrize("held", [True, False])
def test_refreshed_equals_full(spark, rows, name, held):
    old, new, changes = before_and_after(spark)
    product = derive(name, old, loaded_at=F.lit(NOW).cast("timestamp"))
    full = derive(name, new, loaded_at=F.lit(NOW).cast("timestamp"))
    assert rows(full) != rows(product)
    if held:
        assert rows(refreshed(name, product, new, changes, loaded_at=F.lit(NOW).cast("timestamp"))) == rows(full)
    keys = affected_keys(name, new, changes, product if held else None)
    assert 0 < keys.count() == keys.distinct().count() <= new[row_wise(name).fact].count() + 2


def test_a_dimension_loaded_anew_without_change_reaches_nothing(spark):
    old, _, _ = before_and_after(spark)
    product = derive("fact_kitchen_enriched", old)
    changes = {n: old[n] for n in ("dim_chef", "dim_outlet")}
    assert affected_keys("fact_kitchen_enriched", old, changes, product).count() == 0


def test_other_products_are_refused():
    with pytest.raises(ValueError, match="not a row-wise product"):
        row_wise("customer")


def stored(target, name):
    return sorted(tuple(str(v) for v in r) for r in target.read(name).drop("ingested_at").collect())


def test_delta_job_rewrites_touched_days_and_equals_full(spark, tmp_path):
    target = jobs.Lake(spark, str(tmp_path / "lake"))
    data = build(orders=60)
    for i, run in enumerate(data["fact_kitchen"]):
        run["cooking_start"] = datetime(2025, 11, 10) + timedelta(hours=i)
        run["cooking_end"] = run["cooking_start"] + timedelta(minutes=30)
    later = frames(spark, {**data, "fact_kitchen": [dict(data["fact_kitchen"][2], chef_id="CH0"), dict(data["fact_kitchen"][0], order_id="FRESH")]})
    built = frames(spark, data)
    stamped = lambda df: df.withColumn("ingested_at", F.current_timestamp())
    for name in ("fact_kitchen", "dim_chef", "dim_outlet"):
        jobs.store(target, name, stamped(built[name]), "full")
    jobs.enrich(target, "fact_kitchen_enriched", "delta")  # nothing to change yet: derived in full
    assert target.read("fact_kitchen_enriched").count() == target.read("fact_kitchen").count()
    folder = target.days("fact_kitchen_enriched").path
    before = set(glob.glob(f"{folder}/*/*.parquet"))
    raw = set(glob.glob(f"{target.days('fact_kitchen').path}/*/*.parquet"))

    jobs.store(target, "fact_kitchen", stamped(later["fact_kitchen"]), "delta")
    days = jobs.enrich(target, "fact_kitchen_enriched", "delta")
    assert [str(d) for d in days] == ["2025-11-10"]
    after = set(glob.glob(f"{folder}/*/*.parquet"))
    assert {f for f in before if "11-10" not in f} == {f for f in after if "11-10" not in f} != set()
    assert {f for f in raw if "11-10" not in f} == {f for f in set(glob.glob(f"{target.days('fact_kitchen').path}/*/*.parquet")) if "11-10" not in f}
    by_change = stored(target, "fact_kitchen_enriched")
    jobs.enrich(target, "fact_kitchen_enriched")
    assert stored(target, "fact_kitchen_enriched") == by_change

    renamed = frames(spark, {**data, "dim_chef": [dict(r, chef_name="New " + r["chef_id"]) if r["chef_id"] == "CH2" else r for r in data["dim_chef"]]})
    jobs.store(target, "dim_chef", stamped(renamed["dim_chef"]), "full")
    jobs.enrich(target, "fact_kitchen_enriched", "delta")
    by_change = stored(target, "fact_kitchen_enriched")
    assert any("New CH2" in r for r in by_change)
    jobs.enrich(target, "fact_kitchen_enriched")
    assert stored(target, "fact_kitchen_enriched") == by_change


def test_a_table_stored_as_a_whole_before_is_taken_over(spark, tmp_path):
    from larder.sources import lake

    target = jobs.Lake(spark, str(tmp_path / "lake"))
    built = frames(spark, build(orders=10))
    lake.commit(spark, target.table("fact_sales"), built["fact_sales"])
    assert target.has("fact_sales") and not target.has_days("fact_sales") and target.read("fact_sales").count() == 10
    one = built["fact_sales"].limit(1).withColumn("total_order_price", F.lit(-1.0))
    jobs.store(target, "fact_sales", one, "delta")
    assert target.has_days("fact_sales") and target.read("fact_sales").count() == 10
    assert target.read("fact_sales").filter("total_order_price = -1").count() == 1


def test_null_safe_join_leaves_placed_rows_in_place(spark):
    """Rows already placed by their key meet the keys without a second shuffle, and null keys still match null-safe."""
    from larder.plans.changes import null_safe_join

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        data = [(1, "a"), (2, "b"), (None, "c"), (3, "d"), (None, "e")]
        rows = spark.createDataFrame(data, "order_id long, menu string").repartition("order_id")
        keys = spark.createDataFrame([(2,), (None,), (5,)], "order_id long")
        semi = null_safe_join(rows, keys, ["order_id"], "left_semi")
        anti = null_safe_join(rows, keys, ["order_id"], "left_anti")
        assert sorted(r.menu for r in semi.collect()) == ["b", "c", "e"]
        assert sorted(r.menu for r in anti.collect()) == ["a", "d"]
        plan = semi._jdf.queryExecution().executedPlan().toString()
        # the rows' own repartition, reused for the null branch, and the keys; no exchange of the rows on their key again
        assert plan.count("Exchange hashpartitioning(order_id") == 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_ingest_json_writes_compressed_json(spark, tmp_path, monkeypatch):
    """The JSON files that ingest_json reads back are gzip-compressed, not plain text."""
    from larder.catalogue import edges

    monkeypatch.setattr(edges, "scratch", lambda session: str(tmp_path))
    assert edges.ingest_json(spark, "/root/testdata/sf0.001").count() > 0
    assert glob.glob(f"{tmp_path}/fact_sales.json/*.json.gz")
