"""Merges by day, products by change, deep pages and wide frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalogue import base
from larder.catalogue.base import ORACLES, SCHEMAS, load, query
from larder.catalogue.edges import OVERLAP, SPLIT, SQL_CHANGES, SQL_TARGET, target_and_changes
from larder.catalogue.products import SQL_MENU_LINES, YEAR_SECONDS, menu_orders
from larder.operators.ranking import moving, page
from larder.plans.changes import refreshed
from larder.plans.registry import derive
from larder.sources import daily, lake
from larder.sources.shared import scratch
from larder.streaming.incremental import change_window
from larder.streaming.landing import follow, newest

# Every fifth change moves its order by 40 days, every seventh takes its date away.
MOVED_DATE = """CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 40 DAY
 ELSE o_orderdate END"""
SQL_MOVED = f"(SELECT * REPLACE ({MOVED_DATE} AS o_orderdate) FROM {SQL_CHANGES})"


@query(
    "upsert_by_day",
    f"SELECT * FROM {SQL_MOVED} UNION ALL SELECT * FROM {SQL_TARGET} t"
    f" WHERE NOT EXISTS (SELECT 1 FROM {SQL_CHANGES} c WHERE c.o_orderkey = t.o_orderkey)",
)
def upsert_by_day(spark, sf):
    """Repriced and moved orders merged into a table kept by months, of which only the touched ones are written."""
    target, changes = target_and_changes(spark, sf)
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    moved = F.when(key % 7 == 0, None).when(key % 5 == 0, date + F.expr("INTERVAL 40 DAYS")).otherwise(date)
    folder = scratch(spark)
    table = daily.DayTable(f"{folder}/orders", "o_orderdate", unit="month")
    daily.write(spark, table, target)
    changes.withColumn("o_orderdate", moved).write.parquet(f"{folder}/changes")
    daily.merge(spark, table, spark.read.parquet(f"{folder}/changes"), ["o_orderkey"])
    return daily.read(spark, table)


def by_change(spark, name, before, after, changed, **options):
    """The product before the change, written, and then brought up to date."""
    folder = f"{scratch(spark)}/{name}"
    derive(name, before, **options).write.parquet(folder)
    product = spark.read.parquet(folder)
    return refreshed(name, product, after, changed, **options).drop("ingested_at")


@query("fact_sales_items_by_change", SQL_MENU_LINES)
def sales_items_by_change(spark, sf):
    """Order lines of the later shipments added, the earlier ones of the same orders derived again."""
    menus = menu_orders(spark, sf)
    early, late = change_window(menus, "order_ts", end=SPLIT), change_window(menus, "order_ts", start=SPLIT)
    rows = by_change(spark, "fact_sales_items", {"fact_sales": early}, {"fact_sales": menus}, {"fact_sales": late})
    return rows.withColumn("toppings", F.array_join("toppings", ","))


@query("fact_kitchen_enriched_by_change", ORACLES["fact_kitchen_enriched"])
def kitchen_by_change(spark, sf):
    """Later kitchen runs added, and outlets of other names before; the dimension is loaded anew as a whole."""
    runs, outlets = base.kitchen(spark, sf), base.outlets(spark, sf)
    late = change_window(runs, "cooking_end", start=SPLIT)
    renamed = F.when(F.col("outlet_id") % 3 == 0, F.concat(F.lit("old "), "outlet_name")).otherwise(F.col("outlet_name"))
    now = {"fact_kitchen": runs, "dim_chef": base.chefs(spark, sf), "dim_outlet": outlets}
    then = {**now, "fact_kitchen": change_window(runs, "cooking_end", end=SPLIT), "dim_outlet": outlets.withColumn("outlet_name", renamed)}
    return by_change(spark, "fact_kitchen_enriched", then, now, {"fact_kitchen": late, "dim_outlet": outlets}, sla_seconds=YEAR_SECONDS)


@query("fact_stock_enriched_by_change", ORACLES["fact_stock_enriched"])
def stock_by_change(spark, sf):
    """Stock levels that were other quantities, levels that were not there, and stock items of other units before."""
    stock, items = base.stock(spark, sf), base.stock_items(spark, sf)
    touched = F.col("stock_item") % 10 == 3
    other = F.when(touched, F.col("available_quantity") + 1000).otherwise(F.col("available_quantity"))
    units = F.when(F.col("stock_item") % 10 == 5, F.lit("was other")).otherwise(F.col("unit_of_measure"))
    now = {"fact_stock": stock, "dim_stock_item": items, "dim_outlet": base.outlets(spark, sf)}
    then = {
        **now,
        "fact_stock": stock.withColumn("available_quantity", other).filter(F.col("stock_item") % 10 != 7),
        "dim_stock_item": items.withColumn("unit_of_measure", units),
    }
    changed = {
        "fact_stock": stock.filter((F.col("stock_item") % 10).isin(3, 7)),
        "dim_stock_item": items.filter(F.col("stock_item") % 10 == 5),
    }
    return by_change(spark, "fact_stock_enriched", then, now, changed)


@query(
    "page_deep",
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem"
    " ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 100 OFFSET 5000",
)
def deep_page(spark, sf):
    order = [F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    rows = page(load(spark, sf, "lineitem"), order, number=50, size=100, shallow=1000)
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")


@query(
    "win_moving_wide",
    """SELECT event_id, user_id, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents,
 count(*) OVER w AS n, min(value) OVER w AS lowest
 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 500 PRECEDING)""",
)
def moving_wide(spark, sf):
    """Frames of 500 rows in a few groups, each of a fifth of the rows."""
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    frame = {"cents": F.sum(F.rint(F.col("value") * 100).cast("bigint")), "n": F.count(F.lit(1)), "lowest": F.min("value")}
    rows = moving(events, ["event_type"], ["ts", "event_id"], 500, frame)
    return rows.drop("event_type", "value")


@query(
    "stream_landed_drops",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
 CASE WHEN o_orderdate > TIMESTAMP '1998-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
 o_orderdate, o_orderpriority FROM orders""",
)
def stream_landed(spark, sf):
    """Orders dropped on three days, a stale copy of some after their newer rows; one run before the last drop, one after."""
    root, orders = scratch(spark), load(spark, sf, "orders").withColumn("version", F.lit(1))
    newer = change_window(orders, "o_orderdate", start=OVERLAP).withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1, "version": F.lit(2)}
    )
    table = daily.DayTable(f"{root}/orders", "o_orderdate", unit="year")
    schema = SCHEMAS["orders"] + ", version int"

    def take(rows):
        held = daily.read(spark, table) if daily.exists(spark, table) else rows.limit(0)
        changes = newest(held, rows, ["o_orderkey"], [F.desc("version")])
        if not daily.exists(spark, table):
            return daily.write(spark, table, changes)
        changes.write.mode("overwrite").parquet(f"{root}/batch")
        daily.merge(spark, table, spark.read.parquet(f"{root}/batch"), ["o_orderkey"])

    def drop(day, rows):
        path = lake.landing_path(root, "orders", "delta", day)
        rows.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)

    drop("1999-01-01", change_window(orders, "o_orderdate", end=SPLIT))
    drop("1999-01-02", newer)
    run = lambda: follow(spark, lake.landing_path(root, "orders", "full"), schema, take, f"{root}/progress")
    run()
    drop("1999-01-03", change_window(orders, "o_orderdate", start=OVERLAP))
    run()
    return daily.read(spark, table).drop("version")
