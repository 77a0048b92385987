"""Scans, writes, change windows, merges and table versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from larder.catalogue.base import SCHEMAS, load, query
from larder.catalogue.products import SQL_MENU_LINES, menu_orders
from larder.functions.menu import LINE_SCHEMA, parse_lines
from larder.operators.upsert import upsert
from larder.plans.facts import sales_items
from larder.plans.jobs import seed_frame
from larder.sources import lake
from larder.sources.files import scan
from larder.sources.shared import scratch
from larder.streaming.incremental import change_window, high_water_mark

ORDERS = "SELECT * FROM orders"


@query("scan_parquet", "SELECT p_partkey, p_name, p_retailprice FROM part")
def scan_parquet(spark, sf):
    return scan(spark, "parquet", f"{sf}/part.parquet").select("p_partkey", "p_name", "p_retailprice")


@query("scan_csv", ORDERS)
def scan_csv(spark, sf):
    folder = f"{scratch(spark)}/orders.csv"
    load(spark, sf, "orders").write.option("header", True).csv(folder)
    return scan(spark, "csv", folder, SCHEMAS["orders"])


@query("scan_csv_dated", "SELECT event_id, ts, value FROM events")
def scan_csv_dated(spark, sf):
    """Two drops, each in the folder of its day, read together by a full load."""
    root, events = scratch(spark), load(spark, sf, "events").select("event_id", "ts", "value")
    for day, part in (
        ("2024-01-15", change_window(events, "ts", end=datetime(2024, 1, 15))),
        ("2024-02-01", change_window(events, "ts", start=datetime(2024, 1, 15))),
    ):
        # As text, since the CSV writer would cut times to milliseconds.
        text = part.withColumn("ts", F.col("ts").cast("string"))
        text.write.option("header", True).csv(lake.landing_path(root, "events", "delta", day))
    return lake.read_landing(spark, root, "events", "full", schema="event_id bigint, ts timestamp_ntz, value double")


@query("scan_json", ORDERS)
def scan_json(spark, sf):
    folder = f"{scratch(spark)}/orders.json"
    load(spark, sf, "orders").write.json(folder)
    return scan(spark, "json", folder, SCHEMAS["orders"], multiLine=False)


@query(
    "scan_geojson",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS longitude, CAST(c_acctbal AS DOUBLE) AS latitude FROM customer",
)
def scan_geojson(spark, sf):
    """A point feature for each customer, one a line, written and read back."""
    folder = f"{scratch(spark)}/customers.geojson"
    place = F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal").cast("double"))
    load(spark, sf, "customer").select(
        F.lit("Feature").alias("type"),
        F.struct("c_custkey", "c_name").alias("properties"),
        F.struct(F.lit("Point").alias("type"), place.alias("coordinates")).alias("geometry"),
    ).write.json(folder)
    schema = "type string, properties struct<c_custkey: bigint, c_name: string>, geometry struct<type: string, coordinates: array<double>>"
    features = scan(spark, "geojson", folder, schema, multiLine=False)
    return features.select(
        "properties.c_custkey",
        "properties.c_name",
        F.col("geometry.coordinates")[0].alias("longitude"),
        F.col("geometry.coordinates")[1].alias("latitude"),
    )


@query("ingest_json", SQL_MENU_LINES)
def ingest_json(spark, sf):
    """Nested sales from JSON files, menu back to text as the source database stores it, then exploded."""
    folder = f"{scratch(spark)}/fact_sales.json"
    nested = menu_orders(spark, sf).withColumns(
        {
            "order_menu_details": parse_lines("order_menu_details").cast(LINE_SCHEMA),
            **{c: F.col(c).cast("string") for c in ("order_id", "outlet_id", "customer_id", "order_ts")},
        }
    )
    nested.write.json(folder, compression="gzip")  # text of lines repeats: compressed, it writes a sixth or less
    seeded = seed_frame(spark, "fact_sales", folder, multiLine=False)
    typed = sales_items({"fact_sales": seeded}).withColumns(
        {
            "order_ts": F.col("order_ts").cast("timestamp_ntz"),
            **{c: F.col(c).cast("bigint") for c in ("order_id", "outlet_id", "customer_id")},
            "toppings": F.array_join("toppings", ","),
        }
    )
    return typed.drop("ingested_at")


# --- change windows ------------------------------------------------------------------------------

START, END = datetime(2024, 1, 10), datetime(2024, 1, 20, 12)


@query(
    "delta_window",
    "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'",
)
def delta_window(spark, sf):
    return change_window(load(spark, sf, "events"), "ts", START, END)


@query("delta_window_open", "SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'")
def delta_window_open(spark, sf):
    return change_window(load(spark, sf, "events"), "ts", end=END)


@query("delta_window_full", "SELECT * FROM events")
def delta_window_full(spark, sf):
    return change_window(load(spark, sf, "events"), None, START, END)


@query("high_water_mark", "SELECT max(ts) AS high_water_mark FROM events")
def newest_event(spark, sf):
    return high_water_mark(load(spark, sf, "events"), "ts")


# --- merges --------------------------------------------------------------------------------------

SPLIT, OVERLAP = datetime(1999, 1, 1), datetime(1998, 1, 1)
SQL_TARGET = "(SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01')"
SQL_CHANGES = """
(SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
 FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01')
"""


def target_and_changes(spark, sf):
    """Orders up to a day, and repriced orders since an earlier day."""
    orders = load(spark, sf, "orders")
    changes = change_window(orders, "o_orderdate", start=OVERLAP).withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    return change_window(orders, "o_orderdate", end=SPLIT), changes


@query(
    "upsert_all",
    f"SELECT * FROM {SQL_CHANGES} UNION ALL SELECT * FROM {SQL_TARGET} t"
    f" WHERE NOT EXISTS (SELECT 1 FROM {SQL_CHANGES} c WHERE c.o_orderkey = t.o_orderkey)",
)
def upsert_all(spark, sf):
    return upsert(*target_and_changes(spark, sf), ["o_orderkey"])


@query(
    "upsert_subset",
    f"""
SELECT o_orderkey, t.o_custkey, t.o_orderstatus, coalesce(c.o_totalprice, t.o_totalprice) AS o_totalprice,
       t.o_orderdate, t.o_orderpriority
FROM {SQL_TARGET} t LEFT JOIN {SQL_CHANGES} c USING (o_orderkey)
UNION ALL
SELECT * FROM {SQL_CHANGES} c WHERE NOT EXISTS (SELECT 1 FROM {SQL_TARGET} t WHERE t.o_orderkey = c.o_orderkey)
""",
)
def upsert_subset(spark, sf):
    return upsert(*target_and_changes(spark, sf), ["o_orderkey"], update=["o_totalprice"])


# --- table versions ------------------------------------------------------------------------------


def versioned_orders(spark, sf) -> lake.LakeTable:
    """Three versions: orders to a day, the later ones appended, then the merge of repriced orders."""
    table = lake.LakeTable(scratch(spark), "raw", "orders")
    orders = load(spark, sf, "orders")
    lake.commit(spark, table, change_window(orders, "o_orderdate", end=SPLIT))
    lake.commit(spark, table, change_window(orders, "o_orderdate", start=SPLIT), mode="append")
    changes = lake.stage(spark, table, target_and_changes(spark, sf)[1])
    lake.commit(spark, table, upsert(lake.read(spark, table), changes, ["o_orderkey"]))
    return table


@query("staged_write", ORDERS)
def staged_write(spark, sf):
    """Orders to a day as a full load, the later ones as the next day's batch."""
    table = lake.LakeTable(scratch(spark), "raw", "orders")
    orders = load(spark, sf, "orders")
    lake.write(spark, table, change_window(orders, "o_orderdate", end=SPLIT), day="1999-01-01")
    lake.write(spark, table, change_window(orders, "o_orderdate", start=SPLIT), "delta", day="1999-01-02")
    return lake.read(spark, table)


@query(
    "snapshot_counts",
    """SELECT 0 AS version, count(*) AS record_count FROM orders WHERE o_orderdate <= TIMESTAMP '1999-01-01'
 UNION ALL SELECT 1, count(*) FROM orders UNION ALL SELECT 2, count(*) FROM orders""",
)
def snapshot_counts(spark, sf):
    return lake.history(spark, versioned_orders(spark, sf)).select("version", "record_count")


@query("restore_snapshot", ORDERS)
def restore_snapshot(spark, sf):
    table = versioned_orders(spark, sf)
    lake.restore(spark, table, 1)
    return lake.read(spark, table)


@query("compact", ORDERS)
def compacted(spark, sf):
    table = lake.LakeTable(scratch(spark), "raw", "orders")
    lake.commit(spark, table, load(spark, sf, "orders").repartition(32, "o_orderkey"))
    lake.compact(spark, table)
    return lake.read(spark, table)
