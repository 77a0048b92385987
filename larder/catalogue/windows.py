"""Rankings, running and moving windows, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalogue import base
from larder.catalogue.base import SQL_ITEMS, SQL_KITCHEN, SQL_VISITS, load, query, sql_sum, with_roles
from larder.functions.exact import exact_sum
from larder.functions.menu import array_length
from larder.functions.times import day_short_name
from larder.operators.ranking import moving, page, running, top_per_group


def cents(value: str):
    return F.rint(F.col(value) * 100).cast("bigint")


@query(
    "win_rank",
    """SELECT o_orderkey, o_custkey, o_orderdate,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number FROM orders""",
)
def win_rank(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return running(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"order_number": F.lit(1)})


@query(
    "win_cumulative",
    """SELECT event_id, user_id, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS spent_cents
 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def win_cumulative(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", cents("value").alias("cents"))
    rows = running(events, ["user_id"], ["ts", "event_id"], {"spent_cents": F.col("cents")})
    return rows.drop("cents")


@query(
    "win_moving",
    """SELECT event_id, user_id, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS DOUBLE) / count(*) OVER w / 100
   AS mean_of_three, max(value) OVER w AS max_of_three
 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING)""",
)
def win_moving(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    frame = {"cents": F.sum(cents("value")), "n": F.count("value"), "max_of_three": F.max("value")}
    rows = moving(events, ["user_id"], ["ts", "event_id"], 2, frame)
    mean = F.col("cents").cast("double") / F.col("n") / 100
    return rows.select("event_id", "user_id", "ts", mean.alias("mean_of_three"), "max_of_three")


@query(
    "win_priority_top1",
    with_roles(
        f"""
SELECT customer_id, item_id, CAST(quantity AS BIGINT) AS quantity, line_total, CAST(toppings AS BIGINT) AS toppings
FROM (SELECT customer_id, item_id, sum(quantity) AS quantity, {sql_sum("line_total")} AS line_total,
             sum(n_toppings) AS toppings FROM items GROUP BY customer_id, item_id)
QUALIFY row_number() OVER (PARTITION BY customer_id
                           ORDER BY quantity DESC, line_total DESC, toppings DESC, item_id) = 1
""",
        items=SQL_ITEMS,
    ),
)
def win_priority_top1(spark, sf):
    totals = base.items(spark, sf).groupBy("customer_id", "item_id").agg(
        F.sum("quantity").alias("quantity"),
        exact_sum("line_total").alias("line_total"),
        F.sum(array_length("toppings").cast("bigint")).alias("toppings"),
    )
    order = [F.desc("quantity"), F.desc("line_total"), F.desc("toppings"), "item_id"]
    return top_per_group(totals, ["customer_id"], order)


def most_frequent(rows, value: str):
    counts = rows.groupBy("customer_id", value).agg(F.count("order_id").alias("n"))
    return top_per_group(counts, ["customer_id"], [F.desc("n"), value])


def sql_most_frequent(role: str, value: str, name: str) -> str:
    return f"""
SELECT customer_id, v AS {name}, n FROM (SELECT customer_id, {value} AS v, count(order_id) AS n FROM {role} GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, v) = 1
"""


@query(
    "win_top1_outlet",
    with_roles(
        sql_most_frequent("runs", "outlet_id", "outlet_id"),
        runs=f"SELECT k.*, o_custkey AS customer_id FROM ({SQL_KITCHEN}) k JOIN orders ON order_id = o_orderkey",
    ),
)
def win_top1_outlet(spark, sf):
    buyers = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    return most_frequent(base.kitchen(spark, sf).join(buyers, "order_id"), "outlet_id")


@query("win_top1_payment", with_roles(sql_most_frequent("visits", "payment_mode", "payment_mode"), visits=SQL_VISITS))
def win_top1_payment(spark, sf):
    return most_frequent(base.visits(spark, sf), "payment_mode")


@query("win_top1_day", with_roles(sql_most_frequent("visits", "strftime(order_ts, '%a')", "day"), visits=SQL_VISITS))
def win_top1_day(spark, sf):
    return most_frequent(base.visits(spark, sf).withColumn("day", day_short_name(F.col("order_ts"))), "day")


@query(
    "win_top1_hour", with_roles(sql_most_frequent("visits", "CAST(hour(order_ts) AS INTEGER)", "hour"), visits=SQL_VISITS)
)
def win_top1_hour(spark, sf):
    return most_frequent(base.visits(spark, sf).withColumn("hour", F.hour("order_ts")), "hour")


@query("win_top1_type", with_roles(sql_most_frequent("visits", "order_type", "order_type"), visits=SQL_VISITS))
def win_top1_type(spark, sf):
    return most_frequent(base.visits(spark, sf), "order_type")


@query("page", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 150")
def third_page(spark, sf):
    return page(load(spark, sf, "orders"), [F.desc("o_orderdate"), "o_orderkey"], number=3, size=50)
