"""The eight data products over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalogue import base
from larder.catalogue.base import (
    SQL_ITEMS,
    SQL_KITCHEN,
    SQL_KITCHEN_ONCE,
    SQL_SALES,
    SQL_STOCK,
    SQL_VISITS,
    load,
    query,
    sql_mean,
    sql_sum,
    with_roles,
)
from larder.functions.menu import lines_to_json
from larder.plans.facts import kitchen_enriched, sales_enriched, sales_items, stock_enriched
from larder.plans.outlets import MODE_COUNTS, PERCENTAGES, TYPE_COUNTS, outlet_performance
from larder.plans.people import chef_performance, customer_preference, customer_profile

YEAR_SECONDS = 365 * 86400
AS_OF = "2001-09-15"
BANDS = {"Low": 150000, "Medium": 300000}
HIGH_VALUE = 400000
DIGITAL = ("1-URGENT", "2-HIGH", "3-MEDIUM")


def menu_orders(spark, sf):
    """Order lines as small orders: each row carries a JSON menu of one or two lines."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    first = F.floor(F.col("l_quantity") / 2).cast("int")
    price = F.col("l_extendedprice") / F.col("l_quantity")

    def line(quantity, toppings):
        return F.struct(
            F.col("l_partkey").cast("string").alias("item_id"),
            F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("item_name"),
            quantity.alias("quantity"),
            toppings.alias("toppings"),
            price.alias("unit_price"),
            (price * quantity).alias("line_total"),
        )

    plain = F.array().cast("array<string>")
    second = line(F.col("l_quantity").cast("int") - first, plain)
    lines = F.when(first > 0, F.array(line(first, base.toppings()), second)).otherwise(F.array(second))
    return (
        load(spark, sf, "lineitem")
        .repartition("l_orderkey")  # before the JSON is built and parsed: a scan may have fewer parts than tasks
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_shipdate").alias("order_ts"),
            F.col("l_suppkey").alias("outlet_id"),
            F.col("o_custkey").alias("customer_id"),
            lines_to_json(lines).alias("order_menu_details"),
        )
    )


SQL_MENU_LINES = """
SELECT l_orderkey AS order_id, l_shipdate AS order_ts, l_suppkey AS outlet_id, o_custkey AS customer_id,
       CAST(l_partkey AS VARCHAR) AS item_id, 'part ' || CAST(l_partkey AS VARCHAR) AS item_name,
       CAST(part.quantity AS INTEGER) AS quantity, l_extendedprice / l_quantity AS unit_price,
       l_extendedprice / l_quantity * part.quantity AS line_total,
       CASE WHEN part.first THEN
         CASE WHEN l_returnflag <> 'N' AND l_linestatus <> 'O' THEN l_returnflag || ',' || l_linestatus
              WHEN l_returnflag <> 'N' THEN l_returnflag WHEN l_linestatus <> 'O' THEN l_linestatus ELSE '' END
       ELSE '' END AS toppings
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey,
LATERAL (SELECT floor(l_quantity / 2) AS quantity, true AS first
         UNION ALL SELECT l_quantity - floor(l_quantity / 2), false) part
WHERE part.quantity > 0
"""


@query("fact_sales_items", SQL_MENU_LINES)
def fact_sales_items(spark, sf):
    rows = sales_items({"fact_sales": menu_orders(spark, sf)})
    return rows.drop("ingested_at").withColumn("toppings", F.array_join("toppings", ","))


def flagship(spark, sf):
    tables = {
        "fact_sales": base.sales(spark, sf),
        "fact_sales_items": base.bare_items(spark, sf),
        "dim_customer": base.customers(spark, sf),
        "dim_outlet": base.outlets(spark, sf),
        "fact_kitchen": base.kitchen(spark, sf),
    }
    return sales_enriched(
        tables, cook_sla_seconds=YEAR_SECONDS, digital_modes=DIGITAL, high_value=HIGH_VALUE, value_bands=BANDS
    ).drop("ingested_at")


query(
    "fact_sales_enriched",
    with_roles(
        f"""
SELECT s.order_id, order_ts, CAST(order_ts AS DATE) AS order_date, CAST(hour(order_ts) AS INTEGER) AS order_hour,
       CAST(weekofyear(order_ts) AS INTEGER) AS order_week, CAST(month(order_ts) AS INTEGER) AS order_month,
       CAST(year(order_ts) AS INTEGER) AS order_year, dayname(order_ts) AS day_of_week,
       dayofweek(order_ts) IN (0, 6) AS is_weekend, hour(order_ts) IN (12, 13, 19, 20) AS is_peak_hour,
       s.customer_id, c_name AS customer_mobile, total_orders_by_customer > 1 AS is_repeat_customer,
       total_orders_by_customer, customer_lifetime_value,
       CAST(date_diff('day', CAST(last_order_ts AS DATE), CAST(order_ts AS DATE)) AS INTEGER) AS days_since_last_order,
       s.outlet_id, n_name AS outlet_name, total_order_price, coalesce(total_items, 0) AS total_items,
       coalesce(distinct_items_count, 0) AS distinct_items_count,
       CASE WHEN total_items > 0 THEN total_order_price / total_items ELSE 0.0 END AS avg_item_price,
       max_item_price, min_item_price, coalesce(total_toppings_count, 0) AS total_toppings_count,
       items_with_customizations, is_customized_order, payment_mode,
       payment_mode IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS is_digital_payment, order_type,
       CASE WHEN total_order_price < 150000 THEN 'Low' WHEN total_order_price < 300000 THEN 'Medium'
            ELSE 'High' END AS order_value_band,
       coalesce(total_items, 0) > 1 AS is_multi_item_order, total_order_price > 400000 AS is_high_value_order,
       cook_duration_seconds, was_delayed_order
FROM sales s
LEFT JOIN (SELECT order_id, CAST(sum(quantity) AS BIGINT) AS total_items, count(DISTINCT item_id) AS distinct_items_count,
                  CAST(sum(n_toppings) AS BIGINT) AS total_toppings_count, max(unit_price) AS max_item_price,
                  min(unit_price) AS min_item_price, count(*) FILTER (n_toppings > 0) AS items_with_customizations,
                  count(*) FILTER (n_toppings > 0) > 0 AS is_customized_order
           FROM items GROUP BY order_id) i ON s.order_id = i.order_id
LEFT JOIN (SELECT order_id, max(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS cook_duration_seconds,
                  bool_or(epoch(cooking_end) - epoch(cooking_start) > {YEAR_SECONDS}) AS was_delayed_order
           FROM kitchen GROUP BY order_id) k ON s.order_id = k.order_id
LEFT JOIN (SELECT customer_id, count(order_id) AS total_orders_by_customer,
                  {sql_sum("total_order_price")} AS customer_lifetime_value, max(order_ts) AS last_order_ts
           FROM sales GROUP BY customer_id) m ON s.customer_id = m.customer_id
LEFT JOIN customer ON s.customer_id = c_custkey
LEFT JOIN nation ON s.outlet_id = n_nationkey
""",
        sales=SQL_SALES,
        items=SQL_ITEMS,
        kitchen=SQL_KITCHEN,
    ),
)(flagship)


@query(
    "fact_kitchen_enriched",
    with_roles(
        f"""
SELECT order_id, outlet_id, n_name AS outlet_name, chef_id, s_name AS chef_name, cooking_start, cooking_end,
       epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT AS cook_duration_seconds,
       epoch(cooking_end) - epoch(cooking_start) > {YEAR_SECONDS} AS was_delayed_order,
       CAST(cooking_start AS DATE) AS date, CAST(hour(cooking_start) AS INTEGER) AS hour,
       CAST(weekofyear(cooking_start) AS INTEGER) AS week, CAST(month(cooking_start) AS INTEGER) AS month,
       CAST(year(cooking_start) AS INTEGER) AS year, CAST(dayofweek(cooking_start) + 1 AS INTEGER) AS day_of_week_num
FROM kitchen LEFT JOIN supplier ON chef_id = s_suppkey LEFT JOIN nation ON outlet_id = n_nationkey
""",
        kitchen=SQL_KITCHEN,
    ),
)
def fact_kitchen_enriched(spark, sf):
    tables = {
        "fact_kitchen": base.kitchen(spark, sf),
        "dim_chef": base.chefs(spark, sf),
        "dim_outlet": base.outlets(spark, sf),
    }
    return kitchen_enriched(tables, sla_seconds=YEAR_SECONDS).drop("ingested_at")


@query(
    "fact_stock_enriched",
    with_roles(
        """
SELECT outlet_id, n_name AS outlet_name, stock_item, coalesce(unit_of_measure, p_type) AS unit_of_measure,
       available_quantity,
       CASE WHEN available_quantity <= 10 THEN 'low' WHEN available_quantity >= 100 THEN 'high' ELSE 'medium' END
         AS inventory_status,
       available_quantity <= 10 AS needs_restock, CAST(stock_date AS DATE) AS stock_date, stock_date AS stock_date_raw,
       CAST(weekofyear(stock_date) AS INTEGER) AS stock_week, CAST(month(stock_date) AS INTEGER) AS stock_month,
       CAST(year(stock_date) AS INTEGER) AS stock_year, CAST(dayofweek(stock_date) + 1 AS INTEGER) AS day_of_week_num
FROM stock LEFT JOIN part ON stock_item = p_partkey LEFT JOIN nation ON outlet_id = n_nationkey
""",
        stock=SQL_STOCK,
    ),
)
def fact_stock_enriched(spark, sf):
    tables = {
        "fact_stock": base.stock(spark, sf),
        "dim_stock_item": base.stock_items(spark, sf),
        "dim_outlet": base.outlets(spark, sf),
    }
    return stock_enriched(tables).drop("ingested_at")


@query(
    "customer_profile",
    with_roles(
        f"""
SELECT c_custkey AS customer_id, count(s.order_id) AS total_orders,
       {sql_mean("total_order_price")} AS average_order_value, max(total_order_price) AS max_order_value,
       min(total_order_price) AS min_order_value, {sql_sum("total_order_price")} AS total_spent,
       min(order_ts) AS first_order_date, max(order_ts) AS last_order_date,
       CAST(date_diff('day', CAST(min(order_ts) AS DATE), CAST(max(order_ts) AS DATE)) AS INTEGER) AS days_as_customer,
       CAST(date_diff('day', CAST(max(order_ts) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order,
       CAST(sum(items_in_order) AS BIGINT) AS total_items_ordered, count(s.order_id) > 1 AS is_repeat_customer,
       date_diff('day', CAST(max(order_ts) AS DATE), DATE '{AS_OF}') <= 90 AS is_active_customer,
       sum(total_order_price) >= 5000 AS is_high_value_customer,
       CASE WHEN sum(total_order_price) >= 10000 THEN 'Gold' WHEN sum(total_order_price) >= 3000 THEN 'Silver'
            WHEN sum(total_order_price) >= 500 THEN 'Bronze' ELSE 'New' END AS customer_segment,
       CASE WHEN count(s.order_id) >= 50 THEN 'High' WHEN count(s.order_id) >= 10 THEN 'Medium'
            WHEN count(s.order_id) >= 1 THEN 'Low' ELSE 'None' END AS customer_frequency_band,
       CAST((2 * 100 * sum(items_in_order) + count(s.order_id)) // (2 * count(s.order_id)) AS DOUBLE) / 100
         AS items_per_order
FROM sales s LEFT JOIN customer ON s.customer_id = c_custkey
LEFT JOIN (SELECT customer_id, order_id, sum(quantity) AS items_in_order FROM items GROUP BY customer_id, order_id) i
  ON s.order_id = i.order_id
GROUP BY c_custkey
""",
        sales=SQL_SALES,
        items=SQL_ITEMS,
    ),
)
def profile(spark, sf):
    tables = {
        "fact_sales": base.sales(spark, sf),
        "fact_sales_items": base.items(spark, sf),
        "dim_customer": base.customers(spark, sf),
    }
    return customer_profile(tables, as_of=F.lit(AS_OF).cast("date")).drop("ingested_at")


def _top(value: str, alias: str, count: str | None = None) -> str:
    shown = f", n AS {count}" if count else ""
    return f"""(SELECT customer_id, v AS {alias}{shown} FROM
 (SELECT customer_id, {value} AS v, count(order_id) AS n FROM visits GROUP BY ALL)
 QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, v) = 1)"""


@query(
    "customer_preference",
    with_roles(
        f"""
SELECT c_custkey AS customer_id, c_name AS customer_mobile, item_id, p_name AS favorite_item_name,
       outlet_id, n_name AS favorite_outlet_name, orders_at_outlet, preferred_payment_mode, orders_by_payment_method,
       favorite_order_day, CAST(favorite_order_hour AS INTEGER) AS favorite_order_hour, weekend_order_ratio,
       preferred_order_type
FROM customer
LEFT JOIN (SELECT customer_id, item_id FROM
    (SELECT customer_id, item_id, sum(quantity) AS q, {sql_sum("line_total")} AS lt, sum(n_toppings) AS tc
     FROM items GROUP BY customer_id, item_id)
   QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY q DESC, lt DESC, tc DESC, item_id) = 1) fi
  ON c_custkey = fi.customer_id
LEFT JOIN part ON item_id = p_partkey
LEFT JOIN {_top("outlet_id", "outlet_id", "orders_at_outlet")} fo ON c_custkey = fo.customer_id
LEFT JOIN nation ON outlet_id = n_nationkey
LEFT JOIN {_top("payment_mode", "preferred_payment_mode", "orders_by_payment_method")} fp ON c_custkey = fp.customer_id
LEFT JOIN {_top("strftime(order_ts, '%a')", "favorite_order_day")} fd ON c_custkey = fd.customer_id
LEFT JOIN {_top("hour(order_ts)", "favorite_order_hour")} fh ON c_custkey = fh.customer_id
LEFT JOIN {_top("order_type", "preferred_order_type")} ft ON c_custkey = ft.customer_id
LEFT JOIN (SELECT customer_id,
             CAST((200 * count(*) FILTER (dayofweek(order_ts) IN (0, 6)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
               AS weekend_order_ratio
           FROM visits GROUP BY customer_id) w ON c_custkey = w.customer_id
""",
        visits=SQL_VISITS,
        items=SQL_ITEMS,
    ),
)
def preference(spark, sf):
    tables = {
        "fact_sales": base.visits(spark, sf),
        "fact_sales_items": base.items(spark, sf),
        "dim_customer": base.customers(spark, sf),
        "dim_item": base.menu(spark, sf),
        "dim_outlet": base.outlets(spark, sf),
    }
    return customer_preference(tables).drop("ingested_at")


@query(
    "chef_performance",
    with_roles(
        f"""
SELECT k.chef_id, s_name AS chef_name, s_nationkey AS outlet_id, n_name AS outlet_name,
       total_orders_cooked, avg_orders_per_day, avg_cooking_time_sec, min_cooking_time_sec, max_cooking_time_sec,
       peak_hour_orders, total_sales_value_cooked_by_chef
FROM (SELECT chef_id, count(order_id) AS total_orders_cooked,
             count(order_id) / count(DISTINCT CAST(cooking_start AS DATE)) AS avg_orders_per_day,
             CAST(sum(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS DOUBLE) / count(*)
               AS avg_cooking_time_sec,
             min(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS min_cooking_time_sec,
             max(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS max_cooking_time_sec,
             count(*) FILTER (hour(cooking_start) IN (12, 13, 19, 20, 21)) AS peak_hour_orders
      FROM kitchen GROUP BY chef_id) k
LEFT JOIN (SELECT chef_id, {sql_sum("total_order_price")} AS total_sales_value_cooked_by_chef
           FROM sales JOIN kitchen USING (order_id) GROUP BY chef_id) t ON k.chef_id = t.chef_id
LEFT JOIN supplier ON k.chef_id = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
""",
        sales=SQL_SALES,
        kitchen=SQL_KITCHEN_ONCE,
    ),
)
def chef(spark, sf):
    tables = {
        "fact_kitchen": base.kitchen_once(spark, sf),
        "dim_chef": base.chefs(spark, sf),
        "dim_outlet": base.outlets(spark, sf),
        "fact_sales": base.sales(spark, sf),
    }
    return chef_performance(tables).drop("ingested_at")


# Event types stand for order types and payment modes.
OUTLET_TYPES = dict(zip(TYPE_COUNTS, ("view", "click", "purchase")))
OUTLET_MODES = dict(zip(MODE_COUNTS, ("view", "click", "purchase", "signup")))


def sql_outlet_counts() -> str:
    counts = [
        "count(*) FILTER (high_value_flag) AS high_value_orders",
        "count(*) FILTER (total_order_price_anomaly_flag) AS anomalous_orders",
    ]
    counts += [f"count(*) FILTER (order_type = '{v}') AS {n}" for n, v in OUTLET_TYPES.items()]
    counts += [f"count(*) FILTER (payment_mode = '{v}') AS {n}" for n, v in OUTLET_MODES.items()]
    return ", ".join(counts)


def sql_slots() -> str:
    slots = {"morning": (8, 12), "afternoon": (12, 16), "evening": (16, 20), "night": (20, 24)}
    within = {s: f"hour(order_ts) >= {a} AND hour(order_ts) < {b}" for s, (a, b) in slots.items()}
    sums = [sql_sum(f"CASE WHEN {c} THEN total_order_price ELSE 0 END") + f" AS {s}_sales" for s, c in within.items()]
    return ", ".join(sums + [f"count(*) FILTER ({c}) AS {s}_orders" for s, c in within.items()])


SQL_PERCENTAGES = ", ".join(f"round(m.{n} / m.total_orders * 100, 2) AS {pct}" for pct, n in PERCENTAGES.items())
SQL_PEAK = "hour(order_ts) IN (12, 13, 19, 20, 21)"


@query(
    "outlet_performance",
    with_roles(
        f"""
SELECT n_nationkey AS outlet_id, n_name AS outlet_name, m.* EXCLUDE (outlet_id), {SQL_PERCENTAGES},
       d.* EXCLUDE (outlet_id), p.* EXCLUDE (outlet_id)
FROM nation
LEFT JOIN (SELECT outlet_id, {sql_sum("total_order_price")} AS total_sales, count(order_id) AS total_orders,
                  {sql_mean("total_order_price")} AS avg_order_value, {sql_outlet_counts()},
                  round(CAST(sum(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS DOUBLE) / (60 * count(*)), 2)
                    AS avg_cooking_duration_mins, {sql_slots()}
           FROM served GROUP BY outlet_id) m ON n_nationkey = m.outlet_id
LEFT JOIN (SELECT outlet_id, {sql_mean("sales")} AS avg_daily_sales, round(avg(n), 2) AS avg_daily_order_count
           FROM (SELECT outlet_id, {sql_sum("total_order_price")} AS sales, count(*) AS n
                 FROM served GROUP BY outlet_id, CAST(order_ts AS DATE)) GROUP BY outlet_id) d ON n_nationkey = d.outlet_id
LEFT JOIN (SELECT outlet_id, {sql_sum("total_order_price")} AS peak_hour_sales, count(*) AS peak_hour_order_count
           FROM served WHERE {SQL_PEAK} GROUP BY outlet_id) p ON n_nationkey = p.outlet_id
""",
        visits=SQL_VISITS,
        kitchen=SQL_KITCHEN_ONCE,
        served="SELECT v.* EXCLUDE (outlet_id), k.outlet_id, cooking_start, cooking_end FROM visits v JOIN kitchen k USING (order_id)",
    ),
)
def outlet(spark, sf):
    tables = {
        "fact_sales": base.visits(spark, sf),
        "dim_outlet": base.outlets(spark, sf),
        "fact_kitchen": base.kitchen_once(spark, sf),
    }
    rows = outlet_performance(tables, type_counts=OUTLET_TYPES, mode_counts=OUTLET_MODES)
    return rows.drop("ingested_at")
