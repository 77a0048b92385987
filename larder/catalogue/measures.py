"""Projections, joins, aggregates, scalar functions and business rules."""

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
from larder.catalogue.products import (
    OUTLET_MODES,
    OUTLET_TYPES,
    SQL_MENU_LINES,
    SQL_PEAK,
    YEAR_SECONDS,
    menu_orders,
    sql_outlet_counts,
    sql_slots,
)
from larder.functions import rules
from larder.functions.exact import exact_sum, rounded_mean
from larder.functions.menu import LINE_SCHEMA, array_length, lines_to_json, parse_lines
from larder.functions.times import calendar_parts, days_between, minutes_between, seconds_between
from larder.operators.joins import fill_defaults, join_back, lookup
from larder.operators.rollups import (
    chef_workload,
    cooking_per_order,
    items_per_order,
    named,
    orders_per_customer,
    quantity_per_order,
    slot_measures,
    slot_prices,
)
from larder.plans.outlets import PERCENTAGES, order_counts, percentages

# --- projections ---------------------------------------------------------------------------------


@query(
    "project_struct",
    """SELECT l_orderkey AS order_id, l_partkey AS item_id, CAST(l_quantity AS INTEGER) AS quantity,
 l_extendedprice AS line_total FROM lineitem""",
)
def project_struct(spark, sf):
    line = F.struct(
        F.col("l_partkey").alias("item"), F.col("l_quantity").cast("int").alias("n"), F.col("l_extendedprice").alias("amount")
    )
    nested = load(spark, sf, "lineitem").select("l_orderkey", line.alias("line"))
    return nested.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("line.item").alias("item_id"),
        F.col("line.n").alias("quantity"),
        F.col("line.amount").alias("line_total"),
    )


@query(
    "fill_defaults",
    """SELECT o_orderkey, coalesce(n, 0) AS n, coalesce(flag, 'none') AS flag FROM orders
 LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_returnflag) AS flag FROM lineitem GROUP BY l_orderkey)
 ON o_orderkey = l_orderkey""",
)
def filled(spark, sf):
    lines = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("l_returnflag").alias("flag")
    )
    orders = load(spark, sf, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    return fill_defaults(orders, {"n": 0, "flag": "none"})


# --- aggregates ----------------------------------------------------------------------------------

SQL_ORDER_ITEMS = f"""
SELECT order_id, CAST(sum(quantity) AS BIGINT) AS total_items, count(DISTINCT item_id) AS distinct_items_count,
       CAST(sum(n_toppings) AS BIGINT) AS total_toppings_count,
       {sql_sum("line_total")} / CAST(sum(quantity) AS DOUBLE) AS avg_item_price_per_unit,
       max(unit_price) AS max_item_price, min(unit_price) AS min_item_price,
       count(*) FILTER (n_toppings > 0) AS items_with_customizations,
       count(*) FILTER (n_toppings > 0) > 0 AS is_customized_order
FROM items GROUP BY order_id
"""
SQL_BUYERS = f"""
SELECT customer_id, count(order_id) AS total_orders_by_customer,
       {sql_sum("total_order_price")} AS customer_lifetime_value, max(order_ts) AS last_order_ts
FROM sales GROUP BY customer_id
"""


@query("agg_items", with_roles(SQL_ORDER_ITEMS, items=SQL_ITEMS))
def agg_items(spark, sf):
    return items_per_order(base.bare_items(spark, sf))


@query("agg_customer", with_roles(SQL_BUYERS, sales=SQL_SALES))
def agg_customer(spark, sf):
    return orders_per_customer(base.sales(spark, sf))


@query(
    "agg_any",
    with_roles(
        f"""
SELECT order_id, max(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS cook_duration_seconds,
       bool_or(epoch(cooking_end) - epoch(cooking_start) > {YEAR_SECONDS}) AS was_delayed_order
FROM kitchen GROUP BY order_id
""",
        kitchen=SQL_KITCHEN,
    ),
)
def agg_any(spark, sf):
    return cooking_per_order(base.kitchen(spark, sf), YEAR_SECONDS)


@query(
    "agg_two_keys",
    with_roles(
        " SELECT customer_id, order_id, CAST(sum(quantity) AS BIGINT) AS items_in_order FROM items GROUP BY ALL",
        items=SQL_ITEMS,
    ),
)
def agg_two_keys(spark, sf):
    return quantity_per_order(base.items(spark, sf))


@query(
    "agg_profile",
    with_roles(
        f"""
SELECT customer_id, count(order_id) AS orders, {sql_mean("total_order_price")} AS mean_price,
       max(total_order_price) AS highest, min(total_order_price) AS lowest, {sql_sum("total_order_price")} AS spent,
       CAST(date_diff('day', CAST(min(order_ts) AS DATE), CAST(max(order_ts) AS DATE)) AS INTEGER) AS days_as_customer,
       CAST(date_diff('day', CAST(max(order_ts) AS DATE), DATE '2024-02-15') AS INTEGER) AS days_since
FROM visits GROUP BY customer_id
""",
        visits=SQL_VISITS,
    ),
)
def agg_profile(spark, sf):
    price, ts = F.col("total_order_price"), F.col("order_ts")
    today = F.lit("2024-02-15").cast("date")
    return base.visits(spark, sf).groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        rounded_mean("total_order_price").alias("mean_price"),
        F.max(price).alias("highest"),
        F.min(price).alias("lowest"),
        exact_sum("total_order_price").alias("spent"),
        days_between(F.min(ts), F.max(ts)).alias("days_as_customer"),
        days_between(F.max(ts), today).alias("days_since"),
    )


@query(
    "agg_ratio",
    with_roles(
        """
SELECT customer_id, CAST((200 * count(*) FILTER (dayofweek(order_ts) IN (0, 6)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
  AS weekend_order_ratio FROM visits GROUP BY customer_id
""",
        visits=SQL_VISITS,
    ),
)
def agg_ratio(spark, sf):
    weekend = F.sum(F.when(rules.is_weekend("order_ts"), 1).otherwise(0))
    share = F.coalesce(F.try_divide(weekend, F.count("order_id")), F.lit(0.0))
    return base.visits(spark, sf).groupBy("customer_id").agg(F.round(share, 2).alias("weekend_order_ratio"))


@query(
    "agg_distinct",
    with_roles(
        " SELECT chef_id, count(DISTINCT CAST(cooking_start AS DATE)) AS total_days FROM kitchen GROUP BY chef_id",
        kitchen=SQL_KITCHEN,
    ),
)
def agg_distinct(spark, sf):
    return base.kitchen(spark, sf).groupBy("chef_id").agg(F.count_distinct(F.to_date("cooking_start")).alias("total_days"))


SQL_CHEFS = """
SELECT chef_id, count(order_id) AS total_orders_cooked,
       count(order_id) / count(DISTINCT CAST(cooking_start AS DATE)) AS avg_orders_per_day,
       CAST(sum(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS DOUBLE) / count(*) AS avg_cooking_time_sec,
       min(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS min_cooking_time_sec,
       max(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT) AS max_cooking_time_sec
FROM kitchen GROUP BY chef_id
"""


@query(
    "agg_per_day",
    with_roles(f" SELECT chef_id, total_orders_cooked, avg_orders_per_day FROM ({SQL_CHEFS})", kitchen=SQL_KITCHEN),
)
def agg_per_day(spark, sf):
    return chef_workload(base.kitchen(spark, sf)).select("chef_id", "total_orders_cooked", "avg_orders_per_day")


@query(
    "agg_stats",
    with_roles(
        f" SELECT chef_id, avg_cooking_time_sec, min_cooking_time_sec, max_cooking_time_sec FROM ({SQL_CHEFS})",
        kitchen=SQL_KITCHEN,
    ),
)
def agg_stats(spark, sf):
    return chef_workload(base.kitchen(spark, sf)).select(
        "chef_id", "avg_cooking_time_sec", "min_cooking_time_sec", "max_cooking_time_sec"
    )


@query(
    "agg_count_if",
    with_roles(
        f" SELECT customer_id, count(*) FILTER ({SQL_PEAK}) AS peak_hour_orders FROM visits GROUP BY customer_id",
        visits=SQL_VISITS,
    ),
)
def agg_count_if(spark, sf):
    peak = rules.is_peak(F.hour("order_ts"), rules.SERVICE_PEAK_HOURS)
    return base.visits(spark, sf).groupBy("customer_id").agg(F.count_if(peak).alias("peak_hour_orders"))


def outlet_counts():
    return named(order_counts(OUTLET_TYPES, OUTLET_MODES))


@query(
    "agg_kpi",
    with_roles(
        f"""
SELECT outlet_id, {sql_sum("total_order_price")} AS total_sales, count(order_id) AS total_orders,
       {sql_mean("total_order_price")} AS avg_order_value, {sql_outlet_counts()} FROM visits GROUP BY outlet_id
""",
        visits=SQL_VISITS,
    ),
)
def agg_kpi(spark, sf):
    return base.visits(spark, sf).groupBy("outlet_id").agg(
        exact_sum("total_order_price").alias("total_sales"),
        F.count("order_id").alias("total_orders"),
        rounded_mean("total_order_price").alias("avg_order_value"),
        *outlet_counts(),
    )


@query(
    "pct_of_total",
    with_roles(
        " SELECT outlet_id, "
        + ", ".join(f"round({n} / total_orders * 100, 2) AS {pct}" for pct, n in PERCENTAGES.items())
        + f" FROM (SELECT outlet_id, count(order_id) AS total_orders, {sql_outlet_counts()} FROM visits GROUP BY outlet_id)",
        visits=SQL_VISITS,
    ),
)
def pct_of_total(spark, sf):
    counts = base.visits(spark, sf).groupBy("outlet_id").agg(F.count("order_id").alias("total_orders"), *outlet_counts())
    return counts.withColumns(percentages()).select("outlet_id", *PERCENTAGES)


@query(
    "agg_two_level",
    with_roles(
        f"""
SELECT outlet_id, {sql_mean("sales")} AS avg_daily_sales, round(avg(n), 2) AS avg_daily_order_count
FROM (SELECT outlet_id, {sql_sum("total_order_price")} AS sales, count(order_id) AS n
      FROM visits GROUP BY outlet_id, CAST(order_ts AS DATE)) GROUP BY outlet_id
""",
        visits=SQL_VISITS,
    ),
)
def agg_two_level(spark, sf):
    daily = base.visits(spark, sf).groupBy("outlet_id", F.to_date("order_ts").alias("day")).agg(
        exact_sum("total_order_price").alias("sales"), F.count("order_id").alias("n")
    )
    return daily.groupBy("outlet_id").agg(
        rounded_mean("sales").alias("avg_daily_sales"), F.round(F.avg("n"), 2).alias("avg_daily_order_count")
    )


@query(
    "agg_filtered",
    with_roles(
        f"""
SELECT outlet_id, {sql_sum("total_order_price")} AS peak_hour_sales, count(order_id) AS peak_hour_order_count
FROM visits WHERE {SQL_PEAK} GROUP BY outlet_id
""",
        visits=SQL_VISITS,
    ),
)
def agg_filtered(spark, sf):
    peak = rules.is_peak(F.hour("order_ts"), rules.SERVICE_PEAK_HOURS)
    return base.visits(spark, sf).filter(peak).groupBy("outlet_id").agg(
        exact_sum("total_order_price").alias("peak_hour_sales"), F.count("order_id").alias("peak_hour_order_count")
    )


@query("agg_slots", with_roles(f" SELECT outlet_id, {sql_slots()} FROM visits GROUP BY outlet_id", visits=SQL_VISITS))
def agg_slots(spark, sf):
    hour = F.hour("order_ts")
    visits = base.visits(spark, sf).withColumns(slot_prices(hour, F.col("total_order_price")))
    return visits.groupBy("outlet_id").agg(*named(slot_measures(hour)))


# --- joins ---------------------------------------------------------------------------------------


@query(
    "join_left_agg",
    with_roles(
        f" SELECT s.order_id, total_order_price, i.* EXCLUDE (order_id) FROM sales s LEFT JOIN ({SQL_ORDER_ITEMS}) i"
        " ON s.order_id = i.order_id",
        sales=SQL_SALES,
        items=SQL_ITEMS,
    ),
)
def join_left_agg(spark, sf):
    sales = base.sales(spark, sf).select("order_id", "total_order_price")
    return sales.join(items_per_order(base.bare_items(spark, sf)), "order_id", "left")


@query(
    "join_left_dim",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_name AS customer_mobile FROM orders"
    " LEFT JOIN customer ON o_custkey = c_custkey",
)
def join_left_dim(spark, sf):
    orders = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    return lookup(orders, base.customers(spark, sf), "customer_id", "customer_mobile")


@query(
    "join_back_agg",
    with_roles(
        f" SELECT s.order_id, s.customer_id, total_orders_by_customer, customer_lifetime_value, last_order_ts"
        f" FROM sales s LEFT JOIN ({SQL_BUYERS}) m ON s.customer_id = m.customer_id",
        sales=SQL_VISITS,
    ),
)
def join_back_agg(spark, sf):
    visits = base.visits(spark, sf)
    rows = visits.select("order_id", "customer_id")
    return join_back(rows, orders_per_customer(visits), "customer_id")


@query(
    "join_expr_fallback",
    with_roles(
        """
SELECT outlet_id, stock_item, coalesce(unit_of_measure, p_type) AS unit_of_measure, available_quantity
FROM stock LEFT JOIN part ON stock_item = p_partkey
""",
        stock=SQL_STOCK,
    ),
)
def join_expr_fallback(spark, sf):
    units = base.stock_items(spark, sf).select(F.col("stock_item").alias("known_item"), F.col("unit_of_measure").alias("unit"))
    joined = base.stock(spark, sf).join(units, F.col("stock_item") == F.col("known_item"), "left")
    unit = F.coalesce("unit_of_measure", "unit").alias("unit_of_measure")
    return joined.select("outlet_id", "stock_item", unit, "available_quantity")


@query(
    "join_keep_right_key",
    "SELECT event_id AS order_id, c_custkey AS customer_id, value FROM events"
    " LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON user_id = c_custkey",
)
def join_keep_right_key(spark, sf):
    """Buyers outside the dimension lose their key."""
    known = load(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("customer_id")
    )
    events = load(spark, sf, "events").select(F.col("event_id").alias("order_id"), "user_id", "value")
    return events.join(known, F.col("user_id") == F.col("customer_id"), "left").drop("user_id")


@query(
    "join_star",
    with_roles(
        f"""
SELECT c_custkey AS customer_id, c_name AS customer_mobile, m.* EXCLUDE (customer_id), v.* EXCLUDE (customer_id),
       q.* EXCLUDE (customer_id)
FROM customer LEFT JOIN ({SQL_BUYERS}) m ON c_custkey = m.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS visits, max(order_ts) AS last_visit FROM visits GROUP BY customer_id) v
  ON c_custkey = v.customer_id
LEFT JOIN (SELECT customer_id, CAST(sum(quantity) AS BIGINT) AS items FROM items GROUP BY customer_id) q
  ON c_custkey = q.customer_id
""",
        sales=SQL_SALES,
        visits=SQL_VISITS,
        items=SQL_ITEMS,
    ),
)
def join_star(spark, sf):
    seen = base.visits(spark, sf).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("visits"), F.max("order_ts").alias("last_visit")
    )
    bought = base.items(spark, sf).groupBy("customer_id").agg(F.sum("quantity").alias("items"))
    star = base.customers(spark, sf)
    for arm in (orders_per_customer(base.sales(spark, sf)), seen, bought):
        star = star.join(arm, "customer_id", "left")
    return star


@query(
    "join_inner",
    with_roles(
        """
SELECT order_id, total_order_price, k.outlet_id, chef_id FROM sales s JOIN kitchen k USING (order_id)
""",
        sales=SQL_SALES,
        kitchen=SQL_KITCHEN_ONCE,
    ),
)
def join_inner(spark, sf):
    sales = base.sales(spark, sf).select("order_id", "total_order_price")
    cooked = base.kitchen_once(spark, sf).select("order_id", "outlet_id", "chef_id")
    return sales.join(cooked, "order_id", "inner")


@query(
    "join_snowflake",
    with_roles(
        f" SELECT k.chef_id, total_orders_cooked, s_name AS chef_name, s_nationkey AS outlet_id, n_name AS outlet_name"
        f" FROM ({SQL_CHEFS}) k LEFT JOIN supplier ON k.chef_id = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey",
        kitchen=SQL_KITCHEN,
    ),
)
def join_snowflake(spark, sf):
    measures = chef_workload(base.kitchen(spark, sf)).select("chef_id", "total_orders_cooked")
    wide = lookup(measures, base.chefs(spark, sf), "chef_id", "chef_name", "outlet_id")
    return lookup(wide, base.outlets(spark, sf), "outlet_id", "outlet_name")


# --- scalar functions ----------------------------------------------------------------------------


@query(
    "fn_time_parts",
    """SELECT event_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
 CAST(weekofyear(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
 CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday, dayname(ts) AS weekday_name, strftime(ts, '%a') AS weekday_short
 FROM events""",
)
def fn_time_parts(spark, sf):
    names = "date hour week month year weekday weekday_name weekday_short".split()
    return load(spark, sf, "events").select("event_id", *named(calendar_parts("ts", **{n: n for n in names})))


@query(
    "fn_durations",
    with_roles(
        """
SELECT order_id, chef_id, cooking_start, cooking_end, epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT AS seconds,
       CAST(epoch(cooking_end)::BIGINT - epoch(cooking_start)::BIGINT AS DOUBLE) / 60 AS minutes,
       CAST(date_diff('day', CAST(cooking_start AS DATE), CAST(cooking_end AS DATE)) AS INTEGER) AS days
FROM kitchen
""",
        kitchen=SQL_KITCHEN,
    ),
)
def fn_durations(spark, sf):
    ends = ("cooking_start", "cooking_end")
    return base.kitchen(spark, sf).select(
        "order_id", "chef_id", *ends,
        seconds_between(*ends).alias("seconds"),
        minutes_between(*ends).alias("minutes"),
        days_between(*ends).alias("days"),
    )


@query(
    "fn_json_explode",
    f"""SELECT order_id, order_ts, outlet_id, item_id, quantity, line_total,
 CAST(CASE WHEN toppings = '' THEN 0 ELSE 1 + length(toppings) // 2 END AS INTEGER) AS n_toppings
 FROM ({SQL_MENU_LINES})""",
)
def fn_json_explode(spark, sf):
    lines = menu_orders(spark, sf).withColumn("line", F.explode(parse_lines("order_menu_details")))
    return lines.select(
        "order_id", "order_ts", "outlet_id", "line.item_id", "line.quantity", "line.line_total",
        array_length("line.toppings").alias("n_toppings"),
    )


@query(
    "fn_json_roundtrip",
    "SELECT l_orderkey AS order_id, l_linenumber AS line, l_suppkey AS outlet_id, l_quantity AS quantity, true AS same"
    " FROM lineitem",
)
def fn_json_roundtrip(spark, sf):
    row = load(spark, sf, "lineitem")
    line = F.struct(
        F.col("l_partkey").cast("string").alias("item_id"), F.col("l_returnflag").alias("item_name"),
        F.col("l_quantity").cast("int").alias("quantity"), base.toppings().alias("toppings"),
        F.col("l_discount").alias("unit_price"), F.col("l_extendedprice").alias("line_total"),
    )
    nested = row.withColumn("lines", F.array(line).cast(LINE_SCHEMA))
    return nested.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("outlet_id"),
        F.col("l_quantity").alias("quantity"), (parse_lines(lines_to_json("lines")) == F.col("lines")).alias("same"),
    )


# --- business rules ------------------------------------------------------------------------------


@query(
    "flag_value_band",
    with_roles(
        """
SELECT order_id, total_order_price,
       CASE WHEN total_order_price < 200 THEN 'Low' WHEN total_order_price < 500 THEN 'Medium' ELSE 'High' END AS band,
       total_order_price > 300 AS is_high_value, payment_mode IN ('click', 'purchase') AS is_digital
FROM visits
""",
        visits=SQL_VISITS,
    ),
)
def flag_value_band(spark, sf):
    price = F.col("total_order_price")
    return base.visits(spark, sf).select(
        "order_id", "total_order_price", rules.value_band(price).alias("band"),
        rules.is_high_value(price, 300).alias("is_high_value"),
        rules.is_digital(F.col("payment_mode"), ("click", "purchase")).alias("is_digital"),
    )


@query(
    "flag_peak_weekend",
    """SELECT event_id, dayofweek(ts) IN (0, 6) AS is_weekend, hour(ts) IN (12, 13, 19, 20) AS is_order_peak,
 hour(ts) IN (12, 13, 19, 20, 21) AS is_service_peak FROM events""",
)
def flag_peak_weekend(spark, sf):
    hour = F.hour("ts")
    return load(spark, sf, "events").select(
        "event_id", rules.is_weekend("ts").alias("is_weekend"), rules.is_peak(hour).alias("is_order_peak"),
        rules.is_peak(hour, rules.SERVICE_PEAK_HOURS).alias("is_service_peak"),
    )


@query(
    "flag_inventory",
    with_roles(
        """
SELECT outlet_id, stock_item, available_quantity,
       CASE WHEN available_quantity <= 10 THEN 'low' WHEN available_quantity >= 100 THEN 'high' ELSE 'medium' END AS status,
       available_quantity <= 10 AS needs_restock
FROM stock
""",
        stock=SQL_STOCK,
    ),
)
def flag_inventory(spark, sf):
    quantity = F.col("available_quantity")
    return base.stock(spark, sf).select(
        "outlet_id", "stock_item", "available_quantity", rules.inventory_status(quantity).alias("status"),
        rules.needs_restock(quantity).alias("needs_restock"),
    )


@query(
    "flag_segment",
    with_roles(
        """
SELECT customer_id, n AS orders, spent, spent >= 5000 AS is_high_value,
       CASE WHEN spent >= 10000 THEN 'Gold' WHEN spent >= 3000 THEN 'Silver' WHEN spent >= 500 THEN 'Bronze' ELSE 'New' END
         AS segment,
       CASE WHEN n >= 50 THEN 'High' WHEN n >= 10 THEN 'Medium' WHEN n >= 1 THEN 'Low' ELSE 'None' END AS frequency
FROM (SELECT customer_id, count(order_id) AS n, """
        + sql_sum("total_order_price")
        + " AS spent FROM visits GROUP BY customer_id)",
        visits=SQL_VISITS,
    ),
)
def flag_segment(spark, sf):
    spent, orders = F.col("spent"), F.col("orders")
    per_buyer = base.visits(spark, sf).groupBy("customer_id").agg(
        F.count("order_id").alias("orders"), exact_sum("total_order_price").alias("spent")
    )
    return per_buyer.withColumns(
        {
            "is_high_value": rules.is_true(spent >= rules.HIGH_VALUE_SPEND),
            "segment": rules.customer_segment(spent),
            "frequency": rules.frequency_band(orders),
        }
    )
