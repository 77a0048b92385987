"""Query registry, and the retail roles played by the test tables in both languages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import rules
from larder.operators.clean import drop_repeats

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# Schemas of the test tables, declared so that a read opens no file for them.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


# --- SQL fragments -------------------------------------------------------------------------------


def sql_sum(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DOUBLE)"


def sql_mean(value: str, count: str | None = None) -> str:
    """Mean of amounts in cents, rounded half up to cents."""
    cents, n = f"sum(CAST(round({value} * 100) AS BIGINT))", count or f"count({value})"
    return f"CAST((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def sql_long(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


SQL_SALES = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_nationkey AS outlet_id, o_orderdate AS order_ts,
       o_totalprice AS total_order_price, o_orderstatus AS order_type, o_orderpriority AS payment_mode,
       o_totalprice > 1000 AS high_value_flag, o_totalprice > 5000 AS total_order_price_anomaly_flag
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""
SQL_VISITS = """
SELECT event_id AS order_id, user_id AS customer_id, c_nationkey AS outlet_id, ts AS order_ts,
       value AS total_order_price, event_type AS order_type, event_type AS payment_mode,
       value > 400 AS high_value_flag, value > 450 AS total_order_price_anomaly_flag
FROM events LEFT JOIN customer ON user_id = c_custkey
"""
SQL_ITEMS = """
SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS item_id, p_name AS item_name,
       CAST(l_quantity AS INTEGER) AS quantity, p_retailprice AS unit_price, l_extendedprice AS line_total,
       CAST(l_returnflag <> 'N' AS INTEGER) + CAST(l_linestatus <> 'O' AS INTEGER) AS n_toppings
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
"""
SQL_KITCHEN = """
SELECT l_orderkey AS order_id, s_nationkey AS outlet_id, l_suppkey AS chef_id,
       o_orderdate AS cooking_start, l_shipdate AS cooking_end
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
"""
SQL_KITCHEN_ONCE = f"""
SELECT order_id, outlet_id, chef_id, cooking_start, cooking_end
FROM ({SQL_KITCHEN})
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY chef_id, cooking_end) = 1
"""
SQL_STOCK = """
SELECT s_nationkey AS outlet_id, stock_item, available_quantity,
       CASE WHEN available_quantity > 10 THEN 'kg' END AS unit_of_measure, stock_date
FROM (SELECT l_suppkey, l_partkey AS stock_item, sum(l_quantity) AS available_quantity, max(l_shipdate) AS stock_date
      FROM lineitem GROUP BY l_suppkey, l_partkey)
LEFT JOIN supplier ON l_suppkey = s_suppkey
"""


def with_roles(body: str, **roles: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in roles.items()) + body


# --- the same roles as DataFrames ----------------------------------------------------------------


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as sales; the buyer's nation is the outlet."""
    buyers = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    price = F.col("o_totalprice")
    return (
        load(spark, sf, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("outlet_id"),
            F.col("o_orderdate").alias("order_ts"),
            price.alias("total_order_price"),
            F.col("o_orderstatus").alias("order_type"),
            F.col("o_orderpriority").alias("payment_mode"),
            rules.is_high_value(price, rules.HIGH_VALUE_SOURCE).alias("high_value_flag"),
            (price > 5000).alias("total_order_price_anomaly_flag"),
        )
    )


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sales, for everything that needs hours of the day."""
    buyers = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    price = F.col("value")
    return (
        load(spark, sf, "events")
        .join(buyers, F.col("user_id") == F.col("c_custkey"), "left")
        .select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            F.col("c_nationkey").alias("outlet_id"),
            F.col("ts").alias("order_ts"),
            price.alias("total_order_price"),
            F.col("event_type").alias("order_type"),
            F.col("event_type").alias("payment_mode"),
            (price > 400).alias("high_value_flag"),
            (price > 450).alias("total_order_price_anomaly_flag"),
        )
    )


def toppings() -> Column:
    """Zero to two names per line: the flags other than N and O."""
    return F.array_except(F.array("l_returnflag", "l_linestatus"), F.array(F.lit("N"), F.lit("O")))


def bare_items(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their item."""
    parts = load(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return (
        load(spark, sf, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("l_extendedprice").alias("line_total"),
            toppings().alias("toppings"),
        )
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their item and buyer."""
    buyers = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    return bare_items(spark, sf).join(buyers, "order_id", "left")


def kitchen(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as kitchen runs: cooked by the supplier, from order to shipping."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    cooks = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return (
        load(spark, sf, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(cooks, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("s_nationkey").alias("outlet_id"),
            F.col("l_suppkey").alias("chef_id"),
            F.col("o_orderdate").alias("cooking_start"),
            F.col("l_shipdate").alias("cooking_end"),
        )
    )


def kitchen_once(spark: SparkSession, sf: str) -> DataFrame:
    """One kitchen run per order, as the cleaned raw table holds."""
    return drop_repeats(kitchen(spark, sf), ["order_id"], ["chef_id", "cooking_end"])


def stock(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity on hand per supplier and part; small levels carry no unit."""
    levels = (
        load(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.col("l_partkey").alias("stock_item"))
        .agg(F.sum("l_quantity").alias("available_quantity"), F.max("l_shipdate").alias("stock_date"))
    )
    outlets = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return levels.join(outlets, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(
        F.col("s_nationkey").alias("outlet_id"),
        "stock_item",
        "available_quantity",
        F.when(F.col("available_quantity") > 10, "kg").alias("unit_of_measure"),
        "stock_date",
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_mobile")
    )


def outlets(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "nation").select(
        F.col("n_nationkey").alias("outlet_id"), F.col("n_name").alias("outlet_name")
    )


def chefs(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("chef_id"), F.col("s_name").alias("chef_name"), F.col("s_nationkey").alias("outlet_id")
    )


def menu(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"), F.col("p_retailprice").alias("unit_price")
    )


def stock_items(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(
        F.col("p_partkey").alias("stock_id"), F.col("p_partkey").alias("stock_item"), F.col("p_type").alias("unit_of_measure")
    )
