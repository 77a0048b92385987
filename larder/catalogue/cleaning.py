"""Cleaning steps over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalogue.base import load, query
from larder.operators import clean
from larder.tables import CleaningRules


@query("clean_trim", "SELECT doc_id, trim(text, ' ') AS text, lang, source FROM documents")
def clean_trim(spark, sf):
    return clean.trim_strings(load(spark, sf, "documents").select("doc_id", "text", "lang", "source"))


def order_texts(spark, sf):
    """Orders as a text source delivers them: padded, with unreadable prices and times for some statuses."""
    status = F.col("o_orderstatus")
    moment = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(status == "F", "soon").otherwise(moment).alias("ordered"),
        F.when(status == "O", "12x").otherwise(F.col("o_custkey").cast("string")).alias("buyer"),
        F.col("o_custkey").alias("buyer_code"),
        F.when(F.col("o_orderpriority") == "5-LOW", "  ")
        .when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")))
        .alias("priority"),
    )


SQL_ORDER_TEXTS = """
(SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS price,
        CASE WHEN o_orderstatus = 'F' THEN 'soon' ELSE CAST(o_orderdate AS VARCHAR) END AS ordered,
        CASE WHEN o_orderstatus = 'O' THEN '12x' ELSE CAST(o_custkey AS VARCHAR) END AS buyer, o_custkey AS buyer_code,
        CASE WHEN o_orderpriority = '5-LOW' THEN '  '
             WHEN o_orderpriority <> '1-URGENT' THEN ' ' || o_orderpriority || '  ' END AS priority FROM orders)
"""


@query(
    "clean_cast",
    f"""SELECT o_orderkey, TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(ordered AS TIMESTAMP) AS ordered,
 TRY_CAST(buyer AS INTEGER) AS buyer, CAST(buyer_code AS VARCHAR) AS buyer_code FROM {SQL_ORDER_TEXTS}""",
)
def clean_cast(spark, sf):
    casts = {"price": "double", "ordered": "timestamp", "buyer": "int", "buyer_code": "string"}
    typed = clean.cast_columns(order_texts(spark, sf).drop("priority"), casts)
    return typed.withColumn("ordered", F.col("ordered").cast("timestamp_ntz"))


@query(
    "clean_mandatory",
    f"SELECT o_orderkey, trim(priority) AS priority FROM {SQL_ORDER_TEXTS} WHERE trim(priority) <> ''",
)
def clean_mandatory(spark, sf):
    texts = order_texts(spark, sf).select("o_orderkey", "priority")
    return clean.require(clean.trim_strings(texts), ["o_orderkey", "priority"])


LINE_REST = (
    "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()


@query(
    "clean_dedup",
    f"""SELECT * FROM lineitem
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(LINE_REST)}) = 1""",
)
def clean_dedup(spark, sf):
    return clean.drop_repeats(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_REST)


@query("clean_domain", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')")
def clean_domain(spark, sf):
    allowed = {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": ["F", "O"]}
    return clean.keep_allowed(load(spark, sf, "orders"), allowed)


@query(
    "clean_anomaly",
    """SELECT *, o_totalprice > 400000 AS o_totalprice_anomaly_flag, o_custkey < 10 AS o_custkey_anomaly_flag
 FROM orders""",
)
def clean_anomaly(spark, sf):
    bounds = {"o_totalprice": {"gt": 400000}, "o_custkey": {"lt": 10}}
    return clean.flag_anomalies(load(spark, sf, "orders"), bounds)


LINE_RULES = CleaningRules(
    mandatory=("line_key", "flag"),
    casts={"shipped": "timestamp", "price": "double", "quantity": "int"},
    allowed={"flag": ("A", "R")},
    unique_by=("line_key",),
    anomalies={"price": {"gt": 80000}},
)


@query(
    "clean_table",
    """
SELECT *, coalesce(price > 80000, false) AS price_anomaly_flag FROM (
  SELECT line_key, flag, TRY_CAST(shipped AS TIMESTAMP) AS shipped, price, quantity FROM (
    SELECT l_orderkey || '-' || l_linenumber AS line_key, CASE WHEN l_linestatus = 'F' THEN l_returnflag ELSE 'A' END AS flag,
           CAST(l_shipdate AS VARCHAR) AS shipped, l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS quantity
    FROM lineitem)
  QUALIFY row_number() OVER (PARTITION BY line_key ORDER BY shipped, price, quantity, flag) = 1)
WHERE flag IN ('A', 'R')
""",
)
def clean_table(spark, sf):
    padded = F.when(F.col("l_linestatus") == "F", F.concat("l_returnflag", F.lit(" "))).otherwise(" A ")
    raw = load(spark, sf, "lineitem").select(
        F.concat(F.lit(" "), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"), F.lit(" ")).alias("line_key"),
        padded.alias("flag"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("shipped"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
    )
    rows = clean.clean_table(raw, LINE_RULES, prefer=["shipped", "price", "quantity", "flag"])
    return rows.drop("ingested_at").withColumn("shipped", F.col("shipped").cast("timestamp_ntz"))
