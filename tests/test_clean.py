from datetime import datetime

from pyspark.sql import functions as F

from larder.operators import clean
from larder.tables import TABLES, CleaningRules


def test_trim_takes_spaces_but_not_tabs(spark, rows):
    df = spark.createDataFrame([("  a ", 1), ("\tb\t", 2), (None, 3)], "s string, n int")
    assert rows(clean.trim_strings(df), "s") == [("\tb\t",), ("a",), (None,)]


def test_lenient_casts(spark):
    df = spark.createDataFrame(
        [("2025-11-10T12:30:00", "1.5", "7", 3), ("never", "x", "7.5x", 4)], "t string, d string, i string, s int"
    )
    out = clean.cast_columns(df, {"t": "timestamp", "d": "double", "i": "int", "s": "string"}).collect()
    assert tuple(out[0]) == (datetime(2025, 11, 10, 12, 30), 1.5, 7, "3")
    assert tuple(out[1]) == (None, None, None, "4")


def test_timestamps_pass_the_timestamp_cast(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1),)], "t timestamp")
    assert clean.cast_columns(df, {"t": "timestamp"}).collect()[0].t == datetime(2025, 1, 1)


def test_mandatory_rejects_null_blank_and_keeps_typed_values(spark, rows):
    df = spark.createDataFrame(
        [("a", datetime(2025, 1, 1)), ("   ", datetime(2025, 1, 1)), (None, None), ("b", None)], "k string, t timestamp"
    )
    assert rows(clean.require(clean.trim_strings(df), ["k", "t"]), "k") == [("a",)]


def test_repeats_with_and_without_preference(spark, rows):
    df = spark.createDataFrame([("k", 2), ("k", 1), ("l", 5)], "k string, n int")
    assert rows(clean.drop_repeats(df, ["k"], [F.desc("n")])) == [("k", 2), ("l", 5)]
    assert clean.drop_repeats(df, ["k"]).count() == 2
    assert clean.drop_repeats(df, []).count() == 3


def test_allowed_values_drop_nulls(spark, rows):
    df = spark.createDataFrame([("UPI",), ("Cheque",), (None,)], "mode string")
    assert rows(clean.keep_allowed(df, {"mode": ["UPI", "Card"]})) == [("UPI",)]


def test_anomaly_flags_on_both_sides(spark, rows):
    df = spark.createDataFrame([(5000.0,), (5000.01,), (-2.0,), (None,)], "p double")
    gt = clean.flag_anomalies(df, {"p": {"gt": 5000}})
    assert rows(gt) == [(-2.0, False), (5000.0, False), (5000.01, True), (None, False)]
    lt = clean.flag_anomalies(df, {"p": {"lt": -1}})
    assert rows(lt) == [(-2.0, True), (5000.0, False), (5000.01, False), (None, False)]


def test_house_rule_flags_every_sensible_stock_level(spark, rows):
    df = spark.createDataFrame([(-5.0,), (-1.0,), (0.0,)], "available_quantity double")
    flagged = clean.flag_anomalies(df, TABLES["fact_stock"].rules.anomalies)
    assert rows(flagged) == [(-1.0, False), (-5.0, False), (0.0, True)]


def test_units_outside_the_list_are_dropped(spark, rows):
    raw = spark.createDataFrame(
        [("1", "salt", "kg"), ("2", "buns", "pcs"), ("3", "oil", "liters")], "stock_id string, stock_item string, unit_of_measure string"
    )
    assert rows(clean.clean_table(raw, TABLES["dim_stock_item"].rules), "stock_id") == [("1",)]


def test_invalid_duplicate_displaces_a_valid_one(spark):
    rules = CleaningRules(mandatory=("id",), unique_by=("id",), allowed={"mode": ("UPI",)})
    raw = spark.createDataFrame([(" 1 ", "Bad", 1), ("1", "UPI", 2)], "id string, mode string, n int")
    assert clean.clean_table(raw, rules, prefer=["n"]).count() == 0
    assert clean.clean_table(raw, rules, prefer=[F.desc("n")]).count() == 1


def test_cleaner_is_idempotent(spark, rows):
    raw = spark.createDataFrame(
        [(" 1 ", "2025-11-10 08:00:00", "501.5", "UPI", "Delivery"), ("2", "bad", "5001", "Cash ", "Dine-In")],
        "order_id string, order_ts string, total_order_price string, payment_mode string, order_type string",
    )
    once = clean.clean_table(raw, TABLES["fact_sales"].rules).drop("ingested_at")
    assert rows(clean.clean_table(once, TABLES["fact_sales"].rules).drop("ingested_at")) == rows(once)
    assert [r.total_order_price_anomaly_flag for r in once.orderBy("order_id").collect()] == [False, True]
