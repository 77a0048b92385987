import math
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder.functions import rules
from larder.functions.exact import exact_sum, rounded_mean, rounded_ratio
from larder.functions.menu import array_length, lines_to_json, parse_lines
from larder.functions.times import calendar_parts, days_between, minutes_between, parse_timestamps, seconds_between


def evaluate(spark, expression, value, kind="double"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("r")).collect()[0].r


# --- exact sums ----------------------------------------------------------------------------------


def test_exact_sum_equals_decimal_sum_in_any_order(spark):
    random.seed(3)
    values = [round(random.uniform(-1e6, 1e6), random.randint(0, 6)) for _ in range(5000)]
    expected = float(sum(Decimal(repr(v)) for v in values))
    for parts, ordered in ((1, values), (7, sorted(values)), (16, sorted(values, reverse=True))):
        df = spark.createDataFrame([(v,) for v in ordered], "v double").repartition(parts)
        assert df.agg(exact_sum("v").alias("s")).first().s == expected


@pytest.mark.parametrize(
    ("values", "expected"),
    [([], None), ([None], None), ([None, 2.5], 2.5), ([1e300, 1.0], 1e300), ([float("inf"), 1.0], math.inf), ([1e13, 0.25], 1e13 + 0.25)],
)
def test_exact_sum_edges(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(exact_sum("v").alias("s")).first().s == expected


@pytest.mark.parametrize("value, n", [("1e-7D", 10_000_000), ("1D / 3D", 3_000_000), ("9.9e11D", 10_000_000)])
def test_exact_sum_loses_no_digit(spark, value, n):
    one = spark.range(1).selectExpr(f"{value} AS v").first().v
    total = spark.range(n).selectExpr(f"{value} AS v").agg(exact_sum("v").alias("s")).first().s
    assert total == pytest.approx(float(Decimal(repr(one)) * n), rel=2.3e-16)


def test_exact_sum_of_mixed_magnitudes_in_any_order(spark):
    draws = random.Random(3)
    values = [draws.choice((1, -1)) * 10 ** draws.uniform(-9, 13) for _ in range(5000)]
    for seed in range(3):
        draws.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(seed + 2)
        assert df.agg(exact_sum("v").alias("s")).first().s == pytest.approx(math.fsum(values), rel=2.3e-16)


def test_exact_sum_of_nan_is_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert math.isnan(df.agg(exact_sum("v").alias("s")).first().s)


def test_rounded_mean_rounds_half_up(spark):
    df = spark.createDataFrame([(0.01,), (0.0,), (None,)], "v double")
    out = df.agg(rounded_mean("v").alias("m"), rounded_ratio("v", "sum(0)").alias("z")).first()
    assert (out.m, out.z) == (0.01, None)
    huge = spark.createDataFrame([(1e300,), (1e300,)], "v double")
    assert huge.agg(rounded_mean("v").alias("m")).first().m == 1e300


# --- times ---------------------------------------------------------------------------------------


def test_calendar_parts(spark):
    parts = calendar_parts("t", date="d", hour="h", week="w", month="m", year="y", weekday="n", weekday_name="l", weekday_short="s")
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.sql(
            f"""SELECT cast(t as {kind}) t FROM VALUES ('2025-11-15 12:00:00'), ('2025-11-16 23:59:59'),
            ('2025-11-17 00:00:00'), ('2024-12-31 07:00:00'), ('2027-01-01 08:00:00'), (null) AS v(t)"""
        )
        out = [tuple(r)[1:] for r in df.withColumns(parts).select("t", "h", "w", "m", "y", "n", "l", "s").collect()]
        assert out == [
            (12, 46, 11, 2025, 7, "Saturday", "Sat"),
            (23, 46, 11, 2025, 1, "Sunday", "Sun"),
            (0, 47, 11, 2025, 2, "Monday", "Mon"),
            (7, 1, 12, 2024, 3, "Tuesday", "Tue"),
            (8, 53, 1, 2027, 6, "Friday", "Fri"),
            (None, None, None, None, None, "Saturday", None),
        ]


def test_durations_cut_each_side_to_the_second(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 1, 1, 10, 0, 0, 900000), datetime(2025, 1, 1, 10, 10, 1, 100000)), (datetime(2025, 1, 1), None)],
        "a timestamp, b timestamp",
    )
    out = df.select(seconds_between("a", "b"), minutes_between("a", "b"), days_between("a", "b")).collect()
    assert tuple(out[0]) == (601, 601 / 60, 0)
    assert tuple(out[1]) == (None, None, None)


def test_only_text_is_parsed(spark):
    df = spark.createDataFrame([("2025-11-10T01:02:03", datetime(2025, 1, 1)), ("soon", None)], "a string, b timestamp")
    out = parse_timestamps(df, "a", "b").collect()
    assert [tuple(r) for r in out] == [(datetime(2025, 11, 10, 1, 2, 3), datetime(2025, 1, 1)), (None, None)]


# --- order lines ---------------------------------------------------------------------------------


def test_lines_survive_the_round_trip(spark):
    text = '[{"item_id":"I1","item_name":"Pie","quantity":2,"toppings":["a","b"],"unit_price":60.0,"line_total":120.0}]'
    df = spark.createDataFrame([(text,)], "j string")
    assert df.select(lines_to_json(parse_lines("j")).alias("j")).first().j == text


def test_malformed_and_partial_lines(spark):
    df = spark.createDataFrame([("{oops",), (None,), ("[]",), ('[{"item_id":"I1"}]',)], "j string")
    parsed = df.select(parse_lines("j").alias("l")).select("l", array_length("l")).collect()
    assert [r[1] for r in parsed] == [0, 0, 0, 1]
    assert parsed[3].l[0].toppings is None and parsed[3].l[0].item_id == "I1"


# --- rules ---------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("value", "band"),
    [(199.99, "Low"), (200.0, "Medium"), (499.99, "Medium"), (500.0, "High"), (None, "High")],
)
def test_value_band(spark, value, band):
    assert evaluate(spark, rules.value_band(F.col("v")), value) == band


@pytest.mark.parametrize(("value", "flag"), [(500.0, False), (500.01, True), (None, False)])
def test_high_value(spark, value, flag):
    assert evaluate(spark, rules.is_high_value(F.col("v")), value) is flag


@pytest.mark.parametrize(
    ("value", "status", "restock"),
    [(9.99, "low", True), (10.0, "low", True), (10.01, "medium", False), (99.99, "medium", False), (100.0, "high", False)],
)
def test_inventory(spark, value, status, restock):
    assert evaluate(spark, rules.inventory_status(F.col("v")), value) == status
    assert evaluate(spark, rules.needs_restock(F.col("v")), value) is restock


@pytest.mark.parametrize(
    ("value", "segment"), [(499.0, "New"), (500.0, "Bronze"), (3000.0, "Silver"), (9999.0, "Silver"), (10000.0, "Gold"), (None, "New")]
)
def test_segment(spark, value, segment):
    assert evaluate(spark, rules.customer_segment(F.col("v")), value) == segment


@pytest.mark.parametrize(("value", "band"), [(0, "None"), (1, "Low"), (9, "Low"), (10, "Medium"), (50, "High")])
def test_frequency(spark, value, band):
    assert evaluate(spark, rules.frequency_band(F.col("v")), value, "int") == band


@pytest.mark.parametrize(("seconds", "late"), [(600, False), (601, True), (None, False)])
def test_delay(spark, seconds, late):
    assert evaluate(spark, rules.is_delayed(F.col("v")), seconds, "bigint") is late


@pytest.mark.parametrize(
    ("hour", "order_peak", "service_peak", "slot"),
    [
        (0, False, False, None), (7, False, False, None), (8, False, False, "morning"), (11, False, False, "morning"),
        (12, True, True, "afternoon"), (13, True, True, "afternoon"), (15, False, False, "afternoon"),
        (16, False, False, "evening"), (19, True, True, "evening"), (20, True, True, "night"),
        (21, False, True, "night"), (23, False, False, "night"), (None, False, False, None),
    ],
)
def test_hours(spark, hour, order_peak, service_peak, slot):
    v = F.col("v")
    assert evaluate(spark, rules.is_peak(v), hour, "int") is order_peak
    assert evaluate(spark, rules.is_peak(v, rules.SERVICE_PEAK_HOURS), hour, "int") is service_peak
    hits = [s for s in rules.DAY_SLOTS if evaluate(spark, rules.in_slot(v, s), hour, "int")]
    assert hits == ([slot] if slot else [])


@pytest.mark.parametrize(("mode", "digital"), [("UPI", True), ("Card", True), ("Wallet", True), ("Cash", False), (None, False)])
def test_digital(spark, mode, digital):
    assert evaluate(spark, rules.is_digital(F.col("v")), mode, "string") is digital


def test_average_item_price_and_percentage(spark):
    df = spark.createDataFrame([(10.0, 4, 1, 8), (10.0, 0, 1, 0), (None, None, 0, 5)], "p double, n int, a int, b int")
    out = df.select(rules.average_item_price(F.col("p"), F.col("n")), rules.percentage(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in out] == [(2.5, 12.5), (0.0, None), (0.0, 0.0)]
