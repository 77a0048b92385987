"""Grouped roll-ups shared by the data products. Every one aggregates in the map tasks first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import rules
from larder.functions.exact import exact_sum
from larder.functions.menu import array_length
from larder.functions.times import seconds_between
from larder.operators.joins import fill_defaults


def items_per_order(items: DataFrame) -> DataFrame:
    """Counts and prices of the lines of each order."""
    toppings = array_length("toppings")
    rolled = items.groupBy("order_id").agg(
        F.sum("quantity").alias("total_items"),
        F.count_distinct("item_id").alias("distinct_items_count"),
        F.sum(toppings).alias("total_toppings_count"),
        F.try_divide(exact_sum("line_total"), F.sum("quantity")).alias("avg_item_price_per_unit"),
        F.max("unit_price").alias("max_item_price"),
        F.min("unit_price").alias("min_item_price"),
        F.count_if(toppings > 0).alias("items_with_customizations"),
    )
    rolled = rolled.withColumn("is_customized_order", F.col("items_with_customizations") > 0)
    return fill_defaults(
        rolled,
        {
            "total_items": 0,
            "distinct_items_count": 0,
            "total_toppings_count": 0,
            "avg_item_price_per_unit": 0.0,
            "max_item_price": 0.0,
            "min_item_price": 0.0,
        },
    )


def orders_per_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders_by_customer"),
        exact_sum("total_order_price").alias("customer_lifetime_value"),
        F.max("order_ts").alias("last_order_ts"),
    )


def cooking_per_order(kitchen: DataFrame, sla_seconds: int = rules.COOK_SLA_SECONDS) -> DataFrame:
    """Longest cooking time of an order and whether any of its runs was late."""
    seconds = seconds_between("cooking_start", "cooking_end")
    return kitchen.groupBy("order_id").agg(
        F.max(seconds).alias("cook_duration_seconds"),
        F.bool_or(rules.is_delayed(seconds, sla_seconds)).alias("was_delayed_order"),
    )


def quantity_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("customer_id", "order_id").agg(F.sum("quantity").alias("items_in_order"))


def chef_workload(kitchen: DataFrame, peak_hours=rules.SERVICE_PEAK_HOURS) -> DataFrame:
    """All kitchen measures of a chef in one aggregation."""
    seconds = seconds_between("cooking_start", "cooking_end")
    orders, days = F.count("order_id"), F.count_distinct(F.to_date("cooking_start"))
    return kitchen.groupBy("chef_id").agg(
        orders.alias("total_orders_cooked"),
        F.try_divide(orders, days).alias("avg_orders_per_day"),
        F.avg(seconds).alias("avg_cooking_time_sec"),
        F.min(seconds).alias("min_cooking_time_sec"),
        F.max(seconds).alias("max_cooking_time_sec"),
        F.count_if(rules.is_peak(F.hour("cooking_start"), peak_hours)).alias("peak_hour_orders"),
    )


def slot_prices(hour: Column, price: Column) -> dict[str, Column]:
    """The price in the column of its day slot, zero in those of the other slots."""
    return {f"{s}_sales": F.when(rules.in_slot(hour, s), price).otherwise(F.lit(0.0)) for s in rules.DAY_SLOTS}


def slot_measures(hour: Column) -> dict[str, Column]:
    """Sales and order counts of the day slots, as aggregates over ``slot_prices``."""
    sales = {f"{s}_sales": exact_sum(f"{s}_sales") for s in rules.DAY_SLOTS}
    return {**sales, **{f"{s}_orders": F.count_if(rules.in_slot(hour, s)) for s in rules.DAY_SLOTS}}


def named(aggregates: dict[str, Column]) -> list[Column]:
    return [a.alias(n) for n, a in aggregates.items()]
