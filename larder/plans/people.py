"""Customer and chef products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import rules
from larder.functions.exact import exact_sum, rounded_ratio
from larder.functions.menu import array_length
from larder.functions.times import DAY_NAMES, day_short_name, days_between, parse_timestamps
from larder.operators.clean import stamp
from larder.operators.favourites import attribute_counts, largest_first, winner
from larder.operators.joins import fill_defaults, lookup
from larder.operators.rollups import chef_workload, quantity_per_order

Tables = dict[str, DataFrame]

# Output columns of the products, in order.
PROFILE_COLUMNS = (
    "customer_id total_orders average_order_value max_order_value min_order_value total_spent"
    " first_order_date last_order_date days_as_customer days_since_last_order total_items_ordered"
    " is_repeat_customer is_active_customer is_high_value_customer customer_segment"
    " customer_frequency_band items_per_order"
).split()
PREFERENCE_COLUMNS = (
    "item_id favorite_item_name outlet_id favorite_outlet_name orders_at_outlet preferred_payment_mode"
    " orders_by_payment_method favorite_order_day favorite_order_hour weekend_order_ratio preferred_order_type"
).split()
CHEF_COLUMNS = (
    "chef_id chef_name outlet_id outlet_name total_orders_cooked avg_orders_per_day avg_cooking_time_sec"
    " min_cooking_time_sec max_cooking_time_sec peak_hour_orders ingested_at total_sales_value_cooked_by_chef"
).split()


def _spending() -> list[Column]:
    return [
        F.count("order_id").alias("orders"),
        F.count("total_order_price").alias("priced"),
        exact_sum("total_order_price").alias("spent"),
        F.max("total_order_price").alias("highest"),
        F.min("total_order_price").alias("lowest"),
        F.min("order_ts").alias("first_ts"),
        F.max("order_ts").alias("last_ts"),
        F.sum("items_in_order").alias("items"),
    ]


def customer_profile(tables: Tables, loaded_at: Column | None = None, as_of: Column | None = None) -> DataFrame:
    """One row per customer with sales, and one null row for all sales of unknown customers.

    Sales shrink to one row per customer before they meet the customer dimension, so that join is
    as large as the dimension and the unknown customers never gather as raw rows under one key.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    sales = parse_timestamps(tables["fact_sales"], "order_ts").select(
        "order_id", "customer_id", "order_ts", "total_order_price"
    )
    # Dealt by order once: the roll-up by customer and order and the join by order both find their rows together.
    items = tables["fact_sales_items"].select("customer_id", "order_id", "quantity").filter(F.col("order_id").isNotNull())
    quantities = quantity_per_order(items.repartition("order_id")).select("order_id", "items_in_order")
    per_buyer = sales.join(quantities, "order_id", "left").groupBy("customer_id").agg(*_spending())

    known = tables["dim_customer"].select(F.col("customer_id").alias("known_id"))
    profile = (
        per_buyer.join(known, F.col("customer_id") == F.col("known_id"), "left")
        .groupBy(F.col("known_id").alias("customer_id"))
        .agg(
            F.sum("orders").alias("total_orders"),
            rounded_ratio("spent", "sum(priced)").alias("average_order_value"),
            F.max("highest").alias("max_order_value"),
            F.min("lowest").alias("min_order_value"),
            exact_sum("spent").alias("total_spent"),
            F.min("first_ts").alias("first_order_date"),
            F.max("last_ts").alias("last_order_date"),
            F.sum("items").alias("total_items_ordered"),
        )
    )
    orders, spent = F.col("total_orders"), F.col("total_spent")
    idle_days = days_between(F.col("last_order_date"), as_of)
    profile = profile.withColumns(
        {
            "days_as_customer": days_between(F.col("first_order_date"), F.col("last_order_date")),
            "days_since_last_order": idle_days,
            "is_repeat_customer": orders > 1,
            "is_active_customer": rules.is_true(idle_days <= rules.ACTIVE_DAYS),
            "is_high_value_customer": rules.is_true(spent >= rules.HIGH_VALUE_SPEND),
            "customer_segment": rules.customer_segment(spent),
            "customer_frequency_band": rules.frequency_band(orders),
            "items_per_order": F.round(F.try_divide("total_items_ordered", orders), 2),
        }
    )
    return stamp(profile.select(*PROFILE_COLUMNS), loaded_at)


def _order_habits(sales: DataFrame) -> DataFrame:
    """One row per customer with the winners of five order attributes and the weekend share."""
    attributes = {
        "outlet": F.col("outlet_id"),
        "payment": F.col("payment_mode"),
        "day": day_short_name(F.col("order_ts")),
        "hour": F.hour("order_ts"),
        "type": F.col("order_type"),
    }
    counts = attribute_counts(sales, "customer_id", attributes, counted="order_id")
    is_day = F.col("attribute") == "day"
    weekend = F.col("value").isin(*[DAY_NAMES[d - 1][:3] for d in rules.WEEKEND_DAYS])
    hour = F.col("value").try_cast("int")
    picked = counts.groupBy("customer_id").agg(
        winner("outlet").alias("outlet"),
        winner("payment").alias("payment"),
        winner("day").alias("day"),
        F.min(
            F.when(F.col("attribute") == "hour", F.struct((-F.col("n")).alias("minus_n"), hour.alias("value")))
        ).alias("hour"),
        winner("type").alias("type"),
        F.sum(F.when(is_day & weekend, F.col("n_rows")).otherwise(0)).alias("weekend_orders"),
        F.sum(F.when(is_day, F.col("n")).otherwise(0)).alias("all_orders"),
    )
    share = F.coalesce(F.try_divide("weekend_orders", "all_orders"), F.lit(0.0))
    return picked.select(
        "customer_id",
        F.col("outlet.value").alias("outlet_id"),
        (-F.col("outlet.minus_n")).alias("orders_at_outlet"),
        F.col("payment.value").alias("preferred_payment_mode"),
        (-F.col("payment.minus_n")).alias("orders_by_payment_method"),
        F.col("day.value").alias("favorite_order_day"),
        F.col("hour.value").alias("favorite_order_hour"),
        F.round(share, 2).alias("weekend_order_ratio"),
        F.col("type.value").alias("preferred_order_type"),
    )


def favourite_items(items: DataFrame) -> DataFrame:
    """The item each customer took most of; ties by line total, toppings, then item id.

    Ranking by quantity decides alone: the two weaker rankings only speak where quantities tie.
    """
    totals = items.groupBy("customer_id", "item_id").agg(
        F.sum("quantity").alias("quantity"),
        exact_sum("line_total").alias("line_total"),
        F.sum(array_length("toppings")).alias("toppings"),
    )
    fields = [f.alias(f"f{i}") for i, f in enumerate(largest_first("quantity", "line_total", "toppings"))]
    best = totals.groupBy("customer_id").agg(F.min(F.struct(*fields, "item_id")).alias("best"))
    return best.select("customer_id", F.col("best.item_id").alias("item_id"))


def customer_preference(tables: Tables, loaded_at: Column | None = None) -> DataFrame:
    """All dimension customers with their favourites, nulls where they never ordered."""
    customers = tables["dim_customer"]
    bought = F.col("customer_id").isNotNull()
    sales = parse_timestamps(tables["fact_sales"], "order_ts").filter(bought)
    outlet_type = sales.schema["outlet_id"].dataType

    habits = _order_habits(sales).withColumn("outlet_id", F.col("outlet_id").cast(outlet_type))
    items = favourite_items(tables["fact_sales_items"].filter(bought))
    wide = customers.join(habits, "customer_id", "left").join(items, "customer_id", "left")
    wide = lookup(wide, tables["dim_item"], "item_id", "item_name", renamed={"item_name": "favorite_item_name"})
    wide = lookup(
        wide, tables["dim_outlet"], "outlet_id", "outlet_name", renamed={"outlet_name": "favorite_outlet_name"}
    )
    own = [c for c in customers.columns if c != "customer_id"]
    return stamp(wide.select("customer_id", *own, *PREFERENCE_COLUMNS), loaded_at)


def chef_performance(
    tables: Tables, loaded_at: Column | None = None, peak_hours=rules.SERVICE_PEAK_HOURS
) -> DataFrame:
    """One row per chef seen in the kitchen. The outlet is the chef's own, not the kitchen row's."""
    kitchen = parse_timestamps(tables["fact_kitchen"], "cooking_start", "cooking_end").filter(
        F.col("chef_id").isNotNull()
    )
    sold = (
        tables["fact_sales"]
        .select("order_id", "total_order_price")
        .join(kitchen.select("order_id", "chef_id"), "order_id", "inner")
        .groupBy("chef_id")
        .agg(exact_sum("total_order_price").alias("total_sales_value_cooked_by_chef"))
    )
    wide = chef_workload(kitchen, peak_hours).join(sold, "chef_id", "left")
    wide = fill_defaults(wide, {"peak_hour_orders": 0})
    wide = lookup(wide, tables["dim_chef"], "chef_id", "chef_name", "outlet_id")
    wide = lookup(wide, tables["dim_outlet"], "outlet_id", "outlet_name")
    return stamp(wide, loaded_at).select(*CHEF_COLUMNS)
