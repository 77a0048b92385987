"""Outlet product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import rules
from larder.functions.exact import exact_sum, rounded_mean, rounded_ratio
from larder.functions.times import parse_timestamps, seconds_between
from larder.operators.clean import stamp
from larder.operators.rollups import named, slot_measures, slot_prices

Tables = dict[str, DataFrame]

# Counted order attributes and the percentage column of each count.
TYPE_COUNTS = {"dine_in_orders": "Dine-In", "takeaway_orders": "Takeaway", "delivery_orders": "Delivery"}
MODE_COUNTS = {"upi_payments": "UPI", "card_payments": "Card", "cash_payments": "Cash", "wallet_payments": "Wallet"}
PERCENTAGES = {
    "high_value_order_pct": "high_value_orders",
    "anomalous_order_pct": "anomalous_orders",
    "dine_in_order_pct": "dine_in_orders",
    "takeaway_order_pct": "takeaway_orders",
    "delivery_order_pct": "delivery_orders",
    "upi_payment_pct": "upi_payments",
    "card_payment_pct": "card_payments",
    "cash_payment_pct": "cash_payments",
    "wallet_payment_pct": "wallet_payments",
}


def percentages() -> dict[str, Column]:
    return {pct: rules.percentage(F.col(n), F.col("total_orders")) for pct, n in PERCENTAGES.items()}


def order_counts(type_counts: dict[str, str] = TYPE_COUNTS, mode_counts: dict[str, str] = MODE_COUNTS) -> dict:
    """The nine conditional counts, as aggregates."""
    return {
        "high_value_orders": F.count_if(F.col("high_value_flag")),
        "anomalous_orders": F.count_if(F.col("total_order_price_anomaly_flag")),
        **{n: F.count_if(F.col("order_type") == v) for n, v in type_counts.items()},
        **{n: F.count_if(F.col("payment_mode") == v) for n, v in mode_counts.items()},
    }


def outlet_performance(
    tables: Tables,
    loaded_at: Column | None = None,
    peak_hours=rules.SERVICE_PEAK_HOURS,
    type_counts: dict[str, str] = TYPE_COUNTS,
    mode_counts: dict[str, str] = MODE_COUNTS,
) -> DataFrame:
    """All dimension outlets with measures of their cooked orders, nulls where there are none.

    Sales and kitchen meet once on order_id. One aggregation by outlet and day, combined in the map
    tasks, then carries every measure to the final one by outlet; totals, daily means, peak hours
    and day slots all come from those few rows.
    """
    sales = parse_timestamps(tables["fact_sales"], "order_ts").select(
        "order_id", "order_ts", "total_order_price", "order_type", "payment_mode", "high_value_flag",
        "total_order_price_anomaly_flag",
    )
    kitchen = parse_timestamps(tables["fact_kitchen"], "cooking_start", "cooking_end").select(
        "order_id", "outlet_id", "cooking_start", "cooking_end"
    )
    served = sales.join(kitchen.filter(F.col("outlet_id").isNotNull()), "order_id", "inner")

    price, hour = F.col("total_order_price"), F.hour("order_ts")
    served = served.withColumns(
        {
            "order_date": F.to_date("order_ts"),
            "is_peak_hour": rules.is_peak(hour, peak_hours),
            "peak_price": F.when(rules.is_peak(hour, peak_hours), price),
            "cook_seconds": seconds_between("cooking_start", "cooking_end"),
            **slot_prices(hour, price),
        }
    )
    counts = order_counts(type_counts, mode_counts)
    slots = slot_measures(hour)
    daily = served.groupBy("outlet_id", "order_date").agg(
        exact_sum("total_order_price").alias("sales"),
        F.count("order_id").alias("orders"),
        F.count("total_order_price").alias("priced"),
        F.sum("cook_seconds").alias("cook_seconds"),
        F.count("cook_seconds").alias("cooked"),
        exact_sum("peak_price").alias("peak_sales"),
        F.count_if("is_peak_hour").alias("peak_orders"),
        *named({**counts, **slots}),
    )
    measures = daily.groupBy("outlet_id").agg(
        exact_sum("sales").alias("total_sales"),
        F.sum("orders").alias("total_orders"),
        rounded_ratio("sales", "sum(priced)").alias("avg_order_value"),
        *[F.sum(n).alias(n) for n in counts],
        F.round(F.try_divide(F.sum("cook_seconds"), F.sum("cooked") * 60), 2).alias("avg_cooking_duration_mins"),
        rounded_mean("sales").alias("avg_daily_sales"),
        F.round(F.avg("orders"), 2).alias("avg_daily_order_count"),
        exact_sum("peak_sales").alias("peak_hour_sales"),
        F.nullif(F.sum("peak_orders"), F.lit(0)).alias("peak_hour_order_count"),
        *[(exact_sum(n) if n.endswith("_sales") else F.sum(n)).alias(n) for n in slots],
    )
    measures = measures.withColumns(percentages()).select(
        "outlet_id", "total_sales", "total_orders", "avg_order_value", *counts, "avg_cooking_duration_mins",
        *PERCENTAGES, "avg_daily_sales", "avg_daily_order_count", "peak_hour_sales", "peak_hour_order_count", *slots,
    )
    outlets = tables["dim_outlet"]
    own = [c for c in outlets.columns if c != "outlet_id"]
    wide = outlets.join(measures, "outlet_id", "left").select("outlet_id", *own, *measures.columns[1:])
    return stamp(wide, loaded_at)
