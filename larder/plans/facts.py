"""Fact products: exploded order lines, enriched sales, kitchen and stock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import rules
from larder.functions.menu import parse_lines
from larder.functions.times import calendar_parts, days_between, parse_timestamps, seconds_between
from larder.operators.clean import stamp
from larder.operators.joins import fill_defaults, join_back, keep_present, lookup
from larder.operators.rollups import cooking_per_order, items_per_order, orders_per_customer

Tables = dict[str, DataFrame]

# Output columns of the products, in order.
SALES_COLUMNS = (
    "order_id order_ts order_date order_hour order_week order_month order_year day_of_week is_weekend"
    " is_peak_hour customer_id customer_mobile is_repeat_customer total_orders_by_customer"
    " customer_lifetime_value days_since_last_order outlet_id outlet_name total_order_price total_items"
    " distinct_items_count avg_item_price max_item_price min_item_price total_toppings_count"
    " items_with_customizations is_customized_order payment_mode is_digital_payment order_type"
    " order_value_band is_multi_item_order is_high_value_order cook_duration_seconds was_delayed_order"
).split()
KITCHEN_COLUMNS = (
    "order_id outlet_id outlet_name chef_id chef_name cooking_start cooking_end cook_duration_seconds"
    " was_delayed_order date hour week month year day_of_week_num"
).split()
STOCK_COLUMNS = (
    "outlet_id outlet_name stock_item unit_of_measure available_quantity inventory_status needs_restock"
    " stock_date stock_date_raw stock_week stock_month stock_year day_of_week_num"
).split()


def sales_items(tables: Tables, loaded_at: Column | None = None, keep_empty: bool = False) -> DataFrame:
    """One row per order line. Orders without lines vanish unless ``keep_empty``."""
    explode = F.explode_outer if keep_empty else F.explode
    lines = tables["fact_sales"].select(
        "order_id", "order_ts", "outlet_id", "customer_id", explode(parse_lines("order_menu_details")).alias("line")
    )
    fields = ("item_id", "item_name", "quantity", "unit_price", "line_total", "toppings")
    flat = lines.select(
        "order_id", "order_ts", "outlet_id", "customer_id", *[F.col(f"line.{f}").alias(f) for f in fields]
    )
    return stamp(flat, loaded_at)


def sales_enriched(
    tables: Tables,
    loaded_at: Column | None = None,
    cook_sla_seconds: int = rules.COOK_SLA_SECONDS,
    peak_hours=rules.ORDER_PEAK_HOURS,
    digital_modes=rules.DIGITAL_MODES,
    high_value: float = rules.HIGH_VALUE_ORDER,
    value_bands: dict[str, float] = rules.VALUE_BANDS,
) -> DataFrame:
    """One wide row per sale.

    Shuffles of the sales rows: one on order_id, where the item and kitchen roll-ups already are,
    and one on the customer, where metrics and dimension travel as one narrow row per customer.
    """
    sales = parse_timestamps(tables["fact_sales"], "order_ts")
    rolled_items = items_per_order(tables["fact_sales_items"])
    wide = sales.join(rolled_items, "order_id", "left")

    kitchen = tables.get("fact_kitchen")
    if kitchen is None:
        wide = wide.withColumns(
            {"cook_duration_seconds": F.lit(None).cast("long"), "was_delayed_order": F.lit(False)}
        )
    else:
        kitchen = parse_timestamps(kitchen, "cooking_start", "cooking_end")
        wide = wide.join(cooking_per_order(kitchen, cook_sla_seconds), "order_id", "left")

    customers = lookup(
        orders_per_customer(sales.filter(F.col("customer_id").isNotNull())),
        tables["dim_customer"],
        "customer_id",
        "customer_mobile",
    )
    wide = join_back(wide, customers, "customer_id")
    wide = lookup(wide, tables["dim_outlet"], "outlet_id", "outlet_name")

    wide = fill_defaults(wide, {"total_items": 0, "distinct_items_count": 0, "total_toppings_count": 0})
    ts, price, items = F.col("order_ts"), F.col("total_order_price"), F.col("total_items")
    wide = wide.withColumns(
        {
            **calendar_parts(
                ts, date="order_date", hour="order_hour", week="order_week", month="order_month",
                year="order_year", weekday_name="day_of_week",
            ),
            "is_weekend": rules.is_weekend(ts),
            "is_peak_hour": rules.is_peak(F.hour(ts), peak_hours),
            "avg_item_price": rules.average_item_price(price, items),
            "is_multi_item_order": items > 1,
            "is_high_value_order": rules.is_high_value(price, high_value),
            "is_digital_payment": rules.is_digital(F.col("payment_mode"), digital_modes),
            "order_value_band": rules.value_band(price, value_bands["Low"], value_bands["Medium"]),
            "is_repeat_customer": rules.is_true(F.col("total_orders_by_customer") > 1),
            "days_since_last_order": days_between(F.col("last_order_ts"), ts),
        }
    )
    return stamp(keep_present(wide, SALES_COLUMNS), loaded_at)


def kitchen_enriched(
    tables: Tables, loaded_at: Column | None = None, sla_seconds: int = rules.COOK_SLA_SECONDS
) -> DataFrame:
    """One row per kitchen run with chef and outlet names."""
    kitchen = parse_timestamps(tables["fact_kitchen"], "cooking_start", "cooking_end")
    seconds = seconds_between("cooking_start", "cooking_end")
    wide = kitchen.withColumns(
        {
            "cook_duration_seconds": seconds,
            "was_delayed_order": rules.is_delayed(seconds, sla_seconds),
            **calendar_parts(
                "cooking_start", date="date", hour="hour", week="week", month="month", year="year",
                weekday="day_of_week_num",
            ),
        }
    )
    wide = lookup(wide, tables["dim_chef"], "chef_id", "chef_name")
    wide = lookup(wide, tables["dim_outlet"], "outlet_id", "outlet_name")
    return stamp(wide.select(*KITCHEN_COLUMNS), loaded_at)


def stock_enriched(
    tables: Tables,
    loaded_at: Column | None = None,
    low: float = rules.STOCK_LOW,
    high: float = rules.STOCK_HIGH,
) -> DataFrame:
    """One row per stock level and matching stock item; a missing quantity counts as none left."""
    stock = tables["fact_stock"].withColumns(
        {
            "stock_date_raw": F.col("stock_date"),
            "available_quantity": F.coalesce(F.col("available_quantity").try_cast("double"), F.lit(0.0)),
        }
    )
    stock = parse_timestamps(stock, "stock_date")
    units = tables["dim_stock_item"].select(
        F.col("stock_item").alias("_stock_item"), F.col("unit_of_measure").alias("_unit")
    )
    wide = stock.join(units, F.col("stock_item") == F.col("_stock_item"), "left")
    wide = lookup(wide, tables["dim_outlet"], "outlet_id", "outlet_name")
    quantity = F.col("available_quantity")
    wide = wide.withColumns(
        {
            "unit_of_measure": F.coalesce("unit_of_measure", "_unit"),
            "inventory_status": rules.inventory_status(quantity, low, high),
            "needs_restock": rules.needs_restock(quantity, low),
            **calendar_parts(
                "stock_date", date="stock_date", week="stock_week", month="stock_month", year="stock_year",
                weekday="day_of_week_num",
            ),
        }
    )
    return stamp(keep_present(wide, STOCK_COLUMNS), loaded_at)
