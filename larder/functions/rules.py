"""Business rules as column expressions. Thresholds are parameters with the house defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rule thresholds and sets.
WEEKEND_DAYS = (1, 7)
ORDER_PEAK_HOURS = (12, 13, 19, 20)
SERVICE_PEAK_HOURS = (12, 13, 19, 20, 21)
DIGITAL_MODES = ("UPI", "Card", "Wallet")
PAYMENT_MODES = ("Cash", "UPI", "Card", "Wallet")
ORDER_TYPES = ("Dine-In", "Takeaway", "Delivery")
COOK_SLA_SECONDS = 600
HIGH_VALUE_ORDER = 500
HIGH_VALUE_SOURCE = 1000
VALUE_BANDS = {"Low": 200, "Medium": 500}
STOCK_LOW, STOCK_HIGH = 10.0, 100.0
ACTIVE_DAYS = 90
HIGH_VALUE_SPEND = 5000
SPEND_SEGMENTS = {"Gold": 10000, "Silver": 3000, "Bronze": 500}
FREQUENCY_BANDS = {"High": 50, "Medium": 10, "Low": 1}
DAY_SLOTS = {"morning": (8, 12), "afternoon": (12, 16), "evening": (16, 20), "night": (20, 24)}


def is_true(condition: Column) -> Column:
    """A flag that is false, not null, when the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def is_weekend(ts: Column | str) -> Column:
    return is_true(F.dayofweek(ts).isin(*WEEKEND_DAYS))


def is_peak(hour: Column, hours: Sequence[int] = ORDER_PEAK_HOURS) -> Column:
    return is_true(hour.isin(*hours))


def is_delayed(seconds: Column, sla_seconds: int = COOK_SLA_SECONDS) -> Column:
    return is_true(seconds > sla_seconds)


def is_high_value(price: Column, threshold: float = HIGH_VALUE_ORDER) -> Column:
    return is_true(price > threshold)


def is_digital(mode: Column, modes: Sequence[str] = DIGITAL_MODES) -> Column:
    return is_true(mode.isin(*modes))


def value_band(price: Column, low: float = VALUE_BANDS["Low"], medium: float = VALUE_BANDS["Medium"]) -> Column:
    """Low below the first bound, Medium below the second, else High; unknown prices are High."""
    return F.when(price < low, "Low").when(price < medium, "Medium").otherwise("High")


def average_item_price(price: Column, items: Column) -> Column:
    return F.when(items > 0, price / items).otherwise(F.lit(0.0))


def inventory_status(quantity: Column, low: float = STOCK_LOW, high: float = STOCK_HIGH) -> Column:
    return F.when(quantity <= low, "low").when(quantity >= high, "high").otherwise("medium")


def needs_restock(quantity: Column, low: float = STOCK_LOW) -> Column:
    return is_true(quantity <= low)


def _first_reached(value: Column, bands: dict[str, float], fallback: str) -> Column:
    name_of = F
    for name, bound in bands.items():
        name_of = name_of.when(value >= bound, name)
    return name_of.otherwise(fallback)


def customer_segment(spent: Column, bands: dict[str, float] = SPEND_SEGMENTS) -> Column:
    return _first_reached(spent, bands, "New")


def frequency_band(orders: Column, bands: dict[str, float] = FREQUENCY_BANDS) -> Column:
    return _first_reached(orders, bands, "None")


def in_slot(hour: Column, slot: str) -> Column:
    start, end = DAY_SLOTS[slot]
    return (hour >= start) & (hour < end)


def percentage(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part, total) * 100, digits)
