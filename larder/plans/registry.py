"""Product name to plan; inputs of each product are listed in ``larder.tables``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from larder.plans.facts import kitchen_enriched, sales_enriched, sales_items, stock_enriched
from larder.plans.outlets import outlet_performance
from larder.plans.people import chef_performance, customer_preference, customer_profile
from larder.tables import table

PRODUCTS: dict[str, Callable[..., DataFrame]] = {
    "fact_sales_items": sales_items,
    "fact_sales_enriched": sales_enriched,
    "fact_kitchen_enriched": kitchen_enriched,
    "fact_stock_enriched": stock_enriched,
    "customer": customer_profile,
    "customer_preference": customer_preference,
    "chef_performance": chef_performance,
    "outlet_performance": outlet_performance,
}


def product(name: str) -> Callable[..., DataFrame]:
    if name not in PRODUCTS:
        raise ValueError(f"no product named {name!r}")
    return PRODUCTS[name]


def sources_of(name: str) -> tuple[str, ...]:
    product(name)
    return table(name).sources


def derive(name: str, tables: dict[str, DataFrame], **options) -> DataFrame:
    """Build one product from its input tables."""
    return product(name)(tables, **options)
