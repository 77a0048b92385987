"""One registry for all tables: schema, layer, keys, change column and cleaning rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from larder.functions.menu import LINE_SCHEMA
from larder.functions.rules import ORDER_TYPES, PAYMENT_MODES

# Accepted units of measure.
UNITS = ("kg", "g", "litre", "piece")


@dataclass(frozen=True)
class CleaningRules:
    """``anomalies`` maps a column to ``{"gt": x}`` or ``{"lt": x}``."""

    mandatory: tuple[str, ...] = ()
    casts: dict[str, str] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    unique_by: tuple[str, ...] = ()
    anomalies: dict[str, dict[str, float]] = field(default_factory=dict)


@dataclass(frozen=True)
class Table:
    """``day_column`` is the time by whose days the stored table is partitioned; without one it is kept as a whole."""

    name: str
    layer: str
    key: tuple[str, ...]
    schema: str | None = None
    rules: CleaningRules = CleaningRules()
    change_column: str | None = None
    incremental: bool = False
    seed_mode: str | None = None
    sources: tuple[str, ...] = ()
    publish_schema: str | None = None
    day_column: str | None = None


def _dimension(name: str, schema: str, **rules) -> Table:
    key = schema.split()[0]
    return Table(
        name=name,
        layer="raw",
        key=(key,),
        schema=schema,
        rules=CleaningRules(mandatory=(key,), unique_by=(key,), **rules),
        seed_mode="overwrite",
    )


def _product(name: str, key: tuple[str, ...], publish_schema: str, *sources: str, day_column: str | None = None) -> Table:
    return Table(
        name=name, layer="enrich", key=key, sources=sources, publish_schema=publish_schema, day_column=day_column
    )


# Parents first, so that a load in this order never leaves a dangling reference.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        _dimension("dim_outlet", "outlet_id string not null, outlet_name string"),
        _dimension("dim_customer", "customer_id string not null, customer_mobile string"),
        _dimension(
            "dim_item",
            "item_id string not null, item_name string, unit_price double",
            casts={"unit_price": "double"},
            anomalies={"unit_price": {"gt": 10000}},
        ),
        _dimension(
            "dim_stock_item",
            "stock_id string not null, stock_item string, unit_of_measure string",
            allowed={"unit_of_measure": UNITS},
        ),
        _dimension("dim_chef", "chef_id string not null, chef_name string, outlet_id string"),
        Table(
            name="fact_sales",
            layer="raw",
            key=("order_id",),
            schema=(
                "order_id string not null, outlet_id string, customer_id string, order_ts string,"
                f" order_menu_details {LINE_SCHEMA}, total_order_price double, payment_mode string,"
                " order_type string, high_value_flag boolean"
            ),
            rules=CleaningRules(
                mandatory=("order_id",),
                casts={"order_ts": "timestamp", "total_order_price": "double"},
                allowed={"payment_mode": PAYMENT_MODES, "order_type": ORDER_TYPES},
                unique_by=("order_id",),
                anomalies={"total_order_price": {"gt": 5000}},
            ),
            change_column="order_ts",
            incremental=True,
            seed_mode="append",
            day_column="order_ts",
        ),
        Table(
            name="fact_kitchen",
            layer="raw",
            key=("order_id",),
            schema=(
                "order_id string not null, outlet_id string, chef_id string,"
                " cooking_start string, cooking_end string"
            ),
            rules=CleaningRules(
                mandatory=("order_id",),
                casts={"cooking_start": "timestamp", "cooking_end": "timestamp"},
                unique_by=("order_id",),
            ),
            change_column="cooking_end",
            incremental=True,
            seed_mode="append",
            day_column="cooking_end",
        ),
        Table(
            name="fact_stock",
            layer="raw",
            key=("outlet_id", "stock_item", "stock_date"),
            schema=(
                "outlet_id string, stock_item string, available_quantity double,"
                " unit_of_measure string, stock_date string"
            ),
            rules=CleaningRules(
                mandatory=("outlet_id", "stock_item"),
                casts={"stock_date": "timestamp", "available_quantity": "double"},
                allowed={"unit_of_measure": UNITS},
                unique_by=("outlet_id", "stock_item", "stock_date"),
                anomalies={"available_quantity": {"gt": -1}},
            ),
            seed_mode="append",
        ),
        Table(name="fact_sales_items", layer="raw", key=(), sources=("fact_sales",), day_column="order_ts"),
        _product(
            "fact_sales_enriched", ("order_id",), "enrich",
            "fact_sales", "fact_sales_items", "dim_customer", "dim_outlet", "fact_kitchen",
        ),
        _product(
            "fact_kitchen_enriched", ("order_id",), "enrich", "fact_kitchen", "dim_chef", "dim_outlet",
            day_column="cooking_end",
        ),
        _product(
            "fact_stock_enriched", ("outlet_id", "stock_item", "stock_date_raw"), "enrich",
            "fact_stock", "dim_stock_item", "dim_outlet", day_column="stock_date_raw",
        ),
        _product("chef_performance", ("chef_id",), "people", "fact_kitchen", "dim_chef", "dim_outlet", "fact_sales"),
        _product("customer", ("customer_id",), "people", "fact_sales", "dim_customer", "fact_sales_items"),
        _product(
            "customer_preference", ("customer_id",), "people",
            "fact_sales", "fact_sales_items", "dim_customer", "dim_item", "dim_outlet",
        ),
        _product("outlet_performance", ("outlet_id",), "enrich", "fact_sales", "dim_outlet", "fact_kitchen"),
    )
}

DIMENSIONS = tuple(n for n in TABLES if n.startswith("dim_"))
SEEDED = tuple(n for n, t in TABLES.items() if t.seed_mode)
PUBLISHED = tuple(n for n, t in TABLES.items() if t.publish_schema)


def table(name: str) -> Table:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return TABLES[name]
