"""Small retail fixture in the raw-layer schemas, and readers of it in plain Python."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

SCHEMAS = {
    "dim_customer": "customer_id string, customer_mobile string, ingested_at timestamp",
    "dim_item": "item_id string, item_name string, unit_price double, ingested_at timestamp",
    "dim_outlet": "outlet_id string, outlet_name string, ingested_at timestamp",
    "dim_chef": "chef_id string, chef_name string, outlet_id string, ingested_at timestamp",
    "dim_stock_item": "stock_id string, stock_item string, unit_of_measure string, ingested_at timestamp",
    "fact_sales": (
        "order_id string, outlet_id string, customer_id string, order_ts timestamp, order_menu_details string,"
        " total_order_price double, payment_mode string, order_type string, high_value_flag boolean,"
        " ingested_at timestamp, total_order_price_anomaly_flag boolean"
    ),
    "fact_kitchen": (
        "order_id string, outlet_id string, chef_id string, cooking_start timestamp, cooking_end timestamp,"
        " ingested_at timestamp"
    ),
    "fact_stock": (
        "outlet_id string, stock_item string, available_quantity double, unit_of_measure string,"
        " stock_date timestamp, ingested_at timestamp"
    ),
}
LOADED = datetime(2025, 11, 20)
START = datetime(2025, 11, 10)


def build(seed: int = 7, orders: int = 300) -> dict[str, list[dict]]:
    """Rows per table. A third of the sales has one customer, some have none or an unknown one."""
    pick = random.Random(seed)
    outlets = [f"OUT{i}" for i in range(1, 5)]
    buyers = [f"C{i:02d}" for i in range(1, 16)]
    products = {f"ITEM{i}": float(pick.randint(60, 250)) for i in range(1, 8)}
    chefs = [(f"CH{i}", outlets[i % 3]) for i in range(6)]
    data: dict[str, list[dict]] = {
        "dim_customer": [{"customer_id": b, "customer_mobile": f"+91{i:010d}"} for i, b in enumerate([*buyers, "C99"])],
        "dim_item": [{"item_id": k, "item_name": f"Dish {k}", "unit_price": v} for k, v in list(products.items())[:-1]],
        "dim_outlet": [{"outlet_id": o, "outlet_name": f"Outlet {o}"} for o in [*outlets, "OUT9"]],
        "dim_chef": [{"chef_id": c, "chef_name": f"Chef {c}", "outlet_id": o} for c, o in chefs[:-1]],
        "dim_stock_item": [
            {"stock_id": "S1", "stock_item": "salt", "unit_of_measure": "kg"},
            {"stock_id": "S2", "stock_item": "oil", "unit_of_measure": "litre"},
            {"stock_id": "S3", "stock_item": "oil", "unit_of_measure": "piece"},
        ],
        "fact_sales": [],
        "fact_kitchen": [],
        "fact_stock": [
            {"outlet_id": "OUT1", "stock_item": s, "available_quantity": q, "unit_of_measure": u, "stock_date": START}
            for s, q, u in [("salt", 10.0, None), ("salt", None, "g"), ("oil", 100.0, None), ("rice", 10.01, None)]
        ],
    }
    for n in range(orders):
        lines = []
        for _ in range(pick.choice([0, 1, 1, 2, 3, 5])):
            item, quantity = pick.choice(list(products)), pick.randint(1, 3)
            lines.append(
                {
                    "item_id": item, "item_name": f"Dish {item}", "quantity": quantity,
                    "toppings": pick.choice([None, [], ["a"], ["a", "b"]]), "unit_price": products[item],
                    "line_total": products[item] * quantity,
                }
            )
        price = pick.choice([float(sum(x["line_total"] for x in lines)), 199.99, 200.0, 500.0, 500.01, 5000.01, None])
        ordered = pick.choice([START + timedelta(minutes=pick.randint(0, 8 * 1440)), None] + [START] * 2)
        order = {
            "order_id": f"O{n:04d}",
            "outlet_id": pick.choice(outlets[:3]),
            "customer_id": pick.choice([*buyers, None, "GONE"] + ["C01"] * 8),
            "order_ts": ordered,
            "order_menu_details": pick.choice([json.dumps(lines)] * 9 + [None, "{bad"]),
            "total_order_price": price,
            "payment_mode": pick.choice(["Cash", "UPI", "Card", "Wallet"]),
            "order_type": pick.choice(["Dine-In", "Takeaway", "Delivery"]),
            "high_value_flag": pick.choice([True, False, None]),
            "total_order_price_anomaly_flag": price is not None and price > 5000,
        }
        data["fact_sales"].append(order)
        if pick.random() < 0.85:
            begin = (ordered or START) + timedelta(minutes=2)
            data["fact_kitchen"].append(
                {
                    "order_id": order["order_id"],
                    "outlet_id": pick.choice([*outlets[:3], None]),
                    "chef_id": pick.choice([c for c, _ in chefs] + [None]),
                    "cooking_start": pick.choice([begin] * 9 + [None]),
                    "cooking_end": pick.choice([begin + timedelta(seconds=s) for s in (300, 600, 601, 900)] + [None]),
                }
            )
    return data


def lines_of(order: dict) -> list[dict]:
    try:
        return json.loads(order["order_menu_details"] or "[]")
    except json.JSONDecodeError:
        return []


def frames(spark: SparkSession, data: dict[str, list[dict]]) -> dict:
    return {
        name: spark.createDataFrame([{"ingested_at": LOADED, **r} for r in data[name]], schema)
        for name, schema in SCHEMAS.items()
    }
