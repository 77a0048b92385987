"""Products against plain-Python recomputation on a fixture with nulls, ties and a hot customer."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from larder.plans.facts import KITCHEN_COLUMNS, SALES_COLUMNS, STOCK_COLUMNS, sales_items
from larder.plans.people import CHEF_COLUMNS, PROFILE_COLUMNS
from larder.plans.registry import PRODUCTS, derive, product, sources_of
from tests.shop import LOADED, START, build, frames, lines_of

NOW = datetime(2025, 12, 1)


def half_up(value) -> float:
    return float(Decimal(value).quantize(Decimal("0.01"), ROUND_HALF_UP))


def money(values) -> float | None:
    values = [Decimal(repr(v)) for v in values if v is not None]
    return float(sum(values)) if values else None


def mean_money(values) -> float | None:
    values = [Decimal(repr(v)) for v in values if v is not None]
    return half_up(sum(values) / len(values)) if values else None


@pytest.fixture(scope="module")
def data():
    return build()


@pytest.fixture(scope="module")
def tables(spark, data):
    built = frames(spark, data)
    built["fact_sales_items"] = sales_items(built).cache()
    return {n: df.cache() for n, df in built.items()}


def by_key(df, key):
    found = {r[key]: r for r in df.collect()}
    assert len(found) == df.count()
    return found


def test_registry(spark):
    assert set(sources_of("customer")) == {"fact_sales", "dim_customer", "fact_sales_items"}
    assert len(PRODUCTS) == 8
    with pytest.raises(ValueError, match="no product"):
        product("margins")


def test_sales_items(tables, data):
    expected = Counter()
    for order in data["fact_sales"]:
        for x in lines_of(order):
            expected[(order["order_id"], x["item_id"], x["quantity"], x["line_total"], x["toppings"] and tuple(x["toppings"]) or None)] += 1
    got = Counter(
        (r.order_id, r.item_id, r.quantity, r.line_total, tuple(r.toppings) if r.toppings else None)
        for r in tables["fact_sales_items"].collect()
    )
    assert got == expected
    outer = sales_items(tables, keep_empty=True)
    assert outer.filter("item_id is null").count() == sum(not lines_of(o) for o in data["fact_sales"])


def test_sales_enriched(tables, data):
    stamp = F.lit(LOADED)
    df = derive("fact_sales_enriched", tables, loaded_at=stamp)
    assert df.columns == [*SALES_COLUMNS, "ingested_at"]
    got = by_key(df, "order_id")
    assert len(got) == len(data["fact_sales"])
    mobiles = {c["customer_id"]: c["customer_mobile"] for c in data["dim_customer"]}
    cooked = {k["order_id"]: k for k in data["fact_kitchen"]}
    own = defaultdict(list)
    for order in data["fact_sales"]:
        own[order["customer_id"]].append(order)
    for order in data["fact_sales"]:
        row, lines, buyer = got[order["order_id"]], lines_of(order), order["customer_id"]
        history = own[buyer] if buyer is not None else []
        last = max((o["order_ts"] for o in history if o["order_ts"]), default=None)
        total = sum(x["quantity"] for x in lines)
        topped = sum(1 for x in lines if x["toppings"])
        assert row.customer_mobile == mobiles.get(buyer)
        assert row.total_orders_by_customer == (len(history) or None)
        assert row.is_repeat_customer == (len(history) > 1)
        assert row.customer_lifetime_value == money(o["total_order_price"] for o in history)
        ordered = order["order_ts"]
        assert row.days_since_last_order == ((ordered.date() - last.date()).days if ordered and last else None)
        assert row.total_items == total and row.is_multi_item_order == (total > 1)
        assert row.distinct_items_count == len({x["item_id"] for x in lines})
        assert row.total_toppings_count == sum(len(x["toppings"] or []) for x in lines)
        assert row.max_item_price == max((x["unit_price"] for x in lines), default=None)
        assert row.items_with_customizations == (topped if lines else None)
        assert row.is_customized_order == (topped > 0 if lines else None)
        price = order["total_order_price"]
        assert row.avg_item_price == ((price / total if price is not None else None) if total else 0.0)
        assert row.is_digital_payment == (order["payment_mode"] != "Cash")
        assert row.is_weekend == (ordered is not None and ordered.weekday() >= 5)
        assert row.day_of_week == (ordered.strftime("%A") if ordered else "Saturday")
        kitchen = cooked.get(order["order_id"])
        if kitchen is None:
            assert (row.cook_duration_seconds, row.was_delayed_order) == (None, None)
        elif kitchen["cooking_start"] and kitchen["cooking_end"]:
            seconds = int((kitchen["cooking_end"] - kitchen["cooking_start"]).total_seconds())
            assert (row.cook_duration_seconds, row.was_delayed_order) == (seconds, seconds > 600)
        else:
            assert (row.cook_duration_seconds, row.was_delayed_order) == (None, False)
        assert row.ingested_at == LOADED


def test_sales_enriched_without_kitchen(tables):
    fewer = {n: df for n, df in tables.items() if n != "fact_kitchen"}
    row = derive("fact_sales_enriched", fewer).first()
    assert (row.cook_duration_seconds, row.was_delayed_order) == (None, False)


def test_several_kitchen_runs_of_an_order(spark, tables):
    runs = spark.createDataFrame(
        [("O0000", START, START + timedelta(seconds=s)) for s in (100, 601, 600)], "order_id string, cooking_start timestamp, cooking_end timestamp"
    )
    got = by_key(derive("fact_sales_enriched", {**tables, "fact_kitchen": runs}), "order_id")
    assert (got["O0000"].cook_duration_seconds, got["O0000"].was_delayed_order) == (601, True)


def test_kitchen_enriched(tables, data):
    df = derive("fact_kitchen_enriched", tables)
    assert df.columns == [*KITCHEN_COLUMNS, "ingested_at"]
    got = by_key(df, "order_id")
    assert len(got) == len(data["fact_kitchen"])
    names = {c["chef_id"]: c["chef_name"] for c in data["dim_chef"]}
    for k in data["fact_kitchen"]:
        row, start, end = got[k["order_id"]], k["cooking_start"], k["cooking_end"]
        assert row.chef_name == names.get(k["chef_id"])
        assert row.outlet_name == (f"Outlet {k['outlet_id']}" if k["outlet_id"] else None)
        assert row.was_delayed_order == bool(start and end and (end - start).total_seconds() > 600)
        assert row.day_of_week_num == (start.isoweekday() % 7 + 1 if start else None)
        assert row.week == (start.isocalendar().week if start else None)


def test_stock_enriched(tables):
    df = derive("fact_stock_enriched", tables)
    assert df.columns == [*STOCK_COLUMNS, "ingested_at"]
    got = sorted(
        (r.stock_item, r.unit_of_measure, r.available_quantity, r.inventory_status, r.needs_restock) for r in df.collect() if r.unit_of_measure
    )
    assert got == [
        ("oil", "litre", 100.0, "high", False),
        ("oil", "piece", 100.0, "high", False),
        ("salt", "g", 0.0, "low", True),
        ("salt", "kg", 10.0, "low", True),
    ]
    rice = df.filter("stock_item = 'rice'").first()
    assert (rice.unit_of_measure, rice.inventory_status) == (None, "medium")
    assert (rice.stock_date, rice.stock_date_raw) == (START.date(), START)


def test_customer_profile(tables, data):
    df = derive("customer", tables, as_of=F.lit(NOW))
    assert df.columns == [*PROFILE_COLUMNS, "ingested_at"]
    got = by_key(df, "customer_id")
    known = {c["customer_id"] for c in data["dim_customer"]}
    groups = defaultdict(list)
    for order in data["fact_sales"]:
        groups[order["customer_id"] if order["customer_id"] in known else None].append(order)
    assert set(got) == set(groups) and None in got and "C99" not in got
    for key, orders in groups.items():
        row = got[key]
        prices = [o["total_order_price"] for o in orders]
        items = [sum(x["quantity"] for x in lines_of(o)) for o in orders if lines_of(o)]
        times = [o["order_ts"] for o in orders if o["order_ts"]]
        assert row.total_orders == len(orders)
        assert row.total_spent == money(prices)
        assert row.average_order_value == mean_money(prices)
        assert (row.first_order_date, row.last_order_date) == (min(times), max(times))
        assert row.days_as_customer == (max(times).date() - min(times).date()).days
        assert row.days_since_last_order == (NOW.date() - max(times).date()).days
        assert row.total_items_ordered == (sum(items) if items else None)
        assert row.items_per_order == half_up(Decimal(sum(items)) / len(orders))
        assert row.is_repeat_customer == (len(orders) > 1) and row.is_active_customer


def test_activity_ends_after_ninety_days(spark, tables):
    last = datetime(2025, 1, 1, 12)
    sales = spark.createDataFrame([("O1", "C01", last, 10.0)], "order_id string, customer_id string, order_ts timestamp, total_order_price double")
    for days, active in ((90, True), (91, False)):
        as_of = F.lit(last + timedelta(days=days))
        row = derive("customer", {**tables, "fact_sales": sales}, as_of=as_of).first()
        assert (row.days_since_last_order, row.is_active_customer) == (days, active)


def winner(counter: Counter):
    return min(counter, key=lambda v: (-counter[v], (v is not None, v)))


def test_customer_preference(tables, data):
    df = derive("customer_preference", tables, loaded_at=F.lit(NOW))
    assert df.columns[:4] == ["customer_id", "customer_mobile", "ingested_at", "item_id"]
    got = by_key(df, "customer_id")
    assert set(got) == {c["customer_id"] for c in data["dim_customer"]}
    dishes = {i["item_id"]: i["item_name"] for i in data["dim_item"]}
    for key, row in got.items():
        orders = [o for o in data["fact_sales"] if o["customer_id"] == key]
        assert row.ingested_at == NOW
        if not orders:
            assert key == "C99" and row.preferred_payment_mode is None and row.weekend_order_ratio is None
            continue
        outlets = Counter(o["outlet_id"] for o in orders)
        modes = Counter(o["payment_mode"] for o in orders)
        assert row.outlet_id == winner(outlets) and row.orders_at_outlet == max(outlets.values())
        assert row.favorite_outlet_name == f"Outlet {row.outlet_id}"
        assert row.preferred_payment_mode == winner(modes) and row.orders_by_payment_method == max(modes.values())
        assert row.preferred_order_type == winner(Counter(o["order_type"] for o in orders))
        assert row.favorite_order_day == winner(Counter(o["order_ts"] and o["order_ts"].strftime("%a") for o in orders))
        assert row.favorite_order_hour == winner(Counter(o["order_ts"] and o["order_ts"].hour for o in orders))
        weekend = sum(o["order_ts"] is not None and o["order_ts"].weekday() >= 5 for o in orders)
        assert row.weekend_order_ratio == half_up(Decimal(weekend) / len(orders))
        totals = defaultdict(lambda: [0, 0.0, 0])
        for x in (x for o in orders for x in lines_of(o)):
            for i, part in enumerate((x["quantity"], x["line_total"], len(x["toppings"] or []))):
                totals[x["item_id"]][i] += part
        best = min(totals, key=lambda i: (*[-v for v in totals[i]], i)) if totals else None
        assert (row.item_id, row.favorite_item_name) == (best, dishes.get(best))


def test_chef_performance(tables, data):
    df = derive("chef_performance", tables)
    assert df.columns == CHEF_COLUMNS
    got = by_key(df, "chef_id")
    runs = defaultdict(list)
    for k in data["fact_kitchen"]:
        if k["chef_id"]:
            runs[k["chef_id"]].append(k)
    prices = {o["order_id"]: o["total_order_price"] for o in data["fact_sales"]}
    home = {c["chef_id"]: c["outlet_id"] for c in data["dim_chef"]}
    assert set(got) == set(runs) and "CH5" not in home
    for chef, cooked in runs.items():
        row = got[chef]
        starts = [k["cooking_start"] for k in cooked if k["cooking_start"]]
        seconds = [
            int((k["cooking_end"] - k["cooking_start"]).total_seconds()) for k in cooked if k["cooking_start"] and k["cooking_end"]
        ]
        assert row.outlet_id == home.get(chef)
        assert row.total_orders_cooked == len(cooked)
        assert row.avg_orders_per_day == len(cooked) / len({s.date() for s in starts})
        assert (row.min_cooking_time_sec, row.max_cooking_time_sec) == (min(seconds), max(seconds))
        assert row.avg_cooking_time_sec == pytest.approx(sum(seconds) / len(seconds))
        assert row.peak_hour_orders == sum(s.hour in (12, 13, 19, 20, 21) for s in starts)
        assert row.total_sales_value_cooked_by_chef == money(prices[k["order_id"]] for k in cooked)


def test_outlet_performance(tables, data):
    df = derive("outlet_performance", tables, loaded_at=F.lit(NOW))
    assert df.columns[:4] == ["outlet_id", "outlet_name", "ingested_at", "total_sales"]
    got = by_key(df, "outlet_id")
    assert set(got) == {o["outlet_id"] for o in data["dim_outlet"]}
    cooked = {k["order_id"]: k for k in data["fact_kitchen"]}
    slots = {"morning": (8, 12), "afternoon": (12, 16), "evening": (16, 20), "night": (20, 24)}
    for key, row in got.items():
        orders = [o for o in data["fact_sales"] if cooked.get(o["order_id"], {}).get("outlet_id") == key]
        assert row.ingested_at == NOW
        if not orders:
            assert row.total_orders is None and row.peak_hour_order_count is None and row.morning_orders is None
            continue
        prices = [o["total_order_price"] for o in orders]
        assert (row.total_orders, row.total_sales) == (len(orders), money(prices))
        assert row.avg_order_value == mean_money(prices)
        assert row.high_value_orders == sum(bool(o["high_value_flag"]) for o in orders)
        assert row.anomalous_orders == sum(o["total_order_price_anomaly_flag"] for o in orders)
        assert row.upi_payments == sum(o["payment_mode"] == "UPI" for o in orders)
        assert row.takeaway_orders == sum(o["order_type"] == "Takeaway" for o in orders)
        assert row.upi_payment_pct == pytest.approx(row.upi_payments / len(orders) * 100, abs=0.00501)
        days = defaultdict(list)
        for o in orders:
            days[o["order_ts"] and o["order_ts"].date()].append(o["total_order_price"])
        assert row.avg_daily_sales == mean_money(money(p) for p in days.values())
        assert row.avg_daily_order_count == half_up(Decimal(len(orders)) / len(days))
        peak = [o["total_order_price"] for o in orders if o["order_ts"] and o["order_ts"].hour in (12, 13, 19, 20, 21)]
        assert (row.peak_hour_order_count, row.peak_hour_sales) == (len(peak) or None, money(peak))
        for slot, (a, b) in slots.items():
            inside = [o["total_order_price"] for o in orders if o["order_ts"] and a <= o["order_ts"].hour < b]
            assert row[f"{slot}_orders"] == len(inside)
            assert row[f"{slot}_sales"] == (money(inside) or 0.0)


def test_outlet_without_peak_orders(spark, tables):
    quiet = tables["fact_sales"].withColumn("order_ts", F.lit(datetime(2025, 11, 10, 9)))
    row = derive("outlet_performance", {**tables, "fact_sales": quiet}).filter("outlet_id = 'OUT1'").first()
    assert (row.peak_hour_sales, row.peak_hour_order_count, row.night_orders, row.night_sales) == (None, None, 0, 0.0)
