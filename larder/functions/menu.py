"""The nested order-line column: JSON text in the raw layer, array of structs in between."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields of one order line inside ``order_menu_details``.
LINE_SCHEMA = (
    "array<struct<item_id:string, item_name:string, quantity:int,"
    " toppings:array<string>, unit_price:double, line_total:double>>"
)


def parse_lines(text: Column | str) -> Column:
    """JSON text to lines; malformed text gives null, absent fields are null."""
    return F.from_json(text, LINE_SCHEMA)


def lines_to_json(lines: Column | str) -> Column:
    return F.to_json(lines)


def array_length(values: Column | str) -> Column:
    """Array size where a missing array counts as empty."""
    return F.coalesce(F.size(values), F.lit(0))
