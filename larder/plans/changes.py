"""Row-wise products by change: which rows follow from changed inputs, and what they are now.

A row-wise product has, for each key of its fact, rows that depend on that fact row and the dimension rows it refers
to, and on nothing else. So a change set travels through it: fact rows that changed, and fact rows that refer to a
changed dimension row, name the keys; the product of these rows alone takes the place of what the product held for them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.plans.registry import derive

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Lookup:
    """A dimension that the fact refers to by ``key``; ``name`` is the product's copy of its value, if it holds one as it is."""

    key: str
    name: str | None = None


@dataclass(frozen=True)
class RowWise:
    """``key`` identifies the fact rows; ``product_key`` has the same columns under the product's names."""

    fact: str
    key: tuple[str, ...]
    product_key: tuple[str, ...]
    dimensions: dict[str, Lookup] = field(default_factory=dict)


ROW_WISE = {
    "fact_sales_items": RowWise("fact_sales", ("order_id",), ("order_id",)),
    "fact_kitchen_enriched": RowWise(
        "fact_kitchen", ("order_id",), ("order_id",),
        {"dim_chef": Lookup("chef_id", "chef_name"), "dim_outlet": Lookup("outlet_id", "outlet_name")},
    ),
    "fact_stock_enriched": RowWise(
        "fact_stock", ("outlet_id", "stock_item", "stock_date"), ("outlet_id", "stock_item", "stock_date_raw"),
        {"dim_stock_item": Lookup("stock_item"), "dim_outlet": Lookup("outlet_id", "outlet_name")},
    ),
}


def row_wise(name: str) -> RowWise:
    if name not in ROW_WISE:
        raise ValueError(f"{name!r} is not a row-wise product")
    return ROW_WISE[name]


def _changed_references(lookup: Lookup, dimension: DataFrame, changed: DataFrame, product: DataFrame | None) -> DataFrame:
    """Dimension keys whose rows changed.

    A dimension is often loaded anew as a whole. Where the product holds its value, the keys are those for which
    that differs from the value now, a row that is gone included; else those of the changed rows.
    """
    key = lookup.key
    if lookup.name is None or product is None:
        return changed.select(key).dropna().distinct()
    held = product.select(key, F.col(lookup.name).alias("_held")).dropna(subset=[key]).distinct()
    now = dimension.select(F.col(key).alias("_key"), F.col(lookup.name).alias("_now"))
    both = held.join(now, F.col(key) == F.col("_key"), "left")
    return both.filter(~F.col("_held").eqNullSafe(F.col("_now"))).select(key).distinct()


def affected_keys(name: str, tables: Tables, changes: Tables, product: DataFrame | None = None) -> DataFrame:
    """Keys of the fact rows that the changes reach, each once, null values included.

    ``changes`` has the changed or removed rows of any of the product's inputs, ``tables`` all rows as they are now.
    The fact is read for its keys and references only.
    """
    spec = row_wise(name)
    fact = tables[spec.fact]
    keys = changes[spec.fact].select(*spec.key) if spec.fact in changes else fact.select(*spec.key).limit(0)
    for dimension, lookup in spec.dimensions.items():
        if dimension in changes:
            references = _changed_references(lookup, tables[dimension], changes[dimension], product)
            narrow = fact.select(*dict.fromkeys([*spec.key, lookup.key]))
            keys = keys.unionByName(narrow.join(references, lookup.key, "left_semi").select(*spec.key))
    return keys.distinct()


def product_keys(name: str, keys: DataFrame) -> DataFrame:
    """The keys under the product's column names."""
    spec = row_wise(name)
    return keys.select(*[F.col(k).alias(p) for k, p in zip(spec.key, spec.product_key, strict=True)])


def null_safe_join(rows: DataFrame, keys: DataFrame, columns, how: str) -> DataFrame:
    """Rows whose ``columns`` equal, null-safe, those of a row of ``keys`` (``left_semi``) or of none (``left_anti``).

    Rows whose columns are all present meet by plain equality, so that rows already placed by these columns are not
    shuffled again with all their other columns; only rows with a null among them meet by null-safe equality.
    """
    columns = list(columns)
    names = [f"_key_{i}" for i in range(len(columns))]
    present, found, equal, same = F.lit(True), F.lit(True), F.lit(True), F.lit(True)
    for k, n in zip(columns, names, strict=True):
        present, found = present & F.col(k).isNotNull(), found & F.col(n).isNotNull()
        equal, same = equal & (F.col(k) == F.col(n)), same & F.col(k).eqNullSafe(F.col(n))
    named = keys.select(*[F.col(k).alias(n) for k, n in zip(columns, names, strict=True)])
    whole = rows.filter(present).join(named.filter(found).hint("shuffle_hash"), equal, how)
    return whole.unionByName(rows.filter(~present).join(named.filter(~found), same, how))


def rows_of(name: str, tables: Tables, keys: DataFrame, **options) -> DataFrame:
    """The product's rows for these keys, as they are now; the fact is filtered before anything else is done."""
    spec = row_wise(name)
    fact = tables[spec.fact]
    return derive(name, {**tables, spec.fact: null_safe_join(fact, keys, spec.key, "left_semi")}, **options)


def refreshed(name: str, product: DataFrame, tables: Tables, changes: Tables, **options) -> DataFrame:
    """The product after the changes, from the product before them."""
    keys = affected_keys(name, tables, changes, product)
    gone = product_keys(name, keys)
    kept = null_safe_join(product, gone, gone.columns, "left_anti")
    return kept.unionByName(rows_of(name, tables, keys, **options))
