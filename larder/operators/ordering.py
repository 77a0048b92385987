"""Places in an order of rows, as conditions on literals that every pass over the rows sees alike.

Where a plan needs the rows cut along their order, range partitioning would draw new bounds each time it runs. Here a
bounded sample of the order columns gives the bounds once, and they go into the plan as literals. Any bounds give right
results; evenly drawn ones give even parts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled rows for each bound; the driver holds this many times the number of bounds.
SAMPLED = 32


@dataclass(frozen=True)
class SortKey:
    """A column of an order; its direction and the place of nulls as Spark has them."""

    name: str
    descending: bool = False
    nulls_first: bool = True

    @property
    def column(self) -> Column:
        found = F.col(self.name)
        if self.descending:
            return found.desc_nulls_first() if self.nulls_first else found.desc_nulls_last()
        return found.asc_nulls_first() if self.nulls_first else found.asc_nulls_last()


def sort_keys(order: Sequence[Column | str | SortKey]) -> list[SortKey]:
    """Names, and columns such as ``F.desc("x")`` or ``F.asc_nulls_last("x")``, as keys."""

    def key(entry) -> SortKey:
        if isinstance(entry, SortKey):
            return entry
        if isinstance(entry, str):
            return SortKey(entry)
        found = re.fullmatch(r"Column<'`?([^`()]+?)`?(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", str(entry))
        if not found:
            raise ValueError(f"an order takes columns by name, not {entry}")
        name, way, nulls = found.groups()
        return SortKey(name, way == "DESC", nulls != "LAST")

    return [key(e) for e in order]


def _literal(df: DataFrame, name: str, value) -> Column:
    kind = df.schema[name].dataType
    if kind.typeName() == "timestamp_ntz" and value is not None:
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def before(df: DataFrame, keys: Sequence[SortKey], bound: Sequence) -> Column:
    """Whether a row comes before ``bound``, one value for each of the leading keys."""
    out, same = F.lit(False), F.lit(True)
    for key, value in zip(keys, bound, strict=False):
        column, literal = F.col(key.name), _literal(df, key.name, value)
        if value is None:
            earlier = F.lit(False) if key.nulls_first else column.isNotNull()
        else:
            earlier = column > literal if key.descending else column < literal
            # Never null, in a form that a scan can evaluate.
            earlier = earlier | column.isNull() if key.nulls_first else earlier & column.isNotNull()
        out, same = out | (same & earlier), same & column.eqNullSafe(literal)
    return out


def bounds(df: DataFrame, keys: Sequence[SortKey], parts: int, rows: int | None = None) -> list[tuple]:
    """Up to ``parts - 1`` different bounds, in order, that cut the rows about evenly. ``rows`` saves counting them.

    A bound has values for the leading keys only, as many as tell it from the one before.
    """
    narrow = df.select(*[k.name for k in keys])
    rows = narrow.count() if rows is None else rows
    wanted = parts * SAMPLED
    drawn = narrow.sample(min(1.0, 1.2 * wanted / max(rows, 1)), seed=7) if rows > wanted else narrow
    found = [tuple(r) for r in drawn.orderBy(*[k.column for k in keys]).limit(4 * wanted).collect()]
    places = sorted({len(found) * i // parts for i in range(1, parts)} - {0}) if found else []
    cuts, last = [], found[0] if found else ()
    for full in (found[i] for i in places):
        # The shortest beginning that comes after the bound before: mostly one column, so that conditions stay short.
        differs = next((n for n in range(1, len(keys) + 1) if full[:n] != last[:n]), None)
        if differs:
            cuts.append(full[:differs])
            last = full
    return cuts


def part_of(df: DataFrame, keys: Sequence[SortKey], cuts: Sequence[tuple]) -> Column:
    """The number of bounds at or before a row, found by halving."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(before(df, keys, cuts[middle]), among(low, middle)).otherwise(among(middle + 1, high))

    return among(0, len(cuts))
