"""Sums and means of double columns that do not depend on row order and lose no digit.

Floating-point addition depends on the order in which partial sums meet, so a retried task or
another partition count changes the last digits of a plain ``sum(double)``, and with them rounded
means and threshold flags. Here every value is split into integer limbs of its decimal digits: three above
the point in steps of a million, millionths, and millionths of millionths. Each limb is under a million
and a limb's sum is a 64-bit integer, so it cannot overflow below nine million million rows. What lies
beyond the limbs on either side is added as doubles, and with it NaN and infinities.

A remainder under a few units of the value's own last binary digit is not a digit of it, only how a
decimal such as 0.1 is held in binary; it is left out, so that amounts in cents add up to cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOISE = "1.8e-15D"  # 2^-49, relative to the value


class _Limbs:
    """SQL of the limbs of one column; every limb is 0 for ordinary values it does not concern."""

    def __init__(self, name: str):
        self.value = "CAST(`" + name.replace("`", "``") + "` AS DOUBLE)"
        # Beyond 1e18, NaN and infinities: the top is the value itself or its multiple of 1e18.
        self.top = f"CASE WHEN abs({self.value}) < 1e18D THEN 0D ELSE {self.value} END"
        self.body = f"CASE WHEN abs({self.value}) < 1e18D THEN {self.value} WHEN {self.value} IS NOT NULL THEN 0D END"
        whole = f"CAST({self.body} AS BIGINT)"
        self.high = f"{whole} DIV 1000000000000"
        self.middle = f"({whole} DIV 1000000) % 1000000"
        self.low = f"{whole} % 1000000"
        self.millionths = f"CAST(rint(({self.body} - {whole}) * 1e6D) AS BIGINT)"
        left = f"({self.body} - {whole} - {self.millionths} * 1e-6D)"
        digits = f"CASE WHEN abs({left}) > abs({self.body}) * {NOISE} THEN {left} ELSE 0D END"
        self.fine = f"CAST(rint({digits} * 1e12D) AS BIGINT)"
        self.rest = f"({digits} - {self.fine} * 1e-12D)"


def _decimal_total(name: str) -> str:
    """The limbs together, up to 26 digits above the point."""
    x = _Limbs(name)
    sums = [f"CAST(sum({limb}) AS DECIMAL(38,12))" for limb in (x.low, x.millionths, x.fine)]
    middle = f"CAST(CAST(sum({x.middle}) AS DECIMAL(20,0)) * 1000000BD AS DECIMAL(38,12))"
    return f"({middle} + {sums[0]} + CAST({sums[1]} * 0.000001BD AS DECIMAL(38,12)) + CAST({sums[2]} * 0.000000000001BD AS DECIMAL(38,12)))"


def _beyond(name: str) -> str:
    x = _Limbs(name)
    return f"(sum({x.top} + {x.rest}) + sum({x.high}) * 1e12D)"


def _total(name: str) -> str:
    return f"(CAST({_decimal_total(name)} AS DOUBLE) + {_beyond(name)})"


def exact_sum(name: str) -> Column:
    """Aggregate: order-independent sum of a numeric column, as double (null for no values)."""
    return F.expr(_total(name))


def rounded_ratio(name: str, count: str, digits: int = 2) -> Column:
    """Aggregate: ``round(sum(name) / count, digits)``, half up, for an aggregate ``count`` in SQL.

    Null when the count is zero. The division is decimal where the limbs hold the whole sum.
    """
    exact = f"CAST(round(CAST({_decimal_total(name)} AS DECIMAL(32,6)) / nullif({count}, 0), {digits}) AS DOUBLE)"
    inexact = f"round({_total(name)} / nullif({count}, 0), {digits})"
    x = _Limbs(name)
    whole = f"sum({x.top}) = 0D AND sum({x.high}) = 0 AND sum({x.fine}) = 0"
    return F.expr(f"CASE WHEN {whole} THEN {exact} ELSE {inexact} END")


def rounded_mean(name: str, digits: int = 2) -> Column:
    """Aggregate: ``round(avg(name), digits)`` free of summation noise."""
    return rounded_ratio(name, f"count(`{name}`)", digits)
