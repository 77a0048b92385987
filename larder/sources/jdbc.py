"""Relational source and sink. Connection options come from the caller and are never stored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larder.streaming.incremental import change_window


@dataclass(frozen=True)
class Split:
    """Parallel read: ``parts`` range queries over a numeric, date or timestamp column."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class Ranges:
    """Parallel read: about even ranges of a column of any type, found by one query in the database."""

    column: str
    parts: int

    def bounds_query(self, table: str) -> str:
        """The least value of each part but the first; standard SQL with a window function."""
        dealt = f"SELECT {self.column} AS value, NTILE({self.parts}) OVER (ORDER BY {self.column}) AS part FROM {table}"
        present = f"{dealt} WHERE {self.column} IS NOT NULL"
        return f"SELECT part, MIN(value) AS low FROM ({present}) AS dealt WHERE part > 1 GROUP BY part"

    def conditions(self, bounds: Sequence) -> list[str]:
        """One condition for each range; together they hold for every row once, rows without a value in the first.

        The database compares by the order in which it found the bounds, so texts may have any collation.
        """
        marks = [literal(b) for b in dict.fromkeys(bounds)]
        column = self.column
        if not marks:
            return []
        middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(marks, marks[1:], strict=False)]
        return [f"{column} < {marks[0]} OR {column} IS NULL", *middle, f"{column} >= {marks[-1]}"]


def literal(value) -> str:
    """A value as SQL that databases read alike: numbers bare, all else as quoted text that they convert."""
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return "'" + str(value).replace("'", "''") + "'"


@dataclass(frozen=True)
class Window:
    """Rows with ``start < column <= end``; bounds are timestamp text, a missing one is open."""

    column: str
    start: str | None = None
    end: str | None = None

    def cut(self, df: DataFrame) -> DataFrame:
        """Plain comparisons, which Spark hands to the database in the database's own SQL.

        A column of times is compared as such. A text column, which must hold ISO times, is compared with whole days,
        as these sort alike whatever stands between date and time; the days at either end are fetched whole, and the
        caller cuts them.
        """
        if not isinstance(df.schema[self.column].dataType, StringType):
            bounds = [F.lit(b).cast("timestamp") if b else None for b in (self.start, self.end)]
            return change_window(df, self.column, *bounds)
        if self.start is not None:
            df = df.filter(F.col(self.column) >= F.lit(self.start[:10]))
        if self.end is not None:
            after = date.fromisoformat(self.end[:10]) + timedelta(days=1)
            df = df.filter(F.col(self.column) < F.lit(after.isoformat()))
        return df


# How a database writes the remainder of a division, by the beginning of its URL; else MOD(a, b).
REMAINDERS = {"jdbc:sqlserver:": "({0}) % {1}", "jdbc:jtds:": "({0}) % {1}"}


def remainder(url: str) -> str:
    return next((form for start, form in REMAINDERS.items() if url.startswith(start)), "MOD({0}, {1})")


def hash_buckets(expression: str, parts: int, form: str = "MOD({0}, {1})") -> list[str]:
    """Conditions that deal rows to ``parts`` reads by a non-negative whole number, say a hash the database offers.

    ``form`` is the database's remainder. Rows without the number are in the first part.
    """
    rest = form.format(expression, parts)
    return [f"{rest} = 0 OR {rest} IS NULL", *[f"{rest} = {i}" for i in range(1, parts)]]


@dataclass(frozen=True)
class Database:
    """``connection`` holds url, user, password, driver.

    ``splits`` tells for a table how to read it in parallel: ``Ranges``, which finds its bounds itself, a ``Split``
    with bounds, or a list of conditions in the database's SQL, one read each, which must cover every row once.
    """

    connection: Mapping[str, str] = field(repr=False)
    splits: Mapping[str, Split | Ranges | Sequence[str]] = field(default_factory=dict)

    def relation(self, table: str | None = None, query: str | None = None) -> str:
        """What to read; a query is a sub-select, so that the database evaluates it."""
        if not (table or query):
            raise ValueError("a JDBC read needs a table or a query")
        return f"({query}) AS tmp" if query else table

    def read_options(self, table: str | None = None, query: str | None = None) -> dict[str, str]:
        split = self.splits.get(table) if table and not query else None
        options = {**self.connection, "dbtable": self.relation(table, query)}
        return {**options, **split.options()} if isinstance(split, Split) else options

    def conditions(self, spark: SparkSession, table: str) -> list[str]:
        """The conditions of a table's parallel reads; none where it has no such split."""
        split = self.splits.get(table)
        if isinstance(split, Ranges):
            found = self.load(spark, query=split.bounds_query(table)).sort("part").collect()  # a row for each part
            return split.conditions([r["low"] for r in found])
        return [] if split is None or isinstance(split, Split) else list(split)

    def load(self, spark: SparkSession, table: str | None = None, query: str | None = None) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options(table, query)).load()

    def read(
        self, spark: SparkSession, table: str | None = None, query: str | None = None, window: Window | None = None
    ) -> DataFrame:
        parts = self.conditions(spark, table) if table and not query else []
        if parts:
            properties = {k: v for k, v in self.connection.items() if k != "url"}
            df = spark.read.jdbc(self.connection["url"], self.relation(table), predicates=parts, properties=properties)
        else:
            df = self.load(spark, table, query)
        return window.cut(df) if window else df

    def write_options(self, table: str, schema: str | None = None) -> dict[str, str]:
        return {**self.connection, "dbtable": f"{schema}.{table}" if schema else table}

    def write(self, df: DataFrame, table: str, mode: str, schema: str | None = None) -> None:
        """An overwrite empties the table instead of dropping it, so grants and column types survive."""
        options = self.write_options(table, schema)
        if mode == "overwrite":
            options["truncate"] = "true"
        df.write.format("jdbc").options(**options).mode(mode).save()
