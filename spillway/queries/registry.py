"""The registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from spillway.sources import fs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_schemas: dict[tuple, StructType] = {}


class Tables:
    """t.orders is the table orders of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (path, *fs.stamp(self.spark, path))
        # Inferring a schema is a job of its own; a table that has not changed keeps the one it had.
        if key not in _schemas:
            _schemas[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[key]).parquet(path)


def query(sql: str | None = None) -> Callable:
    """Registers a function of Tables under its name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def select(name: str, table: str, key: str, exprs: dict[str, tuple[Callable[[], Column], str]], where: str | None = None) -> None:
    """Registers a projection: per output column, the expression and its SQL; key is carried along."""
    made = {n: _no_negative_zero(c, s) for n, (c, s) in exprs.items()}

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = getattr(Tables(spark, folder), table)
        return (df.filter(where) if where else df).select(key, *[c().alias(n) for n, (c, _) in made.items()])

    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, {', '.join(f'{s} AS {n}' for n, (_, s) in made.items())} FROM {table}" + (f" WHERE {where}" if where else "")


def _no_negative_zero(column: Callable[[], Column], sql: str) -> tuple[Callable[[], Column], str]:
    """Rounding a small negative number gives -0.0 in one engine and 0.0 in the other; adding zero makes both 0.0."""
    if sql.startswith(("round(", "trunc(", "ceil(", "floor(")):
        return lambda: column() + 0.0, f"({sql}) + 0.0"
    return column, sql
