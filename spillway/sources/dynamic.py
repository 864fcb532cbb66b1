"""SQL of unknown shape: its columns and its rows, read once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession

from spillway.types import store_name


class DynamicResult:
    """The columns (name, store type, nullable) of a query and its rows, which can be gone through once and come in parts."""

    def __init__(self, df: DataFrame):
        self._df, self._used = df, False
        self.columns = [(f.name, store_name(f.dataType), f.nullable) for f in df.schema.fields]

    def rows(self) -> Iterator[Row]:
        if self._used:
            raise RuntimeError("a dynamic result can be read only once")
        self._used = True
        yield from self._df.toLocalIterator(prefetchPartitions=True)

    def frame(self) -> DataFrame:
        return self._df


def query(spark: SparkSession, sql: str, args: dict[str, Any] | list | None = None) -> DynamicResult:
    """Runs SQL with named (:name) or positional (?) parameters; parameters are values, never text."""
    return DynamicResult(spark.sql(sql, args=args or {}))


def raw_sql(spark: SparkSession, sql: str, args: dict[str, Any] | list | None = None, **frames: DataFrame) -> DataFrame:
    """SQL as a source that further operators can be put on; frames are named in the text as {name}."""
    return spark.sql(sql, args=args, **frames)
