"""File sources: Parquet, CSV, JSON, partitioned folders, exact file lists, inline rows and named table functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.sources import fs

_functions: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def located(spark: SparkSession, path: str) -> str:
    """A relative path below the session's search path, if one is set."""
    base = spark.conf.get("spark.spillway.search.path", None)
    return f"{base.rstrip('/')}/{path}" if base and not re.match(r"[a-z0-9]+:|/", path) else path


def scan_parquet(spark: SparkSession, path: str, *more: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One or more Parquet paths; several are read exactly as listed, without a listing of folders."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*[located(spark, p) for p in (path, *more)])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).csv(located(spark, path), header=header, sep=sep, enforceSchema=False, quote='"', escape='"')


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A file that is one JSON array, or one object a line; told apart by the first character."""
    path = located(spark, path)
    first = spark.read.text(path).filter("trim(value) <> ''").limit(1).collect()
    return spark.read.schema(schema).json(path, multiLine=bool(first) and first[0][0].lstrip().startswith("["))


def scan_hive(spark: SparkSession, base: str, partitions: dict[str, str] | None = None) -> DataFrame:
    """A folder partitioned as name=value, columns matched by name over all files. Partition columns get the given types instead of guessed ones."""
    base = located(spark, base)
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        df = spark.read.option("basePath", base).option("mergeSchema", True).parquet(base)
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", before)
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in (partitions or {}).items()})


def values(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def is_any_of(x: Column, choices: Sequence[Any]) -> Column:
    """Membership in a parameter collection, with two-valued logic: NULL matches a NULL among the choices and nothing else."""
    plain = [c for c in choices if c is not None]
    hit = F.coalesce(x.isin(plain), F.lit(False)) if plain else F.lit(False)
    return hit | x.isNull() if len(plain) < len(choices) else hit


def register_table_function(name: str, make: Callable[[SparkSession, str], DataFrame]) -> None:
    """Names a source of one path argument; the name may have one schema in front."""
    if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?", name):
        raise ValueError(f"{name!r} is not a function name with at most one schema")
    _functions[name.lower()] = make


def scan_function(spark: SparkSession, name: str, path: str) -> DataFrame:
    if name.lower() not in _functions:
        raise LookupError(f"no table function is called {name}")
    return _functions[name.lower()](spark, located(spark, path))


for _name, _make in {"read_parquet": scan_parquet, "parquet_scan": scan_parquet}.items():
    register_table_function(_name, _make)
register_table_function("file_names", lambda spark, path: spark.createDataFrame([(f,) for f in fs.list_files(spark, path)], "file string"))
