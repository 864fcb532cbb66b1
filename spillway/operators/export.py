"""Parquet export of a query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

COMPRESSIONS = {"snappy": "snappy", "zstd": "zstd", "gzip": "gzip", "uncompressed": "none"}


def export_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "snappy", overwrite_or_ignore: bool = False) -> None:
    """Writes df. partition_by takes plain scalar columns. With overwrite_or_ignore, partitions that df touches are replaced and others stay."""
    if compression.lower() not in COMPRESSIONS:
        raise ValueError(f"{compression} is none of {', '.join(COMPRESSIONS)}")
    if len(set(partition_by)) < len(partition_by):
        raise ValueError("a partition column is named twice")
    for c in partition_by:
        if c not in df.columns:
            raise ValueError(f"{c} is not a column of the query")
        if isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType, T.MapType)):
            raise ValueError(f"{c} is not a scalar column")
    writer = df.write.option("compression", COMPRESSIONS[compression.lower()])
    if overwrite_or_ignore:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partition_by else "static")
    else:
        writer = writer.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
