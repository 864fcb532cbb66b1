"""Structured Streaming into the engine's tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spillway.operators.writes import merge_into
from spillway.sources.snapshots import VersionedTable


def upsert_batches(table: VersionedTable, keys: Sequence[str], ordinal: str | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges each batch by key. A batch that was committed before (its number is in a snapshot's message) is not applied again: batches are committed in order, so the newest number tells."""

    def committed() -> int:
        return next((int(s.message.split()[1]) for s in table.backward() if s.message.startswith("batch ")), -1) if table.newest() else -1

    def apply(batch: DataFrame, number: int) -> None:
        if number <= committed():
            return
        if not table.newest():
            table.overwrite(batch.limit(0).drop(*[ordinal] if ordinal else []), "created")
        merge_into(table, batch, keys, ordinal, message=f"batch {number}")

    return apply


def stream_upsert(stream: DataFrame, table: VersionedTable, keys: Sequence[str], checkpoint: str, ordinal: str | None = None) -> StreamingQuery:
    return stream.writeStream.foreachBatch(upsert_batches(table, keys, ordinal)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, keys: Sequence[str], value: str, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per tumbling window; rows later than `late` behind the newest are dropped by the watermark. Works on batches too."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    out = timed.groupBy(F.window(ts, every), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n", "total")
