"""Joins by order: the latest earlier row, and ranges, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, right_at: str, columns: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """Each left row with the columns (and right_at) of the last right row of its key at or before it; NULLs if there is none.

    Both sides meet in one ordered window per key. bucket is a function of the order, given as a column named __at: with it,
    a key's rows are dealt to its buckets, each finds its last right row there, and rows before a bucket's first one take
    the last of an earlier bucket, so a key with a third of all rows is many tasks. Of right rows at one time the one
    with the greatest columns counts."""
    told = F.struct(F.col(right_at), *[F.col(c) for c in columns])
    mine = left.select(*[F.col(k).alias(f"__by{i}") for i, k in enumerate(by)], F.col(at).alias("__at"), F.lit(1).alias("__side"), F.struct(*[F.col(c) for c in left.columns]).alias("__left"), F.lit(None).cast(right.select(told.alias("x")).schema["x"].dataType).alias("__right"))
    theirs = right.select(*[F.col(k).alias(f"__by{i}") for i, k in enumerate(by)], F.col(right_at).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(mine.schema["__left"].dataType).alias("__left"), told.alias("__right"))
    keys = [f"__by{i}" for i in range(len(by))]
    both = mine.unionByName(theirs).withColumn("__bucket", F.lit(0) if bucket is None else bucket)
    inner = Window.partitionBy(*keys, "__bucket").orderBy("__at", "__side", "__right").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("__found", F.last("__right", ignorenulls=True).over(inner)).filter("__side = 1")
    if bucket is not None:
        # One row per key and bucket: the last right row of all earlier buckets.
        tops = both.groupBy(*keys, "__bucket").agg(F.max("__right").alias("__top"))
        earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = tops.withColumn("__carried", F.last("__top", ignorenulls=True).over(earlier)).select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("__bucket").alias("__bucket_"), "__carried")
        on = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys] + [F.col("__bucket") == F.col("__bucket_")]
        seen = seen.join(carried, on, "left").withColumn("__found", F.coalesce("__found", "__carried"))
    known = [F.col(k).isNotNull() for k in keys]
    found = F.col("__found") if not known else F.when(_all(known), F.col("__found"))
    return seen.withColumn("__found", found).select("__left.*", *[F.col(f"__found.{c}").alias(c) for c in (right_at, *columns)])


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def range_join(points: DataFrame, ranges: DataFrame, at: Column, low: Column, high: Column, width: float, on: Sequence[tuple[str, str]] = (), how: str = "inner") -> DataFrame:
    """Rows of points with all ranges that hold them, low <= at < high, over numbers.

    Ranges are copied to the bins of the given width that they reach into and meet the points of their bin only; width
    should be about the usual length of a range. Column names of the two sides must differ."""
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    p = points.withColumn("__bin", F.floor(at / width).cast("long"))
    last = F.greatest(F.ceil(high / width).cast("long") - 1, F.floor(low / width).cast("long"))
    r = ranges.filter(low < high).withColumn("__range_bin", F.explode(F.sequence(F.floor(low / width).cast("long"), last)))
    cond = (F.col("__bin") == F.col("__range_bin")) & (at >= low) & (at < high)
    for a, b in on:
        cond = cond & (F.col(a) == F.col(b))
    return p.join(r, cond, how).drop("__bin", "__range_bin")
