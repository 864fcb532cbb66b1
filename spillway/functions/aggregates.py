"""Aggregates with the engine's result types and its treatment of NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count(predicate: Column | None = None, wide: bool = True) -> Column:
    made = F.count(F.lit(1)) if predicate is None else F.count(F.when(predicate, 1))
    return made if wide else made.cast("int")


def total(x: Column, kind: str, predicate: Column | None = None, or_zero: bool = False) -> Column:
    """A sum in its selector's own type; floats are summed as doubles."""
    x = x.cast("double") if kind in ("float", "double") else x
    made = F.sum(x if predicate is None else F.when(predicate, x)).cast(kind)
    return F.coalesce(made, F.lit(0).cast(kind)) if or_zero else made


def average(x: Column, kind: str = "double", predicate: Column | None = None) -> Column:
    return F.avg((x if predicate is None else F.when(predicate, x)).cast("double")).cast(kind)


def stddev_sample(x: Column) -> Column:
    return F.stddev_samp(x.cast("double"))


def arg_max(value: Column, order: Column, predicate: Column | None = None) -> Column:
    """The value where order is largest; rows without a value are passed over."""
    ok = value.isNotNull() if predicate is None else value.isNotNull() & predicate
    return F.max_by(value, F.when(ok, order))


def arg_min(value: Column, order: Column, predicate: Column | None = None) -> Column:
    ok = value.isNotNull() if predicate is None else value.isNotNull() & predicate
    return F.min_by(value, F.when(ok, order))
