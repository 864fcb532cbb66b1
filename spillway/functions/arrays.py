"""Array functions. Positions count from 0; outside the array is NULL; a NULL among the elements is no match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def distinct(a: Column) -> Column:
    """Different elements without NULL, sorted."""
    return F.sort_array(F.array_distinct(F.array_compact(a)))


def non_empty(a: Column) -> Column:
    return F.when(a.isNotNull(), F.size(a) > 0)


def contains(a: Column, x) -> Column:
    return F.when(a.isNotNull(), F.coalesce(F.array_contains(a, _c(x)), F.lit(False)))


def any_of(a: Column, test: Callable[[Column], Column]) -> Column:
    """Whether an element passes the test; one for which it is NULL does not."""
    return F.exists(a, lambda x: F.coalesce(test(x), F.lit(False)))


def element(a: Column, i) -> Column:
    return F.get(a, _c(i))


def skip(a: Column, n: int) -> Column:
    return F.slice(a, n + 1, F.greatest(F.size(a) - n, F.lit(0)))


def take(a: Column, n: int) -> Column:
    return F.slice(a, 1, n)


def skip_take(a: Column, n: int, m: int) -> Column:
    return F.slice(a, n + 1, m)


def count(a: Column) -> Column:
    return F.when(a.isNotNull(), F.size(a))


def total(a: Column) -> Column:
    """The sum of the elements; 0 for an empty array."""
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + F.coalesce(x.cast("double"), F.lit(0.0)))


def slice_fused(a: Column, *steps: tuple[str, int]) -> Column:
    """A chain of ("skip", n) and ("take", n) as one slice."""
    start, length = 0, None
    for kind, n in steps:
        if kind == "skip":
            start, length = start + n, None if length is None else max(0, length - n)
        else:
            length = n if length is None else min(length, n)
    return skip(a, start) if length is None else skip_take(a, start, length)
