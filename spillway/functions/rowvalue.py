"""Comparisons of row values, column by column from the left, with the engine's rules for NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pairs(left: list[Column], right: list) -> list[tuple[Column, Column]]:
    if len(left) != len(right):
        raise ValueError(f"row values of {len(left)} and {len(right)} columns cannot be compared")
    if not left:
        raise ValueError("row values need at least one column")
    return [(a, b if isinstance(b, Column) else F.lit(b)) for a, b in zip(left, right, strict=True)]


def equal(left: list[Column], right: list) -> Column:
    return reduce(lambda x, y: x & y, [a == b for a, b in _pairs(left, right)])


def not_equal(left: list[Column], right: list) -> Column:
    return ~equal(left, right)


def compare(left: list[Column], op: str, right: list) -> Column:
    """op is one of < <= > >=. The row is decided at its first difference; a NULL there makes the answer unknown."""
    strict = op[0]
    out = None
    for a, b in reversed(_pairs(left, right)):
        first = a < b if strict == "<" else a > b
        if out is None:
            last = {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]
            out = last
        else:
            out = first | ((a == b) & out)
    return out
