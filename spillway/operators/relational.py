"""Relational helpers whose defaults differ from Spark's: NULL order, two-valued equality, keyset paging, terminals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.functions import rowvalue


def _key(name: str, nulls_first: bool = False) -> Column:
    """A sort key from a name, with a minus in front for descending. NULLs come last unless nulls_first, which puts them first ascending and last descending."""
    if name.startswith("-"):
        return F.col(name[1:]).desc_nulls_last()
    return F.col(name).asc_nulls_first() if nulls_first else F.col(name).asc_nulls_last()


def order_by(df: DataFrame, *names: str, nulls_first: bool = False) -> DataFrame:
    return df.orderBy(*[_key(n, nulls_first) for n in names])


def reverse(names: Sequence[str]) -> list[str]:
    return [n[1:] if n.startswith("-") else "-" + n for n in names]


def page(df: DataFrame, names: Sequence[str], skip: int = 0, take: int | None = None) -> DataFrame:
    ordered = order_by(df, *names)
    ordered = ordered.offset(skip) if skip else ordered
    return ordered if take is None else ordered.limit(take)


def keyset_page(df: DataFrame, names: Sequence[str], after: Sequence | None, take: int) -> DataFrame:
    """The rows after a row value in the order of names: a filter and a top-k, whatever the page number."""
    if after is not None:
        df = df.filter(rowvalue.compare([F.col(n) for n in names], ">", list(after)))
    return order_by(df, *names).limit(take)


def top_per_group(df: DataFrame, group: Sequence[str], names: Sequence[str], n: int) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(*group).orderBy(*[_key(x) for x in names]))
    return df.withColumn("__at", at).filter(F.col("__at") <= n).drop("__at")


def differs(a: Column, b) -> Column:
    """Two-valued <>: NULL differs from every value and equals NULL."""
    return ~a.eqNullSafe(b)


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_anti")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """NOT IN by SQL's rules, planned as one null-aware anti join."""
    spark = df.sparkSession
    return spark.sql(f"SELECT * FROM {{df}} WHERE {column} NOT IN (SELECT {other_column} FROM {{other}})", df=df, other=other)


def include(df: DataFrame, children: DataFrame, parent_key: str, child_key: str, name: str, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """df with each row's children as a sorted array of structs; empty for none."""
    fields = [*order, *[c for c in columns if c not in order]]
    grouped = children.groupBy(F.col(child_key).alias("__key")).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
    empty = F.array().cast(grouped.schema[name].dataType)
    return df.join(grouped, df[parent_key] == F.col("__key"), "left").withColumn(name, F.coalesce(name, empty)).drop("__key")


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def single(df: DataFrame):
    """The only row; none or more than one is an error."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("the sequence has no element" if not rows else "the sequence has more than one element")
    return rows[0]


def first(df: DataFrame, default=None):
    rows = df.limit(1).collect()
    return rows[0] if rows else default


def last(df: DataFrame, names: Sequence[str], default=None):
    return first(order_by(df, *reverse(names)), default)


def element_at(df: DataFrame, names: Sequence[str], index: int):
    return first(page(df, names, index, 1))


def scalar_terminal(df: DataFrame, kind: str, column: str | None = None):
    """Count, Any, Sum, Average, Min or Max of a whole frame: Sum of nothing is 0, the others have no value and raise."""
    if kind == "count":
        return df.count()
    if kind == "any":
        return bool(df.limit(1).count())
    made = df.agg({"sum": F.sum, "average": F.avg, "min": F.min, "max": F.max}[kind](column).alias("v")).first()["v"]
    if made is None and kind != "sum":
        raise ValueError("the sequence has no element")
    return 0 if made is None else made


# -- models ------------------------------------------------------------------------------------------------------------
def per_concrete_type(**tables: DataFrame) -> DataFrame:
    """One table per concrete type: their rows by column name, with the type's name as discriminator."""
    return union_by_name(*[df.withColumn("discriminator", F.lit(name)) for name, df in tables.items()])


def per_type(base: DataFrame, key: str, **derived: DataFrame) -> DataFrame:
    """A base table and one of own columns per derived type, by key: rows of no derived type have the name base."""
    out, kind = base, F.lit("base")
    for name, df in derived.items():
        out = out.join(df.withColumn(f"__is_{name}", F.lit(True)).withColumnRenamed(key, f"__key_{name}"), F.col(key) == F.col(f"__key_{name}"), "left")
        kind = F.when(F.col(f"__is_{name}"), F.lit(name)).otherwise(kind)
    return out.withColumn("discriminator", kind).drop(*[f"__is_{n}" for n in derived], *[f"__key_{n}" for n in derived])


def of_type(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(F.col("discriminator").isin(*names))


class Filters:
    """Conditions that hold for every query of a table unless it is told to ignore them."""

    def __init__(self):
        self._by: dict[str, dict[str, Column]] = {}

    def add(self, table: str, name: str, condition: Column) -> None:
        self._by.setdefault(table, {})[name] = condition

    def apply(self, table: str, df: DataFrame, ignore: bool | Sequence[str] = ()) -> DataFrame:
        """df with the table's conditions, but for those to ignore (all of them: True). NULL is not true."""
        if ignore is True:
            return df
        for name, condition in self._by.get(table, {}).items():
            if name not in ignore:
                df = df.filter(condition)
        return df
