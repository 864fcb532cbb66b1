"""Set-based writes. Functions of DataFrames give a table's next state; those of a VersionedTable publish it as a new
snapshot and rewrite only the files that hold rows that change."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.operators.relational import duplicate_keys
from spillway.plans.command import lifecycle, log
from spillway.sources.snapshots import Snapshot, VersionedTable


class CardinalityError(ValueError):
    """A logical key matches more than one row of the target."""


class AffectedRowsError(RuntimeError):
    """A write touched another number of rows than expected."""


def rows_frame(spark: SparkSession, rows: Sequence[dict[str, Any]], schema: T.StructType) -> DataFrame:
    """Rows for a bulk insert: every column must be given."""
    for i, r in enumerate(rows):
        if missing := [n for n in schema.names if n not in r]:
            raise ValueError(f"row {i} lacks {', '.join(missing)}")
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)


def bulk_insert(table: VersionedTable, rows: Sequence[dict[str, Any]] | DataFrame, schema: T.StructType | None = None) -> int:
    """Appends rows; how many."""
    with lifecycle("bulk insert", table=table.path) as facts:
        df = rows if isinstance(rows, DataFrame) else rows_frame(table.spark, rows, schema)
        made = table.append(df, "bulk insert")
        # Row counts stand in the new files' footers; the source is read once.
        facts["rows"] = table.frame(made, made.added).count() if isinstance(rows, DataFrame) else len(rows)
        return facts["rows"]


def last_wins(source: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row per key: the last by ordinal; where there is nothing but the key, the first. Equal ordinals are told apart by the rows' contents."""
    plain = [c for c in source.columns if c not in keys and c != ordinal]
    order = F.col(ordinal).desc() if plain else F.col(ordinal).asc()
    ties = [F.to_json(F.struct(*plain)).desc()] if plain else []
    return source.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(order, *ties))).filter("__at = 1").drop("__at")


def single_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """source, which fails when it runs if a key that is not NULL has several rows: nothing says then which of them wins."""
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    told = source.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    once = F.assert_true((F.col("__n") == 1) | unknown, F.lit(f"{', '.join(keys)} is not unique in the source of an upsert; give an ordinal"))
    return told.filter(once.isNull()).drop("__n")


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (a[k] == b[k])
    return cond


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], ordinal: str | None = None, update: Sequence[str] | None = None) -> DataFrame:
    """Rows of source replace those of target with their key, others are added. update: only these columns of a row that exists are set.

    The last row of a key by ordinal wins; without an ordinal keys must be single, or the result fails when it runs."""
    source = last_wins(source, keys, ordinal).drop(ordinal) if ordinal else single_keys(source, keys)
    if not [c for c in source.columns if c not in keys]:
        new = source.join(target, _same(source, target, keys), "left_anti")
        return target.unionByName(new, allowMissingColumns=True)
    if update is None and set(source.columns) == set(target.columns):
        return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(source)
    t, s = target.alias("t"), source.withColumn("__here", F.lit(True)).alias("s")
    changed = set(update if update is not None else [c for c in source.columns if c not in keys])
    joined = t.withColumn("__old", F.lit(True)).alias("t").join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(f"t.{c}", f"s.{c}").alias(c))
        elif c not in source.columns:
            out.append(F.col(f"t.{c}"))
        elif c in changed:
            out.append(F.when(F.col("__here"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("__old"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return joined.select(*out)


def upsert_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], ordinal: str | None = None) -> DataFrame:
    """Upsert on a logical key that nothing enforces: refused before anything is written if it matches more than one row."""
    many = duplicate_keys(target, keys).join(source.select(*keys).distinct(), list(keys), "left_semi").limit(1).collect()
    if many:
        raise CardinalityError(f"more than one row has the key {[many[0][k] for k in keys]}")
    return upsert(target, source, keys, ordinal)


def merge_into(table: VersionedTable, source: DataFrame, keys: Sequence[str], ordinal: str | None = None, update: Sequence[str] | None = None, message: str = "", author: str = "") -> Snapshot:
    """upsert() into a table: the files that hold a key of source are written anew, with the rows that are new; others are carried over."""
    base = table.current()
    wanted = source.persist()
    try:
        touched = table.files_with(base, wanted, keys)
        log.info("upsert into %s touches %d files", table.path, len(touched))
        return table.replace(base, touched, upsert(table.frame(base, touched), wanted, keys, ordinal, update), message, author)
    finally:
        wanted.unpersist()


def update_rows(table: VersionedTable, condition: Column, setters: dict[str, Column], expected: int | None = None, message: str = "") -> int:
    """Sets columns of the rows that the condition holds for; how many rows. Nothing is published if another number was expected."""
    return _rewrite_rows(table, condition, lambda df: update_where(df, condition, setters), expected, message)


def delete_rows(table: VersionedTable, condition: Column, expected: int | None = None, message: str = "") -> int:
    """Deletes the rows that the condition holds for; how many. Nothing is published if another number was expected."""
    return _rewrite_rows(table, condition, lambda df: delete_where(df, condition), expected, message)


def _rewrite_rows(table: VersionedTable, condition: Column, change: Callable[[DataFrame], DataFrame], expected: int | None, message: str) -> int:
    base = table.current()
    touched = table.files_with(base, where=condition)
    hit = sum(touched.values())
    if expected is not None and hit != expected:
        raise AffectedRowsError(f"{hit} rows instead of {expected}")
    if touched:
        table.replace(base, touched, change(table.frame(base, touched)), message)
    return hit


def update_where(target: DataFrame, condition: Column, setters: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    kinds = {f.name: f.dataType for f in target.schema.fields}
    return target.withColumns({c: F.when(hit, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in setters.items()})


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """A condition that is unknown keeps its row."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def delete_matching(target: DataFrame, other: DataFrame, on) -> DataFrame:
    return target.join(other, on, "left_anti")


def update_from(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets the columns of changes on the rows with its keys; adds nothing."""
    new = changes.select(*keys, *[F.col(c).alias(f"__{c}") for c in changes.columns if c not in keys]).withColumn("__here", F.lit(True))
    joined = target.join(new, list(keys), "left")
    return joined.select(*[F.when(F.col("__here"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in changes.columns and c not in keys else F.col(c) for c in target.columns])


def delete_keys(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(gone.select(*keys), list(keys), "left_anti").select(*target.columns)


def set_struct(target: DataFrame, column: str, leaves: dict[str, Column], condition: Column | None = None) -> DataFrame:
    """Sets leaves of a struct (dotted names go deeper) and leaves its other parts as they are."""
    made = F.col(column)
    for leaf, v in leaves.items():
        made = made.withField(leaf, v)
    return target.withColumn(column, made if condition is None else F.when(F.coalesce(condition, F.lit(False)), made).otherwise(F.col(column)))


def with_identity(source: DataFrame, target: DataFrame, column: str, order: Sequence[str], cells: int = 64) -> DataFrame:
    """Numbers new rows on from the target's largest id. Rows are ranked within hash cells and cells follow each other, so no single task ranks all rows; the numbers have no gaps but no meaning beyond that."""
    start = target.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]
    celled = source.withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    counts = {r["__cell"]: r["n"] for r in celled.groupBy("__cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, at = [], start
    for c in range(cells):
        before.append(at)
        at += counts.get(c, 0)
    rank = F.row_number().over(Window.partitionBy("__cell").orderBy(*order))
    return celled.withColumn(column, (F.element_at(F.array(*[F.lit(int(x)) for x in before]), F.col("__cell") + 1) + rank).cast("long")).drop("__cell")


def publish(table: VersionedTable, state: DataFrame, base: int, expected_rows: int | None = None, message: str = "") -> Snapshot:
    """Makes state the next snapshot if none came after base, and, if rows are expected, if the whole state has as many. Rows that a change touches are counted by update_rows and delete_rows."""
    if expected_rows is not None and (n := state.count()) != expected_rows:
        raise AffectedRowsError(f"{n} rows instead of {expected_rows}")
    return table.overwrite(state, message, base=base)


def alter(table: VersionedTable, add: dict[str, T.DataType] | None = None, drop: Sequence[str] = (), rename: dict[str, str] | None = None, cast: dict[str, T.DataType] | None = None, message: str = "alter") -> Snapshot:
    """Changes a table's columns. Added and dropped ones change the schema alone, as files are read by name; renamed or retyped ones rebuild the table."""
    base = table.current()
    fields = [f for f in table.frame(base, ()).schema.fields if f.name not in drop]
    names = {f.name for f in fields} | set(drop)
    if lost := [c for c in (*drop, *(rename or {}), *(cast or {})) if c not in {f.name for f in table.frame(base, ()).schema.fields}]:
        raise ValueError(f"{table.path} has no column {', '.join(lost)}")
    if again := [c for c in (add or {}) if c in names]:
        raise ValueError(f"{', '.join(again)} cannot be added: files may hold a column of that name")
    if rename or cast:
        kinds = {f.name: f.dataType for f in fields} | (cast or {})
        rebuilt = table.frame(base).select(*[F.col(f.name).cast(kinds[f.name]).alias((rename or {}).get(f.name, f.name)) for f in fields], *[F.lit(None).cast(k).alias(c) for c, k in (add or {}).items()])
        return table.overwrite(rebuilt, message, base=base.id)
    schema = T.StructType([*fields, *[T.StructField(c, k, True) for c, k in (add or {}).items()]])
    return table.publish_schema(base, schema, message)
