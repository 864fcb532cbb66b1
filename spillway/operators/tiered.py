"""Tiered datasets: a hot table, and cold rows in immutable, partitioned Parquet generations below a watermark.

A store has one root table with a lifecycle column and match keys, and any number of descendants that reach it by a
chain of foreign keys; a descendant row goes where its root goes. Views show the union: hot rows at or above the
watermark or without a date, late hot rows whose key is not cold, and cold rows. Every change of the cold side writes the files that
are new as a generation and then publishes the next numbered control file, which lists all files in force, those carried
over from earlier generations too. A control file appears whole or not at all and is never changed, so a crash before
that leaves the old state in force and of two runs only one publishes. No published data file is ever changed either.

Frames of the hot side are passed in and new hot states are returned; where hot rows live is up to the caller.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.functions.temporal import bucket
from spillway.operators.relational import duplicate_keys, keyset_page, union_by_name
from spillway.plans.command import lifecycle
from spillway.sources import fs


class TierError(RuntimeError):
    """A step was refused; nothing was published."""


@dataclass(frozen=True)
class Partition:
    """by: value, year, month or day of a root column, kept in the hidden column alias."""

    column: str
    by: str = "value"
    alias: str | None = None

    @property
    def name(self) -> str:
        return self.alias or (self.column if self.by == "value" else f"{self.column}_{self.by}")

    def expr(self, column: Column) -> Column:
        return column if self.by == "value" else bucket(column, self.by)


@dataclass(frozen=True)
class Node:
    """A table of the aggregate. parent and link (child column, parent column) pairs lead towards the root."""

    name: str
    keys: tuple[str, ...]
    parent: str | None = None
    link: tuple[tuple[str, str], ...] = ()


_GENERATION, _KEYS = "__generation", "__keys"
#: Keys that a scope can name one by one.
_SCOPE_KEYS = 10_000


def _tail(path: str) -> str:
    """What tells a data file from others, however its path is spelt: generation, partitions (which may be encoded once or twice) and name."""
    return unquote(unquote(path.rsplit(f"/{_GENERATION}=", 1)[-1]))


_PRECISION = {"year": 0, "month": 1, "day": 2, "value": 3}


@dataclass(frozen=True)
class Store:
    root: Node
    lifecycle: str
    path: str
    granularity: str = "month"
    partitions: tuple[Partition, ...] = ()
    children: tuple[Node, ...] = ()

    def __post_init__(self):
        if self.granularity not in ("month", "day"):
            raise ValueError("granularity is month or day")
        if self.partitions and not any(p.column == self.lifecycle and _PRECISION[p.by] >= _PRECISION[self.granularity] for p in self.partitions):
            raise ValueError(f"the partitions must hold {self.lifecycle} by {self.granularity} or finer")
        names = [p.name for p in self.plan]
        if len(set(names)) < len(names):
            raise ValueError("two partitions have one name")
        for c in self.children:
            if c.parent not in {self.root.name, *(x.name for x in self.children)} or not c.link:
                raise ValueError(f"{c.name} does not lead to {self.root.name}")

    @property
    def plan(self) -> tuple[Partition, ...]:
        by = ("year", "month") if self.granularity == "month" else ("year", "month", "day")
        return self.partitions or tuple(Partition(self.lifecycle, b, f"tier_{b}") for b in by)

    @property
    def nodes(self) -> tuple[Node, ...]:
        return (self.root, *self.children)

    def layout(self) -> list[list[str]]:
        return [[p.column, p.by, p.name] for p in self.plan]

    def chain(self, node: Node) -> list[Node]:
        """The node and its ancestors up to the root."""
        out = [node]
        while out[-1].parent is not None:
            out.append(next(n for n in self.nodes if n.name == out[-1].parent))
        return out


@dataclass
class Control:
    watermark: str | None = None
    generation: str | None = None
    from_bound: str | None = None
    layout: list = field(default_factory=list)
    schemas: dict = field(default_factory=dict)
    files: dict = field(default_factory=dict)
    version: int = 0
    history: list = field(default_factory=list)


def align(cutoff: dt.datetime, granularity: str) -> dt.datetime:
    """Down to the first instant of the month or day."""
    day = cutoff.replace(hour=0, minute=0, second=0, microsecond=0)
    return day.replace(day=1) if granularity == "month" else day


def same_row(a: str, b: str, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns], F.lit(True))


def _on(a: str, b: str, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in columns])


class TieredStore:
    def __init__(self, spark: SparkSession, store: Store):
        self.spark, self.store = spark, store

    # -- control ----------------------------------------------------------------------------------------------------

    def _control_path(self, version: int) -> str:
        return f"{self.store.path}/_control/{version:012d}.json"

    def control(self) -> Control:
        found = [n for n in fs.list_names(self.spark, f"{self.store.path}/_control") if n.endswith(".json")]
        return Control(**json.loads(fs.read_text(self.spark, f"{self.store.path}/_control/{max(found)}"))) if found else Control()

    def _publish(self, now: Control, base: int) -> Control:
        now.version = base + 1
        now.history = [*now.history, {"version": now.version, "generation": now.generation, "watermark": now.watermark, "at": time.time()}]
        try:
            if self.control().version != base:
                raise FileExistsError
            fs.publish_text(self.spark, self._control_path(now.version), json.dumps(asdict(now)))
        except FileExistsError as e:
            raise TierError("another run published first") from e
        if now.generation:
            fs.delete(self.spark, self._marker(now.generation))
        return now

    def _marker(self, generation: str) -> str:
        return f"{self.store.path}/_candidates/{generation}.json"

    def candidates(self) -> list[str]:
        """Generations that were begun and not published; refused if another store began one here."""
        found = [n.removesuffix(".json") for n in fs.list_names(self.spark, f"{self.store.path}/_candidates") if n.endswith(".json")]
        for name in found:
            owner = json.loads(fs.read_text(self.spark, self._marker(name)))["store"]
            if owner != self.store.root.name:
                raise TierError(f"{name} was begun by the store of {owner}")
        return found

    def watermark(self) -> dt.datetime | None:
        w = self.control().watermark
        return dt.datetime.fromisoformat(w) if w else None

    # -- cold side --------------------------------------------------------------------------------------------------

    def _base(self, node: str) -> str:
        return f"{self.store.path}/data/{node}"

    def _stored(self, node: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
        """Rows of files of any generations, with their partition columns."""
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self._base(node)).parquet(*files).select(*schema.names)

    def cold(self, node: str | None = None, where: Column | None = None, bounds: Sequence[tuple[str, str, object]] = (), hidden: bool = False) -> DataFrame | None:
        """Rows in force, from the catalogued files; bounds prune partitions (see pruning)."""
        name, now = node or self.store.root.name, self.control()
        if not now.generation:
            return None
        schema = T.StructType.fromJson(now.schemas[name])
        plain = T.StructType([f for f in schema.fields if f.name not in self._hidden(now)])
        df = self._stored(name, now.files[name], schema)
        if bounds and now.layout == self.store.layout():
            for cond in self.pruning(bounds):
                df = df.filter(cond)
        df = df if where is None else df.filter(where)
        return df if hidden else df.select(*plain.names)

    @staticmethod
    def _hidden(now: Control) -> set[str]:
        return {name for column, _, name in now.layout if name != column} | {"_contract"}

    def pruning(self, bounds: Sequence[tuple[str, str, object]]) -> list[Column]:
        """Predicates on partition columns that conjunctive bounds (column, = < <= > >=, value) imply. A bucket holds many values, so strict bounds relax."""
        out = []
        for column, op, v in bounds:
            for p in self.store.plan:
                if p.column != column:
                    continue
                at = F.lit(v) if p.by == "value" else bucket(F.lit(v).cast("timestamp_ntz"), p.by)
                c = F.col(p.name)
                if p.by != "value":
                    op = {"<": "<=", ">": ">="}.get(op, op)
                out.append({"=": c == at, "<": c < at, "<=": c <= at, ">": c > at, ">=": c >= at}[op])
        return out

    def key_index(self) -> DataFrame | None:
        """The distinct match keys of the cold rows, as each generation kept those of its own files."""
        now = self.control()
        return self._stored(_KEYS, now.files[_KEYS], T.StructType.fromJson(now.schemas[_KEYS])) if now.generation else None

    def _write(self, tables: dict[str, DataFrame], now: Control, keep: dict[str, list[str]] | None = None) -> Control:
        """Writes rows as a new generation, beside the files to keep; it does not count until it is published."""
        self.candidates()
        name = f"{now.version + 1:06d}-{uuid.uuid4().hex[:8]}"
        fs.write_text(self.spark, self._marker(name), json.dumps({"store": self.store.root.name, "layout": self.store.layout()}))
        made = Control(now.watermark, name, now.from_bound, self.store.layout(), {}, {}, now.version, now.history)
        names = [p.name for p in self.store.plan]
        for node, df in tables.items():
            for p in self.store.plan:
                if p.name not in df.columns:
                    df = df.withColumn(p.name, p.expr(F.col(p.column)))
            if keep:  # columns that the kept files have, in their order, and new ones
                held = T.StructType.fromJson(now.schemas[node])
                df = df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in held.fields], *[c for c in df.columns if c not in held.names])
            path = f"{self._base(node)}/{_GENERATION}={name}"
            # Rows of a partition come together first, so that it is not many small files; AQE cuts partitions that are large.
            df.hint("rebalance", *names).write.partitionBy(*names).parquet(path)
            made.files[node] = fs.list_files(self.spark, path, ".parquet")
            order = [f for f in df.schema.fields if f.name not in names] + [df.schema[n] for n in names]
            made.schemas[node] = T.StructType([T.StructField(f.name, f.dataType, True) for f in order]).jsonValue()
        root = self.store.root
        keys = self._stored(root.name, made.files[root.name], T.StructType.fromJson(made.schemas[root.name])).select(*root.keys).distinct()
        path = f"{self._base(_KEYS)}/{_GENERATION}={name}"
        keys.write.parquet(path)
        made.files[_KEYS], made.schemas[_KEYS] = fs.list_files(self.spark, path, ".parquet"), T.StructType([T.StructField(f.name, f.dataType, True) for f in keys.schema.fields]).jsonValue()
        made.files = {n: [*(keep or {}).get(n, ()), *files] for n, files in made.files.items()}
        return made

    def _counts(self, made: Control, but: dict[str, list[str]]) -> dict[str, int]:
        """Rows of the files that are new, from their footers."""
        return {n.name: self._stored(n.name, [f for f in made.files[n.name] if f not in but.get(n.name, ())], T.StructType.fromJson(made.schemas[n.name])).count() for n in self.store.nodes}

    # -- roots of children ------------------------------------------------------------------------------------------

    def with_root(self, node: Node, tables: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
        """A descendant's rows with these columns of their root, through the chain of foreign keys."""
        chain = self.store.chain(node)
        df = tables[node.name]
        if len(chain) == 1:
            return df
        child = df.select("*", *[F.col(c).alias(f"__up_{p}") for c, p in node.link])
        for here, up in zip(chain[1:], [*chain[2:], None], strict=True):
            link = [p for _, p in chain[chain.index(here) - 1].link]
            carry = [c for c, _ in here.link] if up else list(columns)
            parent = tables[here.name].select(*[F.col(c).alias(f"__on_{c}") for c in link], *[F.col(c).alias(f"__next_{c}") for c in carry]).distinct()
            child = child.join(parent, [F.col(f"__up_{c}") == F.col(f"__on_{c}") for c in link], "inner").drop(*[f"__up_{c}" for c in link], *[f"__on_{c}" for c in link])
            if up:
                child = child.select(*[c for c in child.columns if not c.startswith("__next_")], *[F.col(f"__next_{c}").alias(f"__up_{p}") for c, p in here.link])
        return child.select(*df.columns, *[F.col(f"__next_{c}").alias(f"__root_{c}") for c in columns])

    # -- views ------------------------------------------------------------------------------------------------------

    def view_root(self, hot: DataFrame, bounds: Sequence[tuple[str, str, object]] = ()) -> DataFrame:
        w, cold = self.watermark(), self.cold(bounds=bounds)
        if cold is None:
            return hot
        ts, keys = F.col(self.store.lifecycle), self.store.root.keys
        new = hot.filter(ts.isNull() | (ts >= F.lit(w)))
        late = hot.filter(ts < F.lit(w)).join(self.key_index(), list(keys), "left_anti").select(*hot.columns)
        return union_by_name(new, late, cold.filter(ts < F.lit(w)))

    def view_child(self, name: str, tables: dict[str, DataFrame]) -> DataFrame:
        """Hot rows whose root is hot, or whose root's key is not cold, and the published cold rows."""
        node, w, cold = next(n for n in self.store.children if n.name == name), self.watermark(), self.cold(name)
        hot = tables[name]
        if cold is None:
            return hot
        keys = self.store.root.keys
        led = self.with_root(node, tables, [*keys, self.store.lifecycle])
        index = self.key_index().select(*[F.col(k).alias(f"__root_{k}") for k in keys]).withColumn("__cold", F.lit(True))
        ts = F.col(f"__root_{self.store.lifecycle}")
        seen = led.join(index, [f"__root_{k}" for k in keys], "left").filter(ts.isNull() | (ts >= F.lit(w)) | F.col("__cold").isNull())
        return union_by_name(seen.select(*hot.columns), cold)

    # -- validation -------------------------------------------------------------------------------------------------

    def validate(self, tables: dict[str, DataFrame]) -> dict[str, int]:
        """Roots with a NULL key, keys found more than once, and descendants without a parent."""
        keys = self.store.root.keys
        root = tables[self.store.root.name]
        out = {"null_keys": root.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).count(), "duplicate_keys": duplicate_keys(root, keys).count()}
        for n in self.store.children:
            if n.name in tables:
                parent = tables[n.parent].select(*[F.col(p).alias(f"__{p}") for _, p in n.link])
                out[f"orphans_{n.name}"] = tables[n.name].join(parent, [F.col(c) == F.col(f"__{p}") for c, p in n.link], "left_anti").count()
        return out

    # -- archive ----------------------------------------------------------------------------------------------------

    def window(self, tables: dict[str, DataFrame], low: dt.datetime | None, cutoff: dt.datetime) -> dict[str, DataFrame]:
        """Hot rows of roots with a date in [low, cutoff), descendants by their root's date; with the root's partition columns."""
        ts = F.col(self.store.lifecycle)
        root = tables[self.store.root.name]
        inside = ts.isNotNull() & (ts < F.lit(cutoff)) & (F.lit(True) if low is None else ts >= F.lit(low))
        out = {self.store.root.name: root.filter(inside).withColumns({p.name: p.expr(F.col(p.column)) for p in self.store.plan if p.name not in root.columns})}
        need = list(dict.fromkeys([self.store.lifecycle, *[p.column for p in self.store.plan]]))
        for n in self.store.children:
            led = self.with_root(n, tables, need)
            r = F.col(f"__root_{self.store.lifecycle}")
            led = led.filter(r.isNotNull() & (r < F.lit(cutoff)) & (F.lit(True) if low is None else r >= F.lit(low)))
            hidden = [p.expr(F.col(f"__root_{p.column}")).alias(p.name) for p in self.store.plan if p.name not in tables[n.name].columns]
            out[n.name] = led.select(*tables[n.name].columns, *hidden)
        return out

    def archive(self, tables: dict[str, DataFrame], cutoff: dt.datetime, low: dt.datetime | None = None) -> Control:
        """Copies the window up to the aligned cutoff into a new generation, checks the counts and moves the watermark. Files of what is cold already are carried over.

        Rows whose key is cold stay out of the copy: same data is a retry, other data is a conflict and refuses the run."""
        with lifecycle("archive", store=self.store.root.name, cutoff=str(cutoff)) as facts:
            made = self._archive(tables, cutoff, low)
            facts["generation"] = made.generation
            return made

    def _archive(self, tables: dict[str, DataFrame], cutoff: dt.datetime, low: dt.datetime | None) -> Control:
        now, cutoff = self.control(), align(cutoff, self.store.granularity)
        if now.watermark and cutoff < dt.datetime.fromisoformat(now.watermark):
            raise TierError("the cutoff lies below the watermark")
        if bad := {k: v for k, v in self.validate(tables).items() if v and not k.startswith("orphans_")}:
            raise TierError(f"the source is not sound: {bad}")
        if now.generation and self.conflicts(tables[self.store.root.name]).limit(1).count():
            raise TierError("hot rows differ from cold rows of the same key; reconcile first")
        if now.generation and now.layout != self.store.layout():
            raise TierError("the cold rows have another layout; rewrite the contract first")
        new = self.window(tables, low if now.watermark is None else None, cutoff)
        index = self.key_index()
        for n in self.store.nodes if index is not None else ():
            add = new[n.name]
            new[n.name] = add.join(index, list(n.keys), "left_anti").select(*add.columns) if n is self.store.root else self._not_cold(n, add, tables, index)
        expected = {n: df.count() for n, df in new.items()}
        made = self._write(new, now, now.files)
        if (got := self._counts(made, now.files)) != expected:
            raise TierError(f"the copy holds {got} rows instead of {expected}")
        made.watermark = cutoff.isoformat()
        made.from_bound = low.isoformat() if low and now.watermark is None else now.from_bound
        return self._publish(made, now.version)

    def _not_cold(self, n: Node, rows: DataFrame, tables: dict[str, DataFrame], index: DataFrame) -> DataFrame:
        keys = self.store.root.keys
        led = self.with_root(n, tables | {n.name: rows}, list(keys))
        mine = index.select(*[F.col(k).alias(f"__root_{k}") for k in keys])
        return led.join(mine, [f"__root_{k}" for k in keys], "left_anti").select(*rows.columns)

    def bootstrap(self, tables: dict[str, DataFrame], low: dt.datetime, cutoff: dt.datetime) -> Control:
        """The first archive, bounded below."""
        if self.control().generation:
            raise TierError("the store has an archive already")
        return self.archive(tables, cutoff, align(low, self.store.granularity))

    def delete_hot(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The hot side without rows below the watermark whose whole archived row is equal. Descendants go by their root."""
        w, out = self.watermark(), dict(tables)
        if w is None:
            return out
        for n in reversed(self.store.nodes):
            hot, cold = tables[n.name], self.cold(n.name)
            shared = [c for c in hot.columns if c in cold.columns]
            missing = reduce(lambda a, b: a & b, [F.col(f"h.{c}").isNull() for c in hot.columns if c not in shared], F.lit(True))
            if n is self.store.root:
                gone = hot.filter(F.col(self.store.lifecycle) < F.lit(w))
            else:
                led = self.with_root(n, tables, [self.store.lifecycle])
                gone = led.filter(F.col(f"__root_{self.store.lifecycle}") < F.lit(w)).select(*hot.columns)
            match = gone.alias("h").join(cold.alias("c"), _on("h", "c", n.keys) & same_row("h", "c", shared) & missing, "left_semi")
            out[n.name] = hot.join(match.select(*n.keys).distinct(), list(n.keys), "left_anti").select(*hot.columns)
        return out

    # -- corrections ------------------------------------------------------------------------------------------------

    def conflicts(self, hot: DataFrame, node: str | None = None) -> DataFrame:
        """Keys that are hot and cold with different data."""
        n = self._node(node or self.store.root.name)
        cold = self.cold(n.name)
        if cold is None:
            return hot.select(*n.keys).limit(0)
        if n is self.store.root:
            cold = cold.filter(F.col(self.store.lifecycle) < F.lit(self.watermark()))
        data = [c for c in hot.columns if c in cold.columns and c not in n.keys]
        return hot.alias("h").join(cold.alias("c"), _on("h", "c", n.keys) & ~same_row("h", "c", data)).select(*[F.col(f"h.{k}") for k in n.keys])

    def reopened(self, hot: DataFrame) -> DataFrame:
        """Keys whose lifecycle date differs between hot and cold."""
        ts, keys = self.store.lifecycle, self.store.root.keys
        return hot.alias("h").join(self.cold().alias("c"), _on("h", "c", keys) & ~F.col(f"h.{ts}").eqNullSafe(F.col(f"c.{ts}"))).select(*[F.col(f"h.{k}") for k in keys])

    def detached(self, name: str, tables: dict[str, DataFrame]) -> DataFrame:
        """Hot descendants whose parent is hot nowhere and cold nowhere."""
        n = next(x for x in self.store.children if x.name == name)
        out = tables[name]
        for parent in (tables[n.parent], self.cold(n.parent)):
            if parent is not None:
                out = out.join(parent.select(*[F.col(p).alias(f"__{p}") for _, p in n.link]), [F.col(c) == F.col(f"__{p}") for c, p in n.link], "left_anti")
        return out

    def conflict_count(self, hot: DataFrame, node: str | None = None) -> int:
        return self.conflicts(hot, node).count()

    def conflict_page(self, hot: DataFrame, after: Sequence | None = None, take: int = 100, node: str | None = None) -> DataFrame:
        """The conflicting keys after a key, in key order; a top-k, whatever the page."""
        n = self._node(node or self.store.root.name)
        return keyset_page(self.conflicts(hot, node).distinct(), n.keys, after, take)

    def conflict_stream(self, hot: DataFrame, node: str | None = None) -> Iterator[Row]:
        """The conflicting keys one by one; the driver holds a partition of them at a time."""
        yield from self.conflicts(hot, node).distinct().toLocalIterator()

    def _node(self, name: str) -> Node:
        return next(n for n in self.store.nodes if n.name == name)

    def scope(self, prefix: Sequence[object] = (), keys: DataFrame | None = None) -> Column:
        """A boundary of upkeep: values of the leading partitions in their order, or the root's keys (then as a condition on them).

        Anything else would cut partitions or keys apart, so it is refused."""
        if bool(prefix) == (keys is not None):
            raise TierError("a scope is a partition prefix or keys")
        if keys is not None:
            if list(keys.columns) != list(self.store.root.keys):
                raise TierError(f"the keys are {', '.join(self.store.root.keys)}")
            rows = keys.distinct().limit(_SCOPE_KEYS + 1).collect()
            if len(rows) > _SCOPE_KEYS or any(v is None for r in rows for v in r):
                raise TierError(f"a scope has at most {_SCOPE_KEYS} keys, without NULL")
            return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(self.store.root.keys, r, strict=True)]) for r in rows], F.lit(False))
        if len(prefix) > len(self.store.plan):
            raise TierError("the prefix has more values than there are partitions")
        return reduce(lambda a, b: a & b, [p.expr(F.col(p.column)) == F.lit(v) for p, v in zip(self.store.plan, prefix, strict=False)])

    def reconcile(self, hot: DataFrame | dict[str, DataFrame], scope: Column | None = None, tombstones: DataFrame | None = None) -> Control:
        """A new generation in which hot rows below the watermark, within scope, win by key, tombstoned keys are gone and other cold rows stay.

        With all hot tables, the descendants of the roots that win are those that are hot; with the root alone, cold descendants stay."""
        now, w, keys = self.control(), self.watermark(), self.store.root.keys
        if not now.generation:
            raise TierError("nothing is archived")
        tables = hot if isinstance(hot, dict) else {self.store.root.name: hot}
        ts = F.col(self.store.lifecycle)
        source = tables[self.store.root.name].filter(ts < F.lit(w))
        source = source if scope is None else source.filter(scope)
        if tombstones is not None:
            source = source.join(tombstones.select(*keys), list(keys), "left_anti")
        if duplicate_keys(source, keys).limit(1).count():
            raise TierError("a key is hot more than once")
        cold = {x.name: self.cold(x.name) for x in self.store.nodes}
        won = source.select(*keys)
        gone = won if tombstones is None else won.union(tombstones.select(*keys))
        rest = cold[self.store.root.name].filter(ts < F.lit(w)).join(gone, list(keys), "left_anti")
        plain = cold[self.store.root.name].columns
        full = {self.store.root.name: union_by_name(rest.select(*plain), source).select(*plain)}
        need = list(dict.fromkeys(p.column for p in self.store.plan))

        def of(n: Node, rows: dict[str, DataFrame], which: DataFrame, how: str) -> DataFrame:
            mine = which.select(*[F.col(k).alias(f"__root_{k}") for k in keys])
            return self.with_root(n, rows, list(keys)).join(mine, [f"__root_{k}" for k in keys], how).select(*rows[n.name].columns)

        for n in self.store.children:
            if n.name in tables:
                kept = of(n, cold, gone, "left_anti")
                new = of(n, tables, won, "left_semi")
                rows = union_by_name(kept, new).select(*cold[n.name].columns)
            else:
                rows = cold[n.name] if tombstones is None else of(n, cold, tombstones, "left_anti")
            # Descendants lie where their root lies now.
            parents = {x.name: self._merged(x, tables, cold, gone, won) if x.name in tables else cold[x.name] for x in self.store.children} | {self.store.root.name: full[self.store.root.name], n.name: rows}
            led = self.with_root(n, parents, need)
            full[n.name] = led.select(*rows.columns, *[p.expr(F.col(f"__root_{p.column}")).alias(p.name) for p in self.store.plan if p.name not in rows.columns])
        return self._publish(self._write(full, now), now.version)

    def _merged(self, n: Node, tables: dict[str, DataFrame], cold: dict[str, DataFrame], gone: DataFrame, won: DataFrame) -> DataFrame:
        keys = self.store.root.keys
        out = []
        for rows, which, how in ((cold, gone, "left_anti"), (tables, won, "left_semi")):
            mine = which.select(*[F.col(k).alias(f"__root_{k}") for k in keys])
            out.append(self.with_root(n, rows, list(keys)).join(mine, [f"__root_{k}" for k in keys], how).select(*rows[n.name].columns))
        return union_by_name(*out).select(*cold[n.name].columns)

    def restore(self, hot: DataFrame | dict[str, DataFrame], scope: Column) -> DataFrame | dict[str, DataFrame]:
        """The hot side with the cold rows of roots in scope added that are not hot; refused if a hot row of the same key differs.

        With all hot tables, descendants of these roots come along and all tables are given back."""
        tables = hot if isinstance(hot, dict) else {self.store.root.name: hot}
        cold = {x.name: self.cold(x.name) for x in self.store.nodes}
        roots, keys, out = cold[self.store.root.name].filter(scope), self.store.root.keys, dict(tables)
        mine = roots.select(*[F.col(k).alias(f"__root_{k}") for k in keys])
        for n in self.store.nodes:
            if n.name not in tables:
                continue
            back = roots if n is self.store.root else self.with_root(n, cold, list(keys)).join(mine, [f"__root_{k}" for k in keys], "left_semi").select(*cold[n.name].columns)
            here = tables[n.name]
            data = [c for c in here.columns if c in back.columns and c not in n.keys]
            if here.alias("h").join(back.alias("c"), _on("h", "c", n.keys) & ~same_row("h", "c", data)).limit(1).count():
                raise TierError(f"a row of {n.name} to restore is hot with other data")
            out[n.name] = union_by_name(here, back.join(here.select(*n.keys), list(n.keys), "left_anti").select(*back.columns)).select(*here.columns)
        return out if isinstance(hot, dict) else out[self.store.root.name]

    # -- upkeep -----------------------------------------------------------------------------------------------------

    def _rewrite(self, change, layout: bool = False) -> Control:
        now = self.control()
        if not now.generation:
            raise TierError("nothing is archived")
        roots = self.cold()
        full = {}
        for n in self.store.nodes:
            rows = self.cold(n.name, hidden=True)
            if layout:
                rows = rows.select(*[c for c in rows.columns if c not in self._hidden(now)])
                if n is not self.store.root:
                    led = self.with_root(n, {x.name: self.cold(x.name) for x in self.store.nodes} | {n.name: rows}, list(dict.fromkeys(p.column for p in self.store.plan)))
                    rows = led.select(*rows.columns, *[p.expr(F.col(f"__root_{p.column}")).alias(p.name) for p in self.store.plan])
            full[n.name] = change(n, rows, roots)
        return self._publish(self._write(full, now), now.version)

    def compact(self) -> Control:
        """The same rows in as few files as their sizes ask for."""
        return self._rewrite(lambda n, rows, roots: rows)

    def contract(self, tables: dict[str, DataFrame] | None = None) -> dict:
        """Whether the cold rows have this store's partition layout and, if tables are given, their columns: per table what was added, dropped or retyped."""
        now = self.control()
        out = {"active": now.layout, "wanted": self.store.layout(), "columns": {}, "rewrite": bool(now.generation) and now.layout != self.store.layout()}
        for n, df in (tables or {}).items() if now.generation else ():
            old = {f.name: f.dataType for f in T.StructType.fromJson(now.schemas[n]).fields if f.name not in self._hidden(now)}
            new = {f.name: f.dataType for f in df.schema.fields}
            out["columns"][n] = {"added": [c for c in new if c not in old], "dropped": [c for c in old if c not in new], "retyped": [c for c in new if c in old and new[c] != old[c]]}
            out["rewrite"] |= any(out["columns"][n].values())
        return out

    def rewrite_contract(self, tables: dict[str, DataFrame] | None = None) -> Control:
        """A new generation in this store's layout and, if tables are given, with their columns: added ones are NULL, dropped ones go, others are cast."""

        def change(n: Node, rows: DataFrame, roots: DataFrame) -> DataFrame:
            if not tables or n.name not in tables:
                return rows
            own = tables[n.name].schema.fields
            extra = [p.name for p in self.store.plan if p.name in rows.columns and p.name not in tables[n.name].columns]
            return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in own], *extra)

        return self._rewrite(change, layout=True)

    def retention(self, boundary: dt.datetime, keep: Column | None = None, dry_run: bool = True) -> dict[str, int] | Control:
        """Keeps cold roots at or above the boundary or in keep, and their descendants. dry_run counts what would stay and go."""
        ts = F.col(self.store.lifecycle)
        stay = (ts >= F.lit(boundary)) if keep is None else (ts >= F.lit(boundary)) | F.coalesce(keep, F.lit(False))
        if dry_run:
            cold = self.cold()
            kept = cold.filter(stay).count()
            return {"kept": kept, "removed": cold.count() - kept}
        kept_keys = self.cold().filter(stay).select(*self.store.root.keys)

        def change(n: Node, rows: DataFrame, roots: DataFrame) -> DataFrame:
            if n is self.store.root:
                return rows.filter(stay)
            keys = self.store.root.keys
            led = self.with_root(n, {x.name: self.cold(x.name) for x in self.store.nodes} | {n.name: rows}, list(keys))
            return led.join(kept_keys.select(*[F.col(k).alias(f"__root_{k}") for k in keys]), [f"__root_{k}" for k in keys], "left_semi").select(*rows.columns)

        return self._rewrite(change)

    def purge_older_than(self, boundary: dt.datetime) -> int:
        """Takes the files of partitions below the aligned boundary out of force, of descendants too; nothing is rewritten. The number of roots that went."""
        now, edge = self.control(), align(boundary, self.store.granularity)
        if not now.generation:
            return 0
        if now.layout != self.store.layout():
            raise TierError("the cold rows have another layout; rewrite the contract first")
        p = max((p for p in self.store.plan if p.column == self.store.lifecycle), key=lambda p: _PRECISION[p.by])
        below = F.col(p.name) < (F.lit(edge) if p.by == "value" else bucket(F.lit(edge).cast("timestamp_ntz"), p.by))
        gone: dict[str, dict[str, int]] = {}
        for n in self.store.nodes:
            rows = self._stored_with_file(n.name, now).filter(below).groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
            gone[n.name] = {_tail(r["__file"]): r["n"] for r in rows.collect()}
        removed = sum(gone[self.store.root.name].values())
        if removed or any(gone.values()):
            kept = {n: [f for f in files if _tail(f) not in gone.get(n, ())] for n, files in now.files.items()}
            made = Control(now.watermark, now.generation, now.from_bound, now.layout, now.schemas, kept, now.version, now.history)
            root = self.store.root
            # The keys of what stays; the key files hold no dates, so they are made anew, from the key columns alone.
            keys = self._stored(root.name, kept[root.name], T.StructType.fromJson(now.schemas[root.name])).select(*root.keys).distinct()
            path = f"{self._base(_KEYS)}/{_GENERATION}={now.version + 1:06d}-{uuid.uuid4().hex[:8]}"
            keys.write.parquet(path)
            made.files[_KEYS] = fs.list_files(self.spark, path, ".parquet")
            self._publish(made, now.version)
        return removed

    def _stored_with_file(self, node: str, now: Control) -> DataFrame:
        schema = T.StructType.fromJson(now.schemas[node])
        if not now.files[node]:
            return self.spark.createDataFrame([], schema).withColumn("__file", F.lit(""))
        df = self.spark.read.schema(schema).option("basePath", self._base(node)).parquet(*now.files[node])
        return df.select(*[p.name for p in self.store.plan], F.col("_metadata.file_path").alias("__file"))

    def inventory(self) -> list[dict]:
        """All generations found: active (some of its files are in force), superseded (published once) or candidate (never published)."""
        now = self.control()
        named = {h["generation"] for h in now.history}
        live = {_tail(f) for files in now.files.values() for f in files}
        found: dict[str, dict] = {}
        for node in fs.list_names(self.spark, f"{self.store.path}/data"):
            for f in fs.list_files(self.spark, self._base(node), ".parquet") if node != _KEYS else ():
                name = f.split(f"/{_GENERATION}=", 1)[1].split("/")[0]
                g = found.setdefault(name, {"generation": name, "files": 0, "in_force": 0, "state": "superseded" if name in named else "candidate"})
                g["files"] += 1
                g["in_force"] += _tail(f) in live
        for name in self.candidates():
            found.setdefault(name, {"generation": name, "files": 0, "in_force": 0, "state": "superseded" if name in named else "candidate"})
        for name, g in found.items():
            if g["in_force"] or name == now.generation:
                g["state"] = "active"
        return sorted(found.values(), key=lambda g: g["generation"])

    def cleanup(self, keep_superseded: int = 1, dry_run: bool = True) -> list[str]:
        """Generations that can go: candidates and all but the newest superseded ones. What is in force is checked again before anything is deleted."""
        every = self.inventory()
        old = [g["generation"] for g in every if g["state"] == "superseded"]
        gone = [g["generation"] for g in every if g["state"] == "candidate"] + (old[:-keep_superseded] if keep_superseded else old)
        if not dry_run:
            active = {g["generation"] for g in self.inventory() if g["state"] == "active"}
            if active & set(gone):
                raise TierError("the plan is out of date")
            for name in gone:
                for node in fs.list_names(self.spark, f"{self.store.path}/data"):
                    fs.delete(self.spark, f"{self._base(node)}/{_GENERATION}={name}")
                fs.delete(self.spark, self._marker(name))
        return gone

    def checkpoint(self) -> str:
        """What is needed to put the cold side back to its present state."""
        return json.dumps(asdict(self.control()))

    def recover(self, captured: str) -> Control:
        """Puts a captured state in force again, if all its files are still there."""
        was, now = Control(**json.loads(captured)), self.control()
        have = {_tail(f) for node in was.files for f in fs.list_files(self.spark, self._base(node), ".parquet")}
        if lost := [f for files in was.files.values() for f in files if _tail(f) not in have]:
            raise TierError(f"{len(lost)} files of the checkpoint are gone")
        was.history = now.history
        return self._publish(was, now.version)

    def preflight(self) -> None:
        """Writes, reads and deletes a small file where the store lies."""
        path = f"{self.store.path}/_probe-{uuid.uuid4().hex}"
        fs.write_text(self.spark, path, "probe")
        if fs.read_text(self.spark, path) != "probe" or not fs.delete(self.spark, path):
            raise TierError(f"{self.store.path} does not keep what is written")


class SharedChild:
    """A child table that rows of several roots, each with a store of its own, point to their parents with."""

    def __init__(self, stores: Sequence[TieredStore], name: str):
        self.stores, self.name = list(stores), name
        self.keys = self.stores[0]._node(name).keys
        if any(s._node(name).keys != self.keys for s in self.stores):
            raise ValueError(f"{name} has other keys in another store")

    def _bound(self, s: TieredStore, tables: dict[str, DataFrame]) -> DataFrame:
        """Hot child rows with a parent in this store, hot or cold."""
        n = s._node(self.name)
        parents = [tables[n.parent], *([s.cold(n.parent)] if s.control().generation else [])]
        held = reduce(DataFrame.union, [p.select(*[F.col(c).alias(f"__{c}") for _, c in n.link]) for p in parents]).distinct()
        return tables[self.name].join(held, [F.col(c) == F.col(f"__{p}") for c, p in n.link], "left_semi")

    def ambiguous(self, tables: dict[str, DataFrame]) -> DataFrame:
        """Keys of child rows that are bound to roots of more than one store."""
        bound = [self._bound(s, tables).select(*self.keys).distinct() for s in self.stores]
        return duplicate_keys(reduce(DataFrame.union, bound), self.keys).select(*self.keys)

    def view(self, tables: dict[str, DataFrame]) -> DataFrame:
        """Each store's view of the rows bound to it, and hot rows that are bound to none; a row of several stores once."""
        hot = tables[self.name]
        bound = [self._bound(s, tables) for s in self.stores]
        views = [s.view_child(self.name, tables | {self.name: b}).select(*hot.columns) for s, b in zip(self.stores, bound, strict=True)]
        free = hot.join(reduce(DataFrame.union, [b.select(*self.keys) for b in bound]).distinct(), list(self.keys), "left_anti").select(*hot.columns)
        return union_by_name(*views, free).dropDuplicates(list(self.keys))
