"""Catalogs: folders of versioned tables, read as a whole at one time, several of them side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spillway.sources import fs
from spillway.sources.snapshots import VersionedTable
from spillway.types import store_name


class Catalog:
    """The versioned tables of a folder. With a time, every table is that of the latest snapshot at or before it, and read-only."""

    def __init__(self, spark: SparkSession, path: str, as_of: float | None = None):
        self.spark, self.path, self.as_of = spark, path.rstrip("/"), as_of

    def names(self) -> list[str]:
        return [n for n in fs.list_names(self.spark, self.path) if fs.exists(self.spark, f"{self.path}/{n}/_log")]

    def table(self, name: str) -> VersionedTable:
        free = VersionedTable(self.spark, f"{self.path}/{name}")
        return free if self.as_of is None else VersionedTable(self.spark, free.path, pinned=free.as_of(self.as_of).id)

    def read(self, name: str, snapshot: int | None = None, timestamp: float | None = None) -> DataFrame:
        """A table's rows; a catalog at a time takes no snapshot or time of a table beside it."""
        return self.table(name).read(snapshot, timestamp)


def scaffold(catalog: Catalog) -> list[dict]:
    """The tables of a catalog with columns (name, store type, nullable), keys and the snapshot they are of, as a model can be made from."""
    out = []
    for name in catalog.names():
        table = catalog.table(name)
        now = table.current()
        columns = [{"name": f.name, "type": store_name(f.dataType), "nullable": f.nullable} for f in table.frame(now, ()).schema.fields]
        out.append({"name": name, "snapshot": now.id, "columns": columns, **table.declared()})
    return out


class Catalogs:
    """Attached catalogs by alias; tables are called alias.name, those of the first one by their name alone too."""

    def __init__(self, **first: Catalog):
        self.attached: dict[str, Catalog] = dict(first)

    def attach(self, alias: str, catalog: Catalog) -> None:
        if alias in self.attached:
            raise ValueError(f"a catalog is attached as {alias} already")
        self.attached[alias] = catalog

    def detach(self, alias: str) -> None:
        del self.attached[alias]

    def read(self, name: str) -> DataFrame:
        alias, _, table = name.rpartition(".")
        if not alias:
            alias = next(iter(self.attached))
        if alias not in self.attached:
            raise LookupError(f"no catalog is attached as {alias}")
        return self.attached[alias].read(table)

    def sql(self, text: str, **names: str) -> DataFrame:
        """SQL over tables of any attached catalogs; {a} stands for the table that a= names."""
        frames = {k: self.read(v) for k, v in names.items()}
        return next(iter(self.attached.values())).spark.sql(text, **frames)
