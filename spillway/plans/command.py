"""Command plans: the SQL and parameters of a query or of a terminal on it, captured without running anything."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("spillway.lifecycle")

_TERMINALS = {
    "query": "SELECT * FROM ({sql})",
    "count": "SELECT CAST(count(*) AS INT) AS value FROM ({sql})",
    "long_count": "SELECT count(*) AS value FROM ({sql})",
    "any": "SELECT EXISTS (SELECT 1 FROM ({sql})) AS value",
    "min": "SELECT min({column}) AS value FROM ({sql})",
    "max": "SELECT max({column}) AS value FROM ({sql})",
    "sum": "SELECT sum({column}) AS value FROM ({sql})",
    "average": "SELECT avg({column}) AS value FROM ({sql})",
}


@dataclass(frozen=True)
class CommandPlan:
    kind: str
    sql: str
    args: dict[str, Any] = field(default_factory=dict)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The plan's result, not run yet. Replayed terminals keep SQL's NULL for the Min, Max or Average of nothing."""
        return spark.sql(self.sql, args=self.args)

    def replay(self, spark: SparkSession) -> Any:
        rows = self.frame(spark)
        return rows.collect() if self.kind == "query" else rows.first()["value"]

    def explain(self, spark: SparkSession) -> str:
        return self.frame(spark)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def tagged(sql: str, *tags: str) -> str:
    """SQL with tags as comments in front, a line each, as logs and the history of queries show them."""
    return "".join(f"-- {line}\n" for tag in tags for line in tag.splitlines()) + sql


@contextmanager
def tags(spark: SparkSession, *names: str) -> Iterator[None]:
    """Jobs that run within carry the tags, by which they are found and can be cancelled."""
    before = spark.sparkContext.getLocalProperty("spark.job.description")
    for n in names:
        spark.addTag(n)
    spark.sparkContext.setLocalProperty("spark.job.description", ", ".join(names))
    try:
        yield
    finally:
        for n in names:
            spark.removeTag(n)
        spark.sparkContext.setLocalProperty("spark.job.description", before)


def capture(sql: str, kind: str = "query", column: str | None = None, **args: Any) -> CommandPlan:
    if kind not in _TERMINALS:
        raise ValueError(f"{kind} is none of {', '.join(_TERMINALS)}")
    if (column is None) != ("{column}" not in _TERMINALS[kind]):
        raise ValueError(f"{kind} takes {'no' if column else 'a'} column")
    return CommandPlan(kind, _TERMINALS[kind].format(sql=sql.rstrip().rstrip(";"), column=column), args)


@contextmanager
def lifecycle(name: str, **facts: Any) -> Iterator[dict[str, Any]]:
    """Logs a step's start and its end or failure, with what the caller puts into the yielded dict (row counts)."""
    began = time.monotonic()
    log.info("%s started %s", name, facts)
    try:
        yield facts
    except Exception as e:
        log.error("%s failed after %.3f s: %s", name, time.monotonic() - began, e)
        raise
    log.info("%s completed in %.3f s %s", name, time.monotonic() - began, facts)


def catalog(spark: SparkSession) -> list[dict[str, Any]]:
    """Tables and views with their columns, as a model can be scaffolded from."""
    out = []
    for t in spark.catalog.listTables():
        columns = [{"name": c.name, "type": c.dataType, "nullable": c.nullable, "partition": c.isPartition} for c in spark.catalog.listColumns(t.name)]
        out.append({"name": t.name, "temporary": t.isTemporary, "kind": t.tableType, "columns": columns})
    return sorted(out, key=lambda t: t["name"])
