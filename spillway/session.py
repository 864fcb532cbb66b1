"""The session that the engine expects: UTC, ANSI, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "spillway", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above. On a cluster the shuffle partitions should be two to three times its cores; AQE joins small ones."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def configure(spark: SparkSession, memory: str | None = None, search_path: str | None = None, threads: int | None = None) -> dict[str, str]:
    """Engine settings by their usual names, on a running session. memory bounds what a broadcast may take, threads the shuffle partitions, search_path where relative files are looked for."""
    wanted = {}
    if memory:
        wanted["spark.sql.autoBroadcastJoinThreshold"] = memory
    if threads:
        wanted["spark.sql.shuffle.partitions"] = str(threads)
    if search_path:
        wanted["spark.spillway.search.path"] = search_path
    for k, v in wanted.items():
        spark.conf.set(k, v)
    return wanted
