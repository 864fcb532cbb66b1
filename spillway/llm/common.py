"""What the training-data operators share: table reading, shared scratch tables, word rules."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than these six (space, tab, LF, VT, FF, CR).
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Scratch tables by path, with their session and their owner; who owns those written now.
_written: dict[str, tuple[SparkSession, str | None]] = {}
_owner: list[str | None] = [None]
#: Which of them a DataFrame of materialize() reads.
_read: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset and all tasks run in this machine's one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        own = spark.sparkContext.getCheckpointDir()
        if not own and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = own or "file://" + tempfile.mkdtemp(prefix="spillway-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder, removed by release(), by its owner's release_scratch(), or when the program ends."""
    path = f"{shared_dir(spark)}/spillway-{os.getpid()}-{uuid.uuid4().hex[:12]}-{name}"
    _written[path] = (spark, _owner[-1])
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df as a table in the shared folder and reads it back. A lost executor costs only its own running tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _read[table] = path
    return table


def discard(table: DataFrame) -> None:
    """Deletes the scratch table that materialize() returned. DataFrames that still read it must not be used afterwards."""
    _delete(_read.pop(table), table.sparkSession)


@contextmanager
def owning(owner: str) -> Iterator[None]:
    """Scratch tables that are written within belong to the owner, who can delete them without touching anyone else's."""
    _owner.append(owner)
    try:
        yield
    finally:
        _owner.pop()


def release_scratch(owner: str) -> None:
    """Deletes the owner's scratch tables. DataFrames that still read them must not be used afterwards."""
    for path, (spark, whose) in list(_written.items()):
        if whose == owner:
            _delete(path, spark)


def trim_driver(spark: SparkSession) -> None:
    """Gives back what the driver holds of work that is done: Python's and Arrow's free memory, and in the JVM garbage with the broadcasts and shuffles that hang on it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
    spark._jvm.System.gc()


def release() -> None:
    """Deletes every scratch table written so far."""
    for path, (spark, _) in list(_written.items()):
        _delete(path, spark)


def _delete(path: str, spark: SparkSession) -> None:
    _written.pop(path, None)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _at_exit() -> None:
    try:
        release()
    except Exception:  # noqa: BLE001  nothing can be done about it any more
        pass


# -- what Python workers keep -------------------------------------------------------------------------------------------
_caches: list[dict] = []
_holder: list[str | None] = [None]


def worker_cache() -> dict:
    """A module's cache in a Python worker, which lives from task to task; emptied once another operator's tasks come."""
    _caches.append({})
    return _caches[-1]


def holds(operator: str) -> None:
    """Said by an operator's tasks as they begin: what other operators' tasks kept in this worker goes, back to the system too, so that workers which serve one operator after another need no more memory than the largest of them."""
    if _holder[0] == operator:
        return
    _holder[0] = operator
    for cache in _caches:
        cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries have no such call
        pass


def words(text: Column) -> Column:
    """The words of a text, in order (null: none)."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that extra columns of any name cannot clash with the operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def set_aside(df: DataFrame, *prefixes: str) -> DataFrame:
    """df with its columns that begin like an operator's own renamed, in place; toDF(*df.columns) puts the names back."""
    taken = {c.lower() for c in df.columns}
    names = []
    for i, c in enumerate(df.columns):
        if c.lower().startswith(prefixes):
            c = f"aside{i}"
            while c in taken:
                c += "_"
        names.append(c)
    return df.toDF(*names)
