"""Small text files and listings in any file system that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = _at(spark, path)
    return system.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    system, p = _at(spark, path)
    stream = system.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Without overwrite an existing file makes this fail, which is how two writers of one version are told apart."""
    system, p = _at(spark, path)
    stream = system.create(p, overwrite)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Makes a whole file or none; FileExistsError if it is there already, which is how two writers of one version are told apart."""
    system, p = _at(spark, path)
    if system.exists(p):
        raise FileExistsError(path)
    scheme = system.getUri().getScheme()
    if scheme not in ("file", "hdfs", "viewfs"):  # object stores show a file once it is closed
        try:
            return write_text(spark, path, text)
        except Exception as e:
            if system.exists(p):
                raise FileExistsError(path) from e
            raise
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, temp, text)
    t = spark._jvm.org.apache.hadoop.fs.Path(temp)
    try:
        if scheme == "file":  # a rename would replace the other writer's file, a link does not
            local = lambda x: spark._jvm.java.io.File(x.toUri().getPath()).toPath()
            spark._jvm.java.nio.file.Files.createLink(local(p), local(t))
        elif not system.rename(t, p):
            raise FileExistsError(path)
    except FileExistsError:
        raise
    except Exception as e:
        if system.exists(p):
            raise FileExistsError(path) from e
        raise
    finally:
        if system.exists(t):
            system.delete(t, False)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    system, p = _at(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(p)) if system.exists(p) else []


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """When a file or folder was changed last, and its length."""
    system, p = _at(spark, path)
    status = system.getFileStatus(p)
    return status.getModificationTime(), status.getLen()


def sizes(spark: SparkSession, files: list[str]) -> dict[str, int]:
    """Files' lengths in bytes."""
    out = {}
    for f in files:
        system, p = _at(spark, f)
        out[f] = system.getFileStatus(p).getLen()
    return out


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """All files below path, hidden folders' included."""
    system, p = _at(spark, path)
    if not system.exists(p):
        return []
    found, it = [], system.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().toString()
        if name.endswith(suffix):
            found.append(name)
    return sorted(found)


def delete(spark: SparkSession, path: str) -> bool:
    system, p = _at(spark, path)
    return system.delete(p, True)
