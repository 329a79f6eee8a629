"""Paths on whatever file system the topic root lives on, through Spark's own Hadoop client."""

from __future__ import annotations

import uuid

from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds."""
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def is_empty(spark: SparkSession, path: str) -> bool:
    """True when the folder is missing or holds nothing but the marker of an empty write."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return True
    return all(entry.getPath().getName() == "_SUCCESS" for entry in fs.listStatus(target))


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file. Fails where the file exists, so of two writers only one gets it."""
    fs, target = _resolve(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, or None where there is none."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; nothing for a missing one."""
    fs, target = _resolve(spark, path)
    return sorted(entry.getPath().getName() for entry in fs.listStatus(target)) if fs.exists(target) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Files at any depth below a folder, by their paths from there, in order; nothing for a missing one."""
    return sorted(name for name, _ in file_times(spark, path))


def file_times(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """Files at any depth below a folder, by their paths from there, each with the time of its last change in epoch ms."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return
    top = fs.getFileStatus(target).getPath().toUri().getPath().rstrip("/") + "/"
    files = fs.listFiles(target, True)
    while files.hasNext():
        status = files.next()
        yield status.getPath().toUri().getPath().removeprefix(top), status.getModificationTime()


def first_files(spark: SparkSession, path: str, most: int, ending: str) -> list[str]:
    """Up to ``most`` files with that ending below a folder, in the order in which they are listed; no more are listed than
    it takes."""
    fs, target = _resolve(spark, path)
    found: list[str] = []
    if fs.exists(target):
        files = fs.listFiles(target, True)
        while len(found) < most and files.hasNext():
            name = files.next().getPath().toString()
            if name.endswith(ending):
                found.append(name)
    return found


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, as the file system adds them up; 0 for a missing one."""
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file to a new path, whose folders are made. Fails where the target exists."""
    fs, old = _resolve(spark, source)
    _, new = _resolve(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise FileExistsError(f"cannot move {source} to {target}")


def size_in_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes that the files hold together."""
    total = 0
    for path in paths:
        fs, target = _resolve(spark, path)
        total += fs.getFileStatus(target).getLen()
    return total


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path, not there yet, under :func:`scratch_base`; what is written there goes when the session's JVM ends.

    Every call gives another path, so runs never see each other's files.
    """
    folder = join(scratch_base(spark), f"{purpose}-{uuid.uuid4().hex}")
    make_dir(spark, folder)
    fs, target = _resolve(spark, folder)
    fs.deleteOnExit(target)
    return join(folder, "data")


def scratch_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting uses its warehouse folder; on a cluster the missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")


def need_microsecond_timestamps(spark: SparkSession) -> None:
    """See that Parquet timestamps are written as microseconds, which have the statistics that let time filters skip
    row groups. The setting is the session's and stays: set and restored around each write, it would be undone by
    another write of the session that ends in between.
    """
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
