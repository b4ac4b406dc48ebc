"""Directory operations through the Hadoop file system, so any supported store works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _open(spark, source)
    _, target_path = _open(spark, target)
    # A rename onto a directory would move the source into it.
    if fs.exists(target_path):
        raise OSError(f"Could not move {source}: {target} exists")
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"Could not move {source} to {target}")


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files below ``source`` to the same places below ``target``; files there stay."""
    fs, folder = _open(spark, source)
    root = fs.makeQualified(folder).toString().rstrip("/")
    found, files = fs.listFiles(folder, True), []
    while found.hasNext():
        place = found.next().getPath().toString()
        inside = place[len(root) + 1 :]
        if not any(part.startswith(("_", ".")) for part in inside.split("/")):
            files.append((place, join(target, inside)))
    for place, moved in files:
        rename(spark, place, moved)


def join(*parts: str) -> str:
    head, *tail = parts
    return "/".join([head.rstrip("/"), *[p.strip("/") for p in tail if p]])


def sibling(path: str, kind: str) -> str:
    """A hidden directory next to ``path``; Spark ignores it when it lists the parent."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{kind}-{name}"


def staging_path(path: str) -> str:
    return f"{sibling(path, 'staging')}-{uuid.uuid4().hex}"


def readable(spark: SparkSession, path: str) -> str | None:
    """Where the data of ``path`` is now: between the two renames of a swap, the previous copy. Moves nothing."""
    return next((p for p in (path, sibling(path, "previous")) if exists(spark, p)), None)


def recover(spark: SparkSession, path: str) -> None:
    """Put the previous copy back if a swap was cut off between its two renames; for writers only."""
    previous = sibling(path, "previous")
    if not exists(spark, path) and exists(spark, previous):
        rename(spark, previous, path)


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Replace ``path`` by ``staged``; the old copy stays until the new one is in place."""
    previous = sibling(path, "previous")
    recover(spark, path)
    delete(spark, previous)
    if exists(spark, path):
        rename(spark, path, previous)
    try:
        rename(spark, staged, path)
    except Exception:
        recover(spark, path)
        raise
    delete(spark, previous)
    spark.catalog.refreshByPath(path)
