"""Publishing versions: readers see all tables of one build, or all of the one before."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from meterlake.sources.tables import (
    CURRENT,
    FACTS,
    HOME,
    READINGS,
    SOURCES,
    UNITS,
    pointers,
    published_version,
    version_table,
)
from meterlake.staging import remove

_VERSION = "version-"
_ANY = object()


def new_version(gold_dir: str) -> str:
    return f"{gold_dir.rstrip('/')}/{_VERSION}{uuid.uuid4().hex}"


def publish(
    spark: SparkSession, gold_dir: str, version: str, *, after: str | None | object = _ANY
) -> None:
    """Point readers to ``version``; versions but this and the one before are deleted.

    Every version has a pointer of its own, with the next number. It is written under another
    name and put in place by renaming, so readers see the one before or a whole new one, on
    every file system; if another build has taken the number, this one fails. ``after`` names
    the version that this one was made from (None: the first): if readers see another one by
    now, this one fails too, as it would undo the other.
    """
    root = gold_dir.rstrip("/")
    old = pointers(spark, root)
    before = published_version(spark, root)
    if after is not _ANY and before != after:
        raise RuntimeError(f"{root}: another build was published meanwhile")
    number = int(old[-1].removeprefix(CURRENT)) + 1 if old else 1
    path = spark._jvm.org.apache.hadoop.fs.Path
    pointer = path(f"{root}/{CURRENT}{number:012}")
    files = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = path(f"{root}/_pointer-{uuid.uuid4().hex}")
    written = files.create(beside, False)
    written.write(bytearray(version.removeprefix(f"{root}/").encode()))
    written.close()
    if files.exists(pointer) or not files.rename(beside, pointer):
        files.delete(beside, False)
        raise RuntimeError(f"{root}: another build was published meanwhile")
    for name in old[:-1]:
        files.delete(path(f"{root}/{name}"), False)
    _remove_unused(spark, files, root, [version, *([before] if before else [])])


def _names(spark: SparkSession, files, folder: str, prefix: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not files.exists(target):
        return []
    found = [status.getPath().getName() for status in files.listStatus(target)]
    return [name for name in found if name.startswith(prefix)]


def _remove_unused(spark: SparkSession, files, root: str, kept: list[str]) -> None:
    for name in _names(spark, files, root, _VERSION):
        if f"{root}/{name}" not in kept:
            remove(spark, f"{root}/{name}")
    for folder, table in ((FACTS, SOURCES), (READINGS, UNITS)):
        written = _names(spark, files, f"{root}/{folder}", f"{HOME}=")
        used = _homes(spark, kept, table) if written else set()
        for name in written:
            if name.removeprefix(f"{HOME}=") not in used:
                remove(spark, f"{root}/{folder}/{name}")


def _homes(spark: SparkSession, versions: list[str], table: str) -> set[str]:
    """Builds whose files the versions use; far fewer than there are files."""
    tables = [version_table(spark, version, table) for version in versions]
    return {
        row[0] for found in tables if found is not None for row in found.select(HOME).distinct().collect()
    }
