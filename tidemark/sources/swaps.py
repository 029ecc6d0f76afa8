"""Partition swaps that survive the driver that began them.

New partitions are written whole beside the old ones, in a hidden folder of the table, together with the names
of those to be emptied. Renaming that folder is the decision: from then on the swap is pending, and whoever
writes to the table next finishes it, however far it came. Each partition is then moved by two renames, old
one out, new one in. A folder that was never decided is thrown away once it is a day old.

One call writes to a table's partition at a time, as the hourly schedule does; different partitions may be
written by different calls.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark.session import file_system

# Hidden from Spark's readers by the first character.
WRITING, PENDING = "_writing-", "_swap-"
ABANDONED_MS = 24 * 3600 * 1000
# The folder Spark gives to a NULL partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def leaf_of(values: Row) -> str:
    """Folder of a partition below its table."""
    return "/".join(f"{c}={NO_VALUE if v is None else v}" for c, v in values.asDict().items())


def write_swap(
    rows: DataFrame, path: str, columns: Sequence[str], owned: Iterable[Row | str] = ()
) -> str:
    """Stage the partitions of ``rows`` and decide the swap; returns the pending folder.

    Partitions of ``owned``, by values or folder, that ``rows`` has nothing for are to be emptied.
    """
    spark = rows.sparkSession
    name = uuid4().hex
    entry = f"{path}/{WRITING}{name}"
    rows.write.partitionBy(*columns).parquet(f"{entry}/rows")
    fs, at = file_system(spark, entry)
    written = set(_leaves(spark, f"{entry}/rows", len(columns)))
    for leaf in sorted({o if isinstance(o, str) else leaf_of(o) for o in owned} - written):
        if fs.exists(_path(spark, f"{path}/{leaf}")):
            fs.mkdirs(_path(spark, f"{entry}/emptied/{leaf}"))
    pending = f"{path}/{PENDING}{name}"
    if not fs.rename(at, _path(spark, pending)):
        raise OSError(f"cannot decide the swap at {pending}")
    return pending


def finish_swap(spark: SparkSession, path: str, pending: str, depth: int) -> list[str]:
    """Move every partition of a pending swap that was not moved yet; returns the folders moved or emptied now."""
    done = []
    for kind in ("rows", "emptied"):
        for leaf in _leaves(spark, f"{pending}/{kind}", depth):
            _take_place(spark, path, pending, kind, leaf)
            done.append(leaf)
    fs, at = file_system(spark, pending)
    fs.delete(at, True)
    return sorted(done)


def _take_place(spark: SparkSession, path: str, pending: str, kind: str, leaf: str) -> None:
    fs, new = file_system(spark, f"{pending}/{kind}/{leaf}")
    place, out = _path(spark, f"{path}/{leaf}"), _path(spark, f"{pending}/out/{leaf}")
    if fs.exists(place):
        fs.mkdirs(out.getParent())
        if fs.exists(out):
            fs.delete(out, True)
        if not fs.rename(place, out):
            raise OSError(f"cannot move the old partition at {place}")
    if kind == "emptied":
        fs.delete(new, True)
        return
    fs.mkdirs(place.getParent())
    if not fs.rename(new, place):
        raise OSError(f"cannot put the new partition in place at {place}")


def finish_swaps(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Finish what earlier writers of the table left pending."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    done = []
    for status in sorted(fs.listStatus(at), key=lambda s: s.getModificationTime()):
        name = status.getPath().getName()
        if name.startswith(PENDING):
            done += finish_swap(spark, path, f"{path}/{name}", depth)
        elif name.startswith(WRITING) and status.getModificationTime() < time.time() * 1000 - ABANDONED_MS:
            fs.delete(status.getPath(), True)
    return done


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _leaves(spark: SparkSession, root: str, depth: int) -> list[str]:
    return folders(spark, root, ["*=*"] * depth)


def folders(spark: SparkSession, root: str, pattern: Sequence[str]) -> list[str]:
    """Partition folders below ``root`` that match the pattern, which has one part for each level."""
    depth = len(pattern)
    fs, _ = file_system(spark, root)
    found = fs.globStatus(_path(spark, f"{root}/{'/'.join(pattern)}")) or []
    names = [[status.getPath()] for status in found]
    for parts in names:
        while len(parts) < depth:
            parts.append(parts[-1].getParent())
    return sorted("/".join(p.getName() for p in reversed(parts)) for parts in names)
