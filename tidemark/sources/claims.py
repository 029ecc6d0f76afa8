"""Claims on partitions that are to be written once, by whichever writer comes first.

A claim is an entry in a hidden folder of the table that can be made once: a folder on a local file system, where
making one fails if it is there, a file made without overwriting elsewhere. It goes when its writer has ended, well or
not. That of a writer that died stays; it is broken when it is older than ``STALE_MS``.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.session import file_system

CLAIMS = "_claims"
STALE_MS = 6 * 3600 * 1000

Claimed = TypeVar("Claimed")


def _claim_path(root: str, name: str) -> str:
    return f"{root}/{CLAIMS}/{name.replace('/', ',').replace('=', '-')}"


def _make(fs, at, spark: SparkSession) -> bool:
    if fs.getUri().getScheme() == "file":
        return spark._jvm.java.io.File(at.toUri().getPath()).mkdir()
    try:
        fs.create(at, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def claim(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the claim is ours now; of any number of callers one gets it. The folder of claims must be there."""
    path = _claim_path(root, name)
    fs, at = file_system(spark, path)
    if _make(fs, at, spark):
        return True
    if not fs.exists(at) or fs.getFileStatus(at).getModificationTime() > time.time() * 1000 - STALE_MS:
        return False
    # its writer died; of two that find that out the rename lets one through
    _, broken = file_system(spark, f"{path}-broken-{time.time_ns()}")
    if not fs.rename(at, broken):
        return False
    fs.delete(broken, True)
    return _make(fs, at, spark)


def release(spark: SparkSession, root: str, name: str) -> None:
    fs, at = file_system(spark, _claim_path(root, name))
    fs.delete(at, True)


@contextmanager
def claimed(spark: SparkSession, root: str, wanted: Mapping[str, Claimed]) -> Iterator[list[Claimed]]:
    """What could be claimed of ``wanted``, by name, while the block runs."""
    held: dict[str, Claimed] = {}
    if wanted:
        fs, at = file_system(spark, f"{root}/{CLAIMS}")
        fs.mkdirs(at)
    try:
        for name, value in wanted.items():
            if claim(spark, root, name):
                held[name] = value
        yield list(held.values())
    finally:
        for name in held:
            release(spark, root, name)
