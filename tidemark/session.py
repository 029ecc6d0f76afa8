"""Session settings the library relies on, and the shared folder for staged tables."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# File bytes one shuffle partition is meant to hold.
BYTES_PER_PARTITION = 256 * 1024 * 1024

_scratch_roots: dict[str, str] = {}
_scopes: list[list[str]] = []
_written: dict[tuple[str, ...], tuple[int, str]] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that matter here; anything in ``conf`` wins over them."""
    settings = {
        # event_date and event_hour are UTC calendar parts of created_at
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone, for sessions this library did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def as_utc(moment: datetime) -> datetime:
    """The moment with its zone; one without a zone is taken as UTC, not as the driver's time."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def partitions_for(source: DataFrame, expansion: int = 1) -> int:
    """Shuffle partitions that suit the files behind ``source``, however many that takes.

    ``expansion`` is how much larger the rows are than the files, as with gzipped text.
    """
    statistics = source._jdf.queryExecution().optimizedPlan().stats()
    size = int(statistics.sizeInBytes()) * expansion
    return math.ceil(size / BYTES_PER_PARTITION)


@contextmanager
def shuffles_for(source: DataFrame, expansion: int = 1) -> Iterator[None]:
    """While the block runs its jobs, at least as many shuffle partitions as ``source`` needs.

    The session's own number holds again afterwards, so no query depends on what ran before it.
    Adaptive execution merges what turns out small.
    """
    spark, name = source.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), partitions_for(source, expansion))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object), for renaming and deleting folders without a Spark job."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application under the cluster's ``spark.checkpoint.dir``.

    Only a local session may go without that setting, or name a local folder; without it, it gets a
    temporary one. What is left in the folder is removed when the driver's JVM ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _scratch_roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if not is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            base = tempfile.mkdtemp(prefix="tidemark-")
            spark.sparkContext.setCheckpointDir(base)
        root = f"{base.rstrip('/')}/tidemark-{app}"
        fs, path = file_system(spark, root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _scratch_roots[app] = root
    return _scratch_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, for one staged table."""
    path = f"{scratch_root(spark)}/{name}-{uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was staged inside it. Frames read from there must be done with by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            fs, at = file_system(spark, path)
            fs.delete(at, True)


def written_once(
    spark: SparkSession, name: str, source: str, write: Callable[[str], object]
) -> str:
    """Path of a staged table that is written at its first use in this application.

    It is written again if ``source``, a folder or file, has another modification time by then.
    """
    fs, at = file_system(spark, source)
    changed = max([s.getModificationTime() for s in fs.listStatus(at)], default=0)
    key = (spark.sparkContext.applicationId, name, source)
    if key not in _written or _written[key][0] != changed:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = changed, path
    return _written[key][1]
