"""Partitioned Parquet tables: read, replace partitions, clear partitions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import file_system, scratch_path
from tidemark.sources.swaps import finish_swap, finish_swaps, write_swap

# Beside a table, while the one that replaces it takes its place.
OLD = "__old"


def _day_folders(path: str, column: str, days: Iterable[date]) -> str:
    return f"{path}/{column}={{{','.join(sorted(d.isoformat() for d in set(days)))}}}"


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    day_column: str | None = None,
    days: Iterable[date] = (),
) -> DataFrame:
    """The table with its declared types; a table nobody has written yet has no rows.

    With ``day_column``, the first partition column, only the folders of ``days`` are listed,
    which keeps a small job on a large table from listing all of it.
    """
    if not day_column:
        return _read(spark, path, schema, path)
    return read_table_folders(spark, path, schema, day_column, [d.isoformat() for d in days])


def read_table_folders(
    spark: SparkSession, path: str, schema: StructType, column: str, values: Iterable[str]
) -> DataFrame:
    """Those partitions of the table, by its only partition column; no other folder is listed."""
    names = sorted(set(values))
    if not names:
        return spark.createDataFrame([], schema)
    return _read(spark, path, schema, f"{path}/{column}={{{','.join(names)}}}")


def _read(spark: SparkSession, path: str, schema: StructType, *folders: str) -> DataFrame:
    """A table is also there while ``replace_table`` renames it: then the old one is read."""
    for base in (path, f"{path}{OLD}", path):
        at = [base + folder.removeprefix(path) for folder in folders]
        try:
            return spark.read.schema(schema).option("basePath", base).parquet(*at)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def read_folders(
    spark: SparkSession, path: str, schema: StructType, folders: Iterable[str]
) -> DataFrame:
    """Those of the partition folders, named relative to ``path``, that exist."""
    present = []
    for folder in folders:
        fs, at = file_system(spark, f"{path}/{folder}")
        if fs.exists(at):
            present.append(f"{path}/{folder}")
    if not present:
        return spark.createDataFrame([], schema)
    return _read(spark, path, schema, *present)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write to the shared scratch folder and read back, so that ``df`` is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    sort_by: Sequence[str] = (),
    owned: Iterable[Row | str] = (),
) -> list[str]:
    """Replace exactly the partitions that ``df`` has rows for, and empty those of ``owned``
    (by values or folder) that it has none for.

    Returns the folders that changed. ``df`` may read the table: it is written beside it before any partition
    goes (``swaps``), and a swap that an earlier call could not end is finished first.

    The rebalance brings each partition's rows together, and splits a partition that is too
    large for one task, so neither tiny files nor a single huge writer come out of it.
    """
    spark = df.sparkSession
    finish_swaps(spark, path, len(columns))
    rows = df.hint("rebalance", *columns)
    if sort_by:
        rows = rows.sortWithinPartitions(*columns, *sort_by)
    return finish_swap(spark, path, write_swap(rows, path, columns, owned), len(columns))


def replace_table(
    df: DataFrame, path: str, columns: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> None:
    """Replace the whole table.

    The rows are written beside the table first and take its place by renaming, so a write that
    fails leaves the table as it was, and ``df`` may read the table it replaces. A driver lost between
    the two renames leaves the old table beside; the next call puts it back before anything else.
    """
    spark = df.sparkSession
    fresh, old = f"{path}__new", f"{path}{OLD}"
    fs, at = file_system(spark, path)
    _, fresh_at = file_system(spark, fresh)
    _, old_at = file_system(spark, old)
    if fs.exists(old_at):
        if fs.exists(at):
            fs.delete(old_at, True)
        else:
            fs.rename(old_at, at)
    rows = df.hint("rebalance", *columns) if columns else df
    if sort_by:
        rows = rows.sortWithinPartitions(*columns, *sort_by)
    (
        rows.write.partitionBy(*columns)
        .option("partitionOverwriteMode", "static")
        .mode("overwrite")
        .parquet(fresh)
    )
    had = fs.exists(at)
    if had and not fs.rename(at, old_at) or not fs.rename(fresh_at, at):
        raise OSError(f"cannot put the new table in place at {path}")
    if had:
        fs.delete(old_at, True)


def read_mart(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table partitioned by date_key, with that column back in its declared type.

    With its ``schema`` also one without rows can be read, as a day without stars leaves it.
    """
    mart = read_table(spark, path, schema) if schema else spark.read.parquet(path)
    return mart.withColumn("date_key", F.col("date_key").cast("bigint"))


def save_as_table(df: DataFrame, name: str, path: str, columns: Sequence[str] = ()) -> None:
    """Replace a catalog table whose files live at ``path``."""
    df.write.mode("overwrite").partitionBy(*columns).option("path", path).saveAsTable(name)


def list_partitions(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    days: Iterable[date] = (),
    base: str | None = None,
) -> set[Row]:
    """Partition values on disk, as text, from a file listing; no file is opened.

    ``days`` narrows the listing to those values of the first column. ``path`` may be a pattern of
    folders below ``base``.
    """
    folders = _day_folders(path, columns[0], days) if days else path
    try:
        files = spark.read.format("binaryFile").option("basePath", base or path).load(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    if not set(columns) <= set(files.columns):
        return set()
    values = files.selectExpr(*[f"cast({c} as string) as {c}" for c in columns])
    return set(values.distinct().collect())
