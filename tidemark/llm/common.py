"""What the operators share: picking columns, row-wise Arrow maps, tables staged in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tidemark.session import scratch_path

# Rows turned into Python objects at a time, inside an Arrow batch.
ROWS_AT_ONCE = 256

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once in an application.

    The driver may have found it through its working folder or ``sys.path``, which executors do not
    share. Spark itself hands the archive out.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tidemark-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` with the package on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names. All other columns, whatever their names, are left out."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that no later job repeats the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key() -> Column:
    """Hash that tells texts of the same doc_id apart; rows equal in both are the same document."""
    return F.xxhash64("text")


def map_rows(
    df: DataFrame,
    start: Callable[[], Callable[..., Sequence]],
    schema: str,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Row-wise Python over Arrow batches.

    ``start`` runs once per task and returns the function of a row: it gets the values of the columns
    that are not in ``keep`` and returns those of ``schema``. The columns in ``keep`` pass unchanged.
    A batch becomes Python objects a few rows at a time, so that memory holds few texts at once.
    """
    made = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(made)
    # numbered names inside: a caller's names may hold dots or be equal to new ones
    inputs = [i for i, c in enumerate(df.columns) if c not in keep]
    kept = [df.columns.index(c) for c in keep]
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    names = [f"c{i}" for i in kept] + [f"m{i}" for i in range(len(made))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_row = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = zip(*[part.column(i).to_pylist() for i in inputs])
                columns = list(zip(*[of_row(*row) for row in rows]))
                arrays = [pa.array(v, t) for v, t in zip(columns, arrow.types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in kept] + arrays, names)

    fields = [StructField(f"c{i}", df.schema[i].dataType) for i in kept]
    fields += [StructField(f"m{i}", f.dataType) for i, f in enumerate(made)]
    mapped = map_batches(numbered, run, StructType(fields))
    return mapped.toDF(*[df.columns[i] for i in kept], *made.names)
