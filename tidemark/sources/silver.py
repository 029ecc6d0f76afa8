"""Silver: Parquet under event_date=/event_hour=, with quarantine and late rows beside it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.functions.hours import Hour, as_hour, days_of, in_hours
from tidemark.functions.keys import check_hour, parse_day
from tidemark.operators.bitmaps import id_bitmaps
from tidemark.operators.silver import dedupe, row_kind
from tidemark.schemas import (
    HOUR_COLUMNS,
    QUARANTINE,
    RAW_TEXT,
    SILVER,
    SILVER_REQUIRED,
    SILVER_WITH_SOURCE,
    SOURCE_COLUMNS,
)
from tidemark.sources.swaps import folders, leaf_of
from tidemark.sources.tables import (
    list_partitions,
    read_folders,
    read_table,
    replace_partitions,
    stage,
)

@dataclass(frozen=True)
class SilverPaths:
    """Valid rows by event hour; bad rows by the hour file they came from; late rows by both."""

    events: str
    quarantine: str
    late: str


def silver_partition(day: str | date, hour: int) -> str:
    """Partition folder of an hour; silver does not pad the hour."""
    return f"event_date={parse_day(day).isoformat()}/event_hour={check_hour(hour)}"


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, SILVER)


def read_silver_hour(spark: SparkSession, root: str, day: str | date, hour: int) -> DataFrame:
    return read_silver_hours(spark, root, [as_hour(day, hour)])


def read_silver_hours(spark: SparkSession, root: str, hours: Sequence[Hour]) -> DataFrame:
    table = read_table(spark, root, SILVER, "event_date", days_of(hours))
    return table.where(in_hours(hours, HOUR_COLUMNS))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rows of a silver table whose timestamp could not be parsed."""
    return read_silver(spark, root).where("event_date IS NULL")


LATE_COLUMNS = ["event_date", *SOURCE_COLUMNS]


def read_late(
    spark: SparkSession, path: str, received: Sequence[Hour] = (), sent: Sequence[Hour] = ()
) -> DataFrame:
    """Late rows that belong to the hours ``received``, or came in the files of the hours ``sent``.

    The table is partitioned by the day of the event, then by the hour file, so only the folders of
    either are listed.
    """
    folders = [f"event_date={day.isoformat()}" for day in sorted(days_of(received))]
    taken = set(folders)
    if sent:
        days = ",".join(sorted(day.isoformat() for day in days_of(sent)))
        found = list_partitions(spark, f"{path}/*/source_date={{{days}}}", LATE_COLUMNS, base=path)
        named = {f"event_date={r.event_date}/source_date={r.source_date}" for r in found}
        folders += sorted(n for n in named if n.split("/")[0] not in taken)
    table = read_folders(spark, path, SILVER_WITH_SOURCE, folders)
    return table.where(in_hours(received, HOUR_COLUMNS) | in_hours(sent, SOURCE_COLUMNS))


def write_silver(events: DataFrame, root: str) -> None:
    """Replace the event hours that ``events`` has rows for; rows without a time share one."""
    replace_partitions(events.select(*SILVER.fieldNames()), root, HOUR_COLUMNS)


def write_silver_hours(
    events: DataFrame, paths: SilverPaths, hours: Sequence[Hour]
) -> list[Hour]:
    """Write what the given hour files yielded, so that any re-run ends in the same tables.

    Returns the event hours that were rewritten.

    ``events`` are transformed rows with their source columns. A row may fall outside its file's
    hour. Such late rows are kept apart by source and merged into the hour they belong to, here
    and whenever that hour is written again, so neither run can wipe out the other's rows.
    """
    spark = events.sparkSession
    staged = stage(row_kind(events), "silver", ["row_kind"])
    rows = {
        kind: staged.where(F.col("row_kind") == kind).drop("row_kind")
        for kind in ("own", "late", "bad")
    }
    bad = rows["bad"] if RAW_TEXT in staged.columns else rows["bad"].withColumn(RAW_TEXT, F.lit(None).cast("string"))
    replace_partitions(
        bad.select(*QUARANTINE.fieldNames()), paths.quarantine, SOURCE_COLUMNS, owned=_partitions(hours, SOURCE_COLUMNS)
    )
    replace_partitions(
        rows["late"].select(*SILVER_WITH_SOURCE.fieldNames()),
        paths.late,
        LATE_COLUMNS,
        owned=_late_partitions(spark, paths.late, hours),
    )

    # calendar hours, not rows: bounded by the calendar
    targets = rows["late"].select(*HOUR_COLUMNS).distinct().collect()
    sent = {(r.event_date, r.event_hour) for r in targets}
    others = sorted(sent - set(hours))
    late = read_late(spark, paths.late, received=[*hours, *others])
    if late.isEmpty():
        content = rows["own"].select(*SILVER.fieldNames())
    else:
        existing = read_silver_hours(spark, paths.events, others)
        parts = [rows["own"], late, existing]
        picked = [p.select(*SILVER.fieldNames()) for p in parts]
        content = stage(dedupe(picked[0].unionByName(picked[1]).unionByName(picked[2])), "merged")
    replace_partitions(content, paths.events, HOUR_COLUMNS, owned=_partitions(hours, HOUR_COLUMNS))
    return sorted({*hours, *others})


def _partitions(hours: Sequence[Hour], columns: Sequence[str]) -> list[Row]:
    """What a run of these hours owns: what an earlier run filled and this one does not is emptied."""
    day, hour = columns
    return [Row(**{day: d.isoformat(), hour: h}) for d, h in hours]


def _late_partitions(spark: SparkSession, path: str, hours: Sequence[Hour]) -> list[str]:
    """The same for late rows, whose hour files lie under several event days."""
    days = ",".join(sorted(day.isoformat() for day in days_of(hours)))
    wanted = tuple(leaf_of(row) for row in _partitions(hours, SOURCE_COLUMNS))
    found = folders(spark, path, ["event_date=*", f"source_date={{{days}}}", "source_hour=*"])
    return [folder for folder in found if folder.endswith(wanted)]


ID_BITMAPS = StructType(
    [
        StructField("event_date", DateType()),
        StructField("event_hour", IntegerType()),
        StructField("total_rows", LongType()),
        StructField("bucket", LongType()),
        StructField("bits", BinaryType()),
        StructField("other_ids", ArrayType(StringType())),
    ]
)


def write_bitmaps(silver: DataFrame, path: str, hours: Sequence[Hour] = ()) -> None:
    """Keep the id bitmaps of the hours that ``silver`` has rows for, in place of theirs from before; an hour of
    ``hours`` without rows is left with none."""
    replace_partitions(id_bitmaps(silver), path, HOUR_COLUMNS, owned=_partitions(hours, HOUR_COLUMNS))


def read_bitmaps(spark: SparkSession, path: str, hours: Sequence[Hour] | None = None) -> DataFrame:
    """Stored bitmaps, of some hours or of all."""
    if hours is None:
        return read_table(spark, path, ID_BITMAPS)
    table = read_table(spark, path, ID_BITMAPS, "event_date", days_of(hours))
    return table.where(in_hours(hours, HOUR_COLUMNS))


def loaded_hours(spark: SparkSession, table: str, hours: Sequence[Hour]) -> set[Hour]:
    """Which of the given hours the warehouse table has."""
    if not hours:
        return set()
    found = list_partitions(spark, table, HOUR_COLUMNS, days_of(hours))
    return {as_hour(r.event_date, int(r.event_hour)) for r in found} & set(hours)


def _require(column: str) -> Column:
    fail = F.raise_error(F.lit(f"required column {column} is NULL"))
    return F.coalesce(F.col(column), fail).alias(column)


def load_hours(silver: DataFrame, table: str, hours: Sequence[Hour]) -> None:
    """Load hours into the warehouse table, replacing only those hours.

    A NULL in a required column, or a row of another hour, fails the write job itself; the
    table is then left as it was.
    """
    in_scope = in_hours(hours, HOUR_COLUMNS)
    outside = F.raise_error(F.lit("row outside the hours being loaded"))
    columns = [
        _require(f.name) if f.name in SILVER_REQUIRED else F.col(f.name) for f in SILVER.fields
    ]
    derived = silver.withColumn("event_date", F.to_date("created_at")).withColumn(
        "event_hour", F.hour("created_at")
    )
    checked = derived.select(*columns).withColumn(
        "event_hour", F.when(in_scope, F.col("event_hour")).otherwise(outside.cast("int"))
    )
    replace_partitions(checked, table, HOUR_COLUMNS)
