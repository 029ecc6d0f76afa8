"""Which days an event id has been on: an index beside the fact, cut into blocks of ids.

Ids are handed out in rising order, so the ids of an hour lie close together; a block is a range of them, and a
lookup reads the few blocks that the incoming ids fall in, whatever the fact's size. Ids that are no numbers go
to blocks by a hash. The index holds every pair of id and day that the fact has. It may hold more, as it is written
before the fact: a pair too many only makes an upsert look at a day in vain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tidemark.session import file_system
from tidemark.sources.swaps import finish_swaps
from tidemark.sources.tables import read_table_folders, replace_partitions, replace_table

# Ids of a block: some 20 hours of events. A block is rewritten whole when it gets new ids.
BLOCK_IDS = 1 << 22
HASHED_BLOCKS = 256

IDS = StructType(
    [
        StructField("event_id", StringType()),
        StructField("event_date", DateType()),
        StructField("id_block", StringType()),
    ]
)


def ids_path(fact_path: str) -> str:
    return f"{fact_path}_ids"


def id_block(event_id: str | Column = "event_id") -> Column:
    number = F.col(event_id).try_cast("bigint") if isinstance(event_id, str) else event_id.try_cast("bigint")
    hashed = F.pmod(F.xxhash64(event_id), F.lit(HASHED_BLOCKS))
    ranged = F.concat(F.lit("n"), F.floor(number / BLOCK_IDS).cast("string"))
    return F.coalesce(ranged, F.concat(F.lit("h"), hashed.cast("string")))


def pairs_of(rows: DataFrame) -> DataFrame:
    """(event_id, event_date, id_block) of rows with an id."""
    known = rows.where("event_id IS NOT NULL AND event_date IS NOT NULL")
    return known.select("event_id", "event_date", id_block().alias("id_block"))


def has_index(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def drop_index(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def build_index(rows: DataFrame, path: str) -> None:
    """The index of all these rows, in place of any other."""
    replace_table(pairs_of(rows), path, ["id_block"], ["event_id"])


def read_blocks(spark: SparkSession, path: str, blocks: list[str]) -> DataFrame:
    return read_table_folders(spark, path, IDS, "id_block", blocks)


def blocks_of(pairs: DataFrame) -> list[str]:
    """Names of blocks, of which there are as many as ranges of ids: 1 for each 4 million, and 256."""
    return sorted(r.id_block for r in pairs.select("id_block").distinct().collect())


def known_days(spark: SparkSession, path: str, pairs: DataFrame, blocks: list[str]) -> DataFrame:
    """(event_id, event_date): days that incoming ids are known on, from their blocks alone."""
    incoming = pairs.select("event_id")
    return read_blocks(spark, path, blocks).join(incoming, "event_id", "left_semi").select("event_id", "event_date")


def add_pairs(spark: SparkSession, path: str, pairs: DataFrame, blocks: list[str]) -> list[str]:
    """Take new pairs into the index; only blocks that get any are rewritten. Returns those."""
    finish_swaps(spark, path, 1)
    known = read_blocks(spark, path, blocks)
    new = pairs.join(known, ["event_id", "event_date"], "left_anti")
    grown = blocks_of(new)
    if not grown:
        return []
    whole = read_blocks(spark, path, grown).unionByName(new.select(*IDS.fieldNames()))
    replace_partitions(whole, path, ["id_block"], ["event_id"])
    return grown
