"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laneforge.sources.shared import shared_dir, stored

#: A word: a run of anything but space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a row's place in its file that rows numbered in one window may differ in.
CHUNK_BITS = 20
#: Rows of a few numbers that may be broadcast; more are joined as the planner sees fit.
BROADCAST_ROWS = 100_000


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder; later reads need neither its lineage nor a given executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def addressed(docs: DataFrame, is_table: bool = False) -> tuple[DataFrame, list[str]]:
    """``docs`` with two columns that tell its rows apart, alike at every read, and the columns' names.

    They hold a hash of the path of the row's file and the row's place in that file, so it doesn't
    matter how a read is split into tasks. ``is_table`` says that ``docs`` is a read of files with selects
    and filters at most. Anything else is written to the shared folder first and read from there.
    """
    if not is_table:
        docs = stored(docs)
    names = [unused(docs, "_file"), unused(docs, "_at")]
    place = docs.metadataColumn("_metadata")
    return docs.select("*", F.xxhash64(place["file_path"]).alias(names[0]), place["row_index"].alias(names[1])), names


def numbered_within(rows: DataFrame, group: str, name: str, keys: list[str]) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2 and so on within each group, in order of the address ``keys``.

    Rows of a part of a file are numbered together, after those of the parts before, so no task
    has to hold or sort a whole group however large it is.
    """
    file, at = keys
    parted = rows.withColumn("_chunk", F.shiftright(at, CHUNK_BITS))
    part = [group, file, "_chunk"]
    earlier = Window.partitionBy(group).orderBy(file, "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = parted.groupBy(*part).agg(F.count("*").alias("_n"))
    before = counts.select(*part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*part).orderBy(at)) - 1
    return parted.withColumn("_own", own).join(before, part).withColumn(name, F.col("_before") + F.col("_own")).drop("_chunk", "_own", "_before")


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` short rows, for a join: broadcast if that is few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join with rows that an ``explode`` made, which takes neither side to the driver.

    Spark sizes such rows by what went into the ``explode``, as if each gave one, and would broadcast them however many they are.
    """
    return df.hint("merge")


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or that with underscores before it, so that it is no column of ``docs``."""
    while name.lower() in map(str.lower, docs.columns):
        name = f"_{name}"
    return name


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc32(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes, unsigned; a null text counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
