"""The archive as a stream: append what arrives, and watch how stale it is.

A micro-batch is written to folders of its own, named by the stream and the number of the batch, and moved
to its days when it is whole. So a batch that is run again after a failure replaces what it left, and
the archive is one for streams and batch writers: nothing beside its parts says which of them count.
Arrival order decides which of two copies stays here; the batch reader's order by part and row
stays the authority.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneforge.sources import archive, publish
from laneforge.sources.shared import Owner

#: Days before a batch's first in which the archive is looked through for matches that come again.
DELAY_DAYS = 1


def incoming(spark: SparkSession, folder: str, schema, files_at_once: int = 100) -> DataFrame:
    """Files of rows as they arrive, with each row's place."""
    return archive.with_position(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder))


def copies(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """The places of a batch's rows whose match is among ``known`` or comes earlier in the batch. A row without an id is no copy."""
    keys = batch.where(F.col("match_id").isNotNull()).select("match_id", "part", "part_row")
    again = archive.later_copies(keys)
    if known is None:
        return again
    seen = keys.join(known.select("match_id"), "match_id", "left_semi").select("part", "part_row")
    return again.unionByName(seen).distinct()


def append_batch(batch: DataFrame, number: int, root: str, source: str, stream: str, delay_days: int = DELAY_DAYS) -> None:
    """Appends a micro-batch without the copies of what is there; the same batch again replaces itself.

    Only ids and places are compared; the documents are not shuffled.
    """
    spark = batch.sparkSession
    name = f"stream-{stream}-{number:09d}"
    first = batch.agg(F.date_sub(F.min(F.to_date("fetched_at")), delay_days).cast("string")).first()[0]
    with Owner(spark) as owner:
        try:
            there = archive.read_archive(spark, root, source, since=first)
            known = there.where(~F.contains("part", F.lit(f"/{name}/")))
        except archive.ArchiveEmpty:
            known = None
        gone = owner.stored(copies(batch, known), "copies")
        publish.append_archive(batch.join(gone, ["part", "part_row"], "left_anti").drop("part", "part_row"), root, source, name)


def stream_archive(rows: DataFrame, root: str, source: str, checkpoint: str, delay_days: int = DELAY_DAYS):
    """Starts a query that appends to the archive what there is and then ends; started again, it goes on where it ended.

    ``rows`` come from ``incoming``. The stream is known by its checkpoint's path.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    write = lambda batch, number: append_batch(batch, number, root, source, stream, delay_days)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def staleness(rows: DataFrame, width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Rows and the newest fetch by hour of fetching; works on a stream and on a table."""
    watched = rows.withWatermark("fetched_at", delay) if rows.isStreaming else rows
    hours = watched.groupBy(F.window("fetched_at", width)).agg(F.count("*").alias("rows"), F.max("fetched_at").alias("newest"))
    return hours.select(F.col("window.start").alias("hour"), "rows", "newest")
