"""Reading the archive: parts, positions, payloads, envelopes and one row for each match."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laneforge.functions.columns import as_int, as_long, parsed_json, patch_of, patch_order, slug, typed_json
from laneforge.sources import parts, schemas
from laneforge.sources.shared import folders, stored

#: How Spark names the folder of rows without a value to part by.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class ArchiveEmpty(ValueError):
    """A source of the archive has no part in the window."""


# ---- parts and windows -------------------------------------------------------------------


def canonical_date(text: str) -> date:
    """A date as YYYY-MM-DD and in no other spelling."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a date as YYYY-MM-DD: {text}")
    return date.fromisoformat(text)


def parts_of(spark: SparkSession, path: str, since: str | None = None) -> list[str]:
    """The day folders of a source from ``since`` on; a folder whose name is no date is an error. Rows without a day belong to no window."""
    found = []
    for folder in folders(spark, f"{path}/dt=*"):
        day = folder.rsplit("dt=", 1)[1]
        if day == NO_DAY:
            found += [] if since else [folder]
        elif not since or canonical_date(day) >= canonical_date(since):
            found.append(folder)
    return found


def read_archive(spark: SparkSession, root: str, source: str, since: str | None = None, schema: str = schemas.ARCHIVE) -> DataFrame:
    """The rows of ``root/source/dt=...`` from ``since`` on, with ``dt``, ``part`` and ``part_row``.

    Days before ``since`` are neither listed nor read. Parts that lack a column have it null, and parts that hold a
    whole number in 32 or in 64 bits are read alike: a number that the schema's own type can't hold is null.
    Days are named one by one, so what a stream's sink may have noted beside them doesn't hide a part.
    """
    path = f"{root}/{source}"
    days = parts_of(spark, path, since)
    if not days:
        raise ArchiveEmpty(f"no archive at {path}" + (f" since {since}" if since else ""))
    df = spark.read.schema(f"{schemas.widest(schema)}, dt DATE").option("basePath", path).parquet(*days)
    if since:
        df = df.where(F.col("dt") >= F.lit(canonical_date(since)))
    df = with_position(df)
    df = df.select(*(narrowed(df, c, kind) for c, kind in schemas.columns_of(schema)), "dt", "part", "part_row")
    if df.isEmpty():
        raise ArchiveEmpty(f"{source} has no rows since {since}")
    return df


def narrowed(df: DataFrame, column: str, kind: str) -> Column:
    return F.col(column) if df.schema[column].dataType.simpleString() == kind.lower() else F.col(column).try_cast(kind).alias(column)


def with_position(df: DataFrame) -> DataFrame:
    """Each row's file and its place in it, the address that stays the same from read to read."""
    return df.select("*", F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("part_row"))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A column ``payload`` with each line that is not empty."""
    return spark.read.text(path).where(F.length("value") > 0).select(F.col("value").alias("payload"))


def read_ladder_pages(spark: SparkSession, root: str) -> DataFrame:
    """Ladder pages, partitioned by date and region."""
    return parts.read_evolved(spark, f"{root}/league-v4")


def read_static_documents(spark: SparkSession, root: str) -> DataFrame:
    """Static documents, partitioned by date and kind."""
    return parts.read_evolved(spark, f"{root}/ddragon")


def read_accounts(spark: SparkSession, root: str) -> DataFrame:
    """Accounts, partitioned by date."""
    return parts.read_evolved(spark, f"{root}/account-v1")


def window_days(days: int) -> int:
    if not 1 <= days <= 400:
        raise ValueError("a window has 1 to 400 days")
    return days


def resolve_window(archive: DataFrame, days: int, end: str | None = None) -> DataFrame:
    """One row: the first and last day of a window that ends at ``end`` or at the newest partition."""
    last = F.lit(canonical_date(end)) if end else F.max("dt")
    return archive.agg(last.alias("last_day")).select(F.date_sub("last_day", window_days(days) - 1).alias("first_day"), "last_day")


def window_ending(end: str, days: int) -> tuple[str, str]:
    last = canonical_date(end)
    return str(last - timedelta(days=window_days(days) - 1)), str(last)


# ---- payloads ----------------------------------------------------------------------------


def parsed_as(payload: Column, schema: str) -> tuple[Column, Column, Column]:
    return typed_json(payload, schema, schemas.TYPED[schema]) if schema in schemas.TYPED else parsed_json(payload, schema)


def parse_summaries(archive: DataFrame, schema: str = schemas.SUMMARY, payload: bool = False, once: bool = False) -> DataFrame:
    """The archive's summaries as structs, beside their position (and their ``payload``, if asked for); null where the payload is no JSON.

    The parse is to the paths that are read; Spark leaves out those that a query does not use. A filter or a join on what the parse
    gives would repeat it for each field; with ``once`` it is a step of its own, which they don't.
    """
    keep = [c for c in ("region", "dt", "part", "part_row") if c in archive.columns]
    both, doc, valid = parsed_as(F.col("payload"), schema)
    out = [*keep, "payload"] if payload else keep
    return archive.select(*keep, "payload", (F.explode(F.array(both)) if once else both).alias("both")).select(*out, valid.alias("payload_valid"), doc.alias("doc"))


def envelope(parsed: DataFrame) -> DataFrame:
    """Keys of each summary beside its struct. A payload that is no JSON has them null and is still a row."""
    guarded = lambda c: F.when(F.col("payload_valid"), c)
    info = F.col("doc.info")
    return parsed.select(
        "*",
        guarded(F.col("doc.metadata.matchId")).alias("match_id"), guarded(info["gameVersion"]).alias("game_version"),
        guarded(info["platformId"]).alias("platform_id"), guarded(as_int(info["queueId"])).alias("queue_id"),
        guarded(as_long(info["gameCreation"])).alias("game_creation_ms"), guarded(array_size(info["participants"])).alias("participants"),
    )


def summary_envelope(parsed: DataFrame) -> DataFrame:
    """The envelope with patch, duration and how the game ended."""
    info = F.col("doc.info")
    guarded = lambda c: F.when(F.col("payload_valid"), c)
    return envelope(parsed).select(
        "*", patch_of(F.col("game_version")).alias("patch"), guarded(as_int(info["gameDuration"])).alias("game_duration_s"),
        guarded(info["endOfGameResult"]).alias("end_of_game_result"),
    )


def timeline_envelope(archive: DataFrame, schema: str = schemas.TIMELINE) -> DataFrame:
    """The archive's own columns of each timeline, its struct, and counts of frames and of participants' frames."""
    own = ("match_id", "region", "patch", "game_version", "queue_id", "game_creation_ms", "game_duration_s")
    keep = (*own, *(c for c in ("part", "part_row") if c in archive.columns))
    both, doc, valid = parsed_as(F.col("payload"), schema)
    parsed = archive.select(*keep, "payload", both.alias("both")).select(*keep, valid.alias("payload_valid"), doc.alias("doc"))
    frames = F.col("doc.info.frames")
    players = F.aggregate(frames, F.lit(0).cast("bigint"), lambda n, f: n + F.coalesce(F.size(F.map_keys(f["participantFrames"])), F.lit(0)))
    guarded = lambda c: F.when(F.col("payload_valid"), c)
    return parsed.select(
        "*", F.col("region").alias("platform_id"), guarded(as_int(F.col("doc.info.frameInterval"))).alias("frame_interval_ms"),
        guarded(array_size(frames)).alias("frame_count"), guarded(F.coalesce(players, F.lit(0).cast("bigint"))).alias("participant_frame_count"),
    )


def array_size(values: Column) -> Column:
    """The length of an array, null for a null one."""
    return F.when(values.isNotNull(), F.size(values))


def first_archived(envelopes: DataFrame, store=stored) -> DataFrame:
    """One row for each match, the first by part and row. Rows without an id each stay, to be counted.

    Only ids and addresses are sorted. The addresses of later copies are stored, so that the planner knows
    how few they are and takes them out where the documents are read: these are not shuffled.
    """
    keys = envelopes.where(F.col("match_id").isNotNull()).select("match_id", "part", "part_row")
    return envelopes.join(store(later_copies(keys), "copies"), ["part", "part_row"], "left_anti")


def later_copies(keys: DataFrame) -> DataFrame:
    """Of ``keys`` (match_id, part, part_row) the places of all rows but each match's first."""
    return copies_numbered(keys).where("_n > 1").select("part", "part_row")


def first_of_each(rows: DataFrame) -> DataFrame:
    """Of short ``rows`` (match_id, part, part_row and others) each match's first by part and row; rows without an id are left out.

    They are sorted as they are, which for documents ``first_archived`` avoids.
    """
    return copies_numbered(rows.where(F.col("match_id").isNotNull())).where("_n = 1").drop("_n")


def copies_numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("match_id").orderBy("part", "part_row")))


def carry_payload(archive: DataFrame, rule: Column, schema: str = schemas.SUMMARY, store=stored) -> DataFrame:
    """The envelopes that ``rule`` chooses, one of each match, with their payloads; a payload that is no JSON is null.

    A payload is carried from the read that tells its envelope, and only where the rule holds, so none is sorted or joined.
    """
    told = envelope(parse_summaries(archive, schema, payload=True)).drop("doc")
    told = told.withColumn("payload", F.when(F.col("payload_valid") & rule, F.col("payload")))
    return first_archived(store(told, "parsed"), store).where(rule)


def damaged(archive: DataFrame) -> DataFrame:
    """The rows whose payload no longer has the hash it was written with."""
    return archive.where(~F.col("payload_sha256").eqNullSafe(F.sha2("payload", 256)))


# ---- static documents --------------------------------------------------------------------


def newest_version(versions: DataFrame, column: str = "version") -> DataFrame:
    """One row: the newest version by its components as numbers, whatever the order of the list."""
    return versions.where(F.col(column).rlike(r"^[0-9]+(\.[0-9]+)*$")).agg(F.max_by(column, patch_order(F.col(column))).alias("version"))


def static_dictionary(documents: DataFrame, kind: str) -> DataFrame:
    """``id``, ``key``, ``name``, ``slug`` and ``icon`` from documents of a kind: champion, item or summoner."""
    entry = "STRUCT<id: STRING, key: STRING, name: STRING, image: STRUCT<full: STRING>>"
    data = F.from_json("payload", f"STRUCT<data: MAP<STRING, {entry}>>")["data"]
    rows = documents.where(F.col("kind") == kind).select(F.explode(data).alias("name_key", "entry"))
    number = as_int(F.col("name_key") if kind == "item" else F.col("entry.key"))
    return rows.select(number.alias("id"), F.col("name_key").alias("key"), F.col("entry.name").alias("name"), slug(F.col("name_key")).alias("slug"), F.col("entry.image.full").alias("icon"))


def rune_dictionary(documents: DataFrame) -> DataFrame:
    """``id``, ``key``, ``name``, ``icon`` and ``tree`` of trees and of the runes in their slots."""
    rune = "STRUCT<id: INT, key: STRING, name: STRING, icon: STRING>"
    trees = F.from_json("payload", f"ARRAY<STRUCT<id: INT, key: STRING, name: STRING, icon: STRING, slots: ARRAY<STRUCT<runes: ARRAY<{rune}>>>>>")
    tree = documents.where("kind = 'runesReforged'").select(F.explode(trees).alias("t"))
    own = F.array(F.struct("t.id", "t.key", "t.name", "t.icon"))
    runes = F.flatten(F.transform("t.slots", lambda s: s["runes"]))
    return tree.select(F.col("t.id").alias("tree"), F.explode(F.concat(own, runes)).alias("r")).select("r.id", "r.key", "r.name", "r.icon", "tree")
