"""From parsed summaries to participants and bans, and the filters that scope them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneforge.functions.columns import as_int, normal_role, platforms_of, rune_key, two_parts
from laneforge.sources.archive import window_ending

ITEMS = tuple(f"item{k}" for k in range(7))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


# ---- filters -----------------------------------------------------------------------------


def in_scope(region: str, queue: int = 0, end: str | None = None, days: int = 14, platform: str | None = None) -> Column:
    """A region's matches of a queue (0: any) that were played in the window that ends at ``end``."""
    rules = [F.col("platform_id").isin(platforms_of(region, platform)), F.col("queue_id") == queue if queue else F.col("queue_id") > 0]
    if end:
        first, last = window_ending(end, days)
        rules.append(F.to_date(F.timestamp_millis("game_creation_ms")).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return all_of(rules)


def usable() -> Column:
    return F.col("payload_valid") & (F.col("participants") > 0)


def match_filter(scope: Column, patch: str | None = None) -> Column:
    """A usable envelope in scope, and of the patch where one is pinned."""
    return usable() & scope & of_patch(patch, two_parts(F.col("game_version")))


def of_patch(patch: str | None, column: Column | None = None) -> Column:
    return (F.col("patch") if column is None else column) == patch if patch else F.lit(True)


def classified(patch: str | None = None) -> Column:
    """Participants with a role, a champion and an outcome."""
    return F.col("role").isNotNull() & (F.col("champion_id") > 0) & F.col("win").isNotNull() & of_patch(patch)


def rejected(patch: str | None = None) -> Column:
    missing = F.col("role").isNull() | F.col("champion_id").isNull() | (F.col("champion_id") <= 0) | F.col("win").isNull()
    return of_patch(patch) & missing


def feature_scope(region: str = "", platform: str = "", queue: int = 0) -> Column:
    """The feature dataset's scope: everything unless a region, platform or queue is named."""
    rules = []
    if region.strip() or platform.strip():
        rules.append(F.col("platform_id").isin(platforms_of(region, platform)))
    if queue:
        rules.append(F.col("queue_id") == queue)
    return all_of(rules)


# ---- participants and bans ---------------------------------------------------------------


def participants(envelopes: DataFrame) -> DataFrame:
    """One row for each participant of the tier list's matches."""
    p = F.col("p")
    rows = envelopes.where("payload_valid").select("match_id", "game_version", "platform_id", "queue_id", "game_creation_ms", F.explode("doc.info.participants").alias("p"))
    return rows.select(
        "match_id", "game_version", "platform_id", "queue_id", F.timestamp_millis("game_creation_ms").cast("timestamp_ntz").alias("game_creation"),
        two_parts(F.col("game_version")).alias("patch"), as_int(p["championId"]).alias("champion_id"),
        normal_role(p["teamPosition"], p["individualPosition"]).alias("role"), p["win"].try_cast("boolean").alias("win"),
        as_int(p["teamId"]).alias("team_id"), *(as_int(p[c]).alias(c) for c in ITEMS),
        as_int(p["summoner1Id"]).alias("summoner1_id"), as_int(p["summoner2Id"]).alias("summoner2_id"), rune_key(p["perks"]).alias("rune_style"),
    )


def sides(envelopes: DataFrame) -> DataFrame:
    """Who played what on which team, without builds."""
    p = F.col("p")
    rows = envelopes.where("payload_valid").select("match_id", "game_version", F.explode("doc.info.participants").alias("p"))
    return rows.select(
        "match_id", two_parts(F.col("game_version")).alias("patch"), as_int(p["championId"]).alias("champion_id"), normal_role(p["teamPosition"], p["individualPosition"]).alias("role"),
        p["win"].try_cast("boolean").alias("win"), as_int(p["teamId"]).alias("team_id"),
    )


def paired(sides: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and structs ``a`` and ``b``: each row with each row of its group that is on another team.

    A group is the players of one role in a match, so its list is short; it is made by one aggregate, without a join.
    Rows that lack a key are of no group: as in a join, nulls don't meet.
    """
    rest = [c for c in sides.columns if c not in keys]
    group = sides.where(all_of([F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("side"))
    others = lambda a: F.filter("side", lambda b: b["team_id"] != a["team_id"])
    pairs = F.flatten(F.transform("side", lambda a: F.transform(others(a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return group.select(*keys, F.inline(pairs))


def bans(envelopes: DataFrame) -> DataFrame:
    """One row for each ban of a champion."""
    each = F.flatten(F.transform("doc.info.teams", lambda t: F.coalesce(t["bans"], F.array())))
    rows = envelopes.where("payload_valid").select("match_id", two_parts(F.col("game_version")).alias("patch"), F.explode(each).alias("b"))
    return rows.select("match_id", "patch", as_int(F.col("b.championId")).alias("champion_id")).where("champion_id > 0")


def summary_participants(envelopes: DataFrame) -> DataFrame:
    """Who played what in each match, for the feature dataset; ids are the payload's own."""
    p = F.col("p")
    keys = ("match_id", "region", "patch", "queue_id", "platform_id", "game_creation_ms", "game_duration_s")
    rows = envelopes.where("payload_valid").select(*keys, F.explode("doc.info.participants").alias("p"))
    return rows.select(
        "match_id", "region", "patch", "queue_id", "platform_id", F.timestamp_millis("game_creation_ms").cast("timestamp_ntz").alias("game_creation"), "game_duration_s",
        as_int(p["participantId"]).alias("participant_id"), as_int(p["championId"]).alias("champion_id"), as_int(p["teamId"]).alias("team_id"),
        normal_role(p["teamPosition"], p["individualPosition"]).alias("role"), p["teamPosition"].alias("team_position"),
        p["individualPosition"].alias("individual_position"), p["win"].try_cast("boolean").alias("win"),
    )


def participant_ids(envelopes: DataFrame, *more: str) -> DataFrame:
    """``match_id`` (and ``more`` columns) and the distinct ids of its players, in order of first mention, blanks left out."""
    listed = F.coalesce("doc.metadata.participants", F.array())
    named = F.coalesce(F.transform("doc.info.participants", lambda p: p["puuid"]), F.array())
    kept = F.filter(F.concat(listed, named), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    return envelopes.select("match_id", *more, F.array_distinct(kept).alias("puuids"))
