"""Counts that the tier list is made of. Every one is a partial and final hash aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneforge.functions.columns import as_int, normal_role, two_parts
from laneforge.operators.extract import ITEMS, classified, paired, rejected

def cell_counts(participants: DataFrame, patch: str | None = None) -> DataFrame:
    return tally(participants.where(classified(patch)), "champion_id", "role")


def tally(rows: DataFrame, *keys) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").cast("int").alias("n"), F.count_if("win").cast("int").alias("wins"))


def ban_counts(bans: DataFrame, patch: str | None = None) -> DataFrame:
    """In how many matches each champion was banned."""
    rows = bans.where("champion_id > 0").where(F.col("patch") == patch if patch else F.lit(True))
    return rows.groupBy("champion_id").agg(F.count_distinct("match_id").cast("int").alias("bans"))


def match_facts() -> Column:
    """What a summary (``doc``) gives to cells: an array of facts, of ``kind`` cell for each classified player, ban for each banned champion, and match once.

    A summary stands for a match, so a champion that a match bans twice is counted once by its list of bans.
    """
    fact = lambda kind, champion=None, role=None, win=None: F.struct(
        F.lit(kind).alias("kind"), (F.lit(None) if champion is None else champion).cast("int").alias("champion_id"),
        (F.lit(None) if role is None else role).cast("string").alias("role"), (F.lit(None) if win is None else win).cast("boolean").alias("win"),
    )
    players = F.transform("doc.info.participants", lambda p: fact("cell", as_int(p["championId"]), normal_role(p["teamPosition"], p["individualPosition"]), p["win"].try_cast("boolean")))
    known = F.filter(players, lambda f: f["role"].isNotNull() & (f["champion_id"] > 0) & f["win"].isNotNull())
    banned = F.array_distinct(F.transform(F.flatten(F.transform("doc.info.teams", lambda t: F.coalesce(t["bans"], F.array()))), lambda b: as_int(b["championId"])))
    bans = F.transform(F.filter(F.coalesce(banned, F.array().cast("array<int>")), lambda c: c > 0), lambda c: fact("ban", c))
    return F.concat(F.coalesce(known, F.array().cast(known_type())), bans, F.array(fact("match")))


def tier_facts(window: DataFrame, patch: str | None = None) -> DataFrame:
    """All that cells are made of, in one pass over the matches and one aggregate: games and wins by kind, champion and role.

    ``window`` has one row for each match, with its ``facts`` or the summary that they are made of.
    """
    rows = window.where("payload_valid").where(two_parts(F.col("game_version")) == patch if patch else F.lit(True))
    each = rows.select(F.inline(F.col("facts") if "facts" in window.columns else match_facts()))
    return each.groupBy("kind", "champion_id", "role").agg(F.count("*").cast("int").alias("n"), F.count_if("win").cast("int").alias("wins"))


def known_type() -> str:
    return "array<struct<kind:string,champion_id:int,role:string,win:boolean>>"


def build_key(kind: str) -> tuple[Column, Column]:
    """The grouping key of a kind of build, and which rows have one."""
    if kind == "items":
        return F.array(*ITEMS), F.greatest(*(F.col(c) for c in ITEMS[:6])) > 0
    if kind == "runes":
        return F.col("rune_style"), F.col("rune_style").isNotNull()
    return F.array("summoner1_id", "summoner2_id"), (F.col("summoner1_id") > 0) & (F.col("summoner2_id") > 0)


def build_counts(participants: DataFrame, kind: str, patch: str | None = None) -> DataFrame:
    key, there = build_key(kind)
    return tally(participants.where(classified(patch) & there), "champion_id", "role", key.alias("key"))


BUILD_KINDS = ("items", "runes", "spells")


def all_build_counts(participants: DataFrame, patch: str | None = None) -> DataFrame:
    """Builds of every kind, in one pass and one shuffle: the columns of ``build_counts`` and ``kind``."""
    keys = [(kind, *build_key(kind)) for kind in BUILD_KINDS]
    each = F.array_compact(F.array(*(F.when(there, F.struct(F.lit(kind).alias("kind"), key.alias("key"))) for kind, key, there in keys)))
    rows = participants.where(classified(patch)).select("champion_id", "role", "win", F.inline(each))
    return tally(rows, "champion_id", "role", "kind", "key")


def matchups(participants: DataFrame, patch: str | None = None) -> DataFrame:
    """Opponents of the same role, each pair once, the lower champion first; mirrors by team."""
    pairs = paired(participants.where(classified(patch)).select("match_id", "role", "team_id", "champion_id", "win"), ["match_id", "role"])
    a, b = F.col("a"), F.col("b")
    first = (a["champion_id"] < b["champion_id"]) | (a["champion_id"] == b["champion_id"]) & (a["team_id"] < b["team_id"])
    return pairs.where(first).select("match_id", "role", a["champion_id"].alias("champion_id"), b["champion_id"].alias("opponent_id"), a["win"].alias("win"))


def matchup_counts(participants: DataFrame, patch: str | None = None) -> DataFrame:
    return tally(matchups(participants, patch), "role", "champion_id", "opponent_id")


def patch_list(participants: DataFrame) -> DataFrame:
    """Matches and participant rows by patch, counted from the participants."""
    return participants.where(F.col("patch").isNotNull()).groupBy("patch").agg(F.count_distinct("match_id").cast("int").alias("matches"), F.count("*").cast("int").alias("participant_rows"))


def envelope_patch_list(envelopes: DataFrame, filters: Column) -> DataFrame:
    """The same figures from the envelopes alone."""
    rows = envelopes.where(filters).select(two_parts(F.col("game_version")).alias("patch"), "participants")
    return rows.groupBy("patch").agg(F.count("*").cast("int").alias("matches"), F.sum("participants").cast("int").alias("participant_rows"))


def archive_stats(envelopes: DataFrame) -> DataFrame:
    """Rows, and rows without a readable envelope."""
    keys = ("match_id", "game_version", "queue_id", "game_creation_ms")
    missing = ~F.col("payload_valid")
    for c in keys:
        missing = missing | F.col(c).isNull()
    return envelopes.agg(F.count("*").cast("int").alias("archive_rows"), F.count_if(missing).cast("int").alias("malformed_rows"))


def window_stats(envelopes: DataFrame, participants: DataFrame, bans: DataFrame, filters: Column, patch: str | None = None) -> DataFrame:
    """One row of counts for the window; bans are those of all its patches."""
    of = F.col("patch") == patch if patch else F.lit(True)
    played = envelopes.where(filters).where(two_parts(F.col("game_version")) == patch if patch else F.lit(True)).agg(F.count_distinct("match_id").cast("int").alias("matches_used"))
    rows = participants.agg(F.count_if(of).cast("int").alias("participant_rows"), F.count_if(rejected(patch)).cast("int").alias("rejected_rows"))
    return played.crossJoin(rows).crossJoin(bans.agg(F.count("*").cast("int").alias("ban_rows")))  # one row each


def baseline(tallies: DataFrame) -> DataFrame:
    """One row: the win rate over all tallies, suppressed ones included."""
    return tallies.agg((F.sum("wins") / F.sum("n").cast("double")).alias("baseline"))
