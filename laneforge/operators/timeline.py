"""The feature dataset: frames and events of timelines, and the six tables made of them.

All joins are on the match, most on match and participant, so rows that are shuffled by
match once serve the joins that follow.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laneforge.functions.columns import as_int, as_long, minute_of
from laneforge.operators.extract import all_of, paired, summary_participants
from laneforge.sources.schemas import CHECKPOINTS, OBJECTIVES, TABLES
from laneforge.sources.archive import first_archived
from laneforge.sources.shared import Owner, stored

KEY = ["match_id", "participant_id"]
MIN_DURATION_S = 600
#: Stretches of time that a key's rows are cut into at most, and the rows of a key from which they are.
SEGMENTS, SEGMENT_ROWS = 1000, 1_000_000


def as_table(df: DataFrame, name: str) -> DataFrame:
    """The columns of a published table, in order and type."""
    return df.select(*(F.col(c).cast(kind).alias(c) for c, kind in TABLES[name]))


# ---- ledger ------------------------------------------------------------------------------


def match_index(summaries: DataFrame, timelines: DataFrame, min_duration_s: int = MIN_DURATION_S) -> DataFrame:
    """Every match with why it is left out of the other tables, or ``ok``."""
    t = timelines.select("match_id", "frame_interval_ms", "frame_count", "participant_frame_count", F.lit(True).alias("there"))
    rows = summaries.join(t, "match_id", "left")
    none = F.coalesce("participant_frame_count", F.lit(0)) == 0
    still = F.col("frame_interval_ms") == 0
    reason = (
        F.when(F.col("there").isNull(), "no_timeline").when(still & none, "aborted").when(still, "frame_interval_zero")
        .when(F.coalesce("game_duration_s", F.lit(0)) < min_duration_s, "too_short").when(none, "frames_null").otherwise("ok")
    )
    graded = rows.withColumn("timeline_present", F.col("there").isNotNull()).withColumn("exclusion_reason", reason)
    graded = graded.withColumn("timeline_eligible", F.col("exclusion_reason") == "ok").withColumn("game_creation", F.timestamp_millis("game_creation_ms").cast("timestamp_ntz"))
    return as_table(graded, "match_index")


def eligible(index: DataFrame) -> DataFrame:
    return index.where("timeline_eligible")


def orphan_timelines(timelines: DataFrame, summaries: DataFrame) -> DataFrame:
    """Timelines of matches without a summary."""
    return timelines.join(summaries.select("match_id"), "match_id", "left_anti")


# ---- frames ------------------------------------------------------------------------------


def frames(timelines: DataFrame) -> DataFrame:
    """One row for each match, participant and frame."""
    f = timelines.where("payload_valid").select("match_id", "region", "patch", "queue_id", F.explode("doc.info.frames").alias("f"))
    p = f.select("match_id", "region", "patch", "queue_id", as_long(F.col("f.timestamp")).alias("frame_timestamp_ms"), F.explode("f.participantFrames").alias("id", "p"))
    v = lambda name: as_int(F.col(f"p.{name}"))
    return p.select(
        "match_id", "region", "patch", "queue_id", as_int(F.col("id")).alias("participant_id"), "frame_timestamp_ms", minute_of(F.col("frame_timestamp_ms")).alias("minute"),
        v("level").alias("level"), as_long(F.col("p.xp")).alias("xp"), v("totalGold").alias("total_gold"), v("currentGold").alias("current_gold"),
        v("minionsKilled").alias("minions_killed"), v("jungleMinionsKilled").alias("jungle_minions_killed"), (v("minionsKilled") + v("jungleMinionsKilled")).alias("cs_total"),
        v("position.x").alias("position_x"), v("position.y").alias("position_y"),
    )


# ---- events ------------------------------------------------------------------------------


def events(timelines: DataFrame) -> DataFrame:
    """One wide row for each event, numbered within its match; repeated skill-ups are marked, not dropped.

    A match's events lie in one payload, so numbers and marks come from its array, without a shuffle.
    """
    every = F.flatten(F.transform("doc.info.frames", lambda f: F.coalesce(f["events"], F.array())))
    f = timelines.where("payload_valid").select("match_id", "region", "patch", "queue_id", every.alias("every"))
    f = f.select("match_id", "region", "patch", "queue_id", "every", repeated_skill_ups(F.col("every")).alias("again"))
    e = f.select("match_id", "region", "patch", "queue_id", "again", F.posexplode("every").alias("event_index", "e"))
    text = lambda name: F.col(f"e.{name}")
    number = lambda name: as_int(text(name))
    timestamp = as_long(text("timestamp"))
    rows = e.select(
        "match_id", "region", "patch", "queue_id", "event_index", timestamp.alias("timestamp_ms"), minute_of(timestamp).alias("minute"),
        text("type").alias("event_type"), F.coalesce(number("participantId"), number("killerId"), number("creatorId")).alias("actor_participant_id"),
        number("victimId").alias("target_participant_id"), text("assistingParticipantIds").alias("assisting_participant_ids"), number("teamId").alias("team_id"),
        number("position.x").alias("position_x"), number("position.y").alias("position_y"), text("laneType").alias("lane_type"), text("monsterType").alias("monster_type"),
        F.coalesce(text("monsterSubType"), text("soulType")).alias("monster_subtype"), text("buildingType").alias("building_type"), text("towerType").alias("tower_type"),
        text("wardType").alias("ward_type"), number("itemId").alias("item_id"), number("beforeId").alias("before_item_id"), number("afterId").alias("after_item_id"),
        number("skillSlot").alias("skill_slot"), number("level").alias("level"), text("killType").alias("kill_type"), number("multiKillLength").alias("multi_kill_length"),
        text("transformType").alias("transform_type"), number("killStreakLength").alias("kill_streak_length"), number("bounty").alias("bounty"),
        number("shutdownBounty").alias("shutdown_bounty"), number("winningTeam").alias("winning_team"),
        F.array_contains("again", F.col("event_index")).alias("is_duplicate_skill_level_up"),
    )
    return rows


def repeated_skill_ups(every: Column) -> Column:
    """The places, in an array of events, of skill-ups that come again for the same player, slot and level."""
    known = lambda e, name: F.coalesce(as_int(e[name]).cast("string"), F.lit("-"))
    player = lambda e: F.coalesce(as_int(e["participantId"]), as_int(e["killerId"]), as_int(e["creatorId"])).cast("string")
    key = lambda e: F.concat_ws(".", F.coalesce(player(e), F.lit("-")), known(e, "skillSlot"), known(e, "level"))
    placed = F.filter(F.transform(every, lambda e, i: F.struct((e["type"] == "SKILL_LEVEL_UP").alias("is"), key(e).alias("key"), i.alias("at"))), lambda x: F.coalesce(x["is"], F.lit(False)))
    first = lambda ups, x: F.array_position(F.transform(ups, lambda u: u["key"]), x["key"])
    again = lambda ups: F.filter(ups, lambda x, n: first(ups, x) <= n)  # noqa: E731  positions count from 1, n from 0
    # an array of one array, so that the list of skill-ups is made once
    return F.flatten(F.transform(F.array(placed), lambda ups: F.transform(again(ups), lambda x: x["at"])))


def events_table(index: DataFrame, all_events: DataFrame) -> DataFrame:
    scope = eligible(index).select("match_id", "region", "patch", "queue_id")
    return as_table(all_events.drop("region", "patch", "queue_id").join(scope, "match_id"), "events")


def roles_of_event():
    """An array of (participant, role) for an event: actor, target, assistants; 0 stands for nobody."""
    one = lambda c, role: F.when(F.col(c) > 0, F.struct(F.col(c).alias("participant_id"), F.lit(role).alias("role_in_event")))
    assists = F.transform(F.coalesce("assisting_participant_ids", F.array().cast("array<int>")), lambda x: F.struct(x.alias("participant_id"), F.lit("assist").alias("role_in_event")))
    return F.array_compact(F.concat(F.array(one("actor_participant_id", "actor"), one("target_participant_id", "target")), assists))


def event_actors(all_events: DataFrame) -> DataFrame:
    """One row for each participant of each event, with the part taken in it."""
    keep = ("match_id", "event_index", "event_type", "timestamp_ms", "minute", "team_id", "lane_type", "ward_type", "monster_type", "monster_subtype", "skill_slot", "level", "item_id", "position_x", "position_y", "is_duplicate_skill_level_up")
    return all_events.select(*keep, F.inline(roles_of_event()))


def kill_points(all_events: DataFrame) -> DataFrame:
    """Kills, deaths and assists in long form: a row for each participant of each kill."""
    kills = all_events.where("event_type = 'CHAMPION_KILL'").select("match_id", "timestamp_ms", F.inline(roles_of_event()))
    is_ = lambda role, name: (F.col("role_in_event") == role).cast("int").alias(name)
    return kills.select("match_id", "participant_id", "timestamp_ms", is_("actor", "kills"), is_("target", "deaths"), is_("assist", "assists"))


def merged_points(points: DataFrame) -> DataFrame:
    return points.groupBy(*KEY, "timestamp_ms").agg(*(F.sum(c).alias(c) for c in ("kills", "deaths", "assists")))


def running_kda(points: DataFrame) -> DataFrame:
    """Sums up to and with each time at which a participant has points."""
    upto = Window.partitionBy(*KEY).orderBy("timestamp_ms").rowsBetween(Window.unboundedPreceding, 0)
    return merged_points(points).select(*KEY, "timestamp_ms", *(F.sum(c).over(upto).cast("bigint").alias(f"{c}_to_minute") for c in ("kills", "deaths", "assists")))


def last_before(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], segment_rows: int | None = None) -> DataFrame:
    """An as-of left join: each left row with the values of the latest right row at its time or before.

    Both sides go into one sort by key and time, so the cost doesn't depend on how many right rows
    precede a left one. Of right rows at one time the last by their values counts. A null key meets nothing.

    A key's rows are one task's, which a game bounds for its players. Where nothing bounds them, ``segment_rows`` cuts the rows of a
    key that has more into stretches of time of about so many; each is sorted on its own, and what was last in the stretches before is
    carried on. Rows of one time stay together.
    """
    mine = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.struct(*mine).alias("_left"), F.lit(None).cast(right.select(F.struct(*values).alias("v")).schema["v"].dataType).alias("_right"))
    b = right.select(*keys, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), F.struct(*values).alias("_right"))
    rows = a.unionByName(b)
    within, carried = list(keys), None
    if segment_rows:
        rows, carried = segmented(rows, keys, segment_rows)
        within.append("_segment")
    upto = Window.partitionBy(*within).orderBy("_at", "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_right", F.last("_right", ignorenulls=True).over(upto)).where("_side = 1")
    if carried is not None:
        rows = rows.join(carried, within, "left").withColumn("_right", F.coalesce("_right", "_carried"))
    known = all_of([F.col(k).isNotNull() for k in keys])
    return rows.select(*keys, *(F.col("_left")[c].alias(c) for c in mine), *(F.when(known, F.col("_right")[c]).alias(c) for c in values))


def segmented(rows: DataFrame, keys: list[str], segment_rows: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``_segment``, a stretch of a large key's time (0 for other keys), and what each later stretch starts with.

    Large keys are at most the rows by ``segment_rows``, so what is told of them is small beside the rows.
    """
    known = rows.where(all_of([F.col(k).isNotNull() for k in keys]))
    large = stored(known.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > segment_rows), "large")
    shares = [k / SEGMENTS for k in range(1, SEGMENTS)]
    ends = known.join(large, keys, "left_semi").groupBy(*keys).agg(F.percentile_approx("_at", shares, 10 * SEGMENTS).alias("_ends"))
    told = stored(ends.join(large, keys), "segments")
    # as many of the cuts as the key's rows ask for
    every = F.greatest(F.lit(1), F.floor(F.lit(SEGMENTS) * segment_rows / F.col("_n"))).cast("int")
    told = told.select(*keys, F.filter("_ends", lambda x, k: (k + 1) % every == 0).alias("_ends"))
    cut = rows.join(told, keys, "left")
    segment = F.coalesce(F.size(F.filter("_ends", lambda x: x < F.col("_at"))), F.lit(0))
    cut = cut.withColumn("_segment", F.when(F.col("_ends").isNull(), F.lit(0)).otherwise(segment)).drop("_ends")
    last = cut.join(told, keys, "left_semi").where("_side = 0").groupBy(*keys, "_segment").agg(F.max(F.struct("_at", "_right")).alias("last"))
    stretches = told.select(*keys, F.explode(F.sequence(F.lit(0), F.size("_ends"))).alias("_segment")).join(last, [*keys, "_segment"], "left")
    before = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.withColumn("_carried", F.last("last._right", ignorenulls=True).over(before)).where("_carried IS NOT NULL")
    return cut, carried.select(*keys, "_segment", "_carried")


def participant_minutes(index: DataFrame, players: DataFrame, all_frames: DataFrame, points: DataFrame) -> DataFrame:
    who = players.join(eligible(index).select("match_id"), "match_id", "left_semi").select(*KEY, "champion_id", "role", "team_id", "win", "patch", "region", "queue_id")
    rows = all_frames.drop("region", "patch", "queue_id").join(who, KEY)
    totals = ["kills_to_minute", "deaths_to_minute", "assists_to_minute"]
    out = last_before(rows, running_kda(points), KEY, "frame_timestamp_ms", "timestamp_ms", totals)
    return as_table(out.fillna(0, totals), "participant_minutes")


# ---- checkpoints and lanes ---------------------------------------------------------------

AT_CHECKPOINT = ("frame_timestamp_ms", "cs_total", "xp", "total_gold", "level", "kills_to_minute", "deaths_to_minute", "assists_to_minute")


def checkpoint_picks(minutes: DataFrame) -> DataFrame:
    """For minutes 5, 10 and 15 that a match reached, each participant's nearest frame.

    A frame counts from a minute before the checkpoint to half a minute after it; of two as near the
    earlier one stands.
    """
    last = F.max("frame_timestamp_ms").over(Window.partitionBy("match_id"))  # a window, so that minutes are made once
    points = minutes.select(*KEY, *AT_CHECKPOINT, last.alias("last_ms"), F.explode(F.array(*map(F.lit, CHECKPOINTS))).alias("checkpoint"))
    at, ms = F.col("checkpoint") * 60000, F.col("frame_timestamp_ms")
    near = points.where(ms.between(at - 60000, at + 30000) & (at <= F.col("last_ms")))
    best = near.groupBy(*KEY, "checkpoint").agg(F.min_by(F.struct(*AT_CHECKPOINT), F.struct(F.abs(ms - at), ms)).alias("f"))
    return best.select(*KEY, "checkpoint", "f.*")


def frame_picks(players: DataFrame, all_frames: DataFrame, points: DataFrame) -> DataFrame:
    """``checkpoint_picks`` of the minutes that ``players``, of eligible matches, and ``all_frames`` make, without the minutes.

    A match's frames lie in one task, so a participant's frames are one row before they are shuffled. Running totals are looked up for the picks alone.
    """
    own, ms = AT_CHECKPOINT[:5], F.col("frame_timestamp_ms")
    near = lambda at: F.when(ms.between(at - 60000, at + 30000), F.struct(F.abs(ms - at), ms))
    best = all_frames.groupBy(*KEY).agg(F.max(ms).alias("last_ms"), *(F.min_by(F.struct(*own), near(60000 * c)).alias(f"at_{c}") for c in CHECKPOINTS))
    best = best.join(players.select(*KEY), KEY, "left_semi").withColumn("last_ms", F.max("last_ms").over(Window.partitionBy("match_id")))
    each = F.array(*(F.struct(F.lit(c).alias("checkpoint"), F.col(f"at_{c}").alias("f")) for c in CHECKPOINTS))
    rows = best.select(*KEY, "last_ms", F.inline(each)).where("f IS NOT NULL AND checkpoint * 60000 <= last_ms").select(*KEY, "checkpoint", "f.*")
    totals = list(AT_CHECKPOINT[5:])
    return last_before(rows, running_kda(points), KEY, "frame_timestamp_ms", "timestamp_ms", totals).fillna(0, totals).select(*KEY, "checkpoint", *AT_CHECKPOINT)


def checkpoint_pivot(picks: DataFrame) -> DataFrame:
    """One row for each participant: the values of every checkpoint side by side."""
    return picks.groupBy(*KEY).agg(*(
        F.max(F.when(F.col("checkpoint") == c, F.col(name))).alias(f"{name}_at_{c}") for c in CHECKPOINTS for name in AT_CHECKPOINT[1:]
    ))


def lane_pairs(index: DataFrame, players: DataFrame) -> DataFrame:
    """Participants with their opponent of the same role, in both directions."""
    return opponents(players.join(eligible(index).select("match_id"), "match_id", "left_semi"))


def opponents(who: DataFrame, *values: str) -> DataFrame:
    """Pairs of the rows of ``who``, with both sides' ``values``, the opponent's with a prefix ``o_``."""
    kept = ["region", "patch", "queue_id", "participant_id", "champion_id", "team_id", "win", *values]
    pairs = paired(who.where("role IS NOT NULL").select("match_id", "role", *kept), ["match_id", "role"])
    a, b = F.col("a"), F.col("b")
    mine = lambda name: a[name].alias(name)
    return pairs.select(
        "match_id", *map(mine, ("region", "patch", "queue_id", "participant_id")), b["participant_id"].alias("opponent_participant_id"), "role", mine("champion_id"),
        b["champion_id"].alias("opponent_champion_id"), mine("team_id"), mine("win"), F.lit("team_position").alias("pairing_basis"),
        F.col("role").isin("BOTTOM", "SUPPORT").alias("is_duo_lane"), (F.col("role") != "JUNGLE").alias("has_nominal_opponent"),
        *map(mine, values), *(b[c].alias(f"o_{c}") for c in values),
    )


def lane_matchups(index: DataFrame, players: DataFrame, picks: DataFrame) -> DataFrame:
    """Own and opponent's values at each checkpoint; null where the game never reached it."""
    own = checkpoint_pivot(picks)
    who = players.join(eligible(index).select("match_id"), "match_id", "left_semi").join(own, KEY, "left")
    rows = opponents(who, *(c for c in own.columns if c not in KEY))
    for c in CHECKPOINTS:
        at = lambda name, side="": F.col(f"{side}{name}_at_{c}")  # noqa: B023, E731
        columns = {f"cs_{c}": at("cs_total"), f"opponent_cs_{c}": at("cs_total", "o_")}
        columns |= {f"{short}_diff_{c}": at(name) - at(name, "o_") for short, name in (("cs", "cs_total"), ("xp", "xp"), ("gold", "total_gold"), ("level", "level"))}
        columns |= {f"{name}_{c}": at(f"{name}_to_minute") for name in ("kills", "deaths", "assists")}
        rows = rows.withColumns(columns)
    return as_table(rows, "lane_matchups")


# ---- early game --------------------------------------------------------------------------


def involvement(actors: DataFrame) -> DataFrame:
    """One aggregate for all that a participant's events tell: counts, first death, skills."""
    is_ = lambda kind, *parts: (F.col("event_type") == kind) & F.col("role_in_event").isin(*parts)
    monster = lambda name: F.count_if(is_("ELITE_MONSTER_KILL", "actor", "assist") & (F.col("monster_type") == name))
    died = is_("CHAMPION_KILL", "target")
    ts = F.col("timestamp_ms")
    first = lambda c: F.min_by(F.when(died, F.col(c)), F.when(died & F.col(c).isNotNull(), ts))  # noqa: E731  a null is passed over
    skill = is_("SKILL_LEVEL_UP", "actor") & ~F.col("is_duplicate_skill_level_up") & F.col("skill_slot").isNotNull()
    skills = F.array_sort(F.collect_list(F.when(skill, F.struct("timestamp_ms", "event_index", "skill_slot"))))
    bought = is_("ITEM_PURCHASED", "actor") & (F.col("item_id") > 0)
    purchases = F.array_sort(F.collect_list(F.when(bought, F.struct("timestamp_ms", "event_index", "item_id"))))
    rows = actors.groupBy(*KEY).agg(
        F.count_if(is_("WARD_PLACED", "actor")).alias("wards_placed"), F.count_if(is_("WARD_KILL", "actor")).alias("wards_killed"),
        F.count_if(is_("TURRET_PLATE_DESTROYED", "actor")).alias("plates_destroyed"), monster("DRAGON").alias("dragons_participated"),
        monster("HORDE").alias("grubs_participated"), monster("RIFTHERALD").alias("heralds_participated"), monster("BARON_NASHOR").alias("barons_participated"),
        monster("ATAKHAN").alias("atakhan_participated"), F.count_if(is_("SKILL_LEVEL_UP", "actor") & F.col("is_duplicate_skill_level_up")).alias("duplicate_skill_ups"),
        F.min(F.when(died, ts)).alias("first_death_ts_ms"), first("position_x").alias("first_death_position_x"), first("position_y").alias("first_death_position_y"),
        skills.alias("skills"), purchases.alias("purchases"),
    )
    item = lambda k, name: F.get("purchases", F.lit(k))[name]
    return rows.withColumns({
        "skill_order": F.when(F.size("skills") > 0, F.array_join(F.transform("skills", lambda s: s["skill_slot"].cast("string")), "")),
        "first_item_ts_ms": item(0, "timestamp_ms"), "first_item_id": item(0, "item_id"), "second_item_ts_ms": item(1, "timestamp_ms"), "second_item_id": item(1, "item_id"),
    }).drop("skills", "purchases")


def skill_order(actors: DataFrame) -> DataFrame:
    """The slots that a participant raised, in order, repeats left out."""
    rows = actors.where("event_type = 'SKILL_LEVEL_UP' AND role_in_event = 'actor' AND NOT is_duplicate_skill_level_up AND skill_slot IS NOT NULL")
    return involvement(rows).select(*KEY, "skill_order")


def item_timings(actors: DataFrame) -> DataFrame:
    """First and second purchase of each participant."""
    order = Window.partitionBy(*KEY).orderBy("timestamp_ms", "event_index")
    rows = actors.where("event_type = 'ITEM_PURCHASED' AND role_in_event = 'actor' AND item_id > 0").withColumn("seq", F.row_number().over(order)).where("seq <= 2")
    pick = lambda c, k: F.min(F.when(F.col("seq") == k, F.col(c)))
    return rows.groupBy(*KEY).agg(pick("timestamp_ms", 1).alias("first_item_ts_ms"), pick("item_id", 1).alias("first_item_id"), pick("timestamp_ms", 2).alias("second_item_ts_ms"), pick("item_id", 2).alias("second_item_id"))


def first_blood(actors: DataFrame) -> DataFrame:
    """The participants who took part in each match's first kill."""
    kills = actors.where("event_type = 'CHAMPION_KILL'")
    first = kills.groupBy("match_id").agg(F.min("event_index").alias("event_index"))
    return kills.where("role_in_event IN ('actor', 'assist')").join(first, ["match_id", "event_index"], "left_semi").select(*KEY, F.lit(True).alias("first_blood_involvement"))


def cumulative_plates(actors: DataFrame) -> DataFrame:
    """Plates up to and with each time; plates at one time count together."""
    upto = Window.partitionBy(*KEY).orderBy("timestamp_ms").rangeBetween(Window.unboundedPreceding, 0)
    rows = actors.where("event_type = 'TURRET_PLATE_DESTROYED' AND role_in_event = 'actor'")
    return rows.select(*KEY, "timestamp_ms", F.count("*").over(upto).alias("plates")).distinct()


def plates_at(actors: DataFrame, picks: DataFrame) -> DataFrame:
    rows = last_before(picks.select(*KEY, "checkpoint", "frame_timestamp_ms"), cumulative_plates(actors), KEY, "frame_timestamp_ms", "timestamp_ms", ["plates"])
    return rows.groupBy(*KEY).agg(*(F.max(F.when(F.col("checkpoint") == c, F.coalesce("plates", F.lit(0)))).alias(f"plates_at_{c}") for c in CHECKPOINTS))


COUNTED = ("plates_destroyed", "duplicate_skill_ups", "wards_placed", "wards_killed", "dragons_participated", "grubs_participated", "heralds_participated", "barons_participated", "atakhan_participated")


def participant_early(index: DataFrame, players: DataFrame, actors: DataFrame, picks: DataFrame) -> DataFrame:
    who = players.join(eligible(index).select("match_id"), "match_id", "left_semi").select(*KEY, "region", "patch", "queue_id", "champion_id", "role", "team_id", "win")
    rows = who.join(involvement(actors), KEY, "left").join(first_blood(actors), KEY, "left").join(plates_at(actors, picks), KEY, "left")
    rows = rows.fillna(0, list(COUNTED)).withColumn("first_blood_involvement", F.coalesce("first_blood_involvement", F.lit(False)))
    return as_table(rows.withColumn("first_death_minute", minute_of(F.col("first_death_ts_ms"))), "participant_early")


# ---- objectives --------------------------------------------------------------------------


def team_events(all_events: DataFrame, players: DataFrame) -> DataFrame:
    """Events with the team they count for: a kill's is its killer's."""
    killers = players.select("match_id", F.col("participant_id").alias("actor_participant_id"), F.col("team_id").alias("killer_team"))
    rows = all_events.join(killers, ["match_id", "actor_participant_id"], "left")
    return rows.withColumn("team_id", F.when(F.col("event_type") == "CHAMPION_KILL", F.col("killer_team")).otherwise(F.col("team_id"))).drop("killer_team")


def match_objectives(index: DataFrame, all_events: DataFrame, players: DataFrame) -> DataFrame:
    """Who took each objective first, and how many each team took, in one aggregate."""
    team = F.col("team_id")
    first_team = lambda rule: F.min_by(F.when(rule, team), F.when(rule & team.isNotNull(), F.col("event_index")))
    first_time = lambda rule: F.min(F.when(rule, F.col("timestamp_ms")))
    kill, dragon, soul = (F.expr(OBJECTIVES[n]) for n in ("kills", "dragons", "souls"))
    tower = F.expr("event_type = 'BUILDING_KILL' AND tower_type = 'OUTER'")
    subtype = F.col("monster_subtype")
    firsts = [
        first_team(kill).alias("first_blood_team"), first_time(kill).alias("first_blood_ts_ms"), first_team(tower).alias("first_tower_team"), first_time(tower).alias("first_tower_ts_ms"),
        first_team(dragon).alias("first_dragon_team"), first_time(dragon).alias("first_dragon_ts_ms"), first_team(soul).alias("soul_team"),
        F.min_by(F.when(soul, subtype), F.when(soul & subtype.isNotNull(), F.col("event_index"))).alias("soul_type"),
    ]
    counts = [F.count_if(F.expr(rule) & (team == t)).alias(f"{name}_team_{t}") for name, rule in OBJECTIVES.items() for t in (100, 200)]
    per_match = team_events(all_events, players).groupBy("match_id").agg(*firsts, *counts)
    rows = eligible(index).select("match_id", "region", "patch", "queue_id", "game_duration_s").join(per_match, "match_id", "left")
    return as_table(rows, "match_objectives")


# ---- all of it ---------------------------------------------------------------------------


class Features(Owner):
    """What the six tables share: ledger, players, minutes and checkpoints, made when they are asked for.

    ``summaries`` and ``timelines`` are parsed envelopes with their copies. The ledger is made of narrow rows alone; the
    structs are stored once, when a table of players, frames or events is asked for, and frames and
    events are read from them by column. ``close`` removes what was stored.
    """

    def __init__(self, summaries: DataFrame, timelines: DataFrame, min_duration_s: int = MIN_DURATION_S, ledger_only: bool = False):
        super().__init__(summaries.sparkSession)
        narrow = lambda df: df.drop("doc") if ledger_only else df
        self._parsed, self.min_duration_s = (narrow(summaries), narrow(timelines)), min_duration_s

    @cached_property
    def summaries(self) -> DataFrame:
        return first_archived(self.stored(self._parsed[0], "parsed"), self.stored)

    @cached_property
    def timelines(self) -> DataFrame:
        return first_archived(self.stored(self._parsed[1], "parsed"), self.stored)

    @cached_property
    def index(self) -> DataFrame:
        return self.stored(match_index(self.summaries, self.timelines, self.min_duration_s), "index")

    @cached_property
    def players(self) -> DataFrame:
        """Players of the matches in the other tables."""
        return self.stored(summary_participants(self.summaries).join(eligible(self.index).select("match_id"), "match_id", "left_semi"), "players")

    @property
    def frames(self) -> DataFrame:
        return frames(self.timelines)

    @property
    def events(self) -> DataFrame:
        return events(self.timelines)

    def minutes_table(self) -> DataFrame:
        return participant_minutes(self.index, self.players, self.frames, kill_points(self.events))

    @cached_property
    def minutes(self) -> DataFrame:
        """The same, stored for the tables that are made of it."""
        return self.stored(self.minutes_table(), "minutes")

    @cached_property
    def picks(self) -> DataFrame:
        if "minutes" in self.__dict__:
            return self.stored(checkpoint_picks(self.minutes), "picks")
        return self.stored(frame_picks(self.players, self.frames, kill_points(self.events)), "picks")

    def seated_frames(self) -> DataFrame:
        """Frames with their players' roles: the minutes without running totals."""
        return self.frames.join(self.players.select(*KEY, "role"), KEY)

    def actors(self) -> DataFrame:
        return event_actors(self.events.join(eligible(self.index).select("match_id"), "match_id", "left_semi"))

    def events_table(self) -> DataFrame:
        return events_table(self.index, self.events)

    def lanes(self) -> DataFrame:
        return lane_matchups(self.index, self.players, self.picks)

    def early(self) -> DataFrame:
        return participant_early(self.index, self.players, self.actors(), self.picks)

    def objectives(self) -> DataFrame:
        return match_objectives(self.index, self.events, self.players)

    def tables(self) -> dict[str, DataFrame]:
        """The six tables, for a caller that writes them all."""
        return {
            "participant_minutes": self.minutes, "match_index": self.index, "events": self.events_table(), "lane_matchups": self.lanes(),
            "participant_early": self.early(), "match_objectives": self.objectives(),
        }
