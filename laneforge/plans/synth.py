"""A match archive derived from ``orders``, for queries on tables that hold no matches.

Order key ``k`` and customer key ``c`` give each match, player, frame and event by integer
arithmetic. Spark makes JSON payloads of them and runs the real extraction; ``sql_relations`` gives
the same relations as plain SQL, without JSON, to hold the results against.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laneforge.sources import archive, publish, shared

H = "(k * 17 + pid * 29 + c * 7)"
ACTOR = "(1 + (k + i * 3 + j * 7) % 10)"
KIND = "((k + i * 5 + j * 3) % 11)"
KILLS, SKILLS = f"{KIND} IN (0, 9)", f"{KIND} IN (5, 10)"
STEP = "(CASE WHEN k % 3 = 0 THEN 65000 ELSE 60000 END)"

#: ``{div}`` is integer division and ``{list}`` makes an array, as each engine writes them.
MATCH = {
    "match_id": "concat('EUW1_', lpad(CAST(k AS STRING), 10, '0'))",
    "game_version": "concat('16.', CAST(16 + k % 3 AS STRING), '.', CAST(100 + k % 7 AS STRING), '.1')",
    "platform_id": "CASE WHEN k % 11 = 0 THEN 'NA1' ELSE 'EUW1' END",
    "queue_id": "CASE WHEN k % 13 = 0 THEN 440 ELSE 420 END",
    "game_creation_ms": "1788220800000 + ((k * 7919) % 28800) * 60000",
    "game_duration_s": "CAST(240 + (k * 37) % 2000 AS INT)",
    "winner": "CASE WHEN (k {div} 3) % 2 = 0 THEN 100 ELSE 200 END",
}
PLAYER = {
    "champion_id": f"1 + least({H} % 40, ({H} {{div}} 40) % 40)",
    "team_id": "CASE WHEN pid <= 5 THEN 100 ELSE 200 END",
    "team_position": "CASE WHEN (k + pid) % 997 = 0 OR (k + pid) % 41 = 0 THEN '' ELSE {position} END",
    "individual_position": "CASE WHEN (k + pid) % 997 = 0 THEN 'Invalid' ELSE {position} END",
    **{f"item{s}": f"CASE WHEN (k + pid) % 53 = 0 THEN 0 ELSE 1000 + ({H} % {s + 2}) * 7 + {s} END" for s in range(6)},
    "item6": "3340",
    "summoner1_id": "4",
    "summoner2_id": f"CASE WHEN (k + pid) % 59 = 0 THEN 0 ELSE 11 + {H} % 3 END",
    "tree": f"8000 + 100 * ({H} % 3)",
    "keystone": f"8005 + {H} % 4",
    "subtree": f"8200 + 100 * ({H} % 2)",
    "flex": f"5008 + {H} % 2",
}
POSITION = "CASE (pid - 1) % 5 WHEN 0 THEN 'TOP' WHEN 1 THEN 'JUNGLE' WHEN 2 THEN 'MIDDLE' WHEN 3 THEN 'BOTTOM' ELSE 'UTILITY' END"
FRAMES = "(5 + (k {div} 20) % 26)"
FRAME = {
    "level": "CAST(1 + i {div} 3 AS INT)",
    "xp": "300 * i + 10 * pid + k % 50",
    "total_gold": "CAST(500 * i + 20 * pid + k % 90 AS INT)",
    "current_gold": "CAST(100 * i + 5 * pid AS INT)",
    "minions_killed": f"CAST(8 * i + {H} % 7 AS INT)",
    "jungle_minions_killed": "CAST(CASE WHEN (pid - 1) % 5 = 1 THEN 7 * i ELSE 0 END AS INT)",
    "position_x": "CAST(1000 + 100 * pid + i AS INT)",
    "position_y": "CAST(200 * i + k % 100 AS INT)",
}
TEAM = "CASE WHEN (k + i) % 2 = 0 THEN 100 ELSE 200 END"
EVENT = {
    "timestamp": f"(i - 1) * {STEP} + (j + 1) * 7000 + k % 100",
    "type": f"CASE {KIND} WHEN 0 THEN 'CHAMPION_KILL' WHEN 1 THEN 'WARD_PLACED' WHEN 2 THEN 'WARD_KILL' WHEN 3 THEN 'TURRET_PLATE_DESTROYED' "
    "WHEN 4 THEN 'ELITE_MONSTER_KILL' WHEN 6 THEN 'ITEM_PURCHASED' WHEN 7 THEN 'BUILDING_KILL' WHEN 8 THEN 'DRAGON_SOUL_GIVEN' WHEN 9 THEN 'CHAMPION_KILL' ELSE 'SKILL_LEVEL_UP' END",
    "participantId": f"CASE WHEN {KIND} IN (5, 6, 10) THEN {ACTOR} END",
    "killerId": f"CASE WHEN {KIND} IN (0, 2, 3, 4, 7, 9) THEN CASE WHEN (k + i + j) % 17 = 0 THEN 0 ELSE {ACTOR} END END",
    "creatorId": f"CASE WHEN {KIND} = 1 THEN {ACTOR} END",
    "victimId": f"CASE WHEN {KILLS} THEN 1 + ({ACTOR} + 4 + i % 5) % 10 END",
    "assists": f"CASE WHEN {KIND} IN (0, 4, 9) AND (i + j) % 5 <> 0 THEN CASE WHEN (i + j) % 2 = 0 THEN {{list}}(CAST(1 + ({ACTOR} + 1) % 10 AS INT), CAST(1 + ({ACTOR} + 2) % 10 AS INT)) ELSE {{list}}(CAST(1 + ({ACTOR} + 1) % 10 AS INT)) END END",
    "teamId": f"CASE WHEN {KIND} IN (3, 4, 7, 8) THEN {TEAM} END",
    "x": f"CASE WHEN {KIND} IN (0, 4, 7, 9) AND (k + i + j) % 19 <> 0 THEN 500 * j + i END",
    "y": f"CASE WHEN {KIND} IN (0, 4, 7, 9) AND (k + i + j) % 19 <> 0 THEN 700 + k % 97 END",
    "laneType": f"CASE WHEN {KIND} IN (3, 7) THEN CASE WHEN i % 2 = 0 THEN 'TOP_LANE' ELSE 'BOT_LANE' END END",
    "monsterType": f"CASE WHEN {KIND} = 4 THEN CASE (k + i) % 5 WHEN 0 THEN 'DRAGON' WHEN 1 THEN 'HORDE' WHEN 2 THEN 'RIFTHERALD' WHEN 3 THEN 'BARON_NASHOR' ELSE 'ATAKHAN' END END",
    "monsterSubType": f"CASE WHEN {KIND} = 4 AND (k + i) % 5 = 0 THEN 'FIRE_DRAGON' END",
    "soulType": f"CASE WHEN {KIND} = 8 THEN CASE WHEN k % 40 = 0 THEN 'Infernal' ELSE 'Ocean' END END",
    "buildingType": f"CASE WHEN {KIND} = 7 THEN 'TOWER_BUILDING' END",
    "towerType": f"CASE WHEN {KIND} = 7 THEN CASE (k + j) % 3 WHEN 0 THEN 'OUTER' WHEN 1 THEN 'INNER' END END",
    "wardType": f"CASE WHEN {KIND} IN (1, 2) THEN 'YELLOW_TRINKET' END",
    "itemId": f"CASE WHEN {KIND} = 6 THEN CASE WHEN (i + j) % 13 = 0 THEN 0 ELSE 1000 + (i * 4 + j) % 20 END END",
    "skillSlot": f"CASE WHEN {SKILLS} THEN 1 + (i + j) % 4 END",
    "level": f"CASE WHEN {SKILLS} THEN 1 + i {{div}} 8 END",
    "killStreakLength": f"CASE WHEN {KILLS} THEN i % 3 END",
    "bounty": f"CASE WHEN {KILLS} THEN 300 + i END",
}
#: Which matches have a timeline, and those without interval, frames, or players' frames.
TIMELINE, NO_INTERVAL, NO_FRAMES, NO_PLAYERS, COPY = "k % 20 = 0", "(k % 200 = 0 OR k % 260 = 0)", "k % 200 = 0", "k % 220 = 0", "k % 25 = 0"

#: Which matches are a crawl's newly fetched ones.
NEW = "k % 3 = 0"


def text(expression: str, engine: str) -> str:
    words = {"div": "div", "list": "array"} if engine == "spark" else {"div": "//", "list": "list_value"}
    return expression.replace("{position}", POSITION).format(**words)


# ---- Spark -------------------------------------------------------------------------------


#: Rows of the archive for a task and for a key that rows are dealt by, at the size of a summary; a timeline is as large as several.
TASK_ROWS, KEY_ROWS, TIMELINE_ROWS = 50_000, 20_000, 8
#: What rows are dealt by.
DEALT = ("fetched_at", "deal")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").cast("bigint").alias("k"), F.col("o_custkey").cast("bigint").alias("c"))
    return orders.select("*", *(F.expr(text(e, "spark")).alias(name) for name, e in MATCH.items()), F.lit(0).alias("later"))


def spread(rows: DataFrame, weight: int = 1) -> DataFrame:
    """Rows of some bytes, dealt before each becomes a payload of kilobytes: by day, as the archive is, and each task's in order of days.

    The archive is written by day and takes this order as it comes, so that payloads are neither shuffled nor sorted. Tasks and
    keys grow with the rows.
    """
    dealt, tasks = deal(rows, weight)
    return dealt.repartition(tasks, *DEALT).sortWithinPartitions(F.to_date("fetched_at"))


def deal(rows: DataFrame, weight: int) -> tuple[DataFrame, int]:
    """Rows with the columns that they are dealt by, and the tasks that they are dealt to."""
    day = F.date_add(F.to_date(F.timestamp_millis("game_creation_ms")), 1 + F.col("later"))
    size = weight * rows.count()
    tasks, keys = max(4 * rows.sparkSession.sparkContext.defaultParallelism, size // TASK_ROWS), max(8, size // (20 * KEY_ROWS))
    return rows.withColumns({"fetched_at": day.cast("timestamp"), "deal": F.pmod(F.xxhash64("k"), F.lit(keys))}), tasks


def each(name: str, numbers, expression: str) -> str:
    """An array of ``expression`` for each number in the place of ``name``: written out, so that Spark compiles it, as it doesn't a lambda.

    Beside a small lambda Spark makes many methods of it; without one it is part of a stage's single method, which is then too large to be compiled.
    """
    return "array(" + ", ".join(re.sub(rf"\b{name}\b", str(n), expression) for n in numbers) + ")"


def spark_text(table: dict[str, str]) -> dict[str, str]:
    return {name: text(e, "spark") for name, e in table.items()}


def archive_columns(rows: DataFrame, payload) -> DataFrame:
    day = F.to_date("fetched_at")
    return rows.select(
        "match_id", F.lit("EUW").alias("region"), F.col("queue_id").cast("int").alias("queue_id"), F.expr("concat('16.', CAST(16 + k % 3 AS STRING))").alias("patch"), "game_version",
        "game_creation_ms", "game_duration_s", F.lit("1").alias("payload_version"), "fetched_at", payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_sha256"), day.alias("dt"), F.concat(F.lit("dt="), day.cast("string"), F.lit("/part-00000")).alias("part"), F.col("k").alias("part_row"),
    )


def summaries(spark: SparkSession, sf_dir: str, of: DataFrame | None = None, where: str = "true") -> DataFrame:
    """The summary archive; some matches are archived again a day later, with the other winner. With ``of`` or ``where``, the summaries of the matches in it or of which it holds, told before a payload is made."""
    p = spark_text(PLAYER)
    fields = ", ".join(f"'{name}', {p[column]}" for name, column in {
        "championId": "champion_id", "teamId": "team_id", "teamPosition": "team_position", "individualPosition": "individual_position",
        **{f"item{s}": f"item{s}" for s in range(7)}, "summoner1Id": "summoner1_id", "summoner2Id": "summoner2_id",
    }.items())
    shards = f"named_struct('offense', 5008, 'flex', {p['flex']}, 'defense', 5001)"
    third = f"named_struct('description', 'statMods', 'style', 5000, 'selections', array(named_struct('perk', 5008), named_struct('perk', {p['flex']}), named_struct('perk', 5001)))"
    style = lambda name, number, perk: f"named_struct('description', {name}, 'style', {number}, 'selections', array(named_struct('perk', {perk})))"
    first = style("CASE WHEN (k + pid) % 61 = 0 THEN 'subStyle' ELSE 'primaryStyle' END", p["tree"], p["keystone"])
    styles = f"CASE WHEN (k + pid) % 67 = 0 THEN array({first}, {style(repr('subStyle'), p['subtree'], '8000')}, {third}) ELSE array({first}, {style(repr('subStyle'), p['subtree'], '8000')}) END"
    perks = f"named_struct('styles', {styles}, 'statPerks', CASE WHEN (k + pid) % 67 = 0 THEN NULL ELSE {shards} END)"
    player = f"named_struct('participantId', pid, 'puuid', concat('p', CAST({H} % 5000 AS STRING)), {fields}, 'win', ({p['team_id']}) = winner, 'perks', {perks})"
    ban = "named_struct('championId', CASE WHEN (k + t + b) % 9 = 0 THEN 0 ELSE 1 + (k * 3 + t * 5 + b * 7 + c) % 45 END, 'pickTurn', b)"
    teams = each("t", (0, 1), f"named_struct('teamId', 100 + 100 * t, 'win', (100 + 100 * t) = winner, 'bans', transform(sequence(1, 5), b -> {ban}))")
    payload = (
        "to_json(named_struct('metadata', named_struct('matchId', match_id), 'info', named_struct('gameVersion', game_version, 'platformId', platform_id, 'queueId', queue_id, "
        f"'gameCreation', game_creation_ms, 'gameDuration', game_duration_s, 'endOfGameResult', 'GameComplete', 'teams', {teams}, 'participants', {each('pid', range(1, 11), player)})))"
    )
    rows = base(spark, sf_dir).where(where)
    again = rows.where(COPY).withColumns({"winner": 300 - F.col("winner"), "later": F.lit(1)})
    rows = rows.unionByName(again)
    return archive_columns(spread(rows if of is None else rows.join(of.select("match_id"), "match_id", "left_semi")), F.expr(payload))


def timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline archive of one match in twenty."""
    f, e = spark_text(FRAME), spark_text(EVENT)
    player = (
        f"named_struct('participantId', pid, 'level', {f['level']}, 'xp', {f['xp']}, 'totalGold', {f['total_gold']}, 'currentGold', {f['current_gold']}, 'minionsKilled', {f['minions_killed']}, "
        f"'jungleMinionsKilled', {f['jungle_minions_killed']}, 'position', named_struct('x', {f['position_x']}, 'y', {f['position_y']}))"
    )
    players = f"CASE WHEN {NO_PLAYERS} THEN NULL ELSE map_from_arrays(transform(sequence(1, 10), pid -> CAST(pid AS STRING)), {each('pid', range(1, 11), player)}) END"
    plain = ", ".join(f"'{'assistingParticipantIds' if n == 'assists' else n}', {x}" for n, x in e.items() if n not in "xy")
    event = f"named_struct({plain}, 'position', CASE WHEN ({e['x']}) IS NOT NULL THEN named_struct('x', {e['x']}, 'y', {e['y']}) END)"
    events = f"CASE WHEN i = 0 THEN NULL ELSE {each('j', range(4), event)} END"
    frame = f"to_json(named_struct('timestamp', i * {STEP}, 'participantFrames', {players}, 'events', {events}))"
    last = f"CASE WHEN {NO_FRAMES} THEN 0 ELSE CAST({text(FRAMES, 'spark')} AS INT) - 1 END"
    head = f"to_json(named_struct('metadata', named_struct('matchId', match_id), 'info', named_struct('frameInterval', CASE WHEN {NO_INTERVAL} THEN 0 ELSE {STEP} END)))"
    # a frame is a row of its own while it is made; a match's frames lie together, in order, in the task that the match was dealt to
    dealt, tasks = deal(base(spark, sf_dir).where(TIMELINE), TIMELINE_ROWS)
    rows = dealt.repartition(tasks, *DEALT).withColumn("at", F.monotonically_increasing_id()).select("*", F.explode(F.expr(f"sequence(0, {last})")).alias("i"))
    rows = rows.sortWithinPartitions(F.to_date("fetched_at"), *DEALT, "at", "i").withColumn("frame", F.expr(frame))
    match = Window.partitionBy(F.to_date("fetched_at"), *DEALT, "at").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("frames", F.collect_list("frame").over(match)).where("i = 0")
    framed = F.concat(F.expr(f"substring({head}, 1, length({head}) - 2)"), F.lit(',"frames":['), F.array_join("frames", ","), F.lit("]}}"))
    return archive_columns(rows, F.when(F.expr(NO_FRAMES), F.expr(head)).otherwise(framed))


ROOTS: dict[tuple[str, str, str], str] = {}


def archived(spark: SparkSession, sf_dir: str, source: str, since: str | None = None) -> DataFrame:
    """The archive of a source ("summaries", "timelines", "played", the summaries of the matches that have a timeline, or "fetched", those of new matches): written once an application, then read as any archive is, from ``since`` on."""
    key = (spark.sparkContext.applicationId, sf_dir, source)
    if key not in ROOTS:
        root = shared.scratch(spark, "archive")
        only = {"of": archived(spark, sf_dir, "timelines")} if source == "played" else {"where": NEW} if source == "fetched" else {}
        made = timelines if source == "timelines" else summaries
        publish.append_archive(made(spark, sf_dir, **only).drop("dt", "part", "part_row"), root, source)
        ROOTS[key] = root
    return archive.read_archive(spark, ROOTS[key], source, since)


# ---- the same in SQL ---------------------------------------------------------------------

ROLE = "CASE {0} WHEN 'TOP' THEN 'TOP' WHEN 'JUNGLE' THEN 'JUNGLE' WHEN 'MIDDLE' THEN 'MID' WHEN 'BOTTOM' THEN 'BOTTOM' WHEN 'UTILITY' THEN 'SUPPORT' END"


def sql_relations() -> str:
    """Common table expressions, from ``WITH`` on, for DuckDB.

    ``m`` matches, ``p`` players, ``b`` bans, ``idx`` the ledger, ``f`` frames and ``e`` events of
    the matches with a usable timeline.
    """
    of = lambda table: ", ".join(f"{text(x, 'sql')} AS {n}" for n, x in table.items())
    ev = {n: text(x, "sql") for n, x in EVENT.items()}
    frames = text(FRAMES, "sql")
    return f"""WITH ord AS (SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(o_custkey AS BIGINT) AS c FROM orders),
m0 AS (SELECT k, c, {of(MATCH)} FROM ord),
m AS (SELECT *, concat('16.', CAST(16 + k % 3 AS STRING)) AS patch, 'EUW' AS region, CAST(make_timestamp(game_creation_ms * 1000) AS TIMESTAMP) AS game_creation FROM m0),
p0 AS (SELECT m.*, pid, {of(PLAYER)} FROM m CROSS JOIN (SELECT unnest(range(1, 11)) AS pid)),
p AS MATERIALIZED (SELECT *, team_id = winner AS win, {ROLE.format("CASE WHEN team_position = '' THEN individual_position ELSE team_position END")} AS role,
 CASE WHEN (k + pid) % 61 <> 0 THEN list_value(tree, keystone, subtree, 5008, flex, 5001) END AS rune_style, CAST(pid AS INT) AS participant_id FROM p0),
b AS (SELECT match_id, patch, platform_id, queue_id, game_creation, CASE WHEN (k + t + bt) % 9 = 0 THEN 0 ELSE 1 + (k * 3 + t * 5 + bt * 7 + c) % 45 END AS champion_id
 FROM m CROSS JOIN (SELECT unnest(range(0, 2)) AS t) CROSS JOIN (SELECT unnest(range(1, 6)) AS bt)),
idx0 AS (SELECT *, {TIMELINE} AS timeline_present,
 CASE WHEN {TIMELINE} THEN CAST(CASE WHEN {NO_INTERVAL} THEN 0 ELSE {STEP} END AS INT) END AS frame_interval_ms,
 CASE WHEN {TIMELINE} AND NOT {NO_FRAMES} THEN CAST({frames} AS INT) END AS frame_count,
 CASE WHEN {TIMELINE} THEN CASE WHEN {NO_FRAMES} OR {NO_PLAYERS} THEN 0 ELSE CAST(10 * {frames} AS BIGINT) END END AS participant_frame_count FROM m),
idx AS (SELECT *, CASE WHEN NOT timeline_present THEN 'no_timeline' WHEN frame_interval_ms = 0 AND coalesce(participant_frame_count, 0) = 0 THEN 'aborted'
 WHEN frame_interval_ms = 0 THEN 'frame_interval_zero' WHEN game_duration_s < 600 THEN 'too_short' WHEN coalesce(participant_frame_count, 0) = 0 THEN 'frames_null' ELSE 'ok' END AS exclusion_reason FROM idx0),
ok AS (SELECT * FROM idx WHERE exclusion_reason = 'ok'),
i AS (SELECT ok.k, ok.c, ok.match_id, ok.patch, ok.queue_id, i FROM ok, unnest(range(0, {frames})) AS r(i)),
f AS (SELECT i.*, CAST(pid AS INT) AS participant_id, i * {STEP} AS frame_timestamp_ms, CAST(floor(i * {STEP} / 60000.0) AS INT) AS minute, {of(FRAME)}
 FROM i CROSS JOIN (SELECT unnest(range(1, 11)) AS pid)),
e0 AS (SELECT k, match_id, patch, queue_id, CAST((i - 1) * 4 + j AS INT) AS event_index, {ev['timestamp']} AS timestamp_ms, {ev['type']} AS event_type,
 CAST(coalesce({ev['participantId']}, {ev['killerId']}, {ev['creatorId']}) AS INT) AS actor_participant_id, CAST({ev['victimId']} AS INT) AS target_participant_id, {ev['assists']} AS assisting_participant_ids,
 CAST({ev['teamId']} AS INT) AS team_id, CAST({ev['x']} AS INT) AS position_x, CAST({ev['y']} AS INT) AS position_y, {ev['laneType']} AS lane_type, {ev['monsterType']} AS monster_type,
 coalesce({ev['monsterSubType']}, {ev['soulType']}) AS monster_subtype, {ev['buildingType']} AS building_type, {ev['towerType']} AS tower_type, {ev['wardType']} AS ward_type,
 CAST({ev['itemId']} AS INT) AS item_id, CAST({ev['skillSlot']} AS INT) AS skill_slot, CAST({ev['level']} AS INT) AS level, CAST({ev['killStreakLength']} AS INT) AS kill_streak_length, CAST({ev['bounty']} AS INT) AS bounty
 FROM i CROSS JOIN (SELECT unnest(range(0, 4)) AS j) WHERE i > 0),
e AS (SELECT *, CAST(floor(timestamp_ms / 60000.0) AS INT) AS minute, coalesce(event_type = 'SKILL_LEVEL_UP'
 AND row_number() OVER (PARTITION BY match_id, actor_participant_id, skill_slot, level ORDER BY event_index) > 1, false) AS is_duplicate_skill_level_up FROM e0),
pt AS (SELECT match_id, actor_participant_id AS participant_id, timestamp_ms, 1 AS kills, 0 AS deaths, 0 AS assists FROM e WHERE event_type = 'CHAMPION_KILL' AND actor_participant_id > 0
 UNION ALL SELECT match_id, target_participant_id, timestamp_ms, 0, 1, 0 FROM e WHERE event_type = 'CHAMPION_KILL' AND target_participant_id > 0
 UNION ALL SELECT match_id, unnest(assisting_participant_ids), timestamp_ms, 0, 0, 1 FROM e WHERE event_type = 'CHAMPION_KILL'),
kda AS (SELECT f.match_id, f.participant_id, f.frame_timestamp_ms, CAST(coalesce(sum(kills), 0) AS BIGINT) AS kills_to_minute, CAST(coalesce(sum(deaths), 0) AS BIGINT) AS deaths_to_minute,
 CAST(coalesce(sum(assists), 0) AS BIGINT) AS assists_to_minute FROM f LEFT JOIN pt ON pt.match_id = f.match_id AND pt.participant_id = f.participant_id AND pt.timestamp_ms <= f.frame_timestamp_ms GROUP BY 1, 2, 3),
mins AS (SELECT f.match_id, f.participant_id, p.champion_id, p.role, p.team_id, p.win, f.frame_timestamp_ms, f.minute, f.level, f.xp, f.total_gold, f.current_gold, f.minions_killed,
 f.jungle_minions_killed, f.minions_killed + f.jungle_minions_killed AS cs_total, f.position_x, f.position_y, kills_to_minute, deaths_to_minute, assists_to_minute, p.patch, p.region, p.queue_id
 FROM f JOIN p ON p.match_id = f.match_id AND p.participant_id = f.participant_id JOIN kda ON kda.match_id = f.match_id AND kda.participant_id = f.participant_id AND kda.frame_timestamp_ms = f.frame_timestamp_ms),
chk AS (SELECT * FROM (SELECT mins.*, cp AS checkpoint, row_number() OVER (PARTITION BY mins.match_id, participant_id, cp ORDER BY abs(frame_timestamp_ms - cp * 60000), frame_timestamp_ms) AS pick
 FROM mins JOIN (SELECT match_id, max(frame_timestamp_ms) AS last_ms FROM mins GROUP BY 1) l ON l.match_id = mins.match_id, (VALUES (5), (10), (15)) v(cp)
 WHERE frame_timestamp_ms BETWEEN cp * 60000 - 60000 AND cp * 60000 + 30000 AND cp * 60000 <= last_ms) WHERE pick = 1),
act AS (SELECT match_id, event_index, event_type, timestamp_ms, minute, team_id, monster_type, monster_subtype, skill_slot, level, item_id, position_x, position_y, is_duplicate_skill_level_up, actor_participant_id AS participant_id, 'actor' AS role_in_event FROM e WHERE actor_participant_id > 0
 UNION ALL SELECT match_id, event_index, event_type, timestamp_ms, minute, team_id, monster_type, monster_subtype, skill_slot, level, item_id, position_x, position_y, is_duplicate_skill_level_up, target_participant_id, 'target' FROM e WHERE target_participant_id > 0
 UNION ALL SELECT match_id, event_index, event_type, timestamp_ms, minute, team_id, monster_type, monster_subtype, skill_slot, level, item_id, position_x, position_y, is_duplicate_skill_level_up, unnest(assisting_participant_ids), 'assist' FROM e)
"""
