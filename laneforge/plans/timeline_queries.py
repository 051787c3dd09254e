"""Feature dataset queries: the six tables, what they are made of, recipes and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneforge.operators import extract, gates, recipes, timeline
from laneforge.plans import synth
from laneforge.plans.catalog import query
from laneforge.sources import archive, schemas, shared

W = synth.sql_relations()


class Dataset(timeline.Features):
    """The relations of the feature dataset over the derived archive, made when they are asked for.

    Only the ledger has rows of matches without a timeline. All other tables are of eligible matches, so where the ledger is not asked for
    (``whole`` is false), the summaries are those of the matches that have a timeline: all matches' ids are held against the timelines'.
    Payloads are parsed to ``lines``, the fields that are read.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, ledger_only: bool = False, whole: bool = True, lines: str = schemas.TIMELINE):
        seats, lines = (schemas.SEATS, schemas.TIMELINE_LEDGER) if ledger_only else (schemas.SEATED, lines)
        summaries = archive.summary_envelope(archive.parse_summaries(synth.archived(spark, sf_dir, "summaries" if whole else "played"), seats))
        super().__init__(summaries.where(extract.feature_scope()), archive.timeline_envelope(synth.archived(spark, sf_dir, "timelines"), lines), ledger_only=ledger_only)


def made(name: str, sql: str, of, ledger_only: bool = False, whole: bool = False, lines: str = schemas.TIMELINE):
    query(name, W + sql)(lambda spark, sf_dir: of(Dataset(spark, sf_dir, ledger_only, ledger_only or whole, lines)))


made("match_index", """SELECT match_id, region, platform_id, patch, CAST(queue_id AS INT) AS queue_id, game_version,
 game_creation, game_duration_s, 'GameComplete' AS end_of_game_result, frame_interval_ms, frame_count, participant_frame_count,
 timeline_present, exclusion_reason, exclusion_reason = 'ok' AS timeline_eligible
 FROM idx""", lambda d: d.index, ledger_only=True)
made("exclusion_counts", "SELECT exclusion_reason AS reason, count(*) AS matches FROM idx GROUP BY 1", lambda d: gates.exclusion_counts(d.index), ledger_only=True)
made("timeline_envelope", """SELECT match_id, region, patch, CAST(queue_id AS INT) AS queue_id, frame_interval_ms,
 frame_count, participant_frame_count FROM idx WHERE timeline_present""", lambda d: d.timelines.select("match_id", "region", "patch", "queue_id", "frame_interval_ms", "frame_count", "participant_frame_count"), ledger_only=True)
made("summary_participants", """SELECT match_id, region, patch, CAST(queue_id AS INT) AS queue_id, platform_id,
 game_creation, game_duration_s, participant_id, CAST(champion_id AS INT) AS champion_id, CAST(team_id AS INT) AS team_id,
 role, team_position, individual_position, win FROM p""", lambda d: extract.summary_participants(d.summaries), whole=True)
made("frames", """SELECT match_id, participant_id, frame_timestamp_ms, minute, level, xp, total_gold, current_gold,
 minions_killed, jungle_minions_killed, minions_killed + jungle_minions_killed AS cs_total, position_x, position_y
 FROM f""", lambda d: d.frames.join(timeline.eligible(d.index).select("match_id"), "match_id", "left_semi").drop("region", "patch", "queue_id"))
E_COLUMNS = {"match_id": "match_id", "region": "'EUW'", "patch": "patch", "queue_id": "CAST(queue_id AS INT)", "assisting_participant_ids": "array_to_string(assisting_participant_ids, ',')", "before_item_id": "NULL::INT", "after_item_id": "NULL::INT", "kill_type": "NULL::VARCHAR", "multi_kill_length": "NULL::INT", "transform_type": "NULL::VARCHAR", "shutdown_bounty": "NULL::INT", "winning_team": "NULL::INT"}
made("events_table", "SELECT " + ", ".join(f"{E_COLUMNS.get(c, c)} AS {c}" for c, _ in schemas.EVENTS) + " FROM e", lambda d: d.events_table().withColumn("assisting_participant_ids", F.array_join("assisting_participant_ids", ",")), lines=schemas.TIMELINE_EVENTS)
made("mark_duplicate_events", """SELECT match_id, event_index, actor_participant_id, skill_slot, level
 FROM e WHERE is_duplicate_skill_level_up""", lambda d: d.events_table().where("is_duplicate_skill_level_up").select("match_id", "event_index", "actor_participant_id", "skill_slot", "level"), lines=schemas.TIMELINE_EVENTS)
made("event_actors", "SELECT match_id, event_index, event_type, participant_id, role_in_event FROM act", lambda d: d.actors().select("match_id", "event_index", "event_type", "participant_id", "role_in_event"), lines=schemas.TIMELINE_EVENTS)
made("merged_points", """SELECT match_id, participant_id, timestamp_ms, CAST(sum(kills) AS BIGINT) AS kills,
 CAST(sum(deaths) AS BIGINT) AS deaths, CAST(sum(assists) AS BIGINT) AS assists
 FROM pt GROUP BY 1, 2, 3""", lambda d: timeline.merged_points(timeline.kill_points(d.events_table())), lines=schemas.TIMELINE_EVENTS)
made("kill_points", "SELECT * FROM pt", lambda d: timeline.kill_points(d.events_table()), lines=schemas.TIMELINE_EVENTS)
made("running_kda", """SELECT match_id, participant_id, timestamp_ms, CAST(sum(sum(kills)) OVER w AS BIGINT) AS kills_to_minute,
 CAST(sum(sum(deaths)) OVER w AS BIGINT) AS deaths_to_minute, CAST(sum(sum(assists)) OVER w AS BIGINT) AS assists_to_minute
 FROM pt GROUP BY 1, 2, 3 WINDOW w AS (PARTITION BY match_id, participant_id
 ORDER BY timestamp_ms)""", lambda d: timeline.running_kda(timeline.kill_points(d.events_table())), lines=schemas.TIMELINE_EVENTS)
made("participant_minutes", "SELECT " + ", ".join(f"CAST({c} AS {k.upper()}) AS {c}" for c, k in schemas.PARTICIPANT_MINUTES) + " FROM mins", lambda d: d.minutes_table())
CHK = "match_id, participant_id, checkpoint, frame_timestamp_ms, cs_total, xp, total_gold, level, kills_to_minute, deaths_to_minute, assists_to_minute"
made("nearest_checkpoint", f"SELECT {CHK} FROM chk", lambda d: d.picks.select(*CHK.split(", ")))
made("checkpoint_pivot", "SELECT match_id, participant_id, " + ", ".join(f"max({n}) FILTER (WHERE checkpoint = {c}) AS {n}_at_{c}" for c in (5, 10, 15) for n in timeline.AT_CHECKPOINT[1:]) + " FROM chk GROUP BY 1, 2", lambda d: timeline.checkpoint_pivot(d.picks))
#: A team has one player of a role, so the players of a role in a match are two columns each of one aggregate.
SIDED = ", ".join(f"max(CASE WHEN team_id = {100 * t} THEN {c} END) AS {n}{t}" for t in (1, 2) for c, n in (("participant_id", "pid"), ("champion_id", "champ"), ("CAST(win AS INT)", "won")))
ONE_WAY = """SELECT match_id, region, patch, CAST(queue_id AS INT) AS queue_id, pid{0} AS participant_id, pid{1} AS opponent_participant_id,
 role, CAST(champ{0} AS INT) AS champion_id,
 CAST(champ{1} AS INT) AS opponent_champion_id, CAST({0}00 AS INT) AS team_id, won{0} = 1 AS win, 'team_position' AS pairing_basis,
 role IN ('BOTTOM', 'SUPPORT') AS is_duo_lane,
 role <> 'JUNGLE' AS has_nominal_opponent FROM sd WHERE pid1 IS NOT NULL AND pid2 IS NOT NULL"""
PAIRS = f"""WITH sd AS MATERIALIZED (SELECT match_id, role, any_value(region) AS region, any_value(patch) AS patch,
 any_value(queue_id) AS queue_id, {SIDED}
 FROM p WHERE role IS NOT NULL AND match_id IN (SELECT match_id FROM ok) GROUP BY 1, 2) {ONE_WAY.format(1, 2)} UNION ALL {ONE_WAY.format(2, 1)}"""
made("lane_pairs", f", pr AS ({PAIRS}) SELECT * FROM pr", lambda d: timeline.lane_pairs(d.index, d.players), lines=schemas.TIMELINE_EVENTS)
_side = lambda c: f"""LEFT JOIN chk c{c} ON c{c}.match_id = pr.match_id AND c{c}.participant_id = pr.participant_id
 AND c{c}.checkpoint = {c} LEFT JOIN chk o{c} ON o{c}.match_id = pr.match_id AND o{c}.participant_id = pr.opponent_participant_id
 AND o{c}.checkpoint = {c}"""  # noqa: E731
_cols = lambda c: f"""c{c}.cs_total AS cs_{c}, o{c}.cs_total AS opponent_cs_{c}, c{c}.cs_total - o{c}.cs_total AS cs_diff_{c},
 c{c}.xp - o{c}.xp AS xp_diff_{c}, c{c}.total_gold - o{c}.total_gold AS gold_diff_{c}, c{c}.level - o{c}.level AS level_diff_{c},
 c{c}.kills_to_minute AS kills_{c}, c{c}.deaths_to_minute AS deaths_{c}, c{c}.assists_to_minute AS assists_{c}"""  # noqa: E731
LANES = f", pr AS ({PAIRS}), lm AS (SELECT pr.*, {', '.join(map(_cols, (5, 10, 15)))} FROM pr {' '.join(map(_side, (5, 10, 15)))})"
made("lane_matchups", LANES + " SELECT * FROM lm", lambda d: d.lanes())
OTHER = [f"{x}_{c}" for c in (5, 10, 15) for x in ("kills", "deaths", "assists")]
made("opponent_recipe", LANES + " SELECT p.match_id, p.participant_id, p.role, " + ", ".join(f"o.{n} AS o_{n}" for n in OTHER) + """
 FROM lm p JOIN lm o ON o.match_id = p.match_id AND o.participant_id = p.opponent_participant_id
 WHERE NOT p.is_duo_lane AND p.has_nominal_opponent""", lambda d: recipes.opponents(d.lanes()).select("match_id", "participant_id", "role", *(f"o_{n}" for n in OTHER)))
COUNT = lambda kind, role, more="": f"count(*) FILTER (WHERE event_type = '{kind}' AND role_in_event IN ({role}){more})"
BOTH = "'actor', 'assist'"
EARLY = f""", inv AS (SELECT match_id, participant_id, {COUNT('WARD_PLACED', "'actor'")} AS wards_placed, {COUNT('WARD_KILL', "'actor'")} AS wards_killed,
 {COUNT('TURRET_PLATE_DESTROYED', "'actor'")} AS plates_destroyed,
 {', '.join(f"{COUNT('ELITE_MONSTER_KILL', BOTH, f' AND monster_type = {m!r}')} AS {n}_participated" for m, n in (('DRAGON', 'dragons'), ('HORDE', 'grubs'), ('RIFTHERALD', 'heralds'), ('BARON_NASHOR', 'barons'), ('ATAKHAN', 'atakhan')))},
 {COUNT('SKILL_LEVEL_UP', "'actor'", ' AND is_duplicate_skill_level_up')} AS duplicate_skill_ups, min(timestamp_ms) FILTER (WHERE event_type = 'CHAMPION_KILL'
 AND role_in_event = 'target') AS first_death_ts_ms,
 arg_min(position_x, timestamp_ms) FILTER (WHERE event_type = 'CHAMPION_KILL' AND role_in_event = 'target'
 AND position_x IS NOT NULL) AS first_death_position_x,
 arg_min(position_y, timestamp_ms) FILTER (WHERE event_type = 'CHAMPION_KILL' AND role_in_event = 'target'
 AND position_y IS NOT NULL) AS first_death_position_y FROM act GROUP BY 1, 2),
fbe AS (SELECT match_id, min(event_index) AS event_index FROM act WHERE event_type = 'CHAMPION_KILL' GROUP BY 1),
fb AS (SELECT DISTINCT act.match_id, participant_id, true AS first_blood_involvement
 FROM act JOIN fbe USING (match_id, event_index) WHERE role_in_event IN ('actor', 'assist')),
sk AS (SELECT match_id, participant_id, string_agg(CAST(skill_slot AS VARCHAR), ''
 ORDER BY timestamp_ms, event_index) AS skill_order FROM act WHERE event_type = 'SKILL_LEVEL_UP' AND role_in_event = 'actor'
 AND NOT is_duplicate_skill_level_up AND skill_slot IS NOT NULL GROUP BY 1, 2),
its AS (SELECT *, row_number() OVER (PARTITION BY match_id, participant_id
 ORDER BY timestamp_ms, event_index) AS seq FROM act WHERE event_type = 'ITEM_PURCHASED' AND role_in_event = 'actor'
 AND item_id > 0),
it AS (SELECT match_id, participant_id, min(timestamp_ms) FILTER (WHERE seq = 1) AS first_item_ts_ms, min(item_id) FILTER (WHERE seq = 1) AS first_item_id,
 min(timestamp_ms) FILTER (WHERE seq = 2) AS second_item_ts_ms, min(item_id) FILTER (WHERE seq = 2) AS second_item_id
 FROM its GROUP BY 1, 2),
pl AS (SELECT match_id, participant_id, timestamp_ms FROM act WHERE event_type = 'TURRET_PLATE_DESTROYED' AND role_in_event = 'actor'),
pla AS (SELECT chk.match_id, chk.participant_id, {', '.join(f"CASE WHEN count(*) FILTER (WHERE checkpoint = {c}) > 0 THEN count(pl.timestamp_ms) FILTER (WHERE checkpoint = {c}) END AS plates_at_{c}" for c in (5, 10, 15))}
 FROM chk LEFT JOIN pl ON pl.match_id = chk.match_id AND pl.participant_id = chk.participant_id AND pl.timestamp_ms <= chk.frame_timestamp_ms
 GROUP BY 1, 2),
early AS (SELECT p.match_id, p.region, p.patch, CAST(p.queue_id AS INT) AS queue_id, p.participant_id, CAST(p.champion_id AS INT) AS champion_id,
 p.role, CAST(p.team_id AS INT) AS team_id, p.win, coalesce(first_blood_involvement, false) AS first_blood_involvement,
 first_death_ts_ms, CAST(floor(first_death_ts_ms / 60000.0) AS INT) AS first_death_minute, first_death_position_x,
 first_death_position_y, coalesce(plates_destroyed, 0) AS plates_destroyed, plates_at_5, plates_at_10, plates_at_15,
 first_item_ts_ms, first_item_id, second_item_ts_ms, second_item_id, skill_order, {', '.join(f"coalesce({c}, 0) AS {c}" for c in timeline.COUNTED[1:])}
 FROM p JOIN ok USING (match_id) LEFT JOIN inv ON inv.match_id = p.match_id AND inv.participant_id = p.participant_id
 LEFT JOIN fb ON fb.match_id = p.match_id AND fb.participant_id = p.participant_id
 LEFT JOIN sk ON sk.match_id = p.match_id AND sk.participant_id = p.participant_id
 LEFT JOIN it ON it.match_id = p.match_id AND it.participant_id = p.participant_id
 LEFT JOIN pla ON pla.match_id = p.match_id AND pla.participant_id = p.participant_id)"""
made("involvement", EARLY + """ SELECT match_id, participant_id, wards_placed, wards_killed, plates_destroyed,
 dragons_participated, grubs_participated, heralds_participated, barons_participated, atakhan_participated,
 duplicate_skill_ups, first_death_ts_ms, first_death_position_x, first_death_position_y
 FROM inv""", lambda d: timeline.involvement(d.actors()).drop("skill_order", "first_item_ts_ms", "first_item_id", "second_item_ts_ms", "second_item_id"), lines=schemas.TIMELINE_EVENTS)
made("first_blood", EARLY + " SELECT * FROM fb", lambda d: timeline.first_blood(d.actors()), lines=schemas.TIMELINE_EVENTS)
made("skill_order", EARLY + " SELECT * FROM sk", lambda d: timeline.skill_order(d.actors()), lines=schemas.TIMELINE_EVENTS)
made("item_timings", EARLY + " SELECT * FROM it", lambda d: timeline.item_timings(d.actors()), lines=schemas.TIMELINE_EVENTS)
made("cumulative_plates", EARLY + """ SELECT match_id, participant_id, timestamp_ms, count(*) OVER (PARTITION BY match_id,
 participant_id ORDER BY timestamp_ms) AS plates FROM pl""", lambda d: timeline.cumulative_plates(d.actors()), lines=schemas.TIMELINE_EVENTS)
made("asof_plates", EARLY + " SELECT * FROM pla", lambda d: timeline.plates_at(d.actors(), d.picks))
made("participant_early", EARLY + " SELECT * FROM early", lambda d: d.early())
OBJ = ", ".join(f"count(*) FILTER (WHERE team_id = {t} AND {rule}) AS {n}_team_{t}" for n, rule in schemas.OBJECTIVES.items() for t in (100, 200))
_first = lambda rule, name: f"""arg_min(team_id, event_index) FILTER (WHERE {rule} AND team_id IS NOT NULL) AS first_{name}_team,
 min(timestamp_ms) FILTER (WHERE {rule}) AS first_{name}_ts_ms"""  # noqa: E731
OBJECTIVES = f""", te AS (SELECT e.match_id, event_index, timestamp_ms, event_type, monster_type, monster_subtype,
 tower_type, CAST(CASE WHEN event_type = 'CHAMPION_KILL' THEN p.team_id ELSE e.team_id END AS INT) AS team_id
 FROM e LEFT JOIN p ON p.match_id = e.match_id AND p.participant_id = e.actor_participant_id),
pm AS (SELECT match_id, {_first(schemas.OBJECTIVES['kills'], 'blood')}, {_first("event_type = 'BUILDING_KILL' AND tower_type = 'OUTER'", 'tower')},
 {_first(schemas.OBJECTIVES['dragons'], 'dragon')},
 arg_min(team_id, event_index) FILTER (WHERE event_type = 'DRAGON_SOUL_GIVEN' AND team_id IS NOT NULL) AS soul_team,
 arg_min(monster_subtype, event_index) FILTER (WHERE event_type = 'DRAGON_SOUL_GIVEN' AND monster_subtype IS NOT NULL) AS soul_type,
 {OBJ} FROM te GROUP BY 1),
obj AS (SELECT ok.match_id, ok.region, ok.patch, CAST(ok.queue_id AS INT) AS queue_id, game_duration_s, pm.* EXCLUDE (match_id)
 FROM ok LEFT JOIN pm USING (match_id))"""
made("match_objectives", OBJECTIVES + " SELECT * FROM obj", lambda d: d.objectives(), lines=schemas.TIMELINE_EVENTS)
made("killer_team", OBJECTIVES + " SELECT match_id, event_index, team_id FROM te WHERE event_type = 'CHAMPION_KILL'", lambda d: timeline.team_events(d.events_table(), d.players).where("event_type = 'CHAMPION_KILL'").select("match_id", "event_index", "team_id"), lines=schemas.TIMELINE_EVENTS)
made("orphan_timelines", "SELECT match_id FROM idx WHERE timeline_present AND k % 60 = 0", lambda d: timeline.orphan_timelines(d.timelines, d.summaries.where(F.substring("match_id", 6, 10).cast("bigint") % 60 != 0)).select("match_id"), ledger_only=True)
@query("ledger_counts", W + """SELECT count(*) AS matches, count_if(timeline_present) AS timelines, count_if(exclusion_reason = 'ok') AS eligible,
 count_if(exclusion_reason <> 'ok') AS excluded, count_if(k % 7 = 0) AS unexplained, count(*) AS distinct_matches, count_if(k % 8 = 0) AS malformed,
 count_if(timeline_present AND k % 60 = 0) AS orphans FROM idx""")
def ledger_counts(spark, sf_dir):
    """Counts over a ledger with faults: matches without a reason, summaries that are no JSON, timelines without a summary."""
    d, number = Dataset(spark, sf_dir, ledger_only=True), F.substring("match_id", 6, 10).cast("bigint")
    unexplained = d.index.withColumn("exclusion_reason", F.when(number % 7 != 0, F.col("exclusion_reason")))
    broken = d.summaries.withColumn("payload_valid", number % 8 != 0)
    return gates.ledger_counts(unexplained, broken, timeline.orphan_timelines(d.timelines, some_summaries(d)))


made("table_row_counts", f""", pr AS ({PAIRS}) SELECT 'match_index' AS table_name, count(*) AS rows
 FROM idx UNION ALL SELECT 'events', count(*) FROM e UNION ALL SELECT 'match_objectives', count(*)
 FROM ok UNION ALL SELECT 'participant_minutes', count(*) FROM f UNION ALL SELECT 'lane_matchups', count(*)
 FROM pr UNION ALL SELECT 'participant_early', 10 * count(*) FROM ok""", lambda d: gates.table_row_counts(d.tables()), whole=True)
made("reconcile_matchups", f""", pr AS ({PAIRS}) SELECT count(*) AS rows, count(DISTINCT match_id) AS matches,
 (SELECT count(*) FROM ok) AS eligible FROM pr""", lambda d: gates.reconcile_matchups(timeline.lane_pairs(d.index, d.players), d.index), lines=schemas.TIMELINE_EVENTS)
LANE_FAULTS = f""", pr AS ({PAIRS}) SELECT 'orphan_timelines' AS reason WHERE (SELECT count(*) FROM idx WHERE timeline_present AND k % 60 = 0) > 0
UNION ALL SELECT 'lane_rows' FROM pr WHERE role <> 'TOP' HAVING count(*) <> 10 * (SELECT count(*) FROM ok)"""


def some_summaries(d: Dataset) -> DataFrame:
    """Summaries without one match in sixty."""
    return d.summaries.where(F.substring("match_id", 6, 10).cast("bigint") % 60 != 0)


made("gate_features", LANE_FAULTS, lambda d: gates.feature_gate(
    gates.ledger_counts(d.index, d.summaries, timeline.orphan_timelines(d.timelines, some_summaries(d))),
    gates.reconcile_matchups(timeline.lane_pairs(d.index, d.players).where("role <> 'TOP'"), d.index),
), whole=True)



def rounded(df, *columns):
    """Averages whose terms cancel, without the noise of the order of addition."""
    return df.withColumns({c: F.round(c, 9) + 0.0 for c in columns})


WIN = "avg(CAST(win AS INT)) AS win_rate"
made("recipe_cs_at_five", LANES + f""" SELECT cs_diff_5 <= -10 AS lost_lane, count(*) AS n, {WIN}
 FROM lm WHERE NOT is_duo_lane AND has_nominal_opponent AND cs_diff_5 IS NOT NULL
 GROUP BY 1""", lambda d: recipes.cs_at_five(d.lanes()))
_kda = lambda s, c: f"""CAST({s}.kills_{c} + {s}.assists_{c} AS DOUBLE) / CASE WHEN {s}.deaths_{c} IS NULL THEN NULL
 ELSE greatest({s}.deaths_{c}, 1) END"""  # noqa: E731
made("recipe_kda_vs_opponent", LANES + f""" SELECT p.role, count(*) AS n, {', '.join(f'round(avg({_kda(chr(112), c)} - {_kda(chr(111), c)}), 9) + 0.0 AS avg_kda_diff_{c}' for c in (5, 10, 15))},
 avg(CAST(p.win AS INT)) AS win_rate FROM lm p JOIN lm o ON o.match_id = p.match_id AND o.participant_id = p.opponent_participant_id
 WHERE NOT p.is_duo_lane AND p.has_nominal_opponent GROUP BY 1""", lambda d: rounded(recipes.kda_vs_opponent(d.lanes()), "avg_kda_diff_5", "avg_kda_diff_10", "avg_kda_diff_15"))
made("recipe_cs_diff_curve", LANES + f""" SELECT CAST(floor(cs_diff_10 / 10.0) * 10 AS DOUBLE) AS cs_diff_bucket,
 count(*) AS n, {WIN} FROM lm WHERE role = 'MID' AND cs_diff_10 IS NOT NULL
 GROUP BY 1 HAVING count(*) >= 30""", lambda d: recipes.cs_diff_curve(d.lanes()))
made("recipe_minute_curves", """SELECT minute, avg(cs_total) AS avg_cs, avg(CASE WHEN role = 'JUNGLE' THEN jungle_minions_killed END) AS avg_jungle_cs,
 avg(total_gold) AS avg_gold FROM mins WHERE minute <= 20 GROUP BY 1""", lambda d: recipes.minute_curves(d.seated_frames()))
made("recipe_first_objective", OBJECTIVES + f""" SELECT obj.first_dragon_team = p.team_id AS took_first_dragon,
 count(DISTINCT p.match_id) AS games, count(*) AS participant_sides, {WIN}
 FROM obj JOIN p USING (match_id) WHERE first_dragon_team IS NOT NULL GROUP BY 1""", lambda d: recipes.first_objective(d.objectives(), d.early()))
made("recipe_event_timing", """SELECT event_type, count(*) AS n, quantile_cont(timestamp_ms, 0.5) / 60000 AS median_minute,
 count(*) FILTER (WHERE is_duplicate_skill_level_up) AS duplicates FROM e
 GROUP BY 1""", lambda d: recipes.event_timing(d.events_table()), lines=schemas.TIMELINE_EVENTS)
made("recipe_death_positions", """SELECT minute, position_x, position_y, count(*) AS deaths
 FROM e WHERE event_type = 'CHAMPION_KILL' AND target_participant_id > 0
 GROUP BY 1, 2, 3""", lambda d: recipes.death_positions(d.events_table()), lines=schemas.TIMELINE_EVENTS)
made("recipe_skill_order_top", EARLY + """ SELECT role, skill_order, count(*) AS n
 FROM early WHERE skill_order IS NOT NULL AND role = 'TOP' GROUP BY 1, 2
 ORDER BY n DESC, skill_order LIMIT 20""", lambda d: recipes.skill_order_top(d.early()))
made("recipe_cs_bucket_frame", LANES + f""" SELECT CAST(floor(cs_diff_5 / 10.0) * 10 AS INT) AS cs_diff_bucket,
 count(*) AS n, {WIN} FROM lm WHERE NOT is_duo_lane AND has_nominal_opponent AND cs_diff_5 IS NOT NULL
 GROUP BY 1""", lambda d: recipes.cs_buckets(d.lanes()))


@query("feature_scope", W + """SELECT exclusion_reason AS reason, count(*) AS matches
 FROM idx WHERE platform_id IN ('NA', 'NA1') AND queue_id = 420 GROUP BY 1""")
def feature_scope(spark, sf_dir):
    d = Dataset(spark, sf_dir, ledger_only=True)
    return gates.exclusion_counts(timeline.match_index(d.summaries.where(extract.feature_scope("NA", queue=420)), d.timelines))


@query("asof_events", """SELECT l.event_id, l.user_id, r.value AS last_purchase
 FROM events l ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') r ON r.user_id = l.user_id
 AND l.ts >= r.ts""")
def asof_events(spark, sf_dir):
    """Each event with its user's latest purchase so far."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts", "event_type", "value")
    bought = rows.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("last_purchase"))
    return timeline.last_before(rows.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "ts", ["last_purchase"], timeline.SEGMENT_ROWS).select("event_id", "user_id", "last_purchase")


@query("asof_hot_key", """SELECT l.event_id, r.value AS last_purchase FROM events l ASOF
 LEFT JOIN (SELECT event_type AS t, ts, value FROM events WHERE event_type = 'purchase') r ON r.t = CASE WHEN l.user_id % 10 < 9 THEN 'purchase' END
 AND l.ts >= r.ts""")
def asof_hot_key(spark, sf_dir):
    """One key with nine rows in ten, the others without a key: its rows are cut into stretches of time."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value", F.when(F.col("user_id") % 10 < 9, "purchase").alias("key"))
    bought = rows.where("event_type = 'purchase'").select(F.lit("purchase").alias("key"), "ts", F.col("value").alias("last_purchase"))
    return timeline.last_before(rows.select("event_id", "key", "ts"), bought, ["key"], "ts", "ts", ["last_purchase"], 500).select("event_id", "last_purchase")
