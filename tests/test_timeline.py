from __future__ import annotations

import pytest
from conftest import rows
from matches import GRADED, graded
from pyspark.sql import functions as F

from laneforge.operators import extract, gates, recipes, timeline
from laneforge.sources import archive, publish


@pytest.fixture(scope="module")
def data(spark):
    summaries, lines = graded(spark)
    out = {}
    out["summaries"] = archive.first_archived(archive.summary_envelope(archive.parse_summaries(summaries)))
    out["timelines"] = archive.first_archived(archive.timeline_envelope(lines))
    out["index"] = timeline.match_index(out["summaries"], out["timelines"]).cache()
    out["players"] = extract.summary_participants(out["summaries"]).cache()
    out["raw_events"] = timeline.events(out["timelines"]).cache()
    out["events"] = timeline.events_table(out["index"], out["raw_events"]).cache()
    out["minutes"] = timeline.participant_minutes(out["index"], out["players"], timeline.frames(out["timelines"]), timeline.kill_points(out["raw_events"])).cache()
    picks = timeline.checkpoint_picks(out["minutes"]).cache()
    out["lanes"] = timeline.lane_matchups(out["index"], out["players"], picks).cache()
    out["early"] = timeline.participant_early(out["index"], out["players"], timeline.event_actors(out["raw_events"]), picks).cache()
    out["objectives"] = timeline.match_objectives(out["index"], out["raw_events"], out["players"]).cache()
    return out


def test_ledger(data):
    want = ["ok", "too_short", "aborted", "ok", "no_timeline", "frame_interval_zero", "frames_null", "ok"]
    found = data["index"].orderBy("match_id").collect()
    assert [r.exclusion_reason for r in found] == want
    assert [r.participant_frame_count for r in found] == [300, 40, 0, 160, None, 30, 0, 130]
    assert [r.frame_count for r in found] == [30, 4, 0, 16, None, 3, 3, 13]
    assert found[2].end_of_game_result == "Abort_TooFewPlayers" and found[0].region == "EUW"


def test_row_counts(data):
    by = lambda name: {int(r[0][-3:]): r[1] for r in rows(data[name].groupBy("match_id").count())}
    assert by("minutes") == {201: 300, 204: 160, 208: 130}
    assert by("events") == {201: 22, 204: 2, 208: 1}
    assert by("lanes") == {201: 10, 204: 10, 208: 10}
    assert by("objectives") == {201: 1, 204: 1, 208: 1}


def test_minutes(data):
    of = data["minutes"].where("match_id LIKE '%201' AND participant_id = 1 AND minute IN (1, 5, 10, 15, 30)").orderBy("minute")
    found = of.select("minute", "cs_total", "xp", "total_gold", "current_gold", "level", "position_x", "position_y", "kills_to_minute", "deaths_to_minute", "assists_to_minute")
    assert rows(found) == [
        (1, 8, 300, 500, 100, 1, 1000, 200, 0, 0, 0), (5, 40, 1500, 2500, 500, 2, 1000, 1000, 1, 0, 0), (10, 80, 3000, 5000, 1000, 4, 1000, 2000, 1, 1, 0),
        (15, 120, 4500, 7500, 1500, 6, 1000, 3000, 2, 1, 0), (30, 240, 9000, 15000, 3000, 11, 1000, 6000, 3, 1, 0),
    ]
    assert data["minutes"].where("cs_total <> minions_killed + jungle_minions_killed").isEmpty()
    assert 12 not in {r[0] for r in rows(data["minutes"].where("match_id LIKE '%204'").select("minute").distinct())}


def test_lanes(data):
    r = data["lanes"].where("match_id LIKE '%201' AND participant_id = 1").first()
    assert (r.opponent_participant_id, r.cs_5, r.opponent_cs_5, r.cs_diff_5, r.xp_diff_5, r.gold_diff_5) == (6, 40, 45, -5, -50, -100)
    assert (r.kills_5, r.deaths_10, r.kills_15, r.role, r.is_duo_lane, r.has_nominal_opponent) == (1, 1, 2, "TOP", False, True)
    short = data["lanes"].where("match_id LIKE '%208'")
    assert short.where("cs_15 IS NOT NULL OR cs_diff_15 IS NOT NULL").isEmpty() and short.where("cs_10 IS NULL").isEmpty()


def test_early(data):
    r = data["early"].where("match_id LIKE '%201' AND participant_id = 1").first()
    assert (r.first_blood_involvement, r.first_death_ts_ms, r.first_death_minute, r.first_death_position_x, r.first_death_position_y) == (True, 481000, 8, 6000, 6100)
    assert (r.plates_destroyed, r.plates_at_5, r.plates_at_10, r.plates_at_15) == (3, 1, 3, 3)
    assert (r.first_item_ts_ms, r.first_item_id, r.second_item_ts_ms, r.second_item_id) == (60000, 1055, 420000, 3153)
    assert (r.skill_order, r.duplicate_skill_ups) == ("12", 1)
    jungler = data["early"].where("match_id LIKE '%201' AND participant_id = 2").first()
    assert (jungler.first_blood_involvement, jungler.dragons_participated, jungler.grubs_participated, jungler.heralds_participated, jungler.barons_participated) == (True, 1, 1, 1, 1)
    idle = data["early"].where("match_id LIKE '%208' AND participant_id = 9").first()
    assert idle.skill_order is None and idle.plates_at_15 is None and idle.plates_at_10 == 0 and idle.wards_placed == 0


def test_objectives(data):
    r = data["objectives"].where("match_id LIKE '%201'").first()
    assert (r.first_blood_team, r.first_blood_ts_ms, r.first_tower_team, r.first_dragon_team, r.first_dragon_ts_ms, r.soul_team, r.soul_type) == (100, 181000, 100, 100, 301000, 100, "FIRE_DRAGON")
    assert (r.kills_team_100, r.kills_team_200, r.dragons_team_100, r.dragons_team_200, r.plates_team_100, r.towers_team_100) == (3, 1, 1, 1, 3, 1)


def test_assists_stay_null_where_the_key_is_absent(data):
    found = rows(data["events"].where("match_id LIKE '%201' AND event_type = 'CHAMPION_KILL'").select("event_index", "assisting_participant_ids"), "event_index")
    assert [x[1] for x in found] == [[2], None, None, None]
    marked = rows(data["events"].where("is_duplicate_skill_level_up").select("timestamp_ms"))
    assert marked == [(781000,)]


def test_recipes(data):
    sizes = [
        recipes.cs_at_five(data["lanes"]).count(), recipes.kda_vs_opponent(data["lanes"]).count(), recipes.cs_diff_curve(data["lanes"]).count(), recipes.minute_curves(data["minutes"]).count(),
        recipes.first_objective(data["objectives"], data["early"]).count(), recipes.event_timing(data["events"]).count(), recipes.death_positions(data["events"]).count(), recipes.skill_order_top(data["early"]).count(),
    ]
    assert sizes == [1, 2, 0, 20, 2, len({e for e in data["events"].select("event_type").distinct().collect()}), 7, 1]
    assert recipes.cs_diff_curve(data["lanes"], least=1).count() > 0


def test_gates(data):
    none = timeline.orphan_timelines(data["timelines"], data["summaries"])
    counts = gates.ledger_counts(data["index"], data["summaries"], none)
    whole = gates.reconcile_matchups(data["lanes"], data["index"])
    assert gates.feature_gate(counts, whole).isEmpty()
    fewer = gates.reconcile_matchups(data["lanes"].where("participant_id > 1"), data["index"])
    assert rows(gates.feature_gate(counts, fewer)) == [("lane_rows",)]
    orphans = timeline.orphan_timelines(data["timelines"], data["summaries"].where("match_id NOT LIKE '%201'"))
    assert rows(gates.feature_gate(gates.ledger_counts(data["index"], data["summaries"], orphans), whole)) == [("orphan_timelines",)]
    assert dict(rows(gates.exclusion_counts(data["index"])))["ok"] == 3


def test_written_tables_have_the_specified_columns(spark, data, tmp_path):
    names = {"match_index": "index", "participant_minutes": "minutes", "events": "events", "lane_matchups": "lanes", "participant_early": "early", "match_objectives": "objectives"}
    tables = {name: data[key] for name, key in names.items()}
    with timeline.Features(data["summaries"], data["timelines"]) as made:
        counted = publish.write_features(made.tables(), str(tmp_path))
    assert counted == {name: spark.read.parquet(f"{tmp_path}/{name}").count() for name in tables} == {name: df.count() for name, df in tables.items()}
    with pytest.raises(gates.GateFailed, match="column 2"):
        publish.write_features({"match_index": data["index"].drop("region")}, str(tmp_path))


def test_as_of_join_takes_the_latest_at_or_before(spark):
    left = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (1, 5, "c"), (2, 9, "d"), (None, 3, "e")], "k int, t int, x string")
    right = spark.createDataFrame([(1, 10, 1), (1, 15, 2), (1, 20, 3), (1, 20, 4), (2, 10, 5)], "k int, t int, v int")
    assert sorted(rows(timeline.last_before(left, right, ["k"], "t", "t", ["v"]).select("x", "v"))) == [("a", 1), ("b", 4), ("c", None), ("d", None), ("e", None)]


def test_as_of_join_of_a_hot_key_in_stretches(spark):
    """One key with most rows: cut into stretches that are near equal, and the same rows as in one sort."""
    left = spark.range(6000).select((F.when(F.col("id") % 6 == 0, F.col("id") % 50 + 1).otherwise(0)).alias("k"), (F.crc32(F.col("id").cast("string").cast("binary")) % 9000).alias("t"), F.col("id").alias("x"))
    left = left.unionByName(left.limit(5).withColumn("k", F.lit(None).cast("bigint")))
    right = left.select("k", (F.col("t") + F.col("x") % 3).alias("t"), F.col("x").alias("v")).where("v % 7 = 0 AND t % 500 > 300")
    plain = timeline.last_before(left, right, ["k"], "t", "t", ["v"])
    cut = timeline.last_before(left, right, ["k"], "t", "t", ["v"], 400)
    assert sorted(rows(cut), key=str) == sorted(rows(plain), key=str) and not cut.where("v IS NOT NULL").isEmpty()
    assert cut.where("k IS NULL AND v IS NOT NULL").isEmpty()
    both = left.select("k", F.col("t").alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("struct<v:bigint>").alias("_right"))
    parts, carried = timeline.segmented(both.unionByName(right.select("k", F.col("t").alias("_at"), F.lit(0).alias("_side"), F.struct("v").alias("_right"))), ["k"], 400)
    sizes = {(r.k, r._segment): r["count"] for r in parts.groupBy("k", "_segment").count().collect()}
    assert max(sizes.values()) <= 600 and len([s for k, s in sizes if k == 0]) > 8
    assert all(s == 0 for k, s in sizes if k != 0) and carried.where("k <> 0").isEmpty()


def test_nearest_frame(spark):
    stamps = [250000, 285000, 315000, 400000]
    df = spark.createDataFrame([("m", 1, ts, k, 0, 0, 0, 0, 0, 0) for k, ts in enumerate(stamps)], "match_id string, participant_id int, frame_timestamp_ms long, cs_total int, xp long, total_gold int, level int, kills_to_minute long, deaths_to_minute long, assists_to_minute long")
    assert rows(timeline.checkpoint_picks(df).select("checkpoint", "cs_total")) == [(5, 1)]


def test_the_season_has_all_grades():
    assert len(GRADED) == 8


def test_minute_is_of_the_timestamp(data):
    late = data["minutes"].where("match_id LIKE '%204'").select(F.max("minute")).first()[0]
    assert late == 17
