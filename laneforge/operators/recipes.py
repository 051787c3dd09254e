"""Ready-made queries over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def win_rate():
    return F.avg(F.col("win").cast("int")).alias("win_rate")


def solo(lanes: DataFrame) -> DataFrame:
    """Rows with one opponent in the lane."""
    return lanes.where("NOT is_duo_lane AND has_nominal_opponent")


def cs_at_five(lanes: DataFrame) -> DataFrame:
    rows = solo(lanes).where("cs_diff_5 IS NOT NULL")
    return rows.groupBy((F.col("cs_diff_5") <= -10).alias("lost_lane")).agg(F.count("*").alias("n"), win_rate())


def opponents(lanes: DataFrame) -> DataFrame:
    """Each solo laner beside the opponent's kills, deaths and assists, as ``o_`` columns."""
    names = [f"{x}_{c}" for c in (5, 10, 15) for x in ("kills", "deaths", "assists")]
    other = lanes.select("match_id", F.col("participant_id").alias("opponent_participant_id"), *(F.col(n).alias(f"o_{n}") for n in names))
    return solo(lanes).join(other, ["match_id", "opponent_participant_id"])


def kda_vs_opponent(lanes: DataFrame) -> DataFrame:
    kda = lambda c, side="": (F.col(f"{side}kills_{c}") + F.col(f"{side}assists_{c}")) / F.greatest(F.col(f"{side}deaths_{c}"), F.lit(1))
    rows = opponents(lanes)
    # greatest() passes over nulls, so a checkpoint that was not reached must stay null
    diff = lambda c: F.when(F.col(f"deaths_{c}").isNotNull() & F.col(f"o_deaths_{c}").isNotNull(), kda(c) - kda(c, "o_"))
    return rows.groupBy("role").agg(F.count("*").alias("n"), *(F.avg(diff(c)).alias(f"avg_kda_diff_{c}") for c in (5, 10, 15)), win_rate())


def cs_diff_curve(lanes: DataFrame, least: int = 30) -> DataFrame:
    rows = lanes.where("role = 'MID' AND cs_diff_10 IS NOT NULL")
    bucket = (F.floor(F.col("cs_diff_10") / F.lit(10.0)) * 10).cast("double")
    return rows.groupBy(bucket.alias("cs_diff_bucket")).agg(F.count("*").alias("n"), win_rate()).where(F.col("n") >= least)


def minute_curves(minutes: DataFrame) -> DataFrame:
    jungle = F.when(F.col("role") == "JUNGLE", F.col("jungle_minions_killed"))
    return minutes.where("minute <= 20").groupBy("minute").agg(F.avg("cs_total").alias("avg_cs"), F.avg(jungle).alias("avg_jungle_cs"), F.avg("total_gold").alias("avg_gold"))


def first_objective(objectives: DataFrame, early: DataFrame) -> DataFrame:
    taken = objectives.where("first_dragon_team IS NOT NULL").select("match_id", "first_dragon_team")
    rows = early.select("match_id", "team_id", "win").join(taken, "match_id")
    return rows.groupBy((F.col("first_dragon_team") == F.col("team_id")).alias("took_first_dragon")).agg(F.count_distinct("match_id").alias("games"), F.count("*").alias("participant_sides"), win_rate())


def event_timing(events: DataFrame) -> DataFrame:
    median = (F.percentile("timestamp_ms", 0.5) / 60000).alias("median_minute")
    return events.groupBy("event_type").agg(F.count("*").alias("n"), median, F.count_if("is_duplicate_skill_level_up").alias("duplicates"))


def death_positions(events: DataFrame) -> DataFrame:
    rows = events.where("event_type = 'CHAMPION_KILL' AND target_participant_id > 0")
    return rows.groupBy("minute", "position_x", "position_y").agg(F.count("*").alias("deaths"))


def skill_order_top(early: DataFrame, limit: int = 20) -> DataFrame:
    """The commonest skill orders in TOP; orders as common stand by their text."""
    rows = early.where("skill_order IS NOT NULL AND role = 'TOP'").groupBy("role", "skill_order").agg(F.count("*").alias("n"))
    return rows.orderBy(F.col("n").desc(), "skill_order").limit(limit)


def cs_buckets(lanes: DataFrame) -> DataFrame:
    rows = solo(lanes).where("cs_diff_5 IS NOT NULL")
    bucket = (F.floor(F.col("cs_diff_5") / F.lit(10.0)) * 10).cast("int")
    return rows.groupBy(bucket.alias("cs_diff_bucket")).agg(F.count("*").alias("n"), win_rate())
