"""Schemas of the archive, of the JSON payloads, and of the published tables.

Numbers inside payloads are declared as strings and cast with ``try_cast`` where they are read, so
``"7"`` and ``7.0`` are both 7 and a bad value makes one null, not a failed parse.
"""

from __future__ import annotations

import re

ARCHIVE = (
    "match_id STRING, region STRING, queue_id INT, patch STRING, game_version STRING, game_creation_ms BIGINT, "
    "game_duration_s INT, payload_version STRING, fetched_at TIMESTAMP, payload STRING, payload_sha256 STRING"
)

SUMMARY = (
    "metadata: STRUCT<matchId: STRING, participants: ARRAY<STRING>>, "
    "info: STRUCT<gameVersion: STRING, platformId: STRING, queueId: STRING, gameCreation: STRING, gameDuration: STRING, "
    "endOfGameResult: STRING, teams: ARRAY<STRUCT<bans: ARRAY<STRUCT<championId: STRING>>>>, "
    "participants: ARRAY<STRUCT<participantId: STRING, puuid: STRING, championId: STRING, teamId: STRING, teamPosition: STRING, "
    "individualPosition: STRING, win: STRING, item0: STRING, item1: STRING, item2: STRING, item3: STRING, item4: STRING, "
    "item5: STRING, item6: STRING, summoner1Id: STRING, summoner2Id: STRING, perks: STRUCT<styles: ARRAY<STRUCT<description: STRING, "
    "style: STRING, selections: ARRAY<STRUCT<perk: STRING>>>>, statPerks: STRUCT<offense: STRING, flex: STRING, defense: STRING>>>>>"
)



def columns_of(schema: str) -> list[tuple[str, str]]:
    """Names and types of a schema of plain columns."""
    return [tuple(c.split()) for c in schema.split(", ")]


#: What a column's type may have been widened to, by the family that it belongs to; a reader takes the widest.
WIDER = {"TINYINT": "BIGINT", "SMALLINT": "BIGINT", "INT": "BIGINT", "FLOAT": "DOUBLE"}


def widest(schema: str) -> str:
    """A schema that reads parts written before and after a column was widened."""
    return ", ".join(f"{c} {WIDER.get(kind, kind)}" for c, kind in columns_of(schema))


#: What cells are made of, for readers of nothing else.
PLAYED = (
    "metadata: STRUCT<matchId: STRING>, info: STRUCT<gameVersion: STRING, platformId: STRING, queueId: STRING, gameCreation: STRING, "
    "teams: ARRAY<STRUCT<bans: ARRAY<STRUCT<championId: STRING>>>>, "
    "participants: ARRAY<STRUCT<championId: STRING, teamPosition: STRING, individualPosition: STRING, win: STRING>>>"
)

#: The same with the players' teams, for matchups.
PAIRED = PLAYED.replace("STRUCT<championId", "STRUCT<teamId: STRING, championId").replace("bans: ARRAY<STRUCT<teamId: STRING, championId", "bans: ARRAY<STRUCT<championId")

#: What the feature dataset reads of a summary: its envelope and who sat where.
SEATED = (
    "metadata: STRUCT<matchId: STRING>, info: STRUCT<gameVersion: STRING, platformId: STRING, queueId: STRING, gameCreation: STRING, gameDuration: STRING, endOfGameResult: STRING, "
    "participants: ARRAY<STRUCT<participantId: STRING, championId: STRING, teamId: STRING, teamPosition: STRING, individualPosition: STRING, win: STRING>>>"
)

#: The envelope and what players are called.
NAMED = (
    "metadata: STRUCT<matchId: STRING, participants: ARRAY<STRING>>, "
    "info: STRUCT<gameVersion: STRING, platformId: STRING, queueId: STRING, gameCreation: STRING, participants: ARRAY<STRUCT<puuid: STRING>>>"
)

FRAME = (
    "STRUCT<level: STRING, xp: STRING, totalGold: STRING, currentGold: STRING, minionsKilled: STRING, "
    "jungleMinionsKilled: STRING, position: STRUCT<x: STRING, y: STRING>>"
)
EVENT = (
    "STRUCT<timestamp: STRING, type: STRING, participantId: STRING, killerId: STRING, creatorId: STRING, victimId: STRING, "
    "assistingParticipantIds: ARRAY<INT>, teamId: STRING, position: STRUCT<x: STRING, y: STRING>, laneType: STRING, monsterType: STRING, "
    "monsterSubType: STRING, soulType: STRING, buildingType: STRING, towerType: STRING, wardType: STRING, itemId: STRING, "
    "beforeId: STRING, afterId: STRING, skillSlot: STRING, level: STRING, killType: STRING, multiKillLength: STRING, "
    "transformType: STRING, killStreakLength: STRING, bounty: STRING, shutdownBounty: STRING, winningTeam: STRING>"
)
TIMELINE = f"info: STRUCT<frameInterval: STRING, frames: ARRAY<STRUCT<timestamp: STRING, participantFrames: MAP<STRING, {FRAME}>, events: ARRAY<{EVENT}>>>>"

#: The same without players' frames but how many there are, for events; and without events too, for the ledger.
TIMELINE_EVENTS = TIMELINE.replace(FRAME, "STRUCT<level: STRING>")
TIMELINE_LEDGER = TIMELINE_EVENTS.replace(f", events: ARRAY<{EVENT}>", "")
#: What the ledger reads of a summary.
SEATS = re.sub(r"participants: ARRAY<.*>>", "participants: ARRAY<STRUCT<participantId: STRING>>>", SEATED)

#: Fields of the feature dataset's payloads that are read by ``try_cast`` alone.
CAST_ALONE = {"win": "BOOLEAN"} | dict.fromkeys((
    "queueId gameCreation gameDuration participantId championId teamId frameInterval timestamp level xp totalGold currentGold minionsKilled jungleMinionsKilled x y "
    "killerId creatorId victimId itemId beforeId afterId skillSlot multiKillLength killStreakLength bounty shutdownBounty winningTeam"
).split(), "BIGINT")


def typed(schema: str) -> str:
    """A schema of the feature dataset with the types that its strings are cast to, before they are narrowed."""
    return re.sub(r"(\w+): STRING", lambda m: f"{m[1]}: {CAST_ALONE.get(m[1], 'STRING')}", schema)


#: Payloads' schemas that have a typed form.
TYPED = {s: typed(s) for s in (SEATED, SEATS, TIMELINE, TIMELINE_EVENTS, TIMELINE_LEDGER)}

LADDER_PAGE = "region STRING, queue STRING, tier STRING, division STRING, page INT, fetched_at TIMESTAMP, payload STRING, payload_sha256 STRING"
STATIC_DOCUMENT = "kind STRING, version STRING, locale STRING, fetched_at TIMESTAMP, payload STRING, payload_sha256 STRING"
ACCOUNT = "puuid STRING, game_name STRING, tag_line STRING, fetched_at TIMESTAMP, payload STRING, payload_sha256 STRING"

# Roles in their published order.
ROLES = ("TOP", "JUNGLE", "MID", "BOTTOM", "SUPPORT")
# Regions and the platforms that they are played on.
PLATFORMS = {
    "EUW": "EUW1", "EUNE": "EUN1", "NA": "NA1", "BR": "BR1", "LAN": "LA1", "LAS": "LA2", "OCE": "OC1", "JP": "JP1", "TR": "TR1", "RU": "RU", "KR": "KR",
}

CHECKPOINTS = (5, 10, 15)


def _columns(text: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in text.split(",")]


MATCH_INDEX = _columns(
    "match_id string,region string,platform_id string,patch string,queue_id int,game_version string,game_creation timestamp_ntz,"
    "game_duration_s int,end_of_game_result string,frame_interval_ms int,frame_count int,participant_frame_count bigint,"
    "timeline_present boolean,exclusion_reason string,timeline_eligible boolean"
)
PARTICIPANT_MINUTES = _columns(
    "match_id string,participant_id int,champion_id int,role string,team_id int,win boolean,frame_timestamp_ms bigint,minute int,"
    "level int,xp bigint,total_gold int,current_gold int,minions_killed int,jungle_minions_killed int,cs_total int,position_x int,"
    "position_y int,kills_to_minute bigint,deaths_to_minute bigint,assists_to_minute bigint,patch string,region string,queue_id int"
)
EVENTS = _columns(
    "match_id string,region string,patch string,queue_id int,event_index int,timestamp_ms bigint,minute int,event_type string,"
    "actor_participant_id int,target_participant_id int,assisting_participant_ids array<int>,team_id int,position_x int,position_y int,"
    "lane_type string,monster_type string,monster_subtype string,building_type string,tower_type string,ward_type string,item_id int,"
    "before_item_id int,after_item_id int,skill_slot int,level int,kill_type string,multi_kill_length int,transform_type string,"
    "kill_streak_length int,bounty int,shutdown_bounty int,winning_team int,is_duplicate_skill_level_up boolean"
)
LANE_MATCHUPS = _columns(
    "match_id string,region string,patch string,queue_id int,participant_id int,opponent_participant_id int,role string,champion_id int,"
    "opponent_champion_id int,team_id int,win boolean,pairing_basis string,is_duo_lane boolean,has_nominal_opponent boolean"
) + [
    (f"{name}_{c}", kind)
    for c in CHECKPOINTS
    for name, kind in (("cs", "int"), ("opponent_cs", "int"), ("cs_diff", "int"), ("xp_diff", "bigint"), ("gold_diff", "int"), ("level_diff", "int"), ("kills", "bigint"), ("deaths", "bigint"), ("assists", "bigint"))
]
PARTICIPANT_EARLY = _columns(
    "match_id string,region string,patch string,queue_id int,participant_id int,champion_id int,role string,team_id int,win boolean,"
    "first_blood_involvement boolean,first_death_ts_ms bigint,first_death_minute int,first_death_position_x int,first_death_position_y int,"
    "plates_destroyed bigint,plates_at_5 bigint,plates_at_10 bigint,plates_at_15 bigint,first_item_ts_ms bigint,first_item_id int,"
    "second_item_ts_ms bigint,second_item_id int,skill_order string,duplicate_skill_ups bigint,wards_placed bigint,wards_killed bigint,"
    "dragons_participated bigint,grubs_participated bigint,heralds_participated bigint,barons_participated bigint,atakhan_participated bigint"
)
# What the objectives table counts for each team.
OBJECTIVES = {
    "kills": "event_type = 'CHAMPION_KILL'",
    "dragons": "event_type = 'ELITE_MONSTER_KILL' AND monster_type = 'DRAGON'",
    "grubs": "event_type = 'ELITE_MONSTER_KILL' AND monster_type = 'HORDE'",
    "heralds": "event_type = 'ELITE_MONSTER_KILL' AND monster_type = 'RIFTHERALD'",
    "barons": "event_type = 'ELITE_MONSTER_KILL' AND monster_type = 'BARON_NASHOR'",
    "atakhan": "event_type = 'ELITE_MONSTER_KILL' AND monster_type = 'ATAKHAN'",
    "souls": "event_type = 'DRAGON_SOUL_GIVEN'",
    "towers": "event_type = 'BUILDING_KILL' AND tower_type IS NOT NULL",
    "plates": "event_type = 'TURRET_PLATE_DESTROYED'",
}
MATCH_OBJECTIVES = _columns(
    "match_id string,region string,patch string,queue_id int,game_duration_s int,first_blood_team int,first_blood_ts_ms bigint,"
    "first_tower_team int,first_tower_ts_ms bigint,first_dragon_team int,first_dragon_ts_ms bigint,soul_team int,soul_type string"
) + [(f"{name}_team_{team}", "bigint") for name in OBJECTIVES for team in (100, 200)]

TABLES = {
    "match_index": MATCH_INDEX,
    "participant_minutes": PARTICIPANT_MINUTES,
    "events": EVENTS,
    "lane_matchups": LANE_MATCHUPS,
    "participant_early": PARTICIPANT_EARLY,
    "match_objectives": MATCH_OBJECTIVES,
}
