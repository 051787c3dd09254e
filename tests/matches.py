"""Small archives of matches, written out so that every expected number can be checked by hand."""

from __future__ import annotations

import datetime as dt
import json

ROLES = ("TOP", "JUNGLE", "MIDDLE", "BOTTOM", "UTILITY")
BLUE, RED = (24, 64, 134, 202, 111), (86, 121, 1, 145, 412)
PLAYERS = [f"player-{k:02d}" for k in range(1, 11)]


def style(description, number, *perks):
    return {"description": description, "style": number, "selections": [{"perk": p} for p in perks]}


PAGE = [style("primaryStyle", 8000, 8005, 9111), style("subStyle", 8100, 8139), style("statMods", 5000, 5008, 5008, 5002)]


def summary(number, created, patch="16.18", platform="EUW1", queue=420, winner=100, top=None, bans=((), ()), bare_items=(), no_spell=(), bad_runes=(), fallback=(), duration=1830, result="GameComplete"):
    """A match; ``top`` replaces the top laners of the teams it names; seats are (team, role)."""
    millis = int(dt.datetime.fromisoformat(created).timestamp() * 1000)
    people = []
    for team, names in ((100, BLUE), (200, RED)):
        for k, champion in enumerate(names):
            seat = (team, k)
            champion = (top or {}).get(team, champion) if k == 0 else champion
            items = [0] * 7 if seat in bare_items else [3000 + champion, 3001, 3002, 3003, 3004, 0, 3340]
            people.append({
                "participantId": len(people) + 1, "puuid": PLAYERS[len(people)], "championId": champion, "teamId": team, "teamPosition": "" if seat in fallback else ROLES[k],
                "individualPosition": ROLES[k], "win": team == winner, **{f"item{i}": x for i, x in enumerate(items)}, "summoner1Id": 4, "summoner2Id": 0 if seat in no_spell else 12,
                "perks": {"styles": PAGE[::-1] if seat in bad_runes else PAGE},
            })
    info = {
        "gameVersion": f"{patch}.700.1", "platformId": platform, "queueId": queue, "gameCreation": millis, "gameDuration": duration, "endOfGameResult": result,
        "teams": [{"teamId": t, "bans": [{"championId": c} for c in b]} for t, b in zip((100, 200), bans)], "participants": people,
    }
    return json.dumps({"metadata": {"matchId": f"EUW1_{number:010d}", "participants": PLAYERS}, "info": info})


def season():
    """(partition, payload) of fourteen matches: nine counted, one for each way to be left out."""
    first, second = "2026-09-10", "2026-09-14"
    return [
        (first, summary(1, "2026-09-09T18:05:00+00:00", bans=((11,), (2,)))),
        (first, summary(2, "2026-09-09T19:20:00+00:00", bans=((3, 0), (5, 0)))),
        (first, summary(3, "2026-09-10T17:45:00+00:00", bans=((2, 3), (4, 5)))),
        (first, summary(4, "2026-09-10T20:10:00+00:00", top={100: 11}, bans=((24,), (3,)), bare_items=[(100, 3)])),
        (first, summary(5, "2026-09-10T21:30:00+00:00", bans=((2,), (5,)), bad_runes=[(100, 0)])),
        (second, summary(6, "2026-09-13T18:00:00+00:00", winner=200, top={100: 13}, bans=((24, 2), (3,)))),
        (second, summary(7, "2026-09-13T19:15:00+00:00", winner=200, top={100: 13}, bans=((24,), ()), no_spell=[(200, 1)])),
        (second, summary(8, "2026-09-13T20:40:00+00:00", winner=200, top={200: 12}, bans=((86,), (2,)), fallback=[(200, k) for k in range(5)])),
        (second, summary(9, "2026-09-13T21:05:00+00:00", patch="16.17", top={100: 99}, bans=((2,), (3,)))),
        (second, summary(10, "2026-08-30T18:30:00+00:00", bans=((2,), (3,)))),
        (second, summary(11, "2026-09-12T18:00:00+00:00", platform="NA1", top={100: 97}, bans=((2,), (3,)))),
        (second, summary(12, "2026-09-12T18:30:00+00:00", queue=440, top={100: 96}, bans=((2,), (3,)))),
        (second, summary(13, "2026-09-14T23:59:00+00:00", winner=200, bans=((12,), (6,)))),
        ("2026-09-15", summary(14, "2026-09-15T00:01:00+00:00", top={100: 98}, bans=((2,), (3,)))),
    ]


def archive(spark, rows, extra=()):
    """An archive frame of (partition, payload), placed in the order given."""
    listed = [(f"dt={day}/part-00000", k, p, dt.date.fromisoformat(day), "EUW") for k, (day, p) in enumerate([*rows, *extra])]
    return spark.createDataFrame(listed, "part string, part_row long, payload string, dt date, region string")


# ---- timelines ---------------------------------------------------------------------------


def kill(ts, killer, victim, assists=None, x=0, y=0):
    return {"timestamp": ts, "type": "CHAMPION_KILL", "killerId": killer, "victimId": victim, "position": {"x": x, "y": y}} | ({} if assists is None else {"assistingParticipantIds": assists})


def plate(ts, team, killer):
    return {"timestamp": ts, "type": "TURRET_PLATE_DESTROYED", "teamId": team, "killerId": killer, "laneType": "TOP_LANE"}


def elite(ts, kind, sub, team, killer):
    return {"timestamp": ts, "type": "ELITE_MONSTER_KILL", "monsterType": kind, "teamId": team, "killerId": killer} | ({"monsterSubType": sub} if sub else {})


def skill(ts, who, slot, level):
    return {"timestamp": ts, "type": "SKILL_LEVEL_UP", "participantId": who, "skillSlot": slot, "level": level}


def item(ts, who, number):
    return {"timestamp": ts, "type": "ITEM_PURCHASED", "participantId": who, "itemId": number}


LONG = [
    skill(60000, 1, 1, 2), item(60000, 1, 1055), kill(181000, 1, 6, [2], 5000, 5000), {"timestamp": 181000, "type": "CHAMPION_SPECIAL_KILL", "killerId": 1, "killType": "KILL_FIRST_BLOOD"},
    plate(245000, 100, 1), elite(301000, "DRAGON", "FIRE_DRAGON", 100, 2), plate(305000, 100, 1), elite(361000, "HORDE", "", 100, 2), plate(365000, 100, 1), item(420000, 1, 3153),
    kill(481000, 6, 1, None, 6000, 6100), {"timestamp": 541000, "type": "BUILDING_KILL", "buildingType": "TOWER", "towerType": "OUTER", "laneType": "TOP", "teamId": 100, "killerId": 1, "position": {"x": 3000, "y": 3000}},
    {"timestamp": 601000, "type": "WARD_PLACED", "creatorId": 3, "wardType": "YELLOW_TRINKET"}, elite(661000, "DRAGON", "WATER_DRAGON", 200, 7), kill(721000, 1, 7),
    {"timestamp": 725000, "type": "WARD_KILL", "killerId": 3, "wardType": "YELLOW_TRINKET"}, skill(781000, 1, 1, 2), skill(785000, 1, 2, 3), kill(961000, 1, 6),
    elite(1021000, "BARON_NASHOR", "", 100, 2), elite(1081000, "RIFTHERALD", "", 100, 2), {"timestamp": 1201000, "type": "DRAGON_SOUL_GIVEN", "teamId": 100, "soulType": "FIRE_DRAGON"},
]


def timeline(number, interval, stamps, events=(), players=True):
    frames, before = [], 0
    for ts in stamps:
        m, people = ts // 60000, {}
        for s in range(10):
            jungle = s % 5 == 1
            people[str(s + 1)] = {
                "level": 1 + m // 3, "xp": 300 * m + 10 * s, "currentGold": 100 * m + 5 * s, "totalGold": 500 * m + 20 * s, "minionsKilled": 0 if jungle else 8 * m + s,
                "jungleMinionsKilled": 7 * m + s if jungle else 0, "position": {"x": 1000 + 100 * s, "y": 200 * m},
            }
        frames.append({"timestamp": ts, "participantFrames": people if players else None, "events": [e for e in events if before < e["timestamp"] <= ts]})
        before = ts
    return json.dumps({"metadata": {"matchId": f"EUW1_{number:010d}"}, "info": {"frameInterval": interval, "frames": frames}})


CREATED = "2026-01-20T18:00:00+00:00"
MINUTES = lambda n: range(60000, 60000 * n + 1, 60000)
#: Summary options and timeline of one match for each way to be graded.
GRADED = {
    201: ({"patch": "16.03"}, timeline(201, 60000, MINUTES(30), LONG)),
    202: ({"patch": "16.03", "duration": 240}, timeline(202, 60000, MINUTES(4), [kill(60000, 6, 1), kill(180000, 1, 6)])),
    203: ({"patch": "16.04", "duration": 90, "winner": 0, "result": "Abort_TooFewPlayers"}, timeline(203, 0, [])),
    204: ({"patch": "16.05", "duration": 1080, "winner": 200}, timeline(204, 60000, range(65000, 65000 * 16 + 1, 65000), [kill(305000, 1, 6), kill(610000, 6, 1)])),
    205: ({"patch": "16.05"}, None),
    206: ({"patch": "16.06"}, timeline(206, 0, MINUTES(3), [kill(60000, 1, 6)])),
    207: ({"patch": "16.06"}, timeline(207, 60000, MINUTES(3), players=False)),
    208: ({"patch": "16.07", "duration": 780}, timeline(208, 60000, MINUTES(13), [kill(66000, 1, 6)])),
}


def graded(spark):
    """Archive frames of summaries and of timelines."""
    day = dt.date(2026, 1, 21)
    millis = int(dt.datetime.fromisoformat(CREATED).timestamp() * 1000)
    summaries = archive(spark, [("2026-01-21", summary(n, CREATED, **options)) for n, (options, _) in GRADED.items()])
    lines = [(f"EUW1_{n:010d}", "EUW", 420, o["patch"], f"{o['patch']}.700.1", millis, o.get("duration", 1830), line, day, "dt=2026-01-21/part-00000", k) for k, (n, (o, line)) in enumerate(GRADED.items()) if line]
    schema = "match_id string, region string, queue_id int, patch string, game_version string, game_creation_ms long, game_duration_s int, payload string, dt date, part string, part_row long"
    return summaries, spark.createDataFrame(lines, schema)
