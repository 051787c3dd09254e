from __future__ import annotations

import os

import pytest
from conftest import SF, rows
from matches import archive as frame
from matches import season
from pyspark.sql import functions as F

from laneforge.operators import extract, gates, policy, tallies
from laneforge.sources import archive

SCOPE = lambda: extract.in_scope("EUW", 420, "2026-09-14", 14)


class Season:
    def __init__(self, raw, patch="16.18"):
        self.envelopes = archive.first_archived(archive.envelope(archive.parse_summaries(raw)))
        self.filters = extract.match_filter(SCOPE())
        window = self.envelopes.where(self.filters)
        self.participants, self.bans = extract.participants(window), extract.bans(window)
        self.tallies = tallies.cell_counts(self.participants, patch)
        self.matches = self.envelopes.where(extract.match_filter(SCOPE(), patch)).agg(F.count_distinct("match_id").alias("matches_used"))
        self.stats = tallies.window_stats(self.envelopes, self.participants, self.bans, self.filters, patch)
        self.cells = policy.cells(self.tallies, tallies.ban_counts(self.bans, patch), self.matches)


EXPECTED = {
    ("TOP", 24): (6, 4, 0.6667, 0.3333, 0.3333, "S+", 0.4001), ("TOP", 86): (8, 3, 0.375, 0.4444, 0.1111, "D", 0.3465), ("TOP", 13): (2, 0, 0.0, 0.1111, 0.0, "D", 0.693),
    **{(r, c): (9, 5, 0.5556, 0.5, 0.0, "S+", 0.3267) for r, c in (("JUNGLE", 64), ("MID", 134), ("BOTTOM", 202), ("SUPPORT", 111))},
    **{(r, c): (9, 4, 0.4444, 0.5, 0.0, "D", 0.3267) for r, c in (("JUNGLE", 121), ("MID", 1), ("BOTTOM", 145), ("SUPPORT", 412))},
}


def published(s, floor=2):
    return {(r.role, r.champion_id): (r.n, r.wins, r.win_rate, r.pick_rate, r.ban_rate, r.tier, r.ci95) for r in policy.published(s.cells, floor).collect()}


def test_published_cells(spark):
    s = Season(frame(spark, season()))
    assert published(s) == EXPECTED
    assert s.stats.first()[:3] == (9, 90, 0)
    assert tallies.archive_stats(s.envelopes).first()[:] == (14, 0)
    assert policy.suppression(s.tallies, 2).first()[:] == (13, 11, 2, 90, 88)
    assert tallies.baseline(s.tallies).first()[0] == 0.5


def test_one_pass_gives_the_same_cells(spark):
    s = Season(frame(spark, season()))
    for patch in ("16.18", "16.17", None):
        apart = policy.cells(tallies.cell_counts(s.participants, patch), tallies.ban_counts(s.bans, patch), s.envelopes.where(extract.match_filter(SCOPE(), patch)).agg(F.count_distinct("match_id").alias("matches_used")))
        once = policy.cells_of_facts(tallies.tier_facts(s.envelopes.where(s.filters), patch))
        assert sorted(rows(once)) == sorted(rows(apart)) and once.count() > 0


def test_copies_change_nothing(spark):
    from matches import summary

    again = [("2026-09-14", summary(1, "2026-09-09T18:05:00+00:00", bans=((11,), (2,)))), ("2026-09-15", summary(1, "2026-09-09T18:05:00+00:00", winner=200))]
    assert published(Season(frame(spark, season(), again))) == EXPECTED


def test_order_and_gates(spark):
    s = Season(frame(spark, season()))
    ranked = policy.ranked(policy.published(s.cells, 2))
    assert [r.champion_id for r in ranked.collect()][:3] == [24, 86, 13]
    assert gates.verify_order(ranked).isEmpty() and gates.verify_cells(policy.published(s.cells, 2), 2).isEmpty()
    assert gates.input_gate(tallies.archive_stats(s.envelopes), s.stats).isEmpty()
    assert gates.output_gate(policy.suppression(s.tallies, 2), s.stats).isEmpty()
    assert rows(gates.output_gate(policy.suppression(s.tallies, 100), s.stats)) == [("no_published_cells",)]
    assert rows(gates.output_gate(policy.suppression(s.tallies, 2), s.stats, gates.GateConfig(min_confident_share=0.9))) == [("suppression_majority",)]
    damaged = ranked.withColumn("win_rate", F.lit(0.9))
    assert gates.verify_cells(damaged, 2).where("problem = 'win_rate'").count() == 11
    with pytest.raises(gates.GateFailed):
        gates.require(gates.verify_cells(damaged, 2))


@pytest.mark.parametrize("payload", ["{}", "{broken", '{"a": 1} tail', None])
def test_a_damaged_row_is_counted(spark, payload):
    s = Season(frame(spark, season(), [("2026-09-10", payload)]))
    stats = tallies.archive_stats(s.envelopes)
    assert stats.first()[:] == (15, 1)
    assert rows(gates.input_gate(stats, s.stats)) == [("malformed_archive",)]


def test_builds(spark):
    s = Season(frame(spark, season()))
    count = lambda kind, champion: sum(r.n for r in tallies.build_counts(s.participants, kind, "16.18").where(F.col("champion_id") == champion).collect())
    assert (count("items", 202), count("runes", 24), count("spells", 121), count("items", 64)) == (8, 5, 8, 9)
    top = policy.top_builds(tallies.build_counts(s.participants, "runes", "16.18")).where("champion_id = 24").first()
    assert top.label == "8000-8005-8100-5008-5008-5002"
    builds = top_of_each(s)
    docs = {r.champion_id: r.roles for r in policy.champion_documents(policy.published(s.cells, 2), s.tallies, builds).collect()}
    assert docs[11] == [] and docs[12] == [] and len(docs) == 13
    assert docs[24][0].items[0].n == 6 and docs[24][0].role == "TOP"
    assert gates.verify_builds(builds, s.cells).isEmpty()


def top_of_each(s):
    out = [policy.top_builds(tallies.build_counts(s.participants, k, "16.18")).withColumn("kind", F.lit(k)) for k in ("items", "runes", "spells")]
    return out[0].unionByName(out[1]).unionByName(out[2])


def test_matchups(spark):
    s = Season(frame(spark, season()))
    counts = tallies.matchup_counts(s.participants, "16.18")
    found = {(r.role, r.champion_id, r.opponent_id): (r.n, r.wins) for r in counts.collect()}
    assert found[("TOP", 24, 86)] == (5, 4) and found[("JUNGLE", 64, 121)] == (9, 5) and found[("MID", 1, 134)] == (9, 4)
    assert sum(n for n, _ in found.values()) == 45
    axis = policy.matchup_axis(counts)
    assert dict(rows(axis))["TOP"] == [11, 12, 13, 24, 86]
    assert gates.verify_matchups(policy.published(policy.matchup_cells(counts), 2), axis, 2).isEmpty()


def test_patches(spark):
    s = Season(frame(spark, season()))
    a, b = tallies.patch_list(s.participants), tallies.envelope_patch_list(s.envelopes, s.filters)
    assert sorted(rows(a)) == [("16.17", 1, 10), ("16.18", 9, 90)]
    assert policy.patch_evidence_diff(a, b).isEmpty()
    assert policy.patch_evidence_diff(a, b.where("patch <> '16.17'")).count() == 1
    assert policy.choose_patch(a) == "16.18" and policy.choose_patch(a, "16.17") == "16.17"
    with pytest.raises(ValueError):
        policy.choose_patch(a, "16.1")
    lists = spark.createDataFrame([("16.9",), ("16.10",), ("15.24",)], "patch string")
    assert policy.newest_patch(lists).first()[0] == "16.10"
    with pytest.raises(Exception, match="not a patch"):
        policy.newest_patch(lists.unionByName(spark.createDataFrame([("x.1",)], "patch string"))).collect()


def test_ties_and_thresholds(spark):
    from laneforge.functions.columns import ci95, normal_role, patch_of, platforms_of, tier_of

    df = spark.createDataFrame([(0.52,), (0.5199,), (0.4941,), (0.4939,), (0.4849,)], "r double")
    assert [x[0] for x in df.select(tier_of(F.col("r"), F.lit(0.5))).collect()] == ["S+", "S", "B", "C", "D"]
    one = spark.range(1)
    assert one.select(ci95(F.lit(6))).first()[0] == 0.4001
    assert one.select(patch_of(F.lit("16")), patch_of(F.lit("16.4.1")), patch_of(F.lit(None).cast("string"))).first()[:] == (None, "16.4", None)
    roles = [("", "MID"), ("ADC", "TOP"), ("", "Invalid"), (None, "UTILITY")]
    assert [x[0] for x in spark.createDataFrame(roles, "a string, b string").select(normal_role(F.col("a"), F.col("b"))).collect()] == ["MID", "BOTTOM", None, "SUPPORT"]
    assert platforms_of(" euw ") == ["EUW", "EUW1"] and platforms_of("", "kr") == ["KR"]


def test_the_window_prunes_the_scan_and_the_store(spark, tmp_path):
    """Days before the window are neither listed nor read, and documents out of scope are not stored."""
    from laneforge.plans import match_queries
    from laneforge.sources import schemas

    with match_queries.Build(spark, SF, schema=schemas.PLAYED) as build:
        plan = build.raw._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dt" in plan and match_queries.FIRST > "2026-09-02"
        assert all(f.rsplit("dt=", 1)[1][:10] >= match_queries.FIRST for f in build.raw.inputFiles())
        kept = build.envelopes
        assert "puuid" not in kept.schema.simpleString() and "item0" not in kept.schema.simpleString()
        assert kept.where(~extract.match_filter(build.scope)).where("doc IS NOT NULL").isEmpty()
        assert not kept.where("doc IS NULL").isEmpty() and not kept.where("doc IS NOT NULL").isEmpty()
        stored = [f.removeprefix("file:") for f in kept.inputFiles()]
    assert stored and not any(os.path.exists(f) for f in stored)


def test_an_empty_window_is_an_error(spark, monkeypatch):
    from laneforge.plans import match_queries
    from laneforge.sources import archive

    monkeypatch.setattr(match_queries, "FIRST", "2030-01-01")
    with pytest.raises(archive.ArchiveEmpty):
        match_queries.tier_list(spark, SF)


def test_players_without_a_match_meet_nobody(spark):
    rows = [(None, "TOP", 100, 1, True), (None, "TOP", 200, 2, False), ("a", "TOP", 100, 3, True), ("a", "TOP", 200, 4, False), ("a", None, 100, 5, True), ("a", None, 200, 6, False)]
    sides = spark.createDataFrame(rows, "match_id string, role string, team_id int, champion_id int, win boolean")
    pairs = extract.paired(sides, ["match_id", "role"]).collect()
    assert sorted((r.a.champion_id, r.b.champion_id) for r in pairs) == [(3, 4), (4, 3)]
