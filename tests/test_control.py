from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from laneforge.operators import control, gates

T = lambda h: dt.datetime(2026, 9, 1, h)
QUEUE = "id long, match_id string, kind string, priority int, attempts int, revivals int, not_before timestamp, claimed_at timestamp, status string, last_cause string"


@pytest.fixture
def queue(spark):
    return spark.createDataFrame([
        (1, "a", "timeline", 100, 1, 0, T(1), None, "pending", None), (2, "b", "timeline", 50, 5, 2, T(1), T(2), "dead", "x"), (3, "c", "timeline", 50, 5, 3, T(1), T(1), "dead", "x"),
        (4, "d", "match", 10, 1, 0, T(2), T(1), "claimed", None), (5, "e", "timeline", 100, 1, 0, T(0), None, "retry", None),
    ], QUEUE)


def test_merge_queue(spark, queue):
    items = spark.createDataFrame([("a", "timeline", 1, None, 0), ("b", "timeline", 7, None, 1), ("c", "timeline", 7, None, 2), ("z", "timeline", 9, None, 3), ("z", "timeline", 4, None, 4), ("", "timeline", 4, None, 5)], "match_id string, kind string, priority int, not_before timestamp, position long")
    out = {r.match_id: r for r in control.merge_queue(queue, items, "2026-09-02 00:00:00").collect()}
    assert len(out) == 6 and out["a"].priority == 100 and out["a"].status == "pending"
    assert (out["b"].status, out["b"].attempts, out["b"].revivals, out["b"].last_cause) == ("pending", 0, 3, None)
    assert (out["c"].status, out["c"].revivals) == ("dead", 3)
    assert (out["z"].priority, out["z"].status, out["z"].not_before) == (4, "pending", dt.datetime(2026, 9, 2)) and out["z"].id > 5


def test_ready_jobs_and_maintenance(queue):
    assert [r.id for r in control.ready_jobs(queue, "timeline", "2026-09-01 01:00:00", 10).collect()] == [5, 1]
    stuck = {r.id: r for r in control.reset_stuck(queue, "2026-09-01 02:00:00", "2026-09-01 03:00:00").collect()}
    assert (stuck[4].status, stuck[4].claimed_at, stuck[4].last_cause) == ("retry", None, control.EXPIRED) and stuck[2].status == "dead"
    back = {r.id: r for r in control.replay_dead(queue, "2026-09-01 03:00:00", 1).collect()}
    assert (back[3].status, back[3].attempts, back[2].status) == ("pending", 0, "dead")
    assert dict(rows(control.queue_depths(queue))) == {"pending": 1, "dead": 2, "claimed": 1, "retry": 1}


def test_frontier(spark):
    schema = "puuid string, region string, seed_tier string, seed_division string, last_seen_at timestamp, last_fetched_at timestamp, consecutive_empty int, priority int, dead boolean"
    table = spark.createDataFrame([("p", "EUW", "GOLD", "I", T(5), T(1), 3, 100, False), ("q", "EUW", "", "", T(1), None, 20, 100, False), ("r", "EUW", "", "", T(1), T(1), 0, 10, True)], schema)
    entries = spark.createDataFrame([("p", "NA", "SILVER", "II", T(2), 200), ("s", "EUW", "", "", T(3), 200), ("s", "EUW", "", "", T(4), 0)], "puuid string, region string, seed_tier string, seed_division string, last_seen_at timestamp, priority int")
    out = {r.puuid: r for r in control.merge_frontier(table, entries).collect()}
    assert (out["p"].region, out["p"].seed_tier, out["p"].last_seen_at, out["p"].priority, out["p"].consecutive_empty) == ("NA", "SILVER", T(5), 100, 3)
    assert (out["s"].priority, out["s"].dead, out["s"].last_fetched_at) == (0, False, None)
    assert [r.puuid for r in control.next_frontier(table, "2026-09-01 06:00:00", 3600, 9).collect()] == ["q", "p"]
    assert {r.puuid: r.priority for r in control.reprioritize(table).collect()} == {"p": 125, "q": 300, "r": 10}
    assert [r.puuid for r in control.prune_frontier(table, "2026-09-01 03:00:00", 10).collect()] == ["p"]
    assert control.frontier_size(table).first()[:] == (2, 1)


def test_samples_grow_by_adding(spark):
    matches = spark.createDataFrame([(f"m{k}",) for k in range(50)], "match_id string")
    ten = [r[0] for r in control.hash_sample(matches, 10).collect()]
    assert ten == [r[0] for r in control.hash_sample(matches.orderBy(F.rand()), 20).collect()][:10]
    with pytest.raises(ValueError):
        control.hash_sample(matches, control.SAMPLE_CAP + 1)


def test_toggles_and_runs(spark):
    schema = "source string, enabled boolean, decided_by string, decided_at timestamp, review_due_at timestamp, notes string"
    old = spark.createDataFrame([("a", True, "x", T(1), None, ""), ("b", True, "x", T(1), None, "")], schema)
    new = spark.createDataFrame([("a", True, "y", T(2), None, "n"), ("b", False, "y", T(2), None, "n"), ("c", True, "y", T(2), None, "")], schema)
    out = {r.source: (r.enabled, r.decided_by, r.decided_at) for r in control.set_toggles(old, new).collect()}
    assert out == {"a": (True, "y", T(1)), "b": (False, "y", T(2)), "c": (True, "y", T(2))}
    run = spark.createDataFrame([("16.1", 3, 2, 1)], "patch string, cells_total int, cells_published int, cells_suppressed int")
    assert control.append_run(run, run).count() == 2
    with pytest.raises(Exception, match="more than their total"):
        control.append_run(run, run.withColumn("cells_total", F.lit(1))).collect()


def test_freshness_and_provenance(spark):
    seen = spark.createDataFrame([(T(5),), (T(3),)], "fetched_at timestamp")
    stale = lambda hour: gates.freshness(seen, F.lit(f"2026-09-01 {hour:02d}:00:00"), 2).first().stale
    assert (stale(7), stale(8), gates.freshness(seen.limit(0), F.lit("2026-09-01 00:00:00"), 2).first().stale) == (False, True, True)
    gates.check_provenance("abcdef1", 3)
    for revision, run in (("xyz", 3), ("abcdef1", 0)):
        with pytest.raises(gates.GateFailed):
            gates.check_provenance(revision, run)
