"""Crawl table queries. The tables are derived from ``orders`` and ``customer``; times are shown in seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneforge.operators import control, gates
from laneforge.operators.extract import participant_ids
from laneforge.plans import synth
from laneforge.plans.catalog import ORACLES, query
from laneforge.sources import archive, publish, schemas, shared
from laneforge.sources.snapshots import Snapshot
from laneforge.streaming.archive import staleness

START = 1788220800
NOW = "2026-09-15 00:00:00"
QUEUE = {
    "id": "k", "kind": "CASE WHEN k % 2 = 0 THEN 'timeline' ELSE 'match' END", "priority": "CAST(100 + k % 5 AS INT)", "attempts": "CAST(k % 4 AS INT)", "revivals": "CAST(k % 7 AS INT)",
    "not_before": f"{START} + (k % 1000) * 3600", "claimed_at": f"CASE WHEN k % 5 IN (1, 4) THEN {START} + (k % 700) * 3600 END",
    "status": "CASE k % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'claimed' WHEN 2 THEN 'retry' WHEN 3 THEN 'done' ELSE 'dead' END",
}
FRONTIER = {
    "puuid": "concat('p', CAST(c AS STRING))", "seed_tier": "CASE WHEN c % 3 = 0 THEN 'GOLD' ELSE '' END", "last_seen_at": f"{START} + (c % 900) * 3600",
    "last_fetched_at": f"CASE WHEN c % 4 <> 0 THEN {START} + (c % 500) * 3600 END", "consecutive_empty": "CAST(c % 14 AS INT)", "priority": "CAST(100 + c % 7 AS INT)", "dead": "c % 10 = 0",
}


def listed(table: dict[str, str]) -> str:
    return ", ".join(f"{x} AS {n}" for n, x in table.items())


W = synth.sql_relations() + f""", q AS (SELECT match_id, {listed(QUEUE)}, NULL::VARCHAR AS last_cause
 FROM m WHERE k % 3 = 0), mt AS (SELECT k, match_id, CAST(queue_id AS INT) AS queue_id, patch, game_creation_ms // 1000 AS created,
 game_duration_s, game_creation_ms // 1000 + 86400 AS fetched FROM m),
fr AS (SELECT {listed(FRONTIER)} FROM (SELECT CAST(c_custkey AS BIGINT) AS c FROM customer))"""


def at(column: str):
    return F.timestamp_seconds(column).alias(column)


def seconds(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = synth.base(spark, sf_dir)
    return rows.select("k", "match_id", F.lit("EUW").alias("region"), F.col("queue_id").cast("int").alias("queue_id"), F.expr("concat('16.', CAST(16 + k % 3 AS STRING))").alias("patch"), "game_version", F.timestamp_millis("game_creation_ms").alias("game_creation"), "game_duration_s", F.timestamp_millis(F.col("game_creation_ms") + 86400000).alias("fetched_at"))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = synth.base(spark, sf_dir).where("k % 3 = 0").select("match_id", *(F.expr(x).alias(n) for n, x in QUEUE.items()))
    return rows.select("id", "match_id", "kind", "priority", "attempts", "revivals", at("not_before"), at("claimed_at"), "status", F.lit(None).cast("string").alias("last_cause"))


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("bigint").alias("c")).select(*(F.expr(x).alias(n) for n, x in FRONTIER.items()))
    return rows.select("puuid", F.lit("EUW").alias("region"), "seed_tier", F.lit("").alias("seed_division"), at("last_seen_at"), at("last_fetched_at"), "consecutive_empty", "priority", "dead")


SINCE = "2026-09-03 00:00:00"
SINCE_S = START + 2 * 86400
ELIGIBLE = f"queue_id = 420 AND created >= {SINCE_S}"


@query("timeline_candidates", W + f""" SELECT match_id, patch, game_duration_s
 FROM mt WHERE {ELIGIBLE} AND game_duration_s >= 600 AND match_id NOT IN (SELECT match_id
 FROM q WHERE kind = 'timeline') ORDER BY md5(match_id), match_id LIMIT 200""")
def timeline_candidates(spark, sf_dir):
    return control.timeline_candidates(matches(spark, sf_dir), queue(spark, sf_dir), "EUW", 420, SINCE, 600, 200).select("match_id", "patch", "game_duration_s")


@query("hash_sample", W + " SELECT match_id FROM mt ORDER BY md5(match_id), match_id LIMIT 500")
def hash_sample(spark, sf_dir):
    return control.hash_sample(matches(spark, sf_dir), 500).select("match_id")


@query("timeline_backlog_stats", W + f""", j AS (SELECT mt.*, status FROM mt
 LEFT JOIN (SELECT * FROM q WHERE kind = 'timeline') USING (match_id) WHERE {ELIGIBLE}) SELECT count(*) AS eligible,
 count_if(game_duration_s < 600) AS short_excluded, count_if(game_duration_s >= 600 AND status IN ('pending',
 'claimed', 'retry')) AS already_queued, count_if(game_duration_s >= 600 AND status IN ('done', 'dead')) AS already_done,
 count_if(game_duration_s >= 600 AND status IS NULL) AS ready FROM j""")
def timeline_backlog(spark, sf_dir):
    return control.timeline_backlog(matches(spark, sf_dir), queue(spark, sf_dir), "EUW", 420, SINCE, 600)


query("queue_depths", W + " SELECT status, count(*) AS jobs FROM q GROUP BY 1")(lambda spark, sf_dir: control.queue_depths(queue(spark, sf_dir)))
query("queue_oldest", W + " SELECT min(not_before) AS oldest FROM q WHERE status IN ('pending', 'retry')")(lambda spark, sf_dir: seconds(control.queue_oldest(queue(spark, sf_dir)), "oldest"))
query("newest_fetched", W + " SELECT max(fetched) AS newest FROM mt")(lambda spark, sf_dir: seconds(control.newest_fetched(matches(spark, sf_dir)), "newest"))
query("frontier_size", W + " SELECT count_if(NOT dead) AS live, count_if(dead) AS dead FROM fr")(lambda spark, sf_dir: control.frontier_size(frontier(spark, sf_dir)))
query("freshness_gate", W + f""" SELECT max(fetched) AS newest_fetched_at, {START + 21 * 86400} - max(fetched) > 129600 AS stale
 FROM mt""")(lambda spark, sf_dir: seconds(gates.freshness(matches(spark, sf_dir), F.lit("2026-09-22 00:00:00"), 36), "newest_fetched_at"))


def offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that a crawl comes upon: those of odd orders, twice as far as there are orders."""
    rows = synth.base(spark, sf_dir).where("k % 2 = 1")
    return rows.select(F.expr("concat('EUW1_', lpad(CAST(k * 2 AS STRING), 10, '0'))").alias("match_id"))


OFFERED = ", off AS (SELECT concat('EUW1_', lpad(CAST(k * 2 AS STRING), 10, '0')) AS match_id FROM m WHERE k % 2 = 1)"
query("known_match", W + OFFERED + " SELECT match_id FROM off WHERE match_id IN (SELECT match_id FROM mt)")(lambda spark, sf_dir: control.known_matches(offered(spark, sf_dir), matches(spark, sf_dir)))
query("new_match", W + OFFERED + " SELECT match_id FROM off WHERE match_id NOT IN (SELECT match_id FROM mt)")(lambda spark, sf_dir: control.new_matches(offered(spark, sf_dir), matches(spark, sf_dir)))
NOW_S = START + 14 * 86400
query("next_frontier", W + f""" SELECT puuid, priority, last_fetched_at
 FROM fr WHERE NOT dead AND (last_fetched_at IS NULL OR last_fetched_at <= {NOW_S} - 86400)
 ORDER BY priority, last_fetched_at NULLS FIRST, puuid LIMIT 100""")(
    lambda spark, sf_dir: seconds(control.next_frontier(frontier(spark, sf_dir), NOW, 86400, 100).select("puuid", "priority", "last_fetched_at"), "last_fetched_at")
)
query("ready_jobs", W + f""" SELECT id, match_id, priority FROM q WHERE kind = 'timeline' AND status IN ('pending',
 'retry') AND not_before <= {NOW_S} ORDER BY priority, not_before, id LIMIT 100""")(
    lambda spark, sf_dir: control.ready_jobs(queue(spark, sf_dir), "timeline", NOW, 100).select("id", "match_id", "priority")
)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs asked for, some twice at another priority."""
    rows = synth.base(spark, sf_dir).where("k % 4 = 0").select("match_id", F.lit("timeline").alias("kind"), F.expr("CAST(50 + k % 3 AS INT)").alias("priority"), F.lit(None).cast("timestamp").alias("not_before"), F.col("k").alias("position"))
    return rows.unionByName(rows.where("position % 8 = 0").withColumns({"priority": F.lit(10), "position": F.col("position") + 1}))


query("dedup_queue_items", W + """ SELECT match_id, 'timeline' AS kind, CAST(CASE WHEN k % 8 = 0 THEN 10 ELSE 50 + k % 3 END AS INT) AS priority,
 k AS position FROM m WHERE k % 4 = 0""")(lambda spark, sf_dir: control.dedup_queue_items(items(spark, sf_dir)).drop("not_before"))


@query("merge_queue", W + f""", n AS (SELECT k, match_id FROM m WHERE k % 4 = 0), top AS (SELECT max(id) AS last_id
 FROM q) SELECT coalesce(q.id, last_id + 1 + n.k) AS id, coalesce(q.match_id, n.match_id) AS match_id, coalesce(q.kind,
 'timeline') AS kind, CASE WHEN n.match_id IS NOT NULL AND q.status = 'dead' AND revivals < 3 THEN 'pending'
 ELSE coalesce(q.status, 'pending') END AS status, CASE WHEN q.id IS NULL THEN 0 WHEN n.match_id IS NOT NULL
 AND q.status = 'dead' AND revivals < 3 THEN revivals + 1 ELSE revivals END::INT AS revivals, CASE WHEN q.id IS NULL THEN {NOW_S}
 WHEN n.match_id IS NOT NULL AND q.status = 'dead' AND revivals < 3 THEN {NOW_S} ELSE q.not_before END AS not_before
 FROM q FULL JOIN n ON n.match_id = q.match_id AND q.kind = 'timeline', top""")
def merge_queue(spark, sf_dir):
    out = control.merge_queue(queue(spark, sf_dir), items(spark, sf_dir), NOW)
    return seconds(out.select("id", "match_id", "kind", "status", "revivals", "not_before"), "not_before")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select((F.col("c_custkey").cast("bigint") * 2).alias("c"))
    return rows.select(F.expr("concat('p', CAST(c AS STRING))").alias("puuid"), F.lit("NA").alias("region"), F.lit("SILVER").alias("seed_tier"), F.lit("I").alias("seed_division"), F.timestamp_seconds(F.lit(START) + F.col("c") % 1200 * 3600).alias("last_seen_at"), F.expr("CAST(c % 200 AS INT)").alias("priority"))


@query("merge_frontier", W + f""", n AS (SELECT concat('p', CAST(c AS STRING)) AS puuid, {START} + c % 1200 * 3600 AS seen,
 CAST(c % 200 AS INT) AS pr FROM (SELECT CAST(c_custkey AS BIGINT) * 2 AS c
 FROM customer)) SELECT coalesce(fr.puuid, n.puuid) AS puuid, CASE WHEN n.puuid IS NULL THEN 'EUW' ELSE 'NA' END AS region,
 CASE WHEN n.puuid IS NULL THEN fr.seed_tier ELSE 'SILVER' END AS seed_tier, greatest(fr.last_seen_at, n.seen) AS last_seen_at,
 least(fr.priority, n.pr) AS priority, coalesce(fr.dead, false) AS dead
 FROM fr FULL JOIN n ON n.puuid = fr.puuid""")
def merge_frontier(spark, sf_dir):
    out = control.merge_frontier(frontier(spark, sf_dir), entries(spark, sf_dir))
    return seconds(out.select("puuid", "region", "seed_tier", "last_seen_at", "priority", "dead"), "last_seen_at")


@query("merge_matches", W + """ SELECT match_id, fetched AS fetched_at
 FROM mt WHERE k % 3 <> 0 UNION ALL SELECT match_id, fetched + 60 FROM mt
 WHERE k % 3 = 0""")
def merge_matches(spark, sf_dir):
    rows = matches(spark, sf_dir)
    again = rows.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 60 SECONDS"))
    out = control.merge_matches(rows.where("k % 3 <> 0"), again.unionByName(again.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 60 SECONDS"))))
    return seconds(out.select("match_id", "fetched_at"), "fetched_at")


@query("reset_stuck", W + f""", s AS (SELECT id FROM q WHERE status = 'claimed' AND claimed_at < {NOW_S}
 ORDER BY claimed_at, id LIMIT 300) SELECT id, CASE WHEN s.id IS NULL THEN status ELSE 'retry' END AS status,
 CASE WHEN s.id IS NULL THEN claimed_at END AS claimed_at, CASE WHEN s.id IS NULL THEN not_before ELSE {NOW_S} END AS not_before,
 CASE WHEN s.id IS NOT NULL THEN '{control.EXPIRED}' END AS last_cause FROM q
 LEFT JOIN s USING (id)""")
def reset_stuck(spark, sf_dir):
    out = control.reset_stuck(queue(spark, sf_dir), NOW, NOW, 300)
    return seconds(out.select("id", "status", "claimed_at", "not_before", "last_cause"), "claimed_at", "not_before")


@query("replay_dead", W + f""", s AS (SELECT id FROM q WHERE status = 'dead'
 ORDER BY claimed_at, id LIMIT 300) SELECT id, CASE WHEN s.id IS NULL THEN status ELSE 'pending' END AS status,
 CASE WHEN s.id IS NULL THEN attempts ELSE 0 END AS attempts, CASE WHEN s.id IS NULL THEN claimed_at END AS claimed_at
 FROM q LEFT JOIN s USING (id)""")
def replay_dead(spark, sf_dir):
    out = control.replay_dead(queue(spark, sf_dir), NOW, 300)
    return seconds(out.select("id", "status", "attempts", "claimed_at"), "claimed_at")


query("prune_frontier", W + f""" SELECT puuid, dead FROM fr WHERE NOT ((dead AND coalesce(last_fetched_at,
 last_seen_at) < {NOW_S}) OR (consecutive_empty >= 8 AND last_seen_at < {NOW_S}))""")(lambda spark, sf_dir: control.prune_frontier(frontier(spark, sf_dir), NOW, 8).select("puuid", "dead"))
query("reprioritize", W + """ SELECT puuid, CAST(CASE WHEN dead THEN priority ELSE least(300, 50 + 25 * consecutive_empty) END AS INT) AS priority
 FROM fr""")(lambda spark, sf_dir: control.reprioritize(frontier(spark, sf_dir)).select("puuid", "priority"))


@query("seed_frontier", """SELECT DISTINCT 'p' || c_custkey AS puuid, upper(CASE WHEN c_custkey % 3 = 0 THEN 'Gold'
 ELSE 'silver' END) AS seed_tier, CASE WHEN c_custkey % 2 = 0 THEN 'II' ELSE 'IV' END AS seed_division
 FROM customer WHERE c_custkey % 11 <> 0""")
def seed_frontier(spark, sf_dir):
    """Ladder pages of customers; an entry may lack its tier or rank, be blank, or stand twice."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("c"))
    puuid = "CASE WHEN c % 11 = 0 THEN '  ' ELSE concat(' p', CAST(c AS STRING)) END"
    entry = F.expr(f"named_struct('puuid', {puuid}, 'tier', CASE WHEN c % 3 = 0 THEN 'Gold' END, 'rank', CASE WHEN c % 2 = 0 THEN 'ii' END)")
    pages = rows.select(F.lit("EUW").alias("region"), F.lit("silver").alias("tier"), F.lit("iv").alias("division"), F.lit(NOW).cast("timestamp").alias("fetched_at"), F.to_json(F.array(entry, entry)).alias("payload"))
    return control.seed_entries(pages).select("puuid", "seed_tier", "seed_division")


@query("widen_frontier", W + f""" SELECT 'p' || CAST({synth.H} % 5000 AS VARCHAR) AS puuid, max(game_creation_ms // 1000 + 86400) AS last_seen_at,
 200::INT AS priority FROM p WHERE k % 3 = 0 GROUP BY 1""")
def widen_frontier(spark, sf_dir):
    """The players of new matches; of each summary that was fetched the names alone are parsed, once, and only these are sorted."""
    told = archive.envelope(archive.parse_summaries(synth.archived(spark, sf_dir, "fetched"), schemas.NAMED, once=True))
    seen = archive.first_of_each(participant_ids(told, "part", "part_row"))
    fetched = matches(spark, sf_dir).where(synth.NEW).select("match_id", "region", "fetched_at")
    out = control.widened(seen.join(fetched, "match_id"))
    return seconds(out.select("puuid", "last_seen_at", "priority"), "last_seen_at")


@query("set_toggles", """SELECT r_name AS source, (r_regionkey % 3 = 0) AS enabled, CASE WHEN (r_regionkey % 2 = 0) <> (r_regionkey % 3 = 0) THEN 2
 ELSE 1 END::BIGINT AS decided_at FROM region""")
def set_toggles(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/region.parquet")
    toggles = lambda rule, t: rows.select(F.col("r_name").alias("source"), F.expr(rule).alias("enabled"), F.lit("ops").alias("decided_by"), F.timestamp_seconds(F.lit(t)).alias("decided_at"), F.lit(None).cast("timestamp").alias("review_due_at"), F.lit("").alias("notes"))
    out = control.set_toggles(toggles("r_regionkey % 2 = 0", 1), toggles("r_regionkey % 3 = 0", 2))
    return seconds(out.select("source", "enabled", "decided_at"), "decided_at")


@query("audit_runs", W + """, r AS (SELECT patch, count(*) AS total, count_if(game_duration_s >= 600) AS shown
 FROM m GROUP BY 1) SELECT patch, total AS cells_total, shown AS cells_published, total - shown AS cells_suppressed
 FROM r UNION ALL SELECT patch, 0, 0, 0 FROM r""")
def audit_runs(spark, sf_dir):
    rows = matches(spark, sf_dir).groupBy("patch").agg(F.count("*").alias("cells_total"), F.count_if(F.col("game_duration_s") >= 600).alias("cells_published"))
    run = rows.withColumn("cells_suppressed", F.col("cells_total") - F.col("cells_published"))
    runs = run.select("patch", *(F.lit(0).cast("bigint").alias(c) for c in ("cells_total", "cells_published", "cells_suppressed")))
    return control.append_run(runs, run)


@query("newest_version", W + """, v AS (SELECT DISTINCT split_part(game_version, '.', 2)::INT AS a, split_part(game_version,
 '.', 3)::INT AS b FROM m) SELECT '16.' || a || '.' || b AS version FROM v
 ORDER BY a DESC, b DESC LIMIT 1""")
def newest_version(spark, sf_dir):
    rows = synth.base(spark, sf_dir).select(F.concat_ws(".", *(F.split_part("game_version", F.lit("."), F.lit(k)) for k in (1, 2, 3))).alias("version"))
    return archive.newest_version(rows)


@query("static_dictionary", """SELECT p_partkey::INT AS id, regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g') || p_partkey AS key,
 p_name AS name, lower(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) || p_partkey AS slug, p_partkey || '.png' AS icon
 FROM part""")
def static_dictionary(spark, sf_dir):
    """Parts as champions, in documents of one entry each."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = F.concat(F.regexp_replace("p_name", "[^A-Za-z0-9]", ""), F.col("p_partkey").cast("string"))
    entry = F.struct(key.alias("id"), F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("name"), F.struct(F.concat(F.col("p_partkey").cast("string"), F.lit(".png")).alias("full")).alias("image"))
    docs = rows.select(F.lit("champion").alias("kind"), F.to_json(F.struct(F.create_map(key, entry).alias("data"))).alias("payload"))
    return archive.static_dictionary(docs, "champion")


@query("static_items", """SELECT p_partkey::INT AS id, CAST(p_partkey AS VARCHAR) AS key, p_name AS name,
 CAST(p_partkey AS VARCHAR) AS slug, p_partkey || '.png' AS icon FROM part""")
def static_items(spark, sf_dir):
    """Parts as items, which are known by the number that their entry stands under."""
    number = F.col("p_partkey").cast("string")
    entry = F.struct(F.col("p_name").alias("name"), F.struct(F.concat(number, F.lit(".png")).alias("full")).alias("image"))
    docs = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.lit("item").alias("kind"), F.to_json(F.struct(F.create_map(number, entry).alias("data"))).alias("payload"))
    return archive.static_dictionary(docs, "item")


@query("static_runes", """SELECT id, key, name, tree FROM (SELECT 8000 + 100 * n_regionkey::INT AS id, 'T' || n_regionkey AS key,
 min(n_name) AS name, 8000 + 100 * n_regionkey::INT AS tree FROM nation
 GROUP BY n_regionkey UNION ALL SELECT 9000 + n_nationkey::INT, 'R' || n_nationkey, n_name, 8000 + 100 * n_regionkey::INT
 FROM nation)""")
def static_runes(spark, sf_dir):
    """Regions as trees, with their nations as runes."""
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet")
    rune = F.struct((9000 + F.col("n_nationkey")).cast("int").alias("id"), F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("key"), F.col("n_name").alias("name"), F.lit("r.png").alias("icon"))
    slots = rows.groupBy("n_regionkey").agg(F.collect_list(rune).alias("runes"), F.min("n_name").alias("name"))
    region = F.col("n_regionkey")
    tree = F.struct((8000 + 100 * region).cast("int").alias("id"), F.concat(F.lit("T"), region.cast("string")).alias("key"), "name", F.lit("t.png").alias("icon"), F.array(F.struct("runes")).alias("slots"))
    return archive.rune_dictionary(slots.select(F.lit("runesReforged").alias("kind"), F.to_json(F.array(tree)).alias("payload"))).drop("icon")


@query("stream_staleness", W + " SELECT fetched // 3600 * 3600 AS hour, count(*) AS rows, max(fetched) AS newest FROM mt GROUP BY 1")
def stream_staleness(spark, sf_dir):
    """The stream's aggregate over the table; a test runs it as a stream."""
    return seconds(staleness(matches(spark, sf_dir)), "hour", "newest")


@query("append_archive", W + f" SELECT CAST(game_creation AS DATE) + 1 AS dt, count(*) AS rows, count(*) AS intact FROM m GROUP BY 1")
def append_archive(spark, sf_dir):
    """The rows as the archive stores them, by the day that they go to."""
    rows = publish.archive_rows(synth.archived(spark, sf_dir, "summaries").where(F.col("dt") == F.to_date(F.timestamp_millis("game_creation_ms")) + F.expr("INTERVAL 1 DAY")).drop("dt"))
    return rows.groupBy("dt").agg(F.count("*").alias("rows"), F.count_if(F.col("payload_sha256") == F.sha2("payload", 256)).alias("intact"))


# ---- the same on snapshots in buckets -----------------------------------------------------


def snapshot(spark: SparkSession, table: DataFrame, keys: list[str]) -> Snapshot:
    made = Snapshot(spark, shared.scratch(spark, "snapshot"), keys, 64)
    made.write(table)
    return made


@query("merge_queue_snapshot", ORACLES["merge_queue"].replace("k % 4 = 0", "k % 400 = 0"))
def merge_queue_snapshot(spark, sf_dir):
    """A small batch merged into the buckets that it falls in."""
    held = snapshot(spark, queue(spark, sf_dir), control.JOB)
    batch = items(spark, sf_dir).where(F.floor(F.col("position") / 2) * 2 % 400 == 0)
    held.change(batch, lambda part: control.merge_queue(part, batch, NOW, control.last_id(held.read())))
    return seconds(held.read().select("id", "match_id", "kind", "status", "revivals", "not_before"), "not_before")


@query("merge_frontier_snapshot", ORACLES["merge_frontier"])
def merge_frontier_snapshot(spark, sf_dir):
    held, batch = snapshot(spark, frontier(spark, sf_dir), ["puuid"]), entries(spark, sf_dir)
    held.change(batch, lambda part: control.merge_frontier(part, batch))
    return seconds(held.read().select("puuid", "region", "seed_tier", "last_seen_at", "priority", "dead"), "last_seen_at")


@query("reset_stuck_snapshot", ORACLES["reset_stuck"])
def reset_stuck_snapshot(spark, sf_dir):
    """The oldest claims of the whole table, rewritten where they lie."""
    held = snapshot(spark, queue(spark, sf_dir), control.JOB)
    hits = shared.stored(control.stuck_jobs(held.read(), NOW, 300))
    held.change(hits, lambda part: control.reset_stuck(part, NOW, NOW, hits=hits))
    return seconds(held.read().select("id", "status", "claimed_at", "not_before", "last_cause"), "claimed_at", "not_before")
