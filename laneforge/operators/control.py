"""Crawl tables: samples, backlog figures, merges and maintenance.

A merge takes a table and a batch and gives the table's next snapshot, by a full outer join on its
key. Nothing is updated in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REVIVALS = 3
SAMPLE_CAP = 100_000
SEED_PRIORITY, PARTICIPANT_PRIORITY = 0, 200
EXPIRED = "the claim ran out before its worker reported a result"
REPLAYED = "taken up again after it had been given up"


# ---- samples and figures -----------------------------------------------------------------


def eligible_matches(matches: DataFrame, region: str, queue: int, since) -> DataFrame:
    return matches.where((F.col("region") == region) & (F.col("queue_id") == queue) & (F.col("game_creation") >= F.lit(since).cast("timestamp")))


def timeline_jobs(queue: DataFrame, kind: str = "timeline") -> DataFrame:
    return queue.where(F.col("kind") == kind).select("match_id", F.col("status").alias("job_status"))


def timeline_candidates(matches: DataFrame, queue: DataFrame, region: str, queue_id: int, since, min_duration_s: int = 0, limit: int = 1000) -> DataFrame:
    """Matches without a timeline job, a sample that is the same from run to run: the first by hash of the id."""
    rows = eligible_matches(matches, region, queue_id, since)
    if min_duration_s > 0:
        rows = rows.where(F.col("game_duration_s") >= min_duration_s)
    return hash_sample(rows.join(timeline_jobs(queue), "match_id", "left_anti"), limit)


def hash_sample(matches: DataFrame, limit: int) -> DataFrame:
    """The first by MD5 of the id; a larger limit only adds rows."""
    if not 0 < limit <= SAMPLE_CAP:
        raise ValueError(f"a sample has 1 to {SAMPLE_CAP} matches")
    return matches.orderBy(F.md5("match_id"), "match_id").limit(limit)


def timeline_backlog(matches: DataFrame, queue: DataFrame, region: str, queue_id: int, since, min_duration_s: int = 0) -> DataFrame:
    """One row: eligible matches, those too short, with a job that waits or is over, and those ready."""
    rows = eligible_matches(matches, region, queue_id, since).join(timeline_jobs(queue), "match_id", "left")
    short = (F.col("game_duration_s") < min_duration_s) & F.lit(min_duration_s > 0)
    job = F.col("job_status").isNotNull()
    return rows.agg(
        F.count("*").alias("eligible"), F.count_if(short).alias("short_excluded"), F.count_if(~short & F.col("job_status").isin("pending", "claimed", "retry")).alias("already_queued"),
        F.count_if(~short & F.col("job_status").isin("done", "dead")).alias("already_done"), F.count_if(~short & ~job).alias("ready"),
    )


def queue_depths(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status").agg(F.count("*").alias("jobs"))


def queue_oldest(queue: DataFrame) -> DataFrame:
    return queue.where("status IN ('pending', 'retry')").agg(F.min("not_before").alias("oldest"))


def newest_fetched(matches: DataFrame) -> DataFrame:
    return matches.agg(F.max("fetched_at").alias("newest"))


def frontier_size(frontier: DataFrame) -> DataFrame:
    return frontier.agg(F.count_if(~F.col("dead")).alias("live"), F.count_if("dead").alias("dead"))


def known_matches(ids: DataFrame, matches: DataFrame) -> DataFrame:
    return ids.join(matches.select("match_id"), "match_id", "left_semi")


def new_matches(ids: DataFrame, matches: DataFrame) -> DataFrame:
    return ids.join(matches.select("match_id"), "match_id", "left_anti")


def next_frontier(frontier: DataFrame, now, cooldown_s: int, limit: int) -> DataFrame:
    """The players to fetch next: by priority, those never fetched first, then the longest ago."""
    ready = F.col("last_fetched_at").isNull() | (F.col("last_fetched_at") <= F.lit(now).cast("timestamp") - F.make_dt_interval(secs=F.lit(cooldown_s)))
    return frontier.where(~F.col("dead") & ready).orderBy("priority", F.col("last_fetched_at").asc_nulls_first(), "puuid").limit(limit)


def ready_jobs(queue: DataFrame, kind: str, now, limit: int) -> DataFrame:
    rows = queue.where((F.col("kind") == kind) & F.col("status").isin("pending", "retry") & (F.col("not_before") <= F.lit(now).cast("timestamp")))
    return rows.orderBy("priority", "not_before", "id").limit(limit)


# ---- merges ------------------------------------------------------------------------------


def merged(table: DataFrame, batch: DataFrame, keys: list[str], when_both: dict[str, Column]) -> DataFrame:
    """``table`` with the rows of ``batch``: new ones added, those in both as ``when_both`` has them.

    Expressions name the batch's columns with a prefix ``new_``. A key stands once in ``batch``.
    """
    new = batch.select(*keys, *(F.col(c).alias(f"new_{c}") for c in table.columns if c not in keys), F.lit(True).alias("_new"))
    both = table.withColumn("_old", F.lit(True)).join(new, keys, "full")
    old, fresh = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    values = [F.when(old & fresh, when_both.get(c, F.col(c))).when(old, F.col(c)).otherwise(F.col(f"new_{c}")).alias(c) for c in table.columns if c not in keys]
    return both.select(*keys, *values).select(*table.columns)


def first_of(batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    first = Window.partitionBy(*keys).orderBy(*order)
    return batch.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def merge_matches(matches: DataFrame, batch: DataFrame) -> DataFrame:
    """New matches added; those known stay as they are."""
    fresh = first_of(batch, ["match_id"], ["fetched_at"]).join(matches.select("match_id"), "match_id", "left_anti")
    return matches.unionByName(fresh)


def dedup_queue_items(items: DataFrame) -> DataFrame:
    """One item for each match and kind: the first by ``position``, at the least priority asked."""
    rows = items.where("match_id <> ''").groupBy("match_id", "kind").agg(F.min("priority").alias("priority"), F.min_by("not_before", "position").alias("not_before"), F.min("position").alias("position"))
    return rows.select("match_id", "kind", "priority", "not_before", "position")


def last_id(queue: DataFrame) -> DataFrame:
    """One row: the largest id, by which new jobs go on."""
    return queue.agg(F.max("id").alias("last_id"))


def merge_queue(queue: DataFrame, items: DataFrame, now, last: DataFrame | None = None) -> DataFrame:
    """New jobs added as pending; dead ones revived, up to three times; others as they are.

    Where ``queue`` is a part of the table, ``last`` is the ``last_id`` of the whole.
    """
    revive = (F.col("status") == "dead") & (F.col("revivals") < REVIVALS)
    last_id_ = F.coalesce(F.col("last_id"), F.lit(0))
    numbered = dedup_queue_items(items).crossJoin(last_id(queue) if last is None else last)  # one row
    new = numbered.select(
        "match_id", "kind", (last_id_ + 1 + F.col("position")).alias("id"), "priority", F.lit(0).alias("attempts"), F.lit(0).alias("revivals"),
        F.coalesce("not_before", F.lit(now).cast("timestamp")).alias("not_before"), F.lit(None).cast("timestamp").alias("claimed_at"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("last_cause"),
    )
    revived = {"status": F.lit("pending"), "attempts": F.lit(0), "revivals": F.col("revivals") + 1, "not_before": F.col("new_not_before"), "claimed_at": F.lit(None), "last_cause": F.lit(None)}
    return merged(queue, new, ["match_id", "kind"], {c: F.when(revive, v).otherwise(F.col(c)) for c, v in revived.items()})


def merge_frontier(frontier: DataFrame, entries: DataFrame) -> DataFrame:
    """Players added or seen again: the later sight, the smaller priority, the new seed."""
    batch = first_of(entries, ["puuid"], ["priority", F.col("last_seen_at").desc()])
    new = batch.select("puuid", "region", "seed_tier", "seed_division", "last_seen_at", F.lit(None).cast("timestamp").alias("last_fetched_at"), F.lit(0).alias("consecutive_empty"), "priority", F.lit(False).alias("dead"))
    return merged(frontier, new, ["puuid"], {
        "region": F.col("new_region"), "seed_tier": F.col("new_seed_tier"), "seed_division": F.col("new_seed_division"),
        "last_seen_at": F.greatest("last_seen_at", "new_last_seen_at"), "priority": F.least("priority", "new_priority"),
    })


def seed_entries(pages: DataFrame, default_tier: str = "", default_division: str = "") -> DataFrame:
    """Frontier entries of ladder pages (region, tier, division, fetched_at, payload of entries)."""
    entry = "STRUCT<puuid: STRING, tier: STRING, rank: STRING>"
    league = F.from_json("payload", f"STRUCT<entries: ARRAY<{entry}>>")["entries"]
    listed = F.when(F.ltrim("payload").startswith("["), F.from_json("payload", f"ARRAY<{entry}>")).otherwise(league)
    rows = pages.select("region", "fetched_at", "tier", "division", F.explode(listed).alias("e"))
    puuid = F.trim("e.puuid")
    or_else = lambda own, page, rest: F.upper(F.coalesce(F.nullif(own, F.lit("")), F.nullif(page, F.lit("")), F.lit(rest)))
    named = rows.where(puuid != "").select(puuid.alias("puuid"), "region", or_else(F.col("e.tier"), F.col("tier"), default_tier).alias("seed_tier"), or_else(F.col("e.rank"), F.col("division"), default_division).alias("seed_division"), F.col("fetched_at").alias("last_seen_at"), F.lit(SEED_PRIORITY).alias("priority"))
    return first_of(named, ["puuid"], [F.col("last_seen_at").desc(), "seed_tier", "seed_division"])


def widened(ids: DataFrame) -> DataFrame:
    """Frontier entries of the players of new matches (match_id, region, fetched_at, puuids)."""
    rows = ids.select("region", F.col("fetched_at").alias("last_seen_at"), F.explode("puuids").alias("puuid"))
    return rows.groupBy("puuid", "region").agg(F.max("last_seen_at").alias("last_seen_at")).withColumns({"seed_tier": F.lit(""), "seed_division": F.lit(""), "priority": F.lit(PARTICIPANT_PRIORITY)})


def set_toggles(toggles: DataFrame, batch: DataFrame) -> DataFrame:
    """Toggles as decided; the time of decision moves only with the decision."""
    changed = ~F.col("enabled").eqNullSafe(F.col("new_enabled"))
    take = {c: F.col(f"new_{c}") for c in ("enabled", "decided_by", "review_due_at", "notes")}
    return merged(toggles, batch, ["source"], take | {"decided_at": F.when(changed, F.col("new_decided_at")).otherwise(F.col("decided_at"))})


def append_run(runs: DataFrame, run: DataFrame) -> DataFrame:
    """The run table with one more row, whose counts must agree."""
    good = F.col("cells_published") + F.col("cells_suppressed") <= F.col("cells_total")
    checked = run.where(F.assert_true(good, F.lit("a run's cells are more than their total")).isNull())
    return runs.unionByName(checked)


# ---- maintenance -------------------------------------------------------------------------


def first_rows(rows: DataFrame, keys: list[str], order: list, limit: int) -> DataFrame:
    return rows.orderBy(*order).limit(limit).select(*keys, F.lit(True).alias("_hit"))


JOB = ["match_id", "kind"]


def stuck_jobs(queue: DataFrame, before, limit: int = 1000) -> DataFrame:
    """The keys of jobs claimed before a time, the oldest claims first."""
    stuck = queue.where((F.col("status") == "claimed") & (F.col("claimed_at") < F.lit(before).cast("timestamp")))
    return first_rows(stuck, [*JOB, "id"], ["claimed_at", "id"], limit)


def dead_jobs(queue: DataFrame, limit: int = 1000) -> DataFrame:
    """The keys of dead jobs, those claimed first first."""
    return first_rows(queue.where("status = 'dead'"), [*JOB, "id"], [F.col("claimed_at").asc_nulls_last(), "id"], limit)


def rewritten(table: DataFrame, hits: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    both = table.join(hits, keys, "left")
    return both.select(*(F.when(F.col("_hit").isNotNull(), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in table.columns))


def reset_stuck(queue: DataFrame, before, now, limit: int = 1000, hits: DataFrame | None = None) -> DataFrame:
    """Jobs claimed before a time go back to be tried again. ``hits`` are those of the whole table where ``queue`` is a part of it."""
    hits = stuck_jobs(queue, before, limit) if hits is None else hits
    return rewritten(queue, hits.drop(*JOB), ["id"], {"status": F.lit("retry"), "claimed_at": F.lit(None), "not_before": F.lit(now).cast("timestamp"), "last_cause": F.lit(EXPIRED)})


def replay_dead(queue: DataFrame, now, limit: int = 1000, hits: DataFrame | None = None) -> DataFrame:
    """Dead jobs become pending. ``hits`` as above."""
    hits = dead_jobs(queue, limit) if hits is None else hits
    return rewritten(queue, hits.drop(*JOB), ["id"], {"status": F.lit("pending"), "attempts": F.lit(0), "claimed_at": F.lit(None), "not_before": F.lit(now).cast("timestamp"), "last_cause": F.lit(REPLAYED)})


def prune_frontier(frontier: DataFrame, before, max_empty: int) -> DataFrame:
    """The frontier without dead players not met since a time, and without those found empty too often."""
    old = lambda c: F.coalesce(c < F.lit(before).cast("timestamp"), F.lit(False))
    gone = F.col("dead") & old(F.coalesce("last_fetched_at", "last_seen_at")) | (F.col("consecutive_empty") >= max_empty) & old(F.col("last_seen_at"))
    return frontier.where(~gone)


def reprioritize(frontier: DataFrame) -> DataFrame:
    due = F.least(F.lit(300), 50 + 25 * F.col("consecutive_empty"))
    return frontier.withColumn("priority", F.when(F.col("dead"), F.col("priority")).otherwise(due).cast("int"))
