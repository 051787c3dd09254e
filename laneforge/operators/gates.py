"""Checks that a build must pass. Each gives rows, so a failing gate says what is wrong and where."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laneforge.functions.columns import TIERS, ci95, patch_order, role_rank, round4
from laneforge.sources.schemas import ROLES, TABLES


class GateFailed(ValueError):
    """A build that must not be published, with the reasons."""


@dataclass(frozen=True)
class GateConfig:
    max_rejected_rows: int = 0
    max_rejected_rate: float = 0.001
    reconcile_tolerance: int = 0
    min_confident_share: float = 0.0
    min_cell_n: int = 100


def require(problems: DataFrame, limit: int = 20) -> None:
    """Raises with the first problems, if there are any."""
    found = problems.limit(limit).collect()
    if found:
        raise GateFailed("; ".join(" ".join(str(x) for x in row) for row in found))


def reasons(counts: DataFrame, rules: dict) -> DataFrame:
    """One row for each rule of (name: condition that fails) that the one row of ``counts`` breaks."""
    failed = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return counts.select(F.explode(failed).alias("reason"))


# ---- tier list ---------------------------------------------------------------------------


def input_gate(archive_stats: DataFrame, window_stats: DataFrame, config: GateConfig = GateConfig()) -> DataFrame:
    """Broken rules of the archive and the window."""
    n = F.col("participant_rows")
    allowed = F.greatest(F.lit(config.max_rejected_rows), F.ceil(F.lit(config.max_rejected_rate) * n))
    return reasons(archive_stats.crossJoin(window_stats), {
        "archive_empty": F.col("archive_rows") == 0,
        "malformed_archive": F.col("malformed_rows") > 0,
        "empty_window": (F.col("matches_used") == 0) | (n - F.col("rejected_rows") == 0),
        "rejected_rows": F.col("rejected_rows") > allowed,
    })


def output_gate(suppression: DataFrame, window_stats: DataFrame, config: GateConfig = GateConfig()) -> DataFrame:
    """Broken rules of the cells: sums that differ, nothing published, or too little of it."""
    total, shown = F.col("cells_total"), F.col("cells_published")
    gap = F.abs(F.col("sum_n") - (F.col("participant_rows") - F.col("rejected_rows")))
    return reasons(suppression.crossJoin(window_stats), {
        "reconciliation": gap > config.reconcile_tolerance,
        "no_published_cells": (total > 0) & (shown == 0),
        "suppression_majority": (shown > 0) & (shown / total < config.min_confident_share),
    })


def tally_sanity(tallies: DataFrame) -> DataFrame:
    """Tallies that can't be: no games, wins out of range, an unknown role."""
    good = (F.col("n") > 0) & F.col("wins").between(0, F.col("n")) & F.col("role").isin(*ROLES)
    return tallies.where(~F.coalesce(good, F.lit(False)))


def freshness(matches: DataFrame, now, budget_hours: float) -> DataFrame:
    """One row: the newest fetch, and whether it is older than the budget at ``now`` (a timestamp column)."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros("newest_fetched_at")
    stale = F.coalesce(age > int(budget_hours * 3_600_000_000), F.lit(True))
    return matches.agg(F.max(F.col("fetched_at").cast("timestamp")).alias("newest_fetched_at")).select("newest_fetched_at", stale.alias("stale"))


def provenance(runs: DataFrame) -> DataFrame:
    """The rows of a run table that don't say which revision and run made them."""
    known = F.col("revision").rlike(r"^[0-9a-f]{7,40}$") & (F.col("run_id") > 0)
    return runs.where(~F.coalesce(known, F.lit(False)))


def check_provenance(revision: str, run_id: int, required: bool = True) -> None:
    if required and (not re.fullmatch(r"[0-9a-f]{7,40}", revision) or run_id <= 0):
        raise GateFailed("unrecorded_provenance")


# ---- feature dataset ---------------------------------------------------------------------


def exclusion_counts(index: DataFrame) -> DataFrame:
    return index.groupBy(F.coalesce("exclusion_reason", F.lit("unexplained")).alias("reason")).agg(F.count("*").alias("matches"))


def ledger_counts(index: DataFrame, summaries: DataFrame, orphans: DataFrame) -> DataFrame:
    """One row of counts over the ledger, the envelopes it was made of, and timelines without a summary."""
    ledger = index.agg(
        F.count("*").alias("matches"), F.count_if("timeline_present").alias("timelines"), F.count_if("timeline_eligible").alias("eligible"),
        F.count_if(~F.col("timeline_eligible")).alias("excluded"), F.count_if(F.col("exclusion_reason").isNull()).alias("unexplained"), F.count_distinct("match_id").alias("distinct_matches"),
    )
    bad = ~F.col("payload_valid") | F.col("match_id").isNull() | F.col("game_version").isNull() | F.col("queue_id").isNull() | F.col("game_creation_ms").isNull()
    return ledger.crossJoin(summaries.agg(F.count_if(bad).alias("malformed"))).crossJoin(orphans.agg(F.count("*").alias("orphans")))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"))
        out = row if out is None else out.unionByName(row)
    return out


def reconcile_matchups(lanes: DataFrame, index: DataFrame) -> DataFrame:
    """One row: lane rows, the matches they are of, and the matches there should be."""
    found = lanes.agg(F.count("*").alias("rows"), F.count_distinct("match_id").alias("matches"))
    return found.crossJoin(index.agg(F.count_if("timeline_eligible").alias("eligible")))


def feature_gate(counts: DataFrame, lanes: DataFrame) -> DataFrame:
    """Broken rules of the feature dataset, from ``ledger_counts`` and ``reconcile_matchups``."""
    return reasons(counts.crossJoin(lanes.select(F.col("rows").alias("lane_rows"), F.col("matches").alias("lane_matches"))), {
        "malformed": F.col("malformed") > 0,
        "unexplained": F.col("unexplained") > 0,
        "orphan_timelines": F.col("orphans") > 0,
        "empty_scope": F.col("matches") == 0,
        "no_timelines": F.col("timelines") == 0,
        "no_eligible_match": F.col("eligible") == 0,
        "lane_rows": (F.col("lane_rows") != 10 * F.col("eligible")) | (F.col("lane_matches") != F.col("eligible")),
    })


def schema_drift(df: DataFrame, table: str) -> list[str]:
    """How the columns, their order and their types differ from the specified ones."""
    want = [f"{c} {t}" for c, t in TABLES[table]]
    got = [f"{c} {t}" for c, t in df.dtypes]
    return [f"{table} column {k + 1}: {g or 'missing'}, not {w or 'specified'}" for k, (w, g) in enumerate(zip(want + [""] * len(got), got + [""] * len(want))) if w != g]


# ---- published documents -----------------------------------------------------------------


def verify_cells(cells: DataFrame, min_cell_n: int = 100, *per: str) -> DataFrame:
    """Published cells that break a rule: ranges, recomputed rates, floor, known tier and role. ``per`` are the columns of their partition, if of several."""
    rate = round4(F.col("wins") / F.col("n").cast("double"))
    off = lambda a, b: F.abs(a - b) > 1e-9
    unit = lambda c: F.col(c).between(0, 1)
    return named(cells, {
        "rates": ~(unit("win_rate") & unit("pick_rate") & unit("ban_rate")), "wins": ~F.col("wins").between(0, F.col("n")),
        "win_rate": off(F.col("win_rate"), rate), "ci95": off(F.col("ci95"), ci95(F.col("n"))), "floor": F.col("n") < min_cell_n,
        "tier": ~F.col("tier").isin(*(t for t, _ in TIERS), "D"), "role": ~F.col("role").isin(*ROLES),
    }, *per, "role", "champion_id")


def named(rows: DataFrame, rules: dict, *keys: str) -> DataFrame:
    """A row for each rule that a row breaks; a comparison with null breaks it too."""
    failed = F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items())))
    return rows.select(*keys, F.explode(failed).alias("problem"))


def verify_order(cells: DataFrame, *per: str) -> DataFrame:
    """Cells out of published order: a repeated champion, a rate above the one before, a better tier after a worse."""
    order = Window.partitionBy(*per, "role").orderBy("rank")
    tier = F.array_position(F.array(*(F.lit(t) for t, _ in TIERS), F.lit("D")), F.col("tier"))
    rows = cells.withColumn("tier_rank", tier).withColumns({
        "before": F.lag("win_rate").over(order), "tier_before": F.lag("tier_rank").over(order), "copies": F.count("*").over(Window.partitionBy(*per, "role", "champion_id")),
    })
    return named(rows, {
        "repeated": F.col("copies") > 1, "rate_order": F.coalesce(F.col("win_rate") > F.col("before"), F.lit(False)),
        "tier_order": F.coalesce(F.col("tier_rank") < F.col("tier_before"), F.lit(False)),
    }, *per, "role", "champion_id")


KEY_LENGTHS = {"items": 7, "runes": 6, "spells": 2}


def key_length() -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in KEY_LENGTHS.items() for x in kv)), F.col("kind"))


def verify_builds(builds: DataFrame, cells: DataFrame) -> DataFrame:
    """Builds with a key of the wrong length, more games than their cell, or too many of a kind."""
    rows = builds.join(cells.select("champion_id", "role", F.col("n").alias("cell_n")), ["champion_id", "role"], "left")
    return named(rows, {"key_length": F.size("key") != key_length(), "too_many_games": F.coalesce(F.col("n") > F.col("cell_n"), F.lit(False)), "too_many_builds": F.col("rank") > 10}, "champion_id", "role", "kind", "rank")


def verify_matchups(shown: DataFrame, axis: DataFrame, min_cell_n: int = 100) -> DataFrame:
    """Published pairs out of order, below the floor, off the axis, or with other rates than their counts."""
    return pair_problems(shown.join(axis, "role", "left"), min_cell_n)


def pair_problems(rows: DataFrame, min_cell_n: int, *per: str) -> DataFrame:
    """The same, of pairs with the ``champions`` of their axis."""
    rate = round4(F.col("wins") / F.col("n").cast("double"))
    return named(rows, {
        "order": F.col("champion_id") > F.col("opponent_id"), "floor": F.col("n") < min_cell_n,
        "axis": ~(F.array_contains("champions", F.col("champion_id")) & F.array_contains("champions", F.col("opponent_id"))),
        "win_rate": F.abs(F.col("win_rate") - rate) > 1e-9, "ci95": F.abs(F.col("ci95") - ci95(F.col("n"))) > 1e-9,
    }, *per, "role", "champion_id", "opponent_id")


PARTITION = ["patch", "region", "queue", "bracket"]


def verify_manifest(manifest: DataFrame, tree: DataFrame) -> DataFrame:
    """Partitions listed twice, listed but not there, there but not listed, or with a window that ends before it starts."""
    rows = manifest.groupBy(*PARTITION).agg(F.count("*").alias("copies"), F.max("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    there = tree.select(*PARTITION).distinct().withColumn("there", F.lit(True))
    both = rows.join(there, PARTITION, "full")
    return named(both, {
        "listed_twice": F.coalesce(F.col("copies") > 1, F.lit(False)), "missing": F.col("there").isNull(), "unlisted": F.col("copies").isNull(),
        "window": F.coalesce(F.col("first_day") > F.col("last_day"), F.lit(False)),
    }, *PARTITION)


def verify_latest(latest: DataFrame, manifest: DataFrame) -> DataFrame:
    """The partition named as latest, if it is not listed or another one is of a newer patch."""
    newest = manifest.agg(F.max(patch_order(F.col("patch"))).alias("newest"))  # one row
    there = manifest.select(*PARTITION, F.lit(True).alias("there")).distinct()
    rows = latest.join(there, PARTITION, "left").crossJoin(F.broadcast(newest))
    return named(rows, {"unlisted": F.col("there").isNull(), "older": patch_order(F.col("patch")) < F.col("newest")}, *PARTITION)


def verify_envelope(documents: DataFrame) -> DataFrame:
    """Documents whose ``envelope`` differs from the partition they lie in, or has a window that ends before it starts."""
    e = F.col("envelope")
    rules = {c: ~e[c].eqNullSafe(F.col(c)) for c in PARTITION}
    return named(documents, rules | {"window": e["first_day"] > e["last_day"]}, *PARTITION)


def in_published_order(cells: DataFrame) -> DataFrame:
    return cells.orderBy(role_rank(F.col("role")), "rank")
