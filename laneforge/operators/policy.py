"""Rates, tiers, suppression, rankings and the published documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from laneforge.functions.columns import ci95, patch_order, role_rank, round4, tier_of, valid_patch
from laneforge.operators.tallies import baseline

MIN_CELL_N = 100
TOP_BUILDS = 10


def cells(tallies: DataFrame, bans: DataFrame, matches: DataFrame) -> DataFrame:
    """Rates, interval and tier of each champion and role. ``matches`` has one row, ``matches_used``.

    The tier comes from the rate before rounding.
    """
    scalars = F.broadcast(baseline(tallies).crossJoin(matches.select("matches_used")))  # one row
    rate = F.col("wins") / F.col("n").cast("double")
    games = F.col("matches_used").cast("double")
    rows = tallies.join(bans, "champion_id", "left").crossJoin(scalars)
    return rows.select(
        "champion_id", "role", "n", "wins", round4(rate).alias("win_rate"), round4(F.col("n") / (2 * games)).alias("pick_rate"),
        round4(F.coalesce("bans", F.lit(0)) / games).alias("ban_rate"), tier_of(rate, F.col("baseline")).alias("tier"), ci95(F.col("n")).alias("ci95"),
    )


def cells_of_facts(facts: DataFrame) -> DataFrame:
    """The same cells from ``tallies.tier_facts``: windows over its few hundred rows stand for joins."""
    everywhere, champion = Window.partitionBy(), Window.partitionBy("champion_id")
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    rows = facts.select(
        "*", (F.sum(of("cell", "wins")).over(everywhere) / F.sum(of("cell", "n")).over(everywhere).cast("double")).alias("baseline"),
        F.max(of("match", "n")).over(everywhere).cast("double").alias("games"), F.max(of("ban", "n")).over(champion).alias("bans"),
    ).where("kind = 'cell'")
    rate = F.col("wins") / F.col("n").cast("double")
    return rows.select(
        "champion_id", "role", "n", "wins", round4(rate).alias("win_rate"), round4(F.col("n") / (2 * F.col("games"))).alias("pick_rate"),
        round4(F.coalesce("bans", F.lit(0)) / F.col("games")).alias("ban_rate"), tier_of(rate, F.col("baseline")).alias("tier"), ci95(F.col("n")).alias("ci95"),
    )


def published(rows: DataFrame, min_cell_n: int = MIN_CELL_N) -> DataFrame:
    return rows.where(F.col("n") >= min_cell_n)


def suppression_figures(min_cell_n: int = MIN_CELL_N) -> list[Column]:
    """How many cells there are, how many are published and suppressed, and the rows they hold."""
    shown = F.col("n") >= min_cell_n
    count = lambda c: F.count_if(c).cast("int")
    return [
        F.count(F.lit(1)).cast("int").alias("cells_total"), count(shown).alias("cells_published"), count(~shown).alias("cells_suppressed"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("int").alias("sum_n"), F.coalesce(F.sum(F.when(shown, F.col("n"))), F.lit(0)).cast("int").alias("sum_n_published"),
    ]


def suppression(rows: DataFrame, min_cell_n: int = MIN_CELL_N) -> DataFrame:
    """One row of these figures."""
    return rows.agg(*suppression_figures(min_cell_n))


def published_and_counted(rows: DataFrame, seen: Observation, min_cell_n: int = MIN_CELL_N) -> DataFrame:
    """The published cells; ``seen`` has the figures of ``suppression`` once they have been written, without another pass."""
    return published(rows.observe(seen, *suppression_figures(min_cell_n)), min_cell_n)


def ranked(rows: DataFrame) -> DataFrame:
    """Published order: role, falling win rate, champion; ``rank`` counts within the role."""
    order = Window.partitionBy("role").orderBy(F.col("win_rate").desc(), "champion_id")
    return rows.withColumn("rank", F.row_number().over(order)).orderBy(role_rank(F.col("role")), F.col("win_rate").desc(), "champion_id")


def top_builds(counts: DataFrame, limit: int = TOP_BUILDS) -> DataFrame:
    """The builds most played by champion, role and kind where there is one: by games, then by key; ``label`` joins the key."""
    kind = ["kind"] if "kind" in counts.columns else []
    order = Window.partitionBy("champion_id", "role", *kind).orderBy(F.col("n").desc(), "key")
    rows = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    rate = round4(F.col("wins") / F.col("n").cast("double"))
    return rows.select("champion_id", "role", "key", F.array_join("key", "-").alias("label"), "n", "wins", rate.alias("win_rate"), "rank", *kind)


def matchup_cells(counts: DataFrame) -> DataFrame:
    rate = round4(F.col("wins") / F.col("n").cast("double"))
    return counts.select("role", "champion_id", "opponent_id", "n", "wins", rate.alias("win_rate"), ci95(F.col("n")).alias("ci95"))


def matchup_axis(counts: DataFrame) -> DataFrame:
    """By role the champions that occur in any pair, suppressed pairs included, ascending."""
    named = counts.select("role", F.explode(F.array("champion_id", "opponent_id")).alias("c")).distinct()
    return named.groupBy("role").agg(F.sort_array(F.collect_list("c")).alias("champions"))


def champion_documents(shown: DataFrame, tallies: DataFrame, builds: DataFrame) -> DataFrame:
    """A document for each champion with any cell: its published roles with their builds, none if all are suppressed.

    ``builds`` has a column ``kind`` beside those of ``top_builds``.
    """
    lists = builds.groupBy("champion_id", "role").agg(*(
        F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("rank", "key", "label", "n", "wins", "win_rate")))).alias(k) for k in ("items", "runes", "spells")
    ))
    cell = shown.join(lists, ["champion_id", "role"], "left")
    stats = F.struct(role_rank(F.col("role")).alias("order"), "role", "n", "wins", "win_rate", "pick_rate", "ban_rate", "tier", "ci95", "items", "runes", "spells")
    roles = cell.groupBy("champion_id").agg(F.sort_array(F.collect_list(stats)).alias("roles"))
    return tallies.select("champion_id").distinct().join(roles, "champion_id", "left").withColumn("roles", F.coalesce("roles", F.array().cast(roles.schema["roles"].dataType)))


def newest_patch(patches: DataFrame) -> DataFrame:
    """One row: the newest patch by its numbers. A patch of another form makes the query fail."""
    checked = F.when(F.assert_true(valid_patch(F.col("patch")), F.concat(F.lit("not a patch: "), "patch")).isNull(), F.col("patch"))
    return patches.agg(F.max_by(checked, patch_order(F.col("patch"))).alias("patch"))


def choose_patch(patches: DataFrame, pinned: str | None = None) -> str:
    """The pinned patch, which must be there, or the newest."""
    if pinned is None:
        found = newest_patch(patches).first()[0]
        if found is None:
            raise ValueError("no patch in the window")
        return found
    if patches.where(F.col("patch") == pinned).isEmpty():
        raise ValueError(f"patch {pinned} is not in the window")
    return pinned


def patch_evidence_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of two patch lists that differ in any column, with both sides' figures."""
    left = a.select("patch", F.col("matches").alias("matches_a"), F.col("participant_rows").alias("rows_a"))
    right = b.select(F.col("patch").alias("patch_b"), F.col("matches").alias("matches_b"), F.col("participant_rows").alias("rows_b"))
    both = left.join(right, left["patch"].eqNullSafe(right["patch_b"]), "full")
    same = F.col("matches_a").eqNullSafe(F.col("matches_b")) & F.col("rows_a").eqNullSafe(F.col("rows_b"))
    return both.where(~same).select(F.coalesce("patch", "patch_b").alias("patch"), "matches_a", "matches_b", "rows_a", "rows_b")
