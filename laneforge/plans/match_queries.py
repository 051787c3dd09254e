"""Tier list queries: archive, extraction, tallies, policy, documents and their gates."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneforge.functions.columns import ci95, epoch_ms, minute_of, patch_of, tier_of, valid_json
from laneforge.operators import extract, gates, policy, tallies
from laneforge.plans import synth
from laneforge.plans.catalog import query
from laneforge.sources import archive, publish, schemas, shared

REGION, QUEUE, END, DAYS, PATCH = "EUW", 420, "2026-09-14", 14, "16.18"
FIRST, _ = archive.window_ending(END, DAYS)
W = synth.sql_relations()
IN_SCOPE = f"platform_id IN ('EUW', 'EUW1') AND queue_id = 420 AND CAST(game_creation AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{END}'"
USED = f"{IN_SCOPE} AND patch = '{PATCH}'"
GOOD = f"{USED} AND role IS NOT NULL AND champion_id > 0"
RATE = "round(CAST(wins AS DOUBLE) / n * 10000) / 10000"
CI = "round(0.98 / sqrt(n) * 10000) / 10000"
CELLS = W + f""", t AS (SELECT CAST(champion_id AS INT) AS champion_id, role, CAST(count(*) AS INT) AS n, CAST(sum(CASE
 WHEN win THEN 1 ELSE 0 END) AS INT) AS wins FROM p WHERE {GOOD} GROUP BY 1, 2),
bn AS (SELECT CAST(champion_id AS INT) AS champion_id, CAST(count(DISTINCT match_id) AS INT) AS bans
 FROM b WHERE {USED} AND champion_id > 0 GROUP BY 1),
w AS (SELECT count(*) AS games FROM m WHERE {USED}), base AS (SELECT CAST(sum(wins) AS DOUBLE) / sum(n) AS r FROM t),
cell AS (SELECT t.champion_id, role, n, wins, {RATE} AS win_rate, round(CAST(n AS DOUBLE) / (2.0 * games) * 10000) / 10000 AS pick_rate,
 round(CAST(coalesce(bans, 0) AS DOUBLE) / games * 10000) / 10000 AS ban_rate,
 CASE WHEN (CAST(wins AS DOUBLE) / n - r) * 100 >= 2.0 THEN 'S+' WHEN (CAST(wins AS DOUBLE) / n - r) * 100 >= 1.2 THEN 'S'
 WHEN (CAST(wins AS DOUBLE) / n - r) * 100 >= 0.6 THEN 'A'
 WHEN (CAST(wins AS DOUBLE) / n - r) * 100 >= -0.6 THEN 'B' WHEN (CAST(wins AS DOUBLE) / n - r) * 100 >= -1.5 THEN 'C'
 ELSE 'D' END AS tier, {CI} AS ci95
 FROM t LEFT JOIN bn USING (champion_id), w, base),
mu AS (SELECT a.role, CAST(a.champion_id AS INT) AS champion_id, CAST(o.champion_id AS INT) AS opponent_id,
 CAST(count(*) AS INT) AS n, CAST(sum(CASE WHEN a.win THEN 1 ELSE 0 END) AS INT) AS wins
 FROM (SELECT * FROM p WHERE {GOOD}) a JOIN (SELECT * FROM p WHERE {GOOD}) o ON a.match_id = o.match_id AND a.role = o.role AND a.team_id <> o.team_id
 WHERE a.champion_id < o.champion_id OR a.champion_id = o.champion_id AND a.team_id < o.team_id GROUP BY 1, 2, 3)
"""


class Build(shared.Owner):
    """The relations of a tier list over the derived archive, made when they are asked for.

    Days before the window are not read: a match is archived on the day that it is played or later. Of each summary the
    fields of ``schema`` are parsed, once; what is stored for all branches is a narrow row, with the parsed struct only where the
    match is in scope, or with ``facts`` what cells are made of in its place. ``whole`` takes all days and keeps all structs,
 for queries on the archive itself.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, patch: str | None = PATCH, schema: str = schemas.SUMMARY, spoil=lambda raw: raw, whole: bool = False, facts: bool = False):
        super().__init__(spark)
        self.raw, self.patch = spoil(synth.archived(spark, sf_dir, "summaries", None if whole else FIRST)), patch
        self.scope = extract.in_scope(REGION, QUEUE, END, DAYS)
        self.parsed = archive.envelope(archive.parse_summaries(self.raw, schema))
        if facts:
            self.parsed = self.parsed.withColumn("facts", F.when(extract.match_filter(self.scope, patch), tallies.match_facts())).drop("doc")
        elif not whole:
            self.parsed = self.parsed.withColumn("doc", F.when(extract.match_filter(self.scope), F.col("doc")))
        self.schema = schema

    @cached_property
    def envelopes(self) -> DataFrame:
        return archive.first_archived(self.stored(self.parsed, "parsed"), self.stored)

    @cached_property
    def window(self) -> DataFrame:
        return self.envelopes.where(extract.match_filter(self.scope))

    @cached_property
    def participants(self) -> DataFrame:
        return extract.participants(self.window) if self.schema == schemas.SUMMARY else extract.sides(self.window)

    @cached_property
    def bans(self) -> DataFrame:
        return extract.bans(self.window)

    def tallies(self) -> DataFrame:
        return tallies.cell_counts(self.participants, self.patch)

    def stats(self) -> DataFrame:
        return tallies.window_stats(self.envelopes, self.participants, self.bans, extract.match_filter(self.scope), self.patch)

    def matches(self) -> DataFrame:
        return self.envelopes.where(extract.match_filter(self.scope, self.patch)).agg(F.count_distinct("match_id").alias("matches_used"))

    def cells(self) -> DataFrame:
        return policy.cells_of_facts(tallies.tier_facts(self.window, self.patch))

    def builds(self) -> DataFrame:
        return policy.top_builds(tallies.all_build_counts(self.participants, self.patch))


def tier_list(spark: SparkSession, sf_dir: str, min_cell_n: int = 100) -> DataFrame:
    return policy.ranked(policy.published(Build(spark, sf_dir, schema=schemas.PLAYED, facts=True).cells(), min_cell_n))


query("tier_list", CELLS + """SELECT *, row_number() OVER (PARTITION BY role
 ORDER BY win_rate DESC, champion_id) AS rank FROM cell WHERE n >= 100""")(tier_list)


@query("read_archive", W + f""", a AS (SELECT k, match_id, CAST(game_creation AS DATE) + 1 AS dt
 FROM m UNION ALL SELECT k, match_id, CAST(game_creation AS DATE) + 2 FROM m
 WHERE {synth.COPY}) SELECT dt, count(*) AS rows, count(DISTINCT match_id) AS matches
 FROM a WHERE dt >= DATE '2026-09-05' GROUP BY 1""")
def read_archive(spark, sf_dir):
    rows = synth.archived(spark, sf_dir, "summaries").where(F.col("dt") >= F.lit("2026-09-05").cast("date"))
    return rows.groupBy("dt").agg(F.count("*").alias("rows"), F.count_distinct("match_id").alias("matches"))


@query("scan_with_position", "SELECT count(*) AS rows, count(*) AS places, 0::BIGINT AS first_row, count(*) - 1 AS last_row FROM orders")
def scan_with_position(spark, sf_dir):
    """Every row of a file has its own place in it."""
    rows = archive.with_position(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    return rows.agg(F.count("*").alias("rows"), F.count_distinct("part", "part_row").alias("places"), F.min("part_row").alias("first_row"), F.max("part_row").alias("last_row"))


@query("union_by_name", """SELECT o_orderkey, o_custkey, NULL::VARCHAR AS o_orderstatus
 FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_orderstatus
 FROM orders WHERE o_orderkey % 2 = 1""")
def union_by_name(spark, sf_dir):
    """Parts with different columns, put together by name."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return rows.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey").unionByName(rows.where("o_orderkey % 2 = 1").select("o_orderstatus", "o_orderkey"), allowMissingColumns=True)


@query("resolve_window", W + f""", a AS (SELECT max(CAST(game_creation AS DATE) + CASE WHEN {synth.COPY} THEN 2
 ELSE 1 END) AS last_day FROM m) SELECT last_day - {DAYS - 1} AS first_day, last_day
 FROM a""")
def resolve_window(spark, sf_dir):
    return archive.resolve_window(synth.archived(spark, sf_dir, "summaries"), DAYS)


@query("json_guard", """SELECT event_id % 6 AS planted, count(*) AS docs, count_if(coalesce(json_valid(doc), false)) AS valid
FROM (SELECT event_id, CASE event_id % 6 WHEN 1 THEN props || ' {}' WHEN 2 THEN props || '] [' || props WHEN 3 THEN left(props,
 length(props) - 1) WHEN 4 THEN ' ' || props || chr(10) WHEN 5 THEN props || '}' ELSE props END AS doc FROM events) GROUP BY 1""")
def json_guard(spark, sf_dir):
    """Payloads as they are, followed by another document, closed twice, cut off, and with space around them."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("event_id") % 6).alias("planted"), "props")
    of = lambda k, doc: F.when(F.col("planted") == k, doc)
    doc = F.coalesce(
        of(1, F.concat("props", F.lit(" {}"))), of(2, F.concat("props", F.lit("] ["), "props")), of(3, F.expr("left(props, length(props) - 1)")),
        of(4, F.concat(F.lit(" "), "props", F.lit("\n"))), of(5, F.concat("props", F.lit("}"))), F.col("props"),
    )
    return rows.groupBy("planted").agg(F.count("*").alias("docs"), F.count_if(valid_json(doc)).alias("valid"))


@query("envelope", W + "SELECT match_id, game_version, platform_id, CAST(queue_id AS INT) AS queue_id, game_creation_ms, 10 AS participants FROM m")
def envelope(spark, sf_dir):
    return Build(spark, sf_dir, whole=True).envelopes.select("match_id", "game_version", "platform_id", "queue_id", "game_creation_ms", "participants")


@query("summary_envelope", W + """SELECT match_id, region, patch, platform_id, CAST(queue_id AS INT) AS queue_id,
 game_duration_s, 'GameComplete' AS end_of_game_result, true AS payload_valid
 FROM m""")
def summary_envelope(spark, sf_dir):
    told = shared.stored(archive.summary_envelope(archive.parse_summaries(synth.archived(spark, sf_dir, "summaries"), schemas.SEATED)).drop("doc"), "parsed")
    rows = archive.first_archived(told)
    return rows.select("match_id", "region", "patch", "platform_id", "queue_id", "game_duration_s", "end_of_game_result", "payload_valid")


@query("dedup_first_archived", W + f"SELECT 'first' AS kept, count(*) AS rows, count_if(win) AS wins FROM p WHERE participant_id = 1")
def dedup_first_archived(spark, sf_dir):
    rows = Build(spark, sf_dir, schema=schemas.PLAYED, whole=True).envelopes.select(F.lit("first").alias("kept"), F.get("doc.info.participants", F.lit(0))["win"].cast("boolean").alias("win"))
    return rows.groupBy("kept").agg(F.count("*").alias("rows"), F.count_if("win").alias("wins"))


@query("participants", W + f"""SELECT match_id, game_version, platform_id, CAST(queue_id AS INT) AS queue_id,
 game_creation, patch, CAST(champion_id AS INT) AS champion_id, role, win, CAST(team_id AS INT) AS team_id,
 {', '.join(f'CAST(item{s} AS INT) AS item{s}' for s in range(7))}, CAST(summoner1_id AS INT) AS summoner1_id,
 CAST(summoner2_id AS INT) AS summoner2_id, array_to_string(rune_style, '-') AS rune_style
 FROM p WHERE {IN_SCOPE}""")
def participants(spark, sf_dir):
    return Build(spark, sf_dir).participants.withColumn("rune_style", F.array_join("rune_style", "-"))


@query("bans", W + f"SELECT match_id, patch, CAST(champion_id AS INT) AS champion_id FROM b WHERE {IN_SCOPE} AND champion_id > 0")
def bans(spark, sf_dir):
    return Build(spark, sf_dir).bans


@query("participant_ids", W + f""", q AS (SELECT match_id, {synth.H} % 5000 AS u
 FROM p) SELECT match_id, count(DISTINCT u) AS players, sum(DISTINCT u)::BIGINT AS total
 FROM q GROUP BY 1""")
def participant_ids(spark, sf_dir):
    rows = extract.participant_ids(Build(spark, sf_dir, schema=schemas.NAMED, whole=True).envelopes).select("match_id", F.explode("puuids").alias("u"))
    return rows.groupBy("match_id").agg(F.count("*").alias("players"), F.sum(F.substring("u", 2, 9).cast("bigint")).alias("total"))


@query("normalize_role", W + "SELECT team_position, individual_position, role, count(*) AS n FROM p GROUP BY 1, 2, 3")
def normalize_role(spark, sf_dir):
    told = shared.stored(archive.summary_envelope(archive.parse_summaries(synth.archived(spark, sf_dir, "summaries"), schemas.SEATED)), "parsed")
    rows = extract.summary_participants(archive.first_archived(told))
    return rows.groupBy("team_position", "individual_position", "role").agg(F.count("*").alias("n"))


@query("patch_of", W + "SELECT game_version, patch, count(*) AS n FROM m GROUP BY 1, 2")
def patches_of(spark, sf_dir):
    return Build(spark, sf_dir, whole=True).envelopes.select("game_version", patch_of(F.col("game_version")).alias("patch")).groupBy("game_version", "patch").agg(F.count("*").alias("n"))


@query("minute_of", "SELECT CAST(floor((epoch_ms(ts) % 3600000) / 60000.0) AS INT) AS minute, count(*) AS n FROM events GROUP BY 1")
def minutes_of(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    ms = epoch_ms(F.col("ts"), rows.schema["ts"].dataType.typeName() == "timestamp") % 3600000
    return rows.groupBy(minute_of(ms).alias("minute")).agg(F.count("*").alias("n"))


@query("sha256_check", W + f"""SELECT count(*) + count_if({synth.COPY}) AS rows, count_if(k % 9 = 0) + count_if(k % 9 = 0 AND {synth.COPY}) AS damaged FROM m""")
def sha256_check(spark, sf_dir):
    """An archive in which payloads were cut off after they were hashed."""
    raw = cut_off(synth.archived(spark, sf_dir, "summaries"))
    bad = archive.damaged(raw).agg(F.count("*").alias("damaged"))
    return raw.agg(F.count("*").alias("rows")).crossJoin(bad)  # one row each


@query("scope_filter", W + f"SELECT platform_id, CAST(queue_id AS INT) AS queue_id, count(*) AS matches FROM m WHERE {IN_SCOPE} GROUP BY 1, 2")
def scope_filter(spark, sf_dir):
    return Build(spark, sf_dir).window.groupBy("platform_id", "queue_id").agg(F.count("*").alias("matches"))


@query("carry_payload", W + f"SELECT match_id, 10::INT AS participants FROM m WHERE {USED}")
def carry_payload(spark, sf_dir):
    raw = synth.archived(spark, sf_dir, "summaries", FIRST)
    held = archive.carry_payload(raw, extract.match_filter(extract.in_scope(REGION, QUEUE, END, DAYS), PATCH), schemas.PLAYED)
    return held.select("match_id", F.json_array_length(F.get_json_object("payload", "$.info.participants")).alias("participants"))


query("rune_key", W + f"SELECT array_to_string(rune_style, '-') AS rune_key, count(*) AS n FROM p WHERE {IN_SCOPE} GROUP BY 1")(
    lambda spark, sf_dir: Build(spark, sf_dir).participants.groupBy(F.array_join("rune_style", "-").alias("rune_key")).agg(F.count("*").alias("n"))
)
query("feature_filter", W + f"SELECT role, count(*) AS n, count(DISTINCT match_id) AS matches FROM p WHERE {GOOD} GROUP BY 1")(
    lambda spark, sf_dir: Build(spark, sf_dir).participants.where(extract.classified(PATCH)).groupBy("role").agg(F.count("*").alias("n"), F.count_distinct("match_id").alias("matches"))
)


@query("match_filter", W + f"SELECT match_id FROM m WHERE {USED}")
def match_filter(spark, sf_dir):
    b = Build(spark, sf_dir)
    return b.envelopes.where(extract.match_filter(b.scope, PATCH)).select("match_id")


@query("tier_for_rate", """SELECT l_linenumber::BIGINT AS line, (l_quantity * 2)::BIGINT AS games, CASE WHEN d * 100 >= 2.0 THEN 'S+'
 WHEN d * 100 >= 1.2 THEN 'S' WHEN d * 100 >= 0.6 THEN 'A' WHEN d * 100 >= -0.6 THEN 'B' WHEN d * 100 >= -1.5 THEN 'C'
 ELSE 'D' END AS tier, round(0.98 / sqrt(CAST((l_quantity * 2)::BIGINT AS DOUBLE)) * 10000) / 10000 AS ci95,
 count(*) AS n FROM (SELECT *, CAST(l_discount AS DOUBLE) - 0.05 AS d FROM lineitem)
 GROUP BY 1, 2, 3, 4""")
def tier_for_rate(spark, sf_dir):
    """Tiers and intervals of lines, with the discount for a rate and the quantity for games."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_linenumber").cast("bigint").alias("line"), (F.col("l_quantity") * 2).cast("bigint").alias("games"), F.col("l_discount").cast("double").alias("rate"))
    graded = rows.select("line", "games", tier_of(F.col("rate"), F.lit(0.05)).alias("tier"), ci95(F.col("games")).alias("ci95"))
    return graded.groupBy("line", "games", "tier", "ci95").agg(F.count("*").alias("n"))


query("cell_counts", CELLS + "SELECT * FROM t")(lambda spark, sf_dir: Build(spark, sf_dir).tallies())
query("ban_counts", CELLS + "SELECT * FROM bn")(lambda spark, sf_dir: tallies.ban_counts(Build(spark, sf_dir).bans, PATCH))
KEYS = {
    "items": ("list_value(item0, item1, item2, item3, item4, item5, item6)", "greatest(item0, item1, item2, item3, item4, item5) > 0"),
    "runes": ("rune_style", "rune_style IS NOT NULL"),
    "spells": ("list_value(summoner1_id, summoner2_id)", "summoner1_id > 0 AND summoner2_id > 0"),
}
for _kind, (_key, _there) in KEYS.items():
    query(f"build_counts_{_kind}", W + f"""SELECT CAST(champion_id AS INT) AS champion_id, role, array_to_string({_key},
 '-') AS key, CAST(count(*) AS INT) AS n, CAST(sum(CASE WHEN win THEN 1 ELSE 0 END) AS INT) AS wins
 FROM p WHERE {GOOD} AND {_there} GROUP BY 1, 2, 3""")(
        lambda spark, sf_dir, kind=_kind: tallies.build_counts(Build(spark, sf_dir).participants, kind, PATCH).withColumn("key", F.array_join("key", "-"))
    )
SIDES = """, s AS MATERIALIZED (SELECT match_id, role, max(CASE WHEN team_id = 100 THEN champion_id END) AS c1,
 max(CASE WHEN team_id = 200 THEN champion_id END) AS c2,
 max(CASE WHEN team_id = 100 THEN CAST(win AS INT) END) AS w1, max(CASE WHEN team_id = 200 THEN CAST(win AS INT) END) AS w2
 FROM p WHERE {} GROUP BY 1, 2)
SELECT match_id, role, CAST(least(c1, c2) AS INT) AS champion_id, CAST(greatest(c1, c2) AS INT) AS opponent_id,
 CASE WHEN c1 <= c2 THEN w1 ELSE w2 END = 1 AS win
FROM s WHERE c1 IS NOT NULL AND c2 IS NOT NULL"""  # a team has one player of a role
query("matchups", W + SIDES.format(GOOD))(lambda spark, sf_dir: tallies.matchups(Build(spark, sf_dir, schema=schemas.PAIRED).participants, PATCH))


def cut_off(raw: DataFrame) -> DataFrame:
    """The archive with the payloads of one match in nine cut off."""
    number = F.substring("match_id", 6, 10).cast("bigint")
    return raw.withColumn("payload", F.when(number % 9 == 0, F.substring("payload", 1, 100)).otherwise(F.col("payload")))


def without_ids(raw: DataFrame) -> DataFrame:
    """The archive with the payloads of one match in eight without a match id."""
    number = F.substring("match_id", 6, 10).cast("bigint")
    return raw.withColumn("payload", F.when(number % 8 == 0, F.regexp_replace("payload", '"matchId":"[^"]*"', '"id":""')).otherwise(F.col("payload")))


@query("matchups_without_ids", W + SIDES.format(f"{GOOD} AND k % 8 <> 0"))
def matchups_without_ids(spark, sf_dir):
    """Summaries that lack an id are of no match, so their players meet nobody."""
    return tallies.matchups(Build(spark, sf_dir, schema=schemas.PAIRED, spoil=without_ids).participants, PATCH)


query("matchup_counts", CELLS + "SELECT * FROM mu")(lambda spark, sf_dir: tallies.matchup_counts(Build(spark, sf_dir, schema=schemas.PAIRED).participants, PATCH))
PATCHES = W + f"SELECT patch, CAST(count(*) AS INT) AS matches, CAST(10 * count(*) AS INT) AS participant_rows FROM m WHERE {IN_SCOPE} GROUP BY 1"
query("patch_list", PATCHES)(lambda spark, sf_dir: tallies.patch_list(Build(spark, sf_dir).participants))


@query("envelope_patch_list", PATCHES)
def envelope_patch_list(spark, sf_dir):
    b = Build(spark, sf_dir)
    return tallies.envelope_patch_list(b.envelopes, extract.match_filter(b.scope))


@query("patch_evidence_diff", W + f""", a AS (SELECT patch, CAST(count(DISTINCT match_id) AS INT) AS matches_a,
 CAST(count(*) AS INT) AS rows_a FROM p WHERE {IN_SCOPE} AND champion_id <> 1
 GROUP BY 1),
b2 AS (SELECT patch, CAST(count(*) AS INT) AS matches_b, CAST(10 * count(*) AS INT) AS rows_b FROM m WHERE {IN_SCOPE} GROUP BY 1)
SELECT patch, matches_a, matches_b, rows_a, rows_b FROM a FULL JOIN b2 USING (patch)
 WHERE matches_a IS DISTINCT FROM matches_b OR rows_a IS DISTINCT FROM rows_b""")
def patch_evidence_diff(spark, sf_dir):
    """Participants of which a champion is missing, against the envelopes."""
    b = Build(spark, sf_dir)
    return policy.patch_evidence_diff(tallies.patch_list(b.participants.where("champion_id <> 1")), tallies.envelope_patch_list(b.envelopes, extract.match_filter(b.scope)))


@query("newest_patch", W + f"SELECT '16.' || max(CAST(split_part(patch, '.', 2) AS INT)) AS patch FROM m WHERE {IN_SCOPE}")
def newest_patch(spark, sf_dir):
    b = Build(spark, sf_dir)
    return policy.newest_patch(tallies.envelope_patch_list(b.envelopes, extract.match_filter(b.scope)))


query("archive_stats", W + f"""SELECT CAST(count(*) + count_if(k % 9 = 0 AND {synth.COPY}) AS INT) AS archive_rows,
 CAST(count_if(k % 9 = 0) + count_if(k % 9 = 0 AND {synth.COPY}) AS INT) AS malformed_rows
 FROM m""")(lambda spark, sf_dir: tallies.archive_stats(Build(spark, sf_dir, spoil=cut_off, whole=True).envelopes))
STATS = W + f""", ps AS (SELECT * FROM p WHERE {USED}) SELECT (SELECT CAST(count(*) AS INT)
 FROM m WHERE {USED}) AS matches_used, (SELECT CAST(count(*) AS INT) FROM ps) AS participant_rows, (SELECT CAST(count(*) AS INT)
 FROM ps WHERE role IS NULL OR champion_id <= 0) AS rejected_rows, (SELECT CAST(count(*) AS INT)
 FROM b WHERE {IN_SCOPE} AND champion_id > 0) AS ban_rows"""
query("window_stats", STATS)(lambda spark, sf_dir: Build(spark, sf_dir).stats())
query("baseline_win_rate", CELLS + "SELECT r AS baseline FROM base")(lambda spark, sf_dir: tallies.baseline(Build(spark, sf_dir).tallies()))


@query("cells", CELLS + "SELECT * FROM cell")
def cells(spark, sf_dir):
    """From separate tallies, bans and matches."""
    b = Build(spark, sf_dir)
    return policy.cells(b.tallies(), tallies.ban_counts(b.bans, b.patch), b.matches())


query("suppress", CELLS + """SELECT CAST(count(*) AS INT) AS cells_total, CAST(count_if(n >= 100) AS INT) AS cells_published,
 CAST(count_if(n < 100) AS INT) AS cells_suppressed, CAST(sum(n) AS INT) AS sum_n, CAST(coalesce(sum(n) FILTER (n >= 100),
 0) AS INT) AS sum_n_published FROM cell""")(
    lambda spark, sf_dir: policy.suppression(Build(spark, sf_dir).tallies())
)
TOP = """SELECT champion_id, role, kind, label, n, wins, rank FROM (SELECT *, row_number() OVER (PARTITION BY champion_id,
 role, kind ORDER BY n DESC, key) AS rank, array_to_string(key, '-') AS label
 FROM ({})) WHERE rank <= 10"""
COUNTED = " UNION ALL ".join(f"""SELECT CAST(champion_id AS INT) AS champion_id, role, '{kind}' AS kind, CAST({key} AS INT[]) AS key,
 CAST(count(*) AS INT) AS n, CAST(sum(CASE WHEN win THEN 1 ELSE 0 END) AS INT) AS wins
 FROM p WHERE {GOOD} AND {there} GROUP BY 1, 2, 3, 4""" for kind, (key, there) in KEYS.items())
query("top_builds", W + TOP.format(COUNTED))(lambda spark, sf_dir: Build(spark, sf_dir).builds().select("champion_id", "role", "kind", "label", "n", "wins", "rank"))
query("matchup_matrix", CELLS + f"SELECT role, champion_id, opponent_id, n, wins, {RATE} AS win_rate, {CI} AS ci95 FROM mu WHERE n >= 5")(
    lambda spark, sf_dir: policy.published(policy.matchup_cells(tallies.matchup_counts(Build(spark, sf_dir, schema=schemas.PAIRED).participants, PATCH)), 5)
)
query("matchup_axis", CELLS + """SELECT role, array_to_string(list_sort(list(DISTINCT c)), ',') AS champions
 FROM (SELECT role, champion_id AS c FROM mu UNION ALL SELECT role, opponent_id
 FROM mu) GROUP BY 1""")(
    lambda spark, sf_dir: policy.matchup_axis(tallies.matchup_counts(Build(spark, sf_dir, schema=schemas.PAIRED).participants, PATCH)).withColumn("champions", F.array_join("champions", ","))
)


LISTED = ", ".join(f"string_agg(label || ':' || n || ':' || wins, ',' ORDER BY rank) FILTER (WHERE kind = '{k}') AS {k}" for k in KEYS)
SHOWN = "role, n, wins, win_rate, pick_rate, ban_rate, tier, ci95"


@query("champion_builds", CELLS + f""", tb AS ({TOP.format(COUNTED)}), bl AS (SELECT champion_id, role, {LISTED} FROM tb GROUP BY 1, 2)
SELECT champion_id, {SHOWN}, items, runes, spells FROM (SELECT DISTINCT champion_id
 FROM cell) c LEFT JOIN (SELECT * FROM cell WHERE n >= 100) s USING (champion_id)
 LEFT JOIN bl USING (champion_id, role)""")
def champion_builds(spark, sf_dir):
    """Every document whole, a row for each of its roles; a champion without a published role has one row of nulls."""
    b = Build(spark, sf_dir)
    found = b.cells()
    docs = policy.champion_documents(policy.published(found), found, b.builds()).select("champion_id", F.explode_outer("roles").alias("r"))
    listed = lambda kind: F.array_join(F.transform(F.col("r")[kind], lambda x: F.concat_ws(":", x["label"], x["n"].cast("string"), x["wins"].cast("string"))), ",")
    return docs.select("champion_id", *(F.col("r")[c].alias(c) for c in SHOWN.split(", ")), *(F.nullif(listed(k), F.lit("")).alias(k) for k in KEYS))


# ---- gates, over relations with faults -----------------------------------------------------


@query("gate_input", W + f""", s AS (SELECT count(*) AS n, count_if(role IS NULL OR champion_id <= 0) AS bad FROM p WHERE {USED} AND k % 9 <> 0)
SELECT 'malformed_archive' AS reason WHERE (SELECT count(*) FROM m WHERE k % 9 = 0 AND CAST(game_creation AS DATE) + 1 >= DATE '{FIRST}') > 0
UNION ALL SELECT 'empty_window' FROM s WHERE n - bad = 0 UNION ALL SELECT 'rejected_rows' FROM s WHERE bad > ceil(0.0002 * n)""")
def gate_input(spark, sf_dir):
    b = Build(spark, sf_dir, spoil=cut_off)
    return gates.input_gate(tallies.archive_stats(b.envelopes), b.stats(), gates.GateConfig(max_rejected_rate=0.0002))


@query("gate_output", CELLS + """SELECT 'no_published_cells' AS reason FROM t WHERE champion_id % 2 = 0 HAVING count(*) > 0
UNION ALL SELECT 'reconciliation' FROM t HAVING sum(n) FILTER (champion_id % 2 = 0) <> sum(n)""")
def gate_output(spark, sf_dir):
    """Half of the tallies, and a floor that none reaches."""
    b = Build(spark, sf_dir)
    return gates.output_gate(policy.suppression(b.tallies().where("champion_id % 2 = 0"), 10**9), b.stats())


WRONG_ROLE, WRONG_WINS = "CASE WHEN champion_id % 11 = 0 THEN 'NONE' ELSE role END", "CASE WHEN champion_id % 7 = 0 THEN n + 1 ELSE wins END"


@query("gate_tallies", CELLS + f"""SELECT champion_id, {WRONG_ROLE} AS role, n, {WRONG_WINS} AS wins
 FROM t WHERE champion_id % 11 = 0 OR champion_id % 7 = 0""")
def gate_tallies(spark, sf_dir):
    return gates.tally_sanity(Build(spark, sf_dir).tallies().withColumns({"role": F.expr(WRONG_ROLE), "wins": F.expr(WRONG_WINS)}))


@query("verify_cells", CELLS + """SELECT role, champion_id, problem FROM cell, (VALUES ('win_rate'), ('tier'), ('floor')) v(problem)
WHERE n >= 20 AND (problem = 'win_rate' AND champion_id % 7 = 0 OR problem = 'tier' AND champion_id % 5 = 0 OR problem = 'floor' AND n < 100)""")
def verify_cells(spark, sf_dir):
    """Cells from a lower floor, some with another rate or an unknown tier."""
    cells = policy.published(Build(spark, sf_dir).cells(), 20)
    return gates.verify_cells(cells.withColumns({"win_rate": F.expr("CASE WHEN champion_id % 7 = 0 THEN win_rate + 0.001 ELSE win_rate END"), "tier": F.expr("CASE WHEN champion_id % 5 = 0 THEN 'Z' ELSE tier END")}))


@query("verify_order", CELLS + """, o AS (SELECT *, CASE tier WHEN 'S+' THEN 1 WHEN 'S' THEN 2 WHEN 'A' THEN 3
 WHEN 'B' THEN 4 WHEN 'C' THEN 5 ELSE 6 END AS tr FROM cell WHERE n >= 20),
q AS (SELECT *, lead(win_rate) OVER w AS before, lead(tr) OVER w AS tier_before
 FROM o WINDOW w AS (PARTITION BY role ORDER BY win_rate DESC, champion_id))
SELECT role, champion_id, problem FROM q, (VALUES ('rate_order'), ('tier_order')) v(problem)
 WHERE problem = 'rate_order' AND win_rate > before OR problem = 'tier_order' AND tr < tier_before""")
def verify_order(spark, sf_dir):
    """The published order turned round."""
    return gates.verify_order(policy.ranked(policy.published(Build(spark, sf_dir).cells(), 20)).withColumn("rank", -F.col("rank")))


@query("verify_builds", CELLS + f""", tb AS ({TOP.format(COUNTED)}) SELECT champion_id, role, kind, CAST(rank AS INT) AS rank,
 problem FROM tb, (VALUES ('key_length'), ('too_many_games')) v(problem)
WHERE problem = 'key_length' AND kind = 'runes' AND champion_id % 4 = 0 OR problem = 'too_many_games' AND champion_id % 6 = 0""")
def verify_builds(spark, sf_dir):
    """Builds, some with a short key or too many games."""
    b = Build(spark, sf_dir)
    key = F.when((F.col("kind") == "runes") & (F.col("champion_id") % 4 == 0), F.slice("key", 1, 5)).otherwise(F.col("key"))
    return gates.verify_builds(b.builds().withColumns({"key": key, "n": F.when(F.col("champion_id") % 6 == 0, F.col("n") + 1_000_000).otherwise(F.col("n"))}), b.cells())


@query("verify_matchups", CELLS + """, s AS (SELECT role, CASE WHEN champion_id % 5 = 0 THEN opponent_id ELSE champion_id END AS champion_id,
 CASE WHEN champion_id % 5 = 0 THEN champion_id ELSE opponent_id END AS opponent_id
 FROM mu WHERE n >= 5)
SELECT role, champion_id, opponent_id, problem FROM s, (VALUES ('order'), ('axis')) v(problem)
 WHERE problem = 'order' AND champion_id > opponent_id OR problem = 'axis' AND (champion_id = 3 OR opponent_id = 3)""")
def verify_matchups(spark, sf_dir):
    """Pairs, some turned round, and an axis that lacks a champion."""
    counts = shared.stored(tallies.matchup_counts(Build(spark, sf_dir, schema=schemas.PAIRED).participants, PATCH))
    turned = F.col("champion_id") % 5 == 0
    shown = policy.published(policy.matchup_cells(counts), 5).withColumns({"champion_id": F.when(turned, F.col("opponent_id")).otherwise(F.col("champion_id")), "opponent_id": F.when(turned, F.col("champion_id")).otherwise(F.col("opponent_id"))})
    axis = policy.matchup_axis(counts).withColumn("champions", F.array_except("champions", F.array(F.lit(3))))
    return gates.verify_matchups(shown, axis, 5)


MANIFEST = W + """, r AS (SELECT patch, platform_id AS region, queue_id AS queue, 'all' AS bracket, min(CAST(game_creation AS DATE)) AS first_day,
 max(CAST(game_creation AS DATE)) AS last_day, count(*) AS matches FROM m
 GROUP BY 1, 2, 3)"""


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a manifest would list: the derived archive's patches, platforms and queues."""
    rows = Build(spark, sf_dir, whole=True).envelopes.select(patch_of(F.col("game_version")).alias("patch"), F.col("platform_id").alias("region"), F.col("queue_id").alias("queue"), F.lit("all").alias("bracket"), F.to_date(F.timestamp_millis("game_creation_ms")).alias("day"))
    return rows.groupBy(*publish.PARTITION).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("matches"))


@query("manifest", MANIFEST + " SELECT patch, region, CAST(queue AS INT) AS queue, bracket, first_day, last_day, matches FROM r")
def manifest(spark, sf_dir):
    """Two builds of each partition in one log; the later one stands."""
    rows = partitions(spark, sf_dir)
    log = rows.withColumn("matches", F.lit(0).cast("bigint")).withColumn("built_at", F.lit(1)).unionByName(rows.withColumn("built_at", F.lit(2)))
    return publish.manifest(log).drop("built_at")


@query("latest_partition", MANIFEST + """ SELECT patch, region, CAST(queue AS INT) AS queue, bracket, first_day,
 last_day, matches FROM r WHERE patch = '16.18' AND region = 'NA1' AND queue = 440""")
def latest_partition(spark, sf_dir):
    rows = partitions(spark, sf_dir)
    return publish.latest_partition(rows, rows.where("region = 'NA1' AND queue = 440 AND patch = '16.18'"))


@query("verify_manifest", MANIFEST + """ SELECT patch, region, CAST(queue AS INT) AS queue, bracket, 'unlisted' AS problem
 FROM r WHERE patch = '16.16'""")
def verify_manifest(spark, sf_dir):
    rows = partitions(spark, sf_dir)
    return gates.verify_manifest(rows.where("patch <> '16.16'"), rows)
