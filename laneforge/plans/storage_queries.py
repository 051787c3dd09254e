"""Queries that write with the real writers, read back with the real readers, and compare."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneforge.operators import documents, gates, tallies
from laneforge.plans import control_queries, synth  # noqa: F401  the names of champions are a query of the former
from laneforge.plans.catalog import QUERIES, query
from laneforge.plans.match_queries import CELLS, END, FIRST, MANIFEST, PATCH, Build, partitions
from laneforge.plans.timeline_queries import PAIRS, Dataset
from laneforge.sources import archive, parts, publish, shared
from laneforge.streaming import archive as stream

W = synth.sql_relations()


@query("read_jsonl_payloads", W + f"""SELECT (SELECT count(*) FROM m) + (SELECT count(*)
 FROM m WHERE {synth.COPY}) AS rows, (SELECT count(*) FROM m) AS matches""")
def read_jsonl_payloads(spark, sf_dir):
    """Payloads as lines of compressed text files, with empty lines between them; they are written as they are made, without an archive beside them."""
    path = shared.scratch(spark, "lines")
    made = synth.summaries(spark, sf_dir).select(F.explode(F.array("payload", F.lit(""))).alias("line"))
    made.write.option("compression", "gzip").text(path)
    found = archive.read_jsonl(spark, path)
    return found.agg(F.count("*").alias("rows"), F.count_distinct(F.get_json_object("payload", "$.metadata.matchId")).alias("matches"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    day = F.date_add(F.lit("2026-09-01").cast("date"), (key % 3).cast("int"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", day.alias("dt"), F.when(key % 2 == 0, "EUW").otherwise("NA").alias("region"))


@query("read_ladder_pages", """SELECT DATE '2026-09-01' + CAST(c_custkey % 3 AS INT) AS dt, CASE WHEN c_custkey % 2 = 0 THEN 'EUW'
 ELSE 'NA' END AS region, count(DISTINCT c_custkey // 60) AS pages, count(*) AS entries
 FROM customer GROUP BY 1, 2""")
def read_ladder_pages(spark, sf_dir):
    """Pages of up to ten entries, partitioned by date and region; pages of one date number themselves in 32 bits, others in 64."""
    root = shared.scratch(spark, "archive")
    page = F.floor(F.col("c_custkey") / 60)
    pages = customers(spark, sf_dir).groupBy("dt", "region", page.alias("page")).agg(F.to_json(F.collect_list(F.struct(F.col("c_name").alias("puuid")))).alias("payload"))
    rows = pages.withColumns({"tier": F.lit("GOLD"), "division": F.lit("I")}).repartition("dt", "region")
    first = F.lit("2026-09-01").cast("date")
    rows.where(F.col("dt") == first).withColumn("page", F.col("page").cast("int")).write.partitionBy("dt", "region").parquet(f"{root}/league-v4")
    rows.where(F.col("dt") != first).write.mode("append").partitionBy("dt", "region").parquet(f"{root}/league-v4")
    found = archive.read_ladder_pages(spark, root)
    return found.groupBy("dt", "region").agg(F.count_distinct("page").alias("pages"), F.sum(F.json_array_length("payload")).cast("bigint").alias("entries"))


@query("read_accounts", """SELECT DATE '2026-09-01' + CAST(c_custkey % 3 AS INT) AS dt, count(*) AS accounts,
 count_if(c_custkey % 3 > 0) AS tagged FROM customer GROUP BY 1""")
def read_accounts(spark, sf_dir):
    """Accounts by date; parts of the first date lack a column, which is null there."""
    root = shared.scratch(spark, "archive")
    rows = customers(spark, sf_dir).select("dt", F.col("c_name").alias("puuid"), F.col("c_custkey").cast("string").alias("tag_line"))
    first = F.lit("2026-09-01").cast("date")
    rows.where(F.col("dt") == first).drop("tag_line").repartition("dt").write.partitionBy("dt").parquet(f"{root}/account-v1")
    rows.where(F.col("dt") != first).repartition("dt").write.mode("append").partitionBy("dt").parquet(f"{root}/account-v1")
    return archive.read_accounts(spark, root).groupBy("dt").agg(F.count("*").alias("accounts"), F.count("tag_line").alias("tagged"))


@query("read_static_documents", """SELECT CASE WHEN p_partkey % 2 = 0 THEN 'champion' ELSE 'item' END AS kind,
 count(*) AS documents FROM part GROUP BY 1""")
def read_static_documents(spark, sf_dir):
    root = shared.scratch(spark, "archive")
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.when(F.col("p_partkey") % 2 == 0, "champion").otherwise("item").alias("kind"), F.lit("2026-09-01").cast("date").alias("dt"), F.to_json(F.struct("p_name")).alias("payload"))
    rows.repartition("kind").write.partitionBy("dt", "kind").parquet(f"{root}/ddragon")
    return archive.read_static_documents(spark, root).groupBy("kind").agg(F.count("*").alias("documents"))


WRITTEN = f""", pr AS ({PAIRS}), t AS (SELECT 'match_index' AS table_name, count(*) AS rows
 FROM idx UNION ALL SELECT 'events', count(*) FROM e UNION ALL SELECT 'match_objectives', count(*)
 FROM ok
 UNION ALL SELECT 'participant_minutes', count(*) FROM f UNION ALL SELECT 'lane_matchups', count(*)
 FROM pr UNION ALL SELECT 'participant_early', 10 * count(*) FROM ok)"""


@query("write_features", W + WRITTEN + " SELECT table_name, rows, rows AS rows_read FROM t")
def write_features(spark, sf_dir):
    """The six tables written after their columns are checked: the rows counted on the way, and those of the files."""
    root = shared.scratch(spark, "features")
    with Dataset(spark, sf_dir) as d:
        counted = publish.write_features(d.tables(), root)
    found = gates.table_row_counts({name: spark.read.parquet(f"{root}/{name}") for name in counted})
    told = F.create_map(*(F.lit(x) for item in counted.items() for x in item))
    return found.select("table_name", told[F.col("table_name")].cast("bigint").alias("rows"), F.col("rows").alias("rows_read"))


DRIFT = {"whole": [], "short": [("frame_count", "missing", None, "int")], "wide": [("queue_id", "type", "bigint", "int")], "turned": [("match_id", "order", "string", "string")], "more": [("note", "unknown", "int", None)]}
_cell = lambda x: "NULL::VARCHAR" if x is None else f"'{x}'"
_faults = ", ".join(f"('{name}', {', '.join(map(_cell, fault))})" for name, faults in DRIFT.items() for fault in faults)


@query("schema_drift", f"SELECT * FROM (VALUES {_faults}) t(written, \"column\", problem, found, wanted) WHERE (SELECT count(*) FROM orders) > 0")
def schema_drift(spark, sf_dir):
    """The ledger written as specified and with faults of four kinds, each found in the footers of its parts."""
    root = shared.scratch(spark, "drift")
    with Dataset(spark, sf_dir, ledger_only=True) as d:
        forms = {
            "whole": d.index, "short": d.index.drop("frame_count"), "wide": d.index.withColumn("queue_id", F.col("queue_id").cast("bigint")),
            "turned": d.index.select(*d.index.columns[1:], "match_id"), "more": d.index.withColumn("note", F.lit(1)),
        }
        for name, df in forms.items():
            df.write.parquet(f"{root}/{name}")
    found = parts.drifted(parts.part_columns(spark, root), "match_index")
    return found.select(F.regexp_extract("part", "/([a-z]+)/[^/]*$", 1).alias("written"), "column", "problem", "found", "wanted").distinct()


@query("write_tallies", CELLS + "SELECT * FROM t")
def write_tallies(spark, sf_dir):
    path, rows = shared.scratch(spark, "tallies"), Build(spark, sf_dir).tallies()
    publish.write_tallies(rows, path)
    return spark.read.schema(rows.schema).json(path)


def entry(patch: str, built_at: int, region: str = "EUW") -> dict:
    """A manifest's entry for a build made on a day of September."""
    first, last = (dt.date.fromisoformat(d) for d in (FIRST, END))
    return {"patch": patch, "region": region, "queue": 420, "bracket": "all", "built_at": dt.datetime(2026, 9, built_at), "first_day": first, "last_day": last, "source": "demo"}


class Parts:
    """What documents are assembled of, over the derived archive, each stored once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        with Build(spark, sf_dir) as b:
            self.cells, self.builds = shared.stored(b.cells()), shared.stored(b.builds())
            self.pairs = shared.stored(tallies.matchup_counts(b.participants, PATCH))
        self.names = QUERIES["static_dictionary"](spark, sf_dir)

    def documents(self, entry: dict, least_n: int = 1, only: str = "true") -> dict[str, DataFrame]:
        return documents.assembled(self.cells.where(only), self.builds.where(only), self.pairs, self.names, entry, least_n)


def told(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """What a reader finds by a manifest: its entries, with the documents and cells of each kind."""
    entries = publish.read_manifest(spark, root, number)
    of = {kind: publish.read_documents(spark, root, kind, entries) for kind in publish.KINDS}
    cells = of["tier_list"].groupBy("build").agg(F.sum(F.size("cells")).alias("cells"))
    pages = of["champions"].groupBy("build").agg(F.count("*").alias("champions"))
    roles = of["matchups"].groupBy("build").agg(F.count("*").alias("roles"))
    out = entries.join(cells, "build", "left").join(pages, "build", "left").join(roles, "build", "left")
    return out.select(*publish.PARTITION, F.dayofmonth("built_at").alias("built_at"), "cells", "champions", "roles")


COUNTED = "count(*) AS cells, count(DISTINCT champion_id) AS champions, (SELECT count(DISTINCT role) FROM mu) AS roles"


@query("publish_partition", CELLS + f"""SELECT '{PATCH}' AS patch, 'EUW' AS region, 420::INT AS queue, 'all' AS bracket,
 2::INT AS built_at, {COUNTED} FROM cell UNION ALL SELECT '16.1', 'EUW', 420, 'all', 1, {COUNTED}
 FROM cell WHERE champion_id <= 10""")
def publish_partition(spark, sf_dir):
    """One partition published twice and another once: what the last manifest lists, with the documents that it names."""
    root, made = shared.scratch(spark, "published"), Parts(spark, sf_dir)
    for patch, built_at, only in ((PATCH, 1, "champion_id > 10"), ("16.1", 1, "champion_id <= 10"), (PATCH, 2, "true")):
        of = entry(patch, built_at)
        publish.publish_partition(made.documents(of, only=only), root, of)
    return told(spark, root)


@query("republish", CELLS + f"""SELECT moment, {PATCH} AS patch, built_at, cells, champions FROM (
SELECT 'before' AS moment, 1 AS built_at, count(*) AS cells, count(DISTINCT champion_id) AS champions FROM cell WHERE champion_id <= 10
UNION ALL SELECT 'reader of before', 1, count(*), count(DISTINCT champion_id) FROM cell WHERE champion_id <= 10
UNION ALL SELECT 'after', 2, count(*), count(DISTINCT champion_id) FROM cell
 UNION ALL SELECT 'after a failure', 2, count(*), count(DISTINCT champion_id)
 FROM cell
UNION ALL SELECT 'from the tree', 2, count(*), count(DISTINCT champion_id)
 FROM cell)""".replace(f"{PATCH} AS patch", f"'{PATCH}' AS patch").replace("1 AS built_at", "1::INT AS built_at"))
def republish(spark, sf_dir):
    """A partition published anew, and once more by a build that fails midway, with what readers of old and new manifests find."""
    root, made = shared.scratch(spark, "published"), Parts(spark, sf_dir)
    first, second, third = entry(PATCH, 1), entry(PATCH, 2), entry(PATCH, 3)
    number = publish.publish_partition(made.documents(first, only="champion_id <= 10"), root, first)
    moments = {"before": shared.stored(told(spark, root))}
    publish.publish_partition(made.documents(second), root, second)
    moments |= {"reader of before": shared.stored(told(spark, root, number)), "after": shared.stored(told(spark, root))}
    broken = made.documents(third)
    broken["matchups"] = broken["matchups"].where(F.assert_true(F.lit(False) & F.col("role").isNotNull(), F.lit("this build fails")).isNull())
    try:
        publish.publish_partition(broken, root, third)
    except Exception as error:
        if "this build fails" not in str(error):
            raise
    moments["after a failure"] = told(spark, root)
    tree = publish.entries_of_tree(spark, root).select("patch", F.dayofmonth("built_at").alias("built_at"))
    moments["from the tree"] = tree.join(moments["after"].drop("patch"), "built_at", "left")
    rows = None
    for moment, df in moments.items():
        one = df.select(F.lit(moment).alias("moment"), "patch", "built_at", "cells", "champions")
        rows = one if rows is None else rows.unionByName(one)
    return rows


FAULTS = """SELECT '16.18' AS patch, 'tier_list' AS kind, role || ' ' || champion_id AS place, 'win_rate' AS problem
 FROM cell WHERE n >= 20 AND champion_id % 7 = 0
UNION ALL SELECT '16.18', 'tier_list', role || ' ' || champion_id, 'floor' FROM cell WHERE n >= 20 AND n < 30
UNION ALL SELECT '16.18', 'champions', role || ' ' || champion_id, 'floor' FROM cell WHERE n >= 20 AND n < 30
UNION ALL SELECT '16.18', 'matchups', s.role || ' ' || s.champion_id || ' ' || opponent_id, 'axis'
 FROM mu s WHERE n >= 30 AND (s.champion_id = 3 OR opponent_id = 3)
UNION ALL SELECT '16.18', 'matchups', s.role || ' ' || s.champion_id || ' ' || opponent_id, 'floor' FROM mu s WHERE n >= 20 AND n < 30
UNION ALL SELECT '16.18', 'matchups', s.role || ' ' || s.champion_id || ' ' || opponent_id, 'axis'
 FROM mu s WHERE n >= 20 AND n < 30 AND (s.champion_id = 3 OR opponent_id = 3)
UNION ALL SELECT '16.17', 'matchups', '', 'missing' UNION ALL SELECT '16.17', 'champions', '', 'broken'
 UNION ALL SELECT '16.16', 'tier_list', '', 'envelope_region'"""


@query("verify_tree", CELLS + FAULTS)
def verify_tree(spark, sf_dir):
    """A published tree with faults planted on disk: wrong rates, documents below the floor, an axis that lacks a champion,
    a kind that is gone, a line cut off, and a document of another region."""
    root, made = shared.scratch(spark, "published"), Parts(spark, sf_dir)
    for patch in ("16.16", "16.17", PATCH):
        of = entry(patch, 1)
        docs = made.documents(of, 20 if patch == PATCH else 30)
        if patch == PATCH:
            wrong = F.transform("cells", lambda c: c.withField("win_rate", F.when(c["champion_id"] % 7 == 0, c["win_rate"] + 0.001).otherwise(c["win_rate"])))
            docs["tier_list"] = docs["tier_list"].withColumn("cells", wrong)
            docs["matchups"] = docs["matchups"].withColumn("champions", F.array_except("champions", F.array(F.lit(3))))
        if patch == "16.16":
            docs["tier_list"] = docs["tier_list"].withColumn("envelope", F.col("envelope").withField("region", F.lit("NA")))
        publish.publish_partition(docs, root, of)
    builds = {r.patch: r.build for r in publish.read_manifest(spark, root).collect()}
    shared.remove(spark, f"{root}/builds/{builds['16.17']}/matchups")
    cut = spark.range(1).select(F.lit('{"envelope":{"patch":"16.17"').alias("value"))
    cut.write.mode("append").text(f"{root}/builds/{builds['16.17']}/champions")
    # the order of rates is broken where rates are, by chance of the neighbours; the test of orders is verify_order
    return publish.verify_tree(spark, root, 30).where("problem <> 'rate_order'").select("patch", "kind", "place", "problem")


@query("merge_manifest", MANIFEST + """ SELECT patch, region, CAST(queue AS INT) AS queue, bracket, CASE WHEN patch = '16.18' THEN 9
 WHEN patch = '16.17' THEN 1 END::INT AS built_at FROM r""")
def merge_manifest(spark, sf_dir):
    """Listed partitions of one patch, those of all patches found in the tree, and a new build of another patch."""
    found = partitions(spark, sf_dir).select(*publish.PARTITION)
    known = found.where("patch = '16.17'").withColumn("built_at", F.lit(1))
    return publish.merge_manifest(known, found, found.where("patch = '16.18'").withColumn("built_at", F.lit(9))).select(*publish.PARTITION, "built_at")


@query("verify_latest", MANIFEST + """ SELECT patch, region, CAST(queue AS INT) AS queue, bracket, 'older' AS problem
 FROM r WHERE patch <> (SELECT max(patch) FROM r)""")
def verify_latest(spark, sf_dir):
    """Each partition named as latest in turn."""
    rows = partitions(spark, sf_dir)
    return gates.verify_latest(rows.select(*publish.PARTITION), rows)


@query("verify_envelope", MANIFEST + """, d AS (SELECT patch, region, CAST(queue AS INT) AS queue, bracket, first_day, last_day FROM r)
SELECT patch, region, queue, bracket, problem FROM d, (VALUES ('region'), ('window')) v(problem)
 WHERE problem = 'region' AND queue = 440 AND region <> 'EUW1' OR problem = 'window' AND patch = '16.17' AND last_day < DATE '2026-12-31'""")
def verify_envelope(spark, sf_dir):
    """Documents of every partition, some with another region or a window turned round."""
    rows = partitions(spark, sf_dir)
    region = F.when(F.col("queue") == 440, "EUW1").otherwise(F.col("region"))
    first = F.when(F.col("patch") == "16.17", F.lit("2026-12-31").cast("date")).otherwise(F.col("first_day"))
    return gates.verify_envelope(rows.withColumn("envelope", F.struct("patch", region.alias("region"), "queue", "bracket", first.alias("first_day"), "last_day")))


@query("provenance", """SELECT o_orderkey::BIGINT AS run_id, CASE WHEN o_orderkey % 5 = 0 THEN 'main' ELSE substr(md5(CAST(o_orderkey AS VARCHAR)),
 1, 12) END AS revision FROM orders WHERE o_orderkey % 5 = 0""")
def provenance(spark, sf_dir):
    """Runs of a table, some under a name that is no revision."""
    key = F.col("o_orderkey").cast("bigint")
    revision = F.when(key % 5 == 0, "main").otherwise(F.substring(F.md5(key.cast("string")), 1, 12))
    return gates.provenance(spark.read.parquet(f"{sf_dir}/orders.parquet").select(key.alias("run_id"), revision.alias("revision")))


@query("append_archive_parts", W + f""", a AS (SELECT CAST(game_creation AS DATE) + 1 AS dt
 FROM m UNION ALL SELECT CAST(game_creation AS DATE) + 2 FROM m WHERE {synth.COPY}) SELECT dt, count(*) AS rows,
 count(*) AS intact FROM a GROUP BY 1""")
def append_archive_parts(spark, sf_dir):
    """Two appends to a new archive, read back by date with every payload held against its hash."""
    root, rows = shared.scratch(spark, "archive"), synth.archived(spark, sf_dir, "summaries").drop("dt", "part", "part_row")
    even = F.crc32(F.col("match_id").cast("binary")) % 2 == 0
    for half in (even, ~even):
        publish.append_archive(rows.where(half), root, "summaries")
    back = archive.read_archive(spark, root, "summaries")
    return back.groupBy("dt").agg(F.count("*").alias("rows"), F.count_if(F.col("payload_sha256") == F.sha2("payload", 256)).alias("intact"))


STREAMED = W + f""", a AS (SELECT k, match_id, k % 5 AS g, k % 7 = 0 AS bare
 FROM m UNION ALL SELECT k, match_id, (k // 25) % 5, k % 7 = 0 FROM m WHERE {synth.COPY}),
r AS (SELECT match_id, bare, count(*) AS n, count_if(g = 0) AS before, count_if(g BETWEEN 1 AND 3) AS live,
 count_if(g = 4) AS after FROM a GROUP BY 1, 2)
SELECT CAST(sum(CASE WHEN bare THEN n ELSE before + after + CASE WHEN before = 0 AND live > 0 THEN 1 ELSE 0 END END) AS BIGINT) AS rows,
 count_if(NOT bare) AS matches, CAST(coalesce(sum(n) FILTER (bare), 0) AS BIGINT) AS without_id FROM r"""


@query("stream_archive", f"SELECT *, rows AS intact FROM ({STREAMED})")
def stream_archive(spark, sf_dir):
    """One archive fed by a batch, a stream in micro-batches that is stopped and started again, and another batch.

    The stream leaves out matches that are there already; one match in seven has no id, and each of its rows is kept.
    """
    root = shared.scratch(spark, "stream")
    number = F.substring("match_id", 6, 10).cast("bigint")
    again = F.to_date("fetched_at") > F.to_date(F.timestamp_millis("game_creation_ms")) + F.lit(1)
    rows = synth.archived(spark, sf_dir, "summaries").drop("dt", "part", "part_row").withColumn("group", F.when(again, F.floor(number / 25) % 5).otherwise(number % 5))
    rows = rows.withColumn("match_id", F.when(number % 7 != 0, F.col("match_id")))
    of = lambda *groups: rows.where(F.col("group").isin(*groups)).drop("group")
    live = lambda: stream.stream_archive(stream.incoming(spark, f"{root}/in", of().schema, 4), f"{root}/out", "summaries", f"{root}/state")
    publish.append_archive(of(0), f"{root}/out", "summaries")
    for arrived in ((1, 2), (3,)):
        for group in arrived:
            of(group).coalesce(4).write.mode("append").parquet(f"{root}/in")
        live().awaitTermination()
    publish.append_archive(of(4), f"{root}/out", "summaries")
    back = archive.read_archive(spark, f"{root}/out", "summaries")
    return back.agg(
        F.count("*").alias("rows"), F.count_distinct("match_id").alias("matches"), F.count_if(F.col("match_id").isNull()).alias("without_id"),
        F.count_if(F.col("payload_sha256") == F.sha2("payload", 256)).alias("intact"),
    )
