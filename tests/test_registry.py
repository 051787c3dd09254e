"""The registered queries against their SQL, and the entry points without the optional part."""

from __future__ import annotations

import contextlib
import datetime
import decimal
import io
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from laneforge.functions.columns import parsed_json, typed_json
from laneforge.operators import timeline
from laneforge.plans import registry, synth, timeline_queries
from laneforge.sources import archive, schemas

ROOT = Path(__file__).resolve().parents[1]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()



@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if v != v else float(f"{v:.10g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return list(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    found = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted((str([plain(r[names.index(c)]) for c in cols]) for r in found.fetchall()))
    assert sorted(str([plain(r[c]) for c in cols]) for r in df.collect()) == want


def test_documents_are_not_shuffled(spark):
    """Neither copies nor the ledger make parsed documents or payloads go through an exchange."""
    d = timeline_queries.Dataset(spark, SF)
    for df in (registry.QUERIES["tier_list"](spark, SF), timeline.match_index(d.summaries, d.timelines)):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        inputs = re.findall(r"\) (?:Broadcast)?Exchange\s*\nInput[^\n]*", out.getvalue())
        assert inputs and not any(re.search(r"\b(?:doc|payload)#", i) for i in inputs)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and {"champion_id", "role", "tier", "win_rate"} <= set(out.columns)


def test_entry_points_without_the_optional_part(tmp_path):
    shutil.copytree(ROOT / "laneforge", tmp_path / "laneforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 100; import re; assert not any(re.match(r'op[0-9]', n) for n in e.queries())"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_outside_imports_the_optional_part():
    files = [p for p in (ROOT / "laneforge").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]
    assert files and not any("laneforge.llm" in p.read_text() for p in files)


def test_the_window_is_a_whole_fortnight(spark):
    """The tier list's matches are of the fourteen days up to the window's end, all of which the archive holds."""
    days = [r.day for r in registry.QUERIES["participants"](spark, SF).selectExpr("CAST(game_creation AS DATE) AS day").distinct().orderBy("day").collect()]
    assert days == [datetime.date(2026, 9, n) for n in range(1, 15)]
    first, last = registry.QUERIES["resolve_window"](spark, SF).select("first_day", "last_day").first()
    assert (last - first).days == 13


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/St_Johns", "UTC"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_minutes_do_not_depend_on_the_session_zone(spark, tmp_path, zone, kind):
    """Times without a zone and points in time, before 1970 too and within half a millisecond of a minute, in zones that are off by parts of an hour."""
    texts = ["2024-03-10 02:30:59.999999", "2024-01-01 00:07:59.9995", "2024-01-01 00:08:59.999499", "1969-12-31 23:57:00.0005", "1969-12-31 23:56:00.000499", "2024-01-01 00:00:00", "1969-12-31 23:58:59.0004", "1940-06-01 12:34:56.5"]
    spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"CAST(t AS {kind}) AS ts").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = sorted(tuple(r) for r in registry.QUERIES["minute_of"](spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == sorted(con.execute(registry.ORACLES["minute_of"]).fetchall())


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_payloads_are_carried_without_a_join(spark):
    """Payloads come from the read that tells their envelopes; the one join takes later copies out."""
    assert re.findall(r"Join type: (\w+)", plan_of(registry.QUERIES["carry_payload"](spark, SF))) == ["LeftAnti"]


def test_roles_are_parsed_once(spark):
    assert "from_json" not in plan_of(registry.QUERIES["normalize_role"](spark, SF))


@pytest.mark.parametrize("source", ["summaries", "timelines"])
def test_the_derived_archive_comes_in_order_of_days(spark, source):
    """So that a write by day needs no sort of payloads."""
    rows = getattr(synth, source)(spark, SF).select(F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at"), "dt")
    found = rows.withColumn("before", F.lag("dt").over(Window.partitionBy("task").orderBy("at"))).localCheckpoint()
    assert found.where("before > dt").count() == 0


def test_payloads_are_made_by_compiled_code(spark):
    """Players, frames and events of the derived payloads are no lambdas, which Spark interprets; payloads are neither dealt nor sorted."""
    for source, most in (("summaries", 1), ("timelines", 1)):
        made = getattr(synth, source)(spark, SF)
        lambdas = [x for x in re.findall(r"lambda (\w+?)#", made._jdf.queryExecution().optimizedPlan().toString())]
        assert not {"i", "j"} & set(lambdas), lambdas
        steps = made._jdf.queryExecution().executedPlan().toString()
        assert steps.count("Exchange") == most and steps.count("Sort [") == most
    whole = synth.timelines(spark, SF).where("part_row % 200 = 20").select("payload", F.from_json("payload", f"STRUCT<{schemas.TIMELINE}>").alias("d"))
    assert whole.where("d IS NULL OR size(d.info.frames) < 5 OR array_max(transform(d.info.frames, f -> size(f.events))) <> 4").isEmpty() and not whole.isEmpty()
    assert synth.each("pid", (1, 2), "pid + k") == "array(1 + k, 2 + k)"


def test_numbers_are_parsed_as_such_and_odd_ones_as_before(spark):
    """Payloads with numbers in other spellings, of other shapes, broken, or with more behind their end give the same struct and validity as by strings."""
    one = '{"info":{"frameInterval":%s,"frames":[{"timestamp":%s,"participantFrames":{"1":{"level":%s,"xp":7,"position":{"x":1,"y":%s}}},"events":[{"type":"A","level":%s}]}]}}'
    odd = ("1", '"7"', '" 7 "', "7.0", '"7.0"', "1e2", "99999999999999999999", "3000000000", "true", "null", '"x"', "[1]", '{"a":1}')
    texts = [one % tuple(v if k == at else "5" for k in range(5)) for at in range(5) for v in odd]
    texts += [one % tuple("12345"), "null", "5", "[1]", "", "{", None, '{"info":1}', '{"info":{"frames":{}}}', '{"info":{"frameInterval":1}},{"info":{}}']
    texts += ['{"info":{"frameInterval":1}}],"both":[{"info":{"frameInterval":2}}', '{"info":{"frameInterval":1}},"b":[{}', '{"info":{"frameInterval":1}}]', '{"info":{"frameInterval":1,"frameInterval":"2"}}', '{"info":{"frameInterval":"2","frameInterval":1}}']
    schema = schemas.TIMELINE
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    read, doc, valid = typed_json(F.col("payload"), schema, schemas.TYPED[schema])
    got = rows.select("n", "payload", read.alias("both")).select("n", doc.alias("doc"), valid.alias("valid"))
    array, doc, valid = parsed_json(F.col("payload"), schema)
    want = rows.select("n", "payload", array.alias("both")).select("n", doc.try_cast(got.schema["doc"].dataType).alias("doc"), valid.alias("valid"))
    assert [r.asDict(True) for r in got.orderBy("n").collect()] == [r.asDict(True) for r in want.orderBy("n").collect()]
    kinds = dict(archive.timeline_envelope(synth.timelines(spark, SF)).select("doc.info.*").dtypes)
    assert kinds["frameInterval"] == "bigint" and "xp:bigint" in kinds["frames"] and "victimId:bigint" in kinds["frames"]


def test_only_played_matches_are_parsed_for_tables_of_eligible_ones(spark):
    """Summaries of all matches for the ledger, of those with a timeline for other tables, which come out the same."""
    some, every = timeline_queries.Dataset(spark, SF, whole=False), timeline_queries.Dataset(spark, SF)
    lines = {r[0] for r in some.timelines.select("match_id").collect()}
    assert {r[0] for r in some.summaries.select("match_id").collect()} == lines and every.index.count() > 10 * len(lines)
    assert some.players.exceptAll(every.players).isEmpty() and every.players.exceptAll(some.players).isEmpty()
    again = synth.archived(spark, SF, "played").groupBy("match_id").count().where("count > 1").count()
    assert again == len([m for m in lines if int(m[5:]) % 25 == 0])


def test_picks_need_no_minutes(spark):
    """Frames at checkpoints are picked before running totals are looked up, and are those that all minutes give."""
    d = timeline_queries.Dataset(spark, SF, whole=False)
    picks = d.picks
    assert "minutes" not in d.__dict__
    want = timeline.checkpoint_picks(d.minutes)
    assert picks.columns == want.columns and dict(picks.dtypes) == dict(want.dtypes) and picks.count() > 0
    assert picks.exceptAll(want).isEmpty() and want.exceptAll(picks).isEmpty()


def test_players_of_new_matches_are_parsed_once(spark):
    """The names alone, of the fetched summaries alone; of a match's copies those of the first, without a join that takes the others out."""
    made = registry.QUERIES["widen_frontier"](spark, SF)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "perks" not in plan and re.findall(r"\bJoin (\w+)", plan) == ["Inner"]
    fetched = synth.archived(spark, SF, "fetched")
    want = synth.archived(spark, SF, "summaries").where("cast(substring(match_id, 6) as bigint) % 3 = 0")
    one = lambda rows: rows.select("match_id", "payload", "dt")
    assert not fetched.isEmpty() and one(fetched).exceptAll(one(want)).isEmpty() and one(want).exceptAll(one(fetched)).isEmpty()
    rows = spark.createDataFrame([("a", "q", 1, 1), ("a", "p", 9, 2), ("a", "p", 10, 3), (None, "p", 1, 4), (None, "p", 2, 5), ("b", "r", 1, 6)], "match_id string, part string, part_row long, x int")
    assert {r.x for r in archive.first_of_each(rows).collect()} == {2, 6}
    assert {r.x for r in archive.first_archived(rows).collect()} == {2, 4, 5, 6}
