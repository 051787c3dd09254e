from __future__ import annotations

import datetime as dt
import json
import pathlib
import time

import pytest
from conftest import SF, rows
from matches import season, summary
from pyspark.sql import Observation
from pyspark.sql import functions as F

from laneforge.operators import control, documents, extract, policy
from laneforge.plans import storage_queries, synth
from laneforge.sources import archive, parts, publish, schemas, shared, snapshots
from laneforge.streaming import archive as stream


def full_rows(spark, sf_dir=SF):
    return synth.summaries(spark, sf_dir).drop("dt", "part", "part_row")


def test_archive_round_trip(spark, tmp_path):
    kept = full_rows(spark)
    publish.append_archive(kept, str(tmp_path), "summaries")
    back = archive.read_archive(spark, str(tmp_path), "summaries", since="2026-09-10")
    assert back.count() == kept.where("fetched_at >= '2026-09-10'").count()
    assert "PartitionFilters: [isnotnull(dt" in back.drop("part", "part_row")._jdf.queryExecution().executedPlan().toString()
    assert archive.damaged(back).isEmpty()
    assert not archive.damaged(back.withColumn("payload", F.lit("{}"))).isEmpty()
    with pytest.raises(archive.ArchiveEmpty):
        archive.read_archive(spark, str(tmp_path), "summaries", since="2030-01-01")
    with pytest.raises(archive.ArchiveEmpty):
        archive.read_archive(spark, str(tmp_path), "timelines")


def test_parts_without_a_column_have_it_null(spark, tmp_path):
    kept = archive_part(spark, 1)
    kept.drop("payload_version").write.parquet(f"{tmp_path}/s/dt=2026-09-01")
    archive_part(spark, 2).write.parquet(f"{tmp_path}/s/dt=2026-09-02")
    back = archive.read_archive(spark, str(tmp_path), "s")
    assert sorted(rows(back.select("payload_version", "part_row")), key=str) == [("1", 0), (None, 0)]


def archive_part(spark, number):
    return full_rows(spark).limit(1)


def test_dates():
    assert archive.window_ending("2026-09-14", 14) == ("2026-09-01", "2026-09-14")
    assert archive.window_ending("2026-03-01", 1) == ("2026-03-01", "2026-03-01")
    for bad in ("2026-9-1", "2026-02-30", "20260901", ""):
        with pytest.raises(ValueError):
            archive.canonical_date(bad)
    for days in (0, 401):
        with pytest.raises(ValueError):
            archive.window_days(days)


def test_jsonl_and_numbers_in_other_spellings(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("\n".join([summary(1, "2026-09-09T18:05:00+00:00"), "", "{oops"]) + "\n")
    payloads = archive.read_jsonl(spark, str(tmp_path / "m.jsonl"))
    assert payloads.count() == 2
    doc = json.loads(summary(2, "2026-09-09T18:05:00+00:00"))
    doc["info"]["queueId"] = "420"
    doc["info"]["participants"][0]["championId"] = "not a number"
    odd = spark.createDataFrame([("p", 0, json.dumps(doc))], "part string, part_row long, payload string")
    e = archive.envelope(archive.parse_summaries(odd))
    assert e.first().queue_id == 420
    assert [r.champion_id for r in extract.participants(e).collect()][:2] == [None, 64]


def test_participant_ids(spark):
    doc = json.loads(summary(1, "2026-09-09T18:05:00+00:00"))
    doc["metadata"]["participants"] = ["x", " ", "player-02", None]
    e = archive.envelope(archive.parse_summaries(spark.createDataFrame([("p", 0, json.dumps(doc))], "part string, part_row long, payload string")))
    assert extract.participant_ids(e).first().puuids[:4] == ["x", "player-02", "player-01", "player-03"]


def test_static_documents(spark):
    champion = {"data": {"KaiSa": {"id": "Kaisa", "key": "145", "name": "Kai'Sa", "image": {"full": "Kaisa.png"}}}}
    items = {"data": {"1055": {"name": "Blade", "image": {"full": "1055.png"}}}}
    runes = [{"id": 8000, "key": "Precision", "name": "Precision", "icon": "p.png", "slots": [{"runes": [{"id": 8005, "key": "Press", "name": "Press", "icon": "a.png"}]}]}]
    docs = spark.createDataFrame([(k, json.dumps(d)) for k, d in (("champion", champion), ("item", items), ("runesReforged", runes))], "kind string, payload string")
    assert rows(archive.static_dictionary(docs, "champion")) == [(145, "KaiSa", "Kai'Sa", "kaisa", "Kaisa.png")]
    assert rows(archive.static_dictionary(docs, "item"))[0][:3] == (1055, "1055", "Blade")
    assert sorted(r.id for r in archive.rune_dictionary(docs).collect()) == [8000, 8005]
    versions = spark.createDataFrame([("16.9.1",), ("16.20.1",), ("16.3.1",), ("lolpatch_7.20",)], "version string")
    assert archive.newest_version(versions).first()[0] == "16.20.1"


def test_ladder_pages(spark):
    entry = [{"puuid": " a ", "tier": "", "rank": ""}, {"puuid": "a"}, {"puuid": ""}, {"puuid": "b", "tier": "gold", "rank": "iv"}]
    pages = [("EUW", "silver", "i", dt.datetime(2026, 9, 1), json.dumps(entry)), ("EUW", "challenger", "i", dt.datetime(2026, 8, 1), json.dumps({"entries": [{"puuid": "c"}]}))]
    out = control.seed_entries(spark.createDataFrame(pages, "region string, tier string, division string, fetched_at timestamp, payload string"))
    assert sorted(rows(out.select("puuid", "seed_tier", "seed_division"))) == [("a", "SILVER", "I"), ("b", "GOLD", "IV"), ("c", "CHALLENGER", "I")]


def of(patch, at):
    return {"patch": patch, "region": "EUW", "queue": 420, "bracket": "all", "built_at": dt.datetime(2026, 9, at), "first_day": dt.date(2026, 9, 1), "last_day": dt.date(2026, 9, 10), "source": "live"}


def docs_of(spark, entry, n, wins=5):
    """The documents of one cell, of n games, with a build and a pair."""
    cells = spark.createDataFrame([(24, "TOP", n, wins, round(wins / n, 4), 0.5, 0.0, "S", round(0.98 / n**0.5, 4))], "champion_id int, role string, n int, wins int, win_rate double, pick_rate double, ban_rate double, tier string, ci95 double")
    builds = spark.createDataFrame([(24, "TOP", [4, 12], "4-12", n, wins, 0.5, 1, "spells")], "champion_id int, role string, key array<int>, label string, n int, wins int, win_rate double, rank int, kind string")
    pairs = spark.createDataFrame([("TOP", 24, 86, n, wins)], "role string, champion_id int, opponent_id int, n int, wins int")
    names = spark.createDataFrame([(24, "jax", "Jax")], "id int, slug string, name string")
    return documents.assembled(cells, builds, pairs, names, entry, 1)


def test_published_partitions(spark, tmp_path):
    root = str(tmp_path)
    assert publish.read_manifest(spark, root).isEmpty()
    numbers = [publish.publish_partition(docs_of(spark, of(p, at), n), root, of(p, at)) for p, n, at in (("16.9", 10, 1), ("16.10", 20, 2), ("16.9", 30, 3))]
    assert numbers == [1, 2, 3]
    listed = publish.read_manifest(spark, root)
    assert [(r.patch, r.built_at.day) for r in listed.collect()] == [("16.10", 2), ("16.9", 3)]
    games = lambda number: {r.envelope.patch: r.cells[0].n for r in publish.read_documents(spark, root, "tier_list", publish.read_manifest(spark, root, number)).collect()}
    assert (games(1), games(2), games(3)) == ({"16.9": 10}, {"16.9": 10, "16.10": 20}, {"16.9": 30, "16.10": 20})
    page = publish.read_documents(spark, root, "champions", listed).where("envelope.patch = '16.9'").first()
    assert (page.slug, page.name, page.roles[0].n, page.roles[0].spells[0].label) == ("jax", "Jax", 30, "4-12")
    assert publish.read_documents(spark, root, "matchups", listed).first().champions == [24, 86]
    assert sorted((r.patch, r.built_at.day) for r in publish.entries_of_tree(spark, root).collect()) == [("16.10", 2), ("16.9", 3)]
    assert publish.verify_tree(spark, root, 1).isEmpty()
    assert publish.latest_partition(listed, listed.where("patch = '16.9'")).first().patch == "16.10"
    gone = publish.prune_builds(spark, root, keep=1)
    assert len(gone) == 1 and publish.manifest_numbers(spark, root) == [3] and games(3) == {"16.9": 30, "16.10": 20}
    with pytest.raises(Exception, match="one source"):
        publish.publish_partition(docs_of(spark, of("16.11", 4), 9), root, {**of("16.11", 4), "source": "demo"})
    assert publish.manifest_numbers(spark, root) == [3]


def test_a_build_that_fails_leaves_the_old_one(spark, tmp_path):
    root = str(tmp_path)
    publish.publish_partition(docs_of(spark, of("16.9", 1), 10), root, of("16.9", 1))
    broken = docs_of(spark, of("16.9", 2), 20)
    broken["matchups"] = broken["matchups"].where(F.assert_true(F.col("role").isNull(), F.lit("fails")).isNull())
    with pytest.raises(Exception, match="fails"):
        publish.publish_partition(broken, root, of("16.9", 2))
    assert [r.built_at.day for r in publish.read_manifest(spark, root).collect()] == [1]
    assert [r.built_at.day for r in publish.entries_of_tree(spark, root).collect()] == [1]
    with pytest.raises(ValueError, match="documents of"):
        publish.publish_partition({"tier_list": broken["tier_list"]}, root, of("16.9", 3))


def test_faults_on_disk_are_named(spark, tmp_path):
    root = str(tmp_path)
    for patch, wins in (("16.9", 5), ("16.10", 5)):
        publish.publish_partition(docs_of(spark, of(patch, 1), 10, wins), root, of(patch, 1))
    builds = {r.patch: r.build for r in publish.read_manifest(spark, root).collect()}
    (line,) = [f for f in (tmp_path / "builds" / builds["16.9"] / "tier_list").glob("*.json") if f.read_text()]
    text = line.read_text()
    line.write_text(text.replace('"win_rate":0.5', '"win_rate":0.6').replace('"queue":420', '"queue":440') + '{"envelope"\n')
    for crc in line.parent.glob(".*.crc"):
        crc.unlink()
    for f in (tmp_path / "builds" / builds["16.10"] / "champions").iterdir():
        f.unlink()
    (tmp_path / "builds" / builds["16.10"] / "champions").rmdir()
    found = {(r.patch, r.kind, r.problem) for r in publish.verify_tree(spark, root, 1).collect()}
    assert found == {("16.9", "tier_list", "win_rate"), ("16.9", "tier_list", "envelope_queue"), ("16.9", "tier_list", "broken"), ("16.10", "champions", "missing")}
    assert {(r.patch, r.problem) for r in publish.verify_tree(spark, root, 11).where("kind = 'matchups'").collect()} == {("16.9", "floor"), ("16.10", "floor")}


def test_a_merge_rewrites_the_buckets_of_its_batch(spark, tmp_path):
    rows_ = spark.range(5000).select(F.concat(F.lit("m"), "id").alias("match_id"), F.lit("timeline").alias("kind"), "id", F.lit(1).alias("priority"), F.lit(0).alias("attempts"), F.lit(0).alias("revivals"),
                                      F.lit("2026-09-01").cast("timestamp").alias("not_before"), F.lit(None).cast("timestamp").alias("claimed_at"), F.lit("dead").alias("status"), F.lit(None).cast("string").alias("last_cause"))
    held = snapshots.Snapshot(spark, f"{tmp_path}/q", control.JOB, 32)
    held.write(rows_)
    files = lambda: {f: f.read_bytes() for f in (tmp_path / "q").rglob("*.parquet")}
    before = files()
    batch = spark.createDataFrame([("m7", "timeline", 0, None, 1), ("new", "timeline", 0, None, 2)], "match_id string, kind string, priority int, not_before timestamp, position int")
    whole = control.merge_queue(held.read(), batch, "2026-09-15")
    expected = sorted(map(str, whole.collect()))
    hit = held.change(batch, lambda part: control.merge_queue(part, batch, "2026-09-15", control.last_id(held.read())))
    after = files()
    assert 1 <= len(hit) <= 2 and sorted(map(str, held.read().select(whole.columns).collect())) == expected
    bucket = lambda f: int(f.parent.name.split("=")[1])
    assert {f: x for f, x in before.items() if bucket(f) not in hit} == {f: x for f, x in after.items() if bucket(f) not in hit}
    assert held.change(batch.limit(0), lambda part: part) == [] and files() == after


def test_figures_gathered_while_writing(spark, tmp_path):
    cells = spark.createDataFrame([(1, 150), (2, 99), (3, 100)], "champion_id int, n int")
    seen = Observation("cells")
    policy.published_and_counted(cells, seen).write.parquet(f"{tmp_path}/cells")
    assert seen.get == policy.suppression(cells).first().asDict() and spark.read.parquet(f"{tmp_path}/cells").count() == 2


def live(spark, path, schema):
    stream.stream_archive(stream.incoming(spark, f"{path}/in", schema, 1), f"{path}/out", "s", f"{path}/c").awaitTermination(120)


def test_stream_and_batch_feed_one_archive(spark, tmp_path):
    """A batch, a stream in three micro-batches with a restart, and a batch again: nothing is lost, no match comes twice by the stream, null ids stay."""
    kept = full_rows(spark).limit(400).withColumn("match_id", F.when(F.crc32(F.col("payload").cast("binary")) % 10 > 0, F.col("match_id"))).coalesce(1).cache()
    parts = [kept.where(F.crc32(F.concat("payload_sha256", F.lit("x")).cast("binary")) % 5 == k) for k in range(5)]
    publish.append_archive(parts[0], str(tmp_path / "out"), "s")
    for p in (parts[1], parts[0].unionByName(parts[1]).unionByName(parts[2])):  # the second file brings known matches again
        p.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    live(spark, tmp_path, kept.schema)
    parts[3].coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    live(spark, tmp_path, kept.schema)
    publish.append_archive(parts[4], str(tmp_path / "out"), "s")
    back = archive.read_archive(spark, str(tmp_path / "out"), "s")
    once = kept.where("match_id IS NOT NULL")
    bare = kept.where("match_id IS NULL").count() + parts[0].unionByName(parts[1]).where("match_id IS NULL").count()
    assert back.where("match_id IS NULL").count() == bare > 0
    assert back.select("match_id").where("match_id IS NOT NULL").distinct().count() == once.select("match_id").distinct().count()
    streamed = back.where("part LIKE '%/stream-%'")
    assert streamed.where("match_id IS NOT NULL").count() == streamed.select("match_id").where("match_id IS NOT NULL").distinct().count()
    assert archive.damaged(back).isEmpty()


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    kept = archive.with_position(spark.read.schema(full_rows(spark).schema).parquet(written(full_rows(spark).limit(50), tmp_path / "in")))
    for _ in range(2):
        stream.append_batch(kept, 0, str(tmp_path / "out"), "s", "x")
    first = archive.read_archive(spark, str(tmp_path / "out"), "s")
    assert first.count() == kept.select("match_id").distinct().count()
    stream.append_batch(kept, 1, str(tmp_path / "out"), "s", "x")  # another batch of the same matches adds none
    assert archive.read_archive(spark, str(tmp_path / "out"), "s").count() == first.count()
    assert not list((tmp_path / "out" / "_staged" / "s").glob("*"))


def test_a_log_of_another_sink_hides_no_part(spark, tmp_path):
    publish.append_archive(full_rows(spark).limit(20), str(tmp_path), "s")
    (tmp_path / "s" / "_spark_metadata").mkdir()
    (tmp_path / "s" / "_spark_metadata" / "0").write_text("v1\n")
    assert archive.read_archive(spark, str(tmp_path), "s").count() == 20


def written(df, path) -> str:
    df.coalesce(1).write.parquet(str(path))
    return str(path)


def test_days_before_the_window_are_not_listed(spark, tmp_path):
    publish.append_archive(full_rows(spark).limit(200), str(tmp_path), "s")
    days = archive.parts_of(spark, f"{tmp_path}/s")
    assert [d for d in days if d >= f"{tmp_path}/s/dt=2026-09-10"] or len(days) > 5
    assert {d.rsplit("=", 1)[1] for d in archive.parts_of(spark, f"{tmp_path}/s", "2026-09-10")} == {d.rsplit("=", 1)[1] for d in days if d.rsplit("=", 1)[1] >= "2026-09-10"}
    (tmp_path / "s" / "dt=2026-9-1").mkdir()
    with pytest.raises(ValueError, match="not a date"):
        archive.parts_of(spark, f"{tmp_path}/s", "2026-09-10")


def test_parts_whose_columns_were_widened(spark, tmp_path):
    """A whole number of 32 bits in one part, of 64 in another, and not there in a third."""
    kept = full_rows(spark).limit(1)
    for day, rows_ in (("01", kept), ("02", kept.withColumn("queue_id", F.lit(2**40 + 420).cast("bigint"))), ("03", kept.withColumn("queue_id", F.lit(440).cast("bigint"))), ("04", kept.drop("queue_id"))):
        rows_.write.parquet(f"{tmp_path}/s/dt=2026-09-{day}")
    back = archive.read_archive(spark, str(tmp_path), "s")
    assert back.schema["queue_id"].dataType.simpleString() == "int"
    first = kept.first().queue_id
    assert [r.queue_id for r in back.orderBy("dt").collect()] == [first, None, 440, None]


def test_drift_is_found_part_by_part(spark, tmp_path):
    whole = ", ".join(f"{c} {t}" for c, t in schemas.TABLES["match_index"])
    empty = spark.createDataFrame([], whole)
    for name, df in (("a", empty), ("b", empty.drop("patch")), ("c", empty.withColumn("frame_count", F.col("frame_count").cast("bigint"))), ("d", empty.select(*reversed(empty.columns)))):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    found = parts.drifted(parts.part_columns(spark, str(tmp_path)), "match_index").withColumn("part", F.regexp_extract("part", "/([a-d])/[^/]*$", 1))
    assert sorted(map(tuple, found.where("part < 'd'").select("part", "column", "problem", "found", "wanted").collect())) == [("b", "patch", "missing", None, "string"), ("c", "frame_count", "type", "bigint", "int")]
    assert found.where("part = 'd' AND problem = 'order'").count() == len(empty.columns) - 1


def test_evolved_parts_read_as_one(spark, tmp_path):
    spark.createDataFrame([("a", 1, 1.5)], "puuid string, level int, share float").write.parquet(f"{tmp_path}/t/dt=2026-09-01")
    spark.createDataFrame([(2**40, "b", 0.1)], "level long, puuid string, share double").write.parquet(f"{tmp_path}/t/dt=2026-09-02")
    spark.createDataFrame([("c",)], "puuid string").write.parquet(f"{tmp_path}/t/dt=2026-09-03")
    back = parts.read_evolved(spark, f"{tmp_path}/t")
    assert [tuple(r)[:3] for r in back.select("puuid", "level", "share").orderBy("puuid").collect()] == [("a", 1, 1.5), ("b", 2**40, 0.1), ("c", None, None)]
    spark.createDataFrame([("d", "x")], "puuid string, level string").write.parquet(f"{tmp_path}/t/dt=2026-09-04")
    with pytest.raises(Exception, match="level bigint, int, string"):
        parts.read_evolved(spark, f"{tmp_path}/t")


def test_staleness_of_a_stream_equals_that_of_a_table(spark, tmp_path):
    kept = full_rows(spark).select("match_id", "fetched_at").limit(100)
    kept.write.parquet(f"{tmp_path}/in")
    live = stream.staleness(stream.incoming(spark, f"{tmp_path}/in", kept.schema))
    query = live.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    time.sleep(1)
    assert sorted(rows(spark.table("hours"))) == sorted(rows(stream.staleness(spark.read.parquet(f"{tmp_path}/in"))))


def test_season_has_every_partition():
    assert {day for day, _ in season()} == {"2026-09-10", "2026-09-14", "2026-09-15"}
    assert [c for c, _ in schemas.LANE_MATCHUPS][-1] == "assists_15" and len(schemas.LANE_MATCHUPS) == 41 and len(schemas.EVENTS) == 33
    assert [len(t) for t in schemas.TABLES.values()] == [15, 23, 33, 41, 31, 31]


def test_lines_are_compressed_and_written_once(spark, monkeypatch):
    """Payloads take kilobytes each as plain lines, and as much again in an archive beside them."""
    made, scratch = [], shared.scratch
    monkeypatch.setattr(shared, "scratch", lambda *named: made.append(scratch(*named)) or made[-1])
    found = storage_queries.read_jsonl_payloads(spark, SF).first()
    assert len(made) == 1 and found.rows > found.matches > 0
    sizes = [f.stat().st_size for f in pathlib.Path(made[0].removeprefix("file:")).glob("part-*")]
    assert 0 < 5 * sum(sizes) < full_rows(spark).agg(F.sum(F.octet_length("payload"))).first()[0]
