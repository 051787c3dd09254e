"""Runs of repeated words against all starts and periods."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from laneforge.llm import periodic, queries

SF = "/root/testdata/sf0.01"


def all_runs(words):
    """Every stretch of twelve words and two periods that can't go on, by its smallest period."""
    n, found = len(words), {}
    ids = periodic.numbers_of(words)
    for q in range(1, n // 2 + 1):
        same = ids[:-q] == ids[q:]
        k = 0
        for at in [*np.flatnonzero(~same).tolist(), n - q]:
            if at - k + q >= max(12, 2 * q):
                found.setdefault((k, at - k + q), q)
            k = at + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(all_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    listed = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, listed, kept)


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def check(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op12_periodic_runs(spark, path).collect()
    rows = sorted((repr(r.doc_id), tuple(r[c] for c in COLUMNS)) for r in found)
    rows = sorted(rows, key=repr)
    want = sorted(((repr(d.doc_id), expected(d.doc_id, d.text)) for d in docs), key=repr)
    assert rows == want
    return want


def test_real_rows(spark):
    assert sum(r[1][0] > 0 for r in check(spark, SF)) > 50


def test_awkward_rows(spark, tmp_path):
    tens = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0]
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "a " * 11, "a " * 12, "a b " * 6, "a b " * 5 + "a", "x " + "a b c " * 4 + "a y", "é é " * 13, "k K " * 9, "a a a a a b " * 9 + "c", ("p q " * 8 + "r ") * 6]
    rows = [(k, t, 1, "x") for k, t in enumerate(texts)] + [(t, x, 1, "x") for t, x in zip(tens, texts[1:])] + [(None, "z " * 20, 1, "x"), (3, "one", 1, "x"), (3, "one", 1, "x"), (tens[-1], " ".join(map(str, range(900))), 2, "y")]
    spark.createDataFrame(rows, "doc_id long, text string, runs int, start string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = periodic.collapse(docs)
    assert out.columns == [*docs.columns, "_runs"] and out.count() == len(rows)
    assert out.where("text = 'a' AND doc_id = 5").first()["_runs"] == [(0, 12, 1)]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_periodic_runs(spark, str(tmp_path)).collect() == []


def words_of(rng, n, size):
    return [b"w%d" % rng.randrange(size) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_all_lags(seed):
    """Words of few kinds, with stretches repeated inside each other, so that runs overlap and nest."""
    rng = random.Random(seed)
    for _ in range(120):
        words = words_of(rng, rng.randrange(1, 60), rng.choice([1, 2, 3, 8]))
        for _ in range(rng.randrange(4)):
            at, p = rng.randrange(len(words)), rng.randrange(1, 30)
            part = words[at : at + p]
            words = words[:at] + (part * rng.randrange(1, 8)) + words[at:]
        assert periodic.runs_of(words) == sorted(all_runs(words), key=lambda r: (r[0], r[2]))


def test_segments_hold_every_run():
    rng = random.Random(9)
    words = words_of(rng, 400, 600) + words_of(rng, 30, 10**6) * 3 + words_of(rng, 400, 600) + [b"q"] * 15
    parts = periodic.segments(periodic.numbers_of(words))
    for s, length, _ in all_runs(words):
        assert any(lo <= s and s + length <= hi for lo, hi in parts)
    assert sum(hi - lo for lo, hi in parts) < len(words)


def test_long_texts_cost_no_square():
    """A word said 200,000 times, one period of 20,000 words ten times over, and as many words of few kinds."""
    rng = random.Random(2)
    began = time.time()
    assert periodic.runs_of([b"a"] * 200_000) == [(0, 200_000, 1)]
    assert (0, 200_000, 20_000) in periodic.runs_of(words_of(rng, 20_000, 10**9) * 10)
    periodic.runs_of(words_of(rng, 200_000, 40))
    assert time.time() - began < 60
