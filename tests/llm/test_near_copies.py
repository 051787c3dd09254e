"""Near copies at a five-word similarity of 0.8, held against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from laneforge.llm import near_copies
from test_operators import copies_are_gone, five_words, similar

SF = "/root/testdata/sf0.01"
RNG = random.Random(5)


def prose(n, rng=RNG):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def edited(words, edits, rng=RNG):
    out = list(words)
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"x{rng.randrange(10**6)}"
    return out


def kept(spark, rows, tmp_path, **options):
    spark.createDataFrame(rows, "doc_id long, text string, _at int, key string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    out = near_copies.keep_one(docs, is_table=True, **options)
    assert out.columns == docs.columns
    return out.collect()


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    copies_are_gone(texts, {r.doc_id for r in near_copies.keep_one(docs, is_table=True).collect()})


@pytest.mark.parametrize("keys", [1, near_copies.KEYS])
def test_crowds(spark, tmp_path, keys):
    """A large group around one text, a chain whose ends are apart, and strangers."""
    middle, chain = prose(200), [prose(200)]
    for _ in range(12):
        chain.append(edited(chain[-1], 3))
    texts = [edited(middle, 2) for _ in range(150)] + chain + [prose(200) for _ in range(20)]
    named = {k: " ".join(t) for k, t in enumerate(texts)}
    found = {r.doc_id for r in kept(spark, [(k, t, 1, "a") for k, t in named.items()], tmp_path, keys=keys)}
    assert not similar(five_words(named[150]), five_words(named[162]))
    assert found == {0, 150, *range(163, 183)}


def test_links_are_verified(spark, tmp_path):
    base = prose(150)
    far, close = edited(base, 9), edited(base, 2)
    assert not similar(five_words(" ".join(base)), five_words(" ".join(far)))
    rows = [(3, " ".join(base), 0, "a"), (1, " ".join(far), 0, "a"), (2, " ".join(close).upper().replace("W", "w"), 0, "a")]
    assert sorted(r.doc_id for r in kept(spark, rows, tmp_path)) == [1, 2]


def test_awkward_rows(spark, tmp_path):
    long = " ".join(prose(60_000))
    rows = [(5, None, 1, "a"), (4, "", 1, None), (9, " \t\n", 2, "b"), (None, "alone here", 1, "a"), (None, "Alone  HERE", 1, "a"),
            (7, "same words again and again", 1, "a"), (7, "same words again and again", 1, "a"), (7, "another text under one id", 1, "a"), (8, long, 0, "c"), (6, long + " end", 0, "c")]
    found = kept(spark, rows, tmp_path)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == [(False, 4), (False, 6), (False, 7), (False, 7), (True, 0)]
    assert len({r.text for r in found}) == 5


def test_empty_table(spark, tmp_path):
    assert kept(spark, [], tmp_path) == []


def test_shared_variants_are_those_within_a_bit(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 62), 1 << 62, (6, near_copies.LONGS))
    rows = [*base]
    for k, flips in enumerate([(3,), (3, 40), (3, 9), (63,), (32, 33), (0,)]):
        changed = ~base[k]  # every segment differs widely but the first two, which differ as told
        changed[0] = base[k][0]
        for bit in flips:
            changed[0] ^= np.int64(-(1 << 63)) if bit == 63 else np.int64(1 << bit)
        rows.append(changed)
    nodes = spark.createDataFrame([(k, *map(int, r)) for k, r in enumerate(rows)], "tag long, " + ", ".join(f"{p} long" for p in near_copies.PARTS))
    shared = near_copies.shared_variants(nodes)
    met = shared.alias("p").join(shared.alias("q"), "key").where("p.tag < q.tag").select("p.tag", "q.tag").distinct().collect()
    low = (1 << 32) - 1
    halves = lambda r: (int(r[0]) & low, int(r[0]) >> 32 & low, *(h for x in r[1:] for h in (int(x) & low, int(x) >> 32 & low)))
    want = {(i, j) for i in range(12) for j in range(i + 1, 12) if any((a ^ b).bit_count() <= 1 for a, b in zip(halves(rows[i]), halves(rows[j])))}
    assert {tuple(r) for r in met} == want and want >= {(0, 6), (1, 7), (2, 8), (3, 9), (4, 10), (5, 11)}
    assert shared.where(F.col("size") < 2).isEmpty()


def run_edited(words, share, rng):
    """One run of replaced words, so long that five-word sets are similar by ``share``."""
    shingles = len(words) - 4
    lost = round(shingles * (1 - share) / (1 + share))  # of each text's shingles
    n = max(1, lost - 4)
    at = rng.randrange(5, len(words) - n - 5)
    return words[:at] + [f"y{rng.randrange(10**6)}" for _ in range(n)] + words[at + n :]


@pytest.mark.parametrize("kind", ["run", "scattered"])
@pytest.mark.parametrize("least", [0.80, 0.85])
def test_recall_of_planted_pairs(spark, tmp_path, kind, least):
    """120 pairs whose similarity lies within three hundredths above ``least``, among strangers that share passages."""
    rng = random.Random(f"{kind}{least}")
    passage, rows, pairs = prose(60, rng), [], []
    while len(pairs) < 120:
        words = prose(rng.randrange(150, 900), rng)
        if len(pairs) % 3 == 0:
            words = words[:80] + passage + words[80:]
        lost = (len(words) - 4) * (1 - least) / (1 + least)
        copy = run_edited(words, least + 0.015, rng) if kind == "run" else edited(words, max(1, round(lost / 5.2)), rng)
        one, two = five_words(" ".join(words)), five_words(" ".join(copy))
        share = len(one & two) / len(one | two)
        if least <= share < least + 0.03:
            pairs.append((2 * len(pairs), 2 * len(pairs) + 1))
            rows += [(pairs[-1][0], " ".join(words), 0, "x"), (pairs[-1][1], " ".join(copy), 0, "x")]
    found = {r.doc_id for r in kept(spark, rows, tmp_path)}
    assert all(a in found for a, _ in pairs)
    assert sum(b not in found for _, b in pairs) >= 0.95 * len(pairs)


def test_a_large_group_just_below_costs_little(spark):
    """600 texts of one base, all at some 0.7 to each other: no pair is worth a look, as they differ in their rare shingles."""
    rng = random.Random(8)
    base = prose(300, rng)
    texts = [edited(base, 12, rng) for _ in range(600)]
    rows = [(bytes([k // 256, k % 256]), [int(x) for x in near_copies.shingles([w.encode() for w in t], 5).view(np.int64)]) for k, t in enumerate(texts)]
    sets = spark.createDataFrame(rows, "node binary, found array<long>")
    pairs = near_copies.by_rare_shingles(sets, sets.select("node", F.col("node").alias("root")))
    assert pairs.count() < 600


def test_rare_shingles_lose_no_pair(spark):
    """Pairs of random sets of all sizes against all pairs: none that is similar enough is missing."""
    rng = random.Random(3)
    base = [[rng.randrange(4000) for _ in range(rng.randrange(1, 60))] for _ in range(12)]
    sets = [sorted({x if rng.random() > 0.08 else rng.randrange(4000) for x in rng.choice(base)}) for _ in range(160)]
    rows = [(bytes([k]), s) for k, s in enumerate(sets)]
    roots = [(bytes([k]), bytes([k % 40])) for k in range(len(sets))]
    frame = spark.createDataFrame(rows, "node binary, found array<long>")
    pairs = near_copies.by_rare_shingles(frame, spark.createDataFrame(roots, "node binary, root binary"))
    got = {(r.a[0], r.b[0]) for r in pairs.collect()}
    similar_ = lambda a, b: 100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b))
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if i % 40 != j % 40 and similar_(sets[i], sets[j])}
    assert want and want <= got
    assert {(r.a[0], r.b[0]) for r in near_copies.linked(pairs, frame).collect()} == want


def test_a_crowd_below_a_link_makes_few_pairs(spark):
    """Sixty sets that share rare shingles with nearly all others, but are too unlike to link; of one there is a near copy."""
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 63, 210, np.int64).astype(np.uint64)
    crowd = [np.concatenate([pool[:90], rng.choice(pool[90:], 40, replace=False)]) for _ in range(60)]
    crowd.append(np.concatenate([crowd[7][:-5], rng.integers(0, 1 << 63, 5, np.int64).astype(np.uint64)]))
    sets = spark.createDataFrame([(bytes([k]), sorted(s.view(np.int64).tolist())) for k, s in enumerate(crowd)], "node binary, found array<long>")
    roots = sets.select("node", F.col("node").alias("root"))
    pairs = {(bytes(r.a)[0], bytes(r.b)[0]) for r in near_copies.by_rare_shingles(sets, roots).collect()}
    assert (7, 60) in pairs and len(pairs) < 20
    for a, b in ((a, b) for a in range(61) for b in range(a)):
        differ = np.bitwise_count((near_copies.parities(crowd[a]) ^ near_copies.parities(crowd[b])).view(np.uint64)).sum()
        assert differ <= len(np.setxor1d(crowd[a], crowd[b]))
