"""Runs of repeated words: stretches that go on with one period, found and folded to their first period.

A run is a stretch of words with smallest period q (words q apart are the same), of ``LEAST`` words
and two periods or more, that no neighbouring word extends. Recursive frequency splitting finds where runs can be: each word of a run
occurs twice in it at least, so a word that its segment has only once can be in no run of it and splits it.
All segments of a text are split together, level by level, until nothing splits; those too short for a run are dropped on the way.

The surviving segments are scanned by lag. Words that a run with period q matches with those q later
are a stretch of at least q (and ``LEAST`` - q), so for each lag only every few words are looked at, some eight to a period; where all of such a
stretch match, it is measured word by word. A lag that is a multiple of a run's period is not measured inside that run again. So a segment of n words costs n log n
comparisons, and not the square of n.

Each text is worked on alone and whole, in the task that holds it; nothing is shuffled.
Defined cases: a null or blank text has no words and no runs; a null id leaves the text as it is;
repeated rows each have a result; other columns pass through ``collapse`` and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneforge.llm.common import unused

#: A run's least words, and how often its period has to fit.
LEAST, FOLDS = 12, 2
#: Words looked at in the shortest stretch that a lag may match.
LOOKS = 8


def numbers_of(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """Where runs can be: first word and end of each segment that frequency splitting leaves."""
    places, label = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    words = int(ids.max()) + 1 if len(ids) else 0
    while len(places):
        _, where, counts = np.unique(label * words + ids[places], return_inverse=True, return_counts=True)
        often = counts[where] >= FOLDS
        kept, label = places[often], label[often]
        if not len(kept):
            return []
        # a new segment starts where a word was dropped or the old segment ends
        starts = np.flatnonzero(np.diff(kept, prepend=-2) != 1)
        starts = np.union1d(starts, np.flatnonzero(np.diff(label, prepend=-1)))
        sizes = np.diff(starts, append=len(kept))
        long = np.repeat(sizes >= LEAST, sizes)
        label = np.repeat(np.arange(len(starts)), sizes)[long]
        stable = len(kept) == len(places) and long.all()
        places = kept[long]
        if stable:
            return [(int(kept[s]), int(kept[s]) + int(n)) for s, n in zip(starts, sizes)]
    return []


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(same.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def scan(ids: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) inside a segment, by lag."""
    part, n = ids[lo:hi], hi - lo
    found: dict[tuple[int, int], int] = {}
    known = np.zeros((0, 3), np.int64)  # start, end, period of runs in which a multiple of the period fits too
    for q in range(1, n // FOLDS + 1):
        least = max((FOLDS - 1) * q, LEAST - q)  # words that match those q later
        step = max(1, least // LOOKS)
        firsts, ends = stretches(part[: n - q : step] == part[q::step])
        for first, end in zip(firsts.tolist(), ends.tolist()):
            if end - first < least // step:
                continue
            a, b = first * step, (end - 1) * step + 1  # both ends match; the stretch goes on for less than a step
            if ((known[:, 0] <= a) & (known[:, 1] >= b + q) & (q % known[:, 2] == 0)).any():
                continue
            left, right = max(0, a - step + 1), min(n - q, b + step - 1)
            same = part[left:right] == part[left + q : right + q]
            for s, e in zip(*(x.tolist() for x in stretches(same))):
                start, stop = left + s, left + e + q
                if e - s >= least and (start, stop) not in found:
                    found[start, stop] = q
                    if stop - start >= 2 * FOLDS * q:
                        known = np.vstack([known, [(start, stop, q)]])
    return [(lo + s, e - s, q) for (s, e), q in found.items()]


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a text's words, by start, then period."""
    ids = numbers_of(words)
    return sorted((r for lo, hi in segments(ids) for r in scan(ids, lo, hi)), key=lambda r: (r[0], r[2]))


def folded(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone)) if g == 0]


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words that are made periodic for one document in ten, by a hash of its id."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def run_digests(docs: DataFrame) -> DataFrame:
    """Runs of each document, its words made periodic by ``repeated``: the longest, and digests of all and of what is kept."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = repeated((text.as_py() or b"").split(), doc_id.as_py())  # bytes part at space and tab to carriage return alone
                runs = runs_of(words)
                start, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
                kept = b" ".join(folded(words, runs))
                rows.append((len(runs), start, length, q, None if q is None else 1000 * length // q, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[k] for r in rows], pa.int64() if k < 5 else pa.string()) for k in range(7)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in names[1:6])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, {longs}, runs_sha256 string, collapsed_sha256 string")


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with texts whose runs are folded to their first period, words joined by one space, and ``runs``, what was found.

    A text without runs stays as it is. An input column ``runs`` keeps its name; the new one then has an underscore before it.
    """
    added = unused(docs, "runs")
    kinds = [(f.name, f.dataType.simpleString()) for f in docs.schema.fields] + [(added, "array<struct<start:long,length:long,period:long>>")]
    at, shape = docs.columns.index(text), pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, found = [], []
            for value in batch.column(at):
                words = (value.as_py() or "").encode().split()
                runs = runs_of(words)
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                out.append(b" ".join(folded(words, runs)).decode() if runs else value.as_py())
            columns = [pa.array(out, pa.string()) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, shape)], names=[name for name, _ in kinds])

    return docs.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in kinds))
