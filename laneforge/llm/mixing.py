"""Mixing sources to target weights by cube-method balanced sampling.

A source's target is its share of all words by weight, at most ``MAX_REPEATS`` times its size. A
document of the source is then taken ``target / size`` times on average: the whole part always, the
rest with a chance. The flight phase moves the chances of three documents at a time along the
null-space of the balance equations (documents, words) until one of them is certain, so both totals
stay as they are. Long documents come first, so what stays undecided is short. It runs in blocks of a
source; two undecided documents at most stay of a block and meet in fewer blocks in the next round, until
the source has one block. What is then undecided (two documents a source at most) lands to the side nearest
the target, and documents of that last block change one or two at a time as long as that comes nearer.

Defined cases: a null text has size 0, and so has a blank one; a source of size 0 takes nothing. The null
source comes last. Repeated rows each have their own chance. Blocks, the order within them and draws come from
hashes of the row's id, size, CRC and its number among rows alike in these, so reruns agree over any layout of
the table, and rows alike spread over all blocks. Rows are told apart by their address in the table. An empty
table gives an empty result. Other columns pass through ``mix``. The table of sources, a row for each, is ranked in
one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laneforge.llm.common import addressed, count_words, numbered_within, saved, text_crc32, unused

MAX_REPEATS = 3
#: Rows of a block of the flight phase.
BLOCK = 5000
EPSILON = 1e-9


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of source and size.

    One row a source: those whose cap is smallest for their weight are full first, and the others
    share what is left by weight.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(order) - 1) % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(MAX_REPEATS)).withColumn("fill", F.col("cap") / F.col("weight"))
    filled = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before, since, whole = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    shared = ranked.withColumn("level", left / F.sum("weight").over(since))
    full = F.col("fill") <= F.col("level")
    level = F.max(F.when(~full, F.col("level"))).over(whole)
    target = F.when(full, F.col("cap")).otherwise(F.col("weight") * level)
    return shared.select("source", "source_size", "source_rows", F.coalesce(target, F.lit(0.0)).alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Chances after the flight phase: 0, 1, or undecided for two rows at most.

    Rows enter one by one; of three undecided rows a step moves along the vector that changes
    neither the sum of chances nor that of chances times size. ``draws`` decides the direction.
    """
    out = chance.copy()
    live: list[int] = []
    for i in range(len(out)):
        if EPSILON < out[i] < 1 - EPSILON:
            live.append(i)
        if len(live) < 3:
            continue
        a, b, c = live
        u = (float(size[c] - size[b]), float(size[a] - size[c]), float(size[b] - size[a]))
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - out[k]) / v if v > 0 else out[k] / -v for k, v in zip(live, u) if v)
        down = min(out[k] / v if v > 0 else (1 - out[k]) / -v for k, v in zip(live, u) if v)
        step = up if draws[i] * (up + down) < down else -down
        for k, v in zip(live, u):
            out[k] = min(1.0, max(0.0, out[k] + step * v))
        live = [k for k in live if EPSILON < out[k] < 1 - EPSILON]
    return np.where(out <= EPSILON, 0.0, np.where(out >= 1 - EPSILON, 1.0, out))


def landing(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Certain chances: of all ways to decide the undecided rows, the one nearest to their total.

    What is then left of the difference in words is taken up by changing rows, one or two at a time.
    """
    open_rows = np.flatnonzero((chance > 0) & (chance < 1))
    want = (chance[open_rows] * size[open_rows]).sum()
    ways = range(1 << len(open_rows))
    total = lambda w: sum(int(size[k]) for j, k in enumerate(open_rows) if w >> j & 1)
    best = min(ways, key=lambda w: (abs(total(w) - want), w))
    out = chance.copy()
    out[open_rows] = [float(best >> j & 1) for j in range(len(open_rows))]
    short = want - total(best)
    while chosen := nearest(np.where(out == 0, size, -size), short):
        for k in chosen:
            short -= size[k] if out[k] == 0 else -size[k]
            out[k] = 1 - out[k]
    return out


def nearest(gains: np.ndarray, short: float) -> tuple[int, ...]:
    """The row or pair of rows whose gains come nearest to ``short``; none if doing nothing is as near."""
    if not len(gains):
        return ()
    order = np.argsort(gains, kind="stable")
    ranked = gains[order]
    one = int(np.abs(short - gains).argmin())
    options = [(abs(short) - EPSILON, ()), (abs(short - gains[one]), (one,))]
    place = np.searchsorted(ranked, short - ranked)
    for step in (-1, 0, 1):
        other = np.clip(place + step, 0, len(ranked) - 1)
        off = np.where(other == np.arange(len(ranked)), np.inf, np.abs(short - ranked - ranked[other]))
        k = int(off.argmin())
        options.append((off[k], (int(order[k]), int(order[other[k]]))))
    return min(options, key=lambda o: (o[0], len(o[1])))[1]


def move(most: int):
    """The flight of a block; a source that has no more than one block of ``most`` rows lands at once."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "h", "file", "at"], ascending=[False, True, True, True])
        size = block["size"].to_numpy(np.int64)
        mixed = block["h"].to_numpy(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # rows of one size come in order of h
        draws = (mixed >> np.uint64(11)) * 2.0**-53
        chance = flight(block["chance"].to_numpy(float), size, draws)
        block["chance"] = landing(chance, size) if block["source_rows"].iloc[0] <= most else chance
        return block.drop(columns="block")

    return run


COLUMNS = "file long, at long, source_key long, size long, h long, chance double, source_rows long"


def decided(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Address and ``chance`` (0 or 1) from rows of ``COLUMNS``; one round of blocks after the other."""
    done: list[DataFrame] = []
    count = "source_rows"
    most = rows.agg(F.max(count)).first()[0] or 0
    k = 0
    while True:
        last = most <= block
        blocks = F.ceil(F.col(count) / block)
        keyed = rows.withColumn("block", F.pmod(F.xxhash64("h", F.lit(k)), blocks))
        moved = saved(keyed.groupBy("source_key", "block").applyInPandas(move(block), COLUMNS))
        certain = (F.col("chance") == 0) | (F.col("chance") == 1)
        done.append(moved.where(certain).select("file", "at", "chance"))
        if last:
            break
        # two rows of each block at most are left
        rows = moved.where(~certain).withColumn(count, 2 * F.ceil(F.col(count) / block))
        most = 2 * -(-most // block)
        k += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def copies(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), block: int = BLOCK, is_table: bool = False) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``copies`` for each row of ``docs``, and its address ``file``, ``at``."""
    told, keys = addressed(docs, is_table)
    return copies_of(told, keys, weights, block)


def copies_of(told: DataFrame, keys: list[str], weights: tuple[float, ...], block: int) -> DataFrame:
    """``copies`` for rows that have the address ``keys``."""
    narrow = saved(told.select("doc_id", "source", count_words(F.col("text")).alias("size"), text_crc32(F.col("text")).alias("crc"), *(F.col(k).alias(a) for k, a in zip(keys, ("file", "at")))))
    shares = saved(targets(narrow.select("source", "size"), weights).withColumn("source_key", F.xxhash64("source", F.col("source").isNull())))
    rated = narrow.join(shares, narrow["source"].eqNullSafe(shares["source"])).drop(shares["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = rated.withColumn("whole", F.floor(rate + EPSILON)).withColumn("chance", F.greatest(F.lit(0.0), rate - F.col("whole")))
    part = rated.where(F.col("chance") > 0).withColumn("same", F.xxhash64("source_key", "doc_id", "size", "crc"))
    part = numbered_within(part.select("file", "at", "source_key", "size", "same", "chance", "source_rows"), "same", "copy", ["file", "at"])
    part = saved(part.select("file", "at", "source_key", "size", F.xxhash64("same", "copy").alias("h"), "chance", "source_rows"))
    drawn = decided(part, block).withColumnRenamed("chance", "drawn")
    out = rated.join(drawn, ["file", "at"], "left")
    return out.select("file", "at", "doc_id", "size", "source_size", "target", (F.col("whole") + F.coalesce("drawn", F.lit(0.0))).cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), is_table: bool = False) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, in the columns of ``docs``."""
    told, keys = addressed(docs, is_table)
    many, copy = unused(told, "copies"), unused(told, "copy")
    taken = copies_of(told.select("doc_id", "source", "text", *keys), keys, weights, BLOCK).where("copies > 0")
    taken = taken.select(F.col("file").alias(keys[0]), F.col("at").alias(keys[1]), F.col("copies").alias(many))
    held = told.join(taken, keys)
    return held.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*(F.col(f"`{c}`") for c in docs.columns))


def mixed(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document of a stored table."""
    return copies(docs, is_table=True).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
