"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments of 32. Of three differing bits at most one falls
in one of the two, so two linked fingerprints agree on a segment with one bit wildcarded: an
equality join on one-wildcard segment variants finds every link, and each candidate is verified.

Exact and fingerprint copies meet first, as rows of distinct fingerprints, so a group of copies
costs one row. Variants shared by more than ``HOT`` fingerprints don't join their members with each
other: there each fingerprint goes to keys whose members all lie within three bits of each other
(a wildcard or a shared midpoint on each part), and every member links to the key's smallest. Such
keys are found for every link, so no link between different fingerprints loses its connection.

Defined cases: a null or blank text has fingerprint zero and links like any other; texts of one or
two words make one shingle. Repeated rows and ids fall in one component. A null id is never the
smallest of its component unless it has no other. An empty table gives an empty result. Other
columns pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from laneforge.llm.common import addressed, saved, shuffled, unused
from laneforge.sources.shared import stored

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints that share a variant and are still joined with each other.
HOT = 1000
#: Bits that are turned in all fingerprints before their star keys are hashed, by round.
SALTS = (0, 0x5555555555555555, 0x3333333333333333)
#: Hashes whose bits are added up at once.
AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's UTF-8 bytes: a bit is 1 if set in over half of the shingles' hashes."""
    words = text.lower().split()  # bytes: only A-Z change, only space and tab to carriage return part
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for first in range(0, n, AT_ONCE):
        last = min(n, first + AT_ONCE)
        parts = [words[first + k : last + k] for k in range(min(shingle, len(words)))]
        hashes = np.array([digest(b" ".join(s), SEED) for s in zip(*parts)], ">u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t or b"", shingle) for t in batch.column("_text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("_text")).mapInArrow(run, f"id {kind}, fp long")


def segment(fp: Column, which: int) -> Column:
    return (F.shiftrightunsigned(fp, 32) if which == 0 else fp).bitwiseAND(F.lit(0xFFFFFFFF))


def variants(fps: DataFrame) -> DataFrame:
    """``fp`` by each key: a segment, the place of its wildcard, and its other bits."""
    masks = [(which << 5 | bit, which, 0xFFFFFFFF ^ (1 << bit)) for which in (0, 1) for bit in range(32)]
    keys = [F.lit(tag << 32).bitwiseOR(segment(F.col("fp"), which).bitwiseAND(F.lit(mask))) for tag, which, mask in masks]
    return spread(fps).select("fp", F.explode(F.array(*keys)).alias("key"))


def spread(fps: DataFrame) -> DataFrame:
    """Short rows that are about to become many, over as many tasks as a shuffle has."""
    return fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def first_meeting(a: Column, b: Column, key: Column) -> Column:
    """True at the one key, of those that two fingerprints share, where their link is to be told."""
    x = a.bitwiseXOR(b)
    high, low = segment(x, 0), segment(x, 1)
    tag = F.shiftright(key, 32)
    wildcard = lambda part, first: F.when(part == 0, F.lit(first)).otherwise(F.lit(first) + F.bit_count(part - 1))
    return tag == F.when(F.bit_count(high) <= 1, wildcard(high, 0)).otherwise(wildcard(low, 32))


def near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs ``a < b`` that connect exactly the fingerprints that links connect."""
    keyed = variants(fps)
    sizes = keyed.groupBy("key").count().where("count > 1")
    shared = saved(keyed.join(shuffled(sizes), "key"))
    pairs = shared.where(F.col("count") <= hot).select("key", F.col("fp").alias("a"))
    other = shared.where(F.col("count") <= hot).select("key", F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    cold = pairs.join(other, "key").where((a < b) & near(a, b) & first_meeting(a, b, F.col("key"))).select("a", "b")
    crowded = shared.where(F.col("count") > hot).select("fp").distinct()
    return cold.unionByName(star_links(crowded)).distinct()


def star_links(fps: DataFrame, salt: int = 0) -> DataFrame:
    """Links from each fingerprint to the smallest of every star key that it has with others.

    Keys are hashes, so a stranger may share one by chance: links are verified, and those whom the
    smallest doesn't suit link to the largest. Where neither suits, all members of the key meet again under other hashes, those
    of the fingerprints with some bits turned in all; that a stranger shares a key each of ``SALTS`` times is past all chance.
    """
    turned = F.col("fp").bitwiseXOR(F.lit(SALTS[salt]))
    named = spread(fps).select("fp", F.explode(star_keys(turned)).alias("key"))
    ends = named.groupBy("key").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most")
    fp, least, most = F.col("fp"), F.col("least"), F.col("most")
    other = F.when(near(least, fp), least).when(near(most, fp), most)
    met, seen = named.join(shuffled(ends), "key").withColumn("other", other), Observation()
    sure = met.observe(seen, F.count_if(F.col("other").isNull()).alias("strangers")).where("other IS NOT NULL")
    found = stored(sure.select(F.least("other", "fp").alias("a"), F.greatest("other", "fp").alias("b")).where("a < b").distinct(), "stars")
    if not seen.get["strangers"] or salt + 1 == len(SALTS):
        return found
    crossed = met.where("other IS NULL").select("key").distinct()
    again = stored(named.join(shuffled(crossed), "key", "left_semi").select("fp").distinct(), "crossed")
    return found.unionByName(star_links(again, salt + 1)).distinct()


def ball(part: Column, bits: int) -> Column:
    """A part of a fingerprint and all that differ from it in one bit: two parts within two bits share one."""
    return F.array(part, *(part.bitwiseXOR(F.lit(1 << k)) for k in range(bits)))


def wild(part: Column, bits: int) -> Column:
    """A part with each bit wildcarded in turn, and marked with the bit's place."""
    return F.array(*(part.bitwiseAND(F.lit(((1 << bits) - 1) ^ (1 << k))).bitwiseOR(F.lit(k << bits)) for k in range(bits)))


def without(start: int, size: int) -> int:
    """A mask of 64 bits, as a signed long, that clears ``size`` bits from ``start``."""
    mask = ~(((1 << size) - 1) << start) & ((1 << 64) - 1)
    return mask - (1 << 64) if mask >> 63 else mask


def star_keys(fp: Column) -> Column:
    """Keys such that those who share one are within three bits, and those within three bits share one.

    Three differing bits split over two halves as 1 and 2, in either order: a wildcard on one half
    and a midpoint on the other meet. All three in one half split so over its quarters, and so on,
    down to parts of one bit, which can't hold two.
    """
    found: list[Column] = []

    def cut(offset: int, bits: int) -> None:
        half = bits // 2
        part = lambda start, size: F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << size) - 1))
        rest = fp.bitwiseAND(F.lit(without(offset, bits)))
        low, high = part(offset, half), part(offset + half, half)
        for tag, (one, two) in enumerate(((low, high), (high, low))):
            label = F.lit(f"{offset}.{bits}.{tag}")
            found.append(F.flatten(F.transform(wild(one, half), lambda w: F.transform(ball(two, half), lambda m: F.xxhash64(label, rest, w, m)))))
        if half >= 4:
            cut(offset, half)
            cut(offset + half, half)
        elif half > 1:
            for start in (offset, offset + half):
                found.append(F.array(F.xxhash64(F.lit(f"{start}.all"), fp.bitwiseAND(F.lit(without(start, half))))))

    cut(0, 64)
    return F.flatten(F.array(*found))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, its smallest reachable node, for the nodes of ``edges`` (a, b).

    Rounds of large-star and small-star: neighbours move to the smallest node known, until every
    edge ends in a root. Each round is written to the shared folder.
    """
    known = saved(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct())
    while True:
        both = known.unionByName(known.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = both.join(least, "hi").where(F.col("lo") > F.col("hi")).select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        under = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(under, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        then = saved(small.unionByName(under.select("hi", F.col("m").alias("lo"))).distinct())
        known = then
        ends = known.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(known.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        loose = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up > 0 and down > 0")
        if loose.isEmpty():
            return known.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def rooted(prints: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Of ``prints`` (id, fp): ``fp`` and ``root``, its component's smallest fingerprint, and ``root`` and ``component``, the smallest id."""
    distinct = saved(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(distinct.select("fp"), hot))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return member, member.groupBy("root").agg(F.min("least").alias("component"))


def grouped(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", id_col: str = "doc_id", hot: int = HOT) -> DataFrame:
    """``id``, ``fp`` and ``component``, the smallest id that links reach from it."""
    prints = saved(fingerprints(docs, shingle, text, id_col))
    member, smallest = rooted(prints, hot)
    named = member.join(smallest, "root").select("fp", "component")
    return prints.join(named, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text: str = "text", is_table: bool = False) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id; any id comes before null.

    If that id stands on several rows of the group, the first of them by address stays.
    """
    told, keys = addressed(docs, is_table)
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), *(F.col(k).alias(a) for k, a in zip(keys, ("file", "at"))))
    prints = saved(fingerprints(told.select(place.alias("place"), F.col(text).alias("text")), shingle, "text", "place"))
    _, smallest = rooted(prints)
    chosen = saved(smallest.select(*(F.col(f"component.{a}").alias(k) for k, a in zip(keys, ("file", "at")))))
    return told.join(chosen, keys, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def clusters(docs: DataFrame) -> DataFrame:
    """Fingerprint and component by document."""
    return grouped(docs).select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
