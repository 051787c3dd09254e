"""SimHash near-duplicates at a five-word similarity, by deletion-variant signatures of a long fingerprint.

Two texts are near copies if the Jaccard similarity of their sets of five-word shingles is
``SIMILARITY`` or more; every link is held against the sets themselves. Candidates come from a
SimHash of 512 bits over word pairs: an edited word touches five shingles of five words but two
pairs, so near copies differ in fewer bits of the latter. The fingerprint is cut into ``SEGMENTS``
segments of 32 bits, and texts that differ by at most one bit in one segment share a one-wildcard
variant of it, so an equality join meets them. Whether a pair has such a segment is chance: at a
similarity of 0.8 by scattered edits (about a tenth of the bits) over nine in ten pairs have one.

One long edit spoils many pairs at once, so such copies may share no variant. Each text is therefore also cut into parts at
words that their hash picks, some six to twelve and half as many, and texts meet that share one of each other's ``RAREST``
rarest parts: a run of a ninth of the words, the longest that leaves a similarity of 0.8, touches three parts at most.

Texts of the same words meet first, so a group of copies costs one row. Each text is
compared with the one that follows it in an order of the key's own, in its ``KEYS`` most shared keys
(variants or parts). What these links leave apart, though it shares a key, is compared by prefix filtering on the
shingles themselves: of two texts at 0.8 the smaller has one of its rarest ninth of shingles among the other's rarest fifth, so texts meet on rare shingles alone. That loses no
pair, needs no cap, and a large group of texts that are just not similar enough costs little, as their rare shingles are what they differ in.

Defined cases: texts that are null or have no words are copies of each other; those of fewer than
five words have one shingle, so they link to equal ones alone. A null id comes after any other;
repeated rows and ids are told apart by address. An empty table gives an empty result, and other
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from laneforge.llm.common import addressed, saved
from laneforge.llm.simhash import components
from laneforge.sources.shared import stored

SHINGLE, FEATURE = 5, 2
#: Least similarity of two linked texts, in hundredths.
SIMILARITY = 80
SEGMENTS, LONGS = 16, 8
#: Candidates differ in this many bits of 512 at most. At a similarity of 0.8 by one long edit, the worst
#: case, 77 are expected, with a deviation of 8; unrelated texts differ in more than 200.
REACH = 104
#: Variants, the most shared ones, in which a text is first compared with the one that follows it.
KEYS = 8
#: Words to a part of a text, by powers of two: parts at a level and at the next, and the rarest parts of a level that texts meet on.
LEAST_PART_BITS, PARTS_OF_TEXT, RAREST = 3, 6, 4
#: Rows of variants for a task.
TASK_ROWS = 2_000_000
#: Shingles whose bits are added up at once.
AT_ONCE = 1 << 11

#: Longs of the parities of a set: its shingles are dealt to this many times 64 bits, of which each tells whether it got an odd number.
PARITY_LONGS = 16

PARTS = [f"f{k}" for k in range(LONGS)]
PARITIES = [f"odd{k}" for k in range(PARITY_LONGS)]
SALTS = (np.arange(1, LONGS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(1, -1)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, each replaced by a well spread one (the finishing step of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: only A-Z change, only space and tab to carriage return part


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``size`` words; a shorter text is one run."""
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(w) for w in words], np.uint64)
    n = max(1, len(words) - size + 1)
    found = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        found = mixed(found * np.uint64(3) + own[k : k + n])
    return np.unique(found)


def levels(n: int) -> tuple[int, int]:
    """The levels of a text of ``n`` words: a word in 2^level ends a part. Texts that differ by a ninth in length share one."""
    first = max(LEAST_PART_BITS, (n // PARTS_OF_TEXT).bit_length() - 1)
    return first, first + 1


def parts_of(words: list[bytes]) -> list[int]:
    """Digests of the parts between words that their own hash picks, at two levels; the level is the lowest byte."""
    own = np.array([xxhash.xxh64_intdigest(w, 1) for w in words], np.uint64)
    found: set[int] = set()
    for level in levels(len(words)):
        ends = [*(np.flatnonzero(own & np.uint64((1 << level) - 1) == 0) + 1).tolist(), len(words)]
        first = 0
        for end in ends:
            if end > first:
                digest = xxhash.xxh3_64_intdigest(b" ".join(words[first:end]))
                found.add(digest >> 8 << 8 | level)
            first = end
    return sorted(found)


def fingerprint(features: np.ndarray) -> np.ndarray:
    """Eight longs: a bit is 1 if set in over half of the features' 512-bit hashes."""
    bits = np.zeros(64 * LONGS, np.int64)
    for first in range(0, len(features), AT_ONCE):
        hashes = mixed(features[first : first + AT_ONCE].reshape(-1, 1) + SALTS)
        bits += np.unpackbits(hashes.view(np.uint8), axis=1).sum(0, dtype=np.uint16)
    return np.packbits(2 * bits > len(features)).view(np.int64)


def prints(texts: DataFrame) -> DataFrame:
    """Of ``texts`` (place, text): ``place``, ``node`` (a digest of the words), ``tag`` (its first bytes), ``n`` shingles, ``parts``, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, parts, found = [], [], [], np.zeros((batch.num_rows, LONGS), np.int64)
            for at, text in enumerate(batch.column(1)):
                words = words_of(text.as_py() or b"")
                nodes.append(xxhash.xxh3_128_digest(b" ".join(words)))
                sizes.append(max(0, len(words) - SHINGLE + 1))
                parts.append(np.array(parts_of(words), np.uint64).view(np.int64))
                found[at] = fingerprint(shingles(words, FEATURE))
            tags = np.frombuffer(b"".join(nodes), np.int64)[::2]
            columns = [batch.column(0), pa.array(nodes, pa.binary()), pa.array(tags), pa.array(sizes, pa.int64()), pa.array(parts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(found[:, k].copy()) for k in range(LONGS)], names=["place", "node", "tag", "n", "parts", *PARTS])

    kind = texts.schema["place"].dataType.simpleString()
    longs = ", ".join(f"{p} long" for p in PARTS)
    return texts.select("place", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"place {kind}, node binary, tag long, n long, parts array<long>, {longs}")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """Of ``texts`` (node, text): ``node`` and ``found``, hashes of its distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(words_of(t.as_py() or b""), SHINGLE).view(np.int64) for t in batch.column(1)]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int64)
            found = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["node", "found"])

    return texts.select("node", F.col("text").cast("binary").alias("text")).mapInArrow(run, "node binary, found array<long>")


def parities(found: np.ndarray) -> np.ndarray:
    """Whether each bit got an odd number of the shingles. Two sets' parities differ in no more bits than the sets in shingles."""
    many = np.bincount((found.view(np.uint64) % np.uint64(64 * PARITY_LONGS)).astype(np.int64), minlength=64 * PARITY_LONGS)
    return np.packbits((many & 1).astype(np.uint8)).view(np.int64)


def parity_of(sets: DataFrame) -> DataFrame:
    """Of ``sets`` (node, found): ``node`` and the parities of what was found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = np.array([parities(found.values.to_numpy()) for found in batch.column(1)], np.int64).reshape(-1, PARITY_LONGS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(odd[:, k].copy()) for k in range(PARITY_LONGS))], names=["node", *PARITIES])

    return sets.select("node", "found").mapInArrow(run, "node binary, " + ", ".join(f"{p} long" for p in PARITIES))


def segment(part: Column, s: int) -> Column:
    """Of the long that holds the ``s``-th segment, that segment."""
    return F.shiftrightunsigned(part, 32) if s % 2 else part.bitwiseAND(F.lit(0xFFFFFFFF))


def variants(nodes: DataFrame) -> DataFrame:
    """``tag`` by each key: a segment, the place of its wildcard, and its other bits."""
    segments = [segment(F.col(PARTS[s // 2]), s).bitwiseOR(F.lit(s << 37)) for s in range(SEGMENTS)]
    keys = [F.col("segment").bitwiseAND(F.lit(~(1 << bit))).bitwiseOR(F.lit(bit << 32)) for bit in range(32)]
    return nodes.select("tag", F.explode(F.array(*segments)).alias("segment")).select("tag", F.explode(F.array(*keys)).alias("key"))


def tasks_for(nodes: DataFrame) -> int:
    """Tasks for the variants of ``nodes``."""
    return max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes.count() * SEGMENTS * 32 // TASK_ROWS)


def in_order(keyed: DataFrame) -> DataFrame:
    """Of ``keyed`` (key, tag) the keys that two texts or more share: ``key``, ``tag``, ``size`` (its texts) and ``next``, that follows in its order."""
    ordered = Window.partitionBy("key").orderBy(F.xxhash64("key", "tag"), "tag")
    around = [F.lag("tag").over(ordered).alias("before"), F.lead("tag").over(ordered).alias("next")]
    rows = keyed.select("key", "tag", *around).where("before IS NOT NULL OR next IS NOT NULL")
    return rows.drop("before").withColumn("size", F.count("*").over(Window.partitionBy("key")))


def shared_variants(nodes: DataFrame) -> DataFrame:
    """The variants that texts share, as ``in_order`` has them."""
    tasks = tasks_for(nodes)
    spread = nodes.select("tag", *PARTS).repartition(tasks, "tag")
    return stored(in_order(variants(spread).repartition(tasks, "key")))


def shared_parts(nodes: DataFrame) -> DataFrame:
    """The parts that texts share, as ``in_order`` has them: of each text and level those among its rarest.

    A part that no other text has is rarer than any, so it takes a place; a text with ``RAREST`` of them at a level has no copy by one edit there.
    """
    each = nodes.select("tag", F.explode("parts").alias("key"))
    often = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    own = nodes.select("tag", F.explode("parts").alias("key")).groupBy("tag", level_of("key")).agg(F.count("*").alias("all"))
    met = each.join(often, "key")
    rarest = Window.partitionBy("tag", "level").orderBy("n", "key")
    everywhere = Window.partitionBy("tag", "level")
    ranked = met.select("tag", "key", "n", level_of("key")).join(own, ["tag", "level"])
    ranked = ranked.withColumn("rank", F.row_number().over(rarest) + F.col("all") - F.count("*").over(everywhere))
    return stored(in_order(ranked.where(F.col("rank") <= RAREST).select("key", "tag")))


def level_of(key: str) -> Column:
    return F.col(key).bitwiseAND(F.lit(255)).alias("level")


def close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of ``pairs`` (x, y) of tags: ``a`` and ``b``, their nodes, if within reach of each other."""
    side = lambda name, tag: nodes.select(F.col("tag").alias(tag), F.struct("node", *PARTS).alias(name))
    both = pairs.join(side("p", "x"), "x").join(side("q", "y"), "y")
    return both.where(may_link("p", "q")).select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b"))


def apart(p: str, q: str) -> Column:
    """The number of bits that two fingerprints differ in."""
    return differing(p, q, PARTS)


def differing(p: str, q: str, fields: list[str]) -> Column:
    return sum((F.bit_count(F.col(f"{p}.{f}").bitwiseXOR(F.col(f"{q}.{f}"))) for f in fields), F.lit(0))


def may_link(p: str, q: str) -> Column:
    """True for different texts within reach of each other."""
    return (F.col(f"{p}.node") != F.col(f"{q}.node")) & (apart(p, q) <= REACH)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are as similar as a link asks, counted exactly."""
    one, two = (sets.select(F.col("node").alias(k), F.col("found").alias(f"_{k}")) for k in "ab")
    common, total = F.size(F.array_intersect("_a", "_b")), F.size("_a") + F.size("_b")
    return pairs.select("a", "b").join(one, "a").join(two, "b").where(common * (100 + SIMILARITY) >= total * SIMILARITY).select("a", "b")


def sets_of(chosen: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The shingle sets of the ``chosen`` nodes."""
    places = nodes.join(chosen, "node", "left_semi").select("node", F.col("least").alias("place"))
    return saved(shingle_sets(texts.join(places, "place").select("node", "text")))


def verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links among ``pairs`` (a, b) of nodes."""
    within = saved(pairs)
    sets = sets_of(within.select(F.explode(F.array("a", "b")).alias("node")).distinct(), texts, nodes)
    return saved(linked(within, sets))


def apart_still(shared: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``node``, ``root`` of texts that share a key with a text of another component."""
    named = nodes.join(roots, "node", "left").select("tag", "node", F.coalesce("root", "node").alias("root"))
    rows = shared.select("key", "tag").join(named.select("tag", F.xxhash64("root").alias("r")), "tag")
    by_key = Window.partitionBy("key")
    tags = rows.select("tag", (F.min("r").over(by_key) < F.max("r").over(by_key)).alias("apart")).where("apart").select("tag").distinct()
    return saved(named.join(tags, "tag", "left_semi").select("node", "root"))


def by_rare_shingles(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may be similar enough: all that are, among ``sets`` (node, found).

    As similar as a link asks, the smaller set has 2 t / (1 + t) of its shingles in common with the other, and the larger a share of t. So in any
    one order of all shingles they meet in those beyond these shares of each, and where they meet first, enough have to follow in both. The
    order is by rarity: a text with so many shingles of its own meets nobody. Those that meet are told apart by their parities, which bound what
    the sets have in common from above, so most of a crowd just below a link never become pairs.
    """
    size = F.size("found")
    beyond = lambda part, whole: (size - F.ceil(size * part / whole) + 1).cast("int")
    firsts = [beyond(SIMILARITY, 100).alias("first"), beyond(2 * SIMILARITY, 100 + SIMILARITY).alias("as_smaller")]
    rows = sets.select("node", size.alias("n"), *firsts, F.explode("found").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1")
    met = rows.join(often, "shingle")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("texts", "shingle"))
    own = F.col("n") - F.count("*").over(Window.partitionBy("node"))
    rare = met.withColumn("rank", rank + own).where("rank <= first").join(roots, "node")
    rare = rare.withColumn("size", F.count("*").over(Window.partitionBy("shingle", "root")))
    by_shingle = Window.partitionBy("shingle")
    main = F.max_by("root", F.struct("size", "root")).over(by_shingle)
    several = rare.withColumns({"main": main, "least": F.min("root").over(by_shingle), "most": F.max("root").over(by_shingle)}).where("least < most")
    kept = ["shingle", "node", "n", "rank", (F.col("rank") <= F.col("as_smaller")).alias("early"), "root"]
    rare = several.select(*kept, (F.col("root") == F.col("main")).alias("in_main"))
    rare = saved(rare.join(parity_of(sets), "node"))
    told = ["node", "n", "rank", "early", "root", *PARITIES]
    few = rare.where("NOT in_main").select("shingle", F.struct(*told).alias("p"))
    others = rare.select("shingle", F.struct(*told).alias("q"), "in_main")
    smaller_early = F.when(F.col("p.n") < F.col("q.n"), F.col("p.early")).when(F.col("p.n") > F.col("q.n"), F.col("q.early")).otherwise(F.col("p.early") & F.col("q.early"))
    common = 1 + F.least(F.col("p.n") - F.col("p.rank"), F.col("q.n") - F.col("q.rank"))
    enough = common * (100 + SIMILARITY) >= (F.col("p.n") + F.col("q.n")) * SIMILARITY
    once = F.col("in_main") | (F.col("p.node") < F.col("q.node"))
    total = F.col("p.n") + F.col("q.n")
    may_be = (total - differing("p", "q", PARITIES)) * (100 + SIMILARITY) >= 2 * SIMILARITY * total
    pairs = few.join(others, "shingle").where((F.col("p.root") != F.col("q.root")) & smaller_early & enough & once & may_be)
    return pairs.select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()


def roots_of(texts: DataFrame, nodes: DataFrame, keys: int = KEYS) -> DataFrame:
    """``node`` and ``root`` of texts that have links. ``texts`` (place, text) holds the text of every ``nodes.least``."""
    worded = nodes.where(F.col("n") > 0)
    shared = shared_variants(worded).unionByName(shared_parts(worded))
    largest = Window.partitionBy("tag").orderBy(F.desc("size"), F.xxhash64("key", "tag"), "key")
    few = shared.withColumn("rank", F.row_number().over(largest)).where(F.col("rank") <= keys).where("next IS NOT NULL")
    followers = few.select(F.least("tag", "next").alias("x"), F.greatest("tag", "next").alias("y")).distinct()
    sure = verified(close(followers, nodes), texts, nodes)
    left = apart_still(shared, nodes, saved(components(sure)))
    sets = sets_of(left.select("node"), texts, nodes)
    more = saved(linked(saved(by_rare_shingles(sets, left)), sets))
    return components(sure.unionByName(more))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", is_table: bool = False, keys: int = KEYS) -> DataFrame:
    """One document of each group that links connect: the one with the smallest id; any id comes before null.

    If that id stands on several rows of the group, the first of them by address stays.
    """
    told, address = addressed(docs, is_table)
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), *(F.col(k).alias(a) for k, a in zip(address, ("file", "at"))))
    texts = told.select(place.alias("place"), F.col(text).alias("text"))
    nodes = saved(prints(texts).groupBy("node", "tag", "n", *PARTS).agg(F.min("place").alias("least"), F.first("parts").alias("parts")))
    roots = roots_of(texts, nodes, keys)
    whole = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    chosen = saved(whole.select(*(F.col(f"least.{a}").alias(k) for k, a in zip(address, ("file", "at")))))
    return told.join(chosen, address, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
