"""An interpolated modified Kneser-Ney model, counted by Spark and memory-mapped by workers.

Words are numbered through a sorted array of their 64-bit hashes. A pair of words is one 64-bit key of
two numbers, and pairs lie in an array sorted by the key's (reversible) hash; the words after a pair
lie behind it in a second array. Training has three passes over compressed blocks of sorted keys:

1. words: each task counts them and sends blocks by range of hashes; a range adds its blocks up;
2. trigrams: each task counts them and sends blocks by range of the first pair's hash; a range adds
   them up and writes its pairs, the words after each and their counts;
3. pairs and words: continuation counts go on as blocks to the ranges of pairs, and from these to
   those of words, which also take the totals by first word. With ``order`` 2 pairs are counted in
   place of trigrams.

How it grows: the number of ranges follows the bytes of the corpus, so a range fits in memory whatever
the corpus. A task sends ``FAN`` blocks at most for each ``BLOCK_TOKENS`` tokens; beyond ``FAN`` ranges the
blocks go on to finer ranges in a further round, so the number of blocks a token has stays bounded. Files
hold ``BUNDLES`` runs of ranges at most; a worker keeps all of them mapped, and a batch of a million tokens
visits each once, with its keys in order. Tables of counts have a byte a value, larger values apart.

The arrays lie in the folder of ``spark.checkpoint.dir``, which must be mounted on the workers for mapping;
``model_dir`` names another. ``scored`` stores its narrow result and then removes the model, unless
``model_dir`` asks to keep it.

Defined cases: a null text counts as empty and is scored as its end token alone. A null id
belongs to the training part. A word that training lacks gets the uniform share of the
lowest order; after a context that training lacks the lower order counts alone. With an empty
training part every token has the uniform share of one class. Repeated rows count each time.
"""

from __future__ import annotations

import mmap
import os
import shutil
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneforge.llm.common import saved
from laneforge.sources.shared import shared_dir

#: Hashed as the end token; holds a space, so no word is equal.
END = b" end"
#: Tokens that a task counts before it sends blocks, and bytes of text for each range of the model.
BLOCK_TOKENS, RANGE_BYTES = 2_000_000, 16_000_000
#: Keys of a range that are held as they came before equal ones are put together.
MERGE_KEYS = 1 << 20
#: Bits of the most ranges that blocks are dealt to at once, and of the most files of a kind.
FAN_BITS, BUNDLE_BITS = 12, 10
#: Bytes of texts whose words are told apart at once; a longer text is split by itself.
PIECE_BYTES = 1 << 19
#: Stand in keys for the start of a text, for words that training lacks, and for "no word follows".
BEGIN, OTHER, NOTHING = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFE), np.uint32(0xFFFFFFFF)
START = BEGIN << np.uint64(32) | BEGIN
LOW = np.uint64(0xFFFFFFFF)
UNKNOWN = np.int64(-1)
#: An odd factor, whose product modulo 2^64 can be undone, and what undoes it.
MIX = np.uint64(0x9E3779B97F4A7C15)
UNMIX = np.uint64(pow(int(MIX), -1, 1 << 64))
#: Pairs whose lengths are added up to find where the words after one begin; pairs with more words after them have their totals stored.
STEP, WIDE = 8, 16


class Sizes(NamedTuple):
    """What tasks need to know of a model beside its arrays; ``starts`` has the first word number of each bundle."""

    path: str
    bits: int
    bundle_bits: int
    starts: tuple[int, ...]
    tokens: int
    words: int
    order: int = 3


# ---- tokens and words --------------------------------------------------------------------


def tokens(text: bytes) -> list[bytes]:
    """Words of a text's UTF-8 bytes, A-Z in lower case, and the end token."""
    return [*text.lower().split(), END]


SPACES = np.isin(np.arange(256), [32, *range(9, 14)])
BYTES = np.random.default_rng(64).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """An odd number's powers modulo 2^64, and those of what undoes it."""
    return tuple(np.concatenate([[np.uint64(1)], np.full(2 * PIECE_BYTES, x).cumprod(dtype=np.uint64)]) for x in (MIX, UNMIX))


def hashes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of some texts, one after the other, and how many each has.

    Words are told apart by a polynomial of their bytes, so that each distinct one is hashed once; that words of one polynomial are the same
    is then checked by byte.
    """
    joined = b"\n".join(texts).lower()
    if len(joined) > 2 * PIECE_BYTES:
        words = [w for t in texts for w in tokens(t)]
        return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64), np.array([len(tokens(t)) for t in texts])
    data = np.frombuffer(joined, np.uint8)
    edges = np.diff(np.concatenate([[0], ~SPACES[data], [0]]).astype(np.int8))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    upto = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    own = np.full(len(start) + len(texts), xxhash.xxh64_intdigest(END), np.uint64)
    lengths = np.diff(upto, prepend=0) + 1
    at = np.ones(len(own), bool)
    at[np.cumsum(lengths) - 1] = False
    up, down = powers()
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[data] * up[: len(data)], dtype=np.uint64)])
    alike, back, first = distinct((sums[end] - sums[start]) * down[start], True)
    size, place = end - start, start[first]
    shift = np.repeat(place[back] - start, size)
    body = ragged(start, end)
    if (size == size[first][back]).all() and (data[body] == data[body + shift]).all():
        found = [xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(place.tolist(), end[first].tolist())]
        own[at] = np.array(found, np.uint64)[back]
    else:
        own[at] = [xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(start.tolist(), end.tolist())]
    return own, lengths


def runs_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Hashes of the tokens of whole texts, lengths of the texts, and what else their rows hold, up to about ``most`` tokens at a time."""
    hashes, lengths, rows, n = [], [], [], 0
    piece, size, limit = [], 0, min(PIECE_BYTES, 2 * most)
    for batch in batches:
        others = batch.drop_columns(["_text"]).to_pylist() if batch.num_columns > 1 else [None] * len(batch)
        for text, other in zip(batch.column("_text").to_pylist(), others, strict=True):
            piece.append(text or b"")
            rows.append(other)
            size += len(piece[-1]) + 1
            if size >= limit:
                own, many = hashes_of(piece)
                hashes.append(own)
                lengths.append(many)
                n += len(own)
                piece, size = [], 0
            if n >= most:
                yield np.concatenate(hashes), np.concatenate(lengths), rows
                hashes, lengths, rows, n = [], [], [], 0
    if rows:
        if piece:
            own, many = hashes_of(piece)
            hashes.append(own)
            lengths.append(many)
        yield np.concatenate(hashes), np.concatenate(lengths), rows


# ---- order -------------------------------------------------------------------------------


def order_of(*keys: np.ndarray) -> np.ndarray:
    """The order of unsigned numbers, by the first key, then the second; equal ones stay as they come.

    Each number is sorted with its place in the lower bits, which is several times as quick as an indirect sort; what
    doesn't fit 64 bits with its place goes by halves.
    """
    if len(keys) > 1:
        order = order_of(*keys[1:])
        return order[order_of(keys[0][order])]
    (values,) = keys
    bits = np.uint64(len(values).bit_length())
    if not len(values):
        return np.empty(0, np.int64)
    if bits > 32:
        return np.argsort(values, kind="stable")
    if int(values.max()).bit_length() + int(bits) > 64:
        return order_of(values >> np.uint64(32), values & LOW)
    packed = values.astype(np.uint64) << bits | np.arange(len(values), dtype=np.uint64)
    packed.sort()
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def distinct(hashes: np.ndarray, with_first: bool = False) -> tuple[np.ndarray, ...]:
    """The distinct values of spread numbers in order, and for each number which of these it is (and, if asked for, where each first stands)."""
    bits = np.uint64(len(hashes).bit_length())
    # by the upper bits, which are nearly always enough
    packed = hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    values = hashes[order]
    if (values[1:] < values[:-1]).any():
        order = order_of(hashes)
        values = hashes[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    back = np.empty(len(values), np.int64)
    back[order] = np.cumsum(new) - 1
    return (values[new], back, order[new]) if with_first else (values[new], back)


def distinct_numbers(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for numbers of words, -1 or more."""
    order = order_of((numbers + 1).astype(np.uint64))
    values = numbers[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    back = np.empty(len(values), np.int64)
    back[order] = np.cumsum(new) - 1
    return values[new], back


# ---- files -------------------------------------------------------------------------------


class Bundle:
    """The files of a run of ranges: written aside, range after range, and renamed at the end, so a repeated task leaves the same files."""

    def __init__(self, path: str, number: int):
        self.path, self.number, self.mark, self.files, self.length = path, number, uuid.uuid4().hex, {}, Counter()

    def aside(self, name: str) -> str:
        return f"{self.path}/.{self.mark}-{name}-{self.number}"

    def add(self, name: str, values: np.ndarray) -> None:
        if name not in self.files:
            self.files[name] = open(self.aside(name), "wb")
        self.files[name].write(np.ascontiguousarray(values).tobytes())

    def add_small(self, name: str, values: np.ndarray) -> None:
        """Counts in a byte each; where one has 255 or more, it stands in a second array by its place."""
        large = np.flatnonzero(values >= 255)
        self.add(name, np.minimum(values, 255).astype(np.uint8))
        self.add(f"{name}.at", large.astype(np.uint64) + np.uint64(self.length[name]))
        self.add(f"{name}.of", values[large].astype(np.uint64))
        self.length[name] += len(values)

    def close(self) -> None:
        for name, out in self.files.items():
            out.close()
            os.replace(self.aside(name), f"{self.path}/{name}-{self.number}")


@lru_cache(maxsize=1 << 15)
def mapped(path: str, kind: str) -> np.ndarray:
    if not os.path.getsize(path):
        return np.empty(0, kind)
    with open(path, "rb") as data:
        return np.frombuffer(mmap.mmap(data.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), kind)


def small(path: str, name: str, bundle: int, at: np.ndarray) -> np.ndarray:
    """The counts at some places of a table that ``add_small`` has written."""
    values = mapped(f"{path}/{name}-{bundle}", "u1")[at].astype(np.int64)
    large = np.flatnonzero(values == 255)
    if large.size:
        place = np.searchsorted(mapped(f"{path}/{name}.at-{bundle}", "u8"), np.asarray(at)[large].astype(np.uint64))
        values[large] = mapped(f"{path}/{name}.of-{bundle}", "u8")[place]
    return values


def tallied(path: str, name: str, bundle: int) -> list[int]:
    """How many counts of a table are 1, 2, 3 and 4, how many are 3 or more, and their sum."""
    values = mapped(f"{path}/{name}-{bundle}", "u1")
    by = np.bincount(values, minlength=256)
    whole = int((by[:255] * np.arange(255)).sum()) + int(mapped(f"{path}/{name}.of-{bundle}", "u8").sum())
    return [*(int(x) for x in by[1:5]), int(by[3:].sum()), whole]


def local(folder: str) -> str:
    """The mounted path of a shared folder."""
    if folder.startswith("file:"):
        return "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        raise ValueError(f"workers can't map files of {folder} into memory; name a mounted folder as model_dir")
    return folder


# ---- blocks ------------------------------------------------------------------------------

BLOCKS = "range long, kind long, n long, block binary"
WORDS, TRIGRAMS, PAIRS, CONTINUATIONS, CONTEXTS, TALLY = range(6)
#: The arrays of each kind of block.
ARRAYS = {WORDS: ("u8", "u4"), TRIGRAMS: ("u8", "u4", "u4"), PAIRS: ("u8", "u4"), CONTINUATIONS: ("u8", "u4"), CONTEXTS: ("u8",) * 5, TALLY: ("u8",)}


def pack(*arrays: np.ndarray) -> bytes:
    """Sorted numbers as differences, then the other arrays, compressed."""
    first = np.diff(arrays[0], prepend=arrays[0].dtype.type(0))
    columns = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in (first, *arrays[1:])]  # like bytes together
    return zstandard.compress(b"".join(columns), 1)


def unpack(block: bytes, n: int, kind: int) -> list[np.ndarray]:
    data, out, at = np.frombuffer(zstandard.decompress(block), np.uint8), [], 0
    for each in map(np.dtype, ARRAYS[kind]):
        size = each.itemsize * n
        out.append(np.ascontiguousarray(data[at : at + size].reshape(each.itemsize, n).T).view(each).ravel())
        at += size
    out[0] = np.cumsum(out[0], dtype=out[0].dtype)
    return out


def blocks(range_: np.ndarray, kind: int, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed block for each range; arrays keep their order within it."""
    if not len(range_):
        return
    order = np.argsort(range_.astype(np.uint16) if range_.max() < 1 << 16 else range_, kind="stable")
    ends = np.flatnonzero(np.diff(range_[order].astype(np.int64), append=-1)) + 1
    rows: list[tuple] = []
    for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
        at = order[a:b]
        rows.append((int(range_[at[0]]), kind, int(b - a), pack(*(x[at] for x in arrays))))
        if len(rows) == 256:
            yield batch_of(rows)
            rows = []
    if rows:
        yield batch_of(rows)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=["range", "kind", "n", "block"])


def top(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The range of each hash: its upper bits."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def range_of(kind: int, keys: np.ndarray, bits: int) -> np.ndarray:
    return top(keys if kind == WORDS else keys * MIX, bits)


def sums_of(parts: list[list[np.ndarray]], kind: int) -> list[np.ndarray]:
    """Blocks of one kind put together: keys in order, equal ones' counts added up."""
    kinds = ARRAYS[kind]
    if not parts:
        return [np.empty(0, k) for k in (*kinds[:-1], "u8")]
    columns = [np.concatenate([p[i] for p in parts]) for i in range(len(kinds))]
    return list(added(columns[:-1], columns[-1].astype(np.uint64)))


def added(keys: list[np.ndarray], counts: np.ndarray) -> list[np.ndarray]:
    """Counts of equal keys (of one array or more) added up, in order of keys."""
    if not len(counts):
        return [*keys, counts]
    order = order_of(*keys)
    keys, counts = [k[order] for k in keys], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return [*(k[first] for k in keys), np.add.reduceat(counts, first)]


def dealt(frame: DataFrame, bits: int) -> DataFrame:
    """Blocks by coarse range, ``FAN_BITS`` of it at a time, brought to single ranges.

    A coarse range is shared by as many tasks as it has ranges below, so no task gets more than about
    a range's share. Nothing is to be done up to 2 ** ``FAN_BITS`` ranges.
    """
    fan = FAN_BITS  # tasks get the driver's setting

    def split(upto: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            n = 0
            for batch in batches:
                for kind, size, block in zip(*(batch.column(c).to_pylist() for c in ("kind", "n", "block"))):
                    held.setdefault(kind, []).append(unpack(block, size, kind))
                    n += size
                    if n >= BLOCK_TOKENS:
                        yield from sent(held, upto)
                        held, n = {}, 0
            yield from sent(held, upto)

        return run

    def sent(held: dict[int, list], upto: int) -> Iterator[pa.RecordBatch]:
        for kind, parts in held.items():
            arrays = sums_of(parts, kind)
            yield from blocks(range_of(kind, arrays[0], upto), kind, *arrays[:-1], arrays[-1].astype(np.uint32))

    level = fan
    while level < bits:
        below = 1 << (bits - level)
        level = min(bits, level + fan)
        frame = frame.repartition(1 << bits, "range", F.pmod(F.crc32("block"), F.lit(below))).mapInArrow(split(level), BLOCKS)
    return frame


def by_bundle(frame: DataFrame, bits: int, bundle_bits: int) -> DataFrame:
    """Blocks dealt out by bundle, in order of ranges, with an empty row for each bundle."""
    shift = bits - bundle_bits
    marks = frame.sparkSession.range(1 << bundle_bits).select(F.shiftleft("id", shift).alias("range"), F.lit(-1).cast("long").alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(b"").alias("block"))
    placed = frame.unionByName(marks).withColumn("bundle", F.shiftright("range", shift))
    return placed.repartition(1 << bundle_bits, "bundle").sortWithinPartitions("bundle", "range").select("bundle", "range", "kind", "n", "block")


def ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, dict[int, list]]]:
    """Bundle, range and, by kind, the unpacked blocks of each range of a sorted partition.

    Blocks are put together as they come, so what is held of a range is some blocks' worth beside twice its distinct keys:
    a pair that every text has comes with each block, and its range in one task.
    """
    at, found, held, limit = None, {}, {}, {}
    for batch in batches:
        for bundle, range_, kind, n, block in zip(*(c.to_pylist() for c in batch.columns)):
            if at is not None and at != (bundle, range_):
                yield *at, found
                found, held, limit = {}, {}, {}
            at = (bundle, range_)
            if kind < 0:
                continue
            found.setdefault(kind, []).append(unpack(block, n, kind))
            held[kind] = held.get(kind, 0) + n
            if held[kind] > limit.get(kind, MERGE_KEYS):
                found[kind] = [sums_of(found[kind], kind)]
                held[kind] = len(found[kind][0][0])
                limit[kind] = max(MERGE_KEYS, 2 * held[kind])
    if at is not None:
        yield *at, found


def bundles_of(batches: Iterator[pa.RecordBatch]):
    return groupby(ranges_of(batches), key=lambda r: r[0])


# ---- training ----------------------------------------------------------------------------


def write_words(docs: DataFrame, path: str, bits: int) -> tuple[tuple[int, ...], int]:
    """Sorted hashes and counts of words by ranges of hashes; gives where bundles start, and the number of tokens."""
    first = min(bits, FAN_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, _, _ in runs_of(batches, BLOCK_TOKENS):
            h, n = np.unique(hashes, return_counts=True)
            yield from blocks(top(h, first), WORDS, h, n.astype(np.uint32))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle, ranges in bundles_of(batches):
            out, words, tokens_ = Bundle(path, bundle), 0, 0
            for _, _, found in ranges:
                h, n = sums_of(found.get(WORDS, []), WORDS)
                out.add("word", h)
                out.add_small("word.n", n)
                words, tokens_ = words + len(h), tokens_ + int(n.sum())
            out.close()
            yield pa.RecordBatch.from_pydict({"bundle": [bundle], "words": [words], "tokens": [tokens_]})

    bundle_bits = min(bits, BUNDLE_BITS)
    counted = dealt(docs.mapInArrow(count, BLOCKS), bits)
    found = by_bundle(counted, bits, bundle_bits).mapInArrow(gather, "bundle long, words long, tokens long").collect()  # a row for each bundle
    lengths = [r.words for r in sorted(found, key=lambda r: r.bundle)]
    return tuple(int(x) for x in np.cumsum([0, *lengths])), sum(r.tokens for r in found)


def keys_of(numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A key for each token: its number, and above it that of the token before, ``BEGIN`` at the start of a text."""
    current = np.where(numbers < 0, OTHER, numbers.astype(np.uint64))
    before = np.empty_like(current)
    before[1:] = current[:-1]
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = BEGIN
    return before << np.uint64(32) | current


def contexts_of(pairs: np.ndarray, lengths: np.ndarray, start) -> np.ndarray:
    """What stands in ``pairs`` one token before each token; ``start`` at the start of a text."""
    contexts = np.empty_like(pairs)
    contexts[1:] = pairs[:-1]
    contexts[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = start
    return contexts


def numbered(hashes: np.ndarray, sizes: Sizes) -> np.ndarray:
    """The number of each word, -1 for those that training lacks."""
    words, back = distinct(hashes)
    out, bundle = np.full(len(words), UNKNOWN), top(words, sizes.bundle_bits)
    for b, at in groups_of(bundle):
        place = found_in(mapped(f"{sizes.path}/word-{b}", "u8"), words[at])
        out[at] = np.where(place < 0, UNKNOWN, place + sizes.starts[b])
    return out[back]


def groups_of(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value, and where it stands, in order."""
    if not len(of):
        return
    order = np.argsort(of.astype(np.uint16) if 0 <= of.min() and of.max() < 1 << 16 else of, kind="stable")
    ends = np.flatnonzero(np.diff(of[order], append=of[order[-1]] + 1)) + 1
    for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
        yield int(of[order[a]]), order[a:b]


def found_in(array: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(array):
        return np.full(len(keys), UNKNOWN)
    at = np.minimum(np.searchsorted(array, keys), len(array) - 1)
    return np.where(array[at] == keys, at, UNKNOWN)


def count_keys(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """Blocks of trigrams by range of their first pair, or of pairs for order 2."""
    first = min(sizes.bits, FAN_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, lengths, _ in runs_of(batches, BLOCK_TOKENS):
            pairs = keys_of(numbered(hashes, sizes), lengths)
            if sizes.order == 2:
                keys, n = np.unique(pairs, return_counts=True)
                yield from blocks(range_of(PAIRS, keys, first), PAIRS, keys, n.astype(np.uint32))
                continue
            ends = np.unique(pairs[np.cumsum(lengths) - 1])  # nothing follows these; they are listed as pairs all the same
            contexts = np.concatenate([contexts_of(pairs, lengths, START), ends])
            last = np.concatenate([pairs.astype(np.uint32), np.full(len(ends), NOTHING)])
            n = np.ones(len(contexts), np.uint32)
            n[len(pairs) :] = 0
            contexts, last, n = added([contexts, last], n)
            yield from blocks(range_of(TRIGRAMS, contexts, first), TRIGRAMS, contexts, last, n.astype(np.uint32))

    return dealt(docs.mapInArrow(count, BLOCKS), sizes.bits)


def write_trigrams(counted: DataFrame, sizes: Sizes) -> DataFrame:
    """The pairs of each range and the words after them; gives blocks of pairs with how many words stand before each."""
    first = min(sizes.bits, FAN_BITS)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle, ranges in bundles_of(batches):
            out, upto, pairs_ = Bundle(sizes.path, bundle), 0, 0
            lengths: list[np.ndarray] = []
            for _, _, found in ranges:
                contexts, last, n = sums_of(found.pop(TRIGRAMS, []), TRIGRAMS)
                starts = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(contexts) else np.empty(0, np.int64)
                real = n > 0
                length = np.add.reduceat(real.astype(np.int64), starts) if len(starts) else starts
                mixed = contexts[starts] * MIX
                by_hash = np.argsort(mixed)
                begin = (np.cumsum(length) - length)[by_hash]
                order = np.flatnonzero(real)[ragged(begin, begin + length[by_hash])]
                length, kept = length[by_hash], n[order]
                out.add("pair", mixed[by_hash])
                out.add_small("after", length)
                out.add("third", last[order])
                out.add_small("third.n", kept)
                wide = np.flatnonzero(length > WIDE)
                at = ragged((np.cumsum(length) - length)[wide], np.cumsum(length)[wide])
                out.add("wide", wide.astype(np.uint64) + np.uint64(pairs_))
                out.add("wide.sums", sums_by(kept[at], length[wide]).astype(np.uint64))
                # where the words after every STEP-th pair of the bundle begin
                lengths.append(length)
                whole = np.concatenate(lengths)
                full = len(whole) // STEP * STEP
                by_step = whole[:full].reshape(-1, STEP).sum(1)
                out.add("after.start", (upto + np.cumsum(by_step) - by_step).astype(np.uint64))
                upto, lengths, pairs_ = upto + int(by_step.sum()), [whole[full:]], pairs_ + len(length)
                pairs, preceding = np.unique(contexts[real] << np.uint64(32) | last[real].astype(np.uint64), return_counts=True)
                yield from blocks(range_of(PAIRS, pairs, first), PAIRS, pairs, preceding.astype(np.uint32))
            out.add("after.start", np.array([upto], np.uint64))
            out.close()

    return dealt(by_bundle(counted, sizes.bits, sizes.bundle_bits).mapInArrow(gather, BLOCKS), sizes.bits)


def sums_by(n: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of each run of counts their sum, and how many are 1, 2 and more. No run is empty."""
    if not len(length):
        return np.empty((0, 4), np.int64)
    first = np.cumsum(length) - length
    return np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (n, n == 1, n == 2, n >= 3)], 1)


def write_pairs(pairs: DataFrame, sizes: Sizes) -> list[int]:
    """Counts of pairs beside them; then, by number of word, continuations and totals. Gives tallies of all counts."""
    starts = np.array(sizes.starts)
    bundle_of = lambda numbers: np.searchsorted(starts, numbers.astype(np.int64), "right") - 1

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle, ranges in bundles_of(batches):
            out, cursor = Bundle(sizes.path, bundle), 0
            for _, range_, found in ranges:
                keys, n = sums_of(found.get(PAIRS, []), PAIRS)
                mixed = keys * MIX
                order = np.argsort(mixed)
                if sizes.order == 2:
                    out.add("pair", mixed[order])
                    out.add_small("pair.n", n[order])
                elif len(keys):
                    listed = mapped(f"{sizes.path}/pair-{bundle}", "u8")
                    place = np.searchsorted(listed, mixed[order])
                    counts = np.zeros(int(place[-1]) + 1 - cursor, np.uint64)  # pairs that start a text twice over have none
                    counts[place - cursor] = n[order]
                    out.add_small("pair.n", counts)
                    cursor = int(place[-1]) + 1
                if not len(keys):
                    continue
                last, preceding = np.unique(keys & LOW, return_counts=True)
                yield from blocks(bundle_of(last), CONTINUATIONS, last, preceding.astype(np.uint32))
                before = keys >> np.uint64(32)
                first = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
                sums = sums_by(n, np.diff(np.append(first, len(keys)))).astype(np.uint64)
                of = before[first]
                yield from blocks(np.where(of == BEGIN, 0, bundle_of(of)), CONTEXTS, of, *sums.T)
            if sizes.order == 3:
                out.add_small("pair.n", np.zeros(len(mapped(f"{sizes.path}/pair-{bundle}", "u8")) - cursor, np.uint64))
            else:
                out.add("pair", np.empty(0, np.uint64))
            out.close()
            thirds = tallied(sizes.path, "third.n", bundle) if sizes.order == 3 else [0] * 6
            known = mapped(f"{sizes.path}/pair.n-{bundle}", "u1")
            tally = np.array([*tallied(sizes.path, "pair.n", bundle), *thirds, int((known > 0).sum())], np.uint64)
            yield batch_of([(bundle, TALLY, len(tally), pack(tally))])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bundle, ranges in bundles_of(batches):
            start, size = sizes.starts[bundle], sizes.starts[bundle + 1] - sizes.starts[bundle]
            follow, context = np.zeros(size, np.uint64), np.zeros((size, 4), np.uint64)
            begin, tally = np.zeros(4, np.uint64), np.zeros(13, np.uint64)
            for _, _, found in ranges:
                for number, preceding in found.get(CONTINUATIONS, []):
                    follow[number.astype(np.int64) - start] += preceding.astype(np.uint64)
                for number, *sums in found.get(CONTEXTS, []):
                    own, table = number != BEGIN, np.stack(sums, 1)
                    context[number[own].astype(np.int64) - start] += table[own]
                    begin += table[~own].sum(0, dtype=np.uint64)
                for (part,) in found.get(TALLY, []):
                    tally += part
            out = Bundle(sizes.path, bundle)
            out.add_small("follow", follow)
            out.add_small("context", context.ravel())
            out.close()
            values = [*map(int, tally), *tallied(sizes.path, "follow", bundle), *map(int, begin)]
            yield pa.RecordBatch.from_pydict({f"t{i}": [v] for i, v in enumerate(values)})

    names = [f"t{i}" for i in range(13 + 6 + 4)]
    sent = by_bundle(pairs, sizes.bits, sizes.bundle_bits).mapInArrow(gather, BLOCKS)
    done = by_bundle(sent, sizes.bundle_bits, sizes.bundle_bits).mapInArrow(finish, ", ".join(f"{t} long" for t in names))
    return list(done.agg(*(F.sum(t) for t in names)).first())


class Discounts(NamedTuple):
    """Discounts of counts 1, 2 and more, for trigrams, pairs and words, what the lowest order shares, and totals after the start."""

    top: tuple[float, float, float]
    high: tuple[float, float, float]
    low: tuple[float, float, float]
    pairs: int
    low_share: float
    begin: tuple[int, int, int, int]


def discounts(tally: list[int]) -> tuple[float, float, float]:
    """From how many keys have counts 1, 2, 3 and 4; half a count where they don't say."""
    n1, n2, n3, n4 = tally
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.5, 3 - 4 * y * n4 / n3 if n3 else 0.5)
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1))


def train(docs: DataFrame, model_dir: str | None = None, order: int = 3) -> tuple[Sizes, Discounts]:
    """Counts ``docs`` (a column ``_text`` of UTF-8 bytes), writes the arrays, and gives what scoring needs beside them."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    path = f"{local(model_dir or shared_dir(docs.sparkSession))}/kneser-ney-{uuid.uuid4().hex}"
    os.makedirs(path)
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = max(0, -(-size // RANGE_BYTES) - 1).bit_length()
    starts, tokens_ = write_words(docs, path, bits)
    if starts[-1] >= int(OTHER):
        raise ValueError("keys hold numbers of 32 bits; the corpus has more distinct words")
    sizes = Sizes(path, bits, min(bits, BUNDLE_BITS), starts, tokens_, starts[-1], order)
    counted = count_keys(docs, sizes)
    t = write_pairs(write_trigrams(counted, sizes) if order == 3 else counted, sizes)
    pair, third, pairs, follow, begin = t[:6], t[6:12], t[12], t[13:19], t[19:23]
    low = discounts(follow[:4])
    share = (low[0] * follow[0] + low[1] * follow[1] + low[2] * follow[4]) / pairs if pairs else 1.0
    return sizes, Discounts(discounts(third[:4]), discounts(pair[:4]), low, pairs, share, tuple(begin))


# ---- scoring -----------------------------------------------------------------------------


def step(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    """The discount of each count."""
    return np.array([0.0, *by])[np.minimum(counts, 3)]


def of_words(name: str, numbers: np.ndarray, sizes: Sizes, width: int = 1) -> np.ndarray:
    """What a table of words has for each number, a row of ``width`` values; zeros for words that training lacks."""
    out = np.zeros((len(numbers), width), np.int64)
    bundle = np.where(numbers < 0, -1, np.searchsorted(np.array(sizes.starts), numbers, "right") - 1)
    for b, at in groups_of(bundle):
        if b >= 0:
            place = numbers[at] - sizes.starts[b]
            out[at] = small(sizes.path, name, b, (place[:, None] * width + np.arange(width)).ravel()).reshape(-1, width)
    return out


def probabilities(hashes: np.ndarray, lengths: np.ndarray, sizes: Sizes, d: Discounts) -> tuple[np.ndarray, np.ndarray]:
    """The model's probability of each token, and the token's count in training."""
    numbers = numbered(hashes, sizes)
    keys = keys_of(numbers, lengths)
    mixed, back = distinct(np.append(keys, START) * MIX)  # in the order of the model's arrays
    back, start = back[:-1], back[-1]
    unique = mixed * UNMIX
    bundle, place, n = top(mixed, sizes.bundle_bits), np.full(len(unique), UNKNOWN), np.zeros(len(unique), np.int64)
    for b, at in groups_of(bundle):
        found = found_in(mapped(f"{sizes.path}/pair-{b}", "u8"), mixed[at])
        place[at], hit = found, found >= 0
        n[at[hit]] = small(sizes.path, "pair.n", b, found[hit])
    last = (unique & LOW).astype(np.int64)
    last[last >= int(OTHER)] = UNKNOWN
    # the lower order: after how many words each word stands
    number, of = distinct_numbers(last)
    follow = of_words("follow", number, sizes)[:, 0]
    low = (np.maximum(follow - step(follow, d.low), 0) / max(1, d.pairs) + d.low_share / (sizes.words + 1))[of]
    before = (unique >> np.uint64(32)).astype(np.int64)
    number, of = distinct_numbers(before)
    context = of_words("context", np.where(number >= int(OTHER), UNKNOWN, number), sizes, 4)
    context[number == int(BEGIN)] = d.begin
    context = context[of].astype(float)
    total, left = context[:, 0], context[:, 1:] @ np.array(d.high)
    p = np.where(total > 0, (np.maximum(n - step(n, d.high), 0) + left * low) / np.maximum(total, 1), low)[back]
    if sizes.order == 3:
        p = third(bundle, place, contexts_of(back, lengths, start), keys.astype(np.uint32), p, sizes, d)
    number, of = distinct_numbers(numbers)
    return p, of_words("word.n", number, sizes)[of, 0]


def third(bundle: np.ndarray, place: np.ndarray, context: np.ndarray, last: np.ndarray, low: np.ndarray, sizes: Sizes, d: Discounts) -> np.ndarray:
    """The probability of each token after its context, one of the pairs placed, where ``low`` is that after one word."""
    p = low.copy()
    by_context = order_of(context)
    firsts = np.concatenate([[0], np.cumsum(np.bincount(context, minlength=len(place)))])
    for b, at in groups_of(bundle):
        at = at[place[at] >= 0]
        length = small(sizes.path, "after", b, place[at])
        at, length = at[length > 0], length[length > 0]
        if not len(at):
            continue
        begin = begins(sizes.path, b, place[at])
        sums = totals(sizes.path, b, place[at], begin, length)
        # the tokens after these contexts
        many = firsts[at + 1] - firsts[at]
        own, token = np.repeat(np.arange(len(at)), many), by_context[ragged(firsts[at], firsts[at + 1])]
        there = within(mapped(f"{sizes.path}/third-{b}", "u4"), begin[own], (begin + length)[own], last[token])
        n = np.zeros(len(there), np.int64)
        n[there >= 0] = small(sizes.path, "third.n", b, there[there >= 0])
        left = sums[:, 1:] @ np.array(d.top)
        p[token] = (np.maximum(n - step(n, d.top), 0) + left[own] * low[token]) / sums[own, 0]
    return p


def begins(path: str, bundle: int, place: np.ndarray) -> np.ndarray:
    """Where the words after each pair begin: a stored start, and the lengths of the few pairs from there."""
    base = mapped(f"{path}/after.start-{bundle}", "u8")[place // STEP].astype(np.int64)
    first = place // STEP * STEP
    length = small(path, "after", bundle, ragged(first, place))
    upto = np.concatenate([[0], np.cumsum(length)])
    ends = np.cumsum(place - first)
    return base + upto[ends] - upto[ends - (place - first)]


def totals(path: str, bundle: int, place: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of each pair the sum of the counts after it, and how many are 1, 2 and more."""
    out = np.empty((len(place), 4))
    wide = length > WIDE
    if wide.any():
        out[wide] = mapped(f"{path}/wide.sums-{bundle}", "u8").reshape(-1, 4)[np.searchsorted(mapped(f"{path}/wide-{bundle}", "u8"), place[wide].astype(np.uint64))]
    narrow = ~wide
    out[narrow] = sums_by(small(path, "third.n", bundle, ragged(begin[narrow], begin[narrow] + length[narrow])), length[narrow])
    return out


def ragged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All indexes from each start to its end."""
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def within(array: np.ndarray, start: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted value stands in its sorted part of ``array``, or -1. No part is empty."""
    lo, hi = start.copy(), end - 1
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        less = array[mid] < wanted[open_]
        lo[open_] = np.where(less, mid + 1, lo[open_])
        hi[open_] = np.where(less, hi[open_], mid)
    return np.where(array[lo] == wanted, lo, UNKNOWN)


def score(docs: DataFrame, sizes: Sizes, d: Discounts) -> DataFrame:
    """The rows of ``docs``, less ``_text``, with token counts and log10 scores of ``_text``."""
    names = [c for c in docs.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for hashes, lengths, rows in runs_of(watched(batches, kinds := {}), BLOCK_TOKENS // 2):
            schema = schema or kinds["schema"]
            p, c = probabilities(hashes, lengths, sizes, d)
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            base = np.log10((c + 0.5) / (sizes.tokens + 0.5 * (sizes.words + 1)))
            results = [lengths, np.add.reduceat((c > 0).astype(np.int64), first), np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first)]
            kept = [pa.array([r[n] for r in rows], schema.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, results)], names=[*names, "n_tokens", "n_known", "base_score", "score"])

    kept = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return docs.select(*names, "_text").mapInArrow(run, f"{kept}, n_tokens long, n_known long, base_score double, score double")


def watched(batches: Iterator[pa.RecordBatch], kinds: dict) -> Iterator[pa.RecordBatch]:
    """``batches``, whose schema is noted."""
    for batch in batches:
        kinds["schema"] = batch.schema
        yield batch


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def scored(docs: DataFrame, model_dir: str | None = None, order: int = 3) -> DataFrame:
    """Scores of all documents by a model of those that are not held out; the model stays only in a ``model_dir``."""
    body = F.col("text").cast("binary").alias("_text")
    sizes, d = train(docs.where(~held_out(F.col("doc_id"))).select(body), model_dir, order)
    out = saved(score(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), body), sizes, d))
    if model_dir is None:
        shutil.rmtree(sizes.path)
    out = out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(sizes.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
