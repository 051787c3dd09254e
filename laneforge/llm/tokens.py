"""Byte-level BPE: counting with a whole-token shortcut, and encoding and decoding with offsets.

Both work by pre-token. A text is cut by the vocabulary's pattern, and each pre-token is encoded
on its own, as the pattern's merges never cross a pre-token. Every Arrow batch sends the distinct
pre-tokens it has not met yet through the ``tokenizers`` library at once.

Unicode tables differ between regex libraries for recently assigned characters. A character is settled
if it is of the same class (letter, number, space, other) in Unicode 3.2 and now. Texts with another one
go through the same method, and their result is then held against the library that defines the right one,
which stands where they differ.

Defined cases: a null text counts as empty and has no tokens; decoding gives back empty bytes.
Rows repeat and ids may be null; each row stands alone. Long texts are never cut, and what is
kept between batches is bounded by ``KEEP`` pre-tokens. Other columns of the input are dropped by
the queries and kept by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

COUNT_FILE = "byte_bpe_50k.json"
ENCODE_FILE = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens kept by a worker between batches, and the longest of them.
KEEP, KEEP_CHARS = 300_000, 64
SPLIT = regex.compile(public_tokenizers.PATTERN)
# The pattern's letters, numbers and spaces below U+02B0, for texts that have no other characters.
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
LATIN = re.compile(rf" ?[{LETTERS}]+| ?[{NUMBERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
BEYOND_LATIN = re.compile("[^\x00-ʯ]")


def pre_tokens(text: str) -> list[str]:
    """The matches of the pattern; Latin texts by a quicker expression that cuts them alike."""
    return SPLIT.findall(text) if BEYOND_LATIN.search(text) else LATIN.findall(text)


def char_class(category: str) -> str:
    return category[0] if category[0] in "LN" else "Z" if category in ("Zs", "Zl", "Zp") else ""


@lru_cache(maxsize=1 << 16)
def settled_char(c: str) -> bool:
    now, before = unicodedata.category(c), unicodedata.ucd_3_2_0.category(c)
    return now != "Cn" and char_class(now) == char_class(before)


def settled(text: str) -> bool:
    return text.isascii() or all(map(settled_char, set(text)))


# ---- counting ----------------------------------------------------------------------------


@lru_cache(maxsize=2)
def counter(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def special_strings(tokenizer: Tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def whole_tokens(path: str) -> list[str]:
    """The strings of a vocabulary that are one pre-token and that the library encodes as one token.

    Proved by encoding each string of the vocabulary alone. The list is no longer than the vocabulary.
    """
    tokenizer = counter(path)
    specials = set(special_strings(tokenizer))
    decode = decoders.ByteLevel().decode
    strings = {s for t in tokenizer.get_vocab() if (s := decode([t])) and "�" not in s and s not in specials}
    alone = sorted(s for s in strings if settled(s) and pre_tokens(s) == [s])
    return [s for s, e in zip(alone, tokenizer.encode_batch_fast(alone, add_special_tokens=False), strict=True) if len(e.ids) == 1]


class Known:
    """Results by pre-token, a table for each part of a result.

    What is ``fixed`` stays; what is learnt is forgotten beyond ``KEEP`` pre-tokens, and long ones
    after each use.
    """

    def __init__(self, look, *fixed: dict):
        self.look, self.fixed, self.long = look, fixed, []
        self.tables = [dict(f) for f in fixed]

    def learn(self, split: list[list[str]]) -> None:
        for table in self.tables:
            for p in self.long:
                del table[p]
        new = self.unknown(split)
        if len(self.tables[0]) + len(new) > len(self.fixed[0]) + KEEP:
            self.tables = [dict(f) for f in self.fixed]
            new = self.unknown(split)
        for table, values in zip(self.tables, self.look(new), strict=True):
            table.update(zip(new, values, strict=True))
        self.long = [p for p in new if len(p) > KEEP_CHARS]

    def unknown(self, split: list[list[str]]) -> list[str]:
        found: set[str] = set()
        for parts in split:
            found |= set(parts).difference(self.tables[0])
        return list(found)


def slices(texts: list[str], chars: int = 4_000_000) -> Iterator[list]:
    """Runs of texts with a bounded number of characters, or a single longer text."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def count_tokens(docs: DataFrame, path: str | None = None, text: str = "text", keys: tuple[str, ...] = ("doc_id",), limit: int = 1024) -> DataFrame:
    """``keys`` with the number of bytes and tokens of each text; ``corrected`` is true where the library's count stands instead of the method's.

    Every text is counted by pre-token. A text with an unsettled character is counted by the library too, and where the two differ the library is right.
    """
    path = path or public_tokenizers.path(COUNT_FILE)
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # bounded by the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = counter(path)
        specials = special_strings(tokenizer)
        cut = re.compile("|".join(map(re.escape, specials))) if specials else None

        known = Known(lambda parts: [[len(e) for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]], dict.fromkeys(whole.value, 1))
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            counts: list[int] = []
            corrected: list[bool] = []
            for run in slices(texts):
                split: list[list[str]] = []
                extra: list[int] = []
                for t in run:
                    if cut and cut.search(t):
                        split.append([p for piece in cut.split(t) for p in pre_tokens(piece)])
                        extra.append(len(cut.findall(t)))
                    else:
                        split.append(pre_tokens(t))
                        extra.append(0)
                known.learn(split)
                count_of = known.tables[0].__getitem__
                for t, n, parts in zip(run, extra, split, strict=True):
                    total = n + sum(map(count_of, parts))
                    told = total if settled(t) else len(tokenizer.encode(t, add_special_tokens=False).ids)
                    counts.append(told)
                    corrected.append(told != total)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(counts, pa.int64()), pa.array(corrected, pa.bool_())], names=[*keys, "n_tokens", "corrected"])

    source = docs.select(*keys, F.col(text).alias("_text"))
    counted = source.select(*keys, F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long").alias("n_bytes"), "_text")
    keys = (*keys, "n_bytes")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema if f.name != "_text")
    return counted.mapInArrow(count, f"{schema}, n_tokens long, corrected boolean").withColumn("over_limit", F.col("n_tokens") > limit)


# ---- encoding and decoding ---------------------------------------------------------------


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def overlaps(path: str) -> ahocorasick.Automaton:
    """Finds where two overlapping pairs of tokens can form the same token, as in runs of a character.

    There the library, which knows an order of pairs, may differ from leftmost first by rank. Such
    a place reads x, y, z with x + y = y + z the token. Bytes stand as characters up to 255.
    """
    ranks, found = ranks_of(path), ahocorasick.Automaton()
    for t in ranks:
        for k in range(1, len(t)):
            if t[k:] == t[: len(t) - k] and t[:k] in ranks and t[k:] in ranks and t[len(t) - k :] in ranks:
                found.add_word((t[:k] + t).decode("latin-1"), True)
    found.make_automaton()
    return found


def with_overlaps(parts: list[str], path: str) -> set[int]:
    """The numbers of the pre-tokens that hold such a place."""
    raw = [p.encode() for p in parts]
    ends = list(accumulate(len(r) + 1 for r in raw))
    return {bisect_right(ends, at) for at, _ in overlaps(path).iter(b"\0".join(raw).decode("latin-1"))}


@lru_cache(maxsize=2)
def encoder(path: str) -> Tokenizer:
    """The ``tokenizers`` library's BPE for a file of ranks: each pair of tokens whose joint is a token, by rank."""
    ranks, chars = ranks_of(path), byte_chars()
    name = {token: "".join(chars[b] for b in token) for token in ranks}
    pairs = sorted(
        (rank, ranks[token[:k]], ranks[token[k:]], token[:k], token[k:])
        for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
    )
    tokenizer = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=[(name[a], name[b]) for *_, a, b in pairs], ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


@lru_cache(maxsize=2)
def rank_encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})


def encode_parts(parts: list[str], path: str, offsets: bool = True) -> tuple[list[list[int]], list[list[int]]]:
    """For each pre-token its ids, and where each id ends in characters of the pre-token.

    A character split over several tokens ends with each of them, as the library's offsets have it.
    """
    tokenizer = encoder(path)
    run = tokenizer.encode_batch if offsets else tokenizer.encode_batch_fast
    encoded = run(parts, add_special_tokens=False)
    ids = [e.ids for e in encoded]
    ends = [[end for _, end in e.offsets] for e in encoded] if offsets else []
    exact = rank_encoding(path)
    for k in with_overlaps(parts, path):
        if (right := exact.encode_ordinary(parts[k])) != ids[k]:
            ids[k] = right
            if offsets:
                ends[k] = ends_in_chars(right, path)
    return ids, ends


@lru_cache(maxsize=2)
def names_of(path: str) -> dict[int, str]:
    """The name of each id in the library's vocabulary: a printable character for each byte."""
    return {i: name for name, i in encoder(path).get_vocab().items()}


#: From a printable character to its byte, as the character of that number.
REVERSED = str.maketrans({c: chr(b) for b, c in enumerate(byte_chars())})


def ends_in_chars(ids: list[int], path: str) -> list[int]:
    """The characters begun by the end of each token."""
    ends, chars = [], 0
    for i in ids:
        chars += sum(b & 0xC0 != 0x80 for b in decode_ids([i], path))
        ends.append(chars)
    return ends


def decode_ids(ids: list[int], path: str) -> bytes:
    """The bytes of ids: the byte table reversed. Characters split over tokens join again as bytes."""
    return "".join(map(names_of(path).__getitem__, ids)).translate(REVERSED).encode("latin-1")


def encode(docs: DataFrame, path: str | None = None, text: str = "text", digests_only: bool = False) -> DataFrame:
    """The rows of ``docs`` with token ids, the end of each token in characters, and decoded bytes.

    Adds ``ids``, ``ends`` (arrays of integers) and ``decoded`` (binary); with ``digests_only``
    adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` in their place. Columns of these names are replaced.
    """
    path = path or public_tokenizers.path(ENCODE_FILE)
    names = docs.columns

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = rank_encoding(path)

        def look(parts: list[str]) -> tuple[list, list]:
            ids, ends = encode_parts(parts, path, offsets=not digests_only)
            return ([",".join(map(str, i)) for i in ids], [decode_ids(i, path) for i in ids]) if digests_only else (ids, ends)

        known = Known(look, {}, {})
        for batch in batches:
            texts, at = [t or "" for t in batch.column("_text").to_pylist()], 0
            for run in slices(texts, 1_000_000):
                columns: list[list] = [[], [], []]
                split = list(map(pre_tokens, run))
                known.learn(split)
                first, second = (table.__getitem__ for table in known.tables)
                for t, parts in zip(run, split, strict=True):
                    whole = None if settled(t) else exact.encode_ordinary(t)  # what the result is held against
                    if digests_only:
                        ids, decoded = ",".join(map(first, parts)), b"".join(map(second, parts))
                        if whole is not None and ids != (right := ",".join(map(str, whole))):
                            ids, decoded = right, decode_ids(whole, path)
                        row = (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    else:
                        ids = list(chain.from_iterable(map(first, parts)))
                        starts = accumulate(map(len, parts), initial=0)
                        ends = [s + e for s, p in zip(starts, parts) for e in second(p)]
                        if whole is not None and ids != whole:
                            ids, ends = whole, ends_in_chars(whole, path)
                        row = (ids, ends, decode_ids(ids, path))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                kinds = (pa.int64(), pa.string(), pa.string()) if digests_only else (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
                kept = [batch.column(i).slice(at, len(run)) for i in range(len(names))]
                at += len(run)
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[*(f"c{i}" for i in range(len(names))), *added])

    added = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests_only else ["ids", "ends", "decoded"]
    types = ["long", "string", "string"] if digests_only else ["array<int>", "array<int>", "binary"]
    source = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)), F.col(text).alias("_text"))
    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)), *(f"{a} {k}" for a, k in zip(added, types, strict=True))])
    out = source.mapInArrow(encode_batches, schema)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in added), *added)

