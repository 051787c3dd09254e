"""Matroska media columns: payloads stored as 8-bit PCM tracks, and files parsed into packets.

``pack`` writes a payload as a Matroska file: EBML header, segment, info, one audio track, clusters
of simple blocks with every kind of lacing, and cues. ``packets`` parses such files, or others, into
a table of packets with timestamps, tracks and byte ranges, and whether a cue points to them. The parser
takes elements of any length, sizes of one to eight bytes, unknown sizes of segments and clusters, void and
checksum elements, simple blocks and block groups, and the four kinds of lacing. A block of a group is a key
frame if it refers to no other block.

Defined cases: a null payload counts as empty. A null media value has no packets. Bytes that are not
Matroska, or are damaged, raise ``MatroskaError``, which says what is wrong and at which byte; with ``errors`` as
"column" such a value gives one row, without a packet, that says it. Equal payloads give equal files. Other
columns pass through ``packets``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Identifiers of elements.
EBML, SEGMENT, VOID, CRC = 0x1A45DFA3, 0x18538067, 0xEC, 0xBF
EBML_VERSION, EBML_READ_VERSION, MAX_ID_LENGTH, MAX_SIZE_LENGTH = 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4282, 0x4287, 0x4285
SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES = 0x114D9B74, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
CHAPTERS, TAGS, ATTACHMENTS = 0x1043A770, 0x1254C367, 0x1941A469
TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, DEFAULT_DURATION, FLAG_LACING = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x23E383, 0x9C
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE_BLOCK = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
TOP_LEVEL = {SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES, CHAPTERS, TAGS, ATTACHMENTS}
NO_LACING, XIPH, FIXED, EBML_LACING = range(4)

RATE = 8000  # samples, and so bytes, in a second
FRAME = 400  # bytes of a frame: 50 ms
LACED = 8  # frames of a laced block
BLOCKS = 8  # blocks of a cluster


# ---- writing -----------------------------------------------------------------------------


def size_bytes(n: int, width: int = 0) -> bytes:
    """``n`` as a variable-length size; all ones is kept for unknown sizes."""
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + size_bytes(len(body)) + body


def number(ident: int, n: int) -> bytes:
    return element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def laced(frames: list[bytes], kind: int) -> bytes:
    """The frames of a block after its flags: their count and sizes as the kind of lacing has them, then all."""
    sizes = [len(f) for f in frames]
    head = b"" if kind == NO_LACING else bytes([len(frames) - 1])
    if kind == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif kind == EBML_LACING:
        head += size_bytes(sizes[0]) + b"".join(size_bytes(b - a + (1 << 13) - 1, 2) for a, b in zip(sizes, sizes[1:-1]))
    return head + b"".join(frames)


def pack(payload: bytes) -> bytes:
    """A Matroska file that holds ``payload`` as one track of 8-bit samples."""
    step, clusters, cues, at = FRAME * LACED, [], [], 0
    ms = lambda byte: byte * 1000 // RATE
    head = element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXING_APP, b"pcm") + element(WRITING_APP, b"pcm"))
    audio = element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + number(CHANNELS, 1) + number(BIT_DEPTH, 8)
    head += element(TRACKS, element(TRACK_ENTRY, number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + number(FLAG_LACING, 1) + number(DEFAULT_DURATION, FRAME * 10**9 // RATE) + element(CODEC_ID, b"A_PCM/INT/LIT") + element(AUDIO, audio)))
    for n, first in enumerate(range(0, len(payload), step * BLOCKS)):
        body = number(TIMESTAMP, ms(first))
        for k, start in enumerate(range(first, min(first + step * BLOCKS, len(payload)), step)):
            frames = [payload[i : i + FRAME] for i in range(start, min(start + step, len(payload)), FRAME)]
            kind = (NO_LACING, FIXED, XIPH, EBML_LACING)[(n * BLOCKS + k) % 4]
            if len(frames) == 1 or kind == FIXED and len(frames[-1]) != FRAME:
                kind = NO_LACING if len(frames) == 1 else XIPH
            for i, group in enumerate([[f] for f in frames] if kind == NO_LACING else [frames]):
                since = struct.pack(">h", ms(start + i * FRAME) - ms(first))
                body += element(SIMPLE_BLOCK, b"\x81" + since + bytes([0x80 | kind << 1]) + laced(group, kind))
        cues.append(element(CUE_POINT, number(CUE_TIME, ms(first)) + element(CUE_TRACK_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER_POSITION, len(head) + at))))
        clusters.append(element(CLUSTER, body))
        at += len(clusters[-1])
    intro = element(EBML, number(EBML_VERSION, 1) + number(EBML_READ_VERSION, 1) + number(MAX_ID_LENGTH, 4) + number(MAX_SIZE_LENGTH, 8) + element(DOC_TYPE, b"matroska") + number(DOC_TYPE_VERSION, 4) + number(DOC_TYPE_READ_VERSION, 2))
    return intro + element(SEGMENT, head + b"".join(clusters) + element(CUES, b"".join(cues)))


# ---- parsing -----------------------------------------------------------------------------


class MatroskaError(ValueError):
    """Bytes that are no Matroska file, or a damaged one."""


class Packet(NamedTuple):
    track: int
    timestamp_ns: int
    offset: int
    size: int
    keyframe: bool
    lacing: int
    cluster: int
    cued: bool


def varint(data: bytes, at: int, keep_marker: bool = False) -> tuple[int, int, bool]:
    """A variable-length number, where it ends, and whether all its bits are ones."""
    if at >= len(data) or not data[at]:
        raise MatroskaError(f"no variable-length number at byte {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise MatroskaError(f"a number is cut off at byte {at}")
    n = int.from_bytes(data[at : at + width], "big")
    mask = (1 << 7 * width) - 1
    return n if keep_marker else n & mask, at + width, n & mask == mask


def elements(data: bytes, at: int, end: int, until: frozenset | set = frozenset()) -> Iterator[tuple[int, int, int]]:
    """Identifier, and start and end of the body, of each element from ``at`` to ``end``.

    A body of unknown size runs to the next element of ``until``, or to ``end``.
    """
    while at < end:
        ident, body, _ = varint(data, at, keep_marker=True)
        size, body, unknown = varint(data, body)
        if unknown:
            stop = end if ident == SEGMENT else next((a for a, i in starts(data, body, end) if i in until), end)
        else:
            stop = body + size
        if stop > end:
            raise MatroskaError(f"element {ident:X} at byte {at} runs past its parent")
        yield ident, body, stop
        at = stop


def starts(data: bytes, at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < end:
        ident, body, _ = varint(data, at, keep_marker=True)
        size, body, _ = varint(data, body)
        yield at, ident
        at = body + size


def unsigned(data: bytes, at: int, end: int) -> int:
    return int.from_bytes(data[at:end], "big")


def block_frames(data: bytes, at: int, end: int) -> tuple[int, int, int, list[tuple[int, int]]]:
    """Track, relative timestamp, flags, and start and end of each frame of a block.

    Laced frames follow each other by the track's default duration; without one they all have the block's timestamp.
    """
    track, at, _ = varint(data, at)
    since, flags = struct.unpack_from(">hB", data, at)
    at, kind = at + 3, flags >> 1 & 3
    if kind == NO_LACING:
        return track, since, flags, [(at, end)]
    count, at, sizes = data[at] + 1, at + 1, []
    if kind == FIXED:
        if (end - at) % count:
            raise MatroskaError(f"frames of fixed size don't fill the block that ends at byte {end}")
        sizes = [(end - at) // count] * count
    else:
        for k in range(count - 1):
            if kind == XIPH:
                n = 0
                while data[at] == 255:
                    n, at = n + 255, at + 1
                n, at = n + data[at], at + 1
            else:
                first = at
                n, at, _ = varint(data, at)
                if k:
                    n += sizes[-1] - ((1 << 7 * (at - first) - 1) - 1)
            sizes.append(n)
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise MatroskaError(f"frames run past the block that ends at byte {end}")
    frames = []
    for n in sizes:
        frames.append((at, at + n))
        at += n
    return track, since, flags, frames


def parse(data: bytes) -> tuple[dict, list[Packet]]:
    """What a file says of itself, and its packets in the order of storage."""
    at = [0]  # where the element begins that is being read
    try:
        return parsed(data, at)
    except (KeyError, IndexError, struct.error, UnicodeDecodeError, StopIteration) as error:
        raise MatroskaError(f"the element before byte {at[0]} lacks a part or is cut off ({type(error).__name__})") from error


def parsed(data: bytes, reading: list[int]) -> tuple[dict, list[Packet]]:
    top = elements(data, 0, len(data))
    ident, at, end = next(top, (0, 0, 0))
    if ident != EBML or not any(i == DOC_TYPE and data[a:b] in (b"matroska", b"webm") for i, a, b in elements(data, at, end)):
        raise MatroskaError("not a Matroska file: no header of that type at byte 0")
    about = {"scale": 1_000_000, "tracks": {}, "cues": [], "clusters": 0, "duration": 0.0}
    found: list[tuple[Packet, tuple[int, int, int]]] = []  # with track, time and cluster position, as cues have them
    for ident, at, end in top:
        if ident != SEGMENT:
            continue
        about["segment"], number_of_clusters, before = at, 0, at
        for kind, a, b in elements(data, at, end, TOP_LEVEL):
            reading[0] = b
            if kind == INFO:
                for i, x, y in elements(data, a, b):
                    if i == TIMESTAMP_SCALE:
                        about["scale"] = unsigned(data, x, y)
                    elif i == DURATION:
                        about["duration"] = struct.unpack(">d" if y - x == 8 else ">f", data[x:y])[0]
            elif kind == TRACKS:
                for i, x, y in elements(data, a, b):
                    if i == TRACK_ENTRY:
                        of = {j: (p, q) for j, p, q in elements(data, x, y)}
                        about["tracks"][unsigned(data, *of[TRACK_NUMBER])] = {"codec": data[slice(*of[CODEC_ID])].decode(), "frame_ns": unsigned(data, *of[DEFAULT_DURATION]) if DEFAULT_DURATION in of else 0}
            elif kind == CLUSTER:
                for packet, track, time in cluster_packets(data, a, b, about, number_of_clusters):
                    found.append((packet, (track, time, before - at)))
                number_of_clusters += 1
            elif kind == CUES:
                for i, x, y in elements(data, a, b):
                    if i == CUE_POINT:
                        of = {j: (p, q) for j, p, q in elements(data, x, y)}
                        places = {j: (p, q) for j, p, q in elements(data, *of[CUE_TRACK_POSITIONS])}
                        about["cues"].append((unsigned(data, *of[CUE_TIME]), unsigned(data, *places[CUE_CLUSTER_POSITION]), unsigned(data, *places[CUE_TRACK])))
            before = b
        about["clusters"] += number_of_clusters
    cued = {(track, time, position) for time, position, track in about["cues"]}
    return about, [p._replace(cued=True) if place in cued else p for p, place in found]


def cluster_packets(data: bytes, start: int, end: int, about: dict, cluster: int) -> Iterator[tuple[Packet, int, int]]:
    """The packets of a cluster, each with its track and, for the first of a block, the block's time, else -1."""
    time = 0
    for kind, a, b in elements(data, start, end):
        if kind == TIMESTAMP:
            time = unsigned(data, a, b)
        if kind not in (SIMPLE_BLOCK, BLOCK_GROUP):
            continue
        inner = list(elements(data, a, b)) if kind == BLOCK_GROUP else []
        refers = any(i == REFERENCE_BLOCK for i, _, _ in inner)
        for x, y in [(a, b)] if kind == SIMPLE_BLOCK else [(p, q) for i, p, q in inner if i == BLOCK]:
            track, since, flags, frames = block_frames(data, x, y)
            frame_ns = about["tracks"].get(track, {}).get("frame_ns", 0)
            key = bool(flags & 0x80) if kind == SIMPLE_BLOCK else not refers
            for k, (p, q) in enumerate(frames):
                packet = Packet(track, (time + since) * about["scale"] + k * frame_ns, p, q - p, key, flags >> 1 & 3, cluster, False)
                yield packet, track, time + since if k == 0 else -1


# ---- DataFrames --------------------------------------------------------------------------

#: Packets in a batch of the packet table.
PACKETS_AT_ONCE = 20_000


def store(docs: DataFrame, payload, media: str = "media") -> DataFrame:
    """``docs`` with the Matroska file of a binary column in ``media``, in place of a column of that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = pa.array([pack(x or b"") for x in batch.column("_payload").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], files], names=[*batch.schema.names[:-1], "media"])

    return with_column(docs, payload, "_payload", run, media, "binary")


def packets(media_df: DataFrame, media: str = "media", errors: str = "raise") -> DataFrame:
    """A row for each packet, beside the other columns: track, timestamp, byte range, keyframe, lacing, cluster and cue.

    With ``errors`` as "column" there is a column ``error``, and a damaged value has one row with it alone.
    """
    if errors not in ("raise", "column"):
        raise ValueError('errors is "raise" or "column"')
    names = [c for c in media_df.columns if c != media]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.bool_(), pa.string())

    def rows_of(data: bytes | None) -> list[tuple]:
        try:
            return [(k, *p, None) for k, p in enumerate(parse(data)[1])] if data is not None else []
        except MatroskaError as error:
            if errors == "raise":
                raise
            return [(*[None] * (len(kinds) - 1), str(error))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                found = rows_of(batch.column("_media")[row].as_py())
                for k in range(0, len(found), PACKETS_AT_ONCE):
                    part = found[k : k + PACKETS_AT_ONCE]
                    kept = [c.take(pa.array([row] * len(part), pa.int32())) for c in batch.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*kept, *(pa.array(v, t) for v, t in zip(zip(*part), kinds))], names=[*batch.schema.names[:-1], *added])

    added = ["packet", *Packet._fields, "error"]
    source = media_df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)), F.col(media).alias("_media"))
    kept = [f"c{i} {media_df.schema[c].dataType.simpleString()}" for i, c in enumerate(names)]
    out = source.mapInArrow(run, ", ".join([*kept, "packet int, track long, timestamp_ns long, offset long, size long, keyframe boolean, lacing int, cluster int, cued boolean, error string"]))
    shown = added if errors == "column" else added[:-1]
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in shown), *shown)


def with_column(docs: DataFrame, value, inner: str, run, name: str, kind: str) -> DataFrame:
    names = docs.columns
    source = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)), value.alias(inner))
    kept = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)]
    out = source.mapInArrow(run, ", ".join([*kept, f"{run_name(kind)} {kind}"]))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c != name), F.col(run_name(kind)).alias(name))


def run_name(kind: str) -> str:
    return "media" if kind == "binary" else "value"


def padded(text: bytes) -> bytes:
    """The bytes of a text and zeros up to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % 64 or 64 * (not text))


def digest(text: bytes) -> tuple:
    """Stores a text's payload, reads it back through the packet table, and sums it up."""
    media = pack(padded(text))
    about, found = parse(media)
    back = b"".join([media[p.offset : p.offset + p.size] for p in found])
    at_cues = sum(int.from_bytes(media[about["segment"] + pos : about["segment"] + pos + 4], "big") == CLUSTER for _, pos, _ in about["cues"])
    kinds = [sum(p.lacing == k for p in found) for k in range(4)]
    last = found[-1].timestamp_ns // 1_000_000
    feature = f"packets={len(found)};clusters={about['clusters']};cues={at_cues};lacing={'/'.join(map(str, kinds))};last_ms={last};duration_ms={about['duration']:.3f};codec={about['tracks'][1]['codec']}"
    return len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature


FIELDS = {"n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}


def media_digests(docs: DataFrame) -> DataFrame:
    """By document, what its stored payload reads back as."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [digest(x or b"") for x in batch.column("body").to_pylist()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(FIELDS.values())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *FIELDS])

    source = docs.select("doc_id", F.col("text").cast("binary").alias("body"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
