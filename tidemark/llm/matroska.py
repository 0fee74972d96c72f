"""Matroska media columns: mux payloads into a container, parse containers into packet tables.

The parser walks variable-length EBML elements (sizes known or unknown), clusters with simple blocks and block
groups, the three kinds of lacing, and cues; each packet has its timestamp, track and byte range in the file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text
from tidemark.plans.runtime import map_arrow

# Element ids of the Matroska format.
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, DEFAULT_DURATION, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x23E383, 0x86
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1

#: Bytes of a frame, samples a second, frames of a block, blocks of a cluster (30 s: offsets fit 16 bits), start of a cluster's children.
FRAME, RATE, LACED, BLOCKS = 192, 8000, 125, 10
FRAME_MS = 1000 * FRAME // RATE


def element(kind: int, data: bytes) -> bytes:
    head = kind.to_bytes((kind.bit_length() + 7) // 8, "big")
    n = len(data)
    width = next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return head + (n | 1 << 7 * width).to_bytes(width, "big") + data


def number(kind: int, value: int) -> bytes:
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def real(kind: int, value: float) -> bytes:
    return element(kind, struct.pack(">d", value))


HEADER = element(EBML, number(EBML_VERSION, 1) + number(EBML_READ_VERSION, 1) + number(EBML_MAX_ID, 4) + number(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + number(DOC_TYPE_VERSION, 4) + number(DOC_TYPE_READ_VERSION, 2))
TRACK = element(TRACKS, element(TRACK_ENTRY, number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + number(FLAG_LACING, 1) + number(DEFAULT_DURATION, FRAME_MS * 1_000_000) + element(CODEC_ID, b"A_PCM/INT/LIT") + element(AUDIO, real(SAMPLING_FREQUENCY, RATE) + number(CHANNELS, 1) + number(BIT_DEPTH, 8))))


def mux(payload: bytes) -> bytes:
    """A file with one track of unsigned 8-bit samples; *payload* is a positive multiple of FRAME bytes. Frames are laced."""
    frames = len(payload) // FRAME
    info = element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + real(DURATION, frames * FRAME_MS) + element(MUXING_APP, b"tidemark") + element(WRITING_APP, b"tidemark"))
    parts, cues, at = [info, TRACK], [], len(info) + len(TRACK)
    for first in range(0, frames, LACED * BLOCKS):
        start, last = first * FRAME_MS, min(frames, first + LACED * BLOCKS)
        blocks = [number(TIMESTAMP, start)]
        for k in range(first, last, LACED):
            n = min(LACED, last - k)
            # Track 1, offset from the cluster, flags: key frame, and fixed-size lacing where several frames share the block.
            head = struct.pack(">BhB", 0x81, k * FRAME_MS - start, 0x80 | (0x04 if n > 1 else 0)) + (bytes([n - 1]) if n > 1 else b"")
            blocks.append(element(SIMPLE_BLOCK, head + payload[k * FRAME : (k + n) * FRAME]))
        parts.append(element(CLUSTER, b"".join(blocks)))
        cues.append(element(CUE_POINT, number(CUE_TIME, start) + element(CUE_TRACK_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER_POSITION, at))))
        at += len(parts[-1])
    return HEADER + element(SEGMENT, b"".join([*parts, element(CUES, b"".join(cues))]))


class Media(NamedTuple):
    """tracks: number → properties; cues: (time, track, byte of the cluster); packets: (timestamp in ns, track, byte, bytes, key, cluster) rows."""

    tracks: dict[int, dict]
    cues: list[tuple[int, int, int]]
    packets: np.ndarray
    clusters: list[int]


class Parser:
    """Reads one file. Damaged or truncated input raises ValueError."""

    MASTERS = frozenset((SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_TRACK_POSITIONS))
    #: Elements that end a cluster of unknown size, or a segment's.
    TOP = frozenset((CLUSTER, CUES, TRACKS, INFO))

    def __init__(self, data: bytes):
        self.data, self.scale = data, 1_000_000
        self.tracks: dict[int, dict] = {}
        self.cues: list[list[int]] = []
        self.packets: list[np.ndarray] = []
        self.clusters: list[int] = []
        self.time, self.base, self.track = 0, 0, {}

    def vint(self, at: int, marked: bool = False) -> tuple[int, int]:
        """(value, next byte) of a variable-length integer; with its length marker for ids; -1 for an unknown size."""
        if at >= len(self.data) or not self.data[at]:
            raise ValueError(f"no element at byte {at}")
        width = 9 - self.data[at].bit_length()
        value = int.from_bytes(self.data[at : at + width], "big")
        if at + width > len(self.data):
            raise ValueError(f"cut off at byte {at}")
        if marked:
            return value, at + width
        value &= (1 << 7 * width) - 1
        return (-1 if value == (1 << 7 * width) - 1 else value), at + width

    def parse(self) -> Media:
        kind, _ = self.vint(0, True)
        if kind != EBML:
            raise ValueError("no EBML header")
        try:
            self.walk(0, len(self.data), None)
        except (struct.error, KeyError, IndexError, RecursionError, OverflowError) as e:
            raise ValueError("a damaged file") from e
        packets = np.concatenate(self.packets) if self.packets else np.zeros((0, 6), np.int64)
        return Media(self.tracks, [(t * self.scale, n, c + self.base) for t, n, c in self.cues], packets, self.clusters)

    def walk(self, at: int, end: int, parent: int | None) -> int:
        """Elements from byte *at*; returns where they end: before *end* only in parents of unknown size."""
        while at < end:
            kind, body = self.vint(at, True)
            if parent == CLUSTER and kind in self.TOP:
                return at
            size, body = self.vint(body)
            stop = end if size < 0 else body + size
            if stop > end:
                raise ValueError(f"element {kind:x} at byte {at} runs past its parent")
            if kind in self.MASTERS:
                self.enter(kind, at, body)
                stop = self.walk(body, stop, kind) if size < 0 else (self.walk(body, stop, kind), stop)[1]
                if kind == TRACK_ENTRY:
                    self.tracks[self.track.get("number", 0)] = self.track
            else:
                self.leaf(kind, body, stop)
            at = stop
        return at

    def enter(self, kind: int, at: int, body: int) -> None:
        if kind == SEGMENT:
            self.base = body
        elif kind == CLUSTER:
            self.clusters.append(at)
            self.time = 0
        elif kind == TRACK_ENTRY:
            self.track = {}
        elif kind == CUE_POINT:
            self.point, self.cue_time = len(self.cues), 0
        elif kind == CUE_TRACK_POSITIONS:
            self.cues.append([self.cue_time, 0, 0])

    def leaf(self, kind: int, at: int, end: int) -> None:
        whole = lambda: int.from_bytes(self.data[at:end], "big")
        if kind in (SIMPLE_BLOCK, BLOCK):
            self.packets.append(self.block(at, end, kind == SIMPLE_BLOCK))
        elif kind == TIMESTAMP:
            self.time = whole()
        elif kind == TIMESTAMP_SCALE:
            self.scale = whole()
        elif kind == CUE_TIME:
            self.cue_time = whole()
            for cue in self.cues[self.point :]:
                cue[0] = self.cue_time
        elif kind in (CUE_TRACK, CUE_CLUSTER_POSITION) and self.cues:
            self.cues[-1][1 if kind == CUE_TRACK else 2] = whole()
        elif kind in (TRACK_NUMBER, TRACK_TYPE, DEFAULT_DURATION, CHANNELS, BIT_DEPTH):
            self.track[{TRACK_NUMBER: "number", TRACK_TYPE: "type", DEFAULT_DURATION: "frame_ns", CHANNELS: "channels", BIT_DEPTH: "bits"}[kind]] = whole()
        elif kind == CODEC_ID:
            self.track["codec"] = self.data[at:end].decode("ascii", "replace")
        elif kind == SAMPLING_FREQUENCY:
            self.track["rate"] = struct.unpack({4: ">f", 8: ">d"}[end - at], self.data[at:end])[0]

    def block(self, at: int, end: int, simple: bool) -> np.ndarray:
        track, at = self.vint(at)
        offset, flags = struct.unpack_from(">hB", self.data, at)
        at += 3
        sizes, at = self.laced(flags >> 1 & 3, at, end)
        if min(sizes) < 0 or at + sum(sizes) > end:
            raise ValueError(f"lacing of the block that ends at byte {end}")
        out = np.empty((len(sizes), 6), np.int64)
        step = self.tracks.get(track, {}).get("frame_ns", 0)
        out[:, 0] = (self.time + offset) * self.scale + step * np.arange(len(sizes))
        out[:, 1] = track
        out[:, 3] = sizes
        out[:, 2] = at + np.cumsum(out[:, 3]) - out[:, 3]
        out[:, 4] = flags >> 7 if simple else 0
        out[:, 5] = len(self.clusters) - 1
        return out

    def laced(self, kind: int, at: int, end: int) -> tuple[list[int], int]:
        """(sizes of the frames, first byte of the first): 0 none, 1 Xiph, 2 fixed, 3 EBML."""
        if kind == 0:
            return [end - at], at
        n, at = self.data[at] + 1, at + 1
        if kind == 2:
            if (end - at) % n:
                raise ValueError(f"fixed lacing of the block that ends at byte {end}")
            return [(end - at) // n] * n, at
        sizes: list[int] = []
        for k in range(n - 1):
            if kind == 1:
                size = 0
                while self.data[at] == 255:
                    size, at = size + 255, at + 1
                size, at = size + self.data[at], at + 1
            else:
                size, after = self.vint(at)
                # Later sizes are differences, moved by half the range to be signed.
                size = size if k == 0 else sizes[-1] + size - ((1 << 7 * (after - at) - 1) - 1)
                at = after
            sizes.append(size)
        return [*sizes, end - at - sum(sizes)], at


def payload_of(media: bytes, packets: np.ndarray) -> bytes:
    """The packets' bytes in file order; neighbouring ranges are cut out at once."""
    if not len(packets):
        return b""
    starts, ends = packets[:, 2], packets[:, 2] + packets[:, 3]
    breaks = np.flatnonzero(starts[1:] != ends[:-1])
    return b"".join(media[a:b] for a, b in zip(starts[np.append(0, breaks + 1)], ends[np.append(breaks, len(ends) - 1)]))


def feature(parsed: Media, samples: np.ndarray) -> str:
    """Counts of the container and integer features of the samples."""
    centred = samples.astype(np.int64) - 128
    crossings = int(np.count_nonzero(np.diff(np.signbit(centred))))
    ms = (int(parsed.packets[-1, 0]) // 1_000_000 + FRAME_MS) if len(parsed.packets) else 0
    return f"packets={len(parsed.packets)};clusters={len(parsed.clusters)};cues={len(parsed.cues)};ms={ms};sum={int(centred.sum())};energy={int((centred * centred).sum())};crossings={crossings}"


def padded(text: str) -> tuple[int, bytes]:
    """(bytes of the text in UTF-8, those with spaces up to a positive multiple of FRAME)."""
    data = text.encode("utf-8")
    return len(data), data + b" " * (max(1, -(-len(data) // FRAME)) * FRAME - len(data))


def to_media(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, media) for each row: its whole text, padded, as an 8-bit audio file. A null text is the empty text."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                made = [padded(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([mux(p) for _, p in made], pa.binary())], ["id", "n_bytes", "media"])

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return map_arrow(rows, write, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, media binary").withColumnRenamed("id", id_column)


def packet_table(media: DataFrame, id_column: str = "doc_id", media_column: str = "media") -> DataFrame:
    """(id, packet, timestamp_ns, track, byte_start, n_bytes, key_frame, cluster) for each packet of each file.

    Null, empty and damaged files have no packets.
    """

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k, data in enumerate(batch.column(1).to_pylist()):
                try:
                    p = Parser(data or b"").parse().packets
                except ValueError:
                    continue
                ids = pa.concat_arrays([batch.column(0).slice(k, 1)]).take(pa.array(np.zeros(len(p), np.int64)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.arange(len(p)), pa.int64()), *(pa.array(np.ascontiguousarray(p[:, c]), pa.int64()) for c in range(4)), pa.array(p[:, 4] == 1), pa.array(np.ascontiguousarray(p[:, 5]), pa.int64())], ["id", "packet", "timestamp_ns", "track", "byte_start", "n_bytes", "key_frame", "cluster"])

    rows = media.select(F.col(id_column).alias("id"), F.col(media_column).alias("media"))
    out = f"id {rows.schema['id'].dataType.simpleString()}, packet long, timestamp_ns long, track long, byte_start long, n_bytes long, key_frame boolean, cluster long"
    return map_arrow(rows, read, out).withColumnRenamed("id", id_column)


def media_digests(media: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Digests of the stored files of ``to_media`` and of the payload read back through their packet tables."""

    def read(batches: Iterator) -> Iterator:
        import zlib
        from hashlib import sha256

        import pyarrow as pa

        for batch in batches:
            rows = []
            for data in batch.column(2).to_pylist():
                parsed = Parser(data).parse()
                payload = payload_of(data, parsed.packets)
                rows.append((len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), sha256(data).hexdigest(), feature(parsed, np.frombuffer(payload, np.uint8))))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    rows = media.select(F.col(id_column).alias("id"), "n_bytes", "media")
    out = f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_arrow(rows, read, out).withColumnRenamed("id", id_column)
