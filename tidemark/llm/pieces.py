"""SentencePiece encoding and decoding with source offsets.

``Normalizer`` applies the model's compiled character map (a double-array trie in the model file) by longest
prefix and records, for each byte of the normalised text, the byte of the source it comes from.  Pieces are laid
over the normalised bytes, so each piece projects to a span of the original bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text
from tidemark.llm.tokens import TextCoder
from tidemark.plans.runtime import map_arrow

#: What SentencePiece writes for a space: U+2581, three bytes in UTF-8.
SPACE = "▁"
SPACE_BYTES = SPACE.encode("utf-8")


class CharacterMap:
    """The compiled map of a model: a trie's size and units, then zero-terminated replacements."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.replacements = b""
        if len(blob) > 4:
            (size,) = struct.unpack_from("<I", blob)
            self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.replacements = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest entry that is a prefix of data[at:]."""
        units = self.units
        if not units:
            return None
        found, node = None, self._step(0, units[0])
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node = self._step(node, unit)
            if unit >> 8 & 1:
                found = (k + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1] : end]

    @staticmethod
    def _step(node: int, unit: int) -> int:
        return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))


class Normalizer:
    """Normalised bytes and, for each of them and the end, the source byte they start from."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode("utf-8")
        return self._mapped(data) if self.map.units or self.squeeze or not self.escape else self._plain(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """No map entries: only spaces change."""
        if not data:
            return b"", np.zeros(1, np.int64)
        source = np.frombuffer(data, np.uint8)
        align = np.repeat(np.arange(len(data)), np.where(source == 32, 3, 1))
        out = data.replace(b" ", SPACE_BYTES)
        if self.prefix:
            out, align = SPACE_BYTES + out, np.concatenate([np.zeros(3, np.int64), align])
        return out, np.append(align, len(data))

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        pairs, at = [], 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit is None:
                n = next((n for n, top in ((1, 0x80), (2, 0xE0), (3, 0xF0)) if data[at] < top), 4)
                hit = n, data[at : at + n]
            pairs.append((at, hit[1]))
            at += hit[0]
        end = len(data)
        if self.squeeze:
            while pairs and not pairs[0][1].strip(b" "):
                pairs.pop(0)
            while pairs and not pairs[-1][1].strip(b" "):
                end = pairs.pop()[0]
            end = end if pairs else 0
        out, align, space = bytearray(), [], SPACE_BYTES if self.escape else b" "
        if pairs and self.prefix:
            out += space
            align += [pairs[0][0]] * len(space)
        blank = self.squeeze
        for at, piece in pairs:
            for k in range(len(piece)):
                byte = piece[k : k + 1]
                if byte == b" " and self.squeeze and blank:
                    continue
                blank = byte == b" "
                byte = space if blank else byte
                out += byte
                align += [at] * len(byte)
        while self.squeeze and out.endswith(space):
            end = align[-1]
            del out[-len(space) :], align[-len(space) :]
        return bytes(out), np.array([*align, end], np.int64)


class Encoded(NamedTuple):
    """ids with begin and end ids; the span of original bytes of each."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


class Pieces:
    """A model of the sentencepiece library with a cache of chunk ids."""

    _open: dict[str, Pieces] = {}

    @classmethod
    def open(cls, path: str) -> Pieces:
        """One instance a Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        self.normalizer = Normalizer(model.normalizer_spec)
        kinds = model.SentencePiece
        # Normalised bytes that each id covers; byte pieces cover one byte, control ids none.
        self.widths = np.array([0 if p.type == kinds.CONTROL else 1 if p.type == kinds.BYTE else len(p.piece.encode("utf-8")) for p in model.pieces], np.int64)
        self.unknown, self.begin, self.end = self.library.unk_id(), self.library.bos_id(), self.library.eos_id()
        apart = not any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces)
        spec = model.normalizer_spec
        self.by_chunk = apart and not self.normalizer.map.units and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces and not any(p.type == kinds.USER_DEFINED for p in model.pieces)
        self.coder = TextCoder(lambda words: [np.array(x, "<u4").tobytes() for x in map(self.library.encode, words)], lambda t: np.array(self.ids(t), "<u4").tobytes(), b"".join)
        self.bytes_of_all = self._bytes if self.by_chunk else self.coder.whole

    def ids(self, text: str) -> list[int]:
        """The library's ids of a whole text."""
        return self.library.encode(text)

    def _bytes(self, text: str) -> bytes:
        # A written U+2581 reads as a space, so it moves chunk boundaries; a leading space gets another before it.
        return self.coder.whole(text) if SPACE in text or text[:1] == " " else self.coder(text)

    def id_bytes(self, text: str) -> bytes:
        """Begin id, ids and end id of a text, as little-endian unsigned 32-bit integers."""
        return struct.pack("<I", self.begin) + self.bytes_of_all(text) + struct.pack("<I", self.end)

    def encode(self, text: str) -> Encoded:
        """ids and the original bytes each covers, found by laying the pieces over the normalised text."""
        ids = np.frombuffer(self.id_bytes(text), "<u4")
        normal, align = self.normalizer(text)
        width = self.widths[ids]
        if (ids == self.unknown).any() or width.sum() != len(normal):
            width = self._widths(text, ids, width, len(normal))
        ends = np.cumsum(width)
        return Encoded(ids, align[ends - width], align[ends])

    def _widths(self, text: str, ids: np.ndarray, width: np.ndarray, total: int) -> np.ndarray:
        """Unknown pieces cover what the library says they do."""
        width = width.copy()
        width[1:-1] = [len(p.surface.replace(" ", SPACE).encode("utf-8")) if p.id == self.unknown else width[k + 1] for k, p in enumerate(self.library.encode(text, return_type="proto").pieces)]
        if width.sum() != total:
            raise ValueError(f"pieces cover {width.sum()} of {total} normalised bytes")
        return width

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def encode_spans(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids, starts, ends, decoded) for each row: ids with begin and end ids, and the original bytes each covers.

    A null text is the empty text (begin and end id only).  Null ids and repeated rows each keep their row; other
    columns are not read; an empty table gives an empty result.
    """

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        p = Pieces.open(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [p.encode(t) for t in part.column(1).to_pylist()]
                lists = [pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in range(3)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists, pa.array([p.decode(f.ids) for f in found], pa.string())], ["id", "ids", "starts", "ends", "decoded"])

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = map_arrow(rows, encode, f"id {kind}, ids array<long>, starts array<long>, ends array<long>, decoded string")
    return out.select(F.col("id").alias(id_column), "ids", "starts", "ends", "decoded")


def encode_digests(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, spans_crc32, n_source_bytes) for each row, from the encoding of ``encode_spans``.

    Digests are made where the ids are, so the lists themselves never leave the Python worker.
    """

    def digest(batches: Iterator) -> Iterator:
        import zlib
        from hashlib import sha256

        import pyarrow as pa

        p = Pieces.open(model)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                e = p.encode(text)
                spans = zlib.crc32(np.stack([e.starts, e.ends], 1).astype("<u4").tobytes())
                rows.append((len(e.ids), sha256(e.ids.tobytes()).hexdigest(), sha256(p.decode(e.ids).encode("utf-8")).hexdigest(), spans, int(e.ends[-1])))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "n_source_bytes"])

    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = map_arrow(rows, digest, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long, n_source_bytes long")
    return out.withColumnRenamed("id", id_column)
