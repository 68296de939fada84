"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for.

The text is normalised by the longest prefixes that the model's compiled character map has a rule for; each byte written
remembers where the text read for it began. Pieces are then merged by score, and a piece's place in the normalised
text gives its span in the original one. No merge crosses two characters that stand side by side in no piece, so the
text is cut there, and parts that come again are merged once.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, texts

SPACE = "▁"  # stands for a space in pieces
_UNKNOWN_BYTES = "�"
# fixed values: field numbers and kinds of the model file's format
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_MODEL_TYPE, _SUFFIX_SPACE, _BYTE_FALLBACK, _UNKNOWN_SURFACE = 3, 24, 35, 44
_CHARACTER_MAP, _DUMMY_PREFIX, _FEWER_SPACES, _ESCAPED = 2, 3, 4, 5
_BPE, _NORMAL, _UNKNOWN, _CONTROL, _BYTE = 2, 1, 2, 3, 6

_CACHED_PARTS, _CACHED_LENGTH = 700_000, 64
_PAIR_BITS = 22  # of the table of character pairs; two pairs at the same place only cost a cut


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at : at + size]
            at += size


class CharacterMap:
    """The rules of a compiled map: a double-array trie of byte strings, and the texts that its values point to."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]
        two = np.zeros(1 << 16, bool)  # pairs of bytes that a rule may begin with
        if self.units:
            for a in range(256):
                node = self._step(self._offset(self.units[0]), a)
                if node is not None:
                    two[a << 8 : (a + 1) << 8] = bool(self.units[node] >> 8 & 1) or [self._step(node ^ self._offset(self.units[node]), b) is not None for b in range(256)]
        self.two = two

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)

    def _step(self, base: int, byte: int) -> int | None:
        """The node that a byte leads to, from the place of a node's children."""
        node = base ^ byte
        return node if byte and node < len(self.units) and self.units[node] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """The end of the longest prefix of ``data[at:]`` that has a rule, and what to write for it."""
        found, base, end = None, self._offset(self.units[0]), at
        while end < len(data) and (node := self._step(base, data[end])) is not None:
            end += 1
            unit = self.units[node]
            base = node ^ self._offset(unit)
            if unit >> 8 & 1:
                found = end, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        end, begun = found
        return end, self.texts[begun : self.texts.index(b"\0", begun)]


class PieceModel:
    """A model of kind BPE with byte fallback; others are refused."""

    def __init__(self, data: bytes):
        trainer, rules, rows = {}, {}, []
        for number, value in fields(data):
            if number == _PIECES:
                rows.append({1: b"", 2: b"\0" * 4, 3: _NORMAL} | dict(fields(value)))
            elif number == _TRAINER:
                trainer |= dict(fields(value))
            elif number == _NORMALIZER:
                rules |= dict(fields(value))
        kinds = [r[3] for r in rows]
        if trainer.get(_MODEL_TYPE) != _BPE or not trainer.get(_BYTE_FALLBACK) or trainer.get(_SUFFIX_SPACE):
            raise ValueError("not a BPE model with byte fallback and leading spaces")
        if set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or not rules.get(_ESCAPED, 1):
            raise ValueError("the model has kinds of pieces that are not supported")
        self.pieces = [r[1].decode() for r in rows]
        self.names = [str(i) for i in range(len(rows))]
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == _NORMAL}
        self.scores = [struct.unpack("<f", r[2])[0] for r in rows]
        byte = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == _BYTE}
        self.bytes = [byte[f"<0x{b:02X}>"] for b in range(256)]
        self.controls = {i for i, k in enumerate(kinds) if k == _CONTROL}
        self.unknown = {i for i, k in enumerate(kinds) if k == _UNKNOWN}
        self.unknown_surface = trainer.get(_UNKNOWN_SURFACE, b" \xe2\x81\x87 ")
        value = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.surfaces = [value.get(i) or p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.is_byte = np.isin(np.arange(len(rows)), self.bytes)
        self.lengths = np.array([1 if b else len(p.encode()) for p, b in zip(self.pieces, self.is_byte, strict=True)])
        self.prefix, self.fewer = bool(rules.get(_DUMMY_PREFIX, 1)), bool(rules.get(_FEWER_SPACES, 1))
        self.map = CharacterMap(rules.get(_CHARACTER_MAP, b""))
        self.together = np.zeros(1 << _PAIR_BITS, bool)
        for p in self.ids:
            self.together[self._pairs(p)] = True
        self._parts: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _pairs(text: str) -> np.ndarray:
        """A place in the table for each two neighbours."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return (codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _PAIR_BITS)

    def normalised(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The text as pieces spell it, and for each of its bytes (and its end) where the text read for it begins."""
        if not data:
            return b"", np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)
        source = np.arange(len(raw))
        if not data.isascii():
            source[raw & 0xC0 == 0x80] = 0
            source = np.maximum.accumulate(source)  # bytes of one character begin together
        end = len(raw)
        if self.map.units:
            raw, source = self._mapped(data, raw, source)
        space = raw == 32
        if self.fewer:
            keep = ~space
            keep[1:] |= ~space[:-1]  # a space stays where none stands before it
            escaped = raw.tobytes().replace(SPACE.encode(), b" " * len(SPACE.encode()))  # these go at the end too
            last = len(escaped.rstrip(b" "))
            if not last:
                return b"", np.zeros(1, np.int64)
            if last < len(raw):
                end = int(source[last])
            keep[last:] = False
            raw, source, space = raw[keep], source[keep], space[keep]
        begun = int(source[0]) if len(source) else end
        out = raw.tobytes().replace(b" ", SPACE.encode())
        source = np.repeat(source, np.where(space, len(SPACE.encode()), 1))
        if self.prefix:
            out = SPACE.encode() + out
            source = np.concatenate((np.full(len(SPACE.encode()), begun), source))
        return out, np.append(source, end)

    def _mapped(self, data: bytes, raw: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        following = np.append(raw[1:], 0).astype(np.int64)
        written, begun, at = [], [], 0
        for place in np.flatnonzero(self.map.two[raw.astype(np.int64) << 8 | following] & (raw & 0xC0 != 0x80)).tolist():
            if place < at or (found := self.map.longest(data, place)) is None:
                continue
            stop, text = found
            written += [raw[at:place], np.frombuffer(text, np.uint8)]
            begun += [source[at:place], np.full(len(text), place)]
            at = stop
        return np.concatenate([*written, raw[at:]]), np.concatenate([*begun, source[at:]])

    def _merged(self, part: str) -> tuple[int, ...]:
        """Merge neighbours into the piece of the highest score, leftmost first, until none is left."""
        symbols: list[str] = list(part)
        left, right = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(symbols) and (known := self.ids.get(symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-self.scores[known], i, j, symbols[i] + symbols[j]))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, piece = heapq.heappop(heap)
            if right[i] != j or not symbols[i] or symbols[i] + symbols[j] != piece:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = piece, ""
            right[i] = right[j]
            if right[i] < len(symbols):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        out: list[int] = []
        for s in filter(None, symbols):
            known = self.ids.get(s)
            out += [known] if known is not None else [self.bytes[b] for b in s.encode()]
        return tuple(out)

    def _part(self, part: str) -> tuple[int, ...]:
        ids = self._merged(part)
        if len(part) <= _CACHED_LENGTH:
            if len(self._parts) >= _CACHED_PARTS:
                self._parts.clear()
            self._parts[part] = ids
        return ids

    def encode(self, data: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids of a whole text, and where the bytes that each stands for begin and end in it."""
        out, source = self.normalised(data)
        if not out:
            return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = out.decode()
        cuts = (np.flatnonzero(~self.together[self._pairs(text)]) + 1).tolist()
        parts = [text[a:b] for a, b in pairwise([0, *cuts, len(text)])]
        found = list(map(self._parts.get, parts))
        if None in found:
            found = [self._parts.get(p) or self._part(p) for p in parts]
        ids = list(chain.from_iterable(found))
        ends = np.cumsum(self.lengths[ids])
        return ids, source[np.concatenate(([0], ends[:-1]))], source[ends]

    def decode(self, ids: list[int]) -> bytes:
        """The text of any ids, in UTF-8: without the space in front, with U+FFFD for bytes that are no character."""
        out: list[bytes] = []
        held = bytearray()
        begun = False  # whether the space in front has been met, or any text
        for i in ids:
            if self.is_byte[i]:
                held += self.surfaces[i]
                continue
            if held:
                out.append(_characters(bytes(held)))
                held.clear()
            begun = begun or any(out)
            if i in self.controls:
                continue
            piece = self.unknown_surface if i in self.unknown else self.surfaces[i]
            if not begun and (self.prefix or self.fewer) and piece[:1] == b" " and i not in self.unknown:
                piece, begun = piece[1:], not self.fewer
            out.append(piece)
        return b"".join([*out, _characters(bytes(held))])

    def plain(self, ids: list[int]) -> bytes:
        """:meth:`decode` of the ids of a text, whose bytes are whole characters."""
        out = b"".join(map(self.surfaces.__getitem__, ids))
        return out[1:] if self.prefix and out[:1] == b" " else out


def _characters(data: bytes) -> bytes:
    """Bytes as characters; each byte that is in none becomes U+FFFD."""
    try:
        data.decode()
        return data
    except UnicodeDecodeError:
        pass
    out, at = "", 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out += data[at : at + size].decode()
                break
            except UnicodeDecodeError:
                pass
        else:
            out, size = out + _UNKNOWN_BYTES, 1
        at += size
    return out.encode()


@lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    """One model for each Python worker and file."""
    with open(path, "rb") as file:
        return PieceModel(file.read())


def encode_documents(docs: DataFrame, model_path: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, ids, begins, ends, decoded``: the pieces of every whole text, the bytes of the original text (in UTF-8) that each
    stands for, and the decoded text (binary).

    Of a character that is spelt in bytes the last one has the character's span, the others an empty span at its beginning; so do
    all but the last byte of what a rule of the character map has rewritten. A null text is empty and has no ids.
    Rows keep their number, repeated and null keys included; no other column is read. Memory is bounded by an
    Arrow batch of texts, a few numbers for each byte of one text, and a cache of fixed size.
    """
    schema = "ids array<int>, begins array<long>, ends array<long>, decoded binary"
    return _encoded(docs, model_path, text, key, schema, _arrays)


def digest_documents(docs: DataFrame, model_path: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, ids_sha256`` (of the decimal ids, joined by commas), ``decoded_sha256``, ``covered_bytes`` (how many bytes
    of the original text the spans hold together) and ``spans_sha256`` (of the spans' ends as little-endian 64-bit integers)."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long, spans_sha256 string"
    return _encoded(docs, model_path, text, key, schema, _digests)


def _arrays(m: PieceModel, found: list[tuple[list[int], np.ndarray, np.ndarray]]) -> list[pa.Array]:
    ids, begins, ends = zip(*found, strict=True) if found else ([], [], [])
    return [
        pa.array(ids, pa.list_(pa.int32())), pa.array(begins, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
        pa.array([_decoded(m, i) for i in ids], pa.binary()),
    ]


def _decoded(m: PieceModel, ids: list[int]) -> bytes:
    return m.decode(ids) if m.fewer or not m.prefix else m.plain(ids)


def _digests(m: PieceModel, found: list[tuple[list[int], np.ndarray, np.ndarray]]) -> list[pa.Array]:
    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    return [
        pa.array([len(ids) for ids, _, _ in found], pa.int64()),
        pa.array([sha(",".join(map(m.names.__getitem__, ids)).encode()) for ids, _, _ in found], pa.string()),
        pa.array([sha(_decoded(m, ids)) for ids, _, _ in found], pa.string()),
        pa.array([int((ends - begins).sum()) for _, begins, ends in found], pa.int64()),
        pa.array([sha(ends.astype("<i8").tobytes()) for _, _, ends in found], pa.string()),
    ]


def _encoded(docs, model_path, text, key, schema, columns) -> DataFrame:
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns(m, [m.encode(t) for t in texts(batch)])], names=names)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    names = ["key", *[c.split()[0] for c in schema.split(", ")]]
    return rows.mapInArrow(run, f"key long, {schema}").withColumnRenamed("key", key)
