"""Byte-level BPE by prefix dynamic programming.

For a byte string under fixed merge ranks there is exactly one token that ends the encoding of each of its
prefixes. A token may follow another exactly if the two, put together as bytes, encode to just these two. So
the last token of a prefix is the one vocabulary entry that ends there and may follow the last token of what
is left before it, and the whole encoding is read backwards from the end. Since entries depend only on what
stands before them, text can be appended without encoding again, and after an edit only entries behind the
edit change.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

#: White space that the fast cut into units does not handle; texts with it are split as a whole.
_RARE_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -     　﻿]")
#: The pattern's matches never run from other characters into white space, so a text may be cut there.
_UNIT = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")

_CACHED_UNITS, _CACHED_PREFIXES, _CACHED_LENGTH = 700_000, 1_500_000, 64


class PrefixEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.names = {i: str(i) for i in self.tokens}
        lengths = sorted({len(b) for b in ranks}, reverse=True)
        self.lengths = [[n for n in lengths if n <= end] for end in range(max(lengths, default=0) + 1)]
        self.split = regex.compile(pattern).findall
        self._follows: dict[tuple[int, int], bool] = {}
        self._units: dict[str, tuple[int, ...]] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._last: dict[bytes, int] = {}  # last tokens of prefixes, which many pieces share

    def merged(self, text: bytes) -> list[int]:
        """Encoding by the definition: merge the neighbours with the lowest rank, leftmost first. Used on short strings."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while True:
            best = min(
                ((r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None),
                default=None,
            )
            if best is None:
                return [self.ranks[p] for p in parts]
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def may_follow(self, before: int, token: int) -> bool:
        """Whether the two tokens stay as they are side by side; -1 stands for the start."""
        known = self._follows.get((before, token))
        if known is None:
            pair = [token] if before < 0 else [before, token]
            text = b"".join(self.tokens[t] for t in pair)
            known = (before < 0 or text not in self.ranks) and self.merged(text) == pair
            if len(self._follows) >= _CACHED_PREFIXES:
                self._follows.clear()
            self._follows[before, token] = known
        return known

    def last_token(self, last: list[int], prefix: bytes) -> int:
        """The token that ends the encoding of ``prefix``, given those of all its shorter prefixes."""
        end = len(prefix)
        for n in self.lengths[min(end, len(self.lengths) - 1)]:
            token = self.ranks.get(prefix[end - n :])
            if token is not None and self.may_follow(last[end - n], token):
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def extend(self, last: list[int], text: bytes) -> None:
        """Continue the table of last tokens (``last[0]`` is -1) to the end of ``text``."""
        longest = len(self.lengths) - 1
        for end in range(len(last), len(text) + 1):
            window = text[max(0, end - longest) : end]  # as far as the longest token can reach
            last.append(self.last_token(last[end - len(window) :], window))

    def last_of(self, text: bytes) -> int:
        """The token that ends the encoding of a short text. Prefixes are looked at as they are needed, and
        kept: other pieces begin alike."""
        token = self._last.get(text)
        if token is not None:
            return token
        end = len(text)
        for n in self.lengths[min(end, len(self.lengths) - 1)]:
            token = self.ranks.get(text[end - n :])
            if token is not None and self.may_follow(self.last_of(text[: end - n]) if n < end else -1, token):
                if len(self._last) >= _CACHED_PREFIXES:
                    self._last.clear()
                self._last[text] = token
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def read(self, last: list[int]) -> list[int]:
        """The ids that a table of last tokens stands for."""
        out, end = [], len(last) - 1
        while end:
            out.append(last[end])
            end -= len(self.tokens[last[end]])
        return out[::-1]

    def piece(self, text: bytes) -> list[int]:
        """Encode one match of the pattern; a match that is itself an entry is that entry."""
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        if len(text) > _CACHED_LENGTH:
            last = [-1]
            self.extend(last, text)
            return self.read(last)
        out = []
        while text:
            out.append(self.last_of(text))
            text = text[: -len(self.tokens[out[-1]])]
        return out[::-1]

    def _match(self, match: str) -> tuple[int, ...]:
        ids = self._pieces.get(match)
        if ids is None:
            ids = tuple(self.piece(match.encode()))
            if len(match) <= _CACHED_LENGTH:
                if len(self._pieces) >= _CACHED_UNITS:
                    self._pieces.clear()
                self._pieces[match] = ids
        return ids

    def _unit(self, unit: str) -> tuple[int, ...]:
        matches = self.split(unit)
        ids = self._match(matches[0]) if len(matches) == 1 else tuple(chain.from_iterable(map(self._match, matches)))
        if len(unit) <= _CACHED_LENGTH:
            if len(self._units) >= _CACHED_UNITS:
                self._units.clear()
            self._units[unit] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, equal to encoding every match of the pattern on its own."""
        if _RARE_SPACE.search(text):
            return list(chain.from_iterable(map(self._match, self.split(text))))
        units = _UNIT.findall(text)
        found = list(map(self._units.get, units))
        if None in found:
            found = [self._unit(u) if ids is None else ids for u, ids in zip(units, found, strict=True)]
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class EncodedText:
    """A text with its tables, which takes appends and edits and encodes again only near them."""

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.pieces: list[str] = []
        self.tables: list[list[int]] = []
        self.encoded_bytes = 0  # bytes whose last token was computed, over all calls
        self.edit(0, 0, text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace the characters from ``start`` to ``stop``."""
        kept, at = 0, 0  # the pieces before the last cut that no change behind it can move
        for i, (piece, following) in enumerate(zip(self.pieces, self.pieces[1:], strict=False)):
            at += len(piece)
            if at >= start:
                break
            if not piece[-1].isspace() and following[0] in " \n\t\r":
                kept = i + 1
        begin = sum(map(len, self.pieces[:kept]))
        old = list(zip(self.pieces[kept:], self.tables[kept:], strict=True))
        self.text = self.text[:start] + new + self.text[stop:]
        fresh = self.encoder.split(self.text[begin:])
        same = 0  # pieces at the end that the change left as they were
        room = len(self.text) - start - len(new)
        while same < min(len(old), len(fresh)) and old[-1 - same][0] == fresh[-1 - same] and len(fresh[-1 - same]) <= room:
            room -= len(fresh[-1 - same])
            same += 1
        tables = []
        for i, piece in enumerate(fresh[: len(fresh) - same]):
            tables.append(self._table(piece, *old[i]) if i < len(old) - same else self._table(piece, "", [-1]))
        self.tables = self.tables[:kept] + tables + [t for _, t in old[len(old) - same :]]
        self.pieces = self.pieces[:kept] + fresh

    def _table(self, piece: str, before: str, table: list[int]) -> list[int]:
        new, had = piece.encode(), before.encode()
        common = next((i for i, (a, b) in enumerate(zip(new, had, strict=False)) if a != b), min(len(new), len(had)))
        table = table[: common + 1]
        self.encoder.extend(table, new)
        self.encoded_bytes += len(new) - common
        return table

    def ids(self) -> list[int]:
        out: list[int] = []
        for piece, table in zip(self.pieces, self.tables, strict=True):
            whole = self.encoder.ranks.get(piece.encode())
            out += [whole] if whole is not None else self.encoder.read(table)
        return out


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> PrefixEncoder:
    """One encoder for each Python worker and vocabulary file."""
    with open(path, "rb") as lines:
        return PrefixEncoder({base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}, pattern)


def encode_documents(
    docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key``, ``ids`` (array of int) and ``decoded`` (binary) for every row, in whole texts.

    A null text is empty and has no ids. Rows keep their number, repeated and null keys included; no other column
    is read. Memory is bounded by an Arrow batch of texts and a cache of fixed size.
    """
    return _encoded(docs, ranks_path, pattern, text, key, "ids array<int>, decoded binary", _arrays)


def digest_documents(
    docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256`` (of the decimal ids, joined by a space) and ``decoded_sha256``."""
    return _encoded(
        docs, ranks_path, pattern, text, key, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests
    )


def _arrays(bpe: PrefixEncoder, found: list[list[int]]) -> list[pa.Array]:
    return [pa.array(found, pa.list_(pa.int32())), pa.array([bpe.decode(ids) for ids in found], pa.binary())]


def _digests(bpe: PrefixEncoder, found: list[list[int]]) -> list[pa.Array]:
    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    return [
        pa.array([len(ids) for ids in found], pa.int64()),
        pa.array([sha(" ".join(map(bpe.names.__getitem__, ids)).encode()) for ids in found], pa.string()),
        pa.array([sha(bpe.decode(ids)) for ids in found], pa.string()),
    ]


def _encoded(docs, ranks_path, pattern, text, key, schema, columns) -> DataFrame:
    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            found = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns(bpe, found)], names=names)

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text"))
    names = [key, *[c.split()[0] for c in schema.split(", ")]]
    return rows.mapInArrow(run, f"{key} long, {schema}")
