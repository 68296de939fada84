"""Token ids in ORC: one row a document, in key order, with stripes that are read in parallel and skipped by their metadata.

ORC stores the integer lists run-length encoded, keeps minimum and maximum of the key for each stripe and row
group, and a Bloom filter on it; Spark splits files at stripes and pushes filters on the key into the reader.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_batches, texts
from .shingles import chunks, words_of

_SLOTS, _CACHED_WORDS, _CACHED_IDS = 1 << 22, 2_000_000, 30_000_000
_WORDS_A_CALL, _BYTES_AT_ONCE = 100, 2 << 20
_ROWS_BETWEEN_CHECKS = 10
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
SCHEMA = "part int, doc_id long, start_in_part long, ids array<int>"


class WordCache:
    """The tokenizer's ids of whole texts, with its work on each distinct word kept.

    Sound for tokenizers that drop white space, never look across it, and lower case; ``word_bpe_49k.json`` is
    one, and others are refused. Words are looked up many at a time in a table of their 64-bit hashes; length and first eight
    bytes are compared too, so shorter words are told apart for sure. Texts that may hold a special token, and texts of
    which two words share a hash, go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self._plain(b"Ab\n CD ") != self._plain(b"ab") + self._plain(b"cd"):
            raise ValueError("the tokenizer does not take words one by one in lower case")
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.int32)  # open addressing; key 0 is free
        self.starts, self.lengths, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
        self.looks = np.empty((2, 0), np.uint64)  # of each word its first bytes and its length

    def _plain(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The words' places, -1 if unknown."""
        slot, out = (hashes % np.uint64(_SLOTS)).astype(np.int64), np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        while len(left):
            keys = self.keys[slot[left]]
            hit = keys == hashes[left]
            out[left[hit]] = self.slots[slot[left[hit]]]
            left = left[~hit & (keys != 0)]
            slot[left] = (slot[left] + 1) % _SLOTS
        return out

    def _learn(self, words: list[str], hashes: np.ndarray, looks: np.ndarray) -> None:
        """Encode new words, many to a call; a token belongs to the word it begins in."""
        counts, ids = [], []
        lines = [words[i : i + _WORDS_A_CALL] for i in range(0, len(words), _WORDS_A_CALL)]
        for line, e in zip(lines, self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ends = np.cumsum(np.fromiter(map(len, line), np.int64, len(line)) + 1)
            begins = np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0]
            counts.append(np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(line)))
            ids.append(np.array(e.ids, np.int32))
        lengths, places = np.concatenate(counts), len(self.starts) + np.arange(len(words))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, *ids))
        self.looks = np.concatenate((self.looks, looks), axis=1)
        slot, left = (hashes % np.uint64(_SLOTS)).astype(np.int64), np.arange(len(hashes))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]  # one word for each free slot; the others go on
            self.keys[slot[put]], self.slots[slot[put]] = hashes[put], places[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) % _SLOTS

    def _group(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, and how many each has."""
        if len(self.starts) > _CACHED_WORDS or len(self.ids) > _CACHED_IDS:
            self.clear()
        blob, starts, ends, hashes, at = words_of(pieces)
        sizes = ends - starts
        first = np.ndarray((len(blob),), "<u8", np.concatenate((blob, np.zeros(8, np.uint8))), strides=(1,))[starts]
        looks = np.stack((first & _MASKS[np.minimum(sizes, 8)], sizes.astype(np.uint64)))
        hashes = np.maximum(hashes, np.uint64(1))
        places = self._find(hashes)
        if (places < 0).any():
            new = np.flatnonzero(places < 0)
            new = new[np.unique(hashes[new], return_index=True)[1]]
            words = [blob[a:b].tobytes().decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            self._learn(words, hashes[new], looks[:, new])
            places = self._find(hashes)
        if (self.looks[:, places] != looks).any() or b"<|" in blob.tobytes():
            found = [self._plain(p) for p in pieces]
            return np.array(list(chain.from_iterable(found)), np.int32), np.array([len(f) for f in found], np.int64)
        lengths = self.lengths[places]
        after = np.concatenate(([0], np.cumsum(lengths)))
        # where each id stands in the cache: the word's start, plus the place in the word
        ids = self.ids[np.repeat(self.starts[places] - after[:-1], lengths) + np.arange(after[-1])]
        return ids, np.diff(after[at])

    def encode(self, documents: list[bytes], end_id: int) -> pa.ListArray:
        """The ids of each text and the end id."""
        counts, out = np.zeros(len(documents), np.int64), [np.empty(0, np.int32)]
        held: list[tuple[int, bytes]] = []

        def flush() -> None:
            if held:
                ids, sizes = self._group([p for _, p in held])
                out.append(ids)
                np.add.at(counts, [d for d, _ in held], sizes)
                held.clear()

        size = 0
        for d, text in enumerate(documents):
            for piece in chunks(text):
                held.append((d, piece))
                size += len(piece)
                if size > _BYTES_AT_ONCE:
                    flush()
                    size = 0
        flush()
        stops = np.concatenate(([0], np.cumsum(counts)))
        ids = np.insert(np.concatenate(out), stops[1:], end_id)
        return pa.ListArray.from_arrays(pa.array((stops + np.arange(len(stops))).astype(np.int32)), pa.array(ids))


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    return WordCache(path)


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str | None = None,
    end_id: int = 2,
    text: str = "text",
    key: str = "doc_id",
    stripe_bytes: int = 16 << 20,
    rows_per_index: int = 1000,
    false_positives: float = 0.01,
) -> None:
    """Encode every whole text, append ``end_id``, and write the ids as ORC in ascending key order.

    File n holds range n of the keys (column ``part``). A null text has only the end id. Null keys come first;
    rows with the same key are ordered by a hash of the text, equal rows are all kept. Other columns are not read.
    The ranges come from the keys and that hash, so a hot key is spread over files.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    tokenizer = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, cache = TaskContext.get().partitionId(), 0, word_cache(tokenizer)
        for batch in batches:
            ids = cache.encode(texts(batch), end_id)
            ends = before + np.asarray(ids.offsets)[1:].astype(np.int64)
            starts = np.concatenate(([before], ends[:-1])) if len(ends) else ends
            before = int(ends[-1]) if len(ends) else before
            columns = [pa.array(np.full(len(ids), part, np.int32)), batch.column(0), pa.array(starts), ids]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "start_in_part", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), "_tie"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    (
        ordered.mapInArrow(run, SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(false_positives))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(rows_per_index))
        .option("orc.stripe.size", str(stripe_bytes))
        # rows are long: a full stripe is closed after few batches (of 32768 ids), whatever stands between two index entries
        .option("orc.rows.between.memory.checks", str(_ROWS_BETWEEN_CHECKS))
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read(spark: SparkSession, path: str, keys: Sequence[int] | None = None, between: tuple[int, int] | None = None) -> DataFrame:
    """Documents of a store; a list or range of keys is pushed into the reader, which skips stripes and row groups."""
    rows = spark.read.schema(SCHEMA).orc(path)
    if keys is not None:
        rows = rows.filter(F.col("doc_id").isin(list(keys)))
    return rows if between is None else rows.filter(F.col("doc_id").between(*between))


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """``part`` and ``base``: how many ids all earlier files hold. One row a file, whatever the files hold."""
    parts = spark.read.schema(SCHEMA).orc(path).groupBy("part").agg(F.sum(F.size("ids").cast("long")).alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("long").alias("base"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """From the files: ``doc_id``, ``start`` (ids of all rows before it), ``n_tokens`` and ``ids_crc32`` of the
    ids as little-endian unsigned 32-bit integers."""
    arrow_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            data, at = np.asarray(ids.values).astype("<u4"), np.asarray(ids.offsets)
            crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"])

    rows = read(spark, path).mapInArrow(run, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")
    # one row a file: at most as many as the write had shuffle partitions
    return rows.join(F.broadcast(offsets(spark, path)), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"
    )
