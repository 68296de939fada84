"""Which keys stand anywhere in which texts, in one pass over the texts.

A nested loop would compare every key with every text, and listing all parts of all texts as rows would make rows
as long as the texts together. Here the keys are first put into a bit table of fixed size (a Bloom filter). A rolling
hash gives the hash of all parts of a text that are as long as some key at once, and only parts whose bits are all
set become rows. These few are then joined with the keys as strings, so the result is exact whatever the hashes do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import matching
from .numbering import pinned

_BASE, _MIX = 0xD1342543DE82EF95, np.uint64(0x9E3779B97F4A7C15)  # odd
_BITS_A_KEY, _PROBES = 32, 3
_LEAST_BITS, _MOST_BITS = 16, 27  # of the table, as powers of two: 8 KB to 16 MB
_AT_ONCE = 1 << 20  # bytes of text that are hashed together
_GAP = b"\xff"  # between texts; no UTF-8 text has it
_LEVEL = 64  # tables that one task puts together


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(max(n, 1), base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


class RollingHash:
    """Hashes of all parts of a byte string that have a given length."""

    def __init__(self, data: bytes):
        values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        powers, self.inverse = _powers(len(values) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers[:-1], dtype=np.uint64)))

    def parts(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        found = (self.sums[length:] - self.sums[:n]) * self.inverse[:n] + np.uint64(length)
        found = (found ^ (found >> np.uint64(32))) * _MIX
        return found ^ (found >> np.uint64(29))


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of the table that stand for each hash."""
    step = (hashes * _MIX) >> np.uint64(32) | np.uint64(1)
    for i in range(_PROBES):
        yield (hashes + np.uint64(i) * step) >> np.uint64(64 - bits)


def _key_table(keys: DataFrame, bits: int) -> np.ndarray:
    """The keys' bits: one table a task, put together 64 to one, so that one table comes to the driver."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, bool)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                data = key.encode()
                for place in _places(RollingHash(data).parts(len(data)), bits):
                    table[place] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(table).tobytes()], pa.binary())], names=["bits"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits - 3, np.uint8)
        for batch in batches:
            for part in batch.column(0):
                table |= np.frombuffer(part.as_buffer(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], names=["bits"])

    tables = pinned(keys.mapInArrow(of_task, "bits binary"))
    n = tables.count()
    while n > 1:
        n = -(-n // _LEVEL)
        tables = pinned(tables.coalesce(n).mapInArrow(together, "bits binary"))
    found = tables.first()
    return np.unpackbits(np.frombuffer(bytes(found[0]), np.uint8)).view(bool) if found else np.zeros(1 << bits, bool)


def holding(texts: DataFrame, text: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``texts`` with each key that stands in their ``text``, once for each two of them.

    The result has the columns of ``texts`` but the text itself, and ``key`` as a string. Keys count once; NULL and empty keys
    stand in no text, and a NULL text holds none. Upper and lower case differ. Work is one pass over the texts for each
    length that keys have, and one row for each key found, besides the few parts that only look like keys.
    """
    columns = [c for c in texts.columns if c != text]
    if key in columns:
        raise ValueError(f"column on both sides: {key}")
    name = F.col(key).cast("string").alias(key)
    wanted = pinned(keys.select(name).filter(F.length(key) > 0).distinct())
    row = wanted.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.octet_length(key)).alias("lengths")).first()
    lengths = sorted(row.lengths)  # as many numbers as keys have lengths
    bits = int(np.clip(np.ceil(np.log2(max(row.n, 1) * _BITS_A_KEY)), _LEAST_BITS, _MOST_BITS))
    spark = texts.sparkSession
    table = spark.sparkContext.broadcast(_key_table(wanted, bits))  # 128 MB at most, as one byte a bit
    schema = texts.select(*columns, F.lit("").alias(key)).schema

    def candidates(held: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Number of the text and the part, for all parts of these texts that may be keys, once a text."""
        data = _GAP.join(held)
        starts = np.cumsum([0] + [len(t) + 1 for t in held[:-1]])
        hashes, found = RollingHash(data), set()
        for length in lengths:
            parts = hashes.parts(length)
            at = np.arange(len(parts))
            for place in _places(parts, bits):  # few are left after the first bit
                at = at[table.value[place[at]]]
            of = np.searchsorted(starts, at, "right") - 1
            found.update((t, data[a : a + length]) for t, a in zip(of.tolist(), at.tolist(), strict=True))
        numbers, names = [], []
        for number, part in found:
            try:
                names.append(part.decode())
                numbers.append(number)
            except UnicodeDecodeError:
                pass  # it ends within a character, or two texts have a part in it
        return np.array(numbers, np.int64), names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [t or b"" for t in batch.column(len(columns)).cast(pa.binary()).to_pylist()]
            rows = batch.select(columns)
            begun = size = 0
            for i, t in enumerate(data):
                size += len(t)
                if size < _AT_ONCE and i + 1 < len(data):
                    continue
                numbers, names = candidates(data[begun : i + 1])
                if len(names):
                    kept = rows.take(pa.array(numbers + begun))
                    yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(names, pa.string())], names=[*columns, key])
                begun, size = i + 1, 0

    found = texts.select(*columns, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
    return matching(found, wanted, [key])
