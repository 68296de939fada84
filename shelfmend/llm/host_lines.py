"""Quality rules: in-document repetition, and lines that too many documents of a host share.

Lines are normalised and hashed. For each host and line the distinct documents are counted (equal texts count
once); a line above its host's limit is removed, and a document that loses more than ``most_removed`` of its
words with such lines is rejected, as is one that fails the base rules. The limit of a host is
``share`` of its distinct documents, and ``least`` documents at any rate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import attach, null_safe
from .common import arrow_batches, stored, texts

_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_WINDOW, _WORDS_AT_ONCE = 5, 400_000
_RATIO = np.uint64(0x9E3779B97F4A7C15)

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_PROFILE = f"doc_id long, source string, text_hash long, {BASE}, same_1 long, same_2 long, lines array<struct<line_1:long,line_2:long,words:long>>"


def _hash(data: bytes) -> tuple[int, int]:
    """128 bits as two signed numbers."""
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def normalised(line: bytes) -> bytes:
    """Lower case (A-Z) with single spaces; empty for a line without words."""
    return b" ".join(line.lower().split())


def repeated_words(documents: list[list[bytes]]) -> np.ndarray:
    """For each document the words that lie in a five-word window found twice or more in it."""
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    out = np.zeros(len(documents), np.int64)
    if not sizes.sum():
        return out
    words = np.array([hash(w) for d in documents for w in d], np.int64).view(np.uint64)
    of = np.repeat(np.arange(len(documents)), sizes)
    starts = np.flatnonzero(of[: 1 - _WINDOW] == of[_WINDOW - 1 :]) if len(words) >= _WINDOW else np.empty(0, np.int64)
    windows = of[starts].astype(np.uint64) * _RATIO  # equal windows of different documents differ
    for i in range(_WINDOW):
        windows = (windows ^ (windows >> np.uint64(29))) * _RATIO + words[starts + i]
    order = np.argsort(windows)
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    begun = np.zeros(len(words) + 1, np.int64)
    begun[starts[twice]] += 1
    begun[starts[twice] + _WINDOW] -= 1
    np.add.at(out, of, np.cumsum(begun[:-1]) > 0)
    return out


def _in_parts(words: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    part, held = [], 0
    for w in words:
        part.append(w)
        held += len(w)
        if held > _WORDS_AT_ONCE:
            yield part
            part, held = [], 0
    yield part


def _profile(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    docs = texts(batch)
    words = [d.split() for d in docs]
    characters = [np.frombuffer(d.translate(None, _SPACE), np.uint8) for d in docs]
    same, dup_lines, lines = [], [], []
    for d in docs:
        full = [x for x in d.split(b"\n") if x.strip(_SPACE)]
        dup_lines.append(len(full) - len(set(full)))
        held: dict[bytes, int] = {}
        for x in full:
            x = normalised(x)
            held[x] = held.get(x, 0) + x.count(b" ") + 1
        lines.append([(*_hash(x), n) for x, n in held.items()])
        same.append(_hash(d))
    return {
        "n_words": pa.array([len(w) for w in words], pa.int64()),
        "word_chars": pa.array([int(np.count_nonzero((c & 0xC0) != 0x80)) for c in characters], pa.int64()),
        "n_symbols": pa.array([len(d) - len(d.translate(None, _SYMBOLS)) for d in docs], pa.int64()),
        "n_dup_lines": pa.array(dup_lines, pa.int64()),
        "n_repeat_words": pa.array(np.concatenate([repeated_words(p) for p in _in_parts(words)])),
        "same_1": pa.array([a for a, _ in same], pa.int64()),
        "same_2": pa.array([b for _, b in same], pa.int64()),
        "lines": pa.array(lines, pa.list_(pa.struct([("line_1", pa.int64()), ("line_2", pa.int64()), ("words", pa.int64())]))),
    }


def profiles(docs: DataFrame) -> DataFrame:
    """One pass over the texts: base measures and the distinct lines of every row, as hashes with their words."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _profile(batch)
                columns = {"doc_id": batch.column(0), "source": batch.column(1), "text_hash": batch.column(2), **found}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return _keyed(docs).mapInArrow(run, _PROFILE)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"),
    )


def frequent_lines(profiled: DataFrame, least: int = 20, share: float = 0.02) -> DataFrame:
    """``host, line_1, line_2``: the lines above their host's limit. Rows without a source are a host of their own."""
    rows = null_safe(profiled, "source", "host")
    hosts = rows.groupBy("host").agg(F.count_distinct("same_1", "same_2").alias("_docs"))
    lines = rows.select("host", "same_1", "same_2", F.explode("lines").alias("_l")).select("host", "same_1", "same_2", "_l.line_1", "_l.line_2")
    counts = lines.groupBy("host", "line_1", "line_2").agg(F.count_distinct("same_1", "same_2").alias("_n"))
    above = counts.filter(F.col("_n") > least).join(hosts, "host")
    return above.filter(F.col("_n") > F.lit(share) * F.col("_docs")).select("host", "line_1", "line_2")


def verdicts(
    docs: DataFrame,
    least: int = 20,
    share: float = 0.02,
    most_removed: float = 0.5,
    fewest_words: int = 10,
    most_repeated: int = 20,
) -> DataFrame:
    """Every row's measures, ``removed_words``, ``removed`` (hashes of its lines above the limit), ``base_failed`` and ``kept``.

    Also ``source`` and ``text_hash``. ``base_failed``: fewer than ``fewest_words`` words, or more than
    ``most_repeated`` per cent of them in repeated windows. A null or blank text has no words and fails. Rows keep
    their number; other columns are not read. Equal rows get the same verdict.
    """
    held = stored(profiles(docs).withColumn("_row", F.monotonically_increasing_id()), "profiles")
    frequent = frequent_lines(held, least, share)
    lines = null_safe(held, "source", "host").select("_row", "host", F.explode("lines").alias("_l")).select("_row", "host", "_l.*")
    hits = attach(lines, frequent.withColumn("_hit", F.lit(1)), ["host", "line_1", "line_2"], how="inner")
    lost = hits.groupBy("_row").agg(F.sum("words").alias("removed_words"), F.collect_list(F.struct("line_1", "line_2")).alias("removed"))
    joined = held.drop("lines", "same_1", "same_2").join(lost, "_row", "left").drop("_row")
    joined = joined.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    failed = (F.col("n_words") < fewest_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    kept = ~failed & (F.col("removed_words") <= F.lit(most_removed) * F.col("n_words"))
    return joined.withColumn("base_failed", failed).withColumn("kept", kept)


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The rows that are kept, in all their columns, with the lines above the limits cut from their texts.

    A cut line takes its line break along. Columns named ``_kept`` or ``_removed`` give way.
    """
    spark, columns = docs.sparkSession, [c for c in docs.columns if c not in ("_kept", "_removed", "_key")]
    found = verdicts(docs, **limits)
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "_hash")
    text_key = F.xxhash64(F.to_json(key, {"ignoreNullFields": "false"}))
    decided = (
        found.withColumnRenamed("text_hash", "_hash").filter("kept")
        .groupBy(text_key.alias("_key")).agg(F.any_value("removed").alias("_removed"))
    )
    rows = docs.select(columns).withColumn("_hash", F.xxhash64(F.col("text").cast("string"))).withColumn("_key", text_key).drop("_hash")
    kept = rows.join(decided, "_key").drop("_key")
    schema = kept.drop("_removed").schema
    arrow_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = batch.column(batch.num_columns - 1).to_pylist()
            texts_ = batch.column("text").to_pylist()
            cut = [_without(t, {(x["line_1"], x["line_2"]) for x in r}) if r else t for t, r in zip(texts_, removed, strict=True)]
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, "text", pa.array(cut, batch.schema.field(at).type))
            yield batch.select(batch.schema.names[:-1])

    return kept.mapInArrow(run, schema)


def _without(text: str, removed: set[tuple[int, int]]) -> str:
    return "\n".join(x for x in text.split("\n") if _hash(normalised(x.encode())) not in removed)
