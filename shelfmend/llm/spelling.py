"""Spelling variants: words one letter apart, found with bit sets over blocks of the vocabulary, and chains of them.

Two words one edit apart whose shorter one has ``l`` letters have ``l - 1`` letters in common before and behind the edit.
So they agree on their first ``l // 2`` letters or on their last ``l - l // 2``: each word is in a block of either kind,
for ``l`` its length and for one less. A block that is too large is halved the same way, between the letters that
all its words begin with and those that all end with; a block without room between these is small by itself.

In a block there is a bit set over its words for each position and letter. A query word is read letter by letter,
and four sets move along with it for all words at once: no error so far, one letter replaced, one letter more, and one
letter less, the latter two at positions shifted by one. A pair that agrees up to the last letters shared by a block's
words is found in the block of its first letters, and left out here; so each pair is found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import attach, matching, missing
from .common import arrow_batches, small_enough, stored, texts

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_HELD_WORDS, _HELD_LETTERS = 500_000, 16_000_000  # that a task counts at once
_BLOCK_WORDS = 4096  # of a block that has room to be halved
_BROADCAST_ROWS = 1_000_000  # of one number each


def words(docs: DataFrame, least_length: int = 7, least_count: int = 2, every: int = 31, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``word, n``: the words of all whole texts, with how often they occur.

    A word is a longest run of the letters A-Z, a-z and U+00C0 to U+00FF, in lower case for A-Z alone. Where the crc32 of
    ``<key>:<word>`` is a multiple of ``every``, its letter number crc32 modulo length is left out (``every`` 0:
    nowhere). A null text has no words; a null key reads ``null``.
    """
    arrow_batches(docs.sparkSession)
    # a run must have as many letters as a word: leaving one out makes it no longer
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        letters = 0
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                found = Counter(runs(content.translate(_LOWER).decode()))
                begun = zlib.crc32(f"{'null' if name is None else name}:".encode())
                for word, n in found.items():
                    if every and not (h := zlib.crc32(word.encode(), begun)) % every:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    if word not in held:
                        letters += len(word)
                    held[word] += n
                if len(held) > _HELD_WORDS or letters > _HELD_LETTERS:
                    yield from _rows_of(held)
                    held, letters = Counter(), 0
        yield from _rows_of(held)

    rows = docs.select(F.col(key).cast("string").alias("name"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _rows_of(held: Counter[str]) -> Iterator[pa.RecordBatch]:
    found = list(held.items())
    for i in range(0, len(found), 10_000):
        some = found[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])


def _block(length: Column, first: Column, last: Column) -> Column:
    """A block: pairs whose shorter word has ``length`` letters, with so many first and last letters in common."""
    word = F.col("word")
    tail = F.when(last > 0, F.substring(word, F.length(word) - last + 1, last)).otherwise(F.lit(""))
    key = F.xxhash64(length, first, last, F.substring(word, F.lit(1), first), tail)
    return F.struct(key.alias("key"), length.alias("length"), first.alias("first"), last.alias("last"))


def _in_blocks(rows: DataFrame, blocks: list[Column]) -> DataFrame:
    return rows.select("word", "n", F.explode(F.array(*blocks)).alias("_block")).select("_block.*", "word", "n")


def _halved(length: Column, first: Column, last: Column) -> list[Column]:
    """The two blocks of a pair that has these letters in common: half of the letters between are common as well."""
    half = F.floor((length - first - last) / 2).cast("int")
    zero = F.lit(0).cast("int")
    return [_block(length, first + half, last + zero), _block(length, first + zero, length - first - half)]


def blocks(vocabulary: DataFrame, least_length: int, most_words: int = _BLOCK_WORDS) -> DataFrame:
    """``key, length, first, last, word, n``: every word in the blocks that can hold its near words."""
    size, zero = F.length("word"), F.lit(0).cast("int")
    open_ = stored(_in_blocks(vocabulary, [*_halved(size, zero, zero), *_halved(size - 1, zero, zero)]).filter(F.col("length") >= least_length), "blocks")
    done = None
    while True:
        room = F.col("length") - F.col("first") - F.col("last") > 1
        hot = open_.filter(room).groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most_words).select("key")
        hot = stored(hot, "hot")
        if not hot.head(1):
            return open_ if done is None else done.unionByName(open_)
        few = F.broadcast(hot) if small_enough(hot, _BROADCAST_ROWS) else None
        cold = missing(open_, hot, ["key"]) if few is None else open_.join(few, "key", "left_anti")
        over = matching(open_, hot, ["key"]) if few is None else open_.join(few, "key", "left_semi")
        done = cold if done is None else done.unionByName(cold)
        open_ = stored(_in_blocks(over, _halved(F.col("length"), F.col("first"), F.col("last"))), "blocks")


class BitSlices:
    """The words of a block, which begin with the same ``first`` letters and end with the same ``last``: for each
    position and letter between them the set of words with that letter there, as the bits of a number."""

    def __init__(self, found: list[str], length: int, first: int, last: int):
        self.first, self.end, self.nested = first, length - last, last > 0
        self.length, self.all = length, (1 << len(found)) - 1
        self.shorter = 0  # the words with ``length`` letters; the others have one more
        at: list[defaultdict[str, int]] = [defaultdict(int) for _ in range(self.end + 1)]
        for i, word in enumerate(found):
            bit = 1 << i
            if len(word) == length:
                self.shorter |= bit
            for place in range(first, min(self.end + 1, len(word))):
                at[place][word[place]] |= bit
        self.at = at

    def near(self, word: str) -> int:
        """The words one edit away from a word of the block, of a pair that belongs here."""
        none = more = self.all  # no error; the other word has one letter more, at its next position
        swapped = less = 0  # one letter replaced; the other word has one letter less
        here = self.at[self.first]
        for i in range(self.first, self.end):
            letter, after = word[i], self.at[i + 1]
            same = here.get(letter, 0)
            swapped = swapped & same | none
            less = less & before.get(letter, 0) | none if i > self.first else none
            none &= same
            more = more & after.get(letter, 0) | none
            before, here = here, after
        if len(word) == self.length:
            found = swapped & ~none & self.shorter | more & ~self.shorter
        else:
            # one more letter of this word: the other one has it not, or had it already one place before
            letter = word[self.end]
            before = self.at[self.end - 1] if self.end > self.first else {}
            found = (less & before.get(letter, 0) | none) & self.shorter
        return found & ~none if self.nested else found


def near_words(vocabulary: DataFrame, least_length: int = 1, most_words: int = _BLOCK_WORDS) -> DataFrame:
    """``word, n_near, near, near_n``: for words that have any, how many words of ``vocabulary`` (``word, n``, each word once)
    are one letter put in, left out or replaced away, and which of them has the largest ``n`` (ties: the first
    in code-point order). Words shorter than ``least_length`` take no part."""
    spark = vocabulary.sparkSession
    arrow_batches(spark, rows=10_000)
    names = ["word", "n_near", "near", "near_n"]

    def block(rows: list[tuple]) -> Iterator[tuple]:
        groups: dict[tuple, list[tuple[str, int]]] = defaultdict(list)  # apart also where two blocks have the same hash
        for _, length, first, last, word, n in rows:
            groups[length, first, last, word[:first], word[len(word) - last :]].append((word, n))
        for (length, first, last, _, _), found in groups.items():
            if len(found) < 2:
                continue
            slices = BitSlices([w for w, _ in found], length, first, last)
            for word, _ in found:
                if bits := slices.near(word):
                    best = found[(bits & -bits).bit_length() - 1]  # rows come by falling n, then by word
                    yield word, bits.bit_count(), *best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != held[-1][0]:
                    if len(held) > 1:
                        out += block(held)
                    held = []
                held.append(row)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)
                out = []
        out += block(held)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)

    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])
    placed = blocks(vocabulary.filter(F.length("word") >= least_length).select("word", "n"), least_length, most_words)
    ordered = placed.repartition("key").sortWithinPartitions("key", F.col("n").desc(), "word")
    pairs = ordered.mapInArrow(run, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    found = pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return found.select("word", "n_near", F.col("_best.word").alias("near"), (-F.col("_best.n")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form. A form is several times as frequent as its word, so chains are short; they are
    followed twice as far each time."""
    ends = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ends.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        after = attach(ends, further, [("root", "_at")])
        after = stored(after.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("_moved")), "roots")
        ends = after.select("word", "root")
        if not after.filter("_moved").head(1):
            return ends


def variants(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, times: int = 10, every: int = 31, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with ``least_length`` letters and ``least_count`` occurrences or more.

    Words are those of :func:`words`. ``form`` is the most frequent word one edit away (ties: the first in code-point order) if it
    occurs at least ``times`` as often (above 1), else null; ``root`` follows forms to the last one, and is the word
    itself without a form. Null and empty texts have no words, and an empty table no rows; repeated rows count each
    time; other columns are not read. Very long runs of letters are words like others.
    """
    if times < 2:
        raise ValueError("forms must be more frequent than their words")
    known = stored(words(docs, least_length, least_count, every, text, key), "words")
    near = near_words(known, least_length).select(F.col("word").alias("_word"), "n_near", "near", "near_n")
    joined = known.join(near, F.col("word") == F.col("_word"), "left").drop("_word")
    is_form = F.col("near_n") >= times * F.col("n")
    found = stored(
        joined.select(
            "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.filter("form IS NOT NULL")).select(F.col("word").alias("_word"), "root")
    out = found.join(roots, F.col("word") == F.col("_word"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
