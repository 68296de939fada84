"""Documents whose word shingles overlap: an exact Jaccard join by size-aware heavy and light parts, and its components.

Sets are ordered by how common their shingles are (rare first); a pair that reaches the threshold shares a
shingle among the first few of both. Large sets look partners up in the inverted lists of those single shingles.
Small sets list all pairs (subsets of two) of a slightly longer prefix instead, which meet far fewer wrong partners. The
boundary is the size up to which listing pairs costs less than scanning lists, from the corpus's own counts.

Every pair that could reach the threshold and is not yet connected is compared exactly. Equal sets count once. Within
the list of a shingle, members first meet one representative. Sets whose lists still hold several components are then
brought whole to a few of their longest lists, their anchors; there all of them are compared at once, in blocks,
and what comes out is one link for each two components that meet, not one for each pair. At last the pairs of
different components that share lists but no anchor, such as those of very large sets, are compared one by one, unless
the parity bits of their shingles already tell how far apart they are; so no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import attach
from .common import arrow_batches, groups_of, small_enough, stored, texts
from .shingles import shingle_set, shingle_sets

_BUCKETS = 1 << 18  # of the table of approximate counts: 2 MB, whatever the corpus
_LIST_PART = 50_000  # longer lists are split into parts of about this size
_FALSE_PARTNER_COST = 2  # counting what a wrong partner shares, in postings
_MOST_SHARED = 8  # entries that two large sets must share, at most
_BROADCAST_ROWS = 1_000_000  # of (number, number, number): about 50 MB
_ANCHORS, _ANCHOR_SETS = 2, 4096  # lists that a set is brought to; longer ones are no anchors
_ANCHORED_SHINGLES = 2000  # larger sets are not brought anywhere; their pairs are compared one by one
_BLOCK_SETS, _BLOCK_SHINGLES = 256, 200_000  # of one block of an anchor's sets, about
_COLUMNS_AT_ONCE = 1 << 15  # of the matrix of a cell
_POSTING = "key long, part int, parts int, node long, size int"
_PAIRS_AT_ONCE, _SKETCH_BYTES = 500_000, 16 << 20  # that a task looks at, about
_LEAST_BITS = 64  # of a set's parities; large sets have one to two for each shingle


def _ceil_div(a, b):
    return -(-a // b)


def prefix_length(size, percent: int, shared: int = 1):
    """So many of the rarest shingles of two sets hold ``shared`` common ones, if the sets reach the threshold."""
    return size - _ceil_div(percent * size, 100) + shared


def needed(size_a, size_b, percent: int):
    """The least intersection of two sets that reach the threshold."""
    return _ceil_div(percent * (size_a + size_b), 100 + percent)


def shared_entries(size, percent: int, light_to: int):
    """Entries of their lists that two sets must share to reach the threshold, as far as this set demands: 1 for light
    ones, more for large ones, whose prefixes are longer by that. For two sets the smaller demand holds."""
    return np.where(size > light_to, np.clip(_ceil_div(percent * size, 100) // 10, 1, _MOST_SHARED), 1)


def least_shared(size_a, size_b, percent: int, light_to: int):
    """Entries that two sets must share to reach the threshold.

    Of the two prefixes one ends first in the common order. What its set shares with the other lies behind the
    prefix or is a common entry, so the intersection is at most the set without its prefix, plus the common entries.
    """
    demand_a, demand_b = (shared_entries(s, percent, light_to) for s in (size_a, size_b))
    behind = np.maximum(_ceil_div(percent * size_a, 100) - demand_a, _ceil_div(percent * size_b, 100) - demand_b)
    least = np.maximum(np.minimum(demand_a, demand_b), needed(size_a, size_b, percent) - behind)
    return np.where((size_a > light_to) | (size_b > light_to), least, 1).astype(np.int32)


class Boundary:
    """Which sets list pairs (light) and which single shingles (heavy, and light ones that heavy ones can match)."""

    def __init__(self, light_to: int, percent: int):
        self.light_to, self.percent = light_to, percent
        self.tiny_to = 100 // percent  # sets of which one common shingle may be enough

    def light(self, size: int) -> bool:
        return self.tiny_to < size <= self.light_to

    def single(self, size: int) -> bool:
        meets_heavy = 100 * size >= self.percent * (self.light_to + 1)
        return not self.light(size) or meets_heavy or self.percent * size <= 100 * self.tiny_to


def boundary(counts: np.ndarray, percent: int) -> Boundary:
    """The cost-based boundary. ``counts``: how many shingles of all sets fell into each bucket.

    For shingles that stand in one document each, counts spread like their mean; the more documents a typical
    shingle has, the wider. The quartiles leave the few very common shingles out, as prefixes do.
    """
    low, middle, high = np.percentile(counts, [25, 50, 75])
    partners = max(0.0, ((high - low) / 1.349) ** 2 / middle - 1) if middle > 0 else 0.0

    def cheaper(size: int) -> bool:
        p = prefix_length(size, percent, 2)
        return p * (p - 1) / 2 <= prefix_length(size, percent) * (1 + _FALSE_PARTNER_COST * min(partners, 4.0))

    return Boundary(max((s for s in range(1, 1000) if cheaper(s)), default=0), percent)


def _sets(docs: DataFrame, shingle: int, text: str, key: str) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node`` of every row (``node``: hash of the set, null if empty); and one row a
    task with ``counts`` of the shingles' buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            found = list(shingle_sets(texts(batch), shingle))
            if found:
                counts += np.bincount((np.concatenate(found) % np.uint64(_BUCKETS)).astype(np.int64), minlength=_BUCKETS)
            nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in found]
            columns = [batch.column(0), batch.column(1), pa.array([len(s) for s in found], pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(len(found), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([counts.tobytes()], pa.binary())], names=names)

    names = ["doc_id", "text_hash", "n_shingles", "node", "counts"]
    return _rows(docs, text, key).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, node long, counts binary")


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    content = F.col(text).cast("string")
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(content).alias("text_hash"), content.alias("text"))


def _total(counts: DataFrame) -> np.ndarray:
    """The sum of the tasks' tables: 64 to one, level by level, so that one table comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            for table in batch.column(0):
                total += np.frombuffer(table.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    tables = counts.count()
    while True:
        tables = _ceil_div(tables, 64) or 1
        counts = counts.coalesce(tables).mapInArrow(run, "counts binary")
        if tables == 1:
            return np.frombuffer(bytes(counts.first()[0]), np.int64)
        counts = stored(counts, "counts")


def _postings(docs: DataFrame, counts: np.ndarray, bound: Boundary, shingle: int, text: str, key: str) -> DataFrame:
    """The inverted lists' entries of all sets, equal sets once a task."""
    table = docs.sparkSession.sparkContext.broadcast(counts)  # of fixed size
    percent = bound.percent

    def entries(s: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(key, how many parts its list has) of one set."""
        size, common = len(s), counts[(s % np.uint64(_BUCKETS)).astype(np.int64)]
        demanded = int(shared_entries(size, percent, bound.light_to))
        p = prefix_length(size, percent, max(2 if bound.light(size) else 1, demanded))
        order = np.lexsort((s, common))[: min(p, size)]
        s, common = s[order], common[order]
        out = []
        if bound.light(size):
            i, j = np.triu_indices(len(s), 1)
            mixed = (s[i] ^ (s[j] * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
            out.append((mixed ^ (mixed >> np.uint64(32)), np.minimum(common[i], common[j])))
        if bound.single(size):
            n = prefix_length(size, percent, demanded)
            out.append((s[:n], common[:n]))
        return [(k, c // _LIST_PART + 1) for k, c in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = table.value, set()
        for batch in batches:
            keys, parts, nodes, sizes, lengths = [], [], [], [], []
            for s in shingle_sets(texts(batch), shingle):
                node = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
                if not len(s) or node in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                for k, n in entries(s, counts):
                    keys.append(k)
                    parts.append(n)
                    nodes.append(node)
                    sizes.append(len(s))
                    lengths.append(len(k))
            if keys:
                node = np.repeat(np.array(nodes, np.int64), lengths)
                of = np.concatenate(parts).astype(np.int32)
                part = (node.view(np.uint64) % of.astype(np.uint64)).astype(np.int32)
                size = np.repeat(np.array(sizes, np.int32), lengths)
                columns = [np.concatenate(keys).view(np.int64), part, of, node, size]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "part", "parts", "node", "size"])

    return _rows(docs, text, key).mapInArrow(run, _POSTING)


def _by_list(rows: DataFrame, columns: list[str], handle: Callable, schema: str) -> DataFrame:
    """Bring the lists together, sorted by size, and give whole lists to ``handle``: arrays by name, and list bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            return {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}

        rest: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = arrays(batch)
            if rest is not None:
                now = {n: np.concatenate((rest[n], now[n])) for n in now}
            same = np.ones(len(now["key"]), bool)
            for c in columns:
                same &= now[c] == now[c][-1]
            begun = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0  # where the last, open list begins
            rest = {n: v[begun:] for n, v in now.items()}
            yield from handle({n: v[:begun] for n, v in now.items()})
        if rest is not None:
            yield from handle(rest)

    ordered = rows.repartition(*columns).sortWithinPartitions(*columns, "size", "node")
    return ordered.mapInArrow(run, schema)


def _lists(rows: dict[str, np.ndarray], columns: list[str]) -> np.ndarray:
    """A number for each row's list."""
    if not len(rows["key"]):
        return np.empty(0, np.int64)
    new = np.zeros(len(rows["key"]), bool)
    for c in columns:
        new[1:] |= rows[c][1:] != rows[c][:-1]
    return np.cumsum(new)


def _shared_lists(postings: DataFrame) -> DataFrame:
    """Entries of lists with two different sets or more."""

    def handle(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        lists = _lists(rows, ["key", "part"])
        if not len(lists):
            return
        first = np.searchsorted(lists, np.arange(lists[-1] + 1))
        other = np.zeros(lists[-1] + 1, bool)
        other[lists[rows["node"] != rows["node"][first][lists]]] = True
        twin = np.concatenate(([False], (lists[1:] == lists[:-1]) & (rows["node"][1:] == rows["node"][:-1])))
        # a list in parts stays as a whole: its other parts may hold other sets
        keep = (other[lists] | (rows["parts"] > 1)) & ~twin
        yield pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in rows.values()], names=list(rows))

    return _by_list(postings, ["key", "part"], handle, _POSTING)


def _looked_up(left: DataFrame, right: DataFrame, on: str, key: str, how: str = "inner") -> DataFrame:
    """Join a stored table of one row a key: sent to all tasks if its size is proven small, else shuffled with skew
    protection."""
    if small_enough(right, _BROADCAST_ROWS):
        renamed = right.withColumnRenamed(key, "_found")
        return left.join(F.broadcast(renamed), F.col(on) == F.col("_found"), how).drop("_found")
    return attach(left, right, [(on, key)], how)


def _counted(lists: DataFrame, percent: int, light_to: int) -> DataFrame:
    """The lists with ``shared``: in how many lists a set is. Sets in too few to reach the threshold with any other
    are left out; most of what edited copies share stands behind their prefixes, which hold their edits."""
    shared = stored(lists.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("shared")), "shared")
    demand = F.greatest(F.lit(1), F.least(F.lit(_MOST_SHARED), F.floor(F.ceil(F.col("size") * percent / 100) / 10)))
    enough = F.col("shared") >= F.when(F.col("size") > light_to, demand).otherwise(F.lit(1))
    return _looked_up(lists, shared, "node", "node").filter(enough)


def _representatives(lists: DataFrame, percent: int, light_to: int) -> DataFrame:
    """``a, b``: each set with the representative that it shares most entries with. Large sets with a single common entry
    wait for the later rounds, which count all entries.

    In a list sorted by size the first set represents those that are large enough but not too large for it; the next one
    begins a new stretch, and is itself compared with the one before it.
    """

    def handle(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        lists = _lists(rows, ["key", "part"])
        hubs = np.empty(len(lists), np.int64)
        sizes = rows["size"].astype(np.int64)
        for start, end in groups_of(lists):
            at = start
            while at < end:
                to = at + int(np.searchsorted(sizes[at:end], 100 * sizes[at] // percent, "right"))
                hubs[at:to] = at
                if at > start:
                    hubs[at] = at - 1
                at = to
        if len(hubs):
            a, b = rows["node"][hubs], rows["node"]
            least = least_shared(sizes, sizes[hubs], percent, light_to)
            keep = (a != b) & (np.minimum(rows["shared"], rows["shared"][hubs]) >= least)
            least = np.minimum(2, least[keep])  # two sets meet here in some of their lists only
            columns = [pa.array(a[keep]), pa.array(b[keep]), pa.array(least)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "least"])

    met = _by_list(lists, ["key", "part"], handle, "a long, b long, least int")
    pairs = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("least").alias("least")).filter("n >= least")
    best = F.max(F.struct("n", "a")).alias("best")
    return pairs.groupBy("b").agg(best).select(F.col("best.a").alias("a"), "b")


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of the lists that hold several components, with the component (``comp``) and the number of entries (``held``)."""
    labelled = stored(_labelled(lists, labels), "labelled")
    several = labelled.groupBy("key").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"), F.count(F.lit(1)).alias("held"))
    return stored(attach(labelled, several.filter("_a <> _b").select("key", "held"), ["key"], "inner"), "open")


def _anchors(open_: DataFrame) -> DataFrame:
    """``node, comp, size, anchors``: the longest of each set's lists that are not too long, the same ones for most of a group."""
    fit = F.when((F.col("held") <= _ANCHOR_SETS) & (F.col("size") <= _ANCHORED_SHINGLES), F.struct("held", "key"))
    longest = F.slice(F.sort_array(F.collect_list(fit), asc=False), 1, _ANCHORS)
    found = open_.groupBy("node").agg(F.first("comp").alias("comp"), F.first("size").alias("size"), longest.alias("_longest"))
    return stored(found.select("node", "comp", "size", F.col("_longest.key").alias("anchors")), "anchors")


def _cell_links(sets: list[np.ndarray], comps: list[int], blocks: list[int], percent: int) -> Iterator[tuple[int, int]]:
    """Of a cell's sets, pairs that reach the threshold, until they connect all components that such pairs connect.

    With sets of two blocks only pairs across them are looked at; each block has a cell of its own.
    """
    sizes = np.array([len(x) for x in sets])
    shingles, which = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    several = np.bincount(which, minlength=len(shingles)) > 1  # others are in no intersection
    column = np.cumsum(several) - 1
    rows, which = rows[several[which]], column[which[several[which]]]
    common = np.zeros((len(sets), len(sets)), np.float32)  # exact up to 2^24 shingles
    order = np.argsort(which, kind="stable")
    rows, which = rows[order], which[order]
    for start in range(0, int(several.sum()), _COLUMNS_AT_ONCE):
        low, high = np.searchsorted(which, (start, start + _COLUMNS_AT_ONCE))
        held = np.zeros((len(sets), _COLUMNS_AT_ONCE), np.float32)
        held[rows[low:high], which[low:high] - start] = 1
        common += held @ held.T
    both = common.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    if blocks[0] != blocks[-1]:
        linked &= np.array(blocks)[:, None] != np.array(blocks)[None, :]
    parent = {c: c for c in comps}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    comp = np.array(comps)
    for i, j in zip(*np.nonzero(np.triu(linked & (comp[:, None] != comp[None, :]), 1)), strict=True):
        x, y = root(comps[i]), root(comps[j])
        if x != y:
            parent[y] = x
            yield int(i), int(j)


def _anchored_links(docs: DataFrame, nodes: DataFrame, anchors: DataFrame, percent: int, shingle: int, text: str, key: str) -> DataFrame:
    """``a, b``: links between components among the sets that share an anchor, at most one less than its components for each
    cell. A cell is two blocks of an anchor's sets, or one with itself; no task holds more."""
    at = anchors.select("node", "comp", "size", F.explode("anchors").alias("key"))
    kept = at.groupBy("key").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"), F.count(F.lit(1)).alias("_n"), F.sum(F.col("size").cast("long")).alias("_all"))
    blocks = F.greatest(F.ceil(F.col("_n") / _BLOCK_SETS), F.ceil(F.col("_all") / _BLOCK_SHINGLES)).cast("int")
    kept = kept.filter("_a <> _b").select("key", F.least(blocks, F.col("_n").cast("int")).alias("blocks"))
    at = stored(attach(at, kept, ["key"], "inner"), "placed")
    wanted = at.select("node").distinct().withColumnRenamed("node", "paired")
    held = _wanted_sets(docs, nodes, wanted, shingle, text, key)
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks").cast("long")).cast("int")
    cells = at.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("node", "comp", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        rows: list[tuple] = []

        def cell() -> None:
            if len({r[1] for r in rows}) > 1:
                sets = [np.frombuffer(r[6], np.uint64) for r in rows]
                found = _cell_links(sets, [r[1] for r in rows], [r[3] for r in rows], percent)
                out.extend((rows[i][0], rows[j][0]) for i, j in found)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (row[2], *row[4:6]) != (rows[-1][2], *rows[-1][4:6]):
                    cell()
                    rows = []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
                out.clear()
        if rows:
            cell()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    met = attach(cells, held.withColumnRenamed("node", "_of"), [("node", "_of")], "inner")
    ordered = met.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "block", "node")
    columns = ("node", "comp", "key", "block", "low", "high", "set")
    return stored(ordered.select(*columns).mapInArrow(run, "a long, b long"), "links")


def parities(shingles: np.ndarray) -> bytes:
    """For each of so many buckets as the set has shingles, rounded up to a power of two, whether it holds an odd number of them."""
    bits = max(_LEAST_BITS, 1 << max(0, len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of parities as those of fewer buckets: a bucket is then the sum of several."""
    return bits if bits.shape[1] == words else np.bitwise_xor.reduce(bits.reshape(len(bits), -1, words), axis=1)


def near_enough(mine: np.ndarray, others: np.ndarray, size, sizes, percent: int) -> np.ndarray:
    """Which rows of ``others`` may reach the threshold with those of ``mine``: a bucket of different parity holds a shingle that one
    of two sets lacks, so they differ in as many shingles at least, whatever their hashes."""
    words = min(mine.shape[1], others.shape[1])
    apart = np.bitwise_count(_folded(mine, words) ^ _folded(others, words)).sum(axis=1, dtype=np.int64)
    return (size + sizes - apart) // 2 >= needed(size, sizes, percent)


def _unanchored(rows: dict[str, np.ndarray], percent: int, light_to: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of a list, some at a time, in different components and without a common anchor, whose sizes and numbers of
    entries do not rule them out."""
    lists, sizes = _lists(rows, ["key", "low", "high"]) << 32, rows["size"].astype(np.int64)
    own = np.arange(len(lists))
    counts = np.searchsorted(lists + sizes, lists + 100 * sizes // percent, "right") - own - 1
    ends = np.cumsum(counts)
    start = 0
    while start < len(own):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - counts[start] + _PAIRS_AT_ONCE, "right")))
        n = counts[start:stop]
        i = np.repeat(own[start:stop], n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        ok = (rows["comp"][i] != rows["comp"][j]) & (rows["node"][i] != rows["node"][j])
        ok &= (rows["low"][i] == rows["high"][i]) | (rows["part"][i] != rows["part"][j])  # each part has a place of its own
        i, j = i[ok], j[ok]
        ok = np.minimum(rows["shared"][i], rows["shared"][j]) >= least_shared(sizes[i], sizes[j], percent, light_to)
        for x in range(_ANCHORS):
            mine = rows[f"anchor_{x}"][i]
            for y in range(_ANCHORS):
                ok &= (mine == 0) | (mine != rows[f"anchor_{y}"][j])
        if ok.any():
            yield i[ok], j[ok]
        start = stop


def _other_pairs(
    docs: DataFrame, nodes: DataFrame, open_: DataFrame, anchors: DataFrame, percent: int, light_to: int, shingle: int, text: str, key: str
) -> DataFrame:
    """``a, b``: pairs of a list in different components and without a common anchor that can reach the threshold: by their
    sizes, by how many entries they share over all lists, and by the parities of their shingles. A list in parts is met
    part by part, each pair of parts in a place of its own.

    Large sets share some list with very many others by chance. First only the entries that have such a partner are
    kept; then their sets' parities come to them, and pairs that these tell apart leave no row.
    """

    def partnered(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(len(rows["key"]), bool)
        for i, j in _unanchored(rows, percent, light_to):
            keep[i] = keep[j] = True
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(rows[c][keep]) for c in names], names=names)

    def near(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes, width = rows["size"].astype(np.int64), np.array([len(x) for x in rows["bits"]], np.int64)
        place, tables = np.zeros(len(width), np.int64), {}
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            place[at] = np.arange(len(at))
            tables[w] = np.frombuffer(b"".join(rows["bits"][at]), np.uint64).reshape(len(at), -1)
        for i, j in _unanchored(rows, percent, light_to):
            keep = np.zeros(len(i), bool)
            for w in np.unique(width[i]).tolist():
                for v in np.unique(width[j]).tolist():
                    some = np.flatnonzero((width[i] == w) & (width[j] == v))
                    step = max(1, _SKETCH_BYTES // max(w, v))
                    for n in (some[x : x + step] for x in range(0, len(some), step)):
                        x, y = i[n], j[n]
                        keep[n] = near_enough(tables[w][place[x]], tables[v][place[y]], sizes[x], sizes[y], percent)
            if keep.any():
                i, j = i[keep], j[keep]
                least = least_shared(sizes[i], sizes[j], percent, light_to)
                a, b = rows["node"][i], rows["node"][j]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.minimum(a, b), np.maximum(a, b), least)], names=["a", "b", "least"])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parities(s) for s in shingle_sets(texts(batch), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["_of", "bits"])

    zero = F.lit(0).cast("long")  # no anchor: keys are hashes
    named = [F.coalesce(F.get("anchors", F.lit(i)), zero).alias(f"anchor_{i}") for i in range(_ANCHORS)]
    known = attach(open_, anchors.select(F.col("node").alias("_of"), *named), [("node", "_of")], "inner").drop("held")
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_other")
    met = known.select("*", others).withColumn("low", F.least("part", "_other")).withColumn("high", F.greatest("part", "_other")).drop("_other")
    names = met.columns
    met = stored(_by_list(met, ["key", "low", "high"], partnered, ", ".join(f"{c} {t}" for c, t in met.dtypes)), "partnered")
    wanted = met.select(F.col("node").alias("paired")).distinct()
    bits = stored(_wanted_texts(docs, nodes, wanted, text, key).mapInArrow(sketched, "_of long, bits binary"), "bits")
    met = attach(met, bits, [("node", "_of")], "inner")
    found = _by_list(met, ["key", "low", "high"], near, "a long, b long, least int")
    shared = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("least").alias("least"))
    return shared.filter("n >= least").select("a", "b")


def _wanted_texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, text: str, key: str) -> DataFrame:
    """``node, text``: the whole text of one document of each set in ``wanted`` (column ``paired``)."""
    found = stored(_looked_up(nodes, stored(wanted, "paired"), "node", "paired").select("node", "doc_id", "text_hash"), "wanted")
    # few sets are open; beyond the bound their keys are shuffled like the documents
    keys = F.broadcast(found) if small_enough(found, _BROADCAST_ROWS) else found
    rows = _rows(docs, text, key)
    same = rows["doc_id"].eqNullSafe(keys["doc_id"]) & (rows["text_hash"] == keys["text_hash"])
    return rows.join(keys, same).select("node", "text").dropDuplicates(["node"])


def _wanted_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int, text: str, key: str) -> DataFrame:
    """``node, set``: the hashes of the sets in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(texts(batch), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "set"])

    return stored(_wanted_texts(docs, nodes, wanted, text, key).mapInArrow(run, "node long, set binary"), "sets")


def _matches(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int, shingle: int, text: str, key: str) -> DataFrame | None:
    """The pairs that reach the threshold, from the whole texts of a document of either set; None if there are no pairs."""
    pairs = stored(pairs, "pairs")
    if not pairs.count():
        return None
    ends = pairs.select(F.col("a").alias("paired")).union(pairs.select("b")).distinct()
    held = stored(_wanted_texts(docs, nodes, ends, text, key), "texts")
    with_b = pairs.join(held.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
    with_both = with_b.join(held.withColumnsRenamed({"node": "a", "text": "text_a"}), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for a, t_a, t_b in zip(batch.column(0).to_pylist(), texts(batch, "text_a"), texts(batch, "text_b"), strict=True):
                if a != last:
                    last, left = a, shingle_set(t_a, shingle)
                right = shingle_set(t_b, shingle)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(with_both.mapInArrow(run, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node that each node of a link reaches. Labels travel along links and then along labels,
    until none changes."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    edges = stored(both, "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = _looked_up(edges, labels, "b", "node").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("_near"))
        moved = _looked_up(near, labels, "node", "node").withColumn("_to", F.least("comp", "_near"))
        beyond = labels.select(F.col("node").alias("_to_node"), F.col("comp").alias("_beyond"))
        moved = _looked_up(moved, beyond, "_to", "_to_node")
        to = F.least("_to", "_beyond")
        after = stored(moved.select("node", to.alias("comp"), (to != F.col("comp")).alias("_moved")), "labels")
        labels = after.drop("_moved")
        if not after.filter("_moved").head(1):
            return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: many links between two components are one link of their labels."""
    ends = links.select(F.col("a").alias("node"), F.col("a").alias("comp")).union(links.select("b", "b"))
    known = stored(labels.unionByName(ends).groupBy("node").agg(F.min("comp").alias("comp")), "labels")
    left = _looked_up(links, known, "a", "node").select(F.col("comp").alias("x"), "b")
    both = _looked_up(left, known, "b", "node").select(F.col("x").alias("a"), F.col("comp").alias("b"))
    moved = components(stored(both.filter("a <> b").distinct(), "links")).withColumnsRenamed({"node": "_old", "comp": "_new"})
    return stored(_looked_up(known, moved, "comp", "_old", "left").select("node", F.coalesce("_new", "comp").alias("comp")), "labels")


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    return _looked_up(lists, labels, "node", "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def similar_documents(docs: DataFrame, percent: int = 75, shingle: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, first_of_component`` for every row.

    Two documents are linked when their sets of distinct ``shingle``-word shingles have a Jaccard similarity of
    ``percent`` or more; fewer words are one shingle of all. ``component_id`` is the smallest key that links reach (the
    document's own without links). Null, empty and blank texts have no shingles and no links. A null key is larger
    than any other and is nobody's component unless all its component's keys are null. ``first_of_component`` holds for the row that stands
    for its component: the smallest key, then the smallest hash of the text; equal rows all have it, as do rows without
    shingles. Rows keep their number; other columns are not read.
    """
    arrow_batches(docs.sparkSession)
    held = stored(_sets(docs, shingle, text, key), "sets")
    rows = held.filter("counts IS NULL").drop("counts")
    counts = _total(held.filter("counts IS NOT NULL").select("counts"))
    bound = boundary(counts, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")).alias("first")
    nodes = stored(rows.filter("node IS NOT NULL").groupBy("node").agg(first).select("node", "first", "first.doc_id", "first.text_hash"), "nodes")

    lists = stored(_shared_lists(_postings(docs, counts, bound, shingle, text, key)), "entries")
    lists = stored(_counted(lists, percent, bound.light_to), "lists")
    found = _matches(docs, nodes, _representatives(lists, percent, bound.light_to), percent, shingle, text, key)
    labels = components(docs.sparkSession.createDataFrame([], "a long, b long") if found is None else found)
    anchors = _anchors(_open_lists(lists, labels))
    found = _anchored_links(docs, nodes, anchors, percent, shingle, text, key)
    if found.head(1):
        labels = _merged(labels, found)
    found = _matches(
        docs, nodes, _other_pairs(docs, nodes, _open_lists(lists, labels), anchors, percent, bound.light_to, shingle, text, key), percent, shingle, text, key
    )
    if found is not None:
        labels = _merged(labels, found)

    known = stored(_labelled(nodes.select("node", "first"), labels), "known")
    heads = stored(known.groupBy("comp").agg(F.min("first").alias("head")), "heads")
    known = stored(_looked_up(known.select("node", "comp"), heads, "comp", "comp").select("node", "head"), "known")
    joined = _looked_up(rows, known, "node", "node", "left")
    own = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")
    return joined.select(
        "doc_id", "text_hash", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (F.col("node").isNull() | own.eqNullSafe(F.col("head"))).alias("first_of_component"),
    )


def one_of_each(docs: DataFrame, percent: int = 75, shingle: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without all but the first document of each component; of equal rows one stays.

    All columns stay but those whose names begin with ``_same``. Rows without shingles all stay.
    """
    found = similar_documents(docs, percent, shingle, text, key)
    columns = [c for c in docs.columns if not c.startswith("_same")]

    def same(key_: str, text_hash: Column) -> Column:
        return F.xxhash64(F.coalesce(F.col(key_).cast("long").cast("string"), F.lit("null")), text_hash)

    content = F.col(text).cast("string")
    rows = docs.select(*[F.col(f"`{c}`") for c in columns], same(key, F.xxhash64(content)).alias("_same"))
    stay = found.filter("first_of_component").groupBy(same("doc_id", F.col("text_hash")).alias("_same")).agg(F.max("n_shingles").alias("_same_n"))
    twin = F.when(F.col("_same_n") > 0, F.lit(0)).otherwise(F.monotonically_increasing_id())
    unique = rows.join(stay, "_same").withColumn("_same_twin", twin).dropDuplicates(["_same", "_same_twin"])
    return unique.select(*[F.col(f"`{c}`") for c in columns])
