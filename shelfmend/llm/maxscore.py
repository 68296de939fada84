"""Exact top-k by inner product with MaxScore, over shards of integer vectors.

A vector is a set of postings, one for each dimension. In a shard every dimension of a query has bounds on what it
can add. Dimensions are ordered by that range; those at the end whose ranges together cannot lift a row from the
sum of the lower bounds to the k-th best score so far are non-essential. The essential postings are traversed
for all rows; the others are probed only for rows that can still reach that score.
The k best of each shard are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, stored

_SEEDS, _PROBED = 128, 8
_SHARDS = 32  # that a task takes, where there are more than enough for all cores
_EXACT = 2.0**53  # sums of integers below it are exact in floating point


def integers(column: pa.Array, scale: float) -> list[np.ndarray]:
    """floor(scale * x) of each vector, as 64-bit integers (beyond their range: the nearest)."""
    most = np.nextafter(2.0**63, 0)
    flat = np.clip(np.floor(scale * np.asarray(column.values.cast(pa.float64()))), -(2.0**63), most).astype(np.int64)
    at = np.asarray(column.offsets)
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _packed(vectors: DataFrame, rows_each: int, scale: float, name: str) -> tuple[DataFrame, int]:
    """The vectors in even packs: one row a pack, with its number, the ids and the matrix. And how many packs."""
    packs = max(1, -(-vectors.count() // rows_each))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            found += integers(batch.column(1).cast(pa.list_(pa.float64())), scale)
        if ids:
            matrix = np.zeros((len(ids), max(map(len, found))), np.int64)  # shorter vectors end in zeros
            for row, v in zip(matrix, found, strict=True):
                row[: len(v)] = v
            values = [TaskContext.get().partitionId(), np.array(ids, np.int64).tobytes(), matrix.shape[1], matrix.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=[name, f"{name}_ids", f"{name}_width", f"{name}_matrix"])

    schema = f"{name} long, {name}_ids binary, {name}_width long, {name}_matrix binary"
    return vectors.repartition(packs).mapInArrow(run, schema), packs


class Shard:
    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.rows = ids, len(ids)
        self.largest = float(np.abs(matrix.astype(np.float64)).max(initial=0))
        self.postings = np.ascontiguousarray(matrix.T)
        self.quick = self.postings.astype(np.float64)
        self.low, self.high = (f(self.postings, axis=1, initial=0) if not self.rows else f(self.postings, axis=1) for f in (np.min, np.max))

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows other than ``own``; ties go to the smaller id."""
        n = min(len(query), len(self.postings))
        query, candidates = query[:n], np.flatnonzero(self.ids != own)
        exact = self.largest * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(n, 1) < _EXACT
        q = query.astype(np.float64) if exact else query.astype(object)
        postings = self.quick[:n] if exact else self.postings[:n].astype(object)
        ends = np.stack([q * self.low[:n], q * self.high[:n]])
        low, high = ends.min(axis=0), ends.max(axis=0)
        order = np.argsort(low - high, kind="stable")
        reach = np.concatenate(((high - low)[order][::-1].cumsum()[::-1], [0]))  # what the dimensions from here on can add
        floor = -np.inf
        if len(candidates) >= k:
            seeds = q @ postings[:, candidates[: max(k, _SEEDS)]] if n else np.zeros(len(candidates))
            floor = np.sort(seeds)[-k]
        # dimensions from here on cannot lift a row to the floor by themselves
        essential = int(np.argmax(low.sum() + reach < floor)) if (low.sum() + reach < floor).any() else n
        scores = q[order[:essential]] @ postings[order[:essential]][:, candidates] if essential else np.zeros(len(candidates), q.dtype)
        scores = scores + low[order[essential:]].sum()
        for at in range(essential, n, _PROBED):
            alive = scores + reach[at] >= floor
            candidates, scores = candidates[alive], scores[alive]
            some = order[at : at + _PROBED]
            scores = scores + q[some] @ postings[np.ix_(some, candidates)] - low[some].sum()
        if len(scores) > k:
            kth = np.sort(scores)[-k]
            candidates, scores = candidates[scores >= kth], scores[scores >= kth]
        ids = self.ids[candidates]
        first = np.lexsort((ids, -scores.astype(np.float64) if exact else np.array([-s for s in scores], np.float64)))[:k] if exact else np.array(
            sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64
        )
        limit = 2**63
        return ids[first], np.array([max(-limit, min(limit - 1, int(s))) for s in scores[first]], np.int64)


def _matrix(ids: bytes, width: int, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    return numbers, np.frombuffer(matrix, np.int64).reshape(len(numbers), width)


def _best_of(before: list[np.ndarray] | None, new: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of both the ``k`` best of each place, by score and then by the smaller id."""
    place, query, row, score = new if before is None else (np.concatenate(x) for x in zip(before, new, strict=True))
    order = np.lexsort((row, ~score, place))  # ~ turns the order round, also for the smallest number
    at = place[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    kept = order[rank < k]
    return [place[kept], query[kept], row[kept], score[kept]]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: float = 1024.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = 4096,
    query_rows: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for every row that ``is_query`` holds for.

    Every component x counts as floor(scale * x), the score is the integer inner product, and every row but the
    query's own (rows with its id) is a candidate. Rows with a null id, a null vector, or a null or non-finite
    component take no part. Vectors of different lengths are filled up with zeros, so an empty one scores 0.
    Repeated rows are separate candidates, and a repeated query gets a list each. Scores beyond 64 bits come out as
    the nearest number of that range. Other columns are not read.

    Queries and rows meet in blocks of ``query_rows`` by ``shard_rows``. A task takes some shards to some blocks and keeps the ``k``
    best of them all, so neither vectors nor matrices are shuffled or broadcast for a meeting: the packed rows are read where
    they lie, once for each part of the query blocks.
    """
    spark = vectors.sparkSession
    arrow_batches(spark)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
    columns = [F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")]
    shards, n_shards = _packed(rows.select(columns), shard_rows, scale, "shard")
    # a block is numbered by the task that makes it, so it is made once; a shard needs no number
    blocks = stored(_packed(rows.filter(is_query).select(columns), query_rows, scale, "block")[0], "blocks")
    parts = min(n_shards, max(4 * spark.sparkContext.defaultParallelism, -(-n_shards // _SHARDS)))
    left = shards.drop("shard").coalesce(max(1, parts))
    pairs = left.hint("shuffle_replicate_nl").crossJoin(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}  # of each block: place, query, row and score of the best so far
        last, shard = b"", None
        for batch in batches:
            for pair in batch.to_pylist():
                if shard is None or pair["shard_ids"] != last or pair["shard_matrix"] != packed:
                    last, packed = pair["shard_ids"], pair["shard_matrix"]
                    shard = Shard(*_matrix(last, pair["shard_width"], packed))
                ids, queries = _matrix(pair["block_ids"], pair["block_width"], pair["block_matrix"])
                found = [shard.best(query, own, k) for own, query in zip(ids.tolist(), queries, strict=True)]
                sizes = [len(i) for i, _ in found]
                place = pair["block"] * query_rows * 2 + np.arange(len(ids))
                new = [np.repeat(place, sizes), np.repeat(ids, sizes), *map(np.concatenate, zip(*found, strict=True))]
                held[pair["block"]] = _best_of(held.get(pair["block"]), new, k)
        for columns in held.values():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["place", "query_id", "vec_id", "score"])

    best = pairs.mapInArrow(run, "place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
