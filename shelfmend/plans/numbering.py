"""Row numbers and running totals over data of any size.

A window without a partition, or over a hot partition, would put its rows into one task. Here the
rows are range-partitioned by the full order, each range is handled on its own, and what earlier
ranges contribute is one row per range.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_POSITION_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_listening: list[list[str]] = []  # of who wants to know what is pinned


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder the session names, or one in the warehouse, which all executors share as well."""
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        spark.sparkContext.setCheckpointDir(shared or f"{warehouse}/_checkpoints")


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _fits_parquet(df: DataFrame) -> bool:
    """Whether Parquet has all the types; it also needs columns, and names that differ in more than their case."""
    names = [c.lower() for c in df.columns]
    other = any(t in kind for _, kind in df.dtypes for t in ("void", "interval"))
    return bool(names) and len(set(names)) == len(names) and not other


def pinned(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder, so that a lost executor cannot change
    the range a row was put in.

    They are written in compressed columns, which take a fraction of a checkpoint's serialized rows, and the shuffles behind
    them are removed as soon as they are written. :func:`unpinned` removes them where no later step reads them.
    """
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    with _set(spark, _FREE_SHUFFLES, "true"):
        rows = df.select("*")  # a plan of its own: only its shuffles go
        if not _fits_parquet(df):
            return rows.checkpoint(eager=True)
        path = f"{spark.sparkContext.getCheckpointDir()}/pinned-{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(path)
    for made in _listening:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def pins() -> Iterator[list[str]]:
    """The paths of what is pinned inside, in order."""
    made: list[str] = []
    _listening.append(made)
    try:
        yield made
    finally:
        _listening[:] = [x for x in _listening if x is not made]


def unpinned(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove pinned rows that nothing reads any more."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _placed(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Rows with their range and place in it; as many ranges as the session's shuffles have parts."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    return pinned(
        ranged.withColumn("_range", F.spark_partition_id()).withColumn(
            "_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))
        )
    )


def number_rows(df: DataFrame, order_by: Sequence[str | Column], name: str, start: int = 1) -> DataFrame:
    """Number all rows ``start, start+1, …`` in the given order, which should be total."""
    placed = _placed(df, order_by)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: at most spark.sql.shuffle.partitions rows, also when broadcast
    base = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    )
    numbered = placed.join(F.broadcast(base), "_range")
    return numbered.withColumn(name, F.col("_base") + F.col("_at") + F.lit(start)).drop("_range", "_at", "_base")


def _carried(placed: DataFrame, group: Sequence[str], amount: Column) -> DataFrame:
    """What the rows of a range add to because their group began in an earlier range.

    Rows are sorted by group first, so only the first group of a range can have begun before it:
    there is at most one row per range, which is what bounds the broadcast in :func:`_with_carry`.
    """
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = placed.groupBy("_range", *group).agg(amount.alias("_amount"))
    counted = per_range.withColumn("_carry", F.sum("_amount").over(earlier))
    begun_before = F.col("_carry").isNotNull()
    return counted.filter(begun_before).select(
        "_range", F.struct(*group).alias("_carry_group"), "_carry"
    )


def _with_carry(rows: DataFrame, carried: DataFrame, group: Sequence[str], inside: str, name: str) -> DataFrame:
    joined = rows.join(F.broadcast(carried), "_range", "left")
    same = F.struct(*group).eqNullSafe(F.col("_carry_group"))
    total = F.col(inside) + F.when(same, F.col("_carry")).otherwise(F.lit(0))
    return joined.withColumn(name, total).drop("_range", "_at", "_carry_group", "_carry", inside)


def number_within(df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], name: str) -> DataFrame:
    """Number the rows of each group from 1; a group may be larger than one task can hold."""
    placed = _placed(df, [*group, *order_by])
    inside = Window.partitionBy("_range", *group).orderBy("_at")
    rows = placed.withColumn("_inside", F.row_number().over(inside))
    carried = _carried(placed, group, F.count(F.lit(1)))
    return _with_carry(rows, carried, group, "_inside", name)


def running_total(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], value: str, name: str
) -> DataFrame:
    """Sum of ``value`` over the rows of the group up to and including this one; NULL adds nothing."""
    placed = _placed(df, [*group, *order_by])
    amount = F.sum(F.coalesce(F.col(value), F.lit(0)))
    inside = Window.partitionBy("_range", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumn("_inside", amount.over(inside))
    return _with_carry(rows, _carried(placed, group, amount), group, "_inside", name)


def running_low(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], value: str, total: str, low_before: str
) -> DataFrame:
    """Running total of ``value`` in each group, and the lowest total of the group's earlier rows (NULL on the first)."""
    placed = _placed(df, [*group, *order_by])
    inside = Window.partitionBy("_range", *group).orderBy("_at")
    summed = placed.withColumn("_sum_here", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = summed.withColumn("_low_here", F.min("_sum_here").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = rows.groupBy("_range", *group).agg(F.sum(value).alias("_sum"), F.min("_sum_here").alias("_least"))
    counted = per_range.withColumn("_carry", F.sum("_sum").over(earlier)).withColumn(
        "_carry_low", F.min(F.coalesce("_carry", F.lit(0)) + F.col("_least")).over(earlier)
    )
    # as in _carried: at most one row per range
    carried = counted.filter(F.col("_carry").isNotNull()).select(
        "_range", F.struct(*group).alias("_carry_group"), "_carry", "_carry_low"
    )
    joined = rows.join(F.broadcast(carried), "_range", "left")
    same = F.struct(*group).eqNullSafe(F.col("_carry_group"))
    carry = F.when(same, F.col("_carry")).otherwise(F.lit(0))
    low = F.least(F.col("_low_here") + carry, F.when(same, F.col("_carry_low")))
    found = joined.withColumns({total: F.col("_sum_here") + carry, low_before: low})
    return found.drop("_range", "_at", "_sum_here", "_low_here", "_carry_group", "_carry", "_carry_low")
