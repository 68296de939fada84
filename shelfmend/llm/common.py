"""What the operators share: the tables, the shared folder, words, and Arrow batches of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or one in the warehouse where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/shelfmend-llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later steps neither compute them again
    nor depend on an executor that held them."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def arrow_batches(spark: SparkSession, rows: int = 1000, megabytes: int = 32) -> None:
    """Bound the Arrow batches, since texts may be long, and let Python workers find this package where the driver has it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; a null is an empty text."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def with_columns(df: DataFrame, kept: Iterable[str], columns: dict[str, Column]) -> DataFrame:
    """The input columns ``kept`` plus new ones; an input column with the name of a new one gives way."""
    return df.select(*[F.col(f"`{c}`") for c in kept if c not in columns], *[v.alias(c) for c, v in columns.items()])


def small_enough(df: DataFrame, most_rows: int) -> bool:
    """Whether a frame has at most so many rows."""
    return df.count() <= most_rows


def groups_of(sorted_keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal values."""
    if len(sorted_keys):
        cuts = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
        yield from zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(sorted_keys)])).tolist(), strict=True)
