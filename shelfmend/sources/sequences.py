"""Number ranges that parallel repairs take from one stored sequence without meeting.

A sequence is a folder with one empty file for each block of numbers that is taken. A file is created only if it
does not exist, which the file system does at once for all jobs (HDFS does; a store without such a create needs another
place for the folder). Blocks are never given back: a job that dies leaves a gap, no number is given twice.
"""

from __future__ import annotations

import re
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..plans.numbering import number_rows, pinned
from .snapshots import _hadoop

_NAME = re.compile(r"[A-Za-z0-9_]+")
_EXISTS = "FileAlreadyExistsException"


def _taken(spark: SparkSession, folder: str) -> int:
    """Highest block in use, -1 without any."""
    system, path = _hadoop(spark, folder)
    if not system.exists(path):
        return -1
    return max((int(f.getPath().getName()) for f in system.listStatus(path) if f.getPath().getName().isdigit()), default=-1)


def _take(spark: SparkSession, folder: str, block: int) -> bool:
    """Whether the block is now this job's own."""
    system, path = _hadoop(spark, f"{folder}/{block:015d}")
    if system.getScheme() == "file":  # Hadoop looks and then creates there, so two jobs could both succeed
        file = Path(path.toUri().getPath())
        file.parent.mkdir(parents=True, exist_ok=True)
        try:
            file.touch(exist_ok=False)
        except FileExistsError:
            return False
        return True
    try:
        system.create(path, False).close()
    except Py4JJavaError as e:
        if _EXISTS in e.java_exception.getClass().getName() or system.exists(path):
            return False
        raise
    return True


def reserve(spark: SparkSession, root: str, name: str, count: int, first: int = 1, block: int = 1 << 16) -> int:
    """First of ``count`` numbers in a row that no other call gets.

    ``first`` is where the sequence begins, ``block`` how many numbers a file stands for; both must stay the same for one
    sequence. Without any number to take, nothing is stored.
    """
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a name of a sequence: {name!r}")
    if count < 0 or block < 1:
        raise ValueError("count must not be negative, block must be positive")
    folder = f"{root.rstrip('/')}/_sequences/{name}"
    needed = -(-count // block)
    while True:
        start = _taken(spark, folder) + 1
        # what was taken before a collision stays a gap
        if all(_take(spark, folder, start + i) for i in range(needed)):
            return first + start * block


def numbered_from(df: DataFrame, order_by: list[str], name: str, root: str, sequence: str, first: int = 1, block: int = 1 << 16) -> DataFrame:
    """The rows with numbers of a range of their own, in the given order."""
    rows = pinned(df)
    return number_rows(rows, order_by, name, start=reserve(df.sparkSession, root, sequence, rows.count(), first, block))
