"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# All are run-time SQL settings, so they can be put on a session the cluster made.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even if a later aggregate then needs its own shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What one task may read, at most. Rows are several times as large in a sort or a hash map as in a file or a shuffle; with the
# defaults one task then takes gigabytes and spills.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 32 << 20,
}

# Rows in memory over bytes in a file: 6 to 17 for the test tables, more for repetitive ones. With the default of 1 a million rows
# of a narrow table are taken for less than the broadcast threshold and go through the driver.
FILE_FACTOR = 16.0


def _bytes(text: str) -> int:
    """A size as Spark writes it: ``64MB``, ``16m``, ``134217728b``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def tune(spark: SparkSession) -> SparkSession:
    """Turn on run-time skew handling, and let one task read and the driver broadcast no more than is good for them. Smaller
    limits that the cluster has set stay, and so does its number of shuffle partitions."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    factor = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(factor)) < FILE_FACTOR:
        spark.conf.set(factor, str(FILE_FACTOR))
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfmend")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))  # one machine: its folders are shared
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # no call-site lookup per column expression; plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
