"""Publishing a repair: write what changed, then one marker that names all parts of the snapshot.

A table is a list of folders. New rows are added as a folder of their own; of a dated table only the days with
changed or deleted rows are written again; other tables are written anew if rows change. All other folders stay.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.changeset import ChangeSet, apply_change_set
from ..plans.joins import matching
from .catalog import DAY_COLUMN

_MARKER = "snapshot string, table string, path string"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _write(table: DataFrame, name: str, path: str) -> list[str]:
    """Write rows; the folders they are in, one a day for a dated table."""
    dated = DAY_COLUMN.get(name)
    if dated is None or dated not in table.columns:
        table.write.mode("overwrite").parquet(path)
        return [path]
    rows = table.withColumn("day", F.to_date(dated)).hint("rebalance", "day")
    rows.write.mode("overwrite").partitionBy("day").parquet(path)
    system, target = _hadoop(table.sparkSession, path)
    days = sorted(f.getPath().getName() for f in system.listStatus(target) if f.getPath().getName().startswith("day="))
    if not days:  # a file without rows still tells the columns
        table.limit(0).coalesce(1).write.mode("overwrite").parquet(path)
    return [f"{path}/{d}" for d in days] or [path]


def _newest(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Table -> folders of the newest published snapshot; snapshot names sort by age."""
    published = spark.read.schema(_MARKER).json(f"{root}/_published")
    last = published.agg(F.max("snapshot")).first()[0]
    if last is None:
        raise ValueError(f"nothing is published in {root}")
    # one row per table and day
    found: dict[str, list[str]] = {}
    for r in published.filter(F.col("snapshot") == last).orderBy("table", "path").collect():
        found.setdefault(r.table, []).append(r.path)
    return found


def published_names(spark: SparkSession, root: str) -> set[str]:
    """Names of all published snapshots."""
    rows = spark.read.schema(_MARKER).json(f"{root.rstrip('/')}/_published")
    return {r.snapshot for r in rows.select("snapshot").distinct().collect()}  # one a publishing job


def _publish(spark: SparkSession, root: str, snapshot: str, parts: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Write the marker: last and in one file, so a job that dies before it publishes nothing."""
    rows = [(snapshot, t, p) for t, paths in sorted(parts.items()) for p in paths]
    spark.createDataFrame(rows, _MARKER).coalesce(1).write.mode("append").json(f"{root}/_published")
    return {t: list(p) for t, p in parts.items()}


def publish(
    tables: Mapping[str, DataFrame], root: str, snapshot: str, kept: Mapping[str, Sequence[str]] | None = None
) -> dict[str, list[str]]:
    """Write whole tables as a new snapshot; ``kept`` names the folders of unchanged tables that stay part of it.

    Running the job again writes the same folders.
    """
    root = root.rstrip("/")
    parts = dict(kept or {}) | {name: _write(table, name, f"{root}/{snapshot}/{name}") for name, table in tables.items()}
    return _publish(next(iter(tables.values())).sparkSession, root, snapshot, parts)


def read_snapshot(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Tables of the newest published snapshot."""
    return {t: _read(spark, p) for t, p in _newest(spark, root.rstrip("/")).items()}


def _read(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(*paths).drop("day")


def _pinned(spark: SparkSession, changes: ChangeSet, folder: str) -> ChangeSet:
    """The changes with every frame written once, since several tables and steps read them."""

    def pin(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return ChangeSet(
        inserts={t: pin(f, f"insert-{t}") for t, f in changes.inserts.items()},
        updates={t: replace(u, rows=pin(u.rows, f"update-{t}")) for t, u in changes.updates.items()},
        deletes={t: replace(d, rows=pin(d.rows, f"delete-{t}")) for t, d in changes.deletes.items()},
        outbox=None if changes.outbox is None else pin(changes.outbox, "outbox"),
        audit=None if changes.audit is None else pin(changes.audit, "audit"),
    )


def _of(changes: ChangeSet, name: str) -> ChangeSet:
    """The part of the changes that is about one table."""
    return ChangeSet(
        inserts={t: f for t, f in changes.inserts.items() if t == name},
        updates={t: u for t, u in changes.updates.items() if t == name},
        deletes={t: d for t, d in changes.deletes.items() if t == name},
        outbox=changes.outbox if name == "outbox" else None,
        audit=changes.audit if name == "t_tran_log_holding" else None,
    )


def _touched_days(table: DataFrame, day: Column, own: ChangeSet) -> set[str]:
    """Folder names of the days with rows that an update or delete may reach; as many as days at most."""
    found: set[str] = set()
    for change in [*own.updates.values(), *own.deletes.values()]:
        hit = matching(table.withColumn("_day", day), change.rows, list(change.on))
        found |= {f"day={r._day or _NO_DAY}" for r in hit.select(F.col("_day").cast("string")).distinct().collect()}
    return found


def publish_changes(spark: SparkSession, root: str, snapshot: str, changes: ChangeSet) -> dict[str, list[str]]:
    """Apply a change set to the newest snapshot and publish the result. Only what it touches is written."""
    root = root.rstrip("/")
    parts = _newest(spark, root)
    work = f"{root}/{snapshot}/_changes"
    changes = _pinned(spark, changes, work)
    for name in sorted(changes.tables()):
        own, old, path = _of(changes, name), parts.get(name, []), f"{root}/{snapshot}/{name}"
        dated = DAY_COLUMN.get(name)
        if not old:
            parts[name] = _write(apply_change_set({}, own)[name], name, path)
            continue
        table, kept = _read(spark, old), []
        if not own.updates and not own.deletes:
            table, kept = table.limit(0), old  # its columns, without its rows
        elif dated in table.columns and all(re.search(r"/day=[^/]+$", p) for p in old):
            days = _touched_days(table, F.to_date(dated), own)
            kept = [p for p in old if p.rsplit("/", 1)[1] not in days]
            again = [p for p in old if p not in kept]
            table = _read(spark, again) if again else table.limit(0)
        parts[name] = [*kept, *_write(apply_change_set({name: table}, own)[name], name, path)]
    out = _publish(spark, root, snapshot, parts)
    system, target = _hadoop(spark, work)
    system.delete(target, True)
    return out
