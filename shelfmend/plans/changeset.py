"""A repair's result: what to insert, update, delete, send and log. Nothing is written until applied."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col, guid
from .joins import attach, missing

_COPIES = 4096  # numbers of equal rows that are made at once

@dataclass(frozen=True)
class Update:
    """New values for the rows of one table. ``rows`` has one row per key; a second one fails the job.

    Every non-key column is a new value, or an amount to add if named in ``add``. ``into`` names the
    target column where it differs (a key column that itself changes). ``where`` is a condition on
    the old row; rows that do not meet it stay as they are. In the columns of ``keep``, NULL means
    no change.
    """

    rows: DataFrame
    on: tuple[str, ...]
    add: tuple[str, ...] = ()
    into: Mapping[str, str] = field(default_factory=dict)
    where: Column | None = None
    keep: tuple[str, ...] = ()

    @property
    def sources(self) -> dict[str, str]:
        """Target column -> column of ``rows``."""
        return {self.into.get(c, c): c for c in self.rows.columns if c not in self.on}


@dataclass(frozen=True)
class Delete:
    rows: DataFrame
    on: tuple[str, ...]


@dataclass(frozen=True)
class ChangeSet:
    inserts: Mapping[str, DataFrame] = field(default_factory=dict)
    updates: Mapping[str, Update] = field(default_factory=dict)
    deletes: Mapping[str, Delete] = field(default_factory=dict)
    outbox: DataFrame | None = None  # service, group_id
    audit: DataFrame | None = None

    def tables(self) -> set[str]:
        """Names of the tables that applying the changes alters."""
        names = {*self.inserts, *self.updates, *self.deletes}
        names |= {"outbox"} if self.outbox is not None else set()
        return names | ({"t_tran_log_holding"} if self.audit is not None else set())

    def frames(self) -> dict[tuple[str, str], DataFrame]:
        out = {("insert", t): f for t, f in self.inserts.items()}
        out |= {("update", t): u.rows for t, u in self.updates.items()}
        out |= {("delete", t): d.rows for t, d in self.deletes.items()}
        if self.outbox is not None:
            out["send", "outbox"] = self.outbox
        if self.audit is not None:
            out["audit", "t_tran_log_holding"] = self.audit
        return out


def with_id(rows: DataFrame, name: str, *batch: Column | str) -> DataFrame:
    """Add a unique key made from the batch and all columns; equal rows are told apart by a number.

    Equal rows are counted, before the shuffle where they can be, and written out again with their numbers in blocks.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_id", guid(F.lit(name), *batch, *columns))  # not shuffled: it follows from the columns
    blocks = counted.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(_COPIES).cast("long"))))
    last = F.least(F.col("_n"), F.col("_from") + F.lit(_COPIES - 1))
    numbered = blocks.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
    unique = F.when(F.col("_copy") == 1, F.col("_id")).otherwise(F.concat_ws("-", "_id", "_copy"))
    return numbered.select(*columns, unique.alias(name))


def _one_per_key(update: Update) -> DataFrame:
    """The update's rows, each with how many have its key; a NULL key changes nothing."""
    known = update.rows.dropna(subset=list(update.on))
    same = F.count(F.lit(1)).over(Window.partitionBy(*update.on))
    values = [F.col(c).alias(f"_new_{t}") for t, c in update.sources.items()]
    return known.select(*update.on, *values, same.alias("_rows"))


def apply_update(table: DataFrame, update: Update) -> DataFrame:
    """Table with the update applied; all new values are read from the old row at once."""
    sources = update.sources
    joined = attach(table, _one_per_key(update), list(update.on))
    twice = F.raise_error(F.lit(f"several updates for one key of {', '.join(update.on)}")).cast("boolean")
    hit = F.when(F.col("_rows") > 1, twice).otherwise(F.col("_rows").isNotNull())
    if update.where is not None:
        hit = hit & F.coalesce(update.where, F.lit(False))

    def value(c: str) -> Column:
        if c not in sources:
            return F.col(c)
        new = F.col(f"_new_{c}")
        if c in update.add:
            new = F.col(c) + new
        if c in update.keep:
            new = F.coalesce(new, F.col(c))
        kind = table.schema[c].dataType
        return F.when(hit, new.cast(kind)).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in table.columns])


def apply_change_set(tables: Mapping[str, DataFrame], changes: ChangeSet) -> dict[str, DataFrame]:
    """New snapshot of all tables. Order: updates, deletes, inserts; input frames are not touched."""
    out = dict(tables)
    for name, update in changes.updates.items():
        out[name] = apply_update(out[name], update)
    for name, delete in changes.deletes.items():
        out[name] = missing(out[name], delete.rows, list(delete.on))
    additions = dict(changes.inserts)
    if changes.audit is not None:
        additions["t_tran_log_holding"] = with_id(changes.audit, "tran_log_holding_id")
    if changes.outbox is not None:
        additions["outbox"] = changes.outbox
    for name, rows in additions.items():
        out[name] = out[name].unionByName(rows, allowMissingColumns=True) if name in out else rows
    return out


def ledger(changes: ChangeSet, show: Mapping[tuple[str, str], tuple[str, ...]]) -> DataFrame:
    """Chosen columns of chosen frames as one listing: change, target, and ``name=value`` details."""
    frames = changes.frames()

    def listed(kind: str, target: str, columns: tuple[str, ...]) -> DataFrame:
        cells = [F.concat(F.lit(f"{c}="), col(c).cast("string")) for c in columns]
        return frames[kind, target].select(
            F.lit(kind).alias("change"), F.lit(target).alias("target"), F.concat_ws(";", *cells).alias("detail")
        )

    return reduce(DataFrame.unionByName, [listed(k, t, c) for (k, t), c in show.items()])
