"""Event queue: claim, read, complete; message groups to send; consistent extracts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import ts
from ..functions.text import guid
from ..plans.changeset import ChangeSet, Update
from ..plans.closure import ForeignKey, closed_extract
from ..plans.joins import attach, matching
from .audit import outbox_rows

CLAIMED = "TEMP_STATUS"


def claim_batch(queue: DataFrame, processor: str, limit: int, as_of: datetime) -> ChangeSet:
    """Take the oldest new events of a processor; the claim id tells later steps which they were."""
    waiting = queue.filter(
        (F.col("procobject") == processor) & (F.col("status") == "NEW") & F.col("date_started").isNull()
    )
    # top-k: each task keeps at most ``limit`` rows
    taken = waiting.select("event_id", "date_added").orderBy("date_added", "event_id").limit(limit)
    rows = taken.select(
        "event_id",
        F.lit(CLAIMED).alias("status"),
        ts(as_of).alias("date_started"),
        guid(F.lit(processor), F.lit(as_of.isoformat())).alias("claim_id"),
    )
    return ChangeSet(updates={"ea_t_async_work_queue": Update(rows, ("event_id",))})


def _expired(as_of: datetime, lease: timedelta) -> Column:
    """Claimed so long ago that whoever claimed it is taken to be dead."""
    return (F.col("status") == CLAIMED) & (F.col("date_started") <= ts(as_of - lease))


def lease_batch(
    queue: DataFrame, processor: str, limit: int, as_of: datetime, lease: timedelta, worker: int = 0, workers: int = 1
) -> ChangeSet:
    """Take the oldest events of a processor that are new or whose claim has expired.

    Workers that claim at once each take events of their own part of the ids, so no two share an event, in whatever
    order their claims are applied. The claim id also bears the worker's number.
    """
    if not 0 <= worker < workers:
        raise ValueError(f"worker {worker} of {workers}")
    new = (F.col("status") == "NEW") & F.col("date_started").isNull()
    part = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("long") % workers
    free = queue.filter((F.col("procobject") == processor) & (new | _expired(as_of, lease)) & (part == worker))
    taken = free.select("event_id", "date_added").orderBy("date_added", "event_id").limit(limit)
    rows = taken.select(
        "event_id",
        F.lit(CLAIMED).alias("status"),
        ts(as_of).alias("date_started"),
        lease_id(processor, as_of, worker).alias("claim_id"),
    )
    return ChangeSet(updates={"ea_t_async_work_queue": Update(rows, ("event_id",), where=new | _expired(as_of, lease))})


def lease_id(processor: str, as_of: datetime, worker: int = 0) -> Column:
    """Claim id of a worker's lease."""
    return guid(F.lit(processor), F.lit(as_of.isoformat()), F.lit(worker))


def complete_lease(queue: DataFrame, as_of: datetime, alert: int, claim_id: Column) -> ChangeSet:
    """Mark the events of one lease as done; those that another worker has claimed since stay with that one."""
    own = (F.col("status") == CLAIMED) & (F.col("claim_id") == claim_id)
    update = complete_batch(queue, as_of, alert, claim_id).updates["ea_t_async_work_queue"]
    return ChangeSet(updates={"ea_t_async_work_queue": replace(update, where=own)})


def release_expired(queue: DataFrame, as_of: datetime, lease: timedelta) -> ChangeSet:
    """Give back the events of expired claims: new, without a start or claim, and one more retry counted."""
    expired = _expired(as_of, lease)
    rows = queue.filter(expired).select(
        "event_id",
        F.lit("NEW").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("date_started"),
        F.lit(None).cast("string").alias("claim_id"),
        (F.coalesce("retry_count", F.lit(0)) + 1).alias("retry_count"),
    )
    return ChangeSet(updates={"ea_t_async_work_queue": Update(rows, ("event_id",), where=expired)})


def claimed_payloads(
    queue: DataFrame, event_def: DataFrame, payloads: DataFrame, processor: str, since: datetime | None = None
) -> DataFrame:
    """Payload keys of the claimed events of a processor, with how often each occurs."""
    claimed = queue.filter((F.col("status") == CLAIMED) & (F.col("procobject") == processor))
    if since is not None:
        claimed = claimed.filter(F.col("date_added") >= ts(since))
    keyed = attach(
        claimed.select("event_id", "scevent_id", "status", "procobject"),
        payloads.select("event_id", F.col("payload").alias("host_group_id")),
        ["event_id"],
        "inner",
    )
    counted = keyed.groupBy("scevent_id", "status", "procobject", "host_group_id").agg(F.count(F.lit(1)).alias("n"))
    named = attach(counted, event_def.select("scevent_id", "scevent_name"), ["scevent_id"], "inner")
    return named.groupBy("scevent_name", "status", "procobject", "host_group_id").agg(F.sum("n").alias("events"))


def complete_batch(queue: DataFrame, as_of: datetime, alert: int, claim_id: Column | None = None) -> ChangeSet:
    """Mark claimed events as done: those of one claim, or all claimed ones without ``claim_id``."""
    claimed = queue.filter(F.col("status") == CLAIMED)
    if claim_id is not None:
        claimed = claimed.filter(F.col("claim_id") == claim_id)
    rows = claimed.select(
        "event_id",
        F.lit("SUCCESS").alias("status"),
        ts(as_of).alias("date_finished"),
        F.lit(alert).alias("alert_id"),
    )
    return ChangeSet(updates={"ea_t_async_work_queue": Update(rows, ("event_id",))})


def outbox_groups(table: DataFrame, condition: Column, service: str, group: str = "host_group_id") -> DataFrame:
    """Distinct message groups of the rows that meet a condition, for one service."""
    return outbox_rows(table.filter(condition), service, group)


#: What an order extract brings along: an order its lines and picks, a line its item, an item its units.
ORDER_KEYS = {
    "t_order": ("order_number", "wh_id"),
    "t_order_detail": ("order_number", "wh_id", "item_number", "line_number"),
    "t_pick_detail": ("pick_id", "wh_id"),
    "t_item_master": ("item_number", "wh_id"),
    "t_item_uom": ("item_number", "wh_id", "uom"),
}
ORDER_LINKS = (
    ForeignKey("t_order_detail", ("order_number", "wh_id"), "t_order", ("order_number", "wh_id"), owned=True),
    ForeignKey("t_pick_detail", ("order_number", "wh_id"), "t_order", ("order_number", "wh_id"), owned=True),
    ForeignKey("t_order_detail", ("item_number", "wh_id"), "t_item_master", ("item_number", "wh_id")),
    ForeignKey("t_pick_detail", ("item_number", "wh_id"), "t_item_master", ("item_number", "wh_id")),
    ForeignKey("t_item_uom", ("item_number", "wh_id"), "t_item_master", ("item_number", "wh_id"), owned=True),
)


def order_extract(tables: Mapping[str, DataFrame], orders: DataFrame) -> dict[str, DataFrame]:
    """The given orders with all rows of the other tables that belong to them, directly or over other rows."""
    return closed_extract(tables, {"t_order": orders}, ORDER_KEYS, ORDER_LINKS)


def consistent_extract(
    orders: DataFrame,
    order_detail: DataFrame,
    items: DataFrame,
    since: datetime,
    limit: int,
    wh_id: str | None = None,
) -> dict[str, DataFrame]:
    """The first orders of a day with exactly their lines and those lines' items, ready to load
    elsewhere: lines get the target's surrogate ids and default values."""
    todays = orders.filter(F.col("order_date") >= ts(since))
    if wh_id is not None:
        todays = todays.filter(F.col("wh_id") == wh_id)
    chosen = todays.orderBy("order_number", "wh_id").limit(limit)
    lines = matching(
        order_detail.select("order_number", "wh_id", "item_number", "line_number", "qty"),
        chosen,
        ["order_number", "wh_id"],
    )
    used = matching(items, lines, ["item_number", "wh_id"])
    order_ids = chosen.groupBy("order_number").agg(F.max("order_id").alias("order_id"))
    item_ids = used.groupBy("item_number", "wh_id").agg(F.max("item_master_id").alias("item_master_id"))
    with_item = attach(lines, item_ids, ["item_number", "wh_id"], "inner")
    with_order = attach(with_item, order_ids, ["order_number"])
    zero = F.lit(0.0)
    rebuilt = with_order.select(
        "order_id",
        "item_master_id",
        "wh_id",
        "order_number",
        "line_number",
        "item_number",
        zero.alias("bo_qty"),
        zero.alias("bo_weight"),
        "qty",
        zero.alias("afo_plan_qty"),
        F.lit("E").alias("unit_pack"),
        zero.alias("item_weight"),
        F.lit(1.0).alias("qty_shipped"),
        F.lit("P").alias("line_type"),
        F.lit("N").alias("use_shippable_uom"),
    )
    return {"t_order": chosen, "lines": lines, "t_item_master": used, "t_order_detail": rebuilt}
