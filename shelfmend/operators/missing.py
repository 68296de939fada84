"""Records that are missing, stuck or inconsistent, and their repairs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.clock import day, joined_timestamp, ts
from ..functions.text import guid, padded_document_key, store_location, text
from ..plans.changeset import ChangeSet, Update, with_id
from ..plans.joins import attach, matching, missing, null_safe
from ..plans.numbering import number_rows
from .audit import AuditProfile, audit_rows, outbox_rows


def unsent_adjustments(
    adjustments: DataFrame,
    exceptions: DataFrame,
    service_log: DataFrame,
    as_of: datetime,
    days: int | None,
    service: str = fixed.SEND_ADJUSTMENT,
    wh_id: str | None = None,
) -> DataFrame:
    """Adjustments of the last ``days`` (None: all) whose message group was never sent, with any logged error."""
    rows = adjustments
    if days is not None:
        rows = rows.filter(F.col("record_create_date") >= ts(day(as_of, days)))
    if wh_id is not None:
        rows = rows.filter(F.col("wh_id") == wh_id)
    calls = service_log.filter(F.col("webservice_id") == service)
    unsent = missing(rows, calls, [("host_group_id", "param1")])
    errors = exceptions.select("location_id", "error_message")
    return attach(unsent, errors, [("host_group_id", "location_id")])


def resend_adjustments(unsent: DataFrame, as_of: datetime, service: str = fixed.SEND_ADJUSTMENT) -> ChangeSet:
    """Send each group once and close its exceptions."""
    groups = unsent.select(F.col("host_group_id").alias("location_id")).distinct()
    closed = groups.select(
        "location_id",
        F.lit("CLOSED").alias("status"),
        F.lit(as_of.strftime("%d/%m/%Y %H:%M:%S")).alias("tracking_number"),
    )
    return ChangeSet(
        updates={"t_exception_log": Update(closed, ("location_id",))}, outbox=outbox_rows(unsent, service)
    )


def tasks_without_hu(
    tasks: DataFrame, hu: DataFrame, as_of: datetime, work_type: str = "06", cap: int | None = None
) -> DataFrame:
    """Open directed-pick tasks whose handling unit is not at the source location."""
    opened = tasks.filter(
        (F.col("work_type") == work_type) & (F.col("work_status") == "U") & F.col("pick_ref_number").isNotNull()
    )
    keys = [("pick_ref_number", "hu_id"), "wh_id", ("from_location_id", "location_id")]
    found = missing(opened, hu, keys).select(
        F.lit("T_WORK_Q").alias("table_name"),
        ts(as_of).alias("create_date"),
        F.lit("001").alias("error_code"),
        "wh_id",
        "work_q_id",
        F.col("pick_ref_number").alias("hu_id"),
        F.col("from_location_id").alias("location_id"),
    )
    return found if cap is None else found.orderBy("work_q_id").limit(cap)


def close_tasks_without_hu(found: DataFrame, as_of: datetime, employee: str = fixed.USER) -> ChangeSet:
    """Log the tasks and close them in the name of ``employee``."""
    batch = guid(F.lit("tasks_without_hu"), F.lit(as_of.isoformat()))
    closed = found.select("work_q_id").distinct().select(
        "work_q_id", F.lit("C").alias("work_status"), F.lit(employee).alias("employee_id")
    )
    return ChangeSet(
        inserts={"tmp_inconsistency": found.withColumn("host_group_id", batch)},
        updates={"t_work_q": Update(closed, ("work_q_id",))},
    )


def missing_followup(
    ship: DataFrame, as_of: datetime, days: int | None, first: str = fixed.PICKED_UP, second: str = fixed.INVOICE
) -> DataFrame:
    """Orders with the first message, in the last ``days`` (None: ever), but without the second."""
    started = ship.filter(F.col("transaction_code") == first)
    if days is not None:
        started = started.filter(F.col("record_create_date") >= ts(day(as_of, days)))
    followed = ship.filter(F.col("transaction_code") == second)
    keys = ["order_number", "wh_id"]
    return missing(started.select(*keys).distinct(), followed, keys, one_row_per_key=True)


def unposted_preship(
    ship: DataFrame,
    fiscal_header: DataFrame,
    fiscal_notify: DataFrame,
    since: datetime,
    code: str = fixed.INVOICE,
    posted: Sequence[str] = ("E", "A", "RA", "NFE_P"),
    order_type: str | None = None,
    bill_to_code: str | None = None,
    prefix: str = "499.",
) -> DataFrame:
    """Pre-shipments that neither fiscal table knows under their padded document key."""
    rows = ship.filter((F.col("record_create_date") >= ts(since)) & (F.col("transaction_code") == code))
    if order_type is not None:
        rows = rows.filter(F.col("order_type") == order_type)
    if bill_to_code is not None:
        rows = rows.filter(F.col("bill_to_code") == bill_to_code)
    keyed = rows.withColumn("document_key", padded_document_key("display_order_number", prefix))
    # both tables are tested with the same key: one anti-join against their union
    known = (
        fiscal_header.filter(F.col("status").isin(*posted))
        .select(F.col("ref_no_1").alias("document_key"))
        .unionByName(
            fiscal_notify.filter(F.col("status_id").isin(*posted)).select(F.col("asn_nbr").alias("document_key"))
        )
    )
    return missing(keyed, known, ["document_key"]).select("order_number", "host_group_id", "transaction_code")


def resend_preship(rows: DataFrame, service: str = fixed.SEND_PRESHIP) -> ChangeSet:
    """Send the messages again and mark them as sent again."""
    marked = rows.select("host_group_id").distinct().withColumn("po_number", F.lit("REENVIO"))
    return ChangeSet(
        updates={"t_al_host_shipment_master": Update(marked, ("host_group_id",))}, outbox=outbox_rows(rows, service)
    )


def failed_preship(
    ship: DataFrame,
    service_log: DataFrame,
    since: datetime,
    phrases: Sequence[str] = fixed.ERROR_PHRASES,
    success: str = fixed.SUCCESS_PHRASE,
    code: str = fixed.INVOICE,
) -> DataFrame:
    """Pre-shipments with an error reply and no success reply: one row per kind of error.

    The log is read once: per message group, whether it ever succeeded and which errors it got.
    """
    reply = F.col("soap_respond")
    relevant = reduce(Column.__or__, [reply.contains(p) for p in phrases], reply.contains(success))
    replies = (
        service_log.filter(relevant)
        .groupBy("param1")
        .agg(
            F.max(reply.contains(success)).alias("ok"),
            *[F.max(reply.contains(p)).alias(f"e{i}") for i, p in enumerate(phrases)],
        )
    )
    seen = F.array(*[F.when(F.col(f"e{i}"), F.lit(p)) for i, p in enumerate(phrases)])
    failed = replies.filter(~F.col("ok")).select("param1", F.array_compact(seen).alias("errors"))
    sent = (
        ship.filter((F.col("record_create_date") >= ts(since)) & (F.col("transaction_code") == code))
        .select("host_group_id", "order_number", "wh_id")
        .distinct()
    )
    joined = attach(sent, failed, [("host_group_id", "param1")], "inner")
    return joined.select("host_group_id", "order_number", "wh_id", F.explode("errors").alias("error_type"))


def resend_failed_preship(rows: DataFrame, as_of: datetime, service: str = fixed.SEND_PRESHIP) -> ChangeSet:
    """Send each group again and log every failed message."""
    profile = AuditProfile(
        *fixed.LOG_RESEND,
        columns={"control_number": "order_number", "control_number_2": "error_type", "wh_id": "wh_id"},
    )
    return ChangeSet(outbox=outbox_rows(rows, service), audit=audit_rows(rows, profile, as_of))


def missing_holds(stock: DataFrame, locations: DataFrame, holds: DataFrame, wh_id: str | None = None) -> DataFrame:
    """Held stock outside type-F locations without a hold record; an absent lot equals an absent lot."""
    held = stock.filter(F.col("status") == "H")
    if wh_id is not None:
        held = held.filter(F.col("wh_id") == wh_id)
    usable = locations.filter(F.col("type") != "F").select("location_id", "wh_id")
    placed = attach(held, usable, ["location_id", "wh_id"], "inner")
    keyed = null_safe(placed, "lot_number", "lot_key")
    known = null_safe(holds, "lot_number", "lot_key")
    return missing(keyed, known, ["item_number", "wh_id", "location_id", "lot_key"]).drop("lot_key")


def add_holds(rows: DataFrame, as_of: datetime, ticket: str) -> ChangeSet:
    """Hold and audit rows for the held stock without one."""
    optional = {"type", "stored_attribute_id", "hu_id"} & set(rows.columns)
    created = rows.select(
        "item_number",
        "wh_id",
        "location_id",
        "lot_number",
        *sorted(optional),
        F.lit("04").alias("reason_id"),
        ts(as_of).alias("date_created"),
        F.lit(ticket).alias("employee_id"),
    )
    profile = AuditProfile(
        fixed.LOG_HOLD[0],
        fixed.LOG_HOLD[1] + ticket,
        columns={
            "control_number": F.lit(ticket), "control_number_2": F.lit("Inserção na T_HOLDS"), "wh_id": "wh_id",
            "hu_id": "hu_id", "location_id": "location_id", "location_id_2": "location_id",
            "num_items": "actual_qty", "item_number": "item_number", "tran_qty": "actual_qty",
        },
        split_clock=True,
    )
    return ChangeSet(inserts={"t_holds": created}, audit=audit_rows(rows, profile, as_of))


def _untyped_units(
    hu: DataFrame, po: DataFrame, containing: Sequence[str], equal: Sequence[str], excluded: str, wh_id: str | None
) -> DataFrame:
    """Handling units without container type, at watched locations, of known orders."""
    place = F.col("location_id")
    watched = reduce(Column.__or__, [place.contains(p) for p in containing], place.isin(*equal))
    rows = hu.filter(F.col("container_type").isNull() & (place != excluded) & watched)
    if wh_id is not None:
        rows = rows.filter(F.col("wh_id") == wh_id)
        po = po.filter(F.col("wh_id") == wh_id)
    rows = rows.select("hu_id", "wh_id", "location_id", "control_number", "load_id")
    return matching(rows, po, [("load_id", "display_po_number")])


def unread_containers(
    hu: DataFrame,
    po: DataFrame,
    readings: DataFrame,
    containing: Sequence[str] = fixed.WATCHED_PARTS,
    equal: Sequence[str] = fixed.WATCHED_PLACES,
    excluded: str = fixed.NO_READING_AT,
    wh_id: str | None = None,
) -> DataFrame:
    """Containers without a type that were never read."""
    units = _untyped_units(hu, po, containing, equal, excluded, wh_id)
    unread = missing(units, readings, ["hu_id", "wh_id"], one_row_per_key=True)
    return unread.withColumn("error_program", F.lit(fixed.NEVER_READ))


def read_after_divert(
    hu: DataFrame,
    po: DataFrame,
    tran_log: DataFrame,
    containing: Sequence[str] = fixed.WATCHED_PARTS,
    equal: Sequence[str] = fixed.WATCHED_PLACES,
    excluded: str = fixed.NO_READING_AT,
    wh_id: str | None = None,
    read_type: str = "411",
    divert_type: str = "410",
) -> DataFrame:
    """Last reading and first divert of containers without a type; a later reading is an error."""
    units = _untyped_units(hu, po, containing, equal, excluded, wh_id)
    kind = F.col("tran_type")
    at = joined_timestamp("start_tran_date", "start_tran_time")
    # the log is large and the containers without a type are few; their orders need not be looked up for it
    log = tran_log.filter(kind.isin(read_type, divert_type))
    untyped = hu.filter(F.col("container_type").isNull())
    own = matching(log.select("hu_id", "wh_id", "tran_type", "start_tran_date", "start_tran_time"), untyped, ["hu_id", "wh_id"])
    moments = (
        own.groupBy("hu_id", "wh_id")
        .agg(
            F.max(F.when(kind == read_type, at)).alias("last_read"),
            F.min(F.when(kind == divert_type, at)).alias("first_divert"),
        )
    )
    late = F.col("last_read") > F.col("first_divert")
    return attach(units, moments, ["hu_id", "wh_id"], one_row_per_key=True).withColumn(
        "error_program", F.when(late, "ERRO").otherwise("OK")
    )


def type_containers(rows: DataFrame, as_of: datetime, message: str) -> ChangeSet:
    """Give the containers the type CX and log an exception for each."""
    logged = rows.select(
        F.lit(fixed.EXC_CONTAINER[0]).alias("tran_type"),
        F.lit(fixed.EXC_CONTAINER[1]).alias("description"),
        ts(as_of).alias("exception_date"),
        F.lit(fixed.USER).alias("employee_id"),
        "wh_id",
        "load_id",
        F.col("control_number").alias("line_number"),
        "location_id",
        F.lit(message).alias("error_message"),
    )
    typed = rows.select("hu_id", "wh_id").distinct().withColumn("container_type", F.lit("CX"))
    still_untyped = F.col("container_type").isNull()
    return ChangeSet(
        inserts={"t_exception_log": with_id(logged, "exception_id")},
        updates={"t_hu_master": Update(typed, ("hu_id", "wh_id"), where=still_untyped)},
    )


def detach_orders(order_messages: DataFrame, po_messages: DataFrame, orders: DataFrame, po: DataFrame) -> DataFrame:
    """Order messages sent with the given order documents that exist already while their PO does not."""
    rows = order_messages.select("host_group_id", "order_number", "wh_id", "customer_po_number")
    sent = matching(rows, po_messages, ["host_group_id"])
    existing = matching(sent, orders, ["order_number"])
    detached = missing(existing, po, [("customer_po_number", "display_po_number")])
    keys = ("host_group_id", "order_number", "wh_id", "customer_po_number")
    return detached.withColumn("new_guid", guid(*keys))


def apply_detach(detached: DataFrame, po_messages: DataFrame, service: str = fixed.IMPORT_PO) -> ChangeSet:
    """Move the headers and details to their new group, then queue the order documents again."""
    header_keys = ("host_group_id", "order_number", "wh_id", "customer_po_number")
    detail_keys = ("host_group_id", "order_number", "wh_id")

    def moved(keys: tuple[str, ...]) -> DataFrame:
        return detached.groupBy(*keys).agg(F.min("new_guid").alias("new_guid")).withColumn(
            "display_order_number", F.col("order_number").cast("string")
        )

    into = {"new_guid": "host_group_id"}
    return ChangeSet(
        updates={
            "t_al_host_order_master": Update(moved(header_keys), header_keys, into=into),
            "t_al_host_order_detail": Update(moved(detail_keys), detail_keys, into=into),
        },
        outbox=outbox_rows(po_messages, service),
    )


def fill_fulfilment(
    receipts: DataFrame, po: DataFrame, type_id: str = "1762", wh_id: str | None = None, empty: str = "0"
) -> DataFrame:
    """Receipts without fulfilment id of a given order type, with the id of their order."""
    rows = receipts.filter(F.col("fulfillment_id") == empty)
    if wh_id is not None:
        rows = rows.filter(F.col("wh_id") == wh_id)
    keys = rows.select("po_number", "wh_id", "host_group_id").distinct()
    typed = matching(keys, po.filter(F.col("type_id") == type_id), ["po_number"])
    return attach(typed, po.select("po_number", "wh_id", "fulfillment_id").distinct(), ["po_number", "wh_id"], "inner")


def apply_fulfilment(rows: DataFrame, service: str = fixed.SEND_UNDO) -> ChangeSet:
    """Write the order's fulfilment id and send each group."""
    keys = ("host_group_id", "po_number", "wh_id")
    filled = rows.groupBy(*keys).agg(F.max("fulfillment_id").alias("fulfillment_id"))
    return ChangeSet(
        updates={"t_al_host_receipt": Update(filled, keys)}, outbox=outbox_rows(rows, service)
    )


def fix_reservation(
    hu: DataFrame,
    stock: DataFrame,
    picks: DataFrame,
    order_detail: DataFrame,
    reserved: str = "TSFCON",
    excluded: Sequence[str] = (fixed.NO_READING_AT, fixed.PRE_RECEIPT),
) -> DataFrame:
    """Reserved handling units without a control number: the line and reservation they should have."""
    units = hu.filter(
        (F.col("reserved_for") == reserved) & F.col("control_number").isNull() & ~F.col("location_id").isin(*excluded)
    ).select("hu_id", "wh_id", "location_id")
    joined = attach(stock.select("hu_id", "wh_id", "type"), units, ["hu_id", "wh_id"], "inner")
    reserved_picks = picks.select(
        F.col("pick_id").cast("string").alias("pick_id"), "wh_id", "order_number", "line_number", "item_number"
    )
    picked = attach(joined, reserved_picks, [("type", "pick_id"), "wh_id"], "inner")
    lines = order_detail.select(
        "order_number", "line_number", "item_number", "cust_part", F.col("wh_id").alias("order_wh_id")
    )
    ordered = attach(picked, lines, ["order_number", "line_number", "item_number"], "inner")
    own = F.col("cust_part").cast("string") == F.col("order_wh_id").cast("string")
    return ordered.select(
        "hu_id",
        "wh_id",
        "line_number",
        "location_id",
        F.when(own, "SHIP").otherwise(text(F.lit("TRANSF_"), F.col("cust_part"))).alias("new_reserved"),
    ).distinct()


def apply_reservation(rows: DataFrame, as_of: datetime, ticket: str) -> ChangeSet:
    """Write line and reservation; a unit with several lines gets the highest."""
    last = F.max(F.struct("line_number", "new_reserved"))
    chosen = rows.groupBy("hu_id", "wh_id").agg(last.alias("last")).select(
        "hu_id",
        "wh_id",
        F.col("last.line_number").alias("control_number"),
        F.col("last.new_reserved").alias("reserved_for"),
    )
    profile = AuditProfile(
        *fixed.LOG_RESERVATION,
        columns={
            "line_number": "line_number", "control_number": F.lit(ticket), "control_number_2": "new_reserved",
            "wh_id": "wh_id", "hu_id": "hu_id", "location_id": "location_id", "num_items": F.lit(0),
            "tran_qty": F.lit(0),
        },
        split_clock=True,
    )
    return ChangeSet(
        updates={"t_hu_master": Update(chosen, ("hu_id", "wh_id"))}, audit=audit_rows(rows, profile, as_of)
    )


def missing_location_rows(
    stores: DataFrame,
    existing: DataFrame,
    suffix: str = ".1",
    kind: str = "relation",
    store_numbers: Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Rows to add for stores that lack them: ``relation`` or ``zone`` rows of the store's location. ``strict`` cuts
    store numbers to 3 characters instead of failing on longer ones."""
    rows = stores if store_numbers is None else stores.filter(F.col("store_number").isin(*store_numbers))
    named = rows.select("wh_id", store_location("store_number", suffix, strict).alias("location_id"))
    absent = missing(named, existing, ["location_id", "wh_id"])
    if kind == "zone":
        return absent.select("wh_id", F.lit("ALL").alias("zone"), "location_id")
    return absent.select(
        "wh_id",
        "location_id",
        F.lit(fixed.STORE_STAGING).alias("related_location_id"),
        F.lit(fixed.STORE_RELATION).alias("relation_type"),
        F.lit("ALL").alias("zone"),
        F.lit("ALL").alias("status"),
    )


def orphan_stock(
    stock: DataFrame,
    hu: DataFrame,
    picks: DataFrame,
    tran_log: DataFrame,
    excluded: Sequence[str] = (fixed.PRE_RECEIPT,),
    alloc_type: str = "351",
    wh_id: str | None = None,
) -> DataFrame:
    """Stock reserved for a pick that does not exist, whose allocated order line has no pick either."""
    rows = stock.filter((F.col("type") != "STORAGE") & ~F.col("location_id").isin(*excluded))
    if wh_id is not None:
        rows = rows.filter(F.col("wh_id") == wh_id)
    # added up before the joins: one row per unit, item and reservation
    rows = rows.groupBy("hu_id", "wh_id", "item_number", "type").agg(F.sum("actual_qty").alias("actual_qty"))
    known = picks.select(F.col("pick_id").cast("string").alias("type"), "wh_id")
    unpicked = missing(rows, known, ["type", "wh_id"])
    allocated = (
        tran_log.filter((F.col("tran_type") == alloc_type) & F.col("control_number").isNotNull())
        .groupBy("hu_id", "wh_id")
        .agg(F.max("control_number").alias("alloc1"))
    )
    # unit and allocation meet first: the stock is shuffled by unit only once
    units = hu.select("hu_id", "wh_id", "reserved_for", "control_number")
    given = attach(allocated, units, ["hu_id", "wh_id"], "inner", one_row_per_key=True)
    with_order = attach(unpicked, given, ["hu_id", "wh_id"], "inner")
    lines = picks.select("order_number", "line_number", "wh_id")
    orphans = missing(with_order, lines, [("alloc1", "order_number"), ("control_number", "line_number"), "wh_id"])
    keys = ["type", "wh_id", "reserved_for", "control_number", "alloc1", "item_number"]
    return orphans.groupBy(*keys).agg(F.sum("actual_qty").alias("actual_qty"))


def create_orphan_picks(orphans: DataFrame, as_of: datetime, first_id: int) -> ChangeSet:
    """A work task and a released pick for each orphan; ids count up from ``first_id``."""
    order = ["wh_id", "alloc1", "control_number", "item_number", "type", "reserved_for"]
    numbered = number_rows(orphans, order, "work_q_id", start=first_id)
    tasks = numbered.select(
        "work_q_id",
        F.lit("03").alias("work_type"),
        F.lit("Order Pick").alias("description"),
        F.lit("20").alias("priority"),
        "wh_id",
        F.lit("U").alias("work_status"),
        F.lit(0.0).alias("qty"),
        ts(as_of).alias("datetime_stamp"),
    )
    none = F.lit(0.0)
    picks = numbered.select(
        F.col("type").alias("pick_id"),
        F.col("alloc1").alias("order_number"),
        F.col("control_number").alias("line_number"),
        F.lit("PP").alias("type"),
        F.lit("EA").alias("uom"),
        "work_q_id",
        F.lit("03").alias("work_type"),
        F.lit("RELEASED").alias("status"),
        "item_number",
        F.col("type").alias("lot_number"),
        F.col("actual_qty").alias("planned_quantity"),
        none.alias("picked_quantity"),
        none.alias("staged_quantity"),
        none.alias("loaded_quantity"),
        none.alias("packed_quantity"),
        none.alias("shipped_quantity"),
        F.lit("WAVE-").alias("wave_id"),
        F.lit("GERAL").alias("pick_area"),
        "wh_id",
        ts(as_of).alias("create_date"),
    )
    return ChangeSet(inserts={"t_work_q": tasks, "t_pick_detail": picks})


def sorter_returns(
    tran_log: DataFrame,
    hu: DataFrame,
    as_of: datetime,
    days: int | None,
    excluded: Sequence[str] = fixed.RAIL_BUFFERS,
    moved_type: str = "317",
    returned_type: str = "024",
    returned_on: Sequence[str] = ("hu_id",),
    wh_id: str | None = None,
) -> DataFrame:
    """Units moved to the sorter that no longer exist and have not been returned, with their quantity."""
    moved = tran_log.filter((F.col("tran_type") == moved_type) & ~F.col("location_id").isin(*excluded))
    if wh_id is not None:
        moved = moved.filter(F.col("wh_id") == wh_id)
    if days is not None:
        moved = moved.filter(F.col("start_tran_date") >= ts(day(as_of, days)))
    keys = ["location_id", "location_id_2", "wh_id", "item_number", "hu_id"]
    summed = moved.groupBy(*keys).agg(F.sum("tran_qty").alias("qty"))
    gone = missing(summed, hu, ["hu_id", "wh_id"])
    returned = tran_log.filter(F.col("tran_type") == returned_type)
    return missing(gone, returned, list(returned_on))


def return_from_sorter(rows: DataFrame, as_of: datetime, ticket: str) -> tuple[DataFrame, ChangeSet]:
    """Return moves (input of ``move_stock``) and the attribute and audit changes."""
    moves = rows.select(
        "wh_id",
        "item_number",
        "qty",
        F.col("location_id_2").alias("from_location"),
        F.lit(None).cast("string").alias("from_hu"),
        F.col("location_id").alias("to_location"),
        F.col("hu_id").alias("to_hu"),
    )
    units = rows.select("hu_id", "wh_id").distinct().select(
        "hu_id", "wh_id", F.lit("BUFFER").alias("reserved_for"), F.lit("EN").alias("container_type")
    )
    profile = AuditProfile(
        *fixed.LOG_SORTER_RETURN,
        columns={
            "control_number": F.lit(ticket), "wh_id": "wh_id", "hu_id": "hu_id", "location_id": "location_id_2",
            "location_id_2": "location_id", "num_items": F.lit(0), "item_number": "item_number", "tran_qty": "qty",
        },
        split_clock=True,
    )
    changes = ChangeSet(
        updates={"t_hu_master": Update(units, ("hu_id", "wh_id"))}, audit=audit_rows(rows, profile, as_of)
    )
    return moves, changes


def barcode_to_item(adjustments: DataFrame, barcodes: DataFrame, items: DataFrame) -> DataFrame:
    """Adjustments that carry a barcode in place of an item, with the item of the barcode."""
    rows = adjustments.select(F.col("item_number").alias("upc"), "adjustment_id", "host_group_id", "wh_id")
    unknown = missing(rows, items, [("upc", "item_number"), "wh_id"])
    return attach(unknown, barcodes.select("upc", "wh_id", "item_number"), ["upc", "wh_id"], "inner")


def apply_barcodes(rows: DataFrame, ticket: str, service: str = fixed.SEND_ADJUSTMENT) -> ChangeSet:
    """Write the item, keep the barcode, send the groups again."""
    last = F.max("item_number")
    fixed = rows.groupBy("adjustment_id").agg(
        last.alias("item_number"),
        last.alias("display_item_number"),
        F.max("upc").alias("gen_attribute_value2"),
    ).withColumn("gen_attribute_value1", F.lit(f"Problema {ticket}"))
    return ChangeSet(
        updates={"t_al_host_inventory_adjustment": Update(fixed, ("adjustment_id",))},
        outbox=outbox_rows(rows, service),
    )


def gtin_backfill(units: DataFrame, barcodes: DataFrame, wh_id: str | None = None, cap: int | None = None) -> DataFrame:
    """Item units without GTIN whose item has exactly one barcode."""
    empty = units.filter(F.col("gtin").isNull())
    if wh_id is not None:
        empty = empty.filter(F.col("wh_id") == wh_id)
    codes = barcodes.groupBy("item_number", "wh_id").agg(
        F.countDistinct("upc").alias("count_upc"), F.max("upc").alias("upc")
    )
    single = codes.filter(F.col("count_upc") == 1).drop("count_upc")
    keys = ["item_number", "wh_id"]
    found = attach(empty.select(*keys).distinct(), single, keys, "inner", one_row_per_key=True)
    return found if cap is None else found.orderBy("item_number", "wh_id").limit(cap)


def apply_gtin(rows: DataFrame, as_of: datetime) -> ChangeSet:
    """Fill the empty GTINs with the barcode and log each item."""
    filled = rows.select("item_number", "wh_id", F.col("upc").alias("gtin"))
    profile = AuditProfile(
        *fixed.LOG_GTIN,
        columns={
            "control_number": "upc", "control_number_2": F.lit("GTIN NULL"), "wh_id": "wh_id", "num_items": F.lit(0),
            "item_number": "item_number", "tran_qty": F.lit(0),
        },
        split_clock=True,
    )
    return ChangeSet(
        updates={"t_item_uom": Update(filled, ("item_number", "wh_id"), where=F.col("gtin").isNull())},
        audit=audit_rows(rows, profile, as_of),
    )
