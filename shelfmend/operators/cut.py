"""Order cut and cancellation: detect lines without stock, classify, cut, invoice, cancel, log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.clock import ts
from ..functions.fixed import CANCEL_COMPLETE, CANCEL_PARTIAL, CUT, CUT_MARK, INVOICE
from ..functions.text import guid, text
from ..plans.changeset import ChangeSet, Update, apply_change_set, with_id
from ..plans.joins import attach, matching, missing
from ..plans.numbering import pinned
from .audit import AuditProfile, audit_rows, outbox_rows

CANCEL_CODES = (CANCEL_COMPLETE, CANCEL_PARTIAL)
STORAGE = "0"  # the type of stock that is not reserved

_ORDER_COLUMNS = (
    "display_order_number", "pro_number", "carton_label", "carrier", "weight", "cubic_volume", "client_code",
    "master_bol_number", "bill_to_code", "bill_to_name", "bill_to_addr1", "bill_to_addr2", "bill_to_city",
    "bill_to_state", "bill_to_zip", "bill_to_phone", "carrier_mode", "fulfillment_id", "split_status",
)
_RENAMED = {
    "carton_label": "seal_number", "carrier": "carrier_code", "weight": "total_weight", "cubic_volume": "total_volume",
}


def _order_part(orders: DataFrame) -> list[Column]:
    """The order columns a shipment header copies, as far as the order table has them."""
    present = set(orders.columns)
    return [F.col(c).alias(_RENAMED.get(c, c)) for c in _ORDER_COLUMNS if c in present]


def min_uom(units: DataFrame) -> DataFrame:
    """Smallest unit of measure per item (our definition: lowest conversion, then name)."""
    smallest = F.min(F.struct("conversion", "uom"))
    return units.groupBy("item_number", "wh_id").agg(smallest.alias("s")).select(
        "item_number", "wh_id", F.col("s.uom").alias("uom")
    )


def _named_items(items: DataFrame, units: DataFrame) -> DataFrame:
    """Display name and smallest unit per item, joined once before the lines use them."""
    names = items.select("item_number", "wh_id", "display_item_number")
    return attach(names, min_uom(units), ["item_number", "wh_id"], one_row_per_key=True)


def zero_stock_lines(
    picks: DataFrame,
    stock: DataFrame,
    tran_log: DataFrame,
    ship: DataFrame,
    locations: DataFrame | None = None,
    areas: DataFrame | None = None,
    logged: DataFrame | None = None,
    start_type: str = "301",
    storage_type: str = STORAGE,
    item_level_start: bool = False,
    wh_id: str | None = None,
) -> DataFrame:
    """Released pick lines whose item has no free stock and whose order is neither started, invoiced,
    reserved nor logged already.

    Without ``locations``/``areas``/``logged`` and with ``item_level_start`` this is the older form:
    all storage stock counts and the start is tested per item.
    """
    storage = stock.filter(F.col("type") == storage_type)
    if locations is not None:
        storage = storage.filter(F.col("status") == "A")
    place = storage.groupBy("item_number", "wh_id", "location_id").agg(
        F.sum("actual_qty").alias("held"), F.sum("unavailable_qty").alias("blocked")
    )
    if locations is not None:
        active = locations.filter(F.col("status") != "I").select("location_id", "wh_id", "pick_area")
        if areas is not None:
            active = matching(active, areas, ["wh_id", "pick_area"])
        place = matching(place, active, ["location_id", "wh_id"])
    free = place.groupBy("item_number", "wh_id").agg((F.sum("held") - F.sum("blocked")).alias("free"))

    released = picks.filter((F.col("status") == "RELEASED") & (F.col("type") == "PP"))
    if wh_id is not None:
        released = released.filter(F.col("wh_id") == wh_id)
    keys = ["wave_id", "wh_id", "pick_id", "order_number", "item_number"]
    # all tests depend on these keys only, so they come first and what is left is added up
    released = released.select(*keys, "planned_quantity")
    empty = missing(released, free.filter(F.col("free") != 0), ["item_number", "wh_id"])

    started = tran_log.filter(F.col("tran_type") == start_type)
    invoiced = ship.filter(F.col("transaction_code") == INVOICE).select("order_number", "wh_id")
    if item_level_start:
        empty = missing(empty, started, [("order_number", "control_number"), "wh_id", "item_number"])
        empty = missing(empty, invoiced, ["order_number", "wh_id"])
    else:
        begun = started.select(F.col("control_number").alias("order_number"), "wh_id").unionByName(invoiced)
        empty = missing(empty, begun, ["order_number", "wh_id"])
    reserved = stock.filter(F.col("type") != storage_type).select(F.col("type").alias("pick_key"))
    empty = missing(empty.withColumn("pick_key", F.col("pick_id").cast("string")), reserved, ["pick_key"])
    if logged is not None:
        known = logged.filter((F.col("tran_type") == CUT) & (F.col("lot_number") == CUT_MARK))
        empty = missing(empty, known, [("order_number", "control_number"), "item_number"])
    lines = empty.groupBy(*keys).agg(F.sum("planned_quantity").alias("plan_qty"))
    return lines.select("order_number", "item_number", "wh_id", "plan_qty", "wave_id").distinct()


def log_cut(lines: DataFrame, as_of: datetime) -> ChangeSet:
    """Exception rows for the lines to cut."""
    rows = lines.select(
        guid("order_number", "wh_id", "item_number", "wave_id", "plan_qty").alias("exception_id"),
        F.col("order_number").alias("control_number"),
        F.lit(fixed.EXC_CUT).alias("description"),
        "item_number",
        "wh_id",
        F.col("plan_qty").alias("quantity"),
        F.col("wave_id").alias("load_id"),
        F.lit(CUT).alias("tran_type"),
        F.lit(CUT_MARK).alias("lot_number"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("suggested_value"),
        ts(as_of).alias("exception_date"),
    )
    return ChangeSet(inserts={"t_exception_log": rows})


def _typed(rows: DataFrame, order_detail: DataFrame, name: str = "tipo") -> DataFrame:
    """PARTIAL if the order has another item that is not cut, else COMPLETE.

    The number of other uncut items is the order's count less one if the row's own item is uncut.
    """
    uncut = order_detail.filter(F.col("bo_qty") == 0).select("order_number", "wh_id", "item_number").distinct()
    per_order = uncut.groupBy("order_number", "wh_id").agg(F.count(F.lit(1)).alias("uncut_items"))
    own = uncut.withColumn("own_uncut", F.lit(1))
    order = [("control_number", "order_number"), "wh_id"]
    counted = attach(attach(rows, per_order, order), own, [*order, "item_number"], one_row_per_key=True)
    others = F.coalesce("uncut_items", F.lit(0)) - F.coalesce("own_uncut", F.lit(0))
    return counted.withColumn(name, F.when(others > 0, "PARTIAL").otherwise("COMPLETE")).drop(
        "uncut_items", "own_uncut"
    )


def _sent_items(
    ship_header: DataFrame, ship_detail: DataFrame, codes: Sequence[str], orders: DataFrame | None = None
) -> DataFrame:
    """Order and item of the messages with one of the codes; ``orders`` (control_number) limits the history."""
    headers = ship_header.filter(F.col("transaction_code").isin(*codes)).select(
        "shipment_id", F.col("order_number").alias("sent_order"), F.col("wh_id").alias("sent_wh")
    )
    if orders is not None:
        headers = matching(headers, orders, [("sent_order", "control_number")])
    details = ship_detail.select("shipment_id", "item_number")
    return attach(details, headers, ["shipment_id"], "inner")


def classify_cut(
    log: DataFrame,
    order_detail: DataFrame,
    ship_header: DataFrame,
    ship_detail: DataFrame | None = None,
    since: datetime | None = None,
    codes: Sequence[str] = (CANCEL_COMPLETE,),
    cap: int | None = None,
) -> DataFrame:
    """Cut orders to process, as PARTIAL or COMPLETE; an order can have both while items differ.

    With ``ship_detail`` an item is done if it was sent itself; without it, if its order was sent.
    """
    open_rows = log.filter(
        (F.col("tran_type") == CUT) & (F.col("lot_number") == CUT_MARK) & F.col("status").isNull()
    )
    if since is not None:
        open_rows = open_rows.filter(F.col("exception_date") >= ts(since))
    rows = open_rows.select("control_number", "wh_id", "item_number").distinct()
    if ship_detail is not None:
        sent = _sent_items(ship_header, ship_detail, codes, rows)
        rows = missing(rows, sent, [("control_number", "sent_order"), "item_number"])
    else:
        sent = ship_header.filter(F.col("transaction_code").isin(*codes))
        rows = missing(rows, sent, [("control_number", "order_number")])
    found = _typed(rows, order_detail).select("control_number", "wh_id", "tipo").distinct()
    return found if cap is None else found.orderBy("control_number", "wh_id", "tipo").limit(cap)


def pending_cancels(
    log: DataFrame, order_detail: DataFrame, ship_header: DataFrame, ship_detail: DataFrame
) -> DataFrame:
    """Orders that a cut, this one or an earlier one, left to cancel, typed by what is left of them now.

    An item whose cancellation was sent before does not count.
    """
    waiting = log.filter(
        (F.col("tran_type") == CUT) & (F.col("suggested_value") == "PEND") & F.col("status").isin("PARTIAL", "COMPLETE")
    )
    rows = waiting.select("control_number", "wh_id", "item_number").distinct()
    sent = _sent_items(ship_header, ship_detail, CANCEL_CODES, rows)
    unsent = missing(rows, sent, [("control_number", "sent_order"), "item_number"])
    return _typed(unsent, order_detail).select("control_number", "wh_id", "tipo").distinct()


def one_type_per_order(classified: DataFrame) -> DataFrame:
    """PARTIAL wins if the items of an order disagree, so code and service cannot differ later."""
    partial = F.max(F.col("tipo") == "PARTIAL")
    return classified.groupBy("control_number", "wh_id").agg(F.when(partial, "PARTIAL").otherwise("COMPLETE").alias("tipo"))


def apply_cut(classified: DataFrame, log: DataFrame) -> ChangeSet:
    """Cut the order lines and picks and mark the log rows; orders already pending are left alone."""
    cut_log = log.filter(F.col("tran_type") == CUT)
    pending = cut_log.filter(F.col("suggested_value") == "PEND")
    decided = missing(one_type_per_order(classified), pending, ["control_number"], one_row_per_key=True)
    lines = (
        matching(cut_log, decided, ["control_number", "wh_id"])
        .groupBy(F.col("control_number").alias("order_number"), "wh_id", "item_number")
        .agg(
            F.max_by("quantity", "exception_id").alias("bo_qty"),
            F.max(F.col("load_id").isNull()).alias("no_wave"),
        )
    )
    key = ("order_number", "wh_id", "item_number")
    order_rows = lines.select(
        *key, "bo_qty", F.when(F.col("no_wave"), F.lit(0.0)).alias("afo_plan_qty")
    )
    pick_rows = lines.select(
        *key,
        F.lit("PICKED").alias("status"),
        F.lit(fixed.USER).alias("lot_number"),
        F.lit("C").alias("pendency"),
        F.lit(fixed.USER_CUT).alias("user_assigned"),
    )
    marks = decided.groupBy("control_number").agg(F.max("tipo").alias("status")).select(
        "control_number", F.lit(CUT).alias("tran_type"), "status", F.lit("PEND").alias("suggested_value")
    )
    return ChangeSet(
        updates={
            "t_exception_log": Update(marks, ("control_number", "tran_type")),
            "t_order_detail": Update(order_rows, key, keep=("afo_plan_qty",)),
            "t_pick_detail": Update(pick_rows, key, where=F.col("status") == "RELEASED"),
        }
    )


def order_status_after_cut(order_detail: DataFrame, form: str = "uncut") -> DataFrame:
    """New order status. ``uncut``: D if any line is uncut, else C. ``remaining``: only the orders
    whose quantity is cut completely, as C."""
    if form == "uncut":
        return order_detail.groupBy("order_number").agg(
            F.when(F.max(F.col("bo_qty") == 0), "D").otherwise("C").alias("status")
        )
    left = order_detail.groupBy("order_number", "wh_id").agg(F.sum(F.col("qty") - F.col("bo_qty")).alias("left"))
    return left.filter(F.col("left") == 0).select("order_number", "wh_id", F.lit("C").alias("status"))


def last_item_gate(picks: DataFrame) -> DataFrame:
    """Orders with nothing picked waiting and nothing released any more."""
    status = F.col("status")
    counts = picks.groupBy("order_number", "wh_id").agg(
        F.count(F.when((status == "PICKED") & (F.col("picked_quantity") > 0), 1)).alias("picked"),
        F.count(F.when(status == "RELEASED", 1)).alias("released"),
    )
    return counts.filter((F.col("picked") == 0) & (F.col("released") == 0)).select("order_number", "wh_id")


def invoice_headers(
    picks: DataFrame,
    stock: DataFrame,
    orders: DataFrame,
    vendors: DataFrame,
    types: DataFrame,
    cut_orders: DataFrame | None = None,
    storage_type: str = STORAGE,
    user: str = fixed.USER_CUT,
) -> DataFrame:
    """Invoice header of the orders past the last-item gate that have reserved stock.

    COMPLETE if planned and picked quantities agree; both count once per reserved stock row.
    """
    gate = last_item_gate(picks if cut_orders is None else matching(picks, cut_orders, ["order_number", "wh_id"]))
    reserved = (
        stock.filter(F.col("type") != storage_type)
        .groupBy("type", "wh_id")
        .agg(F.count(F.lit(1)).alias("stock_rows"))
    )
    loaded = matching(picks, gate, [("load_id", "order_number"), "wh_id"]).select(
        F.col("pick_id").cast("string").alias("pick_key"),
        "wh_id",
        "order_number",
        "planned_quantity",
        "picked_quantity",
    )
    held = attach(loaded, reserved, [("pick_key", "type"), "wh_id"], "inner")
    sums = held.groupBy("order_number", "wh_id").agg(
        F.sum(F.col("planned_quantity") * F.col("stock_rows")).alias("planned"),
        F.sum(F.col("picked_quantity") * F.col("stock_rows")).alias("picked"),
    )
    named = orders.select("order_number", "wh_id", "type_id", *_order_part(orders))
    joined = attach(sums, named, ["order_number", "wh_id"], "inner", one_row_per_key=True)
    joined = attach(joined, types.select("type_id", F.col("type").alias("order_type")), ["type_id"], "inner")
    profiles = vendors.select("vendor_code", F.col("vqm_profile").alias("delivery_sap"))
    joined = attach(joined, profiles, [("bill_to_code", "vendor_code")])
    group = guid(F.lit(INVOICE), "order_number", "wh_id")
    return joined.select(
        group.alias("shipment_id"),
        group.alias("host_group_id"),
        F.lit(INVOICE).alias("transaction_code"),
        F.col("order_number").alias("load_id"),
        F.when(F.col("planned") == F.col("picked"), "COMPLETE").otherwise("PARTIAL").alias("status"),
        F.lit(user).alias("user_id"),
        F.lit(fixed.PRINTER).alias("printer_id"),
        *[c for c in joined.columns if c not in {"planned", "picked", "type_id"}],
    )


def attribute_columns(attribute_values: DataFrame, attribute_map: DataFrame) -> DataFrame:
    """The eleven mapped attributes of each stored attribute id as columns."""
    names = [f"generic_attribute_{i}" for i in range(1, 12)]
    # a global aggregate has one row, so at most eleven slots are broadcast
    one = attribute_map.agg(*[F.max(n).alias(n) for n in names])
    pairs = ", ".join(f"{i}, {n}" for i, n in enumerate(names, start=1))
    slots = one.selectExpr(f"stack(11, {pairs}) AS (slot, attribute_id)").filter(F.col("attribute_id").isNotNull())
    named = attribute_values.join(F.broadcast(slots), "attribute_id")
    return named.groupBy("stored_attribute_id").agg(
        *[
            F.max(F.when(F.col("slot") == i, F.col("attribute_value"))).alias(f"gen_attribute_value{i}")
            for i in range(1, 12)
        ]
    )


def _with_buyer(headers: DataFrame, orders: DataFrame) -> DataFrame:
    """Header keys with the order's client, so that the lines need one join for both."""
    heads = headers.select("shipment_id", "host_group_id", "load_id", "order_number", "wh_id")
    buyers = orders.select("order_number", "wh_id", "client_code", "display_order_number", "customer_id")
    return attach(heads, buyers, ["order_number", "wh_id"], "inner", one_row_per_key=True)


def invoice_details(
    stock: DataFrame,
    picks: DataFrame,
    headers: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    containers: DataFrame,
    units: DataFrame,
    attribute_values: DataFrame,
    attribute_map: DataFrame,
    storage_type: str = STORAGE,
    user: str = fixed.USER_CUT,
) -> DataFrame:
    """Invoice lines: reserved stock per pick, unit and container, with the mapped attributes."""
    held = (
        stock.filter(F.col("type") != storage_type)
        .groupBy("type", "wh_id", F.col("item_number").alias("stock_item"), "hu_id", "stored_attribute_id")
        .agg(F.sum("actual_qty").alias("qty"))
    )
    reserved = picks.select(
        F.col("pick_id").cast("string").alias("pick_key"), "wh_id", "order_number", "load_id", "line_number",
        "item_number", "container_id",
    )
    heads = _with_buyer(headers, orders)
    invoiced = attach(reserved, heads, ["load_id", "order_number", "wh_id"], "inner")
    joined = attach(invoiced, held, [("pick_key", "type"), "wh_id"], "inner")
    named = items.select("item_number", "wh_id", "display_item_number")
    joined = attach(joined, named, [("stock_item", "item_number"), "wh_id"], "inner")
    joined = attach(joined, containers.select("container_id", "wh_id", "tracking_number"), ["container_id", "wh_id"])
    joined = attach(joined, min_uom(units), ["item_number", "wh_id"])
    joined = attach(joined, attribute_columns(attribute_values, attribute_map), ["stored_attribute_id"])
    attributes = [f"gen_attribute_value{i}" for i in range(1, 12)]
    keys = [
        "shipment_id", "host_group_id", "line_number", "item_number", "display_item_number", "hu_id", "wh_id",
        "client_code", "uom", "tracking_number", "order_number", "display_order_number",
        "customer_id", "stored_attribute_id", *attributes,
    ]
    return (
        joined.groupBy(*keys)
        .agg(F.coalesce(F.sum("qty"), F.lit(0)).alias("quantity_shipped"))
        .withColumn("user_id", F.lit(user))
        .withColumnRenamed("customer_id", "delivery_sap")
        .drop("stored_attribute_id")
    )


def closable_tasks(
    picks: DataFrame,
    tasks: DataFrame,
    assignments: DataFrame,
    ship_header: DataFrame,
    ship_detail: DataFrame,
    codes: Sequence[str] = CANCEL_CODES,
    wh_id: str | None = None,
    cap: int | None = None,
) -> DataFrame:
    """Open tasks of cancelled order items with no released pick and nobody assigned."""
    rows = picks.filter(F.col("status") != "RELEASED")
    if "work_type" in picks.columns:
        rows = rows.filter(F.col("work_type").isNull())
    if wh_id is not None:
        rows = rows.filter(F.col("wh_id") == wh_id)
    opened = tasks.filter(F.col("work_status") != "C").select(
        "work_q_id", "work_status", F.col("wh_id").alias("task_wh_id")
    )
    columns = [c for c in ("lot_number", "pendency") if c in picks.columns]
    rows = rows.select(
        "work_q_id", "wh_id", "order_number", "item_number", "wave_id", "status", "pick_area", *columns
    )
    joined = attach(rows, opened, ["work_q_id"], "inner")
    released = picks.filter(F.col("status") == "RELEASED")
    idle = missing(joined, released, ["work_q_id", ("task_wh_id", "wh_id")])
    free = missing(idle, assignments, ["work_q_id", "wh_id"])
    cancelled = _sent_items(ship_header, ship_detail, codes)
    found = (
        matching(free, cancelled, [("order_number", "sent_order"), "item_number"])
        .drop("item_number", "task_wh_id")
        .distinct()
    )
    return found if cap is None else found.orderBy("work_q_id", "wh_id", "order_number", "wave_id", "status").limit(cap)


def close_cut_tasks(found: DataFrame, as_of: datetime) -> ChangeSet:
    """Close the tasks and log each."""
    closed = found.select("work_q_id", "wh_id").distinct().withColumn("work_status", F.lit("C"))
    columns = {
        "wh_id": "wh_id", "control_number": "order_number", "control_number_2": "wave_id", "location_id": "work_q_id",
        "location_id_2": "pick_area",
    }
    if "lot_number" in found.columns:
        columns["lot_number"] = "lot_number"
    profile = AuditProfile(*fixed.LOG_CLOSE_TASK, fixed.USER_CANCEL, columns)
    return ChangeSet(
        updates={"t_work_q": Update(closed, ("work_q_id", "wh_id"))}, audit=audit_rows(found, profile, as_of)
    )


def _coded(classified: DataFrame) -> DataFrame:
    """One type, code, service and message group per cancelled order."""
    whole = F.col("tipo") == "COMPLETE"
    code = F.when(whole, CANCEL_COMPLETE).otherwise(CANCEL_PARTIAL)
    return one_type_per_order(classified).select(
        F.col("control_number").alias("order_number"),
        "wh_id",
        "tipo",
        code.alias("transaction_code"),
        F.when(whole, fixed.SEND_CANCEL).otherwise(fixed.SEND_CANCEL_PARTIAL).alias("service"),
        guid(code, "control_number", "wh_id").alias("host_group_id"),
    )


def cancel_interface(
    classified: DataFrame, orders: DataFrame, order_detail: DataFrame, items: DataFrame, units: DataFrame
) -> ChangeSet:
    """Cancel messages: a header per order, a line per cut item, sent by the service of its type."""
    coded = _coded(classified)
    parts = orders.select("order_number", "wh_id", *_order_part(orders))
    known = attach(coded, parts, ["order_number", "wh_id"], "inner", one_row_per_key=True)
    headers = known.select(
        F.col("host_group_id").alias("shipment_id"),
        "host_group_id",
        "transaction_code",
        F.lit("COMPLETE").alias("status"),
        F.lit(fixed.USER_CANCEL).alias("user_id"),
        F.lit("CP").alias("order_type"),
        *[c for c in parts.columns],
    )
    cut_lines = order_detail.filter(F.col("bo_qty") > 0).select(
        "order_number", "wh_id", "item_number", "line_number", F.col("bo_qty").alias("quantity_shipped")
    )
    groups = known.select(
        "order_number", "wh_id", "host_group_id", "client_code", "display_order_number", "transaction_code"
    )
    lines = attach(cut_lines, groups, ["order_number", "wh_id"], "inner")
    lines = attach(lines, _named_items(items, units), ["item_number", "wh_id"], "inner")
    details = lines.withColumn("shipment_id", F.col("host_group_id")).withColumn("user_id", F.lit(fixed.USER_CANCEL))
    done = coded.select(F.col("order_number").alias("control_number")).distinct().select(
        "control_number", F.lit(CUT).alias("tran_type"), F.lit("OK").alias("suggested_value")
    )
    pending = F.col("suggested_value") == "PEND"
    return ChangeSet(
        inserts={
            "t_al_host_shipment_master": headers,
            "t_al_host_shipment_detail": with_id(details.drop("transaction_code"), "shipment_detail_id"),
        },
        updates={"t_exception_log": Update(done, ("control_number", "tran_type"), where=pending)},
        outbox=outbox_rows(known, F.col("service")),
    )


def cancel_trace(
    classified: DataFrame,
    orders: DataFrame,
    order_detail: DataFrame,
    items: DataFrame,
    picks: DataFrame,
    tran_log: DataFrame,
    codes: Sequence[str] = CANCEL_CODES,
) -> DataFrame:
    """Cut lines with their wave that have no cancel log row yet; one row per pick of the line."""
    coded = _coded(classified).select("order_number", "wh_id", "transaction_code")
    known = matching(coded, orders, ["order_number", "wh_id"], one_row_per_key=True)
    cut_lines = order_detail.filter(F.col("bo_qty") > 0).select("order_number", "wh_id", "item_number", "qty")
    lines = attach(cut_lines, known, ["order_number", "wh_id"], "inner")
    lines = matching(lines, items, ["item_number", "wh_id"])
    logged = tran_log.filter(F.col("tran_type").isin(*codes))
    untold = missing(lines, logged, [("order_number", "control_number"), "item_number", "wh_id"])
    waves = picks.select("order_number", "wh_id", "item_number", F.col("wave_id").alias("control_number_2"))
    return attach(untold, waves, ["order_number", "wh_id", "item_number"]).select(
        F.col("transaction_code").alias("tran_type"),
        F.col("order_number").alias("control_number"),
        "control_number_2",
        "item_number",
        F.col("qty").alias("tran_qty"),
        "wh_id",
    )


def log_cancels(rows: DataFrame, as_of: datetime, descriptions: DataFrame | None = None) -> ChangeSet:
    """Audit rows of all traced lines."""
    parts = [log_cancel(rows, code, as_of, descriptions) for code in CANCEL_CODES]
    return ChangeSet(audit=reduce(DataFrame.unionByName, parts))


def log_cancel(rows: DataFrame, code: str, as_of: datetime, descriptions: DataFrame | None = None) -> DataFrame:
    """Audit rows of the traced lines of one code."""
    profile = AuditProfile(
        code,
        employee=fixed.USER_CUT,
        columns={
            "control_number": "control_number", "control_number_2": "control_number_2", "item_number": "item_number",
            "tran_qty": "tran_qty", "wh_id": "wh_id",
        },
    )
    return audit_rows(rows.filter(F.col("tran_type") == code), profile, as_of, descriptions)


def cancel_eligible(
    orders: DataFrame, worklist: DataFrame, order_detail: DataFrame, ship_header: DataFrame, ship_detail: DataFrame
) -> DataFrame:
    """Listed order lines that were neither cancelled nor shipped; the worklist's item column holds
    the order number."""
    on_list = [("order_number", "item_number"), "wh_id"]
    listed = matching(orders.select("order_number", "wh_id"), worklist, on_list)
    columns = ["order_number", "wh_id", "item_number", "line_number", "qty", "bo_qty"]
    lines = matching(order_detail.select(*columns), listed, ["order_number", "wh_id"])
    # a cancel code or any other code makes the line ineligible; the list alone says whose messages count
    coded = ship_header.filter(F.col("transaction_code").isNotNull()).select("shipment_id", "order_number", "wh_id")
    headers = matching(coded, worklist, on_list)
    sent = attach(ship_detail.select("shipment_id", "item_number"), headers, ["shipment_id"], "inner")
    return missing(lines, sent, ["order_number", "wh_id", "item_number"]).distinct()


def apply_cancel(
    eligible: DataFrame,
    orders: DataFrame,
    order_detail: DataFrame,
    items: DataFrame,
    units: DataFrame,
    ship_header: DataFrame,
    user: str = fixed.USER_CANCEL_LIST,
) -> ChangeSet:
    """Cut the eligible lines completely, send a partial cancel per order, close orders fully cut."""
    key = ("order_number", "wh_id", "item_number")
    cut = pinned(eligible.select(*key).distinct())
    # met once with all order lines and written out: read for the lines, the messages and the orders
    flagged = pinned(
        attach(order_detail.select(*key, "line_number", "qty", "bo_qty"), cut.withColumn("cut", F.lit(True)), list(key))
    )
    # each line of the item is cut to its own quantity
    own_lines = flagged.filter("cut").select(*key, "line_number", F.col("qty").alias("bo_qty"))
    line_key = (*key, "line_number")
    updated_lines = own_lines.groupBy(*line_key).agg(F.max("bo_qty").alias("bo_qty"))

    code = F.lit(CANCEL_PARTIAL)
    affected = cut.select("order_number", "wh_id").distinct()
    grouped = affected.withColumn("host_group_id", guid(code, "order_number", "wh_id", F.lit(user)))
    parts = orders.select("order_number", "wh_id", *_order_part(orders))
    known = pinned(attach(grouped, parts, ["order_number", "wh_id"], "inner", one_row_per_key=True))
    new_orders = missing(
        known, ship_header.filter(F.col("transaction_code") == CANCEL_PARTIAL), ["order_number", "wh_id"]
    )
    headers = new_orders.select(
        F.col("host_group_id").alias("shipment_id"),
        "host_group_id",
        code.alias("transaction_code"),
        F.lit("COMPLETE").alias("status"),
        F.lit("CP").alias("order_type"),
        F.lit(fixed.USER_CANCEL_SENT).alias("user_id"),
        *parts.columns,
    )
    groups = known.select("order_number", "wh_id", "host_group_id", "client_code", "display_order_number")
    lines = attach(own_lines.filter(F.col("bo_qty") > 0), groups, ["order_number", "wh_id"], "inner")
    details = attach(lines, _named_items(items, units), ["item_number", "wh_id"], "inner").select(
        F.col("host_group_id").alias("shipment_id"),
        "host_group_id",
        "line_number",
        "item_number",
        "display_item_number",
        F.col("bo_qty").alias("quantity_shipped"),
        F.lit(user).alias("user_id"),
        "wh_id",
        "client_code",
        "uom",
        "order_number",
        "display_order_number",
    )
    # orders whose remaining quantity is zero once the lines are cut
    remaining = F.when(F.col("cut"), F.lit(0)).otherwise(F.col("qty") - F.col("bo_qty"))
    after = flagged.groupBy("order_number", "wh_id").agg(F.sum(remaining).alias("left"), F.max("cut").alias("cut"))
    closed = after.filter(F.col("cut") & (F.col("left") == 0)).select(
        "order_number", "wh_id", F.lit("C").alias("status")
    )
    return ChangeSet(
        inserts={
            "t_al_host_shipment_master": headers,
            "t_al_host_shipment_detail": with_id(details, "shipment_detail_id", code),
        },
        updates={
            "t_order_detail": Update(updated_lines, line_key),
            "t_order": Update(closed, ("order_number", "wh_id")),
        },
        outbox=outbox_rows(new_orders, fixed.SEND_CANCEL_PARTIAL),
    )


def shipinfo_headers(
    pending: DataFrame, orders: DataFrame, picks: DataFrame, vendors: DataFrame, types: DataFrame
) -> DataFrame:
    """Header of the missing shipment message: COMPLETE if everything planned was picked."""
    rows = matching(picks, pending, [("load_id", "order_number"), "wh_id"])
    sums = rows.groupBy("order_number", "wh_id").agg(
        F.sum("planned_quantity").alias("planned"), F.sum("picked_quantity").alias("picked")
    )
    parts = orders.select("order_number", "wh_id", "type_id", *_order_part(orders))
    joined = attach(sums, parts, ["order_number", "wh_id"], "inner", one_row_per_key=True)
    joined = attach(joined, types.select("type_id", F.col("type").alias("order_type")), ["type_id"], "inner")
    profiles = vendors.select("vendor_code", F.col("vqm_profile").alias("delivery_sap"))
    joined = attach(joined, profiles, [("bill_to_code", "vendor_code")])
    group = guid(F.lit("shipinfo"), "order_number", "wh_id")
    return joined.select(
        group.alias("shipment_id"),
        group.alias("host_group_id"),
        F.lit(INVOICE).alias("transaction_code"),
        F.col("order_number").alias("load_id"),
        F.when(F.col("planned") == F.col("picked"), "COMPLETE").otherwise("PARTIAL").alias("status"),
        F.lit(fixed.USER_SHIPINFO).alias("user_id"),
        F.lit(fixed.PRINTER).alias("printer_id"),
        *[c for c in joined.columns if c not in {"planned", "picked", "type_id"}],
    )


def shipinfo_details(headers: DataFrame, orders: DataFrame, picks: DataFrame, containers: DataFrame) -> DataFrame:
    """Shipped picks of the headers: picked quantity per line and tracking number."""
    # only the picks of the given headers are added up
    shipped = matching(picks.filter(F.col("status") == "SHIPPED"), headers, ["load_id", "order_number", "wh_id"])
    rows = shipped.groupBy(
        "load_id", "order_number", "wh_id", "line_number", "item_number", "container_id"
    ).agg(F.sum("picked_quantity").alias("qty"))
    joined = attach(rows, _with_buyer(headers, orders), ["load_id", "order_number", "wh_id"], "inner")
    joined = attach(joined, containers.select("container_id", "wh_id", "tracking_number"), ["container_id", "wh_id"])
    keys = [
        "shipment_id", "host_group_id", "wh_id", "line_number", "item_number", "client_code", "tracking_number",
        "order_number", "display_order_number", "customer_id",
    ]
    sums = joined.groupBy(*keys).agg(F.coalesce(F.sum("qty"), F.lit(0)).alias("quantity_shipped"))
    return sums.select(
        *keys[:-1],
        F.col("customer_id").alias("delivery_sap"),
        F.col("item_number").alias("display_item_number"),
        text(F.col("order_number"), F.lit("1")).alias("hu_id"),
        F.lit(fixed.USER).alias("user_id"),
        F.lit("EA").alias("uom"),
        "quantity_shipped",
    )


def rebuild_shipinfo(
    pending: DataFrame,
    orders: DataFrame,
    picks: DataFrame,
    vendors: DataFrame,
    types: DataFrame,
    containers: DataFrame,
    as_of: datetime,
) -> ChangeSet:
    """Header, lines, outbox and audit for orders without their shipment message."""
    headers = shipinfo_headers(pending, orders, picks, vendors, types)
    details = shipinfo_details(headers, orders, picks, containers)
    profile = AuditProfile(*fixed.LOG_SHIPINFO, columns={"control_number": "order_number"})
    audit = audit_rows(headers, profile, as_of).withColumn(
        "description", text(F.col("description"), F.col("control_number"))
    )
    return ChangeSet(
        inserts={"t_al_host_shipment_master": headers, "t_al_host_shipment_detail": with_id(details, "shipment_detail_id")},
        outbox=outbox_rows(headers, fixed.SEND_PRESHIP),
        audit=audit,
    )


def pending_invoices(ship: DataFrame, user: str = fixed.USER_CUT) -> DataFrame:
    """Invoice messages written by the cut that were not sent yet."""
    waiting = (F.col("user_id") == user) & F.col("pro_number").isNull() & (F.col("transaction_code") == INVOICE)
    return ship.filter(waiting).select("host_group_id", "wh_id", "order_number").distinct()


def flush_invoices(ship: DataFrame, as_of: datetime, user: str = fixed.USER_CUT) -> ChangeSet:
    """Send the pending invoices, log them, flag message and order."""
    pending = pending_invoices(ship, user)
    sent = pending.select("host_group_id").distinct().select(
        "host_group_id", F.lit(INVOICE).alias("transaction_code"), F.lit("P").alias("pro_number")
    )
    flagged = pending.select("order_number").distinct().withColumn("created_nf", F.lit("Y"))
    profile = AuditProfile(
        *fixed.LOG_INVOICE_SENT, columns={"control_number": "order_number", "wh_id": "wh_id"}
    )
    return ChangeSet(
        updates={
            "t_al_host_shipment_master": Update(sent, ("host_group_id", "transaction_code")),
            "t_order": Update(flagged, ("order_number",)),
        },
        outbox=outbox_rows(pending, fixed.SEND_PRESHIP),
        audit=audit_rows(pending, profile, as_of),
    )


Tables = Mapping[str, DataFrame]
Phase = Callable[[Tables], ChangeSet]


@dataclass(frozen=True)
class CutResult:
    """What each phase of the cut changed, and the tables after all of them."""

    phases: dict[str, ChangeSet]
    tables: dict[str, DataFrame]


#: Tables in which the phases of a run leave what later phases of the same run go by.
RUN_ORDERS, RUN_CANCELS = "cut_run_orders", "cut_run_cancels"


def cut_phases(
    as_of: datetime,
    cap: int | None = None,
    storage_type: str = STORAGE,
    descriptions: DataFrame | None = None,
    run: str | None = None,
) -> dict[str, Phase]:
    """The cut from detection to cancel messages, phase by phase. Each reads the tables the last one left, and nothing else,
    so that a run can stop after any of them and go on later (see :mod:`shelfmend.sources.phases`).

    Orders are typed again after the cut, for code, service and trace alike; orders that an earlier run left
    pending are cancelled with them. ``run`` (the moment, if not given) names the run in the tables that carry decisions
    between its phases.
    """
    run = as_of.isoformat() if run is None else run
    name = F.lit(run).alias("run")

    def of_run(tables: Tables, table: str) -> DataFrame:
        return tables[table].filter(F.col("run") == run).drop("run")

    def detect(now: Tables) -> ChangeSet:
        lines = zero_stock_lines(
            now["t_pick_detail"],
            now["t_stored_item"],
            now["t_tran_log"],
            now["t_al_host_shipment_master"],
            now["t_location"],
            now["t_pick_area"],
            now["t_exception_log"],
            storage_type=storage_type,
        )
        return log_cut(pinned(lines), as_of)

    def cut(now: Tables) -> ChangeSet:
        log = now["t_exception_log"]
        sent = now["t_al_host_shipment_master"], now["t_al_host_shipment_detail"]
        classified = pinned(classify_cut(log, now["t_order_detail"], *sent, cap=cap))
        orders = one_type_per_order(classified).select(F.col("control_number").alias("order_number"), "wh_id", name)
        changes = apply_cut(classified, log)
        return replace(changes, inserts={**changes.inserts, RUN_ORDERS: orders})

    def status(now: Tables) -> ChangeSet:
        after = order_status_after_cut(now["t_order_detail"])
        return ChangeSet(updates={"t_order": Update(matching(after, of_run(now, RUN_ORDERS), ["order_number"]), ("order_number",))})

    def invoice(now: Tables) -> ChangeSet:
        headers = pinned(
            invoice_headers(
                now["t_pick_detail"], now["t_stored_item"], now["t_order"], now["t_vendor"], now["v_type"],
                of_run(now, RUN_ORDERS), storage_type,
            )
        )
        details = invoice_details(
            now["t_stored_item"],
            now["t_pick_detail"],
            headers,
            now["t_item_master"],
            now["t_order"],
            now["t_pick_container"],
            now["t_item_uom"],
            now["t_sto_attrib_collection_detail"],
            now["t_attribute_legacy_map"],
            storage_type,
        )
        return ChangeSet(
            inserts={
                "t_al_host_shipment_master": headers,
                "t_al_host_shipment_detail": with_id(details, "shipment_detail_id"),
            }
        )

    def tasks(now: Tables) -> ChangeSet:
        found = closable_tasks(
            now["t_pick_detail"],
            now["t_work_q"],
            now["t_work_q_assignment"],
            now["t_al_host_shipment_master"],
            now["t_al_host_shipment_detail"],
        )
        return close_cut_tasks(pinned(found), as_of)

    def cancel(now: Tables) -> ChangeSet:
        detail = now["t_order_detail"]
        sent = now["t_al_host_shipment_master"], now["t_al_host_shipment_detail"]
        cancels = pinned(pending_cancels(now["t_exception_log"], detail, *sent))
        changes = cancel_interface(cancels, now["t_order"], detail, now["t_item_master"], now["t_item_uom"])
        return replace(changes, inserts={**changes.inserts, RUN_CANCELS: cancels.select("*", name)})

    def trace(now: Tables) -> ChangeSet:
        found = cancel_trace(
            of_run(now, RUN_CANCELS), now["t_order"], now["t_order_detail"], now["t_item_master"], now["t_pick_detail"],
            now["t_tran_log"],
        )
        return log_cancels(pinned(found), as_of, descriptions)

    def send(now: Tables) -> ChangeSet:
        return flush_invoices(now["t_al_host_shipment_master"], as_of)

    steps = (detect, cut, status, invoice, tasks, cancel, trace, send)
    return {step.__name__: step for step in steps}


def cut_cycle(
    tables: dict[str, DataFrame],
    as_of: datetime,
    cap: int | None = None,
    storage_type: str = STORAGE,
    descriptions: DataFrame | None = None,
) -> CutResult:
    """All phases of :func:`cut_phases` on tables in memory.

    What a phase decides is checkpointed once, because several of its changes and the later phases
    read it. Nothing is visible until the caller publishes the tables.
    """
    now = dict(tables)
    phases: dict[str, ChangeSet] = {}
    for name, phase in cut_phases(as_of, cap, storage_type, descriptions).items():
        phases[name] = phase(now)
        now.update(apply_change_set(now, phases[name]))
    return CutResult(phases, now)
