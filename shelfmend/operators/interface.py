"""Interface messages: transfer lines, re-keying, receipts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import guid, text, trouble_status
from ..plans.changeset import ChangeSet, Update, with_id
from ..plans.joins import attach, matching, missing
from ..plans.numbering import number_rows, number_within
from .audit import outbox_rows



def transfer_lines(
    ship_detail: DataFrame,
    ship_header: DataFrame,
    comments: DataFrame,
    loads: DataFrame | None = None,
    order_prefix: str = "900",
) -> DataFrame:
    """Shipment lines of transfer orders that still belong to a group, with the original order."""
    headers = ship_header if loads is None else matching(ship_header, loads, ["load_id"])
    rows = ship_detail.filter(F.col("order_number").startswith(order_prefix) & (F.col("host_group_id") != "0"))
    rows = matching(rows, headers, ["shipment_id"])
    origins = comments.select(
        "order_number", "wh_id", "item_number", "line_number", "br_order_number_orig", "comment_text"
    )
    return attach(rows, origins, ["order_number", "wh_id", "item_number", "line_number"])


def apply_transfer(lines: DataFrame) -> ChangeSet:
    """A new line for the original order; the old line leaves its group, which is kept beside it."""
    kept = [
        c
        for c in (
            "shipment_id", "line_number", "item_number", "quantity_shipped", "hu_id", "delivery_sap", "user_id",
            "wh_id", "client_code", "record_create_date", "tracking_number", "host_group_id",
        )
        if c in lines.columns
    ]
    created = lines.select(
        *kept,
        F.col("br_order_number_orig").alias("order_number"),
        F.lit("T").alias("display_order_number"),
        F.col("comment_text").alias("gen_attribute_value3"),
        F.col("order_number").alias("gen_attribute_value6"),
    )
    zeroed = lines.groupBy("shipment_detail_id").agg(F.max("host_group_id").alias("gen_attribute_value1")).select(
        "shipment_detail_id",
        F.lit("0").alias("host_group_id"),
        "gen_attribute_value1",
        F.lit("CORREÇÃO").alias("gen_attribute_value8"),
    )
    return ChangeSet(
        inserts={"t_al_host_shipment_detail": with_id(created, "shipment_detail_id")},
        updates={"t_al_host_shipment_detail": Update(zeroed, ("shipment_detail_id",))},
    )


def rekey_so_lines(
    ship_messages: DataFrame,
    picks: DataFrame,
    waves: DataFrame | Sequence,
    ticket: str,
    status: str = "EX",
    lot: str = "W",
    line_prefix: str = "40",
) -> DataFrame:
    """Messages of the waves' orders with their new line number and a new group each."""
    if isinstance(waves, DataFrame):
        chosen = matching(picks.select("order_number", "wave_id"), waves, ["wave_id"])
    else:
        chosen = picks.select("order_number", "wave_id").filter(F.col("wave_id").isin(*waves))
    keys = ["host_group_id", "so_line_number", "so_number", "item_number", "wh_id"]
    rows = ship_messages.filter((F.col("status") == status) & (F.col("lot_number") == lot)).select(*keys).distinct()
    return matching(rows, chosen, [("so_number", "order_number")]).select(
        *keys,
        text(F.lit(line_prefix), F.col("so_line_number")).alias("new_so_line_number"),
        F.lit(ticket).alias("asn_line_number"),
        guid(*keys).alias("new_host_group_id"),
    )


def apply_rekey(rows: DataFrame, service: str = fixed.SEND_ORDER_STATUS) -> ChangeSet:
    """Write the new line numbers and groups, and send the groups."""
    keys = ("host_group_id", "so_line_number", "so_number", "item_number", "wh_id")
    into = {"new_so_line_number": "so_line_number", "new_host_group_id": "host_group_id"}
    return ChangeSet(
        updates={"t_al_host_ship_detail": Update(rows, keys, into=into)},
        outbox=outbox_rows(rows, service, "new_host_group_id"),
    )


def record_replies(replies: DataFrame, length: int | None = None) -> ChangeSet:
    """Store each group's reply (host_group_id, reply), or its first ``length`` characters."""
    reply = F.col("reply") if length is None else F.substring("reply", 1, length)
    stored = replies.groupBy("host_group_id").agg(F.max(reply).alias("asn_line_number"))
    return ChangeSet(updates={"t_al_host_ship_detail": Update(stored, ("host_group_id",))})


def restore_so_number(
    ship_messages: DataFrame,
    comments: DataFrame,
    order_prefix: str = "9",
    container_type: str = "A",
    transaction_code: str = "336",
    client_code: str | None = None,
    cap: int | None = None,
) -> DataFrame:
    """Messages whose order number is replaced by the original one; the old one moves to another column."""
    rows = ship_messages.filter(
        F.col("so_number").startswith(order_prefix)
        & (F.col("container_type") == container_type)
        & (F.col("transaction_code") == transaction_code)
    )
    if client_code is not None:
        rows = rows.filter(F.col("client_code") == client_code)
    rows = rows.select("host_ship_detail_id", "so_number", "so_line_number", "wh_id", "item_number", "host_group_id")
    if cap is not None:
        rows = rows.orderBy("host_ship_detail_id").limit(cap)
    origins = comments.select("order_number", "wh_id", "line_number", "item_number", "br_order_number_orig")
    keys = [("so_number", "order_number"), "wh_id", ("so_line_number", "line_number"), "item_number"]
    return attach(rows, origins, keys).select(
        "host_ship_detail_id",
        guid("host_ship_detail_id", "host_group_id").alias("new_host_group_id"),
        F.col("br_order_number_orig").alias("new_so_number"),
        F.lit("T").alias("container_type"),
        F.col("so_number").alias("asn_number"),
    )


def apply_restored_number(rows: DataFrame, service: str = fixed.SEND_ORDER_STATUS) -> ChangeSet:
    """Write the original numbers under new groups, and send them."""
    one = rows.groupBy("host_ship_detail_id").agg(
        F.max("new_host_group_id").alias("host_group_id"),
        F.max("new_so_number").alias("so_number"),
        F.max("container_type").alias("container_type"),
        F.max("asn_number").alias("asn_number"),
    )
    return ChangeSet(
        updates={"t_al_host_ship_detail": Update(one, ("host_ship_detail_id",))},
        outbox=outbox_rows(rows, service, "new_host_group_id"),
    )


def _carrier_text():
    return F.concat_ws("", F.col("document_type").cast("string"), F.lit("-"), F.col("distro_number").cast("string"))


def receipts_from_asn(notices: DataFrame, po: DataFrame, pos: Sequence | None = None) -> DataFrame:
    """Receipt rows of transfer notices, one message group per order."""
    chosen = po if pos is None else po.filter(F.col("po_number").isin(*pos))
    heads = chosen.select("po_number", "vendor_code", "wh_id", "display_po_number", "client_code").distinct()
    own = notices if pos is None else matching(notices, heads, ["display_po_number", "wh_id"])
    lines = own.select(
        "display_po_number", "wh_id", "item_number", "qty", "hu_id", "context", _carrier_text().alias("scac_code")
    ).distinct()
    return attach(lines, heads, ["display_po_number", "wh_id"], "inner").select(
        guid(F.lit(fixed.RECEIPT), "po_number").alias("host_group_id"),
        F.lit(fixed.RECEIPT).alias("transaction_code"),
        F.lit(fixed.USER).alias("user_id"),
        "vendor_code",
        "po_number",
        "item_number",
        F.col("qty").alias("qty_received"),
        "hu_id",
        "wh_id",
        "display_po_number",
        "scac_code",
        trouble_status("context").alias("status"),
        "client_code",
        F.col("context").alias("pack_slip"),
        F.lit("COMPLETE").alias("fork_id"),
    )


def emit_receipts(receipts: DataFrame, service: str = fixed.SEND_RECEIPT, close_po: bool = False) -> ChangeSet:
    """Receipt rows, one outbox message per group and, if asked, the orders closed."""
    updates = {}
    if close_po:
        closed = receipts.select("po_number").distinct().withColumn("status", F.lit("C"))
        updates["t_po_master"] = Update(closed, ("po_number",))
    return ChangeSet(
        inserts={"t_al_host_receipt": receipts}, updates=updates, outbox=outbox_rows(receipts, service)
    )


def close_store_po(
    po: DataFrame,
    worklist: DataFrame,
    po_detail: DataFrame,
    notices: DataFrame,
    receipts: DataFrame,
    type_id: str = "1637",
    per_po: bool = False,
) -> DataFrame:
    """Numbered receipt rows for listed open store orders with new notices and no receipt yet.

    Order lines pair with the notices of the same order and item. Rows are
    numbered over all orders, or within each with ``per_po``; both ways work range by range.
    """
    opened = po.filter((F.col("status") == "O") & (F.col("type_id") == type_id))
    listed = matching(opened, worklist.select(F.col("item_number").alias("listed_po")), [("po_number", "listed_po")])
    fresh = missing(listed, receipts, ["po_number"])
    heads = fresh.select("po_number", "wh_id", "vendor_code", "display_po_number", "client_code")
    new = notices.filter(F.upper("processing_code") == "NEW").select(
        "display_po_number", "wh_id", F.col("item_number").alias("asn_item"), "hu_id", "context",
        _carrier_text().alias("scac_code"),
    )
    noticed = attach(new, heads, ["display_po_number", "wh_id"], "inner")
    lines = po_detail.select("po_number", "wh_id", "item_number", "qty", F.col("item_number").alias("line_item"))
    joined = attach(noticed, lines, ["po_number", "wh_id", ("asn_item", "line_item")], "inner")
    rows = joined.select(
        guid(F.lit(fixed.STORE_RECEIPT), "po_number").alias("host_group_id"),
        F.lit(fixed.STORE_RECEIPT).alias("transaction_code"),
        F.lit(fixed.USER).alias("user_id"),
        "vendor_code",
        "po_number",
        "item_number",
        F.col("qty").alias("qty_received"),
        "hu_id",
        "wh_id",
        "display_po_number",
        "scac_code",
        trouble_status("context").alias("status"),
        "client_code",
        F.lit("BUFFER").alias("pack_slip"),
    )
    inside = ["item_number", "hu_id", "scac_code", "status", "qty_received"]
    if per_po:
        return number_within(rows, ["po_number"], inside, "line_number")
    return number_rows(rows, ["po_number", *inside], "line_number")


def receipts_from_erp(
    po: DataFrame, shipment: DataFrame, shipsku: DataFrame, notices: DataFrame, type_id: str | None = "1763"
) -> DataFrame:
    """Receipt rows of closed orders from the ERP's shipments, numbered within each order.

    A carton with notices of both kinds counts as troubled.
    """
    closed = po.filter(F.col("status") == "C")
    if type_id is not None:
        closed = closed.filter(F.col("type_id") == type_id)
    heads = closed.select("po_number", "wh_id", "vendor_code", "display_po_number", "client_code")
    arrivals = shipment.select("shipment", "bol_no", "to_loc")
    shipped = attach(heads, arrivals, [("display_po_number", "bol_no"), ("wh_id", "to_loc")], "inner")
    scac = F.concat_ws("", F.col("distro_type").cast("string"), F.lit("-"), F.col("distro_no").cast("string"))
    # the cartons meet their order before they are added up, and all notices are judged: each table is shuffled once, and nothing
    # that was joined is joined again to find out what it needs
    cartons = shipsku.select("shipment", "item", "carton", scac.alias("scac_code"), "qty_expected")
    lines = attach(cartons, shipped, ["shipment"], "inner")
    keys = ["vendor_code", "wh_id", "po_number", "item", "display_po_number", "carton", "scac_code", "client_code"]
    summed = lines.groupBy(*keys).agg(F.sum("qty_expected").alias("qty_received"))
    troubled = F.max(trouble_status("context") == "TRBL")
    context = notices.groupBy("hu_id").agg(F.when(troubled, "TRBL").otherwise("ATS").alias("status"))
    judged = attach(summed, context, [("carton", "hu_id")])
    rows = judged.select(
        guid(F.lit(fixed.RECEIPT), "po_number", "wh_id").alias("host_group_id"),
        F.lit(fixed.RECEIPT).alias("transaction_code"),
        F.lit(fixed.USER_ERP_RECEIPT).alias("user_id"),
        "vendor_code",
        "po_number",
        F.col("item").cast("string").alias("item_number"),
        "qty_received",
        F.col("carton").alias("hu_id"),
        "wh_id",
        "display_po_number",
        "scac_code",
        "status",
        "client_code",
    )
    return number_within(rows, ["po_number", "wh_id"], ["item_number", "hu_id", "scac_code"], "line_number")
