"""Stock reconciliation between the warehouse and the ERP balance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.clock import ts
from ..functions.text import guid
from ..plans.changeset import ChangeSet, with_id
from ..plans.joins import attach, matching
from .audit import AuditProfile, audit_rows, outbox_rows
from .moves import upsert_increment

LOC_OFFSET = 500  # ERP location = warehouse number + 500


def _erp_by_warehouse(erp: DataFrame, offset: int) -> DataFrame:
    """ERP balances keyed by item and warehouse, so that the join needs no arithmetic."""
    kind = dict(erp.dtypes)["loc"]
    warehouse = F.col("loc") - offset if kind != "string" else (F.col("loc").cast("bigint") - offset).cast("string")
    return erp.withColumn("erp_wh_id", warehouse)


def _stock_totals(stock: DataFrame, *extra: Column) -> DataFrame:
    return stock.groupBy("item_number", "wh_id").agg(
        F.sum("actual_qty").alias("wms_total"),
        F.sum("unavailable_qty").alias("wms_blocked"),
        *extra,
    )


def _listed(erp: DataFrame, worklist: DataFrame, offset: int) -> DataFrame:
    """ERP rows of the listed items; an item listed twice counts once."""
    keyed = _erp_by_warehouse(erp, offset)
    return matching(keyed, worklist, [("item", "item_number"), ("erp_wh_id", "wh_id")], one_row_per_key=True)


def reconcile_blocked(
    erp: DataFrame, worklist: DataFrame, stock: DataFrame, loc_offset: int = LOC_OFFSET, loc: str | None = None
) -> DataFrame:
    """Blocked quantity of the ERP minus that of the warehouse, per listed item.

    A surplus in the ERP releases stock (code 750), a deficit blocks it (700); equal rows drop out.
    With ``loc`` all listed items are compared with that one ERP location.
    """
    if loc is None:
        base = _listed(erp, worklist, loc_offset).withColumnRenamed("erp_wh_id", "wh_id")
    else:
        keys = worklist.select("item_number", "wh_id").distinct()
        base = attach(erp.filter(F.col("loc") == loc), keys, [("item", "item_number")], "inner")
    joined = attach(base, _stock_totals(stock), [("item", "item_number"), "wh_id"], one_row_per_key=loc is None)
    diff = F.col("non_sellable_qty") - F.coalesce("wms_blocked", F.lit(0))
    compared = joined.select(
        "item",
        "wh_id",
        "loc",
        F.col("stock_on_hand").alias("sum_soh"),
        F.col("wms_total").alias("sum_wms"),
        F.col("non_sellable_qty").alias("sum_non"),
        F.coalesce("wms_blocked", F.lit(0)).alias("sum_wms_una"),
        diff.alias("diff"),
    ).filter(F.col("diff") != 0)
    up = F.col("diff") > 0
    return compared.select(
        "item",
        "wh_id",
        F.when(up, fixed.RELEASE).otherwise(fixed.BLOCK).alias("transaction_code"),
        "loc",
        "sum_soh",
        "sum_wms",
        "sum_non",
        "sum_wms_una",
        F.abs("diff").alias("dif_erp_wms"),
        F.when(up, "HOLD").otherwise("AVAILABLE").alias("inventory_status_before"),
        F.when(up, "AVAILABLE").otherwise("HOLD").alias("inventory_status_after"),
    )


def reconcile_totals(
    erp: DataFrame, worklist: DataFrame, stock: DataFrame, dest_loc: str, loc_offset: int = LOC_OFFSET
) -> DataFrame:
    """Total, available and blocked gaps of the items for which the ERP has more than the warehouse."""
    base = _listed(erp, worklist, loc_offset).withColumnRenamed("erp_wh_id", "wh_id")
    at_dest = F.count(F.when(F.col("location_id") == dest_loc, 1)).alias("dest_rows")
    joined = attach(base, _stock_totals(stock, at_dest), [("item", "item_number"), "wh_id"], one_row_per_key=True)
    erp_total, erp_blocked = F.col("stock_on_hand"), F.col("non_sellable_qty")
    wms_total = F.coalesce("wms_total", F.lit(0))
    wms_blocked = F.coalesce("wms_blocked", F.lit(0))
    free_gap = (wms_total - wms_blocked) - (erp_total - erp_blocked)
    return joined.filter(erp_total > wms_total).select(
        "item",
        "wh_id",
        F.coalesce("dest_rows", F.lit(0)).alias("sto_count"),
        F.when(erp_total > wms_total, "INC_HJ")
        .when(wms_total > erp_total, "DEC_HJ")
        .otherwise("EQUALIZADO")
        .alias("status"),
        F.abs(erp_total - wms_total).alias("dif_erp_wms"),
        F.abs(free_gap).alias("available_gap"),
        F.abs(wms_blocked - erp_blocked).alias("blocked_gap"),
        F.when(wms_blocked > erp_blocked, "DEC_RMS_IND")
        .when(wms_blocked == erp_blocked, "EQUALIZADO")
        .when(erp_blocked > wms_blocked, "INC_HJ_IND")
        .alias("blocked_status"),
    )


def _phantom(erp: DataFrame, stock: DataFrame, locs: Sequence | None, offset: int) -> DataFrame:
    """ERP rows without on-hand and in-transit quantity whose warehouse stock adds up to nothing.

    Stock rows with only NULL quantities count as no stock, so this is not a plain anti-join.
    """
    rows = erp if locs is None else erp.filter(F.col("loc").isin(*locs))
    idle = rows.filter((F.col("stock_on_hand") == 0) & (F.col("in_transit_qty") == 0))
    held = stock.groupBy("item_number", "wh_id").agg(F.sum("actual_qty").alias("sto_qty"))
    keyed = _erp_by_warehouse(idle, offset)
    joined = attach(keyed, held, [("item", "item_number"), ("erp_wh_id", "wh_id")], one_row_per_key=True)
    return joined.filter(F.col("sto_qty").isNull())


def phantom_negative(
    erp: DataFrame, stock: DataFrame, as_of: datetime, locs: Sequence | None = None, loc_offset: int = LOC_OFFSET
) -> DataFrame:
    """Negative blocked balance with no stock behind it: quantity to take back."""
    negative = erp.filter(F.col("non_sellable_qty") < 0)
    return _phantom(negative, stock, locs, loc_offset).select(
        F.col("item").alias("item_number"),
        F.col("erp_wh_id").alias("wh_id"),
        (-F.col("non_sellable_qty")).alias("qty"),
        F.lit(as_of.strftime("%d%m%Y")).alias("po"),
    )


def phantom_positive(
    erp: DataFrame,
    stock: DataFrame,
    as_of: datetime,
    locs: Sequence | None = None,
    cap: int | None = None,
    loc_offset: int = LOC_OFFSET,
) -> DataFrame:
    """Positive blocked balance with no stock and no reservation behind it; ``cap`` limits one run."""
    positive = erp.filter((F.col("non_sellable_qty") > 0) & (F.col("tsf_reserved_qty") == 0))
    found = _phantom(positive, stock, locs, loc_offset).select(
        F.col("item").alias("item_number"),
        F.col("erp_wh_id").alias("wh_id"),
        F.col("non_sellable_qty").alias("qty"),
        F.lit(as_of.strftime("%d%m%Y")).alias("po"),
    )
    return found if cap is None else found.orderBy("item_number", "wh_id").limit(cap)


def double_sent(
    adjustments: DataFrame,
    erp: DataFrame,
    code: str = fixed.ADJUST,
    matched_only: bool = True,
    loc_offset: int = LOC_OFFSET,
) -> DataFrame:
    """Items whose adjustments were sent by more than one user under the same reference.

    ``OK`` if half of what was sent equals the negative blocked balance.
    """
    sent = (
        adjustments.filter(F.col("transaction_code") == code)
        .groupBy("item_number", "reference_code", "wh_id")
        .agg(F.sum("quantity_change").alias("qty"), F.countDistinct("user_id").alias("users"))
        .filter(F.col("users") > 1)
    )
    per_item = sent.groupBy("wh_id", "item_number").agg(F.sum("qty").alias("qty_sent"))
    blocked = _erp_by_warehouse(erp.filter(F.col("non_sellable_qty") < 0), loc_offset).select(
        "item", "erp_wh_id", "non_sellable_qty"
    )
    joined = attach(
        per_item, blocked, [("item_number", "item"), ("wh_id", "erp_wh_id")], "inner", one_row_per_key=True
    )
    half = F.col("qty_sent") / 2
    out = joined.select(
        "wh_id",
        "item_number",
        F.col("non_sellable_qty").alias("qty_non_sellable"),
        "qty_sent",
        half.alias("qtd_a"),
        (-F.col("non_sellable_qty")).alias("qtd_b"),
        F.when(half == -F.col("non_sellable_qty"), "OK").alias("status"),
    )
    return out.filter(F.col("status") == "OK") if matched_only else out


def releasable_qty(
    worklist: DataFrame,
    erp: DataFrame,
    stock: DataFrame,
    po_unavailable: DataFrame,
    excluded_locations: Sequence[str] = ("RETENCAO",),
    loc_offset: int = LOC_OFFSET,
    strict: bool = False,
) -> DataFrame:
    """Quantity that can be released per listed item, by the first rule that applies.

    By default every source is summed on its own. ``strict`` gives the totals of joining first and
    summing afterwards, where stock is counted once per open order row and the reverse; the totals
    follow from the row counts, no row is multiplied.
    """
    usable = stock.filter((F.col("type") == "STORAGE") & ~F.col("location_id").isin(*excluded_locations))
    wms = usable.groupBy("item_number", "wh_id").agg(
        F.sum("actual_qty").alias("wms"), F.count(F.lit(1)).alias("stock_rows")
    )
    ordered = (
        po_unavailable.filter(F.col("status") == "O")
        .groupBy("item_number", "wh_id")
        .agg(F.sum("qty_unavailable").alias("po"), F.count(F.lit(1)).alias("po_rows"))
    )
    listed = worklist.groupBy("item_number", "wh_id").agg(F.count(F.lit(1)).alias("list_rows"))
    balances = _erp_by_warehouse(erp, loc_offset).select("item", "erp_wh_id", "stock_on_hand", "non_sellable_qty")
    key = ["item_number", "wh_id"]
    joined = attach(
        listed, balances, [("item_number", "item"), ("wh_id", "erp_wh_id")], "inner", one_row_per_key=True
    )
    joined = attach(joined, wms, key, "inner", one_row_per_key=True)
    joined = attach(joined, ordered, key, one_row_per_key=True)
    if strict:
        joined = joined.withColumn("wms", F.col("wms") * F.col("list_rows") * F.coalesce("po_rows", F.lit(1)))
        joined = joined.withColumn("po", F.col("po") * F.col("list_rows") * F.col("stock_rows"))
    soh, non, wms_qty = F.col("stock_on_hand"), F.col("non_sellable_qty"), F.col("wms")
    po, free = F.coalesce("po", F.lit(0)), soh - non
    ladder = (
        F.when(free < 0, (non - soh) + (wms_qty + po))
        .when(soh == 0, 0)
        .when((soh > 0) & (soh == wms_qty) & (non == wms_qty), wms_qty)
        .when(wms_qty > soh, non)
        .when((soh > wms_qty) & (free < wms_qty), wms_qty - free)
        .when((soh == wms_qty) & (free < wms_qty), non)
        .when((soh == wms_qty) & (free == wms_qty), 0)
        .when(free == wms_qty, 0)
        .when(free > wms_qty, 0)
        .otherwise(0.5)
    )
    return joined.select("item_number", "wh_id", ladder.alias("qty")).filter(F.col("qty") > 0)


def manual_feed(worklist: DataFrame, items: DataFrame, direction: str = "block") -> DataFrame:
    """Worklist quantities with the item's client: ``release`` keeps positive ones, ``block`` all."""
    owners = items.groupBy("item_number", "wh_id").agg(F.max("client_code").alias("client_code"))
    if direction == "release":
        wanted = worklist.filter(F.col("qty") > 0)
        return attach(wanted, owners, ["item_number", "wh_id"]).select("item_number", "wh_id", "qty", "client_code")
    return attach(worklist, owners, ["item_number", "wh_id"]).select(
        "item_number",
        "wh_id",
        "qty",
        F.lit(fixed.BLOCK).alias("transaction_code"),
        F.lit("AVAILABLE").alias("inventory_status_before"),
        F.lit("HOLD").alias("inventory_status_after"),
        "client_code",
    )


@dataclass(frozen=True)
class AdjustmentProfile:
    """Constant part of an adjustment message. ``code``/``client`` of None are read from the
    candidate row; ``as_change`` puts the quantity into the change column instead of before/after."""

    user: str
    from_location: str
    to_location: str
    code: str | None = fixed.ADJUST
    client: str | None = "001"
    reason: str | None = None
    reference: str | None = None
    uom: str | None = None
    as_change: bool = True
    per_row: bool = True
    service: str = fixed.SEND_ADJUSTMENT
    audit: AuditProfile | None = None


def _equalising_audit(control_2: str) -> AuditProfile:
    return AuditProfile(
        *fixed.LOG_EQUALISE,
        fixed.USER_EQUALISE,
        {
            "control_number": "po", "control_number_2": F.lit(control_2), "wh_id": "wh_id", "num_items": "qty",
            "item_number": "item_number", "tran_qty": "qty", "elapsed_time": F.lit(10),
        },
    )


def _release_audit(user: str) -> AuditProfile:
    return AuditProfile(
        *fixed.LOG_RELEASE,
        user,
        {
            "control_number": F.lit("Equalização"), "control_number_2": F.lit("Disponi. Auto"), "wh_id": "wh_id",
            "num_items": "qty", "item_number": "item_number", "tran_qty": "qty", "elapsed_time": F.lit(10),
        },
    )


def blocked_profile(ticket: str, location: str) -> AdjustmentProfile:
    """Output of :func:`reconcile_blocked`, one message for the whole batch."""
    return AdjustmentProfile(
        ticket, location, location, code=None, reason="42", uom="EA", as_change=False, per_row=False
    )


def manual_block_profile(user: str, location: str) -> AdjustmentProfile:
    """Output of :func:`manual_feed` for blocking, with each item's own client."""
    return AdjustmentProfile(
        user, location, location, code=None, client=None, reason="42", uom="EA", as_change=False, per_row=False
    )


def double_sent_profile() -> AdjustmentProfile:
    """Output of :func:`double_sent` with ``qtd_a`` as ``qty``."""
    return AdjustmentProfile(fixed.USER_EQUALISE, "ATS", "TRBL", reference="500")


def phantom_negative_profile() -> AdjustmentProfile:
    """Output of :func:`phantom_negative`."""
    audit = _equalising_audit("Equalização Saldo Indisp.")
    return AdjustmentProfile(fixed.USER_EQUALISE, "ATS", "TRBL", reason="6", reference="po", audit=audit)


def phantom_positive_profile() -> AdjustmentProfile:
    """Output of :func:`phantom_positive`."""
    audit = _equalising_audit("Bloqueado > 0")
    return AdjustmentProfile(fixed.USER_EQUALISE, "TRBL", "ATS", reference="po", audit=audit)


def releasable_profile() -> AdjustmentProfile:
    """Output of :func:`releasable_qty`."""
    user = fixed.USER_RELEASE
    return AdjustmentProfile(user, "TRBL", "ATS", reason="6", audit=_release_audit(user))


def manual_release_profile() -> AdjustmentProfile:
    """Output of :func:`manual_feed` for releasing."""
    user = fixed.USER_MANUAL_RELEASE
    return AdjustmentProfile(user, "TRBL", "ATS", client=None, reason="6", audit=_release_audit(user))


def emit_adjustments(candidates: DataFrame, profile: AdjustmentProfile, as_of: datetime) -> ChangeSet:
    """Adjustment messages, outbox and audit rows for candidates with item_number, wh_id and qty."""
    present = set(candidates.columns)

    def field(name: str, fixed: str | None):
        value = F.lit(fixed) if fixed is not None else (F.col(name) if name in present else F.lit(None))
        return value.cast("string").alias(name)

    stamp = F.lit(as_of.isoformat())
    per_row = ("wh_id", "item_number") if profile.per_row else ()
    group = guid(F.lit(profile.user), stamp, *per_row)
    zero = F.lit(0.0)
    qty = F.col("qty").cast("double")
    reference = F.col("po") if profile.reference == "po" else F.lit(profile.reference)
    client = F.lit(profile.client) if profile.client is not None else F.col("client_code")
    messages = candidates.select(
        group.alias("host_group_id"),
        field("transaction_code", profile.code),
        F.col("item_number").cast("string").alias("item_number"),
        (zero if profile.as_change else qty).alias("quantity_before"),
        (zero if profile.as_change else qty).alias("quantity_after"),
        (qty if profile.as_change else zero).alias("quantity_change"),
        field("inventory_status_before", None),
        field("inventory_status_after", None),
        F.lit(profile.reason).cast("string").alias("reason_code"),
        F.lit(profile.from_location).alias("from_location_id"),
        F.lit(profile.to_location).alias("to_location_id"),
        F.lit(profile.user).alias("user_id"),
        F.col("wh_id").cast("string").alias("wh_id"),
        ts(as_of).alias("record_create_date"),
        F.lit(profile.uom).cast("string").alias("uom"),
        reference.cast("string").alias("reference_code"),
        (F.lit(None) if profile.as_change else F.col("item_number")).cast("string").alias("display_item_number"),
        client.cast("string").alias("client_code"),
    )
    audit = audit_rows(candidates, profile.audit, as_of) if profile.audit is not None else None
    return ChangeSet(
        inserts={"t_al_host_inventory_adjustment": with_id(messages, "adjustment_id")},
        outbox=outbox_rows(messages, profile.service),
        audit=audit,
    )


def equalise_totals(gaps: DataFrame, stock: DataFrame, dest_loc: str, ticket: str, as_of: datetime) -> ChangeSet:
    """Repair for :func:`reconcile_totals`: raise the warehouse stock at the destination and, where
    the blocked quantities differ too, tell the ERP to hold (700) or release (750) the gap.

    A gap whose blocked quantity is unknown raises nothing; it is only logged."""
    rows = gaps.withColumnRenamed("item", "item_number")
    judged = rows.filter(F.col("blocked_status").isin("DEC_RMS_IND", "EQUALIZADO", "INC_HJ_IND"))
    raised = upsert_increment(
        stock,
        judged.select("item_number", "wh_id", F.lit(dest_loc).alias("location_id"), F.col("dif_erp_wms").alias("qty")),
        as_of,
        row_type="0",
    )
    differing = rows.filter(F.col("blocked_status").isin("INC_HJ_IND", "DEC_RMS_IND"))
    up = F.col("blocked_status") == "INC_HJ_IND"
    candidates = differing.select(
        "item_number",
        "wh_id",
        F.col("blocked_gap").alias("qty"),
        F.when(up, fixed.RELEASE).otherwise(fixed.BLOCK).alias("transaction_code"),
        F.when(up, "HOLD").otherwise("AVAILABLE").alias("inventory_status_before"),
        F.when(up, "AVAILABLE").otherwise("HOLD").alias("inventory_status_after"),
    )
    profile = AdjustmentProfile(
        ticket, dest_loc, dest_loc, code=None, reason="42", uom="EA", as_change=False, per_row=False
    )
    sent = emit_adjustments(candidates, profile, as_of)
    audit = audit_rows(
        rows,
        AuditProfile(
            *fixed.LOG_INCREMENT,
            columns={
                "control_number": F.lit(ticket), "location_id_2": F.lit(dest_loc), "item_number": "item_number",
                "tran_qty": "dif_erp_wms", "wh_id": "wh_id",
            },
        ),
        as_of,
    )
    return ChangeSet(
        inserts={**raised.inserts, **sent.inserts}, updates=raised.updates, outbox=sent.outbox, audit=audit
    )
