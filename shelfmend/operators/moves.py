"""Stock moves, upserts and merges. Quantities are added up per key before any join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.clock import ts
from ..functions.text import new_id
from ..plans.changeset import ChangeSet, Delete, Update, with_id
from ..plans.joins import attach, matching, missing
from ..plans.numbering import number_rows, number_within, pinned, pins, running_low, unpinned
from .audit import AuditProfile, audit_rows

PLACE = ("wh_id", "item_number", "location_id", "hu_id")
SPOT = ("item_number", "wh_id", "location_id")
ROW = ("sequence", *SPOT)  # a stock row: rows written by other jobs may share a sequence


def move_stock(stock: DataFrame, moves: DataFrame) -> DataFrame:
    """Balances per warehouse, item, location and handling unit after the moves.

    ``moves`` has wh_id, item_number, qty, from_location, from_hu, to_location and to_hu. The source
    loses the quantity, the destination gains it, and a balance of zero disappears. This is our own
    definition of a move; the total never changes.
    """
    qty = F.col("qty")
    out = moves.select(
        "wh_id", "item_number", F.col("from_location").alias("location_id"), F.col("from_hu").alias("hu_id"),
        (-qty).alias("qty"),
    )
    into = moves.select(
        "wh_id", "item_number", F.col("to_location").alias("location_id"), F.col("to_hu").alias("hu_id"), "qty"
    )
    held = stock.select(*PLACE, F.col("actual_qty").alias("qty"))
    signed = held.unionByName(out).unionByName(into)
    return signed.groupBy(*PLACE).agg(F.sum("qty").alias("actual_qty")).filter(F.col("actual_qty") != 0)


@dataclass(frozen=True)
class Moved:
    """``balances`` after the moves, and the ``moves`` with what was moved (``moved_qty``) and what was not (``refused_qty``)."""

    balances: DataFrame
    moves: DataFrame

    @property
    def refused(self) -> DataFrame:
        """Moves that the source could not give in full."""
        return self.moves.filter(F.col("refused_qty") > 0)


def _place(columns: Sequence[str | Column]) -> Column:
    """One short key for a place; a NULL in it is a value of its own."""
    named = [(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(columns, "wilh", strict=True)]
    return F.to_json(F.struct(*named))


def move_within_stock(stock: DataFrame, moves: DataFrame, order_by: Sequence[str | Column]) -> Moved:
    """The moves one after the other, each as far as its source holds the quantity at that moment.

    ``moves`` is as for :func:`move_stock`; rows that ``order_by`` leaves equal come in order of their other columns. A move can
    give on what earlier ones brought. What its source lacks is refused; a NULL or negative quantity counts as none. No
    place falls below zero by a move (one that was below gives only what arrives), and the total never changes.

    All sources are handled at once. A source's departures and arrivals in order make a running total; what has been
    refused so far is how far the total would have fallen below zero at its lowest. What arrives depends on what was refused
    elsewhere, so this is repeated until nothing changes: once for each link of the longest chain of moves that
    pass on a shortage, and once in all where no source is a destination. A move stays within its warehouse and item,
    so a round takes only the warehouses and items for which the round before changed something.
    """
    with pins() as made:
        result = pinned(_allocated(stock, moves, order_by))
    unpinned(stock.sparkSession, made[:-1])  # what the result was worked out from
    real = result.filter(F.col("moved_qty") > 0).withColumn("qty", F.col("moved_qty"))
    return Moved(move_stock(stock, real), result)


def _allocated(stock: DataFrame, moves: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """The moves with what was moved and what was refused. What a round reads goes as soon as the next one's tables are written."""
    spark, columns = stock.sparkSession, moves.columns
    kind = dict(moves.dtypes)["qty"]
    none = F.lit(0).cast(kind)
    asked = moves.withColumn("_asked", F.greatest(F.coalesce("qty", F.lit(0)), F.lit(0)).cast(kind))
    todo = number_rows(asked, [*order_by, *columns], "_move")
    # items that share a hash are only repeated together
    group = F.xxhash64("wh_id", "item_number").alias("_group")
    source = _place(["wh_id", "item_number", "from_location", "from_hu"]).alias("_source")
    target = _place(["wh_id", "item_number", "to_location", "to_hu"]).alias("_target")
    placed = todo.select("_move", group, source, target, "_asked", F.col("_asked").alias("_given"))
    sources = placed.select(F.col("_source").alias("_place")).distinct()
    held = stock.groupBy(*PLACE).agg(F.sum("actual_qty").alias("_held")).filter(F.col("_held") > 0)
    opening = matching(held.select(_place(PLACE).alias("_place"), group, F.col("_held").cast(kind).alias("_held")), sources, ["_place"])
    # a target that gives nothing on takes no part
    passed_on = sources.select(F.col("_place").alias("_target"), F.lit(True).alias("_feeds"))
    given = attach(placed, passed_on, ["_target"]).withColumn("_target", F.when(F.col("_feeds"), F.col("_target"))).drop("_feeds")
    with pins() as last:
        opening, given = pinned(opening), pinned(given)
    chained = not given.filter(F.col("_target").isNotNull()).isEmpty()
    blank = [F.lit(None).cast(given.schema[c].dataType).alias(c) for c in ("_group", "_target", "_given")]
    settled = []
    while True:
        # _move, _step: what is held comes before all moves, a departure before the arrival of the same move
        events = opening.select("_place", F.lit(0).cast("long").alias("_move"), F.lit(0).alias("_step"), F.col("_held").alias("_value"), *blank).unionByName(
            given.select(F.col("_source").alias("_place"), "_move", F.lit(1).alias("_step"), (-F.col("_asked")).cast(kind).alias("_value"), "_group", "_target", "_given")
        )
        if chained:
            arrivals = given.filter(F.col("_target").isNotNull())
            events = events.unionByName(arrivals.select(F.col("_target").alias("_place"), "_move", F.lit(2).alias("_step"), F.col("_given").alias("_value"), *blank))
        with pins() as ranges:
            totals = running_low(events, ["_place"], ["_move", "_step"], "_value", "_total", "_low")
        lacked = F.greatest(none, -F.col("_total")) - F.greatest(none, -F.col("_low"))
        refused = F.greatest(none, lacked)
        after = totals.filter(F.col("_step") == 1).select(
            "_move", "_group", F.col("_place").alias("_source"), "_target", (-F.col("_value")).cast(kind).alias("_asked"),
            (-F.col("_value") - refused).cast(kind).alias("_given"), F.col("_given").alias("_before"),
        )
        with pins() as made:
            after = pinned(after)
        unpinned(spark, ranges)
        changed = after.filter((F.col("_given") != F.col("_before")) & F.col("_target").isNotNull()).select("_group").distinct()
        after = after.drop("_before")
        if chained:
            with pins() as few:
                changed = pinned(changed)
        if not chained or changed.isEmpty():
            settled.append(after.select("_move", "_given"))
            break
        settled.append(pinned(missing(after, changed, ["_group"]).select("_move", "_given")))
        with pins() as kept:
            given = pinned(matching(after, changed, ["_group"]))
            opening = pinned(matching(opening, changed, ["_group"]))
        unpinned(spark, [*last, *made, *few])  # the next round reads nothing else
        last = kept
    done = attach(todo, reduce(DataFrame.unionByName, settled), ["_move"], one_row_per_key=True)
    return done.select(*columns, F.col("_given").alias("moved_qty"), (F.col("_asked") - F.col("_given")).cast(kind).alias("refused_qty"))


def upsert_plan(stock: DataFrame, deltas: DataFrame) -> DataFrame:
    """Summed quantity per item, warehouse and location, and the stock row there that takes it.

    That is the row with the lowest key of its own at the place (``kept_sequence``); without one the quantity becomes a new row.
    """
    wanted = deltas.groupBy(*SPOT).agg(F.sum("qty").alias("qty"))
    # few places get a quantity: the other stock drops out before anything is counted
    here = matching(stock.select(*ROW), wanted, list(SPOT))
    keys = here.groupBy(*SPOT, "sequence").agg(F.count(F.lit(1)).alias("_n"))
    own = F.when(F.col("_n") == 1, F.col("sequence"))
    present = keys.groupBy(*SPOT).agg(F.sum("_n").alias("rows_present"), F.min(own).alias("kept_sequence"))
    joined = attach(wanted, present, list(SPOT), one_row_per_key=True)
    return joined.withColumn("action", F.when(F.col("kept_sequence").isNull(), "INSERT").otherwise("UPDATE"))


def _new_stock(rows: DataFrame, stock: DataFrame, as_of: datetime, row_type: str) -> DataFrame:
    """One new row for each place, under a key of its own."""
    key = new_id(dict(stock.dtypes).get("sequence", "string"), *SPOT, F.lit(row_type), F.lit(as_of.isoformat()))
    return rows.select(
        key.alias("sequence"),
        "item_number",
        F.col("qty").alias("actual_qty"),
        F.lit(0.0).alias("unavailable_qty"),
        F.lit("A").alias("status"),
        "wh_id",
        "location_id",
        ts(as_of).alias("fifo_date"),
        F.lit(row_type).alias("type"),
    )


def upsert_increment(
    stock: DataFrame,
    deltas: DataFrame,
    as_of: datetime,
    row_type: str,
    profile: AuditProfile | None = None,
    refresh: bool = False,
    strict: bool = False,
) -> ChangeSet:
    """Add quantities at a location: to one stock row there, or as a new row of ``row_type`` if there is none, so that the
    total rises by just these quantities. ``strict`` adds them to every stock row of the place. With ``refresh``
    increased rows also get the moment as their FIFO date."""
    plan = pinned(upsert_plan(stock, deltas))  # read for the rows raised, the rows made and the log
    present = F.col("rows_present").isNotNull() if strict else F.col("action") == "UPDATE"
    dated = [ts(as_of).alias("fifo_date")] if refresh and "fifo_date" in stock.columns else []
    key = [] if strict else [F.col("kept_sequence").alias("sequence")]
    added = plan.filter(present).select(*key, *SPOT, F.col("qty").alias("actual_qty"), *dated)
    created = _new_stock(plan.filter(~present), stock, as_of, row_type)
    return ChangeSet(
        inserts={"t_stored_item": created},
        updates={"t_stored_item": Update(added, SPOT if strict else ROW, add=("actual_qty",))},
        audit=audit_rows(plan, profile, as_of) if profile is not None else None,
    )


def return_stock(stock: DataFrame, deltas: DataFrame, control: str, as_of: datetime) -> ChangeSet:
    """Stock of cancelled invoices back at a location, as free stock; each item is logged, with a text of its own if
    it was added to stock that was there."""
    raised = upsert_increment(stock, deltas, as_of, row_type="0")
    plan = upsert_plan(stock, deltas)
    columns = {
        "control_number": F.lit(control), "location_id": "location_id", "location_id_2": "location_id",
        "item_number": "item_number", "tran_qty": "qty", "wh_id": "wh_id",
    }
    created, added = (
        audit_rows(plan.filter(F.col("action") == action), AuditProfile(*log, columns=columns), as_of)
        for action, log in (("INSERT", fixed.LOG_STOCK_BACK), ("UPDATE", fixed.LOG_STOCK_BACK_ADDED))
    )
    return replace(raised, audit=created.unionByName(added))


def load_quantity(ship_header: DataFrame, ship_detail: DataFrame, loads: DataFrame | None = None) -> DataFrame:
    """Shipped quantity per item of each load. ``loads`` limits it to given load ids."""
    headers = ship_header.select("shipment_id", "load_id", "wh_id")
    if loads is not None:
        headers = matching(headers, loads, ["load_id"])
        # only the lines of the given loads are added up
        ship_detail = matching(ship_detail.select("shipment_id", "item_number", "quantity_shipped"), headers, ["shipment_id"])
    # lines are added up per shipment first: a large shipment is one row per item in the join
    lines = ship_detail.groupBy("shipment_id", "item_number").agg(F.sum("quantity_shipped").alias("qty"))
    joined = attach(lines, headers, ["shipment_id"], "inner")
    return joined.groupBy("load_id", "wh_id", "item_number").agg(F.sum("qty").alias("qty"))


def claim_po_stock(
    po: DataFrame,
    po_detail: DataFrame,
    lookup: DataFrame,
    client_control: DataFrame,
    claim_type: str = "1767",
    po_types: Sequence[str] = ("1767", "1766"),
    clients: Sequence | None = None,
) -> DataFrame:
    """Quantity per item of the open claim orders, and where the client wants it put away.

    Orders of ``claim_type`` go to the client's LOC_RECEB_SI location, the others to LOC_RECEB_IA.
    """
    opened = po.filter((F.col("status") == "O") & F.col("type_id").isin(*po_types))
    if clients is not None:
        opened = opened.filter(F.col("client_code").isin(*clients))
    typed = matching(opened, lookup.filter(F.col("lookup_type") == "TYPE"), [("type_id", "lookup_id")])
    # few orders are open claims: their lines alone are added up
    own = matching(po_detail.select("po_number", "wh_id", "item_number", "qty"), typed, ["po_number", "wh_id"])
    lines = own.groupBy("po_number", "wh_id", "item_number").agg(F.sum("qty").alias("qty"))

    def target(kind: str) -> Column:
        return F.max(F.when(F.col("control_type") == kind, F.col("c1")))

    places = client_control.groupBy("wh_id", "client_code").agg(
        target(fixed.LOC_CLAIM).alias("loc_si"), target(fixed.LOC_SETTLEMENT).alias("loc_ia")
    )
    heads = typed.select("po_number", "wh_id", "display_po_number", "client_code", "type_id")
    # the order gets its place before it meets its lines, which are many more
    heads = attach(heads, places, ["wh_id", "client_code"])
    return attach(lines, heads, ["po_number", "wh_id"], "inner").select(
        "po_number",
        "display_po_number",
        "wh_id",
        "client_code",
        "item_number",
        "qty",
        F.when(F.col("type_id") == claim_type, F.col("loc_si")).otherwise(F.col("loc_ia")).alias("location_id"),
    )


def receive_claims(
    claims: DataFrame, stock: DataFrame, as_of: datetime, descriptions: DataFrame | None = None
) -> ChangeSet:
    """Put claim stock away, close its orders and log each item."""
    claims = pinned(claims)  # read for the stock, the orders and the log
    placed = claims.filter(F.col("location_id").isNotNull())
    raised = upsert_increment(stock, placed.select(*SPOT, "qty"), as_of, row_type="STORAGE", refresh=True)
    closed = claims.select("po_number", "wh_id").distinct().withColumn("status", F.lit("C"))
    profile = AuditProfile(
        *fixed.LOG_CLAIM_STOCK,
        columns={
            "control_number": "po_number", "control_number_2": "display_po_number", "wh_id": "wh_id",
            "location_id": "location_id", "location_id_2": "location_id", "num_items": F.lit(0),
            "item_number": "item_number", "tran_qty": "qty",
        },
        split_clock=True,
    )
    return ChangeSet(
        inserts=raised.inserts,
        updates={**raised.updates, "t_po_master": Update(closed, ("po_number", "wh_id"))},
        audit=audit_rows(claims, profile, as_of, descriptions),
    )


def _whole_units(sizes: DataFrame) -> DataFrame:
    """``item_number, wh_id, size, take``: how many units of each size fit into the plan, taken from the largest size down.

    ``sizes`` has one row per item, warehouse, ``planned`` quantity and size (``qty``), with the number ``n`` of units. An item's
    sizes are one array: as many entries as sizes, not units.
    """
    kinds = dict(sizes.dtypes)
    falling = F.sort_array(F.collect_list(F.struct("qty", "n")), asc=False).alias("_sizes")
    lists = sizes.groupBy("item_number", "wh_id").agg(F.max("planned").alias("planned"), falling)
    none = F.array().cast(f"array<struct<size:{kinds['qty']},take:bigint>>")

    def step(so_far: Column, size: Column) -> Column:
        rest, taken = so_far["rest"], so_far["taken"]
        fit = F.least(size["n"], F.floor(rest / size["qty"]).cast("bigint"))
        more = F.array_append(taken, F.struct(size["qty"].alias("size"), fit.alias("take")))
        return F.struct(
            (rest - fit * size["qty"]).cast(kinds["planned"]).alias("rest"), F.when(fit > 0, more).otherwise(taken).alias("taken")
        )

    start = F.struct(F.col("planned").alias("rest"), none.alias("taken"))
    folded = lists.withColumn("_taken", F.aggregate("_sizes", start, step, lambda end: end["taken"]))
    return folded.select("item_number", "wh_id", F.inline("_taken"))


def move_fitting(
    plans: DataFrame, stock: DataFrame, source: str | None, destination: str, strict: bool = False
) -> DataFrame:
    """Stock rows to move to the settlement location, within the planned quantity.

    ``plans`` is the exception log of planned moves (item_number, wh_id, quantity). By default the largest row that fits into
    what is left of the plan is taken, again and again; of equal rows the lowest sequence. With ``strict`` every row no
    larger than the whole plan moves, even past the plan. ``source`` None takes every location but the destination.
    """
    planned = plans.filter(F.col("status").isNull()).groupBy("item_number", "wh_id").agg(
        F.sum("quantity").alias("planned")
    )
    place = F.col("location_id") != destination if source is None else F.col("location_id") == source
    rows = stock.filter(place).select("sequence", *SPOT, "hu_id", F.col("actual_qty").alias("qty"))
    fitting = attach(rows, planned, ["item_number", "wh_id"], "inner").filter(
        (F.col("qty") <= F.col("planned")) & (F.col("qty") > 0)
    )
    if strict:
        return fitting.withColumn("destination", F.lit(destination))
    fitting = pinned(fitting)  # counted by size, then met again
    taken = _whole_units(fitting.groupBy("item_number", "wh_id", "planned", "qty").agg(F.count(F.lit(1)).alias("n")))
    several = attach(fitting, taken, ["item_number", "wh_id", ("qty", "size")], "inner")
    order = ["sequence", "location_id", "hu_id"]  # total, also where rows share a sequence
    counted = number_within(several, ["item_number", "wh_id", "qty"], order, "_at")
    chosen = counted.filter(F.col("_at") <= F.col("take")).drop("_at", "take")
    return chosen.withColumn("destination", F.lit(destination))


def settle_plans(moved: DataFrame, plans: DataFrame, as_of: datetime) -> ChangeSet:
    """Lower the plans by what was moved, close them, and log each move.

    The moved quantity is booked on the lowest plan id of the item; all its plans are closed.
    """
    sums = moved.groupBy("item_number", "wh_id").agg(F.sum("qty").alias("moved"))
    open_plans = plans.filter(F.col("status").isNull())
    first = open_plans.groupBy("item_number", "wh_id").agg(F.min("exception_id").alias("first_id"))
    key = ["item_number", "wh_id"]
    joined = attach(open_plans, attach(first, sums, key, one_row_per_key=True), key)
    booked = F.when(F.col("exception_id") == F.col("first_id"), F.coalesce("moved", F.lit(0))).otherwise(F.lit(0))
    rows = joined.select(
        "exception_id",
        (F.col("quantity") - booked).alias("quantity"),
        booked.cast("double").alias("entered_value"),
        F.lit("X").alias("status"),
    )
    profile = AuditProfile(
        *fixed.LOG_PLAN_MOVE,
        columns={
            "wh_id": "wh_id", "hu_id": "hu_id", "location_id": "location_id", "location_id_2": "destination",
            "item_number": "item_number", "tran_qty": "qty",
        },
    )
    return ChangeSet(
        updates={"t_exception_log": Update(rows, ("exception_id",))}, audit=audit_rows(moved, profile, as_of)
    )


def move_by_client(
    stock: DataFrame, items: DataFrame, client_control: DataFrame, control_type: str = fixed.LOC_SETTLEMENT
) -> DataFrame:
    """Handling-unit stock that lies at another client's location, and its own client's location."""
    control = client_control.filter(F.col("control_type") == control_type)
    owners = control.groupBy("wh_id", "c1").agg(
        F.min("client_code").alias("first_owner"), F.max("client_code").alias("last_owner")
    )
    homes = control.groupBy("wh_id", "client_code").agg(F.max("c1").alias("cc_loc"))
    clients = items.groupBy("item_number", "wh_id").agg(F.max("client_code").alias("client_code"))
    packed = stock.filter(F.col("hu_id").isNotNull()).select(
        "wh_id", "item_number", "location_id", "hu_id", "actual_qty"
    )
    # few locations belong to a client: the other stock drops out before anything is added up
    at_owned = attach(packed, owners, ["wh_id", ("location_id", "c1")], "inner")
    typed = attach(at_owned, clients, ["item_number", "wh_id"], "inner")
    # several clients may share a location: one owner other than the item's client is enough
    foreign = (F.col("first_owner") != F.col("client_code")) | (F.col("last_owner") != F.col("client_code"))
    held = (
        typed.filter(foreign)
        .groupBy("wh_id", "item_number", "location_id", "hu_id", "client_code")
        .agg(F.sum("actual_qty").alias("qty"))
    )
    return attach(held, homes, ["wh_id", "client_code"]).select(
        "wh_id", "item_number", "hu_id", "location_id", "qty", "client_code", "cc_loc"
    )


def client_moves(rows: DataFrame) -> DataFrame:
    """Output of :func:`move_by_client` as input of :func:`move_stock`; no home location, no move."""
    return rows.filter(F.col("cc_loc").isNotNull()).select(
        "wh_id",
        "item_number",
        "qty",
        F.col("location_id").alias("from_location"),
        F.col("hu_id").alias("from_hu"),
        F.col("cc_loc").alias("to_location"),
        F.lit(None).cast("string").alias("to_hu"),
    )


def client_move_audit(
    rows: DataFrame, as_of: datetime, ticket: str, descriptions: DataFrame | None = None
) -> DataFrame:
    """One audit row per place moved to its own client."""
    profile = AuditProfile(
        *fixed.LOG_CLIENT_MOVE,
        columns={
            "control_number": F.lit("Separar estoques/Clientes"), "control_number_2": F.lit(f"Problema: {ticket}"),
            "wh_id": "wh_id", "hu_id": "hu_id", "location_id": "location_id", "location_id_2": "cc_loc",
            "num_items": F.lit(0), "item_number": "item_number", "tran_qty": "qty",
        },
        split_clock=True,
    )
    return audit_rows(rows, profile, as_of, descriptions)


def merge_lots(stock: DataFrame, items: DataFrame, location: str | None = None, wh_id: str | None = None) -> DataFrame:
    """Item places that hold both lot and no-lot stock, and how they merge.

    Items without lot control keep the no-lot side, others the lot side. The quantity of the other
    side is added to one kept row (lowest lot, then lowest sequence), and the other rows are deleted.
    """
    rows = stock
    if location is not None:
        rows = rows.filter(F.col("location_id") == location)
    if wh_id is not None:
        rows = rows.filter(F.col("wh_id") == wh_id)
    lot = F.col("lot_number").isNotNull()

    def side(cond: Column, name: str) -> list[Column]:
        rank = F.struct(F.coalesce("lot_number", F.lit("")).alias("lot"), "sequence", "actual_qty")
        first = F.min(F.when(cond, rank))
        return [
            F.sum(F.when(cond, F.col("actual_qty"))).alias(f"{name}_qty"),
            F.count(F.when(cond, 1)).alias(f"{name}_rows"),
            first.alias(f"{name}_first"),
        ]

    both = (
        rows.groupBy(*SPOT)
        .agg(*side(lot, "lot"), *side(~lot, "plain"))
        .filter((F.col("lot_rows") > 0) & (F.col("plain_rows") > 0))
    )
    control = items.groupBy("item_number", "wh_id").agg(F.max("lot_control").alias("lot_control"))
    joined = attach(both, control, ["item_number", "wh_id"], "inner")
    plain = F.col("lot_control") == "N"

    def pick(no_lot: str, with_lot: str) -> Column:
        return F.when(plain, F.col(no_lot)).otherwise(F.col(with_lot))

    return joined.select(
        *SPOT,
        "lot_control",
        F.when(plain, "NO_LOT").otherwise("LOT").alias("keep"),
        pick("plain_first.sequence", "lot_first.sequence").alias("kept_sequence"),
        pick("lot_qty", "plain_qty").alias("added_qty"),
        (pick("plain_first.actual_qty", "lot_first.actual_qty") + pick("lot_qty", "plain_qty")).alias("new_qty"),
        pick("lot_rows", "plain_rows").alias("deleted_rows"),
    )


def apply_lot_merge(merged: DataFrame, stock: DataFrame, strict: bool = False) -> ChangeSet:
    """Stock changes of a lot merge. ``strict`` adds the quantity to every kept row."""
    decided = merged.select(*SPOT, "keep", "kept_sequence", "added_qty")
    rows = attach(stock.select("sequence", *SPOT, "lot_number", "actual_qty"), decided, list(SPOT), "inner")
    rows = pinned(rows)  # read for the rows raised and the rows dropped
    plain = F.col("lot_number").isNull()
    kept = rows.filter((F.col("keep") == "NO_LOT") == plain)
    if not strict:
        kept = kept.filter(F.col("sequence") == F.col("kept_sequence"))
    raised = kept.select(*ROW, (F.col("actual_qty") + F.col("added_qty")).alias("actual_qty"))
    dropped = rows.filter((F.col("keep") == "NO_LOT") != plain).select(*ROW)
    return ChangeSet(
        updates={"t_stored_item": Update(raised, ROW)},
        deletes={"t_stored_item": Delete(dropped, ROW)},
    )


def consolidate_hu(stock: DataFrame, hu: DataFrame, location: str | None = None, cap: int | None = None) -> DataFrame:
    """Handling-unit stock to merge into the loose row of the same item and location.

    One row per handling unit, item and location, with whether a loose row exists. The cap, if any,
    counts whole groups in key order.
    """
    rows = stock if location is None else stock.filter(F.col("location_id") == location)
    packed = rows.filter(F.col("hu_id").isNotNull())
    units = hu.select("hu_id", "wh_id", "parent_hu_id", "zone")
    sums = packed.groupBy("hu_id", *SPOT).agg(F.sum("actual_qty").alias("qty"))
    known = attach(sums, units, ["hu_id", "wh_id"], "inner")
    if cap is not None:
        known = known.orderBy("hu_id", *SPOT).limit(cap)
    loose = rows.filter(F.col("hu_id").isNull() & (F.col("type") == "STORAGE")).select(*SPOT).distinct()
    marked = attach(known, loose.withColumn("has_loose", F.lit(True)), list(SPOT))
    return marked.withColumn("has_loose", F.coalesce("has_loose", F.lit(False)))


def apply_consolidation(groups: DataFrame, stock: DataFrame, as_of: datetime) -> ChangeSet:
    """Raise or create the loose rows, remove the emptied stock rows and the units left empty."""
    groups = pinned(groups)  # read for each of these
    sums = groups.groupBy(*SPOT, "has_loose").agg(F.sum("qty").alias("qty"))
    loose = stock.filter(F.col("hu_id").isNull() & (F.col("type") == "STORAGE"))
    # one loose row per place takes the quantity
    first = loose.groupBy(*SPOT).agg(F.min(F.struct("sequence", "actual_qty")).alias("first"))
    raised = attach(sums.filter("has_loose"), first, list(SPOT), "inner", one_row_per_key=True).select(
        F.col("first.sequence").alias("sequence"), *SPOT, (F.col("first.actual_qty") + F.col("qty")).alias("actual_qty")
    )
    created = _new_stock(sums.filter(~F.col("has_loose")), stock, as_of, "STORAGE")
    emptied = pinned(matching(stock.select("sequence", "hu_id", *SPOT), groups, ["hu_id", *SPOT]))
    # a unit is dropped only if no other stock is left in it
    left_over = missing(
        stock.filter(F.col("hu_id").isNotNull()).select("hu_id", *SPOT), groups, ["hu_id", *SPOT]
    )
    gone = missing(groups.select("hu_id", "wh_id").distinct(), left_over, ["hu_id", "wh_id"], one_row_per_key=True)
    profile = AuditProfile(
        *fixed.LOG_CONSOLIDATE,
        columns={
            "control_number": "parent_hu_id", "control_number_2": "zone", "wh_id": "wh_id", "hu_id": "hu_id",
            "location_id": "location_id", "location_id_2": "location_id", "item_number": "item_number",
            "tran_qty": "qty",
        },
        split_clock=True,
    )
    return ChangeSet(
        inserts={"t_stored_item": created},
        updates={"t_stored_item": Update(raised, ROW)},
        deletes={
            "t_stored_item": Delete(emptied.select(*ROW, "hu_id"), (*ROW, "hu_id")),
            "t_hu_master": Delete(gone, ("hu_id", "wh_id")),
        },
        audit=audit_rows(groups, profile, as_of),
    )


def split_multi_orders(
    stock: DataFrame,
    picks: DataFrame,
    order_detail: DataFrame,
    new_hu: str | Column,
    hu_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Reserved stock of orders with more than one item, and the unit it moves to.

    ``new_hu`` is the new unit's id, or an expression over the rows when many units are split.
    """
    rows = stock.select("item_number", "location_id", "hu_id", F.col("type").alias("reserved_pick"))
    rows = rows.filter(F.col("hu_id").isNotNull() if hu_ids is None else F.col("hu_id").isin(*hu_ids))
    reserved = picks.select(
        F.col("pick_id").cast("string").alias("pick_id"), "order_number", "wh_id", "wave_id"
    )
    joined = attach(rows, reserved, [("reserved_pick", "pick_id")], "inner")
    counts = order_detail.groupBy("order_number", "wh_id").agg(F.countDistinct("item_number").alias("itms"))
    counted = attach(joined, counts.filter(F.col("itms") > 1), ["order_number", "wh_id"], "inner")
    target = F.lit(new_hu) if isinstance(new_hu, str) else new_hu
    return counted.select(
        "order_number",
        "item_number",
        "location_id",
        "hu_id",
        "wh_id",
        "wave_id",
        F.col("reserved_pick").alias("pick_id"),
        "itms",
        target.alias("new_hu_id"),
    )


def apply_split(rows: DataFrame, hu: DataFrame, as_of: datetime) -> ChangeSet:
    """Create the missing new units, re-key the stock, log each row."""
    wanted = rows.groupBy(F.col("new_hu_id").alias("hu_id"), "wh_id").agg(
        F.min("location_id").alias("location_id"), F.min("order_number").alias("load_id")
    )
    created = missing(wanted, hu, ["hu_id", "wh_id"], one_row_per_key=True).select(
        "hu_id",
        F.lit("SO").alias("type"),
        "location_id",
        F.lit("A").alias("status"),
        ts(as_of).alias("fifo_date"),
        "wh_id",
        "load_id",
    )
    keys = ("hu_id", "item_number", "wh_id", "type", "location_id")
    rekeyed = rows.groupBy("hu_id", "item_number", "wh_id", F.col("pick_id").alias("type"), "location_id").agg(
        F.min("new_hu_id").alias("new_hu_id")
    )
    profile = AuditProfile(
        *fixed.LOG_SPLIT,
        columns={
            "control_number": "order_number", "control_number_2": "wave_id", "hu_id": "hu_id", "hu_id_2": "new_hu_id",
            "location_id": "location_id", "item_number": "item_number",
        },
    )
    return ChangeSet(
        inserts={"t_hu_master": created},
        updates={"t_stored_item": Update(rekeyed, keys, into={"new_hu_id": "hu_id"})},
        audit=audit_rows(rows, profile, as_of),
    )


def confirm_load(
    stock: DataFrame, hu: DataFrame, picks: DataFrame, shipping: DataFrame, hus: Sequence[str] | None = None
) -> DataFrame:
    """Stock of loaded handling units with its pick and dock; rows without a pick or dock are skipped."""
    rows = stock.select("sequence", "item_number", "wh_id", "hu_id", "serial_number", "location_id", "actual_qty")
    if hus is not None:
        rows = rows.filter(F.col("hu_id").isin(*hus))
    units = hu.select("hu_id", "wh_id", "load_id", "control_number", F.col("location_id").alias("loc_hum"))
    docks = shipping.groupBy("shipping_id").agg(F.max("door_location").alias("dock"))
    ordered = picks.select("pick_id", "order_number", "item_number", "wh_id", "line_number", "planned_quantity")
    docked_units = attach(units, docks.filter(F.col("dock").isNotNull()), [("load_id", "shipping_id")], "inner")
    docked = attach(rows, docked_units, ["hu_id", "wh_id"], "inner")
    keys = [("serial_number", "order_number"), "item_number", "wh_id", ("control_number", "line_number")]
    return attach(docked, ordered, keys, "inner").select(
        "sequence",
        "hu_id",
        "wh_id",
        "item_number",
        F.col("location_id").alias("loc_sto"),
        "loc_hum",
        "dock",
        "pick_id",
        F.col("planned_quantity").alias("pkd_qty"),
        F.col("actual_qty").alias("sto_qty"),
    )


def apply_load(rows: DataFrame) -> ChangeSet:
    """Stock and unit to the dock, picks loaded with all quantities at the planned one."""
    held = ("sequence", "item_number", "wh_id", "hu_id")
    stock_rows = rows.groupBy(*held).agg(
        F.max("dock").alias("location_id"), F.max(F.col("pick_id").cast("string")).alias("type")
    )
    units = rows.groupBy("hu_id", "wh_id").agg(F.max("dock").alias("location_id")).withColumn("type", F.lit("LO"))
    planned = F.max("pkd_qty")
    picks = rows.groupBy("pick_id").agg(
        planned.alias("picked_quantity"), planned.alias("staged_quantity"), planned.alias("loaded_quantity")
    )
    return ChangeSet(
        updates={
            "t_stored_item": Update(stock_rows, held),
            "t_hu_master": Update(units, ("hu_id", "wh_id")),
            "t_pick_detail": Update(picks.withColumn("status", F.lit("LOADED")), ("pick_id",)),
        }
    )


def restore_wave(wave_lines: DataFrame, picks: DataFrame, waves: DataFrame | Sequence | None = None) -> DataFrame:
    """Wave lines for which no quantity was picked: the quantity to give back to the order line."""
    lines = wave_lines
    if isinstance(waves, DataFrame):
        # worked out first: few waves are then sent to the lines, which otherwise are often shuffled before the waves are known
        lines = matching(lines, pinned(waves.select("wave_id").distinct()), ["wave_id"])
    elif waves is not None:
        lines = lines.filter(F.col("wave_id").isin(*waves))
    keys = ["item_number", "wh_id", "line_number", "order_number"]
    picked = picks.groupBy(*keys).agg(F.sum("planned_quantity").alias("qty_pkd"))
    grouped = lines.groupBy(*keys, "wave_id", "wave_detail_line_id").agg(F.sum("planned_qty").alias("qty_afo"))
    pkd = F.coalesce("qty_pkd", F.lit(0))
    return attach(grouped, picked, keys, one_row_per_key=True).filter(pkd == 0).select(
        *keys, "wave_id", "wave_detail_line_id", "qty_afo", pkd.alias("qty_pkd"), (F.col("qty_afo") - pkd).alias("dif")
    )


def apply_restore(
    restored: DataFrame, wave_detail_lines: DataFrame, wave_detail: DataFrame, as_of: datetime
) -> ChangeSet:
    """Plan quantity back on the order line, wave line gone, wave detail without lines gone, logged."""
    restored = pinned(restored)  # read for each of these
    line = ("order_number", "wh_id", "line_number")
    given_back = restored.groupBy(*line).agg(F.max("qty_afo").alias("afo_plan_qty"))
    line_keys = ("wave_detail_line_id", "item_number", "line_number")
    dropped = restored.select(*line_keys).distinct()
    # one step after the other, so that the shuffles of all lines are gone when the tables are changed
    remaining = pinned(missing(wave_detail_lines, dropped, list(line_keys)).select("wave_detail_id").distinct())
    touched = matching(wave_detail, restored, ["order_number", "wave_id"])
    empty = pinned(missing(touched, remaining, ["wave_detail_id"]))
    log = restored.select(
        F.col("wh_id").cast("string").alias("tran_type"),
        F.lit(fixed.EXC_WAVE).alias("description"),
        ts(as_of).alias("exception_date"),
        ts(as_of).alias("exception_time"),
        F.lit("Cursor").alias("employee_id"),
        "wh_id",
        F.col("qty_afo").alias("quantity"),
        F.lit("0").alias("hu_id"),
        F.col("wave_id").alias("control_number"),
        "line_number",
        F.lit("0").alias("error_code"),
        F.lit(fixed.EXC_WAVE_LINE).alias("error_message"),
        F.lit("NEW").alias("status"),
        "item_number",
        F.col("order_number").alias("tracking_number"),
    )
    return ChangeSet(
        inserts={"t_exception_log": with_id(log, "exception_id")},
        updates={"t_order_detail": Update(given_back, line, where=F.col("afo_plan_qty") == 0)},
        deletes={
            "t_afo_wave_detail_line": Delete(dropped, line_keys),
            "t_afo_wave_detail": Delete(
                empty.select("wave_detail_id", "order_number", "wave_id"), ("wave_detail_id", "order_number", "wave_id")
            ),
        },
    )


def seed_stock(
    picks: DataFrame,
    orders: DataFrame,
    location: str,
    as_of: datetime,
    qty: float = 200.0,
    newest: int | None = None,
    key_type: str = "string",
) -> DataFrame:
    """Test stock for the items of the released picks; ``newest`` takes only so many picks, by date and id.

    Rows get keys of their own, of the type that the stock's ``sequence`` has.
    """
    released = picks.filter((F.col("type") == "PP") & (F.col("status") == "RELEASED"))
    known = matching(released, orders, ["order_number", "wh_id"])
    top = known.select("item_number", "wh_id", "create_date", "pick_id")
    if newest is not None:
        top = top.orderBy(F.desc("create_date"), "pick_id").limit(newest)
    return _seeded(top.select("item_number", "wh_id").distinct(), location, as_of, qty, key_type)


def seed_missing(
    worklist: DataFrame, stock: DataFrame, location: str, as_of: datetime, qty: float = 200.0
) -> DataFrame:
    """Test stock for listed items that have none at the location."""
    here = stock.filter(F.col("location_id") == location)
    keys = ["item_number", "wh_id"]
    absent = missing(worklist.select(*keys).distinct(), here, keys, one_row_per_key=True)
    return _seeded(absent, location, as_of, qty, dict(stock.dtypes).get("sequence", "string"))


def _seeded(keys: DataFrame, location: str, as_of: datetime, qty: float, key_type: str) -> DataFrame:
    place = [F.col("item_number"), F.col("wh_id"), F.lit(location), F.lit("seed"), F.lit(as_of.isoformat())]
    return keys.select(
        new_id(key_type, *place).alias("sequence"),
        "item_number",
        F.lit(qty).alias("actual_qty"),
        F.lit(0.0).alias("unavailable_qty"),
        F.lit("A").alias("status"),
        "wh_id",
        F.lit(location).alias("location_id"),
        ts(as_of).alias("fifo_date"),
        F.lit("1900-01-01 00:00:00").cast("timestamp_ntz").alias("expiration_date"),
        F.lit("0").alias("type"),
    )

