"""Repairs run to their end state, and the forms of operators that the other modules do not bind."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import cut, duplicates, interface, missing, moves, queue, reconcile
from ..plans.changeset import ChangeSet, apply_change_set, apply_update, ledger
from ..plans.numbering import pinned
from .cut import classify_cut, cut_tables, zero_stock_lines
from .missing import dup_picks, dup_picks_prereceipt
from .moves import EXTRACT_FROM, _deltas, restore_so_number
from .registry import query
from .reports import AS_OF, EVENTS_AS_OF, double_sent, manual_feed, manual_feed_release, releasable_qty

_INCREASED = """
  select t.item_number, t.wh_id, t.location_id, t.hu_id, t.type, t.lot_number, t.actual_qty + coalesce(d.qty, 0) as qty
  from v_stock t left join q_upsert_increment d on d.item_number = t.item_number and d.wh_id = t.wh_id and t.location_id = 'L1'
    and t.sequence = d.kept_sequence
  union all
  select item_number, wh_id, 'L1', null, 'STORAGE', null, qty from q_upsert_increment where action = 'INSERT'"""


def _increased(s):
    """The stock after the increments, written out: the next repair reads it several times."""
    columns = ("sequence", "item_number", "wh_id", "location_id", "hu_id", "lot_number", "type", "actual_qty")
    stock = s.stock().select(*columns)
    changes = moves.upsert_increment(stock, _deltas(s), AS_OF, row_type="STORAGE")
    return pinned(apply_change_set({"t_stored_item": stock}, changes)["t_stored_item"].select(*columns))


def _per_place(stock):
    """Rows, keys and quantity per place; as many keys as rows, or a later repair would hit the wrong one."""
    return stock.groupBy("item_number", "wh_id", "location_id").agg(
        F.sum("actual_qty").alias("qty"), F.count(F.lit(1)).alias("n"), F.count_distinct("sequence").alias("keys")
    )


@query(
    "increment_then_merge_lots",
    f"""
with s as ({_INCREASED}),
p as (
  select item_number, wh_id, location_id, sum(qty) as qty, count(*) filter (lot_number is not null) as lots,
    count(*) filter (lot_number is null) as plain
  from s group by 1, 2, 3)
select p.item_number, p.wh_id, p.location_id, p.qty,
  case when lots > 0 and plain > 0 then case when i.lot_control = 'N' then plain else lots end else lots + plain end as n, n as keys
from p join v_items i on i.item_number = p.item_number and i.wh_id = p.wh_id""",
)
def increment_then_merge_lots(s):
    """Stock per place after quantities were added, partly as new rows, and lots merged."""
    stock = _increased(s)
    changes = moves.apply_lot_merge(moves.merge_lots(stock, s.items()), stock)
    return _per_place(apply_change_set({"t_stored_item": stock}, changes)["t_stored_item"])


@query(
    "increment_then_consolidate",
    f"""
with s as ({_INCREASED}),
p as (
  select s.item_number, s.wh_id, s.location_id, sum(qty) as qty, count(*) as n, count(h.hu_id) as emptied,
    count(*) filter (s.hu_id is null and s.type = 'STORAGE') as loose
  from s left join v_hu h on h.hu_id = s.hu_id and h.wh_id = s.wh_id group by 1, 2, 3)
select *, n as keys from (
  select item_number, wh_id, location_id, qty, n - emptied + case when emptied > 0 and loose = 0 then 1 else 0 end as n from p)""",
)
def increment_then_consolidate(s):
    """Stock per place after quantities were added, partly as new rows, and units emptied into loose rows."""
    stock = _increased(s)
    groups = moves.consolidate_hu(stock, s.handling_units())
    changes = moves.apply_consolidation(groups, stock, AS_OF)
    after = apply_change_set({"t_stored_item": stock, "t_hu_master": s.handling_units()}, changes)["t_stored_item"]
    # written out before it is added up, so that the shuffles of both are not on disk at once
    return _per_place(pinned(after.select("sequence", *moves.SPOT, "actual_qty")))


@query(
    "return_stock_changes",
    """
select 'audit' as change, 't_tran_log_holding' as target, concat_ws(';', 'tran_type=044', 'description=Incremento de estoque' ||
  case when action = 'UPDATE' then ' - UPD' else '' end, 'control_number=T1', 'location_id=L1', 'item_number=' || item_number,
  'tran_qty=' || qty, 'wh_id=' || wh_id) as detail
from q_upsert_increment
union all
select case when action = 'UPDATE' then 'update' else 'insert' end, 't_stored_item', concat_ws(';', 'item_number=' || item_number,
  'wh_id=' || wh_id, 'actual_qty=' || qty) from q_upsert_increment""",
)
def return_stock_changes(s):
    shown = ("tran_type", "description", "control_number", "location_id", "item_number", "tran_qty", "wh_id")
    place = ("item_number", "wh_id", "actual_qty")
    return ledger(
        moves.return_stock(s.stock(), _deltas(s), "T1", AS_OF),
        {("audit", "t_tran_log_holding"): shown, ("insert", "t_stored_item"): place, ("update", "t_stored_item"): place},
    )


@query(
    "reconcile_blocked_by_location",
    """
with held as (select item_number, wh_id, sum(actual_qty) as total, sum(unavailable_qty) as blocked from v_stock group by 1, 2),
gaps as (
  select e.item, w.wh_id, e.loc, e.stock_on_hand as sum_soh, h.total as sum_wms, e.non_sellable_qty as sum_non,
    coalesce(h.blocked, 0) as sum_wms_una, e.non_sellable_qty - coalesce(h.blocked, 0) as gap
  from v_worklist w join v_erp e on e.item = w.item_number and e.loc = 502
  left join held h on h.item_number = w.item_number and h.wh_id = w.wh_id),
signed as (
  select *, '750' as code, 'HOLD' as before, 'AVAILABLE' as after from gaps where gap > 0
  union all select *, '700', 'AVAILABLE', 'HOLD' from gaps where gap < 0)
select item, wh_id, code as transaction_code, loc, sum_soh, sum_wms, sum_non, sum_wms_una, abs(gap) as dif_erp_wms,
  before as inventory_status_before, after as inventory_status_after
from signed""",
)
def reconcile_blocked_by_location(s):
    """All listed items against one location of the ERP."""
    return reconcile.reconcile_blocked(s.erp(), s.worklist(), s.stock(), loc=502)


@query(
    "missing_followup_recent",
    """
select distinct order_number, wh_id from v_ship
where transaction_code = '340' and record_create_date >= timestamp '1996-06-10'
  and (order_number, wh_id) not in (select order_number, wh_id from v_ship where transaction_code = '936')""",
)
def missing_followup_recent(s):
    return missing.missing_followup(s.shipments(), AS_OF, days=2000)


@query(
    "sorter_returns_recent",
    """
with back as (select distinct hu_id, item_number from v_tran where tran_type = '024'),
units as (select distinct hu_id, wh_id from v_hu)
select l.location_id, l.location_id_2, l.wh_id, l.item_number, l.hu_id, round(sum(l.tran_qty), 2) as qty
from v_tran l left join back b on b.hu_id = l.hu_id and b.item_number = l.item_number left join units u on u.hu_id = l.hu_id and u.wh_id = l.wh_id
where l.tran_type = '317' and l.start_tran_date >= timestamp '2024-01-16' and b.hu_id is null and u.hu_id is null
  and l.location_id not in ('RAIL_BUF1', 'RAIL_BUF2')
group by 1, 2, 3, 4, 5""",
)
def sorter_returns_recent(s):
    found = missing.sorter_returns(
        s.tran_log(), s.handling_units(), EVENTS_AS_OF, days=15, returned_on=("hu_id", "item_number")
    )
    return found.withColumn("qty", F.round("qty", 2))


@query(
    "dup_log_recent",
    """
select control_number, item_number, wh_id, tran_log_id, copies, latest from (
  select *, count(*) over k as copies, min(tran_log_id) over k as kept, max(date_trunc('second', start_tran_date)) over k as latest
  from v_tran where tran_type = '361' and start_tran_date >= timestamp '2024-01-11'
  window k as (partition by control_number, item_number, wh_id))
where copies > 1 and tran_log_id <> kept""",
)
def dup_log_recent(s):
    return duplicates.dup_log(s.tran_log(), EVENTS_AS_OF, days=20, keys=("control_number", "item_number", "wh_id"))


@query(
    "delete_picks",
    "select p.* from v_picks p where p.pick_id not in (select pick_id from q_dup_picks)",
)
def delete_picks(s):
    """The picks without the surplus copies."""
    return apply_change_set({"t_pick_detail": s.picks()}, duplicates.delete_picks(dup_picks(s)))["t_pick_detail"]


@query(
    "delete_picks_prereceipt",
    """
select distinct 'delete' as change, 't_pick_detail' as target, 'pick_id=' || pick_id as detail from q_dup_picks_prereceipt
union all
select distinct 'insert', 't_exception_log', 'tran_type=973;wh_id=' || wh_id || ';load_id=' || order_number ||
  ';error_message=PKD Duplicada' from q_dup_picks_prereceipt""",
)
def delete_picks_prereceipt(s):
    changes = duplicates.delete_picks(dup_picks_prereceipt(s), AS_OF)
    shown = {
        ("delete", "t_pick_detail"): ("pick_id",),
        ("insert", "t_exception_log"): ("tran_type", "wh_id", "load_id", "error_message"),
    }
    return ledger(changes, shown)


@query(
    "restore_so_number_changes",
    """
select distinct 'update' as change, 't_al_host_ship_detail' as target, concat_ws(';', 'host_ship_detail_id=' || host_ship_detail_id,
  'host_group_id=' || new_host_group_id, 'so_number=' || new_so_number, 'container_type=T', 'asn_number=' || asn_number) as detail
from q_restore_so_number
union all
select distinct 'send', 'outbox', 'service=EXP_SOSTATUS;group_id=' || new_host_group_id from q_restore_so_number""",
)
def restore_so_number_changes(s):
    shown = {
        ("update", "t_al_host_ship_detail"): (
            "host_ship_detail_id", "host_group_id", "so_number", "container_type", "asn_number",
        ),
        ("send", "outbox"): ("service", "group_id"),
    }
    return ledger(interface.apply_restored_number(restore_so_number(s)), shown)


@query(
    "record_replies",
    """
select m.host_ship_detail_id, r.reply as asn_line_number
from v_shipmsg m left join (select param1, substring(max(soap_respond), 1, 10) as reply from v_ws group by 1) r
  on r.param1 = m.host_group_id""",
)
def record_replies(s):
    """Every message with the first ten characters of its group's reply, as the column of the message takes them."""
    replies = s.service_log().select(F.col("param1").alias("host_group_id"), F.col("soap_respond").alias("reply"))
    changes = interface.record_replies(replies, length=10)
    table = s.ship_messages().withColumn("asn_line_number", F.lit(None).cast("string"))
    return apply_update(table, changes.updates["t_al_host_ship_detail"]).select("host_ship_detail_id", "asn_line_number")


_ADJUSTMENT = ("host_group_id", "item_number", "wh_id", "quantity_change", "reason_code", "from_location_id", "to_location_id", "user_id")


def _adjustment_sql(source: str, group: str, qty: str, tail: str) -> str:
    return f"""
select 'insert' as change, 't_al_host_inventory_adjustment' as target, concat_ws(';', 'host_group_id=' || {group},
  'item_number=' || item_number, 'wh_id=' || wh_id, {qty}, {tail}) as detail
from {source}
union all
select distinct 'send', 'outbox', 'service=EXP_INV_ADJUST;group_id=' || {group} from {source}"""


def _sent(changes: ChangeSet, *columns: str):
    shown = {("insert", "t_al_host_inventory_adjustment"): columns, ("send", "outbox"): ("service", "group_id")}
    return ledger(changes, shown)


@query(
    "double_sent_changes",
    _adjustment_sql(
        "q_double_sent", "md5('HJS_SG|2001-12-01T00:00:00|' || wh_id || '|' || item_number)", "'reference_code=500'",
        "'from_location_id=ATS', 'to_location_id=TRBL', 'user_id=HJS_SG'",
    ),
)
def double_sent_changes(s):
    rows = double_sent(s).withColumn("qty", F.col("qtd_a"))
    changes = reconcile.emit_adjustments(rows, reconcile.double_sent_profile(), AS_OF)
    return _sent(changes, "host_group_id", "item_number", "wh_id", "reference_code", "from_location_id", "to_location_id", "user_id")


@query(
    "releasable_qty_changes",
    _adjustment_sql(
        "q_releasable_qty", "md5('HJS_DISP|2001-12-01T00:00:00|' || wh_id || '|' || item_number)",
        "'quantity_change=' || cast(qty as double)",
        "'reason_code=6', 'from_location_id=TRBL', 'to_location_id=ATS', 'user_id=HJS_DISP'",
    ),
)
def releasable_qty_changes(s):
    return _sent(reconcile.emit_adjustments(releasable_qty(s), reconcile.releasable_profile(), AS_OF), *_ADJUSTMENT)


@query(
    "manual_feed_release_changes",
    _adjustment_sql(
        "q_manual_feed_release", "md5('HJS_CURSOR|2001-12-01T00:00:00|' || wh_id || '|' || item_number)",
        "'quantity_change=' || cast(qty as double)",
        "'reason_code=6', 'from_location_id=TRBL', 'to_location_id=ATS', 'user_id=HJS_CURSOR', 'client_code=' || client_code",
    ),
)
def manual_feed_release_changes(s):
    changes = reconcile.emit_adjustments(manual_feed_release(s), reconcile.manual_release_profile(), AS_OF)
    return _sent(changes, *_ADJUSTMENT, "client_code")


@query(
    "manual_feed_changes",
    _adjustment_sql(
        "q_manual_feed", "md5('U1|2001-12-01T00:00:00')", "'quantity_before=' || cast(qty as double)",
        "'reason_code=42', 'from_location_id=BLOCKED', 'to_location_id=BLOCKED', 'user_id=U1', 'client_code=' || client_code",
    ),
)
def manual_feed_changes(s):
    changes = reconcile.emit_adjustments(manual_feed(s), reconcile.manual_block_profile("U1", "BLOCKED"), AS_OF)
    return _sent(
        changes, "host_group_id", "item_number", "wh_id", "quantity_before", "reason_code", "from_location_id", "to_location_id",
        "user_id", "client_code",
    )


_CHOSEN = "(select * from v_orders where order_date >= timestamp '2000-06-01' order by order_number, wh_id limit 100)"


def _extract(s, name: str):
    return queue.consistent_extract(s.orders(), s.order_lines(), s.items(), EXTRACT_FROM, 100)[name]


@query("consistent_extract_orders", f"select * from {_CHOSEN}")
def consistent_extract_orders(s):
    return _extract(s, "t_order")


@query(
    "consistent_extract_lines",
    f"""
select d.order_number, d.wh_id, d.item_number, d.line_number, d.qty from v_od d
join {_CHOSEN} c on c.order_number = d.order_number and c.wh_id = d.wh_id""",
)
def consistent_extract_lines(s):
    return _extract(s, "lines")


@query(
    "consistent_extract_items",
    "select i.* from v_items i where (i.item_number, i.wh_id) in (select item_number, wh_id from q_consistent_extract_lines)",
)
def consistent_extract_items(s):
    return _extract(s, "t_item_master")


@query(
    "log_cut_changes",
    """
select 'insert' as change, 't_exception_log' as target, 'exception_id=' || md5(concat_ws('|', order_number, wh_id, item_number,
  wave_id, plan_qty)) || ';control_number=' || order_number || ';item_number=' || item_number || ';quantity=' || plan_qty ||
  ';load_id=' || wave_id || ';tran_type=033;lot_number=PRO_E' as detail
from q_zero_stock_lines""",
)
def log_cut_changes(s):
    shown = ("exception_id", "control_number", "item_number", "quantity", "load_id", "tran_type", "lot_number")
    return ledger(cut.log_cut(zero_stock_lines(s), AS_OF), {("insert", "t_exception_log"): shown})


def _pending(s):
    """The log as the cut leaves it."""
    log = s.cut_log()
    return apply_update(log, cut.apply_cut(classify_cut(s), log).updates["t_exception_log"])


@query(
    "pending_cancels",
    """
with waiting as (
  select distinct e.control_number, e.wh_id, e.item_number from v_exc e
  where e.control_number in (select control_number from q_classify_cut)
    and (e.control_number, e.item_number) not in (
      select m.order_number, d.item_number from v_ship m join v_shipdet d on d.shipment_id = m.shipment_id
      where m.transaction_code in ('360', '361'))),
uncut as (select distinct order_number, wh_id, item_number from v_od where bo_qty = 0)
select distinct w.control_number, w.wh_id,
  case when exists (select 1 from uncut u where u.order_number = w.control_number and u.wh_id = w.wh_id
    and u.item_number <> w.item_number) then 'PARTIAL' else 'COMPLETE' end as tipo
from waiting w""",
)
def pending_cancels(s):
    return cut.pending_cancels(_pending(s), s.order_lines(), s.shipments(), s.shipment_lines())


@query(
    "log_cancel_changes",
    """
select 'audit' as change, 't_tran_log_holding' as target, concat_ws(';', 'tran_type=' || tran_type,
  'description=' || case tran_type when '360' then 'whole' else 'part' end, 'employee_id=HJS_CORTE', 'control_number=' || control_number,
  'control_number_2=' || control_number_2, 'item_number=' || item_number, 'tran_qty=' || cast(tran_qty as double), 'wh_id=' || wh_id) as detail
from q_cancel_trace""",
)
def log_cancel_changes(s):
    rows = cut.cancel_trace(classify_cut(s), s.orders(), s.order_lines(), s.items(), s.picks(), s.tran_log())
    texts = s.spark.createDataFrame([("360", "whole"), ("361", "part")], "tran_type string, description string")
    shown = (
        "tran_type", "description", "employee_id", "control_number", "control_number_2", "item_number", "tran_qty", "wh_id",
    )
    return ledger(cut.log_cancels(rows, AS_OF, texts), {("audit", "t_tran_log_holding"): shown})


_CYCLE_STOCK = """(select * replace (case when type = 'STORAGE' and item_number % 2 = 0 then '0' else type end as type) from v_stock)"""


@query(
    "cut_cycle_state",
    f"""
with stock as {_CYCLE_STOCK},
free as (
  select s.item_number, s.wh_id, sum(s.actual_qty) - sum(s.unavailable_qty) as free from stock s
  join v_loc l on l.wh_id = s.wh_id and l.location_id = s.location_id and l.status <> 'I'
  join v_area a on a.wh_id = l.wh_id and a.pick_area = l.pick_area
  where s.type = '0' and s.status = 'A' group by 1, 2),
detected as (
  select distinct order_number, item_number, wh_id from v_picks p
  where p.status = 'RELEASED' and p.type = 'PP'
    and coalesce((select free from free f where f.item_number = p.item_number and f.wh_id = p.wh_id), 0) = 0
    and not exists (select 1 from v_tran l where l.tran_type = '301' and l.control_number = p.order_number and l.wh_id = p.wh_id)
    and not exists (select 1 from v_ship m where m.transaction_code = '936' and m.order_number = p.order_number and m.wh_id = p.wh_id)
    and not exists (select 1 from stock t where t.type = cast(p.pick_id as varchar))
    and not exists (select 1 from v_urgent_exc e where e.control_number = p.order_number
      and e.item_number = p.item_number)),
log as (
  select distinct order_number, item_number, wh_id from (
    select * from detected union all
    select control_number, item_number, wh_id from v_urgent_exc)),
told as (
  select m.order_number, d.item_number, m.transaction_code from v_ship m join v_shipdet d on d.shipment_id = m.shipment_id
  where m.transaction_code in ('360', '361')),
decided as (
  select distinct l.order_number, l.wh_id from log l
  where not exists (select 1 from told t where t.order_number = l.order_number and t.item_number = l.item_number
    and t.transaction_code = '360')),
lines as (
  select d.order_number, d.wh_id, d.item_number,
    c.order_number is not null or d.bo_qty > 0 as is_cut
  from v_od d left join (select l.* from log l join decided using (order_number, wh_id)) c
    on c.order_number = d.order_number and c.wh_id = d.wh_id and c.item_number = d.item_number),
waiting as (
  select l.order_number, l.wh_id, l.item_number from log l
  where l.order_number in (select order_number from decided)
    and not exists (select 1 from told t where t.order_number = l.order_number and t.item_number = l.item_number)),
typed as (
  select w.order_number, w.wh_id, bool_or(exists (select 1 from lines x where x.order_number = w.order_number
    and x.wh_id = w.wh_id and x.item_number <> w.item_number and not x.is_cut)) as part
  from waiting w group by 1, 2)
select 'status' as kind, d.order_number, d.wh_id,
  case when bool_or(not l.is_cut) then 'D' else 'C' end as value
from decided d join lines l on l.order_number = d.order_number group by d.order_number, d.wh_id
union all
select 'cancel', order_number, wh_id, case when part then '361 EXP_CANCEL_PARTIAL_ORDER' else '360 EXP_CANCEL_ORDER' end from typed""",
)
def cut_cycle_state(s):
    """New status and cancel message of every order that a whole cut decides, on stock of both storage types."""
    tables = cut_tables(s)
    half = (F.col("type") == "STORAGE") & (F.col("item_number") % 2 == 0)
    tables["t_stored_item"] = s.stock().withColumn("type", F.when(half, "0").otherwise(F.col("type")))
    phases = cut.cut_cycle(tables, datetime(2024, 1, 31)).phases
    orders = phases["cut"].updates["t_exception_log"].rows.select(F.col("control_number").alias("order_number"))
    known = tables["t_order"].join(orders, "order_number", "left_semi").select("order_number", "wh_id")
    status = phases["status"].updates["t_order"].rows.select("order_number", F.col("status").alias("value"))
    sent = phases["cancel"].inserts["t_al_host_shipment_master"].join(
        phases["cancel"].outbox, F.col("host_group_id") == F.col("group_id")
    )
    a = known.join(status, "order_number").select(F.lit("status").alias("kind"), "order_number", "wh_id", "value")
    b = sent.select(
        F.lit("cancel").alias("kind"), "order_number", "wh_id", F.concat_ws(" ", "transaction_code", "service").alias("value")
    )
    return a.unionByName(b)
