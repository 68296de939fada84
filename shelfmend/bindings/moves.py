"""Stock-move, interface and queue queries over the test data."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import ts
from ..operators import interface, moves, queue
from ..plans.changeset import apply_change_set, apply_update, ledger
from ..plans.numbering import pinned
from .registry import query
from .reports import AS_OF, EVENTS_AS_OF


@query(
    "load_quantity",
    """
select m.load_id, m.wh_id, d.item_number, sum(d.quantity_shipped) as qty
from v_ship m join v_shipdet d on m.shipment_id = d.shipment_id
group by 1, 2, 3""",
)
def load_quantity(s):
    return moves.load_quantity(s.shipments(), s.shipment_lines())


def _deltas(s):
    return load_quantity(s).withColumn("location_id", F.lit("L1")).drop("load_id")


@query(
    "upsert_increment",
    """
select d.item_number, d.wh_id, 'L1' as location_id, d.qty, t.n as rows_present, t.kept as kept_sequence,
  case when t.n is null then 'INSERT' else 'UPDATE' end as action
from (select item_number, wh_id, sum(qty) as qty from q_load_quantity group by 1, 2) d
left join (select item_number, wh_id, count(*) as n, min(sequence) as kept from v_stock where location_id = 'L1' group by 1, 2) t
  on t.item_number = d.item_number and t.wh_id = d.wh_id""",
)
def upsert_increment(s):
    return moves.upsert_plan(s.stock(), _deltas(s))


@query(
    "upsert_increment_changes",
    """
select t.item_number, t.wh_id, t.location_id, t.type, sum(t.actual_qty + coalesce(d.qty, 0)) as actual_qty, count(*) as n
from v_stock t left join q_upsert_increment d on d.item_number = t.item_number and d.wh_id = t.wh_id
  and t.location_id = 'L1' and t.sequence = d.kept_sequence
group by all
union all
select item_number, wh_id, 'L1', '0', qty, 1 from q_upsert_increment where action = 'INSERT'""",
)
def upsert_increment_changes(s):
    """Stock per place after the increments."""
    return _increased_by_type(s, strict=False)


@query(
    "upsert_increment_strict_changes",
    """
select t.item_number, t.wh_id, t.location_id, t.type, sum(t.actual_qty + coalesce(d.qty, 0)) as actual_qty, count(*) as n
from v_stock t left join q_upsert_increment d on d.item_number = t.item_number and d.wh_id = t.wh_id and t.location_id = 'L1'
group by all
union all
select item_number, wh_id, 'L1', '0', qty, 1 from q_upsert_increment where action = 'INSERT'""",
)
def upsert_increment_strict_changes(s):
    """Stock per place after the literal increments, which raise every row of a place."""
    return _increased_by_type(s, strict=True)


def _increased_by_type(s, strict):
    changes = moves.upsert_increment(s.stock(), _deltas(s), AS_OF, row_type="0", strict=strict)
    after = apply_change_set({"t_stored_item": s.stock()}, changes)["t_stored_item"]
    return after.groupBy("item_number", "wh_id", "location_id", "type").agg(
        F.sum("actual_qty").alias("actual_qty"), F.count(F.lit(1)).alias("n")
    )


@query(
    "claim_po_stock",
    """
select p.po_number, p.display_po_number, p.wh_id, p.client_code, d.item_number, sum(d.qty) as qty,
  (select max(c.c1) from v_cli c where c.wh_id = p.wh_id and c.client_code = p.client_code
    and c.control_type = case when p.type_id = '1-URGENT' then 'LOC_RECEB_SI' else 'LOC_RECEB_IA' end) as location_id
from v_po p join v_pod d on p.wh_id = d.wh_id and p.po_number = d.po_number
where p.status = 'O' and p.type_id in ('1-URGENT', '2-HIGH')
group by p.po_number, p.display_po_number, p.wh_id, p.client_code, d.item_number, p.type_id""",
)
def claim_po_stock(s):
    return moves.claim_po_stock(
        s.purchase_orders(),
        s.purchase_lines(),
        s.order_kinds(),
        s.client_control(),
        "1-URGENT",
        ("1-URGENT", "2-HIGH"),
    )


@query(
    "claim_po_stock_changes",
    """
with c as (select item_number, wh_id, location_id, sum(qty) as qty from q_claim_po_stock where location_id is not null
  group by 1, 2, 3)
select case when exists (select 1 from v_stock t where t.item_number = c.item_number and t.wh_id = c.wh_id
    and t.location_id = c.location_id) then 'update' else 'insert' end as change, 't_stored_item' as target,
  'item_number=' || item_number || ';wh_id=' || wh_id || ';location_id=' || location_id || ';actual_qty=' || qty as detail
from c
union all
select distinct 'update', 't_po_master', 'po_number=' || po_number || ';wh_id=' || wh_id || ';status=C' from q_claim_po_stock
union all
select 'audit', 't_tran_log_holding', concat_ws(';', 'tran_type=854', 'start_tran_date=2001-12-01 00:00:00',
  'control_number=' || po_number, 'location_id=' || location_id, 'item_number=' || item_number, 'tran_qty=' || qty)
from q_claim_po_stock""",
)
def claim_po_stock_changes(s):
    changes = moves.receive_claims(claim_po_stock(s), s.stock(), AS_OF)
    place = ("item_number", "wh_id", "location_id", "actual_qty")
    return ledger(
        changes,
        {
            ("insert", "t_stored_item"): place,
            ("update", "t_stored_item"): place,
            ("update", "t_po_master"): ("po_number", "wh_id", "status"),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "start_tran_date", "control_number", "location_id", "item_number", "tran_qty",
            ),
        },
    )


_FITTING = """
select t.sequence, t.item_number, t.wh_id, t.location_id, t.hu_id, t.actual_qty as qty, p.planned, 'L1' as destination
from v_stock t join (select item_number, wh_id, sum(quantity) as planned from v_exc where status is null group by 1, 2) p
  on p.item_number = t.item_number and p.wh_id = t.wh_id
where t.location_id <> 'L1' and t.actual_qty <= p.planned and t.actual_qty > 0"""


@query(
    "move_fitting",
    f"""
with recursive f as ({_FITTING}),
z as (
  select item_number, wh_id, planned, qty, count(*) as n, row_number() over (partition by item_number, wh_id order by qty desc) as k
  from f group by item_number, wh_id, planned, qty),
g(item_number, wh_id, k, qty, take, rest) as (
  select item_number, wh_id, k, qty, least(n, floor(planned / qty)), planned - least(n, floor(planned / qty)) * qty from z where k = 1
  union all
  select z.item_number, z.wh_id, z.k, z.qty, least(z.n, floor(g.rest / z.qty)), g.rest - least(z.n, floor(g.rest / z.qty)) * z.qty
  from g join z on z.item_number = g.item_number and z.wh_id = g.wh_id and z.k = g.k + 1)
select f.* exclude (r) from (
  select *, row_number() over (partition by item_number, wh_id, qty order by sequence, location_id, hu_id) as r from f) f
join g on g.item_number = f.item_number and g.wh_id = f.wh_id and g.qty = f.qty
where f.r <= g.take""",
)
def move_fitting(s):
    return moves.move_fitting(s.cut_log(), s.stock(), None, "L1")


@query("move_fitting_strict", _FITTING)
def move_fitting_strict(s):
    return moves.move_fitting(s.cut_log(), s.stock(), None, "L1", strict=True)


@query(
    "move_fitting_changes",
    """
select 'update' as change, 't_exception_log' as target, 'exception_id=' || e.exception_id || ';quantity=' ||
  (e.quantity - case when e.exception_id = f.first_id then coalesce(m.moved, 0) else 0 end) || ';entered_value=' ||
  cast(case when e.exception_id = f.first_id then coalesce(m.moved, 0) else 0 end as double) || ';status=X' as detail
from v_exc e join (select item_number, wh_id, min(exception_id) as first_id from v_exc group by 1, 2) f
  on f.item_number = e.item_number and f.wh_id = e.wh_id
left join (select item_number, wh_id, sum(qty) as moved from q_move_fitting group by 1, 2) m
  on m.item_number = e.item_number and m.wh_id = e.wh_id
union all
select 'audit', 't_tran_log_holding', concat_ws(';', 'tran_type=202', 'hu_id=' || hu_id, 'location_id=' || location_id,
  'location_id_2=L1', 'item_number=' || item_number, 'tran_qty=' || qty)
from q_move_fitting""",
)
def move_fitting_changes(s):
    changes = moves.settle_plans(move_fitting(s), s.cut_log(), AS_OF)
    return ledger(
        changes,
        {
            ("update", "t_exception_log"): ("exception_id", "quantity", "entered_value", "status"),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "hu_id", "location_id", "location_id_2", "item_number", "tran_qty",
            ),
        },
    )


@query(
    "move_by_client",
    """
select t.wh_id, t.item_number, t.hu_id, t.location_id, sum(t.actual_qty) as qty, i.client_code,
  (select max(c2.c1) from v_cli c2 where c2.control_type = 'LOC_RECEB_IA' and c2.client_code = i.client_code
    and c2.wh_id = t.wh_id) as cc_loc
from v_stock t join v_cli c on c.wh_id = t.wh_id and c.c1 = t.location_id and c.control_type = 'LOC_RECEB_IA'
join v_items i on i.item_number = t.item_number and i.wh_id = t.wh_id
where c.client_code <> i.client_code and t.hu_id is not null
group by t.wh_id, t.item_number, t.hu_id, t.location_id, i.client_code""",
)
def move_by_client(s):
    return moves.move_by_client(s.stock(), s.items(), s.client_control())


@query(
    "move_stock",
    """
select wh_id, item_number, location_id, hu_id, sum(qty) as actual_qty from (
  select wh_id, item_number, location_id, hu_id, actual_qty as qty from v_stock
  union all select wh_id, item_number, location_id, hu_id, -qty from q_move_by_client where cc_loc is not null
  union all select wh_id, item_number, cc_loc, null, qty from q_move_by_client where cc_loc is not null)
group by 1, 2, 3, 4 having sum(qty) <> 0""",
)
def move_stock(s):
    return moves.move_stock(s.stock(), moves.client_moves(move_by_client(s)))


_STAGED = """
select pick_id, item_number, container_id % 5 as wh_id, planned_quantity as qty,
  case status when 'SHIPPED' then 'STAGE' else 'L' || container_id end as from_location, cast(null as varchar) as from_hu,
  case status when 'RELEASED' then 'STAGE' when 'PICKED' then 'L1' else 'L' || container_id end as to_location,
  cast(null as varchar) as to_hu
from v_picks"""

_STAGED_STEPS = f"""
with recursive m as (select *, row_number() over (partition by item_number, wh_id order by pick_id) as k from ({_STAGED})),
start as (
  select item_number, wh_id, location_id, sum(qty) as qty from (
    select item_number, wh_id, location_id, actual_qty as qty from v_stock
    union all select item_number, wh_id, from_location, 0 from m
    union all select item_number, wh_id, to_location, 0 from m)
  group by 1, 2, 3),
places as (select item_number, wh_id, list({{'p': location_id, 'q': qty}} order by location_id) as held from start group by 1, 2),
s(item_number, wh_id, k, pick_id, moved, refused, held) as (
  select item_number, wh_id, cast(0 as bigint), cast(null as varchar), cast(0 as double), cast(0 as double), held from places
  union all
  select s.item_number, s.wh_id, m.k, m.pick_id, t.t, m.qty - t.t,
    [{{'p': x.p, 'q': x.q - case when x.p = m.from_location then t.t else 0 end + case when x.p = m.to_location then t.t else 0 end}} for x in s.held]
  from s join m on m.item_number = s.item_number and m.wh_id = s.wh_id and m.k = s.k + 1,
    lateral (select least(m.qty, [x.q for x in s.held if x.p = m.from_location][1]) as t) t)"""


def _staged(s):
    """Released picks bring stock to a stage, shipped ones take it from there, picked ones go from the shelf to L1."""
    picks, place = s.picks(), F.concat(F.lit("L"), F.col("container_id").cast("string"))
    planned = picks.select(
        "pick_id", "item_number", (F.col("container_id") % 5).alias("wh_id"), F.col("planned_quantity").alias("qty"),
        F.when(F.col("status") == "SHIPPED", F.lit("STAGE")).otherwise(place).alias("from_location"),
        F.lit(None).cast("string").alias("from_hu"),
        F.when(F.col("status") == "RELEASED", F.lit("STAGE")).when(F.col("status") == "PICKED", F.lit("L1")).otherwise(place).alias("to_location"),
        F.lit(None).cast("string").alias("to_hu"),
    )
    loose = s.stock().withColumn("hu_id", F.lit(None).cast("string"))
    return moves.move_within_stock(loose, planned, ["pick_id"])


@query(
    "move_within_stock",
    f"{_STAGED_STEPS}\nselect pick_id, item_number, wh_id, moved as moved_qty, refused as refused_qty from s where k > 0",
)
def move_within_stock(s):
    """All picks as moves against what is held: many bring what later ones take on, many are refused."""
    return _staged(s).moves.select("pick_id", "item_number", "wh_id", "moved_qty", "refused_qty")


@query(
    "move_within_stock_changes",
    f"""{_STAGED_STEPS}
select wh_id, item_number, x.p as location_id, x.q as actual_qty
from (select item_number, wh_id, unnest(arg_max(held, k)) as x from s group by 1, 2) where x.q <> 0""",
)
def move_within_stock_changes(s):
    """Balances per place after these moves."""
    return _staged(s).balances.drop("hu_id")


@query(
    "move_by_client_changes",
    """
select '042' as tran_type, timestamp '2001-12-01' as start_tran_date, 'HJS' as employee_id,
  'Separar estoques/Clientes' as control_number, cast(wh_id as varchar) as wh_id, hu_id, location_id, cc_loc as location_id_2,
  cast(item_number as varchar) as item_number, qty as tran_qty
from q_move_by_client""",
)
def move_by_client_changes(s):
    return moves.client_move_audit(move_by_client(s), AS_OF, "T1").select(
        "tran_type", "start_tran_date", "employee_id", "control_number", "wh_id", "hu_id", "location_id", "location_id_2",
        "item_number", "tran_qty",
    )


@query(
    "merge_lots",
    """
select k.item_number, k.wh_id, k.location_id, i.lot_control, case when i.lot_control = 'N' then 'NO_LOT' else 'LOT' end as keep,
  case when i.lot_control = 'N' then k.plain_seq else k.lot_first.s end as kept_sequence,
  case when i.lot_control = 'N' then k.lot_qty else k.plain_qty end as added_qty,
  case when i.lot_control = 'N' then k.lot_qty else k.plain_qty end + t.actual_qty as new_qty,
  case when i.lot_control = 'N' then k.lot_rows else k.plain_rows end as deleted_rows
from (
  select item_number, wh_id, location_id,
    sum(actual_qty) filter (lot_number is not null) as lot_qty, sum(actual_qty) filter (lot_number is null) as plain_qty,
    count(*) filter (lot_number is not null) as lot_rows, count(*) filter (lot_number is null) as plain_rows,
    min({'l': lot_number, 's': sequence}) filter (lot_number is not null) as lot_first,
    min(sequence) filter (lot_number is null) as plain_seq
  from v_stock group by 1, 2, 3) k
join v_items i on i.item_number = k.item_number and i.wh_id = k.wh_id
join v_stock t on t.sequence = case when i.lot_control = 'N' then k.plain_seq else k.lot_first.s end
  and t.item_number = k.item_number and t.location_id = k.location_id
where k.lot_rows > 0 and k.plain_rows > 0""",
)
def merge_lots(s):
    return moves.merge_lots(s.stock(), s.items())


@query(
    "merge_lots_changes",
    """
select t.sequence, t.item_number, t.lot_number, coalesce(k.new_qty, t.actual_qty) as actual_qty
from v_stock t left join q_merge_lots k on k.kept_sequence = t.sequence
where not exists (select 1 from q_merge_lots m where m.item_number = t.item_number and m.wh_id = t.wh_id
  and m.location_id = t.location_id and (m.keep = 'NO_LOT') <> (t.lot_number is null))""",
)
def merge_lots_changes(s):
    """All stock rows after the merge."""
    changes = moves.apply_lot_merge(merge_lots(s), s.stock())
    after = apply_change_set({"t_stored_item": s.stock()}, changes)["t_stored_item"]
    return after.select("sequence", "item_number", "lot_number", "actual_qty")


@query(
    "consolidate_hu",
    """
select t.hu_id, t.item_number, t.wh_id, t.location_id, sum(t.actual_qty) as qty, h.parent_hu_id, h.zone,
  exists (select 1 from v_stock l where l.item_number = t.item_number and l.wh_id = t.wh_id and l.location_id = t.location_id
    and l.hu_id is null and l.type = 'STORAGE') as has_loose
from v_stock t join v_hu h on t.hu_id = h.hu_id and t.wh_id = h.wh_id
where t.hu_id is not null
group by t.hu_id, t.item_number, t.wh_id, t.location_id, h.parent_hu_id, h.zone""",
)
def consolidate_hu(s):
    return moves.consolidate_hu(s.stock(), s.handling_units())


@query(
    "consolidate_hu_changes",
    """
with g as (select item_number, wh_id, location_id, has_loose, sum(qty) as qty from q_consolidate_hu group by 1, 2, 3, 4),
raised as (
  select arg_min(t.sequence, t.sequence) as sequence, g.qty
  from g join v_stock t on t.item_number = g.item_number and t.wh_id = g.wh_id and t.location_id = g.location_id
    and t.hu_id is null and t.type = 'STORAGE'
  group by g.item_number, g.wh_id, g.location_id, g.qty),
kept as (
  select t.*, r.qty as plus from v_stock t left join raised r on r.sequence = t.sequence
  where not exists (select 1 from q_consolidate_hu c where c.hu_id = t.hu_id and c.item_number = t.item_number
    and c.wh_id = t.wh_id and c.location_id = t.location_id))
select 'stock' as kind, item_number, wh_id, location_id, hu_id, sum(actual_qty + coalesce(plus, 0)) as qty from kept
group by item_number, wh_id, location_id, hu_id
union all
select 'new stock', item_number, wh_id, location_id, null, qty from g where not has_loose
union all
select 'unit', null, h.wh_id, null, h.hu_id, null from v_hu h
where not (exists (select 1 from q_consolidate_hu c where c.hu_id = h.hu_id and c.wh_id = h.wh_id)
  and not exists (select 1 from kept k where k.hu_id = h.hu_id and k.wh_id = h.wh_id))""",
)
def consolidate_hu_changes(s):
    """Stock and units after the consolidation."""
    changes = moves.apply_consolidation(consolidate_hu(s), s.stock(), AS_OF)
    created = changes.inserts["t_stored_item"]
    after = apply_change_set(
        {"t_stored_item": s.stock(), "t_hu_master": s.handling_units()},
        type(changes)(updates=changes.updates, deletes=changes.deletes),
    )
    stock = after["t_stored_item"].groupBy(
        F.lit("stock").alias("kind"), "item_number", "wh_id", "location_id", "hu_id"
    ).agg(F.sum("actual_qty").alias("qty"))
    new = created.select(
        F.lit("new stock").alias("kind"), "item_number", "wh_id", "location_id", F.lit(None).cast("string").alias("hu_id"),
        F.col("actual_qty").alias("qty"),
    )
    units = after["t_hu_master"].select(
        F.lit("unit").alias("kind"), F.lit(None).cast("bigint").alias("item_number"), "wh_id",
        F.lit(None).cast("string").alias("location_id"), "hu_id", F.lit(None).cast("double").alias("qty"),
    )
    return stock.unionByName(new).unionByName(units)


@query(
    "split_multi_orders",
    """
select p.order_number, t.item_number, t.location_id, t.hu_id, p.wh_id, p.wave_id, t.type as pick_id,
  (select count(distinct o.item_number) from v_od o where o.order_number = p.order_number and o.wh_id = p.wh_id) as itms,
  t.hu_id || '-M' as new_hu_id
from v_stock t join v_picks p on t.type = cast(p.pick_id as varchar)
where t.hu_id is not null
  and (select count(distinct o.item_number) from v_od o where o.order_number = p.order_number and o.wh_id = p.wh_id) > 1""",
)
def split_multi_orders(s):
    """Every unit is split; its multi-item orders move to a unit of the same name with a suffix."""
    return moves.split_multi_orders(
        s.stock(), s.picks(), s.order_lines(), F.concat("hu_id", F.lit("-M"))
    )


@query(
    "split_multi_orders_changes",
    """
select t.sequence, coalesce((select max(q.new_hu_id) from q_split_multi_orders q where q.hu_id = t.hu_id
  and q.item_number = t.item_number and q.wh_id = t.wh_id and q.pick_id = t.type and q.location_id = t.location_id), t.hu_id) as hu_id
from v_stock t
union all
select -1, new_hu_id from (select distinct new_hu_id, wh_id from q_split_multi_orders)""",
)
def split_multi_orders_changes(s):
    """Unit of every stock row after the split, and the units to create."""
    changes = moves.apply_split(split_multi_orders(s), s.handling_units(), AS_OF)
    after = apply_update(s.stock(), changes.updates["t_stored_item"]).select("sequence", "hu_id")
    created = changes.inserts["t_hu_master"].select(F.lit("-1").alias("sequence"), "hu_id")
    return after.unionByName(created)


@query(
    "confirm_load",
    """
select t.sequence, t.hu_id, t.wh_id, t.item_number, t.location_id as loc_sto, h.location_id as loc_hum, 'D' || c.c_nationkey as dock,
  p.pick_id, p.planned_quantity as pkd_qty, t.actual_qty as sto_qty
from v_stock t join v_hu h on t.hu_id = h.hu_id and t.wh_id = h.wh_id
join customer c on c.c_custkey = h.load_id and c.c_acctbal > 0
join v_picks p on p.item_number = t.item_number and p.order_number = t.serial_number and p.wh_id = t.wh_id
  and p.line_number = h.control_number""",
)
def confirm_load(s):
    return moves.confirm_load(s.stock(), s.handling_units(), s.picks(), s.docks())


@query(
    "confirm_load_changes",
    """
select 'update' as change, 't_stored_item' as target, 'sequence=' || sequence || ';location_id=' || max(dock) || ';type=' ||
  max(cast(pick_id as varchar)) as detail from q_confirm_load group by sequence
union all
select 'update', 't_hu_master', 'hu_id=' || hu_id || ';wh_id=' || wh_id || ';location_id=' || max(dock) || ';type=LO'
from q_confirm_load group by hu_id, wh_id
union all
select 'update', 't_pick_detail', 'pick_id=' || pick_id || ';status=LOADED;picked_quantity=' || max(pkd_qty) ||
  ';staged_quantity=' || max(pkd_qty) || ';loaded_quantity=' || max(pkd_qty) from q_confirm_load group by pick_id""",
)
def confirm_load_changes(s):
    return ledger(
        moves.apply_load(confirm_load(s)),
        {
            ("update", "t_stored_item"): ("sequence", "location_id", "type"),
            ("update", "t_hu_master"): ("hu_id", "wh_id", "location_id", "type"),
            ("update", "t_pick_detail"): (
                "pick_id", "status", "picked_quantity", "staged_quantity", "loaded_quantity",
            ),
        },
    )


@query(
    "restore_wave",
    """
select w.item_number, w.wh_id, w.line_number, w.order_number, w.wave_id, w.wave_detail_line_id, sum(w.planned_qty) as qty_afo,
  coalesce(sum(p.q), 0) as qty_pkd, sum(w.planned_qty) - coalesce(sum(p.q), 0) as dif
from v_waveplan w left join (select item_number, wh_id, line_number, order_number, sum(planned_quantity) as q
  from v_picks group by 1, 2, 3, 4) p
  on p.item_number = w.item_number and p.wh_id = w.wh_id and p.line_number = w.line_number and p.order_number = w.order_number
where w.wave_id in (select wave_id from v_picks where status = 'RELEASED')
group by 1, 2, 3, 4, 5, 6 having coalesce(sum(p.q), 0) = 0""",
)
def restore_wave(s):
    """All waves that still have released picks."""
    waves = s.picks().filter("status = 'RELEASED'").select("wave_id")
    return moves.restore_wave(s.replanned_wave_lines(), s.picks(), waves)


@query(
    "restore_wave_changes",
    """
with back as (select order_number, wh_id, line_number, max(qty_afo) as q from q_restore_wave group by 1, 2, 3),
left_lines as (select l.* from v_waveplan l where not exists (select 1 from q_restore_wave r
  where r.wave_detail_line_id = l.wave_detail_line_id and r.item_number = l.item_number and r.line_number = l.line_number))
select 'order line' as kind, o.order_number, o.line_number, o.item_number,
  case when o.afo_plan_qty = 0 and b.q is not null then b.q else o.afo_plan_qty end as qty
from v_od o left join back b on b.order_number = o.order_number and b.wh_id = o.wh_id and b.line_number = o.line_number
union all
select 'wave line', order_number, line_number, item_number, planned_qty from left_lines
union all
select 'wave detail', d.order_number, null, d.wave_id, null from v_wavedet d
where not (exists (select 1 from q_restore_wave r where r.order_number = d.order_number and r.wave_id = d.wave_id)
  and not exists (select 1 from left_lines l where l.wave_detail_id = d.wave_detail_id))""",
)
def restore_wave_changes(s):
    """Order lines, wave lines and wave details after the restore."""
    s.store_order_lines()
    changes = moves.apply_restore(restore_wave(s), s.replanned_wave_lines(), s.wave_details(), AS_OF)
    after = apply_change_set(
        {
            "t_order_detail": s.order_lines(),
            "t_afo_wave_detail_line": s.replanned_wave_lines(),
            "t_afo_wave_detail": s.wave_details(),
        },
        changes,
    )
    # each state is written out, so that the shuffles of one are gone when the next is worked out
    a = pinned(after["t_order_detail"].select("order_number", "line_number", "item_number", "afo_plan_qty")).select(
        F.lit("order line").alias("kind"), "order_number", "line_number", "item_number", F.col("afo_plan_qty").alias("qty")
    )
    b = pinned(after["t_afo_wave_detail_line"].select("order_number", "line_number", "item_number", "planned_qty")).select(
        F.lit("wave line").alias("kind"), "order_number", "line_number", "item_number", F.col("planned_qty").alias("qty")
    )
    c = after["t_afo_wave_detail"].select(
        F.lit("wave detail").alias("kind"), "order_number", F.lit(None).cast("int").alias("line_number"),
        F.col("wave_id").alias("item_number"), F.lit(None).cast("double").alias("qty"),
    )
    return a.unionByName(b).unionByName(c)


_SEEDED = """md5(concat_ws('|', item_number, wh_id, '{loc}', 'seed', '2001-12-01T00:00:00')) as sequence, 200.0::double as actual_qty, 0.0::double as unavailable_qty, 'A' as status, wh_id, '{loc}' as location_id,
  timestamp '2001-12-01' as fifo_date, timestamp '1900-01-01' as expiration_date, '0' as type"""


@query(
    "seed_stock",
    f"""
select distinct item_number, {_SEEDED.format(loc='RENGERAL_C')} from (
  select p.item_number, p.wh_id from v_picks p
  where p.type = 'PP' and p.status = 'RELEASED'
    and exists (select 1 from v_orders o where o.order_number = p.order_number and o.wh_id = p.wh_id)
)""",
)
def seed_stock(s):
    return moves.seed_stock(s.picks(), s.orders(), "RENGERAL_C", AS_OF)


@query(
    "seed_stock_missing",
    f"""
select distinct item_number, {_SEEDED.format(loc='L1')} from v_worklist w
where not exists (select 1 from v_stock t where t.item_number = w.item_number and t.wh_id = w.wh_id and t.location_id = 'L1')""",
)
def seed_stock_missing(s):
    return moves.seed_missing(s.worklist(), s.stock(), "L1", AS_OF)


@query(
    "transfer_lines",
    """
select d.*, c.br_order_number_orig, c.comment_text
from v_transfer d left join v_comment c on '900' || c.order_number = d.order_number and c.wh_id = d.wh_id
  and c.item_number = d.item_number and c.line_number = d.line_number
where d.shipment_id in (select shipment_id from v_ship) and d.order_number like '900%' and d.host_group_id <> '0'""",
)
def transfer_lines(s):
    return interface.transfer_lines(s.transfer_shipment_lines(), s.shipments(), s.transfer_comments())


@query(
    "transfer_lines_changes",
    """
select 'insert' as change, 't_al_host_shipment_detail' as target, concat_ws(';', 'shipment_id=' || shipment_id,
  'item_number=' || item_number, 'quantity_shipped=' || quantity_shipped, 'host_group_id=' || host_group_id,
  'order_number=' || br_order_number_orig, 'display_order_number=T', 'gen_attribute_value3=' || comment_text,
  'gen_attribute_value6=' || order_number) as detail
from q_transfer_lines
union all
select distinct 'update', 't_al_host_shipment_detail', 'shipment_detail_id=' || shipment_detail_id || ';host_group_id=0;gen_attribute_value1=' ||
  host_group_id || ';gen_attribute_value8=CORREÇÃO'
from q_transfer_lines""",
)
def transfer_lines_changes(s):
    return ledger(
        interface.apply_transfer(transfer_lines(s)),
        {
            ("insert", "t_al_host_shipment_detail"): (
                "shipment_id", "item_number", "quantity_shipped", "host_group_id", "order_number",
                "display_order_number", "gen_attribute_value3", "gen_attribute_value6",
            ),
            ("update", "t_al_host_shipment_detail"): (
                "shipment_detail_id", "host_group_id", "gen_attribute_value1", "gen_attribute_value8",
            ),
        },
    )


@query(
    "rekey_so_lines",
    """
select distinct host_group_id, so_line_number, so_number, item_number, wh_id, '40' || so_line_number as new_so_line_number,
  'T1' as asn_line_number,
  md5(concat_ws('|', host_group_id, so_line_number, so_number, item_number, wh_id)) as new_host_group_id
from v_shipmsg
where status = 'EX' and lot_number = 'W' and so_number in (
  select order_number from v_picks where wave_id in (
    select wave_id from v_picks where status = 'RELEASED' and type = 'PP'))""",
)
def rekey_so_lines(s):
    """The orders of every wave that has released open picks."""
    waves = s.picks().filter("status = 'RELEASED' AND type = 'PP'").select("wave_id")
    return interface.rekey_so_lines(s.ship_messages(), s.picks(), waves, "T1")


@query(
    "rekey_so_lines_changes",
    """
select m.host_ship_detail_id, coalesce(r.new_host_group_id, m.host_group_id) as host_group_id,
  coalesce(r.new_so_line_number, cast(m.so_line_number as varchar)) as so_line_number, r.asn_line_number
from v_shipmsg m left join q_rekey_so_lines r on r.host_group_id = m.host_group_id and r.item_number = m.item_number
  and r.wh_id = m.wh_id and r.so_number = m.so_number and r.so_line_number = m.so_line_number""",
)
def rekey_so_lines_changes(s):
    """Every message after the re-key."""
    rows = rekey_so_lines(s).withColumn("so_line_number", F.col("so_line_number").cast("string"))
    table = s.ship_messages().withColumns(
        {"so_line_number": F.col("so_line_number").cast("string"), "asn_line_number": F.lit(None).cast("string")}
    )
    after = apply_update(table, interface.apply_rekey(rows).updates["t_al_host_ship_detail"])
    return after.select("host_ship_detail_id", "host_group_id", "so_line_number", "asn_line_number")


@query(
    "restore_so_number",
    """
select m.host_ship_detail_id, md5(m.host_ship_detail_id || '|' || m.host_group_id) as new_host_group_id,
  c.br_order_number_orig as new_so_number, 'T' as container_type, '9' || m.so_number as asn_number
from v_shipmsg m left join v_comment c on c.order_number = m.so_number and c.wh_id = m.wh_id and c.line_number = m.so_line_number
  and c.item_number = m.item_number
where m.container_type = 'A' and m.transaction_code = '336'""",
)
def restore_so_number(s):
    return interface.restore_so_number(s.renumbered_messages(), s.renumbered_comments())


_RECEIPT = """case when a.context in ('DEVTRI', 'ACORDO', 'SINFIS', 'BUFFER', 'TSFCST', 'TSFDOA') then 'TRBL' else 'ATS' end"""


@query(
    "receipts_from_asn",
    f"""
select distinct md5('158|' || p.po_number) as host_group_id, '158' as transaction_code, 'HJS' as user_id, p.vendor_code, p.po_number,
  a.item_number, a.qty as qty_received, a.hu_id, p.wh_id, p.display_po_number, a.document_type || '-' || a.distro_number as scac_code,
  {_RECEIPT} as status, p.client_code, a.context as pack_slip, 'COMPLETE' as fork_id
from v_asn a join v_po p on a.display_po_number = p.display_po_number and a.wh_id = p.wh_id""",
)
def receipts_from_asn(s):
    return interface.receipts_from_asn(s.transfer_notices(), s.purchase_orders())


@query(
    "receipts_from_asn_changes",
    """
select service, group_id from (
  select distinct 'EXP_RECEB' as service, host_group_id as group_id from q_receipts_from_asn)""",
)
def receipts_from_asn_changes(s):
    return interface.emit_receipts(receipts_from_asn(s)).outbox


_STORE = f"""
select md5('164|' || p.po_number) as host_group_id, '164' as transaction_code, 'HJS' as user_id, p.vendor_code, p.po_number,
  d.item_number, d.qty as qty_received, a.hu_id, p.wh_id, p.display_po_number,
  a.document_type || '-' || a.distro_number as scac_code, {_RECEIPT} as status, p.client_code, 'BUFFER' as pack_slip
from v_po p join v_pod d on p.po_number = d.po_number and p.wh_id = d.wh_id
join v_asn a on a.display_po_number = p.display_po_number and a.wh_id = p.wh_id and upper(a.processing_code) = 'NEW'
  and a.item_number = d.item_number
where p.status = 'O' and p.type_id = '2-HIGH' and p.po_number in (select control_number from v_exc)
  and not exists (select 1 from v_receipts r where r.po_number = p.po_number)"""


def _store_po(s, per_po):
    worklist = s.cut_log().select(F.col("control_number").alias("item_number"))
    return interface.close_store_po(
        s.purchase_orders(), worklist, s.purchase_lines(), s.transfer_notices(), s.receipts(), "2-HIGH", per_po=per_po
    )


@query(
    "close_store_po",
    f"""
select *, row_number() over (order by po_number, item_number, hu_id, scac_code, status, qty_received) as line_number
from ({_STORE})""",
)
def close_store_po(s):
    return _store_po(s, per_po=False)


@query(
    "close_store_po_per_order",
    f"""
select *, row_number() over (partition by po_number order by item_number, hu_id, scac_code, status, qty_received) as line_number
from ({_STORE})""",
)
def close_store_po_per_order(s):
    return _store_po(s, per_po=True)


@query(
    "close_store_po_changes",
    """
select 'update' as change, 't_po_master' as target, 'po_number=' || po_number || ';status=C' as detail
from (select distinct po_number from q_close_store_po)
union all
select distinct 'send', 'outbox', 'service=EXP_RECEB;group_id=' || host_group_id from q_close_store_po""",
)
def close_store_po_changes(s):
    changes = interface.emit_receipts(close_store_po(s), close_po=True)
    return ledger(
        changes,
        {("update", "t_po_master"): ("po_number", "status"), ("send", "outbox"): ("service", "group_id")},
    )


@query(
    "receipts_from_erp",
    f"""
select *, row_number() over (partition by po_number, wh_id order by item_number, hu_id, scac_code) as line_number from (
  select md5('158|' || p.po_number || '|' || p.wh_id) as host_group_id, '158' as transaction_code, 'HJS_WSUP' as user_id,
    p.vendor_code, p.po_number, cast(k.l_partkey as varchar) as item_number, sum(k.l_quantity) as qty_received,
    'C' || k.l_orderkey || '-' || k.l_linenumber as hu_id, p.wh_id, p.display_po_number,
    k.l_returnflag || '-' || k.l_suppkey as scac_code,
    (select max({_RECEIPT}) from v_asn a where a.hu_id = 'C' || k.l_orderkey || '-' || k.l_linenumber) as status, p.client_code
  from v_po p join orders s on 'PO' || s.o_orderkey = p.display_po_number and s.o_orderkey % 5 = p.wh_id
  join lineitem k on k.l_orderkey = s.o_orderkey
  where p.status = 'C'
  group by p.po_number, p.wh_id, p.vendor_code, k.l_partkey, k.l_orderkey, k.l_linenumber, p.display_po_number, k.l_returnflag,
    k.l_suppkey, p.client_code)""",
)
def receipts_from_erp(s):
    return interface.receipts_from_erp(
        s.purchase_orders(), s.erp_shipments(), s.erp_shipment_items(), s.transfer_notices(), type_id=None
    )


CLAIM_SIZE = 30


def _claim(s):
    return queue.claim_batch(s.queue(), "click", CLAIM_SIZE, EVENTS_AS_OF)


def _claimed_queue(s):
    return apply_update(s.queue(), _claim(s).updates["ea_t_async_work_queue"])


@query(
    "claim_batch",
    """
select event_id, 'TEMP_STATUS' as status, timestamp '2024-01-31' as date_started, md5('click|2024-01-31T00:00:00') as claim_id
from v_queue where procobject = 'click' and status = 'NEW' and date_started is null
order by date_added, event_id limit 30""",
)
def claim_batch(s):
    """The claim takes a fixed number of the oldest events."""
    return _claim(s).updates["ea_t_async_work_queue"].rows


@query(
    "claimed_payloads",
    """
select d.scevent_name, 'TEMP_STATUS' as status, q.procobject, p.payload as host_group_id, count(*) as events
from v_queue q join q_claim_batch c on c.event_id = q.event_id join v_pay p on p.event_id = q.event_id
join v_evdef d on d.scevent_id = q.scevent_id
group by 1, 3, 4""",
)
def claimed_payloads(s):
    return queue.claimed_payloads(_claimed_queue(s), s.event_definitions(), s.payloads(), "click")


@query(
    "complete_batch",
    """
select q.event_id, case when c.event_id is not null then 'SUCCESS' else q.status end as status,
  coalesce(c.date_started, q.date_started) as date_started,
  case when c.event_id is not null then timestamp '2024-01-31' end as date_finished,
  case when c.event_id is not null then 200 end::bigint as alert_id
from v_queue q left join q_claim_batch c on c.event_id = q.event_id""",
)
def complete_batch(s):
    """The whole queue after a claim and its completion."""
    claimed = _claimed_queue(s)
    done = queue.complete_batch(claimed, EVENTS_AS_OF, 200, F.md5(F.lit("click|2024-01-31T00:00:00")))
    after = apply_update(claimed, done.updates["ea_t_async_work_queue"])
    return after.select("event_id", "status", "date_started", "date_finished", "alert_id")


LEASE = timedelta(minutes=30)
LATER = EVENTS_AS_OF + timedelta(hours=1)


@query(
    "lease_batch",
    """
select event_id, 'TEMP_STATUS' as status, timestamp '2024-01-31 01:00:00' as date_started,
  md5('click|2024-01-31T01:00:00|' || part) as claim_id
from (select *, row_number() over (partition by part order by date_added, event_id) as place from (
  select *, cast('0x' || substring(md5(cast(event_id as varchar)), 1, 8) as bigint) % 2 as part
  from v_queue where procobject = 'click' and status = 'NEW' and date_started is null))
where place <= 30""",
)
def lease_batch(s):
    """Two workers take events at once after a claim whose worker died; the claim's events are free again."""
    claimed = _claimed_queue(s)
    a, b = (queue.lease_batch(claimed, "click", CLAIM_SIZE, LATER, LEASE, i, 2) for i in range(2))
    return a.updates["ea_t_async_work_queue"].rows.unionByName(b.updates["ea_t_async_work_queue"].rows)


@query(
    "release_expired",
    """
select q.event_id, q.status, case when c.event_id is null then q.date_started end as date_started, q.claim_id,
  q.retry_count + case when c.event_id is null then 0 else 1 end as retry_count
from v_queue q left join q_claim_batch c on c.event_id = q.event_id""",
)
def release_expired(s):
    """The whole queue after the events of a dead claim went back."""
    claimed = _claimed_queue(s)
    back = queue.release_expired(claimed, LATER, LEASE).updates["ea_t_async_work_queue"]
    return apply_update(claimed, back).select("event_id", "status", "date_started", "claim_id", "retry_count")


@query(
    "order_extract",
    """
with chosen as (select order_number, wh_id from v_orders where order_date >= timestamp '2000-06-01'),
d as (select d.* from v_od d join chosen using (order_number, wh_id)),
p as (select p.* from v_picks p join chosen using (order_number, wh_id)),
i as (select distinct item_number, wh_id from (select item_number, wh_id from d union all select item_number, wh_id from p)
  join v_items using (item_number, wh_id))
select 't_order' as target, wh_id, order_number::varchar as key from chosen
union all select 't_order_detail', wh_id, concat_ws('-', order_number, item_number) from d
union all select 't_pick_detail', wh_id, pick_id::varchar from p
union all select 't_item_master', wh_id, item_number::varchar from i
union all select 't_item_uom', u.wh_id, concat_ws('-', u.item_number, u.uom) from v_uom u join i using (item_number, wh_id)""",
)
def order_extract(s):
    """All orders from a day on with their lines, picks, items and units."""
    tables = {
        "t_order": s.orders(), "t_order_detail": s.order_lines(), "t_pick_detail": s.picks(), "t_item_master": s.items(),
        "t_item_uom": s.units(),
    }
    found = queue.order_extract(tables, s.orders().filter(F.col("order_date") >= ts(EXTRACT_FROM)))
    names = {
        "t_order": ("order_number",), "t_order_detail": ("order_number", "item_number"), "t_pick_detail": ("pick_id",),
        "t_item_master": ("item_number",), "t_item_uom": ("item_number", "uom"),
    }
    parts = [found[t].select(F.lit(t).alias("target"), "wh_id", F.concat_ws("-", *c).alias("key")) for t, c in names.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "outbox_groups",
    "select distinct 'EXP_INV_ADJUST' as service, host_group_id as group_id from v_adj where quantity_change > 50",
)
def outbox_groups(s):
    return queue.outbox_groups(s.adjustments(), F.col("quantity_change") > 50, "EXP_INV_ADJUST")


EXTRACT_FROM = datetime(2000, 6, 1)


@query(
    "consistent_extract",
    """
with chosen as (select * from v_orders where order_date >= timestamp '2000-06-01' order by order_number, wh_id limit 100)
select o.order_id, i.item_master_id, d.wh_id, d.order_number, d.line_number, d.item_number, 0.0::double as bo_qty,
  0.0::double as bo_weight, d.qty, 0.0::double as afo_plan_qty, 'E' as unit_pack, 0.0::double as item_weight,
  1.0::double as qty_shipped, 'P' as line_type, 'N' as use_shippable_uom
from chosen o join v_od d on d.order_number = o.order_number and d.wh_id = o.wh_id
join v_items i on i.item_number = d.item_number and i.wh_id = d.wh_id""",
)
def consistent_extract(s):
    """The extract takes a fixed number of orders from a day on."""
    return queue.consistent_extract(s.orders(), s.order_lines(), s.items(), EXTRACT_FROM, 100)["t_order_detail"]
