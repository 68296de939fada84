"""Order-cut queries over the test data.

The cut log is every released open pick line; where a step needs lines that are logged already, it is that of the urgent
orders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cut, missing
from ..plans.changeset import apply_update, ledger
from .registry import query
from .reports import AS_OF



def _zero_sql(free: str, started: str, logged: str) -> str:
    return f"""
select distinct b.order_number, b.item_number, b.wh_id, b.plan_qty, b.wave_id
from (
  select p.wave_id, p.wh_id, p.pick_id, p.order_number, p.item_number, sum(p.planned_quantity) as plan_qty,
    coalesce(f.free, 0) as free
  from v_picks p left join ({free}) f on f.item_number = p.item_number and f.wh_id = p.wh_id
  where p.status = 'RELEASED' and p.type = 'PP'
  group by p.wave_id, p.wh_id, p.order_number, p.item_number, p.pick_id, f.free) b
where b.free = 0
  and not exists (select 1 from v_tran l where l.control_number = b.order_number and l.wh_id = b.wh_id
    and l.tran_type = '411'{started})
  and not exists (select 1 from v_ship m where m.order_number = b.order_number and m.wh_id = b.wh_id
    and m.transaction_code = '936')
  and not exists (select 1 from v_stock t where t.type = cast(b.pick_id as varchar)){logged}"""


@query(
    "zero_stock_lines",
    _zero_sql(
        """select s.item_number, s.wh_id, sum(s.actual_qty) - sum(s.unavailable_qty) as free
    from v_stock s join v_loc l on l.wh_id = s.wh_id and l.location_id = s.location_id
    join v_area a on a.wh_id = l.wh_id and a.pick_area = l.pick_area
    where s.type = 'STORAGE' and s.status = 'A' and l.status <> 'I' group by 1, 2""",
        "",
        """
  and not exists (select 1 from v_urgent_exc e where e.control_number = b.order_number and e.item_number = b.item_number
    and e.tran_type = '033' and e.lot_number = 'PRO_E')""",
    ),
)
def zero_stock_lines(s):
    return cut.zero_stock_lines(
        s.picks(), s.stock(), s.tran_log(), s.shipments(), s.locations(), s.pick_areas(), s.urgent_cut_log(),
        start_type="411", storage_type="STORAGE",
    )


@query(
    "zero_stock_lines_by_item",
    _zero_sql(
        """select item_number, wh_id, sum(actual_qty) - sum(unavailable_qty) as free
    from v_stock where type = 'STORAGE' group by 1, 2""",
        " and l.item_number = b.item_number",
        "",
    ),
)
def zero_stock_lines_by_item(s):
    return cut.zero_stock_lines(
        s.picks(), s.stock(), s.tran_log(), s.shipments(), start_type="411", item_level_start=True, storage_type="STORAGE"
    )


_CLASSIFY = """
select distinct e.control_number, e.wh_id,
  case when (select count(distinct o.item_number) from v_od o where o.order_number = e.control_number
    and o.wh_id = e.wh_id and o.item_number <> e.item_number and o.bo_qty = 0) > 0 then 'PARTIAL' else 'COMPLETE' end as tipo
from v_exc e
where e.tran_type = '033' and e.lot_number = 'PRO_E' and e.status is null and not exists ({sent})"""


@query(
    "classify_cut",
    _CLASSIFY.format(
        sent="""
  select 1 from v_ship m join v_shipdet d on m.shipment_id = d.shipment_id
  where m.order_number = e.control_number and m.transaction_code = '360' and d.item_number = e.item_number"""
    ),
)
def classify_cut(s):
    return cut.classify_cut(s.cut_log(), s.order_lines(), s.shipments(), s.shipment_lines())


@query(
    "classify_cut_by_order",
    _CLASSIFY.format(
        sent="""
  select 1 from v_ship m where m.order_number = e.control_number and m.transaction_code in ('360', '361')"""
    ),
)
def classify_cut_by_order(s):
    return cut.classify_cut(s.cut_log(), s.order_lines(), s.shipments(), codes=cut.CANCEL_CODES)


_DECIDED = "(select control_number, wh_id, max(tipo) as tipo from q_classify_cut group by 1, 2)"
_CUT_LINES = f"""(
  select e.control_number as order_number, e.wh_id, e.item_number, arg_max(e.quantity, e.exception_id) as bo_qty
  from v_exc e join {_DECIDED} d on d.control_number = e.control_number and d.wh_id = e.wh_id
  group by 1, 2, 3)"""


@query(
    "apply_cut",
    f"""
select 't_order_detail' as target, o.order_number, o.wh_id, o.item_number, coalesce(c.bo_qty, o.bo_qty) as quantity,
  cast(null as varchar) as status, 1 as n
from v_od o left join {_CUT_LINES} c using (order_number, wh_id, item_number)
union all
select 't_pick_detail', p.order_number, p.wh_id, p.item_number, sum(p.planned_quantity),
  case when p.status = 'RELEASED' and c.order_number is not null then 'PICKED' else p.status end, count(*)
from v_picks p left join {_CUT_LINES} c using (order_number, wh_id, item_number)
group by p.order_number, p.wh_id, p.item_number, 6
union all
select 't_exception_log', e.control_number, e.wh_id, e.item_number, sum(e.quantity), d.tipo, count(*)
from v_exc e left join (select control_number, max(tipo) as tipo from {_DECIDED} group by 1) d
  on d.control_number = e.control_number
group by e.control_number, e.wh_id, e.item_number, d.tipo""",
)
def apply_cut(s):
    """Order lines, picks and log after the cut."""
    log = s.cut_log()
    changes = cut.apply_cut(classify_cut(s), log)
    lines = apply_update(s.order_lines(), changes.updates["t_order_detail"])
    blank = F.lit(None).cast("string")
    picks = s.picks().withColumns({"lot_number": blank, "pendency": blank, "user_assigned": blank})
    picks = apply_update(picks, changes.updates["t_pick_detail"])
    logged = apply_update(log, changes.updates["t_exception_log"])
    one, key = F.count(F.lit(1)).alias("n"), ["order_number", "wh_id", "item_number"]
    a = lines.select(
        F.lit("t_order_detail").alias("target"), *key, F.col("bo_qty").alias("quantity"), blank.alias("status"),
        F.lit(1).cast("bigint").alias("n"),
    )
    b = picks.groupBy(F.lit("t_pick_detail").alias("target"), *key, "status").agg(
        F.sum("planned_quantity").alias("quantity"), one
    )
    c = logged.withColumnRenamed("control_number", "order_number")
    c = c.groupBy(F.lit("t_exception_log").alias("target"), *key, "status").agg(F.sum("quantity").alias("quantity"), one)
    return a.unionByName(b).unionByName(c)


@query(
    "order_status_after_cut",
    "select order_number, case when count(*) filter (bo_qty = 0) > 0 then 'D' else 'C' end as status from v_od group by 1",
)
def order_status_after_cut(s):
    return cut.order_status_after_cut(s.order_lines())


@query(
    "order_status_remaining",
    "select order_number, wh_id, 'C' as status from v_od group by 1, 2 having sum(qty - bo_qty) = 0",
)
def order_status_remaining(s):
    return cut.order_status_after_cut(s.order_lines(), "remaining")


@query(
    "invoice_headers",
    """
with gate as (
  select order_number, wh_id from v_picks group by 1, 2
  having count(*) filter (status = 'PICKED' and picked_quantity > 0) = 0 and count(*) filter (status = 'RELEASED') = 0),
held as materialized (
  select p.order_number, p.wh_id, p.load_id, sum(p.planned_quantity * k.n) as planned, sum(p.picked_quantity * k.n) as picked
  from v_picks p join (select type, wh_id, count(*) as n from v_stock where type <> 'STORAGE' group by 1, 2) k
    on cast(p.pick_id as varchar) = k.type and p.wh_id = k.wh_id
  where (p.load_id, p.wh_id) in (select order_number, wh_id from gate)
  group by 1, 2, 3)
select md5('936|' || p.order_number || '|' || p.wh_id) as shipment_id,
  md5('936|' || p.order_number || '|' || p.wh_id) as host_group_id, '936' as transaction_code, p.order_number as load_id,
  case when p.planned = p.picked then 'COMPLETE' else 'PARTIAL' end as status,
  'HJS_CORTE' as user_id, 'il11405' as printer_id, p.order_number, p.wh_id, o.display_order_number, o.client_code,
  o.bill_to_code, o.split_status, t.type as order_type, v.vqm_profile as delivery_sap
from held p join v_orders o on p.order_number = o.order_number and p.wh_id = o.wh_id
join v_types t on o.type_id = t.type_id
left join v_vendor v on o.bill_to_code = v.vendor_code""",
)
def invoice_headers(s):
    return cut.invoice_headers(s.picks(), s.stock(), s.orders(), s.vendors(), s.order_types(), storage_type="STORAGE")


@query(
    "invoice_details",
    """
with held as materialized (
  select p.pick_id, k.wh_id, k.item_number, k.hu_id, k.stored_attribute_id, k.actual_qty
  from v_stock k join (select distinct pick_id, wh_id from v_picks) p on cast(p.pick_id as varchar) = k.type and p.wh_id = k.wh_id
  where k.type <> 'STORAGE')
select h.shipment_id, h.host_group_id, p.line_number, p.item_number, i.display_item_number,
  coalesce(sum(k.actual_qty), 0) as quantity_shipped, k.hu_id, 'HJS_CORTE' as user_id, p.wh_id, o.client_code, u.uom,
  c.tracking_number, p.order_number, o.display_order_number, o.customer_id as delivery_sap, a.p_brand as gen_attribute_value1,
  a.p_type as gen_attribute_value2, cast(a.p_size as varchar) as gen_attribute_value3,
  """
    + ", ".join(f"cast(null as varchar) as gen_attribute_value{i}" for i in range(4, 12))
    + """
from held k join v_picks p on p.pick_id = k.pick_id and p.wh_id = k.wh_id
left join v_cont c on p.container_id = c.container_id and p.wh_id = c.wh_id
join v_items i on i.item_number = k.item_number and i.wh_id = k.wh_id
join q_invoice_headers h on h.load_id = p.load_id and h.order_number = p.order_number and h.wh_id = p.wh_id
join v_orders o on p.order_number = o.order_number and p.wh_id = o.wh_id
left join v_uom u on u.item_number = p.item_number and u.wh_id = p.wh_id
left join part a on a.p_partkey = k.stored_attribute_id
group by h.shipment_id, h.host_group_id, p.line_number, p.item_number, i.display_item_number, k.hu_id, p.wh_id, o.client_code,
  u.uom, c.tracking_number, p.order_number, o.display_order_number, o.customer_id, k.stored_attribute_id, a.p_brand,
  a.p_type, a.p_size""",
)
def invoice_details(s):
    return cut.invoice_details(
        s.stock(),
        s.picks(),
        invoice_headers(s),
        s.items(),
        s.orders(),
        s.containers(),
        s.units(),
        s.attribute_values(),
        s.attribute_map(),
        storage_type="STORAGE",
    )


@query(
    "closable_tasks",
    """
select distinct p.work_q_id, p.wh_id, p.order_number, p.wave_id, p.status, w.work_status, p.pick_area
from v_picks p join v_work w on w.work_q_id = p.work_q_id
where w.work_status <> 'C' and p.status <> 'RELEASED'
  and not exists (select 1 from v_picks x where x.work_q_id = w.work_q_id and x.wh_id = w.wh_id and x.status = 'RELEASED')
  and not exists (select 1 from v_assign a where a.work_q_id = p.work_q_id and a.wh_id = p.wh_id)
  and exists (select 1 from v_ship m join v_shipdet d on d.shipment_id = m.shipment_id
    where m.transaction_code in ('340', '360') and m.order_number = p.order_number and d.item_number = p.item_number)""",
)
def closable_tasks(s):
    return cut.closable_tasks(
        s.picks(), s.tasks(), s.assignments(), s.shipments(), s.shipment_lines(), codes=("340", "360")
    )


@query(
    "closable_tasks_changes",
    """
select distinct 'update' as change, 't_work_q' as target,
  'work_q_id=' || work_q_id || ';wh_id=' || wh_id || ';work_status=C' as detail
from q_closable_tasks
union all
select 'audit', 't_tran_log_holding', 'tran_type=015;control_number=' || order_number || ';control_number_2=' || wave_id ||
  ';location_id=' || work_q_id || ';location_id_2=' || pick_area
from q_closable_tasks""",
)
def closable_tasks_changes(s):
    changes = cut.close_cut_tasks(closable_tasks(s), AS_OF)
    return ledger(
        changes,
        {
            ("update", "t_work_q"): ("work_q_id", "wh_id", "work_status"),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "control_number", "control_number_2", "location_id", "location_id_2",
            ),
        },
    )


_CODED = f"""(
  select control_number as order_number, wh_id, tipo, case when tipo = 'COMPLETE' then '360' else '361' end as transaction_code,
    md5(case when tipo = 'COMPLETE' then '360' else '361' end || '|' || control_number || '|' || wh_id) as host_group_id
  from {_DECIDED})"""


@query(
    "cancel_interface",
    f"""
select c.host_group_id as shipment_id, c.host_group_id, o.order_number, o.wh_id, d.item_number, d.line_number,
  d.bo_qty as quantity_shipped, o.client_code, o.display_order_number, i.display_item_number, u.uom, 'HJS_C' as user_id
from {_CODED} c join v_orders o on o.order_number = c.order_number
join v_od d on d.order_number = o.order_number
join v_items i on i.wh_id = d.wh_id and i.item_number = d.item_number
left join v_uom u on u.wh_id = d.wh_id and u.item_number = d.item_number
where d.bo_qty > 0""",
)
def cancel_interface(s):
    return _cancel(s).inserts["t_al_host_shipment_detail"].drop("shipment_detail_id")


def _cancel(s):
    return cut.cancel_interface(classify_cut(s), s.orders(), s.order_lines(), s.items(), s.units())


@query(
    "cancel_interface_changes",
    f"""
select 'insert' as change, 't_al_host_shipment_master' as target, 'host_group_id=' || c.host_group_id ||
  ';transaction_code=' || c.transaction_code || ';order_number=' || o.order_number || ';status=COMPLETE;user_id=HJS_C;order_type=CP' ||
  ';client_code=' || o.client_code || ';bill_to_code=' || o.bill_to_code || ';split_status=' || o.split_status as detail
from {_CODED} c join v_orders o on o.wh_id = c.wh_id and o.order_number = c.order_number
union all
select 'send', 'outbox', 'service=' || case when c.tipo = 'COMPLETE' then 'EXP_CANCEL_ORDER' else 'EXP_CANCEL_PARTIAL_ORDER' end ||
  ';group_id=' || c.host_group_id
from {_CODED} c
union all
select 'update', 't_exception_log', 'control_number=' || c.order_number || ';tran_type=033;suggested_value=OK'
from (select distinct order_number from {_CODED}) c""",
)
def cancel_interface_changes(s):
    return ledger(
        _cancel(s),
        {
            ("insert", "t_al_host_shipment_master"): (
                "host_group_id", "transaction_code", "order_number", "status", "user_id", "order_type", "client_code",
                "bill_to_code", "split_status",
            ),
            ("send", "outbox"): ("service", "group_id"),
            ("update", "t_exception_log"): ("control_number", "tran_type", "suggested_value"),
        },
    )


@query(
    "cancel_trace",
    f"""
select c.transaction_code as tran_type, d.order_number as control_number, p.wave_id as control_number_2, d.item_number,
  d.qty as tran_qty, d.wh_id
from {_CODED} c join v_od d on d.wh_id = c.wh_id and d.order_number = c.order_number and d.bo_qty > 0
join v_orders o on o.wh_id = d.wh_id and o.order_number = d.order_number
join v_items i on i.wh_id = d.wh_id and i.item_number = d.item_number
left join v_picks p on p.order_number = d.order_number and p.wh_id = d.wh_id and p.item_number = d.item_number
where not exists (select 1 from v_tran l where l.control_number = d.order_number and l.item_number = d.item_number
  and l.wh_id = d.wh_id and l.tran_type in ('360', '361'))""",
)
def cancel_trace(s):
    return cut.cancel_trace(
        classify_cut(s), s.orders(), s.order_lines(), s.items(), s.picks(), s.tran_log()
    )


@query(
    "cancel_eligible",
    """
select distinct o.order_number, o.wh_id, d.item_number, d.line_number, d.qty, d.bo_qty
from v_orders o join v_od d on d.order_number = o.order_number and d.wh_id = o.wh_id
where not exists (select 1 from v_ship m join v_shipdet x on m.shipment_id = x.shipment_id
  where m.order_number = o.order_number and m.wh_id = o.wh_id and x.item_number = d.item_number)""",
)
def cancel_eligible(s):
    """Every order is on the worklist."""
    worklist = s.orders().select(F.col("order_number").alias("item_number"), "wh_id")
    return cut.cancel_eligible(s.orders(), worklist, s.order_lines(), s.shipments(), s.shipment_lines())


@query(
    "cancel_eligible_changes",
    """
with e as (select order_number, wh_id, item_number, line_number, qty,
    md5('361|' || order_number || '|' || wh_id || '|HJS_REP') as g from q_cancel_eligible),
left_over as (
  select d.order_number, d.wh_id, sum(case when e.qty is not null then 0 else d.qty - d.bo_qty end) as rest,
    max(case when e.qty is not null then 1 else 0 end) as touched
  from v_od d left join e using (order_number, wh_id, item_number) group by 1, 2)
select 'update' as change, 't_order_detail' as target, 'order_number=' || order_number || ';item_number=' || item_number ||
  ';line_number=' || line_number || ';bo_qty=' || qty as detail from e
union all
select distinct 'insert', 't_al_host_shipment_master', 'host_group_id=' || g || ';transaction_code=361;order_number=' || order_number from e
union all
select 'insert', 't_al_host_shipment_detail', 'host_group_id=' || e.g || ';order_number=' || e.order_number || ';item_number=' ||
  e.item_number || ';quantity_shipped=' || e.qty || ';uom=' || u.uom
from e join v_uom u on u.item_number = e.item_number and u.wh_id = e.wh_id where e.qty > 0
union all
select 'update', 't_order', 'order_number=' || order_number || ';wh_id=' || wh_id || ';status=C' from left_over
where touched = 1 and rest = 0
union all
select distinct 'send', 'outbox', 'service=EXP_CANCEL_PARTIAL_ORDER;group_id=' || g from e""",
)
def cancel_eligible_changes(s):
    s.store_order_lines()
    changes = cut.apply_cancel(
        cancel_eligible(s), s.orders(), s.order_lines(), s.items(), s.units(), s.shipments()
    )
    return ledger(
        changes,
        {
            ("update", "t_order_detail"): ("order_number", "item_number", "line_number", "bo_qty"),
            ("insert", "t_al_host_shipment_master"): ("host_group_id", "transaction_code", "order_number"),
            ("insert", "t_al_host_shipment_detail"): (
                "host_group_id", "order_number", "item_number", "quantity_shipped", "uom",
            ),
            ("update", "t_order"): ("order_number", "wh_id", "status"),
            ("send", "outbox"): ("service", "group_id"),
        },
    )


_SHIPINFO_HEAD = """(
  select md5('shipinfo|' || p.order_number || '|' || p.wh_id) as g, p.order_number, p.wh_id, p.load_id,
    case when sum(p.planned_quantity) = sum(p.picked_quantity) then 'COMPLETE' else 'PARTIAL' end as status,
    o.client_code, o.customer_id, o.display_order_number, t.type as order_type, v.vqm_profile
  from v_picks p join q_missing_followup f on f.order_number = p.load_id
  join v_orders o on p.order_number = o.order_number join v_types t on o.type_id = t.type_id
  left join v_vendor v on o.bill_to_code = v.vendor_code
  group by p.order_number, p.wh_id, p.load_id, o.client_code, o.customer_id, o.display_order_number, t.type, v.vqm_profile)"""


def _shipinfo(s):
    pending = missing.missing_followup(s.shipments(), AS_OF, days=None)
    return cut.rebuild_shipinfo(
        pending, s.orders(), s.picks(), s.vendors(), s.order_types(), s.containers(), AS_OF
    )


@query(
    "rebuild_shipinfo",
    f"""
select h.g as shipment_id, h.g as host_group_id, p.wh_id, p.line_number, p.item_number, h.client_code, c.tracking_number,
  p.order_number, h.display_order_number, h.customer_id as delivery_sap, p.item_number as display_item_number,
  p.order_number || '1' as hu_id, 'HJS' as user_id, 'EA' as uom, coalesce(sum(p.picked_quantity), 0) as quantity_shipped
from v_picks p join {_SHIPINFO_HEAD} h on h.order_number = p.order_number
left join v_cont c on p.container_id = c.container_id and p.wh_id = c.wh_id
where p.status = 'SHIPPED'
group by h.g, p.wh_id, p.line_number, p.item_number, h.client_code, c.tracking_number, p.order_number, h.display_order_number,
  h.customer_id""",
)
def rebuild_shipinfo(s):
    return _shipinfo(s).inserts["t_al_host_shipment_detail"].drop("shipment_detail_id")


@query(
    "rebuild_shipinfo_changes",
    f"""
select 'insert' as change, 't_al_host_shipment_master' as target, concat_ws(';', 'host_group_id=' || g, 'transaction_code=936',
  'order_number=' || order_number, 'status=' || status, 'order_type=' || order_type, 'delivery_sap=' || vqm_profile) as detail
from {_SHIPINFO_HEAD}
union all
select 'send', 'outbox', 'service=EXP_PRE_SHIP;group_id=' || g from {_SHIPINFO_HEAD}
union all
select 'audit', 't_tran_log_holding', 'tran_type=088;description=Shipinfo gerada normalmente ' || order_number ||
  ';control_number=' || order_number from {_SHIPINFO_HEAD}""",
)
def rebuild_shipinfo_changes(s):
    return ledger(
        _shipinfo(s),
        {
            ("insert", "t_al_host_shipment_master"): (
                "host_group_id", "transaction_code", "order_number", "status", "order_type", "delivery_sap",
            ),
            ("send", "outbox"): ("service", "group_id"),
            ("audit", "t_tran_log_holding"): ("tran_type", "description", "control_number"),
        },
    )


@query(
    "flush_invoices",
    """
select distinct host_group_id, wh_id, order_number from v_ship
where user_id = 'HJS_CORTE' and pro_number is null and transaction_code = '936'""",
)
def flush_invoices(s):
    return cut.pending_invoices(s.shipments())


@query(
    "flush_invoices_changes",
    """
select 'update' as change, 't_al_host_shipment_master' as target,
  'host_group_id=' || host_group_id || ';transaction_code=936;pro_number=P' as detail
from (select distinct host_group_id from q_flush_invoices)
union all
select 'update', 't_order', 'order_number=' || order_number || ';created_nf=Y' from (select distinct order_number from q_flush_invoices)
union all
select distinct 'send', 'outbox', 'service=EXP_PRE_SHIP;group_id=' || host_group_id from q_flush_invoices
union all
select 'audit', 't_tran_log_holding', 'tran_type=071;control_number=' || order_number || ';wh_id=' || wh_id from q_flush_invoices""",
)
def flush_invoices_changes(s):
    return ledger(
        cut.flush_invoices(s.shipments(), AS_OF),
        {
            ("update", "t_al_host_shipment_master"): ("host_group_id", "transaction_code", "pro_number"),
            ("update", "t_order"): ("order_number", "created_nf"),
            ("send", "outbox"): ("service", "group_id"),
            ("audit", "t_tran_log_holding"): ("tran_type", "control_number", "wh_id"),
        },
    )


def cut_tables(s) -> dict:
    """The test data as the table set the cut cycle reads."""
    blank = F.lit(None).cast("string")
    picks = s.picks().withColumns({"lot_number": blank, "pendency": blank, "user_assigned": blank})
    ship = s.shipments().withColumns(
        {"shipment_id": F.col("shipment_id").cast("string"), "load_id": F.col("load_id").cast("bigint")}
    )
    lines = s.shipment_lines().withColumn("shipment_id", F.col("shipment_id").cast("string"))
    return {
        "t_pick_detail": picks,
        "t_stored_item": s.stock(),
        "t_tran_log": s.tran_log(),
        "t_al_host_shipment_master": ship,
        "t_al_host_shipment_detail": lines,
        "t_location": s.locations(),
        "t_pick_area": s.pick_areas(),
        "t_exception_log": s.urgent_cut_log(),
        "t_order": s.orders().withColumn("created_nf", blank),
        "t_order_detail": s.order_lines(),
        "t_item_master": s.items(),
        "t_item_uom": s.units(),
        "t_pick_container": s.containers(),
        "t_work_q": s.tasks(),
        "t_work_q_assignment": s.assignments(),
        "t_vendor": s.vendors(),
        "v_type": s.order_types(),
        "t_sto_attrib_collection_detail": s.attribute_values(),
        "t_attribute_legacy_map": s.attribute_map(),
    }


