"""Missing-record and duplicate queries over the test data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import duplicates, missing
from ..plans.changeset import apply_change_set, apply_update, ledger
from .registry import query
from .reports import AS_OF, EVENTS_AS_OF, ORDERS_FROM

PHRASES = ("Cannot find dispatch method", "Familia nao encontrada")
UNIT_KEY = "'hu_id=' || hu_id || ';wh_id=' || wh_id"


@query(
    "unsent_adjustments",
    """
select a.adjustment_id, a.host_group_id, a.transaction_code, a.item_number, a.wh_id, a.quantity_change, a.user_id,
  a.reference_code, a.record_create_date, e.error_message
from v_adj a left join v_err e on a.host_group_id = e.location_id
where a.record_create_date >= timestamp '2024-01-01'
  and not exists (select 1 from v_ws w where w.webservice_id = 'EXP_INV_ADJUST' and w.param1 = a.host_group_id)""",
)
def unsent_adjustments(s):
    return missing.unsent_adjustments(s.adjustments(), s.send_errors(), s.service_log(), EVENTS_AS_OF, days=30)


@query(
    "unsent_adjustments_changes",
    """
with g as (select distinct host_group_id as g from q_unsent_adjustments)
select 'update' as change, 't_exception_log' as target,
  'location_id=' || g || ';status=CLOSED;tracking_number=31/01/2024 00:00:00' as detail from g
union all select 'send', 'outbox', 'service=EXP_INV_ADJUST;group_id=' || g from g""",
)
def unsent_adjustments_changes(s):
    changes = missing.resend_adjustments(unsent_adjustments(s), EVENTS_AS_OF)
    return ledger(
        changes,
        {
            ("update", "t_exception_log"): ("location_id", "status", "tracking_number"),
            ("send", "outbox"): ("service", "group_id"),
        },
    )


@query(
    "tasks_without_hu",
    """
select 'T_WORK_Q' as table_name, timestamp '2001-12-01' as create_date, '001' as error_code, w.wh_id, w.work_q_id,
  w.pick_ref_number as hu_id, w.from_location_id as location_id
from v_work w
where w.work_type = '06' and w.work_status = 'U' and w.pick_ref_number is not null
  and not exists (select 1 from v_hu h where h.hu_id = w.pick_ref_number and h.wh_id = w.wh_id
    and h.location_id = w.from_location_id)""",
)
def tasks_without_hu(s):
    return missing.tasks_without_hu(s.tasks(), s.handling_units(), AS_OF)


@query(
    "tasks_without_hu_changes",
    """
select 'insert' as change, 'tmp_inconsistency' as target, 'host_group_id=' || md5('tasks_without_hu|2001-12-01T00:00:00') ||
  ';error_code=001;wh_id=' || wh_id || ';hu_id=' || hu_id || ';work_q_id=' || work_q_id as detail
from q_tasks_without_hu
union all
select 'update', 't_work_q', 'work_q_id=' || work_q_id || ';work_status=C;employee_id=HJS' from q_tasks_without_hu""",
)
def tasks_without_hu_changes(s):
    changes = missing.close_tasks_without_hu(tasks_without_hu(s), AS_OF)
    return ledger(
        changes,
        {
            ("insert", "tmp_inconsistency"): ("host_group_id", "error_code", "wh_id", "hu_id", "work_q_id"),
            ("update", "t_work_q"): ("work_q_id", "work_status", "employee_id"),
        },
    )


@query(
    "missing_followup",
    """
select distinct a.order_number, a.wh_id from v_ship a
where a.transaction_code = '340'
  and not exists (select 1 from v_ship b where b.order_number = a.order_number and b.wh_id = a.wh_id
    and b.transaction_code = '936')""",
)
def missing_followup(s):
    return missing.missing_followup(s.shipments(), AS_OF, days=None)


@query(
    "unposted_preship",
    """
select m.order_number, m.host_group_id, m.transaction_code from v_ship m
where m.transaction_code = '936' and m.record_create_date >= timestamp '1995-01-01'
  and not exists (select 1 from orders o where o.o_orderstatus <> 'O' and o.o_orderpriority <> '3-MEDIUM'
    and '499.' || lpad(cast(o.o_orderkey as varchar), 20, '0') = '499.' || lpad(m.display_order_number, 20, '0'))
  and not exists (select 1 from orders o where o.o_orderstatus = 'O' and o.o_totalprice > 200000
    and '499.' || lpad(cast(o.o_orderkey as varchar), 20, '0') = '499.' || lpad(m.display_order_number, 20, '0'))""",
)
def unposted_preship(s):
    return missing.unposted_preship(s.shipments(), s.fiscal_headers(), s.fiscal_notices(), ORDERS_FROM)


@query(
    "unposted_preship_changes",
    """
select 'update' as change, 't_al_host_shipment_master' as target, 'host_group_id=' || host_group_id || ';po_number=REENVIO' as detail
from (select distinct host_group_id from q_unposted_preship)
union all
select 'send', 'outbox', 'service=EXP_PRE_SHIP;group_id=' || host_group_id
from (select distinct host_group_id from q_unposted_preship)""",
)
def unposted_preship_changes(s):
    changes = missing.resend_preship(unposted_preship(s))
    return ledger(
        changes,
        {
            ("update", "t_al_host_shipment_master"): ("host_group_id", "po_number"),
            ("send", "outbox"): ("service", "group_id"),
        },
    )


@query(
    "failed_preship",
    "\nunion all\n".join(
        f"""
select distinct m.host_group_id, m.order_number, m.wh_id, '{p}' as error_type from v_ship m
where m.transaction_code = '936' and m.record_create_date >= timestamp '1995-01-01'
  and not exists (select 1 from v_ws w where w.param1 = m.host_group_id and contains(w.soap_respond, 'SuccessStatus'))
  and exists (select 1 from v_ws w where w.param1 = m.host_group_id and contains(w.soap_respond, '{p}'))"""
        for p in PHRASES
    ),
)
def failed_preship(s):
    return missing.failed_preship(s.shipments(), s.service_log(), ORDERS_FROM, PHRASES)


@query(
    "failed_preship_changes",
    """
select distinct 'send' as change, 'outbox' as target, 'service=EXP_PRE_SHIP;group_id=' || host_group_id as detail
from q_failed_preship
union all
select 'audit', 't_tran_log_holding', 'tran_type=086;description=Reenvio ShipInfo;control_number=' || order_number ||
  ';control_number_2=' || error_type || ';wh_id=' || wh_id
from q_failed_preship""",
)
def failed_preship_changes(s):
    changes = missing.resend_failed_preship(failed_preship(s), AS_OF)
    return ledger(
        changes,
        {
            ("send", "outbox"): ("service", "group_id"),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "description", "control_number", "control_number_2", "wh_id",
            ),
        },
    )


@query(
    "missing_holds",
    """
select t.wh_id, t.item_number, t.location_id, t.actual_qty, t.type, t.lot_number, t.stored_attribute_id, t.hu_id
from v_stock t join v_loc l on t.location_id = l.location_id and t.wh_id = l.wh_id and l.type <> 'F'
where t.status = 'H' and not exists (
  select 1 from v_holds h where h.item_number = t.item_number and h.wh_id = t.wh_id and h.location_id = t.location_id
    and (h.lot_number = t.lot_number or (h.lot_number is null and t.lot_number is null)))""",
)
def missing_holds(s):
    return missing.missing_holds(s.stock(), s.locations(), s.holds()).select(
        "wh_id", "item_number", "location_id", "actual_qty", "type", "lot_number", "stored_attribute_id", "hu_id"
    )


@query(
    "missing_holds_changes",
    """
select 'insert' as change, 't_holds' as target, concat_ws(';', 'item_number=' || item_number, 'wh_id=' || wh_id,
  'location_id=' || location_id, 'lot_number=' || lot_number, 'type=' || type, 'hu_id=' || hu_id, 'reason_id=04',
  'employee_id=T1') as detail
from q_missing_holds
union all
select 'audit', 't_tran_log_holding', concat_ws(';', 'tran_type=999', 'start_tran_date=2001-12-01 00:00:00',
  'start_tran_time=2001-12-01 00:00:00', 'hu_id=' || hu_id, 'location_id=' || location_id, 'item_number=' || item_number,
  'tran_qty=' || actual_qty)
from q_missing_holds""",
)
def missing_holds_changes(s):
    changes = missing.add_holds(missing_holds(s), AS_OF, "T1")
    return ledger(
        changes,
        {
            ("insert", "t_holds"): (
                "item_number", "wh_id", "location_id", "lot_number", "type", "hu_id", "reason_id", "employee_id",
            ),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "start_tran_date", "start_tran_time", "hu_id", "location_id", "item_number", "tran_qty",
            ),
        },
    )


_WATCHED = """
from v_hu h
where h.container_type is null and h.location_id <> 'L0'
  and (contains(h.location_id, 'L1') or contains(h.location_id, 'L2') or h.location_id = 'L33')
  and h.load_id in (select vendor_code from v_po)"""

_WATCH = dict(containing=("L1", "L2"), equal=("L33",), excluded="L0")


def _loads(s):
    """Known loads: the vendors of the purchase orders."""
    return s.purchase_orders().select(F.col("vendor_code").alias("display_po_number"))


@query(
    "unread_containers",
    f"""
select h.hu_id, h.wh_id, h.location_id, h.control_number, h.load_id, 'SEM IN DATA' as error_program {_WATCHED}
  and not exists (select 1 from v_tran t where t.hu_id = h.hu_id and t.wh_id = h.wh_id)""",
)
def unread_containers(s):
    return missing.unread_containers(s.handling_units(), _loads(s), s.tran_log(), **_WATCH)


@query(
    "unread_containers_changes",
    f"""
select 'insert' as change, 't_exception_log' as target, concat_ws(';', 'tran_type=874', 'wh_id=' || wh_id, 'load_id=' || load_id,
  'line_number=' || control_number, 'location_id=' || location_id, 'error_message=SEM IN DATA') as detail
from q_unread_containers
union all
select 'update', 't_hu_master', {UNIT_KEY} || ';container_type=CX' from q_unread_containers""",
)
def unread_containers_changes(s):
    changes = missing.type_containers(unread_containers(s), AS_OF, "SEM IN DATA")
    return ledger(
        changes,
        {
            ("insert", "t_exception_log"): (
                "tran_type", "wh_id", "load_id", "line_number", "location_id", "error_message",
            ),
            ("update", "t_hu_master"): ("hu_id", "wh_id", "container_type"),
        },
    )


@query(
    "read_after_divert",
    f"""
select *, case when last_read > first_divert then 'ERRO' else 'OK' end as error_program from (
  select h.hu_id, h.wh_id, h.location_id, h.control_number, h.load_id,
    (select date_trunc('second', max(t.start_tran_date)) from v_tran t
      where t.hu_id = h.hu_id and t.wh_id = h.wh_id and t.tran_type = '411') as last_read,
    (select date_trunc('second', min(t.start_tran_date)) from v_tran t
      where t.hu_id = h.hu_id and t.wh_id = h.wh_id and t.tran_type = '410') as first_divert
  {_WATCHED})""",
)
def read_after_divert(s):
    return missing.read_after_divert(s.handling_units(), _loads(s), s.tran_log(), **_WATCH)


@query(
    "detach_orders",
    """
select m.host_group_id, m.order_number, m.wh_id, m.customer_po_number,
  md5(concat_ws('|', m.host_group_id, m.order_number, m.wh_id, m.customer_po_number)) as new_guid
from v_ordmsg m
where m.host_group_id in (select host_group_id from v_pomsg)
  and exists (select 1 from v_orders o where o.order_number = m.order_number)
  and not exists (select 1 from v_po p where p.display_po_number = m.customer_po_number)""",
)
def detach_orders(s):
    return missing.detach_orders(s.order_messages(), s.po_messages(), s.orders(), s.purchase_orders())


@query(
    "detach_orders_changes",
    """
select 'order_header' as kind, coalesce(d.new_guid, m.host_group_id) as host_group_id, m.order_number,
  case when d.new_guid is not null then cast(m.order_number as varchar) end as display_order_number, count(*) as n
from v_ordmsg m left join q_detach_orders d on d.order_number = m.order_number and d.wh_id = m.wh_id
  and d.host_group_id = m.host_group_id and d.customer_po_number = m.customer_po_number
group by all
union all
select 'order_line', coalesce(d.new_guid, 'G' || (l.l_orderkey % 100)), l.l_orderkey,
  case when d.new_guid is not null then cast(l.l_orderkey as varchar) end, count(*)
from lineitem l left join q_detach_orders d on d.order_number = l.l_orderkey
group by all
union all
select 'IMP_PO_ALLOC', host_group_id, cast(null as bigint), cast(null as varchar), 1 from (select distinct host_group_id from v_pomsg)""",
)
def detach_orders_changes(s):
    """The messages after the repair, counted per group and order, and the documents to queue."""
    changes = missing.apply_detach(detach_orders(s), s.po_messages())
    header = s.order_messages().withColumn("display_order_number", F.lit(None).cast("string"))
    after = apply_change_set(
        {"t_al_host_order_master": header, "t_al_host_order_detail": s.order_message_lines()}, changes
    )

    def counted(table, kind):
        return after[table].groupBy(
            F.lit(kind).alias("kind"), "host_group_id", "order_number", "display_order_number"
        ).agg(F.count(F.lit(1)).alias("n"))

    sent = after["outbox"].select(
        F.col("service").alias("kind"),
        F.col("group_id").alias("host_group_id"),
        F.lit(None).cast("bigint").alias("order_number"),
        F.lit(None).cast("string").alias("display_order_number"),
        F.lit(1).cast("bigint").alias("n"),
    )
    return counted("t_al_host_order_master", "order_header").unionByName(
        counted("t_al_host_order_detail", "order_line")
    ).unionByName(sent)


@query(
    "fill_fulfilment",
    """
select distinct r.po_number, r.wh_id, r.host_group_id, p.fulfillment_id
from v_receipts r join v_po p on p.po_number = r.po_number and p.wh_id = r.wh_id
where r.po_number in (select po_number from v_po where type_id = '1-URGENT') and r.fulfillment_id = '0'""",
)
def fill_fulfilment(s):
    return missing.fill_fulfilment(s.receipts(), s.purchase_orders(), "1-URGENT")


@query(
    "fill_fulfilment_changes",
    """
select 'update' as change, 't_al_host_receipt' as target, 'host_group_id=' || host_group_id || ';po_number=' || po_number ||
  ';wh_id=' || wh_id || ';fulfillment_id=' || fulfillment_id as detail
from q_fill_fulfilment
union all
select distinct 'send', 'outbox', 'service=EXP_DESFAZIMENTO;group_id=' || host_group_id from q_fill_fulfilment""",
)
def fill_fulfilment_changes(s):
    changes = missing.apply_fulfilment(fill_fulfilment(s))
    return ledger(
        changes,
        {
            ("update", "t_al_host_receipt"): ("host_group_id", "po_number", "wh_id", "fulfillment_id"),
            ("send", "outbox"): ("service", "group_id"),
        },
    )


@query(
    "fix_reservation",
    """
select distinct h.hu_id, h.wh_id, p.line_number, h.location_id,
  case when o.cust_part = o.wh_id then 'SHIP' else 'TRANSF_' || o.cust_part end as new_reserved
from v_hu h join v_stock t on t.hu_id = h.hu_id and t.wh_id = h.wh_id
join v_picks p on cast(p.pick_id as varchar) = t.type and p.wh_id = t.wh_id
join v_od o on o.order_number = p.order_number and o.line_number = p.line_number and o.item_number = p.item_number
where h.reserved_for = 'TSFCON' and h.control_number is null
  and h.location_id not in ('RECE_TRANSF', 'PRE_RECE_TRANSF')""",
)
def fix_reservation(s):
    return missing.fix_reservation(s.handling_units(), s.stock(), s.picks(), s.order_lines())


@query(
    "fix_reservation_changes",
    f"""
select 'update' as change, 't_hu_master' as target,
  {UNIT_KEY} || ';control_number=' || last.l || ';reserved_for=' || last.r as detail
from (select hu_id, wh_id, max({{'l': line_number, 'r': new_reserved}}) as last from q_fix_reservation group by 1, 2)
union all
select 'audit', 't_tran_log_holding', 'tran_type=999;control_number_2=' || new_reserved || ';line_number=' || line_number ||
  ';hu_id=' || hu_id || ';location_id=' || location_id
from q_fix_reservation""",
)
def fix_reservation_changes(s):
    changes = missing.apply_reservation(fix_reservation(s), AS_OF, "T1")
    return ledger(
        changes,
        {
            ("update", "t_hu_master"): ("hu_id", "wh_id", "control_number", "reserved_for"),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "control_number_2", "line_number", "hu_id", "location_id",
            ),
        },
    )


_STORES = "(select s_suppkey % 5 wh_id, 'CTN_LJ_' || substring('LOJA' || lpad(cast(s_suppkey as varchar), 3, '0'), 5, 3)"


@query(
    "missing_location_rows",
    f"""
select s.wh_id, s.loc as location_id, 'EST_STG_SS' as related_location_id, 'CARTON_SHIP' as relation_type, 'ALL' as zone,
  'ALL' as status
from {_STORES} || '.1' as loc from supplier) s
where not exists (select 1 from supplier x where x.s_acctbal >= 3000 and x.s_suppkey % 5 = s.wh_id
  and 'CTN_LJ_' || lpad(cast(x.s_suppkey as varchar), 3, '0') || '.1' = s.loc)""",
)
def missing_location_rows(s):
    return missing.missing_location_rows(s.stores(), s.store_locations(), strict=True)


@query(
    "missing_zone_rows",
    f"""
select s.wh_id, 'ALL' as zone, s.loc as location_id
from {_STORES} || '.3' as loc from supplier) s
where not exists (select 1 from v_loc l where l.location_id = s.loc and l.wh_id = s.wh_id)""",
)
def missing_zone_rows(s):
    return missing.missing_location_rows(s.stores(), s.locations(), ".3", "zone", strict=True)


@query(
    "orphan_stock",
    """
select type, wh_id, reserved_for, control_number, alloc1, item_number, sum(actual_qty) as actual_qty from (
  select t.hu_id, t.item_number, t.actual_qty, t.type, t.wh_id, h.reserved_for, h.control_number,
    (select max(a.control_number) from v_alloc a where a.tran_type = '351' and a.hu_id = t.hu_id and a.wh_id = t.wh_id) as alloc1
  from v_stock t join v_hu h on t.hu_id = h.hu_id and t.wh_id = h.wh_id
  where t.type <> 'STORAGE' and t.location_id not in ('PRE_RECE_TRANSF')
    and not exists (select 1 from v_picks p where cast(p.pick_id as varchar) = t.type and p.wh_id = t.wh_id)) b
where alloc1 is not null and not exists (select 1 from v_picks p where p.order_number = b.alloc1
  and p.line_number = b.control_number and p.wh_id = b.wh_id)
group by 1, 2, 3, 4, 5, 6""",
)
def orphan_stock(s):
    return missing.orphan_stock(s.stock(), s.handling_units(), s.picks(), s.allocations())


@query(
    "orphan_stock_changes",
    """
with n as (
  select *, row_number() over (
    order by wh_id, alloc1, control_number nulls first, item_number, type, reserved_for nulls first) - 1 + 50000000 as id
  from q_orphan_stock)
select 'insert' as change, 't_work_q' as target, 'work_q_id=' || id || ';work_type=03;work_status=U;wh_id=' || wh_id as detail from n
union all
select 'insert', 't_pick_detail', concat_ws(';', 'pick_id=' || type, 'order_number=' || alloc1, 'line_number=' || control_number,
  'work_q_id=' || id, 'status=RELEASED', 'item_number=' || item_number, 'planned_quantity=' || actual_qty, 'wave_id=WAVE-') from n""",
)
def orphan_stock_changes(s):
    changes = missing.create_orphan_picks(orphan_stock(s), AS_OF, 50_000_000)
    return ledger(
        changes,
        {
            ("insert", "t_work_q"): ("work_q_id", "work_type", "work_status", "wh_id"),
            ("insert", "t_pick_detail"): (
                "pick_id", "order_number", "line_number", "work_q_id", "status", "item_number", "planned_quantity",
                "wave_id",
            ),
        },
    )


@query(
    "sorter_returns",
    """
select l.location_id, l.location_id_2, l.wh_id, l.item_number, l.hu_id, round(sum(l.tran_qty), 2) as qty
from v_tran l
where l.tran_type = '317' and l.location_id not in ('RAIL_BUF1', 'RAIL_BUF2')
  and not exists (select 1 from v_hu h where h.hu_id = l.hu_id and h.wh_id = l.wh_id)
  and not exists (select 1 from v_tran r where r.tran_type = '024' and r.hu_id = l.hu_id and r.item_number = l.item_number)
group by 1, 2, 3, 4, 5""",
)
def sorter_returns(s):
    found = missing.sorter_returns(
        s.tran_log(), s.handling_units(), EVENTS_AS_OF, days=None, returned_on=("hu_id", "item_number")
    )
    return found.withColumn("qty", F.round("qty", 2))


@query(
    "sorter_returns_changes",
    f"""
select distinct 'update' as change, 't_hu_master' as target, {UNIT_KEY} || ';reserved_for=BUFFER;container_type=EN' as detail
from q_sorter_returns
union all
select 'audit', 't_tran_log_holding', 'tran_type=024;control_number=T1;hu_id=' || hu_id || ';location_id=' ||
  location_id_2 || ';location_id_2=' || location_id || ';item_number=' || item_number
from q_sorter_returns""",
)
def sorter_returns_changes(s):
    _, changes = missing.return_from_sorter(sorter_returns(s), EVENTS_AS_OF, "T1")
    return ledger(
        changes,
        {
            ("update", "t_hu_master"): ("hu_id", "wh_id", "reserved_for", "container_type"),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "control_number", "hu_id", "location_id", "location_id_2", "item_number",
            ),
        },
    )


def _text_items(frame):
    return frame.withColumn("item_number", F.col("item_number").cast("string"))


@query(
    "barcode_to_item",
    """
select a.item_number as upc, a.adjustment_id, a.host_group_id, a.wh_id, cast(u.item_number as varchar) as item_number
from v_adj a join v_upc u on a.item_number = u.upc and a.wh_id = u.wh_id
where not exists (select 1 from v_items i where cast(i.item_number as varchar) = a.item_number and i.wh_id = a.wh_id)""",
)
def barcode_to_item(s):
    return missing.barcode_to_item(s.adjustments(), _text_items(s.barcodes()), _text_items(s.items()))


@query(
    "barcode_to_item_changes",
    """
select a.adjustment_id, coalesce(b.item_number, a.item_number) as item_number, b.item_number as display_item_number,
  case when b.upc is not null then 'Problema T1' end as gen_attribute_value1, b.upc as gen_attribute_value2
from v_adj a left join (
  select adjustment_id, max(item_number) as item_number, max(upc) as upc from q_barcode_to_item group by 1) b
  on b.adjustment_id = a.adjustment_id""",
)
def barcode_to_item_changes(s):
    """Every adjustment after the repair."""
    blank = F.lit(None).cast("string")
    table = s.adjustments().select(
        "adjustment_id", "item_number", blank.alias("display_item_number"), blank.alias("gen_attribute_value1"),
        blank.alias("gen_attribute_value2"),
    )
    changes = missing.apply_barcodes(barcode_to_item(s), "T1")
    return apply_update(table, changes.updates["t_al_host_inventory_adjustment"])


@query(
    "gtin_backfill",
    """
select u.item_number, u.wh_id, max(c.upc) as upc
from (select distinct item_number, wh_id from v_uom where gtin is null) u
join v_upc c on c.item_number = u.item_number and c.wh_id = u.wh_id
group by 1, 2 having count(distinct c.upc) = 1""",
)
def gtin_backfill(s):
    return missing.gtin_backfill(s.units(), s.barcodes())


@query(
    "gtin_backfill_changes",
    """
select u.item_number, u.wh_id, u.uom, coalesce(u.gtin, g.upc) as gtin
from v_uom u left join q_gtin_backfill g on g.item_number = u.item_number and g.wh_id = u.wh_id""",
)
def gtin_backfill_changes(s):
    """Every item unit after the backfill."""
    table = s.units().select("item_number", "wh_id", "uom", "gtin")
    return apply_update(table, missing.apply_gtin(gtin_backfill(s), AS_OF).updates["t_item_uom"])


def _dup_sql(cols: str, rows: str) -> str:
    listed = ", ".join(f"p.{c}" for c in cols.split(", "))
    return f"""
select distinct {listed}, d.copies, p.pick_id
from ({rows}) p join (
  select {cols}, count(*) as copies, min(pick_id) as kept from ({rows}) group by {cols} having count(*) > 1) d
  using ({cols})
where p.pick_id <> d.kept"""


@query(
    "dup_picks", _dup_sql("item_number, order_number, wh_id", "select * from v_picks where type = 'PP'")
)
def dup_picks(s):
    return duplicates.dup_picks(s.picks(), keys=("item_number", "order_number", "wh_id"))


@query(
    "dup_picks_strict",
    """
select d.item_number, d.order_number, d.wh_id, m.pick_id, d.copies
from (select item_number, order_number, wh_id, count(*) as copies from v_picks where type = 'PP' group by 1, 2, 3
  having count(*) > 1) d
join (select item_number, order_number, wh_id, max(pick_id) as pick_id from v_picks group by 1, 2, 3) m
  using (item_number, order_number, wh_id)""",
)
def dup_picks_strict(s):
    return duplicates.dup_picks(s.picks(), keys=("item_number", "order_number", "wh_id"), strict=True)


@query(
    "dup_picks_prereceipt",
    _dup_sql(
        "order_number, wh_id",
        """select p.* from v_picks p where p.type = 'PP' and p.status = 'RELEASED' and p.pick_id in (
    select k.pick_id from v_stock t join v_hu h on t.hu_id = h.hu_id and t.wh_id = h.wh_id and h.parent_hu_id is not null
    join v_picks k on k.line_number = h.control_number and k.order_number = t.serial_number
      and k.item_number = t.item_number and k.wh_id = t.wh_id)""",
    ),
)
def dup_picks_prereceipt(s):
    return duplicates.dup_picks_prereceipt(
        s.picks(), s.stock(), s.handling_units(), keys=("order_number", "wh_id")
    )


@query(
    "dup_log",
    """
select t.control_number, t.item_number, t.wh_id, t.tran_log_id, d.copies, d.latest
from v_tran t join (
  select control_number, item_number, wh_id, count(distinct tran_log_id) as copies, min(tran_log_id) as kept,
    max(date_trunc('second', start_tran_date)) as latest
  from v_tran where tran_type = '361' group by 1, 2, 3 having count(distinct tran_log_id) > 1) d
  using (control_number, item_number, wh_id)
where t.tran_type = '361' and t.tran_log_id <> d.kept""",
)
def dup_log(s):
    return duplicates.dup_log(
        s.tran_log(), EVENTS_AS_OF, days=None, keys=("control_number", "item_number", "wh_id")
    )


@query(
    "dup_log_changes",
    """
select tran_log_id, tran_type, item_number from v_tran
where tran_log_id not in (select tran_log_id from q_dup_log)""",
)
def dup_log_changes(s):
    """The log without the surplus copies."""
    changes = duplicates.delete_log(dup_log(s), EVENTS_AS_OF)
    return apply_change_set({"t_tran_log": s.tran_log()}, changes)["t_tran_log"].select(
        "tran_log_id", "tran_type", "item_number"
    )


@query(
    "surplus_tasks",
    """
select work_q_id, location_id, wh_id, open_tasks, kept_id from (
  select *, row_number() over (partition by location_id, wh_id order by work_q_id desc) as rn,
    count(*) over (partition by location_id, wh_id) as open_tasks,
    max(work_q_id) over (partition by location_id, wh_id) as kept_id
  from v_work where work_status = 'U' and work_type = '80')
where rn > 1""",
)
def surplus_tasks(s):
    return duplicates.surplus_tasks(s.tasks())


@query(
    "surplus_tasks_changes",
    """
select location_id, wh_id, count(*) filter (work_status = 'U') as open_tasks, count(*) as tasks
from (
  select w.work_q_id, w.location_id, w.wh_id, case when t.work_q_id is not null then 'C' else w.work_status end as work_status
  from v_work w left join q_surplus_tasks t on t.work_q_id = w.work_q_id where w.work_type = '80')
group by 1, 2""",
)
def surplus_tasks_changes(s):
    """Open tasks per location once the surplus is closed: at most one."""
    after = apply_update(s.tasks(), duplicates.close_tasks(surplus_tasks(s)).updates["t_work_q"])
    return after.filter("work_type = '80'").groupBy("location_id", "wh_id").agg(
        F.count(F.when(F.col("work_status") == "U", 1)).alias("open_tasks"), F.count(F.lit(1)).alias("tasks")
    )

