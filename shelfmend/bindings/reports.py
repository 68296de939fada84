"""Report and reconciliation queries over the test data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import reconcile, reports
from ..operators.audit import verify_batch
from ..plans.changeset import ledger
from .registry import query

EVENTS_FROM = datetime(2024, 1, 1)
ORDERS_FROM = datetime(1995, 1, 1)
AS_OF = datetime(2001, 12, 1)
EVENTS_AS_OF = datetime(2024, 1, 31)


@query(
    "queue_backlog",
    """
select d.scevent_name, q.status, count(*) as events
from v_queue q join v_evdef d on q.scevent_id = d.scevent_id
where q.date_added >= timestamp '2024-01-01' and q.status = 'NEW'
group by 1, 2""",
)
def queue_backlog(s):
    return reports.queue_backlog(s.queue(), s.event_definitions(), EVENTS_FROM)


@query(
    "bus_backlog",
    """
select m.l_partkey as msg_def_detail_id, m.l_linenumber as priority, max(p.p_brand) as name, count(*) as messages
from lineitem m join part p on m.l_partkey = p.p_partkey
where m.l_linestatus = 'O' and (m.l_suppkey % 10 = 0 or m.l_returnflag <> 'A') and p.p_brand <> 'Brand#7'
group by 1, 2""",
)
def bus_backlog(s):
    return reports.bus_backlog(s.bus_messages(), s.bus_details(), s.bus_masters(), "A", "Brand#7")


@query(
    "trace_events",
    """
select p.payload as host_id, q.event_id, q.date_added, q.date_started, q.date_finished, q.alert_id, q.procobject, q.status
from v_queue q join v_pay p on q.event_id = p.event_id
where p.payload in (select json_extract_string(props, '$.k') from events where event_type = 'error' and value > 120)""",
)
def trace_events(s):
    wanted = s.table("events").filter("event_type = 'error' AND value > 120")
    keys = wanted.select(F.get_json_object("props", "$.k").alias("payload"))
    return reports.trace_events(s.queue(), s.payloads(), keys)


@query(
    "trace_events_changes",
    """
select 'update' as change, 'ea_t_async_work_queue' as target,
  'event_id=' || event_id || ';status=NEW;retry_count=0;priority=10' as detail
from q_trace_events""",
)
def trace_events_changes(s):
    changes = reports.requeue_events(trace_events(s))
    return ledger(
        changes,
        {
            ("update", "ea_t_async_work_queue"): (
                "event_id", "status", "date_started", "date_finished", "retry_count", "priority",
            )
        },
    )


_LATENCY = """
select pedido, ship_al_host, ship_web_ser, nf_web_servi,
  strftime(make_timestamp(a * 1000000), '%H:%M:%S') as procs, a // 86400 as procs_days,
  strftime(make_timestamp(b * 1000000), '%H:%M:%S') as procs_al, b // 86400 as procs_al_days,
  strftime(make_timestamp(c * 1000000), '%H:%M:%S') as web_alhost, c // 86400 as web_alhost_days,
  host_group_id
from (
  select *, abs(epoch_us(nf_web_servi) - epoch_us(ship_web_ser)) // 1000000 as a,
    abs(epoch_us(nf_web_servi) - epoch_us(ship_al_host)) // 1000000 as b,
    abs(epoch_us(ship_web_ser) - epoch_us(ship_al_host)) // 1000000 as c
  from (
    select {shown} as pedido, al.record_create_date as ship_al_host, w.first_send as ship_web_ser,
      min(p.process_date) as nf_web_servi, al.host_group_id
    from v_ship al
    join v_ws p on p.webservice_id = 'EXP_PRINT_NF' and p.process_date >= timestamp '2024-01-01'
      and contains(p.soap_request, {number})
    left join (select param1, min(process_date) as first_send from v_ws group by 1) w on w.param1 = al.host_group_id
    where al.transaction_code = '936' and al.record_create_date >= timestamp '1995-01-01'
    group by all))"""


@query("invoice_latency", _LATENCY.replace("{shown}", "al.order_number").format(number="cast(al.order_number as varchar)"))
def invoice_latency(s):
    return reports.invoice_latency(s.shipments(), s.service_log(), ORDERS_FROM, EVENTS_FROM)


_LETTERED = "(case al.order_number % 3 when 0 then '' when 1 then 'r ' else ' ' end || al.order_number || ';')"


@query("invoice_latency_lettered", _LATENCY.replace("{shown}", _LETTERED).format(number=_LETTERED))
def invoice_latency_lettered(s):
    """Numbers with other characters than digits, anywhere in the request."""
    key = F.col("order_number") % 3
    front = F.when(key == 0, F.lit("")).when(key == 1, F.lit("r ")).otherwise(F.lit(" "))
    number = F.concat(front, F.col("order_number").cast("string"), F.lit(";"))
    ship = s.shipments().withColumn("order_number", number)
    return reports.invoice_latency(ship, s.service_log(), ORDERS_FROM, EVENTS_FROM)


_ARCHIVE = """
with grp as (select r_regionkey group_id, r_name as name, case when r_regionkey % 2 = 0 then 'A' else 'I' end group_status from region),
bgrp as (select n_regionkey group_id, n_nationkey + 2 backup_control_id, n_nationkey % 7 group_sequence from nation),
bcon as (
  select s_nationkey id, s_name table_name, 'C' || (s_suppkey % 3) control_type,
    case when s_acctbal < 0 then 'F' else 'S' end status,
    timestamp '2024-01-01' + to_days(cast(s_suppkey % 9 as int)) last_processed_date, s_acctbal elapsed_time
  from supplier)"""


@query(
    "archive_status",
    _ARCHIVE
    + """,
sch as (select r_regionkey group_id, r_regionkey + 1 schedule_id from region where r_name <> 'ASIA'),
sche as (select r_regionkey + 1 schedule_id, 'S_' || r_name as name, r_regionkey * 10 message_id from region),
latest as (select c_nationkey % 5 + 1 schedule_id, max(timestamp '2024-01-01' + to_minutes(c_custkey)) start_time from customer group by 1),
plans as (
  select s.group_id, e.name, e.message_id, l.start_time
  from sch s left join sche e using (schedule_id) left join latest l using (schedule_id)),
board as (
  select distinct c.table_name, c.control_type, c.status, c.last_processed_date, c.elapsed_time, g.group_id, g.name, g.group_status,
    m.group_sequence, p.name as schedule_name, p.message_id, p.start_time
  from bcon c
  left join bgrp m on c.id = m.backup_control_id and m.group_id in (select group_id from grp)
  left join grp g on g.group_id = m.group_id
  left join plans p on p.group_id = g.group_id)
select b.table_name as tabela, b.control_type as tipo, if(b.status = 'F', 'FAILURE', 'SUCCESS') as status_exec,
  b.last_processed_date as ult_exce, b.elapsed_time as time_exec, b.group_id, b.name as grupo, b.group_sequence as sequence,
  coalesce(map {'A': 'Grupo Ativo', 'I': '** Grupo Inativo'}[b.group_status], b.group_status) as status_do_gp,
  ifnull(b.schedule_name, '** Sem programação') as schedule, b.start_time,
  (select cast(floor(s_acctbal) as bigint) from supplier where s_name = b.table_name and s_acctbal >= 0) as registros,
  (select timestamp '2024-01-02' from supplier where s_name = b.table_name and s_acctbal >= 0) as last_analyzed,
  (select timestamp '2024-02-01' + to_hours(r_regionkey) from region where r_regionkey < 4 and r_regionkey * 10 = b.message_id) as prox_exec
from board b""",
)
def archive_status(s):
    return reports.archive_status(
        s.archive_groups(),
        s.archive_group_control(),
        s.archive_control(),
        s.archive_group_schedule(),
        s.archive_schedule(),
        s.archive_schedule_detail(),
        s.table_statistics(),
        s.archive_bus(),
    )


@query(
    "archive_plan",
    _ARCHIVE
    + """
select b.group_id, b.group_sequence, c.control_type as procedure_name, c.table_name, b.backup_control_id as table_id
from bgrp b join bcon c on b.backup_control_id = c.id
where b.group_id in (select group_id from grp where group_status = 'A')""",
)
def archive_plan(s):
    return reports.archive_plan(s.archive_groups(), s.archive_group_control(), s.archive_control())


@query(
    "reconcile_blocked",
    """
with held as (select item_number, wh_id, sum(actual_qty) as total, sum(unavailable_qty) as blocked from v_stock group by 1, 2),
gaps as (
  select e.item, w.wh_id, e.loc, e.stock_on_hand as sum_soh, h.total as sum_wms, e.non_sellable_qty as sum_non,
    coalesce(h.blocked, 0) as sum_wms_una, e.non_sellable_qty - coalesce(h.blocked, 0) as gap
  from v_worklist w join v_erp e on e.item = w.item_number and e.loc - 500 = w.wh_id
  left join held h on h.item_number = w.item_number and h.wh_id = w.wh_id),
signed as (
  select *, '750' as code, 'HOLD' as before, 'AVAILABLE' as after from gaps where gap > 0
  union all select *, '700', 'AVAILABLE', 'HOLD' from gaps where gap < 0)
select item, wh_id, code as transaction_code, loc, sum_soh, sum_wms, sum_non, sum_wms_una, abs(gap) as dif_erp_wms,
  before as inventory_status_before, after as inventory_status_after
from signed""",
)
def reconcile_blocked(s):
    return reconcile.reconcile_blocked(s.erp(), s.worklist(), s.stock())


@query(
    "reconcile_totals",
    """
with held as (
  select item_number, wh_id, sum(actual_qty) as total, sum(unavailable_qty) as blocked, count(*) filter (location_id = 'L1') as here
  from v_stock group by 1, 2),
both_sides as (
  select w.item_number as item, w.wh_id, e.stock_on_hand as erp, e.non_sellable_qty as erp_bad, ifnull(h.total, 0) as wms,
    ifnull(h.blocked, 0) as wms_bad, ifnull(h.here, 0) as sto_count
  from v_worklist w join v_erp e on e.item = w.item_number and e.loc - 500 = w.wh_id
  left join held h on h.item_number = w.item_number and h.wh_id = w.wh_id)
select item, wh_id, sto_count, 'INC_HJ' as status, erp - wms as dif_erp_wms, abs((erp - erp_bad) - (wms - wms_bad)) as available_gap,
  abs(erp_bad - wms_bad) as blocked_gap,
  list_extract(['DEC_RMS_IND', 'EQUALIZADO', 'INC_HJ_IND'], 2 + cast(sign(erp_bad - wms_bad) as int)) as blocked_status
from both_sides where wms < erp""",
)
def reconcile_totals(s):
    return reconcile.reconcile_totals(s.erp(), s.worklist(), s.stock(), "L1")


@query(
    "reconcile_totals_changes",
    """
select case when sto_count > 0 then 'update' else 'insert' end as change, 't_stored_item' as target,
  'item_number=' || item || ';wh_id=' || wh_id || ';location_id=L1;actual_qty=' || dif_erp_wms as detail
from q_reconcile_totals
union all
select 'insert', 't_al_host_inventory_adjustment',
  'transaction_code=' || case when blocked_status = 'INC_HJ_IND' then '750' else '700' end || ';item_number=' || item ||
  ';wh_id=' || wh_id || ';quantity_before=' || blocked_gap || ';inventory_status_before=' ||
  case when blocked_status = 'INC_HJ_IND' then 'HOLD' else 'AVAILABLE' end
from q_reconcile_totals where blocked_status <> 'EQUALIZADO'
union all
select 'audit', 't_tran_log_holding', 'tran_type=009;item_number=' || item || ';tran_qty=' || dif_erp_wms
from q_reconcile_totals""",
)
def reconcile_totals_changes(s):
    changes = reconcile.equalise_totals(reconcile_totals(s), s.stock(), "L1", "1713641", AS_OF)
    place = ("item_number", "wh_id", "location_id", "actual_qty")
    return ledger(
        changes,
        {
            ("insert", "t_stored_item"): place,
            ("update", "t_stored_item"): place,
            ("insert", "t_al_host_inventory_adjustment"): (
                "transaction_code", "item_number", "wh_id", "quantity_before", "inventory_status_before",
            ),
            ("audit", "t_tran_log_holding"): ("tran_type", "item_number", "tran_qty"),
        },
    )


_PHANTOM = """
select e.item as item_number, e.loc - 500 as wh_id, {qty} as qty, '01122001' as po
from v_erp e left join v_stock s on s.wh_id + 500 = e.loc and s.item_number = e.item
where {where} and e.stock_on_hand = 0 and e.in_transit_qty = 0
group by e.item, e.loc, e.non_sellable_qty
having sum(s.actual_qty) is null"""


@query("phantom_negative", _PHANTOM.format(qty="-e.non_sellable_qty", where="e.non_sellable_qty < 0"))
def phantom_negative(s):
    return reconcile.phantom_negative(s.erp(), s.stock(), AS_OF)


@query(
    "phantom_positive",
    _PHANTOM.format(qty="e.non_sellable_qty", where="e.non_sellable_qty > 0 and e.tsf_reserved_qty = 0"),
)
def phantom_positive(s):
    return reconcile.phantom_positive(s.erp(), s.stock(), AS_OF)


@query(
    "double_sent",
    """
select wh_id, item_number, nonse as qty_non_sellable, round(sum(qty), 2) as qty_sent, round(sum(qty) / 2, 3) as qtd_a,
  -nonse as qtd_b, case when sum(qty) / 2 = -nonse then 'OK' end as status
from (
  select a.wh_id, a.item_number, sum(a.quantity_change) as qty,
    (select e.non_sellable_qty from v_erp e where cast(e.item as varchar) = a.item_number and e.loc = a.wh_id + 500) as nonse
  from v_adj a where a.transaction_code = '192'
  group by a.item_number, a.reference_code, a.wh_id having count(distinct a.user_id) > 1)
where nonse < 0
group by wh_id, item_number, nonse""",
)
def double_sent(s):
    erp = s.erp().withColumn("item", F.col("item").cast("string"))
    found = reconcile.double_sent(s.adjustments(), erp, matched_only=False)
    return found.withColumns({"qty_sent": F.round("qty_sent", 2), "qtd_a": F.round("qtd_a", 3)})


_LADDER = """
select item_number, wh_id, qty from (
  select *, case when free < 0 then (non - soh) + (wms + po) when soh = 0 then 0
      when soh > 0 and soh = wms and non = wms then wms when wms > soh then non
      when soh > wms and free < wms then wms - free when soh = wms and free < wms then non
      when soh = wms and free = wms then 0 when free = wms then 0 when free > wms then 0 else 0.5 end as qty
  from ({totals}))
where qty > 0"""


@query(
    "releasable_qty",
    _LADDER.format(
        totals="""
  select t.item_number, t.wh_id, e.stock_on_hand as soh, e.non_sellable_qty as non,
    e.stock_on_hand - e.non_sellable_qty as free, s.wms, coalesce(p.po, 0) as po
  from v_worklist t join v_erp e on e.item = t.item_number and e.loc = t.wh_id + 500
  join (select item_number, wh_id, sum(actual_qty) as wms from v_stock where type = 'STORAGE' group by 1, 2) s
    on s.item_number = t.item_number and s.wh_id = t.wh_id
  left join (select d.item_number, d.wh_id, sum(d.qty) as po from v_pod d join v_po h on h.po_number = d.po_number
    where h.status = 'O' group by 1, 2) p on p.item_number = t.item_number and p.wh_id = t.wh_id"""
    ),
)
def releasable_qty(s):
    return reconcile.releasable_qty(s.worklist(), s.erp(), s.stock(), s.po_unavailable())


@query(
    "releasable_qty_strict",
    _LADDER.format(
        totals="""
  select t.item_number, t.wh_id, e.stock_on_hand as soh, e.non_sellable_qty as non,
    e.stock_on_hand - e.non_sellable_qty as free, sum(s.actual_qty) as wms, coalesce(sum(p.qty), 0) as po
  from v_worklist t join v_erp e on e.item = t.item_number and e.loc = t.wh_id + 500
  left join v_stock s on s.item_number = t.item_number and s.wh_id = t.wh_id
  left join (select d.item_number, d.wh_id, d.qty from v_pod d join v_po h on h.po_number = d.po_number
    where h.status = 'O') p on p.item_number = t.item_number and p.wh_id = t.wh_id
  where s.type = 'STORAGE'
  group by t.item_number, t.wh_id, e.stock_on_hand, e.non_sellable_qty"""
    ),
)
def releasable_qty_strict(s):
    return reconcile.releasable_qty(s.worklist(), s.erp(), s.stock(), s.po_unavailable(), strict=True)


@query(
    "manual_feed",
    """
select t.item_number, t.wh_id, t.qty, '700' as transaction_code, 'AVAILABLE' as inventory_status_before,
  'HOLD' as inventory_status_after,
  (select max(i.client_code) from v_items i where i.item_number = t.item_number and i.wh_id = t.wh_id) as client_code
from v_worklist t""",
)
def manual_feed(s):
    return reconcile.manual_feed(s.worklist(), s.items(), "block")


@query(
    "manual_feed_release",
    """
select t.item_number, t.wh_id, t.qty, i.client_code
from v_worklist t left join v_items i on i.item_number = t.item_number and i.wh_id = t.wh_id
where t.qty > 0""",
)
def manual_feed_release(s):
    return reconcile.manual_feed(s.worklist(), s.items(), "release")


def _blocked_candidates(s):
    return reconcile_blocked(s).withColumnsRenamed({"item": "item_number", "dif_erp_wms": "qty"})


@query(
    "emit_adjustments",
    """
select md5('CHG1|2001-12-01T00:00:00') as host_group_id, transaction_code, cast(item as varchar) as item_number,
  dif_erp_wms as quantity_before, dif_erp_wms as quantity_after, 0.0::double as quantity_change, inventory_status_before,
  inventory_status_after, '42' as reason_code, 'BLOCKED' as from_location_id, 'BLOCKED' as to_location_id,
  'CHG1' as user_id, cast(wh_id as varchar) as wh_id, timestamp '2001-12-01' as record_create_date, 'EA' as uom,
  cast(null as varchar) as reference_code, cast(item as varchar) as display_item_number, '001' as client_code
from q_reconcile_blocked""",
)
def emit_adjustments(s):
    changes = reconcile.emit_adjustments(_blocked_candidates(s), reconcile.blocked_profile("CHG1", "BLOCKED"), AS_OF)
    return changes.inserts["t_al_host_inventory_adjustment"].drop("adjustment_id")


@query(
    "emit_adjustments_changes",
    """
with c as (
  select *, md5('HJS_SG|2001-12-01T00:00:00|' || wh_id || '|' || item_number) as g from q_phantom_negative)
select 'insert' as change, 't_al_host_inventory_adjustment' as target,
  'host_group_id=' || g || ';transaction_code=192;item_number=' || item_number || ';quantity_change=' || qty ||
  ';reason_code=6;from_location_id=ATS;to_location_id=TRBL;reference_code=01122001' as detail from c
union all select 'send', 'outbox', 'service=EXP_INV_ADJUST;group_id=' || g from c
union all
select 'audit', 't_tran_log_holding',
  'tran_type=006;control_number=01122001;control_number_2=Equalização Saldo Indisp.;wh_id=' || wh_id || ';num_items=' || qty ||
  ';item_number=' || item_number || ';tran_qty=' || qty || ';elapsed_time=10.0' from c""",
)
def emit_adjustments_changes(s):
    changes = reconcile.emit_adjustments(phantom_negative(s), reconcile.phantom_negative_profile(), AS_OF)
    return ledger(
        changes,
        {
            ("insert", "t_al_host_inventory_adjustment"): (
                "host_group_id", "transaction_code", "item_number", "quantity_change", "reason_code",
                "from_location_id", "to_location_id", "reference_code",
            ),
            ("send", "outbox"): ("service", "group_id"),
            ("audit", "t_tran_log_holding"): (
                "tran_type", "control_number", "control_number_2", "wh_id", "num_items", "item_number", "tran_qty",
                "elapsed_time",
            ),
        },
    )


@query(
    "audit_rows",
    """
select '006' as tran_type, 'Equalização RMS - Sala de Guerra' as description, timestamp '2001-12-01' as start_tran_date,
  timestamp '2001-12-01' as end_tran_time, 'HJS_SG' as employee_id, po as control_number,
  'Bloqueado > 0' as control_number_2, cast(wh_id as varchar) as wh_id, qty as num_items,
  cast(item_number as varchar) as item_number, qty as tran_qty, 10.0::double as elapsed_time
from q_phantom_positive""",
)
def audit_rows(s):
    changes = reconcile.emit_adjustments(phantom_positive(s), reconcile.phantom_positive_profile(), AS_OF)
    return changes.audit.select(
        "tran_type", "description", "start_tran_date", "end_tran_time", "employee_id", "control_number",
        "control_number_2", "wh_id", "num_items", "item_number", "tran_qty", "elapsed_time",
    )


@query(
    "verify_batch",
    """
select g.host_group_id, count(a.adjustment_id) as rows_written,
  case when count(a.adjustment_id) > 0 then 'SEND' else 'FAILED' end as decision
from (select distinct param1 as host_group_id from v_ws) g left join v_adj a on a.host_group_id = g.host_group_id
group by 1""",
)
def verify_batch_query(s):
    expected = s.service_log().select(F.col("param1").alias("host_group_id"))
    return verify_batch(s.adjustments(), expected)
