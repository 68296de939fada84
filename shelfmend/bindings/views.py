"""SQL twins of the sample views, for the oracle."""

PID = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"

VIEWS = {
    "v_picks": f"""
select {PID} pick_id, l_orderkey order_number, l_linenumber line_number, l_partkey item_number, l_orderkey % 5 wh_id,
  l_quantity planned_quantity, case when l_returnflag = 'R' then 0 else l_quantity end picked_quantity,
  case l_returnflag when 'R' then 'RELEASED' when 'A' then 'PICKED' else 'SHIPPED' end status,
  case when l_linestatus = 'O' then 'PP' else 'RE' end as type, year(l_shipdate) * 100 + month(l_shipdate) wave_id,
  l_orderkey work_q_id, l_orderkey load_id, l_suppkey container_id, l_suppkey % 25 pick_area, l_shipdate create_date
from lineitem""",
    "v_stock": f"""
select {PID} as sequence, l_partkey item_number, l_suppkey % 5 wh_id, 'L' || l_suppkey location_id,
  case when l_linenumber < 7 then 'HU' || l_orderkey end hu_id, l_quantity actual_qty,
  case when l_returnflag = 'R' then l_quantity else 0 end unavailable_qty,
  case when l_linenumber % 2 = 0 then 'LOT' || l_linenumber end lot_number,
  case when l_returnflag = 'R' then 'STORAGE' when l_returnflag = 'N' and l_linenumber < 4 then 'STORAGE'
    when l_linenumber = 3 then 'X' || {PID} else cast({PID} as varchar) end as type,
  case when l_returnflag = 'R' then 'H' else 'A' end status, l_orderkey serial_number, l_partkey stored_attribute_id,
  l_shipdate fifo_date
from lineitem where l_linestatus = 'O'""",
    "v_erp": """
select l_partkey item, l_suppkey % 5 + 500 loc,
  sum(case when l_returnflag = 'N' then l_quantity else 0 end) stock_on_hand,
  sum(case when l_returnflag = 'R' then l_quantity when l_linenumber = 7 then -2 * l_quantity else 0 end) non_sellable_qty,
  sum(case when l_linenumber = 1 then l_quantity else 0 end) in_transit_qty,
  sum(case when l_linenumber = 6 then l_quantity else 0 end) tsf_reserved_qty
from lineitem where l_linestatus = 'F' group by 1, 2""",
    "v_worklist": "select p_partkey item_number, p_partkey % 5 wh_id, p_size qty from part",
    "v_items": """
select p_partkey item_number, w.wh_id, p_partkey % 4 client_code, case when p_size % 2 = 0 then 'N' else 'Y' end lot_control,
  p_name display_item_number, p_partkey * 10 + w.wh_id item_master_id
from part, range(5) w(wh_id)""",
    "v_upc": """
select c.p_partkey item_number, w.wh_id, c.upc from (
  select p_partkey, '90000' || p_partkey upc from part
  union all select p_partkey, '80000' || p_partkey from part where p_size > 40) c, range(5) w(wh_id)""",
    "v_uom": """
select p_partkey item_number, w.wh_id, case when p_size % 2 = 0 then 'EA' else 'CX' end uom, p_size conversion,
  case when p_size % 3 <> 0 then '90000' || p_partkey end gtin
from part, range(5) w(wh_id)""",
    "v_loc": """
select 'L' || s_suppkey location_id, s_suppkey % 5 wh_id, case when s_acctbal < 0 then 'I' else 'E' end status,
  case when s_nationkey % 5 = 0 then 'F' else 'O' end as type, s_nationkey pick_area
from supplier""",
    "v_area": "select n_nationkey pick_area, w.wh_id from nation, range(5) w(wh_id) where n_regionkey <> 0",
    "v_cli": """
select s_suppkey % 5 wh_id, s_suppkey % 4 client_code, 'LOC_RECEB_IA' control_type, max('L' || s_suppkey) c1
from supplier group by 1, 2
union all
select s_suppkey % 5, s_suppkey % 4, 'LOC_RECEB_SI', min('L' || s_suppkey) from supplier group by 1, 2""",
    "v_hu": """
select 'HU' || o_orderkey hu_id, o_orderkey % 5 wh_id, 'L' || (o_custkey % 50) location_id,
  case when o_orderpriority <> '5-LOW' then 'CX' end container_type, o_custkey load_id,
  case when o_orderpriority = '1-URGENT' then 'TSFCON' end reserved_for,
  case when o_orderpriority <> '1-URGENT' or o_totalprice > 250000 then o_orderkey % 7 + 1 end control_number,
  'P' || o_custkey parent_hu_id, o_orderpriority as zone
from orders where o_orderstatus <> 'P'""",
    "v_exc": """
select pick_id exception_id, '033' tran_type, 'PRO_E' lot_number, order_number control_number, item_number, wh_id,
  planned_quantity quantity, wave_id load_id, cast(null as varchar) status, cast(null as varchar) suggested_value,
  create_date exception_date
from v_picks where status = 'RELEASED' and type = 'PP'""",
    "v_err": """
select event_id exception_id, 'G' || (event_id - event_id % 4) location_id, 'E' || user_id error_message
from events where event_type = 'error'""",
    "v_tran": """
select event_id tran_log_id, case event_type when 'view' then '411' when 'click' then '410' when 'purchase' then '317'
    when 'signup' then '361' else '024' end tran_type,
  event_type as description, 'E' || (user_id % 10) employee_id, 'HU' || user_id hu_id, user_id control_number,
  user_id % 5 wh_id, cast(json_extract_string(props, '$.k') as bigint) item_number, value tran_qty,
  'L' || json_extract_string(props, '$.k') location_id, 'RAIL' || (user_id % 3) location_id_2,
  ts start_tran_date, ts start_tran_time
from events""",
    "v_alloc": """
select '351' tran_type, 'HU' || o_orderkey hu_id, o_orderkey % 5 wh_id, o_custkey control_number from orders""",
    "v_queue": """
select event_id, event_type scevent_id, event_type procobject,
  case when value < 20 then 'NEW' when value < 60 then 'SUCCESS' else 'ERROR' end status, ts date_added,
  case when value > 10 then ts end date_started, cast(null as timestamp) date_finished,
  event_id % 4 priority, user_id % 3 retry_count, cast(null as bigint) alert_id, cast(null as varchar) claim_id
from events""",
    "v_pay": "select event_id, json_extract_string(props, '$.k') payload from events",
    "v_evdef": "select distinct event_type scevent_id, upper(event_type) scevent_name from events",
    "v_ship": """
select o_orderkey shipment_id, 'G' || o_orderkey host_group_id,
  case o_orderstatus when 'F' then '936' when 'O' then '340' else '360' end transaction_code,
  o_orderkey order_number, cast(o_orderkey as varchar) display_order_number, o_orderkey % 5 wh_id,
  o_orderdate record_create_date, o_custkey load_id,
  case when o_totalprice > 300000 then 'HJS_CORTE' else 'HJS' end user_id,
  case when o_orderpriority = '2-HIGH' then 'P' end pro_number
from orders where o_orderpriority <> '4-NOT SPECIFIED'
union all
select -1 - o_orderkey, 'H' || o_orderkey, '936', o_orderkey, cast(o_orderkey as varchar), o_orderkey % 5, o_orderdate,
  o_custkey, case when o_totalprice > 300000 then 'HJS_CORTE' else 'HJS' end,
  case when o_orderpriority = '2-HIGH' then 'P' end
from orders where o_orderstatus = 'O' and o_orderpriority = '1-URGENT'""",
    "v_shipdet": f"""
select {PID} shipment_detail_id, l_orderkey shipment_id, l_orderkey order_number, l_orderkey % 5 wh_id,
  l_partkey item_number, l_linenumber line_number, l_quantity quantity_shipped, 'HU' || l_orderkey hu_id,
  l_partkey % 4 client_code, 'G' || l_orderkey host_group_id, l_shipdate record_create_date
from lineitem""",
    "v_transfer": f"""
select {PID} shipment_detail_id, l_orderkey shipment_id,
  case when l_returnflag = 'R' then '900' || l_orderkey else cast(l_orderkey as varchar) end order_number,
  l_orderkey % 5 wh_id, l_partkey item_number, l_linenumber line_number, l_quantity quantity_shipped,
  'HU' || l_orderkey hu_id, 'G' || l_orderkey host_group_id
from lineitem""",
    "v_adj": """
select event_id adjustment_id, 'G' || (event_id - event_id % 4) host_group_id, '192' transaction_code,
  case when value > 80 then '90000' else '' end || json_extract_string(props, '$.k') item_number,
  user_id % 5 wh_id, value quantity_change, event_type user_id, user_id % 10 reference_code, ts record_create_date
from events where event_type <> 'view'""",
    "v_ws": """
select event_id log_id, case event_type when 'error' then 'EXP_INV_ADJUST' else 'EXP_PRINT_NF' end webservice_id,
  'G' || (event_id - event_id % 2) param1,
  case when event_type = 'click' then '<ok>SuccessStatus</ok>' when value < 20 then 'Familia nao encontrada'
    else 'Cannot find dispatch method' end soap_respond,
  'order ' || user_id || ';' soap_request, ts process_date
from events where event_type in ('error', 'click')""",
    "v_work": """
select o_orderkey work_q_id, 'L' || (o_custkey % 50) location_id, 'L' || (o_custkey % 50) from_location_id,
  o_orderkey % 5 wh_id, case when o_orderpriority < '3' then '80' else '06' end work_type,
  case when o_orderstatus = 'O' then 'U' else 'C' end work_status, 'HU' || (o_orderkey + 1) pick_ref_number
from orders""",
    "v_assign": "select o_orderkey work_q_id, o_orderkey % 5 wh_id from orders where o_orderpriority = '3-MEDIUM'",
    "v_orders": """
select o_orderkey order_number, o_orderkey + 500000000 order_id, o_orderkey % 5 wh_id, o_orderstatus status,
  o_orderdate order_date, o_custkey bill_to_code, o_custkey customer_id, o_orderpriority type_id,
  cast(o_orderkey as varchar) display_order_number, o_orderkey % 4 client_code,
  case when o_totalprice > 250000 then 'S' else 'N' end split_status
from orders""",
    "v_types": "select distinct o_orderpriority type_id, substring(o_orderpriority, 3) as type from orders",
    "v_vendor": "select c_custkey vendor_code, c_mktsegment vqm_profile from customer where c_acctbal > 0",
    "v_od": """
select l_orderkey order_number, l_orderkey % 5 wh_id, l_partkey item_number, min(l_linenumber) line_number,
  sum(l_quantity) qty, sum(case when l_returnflag = 'R' then l_quantity else 0 end) bo_qty,
  sum(case when l_returnflag = 'A' then l_quantity else 0 end) afo_plan_qty,
  min(year(l_shipdate) * 100 + month(l_shipdate)) wave_id, l_partkey % 5 cust_part
from lineitem group by l_orderkey, l_partkey""",
    "v_wavelines": """
select wave_id, order_number, line_number, item_number, wh_id, qty planned_qty,
  concat_ws('-', order_number, item_number) wave_detail_line_id, order_number wave_detail_id
from v_od""",
    "v_waveplan": """
select * from v_wavelines
union all
select wave_id, order_number, line_number + 1, item_number, wh_id, planned_qty, wave_detail_line_id || '-N', wave_detail_id
from v_wavelines""",
    "v_urgent_exc": """
select * from v_exc where control_number in (select o_orderkey from orders where o_orderpriority in ('1-URGENT', '2-HIGH'))""",
    "v_wavedet": "select distinct order_number wave_detail_id, wave_id, order_number from v_od",
    "v_comment": """
select order_number, wh_id, item_number, line_number, 'ORIG' || order_number br_order_number_orig,
  'line ' || line_number comment_text
from v_od where qty > 10""",
    "v_po": """
select o_orderkey po_number, 'PO' || o_orderkey display_po_number, o_orderkey % 5 wh_id,
  case when o_orderstatus = 'O' then 'O' else 'C' end status, o_orderpriority type_id, o_orderkey % 4 client_code,
  o_custkey vendor_code, 'FUL' || o_custkey fulfillment_id
from orders""",
    "v_pod": "select l_orderkey po_number, l_orderkey % 5 wh_id, l_partkey item_number, l_quantity qty from lineitem",
    "v_asn": """
select 'PO' || l_orderkey display_po_number, l_orderkey % 5 wh_id, 'C' || l_orderkey || '-' || l_linenumber hu_id,
  l_partkey item_number, l_quantity qty,
  case l_linenumber when 1 then 'DEVTRI' when 2 then 'BUFFER' when 3 then null else 'OTHER' end context,
  case when l_returnflag = 'N' then 'new' else 'done' end processing_code, l_returnflag document_type,
  l_suppkey distro_number
from lineitem""",
    "v_holds": """
select distinct l_partkey item_number, l_suppkey % 5 wh_id, 'L' || l_suppkey location_id,
  case when l_linenumber % 2 = 0 then 'LOT' || l_linenumber end lot_number
from lineitem where l_linestatus = 'O' and l_returnflag = 'R' and l_discount < 0.05""",
    "v_cont": """
select s_suppkey container_id, w.wh_id, s_name tracking_number
from supplier, range(5) w(wh_id) where s_acctbal > 1000""",
    "v_shipmsg": f"""
select {PID} host_ship_detail_id, 'G' || l_orderkey host_group_id, l_orderkey so_number, l_linenumber so_line_number,
  l_partkey item_number, l_orderkey % 5 wh_id, case when l_returnflag = 'R' then 'EX' else 'OK' end status,
  case when l_linestatus = 'O' then 'W' else 'X' end lot_number,
  case when l_returnflag = 'A' then 'A' else 'T' end container_type,
  case when l_linestatus = 'O' then '336' else '340' end transaction_code, l_partkey % 4 client_code
from lineitem""",
    "v_receipts": """
select 'G' || l_orderkey host_group_id, l_orderkey po_number, l_orderkey % 5 wh_id, l_partkey item_number,
  l_quantity qty_received, case when l_linestatus = 'O' then '0' else 'FUL' || l_suppkey end fulfillment_id
from lineitem where l_returnflag = 'A'""",
    "v_ordmsg": """
select 'G' || (o_orderkey % 100) host_group_id, o_orderkey order_number, o_orderkey % 5 wh_id,
  case when o_orderpriority = '1-URGENT' then 'NEW' || o_orderkey else 'PO' || o_orderkey end customer_po_number
from orders""",
    "v_pomsg": """
select 'G' || (o_orderkey % 100) host_group_id, o_orderkey po_number from orders where o_orderstatus = 'P'""",
}
