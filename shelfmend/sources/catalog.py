"""Input tables: explicit schemas, landing, loading. Keys are strings (leading zeros matter)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, StructType, TimestampNTZType


def _columns(strings: str = "", quantities: str = "", times: str = "") -> StructType:
    schema = StructType()
    for names, kind in ((strings, StringType()), (quantities, DecimalType(18, 4)), (times, TimestampNTZType())):
        for name in names.split():
            schema.add(name, kind)
    return schema


_ATTRIBUTES = " ".join(f"gen_attribute_value{i}" for i in range(1, 12))
_BILL_TO = "bill_to_code bill_to_name bill_to_addr1 bill_to_addr2 bill_to_city bill_to_state bill_to_zip bill_to_phone"
_TRAN = dict(
    strings="tran_log_id tran_type description employee_id control_number control_number_2 line_number wh_id hu_id "
    "hu_id_2 location_id location_id_2 item_number lot_number",
    quantities="num_items tran_qty elapsed_time",
    times="start_tran_date start_tran_time end_tran_date end_tran_time",
)

SCHEMAS: Mapping[str, StructType] = {
    "t_stored_item": _columns(
        "sequence item_number status wh_id location_id reserved_for lot_number inspection_code serial_number type "
        "put_away_location stored_attribute_id hu_id shipment_number",
        "actual_qty unavailable_qty",
        "fifo_date expiration_date",
    ),
    "t_hu_master": _columns(
        "hu_id type control_number location_id subtype status wh_id load_position haz_material load_id load_seq "
        "ver_flag zone reserved_for container_type stop_id parent_hu_id user_id",
        times="fifo_date",
    ),
    "t_pick_detail": _columns(
        "pick_id order_number line_number type uom work_q_id work_type status item_number lot_number zone wave_id "
        "load_id container_id user_assigned pick_area wh_id pendency",
        "planned_quantity picked_quantity staged_quantity loaded_quantity packed_quantity shipped_quantity",
        "create_date",
    ),
    "t_pick_container": _columns("container_id wh_id tracking_number"),
    "t_order": _columns(
        "order_id wh_id order_number display_order_number type_id customer_id load_id pro_number master_bol_number "
        f"carrier carton_label status client_code carrier_mode fulfillment_id created_nf split_status {_BILL_TO}",
        "weight cubic_volume",
        "order_date",
    ),
    "t_order_detail": _columns(
        "order_detail_id order_id item_master_id wh_id order_number line_number item_number cust_part",
        "bo_qty qty afo_plan_qty qty_shipped",
    ),
    "t_order_detail_comment": _columns(
        "order_number wh_id item_number line_number br_order_number_orig comment_text", "br_qty br_qty_shipped"
    ),
    "t_item_master": _columns("item_master_id item_number wh_id client_code display_item_number lot_control"),
    "t_item_upc": _columns("item_number wh_id upc"),
    "t_item_uom": _columns("item_number wh_id uom gtin", "conversion"),
    "t_po_master": _columns("po_number display_po_number wh_id client_code vendor_code type_id status fulfillment_id"),
    "t_po_detail": _columns("po_number wh_id item_number", "qty"),
    "t_po_sto_unavailable": _columns("item_number wh_id status", "qty_unavailable"),
    "t_lookup": _columns("lookup_id lookup_type locale_id"),
    "t_location": _columns("wh_id location_id status type pick_area zone"),
    "t_pick_area": _columns("wh_id pick_area"),
    "t_location_relation": _columns("wh_id location_id related_location_id relation_type zone status"),
    "t_zone_loca": _columns("wh_id zone location_id"),
    "t_store_detail": _columns("wh_id store_number"),
    "t_client_control": _columns("wh_id client_code control_type c1"),
    "t_br_shipping_master": _columns("shipping_id door_location"),
    "t_transaction": _columns("tran_type description"),
    "t_vendor": _columns("vendor_code vqm_profile"),
    "v_type": _columns("type_id type"),
    "t_tran_log": _columns(**_TRAN),
    "t_tran_log_holding": _columns(**_TRAN),
    "t_exception_log": _columns(
        "exception_id tran_type description employee_id wh_id suggested_value location_id item_number lot_number hu_id "
        "load_id control_number line_number tracking_number error_code error_message status",
        "entered_value quantity",
        "exception_date exception_time",
    ),
    "tmp_inconsistency": _columns(
        "host_group_id table_name error_code wh_id hu_id work_q_id location_id", times="create_date"
    ),
    "t_work_q": _columns(
        "work_q_id work_type description pick_ref_number priority item_number wh_id location_id from_location_id "
        "work_status employee_id",
        "qty",
        "datetime_stamp",
    ),
    "t_work_q_assignment": _columns("work_q_id wh_id"),
    "t_holds": _columns(
        "item_number wh_id location_id lot_number type stored_attribute_id hu_id reason_id employee_id",
        times="date_created",
    ),
    "t_al_host_shipment_master": _columns(
        "shipment_id host_group_id transaction_code order_number display_order_number load_id pro_number seal_number "
        "carrier_code status split_status user_id wh_id client_code master_bol_number order_type carrier_mode "
        f"delivery_sap printer_id fulfillment_id po_number {_BILL_TO}",
        "total_weight total_volume",
        "record_create_date",
    ),
    "t_al_host_shipment_detail": _columns(
        "shipment_detail_id shipment_id line_number item_number display_item_number lot_number hu_id delivery_sap "
        f"user_id wh_id client_code uom tracking_number order_number display_order_number host_group_id {_ATTRIBUTES}",
        "quantity_shipped",
        "record_create_date",
    ),
    "t_al_host_inventory_adjustment": _columns(
        "adjustment_id host_group_id transaction_code item_number lot_number hu_id inventory_status_before "
        "inventory_status_after reason_code from_location_id to_location_id user_id wh_id uom reference_code "
        f"display_item_number client_code {_ATTRIBUTES}",
        "quantity_before quantity_after quantity_change",
        "fifo_date record_create_date",
    ),
    "t_al_host_receipt": _columns(
        "host_group_id transaction_code user_id vendor_code po_number item_number line_number hu_id wh_id "
        "display_po_number scac_code status client_code pack_slip fork_id fulfillment_id",
        "qty_received",
    ),
    "t_al_host_ship_detail": _columns(
        "host_ship_detail_id host_group_id so_number so_line_number item_number wh_id status lot_number asn_number "
        "asn_line_number container_type client_code transaction_code"
    ),
    "t_al_host_transfer_asn": _columns(
        "display_po_number wh_id item_number hu_id document_type distro_number context processing_code", "qty"
    ),
    "t_al_host_order_master": _columns("host_group_id order_number display_order_number wh_id customer_po_number"),
    "t_al_host_order_detail": _columns("host_group_id order_number display_order_number wh_id"),
    "t_al_host_po_master": _columns("host_group_id po_number"),
    "t_al_host_webservice_in_data": _columns("hu_id wh_id"),
    "t_webservice_alloc_log": _columns("webservice_id param1 soap_request soap_respond", times="process_date"),
    "ea_t_async_work_queue": _columns(
        "event_id scevent_id procobject status alert_id claim_id",
        "retry_count priority",
        "date_added date_started date_finished",
    ),
    "ea_t_event_data": _columns("event_id payload"),
    "ea_t_scevent": _columns("scevent_id scevent_name"),
    "tmp_item": _columns("item_number wh_id", "qty"),
    "t_sto_attrib_collection_detail": _columns("stored_attribute_id attribute_id attribute_value"),
    "t_attribute_legacy_map": _columns(" ".join(f"generic_attribute_{i}" for i in range(1, 12))),
    "v_wave": _columns("wave_id order_number line_number item_number wh_id wave_detail_line_id", "planned_qty"),
    "t_afo_wave_detail_line": _columns("wave_detail_line_id wave_detail_id item_number line_number"),
    "t_afo_wave_detail": _columns("wave_detail_id wave_id order_number"),
    "t_arch_group": _columns("group_id name group_status"),
    "t_arch_backup_control_group": _columns("group_id backup_control_id", "group_sequence"),
    "t_arch_backup_control": _columns("id table_name control_type status", "elapsed_time", "last_processed_date"),
    "t_arch_group_schedule": _columns("group_id schedule_id"),
    "t_arch_schedule": _columns("schedule_id name message_id"),
    "t_arch_schedule_detail": _columns("schedule_id", times="start_time"),
    "table_statistics": _columns("table_name", "num_rows", "last_analyzed"),
    "t_msg_bus": _columns(
        "msg_bus_id msg_def_detail_id sub_application_id", "priority status_id", "date_activated"
    ),
    "t_msg_def_detail": _columns("msg_def_detail_id msg_def_master_id"),
    "t_msg_def_master": _columns("msg_def_master_id name"),
    "item_loc_soh": _columns("item loc", "stock_on_hand non_sellable_qty in_transit_qty tsf_reserved_qty"),
    "shipment": _columns("shipment bol_no to_loc"),
    "shipsku": _columns("shipment item carton distro_type distro_no", "qty_expected"),
    "fm_fiscal_doc_header": _columns("status ref_no_1"),
    "fm_fiscal_doc_notify_desc": _columns("status_id asn_nbr"),
}

# Logs and messages are read by date; they are stored in one folder per day of this column.
DAY_COLUMN = {
    "t_tran_log": "start_tran_date",
    "t_exception_log": "exception_date",
    "t_tran_log_holding": "start_tran_date",
    "t_webservice_alloc_log": "process_date",
    "t_al_host_shipment_master": "record_create_date",
    "t_al_host_inventory_adjustment": "record_create_date",
    "ea_t_async_work_queue": "date_added",
}


def conform(raw: DataFrame, table: str) -> DataFrame:
    """Cast to the table's schema; an empty string is stored as NULL, as the source system has it."""
    present = set(raw.columns)

    def cell(f):
        c = F.col(f.name) if f.name in present else F.lit(None)
        if isinstance(f.dataType, StringType):
            c = F.nullif(c.cast("string"), F.lit(""))
        return c.cast(f.dataType).alias(f.name)

    return raw.select(*[cell(f) for f in SCHEMAS[table].fields])


def land(raw: DataFrame, table: str, root: str) -> None:
    """Write a raw extract as a catalog table. Blanks are cleaned once, here, so that later filters
    compare plain columns and reach the parquet scan."""
    rows = conform(raw, table)
    path = f"{root.rstrip('/')}/{table}"
    if table in DAY_COLUMN:
        dated = rows.withColumn("day", F.to_date(DAY_COLUMN[table]))
        # few files per day, but a busy day is split over as many tasks as its size asks for
        dated.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
    else:
        rows.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, root: str, table: str, since: datetime | None = None) -> DataFrame:
    """Read a catalog table; ``since`` prunes the day folders of a dated table."""
    schema = SCHEMAS[table]
    path = f"{root.rstrip('/')}/{table}"
    if table not in DAY_COLUMN:
        return spark.read.schema(schema).parquet(path)
    rows = spark.read.schema(StructType(list(schema.fields)).add("day", DateType())).parquet(path)
    if since is not None:
        rows = rows.filter(F.col("day") >= F.lit(since.date())).filter(
            F.col(DAY_COLUMN[table]) >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")
        )
    return rows.drop("day")


def load_all(spark: SparkSession, root: str, tables: Sequence[str]) -> dict[str, DataFrame]:
    return {t: load(spark, root, t) for t in tables}


def load_remote(
    spark: SparkSession,
    url: str,
    remote_table: str,
    table: str,
    properties: Mapping[str, str],
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table of another database over JDBC. ``split`` = (column, low, high, partitions) reads it
    in parallel; filters and column choice are pushed to the remote side."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", remote_table).options(**properties)
    if split is not None:
        column, low, high, parts = split
        reader = reader.option("partitionColumn", column).option("lowerBound", low)
        reader = reader.option("upperBound", high).option("numPartitions", parts)
    return conform(reader.load(), table)
