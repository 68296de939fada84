"""The supplied test tables in the shape of the warehouse tables.

Every view maps whole tables; what differs between rows comes from their own columns. A view that
leaves out the rows of some kind does so because the operators look for what is missing, and the rest of
the table is there to be missed. Keys stay integers where the test data has integers, and are composed as
text where it has several; the operators accept either.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.numbering import pinned

PICK_ID = (
    "concat_ws('-', cast(l_orderkey AS string), cast(l_partkey AS string), cast(l_suppkey AS string),"
    " cast(l_linenumber AS string))"
)


class Samples:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A test table; its footer is read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _in_each_warehouse(self, rows: DataFrame) -> DataFrame:
        """The rows once for each of the five warehouses. Not by ``explode``: the planner's size estimates ignore what that
        adds, and millions of rows would be broadcast as a few MB. A small file is read by a task or two; its rows are dealt
        out by their first column before they become five times as many."""
        rows = rows.repartition(rows.columns[0])
        return reduce(DataFrame.unionByName, [rows.withColumn("wh_id", F.lit(w).cast("long")) for w in range(5)])

    def picks(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{PICK_ID} AS pick_id",
            "l_orderkey AS order_number",
            "l_linenumber AS line_number",
            "l_partkey AS item_number",
            "l_orderkey % 5 AS wh_id",
            "l_quantity AS planned_quantity",
            "CASE WHEN l_returnflag = 'R' THEN 0D ELSE l_quantity END AS picked_quantity",
            "CASE l_returnflag WHEN 'R' THEN 'RELEASED' WHEN 'A' THEN 'PICKED' ELSE 'SHIPPED' END AS status",
            "CASE WHEN l_linestatus = 'O' THEN 'PP' ELSE 'RE' END AS type",
            "cast(year(l_shipdate) * 100 + month(l_shipdate) AS bigint) AS wave_id",
            "l_orderkey AS work_q_id",
            "l_orderkey AS load_id",
            "l_suppkey AS container_id",
            "l_suppkey % 25 AS pick_area",
            "l_shipdate AS create_date",
        )

    def stock(self) -> DataFrame:
        return self.table("lineitem").filter("l_linestatus = 'O'").selectExpr(
            f"{PICK_ID} AS sequence",
            "l_partkey AS item_number",
            "l_suppkey % 5 AS wh_id",
            "concat('L', l_suppkey) AS location_id",
            "CASE WHEN l_linenumber < 7 THEN concat('HU', l_orderkey) END AS hu_id",
            "l_quantity AS actual_qty",
            "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0D END AS unavailable_qty",
            "CASE WHEN l_linenumber % 2 = 0 THEN concat('LOT', l_linenumber) END AS lot_number",
            "CASE WHEN l_returnflag = 'R' THEN 'STORAGE'"
            " WHEN l_returnflag = 'N' AND l_linenumber < 4 THEN 'STORAGE'"
            f" WHEN l_linenumber = 3 THEN concat('X', {PICK_ID})"
            f" ELSE cast({PICK_ID} AS string) END AS type",
            "CASE WHEN l_returnflag = 'R' THEN 'H' ELSE 'A' END AS status",
            "l_orderkey AS serial_number",
            "l_partkey AS stored_attribute_id",
            "l_shipdate AS fifo_date",
        )

    def erp(self) -> DataFrame:
        return (
            self.table("lineitem")
            .filter("l_linestatus = 'F'")
            .groupBy(F.expr("l_partkey AS item"), F.expr("l_suppkey % 5 + 500 AS loc"))
            .agg(
                F.expr("sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0D END) AS stock_on_hand"),
                F.expr(
                    "sum(CASE WHEN l_returnflag = 'R' THEN l_quantity WHEN l_linenumber = 7 THEN -2 * l_quantity"
                    " ELSE 0D END) AS non_sellable_qty"
                ),
                F.expr("sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0D END) AS in_transit_qty"),
                F.expr("sum(CASE WHEN l_linenumber = 6 THEN l_quantity ELSE 0D END) AS tsf_reserved_qty"),
            )
        )

    def worklist(self) -> DataFrame:
        return self.table("part").selectExpr("p_partkey AS item_number", "p_partkey % 5 AS wh_id", "p_size AS qty")

    def items(self) -> DataFrame:
        """Item master: every part in each of the five warehouses."""
        return self._in_each_warehouse(self.table("part")).selectExpr(
            "p_partkey AS item_number",
            "wh_id",
            "p_partkey % 4 AS client_code",
            "CASE WHEN p_size % 2 = 0 THEN 'N' ELSE 'Y' END AS lot_control",
            "p_name AS display_item_number",
        ).withColumn("item_master_id", F.expr("item_number * 10 + wh_id"))

    def barcodes(self) -> DataFrame:
        part = self.table("part")
        codes = part.selectExpr("p_partkey", "concat('90000', p_partkey) AS upc").unionByName(
            part.filter("p_size > 40").selectExpr("p_partkey", "concat('80000', p_partkey) AS upc")
        )
        return self._in_each_warehouse(codes).selectExpr("p_partkey AS item_number", "wh_id", "upc")

    def units(self) -> DataFrame:
        return self._in_each_warehouse(self.table("part")).selectExpr(
            "p_partkey AS item_number",
            "wh_id",
            "CASE WHEN p_size % 2 = 0 THEN 'EA' ELSE 'CX' END AS uom",
            "p_size AS conversion",
            "CASE WHEN p_size % 3 <> 0 THEN concat('90000', p_partkey) END AS gtin",
        )

    def locations(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "concat('L', s_suppkey) AS location_id",
            "s_suppkey % 5 AS wh_id",
            "CASE WHEN s_acctbal < 0 THEN 'I' ELSE 'E' END AS status",
            "CASE WHEN s_nationkey % 5 = 0 THEN 'F' ELSE 'O' END AS type",
            "s_nationkey AS pick_area",
        )

    def pick_areas(self) -> DataFrame:
        areas = self.table("nation").filter("n_regionkey <> 0").selectExpr("n_nationkey AS pick_area")
        return self._in_each_warehouse(areas)

    def client_control(self) -> DataFrame:
        by_client = self.table("supplier").groupBy(
            F.expr("s_suppkey % 5 AS wh_id"), F.expr("s_suppkey % 4 AS client_code")
        )
        ends = by_client.agg(
            F.expr("max(concat('L', s_suppkey)) AS ia"), F.expr("min(concat('L', s_suppkey)) AS si")
        )
        return ends.selectExpr("wh_id", "client_code", "stack(2, 'LOC_RECEB_IA', ia, 'LOC_RECEB_SI', si) AS (control_type, c1)")

    def handling_units(self) -> DataFrame:
        return self.table("orders").filter("o_orderstatus <> 'P'").selectExpr(
            "concat('HU', o_orderkey) AS hu_id",
            "o_orderkey % 5 AS wh_id",
            "concat('L', o_custkey % 50) AS location_id",
            "CASE WHEN o_orderpriority <> '5-LOW' THEN 'CX' END AS container_type",
            "o_custkey AS load_id",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'TSFCON' END AS reserved_for",
            "CASE WHEN o_orderpriority <> '1-URGENT' OR o_totalprice > 250000 THEN o_orderkey % 7 + 1 END AS control_number",
            "concat('P', o_custkey) AS parent_hu_id",
            "o_orderpriority AS zone",
        )

    def cut_log(self) -> DataFrame:
        """Exception rows of the cut: every released line of an open pick."""
        return self.picks().filter("status = 'RELEASED' AND type = 'PP'").selectExpr(
            "pick_id AS exception_id",
            "'033' AS tran_type",
            "'PRO_E' AS lot_number",
            "order_number AS control_number",
            "item_number",
            "wh_id",
            "planned_quantity AS quantity",
            "wave_id AS load_id",
            "cast(NULL AS string) AS status",
            "cast(NULL AS string) AS suggested_value",
            "create_date AS exception_date",
        )

    def urgent_cut_log(self) -> DataFrame:
        """The cut log of the urgent orders, which are cut first."""
        urgent = self.table("orders").filter("o_orderpriority IN ('1-URGENT', '2-HIGH')").select("o_orderkey")
        log = self.cut_log()
        return log.join(urgent, log["control_number"] == urgent["o_orderkey"], "left_semi")

    def send_errors(self) -> DataFrame:
        return self.table("events").filter("event_type = 'error'").selectExpr(
            "event_id AS exception_id",
            "concat('G', event_id - event_id % 4) AS location_id",
            "concat('E', user_id) AS error_message",
        )

    def tran_log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS tran_log_id",
            "CASE event_type WHEN 'view' THEN '411' WHEN 'click' THEN '410' WHEN 'purchase' THEN '317'"
            " WHEN 'signup' THEN '361' ELSE '024' END AS tran_type",
            "event_type AS description",
            "concat('E', user_id % 10) AS employee_id",
            "concat('HU', user_id) AS hu_id",
            "user_id AS control_number",
            "user_id % 5 AS wh_id",
            "cast(get_json_object(props, '$.k') AS bigint) AS item_number",
            "value AS tran_qty",
            "concat('L', get_json_object(props, '$.k')) AS location_id",
            "concat('RAIL', user_id % 3) AS location_id_2",
            "ts AS start_tran_date",
            "ts AS start_tran_time",
        )

    def allocations(self) -> DataFrame:
        """Allocation log: the order each handling unit was last given to."""
        return self.table("orders").selectExpr(
            "'351' AS tran_type",
            "concat('HU', o_orderkey) AS hu_id",
            "o_orderkey % 5 AS wh_id",
            "o_custkey AS control_number",
        )

    def queue(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "event_type AS scevent_id",
            "event_type AS procobject",
            "CASE WHEN value < 20 THEN 'NEW' WHEN value < 60 THEN 'SUCCESS' ELSE 'ERROR' END AS status",
            "ts AS date_added",
            "CASE WHEN value > 10 THEN ts END AS date_started",
            "cast(NULL AS timestamp_ntz) AS date_finished",
            "event_id % 4 AS priority",
            "user_id % 3 AS retry_count",
            "cast(NULL AS bigint) AS alert_id",
            "cast(NULL AS string) AS claim_id",
        )

    def payloads(self) -> DataFrame:
        return self.table("events").selectExpr("event_id", "get_json_object(props, '$.k') AS payload")

    def event_definitions(self) -> DataFrame:
        return self.table("events").select(F.col("event_type").alias("scevent_id")).distinct().selectExpr(
            "scevent_id", "upper(scevent_id) AS scevent_name"
        )

    def shipments(self) -> DataFrame:
        orders = self.table("orders")
        common = [
            "o_orderkey AS order_number",
            "cast(o_orderkey AS string) AS display_order_number",
            "o_orderkey % 5 AS wh_id",
            "o_orderdate AS record_create_date",
            "o_custkey AS load_id",
            "CASE WHEN o_totalprice > 300000 THEN 'HJS_CORTE' ELSE 'HJS' END AS user_id",
            "CASE WHEN o_orderpriority = '2-HIGH' THEN 'P' END AS pro_number",
        ]
        main = orders.filter("o_orderpriority <> '4-NOT SPECIFIED'").selectExpr(
            "o_orderkey AS shipment_id",
            "concat('G', o_orderkey) AS host_group_id",
            "CASE o_orderstatus WHEN 'F' THEN '936' WHEN 'O' THEN '340' ELSE '360' END AS transaction_code",
            *common,
        )
        follow_up = orders.filter("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'").selectExpr(
            "-1 - o_orderkey AS shipment_id",
            "concat('H', o_orderkey) AS host_group_id",
            "'936' AS transaction_code",
            *common,
        )
        return main.unionByName(follow_up)

    def shipment_lines(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"{PICK_ID} AS shipment_detail_id",
            "l_orderkey AS shipment_id",
            "l_orderkey AS order_number",
            "l_orderkey % 5 AS wh_id",
            "l_partkey AS item_number",
            "l_linenumber AS line_number",
            "l_quantity AS quantity_shipped",
            "concat('HU', l_orderkey) AS hu_id",
            "l_partkey % 4 AS client_code",
            "concat('G', l_orderkey) AS host_group_id",
            "l_shipdate AS record_create_date",
        )

    def adjustments(self) -> DataFrame:
        return self.table("events").filter("event_type <> 'view'").selectExpr(
            "event_id AS adjustment_id",
            "concat('G', event_id - event_id % 4) AS host_group_id",
            "'192' AS transaction_code",
            "concat(CASE WHEN value > 80 THEN '90000' ELSE '' END, get_json_object(props, '$.k')) AS item_number",
            "user_id % 5 AS wh_id",
            "value AS quantity_change",
            "event_type AS user_id",
            "user_id % 10 AS reference_code",
            "ts AS record_create_date",
        )

    def service_log(self) -> DataFrame:
        return self.table("events").filter("event_type IN ('error', 'click')").selectExpr(
            "event_id AS log_id",
            "CASE event_type WHEN 'error' THEN 'EXP_INV_ADJUST' ELSE 'EXP_PRINT_NF' END AS webservice_id",
            "concat('G', event_id - event_id % 2) AS param1",
            "CASE WHEN event_type = 'click' THEN '<ok>SuccessStatus</ok>'"
            " WHEN value < 20 THEN 'Familia nao encontrada' ELSE 'Cannot find dispatch method' END AS soap_respond",
            "concat('order ', user_id, ';') AS soap_request",
            "ts AS process_date",
        )

    def tasks(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS work_q_id",
            "concat('L', o_custkey % 50) AS location_id",
            "concat('L', o_custkey % 50) AS from_location_id",
            "o_orderkey % 5 AS wh_id",
            "CASE WHEN o_orderpriority < '3' THEN '80' ELSE '06' END AS work_type",
            "CASE WHEN o_orderstatus = 'O' THEN 'U' ELSE 'C' END AS work_status",
            "concat('HU', o_orderkey + 1) AS pick_ref_number",
        )

    def assignments(self) -> DataFrame:
        return self.table("orders").filter("o_orderpriority = '3-MEDIUM'").selectExpr(
            "o_orderkey AS work_q_id", "o_orderkey % 5 AS wh_id"
        )

    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_number",
            "o_orderkey + 500000000 AS order_id",
            "o_orderkey % 5 AS wh_id",
            "o_orderstatus AS status",
            "o_orderdate AS order_date",
            "o_custkey AS bill_to_code",
            "o_custkey AS customer_id",
            "o_orderpriority AS type_id",
            "cast(o_orderkey AS string) AS display_order_number",
            "o_orderkey % 4 AS client_code",
            "CASE WHEN o_totalprice > 250000 THEN 'S' ELSE 'N' END AS split_status",
        )

    def order_types(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderpriority").alias("type_id")).distinct().selectExpr(
            "type_id", "substring(type_id, 3) AS type"
        )

    def vendors(self) -> DataFrame:
        return self.table("customer").filter("c_acctbal > 0").selectExpr(
            "c_custkey AS vendor_code", "c_mktsegment AS vqm_profile"
        )

    def store_order_lines(self) -> None:
        """Work the order lines out once, for a query that reads them again and again as the table they stand for."""
        self._tables["order_lines"] = pinned(self.order_lines())

    def order_lines(self) -> DataFrame:
        if "order_lines" in self._tables:
            return self._tables["order_lines"]
        return (
            self.table("lineitem")
            .groupBy(
                F.expr("l_orderkey AS order_number"), F.expr("l_orderkey % 5 AS wh_id"), F.expr("l_partkey AS item_number")
            )
            .agg(
                F.expr("min(l_linenumber) AS line_number"),
                F.expr("sum(l_quantity) AS qty"),
                F.expr("sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0D END) AS bo_qty"),
                F.expr("sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0D END) AS afo_plan_qty"),
                F.expr("cast(min(year(l_shipdate) * 100 + month(l_shipdate)) AS bigint) AS wave_id"),
            )
            .withColumn("cust_part", F.expr("item_number % 5"))
        )

    def wave_lines(self) -> DataFrame:
        return self.order_lines().selectExpr(
            "wave_id",
            "order_number",
            "line_number",
            "item_number",
            "wh_id",
            "qty AS planned_qty",
            "concat_ws('-', cast(order_number AS string), cast(item_number AS string)) AS wave_detail_line_id",
            "order_number AS wave_detail_id",
        )

    def replanned_wave_lines(self) -> DataFrame:
        """Every wave line, and the same item planned once more on the order's next line, which mostly has no pick."""
        again = self.wave_lines().withColumns({
            "line_number": F.col("line_number") + 1, "wave_detail_line_id": F.concat("wave_detail_line_id", F.lit("-N")),
        })
        return self.wave_lines().unionByName(again)

    def wave_details(self) -> DataFrame:
        return self.order_lines().selectExpr("order_number AS wave_detail_id", "wave_id", "order_number").distinct()

    def comments(self) -> DataFrame:
        return self.order_lines().filter("qty > 10").selectExpr(
            "order_number",
            "wh_id",
            "item_number",
            "line_number",
            "concat('ORIG', order_number) AS br_order_number_orig",
            "concat('line ', line_number) AS comment_text",
        )

    def purchase_orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS po_number",
            "concat('PO', o_orderkey) AS display_po_number",
            "o_orderkey % 5 AS wh_id",
            "CASE WHEN o_orderstatus = 'O' THEN 'O' ELSE 'C' END AS status",
            "o_orderpriority AS type_id",
            "o_orderkey % 4 AS client_code",
            "o_custkey AS vendor_code",
            "concat('FUL', o_custkey) AS fulfillment_id",
        )

    def purchase_lines(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS po_number", "l_orderkey % 5 AS wh_id", "l_partkey AS item_number", "l_quantity AS qty"
        )

    def transfer_notices(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('PO', l_orderkey) AS display_po_number",
            "l_orderkey % 5 AS wh_id",
            "concat('C', l_orderkey, '-', l_linenumber) AS hu_id",
            "l_partkey AS item_number",
            "l_quantity AS qty",
            "CASE l_linenumber WHEN 1 THEN 'DEVTRI' WHEN 2 THEN 'BUFFER' WHEN 3 THEN NULL ELSE 'OTHER' END AS context",
            "CASE WHEN l_returnflag = 'N' THEN 'new' ELSE 'done' END AS processing_code",
            "l_returnflag AS document_type",
            "l_suppkey AS distro_number",
        )

    def holds(self) -> DataFrame:
        held = self.table("lineitem").filter("l_linestatus = 'O' AND l_returnflag = 'R' AND l_discount < 0.05")
        return held.selectExpr(
            "l_partkey AS item_number",
            "l_suppkey % 5 AS wh_id",
            "concat('L', l_suppkey) AS location_id",
            "CASE WHEN l_linenumber % 2 = 0 THEN concat('LOT', l_linenumber) END AS lot_number",
        ).distinct()

    def attribute_values(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS stored_attribute_id",
            "stack(3, 'brand', p_brand, 'type', p_type, 'size', cast(p_size AS string)) AS (attribute_id, attribute_value)",
        )

    def attribute_map(self) -> DataFrame:
        """The one-row legacy map: which attribute fills which of the eleven columns."""
        slots = [f"max({e}) AS generic_attribute_{i}" for i, e in enumerate(
            ["'brand'", "'type'", "'size'"] + ["cast(NULL AS string)"] * 8, start=1
        )]
        return self.table("region").agg(*[F.expr(s) for s in slots])

    def containers(self) -> DataFrame:
        return self._in_each_warehouse(self.table("supplier").filter("s_acctbal > 1000")).selectExpr(
            "s_suppkey AS container_id", "wh_id", "s_name AS tracking_number"
        )

    def ship_messages(self) -> DataFrame:
        """Order-status messages; one order in five carries a transfer number starting with 900."""
        return self.table("lineitem").selectExpr(
            f"{PICK_ID} AS host_ship_detail_id",
            "concat('G', l_orderkey) AS host_group_id",
            "l_orderkey AS so_number",
            "l_linenumber AS so_line_number",
            "l_partkey AS item_number",
            "l_orderkey % 5 AS wh_id",
            "CASE WHEN l_returnflag = 'R' THEN 'EX' ELSE 'OK' END AS status",
            "CASE WHEN l_linestatus = 'O' THEN 'W' ELSE 'X' END AS lot_number",
            "CASE WHEN l_returnflag = 'A' THEN 'A' ELSE 'T' END AS container_type",
            "CASE WHEN l_linestatus = 'O' THEN '336' ELSE '340' END AS transaction_code",
            "l_partkey % 4 AS client_code",
        )

    def po_unavailable(self) -> DataFrame:
        opened = self.purchase_orders().filter("status = 'O'").select("po_number")
        lines = self.purchase_lines().join(opened, "po_number")
        return lines.selectExpr("item_number", "wh_id", "'O' AS status", "qty AS qty_unavailable")

    def order_kinds(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderpriority").alias("lookup_id")).distinct().selectExpr(
            "lookup_id", "'TYPE' AS lookup_type", "'1046' AS locale_id"
        )

    def docks(self) -> DataFrame:
        return self.table("customer").filter("c_acctbal > 0").selectExpr(
            "c_custkey AS shipping_id", "concat('D', c_nationkey) AS door_location"
        )

    def bus_messages(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_partkey AS msg_def_detail_id",
            "l_linenumber AS priority",
            "CASE WHEN l_suppkey % 10 <> 0 THEN l_returnflag END AS sub_application_id",
            "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS status_id",
        )

    def bus_details(self) -> DataFrame:
        return self.table("part").selectExpr("p_partkey AS msg_def_detail_id", "p_brand AS msg_def_master_id")

    def bus_masters(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("msg_def_master_id")).distinct().selectExpr(
            "msg_def_master_id", "msg_def_master_id AS name"
        )

    def archive_groups(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey AS group_id",
            "r_name AS name",
            "CASE WHEN r_regionkey % 2 = 0 THEN 'A' ELSE 'I' END AS group_status",
        )

    def archive_group_control(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "n_regionkey AS group_id", "n_nationkey + 2 AS backup_control_id", "n_nationkey % 7 AS group_sequence"
        )

    def archive_control(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_nationkey AS id",
            "s_name AS table_name",
            "concat('C', s_suppkey % 3) AS control_type",
            "CASE WHEN s_acctbal < 0 THEN 'F' ELSE 'S' END AS status",
            "timestampadd(DAY, cast(s_suppkey % 9 AS int), timestamp_ntz'2024-01-01 00:00:00') AS last_processed_date",
            "s_acctbal AS elapsed_time",
        )

    def archive_group_schedule(self) -> DataFrame:
        return self.table("region").filter("r_name <> 'ASIA'").selectExpr(
            "r_regionkey AS group_id", "r_regionkey + 1 AS schedule_id"
        )

    def archive_schedule(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey + 1 AS schedule_id", "concat('S_', r_name) AS name", "r_regionkey * 10 AS message_id"
        )

    def archive_schedule_detail(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_nationkey % 5 + 1 AS schedule_id",
            "timestampadd(MINUTE, cast(c_custkey AS int), timestamp_ntz'2024-01-01 00:00:00') AS start_time",
        )

    def table_statistics(self) -> DataFrame:
        return self.table("supplier").filter("s_acctbal >= 0").selectExpr(
            "s_name AS table_name",
            "cast(floor(s_acctbal) AS bigint) AS num_rows",
            "timestamp_ntz'2024-01-02 00:00:00' AS last_analyzed",
        )

    def archive_bus(self) -> DataFrame:
        return self.table("region").filter("r_regionkey < 4").selectExpr(
            "r_regionkey * 10 AS msg_bus_id",
            "timestampadd(HOUR, r_regionkey, timestamp_ntz'2024-02-01 00:00:00') AS date_activated",
        )

    def stores(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey % 5 AS wh_id", "cast(s_suppkey AS string) AS store_number")

    def store_locations(self) -> DataFrame:
        return self.table("supplier").filter("s_acctbal >= 3000").selectExpr(
            "s_suppkey % 5 AS wh_id", "concat('CTN_LJ_', lpad(cast(s_suppkey AS string), 3, '0'), '.1') AS location_id"
        )

    def fiscal_headers(self) -> DataFrame:
        """Fiscal documents of closed orders, keyed like the warehouse builds the key."""
        return self.table("orders").filter("o_orderstatus <> 'O'").selectExpr(
            "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'X' ELSE 'A' END AS status",
            "concat('499.', lpad(cast(o_orderkey AS string), 20, '0')) AS ref_no_1",
        )

    def fiscal_notices(self) -> DataFrame:
        return self.table("orders").filter("o_orderstatus = 'O' AND o_totalprice > 200000").selectExpr(
            "'E' AS status_id", "concat('499.', lpad(cast(o_orderkey AS string), 20, '0')) AS asn_nbr"
        )

    def order_messages(self) -> DataFrame:
        """Order documents; the purchase order they name exists only for some of them."""
        return self.table("orders").selectExpr(
            "concat('G', o_orderkey % 100) AS host_group_id",
            "o_orderkey AS order_number",
            "o_orderkey % 5 AS wh_id",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN concat('NEW', o_orderkey) ELSE concat('PO', o_orderkey) END"
            " AS customer_po_number",
        )

    def order_message_lines(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('G', l_orderkey % 100) AS host_group_id",
            "l_orderkey AS order_number",
            "l_orderkey % 5 AS wh_id",
            "cast(NULL AS string) AS display_order_number",
        )

    def po_messages(self) -> DataFrame:
        """Purchase documents of the partly processed orders, by message group."""
        return self.table("orders").filter("o_orderstatus = 'P'").selectExpr(
            "concat('G', o_orderkey % 100) AS host_group_id", "o_orderkey AS po_number"
        )

    def receipts(self) -> DataFrame:
        """Receipts of finished notices; some lack the fulfilment id."""
        return self.table("lineitem").filter("l_returnflag = 'A'").selectExpr(
            "concat('G', l_orderkey) AS host_group_id",
            "l_orderkey AS po_number",
            "l_orderkey % 5 AS wh_id",
            "l_partkey AS item_number",
            "l_quantity AS qty_received",
            "CASE WHEN l_linestatus = 'O' THEN '0' ELSE concat('FUL', l_suppkey) END AS fulfillment_id",
        )

    def erp_shipments(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS shipment", "concat('PO', o_orderkey) AS bol_no", "o_orderkey % 5 AS to_loc"
        )

    def erp_shipment_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS shipment",
            "l_partkey AS item",
            "concat('C', l_orderkey, '-', l_linenumber) AS carton",
            "l_returnflag AS distro_type",
            "l_suppkey AS distro_no",
            "l_quantity AS qty_expected",
        )

    def transfer_shipment_lines(self) -> DataFrame:
        """Shipment lines; returned goods belong to transfer orders, whose numbers start with 900."""
        return self.table("lineitem").selectExpr(
            f"{PICK_ID} AS shipment_detail_id",
            "l_orderkey AS shipment_id",
            "CASE WHEN l_returnflag = 'R' THEN concat('900', l_orderkey) ELSE cast(l_orderkey AS string) END AS order_number",
            "l_orderkey % 5 AS wh_id",
            "l_partkey AS item_number",
            "l_linenumber AS line_number",
            "l_quantity AS quantity_shipped",
            "concat('HU', l_orderkey) AS hu_id",
            "concat('G', l_orderkey) AS host_group_id",
        )

    def transfer_comments(self) -> DataFrame:
        return self.comments().withColumn("order_number", F.expr("concat('900', order_number)"))

    def renumbered_messages(self) -> DataFrame:
        """Order-status messages whose type-A orders carry a number starting with 9."""
        number = "CASE WHEN container_type = 'A' THEN concat('9', so_number) ELSE cast(so_number AS string) END"
        return self.ship_messages().withColumn("so_number", F.expr(number))

    def renumbered_comments(self) -> DataFrame:
        return self.comments().withColumn("order_number", F.expr("concat('9', order_number)"))
