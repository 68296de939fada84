"""Operators on small hand-made tables: NULLs, duplicates, empty inputs, boundary cases."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmend.operators import audit, cut, duplicates, interface, missing, moves, queue, reconcile, reports
from shelfmend.plans.changeset import apply_change_set, apply_update

NOW = datetime(2024, 3, 15, 10, 20, 30)
ERP = "item string, loc int, stock_on_hand double, non_sellable_qty double, in_transit_qty double, tsf_reserved_qty double"
STOCK = (
    "sequence bigint, item_number string, wh_id int, location_id string, hu_id string, actual_qty double, "
    "unavailable_qty double, lot_number string, type string, status string"
)


def stock_row(seq, item, wh=1, loc="A", hu=None, qty=1.0, una=0.0, lot=None, kind="STORAGE", status="A"):
    return (seq, item, wh, loc, hu, qty, una, lot, kind, status)


# --- reports ---------------------------------------------------------------------------------


def test_queue_backlog_counts_only_new_since(frame, bag):
    day = datetime(2024, 3, 15)
    q = frame(
        "scevent_id string, status string, date_added timestamp_ntz",
        ("a", "NEW", day),
        ("a", "NEW", datetime(2024, 3, 14, 23, 59)),
        ("b", "NEW", day),
        ("b", "DONE", day),
        ("c", "NEW", None),
    )
    d = frame("scevent_id string, scevent_name string", ("a", "X"), ("b", "X"))
    assert bag(reports.queue_backlog(q, d, day)) == [("X", "NEW", 2)]


def test_bus_backlog_keeps_null_application(frame, bag):
    m = frame(
        "msg_def_detail_id int, priority int, sub_application_id string, status_id int",
        (1, 5, None, 1), (1, 5, "drop", 1), (1, 5, "ok", 1), (1, 6, "ok", 2), (2, 5, "ok", 1),
    )
    d = frame("msg_def_detail_id int, msg_def_master_id int", (1, 10), (2, 20))
    n = frame("msg_def_master_id int, name string", (10, "keep"), (20, "Schedule Message"))
    got = reports.bus_backlog(m, d, n, "drop", "Schedule Message")
    assert bag(got, "msg_def_detail_id", "priority", "name", "messages") == [(1, 5, "keep", 2)]


def test_requeue_resets_events(frame, bag):
    q = frame(
        "event_id int, date_added timestamp_ntz, date_started timestamp_ntz, date_finished timestamp_ntz, alert_id int, "
        "procobject string, status string, retry_count int, priority int",
        (1, NOW, NOW, NOW, 3, "p", "ERROR", 4, 1),
        (2, NOW, NOW, None, None, "p", "NEW", 0, 2),
    )
    payloads = frame("event_id int, payload string", (1, "k"), (2, "other"))
    traced = reports.trace_events(q, payloads, ["k"])
    after = apply_change_set({"ea_t_async_work_queue": q}, reports.requeue_events(traced))["ea_t_async_work_queue"]
    columns = ("event_id", "status", "date_started", "date_finished", "retry_count", "priority")
    assert bag(after, *columns) == [(1, "NEW", None, None, 0, 10), (2, "NEW", NOW, None, 0, 2)]


def test_invoice_latency_finds_numbers_anywhere_in_the_text(frame):
    ship = frame(
        "order_number string, host_group_id string, transaction_code string, record_create_date timestamp_ntz",
        ("2011057237357-1PC", "G1", "936", datetime(2024, 3, 15, 8)),
        ("77", "G2", "936", datetime(2024, 3, 15, 9)),
        ("88", "G3", "936", datetime(2024, 3, 15, 9)),
    )
    log = frame(
        "webservice_id string, param1 string, soap_request string, process_date timestamp_ntz",
        ("EXP_PRINT_NF", None, "<x>20110572373</x> and 1774", datetime(2024, 3, 15, 9, 30)),
        ("EXP_PRINT_NF", None, "20110572373", datetime(2024, 3, 15, 9, 10)),
        ("OTHER", "G1", "88", datetime(2024, 3, 15, 8, 59, 59)),
        ("EXP_PRINT_NF", None, None, NOW),
        ("EXP_PRINT_NF", None, "", NOW),
    )
    whole = reports.invoice_latency(ship, log, datetime(2024, 3, 15), datetime(2024, 3, 15)).collect()
    assert [r.pedido for r in whole] == ["77"]
    got = reports.invoice_latency(ship, log, datetime(2024, 3, 15), datetime(2024, 3, 15), number_length=11).collect()
    assert [(r.pedido, r.procs, r.procs_al, r.web_alhost) for r in got] == [
        ("77", None, "00:30:00", None),
        ("2011057237357-1PC", "00:10:01", "01:10:00", "00:59:59"),
    ]


def test_invoice_latency_on_long_texts(frame):
    ship = frame(
        "order_number string, host_group_id string, transaction_code string, record_create_date timestamp_ntz",
        *[(str(n), f"G{n}", "936", datetime(2024, 3, 15, 8)) for n in (7, 4711, 123456789012)],
        ("A-1/x", "G0", "936", datetime(2024, 3, 15, 8)),
    )
    body = "<field name='x'>some text without any numbers in it</field>" * 180  # 10 KB
    log = frame(
        "webservice_id string, param1 string, soap_request string, process_date timestamp_ntz",
        ("EXP_PRINT_NF", None, f"{body}<n>00123456789012</n>{body}", datetime(2024, 3, 15, 9)),
        ("EXP_PRINT_NF", None, f"{body}A-1/x{body}", datetime(2024, 3, 15, 10)),
    )
    got = reports.invoice_latency(ship, log, datetime(2024, 3, 15), datetime(2024, 3, 15)).collect()
    assert sorted((r.pedido, r.procs_al) for r in got) == [("123456789012", "01:00:00"), ("7", "01:00:00"), ("A-1/x", "02:00:00")]


# --- reconciliation --------------------------------------------------------------------------


def test_reconcile_blocked_signs_duplicates_and_nulls(frame, bag):
    erp = frame(
        ERP,
        ("a", 501, 10.0, 5.0, 0.0, 0.0), ("b", 501, 10.0, 1.0, 0.0, 0.0), ("c", 501, 10.0, 2.0, 0.0, 0.0),
        ("d", 501, 10.0, None, 0.0, 0.0), ("e", 502, 10.0, 9.0, 0.0, 0.0), ("f", 501, 1.0, 4.0, 0.0, 0.0),
    )
    work = frame(
        "item_number string, wh_id int, qty double",
        ("a", 1, 0.0), ("a", 1, 0.0), ("b", 1, 0.0), ("c", 1, 0.0), ("d", 1, 0.0), ("e", 1, 0.0), ("f", 1, 0.0),
    )
    stock = frame(
        STOCK,
        stock_row(1, "a", qty=3.0, una=2.0), stock_row(2, "a", qty=3.0, una=None), stock_row(3, "b", una=4.0),
        stock_row(4, "c", una=2.0),
    )
    got = reconcile.reconcile_blocked(erp, work, stock)
    columns = ("item", "transaction_code", "dif_erp_wms", "inventory_status_before", "inventory_status_after", "sum_wms")
    assert bag(got, *columns) == [
        ("a", "750", 3.0, "HOLD", "AVAILABLE", 6.0),
        ("b", "700", 3.0, "AVAILABLE", "HOLD", 1.0),
        ("f", "750", 4.0, "HOLD", "AVAILABLE", None),
    ]


def test_reconcile_blocked_against_one_location(frame, bag):
    erp = frame(ERP, ("a", 999, 1.0, 5.0, 0.0, 0.0), ("a", 501, 1.0, 1.0, 0.0, 0.0))
    work = frame("item_number string, wh_id int", ("a", 1), ("a", 2))
    stock = frame(STOCK, stock_row(1, "a", wh=2, una=5.0))
    got = reconcile.reconcile_blocked(erp, work, stock, loc=999)
    assert bag(got, "item", "wh_id", "dif_erp_wms") == [("a", 1, 5.0)]


def test_phantom_counts_null_quantities_as_no_stock(frame, bag):
    erp = frame(
        ERP,
        ("none", 501, 0.0, -2.0, 0.0, 0.0), ("nulls", 501, 0.0, -3.0, 0.0, 0.0), ("some", 501, 0.0, -4.0, 0.0, 0.0),
        ("transit", 501, 0.0, -5.0, 1.0, 0.0), ("plus", 501, 0.0, 6.0, 0.0, 0.0), ("kept", 501, 0.0, 6.0, 0.0, 1.0),
    )
    stock = frame(STOCK, stock_row(1, "nulls", qty=None), stock_row(2, "some", qty=0.0))
    assert bag(reconcile.phantom_negative(erp, stock, NOW)) == [
        ("none", 1, 2.0, "15032024"),
        ("nulls", 1, 3.0, "15032024"),
    ]
    assert bag(reconcile.phantom_positive(erp, stock, NOW), "item_number", "qty") == [("plus", 6.0)]
    assert bag(reconcile.phantom_negative(erp, stock, NOW, locs=[777])) == []


def test_string_erp_locations(frame, bag):
    erp = frame(ERP.replace("loc int", "loc string"), ("a", "501", 0.0, -2.0, 0.0, 0.0))
    stock = frame(STOCK.replace("wh_id int", "wh_id string"))
    assert bag(reconcile.phantom_negative(erp, stock, NOW), "wh_id", "qty") == [("1", 2.0)]


def test_double_sent_needs_two_users(frame, bag):
    adj = frame(
        "transaction_code string, item_number string, reference_code string, wh_id int, user_id string, quantity_change double",
        ("192", "a", "r", 1, "u1", 4.0), ("192", "a", "r", 1, "u2", 4.0), ("192", "a", "s", 1, "u1", 9.0),
        ("192", "b", "r", 1, "u1", 4.0), ("192", "b", "r", 1, "u1", 4.0), ("192", "c", "r", 1, "u1", 1.0),
        ("192", "c", "r", 1, "u2", 1.0),
    )
    erp = frame(ERP, ("a", 501, 0.0, -4.0, 0.0, 0.0), ("b", 501, 0.0, -4.0, 0.0, 0.0), ("c", 501, 0.0, -4.0, 0.0, 0.0))
    assert bag(reconcile.double_sent(adj, erp), "item_number", "qtd_a", "status") == [("a", 4.0, "OK")]
    every = reconcile.double_sent(adj, erp, matched_only=False)
    assert bag(every, "item_number", "status") == [("a", "OK"), ("c", None)]


@pytest.mark.parametrize(
    ("soh", "non", "wms", "po", "want"),
    [
        (5.0, 8.0, 4.0, 1.0, 8.0),  # less than nothing free: blocked - on hand + stock + ordered
        (0.0, 0.0, 4.0, 0.0, None),  # nothing on hand
        (4.0, 4.0, 4.0, 0.0, 4.0),  # all of it blocked
        (3.0, 2.0, 4.0, 0.0, 2.0),  # more stock than the ERP knows: its blocked quantity
        (9.0, 6.0, 4.0, 0.0, 1.0),  # part of the stock is free already
        (4.0, 1.0, 4.0, 0.0, 1.0),  # equal totals
        (4.0, 0.0, 4.0, 0.0, None),  # equal totals, nothing blocked
        (9.0, 1.0, 4.0, 0.0, None),  # more free than in stock
        (4.0, None, 4.0, 0.0, 0.5),  # no rule applies
    ],
)
def test_releasable_ladder(frame, bag, soh, non, wms, po, want):
    erp = frame(ERP, ("a", 501, soh, non, 0.0, 0.0))
    work = frame("item_number string, wh_id int", ("a", 1))
    stock = frame(STOCK, stock_row(1, "a", qty=wms), stock_row(2, "a", qty=99.0, loc="RETENCAO"))
    orders = frame("item_number string, wh_id int, status string, qty_unavailable double", ("a", 1, "O", po))
    got = bag(reconcile.releasable_qty(work, erp, stock, orders), "qty")
    assert got == ([] if want is None else [(want,)])


def test_releasable_strict_equals_join_then_sum(frame, bag):
    erp = frame(ERP, ("a", 501, 5.0, 80.0, 0.0, 0.0))
    work = frame("item_number string, wh_id int", ("a", 1), ("a", 1))
    stock = frame(STOCK, stock_row(1, "a", qty=2.0), stock_row(2, "a", qty=3.0), stock_row(3, "a", qty=1.0))
    orders = frame(
        "item_number string, wh_id int, status string, qty_unavailable double", ("a", 1, "O", 4.0), ("a", 1, "O", 6.0)
    )
    # 2 list rows × 3 stock rows × 2 order rows: stock 6·2·2, orders 10·2·3
    assert bag(reconcile.releasable_qty(work, erp, stock, orders, strict=True), "qty") == [(75.0 + 24.0 + 60.0,)]
    assert bag(reconcile.releasable_qty(work, erp, stock, orders), "qty") == [(75.0 + 6.0 + 10.0,)]


def test_adjustment_groups_per_row_and_per_batch(frame):
    rows = frame("item_number string, wh_id int, qty double, po string, client_code string", ("a", 1, 2.0, "p", "7"), ("b", 1, 3.0, "p", "8"))
    single = reconcile.emit_adjustments(rows, reconcile.phantom_negative_profile(), NOW)
    assert single.outbox.count() == 2 and single.audit.count() == 2
    message = single.inserts["t_al_host_inventory_adjustment"].filter("item_number = 'a'").first()
    assert (message.quantity_change, message.quantity_before, message.reference_code, message.client_code) == (2.0, 0.0, "p", "001")
    batch = reconcile.emit_adjustments(rows, reconcile.manual_block_profile("U", "BLOCKED"), NOW)
    assert batch.outbox.count() == 1 and batch.audit is None
    message = batch.inserts["t_al_host_inventory_adjustment"].filter("item_number = 'b'").first()
    assert (message.quantity_change, message.quantity_before, message.client_code) == (0.0, 3.0, "8")
    again = reconcile.emit_adjustments(rows, reconcile.manual_block_profile("U", "BLOCKED"), NOW)
    assert batch.outbox.collect() == again.outbox.collect()


def test_manual_feed_forms(frame, bag):
    work = frame("item_number string, wh_id int, qty double", ("a", 1, 1.0), ("b", 1, 0.0), ("c", 1, None))
    items = frame("item_number string, wh_id int, client_code string", ("a", 1, "x"))
    assert bag(reconcile.manual_feed(work, items, "release")) == [("a", 1, 1.0, "x")]
    assert reconcile.manual_feed(work, items).count() == 3


# --- audit -----------------------------------------------------------------------------------


def test_audit_looks_up_description_and_splits_the_clock(frame):
    rows = frame("wh_id int, qty double", (1, 2.0))
    texts = frame("tran_type string, description string", ("854", "Entrada"), ("001", "x"))
    profile = audit.AuditProfile("854", columns={"wh_id": "wh_id", "tran_qty": "qty"}, split_clock=True)
    row = audit.audit_rows(rows, profile, NOW, texts).first()
    assert (row.description, row.wh_id, row.tran_qty) == ("Entrada", "1", 2.0)
    assert row.start_tran_date == datetime(2024, 3, 15)
    assert row.start_tran_time == datetime(2024, 3, 1, 10, 20, 30)


def test_verify_batch(frame, bag):
    table = frame("host_group_id string", ("g",), ("g",))
    expected = frame("host_group_id string", ("g",), ("h",))
    assert bag(audit.verify_batch(table, expected)) == [("g", 2, "SEND"), ("h", 0, "FAILED")]


# --- missing records -------------------------------------------------------------------------


def test_failed_preship_needs_error_and_no_success(frame, bag):
    ship = frame(
        "host_group_id string, order_number string, wh_id int, transaction_code string, record_create_date timestamp_ntz",
        *[(g, "o" + g, 1, "936", NOW) for g in "abcd"],
        ("a", "oa", 1, "936", NOW),
    )
    log = frame(
        "param1 string, soap_respond string",
        ("a", "x Cannot find dispatch method y"), ("a", "Familia não encontrada"),
        ("b", "Cannot find dispatch method"), ("b", "SuccessStatus"), ("c", "other"), ("d", None),
    )
    got = missing.failed_preship(ship, log, datetime(2024, 3, 1))
    assert bag(got, "host_group_id", "error_type") == [("a", "Cannot find dispatch method"), ("a", "Familia não encontrada")]


def test_missing_holds_treats_absent_lots_as_equal(frame, bag):
    stock = frame(
        STOCK,
        stock_row(1, "a", status="H"), stock_row(2, "a", status="H", lot="L"), stock_row(3, "b", status="H"),
        stock_row(4, "b", loc="F", status="H"), stock_row(5, "c", status="A"),
    )
    loc = frame("location_id string, wh_id int, type string", ("A", 1, "O"), ("F", 1, "F"))
    holds = frame("item_number string, wh_id int, location_id string, lot_number string", ("a", 1, "A", None))
    found = missing.missing_holds(stock, loc, holds)
    assert bag(found, "sequence") == [(2,), (3,)]
    added = missing.add_holds(found, NOW, "T").inserts["t_holds"]
    after = holds.unionByName(added, allowMissingColumns=True)
    assert missing.missing_holds(stock, loc, after).count() == 0


def test_read_after_divert_null_moments_are_ok(frame, bag):
    hu = frame(
        "hu_id string, wh_id int, location_id string, control_number string, load_id string, container_type string",
        ("h1", 1, "XCTNX", None, "p", None), ("h2", 1, "EST_REC_RS", None, "p", None), ("h3", 1, "DISTCX1", None, "p", None),
        ("h4", 1, "CTN", None, "unknown", None), ("h5", 1, "CTN", None, "p", "CX"), ("h6", 1, "RECE_TRANSF", None, "p", None),
    )
    po = frame("display_po_number string", ("p",))
    d1, d2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    log = frame(
        "hu_id string, wh_id int, tran_type string, start_tran_date timestamp_ntz, start_tran_time timestamp_ntz",
        ("h1", 1, "411", d2, d1), ("h1", 1, "410", d1, d1), ("h2", 1, "411", d1, d1), ("h2", 1, "410", d1, d1),
        ("h3", 1, "411", d2, d2),
    )
    found = missing.read_after_divert(hu, po, log)
    assert bag(found, "hu_id", "error_program") == [("h1", "ERRO"), ("h2", "OK"), ("h3", "OK")]
    repair = missing.type_containers(found.filter("error_program = 'ERRO'"), NOW, "late reading")
    after = apply_update(hu, repair.updates["t_hu_master"])
    assert bag(after.filter("container_type = 'CX'"), "hu_id") == [("h1",), ("h5",)]


def test_unread_containers(frame, bag):
    hu = frame(
        "hu_id string, wh_id int, location_id string, control_number string, load_id string, container_type string",
        ("h1", 1, "CTN", None, "p", None), ("h2", 1, "CTN", None, "p", None),
    )
    found = missing.unread_containers(hu, frame("display_po_number string", ("p",)), frame("hu_id string, wh_id int", ("h1", 1), ("h2", 2)))
    assert bag(found, "hu_id", "error_program") == [("h2", "SEM IN DATA")]


def test_fix_reservation_writes_one_line_per_unit(frame, bag):
    hu = frame(
        "hu_id string, wh_id string, location_id string, reserved_for string, control_number string",
        ("h", "464", "X", "TSFCON", None), ("g", "464", "RECE_TRANSF", "TSFCON", None), ("k", "464", "X", "TSFCON", "1"),
    )
    stock = frame("hu_id string, wh_id string, type string", ("h", "464", "11"), ("h", "464", "12"), ("h", "464", "STORAGE"))
    picks = frame(
        "pick_id string, wh_id string, order_number string, line_number string, item_number string",
        ("11", "464", "o", "1", "a"), ("12", "464", "o", "2", "a"),
    )
    lines = frame(
        "order_number string, line_number string, item_number string, cust_part string, wh_id string",
        ("o", "1", "a", "464", "464"), ("o", "2", "a", None, "464"),
    )
    found = missing.fix_reservation(hu, stock, picks, lines)
    assert bag(found, "line_number", "new_reserved") == [("1", "SHIP"), ("2", "TRANSF_")]
    after = apply_update(hu, missing.apply_reservation(found, NOW, "T").updates["t_hu_master"])
    assert bag(after, "hu_id", "control_number", "reserved_for") == [
        ("g", None, "TSFCON"), ("h", "2", "TRANSF_"), ("k", "1", "TSFCON"),
    ]


def test_location_names_are_padded_and_never_cut(frame, bag):
    stores = frame("wh_id string, store_number string", ("464", "9"), ("464", "276"), ("464", "22"))
    existing = frame("wh_id string, location_id string", ("464", "CTN_LJ_022.1"), ("1", "CTN_LJ_009.1"))
    got = missing.missing_location_rows(stores, existing)
    assert bag(got, "location_id") == [("CTN_LJ_009.1",), ("CTN_LJ_276.1",)]
    assert missing.missing_location_rows(stores, existing, store_numbers=["22"]).count() == 0
    with pytest.raises(Exception, match="more than 3 characters: 1234"):
        missing.missing_location_rows(frame("wh_id string, store_number string", ("464", "1234")), existing).collect()


def test_orphan_stock_ids_count_up(frame):
    stock = frame(
        STOCK,
        stock_row(1, "a", hu="h", qty=2.0, kind="77"), stock_row(2, "a", hu="h", qty=3.0, kind="77"),
        stock_row(3, "b", hu="h", qty=1.0, kind="78"), stock_row(4, "c", hu="h", kind="1"), stock_row(5, "d", hu="h"),
    )
    hu = frame("hu_id string, wh_id int, reserved_for string, control_number string", ("h", 1, "R", "5"))
    picks = frame("pick_id int, wh_id int, order_number string, line_number string", (1, 1, "z", "1"))
    log = frame(
        "tran_type string, hu_id string, wh_id int, control_number string",
        ("351", "h", 1, "o1"), ("351", "h", 1, "o2"), ("999", "h", 1, "o3"), ("351", "h", 1, None),
    )
    found = missing.orphan_stock(stock, hu, picks, log)
    rows = {r.item_number: (r.alloc1, r.actual_qty) for r in found.collect()}
    assert rows == {"a": ("o2", 5.0), "b": ("o2", 1.0)}
    tasks = missing.create_orphan_picks(found, NOW, 1000).inserts["t_work_q"]
    assert sorted(r.work_q_id for r in tasks.collect()) == [1000, 1001]


def test_sorter_returns_drops_unknown_locations(frame, bag):
    log = frame(
        "tran_type string, location_id string, location_id_2 string, wh_id int, item_number string, hu_id string, "
        "tran_qty double, start_tran_date timestamp_ntz",
        ("317", "B", "S", 1, "a", "h1", 2.0, NOW), ("317", "B", "S", 1, "a", "h1", 3.0, NOW),
        ("317", None, "S", 1, "a", "h2", 3.0, NOW), ("317", "RAIL_BUF1", "S", 1, "a", "h3", 3.0, NOW),
        ("317", "B", "S", 1, "a", "h4", 3.0, NOW), ("024", "B", "S", 1, "a", "h4", 3.0, NOW),
        ("317", "B", "S", 1, "a", "h5", 3.0, datetime(2024, 3, 9)), ("317", "B", "S", 1, "a", "h6", 3.0, NOW),
    )
    found = missing.sorter_returns(log, frame("hu_id string, wh_id int", ("h6", 1), ("h1", 2)), NOW, days=5)
    assert bag(found, "hu_id", "qty") == [("h1", 5.0)]
    moves_, changes = missing.return_from_sorter(found, NOW, "T")
    assert bag(moves_, "from_location", "to_location", "to_hu", "qty") == [("S", "B", "h1", 5.0)]
    assert changes.audit.first().location_id == "S"


def test_gtin_backfill_only_single_barcodes_and_only_nulls(frame, bag):
    units = frame("item_number string, wh_id int, gtin string", ("a", 1, None), ("a", 1, "keep"), ("b", 1, None), ("c", 1, None))
    codes = frame("item_number string, wh_id int, upc string", ("a", 1, "u"), ("a", 1, "u"), ("b", 1, "v"), ("b", 1, "w"))
    found = missing.gtin_backfill(units, codes)
    assert bag(found) == [("a", 1, "u")]
    after = apply_update(units, missing.apply_gtin(found, NOW).updates["t_item_uom"])
    assert bag(after, "item_number", "gtin") == [("a", "keep"), ("a", "u"), ("b", None), ("c", None)]


def test_barcode_of_a_known_item_is_left_alone(frame, bag):
    adj = frame("adjustment_id int, host_group_id string, item_number string, wh_id int", (1, "g", "900", 1), (2, "g", "a", 1), (3, "g", "901", 1))
    codes = frame("upc string, wh_id int, item_number string", ("900", 1, "a"), ("901", 1, "b"))
    items = frame("item_number string, wh_id int", ("a", 1), ("901", 1))
    found = missing.barcode_to_item(adj, codes, items)
    assert bag(found, "adjustment_id", "upc", "item_number") == [(1, "900", "a")]


def test_null_display_number_is_never_posted(frame, bag):
    ship = frame(
        "order_number string, host_group_id string, transaction_code string, display_order_number string, record_create_date timestamp_ntz",
        ("1", "g", "936", "1", NOW), ("2", "h", "936", None, NOW), ("3", "i", "936", "3", NOW),
    )
    head = frame("status string, ref_no_1 string", ("A", "499." + "1".rjust(20, "0")), ("Z", "499." + "3".rjust(20, "0")))
    notify = frame("status_id string, asn_nbr string")
    found = missing.unposted_preship(ship, head, notify, datetime(2024, 1, 1))
    assert bag(found, "order_number") == [("2",), ("3",)]


# --- duplicates ------------------------------------------------------------------------------


def test_dup_picks_default_and_strict(frame, bag):
    picks = frame(
        "pick_id int, item_number string, order_number string, line_number string, wave_id string, wh_id int, type string, status string",
        *[(i, "a", "o", "1", "w", 1, "PP", "RELEASED") for i in (1, 2, 3)],
        (9, "a", "o", "1", "w", 1, "RE", "RELEASED"),
        (4, "b", "o", "1", "w", 1, "PP", "RELEASED"),
    )
    assert bag(duplicates.dup_picks(picks), "pick_id", "copies") == [(2, 3), (3, 3)]
    assert bag(duplicates.dup_picks(picks, strict=True), "pick_id") == [(9,)]
    assert duplicates.dup_picks(picks, wave="other").count() == 0
    changes = duplicates.delete_picks(duplicates.dup_picks(picks), NOW)
    after = apply_change_set({"t_pick_detail": picks, "t_exception_log": changes.inserts["t_exception_log"].limit(0)}, changes)
    assert bag(after["t_pick_detail"], "pick_id") == [(1,), (4,), (9,)]
    assert after["t_exception_log"].count() == 1
    assert duplicates.dup_picks(after["t_pick_detail"]).count() == 0


def test_dup_picks_prereceipt_follows_the_parents(frame, bag):
    picks = frame(
        "pick_id int, item_number string, order_number string, line_number string, wave_id string, wh_id int, type string, status string",
        (1, "a", "o", "1", "w", 1, "PP", "RELEASED"), (2, "a", "o", "1", "w", 1, "PP", "RELEASED"),
        (3, "a", "p", "1", "w", 1, "PP", "RELEASED"), (4, "a", "p", "1", "w", 1, "PP", "RELEASED"),
    )
    stock = frame("hu_id string, wh_id int, serial_number string, item_number string", ("h", 1, "o", "a"), ("k", 1, "p", "a"))
    hu = frame("hu_id string, wh_id int, parent_hu_id string, control_number string", ("h", 1, "P1", "1"), ("k", 1, "P2", "1"))
    assert bag(duplicates.dup_picks_prereceipt(picks, stock, hu, ["P1"]), "pick_id") == [(2,)]
    assert bag(duplicates.dup_picks_prereceipt(picks, stock, hu), "pick_id") == [(2,), (4,)]


def test_dup_log_looks_back(frame, bag):
    old = datetime(2024, 1, 1)
    log = frame(
        "tran_log_id int, tran_type string, description string, control_number string, item_number string, wh_id int, "
        "employee_id string, tran_qty double, start_tran_date timestamp_ntz, start_tran_time timestamp_ntz",
        *[(i, "361", "d", "c", "i", 1, "e", 1.0, NOW, NOW) for i in (5, 6)],
        (7, "361", "d", "c", "i", 1, "e", 1.0, old, old),
        (8, "361", "d", "c", "i", 1, None, 1.0, NOW, NOW),
    )
    assert bag(duplicates.dup_log(log, NOW, days=10), "tran_log_id", "latest") == [(6, NOW)]
    assert bag(duplicates.dup_log(log, NOW, days=10, strict=True), "tran_log_id") == [(7,)]


def test_surplus_tasks_leave_one_open(frame, bag):
    tasks = frame(
        "work_q_id int, location_id string, wh_id int, work_type string, work_status string",
        *[(i, "A", 1, "80", "U") for i in range(1, 6)],
        (6, "A", 1, "80", "C"), (7, "B", 1, "80", "U"), (8, "C", 1, "06", "U"), (9, "C", 1, "06", "U"),
    )
    surplus = duplicates.surplus_tasks(tasks)
    assert bag(surplus, "work_q_id") == [(1,), (2,), (3,), (4,)]
    after = apply_change_set({"t_work_q": tasks}, duplicates.close_tasks(surplus))["t_work_q"]
    assert duplicates.surplus_tasks(after).count() == 0
    assert bag(after.filter("work_status = 'U'"), "work_q_id") == [(5,), (7,), (8,), (9,)]


# --- order cut -------------------------------------------------------------------------------

LINES = "order_number string, wh_id int, item_number string, qty double, bo_qty double, afo_plan_qty double"
LOG = (
    "exception_id string, tran_type string, lot_number string, control_number string, item_number string, wh_id int, "
    "quantity double, load_id string, status string, suggested_value string, exception_date timestamp_ntz"
)


def log_row(i, order, item, qty=1.0, wave="w", status=None, suggested=None):
    return (str(i), "033", "PRO_E", order, item, 1, qty, wave, status, suggested, NOW)


def test_classify_compares_with_other_items_only(frame, bag):
    lines = frame(
        LINES,
        ("o1", 1, "a", 5.0, 0.0, 5.0), ("o1", 1, "b", 5.0, 0.0, 5.0), ("o2", 1, "a", 5.0, 0.0, 5.0),
        ("o3", 1, "a", 5.0, 5.0, 0.0), ("o3", 1, "b", 5.0, 0.0, 5.0), ("o4", 1, "a", 5.0, None, 5.0),
    )
    log = frame(
        LOG, log_row(1, "o1", "a"), log_row(2, "o2", "a"), log_row(3, "o3", "a"), log_row(4, "o4", "a"),
        log_row(5, "o5", "a"), log_row(6, "o2", "a", status="COMPLETE"),
    )
    ship = frame("shipment_id int, order_number string, wh_id int, transaction_code string", (1, "o5", 1, "360"))
    sent = frame("shipment_id int, item_number string", (1, "a"))
    want = [("o1", "PARTIAL"), ("o2", "COMPLETE"), ("o3", "PARTIAL"), ("o4", "COMPLETE")]
    assert bag(cut.classify_cut(log, lines, ship, sent), "control_number", "tipo") == want
    assert bag(cut.classify_cut(log, lines, ship, codes=("360", "361")), "control_number", "tipo") == want
    assert cut.classify_cut(log, lines, ship, sent, cap=2).count() == 2


def test_apply_cut_skips_pending_orders_and_keeps_planned_quantity(frame, bag):
    lines = frame(LINES, ("o1", 1, "a", 5.0, 0.0, 4.0), ("o1", 1, "b", 5.0, 0.0, 4.0), ("o2", 1, "a", 5.0, 0.0, 4.0))
    picks = frame(
        "pick_id int, order_number string, wh_id int, item_number string, status string, lot_number string, pendency string, user_assigned string",
        (1, "o1", 1, "a", "RELEASED", None, None, None), (2, "o1", 1, "a", "SHIPPED", None, None, None),
        (3, "o2", 1, "a", "RELEASED", None, None, None),
    )
    log = frame(
        LOG, log_row(1, "o1", "a", 2.0), log_row(2, "o1", "b", 3.0, wave=None), log_row(3, "o2", "a", 1.0, suggested="PEND")
    )
    classified = frame("control_number string, wh_id int, tipo string", ("o1", 1, "PARTIAL"), ("o1", 1, "COMPLETE"), ("o2", 1, "COMPLETE"))
    changes = cut.apply_cut(classified, log)
    after = apply_change_set({"t_order_detail": lines, "t_pick_detail": picks, "t_exception_log": log}, changes)
    assert bag(after["t_order_detail"], "order_number", "item_number", "bo_qty", "afo_plan_qty") == [
        ("o1", "a", 2.0, 4.0), ("o1", "b", 3.0, 0.0), ("o2", "a", 0.0, 4.0),
    ]
    assert bag(after["t_pick_detail"], "pick_id", "status") == [(1, "PICKED"), (2, "SHIPPED"), (3, "RELEASED")]
    assert bag(after["t_exception_log"], "exception_id", "status", "suggested_value") == [
        ("1", "PARTIAL", "PEND"), ("2", "PARTIAL", "PEND"), ("3", None, "PEND"),
    ]
    assert cut.apply_cut(classified, after["t_exception_log"]).updates["t_order_detail"].rows.count() == 0


def test_order_status_forms(frame, bag):
    lines = frame(LINES, ("o1", 1, "a", 5.0, 0.0, 0.0), ("o1", 1, "b", 5.0, 5.0, 0.0), ("o2", 1, "a", 5.0, 5.0, 0.0), ("o3", 1, "a", 5.0, 2.0, 0.0))
    assert bag(cut.order_status_after_cut(lines)) == [("o1", "D"), ("o2", "C"), ("o3", "C")]
    assert bag(cut.order_status_after_cut(lines, "remaining"), "order_number") == [("o2",)]


def test_zero_stock_lines_ignore_stock_at_inactive_places(frame, bag):
    picks = frame(
        "pick_id int, order_number string, wh_id int, item_number string, wave_id string, type string, status string, planned_quantity double",
        *[(i, f"o{i}", 1, item, "w", "PP", "RELEASED", 2.0) for i, item in enumerate("abcd", 1)],
        (5, "o5", 1, "a", "w", "RE", "RELEASED", 1.0), (6, "o6", 1, "a", "w", "PP", "RELEASED", 1.0),
    )
    stock = frame(
        STOCK,
        stock_row(1, "a", loc="OFF", qty=9.0), stock_row(2, "b", qty=9.0), stock_row(3, "c", qty=3.0, una=3.0),
        stock_row(4, "x", kind="4"),
    )
    loc = frame("location_id string, wh_id int, status string, pick_area string", ("A", 1, "E", "p"), ("OFF", 1, "I", "p"))
    area = frame("wh_id int, pick_area string", (1, "p"))
    log = frame("control_number string, wh_id int, item_number string, tran_type string", ("o6", 1, "zz", "301"))
    ship = frame("order_number string, wh_id int, transaction_code string", ("o9", 1, "936"))
    got = cut.zero_stock_lines(picks, stock, log, ship, loc, area, frame(LOG), storage_type="STORAGE")
    assert bag(got, "order_number", "item_number") == [("o1", "a"), ("o3", "c")]
    older = cut.zero_stock_lines(picks, stock, log, ship, item_level_start=True, storage_type="STORAGE")
    assert bag(older, "order_number") == [("o3",)]


def test_last_item_gate(frame, bag):
    picks = frame(
        "order_number string, wh_id int, status string, picked_quantity double",
        ("o1", 1, "PICKED", 0.0), ("o1", 1, "SHIPPED", 5.0), ("o2", 1, "PICKED", 1.0), ("o3", 1, "RELEASED", 0.0),
    )
    assert bag(cut.last_item_gate(picks), "order_number") == [("o1",)]


def test_attribute_columns_pivot(frame):
    values = frame("stored_attribute_id int, attribute_id string, attribute_value string", (1, "c", "red"), (1, "s", "XL"), (2, "zz", "no"))
    names = [f"generic_attribute_{i}" for i in range(1, 12)]
    one = frame(", ".join(f"{n} string" for n in names), ("s", None, "c", *[None] * 8))
    row = cut.attribute_columns(values, one).collect()
    assert [(r.stored_attribute_id, r.gen_attribute_value1, r.gen_attribute_value2, r.gen_attribute_value3) for r in row] == [(1, "XL", None, "red")]


def test_cancel_eligible_and_apply(frame, bag):
    orders = frame("order_number string, wh_id int, client_code string, display_order_number string", ("o1", 1, "c", "O1"), ("o2", 1, "c", "O2"))
    lines = frame(
        "order_number string, wh_id int, item_number string, line_number string, qty double, bo_qty double",
        ("o1", 1, "a", "1", 5.0, 0.0), ("o1", 1, "b", "2", 5.0, 5.0), ("o2", 1, "a", "1", 5.0, 0.0), ("o2", 1, "b", "2", 3.0, 0.0),
    )
    work = frame("item_number string, wh_id int", ("o1", 1), ("o2", 1), ("o1", 1))
    head = frame("shipment_id int, order_number string, wh_id int, transaction_code string", (1, "o1", 1, "361"), (2, "o2", 1, "340"))
    det = frame("shipment_id int, item_number string", (1, "b"), (2, "a"))
    found = cut.cancel_eligible(orders, work, lines, head, det)
    assert bag(found, "order_number", "item_number") == [("o1", "a"), ("o2", "b")]
    items = frame("item_number string, wh_id int, display_item_number string", ("a", 1, "A"), ("b", 1, "B"))
    units = frame("item_number string, wh_id int, uom string, conversion double", ("a", 1, "CX", 10.0), ("a", 1, "EA", 1.0), ("b", 1, "EA", 1.0))
    changes = cut.apply_cancel(found, orders, lines, items, units, head)
    assert bag(changes.inserts["t_al_host_shipment_master"], "order_number") == [("o2",)]  # o1 has its header
    details = changes.inserts["t_al_host_shipment_detail"]
    assert bag(details, "order_number", "item_number", "quantity_shipped", "uom") == [("o1", "a", 5.0, "EA"), ("o2", "b", 3.0, "EA")]
    assert bag(changes.updates["t_order"].rows, "order_number") == [("o1",)]


# --- moves -----------------------------------------------------------------------------------


def test_move_stock_conserves_and_drops_zero(frame, bag):
    stock = frame(STOCK, stock_row(1, "a", hu="h", qty=5.0), stock_row(2, "a", loc="B", qty=1.0), stock_row(3, "b", qty=2.0))
    todo = frame(
        "wh_id int, item_number string, qty double, from_location string, from_hu string, to_location string, to_hu string",
        (1, "a", 5.0, "A", "h", "B", None), (1, "b", 1.0, "A", None, "C", "k"),
    )
    after = moves.move_stock(stock, todo)
    assert bag(after, "item_number", "location_id", "hu_id", "actual_qty") == [
        ("a", "B", None, 6.0), ("b", "A", None, 1.0), ("b", "C", "k", 1.0),
    ]
    assert after.agg(F.sum("actual_qty")).first()[0] == 8.0


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("AB"), st.sampled_from([None, "h", "k"]), st.integers(1, 9), st.sampled_from([None, "l"])), max_size=8),
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 3), st.sampled_from("ABC"), st.integers(1, 9)), min_size=1, max_size=5),
)
def test_increments_then_merges_conserve_stock(frame, rows, deltas):
    """New rows have keys of their own, so a later repair touches no other row."""
    stock = frame(STOCK, *[stock_row(i, item, loc=loc, hu=hu, qty=float(q), lot=lot) for i, (item, loc, hu, q, lot) in enumerate(rows)])
    add = frame("item_number string, wh_id int, location_id string, qty double", *[(i, w, p, float(q)) for i, w, p, q in deltas])
    after = apply_change_set({"t_stored_item": stock}, moves.upsert_increment(stock, add, NOW, row_type="STORAGE"))["t_stored_item"]
    total = float(sum(r[3] for r in rows) + sum(d[3] for d in deltas))  # of what was there before, and what was added
    assert after.agg(F.sum("actual_qty")).first()[0] == total
    assert after.select("sequence").distinct().count() == after.count()
    hu = frame("hu_id string, wh_id int, parent_hu_id string, zone string", ("h", 1, "p", "z"), ("k", 1, "p", "z"))
    groups = moves.consolidate_hu(after, hu)
    one = apply_change_set({"t_stored_item": after, "t_hu_master": hu}, moves.apply_consolidation(groups, after, NOW))["t_stored_item"]
    assert one.agg(F.sum("actual_qty")).first()[0] == total and one.filter("hu_id IS NOT NULL").count() == 0
    items = frame("item_number string, wh_id int, lot_control string", *[(i, w, "N" if w == 2 else "Y") for i in "abc" for w in (1, 2, 3)])
    two = apply_change_set({"t_stored_item": one}, moves.apply_lot_merge(moves.merge_lots(one, items), one))["t_stored_item"]
    assert two.agg(F.sum("actual_qty")).first()[0] == total


def test_upsert_adds_up_deltas_first(frame, bag):
    stock = frame(STOCK, stock_row(1, "a", qty=5.0))
    deltas = frame("item_number string, wh_id int, location_id string, qty double", ("a", 1, "A", 2.0), ("a", 1, "A", 3.0), ("b", 1, "A", 4.0), ("b", 1, "A", 1.0))
    after = apply_change_set({"t_stored_item": stock}, moves.upsert_increment(stock, deltas, NOW, row_type="STORAGE"))
    assert bag(after["t_stored_item"], "item_number", "actual_qty") == [("a", 10.0), ("b", 5.0)]


def test_increment_goes_to_one_row_of_the_place(frame, bag):
    deltas = frame("item_number string, wh_id int, location_id string, qty double", ("a", 1, "A", 5.0), ("b", 1, "A", 2.0), ("c", 1, "A", 3.0))
    stock = frame(
        STOCK,
        stock_row(1, "a", hu="h", qty=1.0), stock_row(2, "a", hu="k", qty=2.0), stock_row(3, "a", lot="l", qty=4.0),
        # two rows under one key, and one without a key, cannot take it: it becomes a new row
        stock_row(7, "b", hu="h", qty=1.0), stock_row(7, "b", hu="k", qty=1.0), stock_row(None, "c", qty=9.0),
    )
    after = apply_change_set({"t_stored_item": stock}, moves.upsert_increment(stock, deltas, NOW, row_type="0"))["t_stored_item"]
    assert bag(after.filter("item_number = 'a'"), "sequence", "actual_qty") == [(1, 6.0), (2, 2.0), (3, 4.0)]
    assert bag(after.filter("item_number <> 'a'"), "item_number", "hu_id", "actual_qty", "type") == [
        ("b", "h", 1.0, "STORAGE"), ("b", "k", 1.0, "STORAGE"), ("b", None, 2.0, "0"), ("c", None, 3.0, "0"), ("c", None, 9.0, "STORAGE"),
    ]
    literal = moves.upsert_increment(stock, deltas.filter("item_number = 'a'"), NOW, row_type="0", strict=True)
    after = apply_change_set({"t_stored_item": stock}, literal)["t_stored_item"]
    assert bag(after.filter("item_number = 'a'"), "sequence", "actual_qty") == [(1, 6.0), (2, 7.0), (3, 9.0)]


def test_seeded_stock_can_be_repaired(frame, bag):
    """Seeded rows have keys, so a later repair finds them."""
    stock = frame(STOCK, stock_row(1, "a"))
    worklist = frame("item_number string, wh_id int", ("a", 1), ("b", 1), ("c", 1))
    seeded = stock.unionByName(moves.seed_missing(worklist, stock, "A", NOW).drop("fifo_date", "expiration_date"), allowMissingColumns=True)
    assert seeded.filter("sequence IS NULL").count() == 0 and seeded.select("sequence").distinct().count() == 3
    deltas = frame("item_number string, wh_id int, location_id string, qty double", ("b", 1, "A", 5.0))
    after = apply_change_set({"t_stored_item": seeded}, moves.upsert_increment(seeded, deltas, NOW, row_type="0"))["t_stored_item"]
    assert bag(after, "item_number", "actual_qty") == [("a", 1.0), ("b", 205.0), ("c", 200.0)]


MOVE = "move_id int, wh_id int, item_number string, qty double, from_location string, from_hu string, to_location string, to_hu string"


def one_by_one(stock, todo):
    """The moves in order, in plain Python."""
    held, out = {}, {}
    for _, item, wh, loc, hu, qty, *_ in stock:
        held[wh, item, loc, hu] = held.get((wh, item, loc, hu), 0) + qty
    below = {p: min(q, 0) for p, q in held.items()}
    for n, wh, item, qty, a, a_hu, b, b_hu in todo:
        source, target = (wh, item, a, a_hu), (wh, item, b, b_hu)
        asked = max(qty or 0, 0)
        given = max(min(asked, held.get(source, 0) - below.get(source, 0)), 0)
        held[source] = held.get(source, 0) - given
        held[target] = held.get(target, 0) + given
        out[n] = (given, asked - given)
    return {p: q for p, q in held.items() if q}, out


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("ABC"), st.sampled_from([None, "h"]), st.integers(-2, 9)), max_size=6),
    st.lists(
        st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(-1, 9)), st.sampled_from("ABC"), st.sampled_from([None, "h"]), st.sampled_from("ABC"), st.sampled_from([None, "h"])),
        min_size=1, max_size=14,
    ),
)
def test_moves_within_stock_are_those_of_a_loop(frame, rows, planned):
    stock = [stock_row(i, item, loc=loc, hu=hu, qty=float(q)) for i, (item, loc, hu, q) in enumerate(rows)]
    todo = [(n, 1, item, None if q is None else float(q), a, a_hu, b, b_hu) for n, (item, q, a, a_hu, b, b_hu) in enumerate(planned)]
    found = moves.move_within_stock(frame(STOCK, *stock), frame(MOVE, *todo), ["move_id"])
    balances, given = one_by_one(stock, todo)
    assert {r.move_id: (r.moved_qty, r.refused_qty) for r in found.moves.collect()} == given
    after = {(r.wh_id, r.item_number, r.location_id, r.hu_id): r.actual_qty for r in found.balances.collect()}
    assert after == balances and sum(after.values()) == sum(r[5] for r in stock)
    assert {r.move_id for r in found.refused.collect()} == {n for n, (_, refused) in given.items() if refused}


def test_a_shortage_passes_down_a_chain(frame, bag):
    """Ten places in a row, of which the first holds less than is asked: every later move lacks the same."""
    places = "ABCDEFGHIJ"
    todo = [(n, 1, "a", 7.0, a, None, b, None) for n, (a, b) in enumerate(zip(places, places[1:], strict=False))]
    found = moves.move_within_stock(frame(STOCK, stock_row(1, "a", qty=4.0)), frame(MOVE, *todo), ["move_id"])
    assert bag(found.moves, "moved_qty", "refused_qty") == [(4.0, 3.0)] * 9
    assert bag(found.balances, "location_id", "actual_qty") == [("J", 4.0)]


def test_moves_of_one_hot_place(spark):
    """A third of all moves from one place: ranges of its moves lie in different tasks, and the allocation goes on across them."""
    n = 30_000
    todo = spark.range(n).selectExpr(
        "cast(id as int) as move_id", "1 as wh_id", "'a' as item_number", "cast(id % 5 as double) as qty", "if(id % 3 = 0, 'HOT', concat('P', id)) as from_location",
        "cast(null as string) as from_hu", "'Z' as to_location", "cast(null as string) as to_hu",
    )
    stock = spark.createDataFrame([(1, "a", "HOT", None, 11_111.0)], "wh_id int, item_number string, location_id string, hu_id string, actual_qty double")
    found = moves.move_within_stock(stock, todo, ["move_id"])
    left, expected = 11_111, 0
    for i in range(0, n, 3):
        given = min(i % 5, left)
        left, expected = left - given, expected + (given < i % 5)
    assert found.refused.filter("from_location = 'HOT'").count() == expected > 0
    assert found.balances.agg(F.sum("actual_qty")).first()[0] == 11_111.0 == found.moves.agg(F.sum("moved_qty")).first()[0]


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 2), st.integers(1, 60)), min_size=1, max_size=4),
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 2), st.integers(0, 12)), max_size=40),
)
def test_move_fitting_takes_what_fits_into_the_rest(frame, planned, units):
    plans = frame("exception_id int, item_number string, wh_id int, quantity double, status string", *[(i, a, w, float(q), None) for i, (a, w, q) in enumerate(planned)])
    stock = frame(STOCK, *[stock_row(i, a, wh=w, qty=float(q)) for i, (a, w, q) in enumerate(units)])
    expected = set()
    for key in {p[:2] for p in planned}:
        rest = sum(q for a, w, q in planned if (a, w) == key)
        for size, sequence in sorted(((-q, i) for i, (a, w, q) in enumerate(units) if (a, w) == key and q)):
            if -size <= rest:
                rest += size
                expected.add(sequence)
    assert {r.sequence for r in moves.move_fitting(plans, stock, None, "Z").collect()} == expected


def test_move_fitting_fills_the_plan_past_units_that_do_not_fit(frame, bag):
    plans = frame("exception_id int, item_number string, wh_id int, quantity double, status string", (1, "a", 1, 10.0, None))
    stock = frame(STOCK, *[stock_row(i, "a", qty=q) for i, q in enumerate((6.0, 5.0, 4.0))])
    assert bag(moves.move_fitting(plans, stock, None, "Z"), "qty") == [(4.0,), (6.0,)]


def test_move_fitting_of_an_item_with_many_units(spark, settings_of):
    """Units of few sizes: an item is one row of sizes, and its units are numbered across many tasks."""
    settings_of(spark__sql__shuffle__partitions=32, spark__sql__adaptive__coalescePartitions__enabled="false")
    n = 1_000_000
    stock = spark.range(n).selectExpr(
        "id as sequence", "'a' as item_number", "1 as wh_id", "'A' as location_id", "cast(null as string) as hu_id", "cast(id % 3 + 2 as decimal(18,4)) as actual_qty"
    )
    plans = spark.createDataFrame([(1, "a", 1, None)], "exception_id int, item_number string, wh_id int, status string").selectExpr("*", "cast(1500001 as decimal(18,4)) as quantity")
    chosen = moves.move_fitting(plans, stock, None, "Z")
    sizes = {int(r.qty): r["count"] for r in chosen.groupBy("qty").count().collect()}
    assert sizes == {4: 333_333, 3: 55_556} and 4 * 333_333 + 3 * 55_556 == 1_500_000  # 1 is left, and no unit is so small
    tasks = [r["count"] for r in chosen.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 8 and max(tasks) < 0.3 * sum(tasks)


def test_move_fitting_prefix_and_strict(frame, bag):
    plans = frame("exception_id int, item_number string, wh_id int, quantity double, entered_value double, status string", (1, "a", 1, 10.0, None, None), (2, "b", 1, 2.0, None, None), (3, "a", 1, 99.0, None, "X"))
    stock = frame(
        STOCK,
        stock_row(1, "a", hu="h1", qty=6.0), stock_row(2, "a", hu="h2", qty=4.0), stock_row(3, "a", hu="h3", qty=1.0),
        stock_row(4, "a", hu="h4", qty=11.0), stock_row(5, "b", hu="h5", qty=3.0), stock_row(6, "a", wh=2, hu="h6", qty=1.0),
        stock_row(7, "a", loc="Z", hu="h7", qty=1.0),
    )
    moved = moves.move_fitting(plans, stock, "A", "Z")
    assert bag(moved, "hu_id") == [("h1",), ("h2",)]
    assert bag(moves.move_fitting(plans, stock, "A", "Z", strict=True), "hu_id") == [("h1",), ("h2",), ("h3",)]
    after = apply_update(plans, moves.settle_plans(moved, plans, NOW).updates["t_exception_log"])
    assert bag(after, "exception_id", "quantity", "entered_value", "status") == [
        (1, 0.0, 10.0, "X"), (2, 2.0, 0.0, "X"), (3, 99.0, None, "X"),
    ]


def test_merge_lots_keeps_one_row_and_the_total(frame, bag):
    stock = frame(
        STOCK,
        stock_row(1, "n", qty=1.0), stock_row(2, "n", qty=2.0), stock_row(3, "n", qty=4.0, lot="L1"), stock_row(4, "n", qty=8.0, lot="L2"),
        stock_row(5, "y", qty=1.0), stock_row(6, "y", qty=2.0, lot="L2"), stock_row(7, "y", qty=4.0, lot="L1"), stock_row(8, "z", qty=9.0),
    )
    items = frame("item_number string, wh_id int, lot_control string", ("n", 1, "N"), ("y", 1, "Y"), ("z", 1, "Y"))
    merged = moves.merge_lots(stock, items)
    assert bag(merged, "item_number", "keep", "kept_sequence", "added_qty", "new_qty", "deleted_rows") == [
        ("n", "NO_LOT", 1, 12.0, 13.0, 2), ("y", "LOT", 7, 1.0, 5.0, 1),
    ]
    after = apply_change_set({"t_stored_item": stock}, moves.apply_lot_merge(merged, stock))["t_stored_item"]
    assert bag(after, "sequence", "actual_qty") == [(1, 13.0), (2, 2.0), (6, 2.0), (7, 5.0), (8, 9.0)]
    strict = apply_change_set({"t_stored_item": stock}, moves.apply_lot_merge(merged, stock, strict=True))["t_stored_item"]
    assert bag(strict, "sequence", "actual_qty") == [(1, 13.0), (2, 14.0), (6, 3.0), (7, 5.0), (8, 9.0)]
    assert moves.merge_lots(after, items).count() == 0


def test_consolidate_hu_keeps_units_with_other_stock(frame, bag):
    stock = frame(
        STOCK,
        stock_row(1, "a", hu="h", qty=2.0), stock_row(2, "a", hu="k", qty=3.0), stock_row(3, "a", qty=1.0),
        stock_row(4, "b", hu="h", qty=4.0), stock_row(5, "c", hu="k", loc="Z", qty=7.0),
    )
    hu = frame("hu_id string, wh_id int, parent_hu_id string, zone string", ("h", 1, "p", "z"), ("k", 1, None, None))
    groups = moves.consolidate_hu(stock, hu, "A")
    changes = moves.apply_consolidation(groups, stock, NOW)
    tables = {"t_stored_item": stock.withColumn("sequence", F.col("sequence").cast("string")), "t_hu_master": hu}
    string_keys = {
        "updates": {"t_stored_item": type(changes.updates["t_stored_item"])(
            changes.updates["t_stored_item"].rows.withColumn("sequence", F.col("sequence").cast("string")), ("sequence",))},
        "deletes": {
            "t_stored_item": type(changes.deletes["t_stored_item"])(
                changes.deletes["t_stored_item"].rows.withColumn("sequence", F.col("sequence").cast("string")), ("sequence",)),
            "t_hu_master": changes.deletes["t_hu_master"],
        },
    }
    after = apply_change_set(tables, type(changes)(inserts=changes.inserts, **string_keys))
    assert bag(after["t_stored_item"], "item_number", "location_id", "hu_id", "actual_qty") == [
        ("a", "A", None, 6.0), ("b", "A", None, 4.0), ("c", "Z", "k", 7.0),
    ]
    assert bag(after["t_hu_master"], "hu_id") == [("k",)]


def test_move_by_client_shared_location_counts_once(frame, bag):
    stock = frame(STOCK, stock_row(1, "a", loc="S", hu="h", qty=5.0), stock_row(2, "a", loc="S", qty=9.0), stock_row(3, "b", loc="S", hu="h", qty=1.0))
    items = frame("item_number string, wh_id int, client_code string", ("a", 1, "c1"), ("b", 1, "c9"))
    control = frame(
        "wh_id int, client_code string, control_type string, c1 string",
        (1, "c2", "LOC_RECEB_IA", "S"), (1, "c3", "LOC_RECEB_IA", "S"), (1, "c1", "LOC_RECEB_IA", "HOME"), (1, "c1", "LOC_RECEB_SI", "S"),
    )
    found = moves.move_by_client(stock, items, control)
    assert bag(found, "item_number", "qty", "cc_loc") == [("a", 5.0, "HOME"), ("b", 1.0, None)]
    assert moves.client_moves(found).count() == 1


def test_claims_go_where_the_client_wants(frame, bag):
    po = frame(
        "po_number string, display_po_number string, wh_id int, client_code string, type_id string, status string",
        ("p1", "P1", 1, "004", "1767", "O"), ("p2", "P2", 1, "004", "1766", "O"), ("p3", "P3", 1, "004", "1767", "C"),
        ("p4", "P4", 1, "004", "1111", "O"),
    )
    lines = frame("po_number string, wh_id int, item_number string, qty double", ("p1", 1, "a", 2.0), ("p1", 1, "a", 3.0), ("p2", 1, "a", 1.0), ("p3", 1, "a", 9.0), ("p4", 1, "a", 9.0))
    lookup = frame("lookup_id string, lookup_type string", ("1767", "TYPE"), ("1766", "TYPE"), ("1111", "TYPE"))
    control = frame("wh_id int, client_code string, control_type string, c1 string", (1, "004", "LOC_RECEB_SI", "SI"), (1, "004", "LOC_RECEB_IA", "IA"))
    found = moves.claim_po_stock(po, lines, lookup, control)
    assert bag(found, "po_number", "qty", "location_id") == [("p1", 5.0, "SI"), ("p2", 1.0, "IA")]


def test_split_creates_only_missing_units(frame, bag):
    stock = frame(STOCK, stock_row(1, "a", hu="h", kind="1"), stock_row(2, "b", hu="h", kind="2"), stock_row(3, "a", hu="h", kind="3"))
    picks = frame("pick_id int, order_number string, wh_id int, wave_id string", (1, "multi", 1, "w"), (2, "multi", 1, "w"), (3, "mono", 1, "w"))
    lines = frame("order_number string, wh_id int, item_number string", ("multi", 1, "a"), ("multi", 1, "b"), ("multi", 1, "a"), ("mono", 1, "a"))
    found = moves.split_multi_orders(stock, picks, lines, "NEW", ["h"])
    assert bag(found, "pick_id", "itms") == [("1", 2), ("2", 2)]
    hu = frame("hu_id string, wh_id int", ("h", 1))
    changes = moves.apply_split(found, hu, NOW)
    assert changes.inserts["t_hu_master"].count() == 1
    assert bag(apply_update(stock, changes.updates["t_stored_item"]), "sequence", "hu_id") == [(1, "NEW"), (2, "NEW"), (3, "h")]
    assert moves.apply_split(found, frame("hu_id string, wh_id int", ("NEW", 1)), NOW).inserts["t_hu_master"].count() == 0


def test_confirm_load_skips_rows_without_pick_or_dock(frame, bag):
    stock = frame(
        "sequence int, item_number string, wh_id int, hu_id string, serial_number string, location_id string, actual_qty double",
        (1, "a", 1, "h1", "o1", "A", 2.0), (2, "b", 1, "h1", "o1", "A", 2.0), (3, "a", 1, "h2", "o1", "A", 2.0),
    )
    hu = frame("hu_id string, wh_id int, load_id string, control_number string, location_id string, type string", ("h1", 1, "L", "1", "A", "SO"), ("h2", 1, "none", "1", "A", "SO"))
    picks = frame("pick_id int, order_number string, item_number string, wh_id int, line_number string, planned_quantity double", (7, "o1", "a", 1, "1", 3.0))
    docks = frame("shipping_id string, door_location string", ("L", "D1"), ("none", None))
    found = moves.confirm_load(stock, hu, picks, docks)
    assert bag(found, "sequence", "dock", "pick_id") == [(1, "D1", 7)]
    changes = moves.apply_load(found)
    assert bag(apply_update(hu, changes.updates["t_hu_master"]), "hu_id", "location_id", "type") == [("h1", "D1", "LO"), ("h2", "A", "SO")]


def test_restore_wave_only_touches_unplanned_lines(frame, bag):
    waves = frame(
        "wave_id string, order_number string, line_number string, item_number string, wh_id int, planned_qty double, wave_detail_line_id int, wave_detail_id int",
        ("w", "o", "1", "a", 1, 5.0, 1, 10), ("w", "o", "2", "b", 1, 6.0, 2, 10), ("w", "p", "1", "a", 1, 7.0, 3, 11), ("x", "q", "1", "a", 1, 7.0, 4, 12),
    )
    picks = frame("item_number string, wh_id int, line_number string, order_number string, planned_quantity double", ("b", 1, "2", "o", 6.0), ("a", 1, "1", "p", 0.0))
    found = moves.restore_wave(waves, picks, ["w"])
    assert bag(found, "order_number", "line_number", "qty_afo") == [("o", "1", 5.0), ("p", "1", 7.0)]
    detail = frame("wave_detail_id int, wave_id string, order_number string", (10, "w", "o"), (11, "w", "p"), (12, "x", "q"))
    orders = frame("order_number string, wh_id int, line_number string, afo_plan_qty double", ("o", 1, "1", 0.0), ("p", 1, "1", 3.0))
    after = apply_change_set(
        {"t_order_detail": orders, "t_afo_wave_detail_line": waves, "t_afo_wave_detail": detail},
        moves.apply_restore(found, waves, detail, NOW),
    )
    assert bag(after["t_order_detail"], "order_number", "afo_plan_qty") == [("o", 5.0), ("p", 3.0)]
    assert bag(after["t_afo_wave_detail"], "wave_detail_id") == [(10,), (12,)]


# --- interface and queue ---------------------------------------------------------------------


def test_transfer_lines(frame, bag):
    det = frame(
        "shipment_detail_id int, shipment_id int, order_number string, wh_id int, item_number string, line_number string, quantity_shipped double, host_group_id string",
        (1, 1, "900123", 1, "a", "1", 2.0, "g"), (2, 1, "900124", 1, "a", "1", 2.0, "0"), (3, 1, "800", 1, "a", "1", 2.0, "g"), (4, 2, "900125", 1, "a", "1", 2.0, "g"),
    )
    head = frame("shipment_id int, load_id string", (1, "L"), (2, "M"))
    notes = frame("order_number string, wh_id int, item_number string, line_number string, br_order_number_orig string, comment_text string", ("900123", 1, "a", "1", "orig", "txt"))
    found = interface.transfer_lines(det, head, notes, frame("load_id string", ("L",)))
    assert bag(found, "shipment_detail_id", "br_order_number_orig") == [(1, "orig")]
    table = det.withColumns({"gen_attribute_value1": F.lit(None).cast("string"), "gen_attribute_value8": F.lit(None).cast("string")})
    changes = interface.apply_transfer(found)
    after = apply_update(table, changes.updates["t_al_host_shipment_detail"]).filter("shipment_detail_id = 1").first()
    assert (after.host_group_id, after.gen_attribute_value1) == ("0", "g")
    new = changes.inserts["t_al_host_shipment_detail"].first()
    assert (new.order_number, new.gen_attribute_value6, new.host_group_id) == ("orig", "900123", "g")


def test_restore_so_number_moves_the_old_one(frame, bag):
    table = frame(
        "host_ship_detail_id int, so_number string, so_line_number string, wh_id int, item_number string, host_group_id string, container_type string, transaction_code string, client_code string, asn_number string",
        (1, "9001", "1", 1, "a", "g", "A", "336", "003", None), (2, "8001", "1", 1, "a", "g", "A", "336", "003", None),
    )
    notes = frame("order_number string, wh_id int, line_number string, item_number string, br_order_number_orig string", ("9001", 1, "1", "a", "orig"))
    changes = interface.apply_restored_number(interface.restore_so_number(table, notes))
    after = apply_update(table, changes.updates["t_al_host_ship_detail"])
    assert bag(after, "host_ship_detail_id", "so_number", "asn_number", "container_type") == [(1, "orig", "9001", "T"), (2, "8001", None, "A")]


def test_replies_are_kept_or_cut_as_asked(frame):
    replies = frame("host_group_id string, reply string", ("g", "0123456789abc"))
    assert interface.record_replies(replies).updates["t_al_host_ship_detail"].rows.first().asn_line_number == "0123456789abc"
    cut_to = interface.record_replies(replies, length=10).updates["t_al_host_ship_detail"].rows
    assert cut_to.first().asn_line_number == "0123456789"


def test_close_store_po_pairs_items_and_numbers(frame, bag):
    po = frame("po_number string, wh_id int, vendor_code string, display_po_number string, client_code string, status string, type_id string", ("p", 1, "v", "P", "c", "O", "1637"), ("q", 1, "v", "Q", "c", "O", "1637"))
    work = frame("item_number string", ("p",), ("q",), ("p",))
    lines = frame("po_number string, wh_id int, item_number string, qty double", ("p", 1, "a", 1.0), ("p", 1, "b", 2.0), ("q", 1, "a", 1.0))
    notices = frame(
        "display_po_number string, wh_id int, item_number string, hu_id string, context string, processing_code string, document_type string, distro_number string",
        ("P", 1, "a", "h1", "BUFFER", "New", "T", "1"), ("P", 1, "b", "h2", None, "NEW", None, "1"), ("P", 1, "b", "h3", "X", "DONE", "T", "1"), ("Q", 1, "a", "h4", "X", "NEW", "T", "1"),
    )
    received = frame("po_number string", ("q",))
    found = interface.close_store_po(po, work, lines, notices, received)
    assert bag(found, "item_number", "hu_id", "status", "scac_code", "line_number") == [("a", "h1", "TRBL", "T-1", 1), ("b", "h2", "ATS", "-1", 2)]


def test_receipts_from_erp_number_each_order(frame, bag):
    po = frame("po_number string, wh_id int, vendor_code string, display_po_number string, client_code string, status string, type_id string", ("p", 1, "v", "P", "c", "C", "1763"), ("q", 1, "v", "Q", "c", "C", "1763"))
    ship = frame("shipment int, bol_no string, to_loc int", (1, "P", 1), (2, "Q", 1))
    sku = frame("shipment int, item int, carton string, distro_type string, distro_no int, qty_expected double", (1, 7, "c1", "T", 1, 2.0), (1, 7, "c1", "T", 1, 3.0), (1, 8, "c2", "T", 1, 1.0), (2, 7, "c3", "T", 1, 1.0))
    notices = frame("hu_id string, context string", ("c1", "X"), ("c1", "BUFFER"), ("c2", None))
    got = interface.receipts_from_erp(po, ship, sku, notices)
    assert bag(got, "po_number", "line_number", "item_number", "qty_received", "status") == [
        ("p", 1, "7", 5.0, "TRBL"), ("p", 2, "8", 1.0, "ATS"), ("q", 1, "7", 1.0, None),
    ]


def test_claim_and_complete_only_own_events(frame, bag):
    schema = "event_id int, procobject string, status string, date_added timestamp_ntz, date_started timestamp_ntz, date_finished timestamp_ntz, alert_id int, claim_id string"
    rows = [(i, "p", "NEW", datetime(2024, 1, 1 + i % 3), None, None, None, None) for i in range(6)]
    rows += [(10, "p", "NEW", NOW, NOW, None, None, None), (11, "z", "TEMP_STATUS", NOW, NOW, None, None, "other")]
    table = frame(schema, *rows)
    claimed = apply_update(table, queue.claim_batch(table, "p", 3, NOW).updates["ea_t_async_work_queue"])
    mine = claimed.filter("status = 'TEMP_STATUS' AND procobject = 'p'")
    assert bag(mine, "event_id") == [(0,), (1,), (3,)]
    claim = mine.first().claim_id
    done = apply_update(claimed, queue.complete_batch(claimed, NOW, 100, F.lit(claim)).updates["ea_t_async_work_queue"])
    assert bag(done.filter("status = 'SUCCESS'"), "event_id", "alert_id") == [(0, 100), (1, 100), (3, 100)]
    assert done.filter("status = 'TEMP_STATUS'").count() == 1
    assert queue.complete_batch(claimed, NOW, 100).updates["ea_t_async_work_queue"].rows.count() == 4


def test_extract_is_referentially_complete(frame):
    orders = frame("order_number string, wh_id int, order_id string, order_date timestamp_ntz", *[(f"o{i}", 1, f"id{i}", datetime(2024, 3, 14 + i % 3)) for i in range(9)])
    lines = frame("order_number string, wh_id int, item_number string, line_number string, qty double", *[(f"o{i}", 1, f"i{i % 4}", "1", 1.0) for i in range(9)])
    items = frame("item_number string, wh_id int, item_master_id string", *[(f"i{i}", 1, f"m{i}") for i in range(6)])
    out = queue.consistent_extract(orders, lines, items, datetime(2024, 3, 15), 4)
    assert out["t_order"].count() == 4
    assert out["lines"].join(out["t_order"], ["order_number", "wh_id"], "left_anti").count() == 0
    assert out["lines"].join(out["t_item_master"], ["item_number", "wh_id"], "left_anti").count() == 0
    assert out["t_order_detail"].filter("order_id IS NULL OR item_master_id IS NULL").count() == 0
    assert out["t_order_detail"].count() == out["lines"].count()
