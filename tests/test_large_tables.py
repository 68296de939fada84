"""What only larger tables bring out: long keys, estimates that are far too small, many rounds."""

import time
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from compare import differences

from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from shelfmend import session
from shelfmend.operators import cut, interface, missing, moves
from shelfmend.plans import joins
from shelfmend.plans.changeset import with_id
from shelfmend.plans.numbering import _ensure_checkpoint_dir, pinned
from shelfmend.sources.samples import Samples


@pytest.fixture
def suppliers(spark, tmp_path):
    """Suppliers with keys of one to five digits; some have no location yet."""
    keys = [(7, 3500.0), (1234, 100.0), (1235, 5000.0), (2345, 100.0), (23451, 100.0), (12, -5.0), (None, 1.0)]
    rows = [(k, f"S{k}", 1, a) for k, a in keys]
    frame = spark.createDataFrame(rows, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    frame.coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    return str(tmp_path), con


@pytest.mark.parametrize("name", ["missing_location_rows", "missing_zone_rows"])
def test_long_store_numbers_are_cut_as_in_the_sql(spark, suppliers, name):
    folder, con = suppliers
    problems, rows = differences(queries()[name](spark, folder), con, oracle_sql()[name])
    assert not problems and rows > 3


def test_strict_locations_take_three_characters(frame, bag):
    stores = frame("wh_id string, store_number string", ("464", "1234"), ("464", "9"))
    existing = frame("wh_id string, location_id string", ("464", "CTN_LJ_009.1"))
    assert bag(missing.missing_location_rows(stores, existing, strict=True), "location_id") == [("CTN_LJ_123.1",)]


def _estimate(frame) -> int:
    return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@pytest.mark.parametrize("view", ["items", "barcodes", "units", "containers", "pick_areas"])
def test_estimates_count_every_warehouse(spark, tmp_path, view):
    """A static broadcast goes by the estimate: it has to grow with the five rows made of each."""
    size = {
        "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
    }
    rows = {
        "part": [(k, f"P{k}", "B", "T", k % 50 + 1, 1.0) for k in range(500)],
        "supplier": [(k, f"S{k}", 1, 2000.0) for k in range(500)],
        "nation": [(k, f"N{k}", 1) for k in range(500)],
    }
    for table, kind in size.items():
        spark.createDataFrame(rows[table], kind).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    samples = Samples(spark, str(tmp_path))
    made = getattr(samples, view)()
    source = samples.table({"pick_areas": "nation", "containers": "supplier"}.get(view, "part"))
    assert _estimate(made) >= 5 * _estimate(source.select(source.columns[0]))
    assert made.groupBy("wh_id").count().count() == 5 and made.count() >= 2500


def test_later_rounds_take_only_items_that_changed(spark, monkeypatch):
    """One item passes a shortage down six places; the other 200 are settled by the first round."""
    sizes, low = [], moves.running_low

    def counted(events, *rest):
        sizes.append(events.count())
        return low(events, *rest)

    monkeypatch.setattr(moves, "running_low", counted)
    chain = [(n, "chain", a, b) for n, (a, b) in enumerate(zip("ABCDEF", "BCDEFG", strict=True))]
    rest = [(100 + 2 * i + k, f"i{i}", a, b) for i in range(200) for k, (a, b) in enumerate(("AB", "BC"))]
    todo = spark.createDataFrame(
        [(n, 1, item, 3.0, a, None, b, None) for n, item, a, b in chain + rest],
        "move_id int, wh_id int, item_number string, qty double, from_location string, from_hu string, to_location string, to_hu string",
    )
    stock = spark.createDataFrame(
        [(1, item, "A", None, 1.0 if item == "chain" else 5.0) for item in ["chain", *(f"i{i}" for i in range(200))]],
        "wh_id int, item_number string, location_id string, hu_id string, actual_qty double",
    )
    found = moves.move_within_stock(stock, todo, ["move_id"])
    assert {(r.item_number == "chain", r.moved_qty) for r in found.moves.collect()} == {(True, 1.0), (False, 3.0)}
    assert sizes[0] > 800 and len(sizes) > 5 and max(sizes[1:]) <= 12


def test_tasks_and_broadcasts_are_bounded(spark):
    """Limits above ours are lowered, smaller ones of the cluster stay."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.sources.fileCompressionFactor"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("128MB", "2m", "1.0"), strict=True):
            spark.conf.set(k, v)
        session.tune(spark)
        assert [spark.conf.get(k) for k in keys] == [str(16 << 20), "2m", "16.0"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_items_are_dealt_out_before_they_are_multiplied(spark, tmp_path):
    """A file of one task is spread first; a single task would combine all items of all warehouses."""
    kind = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    rows = [(k, f"P{k}", "B", "T", k % 50 + 1, 1.0) for k in range(500)]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = Samples(spark, str(tmp_path)).items()
        assert made.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hashes_of_keys_do_not_travel(frame):
    """A join shuffles its rows without a column of hashes."""
    left, right = frame("a bigint, v bigint", (1, 2)), frame("a bigint, w bigint", (1, 3))
    plan = joins.attach(left, right, ["a"])._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan
    assert not [line for line in plan.splitlines() if "Project" in line and "xxhash64" in line]


def _read_again(frame) -> bool:
    return "Aggregate" in frame._jdf.queryExecution().optimizedPlan().toString()


def test_increments_are_added_up_once(frame):
    """The rows raised and the rows made come from one stored plan."""
    stock = frame(
        "sequence string, item_number bigint, wh_id bigint, location_id string, actual_qty double", ("a", 1, 1, "L", 2.0), ("b", 2, 1, "L", 1.0)
    )
    deltas = frame("item_number bigint, wh_id bigint, location_id string, qty double", (1, 1, "L", 4.0), (1, 1, "L", 1.0), (3, 1, "L", 7.0))
    changes = moves.upsert_increment(stock, deltas, datetime(2001, 12, 1), "0")
    raised, made = changes.updates["t_stored_item"].rows, changes.inserts["t_stored_item"]
    assert not _read_again(raised) and not _read_again(made)
    assert [(r.sequence, r.actual_qty) for r in raised.collect()] == [("a", 5.0)]
    assert [(r.item_number, r.actual_qty) for r in made.collect()] == [(3, 7.0)]


def test_cartons_meet_their_order_once(frame):
    """Receipts read orders, cartons and notices once each; cartons with notices of both kinds are troubled, others without have no status."""
    po = frame(
        "po_number bigint, wh_id bigint, vendor_code bigint, display_po_number string, client_code bigint, status string, type_id string",
        (1, 1, 9, "PO1", 2, "C", "x"), (2, 1, 9, "PO2", 2, "O", "x"),
    )
    ships = frame("shipment bigint, bol_no string, to_loc bigint", (11, "PO1", 1), (12, "PO2", 1))
    cartons = frame(
        "shipment bigint, item bigint, carton string, distro_type string, distro_no bigint, qty_expected double",
        (11, 5, "C1", "A", 7, 1.0), (11, 5, "C1", "A", 7, 2.0), (11, 6, "C2", "A", 7, 4.0), (12, 5, "C3", "A", 7, 8.0),
    )
    notices = frame("hu_id string, context string", ("C1", "BUFFER"), ("C1", "OTHER"), ("C3", "OTHER"), (None, "BUFFER"))
    made = interface.receipts_from_erp(po, ships, cartons, notices, type_id=None)
    assert sorted((r.item_number, r.hu_id, r.qty_received, r.status, r.line_number) for r in made.collect()) == [
        ("5", "C1", 3.0, "TRBL", 1), ("6", "C2", 4.0, None, 2),
    ]


def test_waves_are_known_before_their_lines_are_met(frame, monkeypatch):
    """Wave ids are distinct and stored when the lines are joined; many picks of a wave are one row there."""
    stored, pinned = [], moves.pinned
    monkeypatch.setattr(moves, "pinned", lambda rows: stored.append(rows.collect()) or pinned(rows))
    lines = frame(
        "wave_id bigint, order_number bigint, line_number int, item_number bigint, wh_id bigint, planned_qty double, wave_detail_line_id string",
        (7, 1, 1, 5, 1, 3.0, "a"), (8, 2, 1, 5, 1, 4.0, "b"),
    )
    picks = frame("order_number bigint, line_number int, item_number bigint, wh_id bigint, planned_quantity double", (9, 1, 5, 1, 1.0))
    waves = frame("wave_id bigint", (7,), (7,), (None,))
    rows = moves.restore_wave(lines, picks, waves).collect()
    assert [(r.wave_detail_line_id, r.qty_afo, r.dif) for r in rows] == [("a", 3.0, 3.0)]
    assert sorted(r.wave_id or 0 for r in stored[0]) == [0, 7]


def _written(spark):
    """Pinned rows in the shared folder, and shuffle files on this machine."""
    _ensure_checkpoint_dir(spark)
    shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for p in shared.glob("pinned-*")}, {f.name for d in local for f in Path(d).rglob("shuffle_*.data")}


def test_pinned_rows_leave_no_shuffles(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id % 100 AS k", "id AS v").groupBy("k").agg(F.sum("v").alias("v"))
    _, before = _written(spark)
    kept = pinned(rows)
    for _ in range(50):
        _, after = _written(spark)
        if after <= before:
            break
        time.sleep(0.1)
    assert after <= before
    assert kept.count() == 100 and sorted(kept.columns) == ["k", "v"]
    assert pinned(spark.range(3).selectExpr("id", "NULL AS nothing")).count() == 3  # a type that files lack


def test_moves_leave_only_their_result(spark, frame):
    stock = frame("wh_id int, item_number int, location_id string, hu_id string, actual_qty double", (1, 5, "A", None, 4.0), (1, 6, "A", None, 2.0))
    planned = frame(
        "n int, wh_id int, item_number int, qty double, from_location string, from_hu string, to_location string, to_hu string",
        (1, 1, 5, 6.0, "A", None, "B", None), (2, 1, 5, 6.0, "B", None, "C", None), (3, 1, 5, 6.0, "C", None, "D", None), (4, 1, 6, 1.0, "A", None, "B", None),
    )
    before, _ = _written(spark)
    moved = moves.move_within_stock(stock, planned, ["n"])
    after, _ = _written(spark)
    assert len(after - before) == 1
    assert [(r.n, r.moved_qty, r.refused_qty) for r in moved.moves.orderBy("n").collect()] == [(1, 4.0, 2.0), (2, 4.0, 2.0), (3, 4.0, 2.0), (4, 1.0, 0.0)]
    assert {(r.item_number, r.location_id, r.actual_qty) for r in moved.balances.collect()} == {(5, "D", 4.0), (6, "A", 1.0), (6, "B", 1.0)}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_restored_waves_are_worked_out_step_by_step(frame):
    """The tables change by rows that are written out: their joins are done, and their shuffles gone."""
    lines = frame(
        "wave_id bigint, order_number bigint, line_number int, item_number bigint, wh_id bigint, planned_qty double, wave_detail_line_id string, wave_detail_id bigint",
        (7, 1, 1, 5, 1, 3.0, "a", 70), (7, 2, 1, 5, 1, 4.0, "b", 71), (7, 2, 2, 6, 1, 4.0, "c", 71),
    )
    picks = frame("order_number bigint, line_number int, item_number bigint, wh_id bigint, planned_quantity double", (2, 2, 6, 1, 1.0))
    details = frame("wave_detail_id bigint, wave_id bigint, order_number bigint", (70, 7, 1), (71, 7, 2))
    changes = moves.apply_restore(moves.restore_wave(lines, picks, [7]), lines, details, datetime(2024, 1, 1))
    empty = changes.deletes["t_afo_wave_detail"].rows
    assert "Join" not in _plan(empty) and [r.wave_detail_id for r in empty.collect()] == [70]
    assert {r.wave_detail_line_id for r in changes.deletes["t_afo_wave_detail_line"].rows.collect()} == {"a", "b"}
    log = changes.inserts["t_exception_log"].collect()
    assert [(r.tracking_number, r.line_number, r.quantity) for r in sorted(log, key=lambda r: r.tracking_number)] == [(1, 1, 3.0), (2, 1, 4.0)]
    assert all(r.exception_date == r.exception_time == datetime(2024, 1, 1) for r in log)


def test_emptied_units_are_written_out(frame):
    stock = frame(
        "sequence bigint, item_number bigint, wh_id bigint, location_id string, hu_id string, lot_number string, type string, actual_qty double",
        (1, 5, 1, "A", "U", None, "STORAGE", 2.0), (2, 5, 1, "A", None, None, "STORAGE", 1.0), (3, 6, 1, "A", "V", None, "STORAGE", 1.0),
    )
    units = frame("hu_id string, wh_id bigint, parent_hu_id string, zone string", ("U", 1, None, "Z"))
    changes = moves.apply_consolidation(moves.consolidate_hu(stock, units), stock, datetime(2024, 1, 1))
    emptied = changes.deletes["t_stored_item"].rows
    assert "Join" not in _plan(emptied) and [(r.sequence, r.hu_id) for r in emptied.collect()] == [(1, "U")]


def test_cancelled_lines_are_met_once(frame):
    """Lines, messages and orders are made of one join of the order lines with the eligible ones."""
    eligible = frame("order_number bigint, wh_id bigint, item_number bigint, line_number int, qty double, bo_qty double", (1, 1, 5, 1, 3.0, 0.0), (1, 1, 5, 1, 3.0, 0.0))
    orders = frame("order_number bigint, wh_id bigint, client_code string, display_order_number string", (1, 1, "c", "d1"), (2, 1, "c", "d2"))
    lines = frame("order_number bigint, wh_id bigint, item_number bigint, line_number int, qty double, bo_qty double", (1, 1, 5, 1, 3.0, 0.0), (1, 1, 6, 2, 2.0, 2.0), (2, 1, 5, 1, 9.0, 0.0))
    items = frame("item_number bigint, wh_id bigint, display_item_number string", (5, 1, "i5"))
    units = frame("item_number bigint, wh_id bigint, uom string, conversion int", (5, 1, "EA", 1))
    sent = frame("shipment_id string, order_number bigint, wh_id bigint, transaction_code string")
    changes = cut.apply_cancel(eligible, orders, lines, items, units, sent)
    updates = {t: u.rows for t, u in changes.updates.items()}
    assert all("Join" not in _plan(rows) for rows in updates.values())
    assert [(r.order_number, r.item_number, r.line_number, r.bo_qty) for r in updates["t_order_detail"].collect()] == [(1, 5, 1, 3.0)]
    assert [(r.order_number, r.status) for r in updates["t_order"].collect()] == [(1, "C")]
    assert [(r.item_number, r.quantity_shipped) for r in changes.inserts["t_al_host_shipment_detail"].collect()] == [(5, 3.0)]


def test_ids_are_not_shuffled(frame):
    rows = with_id(frame("a int, b string", (1, "x"), (1, "x"), (None, "y")), "id")
    assert len({r.id for r in rows.collect()}) == 3
    exchange = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert exchange and not any("_id#" in line for line in exchange)
