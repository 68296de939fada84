"""The whole cut on the smallest test data: phases agree with each other and with the tables."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmend.bindings.cut import cut_tables
from shelfmend.operators.cut import apply_cut, classify_cut, cut_cycle, cut_phases, last_item_gate, pending_cancels
from shelfmend.plans.changeset import apply_update
from shelfmend.plans.changeset import ChangeSet
from shelfmend.sources.phases import finished, run_phases
from shelfmend.sources.samples import Samples
from shelfmend.sources.snapshots import publish, published_names, read_snapshot

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test data not present")


def test_cut_cycle(spark):
    before = cut_tables(Samples(spark, FOLDER))
    result = cut_cycle(before, datetime(2024, 1, 31), storage_type="STORAGE")
    assert list(result.phases) == ["detect", "cut", "status", "invoice", "tasks", "cancel", "trace", "send"]
    after = result.tables
    for name, table in before.items():
        assert set(table.columns) <= set(after[name].columns), name

    log = after["t_exception_log"]
    assert log.count() > before["t_exception_log"].count()
    # every open log row of a decided order is marked, and its cancel message is queued
    assert log.filter("suggested_value = 'PEND'").count() == 0
    decided = log.filter("suggested_value = 'OK'").select("control_number").distinct().count()
    services = result.phases["cancel"].outbox
    assert services.count() == decided > 0
    codes = result.phases["cancel"].inserts["t_al_host_shipment_master"].groupBy("transaction_code").count().collect()
    by_service = {r.service: r["count"] for r in services.groupBy("service").count().collect()}
    by_code = {r.transaction_code: r["count"] for r in codes}
    assert by_code.get("360", 0) == by_service.get("EXP_CANCEL_ORDER", 0)
    assert by_code.get("361", 0) == by_service.get("EXP_CANCEL_PARTIAL_ORDER", 0)

    # every cancelled line without a log row of its own is traced under the code of its message
    traced = result.phases["trace"].audit.select("control_number", F.col("tran_type").alias("transaction_code")).distinct()
    sent = result.phases["cancel"].inserts["t_al_host_shipment_master"].select(
        F.col("order_number").cast("string").alias("control_number"), "transaction_code"
    )
    assert traced.count() > 0 and traced.exceptAll(sent).count() == 0

    # cut picks are no longer released; nothing else changed its planned quantity
    cut_picks = after["t_pick_detail"].filter("user_assigned = 'HJS_CORTE'")
    assert cut_picks.filter("status <> 'PICKED'").count() == 0 < cut_picks.count()
    total = F.sum("planned_quantity")
    assert after["t_pick_detail"].agg(total).first()[0] == before["t_pick_detail"].agg(total).first()[0]

    # invoices only for orders past the gate
    headers = result.phases["invoice"].inserts["t_al_host_shipment_master"].select("order_number", "wh_id")
    gate = last_item_gate(after["t_pick_detail"])
    assert headers.join(gate, ["order_number", "wh_id"], "left_anti").count() == 0


def test_second_run_sends_nothing_twice(spark):
    before = cut_tables(Samples(spark, FOLDER))
    first = cut_cycle(before, datetime(2024, 1, 31), storage_type="STORAGE")
    second = cut_cycle(first.tables, datetime(2024, 2, 1), storage_type="STORAGE")
    assert second.phases["cancel"].outbox.count() == 0 and second.phases["trace"].audit.count() == 0


def test_items_cut_together_leave_nothing(spark, frame):
    """Two items of one order are cut: each is the other's last, so the order is cancelled as a whole."""
    log = frame(
        "control_number string, wh_id int, item_number string, tran_type string, lot_number string, status string,"
        " suggested_value string, quantity double, load_id int, exception_id string",
        ("o", 1, "a", "033", "PRO_E", None, None, 3.0, 1, "x"), ("o", 1, "b", "033", "PRO_E", None, None, 2.0, 1, "y"),
        ("p", 1, "a", "033", "PRO_E", "PARTIAL", "PEND", 3.0, 1, "z"),
    )
    lines = frame(
        "order_number string, wh_id int, item_number string, bo_qty double, qty double, afo_plan_qty double",
        ("o", 1, "a", 0.0, 3.0, 0.0), ("o", 1, "b", 0.0, 2.0, 0.0), ("p", 1, "a", 3.0, 3.0, 0.0),
        ("p", 1, "c", 0.0, 1.0, 0.0),
    )
    ship = frame("shipment_id string, order_number string, wh_id int, transaction_code string")
    sent = frame("shipment_id string, item_number string")
    changes = apply_cut(classify_cut(log, lines, ship, sent), log)
    log = apply_update(log, changes.updates["t_exception_log"])
    lines = apply_update(lines, changes.updates["t_order_detail"])
    found = pending_cancels(log, lines, ship, sent).collect()
    # the order an earlier run left pending is cancelled with it
    assert sorted((r.control_number, r.tipo) for r in found) == [("o", "COMPLETE"), ("p", "PARTIAL")]


class Killed(Exception):
    pass


def state_of(tables):
    """What a run leaves: messages, cancels and statuses."""
    return {
        name: sorted(map(str, tables[name].select(*columns).collect()))
        for name, columns in {
            "outbox": ["service", "group_id"], "t_order": ["order_number", "status"],
            "t_exception_log": ["control_number", "item_number", "status", "suggested_value"],
            "t_al_host_shipment_master": ["order_number", "transaction_code", "host_group_id"],
        }.items()
    }


def small_cut(spark):
    """A third of the orders with all that belongs to them."""
    tables = cut_tables(Samples(spark, FOLDER))
    keys = {"t_pick_detail": "order_number", "t_order": "order_number", "t_order_detail": "order_number", "t_al_host_shipment_master": "order_number", "t_exception_log": "control_number"}
    return {n: t.filter(F.col(keys[n]) % 3 == 0) if n in keys else t for n, t in tables.items()}


def test_killed_run_goes_on_to_the_same_state(spark, tmp_path):
    """Killed after every third phase, and once between a phase's decision and its marker."""
    tables, as_of = small_cut(spark), datetime(2024, 1, 31)
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    for root in (whole, broken):
        publish(tables, root, "2024-01-30")
    run = "2024-01-31T0800"
    phases = cut_phases(as_of, storage_type="STORAGE", run=run)
    assert run_phases(spark, whole, run, phases) == list(phases) == finished(spark, whole, run, phases)
    expected = state_of(read_snapshot(spark, whole))
    assert len(expected["outbox"]) == len(set(expected["outbox"])) > 0

    starts = []
    while len(finished(spark, broken, run, phases)) < len(phases):
        begun = []

        def watched(name, phase, begun=begun):
            def step(now):
                if len(begun) == 3:
                    raise Killed
                begun.append(name)
                changes = phase(now)
                if name == "cancel" and "cancel" not in [s for one in starts for s in one]:
                    starts.append(list(begun))
                    raise Killed  # decided, but not published
                return changes

            return step

        try:
            run_phases(spark, broken, run, {n: watched(n, p) for n, p in phases.items()})
        except Killed:
            pass
        starts.append(begun)
    assert sum("cancel" in s for s in starts) >= 2 and len(starts) >= 3
    assert state_of(read_snapshot(spark, broken)) == expected
    assert run_phases(spark, broken, run, phases) == []  # a finished run sends nothing again
    assert state_of(read_snapshot(spark, broken)) == expected


def test_run_is_not_continued_past_other_snapshots(spark, frame, tmp_path):
    root, t = str(tmp_path / "s"), frame("a int", (1,))
    publish({"t": t}, root, "2024-01-01")
    phases = {"one": lambda now: ChangeSet(inserts={"t": t}), "two": lambda now: ChangeSet(inserts={"t": t})}

    def dies(now):
        raise Killed

    with pytest.raises(Killed):
        run_phases(spark, root, "2024-01-02", {**phases, "two": dies})
    assert published_names(spark, root) == {"2024-01-01", "2024-01-02.000-one"} and read_snapshot(spark, root)["t"].count() == 2
    with pytest.raises(ValueError):
        run_phases(spark, root, "2024-01-02", {"other": phases["one"], "one": phases["two"], "two": phases["two"]})
    publish({"t": t}, root, "2024-01-03")
    with pytest.raises(ValueError):
        run_phases(spark, root, "2024-01-02", phases)
    assert run_phases(spark, root, "2024-01-04", phases) == ["one", "two"] and read_snapshot(spark, root)["t"].count() == 3
