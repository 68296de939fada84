"""Claims that expire, extracts along foreign keys, number ranges of parallel jobs."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from shelfmend.operators import missing, queue
from shelfmend.plans.changeset import Update, apply_update, with_id
from shelfmend.plans.closure import ForeignKey, closed_extract, closed_keys
from shelfmend.sources.sequences import numbered_from, reserve

NOW = datetime(2024, 3, 15, 8)
LEASE = timedelta(minutes=30)
SCHEMA = (
    "event_id int, procobject string, status string, date_added timestamp_ntz, date_started timestamp_ntz, "
    "date_finished timestamp_ntz, alert_id int, claim_id string, retry_count int"
)
TABLE = "ea_t_async_work_queue"


@pytest.fixture
def events(frame):
    rows = [(i, "p", "NEW", datetime(2024, 1, 1 + i % 3), None, None, None, None, 0) for i in range(40)]
    return frame(SCHEMA, *rows, (90, "z", "NEW", NOW, None, None, None, None, None))


def test_leases_are_disjoint_in_any_order(events):
    """Each worker sees the same queue; whichever claim is applied first, no event has two owners."""
    claims = [queue.lease_batch(events, "p", 8, NOW, LEASE, i, 3).updates[TABLE] for i in range(3)]
    taken = [{r.event_id for r in c.rows.collect()} for c in claims]
    assert len(set().union(*taken)) == sum(map(len, taken)) and all(len(t) == 8 for t in taken)
    for order in list(permutations(claims))[:2]:
        after = events
        for c in order:
            after = apply_update(after, c)
        owners = {r.claim_id: r.n for r in after.filter("claim_id is not null").groupBy("claim_id").agg(F.count("*").alias("n")).collect()}
        assert sorted(owners.values()) == [8, 8, 8]
    with pytest.raises(ValueError):
        queue.lease_batch(events, "p", 8, NOW, LEASE, 3, 3)


def test_dead_claims_come_back_and_late_workers_change_nothing(events, bag):
    first = apply_update(events, queue.lease_batch(events, "p", 5, NOW, LEASE).updates[TABLE])
    held = {r.event_id for r in first.filter("claim_id is not null").collect()}
    soon = queue.lease_batch(first, "p", 100, NOW + timedelta(minutes=29), LEASE).updates[TABLE].rows
    assert not held & {r.event_id for r in soon.collect()}
    then = NOW + LEASE
    again = apply_update(first, queue.lease_batch(first, "p", 5, then, LEASE).updates[TABLE])
    assert {r.event_id for r in again.filter("claim_id is not null").collect()} == held
    late = queue.complete_lease(again, then, 1, queue.lease_id("p", NOW)).updates[TABLE]
    assert bag(apply_update(again, late)) == bag(again)
    # what the late worker made of the queue it saw does not touch the other one's events either
    stale = queue.complete_lease(first, then, 1, queue.lease_id("p", NOW)).updates[TABLE]
    assert bag(apply_update(again, stale)) == bag(again)
    done = apply_update(again, queue.complete_lease(again, then, 1, queue.lease_id("p", then)).updates[TABLE])
    assert {r.event_id for r in done.filter("status = 'SUCCESS'").collect()} == held


def test_release_gives_events_back_once(events, bag):
    first = apply_update(events, queue.lease_batch(events, "p", 5, NOW, LEASE).updates[TABLE])
    assert queue.release_expired(first, NOW, LEASE).updates[TABLE].rows.count() == 0
    back = apply_update(first, queue.release_expired(first, NOW + LEASE, LEASE).updates[TABLE])
    assert back.filter("status = 'NEW' and claim_id is null and date_started is null").count() == 41
    assert bag(back.filter("retry_count = 1"), "event_id") == bag(first.filter("claim_id is not null"), "event_id")
    assert queue.release_expired(back, NOW + LEASE, LEASE).updates[TABLE].rows.count() == 0
    assert queue.lease_batch(events.limit(0), "p", 5, NOW, LEASE).updates[TABLE].rows.count() == 0


def test_closure_follows_cycles_and_leaves_nothing_dangling(frame, bag):
    units = frame("id int, parent int, place string", (1, 2, "A"), (2, 3, "B"), (3, 1, "B"), (4, None, "C"), (5, 4, None), (None, 1, "A"), (1, 2, "A"))
    places = frame("place string, zone int, note string", ("A", 1, "x"), ("B", 1, "y"), ("C", 2, "z"), (None, 9, "n"))
    zones = frame("zone int, main string", (1, "C"), (2, "C"), (3, "A"))
    tables = {"unit": units, "place": places, "zone": zones}
    keys = {"unit": ("id",), "place": ("place",), "zone": ("zone",)}
    links = [
        ForeignKey("unit", ("parent",), "unit", ("id",)),
        ForeignKey("unit", ("place",), "place", ("place",)),
        ForeignKey("place", ("zone",), "zone", ("zone",)),
        ForeignKey("zone", ("main",), "place", ("place",)),
    ]
    found = closed_extract(tables, {"unit": units.filter("id = 1")}, keys, links)
    assert bag(found["unit"], "id") == [(1,), (1,), (2,), (3,)]
    assert bag(found["place"]) == [("A", 1, "x"), ("B", 1, "y"), ("C", 2, "z")]
    assert bag(found["zone"], "zone") == [(1,), (2,)]
    for link in links:  # no key without its row
        names = found[link.child].select(*link.columns).dropna().distinct()
        held = found[link.parent].select(*[F.col(p).alias(c) for p, c in link.up])
        assert names.join(held, list(link.columns), "left_anti").count() == 0
    assert bag(closed_extract(tables, {"unit": units.filter("id = 5")}, keys, links)["unit"], "id") == [(4,), (5,)]
    owned = [*links, ForeignKey("unit", ("parent",), "unit", ("id",), owned=True)]
    assert bag(closed_keys(tables, {"unit": units.filter("id = 4")}, keys, owned)["unit"]) == [(4,), (5,)]
    assert closed_keys(tables, {"unit": units.limit(0)}, keys, links) == {}
    assert all(t.count() == 0 for t in closed_extract(tables, {"unit": units.limit(0)}, keys, links).values())


def test_ranges_of_parallel_jobs_are_disjoint(spark, tmp_path):
    root = str(tmp_path)
    counts = [1, 250, 99, 100, 101, 7, 330, 0] * 3
    with ThreadPoolExecutor(8) as pool:
        starts = list(pool.map(lambda n: reserve(spark, root, "work_q_id", n, first=1000, block=100), counts))
    ranges = sorted((s, s + n) for s, n in zip(starts, counts, strict=True) if n)
    assert ranges[0][0] >= 1000 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert reserve(spark, root, "other", 1) == 1
    with pytest.raises(ValueError):
        reserve(spark, root, "../x", 1)


def test_two_orphan_repairs_get_disjoint_ids(frame, tmp_path):
    orphans = frame(
        "type string, wh_id int, reserved_for string, control_number string, alloc1 string, item_number string, actual_qty double",
        *[(str(i), 1, "r", "1", "o", f"i{i}", 1.0) for i in range(30)],
    )
    ids = []
    for _ in range(2):
        first = reserve(orphans.sparkSession, str(tmp_path), "work_q_id", orphans.count(), block=10)
        ids += [r.work_q_id for r in missing.create_orphan_picks(orphans, NOW, first).inserts["t_work_q"].collect()]
    assert len(set(ids)) == 60
    rows = numbered_from(orphans, ["type"], "id", str(tmp_path), "work_q_id", block=10)
    assert not {r.id for r in rows.collect()} & set(ids) and rows.select("id").distinct().count() == 30


def test_equal_rows_get_their_own_ids(frame):
    rows = frame("a int, b string", *[(1, "x")] * 9000, (2, None), (2, None), (3, "y"))
    found = with_id(rows, "id")
    assert found.count() == 9003 and found.select("id").distinct().count() == 9003
    assert {r.id for r in found.collect()} == {r.id for r in with_id(rows.repartition(7), "id").collect()}


def test_a_second_update_of_one_key_fails(frame):
    table = frame("id int, s string", (1, "a"), (2, "b"))
    twice = Update(frame("id int, s string", (1, "x"), (1, "x")), ("id",))
    with pytest.raises(Exception, match="several updates"):
        apply_update(table, twice).collect()
