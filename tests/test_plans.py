"""Joins, numbering and change sets, on data with NULLs, duplicates and hot keys."""

import random
import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmend.plans.changeset import (
    ChangeSet,
    Delete,
    Update,
    apply_change_set,
    apply_update,
    ledger,
    with_id,
)
from shelfmend.plans.containment import holding
from shelfmend.plans.joins import attach, matching, missing, null_safe
from shelfmend.plans.numbering import number_rows, number_within, running_low, running_total
from shelfmend.sources.snapshots import publish, publish_changes, read_snapshot


def test_existence_with_null_keys_and_duplicates(frame, bag):
    left = frame("a int, b string", (1, "x"), (1, "y"), (2, "x"), (None, "n"))
    right = frame("k int, c string", (1, "p"), (1, "q"), (None, "r"))
    assert bag(matching(left, right, [("a", "k")])) == [(1, "x"), (1, "y")]
    assert bag(missing(left, right, [("a", "k")])) == [(2, "x"), (None, "n")]
    for flag in (True, False):
        both = matching(left, right, [("a", "k")], flag).unionByName(missing(left, right, [("a", "k")], flag))
        assert bag(both) == bag(left)


def test_empty_right_side(frame, bag):
    left = frame("a int", (1,), (2,))
    right = frame("a int")
    assert bag(missing(left, right, ["a"])) == [(1,), (2,)]
    assert bag(matching(left, right, ["a"])) == []


def test_attach_keeps_bag_semantics_and_widens_integers(frame, bag):
    left = frame("a int, b string", (1, "x"), (2, "y"))
    right = frame("a bigint, c string", (1, "p"), (1, "q"))
    assert bag(attach(left, right, ["a"])) == [(1, "x", "p"), (1, "x", "q"), (2, "y", None)]


def test_attach_refuses_other_type_mixes(frame):
    with pytest.raises(TypeError):
        attach(frame("a int", (1,)), frame("a string, c int", ("1", 1)), ["a"])
    with pytest.raises(ValueError):
        attach(frame("a int, c int", (1, 1)), frame("a int, c int", (1, 1)), ["a"])


def test_null_safe_key(frame, bag):
    left = null_safe(frame("i int, lot string", (1, None), (2, "A"), (3, "")), "lot", "k")
    right = null_safe(frame("i int, lot string", (1, None), (2, None), (3, None)), "lot", "k")
    assert bag(missing(left, right, ["i", "k"]), "i") == [(2,), (3,)]


def test_self_join(frame, bag):
    rows = frame("id int, code string", (1, "a"), (1, "b"), (2, "a"))
    assert bag(missing(rows.filter("code = 'a'"), rows.filter("code = 'b'"), ["id"])) == [(2, "a")]


def test_hot_key_partition_is_split(spark, settings_of):
    """A third of the rows on one key, an aggregated other side: the hot partition is split."""
    settings_of(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    )
    rows = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v")
    )
    totals = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
    joined = attach(rows, totals, ["k"], "inner").filter(F.col("v") != F.col("top"))
    assert joined.count() == 60_000 - 500
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    kept = missing(rows, totals.filter("n < 100"), ["k"])
    kept.collect()
    assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()


def _skewed(n=3000):
    """Two groups that span many ranges, one of them without a key, and some small ones."""
    rng = random.Random(5)

    def group():
        r = rng.random()
        return "hot" if r < 0.4 else None if r < 0.7 else f"k{rng.randrange(40)}"

    return [(group(), rng.randrange(50), i, float(rng.randrange(9))) for i in range(n)]


def test_number_rows_is_dense_and_ordered(spark):
    data = _skewed()
    df = spark.createDataFrame(data, "g string, o int, id int, v double").repartition(5)
    got = number_rows(df, ["g", "o", "id"], "n", start=100).collect()
    want = {r[2]: 100 + i for i, r in enumerate(sorted(data, key=lambda r: (r[0] or "", *r[1:3])))}
    assert {r.id: r.n for r in got} == want


def test_number_within_and_running_total(spark):
    data = _skewed()
    df = spark.createDataFrame(data, "g string, o int, id int, v double").repartition(5)
    seen, sums, want = {}, {}, {}
    for g, o, i, v in sorted(data, key=lambda r: (r[0] or "", -r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        sums[g] = sums.get(g, 0.0) + v
        want[i] = (seen[g], sums[g])
    order = [F.desc("o"), "id"]
    numbered = {r.id: r.n for r in number_within(df, ["g"], order, "n").collect()}
    totals = {r.id: r.t for r in running_total(df, ["g"], order, "v", "t").collect()}
    assert {i: (numbered[i], totals[i]) for i in want} == want


def test_number_rows_of_nothing(frame):
    assert number_rows(frame("a int"), ["a"], "n").count() == 0


def test_update_add_into_where_keep(frame, bag):
    table = frame("id int, q double, s string", (1, 5.0, "a"), (2, None, "a"), (3, 1.0, "b"), (None, 2.0, "a"))
    add = Update(frame("id int, q double", (1, 2.0), (2, 2.0), (9, 1.0)), ("id",), add=("q",))
    assert bag(apply_update(table, add)) == bag(
        frame("id int, q double, s string", (1, 7.0, "a"), (2, None, "a"), (3, 1.0, "b"), (None, 2.0, "a"))
    )
    only_a = Update(frame("id int, s string", (1, "z"), (3, "z")), ("id",), where=F.col("s") == "a")
    assert bag(apply_update(table, only_a), "id", "s") == [(1, "z"), (2, "a"), (3, "b"), (None, "a")]
    rekey = Update(frame("id int, new_id int", (1, 10)), ("id",), into={"new_id": "id"})
    assert bag(apply_update(table, rekey), "id") == [(10,), (2,), (3,), (None,)]
    keep = Update(frame("id int, q double, s string", (1, None, None)), ("id",), keep=("q",))
    assert bag(apply_update(table, keep).filter("id = 1")) == [(1, 5.0, None)]


def test_update_reads_old_values(frame, bag):
    table = frame("id int, a string, b string", (1, "x", None))
    swap = Update(frame("id int, a string, b string", (1, "y", "x")), ("id",))
    assert bag(apply_update(table, swap)) == [(1, "y", "x")]


def test_guarded_change_set_is_idempotent(frame, bag):
    table = frame("id int, gtin string", (1, None), (2, "g"))
    changes = ChangeSet(
        updates={"t": Update(frame("id int, gtin string", (1, "n"), (2, "n")), ("id",), where=F.col("gtin").isNull())}
    )
    once = apply_change_set({"t": table}, changes)
    twice = apply_change_set(once, changes)
    assert bag(once["t"]) == bag(twice["t"]) == [(1, "n"), (2, "g")]


def test_change_set_order_and_publish(spark, frame, bag, tmp_path):
    table = frame("id int, v string", (1, "a"), (2, "b"))
    changes = ChangeSet(
        inserts={"t": frame("id int", (3,))},
        updates={"t": Update(frame("id int, v string", (1, "z")), ("id",))},
        deletes={"t": Delete(frame("id int", (2,)), ("id",))},
        outbox=frame("service string, group_id string", ("S", "g")),
    )
    after = apply_change_set({"t": table}, changes)
    assert bag(after["t"]) == [(1, "z"), (3, None)]
    root = str(tmp_path)
    publish({"t": table}, root, "2024-01-01")
    publish(after, root, "2024-01-02")
    (tmp_path / "2024-01-03").mkdir()  # a job that died before its marker
    back = read_snapshot(spark, root)
    assert set(back) == {"t", "outbox"}
    assert bag(back["t"]) == [(1, "z"), (3, None)]
    again = ChangeSet(updates={"t": Update(frame("id int, v string", (3, "c")), ("id",))})
    paths = publish_changes(spark, root, "2024-01-04", again)
    assert [p[len(root) + 1 :] for p in paths["outbox"]] == ["2024-01-02/outbox"]
    assert [p[len(root) + 1 :] for p in paths["t"]] == ["2024-01-04/t"]
    assert not (tmp_path / "2024-01-04" / "_changes").exists()
    assert bag(read_snapshot(spark, root)["t"]) == [(1, "z"), (3, "c")]
    listing = ledger(changes, {("insert", "t"): ("id",), ("send", "outbox"): ("service", "group_id")})
    assert bag(listing) == [("insert", "t", "id=3"), ("send", "outbox", "service=S;group_id=g")]


def test_dated_tables_are_published_by_day(spark, frame, bag, tmp_path):
    days = [datetime(2024, 1, d) for d in (1, 2)]
    log = frame("tran_log_id string, start_tran_date timestamp_ntz", ("a", days[0]), ("b", days[1]))
    publish({"t_tran_log": log}, str(tmp_path), "s1")
    assert (tmp_path / "s1" / "t_tran_log" / "day=2024-01-02").exists()
    assert bag(read_snapshot(spark, str(tmp_path))["t_tran_log"]) == bag(log)


def test_only_touched_days_are_written_again(spark, frame, bag, tmp_path):
    days = [datetime(2024, 1, d, 7) for d in (1, 2, 3)]
    schema = "tran_log_id string, tran_type string, start_tran_date timestamp_ntz"
    log = frame(schema, *[(str(i), "x", d) for i, d in enumerate(days)], ("n", "x", None))
    root = str(tmp_path)
    publish({"t_tran_log": log, "t_tran_log_holding": log}, root, "s1")
    audit = frame(schema, ("a", "y", days[1]))
    paths = publish_changes(spark, root, "s2", ChangeSet(audit=audit))
    assert [p[len(root) + 1 :] for p in paths["t_tran_log_holding"]] == [
        *[f"s1/t_tran_log_holding/day={d}" for d in ("2024-01-01", "2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__")],
        "s2/t_tran_log_holding/day=2024-01-02",
    ]
    assert all("/s1/" in p for p in paths["t_tran_log"])
    held = read_snapshot(spark, root)["t_tran_log_holding"]
    assert bag(held, *log.columns) == sorted([*bag(log), ("a", "y", days[1])], key=repr)
    assert held.filter("tran_log_holding_id IS NOT NULL").count() == 1
    one_day = ChangeSet(
        updates={"t_tran_log": Update(frame("tran_log_id string, tran_type string", ("1", "z"), ("9", "q")), ("tran_log_id",))},
        deletes={"t_tran_log": Delete(frame("tran_log_id string", ("n",)), ("tran_log_id",))},
    )
    paths = publish_changes(spark, root, "s3", one_day)
    assert [p[len(root) + 1 :] for p in paths["t_tran_log"]] == [
        "s1/t_tran_log/day=2024-01-01", "s1/t_tran_log/day=2024-01-03", "s3/t_tran_log/day=2024-01-02",
    ]
    assert bag(read_snapshot(spark, root)["t_tran_log"], "tran_log_id", "tran_type") == [("0", "x"), ("1", "z"), ("2", "x")]


def test_empty_dated_table_is_published(spark, frame, bag, tmp_path):
    log = frame("tran_log_id string, start_tran_date timestamp_ntz", ("a", datetime(2024, 1, 1)))
    publish({"t_tran_log_holding": log.limit(0)}, str(tmp_path), "s1")
    assert read_snapshot(spark, str(tmp_path))["t_tran_log_holding"].count() == 0
    publish_changes(spark, str(tmp_path), "s2", ChangeSet(audit=log))
    assert bag(read_snapshot(spark, str(tmp_path))["t_tran_log_holding"], *log.columns) == bag(log)


def test_two_updates_for_one_key_fail(frame):
    table = frame("id int, v string", (1, "a"), (2, "b"), (None, "n"))
    rows = frame("id int, v string", (1, "x"), (1, "y"))
    with pytest.raises(Exception, match="several updates for one key of id"):
        apply_update(table, Update(rows, ("id",))).collect()
    nulls = frame("id int, v string", (None, "x"), (None, "y"))
    assert apply_update(table, Update(nulls, ("id",))).filter("v IN ('x', 'y')").count() == 0


def test_ids_are_unique_also_for_equal_rows(frame):
    rows = frame("a int, b string", (1, "x"), (1, "x"), (1, None), (2, "x"))
    ids = [r.key for r in with_id(rows, "key").collect()]
    assert len(set(ids)) == 4
    assert sorted(ids) == sorted(r.key for r in with_id(rows.repartition(3), "key").collect())
    assert not set(ids) & {r.key for r in with_id(rows, "key", F.lit("batch 2")).collect()}


def test_timestamps_stay_without_zone(frame):
    from shelfmend.functions.clock import elapsed_seconds, hms, joined_timestamp, month_clock

    a, b = datetime(2024, 1, 1, 23, 59, 59, 500000), datetime(2024, 1, 3, 1, 2, 3)
    df = frame("a timestamp_ntz, b timestamp_ntz", (a, b), (a, None))
    rows = df.select(
        hms(elapsed_seconds("b", "a")).alias("h"),
        hms(elapsed_seconds("a", "b")).alias("r"),
        joined_timestamp("a", "b").alias("j"),
    ).collect()
    assert (rows[0].h, rows[0].r, rows[0].j) == ("01:02:03", "01:02:03", datetime(2024, 1, 1, 1, 2, 3))
    assert rows[1].h is None and rows[1].j == datetime(2024, 1, 1)
    assert month_clock(datetime(2024, 5, 17, 8, 9, 10)) == datetime(2024, 5, 1, 8, 9, 10)


# --- containment -----------------------------------------------------------------------------


def held(frame, bodies, keys):
    found = holding(frame("n int, body string", *enumerate(bodies)), "body", frame("key string", *[(k,) for k in keys]), "key")
    rows = [(r.n, r.key) for r in found.collect()]
    assert len(rows) == len(set(rows)) and found.columns == ["n", "key"]
    return set(rows)


def inside(bodies, keys):
    return {(n, k) for n, b in enumerate(bodies) for k in keys if b and k and k in b}


@given(
    st.lists(st.one_of(st.none(), st.text("ab1-é漢", max_size=40)), max_size=6),
    st.lists(st.one_of(st.none(), st.text("ab1-é漢", max_size=5)), max_size=6),
)
@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_containment_is_that_of_all_pairs(frame, bodies, keys):
    assert held(frame, bodies, keys) == inside(bodies, keys)


def test_containment_in_long_texts(frame):
    """10 KB and 3 MB texts, keys at their ends and across the places where texts are put together."""
    rng = random.Random(4)
    keys = ["".join(rng.choice("ABC-/9") for _ in range(rng.choice((5, 9, 14)))) for _ in range(300)] + ["a", "", None]
    bodies = ["".join(rng.choice("ABC-/9 ") for _ in range(10_000)) for _ in range(20)]
    bodies += [keys[0] + bodies[0] + keys[1], keys[2][:3], keys[2][3:], None, "", "x" * 3_000_000 + keys[3], *[keys[4]] * 3]
    assert held(frame, bodies, keys) == inside(bodies, keys)


def test_containment_has_no_row_for_each_part(frame):
    rows = holding(frame("n int, body string", (1, "x" * 9000 + "key-1")), "body", frame("key string", ("key-1",)), "key")
    plan = rows._jdf.queryExecution().toString()
    assert not re.search("Generate|NestedLoop|Cartesian|explode", plan) and rows.collect() == [(1, "key-1")]
    with pytest.raises(ValueError):
        holding(frame("key string, body string", ("a", "b")), "body", frame("key string", ("a",)), "key")


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_low(spark, frame, settings_of, parts):
    settings_of(spark__sql__shuffle__partitions=parts)
    rng = random.Random(parts)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), i, rng.randint(-5, 5)) for i in range(300)]
    found = running_low(frame("g string, i int, v int", *rows), ["g"], ["i"], "v", "total", "low").collect()
    expected, state = set(), {}
    for g, i, v in rows:
        total, low = state.get(g, (0, None))
        expected.add((g, i, total + v, low))
        state[g] = total + v, total + v if low is None else min(low, total + v)
    assert {(r.g, r.i, r.total, r.low) for r in found} == expected and len(found) == 300
