"""Landing and loading of catalog tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfmend.sources import catalog


def test_blank_is_null_and_keys_stay_text(spark, frame, tmp_path, bag):
    raw = frame("hu_id string, wh_id string, location_id string", ("00000002000001693451", "001", ""), ("x", None, " "))
    catalog.land(raw, "t_hu_master", str(tmp_path))
    got = catalog.load(spark, str(tmp_path), "t_hu_master")
    assert bag(got, "hu_id", "wh_id", "location_id") == [("00000002000001693451", "001", None), ("x", None, " ")]
    assert got.schema == catalog.SCHEMAS["t_hu_master"]


def test_quantities_are_exact_decimals(spark, frame, tmp_path):
    raw = frame("item_number string, wh_id string, qty string", ("a", "1", "0.1"), ("a", "1", "0.2"))
    catalog.land(raw, "tmp_item", str(tmp_path))
    total = catalog.load(spark, str(tmp_path), "tmp_item").agg(F.sum("qty")).first()[0]
    assert str(total) == "0.3000"


def test_dated_tables_are_pruned_by_day(spark, frame, tmp_path, bag):
    days = [datetime(2024, 1, d, 5) for d in (1, 2, 3)]
    raw = frame("tran_log_id string, start_tran_date timestamp_ntz", *[(str(i), d) for i, d in enumerate(days)], ("n", None))
    catalog.land(raw, "t_tran_log", str(tmp_path))
    recent = catalog.load(spark, str(tmp_path), "t_tran_log", since=datetime(2024, 1, 2, 5))
    assert bag(recent, "tran_log_id") == [("1",), ("2",)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(start_tran_date)" in plan
    assert catalog.load(spark, str(tmp_path), "t_tran_log").count() == 4
    assert set(catalog.load_all(spark, str(tmp_path), ["t_tran_log"])) == {"t_tran_log"}


def test_remote_reader_is_lazy_about_drivers(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        catalog.load_remote(spark, "jdbc:none:x", "t", "tmp_item", {}, ("wh_id", 0, 10, 2))
