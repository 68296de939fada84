"""Duplicate records and surplus tasks.

Who stays is decided by a plain aggregate per key, not by a window, so a key with very many copies
is combined before the shuffle and never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.clock import day, joined_timestamp, ts
from ..plans.changeset import ChangeSet, Delete, Update, with_id
from ..plans.joins import attach, matching

PICK_KEY = ("item_number", "order_number", "line_number", "wave_id", "wh_id")


def _surplus_picks(picks: DataFrame, suspects: DataFrame, keys: Sequence[str], strict: bool) -> DataFrame:
    duplicated = suspects.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.min("pick_id").alias("kept_id")
    ).filter(F.col("copies") > 1)
    if strict:
        highest = picks.groupBy(*keys).agg(F.max("pick_id").alias("pick_id"))
        return attach(highest, duplicated.drop("kept_id"), list(keys), "inner", one_row_per_key=True)
    rows = attach(suspects.select(*keys, "pick_id"), duplicated, list(keys), "inner")
    return rows.filter(F.col("pick_id") != F.col("kept_id")).drop("kept_id").distinct()


def dup_picks(
    picks: DataFrame, wave: str | None = None, keys: Sequence[str] = PICK_KEY, strict: bool = False
) -> DataFrame:
    """Picks to delete so that each key keeps its lowest pick id.

    ``strict`` deletes only the highest pick id of the key, taken over picks of every type, although
    the duplicates were counted over type PP.
    """
    if wave is not None:
        picks = picks.filter(F.col("wave_id") == wave)
    return _surplus_picks(picks, picks.filter(F.col("type") == "PP"), keys, strict)


def dup_picks_prereceipt(
    picks: DataFrame,
    stock: DataFrame,
    hu: DataFrame,
    parents: Sequence[str] | None = None,
    keys: Sequence[str] = ("item_number", "order_number", "line_number", "wh_id"),
    strict: bool = False,
) -> DataFrame:
    """As :func:`dup_picks`, limited to released picks reachable from handling units of given parents."""
    units = hu.filter(F.col("parent_hu_id").isNotNull())
    if parents is not None:
        units = units.filter(F.col("parent_hu_id").isin(*parents))
    units = units.select("hu_id", "wh_id", "control_number")
    content = stock.select("hu_id", "wh_id", "serial_number", "item_number")
    reach = attach(content, units, ["hu_id", "wh_id"], "inner")
    on = [("line_number", "control_number"), ("order_number", "serial_number"), "item_number", "wh_id"]
    suspects = matching(picks.filter((F.col("type") == "PP") & (F.col("status") == "RELEASED")), reach, on)
    return _surplus_picks(picks, suspects, keys, strict)


def delete_picks(surplus: DataFrame, as_of: datetime | None = None) -> ChangeSet:
    """Delete the picks; with ``as_of`` also log each duplicated key, as the pre-receipt form does."""
    deletes = {"t_pick_detail": Delete(surplus.select("pick_id").distinct(), ("pick_id",))}
    if as_of is None:
        return ChangeSet(deletes=deletes)
    present = set(surplus.columns)
    key = [c for c in ("wh_id", "order_number", "line_number", "item_number") if c in present]
    logged = surplus.select(*key).distinct().withColumnRenamed("order_number", "load_id")
    constants = {
        "tran_type": F.lit(fixed.EXC_DUP_PICK[0]),
        "description": F.lit(fixed.EXC_DUP_PICK[1]),
        "exception_date": ts(as_of),
        "employee_id": F.lit(fixed.USER),
        "error_message": F.lit("PKD Duplicada"),
    }
    rows = with_id(logged.withColumns(constants), "exception_id")
    return ChangeSet(inserts={"t_exception_log": rows}, deletes=deletes)


def dup_log(
    tran_log: DataFrame,
    as_of: datetime,
    days: int | None,
    tran_type: str = fixed.CANCEL_PARTIAL,
    keys: Sequence[str] = ("control_number", "description", "item_number", "wh_id", "employee_id", "tran_qty"),
    strict: bool = False,
) -> DataFrame:
    """Log rows to delete: copies of the same cancellation, with the latest moment of the key.

    By default the lowest id stays; ``strict`` deletes only the highest of the key, over all dates.
    """
    typed = tran_log.filter(F.col("tran_type") == tran_type)
    recent = typed
    if days is not None:
        recent = typed.filter(F.col("start_tran_date") >= ts(day(as_of, days)))
    at = joined_timestamp("start_tran_date", "start_tran_time")
    duplicated = (
        recent.groupBy(*keys)
        .agg(
            F.countDistinct("tran_log_id").alias("copies"),
            F.min("tran_log_id").alias("kept_id"),
            F.max(at).alias("latest"),
        )
        .filter(F.col("copies") > 1)
    )
    if strict:
        matched_on = [k for k in keys if k != "description"]
        highest = typed.groupBy(*matched_on).agg(F.max("tran_log_id").alias("tran_log_id"))
        return attach(duplicated.drop("kept_id"), highest, matched_on, "inner")
    rows = attach(recent.select(*keys, "tran_log_id"), duplicated, list(keys), "inner")
    return rows.filter(F.col("tran_log_id") != F.col("kept_id")).drop("kept_id")


def delete_log(surplus: DataFrame, as_of: datetime) -> ChangeSet:
    """Delete the surplus copies and log each with the latest moment of its key."""
    columns = [c for c in ("employee_id", "control_number", "item_number") if c in surplus.columns]
    logged = surplus.select(
        F.lit(fixed.EXC_DUP_LOG[0]).alias("tran_type"),
        F.lit(fixed.EXC_DUP_LOG[1]).alias("description"),
        ts(as_of).alias("exception_date"),
        *columns,
        *([F.col("tran_qty").alias("quantity")] if "tran_qty" in surplus.columns else []),
        F.date_format("latest", "dd/MM/yyyy HH:mm:ss").alias("error_message"),
    )
    return ChangeSet(
        inserts={"t_exception_log": with_id(logged, "exception_id")},
        deletes={"t_tran_log": Delete(surplus.select("tran_log_id").distinct(), ("tran_log_id",))},
    )


def surplus_tasks(
    tasks: DataFrame, work_type: str = "80", status: str = "U", cap: int | None = None
) -> DataFrame:
    """Open tasks to close so that each location keeps only the one with the highest id.

    ``cap`` limits one run to that many locations, in key order.
    """
    opened = tasks.filter((F.col("work_status") == status) & (F.col("work_type") == work_type))
    crowded = opened.groupBy("location_id", "wh_id").agg(
        F.count(F.lit(1)).alias("open_tasks"), F.max("work_q_id").alias("kept_id")
    ).filter(F.col("open_tasks") > 1)
    if cap is not None:
        crowded = crowded.orderBy("location_id", "wh_id").limit(cap)
    rows = attach(opened.select("work_q_id", "location_id", "wh_id"), crowded, ["location_id", "wh_id"], "inner")
    return rows.filter(F.col("work_q_id") != F.col("kept_id"))


def close_tasks(surplus: DataFrame) -> ChangeSet:
    """Close the surplus tasks."""
    closed = surplus.select("work_q_id").distinct().withColumn("work_status", F.lit("C"))
    return ChangeSet(updates={"t_work_q": Update(closed, ("work_q_id",))})
