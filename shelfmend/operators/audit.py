"""Audit rows every repair writes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.clock import day, month_clock, ts
from ..plans.joins import attach

_COLUMNS = (
    "control_number", "control_number_2", "line_number", "wh_id", "hu_id", "hu_id_2", "location_id",
    "location_id_2", "num_items", "item_number", "lot_number", "tran_qty", "elapsed_time",
)
_QUANTITIES = {"num_items", "tran_qty", "elapsed_time"}


@dataclass(frozen=True)
class AuditProfile:
    """What one kind of repair writes. ``columns`` maps an audit column to a candidate column name
    or to a literal column; ``split_clock`` stores day and time of day in separate columns."""

    tran_type: str
    description: str | None = None
    employee: str = fixed.USER
    columns: Mapping[str, str | Column] = field(default_factory=dict)
    split_clock: bool = False


def audit_rows(
    rows: DataFrame, profile: AuditProfile, as_of: datetime, descriptions: DataFrame | None = None
) -> DataFrame:
    """One audit row per candidate row. Without a text in the profile, the description is looked up
    by operation code in ``descriptions``."""
    date = ts(day(as_of)) if profile.split_clock else ts(as_of)
    time = ts(month_clock(as_of)) if profile.split_clock else ts(as_of)

    if profile.description is not None or descriptions is None:
        description = F.lit(profile.description)
    else:
        one = descriptions.filter(F.col("tran_type") == profile.tran_type).agg(F.max("description"))
        description = one.scalar()

    def cell(name: str) -> Column:
        source = profile.columns.get(name)
        if source is None:
            source = F.lit(None)
        elif isinstance(source, str):
            source = F.col(source)
        return source.cast("double" if name in _QUANTITIES else "string").alias(name)

    return rows.select(
        F.lit(profile.tran_type).alias("tran_type"),
        description.cast("string").alias("description"),
        date.alias("start_tran_date"),
        time.alias("start_tran_time"),
        date.alias("end_tran_date"),
        time.alias("end_tran_time"),
        F.lit(profile.employee).alias("employee_id"),
        *[cell(c) for c in _COLUMNS],
    )


def outbox_rows(rows: DataFrame, service: str | Column, group: str = "host_group_id") -> DataFrame:
    """Messages to send: one per service and group id."""
    name = F.lit(service) if isinstance(service, str) else service
    return rows.select(name.alias("service"), F.col(group).cast("string").alias("group_id")).distinct()


def verify_batch(table: DataFrame, expected: DataFrame, group: str = "host_group_id") -> DataFrame:
    """Rows written per expected message group; a group without rows must not be sent."""
    written = table.groupBy(group).agg(F.count(F.lit(1)).alias("written"))
    checked = attach(expected.select(group).distinct(), written, [group], one_row_per_key=True)
    rows = F.coalesce("written", F.lit(0))
    return checked.select(
        group, rows.alias("rows_written"), F.when(rows > 0, "SEND").otherwise("FAILED").alias("decision")
    )
