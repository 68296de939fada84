"""Read-only reports: queue and bus backlog, event tracing, invoice latency, archive status."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.clock import elapsed_seconds, hms, ts
from ..plans.changeset import ChangeSet, Update
from ..plans.containment import holding
from ..plans.joins import attach, matching


def queue_backlog(queue: DataFrame, event_def: DataFrame, since: datetime, status: str = "NEW") -> DataFrame:
    """Waiting events per event name and status since a moment.

    Counted per event id before the join, so a busy event costs one row there.
    """
    waiting = queue.filter((F.col("date_added") >= ts(since)) & (F.col("status") == status))
    counted = waiting.groupBy("scevent_id", "status").agg(F.count(F.lit(1)).alias("n"))
    named = attach(counted, event_def.select("scevent_id", "scevent_name"), ["scevent_id"], "inner")
    return named.groupBy("scevent_name", "status").agg(F.sum("n").alias("events"))


def bus_backlog(
    messages: DataFrame,
    detail: DataFrame,
    master: DataFrame,
    excluded_application: str,
    excluded_name: str,
    status_id: int = 1,
) -> DataFrame:
    """Pending messages per definition and priority; a message without an application is kept."""
    app = F.col("sub_application_id")
    pending = messages.filter((F.col("status_id") == status_id) & ((app != excluded_application) | app.isNull()))
    counted = pending.groupBy("msg_def_detail_id", "priority").agg(F.count(F.lit(1)).alias("n"))
    defined = attach(counted, detail.select("msg_def_detail_id", "msg_def_master_id"), ["msg_def_detail_id"], "inner")
    names = master.select("msg_def_master_id", "name").filter(F.col("name") != excluded_name)
    named = attach(defined, names, ["msg_def_master_id"], "inner")
    return named.groupBy("msg_def_detail_id", "priority").agg(
        F.max("name").alias("name"), F.sum("n").alias("messages")
    )


def trace_events(
    queue: DataFrame, payloads: DataFrame, keys: DataFrame | Sequence[str], since: datetime | None = None
) -> DataFrame:
    """Queue events whose payload key is one of ``keys`` (a list, or a DataFrame with ``payload``)."""
    if since is not None:
        queue = queue.filter(F.col("date_added") >= ts(since))
    if isinstance(keys, DataFrame):
        wanted = matching(payloads.select("event_id", "payload"), keys.select("payload"), ["payload"])
    else:
        wanted = payloads.select("event_id", "payload").filter(F.col("payload").isin(*keys))
    traced = attach(queue, wanted, ["event_id"], "inner")
    return traced.select(
        F.col("payload").alias("host_id"),
        "event_id",
        "date_added",
        "date_started",
        "date_finished",
        "alert_id",
        "procobject",
        "status",
    )


def requeue_events(traced: DataFrame) -> ChangeSet:
    """Put traced events back to the start of the queue."""
    rows = traced.select("event_id").distinct().select(
        "event_id",
        F.lit("NEW").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("date_started"),
        F.lit(None).cast("timestamp_ntz").alias("date_finished"),
        F.lit(0).alias("retry_count"),
        F.lit(10).alias("priority"),
    )
    return ChangeSet(updates={"ea_t_async_work_queue": Update(rows, ("event_id",))})


def invoice_latency(
    ship: DataFrame,
    service_log: DataFrame,
    shipped_since: datetime,
    printed_since: datetime,
    code: str = fixed.INVOICE,
    print_service: str = fixed.PRINT_INVOICE,
    number_length: int | None = None,
) -> DataFrame:
    """First send and first invoice print of each shipment message, with the elapsed times.

    A print belongs to a message if its request text contains the order number, or its first
    ``number_length`` characters. Numbers of digits can only stand in runs of digits, so the parts of those runs
    that are as long as some number are the keys of an equi-join, each once a request. Numbers with other characters are
    found by :func:`~shelfmend.plans.containment.holding`, without a row for each part of a text.
    """
    sent = ship.filter((F.col("transaction_code") == code) & (F.col("record_create_date") >= ts(shipped_since)))
    number = F.col("order_number").cast("string")
    sent = sent.withColumn("number_key", number if number_length is None else F.substring(number, 1, number_length))

    # only the sends of these messages are looked at
    own = matching(service_log.select("param1", "process_date"), sent, [("param1", "host_group_id")])
    first_send = own.groupBy("param1").agg(F.min("process_date").alias("web_s_pre_ship"))

    prints = service_log.filter(
        (F.col("webservice_id") == print_service) & (F.col("process_date") >= ts(printed_since))
    ).select("soap_request", "process_date")
    digits = F.col("number_key").rlike("^[0-9]+$")

    in_digits = F.array_distinct(F.regexp_extract_all("soap_request", F.lit("[0-9]+"), F.lit(0)))
    run = prints.select("process_date", F.explode(in_digits).alias("run"))
    sizes = sent.select(F.collect_set(F.when(digits, F.length("number_key")))).scalar()  # the few lengths that occur
    sized = run.select("*", F.explode(sizes).alias("n")).filter(F.length("run") >= F.col("n"))
    starts = F.sequence(F.lit(1), F.length("run") - F.col("n") + 1)
    pieces = sized.select("process_date", F.explode(starts).alias("at"), "run", "n").select(
        "process_date", F.substring(F.col("run"), F.col("at"), F.col("n")).alias("piece")
    )
    found = matching(pieces, sent.select(F.col("number_key").alias("piece")), ["piece"])
    lettered = sent.filter(~digits & (F.length("number_key") > 0)).select(F.col("number_key").alias("piece"))
    if lettered.head(1):
        found = found.unionByName(holding(prints, "soap_request", lettered, "piece"))
    first_print = found.groupBy("piece").agg(F.min("process_date").alias("nf_print"))

    with_print = attach(sent, first_print, [("number_key", "piece")], "inner")
    timed = attach(with_print, first_send, [("host_group_id", "param1")])

    def spell(later: str, earlier: str, name: str) -> list:
        seconds = elapsed_seconds(later, earlier)
        return [hms(seconds).alias(name), F.floor(seconds / 86_400).cast("bigint").alias(f"{name}_days")]

    return timed.select(
        F.col("order_number").alias("pedido"),
        F.col("record_create_date").alias("ship_al_host"),
        F.col("web_s_pre_ship").alias("ship_web_ser"),
        F.col("nf_print").alias("nf_web_servi"),
        *spell("nf_print", "web_s_pre_ship", "procs"),
        *spell("nf_print", "record_create_date", "procs_al"),
        *spell("web_s_pre_ship", "record_create_date", "web_alhost"),
        "host_group_id",
    ).orderBy(F.desc("ship_al_host"), "pedido", "host_group_id")


def archive_status(
    groups: DataFrame,
    group_control: DataFrame,
    control: DataFrame,
    group_schedule: DataFrame,
    schedule: DataFrame,
    schedule_detail: DataFrame,
    statistics: DataFrame,
    bus: DataFrame,
) -> DataFrame:
    """Archive status board: every controlled table with its group, schedule and last run."""
    latest = schedule_detail.groupBy("schedule_id").agg(F.max("start_time").alias("start_time"))
    grouped = attach(
        groups.select("group_id", "name", "group_status"),
        group_control.select("group_id", "backup_control_id", "group_sequence"),
        ["group_id"],
    )
    # every control row stays, also one that no group uses
    controlled = attach(
        control.select("id", "table_name", "control_type", "status", "last_processed_date", "elapsed_time"),
        grouped,
        [("id", "backup_control_id")],
    )
    planned = attach(controlled, group_schedule.select("group_id", "schedule_id"), ["group_id"])
    named = attach(
        planned,
        schedule.select("schedule_id", F.col("name").alias("schedule_name"), "message_id"),
        ["schedule_id"],
    )
    started = attach(named, latest, ["schedule_id"])
    keys = [
        "group_id", "name", "table_name", "group_status", "schedule_name", "status", "last_processed_date",
        "group_sequence", "message_id", "elapsed_time", "control_type",
    ]
    board = started.groupBy(*keys).agg(F.max("start_time").alias("start_time"))
    board = attach(board, statistics.select("table_name", "num_rows", "last_analyzed"), ["table_name"])
    board = attach(board, bus.select("msg_bus_id", "date_activated"), [("message_id", "msg_bus_id")])
    return board.select(
        "group_id",
        F.col("name").alias("grupo"),
        F.col("table_name").alias("tabela"),
        F.col("control_type").alias("tipo"),
        F.col("group_sequence").alias("sequence"),
        F.when(F.col("group_status") == "A", "Grupo Ativo")
        .when(F.col("group_status") == "I", "** Grupo Inativo")
        .otherwise(F.col("group_status"))
        .alias("status_do_gp"),
        F.col("last_processed_date").alias("ult_exce"),
        F.col("elapsed_time").alias("time_exec"),
        F.col("num_rows").alias("registros"),
        "last_analyzed",
        F.coalesce("schedule_name", F.lit("** Sem programação")).alias("schedule"),
        "start_time",
        F.col("date_activated").alias("prox_exec"),
        F.when(F.col("status") == "F", "FAILURE").otherwise("SUCCESS").alias("status_exec"),
    ).orderBy(F.desc("ult_exce"), "start_time", "sequence", "tabela", "group_id")


def archive_plan(
    groups: DataFrame, group_control: DataFrame, control: DataFrame, group: str | None = None
) -> DataFrame:
    """Tables of the active groups in the order the archive run takes them."""
    active = groups.filter(F.col("group_status") == "A")
    if group is not None:
        active = active.filter(F.col("group_id") == group)
    members = matching(
        group_control.select("group_id", "backup_control_id", "group_sequence"), active, ["group_id"]
    )
    plan = attach(
        members,
        control.select("id", "control_type", "table_name"),
        [("backup_control_id", "id")],
        "inner",
    )
    return plan.select(
        "group_id",
        "group_sequence",
        F.col("control_type").alias("procedure_name"),
        "table_name",
        F.col("backup_control_id").alias("table_id"),
    ).orderBy("group_id", "group_sequence", "table_id", "table_name")
