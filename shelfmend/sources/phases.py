"""A long repair in phases, each published on its own, that goes on where an interrupted run stopped.

A phase reads the newest snapshot and gives a change set. The marker that publishes its result bears the run's and
the phase's name, and is the only record of what is done: a phase that died before its marker has published nothing and is
done again, one that has a marker is skipped. So each message of a run goes into the outbox once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..plans.changeset import ChangeSet
from .snapshots import publish_changes, published_names, read_snapshot

Phase = Callable[[Mapping[str, DataFrame]], ChangeSet]


def _snapshot(run: str, number: int, phase: str) -> str:
    """Names of one run sort in the order of its phases."""
    return f"{run}.{number:03d}-{phase}"


def finished(spark: SparkSession, root: str, run: str, phases: Mapping[str, Phase]) -> list[str]:
    """The phases of a run that are published, in order."""
    known = published_names(spark, root)
    return [p for i, p in enumerate(phases) if _snapshot(run, i, p) in known]


def run_phases(spark: SparkSession, root: str, run: str, phases: Mapping[str, Phase]) -> list[str]:
    """Do the phases of a run that are not published yet, one after the other; their names.

    ``run`` must sort behind every snapshot published before the run, as the names of snapshots do. A run to which a later
    snapshot has been published meanwhile is not continued, since its phases would not read each other's results.
    """
    names = [_snapshot(run, i, p) for i, p in enumerate(phases)]
    known = published_names(spark, root)
    done = [n for n in names if n in known]
    own = {n for n in known if n.startswith(f"{run}.")}
    if own != set(names[: len(done)]):
        raise ValueError(f"run {run} has other phases: {sorted(own)}")
    left = names[len(done) :]
    newest = max(known)
    if left and (newest >= left[0] or (done and newest != done[-1])):
        raise ValueError(f"run {run} cannot go on: {newest} is published")
    made = []
    for name, (phase, changes) in list(zip(names, phases.items(), strict=True))[len(done) :]:
        publish_changes(spark, root, name, changes(read_snapshot(spark, root)))
        made.append(phase)
    return made
