"""Rows that belong together by foreign keys, followed until nothing is added."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from .joins import matching, missing
from .numbering import pinned


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` of ``child`` name a row of ``parent``. A chosen child always brings its parent; a chosen
    parent brings its children only if they are ``owned``."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    owned: bool = False

    @property
    def up(self) -> list[tuple[str, str]]:
        return list(zip(self.parent_columns, self.columns, strict=True))

    @property
    def down(self) -> list[tuple[str, str]]:
        return list(zip(self.columns, self.parent_columns, strict=True))


def _narrow(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], links: Sequence[ForeignKey]) -> dict[str, DataFrame]:
    """Of each table, its key and the columns that links use."""
    used = {t: list(k) for t, k in keys.items()}
    for link in links:
        used[link.child] += link.columns
        used[link.parent] += link.parent_columns
    return {t: tables[t].select(*dict.fromkeys(c)) for t, c in used.items()}


def closed_keys(
    tables: Mapping[str, DataFrame],
    start: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    links: Sequence[ForeignKey],
) -> dict[str, DataFrame]:
    """Keys of the rows that the ``start`` rows need, by table; tables without any are left out.

    ``keys`` names the key columns of each table that takes part; ``start`` has at least those. A round follows the
    links from the rows that the round before has added, by semi-joins, and leaves out what is there already, so
    cycles end; there are as many rounds as the longest path has links. Equal keys count once. A NULL key or
    foreign key belongs to nothing.
    """
    slim = _narrow(tables, keys, links)
    kept: dict[str, DataFrame] = {}
    found = {t: [matching(slim[t], rows, list(keys[t]))] for t, rows in start.items()}
    while found:
        fresh = {}
        for t, parts in found.items():
            rows = reduce(DataFrame.unionByName, parts)
            if t in kept:
                rows = missing(rows, kept[t], list(keys[t]))
            rows = pinned(rows.dropna(subset=list(keys[t])).distinct())
            if not rows.isEmpty():
                fresh[t] = rows
        for t, rows in fresh.items():
            own = rows.select(*keys[t])
            kept[t] = kept[t].unionByName(own) if t in kept else own
        found = {}
        for link in links:
            if link.child in fresh:
                found.setdefault(link.parent, []).append(matching(slim[link.parent], fresh[link.child], link.up))
            if link.owned and link.parent in fresh:
                found.setdefault(link.child, []).append(matching(slim[link.child], fresh[link.parent], link.down))
    return {t: rows.distinct() for t, rows in kept.items()}


def closed_extract(
    tables: Mapping[str, DataFrame],
    start: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    links: Sequence[ForeignKey],
) -> dict[str, DataFrame]:
    """The rows of all tables in ``keys`` that the ``start`` rows need, whole; no foreign key of ``links`` is left
    without the row it names, where the tables have it."""
    found = closed_keys(tables, start, keys, links)
    return {t: matching(tables[t], found[t], list(k)) if t in found else tables[t].limit(0) for t, k in keys.items()}
