"""Queries over the test data, each with the SQL it must agree with.

A SQL body names views (``v_…``) and other queries (``q_…``); both become CTEs, so that the text
runs on the bare tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from ..sources.samples import Samples
from .views import VIEWS

Binding = Callable[[Samples], DataFrame]

QUERIES: dict[str, Binding] = {}
BODIES: dict[str, str] = {}

_NAME = re.compile(r"\b([vq]_[a-z0-9_]+)\b")


def query(name: str, sql: str | None = None) -> Callable[[Binding], Binding]:
    def register(binding: Binding) -> Binding:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = binding
        if sql is not None:
            BODIES[name] = sql.strip()
        return binding

    return register


def _body(name: str) -> str:
    return VIEWS[name] if name.startswith("v_") else BODIES[name[2:]]


def _known(name: str) -> bool:
    return name in VIEWS or (name.startswith("q_") and name[2:] in BODIES)


def full_sql(body: str) -> str:
    """The body with every view and query it needs as a CTE, in order of use."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if _known(name) and name not in ordered:
                visit(_body(name))
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS (\n{_body(n)}\n)" for n in ordered)
    return f"WITH {ctes}\nSELECT * FROM (\n{body}\n)"


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return QUERIES[name](Samples(tune(spark), folder))

    return run
