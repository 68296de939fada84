"""Existence tests and lookups that stay balanced when one key holds a large share of the rows.

Two things go wrong with hot keys in plain joins:

* duplicates of the key on the probed side all travel to one task. Here the probed side is
  reduced to one row per key first, which the map-side partial aggregate does before any shuffle;
* after that reduction the aggregate and the join share one shuffle, and adaptive execution then
  no longer sees two plain shuffles below the join, so it will not split the hot partition of the
  *driving* side. Here a hash of the key is one more join key. The planner wants
  all join keys in the partitioning, gives the reduced side its own (small) shuffle, and adaptive
  skew handling applies again.

A driving side that was itself aggregated on the join keys has no hot key. Callers say so with
``one_row_per_key`` and keep the shuffle that aggregate made: the join then needs no other.

Nothing is broadcast by hint: Spark broadcasts a side only below its size threshold, and falls
back to the sort-merge join above it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Key = str | tuple[str, str]

_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def key_pairs(on: Sequence[Key]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in on]


def _common_type(left: str, right: str, name: str) -> str:
    if left == right:
        return left
    if {left, right} <= _INTEGRAL:
        return "bigint"
    raise TypeError(f"join key {name}: {left} on one side, {right} on the other; cast one of them")


def _aligned(
    left: DataFrame, right: DataFrame, on: Sequence[Key], keep: Sequence[str]
) -> tuple[DataFrame, list[Column], list[str]]:
    """Right side with its keys renamed, the left keys cast to match, and the renamed keys."""
    pairs = key_pairs(on)
    types_l, types_r = dict(left.dtypes), dict(right.dtypes)
    kinds = [_common_type(types_l[lk], types_r[rk], lk) for lk, rk in pairs]
    names = [f"_k{i}" for i in range(len(pairs))]

    def typed(name: str, have: str, want: str) -> Column:
        return F.col(name) if have == want else F.col(name).cast(want)

    right = right.select(
        *[typed(rk, types_r[rk], t).alias(n) for (_, rk), t, n in zip(pairs, kinds, names, strict=True)],
        *[F.col(c) for c in keep],
    )
    left_keys = [typed(lk, types_l[lk], t) for (lk, _), t in zip(pairs, kinds, strict=True)]
    return right, left_keys, names


def _joined(
    left: DataFrame, right: DataFrame, left_keys: list[Column], names: list[str], how: str, one_row_per_key: bool
) -> DataFrame:
    cond = reduce(Column.__and__, [k == F.col(n) for k, n in zip(left_keys, names, strict=True)])
    if one_row_per_key:
        return left.join(right, cond, how)
    # a condition on the hashes, not columns with them: those would travel through both shuffles
    spread = F.xxhash64(*left_keys) == F.xxhash64(*[F.col(n) for n in names])
    return left.join(right, spread & cond, how)


def matching(left: DataFrame, right: DataFrame, on: Sequence[Key], one_row_per_key: bool = False) -> DataFrame:
    """Rows of ``left`` that have a partner in ``right`` (EXISTS / IN)."""
    right, left_keys, names = _aligned(left, right, on, [])
    return _joined(left, right.distinct(), left_keys, names, "left_semi", one_row_per_key)


def missing(left: DataFrame, right: DataFrame, on: Sequence[Key], one_row_per_key: bool = False) -> DataFrame:
    """Rows of ``left`` without a partner in ``right`` (NOT EXISTS); a NULL key has no partner."""
    right, left_keys, names = _aligned(left, right, on, [])
    return _joined(left, right.distinct(), left_keys, names, "left_anti", one_row_per_key)


def attach(
    left: DataFrame, right: DataFrame, on: Sequence[Key], how: str = "left", one_row_per_key: bool = False
) -> DataFrame:
    """Add the non-key columns of ``right``; row multiplicity is that of the plain join.

    Callers that need one row per driving row pass a ``right`` that is unique on its keys
    (usually the result of an aggregate).
    """
    used = {r for _, r in key_pairs(on)}
    extra = [c for c in right.columns if c not in used]
    clash = set(extra) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    right, left_keys, names = _aligned(left, right, on, extra)
    return _joined(left, right, left_keys, names, how, one_row_per_key).drop(*names)


def null_safe(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add a never-NULL stand-in for ``column``, so that NULL = NULL in an equi-join."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return df.withColumn(name, F.struct(F.col(column).isNull().alias("absent"), value.alias("value")))
