"""String expressions shared by the operators. All are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(*parts: Column) -> Column:
    """Concatenate, treating NULL as an empty string."""
    return F.concat_ws("", *[p.cast("string") for p in parts])


def guid(*keys: Column | str) -> Column:
    """32-hex message id made from natural keys, so a re-run gives the same id.

    A NULL key is written as ``~`` so that it cannot collide with a missing one.
    """
    return F.md5(F.concat_ws("|", *[F.coalesce(col(k).cast("string"), F.lit("~")) for k in keys]))


def new_id(kind: str, *keys: Column | str) -> Column:
    """Surrogate key for a new row, made from natural keys: a :func:`guid` for a string column, a negative
    number for an integer one (numbers in use are positive)."""
    if kind == "string":
        return guid(*keys)
    parts = F.concat_ws("|", *[F.coalesce(col(k).cast("string"), F.lit("~")) for k in keys])
    return (-F.shiftrightunsigned(F.xxhash64(parts), 1) - 1).cast(kind)


def _padded(value: Column, width: int, what: str) -> Column:
    """Left-padded with zeros; a value that does not fit fails the job instead of losing its end."""
    long = F.length(value) > width
    message = F.concat(F.lit(f"{what} has more than {width} characters: "), value)
    return F.when(long, F.raise_error(message).cast("string")).otherwise(F.lpad(value, width, "0"))


def padded_document_key(order_number: Column | str, prefix: str = "499.") -> Column:
    """Fiscal document key: company prefix and the order number left-padded to 20."""
    return F.concat(F.lit(prefix), _padded(col(order_number).cast("string"), 20, "order number"))


def trouble_status(context: Column | str) -> Column:
    """TRBL for troubled transfer contexts, ATS for all others and for NULL."""
    return F.when(col(context).isin(*fixed.TROUBLE_CONTEXTS), F.lit("TRBL")).otherwise(F.lit("ATS"))


def store_location(store_number: Column | str, suffix: str, strict: bool = False) -> Column:
    """Staging location of a store: fixed prefix, 3-character store number, suffix. A longer number fails the job;
    ``strict`` takes its first 3 characters, as the source's LPAD does."""
    number = col(store_number).cast("string")
    padded = F.lpad(number, 3, "0") if strict else _padded(number, 3, "store number")
    return F.concat(F.lit(fixed.STORE_PREFIX), padded, F.lit(suffix))
