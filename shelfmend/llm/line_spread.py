"""Boilerplate lines: normalised lines that stand on many distinct sites, found by merged HyperLogLog sketches.

Each line hash has a sketch of its sites; sketches merge map-side and again after the shuffle, so a line on every
page costs no more than a few kilobytes. The estimate alone decides lines far from the threshold. Lines within
``margin`` of it get an exact distinct count, so the result is that of exact counts as long as no sketch is off by
``margin`` (at 4096 registers one standard error is 1.6 %, and small sets are counted almost without error).

All in DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import attach, matching
from .common import stored, with_columns

_KEY = ("line_1", "line_2")


def _normalised(line: Column) -> Column:
    """Lower case, without spaces at either end."""
    return F.lower(F.trim(F.translate(line, "\t\x0b\x0c\r", "    ")))


def _own_key(docs: DataFrame, text: str, key: str) -> tuple[Column, Column]:
    """What identifies a row: its key and its text. Equal rows lose the same lines."""
    return F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("null"))), F.xxhash64(F.col(text).cast("string"), F.lit(0))


def lines(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """``_row_1, _row_2, site, at, line_1, line_2``: the lines that are not blank, by 128-bit hash. A null site is a site."""
    row_1, row_2 = _own_key(docs, text, key)
    site = F.coalesce(F.xxhash64(F.col(source).cast("string")), F.lit(0))
    rows = docs.select(
        row_1.alias("_row_1"), row_2.alias("_row_2"), F.when(F.col(source).isNull(), F.lit(0)).otherwise(site).alias("site"),
        F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("at", "_line"),
    ).withColumn("_norm", _normalised(F.col("_line")))
    return rows.filter("_norm != ''").select(
        "_row_1", "_row_2", "site", "at", F.xxhash64("_norm").alias("line_1"), F.xxhash64(F.lit(1), "_norm").alias("line_2"),
    )


def spread_lines(found: DataFrame, sites: int = 10, margin: float = 0.1, registers_log2: int = 12) -> DataFrame:
    """``line_1, line_2`` of the lines on ``sites`` distinct sites or more."""
    sketched = found.groupBy(*_KEY).agg(F.hll_sketch_agg("site", F.lit(registers_log2)).alias("_sketch"))
    estimated = sketched.select(*_KEY, F.hll_sketch_estimate("_sketch").alias("_sites"))
    far = estimated.filter(F.col("_sites") > sites * (1 + margin)).select(*_KEY)
    near = estimated.filter(F.col("_sites").between(sites * (1 - margin), sites * (1 + margin))).select(*_KEY)
    exact = matching(found.select(*_KEY, "site"), near, _KEY).groupBy(*_KEY).agg(F.count_distinct("site").alias("_sites"))
    return far.unionByName(exact.filter(F.col("_sites") >= sites).select(*_KEY))


def remove_spread_lines(
    docs: DataFrame,
    sites: int = 10,
    most_lost: float = 0.5,
    margin: float = 0.1,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    report: bool = False,
) -> DataFrame:
    """Cut lines that stand on ``sites`` or more distinct sites from every text, with their line break.

    A document is cut whatever share of it goes: one that is all boilerplate becomes empty. Only a text that a document
    with another key has as well stays whole where more than ``most_lost`` of its characters would go, since it is a copy
    on many sites and left to the operators on duplicates; ``most_lost=1.0`` cuts these too. Blank lines stay. A null text
    stays null. All rows and columns stay; with ``report``, ``lines_removed`` and ``chars_removed`` are added and take
    the place of columns of that name. Input columns whose names begin with ``_row_`` or ``_cut_`` are dropped.
    """
    found = stored(lines(docs, source, text, key), "lines")  # hashes only; read three times
    boilerplate = spread_lines(found, sites, margin)
    hits = attach(found, boilerplate.withColumn("_hit", F.lit(1)), _KEY, how="inner")
    cuts = hits.groupBy("_row_1", "_row_2").agg(F.collect_set("at").alias("_cut_at"))
    holders = found.groupBy("_row_2").agg(F.min("_row_1").alias("_a"), F.max("_row_1").alias("_b"))
    copies = holders.filter("_a <> _b").select("_row_2", F.lit(True).alias("_cut_copy"))
    cuts = attach(cuts, copies, ["_row_2"])
    row_1, row_2 = _own_key(docs, text, key)
    columns = [c for c in docs.columns if not c.startswith(("_row_", "_cut_"))]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns], row_1.alias("_row_1"), row_2.alias("_row_2"))
    joined = rows.join(cuts, ["_row_1", "_row_2"], "left")
    parts = F.split(F.col(text).cast("string"), "\n")
    gone = F.aggregate(F.col("_cut_at"), F.lit(0), lambda n, i: n + F.length(F.get(parts, i)))
    spared = F.coalesce("_cut_copy", F.lit(False)) & (gone > F.lit(most_lost) * F.length(text))
    real = F.col("_cut_at").isNotNull() & ~spared
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_cut_at"))
    left = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    # under names of their own first: an alias equal to an input column would be taken for it inside a lambda
    made = joined.withColumns({"_cut_real": real, "_cut_gone": gone, "_cut_text": F.when(real, left).otherwise(F.col(text))})
    new = {text: F.col("_cut_text")}
    if not report:
        return made.select(*[new[c].alias(c) if c == text else F.col(f"`{c}`") for c in columns])
    new["lines_removed"] = F.when(F.col("_cut_real"), F.size("_cut_at")).otherwise(F.lit(0)).cast("long")
    new["chars_removed"] = F.when(F.col("_cut_real"), F.col("_cut_gone")).otherwise(F.lit(0)).cast("long")
    return with_columns(made, columns, new)
