"""Mix sources to target weights: Sainte-Laguë apportionment of equal-word blocks, then seeded choice of blocks.

The documents of a source stand in a seeded order and form one long row of words, which is cut into shards of
whole documents. Every (source, shard) is a party whose claim is its share of the source's target; blocks of
``block_words`` words go to the highest quotients claim / (2 n + 1). Each shard then takes as many blocks as it won,
one after the other around its words, from a seeded block on; a second and third round repeats documents.

All in DataFrame operations. No window holds a source: the order runs over ranges, and a shard is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import attach, null_safe
from ..plans.numbering import number_rows, running_total
from .common import WORD, stored


def seeded(seed: int, *parts: Column) -> Column:
    """A number from 0 to 2^60 that depends on the seed and the strings; the same in any engine with MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, source: str, text: str, seed: int) -> DataFrame:
    """``doc_id, source, size, _order, _text``: the words of each row and its place in the seeded order."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        order.alias("_order"),
        F.coalesce(F.xxhash64(F.col(text).cast("string")), F.lit(0)).alias("_text"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source, source_size, target`` for ``source, source_size``: the total shared by weight.

    Sources by code point, null last, have the weights in turn. No target is above ``most`` times its size; what
    is too much goes to the others by weight, until none is above. Each round is one sum over the sources, and
    only that sum comes to the driver.
    """
    numbered = number_rows(sizes, [F.col("source").asc_nulls_last()], "_n", start=0)
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = numbered.withColumn("_w", F.element_at(cycle, (F.col("_n") % len(weights) + 1).cast("int"))).withColumn("_most", most * F.col("source_size"))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    rest, weight, capped = total, rows.agg(F.sum("_w")).first()[0] or 1, 0
    while True:
        share = F.lit(float(rest)) * F.col("_w") / F.lit(float(weight))
        above = share >= F.col("_most")  # a share that reaches the bound stops there
        now, used, others = rows.agg(F.count_if(above), F.sum(F.when(above, F.col("_most"))), F.sum(F.when(~above, F.col("_w")))).first()
        if now == capped:
            break
        capped, rest, weight = now, total - (used or 0), others or 1
    return rows.select("source", "source_size", F.when(above, F.col("_most").cast("double")).otherwise(share).alias("target"))


def seats(parties: DataFrame, block: int) -> DataFrame:
    """Sainte-Laguë: add ``seats`` to rows with ``claim`` (words); as many seats as blocks fit into all claims.

    A party has a seat for each n with claim / (2 n + 1) at or above the last quotient that wins: between
    claim / (2 q) - 1/2 and claim / (2 q) + 1/2 seats. So two divisors enclose that quotient, and on average at
    most two seats a party are open between them; only these are ranked. Ties go to the party that is first by
    ``source`` (null last) and ``shard``.
    """
    total, n = parties.agg(F.sum("claim"), F.count_if(F.col("claim") > 0)).first()
    wanted = round((total or 0.0) / block)
    if not wanted:
        return parties.withColumn("seats", F.lit(0).cast("long"))

    def at(quotient: float) -> Column:
        return F.floor((F.col("claim") / F.lit(quotient) + 1) / 2).cast("long")

    none_more = at(total / (2 * wanted - n)) if 2 * wanted > n else F.lit(0).cast("long")
    rows = parties.withColumn("_sure", none_more).withColumn("_most", at(total / (2 * wanted + n)))
    given = rows.agg(F.sum("_sure")).first()[0]
    candidates = rows.filter(F.col("_most") > F.col("_sure")).select(
        "source", "shard", "claim", F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("_seat")
    )
    quotient = F.col("claim") / (2 * F.col("_seat") + 1)
    ranked = number_rows(
        candidates.withColumn("_q", quotient), [F.col("_q").desc(), F.col("source").asc_nulls_last(), "shard", "_seat"], "_rank"
    )
    best = null_safe(ranked.filter(F.col("_rank") <= wanted - given), "source", "_party")
    won = best.groupBy("_party", "shard").agg(F.count(F.lit(1)).alias("_won"))
    joined = attach(null_safe(rows, "source", "_party"), won, ["_party", "shard"], one_row_per_key=True)
    return joined.withColumn("seats", F.col("_sure") + F.coalesce("_won", F.lit(0))).drop("_party", "_sure", "_most", "_won")


def mix(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    block_words: int = 16,
    shard_words: int = 4_000_000,
    seed: int = 0,
) -> DataFrame:
    """``doc_id, source, text_hash, size, source_size, target, passes, spans, taken`` for every row.

    The mix takes a document ``passes`` times whole, and then the words of ``spans`` (up to two of
    ``struct<first, after>``, counted from 0); ``taken`` counts them all. A null text has size 0 and takes nothing,
    rows without a source form the last source. Equal rows may take different parts of their common place in
    the order. Other columns are not read. No document is taken more than ``most`` times.
    """
    rows = stored(null_safe(sized(docs, source, text, seed), "source", "_s"), "sizes")
    by_source = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    placed = running_total(rows, ["_s"], ["_order", "doc_id", "_text"], "size", "_end")
    placed = placed.withColumn("_start", F.col("_end") - F.col("size")).withColumn("shard", F.floor(F.col("_start") / shard_words).cast("long"))
    placed = stored(placed, "placed")
    aims = null_safe(by_source, "source", "_s").drop("source")
    shards = placed.groupBy("_s", "source", "shard").agg(F.sum("size").alias("_words"), F.min("_start").alias("_first"))
    parties = attach(shards, aims, ["_s"], one_row_per_key=True)
    claim = F.when(F.col("source_size") > 0, F.col("target") * F.col("_words") / F.col("source_size")).otherwise(F.lit(0.0))
    won = seats(parties.withColumn("claim", claim), block_words)

    won = won.withColumn("_take", F.least(F.col("seats") * block_words, most * F.col("_words")))
    won = won.withColumn("passes", F.expr("CASE WHEN _words > 0 THEN _take div _words ELSE 0L END"))
    blocks = F.greatest(F.ceil(F.col("_words") / block_words).cast("long"), F.lit(1))
    block = F.pmod(seeded(seed, F.coalesce("source", F.lit("")), F.col("shard").cast("string")), blocks)
    quotas = won.select(
        "_s", "shard", "source_size", "target", "_words", "_first", "passes",
        (F.col("_take") - F.col("passes") * F.col("_words")).alias("_more"), (block * block_words).alias("_from"),
    )
    joined = attach(placed, quotas, ["_s", "shard"])

    start = F.col("_start") - F.col("_first")

    def part(low: Column, high: Column) -> Column:
        first = F.greatest(low - start, F.lit(0)).cast("long")
        after = F.least(high - start, F.col("size")).cast("long")
        return F.struct(first.alias("first"), F.greatest(after, first).alias("after"))

    end = F.col("_from") + F.col("_more")
    both = F.array(part(F.lit(0), end - F.col("_words")), part(F.col("_from"), F.least(end, F.col("_words"))))
    spans = F.filter(both, lambda s: s["after"] > s["first"])
    taken = F.col("passes") * F.col("size") + F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return joined.select("doc_id", "source", F.col("_text").alias("text_hash"), "size", "source_size", "target", "passes", spans.alias("spans"), taken.alias("taken"))


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The texts of the mix in the columns of ``docs``: whole documents as often as taken, and the parts of spans.

    A part holds its words with the white space between them. ``docs`` and ``mixed`` are matched by document, source
    and text, equal rows one to one; documents of which nothing is taken are left out. Columns whose names begin
    with ``_mix`` give way.
    """
    columns = [c for c in docs.columns if not c.startswith("_mix")]
    twin = Window.partitionBy("_mix_key").orderBy("_mix_key")

    def keyed(df: DataFrame, doc_id: Column, source: Column, text_hash: Column) -> DataFrame:
        same = F.struct(doc_id.alias("d"), source.alias("s"), text_hash.alias("t"))
        key = F.xxhash64(F.to_json(same, {"ignoreNullFields": "false"}))
        return df.withColumn("_mix_key", key).withColumn("_mix_twin", F.row_number().over(twin))

    text_hash = F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0))
    rows = keyed(docs.select(columns), F.col("doc_id").cast("long"), F.col("source").cast("string"), text_hash)
    whole = F.struct(F.lit(-1).cast("long").alias("first"), F.lit(-1).cast("long").alias("after"))
    parts = F.concat(F.array_repeat(whole, F.col("passes").cast("int")), F.col("spans"))
    taken = keyed(mixed.withColumn("_mix_parts", parts), F.col("doc_id"), F.col("source"), F.col("text_hash"))
    joined = rows.join(taken.filter(F.col("taken") > 0).select("_mix_key", "_mix_twin", "_mix_parts"), ["_mix_key", "_mix_twin"])
    joined = joined.select(*columns, F.explode("_mix_parts").alias("_mix_part"))
    space = " \t\n\x0b\x0c\r"
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    first, after = F.col("_mix_part.first").cast("int"), F.col("_mix_part.after").cast("int")
    piece = F.rtrim(F.array_join(F.slice(pieces, first + 1, after - first), ""), F.lit(space))
    text = F.when(first < 0, F.col("text")).otherwise(piece)
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in columns])
