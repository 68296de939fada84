"""Find license texts: MinHash bands of overlapping text windows retrieve templates, shingle containment verifies them.

Templates are grouped by their number of shingles (up to the next power of two, c). A text's shingles are cut into
windows of 2c, one every c, so each run of c lies in a window. Where a window holds three quarters of a
template's shingles, their Jaccard similarity is at least 0.375 / 2.125 = 0.176, and with 64 bands of one
row they collide with a probability above 1 - 4e-6.

Only windows with an anchor word are signed. The anchors of a template are words that together lie in more than a
quarter of its shingles; a text without any of them cannot hold three quarters of the shingles.

All in DataFrame operations. Templates are data of a bounded size (``most_shingles``); only they are broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .templates import TEMPLATES

_SHINGLE = 5


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_shingles(words: list[str]) -> list[str]:
    """Runs of five words; a shorter template is one run. Each once, in order."""
    k = min(_SHINGLE, len(words))
    return list(dict.fromkeys(" ".join(words[i : i + k]) for i in range(len(words) - k + 1)))


def anchors(words: list[str], containment: float) -> list[str]:
    """Words of which every text with ``containment`` of the shingles has one: long ones in many shingles first."""
    shingles = [set(s.split(" ")) for s in template_shingles(words)]
    spare = len(shingles) - containment * len(shingles)  # so many shingles a match may lack
    chosen: list[str] = []
    uncovered = shingles
    while len(shingles) - len(uncovered) <= spare:
        counts = Counter(w for s in uncovered for w in s)
        word = max(counts, key=lambda w: (max(counts[w] * (len(w) - 4), 0), len(w), -words.index(w)))
        chosen.append(word)
        uncovered = [s for s in uncovered if word not in s]
    return chosen


def _size_class(n: int) -> int:
    return 1 << (n - 1).bit_length()


def _signature(shingles: Column, bands: int) -> Column:
    """The smallest of the shingles' hashes under each of ``bands`` hash functions."""
    numbers = F.sequence(F.lit(0), F.lit(bands - 1))
    return F.transform(numbers, lambda b: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b))))


def find_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    containment: float = 0.75,
    bands: int = 64,
    most_shingles: int = 200_000,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key, license, containment, first_word``: each row's templates, with the largest share of a template's
    shingles found in one window and the place of the first shared word (from 0).

    Words are runs of letters and digits in lower case. A null or empty text and one shorter than a template's
    shingle hold none. Repeated rows are reported each. Other columns are not read. A document holds at most one
    row for each template.
    """
    spark = docs.sparkSession
    known = {name: template_words(t) for name, t in templates.items()}
    known = {name: w for name, w in known.items() if w}
    rows = [
        (name, min(_SHINGLE, len(w)), _size_class(len(s)), len(s), s)
        for name, w in known.items()
        for s in [template_shingles(w)]
    ]
    if sum(r[3] for r in rows) > most_shingles:
        raise ValueError(f"the templates have more than {most_shingles} shingles")
    result = f"{key} long, license string, containment double, first_word long"
    if not rows:
        return spark.createDataFrame([], result)
    # of each kind: the anchors, and the fewest shingles that a match has
    kinds: dict[tuple[int, int], tuple[set[str], int]] = {}
    for name, k, c, n, _ in rows:
        words, fewest = kinds.get((k, c), (set(), n))
        kinds[k, c] = words | set(anchors(known[name], containment)), min(fewest, ceil(containment * n - 1e-9))
    wanted = sorted(set().union(*[words for words, _ in kinds.values()]))
    table = spark.createDataFrame(rows, "license string, k int, c int, n int, _texts array<string>")
    table = table.withColumn("_shingles", F.transform("_texts", lambda s: F.xxhash64(s))).drop("_texts")
    keys = table.select("license", "k", "c", F.posexplode(_signature(F.col("_shingles"), bands)).alias("band", "least"))

    lowered = F.lower(F.col(text).cast("string"))
    some = F.lit(False)
    for word in wanted:
        if len(word) > 3:
            some = some | lowered.contains(word)
    short = "|".join(word for word in wanted if len(word) <= 3)  # these lie in many other words
    if short:
        some = some | lowered.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{short})(?![\p{{L}}\p{{N}}])")
    texts = docs.filter(some).select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).cast("long").alias(key),
        F.split(F.trim(F.regexp_replace(lowered, r"[^\p{L}\p{N}]+", " ")), " ").alias("words"),
    )
    kind = F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(c).alias("c"), F.lit(fewest).alias("fewest"), F.array(*[F.lit(w) for w in sorted(words)]).alias("anchors"))
        for (k, c), (words, fewest) in sorted(kinds.items())
    ])
    cut = texts.withColumn("_kind", F.explode(kind)).select("_row", key, "words", "_kind.*")
    cut = cut.filter((F.size("words") - F.col("k") + 1 >= F.col("fewest")) & F.arrays_overlap("words", "anchors"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - F.col("k"), F.lit(0)), F.col("c"))
    windows = cut.withColumn("start", F.explode(starts)).select(
        "_row", key, "k", "c", "fewest", "anchors", "start", F.slice("words", F.col("start") + 1, 2 * F.col("c") + F.col("k") - 1).alias("words")
    )
    windows = windows.filter((F.size("words") - F.col("k") + 1 >= F.col("fewest")) & F.arrays_overlap("words", "anchors"))
    at = F.sequence(F.lit(1), F.size("words") - F.col("k") + 1)
    windows = windows.filter(F.size("words") >= F.col("k")).withColumn(
        "_window", F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice("words", i, F.col("k")), " ")))
    )
    signed = windows.select("_row", key, "k", "c", "start", "_window", F.posexplode(_signature(F.col("_window"), bands)).alias("band", "least"))
    # the templates' band keys and shingles: bounded by most_shingles
    met = signed.join(F.broadcast(keys), ["k", "c", "band", "least"]).drop("band", "least").dropDuplicates(["_row", "license", "start"])
    checked = met.join(F.broadcast(table.select("license", "n", "_shingles")), "license")
    share = F.size(F.array_intersect("_window", "_shingles")) / F.col("n")
    first = F.array_min(F.transform(F.array_intersect("_window", "_shingles"), lambda h: F.array_position("_window", h)))
    verified = checked.withColumn("containment", share).filter(F.col("containment") >= containment)
    found = verified.withColumn("first_word", F.col("start") + first - 1)
    grouped = found.groupBy("_row", key, "license").agg(F.max("containment").alias("containment"), F.min("first_word").cast("long").alias("first_word"))
    return grouped.select(key, "license", "containment", "first_word")
