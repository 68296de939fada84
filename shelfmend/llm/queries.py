"""The operators applied to the test tables, and the SQL they must agree with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import bpe_prefix, host_lines, licenses, line_spread, maxscore, mixing, passages, pieces, set_join, spelling
from . import token_store, trie_counts, whitening
from .common import documents, fresh_path
from .templates import TEMPLATES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_W = r"[^\x20\x09-\x0D]+"


def _query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: run(tune(spark), folder)
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


@_query("op1_token_store")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_store.write(documents(spark, folder), path)
    return token_store.digests(spark, path)


@_query(
    "op2_line_spread",
    """
WITH l AS (
    SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line
    FROM documents
), k AS (
    SELECT *, lower(trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    '))) AS norm FROM l
), b AS (
    SELECT norm FROM k WHERE norm <> '' GROUP BY norm HAVING count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) >= 10
), m AS (
    SELECT k.*, b.norm IS NOT NULL AS hit FROM k LEFT JOIN b USING (norm)
), g AS (
    SELECT doc_id, count(*) FILTER (WHERE hit) AS n, coalesce(sum(length(line)) FILTER (WHERE hit), 0) AS gone,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT hit), '') AS rest
    FROM m GROUP BY doc_id
)
SELECT d.doc_id, md5(CASE WHEN cut THEN rest ELSE text END) AS text_md5, CASE WHEN cut THEN n ELSE 0 END AS lines_removed,
    CAST(CASE WHEN cut THEN gone ELSE 0 END AS BIGINT) AS chars_removed
FROM (
    SELECT d.doc_id, text, n, rest, gone, n > 0 AND NOT (copied AND gone > 0.5 * length(text)) AS cut
    FROM (SELECT *, min(doc_id) OVER same <> max(doc_id) OVER same AS copied FROM documents WINDOW same AS (PARTITION BY text)) d
    LEFT JOIN g USING (doc_id)
) d
""",
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    cut = line_spread.remove_spread_lines(documents(spark, folder), report=True)
    return cut.select("doc_id", F.md5("text").alias("text_md5"), "lines_removed", "chars_removed")


@_query("op3_passages")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, folder))


@_query(
    "op4_host_lines",
    rf"""
WITH d AS (
    SELECT doc_id, coalesce('s' || source, '') AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_W}') AS w
    FROM documents
), l AS (
    SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d
), full_lines AS (
    SELECT doc_id, host, t, line, regexp_extract_all(line, '{_W}') AS lw FROM l WHERE regexp_matches(line, '{_W}')
), dups AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY doc_id
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5
), named AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS five FROM windows
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS n FROM named) WHERE n >= 2
), repeated AS (
    SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM twice, range(0, 5) AS r(o) GROUP BY doc_id
), norm AS (
    SELECT doc_id, host, t, translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line, len(lw) AS n
    FROM full_lines
), hosts AS (
    SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host
), frequent AS (
    SELECT host, line FROM norm JOIN hosts USING (host) GROUP BY host, line, docs
    HAVING count(DISTINCT t) > 20 AND count(DISTINCT t) > CAST(0.02 AS DOUBLE) * docs
), lost AS (
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS removed_words FROM norm JOIN frequent USING (host, line) GROUP BY doc_id
), m AS (
    SELECT doc_id, len(w) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(removed_words, 0) AS removed_words
    FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)
), f AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND removed_words <= 0.5 * n_words AS kept FROM f
""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = host_lines.verdicts(documents(spark, folder))
    return found.drop("source", "text_hash", "removed")


_OP5 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce('s' || source, '') AS s, len(regexp_extract_all(coalesce(text, ''), '{_W}')) AS size,
        md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS ord
    FROM documents
), src AS (
    SELECT s, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY s
), weighed AS (
    SELECT *, CAST(1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS BIGINT) AS w FROM src
), fill(rest, weight, capped) AS (
    SELECT CAST(sum(source_size) AS DOUBLE), CAST(sum(w) AS DOUBLE), CAST(-1 AS BIGINT) FROM weighed
    UNION ALL
    SELECT total - used, greatest(others, 1), n FROM (
        SELECT max(f.capped) AS capped, sum(source_size) AS total,
            coalesce(sum(3 * source_size) FILTER (WHERE f.rest * w / f.weight >= 3 * source_size), 0) AS used,
            coalesce(sum(w) FILTER (WHERE NOT f.rest * w / f.weight >= 3 * source_size), 0) AS others,
            count(*) FILTER (WHERE f.rest * w / f.weight >= 3 * source_size) AS n
        FROM weighed, fill f
    ) WHERE n > capped
), last AS (
    SELECT rest, weight FROM fill ORDER BY capped DESC LIMIT 1
), aims AS (
    SELECT s, source, source_size,
        CASE WHEN rest * w / weight >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE rest * w / weight END AS target
    FROM weighed, last
), placed AS (
    SELECT *, CAST(sum(size) OVER (PARTITION BY s ORDER BY ord, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start FROM d
), sharded AS (
    SELECT *, start // 4000000 AS shard FROM placed
), parties AS (
    SELECT s, shard, any_value(a.source) AS source, CAST(sum(size) AS BIGINT) AS words, min(start) AS first,
        CASE WHEN any_value(a.source_size) > 0 THEN any_value(a.target) * CAST(sum(size) AS BIGINT) / any_value(a.source_size) ELSE 0 END AS claim
    FROM sharded JOIN aims a USING (s) GROUP BY s, shard
), quotients AS (
    SELECT s, shard, row_number() OVER (ORDER BY claim / (2 * n + 1) DESC, source ASC NULLS LAST, shard, n) AS place
    FROM (SELECT *, unnest(range(0, CAST(claim / 16 AS BIGINT) + 3)) AS n FROM parties WHERE claim > 0)
), won AS (
    SELECT s, shard, count(*) AS seats FROM quotients WHERE place <= (SELECT round(sum(claim) / 16) FROM parties) GROUP BY s, shard
), quotas AS (
    SELECT *, CASE WHEN words > 0 THEN take // words ELSE 0 END AS passes,
        take - CASE WHEN words > 0 THEN take // words ELSE 0 END * words AS more,
        16 * (CAST('0x' || substr(md5('0:' || coalesce(source, '') || ':' || shard), 1, 15) AS BIGINT) % greatest(CAST(ceil(words / 16) AS BIGINT), 1)) AS "from"
    FROM (SELECT p.*, least(coalesce(seats, 0) * 16, 3 * words) AS take FROM parties p LEFT JOIN won USING (s, shard))
)
SELECT p.doc_id, p.size, a.source_size, a.target,
    CAST(q.passes * p.size
        + greatest(least(q."from" + q.more - q.words - (p.start - q.first), p.size), 0)
        + greatest(least(least(q."from" + q.more, q.words) - (p.start - q.first), p.size) - greatest(q."from" - (p.start - q.first), 0), 0)
    AS BIGINT) AS taken
FROM sharded p JOIN quotas q USING (s, shard) JOIN aims a USING (s)
"""


@_query("op5_mix", _OP5)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@_query(
    "op6_maxscore",
    """
WITH v AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
    SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM p q JOIN p c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
""",
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.top_k(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


@_query(
    "op7_set_join",
    rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM common JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), reach(doc_id, component_id) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT y, component_id FROM reach JOIN links ON doc_id = x
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(component_id) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
""",
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return set_join.similar_documents(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


@_query("op8_trie_counts")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return trie_counts.count_tokens(documents(spark, folder))


@_query("op9_bpe_prefix")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_prefix.digest_documents(documents(spark, folder))


def _template_rows() -> str:
    rows = []
    for name, text in TEMPLATES.items():
        words = licenses.template_words(text)
        shingles = licenses.template_shingles(words)
        k, c = min(5, len(words)), 1 << (len(shingles) - 1).bit_length()
        rows += [f"('{name}', {k}, {c}, {len(shingles)}, '{s}')" for s in shingles]
    return ", ".join(rows)


@_query(
    "op10_licenses",
    rf"""
WITH t(license, k, c, n, shingle) AS (VALUES {_template_rows()}),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
s AS (
    SELECT doc_id, k, i - 1 AS pos, array_to_string(w[i:i + k - 1], ' ') AS shingle
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM t))
), hits AS (
    SELECT doc_id, license, c, n, pos, shingle FROM s JOIN t USING (k, shingle)
), windows AS (
    SELECT *, pos // c - o AS no FROM hits, (VALUES (0), (1)) AS v(o) WHERE pos // c >= o
), shares AS (
    SELECT doc_id, license, no, count(DISTINCT shingle) / any_value(n) AS containment, min(pos) AS first FROM windows
    GROUP BY doc_id, license, no
)
SELECT doc_id, license, max(containment) AS containment, min(first) AS first_word FROM shares WHERE containment >= 0.75
GROUP BY doc_id, license
""",
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(documents(spark, folder))


@_query(
    "op11_spelling",
    """
WITH RECURSIVE t AS (
    SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
), r AS (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) GROUP BY ALL
), b AS (
    SELECT r, n, flatten([CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END
        FOR x IN string_split(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || r, '')]) AS bytes
    FROM r WHERE length(r) >= 7
), h AS (
    SELECT r, n, xor(list_reduce([CAST(4294967295 AS BIGINT)] || bytes, lambda c, x: xor(c // 256, steps[xor(c % 256, x) + 1])), 4294967295) AS h
    FROM b, t
), w AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM h
), v AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
    SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), one AS (
    SELECT a.word, b.word AS near FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION
    SELECT word, rest FROM cut SEMI JOIN v ON rest = v.word
    UNION
    SELECT rest, word FROM cut SEMI JOIN v ON rest = v.word
), best AS (
    SELECT one.word, count(*) AS n_near, first(near ORDER BY v.n DESC, near) AS near, max(v.n) AS near_n FROM one JOIN v ON v.word = near
    GROUP BY one.word
), f AS (
    SELECT word, CASE WHEN near_n >= 10 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
    FROM v LEFT JOIN best USING (word)
), up(word, root) AS (
    SELECT word, word FROM f
    UNION ALL
    SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up USING (word) JOIN f AS e ON e.word = up.root WHERE e.form IS NULL
""",
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(documents(spark, folder))


@_query("op12_pieces")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest_documents(documents(spark, folder))


@_query("op13_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
