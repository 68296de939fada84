"""The registered queries against their SQL, and the pipeline against what its stages promise."""

import hashlib
import re
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from compare import connect, differences
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from shelfmend.llm import bpe_prefix, mixing
from shelfmend.llm import queries as llm
from shelfmend.llm.common import documents as read
from shelfmend.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test data not present")


def test_all_are_registered():
    assert set(llm.QUERIES) <= set(queries()) and "pipeline" in queries() and set(llm.SQL) <= set(oracle_sql())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in llm.QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", list(llm.SQL))
def test_query(spark, name):
    found, _ = differences(llm.QUERIES[name](spark, FOLDER), connect(FOLDER), llm.SQL[name])
    assert found == []


def rows_of(folder):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def test_token_store_query(spark):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(llm.QUERIES["op1_token_store"](spark, FOLDER).collect())
    at = 0
    for r, (doc_id, text) in zip(rows, rows_of(FOLDER), strict=True):
        n = len(t.encode(text or "", add_special_tokens=False).ids) + 1
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, at, n)
        at += n


def test_bpe_query(spark):
    bpe = bpe_prefix.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = sorted(llm.QUERIES["op9_bpe_prefix"](spark, FOLDER).collect())
    for r, (doc_id, text) in zip(rows, rows_of(FOLDER), strict=True):
        assert (r.doc_id, r.n_tokens, r.decoded_sha256) == (doc_id, len(bpe.encode(text or "")), hashlib.sha256((text or "").encode()).hexdigest())


def test_passages_query(spark):
    """Every document with a run of 50 words that another one has, and no document without a similar passage."""
    docs = {d: (t or "").lower().encode().split() for d, t in rows_of(FOLDER)}
    runs: dict = {}
    for d, w in docs.items():
        for i in range(len(w) - 49):
            runs.setdefault(tuple(w[i : i + 50]), set()).add(d)
    repeated = {d for s in runs.values() if len(s) > 1 for d in s}
    found = llm.QUERIES["op3_passages"](spark, FOLDER).collect()
    assert repeated <= {r.doc_id for r in found} | {r.other_doc_id for r in found}
    for r in found:
        a, b = docs[r.doc_id][r.first_word : r.after_word], docs[r.other_doc_id][r.other_first : r.other_after]
        assert min(len(a), len(b)) >= 50 and r.equal_words >= 0.75 * max(len(a), len(b))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        assert r.equal_words <= row[-1]


def test_pipeline_stages(spark):
    docs = read(spark, FOLDER)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources", "byte-level BPE"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], FOLDER), name.replace(" ", "-")))
    assert all(t.columns == docs.columns for t in tables[:-1])
    verdicts = {r.doc_id: r.kept for r in llm.QUERIES["op4_host_lines"](spark, FOLDER).collect()}
    assert {r.doc_id for r in tables[1].collect()} == {d for d, kept in verdicts.items() if kept}
    assert tables[2].count() == tables[1].count()
    taken = {r.doc_id: r.taken for r in mixing.mix(tables[3]).collect()}
    words: dict = {}
    for r in tables[4].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
    assert words == {d: n for d, n in taken.items() if n}
    expected = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in tables[4].collect())
    assert sorted((r.doc_id, r.decoded_sha256) for r in tables[5].collect()) == expected
    assert corpus_pipeline.run(spark, FOLDER).count() == tables[5].count()
