"""Token store, trie counts and prefix BPE against the tokenizer libraries and brute force."""

import base64
import hashlib
import math
import random
import zlib
from functools import lru_cache

import public_tokenizers
import pyarrow.orc
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmend.llm import bpe_prefix, token_store, trie_counts

ODD = (None, "", "   \n\t ", "Hello, World's\x0bend", "ﬁ İ Σσς é é 한국어 각 ᲀ a​b", "x" * 5000, "don't  stop\r\n<|endoftext|> now", "<|ENDOFTEXT|> A. b, C.D. E.. ., Ab.é.", "1²٣ #$%", "a b c 　d")


@lru_cache
def byte_bpe():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return theirs, bpe_prefix.PrefixEncoder(ranks, public_tokenizers.PATTERN)


ALPHABET = st.text(alphabet="ab e'stTh\n\t\r\x0b\x1c\x85 　é漢1²!#​́", max_size=40) | st.text(max_size=30)


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_encoding_equals_the_library(text):
    theirs, ours = byte_bpe()
    ids = ours.encode(text)
    assert ids == theirs.encode_ordinary(text)
    assert ours.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 10), ALPHABET), max_size=8))
def test_edits_and_appends(changes):
    theirs, ours = byte_bpe()
    encoded, text = bpe_prefix.EncodedText(ours), ""
    for start, length, new in changes:
        start = min(start, len(text))
        stop = min(len(text), start + length)
        text = text[:start] + new + text[stop:]
        encoded.edit(start, stop, new)
        assert encoded.text == text and encoded.ids() == theirs.encode_ordinary(text)
    encoded.append(" the end")
    assert encoded.ids() == theirs.encode_ordinary(text + " the end")


def test_an_edit_encodes_only_near_it(prose):
    _, ours = byte_bpe()
    encoded = bpe_prefix.EncodedText(ours, prose(1, 2000))
    before = encoded.encoded_bytes
    encoded.edit(5000, 5003, "xyz")
    assert encoded.encoded_bytes - before < 60


def test_long_piece_without_spaces():
    theirs, ours = byte_bpe()
    text = "".join(random.Random(3).choice("abcde") for _ in range(20_000))
    assert ours.encode(text) == theirs.encode_ordinary(text)


def test_documents_as_digests_and_arrays(documents):
    theirs, _ = byte_bpe()
    docs = documents(*[(i, t, "s") for i, t in enumerate(ODD)], (0, None, None), (None, "null key", None))
    rows = bpe_prefix.digest_documents(docs).collect()
    assert len(rows) == len(ODD) + 2
    by_id = {r.doc_id: r for r in rows}
    for i, t in enumerate(ODD):
        ids = theirs.encode_ordinary(t or "")
        assert by_id[i].n_tokens == len(ids)
        assert by_id[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert by_id[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    arrays = {r.doc_id: r for r in bpe_prefix.encode_documents(docs).collect()}
    assert arrays[3].ids == theirs.encode_ordinary(ODD[3]) and bytes(arrays[3].decoded) == ODD[3].encode()
    assert bpe_prefix.digest_documents(documents(*[]).limit(0)).count() == 0


def best_counts(word: str, scores: dict[str, float], byte_score: float) -> int:
    """Fewest tokens among the segmentations with the best score, by plain dynamic programming."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in scores]
        c = word[end - 1]
        if c not in scores:
            n = len(c.encode())
            options.append((best[end - 1][0] + n * byte_score, best[end - 1][1] - n))
        best.append(max(options))
    return -best[-1][1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcdé", min_size=1, max_size=12), max_size=20), st.randoms(use_true_random=False))
def test_trie_counts_equal_plain_search(words, rng):
    pieces = list("_abc") + ["".join(rng.choice("_abcd") for _ in range(rng.randint(2, 4))) for _ in range(15)]
    scores = {p: -math.log(i + 2) for i, p in enumerate(dict.fromkeys(pieces))}
    trie = trie_counts.UnigramTrie(scores, word_start="_")
    for _ in range(2):  # the second time from what the trie holds
        assert trie.total([w.encode() for w in words]) == sum(best_counts("_" + w, scores, -20.0) for w in words)


def test_prefixes_are_shared_and_long_words_not_stored():
    trie = trie_counts.UnigramTrie({"a": -1.0, "b": -1.1, "ab": -1.5})
    trie.total([b"abab"])
    nodes = trie.nodes
    assert trie.total([b"ababa"]) == 3 and trie.nodes == nodes + 1
    assert trie.total([b"ab" * 100_000]) == 100_000 and trie.nodes == nodes + 1


def test_token_counts_of_documents(documents):
    model = trie_counts.trie(public_tokenizers.path("piece_bpe_32k.model"))
    docs = documents(*[(i, t, "s") for i, t in enumerate(ODD)], (2, "again", "s"))
    rows = sorted((r.doc_id, r.n_words, r.n_tokens) for r in trie_counts.count_tokens(docs).collect())
    words = [(t or "").encode().split() for t in ODD]
    expected = [
        (i, len(w), sum(best_counts("▁" + x.decode(), model.scores, -20.0) if len(x) < 500 else model.total([x]) for x in w)) for i, w in enumerate(words)
    ]
    assert rows == sorted([*expected, (2, 1, best_counts("▁again", model.scores, -20.0))])
    assert trie_counts.count_tokens(docs.limit(0)).count() == 0


def test_store_equals_the_library(spark, documents, tmp_path):
    docs = documents(*[(i * 7 % 11, t, "s") for i, t in enumerate(ODD)], (None, "no key", "s"), (3, "ab", "s"), (3, "ab", "s"))
    path = str(tmp_path / "store")
    token_store.write(docs, path)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(token_store.digests(spark, path).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in rows]
    assert keys[0] is None and keys[1:] == sorted(keys[1:]) and len(rows) == len(ODD) + 3
    at = 0
    expected: dict = {}
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        expected.setdefault(r.doc_id, []).append((len(ids), crc))
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        expected[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(expected.values())


@pytest.mark.parametrize("files", [1, 3, 8])
def test_store_stripes_and_pruning(spark, prose, tmp_path, settings, files):
    """However many files the rows go to, a stripe closes soon after it is full."""
    settings(spark__sql__shuffle__partitions=files, spark__sql__adaptive__enabled="false")
    docs = spark.createDataFrame([(i, prose(i, 300)) for i in range(3000)], "doc_id long, text string")
    path = str(tmp_path / "store")
    token_store.write(docs, path, stripe_bytes=64 << 10)
    stores = [pyarrow.orc.ORCFile(f) for f in (tmp_path / "store").glob("*.orc")]
    assert len(stores) == files and sum(f.nrows for f in stores) == 3000
    for f in stores:
        assert f.nstripes > 1
        # what the writer holds is larger than what it writes; a stripe is never larger than a limit and the rows between two checks
        rows = [f.read_stripe(i).num_rows for i in range(f.nstripes)]
        assert f.content_length / f.nstripes < 2 * (64 << 10) and max(rows) < 400
    found = token_store.read(spark, path, keys=[17, 2900])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in found.collect()) == [17, 2900]
    assert token_store.read(spark, path, between=(10, 19)).count() == 10


def test_stripes_of_long_texts(spark, prose, tmp_path, settings):
    """Few long rows fill a stripe long before an index entry is due."""
    settings(spark__sql__shuffle__partitions=2, spark__sql__adaptive__enabled="false")
    docs = spark.createDataFrame([(i, prose(i, 20_000)) for i in range(40)], "doc_id long, text string")
    path = str(tmp_path / "store")
    token_store.write(docs, path, stripe_bytes=256 << 10, rows_per_index=1000)
    stores = [pyarrow.orc.ORCFile(f) for f in (tmp_path / "store").glob("*.orc")]
    assert max(f.read_stripe(i).num_rows for f in stores for i in range(f.nstripes)) <= 20
    assert all(f.nstripes >= 2 for f in stores)


def test_empty_store(spark, documents, tmp_path):
    path = str(tmp_path / "store")
    token_store.write(documents(*[(1, "a", "b")]).limit(0), path)
    assert token_store.digests(spark, path).count() == 0


@pytest.mark.parametrize("text", ODD)
def test_word_cache(text):
    cache = token_store.word_cache(public_tokenizers.path("word_bpe_49k.json"))
    ids = cache.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    assert cache.encode([(text or "").encode()], 2).to_pylist() == [ids]
