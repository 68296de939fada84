"""MaxScore, set join, passages and license scan against brute force, on odd rows."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmend.llm import licenses, maxscore, passages, set_join, shingles
from shelfmend.llm.templates import TEMPLATES


def brute_top(vectors, is_query, k):
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in ints:
        if is_query(qi):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in ints if i != qi)
            out += [(qi, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return Counter(out)


def test_top_k(spark):
    rng = random.Random(1)
    vectors = [(i, [rng.gauss(0, 0.2) for _ in range(24)]) for i in range(300)]
    vectors += [(300 + i, vectors[7][1]) for i in range(20)]  # ties
    vectors += [(400, None), (401, [0.1, None]), (402, [float("nan")] * 24), (403, [float("inf")] * 24), (404, []), (None, vectors[3][1])]
    vectors += [(405, [0.5]), (410, [1e9, -1e9, 3.0]), (5, vectors[9][1])]
    df = spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<double>, shard string, block int")
    found = maxscore.top_k(df, F.col("vec_id") % 10 == 0, k=5, shard_rows=64, query_rows=16)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == brute_top(vectors, lambda i: i % 10 == 0, 5)


def test_top_k_broadcasts_nothing(spark):
    """Few queries are no reason to bring them, once for each shard, to the driver; a task keeps the best of all its shards."""
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(400)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = maxscore.top_k(df, F.col("vec_id") % 40 == 0, k=3, shard_rows=16, query_rows=4)
    assert Counter(tuple(r) for r in found.collect()) == brute_top(vectors, lambda i: i % 40 == 0, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "CartesianProduct" in plan


def test_best_of_keeps_each_place():
    low, high = -(2**63), 2**63 - 1
    some = [np.array([1, 1, 2]), np.array([10, 10, 20]), np.array([5, 6, 7]), np.array([low, high, 3])]
    more = [np.array([1, 2, 2]), np.array([10, 20, 20]), np.array([4, 8, 6]), np.array([high, 3, 3])]
    kept = maxscore._best_of(maxscore._best_of(None, some, 2), more, 2)
    assert list(zip(*(x.tolist() for x in kept), strict=True)) == [(1, 10, 4, high), (1, 10, 6, high), (2, 20, 6, 3), (2, 20, 7, 3)]


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [0.5, -0.25]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in maxscore.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 512 * 1024 - 256 * 1024)]
    assert maxscore.top_k(df, F.lit(False)).count() == 0
    assert maxscore.top_k(df.limit(0), F.lit(True)).count() == 0
    assert maxscore.top_k(df.limit(1), F.lit(True)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 80), st.integers(1, 40), st.integers(1, 12), st.integers(0, 2**32 - 1), st.sampled_from([3, 2000, 2**40]))
def test_shard_equals_all_scores(rows, width, k, seed, most):
    rng = np.random.default_rng(seed)
    matrix = rng.integers(-most, most, (rows, width))
    ids = rng.permutation(rows)
    query = matrix[0] if seed % 2 else rng.integers(-most, most, width)
    found, scores = maxscore.Shard(ids, matrix).best(query, int(ids[0]), k)
    exact = [(-sum(int(a) * int(b) for a, b in zip(query, m, strict=True)), int(i)) for m, i in zip(matrix, ids, strict=True) if i != ids[0]]
    limit = 2**63
    assert [(int(i), int(s)) for i, s in zip(found, scores, strict=True)] == [(i, max(-limit, min(limit - 1, -s))) for s, i in sorted(exact)[:k]]


def test_probing_prunes():
    rng = np.random.default_rng(5)
    matrix = (rng.standard_normal((2000, 32)) * np.geomspace(1000, 1, 32)).astype(np.int64)
    shard = maxscore.Shard(np.arange(2000), matrix)
    probed = []
    real, maxscore.np.ix_ = np.ix_, lambda a, b: probed.append(len(b)) or real(a, b)
    try:
        shard.best(matrix[0], 0, 10)
    finally:
        maxscore.np.ix_ = real
    assert probed and probed[-1] < 200 and sum(probed) < 4000


def brute_components(rows, percent=75):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None and (least[r] is None or d < least[r]):
            least[r] = d
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


def near_copies(prose, seed, base_words, copies, edits, first):
    rng = random.Random(seed)
    base = prose(seed, base_words).split()
    out = []
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append((first + i, " ".join(w)))
    return out


def join_rows(prose):
    rows = [(i, prose(i, 40 + i)) for i in range(40)]
    rows += near_copies(prose, 50, 200, 40, 9, 100) + near_copies(prose, 51, 30, 30, 2, 200) + near_copies(prose, 52, 9, 30, 1, 300)
    rows += near_copies(prose, 53, 80, 30, 4, 400)
    chain = prose(60, 400).split()
    rows += [(500 + i, " ".join(chain[8 * i : 8 * i + 120])) for i in range(25)]  # neighbours alike, ends not
    shared = prose(61, 12)
    rows += [(600 + i, f"{prose(600 + i, 25)} {shared}") for i in range(60)]  # a common passage
    rows += [(700, None), (701, ""), (702, " \n"), (703, "one"), (704, "ONE"), (705, "one two"), (706, "a b c d e"), (707, "A b  c d\te")]
    rows += [(None, rows[3][1]), (None, "only null key here indeed"), (3, rows[3][1]), (708, "w " * 5000), (709, "w " * 300)]
    return rows


def test_components_equal_brute_force(documents, prose, monkeypatch):
    rows = join_rows(prose)
    expected = Counter(brute_components(rows))
    docs = documents(*[(i, t, "s") for i, t in rows])
    found = set_join.similar_documents(docs)
    assert Counter(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()) == expected
    monkeypatch.setattr(set_join, "_LIST_PART", 3)  # every list in parts
    monkeypatch.setattr(set_join, "_BROADCAST_ROWS", 0)
    monkeypatch.setattr(set_join, "boundary", lambda counts, percent: set_join.Boundary(40, percent))  # and pairs for more sets
    found = set_join.similar_documents(docs)
    assert Counter(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()) == expected


def test_one_document_of_each_stays(documents, prose):
    rows = join_rows(prose)
    docs = documents(*[(i, t, "s") for i, t in rows], (3, rows[3][1], "s"))
    out = set_join.one_of_each(docs)
    assert out.columns == docs.columns
    groups = {d: c for d, n, c in brute_components(rows) if n}
    kept = Counter(r.doc_id for r in out.collect())
    assert all(kept[d] == (1 if groups[d] == d else 0) for d in groups if d is not None)
    assert kept[700] == kept[701] == kept[702] == 1 and kept[None] == 1


def test_join_of_nothing(documents):
    docs = documents((1, None, None), (2, "", "x"))
    assert sorted(tuple(r) for r in set_join.similar_documents(docs).select("doc_id", "n_shingles", "component_id").collect()) == [(1, 0, 1), (2, 0, 2)]
    assert set_join.similar_documents(docs.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 30), min_size=1, max_size=25), st.sets(st.integers(0, 30), min_size=1, max_size=25), st.sampled_from([50, 60, 75, 90]), st.integers(0, 30))
def test_prefixes_of_matching_sets_meet(a, b, percent, light_to):
    if a == b or 100 * len(a & b) < percent * len(a | b):
        return
    bound = set_join.Boundary(light_to, percent)

    def keys(s):
        order, out = sorted(s), set()
        if bound.light(len(s)):
            p = order[: set_join.prefix_length(len(s), percent, 2)]
            out |= {(x, y) for n, x in enumerate(p) for y in p[n + 1 :]}
        if bound.single(len(s)):
            out |= set(order[: set_join.prefix_length(len(s), percent)])
        return out

    assert keys(a) & keys(b)


def test_shingles_do_not_depend_on_the_process():
    assert shingles.shingle_set(b"A b c d e f", 5).tolist() == shingles.shingle_set(b"a  b\nc d e f", 5).tolist()
    assert len(shingles.shingle_set(b"a b c d e f", 5)) == 2 and len(shingles.shingle_set(b"a b", 5)) == 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25, unique=True))
def test_best_chain(matches):
    found = passages.chains([m for m, _ in matches], [o for _, o in matches], 5)
    order = sorted(matches)
    best: list[float] = []
    for i, (m, o) in enumerate(order):
        before = [best[j] - passages._COST * (m - x + o - y) for j, (x, y) in enumerate(order[:i]) if x < m and y < o]
        best.append(1 + max([0.0, *before]))

    def score(chain):
        return sum(1 - (passages._COST * (b[0] - a[0] + b[1] - a[1]) if a else 0) for a, b in zip([None, *chain], chain, strict=False))

    whole = [c for c in found if max((max(b[0] - a[0], b[1] - a[1]) for a, b in zip(c, c[1:], strict=False)), default=0) <= passages._SPLIT]
    assert abs(score(whole[0]) - max(best)) < 1e-9 or len(found) > len(whole)
    assert sorted(m for c in found for m in c) == order
    assert all(a[0] < b[0] and a[1] < b[1] for c in found for a, b in zip(c, c[1:], strict=False))


def test_planted_passages(documents, prose):
    rng = random.Random(4)
    passage, fuzzy = prose(1000, 60).split(), prose(1001, 120).split()
    rows = [(i, prose(i, 200)) for i in range(60)]
    for i in range(20, 30):
        w = rows[i][1].split()
        rows[i] = (i, " ".join(w[:90] + passage + w[90:]))
    for i in range(30, 40):
        w, p = rows[i][1].split(), list(fuzzy)
        for at in range(rng.randint(0, 12), 120, 17):
            p[at] = f"edit{i}"
        del p[50]
        rows[i] = (i, " ".join(w[:50] + p + w[50:]))
    rows += [(70, rows[0][1]), (71, rows[0][1]), (72, None), (73, ""), (74, "a b"), (None, rows[1][1]), (75, "x " * 3000), (76, "x " * 2000)]
    rows += [(i, f"{prose(i, 80)} {prose(1002, 20)}") for i in range(80, 95)]  # shared, but short
    docs = documents(*[(i, t, "s") for i, t in rows])
    found = passages.repeated_passages(docs).collect()
    flagged = {r.doc_id for r in found} | {r.other_doc_id for r in found}
    assert flagged == {*range(20, 40), 0, 70, 71, 1, None}  # one word over and over has one seed only
    for r in found:
        if r.doc_id is not None and 20 <= r.doc_id < 30:
            assert (r.first_word, r.after_word, r.other_first, r.other_after, r.equal_words) == (90, 150, 90, 150, 60)
        if r.doc_id is not None and 30 <= r.doc_id < 40:
            assert abs(r.first_word - 50) <= 13 and abs(r.after_word - 169) <= 17 and r.equal_words >= 85
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_task_combining_loses_no_passage(documents, prose, monkeypatch):
    passage = prose(5, 70)
    docs = documents(*[(i, f"{prose(100 + i, 60)} {passage} {prose(200 + i, 30)}", "s") for i in range(40)])
    for held in (0, 50, 10**6):
        monkeypatch.setattr(passages, "_HELD_SEEDS", held)
        found = passages.repeated_passages(docs.repartition(7)).collect()
        assert {r.doc_id for r in found} | {r.other_doc_id for r in found} == set(range(40))


def excerpts(prose, n, words):
    """Documents that quote random excerpts of one long text, and which of them share 50 words in a row with another."""
    rng = random.Random(n)
    whole = prose(3, 1000).split()
    rows = []
    for i in range(n):
        at = rng.randint(0, len(whole) - words)
        rows.append((i, " ".join([prose(1000 + i, rng.randint(10, 60)), *whole[at : at + words], prose(5000 + i, 30)])))
    holders = defaultdict(set)
    for i, t in rows:
        w = t.split()
        for at in range(len(w) - 49):
            holders[tuple(w[at : at + 50])].add(i)
    return rows, holders


def test_every_exact_run_is_in_a_row(documents, prose):
    rows, holders = excerpts(prose, 300, 60)
    found = passages.repeated_passages(documents(*[(i, t, "s") for i, t in rows]).repartition(5)).collect()
    covered = defaultdict(set)  # places of each document in some row
    for r in found:
        covered[r.doc_id].update(range(r.first_word, r.after_word))
        covered[r.other_doc_id].update(range(r.other_first, r.other_after))
    texts = {i: t.split() for i, t in rows}
    for i, w in texts.items():
        for at in range(len(w) - 49):
            if len(holders[tuple(w[at : at + 50])]) > 1:
                assert covered[i] >= set(range(at, at + 50))


@pytest.mark.parametrize("words", [60, 100])
@pytest.mark.parametrize("every", [4, 5, 6, 8])
def test_changed_words_down_to_the_identity(documents, prose, words, every):
    rows = []
    for i in range(30):  # pairs; one word in ``every`` is replaced
        p = prose(i, words).split()
        q = [f"new{i}x{n}" if n % every == i % every else w for n, w in enumerate(p)]
        rows += [(2 * i, f"{prose(300 + i, 40)} {' '.join(p)} {prose(600 + i, 30)}"), (2 * i + 1, f"{prose(900 + i, 25)} {' '.join(q)} {prose(1200 + i, 60)}")]
    found = passages.repeated_passages(documents(*[(i, t, "s") for i, t in rows])).collect()
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in found} == {frozenset((2 * i, 2 * i + 1)) for i in range(30)}


def test_every_place_of_a_passage_is_in_a_row(documents, prose):
    p = prose(1, 60)
    stray = " ".join(" ".join([*p.split()[i : i + 5], f"x{i}"]) for i in range(0, 60, 5))  # its words in other company before it
    rows = [(0, f"{prose(2, 30)} {p} {prose(3, 90)} {p}"), (1, f"{prose(4, 20)} {p}"), (2, f"{stray} {prose(5, 80)} {p} {prose(6, 80)} {p} end")]
    found = passages.repeated_passages(documents(*[(i, t, "s") for i, t in rows])).collect()
    covered = defaultdict(set)
    for r in found:
        covered[r.doc_id].update(range(r.first_word, r.after_word))
        covered[r.other_doc_id].update(range(r.other_first, r.other_after))
    for i, t in rows:
        w = t.split()
        for at in range(len(w) - 59):
            if w[at : at + 60] == p.split():
                assert covered[i] >= set(range(at, at + 60))


def test_passages_do_not_depend_on_the_layout(documents, prose, monkeypatch):
    rows, _ = excerpts(prose, 200, 60)
    rng = random.Random(8)
    rows = [(i, " ".join(w if rng.random() > 0.1 else f"new{i}x{n}" for n, w in enumerate(t.split()))) for i, t in rows]
    docs, found = documents(*[(i, t, "s") for i, t in [*rows, *[(1000 + i, t) for i, t in rows[:40]]]]), set()
    for parts, held, bucket, slices in ((1, 10**6, 10**6, 10**6), (8, 3000, 700, 50), (32, 100, 10**5, 7)):
        for name, value in (("_HELD_SEEDS", held), ("_BUCKET_SEEDS", bucket), ("_SLICE_TEXTS", slices)):
            monkeypatch.setattr(passages, name, value)
        found.add(frozenset(passages.repeated_passages(docs.repartition(parts)).collect()))
    assert len(found) == 1 and next(iter(found))


@pytest.mark.parametrize("values", [[0], [1], [2**64 - 1, 0, 5], [300, 2, 70000], list(range(1000))])
def test_packed_numbers_come_back(values):
    numbers = np.array(values, np.uint64)
    assert (passages._unpacked(passages._packed(numbers), len(numbers)) == numbers).all()


def brute_licenses(rows):
    out = {}
    for n, (d, t) in enumerate(rows):
        words = licenses.template_words(t or "")
        for name, text in TEMPLATES.items():
            tw = licenses.template_words(text)
            want = licenses.template_shingles(tw)
            k, c = min(5, len(tw)), 1 << (len(want) - 1).bit_length()
            sh = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
            for s in range(0, max(len(sh), 1), c):
                hit = [i for i, x in enumerate(sh[s : s + 2 * c]) if x in set(want)]
                share = len({sh[s + i] for i in hit}) / len(want)
                if share >= 0.75:
                    a, b = out.get((n, d, name), (0, 10**9))
                    out[n, d, name] = (max(a, share), min(b, s + hit[0]))
    return Counter((d, name, *v) for (_, d, name), v in out.items())


def test_licenses(documents, prose):
    rows = [(i, f"{prose(i, 40)}\n{t}\n{prose(i + 50, 20)}") for i, t in enumerate(TEMPLATES.values())]
    mit = TEMPLATES["MIT"].split()
    rows += [(20, " ".join(mit[:40] + ["changed"] + mit[41:])), (21, " ".join(mit[: len(mit) // 2])), (22, f"{prose(9, 700)} {' '.join(mit)} {prose(10, 900)}")]
    rows += [(23, None), (24, ""), (25, "License"), (26, "ALL-RIGHTS:reserved!"), (27, "all rights are not reserved"), (None, "All rights reserved.")]
    rows += [(28, "all rights reserved " * 3000), (29, prose(30, 300)), (26, "ALL-RIGHTS:reserved!")]
    docs = documents(*[(i, t, "s") for i, t in rows])
    found = licenses.find_licenses(docs)
    assert found.columns == ["doc_id", "license", "containment", "first_word"]
    assert Counter(tuple(r) for r in found.collect()) == brute_licenses(rows)
    assert licenses.find_licenses(docs.limit(0)).count() == 0
    assert licenses.find_licenses(docs, templates={}).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_common_licenses_are_known(documents, prose):
    notices = {
        "BSD-3-Clause title": "Licensed under the BSD 3-Clause License", "MIT title": "Licensed under the MIT License",
        "CC-BY-NC-SA-4.0": "(CC BY-NC-SA 4.0)", "CC-BY-SA-4.0": "CC BY-SA 4.0", "CC0-1.0": "CC0 1.0", "SPDX MPL-2.0": "// SPDX-License-Identifier: MPL-2.0",
        "LGPL-2.1 header": TEMPLATES["LGPL-2.1 header"], "AGPL-3.0 header": TEMPLATES["AGPL-3.0 header"], "EPL-2.0 header": TEMPLATES["EPL-2.0 header"],
        "Unlicense text": TEMPLATES["Unlicense text"], "BSD-2-Clause": TEMPLATES["BSD-2-Clause"],
        "Apache-2.0 text": TEMPLATES["Apache-2.0 text"].split("APPENDIX")[0], "GPL-3.0 text": TEMPLATES["GPL-3.0 text"].split("How to Apply")[0],
    }
    rows = [(i, f"{prose(i, 40)} {t} {prose(i + 50, 20)}", "s") for i, t in enumerate(notices.values())]
    found = licenses.find_licenses(documents(*rows)).collect()
    assert {(i, name) for i, name in enumerate(notices)} <= {(r.doc_id, r.license) for r in found}


@pytest.mark.parametrize("name", list(TEMPLATES))
def test_anchors_cover(name):
    words = licenses.template_words(TEMPLATES[name])
    chosen = licenses.anchors(words, 0.75)
    runs = [set(s.split(" ")) for s in licenses.template_shingles(words)]
    assert sum(not (r & set(chosen)) for r in runs) < 0.75 * len(runs)


@pytest.mark.parametrize("block", [4, 256])
def test_set_join_of_a_group_around_the_threshold(documents, prose, monkeypatch, block):
    """Copies with as many edits as just stay linked or just do not, in blocks of any size: the components of brute force."""
    monkeypatch.setattr(set_join, "_BLOCK_SETS", block)
    rng = random.Random(11)
    base = prose(77, 150).split()
    rows = []
    for i in range(70):
        words = list(base)
        for at in rng.sample(range(150), rng.choice((1, 2, 3, 4, 5, 6))):
            words[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(words), "s"))
    sets = [{tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for _, t, _ in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                low, high = sorted((comp[i], comp[j]))
                comp = [low if c == high else c for c in comp]
    found = set_join.similar_documents(documents(*rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(comp)) and 1 < len(set(comp)) < len(rows)


def test_sets_without_a_common_anchor_are_compared(documents, prose, monkeypatch):
    """With lists too long for anchors, all pairs come the other way."""
    monkeypatch.setattr(set_join, "_ANCHOR_SETS", 1)
    rows = [(i, prose(1, 60) + " " + prose(100 + i, 3 + i % 9), "s") for i in range(30)] + [(99, prose(2, 60), "s")]
    found = {r.doc_id: r.component_id for r in set_join.similar_documents(documents(*rows)).collect()}
    monkeypatch.undo()
    assert found == {r.doc_id: r.component_id for r in set_join.similar_documents(documents(*rows)).collect()}
    assert found[29] == found[0] == 0 and found[99] == 99


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 300), st.integers(0, 80), st.integers(0, 80), st.integers(0, 10**6), st.sampled_from([50, 75, 90]))
def test_parities_rule_out_no_link(both, left, right, seed, percent):
    rng = np.random.default_rng(seed)
    hashes = np.unique(rng.integers(0, 2**63, both + left + right, dtype=np.uint64))
    a, b = np.sort(hashes[: both + left]), np.sort(np.concatenate((hashes[:both], hashes[both + left :])))
    n = len(np.intersect1d(a, b))
    if 100 * n < percent * (len(a) + len(b) - n):
        return
    x, y = (np.frombuffer(set_join.parities(s), np.uint64) for s in (a, b))
    assert set_join.near_enough(x.reshape(1, -1), y.reshape(1, -1), len(a), np.array([len(b)]), percent).all()


def test_large_sets_that_share_lists_by_chance_leave_no_rows(spark, documents, prose, monkeypatch):
    rng = random.Random(6)
    quoted = [prose(7000 + i, 30) for i in range(12)]  # each text is made of half of them
    texts = [" ".join(rng.sample(quoted, 6)) for _ in range(60)]
    near = [" ".join(x if rng.random() > 0.02 else f"new{i}" for i, x in enumerate(texts[n].split())) for n in range(5)]
    rows = [*enumerate([*texts, *near])]
    made, by_list = [], set_join._by_list

    def counted(rows, columns, handle, schema):
        out = by_list(rows, columns, handle, schema)
        if columns == ["key", "low", "high"] and schema.startswith("a long"):
            made.append(out.count())
        return out

    monkeypatch.setattr(set_join, "_by_list", counted)
    monkeypatch.setattr(set_join, "_ANCHORED_SHINGLES", 0)  # all sets are large
    found = set_join.similar_documents(documents(*[(i, t, "s") for i, t in rows]))
    assert Counter(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()) == Counter(brute_components(rows))
    assert made and sum(made) < 1000, made  # without the parities a row for each two texts of a list


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.lists(st.integers(0, 4), max_size=60), st.sampled_from([1, 7, 50, 10**6]))
def test_runs_at_all_places_however_many_match(a, b, at_once):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(passages, "_MATCHES", at_once)
        found = passages.segments(np.array(a, np.uint64), np.array(b, np.uint64))
    expected = []
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] == b[j] and not (i and j and a[i - 1] == b[j - 1]):
                n = next(n for n in range(1, len(a) + 1) if i + n == len(a) or j + n == len(b) or a[i + n] != b[j + n])
                expected.append((i, j, n))
    assert sorted(found) == sorted(expected)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=120, unique=True))
def test_dense_chains_are_the_same(matches):
    assert passages._best_dense_chains(sorted(matches)) == passages._best_chains(sorted(matches))


def test_passage_among_very_many_matches(documents, prose, monkeypatch):
    p = prose(1, 60).split()
    phrase = " ".join(" ".join([*p[i : i + 5], "y"]) for i in range(0, 60, 5))  # each window of the passage stands there before it
    rows = [(0, f"{phrase} {prose(2, 80)} {' '.join(p)}"), (1, f"{phrase} {prose(3, 80)} {' '.join(p)} {prose(4, 90)} {' '.join(p)}")]
    monkeypatch.setattr(passages, "_MATCHES", 100)
    found = passages.repeated_passages(documents(*[(i, t, "s") for i, t in rows])).collect()
    assert {(152, 152), (152, 302)} <= {(r.first_word, r.other_first) if r.doc_id == 0 else (r.other_first, r.first_word) for r in found}


def test_a_task_holds_few_texts_at_once(spark, documents, prose):
    text = prose(7, 1000).encode()
    many = [text] * (6_000_000 // len(text))
    next(shingles.word_hashes([text]))  # the powers are made once
    tracemalloc.start()
    assert sum(len(w) for w in shingles.word_hashes(many)) == 1000 * len(many)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 40 << 20, held  # 2 MB of text at once took more
    passages.repeated_passages(documents((0, text.decode(), "s")))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12))
def test_equal_words_between(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert passages._equal_between(a, b) == best[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(2**64 - 4, 2**64 - 1), st.integers(2**40, 2**40 + 2)), max_size=40))
def test_numbers_in_order(values):
    numbers = np.array(values, np.uint64)
    assert passages._in_order(numbers).tolist() == np.argsort(numbers, kind="stable").tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.integers(2, 30))
def test_winnowed_places(values, window):
    found = np.array(values, np.uint64)
    starts = range(max(1, len(values) - window + 1)) if values else ()
    assert passages.winnowed(found, window).tolist() == sorted({s + values[s : s + window].index(min(values[s : s + window])) for s in starts})


def _excerpts(n, seed):
    """Excerpts of one text in words of their own, one word in seven replaced, and which pairs share 50 words that are equal enough."""
    rng = random.Random(seed)
    source = [f"s{i}" for i in range(500)]
    rows, kept = [], []
    for d in range(n):
        size = rng.randint(54, 64)
        start = rng.randrange(len(source) - size)
        changed = set(rng.sample(range(start, start + size), size // 7))
        words = [f"x{d}y{i}" if i in changed else source[i] for i in range(start, start + size)]
        around = [[f"r{d}a{side}b{i}" for i in range(rng.randint(5, 40))] for side in (0, 1)]
        rows.append((d, " ".join(around[0] + words + around[1])))
        kept.append((len(around[0]), start, start + size, changed))
    pairs = set()
    for i, (_, a, b, x) in enumerate(kept):
        for j, (_, c, e, y) in enumerate(kept[:i]):
            low, high = max(a, c), min(b, e)
            if high - low >= 52 and sum(w not in x and w not in y for w in range(low, high)) >= 0.8 * (high - low):
                pairs.add((j, i))
    return rows, pairs


def test_changed_passages_with_many_holders(spark):
    """Seeds of one passage have other holders each: none of the first and previous ones may share enough of them."""
    rows, pairs = _excerpts(150, 3)
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    linked = {r.doc_id for r in found} | {r.other_doc_id for r in found}
    assert {d for p in pairs for d in p} <= linked


def test_every_holder_is_asked(spark, monkeypatch):
    """With blocks of few seeds and many rounds the pairs are the same, and all that share enough are among the rows."""
    rows, pairs = _excerpts(80, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    whole = Counter(tuple(r) for r in passages.repeated_passages(df).collect())
    for name, value in (("_ASKED_LINKS", 50), ("_HELD_SEEDS", 40), ("_SLICE_TEXTS", 25)):
        monkeypatch.setattr(passages, name, value)
    assert Counter(tuple(r) for r in passages.repeated_passages(df).collect()) == whole
    linked = {d for r in whole for d in (r[0], r[3])}
    assert {d for p in pairs for d in p} <= linked
