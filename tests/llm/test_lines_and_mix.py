"""Line spread, host lines and mixing against brute force, on odd rows."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmend.llm import host_lines, line_spread, mixing


def odd_documents(prose):
    rows = [(i, f"{prose(i, 30)}\nSHARED  boiler plate line\n{prose(i + 500, 10)}", f"site{i % 14}") for i in range(60)]
    rows += [(100 + i, f"{prose(700, 40)}\n{prose(701, 20)}", f"site{i % 14}") for i in range(30)]  # a copy everywhere
    rows += [(200, None, "site1"), (201, "", None), (202, " \n\n\t", None), (203, "shared  boiler plate line", "site0")]
    rows += [(204, prose(900, 50) + "\nonly null site", None), (None, prose(901, 30), None), (205, "x" * 20000, "site2")]
    rows += [(206, f"{prose(902, 30)}\nshared  boiler plate line \nEnd", "site3")] * 3  # equal rows
    return rows


def test_spread_lines_are_cut(documents, prose):
    docs = documents(*odd_documents(prose))
    cut = line_spread.remove_spread_lines(docs, sites=10, report=True)
    rows = cut.collect()
    assert len(rows) == len(odd_documents(prose))
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert all("boiler plate" not in by_id[i][0].text and by_id[i][0].lines_removed == 1 for i in range(60))
    assert by_id[5][0].text == f"{prose(5, 30)}\n{prose(505, 10)}"
    assert all(r.lines_removed == 0 and r.text for i in range(100, 130) for r in by_id[i])  # copies stay whole
    assert by_id[200][0].text is None and by_id[201][0].text == "" and by_id[202][0].text == " \n\n\t"
    assert (by_id[203][0].text, by_id[203][0].lines_removed) == ("", 1)  # a text of nothing else
    assert [r.text for r in by_id[206]] == [f"{prose(902, 30)}\nEnd"] * 3
    assert by_id[5][0].size == "b" and by_id[None][0].text == prose(901, 30)
    assert line_spread.remove_spread_lines(docs.limit(0)).count() == 0


def test_pages_that_are_mostly_boilerplate_are_cut(documents, prose):
    rows = [(i, f"{prose(i, 3)}\nshared boiler plate line that is long", f"site{i}") for i in range(12)]
    cut = line_spread.remove_spread_lines(documents(*rows), report=True).collect()
    assert {r.doc_id: r.text for r in cut} == {i: prose(i, 3) for i in range(12)} and all(r.lines_removed == 1 for r in cut)


def test_only_copies_are_spared(documents, prose):
    line = "shared boiler plate line that is long"
    rows = [(i, f"{prose(i, 3)}\n{line}", f"site{i}") for i in range(12)]
    rows += [(50, f"{prose(50, 3)}\n{line}", "site1"), (51, f"{prose(50, 3)}\n{line}", "site2")]  # two copies of a page
    rows += [(60, f"{prose(60, 90)}\n{line}", "site1"), (61, f"{prose(60, 90)}\n{line}", "site2")]  # that lose little
    rows += [(70, f"{prose(70, 3)}\n{line}", "site1")] * 2  # one row twice is no copy
    found = line_spread.remove_spread_lines(documents(*rows)).collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted((i, t if i in (50, 51) else t.split("\n")[0]) for i, t, _ in rows)
    always = line_spread.remove_spread_lines(documents(*rows), most_lost=1.0).collect()
    assert all(line not in r.text for r in always)


@pytest.mark.parametrize("sites", [2, 9, 10, 11, 25, 60])
def test_threshold_is_exact(spark, sites):
    rows = [(i, f"line {n}", f"s{i % n}") for n in (1, 2, 8, 9, 10, 11, 12, 24, 25, 26, 60) for i in range(2 * n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = line_spread.spread_lines(line_spread.lines(docs), sites)
    counts = defaultdict(set)
    for _, t, s in rows:
        counts[t].add(s)
    assert found.count() == sum(len(s) >= sites for s in counts.values())


def test_spread_plan_is_native(documents):
    plan = line_spread.remove_spread_lines(documents((1, "a", "b")))._jdf.queryExecution().toString()
    assert "hll_sketch_agg" in plan and not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc \n", max_size=60), max_size=4))
def test_repeated_words(texts):
    documents = [t.encode().split() for t in texts]
    expected = []
    for words in documents:
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        n = Counter(windows)
        expected.append(len({i + o for i, w in enumerate(windows) if n[w] > 1 for o in range(5)}))
    assert host_lines.repeated_words(documents).tolist() == expected


def brute_verdicts(rows, least, share):
    hosts, line_docs = defaultdict(set), defaultdict(set)

    def lines(t):
        return [x for x in ((t or "").encode().split(b"\n")) if x.split()]

    for _, t, s in rows:
        hosts[s].add(t or "")
        for x in lines(t):
            line_docs[s, host_lines.normalised(x)].add(t or "")
    out = []
    for i, t, s in rows:
        words = (t or "").encode().split()
        lost = sum(
            len(x.split()) for x in lines(t)
            if len(line_docs[s, host_lines.normalised(x)]) > least and len(line_docs[s, host_lines.normalised(x)]) > share * len(hosts[s])
        )
        full = lines(t)
        windows = [tuple(words[j : j + 5]) for j in range(len(words) - 4)]
        n = Counter(windows)
        repeated = len({j + o for j, w in enumerate(windows) if n[w] > 1 for o in range(5)})
        failed = len(words) < 10 or 100 * repeated > 20 * len(words)
        symbols = sum((t or "").count(c) for c in "#*$%&|<>")
        chars = sum(len(w.decode()) for w in words)
        out.append((i, s, len(words), chars, symbols, len(full) - len(set(full)), repeated, lost, failed, not failed and lost <= 0.5 * len(words)))
    return out


def test_verdicts_equal_brute_force(documents, prose):
    rows = odd_documents(prose)
    rows += [(300 + i, f"Menu home about\nmenu HOME   about contact us now please read our terms and conditions today\n{i} é漢 a b|c", "host") for i in range(40)]
    rows += [(400 + i, " ".join(["one two three four five six seven"] * 4), "host") for i in range(3)]
    found = host_lines.verdicts(documents(*rows), least=5, share=0.1)
    columns = ("doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept")
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == Counter(brute_verdicts(rows, 5, 0.1))


def test_clean_keeps_columns_and_cuts_lines(documents, prose):
    rows = [(i, f"{prose(i, 40)}\nNAV home  login\n{prose(i + 300, 20)}", "h") for i in range(60)]
    rows += [(100, "too short", "h"), (101, None, "h"), (102, "nav home login\n" * 30, "h")]
    rows += [(103, prose(999, 60), None), (103, prose(999, 60), None)]
    docs = documents(*rows)
    out = host_lines.clean(docs, least=20)
    assert out.columns == docs.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert set(kept) == {*range(60), 103} and out.count() == 62
    assert kept[7].text == f"{prose(7, 40)}\n{prose(307, 20)}" and kept[7].node == "e"
    assert host_lines.clean(docs.limit(0)).count() == 0


def sainte_lague(claims, n):
    seats = [0] * len(claims)
    for _ in range(n):
        best = max(range(len(claims)), key=lambda i: (claims[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return seats


@pytest.mark.parametrize("seed", range(4))
def test_seats(spark, seed):
    rng = random.Random(seed)
    claims = [rng.choice([0.0, 5.0, rng.random() * 1000, 40.0]) for _ in range(rng.randint(1, 12))]
    rows = [(f"s{i:02}", 0, c) for i, c in enumerate(claims)]
    parties = spark.createDataFrame(rows, "source string, shard long, claim double")
    got = {r.source: r.seats for r in mixing.seats(parties, 10).collect()}
    assert [got[f"s{i:02}"] for i in range(len(claims))] == sainte_lague(claims, round(sum(claims) / 10))


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 90), ("d", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # weights a 1, b 2, c 3, d 1, null 2; a, d and null stop at three times their size, b and c share 1300 by 2 and 3
    assert got == {"a": 30.0, "d": 0.0, None: 270.0, "b": 520.0, "c": 780.0}


def test_mix(documents, prose):
    rows = [(i, prose(i, 5 + i % 40), f"s{i % 5}") for i in range(400)]
    rows += [(1000, None, "s1"), (1001, "", None), (1002, "two words", None), (1003, "  ", "empty"), (None, "no key", "s2")]
    rows += [(1004, "same row here", "s3")] * 4
    docs = documents(*rows)
    found = mixing.mix(docs, block_words=8, shard_words=600).collect()
    assert len(found) == len(rows)
    taken, target, size = Counter(), {}, Counter()
    for r in found:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.passes * r.size + sum(s.after - s.first for s in r.spans)
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        assert r.target <= 3 * r.source_size
    assert all(size[s] == next(r.source_size for r in found if r.source == s) for s in size)
    for s, t in target.items():
        shards = -(-size[s] // 600) + 1
        assert abs(taken[s] - t) <= 8 * shards
    again = mixing.mix(docs, block_words=8, shard_words=600).collect()
    assert Counter(map(str, found)) == Counter(map(str, again))


def test_apply_mix(documents, prose):
    rows = [(i, prose(i, 20 + i % 9), f"s{i % 3}") for i in range(50)] + [(60, "same row here", "s0")] * 3 + [(61, None, "s1")]
    docs = documents(*rows)
    mixed = mixing.mix(docs)
    out = mixing.apply_mix(docs, mixed)
    assert out.columns == docs.columns
    words = Counter()
    whole = {i: t for i, t, _ in rows}
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.text in whole[r.doc_id]
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += r.taken
    assert words == +taken
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_plan_is_native(documents):
    plan = mixing.mix(documents((1, "a b", "c")))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian"))
