"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from shelfmend.llm import spelling
from shelfmend.llm.spelling import BitSlices


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=7, every=31, times=10):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    out, forms = {}, {}
    for w in n:
        near = sorted((b for b in n if one_apart(w, b)), key=lambda b: (-n[b], b))
        forms[w] = near[0] if near and n[near[0]] >= times * n[w] else None
        out[w] = (forms[w], n[w], len(near))
    found = set()
    for w, (form, k, near) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        found.add((w, form, root, k, near, n[form] if form else None))
    return found


def rows_of(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, docs=60):
    """Words of two letters, many of them one apart, with very different frequencies."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 11))) for _ in range(25)]
    out = []
    for i in range(docs):
        words = []
        for _ in range(60):
            w = stems[min(int(rng.expovariate(0.3)), 24)]
            if rng.random() < 0.15:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "b" + w[at], "É"]) + w[at + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice([" ", "\n", "1", "-"]).join(words), "x"))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_are_those_of_all_pairs(documents, seed):
    rows = texts(seed)
    found = rows_of(spelling.variants(documents(*rows), every=5))
    assert found == brute([r[:2] for r in rows], every=5) and any(f for _, f, *_ in found)


def test_chains_end_in_one_root(documents):
    rows = [(0, "spellinga " * 2000 + "spellingab " * 200 + "spellingabc " * 20 + "spellingabcd " * 2, "x")]
    found = {r[0]: r for r in rows_of(spelling.variants(documents(*rows), every=0))}
    assert found["spellingabcd"] == ("spellingabcd", "spellingabc", "spellinga", 2, 1, 20)
    assert found["spellinga"] == ("spellinga", None, "spellinga", 2000, 1, None)


def test_odd_rows(documents):
    long = "abcdefgh" * 2500
    rows = [
        (None, "Grundstück grundstück", "x"), (1, None, "x"), (2, "", None), (3, f"{long} {long} {long}x {long}x", "x"),
        (4, "same words same words", "x"), (4, "same words same words", "x"), (5, "x" * 7 + " " + "x" * 7, "x"),
    ]
    found = spelling.variants(documents(*rows), every=31)
    assert rows_of(found) == brute([r[:2] for r in rows]) and found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelling.variants(documents(*rows).filter("doc_id = 99")).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(documents(*rows), times=1)


def test_ties_go_to_the_first_word(documents):
    rows = [(0, "warehouse " * 20 + "warehousé " * 20 + "warehous " * 2, "x")]
    found = {r[0]: r[1] for r in rows_of(spelling.variants(documents(*rows), every=0))}
    assert found["warehous"] == "warehouse"


@pytest.mark.parametrize("most_words", [2, 5, 4096])
def test_large_blocks_are_halved(spark, most_words):
    """Any limit gives the same pairs; one block of all words would be a hot key."""
    rng = random.Random(7)
    words = sorted({"prefix" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) + "suffix" for _ in range(200)})
    vocabulary = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    found = {tuple(r) for r in spelling.near_words(vocabulary, 1, most_words).collect()}
    n = {w: i + 2 for i, w in enumerate(words)}
    expected = set()
    for w in words:
        near = sorted((b for b in words if one_apart(w, b)), key=lambda b: (-n[b], b))
        if near:
            expected.add((w, len(near), near[0], n[near[0]]))
    assert found == expected
    sizes = spelling.blocks(vocabulary, 1, most_words).filter("length - first - last > 1").groupBy("key").count()
    assert sizes.filter(f"count > {most_words}").count() == 0


def test_sets_at_every_split():
    """A pair is found in exactly one block, however far blocks are halved."""
    rng = random.Random(1)

    def pairs(words, length, first, last, depth):
        room = length - first - last
        if depth == 0 or room <= 1:
            groups = {}
            for w in words:
                groups.setdefault((w[:first], w[len(w) - last :]), []).append(w)
            for found in groups.values():
                slices = BitSlices(found, length, first, last)
                yield from ((w, x) for w in found for i, x in enumerate(found) if slices.near(w) >> i & 1)
            return
        yield from pairs(words, length, first + room // 2, last, depth - 1)
        yield from pairs(words, length, first, length - first - room // 2, depth - 1)

    for depth in (1, 2, 3, 6):
        for _ in range(50):
            words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(40)})
            found = [p for n in range(1, 10) for p in pairs([w for w in words if len(w) in (n, n + 1)], n, 0, 0, depth)]
            assert sorted(found) == sorted((a, b) for a in words for b in words if one_apart(a, b))
