"""Whitening against an eigendecomposition in one piece."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from shelfmend.llm import queries, whitening


@pytest.fixture(scope="module")
def table(spark):
    def make(rows, extra="x string, n string, component string, vector string, deviation string"):
        names = [c.split()[0] for c in extra.split(", ")]
        return spark.createDataFrame([(i, v, *names) for i, v in rows], f"vec_id long, embedding array<double>, {extra}")

    return make


def expected(rows, scale=256):
    """Per row the whitened values of a dense SVD, the exact deviations, and shares of the variance."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    x = [[*(int(np.floor(scale * c)) for c in v), *[0] * (width - len(v))] for _, v in kept]
    fit = [list(v) for v in sorted(set(map(tuple, x)))]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    _, singular, right = np.linalg.svd(centred, full_matrices=False)
    mean = np.array([s / n for s in sums])
    whitened = (np.array(x, float) - mean) @ right[:4].T / (singular[:4] / np.sqrt(n))
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    return [i for i, _ in kept], n, whitened, deviations, (singular**2 / (singular**2).sum())[:4]


def compare(df, rows, tolerance=1e-9):
    ids, n, whitened, deviations, shares = expected(rows)
    found = df.collect()
    k = max(r.component for r in found)
    assert len(found) == len(ids) * k and {r.n for r in found} == {n}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error <= 1e-10
    by = {}
    for r in found:
        by.setdefault(r.vec_id, {})[r.component] = r
    order = [ids.index(i) for i in by]
    for c in range(1, k + 1):
        got = np.array([by[i][c].whitened for i in by])
        want = whitened[order, c - 1]
        want = want * np.sign(want @ got)
        assert np.abs(got - want).max() < tolerance * max(1, np.abs(want).max())
        assert all(abs(by[i][c].explained - shares[c - 1]) < 1e-10 for i in by)
    assert {i: d if d < 1 << 63 else None for i, d in zip(ids, deviations, strict=True)} == {i: by[i][1].deviation for i in by}


def test_rows_of_very_different_variance(table):
    rng = np.random.default_rng(1)
    mixing = np.linalg.qr(rng.normal(size=(12, 12)))[0] * np.logspace(4, -1, 12)
    rows = [(i, (rng.normal(size=12) @ mixing.T + 50).tolist()) for i in range(400)]
    compare(whitening.whiten(table(rows)), rows)


def test_small_variance_beside_a_large_one(table):
    """The condition of the rows' covariance is beyond double precision; the rows' own is not."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(rng.integers(-(2**40), 2**40)), float(rng.integers(-4, 5)), float(rng.integers(-2, 3))]) for i in range(300)]
    compare(whitening.whiten(table(rows), components=3, scale=256.0), rows, 1e-6)


def test_odd_rows(table):
    rng = np.random.default_rng(3)
    base = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    left_out = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    # equal vectors weigh once in the fit; a shorter one ends in zeros; -0.0 and 0.0 are the same
    more = [*[(200 + i, base[0][1]) for i in range(30)], (300, [0.25, -0.5]), (301, [0.0, -0.0, 0.0, 0.0, 0.0]), (302, [-0.0, 0.0, 0.0, 0.0, 0.0])]
    compare(whitening.whiten(table([*base, *left_out, *more])), [*base, *left_out, *more])
    keyless = whitening.whiten(table([*base, (None, base[1][1])])).filter("vec_id IS NULL")
    assert keyless.count() == 4


def test_rank_below_the_width(table):
    rng = np.random.default_rng(4)
    plane = rng.integers(-9, 10, size=(2, 6))
    rows = [(i, (rng.integers(-50, 51, size=2) @ plane / 256.0).tolist()) for i in range(60)]
    found = whitening.whiten(table(rows))
    assert found.filter("component > 2 AND whitened IS NOT NULL").count() == 0
    compare(found.filter("component <= 2"), rows)


def test_no_variance_and_no_rows(table):
    found = whitening.whiten(table([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in found] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)] * 2
    assert whitening.whiten(table([(1, None)])).collect() == []
    assert whitening.whiten(table([(1, [])])).collect() == []


def test_numbers_beyond_64_bits(table):
    found = whitening.whiten(table([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])).collect()
    # the third row's numbers are small: S is what the nearest 64-bit numbers of the other two differ by
    assert {(r.vec_id, r.deviation) for r in found} == {(1, None), (2, None), (3, (1024**2) + (3 * 512 - 768) ** 2)}
    # beside them the second component is rounding
    assert all(np.isfinite(r.whitened) if r.component == 1 else r.whitened is None for r in found)


def test_result_does_not_depend_on_the_layout(table):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    one, many = (sorted(whitening.whiten(table(rows).repartition(p)).collect()) for p in (1, 13))
    for a, b in zip(one, many, strict=True):
        assert a[:4] == b[:4] and a.whitened == pytest.approx(b.whitened, abs=1e-12)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{folder}/embeddings.parquet").to_pylist()]
    compare(queries.QUERIES["op13_whitening"](spark, folder), rows)
