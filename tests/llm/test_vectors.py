"""Search, mining and whitening of vectors against plain Python, with nulls, ties, repeated rows and empty tables."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from fieldledger.llm import hard_negatives, topk_search, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, `a.b` string, id long, cell int, kind int, tag int, x string, vec string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    hot = [rng.uniform(-0.3, 0.4) for _ in range(12)]
    out = []
    for i in range(400):
        v = [rng.choice([0.0, rng.uniform(-0.3, 0.4)]) for _ in range(12)]
        if i % 3 == 0:
            v = list(hot)  # one vector in a third of all rows: ties
        out.append((i, [float(np.float32(a)) for a in v], 2 if i % 3 == 1 else rng.randrange(5)))
    out += [(500, None, 1), (550, [1.0, None] + [0.0] * 10, 1), (600, [math.nan] * 12, 1), (650, [math.inf] * 12, 2)]
    out += [(700, out[7][1], None), (None, out[8][1], 3), (750, [], 3), (800, [0.5, 0.25], 1), (850, [0.0] * 12, 4)]
    out += [out[50], out[50], out[31], (100, out[5][1], 3), (-50, out[9][1], 2), (-7, out[10][1], 2)]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, 3, 4, "x", "v") for r in rows], SCHEMA).repartition(3)


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks so small that one query and one row meet many."""

    def grid(queries, rows):
        return vectors.plan_grid(queries, rows, query_values=40, row_values=500)

    monkeypatch.setattr(topk_search, "plan_grid", grid)
    monkeypatch.setattr(hard_negatives, "plan_grid", grid)


def usable(rows, scale=256):
    out = []
    for i, v, label in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, tuple(math.floor(scale * x) for x in v), label))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def expected_top(rows, k=5):
    own = usable(rows)
    out = Counter()
    for i, v in {(i, v) for i, v, _ in own if i % 50 == 0}:
        ranked = sorted((-dot(v, w), j) for j, w, _ in own if j != i)[:k]
        out.update((i, rank, j, -s) for rank, (s, j) in enumerate(ranked, 1))
    return out


def expected_negatives(rows):
    own = [r for r in usable(rows) if r[2] is not None]
    out = Counter()
    for i, v, label in {r for r in own if r[0] % 50 == 0}:
        ranked = sorted((-dot(v, w), j, other) for j, w, other in own if j != i)
        for p, j, _ in [r for r in ranked if r[2] == label][:5]:
            fits = [r for r in ranked if r[2] != label and 50 * -p <= 100 * -r[0] <= 95 * -p][:3]
            out.update((i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1))
    return out


def result(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("small", [False, True])
def test_top_k(request, table, rows, small):
    if small:
        request.getfixturevalue("small_blocks")
    assert result(topk_search.top_k(table)) == expected_top(rows)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(request, table, rows, small):
    if small:
        request.getfixturevalue("small_blocks")
    got = result(hard_negatives.hard_negatives(table))
    assert got == expected_negatives(rows)
    assert any(p == 0 for *_, p, _ in got) or len(got) > 50


def test_zero_scores_and_small_groups(spark):
    rows = [(0, [0.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.1], 0), (3, [0.1, 0.2], 0), (50, [-1.0, 0.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(hard_negatives.hard_negatives(table)) == expected_negatives(rows)
    assert result(hard_negatives.hard_negatives(table)) >= Counter([(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)])
    assert result(topk_search.top_k(table)) == expected_top(rows)


def test_windows_without_overflow():
    for score in (*range(-250, 250), 10**16 + 7, -(10**16) - 3):
        low, high = hard_negatives.window(score, 50, 95)
        assert (low, high) == (-((-50 * score) // 100), 95 * score // 100)


def test_scores_too_large(spark):
    big = spark.createDataFrame([(0, [4e9]), (1, [4e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit in a long"):
        topk_search.top_k(big).collect()
    with pytest.raises(Exception, match="too large"):
        topk_search.top_k(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")).collect()


def test_accumulation_equals_products():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-3, 4, (7, 5)), rng.integers(-3, 4, (300, 5))
    assert (topk_search.accumulate(a, b) == a @ b.T).all()
    assert (vectors.inner_products(a, b) == a @ b.T).all()
    assert (vectors.inner_products(a * (1 << 26), b * (1 << 26)) == (a * (1 << 26)) @ (b.T * (1 << 26))).all()


@pytest.mark.parametrize("kind", ["none", "no vector", "no query"])
def test_empty(spark, kind):
    rows = {"none": [], "no vector": [(0, None, 1)], "no query": [(1, [1.0], 1), (2, [1.0], 2)]}[kind]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert topk_search.top_k(table).collect() == []
    assert hard_negatives.hard_negatives(table).collect() == []
    if kind != "no query":
        assert whitening.whiten(table).collect() == []


def whitened(table, **options):
    got = whitening.whiten(table, **options).collect()
    return got, {(r["vec_id"], r["component"]): r["whitened"] for r in got}


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(2)
    v = rng.standard_normal((700, 40)) * np.linspace(0.05, 0.5, 40) @ np.linalg.qr(rng.standard_normal((40, 40)))[0]
    return np.concatenate([v, v[:5], np.repeat(v[:1], 300, axis=0)])


def test_whitening(spark, cloud):
    rows = [(i, [float(a) for a in v], "t", 1) for i, v in enumerate(cloud)]
    rows += [(5000, None, "t", 1), (5001, [math.nan] * 40, "t", 1), (5002, [None] * 40, "t", 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, id long").repartition(5)
    got, by = whitened(table)
    x = np.floor(64 * cloud).astype(np.int64) + 1_000_000
    n, d = x.shape
    off = n * x - x.sum(axis=0)
    y = off / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == 32 * n and {r["n"] for r in got} == {n}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == {i: sum(int(a) ** 2 for a in off[i]) for i in range(n)}
    w = np.array([[by[i, c + 1] for c in range(32)] for i in range(n)])
    want = y @ u[:, :32] / np.sqrt(e[:32])
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w * sign - want).max() < 1e-9
    assert np.abs(w.T @ w / n - np.eye(32)).max() < 1e-10
    assert got[0]["identity_error"] < 1e-10
    explained = {r["component"]: r["explained"] for r in got}
    assert np.allclose([explained[c + 1] for c in range(32)], e[:32] / np.trace(cov), rtol=1e-10)


def test_whitening_far_from_zero_and_flat(spark, cloud):
    """A mean 10^9 times the spread costs no digits; dimensions and components without variance give no rows."""
    flat = cloud[:300, :6].copy()
    flat[:, 2] = 0.25
    flat[:, 5] = flat[:, 0]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(flat)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, by = whitened(table, offset=10**10)
    near, by_near = whitened(table, offset=0)
    ranks = {r["component"] for r in got}
    x = np.floor(64 * flat)
    assert ranks == set(range(1, np.linalg.matrix_rank(x - x.mean(axis=0)) + 1))
    assert all(abs(abs(by[k]) - abs(by_near[k])) < 1e-9 for k in by)
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(r["vec_id"], r["deviation"]) for r in near}


def test_whitening_deviation_beyond_a_long(spark):
    center = whitening.Center(10**10, (3 * 10**10 + 1, -5))
    got = center.deviations(np.array([[4, 0], [10**6, 7]])).to_pylist()
    want = [(10**10 * a - 3 * 10**10 - 1) ** 2 + (10**10 * b + 5) ** 2 for a, b in [(4, 0), (10**6, 7)]]
    assert [int(g) for g in got] == want


def test_whitening_of_few(spark):
    schema = "vec_id long, embedding array<double>"
    same = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [])], schema)).collect() == []
    with pytest.raises(ValueError, match="one length"):
        whitening.whiten(spark.createDataFrame([(1, [0.5]), (2, [0.5, 1.0])], schema))
    two, by = whitened(spark.createDataFrame([(None, [0.0, 1.0]), (2, [1.0, 0.0])], schema))
    assert sorted((r["vec_id"] is None, r["component"], abs(round(r["whitened"], 9))) for r in two) == [(False, 1, 1.0), (True, 1, 1.0)]


def test_jacobi_davidson_of_a_larger_operator():
    """A spectrum of 300 numbers with close pairs: the subspace is cut back, pairs are locked one after the other."""
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    e = np.sort(np.concatenate([rng.random(298), [1.5, 1.5 + 1e-6]]))[::-1]
    a = (q * e) @ q.T
    values, vectors_ = whitening.jacobi_davidson(lambda b: a @ b, 300, 8)
    assert np.abs(values - e[:8]).max() < 1e-13
    assert np.abs(a @ vectors_ - vectors_ * values).max() < 1e-13
    assert np.abs(vectors_.T @ vectors_ - np.eye(8)).max() < 1e-13
