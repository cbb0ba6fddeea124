"""Whitening against dense linear algebra."""

import numpy as np
import pytest

from tessera.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def spectra():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield "random", np.cov(rng.standard_normal((300, 40)).T)
    yield "one axis", np.array([[3.0]])
    yield "repeated", turn @ np.diag([5.0] * 3 + [2.0] * 20 + [1.0] * 17) @ turn.T
    yield "identity", np.eye(24)
    yield "falling", turn @ np.diag(2.0 ** -np.arange(40)) @ turn.T
    yield "one large", np.diag([1e9] + [1.0] * 30)
    yield "deficient", np.cov(rng.standard_normal((6, 40)).T)
    yield "close", turn @ np.diag([1 + 1e-9 * i for i in range(40)]) @ turn.T


@pytest.mark.parametrize("name,v", list(spectra()), ids=[n for n, _ in spectra()])
def test_components(name, v):
    e, q = whitening.components(v, 16)
    want = np.linalg.eigvalsh(v)[::-1]
    want = want[want > 1e-12 * want[0]][:16]
    assert len(e) == len(want)
    assert np.allclose(e, want, rtol=1e-12, atol=1e-13 * want[0])
    assert np.abs(q.T @ q - np.eye(len(e))).max() < 1e-13
    assert np.abs(v @ q - q * e).max() < 1e-13 * want[0]


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 17):
        for _ in range(40):
            a = rng.integers(-3, 4, (d, d)).astype(float)
            a = a + a.T
            e = np.linalg.eigvalsh(a)
            for s in (-0.31, 0.17, 2.59):
                if np.abs(e - s).min() > 1e-9:
                    assert whitening.above(whitening.tridiagonal(a), s) == (e > s).sum()
    assert whitening.above(whitening.tridiagonal(np.array([[0.0, 1.0], [1.0, 0.0]])), 0.0) == 1
    assert whitening.above(whitening.tridiagonal(np.zeros((3, 3))), 0.0) == 0


def test_no_component_is_taken_twice_or_missed():
    v = np.diag(np.arange(1.0, 41.0))
    found = whitening.slices(v, 16)
    assert sum(n for *_, n in found) >= 16 and found == sorted(found, reverse=True)
    for low, high, n in found:
        e, _ = whitening.interval(v, low, high, n, 0)
        assert len(e) == n and ((e > low) & (e <= high)).all()
    with pytest.raises(ArithmeticError):
        whitening.interval(v, *found[0][:2], found[0][2] + 1, 0)


def table(spark, n=900, d=20):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((n, d)) * rng.uniform(0.2, 2, d)
    x[n // 2 : n // 2 + n // 3] = x[3]  # a third are one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(n, None), (n + 1, []), (n + 2, [None] * d), (n + 3, [NAN] * d), (n + 4, [INF] * d), (n + 5, [1.0, 2.0])]
    more = [(None, x[0].tolist()), (0, x[1].tolist()), (n + 6, [0.0] * d)]
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows + odd + more], "vec_id bigint, embedding array<double>, X string, n int, whitened double")
    return [(i, v) for i, v in rows + more], df.repartition(3)


def test_whitening(spark):
    rows, df = table(spark)
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    fixed = whitening.fixed_point(df)
    got = whitening.whiten(fixed, whitening.fit(fixed)).collect()
    assert len(got) == 16 * len(rows)
    want = {}
    for (i, _), row in zip(rows, x):
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))
        for k, w in enumerate(np.abs((row - s / n) @ q / np.sqrt(e))):
            want.setdefault((i, k + 1), []).append((deviation, w))
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert any(r.deviation == d and abs(abs(r.whitened) - w) < 1e-9 for d, w in want[r.vec_id, r.component])
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12
    signs = {}
    for r in got:  # one sign for all rows of a component
        if r.vec_id and r.vec_id < 900:
            w = ((x[r.vec_id] - s / n) @ q[:, r.component - 1]) / np.sqrt(e[r.component - 1])
            if abs(w) > 1e-3:
                signs.setdefault(r.component, set()).add(bool(np.sign(w) == np.sign(r.whitened)))
    assert all(len(v) == 1 for v in signs.values())


def test_few_and_large_vectors(spark):
    def run(rows):
        fixed = whitening.fixed_point(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
        return whitening.whiten(fixed, whitening.fit(fixed)).orderBy("vec_id", "component").collect()

    assert run([]) == []
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance
    got = run([(1, [0.0, 0.0]), (2, [1.0, 1.0])])
    assert [(r.vec_id, r.component, r.n, int(r.deviation), abs(round(r.whitened, 9)), round(r.explained, 9)) for r in got] == [(1, 1, 2, 8192, 1.0, 1.0), (2, 1, 2, 8192, 1.0, 1.0)]
    big = run([(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 2.0])])
    assert int(big[0].deviation) == (3 * 64 * 10**12) ** 2 + 192**2 and len(big) in (3, 6)


def test_query(spark):
    got = queries.op13_whitening(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert got.count() == 16 * 500 and got.filter("deviation is null or identity_error > 1e-4").count() == 0
