"""Vector searches against brute force."""

import numpy as np
import pytest

from tessera.llm import ann, exact_search, vectors

NAN, INF = float("nan"), float("inf")


def table(spark, n=700, dim=16, seed=1):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    x[n // 2 : n // 2 + n // 3] = x[3]  # a third are one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(n, None), (n + 1, []), (n + 2, [None] * dim), (n + 3, [NAN] * dim), (n + 4, [INF] * dim), (None, x[0].tolist()), (n + 5, [0.0] * dim), (n + 50, [1.0, 2.0])]
    return x, spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id bigint, embedding array<double>, shard string, dim int")


@pytest.mark.parametrize("shard", [60, 4096])
def test_exact_search(spark, monkeypatch, shard):
    monkeypatch.setattr(exact_search, "SHARD", shard)
    monkeypatch.setattr(exact_search, "QUERIES", 6)
    x, df = table(spark)
    rows = vectors.valid(df)
    got = {}
    for r in sorted(exact_search.search(rows, rows.filter("vec_id % 50 = 0"), 5, 256.0).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    ids = np.append(np.arange(len(x)), len(x) + 5)
    whole = np.floor(256 * np.vstack([x, np.zeros(x.shape[1])])).astype(np.int64)
    for q in range(0, len(x), 50):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:5]
        assert got[q] == [(int(ids[i]), int(scores[i])) for i in order]
    assert set(got) == set(range(0, len(x), 50))  # the only vector of another dimension has no candidates


def test_exact_search_of_large_numbers(spark):
    big = [(0, [1e15, 1.0]), (1, [1e15, 2.0]), (2, [3.0, 4.0])]
    rows = vectors.valid(spark.createDataFrame(big, "vec_id bigint, embedding array<double>"))
    got = {(r.query_id, r.vec_id): r.score for r in exact_search.search(rows, rows.filter("vec_id = 2"), 5, 1.0).collect()}
    assert got == {(2, 0): 3 * 10**15 + 4, (2, 1): 3 * 10**15 + 8}
    assert exact_search.search(rows.limit(0), rows.limit(0), 5, 1.0).count() == 0


def test_approximate_search(spark, monkeypatch):
    for name, value in (("LIST", 40), ("SHARD", 64), ("QUERIES", 4), ("ROWS", 32)):
        monkeypatch.setattr(ann, name, value)
    x, df = table(spark, 900, 32)
    rows = vectors.valid(df, zero=False)
    got = {}
    for r in sorted(ann.search(rows, rows.filter("vec_id % 20 = 0"), 10).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = 0
    for q in range(0, len(x), 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        assert len(got[q]) == 10 and got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
        assert np.allclose([s for _, s in got[q]], [d[i] for i, _ in got[q]], rtol=1e-13, atol=1e-14)
        hit += len({i for i, _ in got[q]} & set(order))
    assert hit >= 0.9 * 10 * len(got)


def test_approximate_search_of_few(spark):
    rows = vectors.valid(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.5])], "vec_id bigint, embedding array<double>"))
    got = [tuple(r) for r in ann.search(rows, rows.filter("vec_id = 0"), 10).orderBy("rank").collect()]
    assert [(q, k, v) for q, k, v, _ in got] == [(0, 1, 2), (0, 2, 1)]
    assert ann.search(rows.limit(0), rows.limit(0), 10).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    """Of rows with one id only the query's own row is no candidate; each of them is a query."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((120, 8))
    ids = np.where(np.arange(120) % 3 == 0, 50, np.arange(120) + 1)  # a third share one id
    df = spark.createDataFrame([(int(i), v.tolist(), "x") for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>, VEC_ID string").repartition(3)
    rows = vectors.valid(df)
    assert rows.count() == 120
    whole = np.floor(256 * x).astype(np.int64)
    asked = np.flatnonzero(ids == 50)
    got = [(r["rank"], r.vec_id, r.score) for r in exact_search.search(rows, rows.filter("vec_id = 50"), 5, 256.0).collect()]
    near = [(r["rank"], r.vec_id, round(r.score, 9)) for r in ann.search(rows, rows.filter("vec_id = 50"), 10).collect()]
    want, close = [], []
    for q in asked:
        others = np.arange(120) != q
        scores, distance = whole[others] @ whole[q], np.sqrt(((x[others] - x[q]) ** 2).sum(1))
        want += [(k + 1, int(ids[others][i]), int(scores[i])) for k, i in enumerate(np.lexsort((ids[others], -scores))[:5])]
        close += [(k + 1, int(ids[others][i]), round(float(distance[i]), 9)) for k, i in enumerate(np.lexsort((ids[others], distance))[:10])]
    assert sorted(got) == sorted(want) and sorted(near) == sorted(close)  # so few vectors are one list
