"""Whitening against exact fractions and a dense eigensolver."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from labelgrain.llm.whitening import eigenvalues_above, leading_eigenpairs, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int, component string, n string, _id string"


def frame(spark, rows):
    """Embeddings of (id, vector), with columns whose names clash with those the operator uses or makes."""
    return spark.createDataFrame([(i, v, 1, "c", "n", "i") for i, v in rows], SCHEMA)


def symmetric(values, seed=0):
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


def test_counts_by_signs_of_pivots():
    rng = np.random.default_rng(1)
    for k in range(60):
        d = int(rng.integers(1, 25))
        a = rng.standard_normal((d, d))
        a += a.T
        if k % 2:
            np.fill_diagonal(a, 0)
        shift = float(rng.standard_normal())
        assert eigenvalues_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert eigenvalues_above(np.zeros((3, 3)), 0.0) == 0 and eigenvalues_above(np.zeros((3, 3)), -1.0) == 3


@pytest.mark.parametrize(
    "values",
    [[1 / k for k in range(1, 41)], [5, 5, 5, 3, 3 + 1e-13, 3, 2, 1, 0.5, 0.5], [1] * 12, [4, 3, 2, 0, 0, 0, 0, 0, 0, 0], [7], [1e30, 1, 1e-30], [2, 2 - 1e-9, 2 - 2e-9, 1]],
)
def test_leading_eigenpairs(values):
    m = symmetric(values)
    found, vectors = leading_eigenpairs(m, 8)
    expected = np.sort(values)[::-1][:8]
    scale = np.abs(m).sum(axis=1).max()
    assert len(found) == min(8, len(values))
    assert np.abs(found - expected).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() <= 1e-13
    assert np.abs(m @ vectors - vectors * found).max() <= 1e-12 * scale


def whole(vector):
    return [math.floor(1024 * c) + 100_000 for c in vector]


def checked(df, rows):
    """Compare all columns with exact sums and numpy's eigensolver over ``rows``, the rows that remain."""
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = [whole(v) for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    cov = [[float(sum((Fraction(v[i]) - Fraction(s[i], n)) * (Fraction(v[j]) - Fraction(s[j], n)) for v in x) / n) for j in range(d)] for i in range(d)]
    values, vectors = np.linalg.eigh(np.array(cov))
    values, vectors = values[::-1], vectors[:, ::-1]
    m = min(8, d)
    found = df.collect()
    assert len(found) == n * m
    deviations = sorted((repr(i), sum((n * v - t) ** 2 for v, t in zip(w, s, strict=True))) for (i, _), w in zip(rows, x, strict=True))
    for k in range(1, m + 1):
        own = [r for r in found if r.component == k]
        assert sorted((repr(r.vec_id), int(r.deviation)) for r in own) == deviations
        assert {r.n for r in own} == {n}
        assert all(abs(r.explained - values[k - 1] / values.sum()) <= 1e-12 for r in own)
        by_id = {}
        for (i, _), w in zip(rows, x, strict=True):
            by_id.setdefault(i, []).append(float(sum((a - b / n) * e for a, b, e in zip(w, s, vectors[:, k - 1], strict=True)) / math.sqrt(values[k - 1])))
        sign = None
        for r in sorted(own, key=lambda r: -abs(r.whitened)):
            expected = by_id[r.vec_id]
            if sign is None:
                sign = 1 if min(abs(r.whitened - e) for e in expected) < 1e-8 else -1
            assert min(abs(r.whitened - sign * e) for e in expected) < 1e-8
    assert {r.identity_error for r in found} <= {found[0].identity_error} and found[0].identity_error <= 1e-9


def vectors(seed, n, d):
    rnd = random.Random(seed)
    return [(i, [float(np.float32(rnd.gauss(k, 1 + k / 2))) for k in range(d)]) for i in range(n)]


def test_whiten_with_odd_rows(spark):
    rows = vectors(3, 150, 10)
    rows += [(None, rows[5][1]), (7, rows[9][1]), (7, rows[9][1])]
    odd = [(500, None), (501, [1.0] * 9 + [None]), (502, [float("nan")] + [0.0] * 9), (503, [0.0] * 9 + [float("-inf")]), (504, []), (505, [1.0, 2.0])]
    mixed = rows + odd
    random.Random(1).shuffle(mixed)
    checked(whiten(frame(spark, mixed).repartition(5)), rows)
    checked(whiten(frame(spark, rows).coalesce(1)), rows)


def test_whiten_of_few_places_and_large_entries(spark):
    checked(whiten(frame(spark, vectors(4, 40, 3))), vectors(4, 40, 3))
    rows = [(i, [c * 1e5 for c in v]) for i, v in vectors(5, 60, 4)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    checked(whiten(df), rows)
    with pytest.raises(Exception, match="an embedding has an entry"):
        whiten(spark.createDataFrame([(1, [1e20])], "vec_id bigint, embedding array<double>")).collect()


def test_whiten_without_variance_or_rows(spark):
    same = whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(4)])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in same if r.vec_id == 2] == [(1, 4, 0, None, None, None), (2, 4, 0, None, None, None)]
    flat = whiten(frame(spark, [(i, [float(i), 2.0]) for i in range(4)])).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in flat)
    assert {r.explained for r in flat if r.component == 1} == {1.0}
    for rows in ([], [(1, None), (2, [None])], [(3, [])]):
        empty = whiten(frame(spark, rows))
        assert empty.columns[0] == "vec_id" and empty.count() == 0
    assert whiten(frame(spark, vectors(6, 50, 12)), components=2).groupBy("component").count().count() == 2


def test_components_of_the_table(spark):
    """The query's values against a dense eigensolver over the whole table."""
    from labelgrain.llm.queries import op12_embedding_whitening

    sf = "/root/testdata/sf0.001"
    found = op12_embedding_whitening(spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.floor(1024 * np.stack(table["embedding"]).astype(float)) + 100_000
    y = x - x.mean(axis=0)
    values, e = np.linalg.eigh(y.T @ y / len(y))
    for k in range(1, 9):
        own = found[found["component"] == k].set_index("vec_id")["whitened"].loc[table["vec_id"]].to_numpy()
        expected = y @ e[:, -k] / np.sqrt(values[-k])
        assert min(np.abs(own - expected).max(), np.abs(own + expected).max()) < 1e-7
