"""Whitening against numpy's eigendecomposition and exact whole numbers."""

import numpy as np
import pytest

from deskline.llm.queries import QUERIES
from deskline.llm.whitening import Spectrum, fit_whitening, whiten

SF = "/root/testdata/sf0.01"


def plain_version(vectors, many=8):
    """Exact deviations, and the leading eigenpairs, of a list of vectors."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    scaled = n * x.astype(object) - sums.astype(object)
    z = scaled.astype(float) / n
    values, basis = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:many]
    return [int((row * row).sum()) for row in scaled], z, values[order], basis[:, order], float((z * z).sum() / n)


def check(rows, ids, vectors, many):
    deviations, z, values, basis, trace = plain_version(vectors, many)
    by_id = {i: k for k, i in enumerate(ids)}
    signs = {}
    assert len(rows) == len(ids) * len(values)
    for r in rows:
        k, c = by_id[r[0]], r.component - 1
        want = z[k] @ basis[:, c] / np.sqrt(values[c])
        if abs(want) > 1e-3:
            sign = signs.setdefault(c, np.sign(want * r.whitened))
            assert abs(r.whitened * sign - want) < 1e-7
        assert r.n == len(ids)
        assert r.deviation == deviations[k]
        assert abs(r.explained - values[c] / trace) < 1e-10 * r.explained + 1e-15
        assert r.identity_error < 1e-9


def test_query_equals_eigh(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    check(rows, [r.vec_id for r in table], [r.embedding for r in table], 8)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_blocks_and_partitions(spark, block):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(150, 6)) * [9, 5, 3, 1, 0.5, 0.1]).astype(np.float32)
    vectors[40:90] = vectors[40]  # one very common vector
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(40)
    check(whiten(df, fit_whitening(df, block=block), 6).collect(), list(range(150)), vectors, 6)


def test_rank_one_updates():
    rng = np.random.default_rng(1)
    for d in (1, 2, 5, 40):
        spectrum, scatter = Spectrum(d), np.zeros((d, d))
        for i in range(120):
            row = rng.normal(size=d) * np.linspace(1, 100, d)
            if i % 7 == 0:
                row = np.eye(d)[i % d] * 5
            if i % 11 == 0:
                row = np.floor(row / 50)
            if i % 13 == 0:
                row = row * 1e-12
            spectrum.add(row)
            scatter += np.outer(row, row)
        size = np.abs(scatter).max()
        assert np.abs(spectrum.values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * size
        assert np.abs(spectrum.basis.T @ spectrum.basis - np.eye(d)).max() < 1e-12
        assert np.abs(spectrum.basis * spectrum.values @ spectrum.basis.T - scatter).max() < 1e-12 * size


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [-3.0, 0.25, 0.5]), (4, [2.0, 2.0, 0.5]), (5, [0.0, -7.5, 0.5])]
    bad = [(6, None), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 1.0]), (9, [inf, 1.0, 1.0]), (10, [1.0, 2.0]), (11, []), (12, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0.0) for i, v in good + bad], "vec_id long, embedding array<double>, whitened double")
    rows = whiten(df, fit_whitening(df)).collect()
    # The third entry never varies: two components.
    assert sorted(((r.id, r.component) for r in rows), key=repr) == sorted(
        ((i, c) for i, _ in good for c in (1, 2)), key=repr
    )
    deviations, z, values, basis, trace = plain_version([v for _, v in good], 2)
    assert {(r.id, r.deviation) for r in rows} == {(i, d) for (i, _), d in zip(good, deviations)}
    assert all(r.n == 5 and r.identity_error < 1e-12 for r in rows)
    for few in ([], bad[:5], good[:2], good[:1], [(1, [])]):
        small = spark.createDataFrame(few, "vec_id long, embedding array<double>")
        assert whiten(small, fit_whitening(small)).collect() == []


def test_deviation_beyond_64_bits_is_null(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [1e9, 2.0])], "vec_id long, embedding array<double>")
    rows = whiten(df, fit_whitening(df)).collect()
    # The second entry's variance is below the rounding of the first one's.
    assert [r.component for r in rows] == [1, 1, 1] and all(r.deviation is None for r in rows)
    assert max(r.identity_error for r in rows) < 1e-9
