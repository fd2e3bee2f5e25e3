"""Whitening against exact whole-number sums and numpy's eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from hirelake.llm import whitening


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def brute(vectors, most=8):
    """{id: (deviation, |projections|)} and explained, by numpy in double precision."""
    fit = [(i, v) for i, v in vectors if v is not None and len(v) == 4 and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in fit], object)
    n, s = len(x), x.sum(0)
    a = np.array([[float(Fraction(int(n * c - t), n)) for c, t in zip(r, s, strict=True)] for r in x])
    values, turned = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)[:most]
    return fit, [int(((n * r - s) ** 2).sum()) for r in x], np.abs(a @ turned[:, order] / np.sqrt(values[order])), values[order] / values.sum()


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in vectors], "vec_id long, embedding array<float>, n int, whitened double").repartition(3)


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(1)
    made = rng.normal(size=(120, 4)) * [3, 1, 0.2, 0.01] @ np.linalg.qr(rng.normal(size=(4, 4)))[0] + [5, -700, 0, 3e4]
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(made)]
    vectors += [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [1.0, float("nan"), 2.0, 3.0]), (203, [float("inf"), 0.0, 0.0, 0.0])]
    vectors += [(204, []), (205, [1.0, 2.0]), (None, vectors[0][1]), (3, vectors[3][1]), (3, vectors[3][1])]
    fit, deviations, projected, explained = brute(vectors)
    got = rows_of(whitening.whiten(frame(spark, vectors)))
    assert len(got) == 4 * len(fit) and {r[2] for r in got} == {len(fit)}
    assert {r[0] for r in got} == {i for i, _ in fit} and {r[1] for r in got} == {1, 2, 3, 4}
    for (doc, _), deviation, own in zip(fit, deviations, projected, strict=True):
        rows = [r for r in got if r[0] == doc]
        assert {int(r[3]) for r in rows} == {deviation}
        for r in rows:
            assert abs(abs(r[4]) - own[r[1] - 1]) < 1e-6 * max(1, own[r[1] - 1])
            assert abs(r[5] - explained[r[1] - 1]) <= 1e-6 * explained[r[1] - 1]
    assert max(r[6] for r in got) < 1e-9


def test_small_components_keep_their_digits(spark):
    """Spreads 1e7 apart: their squares are beyond what a covariance in doubles can hold."""
    rng = np.random.default_rng(3)
    wide, narrow = rng.choice([-1, 1], 400) * 2.0**23, rng.choice([-1, 1], 400) / 1024
    vectors = [(i, [float(a), float(b), 0.0]) for i, (a, b) in enumerate(zip(wide, narrow, strict=True))]
    got = rows_of(whitening.whiten(frame(spark, vectors)))
    assert {r[1] for r in got} == {1, 2} and max(r[6] for r in got) < 1e-4
    cov = np.cov([wide, narrow * 1.0], bias=True)
    small = np.linalg.det(cov) / cov[0, 0] * 1024**2
    explained = {r[1]: r[5] for r in got}
    total = (cov[0, 0] + cov[1, 1]) * 1024**2
    assert abs(explained[2] - small / total) <= 1e-4 * small / total


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_without_components(spark, vectors):
    assert whitening.whiten(frame(spark, vectors)).count() == 0


def test_fewer_components_than_entries_and_deviation_beyond_64_bits(spark):
    vectors = [(i, [2.0**39 * (i % 2), float(i)]) for i in range(20)]
    got = rows_of(whitening.whiten(frame(spark, vectors), components=1))
    assert len(got) == 20 and {r[1] for r in got} == {1}
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in got:
        assert int(r[3]) == sum((20 * c - s) ** 2 for c, s in zip(x[r[0]], sums, strict=True)) > 2**63


def test_query(spark, sf_dir):
    got = whitening.op12_whitening(spark, sf_dir).toPandas()
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().dropna(subset="embedding")
    x = np.floor(1024 * np.array(vectors.embedding.tolist(), np.float64)) + 100000
    a = x - x.mean(0)
    values = np.linalg.eigvalsh(a.T @ a / len(a))[::-1][:8]
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert len(table) == len(vectors) and np.abs(table.T @ table / len(table) - np.eye(8)).max() < 1e-9
    assert np.allclose(got.groupby("component").explained.first(), values / np.trace(a.T @ a / len(a)), rtol=1e-9)
