"""Kernel density from cell moments against the plain sum over rows."""

import numpy as np
import pytest

from lotmill.operators.profile import density, density_2d


def test_one_dimension(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=800), np.full(300, 2.5), rng.normal(size=40) * 30])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    rows = {r["point"]: r for r in density(df, "x", 50).collect()}
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 50)
    plain = np.exp(-(((grid[:, None] - x) / h) ** 2) / 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert [rows[i]["x"] for i in range(50)] == pytest.approx(grid, abs=1e-9)
    assert np.abs(np.array([rows[i]["density"] for i in range(50)]) - plain).max() < 1e-14 / h


def test_two_dimensions(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=700), rng.normal(size=9) * 20])
    y = 0.7 * x + rng.normal(size=len(x))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0)], "x double, y double")
    rows = {(r["ix"], r["iy"]): r["density"] for r in density_2d(df, "x", "y", 11).collect()}
    cov = np.cov(x, y) * len(x) ** (-1 / 3)
    inv, det = np.linalg.inv(cov), np.linalg.det(cov)
    ends = [np.linspace(v.min() - 3 * np.sqrt(s), v.max() + 3 * np.sqrt(s), 11) for v, s in ((x, cov[0, 0]), (y, cov[1, 1]))]
    for i, gx in enumerate(ends[0]):
        for j, gy in enumerate(ends[1]):
            d = np.stack([gx - x, gy - y])
            plain = np.exp(-np.einsum("ik,ij,jk->k", d, inv, d) / 2).sum() / (len(x) * 2 * np.pi * np.sqrt(det))
            assert abs(rows[i, j] - plain) < 1e-11 / np.sqrt(det)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert density(empty, "x", 5).count() == 0
    assert density_2d(empty, "x", "y", 5).count() == 0
    same = spark.createDataFrame([(1.0, 2.0)] * 4, "x double, y double")
    assert all(r["density"] is None for r in density(same, "x", 5).collect())
    assert all(r["density"] is None for r in density_2d(same, "x", "y", 3).collect())
