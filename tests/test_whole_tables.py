"""Queries without SQL over the whole table, against brute force."""

import numpy as np
import pytest

from statloom import plans
from statloom.operators import blocks, matrix

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    return [r.vec_id for r in rows], np.array([list(r.embedding) for r in rows], float)


@pytest.fixture(scope="module")
def grm(table):
    x = table[1][:, :32]
    g = np.where(x < -0.055, 0.0, np.where(x < 0.055, 1.0, 2.0))
    p = g.mean(0) / 2
    z = (g - 2 * p) / np.sqrt(2 * p * (1 - p))
    return g, z @ z.T / z.shape[1]


def test_relationship_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", 7)
    g = np.random.default_rng(5).integers(0, 3, (40, 20)).astype(float)
    dose = spark.createDataFrame([(i, j, float(g[i, j])) for i in range(40) for j in range(20)], "iid int, feat int, g double")
    p = g.mean(0) / 2
    z = (g - 2 * p) / np.sqrt(2 * p * (1 - p))
    want = z @ z.T / 20
    got = {(r.i, r.j): r.grm for r in matrix.relationship(dose).collect()}
    assert set(got) == {(i, j) for i in range(40) for j in range(i + 1)} and all(np.isclose(v, want[k]) for k, v in got.items())
    high = {(r.i, r.j) for r in matrix.relationship(dose, above=0.2).collect()}
    assert high == {k for k, v in got.items() if v > 0.2}


def test_prune_leaves_no_pair_of_the_table(spark, table, grm):
    ids, _ = table
    drop = {r.iid for r in plans.QUERIES["relatedness_prune"](spark, SF).collect()}
    kept = [n for n, i in enumerate(ids) if i not in drop]
    left = grm[1][np.ix_(kept, kept)] > 0.35
    np.fill_diagonal(left, False)
    assert drop <= set(ids) and not left.any() and max(drop) >= 80


def dense_reml(k, y, x):
    """(share, variance, residual) by a search over the restricted likelihood, from contrasts that the fixed effects x leave."""
    q = np.linalg.qr(np.column_stack([x, np.eye(len(y))]))[0]
    a = q[:, np.linalg.matrix_rank(x) : len(y)]
    theta, vector = np.linalg.eigh(a.T @ k @ a)
    theta, w = np.maximum(theta, 0), vector.T @ (a.T @ y)

    def at(h):
        s = h * theta + 1 - h
        return -0.5 * (np.log(s).sum() + len(w) * np.log((w * w / s).sum()))

    low, high = 0.0, 0.999
    for _ in range(8):
        grid = np.linspace(low, high, 41)
        best = int(np.argmax([at(h) for h in grid]))
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, 40)]
    h = (low + high) / 2 if low > 0 else 0.0
    s = h * theta + 1 - h
    variance = (w * w / s).mean()
    return h, variance, a @ vector @ (w / np.sqrt(s * variance))


def test_polygenic_queries_take_all_samples_and_traits(spark, table, grm):
    ids, x = table
    one = np.ones((len(ids), 1))
    fits = {f: dense_reml(grm[1], x[:, f], one) for f in range(32, 64)}
    got = {(r.feat, r.iid): r for r in plans.QUERIES["polygenic_residuals"](spark, SF).collect()}
    assert set(got) == {(f, i) for f in range(32, 64) for i in ids}
    assert all(abs(got[f, ids[0]].h2 - fits[f][0]) < 1e-3 for f in fits)
    assert all(np.isclose(got[f, i].resid, fits[f][2][n], atol=5e-3) for f in fits for n, i in enumerate(ids))
    h2 = {(r.adjusted, r.feat): r.h2 for r in plans.QUERIES["heritability"](spark, SF).collect()}
    assert set(h2) == {(a, f) for a in (0, 1) for f in fits} and all(abs(h2[0, f] - fits[f][0]) < 1e-3 for f in fits)
    assert all(0 <= v <= 1 for v in h2.values())


def test_mixed_scan_takes_all_samples_and_traits(spark, table, grm):
    ids, x = table
    k = np.where((grm[1] >= 0.8) | np.eye(len(ids), dtype=bool), grm[1], 0.0)
    got = {(r.adjusted, r.variant, r.phenotype): r for r in plans.QUERIES["mixed_model_scan"](spark, SF).collect()}
    assert set(got) == {(a, v, p) for a in (0, 1) for v in range(32) for p in range(32, 64)}
    one = np.ones((len(ids), 1))
    for p in (32, 40, 63):
        h, variance, _ = dense_reml(k, x[:, p], one)
        inverse = np.linalg.inv(h * k + (1 - h) * np.eye(len(ids)))
        for v in range(32):
            full = np.column_stack([one, grm[0][:, v]])
            inner = np.linalg.inv(full.T @ inverse @ full)
            beta = (inner @ full.T @ inverse @ x[:, p])[1]
            r = got[0, v, p]
            assert np.isclose(r.beta, beta, atol=1e-4) and np.isclose(r.t, beta / np.sqrt(variance * inner[1, 1]), atol=5e-3)


def test_deconvolution_takes_all_samples(spark, table):
    assert {r.iid for r in plans.QUERIES["cell_deconvolution"](spark, SF).select("iid").distinct().collect()} == set(table[0])
