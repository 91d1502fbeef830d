"""Permuted scans, beta fits, interactions by tiles and encoding against plain algebra."""

import numpy as np
import pytest

from statloom.operators import assoc, blocks, encoding, nulls


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", 3)
    monkeypatch.setattr(blocks, "COLS", 7)


def long(spark, x, names):
    return spark.createDataFrame([(i, j, None if np.isnan(v) else float(v)) for (i, j), v in np.ndenumerate(x)], names)


def tstats(g, y, c):
    out = np.zeros((len(g), len(y)))
    for i, a in enumerate(g):
        for j, b in enumerate(y):
            x = np.column_stack([np.ones(len(c)), c, a])
            w, rest = np.linalg.lstsq(x, b, rcond=None)[:2]
            out[i, j] = w[-1] / np.sqrt(rest[0] / (len(c) - x.shape[1]) * np.linalg.inv(x.T @ x)[-1, -1])
    return out


@pytest.fixture(scope="module")
def study(spark):
    rng = np.random.default_rng(3)
    g, y, c = rng.integers(0, 3, (9, 40)).astype(float), rng.normal(size=(4, 40)), rng.normal(size=(40, 1))
    y[1] += g[4]
    return g, y, c, long(spark, g, "variant int, iid long, g double"), long(spark, y, "phenotype int, iid long, y double"), spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(c)], "iid long, c array<double>")


def test_null_maxima_are_those_by_hand(study):
    g, y, c, gd, yd, cd = study
    got = {(r["phenotype"], r["perm"]): (r["variant"], r["t"]) for r in nulls.permutation_scan(gd, yd, cd, 3, 5).collect()}
    assert len(got) == 4 * 4
    for k in range(4):
        shuffled = np.array([np.random.default_rng([5, k]).permutation(v) if k else v for v in y])
        t = tstats(g, shuffled, c)
        for p in range(4):
            best = int(np.abs(t[:, p]).argmax())
            assert got[p, k][0] == best and np.isclose(got[p, k][1], t[best, p])


def test_regression_in_one_go(study):
    g, y, c, gd, yd, cd = study
    af = g.mean(1) / 2
    keep = {i for i in range(9) if 0.47 < af[i] < 0.53 and af[i] != 0.5}
    got = {(r["variant"], r["phenotype"]): r["t"] for r in nulls.regression(gd, yd, cd, maf=0.47, permute=11).collect()}
    assert {v for v, _ in got} == keep and keep
    t = tstats(g, np.array([np.random.default_rng([11, 1]).permutation(v) for v in y]), c)
    assert all(np.isclose(v, t[k]) for k, v in got.items())


def test_empirical_p(study):
    _, _, _, gd, yd, cd = study
    got = {r["phenotype"]: r for r in nulls.empirical_p(nulls.permutation_scan(gd, yd, cd, 40, 5), 37).collect()}
    assert got[1]["p_perm"] == 1 / 41 and got[1]["p_beta"] < 0.05 and got[1]["variant"] == 4
    assert all(r["p"] <= r["p_beta"] <= 1 for p, r in got.items() if p != 1)


def test_beta_fit():
    x = np.random.default_rng(1).beta(1.3, 7.0, 20_000)
    a, b = nulls.beta_fit(x)
    assert abs(a - 1.3) < 0.05 and abs(b - 7.0) < 0.3 and nulls.beta_fit(np.full(5, 0.3)) == (1.0, 1.0)


def test_interaction_by_tiles(study, spark):
    g, y, c, gd, yd, cd = study
    g, y = g.copy(), y.copy()
    g[2, 5], y[3, 7] = np.nan, np.nan
    rare = np.zeros((1, 40))
    g = np.vstack([g, rare])
    m = cd.selectExpr("iid", "c[0] as i")
    out = nulls.interaction(long(spark, g, "variant int, iid long, g double"), long(spark, y, "phenotype int, iid long, y double"), m)
    got = {(r["variant"], r["phenotype"]): r for r in out.collect()}
    assert len(got) == 9 * 4
    i = c[:, 0]
    for (v, p), r in got.items():
        a, b = np.where(np.isnan(g[v]), np.nanmean(g[v]), g[v]), np.where(np.isnan(y[p]), np.nanmean(y[p]), y[p])
        a = a - a.mean()
        x = np.column_stack([np.ones(40), a, i, a * i])
        w, rest = np.linalg.lstsq(x, b, rcond=None)[:2]
        t = w[-1] / np.sqrt(rest[0] / 36 * np.linalg.inv(x.T @ x)[-1, -1])
        assert r["n"] == 40 and np.allclose([r["beta"], r["t"]], [w[-1], t], rtol=1e-6, atol=1e-9)
    own = nulls.interaction(gd, spark.createDataFrame([(0, j, float(v)) for j, v in enumerate(i)], "phenotype int, iid long, y double"), m)
    assert {r["t"] for r in own.collect()} == {0.0}


def test_encoding(study, spark, monkeypatch):
    g, y, _, gd, yd, cd = study
    monkeypatch.setattr(encoding, "SIZE", 6)
    monkeypatch.setattr(encoding, "ROWS", 4)
    ids, secret = cd.select("iid"), b"0123456789abcdef"
    a = encoding.encode(gd, ids, secret, False, row="variant", value="g").withColumnRenamed("code", "iid")
    b = encoding.encode(yd, ids, secret, True, row="phenotype", value="y").withColumnRenamed("code", "iid")
    assert a.select("iid").distinct().count() == 40
    got = {(r["variant"], r["phenotype"]): r["b4"] for r in assoc.pair_sums(a, b, a.select("iid").distinct()).collect()}
    assert all(np.isclose(v, g[i] @ y[j]) for (i, j), v in got.items()) and len(got) == 36
    coded = np.array([r["g"] for r in a.collect()])
    assert coded.max() > 50 and len(set(coded.tolist())) > 100  # nothing like dosages
    other = encoding.encode(yd, ids, b"another secret..", True, row="phenotype", value="y").withColumnRenamed("code", "iid")
    wrong = {(r["variant"], r["phenotype"]): r["b4"] for r in assoc.pair_sums(a, other, a.select("iid").distinct()).collect()}
    assert not any(np.isclose(wrong[i, j], g[i] @ y[j]) for i, j in wrong)
    m = encoding.secret_matrix(secret, 0, 3, 30)
    assert m.min() >= 1 and m.max() <= 9 and len(np.unique(m)) == 9 and (m == encoding.secret_matrix(secret, 0, 3, 30)).all() and (m != encoding.secret_matrix(secret, 1, 3, 30)).any()
    with_none = encoding.encode(gd.limit(0), ids, secret, False, row="variant", value="g")
    assert with_none.count() == 0
