"""Adjustment modes and the clocks' rules."""

import numpy as np
import pytest

from statloom.operators import adjustment, ranks


def frames(spark):
    rng = np.random.default_rng(1)
    x, c = rng.normal(size=(3, 30)), rng.normal(size=30)
    x[1, 4] = np.nan
    values = spark.createDataFrame([(f, i, None if np.isnan(v) else float(v)) for (f, i), v in np.ndenumerate(x)], "feat int, iid long, x double")
    return x, c, values, spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(c)], "iid long, c array<double>")




def residual(x, c):
    d = np.column_stack([np.ones(len(c)), c])
    return x - d @ np.linalg.lstsq(d, x, rcond=None)[0]


def test_modes(spark):
    x, c, values, cov = frames(spark)
    got = {(r["feat"], r["iid"]): r["x"] for r in adjustment.adjust(values, cov, 1, "untransformed").collect()}
    want = residual(x[0], c)
    assert np.allclose([got[0, i] for i in range(30)], want)
    ok = ~np.isnan(x[1])
    part = residual(x[1][ok], c[ok])
    assert np.allclose([got[1, i] for i in np.flatnonzero(ok)], part) and np.isclose(got[1, 4], part.mean(), atol=1e-12)
    plain = {(r["feat"], r["iid"]): r["int"] for r in ranks.inverse_normal(values, "x", "feat").collect()}
    scores = np.array([plain[0, i] for i in range(30)])
    once = {(r["feat"], r["iid"]): r["x"] for r in adjustment.adjust(values, cov, 1, "transformed").collect()}
    order = np.argsort(residual(scores, c))
    assert (np.diff([once[0, i] for i in order]) > 0).all()
    again = {(r["feat"], r["iid"]): r["x"] for r in adjustment.adjust(values, cov, 1, "transformed", again=True).collect()}
    assert (np.diff([again[0, i] for i in np.argsort(want)]) > 0).all() and np.allclose(sorted(again[0, i] for i in range(30)), sorted(once[0, i] for i in range(30)), atol=1e-6)
    with pytest.raises(ValueError, match="mode"):
        adjustment.adjust(values, cov, 1, "other")


def test_clock_rules(spark):
    x, _, values, _ = frames(spark)
    w = spark.createDataFrame([(0, 1.0), (1, -2.0), (9, 5.0)], "feat int, w double")
    x[1, 4] = np.nanmean(x[1])
    got = {r["iid"]: r["pred"] for r in adjustment.clock(values, w, 0.5).collect()}
    assert np.allclose([got[i] for i in range(30)], 0.5 + x[0] - 2 * x[1])
    assert adjustment.clock(values, w, least=3).count() == 0 and adjustment.clock(values, w, least=2).count() == 30
    assert adjustment.clock(values, w, share=0.7).count() == 0 and adjustment.clock(values, w, share=2 / 3).count() == 30
    assert adjustment.clock(values.limit(0), w).count() == 0
    years = {r["iid"]: r["pred"] for r in adjustment.clock(values, w, 0.5, years=True).collect()}
    assert all(np.isclose(years[i], 21 * np.exp(v) - 1 if v < 0 else 21 * v + 20) for i, v in got.items())


def test_accelerations(spark):
    x, c, values, _ = frames(spark)
    smoking = x[2]
    pred = values.where("feat = 0").selectExpr("'k' as clock", "iid", "x as pred")
    about = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(zip(c, smoking, strict=True))], "iid long, c array<double>")
    got = {r["iid"]: r for r in adjustment.acceleration(pred, about, 1).collect()}
    one, two = residual(x[0], c[:, None]), residual(x[0], np.column_stack([c, smoking]))
    assert np.allclose([got[i]["pred_sd"] for i in range(30)], one / one.std(ddof=1))
    assert np.allclose([got[i]["pred_ss_sd"] for i in range(30)], two / two.std(ddof=1))
    bare = {r["iid"]: r["pred_sd"] for r in adjustment.acceleration(pred, about.selectExpr("iid", "slice(c, 2, 1) as c"), 0).collect()}
    assert np.allclose([bare[i] for i in range(30)], x[0] / x[0].std(ddof=1))
