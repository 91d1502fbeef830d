"""Global numbers, sums and codes in two steps, pooled models with study intercepts, mixtures on histograms."""

import numpy as np
from pyspark.sql import functions as F

from statloom.functions import scalars
from statloom.operators import assoc, models, numbering


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int").repartition(5)


def test_numbers_and_sums(spark):
    values = [3, 1, None, 1, 7, 7, 7, 2, None, 5]
    rows = sorted(numbering.numbered(frame(spark, values), F.desc("v"), "i").collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == list(range(1, 11))
    assert [(r["v"], r["i"]) for r in rows] == sorted([(v, i) for i, v in enumerate(values)], key=lambda r: (-(r[0] if r[0] is not None else -1), r[1]))
    rows = sorted(numbering.running_sum(frame(spark, values), "v", "v", "i").collect(), key=lambda r: (r["v"] is not None, r["v"] or 0, r["i"]))
    assert [r["total"] for r in rows] == np.cumsum([r["v"] or 0 for r in rows]).tolist() and rows[-1]["share"] == 1
    none = frame(spark, values).limit(0)
    assert numbering.numbered(none, "v").count() == 0 and numbering.running_sum(none, "v", "v").count() == 0


def test_codes_of_two_loads_are_stable(spark):
    words = lambda v: spark.createDataFrame([(x,) for x in v], "a string")
    first = numbering.codes(words(["t", "c", None, "t", "g"]), "a")
    assert {r["a"]: r["code"] for r in first.collect()} == {"c": 0, "g": 1, "t": 2}
    second = numbering.codes(words(["a", "t", "indel", None]), "a", first)
    assert {r["a"]: r["code"] for r in second.collect()} == {"c": 0, "g": 1, "t": 2, "a": 3, "indel": 4}
    assert {r["a"]: r["code"] for r in numbering.codes(words(["x"]), "a", first.limit(0)).collect()} == {"x": 0}
    assert sorted(tuple(r) for r in numbering.codes(words(["t"]), "a", second).collect()) == sorted(tuple(r) for r in second.collect())


def test_factor_levels(spark):
    got = numbering.factor_levels(frame(spark, [5, None, 5, 2]), "v").collect()
    assert {(r["i"], r["level"]) for r in got} == {(0, 3), (1, 1), (2, 3), (3, 2)}


def test_study_intercepts(spark):
    """Equal to a regression with a dummy for each study."""
    rng = np.random.default_rng(2)
    n = 60
    s, g, c = rng.integers(0, 4, n), rng.integers(0, 3, (3, n)).astype(float), rng.normal(size=(n, 2))
    y = rng.normal(size=(2, n)) + s + g[0]
    parts = None
    for k in range(4):
        ids = np.flatnonzero(s == k)
        gd = spark.createDataFrame([(v, int(i), float(g[v, i])) for v in range(3) for i in ids], "variant int, iid long, g double")
        yd = spark.createDataFrame([(p, int(i), float(y[p, i])) for p in range(2) for i in ids], "phenotype int, iid long, y double")
        cd = spark.createDataFrame([(int(i), c[i].tolist()) for i in ids], "iid long, c array<double>")
        part = assoc.study(gd, yd, cd, 2)
        parts = part if parts is None else parts.unionByName(part)
    got = {(r["variant"], r["phenotype"]): r for r in assoc.solve(assoc.pool_within(parts, 2)).collect()}
    dummies = np.eye(4)[s]
    for v in range(3):
        for p in range(2):
            x = np.column_stack([dummies, c, g[v]])
            w, rest = np.linalg.lstsq(x, y[p], rcond=None)[:2]
            se = np.sqrt(rest[0] / (n - 7) * np.linalg.inv(x.T @ x)[-1, -1])
            assert np.allclose([got[v, p]["beta"], got[v, p]["se"], got[v, p]["df"]], [w[-1], se, n - 7])


def test_mixture_on_bins_is_that_of_the_values(spark):
    rng = np.random.default_rng(5)
    groups = {"a": np.concatenate([rng.normal(-1, 0.3, 300), rng.normal(1.5, 0.6, 700)]), "b": rng.normal(0, 1, 400), "one": np.full(9, 2.0)}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("a", None), ("a", float("nan"))]
    got = {r["k"]: r for r in models.mixture(spark.createDataFrame(rows, "k string, x double"), "x", "k").collect()}
    assert set(got) == {"a", "b"}
    for k in got:
        want = models.two_gaussians(groups[k])
        o = np.argsort(want["mean"])
        width = np.ptp(groups[k]) / models.BINS
        for i in (0, 1):
            assert abs(got[k][f"m{i + 1}"] - want["mean"][o[i]]) < 20 * width and abs(got[k][f"s{i + 1}"] - want["sd"][o[i]]) < 20 * width
    assert -1 < got["a"]["cut"] < 1.5 and -1 < got["a"]["dip"] < 1.5
    whole = models.mixture(spark.createDataFrame(rows, "k string, x double"), "x").first()
    assert whole["m1"] < whole["m2"]


def test_crossing_is_where_densities_are_equal():
    for m1, s1, w1, m2, s2, w2 in ((0, 1, 0.5, 4, 1, 0.5), (2, 0.5, 0.3, -1, 2, 0.7), (0, 1, 0.9, 3, 0.2, 0.1)):
        x = scalars.gaussian_crossing(m1, s1, w1, m2, s2, w2)
        assert min(m1, m2) <= x <= max(m1, m2)
        assert np.isclose(w1 / s1 * np.exp(-(((x - m1) / s1) ** 2) / 2), w2 / s2 * np.exp(-(((x - m2) / s2) ** 2) / 2))
    assert scalars.gaussian_crossing(0, 1, 0.999, 0.1, 1, 0.001) is None
