"""Golden micro-fixtures and algebraic properties of the association operators."""

import math
import random
from statistics import NormalDist

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statloom.functions import scalars, stats
from statloom.operators import align, assoc, blocks, kinship, matrix, quality, ranges, ranks, scores, variance
from statloom.sources import schema

G, Y, C = [0, 1, 2, 1, 0, 2], [1.0, 1.9, 3.2, 2.1, 0.8, 2.9], [30, 40, 50, 35, 45, 60]


@pytest.fixture(scope="module")
def study(spark):
    g = spark.createDataFrame([("v", i, float(x)) for i, x in enumerate(G)], "variant string, iid int, g double")
    y = spark.createDataFrame([("p", i, x) for i, x in enumerate(Y)], "phenotype string, iid int, y double")
    none = spark.createDataFrame([(i, []) for i in range(6)], "iid int, c array<double>")
    one = spark.createDataFrame([(i, [float(x)]) for i, x in enumerate(C)], "iid int, c array<double>")
    return g, y, none, one


def column(df, name):
    return [r[name] for r in df.collect()]


def test_ranks_and_inverse_normal(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate([0.10, 0.20, 0.20, 0.50, 0.40])] + [(5, None)], "i int, x double")
    by = {r.i: r for r in df.withColumn("r", ranks.average_rank("x")).collect()}
    assert [by[i].r for i in range(6)] == [1, 2.5, 2.5, 5, 4, None]
    a = {r.i: r.int for r in ranks.inverse_normal(df, "x").collect()}
    assert np.allclose([a[i] for i in range(5)], [-1.338339, -0.267532, -0.267532, 1.330963, 0.542440], atol=2e-6)
    b = {r.i: r.int for r in ranks.inverse_normal(df, "x", rescale=False).collect()}
    assert np.allclose([b[i] for i in range(5)], [-1.281552, -0.253347, -0.253347, 1.281552, 0.524401], atol=2e-6) and b[5] is None


def test_statistics_and_solution(study):
    g, y, none, one = study
    s = assoc.study(g, y, none, 0).first()
    assert list(s.a_cov) == [6] and list(s.a_test) == [6, 10] and np.allclose([s.b_cov[0], s.b4, s.c_yy], [11.9, 16.2, 28.31])
    r = assoc.solve(assoc.study(g, y, none, 0)).first()
    assert np.allclose([r.beta, r.se, r.t, r.df], [1.075, 0.073243, 14.677107, 4], atol=2e-6)
    full = assoc.study(g, y, one, 1)
    s = full.first()
    assert list(s.a_test) == [6, 295, 10] and np.allclose([*s.b_cov, s.b4], [11.9, 549.5, 16.2])
    r = assoc.solve(full).first()
    assert np.allclose([r.beta, r.se, r.t, r.df], [1.194737, 0.077173, 15.481272, 3], atol=2e-6)
    bare = assoc.solve(assoc.select_covariates(full, [], 1)).first()
    assert np.isclose(bare.beta, 1.075)
    with pytest.raises(ValueError):
        assoc.select_covariates(full, [0], 1)
    assert assoc.solve(full, 100.0).count() == 0


def test_statistics_add_up(spark, study):
    g, y, _, one = study
    whole = assoc.solve(assoc.study(g, y, one, 1)).first()
    for cut in (2, 3):
        parts = [assoc.study(g.where(w), y.where(w), one.where(w), 1) for w in (f"iid < {cut}", f"iid >= {cut}")]
        got = assoc.solve(assoc.pool(parts[0].unionByName(parts[1]))).first()
        assert np.allclose([got.beta, got.se, got.t, got.n, got.af], [whole.beta, whole.se, whole.t, whole.n, whole.af])


def test_dense_scan_equals_statistics(spark, study, monkeypatch):
    g, y, none, one = study
    rng = np.random.default_rng(12)
    more = spark.createDataFrame([(f"w{j}", i, float(rng.integers(0, 3))) for j in range(7) for i in range(6)] + [("flat", i, 1.0) for i in range(6)], "variant string, iid int, g double")
    traits = spark.createDataFrame([(f"q{j}", i, float(rng.normal())) for j in range(5) for i in range(6)], "phenotype string, iid int, y double")
    g, y = g.union(more), y.union(traits)
    monkeypatch.setattr(blocks, "ROWS", 3)
    for c, k in ((none, 0), (one, 1)):
        want = {(r.variant, r.phenotype): (r.beta, r.se, r.t) for r in assoc.solve(assoc.study(g, y, c, k)).collect()}
        got = {(r.variant, r.phenotype): (r.beta, r.se, r.t) for r in assoc.scan(g, y, c).collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[x], want[x], atol=1e-7) for x in want)
        top = {(r.variant, r.phenotype) for r in assoc.scan(g, y, c, 1.0).collect()}
        assert top == {x for x, v in want.items() if abs(v[2]) > 1.0}


def test_singular_system_is_zero(spark, study):
    g, y, none, _ = study
    flat = g.withColumn("g", F.lit(1.0))
    r = assoc.solve(assoc.study(flat, y, none, 0)).first()
    assert (r.beta, r.se, r.t) == (0.0, 0.0, 0.0)


def test_meta(spark):
    rows = spark.createDataFrame([("v", "p", 0.5, 0.1, 10), ("v", "p", 0.3, 0.2, 20), ("v", "p", None, None, 5)], "variant string, phenotype string, beta double, se double, n long")
    r = assoc.meta_fixed(rows).first()
    assert np.allclose([r.beta, r.se, r.q, r.i2_raw, r.i2], [0.46, 0.089443, 0.8, -25, 0], atol=2e-6) and r.n == 30
    one = assoc.meta_fixed(rows.limit(1)).first()
    assert np.isclose(one.beta, 0.5) and np.isclose(one.se, 0.1)


def test_lambda_and_expected_p(spark):
    p = [0.001, 0.2, 0.5, 0.7, 0.04]
    chi2 = spark.createDataFrame([(NormalDist().inv_cdf(x / 2) ** 2,) for x in p], "chi2 double")
    assert np.isclose(assoc.lambda_median(chi2).first()[0], 3.610119, atol=1e-5)


def test_scalar_goldens(spark):
    ages = spark.createDataFrame([(-1.0,), (0.0,), (0.5,)], "x double").select(scalars.age_from_clock(F.col("x")).alias("a"))
    assert np.allclose(column(ages, "a"), [6.725468, 20, 30.5], atol=2e-6)
    bands = spark.createDataFrame([(i, x) for i, x in enumerate([0.1, 0.2, 0.4, 0.41, 0.7, 0.71])], "i int, x double").select("i", scalars.banded(F.col("x"), [0.2, 0.40000001, 0.70000001]).alias("b")).orderBy("i")
    assert column(bands, "b") == [1, 2, 2, 3, 3, 4]
    chr_ = spark.createDataFrame([("chrX",), ("y",), ("MT",), ("22",), ("PAR",)], "c string").select(scalars.chromosome_code(F.col("c")).alias("n"))
    assert column(chr_, "n") == [23, 24, 25, 22, None]
    v = spark.createDataFrame([("1.9", "1.10"), ("v1.10.1", "1.10"), ("2", "1.99.9"), ("1.2", "1.2.0")], "a string, b string").select(scalars.version_at_least(F.col("a"), F.col("b")).alias("ok"))
    assert column(v, "ok") == [False, True, True, True]
    n = spark.createDataFrame([("NA",), ("-9",), ("1e3",), ("x",), (None,)], "t string").select(scalars.parse_number(F.col("t")).alias("n"))
    assert column(n, "n") == [None, None, 1000.0, None, None]
    assert np.isclose(scalars.gaussian_crossing(0, 1, 0.5, 4, 1, 0.5), 2)


def test_entropy_flip_filter(spark):
    e = scores.entropy(spark.createDataFrame([("a", 0.5), ("a", 0.25), ("a", 0.25), ("a", 0.0)], "iid string, x double")).first()
    assert e.entropy == 1.5
    g = spark.createDataFrame([(0,), (1,), (2,)], "g int").select(align.flip_dosage(F.col("g"), F.lit(-1)).alias("f"))
    assert column(g, "f") == [2, 1, 0]
    af = spark.createDataFrame([(0.005,), (0.5,), (0.3,), (0.995,)], "af double").where(assoc.maf_filter(F.col("af"), 0.01))
    assert column(af, "af") == [0.3]


def test_mapper(spark):
    ref = spark.createDataFrame([(1, "1", 100, "A", "G"), (2, "1", 200, "C", "T"), (3, "2", 50, "G", "A")], "ref_idx int, chr string, bp long, a1 string, a2 string")
    study = spark.createDataFrame([(0, "1", 100, "A", "G"), (1, "1", 200, "T", "C"), (2, "3", 1, "A", "C")], "study_idx int, chr string, bp long, a1 string, a2 string")
    got = {tuple(r) for r in align.match_variants(study, ref).collect()}
    assert got == {(1, 0, 1), (2, 1, -1), (3, -1, 0)}
    assert {tuple(r) for r in align.match_variants(study, ref, "drop").collect()} == {(1, 0, 1), (2, -1, 0), (3, -1, 0)}
    with pytest.raises(ValueError):
        align.match_variants(study, ref, "error")


def test_duplicates_and_range(spark):
    d = spark.createDataFrame([("x", 1), ("x", 1), ("y", 1), ("y", 2), ("z", 5)], "k string, v int")
    assert sorted(map(tuple, align.exclude_mismatch(d, "k", "v").collect())) == [("x", 1), ("z", 5)]
    snp = spark.createDataFrame([("1", 1000), ("1", 5000)], "chr string, pos long")
    cpg = spark.createDataFrame([("1", 1500)], "chr string, site long")
    assert column(ranges.near_join(snp, cpg, "chr", "pos", "site", 600), "pos") == [1000]


def test_range_joins_equal_brute_force(spark):
    rng = random.Random(4)
    a = [(str(rng.randrange(3)), rng.randrange(-500, 5000)) for _ in range(300)]
    b = [(str(rng.randrange(3)), rng.randrange(-500, 5000)) for _ in range(60)]
    left, right = spark.createDataFrame(a, "chr string, pos long"), spark.createDataFrame(b, "chr string, site long")
    for w in (0, 1, 37, 900):
        got = ranges.near_join(left, right, "chr", "pos", "site", w)
        assert "Cartesian" not in got._jdf.queryExecution().toString()
        want = sorted((x[0], x[1], y[1]) for x in a for y in b if x[0] == y[0] and abs(x[1] - y[1]) <= w)
        assert sorted(tuple(r) for r in got.select("chr", "pos", "site").collect()) == want
    spans = right.selectExpr("chr", "site as s", "site + 120 as e")
    got = ranges.inside_join(left, spans, "chr", "pos", "s", "e", 10, 64)
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and y[1] - 10 <= x[1] <= y[1] + 130)
    assert sorted(tuple(r) for r in got.select("pos", "s").collect()) == want


def test_quantile_in_both_engines(spark):
    p = [1e-12, 1e-5, 0.01, 0.07, 0.3, 0.5, 0.9, 0.9999, 1 - 1e-9]
    want = [NormalDist().inv_cdf(x) for x in p]
    got = column(spark.createDataFrame([(x,) for x in p], "p double").select(stats.norm_quantile("p").alias("q")), "q")
    text = stats.norm_quantile_sql("p")
    other = duckdb.execute(f"SELECT {text} FROM (SELECT unnest({p!r}::DOUBLE[]) AS p)").fetchall()
    assert np.allclose(got, want, rtol=1e-13) and np.allclose([r[0] for r in other], want, rtol=1e-13)


def test_tails():
    assert np.allclose(stats.t_two_sided([2.0, 0.0, -3.5], [10, 5, 30]), [0.07338803, 1.0, 0.00147656], atol=1e-6)
    assert np.isclose(stats.f_upper(4.0, 1, 10), stats.t_two_sided(2.0, 10))
    assert np.isclose(stats.chi2_1_upper(3.841458820694124), 0.05) and np.isclose(stats.norm_two_sided(1.959963984540054), 0.05)
    # all three arrangements of one heterozygote and so on, by enumeration
    assert np.isclose(stats.hardy_weinberg_p(0, 1, 1), 1 / 3) and stats.hardy_weinberg_p(0, 0, 0) == 1.0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 30), st.integers(0, 30), st.integers(0, 30))
def test_hardy_weinberg_is_a_probability(a, b, c):
    p = stats.hardy_weinberg_p(a, b, c)
    assert 0 < p <= 1 and np.isclose(p, stats.hardy_weinberg_p(a, c, b))


@settings(max_examples=15, deadline=None)
@given(st.integers(2, 12), st.integers(0, 10**6))
def test_encoding_keeps_products(n, seed):
    rng = np.random.default_rng(seed)
    g, y = rng.integers(0, 3, (4, n)).astype(float), rng.normal(size=(n, 3))
    a, b = assoc.encode(g, y, seed)
    assert np.allclose(a @ b, g @ y, atol=1e-5)


def test_residuals_are_orthogonal(spark):
    rng = np.random.default_rng(8)
    n = 40
    c = rng.normal(size=(n, 2))
    x = {f: rng.normal(size=n) for f in range(3)}
    rows = [(f, i, None if f == 1 and i % 7 == 0 else float(x[f][i])) for f in x for i in range(n)]
    got = assoc.residuals(spark.createDataFrame(rows, "feat int, iid int, x double"), spark.createDataFrame([(i, c[i].tolist()) for i in range(n)], "iid int, c array<double>"), 2).toPandas()
    a = np.column_stack([np.ones(n), c])
    for f, part in got.groupby("feat"):
        part = part.sort_values("iid")
        ok = part["resid"].notna().to_numpy()
        assert ok.sum() == (n - 6 if f == 1 else n)
        e = part["resid"].to_numpy(float)[ok]
        want = x[f][ok] - a[ok] @ np.linalg.lstsq(a[ok], x[f][ok], rcond=None)[0]
        assert np.allclose(e, want) and np.allclose(a[ok].T @ e, 0, atol=1e-8)


def test_pca_and_relationship(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 5)) @ rng.normal(size=(5, 5))
    long = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(30) for j in range(5)], "iid int, feat int, x double")
    scores_, shares = matrix.principal_components(long, 2)
    got = scores_.toPandas().pivot(index="iid", columns="pc", values="score").to_numpy()
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs((u * s)[:, :2])) and np.allclose(shares, s**2 / (s**2).sum())
    assert matrix.component_count([0.5, 0.2, 0.15, 0.1, 0.05]) == 3
    g = rng.integers(0, 3, (8, 50)).astype(float)
    dose = spark.createDataFrame([(i, j, float(g[i, j])) for i in range(8) for j in range(50)], "iid int, feat int, g double")
    p = g.mean(0) / 2
    ok = np.minimum(p, 1 - p) > 0.01
    z = (g - 2 * p)[:, ok] / np.sqrt(2 * p * (1 - p))[ok]
    want = z @ z.T / ok.sum()
    assert all(np.isclose(r.grm, want[r.i, r.j]) for r in matrix.relationship(dose).collect())


def test_pruning(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path}")
    edges = [(1, 0, 0.5), (2, 1, 0.5), (3, 2, 0.5), (4, 0, 0.01), (6, 5, 0.9)]
    drop = set(column(kinship.prune_related(spark.createDataFrame(edges, "i long, j long, grm double"), 0.1), "iid"))
    assert not any(g > 0.1 and i not in drop and j not in drop for i, j, g in edges) and 4 not in drop and len(drop) <= 3
    x = np.random.default_rng(0).integers(0, 3, 50).astype(float).tolist()
    other = x[::-1]
    v = spark.createDataFrame([("1", 1, "a", x), ("1", 2, "b", x), ("1", 3, "c", other), ("2", 1, "d", x), ("2", 2, "e", [1.0] * 50)], "chr string, pos long, variant string, values array<double>")
    v = v.select("chr", "pos", "variant", F.posexplode("values").alias("iid", "g"))
    kept = set(column(kinship.prune_ld(v, r2=0.5), "variant"))
    assert kept == {"a", "c", "d"}


def test_polygenic_fit_finds_the_share():
    rng = np.random.default_rng(3)
    n = 300
    z = rng.normal(size=(n, 600))
    k = z @ z.T / 600
    lam, vec = np.linalg.eigh(k)
    got = []
    for _ in range(5):
        y = 2 + np.sqrt(0.7) * (vec @ (np.sqrt(np.maximum(lam, 0)) * rng.normal(size=n))) + np.sqrt(0.3) * rng.normal(size=n)
        got.append(kinship.fit_polygenic(np.maximum(lam, 0), vec, y, np.ones((n, 1)))["h2"])
    assert 0.4 < np.mean(got) < 0.95
    flat = kinship.fit_polygenic(np.ones(n), np.eye(n), rng.normal(size=n), np.ones((n, 1)))
    assert np.isclose(flat["residual"].mean(), 0, atol=1e-8)


def test_deconvolution_and_imputation(spark):
    rng = np.random.default_rng(2)
    ref = pd.DataFrame(rng.uniform(size=(60, 3)), columns=["a", "b", "c"])
    x = ref.to_numpy() @ [0.6, 0.3, 0.1]
    got = {r.cell: r.share for r in kinship.deconvolve(spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "iid string, feat int, x double"), ref).collect()}
    assert np.allclose([got[c] for c in "abc"], [0.6, 0.3, 0.1], atol=1e-6)
    wide = spark.createDataFrame([(i, [float(i % 2), float(i % 2) + 1, None if i == 3 else float(i % 2) + 2]) for i in range(12)], "k int, v array<double>")
    filled = {r.k: list(r.v) for r in matrix.knn_impute(wide, "k", "v", k=3).collect()}
    assert filled[3] == [1.0, 2.0, 3.0] and len(filled) == 12


def test_variance_and_interaction(spark):
    rng = np.random.default_rng(6)
    n = 200
    g, i = rng.integers(0, 3, n).astype(float), rng.normal(size=n)
    y = 1 + g - i + 0.7 * g * i + 0.1 * rng.normal(size=n)
    frame = lambda rows, s: spark.createDataFrame(rows, s)
    got = variance.interaction(frame([("v", k, float(g[k])) for k in range(n)], "variant string, iid int, g double"), frame([("p", k, float(y[k])) for k in range(n)], "phenotype string, iid int, y double"), frame([(k, float(i[k])) for k in range(n)], "iid int, i double")).first()
    a = np.column_stack([np.ones(n), g, i, g * i])
    b = np.linalg.lstsq(a, y, rcond=None)[0]
    assert np.isclose(got.beta, b[3]) and got.t > 20
    spread = rng.normal(size=n) * (0.2 + g)
    pairs = frame([("v", "p", k, float(g[k]), float(spread[k])) for k in range(n)], "variant string, phenotype string, iid int, g double, y double")
    assert variance.brown_forsythe(pairs).first().f > 10


def test_expectations(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None)], "id int, x double")
    checks = {"n": ("error", F.count("*"), ">=", 3), "gaps": ("warning", F.avg(F.isnull("x").cast("int")), "<=", 0.1), "unique": ("error", F.count("*") - F.count_distinct("id"), "=", 0)}
    table = quality.expect(df, checks)
    assert {r.check_id: r.passed for r in table.collect()} == {"n": False, "gaps": False, "unique": True}
    with pytest.raises(ValueError, match="failed: n$"):
        quality.require(table)
    a, b = spark.createDataFrame([("k", 1.0), ("l", 2.0)], "k string, v double"), spark.createDataFrame([("k", 1.05), ("m", 2.0)], "k string, v double")
    assert quality.compare(a, b, ["k"], "v", 0.1).count() == 2 and quality.compare(a, b, ["k"], "v").count() == 3


def test_harmonisation_reasons(spark):
    pairs = [("A", "G"), ("A", None), ("<DEL>", "A"), ("R", "I"), ("Y", "Z"), ("AT", "A"), ("N", "A"), ("a", "A")]
    got = column(spark.createDataFrame(pairs, "a string, b string").select(quality.allele_reject("a", "b").alias("w")), "w")
    assert got == [None, "missing", "deletion mark", "insertion or deletion code", "ambiguity code", "more than one base", "not a base", "equal alleles"]


def test_schema_rules(spark):
    df = spark.createDataFrame([("s1", "F", "31", "x"), ("s2", "M", "NA", "x")], "IID string, Sex_factor string, Age_numeric string, Batch_factor string")
    assert schema.typed_columns(df.columns) == (["Sex_factor", "Batch_factor"], ["Age_numeric"])
    assert column(schema.apply_types(df), "Age_numeric") == [31.0, None]
    assert schema.find_column(df.columns, "age_numeric") == "Age_numeric" and schema.find_column(df.columns, "batch") is None
    assert schema.drop_uninformative(df).columns == ["IID", "Sex_factor", "Age_numeric"]
    assert schema.one_hot(df, "Sex_factor", ["M", "F"]).columns[-1] == "Sex_factor_M"


def test_false_discovery_rate(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.03, 0.9]
    got = {r.i: r.fdr for r in ranks.benjamini_hochberg(spark.createDataFrame(list(enumerate(p)), "i int, p double"), "p").collect()}
    order = sorted(range(6), key=lambda i: p[i])
    want, low = {}, 1.0
    for rank in range(6, 0, -1):
        low = min(low, p[order[rank - 1]] * 6 / rank)
        want[order[rank - 1]] = low
    assert np.allclose([got[i] for i in range(6)], [want[i] for i in range(6)])
    assert math.isclose(got[2], got[4])
