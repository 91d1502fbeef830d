"""Association: sufficient statistics, all-pairs regression, meta-analysis, calibration, residuals, variance QTL, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.stats import CHI2_MEDIAN, norm_quantile, norm_quantile_sql, p_from_f, p_from_t
from statloom.operators import assoc, encoding, kinship, matrix, nulls, numbering, ranks, reml, selection, store
from statloom.plans import standins
from statloom.plans.catalog import Tables, query

LONG, DOSE, PHENO, PAIRS = standins.LONG_SQL, standins.DOSE_SQL, standins.PHENO_SQL, standins.PAIRS_SQL
_COV = f"(SELECT iid, x AS c FROM {LONG} WHERE feat = 63)"


def _study(t: Tables, label: int | None = None):
    """(dosages, phenotypes, covariates) under the names of assoc."""
    keep = F.lit(True) if label is None else F.col("label") == label
    g = standins.dosages(t).where(keep).select(F.col("feat").alias("variant"), "iid", "g")
    y = standins.phenotypes(t).where(keep).select(F.col("feat").alias("phenotype"), "iid", "y")
    ids = standins.long(t).where((F.col("feat") == 63) & keep).select("iid", F.array("x").alias("c"))
    return g, y, ids


def _adjusted(t: Tables, label: int | None = None):
    """The study of models with the covariate: feature 63 is no phenotype."""
    g, y, c = _study(t, label)
    return g, y.where("phenotype <> 63"), c


@query(f"SELECT count(*) AS n, round(sum(c), 6) AS s1, round(sum(c * c), 6) AS s2 FROM {_COV}")
def suffstat_covariates(spark, d):
    b = assoc.covariate_block(standins.covariates(Tables(spark, d)), 1)
    return b.select("n", F.round(F.col("a_cov")[1], 6).alias("s1"), F.round(F.col("a_cov")[3], 6).alias("s2"))


@query(f"SELECT feat AS variant, sum(g) AS s_g, round(sum(g * c), 6) AS s_gc, sum(g * g) AS s_gg, round(avg(g) / 2, 6) AS af FROM {DOSE} d JOIN {_COV} v ON d.iid = v.iid GROUP BY feat")
def suffstat_variants(spark, d):
    t = Tables(spark, d)
    s = assoc.variant_sums(_study(t)[0], standins.covariates(t), 1)
    return s.select("variant", F.col("a_test")[0].alias("s_g"), F.round(F.col("a_test")[1], 6).alias("s_gc"), F.col("a_test")[2].alias("s_gg"), F.round("af", 6).alias("af"))


@query(f"SELECT feat AS phenotype, round(sum(y), 6) AS s_y, round(sum(y * c), 6) AS s_yc, round(sum(y * y), 6) AS s_yy FROM {PHENO} d JOIN {_COV} v ON d.iid = v.iid GROUP BY feat")
def suffstat_phenotypes(spark, d):
    t = Tables(spark, d)
    s = assoc.phenotype_sums(_study(t)[1], standins.covariates(t), 1)
    return s.select("phenotype", F.round(F.col("b_cov")[0], 6).alias("s_y"), F.round(F.col("b_cov")[1], 6).alias("s_yc"), F.round("c_yy", 6).alias("s_yy"))


@query(f"SELECT variant, phenotype, round(sum(g * y), 6) AS s_gy FROM {PAIRS} GROUP BY ALL")
def suffstat_pairs(spark, d):
    return assoc.pair_sums(*_study(Tables(spark, d))).select("variant", "phenotype", F.round("b4", 6).alias("s_gy"))


_REG = f"SELECT variant, phenotype, regr_count(y, g) AS n, regr_slope(y, g) AS beta, regr_r2(y, g) AS r2 FROM {PAIRS} GROUP BY ALL"


@query(f"SELECT variant, phenotype, n, round(beta, 6) AS beta, round(sign(beta) * sqrt(r2 * (n - 2) / (1 - r2)), 5) AS t, round(abs(beta / sqrt(r2 * (n - 2) / (1 - r2))), 6) AS se FROM ({_REG})")
def pair_regression(spark, d):
    g, y, _ = _study(Tables(spark, d))
    return assoc.scan_simple(g, y).select("variant", "phenotype", "n", F.round("beta", 6).alias("beta"), F.round("t", 5).alias("t"), F.round("se", 6).alias("se"))


@query(f"SELECT variant, phenotype, round(sign(beta) * sqrt(r2 * (n - 2) / (1 - r2)), 5) AS t FROM ({_REG}) WHERE sqrt(r2 * (n - 2) / (1 - r2)) > 1.5")
def pair_regression_threshold(spark, d):
    t = Tables(spark, d)
    g, y, c = _study(t)
    none = c.select("iid", F.expr("cast(array() as array<double>)").alias("c"))
    return assoc.solve(assoc.study(g, y, none, 0), 1.5).select("variant", "phenotype", F.round("t", 5).alias("t"))


#: One covariate by sweeping it out of both sides (Frisch-Waugh); the covariate itself, feature 63, is no phenotype then.
_SWEPT = f"""(SELECT variant, phenotype, count(*) AS n, regr_sxx(y, g) - pow(regr_sxy(c, g), 2) / regr_sxx(y, c) AS gg,
    regr_sxy(y, g) - regr_sxy(c, g) * regr_sxy(y, c) / regr_sxx(y, c) AS gy, regr_syy(y, g) - pow(regr_sxy(y, c), 2) / regr_sxx(y, c) AS yy
    FROM {PAIRS} p JOIN {_COV} v ON p.iid = v.iid WHERE phenotype <> 63 GROUP BY ALL)"""


@query(f"SELECT variant, phenotype, n, round(gy / gg, 6) AS beta, round(sqrt((yy - gy * gy / gg) / (n - 3) / gg), 6) AS se, round(gy / gg / sqrt((yy - gy * gy / gg) / (n - 3) / gg), 5) AS t FROM {_SWEPT}")
def solve_cov1(spark, d):
    r = assoc.solve(assoc.study(*_adjusted(Tables(spark, d)), 1))
    return r.select("variant", "phenotype", "n", F.round("beta", 6).alias("beta"), F.round("se", 6).alias("se"), F.round("t", 5).alias("t"))


def _cohorts(t: Tables):
    """Statistics of the model with the covariate, a study being a label under ten."""
    mine = F.col("label").between(0, 9)
    g = standins.dosages(t).where(mine).select(F.col("label").alias("study"), F.col("feat").alias("variant"), "iid", "g")
    y = standins.phenotypes(t).where(mine).where("feat <> 63").select(F.col("label").alias("study"), F.col("feat").alias("phenotype"), "iid", "y")
    c = standins.long(t).where("feat = 63").where(mine).select(F.col("label").alias("study"), "iid", F.array("x").alias("c"))
    return assoc.studies(g, y, c, 1)


@query(f"SELECT variant, phenotype, n, round(gy / gg, 6) AS beta FROM {_SWEPT}")
def solve_pooled_cohorts(spark, d):
    return assoc.solve(assoc.pool(_cohorts(Tables(spark, d)))).select("variant", "phenotype", "n", F.round("beta", 6).alias("beta"))


_WITHIN = f"""(SELECT variant, phenotype, sum(n) AS n, count(*) AS studies, sum(gg) AS gg, sum(gy) AS gy, sum(yy) AS yy, sum(gc) AS gc, sum(cy) AS cy, sum(cc) AS cc FROM (
    SELECT label, variant, phenotype, count(*) AS n, regr_sxx(y, g) AS gg, regr_sxy(y, g) AS gy, regr_syy(y, g) AS yy, regr_sxy(c, g) AS gc, regr_sxy(y, c) AS cy, regr_sxx(y, c) AS cc
    FROM {PAIRS} p JOIN {_COV} v ON p.iid = v.iid WHERE phenotype <> 63 GROUP BY ALL) GROUP BY ALL)"""
_WITHIN_FIT = f"(SELECT variant, phenotype, n, n - studies - 2 AS df, gg - gc * gc / cc AS a, gy - gc * cy / cc AS b, yy - cy * cy / cc AS q FROM {_WITHIN})"


@query(f"SELECT variant, phenotype, CAST(df AS DOUBLE) AS df, round(b / a, 6) AS beta, round(b / a / sqrt((q - b * b / a) / df / a), 5) AS t FROM {_WITHIN_FIT}")
def solve_study_intercepts(spark, d):
    """The pooled model with an intercept for each study."""
    r = assoc.solve(assoc.pool_within(_cohorts(Tables(spark, d)), 1))
    return r.select("variant", "phenotype", "df", F.round("beta", 6).alias("beta"), F.round("t", 5).alias("t"))


_COHORT = f"(SELECT label, variant, phenotype, count(*) AS n, regr_slope(y, g) AS beta, abs(regr_slope(y, g)) / sqrt(regr_r2(y, g) * (count(*) - 2) / (1 - regr_r2(y, g))) AS se FROM {PAIRS} GROUP BY ALL)"
_META = f"(SELECT variant, phenotype, sum(n) AS n, count(*) AS k, sum(beta / (se * se)) / sum(1 / (se * se)) AS beta, sqrt(1 / sum(1 / (se * se))) AS se, sum(beta * beta / (se * se)) - pow(sum(beta / (se * se)), 2) / sum(1 / (se * se)) AS q FROM {_COHORT} WHERE se > 0 GROUP BY ALL)"


def _meta(t: Tables):
    r = assoc.pair_regression(standins.pairs(t), "label", "variant", "phenotype")
    return assoc.meta_fixed(r)


@query(f"SELECT variant, phenotype, CAST(n AS BIGINT) AS n, k, round(beta, 6) AS beta, round(se, 6) AS se FROM {_META}")
def meta_ivw(spark, d):
    return _meta(Tables(spark, d)).select("variant", "phenotype", "n", "k", F.round("beta", 6).alias("beta"), F.round("se", 6).alias("se"))


@query(f"SELECT variant, phenotype, round((q - (k - 1)) / q * 100, 4) AS i2_raw, round(greatest((q - (k - 1)) / q * 100, 0), 4) AS i2 FROM {_META}")
def meta_i2(spark, d):
    return _meta(Tables(spark, d)).select("variant", "phenotype", F.round("i2_raw", 4).alias("i2_raw"), F.round("i2", 4).alias("i2"))


_CHI2 = f"(SELECT r2 * (n - 2) / (1 - r2) AS chi2 FROM ({_REG}))"


def _chi2(t: Tables):
    return assoc.scan_simple(*_study(t)[:2]).select((F.col("t") ** 2).alias("chi2"))


@query(f"SELECT round(quantile_cont(chi2, 0.5) / {CHI2_MEDIAN!r}, 6) AS lambda FROM {_CHI2}")
def lambda_median(spark, d):
    return assoc.lambda_median(_chi2(Tables(spark, d))).select(F.round("lambda", 6).alias("lambda"))


@query(f"SELECT round(sum(e * o) / sum(e * e), 6) AS lambda FROM (SELECT pow(q, 2) AS e, chi2 AS o FROM (SELECT chi2, {norm_quantile_sql('p')} AS q FROM (SELECT chi2, 0.5e0 + (n - 0.5e0) / t / 2 AS p FROM (SELECT chi2, row_number() OVER (ORDER BY chi2) AS n, count(*) OVER () AS t FROM {_CHI2}))))")
def lambda_regression(spark, d):
    c = numbering.numbered(_chi2(Tables(spark, d)), "chi2")
    c = c.withColumn("p", 0.5 + (F.col("n") - 0.5) / F.lit(c.count()) / 2).withColumn("e", norm_quantile("p") ** 2)
    return assoc.lambda_regression(c, "e", "chi2").select(F.round("lambda", 6).alias("lambda"))


@query()
def pair_p_values(spark, d):
    r = assoc.scan_simple(*_study(Tables(spark, d))[:2])
    return r.select("variant", "phenotype", F.round(p_from_t("t", (F.col("n") - 2).cast("double")), 8).alias("p"))




@query(f"SELECT l.iid, l.feat, round(x - a - b * c, 6) AS resid FROM {LONG} l JOIN {_COV} v ON l.iid = v.iid JOIN (SELECT feat, regr_intercept(x, c) AS a, regr_slope(x, c) AS b FROM {LONG} l JOIN {_COV} v ON l.iid = v.iid GROUP BY feat) f ON f.feat = l.feat")
def residualise_linear(spark, d):
    t = Tables(spark, d)
    r = assoc.residuals(standins.long(t).select("feat", "iid", "x"), standins.covariates(t), 1)
    return r.select("iid", "feat", F.round("resid", 6).alias("resid"))


@query()
def residualise_transformed(spark, d):
    t = Tables(spark, d)
    first = ranks.inverse_normal(standins.long(t), "x", "feat").select("feat", "iid", F.col("int").alias("x"))
    r = assoc.residuals(first, standins.covariates(t), 1)
    return ranks.inverse_normal(r, "resid", "feat").select("iid", "feat", F.round("int", 6).alias("v"))


@query(f"WITH s AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM (SELECT embedding[1]::DOUBLE AS y, embedding[2]::DOUBLE AS x FROM embeddings)), e AS (SELECT vec_id, embedding[1]::DOUBLE - a - b * embedding[2]::DOUBLE AS e FROM embeddings, s) SELECT vec_id, round(e / (SELECT stddev_samp(e) FROM e), 6) AS accel FROM e")
def age_accel(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", F.col("embedding")[0].cast("double").alias("y"), F.col("embedding")[1].cast("double").alias("x"))
    return assoc.age_acceleration(e, "y", "x").select("vec_id", F.round("accel", 6).alias("accel"))


@query(f"SELECT variant, phenotype, round(regr_slope(z, g), 6) AS beta, round(regr_r2(z, g), 6) AS r2 FROM (SELECT *, abs(y - quantile_cont(y, 0.5) OVER (PARTITION BY variant, phenotype, g)) AS z FROM {PAIRS}) GROUP BY ALL")
def vqtl_drm(spark, d):
    from statloom.operators.variance import deviation

    r = deviation(standins.pairs(Tables(spark, d))).groupBy("variant", "phenotype")
    return r.agg(F.round(F.regr_slope("z", "g"), 6).alias("beta"), F.round(F.regr_r2("z", "g"), 6).alias("r2"))


@query(f"SELECT p.variant, p.phenotype, round(regr_slope(pow(y - a - b * g, 2), g), 6) AS beta FROM {PAIRS} p JOIN (SELECT variant, phenotype, regr_intercept(y, g) AS a, regr_slope(y, g) AS b FROM {PAIRS} GROUP BY ALL) f ON f.variant = p.variant AND f.phenotype = p.phenotype GROUP BY ALL")
def vqtl_svlm(spark, d):
    from statloom.operators.variance import squared_residual

    r = squared_residual(standins.pairs(Tables(spark, d))).groupBy("variant", "phenotype")
    return r.agg(F.round(F.regr_slope("z", "g"), 6).alias("beta"))


@query(f"""WITH z AS (SELECT *, abs(y - quantile_cont(y, 0.5) OVER (PARTITION BY variant, phenotype, g)) AS z FROM {PAIRS}),
    k AS (SELECT variant, phenotype, g, count(*) AS n, avg(z) AS m, sum(z * z) AS s FROM z GROUP BY ALL),
    a AS (SELECT variant, phenotype, count(*) AS k, sum(n) AS n, sum(n * m) / sum(n) AS m, sum(n * m * m) AS nm, sum(s) AS s FROM k GROUP BY ALL)
    SELECT variant, phenotype, round(((nm - n * m * m) / (k - 1)) / ((s - nm) / (n - k)), 5) AS f FROM a""")
def vqtl_bf(spark, d):
    from statloom.operators.variance import brown_forsythe

    return brown_forsythe(standins.pairs(Tables(spark, d))).select("variant", "phenotype", F.round("f", 5).alias("f"))


@query()
def vqtl_bf_p(spark, d):
    from statloom.operators.variance import brown_forsythe

    r = brown_forsythe(standins.pairs(Tables(spark, d)))
    return r.select("variant", "phenotype", F.round(p_from_f("f", F.col("d1").cast("double"), F.col("d2").cast("double")), 8).alias("p"))


def _interaction_sql() -> str:
    """Sums of products, the intercept and the moderator swept out, then the dosage."""
    centred = lambda a, b: f"(sum({a} * {b}) - sum({a}) * sum({b}) / count(*))"
    free = lambda a, b: f"({centred(a, b)} - {centred(a, 'i')} * {centred(b, 'i')} / {centred('i', 'i')})"
    return f"""WITH m AS (SELECT iid, x AS i, x > (SELECT quantile_cont(x, 0.5) FROM {LONG} WHERE feat = 63) AS h FROM {LONG} WHERE feat = 63),
        v AS (SELECT feat FROM (SELECT feat, h, avg(g) / 2 AS p FROM {DOSE} d JOIN m ON m.iid = d.iid GROUP BY ALL) GROUP BY feat HAVING min(least(p, 1 - p)) >= 0.05 AND count(*) = 2),
        s AS (SELECT variant, phenotype, count(*) AS n, {free('g', 'g')} AS xx, {free('g', '(g * i)')} AS xh, {free('(g * i)', '(g * i)')} AS hh, {free('g', 'y')} AS xy, {free('(g * i)', 'y')} AS hy, {free('y', 'y')} AS rest, {centred('y', 'y')} AS yy
              FROM {PAIRS} p JOIN m ON m.iid = p.iid JOIN v ON v.feat = p.variant GROUP BY ALL),
        f AS (SELECT variant, phenotype, n, hh - xh * xh / xx AS hh, hy - xh * xy / xx AS hy, rest - xy * xy / xx AS rest, yy FROM s),
        r AS (SELECT variant, phenotype, n, hy / hh AS beta, hh, rest - hy * hy / hh AS e, yy FROM f)
        SELECT variant, phenotype, n, round(beta, 6) + 0e0 AS beta, round(CASE WHEN e > 1e-12 * yy THEN beta / sqrt(e / (n - 4) / hh) ELSE 0e0 END, 5) + 0e0 AS t FROM r"""


def _interaction(t: Tables):
    g, y, c = _study(t)
    return nulls.interaction(g, y, c.select("iid", F.col("c")[0].alias("i")))


@query(_interaction_sql())
def interaction_scan(spark, d):
    """y ~ g + c + g*c: the product is the tested term and g stands among the covariates, pair by pair in the tiles."""
    r = _interaction(Tables(spark, d))
    return r.select("variant", "phenotype", "n", (F.round("beta", 6) + 0.0).alias("beta"), (F.round("t", 5) + 0.0).alias("t"))


@query()
def interaction_top(spark, d):
    """Each phenotype's best interaction, freed of the number of independent tests on the variant's chromosome."""
    t = Tables(spark, d)
    groups = standins.dosages(t).select(F.col("feat").alias("variant"), (F.col("feat") % 2).alias("chr")).distinct()
    packed = matrix.pack(standins.dosages(t), value="g").select((F.col("feat") % 2).alias("chr"), F.col("feat").alias("pos"), "values")
    tests = selection.effective_tests(packed, "chr")
    r = nulls.top_interactions(_interaction(t), groups, tests)
    return r.select("phenotype", "variant", F.round("t", 5).alias("t"), F.round("p", 8).alias("p"), "tests", F.round("p_adjusted", 7).alias("p_adjusted"))


@query(f"SELECT variant, phenotype, round(gy / gg, 6) AS beta, round(gy / gg / sqrt((yy - gy * gy / gg) / (n - 3) / gg), 5) AS t FROM {_SWEPT} WHERE variant IN (SELECT feat FROM {DOSE} GROUP BY feat HAVING avg(g) / 2 > 0.45e0 AND avg(g) / 2 < 1 - 0.45e0 AND avg(g) / 2 <> 0.5e0)")
def regression_maf(spark, d):
    """The scan in one go, of variants within the limits of allele frequency."""
    return nulls.regression(*_adjusted(Tables(spark, d)), maf=0.45).select("variant", "phenotype", F.round("beta", 6).alias("beta"), F.round("t", 5).alias("t"))


@query()
def permutation_scan(spark, d):
    """Each phenotype's best variant, and how it compares with those of permuted phenotypes."""
    g, y, c = _adjusted(Tables(spark, d))
    n = c.count()
    r = nulls.empirical_p(nulls.permutation_scan(g, y, c, 20, 7), n - 3)
    return r.select("phenotype", "variant", F.round("t", 5).alias("t"), F.round("p", 8).alias("p"), F.round("p_perm", 6).alias("p_perm"), F.round("p_beta", 5).alias("p_beta"))


@query()
def pca_scores(spark, d):
    scores, _ = matrix.leading_components(standins.long(Tables(spark, d)), 3)
    return scores.select("iid", "pc", F.round("score", 5).alias("score"))


@query()
def pca_component_count(spark, d):
    """How many components are kept of those whose shares were looked at."""
    _, shares = matrix.leading_components(standins.long(Tables(spark, d)), 20)
    return spark.createDataFrame([(matrix.component_count(shares), len(shares))], "components int, of int")


@query()
def ld_prune(spark, d):
    g = standins.dosages(Tables(spark, d)).select((F.col("feat") % 2).alias("chr"), F.col("feat").alias("pos"), F.col("feat").alias("variant"), "iid", "g")
    return kinship.prune_ld(g, r2=0.01)


@query()
def relatedness_prune(spark, d):
    return kinship.prune_related(matrix.relatives(standins.dosages(Tables(spark, d)), 0.0, 0.35))


@query(f"SELECT i, j, round((hets - 2 * opp) / (2 * least(hi, hj)) + 0.5 - (hi + hj) / (4 * least(hi, hj)), 6) AS kinship FROM (SELECT a.iid AS i, b.iid AS j, count(*) FILTER (a.g = 1 AND b.g = 1) AS hets, count(*) FILTER (abs(a.g - b.g) = 2) AS opp, count(*) FILTER (a.g = 1) AS hi, count(*) FILTER (b.g = 1) AS hj FROM {DOSE} a JOIN {DOSE} b ON a.feat = b.feat AND a.iid > b.iid GROUP BY ALL)")
def king_kinship(spark, d):
    return kinship.king(standins.dosages(Tables(spark, d))).select("i", "j", F.round("kinship", 6).alias("kinship"))


@query()
def knn_impute(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", F.transform("embedding", lambda v, i: F.when((F.col("vec_id") + i) % 29 != 0, v.cast("double"))).alias("v"))
    return matrix.knn_impute(e, "vec_id", "v").select("vec_id", F.transform("v", lambda x: F.round(x, 6)).alias("v"))


@query(f"SELECT variant, phenotype, round(sum(g * y), 5) AS s_gy FROM {PAIRS} GROUP BY ALL")
def encode_invariant(spark, d):
    """Products of encoded genotypes and phenotypes: those of the plain ones."""
    t = Tables(spark, d)
    g, y, _ = _study(t)
    ids, secret = t.embeddings.select(F.col("vec_id").alias("iid")), b"of the stand-ins, not a secret"
    codes = encoding.encode(g, ids, secret, False, row="variant", value="g").withColumnRenamed("code", "iid")
    others = encoding.encode(y, ids, secret, True, row="phenotype", value="y").withColumnRenamed("code", "iid")
    return assoc.pair_sums(codes, others, codes.select("iid").distinct()).select("variant", "phenotype", F.round("b4", 5).alias("s_gy"))


@query()
def polygenic_residuals(spark, d):
    """Every trait freed of the samples' relationship."""
    t = Tables(spark, d)
    y = standins.phenotypes(t).select("feat", "iid", F.col("y").alias("x"))
    none = t.embeddings.select(F.col("vec_id").alias("iid"), F.expr("cast(array() as array<double>)").alias("c"))
    standard = store.keep(reml.centred_standard(standins.dosages(t), 0.0), "standardised")
    return reml.decorrelated(standard, y, none, 0, probes=10).select("feat", "iid", F.round("resid", 5).alias("resid"), F.round("h2", 4).alias("h2"))


@query()
def cell_deconvolution(spark, d):
    import pandas as pd

    t = Tables(spark, d)
    rows = standins.long(t).where("label < 3").groupBy("label", "feat").agg(F.avg("x").alias("m")).collect()
    ref = pd.DataFrame([(r["feat"], f"c{r['label']}", r["m"]) for r in rows], columns=["feat", "cell", "m"]).pivot(index="feat", columns="cell", values="m")
    return kinship.deconvolve(standins.long(t), ref).select("iid", "cell", F.round("share", 5).alias("share"))


@query(f"SELECT feat, round((avg(x) FILTER (label % 2 = 0) - avg(x) FILTER (label % 2 = 1)) / sqrt(var_samp(x) FILTER (label % 2 = 0) / count(*) FILTER (label % 2 = 0) + var_samp(x) FILTER (label % 2 = 1) / count(*) FILTER (label % 2 = 1)), 5) AS t FROM {LONG} GROUP BY feat")
def welch_t(spark, d):
    s = standins.long(Tables(spark, d)).groupBy("feat", (F.col("label") % 2).alias("s")).agg(F.avg("x").alias("m"), F.var_samp("x").alias("v"), F.count("*").alias("n"))
    a, b = s.where("s = 0").select("feat", "m", (F.col("v") / F.col("n")).alias("u")), s.where("s = 1").select("feat", F.col("m").alias("m1"), (F.col("v") / F.col("n")).alias("u1"))
    return a.join(b, "feat").select("feat", F.round((F.col("m") - F.col("m1")) / F.sqrt(F.col("u") + F.col("u1")), 5).alias("t"))


@query(f"SELECT feat, sum(r) FILTER (label % 2 = 0) - count(*) FILTER (label % 2 = 0) * (count(*) FILTER (label % 2 = 0) + 1) / 2 AS w FROM (SELECT *, rank() OVER (PARTITION BY feat ORDER BY x) + (count(*) OVER (PARTITION BY feat, x) - 1) / 2.0e0 AS r FROM {LONG}) GROUP BY feat")
def wilcoxon_w(spark, d):
    r = standins.long(Tables(spark, d)).select("feat", "label", ranks.average_rank("x", "feat").alias("r"))
    n = F.count_if(F.col("label") % 2 == 0)
    return r.groupBy("feat").agg((F.sum(F.when(F.col("label") % 2 == 0, F.col("r"))) - n * (n + 1) / 2).alias("w"))


@query(f"SELECT variant, phenotype, round(gy / gg, 6) AS beta, round(gy / gg / sqrt((yy - gy * gy / gg) / (n - 3) / gg), 5) AS t FROM {_SWEPT}")
def association_scan(spark, d):
    return assoc.scan(*_adjusted(Tables(spark, d))).select("variant", "phenotype", F.round("beta", 6).alias("beta"), F.round("t", 5).alias("t"))
