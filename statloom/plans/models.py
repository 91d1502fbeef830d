"""Models over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.stats import norm_quantile_sql
from statloom.operators import adjustment, assoc, kinship, matrix, models, normality, relatives, reml, store, surrogate
from statloom.plans import standins
from statloom.plans.catalog import Tables, query
from statloom.sources import packed
from statloom.streaming import partials

PAIRS, LONG = standins.PAIRS_SQL, standins.LONG_SQL


#: Relationship from which stand-ins count as relatives: few variants make it noisy, and families stay small.
FAMILY = 0.8
#: Fixed effects of the adjusted models: leading genetic components.
COMPONENTS = 20


def _models(t: Tables):
    """(0 and no covariates, 1 and genetic components) as (flag, covariates, their number)."""
    ids = t.embeddings.select(F.col("vec_id").alias("iid"))
    yield 0, ids.select("iid", F.expr("cast(array() as array<double>)").alias("c")), 0
    pcs = store.keep(reml.genetic_components(reml.centred_standard(standins.dosages(t), 0.0), COMPONENTS), "genetic-components")
    yield 1, pcs, COMPONENTS


@query(f"SELECT variant, phenotype, regr_count(y, g) AS n, round(regr_slope(y, g), 6) AS beta FROM {PAIRS} GROUP BY ALL")
def glm_linear(spark, d):
    r = models.glm(standins.pairs(Tables(spark, d)), "variant", "phenotype")
    return r.select("variant", "phenotype", "n", F.round("beta", 6).alias("beta"))


@query()
def glm_logistic(spark, d):
    p = standins.pairs(Tables(spark, d)).withColumn("y", F.when(F.col("y") > 0, 2.0).otherwise(1.0))
    return models.glm(p, "variant", "phenotype", kind="logistic").select("variant", "phenotype", F.round("beta", 5).alias("beta"), F.round("p", 6).alias("p"))


@query()
def mixed_model_scan(spark, d):
    """Every variant with every trait under a sparse relationship, without and with genetic components."""
    t = Tables(spark, d)
    g, y = standins.dosages(t).select(F.col("feat").alias("variant"), "iid", "g"), standins.phenotypes(t).select(F.col("feat").alias("phenotype"), "iid", "y")
    edges = store.keep(_sparse(t), "sparse-relationship")
    members = store.keep(relatives.families(edges), "families")
    out, turned, before = [], None, None
    for adjusted, c, k in _models(t):
        there = c.where("c is not null").select("iid")
        if before is None or not before.exceptAll(there).isEmpty() or not there.exceptAll(before).isEmpty():
            turned, before = relatives.rotation_of(edges, members, there), there  # the families of both models' samples are mostly the same
        scan, _ = relatives.mixed_scan(g, y, c, k, edges, members, turned)
        out.append(scan.select(F.lit(adjusted).alias("adjusted"), "variant", "phenotype", F.round("beta", 5).alias("beta"), F.round("t", 4).alias("t")))
    return out[0].unionByName(out[1])


@query()
def heritability(spark, d):
    """The variants' share of every trait by REML, without and with genetic components."""
    t = Tables(spark, d)
    y = standins.phenotypes(t).select("feat", "iid", F.col("y").alias("x"))
    standard = store.keep(reml.centred_standard(standins.dosages(t), 0.0), "standardised")
    out = [reml.heritability(standard, y, c, k, probes=10).select(F.lit(a).alias("adjusted"), "feat", F.round("h2", 4).alias("h2"), F.round("se", 4).alias("se"), F.round("lrt", 3).alias("lrt")) for a, c, k in _models(t)]
    return out[0].unionByName(out[1])


_Z = f"(SELECT iid, feat, (g - 2 * p) / sqrt(2 * p * (1 - p)) AS z FROM (SELECT iid, feat, g, avg(g) OVER (PARTITION BY feat) / 2 AS p FROM {standins.DOSE_SQL}) WHERE p > 0 AND p < 1)"
_SPARSE = f"(SELECT a.iid AS i, b.iid AS j, sum(a.z * b.z) / (SELECT count(DISTINCT feat) FROM {_Z}) AS grm FROM {_Z} a JOIN {_Z} b ON a.feat = b.feat AND a.iid >= b.iid GROUP BY ALL HAVING a.iid = b.iid OR grm >= {FAMILY}e0)"


def _sparse(t: Tables):
    # the kernel's bound is a little under the cutoff, which sparse() applies to what leaves it
    return relatives.sparse(matrix.relationship(standins.dosages(t), 0.0, FAMILY - 1e-9, own=True), FAMILY)


@query(f"SELECT i, j, round(grm, 6) AS grm FROM {_SPARSE}")
def sparse_relationship(spark, d):
    return _sparse(Tables(spark, d)).select("i", "j", F.round("grm", 6).alias("grm"))


@query(f"""WITH RECURSIVE e AS MATERIALIZED (SELECT i, j FROM {_SPARSE}), b AS (SELECT i, j FROM e UNION SELECT j, i FROM e),
    r AS (SELECT i, i AS k FROM b UNION SELECT r.i, b.j FROM r JOIN b ON b.i = r.k)
    SELECT i AS iid, min(k) AS family FROM r GROUP BY i""")
def relative_families(spark, d):
    return relatives.families(store.keep(_sparse(Tables(spark, d)), "sparse-relationship"))


@query()
def unrelated_components(spark, d):
    """Components of the samples without close kinship, and the others' projection."""
    t = Tables(spark, d)
    # few variants make kinship noisy: a bound that leaves a good part of the samples
    kin = store.keep(kinship.king_relatives(standins.dosages(t), 0.3, 0.3), "kinship")
    pairs = kin.where("j is not null").select("i", "j")
    about = kin.where("j is null").groupBy("i").agg(F.sum("d").alias("d"), F.sum("s").alias("s"))
    split = store.keep(relatives.unrelated_of(pairs, about, t.embeddings.select(F.col("vec_id").alias("iid"))), "unrelated")
    scores = relatives.pc_air(standins.dosages(t), split, 3, 0.0)
    return scores.select("iid", "unrelated", F.transform("c", lambda v: F.round(F.abs(v), 4)).alias("c"))


_ROLES = f"(SELECT iid, feat, x, label % 2 AS v, c FROM {LONG} l JOIN (SELECT iid AS id, x AS c FROM {LONG} WHERE feat = 63) k ON k.id = l.iid WHERE feat < 63)"


def _ewas(t: Tables):
    """(values, design): all features but the covariate, which is the last; the label's parity is the variable of interest."""
    long = standins.long(t)
    design = long.where("feat = 63").select("iid", F.array("x", (F.col("label") % 2).cast("double")).alias("c"))
    return long.where("feat < 63").select("feat", "iid", "x"), design


@query()
def ewas_sva(spark, d):
    values, design = _ewas(Tables(spark, d))
    out = surrogate.ewas(values, design, 1, rounds=2)
    return out.select("model", "feat", F.round("beta", 5).alias("beta"), F.round("t", 3).alias("t"))


@query(f"""WITH s AS (SELECT feat, count(*) AS n, regr_sxx(x, v) AS vv, regr_sxy(x, v) AS vx, regr_syy(x, v) AS xx, regr_sxx(x, c) AS cc, regr_sxy(x, c) AS cx, regr_sxy(c, v) AS vc FROM {_ROLES} GROUP BY feat),
    m AS (SELECT 'none' AS model, feat, vv AS a, vx AS b, xx AS q, n - 2 AS df FROM s UNION ALL SELECT 'all', feat, vv - vc * vc / cc, vx - vc * cx / cc, xx - cx * cx / cc, n - 3 FROM s)
    SELECT model, feat, round(b / a, 6) AS beta, round(b / a / sqrt((q - b * b / a) / df / a), 4) AS t FROM m""")
def ewas_covariates(spark, d):
    """The association of every feature with the variable, without and with the covariate."""
    values, design = _ewas(Tables(spark, d))
    return surrogate.ewas(values, design, 1, number=0).where("model <> 'sva'").select("model", "feat", F.round("beta", 6).alias("beta"), F.round("t", 4).alias("t"))


@query()
def mediation(spark, d):
    e = Tables(spark, d).embeddings
    rows = e.select((F.col("label") % 3).alias("k"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xmy")])
    return models.mediation(rows, "k").select("k", F.round("acme", 6).alias("acme"), F.round("total", 6).alias("total"), F.round("p", 4).alias("p"))


@query()
def density_by_sex(spark, d):
    e = Tables(spark, d).embeddings.select((F.col("label") % 2).alias("sex"), F.col("embedding")[0].cast("double").alias("x"))
    return models.density(e, "x", "sex").select("sex", F.round("at", 6).alias("at"), F.round("density", 5).alias("density"))


#: Clocks over the features: name, features asked for, least number and share of them that must be there, whether in years.
_CLOCKS = (("first", range(40), 1, 0.0, True), ("second", [*range(46), *range(100, 130)], 50, 0.0, False), ("third", [*range(50), *range(100, 110)], 1, 0.7, False))
_WEIGHTS = " UNION ALL ".join(f"SELECT '{n}' AS clock, unnest({list(f)}) AS feat, {least} AS least, {share}e0 AS share, {years} AS years" for n, f, least, share, years in _CLOCKS)
_PRED = f"""(SELECT clock, iid, CASE WHEN any_value(years) THEN CASE WHEN s < 0 THEN 21 * exp(s) - 1 ELSE 21 * s + 20 END ELSE s END AS pred FROM (
    SELECT clock, iid, sum(((feat * 37) % 11 - 5) / 10e0 * x) AS s, any_value(years) AS years, any_value(least) AS least, any_value(share) AS share, count(*) AS found FROM ({_WEIGHTS}) w JOIN {LONG} l USING (feat) GROUP BY ALL) f
    WHERE found >= least AND found >= share * (SELECT count(*) FROM ({_WEIGHTS}) a WHERE a.clock = f.clock) GROUP BY clock, iid, s)"""
_ABOUT = f"(SELECT a.iid, a.x AS c1, b.x AS c2 FROM {LONG} a JOIN {LONG} b ON b.iid = a.iid AND b.feat = 61 WHERE a.feat = 60)"


@query(f"""WITH p AS (SELECT clock, p.iid, pred, c1, c2 FROM {_PRED} p JOIN {_ABOUT} a ON a.iid = p.iid),
    s AS (SELECT clock, avg(pred) AS m, avg(c1) AS m1, avg(c2) AS m2, regr_sxx(pred, c1) AS a, regr_sxx(pred, c2) AS b, regr_sxy(c2, c1) AS ab, regr_sxy(pred, c1) AS ya, regr_sxy(pred, c2) AS yb FROM p GROUP BY clock),
    e AS (SELECT p.clock, iid, pred, pred - m - ya / a * (c1 - m1) AS e1, pred - m - (ya * b - yb * ab) / (a * b - ab * ab) * (c1 - m1) - (yb * a - ya * ab) / (a * b - ab * ab) * (c2 - m2) AS e2 FROM p JOIN s ON s.clock = p.clock)
    SELECT clock, iid, round(pred, 5) AS pred, round(e1 / stddev_samp(e1) OVER w, 5) AS pred_sd, round(e2 / stddev_samp(e2) OVER w, 5) AS pred_ss_sd FROM e WINDOW w AS (PARTITION BY clock)""")
def clock_acceleration(spark, d):
    """Ages by three clocks, of which one finds too few of its features, and their accelerations without and with smoking."""
    long = standins.long(Tables(spark, d)).select("feat", "iid", "x")
    pred = None
    for name, feats, least, share, years in _CLOCKS:
        w = spark.createDataFrame([(f, ((f * 37) % 11 - 5) / 10) for f in feats], "feat int, w double")
        p = adjustment.clock(long, w, 0.0, least, share, years).select(F.lit(name).alias("clock"), "iid", "pred")
        pred = p if pred is None else pred.unionByName(p)
    about = long.where("feat in (60, 61)").groupBy("iid").agg(F.transform(F.sort_array(F.collect_list(F.struct("feat", "x"))), lambda s: s["x"]).alias("c"))
    r = adjustment.acceleration(pred, about, 1)
    return r.select("clock", "iid", *[F.round(c, 5).alias(c) for c in ("pred", "pred_sd", "pred_ss_sd")])


@query(f"SELECT l.iid, l.feat, round(x - a - b * c, 6) AS x FROM {LONG} l JOIN (SELECT iid, x AS c FROM {LONG} WHERE feat = 63) v ON l.iid = v.iid JOIN (SELECT feat, regr_intercept(x, c) AS a, regr_slope(x, c) AS b FROM {LONG} l JOIN (SELECT iid, x AS c FROM {LONG} WHERE feat = 63) v ON l.iid = v.iid GROUP BY feat) f ON f.feat = l.feat WHERE l.feat < 63")
def adjust_untransformed(spark, d):
    t = Tables(spark, d)
    values = standins.long(t).where("feat < 63").select("feat", "iid", "x")
    return adjustment.adjust(values, standins.covariates(t), 1, "untransformed").select("iid", "feat", F.round("x", 6).alias("x"))


@query()
def adjust_twice(spark, d):
    """Transformed, freed of the covariate, then of leading components without being transformed before."""
    t = Tables(spark, d)
    first = store.keep(adjustment.adjust(standins.long(t).where("feat < 63").select("feat", "iid", "x"), standins.covariates(t), 1, "transformed"), "adjusted")
    pcs = store.keep(reml.genetic_components(first, 5), "components")
    return adjustment.adjust(first, pcs, 5, "transformed", again=True).select("iid", "feat", F.round("x", 4).alias("x"))


@query(f"SELECT feat, count(*) AS n, round(pow(sum(a * x), 2) / sum(pow(x - mean, 2)), 6) AS w FROM (SELECT *, CASE WHEN i = n THEN l1 WHEN i = n - 1 THEN l2 WHEN i = 1 THEN -l1 WHEN i = 2 THEN -l2 ELSE m * sqrt((1 - 2 * l1 * l1 - 2 * l2 * l2) / (mm - 2 * m1 * m1 - 2 * m2 * m2)) END AS a FROM (SELECT *, m1 / sqrt(mm) + 0.221157e0 * u - 0.147981e0 * u * u - 2.071190e0 * pow(u, 3) + 4.434685e0 * pow(u, 4) - 2.706056e0 * pow(u, 5) AS l1, m2 / sqrt(mm) + 0.042981e0 * u - 0.293762e0 * u * u - 1.752461e0 * pow(u, 3) + 5.682633e0 * pow(u, 4) - 3.582633e0 * pow(u, 5) AS l2 FROM (SELECT *, sum(m * m) OVER v AS mm, max(m) FILTER (i = n) OVER v AS m1, max(m) FILTER (i = n - 1) OVER v AS m2, 1 / sqrt(n) AS u FROM (SELECT *, {norm_quantile_sql('q')} AS m FROM (SELECT *, (i - 0.375e0) / (n + 0.25e0) AS q FROM (SELECT feat, x, row_number() OVER (PARTITION BY feat ORDER BY x) AS i, count(*) OVER (PARTITION BY feat) AS n, avg(x) OVER (PARTITION BY feat) AS mean FROM {LONG}))) WINDOW v AS (PARTITION BY feat)))) GROUP BY feat")
def shapiro_wilk(spark, d):
    return normality.shapiro_wilk(standins.long(Tables(spark, d)), "x", "feat").select("feat", "n", F.round("w", 6).alias("w"))


@query(f"SELECT phenotype, variant, round(CAST(CAST(beta AS FLOAT) AS DOUBLE), 4) AS beta, row_number() OVER (ORDER BY phenotype, variant) - 1 AS n FROM (SELECT variant, phenotype, regr_slope(y, g) AS beta FROM {PAIRS} GROUP BY ALL)")
def packed_results(spark, d):
    """The scan's results written as packed files and read back by byte ranges."""
    t = Tables(spark, d)
    g, y = standins.dosages(t).select(F.col("feat").alias("variant"), "iid", "g"), standins.phenotypes(t).select(F.col("feat").alias("phenotype"), "iid", "y")
    path = store.new_path(spark, "packed")
    packed.write_packed(assoc.scan_simple(g, y), path)
    return packed.read_packed(spark, path).select("phenotype", "variant", F.round(F.col("beta").cast("double"), 4).alias("beta"), "n")


@query()
def mixture_by_sex(spark, d):
    """Two components of the first feature by the label's parity, and where to cut between them."""
    e = Tables(spark, d).embeddings.select((F.col("label") % 2).alias("sex"), F.col("embedding")[0].cast("double").alias("x"))
    return models.mixture(e, "x", "sex").select("sex", *[F.round(f"{c}{i}", 4).alias(f"{c}{i}") for i in (1, 2) for c in "wms"], F.round("cut", 4).alias("cut"), F.round("dip", 4).alias("dip"))


@query(f"SELECT round(sum(x), 5) AS total, count(*) AS n FROM {LONG} WHERE feat = 0")
def permutation_null(spark, d):
    """Permuted values: their sum and number stay."""
    x = standins.long(Tables(spark, d)).where("feat = 0").select("iid", "x")
    return models.permute(x, "x", "iid", 5).agg(F.round(F.sum("x"), 5).alias("total"), F.count("*").alias("n"))


@query(f"WITH r AS (SELECT iid, feat, x, row_number() OVER (PARTITION BY iid ORDER BY x, feat) AS k FROM {LONG}), m AS (SELECT k, avg(x) AS m FROM r GROUP BY k) SELECT iid, feat, round(m, 6) AS x FROM r JOIN m ON r.k = m.k")
def quantile_normalise(spark, d):
    return models.quantile_normalise(standins.long(Tables(spark, d)).select("iid", "feat", "x")).select("iid", "feat", F.round("x", 6).alias("x"))


@query(f"SELECT variant, phenotype, count(*) AS n, round(regr_slope(y, g), 6) AS beta FROM {PAIRS} GROUP BY ALL")
def stream_partials_batch(spark, d):
    """The streaming sums, in batch."""
    s = partials.solve_partials(partials.variant_partials(standins.pairs(Tables(spark, d))))
    return s.select("variant", "phenotype", "n", F.round("beta", 6).alias("beta"))


@query()
def normalised_traits(spark, d):
    e = Tables(spark, d).embeddings
    wide = e.select(F.col("vec_id").alias("iid"), (F.col("label") % 2).alias("sex"), F.col("embedding")[0].cast("double").alias("age"), F.col("embedding")[1].cast("double").alias("smoking"), F.posexplode(F.slice("embedding", 3, 62)).alias("trait", "y"))
    return models.normalise_trait(wide.withColumn("y", F.col("y").cast("double")), "trait").select("trait", "iid", F.round("v", 5).alias("v"))
