"""What stays and what goes, over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.stats import p_from_f
from statloom.operators import assoc, matrix, scores, selection
from statloom.plans import standins
from statloom.plans.catalog import Tables, query

LONG, DOSE, PHENO, PAIRS = standins.LONG_SQL, standins.DOSE_SQL, standins.PHENO_SQL, standins.PAIRS_SQL
_REG = f"(SELECT variant, phenotype, regr_count(y, g) AS n, regr_slope(y, g) AS beta, regr_r2(y, g) AS r2 FROM {PAIRS} GROUP BY ALL)"


def _drop_sql(source: str) -> str:
    return f"""WITH v AS (SELECT * FROM {source}), s AS (SELECT feat, count(*) FILTER (x = 0) AS z, median(x) AS m FROM v GROUP BY feat),
        d AS (SELECT feat FROM s WHERE CASE WHEN (SELECT count(*) FROM s WHERE z > 0) > 1 THEN feat = (SELECT feat FROM s ORDER BY z DESC, feat LIMIT 1) ELSE m = (SELECT min(m) FROM s) END)
        SELECT feat, count(*) AS n, round(sum(x), 5) AS total FROM v WHERE feat NOT IN (SELECT feat FROM d) GROUP BY feat"""


def _totals(df):
    return df.groupBy("feat").agg(F.count("*").alias("n"), F.round(F.sum("x"), 5).alias("total"))


@query(_drop_sql(f"(SELECT feat, g AS x FROM {DOSE})"))
def drop_cell_most_zeros(spark, d):
    return _totals(selection.without_weak_cells(standins.dosages(Tables(spark, d)).select("feat", F.col("g").alias("x")), "feat", "x"))


@query(_drop_sql(f"(SELECT feat, abs(x) + 1 AS x FROM {LONG})"))
def drop_cell_lowest_median(spark, d):
    return _totals(selection.without_weak_cells(standins.long(Tables(spark, d)).select("feat", (F.abs("x") + 1).alias("x")), "feat", "x"))


_PCS = f"(SELECT iid, max(x) FILTER (feat = 0) AS a, max(x) FILTER (feat = 1) AS b FROM {LONG} GROUP BY iid)"
_SCREEN = f"""(SELECT feat, n, aa, bb, aa * bb - ab * ab AS det, (bb * ay - ab * cy) / (aa * bb - ab * ab) AS b1, (aa * cy - ab * ay) / (aa * bb - ab * ab) AS b2, ay, cy, yy FROM (
    SELECT feat, count(*) AS n, regr_sxx(y, a) AS aa, regr_sxx(y, b) AS bb, regr_sxy(a, b) AS ab, regr_sxy(y, a) AS ay, regr_sxy(y, b) AS cy, regr_syy(y, a) AS yy
    FROM {PHENO} p JOIN {_PCS} c ON c.iid = p.iid GROUP BY feat))"""


def _screened(spark, d, pull=0.0):
    """Traits screened against two components; `pull` of the first is added to trait 40."""
    e = Tables(spark, d).embeddings
    pcs = e.select(F.col("vec_id").alias("iid"), F.slice("embedding", 1, 2).alias("c"))
    y = standins.phenotypes(Tables(spark, d)).select(F.col("feat").alias("trait"), "iid", "y").join(pcs, "iid")
    y = y.select("trait", "iid", (F.col("y") + F.when(F.col("trait") == 40, F.col("c")[0] * pull).otherwise(0.0)).alias("y"))
    return selection.screen_components(pcs, y, 2)


@query(f"""WITH s AS (SELECT *, sqrt((yy - b1 * ay - b2 * cy) / (n - 3) / det) AS e FROM {_SCREEN})
    SELECT feat AS trait, 1 AS pc, n, round(b1, 6) AS beta, round(b1 / (e * sqrt(bb)), 5) AS t FROM s UNION ALL SELECT feat, 2, n, round(b2, 6), round(b2 / (e * sqrt(aa)), 5) FROM s""")
def screen_components(spark, d):
    return _screened(spark, d).select("trait", "pc", "n", F.round("beta", 6).alias("beta"), F.round("t", 5).alias("t"))


@query()
def related_components(spark, d):
    """At 5 % over the number of traits, one of which leans on the first component."""
    return selection.related_components(_screened(spark, d, 1.0))


@query(f"SELECT phenotype, count(*) AS n FROM (SELECT DISTINCT feat AS phenotype FROM {PHENO}) WHERE phenotype NOT IN (SELECT phenotype FROM {_REG} WHERE sqrt(r2 * (n - 2) / (1 - r2)) > 2.5 AND NOT (variant % 6 = 5 AND variant BETWEEN 10 AND 20)) GROUP BY ALL")
def drop_driven_components(spark, d):
    """Features as components: those go that have a hit outside a region."""
    t = Tables(spark, d)
    g, y = standins.dosages(t).select(F.col("feat").alias("variant"), "iid", "g"), standins.phenotypes(t).select(F.col("feat").alias("phenotype"), "iid", "y")
    hits = assoc.scan_simple(g, y, 2.5).withColumns({"chr": (F.col("variant") % 6).cast("string"), "pos": F.col("variant")})
    hits = hits.where(selection.outside(("5", 10, 20), "chr", "pos"))
    return selection.without_driven(y.select("phenotype").distinct(), hits, "phenotype").groupBy("phenotype").agg(F.count("*").alias("n"))


def _fits(spark, d):
    t = Tables(spark, d)
    return assoc.scan_simple(standins.dosages(t).select(F.col("feat").alias("variant"), "iid", "g"), standins.phenotypes(t).select(F.col("feat").alias("phenotype"), "iid", "y"))


@query(f"SELECT variant, phenotype, n, round(r2, 7) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 7) AS adjusted, round(r2 * (n - 2) / (1 - r2), 5) AS f FROM {_REG}")
def model_summary(spark, d):
    adjusted = 1 - (1 - F.col("r2")) * (F.col("n") - 1) / (F.col("n") - 2)
    return _fits(spark, d).select("variant", "phenotype", "n", F.round("r2", 7).alias("r2"), F.round(adjusted, 7).alias("adjusted"), F.round(F.col("t") ** 2, 5).alias("f"))


@query(f"SELECT variant, phenotype, n, round(beta, 6) AS b, round(abs(beta) / sqrt(r2 / ((1 - r2) / (n - 2))), 6) AS se FROM {_REG}")
def correlation_association(spark, d):
    """Slope from the correlation and its error from F, whose p takes n - 1 degrees of freedom."""
    r = assoc.by_correlation(_fits(spark, d))
    return r.select("variant", "phenotype", "n", F.round("b", 6).alias("b"), F.round("se", 6).alias("se"))


@query(f"SELECT iid, round(x * (SELECT CASE WHEN avg(x) FILTER (label % 2 = 1) < avg(x) FILTER (label % 2 = 0) THEN -1 ELSE 1 END FROM {LONG} WHERE feat = 3), 6) AS x FROM {LONG} WHERE feat = 3")
def orient_component(spark, d):
    s = standins.long(Tables(spark, d)).where("feat = 3").withColumn("sex", F.col("label") % 2)
    return selection.oriented(s, "x", "sex", 1, 0).select("iid", F.round("x", 6).alias("x"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 20 <> 7")
def drop_sex_mismatches(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", (F.col("c_custkey") % 2).alias("sex"))
    c = c.withColumn("predicted", F.when(F.col("c_custkey") % 20 == 7, 1 - F.col("sex")).otherwise(F.col("sex")))
    return selection.without_mismatches(c, "sex", "predicted").select("c_custkey")


@query(f"""SELECT iid, n, round((o - e) / (n - e), 6) AS f, CASE WHEN (o - e) / (n - e) > 0.8 THEN 1 WHEN (o - e) / (n - e) < 0.2 THEN 2 ELSE 0 END AS sex FROM (
    SELECT iid, count(*) AS n, count(*) FILTER (g <> 1) AS o, sum(1 - 2 * p * (1 - p)) AS e FROM {DOSE} d JOIN (SELECT feat, avg(g) / 2 AS p FROM {DOSE} GROUP BY feat) f ON f.feat = d.feat WHERE p > 0 AND p < 1 GROUP BY iid)""")
def sex_by_homozygosity(spark, d):
    s = selection.x_homozygosity(standins.dosages(Tables(spark, d)).select("iid", F.col("feat").alias("variant"), "g"))
    return s.select("iid", "n", F.round("f", 6).alias("f"), "sex")


@query(f"SELECT feat, count(*) AS n FROM {LONG} WHERE feat % 5 <> 2 GROUP BY feat")
def drop_empty_features(spark, d):
    x = standins.long(Tables(spark, d)).withColumn("x", F.when(F.col("feat") % 5 == 2, F.when(F.col("iid") % 2 == 0, float("nan"))).otherwise(F.col("x")))
    return selection.without_empty(x, "feat", "x").groupBy("feat").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_size FROM part WHERE (p_size, p_partkey) >= (SELECT (p_size, p_partkey) FROM part WHERE p_partkey = 40) AND (p_size, p_partkey) <= (SELECT (p_size, p_partkey) FROM part WHERE p_partkey = 41) OR (p_size, p_partkey) >= (SELECT (p_size, p_partkey) FROM part WHERE p_partkey = 41) AND (p_size, p_partkey) <= (SELECT (p_size, p_partkey) FROM part WHERE p_partkey = 40)")
def variant_interval(spark, d):
    """From part 40 to 41, or the other way round, by size and key."""
    p = Tables(spark, d).part.select("p_partkey", "p_size")
    one = selection.between_variants(p, "p_partkey", 40, 41, "p_size", "p_partkey")
    return one.unionByName(selection.between_variants(p, "p_partkey", 41, 40, "p_size", "p_partkey"))


_PROBES = "(SELECT s_suppkey, s_nationkey AS chr, s_suppkey % 10 AS bp, substr('ACGT', CAST(1 + s_suppkey % 4 AS INTEGER), 1) AS a1, substr('ACGT', CAST(1 + (s_suppkey + 1) % 4 AS INTEGER), 1) AS a2 FROM supplier)"
_PANEL = "(SELECT p_partkey AS idx, p_size % 25 AS chr, p_partkey % 10 AS bp, substr('ACGT', CAST(1 + p_partkey // 10 % 4 AS INTEGER), 1) AS a1, substr('ACGT', CAST(1 + (p_partkey // 10 + 1 + 2 * (p_partkey // 40 % 2)) % 4 AS INTEGER), 1) AS a2 FROM part)"


def _found_sql(on: str) -> str:
    return f"""SELECT s_suppkey, coalesce(min(p.idx), -1) AS idx, coalesce(arg_min(CASE WHEN p.a1 = s.a1 AND p.a2 = s.a2 THEN 1 ELSE -1 END, p.idx), 0) AS flip FROM {_PROBES} s
        LEFT JOIN {_PANEL} p ON {on} AND (p.a1 = s.a1 AND p.a2 = s.a2 OR p.a1 = s.a2 AND p.a2 = s.a1) GROUP BY s_suppkey"""


def _panel(t: Tables):
    letter = lambda n: F.substring(F.lit("ACGT"), (1 + n % 4).cast("int"), F.lit(1))
    s, p = F.col("s_suppkey"), F.floor(F.col("p_partkey") / 10)
    probes = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("chr"), (s % 10).alias("bp"), letter(s).alias("a1"), letter(s + 1).alias("a2"))
    second = p + 1 + 2 * (F.floor(F.col("p_partkey") / 40) % 2)
    return probes, t.part.select(F.col("p_partkey").alias("idx"), (F.col("p_size") % 25).alias("chr"), (F.col("p_partkey") % 10).alias("bp"), letter(p).alias("a1"), letter(second).alias("a2"))


@query(_found_sql("p.chr = s.chr AND p.bp = s.bp"))
def lookup_by_position(spark, d):
    return selection.lookup(*_panel(Tables(spark, d)), ["chr", "bp"], "s_suppkey")


@query(_found_sql("p.idx % 64 = s.s_suppkey % 64"))
def lookup_by_name(spark, d):
    probes, panel = _panel(Tables(spark, d))
    name = lambda c: F.concat(F.lit("rs"), F.col(c) % 64)
    return selection.lookup(probes.withColumn("id", name("s_suppkey")), panel.withColumn("id", name("idx")), ["id"], "s_suppkey")


_INV = f"""(SELECT inversion, n_snps, iid, CASE WHEN top - mid > 0.01 THEN CASE WHEN nn = top THEN 0 WHEN ni = top THEN 1 ELSE 2 END END AS g FROM (
    SELECT *, greatest(nn, ni, ii) AS top, nn + ni + ii - greatest(nn, ni, ii) - least(nn, ni, ii) AS mid FROM (
    SELECT inversion, inversion % 8 + 1 AS n_snps, iid, a + CASE WHEN inversion % 7 = 3 THEN 10 ELSE 0 END AS nn, CASE WHEN inversion % 5 = 4 AND iid % 3 = 0 THEN c ELSE b END AS ni, c AS ii FROM (
    SELECT feat // 3 AS inversion, iid, max(x) FILTER (feat % 3 = 0) AS a, max(x) FILTER (feat % 3 = 1) AS b, max(x) FILTER (feat % 3 = 2) AS c FROM {LONG} WHERE feat < 63 GROUP BY ALL))))"""


@query(f"""WITH s AS (SELECT inversion, max(n_snps) AS n_snps, count(g) AS n, min(g) AS lo, max(g) AS hi, avg(g) / 2 * 100 AS percent FROM {_INV} GROUP BY inversion)
    SELECT inversion, CASE WHEN n_snps <= 3 THEN 'Not enough SNPs' WHEN n <= 0.9 * (SELECT max(n) FROM s WHERE n_snps > 3) THEN 'Bad genotyping' WHEN lo = hi AND lo <> 1 THEN 'Invariant Inversions' END AS reason,
    round(percent, 4) AS percent, n_snps, n FROM s""")
def inversion_summary(spark, d):
    e = Tables(spark, d).embeddings.select(F.col("vec_id").alias("iid"), F.col("embedding").cast("array<double>").alias("e"))
    rows = e.select("iid", "e", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(20).cast("long"))).alias("inversion"))
    at = lambda k: F.element_at("e", (F.col("inversion") * 3 + k + 1).cast("int"))
    s = rows.select("iid", "inversion", (F.col("inversion") % 8 + 1).alias("n_snps"), (at(0) + F.when(F.col("inversion") % 7 == 3, 10.0).otherwise(0.0)).alias("nn"),
                    F.when((F.col("inversion") % 5 == 4) & (F.col("iid") % 3 == 0), at(2)).otherwise(at(1)).alias("ni"), at(2).alias("ii"))
    out = selection.inversion_summary(selection.inversion_calls(s, 0.01))
    return out.select("inversion", "reason", F.round("percent", 4).alias("percent"), "n_snps", "n")


@query("SELECT c_custkey, CASE WHEN c_custkey % 9 = 4 THEN 'remove_' ELSE '' END || c_name AS name FROM customer")
def mark_removed(spark, d):
    """Subjects on a list are renamed, so that no join finds them."""
    return Tables(spark, d).customer.select("c_custkey", F.concat(F.when(F.col("c_custkey") % 9 == 4, "remove_").otherwise(""), "c_name").alias("name"))


@query("SELECT c_custkey, CAST('0x' || substr(md5(upper(c_name)), 1, 15) AS BIGINT) AS hash FROM customer")
def fn_string_hash(spark, d):
    """A number of 60 bits for an allele or a name, the same in every engine."""
    return Tables(spark, d).customer.select("c_custkey", F.conv(F.substring(F.md5(F.upper("c_name")), 1, 15), 16, 10).cast("long").alias("hash"))


@query(f"""SELECT iid, round(sum(x) FILTER (feat IN (0, 1)), 6) AS "Bcells_predicted", round(sum(x) FILTER (feat BETWEEN 2 AND 6), 6) AS "Tcells_predicted", round(sum(x) FILTER (feat = 7), 6) AS "Mono_predicted" FROM {LONG} GROUP BY iid""")
def cell_rollup(spark, d):
    e = Tables(spark, d).embeddings.select(F.col("vec_id").alias("iid"), *[F.col("embedding")[i].cast("double").alias(f"c{i}") for i in range(8)])
    wide = scores.rolled_up(e, {"Bcells": ["c0", "c1"], "Tcells": ["c2", "c3", "c4", "c5", "c6"], "Mono": ["c7"]}, "_predicted", "iid")
    return wide.select("iid", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


_HAVE = "NOT ((variant + label) % 4 = 0 OR (phenotype + label) % 5 = 1)"


@query(f"SELECT variant, phenotype, CAST(count(*) AS BIGINT) AS n, count(DISTINCT label) AS cohorts, round(regr_slope(y, g), 6) AS beta FROM {PAIRS} WHERE {_HAVE} GROUP BY ALL")
def solve_missing_cohorts(spark, d):
    """Cohorts that lack a variant or a phenotype add nothing to the pairs' sums; n is that of the cohorts present."""
    t = Tables(spark, d)
    mine = F.col("label").between(0, 9)
    g = standins.dosages(t).where(mine).where("(feat + label) % 4 <> 0").select(F.col("feat").alias("variant"), "iid", F.col("label").alias("study"), "g")
    y = standins.phenotypes(t).where(mine).where("(feat + label) % 5 <> 1").select(F.col("feat").alias("phenotype"), "iid", F.col("label").alias("study"), "y")
    none = t.embeddings.where(mine).select(F.col("label").alias("study"), F.col("vec_id").alias("iid"), F.expr("cast(array() as array<double>)").alias("c"))
    both = assoc.studies(g, y, none, 0)
    present = both.groupBy("variant", "phenotype").agg(F.count("*").alias("cohorts"))
    r = assoc.solve(assoc.pool(both)).join(present, ["variant", "phenotype"])
    return r.select("variant", "phenotype", "n", "cohorts", F.round("beta", 6).alias("beta"))


@query()
def effective_tests(spark, d):
    """Of the variants on each of two chromosomes, in windows of ten."""
    p = matrix.pack(standins.dosages(Tables(spark, d)), value="g").select((F.col("feat") % 2).alias("chr"), F.col("feat").alias("pos"), "values")
    return selection.effective_tests(p, "chr", window=10)


@query()
def correlation_p_values(spark, d):
    r = assoc.by_correlation(_fits(spark, d))
    return r.select("variant", "phenotype", F.round(p_from_f("f", F.lit(1.0), (F.col("n") - 1).cast("double")), 8).alias("p"))
