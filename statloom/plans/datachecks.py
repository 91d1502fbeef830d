"""The data checks over the driver's tables in the roles of a study's files."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import datachecks as checks
from statloom.operators import quality
from statloom.plans import standins
from statloom.plans.catalog import Tables, query

LONG = standins.LONG_SQL


def _sql(*rows: tuple[str, str, str, str, float, str]) -> str:
    """(check, severity, observed, comparison, limit, source) as one table."""
    parts = [f"SELECT '{n}' AS check_id, '{s}' AS severity, CAST({o} AS DOUBLE) AS observed, CAST({limit} AS DOUBLE) AS threshold, '{op}' AS op FROM {source}" for n, s, o, op, limit, source in rows]
    ok = "CASE op WHEN '>=' THEN observed >= threshold WHEN '<=' THEN observed <= threshold WHEN '>' THEN observed > threshold ELSE observed = threshold END"
    return f"SELECT check_id, severity, round(observed, 6) AS observed, threshold, coalesce({ok}, false) AS passed FROM ({' UNION ALL '.join(parts)})"


def _share(condition: str) -> str:
    return f"avg(CAST(coalesce({condition}, false) AS INTEGER))"


def _shown(*found):
    return quality.combine(list(found)).withColumn("observed", F.round("observed", 6))


_VARIANTS = "(SELECT l_partkey % 26 AS chr, l_orderkey * 10 + l_linenumber AS id, l_linestatus = 'O' AS agrees, l_tax * 10 AS maf, 1.1 - l_discount AS info, l_quantity FROM lineitem)"


@query(_sql(
    ("chromosome_codes", "error", _share("chr BETWEEN 1 AND 23"), ">=", 1, _VARIANTS),
    ("chromosomes_present", "error", "count(DISTINCT chr)", ">=", 22, _VARIANTS),
    ("duplicate_variants", "error", "count(id) - count(DISTINCT id)", "=", 0, _VARIANTS),
    ("strand_agreement", "error", "min(s)", ">=", 0.75, f"(SELECT {_share('agrees')} AS s FROM {_VARIANTS} GROUP BY chr)"),
    ("control_positions", "error", _share("there"), ">=", 0.25, "(SELECT p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AS there FROM part)"),
    ("maf_range", "error", _share("maf BETWEEN 0 AND 1"), ">=", 1, _VARIANTS),
    ("info_range", "error", _share("info <= 1.1"), ">=", 1, _VARIANTS),
    ("low_maf", "warning", _share("maf < 0.01"), "<=", 0.01, _VARIANTS),
    ("low_info", "warning", _share("info < 0.8"), "<=", 0.01, _VARIANTS),
    ("quality_overlap", "error", _share(f"id IN (SELECT id FROM {_VARIANTS} WHERE l_quantity > 2)"), ">=", 0.95, _VARIANTS),
    ("half_alleles", "error", "count(*) FILTER ((a IS NULL) <> (b IS NULL))", "=", 0, "(SELECT nullif(lang, 'de') AS a, nullif(source, 'web') AS b FROM documents)"),
))
def datacheck_genotypes(spark, d):
    t = Tables(spark, d)
    v = t.lineitem.selectExpr("l_partkey % 26 as chr", "l_orderkey * 10 + l_linenumber as id", "l_linestatus = 'O' as agrees", "l_tax * 10 as maf", "1.1 - l_discount as info", "l_quantity", "l_partkey as p_partkey")
    return _shown(
        checks.variants(v, "chr", "id"), checks.strand(v, "chr", "agrees"), checks.build(t.part, v.where("l_quantity > 49"), ["p_partkey"]), checks.quality(v, "maf", "info"),
        checks.overlap(v, v.where("l_quantity > 2"), "id", "quality_overlap", checks.OVERLAP), checks.alleles(t.documents.selectExpr("nullif(lang, 'de') as a", "nullif(source, 'web') as b"), "a", "b"),
    )


_SEX = "(SELECT CASE WHEN vec_id % 50 = 0 THEN NULL WHEN label % 2 = 0 THEN 'F' ELSE 'M' END AS sex, CASE WHEN embedding[1] < 0 THEN 'F' ELSE 'M' END AS guess, CAST(embedding[1] AS DOUBLE) AS pc FROM embeddings)"
_MALE = "CASE sex WHEN 'M' THEN 1.0e0 WHEN 'F' THEN 0.0e0 END"


@query(_sql(
    ("matrix_samples", "error", "count(DISTINCT iid)", ">=", 200, LONG),
    ("matrix_orientation", "error", "count(DISTINCT feat) - count(DISTINCT iid)", ">", 0, LONG),
    ("matrix_missing", "error", "count(*) FILTER (x IS NULL OR isnan(x))", "=", 0, LONG),
    ("matrix_range", "error", _share("x BETWEEN 0 AND 1"), ">=", 1, LONG),
    ("matrix_genotype_probes", "error", "count(*) FILTER (starts_with(CAST(feat AS VARCHAR), 'rs'))", "=", 0, LONG),
    ("array_probes", "error", _share("f < 64"), ">=", 0.8, "(SELECT unnest(range(80)) AS f)"),
    ("sex_labels", "error", _share("sex IN ('M', 'F')"), ">=", 1, _SEX),
    ("least_sex_share", "warning", f"least(avg({_MALE}), 1 - avg({_MALE}))", ">=", 0.05, _SEX),
    ("sex_component", "warning", f"abs(corr({_MALE}, pc))", ">=", 0.7, _SEX),
    ("sex_mismatch", "error", _share("sex <> guess"), "<=", 0.1, _SEX),
    ("samples_missing", "error", _share("m > 0.02"), "<=", 0.01, f"(SELECT iid, avg(CAST(abs(x) > 0.3 AS INTEGER)) AS m FROM {LONG} GROUP BY iid)"),
    ("analysable", "error", "count(sex)", ">=", 10, _SEX),
))
def datacheck_matrix(spark, d):
    t = Tables(spark, d)
    x = standins.long(t)
    s = t.embeddings.select(F.expr("case when vec_id % 50 = 0 then null when label % 2 = 0 then 'F' else 'M' end").alias("sex"), F.when(F.col("embedding")[0] < 0, "F").otherwise("M").alias("guess"), F.col("embedding")[0].cast("double").alias("pc"))
    return _shown(
        checks.matrix(x, "feat", "iid", "x"), checks.overlap(spark.range(80).withColumnRenamed("id", "feat"), x, "feat", "array_probes", checks.PROBES), checks.sex(s, "sex", "guess", "pc"),
        checks.missingness(x.groupBy("iid").agg(F.avg((F.abs("x") > 0.3).cast("int")).alias("m")), "m"), checks.analysable(s, "sex"),
    )


_COVARIATES = "(SELECT c_custkey AS IID, c_mktsegment AS segment_factor, CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS balance_numeric, c_nationkey AS age_numeric, c_name AS name_factor, c_name AS contact FROM customer)"


@query(_sql(
    ("id_first", "error", "max(1)", "=", 1, _COVARIATES),
    ("columns", "error", "max(6)", ">=", 3, _COVARIATES),
    ("unnamed_types", "error", "max(1)", "=", 0, _COVARIATES),
    ("missing_share", "error", "greatest(avg(CAST(segment_factor IS NULL AS INTEGER)), avg(CAST(balance_numeric IS NULL AS INTEGER)), avg(CAST(age_numeric IS NULL AS INTEGER)), avg(CAST(name_factor IS NULL AS INTEGER)))", "<=", 0.1, _COVARIATES),
    ("factor_levels", "error", "CAST(count(DISTINCT segment_factor) = count(*) AS INTEGER) + CAST(count(DISTINCT name_factor) = count(*) AS INTEGER)", "=", 0, _COVARIATES),
    ("least_age", "error", "min(age_numeric)", ">=", 0, _COVARIATES),
    ("mean_age", "error", "avg(age_numeric)", "<=", 100, _COVARIATES),
    ("duplicate_samples", "error", "count(c_custkey) - count(DISTINCT c_custkey)", "=", 0, "customer"),
    ("sample_underscores", "error", "count(*) FILTER (contains(CAST(c_custkey AS VARCHAR), '_'))", "=", 0, "customer"),
    ("family_underscores", "error", "count(*) FILTER (contains(c_name, '_'))", "=", 0, "customer"),
    ("families", "error", "count(DISTINCT c_name)", ">", 1, "customer"),
    ("samples_in_both", "error", "count(DISTINCT o_custkey)", ">=", 200, "(SELECT o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))"),
))
def datacheck_covariates(spark, d):
    t = Tables(spark, d)
    c = t.customer.selectExpr("c_custkey as IID", "c_mktsegment as segment_factor", "case when c_acctbal > 9000 then null else c_acctbal end as balance_numeric", "c_nationkey as age_numeric", "c_name as name_factor", "c_name as contact")
    return _shown(checks.covariates(c, "IID", "age_numeric"), checks.samples(t.customer, "c_custkey", "c_name"), checks.in_both(c, t.orders.withColumnRenamed("o_custkey", "IID"), "IID"))
