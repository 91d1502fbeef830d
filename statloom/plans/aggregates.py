"""Aggregates: summaries, missingness, frequencies, scores, correlations, expectations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from statloom.functions import scalars
from statloom.operators import quality, ranks
from statloom.plans import standins
from statloom.plans.catalog import Tables, query

LONG, DOSE = standins.LONG_SQL, standins.DOSE_SQL


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_group_counts(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, round(min(l_quantity), 4) AS lo, round(avg(l_quantity), 4) AS mean, round(quantile_cont(l_quantity, 0.5), 4) AS median, round(max(l_quantity), 4) AS hi, round(stddev_samp(l_quantity), 4) AS sd, round(stddev_samp(l_quantity) / sqrt(count(*)), 6) AS sem FROM lineitem GROUP BY 1")
def agg_summary(spark, d):
    x = F.col("l_quantity").cast("double")
    r = lambda c, k: F.round(c, k)
    return Tables(spark, d).lineitem.groupBy("l_returnflag").agg(r(F.min(x), 4).alias("lo"), r(F.avg(x), 4).alias("mean"), r(F.percentile(x, 0.5), 4).alias("median"), r(F.max(x), 4).alias("hi"), r(F.stddev_samp(x), 4).alias("sd"), r(F.stddev_samp(x) / F.sqrt(F.count("*")), 6).alias("sem"))


@query(f"SELECT feat, round(avg(x), 7) AS mean, round(stddev_samp(x), 7) AS sd, round(quantile_cont(x, 0.5), 7) AS median FROM {LONG} GROUP BY feat")
def agg_feature_summary(spark, d):
    return standins.long(Tables(spark, d)).groupBy("feat").agg(F.round(F.avg("x"), 7).alias("mean"), F.round(F.stddev_samp("x"), 7).alias("sd"), F.round(F.percentile("x", 0.5), 7).alias("median"))


@query(f"SELECT feat, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.75), 6) AS q3, count(*) - count(x) AS missing FROM {LONG} GROUP BY feat")
def agg_quartiles(spark, d):
    q = F.percentile("x", F.array(F.lit(0.25), F.lit(0.75)))
    return standins.long(Tables(spark, d)).groupBy("feat").agg(q.alias("q"), F.count_if(F.isnull("x")).alias("missing")).select("feat", F.round(F.col("q")[0], 6).alias("q1"), F.round(F.col("q")[1], 6).alias("q3"), "missing")


@query("SELECT source, count(*) AS n, count(*) - count(quality) AS missing, round(1 - count(quality) / count(*), 6) AS share FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def agg_missingness(spark, d):
    t = Tables(spark, d)
    q = t.documents.join(t.labels, "doc_id", "left")
    return q.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.isnull("quality")).alias("missing"), F.round(F.avg(F.isnull("quality").cast("int")), 6).alias("share"))


@query("SELECT round(avg(CAST(share > 0.57 AS INTEGER)), 2) AS above FROM (SELECT source, 1 - count(quality) / count(*) AS share FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)")
def agg_share_above_missingness(spark, d):
    t = Tables(spark, d)
    s = t.documents.join(t.labels, "doc_id", "left").groupBy("source").agg(F.avg(F.isnull("quality").cast("int")).alias("share"))
    return s.agg(F.round(F.avg((F.col("share") > 0.57).cast("int")), 2).alias("above"))


@query(f"SELECT feat, round(avg(g) / 2, 6) AS af, round(least(avg(g) / 2, 1 - avg(g) / 2), 6) AS maf, count(*) FILTER (g = 0) AS n0, count(*) FILTER (g = 1) AS n1, count(*) FILTER (g = 2) AS n2 FROM {DOSE} GROUP BY feat")
def agg_allele_frequency(spark, d):
    s = quality.variant_summary(standins.dosages(Tables(spark, d)), "feat")
    return s.select("feat", F.round("af", 6).alias("af"), F.round(F.least("af", 1 - F.col("af")), 6).alias("maf"), "n0", "n1", "n2")


_COUNTS = f"(SELECT feat, count(*) FILTER (g = 1) AS het, least(count(*) FILTER (g = 0), count(*) FILTER (g = 2)) AS few, count(*) AS n FROM {standins.DOSE_SQL} GROUP BY feat)"
_WAYS = f"(SELECT feat, het, n, 2 * few + het AS rare, unnest(range((2 * few + het) % 2, 2 * few + het + 1, 2)) AS k FROM {_COUNTS})"
_LIKELY = f"(SELECT feat, het, k, k * ln(2) - lgamma(k + 1) - lgamma((rare - k) // 2 + 1) - lgamma(n - k - (rare - k) // 2 + 1) AS l FROM {_WAYS})"


@query(f"""SELECT feat, round(least(1, sum(e) FILTER (e <= seen * (1 + 1e-9)) / sum(e)), 6) AS p_hwe FROM (
    SELECT feat, exp(l - max(l) OVER w) AS e, exp(max(l) FILTER (k = het) OVER w - max(l) OVER w) AS seen FROM {_LIKELY} WINDOW w AS (PARTITION BY feat)) GROUP BY feat""")
def agg_hardy_weinberg(spark, d):
    return quality.variant_summary(standins.dosages(Tables(spark, d)), "feat", hardy=True).select("feat", F.round("p_hwe", 6).alias("p_hwe"))


@query("SELECT user_id, event_type FROM events GROUP BY ALL HAVING count(*) > 1")
def agg_duplicates(spark, d):
    return Tables(spark, d).events.groupBy("user_id", "event_type").count().where("count > 1").select("user_id", "event_type")


@query("SELECT quality, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality")
def agg_frequency_table(spark, d):
    t = Tables(spark, d)
    n = t.documents.join(t.labels, "doc_id", "left").groupBy("quality").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("SELECT lang, count(*) FILTER (toxic = 0) AS t0, count(*) FILTER (toxic = 1) AS t1, count(*) FILTER (toxic IS NULL) AS na FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def agg_contingency(spark, d):
    t = Tables(spark, d)
    j = t.documents.join(t.labels, "doc_id", "left")
    return j.groupBy("lang").agg(F.count_if(F.col("toxic") == 0).alias("t0"), F.count_if(F.col("toxic") == 1).alias("t1"), F.count_if(F.isnull("toxic")).alias("na"))


@query("SELECT coalesce(CAST(label % 2 AS VARCHAR), 'all') AS stratum, count(*) AS n, round(avg(embedding[1]::DOUBLE), 6) AS mean FROM embeddings GROUP BY GROUPING SETS ((), (label % 2))")
def agg_strata(spark, d):
    e = Tables(spark, d).embeddings.select((F.col("label") % 2).alias("s"), F.col("embedding")[0].cast("double").alias("x"))
    return e.groupingSets([[], ["s"]], "s").agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mean")).select(F.coalesce(F.col("s").cast("string"), F.lit("all")).alias("stratum"), "n", "mean")


@query(f"SELECT a.feat AS i, b.feat AS j, round(corr(a.x, b.x), 6) AS r FROM {LONG} a JOIN {LONG} b ON a.iid = b.iid AND a.feat < b.feat GROUP BY ALL")
def agg_pearson_matrix(spark, d):
    x = standins.long(Tables(spark, d))
    a, b = x.select("iid", F.col("feat").alias("i"), F.col("x").alias("x")), x.select("iid", F.col("feat").alias("j"), F.col("x").alias("y"))
    return a.join(b, "iid").where("i < j").groupBy("i", "j").agg(F.round(F.corr("x", "y"), 6).alias("r"))


@query("""WITH r AS (SELECT vec_id, rank() OVER (ORDER BY embedding[1]) + (count(*) OVER (PARTITION BY embedding[1]) - 1) / 2.0e0 AS a,
    rank() OVER (ORDER BY embedding[2]) + (count(*) OVER (PARTITION BY embedding[2]) - 1) / 2.0e0 AS b FROM embeddings) SELECT round(corr(a, b), 6) AS rho FROM r""")
def agg_spearman(spark, d):
    e = Tables(spark, d).embeddings.select(F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return e.select(ranks.average_rank("x").alias("a"), ranks.average_rank("y").alias("b")).agg(F.round(F.corr("a", "b"), 6).alias("rho"))


_WEIGHT = "((feat * 37 % 11) - 5) / 10.0e0"


@query(f"SELECT iid, round(sum({_WEIGHT} * coalesce(g, m)) / (2 * count(*)), 8) AS score FROM (SELECT iid, feat, g, avg(g) OVER (PARTITION BY feat) AS m FROM (SELECT iid, feat, CASE WHEN (iid + feat) % 17 <> 0 THEN g END AS g FROM {DOSE})) GROUP BY iid")
def score_weighted_alleles(spark, d):
    from statloom.operators.scores import allele_score

    dose = standins.dosages(Tables(spark, d)).select("iid", F.col("feat").alias("variant"), F.when((F.col("iid") + F.col("feat")) % 17 != 0, F.col("g")).alias("g"))
    weights = spark.range(32).selectExpr("cast(id as int) as variant", "((id * 37 % 11) - 5) / 10.0D as w")
    return allele_score(dose, weights).select("iid", F.round("score", 8).alias("score"))


@query(f"SELECT iid, round(0.5 + sum({_WEIGHT} * x), 6) AS score FROM {LONG} WHERE feat < 20 GROUP BY iid")
def score_linear_signature(spark, d):
    from statloom.operators.scores import linear_score

    weights = spark.range(20).selectExpr("cast(id as int) as feat", "((id * 37 % 11) - 5) / 10.0D as w")
    return linear_score(standins.long(Tables(spark, d)), weights, 0.5).select("iid", F.round("score", 6).alias("score"))


@query(f"SELECT iid, round(sum(CASE WHEN feat % 2 = 0 THEN {_WEIGHT} * (x - 0.01) ELSE {_WEIGHT} * (0.01 - x) END), 6) AS score FROM {LONG} WHERE feat < 20 GROUP BY iid")
def score_signed_signature(spark, d):
    from statloom.operators.scores import signed_score

    sig = spark.range(20).selectExpr("cast(id as int) as feat", "((id * 37 % 11) - 5) / 10.0D as w", "if(id % 2 = 0, 1.0D, -1.0D) as effect", "0.01D as reference")
    return signed_score(standins.long(Tables(spark, d)), sig).select("iid", F.round("score", 6).alias("score"))


@query(f"SELECT iid, round(-sum(s * log2(s)), 6) AS entropy FROM (SELECT iid, abs(x) / sum(abs(x)) OVER (PARTITION BY iid) AS s FROM {LONG}) WHERE s > 0 GROUP BY iid")
def score_entropy(spark, d):
    from statloom.operators.scores import entropy

    x = standins.long(Tables(spark, d))
    s = x.select("iid", (F.abs("x") / F.sum(F.abs("x")).over(Window.partitionBy("iid"))).alias("x"))
    return entropy(s).select("iid", F.round("entropy", 6).alias("entropy"))


@query(f"SELECT iid, round(quantile_cont(x, 0.5), 6) AS median FROM {LONG} WHERE feat < 14 GROUP BY iid")
def score_panel_median(spark, d):
    return standins.long(Tables(spark, d)).where("feat < 14").groupBy("iid").agg(F.round(F.percentile("x", 0.5), 6).alias("median"))


@query("SELECT p_size AS chr, round(avg(CAST(p_brand < p_type AS INTEGER)), 6) AS agreement FROM part GROUP BY p_size")
def agg_strand_agreement(spark, d):
    return Tables(spark, d).part.groupBy(F.col("p_size").alias("chr")).agg(F.round(F.avg((F.col("p_brand") < F.col("p_type")).cast("int")), 6).alias("agreement"))


@query("SELECT round(avg(CAST(o_custkey IS NOT NULL AS INTEGER)), 6) AS present FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey")
def agg_control_share(spark, d):
    t = Tables(spark, d)
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.lit(1).alias("there")).distinct()
    return t.customer.join(o, "c_custkey", "left").agg(F.round(F.avg(F.isnotnull("there").cast("int")), 6).alias("present"))


@query("SELECT least(30, 1 + CAST(floor((l_quantity - 1) / 49.0 * 30) AS BIGINT)) AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def agg_histogram(spark, d):
    b = F.least(F.lit(30), F.floor((F.col("l_quantity").cast("double") - 1) / 49.0 * 30) + 1)
    return Tables(spark, d).lineitem.groupBy(b.cast("long").alias("bin")).agg(F.count("*").alias("n"))


@query("SELECT iid, feat AS best FROM (SELECT iid, feat, x, row_number() OVER (PARTITION BY iid ORDER BY x DESC, feat) AS n FROM " + LONG + ") WHERE n = 1")
def agg_class_winner(spark, d):
    return standins.long(Tables(spark, d)).groupBy("iid").agg(F.max_by("feat", F.struct("x", -F.col("feat"))).alias("best"))


@query(f"SELECT feat, round(avg(g) / 2 * 100, 4) AS percent, min(g) = max(g) AS invariant FROM {DOSE} GROUP BY feat")
def agg_call_summary(spark, d):
    return standins.dosages(Tables(spark, d)).groupBy("feat").agg(F.round(F.avg("g") / 2 * 100, 4).alias("percent"), (F.min("g") == F.max("g")).alias("invariant"))


@query(f"SELECT a.iid AS i, b.iid AS j, round(sum((a.g - 2 * p) * (b.g - 2 * p) / (2 * p * (1 - p))) / 32, 6) AS grm FROM {DOSE} a JOIN {DOSE} b ON a.feat = b.feat AND a.iid >= b.iid JOIN (SELECT feat, avg(g) / 2 AS p FROM {DOSE} GROUP BY feat) f ON f.feat = a.feat GROUP BY ALL")
def grm(spark, d):
    from statloom.operators.matrix import relationship

    return relationship(standins.dosages(Tables(spark, d)), 0.0).select("i", "j", F.round("grm", 6).alias("grm"))


@query("SELECT 'customers' AS metric, CAST(count(*) AS DOUBLE) AS value FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'mean_total', round(avg(o_totalprice), 4) FROM orders")
def agg_cohort_summary(spark, d):
    t = Tables(spark, d)
    n = lambda df, k: df.agg(F.count("*").cast("double").alias("value")).select(F.lit(k).alias("metric"), "value")
    return n(t.customer, "customers").unionByName(n(t.orders, "orders")).unionByName(t.orders.agg(F.round(F.avg("o_totalprice"), 4).alias("value")).select(F.lit("mean_total").alias("metric"), "value"))


@query("SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, max(n) AS most FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)")
def agg_reconciliation(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), F.max("n").alias("most"))


@query("SELECT count(*) FILTER (quality IS NULL OR toxic IS NULL) AS incomplete, count(*) FILTER (quality IS NOT NULL AND toxic IS NOT NULL) AS complete FROM documents LEFT JOIN labels USING (doc_id)")
def agg_complete_rows(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels, "doc_id", "left").agg(F.count_if(F.expr("quality is null or toxic is null")).alias("incomplete"), F.count_if(F.expr("quality is not null and toxic is not null")).alias("complete"))


@query("SELECT side, k FROM (SELECT 'missing' AS side, c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000))")
def agg_chunk_completeness(spark, d):
    t = Tables(spark, d)
    return quality.complete(t.orders.where("o_totalprice > 490000").select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k")), "k").select("side", "k")


@query("""SELECT check_id, severity, round(observed, 6) AS observed, threshold, passed FROM (
    SELECT 'duplicate_ids' AS check_id, 'error' AS severity, CAST(count(*) - count(DISTINCT c_custkey) AS DOUBLE) AS observed, 0.0e0 AS threshold, count(*) = count(DISTINCT c_custkey) AS passed FROM customer
    UNION ALL SELECT 'samples', 'error', count(*), 200, count(*) >= 200 FROM customer
    UNION ALL SELECT 'balance_missing', 'error', avg(CAST(c_acctbal IS NULL AS INTEGER)), 0.1, avg(CAST(c_acctbal IS NULL AS INTEGER)) <= 0.1 FROM customer
    UNION ALL SELECT 'segments', 'error', count(DISTINCT c_mktsegment), 2, count(DISTINCT c_mktsegment) >= 2 FROM customer
    UNION ALL SELECT 'name_with_underscore', 'error', count(*) FILTER (contains(c_name, '_')), 0, count(*) FILTER (contains(c_name, '_')) = 0 FROM customer
    UNION ALL SELECT 'least_balance', 'warning', min(c_acctbal), 0, min(c_acctbal) >= 0 FROM customer
    UNION ALL SELECT 'mean_balance', 'warning', avg(c_acctbal), 100000, avg(c_acctbal) <= 100000 FROM customer)""")
def expectations_covariates(spark, d):
    c = Tables(spark, d).customer
    checks = {
        "duplicate_ids": ("error", F.count("*") - F.count_distinct("c_custkey"), "=", 0),
        "samples": ("error", F.count("*"), ">=", 200),
        "balance_missing": ("error", F.avg(F.isnull("c_acctbal").cast("int")), "<=", 0.1),
        "segments": ("error", F.count_distinct("c_mktsegment"), ">=", 2),
        "name_with_underscore": ("error", F.count_if(F.col("c_name").contains("_")), "=", 0),
        "least_balance": ("warning", F.min("c_acctbal"), ">=", 0),
        "mean_balance": ("warning", F.avg("c_acctbal"), "<=", 100000),
    }
    return quality.expect(c, checks).withColumn("observed", F.round("observed", 6))


@query(f"""SELECT check_id, 'error' AS severity, round(observed, 6) AS observed, threshold, passed FROM (
    SELECT 'within_range' AS check_id, avg(CAST(x BETWEEN -1 AND 1 AS INTEGER)) AS observed, 1.0e0 AS threshold, avg(CAST(x BETWEEN -1 AND 1 AS INTEGER)) >= 1 AS passed FROM {LONG}
    UNION ALL SELECT 'missing', avg(CAST(x IS NULL AS INTEGER)), 0, avg(CAST(x IS NULL AS INTEGER)) <= 0 FROM {LONG}
    UNION ALL SELECT 'samples', count(DISTINCT iid), 200, count(DISTINCT iid) >= 200 FROM {LONG}
    UNION ALL SELECT 'features', count(DISTINCT feat), 64, count(DISTINCT feat) = 64 FROM {LONG})""")
def expectations_matrix(spark, d):
    x = standins.long(Tables(spark, d))
    checks = {
        "within_range": ("error", F.avg(F.col("x").between(-1, 1).cast("int")), ">=", 1),
        "missing": ("error", F.avg(F.isnull("x").cast("int")), "<=", 0),
        "samples": ("error", F.count_distinct("iid"), ">=", 200),
        "features": ("error", F.count_distinct("feat"), "=", 64),
    }
    return quality.expect(x, checks).withColumn("observed", F.round("observed", 6))


@query("""SELECT check_id, severity, round(observed, 6) AS observed, threshold, passed FROM (
    SELECT 'p_range' AS check_id, 'error' AS severity, avg(CAST(l_discount BETWEEN 0 AND 1 AS INTEGER)) AS observed, 1.0e0 AS threshold, avg(CAST(l_discount BETWEEN 0 AND 1 AS INTEGER)) >= 1 AS passed FROM lineitem
    UNION ALL SELECT 'position', 'error', min(l_partkey), 0, min(l_partkey) >= 0 FROM lineitem
    UNION ALL SELECT 'chromosomes', 'error', count(DISTINCT l_linenumber), 30, count(DISTINCT l_linenumber) <= 30 FROM lineitem
    UNION ALL SELECT 'low_info', 'warning', avg(CAST(l_tax < 0.01 AS INTEGER)), 0.01, avg(CAST(l_tax < 0.01 AS INTEGER)) <= 0.01 FROM lineitem)""")
def expectations_results(spark, d):
    li = Tables(spark, d).lineitem
    checks = {
        "p_range": ("error", F.avg(F.col("l_discount").between(0, 1).cast("int")), ">=", 1),
        "position": ("error", F.min("l_partkey"), ">=", 0),
        "chromosomes": ("error", F.count_distinct("l_linenumber"), "<=", 30),
        "low_info": ("warning", F.avg((F.col("l_tax") < 0.01).cast("int")), "<=", 0.01),
    }
    return quality.expect(li, checks).withColumn("observed", F.round("observed", 6))


@query("SELECT event_id, CASE WHEN value < 50 THEN 'low' ELSE 'high' END AS side FROM events WHERE value IS NOT NULL")
def agg_midpoint_side(spark, d):
    e = Tables(spark, d).events.where("value is not null")
    return e.select("event_id", F.when(scalars.missing_to_null(F.col("value")) < 50, "low").otherwise("high").alias("side"))
