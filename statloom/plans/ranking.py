"""Ranks, inverse-normal transforms, masks, imputation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from statloom.functions.stats import norm_quantile_sql
from statloom.operators import numbering, ranks
from statloom.plans import standins
from statloom.plans.catalog import Tables, query

LONG = standins.LONG_SQL
_TIED = "(SELECT l_orderkey AS k, l_linenumber AS i, l_returnflag AS g, CAST(l_quantity AS DOUBLE) AS x FROM lineitem)"
_RANK = f"(SELECT *, rank() OVER (PARTITION BY g ORDER BY x) + (count(*) OVER (PARTITION BY g, x) - 1) / 2.0e0 AS r FROM {_TIED})"
_FEAT = f"(SELECT iid, feat, x FROM {LONG})"
_FRANK = f"(SELECT *, rank() OVER (PARTITION BY feat ORDER BY x) + (count(*) OVER (PARTITION BY feat, x) - 1) / 2.0e0 AS r FROM {_FEAT})"


def _tied(t: Tables):
    return t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), F.col("l_returnflag").alias("g"), F.col("l_quantity").cast("double").alias("x"))


def _feat(t: Tables):
    return standins.long(t).select("iid", "feat", "x")


@query(f"SELECT k, i, r FROM {_RANK}")
def rank_avg(spark, d):
    return ranks.with_average_rank(_tied(Tables(spark, d)), "x", "g").select("k", "i", "r")


@query(f"SELECT iid, feat, round((q - avg(q) OVER w) / stddev_samp(q) OVER w, 6) AS v FROM (SELECT iid, feat, {norm_quantile_sql('p')} AS q FROM (SELECT iid, feat, (r - 0.5e0) / max(r) OVER (PARTITION BY feat) AS p FROM {_FRANK})) WINDOW w AS (PARTITION BY feat)")
def int_a(spark, d):
    return ranks.inverse_normal(_feat(Tables(spark, d)), "x", "feat").select("iid", "feat", F.round("int", 6).alias("v"))


@query(f"SELECT iid, feat, round({norm_quantile_sql('p')}, 6) AS v FROM (SELECT iid, feat, (r - 0.5e0) / count(x) OVER (PARTITION BY feat) AS p FROM {_FRANK})")
def int_b(spark, d):
    return ranks.inverse_normal(_feat(Tables(spark, d)), "x", "feat", rescale=False).select("iid", "feat", F.round("int", 6).alias("v"))


@query(f"SELECT iid, feat, round((x - avg(x) OVER w) / stddev_samp(x) OVER w, 6) AS z FROM {LONG} WINDOW w AS (PARTITION BY feat)")
def zscore(spark, d):
    return standins.long(Tables(spark, d)).select("iid", "feat", F.round(ranks.z_score("x", "feat"), 6).alias("z"))


def _masked(source: str, t: float) -> str:
    return f"(SELECT iid, feat, CASE WHEN abs(x - avg(x) OVER w) <= {t} * stddev_samp(x) OVER w THEN x END AS x FROM {source} WINDOW w AS (PARTITION BY feat))"


@query(f"SELECT iid, feat, round(x, 6) AS x FROM {_masked(_masked(_masked(LONG, 2.0), 2.0), 2.0)}")
def outlier_iter3(spark, d):
    return ranks.mask_outliers(standins.long(Tables(spark, d)), "x", "feat", times=2.0).select("iid", "feat", F.round("x", 6).alias("x"))


@query(f"SELECT feat, count(*) - count(x) AS masked FROM {_masked(LONG, 2.5)} GROUP BY feat")
def outlier_once_counts(spark, d):
    return ranks.mask_outliers(standins.long(Tables(spark, d)), "x", "feat", times=2.5, rounds=1).groupBy("feat").agg(F.count_if(F.isnull("x")).alias("masked"))


@query(f"SELECT iid, l.feat, round(CASE WHEN x BETWEEN q1 - 0.7 * (q3 - q1) AND q3 + 0.7 * (q3 - q1) THEN x END, 6) AS x FROM {LONG} l JOIN (SELECT feat, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM {LONG} GROUP BY feat) q ON q.feat = l.feat")
def iqr_mask(spark, d):
    return ranks.mask_iqr(standins.long(Tables(spark, d)), "x", "feat", times=0.7).select("iid", "feat", F.round("x", 6).alias("x"))


@query(f"SELECT iid, l.feat, round(greatest(least(x, hi), lo), 6) AS x FROM {LONG} l JOIN (SELECT feat, quantile_cont(x, 0.05) AS lo, quantile_cont(x, 0.95) AS hi FROM {LONG} GROUP BY feat) q ON q.feat = l.feat")
def winsorise(spark, d):
    return ranks.winsorise(standins.long(Tables(spark, d)), "x", "feat").select("iid", "feat", F.round("x", 6).alias("x"))


@query(f"SELECT iid, feat, round(coalesce(v, avg(v) OVER (PARTITION BY feat)), 6) AS x FROM (SELECT iid, feat, CASE WHEN (iid + feat) % 13 <> 0 THEN x END AS v FROM {LONG})")
def row_mean_impute(spark, d):
    x = standins.long(Tables(spark, d)).withColumn("v", F.when((F.col("iid") + F.col("feat")) % 13 != 0, F.col("x")))
    return x.select("iid", "feat", F.round(ranks.impute_mean("v", "feat"), 6).alias("x"))


@query(f"SELECT iid, feat, round((n + 0.5e0) / (t + 1), 8) AS p FROM (SELECT iid, feat, row_number() OVER (PARTITION BY feat ORDER BY x, iid) AS n, count(*) OVER (PARTITION BY feat) AS t FROM {_FEAT})")
def qq_expected(spark, d):
    w = Window.partitionBy("feat")
    return _feat(Tables(spark, d)).select("iid", "feat", F.round((F.row_number().over(w.orderBy("x", "iid")) + 0.5) / (F.count("*").over(w) + 1), 8).alias("p"))


@query(f"SELECT iid, feat, round((n - 0.5e0) / t, 8) AS p FROM (SELECT iid, feat, row_number() OVER (PARTITION BY feat ORDER BY x, iid) AS n, count(*) OVER (PARTITION BY feat) AS t FROM {_FEAT})")
def plotting_positions(spark, d):
    w = Window.partitionBy("feat")
    return _feat(Tables(spark, d)).select("iid", "feat", F.round(ranks.plotting_positions(F.row_number().over(w.orderBy("x", "iid")), F.count("*").over(w)), 8).alias("p"))


@query(f"SELECT feat, round(sum(v) OVER (ORDER BY v DESC, feat ROWS UNBOUNDED PRECEDING) / sum(v) OVER (), 6) AS share FROM (SELECT feat, var_samp(x) AS v FROM {LONG} GROUP BY feat)")
def cum_share(spark, d):
    v = standins.long(Tables(spark, d)).groupBy("feat").agg(F.var_samp("x").alias("v"))  # a row a feature
    return numbering.running_sum(v, "v", F.desc("v"), "feat").select("feat", F.round("share", 6).alias("share"))


@query(f"SELECT feat, x >= (min(x) OVER w + max(x) OVER w) / 2 AS above, iid FROM {LONG} WINDOW w AS (PARTITION BY feat)")
def midpoint_cut(spark, d):
    w = Window.partitionBy("feat")
    return standins.long(Tables(spark, d)).select("feat", (F.col("x") >= (F.min("x").over(w) + F.max("x").over(w)) / 2).alias("above"), "iid")


@query(f"SELECT iid, round(max(x) - max(x) FILTER (n = 2), 6) AS margin FROM (SELECT iid, x, row_number() OVER (PARTITION BY iid ORDER BY x DESC) AS n FROM {LONG}) GROUP BY iid")
def runner_up_margin(spark, d):
    s = standins.long(Tables(spark, d)).groupBy("iid").agg(F.sort_array(F.collect_list("x"), False).alias("a"))
    return s.select("iid", F.round(F.col("a")[0] - F.col("a")[1], 6).alias("margin"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, (l_discount + 0.001e0) / 2 AS p FROM lineitem),
    s AS (SELECT *, p * count(*) OVER () / (rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1) AS f FROM r)
    SELECT l_orderkey, l_linenumber, round(least(1, min(f) OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS fdr FROM s""")
def false_discovery_rate(spark, d):
    p = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", ((F.col("l_discount").cast("double") + 0.001) / 2).alias("p"))
    return ranks.benjamini_hochberg(p, "p").select("l_orderkey", "l_linenumber", F.round("fdr", 6).alias("fdr"))
