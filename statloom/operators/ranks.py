"""Ordered-set transforms within a group: ranks, inverse-normal scores, masks, imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.stats import norm_quantile


def average_rank(x: str, *by: str) -> Column:
    """R's rank(): ties share the mean rank, missing values have none."""
    order = Window.partitionBy(*by, F.isnull(x)).orderBy(x)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, x))
    return F.when(F.col(x).isNotNull(), F.rank().over(order) + (ties - 1) / 2.0)


def with_average_rank(df: DataFrame, x: str, *by: str, name: str = "r") -> DataFrame:
    """df with average_rank() as `name`, from the counts of distinct values, which alone are put in order: for values with many ties."""
    v = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.count("*").alias("__k"))
    before = F.sum("__k").over(Window.partitionBy(*by).orderBy(x).rowsBetween(Window.unboundedPreceding, -1))
    v = v.withColumn(name, F.coalesce(before, F.lit(0)) + 1 + (F.col("__k") - 1) / 2.0).drop("__k")
    return _same(df, v, *by, x, how="left")


def inverse_normal(df: DataFrame, x: str, *by: str, rescale: bool = True) -> DataFrame:
    """df with `int`. Rescaled: quantiles of (rank - 0.5) / largest rank, centred and scaled by the sample deviation.
    Otherwise the quantile of (rank - 0.5) / number of values."""
    w = Window.partitionBy(*by)
    df = df.withColumn("__r", average_rank(x, *by))
    n = F.max("__r").over(w) if rescale else F.count(x).over(w)
    df = df.withColumn("__p", (F.col("__r") - 0.5) / n).withColumn("__q", norm_quantile("__p"))
    out = (F.col("__q") - F.avg("__q").over(w)) / F.stddev_samp("__q").over(w) if rescale else F.col("__q")
    return df.withColumn("int", out).drop("__r", "__p", "__q")


def z_score(x: str, *by: str) -> Column:
    w = Window.partitionBy(*by)
    return (F.col(x) - F.avg(x).over(w)) / F.stddev_samp(x).over(w)


def mask_outliers(df: DataFrame, x: str, *by: str, times: float, rounds: int = 3) -> DataFrame:
    """x set to null beyond mean +- times * deviation, in so many rounds on what is left; a group's null counts follow."""
    w = Window.partitionBy(*by)
    for _ in range(rounds):
        df = df.withColumn(x, F.when(F.abs(F.col(x) - F.avg(x).over(w)) <= times * F.stddev_samp(x).over(w), F.col(x)))
    return df


def mask_iqr(df: DataFrame, x: str, *by: str, times: float = 3.0) -> DataFrame:
    """x set to null outside [Q1 - times * IQR, Q3 + times * IQR], quartiles of type 7."""
    q = df.groupBy(*by).agg(F.percentile(x, F.array(F.lit(0.25), F.lit(0.75))).alias("__q"))
    span = F.col("__q")[1] - F.col("__q")[0]
    inside = (F.col(x) >= F.col("__q")[0] - times * span) & (F.col(x) <= F.col("__q")[1] + times * span)
    return df.join(q, list(by)).withColumn(x, F.when(inside, F.col(x))).drop("__q")


def winsorise(df: DataFrame, x: str, *by: str, share: float = 0.05) -> DataFrame:
    """x clamped to the quantiles share and 1 - share."""
    q = df.groupBy(*by).agg(F.percentile(x, F.array(F.lit(share), F.lit(1 - share))).alias("__q"))
    return df.join(q, list(by)).withColumn(x, F.greatest(F.least(x, F.col("__q")[1]), F.col("__q")[0])).drop("__q")


def impute_mean(x: str, *by: str) -> Column:
    return F.coalesce(F.col(x), F.avg(x).over(Window.partitionBy(*by)))


def plotting_positions(i: Column, n: Column) -> Column:
    """R's ppoints: (i - a) / (n + 1 - 2a), a = 3/8 up to ten values, else 1/2."""
    a = F.when(n <= 10, 0.375).otherwise(0.5)
    return (i - a) / (n + 1 - 2 * a)


def benjamini_hochberg(df: DataFrame, p: str, *by: str) -> DataFrame:
    """df with `fdr`: p * n / rank, made monotone from the largest rank down; null where p is, which doesn't count.

    Ranks are those of distinct values, in buckets that follow the values' order (even above 2**-10, powers of two below), so
    that no task sorts all values; only the buckets' totals, some 2,100 a group, are put in order as a whole.
    """
    v = df.where(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count("*").alias("__k"))
    small = F.coalesce(F.floor(F.log2(F.col(p).cast("double"))), F.lit(-2_000))
    v = v.withColumn("__b", F.when(F.col(p) >= 1 / 1024, F.floor(F.col(p) * 1024)).otherwise(small))
    up = Window.partitionBy(*by).orderBy("__b")
    sums = v.groupBy(*by, "__b").agg(F.sum("__k").alias("__s")).withColumns({
        "__before": F.coalesce(F.sum("__s").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "__n": F.sum("__s").over(Window.partitionBy(*by))})
    v = _same(v, sums.drop("__s"), *by, "__b")
    inside = Window.partitionBy(*by, "__b").orderBy(p)
    v = v.withColumn("__f", F.col(p) * F.col("__n") / (F.col("__before") + F.sum("__k").over(inside)))
    least = v.groupBy(*by, "__b").agg(F.min("__f").alias("__m")).withColumn("__later", F.min("__m").over(up.rowsBetween(1, Window.unboundedFollowing)))
    v = _same(v, least.drop("__m"), *by, "__b")
    down = Window.partitionBy(*by, "__b").orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = v.withColumn("fdr", F.least(F.lit(1.0), F.min("__f").over(down), "__later"))
    return _same(df, v.select(*by, p, "fdr"), *by, p, how="left")


def _same(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """A join on keys where null equals null, with the left side's keys."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(right, on, how).drop(*[f"__r_{k}" for k in keys])
