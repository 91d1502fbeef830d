"""Adjustment of features for covariates and components, and clocks with their rules of overlap and accelerations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.scalars import age_from_clock
from statloom.operators import assoc, ranks

#: Modes of adjust(): whether values are made normal.
MODES = ("transformed", "untransformed")


def adjust(values: DataFrame, covariates: DataFrame, k: int, mode: str, again: bool = False) -> DataFrame:
    """(feat, iid, x): features (feat, iid, x) freed of covariates (iid, c array of k).

    transformed: the inverse normal of the residuals of the inverse normal; untransformed: the residuals of the values as they
    are. `again` is for a second adjustment, for components, of values that a first one has made: they aren't transformed
    before it. Missing values have no part in the fit and take their feature's mean of what comes out.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    plain = values.select("feat", "iid", F.when(~F.isnan("x"), F.col("x")).alias("x"))
    first = plain if mode == "untransformed" or again else ranks.inverse_normal(plain, "x", "feat").select("feat", "iid", F.col("int").alias("x"))
    out = assoc.residuals(first, covariates, k)
    if mode == "transformed":
        out = ranks.inverse_normal(out, "resid", "feat").select("feat", "iid", F.col("int").alias("resid"))
    return out.select("feat", "iid", F.coalesce("resid", F.avg("resid").over(Window.partitionBy("feat"))).alias("x"))


def clock(values: DataFrame, coefficients: DataFrame, intercept: float = 0.0, least: int = 1, share: float = 0.0, years: bool = False) -> DataFrame:
    """iid, pred: intercept + sum of w * x over the coefficients' features (feat, w) that values (feat, iid, x) have, a missing value at its
    feature's mean; with `years` taken back from the clock's scale to years.

    No rows come out if fewer than `least` of its features, or less than `share` of them, are among the values.
    """
    asked = coefficients.agg(F.count("feat").alias("__asked"))  # a row
    found = values.select("feat").distinct().join(coefficients.select("feat"), "feat", "left_semi").agg(F.count("*").alias("__found"))
    enough = found.crossJoin(asked).where((F.col("__found") >= least) & (F.col("__found") >= share * F.col("__asked"))).select(F.lit(1).alias("__enough"))
    mean = F.avg("x").over(Window.partitionBy("feat"))
    sums = values.join(coefficients, "feat").withColumn("x", F.coalesce("x", mean)).groupBy("iid").agg(F.sum(F.col("w") * F.col("x")).alias("__s"))
    pred = F.col("__s") + intercept
    return sums.join(F.broadcast(enough)).select("iid", (age_from_clock(pred) if years else pred).alias("pred"))


def acceleration(pred: DataFrame, about: DataFrame, covariates: int) -> DataFrame:
    """clock, iid, pred, pred_sd, pred_ss_sd: residuals of each clock's ages (clock, iid, pred), over their deviation: of the model with
    the first `covariates` of `about` (iid, c array with smoking last), and of that with smoking besides. Without other
    covariates pred_sd is the age itself over its deviation."""
    both = []
    x = pred.select(F.col("clock").alias("feat"), "iid", F.col("pred").alias("x"))
    for name, k in (("pred_sd", covariates), ("pred_ss_sd", covariates + 1)):
        c = about.select("iid", F.slice("c", 1, k).alias("c"))
        r = assoc.residuals(x, c, k) if k else x.join(about.select("iid"), "iid").select("feat", "iid", F.col("x").alias("resid"))
        both.append(r.select(F.col("feat").alias("clock"), "iid", (F.col("resid") / F.stddev_samp("resid").over(Window.partitionBy("feat"))).alias(name)))
    return pred.join(both[0], ["clock", "iid"]).join(both[1], ["clock", "iid"])
