"""Weighted scores of samples over features."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def allele_score(dosages: DataFrame, weights: DataFrame) -> DataFrame:
    """iid, score: weighted allele count over twice the number of variants; a missing dosage is its variant's mean."""
    mean = F.avg("g").over(Window.partitionBy("variant"))
    d = dosages.join(weights, "variant").withColumn("g", F.coalesce("g", mean))
    return d.groupBy("iid").agg((F.sum(F.col("w") * F.col("g")) / (2 * F.count("*"))).alias("score"))


def linear_score(values: DataFrame, weights: DataFrame, intercept: float = 0.0, least: int = 1) -> DataFrame:
    """iid, score: intercept + sum of w * x over the signature's features; null for samples with fewer than `least`."""
    s = values.join(weights, "feat").groupBy("iid").agg(F.sum(F.col("w") * F.col("x")).alias("s"), F.count("x").alias("n"))
    return s.select("iid", F.when(F.col("n") >= least, F.col("s") + intercept).alias("score"))


def signed_score(values: DataFrame, signature: DataFrame) -> DataFrame:
    """iid, score: w * (x - reference) where the effect is positive, w * (reference - x) where it is negative."""
    gap = (F.col("x") - F.col("reference")) * F.signum("effect")
    return values.join(signature, "feat").groupBy("iid").agg(F.sum(F.col("w") * gap).alias("score"))


def entropy(shares: DataFrame) -> DataFrame:
    """iid, entropy in bits over positive shares x."""
    return shares.where("x > 0").groupBy("iid").agg((-F.sum(F.col("x") * F.log2("x"))).alias("entropy"))


def rolled_up(wide: DataFrame, groups: dict[str, list[str]], suffix: str, key: str) -> DataFrame:
    """key and, for each group, the sum of its cell types' columns, named with the suffix; null if any of them is."""
    return wide.select(key, *[reduce(add, map(F.col, cells)).alias(name + suffix) for name, cells in groups.items()])
