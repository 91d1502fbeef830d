"""Sufficient statistics of a stream of samples: sums add up, so a micro-batch is one more partial study. An extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def variant_partials(samples: DataFrame) -> DataFrame:
    """(variant, phenotype) sums of streamed rows (variant, phenotype, iid, g, y), for complete or update mode."""
    g, y = F.col("g"), F.col("y")
    return samples.groupBy("variant", "phenotype").agg(F.count("*").alias("n"), F.sum(g).alias("s_g"), F.sum(y).alias("s_y"), F.sum(g * g).alias("s_gg"), F.sum(g * y).alias("s_gy"), F.sum(y * y).alias("s_yy"))


def solve_partials(sums: DataFrame) -> DataFrame:
    """variant, phenotype, n, beta, se, t of the simple regression that such sums give."""
    n = F.col("n")
    xx, xy, yy = (F.col(a) - F.col(b) * F.col(c) / n for a, b, c in (("s_gg", "s_g", "s_g"), ("s_gy", "s_g", "s_y"), ("s_yy", "s_y", "s_y")))
    beta = xy / xx
    se = F.sqrt((yy - beta * xy) / (n - 2) / xx)
    return sums.select("variant", "phenotype", "n", beta.alias("beta"), se.alias("se"), (beta / se).alias("t"))


def start(samples: DataFrame, name: str, checkpoint: str):
    """A running query that keeps the sums in the memory table `name`."""
    return variant_partials(samples).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()
