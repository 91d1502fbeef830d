"""Variance QTL and interaction tests on (variant, phenotype, iid, g, y) pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deviation(pairs: DataFrame) -> DataFrame:
    """pairs with z: |y - median of y in its genotype|, the deviation regression's response."""
    m = pairs.groupBy("variant", "phenotype", "g").agg(F.percentile("y", 0.5).alias("__m"))
    return pairs.join(m, ["variant", "phenotype", "g"]).withColumn("z", F.abs(F.col("y") - F.col("__m"))).drop("__m")


def squared_residual(pairs: DataFrame) -> DataFrame:
    """pairs with z: the squared residual of y on g."""
    f = pairs.groupBy("variant", "phenotype").agg(F.regr_intercept("y", "g").alias("__a"), F.regr_slope("y", "g").alias("__b"))
    e = F.col("y") - F.col("__a") - F.col("__b") * F.col("g")
    return pairs.join(f, ["variant", "phenotype"]).withColumn("z", e * e).drop("__a", "__b")


def brown_forsythe(pairs: DataFrame) -> DataFrame:
    """f, d1, d2 of the one-way analysis of |y - median| by genotype."""
    k = deviation(pairs).groupBy("variant", "phenotype", "g").agg(F.count("*").alias("n"), F.avg("z").alias("m"), F.sum(F.col("z") * F.col("z")).alias("s"))
    a = k.groupBy("variant", "phenotype").agg(F.count("*").alias("k"), F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("nm"), F.sum("s").alias("s"))
    f = ((F.col("nm") - F.col("n") * F.col("m") * F.col("m")) / (F.col("k") - 1)) / ((F.col("s") - F.col("nm")) / (F.col("n") - F.col("k")))
    return a.select("variant", "phenotype", f.alias("f"), (F.col("k") - 1).alias("d1"), (F.col("n") - F.col("k")).alias("d2"))


def interaction(dosages: DataFrame, phenotypes: DataFrame, moderator: DataFrame, least_maf: float = 0.05) -> DataFrame:
    """variant, phenotype, n, beta, t of the product term in y ~ g + i + g*i.

    A variant counts only if its minor allele frequency is at least least_maf in both halves of the moderator. The sums are
    aggregates of the pair join; the 4 x 4 systems are solved in batches.
    """
    half = moderator.agg(F.percentile("i", 0.5)).first()[0]
    g = dosages.join(moderator, "iid")
    af = g.groupBy("variant", (F.col("i") > half).alias("__h")).agg((F.avg("g") / 2).alias("p"))
    good = af.groupBy("variant").agg(F.min(F.least("p", 1 - F.col("p"))).alias("m"), F.count("*").alias("c")).where(f"m >= {least_maf} and c = 2").select("variant")
    d = g.join(good, "variant", "left_semi").join(phenotypes, "iid")
    x = [F.lit(1.0), F.col("g"), F.col("i"), F.col("g") * F.col("i")]
    sums = d.groupBy("variant", "phenotype").agg(F.count("*").alias("n"), F.array(*[F.sum(a * b) for a in x for b in x]).alias("a"), F.array(*[F.sum(a * F.col("y")) for a in x]).alias("b"), F.sum(F.col("y") * F.col("y")).alias("yy"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for s in batches:
            if len(s):
                a, b = np.array(s["a"].tolist()).reshape(-1, 4, 4), np.array(s["b"].tolist())
                inverse = np.linalg.pinv(a, hermitian=True)
                w = np.einsum("rij,rj->ri", inverse, b)
                yy = s["yy"].to_numpy()
                rest = yy - (w * b).sum(1)
                # an exact fit, such as of the moderator itself, leaves rounding only
                v = np.where(rest > 1e-12 * yy, rest, 0.0) / (s["n"].to_numpy() - 4)
                se = np.sqrt(v * inverse[:, 3, 3])
                yield pd.DataFrame({"variant": s["variant"], "phenotype": s["phenotype"], "n": s["n"], "beta": w[:, 3], "t": np.divide(w[:, 3], se, out=np.zeros_like(se), where=se > 0)})

    types = {c: dict(sums.dtypes)[c] for c in ("variant", "phenotype")}
    return sums.mapInPandas(solve, f"variant {types['variant']}, phenotype {types['phenotype']}, n long, beta double, t double")
