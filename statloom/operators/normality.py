"""Whether values are normal: the Shapiro-Wilk statistic of groups of any size, from ranks in two steps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.stats import norm_quantile, norm_two_sided
from statloom.operators import numbering

#: Royston's (1995) polynomials, from the constant term up, of 1 / sqrt(n) for the two largest weights, and of n
#: (up to 11) or ln n for mean and logarithm of the deviation of the transformed statistic.
_LAST, _SECOND = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056), (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_SMALL_MEAN, _SMALL_SD = (0.5440, -0.39978, 0.025054, -0.0006714), (1.3822, -0.77857, 0.062767, -0.0020322)
_LARGE_MEAN, _LARGE_SD = (-1.5861, -0.31082, -0.083751, 0.0038915), (-0.4803, -0.082676, 0.0030302)


def _at(polynomial: tuple, x: float) -> float:
    return sum(c * x**i for i, c in enumerate(polynomial))


def _finish(part: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """w and p of groups from their sums: n, mm (sum of squared scores), mx (sum of score * value), ss, and the two largest and
    smallest values."""
    out = []
    for r in part.itertuples(index=False):
        n, u = int(r.n), r.n**-0.5
        if n < 3 or not r.ss > 0:
            out.append((None, None))
            continue
        if n == 3:
            top = (r.x1 - r.y1) * 0.5**0.5
            w = min(1.0, top * top / r.ss)
            out.append((w, max(0.0, 6 / np.pi * (np.arcsin(np.sqrt(w)) - np.arcsin(np.sqrt(0.75))))))
            continue
        root = r.mm**0.5
        last = r.m1 / root + _at(_LAST, u)
        second = r.m2 / root + _at(_SECOND, u)
        ends = 2 if n > 5 else 1
        rest = r.mm - 2 * r.m1**2 - (2 * r.m2**2 if ends == 2 else 0)
        share = 1 - 2 * last**2 - (2 * second**2 if ends == 2 else 0)
        middle = r.mx - r.m1 * (r.x1 - r.y1) - (r.m2 * (r.x2 - r.y2) if ends == 2 else 0)
        top = last * (r.x1 - r.y1) + (second * (r.x2 - r.y2) if ends == 2 else 0) + (middle * (share / rest) ** 0.5 if rest > 0 else 0)
        w = min(1.0, top * top / r.ss)
        apart = np.log(max(1 - w, 1e-300))
        if n <= 11:
            edge = -2.273 + 0.459 * n
            z = np.inf if apart >= edge else (-np.log(edge - apart) - _at(_SMALL_MEAN, n)) / np.exp(_at(_SMALL_SD, n))
        else:
            z = (apart - _at(_LARGE_MEAN, np.log(n))) / np.exp(_at(_LARGE_SD, np.log(n)))
        half = float(norm_two_sided(np.array([abs(z)]))[0]) / 2 if np.isfinite(z) else 0.0
        out.append((w, half if z > 0 else 1 - half))
    frame = pd.DataFrame(out, columns=["w", "p"], dtype=float)
    return pd.concat([part[[*keys, "n"]].reset_index(drop=True), frame], axis=1)


def shapiro_wilk(df: DataFrame, x: str, *by: str) -> DataFrame:
    """by, n, w, p: of each group the statistic and its p by Royston's approximation, which is made for up to 5,000 values and is
    carried on beyond. Null and NaN values don't count; fewer than 3, or equal ones, give null.

    Values are ranked over all groups at once in two steps (numbering.numbered), so no group meets in one task.
    """
    keys = list(by) or ["__all"]
    rows = df.where(F.col(x).isNotNull() & ~F.isnan(x)).select(*([F.lit(0).alias("__all")] if not by else by), F.col(x).cast("double").alias("__x"))
    ranked = numbering.numbered(rows, *keys, "__x", name="__n")
    size = ranked.groupBy(*keys).agg(F.count("*").alias("n"), (F.min("__n") - 1).alias("__start"), F.avg("__x").alias("__mean"))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    own = ranked.alias("a").join(size.alias("b"), on).select(*[F.col(f"a.{k}").alias(k) for k in keys], "n", "__mean", (F.col("__x") - F.col("__mean")).alias("__x"), (F.col("__n") - F.col("__start")).alias("__i"))
    scored = own.withColumn("__q", (F.col("__i") - 0.375) / (F.col("n") + 0.25)).withColumn("__m", norm_quantile("__q"))
    at = lambda place, value: F.max(F.when(F.col("__i") == place, F.col(value)))
    n = F.col("n")
    sums = scored.groupBy(*keys, "n").agg(
        F.sum(F.col("__m") ** 2).alias("mm"), F.sum(F.col("__m") * F.col("__x")).alias("mx"), F.sum(F.col("__x") ** 2).alias("ss"),
        at(n, "__x").alias("x1"), at(n - 1, "__x").alias("x2"), at(F.lit(1), "__x").alias("y1"), at(F.lit(2), "__x").alias("y2"), at(n, "__m").alias("m1"), at(n - 1, "__m").alias("m2"))
    kinds = dict(sums.dtypes)
    out = sums.mapInPandas(lambda parts: (_finish(p, keys) for p in parts if len(p)), ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "n long, w double, p double"]))
    return out.drop("__all")
