"""Scans with permuted phenotypes and with interactions, whose extremes and thresholds are found inside the tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from statloom.functions.stats import beta_tail, p_from_t, t_two_sided
from statloom.operators import assoc, blocks


def permuted(phenotypes: DataFrame, permutations: int, seed: int, plain: bool = True) -> DataFrame:
    """phenotype, perm, iid, y: the phenotypes (phenotype, iid, y) as perm 0 if `plain`, and their values dealt anew over the
    samples that have them as perms 1, 2, ... Phenotypes of the same samples are permuted alike. A task holds one phenotype."""
    kinds = dict(phenotypes.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(parts)).sort_values("iid")
        part = part[part["y"].notna()]
        for k in range(0 if plain else 1, permutations + 1):
            y = part["y"].to_numpy(float)
            yield pd.DataFrame({"phenotype": part["phenotype"], "perm": k, "iid": part["iid"], "y": np.random.default_rng([seed, k]).permutation(y) if k else y})

    return phenotypes.groupBy("phenotype").applyInPandas(run, f"phenotype {kinds['phenotype']}, perm int, iid {kinds['iid']}, y double")


def regression(dosages: DataFrame, phenotypes: DataFrame, covariates: DataFrame, maf: float = 0.0, permute: int | None = None, min_abs_t: float | None = None) -> DataFrame:
    """variant, phenotype, beta, se, t in one go: variants whose coded-allele frequency is within `maf` of neither end and isn't
    one half (0: all), with phenotypes permuted by the seed `permute` if one is given. As assoc.scan() otherwise."""
    if maf:
        good = dosages.groupBy("variant").agg((F.avg("g") / 2).alias("af")).where(assoc.maf_filter(F.col("af"), maf)).select("variant")
        dosages = dosages.join(good, "variant", "left_semi")
    y = phenotypes if permute is None else permuted(phenotypes, 1, permute, plain=False).select("phenotype", "iid", "y")
    return assoc.scan(dosages, y, covariates, min_abs_t)


def permutation_scan(dosages: DataFrame, phenotypes: DataFrame, covariates: DataFrame, permutations: int, seed: int) -> DataFrame:
    """phenotype, perm, variant, t: the variant with the largest |t| (ties: the smaller one), for the phenotypes as they are (perm 0)
    and for each permutation. Permuted copies are further rows of the phenotypes' tiles; a tile's task keeps a row each."""
    values = permuted(phenotypes, permutations, seed)
    kind, of = values.schema["phenotype"].dataType, dosages.schema["variant"].dataType
    first = covariates.select(F.size("c")).first()
    k = 1 + (first[0] if first else 0)
    coded = values.select(F.concat_ws("/", "perm", F.col("phenotype").cast("string")).alias("name"), "iid", "y")

    def finish(sums: blocks.Sums) -> Iterator[pa.RecordBatch]:
        t = assoc.swept(sums)[2]
        rows = np.array(list(sums.rows))
        order = np.argsort(rows, kind="stable")
        best = order[np.abs(t[order]).argmax(0)]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums.cols)), pa.array(rows[best].tolist(), to_arrow_type(of)), pa.array(t[best, np.arange(t.shape[1])])], names=["name", "variant", "t"])

    tops = blocks.multiply(dosages, coded, finish, f"name string, variant {of.simpleString()}, t double", ("variant", "iid", "g"), ("name", "iid", "y"), assoc._design(covariates), k)
    top = tops.groupBy("name").agg(F.min(F.struct(-F.abs("t"), "variant", "t")).alias("m")).select("name", "m.variant", "m.t")
    at = F.locate("/", F.col("name"))
    return top.select(F.substring("name", at + 1, F.length("name")).cast(kind).alias("phenotype"), F.substring("name", F.lit(1), at - 1).cast("int").alias("perm"), "variant", "t")


def beta_fit(p: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Shapes of a beta distribution by maximum likelihood, from moments and Newton's steps on numeric derivatives."""
    from math import lgamma

    p = np.clip(p, 1e-12, 1 - 1e-12)
    m, v = float(p.mean()), float(p.var())
    if not v or v >= m * (1 - m):
        return 1.0, 1.0
    a, b = m * (m * (1 - m) / v - 1), (1 - m) * (m * (1 - m) / v - 1)
    s, r = np.log(p).mean(), np.log1p(-p).mean()

    def value(x: np.ndarray) -> float:
        a, b = np.exp(x)
        return lgamma(a + b) - lgamma(a) - lgamma(b) + (a - 1) * s + (b - 1) * r

    x, h = np.log([a, b]), 1e-4
    for _ in range(rounds):
        e = np.eye(2) * h
        grad = np.array([(value(x + d) - value(x - d)) / (2 * h) for d in e])
        bend = np.array([[(value(x + d + c) - value(x + d - c) - value(x - d + c) + value(x - d - c)) / (4 * h * h) for c in e] for d in e])
        step = np.linalg.solve(bend, grad) if np.linalg.eigvalsh(bend)[-1] < 0 else -grad
        step = np.clip(step, -0.5, 0.5)
        x = x - step
        if np.abs(step).max() < 1e-7:
            break
    return tuple(np.exp(x).tolist())


def empirical_p(tops: DataFrame, df: int) -> DataFrame:
    """phenotype, variant, t, p, p_perm, p_beta from permutation_scan(): the nominal p of the best variant; the share of permutations
    at least as extreme, (r + 1) / (n + 1); and p's place in the beta distribution that the permutations' smallest p follow."""
    kinds = dict(tops.dtypes)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        own, null = part[part["perm"] == 0], part[part["perm"] > 0]
        n = len(null)
        p0 = t_two_sided(null["t"].to_numpy(float), np.full(n, float(df)))
        a, b = beta_fit(np.asarray(p0)) if n > 1 else (1.0, 1.0)
        p = np.asarray(t_two_sided(own["t"].to_numpy(float), np.full(len(own), float(df))))
        more = (np.abs(null["t"].to_numpy())[None] >= np.abs(own["t"].to_numpy())[:, None]).sum(1)
        return pd.DataFrame({"phenotype": own["phenotype"], "variant": own["variant"], "t": own["t"], "p": p, "p_perm": (more + 1) / (n + 1), "p_beta": beta_tail(np.full(len(p), a), np.full(len(p), b), p)})

    return tops.groupBy("phenotype").applyInPandas(run, f"phenotype {kinds['phenotype']}, variant {kinds['variant']}, t double, p double, p_perm double, p_beta double")


class Interaction(blocks.Sums):
    """Besides, sums with the moderator, the second column of the covariates: of g * i with y, and of a variant's squares."""

    def __init__(self, covariates: int) -> None:
        super().__init__(covariates)
        self.giy = np.zeros((0, 0))
        self.g = np.zeros((0, 6))

    def add(self, names: np.ndarray, x: np.ndarray, others: np.ndarray, y: np.ndarray, c: np.ndarray | None) -> None:
        super().add(names, x, others, y, c)
        at, to = self._places(self.rows, names), self._places(self.cols, others)
        size = len(self.rows), len(self.cols)
        self.giy = np.pad(self.giy, [(0, size[0] - self.giy.shape[0]), (0, size[1] - self.giy.shape[1])])
        self.g = np.pad(self.g, [(0, size[0] - len(self.g)), (0, 0)])
        x0, y0, i = np.nan_to_num(x), np.nan_to_num(y), c[:, 1]
        self.giy[np.ix_(at, to)] += (x0 * i) @ y0.T
        powers = np.column_stack([np.ones(len(i)), i, i * i])
        self.g[at] += np.hstack([x0 @ powers, (x0 * x0) @ powers])

    def merge(self, other: Interaction) -> tuple[np.ndarray, np.ndarray]:
        i, j = super().merge(other)
        self.giy = np.pad(self.giy, [(0, len(self.rows) - self.giy.shape[0]), (0, len(self.cols) - self.giy.shape[1])])
        self.g = np.pad(self.g, [(0, len(self.rows) - len(self.g)), (0, 0)])
        self.giy[np.ix_(i, j)] += other.giy
        self.g[i] += other.g
        return i, j


def interaction(dosages: DataFrame, phenotypes: DataFrame, moderator: DataFrame, least_maf: float = 0.05, min_abs_t: float | None = None) -> DataFrame:
    """variant, phenotype, n, beta, t of the product term in y ~ g + i + g*i, by tiles.

    A variant counts only if its minor allele frequency is at least least_maf in both halves of the moderator (iid, i). Missing
    dosages and phenotypes take their feature's mean; samples are those with a moderator. An exact fit, such as of the
    moderator itself, has t 0. Pairs at or under min_abs_t never leave the kernel.
    """
    known = moderator.where("i is not null and not isnan(i)")
    half = known.agg(F.percentile("i", 0.5)).first()[0]
    g = dosages.where("g is not null").join(known, "iid")
    af = g.groupBy("variant", (F.col("i") > half).alias("__h")).agg((F.avg("g") / 2).alias("p"), F.sum("g").alias("s"), F.count("*").alias("k"))
    good = af.groupBy("variant").agg(F.min(F.least("p", 1 - F.col("p"))).alias("m"), F.count("*").alias("c"), (F.sum("s") / F.sum("k")).alias("mean")).where(f"m >= {least_maf} and c = 2").select("variant", "mean")
    # centred, so that a missing value counts as the mean; the product term's coefficient stays
    x = g.join(good, "variant").select("variant", "iid", (F.col("g") - F.col("mean")).alias("g"))
    there = phenotypes.where("y is not null").join(known.select("iid"), "iid", "left_semi")
    mean = there.groupBy("phenotype").agg(F.avg("y").alias("mean"))
    y = there.join(mean, "phenotype").select("phenotype", "iid", (F.col("y") - F.col("mean")).alias("y"))
    keys, kinds = assoc._kinds((dosages, "variant"), (phenotypes, "phenotype"))

    def finish(s: Interaction) -> Iterator[pa.RecordBatch]:
        n, si, sii = s.a[0, 0], s.a[0, 1], s.a[1, 1]
        centre, spread = si / n, max(sii - si * si / n, 1e-300)

        def free(total: np.ndarray, a1: np.ndarray, ai: np.ndarray, b1: np.ndarray, bi: np.ndarray) -> np.ndarray:
            """Sum of products after the intercept and the moderator are swept out of both."""
            return total - a1 * b1 / n - (ai - centre * a1) * (bi - centre * b1) / spread

        g1, gi, gii, gg, ggi, ggii = (v[:, None] for v in s.g.T)
        y1, yi = (v[None] for v in s.own["y"][:, [2, 3]].T)
        yy = s.squares["y"][None]
        xx, xh, hh = free(gg, g1, gi, g1, gi), free(ggi, g1, gi, gi, gii), free(ggii, gi, gii, gi, gii)
        xy, hy, rest = free(s.pair["xy"], g1, gi, y1, yi), free(s.giy, gi, gii, y1, yi), free(yy, y1, yi, y1, yi)
        with np.errstate(all="ignore"):
            lead = np.where(xx > 1e-12 * gg, 1 / xx, 0.0)
            hh, hy, rest = hh - xh * xh * lead, hy - xh * xy * lead, rest - xy * xy * lead
            ok = hh > 1e-12 * ggii
            beta = np.where(ok, hy / hh, 0.0)
            left = rest - beta * hy
            se = np.sqrt(np.where(ok & (left > 1e-12 * yy), left, 0.0) / (n - 4) / hh)
            t = np.where(se > 0, beta / se, 0.0)
        keep = np.ones(t.shape, bool) if min_abs_t is None else np.abs(t) > min_abs_t
        yield from blocks.rows(s, keep, {"n": np.full(t.shape, int(n)), "beta": beta, "t": t}, kinds, ("variant", "phenotype"))

    c = known.select("iid", F.array(F.lit(1.0), F.col("i").cast("double")).alias("c"))
    return blocks.multiply(x, y, finish, f"{keys}, n long, beta double, t double", ("variant", "iid", "g"), ("phenotype", "iid", "y"), c, 2, kernel=Interaction)


def top_interactions(fits: DataFrame, groups: DataFrame, tests: DataFrame) -> DataFrame:
    """phenotype, variant, t, p, tests, p_adjusted: of each phenotype the variant with the smallest p of interaction()
    (ties: the smaller one), times the number of independent tests (chr, tests) of its chromosome (variant, chr), 1 at most."""
    p = fits.select("variant", "phenotype", "t", p_from_t("t", (F.col("n") - 4).cast("double")).alias("p")).where("p is not null")
    top = p.groupBy("phenotype").agg(F.min(F.struct("p", "variant", "t")).alias("m")).select("phenotype", "m.variant", "m.t", "m.p")
    return top.join(groups, "variant").join(tests, "chr").select("phenotype", "variant", "t", "p", "tests", F.least(F.lit(1.0), F.col("p") * F.col("tests")).alias("p_adjusted"))
