"""All-pairs regression from sums that merge: statistics of a study, their pooling, the solution, meta-analysis.

A study is given in long form: dosages (variant, iid, g), phenotypes (phenotype, iid, y), covariates (iid, c array). The
covariates' block is summed once, a variant's and a phenotype's vectors once each; only sum(g*y) needs the pair join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from statloom.functions.stats import CHI2_MEDIAN
from statloom.operators import blocks


def _design(covariates: DataFrame, *by: str) -> DataFrame:
    """(iid, c) with the intercept in front, and the columns `by`."""
    return covariates.select(*by, "iid", F.concat(F.array(F.lit(1.0)), F.col("c").cast("array<double>")).alias("c"))


def _dots(vector: Column, k: int, scalar: Column) -> Column:
    return F.array(*[F.sum(vector[i] * scalar) for i in range(k)])


def covariate_block(covariates: DataFrame, k: int, *by: str) -> DataFrame:
    """One row (or one for each value of `by`): n and a_cov, the (k + 1)**2 sums of products of intercept and covariates, row by row."""
    d = _design(covariates, *by)
    return d.groupBy(*by).agg(F.count("*").alias("n"), F.array(*[F.sum(F.col("c")[i] * F.col("c")[j]) for i in range(k + 1) for j in range(k + 1)]).alias("a_cov"))


def variant_sums(dosages: DataFrame, covariates: DataFrame, k: int, *by: str) -> DataFrame:
    """variant, a_test = [sum g, sum g*c ..., sum g*g], af."""
    d = dosages.join(_design(covariates, *by), [*by, "iid"])
    tests = F.concat(_dots(F.col("c"), k + 1, F.col("g")), F.array(F.sum(F.col("g") * F.col("g"))))
    return d.groupBy(*by, "variant").agg(tests.alias("a_test"), (F.avg("g") / 2).alias("af"))


def phenotype_sums(phenotypes: DataFrame, covariates: DataFrame, k: int, *by: str) -> DataFrame:
    """phenotype, b_cov = [sum y, sum c*y ...], c_yy = sum y*y."""
    d = phenotypes.join(_design(covariates, *by), [*by, "iid"])
    return d.groupBy(*by, "phenotype").agg(_dots(F.col("c"), k + 1, F.col("y")).alias("b_cov"), F.sum(F.col("y") * F.col("y")).alias("c_yy"))


def _kinds(*columns: tuple[DataFrame, str]) -> tuple[str, tuple]:
    """SQL names and Arrow types of key columns."""
    types = [d.schema[c].dataType for d, c in columns]
    return ", ".join(f"{n} {t.simpleString()}" for n, t in zip(("variant", "phenotype"), types, strict=True)), tuple(to_arrow_type(t) for t in types)


def pair_sums(dosages: DataFrame, phenotypes: DataFrame, covariates: DataFrame) -> DataFrame:
    """variant, phenotype, b4 = sum g*y over the samples of all three tables, by tiles; a missing value adds nothing."""
    keys, kinds = _kinds((dosages, "variant"), (phenotypes, "phenotype"))

    def finish(sums: blocks.Sums) -> Iterator[pa.RecordBatch]:
        yield from blocks.rows(sums, sums.pair["n"] > 0, {"b4": sums.pair["xy"]}, kinds, ("variant", "phenotype"))

    there = dosages.join(covariates.select("iid"), "iid", "left_semi")
    return blocks.multiply(there, phenotypes, finish, f"{keys}, b4 double", ("variant", "iid", "g"), ("phenotype", "iid", "y"))


def scan_simple(dosages: DataFrame, phenotypes: DataFrame, min_abs_t: float | None = None) -> DataFrame:
    """variant, phenotype, n, beta, r2, t, se of simple regressions of every phenotype on every variant, by tiles.

    A pair's samples are those that have both. Results are null where either is constant or fewer than three samples are left;
    of a perfect fit t is null. Pairs at or under min_abs_t never leave the kernel, nor pairs without samples.
    """
    keys, kinds = _kinds((dosages, "variant"), (phenotypes, "phenotype"))

    def finish(sums: blocks.Sums) -> Iterator[pa.RecordBatch]:
        n, x, y, xx, yy, xy = (sums.pair[k] for k in ("n", "x", "y", "xx", "yy", "xy"))
        with np.errstate(all="ignore"):
            sxx, syy, sxy = xx - x * x / n, yy - y * y / n, xy - x * y / n
            good = (n > 0) & (sxx > 1e-12 * xx) & (syy > 1e-12 * yy)
            beta = np.where(good, sxy / sxx, np.nan)
            r2 = np.where(good, sxy * sxy / (sxx * syy), np.nan)
            t = np.where((n > 2) & (r2 < 1), np.sign(beta) * np.sqrt(r2 * (n - 2) / (1 - r2)), np.nan)
            se = np.abs(beta / t)
        keep = n > 0 if min_abs_t is None else np.abs(t) > min_abs_t
        values = {"n": n.astype(np.int64), "beta": beta, "r2": r2, "t": t, "se": se}
        for batch in blocks.rows(sums, keep, values, kinds, ("variant", "phenotype")):
            columns = [c if not pa.types.is_floating(c.type) else pa.array(c.to_numpy(zero_copy_only=False), from_pandas=True) for c in batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return blocks.multiply(dosages, phenotypes, finish, f"{keys}, n long, beta double, r2 double, t double, se double", ("variant", "iid", "g"), ("phenotype", "iid", "y"))


def study(dosages: DataFrame, phenotypes: DataFrame, covariates: DataFrame, k: int) -> DataFrame:
    """Partial statistics of one study, a row a pair: variant, phenotype, n, af and the sums that solve() needs."""
    block = covariate_block(covariates, k)  # one row
    pairs = pair_sums(dosages, phenotypes, covariates)
    out = pairs.join(variant_sums(dosages, covariates, k), "variant").join(phenotype_sums(phenotypes, covariates, k), "phenotype")
    return out.crossJoin(F.broadcast(block))


def studies(dosages: DataFrame, phenotypes: DataFrame, covariates: DataFrame, k: int) -> DataFrame:
    """The rows of study() for each study, and its number `study`, an int column of all three tables (0, 1, ...). Every table is
    read once for all studies, whose tiles don't meet those of others."""
    numbered = lambda df, name: df.select("study", F.concat_ws("/", "study", F.col(name).cast("string")).alias("__n"), "iid", F.col({"variant": "g", "phenotype": "y"}[name]).alias("v"))
    there = dosages.join(covariates.select("study", "iid"), ["study", "iid"], "left_semi")
    at = F.locate("/", "__n")

    def finish(sums: blocks.Sums) -> Iterator[pa.RecordBatch]:
        yield from blocks.rows(sums, sums.pair["n"] > 0, {"b4": sums.pair["xy"]}, (pa.string(), pa.string()), ("__n", "__p"))

    pairs = blocks.multiply(numbered(there, "variant"), numbered(phenotypes, "phenotype"), finish, "__n string, __p string, b4 double", ("__n", "iid", "v"), ("__n", "iid", "v"), kernel=blocks.Products, within="study")
    name = lambda c, of, column: F.substring(c, at + 1, F.length(c)).cast(of.schema[column].dataType).alias(column)
    pairs = pairs.select(F.substring("__n", F.lit(1), at - 1).cast(dosages.schema["study"].dataType).alias("study"), name(F.col("__n"), dosages, "variant"), name(F.col("__p"), phenotypes, "phenotype"), "b4")
    out = pairs.join(variant_sums(dosages, covariates, k, "study"), ["study", "variant"]).join(phenotype_sums(phenotypes, covariates, k, "study"), ["study", "phenotype"])
    return out.join(F.broadcast(covariate_block(covariates, k, "study")), "study")


def pool(studies: DataFrame) -> DataFrame:
    """Sums of the statistics of several studies' rows for a pair; only studies that have the pair count."""
    def added(name: str) -> Column:
        size = F.first(F.size(name))
        return F.aggregate(F.collect_list(name), F.array_repeat(F.lit(0.0), size), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))

    af = F.sum(F.col("af") * F.col("n")) / F.sum("n")
    return studies.groupBy("variant", "phenotype").agg(F.sum("n").alias("n"), af.alias("af"), added("a_cov").alias("a_cov"), added("a_test").alias("a_test"), added("b_cov").alias("b_cov"), F.sum("c_yy").alias("c_yy"), F.sum("b4").alias("b4"))


def pool_within(studies: DataFrame, k: int) -> DataFrame:
    """Statistics of a pooled model with an intercept for each study, from rows of study(), one a study and pair, of k covariates.

    The studies' intercepts make the system an arrowhead: each study's is eliminated from its own sums (their Schur
    complement) before these are added up, so the solution has only the common covariates and the variant. n is less by
    the number of studies, which leaves solve() the right degrees of freedom.
    """
    last = k + 1  # of a_test, the variant's square; entry 0 everywhere belongs to the intercept
    n = F.col("n")
    a = lambda i, j: F.col("a_cov")[i * (k + 1) + j]
    g, y = F.col("a_test"), F.col("b_cov")
    cc = [F.sum(a(i, j) - a(i, 0) * a(0, j) / n) for i in range(1, k + 1) for j in range(1, k + 1)]
    gc = [F.sum(g[i] - g[0] * a(0, i) / n) for i in range(1, k + 1)]
    cy = [F.sum(y[i] - y[0] * a(0, i) / n) for i in range(1, k + 1)]
    of = lambda sums: F.array(*sums) if sums else F.expr("cast(array() as array<double>)")
    af = F.sum(F.col("af") * n) / F.sum("n")
    return studies.groupBy("variant", "phenotype").agg(
        (F.sum("n") - F.count("*")).alias("n"), af.alias("af"), of(cc).alias("a_cov"), F.array(*gc, F.sum(g[last] - g[0] * g[0] / n)).alias("a_test"),
        of(cy).alias("b_cov"), F.sum(F.col("c_yy") - y[0] * y[0] / n).alias("c_yy"), F.sum(F.col("b4") - g[0] * y[0] / n).alias("b4"))


def select_covariates(stats: DataFrame, wanted: list[int], k: int) -> DataFrame:
    """Statistics of a model with the wanted covariates (numbered from 1) of k; the intercept always stays."""
    if any(i < 1 or i > k for i in wanted):
        raise ValueError("covariates are numbered from 1")
    keep = [0, *wanted]
    return (
        stats.withColumn("a_cov", F.array(*[F.col("a_cov")[i * (k + 1) + j] for i in keep for j in keep]))
        .withColumn("a_test", F.array(*[F.col("a_test")[i] for i in keep], F.col("a_test")[k + 1]))
        .withColumn("b_cov", F.array(*[F.col("b_cov")[i] for i in keep]))
    )


def solve(stats: DataFrame, min_abs_t: float | None = None) -> DataFrame:
    """variant, phenotype, n, af, df, beta, se, t from statistics; a singular system gives zeros. Rows with |t| at or under
    min_abs_t never leave the kernel."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if not len(part):
                continue
            b_cov, a_test, a_cov = (np.array(part[c].tolist(), float) for c in ("b_cov", "a_test", "a_cov"))
            rows, k = len(part), b_cov.shape[1]
            a = np.zeros((rows, k + 1, k + 1))
            a[:, :k, :k] = a_cov.reshape(rows, k, k)
            a[:, k, :k] = a[:, :k, k] = a_test[:, :k]
            a[:, k, k] = a_test[:, k]
            b = np.concatenate([b_cov, part[["b4"]].to_numpy(float)], 1)
            scale = np.sqrt(np.maximum(np.einsum("rii->ri", a), 1e-300))
            unit = a / scale[:, :, None] / scale[:, None, :]
            good = np.linalg.svd(unit, compute_uv=False)[:, -1] > 1e-10
            inverse = np.zeros_like(a)
            inverse[good] = np.linalg.inv(unit[good])
            inverse = inverse / scale[:, :, None] / scale[:, None, :]
            x = np.einsum("rij,rj->ri", inverse, b)
            df = part["n"].to_numpy(float) - (k + 1)
            rest = np.abs(part["c_yy"].to_numpy(float) - np.einsum("ri,ri->r", b, x))
            with np.errstate(divide="ignore", invalid="ignore"):
                se = np.where(good & (df > 0), np.sqrt(inverse[:, k, k] * rest / df), 0.0)
                t = np.where(se > 0, x[:, k] / se, 0.0)
            out = pd.DataFrame({"variant": part["variant"], "phenotype": part["phenotype"], "n": part["n"], "af": part["af"], "df": df, "beta": np.where(good, x[:, k], 0.0), "se": se, "t": t})
            yield out if min_abs_t is None else out[np.abs(out["t"]) > min_abs_t]

    s = stats.schema
    return stats.mapInPandas(run, f"variant {s['variant'].dataType.simpleString()}, phenotype {s['phenotype'].dataType.simpleString()}, n long, af double, df double, beta double, se double, t double")


def pair_regression(pairs: DataFrame, *by: str, x: str = "g", y: str = "y") -> DataFrame:
    """n, beta, r2, t, se of simple regressions of y on x by group, over rows where both are present."""
    out = pairs.groupBy(*by).agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("beta"), F.regr_r2(y, x).alias("r2"))
    t = F.signum("beta") * F.sqrt(F.col("r2") * (F.col("n") - 2) / (1 - F.col("r2")))
    return out.withColumn("t", t).withColumn("se", F.abs(F.col("beta") / F.col("t")))


def by_correlation(fits: DataFrame) -> DataFrame:
    """variant, phenotype, n, b, f, se from scan_simple(): the slope r * sd(y) / sd(x), F = r**2 / ((1 - r**2) / (n - 2)) and
    the error |b| / sqrt(F). Its p value is that of F with 1 and n - 1 degrees of freedom, not n - 2."""
    f = F.col("t") ** 2
    return fits.select("variant", "phenotype", "n", F.col("beta").alias("b"), f.alias("f"), (F.abs("beta") / F.sqrt(f)).alias("se"))


def meta_fixed(results: DataFrame, cohorts: int | None = None) -> DataFrame:
    """Inverse-variance meta-analysis of rows (variant, phenotype, beta, se, n): beta, se, q, i2 raw and clipped at 0.

    i2 counts `cohorts` cohorts, or those present where that is None. Rows with a missing or zero se don't count.
    """
    w = 1 / (F.col("se") * F.col("se"))
    d = results.where("se > 0 and beta is not null").withColumn("__w", w)
    sums = d.groupBy("variant", "phenotype").agg(F.sum("__w").alias("w"), F.sum(F.col("__w") * F.col("beta")).alias("wb"), F.sum(F.col("__w") * F.col("beta") * F.col("beta")).alias("wbb"), F.sum("n").alias("n"), F.count("*").alias("k"))
    q = F.col("wbb") - F.col("wb") * F.col("wb") / F.col("w")
    k = F.lit(cohorts) if cohorts else F.col("k")
    out = sums.select("variant", "phenotype", "n", "k", (F.col("wb") / F.col("w")).alias("beta"), F.sqrt(1 / F.col("w")).alias("se"), q.alias("q"), k.alias("__k"))
    return out.withColumn("i2_raw", (F.col("q") - (F.col("__k") - 1)) / F.col("q") * 100).withColumn("i2", F.greatest("i2_raw", F.lit(0.0))).drop("__k")


def lambda_median(chi2: DataFrame, column: str = "chi2") -> DataFrame:
    """Genomic control: the median statistic over that of chi-square with one degree of freedom."""
    return chi2.agg((F.percentile(column, 0.5) / CHI2_MEDIAN).alias("lambda"))


def lambda_regression(observed: DataFrame, expected: str, seen: str) -> DataFrame:
    """Slope through the origin of sorted observed on expected statistics, and its standard error."""
    sums = observed.agg(F.sum(F.col(expected) * F.col(seen)).alias("xy"), F.sum(F.col(expected) ** 2).alias("xx"), F.sum(F.col(seen) ** 2).alias("yy"), F.count("*").alias("n"))
    slope = F.col("xy") / F.col("xx")
    return sums.select(slope.alias("lambda"), F.sqrt((F.col("yy") - slope * F.col("xy")) / (F.col("n") - 1) / F.col("xx")).alias("se"))


def maf_filter(af: Column, threshold: float, inclusive: bool = False) -> Column:
    """Coded-allele frequency within the threshold of neither end; exactly 0.5 is left out."""
    inside = (af >= threshold) & (af <= 1 - threshold) if inclusive else (af > threshold) & (af < 1 - threshold)
    return inside & (af != 0.5)


def residuals(values: DataFrame, covariates: DataFrame, k: int) -> DataFrame:
    """feat, iid, resid: x of (feat, iid, x) minus its least-squares fit on intercept and covariates, feature by feature.

    Samples without x don't count for that feature and have a null residual.
    """
    schema = f"feat {values.schema['feat'].dataType.simpleString()}, iid {values.schema['iid'].dataType.simpleString()}, resid double"

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("iid")
        x, c = part["x"].to_numpy(float), np.array(part["c"].tolist(), float)
        ok = ~np.isnan(x)
        out = np.full(len(x), np.nan)
        if ok.sum():
            q, r = np.linalg.qr(c[ok])
            q = q[:, np.abs(np.diag(r)) > 1e-10 * max(1.0, np.abs(r).max())]
            out[ok] = x[ok] - q @ (q.T @ x[ok])
        return pd.DataFrame({"feat": part["feat"], "iid": part["iid"], "resid": pd.Series(out, index=part.index).where(ok, None).astype(float)})

    return values.join(_design(covariates), "iid").select("feat", "iid", "x", "c").groupBy("feat").applyInPandas(fit, schema)


def age_acceleration(df: DataFrame, y: str, x: str) -> DataFrame:
    """df with `accel`: residuals of y on x, scaled by their sample deviation."""
    w = Window.partitionBy()
    s = df.agg(F.regr_slope(y, x).alias("__b"), F.regr_intercept(y, x).alias("__a"))
    d = df.crossJoin(F.broadcast(s)).withColumn("__e", F.col(y) - F.col("__a") - F.col("__b") * F.col(x))
    sd = d.agg(F.stddev_samp("__e").alias("__sd"), F.avg("__e").alias("__m"))
    return d.crossJoin(F.broadcast(sd)).withColumn("accel", F.col("__e") / F.col("__sd")).drop("__a", "__b", "__e", "__sd", "__m")


def encode(genotypes: np.ndarray, phenotypes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """G F and F**-1 Y for a random integer F in 1..9, samples along F: their product is that of G and Y."""
    n, rng = genotypes.shape[1], np.random.default_rng(seed)
    while True:
        f = rng.integers(1, 10, (n, n)).astype(float)
        if np.linalg.cond(f) < 1e8:
            return genotypes @ f, np.linalg.solve(f, phenotypes)


def swept(sums: blocks.Sums) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(beta, se, t) of a tile's pairs, freed of intercept and covariates; zeros where either side is constant beyond them."""
    xy, xx, yy, xc, yc = sums.filled()
    value, vector = np.linalg.eigh(sums.a / np.sqrt(np.outer(np.diag(sums.a), np.diag(sums.a)).clip(1e-300)))
    good = value > 1e-10 * value.max()
    scale = np.sqrt(np.diag(sums.a).clip(1e-300))
    basis = vector[:, good] / np.sqrt(value[good]) / scale[:, None]  # basis @ basis.T inverts a
    px, py = xc @ basis, yc @ basis
    sxx, syy = xx - (px * px).sum(1), yy - (py * py).sum(1)
    sxx, syy = np.where(sxx > 1e-12 * xx, sxx, 0.0)[:, None], np.where(syy > 1e-12 * yy, syy, 0.0)[None]
    sxy = np.where((sxx > 0) & (syy > 0), xy - px @ py.T, 0.0)
    df = sums.a[0, 0] - good.sum() - 1
    beta = np.divide(sxy, sxx, out=np.zeros_like(sxy), where=sxx > 0)
    rest = np.maximum(syy - beta * sxy, 1e-300)
    se = np.sqrt(np.divide(rest, df * sxx, out=np.zeros_like(sxy), where=(sxx > 0) & (syy > 0) & (df > 0)))
    return beta, se, np.divide(beta, se, out=np.zeros_like(sxy), where=se > 0)


def scan(dosages: DataFrame, phenotypes: DataFrame, covariates: DataFrame, min_abs_t: float | None = None) -> DataFrame:
    """variant, phenotype, beta, se, t of every pair in one cohort, freed of intercept and covariates, by tiles.

    Sums of products with the covariates are swept out of those of each pair (Frisch-Waugh), so a task holds tiles and sums
    alone, whatever the number of variants, phenotypes or samples. Missing values take their feature's mean; samples are those
    with covariates. Constant features give zeros. Pairs at or under min_abs_t never leave the kernel. Agrees with
    solve(study()) on complete data.
    """
    keys, kinds = _kinds((dosages, "variant"), (phenotypes, "phenotype"))
    first = covariates.select(F.size("c")).first()
    k = 1 + (first[0] if first else 0)

    def finish(sums: blocks.Sums) -> Iterator[pa.RecordBatch]:
        beta, se, t = swept(sums)
        keep = np.ones(t.shape, bool) if min_abs_t is None else np.abs(t) > min_abs_t
        yield from blocks.rows(sums, keep, {"beta": beta, "se": se, "t": t}, kinds, ("variant", "phenotype"))

    return blocks.multiply(dosages, phenotypes, finish, f"{keys}, beta double, se double, t double", ("variant", "iid", "g"), ("phenotype", "iid", "y"), _design(covariates), k)
