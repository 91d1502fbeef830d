"""Models by group: logistic regression, mixed models, heritability, mediation, mixtures, densities, permutation, tests."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.scalars import gaussian_crossing
from statloom.functions.stats import norm_two_sided, t_two_sided
from statloom.operators import numbering
from statloom.operators.kinship import fit_polygenic


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and standard errors by iterated weighted least squares; columns of x as given."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-10)
        h = np.linalg.pinv((x * w[:, None]).T @ x)
        step = h @ (x.T @ (y - p))
        b = b + step
        if np.abs(step).max() < 1e-10:
            break
    return b, np.sqrt(np.maximum(np.diag(h), 0))


def glm(pairs: DataFrame, *by: str, kind: str = "linear") -> DataFrame:
    """by, n, beta, se, stat, p, low, high of y on g by group with 95 per cent bounds; logistic takes y in 1 and 2."""
    types = dict(pairs.dtypes)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        d = part.dropna(subset=["g", "y"])
        x, y = np.column_stack([np.ones(len(d)), d["g"].to_numpy(float)]), d["y"].to_numpy(float)
        if kind == "logistic":
            b, s = logistic(x, y - 1)
            beta, se = b[1], s[1]
            z = beta / se if se else 0.0
            p = float(norm_two_sided(z))
        else:
            b = np.linalg.lstsq(x, y, rcond=None)[0]
            e = y - x @ b
            sxx = ((x[:, 1] - x[:, 1].mean()) ** 2).sum()
            beta, se = b[1], np.sqrt(e @ e / max(len(y) - 2, 1) / sxx) if sxx else 0.0
            z = beta / se if se else 0.0
            p = float(t_two_sided(z, max(len(y) - 2, 1)))
        row = {k: part[k].iloc[0] for k in by} | {"n": len(d), "beta": beta, "se": se, "stat": z, "p": p, "low": beta - 1.959963984540054 * se, "high": beta + 1.959963984540054 * se}
        return pd.DataFrame([row])

    return pairs.select(*by, "g", "y").groupBy(*by).applyInPandas(fit, ", ".join(f"{k} {types[k]}" for k in by) + ", n long, beta double, se double, stat double, p double, low double, high double")


def mixed_scan(dosages: DataFrame, y: np.ndarray, ids: list, lam: np.ndarray, vec: np.ndarray) -> DataFrame:
    """variant, beta, se, t of each variant under a mixed model whose variance share is fitted once without variants.

    lam and vec are those of kinship.spectrum(): the decorrelating transform is applied from them and never formed; they are
    broadcast and variants are independent.
    """
    null = fit_polygenic(lam, vec, y, np.ones((len(y), 1)))
    s, so = (np.sqrt(np.maximum(v * null["h2"] + 1 - null["h2"], 1e-8)) for v in (lam, 0.0))

    def whiten(v: np.ndarray, vec_: np.ndarray) -> np.ndarray:
        r = vec_.T @ v
        return vec_ @ (r / s) + (v - vec_ @ r) / so

    known = dosages.sparkSession.sparkContext.broadcast((list(ids), vec, whiten(y, vec), whiten(np.ones(len(y)), vec)))
    kind = dict(dosages.dtypes)["variant"]

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        order, vec_, yr, one = known.value
        g = part.set_index("iid")["g"].reindex(order)
        x = np.column_stack([one, whiten(g.fillna(g.mean()).to_numpy(float), vec_)])
        h = np.linalg.pinv(x.T @ x)
        b = h @ (x.T @ yr)
        e = yr - x @ b
        se = float(np.sqrt(h[1, 1] * (e @ e) / (len(yr) - 2)))
        return pd.DataFrame([{"variant": part["variant"].iloc[0], "beta": b[1], "se": se, "t": b[1] / se if se else 0.0}])

    return dosages.groupBy("variant").applyInPandas(fit, f"variant {kind}, beta double, se double, t double")


def heritability(values: DataFrame, ids: list, lam: np.ndarray, vec: np.ndarray) -> DataFrame:
    """feat, h2, loglik, null_loglik, lrt of each feature (feat, iid, x): maximum likelihood with and without the share, from
    kinship.spectrum()."""
    known = values.sparkSession.sparkContext.broadcast((list(ids), lam, vec))
    kind = dict(values.dtypes)["feat"]

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        order, lam_, vec_ = known.value
        x = part.set_index("iid")["x"].reindex(order)
        y, one = x.fillna(x.mean()).to_numpy(float), np.ones((len(order), 1))
        full, none = fit_polygenic(lam_, vec_, y, one), fit_polygenic(np.ones(len(lam_)), vec_, y, one, 1.0)
        return pd.DataFrame([{"feat": part["feat"].iloc[0], "h2": full["h2"], "loglik": full["loglik"], "null_loglik": none["loglik"], "lrt": max(0.0, 2 * (full["loglik"] - none["loglik"]))}])

    return values.groupBy("feat").applyInPandas(fit, f"feat {kind}, h2 double, loglik double, null_loglik double, lrt double")


def mediation(rows: DataFrame, *by: str, draws: int = 400, seed: int = 1) -> DataFrame:
    """by, acme, ade, total, proportion, p of x -> m -> y by group: quasi-Bayesian draws of linear models, seeded by group."""
    types = dict(rows.dtypes)

    def ols(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.linalg.pinv(x.T @ x)
        b = h @ (x.T @ y)
        e = y - x @ b
        return b, h * (e @ e) / max(len(y) - x.shape[1], 1)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        d = part.dropna(subset=["x", "m", "y"]).sort_values(["x", "m", "y"])
        x, m, y = (d[c].to_numpy(float) for c in ("x", "m", "y"))
        one, rng = np.ones(len(d)), np.random.default_rng(seed)
        a = rng.multivariate_normal(*ols(np.column_stack([one, x]), m), draws)
        b = rng.multivariate_normal(*ols(np.column_stack([one, x, m]), y), draws)
        acme, ade = a[:, 1] * b[:, 2], b[:, 1]
        total = acme + ade
        p = min(1.0, 2 * min((acme > 0).mean(), (acme < 0).mean()))
        row = {k: part[k].iloc[0] for k in by} | {"acme": acme.mean(), "ade": ade.mean(), "total": total.mean(), "proportion": np.median(acme / total), "p": p}
        return pd.DataFrame([row])

    return rows.groupBy(*by).applyInPandas(fit, ", ".join(f"{k} {types[k]}" for k in by) + ", acme double, ade double, total double, proportion double, p double")


def two_gaussians(x: np.ndarray, rounds: int = 500) -> dict:
    """A mixture of two normal densities by expectation maximisation from the quartiles: weights, means, deviations."""
    x = np.sort(np.asarray(x, float))
    mean, sd, w = np.quantile(x, [0.25, 0.75]), np.full(2, x.std() + 1e-9), np.full(2, 0.5)
    for _ in range(rounds):
        d = w * np.exp(-0.5 * ((x[:, None] - mean) / sd) ** 2) / sd
        r = d / np.maximum(d.sum(1, keepdims=True), 1e-300)
        n = r.sum(0)
        new = (r * x[:, None]).sum(0) / n
        sd, w = np.sqrt((r * (x[:, None] - new) ** 2).sum(0) / n) + 1e-9, n / len(x)
        if np.abs(new - mean).max() < 1e-10:
            break
        mean = new
    return {"weight": w, "mean": mean, "sd": sd}


def density(df: DataFrame, x: str, *by: str, points: int = 64) -> DataFrame:
    """by, at, density: Gaussian kernel estimate on an even grid over each group's range, Silverman's bandwidth.

    The grid is joined to a histogram 8 times as fine, not to the rows, so its cost doesn't grow with them.
    """
    keys = list(by)
    s = df.where(F.col(x).isNotNull()).groupBy(*keys).agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n")).where("sd > 0")
    s = s.withColumn("h", 0.9 * F.col("sd") * F.pow(F.col("n"), F.lit(-0.2)))
    fine = points * 8
    d = df.join(s, keys) if keys else df.crossJoin(F.broadcast(s))
    cell = F.least(F.floor((F.col(x) - F.col("lo")) / (F.col("hi") - F.col("lo")) * fine), F.lit(fine - 1))
    bins = d.where(F.col(x).isNotNull()).groupBy(*keys, "lo", "hi", "h", "n", cell.alias("c")).agg(F.count("*").alias("k"))
    bins = bins.withColumn("mid", F.col("lo") + (F.col("c") + 0.5) * (F.col("hi") - F.col("lo")) / fine)
    grid = bins.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("at", F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1))
    kernel = F.exp(-0.5 * ((F.col("at") - F.col("mid")) / F.col("h")) ** 2) * F.col("k") / (F.col("h") * F.col("n") * 2.5066282746310002)
    return grid.groupBy(*keys, "at").agg(F.sum(kernel).alias("density"))


def permute(df: DataFrame, column: str, key: str, seed: int) -> DataFrame:
    """df with column's values dealt anew over the rows by a seeded order of the key, which is unique."""
    place = numbering.numbered(df.select(key), key, name="__n")
    drawn = numbering.numbered(df.select(key, F.col(column).alias("__v")), F.xxhash64(F.col(key), F.lit(seed)), key, name="__n").drop(key)
    return df.join(place, key).join(drawn, "__n").withColumn(column, F.col("__v")).drop("__n", "__v")


#: Bins of a group's range in which mixture() counts values.
BINS = 4_096


def mixture(df: DataFrame, x: str, *by: str, rounds: int = 500) -> DataFrame:
    """by, w1, m1, s1, w2, m2, s2, cut, dip: of each group a mixture of two normal densities, the smaller mean first; where their
    weighted densities cross between the means (null if they don't); where a kernel estimate is least between them.

    Values are counted once, in BINS bins of their group's range, with each bin's sum and sum of squares; expectation
    maximisation from the quartiles runs over these bins, all groups side by side, and what a task holds doesn't grow
    with the rows. Null and NaN values don't count; groups of fewer than two different values are left out.
    """
    keys = list(by)
    rows = df.where(F.col(x).isNotNull() & ~F.isnan(x)).select(*keys, F.col(x).cast("double").alias("__x"))
    rows = rows if keys else rows.withColumn("__all", F.lit(0))
    on = keys or ["__all"]
    ends = rows.groupBy(*on).agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi")).where("__lo < __hi")
    cell = F.least(F.floor((F.col("__x") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * BINS), F.lit(BINS - 1)).cast("int")
    bins = rows.join(ends, on).groupBy(*on, cell.alias("__bin")).agg(F.count("*").alias("__n"), F.sum("__x").alias("__s"), F.sum(F.col("__x") ** 2).alias("__q"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__bin")
        n, s, q = (part[c].to_numpy(float) for c in ("__n", "__s", "__q"))
        at, total = s / n, n.sum()
        spread = np.maximum(q / n - at * at, 0.0)  # variance within a bin
        share = (np.cumsum(n) - n / 2) / total
        mean = np.interp([0.25, 0.75], share, at)
        sd = np.full(2, np.sqrt(max(q.sum() / total - (s.sum() / total) ** 2, 0.0)) + 1e-9)
        w = np.full(2, 0.5)
        for _ in range(rounds):
            d = w * np.exp(-0.5 * ((at[:, None] - mean) / sd) ** 2) / sd
            r = n[:, None] * d / np.maximum(d.sum(1, keepdims=True), 1e-300)
            own = np.maximum(r.sum(0), 1e-300)
            new = (r * at[:, None]).sum(0) / own
            sd, w = np.sqrt((r * ((at[:, None] - new) ** 2 + spread[:, None])).sum(0) / own) + 1e-9, own / total
            done = np.abs(new - mean).max() < 1e-10
            mean = new
            if done:
                break
        o = np.argsort(mean, kind="stable")
        w, mean, sd = w[o], mean[o], sd[o]
        width = 0.9 * min(np.sqrt(max(q.sum() / total - (s.sum() / total) ** 2, 0.0) * total / max(total - 1, 1)), (np.interp(0.75, share, at) - np.interp(0.25, share, at)) / 1.34 or np.inf) * total**-0.2
        grid = np.linspace(mean[0], mean[1], 513)
        low = None
        if mean[1] > mean[0] and width > 0:
            low = float(grid[np.argmin((np.exp(-0.5 * ((grid[:, None] - at) / width) ** 2) * n).sum(1))])
        out = {c: part[c].iloc[:1].tolist() for c in on} | {f"{c}{i + 1}": [float(v[i])] for i in (0, 1) for c, v in (("w", w), ("m", mean), ("s", sd))}
        cut = gaussian_crossing(*(float(v) for i in (0, 1) for v in (mean[i], sd[i], w[i])))
        return pd.DataFrame(out | {"cut": [cut], "dip": [low]})

    kinds = dict(bins.dtypes)
    text = ", ".join([*[f"`{c}` {kinds[c]}" for c in on], *[f"{c}{i} double" for i in (1, 2) for c in "wms"], "cut double", "dip double"])
    return bins.groupBy(*on).applyInPandas(fit, text).drop("__all")


def quantile_normalise(long: DataFrame) -> DataFrame:
    """(iid, feat, x): each sample's k-th smallest value becomes the mean of all samples' k-th smallest."""
    from pyspark.sql import Window

    r = long.withColumn("__r", F.row_number().over(Window.partitionBy("iid").orderBy("x", "feat")))
    mean = r.groupBy("__r").agg(F.avg("x").alias("__m"))
    return r.join(mean, "__r").select("iid", "feat", F.col("__m").alias("x"))


def normalise_trait(rows: DataFrame, *by: str, times: float = 5.0, alpha: float = 0.05) -> DataFrame:
    """by, iid, v: each trait's (iid, sex, age, smoking, y) values normalised by the steps its data call for.

    A rank test on sex decides whether the sexes are treated together or apart. Within a part: values beyond mean +- times *
    deviation go, inverse-normal scores of the rest are regressed on those of age, its square and smoking that matter at
    alpha in one joint model, and the residuals are scaled to unit deviation.
    """
    from statistics import NormalDist

    types, score = dict(rows.dtypes), NormalDist().inv_cdf

    def part_of(d: pd.DataFrame) -> pd.Series:
        y = d["y"].where((d["y"] - d["y"].mean()).abs() <= times * d["y"].std())
        q = ((y.rank() - 0.5) / y.notna().sum()).map(score, na_action="ignore").astype(float)
        ok = q.notna() & d[["age", "smoking"]].notna().all(axis=1)
        terms = {"age": d["age"], "age2": d["age"] ** 2, "smoking": d["smoking"]}
        for last in (False, True):
            x = np.column_stack([np.ones(ok.sum()), *[v[ok].to_numpy(float) for v in terms.values()]])
            h = np.linalg.pinv(x.T @ x)
            b = h @ (x.T @ q[ok].to_numpy())
            e = q[ok].to_numpy() - x @ b
            df = max(ok.sum() - x.shape[1], 1)
            se = np.sqrt(np.maximum(np.diag(h) * (e @ e) / df, 1e-300))
            p = t_two_sided(b / se, df)[1:]
            if last or not terms:
                break
            terms = {k: v for (k, v), s in zip(terms.items(), p, strict=True) if s < alpha}
        out = pd.Series(np.nan, index=d.index)
        out[ok] = e / e.std(ddof=1) if len(e) > 1 and e.std() > 0 else e
        return out

    def fit(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values("iid").reset_index(drop=True)
        known = d.dropna(subset=["y", "sex"])
        first = known["sex"] == known["sex"].min()
        n1, n2 = int(first.sum()), int((~first).sum())
        w = known["y"].rank()[first].sum() - n1 * (n1 + 1) / 2
        z = (w - n1 * n2 / 2) / np.sqrt(n1 * n2 * (n1 + n2 + 1) / 12) if n1 and n2 else 0.0
        apart = float(norm_two_sided(z)) < alpha
        v = pd.concat([part_of(x) for _, x in d.groupby("sex")]) if apart else part_of(d)
        out = d[[*by, "iid"]].assign(v=v.reindex(d.index))
        return out.assign(v=out["v"].astype(object).where(out["v"].notna(), None))

    return rows.groupBy(*by).applyInPandas(fit, ", ".join(f"{k} {types[k]}" for k in by) + f", iid {types['iid']}, v double")
