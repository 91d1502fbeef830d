"""Normal quantile as SQL text both for Spark and for any other engine, and tails of t, F, chi-square and normal in numpy."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Coefficients of Wichura's AS 241 (PPND16), lowest power first.
_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
_MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
_FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)

#: Median of chi-square with one degree of freedom.
CHI2_MEDIAN = NormalDist().inv_cdf(0.75) ** 2


def _ratio(coefficients: tuple, x: str) -> str:
    def horner(c: tuple) -> str:
        text = f"{c[-1]!r}"
        for v in c[-2::-1]:
            text = f"({text} * {x} + {v!r})"
        return text

    # plain decimals would be read as decimal types, so each literal carries an exponent
    over, under = (horner(tuple(map(float, c))) for c in coefficients)
    return f"({over} / {under})"


def norm_quantile_sql(p: str) -> str:
    """SQL for the standard normal quantile of p in (0, 1); null outside."""
    q = f"(({p}) - 0.5e0)"
    r = f"sqrt(-ln(CASE WHEN {q} < 0 THEN ({p}) ELSE 1.0e0 - ({p}) END))"
    sign = f"(CASE WHEN {q} < 0 THEN -1.0e0 ELSE 1.0e0 END)"
    text = (
        f"CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN NULL WHEN abs({q}) <= 0.425e0 THEN {q} * {_ratio(_CENTRE, f'(0.180625e0 - {q} * {q})')} "
        f"WHEN {r} <= 5 THEN {sign} * {_ratio(_MIDDLE, f'({r} - 1.6e0)')} ELSE {sign} * {_ratio(_FAR, f'({r} - 5.0e0)')} END"
    )
    import re

    return re.sub(r"(?<![\w.])(\d+\.\d+)(?![\de])", r"\1e0", text)


def norm_quantile(p: str) -> Column:
    """The quantile of the column named p."""
    return F.expr(norm_quantile_sql(p))


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lentz's continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + top / np.where(np.abs(c) < tiny, tiny, c)
            h *= d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


_lgamma = np.vectorize(math.lgamma, otypes=[float])


def beta_tail(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    inside = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(inside) + b * np.log1p(-inside))
    low = inside < (a + 1) / (a + b + 2)
    out = np.where(low, front * _beta_fraction(a, b, inside) / a, 1 - front * _beta_fraction(b, a, 1 - inside) / b)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


def t_two_sided(t, df) -> np.ndarray:
    t, df = np.asarray(t, float), np.asarray(df, float)
    return beta_tail(df / 2, 0.5, df / (df + t * t))


def f_upper(f, d1, d2) -> np.ndarray:
    f, d1, d2 = (np.asarray(v, float) for v in (f, d1, d2))
    return beta_tail(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


_erfc = np.vectorize(math.erfc, otypes=[float])


def chi2_1_upper(x) -> np.ndarray:
    return _erfc(np.sqrt(np.asarray(x, float) / 2))


def norm_two_sided(z) -> np.ndarray:
    return _erfc(np.abs(np.asarray(z, float)) / math.sqrt(2))


@F.pandas_udf(DoubleType())
def p_from_t(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of t with df degrees of freedom; null if either is missing or df < 1."""
    ok = t.notna() & df.notna() & (df >= 1)
    out = pd.Series(np.nan, index=t.index)
    out[ok] = t_two_sided(t[ok], df[ok])
    return out.where(ok, None)


@F.pandas_udf(DoubleType())
def p_from_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    ok = f.notna() & (d2 >= 1)
    out = pd.Series(np.nan, index=f.index)
    out[ok] = f_upper(f[ok], d1[ok], d2[ok])
    return out.where(ok, None)


@F.pandas_udf(DoubleType())
def p_from_chi2(x: pd.Series) -> pd.Series:
    ok = x.notna()
    out = pd.Series(np.nan, index=x.index)
    out[ok] = chi2_1_upper(x[ok])
    return out.where(ok, None)


def hardy_weinberg_p(het: int, hom1: int, hom2: int) -> float:
    """Exact test: the share of heterozygote counts at most as likely as the observed one, given the allele counts."""
    rare, n = 2 * min(hom1, hom2) + het, het + hom1 + hom2
    if n == 0:
        return 1.0
    counts = np.arange(rare % 2, rare + 1, 2)
    minor = (rare - counts) // 2
    major = n - counts - minor
    log = counts * math.log(2) - _lgamma(counts + 1.0) - _lgamma(minor + 1.0) - _lgamma(major + 1.0)
    p = np.exp(log - log.max())
    return float(min(1.0, p[p <= p[counts == het][0] * (1 + 1e-9)].sum() / p.sum()))


@F.pandas_udf(DoubleType())
def p_hardy_weinberg(het: pd.Series, hom1: pd.Series, hom2: pd.Series) -> pd.Series:
    return pd.Series([hardy_weinberg_p(int(a), int(b), int(c)) for a, b, c in zip(het, hom1, hom2, strict=True)])
