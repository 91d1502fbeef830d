"""Surrogate variables: directions over samples that explain what a model leaves of the features, found without a matrix in one place."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.stats import f_upper
from statloom.operators import assoc, store, tall

#: Width and ends of the bins of probits in which p values are counted for the local false discovery rate.
STEP, END = 0.02, 8.0
#: Share of the leading values' sum by which a further Krylov step may still raise them.
TOLERANCE = 1e-6


def most_variable(values: DataFrame, n: int) -> DataFrame:
    """The rows of the n features of (feat, iid, x) with the largest variance, ties by feature."""
    top = values.groupBy("feat").agg(F.var_samp("x").alias("v")).orderBy(F.col("v").desc_nulls_last(), "feat").limit(n).select("feat")
    return values.join(top, "feat", "left_semi")


def permuted_residuals(residual: DataFrame, permutations: int, seed: int) -> DataFrame:
    """set, feat, iid, x: the residuals (feat, iid, x) as set 0, and each feature's shuffled over its samples as sets 1, 2, ...

    A task holds one feature's samples at a time.
    """
    kinds = dict(residual.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(parts)).sort_values("iid")
        for s in range(permutations + 1):
            x = part["x"].to_numpy(float)
            if s:
                x = np.random.default_rng([seed, s, *str(part["feat"].iloc[0]).encode()]).permutation(x)
            yield pd.DataFrame({"set": s, "feat": part["feat"], "iid": part["iid"], "x": x})

    return residual.groupBy("feat").applyInPandas(run, f"set int, feat {kinds['feat']}, iid {kinds['iid']}, x double")


def permuted_tiles(residual: DataFrame, permutations: int, seed: int) -> tall.Tiles:
    """Tiles of permuted_residuals(), of which a feature's samples in a block leave its task as one row with all sets, sample names once."""
    known = residual.where("x is not null")
    size = known.agg(F.approx_count_distinct("feat").alias("r"), F.approx_count_distinct("iid").alias("c")).first()
    r, c = max(1, -(-size["r"] // tall.ROWS)), max(1, -(-size["c"] // tall.COLS))
    kinds = dict(residual.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(parts)).sort_values("iid")
        feat, x, of = part["feat"].iloc[0], part["x"].to_numpy(float), part["c"].to_numpy()
        every = [np.random.default_rng([seed, s, *str(feat).encode()]).permutation(x) if s else x for s in range(permutations + 1)]
        order = np.argsort(of, kind="stable")
        ids, data = part["iid"].to_numpy()[order], np.array(every)[:, order]
        ends = np.flatnonzero(np.r_[True, np.diff(of[order]) != 0, True])
        for low, high in zip(ends[:-1], ends[1:], strict=True):
            yield pd.DataFrame({"r": part["r"].iloc[:1], "c": [of[order][low]], "feat": [feat], "ids": [ids[low:high].tolist()], "data": [np.ascontiguousarray(data[:, low:high]).tobytes()]})

    def dense(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("feat")
        cols = np.unique(np.concatenate([np.asarray(i) for i in part["ids"]]))
        x = np.zeros((permutations + 1, len(part), len(cols)))
        for at, (ids, data) in enumerate(zip(part["ids"], part["data"], strict=True)):
            x[:, at, np.searchsorted(cols, np.asarray(ids))] = np.nan_to_num(np.frombuffer(data).reshape(permutations + 1, -1))
        n = permutations + 1
        return pd.DataFrame({"set": range(n), "r": [part["r"].iloc[0]] * n, "c": [part["c"].iloc[0]] * n, "rows": [part["feat"].tolist()] * n, "cols": [cols.tolist()] * n, "data": [m.tobytes() for m in x]})

    pieces = known.select(tall.block("feat", r).alias("r"), tall.block("iid", c).alias("c"), "feat", "iid", "x").groupBy("feat").applyInPandas(run, f"r int, c int, feat {kinds['feat']}, ids array<{kinds['iid']}>, data binary")
    out = pieces.groupBy("r", "c").applyInPandas(dense, f"set int, r int, c int, rows array<{kinds['feat']}>, cols array<{kinds['iid']}>, data binary")
    return tall.Tiles(store.keep(out, "permuted-residuals"), r, c)


def _free(v: tall.Tall, q: tall.Tall) -> tall.Tall:
    """v without its part in the orthonormal q."""
    inside = {s: g[: q.k, q.k :] for s, g in tall.cross(q, v).items()}
    return tall.combine([v, q], lambda s, x, b: x - b @ inside[s], v.k)


def gram_of(tiles: tall.Tiles, q: tall.Tall | None = None, weights: tall.Tall | None = None) -> Callable[[tall.Tall], tall.Tall]:
    """v -> (I - qq') X' W**2 X (I - qq') v for the tiled X and a weight W of each feature."""

    def apply(v: tall.Tall) -> tall.Tall:
        v = v if q is None else _free(v, q)
        u = tiles.times(v)
        if weights is not None:
            u = tall.combine([u, weights], lambda s, x, w: x * w * w, v.k)
        out = tiles.transposed_times(u)
        return out if q is None else _free(out.kept("gram-product"), q)

    return apply


def components(values: DataFrame, residual: DataFrame, q: tall.Tall, most: int, permutations: int, seed: int, level: float = 0.1) -> int:
    """How many leading directions of the residuals explain more of them than those of permuted residuals do.

    q: the orthonormal design over the samples, of which permuted residuals are freed again. A direction counts if at most the
    level's share of permutations explains as much by its place, and all before it count.
    """
    tiles = permuted_tiles(residual, permutations, seed)
    sets = list(range(permutations + 1))
    wide = q.copies(sets).kept("design-sets")
    narrow = tall.Narrow.of(tiles, wide)
    if narrow:
        found, total, done = narrow.values(most), {s: float(np.trace(g)) for s, g in narrow.gram.items()}, []
    else:
        start = _free(tiles.random(most + 10, seed), wide)
        found, vectors = tall.leading(gram_of(tiles, wide), start.kept("start"), most, tolerance=1e-4)
        total, done = _energy(tiles, wide), [vectors.df]
    share = np.array([found[s] / max(total[s], 1e-300) for s in sets])
    p = np.maximum.accumulate((share[1:] >= share[0]).mean(0)) if permutations else np.zeros(most)
    for df in (tiles.df, wide.df, *done):
        store.drop(df)
    return int(((p <= level) & (found[0] > 1e-9 * max(total[0], 1e-300))).sum())


def _energy(tiles: tall.Tiles, q: tall.Tall) -> dict[int, float]:
    """Sum of squares of X (I - qq'), by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, float] = {}
        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(data.as_buffer())
                held[s] = held.get(s, 0.0) + float(x @ x)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.float64())], names=["set", "v"])

    whole = {r["set"]: r["v"] for r in tiles.df.select("set", "data").mapInArrow(run, "set int, v double").groupBy("set").agg(F.sum("v").alias("v")).collect()}
    inside = tall.cross(tiles.times(q))
    return {s: v - float(np.trace(inside[s])) for s, v in whole.items()}


def f_tests(dots: DataFrame, gram: np.ndarray, n: float, small: list[int], large: list[int]) -> DataFrame:
    """set, feat, p of nested models: dots has each feature's products with the design's columns (array v) and its square yy;
    gram: the columns' products; small and large: their numbers in either model; n: samples."""

    def fitted(v: np.ndarray, cols: list[int]) -> tuple[np.ndarray, int]:
        value, vector = np.linalg.eigh(gram[np.ix_(cols, cols)])
        good = value > 1e-10 * max(value.max(initial=0.0), 1e-300)
        z = v[:, cols] @ (vector[:, good] / np.sqrt(value[good]))
        return (z * z).sum(1), int(good.sum())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if len(part):
                v, yy = np.array(part["v"].tolist(), float), part["yy"].to_numpy(float)
                (a, p0), (b, p1) = fitted(v, small), fitted(v, large)
                rest = np.maximum(yy - b, 1e-12 * yy)
                with np.errstate(all="ignore"):
                    f = np.maximum(b - a, 0.0) / max(p1 - p0, 1) / (rest / max(n - p1, 1))
                p = f_upper(f, np.full(len(f), float(max(p1 - p0, 1))), np.full(len(f), float(max(n - p1, 1))))
                yield pd.DataFrame({"feat": part["feat"], "p": np.where(yy > 0, p, 1.0)})

    return dots.mapInPandas(run, f"feat {dict(dots.dtypes)['feat']}, p double")


def local_fdr(counts: dict[int, int], stop: float = 0.8) -> np.ndarray:
    """Local false discovery rate of each bin of probits, never falling as p grows.

    counts: p values by bin of the probit, which estimate its density by a Gaussian kernel (1.5 times the rule of thumb's
    width); the share of true nulls is that of p at or above `stop`.
    """
    centre = -END + STEP * (np.arange(round(2 * END / STEP)) + 0.5)
    n = np.array([counts.get(i, 0) for i in range(len(centre))], float)
    total = n.sum()
    if not total:
        return np.ones(len(centre))
    share = np.cumsum(n) / total
    quartile = [centre[np.searchsorted(share, q).clip(max=len(centre) - 1)] for q in (0.25, 0.75)]
    mean = (n * centre).sum() / total
    sd = np.sqrt((n * (centre - mean) ** 2).sum() / max(total - 1, 1))
    least = min(sd, (quartile[1] - quartile[0]) / 1.34) or sd or 1.0
    width = 1.5 * 0.9 * least * total**-0.2
    kernel = np.exp(-0.5 * ((centre[:, None] - centre[None]) / width) ** 2) / (width * np.sqrt(2 * np.pi))
    density = np.maximum(kernel @ n / total, 1e-300)
    null = min(1.0, n[centre >= NormalDist().inv_cdf(stop)].sum() / total / (1 - stop))
    rate = np.minimum(null * np.exp(-0.5 * centre**2) / np.sqrt(2 * np.pi) / density, 1.0)
    return np.maximum.accumulate(rate)


def _bins(p: pd.Series) -> np.ndarray:
    z = np.array([NormalDist().inv_cdf(v) for v in np.clip(p.to_numpy(float), 1e-15, 1 - 1e-15)])
    return np.clip(np.floor((z + END) / STEP), 0, round(2 * END / STEP) - 1).astype(np.int32)


def with_rate(tests: DataFrame, name: str) -> DataFrame:
    """feat and the local false discovery rate of its p under `name`; only the bins' counts reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"feat": part["feat"], "bin": _bins(part["p"])})

    binned = tests.mapInPandas(run, f"feat {dict(tests.dtypes)['feat']}, bin int")
    rate = local_fdr({r["bin"]: r["n"] for r in binned.groupBy("bin").agg(F.count("*").alias("n")).collect()})
    table = binned.sparkSession.createDataFrame([(i, float(v)) for i, v in enumerate(rate)], f"bin int, `{name}` double")
    return binned.join(F.broadcast(table), "bin").select("feat", name)


def surrogate_variables(values: DataFrame, design: DataFrame, covariates: int, number: int | None = None, most: int = 10, permutations: int = 10, rounds: int = 5, variable: int = 20_000, seed: int = 1) -> tuple[DataFrame, int]:
    """(iid, sv: array) and their number, by iterative reweighting of the features.

    values: (feat, iid, x), missing values at their feature's mean; design: (iid, c) with the covariates first and the
    variable of interest last. Only the `variable` most variable features count. Unless given, the number comes from
    components(). In each round a feature weighs by the chance that it depends on the surrogate variables and not on the
    variable of interest (local false discovery rates of two F tests); the next variables are the leading directions of
    the weighted, centred features. Samples without a design, or without values, have none. No features, a constant one, or no
    samples give no surrogate variables.

    Features x samples is cut into tiles; samples x (covariates + most + 10) is a table of blocks. The driver sees Gram matrices of
    these few columns, or of the features where there are tall.FEW at most, and counts of p values in bins.
    """
    there = values.where("x is not null and not isnan(x)").join(design.select("iid"), "iid", "left_semi")
    there = store.keep(most_variable(there, variable), "variable-features")
    centred = there.withColumn("x", F.col("x") - F.avg("x").over(Window.partitionBy("feat"))).select("feat", "iid", "x")
    n = there.select("iid").distinct().count()
    none = design.select("iid", F.expr("cast(array() as array<double>)").alias("sv"))
    if not n or number == 0:
        return none, 0
    tiles = tall.Tiles.of(centred, "feat", "iid", "x", name="features")
    own = design.join(there.select("iid").distinct(), "iid", "left_semi")
    full = own.select("iid", F.concat(F.array(F.lit(1.0)), F.col("c").cast("array<double>")).alias("c"))
    d = tall.Tall.of(full, "iid", "c", covariates + 2, tiles.c).kept("design")
    q, _ = tall.orthonormal(d)
    if number is None:
        residual = assoc.residuals(there.select("feat", "iid", "x"), own, covariates + 1).select("feat", "iid", F.col("resid").alias("x")).where("x is not null")
        number = components(centred, residual, q, most, permutations, seed)
    if not number:
        return none, 0
    ones = tall.combine([q], lambda s, x: np.ones((len(x), 1)), 1).kept("ones")
    unit, _ = tall.orthonormal(ones)
    few = tall.Narrow.of(tiles, q), tall.Narrow.of(tiles, unit)

    def leading(freed: tall.Tall, w: tall.Tall | None = None) -> tall.Tall:
        if few[0]:  # a weight each of few features
            by = w and {r["feat"]: r["w"][0] for r in w.rows("feat", "w").collect()}
            return few[w is not None].leading(number, by)[1]
        start = _free(tiles.random(number + 10, seed), freed).kept("start")
        return tall.leading(gram_of(tiles, freed, w), start, number, tolerance=TOLERANCE)[1]

    sv = leading(q)
    square = centred.groupBy("feat").agg(F.sum(F.col("x") ** 2).alias("yy"))
    null, interest, found = list(range(covariates + 1)), covariates + 1, list(range(covariates + 2, covariates + 2 + number))
    for _ in range(rounds):
        model = tall.combine([d, sv], lambda s, a, b: np.column_stack([a, b]), d.k + number).kept("model")
        gram = tall.cross(model)[0]
        dots = store.keep(tiles.times(model).rows("feat", "v").join(square, "feat").select("feat", "v", "yy"), "model-dots")
        by_variable = with_rate(f_tests(dots, gram, n, [*null, *found], [*null, interest, *found]), "b")
        by_surrogate = with_rate(f_tests(dots, gram, n, null, [*null, *found]), "g")
        weight = by_variable.join(by_surrogate, "feat").select("feat", F.array((1 - F.col("g")) * F.col("b")).alias("w"))
        w = tall.Tall.of(weight, "feat", "w", 1, tiles.r).kept("weights")
        energy = tall.cross(w)[0][0, 0]
        if not energy > 1e-12:  # no feature depends on them alone: the variables stay
            break
        new = leading(unit, w)
        for old in (sv.df, model.df, dots, w.df):
            store.drop(old)
        sv = new
    return sv.rows("iid", "sv").select("iid", "sv"), number


def ewas(values: DataFrame, design: DataFrame, covariates: int, **how: object) -> DataFrame:
    """model (none, all, sva), feat, beta, se, t: regressions of each feature on the variable of interest, the design's last
    column: without covariates, with the covariates, and with surrogate variables besides."""
    sv, number = surrogate_variables(values, design, covariates, **how)
    last = F.col("c")[covariates].cast("double")
    variable = design.select(F.lit(0).alias("variant"), "iid", last.alias("g"))
    y = values.select(F.col("feat").alias("phenotype"), "iid", F.col("x").alias("y"))
    some = design.select("iid", F.slice(F.col("c").cast("array<double>"), 1, covariates).alias("c"))
    wide = some.join(sv, "iid").select("iid", F.concat("c", "sv").alias("c"))
    none = design.select("iid", F.expr("cast(array() as array<double>)").alias("c"))
    out = [assoc.scan(variable, y, c).select(F.lit(name).alias("model"), F.col("phenotype").alias("feat"), "beta", "se", "t") for name, c in (("none", none), ("all", some), ("sva", wide if number else some))]
    return out[0].unionByName(out[1]).unionByName(out[2])
