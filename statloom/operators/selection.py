"""What stays and what goes: cell types, components, variants, inversions, samples; and the lookup of variants in a panel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions import stats


def cells_to_drop(long: DataFrame, cell: str, value: str) -> DataFrame:
    """(cell) that a model goes without, since shares add up to one: if several cell types have zeros, the one with most of
    them (ties: the least name); otherwise those with the lowest median."""
    s = long.groupBy(cell).agg(F.count_if(F.col(value) == 0).alias("__z"), F.percentile(value, 0.5).alias("__m"))  # a row a cell type
    rule = s.agg(F.count_if(F.col("__z") > 0).alias("__k"), F.min(F.struct((-F.col("__z")).alias("__n"), F.col(cell)))[cell].alias("__most"), F.min("__m").alias("__low"))
    goes = F.when(F.col("__k") > 1, F.col(cell) == F.col("__most")).otherwise(F.col("__m") == F.col("__low"))
    return s.crossJoin(F.broadcast(rule)).where(goes).select(cell)  # one row


def without_weak_cells(long: DataFrame, cell: str, value: str) -> DataFrame:
    """long without the rows of cells_to_drop()."""
    return long.join(F.broadcast(cells_to_drop(long, cell, value)), cell, "left_anti")


def screen_components(components: DataFrame, traits: DataFrame, k: int) -> DataFrame:
    """trait, pc (from 1), n, beta, t, p of each of k components in the joint regression of a trait on all of them.

    components: iid, c (array of k); traits: trait, iid, y. Samples with a missing value don't count. Traits are solved in
    batches from sums of (k + 2)**2 products; a trait with too few samples has nulls.
    """
    d = traits.where("y is not null").join(components.where(F.forall("c", lambda v: v.isNotNull())), "iid")
    x = [F.lit(1.0), *[F.col("c")[i].cast("double") for i in range(k)]]
    sums = d.groupBy("trait").agg(
        F.count("*").alias("n"), F.array(*[F.sum(x[i] * x[j]) for i in range(k + 1) for j in range(k + 1)]).alias("a"),
        F.array(*[F.sum(v * F.col("y")) for v in x]).alias("b"), F.sum(F.col("y") * F.col("y")).alias("yy"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for s in batches:
            if not len(s):
                continue
            a, b = np.array(s["a"].tolist()).reshape(-1, k + 1, k + 1), np.array(s["b"].tolist())
            inverse = np.linalg.pinv(a, hermitian=True)
            w = np.einsum("rij,rj->ri", inverse, b)
            left = s["n"].to_numpy(float) - k - 1
            with np.errstate(all="ignore"):
                v = np.maximum(s["yy"].to_numpy(float) - (w * b).sum(1), 0.0) / left
                t = w / np.sqrt(v[:, None] * np.einsum("rii->ri", inverse))
            good = (left[:, None] > 0) & np.isfinite(t)
            p = np.where(good, stats.t_two_sided(np.where(good, t, 0.0), np.maximum(left, 1.0)[:, None]), np.nan)
            out = pd.DataFrame({"trait": np.repeat(s["trait"].to_numpy(), k), "pc": np.tile(np.arange(1, k + 1), len(s)), "n": np.repeat(s["n"].to_numpy(), k)})
            for name, m in (("beta", w), ("t", np.where(good, t, np.nan)), ("p", p)):
                out[name] = pd.Series(m[:, 1:].ravel()).astype("Float64").where(~np.isnan(m[:, 1:].ravel()), None)
            yield out

    return sums.mapInPandas(solve, f"trait {dict(sums.dtypes)['trait']}, pc int, n long, beta double, t double, p double")


def related_components(screened: DataFrame, alpha: float = 0.05) -> DataFrame:
    """(pc) that some trait is related to: p under alpha over the number of traits."""
    cut = screened.agg((F.lit(alpha) / F.count_distinct("trait")).alias("__cut"))
    return screened.crossJoin(F.broadcast(cut)).where(F.col("p") < F.col("__cut")).select("pc").distinct()


#: The major histocompatibility complex of build 37, whose hits don't count against a component.
MHC = ("6", 25_000_000, 35_000_000)


def outside(region: tuple[str, int, int], chromosome: str, position: str) -> Column:
    name, start, end = region
    return ~((F.col(chromosome).cast("string") == name) & F.col(position).between(start, end))


def without_driven(components: DataFrame, hits: DataFrame, name: str) -> DataFrame:
    """The rows of components (named by `name`) that no hit names; an error if a hit names every one of them."""
    driven = hits.select(name).distinct()
    if not components.isEmpty() and components.join(driven, name, "left_anti").isEmpty():
        raise ValueError("all components have a genetic part: families or strata are not adjusted for")
    return components.join(driven, name, "left_anti")


def oriented(scores: DataFrame, score: str, group: str, high: object, low: object) -> DataFrame:
    """scores with the component's sign turned so that the group `high` has the larger mean."""
    side = lambda v: F.avg(F.when(F.col(group) == F.lit(v), F.col(score)))
    turn = scores.agg(F.when(side(high) < side(low), -1.0).otherwise(1.0).alias("__turn"))  # one row
    return scores.crossJoin(F.broadcast(turn)).withColumn(score, F.col(score) * F.col("__turn")).drop("__turn")


def without_mismatches(samples: DataFrame, recorded: str, predicted: str, most: float = 0.1) -> DataFrame:
    """Samples whose predicted sex is the recorded one; a missing one matches nothing. An error if more than `most` go."""
    same = F.coalesce(F.col(recorded) == F.col(predicted), F.lit(False))
    share = samples.agg(F.avg((~same).cast("int"))).first()[0]
    if share is not None and share > most:
        raise ValueError(f"{share:.1%} of the samples have another sex than recorded")
    return samples.where(same)


def x_homozygosity(dosages: DataFrame) -> DataFrame:
    """iid, n, f, sex from dosages (iid, variant, g) of chromosome X: f compares homozygous calls with those expected from the
    allele frequencies; under 0.2 is female (2), over 0.8 male (1), the rest undecided (0). Variants without variation and
    missing calls don't count."""
    p = dosages.where("g is not null").groupBy("variant").agg((F.avg("g") / 2).alias("__p")).where("__p > 0 and __p < 1")
    d = dosages.where("g is not null").join(p, "variant")
    s = d.groupBy("iid").agg(F.count("*").alias("n"), F.count_if(F.col("g") != 1).alias("__o"), F.sum(1 - 2 * F.col("__p") * (1 - F.col("__p"))).alias("__e"))
    s = s.withColumn("f", (F.col("__o") - F.col("__e")) / (F.col("n") - F.col("__e")))
    return s.select("iid", "n", "f", F.when(F.col("f") > 0.8, 1).when(F.col("f") < 0.2, 2).otherwise(0).alias("sex"))


def without_empty(long: DataFrame, feature: str, value: str) -> DataFrame:
    """Rows of features that have a value at all; NaN is none."""
    there = long.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(feature).distinct()
    return long.join(there, feature, "left_semi")


def between_variants(variants: DataFrame, name: str, first: object, last: object, *order: str) -> DataFrame:
    """The variants from `first` to `last` by name in the order of the given columns, both included; none if either is absent."""
    place = F.struct(*order)
    ends = variants.where(F.col(name).isin(first, last)).agg(
        F.min(F.when(F.col(name) == F.lit(first), place)).alias("__a"), F.max(F.when(F.col(name) == F.lit(last), place)).alias("__b"))  # one row
    return variants.crossJoin(F.broadcast(ends)).where((place >= F.col("__a")) & (place <= F.col("__b"))).drop("__a", "__b")


def lookup(probes: DataFrame, panel: DataFrame, keys: list[str], probe: str) -> DataFrame:
    """Each probe with idx and flip of the first variant of the panel (by idx) that has the same keys, chromosome and position
    or a name, and the same alleles: flip 1 in the same order, -1 reversed. idx is -1 and flip 0 if there is none.

    Several variants may share keys; probes: probe, keys, a1, a2; panel: idx, keys, a1, a2. `probe` names rows uniquely.
    """
    # of the panel's variants with the same keys and alleles only the first can be found, so a probe meets two rows at most
    first = panel.groupBy(*keys, "a1", "a2").agg(F.min("idx").alias("idx"))
    reverse = first.select(*keys, F.col("a2").alias("a1"), F.col("a1").alias("a2"), "idx").where("a1 <> a2")
    there = first.select(*keys, "a1", "a2", F.struct("idx", F.lit(1).alias("flip")).alias("__h")).unionByName(reverse.select(*keys, "a1", "a2", F.struct("idx", F.lit(-1).alias("flip")).alias("__h")))
    there = there.where("__h.idx is not null").groupBy(*keys, "a1", "a2").agg(F.min("__h").alias("__h"))
    found = probes.join(there, [*keys, "a1", "a2"], "left").groupBy(probe).agg(F.min("__h").alias("__h"))
    return found.select(probe, F.coalesce(F.col("__h.idx"), F.lit(-1)).alias("idx"), F.coalesce(F.col("__h.flip"), F.lit(0)).alias("flip"))


#: Inversions need more SNPs than this, and more than this share of the calls of the best called one.
INVERSION_SNPS, INVERSION_CALLED = 3, 0.9


def inversion_calls(scores: DataFrame, least: float = 0.0) -> DataFrame:
    """scores (inversion, iid, nn, ni, ii, n_snps) with g: copies of the inverted allele by the largest score, null where its
    lead over the second is not above `least`. An infinite score counts as one."""
    finite = {c: F.when(F.col(c) == float("inf"), 1.0).otherwise(F.col(c)) for c in ("nn", "ni", "ii")}
    d = scores.withColumns(finite).withColumn("__s", F.sort_array(F.array("nn", "ni", "ii"), False))
    top = F.col("__s")[0]
    call = F.when(F.col("nn") == top, 0).when(F.col("ni") == top, 1).otherwise(2)
    return d.withColumn("g", F.when(top - F.col("__s")[1] > least, call)).drop("__s")


def inversion_summary(calls: DataFrame) -> DataFrame:
    """inversion, reason (null for those that stay), percent of inverted alleles, n_snps, n called, from inversion_calls()."""
    s = calls.groupBy("inversion").agg(F.max("n_snps").alias("n_snps"), F.count("g").alias("n"), F.min("g").alias("__lo"), F.max("g").alias("__hi"), (F.avg("g") / 2 * 100).alias("percent"))
    most = s.where(F.col("n_snps") > INVERSION_SNPS).agg(F.max("n").alias("__most"))  # one row
    reason = (
        F.when(~(F.col("n_snps") > INVERSION_SNPS), "Not enough SNPs")
        .when(F.col("n") <= INVERSION_CALLED * F.col("__most"), "Bad genotyping")
        .when((F.col("__lo") == F.col("__hi")) & (F.col("__lo") != 1), "Invariant Inversions")
    )
    return s.crossJoin(F.broadcast(most)).select("inversion", reason.alias("reason"), "percent", "n_snps", "n")


def effective_tests(packed: DataFrame, *by: str, window: int = 200, explained: float = 0.99) -> DataFrame:
    """by, tests: how many independent tests a group's variants make, as eigenvalues that explain the share of their
    correlations' variance, window by window of so many variants in order.

    packed: by, pos, values (dosages by sample, all of one length). Correlations are shrunk towards none, by the larger the
    less they can be told from noise (Ledoit and Wolf). Variants without variation don't count. A task holds one window.
    """
    order = Window.partitionBy(*by).orderBy("pos")
    dealt = packed.withColumn("__w", F.floor((F.row_number().over(order) - 1) / window))

    def count(part: pd.DataFrame) -> pd.DataFrame:
        x = np.array(part["values"].tolist(), float)
        x = x - x.mean(1, keepdims=True)
        sd = np.sqrt((x * x).mean(1))
        x = x[sd > 0] / sd[sd > 0, None]
        m, n = x.shape
        tests = m
        if m > 1:
            s = x @ x.T / n
            apart = ((s - np.eye(m) * np.trace(s) / m) ** 2).sum()
            noise = ((x * x) @ (x * x).T / n - s * s).sum() / n
            weight = min(1.0, noise / apart) if apart > 0 else 1.0
            values = np.linalg.eigvalsh((1 - weight) * s + weight * np.eye(m) * np.trace(s) / m)[::-1]
            tests = int(np.searchsorted(np.cumsum(values) / values.sum(), explained - 1e-12) + 1)
        return pd.DataFrame({**{c: part[c].iloc[:1].to_numpy() for c in by}, "tests": [min(tests, m)]})

    kinds = dict(packed.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "tests long"])
    return dealt.groupBy(*by, "__w").applyInPandas(count, schema).groupBy(*by).agg(F.sum("tests").alias("tests"))
