"""Quality control: summaries of variants and samples, allele harmonisation, and expectations as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.stats import p_hardy_weinberg


def variant_summary(dosages: DataFrame, by: str = "variant", hardy: bool = False) -> DataFrame:
    """af, missing and genotype counts of each variant; p_hwe by the exact test if asked for."""
    out = dosages.groupBy(by).agg((F.avg("g") / 2).alias("af"), F.avg(F.isnull("g").cast("int")).alias("missing"), *[F.count_if(F.col("g") == k).alias(f"n{k}") for k in (0, 1, 2)])
    return out.withColumn("p_hwe", p_hardy_weinberg("n1", "n0", "n2")) if hardy else out


def allele_reject(a: str, b: str) -> Column:
    """Why an allele pair can't be harmonised; null if it can."""
    x, y = F.upper(F.trim(a)), F.upper(F.trim(b))
    either = lambda *v: x.isin(*v) | y.isin(*v)
    return (
        F.when(x.isNull() | y.isNull() | either("NA", ""), "missing")
        .when(either("<DEL>", "-"), "deletion mark")
        .when(either("R", "I", "D"), "insertion or deletion code")
        .when(either("Y", "Z"), "ambiguity code")
        .when((F.length(x) > 1) | (F.length(y) > 1), "more than one base")
        .when(~x.rlike("^[ACGT]$") | ~y.rlike("^[ACGT]$"), "not a base")
        .when(x == y, "equal alleles")
    )


def expect(df: DataFrame, checks: dict[str, tuple[str, Column, str, float]]) -> DataFrame:
    """(check_id, severity, observed, threshold, passed), one row a check, in one pass over df.

    checks: id to (severity, aggregate, comparison, threshold); comparison is one of >=, <=, >, <, =. A check whose
    observation is null has failed.
    """
    row = df.agg(*[c.cast("double").alias(k) for k, (_, c, _, _) in checks.items()])
    parts = []
    for k, (severity, _, op, limit) in checks.items():
        o = F.col(k)
        ok = {">=": o >= limit, "<=": o <= limit, ">": o > limit, "<": o < limit, "=": o == limit}[op]
        parts.append(F.struct(F.lit(k).alias("check_id"), F.lit(severity).alias("severity"), o.alias("observed"), F.lit(float(limit)).alias("threshold"), F.coalesce(ok, F.lit(False)).alias("passed")))
    return row.select(F.explode(F.array(*parts)).alias("e")).select("e.*")


def combine(expectations: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, expectations)


def require(expectations: DataFrame) -> None:
    """ValueError that names every failed check of severity error."""
    bad = [r["check_id"] for r in expectations.where("not passed and severity = 'error'").collect()]
    if bad:
        raise ValueError("failed: " + ", ".join(sorted(bad)))


def compare(a: DataFrame, b: DataFrame, keys: list[str], value: str, delta: float = 0.0, relative: float = 0.0) -> DataFrame:
    """Rows (keys, a, b) that differ: missing on one side, or apart by more than delta and more than the relative share."""
    x, y = a.select(*keys, F.col(value).alias("a"), F.lit(1).alias("__a")), b.select(*keys, F.col(value).alias("b"), F.lit(1).alias("__b"))
    gap = F.abs(F.col("a") - F.col("b"))
    near = F.col("a").eqNullSafe(F.col("b")) | (gap <= delta) | (gap <= relative * F.abs("a"))
    return x.join(y, keys, "full").where(F.col("__a").isNull() | F.col("__b").isNull() | ~F.coalesce(near, F.lit(False))).drop("__a", "__b")


def complete(parts: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has: empty if chunks have come together whole."""
    a, b = parts.select(key).distinct(), expected.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("unexpected")).union(b.join(a, key, "left_anti").withColumn("side", F.lit("missing")))
