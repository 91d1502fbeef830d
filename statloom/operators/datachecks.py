"""The named data checks of a study's files, with their limits: each gives rows (check_id, severity, observed, threshold, passed).

Errors stop an analysis (quality.require); warnings are for the eye. A check whose observation is missing, as on an empty
table, has failed. Callers name the columns; others are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators.quality import expect

#: Limits, fixed by the contract.
CHROMOSOMES, LEAST_CHROMOSOMES, STRAND, BUILD, OVERLAP, RARE, PROBES = 23, 22, 0.75, 0.25, 0.95, 0.01, 0.80
SAMPLES, LEAST_SEX, SEX_R, MISMATCH, MISSING, SAMPLE_MISSING, MISSING_SHARE = 200, 0.05, 0.7, 0.1, 0.1, 0.02, 0.01
MOST_INFO, LOW_MAF, LOW_INFO, MOST_AGE, LEAST_N = 1.1, 0.01, 0.8, 100, 10


def _share(c: Column) -> Column:
    """Share of rows where c holds; null counts as not."""
    return F.avg(F.coalesce(c, F.lit(False)).cast("int"))


def study_name(name: str) -> bool:
    """Letters, digits and underscores only, at least one."""
    return re.fullmatch(r"[A-Za-z0-9_]+", name) is not None


def variants(df: DataFrame, chromosome: str, name: str) -> DataFrame:
    """Chromosome codes are within 1 to 23, at least 22 of them are there, and no variant is named twice."""
    code = F.expr(f"try_cast({chromosome} as int)")
    return expect(df, {
        "chromosome_codes": ("error", _share(code.between(1, CHROMOSOMES)), ">=", 1),
        "chromosomes_present": ("error", F.count_distinct(code), ">=", LEAST_CHROMOSOMES),
        "duplicate_variants": ("error", F.count(name) - F.count_distinct(name), "=", 0),
    })


def strand(df: DataFrame, chromosome: str, agrees: str) -> DataFrame:
    """On every chromosome alleles agree with those of the control on at least 75 % of the variants."""
    return expect(df.groupBy(chromosome).agg(_share(F.col(agrees)).alias("s")), {"strand_agreement": ("error", F.min("s"), ">=", STRAND)})


def build(controls: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """At least 25 % of the control positions of the genome build are among the variants."""
    here = df.select(*keys).distinct().withColumn("__there", F.lit(True))
    return expect(controls.select(*keys).join(here, keys, "left"), {"control_positions": ("error", _share(F.col("__there")), ">=", BUILD)})


def quality(df: DataFrame, maf: str, info: str) -> DataFrame:
    """Frequencies are within 0 to 1, info at most 1.1; at most 1 % of the variants are rare, as many badly imputed."""
    return expect(df, {
        "maf_range": ("error", _share(F.col(maf).between(0, 1)), ">=", 1),
        "info_range": ("error", _share(F.col(info) <= MOST_INFO), ">=", 1),
        "low_maf": ("warning", _share(F.col(maf) < LOW_MAF), "<=", RARE),
        "low_info": ("warning", _share(F.col(info) < LOW_INFO), "<=", RARE),
    })


def overlap(ids: DataFrame, others: DataFrame, key: str, name: str, least: float) -> DataFrame:
    """Share of ids that stand among the others: 0.95 for quality and variant ids, 0.80 for probes of an array."""
    there = others.select(key).distinct().withColumn("__there", F.lit(True))
    return expect(ids.select(key).join(there, key, "left"), {name: ("error", _share(F.col("__there")), ">=", least)})


def in_both(a: DataFrame, b: DataFrame, key: str, name: str = "samples_in_both", least: float = SAMPLES) -> DataFrame:
    """At least 200 samples are in both tables."""
    return expect(a.select(key).distinct().join(b.select(key).distinct(), key), {name: ("error", F.count("*"), ">=", least)})


def samples(df: DataFrame, iid: str, fid: str) -> DataFrame:
    """Sample ids are unique, neither id has an underscore, and the family id isn't the same for all."""
    return expect(df, {
        "duplicate_samples": ("error", F.count(iid) - F.count_distinct(iid), "=", 0),
        "sample_underscores": ("error", F.count_if(F.col(iid).cast("string").contains("_")), "=", 0),
        "family_underscores": ("error", F.count_if(F.col(fid).cast("string").contains("_")), "=", 0),
        "families": ("error", F.count_distinct(fid), ">", 1),
    })


def matrix(long: DataFrame, feature: str, sample: str, value: str) -> DataFrame:
    """At least 200 samples, more features than samples, no missing value, all within 0 to 1, no genotype probes (rs...)."""
    return expect(long, {
        "matrix_samples": ("error", F.count_distinct(sample), ">=", SAMPLES),
        "matrix_orientation": ("error", F.count_distinct(feature) - F.count_distinct(sample), ">", 0),
        "matrix_missing": ("error", F.count_if(F.col(value).isNull() | F.isnan(value)), "=", 0),
        "matrix_range": ("error", _share(F.col(value).between(0, 1)), ">=", 1),
        "matrix_genotype_probes": ("error", F.count_if(F.col(feature).cast("string").startswith("rs")), "=", 0),
    })


def sex(df: DataFrame, label: str, predicted: str, component: str) -> DataFrame:
    """Labels are M or F, each of 5 % at least; the component tells them apart (|r| of 0.7); at most 10 % are mismatched."""
    male = F.when(F.col(label) == "M", 1.0).when(F.col(label) == "F", 0.0)
    return expect(df, {
        "sex_labels": ("error", _share(F.col(label).isin("M", "F")), ">=", 1),
        "least_sex_share": ("warning", F.least(F.avg(male), 1 - F.avg(male)), ">=", LEAST_SEX),
        "sex_component": ("warning", F.abs(F.corr(male, F.col(component).cast("double"))), ">=", SEX_R),
        "sex_mismatch": ("error", _share(F.col(label) != F.col(predicted)), "<=", MISMATCH),
    })


def covariates(df: DataFrame, iid: str = "IID", age: str | None = None) -> DataFrame:
    """The id comes first, there are at least three columns, all others end in _factor or _numeric, at most 10 % of any are
    missing, no factor has as many levels as samples; ages are not negative and 100 on average at most. Measured cell counts
    and covariates of scores follow the same rules."""
    others = [c for c in df.columns if c != iid]
    factors = [c for c in others if c.endswith("_factor")]
    checks = {
        "id_first": ("error", F.max(F.lit(int(df.columns[0] == iid))), "=", 1),
        "columns": ("error", F.max(F.lit(len(df.columns))), ">=", 3),
        "unnamed_types": ("error", F.max(F.lit(sum(not c.endswith(("_factor", "_numeric")) for c in others))), "=", 0),
        "missing_share": ("error", F.greatest(*[F.avg(F.isnull(c).cast("int")) for c in others], F.lit(0.0)), "<=", MISSING),
    }
    if factors:
        checks["factor_levels"] = ("error", F.max(F.lit(0)) + sum((F.count_distinct(c) == F.count("*")).cast("int") for c in factors), "=", 0)
    if age:
        checks |= {"least_age": ("error", F.min(age), ">=", 0), "mean_age": ("error", F.avg(age), "<=", MOST_AGE)}
    return expect(df, checks)


def missingness(per_sample: DataFrame, share: str) -> DataFrame:
    """At most 1 % of the samples lack more than 2 % of their values."""
    return expect(per_sample, {"samples_missing": ("error", _share(F.col(share) > SAMPLE_MISSING), "<=", MISSING_SHARE)})


def analysable(df: DataFrame, *columns: str) -> DataFrame:
    """At least 10 rows are complete in the columns."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return expect(df, {"analysable": ("error", F.count_if(whole), ">=", LEAST_N)})


def alleles(df: DataFrame, a: str, b: str) -> DataFrame:
    """No variant has one allele and lacks the other."""
    return expect(df, {"half_alleles": ("error", F.count_if(F.isnull(a) != F.isnull(b)), "=", 0)})
