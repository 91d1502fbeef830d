"""Alignment of tables by sample id and of variants with a reference panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def common_ids(tables: list[DataFrame], key: str) -> DataFrame:
    """Ids that every table has."""
    return reduce(lambda a, b: a.join(b, key, "left_semi"), [t.select(key) for t in tables]).distinct()


def first_match(left: DataFrame, right: DataFrame, key: str, order: list[str]) -> DataFrame:
    """All rows of left, in each the first row of right (by `order`) with the same id, or nulls."""
    w = Window.partitionBy(key).orderBy(*order)
    return left.join(right.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n"), key, "left")


def full_chain(tables: list[DataFrame], key: str) -> DataFrame:
    """Full outer joins one after another on one key."""
    return reduce(lambda a, b: a.join(b, key, "full"), tables)


def match_variants(study: DataFrame, reference: DataFrame, on_flip: str = "flip") -> DataFrame:
    """Each reference variant (ref_idx, chr, bp, a1, a2) with study_idx and flip; study_idx is -1 and flip 0 if absent.

    Alleles match straight (flip 1) or reversed (flip -1); straight ones go first, then the least study_idx. on_flip: "flip"
    keeps reversed ones, "drop" leaves them out, "error" raises if there is any.
    """
    key = F.array_sort(F.array("a1", "a2"))
    left = reference.withColumn("__k", key)
    right = study.select("chr", "bp", key.alias("__k"), F.col("a1").alias("__a1"), "study_idx")
    if on_flip == "drop":
        left, right = left.withColumn("__s", F.col("a1")), right.withColumn("__s", F.col("__a1"))
    on = ["chr", "bp", "__k", *(["__s"] if on_flip == "drop" else [])]
    found = left.join(right, on, "left").withColumn("flip", F.when(F.col("study_idx").isNull(), 0).when(F.col("__a1") == F.col("a1"), 1).otherwise(-1))
    w = Window.partitionBy("ref_idx").orderBy(F.desc("flip"), "study_idx")
    found = found.withColumn("__n", F.row_number().over(w)).where("__n = 1").withColumn("study_idx", F.coalesce("study_idx", F.lit(-1)))
    if on_flip == "error" and not found.where("flip = -1").isEmpty():
        raise ValueError("the study has variants with reversed alleles")
    return found.select("ref_idx", "study_idx", "flip")


def flip_dosage(g, flip):
    """g, or 2 - g where flip is -1."""
    return F.when(flip == -1, 2 - g).otherwise(g)


def exclude_mismatch(df: DataFrame, key: str, *values: str) -> DataFrame:
    """Of rows with one key: all go if their values differ, else one stays."""
    row = F.struct(*values)
    w = Window.partitionBy(key)
    df = df.withColumn("__lo", F.min(row).over(w)).withColumn("__hi", F.max(row).over(w)).withColumn("__n", F.row_number().over(w.orderBy(*values)))
    return df.where((F.col("__lo") == F.col("__hi")) & (F.col("__n") == 1)).drop("__lo", "__hi", "__n")
