"""Scalar rules on columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def variant_id(chr_: str, pos: str, a: str, b: str) -> Column:
    """chr:pos_A1_A2 with the alleles in order."""
    alleles = F.array_sort(F.array(F.col(a), F.col(b)))
    return F.concat(F.col(chr_).cast("string"), F.lit(":"), F.col(pos).cast("string"), F.lit("_"), alleles[0], F.lit("_"), alleles[1])


def split_variant_id(id_: str) -> list[Column]:
    """chr, pos, a1, a2 of such an id."""
    head, pos = F.split_part(F.col(id_), F.lit(":"), F.lit(1)), F.split_part(F.col(id_), F.lit(":"), F.lit(2))
    parts = F.split(pos, "_")
    return [head.alias("chr"), parts[0].cast("long").alias("pos"), parts[1].alias("a1"), parts[2].alias("a2")]


def alleles_unordered(a: str, b: str) -> Column:
    """Allele pair on the strand with the smaller text, in order, so that complements and order don't matter."""
    def pair(x: Column, y: Column) -> Column:
        return F.concat_ws("/", F.array_sort(F.array(x, y)))

    return F.least(pair(F.col(a), F.col(b)), pair(F.translate(a, "ACGT", "TGCA"), F.translate(b, "ACGT", "TGCA")))


def chromosome_code(chr_: Column) -> Column:
    """1-22 as they are; X, Y, MT in any case and with a chr prefix as 23, 24, 25; anything else null."""
    bare = F.upper(F.regexp_replace(chr_, "(?i)^chr", ""))
    return F.when(bare == "X", 23).when(bare == "Y", 24).when(bare.isin("M", "MT"), 25).otherwise(F.when(bare.rlike("^([1-9]|1[0-9]|2[0-2])$"), bare.try_cast("int")))


def age_from_clock(x: Column, adult: float = 20.0) -> Column:
    """Inverse of the clock's log-linear age transform."""
    return F.when(x < 0, (adult + 1) * F.exp(x) - 1).otherwise((adult + 1) * x + adult)


def positive_p(p: Column) -> Column:
    """p with 0 replaced by the smallest normal double."""
    return F.when(p == 0, F.lit(2.2250738585072014e-308)).otherwise(p)


def missing_to_null(x: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def parse_number(text: Column, missing: tuple[str, ...] = ("NA", "-9", ".", "NaN", "Inf")) -> Column:
    """A double; null for missing-value codes and anything that isn't a number."""
    return F.when(F.trim(text).isin(*missing), None).otherwise(missing_to_null(F.trim(text).try_cast("double")))


def banded(x: Column, cuts: list[float]) -> Column:
    """1 below the first cut, 2 below the second, and so on."""
    return reduce(lambda c, i: c.when(x < cuts[i], i + 1), range(len(cuts)), F).otherwise(F.when(x.isNotNull(), len(cuts) + 1))


def version_at_least(have: Column, need: Column) -> Column:
    """Dotted versions part by part; missing parts count as 0."""
    def parts(c: Column) -> Column:
        return F.transform(F.split(F.concat(F.regexp_replace(c, "[^0-9.]", ""), F.lit(".0.0.0.0")), "\\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))

    return F.slice(parts(have), 1, 4) >= F.slice(parts(need), 1, 4)


def sex_from_chromosomes(x: Column, y: Column) -> Column:
    """F, M, Klinefelter or Turner from the X composition (XX or X) and the presence of Y."""
    both = F.concat(x, F.when(y, F.lit("Y")).otherwise(F.lit("")))
    return F.when(both == "XX", "F").when(both == "XY", "M").when(both == "XXY", "Klinefelter").when(both == "X", "Turner")


def sex_code(sex: Column) -> Column:
    return F.when(F.upper(sex) == "M", 1).when(F.upper(sex) == "F", 2)


def gaussian_crossing(m1: float, s1: float, w1: float, m2: float, s2: float, w2: float) -> float | None:
    """Where two weighted normal densities cross between their means, by halving; None if one is above the other at both."""
    import math

    def apart(x: float) -> float:
        first, second = (math.log(w) - math.log(s) - ((x - m) / s) ** 2 / 2 for m, s, w in ((m1, s1, w1), (m2, s2, w2)))
        return first - second

    low, high = sorted((m1, m2))
    at = apart(low)
    if at * apart(high) > 0:
        return None
    for _ in range(200):
        middle = (low + high) / 2
        if (apart(middle) > 0) == (at > 0):
            low = middle
        else:
            high = middle
    return (low + high) / 2
