"""Column types by name: *_factor columns are categories, *_numeric ones numbers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.scalars import parse_number


def typed_columns(names: list[str]) -> tuple[list[str], list[str]]:
    """(factors, numbers) among the names."""
    return [n for n in names if n.endswith("_factor")], [n for n in names if n.endswith("_numeric")]


def find_column(names: list[str], pattern: str) -> str | None:
    """The one column that matches the whole pattern in any case; None if there is none or more than one."""
    found = [n for n in names if re.fullmatch(pattern, n, re.IGNORECASE)]
    return found[0] if len(found) == 1 else None


def apply_types(df: DataFrame) -> DataFrame:
    """Factors as text, numbers as doubles with missing-value codes as null."""
    factors, numbers = typed_columns(df.columns)
    return df.withColumns({c: F.col(c).cast("string") for c in factors} | {c: parse_number(F.col(c).cast("string")) for c in numbers})


def one_hot(df: DataFrame, factor: str, levels: list[str]) -> DataFrame:
    """0/1 columns for all levels but the first by name, which is the reference."""
    return df.select("*", *[(F.col(factor) == v).cast("int").alias(f"{factor}_{v}") for v in sorted(levels)[1:]]).drop(factor)


def drop_uninformative(df: DataFrame, keep: tuple[str, ...] = ("IID",)) -> DataFrame:
    """Without the columns that have at most one distinct value."""
    names = [c for c in df.columns if c not in keep]
    row = df.agg(*[(F.min(c).eqNullSafe(F.max(c))).alias(c) for c in names]).first() if names else {}
    return df.drop(*[c for c in names if row[c]])
