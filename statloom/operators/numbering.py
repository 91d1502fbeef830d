"""Numbers in a global order, running sums and stable codes, in two steps: within ranges, then over the ranges' totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.operators import store

_PLACE = (1 << 33) - 1


def _ordered(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """df dealt into ranges of the order and written, with __p, the range, and __i, the place within it (from 0)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    return store.keep(ranged, "ordered").withColumns({"__p": F.shiftright("__id", 33), "__i": F.col("__id").bitwiseAND(F.lit(_PLACE))}).drop("__id")


def numbered(df: DataFrame, *order: Column | str, name: str = "n") -> DataFrame:
    """df with the row's number in the order, from 1; rows that tie are numbered in any order among themselves.

    Ranges are sorted side by side; only their sizes, a row a partition, meet in one place. Nulls are where Spark sorts them.
    """
    rows = _ordered(df, list(order))
    sizes = rows.groupBy("__p").agg(F.count("*").alias("__c"))
    before = sizes.select("__p", (F.sum("__c").over(Window.orderBy("__p")) - F.col("__c")).alias("__before"))
    return rows.join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + F.col("__i") + 1).drop("__p", "__i", "__before")


def running_sum(df: DataFrame, value: str, *order: Column | str, name: str = "total") -> DataFrame:
    """df with the sum of `value` over the rows up to this one in the order (ties in any order), and their share of the whole
    in `share`. Null adds nothing."""
    rows = _ordered(df, list(order))
    sums = rows.groupBy("__p").agg(F.coalesce(F.sum(value), F.lit(0)).alias("__s"))
    before = sums.select("__p", (F.sum("__s").over(Window.orderBy("__p")) - F.col("__s")).alias("__before"), F.sum("__s").over(Window.partitionBy()).alias("__all"))
    own = F.sum(F.coalesce(value, F.lit(0))).over(Window.partitionBy("__p").orderBy("__i").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + own).withColumn("share", F.col(name) / F.col("__all"))
    return out.drop("__p", "__i", "__before", "__all")


def codes(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, code): codes from 0 of the distinct values that aren't null, in their order.

    known: an earlier result, whose codes stay; values that it lacks get further codes, in their order among themselves. So a
    table loaded in chunks has codes that never change.
    """
    new = values.select(column).where(F.col(column).isNotNull()).distinct()
    if known is None:
        return numbered(new, column).select(column, (F.col("n") - 1).alias("code"))
    last = known.agg(F.coalesce(F.max("code"), F.lit(-1))).first()[0]
    more = numbered(new.join(known.select(column), column, "left_anti"), column).select(column, (F.col("n") + last).alias("code"))
    return known.select(column, "code").unionByName(more)


def factor_levels(df: DataFrame, column: str, name: str = "level") -> DataFrame:
    """df with the rank of the column's value among its distinct ones, from 1; null, if there is any, comes first."""
    levels = numbered(df.select(column).distinct(), column, name=name)
    return df.join(levels.withColumnRenamed(column, "__level"), F.col(column).eqNullSafe(F.col("__level"))).drop("__level")
