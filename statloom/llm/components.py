"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm import common

#: Nodes that a task's union-find holds before it passes its edges on.
FOREST_NODES = 500_000


class Forest:
    """Union-find over hashable nodes; the smaller root wins."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's edges as stars around its components' smallest nodes."""

    def out() -> pa.RecordBatch:
        a = list(forest.up)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array([forest.find(x) for x in a], pa.int64())], names=["a", "b"])

    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        if len(forest.up) > FOREST_NODES:
            yield out()
            forest = Forest()
    if forest.up:
        yield out()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a long, b long); root is the component's smallest node.

    Nodes without edges have no row. Loops and repeated edges do no harm; an empty table gives an empty table.
    """
    stars = edges.where("a != b").select("a", "b").mapInArrow(_forests, "a long, b long")
    now, before = common.save(stars.where("a != b").distinct(), "edges"), None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # each larger node now points down; join what one node points to below its least one
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select("b", "m").where("b != m").union(lowest.select("a", "m")).distinct()
        now = common.save(small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")), "edges", [now])
