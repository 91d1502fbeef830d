"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm import common

#: Rows in a block on average, most blocks of a source, and of all: they bound the plan, whatever the number of rows.
BLOCK_ROWS, MOST_BLOCKS, PLAN_BLOCKS = 64, 2_048, 1 << 18
#: Most sources: each has a weight of its own and at least one block in the plan.
MOST_SOURCES = 100_000
#: Output shards.
SHARDS = 16
_WHOLE = (1 << 63) - 1


def targets(sizes: list[int], weights: list[float], total: float, most: float = 3.0) -> list[float]:
    """Shares of total by weight, none above `most` times its size; what is above goes to the others by weight."""
    out, open_ = [0.0] * len(sizes), {i for i, s in enumerate(sizes) if s > 0}
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / weight > most * sizes[i]}
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            return out
        for i in over:
            out[i] = most * sizes[i]
        left = max(0.0, left - sum(out[i] for i in over))
        open_ -= over
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """shards x sources: quotas dealt out over shards down a binary tree, each split multivariate hypergeometric."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    draw = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * left // shards, method="marginals")
    return np.vstack([split_quotas(draw, left, rng), split_quotas(quotas - draw, shards - left, rng)])


@dataclass(frozen=True)
class Source:
    name: str | None
    rows: int
    size: int
    target: float
    blocks: int


def sources(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> list[Source]:
    """Each source's rows, words, target and number of blocks; sources by code point, null last, weigh `weights` in turn.

    The driver holds a row for each source, MOST_SOURCES at most; a table with more is refused.
    """
    found = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("s")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["s"] or 0) for r in found]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share * sum(sizes), most)
    upto = max(1, min(MOST_BLOCKS, PLAN_BLOCKS // max(1, len(found))))
    return [Source(r["source"], r["n"], s, t, max(1, min(upto, -(-r["n"] // BLOCK_ROWS)))) for r, s, t in zip(found, sizes, aims, strict=True)]


def picks(source: Source, words: dict[int, int], rng: np.random.Generator) -> list[tuple[int, int, float | None]]:
    """Blocks that a source's target takes, as (block, pass, words if only a part): whole passes take every block, the last
    one blocks of a permutation until the target is met. The list is permuted in the end."""
    out: list[tuple[int, int, float | None]] = []
    left, epoch = source.target, 0
    while source.size and left >= source.size - 0.5:
        out += [(b, epoch, None) for b in sorted(words)]
        left, epoch = left - source.size, epoch + 1
    for b in rng.permutation(sorted(words)).tolist() if left >= 0.5 else ():
        if words[b] > left:
            out.append((b, epoch, left))
            break
        out.append((b, epoch, None))
        left -= words[b]
    return [out[i] for i in rng.permutation(len(out))]


def placed(sized: DataFrame, found: list[Source], seed: int) -> DataFrame:
    """Rows with __source, __block, __order, source_size and target; all but target depend on doc_id and text alone."""
    spark = sized.sparkSession
    index = spark.createDataFrame([(s.name, i, s.blocks, s.size, s.target) for i, s in enumerate(found)], "__name string, __source int, __blocks int, source_size long, target double")
    rows = sized.join(F.broadcast(index), F.col("source").eqNullSafe(F.col("__name")), "left").drop("__name")  # MOST_SOURCES rows
    block = F.pmod(F.xxhash64("doc_id", "__text", F.lit(seed)), F.col("__blocks")).cast("int")
    return rows.withColumn("__block", block).withColumn("__order", F.xxhash64("doc_id", "__text", F.lit(seed + 1))).drop("__blocks")


def plan(slim: DataFrame, found: list[Source], shards: int, seed: int) -> DataFrame:
    """__source, __block, __draws: the draws of each block, (epoch, shard, upto): rows of it up to that __order are drawn.

    The tree splits the number of blocks that each source gives over shards; each shard draws its quota from what is left of
    the source's permuted blocks. The plan has PLAN_BLOCKS rows at most, if there are fewer sources.
    """
    spark = slim.sparkSession
    rows = placed(slim, found, seed)
    words: list[dict[int, int]] = [{} for _ in found]
    for r in rows.groupBy("__source", "__block").agg(F.sum("size").alias("s")).collect():  # PLAN_BLOCKS at most
        words[r["__source"]][r["__block"]] = int(r["s"])
    rng = np.random.default_rng(seed)
    taken = [picks(s, w, rng) for s, w in zip(found, words, strict=True)]
    parts = [(i, b, float(m)) for i, x in enumerate(taken) for b, _, m in x if m is not None]
    upto = _cuts(rows, spark.createDataFrame(parts, "__source int, __block int, __most double")) if parts else {}
    quotas = split_quotas(np.array([len(p) for p in taken], np.int64), shards, rng) if found else np.zeros((shards, 0), np.int64)
    draws: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for i, blocks in enumerate(taken):
        left = iter(blocks)
        for shard, n in enumerate(quotas[:, i].tolist()):
            for b, epoch, part in islice(left, n):
                draws.setdefault((i, b), []).append((epoch, shard, _WHOLE if part is None else upto.get(i, -_WHOLE - 1)))
    return spark.createDataFrame([(*k, sorted(v)) for k, v in draws.items()], "__source int, __block int, __draws array<struct<epoch: int, shard: int, upto: long>>")


def _cuts(rows: DataFrame, parts: DataFrame) -> dict[int, int]:
    """For the block that a source gives in part: the last __order within the words that it may give, by source.

    A block holds 1 / MOST_BLOCKS of its source's rows; the running sum is over numbers alone. Rows of one __order go together.
    """
    place = ["__source", "__block"]
    sums = rows.select(*place, "__order", "size").join(F.broadcast(parts), place).groupBy(*place, "__order", "__most").agg(F.sum("size").alias("s"))
    run = F.sum("s").over(Window.partitionBy(*place).orderBy("__order"))
    return dict(sums.withColumn("run", run).where("run - s / 2 <= __most").groupBy("__source").agg(F.max("__order")).collect())


def drawn(docs: DataFrame, shards: int, seed: int, **aims: object) -> tuple[DataFrame, DataFrame]:
    """(docs, slim), both with size, source_size, target, __order and __draws; slim is a saved table without other columns.

    The plan, bounded whatever the number of rows, is broadcast, so no text is shuffled.
    """
    sized = docs.withColumns({"size": common.word_count(F.col("text")), "__text": F.xxhash64("text")})
    slim = common.save(sized.select("doc_id", "source", "size", "__text"), "sizes")
    found = sources(slim, **aims)
    known = F.broadcast(plan(slim, found, shards, seed))

    def with_draws(rows: DataFrame) -> DataFrame:
        out = placed(rows, found, seed).join(known, ["__source", "__block"], "left")
        return out.withColumn("__draws", F.expr("filter(coalesce(__draws, array()), d -> __order <= d.upto)"))

    return with_draws(sized), with_draws(slim)


_NEW = ("size", "source_size", "target", "mix_shard", "mix_epoch", "mix_order")
_OWN = ("__text", "__source", "__block", "__order", "__draws")


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = 17, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """The mix: docs' rows, each as often as it is drawn, with mix_shard, mix_epoch, mix_order, size, source_size, target.

    size is the number of words of a row's whole text (null text: 0). Each source's words in the mix come within about one
    document of its target. mix_order shuffles within a shard. A document is drawn at most `most` times, once a pass. Rows
    without words are never drawn from a source that has none; null sources are one source, the last. Columns of these
    names in docs are replaced. An empty table gives an empty table. Rows that repeat doc_id and text are drawn alike.
    """
    rows, _ = drawn(docs.drop(*_NEW), shards, seed, weights=weights, share=share, most=most)
    rows = rows.withColumn("__draw", F.explode("__draws")).withColumns({"mix_shard": F.col("__draw.shard"), "mix_epoch": F.col("__draw.epoch")})
    return rows.withColumn("mix_order", F.xxhash64("doc_id", "__text", "mix_epoch", F.lit(seed + 2))).drop("__draw", *_OWN)


def shuffled(mixed: DataFrame, partitions: int) -> DataFrame:
    """A mix in the order of its shards and, within each, of mix_order."""
    return mixed.repartitionByRange(partitions, "mix_shard", "mix_order").sortWithinPartitions("mix_shard", "mix_order")


def taken(docs: DataFrame, shards: int = SHARDS, seed: int = 17, **aims: object) -> DataFrame:
    """A row for each row of docs: doc_id, size, source_size, target, mix_shards (the shards that draw it) and taken: the
    words of it in the mix. See mix(); rows that repeat have a row each."""
    _, slim = drawn(docs.select("doc_id", "source", "text"), shards, seed, **aims)
    shards_ = F.expr("array_sort(transform(__draws, d -> d.shard))")
    return slim.select("doc_id", "size", "source_size", "target", shards_.alias("mix_shards"), (F.col("size") * F.size("__draws")).alias("taken"))
