"""Best-fit packing: a configuration linear program over the length histogram, solved by multiplicative weights.

A configuration is a multiset of lengths that fills one sequence. The program covers the rows of each length by fractional
configurations; lengths whose cover lags behind gain weight, a knapsack dynamic program prices configurations at these
weights, and each length that lags takes the best configuration that holds it. The largest of the configurations are rounded
down to whole sequences; best fit over the histogram takes the rows left over. All of this is about the histogram, whose size
the sequence length bounds; the rows are then placed by their rank within a length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import common

LENGTH, END_ID = 4096, 1
#: Rounds of multiplicative weights, pricings in each, rate of the weights, and width of a configuration.
ROUNDS, PRICINGS, RATE, WIDTH = 4, 3, 1.0, 4


@dataclass
class Run:
    """`count` equal sequences from number `first` on; slots: (length, how many of it); `fitted`: by best fit."""

    first: int
    count: int
    slots: list[tuple[int, int]]
    fitted: bool = False


class Knapsack:
    """Most value that each room can hold, lengths repeating at will, and what the best choice for a room begins with."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray, capacity: int) -> None:
        self.lengths, self.best, self.pick = lengths, np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
        best, upto = self.best, np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
        for c in range(1, capacity + 1):
            best[c] = best[c - 1]
            if n := upto[c]:
                gain = best[c - lengths[:n]] + values[:n]
                j = int(gain.argmax())
                if gain[j] > best[c]:
                    best[c], self.pick[c] = gain[j], j
        self.values = values

    def around(self, j: int, most: np.ndarray) -> tuple[dict[int, int], int]:
        """(index: count, room left) of the best configuration with j. Where it repeats a length beyond `most`, the longest
        others that fit take the room."""
        found, room = {j: 1}, len(self.best) - 1 - int(self.lengths[j])
        c = room
        while c > 0:
            i = int(self.pick[c])
            if i < 0:
                c -= 1
                continue
            if found.get(i, 0) < most[i]:
                found[i] = found.get(i, 0) + 1
                room -= int(self.lengths[i])
            c -= int(self.lengths[i])
        while room > 0 and (at := int(np.searchsorted(self.lengths, room, side="right"))):
            i = at - 1
            while i >= 0 and found.get(i, 0) >= most[i]:
                i -= 1
            if i < 0:
                break
            found[i] = found.get(i, 0) + 1
            room -= int(self.lengths[i])
        return found, room


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """Fractional configurations ((length, count), ...) that never exceed the demand, and a lower bound by linear duality.

    In each of `rounds` rounds, of PRICINGS pricings at most, the share of the demand that is to be covered grows by as much. A round prices a row of a
    length at its length times a weight, which shrinks by the exponent of how far the length's cover is ahead of the average,
    and solves the knapsack for these prices. Lengths below the round's share, the longest first, then take their best
    configuration, if that is full (others are left to best fit), by as much as the length that it exhausts first allows.
    """
    covered, config = np.zeros(len(lengths)), {}  # rows of each length, sequences of each configuration
    bound = float(lengths @ demand) / capacity
    # a configuration holds a length at most WIDTH times as often as the average sequence does, or once
    width = np.maximum(1, np.ceil(WIDTH * demand / bound)).astype(np.int64)
    for t in range(1, rounds + 1):
        share = demand * t / rounds
        for _ in range(PRICINGS):
            open_ = covered < share - 1e-9 * demand
            if not open_.any():
                break
            weight = np.exp(-RATE * (covered / demand - (covered / demand)[open_].mean()))
            price = np.where(open_, lengths * np.clip(weight, 0.5, 2.0), 0.0)
            known = Knapsack(price, lengths, capacity)
            if known.best[capacity] > 0:
                bound = max(bound, float(price @ demand) / known.best[capacity])
            for j in np.flatnonzero(open_)[::-1].tolist():
                if covered[j] >= share[j] - 1e-9 * demand[j]:
                    continue
                most = np.where(covered < share - 1e-9 * demand, width, 0)
                found, room = known.around(j, most)
                if room:
                    continue
                step = min((share[i] - covered[i]) / k for i, k in found.items())
                key = tuple(sorted((int(lengths[i]), k) for i, k in found.items()))
                config[key] = config.get(key, 0.0) + step
                for i, k in found.items():
                    covered[i] += k * step
    return config, bound


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(sequences, slots): the longest row left, then ever the longest that still fits. Equal sequences count as one."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out = []
    lengths = [int(x) for x in np.flatnonzero(left)]
    while lengths:
        room, slots = capacity, []
        at = len(lengths)
        while at > 0:
            at = int(np.searchsorted(lengths[:at], room, side="right"))
            if not at:
                break
            length = lengths[at - 1]
            k = min(int(left[length]), room // length)
            slots.append((length, k))
            room -= k * length
            at -= 1
        times = max(1, min(int(left[x]) // k for x, k in slots))
        for x, k in slots:
            left[x] -= k * times
        out.append((times, slots))
        lengths = [x for x in lengths if left[x]]
    return out


def plan(histogram: dict[int, int], capacity: int = LENGTH, rounds: int = ROUNDS) -> tuple[list[Run], float]:
    """Sequences that hold every row of the histogram exactly once; a lower bound on their number by linear duality.

    Of the linear program's configurations as many as there are lengths are kept, those of most sequences, and rounded down;
    best fit over the histogram takes the rows left over. Should best fit alone need fewer sequences, its plan is taken.
    """
    left = {length: n for length, n in sorted(histogram.items()) if n > 0}
    full = left.pop(capacity, 0)  # rows that fill a sequence
    runs = [Run(0, full, [(capacity, 1)])] if full else []
    if not left:
        return runs, float(full)
    lengths = np.array(sorted(left), np.int64)
    solution, bound = solve(lengths, np.array([left[x] for x in lengths.tolist()], np.float64), capacity, rounds)
    # of equal ones those that leave short rows to best fit
    kept = sorted(solution.items(), key=lambda x: (-x[1], -x[0][0][0], x[0]))[: len(lengths)]
    rest, mixed = dict(left), []
    for key, x in kept:
        n = min(int(x + 1e-9), *(rest[length] // k for length, k in key))
        if n > 0:
            mixed.append((n, list(key), False))
            for length, k in key:
                rest[length] -= n * k
    mixed += [(n, slots, True) for n, slots in best_fit({x: n for x, n in rest.items() if n > 0}, capacity)]
    alone = [(n, slots, True) for n, slots in best_fit(left, capacity)]
    first = full
    for n, slots, fitted in min(mixed, alone, key=lambda p: sum(x[0] for x in p)):
        runs.append(Run(first, n, slots, fitted))
        first += n
    return runs, full + bound


def segments(runs: list[Run]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset, rows of it in a sequence) sorted by first rank."""
    used: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    for r in runs:
        offset = 0
        for length, k in r.slots:
            at = used.get(length, 0)
            out.setdefault(length, []).append((at, r.first, offset, k))
            used[length] = at + r.count * k
            offset += length * k
    return {length: np.array(x, np.int64) for length, x in out.items()}


def place(length: int, rank: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of rows of one length by rank."""
    s = found[np.searchsorted(found[:, 0], rank, side="right") - 1]
    at = rank - s[:, 0]
    return s[:, 1] + at // s[:, 3], s[:, 2] + at % s[:, 3] * length


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each text's ids and end_id, cut only if longer than `length`."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            tokens, rows = common.tokenizer(tokenizer_path), []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = tokens.encode(text or "") + end
                for i, at in enumerate(range(0, len(data), 4 * length)):
                    piece = data[at : at + 4 * length]
                    rows.append((doc_id, i, at // 4, len(piece) // 4, zlib.crc32(piece), piece))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)][: len(names)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def ranked(rows: DataFrame, parts: int) -> DataFrame:
    """rows with __rank: 0 to n-1 within each length, by doc_id, piece and checksum.

    A length may have any share of the rows, so it is dealt over `parts` buckets of ids; ranks within a bucket start where
    the earlier buckets' counts end.
    """
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(parts)).cast("int"))
    counts = rows.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    before = counts.selectExpr("length", "__part", "sum(__n) over (partition by length order by __part) - __n as __before")
    inside = rows.selectExpr("*", "row_number() over (partition by __part, length order by doc_id, piece, ids_crc32) - 1 as __in")
    return inside.join(before, ["length", "__part"]).withColumn("__rank", F.col("__in") + F.col("__before")).drop("__part", "__in", "__before")


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, rounds: int = ROUNDS, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null text counts as empty: it is one piece with the end id. Only documents longer than `length` ids are cut. Sequences
    are gapless from offset 0. Rows that repeat are packed once each. An empty table gives an empty table. Other columns of
    docs aren't looked at. The driver holds the histogram, `length` counts at most, and the plan, whose size `rounds` and
    `length` bound.
    """
    rows = common.save(pieces(docs, tokenizer_path, length, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    runs, _ = plan(histogram, length, rounds)
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(segments(runs))
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "__rank"))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for x in np.unique(size):
                at = size == x
                sequence[at], offset[at] = place(int(x), rank[at], known.value[int(x)])
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    return ranked(rows, common.shuffle_partitions(spark)).mapInArrow(run, schema)
