"""Products of two long matrices by dense tiles: each task holds a tile of either side, whatever the matrices' sizes.

A side is a long table (row, col, value); a cell that is absent or null is missing. Rows and columns are dealt by hash into
blocks. The tiles of a pair of row blocks meet in a task one after the other, for all blocks of columns or a part of them, and
only the sums over columns are held, which merge. Which tiles meet is told by equal keys, so no plan is a Cartesian product.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and columns of a tile on average: 4 MB, so that an Arrow batch of 64 MB holds some.
ROWS, COLS = 512, 1024
#: Blocks of columns that a task sums up at most for a pair of row blocks (512 MB), and tasks that a pair is dealt to where there are few pairs.
RUN, SPREAD = 64, 16
#: Pairs of two blocks from which on many different values repeat enough to go in their order.
SORTED = 1 << 20


class Sums:
    """Sums over columns for a pair of row blocks: n, x, y, xx, yy, xy of the columns where both are present, per pair, and,
    with covariates (the intercept first), a = C'C, xc and yc with missing values at their row's mean."""

    def __init__(self, covariates: int) -> None:
        self.rows: dict = {}
        self.cols: dict = {}
        self.k = covariates
        self.pair = {name: np.zeros((0, 0)) for name in ("n", "x", "y", "xx", "yy", "xy", "mx_y", "x_my", "mm")}
        self.own = {name: np.zeros((0, 2 + 2 * covariates)) for name in ("x", "y")}
        self.squares = {name: np.zeros(0) for name in ("x", "y")}
        self.a = np.zeros((covariates, covariates))

    def _places(self, known: dict, names: np.ndarray) -> np.ndarray:
        return np.fromiter((known.setdefault(v, len(known)) for v in names.tolist()), np.int64, len(names))

    def add(self, names: np.ndarray, x: np.ndarray, others: np.ndarray, y: np.ndarray, c: np.ndarray | None) -> None:
        i, j = self._places(self.rows, names), self._places(self.cols, others)
        size = len(self.rows), len(self.cols)
        for name, old in self.pair.items():
            if old.shape != size:
                self.pair[name] = np.pad(old, [(0, size[0] - old.shape[0]), (0, size[1] - old.shape[1])])
        at = np.ix_(i, j)
        nx, ny = np.isnan(x), np.isnan(y)
        mx, my = nx.any(), ny.any()
        x0, y0 = np.where(nx, 0.0, x) if mx else x, np.where(ny, 0.0, y) if my else y
        p = self.pair
        p["xy"][at] += x0 @ y0.T
        if mx or my:
            px, py = (~nx).astype(float), (~ny).astype(float)
            p["n"][at] += px @ py.T
            p["x"][at] += x0 @ py.T
            p["xx"][at] += (x0 * x0) @ py.T
            p["y"][at] += px @ y0.T
            p["yy"][at] += px @ (y0 * y0).T
            if self.k:
                p["mx_y"][at] += nx @ y0.T
                p["x_my"][at] += x0 @ ny.T
                p["mm"][at] += nx.astype(float) @ ny.T
        else:
            p["n"][at] += x.shape[1]
            p["x"][at] += x.sum(1)[:, None]
            p["xx"][at] += (x * x).sum(1)[:, None]
            p["y"][at] += y.sum(1)[None]
            p["yy"][at] += (y * y).sum(1)[None]
        if self.k:
            self.a += c.T @ c
            for side, place, known, v, gaps in (("x", i, self.rows, x0, nx), ("y", j, self.cols, y0, ny)):
                self.own[side] = np.pad(self.own[side], [(0, len(known) - len(self.own[side])), (0, 0)])
                self.squares[side] = np.pad(self.squares[side], (0, len(known) - len(self.squares[side])))
                self.own[side][place] += np.column_stack([v.sum(1), (~gaps).sum(1), v @ c, gaps @ c])
                self.squares[side][place] += (v * v).sum(1)

    def merge(self, other: Sums) -> tuple[np.ndarray, np.ndarray]:
        """Add the sums over other columns; the places of the other's rows and columns."""
        i, j = self._places(self.rows, np.array(list(other.rows))), self._places(self.cols, np.array(list(other.cols)))
        size, at = (len(self.rows), len(self.cols)), np.ix_(i, j)
        for name, more in other.pair.items():
            old = self.pair[name]
            self.pair[name] = np.pad(old, [(0, size[0] - old.shape[0]), (0, size[1] - old.shape[1])])
            self.pair[name][at] += more
        if self.k:
            self.a += other.a
            for side, place, known in (("x", i, self.rows), ("y", j, self.cols)):
                self.own[side] = np.pad(self.own[side], [(0, len(known) - len(self.own[side])), (0, 0)])
                self.squares[side] = np.pad(self.squares[side], (0, len(known) - len(self.squares[side])))
                self.own[side][place] += other.own[side]
                self.squares[side][place] += other.squares[side]
        return i, j

    def filled(self) -> tuple[np.ndarray, ...]:
        """(xy, xx, yy, xc, yc) with missing values at their row's mean."""
        mean = {s: np.divide(o[:, 0], o[:, 1], out=np.zeros(len(o)), where=o[:, 1] > 0) for s, o in self.own.items()}
        c = {s: o[:, 2 : 2 + self.k] + mean[s][:, None] * o[:, 2 + self.k :] for s, o in self.own.items()}
        square = {s: self.squares[s] + mean[s] ** 2 * (self.a[0, 0] - o[:, 1]) for s, o in self.own.items()}
        p, mx, my = self.pair, mean["x"][:, None], mean["y"][None]
        return p["xy"] + mx * p["mx_y"] + my * p["x_my"] + mx * my * p["mm"], square["x"], square["y"], c["x"], c["y"]


class Products(Sums):
    """Only n and xy per pair, so that wider blocks fit a task."""

    def __init__(self, covariates: int) -> None:
        super().__init__(covariates)
        self.pair = {name: np.zeros((0, 0)) for name in ("n", "xy")}

    def _grown(self, names: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, ...]:
        i, j = self._places(self.rows, names), self._places(self.cols, others)
        size = len(self.rows), len(self.cols)
        for name, old in self.pair.items():
            if old.shape != size:
                self.pair[name] = np.pad(old, [(0, size[0] - old.shape[0]), (0, size[1] - old.shape[1])])
        return np.ix_(i, j)

    def add(self, names: np.ndarray, x: np.ndarray, others: np.ndarray, y: np.ndarray, c: np.ndarray | None) -> None:
        at = self._grown(names, others)
        nx, ny = np.isnan(x), np.isnan(y)
        self.pair["n"][at] += (~nx).astype(float) @ (~ny).astype(float).T if nx.any() or ny.any() else x.shape[1]
        self.pair["xy"][at] += np.where(nx, 0.0, x) @ np.where(ny, 0.0, y).T

    def once(self, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, keep) of two blocks of one side, each pair once: names of rows and columns, and where a block meets itself the
        half with i > j, and i = j if own."""
        i, j = np.array(list(self.rows), np.int64), np.array(list(self.cols), np.int64)
        keep = self.pair["n"] > 0
        if next(iter(self.rows)) in self.cols:
            keep &= i[:, None] >= j[None] if own else i[:, None] > j[None]
        return i, j, keep


def pairs(i: np.ndarray, j: np.ndarray, keep: np.ndarray, values: dict[str, np.ndarray], size: int = 100_000, by: str | None = None) -> Iterator[pa.RecordBatch]:
    """Batches (i, j, values) of the pairs to keep, the larger name first; NaN is null. by: the value in whose order they go if they are
    SORTED at least. Equal values are neighbours then, and a file can compress runs of them, which outweighs what names lose."""
    at = np.flatnonzero(keep)
    at = at if by is None or len(at) < SORTED else at[np.argsort(values[by].ravel()[at])]
    for part in np.array_split(at, max(1, -(-len(at) // size))):
        if len(part):
            a, b = np.divmod(part, keep.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(i[a], j[b])), pa.array(np.minimum(i[a], j[b])), *(pa.array(v[a, b], from_pandas=True) for v in values.values())], names=["i", "j", *values])


def near_schema(kind: str) -> str:
    """The columns of near_tile()."""
    return f"rows array<{kind}>, cols array<{kind}>, bits binary, row_n array<int>, col_n array<int>"


def near_tile(rows: list, cols: list, near: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row with what is true in a matrix of two blocks: names of either side, a bit a pair, and each name's number of true ones. Names
    without any are left out, and nothing comes of a matrix without any."""
    r, c = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if len(r):
        near = near[np.ix_(r, c)]
        names = [pa.array([[known[at] for at in there.tolist()]], pa.list_(kind)) for known, there in ((rows, r), (cols, c))]
        counts = [pa.array([near.sum(axis, dtype=np.int32)], pa.list_(pa.int32())) for axis in (1, 0)]
        yield pa.RecordBatch.from_arrays([*names, pa.array([np.packbits(near, axis=1).tobytes()], pa.binary()), *counts], names=["rows", "cols", "bits", "row_n", "col_n"])


def near_bits(batch: pa.RecordBatch, at: int) -> tuple[list, list, np.ndarray]:
    """(rows, cols, bytes that are 1 where a pair is true) of a row that near_tile() made."""
    rows, cols = batch.column("rows")[at].as_py(), batch.column("cols")[at].as_py()
    return rows, cols, np.unpackbits(np.frombuffer(batch.column("bits")[at].as_buffer(), np.uint8).reshape(len(rows), -1), axis=1, count=len(cols))


def _count(long: DataFrame, name: str, size: int) -> int:
    return max(1, -(-long.agg(F.approx_count_distinct(name)).first()[0] // size))


def _tiles(long: DataFrame, row: str, col: str, value: str, r: int, c: int, dealt: str | None = None) -> DataFrame:
    kinds = dict(long.dtypes)

    def dense(part: pd.DataFrame) -> pd.DataFrame:
        names, i = np.unique(part["row"].to_numpy(), return_inverse=True)
        cols, j = np.unique(part["col"].to_numpy(), return_inverse=True)
        x = np.full((len(names), len(cols)), np.nan)
        x[i, j] = part["v"].to_numpy(float)
        return pd.DataFrame({"r": part["r"].iloc[:1], "c": part["c"].iloc[:1], "names": [list(names)], "cols": [list(cols)], "data": [x.tobytes()]})

    block = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    rows = long.select((F.col(dealt) if dealt else block(row, r)).cast("int").alias("r"), block(col, c).alias("c"), F.col(row).alias("row"), F.col(col).alias("col"), F.col(value).cast("double").alias("v"))
    return rows.groupBy("r", "c").applyInPandas(dense, f"r int, c int, names array<{kinds[row]}>, cols array<{kinds[col]}>, data binary")


def multiply(left: DataFrame, right: DataFrame, finish: Callable[[Sums], Iterator[pa.RecordBatch]], schema: str, names: tuple[str, str, str], others: tuple[str, str, str], covariates: DataFrame | None = None, k: int = 0, band: tuple[str, int] | None = None, kernel: Callable[[int], Sums] = Sums, wide: int | None = None, within: str | None = None) -> DataFrame:
    """What finish() makes of the Sums of each pair of row blocks. names and others: the (row, col, value) columns of either
    side; covariates: (col, c array of k), which also says which columns there are. band: a column of both sides that deals
    their rows into numbered blocks, and how much larger the right block's number may be than the left one's: only such pairs
    meet then, without covariates. kernel: what adds up the sums, of k covariates. wide: both sides
    are the same table, whose blocks have up to so many times ROWS rows; each pair of blocks meets once. within: an int column of both
    sides; only rows with the same number in it meet, without covariates, and names of rows must tell those of several numbers apart."""
    spark = left.sparkSession
    if band:
        r = s = 1
    elif wide:
        n = _count(left, names[0], 1)
        r = s = -(-n // min(wide * ROWS, max(ROWS, n // 16)))  # not so few blocks that tasks lack pairs of them
    else:
        r, s = _count(left, names[0], ROWS), _count(right, others[0], ROWS)
    groups = _count(left, within, 1) if within else 1
    c = _count(left, names[1], max(1, COLS * groups // (wide or 1)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    kind = dict(left.dtypes)[names[0]], dict(right.dtypes)[others[0]]
    none = lambda t: F.expr(f"cast(null as array<{t}>)").alias
    dealt, far = band or (None, 0)
    after = F.explode(F.sequence(F.col("r"), F.col("r") + far)) if band else F.explode(F.sequence(F.col("r"), F.lit(s - 1))) if wide else each(s)
    before = F.explode(F.sequence(F.col("s") - far, F.col("s"))) if band else F.explode(F.sequence(F.lit(0), F.col("s"))) if wide else each(r)
    x = _tiles(left, *names, r, c, dealt).select("r", after.alias("s"), "c", F.lit(1).alias("side"), "cols", "data", F.col("names").alias("xn"), none(kind[1])("yn"))
    y = _tiles(right, *others, s, c, dealt).withColumnRenamed("r", "s").select(before.alias("r"), "s", "c", F.lit(2).alias("side"), "cols", "data", none(kind[0])("xn"), F.col("names").alias("yn"))
    if within:
        own = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)) + F.col(within) * n
        run_of = lambda number, n, m: F.explode(F.sequence((F.floor(number / n) * m).cast("int"), (F.floor(number / n) * m + m - 1).cast("int")))
        x = _tiles(left.withColumn("__d", own(names[0], r)), *names, r, c, "__d").select("r", run_of(F.col("r"), r, s).alias("s"), "c", F.lit(1).alias("side"), "cols", "data", F.col("names").alias("xn"), none(kind[1])("yn"))
        y = _tiles(right.withColumn("__d", own(others[0], s)), *others, s, c, "__d").withColumnRenamed("r", "s").select(run_of(F.col("s"), s, r).alias("r"), "s", "c", F.lit(2).alias("side"), "cols", "data", none(kind[0])("xn"), F.col("names").alias("yn"))
    tiles = x.unionByName(y)
    if covariates is not None:
        flat = covariates.select(F.col(names[1]), F.posexplode("c").alias("__j", "__v"))
        z = _tiles(flat, "__j", names[1], "__v", 1, c)
        z = z.withColumn("r", each(r)).withColumn("s", each(s)).select("r", "s", "c", F.lit(0).alias("side"), "cols", "data", none(kind[0])("xn"), none(kind[1])("yn"))
        tiles = tiles.unionByName(z)

    swept = covariates is not None

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Sums]]:
        now, sums, held = None, kernel(k), {}
        for batch in batches:
            for at in range(batch.num_rows):
                key = tuple(batch.column(i)[at].as_py() for i in range(3))
                side, cols = batch.column(3)[at].as_py(), batch.column(4)[at].values.to_numpy(zero_copy_only=False)
                if key[:2] != now:
                    if sums.rows:
                        yield now, sums
                    now, sums = key[:2], kernel(k)
                if held.get("key") != key:
                    held = {"key": key}
                data = np.frombuffer(batch.column(5)[at].as_buffer()).reshape(-1, len(cols))
                if side < 2:
                    held[side] = (cols, data, batch.column(6)[at].values)
                    continue
                if 1 not in held or swept and 0 not in held:
                    continue
                known = held[0][0] if swept else np.union1d(held[1][0], cols)
                sums.add(held[1][2].to_numpy(zero_copy_only=False), _onto(held[1][1], held[1][0], known), batch.column(7)[at].values.to_numpy(zero_copy_only=False), _onto(data, cols, known), held[0][1].T if swept else None)
        if sums.rows:
            yield now, sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sums in summed(batches):
            yield from finish(sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (r_, s_), sums in summed(batches):
            yield pa.RecordBatch.from_arrays([pa.array([r_], pa.int32()), pa.array([s_], pa.int32()), pa.array([pickle.dumps(sums)], pa.binary())], names=["r", "s", "sums"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                key = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                part = pickle.loads(batch.column(2)[at].as_py())
                if key == now:
                    sums.merge(part)
                    continue
                if now is not None:
                    yield from finish(sums)
                now, sums = key, part
        if now is not None:
            yield from finish(sums)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 1 if band or wide else min(c, max(-(-c // RUN), min(SPREAD, n // (r * s * groups)), 1))
    if parts == 1:
        return tiles.repartition(n, "r", "s").sortWithinPartitions("r", "s", "c", "side").mapInArrow(run, schema)
    # a task adds up some of the blocks of columns, and a pair's sums are added up after it
    tiles = tiles.withColumn("part", F.pmod("c", F.lit(parts)))
    some = tiles.repartition(max(n, r * s * groups * parts), "r", "s", "part").sortWithinPartitions("part", "r", "s", "c", "side").drop("part").mapInArrow(partial, "r int, s int, sums binary")
    return some.repartition(n, "r", "s").sortWithinPartitions("r", "s").mapInArrow(merged, schema)


def _onto(x: np.ndarray, cols: np.ndarray, known: np.ndarray) -> np.ndarray:
    """x with the known columns, both sorted; those that x lacks are missing."""
    if len(cols) == len(known) and (cols == known).all():
        return x
    out = np.full((len(x), len(known)), np.nan)
    at = np.searchsorted(known, cols).clip(max=len(known) - 1)
    same = known[at] == cols
    out[:, at[same]] = x[:, same]
    return out


def rows(sums: Sums, keep: np.ndarray, values: dict[str, np.ndarray], kinds: tuple[pa.DataType | None, pa.DataType | None], names: tuple[str, str], size: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Batches (row, other, values) of the pairs to keep."""
    a, b = np.nonzero(keep)
    left, right = pa.array(list(sums.rows)), pa.array(list(sums.cols))
    left, right = (v.cast(k) if k is not None else v for v, k in zip((left, right), kinds, strict=True))
    for at in range(0, len(a), size):
        i, j = a[at : at + size], b[at : at + size]
        yield pa.RecordBatch.from_arrays([left.take(pa.array(i)), right.take(pa.array(j)), *(pa.array(v[i, j]) for v in values.values())], names=[*names, *values])
