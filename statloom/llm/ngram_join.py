"""N-gram Jaccard join by parity sketches.

A text's shingles are XOR-hashed into a bit sketch: each toggles one bit, so the Hamming distance of two sketches is at most
the size of the sets' symmetric difference. A sketch grows with its set; folding the longer of two onto itself makes them
comparable. Sets are dealt into size bands. In a band, shingles fall by hash into so many parts that of two sets which link
some parts are the same in both (pigeonhole); the join is on parts' parities. Pairs that meet and pass the bounds of their
sizes and sketches make candidate groups, and the sets in each group are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm import common
from statloom.llm.components import Forest, components

#: Ratio of a size band's ends, and sets that one task compares with one another.
BAND, CELL = 1.5, 2048
#: Keys of large groups that a set may go without, in each band.
COMMON = 2
_SEED = np.uint64(0x5851F42D4C957F2D)


def band(n: int) -> int:
    return int(math.log(n) / math.log(BAND) + 1e-9)


def band_end(b: int) -> int:
    """Least size above the band's sets."""
    n = max(1, math.floor(BAND ** (b + 1)))
    while band(n) <= b:
        n += 1
    return n


class Join:
    """Sets link when 100 * |A & B| >= percent * |A | B|; all on integers."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.parts: dict[int, int] = {}

    def linked(self, common_size: int, a: int, b: int) -> bool:
        return 100 * common_size >= self.percent * (a + b - common_size)

    def least_size(self, n: int) -> int:
        """The smallest set that a set of n may link with."""
        return -(-n * self.percent // 100)

    def most_apart(self, a, b):
        """The largest symmetric difference of linked sets of these sizes."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def part_count(self, b: int) -> tuple[int, int]:
        """(parts, empty ones to spare) of a band: linked sets whose smaller one is in the band differ in at most d parts.

        There are more than d + 1, so linked sets agree in `spare` + COMMON + 1 parts at least. A set with at most `spare`
        empty parts needs no keys for those, and one with at most COMMON keys that very many sets have needs none of these.
        """
        if b not in self.parts:
            small = band_end(b) - 1
            self.parts[b] = self.most_apart(small, small * 100 // self.percent)
        d = self.parts[b]
        spare = 2 + d // 200
        return (d + 1 + spare + COMMON, spare) if d else (1, 0)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the parts of a set, in its own band and, as the larger set of a pair, in that of its least partner."""
        n = len(shingles)
        if not n:
            return shingles
        # two further hashes: one picks the part, the other stands for the shingle in the part's parity
        pick, value = common.mix(shingles ^ _SEED), common.mix(shingles + _SEED)
        out = []
        for b in range(band(max(1, self.least_size(n))), band(n) + 1):
            parts, spare = self.part_count(b)
            if parts == 1:  # too small to differ and link; equal sets are one
                continue
            part = (pick % np.uint64(parts)).astype(np.int64)
            parity = np.zeros(parts, np.uint64)
            np.bitwise_xor.at(parity, part, value)
            size = np.bincount(part, minlength=parts)
            full = np.flatnonzero(size) if parts - np.count_nonzero(size) <= spare else np.arange(parts)
            tag = common.mix(full.astype(np.uint64) + np.uint64(b << 32))
            key = common.mix(parity[full] + size[full].astype(np.uint64) * _SEED ^ tag)
            out.append(key & ~np.uint64(63) | np.uint64(b))  # the last six bits tell the band
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def sketch(shingles: np.ndarray, words: int = 0) -> np.ndarray:
    """Parity of each bit over a set, in `words` 64-bit words: a power of two, by default of 2 to 4 bits a shingle."""
    bits = 64 * words or max(64, 1 << (2 * len(shingles) - 1).bit_length())
    at = common.mix(shingles ^ (_SEED << np.uint64(1))) & np.uint64(bits - 1)
    parity = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(sketches: np.ndarray, words: int) -> np.ndarray:
    """Rows of sketches at a smaller power of two of words: bits that meet are XORed, as if hashed to fewer."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def _name(shingles: np.ndarray, salt: int) -> int:
    salted = common.mix(shingles + np.uint64(1 + salt) * _SEED)
    parts = np.array([np.bitwise_xor.reduce(salted), np.sum(common.mix(salted), dtype=np.uint64), len(shingles)], np.uint64)
    return int(common.mix(common.WORDS.windows(parts, np.array([0]), np.array([3]))).view(np.int64)[0])


def set_names(shingles: np.ndarray, shared: list[frozenset[int]], bits: int = 64) -> tuple[int, int]:
    """Two signed 64-bit names of a set: the first is its identity, the second finds out whether two sets share the first.

    shared: names that different sets have, then those that these sets have after another hash, and so on.
    """
    name = _name(shingles, 0) >> 64 - bits
    for level, known in enumerate(shared):
        if name in known:
            name = _name(shingles, 2 + level)
    return name, _name(shingles, 1)


def _sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return [common.shingle_set((t or "").encode(), n) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def members(docs: DataFrame, n: int, shared: list[frozenset[int]]) -> DataFrame:
    """row, doc_id, size, set_id (null: no shingles), its check and sketch of every row of (row, doc_id, text)."""
    name_bits = common.NAME_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for batch in batches:
            sets = _sets(batch, n)
            names = [set_names(s, shared, name_bits) if len(s) else (None, None) for s in sets]
            new = [pa.array([len(s) for s in sets], pa.int64()), *(pa.array([x[i] for x in names], pa.int64()) for i in (0, 1)), pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], names=["row", "doc_id", "size", "set_id", "check", "sketch"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, size long, set_id long, check long, sketch binary")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of at least two sets with one key, from rows sorted by key and set: (key, large, sets).

    A group of up to CELL sets is one row, and left out if the task has sent the same one for another key. A larger one
    comes in several rows with `large`, so a task never holds one whole.
    """

    def rows(starts: np.ndarray, ends: np.ndarray, large: bool) -> pa.RecordBatch:
        sizes = ends - starts
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(name[at]))
        return pa.RecordBatch.from_arrays([pa.array(key[starts]), pa.array(np.full(len(starts), large)), lists], names=["key", "large", "sets"])

    key, name = np.empty(0, np.int64), np.empty(0, np.int64)
    over = None  # (key, last set) of a large group of which rows have gone out already
    seen: set[tuple[int, int]] = set()
    for batch in _then_none(batches):
        if batch is not None:
            new_key, new_name = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            key, name = np.concatenate([key, new_key]), np.concatenate([name, new_name])
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])[: len(key)]
            if over and len(key):
                fresh[0] &= (int(key[0]), int(name[0])) != over
            key, name = key[fresh], name[fresh]
        if not len(key):
            continue
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts[1:], len(key))
        large = ends - starts > CELL
        if over:
            large[0] |= int(key[0]) == over[0]
        whole = np.ones(len(starts), bool)
        whole[-1] = batch is None or large[-1]  # the last group may go on in the next batch
        pick = whole & ~large & (ends - starts > 1)
        if pick.any():
            s, e = starts[pick], ends[pick]
            ids = list(zip(common.WORDS.windows(name.view(np.uint64), s, e).tolist(), name[s].tolist(), strict=True))
            first = np.array([x not in seen and not seen.add(x) for x in ids])
            if first.any():
                yield rows(s[first], e[first], False)
            if len(seen) > 1_000_000:
                seen.clear()
        if large.any():
            yield rows(starts[large], ends[large], True)
        over = (int(key[-1]), int(name[-1])) if large[-1] else None
        rest = starts[-1] if not whole[-1] else len(key)
        key, name = key[rest:], name[rest:]


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def shared_keys(docs: DataFrame, n: int, percent: int, shared: list[frozenset[int]]) -> DataFrame:
    """(key, large, sets): the sets that share a key; see _lists."""
    name_bits = common.NAME_BITS

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        join, seen = Join(percent), set()
        for batch in batches:
            keys, names = [], []
            for s in _sets(batch, n):
                if len(s) and (i := set_names(s, shared, name_bits)[0]) not in seen:  # a task sends a set's keys once
                    seen.add(i)
                    keys.append(join.keys(s))
                    names.append(np.full(len(keys[-1]), i))
            if len(seen) > 1_000_000:
                seen.clear()
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(names))], names=["key", "set_id"])

    rows = docs.select("text").mapInArrow(emit, "key long, set_id long")
    dealt = rows.repartition(common.shuffle_partitions(docs.sparkSession), "key").sortWithinPartitions("key", "set_id")
    return dealt.mapInArrow(_lists, "key long, large boolean, sets array<long>")


def forest(join: Join, group: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, label: np.ndarray, allowed: Callable, check: Callable | None = None) -> Iterator[tuple[int, int]]:
    """Edges (i, j) of a spanning forest over pairs of rows of one group that pass the bounds (and `check`).

    Rows of a group stand together. `label` holds what is joined already (equal numbers) and is kept up to date; pairs with
    equal labels aren't looked at. allowed(i, j) tells for arrays of rows which pairs are this task's.
    """
    joined = Forest()
    for step in range(1, len(group)):
        i = np.flatnonzero(group[step:] == group[:-step])
        if not len(i):
            return
        root = label if not joined.up else _roots(label, joined)
        i = i[root[i] != root[i + step]]
        i = i[allowed(i, i + step)]
        small, big = np.minimum(sizes[i], sizes[i + step]), np.maximum(sizes[i], sizes[i + step])
        i = i[small >= -(-big * join.percent // 100)]
        apart = np.bitwise_count(sketches[i] ^ sketches[i + step]).sum(1, dtype=np.int64)
        for x in i[apart <= join.most_apart(sizes[i], sizes[i + step])].tolist():
            a, b = int(label[x]), int(label[x + step])
            if joined.find(a) != joined.find(b) and (check is None or check(x, x + step)):
                joined.join(a, b)
                yield x, x + step


def _roots(label: np.ndarray, joined: Forest) -> np.ndarray:
    known = np.array(list(joined.up), np.int64)
    order = np.argsort(known)
    known = known[order]
    to = np.array([joined.find(x) for x in joined.up], np.int64)[order]
    at = np.searchsorted(known, label).clip(max=len(known) - 1)
    return np.where(known[at] == label, to[at], label)


def _by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups, of rows sorted by their first `keys` columns; a group that goes on waits for its end."""
    held: list[pa.RecordBatch] = []
    for batch in _then_none(batches):
        if batch is None:
            if held:
                yield pa.Table.from_batches(held).combine_chunks()
            return
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for c in range(keys):
            x = batch.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
            new[0] |= not held or held[-1].column(c)[-1].as_py() != x[0]
        at = np.flatnonzero(new)
        if len(at):
            cut = int(at[-1])
            if cut or held:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held, batch = [], batch.slice(cut)
        held.append(batch)


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _bounded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Edges of candidate groups from rows (list, set_id, size, sketch) sorted by list and size."""
    join, seen = Join(percent), set()
    for table in _by_group(batches, 1):
        group, name, size = (table.column(i).to_numpy() for i in range(3))
        bits = table.column("sketch").combine_chunks()
        bits = bits.chunk(0) if isinstance(bits, pa.ChunkedArray) else bits
        words = np.array(pa.compute.binary_length(bits).to_numpy(zero_copy_only=False)) // 8
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        least = np.repeat(np.minimum.reduceat(words, starts), np.diff(starts, append=len(group)))
        out = []
        for w in np.unique(least).tolist():  # groups whose shortest sketch is alike
            at = np.flatnonzero(least == w)
            sketches = np.empty((len(at), w), np.uint64)
            for v in np.unique(words[at]).tolist():
                mine = np.flatnonzero(words[at] == v)
                data = np.frombuffer(b"".join(bits.take(pa.array(at[mine])).to_pylist()), np.uint64).reshape(len(mine), v)
                sketches[mine] = fold(data, w)
            # one label a set and group, since a set may be in several groups
            for i, j in forest(join, group[at], size[at], sketches, np.arange(len(at)), lambda i, j: slice(None)):
                pair = (int(name[at[i]]), int(name[at[j]]))
                if pair not in seen:
                    seen.add(pair)
                    out.append(pair)
        if out:
            yield _edges(out)
        if len(seen) > 500_000:
            seen.clear()


def candidates(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): edges whose components hold all pairs of sets that share a key and pass the bounds of sizes and sketches.

    Of keys that more than CELL sets have, a set goes without if it has COMMON of them in a band at most: linked sets agree
    in more parts than that. Of the sets that keep such a key, those of a group of up to CELL are compared like others; all of
    a larger group are candidates of one another.
    """
    small = shared.where("not large").select("sets")
    wide = common.save(shared.where("large").select("key", F.explode("sets").alias("set_id")), "wide")
    in_band = wide.withColumn("band", F.col("key").bitwiseAND(F.lit(63)))
    needed = in_band.groupBy("set_id", "band").count().where(F.col("count") > COMMON).drop("count")
    kept = common.save(in_band.join(needed.hint("merge"), ["set_id", "band"], "left_semi").select("key", "set_id"), "kept", [wide])
    counts = common.save(kept.groupBy("key").agg(F.min("set_id").alias("least"), F.count("*").alias("n")), "counts")
    fits = kept.join(counts.where(f"n <= {CELL} and n > 1").select("key").hint("merge"), "key", "left_semi")
    lists = small.unionByName(fits.groupBy("key").agg(F.sort_array(F.collect_list("set_id")).alias("sets")).select("sets")).dropDuplicates(["sets"])
    lists = common.save(lists.withColumn("list", F.xxhash64("sets")), "lists")
    stars = common.join_groups(kept, counts.where(f"n > {CELL}"), "key", "n", F.xxhash64("set_id"))
    rows = lists.select("list", F.explode("sets").alias("set_id")).join(sets.select("set_id", "size", "sketch").hint("merge"), "set_id")
    rows = rows.select("list", "set_id", "size", "sketch").repartition(common.shuffle_partitions(shared.sparkSession), "list").sortWithinPartitions("list", "size", "set_id")
    near = rows.mapInArrow(lambda b: _bounded(b, percent), "a long, b long")
    return common.save(near.unionByName(stars.select(F.col("least").alias("a"), F.col("set_id").alias("b")).where("a != b")), "candidates", [kept, counts, lists])


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of rows (root, i, j, side, cluster, set_id, data) sorted by cell (root, i, j).

    Rows of side 0 meet one another and those of other sides; rows of one other side don't meet.
    """
    join = Join(percent)
    for table in _by_group(batches, 3):
        cells = np.stack([table.column(c).to_numpy() for c in range(3)])
        starts = np.flatnonzero(np.concatenate([[True], (cells[:, 1:] != cells[:, :-1]).any(0)]))
        columns = [table.column(c).to_numpy() for c in (3, 4, 5)]
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), cells.shape[1]], strict=True):
            side, cluster, name = (c[start:end] for c in columns)
            held = [np.frombuffer(x, np.uint64) for x in table.column("data").slice(start, end - start).to_pylist()]
            order = sorted(range(len(held)), key=lambda x: len(held[x]))
            side, cluster, name, held = side[order], cluster[order], name[order], [held[x] for x in order]
            size = np.array([len(s) for s in held])
            words = len(sketch(held[-1]))
            bits = np.array([sketch(s, words) for s in held])

            def check(x: int, y: int, held: list = held) -> bool:
                both = np.intersect1d(held[x], held[y], assume_unique=True)
                return join.linked(len(both), len(held[x]), len(held[y]))

            def allowed(i: np.ndarray, j: np.ndarray, side: np.ndarray = side) -> np.ndarray:
                return (side[i] == 0) | (side[i] != side[j])

            found = [(int(name[x]), int(name[y])) for x, y in forest(join, np.zeros(len(held), np.int8), size, bits, cluster.copy(), allowed, check)]
            if found:
                yield _edges(found)


def links(near: DataFrame, percent: int) -> DataFrame:
    """(a, b): edges with the same components as all exact links within each group of near (root, set_id, data).

    A group of up to CELL sets meets in one cell. A larger one is dealt by hash into blocks of half as many, and the sets of
    its first block are representatives: every other block meets them as well as its own sets. What that joins is a cluster;
    sets outside their group's largest cluster then meet the sets of all its blocks. Two sets of the largest cluster need not
    meet again, so the work is the square of the group's size only if its sets hardly link.
    """
    half = CELL // 2
    spark = near.sparkSession

    def meet(cells: DataFrame) -> DataFrame:
        rows = cells.select("root", "i", "j", "side", "cluster", "set_id", "data").repartition(common.shuffle_partitions(spark), "root", "i", "j").sortWithinPartitions("root", "i", "j")
        return rows.mapInArrow(lambda b: _verified(b, percent), "a long, b long")

    counts = near.groupBy("root").agg(F.count("*").alias("n")).withColumn("blocks", F.when(F.col("n") > CELL, F.ceil(F.col("n") / half)).otherwise(1).cast("int"))
    rows = common.save(common.join_groups(near, counts, "root", "n", F.col("set_id")).withColumn("block", F.pmod(F.xxhash64("set_id"), "blocks").cast("int")).drop("n"), "near")
    zero = F.lit(0)
    to = F.when(F.col("block") == 0, F.sequence(zero, F.col("blocks") - 1)).otherwise(F.array("block"))
    cells = rows.withColumns({"cluster": F.col("set_id"), "i": F.explode(to), "j": zero})
    # in a block other than the first, representatives don't meet one another again
    first = common.save(meet(cells.withColumn("side", F.when((F.col("block") == 0) & (F.col("i") > 0), 1).otherwise(0))), "links")
    wide = rows.where("blocks > 1")
    if wide.isEmpty():
        return first
    cluster = components(first).select(F.col("node").alias("set_id"), F.col("root").alias("cluster"))
    placed = wide.join(cluster.hint("merge"), "set_id", "left").withColumn("cluster", F.coalesce("cluster", "set_id"))
    placed = common.save(placed, "placed")
    sums = placed.groupBy("root", "cluster").agg(F.count("*").alias("c"))
    top = sums.groupBy("root").agg(F.max(F.struct("c", "cluster")).alias("m"), F.sum("c").alias("n")).select("root", "n", F.col("m.cluster").alias("top"), F.ceil((F.col("n") - F.col("m.c")) / half).cast("int").alias("outer"))
    marked = common.join_groups(placed, top.where("outer > 0"), "root", "n", F.col("set_id")).withColumn("out", F.col("cluster") != F.col("top"))
    mine = F.pmod(F.xxhash64("set_id", F.lit(1)), "outer").cast("int")
    # a set outside the largest cluster goes, as side 0, to the cells of its own outer block with every block, and all sets of
    # a block, as side 1, to its cells with every outer block
    outer = marked.where("out").withColumns({"side": zero, "j": mine, "i": F.explode(F.sequence(zero, F.col("blocks") - 1))})
    inner = marked.withColumns({"side": F.lit(1), "i": F.col("block"), "j": F.explode(F.sequence(zero, F.col("outer") - 1))})
    # a set that would meet itself, or one of its own outer block, stays on side 0 alone
    inner = inner.where(~(F.col("out") & (mine == F.col("j"))))
    inside = marked.where("out").withColumns({"side": zero, "j": mine, "i": F.lit(-1)})
    names = ["root", "i", "j", "side", "cluster", "set_id", "data"]
    second = meet(outer.select(names).unionByName(inner.select(names)).unionByName(inside.select(names)))
    return common.save(first.unionByName(second), "links", [placed])


def _classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """row, doc_id, n_shingles, component_id, first of each row key of docs (row, doc_id, text)."""
    twice: list[frozenset[int]] = []
    while True:
        held = common.save(members(docs, n, twice), "members")
        found = held.where("set_id is not null").groupBy("set_id").agg(
            F.min("size").alias("size"), F.min("sketch").alias("sketch"), F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "row")).alias("least"),
            F.min("row").alias("row"), F.count("*").alias("n"), (F.min("check") != F.max("check")).alias("mixed"))
        sets = common.save(found, "sets")
        # names shared by chance, some n**2 / 2**65 of n sets: only their sets are named anew
        mixed = frozenset(r["set_id"] for r in sets.where("mixed").select("set_id").collect())
        if not mixed:
            break
        twice.append(mixed)
        common.drop(held)
        common.drop(sets)
    shared = common.save(shared_keys(docs, n, percent, twice), "keys")
    edges = candidates(shared, sets, percent)
    common.drop(shared)
    near = components(edges).withColumnRenamed("node", "set_id").join(sets.select("set_id", "row").hint("merge"), "set_id")
    near = common.save(near, "groups", [edges])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in _sets(batch, n)], pa.binary())], names=["row", "data"])

    # a Bloom filter lets the texts of candidates through, and only their hashes are shuffled
    data = common.with_hits(docs.select("row", "text"), "row", near.select("row")).where("__hit").select("row", "text").mapInArrow(hashed, "row long, data binary")
    near = common.save(data.join(near.hint("merge"), "row").dropDuplicates(["set_id"]).select("root", "set_id", "data"), "candidate-sets", [near])
    found = links(near, percent)
    roots = common.save(components(found).withColumnRenamed("node", "set_id"), "roots", [near, found])
    named = sets.select("set_id", "least", "n").join(roots.hint("merge"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    tops = named.groupBy("root").agg(F.min("least").alias("top"), F.sum("n").alias("rows"))
    named = common.join_groups(named, tops, "root", "rows", F.col("set_id")).select("set_id", "n", "top")
    slim = held.select("row", "doc_id", "size", "set_id")
    about = common.join_groups(slim.where("set_id is not null"), common.save(named, "classes"), "set_id", "n", F.xxhash64("row"))
    about = about.select("row", "doc_id", "size", F.col("top.doc_id").alias("component_id"), (F.col("row") == F.col("top.row")).alias("first"))
    none = slim.where("set_id is null").select("row", "doc_id", "size", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    about = about.unionByName(none).withColumnRenamed("size", "n_shingles")
    return common.save(about, "members", [held, sets, roots])


def _keyed(docs: DataFrame) -> DataFrame:
    return common.with_row_key(docs, "__row")


def _slim(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def ngram_join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """docs with n_shingles and component_id: the smallest doc_id reachable by links.

    Words are runs of anything but ASCII white space after A-Z are lower-cased; a row's set holds its distinct n-word
    shingles, the whole sequence if it has fewer words. Null text and text without words have no shingles and link with
    nothing. Two rows link when 100 * |A & B| >= percent * |A | B|; no link is lost. Rows with a null doc_id take part and
    never give a component its id unless no other row is in it (then null). Rows that repeat link with one another. An
    empty table gives an empty table. Columns of these names in docs are replaced.
    """
    docs = docs.drop("n_shingles", "component_id")
    rows = _keyed(docs)
    about = _classes(_slim(rows), n, percent).select(F.col("row").alias("__row"), "n_shingles", "component_id").dropDuplicates(["__row"])
    return rows.join(about.hint("merge"), "__row").drop("__row")


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay if each group of linked rows keeps one: the one with the smallest doc_id.

    Rows with a null doc_id stay only in a group without others; of rows with the same doc_id, or null ones, one stays by a
    hash. Rows that repeat doc_id and text stay or go together. Rows without shingles stay. An empty table gives an empty
    table. All columns pass through. Only texts of rows that a Bloom filter takes for ones that go are shuffled.
    """
    rows = _keyed(docs)
    gone = _classes(_slim(rows), n, percent).where("not first").select(F.col("row").alias("__row"))
    flagged = common.with_hits(rows, "__row", gone)
    stay = flagged.where("__hit").join(gone.hint("merge"), "__row", "left_anti")
    return flagged.where("not __hit").unionByName(stay).select(*docs.columns)
