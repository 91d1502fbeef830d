"""Snapshot difference with rekeying: DuckDB joins the rows of a key inside Arrow batches, then pairs what is left by content."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from statloom.llm import common

#: Rows that DuckDB joins at once: a task's memory doesn't grow with its partition.
CHUNK = 50_000
#: Rows of 80 bytes or so a partition that Spark's range shuffle samples for its borders; it takes a million of them at most.
SAMPLES = 20
OLD, NEW = 0, 1
PAIR, ALONE, OPEN = 0, 1, 2


def _sha(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def digests(rows: DataFrame, side: int, key: str, columns: list[str]) -> DataFrame:
    """(side, key, d0, d1, ..., row, content, u): a SHA-256 of each column as text (null stays null), one of the whole row with
    nulls as ~, one of the columns' digests, and a number that tells rows apart."""
    cells = [F.col(f"`{c}`").cast("string") for c in columns]
    whole = F.concat_ws("\n", *[F.coalesce(c, F.lit("~")) for c in cells])
    out = rows.select(F.lit(side).alias("side"), F.col(f"`{key}`").alias("key"), *[_sha(c).alias(f"d{i}") for i, c in enumerate(cells)], _sha(whole).alias("row"))
    content = _sha(F.concat_ws(",", *[F.coalesce(F.lower(F.hex(f"d{i}")), F.lit("~")) for i in range(len(columns))]))
    return out.withColumn("content", content).withColumn("u", F.monotonically_increasing_id())


def _sql(group: list[str], order: str, columns: list[str]) -> str:
    """Pairs the i-th earlier with the i-th later row of each group of the table `chunk`; others come out alone."""
    kinds = [f"d{i}" for i in range(len(columns))]
    changed = ", ".join(f"CASE WHEN o.{d} IS DISTINCT FROM n.{d} THEN '{c.replace(chr(39), 2 * chr(39))}' END" for d, c in zip(kinds, columns, strict=True))
    same = " AND ".join(f"o.{g} IS NOT DISTINCT FROM n.{g}" for g in group)
    alone = ", ".join(f"coalesce(o.{d}, n.{d}) AS {d}" for d in kinds)
    return f"""
        WITH r AS (
            SELECT *, row_number() OVER (PARTITION BY side, gid, {", ".join(group)} ORDER BY {order} NULLS FIRST, u) AS i FROM chunk)
        SELECT CASE WHEN o.side IS NULL OR n.side IS NULL THEN {ALONE} ELSE {PAIR} END AS kind,
               CASE WHEN o.side IS NULL THEN {NEW} ELSE {OLD} END AS side, o.key AS old_key, n.key AS new_key,
               CASE WHEN o.side IS NULL OR n.side IS NULL THEN '' ELSE concat_ws(',', {changed}) END AS changed, {alone},
               coalesce(n.row, o.row) AS row, coalesce(n.content, o.content) AS content, NULL::BLOB AS gid, NULL::INTEGER AS pid, NULL::BIGINT AS i
        FROM (FROM r WHERE side = {OLD}) o FULL OUTER JOIN (FROM r WHERE side = {NEW}) n ON o.gid = n.gid AND {same} AND o.i = n.i"""


def _joined(batches: Iterator[pa.RecordBatch], sql: str, out: pa.Schema, chunk_rows: int) -> Iterator[pa.RecordBatch]:
    """The pairs of a partition's whole groups; rows of groups that may go on in another partition, or are longer than a
    chunk, stay open: with their place among the group's rows of their side here."""
    pid = TaskContext.get().partitionId()
    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
    first, now, seen = None, None, [0, 0]

    def still_open(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows of one group."""
        nonlocal now
        if (gid := rows.column("gid")[0].as_py()) != now:
            now, seen[:] = gid, [0, 0]
        later = rows.column("side").to_numpy() == NEW
        place = np.where(later, np.cumsum(later) + seen[NEW], np.cumsum(~later) + seen[OLD])
        seen[OLD] += int((~later).sum())
        seen[NEW] += int(later.sum())
        n, old = len(rows), pa.array(~later)
        keys = rows.column("key").combine_chunks()
        none = pa.nulls(n, keys.type)
        cols = {"kind": pa.array([OPEN] * n, pa.int32()), "side": rows.column("side"), "old_key": pa.compute.if_else(old, keys, none), "new_key": pa.compute.if_else(old, none, keys), "changed": pa.array([""] * n), "pid": pa.array([pid] * n, pa.int32()), "i": pa.array(place, pa.int64())}
        yield from pa.table([cols.get(c, rows.column(c) if c in rows.column_names else None) for c in out.names], schema=out).to_batches()

    def whole(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        con.register("chunk", rows)
        yield from con.sql(sql).to_arrow_table().select(out.names).cast(out).to_batches()
        con.unregister("chunk")

    def parts(rows: pa.Table, last: bool) -> Iterator[tuple[pa.Table, bool]]:
        """Cuts at the borders of the first and of the last group."""
        gids = rows.column("gid").combine_chunks()
        edge = pa.compute.index(pa.compute.not_equal(gids, gids[0]), True).as_py() if gids[0].as_py() in (first, now) else 0
        if edge < 0:
            yield rows, True
            return
        if edge:
            yield rows.slice(0, edge), True
        end = edge + pa.compute.index(pa.compute.equal(gids.slice(edge), gids[-1]), True).as_py()
        if end > edge:
            yield rows.slice(edge, end - edge), False
        yield rows.slice(end), last

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if first is None:
            first = batch.column("gid")[0].as_py()
        held.append(batch)
        if sum(b.num_rows for b in held) < chunk_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        held = []
        for rows, opened in parts(table, False):
            if opened:
                yield from still_open(rows)
            elif rows.column("gid")[0].equals(table.column("gid")[-1]):
                if len(rows) >= chunk_rows:  # longer than a chunk: the rest of the group follows it
                    yield from still_open(rows)
                else:
                    held = rows.to_batches()
            else:
                yield from whole(rows)
    if held:
        for rows, opened in parts(pa.Table.from_batches(held).combine_chunks(), True):
            yield from still_open(rows) if opened else whole(rows)


def _pair(rows: DataFrame, gid: Column, group: list[str], order: str, columns: list[str], name: str, chunk_rows: int) -> DataFrame:
    """(kind, side, old_key, new_key, changed, d0, ..., row, content): of each group the i-th earlier row with the i-th later one."""
    spark, kinds = rows.sparkSession, [f"d{i}" for i in range(len(columns))]
    # nulls go first in Spark's order, and in DuckDB's by NULLS FIRST; u parts rows that repeat everything
    placed = rows.withColumn("gid", gid).withColumn("g", F.xxhash64("gid"))
    placed = placed.repartitionByRange(common.shuffle_partitions(spark), "g", order, "u").sortWithinPartitions("g", "gid", order, "u").drop("g")
    kind, key = rows.schema["key"].dataType.simpleString(), to_arrow_type(rows.schema["key"].dataType)
    text = ", ".join(["kind int", "side int", f"old_key {kind}", f"new_key {kind}", "changed string", *[f"{d} binary" for d in kinds], "row binary", "content binary", "gid binary", "pid int", "i long"])
    arrow = pa.schema([("kind", pa.int32()), ("side", pa.int32()), ("old_key", key), ("new_key", key), ("changed", pa.string()), *[(d, pa.binary()) for d in (*kinds, "row", "content", "gid")], ("pid", pa.int32()), ("i", pa.int64())])
    sql = _sql(group, order, columns)
    samples = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(samples)
    spark.conf.set(samples, SAMPLES)
    try:
        out = common.save(placed.mapInArrow(lambda b: _joined(b, sql, arrow, chunk_rows), text), name)
    finally:
        spark.conf.set(samples, before)
    names = ["kind", "side", "old_key", "new_key", "changed", *kinds, "row", "content"]
    return out.where(f"kind <> {OPEN}").select(names).unionByName(_resolve(out.where(f"kind = {OPEN}"), group, kinds, columns).select(names))


def _resolve(rows: DataFrame, group: list[str], kinds: list[str], columns: list[str]) -> DataFrame:
    """Pairs of open rows: a row's place in its group is that in its partition after all earlier partitions' rows."""
    count = rows.groupBy("gid", "side", "pid").agg(F.count(F.lit(1)).alias("__n"))
    before = count.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy("gid", "side").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    own = rows.withColumn("key", F.when(F.col("side") == OLD, F.col("old_key")).otherwise(F.col("new_key")))
    placed = own.join(before.hint("merge"), ["gid", "side", "pid"]).withColumn("i", F.col("i") + F.col("__before"))
    same = [F.coalesce(F.hex(g) if g in kinds else F.hex(F.col(g).cast("string")), F.lit("~")).alias(f"__g{k}") for k, g in enumerate(group)]
    cell = F.struct("key", *kinds, "row", "content")
    pairs = placed.groupBy("gid", "i", *same).agg(*[F.first(F.when(F.col("side") == s, cell), ignorenulls=True).alias(n) for s, n in ((OLD, "o"), (NEW, "n"))])
    both = F.col("o").isNotNull() & F.col("n").isNotNull()
    changed = F.concat_ws(",", *[F.when(~F.col(f"o.{d}").eqNullSafe(F.col(f"n.{d}")), F.lit(c)) for d, c in zip(kinds, columns, strict=True)])
    return pairs.select(F.when(both, PAIR).otherwise(ALONE).alias("kind"), F.when(F.col("o").isNull(), NEW).otherwise(OLD).alias("side"), F.col("o.key").alias("old_key"), F.col("n.key").alias("new_key"), F.when(both, changed).otherwise("").alias("changed"), *[F.coalesce(f"o.{d}", f"n.{d}").alias(d) for d in kinds], F.coalesce("n.row", "o.row").alias("row"), F.coalesce("n.content", "o.content").alias("content"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str], chunk_rows: int = CHUNK) -> DataFrame:
    """Pairs and unpaired rows of two snapshots: key (later, else earlier), old_key, op, changed, row_sha256.

    Rows of equal keys pair: op is same, or update with the differing `columns`, in their order, in `changed`. Among rows that
    are left, of equal content in all `columns` the i-th smallest earlier key pairs with the i-th smallest later key: rekey.
    The rest are insert (old_key null) and delete (row_sha256 null). A null equals only a null, in keys too: null keys pair, and
    are the smallest. Where a key repeats in a snapshot, its i-th row in the order of `content`, a digest of its columns' digests,
    pairs with the other snapshot's i-th, so rows that repeat pair one by one. Empty texts are texts; texts of any length are
    compared by SHA-256. Either snapshot, or both, may be empty. Columns beyond key and `columns` are ignored, whatever
    their names; the key may be of any type that Spark orders, the same in both.

    Two shuffles of digests, never of texts: by the key's hash, then, for unpaired rows, by the content's. Both are by ranges of
    (hash, order), so a key or a content that a third of the rows share is dealt over many tasks: a task joins the groups
    that are whole within it in DuckDB, at most `chunk_rows` (and a batch's) rows at once, and leaves open those at its
    edges, whose places are counted up over the partitions. Nothing goes to the driver or into a broadcast but
    Spark's own sample of (hash, order) for the ranges' borders, SAMPLES a partition and a million at most.
    """
    spark = old.sparkSession
    common.prepare(spark)
    rows = common.save(reduce(DataFrame.unionByName, [digests(old, OLD, key, columns), digests(new, NEW, key, columns)]), "snapshots")
    kinds = [f"d{i}" for i in range(len(columns))]
    keyed = _pair(rows, _sha(F.coalesce(F.concat(F.lit("="), F.col("key").cast("string")), F.lit("~"))), ["key"], "content", columns, "by-key", chunk_rows)
    left = keyed.where(f"kind = {ALONE}").select("side", F.coalesce("old_key", "new_key").alias("key"), *kinds, "row", "content")
    left = common.save(left.withColumn("u", F.monotonically_increasing_id()), "unpaired", [rows])
    moved = _pair(left, F.col("content"), kinds, "key", columns, "by-content", chunk_rows)
    hex_row = F.lower(F.hex("row")).alias("row_sha256")
    pairs = keyed.where(f"kind = {PAIR}").select(F.col("new_key").alias("key"), "old_key", F.when(F.col("changed") == "", "same").otherwise("update").alias("op"), "changed", hex_row)
    op = F.when(F.col("kind") == PAIR, "rekey").when(F.col("side") == NEW, "insert").otherwise("delete")
    later = F.when((F.col("kind") == PAIR) | (F.col("side") == NEW), F.col("new_key")).otherwise(F.col("old_key"))
    rest = moved.select(later.alias("key"), "old_key", op.alias("op"), F.lit("").alias("changed"), F.when(op != "delete", hex_row).alias("row_sha256"))
    return pairs.unionByName(rest)
