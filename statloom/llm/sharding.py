"""Sharding by extendible hashing, in DataFrame operations only.

A row's hash is the first 60 bits of an MD5 of its key. The directory starts with one bucket; a bucket above the byte limit
splits on the next bit of the prefix, and no other does. Sizes come from a histogram of prefixes, BITS deep, pre-aggregated
by task; what is still too large at its end is counted deeper, over those rows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm import common

#: Bits of prefix that one round counts, bits of the hash, and bytes that a shard may hold.
BITS, HASH_BITS, BYTE_LIMIT = 12, 60, 32 << 20
#: Cells beyond twice the buckets, and buckets that may be broadcast, when rows are dealt to buckets.
CELLS = 1 << 14
#: Overflow pages, and rows, that one task fills one after the other.
RUN_PAGES, RUN_ROWS = 16, 1_000_000


def prefix_hash(key: Column) -> Column:
    """60 bits of the MD5 of a key's text; null keys have the hash of an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(hash_: Column | str, depth: Column | int) -> Column:
    return F.expr(f"shiftright({hash_}, cast({HASH_BITS} - {depth} as int))")


def directory(cells: DataFrame, first: int, last: int, byte_limit: int) -> DataFrame:
    """Buckets (depth, prefix, bytes, rows) of cells (__hash cut to `last` bits, bytes, rows) between two depths.

    A bucket is the shallowest prefix whose bytes fit the limit, or one of `last` bits that doesn't. The directory has
    2**(last - first) cells for each bucket that was too large at `first`.
    """
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("prefix", _prefix("__hash", "depth"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    # a bucket exists if the one above it was too large (or there is none), and is final if it fits itself
    above = sums.where((F.col("bytes") > byte_limit) & (F.col("rows") > 1)).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("__up"))
    split = sums.withColumn("__up", F.shiftright("prefix", 1)).join(above.withColumn("__split", F.lit(True)), ["depth", "__up"], "left")
    fits = (F.col("bytes") <= byte_limit) | (F.col("rows") == 1) | (F.col("depth") == last)
    return split.where((F.col("__split") | (F.col("depth") == first)) & fits).select("depth", "prefix", "bytes", "rows")


def buckets(hashed: DataFrame, byte_limit: int, bits: int = BITS) -> DataFrame:
    """The whole directory of rows (__hash, __bytes): depth, prefix, bytes, rows."""
    found, left, first = None, hashed, 0
    while True:
        last = min(first + bits, HASH_BITS)
        low = F.expr(f"shiftleft(shiftright(__hash, {HASH_BITS - last}), {HASH_BITS - last})").alias("__hash")
        cells = left.groupBy(low).agg(F.sum("__bytes").alias("bytes"), F.count("*").alias("rows"))
        level = common.save(directory(cells, first, last, byte_limit), "directory")
        found = level if found is None else found.unionByName(level)
        over = level.where((F.col("depth") == last) & (F.col("bytes") > byte_limit) & (F.col("rows") > 1))
        if last == HASH_BITS or over.isEmpty():
            return found
        found = found.join(over.select("depth", "prefix"), ["depth", "prefix"], "left_anti")
        left = left.join(over.select(F.col("prefix").alias("__p")), _prefix("__hash", last) == F.col("__p"), "left_semi")
        first = last


def shard(docs: DataFrame, byte_limit: int = BYTE_LIMIT, key: str = "doc_id", bits: int = BITS, keep: bool = True) -> DataFrame:
    """docs with bytes, shard, shard_depth, shard_bytes, shard_rows.

    bytes is the UTF-8 length of text (null: 0). shard names the bucket by its hash prefix in bits (empty: one shard holds
    all). Every shard fits byte_limit, except that a row above it has a shard of its own. Rows that repeat one key, which no
    bit can part, go to overflow pages of their bucket, each within the limit: "+run.page", or "+run.page!" for a row of
    more than half the limit, which has a page of its own. Runs are filled side by side, however many rows repeat a key.
    Columns of these names in docs are replaced; other columns pass through if keep is true, else only the key. An empty
    table gives an empty table.
    """
    docs = docs.drop("bytes", "shard", "shard_depth", "shard_bytes", "shard_rows")
    docs = docs.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    docs = docs if keep else docs.select(key, "bytes")
    rows = docs.withColumn("__hash", prefix_hash(F.col(key)))
    slim = common.save(rows.select("__hash", F.col("bytes").alias("__bytes")) if keep else rows, "hashes")
    rows = rows if keep else slim
    found = common.save(buckets(slim if keep else slim.select("__hash", F.col("bytes").alias("__bytes")), byte_limit, bits), "directory")
    named = found.select("depth", "prefix", F.expr("if(depth = 0, '', lpad(bin(prefix), depth, '0'))").alias("shard"), F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows"))
    counts = {r["depth"]: r["n"] for r in found.groupBy("depth").agg(F.count("*").alias("n")).collect()}  # HASH_BITS + 1 at most
    out = _leaf_join(rows, named, counts)
    over = (F.col("shard_bytes") > byte_limit) & (F.col("shard_rows") > 1)
    if found.where((F.col("bytes") > byte_limit) & (F.col("rows") > 1)).isEmpty():
        return out
    runs = F.ceil(F.greatest(F.col("shard_bytes") / (RUN_PAGES * byte_limit), F.col("shard_rows") / RUN_ROWS))
    paged = common.save(out.where(over).withColumn("__run", F.pmod(F.monotonically_increasing_id(), runs)), "pages")
    half = max(1, byte_limit // 2)
    alone = F.col("bytes") > half
    order = Window.partitionBy("shard", "__run", alone).orderBy("bytes", key)
    # small rows that start in one half of the limit end within the whole of it
    upto = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    page = F.when(alone, F.concat(F.row_number().over(order).cast("string"), F.lit("!"))).otherwise(F.expr("string(__upto div %d)" % half))
    paged = paged.withColumn("__upto", upto).withColumn("shard", F.concat("shard", F.lit("+"), F.col("__run").cast("string"), F.lit("."), page)).drop("__upto", "__run")
    sums = paged.groupBy("shard").agg(F.sum("bytes").alias("__b"), F.count("*").alias("__n"))
    paged = paged.join(sums, "shard").withColumn("shard_bytes", F.col("__b")).withColumn("shard_rows", F.col("__n")).select(*out.columns)
    return out.where(~over).unionByName(paged)


def _cell_depth(counts: dict[int, int]) -> int:
    """The deepest level at which the buckets, counted by depth, stand in few more cells than there are buckets."""
    cells = lambda c: sum(n << max(c - d, 0) for d, n in counts.items())
    return max((c for c in range(min(counts, default=0), max(counts, default=0) + 1) if cells(c) <= 2 * sum(counts.values()) + CELLS), default=0)


def _leaf_join(rows: DataFrame, buckets_: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Rows with their bucket: one equality join, by cells of one level. A bucket above it lists its cells, one below it stands in
    the cell that holds it, and a row of such a cell takes the bucket whose prefix it has. counts: buckets by depth."""
    c = _cell_depth(counts)
    cells = F.expr(f"if(depth <= {c}, sequence(shiftleft(prefix, greatest({c} - depth, 0)), shiftleft(prefix + 1, greatest({c} - depth, 0)) - 1), array(shiftright(prefix, greatest(depth - {c}, 0))))")
    leaves = buckets_.withColumn("__cell", F.explode(cells)).withColumnRenamed("depth", "shard_depth")
    leaves = leaves.hint("merge") if sum(counts.values()) > CELLS else leaves
    out = rows.withColumn("__cell", _prefix("__hash", c)).join(leaves, "__cell").where(_prefix("__hash", "shard_depth") == F.col("prefix"))
    return out.drop("__cell", "__hash", "prefix").select(*[x for x in rows.columns if x != "__hash"], "shard", "shard_depth", "shard_bytes", "shard_rows")
