"""Order MinHash fingerprints of whole texts, in DataFrame operations only.

A text's k-mers are runs of K words, numbered by occurrence, so that repeats count. Each of TUPLES tuples orders them by a hash
function of its own and selects the LENGTH least; these keep the order in which they stand in the text, and the tuple is hashed. Two texts agree in a tuple only if they share the k-mers and their order, so the share of tuples in
which they agree follows their edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm import common

K, TUPLES, LENGTH = 2, 32, 2
#: Low bits of a packed minimum that hold the k-mer's place; the high ones hold its hash.
PLACE = 30


class _Ranges:
    """Ranges of doc_ids between sorted cuts, as a small table that rows join: null ids are range 0, others 1 and up.

    Ids fall by their high bits into cells, some four for a cut; a cell's row has the number of cuts before it and those in
    it. The table's size follows the number of partitions, not of rows, and no plan holds the cuts.
    """

    def __init__(self, spark: SparkSession, cuts: list[int]) -> None:
        self.low, self.high, self.shift = (cuts[0], cuts[-1], 0) if cuts else (0, 0, 0)
        while (self.high >> self.shift) - (self.low >> self.shift) > 4 * len(cuts):
            self.shift += 1
        cells: dict[int, list[int]] = {c: [] for c in range(self.low >> self.shift, (self.high >> self.shift) + 1)}
        for x in cuts:
            cells[x >> self.shift].append(x)
        rows, before = [], 0
        for c, inside in cells.items():
            rows.append((c, before, inside))
            before += len(inside)
        self.table = spark.createDataFrame(rows, "__cell long, __before int, __cuts array<long>")

    def of(self, rows: DataFrame) -> DataFrame:
        """rows with __b, the range of their doc_id."""
        cell = F.greatest(F.lit(self.low >> self.shift), F.least(F.lit(self.high >> self.shift), F.shiftright("doc_id", self.shift)))
        joined = rows.withColumn("__cell", cell).join(F.broadcast(self.table), "__cell", "left")  # four rows a cut at most
        inside = F.expr("1 + __before + size(filter(__cuts, x -> x < doc_id))")
        return joined.withColumn("__b", F.when(F.col("doc_id").isNull(), 0).otherwise(inside)).drop("__cell", "__before", "__cuts")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (__b, __r, __ghost, doc_id, text, next_text): each text with that of the next row in descending doc_id.

    The row after the last is the first. Rows are dealt out in ranges of doc_id; the head of a range also stands, as a
    ghost, at the end of the range before it, so no row looks outside its own range. (__b, __r) is a row's key and a row's
    next one is (__b, __r + 1). Null doc_ids come last; rows that repeat a doc_id are ordered by text.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    parts = 8 * common.shuffle_partitions(spark)
    shares = F.array(*[F.lit((i + 1) / 64) for i in range(63)])
    # quantiles of quantiles: 63 cuts, and as many more inside each range as partitions call for
    coarse = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 100_000).alias("c")).first()["c"] or []))
    cuts = coarse
    if parts > 64:
        fine = -(-parts // 64)
        inner = F.array(*[F.lit((i + 1) / fine) for i in range(fine - 1)])
        found = _Ranges(spark, coarse).of(ids).groupBy("__b").agg(F.percentile_approx("doc_id", inner, 10_000).alias("c")).collect()  # a row a range
        cuts = sorted({*coarse, *(x for r in found for x in r["c"] or [])})
    ranges = _Ranges(spark, cuts)
    heads = {r["__b"]: r["h"] for r in ranges.of(ids).groupBy("__b").agg(F.max("doc_id").alias("h")).collect()}  # a row a range
    held = sorted(heads)
    # the range whose end the head of a range stands at
    after = spark.createDataFrame([(heads[b], held[(i + 1) % len(held)]) for i, b in enumerate(held)], "__head long, __there int")
    own = F.struct(F.col("__b").alias("b"), F.lit(False).alias("g"))
    ghost = F.struct(F.col("__there").alias("b"), F.lit(True).alias("g"))
    dealt = ranges.of(docs).join(F.broadcast(after), F.col("doc_id").eqNullSafe(F.col("__head")), "left").withColumn("__at", F.explode(F.array(own, ghost))).where("__at.b is not null")
    dealt = dealt.select(F.col("__at.b").alias("__b"), F.col("__at.g").alias("__ghost"), "doc_id", "text")
    # more partitions than other shuffles: a text's k-mers take some twenty times its room
    dealt = dealt.repartition(4 * common.shuffle_partitions(spark), "__b")
    window = Window.partitionBy("__b").orderBy("__ghost", F.desc_nulls_last("doc_id"), "text")
    return dealt.withColumn("__r", F.row_number().over(window)).withColumn("next_text", F.coalesce(F.lead("text").over(window), F.lit("")))


def edited() -> Column:
    """The text whose last third of code points gives way to as many of the next text's first ones (or all it has)."""
    return F.expr("concat(substring(text, 1, length(text) - length(text) div 3), substring(next_text, 1, cast(length(text) div 3 as int)))")


def _packed(j: int) -> Column:
    """A k-mer under the order of tuple j: the high bits of its hash, then its place."""
    return F.xxhash64("__x", F.lit(j)).bitwiseAND(F.lit(-(1 << PLACE))).bitwiseOR(F.col("__pos").cast("long")).alias(f"__p{j}")


def _tuple(j: int) -> Column:
    """Hash of tuple j: its k-mers' hashes in the order of their places."""
    picked = [F.col(f"__m{j}_{i}") for i in range(LENGTH)]
    ordered = F.sort_array(F.array(*[F.struct(p.bitwiseAND(F.lit((1 << PLACE) - 1)).alias("at"), F.shiftright(p, PLACE).alias("hash")) for p in picked]))
    return F.xxhash64(ordered.getField("hash"))


def signatures(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys and __sig, TUPLES longs, of rows (keys, __text); a text without words has no row.

    Rows must be told apart by their keys. If they are dealt out by a key already, nothing is shuffled.
    """
    words = texts.select(*keys, F.regexp_extract_all("__text", F.lit(f"({common.WORD})"), F.lit(1)).alias("w"))
    grams = F.arrays_zip(*[(F.col("w") if i == 0 else F.slice("w", i + 1, F.size("w"))).alias(f"w{i}") for i in range(K)])
    rows = words.select(*keys, F.size("w").alias("n"), F.posexplode(grams).alias("__pos", "g")).where(f"__pos <= greatest(n - {K}, 0)")
    rows = rows.select(*keys, F.xxhash64(*[f"g.w{i}" for i in range(K)]).alias("__h"), "__pos")
    rows = rows.withColumn("__x", F.xxhash64("__h", F.row_number().over(Window.partitionBy(*keys, "__h").orderBy("__pos"))))
    rows = rows.select(*keys, *[_packed(j) for j in range(TUPLES)])
    # the least k-mer of each order, then the least above it: the rows of a text stand together, so nothing is shuffled or sorted
    text = Window.partitionBy(*keys)
    for i in range(LENGTH - 1):
        above = [F.col(f"__p{j}") if i == 0 else F.when(F.col(f"__p{j}") > F.col(f"__m{j}_{i - 1}"), F.col(f"__p{j}")) for j in range(TUPLES)]
        rows = rows.select("*", *[F.min(x).over(text).alias(f"__m{j}_{i}") for j, x in enumerate(above)])
    last = LENGTH - 1
    least = [F.min(f"__m{j}_{i}").alias(f"__m{j}_{i}") for j in range(TUPLES) for i in range(last)]
    top = [F.min(F.when(F.col(f"__p{j}") > F.col(f"__m{j}_{last - 1}"), F.col(f"__p{j}")) if last else F.col(f"__p{j}")).alias(f"__m{j}_{last}") for j in range(TUPLES)]
    found = rows.groupBy(*keys).agg(*least, *top)
    return found.select(*keys, F.array(*[_tuple(j) for j in range(TUPLES)]).alias("__sig"))


def likeness(a: str, b: str) -> Column:
    """Share of tuples in which two signatures agree; two texts without words agree in all."""
    return F.expr(f"size(filter(zip_with({a}, {b}, (x, y) -> x = y), e -> e)) / {float(TUPLES)}D")


def printed(sig: str) -> Column:
    return F.expr(f"array_join(transform({sig}, x -> lpad(hex(x & 4294967295L), 8, '0')), '')")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    See edited() and with_next() for the edited text and the next row. Null text counts as empty; texts without words
    share one fingerprint. Equal texts have equal fingerprints. A single row is its own next one. An empty table gives an
    empty table. Other columns of docs aren't looked at.
    """
    rows = with_next(docs)
    texts = rows.select("__b", "__r", F.explode(F.when(F.col("__ghost"), F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")))).otherwise(F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")), F.struct(F.lit(1).alias("k"), edited().alias("t"))))).alias("e"))
    sigs = signatures(texts.select("__b", "__r", F.col("e.k").alias("__k"), F.col("e.t").alias("__text")), ["__b", "__r", "__k"])
    both = sigs.groupBy("__b", "__r").agg(*[F.max(F.when(F.col("__k") == k, F.col("__sig"))).alias(n) for k, n in enumerate(("__own", "__edited"))])
    about = rows.select("__b", "__r", "__ghost", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(edited(), 256).alias("edited_sha256"))
    none = F.array_repeat(F.lit(0).cast("long"), TUPLES)
    out = about.join(both, ["__b", "__r"], "left").withColumns({n: F.coalesce(F.col(n), none) for n in ("__own", "__edited")})
    out = out.withColumn("__next", F.lead("__own").over(Window.partitionBy("__b").orderBy("__r"))).where("not __ghost")
    return out.select("doc_id", "n_chars", "edited_sha256", printed("__own").alias("fingerprint"), printed("__edited").alias("edited_fingerprint"), likeness("__own", "__edited").alias("near_edited"), likeness("__own", "__next").alias("near_next"))
