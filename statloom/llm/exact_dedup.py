"""Exact deduplication on a cuckoo-filter index of live digests.

Each task first indexes the digests of its own rows, so a text with any number of copies leaves a task as one row; the
partial groups are then dealt out into bins of digests and a second index for each bin merges them. The filter's tags decide
whether a digest may be live; a hit is verified against the content kept in the tag's own bucket (SHA-256 and byte length of
the whole text). When a row with a larger doc_id takes over a group, the old live entry is deleted and the new one inserted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm import common

_SPREAD = 0x9E3779B1
#: Partial groups in a bin of digests on average, which one index holds at once.
BIN_GROUPS = 50_000
_FIELDS = ("digest", "keep_id", "group_size", "tops")
_GROUPS = "digest binary, keep_id long, group_size long, tops long"


class DigestIndex:
    """Live digests in a partial-key cuckoo filter: insert, delete, find.

    A bucket has SLOTS slots; a slot is a 16-bit tag and, beside it, its content: [digest, live doc_id, rows of the group,
    rows that have the live doc_id]. Tags alone decide where to look, and content moves with its tag. An overflow rebuilds the
    index at twice the size from the stored digests.
    """

    SLOTS, KICKS = 4, 64

    def __init__(self, capacity: int = 1024) -> None:
        self.live = 0
        self._clear(max(4, (capacity * 5 // (4 * self.SLOTS)).bit_length()))

    def _clear(self, bits: int) -> None:
        self.bits, self.mask = bits, (1 << bits) - 1
        self.tags: list[list[int]] = [[] for _ in range(1 << bits)]
        self.content: list[list[list]] = [[] for _ in range(1 << bits)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """(tag, bucket, other bucket): the other bucket of a tag is told by the bucket that it is in and the tag alone."""
        key = int.from_bytes(digest[:8], "big")
        tag, at = key >> 48 & 0xFFFF, key & self.mask
        return tag, at, self._other(at, tag)

    def _other(self, at: int, tag: int) -> int:
        return (at ^ (tag + 1) * _SPREAD) & self.mask

    def __iter__(self) -> Iterator[list]:
        for bucket in self.content:
            yield from bucket

    def _slot(self, digest: bytes) -> tuple[int, int] | None:
        """Bucket and slot of a live digest: only content whose tag agrees is compared."""
        tag, *both = self._places(digest)
        for at in both:
            tags = self.tags[at]
            if tag in tags:
                for i, t in enumerate(tags):
                    if t == tag and self.content[at][i][0] == digest:
                        return at, i
        return None

    def find(self, digest: bytes) -> list | None:
        """A live digest's content."""
        found = self._slot(digest)
        return self.content[found[0]][found[1]] if found else None

    def _put(self, entry: list) -> list | None:
        """None, or the content that found no room in the end."""
        tag, a, b = self._places(entry[0])
        for at in (a, b):
            if len(self.tags[at]) < self.SLOTS:
                self.tags[at].append(tag)
                self.content[at].append(entry)
                return None
        at = a if tag & 2 else b
        for kick in range(self.KICKS):
            slot = (kick + tag) % self.SLOTS
            self.tags[at][slot], tag = tag, self.tags[at][slot]
            self.content[at][slot], entry = entry, self.content[at][slot]
            at = self._other(at, tag)
            if len(self.tags[at]) < self.SLOTS:
                self.tags[at].append(tag)
                self.content[at].append(entry)
                return None
        return entry

    def insert(self, digest: bytes, doc_id: int | None, size: int = 1, tops: int = 1) -> None:
        """A digest that isn't live."""
        self.live += 1
        homeless = self._put([digest, doc_id, size, tops])
        while homeless is not None:
            stored, bits = [*self, homeless], self.bits
            while homeless is not None:
                bits += 1
                self._clear(bits)
                homeless = next((x for x in map(self._put, stored) if x is not None), None)

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out; False if it isn't held."""
        found = self._slot(digest)
        if found is None:
            return False
        at, i = found
        del self.tags[at][i], self.content[at][i]
        self.live -= 1
        return True

    def add(self, digest: bytes, doc_id: int | None, size: int = 1, tops: int = 1) -> None:
        """Count a group of `size` equal rows, `tops` of which have its largest doc_id; a null doc_id is below all."""
        held = self.find(digest)
        if held is None:
            self.insert(digest, doc_id, size, tops)
        elif doc_id == held[1]:
            held[2] += size
            held[3] += tops
        elif doc_id is not None and (held[1] is None or doc_id > held[1]):
            self.delete(digest)
            self.insert(digest, doc_id, held[2] + size, tops)
        else:
            held[2] += size


def _batch(index: DigestIndex) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*index, strict=True), kinds, strict=True)], names=list(_FIELDS))


def _partial(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Partial groups of the rows seen, at most `most` and a batch's of them held at once."""
    index = DigestIndex()
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            index.add(*row)
        if index.live >= most:
            yield _batch(index)
            index = DigestIndex()
    if index.live:
        yield _batch(index)


def _by_bin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of rows that come bin by bin; one bin's index is held at a time."""
    index, now = DigestIndex(), None
    for batch in batches:
        for bin_, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bin_ != now:
                if index.live:
                    yield _batch(index)
                index, now = DigestIndex(), bin_
            index.add(*row)
    if index.live:
        yield _batch(index)


def digest(text: Column) -> Column:
    """Key of a whole text: SHA-256 of its UTF-8 bytes and their number; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(F.unhex(F.sha2(text, 256)), F.unhex(F.lpad(F.hex(F.octet_length(text)), 16, "0")))


def groups(keyed: DataFrame, most: int = 200_000, bin_groups: int = BIN_GROUPS) -> DataFrame:
    """One row for each distinct digest of `keyed` (doc_id, digest): keep_id, group_size and tops, the rows with keep_id.

    A task holds about `most` digests before it passes its partial groups on. They are counted and dealt by a hash into bins
    of about `bin_groups`; a task merges one bin after the other.
    """
    one = F.lit(1).cast("long")
    partial = keyed.select("digest", F.col("doc_id").cast("long").alias("doc_id"), one.alias("n"), one.alias("t")).mapInArrow(lambda b: _partial(b, most), _GROUPS)
    partial = common.save(partial, "partial")
    bins = max(1, common.shuffle_partitions(keyed.sparkSession), -(-partial.count() // bin_groups))
    binned = partial.select(F.pmod(F.xxhash64("digest"), F.lit(bins)).alias("bin"), *_FIELDS)
    dealt = binned.repartition(common.shuffle_partitions(keyed.sparkSession), "bin").sortWithinPartitions("bin")
    return common.save(dealt.mapInArrow(_by_bin, _GROUPS), "groups", [partial])


def exact_dedup(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Every row of docs with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical without any change; a null text counts as empty. Of equal texts the row with the largest
    doc_id stays; a null doc_id is smaller than any other, and of rows that repeat the doc_id that stays one stays (the
    others have kept false). Columns of these four names in docs are replaced; other columns pass through if keep_text is
    true, else only doc_id. An empty table gives an empty table.

    Only rows of texts that stand more than once are shuffled: a Bloom filter of bounded size tells the others, most rows,
    where they stand.
    """
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    keyed = (docs if keep_text else docs.select("doc_id", "text")).withColumn("__digest", digest(F.col("text")))
    slim = common.save(keyed.select("doc_id", F.col("__digest").alias("digest")), "digests")
    found = groups(slim)
    if not keep_text:
        keyed = slim.withColumnRenamed("digest", "__digest")
    many = found.where("group_size > 1").select(F.xxhash64("digest"))
    flagged = common.with_hits(keyed.withColumn("__key", F.xxhash64("__digest")), "__key", many).drop("__key")
    alone = flagged.where("not __hit").drop("__hit").withColumns({"keep_id": F.col("doc_id").cast("long"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    named = found.withColumnRenamed("digest", "__digest")
    copies = common.join_groups(flagged.where("__hit").drop("__hit"), named, "__digest", "group_size", F.xxhash64("doc_id"))
    copies = copies.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # rows that repeat both the text and the doc_id that stays: one stays
    tied = F.col("kept") & (F.col("tops") > 1)
    turn = F.row_number().over(Window.partitionBy("__digest").orderBy("doc_id"))
    ties = copies.where(tied).withColumn("kept", turn == 1)
    names = [*[c for c in docs.columns if keep_text or c == "doc_id"], "keep_id", "group_size", "kept", "__digest"]
    out = alone.select(names).unionByName(copies.where(~tied).select(names)).unionByName(ties.select(names))
    return out.withColumn("text_sha256", F.lower(F.hex(F.substring("__digest", 1, 32)))).drop("__digest")
