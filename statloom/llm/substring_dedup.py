"""Duplicate passages by relative Lempel-Ziv parsing of documents against the corpus as an index of reference blocks.

Content chooses the blocks: of each window of `window` words the run of half as many words with the least hash is its anchor,
and the consecutive windows with one anchor make a block. Every block of the corpus is a reference block, indexed by its anchor
and by the hashes of its whole span. A block whose whole span stands elsewhere matches the reference there in full; where only
the anchor does, the windows of one block of each distinct span are compared with those of the others. Each match points at its
place in a reference; matches that continue one another in the same reference are joined, and a document is parsed greedily
into these factors, ever the one that reaches furthest. Factors have `window` words at least; what they cover is duplicate.
Equal windows have equal anchors, so no window is missed. Spans and windows are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm import common

WINDOW = 35
_BLOCK = "key long, anchor long, span long, check long, first int, n int"
_WINDOW = "anchor long, hash long, check long, key long, start int"
_FACTOR = "array<struct<start: int, end: int, ref: long, ref_start: int>>"


def _anchor_words(window: int) -> int:
    return window // 2 + 1


def _hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of words[start:end]."""
    n = (ends - starts).astype(np.uint64)
    other = common.mix(words ^ np.uint64(0x2545F4914F6CDD1D))
    return common.mix(common.WORDS.windows(words, starts, ends) + n), common.mix(common.CHECKS.windows(other, starts, ends) ^ n)


def blocks(words: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """anchor hash, span's two hashes, first window and number of windows of each block of a text's word hashes."""
    if len(words) < window:
        return (np.empty(0, np.uint64),) * 3 + (np.empty(0, np.int64),) * 2
    size = _anchor_words(window)
    at = np.arange(len(words) - size + 1)
    grams = common.mix(common.WORDS.windows(words, at, at + size))
    place = np.lib.stride_tricks.sliding_window_view(grams, window - size + 1).argmin(1)
    place += np.arange(len(place))
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    n = np.diff(first, append=len(place))
    return grams[place[first]], *_hashes(words, first, first + n + window - 1), first, n


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=names)


def _blocks_of(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = batch.column(0).to_pylist(), []
            for key, text in zip(keys, batch.column(1).to_pylist(), strict=True):
                a, s, c, f, n = blocks(common.word_hashes((text or "").encode()), window)
                if len(a):
                    found.append((np.full(len(a), key), a, s, c, f.astype(np.int32), n.astype(np.int32)))
            if found:
                yield _batch(["key", "anchor", "span", "check", "first", "n"], *map(np.concatenate, zip(*found, strict=True)))

    return run


def _windows_of(window: int):
    """Rows (anchor, hash, check, key, start) of the windows in the blocks that a text's row lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, text, listed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = common.word_hashes((text or "").encode())
                n = np.array([x["n"] for x in listed])
                start = np.repeat(np.array([x["first"] for x in listed]) - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                hashes = _hashes(words, start, start + window)
                found.append((np.repeat(np.array([x["anchor"] for x in listed]), n), *hashes, np.full(len(start), key), start.astype(np.int32)))
            if found:
                yield _batch(["anchor", "hash", "check", "key", "start"], *map(np.concatenate, zip(*found, strict=True)))

    return run


def _reference(key: str, at: str) -> Column:
    """The place that a repeated block or window points at: the least of all its places, `lo`, or for that itself the largest."""
    own = (F.col(key) == F.col("lo.key")) & (F.col(at) == F.col("lo.at"))
    return F.when(own, F.col("hi")).otherwise(F.col("lo"))


def _places(at: str) -> list[Column]:
    place = F.struct("key", F.col(at).alias("at"))
    return [F.count("*").alias("c"), F.min(place).alias("lo"), F.max(place).alias("hi")]


def matches(rows: DataFrame, window: int) -> DataFrame:
    """key and pieces, an array of (start, end, ref, ref_start): words start to end of the row stand in row `ref` from
    ref_start on. rows: (key, text); a row that stands in full elsewhere may point at itself if the other has its key."""
    every = rows.mapInArrow(_blocks_of(window), _BLOCK)
    # counted with partial sums by task, so an anchor that a third of the rows share is no large group; as a table of its
    # own, so that Spark can split that anchor's rows in the join
    twice = common.save(every.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    held = common.save(every.join(twice.hint("merge"), "anchor", "left_semi"), "blocks", [twice])
    span = ["anchor", "span", "check"]
    kinds = common.save(held.groupBy(*span).agg(*_places("first"), F.first("n").alias("n")), "spans")
    parted = kinds.groupBy("anchor").count().where("count > 1").select("anchor")
    # one block of each distinct span: reference blocks whose windows are compared one by one
    ends = kinds.join(common.save(parted, "parted").hint("merge"), "anchor", "left_semi").select("lo.key", "anchor", F.col("lo.at").alias("first"), "n")
    listed = common.save(ends.groupBy("key").agg(F.collect_list(F.struct("anchor", "first", "n")).alias("listed")), "listed")
    near = common.with_hits(rows, "key", listed.select("key")).where("__hit").select("key", "text")
    windows = common.save(near.join(listed.hint("merge"), "key").select("key", "text", "listed").mapInArrow(_windows_of(window), _WINDOW), "windows", [listed])
    same = ["anchor", "hash", "check"]
    again = common.save(windows.groupBy(*same).agg(*_places("start")).where("c > 1"), "again")
    single = windows.join(again.hint("merge"), same).select("key", "start", (F.col("start") + window).alias("end"), _reference("key", "start").alias("to"))
    repeated = kinds.where("c > 1").drop("n", "c")
    whole = held.join(repeated.hint("merge"), span).select("key", F.col("first").alias("start"), (F.col("first") + F.col("n") + (window - 1)).alias("end"), _reference("key", "first").alias("to"))
    piece = F.struct("start", "end", F.col("to.key").alias("ref"), F.col("to.at").alias("ref_start"))
    return common.save(whole.unionByName(single).groupBy("key").agg(F.collect_list(piece).alias("pieces")), "pieces", [held, kinds, windows, again])


def parse(start: np.ndarray, end: np.ndarray, ref: np.ndarray, ref_start: np.ndarray) -> np.ndarray:
    """Factors, rows (start, end, ref, ref_start), of a document from its matches.

    Matches that overlap or touch and point at one stretch of a reference are one. From the left, the match that reaches
    furthest of those that start no later than the words not yet parsed is the next factor.
    """
    shift = ref_start - start
    order = np.lexsort((start, shift, ref))
    start, end, ref, shift = start[order], end[order], ref[order], shift[order]
    # stretches of one (ref, shift) have pieces of almost one length, so ends grow with starts but for nested ones
    new = np.concatenate([[True], (ref[1:] != ref[:-1]) | (shift[1:] != shift[:-1])])
    run = np.cumsum(new)
    far = np.maximum.accumulate(end + run * (int(end.max()) + 1)) - run * (int(end.max()) + 1)
    new[1:] |= start[1:] > far[:-1]
    at = np.flatnonzero(new)
    joined = np.stack([start[at], np.maximum.reduceat(end, at), ref[at], shift[at] + start[at]], 1)
    joined = joined[np.lexsort((-joined[:, 1], joined[:, 0]))]
    out, done, i = [], -1, 0
    while i < len(joined):
        best = None
        while i < len(joined) and joined[i, 0] <= max(done, joined[i if best is None else best, 0]):
            if best is None or joined[i, 1] > joined[best, 1]:
                best = i
            i += 1
        if joined[best, 1] > done:
            out.append(best)
            done = int(joined[best, 1])
    return joined[out]


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with row_key, n_words, n_removed, factors and kept_text.

    A word goes if it is covered by `window` consecutive words whose sequence also starts anywhere else, in another row or
    in this one, overlaps included; all is judged on the input, so of repeated passages no occurrence stays. Words are runs
    of anything but ASCII white space, taken unchanged; kept_text joins the kept ones by one space. factors are what a text
    was parsed into, (start, end, ref, ref_start): these words also stand in the row with row_key `ref`, from word ref_start
    on; the words that they cover go. Null text has no words. Rows that repeat count as different rows, though doc_id and
    text give them one row_key. Texts under `window` words lose nothing. An empty table gives an empty table. Columns of
    these names in docs are replaced.
    """
    docs = docs.drop("row_key", "n_words", "n_removed", "factors", "kept_text")
    rows = common.with_row_key(docs, "row_key")
    found = matches(rows.select(F.col("row_key").alias("key"), "text"), window)
    columns = rows.columns
    names = [*columns, "n_words", "n_removed", "factors", "kept_text"]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ref", pa.int64()), ("ref_start", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, factors, kept = [], [], [], []
            pieces = batch.column(batch.schema.get_field_index("pieces"))
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                words = (text or "").encode().split()
                total.append(len(words))
                if not pieces[i].is_valid:
                    removed.append(0)
                    factors.append([])
                    kept.append(b" ".join(words).decode())
                    continue
                parsed = parse(*(x.to_numpy(zero_copy_only=False).astype(np.int64) for x in pieces[i].values.flatten()))
                gone = np.zeros(len(words), bool)
                for a, b in parsed[:, :2].tolist():
                    gone[a:b] = True
                removed.append(int(gone.sum()))
                factors.append([dict(zip(("start", "end", "ref", "ref_start"), x, strict=True)) for x in parsed.tolist()])
                kept.append(b" ".join(compress(words, (~gone).tolist())).decode())
            new = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(factors, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in columns], *new], names=names)

    # a Bloom filter tells most rows without a match, whose texts then stay where they are
    flagged = common.with_hits(rows, "row_key", found.select("key"))
    none = flagged.where("not __hit").drop("__hit").withColumn("pieces", F.expr(f"cast(null as {_FACTOR})"))
    some = flagged.where("__hit").drop("__hit").join(found.withColumnRenamed("key", "row_key").hint("merge"), "row_key", "left").select(none.columns)
    long = F.lit(0).cast("long")
    schema = rows.withColumns({"n_words": long, "n_removed": long, "factors": F.expr(f"cast(null as {_FACTOR})"), "kept_text": F.lit("")}).schema
    return none.mapInArrow(run, schema).unionByName(some.mapInArrow(run, schema))
