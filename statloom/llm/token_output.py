"""Token ids as compressed blocks: an adaptive context-mixing model drives a range coder.

A block holds the ids of consecutive documents and can be read alone: its models start anew and a checksum covers it. Its
ids are cut into lanes of STEPS ids, which are coded side by side, one id of each lane a step, against models that all lanes
share and that both sides update after each step. The id predicted after the last two ids and the one predicted after the
last id take shares of the interval, by mixed adaptive estimates of how often such predictions hold; adaptive order-0
frequencies share out the rest. All model arithmetic is on integers.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from statloom.llm import common

MAGIC, STEPS, BLOCK_IDS = b"CMRC\x01", 64, 1 << 20
#: Pieces whose ids a worker keeps.
PIECES = 800_000
_TOP, _BOT, _SCALE = np.uint64(1 << 48), np.uint64(1 << 32), 32
_MASK2, _MOST0, _GAIN0, _REBUILD, _GUIDE = (1 << 16) - 1, 1 << 21, 24, 4, 5
_STRETCH = np.array([round(256 * math.log((i + 0.5) / (4095.5 - i))) for i in range(4096)], np.int64)
_SQUASH = np.array([min(4000, max(8, round(4096 / (1 + math.exp(-i / 256))))) for i in range(-2048, 2048)], np.int64)


class _Rates:
    """Adaptive shares of hits by context, as 12-bit numbers."""

    def __init__(self, *shape: int) -> None:
        self.n, self.k = np.full(shape, 4, np.int64), np.full(shape, 2, np.int64)
        self.p = self.k * 4095 // self.n

    def update(self, n: np.ndarray, k: np.ndarray) -> None:
        self.n += n
        self.k += k
        if self.n.max() > 1 << 16:
            self.n, self.k = (self.n >> 1) + 2, (self.k >> 1) + 1
        self.p = self.k * 4095 // self.n


class _Model:
    """What both sides know before an id: predictions by the last two ids and the last one, and frequencies.

    A context is (confidence of either prediction, whether they agree). Two estimates that the order-2 prediction holds, by
    part of the context each, are mixed in the logistic domain with weights that follow the error.
    """

    def __init__(self, vocabulary: int, lanes: int) -> None:
        self.size = vocabulary
        self.count = np.ones(vocabulary, np.int64)
        self.waiting: list[np.ndarray] = []
        self.steps = 0
        # an entry is a predicted id + 1 and 4 bits of confidence, at most 15; 0: none yet
        self.after1, self.after2 = np.zeros(vocabulary + 1, np.int32), np.zeros(_MASK2 + 1, np.int32)
        self.last, self.before = np.full(lanes, vocabulary, np.int32), np.full(lanes, vocabulary, np.int32)
        self.agreed, self.paired, self.second = _Rates(16, 1, 2), _Rates(16, 16, 1), _Rates(16, 16, 1)
        self.weight = np.full((1, 1, 2), 128, np.int64)
        self._sum()
        self._mix()

    def _sum(self) -> None:
        if self.waiting:
            self.count += np.bincount(np.concatenate(self.waiting), minlength=self.size) * _GAIN0
            self.waiting = []
        self.total = int(self.count.sum())
        while self.total > _MOST0:
            self.count = (self.count + 1) >> 1
            self.total = int(self.count.sum())
        # quotients below 2**32 by numbers up to 2**21 are told from integers in doubles, so division is exact after truncation
        self.cum = np.zeros(self.size + 1)
        np.cumsum(self.count, out=self.cum[1:])
        self.guide = None

    def _holding(self, places: np.ndarray) -> np.ndarray:
        """The id whose part of the cumulated frequencies holds each place, a whole number.

        A table has the ids that hold every 2**_GUIDE-th place, so that few steps are left to halve the ids between two of them.
        """
        if self.guide is None:
            marks = np.arange(0, self.total + (2 << _GUIDE), 1 << _GUIDE)
            self.guide = np.minimum(np.searchsorted(self.cum[1:], marks, side="right"), self.size - 1)
            self.steps_left = int(np.diff(self.guide).max()).bit_length()
        at = places.astype(np.intp) >> _GUIDE
        low, high = self.guide.take(at), self.guide.take(at + 1)
        for _ in range(self.steps_left):
            middle = low + high >> 1
            below = self.cum.take(middle + 1) <= places
            low, high = np.where(below, middle + 1, low), np.where(below, high, middle)
        return low

    def _mix(self) -> None:
        """Parts of the interval of either prediction, by context."""
        self.a, self.b = _STRETCH[self.agreed.p], _STRETCH[self.paired.p]
        self.p2 = _SQUASH[np.clip((self.a * self.weight + self.b * (256 - self.weight)) >> 8, -2048, 2047) + 2048]
        self.p2[0] = 0
        p1 = np.clip(np.broadcast_to(self.second.p, self.p2.shape), 8, 4000) * np.array([1, 0])
        p1[:, 0] = 0
        f2, f1 = self.p2 << 20, ((4096 - self.p2) * p1 >> 12) << 20
        self.part2, self.head = f2.ravel(), (f2 + f1).ravel()
        self.rest = (1 << _SCALE) - self.head.astype(float)

    def shares(self, n: int) -> None:
        """Predictions and contexts of the first n lanes."""
        self.at1 = self.last[:n].astype(np.intp)
        self.at2 = (self.last[:n] * np.int32(0x1E3779B1) + self.before[:n] * np.int32(0x05EBCA77) >> 9 & _MASK2).astype(np.intp)
        self.e2, self.e1 = self.after2.take(self.at2), self.after1.take(self.at1)
        self.conf2, self.conf1, id2, id1 = self.e2 & 15, self.e1 & 15, self.e2 >> 4, self.e1 >> 4
        self.context = ((self.conf2 << 5) + (self.conf1 << 1) + (id2 == id1)).astype(np.intp)
        self.id2, self.id1 = id2 - 1, id1 - 1

    def _low(self, context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the parts of ids that neither prediction gave."""
        rest, ids = self.rest.take(context), ids.astype(np.intp)
        low = (rest * self.cum.take(ids) / self.total).astype(np.int64)
        high = (rest * self.cum.take(ids + 1) / self.total).astype(np.int64)
        return self.head.take(context) + low, high - low

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of each id's part of the interval."""
        size, start = self.part2.take(self.context), np.zeros(len(ids), np.int64)
        self.hit2 = (ids == self.id2) & (size > 0)
        other = np.flatnonzero(~self.hit2)
        c, now = self.context.take(other), ids.take(other)
        first = size.take(other)
        second = self.head.take(c) - first
        hit = (now == self.id1.take(other)) & (second > 0)
        self.hit1 = other[hit]
        start[self.hit1], size[self.hit1] = first[hit], second[hit]
        miss = ~hit
        at = other[miss]
        start[at], size[at] = self._low(c[miss], now[miss])
        return start, size

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids whose parts hold these places; start and size of the parts."""
        size, start = self.part2.take(self.context), np.zeros(len(at), np.int64)
        self.hit2 = at < size
        ids = self.id2.copy()
        other = np.flatnonzero(~self.hit2)
        c, place, first = self.context.take(other), at.take(other), size.take(other)
        head = self.head.take(c)
        hit = place < head
        self.hit1 = other[hit]
        ids[self.hit1], start[self.hit1], size[self.hit1] = self.id1[self.hit1], first[hit], (head - first)[hit]
        miss = ~hit
        at, c = other[miss], c[miss]
        t = ((place[miss] - head[miss] + 1) * float(self.total) - 1) / self.rest.take(c)
        now = self._holding(np.floor(t))
        ids[at] = now
        start[at], size[at] = self._low(c, now)
        return ids, start, size

    def update(self, ids: np.ndarray) -> None:
        """Learn what the first lanes' ids were, after interval() or find()."""
        n = len(ids)
        every = np.bincount(self.context, minlength=512).reshape(16, 16, 2)
        hits = np.bincount(self.context[self.hit2], minlength=512).reshape(16, 16, 2)
        seconds = np.bincount(self.context.take(self.hit1), minlength=512).reshape(16, 16, 2)
        error = ((hits << 12) - every * self.p2) * (self.a - self.b) >> 10
        step = error.sum((0, 1)) // np.maximum(1, every.sum((0, 1))) >> 4
        self.weight = np.clip(self.weight + step, 0, 256)
        self.agreed.update(every.sum(1, keepdims=True), hits.sum(1, keepdims=True))
        self.paired.update(every.sum(2, keepdims=True), hits.sum(2, keepdims=True))
        self.second.update((every - hits)[:, :, :1], seconds[:, :, :1])
        self._mix()
        fresh = (ids + 1 << 4) + 1
        self.after2[self.at2] = self._entry(self.e2, self.conf2, self.id2 == ids, fresh)
        self.after1[self.at1] = self._entry(self.e1, self.conf1, self.id1 == ids, fresh)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids
        self.waiting.append(ids)
        self.steps += 1
        if self.steps % _REBUILD == 0 or self.steps < _REBUILD:
            self._sum()

    @staticmethod
    def _entry(entry: np.ndarray, conf: np.ndarray, hit: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """A hit adds to the confidence; a miss halves one above 3 and else puts the new id there."""
        return np.where(hit, entry + (conf < 15), np.where(conf > 3, entry - (conf + 1 >> 1), fresh))


class _Lanes:
    """State of a range coder for each lane; settle() yields the lanes whose top 16 bits are settled and shifts them out."""

    def __init__(self, lanes: int) -> None:
        self.low, self.span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)

    def unit(self, n: int) -> np.ndarray:
        return self.span[:n] >> np.uint64(_SCALE)

    def narrow(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        n = len(unit)
        self.low[:n] += unit * start.view(np.uint64)
        np.multiply(unit, size.view(np.uint64), out=self.span[:n])

    def settle(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        a, b, go = self.low[:n], self.span[:n], None
        while True:
            out = (a ^ (a + b)) < _TOP
            tight = ~out & (b < _BOT)
            if tight.any():
                b = np.where(tight, -a & (_BOT - np.uint64(1)), b)
                out |= tight
            at = np.flatnonzero(out)
            if not len(at):
                return
            a, b, go = a.take(at), b.take(at), at if go is None else go.take(at)
            yield go, a
            a, b = a << np.uint64(16), b << np.uint64(16)
            self.low[go], self.span[go] = a, b


def encode(ids: np.ndarray) -> bytes:
    """A block of ids below 2**20."""
    ids = np.asarray(ids)
    n = len(ids)
    size = int(ids.max(initial=0)) + 1
    if size > 1 << 20 or int(ids.min(initial=0)) < 0:
        raise ValueError("ids must be below 2**20")
    ids = ids.astype(np.int32)
    lanes = -(-n // STEPS)
    model, coder = _Model(size, lanes), _Lanes(lanes)
    lane_out, word_out = [], []
    for t in range(min(n, STEPS)):
        active = lanes if (lanes - 1) * STEPS + t < n else lanes - 1
        now = ids[t::STEPS][:active]
        model.shares(active)
        coder.narrow(coder.unit(active), *model.interval(now))
        for go, low in coder.settle(active):
            lane_out.append(go)
            word_out.append((low >> np.uint64(48)).astype("<u2"))
        model.update(now)
    for shift in (48, 32, 16, 0):
        lane_out.append(np.arange(lanes))
        word_out.append((coder.low >> np.uint64(shift)).astype("<u2"))
    lane = np.concatenate(lane_out) if lane_out else np.empty(0, np.int64)
    words = np.concatenate(word_out)[np.argsort(lane.astype(np.int32), kind="stable")] if n else np.empty(0, "<u2")
    sizes = zlib.compress(np.bincount(lane, minlength=lanes).astype("<u4").tobytes(), 1)
    body = struct.pack("<III", n, size, len(sizes)) + sizes + words.astype("<u2").tobytes()
    return MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def decode(block: bytes) -> np.ndarray:
    """ids of a block; ValueError if it isn't one or its checksum differs."""
    if block[:5] != MAGIC or len(block) < 21 or zlib.crc32(block[9:]) != struct.unpack("<I", block[5:9])[0]:
        raise ValueError("not an intact block of ids")
    n, size, head = struct.unpack("<III", block[9:21])
    lanes = -(-n // STEPS)
    sizes = np.frombuffer(zlib.decompress(block[21 : 21 + head]), "<u4").astype(np.int64)
    words = np.frombuffer(block, "<u2", offset=21 + head) if (21 + head) % 2 == 0 else np.frombuffer(block[21 + head :], "<u2")
    words = words.astype(np.uint64)
    at = np.zeros(lanes, np.int64)
    np.cumsum(sizes[:-1], out=at[1:])
    code = np.zeros(lanes, np.uint64)
    for _ in range(4 if n else 0):
        code = code << np.uint64(16) | words[at]
        at += 1
    model, coder = _Model(size, lanes), _Lanes(lanes)
    ids = np.zeros((STEPS, lanes), np.int32)
    for t in range(min(n, STEPS)):
        active = lanes if (lanes - 1) * STEPS + t < n else lanes - 1
        model.shares(active)
        unit = coder.unit(active)
        place = np.minimum((code[:active] - coder.low[:active]) // unit, np.uint64((1 << _SCALE) - 1))
        now, start, part = model.find(place.view(np.int64))
        coder.narrow(unit, start, part)
        for go, _ in coder.settle(active):
            code[go] = code[go] << np.uint64(16) | words[at[go]]
            at[go] += 1
        model.update(now)
        ids[t, :active] = now
    return ids.T.reshape(-1)[:n]


def pack_block(doc_ids: list[int | None], parts: list[bytes]) -> bytes:
    """A block with its documents' ids (null as a flag) and lengths in front."""
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = zlib.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array([len(p) // 4 for p in parts], "<i8").tobytes() + known.tobytes(), 1)
    head = struct.pack("<II", len(doc_ids), len(head)) + head
    return struct.pack("<I", zlib.crc32(head)) + head + encode(np.frombuffer(b"".join(parts), "<u4"))


def unpack_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, their numbers of ids, all ids."""
    n, size = struct.unpack("<II", block[4:12])
    head = zlib.decompress(block[12 : 12 + size])
    if zlib.crc32(block[4 : 12 + size]) != struct.unpack("<I", block[:4])[0]:
        raise ValueError("not an intact block of documents")
    docs, lengths, known = np.frombuffer(head, "<i8", n), np.frombuffer(head, "<i8", n, 8 * n), np.frombuffer(head, np.uint8, n, 16 * n)
    return [d if k else None for d, k in zip(docs.tolist(), known.tolist(), strict=True)], lengths, decode(block[12 + size :])


_FILE = "part int, place long, first_start long, n_tokens long, n_docs int, block binary"


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, partitions: int | None = None) -> None:
    """Write the ids of every text, each document's followed by end_id, in ascending doc_id order, as a folder of blocks.

    Null text counts as empty (end_id alone), a null doc_id comes first, rows that repeat a doc_id follow one another. The
    folder's Parquet files carry a block a row: (part, place) is its order, first_start its ids' offset within the part.
    An empty table gives a folder without blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end, part = common.tokenizer(tokenizer_path, PIECES), int(end_id).to_bytes(4, "little"), TaskContext.get().partitionId()
        doc_ids, parts, size, place, start = [], [], 0, 0, 0

        def block() -> pa.RecordBatch:
            row = [part, place, start, size // 4, len(doc_ids), pack_block(doc_ids, parts)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["part", "place", "first_start", "n_tokens", "n_docs", "block"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                parts.append(tokens.encode(text or "") + end)
                size += len(parts[-1])
                if size >= 4 * BLOCK_IDS:
                    yield block()
                    start, place, doc_ids, parts, size = start + size // 4, place + 1, [], [], 0
        if doc_ids:
            yield block()

    n = partitions or common.shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    rows.mapInArrow(run, _FILE).write.option("compression", "none").parquet(path)


def read_ids(spark: object, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids: binary, little-endian uint32) of each document in a folder of blocks."""
    files = spark.read.parquet(path)
    # a row a part: their number is that of the writing job's partitions
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("__n"))
    before = sizes.select("part", (F.sum("__n").over(Window.orderBy("part")) - F.col("__n")).alias("__before"))
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids, lengths, ids = unpack_block(block)
                ends = np.cumsum(lengths)
                data = memoryview(ids.astype("<u4").tobytes())
                cut = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                cols = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array([bytes(c) for c in cut], pa.binary())] * with_ids], names=names)

    placed = files.join(F.broadcast(before), "part").select((F.col("first_start") + F.col("__before")).alias("start"), "block")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
