"""Helpers that the corpus operators share: shared-folder tables, word hashing, cached tokenizing."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: The words of the contracts: runs of anything but space and \t\n\v\f\r.
WORD = r"[^\x20\x09-\x0D]+"
_ODD = U64(0x9E3779B97F4A7C15)
_written: list[tuple[SparkSession, str]] = []
_paths: dict[int, tuple[DataFrame, str]] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a temporary one only in local mode, where it is unset.

    On a cluster a folder of the driver's own machine would be incomplete for all others, so an unset name is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="statloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Whether Spark removes the shuffle files of a query as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save(df: DataFrame, name: str, done: Iterable[DataFrame] = ()) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors.

    The shuffle files of the write go when it has ended. `done` are saved tables that nothing needs any more after it.
    """
    spark = df.sparkSession
    path = saved_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.parquet(path)
    _paths[id(out)] = (out, path)
    for old in done:
        drop(old)
    return out


def drop(saved: DataFrame) -> None:
    """Remove a table that save() has written."""
    _, path = _paths.pop(id(saved))
    _written.remove((saved.sparkSession, path))
    _remove(saved.sparkSession, path)


def saved_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{checkpoint_dir(spark)}/statloom/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_saved() -> None:
    """Remove the tables that save() has written; called when the driver ends."""
    _paths.clear()
    while _written:
        try:
            _remove(*_written.pop())
        except Exception:  # noqa: BLE001  the session may be gone already
            return


atexit.register(drop_saved)


#: Rows of texts that go to a Python worker at once.
BATCH_ROWS = 1_000


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, since rows hold whole texts; workers find this package even if they start in another folder."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- rows, filters and joins

#: Most words of a filter that is broadcast, and bits that a key sets in one of them.
FILTER_WORDS, FILTER_BITS = 1 << 20, 3
#: Rows of a group above which it is dealt over several tasks, and most such groups that are broadcast.
HOT_ROWS, HOT_GROUPS = 1_000, 100_000


#: Bits of a name of a row or set, before those that are shared by different ones get another.
NAME_BITS = 64


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """docs with a long that tells its rows apart by doc_id and text; rows that repeat both have the same one.

    It is a 64-bit hash. A second hash finds the keys that different rows share, some n**2 / 2**65 of n rows (43 of 4 * 10**10);
    those rows alone get another hash, until no key is shared.
    """

    def hashed(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("doc_id").isNull(), "text", F.col("text").isNull())

    key, check, seed = F.shiftrightunsigned(hashed(0), 64 - NAME_BITS) if NAME_BITS < 64 else hashed(0), hashed(1), 2
    while shared := ambiguous(docs.select(key.alias("k"), check.alias("c"))):
        key, seed = F.when(key.isin(shared), hashed(seed)).otherwise(key), seed + 1
    return docs.withColumn(name, key)


def ambiguous(pairs: DataFrame) -> list[int]:
    """The k of rows (k, c) that stand with different c: shared by chance, and as few."""
    return [r["k"] for r in pairs.groupBy("k").agg((F.min("c") != F.max("c")).alias("x")).where("x").select("k").collect()]


def with_hits(rows: DataFrame, key: str, known: DataFrame, name: str = "__hit") -> DataFrame:
    """rows with a boolean that is true where the long `key` is in the one column of `known`, and for few other keys.

    A blocked Bloom filter of FILTER_WORDS words at most, joined by broadcast: its size doesn't grow with the data. With more
    keys than it can tell apart it lets more rows through, so what follows must be exact by itself.
    """
    words = min(FILTER_WORDS, 1 << max(4, known.count().bit_length()))

    def place(k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(words)).cast("int")

    def bits(k: Column) -> Column:
        h = F.xxhash64(F.lit(1), k)
        one = F.lit(1).cast("long")
        out = F.lit(0).cast("long")
        for i in range(FILTER_BITS):
            out = out.bitwiseOR(F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
        return out

    k = F.col(known.columns[0])
    table = known.groupBy(place(k).alias("__word")).agg(F.bit_or(bits(k)).alias("__bits"))
    out = rows.withColumn("__word", place(F.col(key))).join(F.broadcast(table), "__word", "left").drop("__word")
    return out.withColumn(name, F.coalesce(F.col("__bits").bitwiseAND(bits(F.col(key))) == bits(F.col(key)), F.lit(False))).drop("__bits")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, salt: Column) -> DataFrame:
    """rows joined (inner) with their group by `key`; a group of more than HOT_ROWS rows is dealt over tasks by `salt`.

    groups has one row a key, with the number of its rows in `count`. The list of hot groups is broadcast: their number is
    bounded by the rows over the threshold, which rises tenfold until HOT_GROUPS at most are left.
    """
    most = HOT_ROWS
    while (hot := groups.where(F.col(count) > most).select(key, F.ceil(F.col(count) / F.lit(most)).cast("int").alias("__parts"))).count() > HOT_GROUPS:
        most *= 10
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("__part", F.pmod(salt, F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    parts = F.when(F.col(count) > most, F.ceil(F.col(count) / F.lit(most)).cast("int")).otherwise(1)
    spread = groups.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    # shuffled at every size, lest a small table alone be broadcast and the plan change as it grows
    return dealt.join(spread.hint("merge"), [key, "__part"]).drop("__part")


# ---------------------------------------------------------------- hashing of words, in numpy


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * U64(pow(base, done, 1 << 64))
        done += step
    return out


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)

    def windows(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair, independent of where it stands."""
        self.upto(len(values) + 1)
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


BYTES, WORDS, CHECKS = Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5), Powers(0x9FB21C651E98DF25)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: bytes, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 bytes; lower folds A-Z only."""
    raw = np.frombuffer(data, np.uint8)
    if lower:
        raw = _LOWER[raw]
    space = np.empty(len(raw) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, U64)
    return mix(BYTES.windows(raw.astype(U64) + U64(1), starts, ends) + (ends - starts).astype(U64) * _ODD)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows."""
    if len(words) < n:
        return np.empty(0, U64)
    at = np.arange(len(words) - n + 1)
    return mix(WORDS.windows(words, at, at + n))


def shingle_set(data: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of lower-cased words; fewer words make one shingle, none make none."""
    words = word_hashes(data, lower=True)
    if len(words) < n:
        return mix(WORDS.windows(words, np.array([0]), np.array([len(words)])) ^ U64(len(words))) if len(words) else words
    return np.unique(gram_hashes(words, n))


# ---------------------------------------------------------------- tokenizing with a cache of pieces

#: Letters and numbers among the characters up to U+024F, and the white space of ASCII.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t\n\r\x0b\x0c"
_ENDINGS = "'(?:s|t|re|ve|m|ll|d)"
#: The vocabularies' own splitting patterns over those characters.
_KEEPS_SPACE = re.compile(rf"{_ENDINGS}| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_DROPS_SPACE = re.compile(rf"{_ENDINGS}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
#: A text with any other character, or with one that is special in lower case or as white space, goes to the library whole; so
#: does one with an added token's content.
_OTHER = re.compile("[^\x00-\u024f\u2010-\u2027]|[\x1c-\x1f\x85\xa0\u0130\u023a\u023e]")
_loaded: dict[str, PieceTokenizer] = {}


def _odd(text: str) -> bool:
    """Whether a text has one of _OTHER; plain ASCII is told without a look at each character."""
    return any(c in text for c in "\x1c\x1d\x1e\x1f") if text.isascii() else _OTHER.search(text) is not None


def _byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for each byte: itself if printable in Latin-1, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class PieceTokenizer(dict):
    """ids of whole texts, packed as little-endian uint32.

    BPE merges never cross the pieces into which the vocabulary's pattern splits a text. The dictionary keeps the ids of
    pieces; the tokenizers library's model encodes those it lacks. `most` bounds it: beyond half of that it becomes the older
    half, from which pieces that occur again come back. The ids are those of Tokenizer.from_file(path).encode(text, add_special_tokens=False).
    """

    def __init__(self, path: str, most: int = 400_000) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.most, self.older = self.tokenizer.model, _byte_letters(), most, {}
        self.drops_space = self.tokenizer.normalizer is not None
        # the library finds added tokens before it splits a text
        self.added = [t.content.lower() if self.drops_space else t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = (_DROPS_SPACE if self.drops_space else _KEEPS_SPACE).findall

    def whole(self, text: str) -> bytes:
        """By the library's own pipeline."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            letters = piece.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        shown = text.lower() if self.drops_space else text
        if _odd(text) or any(t in shown for t in self.added):
            return self.whole(text)
        if 2 * len(self) > self.most:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, self.cut(shown)))


def tokenizer(path: str, most: int = 400_000) -> PieceTokenizer:
    """One for each Python worker and vocabulary, with a cache of `most` pieces (some 170 bytes each)."""
    if path not in _loaded:
        _loaded[path] = PieceTokenizer(path, most)
    _loaded[path].most = most
    return _loaded[path]


def release() -> None:
    """Drop a worker's tokenizers: operators without use for them may need their memory."""
    _loaded.clear()
