"""Language identification by compression with one raw-content zstandard dictionary for each language."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import common

#: Most bytes of text that one language's dictionary holds, and rows (of different texts) per language that may give them.
DICTIONARY_BYTES, SAMPLE_ROWS = 32_768, 2_000
#: Characters that one sampled row gives, from a place in its whole text that a hash picks, so that a few long ones don't fill
#: a dictionary.
PASSAGE = 512
#: Least margin, as a share of the second smallest size, below which a prediction is rejected.
MIN_MARGIN = 0.005
LEVEL = 6
#: Bytes that one frame compresses: short ones lean on the dictionary, not on the text's own past.
BLOCK = 2_048


#: Runs of word characters but decimal digits and the underscore: letters, and the few numbers of other kinds.
_WORDS = re.compile(r"[^\W\d_]+")


@cache
def _numbers() -> dict[int, str]:
    """Word characters that are numbers but no decimal digits, as blanks."""
    return {c: " " for c in range(sys.maxunicode + 1) if (x := chr(c)).isalnum() and not x.isalpha() and not x.isdecimal()}


def learn(docs: DataFrame, seed: int = 0) -> dict[str, bytes]:
    """Raw-content dictionaries from labelled rows: a passage each of the SAMPLE_ROWS texts a language that have the least
    hashes; copies count once.

    Rows with null text, text without letters or null lang aren't used. The dictionaries go to the driver: DICTIONARY_BYTES a
    language, a fixed size that some hundred texts fill, lest a language gain by having more material. A language with less
    keeps what it has, which is to its own disadvantage alone: no dictionary depends on another's size.
    """
    labelled = docs.where("text is not null and lang is not null and text rlike '\\\\p{L}'").select("lang", "text", F.xxhash64("text", F.lit(seed)).alias("o"))
    # a cut on the hash by the number of distinct texts leaves about twice SAMPLE_ROWS a language, or all
    counts = common.save(labelled.groupBy("lang").agg(F.approx_count_distinct("o", 0.02).alias("n")), "languages")
    share = F.least(F.lit(1.0), F.lit(2.0 * SAMPLE_ROWS) / F.greatest(F.lit(1), "n"))
    start = F.pmod(F.xxhash64("o", F.lit(seed + 1)), F.greatest(F.lit(1), F.length("text") - PASSAGE + 1)) + 1
    passage = F.substring("text", start.cast("int"), F.lit(PASSAGE))
    # a row a language: Spark broadcasts it if it is small, else passages are shuffled, not texts
    near = labelled.select("lang", "o", passage.alias("t")).join(counts, "lang").where(F.pmod("o", F.lit(1_000_003)) < share * 1_000_003)
    found: dict[str, list[str]] = {}
    for r in near.groupBy("lang", "o").agg(F.min("t").alias("t")).groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("o", "t"))), 1, SAMPLE_ROWS).alias("s")).collect():
        found[r["lang"]] = [x["t"] for x in r["s"]]
    return {lang: " ".join(dict.fromkeys(filter(None, map(letters, texts)))).encode()[:DICTIONARY_BYTES] for lang, texts in sorted(found.items())}


def letters(text: str) -> str:
    """The words of letters (category L) in lower case: digits, marks and shouting say nothing of the language."""
    words = _WORDS.findall(text.lower())
    if not "".join(words).isalpha():  # a number among them: rare, so only now the slower way
        words = _WORDS.findall(text.lower().translate(_numbers()))
    return " ".join(words)


class Classifier:
    """Sizes of a text compressed with each dictionary, BLOCK bytes at a time; the smallest sum wins, ties by name."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.langs, self.coders = sorted(dictionaries), []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang] or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """lang, score, margin. `und` with 0 for null, text without letters, or no languages learned."""
        data = letters(text or "").encode()
        if not data or not self.langs:
            return "und", 0.0, 0.0
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.coders]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0, 1.0
        best, second = sizes[order[0]], sizes[order[1]]
        margin = (second - best) / second
        return self.langs[order[0]], min(1.0, 0.5 + 2.5 * margin), margin


def language_id(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """docs with lang_pred, score and lang_rejected, from the whole text alone.

    lang_pred is the language whose dictionary compresses the text best, or `und` where text is null or has no letter (also
    empty text, and any text when nothing was learned). score runs from 0 (und) over 0.5 (a tie) to 1. lang_rejected is
    true for `und` and where the margin to the second language is under min_margin. Columns of these names in docs are
    replaced; all others, lang included, pass through and aren't looked at.
    """
    docs = docs.drop("lang_pred", "score", "lang_rejected")
    models = docs.sparkSession.sparkContext.broadcast(dictionaries)  # DICTIONARY_BYTES for each language at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        known = Classifier(models.value)
        for batch in batches:
            lang, score, margin = zip(*map(known.predict, batch.column("text").to_pylist()), strict=True) if batch.num_rows else ((), (), ())
            rejected = [x == "und" or m < min_margin for x, m in zip(lang, margin, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=[*batch.schema.names, "lang_pred", "score", "lang_rejected"])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("lang_rejected", T.BooleanType())))])
    return docs.mapInArrow(run, schema)
