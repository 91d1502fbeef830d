"""Token counts under a unigram model by trie-shared dynamic programming.

Distinct pre-tokens are inserted in a trie; the best segmentation's score of a prefix is computed once for each node, so
pre-tokens with a common prefix share that work, and a terminal keeps its token count. A document's count is the sum over
its pre-tokens. Each task keeps one trie for the rows it reads; beyond NODES nodes it starts anew. Of a longer pre-token the
trie holds the first DEEP characters; from there on only what the longest piece can reach back to is kept. The shipped vocabulary has
merges but no unigram scores, so these come from how often its encoder uses each piece in the whole corpus.
"""

from __future__ import annotations

import gc
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Nodes that a trie holds, and distinct pre-tokens that a task counts, before they start anew.
NODES, WORDS = 1_000_000, 500_000
#: Characters of a pre-token that a trie holds, characters that the encoder counts pieces of at once, and characters of texts
#: above that length that a task holds before it counts them.
DEEP, RUN, HELD = 4_096, 1 << 16, 1 << 25
_SPACE = "▁"
_known: dict[str, Trie] = {}


def piece_counts(docs: DataFrame, path: str) -> dict[str, int]:
    """How often the vocabulary's own encoder uses each piece in all texts of docs; the driver holds one count a piece.

    A task counts its pre-tokens, WORDS distinct ones at a time, and encodes each distinct one once. Of a pre-token above RUN
    characters each run of RUN characters is encoded by itself, so memory doesn't grow with it; no other is cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        model, held, total = SentencePieceProcessor(model_file=path), Counter(), np.zeros(0, np.int64)

        def add() -> None:
            words, counts = list(held), np.array(list(held.values()), np.int64)
            for at in range(0, len(words), 10_000):
                ids = model.encode([w.decode() for w in words[at : at + 10_000]], num_threads=1)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                total[:] += np.bincount(np.fromiter(chain.from_iterable(ids), np.int64, sizes.sum()), np.repeat(counts[at : at + 10_000], sizes), len(total)).astype(np.int64)
            held.clear()

        total = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            size = 0
            for text in batch.column(0).to_pylist():
                if len(text or "") <= RUN:
                    held.update((text or "").encode().split())
                    continue
                # bytes are split, since white space of ASCII alone parts words
                for word in text.encode().split():
                    held.update([word] if len(word) <= RUN else [w.encode() for w in _runs(word.decode(), RUN)])
                size += len(text)
                if size > HELD:
                    add()
                    size = 0
            if size or len(held) > WORDS:
                add()
        add()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([model.id_to_piece(int(i)) for i in used], pa.string()), pa.array(total[used])], names=["piece", "n"])

    found = docs.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: r["n"] for r in found.collect()}


def _runs(word: str, size: int) -> list[str]:
    return [word[at : at + size] for at in range(0, len(word), size)]


class Vocabulary:
    """Pieces with unigram scores: the log of a piece's share of all pieces counted, each counted once more than it was."""

    def __init__(self, path: str, counts: dict[str, int]) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        total = sum(counts.get(p, 0) + 1 for p in plain)
        self.scores = {p: math.log((counts.get(p, 0) + 1) / total) for p in plain}
        # a character that is no piece falls back to a token for each byte
        self.byte_score = min(self.scores.values(), default=0.0) - 10.0

    def byte_fallback(self, char: str) -> tuple[float, int]:
        n = len(char.encode("utf-8", "surrogatepass"))
        return n * self.byte_score, n


class Trie:
    """Nodes by prefix; a node holds its best score and that segmentation's tokens. Equal scores: the fewest tokens."""

    def __init__(self, vocabulary: Vocabulary, most: int = NODES) -> None:
        self.vocabulary, self.most = vocabulary, most
        self.longest = max(map(len, vocabulary.scores), default=1)
        # pieces by their last characters backwards, so that a node tries only endings that exist
        self.ends: dict = {}
        for piece, score in vocabulary.scores.items():
            node = self.ends
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score
        self.clear()

    def clear(self) -> None:
        self.size, self.computed = 1, 0
        self.root: dict = {}
        self.terminal: dict[bytes, tuple] = {}

    def count(self, word: bytes) -> int:
        """Tokens of a pre-token, from its terminal node, which is found by name if the word was inserted before."""
        node = self.terminal.get(word)
        if node is None:
            if self.size > self.most:
                self.clear()
            node = self._insert(_SPACE + word.decode())
            if len(word) <= DEEP:
                self.terminal[word] = node
                self.size += len(word) >> 8  # a long name takes as much as some nodes
        return node[1]

    def _insert(self, word: str) -> tuple:
        """The word's terminal: walk down from the root; only nodes that aren't there yet are computed. A node is (score,
        tokens, children). Past DEEP characters nothing is stored, and of the scores on the way only the last ones are kept."""
        node, scores, tokens, child, pieces = self.root, [0.0], [0], (0.0, 0, self.root), self.vocabulary.scores
        gone = 0
        for end, c in enumerate(word, 1):
            child = node.get(c)
            if child is None:
                best, least, ends, start = -math.inf, 0, self.ends, end
                while start:
                    start -= 1
                    ends = ends.get(word[start])
                    if ends is None:
                        break
                    if "" in ends:
                        score = ends[""] + scores[start - gone]
                        if score > best or score == best and tokens[start - gone] + 1 < least:
                            best, least = score, tokens[start - gone] + 1
                if c not in pieces:
                    score, n = self.vocabulary.byte_fallback(c)
                    if score + scores[-1] > best:
                        best, least = score + scores[-1], n + tokens[-1]
                child = (best, least, {})
                if end <= DEEP:
                    node[c] = child
                    self.size += 1
                self.computed += 1
            scores.append(child[0])
            tokens.append(child[1])
            if len(scores) > 2 * DEEP + self.longest:
                cut = len(scores) - self.longest - 1
                del scores[:cut], tokens[:cut]
                gone += cut
            node = child[2]
        return child


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """docs with n_words and n_tokens of the whole text.

    Pre-tokens are the runs of anything but white space (of ASCII), each with a mark for its start; characters without a
    piece count a token for each byte. Of very long pre-tokens only the text itself is held whole. The unigram scores are those of the pieces' counts in all texts of docs. Null and
    empty texts have no tokens. Columns of these names in docs are replaced, others pass through; an empty table gives an
    empty table.
    """
    docs = docs.drop("n_words", "n_tokens")
    counts = docs.sparkSession.sparkContext.broadcast(piece_counts(docs, vocabulary_path))  # one a piece of the vocabulary
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _known:  # one for each Python worker
            _known.clear()
            _known[name] = Trie(Vocabulary(vocabulary_path, counts.value))
        known = _known[name]
        gc.disable()  # nodes form no cycles, and there are too many to look through time and again
        try:
            for batch in batches:
                words, tokens = [], []
                for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                    cut = (text or "").encode().split()
                    words.append(len(cut))
                    tokens.append(sum(map(known.count, cut)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[*batch.schema.names, "n_words", "n_tokens"])
        finally:
            gc.enable()

    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.mapInArrow(run, schema)
