"""The corpus operators against brute force, round trips and held-out accuracy, and on the edge cases."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from statloom.llm import common, components, exact_dedup, fingerprint, language_id, mixing, ngram_join, packing, sharding, substring_dedup, token_counts, token_output

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BPE, BYTE_BPE, PIECES = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- tokenizing


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
@pytest.mark.parametrize("most", [4, 50, 400_000])
def test_pieces_equal_whole(path, most, odd):
    t = common.PieceTokenizer(path, most)
    more = ["a  b", "\n\nfoo \n\nx", "  x  ", "it's 'tis I'LL", "x\r\n\r\ny\t z", "½² 3rd ×÷", "İstanbul ǅ ſ", "a b c\x1cd", "ΑΣ Σ"]
    every = [x for _, x in texts(odd)] + more
    for text in every + every:
        assert t.encode(text) == t.whole(text)
        assert len(t) + len(t.older) <= most + 2 * max(map(len, every))


# ---------------------------------------------------------------- 1 packing


def test_plan_covers_each_length_once():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 400):
        lengths = np.clip(rng.lognormal(4, 1.2, n).astype(int), 1, 512)
        histogram = Counter(lengths.tolist())
        runs, bound = packing.plan(histogram, 512, rounds=2)
        got = Counter()
        for r in runs:
            assert sum(x * k for x, k in r.slots) <= 512
            for x, k in r.slots:
                got[x] += k * r.count
        assert got == histogram
        used = sum(r.count for r in runs)
        assert bound <= used + 1e-6 and used <= sum(k for k, _ in packing.best_fit(dict(histogram), 512))


@pytest.fixture(scope="module")
def histogram(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return {r["length"]: r["count"] for r in packing.pieces(docs, WORD_BPE).groupBy("length").count().collect()}


@pytest.mark.parametrize("times", [1, 5, 50, 500])
def test_plan_beats_best_fit_alone(times, histogram):
    many = {x: n * times for x, n in histogram.items()}
    runs, bound = packing.plan(many)
    used = sum(r.count for r in runs)
    assert bound - 1e-6 <= used <= sum(n for n, _ in packing.best_fit(many, packing.LENGTH))
    assert used <= bound * 1.00003 + 1  # close to the least number at any size
    open_ = [r for r in runs if r.slots != [(packing.LENGTH, 1)]]
    if times >= 50:
        assert sum(r.count for r in open_ if not r.fitted) >= sum(r.count for r in open_) / 2


def test_program_never_exceeds_the_demand():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(1, 300, 60))
    demand = rng.integers(1, 500, len(lengths)).astype(float)
    configs, bound = packing.solve(lengths, demand, 300)
    for j, x in enumerate(lengths.tolist()):
        assert sum(n * dict(key).get(x, 0) for key, n in configs.items()) <= demand[j] * (1 + 1e-6)
    assert all(sum(x * k for x, k in key) == 300 for key in configs)
    assert 0 < sum(configs.values()) <= bound


@pytest.mark.parametrize("which", ["odd", "docs", "empty"])
def test_packing(which, request):
    df = request.getfixturevalue(which)
    rows = packing.pack(df, WORD_BPE, rounds=2).collect()
    tokens = common.PieceTokenizer(WORD_BPE)
    want = []
    for d, t in texts(df):
        ids = tokens.whole(t) + (1).to_bytes(4, "little")
        want += [(d, i, at // 4, len(ids[at : at + 16384]) // 4, zlib.crc32(ids[at : at + 16384])) for i, at in enumerate(range(0, len(ids), 16384))]
    assert Counter(tuple(r[:5]) for r in rows) == Counter(want)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        end = 0
        for offset, length in sorted(x):
            assert offset == end
            end += length
        assert end <= 4096


# ---------------------------------------------------------------- 2 fingerprints


@pytest.mark.parametrize("which", ["odd", "docs", "empty"])
def test_fingerprints(which, request):
    df = request.getfixturevalue(which)
    got = fingerprint.fingerprints(df).collect()
    order = sorted(texts(df), key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
    following = {d: order[(i + 1) % len(order)] for i, (d, _) in enumerate(order)}
    by = {d: t for d, t in order}
    assert len(got) == len(order)
    prints = {r.doc_id: r for r in got}
    for r in got:
        t, (n, after) = by[r.doc_id], following[r.doc_id]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        same = [r.fingerprint[i : i + 8] == prints[n].fingerprint[i : i + 8] for i in range(0, 256, 8)]
        assert r.near_next == sum(same) / 32
        same = [r.fingerprint[i : i + 8] == r.edited_fingerprint[i : i + 8] for i in range(0, 256, 8)]
        assert r.near_edited == sum(same) / 32
    one = defaultdict(set)
    for r in got:
        one[by[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in one.values())


def brute_fingerprint(text):
    """Order MinHash from its definition: of the occurrence-numbered k-mers, the least under each order, in text order."""
    def h(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p, seed=seed)
        return seed

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    words = WORD.findall(text)
    grams = [words[i : i + fingerprint.K] for i in range(max(len(words) - fingerprint.K, 0) + 1)] if words else []
    seen, numbered = Counter(), []
    for g in grams:
        x = h(*(w.encode() for w in g))
        seen[x] += 1
        numbered.append(h(x.to_bytes(8, "little"), seen[x].to_bytes(4, "little")))
    out = []
    for j in range(fingerprint.TUPLES):
        order = sorted((signed(h(x.to_bytes(8, "little"), j.to_bytes(4, "little"))) >> fingerprint.PLACE, place) for place, x in enumerate(numbered))
        least = sorted((place, x) for x, place in order[: fingerprint.LENGTH])
        out.append(h(*((x & (1 << 64) - 1).to_bytes(8, "little") for _, x in least)) & 0xFFFFFFFF if numbered else 0)
    return "".join(f"{x:08X}" for x in out)


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_fingerprints_by_definition(which, request):
    df = request.getfixturevalue(which)
    by = dict(texts(df))
    got = fingerprint.fingerprints(df.where("doc_id % 4 = 1 or doc_id < 20")).collect()
    order = sorted((r.doc_id for r in got), reverse=True)
    for r in got:
        t, after = by[r.doc_id], by[order[(order.index(r.doc_id) + 1) % len(order)]]
        cut = len(t) // 3
        assert r.fingerprint == brute_fingerprint(t)
        assert r.edited_fingerprint == brute_fingerprint(t[: len(t) - cut] + after[:cut])


def test_ranges(spark):
    rng = random.Random(6)
    for cuts in ([], [5], sorted(rng.sample(range(10_000), 300)), [-(1 << 62), 0, 3, 1 << 62]):
        ids = [None, *range(-3, 12), *rng.sample(range(10_000), 50), 1 << 62, -(1 << 63), (1 << 63) - 1, *cuts]
        rows = fingerprint._Ranges(spark, cuts).of(spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()
        assert all(r["__b"] == (0 if r.doc_id is None else 1 + sum(c < r.doc_id for c in cuts)) for r in rows)


def test_fingerprints_of_repeated_ids_and_one_row(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h i j"), (0, "k l m"), (None, "n o")]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((d, brute_fingerprint(t)) for d, t in rows)
    one = fingerprint.fingerprints(spark.createDataFrame(rows[3:4], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"k l k").hexdigest()


def test_fingerprints_follow_edits(docs):
    got = fingerprint.fingerprints(docs.where("n_chars > 600")).collect()
    assert np.mean([r.near_edited for r in got]) > 0.15 > 0.02 > np.mean([r.near_next for r in got])


def test_signature_is_order_sensitive(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words)), (1, " ".join(words[200:] + words[:200]))]
    sigs = fingerprint.signatures(spark.createDataFrame(rows, "id int, __text string"), ["id"]).collect()
    a, b = (r["__sig"] for r in sorted(sigs, key=lambda r: r.id))
    # nearly all k-mers are shared, but about half of the pairs change places
    assert 0.2 < np.mean([x == y for x, y in zip(a, b)]) < 0.8


# ---------------------------------------------------------------- 3 token counts


def brute_count(vocabulary, word):
    word = "▁" + word
    best = [(0.0, 0)] + [(-1e18, 0)] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            p = word[start:end]
            if p in vocabulary.scores:
                options = [(vocabulary.scores[p], 1)]
            elif end - start == 1:
                options = [vocabulary.byte_fallback(p)]
            else:
                continue
            for score, n in options:
                new = (best[start][0] + score, best[start][1] + n)
                if new[0] > best[end][0] or new[0] == best[end][0] and new[1] < best[end][1]:
                    best[end] = new
    return best[-1][1]


@pytest.mark.parametrize("which", ["odd", "docs", "empty"])
def test_token_counts(which, request):
    df = request.getfixturevalue(which)
    got = {(r.doc_id, r.n_words, r.n_tokens) for r in token_counts.token_counts(df, PIECES).collect()}
    counts = token_counts.piece_counts(df, PIECES)
    model, want = SentencePieceProcessor(model_file=PIECES), Counter()
    for _, t in texts(df):
        for w in WORD.findall(t):
            want.update(model.encode(w, out_type=str))
    assert counts == want
    vocabulary, known = token_counts.Vocabulary(PIECES, counts), {}
    for d, t in texts(df):
        words = WORD.findall(t)
        for w in words:
            if w not in known:
                known[w] = brute_count(vocabulary, w)
        assert (d, len(words), sum(known[w] for w in words)) in got


def test_trie_shares_prefixes():
    vocabulary = token_counts.Vocabulary(PIECES, {"▁inter": 50, "national": 40, "▁": 3, "ly": 9})
    trie = token_counts.Trie(vocabulary, most=40)
    for w in (b"international", b"internationally"):
        trie.count(w)
    assert trie.computed == len("▁internationally")
    for w in (f"word{i}".encode() for i in range(50)):
        assert trie.count(w) == brute_count(vocabulary, w.decode())


def test_long_pretokens(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "DEEP", 5)
    vocabulary = token_counts.Vocabulary(PIECES, {"▁inter": 50, "national": 40, "▁": 3, "ly": 9})
    trie, rng = token_counts.Trie(vocabulary), random.Random(3)
    words = ["".join(rng.choice(["inter", "national", "ly", "x", "é", "的"]) for _ in range(n)) for n in (1, 2, 3, 10, 60, 200)]
    for w in words + words[::-1] + ["y".join(words)]:
        assert trie.count(w.encode()) == brute_count(vocabulary, w)
    assert trie.size < 1 + 5 * 14 + len(words)
    # pieces of a long pre-token are counted run by run, those of others as a whole
    monkeypatch.setattr(token_counts, "RUN", 50)
    monkeypatch.setattr(token_counts, "HELD", 100)
    counts = token_counts.piece_counts(spark.createDataFrame([(w + " and others",) for w in words] + [(None,)], "text string"), PIECES)
    model, want = SentencePieceProcessor(model_file=PIECES), Counter()
    for w in words + ["and", "others"] * len(words):
        for at in range(0, len(w), 50) if len(w.encode()) > 50 else [0]:
            want.update(model.encode(w[at : at + 50], out_type=str))
    assert counts == want


def test_a_long_pretoken_takes_little_memory():
    rng = random.Random(4)
    word = "".join(rng.choice("abcdefghijklmnop") for _ in range(300_000)).encode()
    trie = token_counts.Trie(token_counts.Vocabulary(PIECES, {}))
    tracemalloc.start()
    trie.count(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000 and trie.size <= 1 + token_counts.DEEP


# ---------------------------------------------------------------- 4 exact dedup


@pytest.mark.parametrize("keep_text", [True, False])
def test_exact_dedup(keep_text, odd, docs, empty):
    for df in (odd, docs, empty):
        got = exact_dedup.exact_dedup(df, keep_text).collect()
        groups = defaultdict(list)
        for d, t in texts(df):
            groups[t].append(d)
        by = {d: t for d, t in texts(df)}
        assert len(got) == sum(map(len, groups.values()))
        for r in got:
            g = groups[by[r.doc_id]]
            top = max((d for d in g if d is not None), default=None)
            assert (r.keep_id, r.group_size, r.kept) == (top, len(g), r.doc_id == top)
            assert r.text_sha256 == hashlib.sha256(by[r.doc_id].encode()).hexdigest()


def test_repeated_rows_keep_one(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (0, "x")], "doc_id long, text string")
    for keep in (True, False):
        got = exact_dedup.exact_dedup(df, keep)
        assert got.where("kept").count() == 2 and got.count() == 4


def test_cuckoo_index_inserts_deletes_grows():
    rng, index, live = random.Random(5), exact_dedup.DigestIndex(16), {}
    first = index.bits
    for i in range(20_000):
        d = hashlib.sha256(str(rng.randrange(3_000)).encode()).digest()
        if rng.random() < 0.3:
            assert index.delete(d) == (live.pop(d, None) is not None)
        else:
            index.add(d, i)
            live[d] = [d, i, live.get(d, [d, 0, 0])[2] + 1, 1]
    assert all(index.find(d) == v for d, v in live.items()) and index.live == len(live)
    assert sorted(index) == sorted(live.values()) and index.bits > first


def test_filter_hit_is_verified_against_the_bucket():
    index = exact_dedup.DigestIndex(16)
    a, b = b"\1" * 8 + b"a" * 32, b"\1" * 8 + b"b" * 32  # the same tag and buckets
    index.add(a, 1)
    assert index.find(b) is None and not index.delete(b)
    index.add(b, 2)
    assert index.find(a)[1] == 1 and index.find(b)[1] == 2 and index.delete(a) and index.find(b)[1] == 2


def test_hot_groups_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(300)] + [(299, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for keep in (True, False):
        got = exact_dedup.exact_dedup(df, keep).collect()
        assert len(got) == 301 and sum(r.kept for r in got) == 101
        assert {(r.keep_id, r.group_size) for r in got if r.doc_id % 3} == {(299, 201)}


# ---------------------------------------------------------------- 5 n-gram join


def brute_components(pairs, n, percent):
    sets = {}
    for d, t in pairs:
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in WORD.findall(t)]
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    forest = components.Forest()
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                forest.join(a, b)
    return {d: (len(sets[d]), forest.find(d)) for d in ids}


def near_copies(seed, groups, copies):
    rng, out, i = random.Random(seed), [], 1000
    for g in range(groups):
        base = [f"{rng.choice('abcdefg')}{rng.randrange(300)}" for _ in range(rng.choice([8, 15, 40, 120, 300]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                p = rng.randrange(len(w))
                w[p : p + 1] = rng.choice([[], ["new"], [w[p], "in"]]) or ["x"]
            out.append((i, " ".join(w)))
            i += 1
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(n, percent, spark, odd, docs, monkeypatch):
    rows = near_copies(n, 8, 25) + [x for x in texts(odd) if x[0] is not None] + [(d + 5000, t) for d, t in texts(docs.limit(60))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, n, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df, n, percent).collect()}
    assert got == want
    monkeypatch.setattr(ngram_join, "CELL", 6)  # large groups meet in cells of two blocks
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df, n, percent).collect()}
    assert got == want


def test_ngram_join_edges(odd, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(odd).collect()}
    assert got[2] == (0, 2) and got[3] == (0, 3) and got[None][1] == 10 and got[11][1] == 10 and len(got) == odd.count()
    assert ngram_join.ngram_join(empty).count() == 0


def test_linked_sets_share_a_key_and_sketches_bound():
    rng = np.random.default_rng(9)
    for percent in (80, 90):
        join = ngram_join.Join(percent)
        for n in [1, 4, 5, 9, 10, 13, 40, 333, 2500] * 6:
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            cut = rng.integers(0, n + 1)
            b = np.concatenate([a[cut // 8 :], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 6))).astype(np.uint64)])
            both = len(np.intersect1d(a, b))
            apart = int(np.bitwise_count(ngram_join.sketch(a) ^ ngram_join.sketch(b)).sum())
            assert apart <= len(a) + len(b) - 2 * both
            if len(b) and join.linked(both, len(a), len(b)) and not (both == n == len(b)):
                assert len(np.intersect1d(join.keys(a), join.keys(b)))
            if len(a) and len(b):
                x, y = ngram_join.sketch(a), ngram_join.sketch(b)
                words = min(len(x), len(y))
                assert (ngram_join.fold(x[None], words)[0] == ngram_join.sketch(a, words)).all()
                assert np.bitwise_count(ngram_join.fold(x[None], words) ^ ngram_join.fold(y[None], words)).sum() <= len(a) + len(b) - 2 * both


def test_linked_sets_agree_beyond_common_and_empty_parts():
    rng = np.random.default_rng(4)
    join = ngram_join.Join(80)
    for n in [4, 9, 13, 40, 333] * 8:
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[n // 12 :], rng.integers(0, 1 << 63, n // 12).astype(np.uint64)])
        if join.linked(len(np.intersect1d(a, b)), len(a), len(b)) and len(np.intersect1d(a, b)) < n:
            same = np.intersect1d(join.keys(a), join.keys(b))
            assert max(np.bincount((same & np.uint64(63)).astype(int))) > ngram_join.COMMON


def test_common_line_in_many_texts(spark, monkeypatch):
    """A line that all texts share makes keys of large groups; links are still found and no others."""
    monkeypatch.setattr(ngram_join, "CELL", 8)
    rng = random.Random(8)
    line = "all rights reserved by the author of this work and no part may be copied"
    rows = []
    for i in range(60):
        own = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 20])))
        rows.append((2 * i, f"{line} {own}"))
        if i % 3 == 0:
            rows.append((2 * i + 1, f"{line} {own} more"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, percent in ((3, 90), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df, n, percent).collect()}
        assert got == brute_components(rows, n, percent)


def test_names_that_different_ones_share(spark, docs, monkeypatch):
    """With names of a few bits most are shared at first; those get others, and results stay."""
    want = sorted(map(repr, ngram_join.ngram_join(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id").collect()))
    gone = substring_dedup.substring_dedup(docs.select("doc_id", "text")).agg(F.sum("n_removed")).first()[0]
    monkeypatch.setattr(common, "NAME_BITS", 5)
    keyed = common.with_row_key(docs, "k")
    assert keyed.select("k").distinct().count() == docs.select("doc_id", "text").distinct().count()
    assert sorted(map(repr, ngram_join.ngram_join(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id").collect())) == want
    assert substring_dedup.substring_dedup(docs.select("doc_id", "text")).agg(F.sum("n_removed")).first()[0] == gone


def test_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (None, text + " x"), (5, text + " y z"), (None, "other words that stand alone here"), (7, "short"), (8, None), (None, "short short short short short short")]
    got = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row")).collect()
    assert len(got) == 5 and sum(r.text is not None and r.text.startswith("w0") for r in got) == 1 and all(r.row == 1 for r in got)


def test_components(spark):
    rng, forest, edges = random.Random(2), components.Forest(), []
    for _ in range(300):
        a, b = rng.randrange(400), rng.randrange(400)
        edges.append((a, b))
        forest.join(a, b)
    edges += [(i, i + 1) for i in range(1000, 1100)]
    for i in range(1000, 1100):
        forest.join(i, i + 1)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()}
    assert got == {x: forest.find(x) for e in edges if e[0] != e[1] for x in e}


# ---------------------------------------------------------------- 6 sharding


def test_sharding(odd, docs, empty, spark):
    for df, limit in ((docs, 60_000), (docs, 4_000), (odd, 1_000), (empty, 10)):
        got = sharding.shard(df, limit, bits=4).collect()
        assert len(got) == df.count()
        sums = Counter()
        for r in got:
            sums[r.shard] += r.bytes
        for r in got:
            assert r.shard_bytes == sums[r.shard] and (sums[r.shard] <= limit or r.shard_rows == 1)
        splits = {r.shard for r in got}
        assert not any(a != b and b.startswith(a) for a in splits for b in splits)  # no bucket holds another
    same = spark.createDataFrame([(7, "x" * 10)] * 30, "doc_id long, text string")
    assert all(r.shard_bytes <= 40 for r in sharding.shard(same, 40, bits=30).collect())


@pytest.mark.parametrize("sizes", [[45, 90], [45, 45, 45, 90, 51, 50, 50, 1, 0, 0, 100], [130, 20, 20], [100] * 40])
def test_overflow_pages_fit(sizes, spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_PAGES", 4)
    df = spark.createDataFrame([(7, "x" * n) for n in sizes] + [(8, "y")], "doc_id long, text string")
    got = sharding.shard(df, 100, bits=30).collect()
    sums, rows = Counter(), Counter()
    for r in got:
        sums[r.shard] += r.bytes
        rows[r.shard] += 1
    assert len(got) == len(sizes) + 1
    assert all(sums[r.shard] == r.shard_bytes and rows[r.shard] == r.shard_rows and (r.shard_bytes <= 100 or r.shard_rows == 1) for r in got)


# ---------------------------------------------------------------- 7 substring dedup


def brute_removed(pairs, window):
    words = [(d, WORD.findall(t)) for d, t in pairs]
    seen = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("window", [35, 6])
def test_substring_dedup(window, spark, odd, docs, empty):
    rng = random.Random(window)
    passage = [f"p{i}" for i in range(60)]
    planted = []
    for i in range(40):
        w = [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(80))]
        a = rng.randrange(0, 30)
        b = rng.randrange(a, 61)
        at = rng.randrange(len(w) + 1)
        planted.append((9000 + i, " ".join(w[:at] + passage[a:b] + w[at:])))
    for df in (spark.createDataFrame(planted, "doc_id long, text string"), odd, docs, empty):
        got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(df, window).collect())
        assert got == brute_removed(texts(df), window)


def test_factors_stand_in_their_reference(docs, odd):
    """Each factor is at least a window long, its words stand where it points, and only factors' words go."""
    for df in (docs, odd):
        rows = substring_dedup.substring_dedup(df).collect()
        words = {r.row_key: WORD.findall(r.text or "") for r in rows}
        assert any(r.factors for r in rows)
        for r in rows:
            gone = set()
            for f in r.factors:
                n = f.end - f.start
                assert n >= 35 and words[r.row_key][f.start : f.end] == words[f.ref][f.ref_start : f.ref_start + n]
                gone |= set(range(f.start, f.end))
            assert r.n_removed == len(gone)
            starts = [f.start for f in r.factors]
            assert starts == sorted(set(starts)) and [f.end for f in r.factors] == sorted({f.end for f in r.factors})


def test_removal_rests_on_the_parse(docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "WINDOW", 35)
    got = substring_dedup.matches(common.with_row_key(docs, "key").select("key", "text"), 35).collect()
    assert got
    for r in got:
        cols = [np.array([getattr(x, c) for x in r.pieces], np.int64) for c in ("start", "end", "ref", "ref_start")]
        covered = set().union(*(range(a, b) for a, b in zip(cols[0].tolist(), cols[1].tolist())))
        parsed = substring_dedup.parse(*cols)
        assert set().union(*(range(a, b) for a, b in parsed[:, :2].tolist())) == covered and len(parsed) <= len(r.pieces)


def test_parse_joins_and_takes_the_longest():
    f = lambda *rows: substring_dedup.parse(*np.array(rows, np.int64).T).tolist()
    assert f((0, 40, 7, 100), (20, 60, 7, 120), (60, 100, 7, 160)) == [[0, 100, 7, 100]]
    assert f((0, 40, 7, 100), (0, 60, 8, 5), (50, 95, 9, 0), (200, 240, 7, 0)) == [[0, 60, 8, 5], [50, 95, 9, 0], [200, 240, 7, 0]]
    assert f((0, 40, 7, 100), (10, 50, 8, 0), (45, 90, 7, 3)) == [[0, 40, 7, 100], [10, 50, 8, 0], [45, 90, 7, 3]]


# ---------------------------------------------------------------- 8 mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 300) == [187.5, 75, 37.5]
    got = mixing.targets([10, 1000, 1000], [5, 2, 1], 2010)
    assert got[0] == 30 and abs(sum(got) - 2010) < 1e-9 and abs(got[1] / got[2] - 2) < 1e-9
    assert mixing.targets([], [], 0) == [] and mixing.targets([0], [5], 0) == [0.0]


def test_split_quotas_are_exact():
    quotas = np.array([5, 0, 100, 7_000])
    got = mixing.split_quotas(quotas, 7, np.random.default_rng(1))
    assert got.shape == (7, 4) and (got.sum(0) == quotas).all() and (got >= 0).all()
    assert np.ptp(got.sum(1)) <= 7


@pytest.mark.parametrize("which", ["odd", "docs", "empty"])
def test_mixing(which, request):
    df = request.getfixturevalue(which)
    got = mixing.taken(df).collect()
    assert sorted(got, key=str) == sorted(mixing.taken(df).collect(), key=str)
    size = Counter()
    for d, t in texts(df):
        size[d] += len(WORD.findall(t))
    sources = {r.doc_id: r.source for r in df.collect()}
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        assert r.size == size[r.doc_id] and 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        s = sources[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] + 1
    assert len(got) == df.count()
    mixed = mixing.mix(df).collect()
    drawn, places = Counter(r.doc_id for r in mixed), defaultdict(list)
    for r in mixed:
        places[r.doc_id].append(r.mix_shard)
    for r in got:
        assert drawn[r.doc_id] * r.size == r.taken and sorted(places[r.doc_id]) == r.mix_shards


def test_mixing_keeps_repeated_rows(spark):
    rows = [(1, "a b c", "s")] * 4 + [(1, "a b d", "s"), (1, None, None), (None, "x y", "t"), (None, "x y", "t")]
    got = mixing.taken(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 8 and len({r.taken for r in got if r.size == 3 and r.doc_id == 1}) <= 2


def test_shards_draw_their_quotas(docs, monkeypatch):
    """Every draw is one of a shard: what the tree gives no shard isn't taken, and shards hold what it gives them."""
    split, seen = mixing.split_quotas, []

    def spy(quotas, shards, rng):
        out = split(quotas, shards, rng)
        if shards == 5:
            seen.append(out)
        return out

    monkeypatch.setattr(mixing, "split_quotas", spy)
    plan_ = mixing.plan(docs.selectExpr("doc_id", "source", "cast(n_chars as long) as size", "xxhash64(text) as __text"), [
        mixing.Source(s, n, n * 9, n * 9.0, 7) for s, n in sorted(docs.groupBy("source").count().collect())], 5, 3).collect()
    got = Counter((d.shard, r["__source"]) for r in plan_ for d in r["__draws"])
    assert {(i, j): n for (i, j), n in np.ndenumerate(seen[-1]) if n} == got
    monkeypatch.setattr(mixing, "split_quotas", lambda quotas, shards, rng: np.zeros((shards, len(quotas)), np.int64))
    assert all(r.taken == 0 and r.mix_shards == [] for r in mixing.taken(docs).collect())


def test_shards_are_shuffled_locally(docs):
    mixed = mixing.mix(docs, shards=3)
    parts = mixing.shuffled(mixed, 4).rdd.glom().collect()
    order = [(r.mix_shard, r.mix_order) for p in parts for r in p]
    assert order == sorted(order) and len(order) == mixed.count() and {s for s, _ in order} == {0, 1, 2}


# ---------------------------------------------------------------- 9 token output


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5_000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 20, n), rng.zipf(1.3, n) % 50_000, np.zeros(n, int), np.tile([7, 8, 9], n)[:n]):
        block = token_output.encode(ids)
        assert (token_output.decode(block) == ids).all()
    if n > 1_000:
        assert len(token_output.encode(np.tile([7, 8, 9], n)[:n])) < n


def test_coder_refuses_damage():
    block = bytearray(token_output.encode(np.arange(300)))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        token_output.decode(bytes(block))


def test_places_are_found_by_the_guide():
    rng = np.random.default_rng(2)
    for size in (1, 2, 7, 1_000, 50_000):
        model = token_output._Model(size, 1)
        model.count += np.where(rng.random(size) < 0.1, rng.integers(0, 3_000, size), 0)
        model._sum()
        places = np.concatenate([np.floor(rng.random(5_000) * model.total), model.cum[:-1], model.cum[1:] - 1])
        assert (model._holding(places) == np.searchsorted(model.cum[1:], places, side="right")).all()


@pytest.mark.parametrize("which", ["odd", "docs", "empty"])
def test_token_output(which, request, spark, tmp_path):
    df = request.getfixturevalue(which)
    path = f"file://{tmp_path}/ids"
    token_output.write_ids(df, path, BYTE_BPE)
    got = token_output.read_ids(spark, path, with_ids=True).collect()
    tokens, start, want = common.PieceTokenizer(BYTE_BPE), 0, []
    for d, t in sorted(texts(df), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = tokens.whole(t) + bytes(4)
        want.append((d, start, len(ids) // 4, zlib.crc32(ids), ids))
        start += len(ids) // 4
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got) == Counter(want)


# ---------------------------------------------------------------- 10 language id


def test_language_id_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    known = language_id.learn(df.where("not held_out"))
    got = language_id.language_id(df.where("held_out"), known).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert np.mean([r.lang_rejected for r in got]) < 0.02 and all(0 <= r.score <= 1 for r in got)


def test_language_id_edges(odd, empty, docs):
    known = language_id.learn(docs)
    got = {r.doc_id: r for r in language_id.language_id(odd, known).collect()}
    assert len(got) == odd.count()
    for d in (2, 3, 4, 13):
        assert got[d].lang_pred == "und" and got[d].score == 0 and got[d].lang_rejected
    numbers = df_numbers(odd.sparkSession)
    assert {r.lang_pred for r in language_id.language_id(numbers, known).collect()} == {"und"}
    assert language_id.language_id(empty, known).count() == 0
    assert language_id.learn(empty) == {}
    assert {r.lang_pred for r in language_id.language_id(odd, {}).collect()} == {"und"}


def df_numbers(spark):
    """Word characters that aren't letters."""
    return spark.createDataFrame([(i, x) for i, x in enumerate("½ ² ① Ⅷ ٣ _ 〇".split())], "doc_id long, text string")


def test_a_small_language_leaves_the_others_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    known = language_id.learn(docs.where("not held_out"))

    def accuracy(models):
        got = language_id.language_id(docs.where("held_out"), models).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.avg(F.col("lang_rejected").cast("double"))).first()
        return np.array(got)

    before = accuracy(known)
    for n in (1, 20, 200):
        more = spark.range(n).selectExpr("-1 - id as doc_id", "concat('sana', repeat(char(97 + id % 26), 1 + id div 26)) as text", "'fi' as lang")
        models = language_id.learn(docs.where("not held_out").select("doc_id", "text", "lang").unionByName(more))
        assert models.pop("fi") and models == known
        models = language_id.learn(docs.where("not held_out").select("doc_id", "text", "lang").unionByName(more))
        assert np.abs(accuracy(models) - before).max() < 0.005


def test_passages_come_from_whole_texts(spark):
    rows = [(i, "x" * 3000 + f" abcdefgh{chr(97 + i % 26)}{chr(97 + i // 26)} " + "y" * 3000, "l") for i in range(60)]
    known = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert b"x" in known["l"] and b"y" in known["l"]


def test_copies_count_once(spark):
    rows = [(i, f"copy of text {'abcdefghij'[i % 10]}", "l") for i in range(2000)]
    known = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert known["l"].count(b"copy") == 10
