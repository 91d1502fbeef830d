"""Snapshot difference, centroid clustering and WARC against brute force and SQL, and on the edge cases."""

import gzip
import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from statloom.llm import clustering, queries, snapshot, warc

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_snapshot_diff", "op12_ball_kmeans", "op13_warc"])
def test_equals_sql(name, spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})")
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, cursor.fetchall()))


# ---------------------------------------------------------------- 11 snapshot difference


def diff(old, new):
    """By definition, rows of (key, text, lang): equal keys pair in the order of the contents' digests, then equal contents in that of keys."""
    sha256 = lambda v: "~" if v is None else hashlib.sha256(v.encode()).hexdigest()

    out, left = [], [[], []]
    keyed = [defaultdict(list), defaultdict(list)]
    for side, rows in enumerate((old, new)):
        for r in rows:
            keyed[side][r[0]].append(r)
    for key in {*keyed[0], *keyed[1]}:
        a, b = (sorted(keyed[s].get(key, []), key=lambda r: sha256(",".join(map(sha256, r[1:])))) for s in (0, 1))
        for x, y in zip(a, b, strict=False):
            changed = ",".join(c for c, p, q in zip(("text", "lang"), x[1:], y[1:], strict=True) if p != q)
            out.append((key, key, "update" if changed else "same", changed, y))
        left[0] += a[len(b) :]
        left[1] += b[len(a) :]
    content = [defaultdict(list), defaultdict(list)]
    for side in (0, 1):
        for r in left[side]:
            content[side][r[1:]].append(r)
    for c in {*content[0], *content[1]}:
        a, b = (sorted(content[s].get(c, []), key=lambda r: (r[0] is not None, r[0] or 0)) for s in (0, 1))
        out += [(y[0], x[0], "rekey", "", y) for x, y in zip(a, b, strict=False)]
        out += [(x[0], x[0], "delete", "", None) for x in a[len(b) :]]
        out += [(y[0], None, "insert", "", y) for y in b[len(a) :]]
    sha = lambda r: r and hashlib.sha256("\n".join("~" if v is None else v for v in r[1:]).encode()).hexdigest()
    return sorted(map(repr, [(k, o, op, c, sha(r)) for k, o, op, c, r in out]))


def found(df):
    return sorted(map(repr, map(tuple, df.select("key", "old_key", "op", "changed", "row_sha256").collect())))


def frames(spark, *sides):
    return [spark.createDataFrame(rows, "id long, text string, lang string").selectExpr("*", "'x' as key", "1 as side", "2 as d0") for rows in sides]


@pytest.mark.parametrize("chunk", [3, 40, 50_000])
def test_diff_by_definition(chunk, spark):
    rng = random.Random(chunk)
    texts = ["", "a", None, "same", "same", "same", "b" * 50_000]

    def rows(n):
        return [(rng.choice([None, *range(-20, 60)]), rng.choice(texts), rng.choice(["en", None, "de"])) for _ in range(n)]

    old, new = rows(150), rows(170)
    a, b = frames(spark, old, new)
    assert found(snapshot.snapshot_diff(a, b, "id", ["text", "lang"], chunk)) == diff(old, new)


@pytest.mark.parametrize("chunk", [7, 50_000])
def test_hot_key_and_hot_content_are_dealt_out(chunk, spark):
    old = [(5, f"t{i}", "en") for i in range(90)] + [(100 + i, "copy", None) for i in range(120)] + [(1_000 + i, f"u{i}", "x") for i in range(40)]
    old += [(None, None, None)] * 70
    new = [(None, None, None)] * 60 + [(5, f"t{i + 3}", "en") for i in range(80)] + [(-100 - i, "copy", None) for i in range(100)] + [(1_000 + i, f"u{i}", "x") for i in range(40)]
    a, b = frames(spark, old, new)
    assert found(snapshot.snapshot_diff(a, b, "id", ["text", "lang"], chunk)) == diff(old, new)


def test_diff_edges(spark, odd, empty):
    columns = ["text", "lang", "source"]
    assert {r.op for r in snapshot.snapshot_diff(odd, odd, "doc_id", columns).collect()} == {"same"}
    gone = snapshot.snapshot_diff(odd, empty, "doc_id", columns).collect()
    assert {(r.op, r.row_sha256) for r in gone} == {("delete", None)} and len(gone) == odd.count()
    assert {r.op for r in snapshot.snapshot_diff(empty, odd, "doc_id", columns).collect()} == {"insert"}
    assert snapshot.snapshot_diff(empty, empty, "doc_id", columns).count() == 0
    named = [df.withColumn("doc_id", F.concat(F.lit("k"), "doc_id")) for df in (odd, odd.where("doc_id <> 3"))]
    assert {r.op for r in snapshot.snapshot_diff(*named, "doc_id", ["text"]).collect()} == {"same", "delete"}


def test_open_rows_follow_the_partitions(spark, monkeypatch):
    """Groups over several partitions are open, and only those at an edge."""
    seen = []
    true = snapshot._resolve
    monkeypatch.setattr(snapshot, "_resolve", lambda rows, *a: seen.append([r.gid for r in rows.collect()]) or true(rows, *a))
    a, b = frames(spark, [(i, "copy", None) for i in range(400)], [(-i - 1, "copy", None) for i in range(400)])
    assert found(snapshot.snapshot_diff(a, b, "id", ["text", "lang"])) == diff([(i, "copy", None) for i in range(400)], [(-i - 1, "copy", None) for i in range(400)])
    by_key, by_content = seen
    assert len(by_content) == 800 and len(by_key) <= 4 * 2


# ---------------------------------------------------------------- 12 centroid clustering


def lloyd(ids, vectors, k, rounds, seed):
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"{seed}:{ids[i]}".encode()).hexdigest(), vectors[i].tolist()))[:k]
    centroids = vectors[order].copy()
    for t in range(rounds + 1):
        d = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
        who = d.argmin(1)
        if t < rounds:
            for j in range(len(centroids)):
                if (who == j).any():
                    centroids[j] = vectors[who == j].sum(0) // int((who == j).sum())
    return who, d.min(1), centroids


@pytest.mark.parametrize(("k", "rounds", "spread"), [(16, 3, 1.0), (5, 6, 0.05), (7, 2, 0.0), (40, 4, 3.0)])
def test_clusters_by_definition(k, rounds, spread, spark):
    rng = np.random.default_rng(k)
    centres = rng.normal(size=(6, 8))
    x = np.repeat(centres, 60, 0) + spread * rng.normal(size=(360, 8))
    x[::3] = x[0]  # a vector that a third of the rows share
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = sorted(map(tuple, clustering.cluster(df, k, rounds, dimensions=8).collect()))
    v = np.array([[math.floor(64 * c) for c in r] for _, r in rows])
    who, dist, centroids = lloyd(range(len(v)), v, k, rounds, 1)
    inertia = [int(dist[who == j].sum()) for j in range(len(centroids))]
    want = [(i, int(j), int(d), inertia[j], int(dist.sum()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, (j, d) in enumerate(zip(who, dist, strict=True))]
    assert got == want


def test_balls_look_at_neighbours_only():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-2_000, 2_000, (50, 4))
    member = np.repeat(np.arange(50), 40)
    vectors = centroids[member] + rng.integers(-150, 150, (2_000, 4))
    own = ((vectors - centroids[member]) ** 2).sum(1)
    radius = np.array([own[member == j].max() for j in range(50)])
    new, dist, looked = clustering.Balls(centroids, radius).assign(vectors, member)
    full = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (new == full.argmin(1)).all() and (dist == full.min(1)).all()
    assert looked < 0.1 * full.size
    # a ball without known members: all others are its neighbours, and the bound on distance alone decides
    new, dist, _ = clustering.Balls(centroids, np.full(50, clustering.FAR)).assign(vectors, np.zeros(2_000, np.int64))
    assert (new == full.argmin(1)).all() and (dist == full.min(1)).all()


def test_ties_go_to_the_smaller_number():
    centroids = np.array([[10, 0], [-10, 0], [0, 10], [10, 0]])
    balls = clustering.Balls(centroids, np.full(4, clustering.FAR))
    for start in range(4):
        new, _, _ = balls.assign(np.array([[0, 0], [10, 0], [-1, 0]]), np.full(3, start))
        assert new.tolist() == [0, 0, 1]


def test_clusters_edges(spark):
    good = [0.5, -0.25]
    rows = [(1, good), (1, good), (None, [0.1, 0.1]), (2, None), (3, []), (4, [0.5]), (5, [0.5, None]), (6, [float("nan"), 0.0]), (7, [float("inf"), 0.0]), (8, [1e30, 0.0]), (9, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as cluster", "2 as v", "3 as distance")
    got = clustering.cluster(df, k=4, dimensions=2).collect()
    assert sorted((r.vec_id is None, r.cluster, r.distance) for r in got) == [(False, 0, 0), (False, 0, 0), (True, 2, 0)]
    assert {r.inertia for r in got} == {0}
    none = clustering.cluster(df.limit(0), dimensions=2)
    assert none.count() == 0 and none.columns == clustering.cluster(df, k=4, dimensions=2).columns
    assert clustering.cluster(df.where("vec_id = 2"), dimensions=2).count() == 0
    far = spark.createDataFrame([(1, [1e6, -1e6]), (2, [-1e6, 1e6])], "vec_id long, embedding array<double>")
    one = clustering.cluster(far, k=1, dimensions=2).collect()
    assert [r.distance for r in one] == [2 * 64_000_000**2] * 2


# ---------------------------------------------------------------- 13 WARC

PAGES = [
    (3, "http://a/", "<p>one</p>"),
    (1, "http://b/ x", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (4, "http://c/", None),
    (5, "http://d/", ""),
    (6, "http://é/", "naïve — テキスト"),
    (None, "http://e/", "<p>one</p>"),
    (None, "http://f/", "alone"),
    (7, "http://g/", "x" * 300_000),
    (8, "http://h/\r\nWARC-Type: fake", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (1, "http://b/ x", "<p>one</p>"),
    (-9, "http://i/", "minus"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' as payload", "1 as file").repartition(3)


@pytest.mark.parametrize(("least", "split"), [(0, 1 << 22), (0, 61), (8, 200), (1_000_000, 997)])
def test_warc_round_trip(least, split, pages, spark, tmp_path):
    path = f"file://{tmp_path}/w"
    files = warc.write_warc(pages, path, least)
    firsts = {}
    for i, _, h in PAGES:
        if i is not None and len((h or "").encode()) >= least:
            firsts[h or ""] = min(i, firsts.get(h or "", i))
    want = []
    for i, _, h in PAGES:
        data, first = (h or "").encode(), firsts.get(h or "")
        revisit = first is not None and i != first
        want.append((i, len(data), warc.payload_digest(data), "revisit" if revisit else "response", first if revisit else None))
    for given in (files, None):
        got = warc.read_warc(spark, path, given, split, with_payload=True).collect()
        assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
        payloads = sorted((r.page_id or 0, bytes(r.payload)) for r in got if r.record_type == "response")
        assert payloads == sorted((w[0] or 0, (h or "").encode()) for w, (_, _, h) in zip(want, PAGES, strict=True) if w[3] == "response")
        assert {r.url for r in got if r.page_id in (2, 8)} == {"urn:unknown", "http://h/ WARC-Type: fake"}


def test_archives_are_plain_gzip(pages, spark, tmp_path):
    warc.write_warc(pages, f"file://{tmp_path}/w")
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("*.warc.gz")))
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES) and not list((tmp_path / "w").glob(".draft*"))


def test_false_members(spark, tmp_path):
    """Magic within data, members within a stored payload, members that aren't whole, several records in a member, other files' members."""
    inner = warc.member(99, "http://inner/", b"nested " * 40, None, False)

    def stored(record):
        z = zlib.compressobj(0, zlib.DEFLATED, 31)
        return z.compress(record) + z.flush()

    payload = b"junk" + warc.MAGIC + b"\x00" * 30 + inner * 3
    outer = stored(gzip.decompress(warc.member(1, "http://outer/", payload, None, False)))
    assert inner in outer
    two = gzip.compress(gzip.decompress(warc.member(2, "http://two/", b"2", None, False)) + gzip.decompress(warc.member(3, "http://three/", b"3", None, False)))
    other = gzip.compress(b"not a record " * 50)
    info = gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")
    torn = warc.member(4, "http://torn/", random.Random(1).randbytes(400), None, False)[:-20]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(info + outer + other + two + outer + torn)
    (tmp_path / "w" / "empty.warc.gz").write_bytes(b"")
    for split in (1 << 20, 300, 64, 17):
        got = warc.read_warc(spark, f"file://{tmp_path}/w", None, split).collect()
        assert sorted((r.record_type, r.page_id or 0, r.payload_bytes) for r in got) == [("response", 1, len(payload)), ("response", 1, len(payload)), ("response", 2, 1), ("response", 3, 1), ("warcinfo", 0, 5)], split


def test_every_range_owns_what_starts_in_it(tmp_path):
    members = [warc.member(i, f"http://{i}/", random.Random(i).randbytes(5 * i), None, False) for i in range(60)]
    (tmp_path / "x").write_bytes(b"".join(members))
    starts = np.cumsum([0, *map(len, members)])
    with pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "x")) as f:
        source = warc.Source(f, f.size())
        for a, b in ((0, 1), (1, 400), (int(starts[7]), int(starts[9])), (int(starts[7]) + 1, int(starts[9]) + 1), (500, f.size())):
            assert [r[0] for r in warc.scan(source, a, b)] == [s for s in starts[:-1].tolist() if a <= s < b]


def test_damaged_payload_is_an_error(spark, tmp_path):
    record = gzip.decompress(warc.member(1, "u", b"payload", None, False)).replace(b"payload\r\n", b"pbyload\r\n")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc.gz").write_bytes(gzip.compress(record))
    with pytest.raises(Exception, match="isn't what its digest says"):
        warc.read_warc(spark, f"file://{tmp_path}/w").collect()


def test_warc_of_nothing(pages, spark, tmp_path):
    files = warc.write_warc(pages.limit(0), f"file://{tmp_path}/w")
    assert warc.read_warc(spark, f"file://{tmp_path}/w", files).count() == 0
    assert warc.read_warc(spark, f"file://{tmp_path}/nowhere").count() == 0


def test_frequent_payload_is_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc.common, "HOT_ROWS", 20)
    df = spark.createDataFrame([(i, "u", "same" if i % 3 else str(i)) for i in range(300)], "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_warc(spark, path, warc.write_warc(df, path)).collect()}
    assert got == {i: ("revisit", 1) if i % 3 and i != 1 else ("response", None) for i in range(300)}
