"""Steps whose work grew with the square of the tables, or that a whole group passed through."""

import numpy as np

from statloom.llm import sharding
from statloom.operators import assoc, kinship, ranges, ranks, relatives, selection


def test_lookup_meets_first_variants_only(spark):
    """A probe met every variant of the panel with its keys."""
    rng = np.random.default_rng(1)
    letters = "ACGT"
    panel = [(i, i % 2, letters[a], letters[b]) for i, (a, b) in enumerate(rng.integers(0, 4, (200, 2)))] + [(None, 0, "A", "C"), (500, None, "A", "C"), (501, 1, None, "C")]
    probes = [(n, n % 3, letters[a], letters[b]) for n, (a, b) in enumerate(rng.integers(0, 4, (60, 2)))] + [(60, None, "A", "C"), (61, 1, None, "C")]
    out = selection.lookup(spark.createDataFrame(probes, "n int, k int, a1 string, a2 string"), spark.createDataFrame(panel, "idx int, k int, a1 string, a2 string"), ["k"], "n")
    want = {}
    for n, k, a, b in probes:
        hits = [(i, 1 if (c, d) == (a, b) else -1) for i, q, c, d in panel if None not in (i, q, k, a, c) and q == k and (c, d) in ((a, b), (b, a))]
        want[n] = min(hits, default=(-1, 0))
    assert {r.n: (r.idx, r.flip) for r in out.collect()} == want
    assert len({v[1] for v in want.values()}) == 3
    joined = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joined) == 1 and joined[0].count("a1#") and joined[0].count("a2#")


def test_least_within_makes_no_pairs(spark):
    """every pair within the window was made."""
    rng = np.random.default_rng(2)
    rows = [(int(c), int(p), None if v < 0.1 else float(v)) for c, p, v in zip(rng.integers(0, 2, 150), rng.integers(-40, 90, 150), rng.random(150), strict=True)]
    df = spark.createDataFrame(rows, "chr int, pos long, v double")
    got = ranges.least_within(df, "chr", "pos", "v", 7)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {(c, p): min((v for d, q, v in rows if d == c and abs(p - q) < 7 and v is not None), default=None) for c, p, _ in rows}
    assert {(r.chr, r.pos): r.least for r in got.collect()} == want


def test_ranks_from_counts_of_values(spark):
    """F16: a group's rows were put in order by one task, and rows of one value were held by it."""
    rows = [(i, g, x) for i, (g, x) in enumerate([("a", 2.0), ("a", 2.0), ("a", 1.0), ("a", None), (None, 3.0), (None, 3.0), ("b", 0.0), ("b", -0.0), ("b", float("nan"))])]
    df = spark.createDataFrame(rows, "i int, g string, x double")
    got = ranks.with_average_rank(df, "x", "g")
    want = {r.i: r.r for r in df.select("i", ranks.average_rank("x", "g").alias("r")).collect()}
    assert {r.i: r.r for r in got.collect()} == want == {0: 2.5, 1: 2.5, 2: 1.0, 3: None, 4: 1.5, 5: 1.5, 6: 1.5, 7: 1.5, 8: 3.0}


def test_few_cells_whatever_the_depth(spark):
    """shallow buckets listed 2**16 cells each, all of which went through the driver."""
    assert sharding._cell_depth({12: 3_000, 13: 9_000, 20: 2}) == 14 and sharding._cell_depth({0: 1}) == 0 and sharding._cell_depth({}) == 0
    rows = [(n, "x" * (900 if n < 2 else 20)) for n in range(300)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 1_000).collect()
    plain = {r.doc_id: r for r in out}
    assert len(out) == len(plain) == 300 and len({r.shard_depth for r in out}) > 1
    sharding.CELLS, kept = -10_000, sharding.CELLS  # buckets below the cells' level, and no broadcast
    try:
        again = {r.doc_id: r for r in sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 1_000).collect()}
    finally:
        sharding.CELLS = kept
    assert again == plain


def test_large_families_turn_by_panels(spark, monkeypatch):
    """a row for each pair of a family's members was joined with every vector."""
    monkeypatch.setattr(relatives, "PANEL", 8 * 20 * 7)  # panels of seven rows
    monkeypatch.setattr(relatives, "VECTORS", 2)
    rng = np.random.default_rng(3)
    n, big = 26, 20
    k = np.eye(n)
    k[:big, :big] += 0.3 * np.cov(rng.normal(size=(big, 40)))
    k[big, big + 1] = k[big + 1, big] = 0.4
    v = rng.normal(size=(5, n))
    i, j = np.nonzero(np.tril(k))
    edges = spark.createDataFrame([(int(a), int(b), float(k[a, b])) for a, b in zip(i, j, strict=True)], "i long, j long, grm double")
    values = spark.createDataFrame([(a, b, float(v[a, b])) for a in range(5) for b in range(n) if (a, b) != (1, 3)], "name int, iid long, v double")
    v[1, 3] = 0.0
    turn, lam = relatives.rotation(edges, relatives.families(edges))
    assert turn.pairs.count() == 4 + 4 and turn.panels.count() == 3
    got = {(r["name"], r.row): r.v for r in relatives.rotated(values, turn, "name", "v").collect()}
    lam = {r.row: r.lam for r in lam.collect()}
    assert len(got) == 5 * n and len(lam) == n
    u = np.array([[got[a, b] for b in range(n)] for a in range(5)])
    assert np.allclose(u @ np.diag([lam[b] for b in range(n)]) @ u.T, v @ k @ v.T) and np.allclose(u @ u.T, v @ v.T)


def test_studies_at_once(spark, monkeypatch):
    """every cohort filtered and read all tables anew."""
    from statloom.operators import blocks

    monkeypatch.setattr(blocks, "ROWS", 2)
    monkeypatch.setattr(blocks, "COLS", 3)
    rng = np.random.default_rng(5)
    at = [(s, 100 * s + i) for s in (0, 3) for i in range(9)]
    g = spark.createDataFrame([(s, f"v{v}", i, float(rng.integers(0, 3))) for s, i in at for v in range(5) if (s, v) != (3, 1)], "study int, variant string, iid long, g double")
    y = spark.createDataFrame([(s, p, i, float(rng.normal())) for s, i in at for p in range(3) if (s, p) != (0, 2)], "study int, phenotype int, iid long, y double")
    c = spark.createDataFrame([(s, i, [float(rng.normal())]) for s, i in at if i != 4], "study int, iid long, c array<double>")
    got = {(r.study, r.variant, r.phenotype): r for r in assoc.studies(g, y, c, 1).collect()}
    n = 0
    for s in (0, 3):
        for r in assoc.study(*(df.where(f"study = {s}").drop("study") for df in (g, y, c)), 1).collect():
            own, n = got[s, r.variant, r.phenotype], n + 1
            assert own.n == r.n and all(np.allclose(own[f], r[f]) for f in ("a_cov", "a_test", "b_cov", "c_yy", "b4", "af"))
    assert len(got) == n == 5 * 2 + 4 * 3


def test_samples_are_deconvolved_together(spark):
    """a call of Python a sample, with a least-squares solution a round."""
    import pandas as pd

    rng = np.random.default_rng(6)
    ref = pd.DataFrame(rng.random((20, 3)), columns=["a", "b", "c"])
    x = rng.dirichlet([1, 1, 1], 12) @ ref.to_numpy().T + 0.1 * rng.normal(size=(12, 20))
    x[2, 5], x[3] = np.nan, np.nan
    rows = [(i, f, float(x[i, f])) for i in range(12) for f in range(20) if not np.isnan(x[i, f])] + [(3, 99, 1.0), (4, 99, 5.0)]
    out = kinship.deconvolve(spark.createDataFrame(rows, "iid long, feat int, x double"), ref)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.iid, r.cell): r.share for r in out.collect()}
    assert len(got) == 36 and [got[3, c] for c in "abc"] == [0, 0, 0]
    for i in set(range(12)) - {3}:
        ok = ~np.isnan(x[i])
        a, y, w = np.column_stack([np.ones(ok.sum()), ref.to_numpy()[ok]]), x[i][ok], np.ones(ok.sum())
        for _ in range(50):
            b = np.linalg.lstsq(a * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
            e = np.abs(y - a @ b)
            w = np.minimum(1.0, 1.345 * max(np.median(e) / 0.6745, 1e-12) / e)
        share = np.maximum(b[1:], 0)
        assert np.allclose([got[i, c] for c in "abc"], share / share.sum(), atol=1e-8)


def test_a_pair_of_blocks_is_summed_by_many_tasks(spark, monkeypatch):
    """all columns of a pair of row blocks were read by one task."""
    from statloom.operators import blocks, nulls

    rng = np.random.default_rng(8)
    x, y, c = rng.integers(0, 3, (4, 40)).astype(float), rng.normal(size=(3, 40)), rng.normal(size=40)
    x[1, 3], y[2, 7], y[0, 9] = np.nan, np.nan, np.nan
    g = spark.createDataFrame([(a, b, float(x[a, b])) for a in range(4) for b in range(40) if not np.isnan(x[a, b])], "variant int, iid long, g double")
    p = spark.createDataFrame([(a, b, float(y[a, b])) for a in range(3) for b in range(40) if not np.isnan(y[a, b])], "phenotype int, iid long, y double")
    cov = spark.createDataFrame([(b, [float(c[b])]) for b in range(40)], "iid long, c array<double>")
    mod = cov.select("iid", cov["c"][0].alias("i"))

    def results():
        plans = [assoc.scan(g, p, cov), assoc.scan_simple(g, p), nulls.interaction(g, p, mod, 0.01)]
        return plans, [{(r.variant, r.phenotype): tuple(r)[2:] for r in d.collect()} for d in plans]

    _, want = results()
    monkeypatch.setattr(blocks, "COLS", 4)
    monkeypatch.setattr(blocks, "RUN", 3)
    plans, got = results()
    for d, a, b in zip(plans, want, got, strict=True):
        assert d._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
        assert a.keys() == b.keys() and len(a) == 12 and all(np.allclose(a[k], b[k]) for k in a)


def test_sharding_keeps_what_its_sql_leaves_out(spark, tmp_path):
    """the SQL ends at 24 bits of prefix and drops a document that needs more; the query has all documents."""
    import hashlib

    import duckdb

    from statloom.llm import queries

    seen: dict[str, int] = {}
    for n in range(1 << 20):
        other = seen.setdefault(hashlib.md5(str(n).encode()).hexdigest()[:7], n)
        if other != n:
            break
    rows = [(other, "x" * 40_000), (n, "y" * 40_000), (-1, "z")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.bytes, r.shard, r.shard_depth) for r in queries.sharding_64k(spark, str(tmp_path)).collect()}
    assert set(got) == {other, n, -1} and got[n][2] == got[other][2] > 24
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = queries.oracle_sql()["sharding_64k"]
    assert {r[0] for r in con.execute(sql).fetchall()} == {-1}
    assert {r[0]: (r[1], r[2], r[3]) for r in con.execute(sql.replace("range(25)", "range(61)")).fetchall()} == got
