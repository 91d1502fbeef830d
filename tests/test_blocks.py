"""Products by tiles against numpy, with tiles much smaller than the matrices, and with missing values."""

import numpy as np
import pytest

from statloom.operators import assoc, blocks, kinship, matrix


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", 3)
    monkeypatch.setattr(blocks, "COLS", 7)


def tables(spark, seed, missing):
    rng = np.random.default_rng(seed)
    g, y, c = rng.integers(0, 3, (8, 40)).astype(float), rng.normal(size=(5, 40)), rng.normal(size=(40, 2))
    g[rng.random(g.shape) < missing] = np.nan
    y[rng.random(y.shape) < missing] = np.nan
    long = lambda x, names: spark.createDataFrame([(i, j, None if np.isnan(v) else float(v)) for (i, j), v in np.ndenumerate(x) if not (np.isnan(v) and j % 2)], names)
    return g, y, c, long(g, "variant int, iid long, g double"), long(y, "phenotype int, iid long, y double"), spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(c)], "iid long, c array<double>")


@pytest.mark.parametrize("missing", [0.0, 0.2])
def test_simple_regressions(spark, missing):
    g, y, c, gd, yd, cd = tables(spark, 1, missing)
    got = {(r.variant, r.phenotype): r for r in assoc.scan_simple(gd, yd).collect()}
    assert len(got) == 40
    for i, a in enumerate(g):
        for j, b in enumerate(y):
            ok = ~np.isnan(a) & ~np.isnan(b)
            slope = np.cov(a[ok], b[ok], ddof=0)[0, 1] / a[ok].var()
            r = np.corrcoef(a[ok], b[ok])[0, 1]
            t = r * np.sqrt((ok.sum() - 2) / (1 - r * r))
            row = got[i, j]
            assert row.n == ok.sum() and np.allclose([row.beta, row.r2, row.t, row.se], [slope, r * r, t, abs(slope / t)])
    high = assoc.scan_simple(gd, yd, 1.0).collect()
    assert {(r.variant, r.phenotype) for r in high} == {k for k, r in got.items() if abs(r.t) > 1}
    sums = {(r.variant, r.phenotype): r.b4 for r in assoc.pair_sums(gd, yd, cd.where("iid < 30")).collect()}
    assert all(np.isclose(v, np.nansum(g[i, :30] * y[j, :30])) for (i, j), v in sums.items()) and len(sums) == 40


@pytest.mark.parametrize("missing", [0.0, 0.2])
def test_scan_sweeps_out_covariates(spark, missing):
    g, y, c, gd, yd, cd = tables(spark, 2, missing)
    got = {(r.variant, r.phenotype): r for r in assoc.scan(gd, yd, cd).collect()}
    fill = lambda x: np.where(np.isnan(x), np.nanmean(x, 1, keepdims=True), x)
    for i, a in enumerate(fill(g)):
        for j, b in enumerate(fill(y)):
            x = np.column_stack([np.ones(40), c, a])
            beta, rest = np.linalg.lstsq(x, b, rcond=None)[:2]
            se = np.sqrt(rest[0] / 36 * np.linalg.inv(x.T @ x)[3, 3])
            assert np.allclose([got[i, j].beta, got[i, j].se, got[i, j].t], [beta[3], se, beta[3] / se])


def test_constant_and_empty(spark):
    g = spark.createDataFrame([(0, i, 1.0) for i in range(9)] + [(1, i, float(i % 3)) for i in range(9)], "variant int, iid long, g double")
    y = spark.createDataFrame([(0, i, float(i)) for i in range(9)], "phenotype int, iid long, y double")
    c = spark.createDataFrame([(i, [float(i % 2), 1.0]) for i in range(9)], "iid long, c array<double>")
    got = {r.variant: r for r in assoc.scan_simple(g, y).collect()}
    assert got[0].beta is None and got[1].n == 9
    swept = {r.variant: r for r in assoc.scan(g, y, c).collect()}
    assert swept[0].beta == 0 and swept[0].t == 0 and swept[1].se > 0
    assert assoc.scan_simple(g.limit(0), y).count() == 0 and assoc.scan(g, y.limit(0), c).count() == 0


def test_gram_and_king(spark):
    rng = np.random.default_rng(5)
    g = rng.integers(0, 3, (11, 30)).astype(float)
    d = spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(g)], "iid long, feat int, g double")
    got = {(r.i, r.j): r.s for r in matrix.gram(d, value="g").collect()}
    assert len(got) == 66 and all(np.isclose(s, g[i] @ g[j]) for (i, j), s in got.items())
    kin = {(r.i, r.j): r.kinship for r in kinship.king(d).collect()}
    assert len(kin) == 55
    for (i, j), k in kin.items():
        a, b = g[i], g[j]
        hets, opposite, hi, hj = ((a == 1) & (b == 1)).sum(), (abs(a - b) == 2).sum(), (a == 1).sum(), (b == 1).sum()
        assert np.isclose(k, (hets - 2 * opposite) / (2 * min(hi, hj)) + 0.5 - (hi + hj) / (4 * min(hi, hj)))


def test_no_plan_is_a_cartesian_product(spark):
    _, _, _, gd, yd, cd = tables(spark, 3, 0.0)
    for df in (assoc.scan(gd, yd, cd), assoc.scan_simple(gd, yd), assoc.pair_sums(gd, yd, cd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_gram_of_one_table_meets_each_pair_of_blocks_once(spark):
    """both orders of blocks were multiplied, with nine sums a pair."""
    rng = np.random.default_rng(6)
    g = rng.integers(0, 3, (40, 9)).astype(float)
    d = spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(g) if (i + j) % 5], "iid long, feat int, g double")
    x = np.where(np.add.outer(np.arange(40), np.arange(9)) % 5 == 0, 0.0, g)
    rows = matrix.gram(d, value="g").collect()
    assert len(rows) == len({(r.i, r.j) for r in rows}) == 820 and all(r.i >= r.j and np.isclose(r.s, x[r.i] @ x[r.j]) for r in rows)
    high = {(r.i, r.j) for r in matrix.gram(d, value="g", above=14.0, own=True).collect()}
    assert high == {(r.i, r.j) for r in rows if r.s > 14.0 or r.i == r.j} and len(high) > 40
    met = spark.createDataFrame([(i, 0, 1.0) for i in range(40)], "iid long, feat int, g double")

    def names(sums):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([sorted(set(sums.rows) ^ set(sums.cols))[0] if set(sums.rows) ^ set(sums.cols) else -1])], names=["n"])

    one = blocks.multiply(met, met, names, "n long", ("iid", "feat", "g"), ("iid", "feat", "g"), kernel=blocks.Products, wide=1).collect()
    n = sum(r.n == -1 for r in one)
    assert n > 1 and len(one) == n * (n + 1) // 2


def test_kinship_is_whole_within_a_tile(spark):
    """all pairs were shuffled, twice, to bring a pair's counts together."""
    rng = np.random.default_rng(7)
    g = rng.integers(0, 3, (23, 30)).astype(float)
    g[4] = 2 * (g[4] > 0)  # no heterozygote
    d = spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(g) if (i * j) % 7 != 3], "iid long, feat int, g double")
    kin = kinship.king(d)
    assert kin._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(i") == 0
    want = {(r.i, r.j): r.kinship for r in kin.collect()}
    seen = np.multiply.outer(np.arange(23), np.arange(30)) % 7 != 3
    assert len(want) == 253
    for (i, j), k in want.items():
        both = seen[i] & seen[j]
        a, b = g[i][both], g[j][both]
        hi, hj = (a == 1).sum(), (b == 1).sum()
        if not min(hi, hj):
            assert k is None
            continue
        assert np.isclose(k, (((a == 1) & (b == 1)).sum() - 2 * (abs(a - b) == 2).sum()) / (2 * min(hi, hj)) + 0.5 - (hi + hj) / (4 * min(hi, hj)))
    got = kinship.king_relatives(d, 0.1, 0.2).collect()
    assert {(r.i, r.j) for r in got if r.j is not None} == {p for p, k in want.items() if k is not None and k > 0.1}
    for n in range(23):
        own = [k for p, k in want.items() if n in p and k is not None]
        parts = [r for r in got if r.j is None and r.i == n]
        assert sum(r.d for r in parts) == sum(k < -0.2 for k in own) and np.isclose(sum(r.s for r in parts), sum(own))


@pytest.mark.parametrize("top", [4, 4_096])
def test_samples_leave_in_the_order_one_by_one(spark, monkeypatch, top):
    """a round dropped only samples that come before all their relatives, so dense tables took hundreds of rounds."""
    rng = np.random.default_rng(8)
    pairs = sorted({(int(max(p)), int(min(p))) for p in rng.integers(0, 12, (30, 2)) if p[0] != p[1]})
    left, want = {frozenset(p) for p in pairs}, []
    while left:
        n = {i: sum(i in p for p in left) for i in range(12)}
        want.append(min(range(12), key=lambda i: (-n[i], i)))
        left = {p for p in left if want[-1] not in p}
    monkeypatch.setattr(kinship, "TOP", top)
    rounds = kinship.first_to_go(spark.createDataFrame(pairs + [p[::-1] for p in pairs], "i long, j long"))
    assert [r.i for go in rounds for r in go.collect()] == want and (len(rounds) == 1 or top < 12)
    edges = spark.createDataFrame([(*p, 0.5) for p in pairs], "i long, j long, grm double")
    assert {r.iid for r in kinship.prune_related(edges, 0.1).collect()} == set(want)
    assert kinship.prune_related(edges, 0.5).count() == 0


def test_many_pairs_go_in_the_order_of_their_values(monkeypatch):
    """pairs of two blocks went by their names, and no value stood beside its equals."""
    rng = np.random.default_rng(3)
    i, j, v = np.arange(30), np.arange(30, 50), rng.integers(0, 9, (30, 20)).astype(float)
    keep = rng.random(v.shape) < 0.7
    batches = lambda: [b.to_pydict() for b in blocks.pairs(i, j, keep, {"s": v}, 64, by="s")]
    few = [x for b in batches() for x in b["s"]]
    monkeypatch.setattr(blocks, "SORTED", 100)
    many = batches()
    assert [x for b in many for x in b["s"]] == sorted(few) != few and max(len(b["s"]) for b in many) <= 64
    got = sorted(z for b in many for z in zip(b["i"], b["j"], b["s"], strict=True))
    assert got == sorted((int(j[b]), int(i[a]), v[a, b]) for a, b in zip(*np.nonzero(keep), strict=True))


def test_open_pairs_are_bits(spark, monkeypatch):
    """every pair above the bound was a row, in both orders, which each round read and wrote."""
    monkeypatch.setattr(kinship, "TILE", 4)
    rng = np.random.default_rng(9)
    g = spark.createDataFrame([(i, j, float(v)) for (i, j), v in np.ndenumerate(rng.integers(0, 3, (25, 12)))], "iid long, feat int, g double")
    pairs = matrix.relationship(g, 0.0).where("i != j and grm > 0.2").select("i", "j")
    want = {(r.i, r.j) for r in pairs.collect()}
    for tiles in (matrix.relatives(g, 0.0, 0.2), kinship.pairs_in_tiles(pairs.union(pairs.select("j", "i")))):
        got = []
        for t in tiles.toArrow().to_batches():
            for at in range(t.num_rows):
                rows, cols, near = blocks.near_bits(t, at)
                got += [(max(rows[a], cols[b]), min(rows[a], cols[b])) for a, b in zip(*np.nonzero(near), strict=True)]
                assert t.column("row_n")[at].as_py() == near.sum(1).tolist() and t.column("col_n")[at].as_py() == near.sum(0).tolist()
        assert len(got) == len(want) > 25 and set(got) == want
    edges = pairs.selectExpr("i", "j", "0.5d as grm")
    gone = {r.iid for r in kinship.prune_related(matrix.relatives(g, 0.0, 0.2)).collect()}
    assert gone == {r.iid for r in kinship.prune_related(edges, 0.1).collect()} and all(set(p) & gone for p in want)
