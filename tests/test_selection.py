"""Selection, lookup, pruning and binary genotypes against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.functions import stats
from statloom.operators import assoc, blocks, kinship, matrix, ranks, selection
from statloom.sources import readers, sinks


def greedy(x, chrs, window, step, r2):
    """Numbers of kept rows of x, each chromosome's in order."""
    kept = []
    for c in sorted(set(chrs)):
        at = [i for i in range(len(x)) if chrs[i] == c and len({v for v in x[i] if not np.isnan(v)}) > 1]
        went = set()
        for b in range(len(at)):
            for a in range(b):
                both = ~np.isnan(x[at[a]]) & ~np.isnan(x[at[b]])
                if a not in went and b < a // step * step + window and np.corrcoef(x[at[a]][both], x[at[b]][both])[0, 1] ** 2 > r2:
                    went.add(b)
        kept += [at[i] for i in range(len(at)) if i not in went]
    return sorted(kept)


@pytest.mark.parametrize(("window", "step"), [(10_000, 5), (7, 1), (10, 5), (2, 1)])
def test_prune_ld_by_blocks(spark, monkeypatch, window, step):
    monkeypatch.setattr(blocks, "ROWS", 4)
    rng = np.random.default_rng(window)
    base = rng.integers(0, 3, (12, 40)).astype(float)
    x = np.array([np.where(rng.uniform(size=40) < 0.4, rng.integers(0, 3, 40), base[i // 4]) for i in range(46)])
    x[5] = 1.0
    x[rng.uniform(size=x.shape) < 0.05] = np.nan
    chrs = ["1"] * 21 + ["10"] * 25
    rows = [(chrs[i], i, f"v{i}", j, None if np.isnan(x[i, j]) else float(x[i, j])) for i in range(46) for j in range(40)]
    df = spark.createDataFrame(rows, "chr string, pos int, variant string, iid int, g double")
    got = sorted(int(r.variant[1:]) for r in kinship.prune_ld(df, window, step, 0.2).collect())
    assert got == greedy(x, chrs, window, step, 0.2) and len(got) < 45
    assert kinship.prune_ld(df.limit(0)).count() == 0


def test_bed_round_trip_by_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "RANGE", 12)
    rng = np.random.default_rng(2)
    g = rng.choice([0.0, 1.0, 2.0, np.nan], (23, 11))
    cells = [(i, j, None if np.isnan(g[i, j]) else float(g[i, j])) for i in range(23) for j in range(11) if (i, j) != (3, 4)]
    g[3, 4] = np.nan
    files = sinks.write_bed(spark.createDataFrame(cells, "variant_idx int, sample_idx int, g double"), f"file://{tmp_path}/out", 11, 3)
    assert sum(n for _, _, n in files) == 23 and len(files) > 1
    back = np.full(g.shape, -1.0)
    for name, first, _ in files:
        for r in readers.read_bed(spark, f"file://{name}", 11).collect():
            back[first + r.variant_idx, r.sample_idx] = np.nan if r.g is None else r.g
    assert np.array_equal(back, g, equal_nan=True)
    (tmp_path / "cut.bed").write_bytes(b"\x6c\x1b\x01" + b"\0" * 4)
    with pytest.raises(ValueError, match="whole records"):
        readers.read_bed(spark, f"file://{tmp_path}/cut.bed", 11)


def test_grm_in_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "RANGE", 8)
    n = 9
    i, j = np.tril_indices(n)
    (tmp_path / "x.grm.bin").write_bytes((i * 100.0 + j).astype("<f4").tobytes())
    (tmp_path / "x.grm.N.bin").write_bytes(np.full(len(i), 7, "<f4").tobytes())
    got = {(r.i, r.j): (r.n_snp, r.grm) for r in readers.read_grm(spark, f"file://{tmp_path}/x").collect()}
    assert got == {(a, b): (7.0, a * 100.0 + b) for a, b in zip(i.tolist(), j.tolist(), strict=True)}


def test_fdr_in_groups(spark):
    rng = np.random.default_rng(4)
    groups = {"a": rng.uniform(size=300).round(2).tolist(), None: (10.0 ** -rng.uniform(0, 300, 200)).tolist(), "b": [0.0, 0.0, 1.0, 1.0], "c": [0.04]}
    rows = [(k, n, p) for k, v in groups.items() for n, p in enumerate(v)] + [("a", -1, None)]
    got = {(r.k, r.n): r.fdr for r in ranks.benjamini_hochberg(spark.createDataFrame(rows, "k string, n int, p double"), "p", "k").collect()}
    assert len(got) == len(rows) and got["a", -1] is None
    for k, v in groups.items():
        order = np.argsort(v)[::-1]
        want = np.empty(len(v))
        want[order] = np.minimum(1, np.minimum.accumulate(np.array(v)[order] * len(v) / np.arange(len(v), 0, -1)))
        assert np.allclose([got[k, n] for n in range(len(v))], want, rtol=1e-12)


def test_screening(spark):
    rng = np.random.default_rng(6)
    c = rng.normal(size=(80, 3))
    y = {"x": c[:, 1] + rng.normal(size=80), "y": rng.normal(size=80)}
    comps = spark.createDataFrame([(i, c[i].tolist()) for i in range(80)], "iid int, c array<double>")
    traits = spark.createDataFrame([(k, i, None if (k, i) == ("y", 0) else float(v[i])) for k, v in y.items() for i in range(80)], "trait string, iid int, y double")
    got = {(r.trait, r.pc): r for r in selection.screen_components(comps, traits, 3).collect()}
    for k, v in y.items():
        rows = slice(1, None) if k == "y" else slice(None)
        a = np.column_stack([np.ones(80), c])[rows]
        b = np.linalg.lstsq(a, v[rows], rcond=None)[0]
        s = ((v[rows] - a @ b) ** 2).sum() / (len(a) - 4) * np.linalg.inv(a.T @ a)
        for pc in (1, 2, 3):
            t = b[pc] / np.sqrt(s[pc, pc])
            assert np.isclose(got[k, pc].t, t) and np.isclose(got[k, pc].p, stats.t_two_sided(t, len(a) - 4)) and got[k, pc].n == len(a)
    assert [r.pc for r in selection.related_components(selection.screen_components(comps, traits, 3)).collect()] == [2]
    few = selection.screen_components(comps, traits.where("iid < 3"), 3).collect()
    assert len(few) == 6 and all(r.p is None for r in few)


def test_components_that_hits_name_go(spark):
    comps = spark.createDataFrame([("p1",), ("p2",)], "pc string")
    hits = spark.createDataFrame([("p1", "6", 26_000_000), ("p1", "6", 10), ("p2", "6", 30_000_000)], "pc string, chr string, pos long")
    assert [r.pc for r in selection.without_driven(comps, hits.where(selection.outside(selection.MHC, "chr", "pos")), "pc").collect()] == ["p2"]
    with pytest.raises(ValueError, match="genetic"):
        selection.without_driven(comps, hits, "pc")


def test_sex(spark):
    df = spark.createDataFrame([(i, "F", "M" if i == 3 else None if i == 4 else "F") for i in range(30)], "i int, a string, b string")
    assert {r.i for r in selection.without_mismatches(df, "a", "b").collect()} == set(range(30)) - {3, 4}
    with pytest.raises(ValueError, match="another sex"):
        selection.without_mismatches(df.where("i < 10"), "a", "b")
    assert selection.without_mismatches(df.limit(0), "a", "b").count() == 0


def test_lookup_takes_the_first_consistent(spark):
    panel = spark.createDataFrame([(5, 1, 10, "A", "G"), (2, 1, 10, "A", "C"), (7, 1, 10, "G", "A"), (9, 1, 20, "A", "T")], "idx int, chr int, bp int, a1 string, a2 string")
    probes = spark.createDataFrame([(0, 1, 10, "G", "A"), (1, 1, 10, "C", "A"), (2, 1, 10, "T", "A"), (3, 2, 10, "A", "G"), (4, 1, 20, "A", None)], "n int, chr int, bp int, a1 string, a2 string")
    got = {r.n: (r.idx, r.flip) for r in selection.lookup(probes, panel, ["chr", "bp"], "n").collect()}
    assert got == {0: (5, -1), 1: (2, -1), 2: (-1, 0), 3: (-1, 0), 4: (-1, 0)}


def test_effective_tests(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (30, 400)).astype(float)
    same = np.repeat(rng.integers(0, 3, (1, 400)).astype(float), 30, 0)
    rows = [(k, i, v.tolist()) for k, m in (("free", x), ("same", same), ("flat", np.ones((4, 400)))) for i, v in enumerate(m)]
    got = {r.g: r.tests for r in selection.effective_tests(spark.createDataFrame(rows, "g string, pos int, values array<double>"), "g", window=15).collect()}
    assert 28 <= got["free"] <= 30 and got["same"] == 2 and got["flat"] == 0


def test_p_of_the_correlation_takes_n_minus_one(spark):
    fits = spark.createDataFrame([("v", "p", 20, 0.5, 2.0)], "variant string, phenotype string, n int, beta double, t double")
    r = assoc.by_correlation(fits).first()
    assert np.isclose(r.f, 4) and np.isclose(r.se, 0.25)
    p = assoc.by_correlation(fits).select(stats.p_from_f("f", F.lit(1.0), (F.col("n") - 1).cast("double"))).first()[0]
    assert np.isclose(p, stats.t_two_sided(2.0, 19))


def test_inversions(spark):
    inf = float("inf")
    rows = [("few", i, 1.0, 0.0, 0.0, 3) for i in range(10)] + [("same", i, inf, 0.5, 0.1, 9) for i in range(10)]
    rows += [("bad", i, 0.5, 0.5 if i < 2 else 0.1, 0.1, 9) for i in range(10)] + [("good", i, 0.1, 0.9 if i else 0.0, 0.2, 9) for i in range(10)]
    s = spark.createDataFrame(rows, "inversion string, iid int, nn double, ni double, ii double, n_snps int")
    got = {r.inversion: (r.reason, r.n) for r in selection.inversion_summary(selection.inversion_calls(s)).collect()}
    assert got == {"few": ("Not enough SNPs", 10), "same": ("Invariant Inversions", 10), "bad": ("Bad genotyping", 8), "good": (None, 10)}


def test_cells_to_drop(spark):
    long = spark.createDataFrame([("a", 0.0), ("a", 3.0), ("b", 1.0), ("b", 2.0), ("c", 0.0), ("c", 0.0), ("d", 9.0), ("d", 8.0)], "cell string, x double")
    drop = lambda d: sorted(r.cell for r in selection.cells_to_drop(d, "cell", "x").collect())
    assert drop(long) == ["c"] and drop(long.where("cell <> 'c'")) == ["a", "b"] and drop(long.limit(0)) == []


def test_banded_pairs_are_those_of_all(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", 3)
    x = np.random.default_rng(0).integers(0, 3, (20, 15)).astype(float)
    df = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(20) for j in range(15)], "n long, iid int, g double")
    got = {(r.a, r.b) for r in kinship.ld_pairs(df, 8, 1, 0.05).collect()}
    r = np.corrcoef(x) ** 2
    assert got == {(a, b) for a in range(20) for b in range(a + 1, min(20, a + 8)) if r[a, b] > 0.05}
    assert matrix.gram(df, "iid", "n", "g").count() == 210
