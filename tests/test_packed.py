"""Packed results by byte ranges; the Shapiro-Wilk statistic against published figures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.operators import normality
from statloom.sources import packed


@pytest.mark.parametrize("rows", [4, 25_000])
def test_round_trip_by_ranges(rows, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packed, "ROWS", rows)
    rng = np.random.default_rng(1)
    want = [(v, f"p{p:02d}", float(np.float32(rng.normal())), float(np.float32(rng.random()))) for p in range(7) for v in range(40 if p == 3 else 3 + p)] + [(None, None, 1.0, None)]
    path = f"file://{tmp_path}/r"
    packed.write_packed(spark.createDataFrame(want, "variant long, phenotype string, beta double, se double").repartition(5), path)
    got = packed.read_packed(spark, path).collect()
    key = lambda r: (r[1] is not None, r[1] or "", r[0] or 0)
    assert sorted([(r["variant"], r["phenotype"], r["beta"], r["se"]) for r in got], key=key) == sorted(want, key=key)
    order = sorted(got, key=lambda r: r["n"])
    assert [r["n"] for r in order] == list(range(len(want))) and [key((r["variant"], r["phenotype"])) for r in order] == sorted(map(key, want))
    index = spark.read.parquet(f"{path}/index")
    assert index.agg(F.max("rows")).first()[0] <= rows
    some = packed.read_packed(spark, path, "phenotype = 'p03' and first <= 9 and last >= 9").where("variant = 9").collect()
    assert [(r["variant"], r["phenotype"]) for r in some] == [(9, "p03")]


def test_nothing_packed(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    packed.write_packed(spark.createDataFrame([], "variant long, phenotype string, beta double, se double"), path)
    assert packed.read_packed(spark, path).count() == 0


def test_shapiro_wilk(spark):
    # weights of men: published W = 0.79, p = 0.0067
    weights = [148.0, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    rng = np.random.default_rng(3)
    groups = {"w": weights, "normal": rng.normal(size=400).tolist(), "skewed": rng.exponential(size=400).tolist(), "three": [1.0, 2.0, 4.0], "two": [1.0, 2.0], "same": [5.0] * 9, None: rng.normal(size=30).tolist()}
    rows = [(k, float(v)) for k, x in groups.items() for v in x] + [("w", None), ("w", float("nan"))]
    got = {r["k"]: r for r in normality.shapiro_wilk(spark.createDataFrame(rows, "k string, x double").repartition(6), "x", "k").collect()}
    assert abs(got["w"]["w"] - 0.7888) < 1e-3 and abs(got["w"]["p"] - 0.0067) < 5e-4 and got["w"]["n"] == 11
    assert got["normal"]["w"] > 0.985 and got["normal"]["p"] > 0.01 and got["skewed"]["p"] < 1e-10
    assert np.isclose(got["three"]["w"], 27 / 28) and np.isclose(got["three"]["p"], 0.6369, atol=1e-3)
    assert got["two"]["w"] is None and got["same"]["p"] is None and got[None]["n"] == 30
    assert normality.shapiro_wilk(spark.createDataFrame(rows, "k string, x double"), "x").first()["n"] == len(rows) - 2
