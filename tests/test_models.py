"""Models and the stream of partial sums."""

import numpy as np
from pyspark.sql import functions as F

from statloom.operators import models
from statloom.streaming import partials


def test_logistic_and_linear(spark):
    rng = np.random.default_rng(0)
    g = rng.integers(0, 3, 2000).astype(float)
    y = (rng.uniform(size=2000) < 1 / (1 + np.exp(-(g - 1)))).astype(float)
    b, s = models.logistic(np.column_stack([np.ones(2000), g]), y)
    assert abs(b[1] - 1) < 4 * s[1] and 0.03 < s[1] < 0.12
    df = spark.createDataFrame([("v", float(a), float(c) + 1) for a, c in zip(g, y)], "variant string, g double, y double")
    r = models.glm(df, "variant", kind="logistic").first()
    assert np.isclose(r.beta, b[1]) and r.low < b[1] < r.high and r.p < 1e-20
    lin = models.glm(df, "variant").first()
    assert np.isclose(lin.beta, np.polyfit(g, y, 1)[0]) and lin.n == 2000


def test_mixture_and_density(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, 600), rng.normal(8, 0.5, 400)])
    m = models.two_gaussians(x)
    assert np.allclose(np.sort(m["mean"]), [0, 8], atol=0.2) and np.allclose(np.sort(m["weight"]), [0.4, 0.6], atol=0.03)
    d = models.density(spark.createDataFrame([(float(v),) for v in x], "x double"), "x").toPandas().sort_values("at")
    assert abs(np.trapezoid(d["density"], d["at"]) - 1) < 0.1


def test_mediation(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=800)
    m = 0.5 * x + 0.2 * rng.normal(size=800)
    y = 2 * m + 0.3 * rng.normal(size=800)
    df = spark.createDataFrame([("k", *map(float, r)) for r in zip(x, m, y)], "k string, x double, m double, y double")
    r = models.mediation(df, "k").first()
    assert abs(r.acme - 1) < 0.1 and abs(r.ade) < 0.15 and r.p < 0.01


def test_permutation(spark):
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = models.permute(df, "v", "k", 3).collect()
    assert sorted(r.v for r in got) == [2 * i for i in range(50)] and any(r.v != 2 * r.k for r in got)
    assert sorted(map(tuple, models.permute(df, "v", "k", 3).collect())) == sorted(map(tuple, got))


def test_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [("v", "p", i, float(rng.integers(0, 3)), float(rng.normal())) for i in range(90)]
    schema = "variant string, phenotype string, iid int, g double, y double"
    df = spark.createDataFrame(rows, schema)
    for i in range(3):
        df.where(F.col("iid") % 3 == i).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"file://{tmp_path}/in")
    q = partials.start(stream, "sums", f"file://{tmp_path}/cp")
    q.processAllAvailable()
    q.stop()
    got, want = partials.solve_partials(spark.table("sums")).first(), partials.solve_partials(partials.variant_partials(df)).first()
    assert np.allclose(got[2:], want[2:]) and got.n == 90


def test_normalised_traits(spark):
    rng = np.random.default_rng(4)
    n = 300
    age, smoking, sex = rng.uniform(20, 70, n), rng.normal(size=n), rng.integers(0, 2, n)
    y = np.exp(0.05 * age + 3 * sex + 0.3 * rng.normal(size=n))
    y[0] = 1e9
    rows = [("t", i, int(sex[i]), float(age[i]), float(smoking[i]), float(y[i])) for i in range(n)]
    got = models.normalise_trait(spark.createDataFrame(rows, "trait string, iid int, sex int, age double, smoking double, y double"), "trait").toPandas()
    v = got.set_index("iid")["v"].astype(float)
    assert np.isnan(v[0]) and v.notna().sum() == n - 1
    for s in (0, 1):  # the sexes differ, so each is normalised alone
        part = v[(sex == s) & v.notna().reindex(range(n)).to_numpy()]
        assert abs(part.std() - 1) < 1e-6 and abs(part.mean()) < 1e-6
        assert abs(np.corrcoef(part, age[part.index])[0, 1]) < 0.05
