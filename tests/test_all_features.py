"""Queries without SQL take all 32 variants, all 32 phenotypes and all features."""

import numpy as np
import pytest

from statloom import plans

SF = "/root/testdata/sf0.001"
PAIRS = {(v, p) for v in range(32) for p in range(32, 64)}


@pytest.mark.parametrize("name", ["pair_p_values", "vqtl_bf_p", "glm_logistic", "interaction_scan"])
def test_all_pairs(name, spark):
    rows = plans.QUERIES[name](spark, SF).collect()
    assert len(rows) == 1024 and {(r.variant, r.phenotype) for r in rows} == PAIRS


def test_interaction_of_a_late_pair(spark):
    x = np.array([list(r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()], float)
    g, y, c = np.where(x[:, 31] < -0.055, 0.0, np.where(x[:, 31] < 0.055, 1.0, 2.0)), x[:, 62], x[:, 63]
    a = np.column_stack([np.ones(len(g)), g, c, g * c])
    b = np.linalg.lstsq(a, y, rcond=None)[0]
    e = y - a @ b
    t = b[3] / np.sqrt(np.linalg.inv(a.T @ a)[3, 3] * (e @ e) / (len(y) - 4))
    got = {(r.variant, r.phenotype): r for r in plans.QUERIES["interaction_scan"](spark, SF).collect()}
    assert np.isclose(got[31, 62].beta, b[3], atol=1e-5) and np.isclose(got[31, 62].t, t, atol=1e-4)
    assert all(got[v, 63].t == 0 and got[v, 63].beta == 0 for v in range(32))


def test_all_features_are_residualised(spark):
    rows = plans.QUERIES["residualise_transformed"](spark, SF).collect()
    assert {r.feat for r in rows} == set(range(64)) and len(rows) == 64 * 500 and not any(r.v is None for r in rows)
