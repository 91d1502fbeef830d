"""The named data checks pass good files and fail bad ones."""

import pytest

from statloom.operators import datachecks as checks
from statloom.operators import quality


def results(df):
    return {r.check_id: r.passed for r in df.collect()}


def test_study_name():
    assert checks.study_name("Study_1") and not checks.study_name("") and not checks.study_name("a b") and not checks.study_name("x-1")


def test_variants(spark):
    good = spark.createDataFrame([(str(i % 23 + 1), f"v{i}") for i in range(46)], "chr string, id string")
    assert all(results(checks.variants(good, "chr", "id")).values())
    bad = spark.createDataFrame([("X", "a"), ("1", "a")], "chr string, id string")
    assert not any(results(checks.variants(bad, "chr", "id")).values())
    assert results(checks.variants(good.limit(0), "chr", "id"))["chromosome_codes"] is False


def test_covariates(spark):
    good = spark.createDataFrame([(i, "MF"[i % 2], 40.0 + i % 9) for i in range(30)], "IID int, Sex_factor string, Age_numeric double")
    assert all(results(checks.covariates(good, age="Age_numeric")).values())
    bad = spark.createDataFrame([(f"s{i}", None if i % 2 else -5.0, i) for i in range(30)], "Name_factor string, Age_numeric double, IID int")
    got = results(checks.covariates(bad, age="Age_numeric"))
    assert not got["id_first"] and not got["missing_share"] and not got["factor_levels"] and not got["least_age"] and got["columns"]
    with pytest.raises(ValueError, match="factor_levels, id_first"):
        quality.require(checks.covariates(bad, age="Age_numeric"))


def test_sex_and_samples(spark):
    rows = [(f"i{i}", "f", "MF"[i % 2], "MF"[i % 2], float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "iid string, fid string, sex string, guess string, pc double")
    assert all(results(checks.sex(df, "sex", "guess", "pc")).values())
    assert results(checks.samples(df, "iid", "fid")) == {"duplicate_samples": True, "sample_underscores": True, "family_underscores": True, "families": False}
    assert results(checks.analysable(df, "sex", "pc")) == {"analysable": True} and results(checks.analysable(df.limit(9), "sex")) == {"analysable": False}
