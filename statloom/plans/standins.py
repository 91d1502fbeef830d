"""The driver's tables in the roles of genomic ones, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.plans.catalog import Tables

#: Features from this one on are phenotypes, those before it dosages; cuts between dosages 0, 1 and 2.
SPLIT, CUT = 32, 0.055

LONG_SQL = "(SELECT vec_id AS iid, label, CAST(unnest(range(64)) AS INTEGER) AS feat, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"
DOSE_SQL = f"(SELECT iid, label, feat, CASE WHEN x < -{CUT}e0 THEN 0e0 WHEN x < {CUT}e0 THEN 1e0 ELSE 2e0 END AS g FROM {LONG_SQL} WHERE feat < {SPLIT})"
PHENO_SQL = f"(SELECT iid, label, feat, x AS y FROM {LONG_SQL} WHERE feat >= {SPLIT})"
PAIRS_SQL = f"(SELECT d.iid, d.label, d.feat AS variant, p.feat AS phenotype, g, y FROM {DOSE_SQL} d JOIN {PHENO_SQL} p ON d.iid = p.iid)"


def long(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("iid"), "label", F.posexplode("embedding").alias("feat", "x")).withColumn("x", F.col("x").cast("double"))


def dosages(t: Tables) -> DataFrame:
    return long(t).where(F.col("feat") < SPLIT).select("iid", "label", "feat", F.when(F.col("x") < -CUT, 0.0).when(F.col("x") < CUT, 1.0).otherwise(2.0).alias("g"))


def phenotypes(t: Tables) -> DataFrame:
    return long(t).where(F.col("feat") >= SPLIT).select("iid", "label", "feat", F.col("x").alias("y"))


def pairs(t: Tables) -> DataFrame:
    d = dosages(t).withColumnRenamed("feat", "variant")
    p = phenotypes(t).select("iid", F.col("feat").alias("phenotype"), "y")
    return d.join(p, "iid")


def covariates(t: Tables) -> DataFrame:
    """(iid, c): the last feature as the one numeric covariate."""
    return long(t).where("feat = 63").select("iid", F.array("x").alias("c"))
