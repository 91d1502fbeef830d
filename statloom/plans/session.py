"""Session settings that plans rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from statloom.operators.store import shared

__all__ = ["shared", "ship"]


def ship(spark: SparkSession) -> None:
    """Python workers find this package even if they start in another folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
