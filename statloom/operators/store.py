"""Tables written in the shared folder: they cut the lineage of iterations and survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_kept: dict[int, tuple[DataFrame, str]] = {}


def shared(spark: SparkSession) -> None:
    """checkpoint() writes to the folder in spark.checkpoint.dir; in local mode, where it may be unset, to a temporary one."""
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="statloom-"))


def keep(df: DataFrame, name: str, done: Iterable[DataFrame] = ()) -> DataFrame:
    """df written as Parquet below the checkpoint folder and read back; `done` are kept tables that nothing needs after it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    _kept[id(out)] = (out, path)
    for old in done:
        drop(old)
    return out


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    shared(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def drop(kept: DataFrame) -> None:
    """Remove what keep() has written; other tables are left alone."""
    found = _kept.pop(id(kept), None)
    if found:
        _remove(kept.sparkSession, found[1])


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _at_end() -> None:
    for df, path in list(_kept.values()):
        try:
            _remove(df.sparkSession, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return


atexit.register(_at_end)
