"""Sinks: delimited text, Parquet partitioned as results are read, GRM, per-phenotype and per-chromosome folders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists", digits: int | None = None) -> None:
    """Delimited text with a header, NA for null; doubles rounded if digits are given."""
    doubles = {n for n, t in df.dtypes if t in ("double", "float")}
    df = df.select(*[F.round(c, digits).alias(c) if digits is not None and c in doubles else F.col(c) for c in df.columns])
    df.write.mode(mode).options(header="true", sep=sep, nullValue="NA").csv(path)


def write_wide(long: DataFrame, path: str, key: str, name: str, value: str, names: list) -> None:
    """A column for each of `names`: only for the ends of a flow, since their number bounds the width."""
    write_text(long.groupBy(key).pivot(name, names).agg(F.first(value)), path, ",")


def write_results(df: DataFrame, path: str, by: str = "phenotype", mode: str = "append") -> None:
    """Parquet folders by phenotype or chromosome. Rows are dealt by ranges of it and of the other columns, so that a value with
    many rows is spread over several files. Mode append adds to what is there: use errorifexists where a job may run again."""
    df.repartitionByRange(by, *[c for c in df.columns if c != by]).write.mode(mode).partitionBy(by).option("compression", "zstd").parquet(path)


def write_chunks(df: DataFrame, path: str, key: str, rows: int = 25_000) -> None:
    """Parquet files of at most so many rows in the key's order."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.option("maxRecordsPerFile", rows).parquet(path)


def write_grm(edges: DataFrame, path: str) -> None:
    """The relationship matrix as an edge list, i >= j."""
    edges.where("i >= j").write.parquet(path)


def write_bed(dosage: DataFrame, path: str, samples: int, parts: int = 8) -> list[tuple[str, int, int]]:
    """PLINK .bed files of consecutive variants below the folder: (file, first variant number, variants) of each, in order.

    dosage: variant_idx, sample_idx, g (copies of the first allele, 0, 1 or 2; anything else, or absent, is missing). A file
    gets its name when it is whole, so a repeated task only writes the same again.
    """
    packed = dosage.groupBy("variant_idx").agg(F.collect_list(F.struct("sample_idx", F.col("g").cast("double").alias("g"))).alias("v"))
    width = (samples + 3) // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pa.fs.FileSystem.from_uri(path)
        task = TaskContext.get()
        name, draft = f"{folder}/part-{task.partitionId():05d}.bed", f"{folder}/.draft-{task.taskAttemptId()}"
        files.create_dir(folder, recursive=True)
        first, n = None, 0
        with files.open_output_stream(draft) as out:
            out.write(b"\x6c\x1b\x01")
            for batch in batches:
                for variant, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    codes, cells = np.full(4 * width, 1, np.uint8), cells.values
                    codes[samples:] = 0
                    g = cells.field("g").to_numpy(zero_copy_only=False)
                    at = cells.field("sample_idx").to_numpy(zero_copy_only=False).astype(np.int64)
                    for value, code in ((2.0, 0), (1.0, 2), (0.0, 3)):
                        codes[at[g == value]] = code
                    out.write((codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).tobytes())
                    first, n = variant if first is None else first, n + 1
        if not n:
            files.delete_file(draft)
            return
        files.move(draft, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([first], pa.int64()), pa.array([n], pa.int64())], names=["file", "first", "variants"])

    dealt = packed.repartitionByRange(parts, "variant_idx").sortWithinPartitions("variant_idx").select(F.col("variant_idx").cast("long"), "v")
    return sorted((tuple(r) for r in dealt.mapInArrow(run, "file string, first long, variants long").collect()), key=lambda r: r[1])
