"""Packed results: compressed rows of (variant, beta, se) a phenotype in a few files, with an index for reading by byte range."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from statloom.operators import numbering

#: Rows of a record at most, and its zlib level.
ROWS, LEVEL = 25_000, 9


def write_packed(results: DataFrame, path: str) -> None:
    """Write results (variant, phenotype, beta, se) as files part-*.packed and a Parquet table `index` below the path.

    Rows are dealt by ranges of (phenotype, variant), so a phenotype of any size is spread over files; a record holds at most
    ROWS rows of one phenotype in the order of variants, values as 32-bit floats. The index has phenotype, file, offset, bytes,
    rows, first and last variant, and start: the number of the record's first row among all, by a prefix sum within and over the
    files. A null phenotype or variant is one too. A file gets its name when it is whole, so a repeated task writes the same again.
    """
    spark = results.sparkSession
    kinds = {n: results.schema[n].dataType for n in ("phenotype", "variant")}
    arrow = {n: to_arrow_type(t) for n, t in kinds.items()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = results.select("phenotype", "variant", F.col("beta").cast("float"), F.col("se").cast("float")).repartitionByRange(parts, "phenotype", "variant").sortWithinPartitions("phenotype", "variant")
    text = f"phenotype {kinds['phenotype'].simpleString()}, file string, offset long, bytes long, rows long, first {kinds['variant'].simpleString()}, last {kinds['variant'].simpleString()}"
    out = pa.schema([("phenotype", arrow["phenotype"]), ("file", pa.string()), ("offset", pa.int64()), ("bytes", pa.int64()), ("rows", pa.int64()), ("first", arrow["variant"]), ("last", arrow["variant"])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pa.fs.FileSystem.from_uri(path)
        task = TaskContext.get()
        name, draft = f"part-{task.partitionId():05d}.packed", f"{folder}/.draft-{task.taskAttemptId()}"
        files.create_dir(folder, recursive=True)
        entries: list[tuple] = []
        held: list[pa.Table] = []
        with files.open_output_stream(draft, compression=None) as to:

            def record() -> None:
                whole = pa.concat_tables(held).combine_chunks()
                held.clear()
                sink = pa.BufferOutputStream()
                body = whole.drop_columns("phenotype")
                with pa.ipc.new_stream(sink, body.schema) as w:
                    w.write_table(body)
                data = zlib.compress(sink.getvalue().to_pybytes(), LEVEL)
                ids = whole.column("variant")
                entries.append((whole.column("phenotype")[0].as_py(), name, to.tell(), len(data), len(whole), ids[0].as_py(), ids[-1].as_py()))
                to.write(data)

            now = None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                at = 0
                while at < len(table):
                    key = table.column("phenotype")[at]
                    same = pa.compute.equal(table.column("phenotype").slice(at), key) if key.is_valid else table.column("phenotype").slice(at).is_null()
                    end = pa.compute.index(same, False).as_py()
                    run_length = end if end >= 0 else len(table) - at
                    if held and (key.as_py() != now or sum(map(len, held)) >= ROWS):
                        record()
                    now = key.as_py()
                    take = min(run_length, ROWS - sum(map(len, held)))
                    held.append(table.slice(at, take))
                    at += take
            if held:
                record()
        files.move(draft, f"{folder}/{name}")
        if entries:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*entries, strict=True), out, strict=True)], schema=out)

    index = numbering.running_sum(rows.mapInArrow(run, text), "rows", "file", "offset", name="end")
    index.withColumn("start", F.col("end") - F.col("rows")).drop("end", "share").write.parquet(f"{path}/index")


def read_packed(spark: SparkSession, path: str, where: Column | str | None = None) -> DataFrame:
    """(phenotype, variant, beta, se, n): rows of write_packed() with their number n from 0; only records that `where`, a
    condition on the index, keeps are read, each by its byte range."""
    index = spark.read.parquet(f"{path}/index")
    index = index if where is None else index.where(where)
    kinds = {n: index.schema[c].dataType for n, c in (("phenotype", "phenotype"), ("variant", "first"))}
    schema = pa.schema([("phenotype", to_arrow_type(kinds["phenotype"])), ("variant", to_arrow_type(kinds["variant"])), ("beta", pa.float32()), ("se", pa.float32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pa.fs.FileSystem.from_uri(path)
        for batch in batches:
            for phenotype, name, offset, size, start in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                with files.open_input_file(f"{folder}/{name}") as f:
                    data = zlib.decompress(f.read_at(size, offset))
                with pa.ipc.open_stream(data) as r:
                    table = r.read_all().combine_chunks()
                n = len(table)
                columns = [pa.array([phenotype] * n, schema.field(0).type), *(table.column(c).combine_chunks() for c in ("variant", "beta", "se")), pa.array(range(start, start + n), pa.int64())]
                yield pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("phenotype", "file", "offset", "bytes", "start").repartition(parts, "file", "offset")
    return dealt.mapInArrow(run, f"phenotype {kinds['phenotype'].simpleString()}, variant {kinds['variant'].simpleString()}, beta float, se float, n long")
