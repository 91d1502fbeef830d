"""WARC archives: a writer of gzip members a record, and a splittable reader whose tasks scan byte ranges for them."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm import common

#: Bytes of a range, bytes that a task reads at once, bytes that are inflated at once, and the most that a record's header lines may take.
SPLIT_BYTES, READ_BYTES, FEED_BYTES, HEAD_BYTES = 4 << 20, 1 << 18, 1 << 14, 1 << 16
#: Fixed values of the formats: start of a gzip member that is deflated, WARC version, date that stands for an unknown one.
MAGIC, VERSION, DATE = b"\x1f\x8b\x08", b"WARC/1.1", "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identity: str | None) -> int | None:
    digits = (identity or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.removeprefix("-").isdecimal() else None


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit keeps the response's HTTP header, with the payload's length, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = " ".join((url or "").split()) or "urn:unknown"
    lines = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"] if revisit else []
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + deflate.flush()


# ---------------------------------------------------------------- which pages are responses


def with_firsts(pages: DataFrame, payload: str = "html", least: int = 0) -> DataFrame:
    """pages with __first, the smallest page_id of the same payload where that is another row's, and __revisit.

    Pages are told apart by SHA-256 and length of their payloads; only narrow rows of payloads that stand more than once are joined, the
    rows of a frequent one dealt over tasks. Payloads below `least` bytes are never revisited.
    """
    octets = F.coalesce(F.col(payload), F.lit(""))
    keyed = pages.withColumn("__digest", F.concat(F.unhex(F.sha2(octets, 256)), F.unhex(F.lpad(F.hex(F.octet_length(octets)), 16, "0"))))
    wide = F.octet_length(octets) >= least
    slim = common.save(keyed.where(wide).select(F.col("page_id").cast("long").alias("page_id"), F.col("__digest").alias("digest")), "payloads")
    groups = common.save(slim.groupBy("digest").agg(F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("__size")).where("__size > 1"), "payload-groups", [slim])
    flagged = common.with_hits(keyed.withColumn("__key", F.xxhash64("__digest")), "__key", groups.select(F.xxhash64("digest"))).drop("__key")
    flagged = flagged.withColumn("__hit", F.col("__hit") & wide)
    alone = flagged.where("not __hit").withColumns({"__first": F.lit(None).cast("long"), "__revisit": F.lit(False)})
    hits = flagged.where("__hit").withColumnRenamed("__digest", "digest")
    # the filter lets a few rows of single payloads pass, which have no group
    found = common.join_groups(hits.join(groups.select("digest"), "digest", "left_semi"), groups, "digest", "__size", F.xxhash64("page_id"))
    lost = hits.join(groups.select("digest"), "digest", "left_anti").withColumns({"__first": F.lit(None).cast("long"), "__revisit": F.lit(False)})
    revisit = ~F.col("page_id").cast("long").eqNullSafe(F.col("__first"))
    found = found.withColumn("__revisit", revisit)
    names = [*pages.columns, "__first", "__revisit"]
    return alone.select(names).unionByName(found.select(names)).unionByName(lost.select(names))


# ---------------------------------------------------------------- writer


def write_warc(pages: DataFrame, path: str, least: int = 0, payload: str = "html") -> DataFrame:
    """Write page_id, url and the payload of every row as archives part-*.warc.gz below the folder; (file, bytes) of each.

    Of records with equal payloads of at least `least` bytes the one with the smallest page_id is a response, the others
    revisit it. Null payload counts as empty, a null url as urn:unknown. A null page_id is larger than any other; where all of a
    group are null, or rows repeat the smallest page_id, each of them is a response. A record may be of any length; a task
    holds one at a time. An empty table gives archives without records. Further columns are left out.

    A file gets its name when it is whole, so a repeated task writes the same again and nothing else.
    """
    rows = with_firsts(pages.select("page_id", "url", payload), payload, least).select(F.col("page_id").cast("long"), "url", payload, "__first", "__revisit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = pa.fs.FileSystem.from_uri(path)
        task = TaskContext.get()
        name, draft, size = f"{folder}/part-{task.partitionId():05d}.warc.gz", f"{folder}/.draft-{task.taskAttemptId()}", 0
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                for page_id, url, text, first, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = member(page_id, url, (text or "").encode(), first, revisit)
                    out.write(data)
                    size += len(data)
        files.move(draft, name)
        yield pa.RecordBatch.from_arrays([pa.array([name.rsplit("/", 1)[-1]]), pa.array([size], pa.int64())], names=["file", "bytes"])

    return common.save(rows.mapInArrow(run, "file string, bytes long"), "archives")


# ---------------------------------------------------------------- splittable reader


class Source:
    """Bytes of an open file, read in pieces of READ_BYTES; the last piece is kept."""

    def __init__(self, file: pa.NativeFile, size: int) -> None:
        self.file, self.size, self.start, self.piece = file, size, 0, b""

    def at(self, start: int, length: int = FEED_BYTES) -> bytes:
        length = max(0, min(length, self.size - start))
        if start < self.start or start + length > self.start + len(self.piece):
            self.start, self.piece = start, self.file.read_at(min(max(length, READ_BYTES), self.size - start), start) if length else b""
        return self.piece[start - self.start : start - self.start + length]


def headers(lines: bytes) -> dict[str, str]:
    """Named fields, names in lower case; a field that is named twice has its last value."""
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n"))
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def records(source: Source, start: int) -> Iterator[tuple[dict[str, str], bytes]] | None:
    """The records of the gzip member that begins at `start`: (fields, block); then, as the last item, ({}, end of the member).

    None if no member with a WARC record begins there: its header is decoded before anything is taken for granted.
    """
    inflate, at, data = zlib.decompressobj(31), start, bytearray()

    def more(limit: int = 1 << 18) -> bool:
        nonlocal at
        if inflate.eof:
            return False
        fresh = inflate.unconsumed_tail or source.at(at)
        at += 0 if inflate.unconsumed_tail else len(fresh)
        if not fresh:
            raise zlib.error("the member isn't whole")
        data.extend(inflate.decompress(fresh, limit))
        return True

    def head() -> dict[str, str] | None:
        while (end := data.find(b"\r\n\r\n")) < 0:
            if len(data) > HEAD_BYTES or not b"WARC/".startswith(data[:5]) and data[:5] != b"WARC/" or not more(4_096):
                return None
        if data[:5] != b"WARC/":
            return None
        fields = headers(bytes(data[:end]))
        del data[: end + 4]
        return fields if fields.get("content-length", "").isdecimal() else None

    try:
        first = head()
    except zlib.error:
        return None
    if first is None:
        return None

    def run() -> Iterator[tuple[dict[str, str], bytes]]:
        fields = first
        while fields is not None:
            length = int(fields["content-length"])
            while len(data) < length + 4 and more():
                pass
            if len(data) < length:
                raise zlib.error("the record isn't whole")
            yield fields, bytes(data[:length])
            del data[: length + 4]
            while not data and more():
                pass
            fields = head() if data else None
        while more():
            data.clear()
        yield {}, at - len(inflate.unused_data)

    return run()


def scan(source: Source, start: int, end: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, end, fields, block) of each record whose member begins in [start, end), however far it goes on."""
    at = start
    while at < end:
        found = records(source, at) if source.at(at, 3) == MAGIC else None
        if found is None:  # look for the next place where a member may begin
            at += 1
            while at < end:
                piece = source.at(at, min(READ_BYTES, end - at) + 2)
                place = piece.find(MAGIC)
                if 0 <= place < end - at:
                    at += place
                    break
                at += max(1, len(piece) - 2)
            continue
        held = []
        try:
            for fields, block in found:
                if fields:
                    held.append((fields, block))
                else:
                    reach = block
        except zlib.error:  # no whole member after all
            at += 1
            continue
        for fields, block in held:
            yield at, reach, fields, block
        at = reach


def _row(fields: dict[str, str], block: bytes, whole: bool) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    http = fields.get("content-type", "").startswith("application/http")
    if not http:
        head, payload = b"", block
    kind, told = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "revisit":
        size = int(headers(head).get("content-length", len(payload)))
        return page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), size, told, kind, page_of(fields.get("warc-refers-to")), None
    digest = payload_digest(payload)
    if told and told != digest:
        raise ValueError(f"the payload of {fields.get('warc-record-id')} isn't what its digest says")
    return page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), len(payload), digest, kind, None, payload if whole else None


def ranges(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, start, end) of ranges of (file, bytes), dealt over tasks."""
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    out = files.where("bytes > 0").select("file", "bytes", cut.alias("start")).withColumn("end", F.least("bytes", F.col("start") + split_bytes)).drop("bytes")
    return out.repartition(common.shuffle_partitions(files.sparkSession), "file", "start")


def read_warc(spark: SparkSession, path: str, files: DataFrame | None = None, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """The records of the folder's *.warc.gz: file, offset, page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Each task scans a range of bytes for the start of gzip members, takes one for a record only if it decodes to a WARC header, and
    owns the records that start in its range, reading on beyond it for the last one. A member within another one's
    payload (stored, not deflated) is found too, if a range starts there; records that begin before an earlier range's last
    member ends are such, and are left out. A payload that differs from its digest is an error; a member that isn't whole is
    no record. A task holds one member's records at a time. Without files there are no rows.

    files: (file, bytes); without it the folder is listed. payload_bytes and payload_digest of a revisit are of the full payload.
    """
    if files is None:
        system, folder = pa.fs.FileSystem.from_uri(path)
        there = system.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True))
        files = spark.createDataFrame([(f.base_name, f.size) for f in there if f.base_name.endswith(".warc.gz")], "file string, bytes long")
    kinds = [("file", pa.string()), ("start", pa.int64()), ("offset", pa.int64()), ("reach", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = pa.fs.FileSystem.from_uri(path)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])

        for b in batches:
            for name, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows, held = [], 0
                with system.open_input_file(f"{folder}/{name}") as file:
                    for offset, reach, fields, block in scan(Source(file, file.size()), start, end):
                        rows.append((name, start, offset, reach, *_row(fields, block, with_payload)))
                        held += len(block) if with_payload else 0
                        if len(rows) >= common.BATCH_ROWS or held > SPLIT_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    schema = "file string, start long, offset long, reach long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    found = common.save(ranges(files, split_bytes).mapInArrow(run, schema), "records")
    # a row a range: how far the members of earlier ranges of the file reach
    last = found.groupBy("file", "start").agg(F.max("reach").alias("reach"))
    before = F.max("reach").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    floors = last.select("file", "start", before.alias("__floor")).where("__floor > start")
    own = found.join(floors, ["file", "start"], "left").where("__floor is null or offset >= __floor")
    return own.drop("start", "reach", "__floor", *[] if with_payload else ["payload"])
