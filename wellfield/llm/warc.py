"""A content-addressed WARC archive: payloads once, exact headers apart, records rebuilt by a join."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

CRLF = "\r\n"
#: An exported file has about so many bytes of records before it is packed.
FILE_BYTES = 1 << 25
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_sha256 string"


def _field(name: str, value) -> "F.Column":
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def write_archive(pages: DataFrame, path: str, *, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write path/payloads (digest, payload) and path/headers (page_id, digest, header, http).

    A record's header and the head of its HTTP response are kept exactly, apart from the payload, which is stored once.

    Of records with equal payloads of at least `least` bytes the one with the smallest page_id is a response and the
    others revisit it; smaller ones are all responses. Payload rows are made distinct on digest and bytes together,
    so different bytes stay different rows, and read_archive() refuses those that do not match. Line ends in a url are
    blanked, so that no header field can be forged. A null html is an empty payload; a null page_id is written as no
    record id and is never revisited. Rows with one page_id are records of their own under one record id; of equal
    payloads under the smallest id all rows are responses. Payloads are handled by row, however long. An empty table
    gives an empty archive; other columns are ignored.
    """
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ").alias("url"), text.alias("payload"), F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    rows.select("digest", "payload").distinct().write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads")
    narrow = rows.select("page_id", "url", "digest", "bytes")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.length(http) + F.when(F.col("kind") == "response", F.col("bytes")).otherwise(0)
    refers = F.when((F.col("bytes") >= least) & (F.col("page_id") != F.col("first_id")), F.col("first_id"))
    kind = F.when(refers.isNull(), "response").otherwise("revisit")
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _field("WARC-Type", F.col("kind")), _field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        _field("WARC-Target-URI", F.when(F.col("url") != "", F.col("url"))), _field("WARC-Date", F.lit(date)), _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers").cast("string"), F.lit(">"))),
        F.when(F.col("refers").isNotNull(), _field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        _field("Content-Type", F.lit("application/http; msgtype=response")), _field("Content-Length", block), F.lit(CRLF),
    )
    told = narrow.join(first, "digest").withColumn("refers", refers).withColumn("kind", kind)
    told.select("page_id", "digest", header.alias("header"), http.alias("http")).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, http, payload (a revisit has the payload it revisits), payload_digest, record_type, refers_to,
    payload_bytes, record: the exact WARC record, that is header, block (in a revisit without payload) and blank lines.

    Every stored payload is hashed again; one that does not match its digest ends the read with an error, so a digest
    has one payload at most. So does a block whose length is not what its header says. Headers are read from their
    text alone.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    payloads = stored.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest"))).alias("payload"))
    field = lambda name, what: F.regexp_extract("header", rf"\r\n{name}: {what}\r\n", 1)
    id_of = lambda name: F.expr(f"try_cast({name} as bigint)")
    parsed = spark.read.parquet(f"{path}/headers").select(
        field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").alias("own"), "header", "http", field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("payload_digest"),
        field("WARC-Type", "(response|revisit)").alias("record_type"), field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").alias("other"), field("Content-Length", "([0-9]+)").cast("long").alias("length"),
    )
    joined = parsed.join(payloads, parsed["payload_digest"] == payloads["digest"])
    block = F.concat("http", F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))
    whole = F.when(F.octet_length(block) == F.col("length"), F.concat("header", block, F.lit(CRLF * 2))).otherwise(F.raise_error(F.lit("block is not as long as its header says")))
    return joined.select(
        id_of("own").alias("page_id"), "header", "http", "payload", "payload_digest", "record_type", id_of("other").alias("refers_to"), F.octet_length("payload").cast("long").alias("payload_bytes"), whole.alias("record"),
    )


def export_warc(archive: DataFrame, path: str, *, per_file: int = 10_000) -> None:
    """Write the records as packed WARC files of up to per_file records; the writer puts the blank lines after each."""
    ends = F.expr(f"substring(record, 1, length(record) - {len(CRLF * 2)})")
    archive.select(ends).write.mode("overwrite").option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def records_in(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of each record in a WARC file, packed or not, by the lengths that the headers give."""
    source = gzip.open(io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while first := source.readline():
        lines = [first]
        while lines[-1] not in (b"\r\n", b""):
            lines.append(source.readline())
        fields = dict(line.rstrip(b"\r\n").split(b": ", 1) for line in lines[1:-1])
        size = int(fields[b"Content-Length"])
        block = source.read(size)
        if len(block) < size or source.read(4) != b"\r\n\r\n":
            raise ValueError(f"no record end after {size} bytes")
        yield b"".join(lines), block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header, block of every record in the WARC files under path; a task holds one packed file and one record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for header, block in _records(batches):
            yield pa.RecordBatch.from_arrays([pa.array([header.decode()]), pa.array([block.decode()])], ["header", "block"])

    return _files(spark, path).mapInArrow(run, "header string, block string")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_sha256 of every record in the WARC files under
    path, told by the records alone. A response whose payload is not what its digest says ends the read with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for header, block in _records(batches):
            rows.append(_page(header, block))
            if len(rows) == 4096:
                yield _table(rows)
                rows = []
        if rows:
            yield _table(rows)

    return _files(spark, path).mapInArrow(run, READ)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
    for batch in batches:
        for content in batch.column("content"):
            yield from records_in(content.as_py())


def _page(header: bytes, block: bytes) -> tuple:
    fields = dict(line.split(": ", 1) for line in header.decode().split(CRLF)[1:] if line)
    number = lambda name: int(fields[name].removeprefix("<urn:page:").removesuffix(">")) if name in fields else None
    http, _, payload = block.partition(b"\r\n\r\n")
    told = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])
    size, digest, kind = int(told[b"Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload does not match its digest")
    return number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To"), hashlib.sha256(header + block + b"\r\n\r\n").hexdigest()


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in READ.split(", ")])


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to a content-addressed archive in the shared folder, rebuild every record into WARC files, and
    read these files back; see write_archive() for what is a response and for odd rows, read_pages() for the columns."""
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "warc")
    write_archive(pages, scratch.root)
    scratch.until_exit(scratch.root)
    n, size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()  # two numbers
    export_warc(read_archive(spark, scratch.root), f"{scratch.root}/warc", per_file=max(1, int(n * FILE_BYTES / ((size or 0) + 1000 * n + 1))))
    with scratch.small_batches(1):
        return scratch.put("read", read_pages(spark, f"{scratch.root}/warc"))
