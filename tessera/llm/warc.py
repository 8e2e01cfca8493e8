"""Operator 6: WARC archives and transaction assembly.

:func:`write_warc` writes each capture as three records (request, response or revisit,
metadata); the request and the metadata name the response record in
``WARC-Concurrent-To``. Of captures with equal payloads of at least ``revisit_bytes``
bytes, the one with the largest page_id is the response and the others refer to
it. Spark's text writer makes the files, gzipped, in any store it can write to.
Every record starts with the version line and one boundary header with a number
drawn for the archive, so :func:`read_archive` can let Spark's reader cut files at
records, no matter what a payload holds; each block is checked against its
Content-Length. :func:`read_warc` reads archives from elsewhere, file by file.

:func:`captures` joins the records of a transaction through the concurrent-to
ids into one nested row per capture; a revisit gets payload size and digest
of the response it refers to. :func:`assemble` adds the payloads.

Defined cases: null html is an empty payload; null urls have no target header; line ends in
urls are percent-encoded; a null page_id is never referred to and stays a
response; rows equal in all three columns are one capture; an empty table gives
no captures. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import io
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import text_bytes, written
from tessera.session import scratch_table_path

CRLF = "\r\n"
END = "\r\n\r\n"
#: Fixed capture date: the tables hold none.
DATE = "2024-01-01T00:00:00Z"


def _record_id(kind: str, *keys: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(boundary: str, kind, fields: dict[str, Column], block: Column) -> Column:
    """Text of one record; a null field is left out."""
    parts = [F.lit(f"WARC/1.1{CRLF}{boundary}{CRLF}WARC-Type: "), kind]
    for name, value in fields.items():
        parts.append(F.coalesce(F.concat(F.lit(f"{CRLF}{name}: "), value), F.lit("")))
    parts += [F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}Content-Length: "), F.octet_length(block).cast("string"),
              F.lit(END), block]
    return F.concat(*parts)


def new_boundary() -> str:
    return f"WARC-Boundary: {uuid.uuid4()}"


def write_warc(pages: DataFrame, path: str, boundary: str, revisit_bytes: int = 1000,
               records_per_file: int = 20_000) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped archives below ``path``."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"),
                        F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    marked = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    small = marked.select("page_id", "url", "digest", F.octet_length("payload").alias("size"))
    large = small.where((F.col("size") >= revisit_bytes) & F.col("page_id").isNotNull())
    top = large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("top"), F.count("*").alias("c"))
    later = (large.join(top.where("c > 1"), "digest").where("page_id <> top.page_id")
             .select("page_id", "digest", "top").distinct())
    full = marked.join(later, ["page_id", "digest"], "left")
    keys = [F.col("page_id"), F.col("url"), F.col("digest")]
    main = _record_id("response", *keys)
    revisit = F.col("top").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(END))
    target = {"WARC-Target-URI": F.col("url")}
    request = _record(boundary, F.lit("request"), {
        "WARC-Record-ID": _record_id("request", *keys), "WARC-Concurrent-To": main, **target,
        "Content-Type": F.lit("application/http; msgtype=request")},
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{END}")))
    response = _record(boundary, F.when(revisit, "revisit").otherwise("response"), {
        "WARC-Record-ID": main, **target, "Content-Type": F.lit("application/http; msgtype=response"),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
        "WARC-Profile": F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        "WARC-Refers-To": F.when(revisit, _record_id("response", F.col("top.page_id"), F.col("top.url"),
                                                     F.col("digest")))},
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))))
    metadata = _record(boundary, F.lit("metadata"), {
        "WARC-Record-ID": _record_id("metadata", *keys), "WARC-Concurrent-To": main, **target,
        "Content-Type": F.lit("application/warc-fields")},
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)))
    (full.select(F.concat_ws(END, request, response, metadata).alias("value"))
     .write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("lineSep", END)
     .option("maxRecordsPerFile", records_per_file).text(path))


def read_archive(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """(headers, block) of the records of archives that :func:`write_warc` wrote; blocks are bytes."""
    text = spark.read.option("lineSep", f"WARC/1.1{CRLF}{boundary}{CRLF}").text(path).where("value <> ''")
    head = F.substring_index("value", END, 1)
    raw = F.col("value").cast("binary")
    # the blank line after the head and the two line ends after the block do not count
    cut = text.select(head.alias("head"), "value").select(
        "head", F.substring(raw, F.octet_length("head") + 5,
                            F.octet_length("value") - F.octet_length("head") - 8).alias("block"))
    fields = cut.select(F.str_to_map("head", F.lit(CRLF), F.lit(": ")).alias("headers"), "block")
    right = F.octet_length("block") == F.col("headers")["Content-Length"].cast("bigint")
    return fields.select("headers", F.when(right, F.col("block")).otherwise(
        F.raise_error(F.lit("a record's block differs from its Content-Length")).cast("binary")).alias("block"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block) of WARC files of any origin, plain or gzipped by record: each
    file is parsed in order by one task, so a file must fit into it."""
    def records(raw: bytes):
        data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
        f = io.BytesIO(data)
        while line := f.readline():
            if not line.startswith(b"WARC/"):
                continue
            head = []
            while (line := f.readline().strip()):
                name, _, value = line.decode("utf-8", "replace").partition(":")
                head.append((name, value.strip()))
            size = int(dict((k.lower(), v) for k, v in head).get("content-length", 0))
            yield list(dict(head).items()), f.read(size)

    def run(batches):
        kind = pa.map_(pa.string(), pa.string())
        for b in batches:
            data, off = text_bytes(b.column(0))
            for i in range(b.num_rows):
                got = list(records(data[off[i]:off[i + 1]].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in got], kind),
                                                  pa.array([x for _, x in got], pa.binary())], ["headers", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        run, "headers map<string,string>, block binary")


def _payload() -> Column:
    """Bytes after the HTTP head of a block."""
    return F.substring(F.col("block"), F.octet_length(F.substring_index(F.col("block").cast("string"), END, 1)) + 5,
                       F.octet_length("block"))


def _index(records: DataFrame) -> DataFrame:
    """One small row per record, as a written table: the archives are parsed once. A response's
    payload is held against its digest."""
    h = F.col("headers")
    full = F.col("type") == "response"
    rows = records.select(
        h["WARC-Type"].alias("type"), h["WARC-Record-ID"].alias("id"), h["WARC-Concurrent-To"].alias("to"),
        h["WARC-Refers-To"].alias("refers"), h["WARC-Target-URI"].alias("url"), h["WARC-Payload-Digest"].alias("digest"),
        "block").withColumn("payload", F.when(full, _payload()))
    right = ~full | F.col("digest").isNull() | (F.concat(F.lit("sha1:"), F.sha1("payload")) == F.col("digest"))
    note = F.when(F.col("type").isin("request", "metadata"), F.col("block").cast("string"))
    return written(rows.select(
        "type", "id", "to", "refers", "url", F.octet_length("payload").cast("bigint").alias("size"), note.alias("note"),
        F.when(right, F.when(full, F.sha1("payload"))).otherwise(
            F.raise_error(F.lit("a payload differs from its digest")).cast("string")).alias("sha1")), "warc-index")


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, url, page_id, request, response, metadata).

    ``response`` has record_type, payload_bytes, payload_digest and, for a revisit, the page it
    refers to; sizes and digests are those of the full payload."""
    rows = _index(records)

    def part(kind):
        return F.max(F.when(F.col("type") == kind, F.struct(F.col("id").alias("record_id"), F.col("note").alias("block"))))

    side = (rows.where(F.col("type").isin("request", "metadata")).groupBy(F.col("to").alias("id"))
            .agg(part("request").alias("request"), part("metadata").alias("metadata"))
            .withColumn("page_id", F.regexp_extract("metadata.block", r"page-id: (-?[0-9]+)", 1).try_cast("bigint")))
    main = (rows.where(F.col("type").isin("response", "revisit")).select("id", "url", "type", "refers", "size", "sha1")
            .dropDuplicates(["id"]))
    seen = (main.where("type = 'response'").join(side.select("id", "page_id"), "id", "left").select(
        F.col("id").alias("refers"), F.col("sha1").alias("seen_sha1"), F.col("size").alias("seen_size"),
        F.col("page_id").alias("seen_page")))
    # a response looks itself up, so that there is no null key that all responses share
    whole = main.join(side, "id", "left").withColumn("own", F.col("refers").isNull()).withColumn(
        "refers", F.coalesce("refers", "id"))
    return whole.join(seen, "refers", "left").select(
        F.col("id").alias("record_id"), "url", "page_id", "request",
        F.struct(F.col("type").alias("record_type"), F.coalesce("size", "seen_size").alias("payload_bytes"),
                 F.coalesce("sha1", "seen_sha1").alias("payload_digest"),
                 F.when(~F.col("own"), F.col("seen_page")).alias("refers_to")).alias("response"), "metadata")


def assemble(records: DataFrame) -> DataFrame:
    """:func:`captures` with the payload bytes in ``response`` (null for a revisit)."""
    payloads = (records.where(F.col("headers")["WARC-Type"] == "response")
                .select(F.col("headers")["WARC-Record-ID"].alias("record_id"), _payload().alias("payload"))
                .dropDuplicates(["record_id"]))
    return captures(records).join(payloads, "record_id", "left").withColumn(
        "response", F.col("response").withField("payload", F.col("payload"))).drop("payload")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read it back: its records."""
    spark = pages.sparkSession
    path, boundary = scratch_table_path(spark, "warc"), new_boundary()
    write_warc(pages, path, boundary)
    return read_archive(spark, path, boundary)


def report(pages: DataFrame) -> DataFrame:
    """Digest columns of the captures of a :func:`round_trip`, one row each."""
    r = "response"
    return captures(round_trip(pages)).select("page_id", f"{r}.payload_bytes", f"{r}.payload_digest", f"{r}.record_type",
                                    f"{r}.refers_to")
