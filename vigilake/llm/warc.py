"""WARC archives: writing with segmentation, revisits and chunked payloads, and reading them back.

Archives are gzip text files that Spark writes and reads itself, so they may lie in any store. A record is one row and the
row separator is the blank line pair that ends a record. Reading cuts the stream at the version line and joins pieces again
until a record has the length its header states, so a payload may hold any bytes, the version line included. Segments are
then grouped by the id of the record they continue.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.session import staging_path

VERSION = "WARC/1.1"
SEGMENT_BYTES = 64 * 1024       # longer HTTP blocks go on in continuation records
CHUNK_BYTES = 16 * 1024         # chunk size of the transfer coding
RECORDS_PER_FILE = 200_000
RAW = ("record_id string, kind string, uri string, digest string, refers_to string, origin string, segment int, total bigint, "
       "content binary")
_DIGITS = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, from five hexadecimal digits (20 bits) at a time."""
    hexa = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexa, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), *_DIGITS)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, size and ``first``: the page whose response this record revisits, else null.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the smallest page_id is the response.
    Only sizes and digests are shuffled to find it.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": sha1_base32(F.col("payload")), "size": F.octet_length("payload").cast("bigint")})
    keys = rows.filter(F.col("size") >= least_bytes).select("digest", "size", "page_id")
    firsts = keys.groupBy("digest", "size").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = (keys.join(firsts.drop("n"), ["digest", "size"]).filter("least is not null and not (page_id <=> least)")
              .select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), F.col("least").alias("first"))
              .dropDuplicates(["__page", "__digest"]))
    same = F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest"))
    return rows.join(copies, same, "left").drop("__page", "__digest")


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def _urn(page: Column, own: Column | None = None, segment: Column | None = None) -> Column:
    """Id of a record: page and payload, and what tells rows that are equal in both apart. Without ``own`` it names them all."""
    parts = [F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), F.col("digest")]
    if own is not None:
        parts += [F.lit(":"), own]
    if segment is not None:
        parts.append(F.when(segment > 1, F.concat(F.lit("-"), segment.cast("string"))).otherwise(F.lit("")))
    return F.concat(*parts, F.lit(">"))


def _chunked(payload: Column, chunk: int) -> Column:
    """The payload in chunked transfer coding."""
    starts = F.when(F.octet_length(payload) > 0, F.sequence(F.lit(1), F.octet_length(payload), F.lit(chunk))).otherwise(
        F.expr("cast(array() as array<int>)"))
    frame = lambda at: F.concat(
        F.lower(F.hex(F.least(F.lit(chunk), F.octet_length(payload) - at + 1).cast("bigint"))).cast("binary"), F.lit(b"\r\n"),
        F.substring(payload, at, F.lit(chunk)), F.lit(b"\r\n"))
    return F.concat(F.aggregate(F.transform(starts, frame), F.lit(b""), lambda a, b: F.concat(a, b)), F.lit(b"0\r\n\r\n"))


def records(pages: DataFrame, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES, least_bytes: int = 0) -> DataFrame:
    """(record string): the archive's records without the blank lines that end them. Bytes of any kind pass unchanged."""
    # every row is a record of its own; all segments of a record are written by one task, so they share its id
    rows = with_revisits(pages, least_bytes).withColumn("own", F.expr("uuid()"))
    revisit = F.col("first").isNotNull()
    status = F.lit(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n")
    block = F.when(revisit, status).otherwise(F.concat(status, _chunked(F.col("payload"), chunk)))
    sized = rows.select("page_id", "own", "url", "digest", "size", "first", block.alias("block")).withColumn(
        "total", F.octet_length("block"))
    parts = sized.withColumn("number", F.explode(F.sequence(F.lit(1), F.greatest(
        F.lit(1), F.ceil(F.col("total") / F.lit(segment)).cast("int")))))
    number, page = F.col("number"), F.col("page_id")
    last = F.ceil(F.col("total") / F.lit(segment))
    body = F.substring(F.col("block"), (number - 1) * segment + 1, F.lit(segment))
    kind = F.when(number > 1, "continuation").when(revisit, "revisit").otherwise("response")
    many = last > 1
    head = F.concat(
        F.lit(f"{VERSION}\r\n"), _header("WARC-Type", kind), _header("WARC-Record-ID", _urn(page, F.col("own"), number)),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        _header("WARC-Payload-Digest", F.when(number == 1, F.concat(F.lit("sha1:"), F.col("digest")))),
        _header("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", F.when(revisit, _urn(F.col("first")))),
        _header("WARC-Segment-Number", F.when(many, number.cast("string"))),
        _header("WARC-Segment-Origin-ID", F.when(number > 1, _urn(page, F.col("own")))),
        _header("WARC-Segment-Total-Length", F.when(many & (number == last), F.col("total").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"))
    return parts.select(F.concat(head.cast("binary"), body).cast("string").alias("record"))


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES, least_bytes: int = 0,
                   per_file: int = RECORDS_PER_FILE) -> None:
    """One record per row of ``pages`` (page_id bigint, url string, html string; further columns are ignored) under ``path``.

    A null html is an empty payload, a null url an empty one. Every row is a record, also where page_id and payload repeat
    or the page_id is null; a row without an id revisits the smallest page with its payload, or is a response where there
    is none. Of equal payloads all rows of the smallest page are responses. An empty table writes no record.
    """
    (records(pages, segment, chunk, least_bytes).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives, segments still apart. A stream that ends inside a record is an error."""
    lines = spark.read.option("lineSep", f"{VERSION}\r\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_parse, RAW)


def _parse(batches):
    marker = f"{VERSION}\r\n".encode()
    file, pending = None, None
    for batch in batches:
        rows = []
        for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != file:
                if pending is not None:
                    raise ValueError(f"record cut off at the end of {file}")
                file, pending = name, None
                if not value:
                    continue  # nothing stands in front of the first version line
            pending = value if pending is None else pending + marker + value
            record = _record(pending)
            if record is not None:
                rows.append(record)
                pending = None
        columns = list(zip(*rows)) if rows else [[] for _ in _TYPES]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES.values())], names=list(_TYPES))
    if pending is not None:
        raise ValueError(f"record cut off at the end of {file}")


def _record(data: bytes) -> tuple | None:
    """Fields of one record, or None while its block is not complete."""
    split = data.find(b"\r\n\r\n")
    if split < 0:
        return None
    named = {}
    for line in data[:split].decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        named[name.strip().lower()] = value.strip()
    size = int(named["content-length"])
    if len(data) < split + 4 + size + 4:
        return None
    number, total = named.get("warc-segment-number"), named.get("warc-segment-total-length")
    return (named.get("warc-record-id"), named.get("warc-type"), named.get("warc-target-uri"), named.get("warc-payload-digest"),
            named.get("warc-refers-to"), named.get("warc-segment-origin-id"), int(number) if number else None,
            int(total) if total else None, data[split + 4:split + 4 + size])


_TYPES = {"record_id": pa.string(), "kind": pa.string(), "uri": pa.string(), "digest": pa.string(), "refers_to": pa.string(),
          "origin": pa.string(), "segment": pa.int32(), "total": pa.int64(), "content": pa.binary()}


def reassemble(raw: DataFrame) -> DataFrame:
    """Whole records: continuation records are joined to the record they continue, in segment order.

    Only segmented records are shuffled. A record whose numbers have a gap, or whose length is not the stated total, is an
    error.
    """
    whole = raw.filter("segment is null").drop("origin", "segment", "total")
    parts = raw.filter("segment is not null").withColumn("of", F.coalesce("origin", "record_id"))
    first = lambda name: F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name)
    joined = parts.groupBy("of").agg(
        *[first(name) for name in ("record_id", "kind", "uri", "digest", "refers_to")],
        F.max("total").alias("total"), F.max("segment").alias("last"),
        F.array_sort(F.collect_set(F.struct("segment", "content"))).alias("segments"))
    content = F.aggregate("segments", F.lit(b""), lambda acc, s: F.concat(acc, s["content"]))
    complete = (F.size("segments") == F.col("last")) & (F.octet_length("content") == F.col("total"))
    checked = joined.withColumn("content", content).withColumn("content", F.when(complete, F.col("content")).otherwise(
        F.raise_error(F.concat(F.lit("incomplete segments of "), F.coalesce("of", F.lit("?")))).cast("binary")))
    return whole.unionByName(checked.select(*whole.columns))


def decode_http(content: bytes) -> bytes:
    """Payload of an HTTP response block: what follows its header, with chunked framing taken off."""
    head, _, body = content.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + size])
        if len(out[-1]) != size or body[line + 2 + size:line + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        at = line + 4 + size


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """record_id, kind, uri, digest, refers_to and payload of every record; revisits have a null payload."""
    names = ["record_id", "kind", "uri", "digest", "refers_to", "payload"]
    types = [pa.string()] * 5 + [pa.binary()]

    def run(batches):
        for batch in batches:
            kinds = batch.column(1).to_pylist()
            payloads = [None if kind == "revisit" else decode_http(c.as_py()) for kind, c in zip(kinds, batch.column(5))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(payloads, types[5])], names=names)

    rows = reassemble(read_records(spark, path)).select(*names[:5], "content")
    return rows.mapInArrow(run, "record_id string, kind string, uri string, digest string, refers_to string, payload binary")


def sha1_text(payload: bytes) -> str:
    """The digest of ``sha1_base32`` outside Spark."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def round_trip(pages: DataFrame, segment: int = SEGMENT_BYTES, least_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back and describe every record.

    (page_id, payload_bytes, payload_digest, record_type, refers_to): size and digest are those of the payload read, for
    revisits those of the response they refer to. One row per row of ``pages``; edge cases are those of ``write_archives``.
    """
    spark = pages.sparkSession
    path = staging_path(spark, "warc")
    write_archives(pages, path, segment, least_bytes=least_bytes)
    read = read_payloads(spark, path).select(
        "record_id", "kind", "refers_to", F.regexp_replace("digest", "^sha1:", "").alias("stated"), F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"))
    # digests only from here on
    page = lambda name: F.nullif(F.regexp_extract(name, r"<urn:page:(-?\d*):", 1), F.lit("")).cast("bigint")
    return read.select(page("record_id").alias("page_id"), F.col("kind").alias("record_type"), F.when(
        F.col("kind") == "revisit", page("refers_to")).alias("refers_to"), "stated", "payload_bytes", "payload_digest")


def resolve_revisits(rows: DataFrame) -> DataFrame:
    """Give revisit rows the size and digest of the response they refer to, found by page and stated digest."""
    own = rows.filter("record_type != 'revisit'")
    revisits = rows.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    known = own.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"), "payload_bytes", "payload_digest")
    known = known.dropDuplicates(["refers_to", "stated"])  # all responses of a page and payload are alike
    return own.unionByName(revisits.join(known, ["refers_to", "stated"], "left").select(*own.columns))
