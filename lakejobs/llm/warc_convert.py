"""Legacy archive converter: ARC files to WARC records, with deduplicated payloads.

ARC files are read as whole files (their size is the writer's choice) and parsed in one pass:
the version block names the fields of the header lines that follow, and every record's last
field declares its length. Equivalent WARC identifiers, times, types and digests are made up
from what the legacy headers say. Writing and reading go through Spark's own file formats, so
that archives may lie on any file system.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The field lines of both versions of the legacy format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}
# Fixed value: the profile URI of revisit records of equal payloads.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: URLs
WARC_END = "\r\n\r\n"
ID_HEADER = b"X-Archive-Id"
CHUNK = 1 << 20
PIECE = 1 << 16  # bytes that a gzip member is fed at once


def inflated(content: bytes) -> bytes:
    """A file's bytes; gzip files may have any number of members."""
    if content[:2] != b"\x1f\x8b":
        return content
    # Fed by offset and in pieces, so that a member costs its own size and not the file's.
    out, view, at = [], memoryview(content), 0
    while content[at:at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        while not member.eof and at < len(content):
            piece = view[at:at + PIECE]
            out.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        if not member.eof:
            raise ValueError("the last gzip member is not whole")
    return b"".join(out)


def arc_block(version: int, name: str) -> bytes:
    body = f"{version} 0 lakejobs\n{FIELDS[version]}\n".encode()
    head = ["filedesc://" + name, "0.0.0.0", "20240101000000", "text/plain"]
    head += ["200", "-", "-", "0", name] if version == 2 else []
    return " ".join([*head, str(len(body))]).encode() + b"\n" + body


def arc_record(version: int, url: str, date: str, body: bytes, name: str) -> bytes:
    """One record; white space and control signs of the URL are percent-encoded."""
    safe = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~") or "about:blank"
    head = [safe, "0.0.0.0", date, "text/html"]
    if version == 2:
        head += ["200", hashlib.md5(body).hexdigest(), "-", "0", name]
    return " ".join([*head, str(len(body))]).encode() + b"\n" + body


def parse_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(header fields, body, offset) of every record after the version block.

    Raises on a header line that does not fit its version, and on a length beyond the file."""
    at, fields = 0, None
    while at < len(content):
        if content[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        stop = content.find(b"\n", at)
        line = content[at:stop if stop >= 0 else len(content)].decode("latin-1").rstrip("\r")
        values = line.split(" ")
        length = int(values[-1]) if values[-1].isdigit() else -1
        begin = stop + 1
        if stop < 0 or length < 0 or begin + length > len(content):
            raise ValueError(f"no record at byte {at}: {line[:80]!r}")
        body = content[begin:begin + length]
        if fields is None or line.startswith("filedesc:"):
            named = body.decode("latin-1").split("\n")
            version = int(named[0].split(" ")[0])
            fields = named[1].strip().split(" ")
            if version not in FIELDS or fields[-1] != "Archive-length":
                raise ValueError(f"unknown version block: {named[:2]}")
        else:
            # A URL of old crawlers may hold spaces: the other fields are counted from the right.
            extra = len(values) - len(fields)
            if extra < 0:
                raise ValueError(f"too few fields at byte {at}: {line[:80]!r}")
            values = [" ".join(values[:extra + 1]), *values[extra + 1:]]
            yield dict(zip(fields, values, strict=True)), body, at
        at = begin + length


def warc_date(legacy: str) -> str:
    """ISO 8601 of a legacy date of 8 to 14 digits; what is missing or impossible is the least."""
    digits = re.sub(r"\D", "", legacy)[:14]
    digits += "00000101000000"[len(digits):]
    year, month, day, hour, minute, second = (
        int(digits[a:b]) for a, b in ((0, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 14)))
    return (f"{year:04d}-{min(max(month, 1), 12):02d}-{min(max(day, 1), 31):02d}"
            f"T{min(hour, 23):02d}:{min(minute, 59):02d}:{min(second, 59):02d}Z")


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its empty line) and payload; no head where the body has none."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    stop = body.find(b"\r\n\r\n")
    return (body[:stop + 4], body[stop + 4:]) if stop >= 0 else (body, b"")


def head_value(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        if line[:len(name) + 1].lower() == name.lower() + b":":
            return line[len(name) + 1:].strip().decode("latin-1")
    return None


PARSED = ("file string, offset long, source_id long, url string, ip string, date string, "
          "content_type string, record_id string, http_head binary, payload binary, "
          "payload_bytes long, payload_digest string")


def parsed_files(batches) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PARSED.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]
             for c in PARSED.split(", ")]

    def out(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            file = path.as_py().rpartition("/")[2]
            rows, held = [], 0
            for fields, body, offset in parse_arc(inflated(content.as_py())):
                head, payload = split_http(body)
                own = head_value(head, ID_HEADER)
                record = uuid.uuid5(NAMESPACE, f"{file}#{offset}")
                rows.append((
                    file, offset, int(own) if own else None, fields["URL"], fields["IP-address"],
                    warc_date(fields["Archive-date"]), fields["Content-type"],
                    f"<urn:uuid:{record}>", head, payload, len(payload),
                    hashlib.sha1(payload).hexdigest()))
                held += len(body)
                if held > CHUNK:
                    yield out(rows)
                    rows, held = [], 0
            yield out(rows)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the ARC files (plain or gzip) below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(parsed_files, PARSED)


def write_arc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html", date: str = "20240101000000") -> None:
    """Write pages as legacy archives, one a task, even ones as version 1 and odd ones as 2."""

    def archive(batches):
        number = TaskContext.get().partitionId()
        version, name = 1 + number % 2, f"part-{number:05d}.arc"
        first = [arc_block(version, name)]
        for batch in batches:
            out = first
            for own, url, html in zip(*(c for c in batch.columns), strict=True):
                key = own.as_py()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (
                    b"" if key is None else ID_HEADER + b": %d\r\n" % key) + b"\r\n"
                body = head + (html.as_py() or "").encode()
                out.append(arc_record(version, url.as_py(), date, body, name))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
            first = []
        if first:
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.binary())], ["record"])

    pages.select(
        F.col(f"`{id_col}`").cast("long"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`"),
    ).mapInArrow(archive, "record binary").select(F.col("record").cast("string")).write.option(
        "lineSep", "\n").option("maxRecordsPerFile", 0).option(
        "compression", "gzip").text(path)


def with_revisits(records: DataFrame, least: int = 1000) -> DataFrame:
    """Add ``record_type`` and what a revisit refers to.

    Of records with equal payloads of at least ``least`` bytes, the one with the largest id (then
    the last by file and place) is the response. Only payloads that occur twice or more are
    joined, by one row each; adaptive execution splits a payload that many records share."""
    place = F.struct(F.coalesce("source_id", F.lit(-(1 << 63))).alias("own"), "file", "offset")
    known = records.where(F.col("payload_bytes") >= least).select(
        F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"),
        F.struct(place.alias("place"), "source_id", "record_id", "url", "date").alias("_one"))
    response = known.groupBy("_digest", "_bytes").agg(
        F.max_by("_one", "_one.place").alias("_one"), F.count("*").alias("_n"),
    ).where("_n > 1").drop("_n")
    joined = records.join(
        response, (F.col("payload_digest") == F.col("_digest"))
        & (F.col("payload_bytes") == F.col("_bytes")), "left")
    revisit = F.col("_one").isNotNull() & (F.col("_one.place") != place)
    return joined.withColumn(
        "record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    ).withColumn("refers_to", F.when(revisit, F.col("_one"))).drop("_digest", "_bytes", "_one")


def warc_text() -> Column:
    """Head and block of each WARC record, without the two empty lines behind it."""
    revisit = F.col("record_type") == "revisit"
    http = F.length("http_head") > 0

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")).cast("binary")

    def maybe(condition: Column, name: str, value: Column) -> Column:
        return F.when(condition & value.isNotNull(), line(name, value)).otherwise(
            F.lit("").cast("binary"))

    block = F.when(revisit, F.col("http_head")).otherwise(F.concat("http_head", "payload"))
    kind = F.when(F.col("record_type") == "revisit", F.lit("revisit")).when(
        http, F.lit("response")).otherwise(F.lit("resource"))
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return F.concat(
        F.lit("WARC/1.1\r\n").cast("binary"),
        line("WARC-Type", kind), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("ip")), line("WARC-Payload-Digest", digest),
        line("X-Payload-Length", F.col("payload_bytes")),
        maybe(F.lit(True), "X-Archive-Id", F.col("source_id")),
        maybe(revisit, "WARC-Profile", F.lit(SAME_PAYLOAD)),
        maybe(revisit, "WARC-Refers-To", F.col("refers_to.record_id")),
        maybe(revisit, "WARC-Refers-To-Target-URI", F.col("refers_to.url")),
        maybe(revisit, "WARC-Refers-To-Date", F.col("refers_to.date")),
        maybe(revisit, "X-Refers-To-Id", F.col("refers_to.source_id")),
        line("Content-Type", F.when(http, F.lit("application/http; msgtype=response")).otherwise(
            F.col("content_type"))),
        line("Content-Length", F.length(block)), F.lit("\r\n").cast("binary"), block)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records with their type as gzip WARC files, one a task."""
    records.select(warc_text().cast("string").alias("record")).write.option(
        "lineSep", WARC_END).option("maxRecordsPerFile", 0).option(
        "compression", "gzip").text(path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(head fields, block) of every record; raises where a record is not whole."""
    at = 0
    while at < len(content):
        stop = content.find(b"\r\n\r\n", at)
        lines = content[at:stop].decode("utf-8").split("\r\n") if stop >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}: {lines[0][:80]!r}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        begin = stop + 4
        end = begin + int(fields["Content-Length"])
        if content[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} has no end")
        yield fields, content[begin:end]
        at = end + 4


READ = ("record_id string, record_type string, url string, date string, source_id long, "
        "payload_bytes long, payload_digest string, refers_to_record string, refers_to long, "
        "payload binary")


def read_files(batches) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in READ.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]
             for c in READ.split(", ")]

    def out(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def number(value: str | None) -> int | None:
        return None if value is None else int(value)

    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for fields, block in parse_warc(inflated(content.as_py())):
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = fields["WARC-Type"] == "revisit"
                payload = None if revisit else split_http(block)[1]
                if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"digest of {fields['WARC-Record-ID']} does not fit")
                size = int(fields["X-Payload-Length"]) if revisit else len(payload)
                rows.append((
                    fields["WARC-Record-ID"], fields["WARC-Type"], fields["WARC-Target-URI"],
                    fields["WARC-Date"], number(fields.get("X-Archive-Id")), size, digest,
                    fields.get("WARC-Refers-To"), number(fields.get("X-Refers-To-Id")), payload))
                held += len(block)
                if held > CHUNK:
                    yield out(rows)
                    rows, held = [], 0
            yield out(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the WARC files (plain or gzip) below a path; a revisit has no payload."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(read_files, READ)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 1000) -> None:
    """Convert all legacy archives below one path to WARC files below another.

    Payloads of at least ``least`` bytes are stored once. No archive gives no record."""
    write_warc(with_revisits(read_arc(spark, arc_path), least), warc_path)
