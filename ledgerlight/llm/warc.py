"""Legacy archives to WARC.

The converter reads ARC files of version 1 and 2, gzipped (as one or many members) or
plain. A file starts with a version block whose first line tells the length of the block;
its last line names the fields of the header lines that follow. Every record is a header
line and a body of exactly the declared length, so a body may hold anything: header lines,
line breaks, and bytes that are no text. For each record an equivalent WARC record is made:
a name-based ``urn:uuid`` from url, date, file, offset and payload, an ISO timestamp, the
address, the type, and the payload's SHA-1 in base32. A body that opens with an HTTP header is
a response: the header is kept as archived and is no part of the payload. Any other body
is a resource. The first response of a payload stays, later ones revisit it.

Damaged records (a header line without its fields, length or date, a body or a compressed
file cut short) are left out and reported with file, offset and reason; reading goes on at the
next line that is a whole header line whose body fits.

``page_records`` runs the whole way: pages to ARC files, ARC to WARC files, and
the WARC files read back. The page's id is the fragment of the archived url. Files are
written (gzip) by Spark's text writer, whose separator closes a record, to the shared
folder, and read as binary files of about ``FILE_BYTES``: a task's memory does not grow with
the input. Archives are parsed once.

Defined cases: null html is empty; null urls are written as ``unknown:``, and blanks in urls as ``%20``
(the header line is split on them); rows without page_id revisit a row with an id and
their payload, and are responses where there is none; rows of one page_id are all kept, and of
those with one payload all are responses; html may itself open with an HTTP header; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import remove, scratch, split_by_ids, written

FILE_BYTES = 16 << 20
#: The field lines that close the version block of the two ARC versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_RECORD = "record binary"
#: Opens the fragment that holds a page's id; a missing id is a dash.
KEY_MARK = "#page-id="
#: Fixed value: the address of records whose address is not known.
NO_ADDRESS = "0.0.0.0"


# --- ARC ------------------------------------------------------------------------------

def arc_header(version: int, name: str, date: str) -> str:
    """The version block that opens an ARC file, up to the blank line."""
    body = f"{version} 0 llm\n{FIELDS[version]}\n"
    tail = ["text/plain"] + (["200", "-", "-", "0", name] if version == 2 else [])
    return f"filedesc://{name} 0.0.0.0 {date} {' '.join(tail)} {len(body.encode())}\n{body}"


def _arc_record(version: Column, url: Column, date: Column, html: Column) -> Column:
    """Header line, archived HTTP header and payload."""
    body = F.concat(F.lit("HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n"), html)
    size = F.octet_length(body).cast("string")
    head = F.concat_ws(" ", url, F.lit(NO_ADDRESS), date, F.lit("text/html"))
    more = F.concat_ws(" ", F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc"))
    return F.concat(F.when(version == 2, F.concat_ws(" ", head, more, size)).otherwise(F.concat_ws(" ", head, size)),
                    F.lit("\n"), body)


def unpacked(data: bytes) -> tuple[bytes, str | None]:
    """The bytes of a gzip file of any number of members, or of a plain one, as far
    as they can be read, and what stops the reading."""
    if data[:2] != b"\x1f\x8b":
        return data, None
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(data))
        except zlib.error as e:
            return b"".join(out), f"damaged compression: {e}"
        if not member.eof:
            return b"".join(out), "compressed file cut short"
        data = member.unused_data
    return b"".join(out), None if not data.strip(b"\0") else "bytes after the compressed members"


_LINE = re.compile(rb"^\S[^\n]* \d{4,14} [^\n]*\d\r?$", re.MULTILINE)


def _header(line: bytes, fields: list[str]) -> tuple[dict, int] | str:
    """The named fields of a header line and the body's length, or what is wrong with it."""
    parts = line.decode("utf-8", "replace").rstrip("\r").split(" ")
    if not (parts[-1].isascii() and parts[-1].isdigit()):
        return "header line without a length"
    if len(parts) < len(fields):
        return "header line without all fields"
    cut = len(parts) - len(fields) + 1                        # a url may hold blanks: count from the end
    named = dict(zip(fields[1:], parts[cut:]))
    try:
        date = iso_date(named.get("Archive-date", ""))
    except ValueError:
        return "header line without a date"
    return {"url": " ".join(parts[:cut]), "ip": named.get("IP-address", NO_ADDRESS), "date": date,
            "type": named.get("Content-type", "application/octet-stream")}, int(parts[-1])


def _next_header(data: bytes, at: int, fields: list[str]) -> int:
    """Where, from ``at`` on, the next whole header line starts whose body fits."""
    for m in _LINE.finditer(data, at):
        found = _header(m.group(), fields)
        if not isinstance(found, str) and m.end() + 1 + found[1] <= len(data):
            return m.start()
    return len(data)


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file: offset, url, ip, date (ISO), type and body; or offset and
    error for a damaged one. The version block tells the fields, the declared length the
    end of every body."""
    fields, at = FIELDS[1].split(" "), 0
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):                 # the blank line between records
            at += 1
            continue
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end]
        if line.startswith(b"filedesc://"):
            size = line.rstrip(b"\r").rsplit(b" ", 1)[-1]
            block = data[end + 1:end + 1 + int(size)] if size.isdigit() else b""
            named = block.decode("utf-8", "replace").splitlines()[1:2]
            if named and len(block) == int(size):
                fields, at = named[0].split(" "), end + 1 + int(size)
                continue
            found: tuple[dict, int] | str = "damaged version block"
        else:
            found = _header(line, fields)
        if not isinstance(found, str) and end + 1 + found[1] > len(data):
            found = "body cut short"
        if isinstance(found, str):
            yield {"offset": at, "error": found}
            at = _next_header(data, min(end + 1, len(data)), fields)
            continue
        yield found[0] | {"offset": at, "body": data[end + 1:end + 1 + found[1]]}
        at = end + 1 + found[1]


def http_split(body: bytes) -> tuple[bytes | None, bytes]:
    """(archived HTTP header with its blank line, payload); no header: (None, body)."""
    if body[:5] == b"HTTP/":
        m = re.search(rb"\r?\n\r?\n", body)
        if m:
            return body[:m.end()], body[m.end():]
    return None, body


# --- WARC -----------------------------------------------------------------------------

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, "\x1f".join(parts)).urn


def iso_date(date: str) -> str:
    """14 digits to ISO; shorter dates are filled up, as early archives cut them."""
    if not (date.isascii() and date.isdigit() and 4 <= len(date) <= 14):
        raise ValueError(f"no archive date: {date[:40]}")
    full = date + "19700101000000"[len(date):]
    return datetime.strptime(full, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


_ARCHIVED = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("error", pa.string()), ("url", pa.string()), ("ip", pa.string()),
                       ("date", pa.string()), ("type", pa.string()), ("bytes", pa.int64()), ("sha", pa.string()), ("id", pa.string()),
                       ("http", pa.binary()), ("body", pa.binary())])


def _archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ARC files (path, content) to one row per record with its WARC identity."""
    def frame(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_ARCHIVED)

    for files in batches:
        for path, content in zip(files.column("path"), files.column("content")):
            file, rows = path.as_py().rsplit("/", 1)[-1], []
            data, stop = unpacked(content.as_py())
            for r in parse_arc(data):
                if "error" not in r:
                    http, payload = http_split(r["body"])
                    sha = digest(payload)
                    r |= {"bytes": len(payload), "sha": sha, "http": http, "body": payload,
                          "id": record_id(r["url"], r["date"], file, str(r["offset"]), sha)}
                rows.append(r | {"file": file})
                if len(rows) == 500:
                    yield frame(rows)
                    rows = []
            if stop:
                rows.append({"file": file, "offset": len(data), "error": stop})
            yield frame(rows)


def _warc_record() -> Column:
    """A WARC/1.1 record without its last newline, which the writer adds. A revisit's
    block is its HTTP header; its payload's length stands in an extension field."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    http, body = F.col("http").cast("string"), F.col("body").cast("string")      # bytes as they are
    response = F.col("http").isNotNull()
    revisit = response & F.col("first").isNotNull() & ~F.col("first.at").eqNullSafe(F.col("at"))
    block = F.when(revisit, http).when(response, F.concat(http, body)).otherwise(body)
    kind = F.when(revisit, F.lit("revisit")).when(response, F.lit("response")).otherwise(F.lit("resource"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("id"), F.lit(">"))), line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("url")),
        F.when(F.col("ip") != NO_ADDRESS, line("WARC-IP-Address", F.col("ip"))).otherwise(F.lit("")),
        line("Content-Type", F.when(response, F.lit("application/http; msgtype=response")).otherwise(F.col("type"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                 line("WARC-Refers-To", F.concat(F.lit("<"), F.col("first.id"), F.lit(">"))),
                                 line("WARC-Refers-To-Target-URI", F.col("first.url")),
                                 line("WARC-Refers-To-Date", F.col("first.date")))).otherwise(F.lit("")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block, F.lit("\r\n\r"))


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record; the declared length ends the block."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        at = end + 4 + int(fields["Content-Length"])
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError("WARC record without its end")
        yield fields, data[end + 4:at]
        at += 4


def _page_id(url: str) -> int | None:
    key = url.rsplit(KEY_MARK, 1)[-1]
    return None if key == "-" else int(key)


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        for content in files["content"]:
            rows = []
            for fields, block in parse_warc(unpacked(content)[0]):
                if fields["WARC-Type"] == "warcinfo":
                    continue
                kind, sha, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                if kind == "response":                       # the payload follows the HTTP header
                    payload = http_split(block)[1]
                    if digest(payload) != sha or len(payload) != size:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                rows.append((_page_id(fields["WARC-Target-URI"]), size, sha, kind,
                             _page_id(fields["WARC-Refers-To-Target-URI"]) if kind == "revisit" else None))
            out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


# --- files ----------------------------------------------------------------------------

def _write(records: DataFrame, opening: str, n_bytes: int, n_records: int, path: str) -> None:
    """Records as gzip files of about FILE_BYTES by the mean size of a record,
    each opened by ``opening``; no shuffle."""
    per_file = max(1, FILE_BYTES * n_records // max(n_bytes, 1))

    def framed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        for batch in batches:
            out = []
            for record in batch["record"]:
                if n % per_file == 0:
                    out.append(opening.encode())
                out.append(record)
                n += 1
            yield pd.DataFrame({"record": out}, dtype=object)

    (records.select(F.col("record").cast("binary")).mapInPandas(framed, _RECORD).select(F.col("record").cast("string")).write.option("lineSep", "\n").option("compression", "gzip")
     .option("maxRecordsPerFile", per_file + 1).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _sizes(df: DataFrame, size: Column) -> tuple[int, int]:
    row = df.agg(F.sum(size), F.count(F.lit(1))).first()
    return row[0] or 0, row[1]


def write_arc(pages: DataFrame, path: str, version: int = 1, date: str = "20240229120000") -> None:
    """``pages`` (page_id, url, html) as ARC files, each with its version block."""
    url = F.concat(F.regexp_replace(F.coalesce("url", F.lit("unknown:")), r"\s", "%20"), F.lit(KEY_MARK),
                   F.coalesce(F.col("page_id").cast("string"), F.lit("-")))
    html = F.coalesce("html", F.lit(""))
    _write(pages.select(_arc_record(F.lit(version), url, F.lit(date), html).alias("record")), arc_header(version, "pages.arc", date),
           *_sizes(pages, F.octet_length(html) + 180), path)


def convert(spark: SparkSession, arc_path: str, warc_path: str, order: Column | None = None) -> DataFrame:
    """ARC files in ``arc_path`` to WARC files in ``warc_path``; returns the damaged
    records (file, offset, error). Of the responses of one payload the least by
    ``order`` (of file, offset, url and date; null: never) stays; without it, the earliest one."""
    order = F.struct("date", "file", "offset") if order is None else order
    rows = written(_files(spark, arc_path).mapInArrow(_archived, from_arrow_schema(_ARCHIVED)), "warc-parsed")
    good = rows.where("error is null").withColumn("at", order)
    first = F.min(F.when(F.col("at").isNotNull(), F.struct("at", "id", "url", "date"))).alias("first")
    copied = written(good.where("http is not null").groupBy("sha").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first"),
                     "warc-payloads")
    # Payloads that surely have no copy need no shuffle to their copies.
    shared, alone = split_by_ids(good, copied, "sha")
    shared = shared.join(copied.hint("merge"), "sha", "left")
    alone = alone.withColumn("first", F.lit(None).cast(copied.schema["first"].dataType))
    records = alone.unionByName(shared).select(_warc_record().alias("record"))
    info = "software: llm archive converter\r\nformat: WARC File Format 1.1\r\n"
    opening = ("WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <" + record_id("warcinfo", info) + ">\r\n"
               "WARC-Date: 2024-02-29T12:00:00Z\r\nContent-Type: application/warc-fields\r\n"
               f"Content-Length: {len(info)}\r\n\r\n{info}\r\n\r")
    _write(records, opening, *_sizes(good, F.col("bytes") + 700), warc_path)
    return rows.where("error is not null").select("file", "offset", "error")


def page_records(pages: DataFrame, version: int = 1) -> DataFrame:
    """Pages to ARC, ARC to WARC, and what reading the WARC files back gives:
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    arcs, warcs = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(pages, arcs, version)
    convert(spark, arcs, warcs, F.substring_index("url", KEY_MARK, -1).try_cast("long"))
    remove(spark, arcs)
    return _files(spark, warcs).mapInPandas(
        _read_back, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
