"""Web archives: ARC files of either version, converted to WARC with revisit records, and read back.

ARC 1 header lines have five fields (URL, address, date, type, length), ARC 2 lines ten; the file's first record
says which. The converter walks a file by declared lengths and synthesises what WARC adds: record identifiers, ISO
timestamps, record types and payload digests. Among equal payloads of at least ``MIN_REVISIT`` bytes the record with
the largest page id stays a response; the others become revisits that refer to it and keep their HTTP headers only.

An archive's rows are whole files of about ``FILE_BYTES``, written by Spark's text writer one a file and read as binary
files, so no local folder is needed, and neither a writer nor a reader holds more than a file and a record. Payloads are
bytes of any kind. A record without HTTP header, such as ``dns:``, becomes a ``resource`` of its declared type.

Defined cases: null html is the empty payload; null urls are written as ``-`` and read back as null; white space in
urls is percent-encoded; rows with equal page id and payload are all responses; null page ids are kept and sort
below all others; a very long page is one record, held at once; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, arrow_schema, ddl, delete_path, prepare, shared_dir

MIN_REVISIT = 1000
#: Bytes after which an archive file ends.
FILE_BYTES = 16 << 20
#: The capture date of records whose table has none.
DATE = "20240101000000"
ARC_END, WARC_END = b"\n", b"\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page-Id: {}\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def arc_head(version: int, name: str) -> str:
    """The version block, which is the first record of a file."""
    fields = ("URL IP-address Archive-date Content-type Archive-length" if version == 1 else
              "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length")
    block = f"{version} 0 corpus\n{fields}\n"
    head = f"filedesc://{name} 0.0.0.0 {DATE} text/plain"
    head += "" if version == 1 else " 200 - - 0 " + name
    return f"{head} {len(block.encode())}\n{block}"


def arc_record(version: int, name: str, url: str | None, page_id: int | None, html: str | None, offset: int = 0) -> str:
    body = html or ""
    http = _HTTP.format("" if page_id is None else page_id, len(body.encode())) + body
    place = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if url else "-"
    head = f"{place} 0.0.0.0 {DATE} text/html"
    head += "" if version == 1 else f" 200 - - {offset} {name}"
    return f"{head} {len(http.encode())}\n{http}"


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file, walked by declared lengths. The version block says how header lines are laid out."""
    at, names = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.index(b"\n", at)
        fields = data[at:end].decode("utf-8", "surrogateescape").rstrip("\r").split(" ")
        if names is None:
            if not fields[0].startswith("filedesc:"):
                raise ValueError("an ARC file starts with its version block")
            block = data[end + 1 : end + 1 + int(fields[-1])].decode("utf-8", "replace").split("\n")
            names = block[1].rstrip("\r").split(" ")
            if block[0].split(" ")[0] not in ("1", "2") or len(fields) != len(names):
                raise ValueError("unknown ARC version")
        head = dict(zip(names, fields, strict=True))
        size = int(head["Archive-length"])
        body = data[end + 1 : end + 1 + size]
        if len(body) < size:
            raise ValueError("an ARC record is cut off")
        at = end + 1 + size
        if not head["URL"].startswith("filedesc:"):
            yield head | {"block": body}


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower case), the header's bytes, and the payload. A block without HTTP header is all payload."""
    cut = block.find(b"\r\n\r\n") + 4
    if not block.startswith(b"HTTP/") or cut < 4:
        return {}, b"", block
    lines = block[:cut].decode("latin-1").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}, block[:cut], block[cut:]


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def warc_record(kind: str, url: str | None, date: str, page_id: int | None, digest: str, block: bytes,
                refers_to: int | None = None, media: str = "application/http;msgtype=response") -> bytes:
    """One record; ``digest`` is the payload's hexadecimal SHA-1, ``block`` HTTP headers and (but for revisits) payload."""
    moment = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {moment}",
             f"Content-Type: {media}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    lines += [f"WARC-Target-URI: {url}"] * (url is not None)
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                  f"X-Refers-To-Page-Id: {refers_to}", "WARC-Truncated: length"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower case) and block of each record."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        if data[at : at + 5] != b"WARC/":
            raise ValueError("not a WARC record")
        cut = data.index(b"\r\n\r\n", at) + 4
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in data[at:cut].decode().split("\r\n")[1:] if x)}
        size = int(fields["content-length"])
        if cut + size > len(data):
            raise ValueError("a WARC record is cut off")
        yield fields, data[cut : cut + size]
        at = cut + size


def _write_files(df: DataFrame, path: str) -> None:
    """A file for each row of ``df`` (one binary column). Bytes stay as they are in Spark's strings and its text writer."""
    rows = df.select(F.col("value").cast("string"))
    rows.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _in_files(records: Iterator[bytes], end: bytes, head: bytes = b"", most: int = FILE_BYTES) -> Iterator[tuple[bytes]]:
    """Records as contents of files, each begun by ``head``; the text writer adds a line feed."""
    held, size = [], 0
    for r in records:
        held += [r, end]
        size += len(r) + len(end)
        if size >= most:
            yield (head + b"".join(held),)
            held, size = [], 0
    if held:
        yield (head + b"".join(held),)


def _files(spark, path: str) -> DataFrame:
    """File contents as rows."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _unpacked_bytes(files: Iterable[bytes]) -> Iterator[bytes]:
    return (zlib.decompress(raw, 47) if raw[:2] == b"\x1f\x8b" else raw for raw in files)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    return _unpacked_bytes(x.as_py() for batch in batches for x in batch.column(0))


def _in_batches(rows: Iterator[tuple], fields: list[tuple[str, str]], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of some MB."""
    schema, held, size = arrow_schema(fields), [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (str, bytes))) + 8
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def write_arc(pages: DataFrame, path: str, version: int | None = None, most: int = FILE_BYTES) -> None:
    """``page_id, url, html`` as ARC files. Without ``version`` even partitions are written in version 1, odd ones in 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        v, name = version or 1 + part % 2, f"part-{part}.arc"
        records = (
            arc_record(v, name, url, page_id, html).encode()
            for batch in batches for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        )
        yield from _in_batches(_in_files(records, ARC_END, arc_head(v, name).encode(), most), [("value", "binary")])

    docs = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    _write_files(docs.mapInArrow(run, "value binary"), path)


def read_arc(spark, path: str) -> DataFrame:
    """ARC records: ``page_id, url, date, type, head`` (HTTP header), ``payload, digest, payload_bytes``."""
    fields = [("page_id", "bigint"), ("url", "string"), ("date", "string"), ("type", "string"), ("head", "binary"), ("payload", "binary"),
              ("digest", "string"), ("payload_bytes", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for data in _unpacked(batches):
                for r in parse_arc(data):
                    http, head, body = split_http(r["block"])
                    page, url = http.get("x-page-id") or None, r["URL"].encode("utf-8", "surrogateescape").decode("utf-8", "replace")
                    yield (int(page) if page else None, None if url == "-" else url, r["Archive-date"], r["Content-type"],
                           head, body, hashlib.sha1(body).hexdigest(), len(body))

        yield from _in_batches(rows(), fields)

    return _files(spark, path).mapInArrow(run, ddl(fields))


def convert(spark, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT, most: int = FILE_BYTES) -> None:
    """ARC files to WARC files. Digests are counted on narrow rows that combine before their shuffle; only digests that
    repeat are joined."""
    with Scratch(spark) as tmp:
        records = read_arc(spark, arc_path)
        twice = tmp.write(
            records.where((F.col("payload_bytes") >= min_bytes) & (F.length("head") > 0)).groupBy("digest")
            .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
            .where("n > 1 and response_id is not null").select("digest", "response_id")
        )
        joined = records.join(twice, "digest", "left")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows():
                for batch in batches:
                    for url, date, kind, page, digest, head, body, to in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                        if not head:
                            yield warc_record("resource", url, date, page, digest, body, media=kind)
                        elif to is None or page == to:
                            yield warc_record("response", url, date, page, digest, head + body)
                        else:
                            yield warc_record("revisit", url, date, page, digest, head, to)

            yield from _in_batches(_in_files(rows(), WARC_END, most=most), [("value", "binary")])

        order = joined.select("url", "date", "type", "page_id", "digest", "head", "payload", "response_id")
        _write_files(order.mapInArrow(run, "value binary"), warc_path)


def read_warc(spark, path: str) -> DataFrame:
    """WARC records: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``. A response's digest and
    length are those of its payload, and must agree with the header; a revisit's are what it declares."""
    fields = [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"),
              ("refers_to", "bigint"), ("url", "string")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for data in _unpacked(batches):
                for head, block in parse_warc(data):
                    kind = head["warc-type"]
                    http, _, body = split_http(block) if kind != "resource" else ({}, b"", block)
                    declared = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                    size = int(http.get("content-length", len(body)))
                    if kind != "revisit" and (hashlib.sha1(body).hexdigest() != declared or len(body) != size):
                        raise ValueError("a payload differs from its digest")
                    page = http.get("x-page-id") or None
                    yield (int(page) if page else None, size, declared, kind,
                           int(head["x-refers-to-page-id"]) if kind == "revisit" else None, head.get("warc-target-uri"))

        yield from _in_batches(rows(), fields)

    return _files(spark, path).mapInArrow(run, ddl(fields))


def archive(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, html`` through ARC and WARC files in the shared folder and back, as ``read_warc`` gives it. The
    archives go when they have been read."""
    spark = prepare(pages.sparkSession)
    path = shared_dir(spark)
    try:
        write_arc(pages, f"{path}/arc")
        convert(spark, f"{path}/arc", f"{path}/warc", min_bytes)
        with Scratch(spark) as tmp:
            return tmp.keep(tmp.write(read_warc(spark, f"{path}/warc")))
    finally:
        delete_path(spark, path)
