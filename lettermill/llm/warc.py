"""Legacy ARC archives to WARC: header lines by version, declared lengths, synthesised record fields.

Archives are read and converted file by file inside tasks; which of the records with one payload is the
response is an aggregation and a join in Spark; WARC files are written by Spark's text writer, whose line
separator is the two line ends that close a WARC record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm.common import checkpointed, fresh_dir, table

# Fixed by the ARC format: the names in the second line of a version block, per version.
ARC_NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CRLF = b"\r\n"
RECORD_END = "\r\n\r\n"


@dataclass
class ArcRecord:
    """One record; ``fields`` by the names of its archive's version block, ``problem`` if it is damaged."""

    offset: int
    fields: dict[str, str]
    body: bytes
    problem: str | None = None

    @property
    def is_description(self) -> bool:
        return self.fields.get("URL", "").startswith("filedesc://")


def _header(line: bytes, names: list[str]) -> dict[str, str] | None:
    """Fields of a header line. A URL may hold spaces, so fields are counted from the right."""
    parts = line.decode("utf-8", "replace").rsplit(" ", len(names) - 1)
    if len(parts) != len(names) or not re.fullmatch("[0-9]{1,18}", parts[-1]) or ":" not in parts[0]:
        return None
    return dict(zip(names, parts))


def gunzip(content: bytes) -> bytes:
    """What can be read of gzipped content, member after member; a damaged member ends it."""
    out = []
    while content[:2] == b"\x1f\x8b":
        reader = zlib.decompressobj(16 + zlib.MAX_WBITS)
        try:
            out.append(reader.decompress(content))
        except zlib.error:
            # A few bytes at a time, to get at what stands before the damage.
            reader = zlib.decompressobj(16 + zlib.MAX_WBITS)
            for at in range(0, len(content), 16):
                try:
                    out.append(reader.decompress(content[at:at + 16]))
                except zlib.error:
                    break
            break
        content = reader.unused_data.lstrip(b"\0") if reader.eof else b""
    return b"".join(out)


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file (plain or gzipped), the version block first.

    A line that is no header is skipped, and what was skipped is told by the next record's ``problem``; so is
    a body shorter than declared, of an archive that was cut off too. Empty content has no records. A version block
    that tells no version or names that lack a length is read as version 1.
    """
    if content[:2] == b"\x1f\x8b":
        content = gunzip(content)
    names, at, skipped = ARC_NAMES[1].split(" "), 0, 0
    while at < len(content):
        end = content.find(b"\n", at)
        end = len(content) if end < 0 else end
        line = content[at:end].rstrip(b"\r")
        # A version block has the short header, whatever the version it tells.
        fields = _header(line, ARC_NAMES[1].split(" ") if line.startswith(b"filedesc://") else names)
        if fields is None:
            skipped += len(line)
            at = end + 1
            continue
        length = int(fields["Archive-length"])
        body = content[end + 1:end + 1 + length]
        problem = f"{skipped} bytes skipped" if skipped else None
        if len(body) < length:
            problem = f"{length - len(body)} bytes missing"
        record = ArcRecord(at, fields, body, problem)
        if record.is_description:
            told = body.split(b"\n")
            version = re.match(rb"[0-9]{1,3}", told[0])
            named = told[1].decode("ascii", "replace").split() if len(told) > 1 else []
            sound = len(named) > 1 and named[0] == "URL" and named[-1] == "Archive-length"
            names = named if sound else ARC_NAMES.get(int(version[0]) if version else 1, ARC_NAMES[1]).split(" ")
        yield record
        at, skipped = end + 1 + length, 0


def arc_bytes(records: list[tuple[str, str, str, bytes]], version: int, name: str, date: str) -> bytes:
    """An ARC file of (url, ip, type, body) records in the header form of the version."""
    told = f"{version} 0 lettermill\n{ARC_NAMES[version]}\n\n".encode()
    out = [f"filedesc://{name} 0.0.0.0 {date} text/plain {len(told)}\n".encode(), told, b"\n"]
    at = sum(map(len, out))
    for url, ip, kind, body in records:
        known = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Result-code": "200", "Checksum": "-",
                 "Location": "-", "Offset": str(at), "Filename": name, "Archive-length": str(len(body))}
        head = (" ".join(known[n] for n in ARC_NAMES[version].split(" ")) + "\n").encode()
        out += [head, body, b"\n"]
        at += len(head) + len(body) + 1
    return b"".join(out)


def pages_to_arc(pages: DataFrame, date: str = "20000101000000", file_bytes: int = 4 << 20) -> DataFrame:
    """(path, content) like Spark's binary file source: legacy archives of ``pages`` (page_id, url, html).

    Each is an HTTP response per page, up to about ``file_bytes`` per archive (a longer page stands alone), in
    turns of version 1 and 2. The page id travels in an HTTP header. Null html is an empty payload, a null
    or blank url a urn of the page; white space in urls is escaped.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            name = f"pages-{task:06d}-{number:06d}.arc"
            return pa.RecordBatch.from_pydict({"path": [name], "content": pa.array([arc_bytes(held, 1 + number % 2, name, date)], pa.binary())})

        for batch in batches:
            for page, url, html in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "html"))):
                payload = (html.as_py() or "").encode()
                url = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", (url.as_py() or "").strip()) or f"urn:page:{page.as_py()}"
                tag = b"" if page.as_py() is None else f"X-Page-Id: {page.as_py()}\r\n".encode()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n" % (tag, len(payload))
                held.append((url if ":" in url else f"urn:{url}", "0.0.0.0", "text/html", head + payload))
                size += len(head) + len(payload)
                if size >= file_bytes:
                    yield archive()
                    number, held, size = number + 1, [], 0
        if held:
            yield archive()

    return pages.select("page_id", "url", "html").mapInArrow(run, "path string, content binary")


def warc_date(archive_date: str) -> str:
    """A WARC date from an archive date of up to 14 digits; missing digits are those of the year's start."""
    digits = re.sub(r"\D", "", archive_date)[:14]
    digits += "00000101000000"[len(digits):]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(*parts: str) -> str:
    h = hashlib.sha1("\n".join(parts).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-{'89ab'[int(h[16], 16) & 3]}{h[17:20]}-{h[20:32]}>"


def _http_header(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


CONVERTED = ("record_id string, kind string, uri string, date string, ip string, content_type string, page_id bigint, "
             "payload_digest string, payload_bytes bigint, head binary, payload binary")


def convert_arc(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """WARC record fields of every record of the archives (path, content): one row per record.

    ``kind`` is warcinfo for a version block, response for an HTTP response, resource for anything else. The
    identifier is made from uri, date, page id and digest, so a capture repeated in all of them has the
    same identifier. ``head`` is the HTTP header, ``payload`` what follows it. Damaged records are kept with
    what is there. Without ``with_payload`` the two are null (an index pass).
    """
    names = [c.split(" ")[0] for c in CONVERTED.split(", ")]
    types = pa.schema([(c.split(" ")[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split(" ")[1]])
                       for c in CONVERTED.split(", ")])

    def rows(name: str, content: bytes) -> Iterator[tuple]:
        for r in parse_arc(content):
            url, date = r.fields.get("URL", ""), warc_date(r.fields.get("Archive-date", ""))
            head, payload, page = b"", r.body, None
            kind, content_type = "resource", r.fields.get("Content-type", "application/octet-stream")
            if r.is_description:
                kind, content_type = "warcinfo", "application/warc-fields"
                payload = f"software: lettermill\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
            elif r.body.startswith(b"HTTP/"):
                kind, content_type = "response", "application/http; msgtype=response"
                cut = r.body.find(b"\r\n\r\n")
                head, payload = (r.body[:cut + 4], r.body[cut + 4:]) if cut >= 0 else (r.body, b"")
                told = _http_header(head, b"X-Page-Id")
                page = int(told) if told and re.fullmatch(r"-?\d+", told) else None
            digest = digest32(payload)
            unique = _record_id(url, date, str(page), digest, name if kind == "warcinfo" else "")
            yield (unique, kind, url, date, r.fields.get("IP-address", ""), content_type, page, digest, len(payload),
                   head if with_payload else None, payload if with_payload else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                found = list(rows(name.as_py() or "", content.as_py() or b""))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, types.field(n).type) for n, c in zip(names, zip(*found))], schema=types)

    return archives.select("path", "content").mapInArrow(run, CONVERTED)


def with_roles(records: DataFrame, index: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``records`` with ``record_type`` and ``refers_to_id``: of equal payloads the smallest page id responds.

    Payloads are equal if digest and length are. A null page id comes after all others; rows that share the
    smallest page id are all responses. Payloads under ``least_bytes`` are never revisits. ``index`` has the
    same records without their bodies. The sums per payload combine before they are shuffled, and a payload
    shared by many pages is split by AQE on the side that holds the bodies.
    """
    same = ["payload_digest", "payload_bytes"]
    known = index.filter((F.col("kind") == "response") & (F.col("payload_bytes") >= least_bytes))
    first = known.groupBy(*same).agg(F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_id")).alias("_first"))
    joined = records.join(first.hint("shuffle_hash"), same, "left")
    revisit = (F.col("kind") == "response") & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first.page_id"))
    return joined.select(*records.columns, F.when(revisit, "revisit").otherwise(F.col("kind")).alias("record_type"),
                         F.when(revisit, F.col("_first.record_id")).alias("refers_to_id"))


def warc_record() -> Column:
    """The bytes of a record, but for the two line ends that close it."""
    c = F.col
    revisit = c("record_type") == "revisit"
    block = F.when(revisit, c("head")).otherwise(F.concat("head", "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    some = lambda test, *lines: F.when(test, F.concat(*lines)).otherwise("")
    info = c("record_type") == "warcinfo"
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", c("record_type")), line("WARC-Record-ID", c("record_id")), line("WARC-Date", c("date")),
        some(~info, line("WARC-Target-URI", c("uri")), line("WARC-IP-Address", c("ip")),
             line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest"))),
        some(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
             line("WARC-Refers-To", F.coalesce("refers_to_id", F.lit("")))),
        line("Content-Type", c("content_type")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return F.concat(header.cast("binary"), block)


def write_warc(records: DataFrame, path: str, records_per_file: int = 5000) -> None:
    """WARC files, gzipped, of at most ``records_per_file`` records each."""
    (records.select(warc_record().cast("string").alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).mode("error").text(path))


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record, by declared lengths."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while True:
        while content[at:at + 2] == CRLF:
            at += 2
        if at >= len(content):
            return
        end = content.find(b"\r\n\r\n", at)
        if not content.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(headers["content-length"])
        yield headers, content[end + 4:end + 4 + length]
        at = end + 4 + length


READ = ("record_id string, record_type string, page_id bigint, payload_bytes bigint, payload_digest string, "
        "refers_to_id string, digest_ok boolean")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """What the page records of WARC files say; ``digest_ok`` where the payload is there and fits its digest."""
    types = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("refers_to_id", pa.string()), ("digest_ok", pa.bool_())])

    def row(headers: dict[str, str], block: bytes) -> tuple:
        cut = block.find(b"\r\n\r\n")
        head, payload = (block[:cut + 4], block[cut + 4:]) if block.startswith(b"HTTP/") and cut >= 0 else (b"", block)
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        revisit = headers["warc-type"] == "revisit"
        page = _http_header(head, b"X-Page-Id")
        size = int(_http_header(head, b"Content-Length") or 0) if revisit else len(payload)
        return (headers["warc-record-id"], headers["warc-type"], int(page) if page else None, size, digest,
                headers.get("warc-refers-to"), None if revisit else digest32(payload) == digest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = [row(h, b) for h, b in parse_warc(content.as_py()) if "warc-payload-digest" in h]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(types, zip(*found))], schema=types)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, READ)


def pages_through_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """``pages`` as legacy archives, converted to WARC files under ``path`` and read back: one row per page.

    ``refers_to`` is the page id of the record a revisit refers to, found by its identifier.
    """
    archives = pages_to_arc(pages)
    write_warc(with_roles(convert_arc(archives), convert_arc(archives, with_payload=False), least_bytes), path)
    read = checkpointed(read_warc(pages.sparkSession, path))
    answered = (read.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id"))
                .agg(F.min("page_id").alias("refers_to")))
    return read.join(answered, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_through_warc(table(spark, sf_dir, "pages"), fresh_dir(spark, "warc"))


OP1_SQL = r"""
WITH hashed AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_bytes, hex) AS first_id FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
    (((instr('0123456789abcdef', substr(hex, CAST(i * 5 // 4 AS BIGINT) + 1, 1)) - 1) * 16
      + instr('0123456789abcdef', substr(hex, CAST(i * 5 // 4 AS BIGINT) + 2, 1)) - 1)
      // CAST(pow(2, 3 - i * 5 % 4) AS BIGINT)) % 32) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN NULL ELSE true END AS digest_ok
FROM firsts
"""
