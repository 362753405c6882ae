"""Legacy archive converter: ARC files to WARC files.

Method.  An ARC file opens with a version block (``filedesc://...``) whose second
line names the version: version 1 URL records have the header line ``URL
IP-address Archive-date Content-type Archive-length``, version 2 ``URL IP-address
Archive-date Content-type Result-code Checksum Location Offset Filename
Archive-length``.  ``parse_arc`` cuts records by their declared lengths, by the
columns of the version found.  ``to_warc`` makes the WARC equivalent of each:
record id (a name-based UUID of the ARC record's content and its place, archive and byte, so
converting an archive again gives the same ids), ISO date, type (``response`` for HTTP blocks, ``resource`` for others,
``revisit`` for a repeated payload) and SHA-256 digests.

Archives are gzip files that Spark's text writer puts wherever Spark can write:
a row is one record and the line separator is what ends a record in the format
(newline in ARC, two CRLF in WARC).  Reading uses the ``binaryFile`` source, one
archive per task at a time; ``bytes_per_file`` sets the mean size of an archive, records
fall on archives by hashes that are as good as unique.

NULL payloads count as empty; blanks and control characters in a URL are
percent-encoded, a NULL URL becomes ``-``.  Repeated rows are separate records with ids of
their own; a NULL page id is an empty header and comes last in order.  Headers that are not UTF-8
are read as Latin-1.  Dates with fewer than 14 digits start at the first month, day, hour and so
on that they leave out, what is no date becomes 1970-01-01; the original is kept in the header
``ARC-Archive-Date``.
A truncated record (declared length beyond the end) raises ValueError.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

FIELDS = {  # fixed values: the header columns of the two ARC versions
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
MIN_REVISIT_BYTES = 100
_ENCODE = re.compile(r"[\x00-\x20\x7f]")


def arc_header(version: int, name: str, date: str) -> bytes:
    """The version block that opens an ARC file, without its last newline."""
    block = f"{version} 0 archive\n{' '.join(FIELDS[version])}\n".encode()
    extra = "" if version == 1 else " 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(block)}\n".encode() + block


def arc_record(version: int, url: str, ip: str, date: str, mime: str, name: str, block: bytes) -> bytes:
    """One URL record, without the newline that ends it."""
    url = _ENCODE.sub(lambda m: f"%{ord(m[0]):02X}", url or "") or "-"
    extra = "" if version == 1 else f" 200 - - 0 {name}"
    return f"{url} {ip} {date} {mime}{extra} {len(block)}\n".encode("utf-8", "surrogatepass") + block


def _decoded(header: bytes) -> str:
    """Header text: UTF-8, else Latin-1."""
    try:
        return header.decode("utf-8")
    except UnicodeDecodeError:
        return header.decode("latin-1")


def iso_date(date: str) -> str:
    """WARC date of an ARC date, see the module's docstring."""
    full = date + "00000101000000"[len(date):]
    try:
        return datetime.datetime.strptime(full, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def parse_arc(data: bytes) -> Iterator[dict]:
    """The URL records of an ARC file, header columns by name plus ``block`` and ``at``, its first byte."""
    at, version = 0, 1
    while at < len(data):
        if data[at:at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        parts = _decoded(data[at:end]).split(" ")
        length, begin = int(parts[-1]), at
        block = data[end + 1:end + 1 + length]
        if len(block) < length:
            raise ValueError(f"truncated ARC record at byte {at}")
        at = end + 1 + length
        if parts[0].startswith("filedesc://"):
            version = int(block.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        # A legacy content type may hold blanks: the fixed columns are taken from both ends.
        tail = len(FIELDS[version]) - 4
        row = dict(zip(FIELDS[version], [*parts[:3], " ".join(parts[3:-tail]), *parts[-tail:]]))
        yield {**row, "block": block, "at": begin}


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP header with its blank line, payload); no HTTP header: (b'', block)."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def to_warc(record: dict, refers_to: str | None = None, refers_uri: str | None = None) -> bytes:
    """The WARC record of an ARC record, without the two CRLF that end it.  A digest
    under ``payload_digest`` and an id under ``record`` are taken as they are."""
    head, payload = split_http(record["block"])
    digest = record.get("payload_digest") or hashlib.sha256(payload).hexdigest()
    kind = "revisit" if refers_to else "response" if head else "resource"
    block = head if refers_to else record["block"]
    old = record["Archive-date"]
    date = iso_date(old)
    name = record.get("record") or record_id(record, head, digest)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {record['URL']}", f"WARC-IP-Address: {record['IP-address']}",
             f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             "Content-Type: " + ("application/http; msgtype=response" if head else record["Content-type"])]
    if re.sub("[^0-9]", "", date) != old:
        lines.append(f"ARC-Archive-Date: {old}")
    if refers_to:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {refers_to}", f"WARC-Refers-To-Target-URI: {refers_uri}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block


def record_id(record: dict, head: bytes, digest: str, archive: str = "") -> str:
    """Name-based identifier of an ARC record's header, content (its HTTP header and the
    digest of its payload) and place."""
    name = " ".join([record["URL"], record["Archive-date"], hashlib.sha256(head).hexdigest(), digest,
                     archive, str(record.get("at", ""))])
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode('utf-8', 'surrogatepass')).digest()[:16], version=5)}>"


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"broken WARC header at byte {at}")
        lines = _decoded(data[at:end]).split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        length = int(headers["Content-Length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length:
            raise ValueError(f"truncated WARC record at byte {at}")
        yield headers, block
        at = end + 4 + length + 4


def write_arc(rows: DataFrame, path: str, version: int | tuple[int, ...] = 1, bytes_per_file: int = 16 << 20) -> None:
    """Write (url, ip, date, mime, block) rows as gzip ARC files of about ``bytes_per_file``;
    of several versions each file takes the next."""
    total = rows.agg(F.sum(F.length("block"))).first()[0] or 0
    rows = rows.select("url", "ip", "date", "mime", "block").repartition(max(1, -(-total // bytes_per_file)))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, part = True, TaskContext.get().partitionId()
        kind = version if isinstance(version, int) else version[part % len(version)]
        for df in frames:
            name = f"pages-{part:05d}.arc.gz"
            out = [arc_record(kind, *x[:4], name, x[4]) for x in df.itertuples(index=False)]
            if first and out:
                out.insert(0, arc_header(kind, name, df["date"].iloc[0]))
                first = False
            yield pd.DataFrame({"value": out})

    lines = rows.mapInPandas(encode, "value binary")
    lines.select(F.col("value").cast("string")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


_RECORD = ("url string, ip string, date string, mime string, record string, http boolean, payload_bytes long, "
           "payload_digest string, page string, block binary")


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of the ARC files under ``path``; ``page``: the HTTP header X-Page-Id, if any.
    Without ``blocks`` the block is NULL and never leaves the parsing task."""
    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for place, content in zip(df["path"], df["content"]):
                part: list[tuple] = []
                held = 0
                for r in parse_arc(gzip.decompress(content)):
                    head, payload = split_http(r["block"])
                    digest = hashlib.sha256(payload).hexdigest()
                    part.append((r["URL"], r["IP-address"], r["Archive-date"], r["Content-type"],
                                 record_id(r, head, digest, place.rsplit("/", 1)[-1]), bool(head), len(payload), digest,
                                 http_value(head, "X-Page-Id"), r["block"] if blocks else None))
                    held += len(r["block"]) if blocks else 1000
                    if held > 4 << 20:
                        yield pd.DataFrame(part, columns=_NAMES)
                        part, held = [], 0
                yield pd.DataFrame(part, columns=_NAMES)
    return _archives(spark, path).mapInPandas(parse, _RECORD)


_NAMES = [x.strip().split(" ")[0] for x in _RECORD.split(",")]


def http_value(head: bytes, name: str) -> str | None:
    """A header of an HTTP block, or None."""
    found = re.search(rb"(?mi)^" + name.encode() + rb": *([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


def page_order() -> Column:
    """Records by the number in X-Page-Id; records without one last."""
    return F.coalesce(F.expr("try_cast(page as long)"), F.lit((1 << 63) - 1))


def write_warc(records: DataFrame, path: str, order: Column, heads: DataFrame | None = None,
               bytes_per_file: int = 16 << 20) -> None:
    """Write ARC records as gzip WARC files of about ``bytes_per_file``.  Of the records with equal
    payloads of at least ``MIN_REVISIT_BYTES`` the smallest in ``order`` is written whole, the others
    are revisits of it.  ``heads``: the same records without their blocks.

    Who revisits whom is decided on the heads alone, which are staged once; blocks are shuffled once, by
    record id, so a payload that a third of all records share does not gather in one task.
    """
    heads = (records if heads is None else heads).select("record", "url", "payload_digest", "payload_bytes",
                                                         order.alias("o"))
    heads = staged(heads, "op5-heads")
    total = heads.agg(F.sum("payload_bytes") + F.count("*") * 1000).first()[0] or 0
    big = heads.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
    first = big.groupBy("payload_digest").agg(F.count("*").alias("n"), F.min(
        F.struct("o", "record", "url")).alias("first")).where("n > 1").select("payload_digest", "first")
    again = big.join(first, "payload_digest").where(F.col("record") != F.col("first.record")).select(
        "record", F.col("first.record").alias("refers_to"), F.col("first.url").alias("refers_uri"))
    rows = records.select("record", "url", "ip", "date", "mime", "block", "payload_digest")
    rows = rows.repartition(max(1, -(-total // bytes_per_file)), "record").join(again, "record", "left")
    rows = rows.select("record", "url", "ip", "date", "mime", "block", "payload_digest", "refers_to", "refers_uri")

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            out = []
            for record, url, ip, date, mime, block, digest, to, uri in df.itertuples(index=False):
                r = {"record": record, "URL": url, "IP-address": ip, "Archive-date": date, "Content-type": mime, "block": block,
                     "payload_digest": digest}
                out.append(to_warc(r, to or None, uri))
            yield pd.DataFrame({"value": out})

    lines = rows.mapInPandas(encode, "value binary")
    lines.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(record, type, url, date, payload_digest, payload_bytes, page, refers_to, payload) of the
    WARC files under ``path``; a revisit has the length that its HTTP header declares and no payload.
    Without ``payloads`` they are checked against their digests, but not returned."""
    names = ["record", "type", "url", "date", "payload_digest", "payload_bytes", "page", "refers_to", "payload"]

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for content in df["content"]:
                part: list[tuple] = []
                held = 0
                for h, block in parse_warc(gzip.decompress(content)):
                    head, payload = split_http(block)
                    revisit = h["WARC-Type"] == "revisit"
                    if not revisit and f"sha256:{hashlib.sha256(payload).hexdigest()}" != h["WARC-Payload-Digest"]:
                        raise ValueError(f"payload of {h['WARC-Record-ID']} does not fit its digest")
                    size = int(http_value(head, "Content-Length") or 0) if revisit else len(payload)
                    part.append((h["WARC-Record-ID"], h["WARC-Type"], h["WARC-Target-URI"], h["WARC-Date"],
                                 h["WARC-Payload-Digest"].split(":", 1)[1], size, http_value(head, "X-Page-Id"),
                                 h.get("WARC-Refers-To"), payload if payloads and not revisit else None))
                    held += len(block) if payloads else 1000
                    if held > 4 << 20:
                        yield pd.DataFrame(part, columns=names)
                        part, held = [], 0
                yield pd.DataFrame(part, columns=names)
    return _archives(spark, path).mapInPandas(parse, "record string, type string, url string, date string, "
                                              "payload_digest string, payload_bytes long, page string, "
                                              "refers_to string, payload binary")


def arc_rows(pages: DataFrame, date: str = "20080430204825") -> DataFrame:
    """(url, ip, date, mime, block) of pages: an HTTP response that names the page."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "),
                    F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\nContent-Length: "),
                    F.length(body).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.coalesce("url", F.lit("")).alias("url"), F.lit("0.0.0.0").alias("ip"),
                        F.lit(date).alias("date"), F.lit("text/html").alias("mime"),
                        F.concat(head.cast("binary"), body).alias("block"))
