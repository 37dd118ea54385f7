"""Converts legacy ARC archives to WARC, with synthesised identifiers, dates, types and digests."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from uuid import UUID

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, batch, batch_of_rows, lists, read_file, share_smallest, write_file

ROLL_BYTES = 16 << 20  # of one archive, before compression
# The field names that each ARC version declares for its record lines.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CHUNK = 1 << 14  # bytes handed to the decompressor at once
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER = "X-Page-Id"
NO_ID = 2**63 - 1

FILES = "part int, path string"
INDEX = (
    "part int, path string, ordinal int, page_id long, payload_bytes long, digest string, "
    "uri string, arc_version int"
)
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ARC, writing


def _clean(url: str | None) -> str:
    """A URL that fits a line of fields separated by spaces."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "urn:unknown"


def arc_record(version: int, url: str, date: str, kind: str, body: bytes, offset: int, filename: str) -> bytes:
    fields = [url, "0.0.0.0", date, kind]
    if version == 2:
        fields += ["200", hashlib.md5(body).hexdigest(), "-", str(offset), filename]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_head(version: int, filename: str, date: str) -> bytes:
    body = f"{version} 0 origin\n{FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{filename}", date, "text/plain", body, 0, filename)


def http_response(page_id: int | None, payload: bytes) -> bytes:
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"{ID_HEADER}: {page_id}")
    return "\r\n".join([*head, "", ""]).encode() + payload


def _write_arcs(folder: str, date: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        packed, size, offset, paths = [], 0, 0, []

        def close() -> None:
            nonlocal packed, size, number
            path = f"{folder}/{task:06d}-{number:05d}.arc.gz"
            write_file(path, b"".join(packed))
            paths.append(path)
            packed, size, number = [], 0, number + 1

        for rows in batches:
            for page_id, url, html in lists(rows, "page_id", "url", "html"):
                name, version = f"{task:06d}-{number:05d}.arc.gz", 1 + (task + number) % 2
                if not packed:
                    packed.append(gzip.compress(arc_head(version, name, date), 1, mtime=0))
                body = http_response(page_id, (html or "").encode())
                offset = len(packed[0]) if len(packed) == 1 else offset + len(packed[-1])
                record = arc_record(version, _clean(url), date, "text/html", body, offset, name)
                packed.append(gzip.compress(record, 1, mtime=0))
                size += len(record)
                if size >= roll_bytes:
                    close()
        if packed:
            close()
        yield batch(FILES, [[task] * len(paths), paths])

    return write


def write_arcs(
    pages: DataFrame, scratch: Scratch, folder: str, date: str = "20240101000000", roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Pages as ARC archives, of both versions in turn; returns the archives."""
    source = pages.select(pages["page_id"].cast(LongType()).alias("page_id"), pages["url"], pages["html"])
    return scratch.pin(source.mapInArrow(_write_arcs(folder, date, roll_bytes), FILES), "arcs")


# ARC, reading


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """The gzip members of a file, each a record, with their offsets."""
    at = 0
    while at < len(data):
        unpacker, offset, parts = zlib.decompressobj(wbits=31), at, []
        while not unpacker.eof:
            some = data[at : at + CHUNK]
            if not some:
                raise ValueError(f"the member at {offset} is cut short")
            parts.append(unpacker.decompress(some))
            at += len(some) - len(unpacker.unused_data)
        yield offset, b"".join(parts)


def parse_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC file after its version block.

    The block's first line names the version and its second line the fields. A record line is
    split from its right end, by as many fields as the version has. The declared length
    decides where the body ends; a body that is shorter or followed by more than line ends is an error.
    """
    names: list[str] = []
    version = 0
    for offset, raw in members(data):
        line, _, rest = raw.partition(b"\n")
        parts = line.decode("utf-8", "replace").rstrip("\r")
        length = int(parts.rpartition(" ")[2])
        body = rest[:length]
        if len(body) != length or rest[length:].strip(b"\r\n"):
            raise ValueError(f"record at {offset}: {len(rest)} bytes where {length} are declared")
        if not names:
            if not parts.startswith("filedesc://"):
                raise ValueError("an ARC file starts with its version block")
            first, fields = body.decode().splitlines()[:2]
            version, names = int(first.split()[0]), fields.split()
            if version not in FIELDS or fields != FIELDS[version]:
                raise ValueError(f"unknown ARC version: {first} / {fields}")
            continue
        values = dict(zip(names, parts.rsplit(" ", len(names) - 1), strict=True))
        yield {"offset": offset, "version": version, "body": body, **values}


def split_http(body: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields in lower case, the header block with its empty line, and the payload."""
    end = body.find(b"\r\n\r\n")
    if not body.startswith(b"HTTP/") or end < 0:
        return {}, b"", body
    head = body[: end + 4]
    fields = (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, c, v in fields if c}, head, body[end + 4 :]


# WARC


def warc_date(arc_date: str) -> str:
    """ISO 8601 out of the 14 digits of ARC, or of fewer where old archives left off."""
    digits = (arc_date + "00000101000000"[len(arc_date) :])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:]}Z"


def record_id(page_id: int | None, arc: str, offset: int) -> str:
    """A version 8 UUID: made of the page's id where there is one, else of the place in the archive.

    Equal input always gives equal ids, so a repeated task writes the same file, and a revisit
    can name its response without looking it up.
    """
    if page_id is None:
        value = int.from_bytes(hashlib.sha256(f"{arc}:{offset}".encode()).digest()[:16]) | 1 << 60
    else:
        unsigned = page_id & (1 << 64) - 1
        value = (unsigned >> 16) << 80 | (unsigned >> 4 & 0xFFF) << 64 | (unsigned & 0xF)
    value = value & ~(0xF << 76) & ~(0x3 << 62) | 8 << 76 | 2 << 62
    return f"<urn:uuid:{UUID(int=value)}>"


def page_of(identifier: str) -> int | None:
    """The page id inside a record id made by record_id."""
    value = UUID(identifier.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 60 & 1:
        return None
    unsigned = (value >> 80) << 16 | (value >> 64 & 0xFFF) << 4 | (value & 0xF)
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def convert(record: dict, arc: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """The WARC record of an ARC record. URLs that are not http(s) become resources."""
    http, head, payload = split_http(record["body"])
    own = int(http[ID_HEADER.lower()]) if ID_HEADER.lower() in http else None
    block, kind = record["body"], "response" if head else "resource"
    fields = {
        "WARC-Record-ID": record_id(own, arc, record["offset"]),
        "WARC-Date": warc_date(record["Archive-date"]),
        "WARC-Target-URI": record["URL"],
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "Content-Type": "application/http; msgtype=response" if head else record["Content-type"],
    }
    if is_revisit:
        block, kind = head, "revisit"
        fields["WARC-Profile"] = PROFILE
        if refers_to is not None:
            fields["WARC-Refers-To"] = record_id(refers_to, "", 0)
    if record["IP-address"] != "0.0.0.0":
        fields["WARC-IP-Address"] = record["IP-address"]
    fields["WARC-Block-Digest"] = f"sha1:{base32_sha1(block)}"
    return warc_record({"WARC-Type": kind, **fields}, block)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    for offset, raw in members(data):
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at {offset}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        if rest[length:] != b"\r\n\r\n":
            raise ValueError(f"record at {offset}: the declared length is wrong")
        yield fields, rest[:length]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for part, path in lists(rows, "part", "path"):
            out = []
            for ordinal, record in enumerate(parse_arc(read_file(path))):
                http, _, payload = split_http(record["body"])
                page_id = int(http[ID_HEADER.lower()]) if ID_HEADER.lower() in http else None
                digest = base32_sha1(payload)
                out.append((part, path, ordinal, page_id, len(payload), digest, record["URL"], record["version"]))
            yield batch_of_rows(INDEX, out)


def _convert_files(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arc, records, packed, paths = "", iter(()), [], []

        def close() -> None:
            if packed:
                paths.append(f"{folder}/{arc.rpartition('/')[2].removesuffix('.arc.gz')}.warc.gz")
                write_file(paths[-1], b"".join(packed))
                packed.clear()

        for rows in batches:
            for path, is_revisit, refers_to in lists(rows, "path", "revisit", "refers_to"):
                if path != arc:
                    close()
                    arc, records = path, parse_arc(read_file(path))
                    info = b"software: ARC to WARC converter\r\nformat: WARC File Format 1.1\r\n"
                    head = {"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(None, path.rpartition("/")[2], -1)}
                    head |= {"WARC-Date": "2024-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}
                    packed.append(gzip.compress(warc_record(head, info), 1, mtime=0))
                record = convert(next(records), path.rpartition("/")[2], refers_to, is_revisit)
                packed.append(gzip.compress(record, 1, mtime=0))
        close()
        yield batch(FILES, [[TaskContext.get().partitionId()] * len(paths), paths])

    return write


def convert_arcs(arcs: DataFrame, scratch: Scratch, folder: str, min_bytes: int = 0) -> DataFrame:
    """Convert ARC archives to one WARC archive each; returns the WARC archives.

    Of records with equal payloads of at least `min_bytes` bytes the one with the smallest page
    id is a response and the others revisit it (of equal ids the first in the archives; records
    without an id come behind all others). The first pass parses every archive and keeps a line
    per record. The smallest of a digest is found per partition first, so a payload shared by a
    third of all records is no hot key. The second pass writes each archive in its old order.
    """
    parts = max(1, arcs.count())
    index = arcs.select("part", "path").repartition(parts, "path").mapInArrow(_index, INDEX)
    index = scratch.pin(index, "index")
    rank = F.struct(F.coalesce("page_id", F.lit(NO_ID)).alias("id"), "path", "ordinal")
    shared = F.when(F.col("payload_bytes") >= min_bytes, F.col("digest")).otherwise(
        F.concat_ws(" ", "path", "ordinal")
    )
    ranked = share_smallest(index.withColumns({"rank": rank, "payload": shared}), "payload", "rank", "first")
    plan = ranked.select(
        "path",
        "ordinal",
        (F.col("first") != F.col("rank")).alias("revisit"),
        F.nullif("first.id", F.lit(NO_ID)).alias("refers_to"),
    )
    plan = plan.repartition(parts, "path").sortWithinPartitions("path", "ordinal")
    return scratch.pin(plan.mapInArrow(_convert_files(folder), FILES), "warcs")


def _read_warcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for path in rows.column("path").to_pylist():
            out = []
            for fields, block in parse_warc(read_file(path)):
                if fields["WARC-Type"] == "warcinfo":
                    continue
                http, _, payload = split_http(block)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size, refers_to = len(payload), None
                if fields["WARC-Type"] == "revisit":
                    size = int(http["content-length"])
                    if "WARC-Refers-To" in fields:
                        refers_to = page_of(fields["WARC-Refers-To"])
                elif digest != base32_sha1(payload):
                    raise ValueError(f"{path}: a payload does not match its digest")
                out.append((page_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers_to))
            yield batch_of_rows(PAGES, out)


def read_warcs(warcs: DataFrame) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return warcs.repartition(max(1, warcs.count()), "path").mapInArrow(_read_warcs, PAGES)


def pages_to_warc(pages: DataFrame, scratch: Scratch, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC archives, those to WARC archives, and the records read back from these.

    A null html is an empty payload. A null page_id is kept: its record gets an id from its place
    in the archive. Spaces and control characters of a URL are percent-encoded. Repeated rows are
    a record each. Other columns are ignored. An empty table gives no archive and no row.
    """
    folder = folder or scratch.path
    arcs = write_arcs(pages, scratch, f"{folder}/arc-files")
    return read_warcs(convert_arcs(arcs, scratch, f"{folder}/warc-files", min_bytes))
