"""Web pages as WARC records in ZIP-packaged archives, and a reader that extracts nothing.

``write_archives`` finds equal payloads, and each task writes the records of its partition into one
archive: a ZIP file whose members are stored as they are: ``archive/data.warc.gz`` (every record a gzip
member of its own), ``indexes/index.cdxj`` (a line per record with its place) and
``datapackage.json``. ``read_archives`` finds the central directory from the end of each file, by the
ZIP64 records where those stand, locates the data of the members, and range-reads the records at
the places that the index gives.

Of records with equal payloads of at least ``least_bytes`` bytes, those with the largest page id are
responses and the others revisit them; smaller payloads are all responses. A null html is an empty
payload. A null page id is smaller than any other; if all ids of a payload are null, all its records
are responses. Repeated rows are records of their own. An empty table gives no archive.

Attempts of a task write files of different names; the manifest, a table, names those that count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.llm.common import pieces
from dockpulse.llm.files import attempt_path, locate, shared_folder
from dockpulse.session import stage

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
BLOCK = 4 << 20  # records are read in blocks of about so many bytes
MANIFEST = "part int, path string, n_records long"
DATE = "2000-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(page_id, url, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has headers only."""
    block = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Refers-To: {page_urn(refers_to)}", f"WARC-Profile: {SAME_PAYLOAD}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers in lower case, and the payload behind the HTTP headers."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC record at this place")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


class ArchiveWriter:
    """Writes records as they come; only the index is held until the end."""

    def __init__(self, path: str):
        system, inside = locate(path)
        self.out = system.open_output_stream(inside)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.place, self.lines = 0, []

    def add(self, page_id, url, payload: bytes, refers_to: int | None, revisit: bool) -> None:
        data = gzip.compress(record(page_id, url, payload, refers_to, revisit), 6, mtime=0)
        self.member.write(data)
        entry = {"id": page_id, "offset": self.place, "length": len(data), "filename": WARC_MEMBER}
        self.lines.append(f"{page_urn(page_id)} {json.dumps(entry)}\n")
        self.place += len(data)

    def close(self) -> int:
        self.member.close()
        self.zip.writestr(INDEX_MEMBER, "".join(self.lines))
        resources = [{"path": WARC_MEMBER}, {"path": INDEX_MEMBER}]
        package = {"profile": "data-package", "wacz_version": "1.1.1", "resources": resources}
        self.zip.writestr("datapackage.json", json.dumps(package))
        self.zip.close()
        self.out.close()
        return len(self.lines)


class ArchiveReader:
    """The members of a ZIP file, found from its end, and range reads inside stored ones."""

    def __init__(self, path: str):
        system, inside = locate(path)
        self.file = system.open_input_file(inside)
        self.size = self.file.size()
        place, length, count = self.directory()
        self.members = dict(self.entries(self.file.read_at(length, place), count))

    def directory(self) -> tuple[int, int, int]:
        """Place, length and number of entries of the central directory."""
        low = max(0, self.size - 22 - 0xFFFF)
        tail = self.file.read_at(self.size - low, low)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end of a central directory")
        count, length, place = struct.unpack_from("<HII", tail, at + 10)
        if 0xFFFF == count or 0xFFFFFFFF in (length, place):
            locator = self.file.read_at(20, low + at - 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("the ZIP64 locator is missing")
            (end64,) = struct.unpack_from("<Q", locator, 8)
            record64 = self.file.read_at(56, end64)
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 record is missing")
            count, length, place = struct.unpack_from("<QQQ", record64, 32)
        return place, length, count

    @staticmethod
    def entries(data: bytes, count: int) -> Iterator[tuple[str, tuple[int, int, int]]]:
        """Name and (method, stored size, place of the local header) of each member."""
        at = 0
        for _ in range(count):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, stored, full, n, extra, note = struct.unpack_from("<10xH8xIIHHH", data, at)
            (place,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n].decode()
            field, end = at + 46 + n, at + 46 + n + extra
            while field + 4 <= end:
                kind, size = struct.unpack_from("<HH", data, field)
                if kind == 1:  # 64-bit values, only of those that did not fit, in this order
                    wide = iter(struct.unpack_from(f"<{size // 8}Q", data, field + 4))
                    full = next(wide) if full == 0xFFFFFFFF else full
                    stored = next(wide) if stored == 0xFFFFFFFF else stored
                    place = next(wide) if place == 0xFFFFFFFF else place
                field += 4 + size
            yield name, (method, stored, place)
            at = end + note

    def locate(self, name: str) -> tuple[int, int]:
        """Place and size of the data of a stored member."""
        method, size, place = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed as a whole")
        head = self.file.read_at(30, place)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("no member at this place")
        n, extra = struct.unpack_from("<HH", head, 26)
        return place + 30 + n + extra, size

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        place, size = self.locate(name)
        return self.file.read_at(size - offset if length is None else length, place + offset)

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """Every record of the index, read in blocks of neighbours."""
        lines = self.read(INDEX_MEMBER).decode().splitlines()
        index = [json.loads(line.partition(" ")[2]) for line in lines]
        places = {name: self.locate(name)[0] for name in {e["filename"] for e in index}}
        spans = sorted((places[e["filename"]] + e["offset"], e["length"]) for e in index)
        i = 0
        while i < len(spans):
            low, end, j = spans[i][0], sum(spans[i]), i + 1
            while j < len(spans) and spans[j][0] == end and end - low < BLOCK:
                end, j = sum(spans[j]), j + 1
            block = self.file.read_at(end - low, low)
            for start, length in spans[i:j]:
                yield parse_record(gzip.decompress(block[start - low : start - low + length]))
            i = j


def write_archives(
    pages: DataFrame,
    least_bytes: int = 0,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Write the archives below the shared folder and return their manifest, a row per archive.

    Equal payloads meet as digests only, counted before the shuffle; the join that brings the
    largest id back can be split by Spark where one payload has a large share of the pages.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "archives")
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
        F.sha1(body).alias("digest"),
    )
    kept = rows.groupBy("digest").agg(F.max("page_id").alias("keeper"))
    # Staged: a join straight after the sum would keep its layout, a hot payload in one task.
    joined = rows.join(stage(kept, "payloads"), "digest").select("page_id", "url", "html", "keeper")

    def run(batches):
        writer, path = None, None
        number = TaskContext.get().partitionId()
        for batch in batches:
            for part in pieces(batch, "html"):
                if writer is None:
                    path = attempt_path(folder, number, ".wacz")
                    writer = ArchiveWriter(path)
                columns = [part.column(i).to_pylist() for i in range(4)]
                for own, address, text, keeper in zip(*columns, strict=True):
                    payload = text.encode()
                    revisit = len(payload) >= least_bytes and own != keeper
                    writer.add(own, address, payload, keeper, revisit)
        if writer is not None:
            values = [[number], [path], [writer.close()]]
            kinds = [pa.int32(), pa.string(), pa.int64()]
            arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "path", "n_records"])

    return stage(joined.mapInArrow(run, MANIFEST), "archive-manifest")


RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
    ]
)


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of all archives. Digest and length of a response are those of the bytes read;
    a revisit carries those of its response, and no payload."""
    fields = [f for f in RECORDS if with_payload or f.name != "payload"]
    schema = T.StructType(fields)
    kinds = {"page_id": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64()}
    kinds["refers_to"] = pa.int64()

    def rows(path):
        for headers, payload in ArchiveReader(path).records():
            revisit = headers["warc-type"] == "revisit"
            digest = base32_sha1(payload)
            if revisit:
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
            yield {
                "page_id": page_of(headers["warc-record-id"]),
                "url": headers.get("warc-target-uri"),
                "payload": None if revisit else payload,
                "payload_bytes": int(headers["warc-x-payload-length"]) if revisit else len(payload),
                "payload_digest": digest,
                "record_type": headers["warc-type"],
                "refers_to": page_of(headers.get("warc-refers-to")),
            }

    def packed(found):
        arrays = [pa.array([r[f.name] for r in found], kinds.get(f.name, pa.string())) for f in fields]
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    def run(batches):
        for batch in batches:
            for path in batch.column(batch.schema.names.index("path")).to_pylist():
                found, held = [], 0
                for r in rows(path):
                    found.append(r)
                    held += 200 + r["payload_bytes"]
                    if held > BLOCK:
                        yield packed(found)
                        found, held = [], 0
                if found:
                    yield packed(found)

    return manifest.repartition(max(1, manifest.count()), "part").mapInArrow(run, schema)


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages),
d AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((CAST('0x' || substr(h, (k // 4) * 5 + 1, 5) AS INT) >> (15 - 5 * (k % 4))) & 31) + 1), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM p JOIN d USING (h)"""
