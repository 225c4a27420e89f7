"""Archives written, read back and compared; directories in both widths."""

import gzip
import struct
import zipfile

import pytest

from dockpulse.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, keeper long"


def expected(rows, least=0):
    keeper = {}
    for key, _, html in rows:
        if key is not None:
            keeper[html or ""] = max(key, keeper.get(html or "", key))
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        best = keeper.get(html or "")
        again = len(body) >= least and key != best
        out.append(
            (key, len(body), warc.base32_sha1(body), "revisit" if again else "response", best if again else None)
        )
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/x", "<p>one</p>"), (2, "http://a/y", "<p>one</p>"), (7, None, "<p>one</p>"),
    (3, "http://b/ü \r\nX: y", "två\r\n\r\nlines"), (4, "http://c", None), (5, "http://c", ""),
    (None, "http://d", "<p>one</p>"), (None, None, "alone"), (None, None, "alone"),
    (8, "http://e", "z" * 200_000), (7, None, "<p>one</p>"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    df = spark.createDataFrame([(*r, "d", 1) for r in ROWS], SCHEMA).repartition(3)
    manifest = warc.write_archives(df, least_bytes=least)
    assert sum(r["n_records"] for r in manifest.collect()) == len(ROWS)
    found = warc.read_archives(manifest).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in found), key=str) == expected(ROWS, least)
    bodies = {r["page_id"]: r for r in found if r["record_type"] == "response"}
    assert bytes(bodies[3]["payload"]).decode() == "två\r\n\r\nlines"
    assert bodies[3]["url"] == "http://b/%C3%BC%20%0D%0AX:%20y"


def test_empty_table(spark):
    manifest = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def write(path, n):
    writer = warc.ArchiveWriter(str(path))
    for i in range(n):
        writer.add(i, f"http://x/{i}", f"page {i} ".encode() * 50, None, False)
    assert writer.close() == n


def test_zip64_directory(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = tmp_path / "wide.wacz"
    write(path, 20)
    data = path.read_bytes()
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    end = data.rfind(b"PK\x05\x06")
    wide = data[: end + 8] + struct.pack("<HHII", 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF) + data[end + 20 :]
    path.write_bytes(wide)
    reader = warc.ArchiveReader(str(path))
    assert [warc.page_of(h["warc-record-id"]) for h, _ in reader.records()] == list(range(20))


def test_reader_agrees_with_the_library(tmp_path, monkeypatch):
    path = tmp_path / "plain.wacz"
    write(path, 30)
    monkeypatch.setattr(warc, "BLOCK", 300)
    reader = warc.ArchiveReader(str(path))
    with zipfile.ZipFile(path) as other:
        for info in other.infolist():
            assert reader.read(info.filename) == other.read(info.filename)
        whole = gzip.decompress(other.read(warc.WARC_MEMBER))
    assert whole.count(b"WARC/1.1\r\n") == 30
    assert [p for _, p in reader.records()] == [f"page {i} ".encode() * 50 for i in range(30)]


def test_comment_behind_the_directory(tmp_path):
    path = tmp_path / "note.wacz"
    write(path, 2)
    with zipfile.ZipFile(path, "a") as z:
        z.comment = b"a note PK"
    assert len(list(warc.ArchiveReader(str(path)).records())) == 2


def test_compressed_members_are_refused(tmp_path):
    path = tmp_path / "deflated.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warc.INDEX_MEMBER, "x" * 100)
    with pytest.raises(ValueError):
        list(warc.ArchiveReader(str(path)).records())
    (tmp_path / "no.zip").write_bytes(b"nothing")
    with pytest.raises(ValueError):
        warc.ArchiveReader(str(tmp_path / "no.zip"))
