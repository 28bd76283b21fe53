"""ZIP archives of WARC records: round trips, other readers, and brute force."""

import gzip
import hashlib
import io
import random
import zipfile

import pytest

from skytally.llm import warc_zip
from skytally.llm.warc_zip import ZipReader, ZipWriter


class Bytes:
    def __init__(self, data):
        self.data, self.read_bytes = data, 0

    def read_at(self, length, at):
        self.read_bytes += length
        return self.data[at : at + length]


@pytest.mark.parametrize("always64", [False, True])
def test_zip_round_trip(always64):
    out = io.BytesIO()
    writer = ZipWriter(out, always64=always64)
    members = {"a/é.bin": b"x" * 1000, "empty": b"", "b": bytes(range(256)) * 300}
    for name, data in members.items():
        writer.add(name, [data[:7], data[7:]])
    size = writer.close()
    raw = out.getvalue()
    assert size == len(raw)
    with zipfile.ZipFile(io.BytesIO(raw)) as library:
        assert library.testzip() is None and {n: library.read(n) for n in library.namelist()} == members
    reader = ZipReader(Bytes(raw), size)
    assert {n: reader.read_range(n, 0, m.size) for n, m in reader.members.items()} == members
    assert reader.read_range("b", 255, 3) == b"\xff\0\1"
    with pytest.raises(ValueError, match="ends before"):
        reader.read_range("b", 76_790, 11)


def test_archives_of_another_writer():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as library:
        library.writestr("stored", b"abc" * 100)
        library.writestr("packed", b"abc" * 100, zipfile.ZIP_DEFLATED)
        library.comment = b"note PK\5\6 note" + b"!" * 300
    raw = out.getvalue()
    reader = ZipReader(Bytes(raw), len(raw))
    assert reader.read_range("stored", 3, 6) == b"abcabc"
    with pytest.raises(ValueError, match="compressed"):
        reader.read_range("packed", 0, 1)


def test_more_members_than_the_old_format_counts():
    out = io.BytesIO()
    writer = ZipWriter(out)
    for i in range(66_000):
        writer.add(str(i), [b"%d" % i])
    size = writer.close()
    reader = ZipReader(Bytes(out.getvalue()), size)
    assert len(reader.members) == 66_000 and reader.read_range("65999", 0, 5) == b"65999"


@pytest.mark.parametrize("raw", [b"", b"PK\5\6", b"no archive at all" * 9])
def test_what_is_no_archive_is_an_error(raw):
    with pytest.raises(ValueError, match="no end record"):
        ZipReader(Bytes(raw), len(raw))


def test_only_ranges_are_read():
    out = io.BytesIO()
    writer = ZipWriter(out)
    for i in range(20):
        writer.add(f"m{i}", [b"z" * 1_000_000])
    size = writer.close()
    file = Bytes(out.getvalue())
    ZipReader(file, size).read_range("m7", 500, 100)
    assert file.read_bytes < 80_000


def test_records_round_trip():
    raw = warc_zip.warc_record({"WARC-Type": "response", "X": "a: b"}, b"block\r\n\r\nmore")
    assert warc_zip.parse_record(raw) == ({"warc-type": "response", "x": "a: b", "content-length": "13"}, b"block\r\n\r\nmore")


def brute(pages):
    first = {}
    for page_id, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0])):
        first.setdefault((html or "").encode(), page_id)
    out = []
    for page_id, _, html in pages:
        raw = (html or "").encode()
        again = len(raw) >= 100 and first[raw] != page_id
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None))
    return sorted(map(str, out))


def test_pages_equal_brute_force(spark):
    rng = random.Random(0)
    texts = ["".join(rng.choice("<p>é\r\n\r\n x") for _ in range(n)) for n in (0, 1, 99, 100, 120, 5000, 300_000)]
    pages = [(i, f"http://h/{i}\r\nx", rng.choice(texts)) for i in range(60)]
    pages += [(100, None, None), (101, "", ""), (None, "u", texts[5]), (102, "u", "b" * 100), (102, "u", "b" * 100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    df = df.selectExpr("*", *[f"'decoy' as `{c}`" for c in ("digest", "id", "payload", "first", "refers_to", "size")])
    rows = warc_zip.archive_and_read(df).collect()
    assert sorted(str(tuple(r)) for r in rows) == brute(pages)
    assert warc_zip.archive_and_read(df.limit(0)).collect() == []


def test_small_parts_and_payloads(spark, tmp_path):
    """Many WARC files and archives per task, ZIP64 throughout, runs of one record."""
    pages = [(i, f"http://h/{i}", f"<html>{i % 7}" + "y" * 200) for i in range(50)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    marked = warc_zip.mark_revisits(df, id_col="page_id", payload_col="html")
    written = warc_zip.write_archives(
        marked, str(tmp_path), id_col="page_id", url_col="url", payload_col="html", warc_bytes=600, archive_bytes=2000, always64=True
    )
    archives = written.collect()
    assert len(archives) > 3
    for row in archives:
        with zipfile.ZipFile(row.archive) as library:
            assert library.testzip() is None
    runs = warc_zip.read_index(written, str(tmp_path), run_bytes=1)
    rows = warc_zip.read_records(runs, str(tmp_path), with_payload=True).collect()
    assert len(rows) == 50
    for r in rows:
        text = pages[int(r.record_id)][2].encode()
        assert r.url == f"http://h/{r.record_id}" and r.payload_bytes == len(text)
        assert (r.payload is None) == (r.record_type == "revisit") and (r.payload is None or bytes(r.payload) == text)


def test_records_have_the_mandatory_fields(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 200), (2, None, "x" * 200), (3, "http://b/", None)], "page_id long, url string, html string")
    marked = warc_zip.mark_revisits(pages, id_col="page_id", payload_col="html")
    written = warc_zip.write_archives(marked, str(tmp_path), id_col="page_id", url_col="url", payload_col="html", date="2020-02-03T04:05:06Z")
    found = 0
    for row in written.collect():
        with zipfile.ZipFile(row.archive.removeprefix("file:")) as archive:
            for name in archive.namelist():
                if name.endswith(".warc.gz"):
                    data = gzip.decompress(archive.read(name))
                    found += data.count(b"WARC/1.1\r\n")
                    for field in (b"WARC-Type: ", b"WARC-Record-ID: <", b"WARC-Date: 2020-02-03T04:05:06Z\r\n", b"Content-Length: "):
                        assert data.count(b"\r\n" + field) >= data.count(b"WARC/1.1\r\n")
    assert found == 3
