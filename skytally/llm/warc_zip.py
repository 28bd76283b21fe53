"""WARC records in ZIP archives, written and read without extraction.

An archive is a ZIP file with stored (uncompressed) members: WARC files, whose records are one gzip member each, and an
index per WARC file with a line per record (key, offset, length). The writer puts a ZIP64 end record and ZIP64 fields where
numbers need them, or always where asked to. The reader fetches only ranges: the end of the file, the central directory,
the local header of a member, its index, and then the records that are wanted, joined into runs of at most ``run_bytes``.

Archives are read and written through ``pyarrow.fs``, from any store it knows, or from a local path.

Null payloads are empty. Rows that repeat a key are records of their own; the index lists each. An empty table gives no
archive and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import checkpointed, in_slices, shared_folder

# Signatures and layouts of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
LOCAL_LAYOUT, CENTRAL_LAYOUT = "<4s5H3I2H", "<4s6H3I5H2I"
END_LAYOUT, END64_LAYOUT, LOCATOR_LAYOUT = "<4s4H2IH", "<4sQ2H2I4Q", "<4sIQI"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" in uri or uri.startswith("file:"):
        scheme, _, rest = uri.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


@dataclass(frozen=True)
class Member:
    name: str
    method: int  # 0: stored
    crc: int
    size: int
    header_at: int


class ZipWriter:
    """Writes stored members to a stream, one after the other."""

    def __init__(self, stream, *, always64: bool = False) -> None:
        self.stream, self.always64, self.at = stream, always64, 0
        self.members: list[Member] = []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _wide(self, number: int) -> bool:
        return self.always64 or number >= MAX32

    def add(self, name: str, parts: list[bytes]) -> None:
        crc = size = 0
        for part in parts:
            crc, size = zlib.crc32(part, crc), size + len(part)
        raw, wide, start = name.encode(), self._wide(size), self.at
        extra = struct.pack("<2H2Q", 1, 16, size, size) if wide else b""
        shown = MAX32 if wide else size
        self._put(struct.pack(LOCAL_LAYOUT, LOCAL, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, shown, shown, len(raw), len(extra)))
        self._put(raw + extra)
        for part in parts:
            self._put(part)
        self.members.append(Member(name, 0, crc, size, start))

    def close(self) -> int:
        """Writes the directory; returns the size of the archive."""
        start = self.at
        for m in self.members:
            raw, wide = m.name.encode(), self._wide(m.size) or self._wide(m.header_at)
            extra = struct.pack("<2H3Q", 1, 24, m.size, m.size, m.header_at) if wide else b""
            size, at = (MAX32, MAX32) if wide else (m.size, m.header_at)
            self._put(
                struct.pack(CENTRAL_LAYOUT, CENTRAL, 45, 45 if wide else 20, 0x800, 0, 0, 0x21, m.crc, size, size, len(raw),
                            len(extra), 0, 0, 0, 0, at)
                + raw + extra
            )
        length, n = self.at - start, len(self.members)
        if self.always64 or n >= MAX16 or start >= MAX32 or length >= MAX32:
            end64 = self.at
            self._put(struct.pack(END64_LAYOUT, END64, 44, 45, 45, 0, 0, n, n, length, start))
            self._put(struct.pack(LOCATOR_LAYOUT, LOCATOR64, 0, end64, 1))
            n, length, start = MAX16, MAX32, MAX32
        self._put(struct.pack(END_LAYOUT, END, 0, 0, n, n, length, start, 0))
        return self.at


class ZipReader:
    """Reads the directory of an archive, and ranges of its stored members."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size = file, size
        self.members = {m.name: m for m in self._directory()}
        self._data_at: dict[str, int] = {}

    def read(self, at: int, length: int) -> bytes:
        data = self.file.read_at(length, at)
        if len(data) != length:
            raise ValueError(f"the archive ends before byte {at + length}")
        return bytes(data)

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - MAX16)
        tail = self.read(tail_at, self.size - tail_at)
        found = tail.rfind(END)
        # A comment may hold the signature: the record that its own comment length carries to the end of the file counts.
        while found >= 0 and found + 22 + int.from_bytes(tail[found + 20 : found + 22], "little") != len(tail):
            found = tail.rfind(END, 0, found)
        if found < 0:
            raise ValueError("no end record: not a ZIP archive")
        _, _, _, _, n, length, start, _ = struct.unpack_from(END_LAYOUT, tail, found)
        end_at = tail_at + found
        if MAX16 == n or MAX32 in (length, start):
            locator = self.read(end_at - 20, 20) if end_at >= 20 else b""
            if locator[:4] == LOCATOR64:
                _, _, end64_at, _ = struct.unpack(LOCATOR_LAYOUT, locator)
                record = struct.unpack(END64_LAYOUT, self.read(end64_at, struct.calcsize(END64_LAYOUT)))
                if record[0] != END64:
                    raise ValueError("the ZIP64 end record is not where its locator says")
                n, length, start = record[7], record[8], record[9]
        directory, at = self.read(start, length), 0
        for _ in range(n):
            (sign, _, _, _, method, _, _, crc, packed, size, names, extras, comments, _, _, _, header) = struct.unpack_from(
                CENTRAL_LAYOUT, directory, at
            )
            if sign != CENTRAL:
                raise ValueError("a directory entry is not where it should be")
            at += 46
            name = directory[at : at + names].decode()
            extra = directory[at + names : at + names + extras]
            at += names + extras + comments
            # The ZIP64 field holds, in this order, the numbers that did not fit.
            wide = iter(_extra64(extra))
            size = next(wide) if size == MAX32 else size
            packed = next(wide) if packed == MAX32 else packed
            header = next(wide) if header == MAX32 else header
            yield Member(name, method, crc, size, header)

    def data_at(self, name: str) -> int:
        """Where a member's bytes start: its local header has lengths of its own."""
        if name not in self._data_at:
            m = self.members[name]
            if m.method:
                raise ValueError(f"{name} is compressed, so its ranges cannot be read")
            header = struct.unpack(LOCAL_LAYOUT, self.read(m.header_at, 30))
            if header[0] != LOCAL:
                raise ValueError(f"{name} has no local header")
            self._data_at[name] = m.header_at + 30 + header[9] + header[10]
        return self._data_at[name]

    def read_range(self, name: str, offset: int, length: int) -> bytes:
        if offset + length > self.members[name].size:
            raise ValueError(f"{name} ends before byte {offset + length}")
        return self.read(self.data_at(name) + offset, length)


def _extra64(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
        at += 4 + length
    return []


def warc_record(headers: dict[str, str], block: bytes, *, level: int = 1) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a gzipped record."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def _http(payload_length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_length}\r\n\r\n".encode()


def mark_revisits(pages: DataFrame, *, id_col: str, payload_col: str, least_bytes: int = 100) -> DataFrame:
    """``pages`` with ``digest`` (SHA-256 of the payload) and ``refers_to``: of equal payloads of at least ``least_bytes``
    bytes, the least id is the response (null), and others refer to it. Of rows that repeat that id, all are responses.
    A null id is greater than any other."""
    raw = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    marked = pages.withColumn("digest", F.sha2(raw, 256)).withColumn("payload_bytes", F.length(raw).cast("long"))
    # Only digests and ids are grouped: one row per task for payloads that many pages share.
    firsts = marked.filter(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(
        F.min(id_col).alias("first"), F.count("*").alias("rows_")
    )
    firsts = checkpointed(firsts.filter("rows_ > 1").select("digest", "first"))
    joined = marked.join(firsts, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("first")


def write_archives(
    records: DataFrame,
    folder: str,
    *,
    id_col: str,
    url_col: str,
    payload_col: str,
    warc_bytes: int = 64 << 20,
    archive_bytes: int = 1 << 30,
    always64: bool = False,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes the rows of ``mark_revisits`` into archives below ``folder``; returns a row per archive: ``archive`` and
    ``size``. Archives of lost or repeated tasks are never listed: each attempt writes under a name of its own, and the
    rows are checkpointed. A task holds one WARC file of about ``warc_bytes``. Every record has the ``date``; it is fixed unless
    given, so that equal rows give equal records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        context = TaskContext.get()
        stamp = f"{context.partitionId():06d}-{uuid.uuid4().hex}"
        done, stream, writer = [], None, None
        parts: list[bytes] = []
        index: list[str] = []
        offset = n = 0

        def close_warc() -> None:
            nonlocal parts, index, offset, n
            if parts:
                writer.add(f"archive/data-{n:04d}.warc.gz", parts)
                writer.add(f"indexes/data-{n:04d}.idx", ["".join(index).encode()])
                parts, index, offset, n = [], [], 0, n + 1

        def close_archive() -> None:
            nonlocal stream, writer
            if stream:
                close_warc()
                size = writer.close()
                stream.close()
                done.append((path, size))
                stream = writer = None

        for batch in in_slices(batches, 256):
            for row in batch.to_pylist():
                if stream is None:
                    path = f"{base}/part-{stamp}-{len(done):04d}.wacz"
                    store.create_dir(base, recursive=True)
                    stream = store.open_output_stream(path)
                    writer = ZipWriter(stream, always64=always64)
                payload = (row["payload"] or "").encode()
                headers = {
                    "WARC-Type": "response" if row["refers_to"] is None else "revisit",
                    "WARC-Record-ID": f"<urn:page:{row['id']}>",
                    "WARC-Date": date,
                    "WARC-Target-URI": (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A"),
                    "WARC-Payload-Digest": f"sha256:{row['digest']}",
                    "Content-Type": "application/http;msgtype=response",
                }
                block = _http(len(payload))
                if row["refers_to"] is None:
                    block += payload
                else:
                    headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    headers["WARC-Refers-To"] = f"<urn:page:{row['refers_to']}>"
                raw = warc_record(headers, block)
                index.append(f"{row['id']} {offset} {len(raw)}\n")
                parts.append(raw)
                offset += len(raw)
                if offset >= warc_bytes:
                    close_warc()
                if writer.at >= archive_bytes:
                    close_archive()
        close_archive()
        if done:
            paths, sizes = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(sizes, pa.int64())], ["archive", "size"])

    chosen = records.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"), "digest", "refers_to"
    )
    return checkpointed(chosen.mapInArrow(run, "archive string, size long"))


def read_index(archives: DataFrame, folder: str, *, run_bytes: int = 4 << 20) -> DataFrame:
    """From each archive's directory and indexes, the runs of adjacent records to fetch: ``archive``, ``size``, ``member``,
    ``offset`` and ``lengths`` of the records. No record is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["archive"]) as file:
                    reader = ZipReader(file, row["size"])
                    for name in [m for m in reader.members if m.startswith("indexes/")]:
                        member = name.replace("indexes/", "archive/").removesuffix(".idx") + ".warc.gz"
                        lines = reader.read_range(name, 0, reader.members[name].size).decode().splitlines()
                        runs: list[dict] = []
                        for line in lines:
                            _, offset, length = line.split(" ")
                            last = runs[-1] if runs else None
                            if last and last["end"] == int(offset) and last["end"] - last["offset"] < run_bytes:
                                last["lengths"].append(int(length))
                                last["end"] += int(length)
                            else:
                                runs.append({"offset": int(offset), "end": int(offset) + int(length), "lengths": [int(length)]})
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["archive"]] * len(runs)),
                                pa.array([row["size"]] * len(runs), pa.int64()),
                                pa.array([member] * len(runs)),
                                pa.array([r["offset"] for r in runs], pa.int64()),
                                pa.array([r["lengths"] for r in runs], pa.list_(pa.int64())),
                            ],
                            ["archive", "size", "member", "offset", "lengths"],
                        )

    return archives.mapInArrow(run, "archive string, size long, member string, offset long, lengths array<bigint>")


RECORD = "record_id string, record_type string, url string, payload_digest string, payload_bytes long, refers_to string"


def read_records(runs: DataFrame, folder: str, *, with_payload: bool = False) -> DataFrame:
    """The records of the runs of ``read_index``: id, type, address, digest and length of the payload, and the id that a
    revisit refers to; ``with_payload`` adds the bytes (null for revisits). The payload of a response is checked against
    its digest."""
    names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * with_payload

    def read(row: dict, reader: ZipReader) -> Iterator[tuple]:
        data = reader.read_range(row["member"], row["offset"], sum(row["lengths"]))
        at = 0
        for length in row["lengths"]:
            headers, block = parse_record(data[at : at + length])
            at += length
            head, _, payload = block.partition(b"\r\n\r\n")
            stated = headers["warc-payload-digest"].removeprefix("sha256:")
            size = int(next(line for line in head.decode().split("\r\n") if line.startswith("Content-Length: "))[16:])
            if headers["warc-type"] == "response":
                if len(payload) != size or hashlib.sha256(payload).hexdigest() != stated:
                    raise ValueError(f"the payload of {headers['warc-record-id']} is not what its record says")
            refers = headers.get("warc-refers-to")
            yield (
                headers["warc-record-id"][len("<urn:page:") : -1],
                headers["warc-type"],
                headers["warc-target-uri"],
                stated,
                size,
                refers and refers[len("<urn:page:") : -1],
                payload if headers["warc-type"] == "response" else None,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        file, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if not file or opened != row["archive"]:
                    if file:
                        file.close()
                    opened = row["archive"]
                    file = store.open_input_file(opened)
                    reader = ZipReader(file, row["size"])
                found = list(zip(*read(row, reader), strict=True))
                types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(found[: len(names)], types, strict=False)]
                yield pa.RecordBatch.from_arrays(columns, names)
        if file:
            file.close()

    return runs.mapInArrow(run, RECORD + ", payload binary" * with_payload)


def archive_and_read(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes a record per row into archives below the shared folder, and reads all of them back. Runs of records are dealt
    out evenly before they are fetched, whatever archive they are in."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    marked = mark_revisits(pages.select(id_col, url_col, payload_col), id_col=id_col, payload_col=payload_col)
    written = write_archives(marked, folder, id_col=id_col, url_col=url_col, payload_col=payload_col)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = read_index(written, folder).repartition(tasks, "archive", "member", "offset")
    kind = pages.schema[id_col].dataType.simpleString()

    def as_id(c: str):
        return F.when(F.col(c) != "None", F.col(c)).cast(kind)

    return read_records(runs, folder).select(
        as_id("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", as_id("refers_to").alias("refers_to")
    )
