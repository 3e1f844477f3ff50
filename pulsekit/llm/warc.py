"""WARC archives with a dictionary (operator 3).

Each record is a Zstandard frame of its own, compressed with a dictionary that
was built from the records of the same file and stands, itself compressed, in
a skippable frame at the file's start: a reader that knows a record's place
can read it alone with the file's first frame.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more, the one with the
smallest page id is a response; the others are revisits that name it and carry
no payload. Smaller payloads are always responses.

A task buffers records up to ``SAMPLE`` bytes to build the dictionary, then
streams. It starts a new file after ``FILE`` bytes. A task that is run again
writes other files; only those named in the manifest, which Spark writes when
the tasks have ended, are ever read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import filesystem, need, save, shared_folder

MIN_REVISIT = 100
SAMPLE, DICT, FILE, LEVEL = 8 << 20, 64 << 10, 256 << 20, 6
DICT_MAGIC, FRAME_MAGIC = b"\x5d\x2a\x4d\x18", b"\x28\xb5\x2f\xfd"  # skippable frame 0x184D2A5D; a Zstandard frame
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of URLs, RFC 4122


def record_id(page_id: int | None) -> str:
    """Follows from the page id, so a revisit names its response without a look-up."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def _clean(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def make_record(row: dict) -> bytes:
    """One WARC/1.1 record of a row of :func:`plan_records`."""
    payload = row["html"] or b""
    head = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id(row["page_id"])),
        ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(row["url"])),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"), ("X-Payload-Length", str(row["payload_bytes"])),
        ("X-Page-ID", "" if row["page_id"] is None else str(row["page_id"])),
    ]
    if row["record_type"] == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(row["refers_to"])), ("WARC-Refers-To-Target-URI", _clean(row["refers_url"])),
                 ("X-Refers-To-Page-ID", str(row["refers_to"]))]
        block = _HTTP % 0
    else:
        block = _HTTP % len(payload) + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode("utf-8") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return {"headers": headers, "payload": block.partition(b"\r\n\r\n")[2]}


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary; few or uniform records are themselves the (raw) dictionary."""
    try:
        return zstandard.train_dictionary(DICT, records, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICT] or b"\0" * 8


def open_dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    trained = data[:4] == b"\x37\xa4\x30\xec"
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes one file: the dictionary frame, then a frame a record."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/pages-{uuid.uuid4().hex}.warc.zst"
        self.fs, self.path = filesystem(self.uri)
        self.sample, self.sampled, self.size, self.n, self.raw, self.out = [], 0, 0, 0, 0, None

    def _open(self) -> None:
        data = build_dictionary(self.sample)
        frame = zstandard.ZstdCompressor(level=LEVEL).compress(data)
        self.out = self.fs.open_output_stream(self.path, compression=None)  # frames are as written
        self._put(DICT_MAGIC + len(frame).to_bytes(4, "little") + frame)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=open_dictionary(data), write_checksum=True, write_content_size=True)
        for r in self.sample:
            self._put(self.zstd.compress(r))
        self.sample = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self.n += 1
        self.raw += len(record)
        if self.out is None:
            self.sample.append(record)
            self.sampled += len(record)
            if self.sampled >= SAMPLE:
                self._open()
        else:
            self._put(self.zstd.compress(record))

    def close(self) -> tuple[str, int, int, int]:
        if self.out is None:
            self._open()
        self.out.close()
        return self.uri, self.n, self.size, self.raw


def read_records(uri: str) -> Iterator[dict]:
    """The records of a file in order, one in memory at a time."""
    fs, path = filesystem(uri)
    with fs.open_input_stream(path, compression=None) as f:
        head = f.read(8)
        if head[:4] != DICT_MAGIC:
            raise ValueError(f"{uri} does not begin with a dictionary frame")
        data = f.read(int.from_bytes(head[4:8], "little"))
        zstd = zstandard.ZstdDecompressor(dict_data=open_dictionary(zstandard.ZstdDecompressor().decompress(data)))
        rest = b""
        while True:
            frame, parts = zstd.decompressobj(), []
            while not frame.eof:
                rest = rest or f.read(1 << 20)
                if not rest:
                    if parts:
                        raise ValueError(f"{uri} ends within a record")
                    return
                parts.append(frame.decompress(rest))
                rest = frame.unused_data if frame.eof else b""
            yield parse_record(b"".join(parts))


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if out is None:
                        filesystem(folder)[0].create_dir(filesystem(folder)[1])
                        out = ArchiveWriter(folder)
                    out.add(make_record(row))
                    if out.size >= FILE:
                        done.append(out.close())
                        out = None
        if out is not None:
            done.append(out.close())
        if done:
            uri, n, size, raw = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(uri), *(pa.array(c, pa.int64()) for c in (n, size, raw))],
                                             names=["path", "n_records", "n_bytes", "raw_bytes"])

    return run


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def packed(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"])

    for batch in batches:
        for uri in batch.column("path").to_pylist():
            rows, size = [], 0
            for r in read_records(uri):
                h, data = r["headers"], r["payload"]
                page, refers = h["x-page-id"], h.get("x-refers-to-page-id")
                digest, length = h["warc-payload-digest"].removeprefix("sha256:"), int(h["x-payload-length"])
                if h["warc-type"] == "response":  # what was read counts, not what the header says
                    got = hashlib.sha256(data).hexdigest()
                    if got != digest or len(data) != length:
                        raise ValueError(f"{uri}: the payload of page {page} does not match its digest")
                rows.append((int(page) if page else None, h["warc-target-uri"], h["warc-type"], int(refers) if refers else None, digest, length, data))
                size += len(data) + 300
                if size > 8 << 20:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)


def plan_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT
) -> DataFrame:
    """Rows with record type, referred page and payload (bytes) of every row of ``pages``."""
    src = need(pages, id_col, url_col, html_col).toDF("page_id", "url", "html")
    rows = src.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"),
    ).withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    first = (
        rows.filter((F.col("payload_bytes") >= min_revisit) & F.col("page_id").isNotNull())
        .groupBy("payload_digest").agg(F.min(F.struct("page_id", "url")).alias("f"), F.count("*").alias("n"))
        .filter("n > 1").select("payload_digest", F.col("f.page_id").alias("fid"), F.col("f.url").alias("furl"))
    )
    again = F.coalesce(F.col("page_id") != F.col("fid"), F.lit(False))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("fid")).alias("refers_to"), F.when(again, F.col("furl")).alias("refers_url"),
        F.when(~again, F.col("html")).alias("html"))


def write_archive(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT
) -> DataFrame:
    """Write one record a row; returns the manifest (path, n_records, n_bytes, raw_bytes), one row per file.

    A null payload is empty, a null url an empty header. Rows that share both
    payload and the smallest page id are all responses; a row with a null page
    id is a response to which nothing refers. An empty table writes no file.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    rows = plan_records(pages, id_col, url_col, html_col, min_revisit)
    return save(rows.mapInArrow(_writer(folder), "path string, n_records long, n_bytes long, raw_bytes long"), "warc-manifest")


def read_archive(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload.

    Digest and length are those of the full payload, checked against the
    payload of every response; a revisit's own payload is empty.
    """
    return manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(
        _reader, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS fid FROM p WHERE payload_bytes >= {MIN_REVISIT} GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.fid IS NOT NULL AND p.page_id <> f.fid THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.fid IS NOT NULL AND p.page_id <> f.fid THEN f.fid END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""
