"""WARC archives compressed record by record with a dictionary built from their own records.

An archive is a ``.warc.zst`` file: a leading skippable frame (magic 0x184D2A5D) holds a Zstandard
dictionary built from a spread of the archive's records, and every record follows as a frame of
its own, so any record can be read alone. Records whose payload was archived before are revisits:
of equal payloads of at least ``min_revisit_bytes`` bytes the smallest ``page_id`` is the response.

Which page is first is found on ids and digests alone (minima are combined before the shuffle); the
html is dealt once, by id and digest, so a payload that a third of the pages share has no hot key.
A task holds one archive's records at a time (``ARCHIVE_BYTES``). Files have a name of their own
for each attempt and only those in the written manifest are read, so a lost task leaves at most an
unread file behind.

Edge cases: a null html is an empty payload; a null url has no target header, and control characters
in one are percent-encoded; rows with a null ``page_id`` are archived under ``null``, and are
responses only when no page with an id has their payload; rows that repeat a page id with the first
payload are all responses; very long payloads make an archive of their own; too few or too small
records for a dictionary leave the leading frame out; an empty table writes no archive and reads
back empty; extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common as C

#: Uncompressed bytes of records in one archive.
ARCHIVE_BYTES = 16 << 20
DICT_BYTES = 64 << 10
#: Sample bytes for the dictionary, as a multiple of its size.
SAMPLE_TIMES = 50
LEVEL = 6
#: Fixed values of the WARC and Zstandard formats.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time of capture, so all records have this date.
DATE = "1970-01-01T00:00:00Z"

_ID = "urn:page:"
MANIFEST = "path string, n_records long, raw_bytes long, file_bytes long, dict_bytes long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "payload binary")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(s: str) -> str:
    return "".join(f"%{b:02X}" if b < 0x21 or b == 0x7F else chr(b) for b in s.encode("utf-8", "surrogatepass")) \
        .encode("latin-1").decode("utf-8", "surrogatepass")


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the headers of the response and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda i: f"<{_ID}{'null' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}")
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from records spread evenly over the archive; empty when they are too few or too small."""
    total = sum(map(len, records))
    size = min(DICT_BYTES, total // 10)
    step = max(1, -(-total // (size * SAMPLE_TIMES))) if size else 1
    try:
        return zstandard.train_dictionary(size, records[::step], k=256, d=8).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:
        return b""


def archive_bytes(records: list[bytes]) -> tuple[bytes, int]:
    """The file of one archive and the size of its dictionary."""
    raw = build_dictionary(records)
    out = [SKIPPABLE.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw] if raw else []
    z = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    out += [z.compress(r) for r in records]
    return b"".join(out), len(raw)


def read_records(data: bytes):
    """The records of an archive, one frame at a time."""
    at, extra = 0, None
    if int.from_bytes(data[:4], "little") == SKIPPABLE:
        at = 8 + int.from_bytes(data[4:8], "little")
        extra = zstandard.ZstdCompressionDict(data[8:at])
    z = zstandard.ZstdDecompressor(dict_data=extra) if extra else zstandard.ZstdDecompressor()
    while at < len(data):
        d, out = z.decompressobj(), []
        while not d.eof and at < len(data):
            part = data[at:at + 32768]
            out.append(d.decompress(part))
            at += len(part)
        at -= len(d.unused_data)
        yield b"".join(out)


def parse(rec: bytes) -> dict:
    """The fields of a record; digest and length of a response are taken from its payload, and checked."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda s: None if s is None or s.endswith(":null>") else int(s[len(_ID) + 1:-1])
    revisit = h["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != told or sha1_base32(payload) != digest):
        raise ValueError(f"record {h['WARC-Record-ID']} does not hold its payload")
    return {"page_id": number(h["WARC-Record-ID"]), "url": h.get("WARC-Target-URI"), "payload_bytes": told, "payload_digest": digest,
            "record_type": h["WARC-Type"], "refers_to": number(h.get("WARC-Refers-To")), "payload": None if revisit else payload}


def _place(uri: str):
    """File system and path of a folder or file; a plain or file: path is local."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def _write(folder: str):
    def run(batches):
        fs, base = _place(folder)
        made = False
        held: list[bytes] = []
        size = 0

        def flush():
            nonlocal made, held, size
            if not made:
                fs.create_dir(base, recursive=True)
                made = True
            data, d = archive_bytes(held)
            name = f"{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(data)
            row = (f"{folder}/{name}", len(held), size, len(data), d)
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["path", "n_records", "raw_bytes", "file_bytes", "dict_bytes"])

        for rb in batches:
            cols = [rb.column(i) for i in range(5)]
            for i in range(rb.num_rows):
                page, url, html, revisit, to = (c[i].as_py() for c in cols)
                held.append(record(page, url, (html or "").encode("utf-8", "surrogatepass"), revisit, to))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()
    return run


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Archive page_id, url, html of all pages in folder; returns the manifest, already written beside it."""
    spark = pages.sparkSession
    C.ship_package(spark)
    text = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        F.sha1(text.cast("binary")).alias("sha"), F.octet_length(text).alias("n"))
    small = rows.select("page_id", "sha", "n")
    first = small.where(F.col("n") >= min_revisit_bytes).groupBy("sha").agg(F.min("page_id").alias("first"))
    later = small.join(first, "sha").where("first is not null and not (page_id <=> first)").select(F.col("page_id").alias("p"), F.col("sha").alias("s"), "first").distinct()
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s"))
    deal = rows.join(later, same, "left").select("page_id", "url", "html", F.col("first").isNotNull().alias("revisit"), F.col("first").alias("to"))
    out, _ = C.written(deal.mapInArrow(_write(folder), MANIFEST), "warc-manifest")
    return out


def _read(keep_payload: bool):
    def run(batches):
        for rb in batches:
            for p in rb.column(0):
                fs, path = _place(p.as_py())
                with fs.open_input_stream(path, compression=None) as f:
                    data = f.read()
                rows, size = [], 0
                for r in read_records(data):
                    x = parse(r)
                    size += len(r)
                    rows.append(x if keep_payload else x | {"payload": None})
                    if size >= ARCHIVE_BYTES // 4:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_RECORD)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_RECORD)
    return run


_ARROW_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of all archives of a manifest; payload is null for revisits (and if not kept)."""
    C.ship_package(manifest.sparkSession)
    spark = manifest.sparkSession
    # A file is one row here: deal them evenly, or the few manifest files would be few tasks.
    return manifest.select("path").repartition(max(1, spark.sparkContext.defaultParallelism * 4)).mapInArrow(_read(keep_payload), RECORD)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(C.table(spark, sf_dir, "pages").select("page_id", "url", "html"), C.scratch_path(spark, "warc"))
    return read_archives(manifest, keep_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER), 1)), '') AS payload_digest
  FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM d GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""
