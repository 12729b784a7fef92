"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole WARC records, followed by a skippable frame with the
seek table (compressed and plain size of every frame) and its footer.  The index maps each record to bundle, frame and offset
within the plain frame, so one record costs one seek and one frame.  Records with equal payloads are written once; the others
are `revisit` records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 20, 1 << 28, 3
# Fixed values of the seekable format: skippable frame with the table, and the last four bytes of a file.
TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x8F92EAB1
EPOCH = "1970-01-01T00:00:00Z"  # the tables have no capture time; a fixed one keeps reruns equal


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def one_line(value: str) -> str:
    return "".join(" " if c in "\r\n" else c for c in value)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or a revisit (no payload, but its length and digest) where `refers_to` is given."""
    name = "null" if page_id is None else str(page_id)
    body = b"" if refers_to is not None else payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {EPOCH}",
             f"WARC-Target-URI: {one_line(url or '')}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(plain: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and body of the record at an offset of a plain frame, and where the next one begins."""
    end = plain.index(b"\r\n\r\n", at)
    first, *lines = plain[at:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(headers["Content-Length"])
    body = plain[end + 4:end + 4 + size]
    if len(body) != size or plain[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut short")
    return headers, body, end + 8 + size


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", c, d) for c, d in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, FOOTER_MAGIC)
    return struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame of an open bundle."""
    file.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != FOOTER_MAGIC:
        raise ValueError("the bundle has no seek table")
    file.seek(size - 9 - 8 * frames)
    pairs = list(struct.iter_unpack("<II", file.read(8 * frames)))
    offsets = np.concatenate([[0], np.cumsum([c for c, _ in pairs], dtype=np.int64)])
    return [(int(o), c, d) for o, (c, d) in zip(offsets, pairs)]


def filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """Local, HDFS and object-store folders alike; executors and driver get the same files."""
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class BundleWriter:
    """Frames of one bundle; the file appears under its name only when it is closed."""

    def __init__(self, fs, folder: str):
        self.fs, self.folder, self.name = fs, folder, f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.out, self.sizes, self.plain, self.size, self.compress = None, [], io.BytesIO(), 0, zstandard.ZstdCompressor(level=LEVEL)

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset within it."""
        if self.plain.tell() and self.plain.tell() + len(data) > FRAME_BYTES:
            self.flush()
        place = (len(self.sizes), self.plain.tell())
        self.plain.write(data)
        return place

    def flush(self) -> None:
        if self.plain.tell():
            if self.out is None:
                self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}.part")
            plain = self.plain.getvalue()
            packed = self.compress.compress(plain)
            self.out.write(packed)
            self.sizes.append((len(packed), len(plain)))
            self.size += len(packed)
            self.plain = io.BytesIO()

    def close(self) -> None:
        self.flush()
        if self.out is not None:
            self.out.write(seek_table(self.sizes))
            self.out.close()
            self.fs.move(f"{self.folder}/{self.name}.part", f"{self.folder}/{self.name}")


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to: null for the response of each payload, its page_id for the others.

    Payloads are told apart by SHA-256 and length.  Only payloads that occur more than once meet the rows again, and those rows are
    joined without their html first; a payload that many pages share is a skewed join side without state, which Spark may split.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    narrow = rows.select("page_id", F.unhex(F.sha2(payload, 256)).alias("same"), F.length(payload).alias("size"))
    shared = narrow.groupBy("same", "size").agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1 AND owner IS NOT NULL").select("same", "size", "owner")
    revisits = narrow.join(shared, ["same", "size"]).where(~F.col("page_id").eqNullSafe(F.col("owner")))
    revisits = revisits.groupBy(F.col("page_id").alias("r_id"), F.col("same").alias("r_same")).agg(F.min("owner").alias("refers_to"))
    met = rows.withColumn("same", F.unhex(F.sha2(payload, 256))).join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("same") == F.col("r_same")), "left")
    return met.select("page_id", "url", "html", "refers_to")


_INDEX = "page_id BIGINT, bundle STRING, frame INT, position BIGINT"


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the records of all pages to bundles below `folder`, and their index to `folder`/index; returns the index as read from there.

    A task that is run again writes bundles of new names; only bundles that the index names belong to the archive.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        writer = BundleWriter(fs, root)
        for batch in filter(len, batches):
            rows = []
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                payload = (html or "").encode()
                if writer.size >= BUNDLE_BYTES:
                    writer.close()
                    writer = BundleWriter(fs, root)
                frame, position = writer.add(record(page_id, url, payload, digest32(payload), refers_to))
                rows.append((page_id, writer.name, frame, position))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int32(), pa.int64()))], ["page_id", "bundle", "frame", "position"])
        writer.close()

    with_roles(pages).mapInArrow(run, _INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(_INDEX).parquet(f"{folder}/index")


def _page(reference: str | None) -> int | None:
    name = reference.removeprefix("<urn:page:").removesuffix(">") if reference else "null"
    return None if name == "null" else int(name)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index names, read back frame by frame: page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload.

    The payload of a revisit is null; its digest and length are those of the full payload.  Digest and length of a response are computed
    from what was read and must be what its headers say.
    """
    frames = index.groupBy("bundle", "frame").agg(F.array_sort(F.collect_list(F.struct("position", "page_id"))).alias("records"))  # a frame holds about a MiB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        tables, unpack = {}, zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle, frame, records in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "records"))):
                path = f"{root}/{bundle}"
                with fs.open_input_file(path) as file:
                    if bundle not in tables:
                        tables[bundle] = read_seek_table(file, file.size())
                    offset, packed, plain = tables[bundle][frame]
                    file.seek(offset)
                    data = unpack.decompress(file.read(packed), max_output_size=plain)
                rows = []
                for r in records:
                    headers, body, _ = parse(data, r["position"])
                    kind, digest, size = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
                    if _page(headers["WARC-Record-ID"]) != r["page_id"] or (kind == "response" and (digest32(body), len(body)) != (digest, size)):
                        raise ValueError(f"{bundle}, frame {frame}, {r['position']}: the record is not what the index or its headers say")
                    rows.append((r["page_id"], headers["WARC-Target-URI"], kind, digest, size, _page(headers.get("WARC-Refers-To")), body.decode() if kind == "response" else None))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"])

    schema = "page_id BIGINT, url STRING, record_type STRING, payload_digest STRING, payload_bytes BIGINT, refers_to BIGINT, payload STRING"
    return frames.mapInArrow(run, schema)


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages and reads them back: the columns of `read_records`, one row per input row.

    Reads page_id, url, html; other columns are not read.  A null html is an empty payload, and empty payloads are equal too.  Of equal
    payloads the row with the smallest page_id is the response; rows that tie for it are all responses.  A null page_id counts as
    larger than any; a payload that only such rows have is a response in each.  An empty table writes an empty index and gives an empty result.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_records(write_bundles(pages, folder), folder)
