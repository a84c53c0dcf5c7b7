"""WARC archives with an index written first, and reads of selected records by merged byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import shared_folder, staged, text_of

#: Bytes after which a task starts another archive; bytes of a merged read, and of a gap that is read over.
ARCHIVE_BYTES, READ_BYTES, GAP_BYTES = 256 << 20, 8 << 20, 64 << 10

#: Bytes of archives that a reading task takes, about.
TASK_BYTES = 128 << 20

INDEX = ("archive string, offset bigint, length bigint, url string, digest string, payload_bytes bigint, record_type string, "
         "page_id bigint, refers_to bigint")


def _open(path: str):
    """File system and path for a URI, on any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _digest(hex_sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_sha1)).decode()


def _uri(url) -> str:
    """The URL on one line, as headers are lines."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def record(page_id, url, payload: bytes, digest: str, refers_to, kind: str) -> bytes:
    """One record as a gzip member. A revisit has no block; it names the page it refers to."""
    block = payload if kind == "response" else b""
    name = "NULL" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Target-URI: {_uri(url)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 3, mtime=0)


def parse(member: bytes) -> dict:
    """Headers and block of a record; fails on a broken one."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    return fields | {"block": rest[:size]}


def write_archives(pages: DataFrame, folder: str, least: int = 0, page_id: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """Writes the archives below ``folder`` and returns their staged index.

    Of records with equal payloads of at least ``least`` bytes the one with the smallest id is a response and the others
    revisit it; NULL html is an empty payload. Rows that repeat both id and payload are all written alike. A record
    with a NULL id is a revisit if a page with an id has its payload, else a response.

    Every attempt of a task writes files of its own and hands their names to the index, so what a lost executor or a
    second attempt has left is never read.
    """
    p = pages.select(pages[page_id].cast("bigint").alias("page_id"), pages[url].cast("string").alias("url"),
                     text_of(pages, html).alias("html"))
    p = p.withColumn("sha1", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html").cast("bigint"))
    first = p.where(F.col("bytes") >= least).groupBy(F.col("sha1").alias("f_sha1")).agg(F.min("page_id").alias("first"))
    first = staged(first)  # a table again, so that a very common payload can be split in the join
    j = p.join(first, F.col("sha1") == F.col("f_sha1"), "left").select("page_id", "url", "html", "sha1", "first")

    def run(batches):
        import pyarrow as pa

        out, name, at = None, None, 0
        columns = [c.strip().split()[0] for c in INDEX.split(",")]
        kinds = [pa.string() if "string" in c else pa.int64() for c in INDEX.split(",")]
        for b in batches:
            rows = []
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):  # one payload at a time
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    system, path = _open(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                payload = r["html"].encode()
                again = r["first"] is not None and r["first"] != r["page_id"]
                kind, digest = "revisit" if again else "response", _digest(r["sha1"])
                refers_to = r["first"] if again else None
                member = record(r["page_id"], r["url"], payload, digest, refers_to, kind)
                out.write(member)
                rows.append((name, at, len(member), r["url"], digest, len(payload), kind, r["page_id"], refers_to))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], columns)
        if out is not None:
            out.close()

    return staged(j.mapInArrow(run, INDEX))


def read_records(index: DataFrame) -> DataFrame:
    """The selected records of an index, from their archives: page_id, url, payload (of responses), payload_bytes,
    digest, record_type, refers_to.

    Within a task, ranges of an archive are sorted by offset and neighbours are merged into one read. Every record is
    parsed, and a response's digest is worked out again; a broken archive fails the job.
    """
    places = index.select("archive", "offset", "length", (F.col("offset") / READ_BYTES).cast("bigint").alias("part"))
    # parted by the archives' bytes: the places alone are small, and would be read by one task
    held = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // TASK_BYTES))
    places = places.repartition(tasks, "archive", "part").sortWithinPartitions("archive", "offset")
    schema = ("page_id bigint, url string, payload binary, payload_bytes bigint, digest string, record_type string, "
              "refers_to bigint")

    def run(batches):
        import pyarrow as pa

        def ident(x):
            x = x and x.removeprefix("<urn:page:").removesuffix(">")
            return None if x in (None, "NULL") else int(x)

        def records(ranges, source):
            start, stop = ranges[0][0], max(o + n for o, n in ranges)
            data = source.read_at(stop - start, start)
            for o, n in ranges:
                f = parse(data[o - start:o - start + n])
                digest, kind = f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"]
                if kind == "response" and base64.b32encode(hashlib.sha1(f["block"]).digest()).decode() != digest:
                    raise ValueError("digest differs")
                yield (ident(f["WARC-Record-ID"]), f["WARC-Target-URI"], f["block"] if kind == "response" else None,
                       int(f["WARC-Payload-Length"]), digest, kind, ident(f.get("WARC-Refers-To")))

        def merged(rows):
            now, ranges = None, []
            for name, offset, length in rows:
                if ranges and (name != now or offset - sum(ranges[-1]) > GAP_BYTES or offset - ranges[0][0] > READ_BYTES):
                    yield now, ranges
                    ranges = []
                now = name
                ranges.append((offset, length))
            if ranges:
                yield now, ranges

        rows = ((r["archive"], r["offset"], r["length"]) for b in batches for r in b.to_pylist())
        names = ["page_id", "url", "payload", "payload_bytes", "digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        opened = source = None
        for name, ranges in merged(rows):
            if name != opened:
                if source is not None:
                    source.close()
                system, path = _open(name)
                opened, source = name, system.open_input_file(path)
            got = list(records(ranges, source))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*got), kinds)], names)
        if source is not None:
            source.close()

    return places.drop("part").mapInArrow(run, schema)


def archive_and_read(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes all pages and reads all records back."""
    return read_records(write_archives(pages, folder or f"{shared_folder(pages.sparkSession)}", **options))
