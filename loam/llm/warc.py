"""WARC archives, index first (operator 8).

Writing: each task streams its rows into archive files of gzip members, one
record each, and its output is the index: archive, offset, length, URL,
payload digest and record type per record.  Files carry the writing attempt's
own random name, so a retried or lost task leaves at most files that no index
row names.  The index is a written table and the only way to the records.

Reading: selected index rows are dealt by (archive, region), sorted by offset,
and neighbouring ranges are read in one request.

Of records with equal payloads (of ``least_bytes`` or more) the one with the
smallest page id is the response; the others are revisit records that refer to
it and hold no payload.  Only digests met twice or more are joined back.

Archives go through ``pyarrow.fs`` by the folder's URI, so any store that
pyarrow reaches will do.  Defined results: a null payload is empty; a null page id
is never the smallest unless all ids of the payload are null (then all its
records are responses); rows with equal page id and payload are responses all;
a null URL has no target header; an empty table writes nothing.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import stored, utf8

FILE_BYTES = 256 << 20
GAP = 64 << 10
SPAN = 8 << 20
REGION = 32 << 20
INDEX = ("page_id long, url string, payload_digest string, payload_bytes long, record_type string, "
         "archive string, offset long, length long")
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, sha1: str, refers_to) -> bytes:
    """One WARC record: headers, blank line, block, two blank lines."""
    revisit = refers_to is not None
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Payload-Digest", f"sha1:{sha1}"), ("X-Payload-Length", str(len(payload)))]
    if url is not None:
        clean = "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)
        head.append(("WARC-Target-URI", clean))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        block = http
    else:
        block = http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields and payload of one record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    head = dict(x.split(": ", 1) for x in top.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(head["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    number = lambda k: int(x) if (x := head[k][10:-1]) else None
    revisit = head["WARC-Type"] == "revisit"
    sha1 = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and digest(payload) != sha1:
        raise ValueError(f"record {head['WARC-Record-ID']}: payload does not match its digest")
    return {"page_id": number("WARC-Record-ID"), "payload_bytes": int(head["X-Payload-Length"]), "payload_digest": sha1,
            "record_type": head["WARC-Type"], "refers_to": number("WARC-Refers-To") if revisit else None,
            "payload": None if revisit else payload}


def write(df: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          least_bytes: int = 0) -> DataFrame:
    """Write the rows of ``df`` into archives under ``folder`` (a URI) and
    return the written index."""
    src = df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                    F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    src = src.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    twice = stored(src.where(F.octet_length("html") >= least_bytes).groupBy("sha")
                   .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
                   .select(F.col("sha").alias("sha2"), "first"), "copies")
    rows = src.join(twice, F.col("sha") == F.col("sha2"), "left").select(
        "page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, at, name = None, 0, None
        for b in batches:
            index = []
            for page, link, text, first in zip(*(c.to_pylist() for c in b.columns)):
                payload = utf8(text)
                sha1 = digest(payload)
                gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = gz.compress(record(page, link, payload, sha1, first)) + gz.flush()
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, at = fs.open_output_stream(f"{base}/{name}", compression=None), 0
                out.write(data)
                index.append((page, link, sha1, len(payload), "response" if first is None else "revisit", name, at, len(data)))
                at += len(data)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            if index:
                cols = list(zip(*index))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=[x.split()[0] for x in INDEX.split(", ")])
        if out is not None:
            out.close()

    return stored(rows.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names: ``RECORDS`` (null payload for
    revisits, and for all if ``payloads`` is false)."""
    # by bytes to read, not by the size of the index rows; a number keeps Spark from merging the partitions
    regions = int((index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) // (REGION // 4)) + 1
    picked = (index.select("archive", "offset", "length", F.floor(F.col("offset") / REGION).alias("region"))
                   .repartition(regions, "archive", "region").sortWithinPartitions("archive", "offset"))
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        handle, held = None, None

        def spans(rows):
            """Neighbouring ranges of one archive as (first, end, members)."""
            cur = None
            for archive, offset, length, _ in rows:
                if cur and cur[0] == archive and 0 <= offset - cur[2] <= GAP and offset + length - cur[1] <= SPAN:
                    cur[3].append((offset, length))
                    cur[2] = max(cur[2], offset + length)
                else:
                    if cur:
                        yield cur
                    cur = [archive, offset, offset + length, [(offset, length)]]
            if cur:
                yield cur

        for b in batches:
            for archive, first, end, members in spans(zip(*(c.to_pylist() for c in b.columns))):
                if held != archive:
                    if handle:
                        handle.close()
                    handle, held = fs.open_input_file(f"{base}/{archive}"), archive
                data = handle.read_at(end - first, first)
                got = [parse(zlib.decompress(data[o - first:o - first + n], 31)) for o, n in members]
                if not payloads:
                    got = [x | {"payload": None} for x in got]
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in got], k) for n, k in zip(names, kinds)], names=names)
        if handle:
            handle.close()

    return picked.mapInArrow(run, RECORDS)
