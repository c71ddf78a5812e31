"""WARC archives: writing, normalising monolithic gzip, reading back.

``write`` makes archives the way some crawlers do: one gzip stream around all
records of a file, which cannot be read from the middle.  ``normalise`` inflates
each such stream once, record by record, rewrites every record as a gzip member
of its own and writes a sidecar index (one JSON line per record: offset, length,
uri, type) beside it.  ``read`` seeks by that index.

Archives are real files in the shared folder, reached through pyarrow's file
systems by the folder's URI (on HDFS that needs libhdfs on the executors).  A
task writes under a name of its own attempt and hands the name on, so a repeated
task never meets another attempt's file; files of failed attempts are not listed
and never read.  Memory is bounded by the largest record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A new archive is begun beyond this many payload bytes.
ARCHIVE_BYTES = 64 << 20
#: Payloads shorter than this are never revisits.
MIN_REVISIT = 1000
#: Digests of repeated payloads are broadcast up to this many rows (64 bytes each).
BROADCAST_DIGESTS = 500_000
SALTS = 16
_READ = 1 << 20
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.I)


def file_system(uri: str):
    """(pyarrow file system, path in it) of a folder's URI or local path."""
    from pyarrow import fs
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


# ----------------------------------------------------------------- planning

def plan(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, payload, digest, refers_to) of every row: ``refers_to`` is set
    for revisits only.

    Of rows with equal payloads of MIN_REVISIT bytes or more, the one with the
    largest key is the response (a repeated row of that key too); the others,
    and rows without a key, revisit it.  Without any key all are responses."""
    payload = F.coalesce(pages[html].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages[key].alias("id"), pages[url].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= MIN_REVISIT
    seen = (rows.filter(long).groupBy("digest").agg(F.max("id").alias("low"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1 AND low IS NOT NULL").select("digest", F.col("low").alias("first_id")))
    if seen.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        joined = rows.join(F.broadcast(seen), "digest", "left")
    else:  # a digest shared by many rows is dealt to SALTS tasks
        salt = F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")
        copies = seen.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", salt).join(copies, ["digest", "salt"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return joined.select("id", "url", "payload", "digest", F.when(revisit, F.col("first_id")).alias("refers_to"))


# ------------------------------------------------------------------- writing

def _record(row) -> bytes:
    """One WARC/1.1 record: a response, or a revisit that has the HTTP header
    (with the full payload's length) but no payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(row.payload)).encode() + b"\r\n\r\n")
    revisit = row.refers_to is not None and not pd.isna(row.refers_to)
    block = http if revisit else http + row.payload
    uri = "" if row.url is None else re.sub(r"[\r\n]+", " ", row.url)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Record-ID: <urn:page:{'' if pd.isna(row.id) else int(row.id)}>",
            "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(row.digest)).decode()]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{int(row.refers_to)}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(planned: DataFrame, folder: str) -> DataFrame:
    """(archive): the archives written into ``folder``, each one gzip stream.
    Lazy: read the result once and store it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        task, made = TaskContext.get(), 0
        out = None
        for pdf in batches:
            pdf = pdf.astype({"id": "Int64", "refers_to": "Int64"})
            for row in pdf.itertuples(index=False):
                if out is None:
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{made:04d}.warc.gz"
                    out, gz, size = fs.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), 0
                out.write(gz.compress(_record(row)))
                size += len(row.payload)
                if size >= ARCHIVE_BYTES:
                    out.write(gz.flush())
                    out.close()
                    out, made = None, made + 1
                    yield pd.DataFrame({"archive": [name]})
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield pd.DataFrame({"archive": [name]})
    return planned.mapInPandas(run, "archive string")


# --------------------------------------------------------------- normalising

def _inflated(stream) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, piece by piece."""
    inflate, rest = zlib.decompressobj(31), b""
    while True:
        data = rest or stream.read(_READ)
        rest = b""
        if not data:
            if not inflate.eof and inflate.unconsumed_tail == b"" and getattr(inflate, "begun", False):
                raise ValueError("the gzip stream ends early")
            return
        piece = inflate.decompress(data)
        if inflate.eof:
            rest = inflate.unused_data
            inflate = zlib.decompressobj(31)
        if piece:
            yield piece


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records (with their closing line ends) of an inflated archive."""
    held = bytearray()
    need = 0  # bytes of the first record, once its header is known
    for piece in pieces:
        held += piece
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                length = _LENGTH.search(held, 0, end + 2)
                if not held.startswith(b"WARC/") or not length:
                    raise ValueError(f"no WARC record: {bytes(held[:60])!r}")
                need = end + 4 + int(length[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the archive ends inside a record")


def header(record: bytes) -> tuple[dict[str, str], bytes]:
    """The WARC header fields of a record, lower-cased, and its block."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, block[:int(fields["content-length"])]


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """(archive, index, records): for each archive, the name of the rewritten
    one and of its sidecar.  Each stream is inflated once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = file_system(folder)
        tag = TaskContext.get().taskAttemptId()
        for pdf in batches:
            for name in pdf["archive"]:
                new = f"{name[:-len('.warc.gz')]}-n{tag}.warc.gz"
                offset, n = 0, 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as source, \
                        fs.open_output_stream(f"{path}/{new}", compression=None) as out, \
                        fs.open_output_stream(f"{path}/{new}.idx", compression=None) as index:
                    for record in records(_inflated(source)):
                        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = gz.compress(record) + gz.flush()
                        fields, _ = header(record)
                        line = {"offset": offset, "length": len(member), "type": fields["warc-type"],
                                "id": fields["warc-record-id"], "uri": fields["warc-target-uri"]}
                        out.write(member)
                        index.write(json.dumps(line).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                yield pd.DataFrame({"archive": [new], "index": [f"{new}.idx"], "records": [n]})
    return archives.mapInPandas(run, "archive string, index string, records long")


# ------------------------------------------------------------------- reading

def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while data := stream.read(_READ):
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


def read(archives: DataFrame, folder: str) -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to, payload)
    of every record, found by the sidecar index; a revisit has no payload.  The
    digest of a response is recomputed and must equal its header's."""
    def number(urn: str | None):
        digits = (urn or "").removeprefix("<urn:page:").rstrip(">")
        return int(digits) if digits else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = file_system(folder)
        for pdf in batches:
            for name, index in zip(pdf["archive"], pdf["index"]):
                out, held = [], 0
                with fs.open_input_file(f"{path}/{name}") as source, \
                        fs.open_input_stream(f"{path}/{index}", compression=None) as lines:
                    for line in _lines(lines):
                        at = json.loads(line)
                        source.seek(at["offset"])
                        fields, block = header(zlib.decompress(source.read(at["length"]), 31))
                        http, _, payload = block.partition(b"\r\n\r\n")
                        n = int(_LENGTH.search(http + b"\r\n")[1])
                        digest = base64.b32decode(fields["warc-payload-digest"][5:]).hex()
                        revisit = fields["warc-type"] == "revisit"
                        if not revisit and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"{name}: the record at {at['offset']} is damaged")
                        out.append((number(fields["warc-record-id"]), fields["warc-target-uri"], n, digest,
                                    fields["warc-type"], number(fields.get("warc-refers-to")),
                                    None if revisit else payload))
                        held += len(payload)
                        if held >= _READ * 8:
                            yield _frame(out)
                            out, held = [], 0
                if out:
                    yield _frame(out)

    def _frame(rows) -> pd.DataFrame:
        cols = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        return pd.DataFrame(rows, columns=cols).astype({"id": "Int64", "refers_to": "Int64"})

    return archives.mapInPandas(run, "id long, url string, payload_bytes long, payload_digest string, "
                                     "record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """Write ``pages`` as monolithic archives into ``folder``, normalise them,
    and read every record back: the columns of :func:`read`.  Null html is the
    empty payload; a null url reads back as the empty text; an empty table
    gives no archive and no row."""
    from .common import stored
    made = stored(write(plan(pages, key, url, html), folder), "warc-made")
    tasks = max(1, pages.sparkSession.sparkContext.defaultParallelism)
    normal = stored(normalise(made.repartition(tasks), folder), "warc-normal")
    return read(normal.repartition(tasks), folder)
