"""WARC archives: write, normalise to one gzip member per record with an offset index, read back (operator 1)."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import scratch_folder
from .common import small, store

LEAST_REVISIT_BYTES = 100
ROLL_BYTES = 256 << 20  # an archive is closed once it holds so many bytes before compression
RECORDS_A_READ = 2_000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
GZIP = 31  # zlib's window bits for the gzip format
CHUNK = 1 << 20


def _fs(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP header only."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[2:2] = [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode("utf-8", "replace") + END + block + END


def inflate(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content of a gzip stream of any number of members."""
    member = zlib.decompressobj(GZIP)
    for data in chunks:
        while data:
            yield member.decompress(data)
            data = member.unused_data
            if member.eof:
                member = zlib.decompressobj(GZIP)


def records(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Whole records from pieces of an inflated archive; memory is that of a record and a piece."""
    held = bytearray()
    for data in chunks:
        held += data
        at = 0
        while (head := held.find(END, at)) >= 0:
            size = re.search(rb"\r\nContent-Length: *(\d+)", held[at:head], re.I)
            end = head + len(END) + int(size[1]) + len(END)
            if end > len(held):
                break
            yield bytes(held[at:end])
            at = end
        del held[:at]
    if held:
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, block = data.partition(END)
    return dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:]), block[: -len(END)]


def gz(data: bytes) -> bytes:
    member = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return member.compress(data) + member.flush()


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives of one gzip stream each; (path, records) per archive.

    Every task streams its rows.  File names are drawn anew by every attempt and only the files of the attempt that
    counts are listed, so a lost executor leaves at most files that nobody reads.
    """
    html = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    html = html.withColumn("digest", F.sha2("payload", 256))
    # copies meet as digests; only repeated ones are joined back
    first = (html.filter(F.octet_length("payload") >= LEAST_REVISIT_BYTES).groupBy(F.col("digest").alias("__digest"))
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    # stored, so that both sides of the join are plain exchanges and the partition of a hot payload can be split
    rows = html.join(store(first), F.col("digest") == F.col("__digest"), "left")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))

    def write(batches):
        fs, path = _fs(folder)
        fs.create_dir(path, recursive=True)
        out, made = None, []
        for b in small(batches):
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, stream, size, n = fs.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, GZIP), 0, 0
                data = record(*row)
                out.write(stream.compress(data))
                size, n = size + len(data), n + 1
                if size >= roll_bytes:
                    out.write(stream.flush())
                    out.close()
                    made.append((name, n))
                    out = None
        if out is not None:
            out.write(stream.flush())
            out.close()
            made.append((name, n))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{m[0]}" for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["path", "records"])

    return store(rows.select("page_id", "url", "payload", "digest", refers.alias("refers_to")).mapInArrow(write, "path string, records long"))


def _spread(rows: DataFrame) -> DataFrame:
    return rows.repartition(max(1, rows.count()))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (path) so that every record is a gzip member; (path, records) of the new ones.

    A task inflates its stream once and holds one record at a time.  Next to the archive lies its index `path`.idx: a
    line "offset length record-id" for each record.  Archives may hold one stream or any number of members.
    """

    def rewrite(batches):
        fs, target = _fs(folder)
        fs.create_dir(target, recursive=True)
        made = []
        for b in batches:
            for uri in b.column(0).to_pylist():
                source, path = _fs(uri)
                name = f"{uuid.uuid4().hex}.warc.gz"
                at, n = 0, 0
                with source.open_input_stream(path, compression=None) as data, fs.open_output_stream(f"{target}/{name}", compression=None) as out, \
                        fs.open_output_stream(f"{target}/{name}.idx", compression=None) as index:
                    for r in records(inflate(iter(lambda: data.read(CHUNK), b""))):
                        member = gz(r)
                        out.write(member)
                        index.write(f"{at} {len(member)} {re.search(rb'WARC-Record-ID: *(<[^>]*>)', r, re.I)[1].decode()}\n".encode())
                        at, n = at + len(member), n + 1
                made.append((name, n))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{m[0]}" for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["path", "records"])

    return store(_spread(archives.select("path")).mapInArrow(rewrite, "path string, records long"))


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn and urn != "<urn:page:>" else None


def read_archives(archives: DataFrame, per_read: int = RECORDS_A_READ) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records of normalised archives.

    Tasks read ranges of the index, so an archive is read by several of them.  A response whose payload does not have the
    digest in its header raises.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(per_read).cast("long"))
    ranges = archives.filter("records > 0").select("path", F.explode(starts).alias("start"))

    def read(batches):
        for b in batches:
            for uri, start in zip(*(c.to_pylist() for c in b.columns)):
                fs, path = _fs(uri)
                with fs.open_input_stream(f"{path}.idx", compression=None) as index:
                    lines = index.read().split(b"\n")[start : start + per_read]
                rows = []
                with fs.open_input_file(path) as data:
                    for line in filter(None, lines):
                        offset, length, _ = line.split(b" ", 2)
                        head, block = parse(zlib.decompress(data.read_at(int(length), int(offset)), GZIP))
                        http, _, payload = block.partition(END)
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        if head["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or size != len(payload)):
                            raise ValueError(f"{uri}: the record at {int(offset)} is damaged")
                        rows.append((_page(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], _page(head.get("WARC-Refers-To"))))
                columns = list(zip(*rows)) if rows else [[]] * 5
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return _spread(ranges).mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back `pages` (page_id, url, html).

    Of records with equal payloads of at least 100 bytes the smallest page_id's is the response, the others revisit it;
    smaller ones are all responses.  A null html is an empty payload, a null url an empty address.  Rows that repeat the
    smallest page_id and its payload are responses too; a null page_id comes back as null.  No rows give no archive and an empty result.
    """
    folder = scratch_folder(pages.sparkSession)
    return read_archives(normalise(write_archives(pages, f"{folder}/streams"), f"{folder}/members"))
