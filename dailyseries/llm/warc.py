"""WARC: monolithic gzip normaliser with a sidecar offset index.

Three steps, each one Spark job over archives:

1. ``write_monolithic`` packs rows into WARC files that are one gzip stream
   each, as some crawlers leave them: nothing in them can be read without
   inflating everything before it.
2. ``normalise`` inflates every such stream once, front to back, and rewrites
   each record as a gzip member of its own.  Repeated payloads become revisit
   records.  A sidecar index (a table) holds archive, offset and length.
3. ``read_records`` seeks each record through the index and parses it.

Files are written through ``pyarrow.fs`` from the URI of the shared folder,
under a task-attempt name and then moved, so a retried task leaves whole files
only.  Gzip headers carry no time, hence a rerun writes the same bytes.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import materialize, rows_of, small_batches
from dailyseries.session import scratch_path

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
READ_RECORDS = 4096  # consecutive records read by one task
CRLF = b"\r\n"
CHUNK = 1 << 18
DATE = b"1970-01-01T00:00:00Z"  # pages carry no fetch time

_ENTRY = pa.schema([("archive", pa.string()), ("nth", pa.int64()), ("page_id", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload_key", pa.string())])
ENTRY_SCHEMA = ("archive string, nth long, page_id long, payload_bytes long, payload_digest string, "
                "payload_key string")
_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                    ("nth", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string())])
INDEX_SCHEMA = "archive string, offset long, length long, nth long, page_id long, record_type string"
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
                     ("payload", pa.binary())])
RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                 "target_uri string, payload binary")


def open_fs(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):  # Hadoop writes file:/path, Arrow wants file:///path
        uri = "file:///" + uri.split(":", 1)[1].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def record_bytes(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, size: int,
                 refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record.  A header value never holds a line break."""
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Date: " + DATE,
            b"Content-Type: application/octet-stream", b"WARC-Payload-Digest: sha1:" + digest.encode(),
            b"X-Payload-Length: %d" % size]
    if page_id is not None:
        head += [b"WARC-Record-ID: <urn:page:%d>" % page_id]
    if url is not None:
        head += [b"WARC-Target-URI: " + " ".join(url.splitlines()).encode()]
    if refers_to is not None:
        head += [b"WARC-Refers-To: <urn:page:%d>" % refers_to,
                 b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return CRLF.join([*head, b"Content-Length: %d" % len(payload), b"", payload]) + CRLF * 2


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def parse_stream(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record of an uncompressed WARC stream; only
    the record at hand is held in memory."""
    buffer = bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while fill(1):
        searched = 0
        while (end := buffer.find(CRLF * 2, max(0, searched - 3))) < 0:
            searched = len(buffer)
            if not fill(len(buffer) + 1):
                raise ValueError("a record's header is cut off")
        head = parse_head(bytes(buffer[:end]))
        size = int(head["content-length"])
        whole = end + 4 + size + 4
        if not fill(whole):
            raise ValueError("a record is cut off")
        payload = bytes(buffer[end + 4:end + 4 + size])
        del buffer[:whole]
        yield head, payload


def inflate(stream) -> Iterator[bytes]:
    """Uncompressed chunks of a gzip file of one or many members."""
    d = zlib.decompressobj(31)
    data = stream.read(CHUNK)
    while data:
        out = d.decompress(data, 4 * CHUNK)
        if out:
            yield out
        data = d.unconsumed_tail
        if d.eof:
            data = d.unused_data
            d = zlib.decompressobj(31)
        if not data:
            data = stream.read(CHUNK)


class ArchiveWriter:
    """One archive file, written under an attempt's name and moved when whole."""

    def __init__(self, folder: str, name: str):
        self.fs, root = open_fs(folder)
        self.path = f"{root}/{name}"
        self.part = f"{root}/.{name}.{uuid.uuid4().hex[:8]}"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.at = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row; returns (archive, nth, page_id, payload_bytes,
    payload_digest, payload_key).  A task rolls to a new archive at
    ``archive_bytes`` of uncompressed records, which bounds later tasks."""

    def run(batches):
        part, roll, writer, deflate, nth, raw = TaskContext.get().partitionId(), 0, None, None, 0, 0
        for batch in batches:
            rows = []
            for page_id, url, html in rows_of(batch):
                if writer is None:
                    name = f"crawl-{part:06d}-{roll:04d}.warc.gz"
                    writer, deflate, nth, raw = ArchiveWriter(folder, name), zlib.compressobj(1, wbits=31), 0, 0
                payload = (html or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                record = record_bytes("response", page_id, url, payload, digest, len(payload))
                writer.write(deflate.compress(record))
                rows.append({"archive": name, "nth": nth, "page_id": page_id, "payload_bytes": len(payload),
                             "payload_digest": digest, "payload_key": hashlib.sha256(payload).hexdigest()})
                nth, raw = nth + 1, raw + len(record)
                if raw >= archive_bytes:
                    writer.write(deflate.flush())
                    writer.close()
                    writer, roll = None, roll + 1
            yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY)
        if writer is not None:
            writer.write(deflate.flush())
            writer.close()

    small_batches(pages.sparkSession)
    columns = pages.select("page_id", F.col("url").cast("string").alias("url"),
                           F.col("html").cast("string").alias("html"))
    return materialize(columns.mapInArrow(run, ENTRY_SCHEMA), "warc-entries")


def decide(entries: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(archive, nth, refers_to, first) of the records that become revisits.

    Of equal payloads (equal SHA-256) of at least ``min_bytes``, the record
    with the largest page_id is the response; among rows that repeat that
    page_id, or when all page_ids are null, the first by archive and number.
    """
    large = entries.where(F.col("payload_bytes") >= min_bytes)
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("id"), F.col("archive"),
                     (-F.col("nth")).alias("nth"))
    best = (large.groupBy("payload_key").agg(F.max(order).alias("best"), F.max("page_id").alias("refers_to"),
                                             F.count("*").alias("n")).where("n > 1"))
    return (large.join(best, "payload_key")
            .where(~((F.col("archive") == F.col("best.archive")) & (-F.col("nth") == F.col("best.nth"))))
            .select("archive", "nth", "refers_to"))


def normalise(entries: DataFrame, revisits: DataFrame, raw_folder: str, folder: str) -> DataFrame:
    """Rewrite every monolithic archive record by record; returns the sidecar
    index (archive, offset, length, nth, page_id, record_type).

    One task per archive; it gets the archive's name and its revisit
    decisions, and streams the records.
    """
    archives = entries.select("archive").distinct()
    # a number keeps the tasks apart: by their size, rows about archives would all be put into one
    tasks = max(1, archives.count())
    decided = (archives.withColumns({"nth": F.lit(None).cast("long"),
                                                                 "refers_to": F.lit(None).cast("long")})
               .unionByName(revisits).repartition(tasks, "archive"))

    def run(key: tuple[pa.Scalar, ...], decisions: pa.Table) -> pa.Table:
        name = key[0].as_py()
        refers = {n: r for n, r in zip(decisions["nth"].to_pylist(), decisions["refers_to"].to_pylist(),
                                       strict=True) if n is not None}
        fs, root = open_fs(raw_folder)
        writer, rows = ArchiveWriter(folder, name), []
        with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
            for nth, (head, payload) in enumerate(parse_stream(inflate(stream))):
                rid = head.get("warc-record-id")
                page_id = int(rid[len("<urn:page:"):-1]) if rid else None
                kind = "revisit" if nth in refers else "response"
                record = record_bytes(kind, page_id, head.get("warc-target-uri"),
                                      b"" if nth in refers else payload, head["warc-payload-digest"][5:],
                                      len(payload), refers.get(nth))
                c = zlib.compressobj(3, wbits=31)
                member = c.compress(record) + c.flush()
                rows.append({"archive": name, "offset": writer.at, "length": len(member), "nth": nth,
                             "page_id": page_id, "record_type": kind})
                writer.write(member)
        writer.close()
        return pa.Table.from_pylist(rows, schema=_INDEX)

    return materialize(decided.groupBy("archive").applyInArrow(run, INDEX_SCHEMA), "warc-index")


def read_records(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Read records back through the index, each by one seek and one member.

    A response's payload is hashed again and must have the digest and length
    its header gives; a corrupt record raises.  With ``payload=False`` the
    payload column is null."""

    def run(batches):
        fs, root = open_fs(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, fs.open_input_file(f"{root}/{archive}")
                source.seek(offset)
                raw = zlib.decompress(source.read(length), wbits=31)
                head, _, rest = raw.partition(CRLF * 2)
                head = parse_head(head)
                body = rest[:int(head["content-length"])]
                digest, size = head["warc-payload-digest"][5:], int(head["x-payload-length"])
                if head["warc-type"] == "response" and (len(body) != size or
                                                        hashlib.sha1(body).hexdigest() != digest):
                    raise ValueError(f"{archive} at {offset}: payload does not match its digest")
                ids = [int(x[len("<urn:page:"):-1]) if (x := head.get(k)) else None
                       for k in ("warc-record-id", "warc-refers-to")]
                rows.append({"page_id": ids[0], "payload_bytes": size, "payload_digest": digest,
                             "record_type": head["warc-type"], "refers_to": ids[1],
                             "target_uri": head.get("warc-target-uri"),
                             "payload": body if payload and head["warc-type"] == "response" else None})
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
        if source is not None:
            source.close()

    return index.select("archive", "offset", "length").mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame, payload: bool = False) -> DataFrame:
    """Write, normalise and read back all rows of ``pages``.

    Null html is an empty payload; a null page_id or url leaves its header
    out and comes back as null; repeated rows are records of their own; an
    empty table gives an empty result.  Line breaks in a url become spaces.
    A very long page is one record, written and read whole.  Of equal payloads
    with the same largest page_id one is the response.  Other columns are
    not read, whatever their names.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    entries = write_monolithic(pages, f"{folder}/raw")
    index = normalise(entries, decide(entries), f"{folder}/raw", f"{folder}/records")
    # members of one archive in order: seeks go forward and each task keeps few files open
    block = F.floor(F.col("nth") / READ_RECORDS)
    tasks = max(1, index.groupBy("archive", block.alias("block")).count().count())
    ordered = index.repartition(tasks, "archive", block).sortWithinPartitions("archive", "offset")
    return read_records(ordered, f"{folder}/records", payload)


def digest_columns(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
q as (select page_id, octet_length(b) as payload_bytes, sha1(b) as payload_digest, sha256(b) as k from p),
m as (select *, max(page_id) over (partition by k) as top from q)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when payload_bytes >= {MIN_REVISIT_BYTES} and page_id < top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= {MIN_REVISIT_BYTES} and page_id < top then top end as refers_to
from m
"""
