"""Web archives: monolithic gzip files made seekable.

A crawl often arrives as one gzip stream per archive, which can only be read
from the start.  The normaliser inflates such a stream once, rewrites every
record as a gzip member of its own and lists the members in a sidecar index, so
that any record can be read by offset and an archive by many tasks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as filesystems
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm.common import column_values, small_batches, stored

#: Equal payloads of at least so many bytes are stored once.
LEAST_SHARED = 0
#: Bytes inflated at a time.
BLOCK = 1 << 20
#: Records of an index that one task reads.
RECORDS_PER_READ = 512
#: More tasks than this are not started for one step.
MOST_TASKS = 100_000
LEVEL = 6
_EPOCH = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Records

@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Names that are looked up here; archives may write them in any case.
_NAMES = {
    name.lower(): name
    for name in (
        "WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Profile",
        "WARC-Refers-To", "Content-Type", "Content-Length", "Page-ID", "Payload-Length", "Refers-To-Page-ID",
    )
}


def parse_record(data: bytes) -> Record:
    """Headers and block; names of any case, values with or without a space before them, lines that go on."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last is not None:
            headers[last] = f"{headers[last]} {line.strip()}".strip()
            continue
        name, _, value = line.partition(":")
        last = _NAMES.get(name.strip().lower(), name.strip())
        headers[last] = value.strip()
    return Record(headers, rest[: int(headers["Content-Length"])])


def page_record(page_id, url, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """A response with its payload, or a revisit that names the response and has none."""
    name = "" if page_id is None else str(page_id)
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{name}')}>",
        "WARC-Date": _EPOCH,
        # A header is one line.
        "WARC-Target-URI": "".join(c for c in url or "" if c.isprintable()),
        "Page-ID": name,
        "WARC-Payload-Digest": f"sha1:{payload_digest}",
        "Payload-Length": str(len(payload)),
        "Content-Type": "text/html; charset=utf-8",
    }
    if refers_to is None:
        return record_bytes(headers, payload)
    headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    headers["WARC-Refers-To"] = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"
    headers["Refers-To-Page-ID"] = str(refers_to)
    return record_bytes(headers, b"")


def records_of_stream(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, from the bytes of an archive in pieces of any size."""
    held = bytearray()
    pieces = iter(pieces)
    ended = False
    while True:
        head = held.find(b"\r\n\r\n")
        if head >= 0:
            length = next(
                int(line.split(b":", 1)[1]) for line in bytes(held[:head]).split(b"\r\n") if line.lower().startswith(b"content-length:")
            )
            end = head + 4 + length + 4
            if len(held) >= end:
                yield bytes(held[:end])
                del held[:end]
                continue
        if ended:
            if held.strip():
                raise ValueError("the archive ends within a record")
            return
        piece = next(pieces, None)
        if piece is None:
            ended = True
        else:
            held += piece


def inflated(read, block: int = BLOCK) -> Iterator[bytes]:
    """A gzip stream of one or more members, inflated block by block."""
    inflate = zlib.decompressobj(wbits=31)
    while data := read(block):
        while data:
            yield inflate.decompress(data, block) if not inflate.eof else b""
            if inflate.eof:
                data = inflate.unused_data
                inflate = zlib.decompressobj(wbits=31)
            else:
                data = inflate.unconsumed_tail
    if rest := inflate.flush():
        yield rest


# Files, on any file system that all tasks reach

def _place(path: str) -> tuple[filesystems.FileSystem, str]:
    return filesystems.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Published:
    """A file that appears under its name when it is whole; attempts do not meet."""

    def __init__(self, path: str) -> None:
        self.fs, self.name = _place(path)
        self.own = f"{self.name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.fs.create_dir(self.name.rsplit("/", 1)[0], recursive=True)
        self.out = self.fs.open_output_stream(self.own, compression=None)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.fs.move(self.own, self.name)
        else:
            self.fs.delete_file(self.own)


def _write_batches(folder: str):
    """Each task writes its pages as one archive, in one gzip stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n = f"{folder}/crawl-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with _Published(path) as out:
            with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=LEVEL, mtime=0) as stream:
                for batch in batches:
                    columns = (column_values(batch, c) for c in ("page_id", "url", "payload", "refers_to", "digest"))
                    for page_id, url, payload, refers_to, known in zip(*columns, strict=True):
                        stream.write(page_record(page_id, url, payload, known, refers_to))
                        n += 1
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return run


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known = pa.array([digest(p) for p in column_values(batch, "payload")], pa.string())
        yield batch.append_column("digest", known)


def write_archives(pages: DataFrame, folder: str, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Writes the pages as monolithic ``.warc.gz`` files; returns ``path, records``.

    Of equal payloads of at least ``least_shared`` bytes the one with the
    largest page_id is the response, and so is any that repeats that id; the
    others revisit it.  Without an id among them all are responses.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).mapInArrow(_digest_batches, "page_id long, url string, payload binary, digest string")
    size = F.octet_length("payload")
    first = rows.select("digest", "page_id", size.alias("bytes")).filter(F.col("bytes") >= least_shared).groupBy(
        "digest", "bytes"
    ).agg(F.max("page_id").alias("response"))
    told = rows.withColumn("bytes", size).join(first, ["digest", "bytes"], "left")
    revisits = ~F.col("page_id").eqNullSafe(F.col("response"))
    marked = told.withColumn("refers_to", F.when(revisits, F.col("response")))
    written = marked.select("page_id", "url", "payload", "refers_to", "digest")
    return stored(written.mapInArrow(_write_batches(folder), "path string, records long"), "archives")


def normalise(source: str, target: str) -> tuple[str, int]:
    """Rewrites an archive with a member per record; its index, ``target + '.idx'``, has a JSON line for each."""
    files, name = _place(source)
    entries, offset = [], 0
    with files.open_input_stream(name, compression=None) as stream, _Published(target) as out:
        for record in records_of_stream(inflated(stream.read)):
            member = gzip.compress(record, LEVEL, mtime=0)
            out.write(member)
            headers = parse_record(record).headers
            entries.append(
                {"offset": offset, "length": len(member), "type": headers["WARC-Type"], "page_id": headers.get("Page-ID", "")}
            )
            offset += len(member)
    with _Published(f"{target}.idx") as out:
        for start in range(0, len(entries), 4096):
            out.write("".join(json.dumps(e) + "\n" for e in entries[start : start + 4096]).encode())
    return target, len(entries)


def _spread(rows: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Deals out rows that are small but stand for much work; a stated number of tasks is not merged."""
    return rows.repartition(max(1, min(tasks, MOST_TASKS)), *keys)


def _normalise_batches(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [normalise(path, f"{folder}/{path.rsplit('/', 1)[1]}") for path in column_values(batch, "path")]
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "records": [n for _, n in done]})

    return run


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Normalises the archives in ``path``, a task each, into ``folder``; returns ``path, records``."""
    small_batches(archives.sparkSession)
    spread = _spread(archives.select("path"), archives.count())
    return stored(spread.mapInArrow(_normalise_batches(folder), "path string, records long"), "normalised")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (column_values(batch, c) for c in ("path", "offset", "length"))
        at, handle = None, None
        for path, offset, length in sorted(zip(*columns, strict=True)):
            if path != at:
                if handle:
                    handle.close()
                files, name = _place(path)
                at, handle = path, files.open_input_file(name)
            record = parse_record(gzip.decompress(handle.read_at(length, offset)))
            h = record.headers
            rows.append(
                {
                    "page_id": int(h["Page-ID"]) if h["Page-ID"] else None,
                    "url": h["WARC-Target-URI"],
                    "payload_bytes": int(h["Payload-Length"]),
                    "payload_digest": h["WARC-Payload-Digest"].removeprefix("sha1:"),
                    "record_type": h["WARC-Type"],
                    "refers_to": int(h["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in h else None,
                    "block_bytes": len(record.block),
                    "intact": h["WARC-Type"] != "response"
                    or (digest(record.block) == h["WARC-Payload-Digest"].removeprefix("sha1:")),
                }
            )
        if handle:
            handle.close()
        yield pa.RecordBatch.from_pylist(rows, _READ)


_READ = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("block_bytes", pa.int64()), ("intact", pa.bool_()),
    ]
)


def read_records(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """The records of normalised archives, by their indexes; several tasks share an archive."""
    small_batches(spark)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in column_values(batch, "path"):
                files, name = _place(f"{path}.idx")
                with files.open_input_stream(name, compression=None) as stream:
                    entries = [json.loads(line) for line in stream.read().splitlines()]
                for start in range(0, len(entries), RECORDS_PER_READ):
                    some = entries[start : start + RECORDS_PER_READ]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": [path] * len(some),
                            "run": pa.array([start // RECORDS_PER_READ] * len(some), pa.int64()),
                            "offset": pa.array([e["offset"] for e in some], pa.int64()),
                            "length": pa.array([e["length"] for e in some], pa.int64()),
                        }
                    )

    files, records = archives.agg(F.count(F.lit(1)), F.coalesce(F.sum("records"), F.lit(0))).first()
    ddl = "path string, run long, offset long, length long"
    entries = _spread(archives.select("path"), files).mapInArrow(listed, ddl)
    runs = _spread(entries, records // (8 * RECORDS_PER_READ), "path", "run").sortWithinPartitions("path", "offset")
    ddl = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "block_bytes long, intact boolean"
    )
    return runs.mapInArrow(_read_batches, ddl)


def round_trip(pages: DataFrame, folder: str, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Pages written, normalised and read back: the records, one per row of ``pages``.

    Null html is an empty payload, a null url an empty one; null and repeated
    ids are kept.  ``intact`` is false where a response's payload does not match
    its digest.  An empty table gives no records.
    """
    archives = write_archives(pages, f"{folder}/crawl", least_shared)
    return read_records(pages.sparkSession, normalise_archives(archives, f"{folder}/seekable"))
