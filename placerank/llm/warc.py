"""Legacy archives to WARC, and both ways between tables and archive files.

write_arc     pages -> ARC files; version 1 and 2 headers alternate by task
read_arc      ARC files -> records: the version line says which fields a record's header line has, its last field is the
              declared length, and exactly that many bytes follow
write_warc    records -> WARC files: identifiers, timestamps, types and digests are synthesised from the ARC fields
read_warc     WARC files -> records

Archives are files of gzip members, one per record, of about `roll` bytes each, in the shared folder that the session names.
A task writes under a name of its own and renames when a file is complete, so a task that runs again replaces its files.
A manifest table lists them. The driver sees no record.

Of records with equal payloads (SHA-1 of the bytes) the one with the largest page_id is the response, the others revisit
it. The winners are found by an aggregation on digests that is combined per task; revisits carry no payload.

Defined results: null html is an empty payload; a null page_id revisits a winner that has one and is a response
otherwise; rows that repeat the winner's page_id and payload are responses as well; a null url is written as urn:none.
Payloads are never cut. An empty table makes no files and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from placerank.llm.common import cut_lineage, new_path

ARC_DATE, ARC_IP = "20240101000000", "0.0.0.0"
#: the fields of a record's header line by version, as the format lays down
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, ip string, date string, mime string, payload_bytes long, payload_digest string, member binary"
READ = "page_id long, url string, record_id string, date string, record_type string, payload_bytes long, payload_digest string, refers_to_id string, payload binary"
#: bytes of a file that are unpacked at once
STEP = 8 << 10
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # for URLs, as RFC 4122 lays down


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{payload_digest}:{page_id}')}>"


# ------------------------------------------------------------- files

def _files(df: DataFrame, base: str, ending: str, encode: Callable, opening: Callable, roll: int) -> DataFrame:
    """Writes archives of encode(row) under base/files; returns the manifest (path, records, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        task, number, out = TaskContext.get(), 0, None
        system, folder = fs.FileSystem.from_uri(f"{base}/files")
        system.create_dir(folder, recursive=True)

        def close():
            sink, hidden, name, count = out
            size = sink.tell()
            sink.close()
            system.move(hidden, f"{folder}/{name}")
            return pa.RecordBatch.from_pydict({"path": [f"{base}/files/{name}"], "records": [count], "bytes": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    # the attempt is part of the name, so that a late attempt cannot write over an archive that the manifest lists
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.{ending}"
                    hidden = f"{folder}/_{name}"
                    out = [system.open_output_stream(hidden, compression=None), hidden, name, 0]
                    first = opening(name, task.partitionId())
                    if first:
                        out[0].write(gzip.compress(first, 1, mtime=0))
                out[0].write(gzip.compress(encode(row), 1, mtime=0))
                out[3] += 1
                if out[0].tell() >= roll:
                    yield close()
                    out, number = None, number + 1
        if out is not None:
            yield close()

    df.mapInArrow(run, "path string, records long, bytes long").write.parquet(f"{base}/manifest")
    return df.sparkSession.read.parquet(f"{base}/manifest")


def _members(raw) -> Iterator[tuple[bytes, bytes]]:
    """The gzip members of a file, one after the other: (content, the member itself)."""
    view, start = memoryview(raw), 0
    while start < len(view):
        unzip, parts, at = zlib.decompressobj(31), [], start
        while not unzip.eof and at < len(view):  # in steps, as what follows a member is copied
            parts.append(unzip.decompress(view[at:at + STEP]))
            at += STEP
        end = min(at, len(view)) - len(unzip.unused_data)
        yield b"".join(parts), bytes(view[start:end])
        start = end


def _parsed(spark: SparkSession, base: str, ending: str, parse: Callable, schema: str) -> DataFrame:
    """The records of the archives that the manifest lists, in rows of the schema.

    Only those: a lost attempt may have left whole archives in the folder, whose records were written again by the attempt
    that took its place. The tasks open the archives themselves; neither names nor contents pass through the driver.
    """
    manifest = spark.read.parquet(f"{base}/manifest")
    files = manifest.count()
    if not files:
        return spark.createDataFrame([], schema)
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(f.split()[0], types[f.split()[1]]) for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column("path").to_pylist():
                if not path.endswith(f".{ending}"):
                    raise ValueError(f"{path} is not a {ending} archive")
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as source:
                    raw = source.read_buffer()
                rows, size = [], 0
                for row in parse(raw):
                    rows.append(row)
                    size += sum(len(v) for v in row if isinstance(v, bytes))
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], arrow)

    # a task per archive, which is as large as `roll` lets it grow
    return manifest.select("path").repartition(min(files, 20_000)).mapInArrow(run, schema)


# ------------------------------------------------------------- ARC

def _arc_head(name: str, version: int) -> bytes:
    body = f"{version} 0 placerank\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    more = "200 - - 0 " + name + " " if version == 2 else ""
    return f"filedesc://{name} {ARC_IP} {ARC_DATE} text/plain {more}{len(body)}\n".encode() + body + b"\n"


def write_arc(pages: DataFrame, base: str, roll: int = 32 << 20) -> DataFrame:
    """Pages (page_id, url, html) as ARC files; the manifest."""

    def version(task: int) -> int:
        return 1 + task % 2

    def encode(row: dict) -> bytes:
        payload = row["html"] or b""
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        if row["page_id"] is not None:
            head += f"X-Page-Id: {row['page_id']}\r\n".encode()
        block = head + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
        url = quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~") if row["url"] else "urn:none"
        more = f"200 {digest(payload)} - 0 - " if version(TaskContext.get().partitionId()) == 2 else ""
        return f"{url} {ARC_IP} {ARC_DATE} text/html {more}{len(block)}\n".encode() + block + b"\n"

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html"))
    return _files(rows, base, "arc.gz", encode, lambda name, task: _arc_head(name, version(task)), roll)


def _split(url: str, block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head with its empty line, payload); other protocols have no head."""
    if not block.startswith(b"HTTP/") and not url.startswith(("http:", "https:")):
        return b"", block
    head, gap, payload = block.partition(b"\r\n\r\n")
    return (head + gap, payload) if gap else (b"", block)


def _arc_record(data: bytes, at: int, fields: list[str] | None) -> tuple[int, dict[str, str], bytes]:
    """(where it ends, fields by name, block) of the record whose header line starts at `at`; fields None: URL alone."""
    end = data.find(b"\n", at)
    line = data[at:end if end >= 0 else len(data)].strip()
    parts, at = line.decode("utf-8", "replace").split(" "), end + 1 if end >= 0 else len(data)
    length = int(parts[-1])
    block = data[at:at + length]
    if len(block) < length:
        raise ValueError(f"{length} bytes declared, {len(block)} found: {line[:200]!r}")
    if fields is None or parts[0].startswith("filedesc:"):
        return at + length, {"URL": parts[0]}, block
    if len(parts) < len(fields):
        raise ValueError(f"{len(fields)} fields expected: {line[:200]!r}")
    # a url may hold spaces: it is what stands left of the other fields
    cut = len(parts) - len(fields) + 1
    return at + length, dict(zip(fields[1:], parts[cut:]), URL=" ".join(parts[:cut])), block


def parse_arc(raw) -> Iterator[tuple]:
    """Records of an ARC file (plain or of gzip members), without its own description.

    member is the record as a gzip member, as it stands in the file or made here.
    """
    fields = ARC_FIELDS[1]
    for data, member in _members(raw) if bytes(raw[:2]) == b"\x1f\x8b" else [(bytes(raw), None)]:
        at = 0
        while at < len(data):
            if data[at:at + 1] in b"\r\n":
                at += 1
                continue
            end, named, block = _arc_record(data, at, fields)
            if named["URL"].startswith("filedesc:"):
                fields = ARC_FIELDS[int(block.split(b" ", 1)[0])]
            else:
                head, payload = _split(named["URL"], block)
                page_id = next((int(h[10:]) for h in head.split(b"\r\n") if h.lower().startswith(b"x-page-id:")), None)
                yield (page_id, named["URL"], named["IP-address"], named["Archive-date"], named["Content-type"], len(payload), digest(payload),
                       member if member is not None else gzip.compress(data[at:end], 1, mtime=0))
            at = end


def read_arc(spark: SparkSession, base: str) -> DataFrame:
    return _parsed(spark, base, "arc.gz", parse_arc, RECORDS)


# ------------------------------------------------------------- WARC

def warc_date(date: str) -> str:
    """A 14-digit date (shorter ones are filled up) as ISO 8601."""
    d = date + "00000101000000"[len(date):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def encode_warc(row: dict) -> bytes:
    """One WARC record of an ARC record; a revisit of winner if is_revisit."""
    head, payload = _split(row["url"], _arc_record(gzip.decompress(row["member"]), 0, None)[2])
    block = head if row["is_revisit"] else head + payload
    kind = "revisit" if row["is_revisit"] else "response" if head else "resource"
    lines = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(row["page_id"], row["payload_digest"])), ("WARC-Date", warc_date(row["date"])),
        ("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"]),
        ("Content-Type", "application/http; msgtype=response" if head else row["mime"]),
        ("WARC-Payload-Digest", "sha1:" + row["payload_digest"]), ("WARC-Block-Digest", "sha1:" + digest(block)),
        ("X-Payload-Length", str(row["payload_bytes"])),
    ]
    if row["is_revisit"]:
        lines += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(row["winner"], row["payload_digest"]))]
    lines.append(("Content-Length", str(len(block))))
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _warcinfo(name: str, task: int) -> bytes:
    body = b"software: placerank\r\nformat: WARC File Format 1.0\r\n"
    head = (f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, name)}>\r\nWARC-Date: {warc_date(ARC_DATE)}\r\n"
            f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    return head + body + b"\r\n\r\n"


def write_warc(records: DataFrame, base: str, min_bytes: int = 0, roll: int = 32 << 20) -> DataFrame:
    """ARC records as WARC files; the manifest. Payloads shorter than min_bytes are all responses."""
    long_enough = F.col("payload_bytes") >= min_bytes
    winners = records.filter(long_enough).groupBy("payload_digest").agg(F.max("page_id").alias("winner"))
    revisit = F.col("winner").isNotNull() & ~F.col("winner").eqNullSafe(F.col("page_id")) & long_enough
    joined = records.join(winners, "payload_digest", "left").withColumn("is_revisit", revisit)
    return _files(joined, base, "warc.gz", encode_warc, _warcinfo, roll)


def parse_warc(raw) -> Iterator[tuple]:
    """Records of a WARC file, without warcinfo."""
    for data, _ in _members(raw) if bytes(raw[:2]) == b"\x1f\x8b" else [(bytes(raw), None)]:
        stream = io.BytesIO(data)
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                if line.strip():
                    raise ValueError(f"no record starts with {line[:80]!r}")
                continue
            head = {}
            while (line := stream.readline().strip()):
                k, _, v = line.decode().partition(": ")
                head[k] = v
            length = int(head["Content-Length"])
            block = stream.read(length)
            if len(block) < length:
                raise ValueError(f"{length} bytes declared, {len(block)} found")
            if head["WARC-Type"] == "warcinfo":
                continue
            http, gap, payload = block.partition(b"\r\n\r\n") if head["Content-Type"].startswith("application/http") else (b"", b"", block)
            page_id = next((int(h[10:]) for h in http.split(b"\r\n") if h.lower().startswith(b"x-page-id:")), None)
            kind, found = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind != "revisit" and digest(payload) != found:
                raise ValueError(f"digest of {head['WARC-Record-ID']} differs")
            yield (page_id, head["WARC-Target-URI"], head["WARC-Record-ID"], head["WARC-Date"], kind,
                   int(head["X-Payload-Length"]) if kind == "revisit" else len(payload), found, head.get("WARC-Refers-To"),
                   None if kind == "revisit" else payload)


def read_warc(spark: SparkSession, base: str) -> DataFrame:
    return _parsed(spark, base, "warc.gz", parse_warc, READ)


def roundtrip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages to ARC files, converted to WARC files and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark, base = pages.sparkSession, new_path(pages.sparkSession, "archives")
    write_arc(pages, f"{base}/arc")
    write_warc(read_arc(spark, f"{base}/arc"), f"{base}/warc", min_bytes)
    back = cut_lineage(read_warc(spark, f"{base}/warc").drop("payload"))
    pointed = back.filter(F.col("record_type") != "revisit").groupBy("record_id").agg(F.max("page_id").alias("refers_to"))
    return (
        back.join(pointed.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id", "left")
        .select("page_id", "payload_bytes", "payload_digest", F.col("record_type"), "refers_to")
    )
