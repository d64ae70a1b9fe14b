r"""WARC archives in Zstandard: a dictionary frame, then one frame per record.

    skippable frame 0x184D2A5D with the dictionary | frame of record 1 | frame of record 2 | ...

The writer trains a dictionary on the first records of each archive and compresses every record
alone with it, so that any record can be read without the others.  Payloads that occur again are
kept once: of the records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the
largest page_id is a response, the others are revisits that name it and repeat its HTTP header
only.  The reader loads the dictionary, decodes frame by frame and checks the version line, the
mandatory headers, the lengths of header, block and payload, and both digests.

Archives are written by range of page_id under names that do not change when a task runs again.

Defined cases: a null html is an empty payload; a null page_id has no id header and counts as the
smallest; of rows with the same page_id and payload the first is the response; a null url has no
target header; control characters of a url are percent-encoded; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import join_on_small, open_folder, put_file, saved, spread

# fixed values of the formats
DICTIONARY_MAGIC, FRAME_MAGIC, TRAINED_MAGIC = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

LEAST_REVISIT = 1000
DICTIONARY_BYTES = 32 << 10
TRAIN_BYTES = 1 << 20
ARCHIVE_BYTES = 16 << 20


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    """One id per page, payload and repetition; the first of a run is number 0."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                 copy: int = 0, date: str = "1970-01-01T00:00:00Z") -> bytes:
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    digest = _digest(payload)
    if not revisit:
        block += payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest, copy)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="".join(chr(c) for c in range(33, 127)))))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest, 0))]
        if refers_to is not None:
            head.append(("X-Refers-To-Page-ID", str(refers_to)))
    head += [("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _digest(block)),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def build_archive(records: list[bytes]) -> bytes:
    """An archive of whole records; without a dictionary where the records are too few to train one."""
    sample, size = [], 0
    for r in records:
        if size >= TRAIN_BYTES:
            break
        sample.append(r[:TRAIN_BYTES])
        size += len(r)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, sample) if len(sample) >= 8 else None
    except zstandard.ZstdError:                        # the samples hold too little to share
        trained = None
    zip_ = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True, write_content_size=True)
    out = bytearray()
    if trained:
        body = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        out += struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body
    for r in records:
        out += zip_.compress(r)
    return bytes(out)


def _frames(data: bytes):
    """The decoded frames of an archive, by the dictionary in its leading skippable frame."""
    at, trained = 0, None
    view = memoryview(data)
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise ValueError("the dictionary frame is cut short")
        body = data[8:8 + size]
        if body[:4] == struct.pack("<I", FRAME_MAGIC):
            body = zstandard.ZstdDecompressor().decompress(body)
        if body[:4] != struct.pack("<I", TRAINED_MAGIC):
            raise ValueError("the leading frame holds no dictionary")
        trained, at = zstandard.ZstdCompressionDict(body), 8 + size
    unzip = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(data):
        one, parts = unzip.decompressobj(), []
        while not one.eof:
            if at >= len(data):
                raise ValueError("the last frame is cut short")
            fed = view[at:at + (64 << 10)]
            parts.append(one.decompress(fed))
            at += len(fed) - len(one.unused_data)
        yield b"".join(parts)


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line {line[:80]!r}")
        out[name.decode().lower()] = value.strip().decode()
    return out


def parse_record(record: bytes) -> dict:
    """The fields of one record; ValueError says what does not hold."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not blank or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ValueError(f"bad version line {version[:40]!r}")
    h = _headers(lines)
    if missing := [k for k in MANDATORY if k not in h]:
        raise ValueError(f"headers are missing: {missing}")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("the block's length is not its Content-Length")
    block = rest[:-4]
    if "warc-block-digest" in h and h["warc-block-digest"] != _digest(block):
        raise ValueError("the block fails its digest")
    http, blank, payload = block.partition(b"\r\n\r\n")
    own = _headers(http.partition(b"\r\n")[2])
    size = int(own["content-length"])
    if h["warc-type"] == "response":
        if len(payload) != size or _digest(payload) != h["warc-payload-digest"]:
            raise ValueError("the payload fails its length or digest")
    elif h["warc-type"] != "revisit" or payload:
        raise ValueError("neither a response nor a revisit without payload")
    return {"record_id": h["warc-record-id"], "record_type": h["warc-type"], "url": h.get("warc-target-uri"),
            "page_id": int(h["x-page-id"]) if "x-page-id" in h else None,
            "refers_to": int(h["x-refers-to-page-id"]) if "x-refers-to-page-id" in h else None,
            "payload_bytes": size, "payload_digest": base64.b32decode(h["warc-payload-digest"].partition(":")[2]).hex(),
            "payload": payload if h["warc-type"] == "response" else None}


def read_archive(data: bytes):
    """The parsed records of an archive; each frame must hold one record and nothing else."""
    for frame in _frames(data):
        yield parse_record(frame)


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          least_revisit: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row into archives in ``folder``; returns the archives (name, n_records, n_bytes before
    compression)."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    big = F.octet_length(F.coalesce(F.col("html"), F.lit(""))) >= least_revisit
    # small payloads get a key of their own, so that they spread over the join
    rows = rows.withColumn("key", F.when(big, F.sha2(body, 256)).otherwise(F.concat(F.lit("p"), F.coalesce("page_id", F.lit(0)))))
    again = saved(rows.filter(big).groupBy("key").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1").select(F.col("key").alias("g_key"), "latest"), "warc-again")
    marked = join_on_small(rows, again, rows.key == again.g_key, "left").select(
        "page_id", "url", "html", "key", "latest", F.col("g_key").isNotNull().alias("shared"))
    ordered = marked.repartitionByRange("page_id", "key").sortWithinPartitions("page_id", "key")

    def run(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        before, copy = None, 0

        def flush():
            name = f"{part:08d}-{seq:06d}.warc.zst"
            put_file(folder, name, build_archive(held))
            return pa.RecordBatch.from_pylist([{"name": name, "n_records": len(held), "n_bytes": size}], schema=made)
        for batch in batches:
            for i, u, h, key, latest, shared in zip(*(c.to_pylist() for c in batch.columns)):
                copy = copy + 1 if before == (i, key) else 0
                before, revisit = (i, key), shared and (i != latest or copy > 0)
                held.append(build_record(i, u, (h or "").encode(), latest if revisit else None, revisit, copy))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield flush()
    made = pa.schema([("name", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
    return saved(ordered.mapInArrow(run, "name string, n_records long, n_bytes long"), "warc-files")


def read(spark: SparkSession, folder: str, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of the archives named; a record that fails a check ends the job."""
    fields = ["record_id string", "record_type string", "url string", "page_id long", "refers_to long",
              "payload_bytes long", "payload_digest string"] + ["payload binary"] * payloads
    schema = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in fields])

    def run(batches):
        store, base = open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{base}/{name}") as source:
                    data = source.read()
                held = []
                for r in read_archive(data):
                    held.append({k: r[k] for k in schema.names})
                    if len(held) == 500:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
    total = archives.agg(F.sum("n_bytes")).first()[0] or 0
    return spread(archives.select("name"), total).mapInArrow(run, ", ".join(fields))
