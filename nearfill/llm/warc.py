"""WARC archives of pages, compressed record by record with an embedded Zstandard dictionary.

Each task writes archives of about ``FILE_BYTES``.  An archive begins with a
skippable frame (magic 0x184D2A5D) that holds a dictionary built from records of
that archive; every WARC record is one Zstandard frame compressed with it, so a
reader needs nothing but the archive and can start at any record.  Payloads that
occur more than once are stored once: of equal payloads of at least
``min_bytes`` the one with the largest key is a response, the others are revisit
records that refer to it and have no payload.

Defined results: a null payload is an empty one; a null key is written as an
empty id, never wins, and comes back as null (it is a response if no equal
payload has a key); rows with the same key and payload are all responses where
that key wins; an empty table gives an empty table and no archive.  Other
columns are not read, whatever their names.
"""
from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs, stages

#: Uncompressed payload bytes of an archive, about.
FILE_BYTES = 64 << 20
#: Bytes of records that a dictionary is built from: evenly spaced records, each up to SAMPLE_RECORD bytes.
SAMPLE_BYTES = 2 << 20
SAMPLE_RECORD = 16 << 10
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
_SKIP_MAGIC = 0x184D2A5D
_SKIP = struct.Struct("<II")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def _id(key) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def record(key, url: str | None, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit (``refers_to`` given) without."""
    revisit = refers_to is not None
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(key)}", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of a record: type, key, uri, digest, size, refers_to, payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    field = dict(line.split(": ", 1) for line in (x.decode() for x in head.split(b"\r\n")[1:]) if ": " in line)
    payload = rest[:int(field["Content-Length"])]
    number = lambda name: int(field[name][10:-1]) if field.get(name, "<urn:page:>") != "<urn:page:>" else None
    return {"type": field["WARC-Type"], "key": number("WARC-Record-ID"), "uri": field.get("WARC-Target-URI", "").strip(),
            "digest": field["WARC-Payload-Digest"].removeprefix("sha1:"), "size": int(field["X-Payload-Length"]),
            "refers_to": number("WARC-Refers-To"), "payload": payload}


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from evenly spaced records; few or short ones count several times, as the trainer wants more than they hold."""
    total = sum(min(len(r), SAMPLE_RECORD) for r in records)
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[:SAMPLE_RECORD] for r in records[::step]]
    size = sum(map(len, samples))
    times = max(1, -(-16 // len(samples)), -(-4 * DICTIONARY_BYTES // size))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, size)), samples * times, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # nothing recurs in the samples: their content serves as it is
        return b"".join(samples)[-DICTIONARY_BYTES:]


def archive(records: list[bytes]) -> list[bytes]:
    """The bytes of an archive: skippable frame with the dictionary, then one frame for each record."""
    raw = build_dictionary(records)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw))
    return [_SKIP.pack(_SKIP_MAGIC, len(raw)) + raw, *(packer.compress(r) for r in records)]


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive, frame by frame."""
    magic, size = _SKIP.unpack_from(data)
    if magic != _SKIP_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    raw, rest = data[8:8 + size], memoryview(data)[8 + size:]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    while len(rest):
        frame = reader.decompressobj()
        yield frame.decompress(rest)
        rest = rest[len(rest) - len(frame.unused_data):]


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            uri = blobs.write(folder, f"pages-{task:06d}-{number:04d}.warc.zst", archive(held))
            row = pa.RecordBatch.from_pylist([{"uri": uri, "records": len(held), "bytes": size}])
            held.clear()
            number, size = number + 1, 0
            return row

        for batch in batches:
            keys, urls, pages, digests, sizes, winners = (batch.column(i) for i in range(6))
            for i in range(batch.num_rows):
                key, winner = keys[i].as_py(), winners[i].as_py()
                revisit = winner is not None and winner != key
                payload = b"" if revisit or not pages[i].is_valid else pages[i].as_buffer().to_pybytes()
                r = record(key, urls[i].as_py(), payload, digests[i].as_py(), sizes[i].as_py(), winner if revisit else None)
                held.append(r)
                size += len(r)
                if size >= FILE_BYTES:
                    yield flush()
        if held:
            yield flush()
    return run


def write(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html",
          min_bytes: int = 1000) -> DataFrame:
    """Write archives; the table of archives (uri, records, bytes).

    Winners are found by a pre-aggregated maximum per digest and size; the join
    back is on them, and only its skewed partitions are split by the optimizer.
    """
    spark = pages.sparkSession
    folder = folder or stages.shared_path(spark, "warc")
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    read = (pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("body"))
            .withColumn("digest", F.sha1("body")).withColumn("size", F.octet_length("body").cast("long")))
    winner = (read.where(F.col("size") >= min_bytes).groupBy("digest", "size")
              .agg(F.max("key").alias("winner"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    rows = read.join(winner, ["digest", "size"], "left").select("key", "url", "body", "digest", "size", "winner")
    return stages.table(rows.mapInArrow(_written(folder), "uri string, records long, bytes long"), "warc-list")


def _read_back(with_payload: bool):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "payload"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows: list[tuple] = []
                size = 0
                for data in records_of(blobs.read(uri)):
                    r = parse_record(data)
                    if r["type"] == "response" and (len(r["payload"]) != r["size"] or hashlib.sha1(r["payload"]).hexdigest() != r["digest"]):
                        raise ValueError(f"damaged record {r['key']} in {uri}")
                    rows.append((r["key"], r["size"], r["digest"], r["type"], r["refers_to"], r["uri"],
                                 r["payload"] if with_payload else None))
                    size += len(r["payload"]) if with_payload else 0
                    if len(rows) >= 10_000 or size >= 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return run


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of all archives, each payload checked against its digest.

    Columns: page_id, payload_bytes and payload_digest (of the full payload),
    record_type, refers_to, uri, payload (null without ``with_payload``, empty for revisits).
    """
    spread = archives.select("uri").repartition(max(1, archives.count()))
    return spread.mapInArrow(_read_back(with_payload), (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, payload binary"))
