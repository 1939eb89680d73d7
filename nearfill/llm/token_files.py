"""Token ids in files of fixed-width packed bits.

A file holds documents one after the other:

  * header, 40 bytes: magic ``b"TOKBITS1"``, then unsigned 64-bit little-endian bits per
    id, ids per block, documents, ids;
  * per document its key (signed 64-bit) and its number of ids (unsigned 64-bit),
    then one byte, 1 where the key is null;
  * the byte offset of each block and of the end, from the start of the payload
    (unsigned 64-bit), so that any id is found without reading what stands before it;
  * the payload: blocks of ``BLOCK_IDS`` ids.  In groups of 64 ids, id j of a
    group takes bits ``j * bits`` and up of ``bits`` 64-bit words.

The bits per id are the fewest that hold the vocabulary.  Packing and unpacking
are 64 vectorised shifts, whatever the number of ids.

Defined results: a null or empty text is its end id alone; documents are in
ascending order of the key (null first), rows with one key in order of their
texts; an empty table gives an empty table.
"""
from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import blobs, encoding, stages

MAGIC = b"TOKBITS1"
BLOCK_IDS = 4096
#: A task starts a new file after so many ids.
FILE_IDS = 8_000_000
_HEAD = struct.Struct("<8sQQQQ")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each; the last group of 64 is filled with zeros."""
    groups = -(-len(ids) // 64)
    wide = np.zeros(groups * 64, dtype=np.uint64)
    wide[:len(ids)] = ids
    wide = np.ascontiguousarray(wide.reshape(groups, 64).T)
    out = np.zeros((bits, groups), dtype=np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[word] |= wide[j] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= wide[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of ``pack_bits``'s bytes."""
    words = np.ascontiguousarray(np.frombuffer(data, dtype="<u8").reshape(-1, bits).T)
    out = np.empty((64, words.shape[1]), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[word + 1] << np.uint64(64 - shift)
        out[j] = value & mask
    return np.ascontiguousarray(out.T).reshape(-1)[:count]


def file_parts(keys: list, lengths: list[int], ids: np.ndarray, bits: int) -> list[bytes]:
    """The bytes of one file."""
    blocks = [pack_bits(ids[i:i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    return [_HEAD.pack(MAGIC, bits, BLOCK_IDS, len(keys), len(ids)),
            np.array([k if k is not None else 0 for k in keys], dtype="<i8").tobytes(),
            np.array(lengths, dtype="<u8").tobytes(),
            np.array([k is None for k in keys], dtype=np.uint8).tobytes(), offsets.tobytes(), *blocks]


def _head(data: bytes) -> tuple[int, int, int, int]:
    magic, bits, block, n_docs, n_ids = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a file of packed token ids")
    return bits, block, n_docs, n_ids


def parse(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(keys, number of ids of each document, all ids) of a file."""
    bits, block, n_docs, n_ids = _head(data)
    at = _HEAD.size
    keys = np.frombuffer(data, "<i8", n_docs, at)
    lengths = np.frombuffer(data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
    null = np.frombuffer(data, np.uint8, n_docs, at + 16 * n_docs)
    n_blocks = -(-n_ids // block)
    at += 17 * n_docs
    offsets = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
    body = memoryview(data)[at + 8 * (n_blocks + 1):]
    ids = unpack_bits(body[:offsets[-1]], bits, n_ids)  # blocks are whole groups, so they unpack as one
    return [None if z else int(k) for k, z in zip(keys, null)], lengths, ids


def read_ids(uri: str, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count - 1`` of a file, reading only their blocks."""
    bits, block, n_docs, n_ids = _head(blobs.read_range(uri, 0, _HEAD.size))
    count = max(0, min(count, n_ids - first))
    if not count:
        return np.zeros(0, np.uint32)
    low, high = first // block, (first + count - 1) // block
    at = _HEAD.size + 17 * n_docs
    ends = np.frombuffer(blobs.read_range(uri, at + 8 * low, 8 * (high - low + 2)), "<u8").astype(np.int64)
    body = at + 8 * (-(-n_ids // block) + 1)
    data = blobs.read_range(uri, body + int(ends[0]), int(ends[-1] - ends[0]))
    return unpack_bits(data, bits, len(data) * 8 // bits)[first - low * block:][:count]


def _written(path: str, end_id: int, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding.encoder(path)
        bits = bits_for(enc.vocab_size)
        task, number = TaskContext.get().partitionId(), 0
        keys: list = []
        lengths: list[int] = []
        ids: list[np.ndarray] = []
        n_ids = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, n_ids
            uri = blobs.write(folder, f"tokens-{task:06d}-{number:04d}", file_parts(keys, lengths, np.concatenate(ids), bits))
            row = pa.RecordBatch.from_pylist([{"task": task, "number": number, "uri": uri, "n_docs": len(keys), "n_ids": n_ids}])
            number, n_ids = number + 1, 0
            for held in (keys, lengths, ids):
                held.clear()
            return row

        for batch in batches:
            for key, found in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                keys.append(key)
                lengths.append(len(found) + 1)
                ids += [found.astype(np.uint16) if bits <= 16 else found, np.array([end_id], np.uint16 if bits <= 16 else np.uint32)]
                n_ids += len(found) + 1
                if n_ids >= FILE_IDS:
                    yield flush()
        if keys:
            yield flush()
    return run


def write(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode documents into files in order of their keys; the table of files, with ``first_id`` of each.

    Columns: task, number (files are in this order), uri, n_docs, n_ids, first_id
    (ids in all files before it).
    """
    spark = docs.sparkSession
    folder = folder or stages.shared_path(spark, "token-files")
    read = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    ordered = read.repartitionByRange("key").sortWithinPartitions("key", "text")
    files = stages.table(ordered.mapInArrow(
        _written(tokenizer_path, end_id, folder), "task long, number long, uri string, n_docs long, n_ids long"), "token-list")
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys, lengths, ids = parse(blobs.read(uri))
            ends = np.cumsum(lengths)
            starts = ends - lengths
            step = max(1, len(keys) // max(1, len(ids) // 1_000_000 + 1))
            for i in range(0, len(keys), step):
                j = min(len(keys), i + step)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[i:j], pa.int64()), pa.array(first + starts[i:j]), pa.array(lengths[i:j]),
                    pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(starts[i:j], ends[i:j])], pa.binary())],
                    names=["key", "start", "n_tokens", "ids"])


def read(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents of the files that ``write`` listed: (key, start, n_tokens, ids as little-endian unsigned 32-bit)."""
    spread = files.select("uri", "first_id").repartition(max(1, files.count()))
    back = spread.mapInArrow(_read_back, "key long, start long, n_tokens long, ids binary")
    return back.withColumnRenamed("key", key)
