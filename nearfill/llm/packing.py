"""Best-fit decreasing packing of token sequences, without a shuffle.

A document is its token ids and an end id.  Documents longer than the capacity
are cut into full windows, which need no search; what is left of each goes,
longest first, into the open window with the least room that still holds it.  A
segment tree over the room left (0 to capacity) finds that window.  Each task
packs its own documents, in groups of ``GROUP_IDS`` ids (some thousands of
windows), so that memory is bounded and no group is spread over tasks; sequence
ids are unique over all tasks.  Partitions of little text are merged first, or the windows that
each task leaves open at its end would be most of what it packs.

Defined results: a null or empty text is its end id alone; repeated rows are
packed as documents of their own; an empty table gives an empty table; the key
may be null.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encoding

CAPACITY = 2048
#: Ids that a task holds before it packs them.
GROUP_IDS = 3_000_000
#: Bytes of text that a task gets at least, about; smaller partitions are merged, so that open windows fill up.
TASK_BYTES = 8 << 20
_TASK_BITS = 40


class OpenWindows:
    """Windows by room left, in a segment tree of counts."""

    def __init__(self, capacity: int):
        self.size = 1 << int(capacity).bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._change(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (window, room) with the least room of at least ``length``."""
        node = length + self.size
        if not self.count[node]:
            while node & 1 or not self.count[node + 1]:  # up to the first ancestor with something to its right
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._change(room, -1)
        return self.windows[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each piece; windows count from 0.  Lengths are 1 to capacity."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_windows, made = OpenWindows(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = open_windows.take(length)
        if found is None:
            found, made = (made, capacity), made + 1
        window[i], offset[i] = found[0], capacity - found[1]
        if found[1] > length:
            open_windows.add(found[0], found[1] - length)
    return window, offset


_SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _packed(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding.encoder(path)
        first = TaskContext.get().partitionId() << _TASK_BITS
        keys: list = []
        start, ids, total, n_ids = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, n_ids
            lengths = np.array([len(x) for x in ids], dtype=np.int64)
            window, offset = best_fit_decreasing(lengths, capacity)
            cols = [start, lengths, [x.astype("<u4").tobytes() for x in ids], total, window + first, offset]
            first += int(window.max()) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type)] + [pa.array(c, t) for c, t in zip(cols, _TYPES)], names=names)
            for held in (keys, start, ids, total):
                held.clear()
            n_ids = 0

        for batch in batches:
            key_type, names = batch.schema.field(0).type, [batch.schema.field(0).name, *_NAMES]
            for key, found in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                found = np.append(found, np.uint32(end_id))
                for at in range(0, len(found), capacity):
                    keys.append(key)
                    start.append(at)
                    ids.append(found[at:at + capacity])
                    total.append(len(found))
                n_ids += len(found)
                if n_ids >= GROUP_IDS:
                    yield from flush()
        if keys:
            yield from flush()
    return run


_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: (key, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers;
    the pieces of a sequence follow each other by ``offset``, without a gap.
    """
    read = docs.select(F.col(key), F.col(text).cast("string").alias("__text"))
    kind = read.schema[0].dataType.simpleString()
    total = read.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    tasks = max(1, total // TASK_BYTES)
    if read.rdd.getNumPartitions() > tasks:
        read = read.coalesce(tasks)
    return read.mapInArrow(_packed(tokenizer_path, end_id, capacity), f"`{key}` {kind}, {_SCHEMA}")
