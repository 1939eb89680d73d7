"""Substring dedup by level-wise doubling: words of windows that stand somewhere earlier go.

A text's words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A window is ``window`` consecutive
words of one document.  A word goes if some window over it also starts earlier: in a document with a smaller
key, or before it in the same document.  Windows are judged on the input, not on what is left.

Method
  * Levels are word lengths that double up to the window (5, 10, 20).  At each level a window is
    told by one gram of that length: of the grams inside it the one with the least
    hash, the leftmost of equals.  Equal windows choose equal grams, so a window whose gram stands at one place alone
    cannot repeat and goes; what repeats is extended to twice the length, until no candidate is left.
    Neighbouring windows mostly choose the same gram and are one row, a run.
  * At the last level a run of surviving windows is named by the 128-bit hash of its bytes, words joined by one
    space, and so is every window in it.  Equal runs collapse into their first place.  All windows of a later
    copy of a run repeat; the windows of distinct runs with the same gram are compared one by one.

Scale
  * Levels shuffle (hash, document, place, length) of runs, about an eighth of the words; counts are
    pre-aggregated and joined back, so a phrase that very many documents hold is no hot task.  No pairs of
    documents or copies are made.
  * Texts are read once a level, by a join with the runs that survived, and once to take words out.

Hashes of the lower levels only choose candidates: a collision keeps a window longer.  What is removed rests on
128-bit hashes of whole windows.

Defined results: a null or empty text, or one of fewer words than a window, keeps all of its words; a
null key comes after all others; rows equal in key and text are one document, each with
its result; rows of one key with different texts are documents of their own, in the order of a hash of the text; an empty table
gives an empty table.  Columns other than key and text are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stages, textbytes

#: The shortest level has at least this many words.
LEAST = 4
_RUN = pa.struct([("a", pa.int32()), ("w", pa.int32())])
_PLACE = ["nokey", "key", "h"]


def levels(window: int) -> list[int]:
    """Lengths below the window, shortest first, each about half of the next."""
    out, length = [], window
    while -(-length // 2) >= LEAST:
        length = -(-length // 2)
        out.append(length)
    return out[::-1]


def least_grams(grams: np.ndarray, span: int) -> np.ndarray:
    """For each place the leftmost least of the ``span`` grams from it on (as many places as there are whole spans)."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    value, at, width = grams, np.arange(len(grams)), 1

    def joined(step: int) -> tuple[np.ndarray, np.ndarray]:
        right = value[step:] < value[:-step]
        return np.where(right, value[step:], value[:-step]), np.where(right, at[step:], at[:-step])

    while 2 * width <= span:
        value, at = joined(width)
        width *= 2
    if width < span:
        value, at = joined(span - width)
    return at[:n]


def _alive(runs: pa.Array, first: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places are in the runs of their texts (a list of (a, w) for each text)."""
    mark = np.zeros(n + 1, np.int64)
    owner = np.repeat(first[:-1], np.diff(np.asarray(runs.offsets)))
    flat = runs.flatten()
    a = owner + np.asarray(flat.field("a"))
    np.add.at(mark, a, 1)
    np.add.at(mark, a + np.asarray(flat.field("w")), -1)
    return np.cumsum(mark[:-1]) > 0


def _runs(t: textbytes.Texts, runs: pa.Array | None, length: int, window: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of surviving windows with one least gram: (gram hash, text, first window, windows), and the texts' first words."""
    w = textbytes.words(t)
    n = len(w.start)
    none = np.zeros(0, np.int64)
    if n < window:
        return none.astype(np.uint64), none, none, none, w.first
    grams = textbytes.grams(textbytes.Spans(t.buf).hash(w.start, w.end), length)
    at = least_grams(grams, window - length + 1)
    owner = w.owner
    alive = owner[:len(at)] == owner[window - 1:]
    if runs is not None:
        alive &= _alive(runs, w.first, n)[:len(at)]
    place = np.flatnonzero(alive)
    if not len(place):
        return none.astype(np.uint64), none, none, none, w.first
    cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(at[place]) != 0) | (np.diff(owner[place]) != 0)) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]])
    first = place[starts]
    return grams[at[first]], owner[first], first - w.first[owner[first]], ends - starts, w.first


def _slices(batch: pa.RecordBatch, text: str, runs: str | None) -> Iterator[tuple[textbytes.Texts, pa.Array | None]]:
    for t in textbytes.slices(batch.column(text)):
        yield t, batch.column(runs).slice(t.first, t.count) if runs else None


def _level(length: int, window: int, known: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, runs in _slices(batch, "text", "runs" if known else None):
                g, own, a, w, _ = _runs(t, runs, length, window)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), batch.column("h").take(pa.array(own + t.first)),
                                                  pa.array(a.astype(np.int32)), pa.array(w.astype(np.int32))], names=["g", "h", "a", "w"])
    return run


def _named(length: int, window: int, known: bool):
    """Runs of the last level: their gram, their name, their place and the names of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for t, runs in _slices(batch, "text", "runs" if known else None):
                g, own, a, w, _ = _runs(t, runs, length, window)
                names, each = [], []
                text, starts, ends, last = memoryview(b""), [], [], -1
                for i, s, n in zip(own.tolist(), a.tolist(), w.tolist()):
                    if i != last:
                        parts = t.raw(i).split()
                        size = np.fromiter(map(len, parts), np.int64, len(parts))
                        end = np.cumsum(size + 1) - 1
                        text, starts, ends, last = memoryview(b" ".join(parts)), (end - size).tolist(), end.tolist(), i
                    names.append(digest(text[starts[s]:ends[s + n + window - 2]]))
                    each.append(b"".join([digest(text[starts[x]:ends[x + window - 1]]) for x in range(s, s + n)]))
                name = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                rows = pa.array(own + t.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.view(np.int64)), pa.array(name[:, 0]), pa.array(name[:, 1]), *[batch.column(c).take(rows) for c in _PLACE],
                     pa.array(a.astype(np.int32)), pa.array(w.astype(np.int32)), pa.array(each, pa.binary())],
                    names=["g", "c1", "c2", *_PLACE, "a", "w", "names"])
    return run


def _split_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of a run: its name and place."""
    for batch in batches:
        names = batch.column("names")
        flat = np.frombuffer(b"".join(names.to_pylist()), np.int64).reshape(-1, 2)
        n = np.asarray(batch.column("w")).astype(np.int64)
        rows = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        at = np.asarray(batch.column("a"))[rows] + offset
        yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1]), *[batch.column(c).take(pa.array(rows)) for c in _PLACE],
                                          pa.array(at.astype(np.int32))], names=["c1", "c2", *_PLACE, "a"])


def _read(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(nokey, key, h, text): h tells texts of one key apart and stands for both in the lower levels."""
    return (docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .select(F.col("id").isNull().alias("nokey"), F.coalesce("id", F.lit(0)).cast("long").alias("key"),
                    F.xxhash64("id", "text").alias("h"), "text"))


def _repeated(runs: DataFrame) -> DataFrame:
    """Runs whose gram stands at two places or more."""
    often = runs.groupBy("g").agg(F.min("h").alias("h0"), F.max("h").alias("h1"), F.min("a").alias("a0"), F.max("a").alias("a1")).where(
        "h0 <> h1 or a0 <> a1").select("g")
    return _among(runs, often, "often")


def _among(rows: DataFrame, grams: DataFrame, name: str) -> DataFrame:
    """Rows with one of the grams, which are a table of their own: adaptive execution then splits the rows of a hot gram."""
    return rows.join(stages.table(grams, name), "g", "left_semi")


def _place() -> Column:
    return F.struct(*_PLACE, "a")


def spans(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of words to take out: (nokey, key, h, a, e), words ``a`` to ``e - 1`` of a document."""
    read = _read(docs, key, text)
    joined, left, steps = read, None, levels(window)
    for length in steps:
        thin = joined.drop("nokey", "key")
        runs = stages.table(thin.mapInArrow(_level(length, window, left is not None), "g long, h long, a int, w int"), "runs")
        # equal rows of a table give equal runs: one set for each document
        alive = stages.table(_repeated(runs).groupBy("h").agg(F.collect_set(F.struct("a", "w")).alias("runs")), "alive")
        stages.discard(runs)
        if left is not None:
            stages.discard(left)
        left, joined = alive, read.join(alive, "h")
        if alive.isEmpty():
            break
    last = stages.table(joined.mapInArrow(_named(steps[-1] if steps else 1, window, left is not None),
                        "g long, c1 long, c2 long, nokey boolean, key long, h long, a int, w int, names binary"), "named")
    if left is not None:
        stages.discard(left)
    distinct = stages.table(last.groupBy("c1", "c2").agg(F.min(F.struct(*_PLACE, "a", "g", "w", "names")).alias("f"))
                            .select("c1", "c2", "f.*"), "distinct")
    later = _not_first(last.select("c1", "c2", *_PLACE, "a", "w"), distinct.select("c1", "c2", *_PLACE, "a"))
    several = distinct.groupBy("g").count().where("count > 1").select("g")
    windows = stages.table(_among(distinct, several, "several").select(*_PLACE, "a", "w", "names")
                           .mapInArrow(_split_names, "c1 long, c2 long, nokey boolean, key long, h long, a int"), "windows")
    first = windows.groupBy("c1", "c2").agg(F.min(_place()).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2", "f.*")
    out = stages.table(later.select(*_PLACE, "a", (F.col("a") + F.col("w") + window - 1).alias("e"))
                       .unionByName(_not_first(windows, first).select(*_PLACE, "a", (F.col("a") + window).alias("e"))), "spans")
    for t in (last, distinct, windows):
        stages.discard(t)
    return out


def _not_first(rows: DataFrame, first: DataFrame) -> DataFrame:
    """Rows that are not at their name's first place."""
    names = [*_PLACE, "a"]
    f = first.select("c1", "c2", *[F.col(c).alias(f"f_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        same = same & (F.col(c) == F.col(f"f_{c}"))
    return rows.join(f, ["c1", "c2"]).where(~same).select(*rows.columns)


def _cut(report: bool):
    """Texts without the words of their spans: the words left, joined by one space, or figures of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, left = [], [], []
            for text, cuts in zip(batch.column("text"), batch.column("cuts")):
                words = text.as_py().encode().split()
                total.append(len(words))
                if cuts.is_valid:
                    keep = np.ones(len(words), dtype=bool)
                    for cut in cuts.as_py():
                        keep[cut["a"]:cut["e"]] = False
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                kept = b" ".join(words)
                gone.append(total[-1] - len(words))
                left.append(hashlib.sha256(kept).hexdigest() if report else kept.decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.string())],
                                             names=["id", "n_words", "n_removed", "kept"])
    return run


def _cleaned(docs: DataFrame, window: int, key: str, text: str, report: bool) -> DataFrame:
    cuts = spans(docs, window, key, text).groupBy(*_PLACE).agg(F.collect_set(F.struct("a", "e")).alias("cuts"))
    return (_read(docs, key, text).join(cuts, _PLACE, "left").select(F.when(~F.col("nokey"), F.col("key")).alias("id"), "text", "cuts")
            .mapInArrow(_cut(report), "id long, n_words long, n_removed long, kept string"))


def clean(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, text): every document with the words that are left, joined by one space."""
    return _cleaned(docs, window, key, text, False).toDF(key, "n_words", "n_removed", text)


def report(docs: DataFrame, window: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every document."""
    return _cleaned(docs, window, key, text, True).toDF(key, "n_words", "n_removed", "kept_sha256")
