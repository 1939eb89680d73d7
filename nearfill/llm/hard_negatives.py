"""Hard-negative mining by an inverted multi-index with certified windows.

Rows are vectors with a label.  Components are made whole numbers, ``floor(scale * x)``; a
row's score for an anchor is their inner product, an exact integer; higher scores come first, ties by
smaller id.  An anchor's positives are its first rows of the same label, itself left out.  A positive's
negatives are the anchor's first rows of other labels whose score lies in the positive's window, from ``low`` to ``high``
percent of its score.  The result is exact.

Method
  * Vectors are cut into two halves, each with a codebook; a row's cell is its pair of codes.  For an anchor
    half q and a code with centre c and radius R (of all its rows), no half scores more than ``q.c + |q| R``.  The sum
    over both halves bounds a cell.
  * A heap over the two sorted lists visits an anchor's cells from the highest bound down.  It goes on in four steps:
    until the cells hold some hundred rows; until the bound falls below the last positive found, which then are
    certified; the negatives of the cells met so far follow; and on until the bound falls below every window's
    last negative found, or its lower end, which certifies the windows.

Scale
  * Codebooks come from at most ``SAMPLE_ROWS`` rows by a hash order; radii, cells and scores cover all rows.
  * Rows with one first code, in blocks of ``ROW_BLOCK``, meet the anchors that visit that code, in blocks of
    ``ANCHOR_BLOCK``; a 64-bit mask tells the second codes.  A hot cell is many blocks, and a block goes only where
    anchors visit its code.  Each pair of blocks leaves each anchor's few best.  Walks are dealt over all tasks.
  * How much the bounds save depends on the data: tight clusters are skipped, unrelated vectors in tens of
    dimensions are nearly all compared.

Defined results: rows with a null id, a null label, a vector that is null or empty, or any null or non-finite component take no part, nor do
vectors of another length than most, or with a component of 2**27 or more after scaling (a score
might not fit 64 bits); of rows with one id the first by (label, vector) counts; an anchor without
positives, and a positive without rows in its window, give no rows; an empty table gives an empty table.  Columns other than id, vector and label are not read.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import stages

CODES = 64
SAMPLE_ROWS = 20_000
ROW_BLOCK = 4096
ANCHOR_BLOCK = 1024
#: The first step walks until an anchor's cells hold this many rows.
FIRST_ROWS = 512
_LIMIT = float(1 << 27)
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Cells:
    """Two codebooks, the radius of each code, and the rows of every cell."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    size: np.ndarray

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """What no half of a code's rows scores above, for both halves, and a margin for rounding."""
        half = self.books[0].shape[1]
        out, margin = [], 1e-6
        for part, book, radius in zip((anchor[:half], anchor[half:]), self.books, self.radii):
            length = math.sqrt(float((part * part).sum()))
            # one anchor at a time, so that each walk of it sees the same numbers
            out.append((book * part).sum(axis=1) + length * radius)
            margin += 1e-9 * length * float(np.sqrt((book * book).sum(axis=1)).max() + radius.max())
        return out[0], out[1], margin


def descend(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) for all pairs of codes, from the largest ``first[i] + second[j]`` down."""
    o1, o2 = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    s1, s2 = first[o1].tolist(), second[o2].tolist()
    heap = [(-(s1[0] + s2[0]), 0, 0)]
    while heap:
        low, i, j = heapq.heappop(heap)
        yield -low, o1[i], o2[j]
        if j + 1 < len(s2):
            heapq.heappush(heap, (-(s1[i] + s2[j + 1]), i, j + 1))
        if not j and i + 1 < len(s1):
            heapq.heappush(heap, (-(s1[i + 1] + s2[0]), i + 1, 0))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _centres(x: np.ndarray, codes: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Centres of the sample's halves: Lloyd steps from distinct rows drawn at random."""
    found = np.unique(x, axis=0)
    found = found[rng.permutation(len(found))[:codes]].copy()
    for _ in range(rounds):
        own = _nearest(x, found)
        for c in np.unique(own).tolist():
            found[c] = x[own == c].mean(axis=0)
    return found


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def _usable(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(_LIMIT))), F.lit(False))


def whole_rows(table: DataFrame, scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, v): the rows that take part, one for each id, components as whole numbers."""
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    read = table.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), scaled.alias("x"))
    whole = F.transform("x", lambda x: F.floor(x).cast("int"))
    return (read.where(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("x")))
            .select("id", F.struct("label", whole.alias("v")).alias("r")).groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v"))


def _codes(n: int) -> int:
    """Codes of a half: a power of two near half the root of the rows, from 8 to ``CODES``."""
    return int(min(CODES, max(8, 1 << max(0, round(math.log2(math.sqrt(max(n, 1)) / 2 + 1e-9))))))


def _coded(books: tuple[np.ndarray, np.ndarray], dim: int):
    half = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            cols = []
            for part, book in zip((x[:, :half], x[:, half:]), books):
                own = _nearest(part, book)
                cols += [pa.array(own.astype(np.int32)), pa.array(np.sqrt(((part - book[own]) ** 2).sum(axis=1)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=["id", "label", "v", "c1", "r1", "c2", "r2"])
    return run


def index(rows: DataFrame, seed: int = 11) -> tuple[Cells, DataFrame, int] | None:
    """The cells of ``rows`` (id, label, v), the rows with their codes as a table, and their vectors' length; None without rows."""
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE_ROWS).select("v").toArrow()["v"].to_pylist()
    if not sample:
        return None
    dim = int(np.bincount([len(v) for v in sample]).argmax())
    x = np.array([v for v in sample if len(v) == dim], dtype=np.float64)
    rng, half, codes = np.random.default_rng(seed), max(1, dim // 2), _codes(total)
    second = _centres(x[:, half:], codes, rng) if dim > 1 else np.zeros((1, 0))
    books = _centres(x[:, :half], codes, rng), second
    coded = stages.table(rows.where(F.size("v") == dim).mapInArrow(
        _coded(books, dim), "id long, label long, v array<int>, c1 int, r1 double, c2 int, r2 double"), "coded")
    # at most CODES * CODES rows reach the driver
    cells = coded.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).toArrow()
    size, radii = np.zeros((len(books[0]), len(books[1])), np.int64), (np.zeros(len(books[0])), np.zeros(len(books[1])))
    c1, c2 = cells["c1"].to_numpy(), cells["c2"].to_numpy()
    size[c1, c2] = cells["n"].to_numpy()
    np.maximum.at(radii[0], c1, cells["r1"].to_numpy())
    np.maximum.at(radii[1], c2, cells["r2"].to_numpy())
    return Cells(books, radii, size), coded.select("id", "label", "v", "c1", "c2"), dim


def _start(cells: Cells, dim: int):
    """The bound at which each anchor's first step ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for q in _matrix(batch.column("v"), dim):
                first, second, _ = cells.bounds(q)
                met, bound = 0, math.inf
                for bound, i, j in descend(first, second):
                    met += int(cells.size[i, j])
                    if met >= FIRST_ROWS:
                        break
                ends.append(bound)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.float64())], names=[*batch.schema.names, "reach"])
    return run


def _probes(cells: Cells, dim: int):
    """For each anchor (with ``lo`` and ``hi``) one row per first code among its cells with bounds in that range; a mask of second codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, code, mask = [], [], []
            lows, highs = batch.column("lo").to_pylist(), batch.column("hi").to_pylist()
            for r, q in enumerate(_matrix(batch.column("v"), dim)):
                first, second, margin = cells.bounds(q)
                masks: dict[int, int] = {}
                for bound, i, j in descend(first, second):
                    if bound < lows[r] - margin:
                        break
                    if bound < highs[r] + margin and cells.size[i, j]:  # a cell at the border may be met twice
                        masks[i] = masks.get(i, 0) | 1 << j
                row += [r] * len(masks)
                code += list(masks)
                mask += list(masks.values())
            kept = batch.select([n for n in batch.schema.names if n not in ("lo", "hi")]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(code, pa.int32()), pa.array(np.array(mask, np.uint64).view(np.int64))],
                                             names=[*kept.schema.names, "c1", "mask"])
    return run


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles where no sum can pass 2**53, else in integers."""
    if not len(anchors) or not len(rows) or np.abs(anchors).max() * np.abs(rows).max() * anchors.shape[1] < 2.0 ** 53:
        return (anchors @ rows.T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(score) > k:
        least = np.partition(score, -k)[-k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _met(dim: int, k: int, low: int, high: int, negatives: bool):
    """Each anchor's k best rows of a block: of its label, or of others in the window of each positive score."""
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and asked.num_rows:
            ids, label = np.asarray(rows["id"]), np.asarray(rows["label"])
            bit = np.uint64(1) << np.asarray(rows["c2"]).astype(np.uint64)
            v, q = _matrix(rows["v"], dim), _matrix(asked["v"], dim)
            mask = np.asarray(asked["mask"]).view(np.uint64)
            own, own_label = asked["id"].to_pylist(), asked["label"].to_pylist()
            windows = asked["scores"].to_pylist() if negatives else None
            for at in range(0, len(q), 256):
                block = scores(q[at:at + 256], v)
                for r in range(len(block)):
                    a = at + r
                    seen = (mask[a] & bit) != 0
                    if not negatives:
                        near = np.flatnonzero(seen & (label == own_label[a]) & (ids != own[a]))
                        best = near[_best(block[r][near], ids[near], k)]
                        out += [(own[a], 0, int(ids[b]), int(block[r][b])) for b in best]
                        continue
                    other = np.flatnonzero(seen & (label != own_label[a]))
                    s = block[r][other]
                    for p in windows[a]:
                        inside = other[(s >= -(-low * p // 100)) & (s <= high * p // 100)]
                        best = inside[_best(block[r][inside], ids[inside], k)]
                        out += [(own[a], p, int(ids[b]), int(block[r][b])) for b in best]
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor", "p", "id", "score"), cols)})
    return run


def _meet(coded: DataFrame, cells: Cells, asked: DataFrame, dim: int, k: int, low: int, high: int, negatives: bool) -> DataFrame:
    """The best rows of the cells that ``asked`` (id, label, v, lo, hi, scores) visits: (anchor, p, id, score)."""
    schema = "id long, label long, v array<int>, " + ("scores array<long>, " if negatives else "") + "c1 int, mask long"
    names = ["id", "label", "v", *(["scores"] if negatives else []), "lo", "hi"]
    tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows, long walks
    probes = stages.table(asked.select(*names).repartition(tasks, "id").mapInArrow(_probes(cells, dim), schema), "probes")
    met = np.zeros(len(cells.size), np.int64)
    for r in probes.groupBy("c1").count().collect():  # at most CODES rows
        met[r["c1"]] = r["count"]
    blocks = lambda n, size: F.lit([max(1, -(-int(x) // size)) for x in n])
    row_blocks, anchor_blocks = blocks(cells.size.sum(axis=1), ROW_BLOCK), blocks(met, ANCHOR_BLOCK)
    part = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.get(n, F.col("c1"))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.get(n, F.col("c1")) - 1))
    visited = coded.where(F.get(F.lit([bool(x) for x in met]), F.col("c1")))
    left = visited.withColumn("rb", part(row_blocks, 1)).withColumn("ab", every(anchor_blocks))
    right = probes.withColumn("ab", part(anchor_blocks, 2)).withColumn("rb", every(row_blocks))
    on = ["c1", "rb", "ab"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(_met(dim, k, low, high, negatives), "anchor long, p long, id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and window."""
    order = Window.partitionBy("anchor", "p").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         key: str = "vec_id") -> DataFrame:
    """Hard negatives of the rows (id, label, v) whose id is in ``anchors``: (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score)."""
    spark = rows.sparkSession
    found = index(stages.table(rows, "whole"))
    if found is None:
        return spark.createDataFrame([], _RESULT)
    cells, coded, dim = found
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = anchors.select(F.col(key).cast("long").alias("id")).distinct()
    start = stages.table(coded.select("id", "label", "v").join(picked, "id", "left_semi").repartition(tasks, "id")
                         .mapInArrow(_start(cells, dim), "id long, label long, v array<int>, reach double"), "anchors")
    infinity = F.lit(math.inf)
    begun = start.withColumns({"lo": F.col("reach"), "hi": infinity})
    near = stages.table(_first(_meet(coded, cells, begun, dim, positives, low, high, False), positives), "near")
    last = near.groupBy(F.col("anchor").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    more = (start.join(last, "id", "left").withColumn(
        "lo", F.when(F.col("n") >= positives, F.col("low").cast("double")).otherwise(-infinity)).withColumn("hi", F.col("reach")))
    more = stages.table(more.select("id", "label", "v", "reach", "lo", "hi"), "more")
    best = stages.table(_first(near.drop("rank").unionByName(_meet(coded, cells, more, dim, positives, low, high, False)), positives), "positives")
    # windows of positives that score below zero are empty
    asked = best.where("score >= 0").groupBy(F.col("anchor").alias("id")).agg(F.collect_set("score").alias("scores"))
    known = stages.table(more.withColumn("reach", F.least("reach", "lo")).select("id", "label", "v", "reach").join(asked, "id"), "known")
    some = stages.table(_first(_meet(coded, cells, known.withColumns({"lo": F.col("reach"), "hi": infinity}), dim, negatives, low, high, True),
                               negatives), "some")
    ends = some.groupBy(F.col("anchor").alias("id"), "p").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    window = (known.select("id", F.explode("scores").alias("p")).join(ends, ["id", "p"], "left")
              .withColumn("end", F.when(F.col("n") >= negatives, F.col("low").cast("double")).otherwise(F.col("p") * (low / 100) - 1))
              .groupBy("id").agg(F.min("end").alias("lo")))
    rest = known.join(window, "id").withColumn("hi", F.col("reach"))
    hard = _first(some.drop("rank").unionByName(_meet(coded, cells, rest, dim, negatives, low, high, True)), negatives)
    return best.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(
        hard.select(F.col("anchor").alias("anchor_id"), F.col("p").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
                    F.col("score").alias("negative_score")), ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
