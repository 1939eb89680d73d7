"""Approximate nearest neighbours by an inverted multi-index, ranked by cosine.

Unit vectors are cut into two halves, each quantised by its own codebook of
``codes`` centroids; a row's cell is its pair of codes.  A query walks the cells in
order of the summed distances of its halves to the centroids, with a heap, until
the cells hold a share of all rows.  Rows of the visited cells are reranked by
the exact cosine of the original vectors, in double precision.

Fitting uses at most ``sample_rows`` rows by a seeded hash order: they train the
codebooks and tell the share of rows to walk for the wanted recall, as measured
by brute force within the sample.  Every row is indexed.

Reranking runs in tiles: rows with one first code, in blocks of ``ROW_BLOCK``,
meet the queries that visit that code, in blocks of ``QUERY_BLOCK``; a 64-bit mask
tells which second codes a query visits.  A cell with very many rows is many
blocks, so no task holds it whole.

Defined results: vectors that are null, empty, zero, hold null or non-finite
components, or have another length than most of the sample take no part, nor do rows with a
null id; rows with one id are one candidate and one query (its first by vector);
ties go to the smaller id; with fewer than ``k`` candidates a query gets all that
it visits, which is every row when there are at most ``k + 1``; an empty table gives
an empty table.  Columns other than id and vector are not read.
"""
from __future__ import annotations

import heapq
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
QUERY_BLOCK = 2048


@dataclass(frozen=True)
class Index:
    """Two codebooks and the share of rows that a query walks."""

    books: tuple[np.ndarray, np.ndarray]
    share: float
    dim: int

    def distances(self, unit: np.ndarray) -> list[np.ndarray]:
        """Squared distances of both halves of unit vectors to the centroids."""
        half = self.books[0].shape[1]
        return [_square_distances(part, book) for part, book in
                zip((unit[:, :half], unit[:, half:]), self.books)]


def _square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def codebook(x: np.ndarray, codes: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centroids of a bounded sample by k-means from a spread start."""
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:codes]].copy()
    for _ in range(rounds):
        own = _square_distances(x, centres).argmin(axis=1)
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def walk(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of codes in order of ``d1[i] + d2[j]``."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    o1, o2 = o1.tolist(), o2.tolist()
    heap = [(s1[0] + s2[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield o1[i], o2[j]
        if j + 1 < len(s2):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if not j and i + 1 < len(s1):
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))


def _share_needed(index: Index, unit: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> float:
    """Share of the sample to walk so that ``recall`` of the exact neighbours of 300 sample rows are met."""
    d1, d2 = index.distances(unit)
    n2 = d2.shape[1]
    cell = d1.argmin(axis=1) * n2 + d2.argmin(axis=1)
    size = np.bincount(cell, minlength=d1.shape[1] * n2)
    queries = rng.permutation(len(unit))[:300]
    needed = []
    for q in queries:
        score = unit @ unit[q]
        score[q] = -np.inf
        near = np.argsort(-score, kind="stable")[:min(k, len(unit) - 1)]
        order = np.argsort((d1[q][:, None] + d2[q][None, :]).ravel(), kind="stable")
        walked = np.empty(len(order))
        walked[order] = np.cumsum(size[order]) / len(unit)
        needed += walked[cell[near]].tolist()
    return float(np.quantile(needed, recall)) if needed else 1.0


def _valid(vector: Column) -> Column:
    number = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & number & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(table: DataFrame, key: str, vector: str) -> DataFrame:
    return (table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & _valid(F.col("v"))))


def fit(table: DataFrame, k: int = 5, recall: float = 0.96, codes: int = CODES, sample_rows: int = SAMPLE_ROWS,
        key: str = "vec_id", vector: str = "embedding", seed: int = 5) -> Index | None:
    """Codebooks and walk share from a bounded sample; None if no row has a usable vector."""
    sample = _rows(table, key, vector).orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample_rows).toArrow()
    if not len(sample):
        return None
    lengths = np.diff(np.asarray(sample["v"].combine_chunks().offsets))
    dim = int(np.bincount(lengths).argmax())
    unit = _unit(np.array([v for v in sample["v"].to_pylist() if len(v) == dim], dtype=np.float64))
    rng, half = np.random.default_rng(seed), max(1, dim // 2)
    second = unit[:, half:] if dim > 1 else np.zeros((len(unit), 1))
    index = Index((codebook(unit[:, :half], codes, rng), codebook(second, codes, rng)), 1.0, dim)
    return Index(index.books, _share_needed(index, unit, k, recall, rng), dim)


def _coded(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = index.distances(_unit(_matrix(batch.column(1), index.dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d1.argmin(axis=1), pa.int32()),
                                              pa.array(d2.argmin(axis=1), pa.int32())], names=["id", "v", "c1", "c2"])
    return run


def _probes(index: Index, size: np.ndarray):
    """For each query one row per first code that it visits, with a mask of the second codes."""
    stop = index.share * size.sum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2 = index.distances(_unit(_matrix(batch.column(1), index.dim)))
            row, code, mask = [], [], []
            for r in range(len(d1)):
                met, masks = 0, {}
                for i, j in walk(d1[r], d2[r]):
                    if size[i, j]:
                        masks[i] = masks.get(i, 0) | 1 << j
                        met += size[i, j]
                        if met >= stop:
                            break
                row += [r] * len(masks)
                code += list(masks)
                mask += list(masks.values())
            picked = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(code, pa.int32()),
                                              pa.array(np.array(mask, dtype=np.uint64).view(np.int64))], names=["q", "qv", "c1", "mask"])
    return run


def cosine(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query, summed in one order for every row, so that equal rows get equal values."""
    return (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _ranked(index: Index, k: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if rows.num_rows and queries.num_rows:
            v, ids, c2 = _matrix(rows["v"].combine_chunks(), index.dim), np.asarray(rows["id"]), np.asarray(rows["c2"])
            qv, q = _matrix(queries["qv"].combine_chunks(), index.dim), np.asarray(queries["q"])
            mask = np.asarray(queries["mask"]).view(np.uint64)
            unit, qunit = _unit(v), _unit(qv)
            bit = np.uint64(1) << c2.astype(np.uint64)
            for at in range(0, len(q), 256):
                score = qunit[at:at + 256] @ unit.T
                for r in range(len(score)):
                    s = np.where(((mask[at + r] & bit) != 0) & (ids != q[at + r]), score[r], -np.inf)
                    least = np.partition(s, -k)[-k] if len(s) > k else -np.inf
                    near = np.flatnonzero((s >= least - 1e-9) & (s > -np.inf))
                    exact = cosine(v[near], qv[at + r])
                    best = np.lexsort((ids[near], -exact))[:k]
                    out.append((np.full(len(best), q[at + r]), ids[near][best], exact[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))
    return run


def search(table: DataFrame, queries: DataFrame, index: Index | None, k: int = 5, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """The nearest rows found for each query: (query_id, rank from 1, vec_id, score)."""
    spark = table.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fits = F.size("v") == index.dim
    schema = "id long, v array<double>, c1 int, c2 int"
    rows = stages.table(_rows(table, key, vector).where(fits).mapInArrow(_coded(index), schema), "vectors")
    counted = rows.groupBy("c1", "c2").count().toArrow()  # codes * codes rows at most
    size = np.zeros((len(index.books[0]), len(index.books[1])), dtype=np.int64)
    size[counted["c1"].to_numpy(), counted["c2"].to_numpy()] = counted["count"].to_numpy()
    if size.sum() <= k + 1:
        index = Index(index.books, 1.0, index.dim)
    one = Window.partitionBy("id").orderBy("v")
    asked = (_rows(queries, key, vector).where(fits).withColumn("place", F.row_number().over(one)).where("place = 1")
             .select("id", "v").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")  # walks are dealt over all tasks
             .mapInArrow(_probes(index, size), "q long, qv array<double>, c1 int, mask long"))
    asked = stages.table(asked, "probes")
    query_blocks = -(-asked.select("q").distinct().count() // QUERY_BLOCK) or 1
    blocks = F.lit([-(-int(n) // ROW_BLOCK) for n in size.sum(axis=1)])  # of each first code
    left = (rows.withColumn("rb", F.pmod(F.xxhash64("id"), F.get(blocks, F.col("c1"))).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (asked.withColumn("rb", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("c1")) - 1)))
             .withColumn("qb", F.pmod(F.xxhash64("q", F.lit(1)), F.lit(query_blocks)).cast("int")))
    found = (left.groupBy("c1", "rb", "qb").cogroup(right.groupBy("c1", "rb", "qb"))
             .applyInArrow(_ranked(index, k), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
