"""Exact top-k nearest-neighbour join and neighbour votes (NN-01..NN-04).

References are partitioned into Voronoi cells around ``P`` pivots (a seeded
hash sample of the references; P grows with sqrt(n) up to ``MAX_PIVOTS``), and the
triangle inequality limits the cells each query visits:

1. every reference gets its nearest pivot (``cell``) and radius; per
   (group, cell) the count and min / max radius are kept (a small table).  Neighbouring
   cells of a group make up *blocks* of about ``block_rows`` references;
2. **home phase** -- every query meets the block of its own nearest
   pivot's cell; the top k there are real neighbours, so the k-th distance
   ``theta`` bounds the final k-th distance (a query whose home block holds
   fewer than k references gets ``theta = inf``);
3. **expansion phase** -- the query visits only the cells of other blocks whose lower
   bound ``max(d(q,p_c) - rmax_c, (d(q,p_c) - d(q,p_home)) / 2,
   rmin_c - d(q,p_c), 0)`` does not exceed ``theta``;
4. both phases' candidates are ranked per query by ``(distance, ref id)``.

How much this prunes depends on the data: with a few features most cells are
skipped, with many unrelated ones (tens of dimensions) hardly any, and the
join then compares nearly all pairs of a group.  The result is exact either way.

A query goes once to each block that it visits, with a bit mask of its cells, so the copies of a row
are as many as the blocks it visits, however large the tables are.  A block of a hot cell, or
one that very many queries visit, is dealt over several tasks, and only each query's k best leave a task.

In a task the references of a cell are cut into small boxes (few features) and a query meets the nearest
box first, then those within its k-th distance so far.  Before exact distances comes a bound: for Euclidean and cosine distance
one matrix product gives all distances up to rounding; Minkowski distance of p from 2 to 4 is at least a share of the Euclidean one; for the
others features as 16-bit numbers of equal steps give them up to the steps, or else sums in single precision do.  With many features runs of
references over cells come before that: for Chebyshev distance bitmaps of the references below and above some levels of each feature, for Manhattan
distance a matrix product that is the sum over the features in which two rows lie in different cells.  Only pairs that the
bound leaves within ``theta`` and the block's k best are added up feature by feature, and no more than a few times
k pairs a query are held.  Cosine distance is ranked through unit vectors, computed once.

Rows are told apart by numbers that are written down once (``steps.numbered``),
never by the caller's ids: ids may repeat or be NULL, on both sides, and every
query row keeps its own neighbours.  The result is a table in the shared folder,
after which the working tables are released.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.columns import METRICS
from . import steps

MAX_PIVOTS = 1024
# Cell statistics (groups x pivots) stay below this many rows: more groups have fewer pivots.
MAX_CELLS = 100_000
#: Cells of a block: the bits of a mask.
MASK_CELLS = 64
#: References of a block, and queries that meet it in one task.
BLOCK_ROWS = (2048, 32_768)
#: Neighbours that the queries of one task keep.
TASK_NEIGHBORS = 1_000_000
#: Partitions of the block pairs at most.
MAX_TASKS = 2000
#: Up to so many features, boxes inside a cell are worth their bounds.
BOX_FEATURES = 8
BOX_ROWS = 256
#: Levels of a feature in the bitmaps, and cells of a feature in the matrix product.
LEVELS, FEATURE_CELLS = 32, 4
#: References of the first and the largest run, and query rows that meet a run and its bitmaps at a time.
RUN_ROWS, WIDE_ROWS = (1024, 16_384), (512, 128)
#: Shares of the pairs beyond which bitmaps and matrix products are given up.
WIDE_SHARES = (0.05, 0.25)
#: Pairs whose exact distances are added up at a time.
PAIR_ROWS = 8192
#: Query rows whose distances to all pivots are held at a time.
VISIT_ROWS = 1024
#: Rows of a box that asks the pivots together; of fewer pivots than that, all are asked.
PIVOT_BOX = 128
#: Neighbours that one task sorts or adds up, about; partitions of fewer than the second are not worth a task.
SORTED_NEIGHBORS = (500_000, 20_000)


def _pivot_count(n_refs: int) -> int:
    """About 2 sqrt(n), but cells of some hundred references at least: smaller ones cost more than they save."""
    return max(1, min(MAX_PIVOTS, int(2 * math.sqrt(max(n_refs, 1))), n_refs // 128))


def _dealt(df: DataFrame, by: str, rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows in partitions by ``by`` whose size does not grow with the table."""
    most, least = SORTED_NEIGHBORS
    return df.repartition(max(1, -(-rows // most), min(df.sparkSession.sparkContext.defaultParallelism, rows // least)), by)


def _unit(cols: Sequence[str]) -> list[Column]:
    norm = "sqrt(" + " + ".join(f"`{c}` * `{c}`" for c in cols) + ")"
    return [F.expr(f"CASE WHEN _norm = 0 THEN 0.0D ELSE `{c}` / _norm END") for c in cols], F.expr(norm)


def _sums(a: np.ndarray, b: np.ndarray, metric: str, p: float, kind: type = np.float64) -> np.ndarray:
    """Distances of all rows of ``b`` (down) to all of ``a`` before the root, in tiles that stay in the processor's cache."""
    at, bt = np.ascontiguousarray(a.T, dtype=kind), np.ascontiguousarray(b.T, dtype=kind)
    out = np.zeros((len(b), len(a)), dtype=kind)
    for i in range(0, len(b), 64):
        for j in range(0, len(a), 2048):
            total = out[i:i + 64, j:j + 2048]
            diff, work = np.empty(total.shape, kind), np.empty(total.shape, kind)
            for x, y in zip(at, bt):
                np.subtract(x[None, j:j + 2048], y[i:i + 64, None], out=diff)
                if metric == "euclidean":
                    np.multiply(diff, diff, out=diff)
                else:
                    np.abs(diff, out=diff)
                if metric == "minkowski" and p == 3:
                    np.multiply(diff, diff, out=work)
                    np.multiply(work, diff, out=diff)
                elif metric == "minkowski":
                    np.power(diff, p, out=diff)
                (np.maximum if metric == "chebyshev" else np.add)(total, diff, out=total)
    return out


def _stepped(q: np.ndarray, r: np.ndarray, metric: str) -> tuple[np.ndarray, float, float] | None:
    """Manhattan or Chebyshev distances of all rows of ``r`` (down) to all of ``q`` as 16-bit numbers of steps, the step, and
    how many steps they may be off; None where such numbers would be too coarse."""
    d = q.shape[1]
    least, most = min(q.min(), r.min()), max(q.max(), r.max())
    steps_wide = 32_767 // (d if metric == "manhattan" else 1)
    if not 1e-200 < most - least < 1e200 or steps_wide < 64 or max(abs(least), abs(most)) > 1e6 * (most - least):
        return None
    step = (most - least) / steps_wide
    a, b = (np.ascontiguousarray(np.minimum(np.rint((x - least) / step), steps_wide).astype(np.int16).T) for x in (q, r))
    out = np.zeros((len(r), len(q)), np.int16)
    for i in range(0, len(r), 64):
        for j in range(0, len(q), 2048):
            total = out[i:i + 64, j:j + 2048]
            diff = np.empty(total.shape, np.int16)
            for x, y in zip(a, b):
                np.subtract(x[None, j:j + 2048], y[i:i + 64, None], out=diff)
                np.abs(diff, out=diff)
                (np.maximum if metric == "chebyshev" else np.add)(total, diff, out=total)
    return out, step, 1.001 * (d if metric == "manhattan" else 1) + 1


def _few_pairs(q: np.ndarray, r: np.ndarray, out: np.ndarray | None, theta: np.ndarray, k: int, metric: str, p: float
               ) -> tuple[np.ndarray, np.ndarray] | None:
    """(references, queries) of pairs that cheap bounds leave within ``theta`` and each query's k nearest; None if they are many."""
    share = 0.05
    if metric == "minkowski":
        share = 0.25
        if not 2 <= p <= 4 or not np.isfinite(theta).all():
            return None
        qq, rr = (q * q).sum(axis=1), (r * r).sum(axis=1)
        bound = r @ q.T  # becomes the squared Euclidean distance, of which a share is a lower bound
        bound *= -2.0
        bound += qq[None, :]
        bound += rr[:, None]
        reach = theta * (1 + 1e-9) / q.shape[1] ** (1.0 / p - 0.5)
        near = bound <= reach * reach + 1e-11 * (qq + rr.max()) + 1e-300
    else:
        found = _stepped(q, r, metric)
        if found is None:
            return None
        bound, step, off = found
        if out is not None:
            bound[out] = 32_767
        reach = np.minimum(theta / step * (1 + 1e-9) + off, 32_767).astype(np.int16)
        near = bound <= reach
        if len(r) > k and np.count_nonzero(near) > 2 * k * len(q):
            kth = np.partition(bound, k - 1, axis=0)[k - 1]
            near = bound <= np.minimum(reach, np.minimum(kth + 2 * off, 32_767).astype(np.int16))
    if out is not None:
        near &= ~out
    if np.count_nonzero(near) > share * near.size + 2 * k * len(q):
        return None
    j, i = np.nonzero(near)
    if metric == "minkowski":  # what is left, by sums of their own
        top = max(np.abs(q).max(), np.abs(r).max())
        kind = np.float32 if 1e-4 < top < 1e6 else np.float64
        eps, d = float(np.finfo(kind).eps), q.shape[1]
        reach = ((theta * (1 + 1e-9) + 4 * eps * top * d ** (1.0 / p)) * (1 + 4 * eps * (d + 8))) ** p
        a, b, keep = q.astype(kind), r.astype(kind), np.zeros(len(i), bool)
        for at in range(0, len(i), 2048):
            one, two = i[at:at + 2048], j[at:at + 2048]
            diff = np.abs(a[one] - b[two])
            keep[at:at + 2048] = (diff * diff * diff if p == 3 else np.power(diff, p)).sum(axis=1) <= reach[one]
        i, j = i[keep], j[keep]
    return j, i


def _windows(r: np.ndarray, k: int):
    """For query rows and their thetas, (queries, references) of all pairs that can differ by theta at most in every feature, None if
    they are many: bitmaps of the references below the first level above a window, and not below the last one under it."""
    n, d = r.shape
    some = np.sort(r[::max(1, n // 4096)], axis=0)
    cuts = np.ascontiguousarray(some[np.arange(1, LEVELS) * len(some) // LEVELS].T)
    below = np.empty((d, LEVELS + 1, -(-n // 64) * 8), np.uint8)
    level = np.full(below.shape[2] * 8, LEVELS, np.uint8)  # what fills up the last word is below no level
    for j in range(d):
        level[:n] = np.searchsorted(cuts[j], r[:, j], side="right")
        below[j] = np.packbits(level < np.arange(LEVELS + 1, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    below = below.view("<u8")
    above = ~below

    def near(q: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        reach = theta[:, None] * (1 + 1e-9) + 1e-15 * np.abs(q)
        first, last = (np.stack([np.searchsorted(c, x, side="right") for c, x in zip(cuts, w.T)]) for w in (q - reach, q + reach))
        found = []
        for at in range(0, len(q), WIDE_ROWS[1]):
            lo, hi = first[:, at:at + WIDE_ROWS[1]], last[:, at:at + WIDE_ROWS[1]] + 1
            both = np.take(below[0], hi[0], axis=0)
            work = np.empty_like(both)
            for j in range(d):
                for side, place in ((below, hi), (above, lo)):
                    np.take(side[j], place[j], axis=0, out=work, mode="clip")
                    np.bitwise_and(both, work, out=both)
            i, word = np.nonzero(both)
            if np.bitwise_count(both[i, word]).sum() > WIDE_SHARES[0] * n * len(both) + 2 * k * len(both):
                return None
            one, bit = np.nonzero(np.unpackbits(both[i, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            found.append((at + i[one], 64 * word[one] + bit))
        return tuple(np.concatenate(f) for f in zip(*found))

    return near


def _cells_apart(r: np.ndarray, k: int):
    """For query rows and their thetas, (queries, references) of all pairs whose Manhattan distance can be theta at most, None if they are many.

    The distance is at least its sum over the features in which the two lie in different cells.  For a and b in cells 0, 1.. of a feature that is
    a [cell a > 0] + b [cell b > 0], less b [cell a >= l] [cell b is l - 1 or l] and a [cell b >= l] [cell a is l - 1 or l] for every l > 0: a matrix product.
    """
    n, d = r.shape
    some = np.sort(r[::max(1, n // 4096)], axis=0)
    cuts = some[np.arange(1, FEATURE_CELLS) * len(some) // FEATURE_CELLS]
    middle, eps, largest = cuts[len(cuts) // 2], float(np.finfo(np.float32).eps), np.abs(r).max()
    off = 3 * (2 * d * FEATURE_CELLS + 16) * eps  # rounding, as a share of the values added up

    def sides(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values by cells, marks of cells, and what a row adds by itself less what rounding can make of it."""
        cell, x = (x[:, None] >= cuts).sum(axis=1), x - middle
        values = np.hstack([np.where((cell == c) | (cell == c - 1), -x, 0.0) for c in range(1, FEATURE_CELLS)])
        marks = np.hstack([cell >= c for c in range(1, FEATURE_CELLS)])
        own = np.where(cell > 0, x, 0.0).sum(axis=1) - off * np.abs(x).sum(axis=1)
        return values.astype(np.float32), marks.astype(np.float32), own[:, None].astype(np.float32)

    values, marks, own = sides(r)
    right, single = np.hstack([values, marks, own, np.ones_like(own)]), r.astype(np.float32)
    ones = np.ones(d, np.float32)

    def near(q: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        values, marks, own = sides(q)
        left, narrow, top = np.hstack([marks, values, np.ones_like(own), own]).T, q.astype(np.float32), max(np.abs(q).max(), largest)
        limit = np.nextafter((theta * (1 + 1e-9) + 1e-15 * d * top).astype(np.float32), np.float32(np.inf))
        reach, found = (theta * (1 + 1e-9) + 4 * eps * top * d) * (1 + 4 * eps * (d + 8)), []
        work = np.empty((min(n, RUN_ROWS[0]), len(q)), np.float32)
        for at in range(0, n, RUN_ROWS[0]):
            part = right[at:at + RUN_ROWS[0]]
            part = np.matmul(part, left, out=work[:len(part)]) <= limit
            if np.count_nonzero(part) > WIDE_SHARES[1] * part.size + 2 * k * len(q):
                return None
            j, i = divmod(np.flatnonzero(part), len(q))
            for one in range(0, len(i), 2048):  # what is left, by sums in single precision
                a, b = i[one:one + 2048], at + j[one:one + 2048]
                diff = narrow.take(a, axis=0)
                np.subtract(diff, single.take(b, axis=0), out=diff)
                keep = np.abs(diff, out=diff) @ ones <= reach[a]
                found.append((a[keep], b[keep]))
        return tuple(np.concatenate(f) for f in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    return near


def _np_dist(x: np.ndarray, piv: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Distances of rows to pivots."""
    out = _sums(x, piv, metric, p).T
    if metric == "euclidean":
        return np.sqrt(out)
    return np.power(out, 1.0 / p) if metric == "minkowski" else out


def _assign_udf(pivots: np.ndarray, metric: str, p: float):
    """Nearest pivot and its distance for every row (numpy in Arrow batches)."""
    schema = "cell int, rad double"

    @F.pandas_udf(schema)
    def _assign(x: pd.DataFrame) -> pd.DataFrame:
        xs = x.to_numpy(dtype=float)
        cell, rad = np.empty(len(xs), "int32"), np.empty(len(xs))
        for rows, some in _pivots_near(xs, pivots, metric, p):
            d = _np_dist(xs[rows], pivots[some], metric, p)
            at = d.argmin(1)
            cell[rows], rad[rows] = some[at], d[np.arange(len(rows)), at]
        return pd.DataFrame({"cell": cell, "rad": rad})

    return _assign.asNondeterministic()  # evaluated once, never duplicated by projection collapse


def _boxes(x: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """``rows`` of ``x`` cut at medians of the widest feature into neighbouring runs of at most ``size``."""
    todo, out = [rows], []
    while todo:
        some = todo.pop()
        if len(some) <= size:
            out.append(some)
            continue
        part, half = x[some], len(some) // 2
        by = np.argpartition(part[:, np.ptp(part, axis=0).argmax()], half)
        todo += [some[by[half:]], some[by[:half]]]
    return out


def _pivots_near(x: np.ndarray, pivots: np.ndarray, metric: str, p: float, theta: np.ndarray | None = None, rmax: np.ndarray | None = None):
    """Runs of rows of ``x`` with the numbers of the pivots to ask: all that can be nearest to one of the rows and, with ``theta``,
    all whose cell of radius ``rmax`` can reach within it.  Few features bound whole boxes of rows; many leave all pivots."""
    if x.shape[1] > BOX_FEATURES or len(pivots) < PIVOT_BOX:
        for at in range(0, len(x), VISIT_ROWS):
            yield np.arange(at, min(at + VISIT_ROWS, len(x))), np.arange(len(pivots))
        return
    boxes = _boxes(x, np.arange(len(x)), PIVOT_BOX) if len(x) else []
    for at in range(0, len(boxes), 128):
        units = boxes[at:at + 128]
        lo, hi = (np.array([f(x[u], axis=0) for u in units]) for f in (np.min, np.max))
        low = _box_bounds(pivots, lo, hi, metric, p)
        ask = low <= _box_reach(pivots, lo, hi, metric, p).min(axis=0) * (1 + 1e-9) + 1e-12
        if theta is not None:
            ask |= low - rmax[:, None] <= np.array([theta[u].max() for u in units]) + 1e-9 * (low + rmax[:, None]) + 1e-12
        ask[:, ~ask.any(axis=0)] = True  # distances that are no numbers
        for rows, some in zip(units, ask.T):
            yield rows, np.flatnonzero(some)


def _runs(n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of every cell and its place there: runs of cells of about ``size`` rows, of ``MASK_CELLS`` cells at most."""
    run, place = np.zeros(len(n), int), np.zeros(len(n), int)
    at = cells = held = 0
    for c, rows in enumerate(n.tolist()):
        if cells == MASK_CELLS or (held >= size / 2 and held + rows > 1.25 * size):
            at, cells, held = at + 1, 0, 0
        run[c], place[c] = at, cells
        cells, held = cells + 1, held + rows
    before = int((run == at - 1).sum())
    if at and held < size / 2 and before + cells <= MASK_CELLS:  # a short last run
        place[run == at] += before
        run[run == at] = at - 1
    return run, place


def _visits(pivots: np.ndarray, metric: str, p: float, groups: list, group_of: np.ndarray, qs: list[str], columns: list[str]):
    """Rows of queries for the blocks other than the home block with cells whose triangle-inequality lower bound is
    within the query's theta, with masks of those cells.  ``groups`` has (n, rmax, rmin, block, bit, first cell of every block)
    over the P cells of each group (a small table: groups x P), ``group_of`` the group of a block."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 8 * VISIT_ROWS):
                part = batch.slice(at, 8 * VISIT_ROWS)
                x = np.stack([np.asarray(part.column(c), dtype=float) for c in qs], axis=1)
                theta, home = np.asarray(part.column("_theta")), np.asarray(part.column("_block"))
                found = []
                for g in np.unique(group_of[home]).tolist():
                    mine = np.flatnonzero(group_of[home] == g)
                    n, rmax, rmin, block, bit, _ = groups[g]
                    for rows, some in _pivots_near(x[mine], pivots, metric, p, theta[mine], rmax):
                        rows, where = mine[rows], block[some]
                        dq = _np_dist(x[rows], pivots[some], metric, p)
                        low = np.maximum((dq - dq.min(1, keepdims=True)) / 2.0, 0.0)
                        lb = np.maximum(np.maximum(dq - rmax[some], rmin[some] - dq), low)
                        ok = (lb <= theta[rows, None]) & (n[some] > 0) & (where != home[rows, None])
                        starts = np.flatnonzero(np.diff(where, prepend=-1))
                        masks = np.bitwise_or.reduceat(np.where(ok, bit[some], np.uint64(0)), starts, axis=1)
                        i, b = np.nonzero(masks)
                        found.append((rows[i], where[starts[b]], masks[i, b]))
                i, block, mask = (np.concatenate(f) for f in zip(*found))
                if len(i):
                    new = {"_block": pa.array(block.astype(np.int32)), "_mask": pa.array(mask.view(np.int64))}
                    rows = part.take(pa.array(i))
                    yield pa.RecordBatch.from_arrays([new[c] if c in new else rows.column(c) for c in columns], names=columns)

    return run


def _pair_distances(q: np.ndarray, r: np.ndarray, metric: str, p: float, start: np.ndarray | None = None, first: int = 0) -> np.ndarray:
    """Distances of pairs (row by row), features added up in order; ``start`` holds the sums of the features before ``first``."""
    out = np.zeros(len(q)) if start is None else start
    for j in range(first, q.shape[1]):
        out = _step(out, q[:, j], r[:, j], metric, p)
    if metric == "euclidean":
        return np.sqrt(out)
    if metric == "cosine":
        return 1.0 - out
    return np.power(out, 1.0 / p) if metric == "minkowski" else out


def _step(out: np.ndarray, a: np.ndarray, b: np.ndarray, metric: str, p: float) -> np.ndarray:
    """One more feature of a running distance."""
    if metric == "cosine":  # of unit vectors
        return out + a * b
    diff = np.abs(a - b)
    if metric == "euclidean":
        return out + diff * diff
    if metric == "manhattan":
        return out + diff
    return np.maximum(out, diff) if metric == "chebyshev" else out + np.power(diff, p)


def _near_pairs(q: np.ndarray, r: np.ndarray, out: np.ndarray | None, theta: np.ndarray, k: int, metric: str, p: float
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, reference, distance) of all pairs that can be among each query's k nearest of ``r``, within ``theta`` (in the
    pruning space); ``out`` (references down) marks pairs that take no part."""
    d = q.shape[1]
    if d > BOX_FEATURES and metric in ("manhattan", "chebyshev", "minkowski") and len(q) and len(r):
        few = _few_pairs(q, r, out, theta, k, metric, p)
        if few is not None:
            j, i = few
            return i, j, _pair_distances(q[i], r[j], metric, p)
    if metric in ("euclidean", "cosine"):
        qq, rr = (q * q).sum(axis=1), (r * r).sum(axis=1)
        if metric == "cosine":  # twice the distance: the square of the unit vectors' (a zero vector is at 1 from all)
            qq, rr = np.ones(len(q)), np.ones(len(r))
        bound = r @ q.T  # becomes the squared distance
        bound *= -2.0
        bound += qq[None, :]
        bound += rr[:, None]
        margin = 1e-11 * (qq + (rr.max() if len(rr) else 0.0)) + 1e-300
        reach = theta * theta + margin
        ranked = lambda kth: kth + margin
    else:
        top = max(np.abs(q).max(initial=0.0), np.abs(r).max(initial=0.0))
        kind = np.float32 if 1e-4 < top < 1e6 and (metric != "minkowski" or p <= 4) else np.float64
        root = p if metric == "minkowski" else 1.0
        eps = float(np.finfo(kind).eps)
        flat, grown = 4 * eps * top * (1.0 if metric == "chebyshev" else d ** (1.0 / root)), 1 + 4 * eps * (d + 8)
        above = lambda x: (x + flat) * grown  # noqa: E731  (what rounding can make of a distance)
        bound = _sums(q, r, metric, p, kind)
        reach = above(theta) ** root
        ranked = lambda kth: above(above(kth.astype(float) ** (1.0 / root))) ** root
    if out is not None:
        bound[out] = np.inf
    limit = lambda x: np.nextafter(x.astype(bound.dtype), bound.dtype.type(np.inf))
    near = bound <= limit(reach)
    if len(r) > k and np.count_nonzero(near) > 2 * k * len(q):
        near = bound <= limit(np.minimum(reach, ranked(np.partition(bound, k - 1, axis=0)[k - 1])))
    near &= bound < np.inf
    j, i = np.nonzero(near)
    return i, j, _pair_distances(q[i], r[j], metric, p)


def _box_bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Least distance of every query to every box."""
    out = np.zeros((len(q), len(lo)))
    for j in range(q.shape[1]):
        x = q[:, j, None]
        gap = np.maximum(np.maximum(lo[None, :, j] - x, x - hi[None, :, j]), 0.0)
        out = _step(out, gap, np.zeros(1), metric, p)
    if metric == "euclidean":
        return np.sqrt(out)
    return np.power(out, 1.0 / p) if metric == "minkowski" else out


def _box_reach(q: np.ndarray, lo: np.ndarray, hi: np.ndarray, metric: str, p: float) -> np.ndarray:
    """Greatest distance of every query to every box."""
    out = np.zeros((len(q), len(lo)))
    for j in range(q.shape[1]):
        x = q[:, j, None]
        out = _step(out, np.maximum(np.abs(x - lo[None, :, j]), np.abs(hi[None, :, j] - x)), np.zeros(1), metric, p)
    if metric == "euclidean":
        return np.sqrt(out)
    return np.power(out, 1.0 / p) if metric == "minkowski" else out


def _slack(distance, metric: str):
    """A bound of the pruning space that no neighbour of ``distance`` exceeds: for cosine the Euclidean distance of unit vectors,
    sqrt(2 * cosine distance) (small absolute slack for rounding near 0)."""
    if metric == "cosine":
        distance = np.sqrt(2.0 * np.maximum(distance, 0.0) + 1e-14)
    return distance * (1 + 1e-9) + 1e-12


def _numbers(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Equal values of several columns as equal numbers; a NULL is like no other value."""
    whole = pa.concat_arrays([c for col in columns for c in col.chunks])
    code = np.asarray(pc.fill_null(whole.dictionary_encode().indices, -1)).astype(np.int64)
    code[code < 0] = -1 - np.flatnonzero(code < 0)
    return np.split(code, np.cumsum([len(c) for c in columns])[:-1])


def _best_of(i: np.ndarray, dist: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best pairs, by distance and then the references' order."""
    by = np.lexsort((order, dist, i))
    rank = np.arange(len(i)) - np.searchsorted(i[by], i[by])
    return by[rank < k]


def _settled(pool: list, order: np.ndarray, k: int, reach: np.ndarray, metric: str) -> int:
    """Keep each query's k best of the pairs in ``pool`` and take the k-th as its bound in ``reach``; how many pairs are left."""
    i, j, dist = (np.concatenate(c) for c in zip(*pool))
    best = _best_of(i, dist, order[j], k)
    i, j, dist = i[best], j[best], dist[best]
    full = np.flatnonzero(np.bincount(i, minlength=len(reach)) >= k)
    last = np.searchsorted(i, full, side="right") - 1
    reach[full] = np.minimum(reach[full], _slack(dist[last], metric))
    pool[:] = [(i, j, dist)]
    return len(i)


def _search_wide(q: np.ndarray, theta: np.ndarray, mask: np.ndarray, r: np.ndarray, bit: np.ndarray, order: np.ndarray, outside, k: int,
                 metric: str, p: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """``_search`` for many features and Manhattan or Chebyshev distance, by runs of references over cells; None where few pairs of
    rows and references are in the masks, or values lie too far apart."""
    asked = (mask[:, None] >> np.arange(MASK_CELLS, dtype=np.uint64) & np.uint64(1)).sum(axis=0) @ np.bincount(bit, minlength=MASK_CELLS)
    if min(len(q), len(r)) < WIDE_ROWS[1] or asked < len(q) * len(r) / 8:
        return None
    least, most = min(q.min(), r.min()), max(q.max(), r.max())
    if not 1e-12 < most - least < 1e12 or max(abs(least), abs(most)) > 1e4 * (most - least):
        return None
    cells, by, runs = np.left_shift(np.uint64(1), bit.astype(np.uint64)), np.argsort(bit, kind="stable"), []
    while len(by):  # without a theta each run is about as large as those before it, so that few of its pairs are within reach
        size = min(max(len(r) - len(by), RUN_ROWS[0]), RUN_ROWS[1]) if np.isinf(theta).any() else RUN_ROWS[1]
        size = size if len(by) - size >= RUN_ROWS[0] else len(by)
        runs, by = [*runs, by[:size]], by[size:]
    chunks = [(np.arange(at, min(at + WIDE_ROWS[0], len(q))), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], theta[at:at + WIDE_ROWS[0]].copy())
              for at in range(0, len(q), WIDE_ROWS[0])]
    for run in runs:
        near, here = (_windows if metric == "chebyshev" else _cells_apart)(r[run], k), np.bitwise_or.reduce(cells[run])
        for rows, pool, reach in chunks:
            left = np.flatnonzero(mask[rows] & here)
            some = left[np.isfinite(reach[left])]
            found = near(q[rows[some]], reach[some]) if len(some) else None
            if found is not None:
                left = left[np.isinf(reach[left])]
                i, j = some[found[0]], run[found[1]]
                ok, marks = mask[rows[i]] & cells[j] != 0, outside(rows[i], j, True)
                i, j = (x[ok if marks is None else ok & ~marks] for x in (i, j))
                for at in range(0, len(i), PAIR_ROWS):
                    a, b = i[at:at + PAIR_ROWS], j[at:at + PAIR_ROWS]
                    dist = _pair_distances(q[rows[a]], r[b], metric, p)
                    keep = dist <= reach[a]
                    pool.append((a[keep], b[keep], dist[keep]))
                _settled(pool, order, k, reach, metric)
            for at in range(0, len(run) if len(left) else 0, RUN_ROWS[0]):
                unit = run[at:at + RUN_ROWS[0]]
                out, marks = mask[None, rows[left]] & cells[unit, None] == 0, outside(rows[left], unit)
                i, j, dist = _near_pairs(q[rows[left]], r[unit], out if marks is None else out | marks, reach[left], k, metric, p)
                pool.append((left[i], unit[j], dist))
                _settled(pool, order, k, reach, metric)
    i, j, dist = (np.concatenate(c) for c in zip(*((rows[pool[0][0]], *pool[0][1:]) for rows, pool, _ in chunks)))
    return i, j, dist


def _search(q: np.ndarray, theta: np.ndarray, mask: np.ndarray, r: np.ndarray, bit: np.ndarray, order: np.ndarray, outside, k: int,
            metric: str, p: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, reference, distance) of each query's k nearest references in the cells of its mask."""
    boxed, inside = q.shape[1] <= BOX_FEATURES, "euclidean" if metric == "cosine" else metric
    wide = _search_wide(q, theta, mask, r, bit, order, outside, k, metric, p) if not boxed and metric in ("manhattan", "chebyshev") else None
    if wide is not None:
        return wide
    size = max(BOX_ROWS, 2 * k) if boxed else 4 * BOX_ROWS
    units = [u for b in np.unique(bit).tolist() for u in _boxes(r, np.flatnonzero(bit == b), size)]
    unit_bit = np.array([bit[u[0]] for u in units], dtype=np.uint64)
    lo, hi = (np.array([f(r[u], axis=0) for u in units]) for f in (np.min, np.max))
    done = []
    for rows in _boxes(q, np.arange(len(q)), max(64, 2_000_000 // max(size, len(units)) // 4)):
        x, reach = q[rows], theta[rows].copy()
        ask = (mask[rows, None] >> unit_bit & np.uint64(1)).astype(bool)
        low = _box_bounds(x, lo, hi, inside, p) if boxed else np.zeros(ask.shape)
        low[~ask] = np.inf
        pool, held, kept = [], 0, 0

        def meet(some: np.ndarray, unit: np.ndarray) -> int:
            i, j, dist = _near_pairs(x[some], r[unit], outside(rows[some], unit), reach[some], k, metric, p)
            pool.append((some[i], unit[j], dist))
            return len(i)

        if boxed:  # the nearest box first
            nearest = low.argmin(axis=1)
            for u in np.unique(nearest).tolist():
                some = np.flatnonzero((nearest == u) & ask[:, u])
                held += meet(some, units[u])
            ask[np.arange(len(rows)), nearest] = False
            held = kept = _settled(pool, order, k, reach, metric)
        for u in np.flatnonzero(ask.any(axis=0)).tolist():
            some = np.flatnonzero(ask[:, u] & (low[:, u] <= reach))
            if len(some):
                held += meet(some, units[u])
                if held - kept > k * len(rows):
                    held = kept = _settled(pool, order, k, reach, metric)
        if pool:
            _settled(pool, order, k, reach, metric)
            done.append((rows[pool[0][0]], *pool[0][1:]))
    return tuple(np.concatenate(c) for c in zip(*done)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _block_top(k: int, metric: str, p: float, qs: list[str], rs: list[str], nb: list[str], exclude_self: bool, exclude_same: str | None):
    """The k best references of a block for each of its queries, among the cells of its mask."""
    def run(key: tuple[pa.Scalar, ...], queries: pa.Table, refs: pa.Table) -> pa.Table:
        i, j, dist = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if queries.num_rows and refs.num_rows:
            q = np.stack([np.asarray(queries[c], dtype=float) for c in qs], axis=1)
            r = np.stack([np.asarray(refs[c], dtype=float) for c in rs], axis=1)
            order = np.empty(len(r), np.int64)
            order[np.asarray(pc.sort_indices(refs["_rid"]))] = np.arange(len(r))  # NULL ids last
            pairs = ([_numbers(queries["_qkey"], refs["_rid"])] if exclude_self else []) + (
                [_numbers(queries["_same"], refs["_same"])] if exclude_same else [])

            def outside(some: np.ndarray, unit: np.ndarray, paired: bool = False) -> np.ndarray | None:
                """Pairs that take no part, references down (or one by one)."""
                marks = [theirs[unit] == mine[some] if paired else theirs[unit, None] == mine[None, some] for mine, theirs in pairs]
                return np.logical_or.reduce(marks) if marks else None

            i, j, dist = _search(q, np.asarray(queries["_theta"]), np.asarray(queries["_mask"]).view(np.uint64), r,
                                 np.asarray(refs["_bit"]), order, outside, k, metric, p)
        left, right = queries["_qid"].take(pa.array(i)), refs.take(pa.array(j))
        return pa.table([left, right["_rid"], pa.array(dist)] + [right[c] for c in nb], names=["_qid", "_rid", "distance", *nb])
    return run


def knn_join(queries: DataFrame, refs: DataFrame, k: int, features: Sequence[str], *,
             query_id: str, ref_id: str, metric: str = "euclidean", p: float = 2.0,
             group: Sequence[str] = (), ref_features: Sequence[str] | None = None,
             exclude_self: bool = False, exclude_same: str | None = None, query_carry: Sequence[str] = (),
             ref_carry: Sequence[str] = (), n_pivots: int | None = None, block_rows: int | None = None,
             seed: int = 42, query_row: str | None = None) -> DataFrame:
    """NN-01: the ``k`` nearest references of every query row.

    Returns ``query_row, query_id, *group, *query_carry, neighbor_id, rank, distance,
    nb_<ref_carry>...``; ``rank`` is 1..k in ``(distance, neighbor_id)`` order, NULL ids last.
    ``query_row`` is a number of the query row, given here unless it names a column
    that numbers the rows already.
    ``group`` columns must exist on both sides: neighbours come from the
    query's own group only.  ``exclude_self`` drops the reference whose id
    equals the query id; ``exclude_same`` names a column of both sides (a fold, say)
    in which a neighbour must differ from the query.  Ids may repeat and be NULL.
    Rows with a NULL feature take no part.  Queries with no reference in their
    group get no rows.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    feats = list(features)
    rfeats = list(ref_features or features)
    if len(rfeats) != len(feats):
        raise ValueError("query and reference feature lists differ in length")
    if metric == "minkowski" and p < 1:
        raise ValueError("minkowski needs p >= 1")
    spark = queries.sparkSession
    d = len(feats)
    prune_metric = "euclidean" if metric == "cosine" else metric
    groups = list(group)
    gnames = [f"_g{i}" for i in range(len(groups))] or ["_g0"]
    qs, rs = [f"_q{j}" for j in range(d)], [f"_r{j}" for j in range(d)]
    bq = lambda c: "`" + c.replace("`", "``") + "`"
    same = [f"{bq(exclude_same)} AS _same"] if exclude_same else []

    def side(df: DataFrame, key: str, name: str, cols: list[str], out: list[str], carry: list[str]) -> DataFrame:
        rows = df.selectExpr(f"{bq(key)} AS {name}", *([f"{bq(g)} AS {n}" for g, n in zip(groups, gnames)] or ["0 AS _g0"]),
                             *same, *[f"CAST({bq(f)} AS DOUBLE) AS {n}" for f, n in zip(cols, out)], *carry)
        rows = rows.where(F.expr(" and ".join(f"({c} is not null and not isnan({c}))" for c in out)))
        if metric != "cosine":
            return rows
        unit, norm = _unit(out)
        rows = rows.withColumn("_norm", norm)
        return rows.select(*[c for c in rows.columns if c not in [*out, "_norm"]], *[e.alias(n) for e, n in zip(unit, out)])

    nb = [f"nb_{c}" for c in ref_carry]
    row = [f"{bq(query_row)} AS _qid"] if query_row else []
    q = side(queries, query_id, "_qkey", feats, qs, row + [bq(c) for c in query_carry])
    q = q if query_row else steps.numbered(q, "queries", "_qid")
    r = steps.numbered(side(refs, ref_id, "_rid", rfeats, rs, [f"{bq(c)} AS {bq(n)}" for c, n in zip(ref_carry, nb)]), "refs", "_rrow")
    held, written = [], [r] if query_row else [q, r]

    # 1. pivots: P references in seeded hash order
    n_refs = r.count()
    if n_refs == 0:
        return _empty_result(spark, q, r, query_id, groups, gnames, query_carry, ref_carry)
    r = steps.spread(r, n_refs)
    q = q if query_row else steps.spread(q, q.count())
    n_groups = r.select(*gnames).distinct().count() if groups else 1
    P = min(n_pivots or _pivot_count(n_refs // n_groups), max(1, MAX_CELLS // n_groups))
    piv = np.asarray([[float(v) for v in row] for row in
                      r.orderBy(F.xxhash64("_rid", F.lit(seed)), "_rrow").select(*rs).limit(P).collect()], dtype=float)
    P = len(piv)
    piv = piv[np.concatenate(_boxes(piv, np.arange(P), 1))]  # neighbouring numbers are neighbouring cells
    assign = _assign_udf(piv, prune_metric, p)
    if block_rows is None:
        block_rows = min(max(n_refs // n_groups // 12, BLOCK_ROWS[0]), BLOCK_ROWS[1])
    query_rows = min(block_rows, max(TASK_NEIGHBORS // k, 64))

    # 2. references: nearest pivot, radius; cell summaries (at most MAX_CELLS rows), blocks of neighbouring cells
    near_ref = r.withColumn("_a", assign(F.struct(*[F.col(c) for c in rs]))).select(
        "*", F.col("_a.cell").alias("_cell"), F.col("_a.rad").alias("_rad")).drop("_a").persist(StorageLevel.DISK_ONLY)
    held.append(near_ref)
    cells = near_ref.where(F.expr(" and ".join(f"{g} is not null" for g in gnames))).groupBy(*gnames, "_cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("_rad").alias("rmax"), F.min("_rad").alias("rmin"))
    stats: dict = {}
    for row in cells.collect():
        n, rmax, rmin = stats.setdefault(tuple(row[g] for g in gnames), (np.zeros(P), np.zeros(P), np.zeros(P)))
        c = row["_cell"]
        n[c], rmax[c], rmin[c] = row["n"], row["rmax"], row["rmin"]
    kinds = {f.name: f.dataType for f in [*q.schema, *r.schema]}
    by_group, group_of, block_n, place = [], [], [], []
    for key, (n, rmax, rmin) in stats.items():
        run, bit = _runs(n, block_rows)
        starts = np.flatnonzero(bit == 0)
        place += [(*key, c, int(b) + len(block_n), int(x)) for c, (b, x) in enumerate(zip(run, bit))]
        by_group.append((n, rmax, rmin, run + len(block_n), np.left_shift(np.uint64(1), bit.astype(np.uint64)), starts))
        group_of += [len(by_group) - 1] * len(starts)
        block_n += np.add.reduceat(n, starts).astype(int).tolist()
    group_of = np.array(group_of, dtype=int)
    places = spark.createDataFrame(place, StructType(
        [StructField(g, kinds[g]) for g in gnames] + [StructField(c, IntegerType()) for c in ("_cell", "_block", "_bit")]))
    r2 = near_ref.join(F.broadcast(places), [*gnames, "_cell"]).select("_rrow", "_rid", *(["_same"] if same else []), *rs, *nb, "_block", "_bit")

    # 3. queries: home block (that of the nearest pivot's cell)
    q2 = q.withColumn("_cell", assign(F.struct(*[F.col(c) for c in qs]))["cell"]).join(
        F.broadcast(places.toDF(*places.columns)), [*gnames, "_cell"]).drop("_cell", "_bit").persist(StorageLevel.DISK_ONLY)
    held.append(q2)
    asking = ["_qid", *(["_qkey"] if exclude_self else []), *(["_same"] if same else []), *qs]
    schema = StructType([StructField("_qid", kinds["_qid"]), StructField("_rid", kinds["_rid"]), StructField("distance", DoubleType())]
                        + [StructField(c, kinds[c]) for c in nb])
    top = _block_top(k, metric, p, qs, rs, nb, exclude_self, exclude_same)

    def met(visits: DataFrame) -> tuple[DataFrame, bool, int, int]:
        """Blocks and the queries that visit them; each query's k best of each, whether some block is dealt over tasks,
        the most rows there can be, and the visits."""
        asked = visits.groupBy("_block").count().collect()  # a row for each block, of which there are fewer than cells
        parts = [(row["_block"], math.ceil(block_n[row["_block"]] / (1.5 * block_rows)), math.ceil(row["count"] / query_rows)) for row in asked]
        dealt = any(rn > 1 for _, rn, _ in parts)
        found = sum(rn * row["count"] * min(k, block_n[row["_block"]]) for (_, rn, _), row in zip(parts, asked))
        tasks = max(1, min(MAX_TASKS, 3 * sum(rn * qn for _, rn, qn in parts)))  # so that few of them are hashed together
        parts = spark.createDataFrame(parts, "_block int, _rn int, _qn int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        part = lambda key, n, s: F.pmod(F.xxhash64(key, F.lit(s)), F.col(n)).cast("int")
        by = ["_block", "_qp", "_rp"]
        left = visits.join(F.broadcast(parts), "_block").withColumn("_qp", part("_qid", "_qn", seed)).withColumn("_rp", every("_rn"))
        right = r2.join(F.broadcast(parts.toDF(*parts.columns)), "_block").withColumn("_rp", part("_rrow", "_rn", seed + 1)).withColumn("_qp", every("_qn"))
        left, right = (side.drop("_rn", "_qn", "_rrow").repartition(tasks, *by) for side in (left, right))
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(top, schema), dealt, found, sum(row["count"] for row in asked)

    order = Window.partitionBy("_qid").orderBy("distance", F.col("_rid").asc_nulls_last())

    def first(df: DataFrame, rows: int) -> DataFrame:
        return _dealt(df, "_qid", rows).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # 4. home phase: exact top k within the home block
    near, dealt, home_rows, n_queries = met(q2.select(*asking, "_block", F.lit(float("inf")).alias("_theta"), F.lit(-1).cast("long").alias("_mask")))
    near = (first(near, home_rows).drop("rank") if dealt else near).persist(StorageLevel.DISK_ONLY)
    held.append(near)
    theta = near.groupBy("_qid").agg(F.count(F.lit(1)).alias("_hn"), F.max("distance").alias("_hd"))

    # 5. expansion phase: cells of other blocks whose lower bound is within theta, which lives in the pruning space (see _slack)
    hd = F.sqrt(F.lit(2.0) * F.greatest(F.col("_hd"), F.lit(0.0)) + F.lit(1e-14)) if metric == "cosine" else F.col("_hd")
    qt = q2.select(*asking, "_block").repartition(steps.parts(spark, n_queries), "_qid").join(theta, "_qid", "left").withColumn(
        "_theta", F.when(F.col("_hn") >= k, hd * F.lit(1 + 1e-9) + F.lit(1e-12)).otherwise(F.lit(float("inf")))).select(
        *asking, "_block", "_theta")
    columns = [*asking, "_block", "_theta", "_mask"]
    more = qt.mapInArrow(_visits(piv, prune_metric, p, by_group, group_of, qs, columns),  # not stored: cheaper to find twice
                         StructType([*qt.schema.fields, StructField("_mask", LongType())]))

    # 6. merge: top k of both phases per query
    further, _, more_rows, _ = met(more)
    best = first(near.unionByName(further), home_rows + more_rows).join(q2.select("_qid", "_qkey", *gnames, *[bq(c) for c in query_carry]), "_qid")
    out = steps.table(best.select(
        F.col("_qid").alias("query_row"), F.col("_qkey").alias(query_id), *[F.col(n).alias(g) for g, n in zip(groups, gnames)],
        *query_carry, F.col("_rid").alias("neighbor_id"), "rank", "distance", *nb), "neighbors")
    for df in held:
        df.unpersist()
    steps.discard(*written)
    return out


def _empty_result(spark, q, r, query_id, groups, gnames, query_carry, ref_carry):
    sel = q.select(F.col("_qid").alias("query_row"), F.col("_qkey").alias(query_id), *[F.col(n).alias(g) for g, n in zip(groups, gnames)],
                   *query_carry, F.lit(None).cast("long").alias("neighbor_id"), F.lit(0).alias("rank"),
                   F.lit(None).cast("double").alias("distance"),
                   *[F.lit(None).alias(f"nb_{c}") for c in ref_carry])
    return sel.where(F.lit(False))


def _inverse(distance: str = "distance") -> Column:
    """Weight of a neighbour: 1/d, NULL at distance 0."""
    return F.when(F.col(distance) == 0, F.lit(None)).otherwise(F.lit(1.0) / F.col(distance))


def vote_shares(neighbors: DataFrame, row: str, label: str) -> DataFrame:
    """NN-03 + KC-07 in long form, for any number of classes: ``row, class, weight, share``.

    Weight ``1/d`` summed per class; when some neighbour is at distance 0 only those
    count, equally.  Only classes among a row's neighbours are listed.  Both sums use
    the one partitioning by row.
    """
    near = _dealt(neighbors.where(F.col(label).isNotNull()), row, neighbors.count())
    per = near.groupBy(row, F.col(label).alias("class")).agg(
        F.sum(_inverse()).alias("_s"), F.count(F.when(F.col("distance") == 0, 1)).alias("_z"))
    own = Window.partitionBy(row)
    per = per.withColumn("weight", F.when(F.max("_z").over(own) > 0, F.col("_z").cast("double")).otherwise(F.coalesce("_s", F.lit(0.0))))
    return (per.where("weight > 0").withColumn("share", F.col("weight") / F.sum("weight").over(own))
            .select(row, "class", "weight", "share"))


def top_share(shares: DataFrame, row: str) -> DataFrame:
    """``row, prediction, probability``: the class of largest weight, ties to the first class."""
    order = Window.partitionBy(row).orderBy(F.desc("weight"), "class")
    return shares.withColumn("_n", F.row_number().over(order)).where("_n = 1").select(
        row, F.col("class").alias("prediction"), F.col("share").alias("probability"))


def weighted_vote(neighbors: DataFrame, row: str, label: str, classes: Sequence,
                  carry: Sequence[str] = ()) -> DataFrame:
    """NN-03 + KC-06/07 for a short list of classes: inverse-distance vote per query row.

    Weight ``1/d``; when some neighbour is at distance 0 only those count,
    equally.  Returns ``row, *carry, prediction, proba_<i>`` (one per class in
    ``classes`` order); the prediction is the class of largest weight, ties to
    the first class.  One aggregate keyed by the query row.
    """
    classes = list(classes)
    inv = _inverse()
    aggs = [F.min("distance").alias("_dmin")] + [F.first(c).alias(c) for c in carry]
    for i, c in enumerate(classes):
        is_c = F.col(label) == F.lit(c)
        aggs += [F.sum(F.when(is_c, inv)).alias(f"_s{i}"),
                 F.count(F.when(is_c & (F.col("distance") == 0), 1)).alias(f"_z{i}")]
    g = _dealt(neighbors, row, neighbors.count()).groupBy(row).agg(*aggs)
    wts = {i: F.when(F.col("_dmin") == 0, F.col(f"_z{i}").cast("double")).otherwise(F.coalesce(F.col(f"_s{i}"), F.lit(0.0)))
           for i in range(len(classes))}
    g = g.withColumns({f"_w{i}": e for i, e in wts.items()})
    total = sum((F.col(f"_w{i}") for i in range(1, len(classes))), F.col("_w0"))
    best = F.greatest(*[F.struct(F.col(f"_w{i}").alias("w"), F.lit(-i).alias("n")) for i in range(len(classes))]) \
        if len(classes) > 1 else F.struct(F.col("_w0").alias("w"), F.lit(0).alias("n"))
    labels = F.array(*[F.lit(c) for c in classes])
    return g.select(row, *carry, labels[-best["n"]].alias("prediction"),
                    *[(F.col(f"_w{i}") / total).alias(f"proba_{i}") for i in range(len(classes))])


def uniform_votes(neighbors: DataFrame, row: str, label: str, ks: Sequence[int], carry: Sequence[str] = ()) -> DataFrame:
    """NN-04 for many k at once: majority label among the first k neighbours, for any number of classes.

    One row for each class among a row's neighbours holds its counts for all k, in the partitioning by row.
    A k beyond a row's neighbours is left out.  Returns ``row, *carry, k, prediction``; ties go to the first class.
    """
    ks = sorted({int(x) for x in ks})
    near = _dealt(neighbors, row, neighbors.count())
    per = near.groupBy(row, F.col(label).alias("_class")).agg(
        *[F.count(F.when(F.col("rank") <= x, 1)).alias(f"_n{x}") for x in ks], *[F.first(c).alias(c) for c in carry])
    won = per.groupBy(row).agg(*[F.first(c).alias(c) for c in carry], *[e for x in ks for e in (
        F.min(F.struct((-F.col(f"_n{x}")).alias("n"), F.col("_class").alias("class"))).alias(f"_b{x}"), F.sum(f"_n{x}").alias(f"_s{x}"))])
    each = F.array(*[F.struct(F.lit(x).alias("k"), F.col(f"_b{x}.class").alias("prediction"), F.col(f"_s{x}").alias("_all")) for x in ks])
    return won.select(row, *carry, F.inline(each)).where(F.col("_all") == F.col("k")).drop("_all")
