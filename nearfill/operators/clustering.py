"""Clustering: nearest centre, silhouette and the k-means search (CL-01..CL-06).

All models of a search -- one for each class, k and restart -- are fitted together.  Rows are dealt once over
as many partitions as they need and packed, some thousands of a class to a row of bytes; one pass over them moves the centres of every model that
still moves (Lloyd's iteration), so a search takes as many jobs as its slowest model has
iterations, not that many for each model; a pass plans nothing anew and turns no single rows into columns.  Packed rows are neighbours, cut into
small boxes: a box that lies on one centre's side of every bisector moves whole, by its sum, and only the rows of the others are looked at.  Seeding is k-means|| over all rows: a random row, two rounds of ``2k`` rows
drawn in proportion to their squared distance, then weighted k-means++ on the drawn ones.  The best
restart of a k is the one of lowest cost; the k of highest silhouette wins (first wins).  The
silhouettes of all classes and ks are found together, in two passes over the rows (squared Euclidean,
linear time, as MLlib's ``ClusteringEvaluator`` defines it).  The reference's Euclidean silhouette compares all pairs
and is not built.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from . import steps

#: Centres that are fitted at a time, about (the classes of a round).
FIT_CENTRES = 20_000
#: Rows of a partition of the fits, about.
FIT_ROWS = 25_000
#: Rows whose distances are held at a time.
CHUNK = 8192
#: Rows whose products with the centres of some models are held at a time, and such centres.
TILE = (2048, 128)
#: Rows of a box of neighbouring rows, rows in which boxes are made, packed rows that a pass looks at together, and unsure boxes at a time.
BOX_ROWS, HELD_ROWS, PASS_ROWS, UNSURE = 32, 32 * CHUNK, 4 * CHUNK, 1024
#: Up to so many features, boxes are worth their bounds.
BOX_FEATURES = 8
#: Rows of sums that the driver adds up itself.
FETCHED_ROWS = 50_000
#: Rounds of the seeding after the first row.
SEED_ROUNDS = 2


# ----------------------------------------------------------------- CL-04
def assign_nearest(df: DataFrame, features: Sequence[str], centres: dict, group: str | None = None,
                   out: str = "cluster", dist_out: str | None = None) -> DataFrame:
    """Add the id of the nearest centre (Euclidean) and optionally its distance.

    ``centres`` maps a group value (or None when ``group`` is None) to a k × d
    list of centres; rows whose group has no centres, or with a NULL or NaN
    feature, get NULL.  Ties go to the lowest cluster id.  Evaluated with numpy in
    Arrow batches, whatever the number of centres.
    """
    feats = list(features)
    mats = {g: np.asarray(c, dtype=float) for g, c in centres.items()}
    schema = StructType([StructField("cluster", IntegerType()), StructField("distance", DoubleType())])

    def nearest(x: pd.DataFrame) -> pd.DataFrame:
        xs = x[[f"_f{j}" for j in range(len(feats))]].to_numpy(dtype=float)
        usable = ~np.isnan(xs).any(1)
        cluster, best = np.full(len(x), -1), np.full(len(x), np.nan)
        for g, cs in mats.items():
            rows = np.flatnonzero(usable & (x["_g"].to_numpy() == g) if group is not None else usable)
            if not len(rows):
                continue
            d2 = np.empty((len(rows), len(cs)))
            for c, centre in enumerate(cs):
                diff = xs[rows] - centre
                d2[:, c] = (diff * diff).sum(1)
            cluster[rows] = d2.argmin(1)
            best[rows] = np.sqrt(d2.min(1))
        return pd.DataFrame({"cluster": pd.Series(cluster, dtype="Int32").where(cluster >= 0),
                             "distance": pd.Series(best, dtype="Float64").where(cluster >= 0)})

    cols = [F.col(f).cast("double").alias(f"_f{j}") for j, f in enumerate(feats)]
    if group is not None:
        cols = [F.col(group).alias("_g")] + cols
    run = F.pandas_udf(nearest, schema).asNondeterministic()  # evaluated once, never duplicated
    res = df.withColumn("_nc", run(F.struct(*cols))).withColumn(out, F.col("_nc.cluster"))
    if dist_out:
        res = res.withColumn(dist_out, F.col("_nc.distance"))
    return res.drop("_nc")


# ----------------------------------------------------------------- CL-05
def silhouette_values(xc, sq, n, psi, Y, labels) -> np.ndarray:
    """Per-row squared-Euclidean silhouette given cluster sums (n, psi, Y)."""
    k = len(n)
    safe_n = np.where(n > 0, n, 1.0)
    dist = sq[:, None] + (psi / safe_n)[None, :] - 2.0 * (xc @ Y.T) / safe_n[None, :]
    dist = np.where((n > 0)[None, :], dist, np.inf)
    rows = np.arange(len(labels))
    own_n = n[labels]
    a = dist[rows, labels] * own_n / np.maximum(own_n - 1, 1)
    other = dist.copy()
    other[rows, labels] = np.inf
    b = other.min(1) if k > 1 else np.full(len(labels), np.inf)
    s = np.where(a < b, 1 - a / np.where(b == 0, 1, b), np.where(a > b, b / np.where(a == 0, 1, a) - 1, 0.0))
    s = np.where(own_n <= 1, 0.0, s)
    s = np.where(np.isinf(b), 0.0, s)
    return s


def silhouette(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    """CL-05 for a given assignment → one row ``silhouette`` (squared Euclidean).

    Cluster sums come from one aggregate (bounded by the cluster count); a
    second pass computes every row's coefficient from them in Arrow batches.
    """
    feats = list(features)
    d = len(feats)
    xcols = [f"_x{j}" for j in range(d)]
    data = df.select(F.col(cluster).alias("_c"), *[F.col(f).cast("double").alias(x) for f, x in zip(feats, xcols)])
    sq = sum((F.col(x) * F.col(x) for x in xcols[1:]), F.col(xcols[0]) * F.col(xcols[0]))
    stats = data.groupBy("_c").agg(F.count(F.lit(1)).alias("n"), F.sum(sq).alias("psi"),
                                   *[F.sum(x).alias(x) for x in xcols]).orderBy("_c").collect()
    ids = [r["_c"] for r in stats]
    n = np.array([r["n"] for r in stats], dtype=float)
    psi = np.array([r["psi"] for r in stats], dtype=float)
    Y = np.array([[r[x] for x in xcols] for r in stats], dtype=float)
    index = {c: i for i, c in enumerate(ids)}

    def run(it):
        for pdf in it:
            xs = pdf[xcols].to_numpy(dtype=float)
            lab = np.array([index[c] for c in pdf["_c"]], dtype=int)
            s = silhouette_values(xs, (xs * xs).sum(1), n, psi, Y, lab)
            yield pd.DataFrame({"s": [float(s.sum())], "n": [len(s)]})

    part = data.where(F.col("_c").isNotNull()).mapInPandas(run, "s double, n long")
    return part.agg((F.sum("s") / F.sum("n")).alias("silhouette"))


# ----------------------------------------------------------------- CL-01/02/03/06
@dataclass
class ClusterSearch:
    centres: dict        # class value -> k × d list (chosen model)
    k: dict              # class value -> chosen k
    inertia: dict        # class value -> inertia of the chosen model
    silhouette: dict     # class value -> silhouette of the chosen model (0 with one cluster)
    n_iter: dict         # class value -> iterations of the chosen model
    counts: dict         # class value -> list of cluster sizes
    scores: list         # rows (class, k, silhouette, inertia, n_iter)


@dataclass
class _Fit:
    centres: np.ndarray
    inertia: float
    n_iter: int


def _nearest(xt: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every column of ``xt`` (ties to the first) and its squared distance."""
    own, best = np.zeros(xt.shape[1], np.intp), np.empty(xt.shape[1])
    d2, diff = np.empty_like(best), np.empty_like(best)
    for c, centre in enumerate(centres):
        out = d2 if c else best
        np.subtract(xt[0], centre[0], out=out)
        np.multiply(out, out, out=out)
        for x, v in zip(xt[1:], centre[1:]):
            np.subtract(x, v, out=diff)
            np.multiply(diff, diff, out=diff)
            np.add(out, diff, out=out)
        if c:
            np.copyto(own, c, where=d2 < best)
            np.minimum(best, d2, out=best)
    return own, best


def _mixed(x: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers mixed with one salt after the other."""
    with np.errstate(over="ignore"):
        for s in salt:
            x = (x ^ np.uint64(s & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x ^= x >> np.uint64(shift)
                x *= np.uint64(by)
            x ^= x >> np.uint64(31)
    return x


def _draws(rows: np.ndarray, *salt: int) -> np.ndarray:
    """A number in (0, 1) for each row number, the same for the same salt."""
    return ((_mixed(rows.astype(np.uint64), *salt) >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53


def _neighbouring(x: np.ndarray) -> np.ndarray:
    """An order of the columns of ``x`` in which chunks, and in them boxes, are neighbours: cut near medians of the widest feature."""
    todo, out = [np.arange(x.shape[1])], []
    while todo:
        some = todo.pop()
        if len(some) <= BOX_ROWS:
            out.append(some)
            continue
        unit = CHUNK if len(some) > CHUNK else BOX_ROWS
        part, half = x[:, some], unit * max(1, round(len(some) / 2 / unit))
        by = np.argpartition(part[np.ptp(part, axis=1).argmax()], half)
        todo += [some[by[half:]], some[by[:half]]]
    return np.concatenate(out) if out else np.zeros(0, np.intp)


def _packed(rows: DataFrame, xcols: list[str]) -> DataFrame:
    """``_cls, numbers, x``: row numbers and features (as rows of a matrix) of up to ``CHUNK`` neighbouring rows of a class, as bytes."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= HELD_ROWS:
                yield from packed(held)
                held, n = [], 0
        if n:
            yield from packed(held)

    def packed(held):
        some = pa.Table.from_batches(held)
        cls, number = np.asarray(some["_cls"]), np.asarray(some[steps.ROW])
        x = np.stack([np.asarray(some[c], dtype=float) for c in xcols])
        for c in np.unique(cls).tolist():
            rows = np.flatnonzero(cls == c)
            rows = rows[_neighbouring(x[:, rows])] if len(xcols) <= BOX_FEATURES else rows
            for at in range(0, len(rows), CHUNK):
                one = rows[at:at + CHUNK]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([number[one].tobytes()], pa.binary()),
                                                  pa.array([x[:, one].tobytes()], pa.binary())], names=["_cls", "numbers", "x"])

    return rows.mapInArrow(run, "_cls int, numbers binary, x binary")


def _pickled(rows: DataFrame) -> tuple[RDD, str]:
    """Class and features of packed ``rows`` as a file of pickled records, and its path: a pass takes its bytes as they are, without a
    conversion of columns to Python objects."""
    path = steps.folder(rows.sparkSession, "chunks")
    rows.select("_cls", "x").rdd.map(lambda row: (row[0], bytes(row[1]))).saveAsPickleFile(path, 1)
    return rows.sparkSession.sparkContext.pickleFile(path), path


def _unpacked(numbers: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(numbers, np.int64)
    return numbers, np.frombuffer(x, float).reshape(-1, len(numbers))


def _moved(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rows and sums of the features of each cluster of some models (model, centre, feature) that have as many centres each; the
    nearest centre is that of the largest ``x . c - c . c / 2`` (ties to the first), one matrix product for all models."""
    r, k, d = centres.shape
    shift = centres.reshape(-1, d).mean(axis=0)
    c = (centres - shift).transpose(1, 0, 2).reshape(k * r, d)  # the models' first centres, then their second ones
    c = np.column_stack([c, -(c * c).sum(axis=1) / 2.0])
    first, out = k * np.arange(r)[:, None], np.zeros((1 + d, r * k))
    for at in range(0, x.shape[1], TILE[0]):
        part = x[:, at:at + TILE[0]]
        near = (c @ np.vstack([part - shift[:, None], np.ones(part.shape[1])])).reshape(k, r, -1)
        kind = np.uint8 if k < 256 else np.int32
        own, best = np.zeros(near.shape[1:], kind), near[0]
        for j in range(1, k):
            np.maximum(own, (near[j] > best) * kind(j), out=own)
            np.maximum(best, near[j], out=best)
        own = (own + first).ravel()
        for i, weight in enumerate((None, *part)):
            out[i] += np.bincount(own, weight if weight is None else np.tile(weight, r), r * k)
    return out.T.reshape(r, k, 1 + d)


def _moved_boxes(x: np.ndarray, boxes: tuple, centres: np.ndarray) -> np.ndarray:
    """``_moved`` for whole boxes of rows (feature, box, row), with the means, radii and sums of ``_boxes_of``.  All rows of a box have one nearest
    centre if its mean is farther from the bisector with any other than the box reaches; the rows of other boxes are looked at."""
    mean, radius, total = boxes
    r, k, d = centres.shape
    shift = centres.reshape(-1, d).mean(axis=0)
    c, m = centres - shift, mean - shift[:, None]
    half = (c * c).sum(axis=2) / 2.0
    near = (c.transpose(1, 0, 2).reshape(k * r, d) @ m).reshape(k, r, -1) - half.T[:, :, None]
    own, best = np.zeros(near.shape[1:], np.intp), near[0].copy()
    for j in range(1, k):
        np.copyto(own, j, where=near[j] > best)
        np.maximum(best, near[j], out=best)
    apart = np.sqrt(((c[:, :, None] - c[:, None]) ** 2).sum(axis=3))
    own += k * np.arange(r)[:, None]
    sure, slack = np.ones(own.shape, bool), 1e-9 * ((m * m).sum(axis=0).max() + half.max()) + 1e-300
    for j in range(k):
        reach = apart[:, :, j].ravel().take(own)
        reach *= radius * (1 + 1e-9)
        reach += slack
        sure &= (best - near[j] > reach) | (own == (k * np.arange(r) + j)[:, None])
    unsure = np.flatnonzero(~sure)
    if len(unsure) > sure.size / 2:
        return _moved(x.reshape(d, -1), centres)
    out, of = np.zeros((1 + d, r * k)), own[sure]
    out[0] = BOX_ROWS * np.bincount(of, minlength=r * k)
    for i, weight in enumerate(total):
        out[1 + i] = np.bincount(of, np.broadcast_to(weight, sure.shape)[sure], r * k)
    model, box = np.divmod(unsure, sure.shape[1])
    for at in range(0, len(unsure), UNSURE):
        t, some = model[at:at + UNSURE], x[:, box[at:at + UNSURE]]
        part, cs, hs = some - shift[:, None, None], c[t], half[t]
        own, best, work = np.zeros(part.shape[1:], np.intp), None, np.empty(part.shape[1:])
        for j in range(k):
            score = part[0] * cs[:, j, 0, None]
            for i in range(1, d):
                np.multiply(part[i], cs[:, j, i, None], out=work)
                np.add(score, work, out=score)
            np.subtract(score, hs[:, j, None], out=score)
            if j:
                np.copyto(own, j, where=score > best)
                np.maximum(best, score, out=best)
            else:
                best = score
        own = (own + k * t[:, None]).ravel()
        for i, weight in enumerate((None, *some)):
            out[i] += np.bincount(own, weight if weight is None else weight.ravel(), r * k)
    return out.T.reshape(r, k, 1 + d)


def _boxes_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, radii and sums of boxes (feature, box, row)."""
    total = x.sum(axis=2)
    mean = total / x.shape[2]
    away = x - mean[:, :, None]
    return mean, np.sqrt((away * away).sum(axis=0).max(axis=1)), total


def _whole_boxes(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The whole boxes of some chunks (feature, box, row), and the rows of none."""
    cut = [x.shape[1] // BOX_ROWS * BOX_ROWS for x in parts]
    return np.hstack([x[:, :n] for x, n in zip(parts, cut)]).reshape(len(parts[0]), -1, BOX_ROWS), np.hstack([x[:, n:] for x, n in zip(parts, cut)])


def _added(rows: DataFrame | RDD, xcols: list[str], models: dict, parts: int, columns: int, of_chunks) -> dict:
    """For each model a matrix of a row for each centre: what ``of_chunks(features of some chunks, models of a class)`` gives for the chunks
    of packed ``rows``, added up in one pass.  Few rows of few ``parts`` are added up on the driver, more of them by Spark."""
    of_class: dict = {}
    for t, centres in models.items():
        of_class.setdefault(t[0], {})[t] = centres

    d = len(xcols)

    def run(packed):
        total, held, n, of = {}, [], 0, None
        for c, chunk in chain(packed, [(None, b"")]):
            if held and (c != of or n >= PASS_ROWS):
                for t, m in of_chunks(held, of_class[of]):
                    total[t] = total[t] + m if t in total else m
                held, n = [], 0
            if c in of_class:
                x, of = np.frombuffer(chunk, float).reshape(d, -1), c
                held, n = [*held, x], n + x.shape[1]
        return total.items()

    found = (rows if isinstance(rows, RDD) else rows.select("_cls", "x").rdd).mapPartitions(run)
    if parts * sum(len(c) for c in models.values()) > FETCHED_ROWS:
        found = found.reduceByKey(np.add)
    out = {t: np.zeros((len(c), columns)) for t, c in models.items()}
    for t, m in found.collect():  # a matrix for each model, of each part if those are few
        out[t] += m
    return out


def _sums(rows: DataFrame | RDD, xcols: list[str], models: dict, parts: int) -> dict:
    """For each model ``(class, k, restart) -> centres``: rows and sums of the features of every cluster, in one pass."""
    def of_chunks(chunks, some):
        x, rest = _whole_boxes(chunks) if len(xcols) <= BOX_FEATURES else (np.zeros((len(xcols), 0, BOX_ROWS)), np.hstack(chunks))
        boxes, alike = _boxes_of(x) if x.size else None, {}
        for t, centres in some.items():
            alike.setdefault(len(centres), []).append(t)
        for k, names in alike.items():
            step = max(1, TILE[1] // k)
            for at in range(0, len(names), step):
                few = names[at:at + step]
                centres = np.stack([some[t] for t in few])
                if x.size:
                    yield from zip(few, _moved_boxes(x, boxes, centres))
                if rest.size:
                    yield from zip(few, _moved(rest, centres))

    return _added(rows, xcols, models, parts, 1 + len(xcols), of_chunks)


def _costs(rows: DataFrame | RDD, models: dict, parts: int) -> dict:
    """For each model the summed squared distances of its rows from their nearest centres, in one pass."""
    of_chunks = lambda chunks, some: ((t, np.array([[_nearest(x, c)[1].sum()]])) for x in chunks for t, c in some.items())
    xcols = [f"_x{j}" for j in range(next((c.shape[1] for c in models.values()), 1))]
    return {t: float(m[0, 0]) for t, m in _added(rows, xcols, models, parts, 1, of_chunks).items()}


def _drawn(rows: DataFrame, xcols: list[str], models: dict, seed: int, turn: int) -> dict:
    """For each model ``(class, k, restart) -> centres so far``: further rows drawn without replacement, in proportion to
    their squared distance from the centres (one, any, if there are none), in one pass."""
    of_class: dict = {}
    for t, centres in models.items():
        of_class.setdefault(t[0], []).append((t, centres, 2 * t[1] if len(centres) else 1))

    def run(batches):
        best: dict = {}
        for c, numbers, chunk in (row for batch in batches for row in zip(*(batch.column(x).to_pylist() for x in ("_cls", "numbers", "x")))):
            all_numbers, all_x = _unpacked(numbers, chunk)
            if not len(all_numbers):
                continue
            lo, hi, salted = all_x.min(axis=1), all_x.max(axis=1), {}
            for t, centres, want in of_class.get(c, ()):
                if t[1] not in salted:  # the restarts of a k share the first salts
                    salted = {t[1]: _mixed(all_numbers.astype(np.uint64), seed, *t[:2])}
                draw, old = ((_mixed(salted[t[1]], t[2], turn) >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53, best.get(t)
                number, x = all_numbers, all_x
                if old is not None and len(old) == want:  # no row of the chunk weighs more than the farthest corner from any one centre
                    far = (np.maximum(np.abs(centres - lo), np.abs(hi - centres)) ** 2).sum(axis=1).min() if len(centres) else 1.0
                    some = np.flatnonzero(draw >= np.exp(-old[-1, 0] * far) * (1 - 1e-9))
                    if not len(some):
                        continue
                    draw, number, x = draw[some], number[some], x[:, some]
                wait = -np.log(draw)  # the least of wait / weight are such a draw
                if len(centres):
                    weight = _nearest(x, centres)[1]
                    wait = np.divide(wait, weight, out=np.full(len(wait), np.inf), where=weight > 0)
                some = np.argpartition(wait, want - 1)[:want] if len(wait) > want else np.arange(len(wait))
                some = some[wait[some] < np.inf]
                new = np.column_stack([wait[some], number[some].astype(float), x[:, some].T])
                new = new if old is None else np.concatenate([old, new])
                best[t] = new[np.lexsort((new[:, 1], new[:, 0]))[:want]]
        key = np.array([t for t, m in best.items() for _ in m], dtype=np.int32).reshape(-1, 3)
        if len(key):
            m = np.concatenate([*best.values()])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*key.T, *m.T)], names=["c", "k", "i", "wait", "number", *xcols])

    schema = "c int, k int, i int, wait double, number double, " + ", ".join(f"{x} double" for x in xcols)
    order = Window.partitionBy("c", "k", "i").orderBy("wait", "number")
    found = rows.mapInArrow(run, schema).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= (F.lit(1) if turn == 0 else 2 * F.col("k"))).orderBy("c", "k", "i", "rank").toArrow()
    out: dict = {}
    for c, k, i, *x in zip(*(found.column(x).to_pylist() for x in ("c", "k", "i", *xcols))):
        out.setdefault((c, k, i), []).append(x)
    return out


def _seeded(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k centres from weighted points: k-means++ and Lloyd's iteration on the points."""
    points, weight = points[weight > 0], weight[weight > 0]
    centres = points[[rng.choice(len(points), p=weight / weight.sum())]]
    while len(centres) < k:
        cost = _nearest(points.T, centres)[1] * weight
        if not cost.sum() > 0:  # fewer different rows than clusters
            break
        centres = np.concatenate([centres, points[[rng.choice(len(points), p=cost / cost.sum())]]])
    for _ in range(30):
        own = _nearest(points.T, centres)[0]
        n = np.bincount(own, weight, len(centres))
        moved = np.stack([np.bincount(own, weight * x, len(centres)) for x in points.T], axis=1)
        moved = np.where(n[:, None] > 0, moved / np.where(n > 0, n, 1)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def _fit_all(rows: DataFrame, xcols: list[str], tasks: list[tuple], max_iter: int, tol: float, seed: int, parts: int) -> dict:
    """A fit for each ``(class, k, restart)``; ``parts`` is how many partitions of sums a pass can have."""
    d = len(xcols)
    chunks, path = _pickled(rows)
    parts = min(parts, chunks.getNumPartitions())
    centres = {t: np.zeros((0, d)) for t in tasks}
    for turn in range(1 + SEED_ROUNDS):
        # with one cluster, or no row away from the centres so far, the first row is all
        asked = {t: c for t, c in centres.items() if turn == 0 or t[1] > 1}
        for t, found in (_drawn(rows, xcols, asked, seed, turn) if asked else {}).items():
            centres[t] = np.concatenate([centres[t], np.array(found, dtype=float)])
    weights = _sums(chunks, xcols, centres, parts)
    centres = {t: _seeded(c, weights[t][:, 0], t[1], np.random.default_rng([seed, *t])) for t, c in centres.items()}
    fits, moving = {}, dict(centres)
    for turn in range(1, max_iter + 1):
        found = _sums(chunks, xcols, moving, parts)
        for t, m in found.items():
            n, old = m[:, 0], moving[t]
            new = np.where(n[:, None] > 0, m[:, 1:] / np.where(n > 0, n, 1)[:, None], old)
            still = ((new - old) ** 2).sum(axis=1).max() > tol * tol
            moving[t] = new
            if not still or turn == max_iter:
                fits[t] = (new, turn)
        moving = {t: c for t, c in moving.items() if t not in fits}
        if not moving:
            break
    cost = _costs(chunks, {t: c for t, (c, _) in fits.items()}, parts)
    steps.discard_path(rows.sparkSession, path)
    return {t: _Fit(c, cost[t], turns if t[1] > 1 else 0) for t, (c, turns) in fits.items()}


def search_silhouettes(data: DataFrame, d: int, models: dict) -> tuple[dict, dict]:
    """Mean squared-Euclidean silhouette of every model ``(class, k) -> centres`` on its class's rows, and the rows of
    each cluster, in two passes.

    ``data``: ``_cls, _x0..``.  The first pass leaves, for each partition, the sums of every cluster of every
    model; the second adds up the coefficients.  Models of fewer than two clusters with rows have none.
    """
    xcols = [f"_x{j}" for j in range(d)]
    mats = {t: np.asarray(c, dtype=float) for t, c in models.items()}

    def parts(pdf: pd.DataFrame):
        """(model, rows, nearest centres) of a batch."""
        xs, cls = pdf[xcols].to_numpy(dtype=float), pdf["_cls"].to_numpy()
        for t, centres in mats.items():
            x = xs[cls == t[0]]
            if len(x):
                yield t, x, _nearest(x.T, centres)[0]

    def sums(it):
        total = {t: np.zeros((len(c), d + 2)) for t, c in mats.items()}
        for pdf in it:
            for t, x, own in parts(pdf):
                for i, weight in enumerate((None, (x * x).sum(1), *x.T)):
                    total[t][:, i] += np.bincount(own, weight, len(total[t]))
        rows = [(t[0], t[1], j, *row) for t, m in total.items() for j, row in enumerate(m) if row[0]]
        if rows:
            yield pd.DataFrame(rows, columns=["c", "k", "j", "n", "psi", *xcols])

    columns = ["n", "psi", *xcols]
    schema = "c int, k int, j int, " + ", ".join(f"{x} double" for x in columns)
    found = data.select("_cls", *xcols).mapInPandas(sums, schema).groupBy("c", "k", "j").agg(*[F.sum(x).alias(x) for x in columns])
    whole = {t: np.zeros((len(c), d + 2)) for t, c in mats.items()}
    for r in found.collect():  # a row for each cluster of each model
        whole[r["c"], r["k"]][r["j"]] = [r[x] for x in columns]

    def scores(it):
        total = {t: np.zeros(2) for t in mats}
        for pdf in it:
            for t, x, own in parts(pdf):
                m = whole[t]
                s = silhouette_values(x, (x * x).sum(1), m[:, 0], m[:, 1], m[:, 2:], own)
                total[t] += [s.sum(), len(s)]
        rows = [(*t, *v) for t, v in total.items() if v[1]]
        if rows:
            yield pd.DataFrame(rows, columns=["c", "k", "s", "n"])

    means = (data.select("_cls", *xcols).mapInPandas(scores, "c int, k int, s double, n double").groupBy("c", "k")
             .agg((F.sum("s") / F.sum("n")).alias("s")).collect())
    counts = {t: [int(n) for n in m[:, 0]] for t, m in whole.items()}
    return {(r["c"], r["k"]): float(r["s"]) for r in means if sum(n > 0 for n in counts[r["c"], r["k"]]) > 1}, counts


def _in_order(rows: DataFrame, xcols: list[str], n: int) -> DataFrame:
    """Rows in partitions and an order that depend on their values alone, so that a seed always draws the same rows."""
    return rows.repartition(-(-n // FIT_ROWS), "_cls", *xcols).sortWithinPartitions("_cls", *xcols)


def kmeans_search(data: DataFrame, classes: list, d: int, k_choices: dict, *, n_init: int = 10,
                  max_iter: int = 300, tol: float = 1e-4, seed: int = 42, sizes: dict | None = None) -> ClusterSearch:
    """Fit every (class, k, restart) and keep, per class, the k of highest
    silhouette (first wins) with its lowest-cost restart.

    ``data``: ``_cls`` (index into ``classes``), ``_x0..`` scaled features
    without NULLs.  ``k_choices``: class index → candidate k list (one entry = fixed k).
    ``sizes``: class index → rows, if known.
    """
    spark, xcols = data.sparkSession, [f"_x{j}" for j in range(d)]
    path = steps.folder(spark, "classes")
    data.select(F.col("_cls").cast("int").alias("_cls"), *xcols).write.partitionBy("_cls").parquet(path)
    stored = spark.read.schema("_cls int, " + ", ".join(f"{x} double" for x in xcols)).parquet(path)
    sizes = sizes or {r["_cls"]: r["count"] for r in stored.groupBy("_cls").count().collect()}  # one row per class
    best: dict[tuple, _Fit] = {}
    order = [c for c in k_choices if sizes.get(c)]
    tasks = {c: [(c, k, i) for k in k_choices[c] for i in range(n_init if k > 1 else 1)] for c in order}
    rounds, centres = [], FIT_CENTRES
    for c in order:
        own = sum(k for _, k, _ in tasks[c])
        if centres + own > FIT_CENTRES:
            rounds, centres = [*rounds, []], 0
        rounds[-1].append(c)
        centres += own
    for some in rounds:
        n = sum(sizes[c] for c in some)
        rows = steps.numbered(_in_order(stored.where(F.col("_cls").isin(some)), xcols, n), "fits")
        near = rows.repartitionByRange(steps.parts(spark, n), "_cls", *xcols, steps.ROW)  # partitions of neighbouring rows
        packed = steps.table(_packed(near, xcols), "packed")
        found_all = _fit_all(packed, xcols, [t for c in some for t in tasks[c]], max_iter, tol, seed, -(-n // FIT_ROWS))
        for (c, k, _), found in sorted(found_all.items(), key=lambda x: x[0]):
            if (c, k) not in best or found.inertia < best[c, k].inertia:
                best[c, k] = found
        steps.discard(rows, packed)
    scores, counts = search_silhouettes(stored, d, {t: f.centres for t, f in best.items()})
    steps.discard_path(spark, path)

    out = ClusterSearch({}, {}, {}, {}, {}, {}, [])
    for c in order:
        chosen, top = None, -1.0
        for k in k_choices[c]:
            found, s = best[c, k], scores.get((c, k))
            out.scores.append((classes[c], k, s, found.inertia, found.n_iter))
            if chosen is None or (s is not None and s > top):
                chosen, top = k, s if s is not None else top
        found, name = best[c, chosen], classes[c]
        out.centres[name], out.k[name] = found.centres.tolist(), len(found.centres)
        out.inertia[name], out.n_iter[name] = found.inertia, found.n_iter
        out.silhouette[name] = scores.get((c, chosen)) or 0.0
        out.counts[name] = counts[c, chosen]
    return out
