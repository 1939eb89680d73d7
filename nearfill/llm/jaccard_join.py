"""N-gram Jaccard join: documents whose 5-word shingle sets are alike, and their components.

Texts are read in ASCII lower case as words ``[^\\x20\\x09-\\x0D]+``; a document's
set holds its distinct shingles of ``k`` words as 64-bit hashes (one shingle of
the whole sequence if there are fewer words).  Two sets link when
``100 * |A n B| >= percent * |A u B|``.

Method
  1. One pass over the texts gives each document its set's size, a 128-bit
     digest and its smallest hashes (the prefix).  Documents with equal digests
     are one class; everything after works on classes.
  2. Linked sets share at least ``min(c_A, c_B)`` tokens of their prefixes, where
     a prefix has ``n - ceil(t n) + c`` tokens and ``c = 1 + n // 16``.  Tokens of
     a single class go, counted exactly over all classes; then each class drops
     its ``c(ceil(t n)) - 1`` most frequent tokens.  The rarest shared token of a
     linked pair survives on both sides, so no link is lost, and lines or passages
     that very many documents share no longer bring them together.
  3. Classes with a common token meet in size-banded tiles: bands of ratio 1/t,
     tile b holding bands b and b + 1.  In three rounds every member meets one
     chosen member of its tile that is in another component.  Then only tiles whose members are still in different components
     compare members across components: small tiles by an equi-join that counts the
     tokens a pair has in common (which bounds the overlap from above too), large
     ones in blocks.
  4. A pair is tested by hashed bitmaps of 4n or more bits first:
     ``|A n B| <= n_A - popcount(A & ~B)`` (and the same for B).  What passes is
     decided by intersecting the sorted hash arrays.

Pairs within one component are not all listed (a group of m near copies has
m*m/2): components are what the join returns.

Defined results: a null or empty text, or one without words, has an empty set
and links with nothing; a null key links with nothing and has a null component;
repeated rows are one document; a key with several different texts links what
any of its texts links (``keep_one`` treats these texts as documents of their own);
an empty table gives an empty table.  Columns other than
key and text are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import graph, stages, textbytes

#: Members of a large tile's block; two blocks are compared in one step.
BLOCK = 512
#: Tiles up to this size are joined pair by pair, larger ones block by block; the pairs found are the same.
SMALL_TILE = 64
_PREFIXES = "id long, x long, n int, d1 long, d2 long, prefix array<long>"
_SETS = "c long, n int, bits binary, tokens array<long>"


def _least_overlap(n, percent: int):
    """ceil(percent / 100 * n), in integers."""
    return -((-n * percent) // 100)


def _slack(n):
    return 1 + n // 16


def _prefix_size(n: int, percent: int) -> int:
    return min(n, n - _least_overlap(n, percent) + _slack(n))


def bitmap(tokens: np.ndarray) -> bytes:
    """Bitmap of a set: the low bits of each hash in a power of two of at least 4n bits."""
    width = max(64, 1 << int(4 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """OR a bitmap of 64-bit words down to ``words`` words (both powers of two)."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def overlap_bound(n_a: int, bits_a: np.ndarray, n_b: int, bits_b: np.ndarray) -> int:
    """No two sets with these sizes and bitmaps (64-bit words) share more tokens than this."""
    w = min(len(bits_a), len(bits_b))
    a, b = _fold(bits_a, w), _fold(bits_b, w)
    only_a = int(np.bitwise_count(a & ~b).sum())
    only_b = int(np.bitwise_count(b & ~a).sum())
    return min(n_a - only_a, n_b - only_b)


def _needed(n_a, n_b, percent: int):
    """Smallest overlap with ``100 * i >= percent * (n_a + n_b - i)``."""
    return -(-(percent * (n_a + n_b)) // (100 + percent))


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(tokens.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _list_array(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).view(np.int64)))


def _prefixes(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in textbytes.slices(batch.column("text")):
                n, low, high, prefix = [], [], [], []
                for s in textbytes.shingle_sets(t, k):
                    d1, d2 = _digest(s)
                    n.append(len(s))
                    low.append(d1)
                    high.append(d2)
                    prefix.append(s[:_prefix_size(len(s), percent)])
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(t.first, t.count), batch.column("x").slice(t.first, t.count), pa.array(n, pa.int32()),
                    pa.array(low, pa.int64()), pa.array(high, pa.int64()), _list_array(prefix)], names=["id", "x", "n", "d1", "d2", "prefix"])
    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in textbytes.slices(batch.column(1)):
                found, rows = [], []
                for i, s in enumerate(textbytes.shingle_sets(t, k), t.first):
                    if _digest(s) == (batch.column(2)[i].as_py(), batch.column(3)[i].as_py()):
                        found.append(s)
                        rows.append(i)
                if rows:
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(rows)), pa.array([len(s) for s in found], pa.int32()),
                        pa.array([bitmap(s) for s in found], pa.binary()), _list_array(found)],
                        names=["c", "n", "bits", "tokens"])
    return run


def _bound(percent: int):
    """Keep pairs whose sizes and bitmaps leave enough overlap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("na", "nb"))
            need = _needed(n_a, n_b, percent)
            fit = np.flatnonzero(np.minimum(n_a, n_b) >= need).tolist()
            bits_a, bits_b = batch.column("ba"), batch.column("bb")
            keep = [i for i in fit if overlap_bound(
                n_a[i], np.frombuffer(bits_a[i].as_buffer(), np.uint64),
                n_b[i], np.frombuffer(bits_b[i].as_buffer(), np.uint64)) >= need[i]]
            yield batch.select(["x", "y", "hits", "a", "b"]).take(pa.array(keep, pa.int64()))
    return run


def _exact(percent: int):
    """Keep pairs whose sorted token arrays overlap enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, cols = [], []
            for name in ("ta", "tb"):
                col = batch.column(name)
                cols.append((col.flatten().to_numpy().view(np.uint64), np.asarray(col.offsets) - col.offsets[0].as_py()))
            (va, oa), (vb, ob) = cols
            for i in range(batch.num_rows):
                x, y = va[oa[i]:oa[i + 1]], vb[ob[i]:ob[i + 1]]
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                if int((y[at] == x).sum()) >= _needed(len(x), len(y), percent):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
    return run


def _padded(lists: pa.ChunkedArray) -> np.ndarray:
    """Sorted lists as rows of one matrix, filled up with the largest integer."""
    col = lists.combine_chunks()
    ends = np.asarray(col.offsets)
    size = np.diff(ends)
    out = np.full((len(size), int(size.max())), np.iinfo(np.int64).max)
    out[np.arange(out.shape[1]) < size[:, None]] = np.asarray(col.values)[ends[0]:ends[-1]]
    return out


def _tile_pairs(percent: int):
    """Pairs across components of two blocks of one tile that sizes and bitmaps allow.

    A pair is found in several tiles; it is returned in that of its smallest common token.
    """
    def run(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        token, tile = key[0].as_py(), key[1].as_py()
        side = np.asarray(block["side"])
        c, comp, n, band = (np.asarray(block[x]).astype(np.int64) for x in ("c", "comp", "n", "band"))
        maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in block["bits"]]
        width = min(len(m) for m in maps)
        maps = np.stack([_fold(m, width) for m in maps])
        own = _padded(block["own"])
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side >= 1)  # side 1: both, a block with itself
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left.tolist():
            need = _needed(n[i], n[right], percent)
            j = right[(comp[right] != comp[i]) & (np.minimum(n[right], n[i]) >= need) & ((side[i] != 1) | (c[right] > c[i]))
                      & (np.minimum(band[right], band[i]) == tile)]
            if not len(j):
                continue
            only_i = np.bitwise_count(maps[i] & ~maps[j]).sum(axis=1, dtype=np.int64)
            only_j = np.bitwise_count(maps[j] & ~maps[i]).sum(axis=1, dtype=np.int64)
            j = j[np.minimum(n[i] - only_i, n[j] - only_j) >= _needed(n[i], n[j], percent)]
            if not len(j):
                continue
            common = own[i][np.minimum(np.searchsorted(own[i], own[j]), own.shape[1] - 1)] == own[j]
            j = j[own[j, common.argmax(axis=1)] == token]
            out_a.append(np.minimum(c[i], c[j]))
            out_b.append(np.maximum(c[i], c[j]))
        return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})
    return run


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def classes(docs: DataFrame, k: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text"
            ) -> tuple[DataFrame, DataFrame]:
    """Step 1: (rows (id, x, n, d1, d2), classes (c, rep, d1, d2, n, prefix)), both as tables; x is a hash of the text."""
    read = docs.select(F.col(key).cast("long").alias("id"), _text_hash(F.col(text)).alias("x"), F.col(text).cast("string").alias("text"))
    full = stages.table(read.mapInArrow(_prefixes(k, percent), _PREFIXES), "prefixes")
    rows = stages.table(full.select("id", "x", "n", "d1", "d2"), "rows")
    found = stages.table(full.where("n > 0 and id is not null").groupBy("d1", "d2", "n")
                         .agg(F.min("id").alias("rep"), F.first("prefix").alias("prefix"))
                         .withColumn("c", F.monotonically_increasing_id()), "classes")
    stages.discard(full)
    return rows, found


def _dropped(n, percent: int):
    """Most frequent tokens that a class of n drops: c(ceil(t n)) - 1."""
    return F.floor(F.ceil(n * percent / 100) / 16)


def shared_tokens(found: DataFrame, percent: int = 75) -> DataFrame:
    """Step 2: (c, n, token) of every class, without tokens of one class and without its most frequent ones."""
    tokens = found.select("c", "n", F.explode("prefix").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    order = Window.partitionBy("c").orderBy(F.desc("df"), F.desc("token"))
    return (tokens.join(often, "token").withColumn("place", F.row_number().over(order))
            .where(F.col("place") > _dropped(F.col("n"), percent)).select("c", "n", "token"))


def _tiles(shared: DataFrame, percent: int) -> DataFrame:
    """(c, n, band, token, tile): band b stands in the tiles b - 1 and b."""
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-12).cast("int")
    return (shared.withColumn("band", band)
            .select("c", "n", "band", "token", F.explode(F.array(F.col("band") - 1, "band")).alias("tile")))


def _with_component(tiles: DataFrame, component: DataFrame | None) -> DataFrame:
    if component is None:
        return tiles.withColumn("comp", F.col("c"))
    return (tiles.join(component.withColumnRenamed("node", "c"), "c", "left")
            .withColumn("comp", F.coalesce("component", "c")).drop("component"))


def _open_tiles(members: DataFrame, salt: int) -> DataFrame:
    """Tiles with members of more than one component, their size, and one member: the first by a salted hash.

    At first a group's tiles choose alike, so that few pairs connect most of it; later ones (salt over 0)
    choose by token too, so that a member still apart meets as many others as it has tokens.
    """
    by = F.xxhash64("c", F.lit(salt)) if not salt else F.xxhash64("c", "token", F.lit(salt))
    one = F.min(F.struct(by.alias("o"), "c", "comp"))
    return (members.groupBy("token", "tile")
            .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"), one.alias("one"))
            .where("lo < hi").select("token", "tile", "size", F.col("one.c").alias("a"), F.col("one.comp").alias("comp_a")))


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y, hits, a, b) that sizes and bitmaps allow."""
    side = sets.select("c", "n", "bits")
    met = pairs.join(side.toDF("a", "na", "ba"), "a").join(side.toDF("b", "nb", "bb"), "b")
    return met.mapInArrow(_bound(percent), "x long, y long, hits long, a long, b long")


def _star_pairs(members: DataFrame, sets: DataFrame, percent: int, salt: int) -> DataFrame:
    """Pairs of a tile's chosen member with its members of other components, one for each pair of components."""
    met = (members.join(_open_tiles(members, salt), ["token", "tile"]).where("comp <> comp_a")
           .groupBy(F.least("comp", "comp_a").alias("x"), F.greatest("comp", "comp_a").alias("y"), "a", F.col("c").alias("b"))
           .agg(F.count(F.lit(1)).alias("hits")))
    return (_bounded(met, sets, percent).groupBy("x", "y").agg(F.max(F.struct("hits", "a", "b")).alias("p"))
            .select("p.a", "p.b"))


def _small_tile_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y, hits, a, b) across components that meet in small tiles, if their common tokens leave enough overlap.

    Common tokens of a pair are hits, dropped ones, tokens of large tiles, or
    outside the prefix of the class whose prefix ends first.
    """
    size = F.col("n") - F.least(F.col("n"), F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 + F.floor(F.col("n") / 16))
    large = (members.where(F.col("size") > SMALL_TILE).groupBy("c").agg(F.count_distinct("token").alias("large")))
    m = (members.where(F.col("size") <= SMALL_TILE).join(large, "c", "left")
         .select("token", "tile", "c", "comp", "n", "band", F.coalesce("large", F.lit(0)).alias("large"),
                 size.alias("rest"), _dropped(F.col("n"), percent).alias("drop")))
    z = m.select("token", "tile", *[F.col(c).alias(f"{c}_z") for c in m.columns[2:]])
    need = F.ceil((F.col("n") + F.col("n_z")) * percent / (100 + percent))
    pairs = (m.join(z, ["token", "tile"])
             .where((F.col("c") < F.col("c_z")) & (F.col("comp") != F.col("comp_z")) & (F.least("n", "n_z") >= need)
                    & (F.col("tile") == F.least("band", "band_z"))))
    most = F.greatest("drop", "drop_z") + F.least("large", "large_z") + F.greatest("rest", "rest_z")
    return (pairs.groupBy("c", "c_z").agg(
                F.count(F.lit(1)).alias("hits"), F.first(most).alias("most"), F.first(need).alias("need"),
                F.first(F.least("comp", "comp_z")).alias("x"), F.first(F.greatest("comp", "comp_z")).alias("y"))
            .where("hits + most >= need").select("x", "y", "hits", F.col("c").alias("a"), F.col("c_z").alias("b")))


def _large_tile_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components of large tiles that sizes and bitmaps allow.

    A tile's largest component is cut into blocks, as are its other members: blocks
    of the one meet blocks of the others, and the others' blocks meet each other;
    members of the largest component never meet among themselves.
    """
    large = members.where(F.col("size") > SMALL_TILE)
    on = ["token", "tile"]
    main = (large.groupBy(*on, "comp").agg(F.count(F.lit(1)).alias("n_comp")).groupBy(*on)
            .agg(F.max(F.struct("n_comp", "comp")).alias("top"), F.sum("n_comp").alias("n_all"))
            .select(*on, F.col("top.comp").alias("main"), F.ceil(F.col("top.n_comp") / BLOCK).cast("int").alias("main_blocks"),
                    F.ceil((F.col("n_all") - F.col("top.n_comp")) / BLOCK).cast("int").alias("blocks")))
    place = lambda n: F.pmod(F.xxhash64("c"), F.col(n)).cast("int")
    each = lambda n, f: F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)
    at = lambda kind, p, q, side: F.struct(F.lit(kind).alias("kind"), p.alias("p"), q.alias("q"), side.alias("side"))
    own, zero, two = F.col("part"), F.lit(0), F.lit(2)
    among = each("blocks", lambda x: at(1, F.least(own, x), F.greatest(own, x), F.when(own == x, 1).when(own < x, 0).otherwise(2)))
    spots = F.when(F.col("comp") == F.col("main"), each("blocks", lambda x: at(0, own, x, zero))).otherwise(
        F.concat(each("main_blocks", lambda x: at(0, x, own, two)), among))
    lists = large.groupBy("c").agg(F.array_sort(F.collect_set("token")).alias("own"))
    m = (large.join(main, on)
         .withColumn("part", F.when(F.col("comp") == F.col("main"), place("main_blocks")).otherwise(place("blocks")))
         .join(sets.select("c", "bits").join(lists, "c"), "c")
         .withColumn("spot", F.explode(spots))
         .select(*on, "spot.kind", "spot.p", "spot.q", "spot.side", "c", "comp", "n", "band", "bits", "own"))
    return m.groupBy(*on, "kind", "p", "q").applyInArrow(_tile_pairs(percent), "a long, b long")


def _cross_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Every pair across components with a common tile that may link."""
    opened = stages.table(members.join(_open_tiles(members, 0).select("token", "tile", "size"), ["token", "tile"]), "open")
    small = _bounded(_small_tile_pairs(opened, percent), sets, percent).select("a", "b")
    return small.unionByName(_large_tile_pairs(opened, sets, percent)).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("c").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("c").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(_exact(percent), "a long, b long")


def class_links(docs: DataFrame, found: DataFrame, k: int = 5, percent: int = 75,
                key: str = "doc_id", text: str = "text", star_rounds: int = 3) -> DataFrame:
    """Steps 2 to 4: (node, component) of the classes that link with another one."""
    shared = stages.table(shared_tokens(found, percent), "tokens")
    reps = found.join(shared.select("c").distinct(), "c", "left_semi").select("c", F.col("rep").alias("id"), "d1", "d2")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sets = stages.table(reps.join(texts, "id").select("c", "text", "d1", "d2").mapInArrow(_full_sets(k), _SETS), "sets")
    tiles = _tiles(shared, percent)
    links = component = None
    for step in range(star_rounds + 1):
        members = _with_component(tiles, component)
        pairs = _star_pairs(members, sets, percent, step) if step < star_rounds else _cross_pairs(members, sets, percent)
        new = stages.table(_verified(pairs, sets, percent), "links")
        if step and new.isEmpty():
            continue
        links = new if links is None else links.unionByName(new)
        component = graph.components(links)
    return component


def _components(docs: DataFrame, k: int, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, (c, component) of every class that has words)."""
    rows, found = classes(docs, k, percent, key, text)
    label = class_links(docs, found, k, percent, key, text)
    named = found.join(label, found.c == label.node, "left").select("c", "rep", "d1", "d2", F.coalesce("component", "c").alias("component"))
    return rows, found, stages.table(named, "named")


def _same_key(rows: DataFrame, named: DataFrame) -> DataFrame | None:
    """Links (a, b) between the components that texts of one key are in; None if no key has different texts."""
    texts = rows.where("n > 0 and id is not null")
    several = stages.table(texts.groupBy("id").agg(*[f("d1") for f in (F.min, F.max)], *[f("d2") for f in (F.min, F.max)])
                           .toDF("id", "a1", "b1", "a2", "b2").where("a1 <> b1 or a2 <> b2").select("id"), "several")
    if several.isEmpty():
        return None
    of = texts.join(several, "id").join(named.select("d1", "d2", "component"), ["d1", "d2"]).select("id", "component").distinct()
    least = of.groupBy("id").agg(F.min("component").alias("a"))
    return of.join(least, "id").select("a", F.col("component").alias("b")).where("a <> b").distinct()


def components(docs: DataFrame, k: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: (key, n_shingles, component_id); see the module's docstring."""
    rows, _, named = _components(docs, k, percent, key, text)
    more = _same_key(rows, named)
    if more is not None:
        joined = graph.components(more).toDF("component", "joined")
        named = named.join(joined, "component", "left").withColumn("component", F.coalesce("joined", "component")).drop("joined")
    low = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(low, "component").select("d1", "d2", "component_id")
    return (rows.select("id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
            .select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each group of linked texts left (its smallest key), all columns as they were.

    Different texts of one key are documents of their own here: a text goes only if the group that it is linked with keeps a row.
    Of several rows with one key and text the first by the hash of its columns stays; rows with a null key all stay.
    """
    rows, _, named = _components(docs, k, percent, key, text)
    placed = rows.where("id is not null").join(named.select("d1", "d2", "component"), ["d1", "d2"], "left")
    alone = placed.where("component is null").select("id", "x").distinct()
    heads = (placed.where("component is not null").groupBy("component").agg(F.min(F.struct("id", "x")).alias("h"))
             .select("h.id", "h.x").unionByName(alone).toDF("__head", "__x"))
    order = Window.partitionBy("__head", "__x").orderBy("__row")
    kept = (docs.join(heads, (docs[key].cast("long") == heads["__head"]) & (_text_hash(docs[text]) == heads["__x"]))
            .withColumn("__row", F.xxhash64(*[F.col(c) for c in docs.columns]))
            .withColumn("__place", F.row_number().over(order)).where("__place = 1").select(*docs.columns))
    return kept.unionByName(docs.where(F.col(key).isNull()))
