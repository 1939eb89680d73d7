"""Mixing sources to target weights by Pfair scheduling, in Spark expressions only.

A source's documents, in a seeded hash order, are cut into blocks.  Its target
weight is a whole number of ``parts`` out of ``PERIOD``.  Block j of a source of weight w
(parts / period) is released at slot ``floor(j / w)`` and due by slot
``ceil((j + 1) / w)``; each slot goes to the released block with the earliest
deadline (ties: the source that comes first by name).  So after any number of slots
t a source has had within less than one block of ``t * w``.  The windows repeat
every period, so one period is scheduled, as a fold over its slots, and
repeated.

Sources whose weight is less than one part share the parts of a group, and the
turns of a group are scheduled among its members in the same way, in a period of
their own and to any depth; a member's slot follows from the slots of its groups.
If all of them weigh less than one part, their group has one and leaves the turns
empty that are too many.  So the number of sources is free, and each keeps its weight.

All documents are used: the mix ends with the slot in which the last source has
given each of its blocks once, and sources that are through earlier begin again
(an epoch), at most ``max_epochs`` times in all.  After that a source leaves its
slots empty, and the others keep theirs.

Target weights come from the caller, or are the sources' document counts to the
power ``alpha``, which flattens them.

Defined results: documents without a source are one source of their own; ids and
texts may be null; repeated rows are documents of their own (rows that are equal
in every column are interchangeable); an empty table gives an empty table; a
source that the caller gives no weight raises ValueError, as do several sources
in a period of less than two slots.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PERIOD = 1000
BLOCK_DOCS = 64
MAX_EPOCHS = 4
ALPHA = 0.9
#: Parts of a period that a group of small sources has, about, if there are enough of them.
_GROUP_PARTS = 32
#: Plans of more sources are joined without a broadcast hint.
_BROADCAST_SOURCES = 10_000
#: Hash ranges that a source's documents are ranked in; a range is one window group.
_RANGES = 4096


def _name(source: str) -> Column:
    """A source's name, never null: null and text sources can't clash."""
    return F.coalesce(F.concat(F.lit("s:"), F.col(source).cast("string")), F.lit("null"))


def _counts(docs: DataFrame, source: str) -> DataFrame:
    return docs.groupBy(_name(source).alias("src")).agg(F.count(F.lit(1)).alias("docs"))


def _shares(counts: DataFrame, weights: dict[str | None, int] | None, alpha: float, period: int) -> list[tuple[str, int, float]]:
    """(source, documents, share) by name, one row per source."""
    rows = counts.orderBy("src").collect()
    if len(rows) > 1 and period < 2:
        raise ValueError(f"{len(rows)} sources need a period of two slots at least")
    if weights is None:
        return [(r.src, r.docs, float(r.docs) ** alpha) for r in rows]
    wanted = {"null" if k is None else f"s:{k}": v for k, v in weights.items()}
    lacking = [r.src for r in rows if wanted.get(r.src, 0) <= 0]
    if lacking:
        raise ValueError(f"{len(lacking)} sources have no positive weight")
    return [(r.src, r.docs, float(wanted[r.src])) for r in rows]


def _parts(share: list[float], period: int) -> list[int]:
    """Whole parts of a period, one at least for each share."""
    total = sum(share)
    parts = [max(1, int(period * s / total)) for s in share]
    order = sorted(range(len(share)), key=lambda i: (parts[i] - period * share[i] / total, i))
    at = 0
    while sum(parts) < period:  # largest remainder first
        parts[order[at % len(share)]] += 1
        at += 1
    while sum(parts) > period:  # the part of a group that weighs less is taken from the largest
        parts[max(range(len(share)), key=lambda i: parts[i])] -= 1
    return parts


def _groups(tail: list[tuple[float, int | None]], part: float, least: int) -> list[list[tuple[float, int | None]]]:
    """``tail`` in order, cut into at least ``least`` groups of about _GROUP_PARTS parts."""
    weight = sum(s for s, _ in tail)
    n = max(least, int(weight / part) // _GROUP_PARTS)
    groups: list[list] = [[] for _ in range(n)]
    before = 0.0
    for s, i in tail:
        groups[min(n - 1, int((before + s / 2) / weight * n))].append((s, i))
        before += s
    return [g for g in groups if g]


def _tree(share: list[float], period: int) -> tuple[list[list[tuple[int, int | None, int | None]]], int]:
    """(nodes, levels): a node, the first one being the root, lists its members as (parts, source, node);
    neither source nor node stands for turns that stay empty."""
    todo: list[tuple[int, list]] = [(1, [(s, i) for i, s in enumerate(share)])]
    nodes, levels = [], 1
    for level, items in todo:  # grows
        levels = max(levels, level)
        total = sum(s for s, _ in items)
        head = [x for x in items if period * x[0] / total >= 1]
        tail = [x for x in items if period * x[0] / total < 1]
        members = [(s, i, None) for s, i in head]
        for group in _groups(tail, total / period, 1 if head else 2) if tail else []:
            weight = sum(s for s, _ in group)
            if any(i is not None for _, i in group) and weight < total / period:
                group = [*group, (total / period - weight, None)]
            if len(group) == 1:
                members.append((*group[0], None))
            else:
                members.append((max(weight, total / period), None, len(todo)))
                todo.append((level + 1, group))
        nodes.append([(p, i, n) for p, (_, i, n) in zip(_parts([m[0] for m in members], period), members)])
    return nodes, levels


def _schedule(share: Column, period: int) -> Column:
    """Earliest-deadline-first over one period: the number of the member that has each slot."""
    def slot(state: Column, t: Column) -> Column:
        due = F.transform(state["next"], lambda k, i: F.when(
            (k < F.get(share, i)) & (F.floor(k * period / F.get(share, i)) <= t),
            F.struct(F.ceil((k + 1) * period / F.get(share, i)).alias("deadline"), i.alias("source"))))
        after = F.transform(F.array(F.array_min(due)["source"]), lambda pick: F.struct(  # bound, so that it is found once a slot
            F.transform(state["next"], lambda k, i: F.when(i == pick, k + 1).otherwise(k)).alias("next"),
            F.concat(state["slots"], F.array(pick)).alias("slots")))
        return F.get(after, 0)

    start = F.struct(F.transform(share, lambda p: F.lit(0)).alias("next"), F.array().cast("array<int>").alias("slots"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, slot, lambda state: state["slots"])


def schedule(counts: DataFrame, weights: dict[str | None, int] | None = None, alpha: float = ALPHA,
             block_docs: int = BLOCK_DOCS, max_epochs: int = MAX_EPOCHS, period: int = PERIOD) -> DataFrame:
    """One row per source: (src, blocks, total, path); ``total`` blocks in all epochs, ``path`` the (parts, slots of a
    period) of its groups, the outermost first, and its own."""
    sources = _shares(counts, weights, alpha, period)
    spark = counts.sparkSession
    if not sources:
        return spark.sql("SELECT '' AS src, 1L AS blocks, 1L AS total, array(struct(1 AS parts, array(0) AS slots)) AS path WHERE false")
    tree, levels = _tree([s for _, _, s in sources], period)
    rows = [{"at": at, "share": [p for p, _, _ in members], "members": [
        {"parts": p, "node": n} | ({} if i is None else {"src": sources[i][0], "blocks": -(-sources[i][1] // block_docs)})
        for p, i, n in members]} for at, members in enumerate(tree)]
    shape = "array<struct<at:int,share:array<int>,members:array<struct<parts:int,node:int,src:string,blocks:bigint>>>>"
    nodes = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), shape)))
    if len(rows) > 1:
        nodes = nodes.repartition("at")
    every = (nodes.select("at", "members", _schedule(F.col("share"), period).alias("plan"))
             .select("at", "plan", F.posexplode("members").alias("number", "m")))
    own = F.filter(F.transform("plan", lambda s, t: F.when(s == F.col("number"), t)), lambda t: t.isNotNull())
    steps = every.select("at", "m.node", "m.src", "m.blocks", F.struct("m.parts", own.alias("slots")).alias("step"))
    found = steps.where("at = 0").select("src", "blocks", "node", F.array("step").alias("path"))
    plan = found.where("src IS NOT NULL")
    for _ in range(levels - 1):
        outer = found.where("node IS NOT NULL").select(F.col("node").alias("at"), F.col("path").alias("above"))
        found = outer.join(steps, "at").select("src", "blocks", "node", F.concat("above", F.array("step")).alias("path"))
        plan = plan.unionByName(found.where("src IS NOT NULL"))
    plan = plan.select("src", "blocks", "path")
    length = F.max(_slot(F.col("blocks") - 1, period) + 1).over(Window.partitionBy())  # one row per source
    plan = plan.withColumn("length", length)
    given = F.aggregate("path", F.col("length"), lambda n, s: (
        F.floor(n / period) * s["parts"] + F.size(F.filter(s["slots"], lambda t: t < F.pmod(n, F.lit(period))))).cast("long"))
    plan = plan.select("src", "blocks", F.least(given, F.col("blocks") * max_epochs).alias("total"), "path")
    return F.broadcast(plan) if len(sources) <= _BROADCAST_SOURCES else plan


def _slot(turn: Column, period: int, path: str = "path") -> Column:
    """Slot of a source's block number ``turn``, counted over all epochs: its turn in its group is the group's turn, and so on."""
    return F.aggregate(F.reverse(path), turn.cast("long"), lambda t, s: (
        F.floor(t / s["parts"]) * period + F.get(s["slots"], F.pmod(t, s["parts"]).cast("int"))).cast("long"))


def _ranked(docs: DataFrame, source: str, key: str, seed: int) -> DataFrame:
    """``docs`` with __src and __rank, the place (from 0) in the source's hash order, without one window over a source."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    named = (docs.withColumn("__src", _name(source)).withColumn("__hash", digest)
             .withColumn("__range", F.conv(F.substring("__hash", 1, 3), 16, 10).cast("int"))
             .withColumn("__row", F.xxhash64(*[F.col(c) for c in docs.columns])))
    before = Window.partitionBy("__src").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offset = (named.groupBy("__src", "__range").agg(F.count(F.lit(1)).alias("__n"))  # at most _RANGES rows per source
              .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    order = Window.partitionBy("__src", "__range").orderBy("__hash", "__row")
    return (named.join(offset, ["__src", "__range"])
            .withColumn("__rank", F.col("__before") + F.row_number().over(order) - 1)
            .drop("__hash", "__range", "__row", "__before"))


def positions(docs: DataFrame, weights: dict[str | None, int] | None = None, alpha: float = ALPHA,
              block_docs: int = BLOCK_DOCS, max_epochs: int = MAX_EPOCHS, period: int = PERIOD,
              key: str = "doc_id", source: str = "source", seed: int = 17) -> DataFrame:
    """``docs``, a row for each epoch, with __src, __block, __epoch, __slot (the block's) and __place (within the block)."""
    plan = schedule(_counts(docs, source), weights, alpha, block_docs, max_epochs, period)
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    block = F.floor(F.col("__rank") / block_docs)
    epochs = F.floor((F.col("__total") - 1 - F.col("__block")) / F.col("__blocks"))  # the last epoch that has the block
    turn = F.col("__epoch") * F.col("__blocks") + F.col("__block")
    return (_ranked(docs, source, key, seed).withColumn("__block", block)
            .join(plan, "__src")
            .withColumn("__epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs)))
            .withColumn("__slot", _slot(turn, period, "__path")).withColumn("__place", F.pmod(F.col("__rank"), F.lit(block_docs)).cast("long"))
            .drop("__blocks", "__total", "__path", "__rank"))


def mix(docs: DataFrame, weights: dict[str | None, int] | None = None, alpha: float = ALPHA,
        block_docs: int = BLOCK_DOCS, max_epochs: int = MAX_EPOCHS, period: int = PERIOD,
        key: str = "doc_id", source: str = "source", seed: int = 17) -> DataFrame:
    """The documents in mixed order, a row for each epoch, all columns as they were."""
    return (positions(docs, weights, alpha, block_docs, max_epochs, period, key, source, seed)
            .orderBy("__slot", "__place").select(*docs.columns))
