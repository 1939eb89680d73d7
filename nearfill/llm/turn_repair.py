"""Conversation structure repair: the cheapest edits that give a conversation the roles ``(s?(ua)+)?``.

Rows of a conversation stand in order of (turn, nulls first; role; SHA-256 of the text).
A row's first fault counts: blank (nothing but white space), duplicate (role and
text seen earlier in the conversation), truncated (the last character that is not white space is none of ``.!?``).

Edits: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty turn of user or
assistant 5.  Blank and duplicate rows must be deleted; a truncated row that stays costs 5 more.
A repaired conversation is empty, or an optional system turn and then pairs of
user and assistant, told by the roles' first letters.  Of equally cheap edits the
sequence of initials (D, I, K, R) that is least in ASCII is taken.

Method (Four Russians)
  * A row is a symbol: whether it must go, else its role's letter and whether it is truncated.
    The state is what was emitted last (nothing, s, u, a).  A vector holds the
    costs from the four states to the end, less its minimum; few such vectors exist.
  * For every vector and every block of ``BLOCK`` symbols the vector before the block and the cost
    that the block adds are computed once.  A conversation is walked from its end, a lookup for each block.
  * Tracing goes from the start: each block is expanded backward from the vector
    behind it, and the least initial that loses nothing is taken at each step, so ties
    cannot mislead it.  Expanded blocks are kept and used again.

Scale
  * Faults, first occurrences, turn gaps and multiplicities are Spark aggregates over rows without texts.
  * A sort by range deals every conversation over as many tasks as it has ranges; each range
    leaves one byte a row.  A conversation's bytes then meet in one task, in the size of its audit, a cell of the result.
  * Texts are read once more, sorted by conversation behind its audit, and streamed: a task holds a batch of rows,
    never a conversation.  A SHA-256 over a conversation is a chain, so its rows go through one task.

Defined results: a null role or text is one space; a null conversation id is a conversation of its own; rows that are
equal in all columns are adjacent duplicates; a conversation without rows has zeros, an empty audit
and no repaired rows; an empty table gives an empty table.  Other columns than the four are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import stages

BLOCK = 4
DELETE, RETELL, INSERT, TRUNCATED = 2, 1, 5, 5
#: Codes of a row: its role's letter (s, u, a, other) and its first fault.
LETTERS = ("s", "u", "a")
OK, CUT, BLANK, COPY = range(4)
#: States: nothing emitted, s, u, a; the state after the next user or assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_END = (0, 10, 5, 0)
#: What Keep emits: (state, letter) to state.
_KEEP = {(EMPTY, 0): SYSTEM, (EMPTY, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
#: Symbols: 0 must be deleted, else 1 + 2 * letter + truncated.
SYMBOLS = 9
_SYMBOL_OF = np.array([[1 + 2 * letter + fault if fault <= CUT else 0 for fault in range(4)] for letter in range(4)], np.uint8).ravel()
_WHITE = "\t\n\x0b\x0c\r "


def step(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to the end from the four states before a row, given those behind it."""
    cost = [DELETE + c for c in after]
    if symbol:
        letter, extra = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
        for state in range(4):
            cost[state] = min(cost[state], RETELL + extra + after[_NEXT[state]])
            if (state, letter) in _KEEP:
                cost[state] = min(cost[state], extra + after[_KEEP[state, letter]])
    cost[USER], cost[ASSISTANT] = min(cost[USER], INSERT + cost[ASSISTANT]), min(cost[ASSISTANT], INSERT + cost[USER])
    return (min(cost[EMPTY], INSERT + cost[USER]), min(cost[SYSTEM], INSERT + cost[USER]), cost[USER], cost[ASSISTANT])


class Tables:
    """All normalised vectors and their transitions over one symbol and over every block of ``BLOCK`` symbols."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = [_END]
        place, one, gain = {_END: 0}, [], []
        for v in self.vectors:  # grows while it is walked
            row = []
            for symbol in range(SYMBOLS):
                new = step(v, symbol)
                low = min(new)
                new = tuple(c - low for c in new)
                if new not in place:
                    place[new] = len(self.vectors)
                    self.vectors.append(new)
                row.append((place[new], low))
            one.append([r[0] for r in row])
            gain.append([r[1] for r in row])
        self.one, self.one_cost = np.array(one, np.int32), np.array(gain, np.int32)
        # a block's code reads its symbols as digits, the first row's highest; rows are walked from the last one
        n = len(self.vectors)
        state, cost = np.repeat(np.arange(n, dtype=np.int32)[:, None], SYMBOLS ** BLOCK, axis=1), np.zeros((n, SYMBOLS ** BLOCK), np.int32)
        codes = np.arange(SYMBOLS ** BLOCK)
        for i in range(BLOCK):
            digit = np.broadcast_to(codes // SYMBOLS ** i % SYMBOLS, state.shape)
            cost += self.one_cost[state, digit]
            state = self.one[state, digit]
        self.block, self.block_cost = state.tolist(), cost.tolist()
        self._expanded: dict[tuple[int, int, bytes], tuple[str, int]] = {}

    def expand(self, state: int, behind: int, symbols: bytes) -> tuple[str, int]:
        """The initials of the least cheapest edits of a block entered in ``state``, and the state it leaves."""
        key = state, behind, symbols
        if key not in self._expanded:
            costs = [self.vectors[behind]]
            for symbol in reversed(symbols):
                costs.append(step(costs[-1], symbol))
            costs.reverse()
            out = []
            for i, symbol in enumerate(symbols):
                now, after = costs[i], costs[i + 1]
                while True:
                    letter, extra = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2) if symbol else 0
                    kept = _KEEP.get((state, letter)) if symbol else None
                    if DELETE + after[state] == now[state]:
                        out.append("D")
                    elif INSERT + now[_NEXT[state]] == now[state]:
                        out.append("I")
                        state = _NEXT[state]
                        continue
                    elif kept is not None and extra + after[kept] == now[state]:
                        out.append("K")
                        state = kept
                    else:
                        out.append("R")
                        state = _NEXT[state]
                    break
            self._expanded[key] = "".join(out), state
        return self._expanded[key]


@cache
def tables() -> Tables:
    return Tables()


def audit(symbols: bytes) -> tuple[int, str]:
    """Cost and initials of the least cheapest edits of a conversation's symbols."""
    t = tables()
    blocks = len(symbols) // BLOCK
    vector, cost = 0, 0
    for symbol in reversed(symbols[blocks * BLOCK:]):
        cost += int(t.one_cost[vector, symbol])
        vector = int(t.one[vector, symbol])
    behind = [0, vector]  # of the rest, of the last block, and so on
    digits = np.frombuffer(symbols[:blocks * BLOCK], np.uint8).reshape(blocks, BLOCK) @ SYMBOLS ** np.arange(BLOCK)[::-1]
    for code in reversed(digits.tolist()):
        cost += t.block_cost[vector][code]
        vector = t.block[vector][code]
        behind.append(vector)
    cost += t.vectors[vector][EMPTY]
    out, state = [], EMPTY
    for b in range(blocks):
        text, state = t.expand(state, behind[blocks - b], symbols[b * BLOCK:(b + 1) * BLOCK])
        out.append(text)
    text, state = t.expand(state, 0, symbols[blocks * BLOCK:])
    out.append(text)
    while _END[state]:
        out.append("I")
        state = _NEXT[state]
    return cost, "".join(out)


def _illegal(codes: np.ndarray) -> int:
    """Adjacent rows whose letters are not su, ua or au."""
    letter = codes // 4
    a, b = letter[:-1], letter[1:]
    return int((~(((b == 1) & ((a == 0) | (a == 2))) | ((a == 1) & (b == 2)))).sum())


def _runs(column: pa.Array) -> np.ndarray:
    """Starts of runs of equal values (nulls are equal), and the length."""
    code = np.asarray(pc.dictionary_encode(column, null_encoding="encode").indices)
    return np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1, [len(code)]]).astype(np.int64) if len(code) else np.zeros(1, np.int64)


def _whole(batches: Iterator[pa.RecordBatch], value) -> Iterator[tuple[object, bytes]]:
    """(conversation, bytes of its rows) of sorted rows; ``value`` gives the bytes of some consecutive rows."""
    open_id, parts = None, None
    for batch in batches:
        ends = _runs(batch.column(0))
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            conv = batch.column(0)[a].as_py()
            if parts is not None and conv == open_id:
                parts.append(value(batch, a, b))
                continue
            if parts is not None:
                yield open_id, b"".join(parts)
            open_id, parts = conv, [value(batch, a, b)]
    if parts is not None:
        yield open_id, b"".join(parts)


def _pieces(id_type: pa.DataType):
    """One row per conversation of a range: its rows' codes, and the range's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def value(batch: pa.RecordBatch, a: int, b: int) -> bytes:
            first, rest, n = (np.asarray(batch.column(i)[a:b]) for i in (1, 2, 3))
            codes = np.repeat(rest.astype(np.uint8), n)
            at = np.cumsum(n) - n
            codes[at[n > 0]] = first[n > 0]
            return codes.tobytes()

        part = TaskContext.get().partitionId()
        found: list[tuple[object, bytes]] = []
        for found_one in _whole(batches, value):
            found.append(found_one)
            if len(found) == 4096:
                yield _batch(found, id_type, part)
                found = []
        if found:
            yield _batch(found, id_type, part)
    return run


def _batch(found: list[tuple[object, bytes]], id_type: pa.DataType, part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], id_type), pa.array([part] * len(found), pa.int32()),
                                       pa.array([f[1] for f in found], pa.binary())], names=["conv", "part", "codes"])


_AUDIT = [("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()),
          ("audit", pa.string())]


def _audits(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", *[n for n, _ in _AUDIT]]
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            cols = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [id_type, *[t for _, t in _AUDIT]])], names=names)

        for conv, raw in _whole(batches, lambda batch, a, b: b"".join(x.as_py() for x in batch.column(2)[a:b])):
            codes = np.frombuffer(raw, np.uint8)
            count = np.bincount(codes % 4, minlength=4)
            cost, text = audit(_SYMBOL_OF[codes].tobytes())
            rows.append((conv, int(count[BLANK]), int(count[COPY]), int(count[CUT]), _illegal(codes), cost, text))
            if len(rows) == 4096:
                yield out()
                rows.clear()
        if rows:
            yield out()
    return run


def _space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The test damage: ``crc32("conv:turn") % 20`` drops a row (0), empties its text (1), takes its ``.!?`` (2),
    repeats it (3) or makes it the user's (4).  Returns rows (conv, turn, role, text, copies) with copies 0, 1 or 2."""
    number = F.crc32(F.concat(_space(F.col("conv")), F.lit(":"), _space(F.col("turn"))).cast("binary")) % 20
    return (rows(table, conv, turn, role, text).withColumn("fault", number)
            .select("conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies")))


def rows(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of turns as rows (conv, turn, role, text, copies), null roles and texts as one space."""
    return table.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _space(F.col(role)).alias("role"),
                        _space(F.col(text)).alias("text"), F.lit(1).alias("copies"))


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def _thin(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, letter, fault, n): distinct rows without texts and how often each stands there."""
    bare = F.rtrim(F.col("text"), F.lit(_WHITE))
    initial = F.left("role", F.lit(1))
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(OK)
    return (turns.select("conv", "turn", "role", _digest("text").alias("digest"), letter.alias("letter"), fault.alias("fault"), "copies")
            .groupBy("conv", "turn", "role", "digest", "letter", "fault").agg(F.sum("copies").alias("n")))


def _id_type(turns: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(turns.schema["conv"].dataType)


def _with_audit(turns: DataFrame, name: str) -> StructType:
    schema = turns.select("conv").schema
    if name == "pieces":
        return schema.add("part", "integer").add("codes", "binary")
    for column in ("blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(column, "long")
    return schema.add("audit", "string")


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation of ``turns``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit)."""
    spark = turns.sparkSession
    thin = stages.table(_thin(turns), "turns")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stand = thin.where("n > 0")
    # first occurrences by a pre-aggregated minimum: a text that a conversation repeats very often is no hot task
    first = stand.groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    f = first.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("first"),
                     F.lit(True).alias("seen"))
    met = thin.join(f, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    again = F.coalesce(F.col("seen") & ~F.col("turn").eqNullSafe(F.col("first")), F.lit(False))
    blank = F.col("fault") == BLANK
    code = lambda fault: (4 * F.col("letter") + fault).cast("int")
    coded = met.select("conv", code(F.when(again & ~blank, COPY).otherwise(F.col("fault"))).alias("head"),
                       code(F.when(blank, BLANK).otherwise(COPY)).alias("rest"), F.col("n").cast("long").alias("n"), "turn", "role", "digest")
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    id_type = _id_type(turns)
    # a table, so that a range's number and its rows stay together when executors are lost
    pieces = stages.table(coded.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv", "head", "rest", "n")
                          .mapInArrow(_pieces(id_type), _with_audit(turns, "pieces")), "pieces")
    found = (pieces.repartition(n, "conv").sortWithinPartitions("conv", "part")
             .select("conv", "part", "codes").mapInArrow(_audits(id_type), _with_audit(turns, "audits")))
    wide = lambda c: c.cast("decimal(20,0)")
    gaps = (stand.groupBy("conv").agg((wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")).try_cast("long").alias("gaps"))
            .select(F.col("conv").alias("c"), "gaps"))
    out = found.join(gaps, F.col("conv").eqNullSafe(F.col("c")), "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)).cast("long"))
    return stages.table(out.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), "audits")


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of conversations behind their audits: (True, batch, row) at each audit, (False, edit, role, text, turn) for each row that stays."""
    letters, state = iter(""), EMPTY

    def inserted(last: str) -> Iterator[tuple]:
        nonlocal state
        state = _NEXT[state]
        yield False, last, _ROLE[state], "", None

    for batch in batches:
        kind, turn, role, text = (batch.column(i).to_pylist() for i in (1, 2, 3, 4))
        for i in range(batch.num_rows):
            if not kind[i]:
                for letter in letters:  # what the conversation before this one inserts at its end
                    yield from inserted(letter)
                yield True, batch, i
                letters, state = iter(text[i]), EMPTY
                continue
            letter = next(letters)
            while letter == "I":
                yield from inserted(letter)
                letter = next(letters)
            if letter == "D":
                continue
            name = role[i]
            if letter == "R":
                state = _NEXT[state]
                name = _ROLE[state]
            else:
                state = _KEEP[state, LETTERS.index(name[0])]
            yield False, letter, name, text[i], turn[i]
    for letter in letters:
        yield from inserted(letter)


def _behind_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Conversations in order within partitions: the audit (kind 0), then the rows (kind 1)."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    extra = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    head = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"), *extra)
    stand = turns.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    body = stand.select("conv", F.lit(1).alias("kind"), "turn", "role", "text", _digest("text").alias("digest"),
                        *[F.lit(None).cast("long").alias(c) for c in extra])
    return (head.unionByName(body).repartition(n, "conv")
            .sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "digest").drop("digest"))


def repaired(turns: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The repaired turns: (conv, place from 0, edit K, R or I, turn, role, text); inserted turns have no turn number."""
    found = audits(turns) if found is None else found
    id_type = _id_type(turns)
    kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = ["conv", "place", "edit", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, place, size = None, 0, 0
        for new, *row in _follow(batches):
            if new:
                conv, place = row[0].column(0)[row[1]].as_py(), 0
                continue
            edit, role, text, turn = row
            out.append((conv, place, edit, turn, role, text))
            place, size = place + 1, size + len(text)
            if len(out) == 10_000 or size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    schema = turns.select("conv").schema.add("place", "long").add("edit", "string").add("turn", "long").add("role", "string").add("text", "string")
    return _behind_audits(turns, found).mapInArrow(run, schema)


def report(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: its audit and the SHA-256 of the repaired ``role:text`` lines."""
    id_type = _id_type(turns)
    extra = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = [key, *extra, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        head, sha, start = None, hashlib.sha256(), True

        def out() -> pa.RecordBatch:
            kinds = [id_type, *[pa.int64()] * len(extra), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)

        for new, *row in _follow(batches):
            if new:
                if head is not None:
                    done.append((*head, sha.hexdigest()))
                    if len(done) == 4096:
                        yield out()
                        done.clear()
                batch, i = row
                head = tuple(batch.column(c)[i].as_py() for c in (0, *range(5, 5 + len(extra)), 4))
                sha, start = hashlib.sha256(), True
                continue
            _, role, text, _ = row
            sha.update((role + ":" + text if start else "\n" + role + ":" + text).encode())
            start = False
        if head is not None:
            done.append((*head, sha.hexdigest()))
        if done:
            yield out()

    schema = turns.select(F.col("conv").alias(key)).schema
    for column in extra:
        schema = schema.add(column, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")
    return _behind_audits(turns, audits(turns)).mapInArrow(run, schema)
