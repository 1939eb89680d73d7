"""Conversation repair against a plain dynamic program over (cost, initials), and odd tables."""
import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest

from nearfill.llm import queries, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, copies string, digest int, conv string"
LEGAL = {"su", "ua", "au"}


def cheapest(rows):
    """(cost, initials) of rows (initial, must go, truncated), by trying every edit at every place."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(i, last, inserted):
        found = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if i < len(rows):
            initial, gone, cut = rows[i]
            cost, rest = best(i + 1, last, 0)
            found.append((cost + 2, "D" + rest))
            if not gone:
                for letter, to, price in [("K", initial, 0), ("R", "u", 1), ("R", "a", 1)]:
                    if (last, to) in after:
                        cost, rest = best(i + 1, after[last, to], 0)
                        found.append((cost + price + 5 * cut, letter + rest))
        if inserted < 3:
            for to in "ua":
                if (last, to) in after:
                    cost, rest = best(i, after[last, to], inserted + 1)
                    found.append((cost + 5, "I" + rest))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def plain(table, damage=True):
    """The contract, conversation by conversation."""
    out, rows_of = {}, defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        rows_of[conv]
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows_of[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for conv, rows in rows_of.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = cheapest(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)))
        lines, at, last = [], iter(rows), ""
        for letter in audit:
            row = next(at) if letter != "I" else (None, None, "")
            if letter == "D":
                continue
            role = row[1] if letter == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append((letter, role, row[2]))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in lines))
        turns = {r[0] for r in rows} - {None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest()), lines
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def made(n, seed=3):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(1, 12)):
            rows.append((conv, turn if r.random() < 0.9 else r.choice([None, turn + 3, 0]),
                         r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "s", "ü"]),
                         r.choice(["Done.", "Yes!", "so", "", " \t", None, "Ask?\n", "tail  ", f"t{turn}.", " .\x0b"])))
    return rows + rows[:40]


def check(spark, rows):
    want = plain(rows)
    got = turn_repair.report(turn_repair.damaged(frame(spark, rows))).collect()
    assert len(got) == len(want)
    for g in got:
        assert tuple(g)[1:] == want[g.conv_id][0], g


def test_tables_equal_the_plain_program():
    r = random.Random(5)
    for _ in range(3000):
        symbols = bytes(r.choice([0, 1, 2, 3, 3, 4, 5, 5, 6, 7, 8]) for _ in range(r.randrange(13)))
        rows = tuple(("", True, False) if not s else ("suax"[(s - 1) // 2], False, s % 2 == 0) for s in symbols)
        assert turn_repair.audit(symbols) == cheapest(rows)


def test_vectors_are_few_and_blocks_agree_with_single_rows():
    t = turn_repair.tables()
    assert len(t.vectors) < 100
    r = random.Random(6)
    symbols = bytes(r.randrange(9) for _ in range(4001))
    cost, after = 0, (0, 10, 5, 0)
    for s in reversed(symbols):
        after = turn_repair.step(after, s)
    cost, audit = turn_repair.audit(symbols)
    assert cost == after[0] and len(audit.replace("I", "")) == len(symbols)


def test_report_equals_the_contract(spark):
    check(spark, made(120))


def test_one_conversation_over_many_ranges(spark):
    r = random.Random(8)
    check(spark, [(7 if i % 3 else i % 40 + 100, i // 2, r.choice(["user", "assistant", "system"]), f"row {i}" + "." * (i % 4 > 0)) for i in range(700)])


def test_odd_tables(spark):
    check(spark, [(None, None, None, None), (None, 4, "user", "Hi."), (None, 5, "assistant", "Yes.")])
    check(spark, [(1, 2**62, "user", "a."), (1, -2**62, "assistant", "b.")])
    check(spark, [(1, 1, "user", "long " * 300_000 + "."), (1, 2, "assistant", "ok.")] * 3)
    empty = turn_repair.report(turn_repair.damaged(frame(spark, [(1, 1, "u", "t")]).where("false")))
    assert empty.collect() == []
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    [row] = turn_repair.report(turn_repair.damaged(frame(spark, [(gone, 0, "user", "Hi.")]))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns(spark):
    rows = made(40, seed=4)
    want = plain(rows, damage=False)
    got = defaultdict(list)
    for r in turn_repair.repaired(turn_repair.rows(frame(spark, rows))).collect():
        got[r.conv].append((r.place, r.edit, r.role, r.text))
    for conv, (_, lines) in want.items():
        assert sorted(got[conv]) == [(i, *line) for i, line in enumerate(lines)]


@pytest.mark.parametrize("name", ["conv_id", "turn", "role", "text"])
def test_null_columns(spark, name):
    rows = [tuple(None if n == name else v for n, v in zip(("conv_id", "turn", "role", "text"), r)) for r in made(10)]
    check(spark, rows[:25])


def test_registered_query_has_sql():
    assert "op11_turn_repair" in queries.QUERIES and "op11_turn_repair" in queries.ORACLE
