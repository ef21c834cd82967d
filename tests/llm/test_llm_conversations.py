"""Conversation repair against a plain search, on planted cases and whole tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from llm_cases import plain

from silverline.llm import conversations as c
from silverline.llm import queries

SF = "/root/testdata/sf0.001"
GOOD = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, at long, lo string, cells int, `a.b` string"
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        act = zlib.crc32(name.encode()) % 20
        if act:
            text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
            out += [(conv, turn, "user" if act == 4 else role, text)] * (2 if act == 3 else 1)
    return out


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append(1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def search(turns, marks):
    """The least (cost, audit, lines), left to right over the states of the grammar, two inserts at most in a row."""
    best = {0: (0, "", [])}

    def relax(into, state, cost, audit, lines):
        if state is not None and (state not in into or (cost, audit) < into[state][:2]):
            into[state] = (cost, audit, lines)

    def inserted(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                for role in ("user", "assistant"):
                    relax(found, MOVES.get((state, role[0])), cost + 3, audit + "I", [*lines, f"{role}:"])
        return found

    best = inserted(best)
    for (role, text), mark in zip(turns, marks):
        after = {}
        for state, (cost, audit, lines) in best.items():
            relax(after, state, cost + 4, audit + "D", lines)
            if mark not in (1, 2):
                extra = 3 if mark == 3 else 0
                relax(after, MOVES.get((state, role[:1])), cost + extra, audit + "K", [*lines, f"{role}:{text}"])
                for new in ("user", "assistant"):
                    relax(after, MOVES.get((state, new[0])), cost + 3 + extra, audit + "R", [*lines, f"{new}:{text}"])
        best = inserted(after)
    return min(best[q] for q in (0, 3) if q in best)


def brute_report(original, rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = []
    for conv in {r[0] for r in original}:
        mine = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [(r[2], r[3]) for r in mine]
        marks = faults(turns)
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = search(turns, marks)
        out.append((conv, gaps, marks.count(1), marks.count(2), marks.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def cases():
    rng = random.Random(11)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice(["Yes.", "No!", "é und so", "a. ", " \n", "", None, f"t{turn}?"])))
    rows += [(100, t, "user" if t % 2 else "assistant", f"line {t}." if t % 7 else "again.") for t in range(300)]  # a long one
    rows += [(None, 1, "user", "no id."), (None, 2, "assistant", "none."), (101, 1, "user", "twice."), (101, 1, "user", "twice.")]
    rows += [(102, None, "user", "x" * 200_000 + "."), (102, None, "assistant", "y.")]
    return rows


def test_chart_finds_the_least_of_all_repairs():
    """All edit strings with two inserts at most at each place, over all conversations of up to three turns."""
    costs = c.Costs()
    for n in range(4):
        for turns in itertools.product([("s", 0), ("u", 0), ("a", 3), ("u", 2), ("x", 0)], repeat=n):
            best = None
            options = []
            for initial, fault in turns:
                own = [("D", "", 4)]
                if fault != 2:
                    extra = 3 if fault == 3 else 0
                    own += [("K", initial, extra), ("R", "u", 3 + extra), ("R", "a", 3 + extra)]
                options.append(own)
            places = [["", "u", "a", "ua", "au"]] * (n + 1)
            for chosen in itertools.product(*options):
                for added in itertools.product(*places) if n < 3 else [("",) * k + (x,) + ("",) * (n - k) for k in range(n + 1) for x in places[0]]:
                    roles = added[0] + "".join(o[1] + a for o, a in zip(chosen, added[1:]))
                    if GOOD.fullmatch(roles):
                        audit = "I" * len(added[0]) + "".join(o[0] + "I" * len(a) for o, a in zip(chosen, added[1:]))
                        pair = (sum(o[2] for o in chosen) + 3 * sum(map(len, added)), audit)
                        best = pair if best is None else min(best, pair)
            got = c.parsed(c.chart(list(turns), costs))
            assert got == best if n < 3 else got <= best, turns


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "fan": 2}, {"block": 1, "fan": 3}])
def test_report_equals_search(spark, sizes):
    rows = cases()
    filled = [(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows]
    frame = spark.createDataFrame([(*r, 1, "l", 2, "d") for r in rows], SCHEMA).repartition(5)
    assert plain(c.repair_report(frame, frame, c.Costs(**sizes)).collect()) == plain(brute_report(filled, filled))


def test_damage_then_repair(spark):
    rows = cases()
    frame = spark.createDataFrame([(*r, 1, "l", 2, "d") for r in rows], SCHEMA).repartition(3)
    damaged = brute_damage(rows)
    assert plain(c.damaged(frame).collect()) == plain(damaged)
    assert plain(c.repair_report(frame, c.damaged(frame)).collect()) == plain(brute_report(rows, damaged))


def test_repaired_rows_are_good_conversations(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "user", "B"), (1, 2, "user", "B"), (2, 0, "system", "S."), (3, 5, "system", "S."), (3, 6, "user", "U.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = c.repaired_rows(c.repair(frame)).orderBy("conv_id", "at", "no").collect()
    turns = defaultdict(list)
    for row in got:
        turns[row["conv_id"]].append((row["role"], row["text"]))
    assert all(GOOD.fullmatch("".join(role[0] for role, _ in lines)) for lines in turns.values())
    assert turns[3] == [("system", "S."), ("user", "U."), ("assistant", "")] and 2 not in turns


def test_empty_tables_and_dropped_conversations(spark):
    schema = "conv_id string, turn int, role string, text string"
    none = spark.createDataFrame([], schema)
    assert c.repair_report(none, none).collect() == []
    some = spark.createDataFrame([("x", 1, "user", "a."), (None, 1, "user", "a.")], schema)
    empty = hashlib.sha256(b"").hexdigest()
    assert plain(c.repair_report(some, none).collect()) == plain([(name, 0, 0, 0, 0, 0, 0, "", empty) for name in ("x", None)])


def test_query_over_the_table(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    assert plain(queries.QUERIES["op11_interval_repair"](spark, SF).collect()) == plain(brute_report(rows, brute_damage(rows)))
