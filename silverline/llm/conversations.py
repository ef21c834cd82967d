"""Repair of conversation structure by weighted CYK parsing over row spans.

A good conversation reads `(s?(ua)+)?` by the initials of its roles. Its automaton has four states
(0 begun, 1 after s, 2 after u, 3 after a); the nonterminals of the repair grammar are pairs of states,
X[p,q] for "leads from p to q", in Chomsky normal form:

    X[p,q] -> X[p,r] X[r,q]        two neighbouring spans
    X[p,q] -> edit of one row      keep, rerole, delete
    X[p,q] -> edit of no row       insert, which spans of no rows close over

A cell holds the least (cost, audit) of one nonterminal over one span. Audits compare as whole strings
and are built by joining: of two audits of equal cost in a cell none can begin with the other, since
both hold one letter for each row of the span and every further insertion costs more. So the least
pair of a span comes from least pairs of its parts.

Spans of up to `block` rows are parsed by a chart, bottom-up by length over all split points. Cells are
indexed by the states at both ends, so every split point of a longer span gives the same minimum, and
blocks of longer conversations are joined bottom-up by doubling the length: a conversation with a third
of all rows is many small charts and a logarithm of rounds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import map_rows, pa_schema, slices, stored
from silverline.operators.positions import with_positions

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]

STATES = range(4)
#: What a role initial does: from state to state.
MOVES = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3


@dataclass(frozen=True)
class Costs:
    """What the edits cost. Rows of a chart and spans joined in a round only bound the work of a task."""

    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3
    block: int = 16
    fan: int = 32


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of the span that two neighbouring spans make."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            other = right.get((r, q))
            if other is not None:
                pair = (cost + other[0], audit + other[1])
                if (p, q) not in out or pair < out[p, q]:
                    out[p, q] = pair
    return out


def insertions(costs: Costs) -> Cells:
    """Cells of a span of no rows: nothing, or inserted turns, closed over joining."""
    closed: Cells = {(p, p): (0, "") for p in STATES}
    for role in ROLES:
        for move in MOVES[role]:
            closed[move] = min(closed.get(move, (costs.insert, "I")), (costs.insert, "I"))
    while True:
        more = joined(closed, closed)
        if more == closed:
            return closed
        closed = more


def edits(initial: str, fault: int, costs: Costs) -> Cells:
    """Cells of one row: delete it, keep it where its role fits, or give it a role that does."""
    out: Cells = {(p, p): (costs.delete, "D") for p in STATES}
    if fault not in (BLANK, DUPLICATE):
        extra = costs.truncated if fault == TRUNCATED else 0
        for role in ROLES:
            for move in MOVES[role]:
                out[move] = min(out.get(move, (costs.rerole + extra, "R")), (costs.rerole + extra, "R"))
        for move in MOVES.get(initial, ()):
            out[move] = min(out.get(move, (extra, "K")), (extra, "K"))
    return out


def chart(rows: list[tuple[str, int]], costs: Costs, closure: Cells | None = None) -> Cells:
    """Cells of the span of all rows (role initial, fault), by the table over spans."""
    closure = insertions(costs) if closure is None else closure
    spans = {(i, i + 1): joined(joined(closure, edits(initial, fault, costs)), closure) for i, (initial, fault) in enumerate(rows)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            best: Cells = {}
            for k in range(i + 1, i + length):
                for key, pair in joined(spans[i, k], spans[k, i + length]).items():
                    if key not in best or pair < best[key]:
                        best[key] = pair
            spans[i, i + length] = best
    return spans[0, len(rows)] if rows else closure


def parsed(cells: Cells) -> Cell:
    """The least pair of a whole conversation: from the start to nowhere, or to the end of an answer."""
    return min(cells[0, q] for q in (0, 3) if (0, q) in cells)


def _packed(cells: Cells) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in sorted(cells.items())]


def _cells(packed: list[dict]) -> Cells:
    return {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in packed}


_SPAN = "cells array<struct<p: int, q: int, cost: long, audit: string>>, head string, tail string, illegal long"


def _plain(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()


def damaged(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) with planted faults, chosen by the CRC-32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its `[.!?]`, 3 repeats it, 4 sets its role to user.
    NULL counts as one space: in the hashed name, as a role and as a text; a NULL turn stays NULL.
    """
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    dealt = rows.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.pmod(F.crc32(named.cast("binary")), F.lit(20)).alias("fault"),
    )
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy")
    return dealt.filter(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies
    ).drop("copy")


def _facts(placed: DataFrame) -> DataFrame:
    """(conv_id, at, turn, initial, fault) of every row; texts stay behind, repeats are found by their MD5."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    key = F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    seen = stored(placed.select("conv_id", "at", "turn", F.substring("role", 1, 1).alias("initial"), last.alias("last"), key.alias("key")), "turns")
    # Only what occurs twice goes into the join; stored, Spark knows how little that is.
    firsts = seen.groupBy("conv_id", "key").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = stored(firsts.select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "first"), "repeats")
    fault = F.when(F.col("last") == "", BLANK).when(F.col("at") > F.col("first"), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(0)
    return seen.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left").select(
        "conv_id", "at", "turn", "initial", fault.alias("fault")
    )


def _blocks(facts: DataFrame, extents: DataFrame, costs: Costs) -> DataFrame:
    """(conv_id, lo, last_block, block) with the cells of the rows of each block."""
    numbered = facts.join(extents, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "lo", F.floor((F.col("hi") - F.col("lo")) / costs.block).alias("last_block"),
        F.floor((F.col("at") - F.col("lo")) / costs.block).alias("block"), F.struct("at", "initial", "fault").alias("row"),
    )
    grouped = numbered.groupBy("conv_id", "lo", "last_block", "block").agg(F.array_sort(F.collect_list("row")).alias("rows"))

    def make():
        closure = insertions(costs)

        # Initials and faults are all that a chart depends on, and few sequences of them are common.
        @lru_cache(maxsize=1 << 14)
        def parse(turns: tuple) -> dict:
            pairs = [a + b for (a, _), (b, _) in zip(turns, turns[1:])]
            cells = _packed(chart(list(turns), costs, closure))
            return {"cells": cells, "head": turns[0][0], "tail": turns[-1][0], "illegal": sum(pair not in LEGAL for pair in pairs)}

        def one(row: dict) -> dict:
            turns = tuple((r["initial"], r["fault"]) for r in row["rows"])
            return {c: row[c] for c in ("conv_id", "lo", "last_block", "block")} | parse(turns)

        return lambda rows: [one(row) for row in rows]

    return map_rows(grouped, make, f"conv_id {_plain(facts, 'conv_id')}, lo long, last_block long, block long, {_SPAN}")


def _longer(spans: DataFrame, costs: Costs) -> DataFrame:
    """Spans of `fan` neighbouring spans, by doubling lengths."""
    parts = F.struct("block", "cells", "head", "tail", "illegal")
    grouped = spans.groupBy("conv_id", "lo", F.floor(F.col("last_block") / costs.fan).alias("last_block"), F.floor(F.col("block") / costs.fan).alias("over")).agg(
        F.array_sort(F.collect_list(parts)).alias("parts")
    )

    def make():
        def pair(left: tuple, right: tuple) -> tuple:
            cells, head, tail, illegal = left
            more, first, last, others = right
            return joined(cells, more), head, last, illegal + others + (tail + first not in LEGAL)

        def one(row: dict) -> dict:
            parts = [(_cells(p["cells"]), p["head"], p["tail"], p["illegal"]) for p in row["parts"]]
            while len(parts) > 1:
                parts = [pair(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
            cells, head, tail, illegal = parts[0]
            return {
                "conv_id": row["conv_id"], "lo": row["lo"], "last_block": row["last_block"], "block": row["over"],
                "cells": _packed(cells), "head": head, "tail": tail, "illegal": illegal,
            }

        return lambda rows: [one(row) for row in rows]

    return map_rows(grouped, make, f"conv_id {_plain(spans, 'conv_id')}, lo long, last_block long, block long, {_SPAN}")


def _audits(blocks: DataFrame, longest: int, costs: Costs) -> DataFrame:
    """(conv_id, lo, illegal, cost, audit) of every conversation. `longest`: blocks of the longest one, less one."""
    whole, spans = [], stored(blocks, "spans")
    while True:
        whole.append(spans.filter("last_block = 0"))
        if longest == 0:
            break
        spans, longest = stored(_longer(spans.filter("last_block > 0"), costs), "spans"), longest // costs.fan
    done = whole[0]
    for more in whole[1:]:
        done = done.unionByName(more)

    def make():
        def one(row: dict) -> dict:
            cost, audit = parsed(_cells(row["cells"]))
            return {"conv_id": row["conv_id"], "lo": row["lo"], "illegal": row["illegal"], "cost": cost, "audit": audit}

        return lambda rows: [one(row) for row in rows]

    return map_rows(done, make, f"conv_id {_plain(blocks, 'conv_id')}, lo long, illegal long, cost long, audit string")


def steps(audit: str) -> Iterator[tuple[str, str | None, str]]:
    """For each row what an audit does: (roles inserted before, its role, roles inserted behind the last row).

    The role is NULL for a deleted row and empty for one that keeps its own; inserted roles are joined by commas.
    """
    left = len(audit) - audit.count("D")
    state = 0 if left % 2 == 0 else None  # an odd number of turns begins with a system turn
    end = len(audit.rstrip("I"))
    for found in re.finditer("(I*)([KRD])", audit):
        before = []
        for letter in found[1] + found[2].replace("D", ""):
            role = "" if state is None else ("user", "assistant")[state]
            state = 0 if state is None else 1 - state
            before.append(role)
        own = None if found[2] == "D" else before.pop()
        behind = []
        if found.end() == end:
            for _ in audit[end:]:
                behind.append(("user", "assistant")[state or 0])
                state = 1 - (state or 0)
        yield ",".join(before), "" if found[2] == "K" else own, ",".join(behind)


def _steps(audits: DataFrame, rows: int = 4096) -> DataFrame:
    """(at, before, role, behind) of every row, a long audit in many batches."""
    schema = "at long, before string, role string, behind string"
    out = pa_schema(audits.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for batch in batches:
            for part in slices(batch):
                for row in part.to_pylist():
                    for r, step in enumerate(steps(row["audit"])):
                        made.append((row["lo"] + r, *step))
                        if len(made) == rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), out)], schema=out)
                            made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), out)], schema=out)

    return audits.select("lo", "audit").mapInArrow(run, schema)


@dataclass(frozen=True)
class Repair:
    """The rows in their order (`at`), the measures of each conversation, and what becomes of each row."""

    placed: DataFrame
    measures: DataFrame
    steps: DataFrame


def repair(rows: DataFrame, costs: Costs | None = None) -> Repair:
    """The cheapest repair of every conversation of (conv_id, turn, role, text); other columns are not read.

    Rows go by turn, NULL first; rows of one turn by role, then text. NULL roles and texts count as one
    space; rows with a NULL conv_id are a conversation. Of equal rows all but the first are duplicates.
    Measures: gaps in turns (NULL turns apart), rows by first fault, pairs of neighbours that the grammar
    does not allow, cost and audit. An audit has a letter a row, so it is as long as its conversation.
    An empty table gives no rows.
    """
    costs = costs or Costs()
    filled = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    placed = with_positions(filled, [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")], "at")
    facts = stored(_facts(placed), "faults")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    counts = [F.count_if(F.col("fault") == k).alias(name) for k, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))]
    found = stored(facts.groupBy("conv_id").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), gaps.cast("long").alias("gaps"), *counts), "conversations")
    extents = found.select(F.col("conv_id").alias("c"), "lo", "hi")
    longest = found.agg(F.max(F.floor((F.col("hi") - F.col("lo")) / costs.block))).first()[0] or 0
    audits = stored(_audits(_blocks(facts, extents, costs), longest, costs), "audits")
    measures = found.drop("hi").join(audits.drop("conv_id"), "lo").drop("lo")
    return Repair(placed, measures, _steps(audits))


def repaired_rows(done: Repair) -> DataFrame:
    """(conv_id, at, no, role, text) of the repaired conversations: inserted turns have no text; order by (at, no)."""

    def added(roles: str) -> Column:
        given = F.filter(F.split(roles, ","), lambda r: r != "")
        return F.transform(given, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    kept = F.when(F.col("new").isNotNull(), F.array(F.struct(F.when(F.col("new") == "", F.col("role")).otherwise(F.col("new")).alias("role"), "text")))
    none = F.array().cast("array<struct<role: string, text: string>>")
    every = F.concat(added("before"), F.coalesce(kept, none), added("behind"))
    return (
        done.placed.join(done.steps.withColumnRenamed("role", "new"), "at")
        .select("conv_id", "at", F.posexplode(every).alias("no", "turn_row"))
        .select("conv_id", "at", "no", "turn_row.role", "turn_row.text")
    )


def conversation_hashes(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the `role:text` lines of each conversation of (conv_id, at, no, role, text), in order.

    One hash of one text cannot be put together from parts, so the rows of a conversation pass one
    task; they do so as a stream of a sorted partition and never pile up.
    """
    schema = f"conv_id {_plain(rows, 'conv_id')}, sha256 string"
    out = pa_schema(rows.sparkSession, schema)
    line = F.concat("role", F.lit(":"), "text").cast("binary").alias("line")
    ordered = rows.select("conv_id", "at", "no", line).repartition("conv_id").sortWithinPartitions("conv_id", "at", "no").select("conv_id", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, name, done = None, None, []
        for batch in batches:
            for part in slices(batch):
                for conv_id, text in zip(part["conv_id"].to_pylist(), part["line"].to_pylist()):
                    if running is None or conv_id != name:
                        if running is not None:
                            done.append({"conv_id": name, "sha256": running.hexdigest()})
                        running, name = hashlib.sha256(text), conv_id
                    else:
                        running.update(b"\n" + text)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)
                done = []
        if running is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": name, "sha256": running.hexdigest()}], schema=out)

    return ordered.mapInArrow(run, schema)


def repair_report(original: DataFrame, rows: DataFrame, costs: Costs | None = None) -> DataFrame:
    """One row for each conv_id of `original`: what was wrong with its `rows`, and the repair of least cost.

    Conversations without rows have zeros, an empty audit and the hash of an empty text.
    """
    done = repair(rows, costs)
    hashes = conversation_hashes(repaired_rows(done))
    every = original.select("conv_id").distinct()
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        every.join(done.measures.withColumnRenamed("conv_id", "m"), F.col("conv_id").eqNullSafe(F.col("m")), "left")
        .join(hashes.withColumnRenamed("conv_id", "h"), F.col("conv_id").eqNullSafe(F.col("h")), "left")
        .select(
            "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
        )
    )
