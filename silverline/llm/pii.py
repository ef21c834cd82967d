"""Personal data: fixed rules give seeds, and the words around the seeds find more.

Four rules (email, ip, card, phone) find base spans. Their contexts become lexical patterns: the
two words before and the word after, in three shapes. Patterns and the values they touch form a
graph that Spark scores in rounds: a pattern is as good as the values it touches, a value as good
as its patterns. Patterns that end with high confidence mark values that no rule knows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import cut, map_rows

# The kinds, in the order of the listing.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: the run's first digit would have matched before.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
# What may be an identifier besides: a word with a digit or an at sign, trimmed of punctuation.
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_SPACES = frozenset(" \t\n\x0b\x0c\r")
_TRIM = ".,;:!?()[]{}<>\"'`|%$*#&"
# Characters looked at on either side for context words.
_NEAR = 64

_CANDIDATES = "array<struct<kind:string, start:long, end:long, value:string, patterns:array<string>>>"
_FOUND = f"doc_id long, spans array<struct<kind:int, start:long, end:long>>, near {_CANDIDATES}"


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring, distinct seed values a pattern needs, and the confidence that marks a value."""

    rounds: int = 3
    min_seeds: int = 3
    confidence: float = 0.9


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from the at signs: the local part is the run of its characters before one."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            floor = match.end()
        else:
            floor = at + 1
        at = text.find("@", floor)
    return found


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = "".join(_DIGITS.findall(match[0]))
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(match.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15]


RULES: tuple[Callable[[str], list[tuple[int, int]]], ...] = (emails, ips, cards, phones)


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Context shapes of a span: two words before; a word on each side; two before and one after."""
    before = [w.strip(_TRIM).lower() for w in text[max(0, start - _NEAR) : start].split(" ")]
    after = [w.strip(_TRIM).lower() for w in text[end : end + _NEAR].split(" ")]
    left = [w for w in before if w][-2:]
    right = [w for w in after if w][:1]
    shapes = []
    if len(left) == 2:
        shapes.append("\x1f".join(["L2", *left]))
    if left and right:
        shapes.append("\x1f".join(["LR", left[-1], *right]))
    if len(left) == 2 and right:
        shapes.append("\x1f".join(["L2R", *left, *right]))
    return shapes


def _candidate(text: str, kind: str | None, start: int, end: int) -> dict:
    return {"kind": kind, "start": start, "end": end, "value": text[start:end].lower(), "patterns": _patterns(text, start, end)}


def find_base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base spans, by kind, then start."""
    return [(kind, *span) for kind, rule in enumerate(RULES) for span in rule(text)]


def _unknown(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Identifier-like words outside the base spans."""
    found, at, done = [], 0, 0
    taken = sorted(taken)
    while mark := _MARK.search(text, done):
        start = mark.start()
        while start > done and text[start - 1] not in _SPACES:
            start -= 1
        gap = _SPACE.search(text, mark.end())
        done = gap.start() if gap else len(text)
        word = text[start:done]
        start += len(word) - len(word.lstrip(_TRIM))
        end = done - (len(word) - len(word.rstrip(_TRIM)))
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        free = at == len(taken) or taken[at][0] >= end
        if free and end - start >= 5:
            found.append((start, end))
    return found


def _scan() -> Callable[[list[dict]], list[dict]]:
    def scan(row: dict) -> dict:
        text = row["text"] or ""
        spans = find_base(text)
        near = [_candidate(text, KINDS[kind], start, end) for kind, start, end in spans]
        near += [_candidate(text, None, start, end) for start, end in _unknown(text, [s[1:] for s in spans])]
        return {
            "doc_id": row["doc_id"],
            "spans": [{"kind": k, "start": s, "end": e} for k, s, e in spans],
            "near": [c for c in near if c["patterns"]],
        }

    return lambda rows: [scan(row) for row in rows]


def confident_patterns(near: DataFrame, how: Bootstrap) -> DataFrame:
    """(kind, pattern, score) of the patterns that end with high confidence.

    `near` has one row per occurrence: kind (NULL if no rule knows the value), value, pattern. Every
    sum is an aggregate with partial sums before the shuffle; a frequent pattern or value is one row
    of the graph however often it occurs.
    """
    edges = cut(near.groupBy("pattern", "value").agg(F.max("kind").alias("kind"), F.count("*").alias("n")))
    seeded = edges.filter("kind is not null").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    kept = seeded.filter(F.col("seeds") >= how.min_seeds).select("pattern", F.col("kind").alias("of"))
    graph = cut(edges.join(kept, "pattern"))
    # A value starts at 1 for the kind that a rule gave it, else at 0.
    values = graph.groupBy("of", "value").agg(F.max((F.col("kind") == F.col("of")).cast("double")).alias("known"))
    scores = values.select("of", "value", F.coalesce("known", F.lit(0.0)).alias("known"), F.coalesce("known", F.lit(0.0)).alias("score"))
    patterns = None
    for _ in range(how.rounds):
        scores = cut(scores)
        patterns = (
            graph.join(scores, ["of", "value"])
            .groupBy("of", "pattern")
            .agg((F.sum("score") / F.count("*")).alias("trust"), F.sum("known").alias("seeds"))
        )
        reached = graph.join(patterns, ["of", "pattern"]).groupBy("of", "value").agg(
            # One minus the chance that all its patterns are wrong.
            (1.0 - F.exp(F.sum(F.log(1.0 - F.least("trust", F.lit(0.999)))))).alias("reached")
        )
        scores = scores.join(reached, ["of", "value"]).select(
            "of", "value", "known", F.greatest("known", F.col("reached") * 0.9).alias("score")
        )
    return patterns.filter((F.col("trust") >= how.confidence) & (F.col("seeds") >= how.min_seeds)).select(
        F.col("of").alias("kind"), "pattern", F.col("trust").alias("score")
    )


def find_personal_data(docs: DataFrame, how: Bootstrap | None = None) -> DataFrame:
    """(doc_id, base, more): spans by the rules and spans that only contexts found, per document.

    Whole texts are read once. NULL text counts as empty and has no spans; a NULL id stays NULL;
    repeated rows each get their spans; an empty table gives no rows; columns other than doc_id and
    text are not looked at. Values in many documents count once as seeds of a pattern. A value that
    patterns of several kinds mark takes the kind of the pattern with the highest score, of equal ones
    the last by name.
    """
    how = how or Bootstrap()
    found = cut(map_rows(docs.select("doc_id", "text"), _scan, _FOUND).withColumn("row", F.monotonically_increasing_id()))
    places = found.select("row", F.explode("near").alias("c")).select("row", "c.*")
    near = places.select("kind", "value", F.explode("patterns").alias("pattern"))
    good = confident_patterns(near, how).withColumnRenamed("kind", "of")
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("of")).cast("int") - 1
    extra = (
        places.filter("kind is null")
        .select("row", "start", "end", F.explode("patterns").alias("pattern"))
        .join(good, "pattern")
        .groupBy("row", "start", "end")
        .agg(F.max_by("of", F.struct("score", "of")).alias("of"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct(order.alias("kind"), "start", "end"))).alias("more"))
    )
    none = F.expr("cast(array() as array<struct<kind:int, start:long, end:long>>)")
    return found.join(extra, "row", "left").select("doc_id", F.col("spans").alias("base"), F.coalesce("more", none).alias("more"))
