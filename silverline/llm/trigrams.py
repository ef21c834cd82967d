"""Boolean trigram queries from regular expressions, derived when a plan is made.

A query is a list of alternatives; each is a set of trigrams that a text must hold, in lower case,
if the expression matches it by that alternative. An alternative without trigrams says nothing, so
an expression that has one must scan every text.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as parser

# Character classes up to this size are spelled out; larger ones end a literal run.
SMALL_CLASS = 8
# Alternatives beyond this many are given up: the expression then scans every text.
MAX_ALTERNATIVES = 256

# (trigrams so far, literal characters that just ended), for one way through an expression.
Way = tuple[frozenset[str], str]


def _put(way: Way, char: str) -> Way:
    grams, run = way
    run = run + char.lower()
    if len(run) >= 3:
        grams |= {run[-3:]}
    return grams, run[-2:]


def _broken(ways: list[Way]) -> list[Way]:
    return list(dict.fromkeys((grams, "") for grams, _ in ways))


def _walk(tree: object, ways: list[Way]) -> list[Way]:
    for op, value in tree:
        if op is ops.LITERAL:
            ways = [_put(way, chr(value)) for way in ways]
        elif op is ops.IN and all(kind is ops.LITERAL for kind, _ in value) and len(value) <= SMALL_CLASS:
            chars = dict.fromkeys(chr(code).lower() for _, code in value)
            ways = [_put(way, char) for way in ways for char in chars]
        elif op is ops.SUBPATTERN:
            ways = _walk(value[3], ways)
        elif op is ops.BRANCH:
            ways = [way for branch in value[1] for way in _walk(branch, ways)]
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            low, high, inner = value
            if high == 1:
                ways = ways + _walk(inner, ways)
            elif low == 0:
                ways = _broken(ways)
            else:
                ways = _broken(_walk(inner, ways)) if (low, high) != (1, 1) else _walk(inner, ways)
        elif op in (ops.AT, ops.ASSERT, ops.ASSERT_NOT):
            pass
        else:
            ways = _broken(ways)
        ways = list(dict.fromkeys(ways))
        if len(ways) > MAX_ALTERNATIVES:
            return [(frozenset(), "")]
    return ways


def query(expression: str) -> list[frozenset[str]]:
    """The alternatives of an expression, without those that a weaker one covers; empty if it must scan every text."""
    found = {grams for grams, _ in _walk(parser.parse(expression), [(frozenset(), "")])}
    if frozenset() in found:
        return []
    return sorted((grams for grams in found if not any(other < grams for other in found)), key=sorted)
