"""Boolean trigram queries derived from regular expressions.

A query says which trigrams a text must hold if the expression is to match it. It is kept in
conjunctive form: a tuple of clauses, each a set of trigrams of which one at least must occur. An
empty tuple asks for nothing, so every text qualifies. Letters are folded to lower case, which can
only let more texts through.
"""
from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as parser

#: Most strings that a part of an expression is followed as exactly, and most trigrams of a clause.
MOST_STRINGS = 64
MOST_TRIGRAMS = 96

Query = tuple[frozenset[str], ...]


@dataclass(frozen=True)
class Part:
    """What is known of a part: all strings it can be, or none known; and the clauses it asks for."""

    strings: frozenset[str] | None
    query: Query = ()


EMPTY = Part(frozenset({""}))
ANY = Part(None)


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _asked(part: Part) -> Query:
    """The clauses of a part once nothing more is joined to its strings."""
    if part.strings is None or any(len(s) < 3 for s in part.strings):
        return part.query
    if len(part.strings) == 1:
        return part.query + tuple(frozenset({g}) for g in sorted(_grams(next(iter(part.strings)))))
    clauses = [frozenset(s[i:i + 3] for s in part.strings) for i in range(min(map(len, part.strings)) - 2)]
    return part.query + tuple(c for c in clauses if len(c) <= MOST_TRIGRAMS)


def _joined(a: Part, b: Part) -> Part:
    if a.strings is not None and b.strings is not None and len(a.strings) * len(b.strings) <= MOST_STRINGS:
        return Part(frozenset(x + y for x, y in product(a.strings, b.strings)), a.query + b.query)
    return Part(b.strings, _asked(a) + b.query) if b.strings is not None else Part(None, _asked(a) + b.query)


def _either(parts: list[Part]) -> Part:
    if all(p.strings is not None and not p.query for p in parts):
        together = frozenset().union(*(p.strings for p in parts))
        if len(together) <= MOST_STRINGS:
            return Part(together)
    queries = [_asked(p) for p in parts]
    if not all(queries):
        return ANY
    # (a and b) or (c and d): of every choice of one clause from each branch, the shortest one is kept
    best = [min(q, key=len) for q in queries]
    clause = frozenset().union(*best)
    return Part(None, (clause,) if len(clause) <= MOST_TRIGRAMS else ())


def _members(items) -> frozenset[str] | None:
    """The lower-case characters of a small class, or none."""
    found: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if found and len(found) <= 8 else None


def _walk(items) -> Part:
    part = EMPTY
    for op, value in items:
        part = _joined(part, _one(op, value))
    return part


def _one(op, value) -> Part:
    if op is sre.LITERAL:
        return Part(frozenset({chr(value).lower()}))
    if op is sre.IN:
        found = _members(value)
        return ANY if found is None else Part(found)
    if op is sre.SUBPATTERN:
        return _walk(value[3])
    if op is sre.BRANCH:
        return _either([_walk(x) for x in value[1]])
    if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return EMPTY
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, inner = value
        once = _walk(inner)
        if (least, most) == (0, 1) and once.strings is not None:
            return _either([EMPTY, Part(once.strings)])
        if least == 0:
            return ANY
        part = EMPTY
        for _ in range(min(least, 8)):
            part = _joined(part, once)
        return part if least == most and least <= 8 else Part(None, _asked(part))
    return ANY


def trigram_query(pattern: str) -> Query:
    """The clauses every match of `pattern` fulfils; () if the pattern has no mandatory trigram.

    Inline flags and syntax are those that Java's and Python's expressions have in common.
    """
    clauses = set(_asked(_walk(parser.parse(pattern))))
    return tuple(sorted((c for c in clauses if not any(o < c for o in clauses)), key=lambda c: (len(c), sorted(c))))
