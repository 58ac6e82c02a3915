"""Boolean trigram queries of regular expressions.

A query is a list of alternatives, each a set of trigrams that must all occur
in a matching text (lower-cased). None means that nothing is mandatory.
"""

from __future__ import annotations

from re import _constants as K
from re import _parser as P

Query = list[frozenset[str]] | None
#: Strings followed exactly before they are turned into trigrams.
MOST_STRINGS = 64


def _all_of(strings: set[str]) -> Query:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return None if frozenset() in sets else _least(sets)


def _least(sets) -> Query:
    return [s for s in sorted(set(sets), key=lambda s: (len(s), sorted(s))) if not any(t < s for t in sets)]


def _and(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return _least({s | t for s in a for t in b})


def _or(queries: list[Query]) -> Query:
    return None if None in queries else _least({s for q in queries for s in q})


def _char_set(items) -> set[str] | None:
    """The characters of a small class, else None."""
    found: set[str] = set()
    for op, arg in items:
        if op is K.LITERAL:
            found.add(chr(arg).lower())
        elif op is K.RANGE and arg[1] - arg[0] < 4:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= 4 else None


def _walk(tree) -> tuple[set[str] | None, Query]:
    """(exact strings, None) if the strings are few, else (None, query)."""
    exact, query = {""}, None
    whole = True

    def flush():
        nonlocal exact, query, whole
        query, exact, whole = _and(query, _all_of(exact)), {""}, False

    for op, arg in tree:
        strings, inner = None, None
        if op is K.LITERAL:
            strings = {chr(arg).lower()}
        elif op is K.IN:
            strings = _char_set(arg)
        elif op is K.SUBPATTERN:
            strings, inner = _walk(arg[-1])
        elif op is K.BRANCH:
            parts = [_walk(x) for x in arg[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
            else:
                inner = _or([_all_of(s) if s is not None else q for s, q in parts])
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
            low, high, body = arg
            part, within = _walk(body)
            if (low, high) == (0, 1) and part is not None:
                strings = part | {""}
            elif low == high and part is not None and len(part) ** low <= MOST_STRINGS and low <= 8:
                strings = {""}
                for _ in range(low):
                    strings = {a + b for a in strings for b in part}
            elif low > 0:
                inner = _all_of(part) if part is not None else within
        if strings is not None and len(exact) * len(strings) <= MOST_STRINGS:
            exact = {a + b for a in exact for b in strings}
            continue
        flush()
        if strings is not None:
            exact = strings
        else:
            query = _and(query, inner)
    if whole:
        return exact, None
    flush()
    return None, query


def trigram_query(pattern: str) -> Query:
    """The query every text that matches ``pattern`` fulfils; None if there is none."""
    exact, query = _walk(P.parse(pattern))
    return _all_of(exact) if exact is not None else query
