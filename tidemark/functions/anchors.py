"""Literals that every match of a pattern holds, taken from the pattern: texts without them need no regular expression."""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parser of Python's own patterns; secrets are written in what it shares with Java's.
from re import _constants as C
from re import _parser as P

#: Spellings that a clause has at most: a clause of more says nothing.
MOST_SPELLINGS = 16
_FLAGS = re.compile(r"\A\(\?([a-zA-Z]+)\)")
#: What Java reads otherwise than Python does, or Python not at all: groups with options, classes of classes, vertical space.
_ELSEWHERE = re.compile(r"\(\?|&&|\[[^\]]*\[|\\v|\\0")


def _chars(item: tuple, ignore_case: bool) -> tuple[str, ...] | None:
    """The characters that an item takes, if it takes exactly one of a few. Where case is ignored, letters have more spellings than their two."""
    op, arg = item
    if op is C.LITERAL:
        found = (chr(arg),)
    elif op is C.IN and all(o is C.LITERAL for o, _ in arg):
        found = tuple(chr(a) for _, a in arg)
    else:
        return None
    if len(found) > MOST_SPELLINGS or (ignore_case and any(c.upper() != c.lower() or ord(c) > 127 for c in found)):
        return None
    return found


def _spellings(run: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Clauses of characters in a row: the longest plain stretch, and the longest that has few spellings."""

    def stretch(most: int) -> tuple[str, ...]:
        best: list[tuple[str, ...]] = []
        for i in range(len(run)):
            n, j = 1, i
            while j < len(run) and n * len(run[j]) <= most:
                n, j = n * len(run[j]), j + 1
            best = max(best, run[i:j], key=len)
        return tuple("".join(x) for x in product(*best)) if best else ()

    return [c for c in dict.fromkeys((stretch(1), stretch(MOST_SPELLINGS))) if c]


def _clauses(items: list, ignore_case: bool) -> list[tuple[str, ...]]:
    """All of these hold in every match; of each clause, one of its literals is there."""
    out: list[tuple[str, ...]] = []
    run: list[tuple[str, ...]] = []

    def ended() -> None:
        out.extend(_spellings(run))
        run.clear()

    def walk(items: list) -> None:
        for item in items:
            op, arg = item
            if (chars := _chars(item, ignore_case)) is not None:
                run.append(chars)
            elif op is C.SUBPATTERN:
                walk(list(arg[3]))
            elif op is C.AT:
                continue
            else:
                ended()
                if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
                    out.extend(_clauses(list(arg[2]), ignore_case))
                elif op is C.BRANCH:
                    sides = [_clauses(list(side), ignore_case) for side in arg[1]]
                    # Of each side the clause with the longest literals; a side without any leaves the branch without one.
                    best = [max(side, key=lambda c: (min(map(len, c)), -len(c)), default=()) for side in sides]
                    either = tuple(dict.fromkeys(x for c in best for x in c))
                    if all(best) and len(either) <= MOST_SPELLINGS:
                        out.append(either)

    walk(items)
    ended()
    return out


@lru_cache(maxsize=256)
def required_literals(pattern: str) -> tuple[tuple[str, ...], ...]:
    """Clauses of a pattern, those that few texts meet first; none if the pattern is beyond what is read here, and then it is simply tried on all texts."""
    flags = _FLAGS.match(pattern)
    body = pattern[flags.end() :] if flags else pattern
    if "x" in (flags[1] if flags else "") or _ELSEWHERE.search(body.replace("(?:", "(")):
        return ()
    try:
        parsed = P.parse(body)
    except re.error:
        return ()
    found = dict.fromkeys(tuple(dict.fromkeys(c)) for c in _clauses(list(parsed), bool(flags and "i" in flags[1])))
    return tuple(sorted(found, key=lambda c: (-min(map(len, c)) / len(c), c)))


def may_match(text: Column, pattern: str) -> Column:
    """Whether a text holds what every match of the pattern holds: byte searches only."""
    one = lambda clause: reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in clause])
    return reduce(lambda a, b: a & b, [one(c) for c in required_literals(pattern)], F.lit(True))


def matches(text: Column, pattern: str) -> Column:
    """``text.rlike(pattern)``, decided by literals wherever they can decide it."""
    return may_match(text, pattern) & text.rlike(pattern)
