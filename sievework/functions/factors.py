"""Literals that a regular expression's every match must hold.

A text without them can't match, and looking for a literal is much cheaper than running an
expression; a table's reader can use them too.  The syntax tree is the standard library's,
which reads most expressions as Java does; for what the two read differently, or what
can't be told, there is no factor, and the expression alone decides.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser

#: Beyond so many alternatives a test of literals isn't worth it.
MOST = 8
#: Escapes that both read alike; class operations, inline flags and possessive quantifiers aren't looked into.
ALIKE = re.compile(r"(?:\\[dDwWsSbBnrtf]|\\[^A-Za-z0-9]|[^\\])*", re.DOTALL)
ODD = re.compile(r"\(\?[^:=!]|&&|\[[^\]]*\[|[+*?}]\+")


def required(pattern: str) -> list[str]:
    """Literals of which each match holds one at least; none if that can't be told."""
    if not ALIKE.fullmatch(pattern) or ODD.search(pattern):
        return []
    try:
        return _best(_parser.parse(pattern)) or []
    except (re.error, RecursionError, OverflowError):
        return []


def _worth(literals: list[str]) -> tuple[int, int]:
    """The shortest literal's length counts first, then how few they are."""
    return min(map(len, literals)), -len(literals)


def _best(items) -> list[str] | None:
    """The best set of literals that a sequence of parts must hold one of."""
    found, run = [], ""
    for kind, value in [*items, (None, None)]:
        if kind is op.LITERAL:
            run += chr(value)
            continue
        if run:
            found.append([run])
        run = ""
        if kind is op.SUBPATTERN:
            found.append(_best(value[-1]))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0]:
            found.append(_best(value[2]))
        elif kind is op.BRANCH:
            each = [_best(x) for x in value[1]]
            found.append(None if None in each else [x for own in each for x in own])
    fit = [x for x in found if x and len(x) <= MOST]
    return max(fit, key=_worth) if fit else None
