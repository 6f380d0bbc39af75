"""From a regular expression to the trigrams that every match must hold.

The answer is an OR of ANDs: a list of trigram sets, one of which must be
wholly in a text for the expression to match it; None if some match may have no
trigram at all. Letters are folded to lower case, so the index is too.
"""

from __future__ import annotations

import re._constants as k
import re._parser as parser

#: Anything: what stands left and right of it is not adjacent.
GAP = None

#: Beyond so many alternatives, or characters of a class, a part counts as a gap.
MOST_ALTERNATIVES, MOST_CHARS = 24, 8

_ALT = tuple  # an alternative: literal strings and gaps, in order


def _join(left: _ALT, right: _ALT) -> _ALT:
    if left and right and left[-1] is not GAP and right[0] is not GAP:
        return (*left[:-1], left[-1] + right[0], *right[1:])
    return (*left, *right)


def _class(items) -> list[_ALT]:
    chars: set[str] = set()
    for op, av in items:
        if op is k.LITERAL:
            chars.add(chr(av).lower())
        elif op is k.RANGE and av[1] - av[0] < 64:
            chars |= {chr(c).lower() for c in range(av[0], av[1] + 1)}
        else:
            return [(GAP,)]
    return [(c,) for c in sorted(chars)] if len(chars) <= MOST_CHARS else [(GAP,)]


def _alternatives(node) -> list[_ALT]:
    out: list[_ALT] = [()]
    for op, av in node:
        if op is k.LITERAL:
            part = [(chr(av).lower(),)]
        elif op is k.IN:
            part = _class(av)
        elif op is k.BRANCH:
            part = [a for branch in av[1] for a in _alternatives(branch)]
        elif op is k.SUBPATTERN:
            part = _alternatives(av[3])
        elif op in (k.MAX_REPEAT, k.MIN_REPEAT):
            least, most, body = av
            inner = _alternatives(body)
            if (least, most) == (0, 1):
                part = [*inner, ()]
            elif least == 0:
                part = [(GAP,)]
            else:
                part = inner if (least, most) == (1, 1) else [_join(a, (GAP,)) for a in inner]
        elif op is k.AT:
            part = [()]
        else:
            part = [(GAP,)]
        if len(part) * len(out) > MOST_ALTERNATIVES:
            part = [(GAP,)]
        out = [_join(a, b) for a in out for b in part]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The trigram sets of ``pattern``, none of them holding another; None for a full scan."""
    sets = {frozenset(run[i:i + 3] for run in alt if run is not GAP for i in range(len(run) - 2))
            for alt in _alternatives(parser.parse(pattern))}
    if frozenset() in sets:
        return None
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)
