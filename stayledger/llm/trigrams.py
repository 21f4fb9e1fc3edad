"""Boolean trigram queries: what three-character strings a text must hold for a regular expression to match in it.

Each part of the expression is described by the texts it can match, as far as they are few (``exact``), else by how its
matches begin and end (``prefix``, ``suffix``) and by a condition on the text (``query``). Joining two parts adds the
trigrams across the seam. Letters are folded to lower case, so the condition holds for either case; what the analysis
does not follow (large classes, repeats, non-ASCII letters, references) weakens the condition and never sharpens it.

A query is True (nothing is required), a trigram, or ``("and", parts)`` / ``("or", parts)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as kinds, _parser as parser

MOST = 32  # texts followed one by one
FEW = 8  # members of a class followed one by one, and copies of a repeat


def both(*parts):
    """All of the queries."""
    flat = {q for part in parts if part is not True for q in (part[1] if part[0] == "and" else [part])}
    return True if not flat else next(iter(flat)) if len(flat) == 1 else ("and", frozenset(flat))


def either(*parts):
    """One of the queries at least. A part that asks for all that another asks for, and more, is left out."""
    if True in parts:
        return True
    flat = {q for part in parts for q in (part[1] if part[0] == "or" else [part])}
    least = {q for q in flat if not any(_asked(other) < _asked(q) for other in flat)}
    return next(iter(least)) if len(least) == 1 else ("or", frozenset(least))


def _asked(query) -> frozenset:
    return query[1] if query[0] == "and" else frozenset({query})


def any_of(texts):
    """The query that a text holding one of ``texts`` fulfils."""
    if any(len(text) < 3 for text in texts):
        return True
    return either(*[both(*[text[i : i + 3] for i in range(len(text) - 2)]) for text in texts])


@dataclass(frozen=True)
class Part:
    exact: frozenset | None
    prefix: frozenset = frozenset({""})
    suffix: frozenset = frozenset({""})
    query: object = True

    def settled(self) -> Part:
        """The same without ``exact``."""
        if self.exact is None:
            return self
        return Part(None, _ends({t[:2] for t in self.exact}), _ends({t[-2:] for t in self.exact}), any_of(self.exact))


ANYTHING, NOTHING = Part(None), Part(frozenset({""}))


def _ends(texts) -> frozenset:
    return frozenset(texts) if len(texts) <= MOST else frozenset({""})


def _joined(one: Part, two: Part) -> Part:
    if one.exact is not None and two.exact is not None and len(one.exact) * len(two.exact) <= MOST:
        return Part(frozenset(a + b for a, b in product(one.exact, two.exact)))
    a, b = one.settled(), two.settled()
    seam = any_of({s + p for s, p in product(a.suffix, b.prefix)})
    prefix = {(e + p)[:2] for e, p in product(one.exact, b.prefix)} if one.exact is not None else a.prefix
    suffix = {(s + e)[-2:] for s, e in product(a.suffix, two.exact)} if two.exact is not None else b.suffix
    return Part(None, _ends(prefix), _ends(suffix), both(a.query, b.query, seam))


def _one_of(one: Part, two: Part) -> Part:
    if one.exact is not None and two.exact is not None and len(one.exact | two.exact) <= MOST:
        return Part(one.exact | two.exact)
    a, b = one.settled(), two.settled()
    return Part(None, _ends(a.prefix | b.prefix), _ends(a.suffix | b.suffix), either(a.query, b.query))


def _letter(code: int) -> str | None:
    return chr(code + 32 if 65 <= code <= 90 else code) if code < 128 else None


def _class(members) -> Part:
    letters = set()
    for kind, value in members:
        if kind is kinds.LITERAL:
            codes = [value]
        elif kind is kinds.RANGE and value[1] - value[0] < 4 * FEW:
            codes = range(value[0], value[1] + 1)
        else:
            return ANYTHING
        letters |= {_letter(code) for code in codes}
    return Part(frozenset(letters)) if None not in letters and len(letters) <= FEW else ANYTHING


def _item(kind, value) -> Part:
    if kind is kinds.LITERAL:
        return Part(frozenset({_letter(value)})) if _letter(value) else ANYTHING
    if kind is kinds.IN:
        return _class(value)
    if kind is kinds.BRANCH:
        return reduce(_one_of, [_sequence(items) for items in value[1]])
    if kind is kinds.SUBPATTERN:
        return _sequence(value[-1])
    if kind is kinds.ATOMIC_GROUP:
        return _sequence(value)
    if kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
        return NOTHING
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        least, most, items = value
        inner = _sequence(items)
        if (least, most) == (0, 1):
            return _one_of(inner, NOTHING)
        copies = reduce(_joined, [inner] * min(least, FEW), NOTHING)
        return copies if least == most <= FEW else _joined(copies, ANYTHING)
    return ANYTHING


def _sequence(items) -> Part:
    return reduce(_joined, [_item(*item) for item in items], NOTHING)


def trigram_query(pattern: str):
    """The condition that every text fulfils, once its letters A-Z are in lower case, in which ``pattern`` matches."""
    return _sequence(parser.parse(pattern)).settled().query


def trigrams_in(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_in, query[1]))
