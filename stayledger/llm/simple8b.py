"""Simple-8b: unsigned integers packed into 64-bit words.

The low four bits of a word are its selector, which says how many values of how many bits fill the other 60. Values of
more than 60 bits are escaped: selector 0 alone in a word, then the value in a word of its own.
"""

from __future__ import annotations

import numpy as np

ESCAPE = 0
# Selector -> (values in the word, bits of each).
LAYOUTS = {
    2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6), 8: (8, 7),
    9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60),
}
_COUNTS = np.array([0, 0] + [count for count, _ in LAYOUTS.values()], np.int64)
_COUNTS[ESCAPE] = 1


def pack(values: np.ndarray) -> np.ndarray:
    """Words for ``values``, each word filled with as many of the next values as fit. The last one may end in zeros
    that stand for nothing, so the number of values has to be kept beside the words."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    width = np.zeros(n, np.int8)  # bits of each value; what follows the last one counts as zeros
    width[:] = np.frexp(values.astype(np.float64))[1]
    selector, widest, reach = np.zeros(n, np.int8), width, 1
    for code, (count, bits) in reversed(LAYOUTS.items()):  # the last that fits holds most values
        while reach < count:  # bits of the widest of the next ``count`` values
            more = min(reach, count - reach)
            widest = np.maximum(widest, np.concatenate([widest[more:], np.zeros(min(more, n), np.int8)]))
            reach += more
        selector[widest <= bits] = code
    step = _COUNTS[selector].astype(np.uint8).tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    chosen = selector[starts]
    escaped = chosen == ESCAPE
    words = chosen.astype(np.uint64)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for code, (count, bits) in LAYOUTS.items():
        here = np.flatnonzero(chosen == code)
        if len(here):
            first, filled = starts[here], np.full(len(here), code, np.uint64)
            for k in range(count):
                filled |= padded[first + k] << np.uint64(4 + k * bits)
            words[here] = filled
    if escaped.any():
        words = np.insert(words, np.flatnonzero(escaped) + 1, values[starts[escaped]])
    return words


def _raw(selector: np.ndarray) -> np.ndarray:
    """Which words are escaped values, given every word's low four bits."""
    raw = np.zeros(len(selector), bool)
    for at in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    return raw


def values_per_word(words: np.ndarray) -> np.ndarray:
    """Places for values in each word; none in the word of an escaped value, which its selector word counts."""
    selector = (words & np.uint64(15)).astype(np.int64)
    return np.where(_raw(selector), 0, _COUNTS[selector])


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values that ``words`` hold, as unsigned 64-bit integers."""
    words = np.asarray(words, np.uint64)
    selector = (words & np.uint64(15)).astype(np.int64)
    heads = np.flatnonzero(~_raw(selector))
    counts = _COUNTS[selector[heads]]
    offsets = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for code, (count, bits) in LAYOUTS.items():
        here = np.flatnonzero(selector[heads] == code)
        mask = np.uint64((1 << bits) - 1)
        for k in range(count if len(here) else 0):
            out[offsets[here] + k] = words[heads[here]] >> np.uint64(4 + k * bits) & mask
    escaped = np.flatnonzero(selector[heads] == ESCAPE)
    out[offsets[escaped]] = words[heads[escaped] + 1]
    return out[:n]
