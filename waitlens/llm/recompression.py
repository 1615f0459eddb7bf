"""Recompression: equal stretches of words get equal inner symbols, whatever stands around them.

A round names each run of one symbol by (symbol, length), splits the symbols in two classes by a hash, and names each pair
of a first-class symbol followed by a second-class one. Names are 64-bit hashes of what they stand for, so all tasks name
alike without a common table. What becomes of two neighbours depends on these two alone, but for the runs at both ends of a
stretch; so what a round makes of the inside of a stretch is the same wherever the stretch occurs.
"""

from __future__ import annotations

import numpy as np

from waitlens.llm.text import mix, window_hashes

ROUNDS = 2
REACH = 4

_U = np.uint64
_MOST = np.iinfo(_U).max


def _round(symbols: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The next round's symbols and where in `symbols` they begin; of each symbol its run; of each run its next symbol and
    whether it is the second of a pair."""
    starts = np.ones(len(symbols), bool)
    starts[1:] = symbols[1:] != symbols[:-1]
    run, heads = np.cumsum(starts) - 1, np.flatnonzero(starts)
    lengths, base = np.diff(np.append(heads, len(symbols))), symbols[heads]
    names = np.where(lengths > 1, mix(base ^ mix(lengths, 3), 4), base)
    right = (mix(base, 16 + level) >> _U(63)).astype(bool)
    second = np.zeros(len(base), bool)
    second[1:] = ~right[:-1] & right[1:]
    first = np.flatnonzero(~second)
    paired = np.append(second, False)[first + 1]
    after = names[np.minimum(first + 1, len(names) - 1)]
    with np.errstate(over="ignore"):
        pairs = mix(names[first] * _U(0xA24BAED4963EE407) + after, 5)
    return np.where(paired, pairs, names[first]), heads[first], run, np.cumsum(~second) - 1, second


def anchors(words: np.ndarray, starts: np.ndarray, size: int, rounds: int = ROUNDS, reach: int = REACH) -> np.ndarray:
    """For each stretch of `size` word hashes at `starts` the name of its anchor; equal stretches have equal anchors.

    The anchor is the symbol of the last round, inside the stretch, whose name with its first `reach` words is least;
    neighbouring stretches mostly share it. A stretch with no such symbol, as one of few different words, takes the last
    round that left one, at the least its words themselves.
    """
    names = np.zeros(len(starts), _U)
    grams = np.zeros(len(words), _U)
    grams[: max(len(words) - reach + 1, 0)] = window_hashes(words, reach)
    symbols, begins = words, np.arange(len(words))
    lo, hi, left = starts, starts + size, np.arange(len(starts))
    for level in range(rounds + 1):
        inner = np.full(len(left), _MOST, _U)
        for step in range(int((hi - lo).max(initial=0))):
            at = np.minimum(lo + step, hi - 1)
            fits = begins[at] + reach <= starts[left] + size
            inner = np.where(fits, np.minimum(inner, mix(grams[begins[at]] ^ mix(symbols[at], level), 6)), inner)
        some = inner < _MOST
        names[left[some]] = inner[some]
        if level == rounds or not len(left):
            return names
        left, lo, hi = left[some], lo[some], hi[some]
        symbols, heads, run, to, second = _round(symbols, level)
        begins = begins[heads]
        first, last = run[lo] + 1, run[hi - 1]  # without the runs at both ends
        at = np.minimum(first, len(to) - 1)
        up, end = to[at] + second[at], to[last]  # without what may belong to a pair that reaches out
        inside = (first < last) & (up < end)
        left, lo, hi = left[inside], up[inside], end[inside]
    return names
