"""Jaro distance between two string columns, one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

WIDE = 64  # longer strings are compared one pair at a time
ROWS = 8192  # pairs compared side by side


def jaro_similarity(a: str, b: str) -> float:
    """Jaro similarity; half of the out-of-order matches, rounded down, count as transpositions."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    seen = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                seen.append(ch)
                break
    m = len(seen)
    if m == 0:
        return 0.0
    other = [ch for ch, used in zip(b, taken) if used]
    swaps = sum(x != y for x, y in zip(seen, other)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3.0


def _codes(words: list[str], size: np.ndarray) -> np.ndarray:
    """Code points by (place, word), zero beyond a word's end."""
    wide = max(1, int(size.max()))
    out = np.array(words, f"<U{wide}").view(np.uint32).reshape(len(words), wide)
    return np.ascontiguousarray(out.T)


def jaro_similarities(a: list[str], b: list[str]) -> np.ndarray:
    """jaro_similarity of each pair of non-empty strings, place by place over all pairs at once."""
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    ca, cb = _codes(a, la), _codes(b, lb)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    within = [reach >= k for k in range(int(reach.max()) + 1)]
    free = np.arange(len(cb))[:, None] < lb
    seen = np.zeros(ca.shape, bool)
    for i in range(len(ca)):
        open_ = i < la
        for j in range(max(0, i - len(within) + 1), min(len(cb), i + len(within))):
            hit = ca[i] == cb[j]
            hit &= free[j]
            hit &= open_
            hit &= within[abs(i - j)]
            free[j] ^= hit
            open_ ^= hit
            seen[i] |= hit
    taken = ~free & (np.arange(len(cb))[:, None] < lb)
    m = seen.sum(0)
    # matched characters of all pairs end to end: as many of a as of b
    apart = ca.T[seen.T] != cb.T[taken.T]
    swaps = np.bincount(np.repeat(np.arange(len(m)), m), weights=apart, minlength=len(m)) // 2
    some = np.maximum(m, 1)
    return np.where(m > 0, (m / la + m / lb + (m - swaps) / some) / 3.0, 0.0)


@F.pandas_udf(DoubleType())
def _jaro_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.zeros(len(a))
    left, right = a.tolist(), b.tolist()
    for start in range(0, len(left), ROWS):
        x, y = left[start : start + ROWS], right[start : start + ROWS]
        short = np.array([bool(s and t) and max(len(s), len(t)) <= WIDE for s, t in zip(x, y)])
        got = np.zeros(len(x))
        if short.any():
            at = np.flatnonzero(short)
            got[at] = jaro_similarities([x[i] for i in at], [y[i] for i in at])
        for i in np.flatnonzero(~short):
            got[i] = jaro_similarity(x[i], y[i])
        out[start : start + ROWS] = 1.0 - got
    return pd.Series(out)


def jaro_distance(a: Column, b: Column) -> Column:
    return _jaro_distance(a, b)
