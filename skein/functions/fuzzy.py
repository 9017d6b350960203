"""Similarity of a short string with the best-aligned part of a longer one, in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one machine word of bits per 64 characters of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row = mask = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & mask
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """100 times twice the common length over both lengths (insertions and deletions only)."""
    total = len(a) + len(b)
    return 100.0 * 2 * common_length(a, b) / total if total else 100.0


def partial(a: str, b: str) -> float:
    """The highest :func:`ratio` of the shorter string with any window of the longer one, shorter windows at its ends included."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    n, letters = len(a), set(a)
    best = 0.0
    for i in range(1 - n, len(b)):
        window = b[max(0, i) : i + n]
        edge = window[-1] if i <= len(b) - n else window[0]
        if edge in letters:  # a window whose edge is foreign is no better than one without it
            best = max(best, ratio(a, window))
    return best


def reaches(a: str, b: str, least: int) -> bool:
    """Whether :func:`partial` is at least ``least``, without trying every window.

    A window whose ratio is high enough differs from ``a`` by so few insertions and deletions that
    one of that many pieces of ``a``, and one more, stands in it unbroken. So only windows
    around the pieces' places in ``b``, and the shorter ones at its ends, are compared.
    """
    if len(a) > len(b):
        return partial(a, b) >= least
    if not a or a in b:
        return bool(a) or not b
    n, m = len(a), len(b)
    edits = 2 * n * (100 - least) // 100
    cuts = [n * k // (edits + 1) for k in range(edits + 2)]
    starts = {*range(-edits, 0), *range(m - n + 1, m - n + edits + 1)}
    for x, y in zip(cuts, cuts[1:], strict=False):
        at = b.find(a[x:y])
        while at >= 0:
            starts |= {*range(max(1 - n, at - x - edits), at - x + edits + 1)}
            at = b.find(a[x:y], at + 1)
    windows = {b[max(0, i) : i + n] for i in starts if 1 - n <= i < m}
    return any(200 * common_length(a, w) >= least * (n + len(w)) for w in windows)


@F.pandas_udf(ArrayType(StringType()))
def heard(keys: pd.Series, least: pd.Series, text: pd.Series) -> pd.Series:
    """Of each row's keys those that its text holds with a partial ratio of at least the one beside the key."""
    rows = zip(keys, least, text, strict=True)
    return pd.Series([[] if ks is None or t is None else [k for k, n in zip(ks, ns, strict=True) if reaches(k, t, int(n))] for ks, ns, t in rows])


@F.pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else partial(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
