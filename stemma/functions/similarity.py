"""String similarities that Catalyst cannot express, as Arrow-batched pandas UDFs (TX12, TX13)."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType


def title_ratio(a: str | None, b: str | None) -> float:
    """difflib ratio of two titles in lower case without marks; 0 if either is empty."""
    if not a or not b:
        return 0.0
    x, y = ("".join(c for c in t.lower() if c.isalnum() or c == " ") for t in (a, b))
    return difflib.SequenceMatcher(None, x, y).ratio()


@F.pandas_udf(DoubleType())
def title_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([title_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


#: Not deterministic for the planner only: a filter on the score must not bring a second evaluation.
title_similarity = title_similarity.asNondeterministic()


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of one big integer."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    free = (1 << len(a)) - 1
    full = free
    for c in b:
        hit = free & places.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(a) - free.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """0-100: twice the common subsequence over both lengths."""
    return 200.0 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text and a window of its length in the longer, windows at the ends cut off."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    n, best = len(a), 0.0
    letters = set(a)
    for end in range(1, len(b) + n):
        window = b[max(0, end - n) : min(end, len(b))]
        if end >= len(b):
            good = window[0] in letters
        else:
            good = window[-1] in letters
        if good:
            best = max(best, indel_ratio(a, window))
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = (" ".join(sorted(s)) for s in (x - y, y - x))
    if both and (not one or not two):
        return 100.0
    with_one, with_two = f"{both} {one}".strip(), f"{both} {two}".strip()
    ways = [indel_ratio(with_one, with_two)]
    if both:
        ways += [indel_ratio(both, with_one), indel_ratio(both, with_two)]
    return max(ways)


def name_score(a: str | None, b: str | None) -> int:
    """The best of the three ratios as a whole number of 0 to 100 (TX13)."""
    a, b = a or "", b or ""
    if not a or not b:
        return 0
    return max(round(f(a, b)) for f in (token_sort_ratio, token_set_ratio, partial_ratio))


#: Pairs of texts whose letters are compared together; bits of a word that hold a text.
TOGETHER, BITS = 1 << 14, 64


def codes_of(texts: list[str], width: int, pad: int) -> np.ndarray:
    """One row of code points for each text, filled up with ``pad``."""
    out = np.full((len(texts), width), pad, np.int32)
    for k, t in enumerate(texts):
        if t:
            out[k, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<i4")
    return out


def common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    """``common_subsequence`` of each pair; one 64-bit word holds the state of a pair whose first text fits in it."""
    n, out = np.array([len(x) for x in a]), np.zeros(len(a), np.int64)
    long = np.flatnonzero(n > BITS)
    for k in long.tolist():
        out[k] = common_subsequence(a[k], b[k])
    m = np.array([len(x) for x in b])
    short = np.flatnonzero((n <= BITS) & (n > 0) & (m > 0))
    short = short[np.lexsort((n[short], m[short]))]  # pairs of like lengths together
    for at in range(0, len(short), TOGETHER):
        some = short[at : at + TOGETHER]
        x, y = codes_of([a[k] for k in some.tolist()], int(n[some].max()), -1), codes_of([b[k] for k in some.tolist()], int(m[some].max()), -2)
        weights = np.uint64(1) << np.arange(x.shape[1], dtype=np.uint64)
        full = np.where(n[some] == BITS, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(n[some], BITS - 1).astype(np.uint64)) - np.uint64(1))
        free = full.copy()
        for j in range(y.shape[1]):
            hit = free & ((x == y[:, j, None]) * weights).sum(1, dtype=np.uint64)
            free = (free + hit | free - hit) & full
        out[some] = n[some] - np.bitwise_count(free)
    return out


def indel_ratios(a: list[str], b: list[str]) -> np.ndarray:
    both = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)])
    return np.where(both > 0, 200.0 * common_subsequences(a, b) / np.maximum(both, 1), 100.0)


def shared_letters(a: list[str], b: list[str]) -> np.ndarray:
    """How many letters each pair can have in common at most, whatever their order; letters that are alike in 6 bits count as one."""

    def counts(texts: list[str]) -> np.ndarray:
        where = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<i4") & 63
        return np.bincount(where * 64 + letters, minlength=64 * len(texts)).reshape(-1, 64)

    if not a:
        return np.zeros(0, np.int64)
    texts = sorted({*a, *b})
    place = {t: k for k, t in enumerate(texts)}
    table = counts(texts).astype(np.int32)
    i, j = (np.array([place[t] for t in side]) for side in (a, b))
    return np.concatenate([np.minimum(table[i[k : k + TOGETHER]], table[j[k : k + TOGETHER]]).sum(1) for k in range(0, len(i), TOGETHER)])


def name_scores(a: list[str | None], b: list[str | None], least: int = -1) -> np.ndarray:
    """``name_score`` of each pair where it is over ``least``, anything up to ``least`` elsewhere.

    Pairs that no ratio can bring over ``least`` are left out first, by their lengths and letters; then the three
    ratios are computed for all that are left together, windows of partial matches as pairs of their own.
    """
    out = np.zeros(len(a), np.int64)
    some = [k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x and y]
    if not some:
        return out
    x, y = [a[k] for k in some], [b[k] for k in some]
    nx, ny = np.array([len(t) for t in x]), np.array([len(t) for t in y])
    shared, low = shared_letters(x, y), np.minimum(nx, ny)
    tokens = {t: t.split() for t in {*x, *y}}
    sets = {t: set(w) for t, w in tokens.items()}
    meet = np.array([not sets[p].isdisjoint(sets[q]) or p.isspace() or q.isspace() for p, q in zip(x, y, strict=True)])
    # joined tokens may be shorter than the text, by its white space and repeats; a window is the longer, the more it can share
    fewest = np.array([min(len(" ".join(sorted(sets[t]))), len(" ".join(tokens[t]))) for t in x]) + np.array([min(len(" ".join(sorted(sets[t]))), len(" ".join(tokens[t]))) for t in y])
    extra = np.maximum(np.array([len(tokens[t]) for t in x]), np.array([len(tokens[t]) for t in y]))  # blanks that join tokens
    bound = np.maximum(200.0 * (shared + extra) / np.maximum(fewest, 1), 200.0 * shared / np.maximum(low + shared, 1))
    may = np.flatnonzero(meet | (np.round(bound + 0.01) > least))
    best = np.zeros(len(x))
    sort_of = {t: " ".join(sorted(w)) for t, w in tokens.items()}
    left, right, owner = [], [], []

    def ask(k: int, p: str, q: str) -> None:
        left.append(p)
        right.append(q)
        owner.append(k)

    for k in may.tolist():
        p, q = x[k], y[k]
        ask(k, sort_of[p], sort_of[q])
        u, v = sets[p], sets[q]
        if u and v:
            both = " ".join(sorted(u & v))
            one, two = (" ".join(sorted(s)) for s in (u - v, v - u))
            if both and (not one or not two):
                best[k] = 100.0
                continue
            with_one, with_two = f"{both} {one}".strip(), f"{both} {two}".strip()
            ask(k, with_one, with_two)
            if both:
                ask(k, both, with_one)
                ask(k, both, with_two)
        if len(p) > len(q):
            p, q = q, p
        n, letters = len(p), set(p)
        for end in range(1, len(q) + n):
            window = q[max(0, end - n) : min(end, len(q))]
            if (window[0] if end >= len(q) else window[-1]) in letters:
                ask(k, p, window)
    if owner:
        np.maximum.at(best, np.array(owner), indel_ratios(left, right))
    out[some] = np.round(best).astype(np.int64)
    return out


@F.pandas_udf(IntegerType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(name_scores(list(a), list(b)), dtype="int32")
