"""Suffix order, common prefixes and longest previous factors of short symbol arrays, in numpy."""

from __future__ import annotations

import numpy as np


def _ranks(code: np.ndarray) -> np.ndarray:
    """Dense ranks, in ascending order of the codes."""
    order = np.argsort(code)
    new = np.empty(len(code), np.int64)
    new[order] = np.cumsum(np.concatenate([[0], code[order][1:] != code[order][:-1]]))
    return new


def passage_order(symbols: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts``, ascending, in the order of the ``depth`` symbols that stand there, equal ones in ascending order.

    Also, for each place, ``depth`` if its symbols are those of the place before and 0 if not: common prefixes, of which
    shorter ones don't count. Symbols are below 512; the first ranks are those of seven packed into a number.
    """
    length = min(7, depth)
    code = np.zeros(len(symbols), np.int64)
    for k in range(length):
        code[: max(0, len(symbols) - k)] |= symbols[k:].astype(np.int64) << (9 * (length - 1 - k))
    rank = _ranks(code)
    while 2 * length < depth:
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - length)] = rank[length:] + 1
        rank = _ranks((rank << 32) | after)
        length *= 2
    last = rank[starts] << 32
    if depth > length:
        last |= rank[starts + depth - length]
    by = np.argsort(last, kind="stable")
    same = np.zeros(len(by), np.int64)
    same[1:][last[by][1:] == last[by][:-1]] = depth
    return starts[by], same


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Positions by their suffixes up to ``depth`` symbols, equal ones in ascending order, and the ranks by fewer symbols.

    Prefix doubling: ranks by 1, 2, 4 … symbols, each combined from two of the one before; what is behind the end is
    smaller than any symbol.
    """
    levels = [(1, _ranks(symbols.astype(np.int64)))]
    while levels[-1][0] < depth:
        length, rank = levels[-1]
        step = min(length, depth - length)
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - step)] = rank[step:] + 1
        levels.append((length + step, _ranks((rank << 32) | after)))
    return np.argsort(levels[-1][1], kind="stable"), levels


def common_prefixes(order: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """For each place but the first, how many symbols its suffix shares with the one before, up to the depth of the order."""
    a, b = order[:-1].copy(), order[1:].copy()
    n = len(order)
    full = levels[-1][1][a] == levels[-1][1][b]
    out = np.zeros(len(a), np.int64)
    for length, rank in reversed(levels[:-1]):
        if length & (length - 1):
            continue
        inside = (a < n) & (b < n) & ~full
        same = inside.copy()
        same[inside] = rank[a[inside]] == rank[b[inside]]
        # Equal ranks at the end of the array mean that both end there, which two different positions can't.
        out[same] += length
        a[same] += length
        b[same] += length
    out[full] = levels[-1][0]
    return np.concatenate([[0], np.minimum(out, levels[-1][0])]) if n else np.zeros(0, np.int64)


def _nearest(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each place the prefix it shares with the nearest place before that holds a smaller position (0: there is none)."""
    n = len(order)
    to = np.arange(n) - 1
    low = shared.copy()
    open_ = np.flatnonzero((to >= 0) & (low > 0))
    open_ = open_[order[to[open_]] > order[open_]]
    while len(open_):
        at = to[open_]
        low[open_] = np.minimum(low[open_], low[at])  # all skipped places hold larger positions
        to[open_] = to[at]
        open_ = open_[(to[open_] >= 0) & (low[open_] > 0)]
        open_ = open_[order[to[open_]] > order[open_]]
    low[to < 0] = 0
    return low


def factors(order: np.ndarray, shared: np.ndarray, earlier: bool = True) -> np.ndarray:
    """By position, the length of the longest factor that starts there and also at an earlier (or a later) position.

    The best match of a position is the previous or the next place in suffix order that holds a smaller (larger) position.
    """
    keys = order if earlier else -order
    back = np.concatenate([[0], shared[:0:-1]]) if len(shared) else shared
    best = np.maximum(_nearest(keys, shared), _nearest(keys[::-1], back)[::-1])
    out = np.zeros(int(order.max()) + 1 if len(order) else 0, np.int64)
    out[order] = best
    return out
