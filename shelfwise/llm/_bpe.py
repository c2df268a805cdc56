"""Byte-pair encodings as a lattice: which tokens may follow each other, and relaxation over all words at once.

Byte-pair encoding splits a text in exactly one way. A sequence of tokens is that split if and only if every two
neighbours are *compatible*: encoding their joined text gives the two of them back. So the split of a word's every
prefix follows by dynamic programming over positions: among the tokens that end at a position exactly one is
compatible with the last token of the prefix before it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from ._common import mixed

NONE = np.int64(1) << np.int64(40)
# Longer words are relaxed in windows of so many symbols, which overlap by the widest token and SLACK.
LONG_WORD = 400
WINDOW = 256
SLACK = 64
WINDOWS_AT_ONCE = 1024


class HashIndex:
    """Vectorised lookup of 64-bit keys: open addressing with linear steps."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.shift, self.size, self.missing = np.uint64(64 - bits), 1 << bits, missing
        self.keys = np.zeros(self.size, np.uint64)
        self.values = np.full(self.size, missing, np.int64)
        self.used = np.zeros(self.size, bool)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = ~self.used[slot]
            winner = np.full(self.size, -1)
            winner[slot[free]] = todo[free]
            won = winner[slot] == todo
            at, which = slot[won], todo[won]
            self.used[at], self.keys[at], self.values[at] = True, keys[which], values[which]
            slot, todo = (slot[~won] + 1) & (self.size - 1), todo[~won]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.missing, np.int64)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            used = self.used[slot]
            hit = used & (self.keys[slot] == keys[todo])
            out[todo[hit]] = self.values[slot[hit]]
            on = used & ~hit
            slot, todo = (slot[on] + 1) & (self.size - 1), todo[on]
        return out


class Merges:
    """Merge ranks and the last merge of every token; ``unknown`` is a token that never merges."""

    def __init__(self, pairs: dict[tuple[int, int], int], rank: np.ndarray, left: np.ndarray, right: np.ndarray,
                 unknown: int = -1):
        self.pairs, self.rank, self.left, self.right, self.unknown = pairs, rank, left, right, unknown
        a = np.fromiter((p[0] for p in pairs), np.uint64, len(pairs))
        b = np.fromiter((p[1] for p in pairs), np.uint64, len(pairs))
        self.index = HashIndex(a << np.uint64(32) | b, np.fromiter(pairs.values(), np.int64, len(pairs)), int(NONE))
        self._known: dict[tuple[int, int], bool] = {}

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge would join the neighbours a and b: their merges are undone from the last to the first,
        and at each state the symbols at the border must not merge before they are used up inside a or b."""
        ok = np.ones(len(a), bool)
        at = np.flatnonzero((a != self.unknown) & (b != self.unknown))
        x, y = a[at].astype(np.int64), b[at].astype(np.int64)
        x_used = np.full(len(at), NONE)
        y_used = x_used.copy()
        while len(at):
            r = self.index.get(x.astype(np.uint64) << np.uint64(32) | y.astype(np.uint64))
            # Of equal merges the leftmost comes first.
            joined = (r < x_used) & (r <= y_used) & (r < NONE)
            ok[at[joined]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~joined & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry, x_used, y_used = (v[on] for v in (at, x, y, rx, ry, x_used, y_used))
            undo = rx > ry
            x_used, x = np.where(undo, rx, x_used), np.where(undo, self.right[x], x)
            y_used, y = np.where(undo, y_used, ry), np.where(undo, y, self.left[y])
        return ok

    def compatible_one(self, a: int, b: int) -> bool:
        if a == self.unknown or b == self.unknown:
            return True
        known = self._known.get((a, b))
        if known is None:
            if len(self._known) > 500_000:
                self._known.clear()
            known = self._known[a, b] = bool(self.compatible(np.array([a]), np.array([b]))[0])
        return known


class Relaxed:
    """Last token, token count and its start for the prefix that ends with each symbol."""

    def __init__(self, symbols: int):
        self.last = np.full(symbols, -1, np.int64)
        self.count = np.zeros(symbols, np.int32)
        self.came = np.zeros(symbols, np.int64)


def relax(tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, merges: Merges) -> Relaxed:
    """Relax all words together, position by position.

    ``tokens[n, e]`` is the token of n symbols that ends with symbol e (-1: none); words are the symbols
    starts[w] to starts[w] + lengths[w] - 1. Long words go through :func:`relax_long`.
    """
    out = Relaxed(tokens.shape[1])
    widest = tokens.shape[0] - 1
    order = np.argsort(-lengths, kind="stable")
    begin, size = starts[order], lengths[order]
    for k in range(int(size[0]) if len(size) else 0):
        m = int(np.searchsorted(-size, -k, "left"))  # words with more than k symbols
        open_ends = begin[:m] + k
        for n in range(min(k + 1, widest), 0, -1):
            t = tokens[n, open_ends]
            has = np.flatnonzero(t >= 0)
            if not len(has):
                continue
            e, t = open_ends[has], t[has]
            if n <= k:
                ok = merges.compatible(out.last[e - n], t)
                has, e, t = has[ok], e[ok], t[ok]
                out.count[e] = out.count[e - n] + 1
            else:
                out.count[e] = 1
            out.last[e], out.came[e] = t, e - n + 1
            open_ends = np.delete(open_ends, has)
            if not len(open_ends):
                break
    return out


def relax_long(size: int, widest: int, edges: Callable[[np.ndarray, np.ndarray], np.ndarray], merges: Merges) -> Relaxed:
    """Relax one long word: windows of it are relaxed together, each as if it were a word, and joined in order.

    What follows a position depends on the ``widest`` positions up to it alone. So where a window and the word so far give
    the same last tokens for that many positions in a row (and counts that differ by one number), the rest of the window is
    the word's own. Windows overlap for that; where the overlap does not bring them together, positions are relaxed one by
    one until they meet. ``edges(starts, lengths)`` gives the tokens of some windows, laid end to end.
    """
    out = Relaxed(size)
    overlap = widest + SLACK
    done = 0
    for group in range(0, size, WINDOWS_AT_ONCE * WINDOW):
        begins = np.arange(group, min(size, group + WINDOWS_AT_ONCE * WINDOW), WINDOW)
        lengths = np.minimum(WINDOW + overlap, size - begins)
        tokens = edges(begins, lengths)
        places = np.cumsum(lengths) - lengths
        part = relax(tokens, places, lengths, merges)
        for b, length, at in zip(begins.tolist(), lengths.tolist(), places.tolist(), strict=True):
            if done >= b + length:
                continue
            shift, same = 0, 0 if done else widest
            near = slice(max(done - widest, b), done)
            if near.stop - near.start == widest:
                here = slice(at + near.start - b, at + near.stop - b)
                apart = out.count[near] - part.count[here]
                if (out.last[near] == part.last[here]).all() and (apart == apart[0]).all():
                    shift, same = int(apart[0]), widest
            while same < widest and done < b + length:
                e = at + done - b
                for n in range(widest, 0, -1):
                    t = int(tokens[n, e])
                    if t >= 0 and merges.compatible_one(int(out.last[done - n]), t):
                        out.last[done], out.came[done], out.count[done] = t, done - n + 1, out.count[done - n] + 1
                        break
                gap = int(out.count[done]) - int(part.count[e])
                met = out.last[done] == part.last[e]
                same = (same + 1 if same and gap == shift else 1) if met else 0
                shift = gap
                done += 1
            rest = slice(at + done - b, at + length)
            out.last[done:b + length] = part.last[rest]
            out.count[done:b + length] = part.count[rest] + shift
            out.came[done:b + length] = part.came[rest] + (b - at)
            done = b + length
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i] + 1, ... of all spans, one span after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
