"""Runs of periodic words, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, at least
``LEAST`` words and twice q long, that no neighbouring word extends.  A run of
period q holds, q words apart, two copies of any of its blocks.  So for blocks
of m = 4, 8, 16, ... words at regular places the next copies between 2 m - 1
and 4 m - 2 words ahead are looked up; a run of such a period holds a whole
block and its copy.  Blocks of four words stand at every second place, which
suffices for all periods up to 14, as a run has twelve words or more.

Copies of a block are an interval of the suffix array; those inside a window
follow one after another by range successor in a wavelet matrix over it.
Copies at most m / 2 apart form a progression whose difference is a period of
the block; it is crossed in one step.  If the block itself lies in the same
periodic stretch, only the first copy tells anything new.  Each candidate
period is extended to both sides by ranks of the powers of two, which are left
over from building the suffix array, and kept if it is a run.  A stretch found
with several periods has the smallest of them.

Texts are taken in groups of about ``GROUP_WORDS`` words; words of different
texts are different symbols, so nothing is found across texts.  Texts in which
no four words in a row occur twice have no run and leave before that.

Defined cases: null and empty texts have no runs and collapse to an empty
text; repeated rows are texts of their own; all columns are kept, and the
names of the new ones are the caller's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.values import col
from .common import fresh

LEAST = 12  # words of a run
BASE = 4  # words of the smallest block
GROUP_WORDS = 60_000
CANDIDATES = 1_000_000  # extended at once
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:binary>"


def _heads(values: np.ndarray) -> np.ndarray:
    """Place at which the run of equal neighbours begins that each value is in."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


class Suffixes:
    """Suffix array by prefix doubling, with the ranks of all powers of two."""

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(n, np.int32)
        rank[order] = _heads(symbols[order])
        # the rank of a place is where its group begins in the suffix array
        self.ranks, self.sizes, step = [rank], [np.bincount(rank, minlength=n).astype(np.int32)], 1
        while True:
            open_ = np.flatnonzero(self.sizes[-1][rank] > 1)
            if not len(open_):
                break
            ahead = np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)].astype(np.int64) + 1, 0)
            pair = rank[open_].astype(np.int64) * (n + 1) + ahead
            order = np.argsort(pair, kind="stable")
            open_, pair = open_[order], pair[order]
            old = rank[open_]
            rank = rank.copy()
            rank[open_] = old + _heads(pair) - _heads(old)
            self.ranks.append(rank)
            self.sizes.append(np.bincount(rank, minlength=n).astype(np.int32))
            step *= 2
        self.array = np.empty(n, np.int64)
        self.array[rank] = np.arange(n)

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common continuation from places i < j."""
        length = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks) - 1)):
            a, b = i + length, j + length
            inside = b < self.n
            same = inside & (self.ranks[k][np.where(inside, a, 0)] == self.ranks[k][np.where(inside, b, 0)])
            length += same.astype(np.int64) << k
        return length

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common stretch that ends before places i < j."""
        length = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks) - 1)):
            a, b = i - length - (1 << k), j - length - (1 << k)
            inside = a >= 0
            same = inside & (self.ranks[k][np.where(inside, a, 0)] == self.ranks[k][np.where(inside, b, 0)])
            length += same.astype(np.int64) << k
        return length


class Successor:
    """Wavelet matrix over the numbers 0 to n - 1 in any order."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, (self.n - 1).bit_length())
        self.zeros = []
        for b in reversed(range(self.bits)):
            one = (values >> b) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int64))
            values = np.concatenate([values[~one], values[one]])

    def __call__(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value of at least ``least`` at the places low to high - 1; n if there is none."""
        a, b, below = low, high, np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (least >> (self.bits - 1 - level)) & 1 == 1
            za, zb = zeros[a], zeros[b]
            below += np.where(one, zb - za, 0)
            a, b = np.where(one, zeros[-1] + a - za, za), np.where(one, zeros[-1] + b - zb, zb)
        below = np.where(least >= self.n, high - low, below)
        found, a, b, skip, value = below < high - low, low, high, below, np.zeros(len(low), np.int64)
        for level, zeros in enumerate(self.zeros):
            za, zb = zeros[a], zeros[b]
            one = skip >= zb - za
            skip = np.where(one, skip - (zb - za), skip)
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            a, b = np.where(one, zeros[-1] + a - za, za), np.where(one, zeros[-1] + b - zb, zb)
        return np.where(found, value, self.n)


def _extended(text: Suffixes, pairs: list[tuple[np.ndarray, np.ndarray]], least: int) -> np.ndarray:
    """``(start, length, period)`` of the candidates (place of a block, place of its copy) that are runs."""
    kept = [np.zeros((0, 3), np.int64)]
    for i, j in pairs:
        for s in range(0, len(i), CANDIDATES):
            a, b = i[s : s + CANDIDATES], j[s : s + CANDIDATES]
            left, q = text.left(a, b), b - a
            length = left + text.right(a, b) + q
            good = (length >= 2 * q) & (length >= least)
            kept.append(np.unique(np.stack([a - left, length, q], axis=1)[good], axis=0))
    return np.concatenate(kept)


def _copies(text: Suffixes, find: Successor, k: int, stride: int, nearest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Candidates from the blocks of 2**k words at every ``stride``-th place."""
    m, ranks, sizes = 1 << k, text.ranks[k], text.sizes[k]
    block = np.arange(0, text.n, stride)
    block = block[sizes[ranks[block]] > 1]
    low = ranks[block].astype(np.int64)
    high, after, end = low + sizes[low], block + nearest, block + 4 * m - 2
    out = []
    while len(block):
        x = find(low, high, after)
        on = x <= np.minimum(end, text.n - 1)
        block, low, high, end, x = block[on], low[on], high[on], end[on], x[on]
        if not len(block):
            break
        gap = find(low, high, x + 1) - x
        last = x.copy()
        row = np.flatnonzero((gap <= m // 2) & (x + gap < text.n))
        if len(row):
            s, first, d = block[row], x[row], gap[row]
            reach = text.right(first, first + d) + d
            last[row] = first + d * ((reach - m) // d)
            own = text.right(s, s + d) + d >= first - s + m  # one periodic stretch with the block
            more = np.where(own, 0, (np.minimum(last[row], end[row]) - first) // d)
            step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
            out.append((np.repeat(s, more), np.repeat(first, more) + step * np.repeat(d, more)))
        out.append((block, x))
        after = last + 1
    return out


def runs_of(symbols: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """``(start, length, period)`` of all runs, by start and period; no text has more than ``longest`` words."""
    text = Suffixes(symbols)
    find, found = Successor(text.array), []
    k = BASE.bit_length() - 1
    while k < len(text.ranks) - 1 and (k == 2 or 2 * ((2 << k) - 1) <= longest):
        found.append(_extended(text, _copies(text, find, k, 2 if k == 2 else 1 << k, 1 if k == 2 else (2 << k) - 1), least))
        k += 1
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _repeating(symbols: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Texts in which the same four words in a row occur twice (a few more, by chance)."""
    if len(symbols) <= BASE:
        return np.zeros(n, bool)
    h = symbols[: len(symbols) - BASE + 1].astype(np.uint64)
    for i in range(1, BASE):
        h = h * np.uint64(0x9E3779B97F4A7C15) + symbols[i : len(symbols) - BASE + 1 + i].astype(np.uint64)
    h = h ^ (h >> np.uint64(29))
    inside = owner[: len(h)] == owner[BASE - 1 :]
    h, owner = h[inside], owner[: len(h)][inside]
    ordered = np.sort(h)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    place = np.minimum(np.searchsorted(again, h), max(0, len(again) - 1))
    return np.bincount(owner[again[place] == h] if len(again) else [], minlength=n) > 0


def analyse(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text, given as words."""
    known: dict[bytes, int] = {}
    size = np.array([len(t) for t in texts])
    symbols = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, int(size.sum()))
    owner = np.repeat(np.arange(len(texts)), size)
    symbols += owner * len(known)
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    chosen = _repeating(symbols, owner, len(texts)) & (size >= least)
    if not chosen.any():
        return out
    use = chosen[owner]
    runs = runs_of(symbols[use], int(size[chosen].max()), least)
    numbers = np.flatnonzero(chosen)
    begins = np.concatenate([[0], np.cumsum(size[numbers])])
    bounds = np.searchsorted(runs[:, 0], begins)
    for i, t in enumerate(numbers.tolist()):
        out[t] = runs[bounds[i] : bounds[i + 1]] - [begins[i], 0, 0]
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by blanks, of each run only its first period."""
    if not len(runs):
        return b" ".join(words)
    turn = np.zeros(len(words) + 1, np.int64)
    np.add.at(turn, runs[:, 0] + runs[:, 2], 1)
    np.add.at(turn, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(turn)[:-1] == 0).tolist()])


def with_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed", least: int = LEAST) -> DataFrame:
    """``docs`` with the runs of each text, by start and period, and the text without its repetitions."""
    if least < LEAST:
        raise ValueError(f"Runs of fewer than {LEAST} words are not searched for.")

    def arrays(texts: list[list[bytes]]) -> pa.Array:
        found = analyse(texts, least)
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        items = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], fields=list(RUN))
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        whole = pa.array([collapse(t, f) for t, f in zip(texts, found)], pa.binary())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), items), whole], names=["runs", "collapsed"])

    @F.arrow_udf(RESULT)
    def periodic(column: pa.Array) -> pa.Array:
        parts, group, size = [], [], 0
        for value in column:
            words = (value.as_py() or b"").split()
            if group and size + len(words) > GROUP_WORDS:
                parts.append(arrays(group))
                group, size = [], 0
            group.append(words)
            size += len(words)
        parts.append(arrays(group))
        return pa.concat_arrays(parts)

    found = periodic(col(text).cast("binary"))
    kept = [col(c) for c in docs.columns]
    made = fresh(docs, "_found")[0]
    return docs.select(*kept, found.alias(made)).select(*kept, F.col(f"{made}.runs").alias(runs), F.col(f"{made}.collapsed").cast("string").alias(collapsed))
