"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends; only runs of at least ``min_words`` words and
``min_periods`` periods count.  Inside a task, the documents of a slice share
one suffix array over their words (a document's words and its end are symbols of
their own, so no suffix is compared beyond its document):

1. Prefix doubling ranks the suffixes; only suffixes that still tie are sorted
   again.  The ranks of all rounds stay, as they give the length that any two
   suffixes have in common (:meth:`Suffixes.common`) and so the LCP array.
2. Every LCP interval is a pair of bounds, found for each LCP by range minima
   (no tree is built).  For each interval of depth d, each suffix i of all its
   children but the largest looks up whether the suffixes i + d and i - d lie in
   the interval too (their ranks against its bounds).  If so, and if the words
   behind differ, two equal stretches of d words stand side by side and the next
   word ends them: a branching square.
3. A branching square is rotated to the left as far as it stays a square; its
   rotations make up the run that ends with it.  Squares of a multiple of a run's
   period within that run are the same run and go.

A run of at least ``min_words`` words and ``min_periods`` >= 2 periods holds two equal
stretches of ``min_words - min_words // min_periods`` words, so documents without such a repeat
are left after the first rounds.

Cases: a null or empty text has no words and no runs and collapses to an empty text;
repeated rows are searched each; a long document is a slice of its own; extra
columns of the input are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textstats as ts
from .range_minima import Minima

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
EXPAND = 1 << 21  # suffixes looked up at once


class Suffixes:
    """Ranks of all suffixes of ``symbols`` after each doubling round, and those that tie after ``depth`` symbols.

    The last symbol of every document occurs once, so equal stretches never reach beyond it.
    """

    def __init__(self, symbols: np.ndarray, depth: int | None = None):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        first = self._starts(symbols[order])
        rank = np.empty(n, np.int64)
        rank[order] = first
        self.rounds = [rank.astype(np.int32)]
        tied = order[self._shared(first)]
        ranked = 1  # symbols that the ranks tell apart
        while len(tied) and (depth is None or ranked < depth):
            step = ranked if depth is None else min(ranked, depth - ranked)
            key = rank[tied] * n + rank[tied + step]
            order = np.argsort(key, kind="stable")
            tied, key = tied[order], key[order]
            group = key // n
            first = self._starts(key)
            rank[tied] = group + first - self._starts(group)
            tied = tied[self._shared(first)]
            ranked += step
            if depth is None:
                self.rounds.append(rank.astype(np.int32))
        self.rank, self.tied = rank, tied

    @staticmethod
    def _starts(ordered: np.ndarray) -> np.ndarray:
        """Place of the first equal value, for each value of a sorted array."""
        at = np.arange(len(ordered))
        at[1:][ordered[1:] == ordered[:-1]] = 0
        return np.maximum.accumulate(at) if len(at) else at

    @staticmethod
    def _shared(first: np.ndarray) -> np.ndarray:
        """Whether others have the same start."""
        out = np.zeros(len(first), bool)
        same = first[1:] == first[:-1]
        out[1:] |= same
        out[:-1] |= same
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes a and b have in common at their start (a differs from b)."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.rounds) - 1, -1, -1):
            out += (self.rounds[k][a + out] == self.rounds[k][b + out]).astype(np.int64) << k
        return out


def _small_children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bounds of every child but the largest of every LCP interval of depth 1 or more, with the interval's depth and bounds.

    ``lcp[k]`` belongs to the suffixes in places k - 1 and k; the first and the last entry are -1.
    """
    at = np.flatnonzero(lcp[1:-1] > 0) + 1
    depth = lcp[at]
    minima = Minima(lcp)
    left = minima.before(at - 1, depth)
    right = minima.after(at + 1, depth) - 1
    end = minima.after(at + 1, depth + 1) - 1  # of the child that starts here
    order = np.lexsort((at, depth, left))  # the splits of an interval stand together
    at, depth, left, right, end = (x[order] for x in (at, depth, left, right, end))
    opens = np.ones(len(at), bool)
    opens[1:] = (left[1:] != left[:-1]) | (depth[1:] != depth[:-1])
    # The first child of an interval ends before the first split.
    begin = np.concatenate((at, left[opens]))
    close = np.concatenate((end, at[opens] - 1))
    depth, left, right = (np.concatenate((x, x[opens])) for x in (depth, left, right))
    interval = np.concatenate((np.cumsum(opens) - 1, np.arange(int(opens.sum()))))
    order = np.lexsort((begin - close, interval))  # the largest first
    small = np.ones(len(order), bool)
    small[np.unique(interval[order], return_index=True)[1]] = False
    pick = order[small]
    return begin[pick], close[pick], depth[pick], left[pick], right[pick]


def branching_squares(symbols: np.ndarray, suffixes: Suffixes, sa: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Rows (start, d): two equal stretches of d symbols side by side whose next symbol ends the period."""
    begin, close, depth, left, right = _small_children(lcp)
    rank, n = suffixes.rank, len(symbols)
    size = close - begin + 1
    upto = np.concatenate(([0], np.cumsum(size)))
    found = []
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + EXPAND, side="right")) - 1)
        child = np.repeat(np.arange(a, b), size[a:b])
        i = sa[np.arange(len(child)) - (upto[child] - upto[a]) + begin[child]]
        d, lo, hi = depth[child], left[child], right[child]
        for start, other in ((i, i + d), (i - d, i - d)):
            ok = (other >= 0) & (other < n)
            ok[ok] = (rank[other[ok]] >= lo[ok]) & (rank[other[ok]] <= hi[ok])
            start, period = start[ok], d[ok]
            ends = symbols[start + period] != symbols[start + 2 * period]
            found.append(np.column_stack((start[ends], period[ends])))
        a = b
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _rotations(suffixes: Suffixes, start: np.ndarray, d: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How far each square can be rotated to the left, at most ``most``."""
    lo, hi = np.zeros(len(start), np.int64), most.copy()
    while np.any(lo < hi):
        mid = (lo + hi + 1) // 2
        at = start - mid
        fits = suffixes.common(at, at + d) >= d + mid
        lo, hi = np.where(fits, mid, lo), np.where(fits, hi, mid - 1)
    return lo


def runs(symbols: np.ndarray, origin: np.ndarray, min_words: int, min_periods: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs; ``origin`` is the first place of each symbol's document."""
    if len(symbols) < 3:
        return []
    suffixes = Suffixes(symbols)
    sa = np.empty(len(symbols), np.int64)
    sa[suffixes.rank] = np.arange(len(symbols))
    lcp = np.concatenate(([-1], suffixes.common(sa[:-1], sa[1:]), [-1]))
    squares = branching_squares(symbols, suffixes, sa, lcp)
    start, d = squares[:, 0], squares[:, 1]
    # min_periods periods are min_periods - 2 periods of rotations.
    more = (min_periods - 2) * d
    ok = start - more >= origin[start]
    start, d, more = start[ok], d[ok], more[ok]
    ok = suffixes.common(start - more, start - more + d) >= more + d
    start, d = start[ok], d[ok]
    turns = _rotations(suffixes, start, d, start - origin[start])
    out, ends = [], {}
    for s, p, t in sorted(zip(start.tolist(), d.tolist(), turns.tolist(), strict=True), key=lambda x: x[1]):
        here = ends.setdefault(s + 2 * p, [])
        if any(p % q == 0 and first <= s for first, q in here):
            continue  # the same run, its period taken several times
        here.append((s - t, p))
        if t + 2 * p >= min_words:
            out.append((s - t, t + 2 * p, p))
    return out


def slice_runs(w: ts.Words, rows: int, min_words: int, min_periods: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (word number, length, period) of each row of a slice that has any, by start, then period."""
    sizes = np.bincount(w.row, minlength=rows)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]

    def laid_out(pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of the picked rows, each followed by its end; first place and row of each symbol's document."""
        n = sizes[pick] + 1
        first = np.concatenate(([0], np.cumsum(n)))[:-1]
        doc = np.repeat(np.arange(len(pick)), n)
        inside = np.arange(int(n.sum())) - first[doc]
        last = inside == n[doc] - 1
        width = len(w.distinct) + 1
        code = np.full(len(doc), width - 1, np.int64)
        code[~last] = w.code[(begin[pick][doc] + inside)[~last]]
        return doc * width + code, first[doc], pick[doc]

    pick = np.flatnonzero(sizes >= min_words)
    if not len(pick):
        return {}
    symbols, _, row = laid_out(pick)
    repeat = Suffixes(symbols, depth=min_words - min_words // min_periods)
    pick = np.unique(row[repeat.tied])
    if not len(pick):
        return {}
    symbols, origin, row = laid_out(pick)
    out: dict[int, list[tuple[int, int, int]]] = {}
    for s, length, p in sorted(runs(symbols, origin, min_words, min_periods)):
        out.setdefault(int(row[s]), []).append((int(s - origin[s]), length, p))
    return {r: sorted(found, key=lambda x: (x[0], x[2])) for r, found in out.items()}


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; ties: smallest start, then period."""
    best = None
    for run in found:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _collapsed(w: ts.Words, rows: int, found: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    """The words that no run repeats, joined by one space."""
    begin = np.concatenate(([0], np.cumsum(np.bincount(w.row, minlength=rows))))
    edges = np.zeros(len(w.code) + 1, np.int64)
    for r, each in found.items():
        for s, length, p in each:
            edges[begin[r] + s + p] += 1
            edges[begin[r] + s + length] -= 1
    kept = np.cumsum(edges[:-1]) == 0
    left = np.bincount(w.row[kept], minlength=rows)
    offsets = pa.array(np.concatenate(([0], np.cumsum(left))).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, w.distinct.cast(pa.string()).take(pa.array(w.code[kept]))), " ")


def _run_lists(rows: int, found: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    sizes = np.zeros(rows, np.int64)
    for r, each in found.items():
        sizes[r] = len(each)
    flat = np.array([x for r in sorted(found) for x in found[r]], np.int64).reshape(-1, 3)
    values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), values)


def periodic_runs(docs: DataFrame, min_words: int = 24, min_periods: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id_col``, ``runs`` by start, then period, the ``strongest`` of them and the ``collapsed`` text of every row."""
    if min_periods < 2 or min_words < 2:
        raise ValueError("a run has at least two words and two periods")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            for first, texts in ts.slices(batch.column(1)):
                n, w = len(texts), ts.words(texts)
                found = slice_runs(w, n, min_words, min_periods)
                lists = _run_lists(n, found)
                best = [strongest(found.get(r, [])) for r in range(n)]
                names = ["start", "length", "period"]
                top = pa.array([b and dict(zip(names, b, strict=True)) for b in best], lists.type.value_type)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), lists, top, _collapsed(w, n, found)],
                    names=[id_col, "runs", "strongest", "collapsed"])

    element = RUNS.removeprefix("array<").removesuffix(">")
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        search, f"{id_col} {dict(docs.dtypes)[id_col]}, runs {RUNS}, strongest {element}, collapsed string")
