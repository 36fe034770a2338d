"""Periodic runs of words in each text, by the branching-tandem test on an enhanced suffix array.

The texts of a batch get one suffix array (by words, with a terminator of its own after every text, so
nothing crosses a text) with ranks (ISA) and common prefixes (LCP) of neighbours. The arrays stand for the
suffix tree: an LCP interval [l, r] of depth d is an internal node, places in it where the LCP equals d cut
it into its children. For every suffix i in all children of an interval but its largest, i + d and i - d are
looked up in ISA: where both of a pair lie in [l, r], the d words at i and at i + d are equal. The square
at i branches if the words behind it differ, and then it is the right end of a run. Squares are
rotated to the left as far as the words allow, which gives the run; of squares with the same right end
that belong to one run, the smallest period is kept (the others are its multiples). No tree nodes are built;
intervals come from nearest smaller values, all in vector operations.

Only squares that could reach the wanted length are rotated: the words before them are compared first.
Words are compared by numbers that a batch gives to its distinct words, never by hashes. Depths
above a text's length divided by ``least_exponent`` cannot belong to a run, so sorting stops there.

Cost: n log n for a text of n words, in one task, some 210 bytes a word beside the words themselves; batches are cut by
``BATCH_BYTES`` and only a longer text exceeds it.

Defined cases: a null text has no words and no run; texts shorter than the least length have no run; a long
text is searched whole; runs may overlap or lie within each other, and each is told; repeated rows give
repeated results; null ids stay; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import small_batches, split_words

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
BATCH_BYTES, BATCH_ROWS = 1 << 20, 2000
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class _Numbers(dict):
    """Numbers for words in the order they come, from ``first``."""

    def __init__(self, first: int):
        super().__init__()
        self.first = first

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.first + len(self)
        return number


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(words as numbers, begins of the texts): equal words have equal numbers; every text ends with a number of its own."""
    number = _Numbers(len(texts)).__getitem__
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    words = np.empty(int(begin[-1]), dtype=np.int64)
    for k, text in enumerate(texts):
        words[begin[k] : begin[k + 1] - 1] = np.fromiter(map(number, text), dtype=np.int64, count=len(text))
        words[begin[k + 1] - 1] = k  # the terminator
    return words, begin


def suffix_array(words: np.ndarray, text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(SA, ISA, LCP) of the suffixes, sorted by text and then by their first ``depth`` words or more.

    ``LCP[k]`` belongs to SA[k - 1] and SA[k]. Ranks are first places of groups; each round sorts
    the groups by the ranks ``reach`` words further and doubles it. The ranks of all rounds give the LCP.
    """
    n = len(words)
    key = text * (int(words.max(initial=0)) + 1) + words
    sa = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[sa][1:] != key[sa][:-1]])
    isa = np.empty(n, dtype=np.int64)
    isa[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    history, reach = [isa.astype(np.int32 if n < 1 << 31 else np.int64)], 1
    lcp = np.zeros(n, dtype=np.int64)
    open_ = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    while len(open_) and reach < depth:
        suffix = sa[open_]
        group = isa[suffix]
        order = np.lexsort((isa[suffix + reach], group))
        suffix, group, behind = suffix[order], group[order], isa[suffix + reach][order]
        sa[open_] = suffix
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])])
        # neighbours of one group that part in this round
        part = np.flatnonzero(new[1:] & (group[1:] == group[:-1])) + 1
        a, b, same = suffix[part - 1] + reach, suffix[part] + reach, np.full(len(part), reach)
        for ranks, step in zip(reversed(history[:-1]), (reach >> k for k in range(1, len(history))), strict=True):
            equal = ranks[a] == ranks[b]
            same += equal * step
            a, b = a + equal * step, b + equal * step
        lcp[open_[part]] = same
        isa[suffix] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        reach *= 2
        history.append(isa.astype(history[0].dtype))
        open_ = open_[~(new & np.concatenate([new[1:], [True]]))]
    # what is still together agrees in all the words that matter
    together = np.zeros(n, dtype=bool)
    together[1:] = isa[sa[1:]] == isa[sa[:-1]]
    lcp[together] = reach
    isa[sa] = np.arange(n)
    return sa, isa, lcp


def _nearest_smaller(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each of ``places``, the nearest earlier place with a smaller value; there must be one."""
    levels = [values]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append(np.minimum(last[0::2], np.append(last[1::2], last[-1:])[: len(last[0::2])]))
    own, found, height = values[places], np.full(len(places), -1, dtype=np.int64), np.zeros(len(places), dtype=np.int64)
    block, todo = places.copy(), np.arange(len(places))
    for k, level in enumerate(levels):  # climb until the block on the left holds a smaller value
        left = np.maximum(block[todo] - 1, 0)
        hit = (block[todo] & 1 == 1) & (level[left] < own[todo])
        found[todo[hit]], height[todo[hit]] = left[hit], k
        todo = todo[~hit]
        if not len(todo):
            break
        block[todo] >>= 1
    down = np.flatnonzero(height > 0)
    for k in range(len(levels) - 1, 0, -1):  # descend to its last one
        now = down[height[down] >= k]
        level, right = levels[k - 1], 2 * found[now] + 1
        right = np.where(right < len(level), right, right - 1)
        found[now] = np.where(level[right] < own[now], right, 2 * found[now])
    return found


def lcp_intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(intervals, children): rows (depth, first, behind the last) and (number of the interval, first, behind the last)."""
    cuts = np.flatnonzero(lcp > 0)
    closed = np.append(lcp, 0)
    first = _nearest_smaller(closed, cuts)
    last = len(closed) - 1 - _nearest_smaller(closed[::-1], len(closed) - 1 - cuts)
    order = np.lexsort((cuts, last, first))
    cuts, first, last = cuts[order], first[order], last[order]
    new = np.concatenate([[True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])])[: len(cuts)]
    heads, number = np.flatnonzero(new), np.cumsum(new) - 1
    ends = np.where(np.append(new[1:], True)[: len(cuts)], last, np.append(cuts[1:], 0)[: len(cuts)])
    children = np.stack([np.concatenate([number[heads], number]), np.concatenate([first[heads], cuts]), np.concatenate([cuts[heads], ends])])
    return np.stack([lcp[cuts[heads]], first[heads], last[heads]]), children


def branching_squares(words: np.ndarray, text: np.ndarray, sizes: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching squares that may end a run of ``exponent`` periods."""
    sa, isa, lcp = suffix_array(words, text, int(sizes.max(initial=0)) // exponent + 1)
    nodes, children = lcp_intervals(lcp)
    depth, first, last = nodes
    # a run of so many periods has as many suffixes that share the first one
    fit = (last - first >= exponent) & (depth * exponent <= sizes[text[sa[first]]])
    children = children[:, fit[children[0]]]
    number, lo, hi = children[:, np.lexsort((-(children[2] - children[1]), children[0]))]
    small = np.concatenate([[False], number[1:] == number[:-1]])[: len(number)]  # all but an interval's largest child
    number, lo, width = number[small], lo[small], (hi - lo)[small]
    offset = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
    node, i = np.repeat(number, width), sa[np.repeat(lo, width) + offset]
    d, l, r = depth[node], first[node], last[node]
    found = []
    for start, other in ((i, i + d), (i - d, i - d)):
        rank = isa[np.clip(other, 0, len(words) - 1)]
        met = (other >= 0) & (rank >= l) & (rank < r)
        start, q = start[met], d[met]
        branches = words[start + q] != words[start + 2 * q]
        found.append(np.stack([start[branches], q[branches]]))
    squares = np.unique(np.concatenate(found, 1), axis=1)
    return squares[0], squares[1]


def _rotations(words: np.ndarray, start: int, period: int) -> int:
    """How far a square can be rotated to the left."""
    done, step = 0, 64
    while True:
        lo = max(0, start - done - step)
        a, b = words[lo : start - done], words[lo + period : start - done + period]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + len(a) - 1 - int(differ[-1])
        done, step = done + len(a), 2 * step
        if lo == 0:
            return done


def runs_of(texts: list[list[bytes]], least_length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """For each text its runs (start, length, period) of at least ``least_length`` words and ``exponent`` periods, by start, then period."""
    words, begin = numbered(texts)
    sizes = np.diff(begin) - 1
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(words):
        return out
    start, period = branching_squares(words, text, sizes, exponent)
    wanted = np.maximum(least_length, exponent * period)
    for k in range(1, 9):  # most squares stand alone: the words before them differ at once
        # before a text stands the terminator of another, which equals nothing
        at = np.maximum(start - k, -1)
        go_on = (2 * period + k > wanted) | (words[at] == words[at + period])
        start, period, wanted = start[go_on], period[go_on], wanted[go_on]
    end = start + 2 * period
    order, before = np.lexsort((period, end)), (-1, [])
    for s, q, e, least in zip(start[order].tolist(), period[order].tolist(), end[order].tolist(), wanted[order].tolist(), strict=True):
        known = before[1] if before[0] == e else []
        if not any(q % p == 0 and run_start <= s for run_start, p in known):
            run_start = s - _rotations(words, s, q)
            if e - run_start >= least:
                known.append((run_start, q))
                at = int(text[s])
                out[at].append((run_start - int(begin[at]), e - run_start, q))
        before = (e, known)
    for found in out:
        found.sort(key=lambda run: (run[0], run[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(w for w, held in zip(words, np.cumsum(edge).tolist(), strict=False) if not held)


def _strongest(runs: list[tuple[int, int, int]]) -> dict | None:
    """The run of the greatest exponent; of equal ones the first, then that of the smallest period."""
    best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=None)
    return None if best is None else dict(zip(("start", "length", "period"), best, strict=True))


def _found(least_length: int, exponent: int, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        for batch in small_batches(batches, "text", BATCH_BYTES, BATCH_ROWS):
            ids = batch.column("doc_id").to_pylist()
            texts = [split_words(t or "") for t in batch.column("text").to_pylist()]
            if rewrite:
                texts = [rewrite(i, t) for i, t in zip(ids, texts, strict=True)]
            runs = runs_of(texts, least_length, exponent)
            lists = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs]
            kept = [collapsed(t, found).decode("utf-8", "surrogatepass") for t, found in zip(texts, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(lists, pa.list_(kind)), pa.array([_strongest(found) for found in runs], kind), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )

    return run


def periodic_runs(
    docs: DataFrame, least_length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT, id_col: str = "doc_id", text_col: str = "text",
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs`` (start, length, period), ``strongest`` and ``collapsed``, the text
    without the words that a run holds after its first period. ``rewrite`` may change the words before the search."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(_found(least_length, exponent, rewrite), f"doc_id bigint, n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A repeated stretch at the end of every tenth document (by the CRC-32 of its decimal id), with place and period from the id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * -(-(n - a) // p))[: n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """Counts and hashes of ``periodic_runs``, and the strongest run."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best: Column = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
