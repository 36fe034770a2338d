"""Repeated passages by sparse suffix arrays.

Of all suffixes only those at minimiser positions are retained: every passage of ``WINDOW`` words has
such a position, the same one in each of its copies, so no passage is missed. A retained suffix
travels with the words around it that a passage through it can reach. Suffixes are grouped by the
eight words they start with, sorted by what follows, and compared with their neighbours; a match is
extended to the left and to the right, and counts from ``WINDOW`` words on. Where more than two
suffixes share a start, a partner that is not a neighbour may reach further to the left; there the
runs at each distance from the position are compared by hash as well, so the result is exact.
Suffixes with the same surroundings in one batch are decided there, and one of them is shuffled.

Surroundings are compared by 32-bit word hashes, the shared start by 64 bits.

Defined cases: null text has no words; null ids stay; rows with equal texts are passages of each other
if they have ``WINDOW`` words; shorter texts have no passage; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import small_batches, split_words, text_or_empty
from tidepanel.llm.repeats import GRAM_WORDS, distinct_texts, repeated_grams, signed, texts_with_repeated_grams
from tidepanel.llm.wordhash import BASE, WordHashes, minimisers
from tidepanel.session import cut_lineage

WINDOW = 50
#: Groups of suffixes that one task sorts at a time, about.
GROUP_SUFFIXES = 20_000
SUFFIXES = "gram bigint, uid bigint, start int, before int, after int, around binary, n int"


def _around(hashes: WordHashes, at: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words on the left, on the right, 32-bit hashes) within ``reach`` words of the gram, zero beyond the text."""
    begin = hashes.begin[np.searchsorted(hashes.begin, at, "right") - 1]
    before = np.minimum(at - begin, reach)
    after = np.minimum(hashes.end[at] - at, GRAM_WORDS + reach)
    places = at[:, None] + np.arange(-reach, GRAM_WORDS + reach)
    inside = (places >= begin[:, None]) & (places < hashes.end[at][:, None])
    short = (hashes.words >> np.uint64(32)).astype(np.uint32)
    return before, after, np.where(inside, short[np.clip(places, 0, len(short) - 1)], 0).astype("<u4")


def _retained(window: int):
    """Suffix rows: n = 0 is open, n = -1 stands for others of its batch, n > 0 is a decided passage of n words at start."""
    reach = window - GRAM_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20, 500):
            hashes = WordHashes([split_words(t) for t in batch.column("text").to_pylist()])
            _, _, chosen = minimisers(hashes, window, GRAM_WORDS)
            chosen = chosen[hashes.fits(GRAM_WORDS)[chosen]]
            gram = hashes.runs(chosen, GRAM_WORDS) | np.uint64(1)
            chosen = chosen[np.isin(gram, repeated_grams(batch))]
            gram = hashes.runs(chosen, GRAM_WORDS) | np.uint64(1)
            uids = np.array(batch.column("uid").to_pylist(), dtype=np.int64)
            uid, start = uids[np.searchsorted(hashes.begin, chosen, "right") - 1], chosen - hashes.begin[np.searchsorted(hashes.begin, chosen, "right") - 1]
            before, after, around = _around(hashes, chosen, reach)
            alike: dict[tuple, list[int]] = {}
            rows = [a.tobytes() for a in around]
            for i, key in enumerate(zip(rows, before.tolist(), after.tolist(), strict=True)):
                alike.setdefault(key, []).append(i)
            out = []
            for own in alike.values():
                i = own[0]
                whole = int(before[i] + after[i])
                settled = len(own) > 1 and whole >= window  # all that any of them can match is decided
                out += [(i, -1)] if settled else [(j, 0) for j in own]
                out += [(j, whole) for j in own] if settled else []
            at, n = np.array([i for i, _ in out], dtype=np.int64), np.array([k for _, k in out], dtype=np.int32)
            place = np.where(n > 0, start[at] - before[at], start[at]).astype(np.int32)
            grams = np.where(n > 0, WordHashes.mix_pairs(uid[at], start[at]), gram[at])
            kept = [rows[i] if k <= 0 else None for i, k in out]
            columns = [signed(grams), pa.array(uid[at]), pa.array(place), pa.array(before[at].astype(np.int32)), pa.array(after[at].astype(np.int32)), pa.array(kept, pa.binary()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "uid", "start", "before", "after", "around", "n"])

    return run


def _common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows, at most ``most``."""
    return np.minimum(np.logical_and.accumulate(a == b, axis=1).sum(axis=1), most)


def passages(window: int):
    """From a table of suffixes to (uid, start, n): matched passages of ``n`` words, n >= window."""
    reach = window - GRAM_WORDS

    def run(group: pa.Table) -> pa.Table:
        gram, uid, start, before, after, n = (np.asarray(group.column(c)).astype(np.int64) for c in ("gram", "uid", "start", "before", "after", "n"))
        decided, live = n > 0, np.flatnonzero(n <= 0)
        found = [(uid[decided], start[decided], n[decided])]
        if len(live):
            text = group.column("around").to_pylist()
            order = live[sorted(range(len(live)), key=lambda i: (gram[live[i]], text[live[i]][4 * reach :]))]  # the suffix array
            around = np.frombuffer(b"".join(text[i] for i in order), dtype="<u4").reshape(len(order), -1)
            gram, uid, start, before, after, n = (x[order] for x in (gram, uid, start, before, after, n))
            same = np.flatnonzero(gram[1:] == gram[:-1])
            right = _common(around[same, reach:], around[same + 1, reach:], np.minimum(after[same], after[same + 1]))
            left = _common(around[same, reach - 1 :: -1], around[same + 1, reach - 1 :: -1], np.minimum(before[same], before[same + 1]))
            hit = left + right >= window
            for i in (same[hit], same[hit] + 1):
                found.append((uid[i], start[i] - left[hit], (left + right)[hit]))
            ends = np.concatenate([[0], np.flatnonzero(gram[1:] != gram[:-1]) + 1, [len(gram)]])
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                if b - a > 2:
                    found += _by_distance(around[a:b], uid[a:b], start[a:b], before[a:b], after[a:b], window)
        keep = _union(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return pa.table([pa.array(keep[0], pa.int64()), pa.array(keep[1], pa.int32()), pa.array(keep[2], pa.int32())], names=["uid", "start", "n"])

    return run


def _union(uid: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of words, overlapping and touching ones of a text joined."""
    if not len(uid):
        return uid, start, n
    order = np.lexsort((start, uid))
    uid, start, n = uid[order], start[order], n[order]
    apart = np.unique(uid, return_inverse=True)[1] * (int((start + n).max()) + 2)
    reached = np.maximum.accumulate(apart + start + n)
    first = np.flatnonzero(np.concatenate([[True], (apart + start)[1:] > reached[:-1]]))
    last = np.concatenate([first[1:], [len(uid)]]) - 1
    return uid[first], start[first], reached[last] - (apart + start)[first]


def _by_distance(around: np.ndarray, uid: np.ndarray, start: np.ndarray, before: np.ndarray, after: np.ndarray, window: int) -> list[tuple]:
    """Passages among suffixes with one start: equal runs of ``window`` words, distance by distance to the left."""
    reach, out = window - GRAM_WORDS, []
    powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(around.shape[1], BASE, dtype=np.uint64)]))[:-1]
    sums = np.concatenate([np.zeros((len(around), 1), np.uint64), np.cumsum((around.astype(np.uint64) + np.uint64(1)) * powers, axis=1, dtype=np.uint64)], axis=1)
    for back in range(reach + 1):
        inside = np.flatnonzero((before >= back) & (after >= window - back))
        if len(inside) > 1:
            run = sums[inside, reach - back + window] - sums[inside, reach - back]
            _, of, count = np.unique(run, return_inverse=True, return_counts=True)
            hit = inside[count[of] > 1]
            out.append((uid[hit], start[hit] - back, np.full(len(hit), window, dtype=np.int64)))
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for digest, spans in zip(batch.column("text_sha256").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            begin = end = None
            for s, e in sorted((x["start"], x["start"] + x["n"]) for x in spans):
                if end is not None and s <= end:
                    end = max(end, e)
                    continue
                if end is not None:
                    rows.append((digest, begin, end - begin))
                begin, end = s, e
            rows.append((digest, begin, end - begin))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["text_sha256", "start_word", "n_words"])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        sizes = [len(split_words(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_sha256"), pa.array(sizes, pa.int64())], ["doc_id", "text_sha256", "whole"])


def repeated_passages(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and maximal stretch of words in repeated passages: ``doc_id, start_word, n_words``."""
    texts, copies = distinct_texts(docs, text_col)
    affected = texts_with_repeated_grams(texts, window)
    suffixes = affected.select("uid", "text", "grams").mapInArrow(_retained(window), SUFFIXES)
    retained = affected.agg(F.sum(F.size("grams"))).first()[0] or 0
    groups = max(1, -(-2 * retained // GROUP_SUFFIXES))
    found = suffixes.groupBy(F.pmod("gram", F.lit(groups)).alias("group")).applyInArrow(passages(window), "uid bigint, start int, n int")
    of_text = found.groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))  # at most a text's own places
    merged = affected.select("uid", "text_sha256").join(of_text, "uid").drop("uid").mapInArrow(_merge, "text_sha256 string, start_word bigint, n_words bigint")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    rows = cut_lineage(plain.mapInArrow(_sizes, "doc_id bigint, text_sha256 string, whole bigint"))
    whole = rows.where(F.col("whole") >= window).join(copies, "text_sha256", "left_semi").select("doc_id", F.lit(0).cast("long").alias("start_word"), F.col("whole").alias("n_words"))
    return rows.join(merged.join(copies, "text_sha256", "left_anti"), "text_sha256").select("doc_id", "start_word", "n_words").unionByName(whole)
