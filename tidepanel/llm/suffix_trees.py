"""Repeated runs of words by prefix-partitioned suffix trees.

A suffix is a place in a text, read for ``WINDOW`` words, since nothing deeper matters. Suffixes are
split into groups by prefix: by their first 5 words as long as such a group fits in memory, by 15
where it does not, and by all words where even that is too much. In each group the sorted
suffixes with the common depth of neighbours are the group's suffix tree; its edges are read
in blocks of words (15 and 20), each one symbol of 64 bits. Leaves below an internal node of full
depth are places of a repeated run; such places side by side make up the maximal repeats. Runs
that repeat inside one batch of texts are decided there, and only one of them is shuffled.

Only suffixes whose least gram is repeated are shuffled (see ``repeats``). Runs are judged on the
input. Equal texts enter once; a text with a copy and at least a window of words is removed whole.

Defined cases: null text has no words; null ids stay; repeated rows are copies of each other; texts
shorter than a window lose nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import small_batches, split_words, text_or_empty
from tidepanel.llm.repeats import GRAM_WORDS, distinct_texts, repeated_grams, signed, texts_with_repeated_grams
from tidepanel.llm.wordhash import WordHashes, minimisers

WINDOW = 35
SHORT_PREFIX, LONG_PREFIX = 5, 15
#: Suffixes in one tree, and buckets of short prefixes that are counted to form the groups.
GROUP_SUFFIXES = 200_000
BUCKETS = 1 << 16
SUFFIXES = "group int, a bigint, b bigint, uid bigint, start int, n int"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _candidates(batch: pa.RecordBatch, window: int) -> tuple[WordHashes, np.ndarray]:
    """Starts of the runs whose least gram is repeated."""
    hashes = WordHashes([split_words(t) for t in batch.column("text").to_pylist()])
    starts, least, _ = minimisers(hashes, window, GRAM_WORDS)
    return hashes, starts[np.isin(least, repeated_grams(batch))]


def _bucket(hashes: WordHashes, starts: np.ndarray) -> np.ndarray:
    return (hashes.runs(starts, SHORT_PREFIX) >> np.uint64(48)).astype(np.int64)


def _count_prefixes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in small_batches(batches, "text"):
            total += np.bincount(_bucket(*_candidates(batch, window)), minlength=BUCKETS)
        live = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(live), pa.array(total[live])], ["bucket", "n"])

    return run


def prefix_groups(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket of short prefixes, its first group and its number of groups.

    Small neighbouring buckets share a group; a bucket above ``most`` suffixes gets several.
    """
    first, parts = np.zeros(len(counts), dtype=np.int64), np.ones(len(counts), dtype=np.int64)
    group, held = 0, 0
    for bucket, n in enumerate(counts.tolist()):
        if held and held + n > most:
            group, held = group + 1, 0
        first[bucket] = group
        if n > most:
            parts[bucket] = -(-n // most)
            group, held = group + int(parts[bucket]), 0
        else:
            held += n
    return first, parts


def _ranges(uid: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(uid, start, n) of places side by side; input sorted by uid and start."""
    if not len(uid):
        return uid, start, start
    new = np.flatnonzero(np.concatenate([[True], (uid[1:] != uid[:-1]) | (start[1:] != start[:-1] + 1)]))
    return uid[new], start[new], np.diff(np.concatenate([new, [len(uid)]]))


def _suffixes(window: int, first: np.ndarray, parts: np.ndarray):
    """Suffix rows: n = 0 is open, n = -1 stands for others of its batch, n > 0 are n decided places from start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            hashes, at = _candidates(batch, window)
            a, b = hashes.runs(at, LONG_PREFIX), hashes.runs(at + LONG_PREFIX, window - LONG_PREFIX)
            bucket = _bucket(hashes, at)
            deep = np.where(parts[bucket] > 16, WordHashes.mix_pairs(a, b), a)
            group = first[bucket] + (deep % parts[bucket].astype(np.uint64)).astype(np.int64)
            text = np.searchsorted(hashes.begin, at, "right") - 1
            uid, start = np.array(batch.column("uid").to_pylist(), dtype=np.int64)[text], at - hashes.begin[text]
            order = np.lexsort((b, a))
            same = np.concatenate([[False], (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])])
            leader = np.flatnonzero(~same)
            size = np.diff(np.concatenate([leader, [len(order)]]))
            one, many = order[leader[size == 1]], order[leader[size > 1]]
            local = np.sort(order[np.repeat(size > 1, size)])
            own_uid, own_start, own_n = _ranges(uid[local], start[local])
            send = np.concatenate([one, many])
            spread = (WordHashes.mix_pairs(own_uid, own_start) % np.uint64(max(1, int(first[-1] + parts[-1])))).astype(np.int64)
            zeros = np.zeros(len(own_uid), dtype=np.uint64)
            columns = [np.concatenate([group[send], spread]).astype(np.int32), signed(np.concatenate([a[send], zeros])), signed(np.concatenate([b[send], zeros])), np.concatenate([uid[send], own_uid]),
                       np.concatenate([start[send], own_start]).astype(np.int32), np.concatenate([np.zeros(len(one), np.int32), np.full(len(many), -1, np.int32), own_n.astype(np.int32)])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["group", "a", "b", "uid", "start", "n"])

    return run


def subtree_repeats(group: pa.Table) -> pa.Table:
    """Places below the deep internal nodes of one group's suffix tree."""
    a, b, uid, start, n = (np.asarray(group.column(c)) for c in ("a", "b", "uid", "start", "n"))
    decided, suffixes = n > 0, np.flatnonzero(n <= 0)
    order = suffixes[np.lexsort((b[suffixes], a[suffixes]))]
    # depth at which neighbouring leaves part: 0 or 1 symbol, or 2, which is the full window
    depth = np.where(a[order][1:] != a[order][:-1], 0, np.where(b[order][1:] != b[order][:-1], 1, 2))
    deep = np.concatenate([[False], depth == 2, [False]])
    leaves = order[(deep[:-1] | deep[1:]) & (n[order] == 0)]
    columns = [np.concatenate([uid[decided], uid[leaves]]), np.concatenate([start[decided], start[leaves]]), np.concatenate([n[decided], np.ones(len(leaves), dtype=n.dtype)])]
    return pa.table([pa.array(c) for c in columns], names=["uid", "start", "n"])


def _covered(size: int, places: list[dict], window: int) -> np.ndarray:
    """Which words stand in a repeated run; a place covers ``n`` starts and the window from the last."""
    edge = np.zeros(size + 1, dtype=np.int64)
    for p in places:
        edge[p["start"]] += 1
        edge[p["start"] + p["n"] + window - 1] -= 1
    return np.cumsum(edge)[:size] > 0


def _trim(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            removed, digest = [], []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
                words = split_words(text)
                gone = _covered(len(words), places, window)
                removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("text_sha256"), pa.array(removed, pa.int64()), pa.array(digest, pa.string())], ["text_sha256", "removed", "trimmed_sha256"])

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        words = [split_words(t) for t in batch.column("text").to_pylist()]
        found = [pa.array([len(w) for w in words], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_sha256"), *found], ["doc_id", "text_sha256", "n_words", "whole_sha256"])


def repeated_places(docs: DataFrame, window: int, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(affected texts, their repeated places, digests of texts with copies)."""
    texts, copies = distinct_texts(docs, text_col)
    affected = texts_with_repeated_grams(texts, window)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in affected.select("text", "grams").mapInArrow(_count_prefixes(window), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]  # at most BUCKETS rows
    suffixes = affected.select("uid", "text", "grams").mapInArrow(_suffixes(window, *prefix_groups(counts, GROUP_SUFFIXES)), SUFFIXES)
    return affected, suffixes.groupBy("group").applyInArrow(subtree_repeats, "uid bigint, start int, n int"), copies


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``; the kept words are joined by one space."""
    affected, places, copies = repeated_places(docs, window, text_col)
    of_text = places.groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("places"))  # at most a text's own words
    trimmed = affected.select("uid", "text_sha256", "text").join(of_text, "uid").drop("uid").mapInArrow(_trim(window), "text_sha256 string, removed bigint, trimmed_sha256 string")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    whole = plain.mapInArrow(_whole, "doc_id bigint, text_sha256 string, n_words bigint, whole_sha256 string")
    gone = F.col("copied") & (F.col("n_words") >= window)
    return (
        whole.join(trimmed, "text_sha256", "left").join(copies.withColumn("copied", F.lit(True)), "text_sha256", "left")
        .select("doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
                F.when(gone, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("trimmed_sha256", "whole_sha256")).alias("kept_sha256"))
    )
