"""Substring operators against counting every run of words."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidepanel.llm import suffix_trees, wordhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(given, window):
    """Per row, which words stand in a run of words that also starts elsewhere."""
    words = [WORD.findall(t or "") for _, t in given]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((w, gone))
    return out


def repeating_texts(rows):
    rng = random.Random(12)
    word = lambda n, v=3000: [f"v{rng.randrange(v)}" for _ in range(n)]
    base, passages = word(400), [word(n) for n in (34, 35, 36, 49, 50, 51, 70, 120)]
    given = [(r[0], r[1]) for r in rows]
    for i in range(60):
        text = list(base)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(400)] = "edit"
        given.append((1000 + i, " ".join(text)))
    for i in range(80):
        parts = [word(rng.randrange(60)), rng.choice(passages), word(rng.randrange(60)), rng.choice(passages)[: rng.randrange(20, 120)]]
        given.append((2000 + i, "\n ".join(" ".join(p) for p in parts)))
    given += [(3000, " ".join(["same"] * 500)), (3001, " ".join(["a", "b"] * 60)), (3002, " ".join(base[:34])), (3003, " ".join(base[10:45])), (3004, "x" * 20000)]
    return given


@pytest.mark.parametrize("group", [200_000, 40])
def test_removed_words(spark, rows, docs, empty, monkeypatch, group):
    monkeypatch.setattr(suffix_trees, "GROUP_SUFFIXES", group)
    given = repeating_texts(rows)
    table = spark.createDataFrame(given, "doc_id bigint, text string").repartition(5)
    want = Counter((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()) for (i, _), (w, gone) in zip(given, covered(given, 35), strict=True))
    assert Counter(tuple(r) for r in suffix_trees.remove_repeats(table).collect()) == want
    assert suffix_trees.remove_repeats(empty).count() == 0
    assert suffix_trees.remove_repeats(docs).count() == len(rows)


def test_groups_are_sized_by_prefix():
    counts = np.array([5, 3, 0, 90, 4, 4, 25, 1])
    first, parts = suffix_trees.prefix_groups(counts, 10)
    assert parts.tolist() == [1, 1, 1, 9, 1, 1, 3, 1] and first.tolist() == [0, 0, 0, 1, 10, 10, 11, 14]


def test_run_hashes_and_minimisers():
    rng = random.Random(2)
    texts = [[str(rng.randrange(4)).encode() for _ in range(n)] for n in (0, 3, 40, 100, 11)]
    hashes, flat = wordhash.WordHashes(texts), [w for t in texts for w in t]
    seen = defaultdict(set)
    for i, h in enumerate(hashes.runs(np.arange(len(flat) - 4), 5)):
        seen[tuple(flat[i : i + 5])].add(int(h))
    assert all(len(x) == 1 for x in seen.values()) and len(set.union(*seen.values())) == len(seen)
    starts, least, chosen = wordhash.minimisers(hashes, 20, 5)
    grams = hashes.runs(np.arange(len(flat) - 4), 5) | np.uint64(1)
    assert starts.tolist() == [i for i in range(len(flat)) if i + 20 <= hashes.end[i]]
    for s, m in zip(starts, least, strict=True):
        assert m == grams[s : s + 16].min()
    assert set(chosen.tolist()) == {i for s, m in zip(starts, least, strict=True) for i in range(s, s + 16) if grams[i] == m}


@pytest.mark.parametrize("group", [20_000, 30])
def test_passages(spark, rows, docs, empty, monkeypatch, group):
    from tidepanel.llm import sparse_suffixes

    monkeypatch.setattr(sparse_suffixes, "GROUP_SUFFIXES", group)
    given = repeating_texts(rows)
    table = spark.createDataFrame(given, "doc_id bigint, text string").repartition(5)
    want = Counter()
    for (i, _), (_, gone) in zip(given, covered(given, 50), strict=True):
        for m in re.finditer("1+", "".join("01"[g] for g in gone)):
            want[i, m.start(), len(m[0])] += 1
    assert Counter(tuple(r) for r in sparse_suffixes.repeated_passages(table).collect()) == want and len(want) > 100
    assert sparse_suffixes.repeated_passages(empty).count() == 0
    assert {r["doc_id"] for r in sparse_suffixes.repeated_passages(docs).collect()} <= {r[0] for r in rows}


def test_partners_that_are_no_neighbours_count():
    from tidepanel.llm.sparse_suffixes import WINDOW, _by_distance, passages

    rng = np.random.default_rng(3)
    width = 2 * (WINDOW - 8) + 8
    base = rng.integers(1, 1 << 31, size=(40, width)).astype("<u4")
    base[:, WINDOW - 8 : WINDOW] = base[0, WINDOW - 8 : WINDOW]
    for i in range(1, 40):
        own = rng.integers(0, i)
        cut = rng.integers(WINDOW, width)
        base[i, :cut] = base[own, :cut]
    table = np.arange(40, dtype=np.int64)
    full = np.full(40, WINDOW - 8), np.full(40, WINDOW)
    import pyarrow as pa

    rows = pa.table([pa.array(np.zeros(40, np.int64)), pa.array(table), pa.array(np.full(40, 1000, np.int32)), pa.array(full[0].astype(np.int32)), pa.array(full[1].astype(np.int32)), pa.array([r.tobytes() for r in base]), pa.array(np.zeros(40, np.int32))], names=["gram", "uid", "start", "before", "after", "around", "n"])
    got = defaultdict(set)
    for r in passages(WINDOW)(rows).to_pylist():
        got[r["uid"]] |= set(range(r["start"], r["start"] + r["n"]))
    want = defaultdict(set)
    for uid, start, n in _by_distance(base, table, np.full(40, 1000), *full, WINDOW):
        for u, s, k in zip(uid, start, n, strict=True):
            want[int(u)] |= set(range(int(s), int(s + k)))
    assert got == want and len(want) > 10
