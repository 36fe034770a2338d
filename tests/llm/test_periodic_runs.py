import hashlib
import random
from collections import Counter
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import KINDS
from tidepanel.llm.periodic_runs import collapsed, numbered, periodic_runs, planted, run_digests, runs_of, suffix_array

word = st.sampled_from([b"a", b"b", b"c"])
repeated = st.builds(lambda u, k, tail: u * k + tail, st.lists(word, min_size=1, max_size=4), st.integers(1, 9), st.lists(word, max_size=3))
text = st.lists(repeated, max_size=4).map(lambda parts: [w for p in parts for w in p])


def slow_runs(words, least_length=6, exponent=4):
    """Every period, every stretch; the smallest period of an extent stays."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                if j + q - i >= max(least_length, exponent * q):
                    found.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(text, max_size=5), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_of_a_batch(texts, least):
    assert runs_of(texts, *least) == [slow_runs(t, *least) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(text, min_size=1, max_size=4))
def test_suffix_array(texts):
    words, begin = numbered(texts)
    if not len(words):
        return
    of = [k for k, t in enumerate(texts) for _ in range(len(t) + 1)]
    import numpy as np

    sa, isa, lcp = suffix_array(words, np.array(of), len(words) + 1)
    suffix = lambda i: (of[i], words[i : begin[of[i] + 1]].tolist())
    order = [suffix(i) for i in sa.tolist()]
    assert order == sorted(order) and isa[sa].tolist() == list(range(len(words)))
    for k in range(1, len(words)):
        (p, a), (q, b) = order[k - 1], order[k]
        same = 0
        while p == q and same < min(len(a), len(b)) and a[same] == b[same]:
            same += 1
        assert lcp[k] == same


def test_long_and_highly_repetitive_texts():
    assert runs_of([[b"x"] * 50_000]) == [[(0, 50_000, 1)]]
    assert runs_of([[b"a", b"b", b"c"] * 9_000 + [b"a", b"z"]]) == [[(0, 27_001, 3)]]
    rng = random.Random(1)
    unit = [b"w%d" % rng.randrange(50) for _ in range(700)]
    own = [b"q"] + unit * 5 + unit[:13] + [b"r"]
    assert runs_of([own]) == [slow_runs(own)] == [[(1, 3513, 700)]]


def slow_row(doc_id, text):
    words = planted(doc_id, (text or "").encode("utf-8").split())
    runs = slow_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_rows(spark, docs, rows):
    got = run_digests(periodic_runs(docs, rewrite=planted))
    want = Counter(slow_row(r[0], r[1]) for r in rows)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(r[1] > 0 for r in want) >= 5
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_planted_stretch():
    import zlib

    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g, words = zlib.crc32(str(doc_id).encode()) // 10, [b"%d" % i for i in range(97)]
    a = g % 97
    p = 1 + (97 - a) // (3 + g % 8)
    assert planted(doc_id, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(97)]
    assert planted(doc_id, []) == [] and planted(None, words) == words


def test_empty_table_and_collapse(spark):
    assert run_digests(periodic_runs(spark.createDataFrame([], KINDS))).count() == 0
    assert collapsed([b"a"] * 7 + [b"b"], [(0, 7, 1)]) == b"a b"
    assert collapsed([], []) == b""
