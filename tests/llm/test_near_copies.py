"""Near copies against all pairs at similarity 0.8 on five-word shingles."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm.conftest import KINDS, prose
from tests.llm.test_dedup_shards_counts import UP
from tidepanel.llm import near_copies, simhash


def slow_set(text):
    words = (text or "").translate(UP).encode("utf-8", "surrogatepass").split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def slow_near(rows):
    """The rows that stay: ids that are the smallest of their component, and rows without an id."""
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or a and b and 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter(r for k, r in enumerate(rows) if r[0] is None or r[0] == least[find(k)])


def changed(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_stage_against_all_pairs(spark, rows, empty):
    rng = random.Random(11)
    base, line = prose(rng, 150, 4000), prose(rng, 20, 4000)
    given = [(r[0], r[1]) for r in rows]
    given += [(300 + i, changed(rng, base, i % 6)) for i in range(60)]
    given += [(400 + i, prose(rng, 40, 4000) + " " + line) for i in range(40)]
    for i in range(30):
        text = prose(rng, rng.randrange(20, 200), 4000)
        given += [(500 + 2 * i, text), (501 + 2 * i, changed(rng, text, 1 + i % 3))]
    given += [(300, "another text of the same id"), (None, changed(rng, base, 1))]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, None, None, None) for i, t in given], KINDS).repartition(3)
    stage = dict(corpus_pipeline.STAGES)["near dedup"]
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"]) for r in out.collect())
    want = slow_near(given)
    assert kept == want and 60 < len(given) - sum(want.values())
    assert stage(spark, empty, "").count() == 0


def test_stage_on_given_documents(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, "")
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == slow_near(given)


def test_the_stage_takes_its_first_pairs_from_ball_hashing(spark, rows, monkeypatch):
    prints = sorted({simhash.fingerprint(t) for _, t, *_ in rows} | {5, 6, 1 << 40, 3 << 40, 7 << 40})
    nodes = [(100 * k + copy, fp - (1 << 64) if fp >> 63 else fp) for k, fp in enumerate(prints) for copy in range(1 + k % 2)]
    found = near_copies.ball_pairs(spark.createDataFrame(nodes, "node bigint, fp bigint")).collect()
    of = dict(nodes)
    root = {n: n for n in of}

    def find(n):
        return n if root[n] == n else find(root[n])

    for a, b in found:
        assert ((of[a] ^ of[b]) & (1 << 64) - 1).bit_count() <= simhash.RADIUS
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a in of for b in of if ((of[a] ^ of[b]) & (1 << 64) - 1).bit_count() <= simhash.RADIUS)
    asked, ball_hashing = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda nodes: asked.append(nodes) or ball_hashing(nodes))
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string")
    assert dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, "").count() == sum(slow_near([(r[0], r[1]) for r in rows]).values())
    assert len(asked) == 1


def test_altered_copies_meet_the_least_altered_one_and_not_each_other(spark, monkeypatch):
    rng = random.Random(5)
    base, compared, links = prose(rng, 150, 4000), [], near_copies._links
    given = [(i, changed(rng, base, i % 4)) for i in range(240)]
    monkeypatch.setattr(near_copies, "_links", lambda pairs, sets: compared.append(pairs.distinct().count()) or links(pairs, sets))
    out = near_copies.drop_near_copies(spark.createDataFrame(given, "doc_id bigint, text string"))
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == slow_near(given)
    assert sum(compared) < 4 * len(given)


def test_shingles_meet_on_64_bits(spark, monkeypatch):
    low, met, links = {}, [], near_copies._links
    for i in range(200_000):
        low.setdefault(int(near_copies.shingles(t := f"w{i} a b c d")[0]) & 0xFFFFFFFF, []).append(t)
    given = [(i, t) for i, t in enumerate(t for group in low.values() if len(group) > 1 for t in group)]
    assert given  # texts whose only shingles agree on 32 bits
    monkeypatch.setattr(near_copies, "_links", lambda pairs, sets: met.append(pairs.count()) or links(pairs, sets))
    assert near_copies.drop_near_copies(spark.createDataFrame(given, "doc_id bigint, text string")).count() == len(given)
    assert sum(met) == 0
