"""Exact dedup, shards, token counts and SimHash against brute force on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tidepanel.llm import exact_dedup, sharding, simhash, token_counts

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256((text or "").translate(UP).encode()).hexdigest()


def test_exact_duplicates(docs, rows):
    found = exact_dedup.exact_duplicates(docs).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[sha(r[1])].append(r[0])
    keep = {h: max((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    assert Counter((r["doc_id"], r["text_sha256"]) for r in found) == Counter((r[0], sha(r[1])) for r in rows)
    for r in found:
        assert r["keep_id"] == keep[r["text_sha256"]] and r["group_size"] == len(groups[r["text_sha256"]])
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert Counter(r["text_sha256"] for r in found if r["kept"]) == Counter(dict.fromkeys(groups, 1))


def test_a_small_bit_field_gives_the_same_answer(docs, monkeypatch):
    want = sorted(map(str, exact_dedup.exact_duplicates(docs).collect()))
    monkeypatch.setattr(exact_dedup, "MOST_BITS", 64)
    assert sorted(map(str, exact_dedup.exact_duplicates(docs).collect())) == want


def test_rows_that_stay(docs, rows, empty):
    out = exact_dedup.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert Counter(sha(r["text"]) for r in out.collect()) == Counter({sha(r[1]): 1 for r in rows})
    assert exact_dedup.drop_exact_duplicates(empty).count() == exact_dedup.exact_duplicates(empty).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_shards(spark, docs, empty, hot):
    source = docs.unionByName(spark.range(1000, 3000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'copy', md5(string(id))) AS text"), allowMissingColumns=True) if hot else docs
    found = sharding.shard_by_bytes(source, 7).collect()
    given = [(r["doc_id"], r["text"] or "") for r in source.collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in given)
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 7
    total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 7) <= 2 * largest + 0.04 * total / 7
    groups = defaultdict(set), Counter()
    for r in found:
        groups[0][r["text_crc32"]].add(r["shard"])
        groups[1][r["text_crc32"]] += r["size"]
    assert all(len(s) == 1 for c, s in groups[0].items() if groups[1][c] * 7 * 50 <= total)
    assert sharding.shard_by_bytes(empty).count() == 0


def test_token_counts_and_cache(spark, docs, rows, empty, tmp_path):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    tokenizer = Tokenizer.from_file(path)
    want = Counter((r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    half = docs.where("doc_id < 10")
    token_counts.token_counts(half, path, cache).collect()
    first = spark.read.parquet(cache).count()
    assert first == len({r[1] or "" for r in rows if r[0] is not None and r[0] < 10})
    found = token_counts.token_counts(docs, path, cache).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in found) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in found)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({r[1] or "" for r in rows})
    token_counts.token_counts(docs, path, cache).collect()
    assert spark.read.parquet(cache).count() == stored.count()
    stored.write.mode("append").parquet(cache)  # as two writers or a repeated run leave it
    again = token_counts.token_counts(docs, path, cache).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in again) == want
    other = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.token_counts(docs.where("doc_id = 8"), other, cache).first()["n_tokens"] > 0
    assert token_counts.token_counts(empty, path, cache).count() == 0


def test_long_texts_are_cut_where_tokens_end():
    rng = random.Random(3)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        for _ in range(60):
            text = "".join(rng.choice(["ab", "Cd", " ", "  ", "\n", " \n", "é", "ß ", "'s", " 12", "!", "<|endoftext|>", "́", "　"]) for _ in range(300))
            cut = token_counts.pieces(text, 20)
            assert "".join(cut) == text
            assert [i for p in cut for i in tokenizer.encode(p, add_special_tokens=False).ids] == tokenizer.encode(text, add_special_tokens=False).ids


def slow_fingerprint(text):
    words = [w for w in (text or "").translate(UP).replace("\t", " ").replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, near):
    root = {n: n for n in nodes}
    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_simhash_against_all_pairs(spark, docs, rows, empty):
    found = simhash.simhash_components(docs).collect()
    prints = [(r[0], slow_fingerprint(r[1])) for r in rows]
    assert Counter((r["doc_id"], r["fingerprint"]) for r in found) == Counter((i, f"{p:016x}") for i, p in prints)
    roots = slow_components(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, p in prints:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    assert Counter((r["doc_id"], r["component_id"]) for r in found) == Counter((i, least.get(roots[p])) for i, p in prints)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {None, *least.values()}
    assert simhash.simhash_components(empty).count() == simhash.drop_near_duplicates(empty).count() == 0


def test_links_join_the_components_of_all_pairs(spark):
    rng = random.Random(9)
    values = {0, (1 << 64) - 1}
    for _ in range(6):
        v = rng.getrandbits(64)
        for _ in range(25):
            values.add(v)
            v ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                v ^= 1 << rng.randrange(64)
            if rng.random() < 0.15:
                v ^= rng.getrandbits(64)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    from tidepanel.llm.components import components

    nodes = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    got = {r["node"]: r["root"] for r in components(simhash.links(nodes)).collect()}
    want = slow_components(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    smallest = {}
    for n, r in want.items():
        smallest[r] = min(n, smallest.get(r, n))
    assert {n: got.get(n, n) for n in signed} == {n: smallest[r] for n, r in want.items()}
