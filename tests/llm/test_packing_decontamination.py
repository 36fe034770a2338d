"""Packing as an exact round trip; decontamination against comparing every passage with every item."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidepanel.llm import common, decontaminate, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_encode_as_the_library_does(tokenizer):
    rng, encode = random.Random(4), packing.WordEncoder(PATH)
    parts = ["ab", "Cd", " ", "  ", "\n", "\t", "é", "É", "ß", "İ", "Σ", "σς", "́", "'s", "'LL", "12", "!", "?!", "<|endoftext|>", "<|StartOfText|>", "　", "\x1f", "\x85", "日本", "ﬁ", "ǅ", "²", "_", "\x00", "a.", "W,"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        assert list(np.frombuffer(encode(text), dtype="<u2")) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_full_memo_is_emptied(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MEMO_WORDS", 20)
    monkeypatch.setattr(packing, "STRETCH", 30)
    encode = packing.WordEncoder(PATH)
    for i in range(30):
        text = " ".join(f"word{chr(97 + j % 26)}{chr(97 + i % 26)}, x" for j in range(15))
        assert list(np.frombuffer(encode(text), dtype="<u2")) == tokenizer.encode(text, add_special_tokens=False).ids


def check_round_trip(pieces, given, tokenizer):
    want = defaultdict(list)
    for i, text in given:
        want[i].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(want)
    for i, texts in want.items():
        if len(texts) > 1:  # repeated ids: only the amounts can be told
            assert sum(p["length"] for p in by_doc[i]) == sum(map(len, texts))
            continue
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            ids = texts[0][at : at + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(texts[0])
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
            at += p["length"]
        assert at == len(texts[0])
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW and at & (at - 1) == 0  # a full window or a smaller power of two: no padding


@pytest.mark.parametrize("rows_a_shard", [4000, 20])
def test_packing_round_trip(docs, rows, empty, tokenizer, monkeypatch, rows_a_shard):
    monkeypatch.setattr(packing, "SHARD_ROWS", rows_a_shard)
    check_round_trip(packing.pack_documents(docs, PATH).collect(), [(r[0], r[1]) for r in rows], tokenizer)
    assert packing.pack_documents(empty, PATH).count() == 0


def test_neighbours_fill_the_window_of_their_seed():
    rng = np.random.default_rng(1)
    topics = [rng.integers(k * 500, k * 500 + 400, size=(8, 1000)).astype("<u2") for k in range(4)]
    texts = [topics[k][i] for i in range(8) for k in range(4)]
    idf = np.ones(packing.VOCABULARY)
    by = defaultdict(set)
    for text, _, _, sequence, _ in packing.pack_shard(texts, idf, 1000):
        by[sequence].add(text % 4)
    assert [len(by[s]) for s in range(4)] == [1, 1, 2, 2] or sum(len(x) for x in by.values()) <= 14
    index = packing.ShardIndex(texts, idf, 1000)
    found = list(index.neighbours(0, np.ones(len(texts), dtype=bool)))
    assert {t % 4 for t in found} == {0} and sorted(found) == list(range(0, 32, 4))


def make_items(rng, n):
    return [(i, f"{' '.join(f'q{rng.randrange(600)}' for _ in range(rng.randrange(6, 30)))}. {' '.join(f'a{rng.randrange(600)}' for _ in range(rng.randrange(1, 9)))}.") for i in range(n)] + [(9000, ""), (9001, None), (9002, "tiny item"), (9003, "...")]


def slow_matches(text, items, longest):
    words, found = decontaminate.terms(text), set()
    for i, item in items:
        own = decontaminate.terms(item)
        if not own:
            continue
        question, answer = decontaminate.question_and_answer(item)
        for at in range(0, max(1, len(words)), longest):
            part = words[at : at + 2 * longest]
            n = min(5, len(own))
            held = {tuple(part[k : k + n]) for k in range(len(part) - n + 1)}
            mine = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)}
            if len(mine & held) >= 0.8 * len(mine) and len(question & set(part)) >= 0.8 * len(question) and len(answer & set(part)) >= 0.8 * len(answer):
                found.add(i)
    return found


def test_decontamination_finds_every_overlapping_pair(spark, docs, rows, empty):
    rng = random.Random(8)
    items = make_items(rng, 150)
    longest = max(len(decontaminate.terms(t)) for _, t in items)
    noise = lambda n: " ".join(f"{rng.choice('qa')}{rng.randrange(600)}" for _ in range(n))
    given = [(r[0], r[1]) for r in rows]
    for i in range(120):
        item = items[rng.randrange(150)][1]
        words = item.split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            words[rng.randrange(len(words))] = noise(1)
        given.append((500 + i, f"{noise(rng.randrange(200))} {' '.join(words).upper() if i % 2 else ' '.join(words)} {noise(rng.randrange(200))}"))
    given += [(700, noise(3000)), (701, "x tiny, ITEM y"), (702, items[3][1] + " " + noise(400) + " " + items[4][1])]
    table = spark.createDataFrame(given, "doc_id bigint, text string")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(table, tests).collect()
    want = {(i, item) for i, t in given for item in slow_matches(t, items, longest)}
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(want) > 50 and len(found) == len(want)
    assert all(r["score"] >= 1 for r in found)
    assert {(702, 3), (702, 4), (701, 9002)} <= want
    kept = decontaminate.drop_contaminated(table, tests)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in given} - {i for i, _ in want}
    assert decontaminate.drop_contaminated(docs, tests).columns == docs.columns
    assert decontaminate.contaminated(empty, tests).count() == 0
    assert decontaminate.contaminated(docs, tests.where("item_id < 0")).count() == 0
    assert decontaminate.drop_contaminated(docs, tests.where("item_id < 0")).count() == len(rows)


def test_many_items_are_scanned_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 16)
    monkeypatch.setattr(decontaminate, "SHARDS_PER_SCAN", 2)
    items = make_items(random.Random(3), 100)
    table = spark.createDataFrame([(i, "intro words " + t) for i, t in items[:100]], "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert {(i, i) for i in range(100)} <= found


def test_every_latin_letter_encodes_as_the_library_does(tokenizer):
    encode = packing.WordEncoder(PATH)
    for code in [*range(0x41, 0x5B), *range(0xAA, 0x260), 0x3A3, 0x1E9E, 0x212A]:
        for text in (chr(code), f"ab{chr(code)}cd,", f"{chr(code)}{chr(code)}!", f"e{chr(0x301)} {chr(code)}"):
            assert list(np.frombuffer(encode(text), dtype="<u2")) == tokenizer.encode(text, add_special_tokens=False).ids, hex(code)


def test_a_word_is_held_once_whatever_mark_ends_it(tokenizer):
    encode = packing.WordEncoder(PATH)
    text = "Élan, élan. Élan 3, 3. a.b, x., İ. İ, end."
    assert list(np.frombuffer(encode(text + " " + text), dtype="<u2")) == tokenizer.encode(text + " " + text, add_special_tokens=False).ids
    assert "Élan" in encode.memo and not {"Élan,", "élan."} & set(encode.memo)


def test_terms_are_counted_once_a_text():
    counts, last = np.zeros(packing.VOCABULARY, dtype=np.int64), np.zeros(packing.VOCABULARY, dtype=np.int64)
    for ids in ([5, 7, 5, 2], [7, 2], [2]):
        packing._count_terms(counts, last, np.array(ids, dtype="<u2"))
    assert {t: int(counts[t]) for t in np.flatnonzero(counts)} == {5: 1, 7: 2, 2: 3}


def test_packing_frees_the_memo_of_the_encoder():
    common.worker_value("a stage before", object)
    assert not list(packing._pack(np.zeros(packing.VOCABULARY), 1.0)(iter([])))
    assert not common._WORKER


def test_sketches_and_counts_work_on_narrow_numbers():
    """Token pairs are hashed in 32 bits; a text's order of equal pairs does not matter, its least pair does."""
    rng = np.random.default_rng(1)
    ids = rng.integers(0, packing.VOCABULARY, 500).astype("<u2")
    assert 0 <= packing._sketch(ids) < 1 << 32
    assert packing._sketch(ids) == min(packing._sketch(ids[i : i + 2]) for i in range(len(ids) - 1))
    assert len({packing._sketch(rng.integers(0, packing.VOCABULARY, 2).astype("<u2")) for _ in range(2000)}) > 1990
    counts, last = np.zeros(packing.VOCABULARY, dtype="<i8"), np.zeros(packing.VOCABULARY, dtype=np.int32)
    packing._count_terms(counts, last, ids)
    assert np.array_equal(np.flatnonzero(counts), np.unique(ids)) and counts.max() == 1


def test_words_are_not_encoded_again_on_half_a_million():
    made = []
    memo = common.WordMemo(lambda word: made.append(word) or b"", packing.MEMO_WORDS)
    for _ in range(2):
        for i in range(500_000):
            assert memo[str(i)] == b""
    assert len(made) == 500_000 and len(memo) + len(memo.before) <= packing.MEMO_WORDS
