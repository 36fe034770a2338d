"""Lexical retrieval packing of token sequences.

Texts are tokenised once; whole windows of a long text become sequences of their own, and what is
left (less than a window) goes to a shard. A shard holds an inverted index of its remainders with
BM25 weights, whose document frequencies come from all texts. The next unused remainder seeds a
window; the index returns unused neighbours in order of score, and they fill the window greedily,
the last one cut to fit, its rest seeding the next window. When no neighbour shares a term, the
next unused remainder fills on. A shard's last tokens are cut into power-of-two sequences. So no
sequence needs padding.

Shards are ranges of (sketch, id), the sketch being the least hash of the text's token pairs, so
copies and near copies share a shard; they are sized by tokens and rows, and a large group of copies
spreads over several. A seed is compared with its shard only.

Defined cases: null text counts as empty (its one token is the end token); null ids stay; repeated
rows are separate documents; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import WordMemo, drop_worker_value, small_batches, worker_value
from tidepanel.session import cut_lineage

WINDOW = 4096
END_ID = 2
VOCABULARY = 1 << 16
#: A shard's intended size: what one task holds in memory.
SHARD_TOKENS, SHARD_ROWS = 4_000_000, 4000
#: A seed's query: its terms of largest BM25 weight.
QUERY_TERMS = 48
#: Characters of a long text that are encoded at a time.
STRETCH = 1 << 20
K1, B = 1.2, 0.75
#: Constants of the hash of token pairs, odd 32-bit multipliers.
SHIFT, HALF, ONE, MIX = np.uint32(16), np.uint32(15), np.uint32(1), (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B))
#: Words whose ids a worker keeps (about 300 bytes each); they outlive a task, but not the stage that encodes.
MEMO_WORDS = 1_200_000
#: ASCII marks that form one pre-token in a run; not the apostrophe, nor the signs of special tokens.
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: A lone comma or full stop behind a Latin letter or digit, at a word's end: a pre-token of its own. (Not behind
#: the dotted capital I, whose lower case ends in a mark.) One pattern a mark, so that both are found and set by plain text.
BEFORE_MARK = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
LONE_COMMA = re.compile(f",(?=[ \\n])(?<=[{BEFORE_MARK}],)")
LONE_STOP = re.compile(f"\\.(?=[ \\n])(?<=[{BEFORE_MARK}]\\.)")
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
STORED = f"kind int, {PIECES}, sketch bigint, uid bigint, ids binary"


class WordEncoder:
    """Token ids of texts (as 16-bit bytes) for a vocabulary whose tokens never cross white space.

    Words are looked up in a memo; an unknown one is encoded by the library. A comma or full stop at a word's
    end is cut off first, so that the memo holds the word once. A word of Latin letters
    with a run of marks behind it is encoded as its letters and the run, which are separate
    pre-tokens, by the library's model; everything else goes to the whole tokenizer as it stands.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.memo = WordMemo(self._encode, MEMO_WORDS)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        assert self.tokenizer.get_vocab_size(with_added_tokens=True) <= VOCABULARY, "ids must fit 16 bits"
        with open(path, encoding="utf-8") as f:
            bpe = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in bpe["merges"]]
        self.split = BPE(vocab=bpe["vocab"], merges=merges, end_of_word_suffix=bpe["end_of_word_suffix"], cache_capacity=0).tokenize
        # fixed values of byte-level vocabularies: a byte that is no printable Latin-1 sign is spelled by a letter from 256 on
        odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
        spelled = {b: 256 + i for i, b in enumerate(odd)}
        self.byte_letters = "".join(chr(spelled.get(b, b)) for b in range(256))

    def _letters(self, word: str) -> bytes:
        word = word.lower() if word.isascii() else codecs.charmap_decode(unicodedata.normalize("NFC", word).lower().encode(), "strict", self.byte_letters)[0]
        return array("H", [t.id for t in self.split(word)]).tobytes()

    def _encode(self, word: str) -> bytes:
        if not word:
            return b""
        if _plain(word):
            return self._letters(word)
        stem = word.rstrip(MARKS)
        if len(stem) < len(word) and _plain(stem):
            return self.memo[stem] + self.memo[word[len(stem) :]]
        return array("H", self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids).tobytes()

    def __call__(self, text: str) -> bytes:
        stretches = _stretches(text) if len(text) > STRETCH else (text,)
        return b"".join(b"".join(map(self.memo.__getitem__, LONE_STOP.sub(" .", LONE_COMMA.sub(" ,", part)).replace("\n", " ").split(" "))) for part in stretches)


def _stretches(text: str) -> list[str]:
    """A text cut at spaces into stretches of about STRETCH characters; words are not cut."""
    out, start = [], 0
    while len(text) - start > STRETCH and (cut := text.find(" ", start + STRETCH)) >= 0:
        out.append(text[start:cut])
        start = cut + 1
    return [*out, text[start:]]


def _plain(word: str) -> bool:
    """Latin letters only, which stay letters when normalised and lower-cased."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and word.lower().isalpha()))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _count_terms(counts: np.ndarray, last: np.ndarray, ids: np.ndarray) -> None:
    """Add one to the count of every token that a text holds; ``last`` is scratch space of the vocabulary's size."""
    ids, places = ids.astype(np.intp), np.arange(len(ids), dtype=last.dtype)
    last[ids] = places
    counts[ids[last[ids] == places]] += 1  # a token's last place only


def _sketch(ids: np.ndarray) -> int:
    wide = ids.astype(np.uint32)
    pairs = wide[:-1] << SHIFT | wide[1:] if len(ids) > 1 else wide
    mixed = (pairs + ONE) * MIX[0]
    mixed ^= mixed >> HALF
    return int((mixed * MIX[1]).min())


def _encode(path: str):
    """Rows of kind 0 (a full window of one text), 1 (the rest of a text) and 2 (this task's term counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, counts, texts, sequences = None, np.zeros(VOCABULARY, dtype="<i8"), 0, 0
        last = np.zeros(VOCABULARY, dtype=np.int32)
        first = (1 << 62) + (TaskContext.get().partitionId() << 32)
        for batch in small_batches(batches, "text", 2 << 20, 500):
            encode, rows = encode or worker_value(path, lambda: WordEncoder(path)), []
            for doc, text, uid in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "uid")), strict=True):
                ids = np.frombuffer(encode(text or "") + END_ID.to_bytes(2, "little"), dtype="<u2")
                _count_terms(counts, last, ids)
                texts += 1
                full = len(ids) // WINDOW * WINDOW
                for at in range(0, full, WINDOW):
                    rows.append((0, doc, at, WINDOW, crc(ids[at : at + WINDOW]), len(ids), first + sequences, 0, None, uid, None))
                    sequences += 1
                if full < len(ids):
                    rows.append((1, doc, full, len(ids) - full, None, len(ids), None, None, _sketch(ids[full:]), uid, ids[full:].tobytes()))
            yield _batch(rows, STORED)
        if texts:
            yield _batch([(2, None, None, texts, None, None, None, None, None, None, counts.tobytes())], STORED)

    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split() for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(VOCABULARY, dtype=np.int64)
    for batch in batches:
        for counts in batch.column("ids").to_pylist():
            total += np.frombuffer(counts, dtype="<i8")
    live = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(live, pa.int64()), pa.array(total[live], pa.int64())], ["term", "n"])


class ShardIndex:
    """BM25 postings of a shard's texts, term by term."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float):
        each = [np.unique(t, return_counts=True) for t in texts]
        sizes = np.array([len(u) for u, _ in each])
        term, tf = np.concatenate([u for u, _ in each]).astype(np.int64), np.concatenate([c for _, c in each])
        length = np.repeat([len(t) for t in texts], sizes)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        self.query = []
        for own, w in zip(np.split(term, np.cumsum(sizes)[:-1]), np.split(weight, np.cumsum(sizes)[:-1]), strict=True):
            self.query.append(own if len(own) <= QUERY_TERMS else own[np.argpartition(-w, QUERY_TERMS)[:QUERY_TERMS]])
        order = np.argsort(term, kind="stable")
        self.text, self.weight = np.repeat(np.arange(len(texts)), sizes)[order], weight[order]
        self.begin = np.searchsorted(term[order], np.arange(VOCABULARY + 1))

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused texts that share a query term with the seed, best first, ties by place."""
        terms = self.query[seed]
        places = [slice(self.begin[t], self.begin[t + 1]) for t in terms]
        score = np.bincount(np.concatenate([self.text[p] for p in places]), weights=np.concatenate([self.weight[p] for p in places]), minlength=len(unused)) * unused
        if len(score) > 64:
            best = np.argpartition(-score, 32)[:32]
            best = best[np.lexsort((best, -score[best]))]
            yield from (int(i) for i in best if score[i] > 0)
            score[best] = 0
        yield from (int(i) for i in np.lexsort((np.arange(len(score)), -score))[: np.count_nonzero(score > 0)])


def pack_shard(texts: list[np.ndarray], idf: np.ndarray, mean: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, start, length, sequence, offset) of every piece; each text is shorter than a window."""
    index, unused = ShardIndex(texts, idf, mean), np.ones(len(texts), dtype=bool)
    left, next_seed, rest = sum(map(len, texts)), 0, None
    sequence = 0
    while left:
        if left >= WINDOW:
            sizes = [WINDOW]
        else:  # the last tokens: power-of-two sequences
            sizes = [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
        room, offset, found = sizes.pop(0), 0, None
        while True:
            if rest is not None:
                text, start = rest
            else:
                text = next((i for i in found if unused[i]), None) if found is not None else None
                if text is None:
                    while not unused[next_seed]:
                        next_seed += 1
                    text = next_seed
                start, unused[text] = 0, False
            if found is None:
                found = index.neighbours(text, unused.copy())
            take = min(room, len(texts[text]) - start)
            yield text, start, take, sequence, offset
            left, room, offset = left - take, room - take, offset + take
            rest = (text, start + take) if start + take < len(texts[text]) else None
            if room == 0:
                sequence += 1
                if not sizes:
                    break
                room, offset = sizes.pop(0), 0


def _pack(idf: np.ndarray, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_value()
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("sketch", "ascending"), ("doc_id", "ascending"), ("uid", "ascending")])
        doc, base, total = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        texts = [np.frombuffer(b, dtype="<u2") for b in table.column("ids").to_pylist()]
        first, rows = TaskContext.get().partitionId() << 32, []
        for text, start, length, sequence, offset in pack_shard(texts, idf, mean):
            rows.append((doc[text], base[text] + start, length, crc(texts[text][start : start + length]), total[text], first + sequence, offset))
        yield _batch(rows, PIECES)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("uid"))
    stored = cut_lineage(own.mapInArrow(_encode(tokenizer_path), STORED))
    counts = {r["kind"]: r for r in stored.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("length").alias("tokens")).collect()}
    whole = stored.where("kind = 0").select(*(f.strip().split()[0] for f in PIECES.split(",")))
    if 1 not in counts:
        return whole
    n_texts, tokens, rows = counts[2]["tokens"], counts[1]["tokens"], counts[1]["rows"]
    held = np.zeros(VOCABULARY)
    for r in stored.where("kind = 2").select("ids").mapInArrow(_term_counts, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        held[r["term"]] = r["n"]  # at most one row a token of the vocabulary
    idf = np.log(1 + (n_texts - held + 0.5) / (held + 0.5))
    shards = max(1, -(-tokens // SHARD_TOKENS), -(-rows // SHARD_ROWS))
    rest = stored.where("kind = 1").select("doc_id", "start", "doc_tokens", "sketch", "uid", "ids").repartitionByRange(shards, "sketch", "doc_id", "uid")
    return whole.union(rest.mapInArrow(_pack(idf, tokens / rows), PIECES))
