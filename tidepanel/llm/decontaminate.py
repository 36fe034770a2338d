"""Benchmark decontamination: BM25 over test items with block-max pruning, then overlap checks.

The index holds the test items; every passage of every training text is a query. An item's impacts
(its BM25 term weights) are scaled so that 1 is the least score a passage can have that holds
``OVERLAP`` of the item's word shingles: what the costliest fifth of its words may take away is
subtracted from its own score. Items stand in blocks; for each term a block keeps its largest
impact. The sum of these bounds every item's score in the block, so a passage opens only blocks
whose bound reaches 1 and scores their items exactly; all items at 1 or more are retrieved, none
is lost. A retrieved pair counts as contamination when the passage holds ``OVERLAP`` of the item's
five-word shingles, of its question's words and of its answer's words (the last sentence).

Passages are windows of twice the longest item, each starting half a window after the one before,
so any place as long as an item lies whole in one. Terms are lower-cased runs of letters and digits.

Defined cases: null and empty texts match nothing; items without words are skipped, items below
five words are one shingle; null ids stay; repeated rows each get their rows; empty tables give an
empty result; further columns are ignored, and ``drop_contaminated`` passes them through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import small_batches

K1, B = 1.2, 0.75
SHINGLE_WORDS = 5
OVERLAP = 0.8
BLOCK_ITEMS = 8
#: Items in one index shard, and shards that one scan of the texts carries (an index of a few MB each).
SHARD_ITEMS = 1024
SHARDS_PER_SCAN = 16
SPACES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def terms(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(SPACES).split()


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + SHINGLE_WORDS]) for i in range(max(1, len(words) - SHINGLE_WORDS + 1))} if words else set()


def question_and_answer(text: str) -> tuple[set[bytes], set[bytes]]:
    """Words of all sentences but the last, and of the last; a single sentence is the question alone."""
    parts = [p for p in SENTENCE.split(text) if terms(p)]
    return ({w for p in parts[:-1] for w in terms(p)}, set(terms(parts[-1]))) if len(parts) > 1 else (set(terms(text)), set())


class IndexShard:
    """Inverted index of some items: scaled impacts by block, and block maxima."""

    def __init__(self, items: list[tuple[int, str]], documents_with: Counter, n_items: int, mean_words: float):
        held = sorted(((i, t, terms(t)) for i, t in items), key=lambda x: (len(x[2]), str(x[0])))
        held = [x for x in held if x[2]]
        self.ids, self.texts = [x[0] for x in held], [x[1] for x in held]
        self.longest = max(len(x[2]) for x in held) if held else 0
        self.term: dict[bytes, int] = {}
        blocks = -(-len(held) // BLOCK_ITEMS)
        found: dict[tuple[int, int], float] = {}
        self.impacts: list[dict[int, np.ndarray]] = [{} for _ in range(blocks)]
        for place, (_, _, words) in enumerate(held):
            weight = {}
            for w, tf in Counter(words).items():
                idf = log(1 + (n_items - documents_with[w] + 0.5) / (documents_with[w] + 0.5))
                weight[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            lost = sorted(weight.values(), reverse=True)[: int((1 - OVERLAP) * len(words) + 1e-9)]
            least = max(1e-9, (sum(weight.values()) - sum(lost)) * (1 - 1e-6))
            block = place // BLOCK_ITEMS
            for w, x in weight.items():
                t = self.term.setdefault(w, len(self.term))
                found[t, block] = max(x / least, found.get((t, block), 0))
                self.impacts[block].setdefault(t, np.zeros(BLOCK_ITEMS))[place % BLOCK_ITEMS] = x / least
        self.most = np.zeros((len(self.term), blocks), dtype=np.float32)
        for (t, block), x in found.items():
            self.most[t, block] = x * (1 + 1e-6)
        self.parts = [(shingles(x[2]), *question_and_answer(x[1])) for x in held]

    def matches(self, words: list[bytes]) -> dict[int, tuple[float, float, float, float]]:
        """Best passage of each item that passes: {place: (score, overlap, question, answer)}."""
        get = self.term.get
        known = np.array([get(w, -1) for w in words], dtype=np.int32)
        at = np.flatnonzero(known >= 0)
        if not len(at):
            return {}
        half = self.longest
        segment = at // half
        begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        sums = np.zeros((int(segment[-1]) + 2, self.most.shape[1]), dtype=np.float32)
        sums[segment[begin]] = np.add.reduceat(self.most[known[at]], begin, axis=0)
        found: dict[int, tuple[float, float, float, float]] = {}
        for passage, block in zip(*np.nonzero(sums[:-1] + sums[1:] >= 1), strict=True):
            own, impacts = words[passage * half : (passage + 2) * half], self.impacts[block]
            score = sum((impacts[t] for t in {get(w, -1) for w in own} if t in impacts), np.zeros(BLOCK_ITEMS))
            for i in np.flatnonzero(score >= 1):
                place = int(block) * BLOCK_ITEMS + int(i)
                checked = self._overlap(place, own)
                if checked and (float(score[i]), *checked) > found.get(place, ()):
                    found[place] = (float(score[i]), *checked)
        return found

    def _overlap(self, place: int, words: list[bytes]) -> tuple[float, float, float] | None:
        own, question, answer = self.parts[place]
        held, bag = shingles(words), set(words)
        if len(next(iter(own))) < SHINGLE_WORDS:  # a short item is one shingle of its own length
            n = len(next(iter(own)))
            held = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        shares = [len(part & of) / len(part) if part else 1.0 for part, of in ((own, held), (question, bag), (answer, bag))]
        return tuple(shares) if min(shares) >= OVERLAP - 1e-9 else None


def build_index(items: list[tuple[int, str]]) -> list[IndexShard]:
    """Shards over items of like length, with document frequencies over all of them."""
    held = sorted(((i, t) for i, t in items if terms(t)), key=lambda x: (len(terms(x[1])), str(x[0])))
    frequency = Counter(w for _, t in held for w in set(terms(t)))
    mean = sum(len(terms(t)) for _, t in held) / max(1, len(held))
    return [IndexShard(held[i : i + SHARD_ITEMS], frequency, len(held), mean) for i in range(0, len(held), SHARD_ITEMS)]


def _indexes(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[IndexShard]]:
    """Indexes of at most SHARDS_PER_SCAN shards each; more items make more scans, never a larger broadcast."""
    own = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    scans = max(1, -(-own.count() // (SHARD_ITEMS * SHARDS_PER_SCAN)))
    for scan in range(scans):
        part = own.where(F.pmod(F.xxhash64("item", "text"), F.lit(scans)) == scan)
        yield build_index([(r["item"], r["text"]) for r in part.distinct().collect()])


def _search(shards: list[IndexShard]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = terms(text)
                rows += [(doc, shard.ids[place], *found) for shard in shards for place, found in shard.matches(words).items()]
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"])

    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and test item it contains: ``doc_id, item_id, score, overlap, question_overlap, answer_overlap``.

    ``score`` is BM25 in units of the least score a full match can have. Nothing is shuffled.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for shards in _indexes(items, item_col, item_text_col):
        found = own.mapInArrow(_search(shards), "doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, answer_overlap double")
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no test item, with their columns."""
    out = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    for shards in _indexes(items, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], shards: list[IndexShard] = shards) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, text_col):
                clean = [not any(shard.matches(words) for shard in shards) for words in map(terms, batch.column(text_col).to_pylist())]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out
