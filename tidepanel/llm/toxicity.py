"""Toxicity: subword-bag embeddings, averaged, into a linear softmax; trained jointly in numpy.

A word is the bag of its hashed character n-grams, so a misspelling never seen in training shares
most vectors with the word it hides. A text is cut into windows of a few words; a window's vector
is the average of its words' vectors, the softmax layer turns it into two class scores, and a
text counts as toxic as its most toxic window does. Embeddings and softmax weights are fitted
together by gradient descent with momentum; the gradient reaches a text's windows by their softmax share.

With two classes only the difference of the class weights matters, so a model is scored through
one number an n-gram, ``embedding . (w_toxic - w_clean)``.

The labelled sample is bounded (``TRAIN_PER_CLASS``, ``TRAIN_BYTES``) and trained on in one task of an executor;
every text is scored whole.

Defined cases: null and empty texts get the score of an empty window; null ids are scored and
count as held out of training; null labels and labels without a document are ignored, of several
labels for one id the larger counts; without a labelled row every score is 0.5 and nothing is
rejected; repeated rows score alike; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import random
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import WordMemo, drop_worker_value, small_batches, worker_value

#: Bound of the training sample: labelled rows of each class, and bytes of one sampled text.
TRAIN_PER_CLASS = 1200
TRAIN_BYTES = 50_000
BUCKETS = 1 << 18
DIMENSIONS = 8
WINDOW = 8
#: Models from different starts and misspellings, which are averaged.
RESTARTS = 3
STEPS = 100
#: Largest step of a weight, at the start.
STEP = 2.0
#: Share of the loss that the toxic texts make up, whatever their number in the sample.
TOXIC_WEIGHT = 0.5
#: An n-gram is learned if it stands in so many sampled texts, and its share of texts differs between the
#: classes by so many standard deviations of chance; the embeddings of all others stay zero.
LEAST_TEXTS, LEAST_DEVIATIONS = 5, 4.0
GRAMS = (3, 4, 5)
#: Word scores that a worker keeps (about 200 bytes each).
MEMO_WORDS = 500_000
#: Signs before and behind a word; the second is matched on the reversed word, so both take linear time.
BEFORE, BEHIND = re.compile(r"[^\w$@*]*"), re.compile(r"[^\w$@*!]*")


def word_grams(word: str) -> list[int]:
    """Bucket numbers of a word's character n-grams and of the word itself; none for bare punctuation."""
    word = word[BEFORE.match(word).end() :]
    word = word[: len(word) - BEHIND.match(word[::-1]).end()]
    if not word:
        return []
    if len(word) > 64:  # a long run without a space is read as words of 64 characters
        return [g for i in range(0, len(word), 64) for g in word_grams(word[i : i + 64])]
    whole, crc = f"<{word}>", zlib.crc32
    flat = whole.encode("utf-8", "surrogatepass")
    if word.isascii():
        return [crc(flat[i : i + n]) % BUCKETS for n in GRAMS for i in range(len(flat) - n + 1)] + [crc(b"=" + flat) % BUCKETS]
    return [crc(whole[i : i + n].encode("utf-8", "surrogatepass")) % BUCKETS for n in GRAMS for i in range(len(whole) - n + 1)] + [crc(b"=" + flat) % BUCKETS]


@dataclass
class Model:
    """Embeddings (buckets x dimensions) and softmax weights (dimensions + 1 x classes)."""

    embeddings: np.ndarray
    softmax: np.ndarray

    def gram_scores(self) -> tuple[np.ndarray, float]:
        toward = self.softmax[:, 1] - self.softmax[:, 0]
        return (self.embeddings @ toward[:-1]).astype(np.float32), float(toward[-1])


def _misspell(word: str, rng: random.Random) -> str:
    i = rng.randrange(len(word))
    kind = rng.randrange(3)
    return word[:i] + ("", word[i] * 2, rng.choice("aeiou013$*"))[kind] + word[i + 1 :] if len(word) > 3 else word


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts over all texts' words, and each text's first window. A text without words has one empty window."""
    counts = np.maximum(1, -(-sizes // WINDOW))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    own = np.repeat(np.arange(len(sizes)), counts)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return begin[own] + (np.arange(len(own)) - first[own]) * WINDOW, first


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[ends] - total[starts]


def train(texts: list[str], toxic: list[int], steps: int = STEPS, restarts: int = RESTARTS) -> Model:
    """Fit RESTARTS models and set them side by side: the class scores are their mean."""
    models = [_train_once(texts, toxic, steps, seed) for seed in range(7, 7 + restarts)]
    bias = np.mean([m.softmax[-1] for m in models], axis=0, keepdims=True)
    return Model(np.hstack([m.embeddings for m in models]) / restarts, np.vstack([*(m.softmax[:-1] for m in models), bias]))


def _train_once(texts: list[str], toxic: list[int], steps: int, seed: int) -> Model:
    """Fit embeddings and softmax together; a fifth of the words is misspelled at random."""
    rng, draw = random.Random(seed), np.random.default_rng(seed)
    ids: dict[str, int] = {}
    words, sizes = [], []
    for text in texts:
        own = [w if rng.random() > 0.2 else _misspell(w, rng) for w in text.lower().split()]
        words += [ids.setdefault(w, len(ids)) for w in own]
        sizes.append(len(own))
    grams = [word_grams(w) for w in ids]
    per_word = np.array([len(g) for g in grams], dtype=np.int64)
    gram = np.fromiter((g for own in grams for g in own), dtype=np.int64, count=int(per_word.sum()))
    of_word = np.repeat(np.arange(len(ids)), per_word)
    word, sizes, y = np.array(words, dtype=np.int64), np.array(sizes, dtype=np.int64), np.array(toxic, dtype=np.float64)
    begin = np.concatenate([[0], np.cumsum(per_word)[:-1]])
    held = np.zeros((2, BUCKETS))
    for label, own in zip(toxic, np.split(word, np.cumsum(sizes)[:-1]), strict=True):
        own = np.unique(own)
        span = np.repeat(begin[own] - np.concatenate([[0], np.cumsum(per_word[own])[:-1]]), per_word[own]) + np.arange(per_word[own].sum())
        held[label, np.unique(gram[span])] += 1
    n = np.maximum(1, np.array([(y == 0).sum(), (y == 1).sum()]))
    share = held.sum(axis=0) / n.sum()
    beyond_chance = np.abs(held[1] / n[1] - held[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]) + 1e-12)
    live = (beyond_chance[gram] >= LEAST_DEVIATIONS) & (held.sum(axis=0)[gram] >= LEAST_TEXTS)
    gram, of_word = gram[live], of_word[live]
    seen, gram = np.unique(gram, return_inverse=True)
    calm = 1 / np.sqrt(held.sum(axis=0)[seen])  # an n-gram of many texts has more chance agreement with the labels
    starts, first = _windows(sizes)
    ends = np.concatenate([starts[1:], [len(word)]])
    own_text = np.repeat(np.arange(len(sizes)), np.diff(np.concatenate([first, [len(starts)]])))
    length = np.maximum(1, ends - starts)
    of_window = np.repeat(np.arange(len(starts)), ends - starts)
    per_word = np.maximum(1, per_word)
    weight = np.where(y == 1, TOXIC_WEIGHT / max(1, y.sum()), (1 - TOXIC_WEIGHT) / max(1, (1 - y).sum()))
    embeddings, softmax = draw.normal(0, 0.001, (len(seen), DIMENSIONS)), np.zeros((DIMENSIONS + 1, 2))
    softmax[:-1] = draw.normal(0, 0.5, (DIMENSIONS, 2))
    speed = [np.zeros_like(embeddings), np.zeros_like(softmax)]
    for step in range(steps):
        toward = softmax[:, 1] - softmax[:, 0]
        of_words = np.bincount(of_word, weights=(embeddings @ toward[:-1])[gram], minlength=len(ids)) / per_word
        z = _sums(of_words[word], starts, ends) / length + toward[-1]
        top = np.maximum.reduceat(z, first)
        error = (1 / (1 + np.exp(-np.clip(top, -30, 30))) - y) * weight
        share = np.exp(z - top[own_text])
        share /= np.add.reduceat(share, first)[own_text]
        to_window = error[own_text] * share
        to_word = np.bincount(word, weights=(to_window / length)[of_window], minlength=len(ids)) / per_word
        to_gram = np.bincount(gram, weights=to_word[of_word], minlength=len(seen)) * calm
        grow = np.zeros_like(softmax)
        grow[:-1, 1] = embeddings.T @ to_gram
        grow[-1, 1] = to_window.sum()
        grow[:, 0] = -grow[:, 1]
        rate = 1 - step / steps
        for i, (values, gradient, most) in enumerate(((embeddings, np.outer(to_gram, toward[:-1]), STEP), (softmax, grow, STEP / 10))):
            # one scale for all n-grams: what is seen often moves most, and a rare one hardly
            speed[i] = 0.8 * speed[i] + gradient
            values -= rate * most * speed[i] / (np.abs(speed[i]).max(initial=0) + 1e-12)
    whole = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    whole[seen] = embeddings
    return Model(whole, softmax)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


@dataclass
class Fitted:
    """What scoring needs of a model: one number an n-gram, and the bias."""

    scores: np.ndarray
    bias: float

    def gram_scores(self) -> tuple[np.ndarray, float]:
        return self.scores, self.bias


def _fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Train on the rows of the one task that holds the sample; one row out, none if a class is missing."""
    drop_worker_value()
    rows = sorted(zip(*(c.to_pylist() for c in pa.Table.from_batches(batches).columns), strict=True)) if (batches := list(batches)) else []
    if {0, 1} <= {label for _, _, label in rows}:
        scores, bias = train([text for _, text, _ in rows], [label for _, _, label in rows]).gram_scores()
        yield pa.RecordBatch.from_arrays([pa.array([scores.astype("<f4").tobytes()], pa.binary()), pa.array([bias], pa.float64())], ["scores", "bias"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Fitted | None:
    """Train on a bounded sample of the labelled rows that are not held out, in one task of an executor.

    The sample is chosen by a hash of the id, so it is the same whatever the partitioning; of several texts
    of a sampled id the least counts. The driver gets the fitted numbers only.
    """
    known = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    order = F.xxhash64("_id", F.lit(11))
    chosen = known.where("_label = 0").orderBy(order).limit(TRAIN_PER_CLASS).union(known.where("_label = 1").orderBy(order).limit(TRAIN_PER_CLASS))
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where(F.octet_length("_text") <= TRAIN_BYTES)
    sample = own.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_label").alias("_label"))  # one row an id
    row = sample.repartition(1).mapInArrow(_fit_sample, "scores binary, bias double").first()
    return None if row is None else Fitted(np.frombuffer(row["scores"], dtype="<f4"), row["bias"])


def _scorer(scores: np.ndarray, bias: float):
    score_of = scores.tolist()

    def of_word(w: str) -> float:
        grams = word_grams(w)
        return sum([score_of[g] for g in grams]) / len(grams) if grams else 0.0

    of = WordMemo(of_word, MEMO_WORDS).__getitem__

    def score(text: str | None) -> float:
        words = text.lower().split() if text else []
        if not words:
            return 1 / (1 + np.exp(-bias))
        values = np.array(list(map(of, words)))
        starts = np.arange(0, len(values), WINDOW)
        z = np.add.reduceat(values, starts) / np.minimum(WINDOW, len(values) - starts) + bias
        return float(1 / (1 + np.exp(-np.clip(z.max(), -30, 30))))

    return score


def with_score(docs: DataFrame, model: Model | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """Append the score of every row's whole text; the other columns pass through."""
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    scores, bias = model.gram_scores()
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = worker_value(key, lambda: _scorer(scores, bias))
        for batch in small_batches(batches, text_col):
            found = [score(t) for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, name])

    kept = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return kept.mapInArrow(run, kept.withColumn(name, F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    model = fit(docs, labels, id_col, text_col)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = with_score(own, model).drop("text")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted") if model else F.lit(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    model = fit(docs, labels, id_col, text_col)
    if model is None:
        return docs
    name = next(f"_score{i}" for i in range(len(docs.columns) + 1) if f"_score{i}" not in docs.columns)
    return with_score(docs, model, text_col, name).where(F.col(name) < 0.5).drop(name)
