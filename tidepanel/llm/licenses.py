"""License notices: phrase places, and an exact set-similarity join of text blocks with notice templates.

A block is any run of words twice as long as the longest template, across line breaks: wrapped
notices are met, words scattered over a long text are not. It is similar to a template when it holds
at least ``THRESHOLD`` of the template's distinct words. Words are ordered by how many documents hold them, counted over all documents. A template's
prefix is its rarest words, so many that a text without any of them cannot reach the threshold;
an index from prefix words to templates gives the candidates. The length filter drops texts with
too few template words, the positional filter those whose words after the first common one
are too few; in the rest every block is compared exactly. The filters lose nothing.

Defined cases: null text counts as empty (no words, score 0); null ids stay; repeated rows each
get their result; an empty table gives an empty result; further columns are ignored; a text
shorter than a block is one block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import LOWER_BYTES, small_batches

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Sentences of public license notices.
TEMPLATES = {
    "agpl-3.0": ["licensed under the gnu affero general public license version 3"],
    "apache-2.0": ["licensed under the apache license version 2 0", "you may not use this file except in compliance with the license"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "cc-by-4.0": ["this work is licensed under a creative commons attribution 4 0 international license", "licensed under cc by 4 0"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0"],
    "gpl-3.0": ["licensed under the gnu general public license version 3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "mit-notice": ["released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}
THRESHOLD = 0.8
#: A block has as many words as this many of the longest template.
WINDOW_TEMPLATES = 2
#: Everything but digits, lower-case letters and bytes of other alphabets parts words.
SPACES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
SCHEMA = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def words_of(lowered: bytes) -> list[bytes]:
    return lowered.translate(SPACES).split()


def _lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES)


def _count_words(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            held = Counter(w for t in batch.column("text").to_pylist() for w in vocabulary.intersection(words_of(_lowered(t))))
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    return run


class TemplateIndex:
    """Prefix index of the templates under a global order of words, rarest first."""

    def __init__(self, templates: dict[str, list[str]], frequency: dict[str, int], threshold: float):
        vocabulary = sorted({w for ts in templates.values() for t in ts for w in t.split()}, key=lambda w: (frequency.get(w, 0), w))
        self.order = {w.encode(): i for i, w in enumerate(vocabulary)}
        self.sets, self.prefix = [], {}
        for label, ts in templates.items():
            for t in ts:
                ordered = sorted(self.order[w.encode()] for w in set(t.split()))
                need = ceil(threshold * len(ordered) - 1e-9)
                for i, w in enumerate(ordered[: len(ordered) - need + 1]):
                    self.prefix.setdefault(w, []).append((len(self.sets), i))
                self.sets.append((label, frozenset(ordered), need))
        self.window = WINDOW_TEMPLATES * max(len(t.split()) for ts in templates.values() for t in ts)
        self.starters = frozenset(w for w, i in self.order.items() if i in self.prefix)

    def similar(self, words: list[bytes]) -> list[tuple[str, float]]:
        """Labels and best containments of all templates that some window of the words meets."""
        places = [(at, i) for at, w in enumerate(words) if (i := self.order.get(w)) is not None]
        block = sorted({i for _, i in places})
        tried, found = set(), []
        for j, w in enumerate(block):
            for template, i in self.prefix.get(w, ()):
                label, own, need = self.sets[template]
                # length: too few words; position: the first common word leaves too few behind it
                if template in tried or len(block) < need:
                    continue
                tried.add(template)
                if 1 + min(len(own) - i - 1, len(block) - j - 1) < need or len(own.intersection(block)) < need:
                    continue
                common = most_distinct([p for p in places if p[1] in own], self.window)
                if common >= need:
                    found.append((label, common / len(own)))
        return found


def most_distinct(places: list[tuple[int, int]], window: int) -> int:
    """The most distinct words that stand within ``window`` consecutive words; ``places`` are (position, word) in order."""
    held, first, most = Counter(), 0, 0
    for at, word in places:
        held[word] += 1
        while places[first][0] <= at - window:
            gone = places[first][1]
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            first += 1
        most = max(most, len(held))
    return most


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(start in words, label) of every place where a phrase's words stand consecutively."""
    joined, places = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        sought, at = f" {phrase} ".encode(), -1
        seen = start = 0
        while (at := joined.find(sought, at + 1)) >= 0:
            seen += joined.count(b" ", start, at)
            start = at
            places.append((seen, label))
    return places


def _scan(index: TemplateIndex, phrases: dict[str, str]):
    def one(text: str | None) -> tuple:
        lowered = _lowered(text)
        words = words_of(lowered)
        places = phrase_places(words, phrases)
        starts = [s for s, _ in places]
        base = {label for _, label in places}
        near = [] if index.starters.isdisjoint(words) else index.similar(words)
        score = max([1.0 if base else 0.0, *(c for _, c in near)])
        join = lambda labels: ",".join(sorted(labels))
        return len(words), len(places), min(starts, default=None), max(starts, default=None), join(base), join(base | {label for label, _ in near}), score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = [one(t) for t in batch.column("text").to_pylist()]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def license_scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: word count, phrase places, their labels, all labels, and the best containment (1 with a phrase)."""
    templates = templates or TEMPLATES
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    vocabulary = frozenset(w.encode() for ts in templates.values() for t in ts for w in t.split())
    counted = own.select("text").mapInArrow(_count_words(vocabulary), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {r["word"]: r["n"] for r in counted.collect()}  # at most one row a template word
    return own.mapInArrow(_scan(TemplateIndex(templates, frequency, threshold), PHRASES), SCHEMA)
