"""What both substring operators start from: distinct texts, and those that may hold a repeat.

A run of ``window`` words has a least gram (the minimiser: ``gram`` words whose hash is least), and
two equal runs have it at the same place. So a run can repeat only if its least gram stands at two
chosen positions of the corpus. Counting the chosen grams, a few per cent of all positions,
leaves the texts that may hold a repeat, each with its repeated grams. Nothing is lost.

Equal texts are found first and enter once, so a large group of copies adds no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import small_batches, split_words, text_or_empty
from tidepanel.llm.exact_dedup import MOST_BITS, flag_possible_copies, repeated_cells
from tidepanel.llm.wordhash import WordHashes, minimisers
from tidepanel.session import cut_lineage

GRAM_WORDS = 8


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def distinct_texts(docs: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(texts, copies): one row a distinct text (``text_sha256, text``), and the digests that more than one row has.

    Texts that a two-pass Bloom filter shows to be single stay where they are; the others are shuffled.
    """
    plain = docs.select(text_or_empty(text_col).alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    digests = cut_lineage(plain.select("text_sha256"))
    bits = min(MOST_BITS, 1 << max(15, (16 * digests.count()).bit_length()))
    field = cut_lineage(repeated_cells(digests, bits))
    flagged = flag_possible_copies(plain, field, bits)
    texts = flagged.where(~F.col("maybe_copy")).unionByName(flagged.where("maybe_copy").dropDuplicates(["text_sha256"])).select("text_sha256", "text")
    copies = flag_possible_copies(digests, field, bits).where("maybe_copy").groupBy("text_sha256").count().where("count > 1").select("text_sha256")
    return texts, cut_lineage(copies)


def _chosen_grams(window: int):
    """(slot, gram, key, n) of a batch. A gram met once in the batch goes to the slot of its hash.

    One met more often is decided here: it sends one row without a key there, so that others learn of
    it, and one row to a slot of its own for each text; no slot gets more than a row a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            hashes = WordHashes([split_words(t) for t in batch.column("text").to_pylist()])
            _, _, chosen = minimisers(hashes, window, GRAM_WORDS)
            chosen = chosen[hashes.fits(GRAM_WORDS)[chosen]]
            gram = hashes.runs(chosen, GRAM_WORDS) | np.uint64(1)
            key = np.array(batch.column("key").to_pylist(), dtype=np.int64)[np.searchsorted(hashes.begin, chosen, "right") - 1]
            found, back, count = np.unique(gram, return_inverse=True, return_counts=True)
            once = count[back] == 1
            pairs = np.unique(np.stack([gram[~once].view(np.int64), key[~once]]), axis=1)
            many = found[count > 1]
            slots = np.concatenate([gram[once], many, WordHashes.mix_pairs(pairs[0], pairs[1])])
            grams = np.concatenate([gram[once], many, pairs[0].view(np.uint64)])
            keys = pa.concat_arrays([pa.array(key[once]), pa.nulls(len(many), pa.int64()), pa.array(pairs[1])])
            n = np.concatenate([np.ones(int(once.sum()), np.int32), np.full(len(many) + pairs.shape[1], 2, np.int32)])
            yield pa.RecordBatch.from_arrays([signed(slots), signed(grams), keys, pa.array(n)], ["slot", "gram", "key", "n"])

    return run


def texts_with_repeated_grams(texts: DataFrame, window: int) -> DataFrame:
    """Stored rows (uid, text_sha256, text, grams) of the texts that may hold a repeat of ``window`` words."""
    keyed = texts.withColumn("key", F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long"))
    chosen = keyed.select("key", "text").mapInArrow(_chosen_grams(window), "slot bigint, gram bigint, key bigint, n int")
    total = F.sum("n").over(Window.partitionBy("slot"))
    repeated = chosen.withColumn("total", total).where("total > 1 AND key IS NOT NULL").groupBy("key").agg(F.collect_set("gram").alias("grams"))
    return cut_lineage(keyed.join(repeated, "key").select(F.monotonically_increasing_id().alias("uid"), "text_sha256", "text", "grams"))


def repeated_grams(batch: pa.RecordBatch) -> np.ndarray:
    return np.unique(np.asarray(pc.list_flatten(batch.column("grams")))).view(np.uint64)
