"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer, digest, n_tokens). A text's key is the SHA-256 of its
content together with the SHA-256 of the tokenizer file, so a new vocabulary never meets old
counts. Normalisation only turns a missing text into an empty one: any other change could change
the count. Known digests are joined, every distinct missing text is encoded once, and the new
counts are appended.

Defined cases: null text counts as empty (0 tokens); null ids stay; repeated rows each get their
count; an empty table gives an empty result; further columns are ignored; a long text is encoded
in pieces cut where the vocabulary's pre-tokens end, which gives the same count.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import small_batches, text_or_empty
from tidepanel.session import cut_lineage

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens bigint"
#: Texts are handed to the library in pieces of about this many characters.
PIECE_CHARS = 1 << 16
#: Between two ASCII letters, before a single space: a pre-token always ends here.
SAFE_CUT = re.compile(r"(?<=[a-zA-Z]) (?=[a-zA-Z])")


def pieces(text: str, most: int = PIECE_CHARS) -> list[str]:
    """Cut a text before spaces that part two ASCII letters, at the first such place after ``most`` characters."""
    out, start = [], 0
    while len(text) - start > most:
        cut = SAFE_CUT.search(text, start + most)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _counter(path: str):
    """A function from texts to token counts; for .json and .model files."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()

        def count(texts: list[str]) -> list[int]:
            cut = [pieces(t) for t in texts]
            sizes = iter([len(e) for e in tokenizer.encode_batch_fast([p for ps in cut for p in ps], add_special_tokens=False)])
            return [sum(next(sizes) for _ in ps) for ps in cut]

        return count
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def _encode(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in small_batches(batches, "text", 1 << 18, 64):
            count = count or _counter(path)
            n = count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([version] * len(n)), batch.column("digest"), pa.array(n, pa.int64())], ["tokenizer", "digest", "n_tokens"])

    return run


def _exists(docs: DataFrame, path: str) -> bool:
    jvm = docs.sparkSession._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(docs.sparkSession._jsc.hadoopConfiguration()).exists(at)


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``. Appends what it had to encode to the cache.

    The cache is appended to when this function is called; one writer at a time.
    """
    spark, version, text = docs.sparkSession, file_digest(tokenizer_path), text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("digest"))
    narrow = cut_lineage(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    missing = keyed.select("digest", "text")
    if _exists(docs, cache_path):
        known = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version).select("digest")
        missing = missing.join(known, "digest", "left_anti")
    distinct = missing.groupBy("digest").agg(F.first("text").alias("text"))
    distinct.mapInArrow(_encode(tokenizer_path, version), CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version)
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # two writers may both have added a digest
    return narrow.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
