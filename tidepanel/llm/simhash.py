"""SimHash near-duplicates by ball hashing that meets in the middle.

Two fingerprints differ in at most two bits exactly when some 64-bit number differs from each of
them in at most one. So every distinct fingerprint emits itself and its 64 one-bit variants, the
variants are shuffled, and fingerprints that meet on one are linked. A variant is met by at most 65
distinct fingerprints, whatever the data, so no group can grow; neighbours in its sorted order
are linked, which joins the same components as all pairs. Equal fingerprints collapse first.

Defined cases: null and empty texts have fingerprint zero; null ids take part and give a null
component only where no id is known; repeated rows share a fingerprint; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import LOWER_BYTES, small_batches
from tidepanel.llm.components import components
from tidepanel.session import cut_lineage

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total, ones = len(words) - SHINGLE_WORDS + 1, np.zeros(64, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, CHUNK):
        part = words[at : at + CHUNK + SHINGLE_WORDS - 1]
        hashes = np.fromiter((digest(join(s), SEED) for s in zip(*(part[i:] for i in range(SHINGLE_WORDS)), strict=False)), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): links that join all fingerprints of ``nodes`` (distinct ``fp``) within two bits."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    met = nodes.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("variant"))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = met.select(F.col("fp").alias("a"), before.alias("b")).where(F.col("b").isNotNull())
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``, the smallest id it reaches over links of at most two bits."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = cut_lineage(own.mapInArrow(_fingerprints, "doc_id bigint, fp bigint"))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    labels = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(labels, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component (and those without an id), with their columns."""
    gone = simhash_components(docs, id_col, text_col).where("doc_id <> component_id").select("doc_id")
    return docs.alias("own").join(gone.alias("gone"), F.col(f"own.`{id_col}`") == F.col("gone.doc_id"), "left_anti")
