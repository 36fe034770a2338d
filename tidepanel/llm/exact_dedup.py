"""Exact duplicates with a two-pass Bloom filter, on DataFrame functions only.

Pass one hashes each normalised text to two cells of a bit field and keeps the cells that were
hit more than once. Pass two tests every row against them: a row with an unmarked cell has no
copy and goes straight to the result; only the others are shuffled, grouped by SHA-256 and
decided. A false alarm costs one shuffled narrow row and changes nothing.

Defined cases: a null text counts as empty; a null id takes part and is the smallest; rows that
repeat an id and a text are copies of each other (exactly one stays); an empty table gives an
empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import lower_ascii, text_or_empty
from tidepanel.session import cut_lineage

#: The bit field never exceeds this (8 MB); beyond it more rows are shuffled, with the same result.
MOST_BITS = 1 << 26
#: A group with at least this share of all rows is joined by broadcast: at most HOT_SHARE such groups exist.
HOT_SHARE = 1000


def text_digest(text_col: str) -> Column:
    return F.sha2(lower_ascii(text_or_empty(text_col)), 256)


def _cells(bits: int) -> tuple[Column, Column]:
    """Two cells of a row, from 1 to ``bits``."""
    sha = F.col("text_sha256")
    return tuple(F.xxhash64(sha, F.lit(seed)).bitwiseAND(F.lit(bits - 1)) + 1 for seed in (1, 2))


def repeated_cells(digests: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap) of the cells hit more than once; at most ``bits`` / 8 bytes in all."""
    hits = digests.select(F.explode(F.array(*_cells(bits))).alias("cell")).groupBy("cell").count().where("count > 1")
    return hits.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap"))


def flag_possible_copies(rows: DataFrame, field: DataFrame, bits: int) -> DataFrame:
    """Add ``maybe_copy``: whether both cells of the row are marked. Needs ``text_sha256``; no shuffle."""
    out = rows
    for i, cell in enumerate(_cells(bits)):
        marked = field.select(F.col("bucket").alias(f"_bucket{i}"), F.col("bitmap").alias(f"_bitmap{i}"))
        out = out.withColumn(f"_at{i}", F.bitmap_bit_position(cell)).join(F.broadcast(marked), F.bitmap_bucket_number(cell) == F.col(f"_bucket{i}"), "left")
    def marked_bit(i: int) -> Column:
        byte = F.conv(F.hex(F.substring(F.col(f"_bitmap{i}"), (F.col(f"_at{i}") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.getbit(byte, (F.col(f"_at{i}") % 8).cast("int")) == 1, F.lit(False))
    return out.withColumn("maybe_copy", marked_bit(0) & marked_bit(1)).drop(*(f"_{x}{i}" for x in ("at", "bucket", "bitmap") for i in (0, 1)))


def _decide(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """Decided rows (doc_id, keep_id, group_size, kept, text_sha256), the bit field and its size."""
    narrow = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256"), F.monotonically_increasing_id().alias("uid")))
    total = narrow.count()
    bits = min(MOST_BITS, 1 << max(15, (16 * total).bit_length()))
    field = cut_lineage(repeated_cells(narrow, bits))
    flagged = flag_possible_copies(narrow, field, bits)
    alone = flagged.where(~F.col("maybe_copy")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    maybe = flagged.where("maybe_copy").drop("maybe_copy")
    groups = cut_lineage(
        maybe.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "uid")).alias("keep"), F.count("*").alias("group_size")).where("group_size > 1")
    )
    hot = groups.where(F.col("group_size") * HOT_SHARE >= total).select("text_sha256", F.col("keep").alias("hot_keep"), F.col("group_size").alias("hot_size"))
    rest = groups.where(F.col("group_size") * HOT_SHARE < total)
    met = maybe.join(F.broadcast(hot), "text_sha256", "left")
    kept = F.coalesce(F.col("uid") == F.col("keep.uid"), F.lit(True))
    columns = ["doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
               F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), "text_sha256"]
    in_hot = met.where("hot_size is not null").select("doc_id", "uid", "text_sha256", F.col("hot_keep").alias("keep"), F.col("hot_size").alias("group_size"))
    in_rest = met.where("hot_size is null").drop("hot_keep", "hot_size").join(rest, "text_sha256", "left")
    return alone.unionByName(in_hot.select(*columns)).unionByName(in_rest.select(*columns)), field, bits


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the largest id stays.
    """
    return _decide(docs, id_col, text_col)[0]


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns. Rows without a marked cell are not shuffled."""
    decided, field, bits = _decide(docs, id_col, text_col)
    marks = decided.where("group_size > 1").groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.max("kept").alias("_kept"))
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_digest(text_col).alias("text_sha256"))
    flagged = flag_possible_copies(own, field, bits)
    maybe = flagged.where("maybe_copy").select("row", "text_sha256")
    met = maybe.join(marks, F.col(f"row.`{id_col}`").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha")), "left")
    single = met.where("_kept is null").select("row")
    stays = met.where("_kept").withColumn("_id", F.col(f"row.`{id_col}`")).dropDuplicates(["_id", "text_sha256"]).select("row")
    return flagged.where(~F.col("maybe_copy")).select("row").union(single).union(stays).select("row.*")
