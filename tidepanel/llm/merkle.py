"""Merkle manifest of a dataset: one tree a group, the groups' roots under one more tree, a proof a row.

A level of a tree is a table of nodes (grp, idx, digest), built by a sibling-shift self-join: every node
sends its digest to the slots of its run, at computed indices (slot XOR 1 for a binary tree, the other
slots of the run by their offsets otherwise), and an equijoin with the nodes on (grp, idx) keeps what
meets a node. Rows of slot zero then hold a whole run and emit the parent. Levels shrink by ``fan``, are
stored one by one, and the driver only learns whether another one is needed. No task sees a group:
keys are single nodes, and a node's place in its group comes from range partitions and their offsets.

Proofs are put together from the top: each level joins the path of its parents, so that a row's path lists
(before, after), the siblings on its left and right, from leaf to root. A changed row is folded along it.

Defined cases: a null field is ``-``, so it differs from an empty one; rows with a null id come first in
their group and count as not tampered; rows of one group and id go by their leaf, and equal rows have equal
leaves; null groups are one group, before all others; long texts are hashed in the JVM, whole; an empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import lower_ascii
from tidepanel.operators.ordered import running_total
from tidepanel.session import cut_lineage

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEPS = "array<struct<before:binary,after:binary>>"


def digest_of(data: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(data, 256))


def hex_of(data: Column) -> Column:
    """Lowercase hex text of one or more digests in a row, as bytes to be hashed."""
    return F.lower(F.hex(data))


def leaf_of(values: list[Column]) -> Column:
    """Digest of the fields, each as its length in bytes, a colon and its text; ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return digest_of(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"))


def _joined(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["digest"]))


def sibling_level(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """``nodes`` (grp, idx, digest, ...) with the digests of the run's others: ``before`` and ``after``, in order of slots."""
    more = [c for c in nodes.columns if c not in ("grp", "idx", "digest")]
    slot, run = F.pmod("idx", F.lit(fan)), F.col("idx") - F.pmod("idx", F.lit(fan))
    to = [slot.bitwiseXOR(F.lit(1).cast("long"))] if fan == 2 else [F.pmod(slot + k, F.lit(fan)) for k in range(1, fan)]
    sent = nodes.select("grp", F.explode(F.array(*[run + t for t in to])).alias("idx"), F.struct(slot.alias("slot"), "digest").alias("sibling"))
    met = nodes.join(sent, ["grp", "idx"], "left").groupBy("grp", "idx").agg(*[F.first(c).alias(c) for c in ("digest", *more)], F.sort_array(F.collect_list("sibling")).alias("siblings"))
    return met.select(
        "grp", "idx", "digest", *more,
        _joined(F.filter("siblings", lambda s: s["slot"] < slot)).alias("before"), _joined(F.filter("siblings", lambda s: s["slot"] > slot)).alias("after"),
        # alone at the first place: the whole group has come down to this node
        ((F.col("idx") == 0) & (F.size("siblings") == 0)).alias("last"),
    )


def parents(level: DataFrame, fan: int = FAN) -> DataFrame:
    """The nodes above: each run's row of slot zero holds all of it."""
    heads = level.where((F.pmod("idx", F.lit(fan)) == 0) & ~F.col("last"))
    return heads.select("grp", (F.col("idx") / fan).cast("long").alias("idx"), digest_of(hex_of(F.concat("digest", "after")).cast("binary")).alias("digest"))


def build_levels(nodes: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """All levels from the leaves up, each stored; the last row of every group is marked ``last``."""
    levels = [cut_lineage(sibling_level(nodes, fan))]
    while not levels[-1].where("NOT last").isEmpty():
        levels.append(cut_lineage(sibling_level(parents(levels[-1], fan), fan)))
    return levels


def paths(levels: list[DataFrame], tops: DataFrame, fan: int = FAN) -> DataFrame:
    """(grp, idx, digest, ..., top, path) of the lowest level; ``tops`` (grp, top, path) is what lies above a group.

    A level's rows travel with their own siblings only, to meet the paths of their parents, one in ``fan`` of them.
    """
    above = None
    for level in reversed(levels):
        own = [c for c in level.columns if c not in ("before", "after", "last")]
        found = level.where("last").join(tops, "grp").select(*own, F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), "path")
        if above is not None:
            upper = above.select("grp", F.col("idx").alias("up"), "top", F.col("path").alias("rest"))
            step = F.array(F.struct("before", "after"))
            open_rows = level.where("NOT last").withColumn("up", (F.col("idx") / fan).cast("long"))
            found = found.unionByName(open_rows.join(upper, ["grp", "up"]).select(*own, "top", F.concat(step, "rest").alias("path")))
        above = found
    return above


def placed_rows(docs: DataFrame, id_col: str, group_col: str, fields: list[str], tampered: Column) -> DataFrame:
    """(doc_id, grp, idx, leaf, changed): a row's place in its group and its leaf before and after tampering, if any."""
    changed = [lower_ascii(F.col(c)) if c == fields[-1] else F.col(c) for c in fields]
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),  # null sorts first
        leaf_of([F.col(c) for c in fields]).alias("leaf"),
        F.when(tampered, leaf_of(changed)).alias("changed"),
    )
    return running_total(cut_lineage(own), ["grp"], ["doc_id", "leaf"], out="idx")


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, tampered: Column | None = None, fan: int = FAN) -> DataFrame:
    """One row per document: its digests, its path and what a verifier that sees the changed row computes.

    ``doc_id, grp, idx, leaf, subroot, root`` (32 bytes each), ``path`` (its siblings' digests left and right, level
    by level), ``folded`` (the root recomputed from the changed, else original leaf) and ``verified``. ``tampered``
    marks the rows whose last field's A-Z are lower-cased before verification.
    """
    tampered = F.lit(False) if tampered is None else tampered
    levels = build_levels(placed_rows(docs, id_col, group_col, list(fields), tampered).withColumnRenamed("leaf", "digest"), fan)
    ends = cut_lineage(reduce(DataFrame.union, [x.where("last").select("grp", "digest") for x in levels]))
    order = cut_lineage(running_total(ends, [], ["grp"], out="idx").select("grp", "idx"))
    upper = build_levels(ends.join(order, "grp").select(F.lit("").alias("grp"), "idx", "digest"), fan)
    nothing = F.from_json(F.lit("[]"), _STEPS)
    whole = upper[-1].where("last").select("grp", F.lit(None).cast("binary").alias("top"), nothing.alias("path"))
    of_group = paths(upper, whole, fan).join(order.withColumnRenamed("grp", "name"), "idx")
    tops = cut_lineage(of_group.select(F.col("name").alias("grp"), F.col("top.subroot").alias("top"), "path"))
    found = paths(levels, tops, fan).withColumnRenamed("digest", "leaf")
    folded = F.aggregate("path", F.coalesce("changed", "leaf"), lambda acc, s: digest_of(hex_of(F.concat(s["before"], acc, s["after"])).cast("binary")))
    out = found.select("doc_id", "grp", "idx", "leaf", F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"), "path", folded.alias("folded"))
    return out.withColumn("verified", F.col("folded") == F.col("root"))


def manifest_digests(manifest: DataFrame) -> DataFrame:
    """Hex columns of a manifest, and the hash of each row's proof: its siblings from leaf to root, left to right."""
    proof = F.aggregate("path", F.lit(b""), lambda acc, s: F.concat(acc, s["before"], s["after"]))
    hexed = [hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return manifest.select("doc_id", *hexed, F.sha2(hex_of(proof).cast("binary"), 256).alias("proof_sha256"), hex_of(F.col("folded")).alias("folded_root"), "verified")


def every_fifth_by_crc(id_col: str = "doc_id") -> Column:
    """Rows whose decimal id has a CRC-32 that five divides."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))
