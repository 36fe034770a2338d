"""Shards of near-equal bytes by sampled splitters, on DataFrame functions only.

Rows are ordered by (text hash, id), so equal texts stand together. A size-weighted sample of the
keys gives quantile boundaries; ranges that turn out overfull, in bytes or in rows, are cut again (a
range that holds a single text, by id). Each range is summed in its own task, the few range totals give every
row its place on the line of all bytes, and a shard is an equal stretch of that line. A row goes
where its middle lies.
A group of equal texts of at most 2 % of a shard moves as one; a larger one is cut where the
shard ends. So shards differ by at most 2 % of a shard or one document.

Defined cases: a null text has size 16 and counts as empty; a null id sorts first; rows that
repeat an id are ordered by their place in the input; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import text_or_empty
from tidepanel.session import cut_lineage

#: Sampled keys for each range; the boundaries' error is about a sixteenth of a range.
SAMPLES_PER_RANGE = 256
ROW_OVERHEAD = 16
#: A group of equal texts up to this share of a shard is never cut.
WHOLE_GROUP_SHARE = 50


def _cell_of(bounds: list[tuple[int, int]]) -> Column:
    """How many (key, id) boundaries a row has passed, by binary search."""
    if not bounds:
        return F.lit(0)
    keys, ids = F.lit([k for k, _ in bounds]).cast("array<bigint>"), F.lit([d for _, d in bounds]).cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    def passed(at: Column) -> Column:
        key, doc = F.get(keys, at - 1), F.get(ids, at - 1)
        return (key < F.col("key")) | ((key == F.col("key")) & (doc <= F.coalesce("doc_id", F.lit(-(1 << 63)))))
    return F.reduce(F.lit(steps), F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & passed(at + step), at + step).otherwise(at))


def _boundaries(rows: DataFrame, total: int, count: int, ranges: int) -> list[tuple[int, int]]:
    """Sampled splitters, with overfull ranges cut again. Sizes are bounded by ``ranges``."""
    lowest, chance = -(1 << 63), F.col("size") * (SAMPLES_PER_RANGE * ranges / total)
    drawn = rows.where(F.pmod(F.xxhash64("key", "doc_id", "uid"), F.lit(1 << 24)) < chance * (1 << 24))
    shares = [i / ranges for i in range(1, ranges)]
    quantiles = drawn.agg(F.percentile_approx("key", shares, 20 * ranges).alias("q")).first()["q"] or []
    bounds = sorted({(q, lowest) for q in quantiles} | {(q + 1, lowest) for q in quantiles if quantiles.count(q) > 1})
    # how many times an even range's bytes or rows, whichever is more
    load = F.greatest(F.sum("size") * ranges / total, F.count("*") * ranges / count)
    while True:  # a cut sets a frequent text apart, the next cuts it by id, until no range is overfull or can be cut
        over = {r["cell"]: r["load"] for r in rows.groupBy(_cell_of(bounds).alias("cell")).agg(load.alias("load")).where("load > 2").collect()}  # at most one row a range
        if not over:
            break
        cut = rows.withColumn("cell", _cell_of(bounds)).where(F.col("cell").isin(list(over))).groupBy("cell").agg(
            F.min("key").alias("low"), F.max("key").alias("high"), F.percentile_approx("key", shares, 20 * ranges).alias("keys"), F.percentile_approx("doc_id", shares, 20 * ranges).alias("ids")
        )
        found = set(bounds)
        for r in cut.collect():
            pieces = min(ranges, ceil(over[r["cell"]]))
            picks = [(i * ranges) // pieces - 1 for i in range(1, pieces)]
            if r["low"] == r["high"]:
                found |= {(r["low"], r["ids"][i]) for i in picks if r["ids"]}
            else:
                keys = [r["keys"][i] for i in picks]
                found |= {(k, lowest) for k in keys} | {(k + 1, lowest) for k in keys}
        if found == set(bounds):
            break
        bounds = sorted(found)
    return sorted(set(bounds))


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` counts a shard's rows from 0 without gaps; the law is ``bytes``.
    """
    text = text_or_empty(text_col)
    rows = cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long").alias("key"), F.monotonically_increasing_id().alias("uid"),
    ))
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    total, count = total or 1, count or 1
    ranges = max(4 * shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = _boundaries(rows, total, count, ranges)
    placed = rows.withColumn("cell", _cell_of(bounds))
    totals = {r["cell"]: (r["bytes"], r["rows"]) for r in placed.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}  # one row a range
    bytes_before, rows_before = [0], [0]
    for cell in range(len(bounds)):
        bytes_before.append(bytes_before[-1] + totals.get(cell, (0, 0))[0])
        rows_before.append(rows_before[-1] + totals.get(cell, (0, 0))[1])
    order = Window.partitionBy("cell").orderBy("key", "doc_id", "uid")
    group = Window.partitionBy("cell", "key")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    middle = F.when(F.col("group_bytes") * (shards * WHOLE_GROUP_SHARE) <= total, F.col("group_start") + F.col("group_bytes") / 2).otherwise(F.col("before") + F.col("size") / 2)
    offset = F.get(F.lit(bytes_before).cast("array<bigint>"), F.col("cell"))
    stored = cut_lineage(
        placed.withColumn("before", before).withColumn("n", F.row_number().over(order))
        .withColumn("group_start", F.min("before").over(group)).withColumn("group_bytes", F.sum("size").over(group))
        .select("doc_id", "size", "text_crc32", F.least(F.lit(shards - 1), F.floor((offset + middle) * shards / F.lit(total))).cast("int").alias("shard"),
                (F.get(F.lit(rows_before).cast("array<bigint>"), F.col("cell")) + F.col("n") - 1).alias("place"))
    )
    starts = stored.groupBy("shard").agg(F.min("place").alias("start"))  # one row a shard
    return stored.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
