"""Near copies by the similarity of their five-word shingles: an exact set-similarity join.

Texts are near copies when the Jaccard similarity of their sets of five-word shingles is 0.8 or more.
Shingles have one global order: those frequent in a sample come last, the others go by hash. Two sets
of that similarity share one of their first ``n - ceil(0.8 n) + 1`` shingles, so texts meet on these.
The sample changes only how many meet, never the result. Equal sets collapse first, and shingles of the
same holders count as one, at each holder's first place. Pairs are dropped
by length, by position and by profiles of the sets (counts of their hashes' first bytes), and the rest compared
set by set; the sets are stored by node, so that only pairs travel. The first round compares what operator 4's
ball hashing links: fingerprints of at most two differing bits (``simhash``). The next rounds compare each text that
meets on a shingle with that shingle's centre, first the text in which the shingle stands foremost (of altered
copies the least altered one, which most others resemble), then one drawn anew for each shingle; texts that are
joined already need no comparison, and a last round compares all the others, so components are those of all pairs.

Defined cases: A-Z are lower-cased; texts of one to four words have one shingle, themselves; texts
without words are equal; sets are equal up to 64-bit hashes, and what two of them share is counted on
32 bits (different shingles of a pair agree once in some 10,000 pairs); null ids take part, and their
rows stay; an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm import simhash
from tidepanel.llm.common import LOWER_BYTES, drop_worker_value, small_batches, text_or_empty
from tidepanel.llm.components import components
from tidepanel.session import cut_lineage, store_bucketed

SHINGLE_WORDS = 5
SEED = 42
#: Rounds with one centre a shingle, before all others are compared.
STARS = 2
#: Texts of the sample, and shingles kept from it; both bound what reaches the driver and the tasks.
SAMPLE, MOST_FREQUENT = 32_768, 262_144


def shingles(text: str | None) -> np.ndarray:
    """Distinct hashes of the text's word shingles, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    if len(words) < SHINGLE_WORDS:
        words = [b" ".join(words)] if words else []
        return np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], dtype="<u8")
    digest, join = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False)
    return np.unique(np.fromiter((digest(join(s), SEED) for s in runs), dtype="<u8"))


def node_of(hashes: np.ndarray) -> int:
    """One signed number a set; the empty set has zero."""
    return int(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), SEED) if len(hashes) else 0], dtype="<u8").view("<i8")[0])


def prefix_of(hashes: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set's first shingles in the global order; two sets of similarity 0.8 share one of them."""
    n = len(hashes)
    rank = np.zeros(n, dtype=np.int64)
    if len(frequent) and n:
        low = hashes.astype("<u4")
        at = np.minimum(np.searchsorted(frequent, low), len(frequent) - 1)
        rank = np.where(frequent[at] == low, counts[at], 0)
    return hashes[np.lexsort((hashes, rank))][: n - (4 * n + 4) // 5 + 1 if n else 0]


def _lists(parts: list[np.ndarray], bits: int = 32) -> pa.Array:
    """Lists of the hashes' lower bits; 32 are half the bytes to move, but meet by chance in a large corpus."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, "<u8"), *parts]).astype(f"<u{bits // 8}").view(f"<i{bits // 8}")))


def _places(frequent: np.ndarray, counts: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_worker_value()
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            sets, prints = [shingles(t) for t in texts], np.array([simhash.fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array([node_of(s) for s in sets], pa.int64()), pa.array(prints), pa.array([len(s) for s in sets], pa.int64()), _lists([prefix_of(s, frequent, counts) for s in sets], 64)],
                ["doc_id", "key", "node", "fp", "n", "prefix"],
            )

    return run


def profile_of(hashes: np.ndarray) -> bytes:
    """How many of the set's hashes begin with each of 256 bytes; empty if a number does not fit a byte."""
    counts = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=256)
    return counts.astype("u1").tobytes() if counts.max(initial=0) < 256 else b""


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_worker_value()
    for batch in small_batches(batches, "text"):
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), _lists(sets), pa.array([profile_of(s) for s in sets], pa.binary())], ["node", "n", "hashes", "profile"])


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose profiles leave room for a similarity of 0.8: what two sets share is at most the sum of the lesser counts."""
    for batch in batches:
        keep = []
        for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True):
            x, y = np.frombuffer(one, "u1").astype(np.int64), np.frombuffer(two, "u1").astype(np.int64)
            keep.append(not len(x) or not len(y) or bool(9 * np.minimum(x, y).sum() >= 4 * (x.sum() + y.sum())))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def frequent_shingles(own: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (their lower 32 bits) that several sampled texts hold, ascending, and in how many."""
    every = max(1, own.count() // SAMPLE)
    sampled = own.where(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(every)) == 0).select("text")
    held = sampled.mapInArrow(_sets, "node bigint, n bigint, hashes array<int>, profile binary").select(F.explode("hashes").alias("shingle"))
    most = held.groupBy("shingle").count().where("count > 1").orderBy(F.desc("count"), "shingle").limit(MOST_FREQUENT).toArrow()
    found = most.column("shingle").to_numpy().astype("<i4").view("<u4")
    order = np.argsort(found)
    return found[order], most.column("count").to_numpy().astype(np.int32)[order]


def _could_be_near(a: str, b: str) -> Column:
    """Whether what lies behind a common shingle, if it is the first one, leaves enough (also holds for lengths)."""
    behind = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    return 9 * behind >= 4 * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have similarity 0.8 or more."""
    distinct = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sketched = distinct.join(sets.select(F.col("node").alias("a"), F.col("profile").alias("one")), "a").join(sets.select(F.col("node").alias("b"), F.col("profile").alias("two")), "b")
    both = cut_lineage(sketched.mapInArrow(_possible, "a bigint, b bigint")).join(sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("of_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("of_b")), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return cut_lineage(both.where(9 * common >= 4 * (F.col("n_a") + F.col("n_b"))).select("a", "b"))


def ball_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (``node, fp``) that ball hashing links; the nodes of one fingerprint pair with its least node."""
    heads = cut_lineage(nodes.groupBy("fp").agg(F.min("node").alias("head")))
    equal = nodes.join(heads, "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    head = lambda fp, name: heads.select(F.col("fp").alias(fp), F.col("head").alias(name))
    close = simhash.links(heads.select("fp")).toDF("fp_a", "fp_b").join(head("fp_a", "a"), "fp_a").join(head("fp_b", "b"), "fp_b")
    return equal.union(close.select("a", "b"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, component_id`` of every document: ``key`` hashes the text, the component's id is its smallest known doc_id."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    rows = cut_lineage(own.mapInArrow(_places(*frequent_shingles(own)), "doc_id bigint, key bigint, node bigint, fp bigint, n bigint, prefix array<bigint>"))
    nodes = cut_lineage(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("key").alias("key"), F.min("fp").alias("fp")))
    by_shingle = Window.partitionBy("shingle")
    several = F.min("root").over(by_shingle) != F.max("root").over(by_shingle)
    once = rows.groupBy("node").agg(F.any_value(F.struct("n", "prefix")).alias("p"))
    placed = once.select("node", F.col("p.n").alias("n"), F.posexplode("p.prefix").alias("at", "shingle"))
    holders = F.bit_xor(F.xxhash64("node")).over(by_shingle)
    shared = placed.withColumn("root", F.col("node")).select("node", "n", "at", several.alias("several"), holders.alias("shingle")).where("several")
    met = cut_lineage(shared.groupBy("shingle", "node").agg(F.any_value("n").alias("n"), F.min("at").alias("at")).withColumn("root", F.col("node")))
    wanted = cut_lineage(nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", "fp", "key"))
    sets = store_bucketed(own.join(wanted.select("key"), "key", "left_semi").select("text").mapInArrow(_sets, "node bigint, n bigint, hashes array<int>, profile binary").dropDuplicates(["node"]), ["node"], spread=False)
    links, roots = [], None
    for star in range(-1, STARS + 1):
        if met.isEmpty():
            break
        if star < 0:
            pairs = ball_pairs(wanted.select("node", "fp"))
        else:
            if star < STARS:
                foremost = F.col("at") if star == 0 else F.lit(0)
                centre = F.min(F.struct(foremost.alias("place"), F.xxhash64("node", "shingle", F.lit(star)).alias("h"), "node", "n", "at", "root")).over(by_shingle)
                pairs = met.select(F.struct("node", "n", "at", "root").alias("x"), centre.alias("y"))
            else:
                side = lambda name: met.select("shingle", F.struct("node", "n", "at", "root").alias(name))
                pairs = side("x").join(side("y"), "shingle").where("x.node < y.node")
            pairs = pairs.where("x.root <> y.root").where(_could_be_near("x", "y")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        links.append(_links(pairs, sets))
        roots = cut_lineage(components(reduce(DataFrame.union, links)))
        met = cut_lineage(met.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).withColumn("several", several).where("several").drop("several"))
    rooted = nodes.withColumn("root", F.col("node"))
    if roots is not None:
        rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labels = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = rooted.join(labels, "root").select("node", "component_id")
    return rows.select("doc_id", "key", "node").join(of_node, "node").select("doc_id", "key", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component (and those without an id), with their columns."""
    gone = near_components(docs, id_col, text_col).where("doc_id <> component_id").select("doc_id", F.col("key").alias("_key")).distinct()
    same = (F.col(f"own.`{id_col}`") == F.col("gone.doc_id")) & (F.xxhash64(text_or_empty(f"own.`{text_col}`")) == F.col("gone._key"))
    return docs.alias("own").join(gone.alias("gone"), same, "left_anti")
