"""Links between vectors of one label at a cosine threshold, found by spherical-cap filters.

Filter directions come from random product codes: after a random rotation a vector is cut into two
blocks, each with ``WORDS`` random unit words, so a code has WORDS**2 directions and the best ones of a
vector are decoded from the best words of its blocks, without a look at the others. Every vector
is decoded to all directions that exceed its own level, the inner product with its ``FILTERS``-th best one
(a fixed level for all would leave out vectors with a weak block). Two vectors at cosine 0.93 share
one of their filters in all but about two in ten thousand cases (measured: see the tests and README); the
codes depend on the dimension and a seed only.

Vectors meet on (label, dimension, filter). A pair that shares several filters counts at the smallest one,
so link counts are sums over filters and no pair leaves a task. Filters with more than ``CELL`` members are
cut into blocks, and each pair of blocks is a cell of its own, spread over the tasks; cells are
processed together in slots of about ``SLOT`` rows. Each cell sends link counts and one edge per vector
to its least neighbour's group, which the components are made of.

Equal vectors of one label are one class; they enter the search once, and their links with each other are
counted by the size of the class.

Defined cases: a vector that is null, empty, zero or has a null or non-finite component, or whose label is
null, links with nothing; vectors of different length do not link; rows without an id take part, and their
component's id is the smallest known one, null if none; repeated rows are classes of several rows; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.components import components
from tidepanel.session import cut_lineage

LEAST_COSINE = 0.93
WORDS, CODES, FILTERS, SEED = 256, 4, 24, 12
#: Members of a block of a frequent filter, and rows that a task takes at a time.
CELL, SLOT = 1024, 16_384
#: Members up to which cells are taken together, pair by pair, and not one by one as matrices.
FEW = 32
#: Vectors decoded together.
DECODED = 1024
#: A class with this share of all rows is joined by broadcast; there are at most so many of them.
HOT_SHARE = 1000


@lru_cache(maxsize=4)
def codes(dim: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rotation, words of the first block, words of the second) of every code."""
    rng, wide = np.random.default_rng([SEED, dim]), max(16, dim + dim % 2)
    out = []
    for _ in range(CODES):
        rotation = np.linalg.qr(rng.standard_normal((wide, wide)))[0][:dim]
        words = rng.standard_normal((2, WORDS, wide // 2))
        out.append((rotation, *(words / np.linalg.norm(words, axis=2, keepdims=True))))
    return out


def decode(unit: np.ndarray) -> np.ndarray:
    """For each row, the ``FILTERS`` directions with the largest inner products, ascending by number."""
    best, value = [], []
    for k, (rotation, one, two) in enumerate(codes(unit.shape[1])):
        turned = unit @ rotation
        half = turned.shape[1] // 2
        a, b = turned[:, :half] @ one.T, turned[:, half:] @ two.T
        # a direction among the best FILTERS has both its words among their blocks' best FILTERS
        i, j = np.argpartition(-a, FILTERS, axis=1)[:, :FILTERS], np.argpartition(-b, FILTERS, axis=1)[:, :FILTERS]
        sums = (np.take_along_axis(a, i, 1)[:, :, None] + np.take_along_axis(b, j, 1)[:, None, :]).reshape(len(unit), -1)
        numbers = (k * WORDS * WORDS + i[:, :, None] * WORDS + j[:, None, :]).reshape(len(unit), -1)
        most = np.argpartition(-sums, FILTERS, axis=1)[:, :FILTERS]
        best.append(np.take_along_axis(numbers, most, 1))
        value.append(np.take_along_axis(sums, most, 1))
    best, value = np.concatenate(best, 1), np.concatenate(value, 1)
    most = np.argpartition(-value, FILTERS, axis=1)[:, :FILTERS]
    return np.sort(np.take_along_axis(best, most, 1), axis=1).astype(np.int32)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the filters of every vector as the last column."""
    for whole in batches:
        for start in range(0, whole.num_rows, DECODED):
            batch = whole.slice(start, DECODED)
            x, begin, sizes = _flat(batch.column("vector"))
            found = np.zeros((len(sizes), FILTERS), dtype=np.int32)
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                found[rows] = decode(_units(x, begin[rows], dim))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * FILTERS), pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "filters"])


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all components, begin of each vector, its length)."""
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.concatenate([[0], sizes]))[:-1], sizes


def _units(x: np.ndarray, begin: np.ndarray, dim: int) -> np.ndarray:
    """The vectors at ``begin``, in double precision and of length one."""
    v = x[begin[:, None] + np.arange(dim)].astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _first_shared(a: np.ndarray, b: np.ndarray, at: int) -> np.ndarray:
    """Whether no filter below ``at`` is common to a row of ``a`` and a row of ``b``; both are (rows, FILTERS)."""
    numbers = np.intersect1d(a[a < at], b[b < at])
    if not len(numbers):
        return np.ones((len(a), len(b)), dtype=bool)

    def held(x: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(numbers, x), len(numbers) - 1)
        hit = numbers[place] == x
        out = np.zeros((len(x), len(numbers)), dtype=np.float32)
        out[np.nonzero(hit)[0], place[hit]] = 1
        return out

    return held(a) @ held(b).T == 0


def _least_reached(linked: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """For each row, the smallest uid it reaches inside the cell by links."""
    least = uid.copy()
    while True:
        after = np.where(linked, least[None, :], least[:, None]).min(1)
        after = np.minimum(after, least)
        if (after == least).all():
            return least
        least = after


def _small_cells(cell: np.ndarray, at: np.ndarray, unit: np.ndarray, filters: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Newly linked pairs of rows in cells of few members; rows are sorted by cell, and each meets the next ones of its cell."""
    found = [np.zeros((2, 0), dtype=np.int64)]
    for step in range(1, FEW):
        i = np.flatnonzero(cell[:-step] == cell[step:])
        if not len(i):
            break
        for part in np.array_split(i, -(-len(i) // 65_536)):
            near = part[np.einsum("ij,ij->i", unit[part], unit[part + step]) >= least]
            shared = (filters[near][:, :, None] == filters[near + step][:, None, :]) & (filters[near] < at[near][:, None])[:, :, None]
            near = near[~shared.any((1, 2))]
            found.append(np.stack([near, near + step]))
    return tuple(np.concatenate(found, 1))


def cell_links(least: float):
    def run(group: pa.Table) -> pa.Table:
        """(uid, n, reached): rows newly linked to a vector in this slot's cells, and a smaller vector of its component."""
        cell, side, uid, at, copies = (group.column(c).to_numpy() for c in ("cell", "side", "uid", "filter", "copies"))
        values, begin, sizes = _flat(group.column("vector").combine_chunks())
        filters = group.column("filters").combine_chunks().flatten().to_numpy().reshape(-1, FILTERS)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            rows = rows[np.lexsort((uid[rows], side[rows], cell[rows]))]
            c, s, u, f, w, fs = cell[rows], side[rows], uid[rows], at[rows], copies[rows], filters[rows]
            x = _units(values, begin[rows], dim)
            edge = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1], [True]]))
            size, split = np.diff(edge), s[edge[:-1]] >= 0
            few = np.repeat(~split & (size <= FEW), size)
            i, j = _small_cells(c[few], f[few], x[few], fs[few], least)
            a, b, wa, wb = u[few][i], u[few][j], w[few][i], w[few][j]
            # a link is an edge and counts once, at the smallest filter that both share
            found += [(a, wb, np.minimum(a, b)), (b, wa, np.minimum(a, b))]
            for k in np.flatnonzero(split | (size > FEW)).tolist():
                lo, hi = int(edge[k]), int(edge[k + 1])
                mid = lo + int(np.searchsorted(s[lo:hi], 1)) if split[k] else hi
                if mid == lo:
                    continue  # only one of two blocks
                cross = mid < hi  # two blocks: the pairs across; one: the pairs inside
                one, two = slice(lo, mid), slice(mid, hi) if cross else slice(lo, hi)
                near = x[one] @ x[two].T >= least
                if not cross:
                    np.fill_diagonal(near, False)
                if not near.any():
                    continue
                new = near & _first_shared(fs[one], fs[two], int(f[lo]))
                own, n = u[lo:hi], new @ w[two]
                if cross:
                    linked = np.zeros((hi - lo, hi - lo), dtype=bool)
                    linked[: mid - lo, mid - lo :], linked[mid - lo :, : mid - lo] = near, near.T
                    n = np.concatenate([n, new.T @ w[one]])
                else:
                    linked = near
                some = np.flatnonzero(linked.any(1))
                found.append((own[some], n[some], _least_reached(linked[np.ix_(some, some)], own[some])))
        columns = [np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in range(3)]
        return pa.table([pa.array(x.astype(np.int64)) for x in columns], names=["uid", "n", "reached"])

    return run


def _met(found: DataFrame) -> DataFrame:
    """Rows of cells: vectors that share a filter, those of frequent filters once for each pair of blocks they take part in."""
    key = ["label", "dim", "filter"]
    placed = cut_lineage(found.select("uid", "label", "dim", F.explode("filters").alias("filter")))
    sizes = placed.groupBy(*key).count().where("count > 1")
    spread = placed.join(sizes, key).withColumn("blocks", F.ceil(F.col("count") / CELL).cast("int")).withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    of_cell = lambda i, j: F.xxhash64(*key, i, j).alias("cell")
    whole = spread.where("blocks = 1").select("uid", "filter", of_cell(F.lit(0), F.lit(0)), F.lit(-1).alias("side"))
    parts = spread.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = parts.select("uid", "filter", of_cell(F.least("block", "other"), F.greatest("block", "other")), (F.col("block") > F.col("other")).cast("int").alias("side"))
    cells = cut_lineage(whole.unionByName(cut))
    slots = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-cells.count() // SLOT))
    return cells.withColumn("slot", F.pmod(F.xxhash64("cell"), F.lit(slots)).cast("int")).join(found.select("uid", "copies", "vector", "filters"), "uid")


def _told(own: DataFrame, told: DataFrame) -> DataFrame:
    """The rows with what their class was told; a class with a thousandth of all rows or more comes by broadcast."""
    total = own.count()
    # at most HOT_SHARE classes can hold so many rows each
    hot = told.where(F.col("copies") * HOT_SHARE >= total).select("label", "vector", F.struct("copies", "n", "component").alias("hot"))
    rest = told.where(F.col("copies") * HOT_SHARE < total).select("label", "vector", F.struct("copies", "n", "component").alias("rest"))
    met = own.join(F.broadcast(hot), ["label", "vector"], "left")
    done = met.where("hot IS NOT NULL").withColumn("class", F.col("hot"))
    todo = met.where("hot IS NULL AND takes_part").join(rest, ["label", "vector"], "left").withColumn("class", F.col("rest"))
    alone = met.where("hot IS NULL AND NOT takes_part").withColumn("class", F.lit(None).cast(hot.schema["hot"].dataType))
    columns = ["vec_id", "label", "takes_part", "class"]
    rows = done.select(columns).unionByName(todo.select(columns)).unionByName(alone.select(columns))
    copies = F.coalesce("class.copies", F.lit(1).cast("long"))
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("class.component"))
    return rows.select(
        "vec_id", "label", copies.alias("class_size"), (F.coalesce("class.n", F.lit(0).cast("long")) + copies - 1).alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def vector_links(vectors: DataFrame, least: float = LEAST_COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: ``vec_id, label, class_size`` (rows with the same vector and label), ``n_links, component_id, kept``."""
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(kind).alias("vector"))
    sound = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists("vector", lambda x: x != 0)
    own = cut_lineage(own.withColumn("takes_part", F.coalesce(sound & F.col("label").isNotNull(), F.lit(False))))
    grouped = own.where("takes_part").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    classes = cut_lineage(grouped.select(F.monotonically_increasing_id().alias("uid"), F.size("vector").alias("dim"), "label", "copies", "least_id", "vector"))
    found = cut_lineage(classes.mapInArrow(_decoded, f"uid bigint, dim int, label string, copies bigint, least_id bigint, vector {kind}, filters array<int>"))
    links = cut_lineage(_met(found).groupBy("slot").applyInArrow(cell_links(least), "uid bigint, n bigint, reached bigint"))
    roots = components(links.select(F.col("uid").alias("a"), F.col("reached").alias("b")))
    rooted = cut_lineage(classes.select("uid", "least_id").join(roots.withColumnRenamed("node", "uid"), "uid"))
    of_class = rooted.join(rooted.groupBy("root").agg(F.min("least_id").alias("component")), "root").select("uid", "component")
    counted = links.groupBy("uid").agg(F.sum("n").alias("n"))
    told = classes.join(counted.join(of_class, "uid"), "uid", "left").where("n IS NOT NULL OR copies > 1")
    return _told(own, cut_lineage(told.select("label", "vector", "copies", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("component", "least_id").alias("component"))))
