"""Cross-section operators: ranks, buckets, winsorization, standardization.

Every operator has two plans with the same results.

``window``  one sort per group. Right while the largest group fits a task.
``split``   no group is ever sorted in one task (see ``ordered``): values are
            pre-aggregated, range-partitioned, and joined back.

``plan="auto"`` measures the largest group and picks. A caller that knows a bound
(for a panel: the number of entities) passes ``width`` and saves that pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.scalars import clip, ratio
from tidepanel.operators.ordered import column_quantiles, exact_quantiles, group_width, null_safe_join, running_total, stepped
from tidepanel.session import cut_lineage

WINDOW_ROW_LIMIT = 2_000_000


def choose_plan(df: DataFrame, by: Sequence[str], plan: str = "auto", width: int | None = None) -> str:
    if plan != "auto":
        return plan
    rows = width if width is not None else group_width(df, by)
    return "window" if rows <= WINDOW_ROW_LIMIT else "split"


# ---------------------------------------------------------------- ranks
def ordinal_rank_expr(x: str | Column, by: Sequence[str], tie: str, descending: bool = False, min_n: int = 0) -> Column:
    """Ordinal percentile rank as a window expression; ties go by ``tie``."""
    x = F.col(x) if isinstance(x, str) else x
    key = -x if descending else x
    n = F.count(x).over(Window.partitionBy(*by))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(key.asc_nulls_last(), tie)) / n
    return F.when(x.isNotNull() & (n >= min_n), rank)


def average_rank_expr(x: str | Column, by: Sequence[str], min_n: int = 0) -> Column:
    """Average-tie percentile rank as a window expression: rank and ties read one sort."""
    x = F.col(x) if isinstance(x, str) else x
    n = F.count(x).over(Window.partitionBy(*by))
    ordered = Window.partitionBy(*by).orderBy(x.asc_nulls_last())
    first = F.rank().over(ordered)
    ties = F.count(x).over(ordered.rangeBetween(Window.currentRow, Window.currentRow))
    return F.when(x.isNotNull() & (n >= min_n), (first + (ties - 1) / 2) / n)


def add_ranks(
    df: DataFrame,
    ranks: dict[str, str],
    by: Sequence[str],
    id_cols: Sequence[str],
    tie: str,
    method: str = "ordinal",
    descending: Sequence[str] = (),
    min_n: int = 0,
    plan: str = "auto",
    width: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add percentile ranks ``{output: input}`` inside the groups ``by``.

    ``id_cols`` identify a row; ``tie`` breaks ordinal ties. Outputs listed in
    ``descending`` rank the negated value. ``stored`` says that ``df`` is a stored table, which the split
    plan need not store again.
    """
    if choose_plan(df, by, plan, width) == "window":
        def expr(out: str, src: str) -> Column:
            if method == "average":
                return average_rank_expr(-F.col(src) if out in descending else src, by, min_n)
            return ordinal_rank_expr(src, by, tie, out in descending, min_n)

        return df.withColumns({o: expr(o, s) for o, s in ranks.items()})

    keys = [*dict.fromkeys([*by, *id_cols])]
    carried = [*dict.fromkeys([*keys, tie])]
    signed = [(-F.col(s) if o in descending else F.col(s)).cast("double").alias(o) for o, s in ranks.items()]
    # what is ranked is stored, since several steps read it; a table without other columns is planned once
    narrow = df.select(*dict.fromkeys([*carried, *ranks.values()]))
    narrow = narrow if stored else cut_lineage(narrow)
    df = narrow.select(*df.columns) if set(df.columns) == set(narrow.columns) else df
    # one long table ranks all columns in a single range shuffle; the names travel with every value
    short = {o: f"_{i}" for i, o in enumerate(ranks)}
    rows = (
        narrow.select(*carried, *[s.alias(short[o]) for s, o in zip(signed, ranks)])
        .unpivot(carried, list(short.values()), "_var", "_x")
        .where(F.col("_x").isNotNull())
    )
    groups = ["_var", *by]
    if method == "average":
        counted = rows.groupBy(*groups, "_x").agg(F.count(F.lit(1)).alias("_ties"))
        placed = running_total(counted, groups, ["_x"], weight="_ties", out="_below")
        placed = null_safe_join(placed, placed.groupBy(*groups).agg(F.sum("_ties").alias("_n")), groups)
        placed = placed.withColumn("_rank", (F.col("_below") + 1 + (F.col("_ties") - 1) / 2) / F.col("_n")).drop("_below", "_ties")
        ranked = null_safe_join(rows, placed, [*groups, "_x"])
    else:
        placed = running_total(rows, groups, ["_x", tie], out="_below")
        sizes = placed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
        ranked = null_safe_join(placed, sizes, groups).withColumn("_rank", (F.col("_below") + 1) / F.col("_n"))
    wide = ranked.groupBy(*keys).agg(
        *[F.max(F.when((F.col("_var") == short[o]) & (F.col("_n") >= min_n), F.col("_rank"))).alias(o) for o in ranks]
    )
    # stored, so that ranking again on the result does not plan this input twice
    return null_safe_join(df, cut_lineage(wide), keys)


def add_rank_with_fallback(
    df: DataFrame, x: str, out: str, date: str, levels: Sequence[str], id_cols: Sequence[str], tie: str, min_n: int = 8, plan: str = "auto", width: int | None = None
) -> DataFrame:
    """Ordinal rank in the finest level with ``min_n`` values; the last level has no minimum."""
    plan = choose_plan(df, [date], plan, width)
    temp = [f"_fallback_{i}" for i in range(len(levels))]
    for i, (name, level) in enumerate(zip(temp, levels)):
        df = add_ranks(df, {name: x}, [date, level], id_cols, tie, min_n=min_n if i < len(levels) - 1 else 0, plan=plan)
    return df.withColumn(out, F.coalesce(*temp)).drop(*temp)


def add_top_k(df: DataFrame, x: str, out: str, by: Sequence[str], k: int, id_cols: Sequence[str], tie: str, plan: str = "auto", width: int | None = None) -> DataFrame:
    """1 for the k largest values per group (ties by ``tie``), 0 for the others, NULL for NULL."""
    if choose_plan(df, by, plan, width) == "window":
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(x).desc_nulls_last(), tie))
        return df.withColumn(out, F.when(F.col(x).isNotNull(), (place <= k).cast("int")))
    keys = [*dict.fromkeys([*by, *id_cols])]
    rows = df.where(F.col(x).isNotNull()).select(*dict.fromkeys([*keys, tie, x]))
    placed = running_total(rows, by, [F.col(x).desc(), F.col(tie)], out="_place").select(*keys, (F.col("_place") < k).cast("int").alias(out))
    return null_safe_join(df, placed, keys)


# ---------------------------------------------------------------- quantile edges and buckets
def bucket_edges(q: int) -> list[float]:
    return [i / q for i in range(q + 1)]


def bucket_of(x: Column, edges: Column) -> Column:
    """1-based right-closed bucket among distinct edges, lowest edge included."""
    return F.when(x.isNotNull(), F.greatest(F.lit(1), F.size(F.filter(edges, lambda e: e < x))))


def add_bucket(df: DataFrame, x: str, by: Sequence[str], q: int, out: str, plan: str = "auto", width: int | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Quantile buckets 1..q per group; equal edges are merged before numbering.

    Right behind a rank of ``x`` with the same ``tie``, the window plan uses the rank's sort.
    """
    probs = bucket_edges(q)
    if choose_plan(df, by, plan, width) == "window":
        group = Window.partitionBy(*by)
        placed = df.withColumns({"_place": F.row_number().over(group.orderBy(F.col(x).asc_nulls_last(), *tie)) - 1, "_n": F.count(x).over(group)})
        value_at = lambda place: F.max(F.when(F.col("_place") == place, F.col(x))).over(group)
        ats = {i: F.lit(p) * (F.col("_n") - 1) for i, p in enumerate(probs)}
        # the first and the last edge are values themselves
        inner = [i for i, p in enumerate(probs) if 0 < p < 1]
        found = placed.withColumns({**{f"_lo{i}": value_at(F.floor(at)) for i, at in ats.items()}, **{f"_hi{i}": value_at(F.ceil(ats[i])) for i in inner}})
        edges = [stepped(F.col(f"_lo{i}"), F.col(f"_hi{i}"), at) if i in inner else F.col(f"_lo{i}").cast("double") for i, at in ats.items()]
        with_edges = found.withColumn("_edges", F.array(*edges)).drop("_place", "_n", *[f"_lo{i}" for i in ats], *[f"_hi{i}" for i in inner])
    else:
        names = {f"_e{i}": p for i, p in enumerate(probs)}
        per_group = exact_quantiles(df, by, x, names, "stepped").select(*by, F.array(*names).alias("_edges"))
        with_edges = null_safe_join(df, per_group, by)
    return with_edges.withColumn(out, bucket_of(F.col(x), F.array_distinct("_edges"))).drop("_edges")


def winsorize(
    df: DataFrame, cols: Sequence[str], by: Sequence[str], lower: float = 0.02, upper: float = 0.98, plan: str = "auto", width: int | None = None, suffix: str = ""
) -> DataFrame:
    """Clip every column to its own quantiles per group."""
    if choose_plan(df, by, plan, width) == "window":
        w = Window.partitionBy(*by)
        bounds = {f"_q_{c}": F.percentile(F.col(c), F.array(F.lit(lower), F.lit(upper))).over(w) for c in cols}
        out = df.withColumns(bounds)
        out = out.withColumns({c + suffix: clip(F.col(c), F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]) for c in cols})
        return out.drop(*bounds)
    out = df
    for c in cols:
        q = exact_quantiles(df, by, c, {f"_lo_{c}": lower, f"_hi_{c}": upper})
        out = null_safe_join(out, q, by)
    return out.withColumns({c + suffix: clip(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")) for c in cols}).drop(
        *[f"_lo_{c}" for c in cols], *[f"_hi_{c}" for c in cols]
    )


def group_moments(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_std_{c}"), (F.max(c) > F.min(c)).alias(f"_vary_{c}")]
    return df.groupBy(*by).agg(*aggs)


def standardize(df: DataFrame, cols: Sequence[str], by: Sequence[str], suffix: str = "") -> DataFrame:
    """Per-group z-score; a constant or single-row group is only centred.

    Moments combine on the map side, so this needs no second plan.
    """
    out = null_safe_join(df, group_moments(df, cols, by), by)

    def z(c: str) -> Column:
        centred = F.col(c) - F.col(f"_mean_{c}")
        return F.when(F.col(f"_vary_{c}"), ratio(centred, F.col(f"_std_{c}"))).otherwise(centred)

    helper = [f"_{k}_{c}" for c in cols for k in ("mean", "std", "vary")]
    return out.withColumns({c + suffix: z(c) for c in cols}).drop(*helper)


# Fixed value: makes the median absolute deviation of normal data its standard deviation.
MAD_SCALE = 1.4826


def robust_standardize(df: DataFrame, cols: Sequence[str], by: Sequence[str], plan: str = "auto", width: int | None = None, suffix: str = "") -> DataFrame:
    """Per-group z-score from median and median absolute deviation; without deviation only centred."""
    plan, out = choose_plan(df, by, plan, width), df

    def median(source: DataFrame, c: str, name: str) -> DataFrame:
        if plan == "window":
            return source.withColumn(name, F.percentile(F.col(c), F.lit(0.5)).over(Window.partitionBy(*by)))
        return null_safe_join(source, exact_quantiles(source, by, c, {name: 0.5}), by)

    for c in cols:
        out = median(out, c, "_med").withColumn("_off", F.abs(F.col(c) - F.col("_med")))
        out = median(out, "_off", "_mad")
        centred = F.col(c) - F.col("_med")
        out = out.withColumn(c + suffix, F.when(F.col("_mad") > 0, centred / (F.col("_mad") * MAD_SCALE)).otherwise(centred)).drop("_med", "_off", "_mad")
    return out


# ---------------------------------------------------------------- whole-table clipping
def clip_sigma(
    df: DataFrame, outputs: dict[str, str], n_sigma: float = 5.0, only: Sequence[str] | None = None, store: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """``{output: input}`` clipped at mean +- n sigma of the whole column.

    The statistics are one aggregated row, read back as a scalar subquery. The table is stored before (by ``store``), since
    the statistics and the clipping both read it. ``only`` names the wanted columns: others are neither stored nor returned.
    """
    sources = [*dict.fromkeys(outputs.values())]
    df = store(df if only is None else df.select(*[c for c in df.columns if c in only or c in sources]))
    stats = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in sources]).alias("stats")
    )
    out = df.withColumn("_stats", stats.scalar())

    def bounded(c: str) -> Column:
        s = F.col("_stats")[c]
        return clip(F.col(c), s["m"] - n_sigma * s["s"], s["m"] + n_sigma * s["s"])

    out = out.withColumns({o: bounded(c) for o, c in outputs.items()}).drop("_stats")
    return out if only is None else out.select(*only)


def clip_quantile(df: DataFrame, outputs: dict[str, str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Clip at whole-column quantiles. ``df`` is read several times."""
    sources = [*dict.fromkeys(outputs.values())]
    return _clip_between(df, outputs, column_quantiles(df, sources, {"lo": lower, "hi": upper}))


def clip_mad(df: DataFrame, outputs: dict[str, str], n_mad: float = 5.0) -> DataFrame:
    """Clip at median +- n times the median absolute deviation of the whole column. ``df`` is read several times."""
    sources = [*dict.fromkeys(outputs.values())]
    med = column_quantiles(df, sources, {"med": 0.5})
    # one row, read back as a scalar: a join on the column's name would bring all its rows to one task
    row = med.agg(F.struct(*[F.max(F.when(F.col("_var") == c, F.col("med"))).alias(c) for c in sources]).alias("m"))
    centred = df.select(*sources).withColumn("_med", row.scalar()).select(*[F.abs(F.col(c).cast("double") - F.col("_med")[c]).alias(c) for c in sources])
    mad = column_quantiles(centred, sources, {"mad": 0.5})
    bounds = med.join(mad, "_var").select("_var", (F.col("med") - n_mad * F.col("mad")).alias("lo"), (F.col("med") + n_mad * F.col("mad")).alias("hi"))
    return _clip_between(df, outputs, bounds)


def _clip_between(df: DataFrame, outputs: dict[str, str], bounds: DataFrame) -> DataFrame:
    sources = [*dict.fromkeys(outputs.values())]
    row = bounds.agg(
        F.struct(*[F.max(F.when(F.col("_var") == c, F.struct("lo", "hi"))).alias(c) for c in sources]).alias("bounds")
    )
    out = df.withColumn("_bounds", row.scalar())
    return out.withColumns({o: clip(F.col(c), F.col("_bounds")[c]["lo"], F.col("_bounds")[c]["hi"]) for o, c in outputs.items()}).drop("_bounds")
