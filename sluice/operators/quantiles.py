"""Exact linear-interpolation quantiles without a single-task value map.

Spark's exact ``percentile`` keeps a value -> count map per group and merges all
maps into ONE task for a global aggregate: memory grows with the number of
distinct values, which is unbounded at 100 TB.  ``exact_quantiles`` reads the
column three times instead, each a plain (partial) aggregation:

1. exact ``n`` and a KLL sketch of the column.  Sketches are merged in two levels
   (per bucket of map partitions, then globally), so the final merge sees at most
   ``buckets`` sketches, not one per map task;
2. for every probability a value bracket read off that sketch, with a rank margin
   several times the sketch error: conditional aggregates count the rows below it
   exactly and sketch the rows inside, all brackets in one pass without repeating
   rows;
3. inside the second brackets (~0.02 % of the rows) values are counted per distinct
   value (ties, even a value holding a third of all rows, collapse to one row).
   The values are dealt into bins cut at the second sketch's grid; the bins' totals
   tell which bins hold the ranks ``floor(h)`` and ``ceil(h)``, ``h = p * (n - 1)``,
   and only these are ordered, each by itself.  The answer is
   ``lo + (hi - lo) * (h - floor(h))`` — the rule of pandas/numpy ``linear`` and
   DuckDB ``quantile_cont``.

NULL and NaN are missing values.  The whole computation is one lazy plan.  If a
bracket ever missed a target rank the job fails via ``raise_error`` rather than
return a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kll_rank_error(k: int) -> float:
    """Conservative normalized rank error of a KLL sketch with parameter ``k``
    (published single-sided bound ~2.3/k^0.97 at 99% confidence, rounded up)."""
    return 3.0 / (k ** 0.9)


GRID = 512
GRID_RANKS = np.arange(GRID + 1, dtype="float64") / GRID


def _grid(sketch: Column) -> Column:
    """The sketch's values at a fixed grid of ranks (the ranks must be a literal)."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(GRID_RANKS))


def _bracket(grid: Column, margin: float, below: Column, n_band: Column, r0: Column, r1: Column) -> tuple[Column, Column]:
    """Grid values ``(a, b)`` whose ranks enclose the target ranks r0..r1 with the
    margin plus two ranks to spare."""
    nb = F.nullif(n_band, F.lit(0)).cast("double")
    spare = F.lit(margin) + F.lit(2.0) / nb
    lo = (r0 - below + F.lit(1)).cast("double") / nb - spare
    hi = (r1 - below + F.lit(1)).cast("double") / nb + spare
    lo_i = F.greatest(F.lit(0), F.floor(lo * GRID)).cast("int")
    hi_i = F.least(F.lit(GRID), F.ceil(hi * GRID)).cast("int")
    # element_at is 1-based
    return F.element_at(grid, lo_i + 1), F.element_at(grid, hi_i + 1)


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    k: int = 4096,
    buckets: int = 1024,
    margin_factor: float = 3.0,
    method: str = "sketch",
    accuracy: int = 10_000,
) -> DataFrame:
    """One row with one double column per probability (NULL if there is no value).

    ``method="sketch"`` (default) is exact and scale-safe.  Each bracket holds about
    ``2 * (margin_factor * kll_rank_error(k) + 1 / GRID)`` (~1.4 %) of the rows it was
    read from.  ``"percentile"`` uses Spark's exact ``percentile`` (fine when distinct
    values are few); ``"approx"`` returns ``approx_percentile`` (rank error
    n/accuracy).
    """
    probs = [float(p) for p in probs]
    names = list(names or [f"q{i}" for i in range(len(probs))])
    x = F.col("x")
    vals = df.select(F.col(column).cast("double").alias("x")).where(x.isNotNull() & ~F.isnan(x))

    if method == "percentile":
        q = vals.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("qs"))
        return q.select(*[F.col("qs")[i].alias(nm) for i, nm in enumerate(names)])
    if method == "approx":
        q = vals.agg(F.percentile_approx("x", probs, accuracy).alias("qs"))
        return q.select(*[F.col("qs")[i].alias(nm) for i, nm in enumerate(names)])
    if method != "sketch":
        raise ValueError(f"unknown method {method!r}")

    every, margin = range(len(probs)), margin_factor * kll_rank_error(k)
    bucket = (F.spark_partition_id() % F.lit(buckets)).alias("_bucket")

    # pass 1: n and a sketch of everything -> ranks and first brackets (one struct)
    parts = vals.groupBy(bucket).agg(F.kll_sketch_agg_double("x", k).alias("s"), F.count(F.lit(1)).alias("n"))
    whole = parts.agg(F.kll_merge_agg_double("s", k).alias("s"), F.sum("n").alias("n")).where("n > 0")
    whole = whole.select("n", _grid(F.col("s")).alias("g"))
    fields = [F.col("n")]
    for i, p in enumerate(probs):
        h = F.lit(p) * (F.col("n") - F.lit(1)).cast("double")
        r0, r1 = F.floor(h), F.ceil(h)
        a, b = _bracket(F.col("g"), margin, F.lit(0), F.col("n"), r0, r1)
        fields += [h.alias(f"h{i}"), r0.alias(f"r0{i}"), r1.alias(f"r1{i}"), a.alias(f"a{i}"), b.alias(f"b{i}")]
    # subqueries enter as columns: their plans hold a partition number, which an
    # aggregate's arguments may not
    first, second = F.col("first"), F.col("second")
    at_first = vals.withColumn("first", whole.select(F.struct(*fields)).scalar())

    # pass 2: below and inside of every bracket by conditional aggregates
    aggs = []
    for i in every:
        inside = F.when((x >= first[f"a{i}"]) & (x <= first[f"b{i}"]), x)
        aggs += [
            F.count_if(x < first[f"a{i}"]).alias(f"below{i}"),
            F.count(inside).alias(f"band{i}"),
            F.kll_sketch_agg_double(inside, k).alias(f"s{i}"),
        ]
    aggs.append(F.max("first").alias("first"))
    parts = at_first.groupBy(bucket).agg(*aggs)
    merged = parts.agg(F.max("first").alias("first"), *[
        c for i in every
        for c in (F.sum(f"below{i}").alias(f"below{i}"), F.sum(f"band{i}").alias(f"band{i}"), F.kll_merge_agg_double(f"s{i}", k).alias(f"s{i}"))
    ]).where("band0 is not null")
    grids = merged.select("first", *[f"below{i}" for i in every], *[f"band{i}" for i in every], *[_grid(F.col(f"s{i}")).alias(f"g{i}") for i in every])
    fields = []
    for i in every:
        a, b = _bracket(F.col(f"g{i}"), margin, F.col(f"below{i}"), F.col(f"band{i}"), first[f"r0{i}"], first[f"r1{i}"])
        fields += [a.alias(f"a{i}"), b.alias(f"b{i}"), F.col(f"g{i}")]
        fields += [first[f"{c}{i}"].alias(f"{c}{i}") for c in ("h", "r0", "r1")]
    bounds = grids.select(F.struct(*fields)).scalar()

    # pass 3: one row per distinct value inside any bracket; all others together, told
    # apart only by which brackets they are below
    inside_any, below = F.lit(False), F.lit(0)
    for i in every:
        inside_any = inside_any | ((x >= second[f"a{i}"]) & (x <= second[f"b{i}"]))
        below = below + F.when(x < second[f"a{i}"], F.lit(1 << i)).otherwise(F.lit(0))
    key = F.when(inside_any, x)
    zoned = vals.withColumn("second", bounds).select(
        key.alias("x"), F.when(key.isNull(), below).otherwise(F.lit(0)).alias("zone")
    )
    counts = zoned.groupBy("x", "zone").agg(F.count(F.lit(1)).alias("c")).withColumn("second", bounds)
    # per bracket the bin of a value: -1 below, else the number of grid cuts under it
    per_bracket = []
    for i in every:
        a, b = second[f"a{i}"], second[f"b{i}"]
        cuts = F.aggregate(second[f"g{i}"], F.lit(0), lambda acc, g: acc + F.when(g < x, F.lit(1)).otherwise(F.lit(0)))
        bin_ = (
            F.when(x.isNull(), F.when(F.col("zone").bitwiseAND(F.lit(1 << i)) != 0, F.lit(-1)))
            .when(x < a, F.lit(-1)).when(x <= b, cuts)
        )
        per_bracket.append(F.struct(
            F.lit(i).alias("i"), bin_.alias("bin"),
            second[f"h{i}"].alias("h"), second[f"r0{i}"].alias("r0"), second[f"r1{i}"].alias("r1"),
        ))
    binned = counts.select("x", "c", F.inline(F.array(*per_bracket))).where(F.col("bin").isNotNull())
    totals = binned.groupBy("i", "bin").agg(F.sum("c").alias("total"), F.max("r0").alias("r0"), F.max("r1").alias("r1"))
    ordered = Window.partitionBy("i").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most GRID + 2 bins per probability, whatever the size of the column
    end = F.sum("total").over(ordered)
    spans = totals.select("i", "bin", "r0", "r1", (end - F.col("total")).alias("start"), end.alias("end"))
    holds = lambda r: (F.col("start") <= F.col(r)) & (F.col(r) < F.col("end"))
    wanted = spans.where((F.col("bin") >= 0) & (holds("r0") | holds("r1"))).select("i", "bin", "start")
    w = Window.partitionBy("i", "bin").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("start") + F.sum("c").over(w)
    ranked = binned.join(wanted, ["i", "bin"]).select("i", "x", "h", "r0", "r1", upto.alias("end"), (upto - F.col("c")).alias("start"))
    out = []
    for i, nm in enumerate(names):
        mine = F.col("i") == i
        v0, v1 = F.max(F.when(mine & holds("r0"), x)), F.max(F.when(mine & holds("r1"), x))
        h, r0 = F.max(F.when(mine, F.col("h"))), F.max(F.when(mine, F.col("r0")))
        missed = F.raise_error(F.lit("exact_quantiles: bracket missed the target rank")).cast("double")
        value = F.when(v0.isNull() | v1.isNull(), missed).otherwise(v0 + (v1 - v0) * (h - r0))
        out.append(F.when(F.max("h").isNull(), F.lit(None).cast("double")).otherwise(value).alias(nm))
    return ranked.agg(*out)
