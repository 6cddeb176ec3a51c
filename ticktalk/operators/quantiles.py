"""Exact percentiles without gathering a group's values in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticktalk.operators.runs import _FINE_BITS, RUN, Runs
from ticktalk.session import settle


def _group_carry(runs: Runs, counts: str) -> DataFrame:
    """For every run its first and last group, how often the first one is counted in earlier runs, and how often both are in all.

    Only groups at the ends of runs go on into other runs, so at most two rows per run are added up: among the runs of a
    coarse range first, then among the ranges.
    """
    sums = settle(runs.df.groupBy(RUN, runs.group().alias("g")).agg(F.sum(counts).alias("n")), "run-groups")
    ends = sums.groupBy(RUN).agg(F.min("g").alias("first"), F.max("g").alias("last"))
    edge = sums.join(ends, RUN).where(F.col("g").eqNullSafe(F.col("first")) | F.col("g").eqNullSafe(F.col("last")))
    edge = edge.withColumn("__coarse", F.shiftright(RUN, _FINE_BITS))
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = (Window.unboundedPreceding, -1)
    in_range = Window.partitionBy("__coarse", "g").orderBy(RUN)
    marked = edge.withColumns({"near": F.coalesce(F.sum("n").over(in_range.rowsBetween(*so_far)), F.lit(0)), "held": F.sum("n").over(in_range.rowsBetween(*whole))})
    ranges = edge.groupBy("__coarse", "g").agg(F.sum("n").alias("n"))
    across = Window.partitionBy("g").orderBy("__coarse")
    ranges = ranges.select("__coarse", "g", F.coalesce(F.sum("n").over(across.rowsBetween(*so_far)), F.lit(0)).alias("far"), F.sum("n").over(across.rowsBetween(*whole)).alias("total"))
    far = ranges.select(F.col("__coarse").alias("__range"), F.col("g").alias("__g"), "far", "total")
    joined = marked.join(far, (F.col("__coarse") == F.col("__range")) & F.col("g").eqNullSafe(F.col("__g")))
    is_first = F.col("g").eqNullSafe(F.col("first"))
    is_last = F.col("g").eqNullSafe(F.col("last"))
    return joined.groupBy(RUN).agg(
        F.first("first").alias("__first"),
        F.first("last").alias("__last"),
        F.max(F.when(is_first, F.col("near") + F.col("far"))).alias("__before"),
        F.max(F.when(is_first, F.col("total"))).alias("__first_total"),
        F.max(F.when(is_last, F.col("total"))).alias("__last_total"),
    )


def exact_percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), **size
) -> DataFrame:
    """Linearly interpolated percentiles of the non-null values, as columns ``p0, p1, ...`` in the order given,
    and their number ``n``.

    One scan counts the values. The counts are ranked along runs of ``by + value``, where a group takes its rank and its
    size from the runs before and after; only the rows that hold a wanted rank go on, a few for each group.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    counts = settle(counts, "value-counts")
    runs = Runs(counts, [value], by, **size)

    in_group = Window.partitionBy(RUN, *by)
    upto = F.sum("__n").over(runs.window().rowsBetween(Window.unboundedPreceding, 0))
    ranked = runs.spread().withColumns({"__upto": upto, "__total": F.sum("__n").over(in_group)})
    if not runs.cuts.whole:
        ranked = ranked.join(_group_carry(runs, "__n"), RUN)
        in_first, in_last = runs.group().eqNullSafe(F.col("__first")), runs.group().eqNullSafe(F.col("__last"))
        total = F.when(in_first, F.col("__first_total")).when(in_last, F.col("__last_total")).otherwise(F.col("__total"))
        ranked = ranked.withColumns({"__upto": F.col("__upto") + F.when(in_first, F.col("__before")).otherwise(0), "__total": total})

    # A row covers ranks [__upto - __n, __upto) and matters to a place if it holds the rank right below or above it.
    def holds(rank: Column) -> Column:
        return (rank >= F.col("__upto") - F.col("__n")) & (rank < F.col("__upto"))

    places = []
    for i, p in enumerate(probabilities):
        at = F.lit(float(p)) * (F.col("__total") - 1)
        held = holds(F.floor(at)) | holds(F.ceil(at))
        places.append(F.when(held, F.struct(F.lit(i).alias("i"), at.alias("at"))))
    near = (
        ranked.withColumn("__w", F.explode(F.array(*places)))
        .where(F.col("__w").isNotNull())
        .withColumns({"__i": F.col("__w.i"), "__at": F.col("__w.at")})
    )
    low, high = F.floor("__at"), F.ceil("__at")
    share = F.col("__at") - low
    part = F.when(holds(low), F.col(value) * (1 - share)).otherwise(F.lit(0.0)) + F.when(
        holds(high) & (high > low), F.col(value) * share
    ).otherwise(F.lit(0.0))
    pieces = near.select(*by, "__total", "__i", part.alias("__part"))
    return pieces.groupBy(*by).agg(
        F.max("__total").alias("n"),
        *[F.sum(F.when(F.col("__i") == i, F.col("__part"))).alias(f"p{i}") for i in range(len(probabilities))]
    )
