"""As-of join: each row meets the quote that is closest in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ticktalk.operators.runs import RUN, Runs

_SIDE, _TIE, _QUOTE = "__side", "__tie", "__quote"

_TIMES = (T.TimestampType, T.TimestampNTZType)


def _timed(df: DataFrame, on: str) -> Column:
    """Whether a row has a time: neither NULL nor NaN."""
    there = F.col(on).isNotNull()
    return there & ~F.isnan(on) if isinstance(df.schema[on].dataType, T.FractionalType) else there


def split_untimed(df: DataFrame, on: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(rows with a time, rows without)."""
    return df.where(_timed(df, on)), df.where(~_timed(df, on))


def _distance(dtype: T.DataType, later: Column, earlier: Column) -> Column:
    if isinstance(dtype, _TIMES):
        return F.timestamp_diff("MICROSECOND", earlier, later)
    if isinstance(dtype, T.IntegralType):  # the ends of the axis may be further apart than its type can tell
        return later.cast("decimal(20,0)") - earlier.cast("decimal(20,0)")
    return later - earlier


def _pick(
    found: DataFrame, columns: list[str], kept: list[str], on: str, dtype: T.DataType, tolerance: float | None, quote_time: str | None
) -> DataFrame:
    """The columns of ``left`` and those of its match, if that is near enough."""
    met = F.lit(True)
    if tolerance is not None:
        unit = 1e6 if isinstance(dtype, _TIMES) else 1
        met = F.abs(_distance(dtype, F.col(on), F.col("__match")["at"])) <= tolerance * unit
    matched = [F.when(met, F.col("__match")[c]).alias(c) for c in kept]
    if quote_time:
        matched.append(F.when(met, F.col("__match")["at"]).alias(quote_time))
    return found.select(*columns, *matched)


def asof_join(
    left: DataFrame,
    quotes: DataFrame,
    on: str = "timestamp",
    left_tie: str | None = None,
    quote_tie: str | None = None,
    by: Sequence[str] = (),
    direction: str = "nearest",
    tolerance: float | None = None,
    quote_time: str | None = None,
    **size,
) -> DataFrame:
    """Every row of ``left`` with a time, plus the columns of its quote (NULL where there is none).

    ``direction`` is ``backward`` (at or before), ``forward`` (at or after), or ``nearest``; of two equally near quotes
    the earlier one wins. Among quotes of the same time the last one by ``quote_tie`` is met going backward, and the
    first one going forward. ``tolerance`` is in seconds for timestamps, else in units of ``on``. ``quote_time`` names
    an extra column with the time of the quote. Rows without a time, NaN included, are left out on both sides: see ``split_untimed``.

    Both sides are laid out in one order and cut into runs; a run takes the last quote before it and the first one after it
    from what the other runs pass on. So neither a hot instant nor a hot ``by`` value ends up in one task, and no side is
    gathered anywhere.
    """
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    by = list(by)
    dtype = left.schema[on].dataType
    kept = [c for c in quotes.columns if c not in (*by, on)]
    clash = set(kept) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")

    # At the same time quotes come before messages, so that they count as "at or before" - unless only later ones count.
    quote_side = 1 if direction == "forward" else 0
    # Without a tie-break, a hash of the row spreads the messages of one instant.
    tie = F.col(left_tie).cast("string") if left_tie else F.xxhash64(*left.columns).cast("string")
    rows = left.where(_timed(left, on)).withColumns({_SIDE: F.lit(1 - quote_side), "__left_tie": tie})
    quote_rows = quotes.where(_timed(quotes, on)).select(
        *by,
        F.col(on).cast(dtype).alias(on),
        (F.col(quote_tie) if quote_tie else F.lit(0)).alias(_TIE),
        F.lit(quote_side).alias(_SIDE),
        F.struct(F.struct(*by).alias("by") if by else F.lit(0).alias("by"), F.col(on).cast(dtype).alias("at"), *kept).alias(_QUOTE),
    )
    both = rows.unionByName(quote_rows, allowMissingColumns=True)
    runs = Runs(both, [on, _SIDE, _TIE, "__left_tie"], by, **size)

    ahead = [F.asc(c) for c in runs.order]
    back = [F.desc(c) for c in runs.order]
    so_far = (Window.unboundedPreceding, 0)
    found = runs.spread()
    if direction != "forward":
        found = found.withColumn("__back", F.last(_QUOTE, ignorenulls=True).over(runs.window(*ahead).rowsBetween(*so_far)))
    if direction != "backward":
        found = found.withColumn("__fore", F.last(_QUOTE, ignorenulls=True).over(runs.window(*back).rowsBetween(*so_far)))
    found = found.where(F.col(_SIDE) == 1 - quote_side)

    if not runs.cuts.whole:
        place = F.when(F.col(_SIDE) == quote_side, F.struct(*[F.col(c) for c in runs.keys]))
        ends = runs.per_run(F.max_by(_QUOTE, place).alias("__before"), F.min_by(_QUOTE, place).alias("__after"))
        carry = runs.scan(ends, last_before=["__before"], first_after=["__after"])
        found = found.join(carry, RUN, "left")
        for near, far in (("__back", "__before"), ("__fore", "__after")):
            if near in found.columns:
                own = runs.same_group(F.col(far)["by"])
                found = found.withColumn(near, F.coalesce(F.col(near), F.when(own, F.col(far))))

    if direction == "backward":
        match = F.col("__back")
    elif direction == "forward":
        match = F.col("__fore")
    else:
        behind = _distance(dtype, F.col(on), F.col("__back")["at"])
        beyond = _distance(dtype, F.col("__fore")["at"], F.col(on))
        match = F.when(F.col("__fore").isNull() | (behind <= beyond), F.col("__back")).otherwise(F.col("__fore"))
    return _pick(found.withColumn("__match", match), left.columns, kept, on, dtype, tolerance, quote_time)
