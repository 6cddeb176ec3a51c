"""Profiles of tables and columns: counts, shares, summaries, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ticktalk.operators.quantiles import exact_percentiles

QUARTILES = (0.25, 0.5, 0.75)
WEEK_HOURS = 168


def _long_form(one_row: DataFrame, value: str) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "column", value)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) from one pass."""
    columns = columns or df.columns
    return _long_form(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "nulls")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False, digest: bool = True) -> DataFrame:
    """(column, distinct, percent of rows); nulls are not counted as a value. All but the last column by default.

    Exact counts shuffle every distinct value. ``digest`` sends 256-bit digests of text instead of the text.
    """
    columns = list(columns or df.columns[:-1])

    def counted(name: str) -> Column:
        if approximate:
            return F.approx_count_distinct(name)
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        return F.count_distinct(F.unhex(F.sha2(name, 256)) if digest and is_text else F.col(name))

    counts = df.agg(F.count("*").alias("__rows"), *[counted(c).alias(c) for c in columns])
    return counts.unpivot("__rows", columns, "column", "distinct").select(
        "column", "distinct", (F.col("distinct") * 100.0 / F.col("__rows")).alias("percent")
    )


def true_share(df: DataFrame, flag: str) -> DataFrame:
    """Percent of all rows, nulls included, whose flag is true."""
    return df.agg((F.count_if(F.col(flag)) * 100.0 / F.count("*")).alias("percent_true"))


def daily_stats(df: DataFrame, ts: str = "timestamp", value: str = "price") -> DataFrame:
    """Mean and sample deviation per date; NULL deviation for a single row."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def describe(df: DataFrame, value: str, approximate: bool = False, **size) -> DataFrame:
    """count, mean, std, min, quartiles, max of the non-null values, in one row."""
    named = [F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")]
    ends = [F.min(value).alias("min"), F.max(value).alias("max")]
    if approximate:
        cuts = F.approx_percentile(value, list(QUARTILES), 10_000)
        table = df.agg(*named, *ends, cuts.alias("q"))
        q = [F.col("q")[i] for i in range(3)]
    else:
        quartiles = exact_percentiles(df, value, QUARTILES, **size)
        table = df.agg(*named, *ends).withColumn("q", quartiles.select(F.struct("p0", "p1", "p2")).scalar())
        q = [F.col("q")[f"p{i}"] for i in range(3)]
    return table.select("count", "mean", "std", "min", *[v.alias(n) for v, n in zip(q, ("p25", "p50", "p75"))], "max")


def spread_per_group(df: DataFrame, value: str, by: Sequence[str], **size) -> DataFrame:
    """Per group: count, min, quartiles, max of the non-null values."""
    points = exact_percentiles(df, value, (0.0, *QUARTILES, 1.0), by=by, **size)
    names = ("min", "p25", "p50", "p75", "max")
    return points.select(*by, F.col("n").alias("count"), *[F.col(f"p{i}").alias(name) for i, name in enumerate(names)])


def _ends(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.struct(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).alias("ends"))


def histogram(df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, low, high, count) for equal-width bins, empty ones included; the last bin is closed on the right.

    Without given ends the range is that of the data, and one wide around a constant. Values outside are left out.
    """
    spark = df.sparkSession
    values = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(F.col(value).cast("double").alias("x"))
    if low is None or high is None:
        ends = _ends(values, "x").scalar()
        flat = ends["lo"] == ends["hi"]
        lo = F.when(flat, ends["lo"] - 0.5).otherwise(ends["lo"])
        hi = F.when(flat, ends["hi"] + 0.5).otherwise(ends["hi"])
    else:
        lo, hi = F.lit(float(low)), F.lit(float(high))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    counts = (
        values.withColumns({"lo": lo, "hi": hi})
        .where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
        .select(F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )
    every = spark.range(bins).select(F.col("id").alias("bin"), lo.alias("lo"), hi.alias("hi"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def with_equal_bins(df: DataFrame, value: str, bins: int, out: str = "bin") -> DataFrame:
    """Add the number, from 1, of the right-closed equal-width bin; the first bin also takes the minimum."""
    spare = "__ends"
    width = (F.col(f"{spare}.hi") - F.col(f"{spare}.lo")) / F.lit(bins)
    place = F.ceil((F.col(value) - F.col(f"{spare}.lo")) / F.nullif(width, F.lit(0.0)))
    number = F.when(F.col(value).isNotNull(), F.least(F.greatest(F.lit(1), F.coalesce(place, F.lit((bins + 1) // 2))), F.lit(bins)))
    return df.withColumn(spare, _ends(df, value).scalar()).withColumn(out, number.cast("int")).drop(spare)


def rows_by_hour(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.count("*").alias("count"))


def volume_kpi(df: DataFrame, hours: int = WEEK_HOURS, more_than: float = 10) -> DataFrame:
    """Row count, mean per hour, and the two checks on them."""
    return df.agg(F.count("*").alias("messages")).select(
        "messages",
        (F.col("messages") / F.lit(float(hours))).alias("per_hour"),
        (F.col("messages") > 0).alias("not_empty"),
        (F.col("messages") / F.lit(float(hours)) > more_than).alias("enough_per_hour"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
