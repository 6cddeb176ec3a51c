"""Sorted, largest, newest, and sampled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ticktalk.operators.runs import RUN, Runs

PLAIN_TOP = 1000  # up to here every task may send its own top rows to the last one


def sort_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Total order by range partitions; a tie-break column in ``order`` also splits a hot value."""
    return df.orderBy(*order)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def newest_rows(df: DataFrame, n: int, order: Sequence[str], plain_top: int = PLAIN_TOP, **size) -> DataFrame:
    """The last ``n`` rows along ``order``, newest first.

    For a large ``n`` the rows are first narrowed to the newest runs that hold at least ``n`` rows, so that the last
    task meets about ``n`` rows and not ``n`` from every task before it.
    """
    newest = [F.desc(c) for c in order]
    if n > plain_top:
        runs = Runs(df, order, **size)
        if not runs.cuts.whole:
            newer = runs.scan(runs.per_run(F.count("*").alias("newer")), sum_after=["newer"])
            first = newer.where(F.col("newer") < n).agg(F.min(RUN)).first()[0]
            df = runs.df.where(F.col(RUN) >= first).drop(RUN)
    return df.orderBy(*newest).limit(n)


def longest_texts(df: DataFrame, text: str = "text", key: str = "message_id", n: int = 100, out: str = "text_length") -> DataFrame:
    """(key, length) of the longest texts; of equal ones the lower key comes first."""
    return df.select(key, F.length(text).alias(out)).orderBy(F.desc(out), key).limit(n)


def random_sample(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer."""
    return df.orderBy(F.rand(seed)).limit(n)


def keyed_sample(df: DataFrame, n: int, key: str) -> DataFrame:
    """Exactly ``n`` rows, the same ones whatever the layout of the table: those with the lowest digest of ``key``."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
