"""Unions over drifting schemas, and removal of whole-row copies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_tables(tables: Iterable[DataFrame]) -> DataFrame:
    """All rows, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def drop_copies(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One of each set of equal rows, arrays included. ``keys`` compares fewer columns, where rows allow it."""
    return df.dropDuplicates(list(keys)) if keys else df.dropDuplicates()


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns."""
    return df.dropna("any", subset=list(columns) if columns else None)
