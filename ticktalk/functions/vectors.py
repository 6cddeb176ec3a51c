"""Embeddings as arrays, as list literals, and as ML vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, functions as F


def list_from_text(text: Column | str, item: str = "double") -> Column:
    """``"[0.1, 2]"`` as an array; bad text is NULL."""
    return F.from_json(text, f"array<{item}>")


def text_from_list(values: Column | str) -> Column:
    return F.to_json(values)


def cluster_from_text(text: Column | str) -> Column:
    """Cluster number; ``"None"`` and other bad text is NULL."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("int")


def dense(values: Column | str) -> Column:
    """ML vector of an array. The array must hold no nulls."""
    return array_to_vector(F.col(values) if isinstance(values, str) else values)


def plain(vector: Column | str, dtype: str = "float64") -> Column:
    return vector_to_array(F.col(vector) if isinstance(vector, str) else vector, dtype)
