"""Exact dedup: groups by a 128-bit hash of the text, bytes compared inside the groups, smallest id kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import BLANKS, query, table
from ticktalk.session import settle


def squeezed(text: Column) -> Column:
    """The text with each run of blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text as 16 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = squeezed,
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text`` hash ``text_sha256``.

    Equal normalised texts form a group; the smallest id stays. Hashes only find the groups: texts are grouped by hash *and*
    bytes (each task first folds its own copies, so a group with a third of all rows sends one row per task), and a hash with
    one text is then proven free of collisions and serves as the key of the light join back to the rows. Rows of a hash with
    several texts, should there be any, are joined on their bytes.

    Null text: equal to the empty one. Null id: never the one that stays unless the group has no other; ``kept`` if so.
    Rows that repeat an id and its text are one document and all are marked kept. Other columns are ignored. Empty table:
    no rows.
    """
    text = normalise(F.col(text_col))
    named = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).withColumn("_hash", digest(F.col("_text")))
    texts = named.groupBy("_hash", "_text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    hashes = texts.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    rows = named.select("doc_id", "_hash", F.sha2("_text", 256).alias("text_sha256"))
    found = settle(rows.join(hashes, "_hash"), "exact")
    result = found.where("_texts = 1").select("doc_id", "keep_id", "group_size", "text_sha256")
    mixed = found.where("_texts > 1").select("_hash").distinct()
    if not mixed.isEmpty():
        apart = named.join(mixed, "_hash", "left_semi").join(texts, ["_hash", "_text"])
        result = result.union(apart.select("doc_id", "keep_id", "group_size", F.sha2("_text", 256)))
    return result.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


@query(r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents),
g AS (SELECT x, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256 FROM t JOIN g ON t.x = g.x
""")
def op5_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))
