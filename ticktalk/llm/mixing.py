"""Mix sources to target weights by a golden-ratio schedule of equal blocks. DataFrame functions only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticktalk.llm.common import BLANKS, fresh, query, table, text_key, word_count
from ticktalk.session import settle

#: Weights of the sources in their order, repeating; share of all sizes that the mix has; most copies of a source.
WEIGHTS, SHARE, COPIES = (5.0, 2.0, 1.0), 1.5, 2.0
GOLDEN = (math.sqrt(5) - 1) / 2


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, copies: float = COPIES) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target, quota, number``.

    Sources by code point (null last) weigh ``weights`` in turn. A target stops at ``copies`` times its source's size and
    the excess goes to the others by weight: the level at which the capped shares add up is found by running sums over the
    sources in order of cap per weight. There is one row per source here, never one per document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(order) - 1).alias("number")
    cycle = F.array(*map(F.lit, weights))
    s = sizes.select("source", "source_size", number).withColumn("w", F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.lit(copies) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    up = Window.orderBy("ratio", "number")
    s = s.withColumn("capped", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open", F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)))
    every = Window.partitionBy()
    s = s.withColumn("level", (F.lit(share) * F.sum("source_size").over(every) - F.col("capped")) / F.col("open"))
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"])
    s = s.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))))
    return s.select("source", "source_size", "number", "target", F.round("target").cast("long").alias("quota"))


def _prefix(df: DataFrame, keys: list[str], group: str, order: list[str | Column], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same keys, in order of (group, order). Sums within groups, and over
    the totals of groups, so that no task meets all rows of one key."""
    total = df.groupBy(*keys, group).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(*keys, group, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inner.join(total, [*keys, group]).withColumn(out, F.col("_inner") + F.col("_before")).drop("_inner", "_before")


def slots(goals: DataFrame, n_slots: int) -> DataFrame:
    """The schedule: ``slot, number, rank``. Slot t has the point t * step mod n_slots, a rotation by the golden ratio in
    whole numbers; the source is that whose part of the cumulative quotas holds the point. As step and n_slots share no
    factor, each source gets exactly its number of blocks, spread evenly. Slots are ranked per source in their order."""
    spark = goals.sparkSession
    step = max(1, round(n_slots * GOLDEN))
    while math.gcd(step, n_slots) > 1:
        step += 1
    cell = max(16, math.isqrt(n_slots))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), ((F.col("id") * step) % n_slots).alias("point"))
    points = points.withColumn("cell", F.expr(f"point div {cell}"))
    parts = goals.where("blocks > 0").select("number", "low", (F.col("low") + F.col("blocks")).alias("high"))
    parts = parts.withColumn("cell", F.explode(F.expr(f"sequence(low div {cell}, (high - 1) div {cell})")))
    hit = points.join(parts, "cell").where("point >= low AND point < high").select("slot", "number", F.lit(1).alias("one"))
    hit = hit.withColumn("stretch", F.expr(f"slot div {cell}"))
    return _prefix(hit, ["number"], "stretch", ["slot"], "one", "rank").select("slot", "number", "rank")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = 1024,
    seed: int = 17,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    copies: float = COPIES,
) -> tuple[DataFrame, DataFrame]:
    """Returns (documents, mixture).

    Documents: one row per input row with ``doc_id, size, source, number, source_size, target, start`` and the row key
    ``number, place``. Mixture: ``slot, number, place, pass, from_word, n_words``: slot after slot, the words that the mix takes.

    Each source's documents are shuffled by a hash, laid end to end, and cut into blocks of ``block`` words; past its end a
    source starts anew (at most ``copies`` times), and its last block ends at its target. Slots and blocks meet on source
    and rank. Blocks grow once a mix has more than 2^30 of them, so that slot numbers stay within 64 bits when multiplied.

    Text null or without words: size 0, nothing taken. Source null: a source of its own, last in order. Null and repeated
    ids and rows: each row is a document of its own; equal rows lie in any order but have the same share. Other columns are
    ignored. Empty table: both results empty. Reruns agree: order comes from hashes of id and size only.
    """
    raw = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), text_key(F.col(text_col)).alias("text_key"))
    raw = settle(raw, "mix-sizes")
    goals = raw.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    n_docs = raw.count()
    goals = targets(goals.drop("n_docs"), weights, share, copies)
    planned = goals.agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("words")).first()["words"]
    block = max(block, -(-planned // 2**30))
    goals = goals.withColumn("blocks", F.expr(f"(quota + {block - 1}) div {block}"))
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    goals = settle(goals.withColumn("low", F.coalesce(F.sum("blocks").over(before), F.lit(0))).coalesce(1), "mix-goals")
    n_slots = goals.agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("n")).first()["n"]

    stretches = max(1, 4 * math.isqrt(n_docs))
    hashed = F.xxhash64(F.lit(seed), "doc_id", "size")
    rows = raw.join(goals.select("source", "number", "source_size", "target", "quota"), raw.source.eqNullSafe(goals.source)).drop(goals.source)
    rows = rows.withColumn("order", hashed).withColumn("stretch", F.expr(f"`order` div {2**63 // stretches + 1}") + F.when(F.col("order") < 0, -stretches).otherwise(0))
    rows = rows.withColumn("one", F.lit(1).cast("long")).withColumn("both", F.struct("size", "one"))
    line = ["order", F.col("doc_id"), "size", "text_key"]
    placed = _prefix(rows.drop("both"), ["number"], "stretch", line, "size", "start")
    within = Window.partitionBy("number", "stretch").orderBy(*line)
    placed = placed.withColumn("place", F.struct(F.col("stretch"), F.row_number().over(within).alias("row")))
    placed = settle(placed.select("doc_id", "size", "text_key", "source", "number", "source_size", "target", "quota", "start", "place"), "mix-placed")

    laps = F.explode(F.expr(f"sequence(0, {math.ceil(copies) - 1})"))
    pieces = placed.where("size > 0").select("number", "place", "size", "quota", "start", "source_size", laps.alias("pass"))
    pieces = pieces.withColumn("begin", F.expr("pass * source_size + start")).withColumn("end", F.expr("least(begin + size, quota)")).where("end > begin")
    pieces = pieces.withColumn("rank", F.explode(F.expr(f"sequence(begin div {block}, (end - 1) div {block})")))
    pieces = pieces.withColumn("first", F.expr(f"greatest(begin, rank * {block})")).withColumn("n_words", F.expr(f"least(end, (rank + 1) * {block}) - first"))
    pieces = pieces.select("number", "rank", "place", "pass", F.expr("first - begin").alias("from_word"), "n_words")
    mixture = pieces.join(slots(goals, max(1, n_slots)), ["number", "rank"])
    return placed.drop("quota"), mixture.select("slot", "number", "place", "pass", "from_word", "n_words")


def taken_words(documents: DataFrame, mixture: DataFrame) -> DataFrame:
    """Words of each document in the mixture, repeats counted."""
    taken = mixture.groupBy("number", "place").agg(F.sum("n_words").alias("taken"))
    rows = documents.join(taken, ["number", "place"], "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **parameters) -> DataFrame:
    """The mix as rows of ``docs``: one row for each time that a document is taken, with the words that the mix takes of it.

    A whole document keeps its text; where a source's share ends inside a document, the first words stay, joined by one space.
    Documents of no words are not taken. Rows that share an id are told apart by source and text; of rows that share all three any one
    stands for a place in the mix, and each is taken as often as its place says. Null ids are ids; other columns stay, whatever their names."""
    placed, mixture = mix(docs, id_col, text_col, source_col, **parameters)
    taken = mixture.groupBy("number", "place", "pass").agg(F.sum("n_words").alias("taken"))
    copies = Window.partitionBy("doc_id", "source", "text_key").orderBy("number", "place")
    places = placed.where("size > 0").withColumn("copy", F.row_number().over(copies)).join(taken, ["number", "place"])
    found = fresh(docs, "mix")
    places = places.select(F.struct("doc_id", "source", "text_key", "copy", "size", "taken").alias(found + "_place"))
    row, place = F.col(found), F.col(found + "_place")
    named = F.struct(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text_key(F.col(text_col)).alias("text_key"))
    rows = docs.where(word_count(F.col(text_col)) > 0).withColumn(found, named)
    copy = F.row_number().over(Window.partitionBy(found).orderBy(found))
    rows = rows.withColumn(found, F.struct(row["doc_id"].alias("doc_id"), row["source"].alias("source"), row["text_key"].alias("text_key"), copy.alias("copy")))
    same = [row[c].eqNullSafe(place[c]) for c in ("doc_id", "source")] + [row[c] == place[c] for c in ("text_key", "copy")]
    out = rows.join(places, reduce(lambda a, b: a & b, same))
    some = F.array_join(F.slice(F.filter(F.split(F.col(text_col), BLANKS), lambda w: w != ""), 1, place["taken"].cast("int")), " ")
    text = F.when(place["taken"] < place["size"], some).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).select(*docs.columns)


@query()
def op2_mix_sources(spark, sf_dir):
    return taken_words(*mix(table(spark, sf_dir, "documents")))
