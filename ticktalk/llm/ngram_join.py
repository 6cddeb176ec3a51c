"""N-gram Jaccard join: MinHash bands for a target recall, pairs verified on full n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import may_meet, pieces, query, table, text_bytes
from ticktalk.llm.exact_dedup import content_hash, squeezed
from ticktalk.llm.links import block_pairs, candidate_groups, components
from ticktalk.session import settle

#: Words of a gram, least similarity, share of the pairs at that similarity that meet in a band, hashes of a band.
N, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.999, 8
#: Texts and bytes of a block of a candidate group, and grams that are counted at once.
BLOCK, BLOCK_BYTES, GRAMS = 512, 1_000_000, 8192


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Number of bands of ``rows`` hashes at which a pair of this similarity shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of each word. Hashes are polynomials of the bytes, taken from prefix sums."""
    raw = np.frombuffer(data, np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    base = pow(0x9E3779B97F4A7C15, 1, 1 << 64)
    power = np.full(len(raw) + 1, base, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(len(raw) + 1, pow(base, -1, 1 << 64), np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)))
    return start, _mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def signatures(texts: list[bytes], n: int, bands: int, rows: int) -> list[np.ndarray | None]:
    """The band hashes of each text's word n-grams; a text of fewer words is one gram; a text without words has none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    start, word = word_hashes(b"\n".join(texts))
    ends = np.cumsum(sizes + 1)
    doc = np.searchsorted(ends, start, "right")
    count = np.bincount(doc, minlength=len(texts))
    begin = np.cumsum(count) - count
    gram = word.copy()
    for k in range(1, n):
        gram[: len(word) - k] = gram[: len(word) - k] * np.uint64(0x9E3779B97F4A7C15) + word[k:] if len(word) > k else gram[:0]
    grams, at = [], np.arange(len(word)) - begin[doc]
    whole = at + n <= count[doc]
    short = np.flatnonzero((count > 0) & (count < n))
    for d in short:  # the hash of all its words
        h = np.uint64(0)
        for w in word[begin[d] : begin[d] + count[d]]:
            h = np.uint64((int(h) * 0x9E3779B97F4A7C15 + int(w)) % (1 << 64))
        gram[begin[d]] = h
    whole[begin[short]] = True
    grams, owner = _mix(gram[whole]), doc[whole]
    out: list[np.ndarray | None] = [None] * len(texts)
    if not len(grams):
        return out
    first = np.flatnonzero(np.diff(np.concatenate(([-1], owner))))
    factors = _mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    keys = np.empty((len(first), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(first), b + 1, np.uint64)
        for r in range(rows):
            key = _mix(key * np.uint64(31) + np.minimum.reduceat(grams * factors[b * rows + r], first))
        keys[:, b] = key
    for row, d in zip(keys.view(np.int64), owner[first]):
        out[d] = row
    return out


def grams_of(text: str, n: int) -> set:
    words = text.split(" ")
    return set(zip(*(words[k:] for k in range(n)))) if len(words) >= n else {tuple(words)}


def linked_sets(sets: list[set], similarity: float, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(links of each set, first set of its chain of links). Two sets, with ``side`` two of different sides, are linked if their Jaccard
    similarity reaches ``similarity``. Common elements are counted exactly, by products of parts of the sets' incidence matrix."""
    names: dict = {}
    column = np.array([names.setdefault(g, len(names)) for x in sets for g in x], np.int64)
    size = np.array([len(x) for x in sets], np.float64)
    row = np.repeat(np.arange(len(sets)), size.astype(np.int64))
    shared = np.bincount(column) > 1
    row, column = row[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)))
    for start in range(0, int(shared.sum()), GRAMS):
        part = slice(*np.searchsorted(column, [start, start + GRAMS]))
        held = np.zeros((len(sets), min(GRAMS, int(shared.sum()) - start)), np.float32)
        held[row[part], column[part] - start] = 1
        common += held @ held.T
    links = common >= similarity * (size[:, None] + size[None, :] - common)
    np.fill_diagonal(links, False)
    if side is not None:
        links &= side[:, None] != side[None, :]
    first = np.arange(len(sets))
    while True:
        least = np.minimum(first, np.where(links, first[None, :], len(sets)).min(axis=1))
        least = least[least]
        if (least == first).all():
            return links.sum(axis=1), first
        first = least


def ngram_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS
) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies`` for every row: rows share a class if a chain of links joins their texts.

    Two different texts are linked if the Jaccard similarity of their sets of word ``n``-grams reaches ``similarity``. Texts with
    the same words are copies and stand as one from the start, so a group of copies adds one text. Candidates share one of the
    MinHash bands, as many as ``recall`` needs at the threshold. All texts that a chain of shared bands joins are compared with each other,
    on full sets, block by block (see ``block_pairs``): tasks return a row for each text of a pair of blocks, not for each pair.
    ``n_links``: the different texts that the text is linked to; ``n_copies``: rows with the same words. ``class_id``: smallest id of the class.

    Fewer than n words: all of them are one gram. Null, empty and blank texts: copies of each other, linked to nothing else. Null ids: rows
    get a class, whose id is null only if all its ids are. Repeated rows are copies. Other columns are ignored. Empty table: no rows."""
    bands = bands_for(similarity, recall, rows)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def named(some: DataFrame) -> DataFrame:
        return some.select("doc_id", F.trim(squeezed(F.col("text"))).alias("text")).withColumn("fp", content_hash(F.col("text")))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1_000_000):
            texts = text_bytes(batch.column("text"))
            found = signatures(texts, n, bands, rows)
            size = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fp"), size, pa.array(found, pa.list_(pa.int64()))], ["doc_id", "fp", "size", "bands"])

    signed = settle(named(plain).mapInArrow(sign, "doc_id long, fp binary, size long, bands array<long>"), "ngram-signatures")
    copies = signed.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    copies = settle(copies.withColumn("name", F.xxhash64("fp")), "ngram-copies")
    # Equal names of different texts could only join two groups, whose texts are compared then.
    groups = candidate_groups(copies.select(F.explode("bands").alias("key"), F.col("name").alias("id")))
    need = settle(groups.withColumnRenamed("id", "name").join(copies.select("name", "fp", "rep", "size"), "name").select("fp", "rep", "size", "root"), "ngram-need")
    placed = settle(block_pairs(need, BLOCK, BLOCK_BYTES).withColumnRenamed("fp", "need"), "ngram-blocks")
    some = named(may_meet(plain, need.withColumnRenamed("rep", "doc_id"), F.col("doc_id")))
    texts = some.join(placed, (some.fp == placed.need) & some.doc_id.eqNullSafe(placed.rep)).select("fp", "text", "root", "part", F.explode("pairs").alias("pair"))
    texts = texts.select("fp", "text", "root", "part", "pair.low", "pair.high")

    def judge(group: dict[bytes, tuple[int, str]], across: bool) -> pa.RecordBatch:
        names = list(group)
        side = np.array([part for part, _ in group.values()]) if across else None
        links, first = linked_sets([grams_of(text, n) for _, text in group.values()], similarity, side)
        met = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array([names[i] for i in met], pa.binary()), pa.array([names[i] for i in first[met]], pa.binary()), pa.array(links[met], pa.int64())], ["a", "b", "n"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, group = [None, 0, 0], {}
        for batch in batches:
            for fp, text, part, *key in zip(*(batch.column(c).to_pylist() for c in ("fp", "text", "part", "root", "low", "high"))):
                if key != last:
                    if group:
                        yield judge(group, last[1] != last[2])
                    last, group = key, {}
                group[fp] = part, text
        if group:
            yield judge(group, last[1] != last[2])

    pair = ["root", "low", "high"]
    links = settle(texts.repartition(*pair).sortWithinPartitions(*pair).mapInArrow(compare, "a binary, b binary, n long"), "ngram-links")
    degree = links.groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("n_links"))
    roots = components(links.select("a", "b")).select(F.col("id").alias("fp"), "root")
    texts = copies.select("fp", "rep", "n_copies").join(roots, "fp", "left").join(degree, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    texts = settle(texts, "ngram-rooted")
    classes = settle(texts.groupBy("root").agg(F.min("rep").alias("class_id")), "ngram-classes")
    labelled = settle(texts.join(classes, "root").select("fp", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies"), "ngram-labels")
    return signed.select("doc_id", "fp").join(labelled, "fp").select("doc_id", "class_id", "n_links", "n_copies")


@query()
def op4_ngram_join(spark, sf_dir):
    return ngram_classes(table(spark, sf_dir, "documents"))
