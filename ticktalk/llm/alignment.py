"""Alignment of two tokenizers: the ends of their tokens are merged along independent pieces of equal work."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import pieces, query, table
from ticktalk.llm.encoders import StretchEncoder, byte_level, in_worker, sentence_pieces, tokenizer_file
from ticktalk.session import settle

STEPS = 64  # ends that one piece merges
TEXT_BYTES = 2_000_000  # text whose tokens are aligned at once, one document at least

_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def split_diagonals(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first ``d`` merged ends are of A, for each ``d`` in ``diagonals``: halving along all of them at once.
    Of equal ends that of A comes first."""
    low = np.maximum(0, diagonals - len(b_ends))
    high = np.minimum(diagonals, len(a_ends))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        other = np.minimum(np.maximum(diagonals - middle - 1, 0), max(len(b_ends) - 1, 0))
        taken = open_ & (a_ends[np.minimum(middle, len(a_ends) - 1)] <= b_ends[other])
        low = np.where(taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)
    return low


def merge_ends(a_ends: np.ndarray, b_ends: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge two ascending lists of token ends of the same bytes.

    Returns the links as places in A and in B, and the common cuts as counts of tokens of A and of B before them. Each piece
    starts where its diagonal is split and merges ``steps`` ends without looking at other pieces; here all pieces advance
    together, one end at a time. An interval between neighbouring ends lies in one token of A and one of B, so each is a link. A group
    that crosses pieces is stitched by the cuts on either side of it.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    total = n_a + n_b
    if not total:
        none = np.empty(0, np.int64)
        return none, none, none, none
    starts = np.arange(0, total, steps)
    i = split_diagonals(a_ends, b_ends, starts)
    j = starts - i
    beyond = np.int64(np.iinfo(np.int64).max)
    a, b = np.append(a_ends, beyond), np.append(b_ends, beyond)
    before = np.maximum(np.where(i > 0, a[i - 1], 0), np.where(j > 0, b[j - 1], 0))
    shape = (steps, len(starts))
    link_i, link_j = np.empty(shape, np.int64), np.empty(shape, np.int64)
    linked, cut = np.zeros(shape, bool), np.zeros(shape, bool)
    for step in range(steps):
        a_end, b_end = a[i], b[j]
        of_a = a_end <= b_end
        end = np.where(of_a, a_end, b_end)
        there = end < beyond
        link_i[step], link_j[step] = i, j
        linked[step] = there & (end > before)
        # The end of B that follows an equal end of A closes a group.
        cut[step] = there & ~of_a & (i > 0) & (a[i - 1] == end)
        i, j = i + (of_a & there), j + (~of_a & there)
        before = end
    keep, at = linked.T, cut.T
    return link_i.T[keep], link_j.T[keep], link_i.T[at], link_j.T[at] + 1


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, names: np.ndarray, bounds: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2`` for the groups between ``bounds``, which are numbers of groups. ``names`` holds each id with a comma, a bar
    and a semicolon after it, one list after the other."""
    step = len(names) // 3
    a_sizes, b_sizes = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    signs_a, signs_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    signs_a[cut_a - 1], signs_b[cut_b - 1] = 1, 2
    codes = np.empty(len(a_ids) + len(b_ids), np.int64)
    codes[np.arange(len(a_ids)) + np.repeat(cut_b - b_sizes, a_sizes)] = a_ids + step * signs_a
    codes[np.arange(len(b_ids)) + np.repeat(cut_a, b_sizes)] = b_ids + step * signs_b
    edges = np.append(0, cut_a + cut_b)[bounds]
    parts = names[codes].tolist()
    return ["".join(parts[x:y])[:-1] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]


class _Pair:
    """Both tokenizers of a Python worker."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode_a, self.a_bytes = byte_level(a_file)
        encode_b, self.b_bytes = sentence_pieces(b_file)
        self.encoder = StretchEncoder(encode_a, encode_b)
        self.a_table, self.b_table = np.array(self.a_bytes, object), np.array(self.b_bytes, object)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        ids = range(max(len(self.a_bytes), len(self.b_bytes)))
        self.names = np.array([f"{i}{sign}" for sign in ",|;" for i in ids], object)

    def tokens(self, texts: list[str]):
        """Ids of A and B of all texts end to end with the number in each text; texts that do not come back whole have none."""
        data = [text.encode() for text in texts]
        (a, n_a), (b, n_b) = self.encoder.encode(texts)
        whole = np.ones(len(texts), bool)
        if b"".join(self.a_table[a].tolist()) != b"".join(data) or b"".join(self.b_table[b].tolist()) != b"".join(data):
            for ids, sizes, names in ((a, n_a, self.a_table), (b, n_b, self.b_table)):
                edges = np.append(0, np.cumsum(sizes)).tolist()
                for k, text in enumerate(data):
                    whole[k] &= b"".join(names[ids[edges[k] : edges[k + 1]]].tolist()) == text
        elif ((self._span(self.a_sizes[a], n_a) != [len(x) for x in data]) | (self._span(self.b_sizes[b], n_b) != [len(x) for x in data])).any():
            raise AssertionError("a token crosses two texts")
        a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
        return a, np.where(whole, n_a, 0), b, np.where(whole, n_b, 0)

    @staticmethod
    def _span(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        upto = np.append(0, np.cumsum(sizes))
        return np.diff(upto[np.append(0, np.cumsum(counts))])


def _aligned(batch: pa.RecordBatch, pair: _Pair):
    """One row for each document, with the links as slots of a list of distinct id pairs; and that list."""
    texts = batch.column("text").to_pylist()
    there = [k for k, text in enumerate(texts) if text]
    a, some_a, b, some_b = pair.tokens([" " + texts[k] for k in there])
    n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    n_a[there], n_b[there] = some_a, some_b
    at_a, at_b, cut_a, cut_b = merge_ends(np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b]))

    of_token = np.repeat(np.arange(len(texts)), n_a)
    of_link = of_token[at_a]
    n_groups = np.bincount(of_token[cut_a - 1], minlength=len(texts))
    n_links = np.bincount(of_link, minlength=len(texts))
    named = group_texts(a, b, cut_a, cut_b, pair.names, np.append(0, np.cumsum(n_groups)))
    sha = [hashlib.sha256(text.encode()).hexdigest() if n else "" for text, n in zip(named, n_a.tolist())]

    code = a[at_a].astype(np.int64) << 32 | b[at_b]
    pairs, slots, totals = np.unique(code, return_inverse=True, return_counts=True)
    per_doc, times = np.unique(of_link * max(len(pairs), 1) + slots, return_counts=True)
    doc_of, slot = np.divmod(per_doc, max(len(pairs), 1))
    ends = np.append(0, np.cumsum(np.bincount(doc_of, minlength=len(texts))))
    docs = [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)], pa.array(sha, pa.string())]
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (slot, times)]
    return docs, lists, pairs, totals


def _layout(a_file: bytes, b_file: bytes, text_bytes: int):
    names = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "slots", "times", "pairs", "links"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = in_worker("alignment", a_file + b_file, lambda: _Pair(a_file, b_file))
        for batch in pieces(batches, "text", text_bytes):
            docs, lists, pairs, totals = _aligned(batch, pair)
            chunk, n = uuid.uuid4().hex, batch.num_rows
            none = pa.nulls(n, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * n), *docs, *lists, none, none], names)
            blank = [pa.nulls(1, column.type) for column in (*docs, *lists)]
            dictionary = [pa.array([x], pa.list_(pa.int64())) for x in (pairs, totals)]
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), *blank, *dictionary], names)

    return rows


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one chunk with the corpus-wide counts of its id pairs."""
    size = counts.num_rows
    place = counts.column("slot").to_numpy()
    count, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
    count[place], top[place] = counts.column("count").to_numpy(), counts.column("top").to_numpy()
    slots, times = (docs.column(c).combine_chunks() for c in ("slots", "times"))
    sizes = pa.compute.list_value_length(slots).to_numpy(zero_copy_only=False)
    slots, times = slots.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    edges = np.append(0, np.cumsum(sizes))

    def total(values: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(values))[edges])

    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    more = {"n_best": total(times * top[slots]), "count_sum": total(times * count[slots])}
    for name, values in more.items():
        kept = kept.append_column(name, pa.array(values, pa.int64()))
    return kept.append_column("groups_sha256", docs.column("groups_sha256"))


def align_tokenizers(
    docs: DataFrame, a_file: bytes, b_file: bytes, id_col: str = "doc_id", text_col: str = "text", text_bytes: int = TEXT_BYTES
) -> DataFrame:
    """Tokens of a byte-level BPE (A, over a space and the text) and of a piece model (B, which adds the space) that cover the same bytes.

    One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. Groups lie between byte offsets where
    tokens of both end; links are overlapping tokens of A and B; ``n_best`` counts the links whose id pair is, over all rows, the most
    frequent one of its B id, ties included; ``count_sum`` adds the frequencies of the links' pairs.

    Null and empty texts, and texts that either tokenizer changes, have zeros and an empty hash. Rows that repeat an id stay apart, and a
    null id is kept; long texts are taken whole; other columns change nothing. Empty table: no rows.

    A chunk of about ``text_bytes`` bytes of text is aligned at once. What leaves it are its distinct id pairs with their numbers of links,
    so a pair that is in every text is counted once per chunk, and texts are read and encoded once.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"chunk string, {_DOC}, slots array<int>, times array<int>, pairs array<long>, links array<long>"
    laid_out = settle(texts.mapInArrow(_layout(a_file, b_file, text_bytes), schema), "alignment")
    met = laid_out.where("pairs IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("pairs", "links")).alias("slot", "met"))
    met = met.select("chunk", "slot", F.col("met.pairs").alias("pair"), F.col("met.links").alias("links"))
    totals = met.groupBy("pair").agg(F.sum("links").alias("count"))
    totals = settle(totals.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "alignment-counts")
    highest = totals.groupBy("b").agg(F.max("count").alias("highest"))
    ranked = totals.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("top"))
    counts = met.join(ranked, "pair").select(F.col("chunk").alias("of_chunk"), "slot", "count", "top")
    rows = laid_out.where("pairs IS NULL").drop("pairs", "links")
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("chunk").cogroup(counts.groupBy("of_chunk")).applyInArrow(_scored, out)


@query()
def op11_cross_tokenizer(spark, sf_dir):
    files = [tokenizer_file(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokenizers(table(spark, sf_dir, "documents"), *files)
