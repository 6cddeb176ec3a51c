"""Substring dedup by recompression: rounds name runs and pairs of words, and shared names reveal long repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import pieces, query, table, text_bytes
from ticktalk.llm.ngram_join import word_hashes
from ticktalk.llm.repeats import LAST, Spans, U, covered, keyed, mix, repeated_spans, sliding_least
from ticktalk.session import settle

#: Words of a window, rounds of naming, and words that an anchor names.
WIDTH, ROUNDS, ANCHOR = 50, 2, 16


def recompressed(names: np.ndarray, doc: np.ndarray, rounds: int) -> np.ndarray:
    """Where symbols begin after the rounds. Names are hashes of what they stand for, so that all tasks agree on them.

    A round first names runs: the first two of equal neighbours become one symbol, the others stay as they are, and none of
    them changes again. Then pairs: a bit of each name makes it left or right, and a left symbol joins a right one that follows.
    Both look at neighbours only, so equal texts get equal symbols but for ends: at the front up to 3 words after one round,
    9 after two; at the back 2 and 6. Symbols have at most 2, then 4 words."""
    start, fixed = np.arange(len(names)), np.zeros(len(names), bool)
    for k in range(rounds):
        if len(names) < 2:
            break
        same = np.zeros(len(names) + 1, bool)  # equal to the next, at +1: equal to the one before
        same[1:-1] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1]) & ~fixed[1:] & ~fixed[:-1]
        before, after = same[:-1], same[1:]
        head = after & ~before
        second = np.zeros(len(names), bool)
        second[1:] = head[:-1]
        names = np.where(head, mix(names + U(0x51ED270B * (k + 1))), names)
        fixed |= before | after
        stay = ~second
        names, doc, start, fixed = names[stay], doc[stay], start[stay], fixed[stay]
        left = (mix(names ^ U(0xA0761D6478BD642F + k)) >> U(63)).astype(bool)
        join = np.zeros(len(names), bool)
        join[:-1] = left[:-1] & ~left[1:] & ~fixed[:-1] & ~fixed[1:] & (doc[1:] == doc[:-1])
        gone = np.zeros(len(names), bool)
        gone[1:] = join[:-1]
        nxt = np.append(names[1:], U(0))
        names = np.where(join, mix(names * U(0x9E3779B97F4A7C15) + mix(nxt) + U(k)), names)
        names, doc, start, fixed = names[~gone], doc[~gone], start[~gone], fixed[~gone]
    return start


def word_segments(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(text, anchor, first window, windows, two hashes, anchor's place) of each segment. A window's anchor is, among the symbols that begin
    where equal windows agree, the one whose next words have the smallest name."""
    front, back = 9, 6
    sizes = np.array([len(t) for t in texts], np.int64)
    at, words = word_hashes(b"\n".join(texts))
    doc = np.searchsorted(np.cumsum(sizes + 1), at, "right")
    reach = width - front - max(back, ANCHOR) + 1
    if len(words) < width:
        return (np.zeros(0, np.int64), np.zeros(0, U), *(np.zeros(0, np.int64),) * 2, *(np.zeros(0, U),) * 2, np.zeros(0, np.int64))
    spans = Spans(words)
    name = spans.every(ANCHOR)
    value = np.full(len(name), 2**64 - 1, U)
    start = recompressed(words, doc, ROUNDS)
    start = start[start < len(name)]
    value[start] = name[start] >> U(1)  # always below that of a place without a symbol
    window = np.arange(len(words) - width + 1)
    window = window[doc[window] == doc[window + width - 1]]
    if not len(window):
        return (np.zeros(0, np.int64), np.zeros(0, U), *(np.zeros(0, np.int64),) * 2, *(np.zeros(0, U),) * 2, np.zeros(0, np.int64))
    chosen = sliding_least(value, reach)[window + front]
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1))))
    lo, last = window[new], window[np.append(new[1:], len(window)) - 1]
    end, anchor = last + width, chosen[new]
    first = np.searchsorted(doc, doc[lo], "left")
    s1 = spans.hash(lo, end, 0) ^ mix((anchor - lo).astype(U))
    return doc[lo], name[anchor], lo - first, last - lo + 1, s1, spans.hash(lo, end, 1), anchor - first


def word_spans(text: bytes) -> Spans:
    return Spans(word_hashes(text)[1])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc, tid, spans``: word ranges of each text that are covered by windows of ``width`` words which start in a smaller id too."""
    return repeated_spans(keyed(docs, id_col, text_col), lambda texts: word_segments(texts, width), word_spans, width, earlier=True)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row; ``kept``: the words that stay, joined by one space.

    Words are split at ASCII blanks. A window is ``width`` words (40 or more) of one document; words covered by a window that also
    starts in a document of smaller id go, judged on the input. Windows are compared by 128-bit hashes of 64-bit word hashes.

    Null, empty and short texts: nothing to remove. Null ids count as larger than all others, and as one. Rows that repeat an id are
    one document to the rule. Other columns are ignored. Empty table: no rows."""
    if width < 40:
        raise ValueError("windows need 40 words or more")
    rows = keyed(docs, id_col, text_col)
    gone = settle(repeated_passages(docs, id_col, text_col, width).select(F.col("doc").alias("d"), F.col("tid").alias("t"), "spans"), "passages")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n, removed, kept = [], [], []
            for text, spans in zip(text_bytes(batch.column("text")), batch.column("spans").to_pylist()):
                words = text.split()
                n.append(len(words))
                if spans:
                    out = covered(spans, len(words))
                    words = [w for w, x in zip(words, out.tolist()) if not x]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    joined = rows.join(gone, (rows.doc == gone.d) & (rows.tid == gone.t), "left").select("doc", "text", "spans")
    out = joined.mapInArrow(drop, "doc_id long, n_words long, n_removed long, kept string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST)))


@query()
def op1_substring_dedup(spark, sf_dir):
    kept = remove_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
