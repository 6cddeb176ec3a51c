"""Suffix-array dedup: Burrows-Wheeler transforms of shards, merged by refining the interleave of their suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import pieces, query, table, text_bytes
from ticktalk.llm.repeats import LAST, Spans, U, covered, keyed, mix, repeated_spans, sliding_least
from ticktalk.session import settle

#: Bytes of a window; phrases begin at the least of GAP hashes of GRAM bytes; phrases by which suffixes are told apart; bytes
#: among which a window chooses its phrase, so that this and the phrases that follow depend on bytes of the window alone.
WIDTH, GAP, GRAM, DEPTH = 400, 32, 16, 4
REACH = WIDTH - (GAP - 1) - DEPTH * GAP - (GAP + GRAM - 1)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of a sequence that ends in a unique smallest symbol, in order, by prefix doubling."""
    _, rank = np.unique(symbols, return_inverse=True)
    step, n = 1, len(symbols)
    while rank.max() < n - 1:
        key = rank.astype(np.int64) * (n + 1)
        key[:-step] += rank[step:] + 1
        _, rank = np.unique(key, return_inverse=True)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def refined_blocks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Name of the block of each suffix when suffixes are told apart by ``depth`` symbols.

    The shard's transform holds, in suffix order, the symbol before each suffix. All suffixes begin in one block; one refinement
    sends each to the block of (symbol before it, its block) at the place that a stable sort of the transform gives.
    Names are hashes, so the blocks of all shards interleave by name, without sorting suffixes of different shards."""
    order = suffix_order(symbols)
    transform = symbols[order - 1]
    target = np.empty(len(order), np.int64)
    target[np.argsort(transform, kind="stable")] = np.arange(len(order))
    block = np.zeros(len(order), U)
    for _ in range(depth):
        refined = np.empty(len(order), U)
        refined[target] = mix(block * U(0x9E3779B97F4A7C15) + transform)
        block = refined
    out = np.empty(len(order), U)
    out[order] = block
    return out


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1342543DE82EF95))


def byte_segments(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(text, block, first window, windows, two hashes, phrase's place) of each segment. A text is cut into phrases at the bytes whose next
    GRAM bytes have the least hash among some GAP neighbours. A window chooses the phrase of least name among those that begin
    GAP - 1 bytes or more, and less than GAP - 1 + REACH, after its start. Its name is the phrase's block, and the bytes that all windows
    have which can choose it."""
    sizes = np.array([len(t) for t in texts], np.int64)
    empty = (np.zeros(0, np.int64), np.zeros(0, U), *(np.zeros(0, np.int64),) * 2, *(np.zeros(0, U),) * 2, np.zeros(0, np.int64))
    if not (sizes >= width).any():
        return empty
    long = np.flatnonzero(sizes >= width)
    data = np.frombuffer(b"".join(texts[i] for i in long), np.uint8)
    ends = np.cumsum(sizes[long])
    begins = ends - sizes[long]
    spans = Spans(_BYTE[data])
    value = spans.every(GRAM)
    least = sliding_least(value, GAP)
    inside = np.ones(len(least), bool)  # ranges that lie in one text
    for k in ends[:-1]:
        inside[max(0, k - GAP - GRAM + 2) : k] = False
    mark = np.zeros(len(data), bool)
    mark[least[inside]] = True
    cuts = np.flatnonzero(mark)
    owner = np.searchsorted(ends, cuts, "right")
    stop = np.append(cuts[1:], len(data))
    last = np.append(owner[1:] != owner[:-1], True)
    phrase = spans.hash(cuts, np.where(last, ends[owner], stop)) | U(2)
    # After each text's last phrase stands a mark that differs from any phrase; the shard ends in its smallest symbol.
    sequence = np.insert(phrase, np.flatnonzero(last) + 1, U(1))
    place = np.arange(len(cuts)) + owner
    block = refined_blocks(np.append(sequence, U(0)), DEPTH)[place]

    window = np.concatenate([np.arange(b, e - width + 1) for b, e in zip(begins, ends)])
    rank = np.full(len(data), 2**64 - 1, U)
    rank[cuts] = mix(phrase) >> U(1)
    chosen = np.searchsorted(cuts, sliding_least(rank, REACH)[window + GAP - 1])
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1))))
    lo, hi = window[new], window[np.append(new[1:], len(window)) - 1]
    at = chosen[new]
    text = np.searchsorted(ends, lo, "right")
    s1 = spans.hash(lo, hi + width, 0) ^ mix((cuts[at] - lo).astype(U))
    core = cuts[at] - (GAP - 1)
    name = mix(block[at]) ^ spans.hash(core, core + width - REACH + 1)
    return long[text], name, lo - begins[text], hi - lo + 1, s1, spans.hash(lo, hi + width, 1), cuts[at] - begins[text]


def byte_spans(text: bytes) -> Spans:
    return Spans(_BYTE[np.frombuffer(text, np.uint8)])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` for every row; ``spans``: byte ranges that go, ``kept``: the other bytes.

    A byte goes if it is covered by a string of ``width`` bytes (400 or more) that also starts at any other place of any text, the same
    one included; judged on the input. Strings are compared by 128-bit hashes.

    Null, empty and short texts: nothing to remove. Ids only name rows: null or repeated ones change nothing; of rows that are
    equal, all repeat each other. Other columns are ignored. Empty table: no rows."""
    if width < 400:
        raise ValueError("strings need 400 bytes or more")
    rows = keyed(docs, id_col, text_col)
    gone = repeated_spans(rows, lambda texts: byte_segments(texts, width), byte_spans, width, earlier=False)
    gone = settle(gone.select(F.col("doc").alias("d"), F.col("tid").alias("t"), "spans"), "repeats")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            n, removed, runs, kept = [], [], [], []
            for text, spans in zip(text_bytes(batch.column("text")), batch.column("spans").to_pylist()):
                n.append(len(text))
                if not spans:
                    removed.append(0), runs.append([]), kept.append(text)
                    continue
                out = covered(spans, len(text))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], out.astype(np.int8), [0]))))
                runs.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                removed.append(int(out.sum()))
                kept.append(np.frombuffer(text, np.uint8)[~out].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    joined = rows.join(gone, (rows.doc == gone.d) & (rows.tid == gone.t), "left").select("doc", "text", "spans")
    out = joined.mapInArrow(drop, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST)))


@query()
def op8_suffix_dedup(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
