"""Quality rules by repetition coverage: characters inside repeated n-grams and lines, by rolling hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import pieces, query, table, text_bytes

#: Most of a text's word characters that may lie in n-grams found twice or more, by n: the published limits for web text.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Most of a text's characters in lines, and of its lines, that may repeat an earlier line: the published limits.
LINE_CHARS_LIMIT, LINES_LIMIT = 0.20, 0.30
#: Words in repeated n-grams, and repeats of lines, that a text may have at LENIENCE (lines: LINES_LENIENCE) above these limits: what
#: one line of 15 words makes that it repeats once, a large share of a short text only. From 300 words on, the limits on n-grams
#: hold as they are.
SPARED_WORDS, SPARED_LINES, LENIENCE, LINES_LENIENCE = 30, 1, 0.10, 0.20
MIN_WORDS, BASE_REPEATS = 10, 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_windows(hashes: np.ndarray, ids: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Which n-word windows occur twice or more in their own document. ``hashes`` are those of the windows, each mixed with
    its document; windows that cross documents must not be looked at. Equal hashes are compared word by word."""
    inside = np.flatnonzero(doc[: len(hashes)] == doc[n - 1 :])
    order = inside[np.argsort(hashes[inside])]
    same = hashes[order[1:]] == hashes[order[:-1]]
    left, right = order[:-1][same], order[1:][same]
    true = doc[left] == doc[right]
    for k in range(n):
        true &= ids[left + k] == ids[right + k]
    found = np.zeros(len(hashes), bool)
    if true.all():
        found[left] = found[right] = True
    else:  # two different windows share a hash: number the windows exactly
        rows = np.stack([doc[inside], *(ids[inside + k] for k in range(n))], 1)
        _, number, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        found[inside[count[number.ravel()] > 1]] = True
    return found


def measure(texts: list[bytes], lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts of each text. ``chars_n``: word characters inside n-grams found twice or more in the text."""
    sizes = np.array([len(x) for x in texts], np.int64)
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    blank = _BLANK[data]
    first = (data & 0xC0) != 0x80

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[ends] - sums[starts]

    begins = ~blank
    begins[1:] &= blank[:-1]
    chars = np.concatenate(([0], np.cumsum(first & ~blank, dtype=np.int64)))
    at = np.flatnonzero(begins)
    doc = np.searchsorted(ends, at, "right")
    upto = np.append(chars[at], chars[-1])
    length = np.diff(upto)
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in joined.split()), np.int64, len(at))
    words = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    out = {"n_words": words, "word_chars": total(first & ~blank), "n_symbols": total(_SYMBOL[data])}

    word_hash, salt = _scramble(ids.astype(np.uint64) + np.uint64(1)), _scramble(doc.astype(np.uint64) * _BASE + np.uint64(7))
    rolling = word_hash.copy()
    for n in range(2, max(lengths) + 1):
        if len(ids) < n:
            rolling = rolling[:0]
        else:
            rolling = rolling[: len(ids) - n + 1] * _BASE + word_hash[n - 1 :]
        if n not in lengths:
            continue
        covered = np.zeros(len(ids) + 1, np.int64)
        if len(rolling):
            hit = np.flatnonzero(repeated_windows(rolling ^ salt[: len(rolling)], ids, doc, n))
            np.add.at(covered, hit, 1)
            np.subtract.at(covered, hit + n, 1)
        inside = np.cumsum(covered)[:-1] > 0
        out[f"words_{n}"] = np.bincount(doc[inside], minlength=len(texts)).astype(np.int64)
        out[f"chars_{n}"] = np.bincount(doc[inside], weights=length[inside], minlength=len(texts)).astype(np.int64)

    lines, again, line_chars, again_chars = [], [], [], []
    for text in texts:
        seen: set[bytes] = set()
        n = dup = size = dup_size = 0
        for line in text.split(b"\n"):
            if not line.strip():
                continue
            n += 1
            size += len(line)
            if line in seen:
                dup += 1
                dup_size += len(line)
            else:
                seen.add(line)
        lines.append(n), again.append(dup), line_chars.append(size), again_chars.append(dup_size)
    return out | {"n_lines": np.array(lines, np.int64), "n_dup_lines": np.array(again, np.int64), "line_bytes": np.array(line_chars, np.int64), "dup_line_bytes": np.array(again_chars, np.int64)}


def _rows(batches: Iterator[pa.RecordBatch], limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    lengths = tuple(NGRAM_LIMITS)
    for batch in pieces(batches, "text", limit):
        m = measure(text_bytes(batch.column("text")), lengths)
        repeats = m[f"words_{BASE_REPEATS}"]
        failed = (m["n_words"] < MIN_WORDS) | (100 * repeats > 20 * m["n_words"])
        few = m["n_dup_lines"] <= SPARED_LINES
        bad = (m["dup_line_bytes"] > (LINE_CHARS_LIMIT + LENIENCE * few) * m["line_bytes"]) | (m["n_dup_lines"] > (LINES_LIMIT + LINES_LENIENCE * few) * m["n_lines"])
        for n, share in NGRAM_LIMITS.items():
            bad |= m[f"chars_{n}"] > (share + LENIENCE * (m[f"words_{n}"] <= SPARED_WORDS)) * m["word_chars"]
        out = {k: m[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines")} | {"n_repeat_words": repeats, "base_failed": failed, "kept": ~(failed | bad)}
        out |= {f"chars_{n}": m[f"chars_{n}"] for n in lengths} | {"dup_line_bytes": m["dup_line_bytes"]}
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out.values())], ["doc_id", *out])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the base counts, characters in repeated n-grams by n, bytes in repeated lines, and
    ``kept``, false if the base rules or one of the limits on repetition fail.

    One narrow pass; a task holds about 2 MB of texts besides Spark's Arrow batch, or one text. Null and empty texts have no
    words and fail the base rule. Rows are judged alone, so repeated rows and ids repeat their result. Other columns are
    ignored. Empty table: no rows.
    """
    counts = ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    more = ", ".join(f"chars_{n} long" for n in NGRAM_LIMITS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_rows, f"doc_id long, {counts}, base_failed boolean, kept boolean, {more}, dup_line_bytes long")


def keep_clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``quality`` keeps, with all their columns, judged and passed on in one narrow pass."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # names of other columns may clash
    text = F.col(text_col).cast("string").alias("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            judged = next(_rows(iter([pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], ["doc_id", "text"])]), limit=2**62))
            yield batch.select(names).filter(judged.column("kept"))

    kinds = ", ".join(f"{n} {k}" for n, (_, k) in zip(names, docs.dtypes))
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], text).mapInArrow(rows, kinds).toDF(*docs.columns)


@query()
def op10_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"))
