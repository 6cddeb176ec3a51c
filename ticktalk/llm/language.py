"""Language ID by unigrams over a public vocabulary's pieces, summed over all segmentations of each word."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.byte_bpe import public_ranks, read_ranks
from ticktalk.llm.common import pieces, query, table

#: Pieces of the vocabulary that are used have at most so many bytes, so that one fits a 64-bit key.
LONGEST = 8
WORD = re.compile(r"[^\W\d_]+")


class Pieces:
    """The vocabulary's pieces by length, found by binary search."""

    def __init__(self, rank_file: bytes):
        keys: dict[int, list[int]] = {k: [] for k in range(1, LONGEST + 1)}
        for piece in read_ranks(rank_file):
            if len(piece) <= LONGEST:
                keys[len(piece)].append(int.from_bytes(piece, "big"))
        self.keys, self.first, n = {}, {}, 0
        for k, found in keys.items():
            self.keys[k], self.first[k] = np.array(sorted(found), np.uint64), n
            n += len(found)
        self.size = n

    def spans(self, words: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """``words``: byte rows of one length. For each end, the (begin, rows, piece numbers) of the pieces that end there."""
        n = words.shape[1]
        out: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        for end in range(1, n + 1):
            key, found = np.zeros(len(words), np.uint64), []
            for k in range(1, min(LONGEST, end) + 1):
                key = key | (words[:, end - k].astype(np.uint64) << np.uint64(8 * (k - 1)))
                at = np.minimum(np.searchsorted(self.keys[k], key), len(self.keys[k]) - 1)
                rows = np.flatnonzero(self.keys[k][at] == key)
                if len(rows):
                    found.append((end - k, rows, at[rows] + self.first[k]))
            out.append(found)
        return out


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, byte rows) of words of equal length. A word begins with a blank, as pieces inside a text do."""
    groups: dict[int, list[int]] = {}
    data = [b" " + w.encode() for w in words]
    for i, w in enumerate(data):
        groups.setdefault(len(w), []).append(i)
    for n, at in groups.items():
        step = max(1, 400_000 // n)
        for k in range(0, len(at), step):
            part = at[k : k + step]
            yield np.array(part), np.frombuffer(b"".join(data[i] for i in part), np.uint8).reshape(len(part), n)


def log_likelihoods(words: list[str], vocabulary: Pieces, probability: np.ndarray) -> np.ndarray:
    """log P(word | language), all segmentations summed by the forward algorithm. ``probability``: pieces x languages."""
    out = np.empty((len(words), probability.shape[1]))
    for at, rows in by_length(words):
        n = rows.shape[1]
        forward: dict[int, np.ndarray] = {0: np.ones((len(at), probability.shape[1]))}
        log = np.zeros(out[at].shape)
        for end, found in enumerate(vocabulary.spans(rows), 1):
            total = np.zeros_like(log)
            for begin, some, piece in found:
                total[some] += forward[begin][some] * probability[piece]
            forward[end] = total
            forward.pop(end - LONGEST, None)
            if end % 16 == 0 and end < n:  # keep long words within the range of doubles
                scale = total.copy()
                log += np.log(scale)
                for f in forward:
                    forward[f] = forward[f] / scale
        out[at] = log + np.log(forward[n])
    return out


def expected_counts(words: list[str], times: np.ndarray, vocabulary: Pieces, probability: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece (one language), by forward and backward sums over the segmentations."""
    out = np.zeros(vocabulary.size)
    for at, rows in by_length(words):
        n, spans = rows.shape[1], vocabulary.spans(rows)
        forward, backward = np.zeros((n + 1, len(at))), np.zeros((n + 1, len(at)))
        forward[0] = backward[n] = 1
        scale = np.ones((n + 1, len(at)))
        for end in range(1, n + 1):
            for begin, some, piece in spans[end - 1]:
                factor = np.ones(len(some))
                for k in range(begin + 1, end):
                    factor /= scale[k, some]
                forward[end, some] += forward[begin, some] * probability[piece] * factor
            scale[end] = forward[end]
            forward[end] = 1
        for end in range(n, 0, -1):
            for begin, some, piece in spans[end - 1]:
                factor = np.ones(len(some))
                for k in range(begin + 1, end + 1):
                    factor /= scale[k, some]
                use = probability[piece] * factor * backward[end, some]
                backward[begin, some] += use
                np.add.at(out, piece, use * times[at[some]])
    return out


def train(rows: DataFrame, rank_file: bytes, docs_per_language: int = 2000, rounds: int = 3, smoothing: float = 0.05) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, priors, pieces x languages) from rows ``doc_id, text, lang``.

    Fits on a bounded sample: about ``docs_per_language`` rows of each language, by a hash of the id. Priors come from all
    rows. Word counts are summed in Spark; each round sums expected counts per piece in tasks, and the driver sees one row
    per piece and language, which the vocabulary bounds."""
    count = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(count)
    if not names:
        return [], np.zeros(0), np.zeros((0, 0))
    share = F.create_map(*[F.lit(x) for k in names for x in (k, min(1.0, docs_per_language / count[k]))])
    sample = rows.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)

    def words(batches):
        for batch in pieces(batches, "text"):
            totals: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                totals.setdefault(lang, Counter()).update(WORD.findall((text or "").lower()))
            flat = [(k, w, n) for k, c in totals.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    counted = sample.select("text", "lang").mapInArrow(words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).cache()
    size = Pieces(rank_file).size
    probability = np.full((size, len(names)), 1.0 / size)
    for _ in range(rounds):

        def expect(batches, given=probability):
            vocabulary = Pieces(rank_file)
            total = np.zeros((vocabulary.size, len(names)))
            for batch in batches:
                langs, found = np.array(batch.column("lang").to_pylist()), batch.column("word").to_pylist()
                times = np.array(batch.column("n").to_pylist(), float)
                for k, name in enumerate(names):
                    at = np.flatnonzero(langs == name) if len(langs) else []
                    if len(at):
                        total[:, k] += expected_counts([found[i] for i in at], times[at], vocabulary, given[:, k])
            p, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(k, pa.int64()), pa.array(total[p, k])], ["piece", "k", "n"])

        sums = counted.mapInArrow(expect, "piece long, k long, n double").groupBy("piece", "k").agg(F.sum("n").alias("n")).toPandas()
        total = np.full((size, len(names)), smoothing)
        total[sums.piece, sums.k] += sums.n
        probability = total / total.sum(0)
    counted.unpersist()
    prior = np.array([count[n] for n in names], float)
    return names, prior / prior.sum(), probability


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], rank_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score``: the most probable language of each whole text and its posterior.

    One narrow pass; the model (pieces x languages) travels with the tasks. Scores of words are kept while they are few
    enough. Text null or without letter: ``und``, score 0; so is every text if nothing was learned. Ties: the first language by name.
    Ids play no part, so null or repeated ids and rows change nothing; other columns are ignored. Empty table: no rows."""
    names, prior, probability = model

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, number, table_ = Pieces(rank_file), {}, np.zeros((0, len(names)))
        for batch in pieces(batches, "text"):
            counts = [Counter(WORD.findall((t or "").lower())) for t in batch.column("text").to_pylist()]
            if len(number) > 300_000:
                number, table_ = {}, np.zeros((0, len(names)))
            new = list({w for c in counts for w in c if w not in number})
            if new and names:
                number.update(zip(new, range(len(number), len(number) + len(new))))
                table_ = np.concatenate((table_, log_likelihoods(new, vocabulary, probability).astype(np.float32)))
            langs, scores = [], []
            for c in counts:
                if not names or not any(x.isalpha() for w in c for x in w):
                    langs.append("und"), scores.append(0.0)
                    continue
                at = np.fromiter(map(number.__getitem__, c), np.int64, len(c))
                total = np.log(prior) + np.fromiter(c.values(), float, len(c)) @ table_[at].astype(float)
                best = int(np.argmax(total))
                langs.append(names[best]), scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(rows, "doc_id long, lang_pred string, score double")


def held_out(doc_id) -> F.Column:
    """The fold that nothing is learned from. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query()
def op7_language(spark, sf_dir):
    docs, ranks = table(spark, sf_dir, "documents"), public_ranks("byte_bpe_multi_50k.tiktoken")
    model = train(docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()), ranks)
    return predict(docs, model, ranks).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
