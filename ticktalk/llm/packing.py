"""Packing of documents into sequences: linear grouping and configurations for large pieces, best fit for the rest."""

from __future__ import annotations

import os
import secrets
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticktalk.llm.common import pieces, query, table
from ticktalk.llm.encoders import StretchEncoder, byte_level, headed, in_worker, tokenizer_file
from ticktalk.session import settle

CAPACITY = 2048
END = 0  # id after each document
GROUPS = (128, 512)  # numbers of groups of equal cardinality; the plan with fewer sequences counts
SMALL = 8  # a piece of at most 1 / SMALL of a sequence is small
RANKED = 50_000  # rows of one length that are numbered in one task
TEXT_BYTES = 1_000_000


# --- Plan: from the number of pieces of each length, so never larger than the capacity allows, whatever the data ---


def equal_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, falling, in groups with equally many pieces, as (length, pieces). A length may lie in two groups; few lengths
    are groups of their own."""
    if len(counts) <= groups:
        return [[(length, counts[length])] for length in sorted(counts, reverse=True)]
    bound = -(-sum(counts.values()) // groups)
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append([])
                room = bound
            some = min(left, room)
            out[-1].append((length, some))
            left, room = left - some, room - some
    return out


def priced_configurations(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """For each size, as a column: how often to take every size so that they fit, it is among them, and their prices add up to the most."""
    worth, choice = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        offers = np.full((len(sizes), capacity + 1), -1.0)
        for k, size in enumerate(sizes.tolist()):
            offers[k, size:] = worth[: capacity + 1 - size] + prices[k]
        taken = offers.argmax(axis=0)
        better = offers[taken, np.arange(capacity + 1)]
        use = better > worth + 1e-12
        if not use.any():
            break
        choice.append(np.where(use, taken, -1))
        worth = np.where(use, better, worth)
    columns, room, each = np.eye(len(sizes)), capacity - sizes, np.arange(len(sizes))
    for taken in reversed(choice):
        k = taken[room]
        some = k >= 0
        np.add.at(columns, (k[some], each[some]), 1)
        room = np.where(some, room - sizes[k], room)
    return columns


def best_fit_configurations(sizes: np.ndarray, needed: np.ndarray, capacity: int) -> np.ndarray:
    """The configurations, as columns, of packing ``needed`` pieces of each size, falling, into the sequences with the least room."""
    open_: dict[int, list[list]] = {}
    done: list[np.ndarray] = []

    def put(k: int, size: int, amounts: np.ndarray, number: int, room: int, left: int) -> int:
        copies = room // size
        for some, times in ((left // copies, copies), (1, left % copies)):
            some = min(some, number)
            if some and times:
                filled = amounts.copy()
                filled[k] += times
                open_.setdefault(room - times * size, []).append([filled, some])
                number, left = number - some, left - some * times
        if number:
            open_.setdefault(room, []).append([amounts, number])
        return left

    for k, (size, left) in enumerate(zip(sizes.tolist(), needed.tolist())):
        for room in sorted(r for r in open_ if r >= size):
            for amounts, number in open_.pop(room):
                if left:
                    left = put(k, size, amounts, number, room, left)
                else:
                    open_.setdefault(room, []).append([amounts, number])
        if left:
            put(k, size, np.zeros(len(sizes), np.int64), -(-left // (capacity // size)), capacity, left)
    for spans in open_.values():
        done += [amounts for amounts, _ in spans]
    return np.unique(np.array(done, float), axis=0).T


def configurations(sizes: np.ndarray, needed: np.ndarray, capacity: int, gap: float = 2e-4) -> list[tuple[np.ndarray, int]]:
    """(amount of each size in a sequence, whole number of such sequences): the rounded-down solution of the linear programme that covers
    ``needed`` pieces of each size by the fewest sequences. ``sizes`` fall.

    Simplex steps go on among the configurations of a best-fit packing until none is better; then knapsacks price a new configuration for
    every size, until the dual bound is within ``gap``. The more sizes, the fewer rounds of knapsacks; each leaves a solution.
    """
    most = max(4, 150 * 128**2 // max(len(sizes), 128) ** 2)
    basis = np.diag((capacity // sizes).astype(float))
    columns = best_fit_configurations(sizes, needed, capacity)
    for _ in range(most):
        inverse = np.linalg.inv(basis)
        for _ in range(4 * len(sizes)):
            gains = inverse.sum(axis=0) @ columns
            best = int(gains.argmax())
            if gains[best] <= 1 + 1e-9:
                break
            uses, move = inverse @ needed, inverse @ columns[:, best]
            ratios = np.where(move > 1e-9, uses / np.where(move > 1e-9, move, 1), np.inf)
            out = int(ratios.argmin())
            if not np.isfinite(ratios[out]):
                break
            basis[:, out] = columns[:, best]
            row = inverse[out] / move[out]
            inverse -= np.outer(move, row)
            inverse[out] = row
        prices = np.maximum(np.linalg.inv(basis).sum(axis=0), 0)
        columns = priced_configurations(sizes, prices, capacity)
        value = float((prices @ columns).max())
        if value <= 1 + 1e-9 or (np.linalg.solve(basis, needed)).sum() * value <= (needed @ prices) * (1 + gap):
            break
    uses = np.floor(np.linalg.solve(basis, needed) + 1e-6).astype(np.int64)
    return [(basis[:, k].astype(np.int64), int(n)) for k, n in enumerate(uses) if n > 0]


class Plan:
    """Places of pieces by length and rank: entries ``length, first rank, pieces, first sequence, offset, copies``. An entry fills
    sequences one by one with ``copies`` pieces each from ``offset`` on."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS[0], small: int = SMALL):
        self.capacity, self.small, self.entries, self.sequences = capacity, small, [], 0
        self.left = {length: n for length, n in counts.items() if n}
        self.met = dict.fromkeys(self.left, 0)
        self.open: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, sequences)
        if capacity in self.left:
            self._put(capacity, self._new(self.left[capacity]), self.left[capacity], 0)
        pieces_left = None
        while large := {length: n for length, n in self.left.items() if length * small > capacity}:
            before, pieces_left = pieces_left, sum(large.values())
            # What rounding down left is grouped again, as long as that places half of it.
            if before is not None and 2 * pieces_left > before:
                break
            self._group(equal_groups(large, groups))
        for length in sorted(self.left, reverse=True):
            self._best_fit(length)

    def _new(self, number: int) -> int:
        self.sequences += number
        return self.sequences - number

    def _put(self, length: int, first: int, number: int, offset: int, copies: int = 1) -> None:
        if not number:
            return
        self.entries.append((length, self.met[length], number, first, offset, copies))
        self.met[length] += number
        self.left[length] -= number
        if not self.left[length]:
            del self.left[length]

    def _leave(self, first: int, number: int, room: int) -> None:
        if number and room:
            self.open.setdefault(room, []).append((first, number))

    def _group(self, groups: list[list[tuple[int, int]]]) -> None:
        """Round lengths up to the largest of their group, choose configurations, and put actual pieces in their places."""
        needed: dict[int, int] = {}
        for group in groups:
            needed[group[0][0]] = needed.get(group[0][0], 0) + sum(n for _, n in group)
        sizes = np.array(list(needed))
        for amounts, number in configurations(sizes, np.array(list(needed.values())), self.capacity):
            spans = [(self._new(number), number, 0)]
            slots = [size for size, amount in zip(sizes.tolist(), amounts.tolist()) for _ in range(amount)]
            for size in slots[:-1]:
                spans = self._fill(spans, size)
            for first, n, used in self._fill(spans, self.capacity):
                self._leave(first, n, self.capacity - used)

    def _fill(self, spans: list[tuple[int, int, int]], size: int) -> list[tuple[int, int, int]]:
        """For each sequence of ``spans`` (first, number, used) the longest large piece there is up to ``size`` that fits."""
        out = []
        for first, number, used in spans:
            while number:
                length = self._longest(min(size, self.capacity - used))
                if not length:
                    out.append((first, number, used))
                    break
                some = min(number, self.left[length])
                self._put(length, first, some, used)
                out.append((first, some, used + length))
                first, number = first + some, number - some
        return out

    def _longest(self, bound: int) -> int:
        """The longest large length up to ``bound`` that has pieces left, or 0."""
        for length in range(bound, self.capacity // self.small, -1):
            if length in self.left:
                return length
        return 0

    def _best_fit(self, length: int) -> None:
        """All pieces of a length into the sequences with the least room that take them, then into new ones."""
        for room in sorted(r for r in self.open if r >= length):
            spans = self.open.pop(room)
            while spans and length in self.left:
                first, number = spans.pop()
                first, number = self._copies(length, first, number, room)
                if number:
                    spans.append((first, number))
            if spans:
                self.open.setdefault(room, []).extend(spans)
            if length not in self.left:
                return
        while length in self.left:
            number = -(-self.left[length] // (self.capacity // length))
            self._copies(length, self._new(number), number, self.capacity)

    def _copies(self, length: int, first: int, number: int, room: int) -> tuple[int, int]:
        """Fill sequences with as many copies as their room takes; a last one may get fewer. What stays untouched is returned."""
        copies, offset, held = room // length, self.capacity - room, self.left[length]
        full = min(number, held // copies)
        self._put(length, first, full * copies, offset, copies)
        self._leave(first, full, room - copies * length)
        first, number = first + full, number - full
        if number and (rest := self.left.get(length, 0)):
            rest = min(rest, copies)
            self._put(length, first, rest, offset, rest)
            self._leave(first, 1, room - rest * length)
            first, number = first + 1, number - 1
        return first, number


# --- Rows: cutting, numbering and placing on Spark ---


def _cut(file: bytes, capacity: int, end: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = in_worker("packing", file, lambda: StretchEncoder(byte_level(file)[0]))
        for batch in pieces(batches, "text", TEXT_BYTES):
            ids, sizes = encoder.encode([text or "" for text in batch.column("text").to_pylist()], headed)[0]
            ids = np.insert(ids, np.cumsum(sizes), end).astype("<u4")
            sizes = sizes + 1
            number = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            first = sizes - capacity * (number - 1)
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[row], capacity)
            begin = ((np.cumsum(sizes) - sizes)[row] + start) * 4
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist())]
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            stamp = pa.array(np.full(len(row), secrets.randbits(62)), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "stamp", "row"]
            yield pa.RecordBatch.from_arrays([*columns, stamp, pa.array(np.arange(len(row)), pa.int64())], names)

    return rows


def _placed(entries: list[tuple[int, ...]]):
    """Rows with their rank within the length, to their places."""
    plan = np.array(sorted(entries), np.int64).reshape(-1, 6)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(rank), np.int64)
            for one in np.unique(length).tolist():
                low, high = np.searchsorted(plan[:, 0], [one, one + 1])
                mine = length == one
                at[mine] = low + np.searchsorted(plan[low:high, 1], rank[mine], side="right") - 1
            _, begun, _, first, offset, copies = plan[at].T
            turn, copy = np.divmod(rank - begun, copies)
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(first + turn, pa.int64()), pa.array(offset + copy * length, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return rows


def pack(
    docs: DataFrame,
    file: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    groups: tuple[int, ...] = GROUPS,
    ranked: int = RANKED,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: one row for each piece of each row of ``docs``.

    A document is the ids of its text (null: empty) and ``end``. One longer than ``capacity`` is cut into pieces of that length, the first
    of which may be shorter. Strings of special tokens inside texts are ordinary text.

    Large pieces: lengths are rounded up within groups of equal cardinality, a linear programme over these few lengths chooses
    configurations, actual pieces take their places, and what the rounding down of the programme leaves is grouped again. Of the numbers
    of groups in ``groups`` the one whose plan needs the fewest sequences is taken. The rest, and
    small pieces, go to the sequence with the least room that takes them.

    The driver sees how many pieces each length has, ``capacity`` numbers at most, and the plan it makes from them is as small. Pieces
    are numbered within their length, a frequent length in several tasks, and find their places by length and number.

    Null and repeated ids are kept, each row is a document; long texts are taken whole; other columns change nothing. Empty table: no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, stamp long, row long"
    parts = settle(texts.mapInArrow(_cut(file, capacity, end), schema), "packing")
    counts = {row["length"]: row["count"] for row in parts.groupBy("length").count().collect()}
    spark = docs.sparkSession
    tasks = spark.createDataFrame([(length, -(-n // ranked)) for length, n in counts.items()], "length long, tasks long")
    dealt = parts.join(F.broadcast(tasks), "length").withColumn("task", F.pmod(F.xxhash64("stamp", "row"), F.col("tasks")))
    numbered = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("length", "task").orderBy("stamp", "row")) - 1)
    held = dealt.groupBy("length", "task").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = held.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begun"))
    ranks = numbered.join(begun, ["length", "task"]).withColumn("rank", (F.col("rank") + F.col("begun")).cast("long"))
    plan = min((Plan(counts, capacity, number) for number in groups), key=lambda made: made.sequences)
    wanted = ranks.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return wanted.mapInArrow(_placed(plan.entries), out)


@query()
def op12_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
