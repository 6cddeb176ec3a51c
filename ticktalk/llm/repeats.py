"""Long repeats from anchored segments: shared by the two operators that remove repeated substrings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import pieces, text_bytes
from ticktalk.session import discard, scratch_path, settle

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: Windows whose name's place in them differs by less than so many are compared as one, before single windows are.
STEP = 16
#: Ids that are null come after all others.
LAST = 2**63 - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Spans:
    """Hashes of spans of a sequence of 64-bit units, by prefix sums of a polynomial; two bases give 128 bits."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, units: np.ndarray):
        self.n, self.sums = len(units), []
        for base in BASES:
            power, _ = self.power(base, self.n + 1)
            self.sums.append(np.concatenate((np.zeros(1, U), np.cumsum(units * power[: self.n], dtype=U))))

    @classmethod
    def power(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in cls.powers or len(cls.powers[base][0]) < n:
            up, down = np.full(n, base, U), np.full(n, pow(base, -1, 1 << 64), U)
            up[0] = down[0] = 1
            cls.powers[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls.powers[base]

    def hash(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        _, down = self.power(BASES[which], self.n + 1)
        return mix((self.sums[which][end] - self.sums[which][start]) * down[start] + (end - start).astype(U))

    def every(self, width: int) -> np.ndarray:
        """Hash of the span of ``width`` units at each position that has one."""
        _, down = self.power(BASES[0], self.n + 1)
        m = self.n - width + 1
        return mix((self.sums[0][width:] - self.sums[0][:m]) * down[:m]) if m > 0 else np.zeros(0, U)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value (rightmost of equal ones) among ``width`` from each position."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] <= values[left], right, left)
        size += step
    return at


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, tid, text``: id (null last), hash of the text that tells rows of one id apart, text (null as empty)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("tid"), text.alias("text"))


def repeated_spans(
    rows: DataFrame, segments: Callable[[list[bytes]], tuple[np.ndarray, ...]], hashes: Callable[[bytes], Spans], width: int, earlier: bool
) -> DataFrame:
    """``doc, tid, spans``: parts (start, end) in units of each text that lie in windows of ``width`` units which also start in a smaller id
    (``earlier``), or anywhere else (else).

    ``segments`` names each text's windows: equal windows have equal names (``anchor``), and consecutive windows of one name are
    one segment, with a 128-bit hash of all that they cover. First names that occur once are dropped. A segment that occurs
    again as a whole is decided at once. Only where segments of one name differ, parts of one copy of each are compared in the same
    way, and single windows only where parts differ that share what all their windows have in common.
    Groups are folded by task before any shuffle, so thousands of copies send one row per task and segment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            at, anchor, lo, n, s1, s2, mid = segments(text_bytes(batch.column("text")))
            take = pa.array(at, pa.int64())
            arrays = [batch.column("doc").take(take), batch.column("tid").take(take), pa.array(anchor.view(np.int64)), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(mid.astype(np.int32)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc", "tid", "anchor", "lo", "n", "mid", "s1", "s2"])

    path = scratch_path(rows.sparkSession, "segments")
    found = settle(rows.mapInArrow(cut, "doc long, tid long, anchor long, lo int, n int, mid int, s1 long, s2 long"), path=path)
    if earlier:
        shared = found.groupBy("anchor").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x < y")
    else:
        shared = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("x")).where("x > 1")
    shared = settle(shared.select("anchor"), "segment-names")
    found = settle(found.join(shared, "anchor"), "segments-shared")
    discard(rows.sparkSession, path)
    name = ["anchor", "s1", "s2"]
    place = F.struct("doc", "tid", "lo")
    kinds = settle(found.groupBy(*name).agg(F.min(place).alias("rep"), F.count(F.lit(1)).alias("times")), "segment-kinds")
    mixed = settle(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor", F.lit(True).alias("mixed")), "segments-mixed")
    judged = settle(found.join(kinds, name).join(mixed, "anchor", "left"), "segments-judged")
    again = F.col("rep.doc") < F.col("doc") if earlier else F.col("times") > 1
    whole = judged.where(again).select("doc", "tid", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + width).alias("end"))
    one = F.col("rep.doc") == F.col("doc") if earlier else F.col("rep") == place
    asked = judged.where(one & F.col("mixed")).groupBy(F.col("doc").alias("d"), F.col("tid").alias("t")).agg(F.collect_set(F.struct("lo", "n", "mid")).alias("asked"))
    asked = settle(asked, "segments-asked")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            docs, tids = batch.column("doc").to_pylist(), batch.column("tid").to_pylist()
            for doc, tid, text, asked_parts in zip(docs, tids, text_bytes(batch.column("text")), batch.column("asked").to_pylist()):
                spans = hashes(text)
                lo, mid = (np.concatenate([np.arange(p["lo"], p["lo"] + p["n"]) if k else np.full(p["n"], p["mid"]) for p in asked_parts]) for k in (1, 0))
                lo, at = np.unique(lo, return_index=True)
                mid = mid[at]
                cell = (mid - lo) // STEP
                new = np.flatnonzero(np.concatenate(([True], (lo[1:] != lo[:-1] + 1) | (mid[1:] != mid[:-1]) | (cell[1:] != cell[:-1]))))
                end = np.append(new[1:], len(lo))
                core = mid[new] - cell[new] * STEP  # all windows of the cell hold what lies from here to width - STEP + 1 later
                names = spans.hash(core, core - STEP + 1 + width) ^ mix(cell[new].astype(U))
                s1 = spans.hash(lo[new], lo[end - 1] + width, 0) ^ mix((mid[new] - lo[new]).astype(U))
                s2 = spans.hash(lo[new], lo[end - 1] + width, 1)
                singles = pa.ListArray.from_arrays(pa.array(np.append(new, len(lo)).astype(np.int32)), pa.array(spans.hash(lo, lo + width, 1).view(np.int64)))
                m = len(new)
                arrays = [pa.array(np.full(m, doc)), pa.array(np.full(m, tid)), pa.array(names.view(np.int64)), pa.array(lo[new].astype(np.int32)), pa.array((end - new).astype(np.int32)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), singles]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "tid", "core", "lo", "n", "s1", "s2", "windows"])

    texts = rows.join(asked, (rows.doc == asked.d) & (rows.tid == asked.t)).select("doc", "tid", "text", "asked")
    part = settle(texts.mapInArrow(parts, "doc long, tid long, core long, lo int, n int, s1 long, s2 long, windows array<long>"), "parts")
    # Parts of one core: those that occur again as a whole are decided; windows of the others are compared within the core.
    named = part.groupBy("core", "s1", "s2").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("times"))
    named = settle(named, "part-kinds")
    differ = settle(named.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("core", F.lit(True).alias("differ")), "parts-differ")
    seen = settle(part.join(named, ["core", "s1", "s2"]).join(differ, "core", "left").where("differ OR times > 1"), "parts-judged")
    again = F.col("first") < F.col("doc") if earlier else F.col("times") > 1
    joint = seen.where(again).select("doc", "tid", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + width).alias("end"))
    open_ = seen.where("differ").select("doc", "tid", "core", "lo", F.posexplode("windows").alias("k", "w"))
    single = settle(open_.select("doc", "tid", "core", "w", (F.col("lo") + F.col("k")).alias("start")), "windows")
    if earlier:
        first = single.groupBy("core", "w").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x < y")
        hit = single.join(settle(first, "windows-first"), ["core", "w"]).where("x < doc")
    else:
        first = single.groupBy("core", "w").agg(F.count(F.lit(1)).alias("x")).where("x > 1")
        hit = single.join(settle(first, "windows-first"), ["core", "w"])
    spans = whole.union(joint).union(hit.select("doc", "tid", "start", (F.col("start") + width).alias("end")))
    return spans.groupBy("doc", "tid").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def covered(spans: list[dict], n: int) -> np.ndarray:
    """Which of n units lie in the spans."""
    steps = np.zeros(n + 1, np.int64)
    for s in spans:
        steps[s["start"]] += 1
        steps[s["end"]] -= 1
    return np.cumsum(steps[:-1]) > 0
