"""Byte-level BPE: token boundaries by a scan over transition functions, merges cached per piece, and decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import pieces, query, table

# Classes of code points: letters that can end a contraction apart, other letters, numbers, apostrophe, other signs, space,
# other white space.
LETTER, SINGLE, R, V, L, E, NUMBER, QUOTE, SIGN, SPACE, BLANK = range(11)
# States: what the token that holds the last code point is. OPEN: an apostrophe that began a token; OPEN_RV, OPEN_L: it and
# r or v, it and l; CLOSED: a whole contraction.
WORD, DIGITS, SIGNS, AFTER_SPACE, BLANKS_, OPEN, OPEN_RV, OPEN_L, CLOSED = range(9)
#: White space by Unicode; letters that follow an apostrophe in a contraction.
WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = {"s": SINGLE, "t": SINGLE, "m": SINGLE, "d": SINGLE, "r": R, "v": V, "l": L, "e": E}


def class_table() -> np.ndarray:
    """Class of each code point."""
    kind = np.full(0x110000, SIGN, np.uint8)
    for code in range(0x110000):
        first = unicodedata.category(chr(code))[0]
        if first == "L":
            kind[code] = LETTER
        elif first == "N":
            kind[code] = NUMBER
    kind[list(WHITE)] = BLANK
    kind[0x20], kind[0x27] = SPACE, QUOTE
    for letter, name in CONTRACTIONS.items():
        kind[ord(letter)] = name
    return kind


def _step(state: int, kind: int) -> int:
    letter = kind in (LETTER, SINGLE, R, V, L, E)
    if state == OPEN and letter:
        return {SINGLE: CLOSED, R: OPEN_RV, V: OPEN_RV, L: OPEN_L}.get(kind, WORD)
    if state == OPEN_RV and kind == E or state == OPEN_L and kind == L:
        return CLOSED
    if letter:
        return WORD
    if kind == NUMBER:
        return DIGITS
    if kind == SPACE:
        return AFTER_SPACE
    if kind == BLANK:
        return BLANKS_
    if kind == QUOTE and state not in (SIGNS, AFTER_SPACE, OPEN):
        return OPEN
    return SIGNS


def transition_monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The functions that strings of classes can be: number of each class's function, table of compositions (first, then),
    and state that each function leads to from the start of a text."""
    functions = [tuple(_step(s, k) for s in range(9)) for k in range(11)]
    number = {f: i for i, f in reversed(list(enumerate(functions)))}
    known = list(functions)
    for f in known:  # grows until closed under composition
        for g in functions:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(known)
                known.append(h)
    compose = np.array([[number[tuple(g[s] for s in f)] for g in known] for f in known], np.uint16)
    return np.array([number[f] for f in functions], np.uint16), compose, np.array([f[BLANKS_] for f in known], np.uint8)


def scan(functions: np.ndarray, compose: np.ndarray, width: int = 64) -> np.ndarray:
    """Prefix compositions. Rows of ``width`` are scanned side by side, then the rows' totals, then both are composed."""
    n = len(functions)
    if n <= width:
        out = functions.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], functions[i]]
        return out
    whole = n // width
    size = np.uint32(len(compose))
    flat = compose.ravel()
    block = np.ascontiguousarray(functions[: whole * width].reshape(whole, width).T)
    for i in range(1, width):
        block[i] = flat[block[i - 1] * size + block[i]]
    totals = scan(block[-1], compose, width)
    block[:, 1:] = flat[totals[:-1] * size + block[:, 1:]]
    rest = functions[whole * width :].copy()
    last = totals[-1]
    for i in range(len(rest)):
        rest[i] = last = compose[last, rest[i]]
    return np.concatenate((block.T.ravel(), rest))


def boundaries(kinds: np.ndarray, starts: np.ndarray, monoid: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Where tokens begin. ``kinds``: classes of the code points of many texts, ``starts``: where each non-empty text begins."""
    generator, compose, led = monoid
    n = len(kinds)
    white = (kinds == SPACE) | (kinds == BLANK)
    # A text starts as after a blank that no token can share; a reset is the blank's function before its first code point.
    first = generator[kinds]
    first[starts] = compose[generator[BLANK], first[starts]]
    state = led[scan(first, compose)]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = BLANKS_, state[:-1]
    before[starts] = BLANKS_
    word = np.isin(kinds, (LETTER, SINGLE, R, V, L, E))
    begins = np.ones(n, bool)
    same = word & (before == WORD) | (kinds == NUMBER) & (before == DIGITS) | ((kinds == SIGN) | (kinds == QUOTE)) & ((before == SIGNS) | (before == OPEN))
    begins[same | ~white & (before == AFTER_SPACE)] = False
    closed = np.flatnonzero(state == CLOSED)
    begins[closed] = False  # s in 's
    long = closed[before[closed] != OPEN]
    begins[long - 1] = False  # r in 're
    begins[word & ((before == OPEN_RV) | (before == OPEN_L)) & (state != CLOSED)] = False  # 'rx: not a contraction
    # White space: a run is one token, but its last code point stands apart if something else follows.
    after = np.zeros(n, bool)
    after[:-1] = ~white[1:]
    after[np.append(starts[1:], n) - 1] = False
    run = np.zeros(n, bool)
    run[1:] = white[:-1]
    run[starts] = False
    begins[white & run & ~after] = False
    begins[starts] = True
    return begins


class Merges(dict):
    """Ids of pieces as little-endian bytes, merged when first met. At most ``most`` pieces are kept; others are merged again."""

    def __init__(self, ranks: dict[bytes, int], most: int = 400_000):
        super().__init__()
        self.ranks, self.most = ranks, most

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[piece] = np.array(merged(piece, self.ranks), "<u4").tobytes()
        return ids


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbours of lowest rank, leftmost first, until none has one."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    get = ranks.get
    if len(piece) <= 48:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], 1 << 30) for i in range(len(piece) - 1)]
        while pairs:
            low = min(pairs)
            if low == 1 << 30:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], 1 << 30)
        return [ranks[p] for p in parts]
    end = list(range(1, len(piece) + 1))  # end of the part that begins here; 0: merged into an earlier one
    back = list(range(-1, len(piece) - 1))
    heap = [(r, i, i + 2) for i in range(len(piece) - 1) if (r := get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    n = len(piece)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            back[stop] = i
            if (r := get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if back[i] >= 0 and (r := get(piece[back[i] : stop])) is not None:
            heapq.heappush(heap, (r, back[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Codec:
    """Encodes lists of texts to ids with byte offsets, and decodes ids."""

    def __init__(self, rank_file: bytes):
        self.ranks = read_ranks(rank_file)
        self.cache = Merges(self.ranks)
        self.tokens = {i: b for b, i in self.ranks.items()}
        self.lengths = np.zeros(max(self.tokens) + 1, np.int64)
        for i, b in self.tokens.items():
            self.lengths[i] = len(b)
        self.kinds, self.monoid = class_table(), transition_monoid()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        if not len(codes):
            return [b""] * len(texts)
        starts = np.cumsum(sizes) - sizes
        begins = np.flatnonzero(boundaries(self.kinds[codes], starts[sizes > 0], self.monoid))
        width = np.add(codes >= 0x80, codes >= 0x800, dtype=np.uint8) + (codes >= 0x10000) + np.uint8(1)
        offset = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(width, dtype=np.int64, out=offset[1:])
        data = joined.encode()
        cuts = np.append(offset[begins], len(data)).tolist()
        upto = np.searchsorted(begins, np.append(starts, len(codes))).tolist()
        cache, out = self.cache, []
        for a, b in zip(upto[:-1], upto[1:]):
            edges = cuts[a : b + 1] if b > a else []
            out.append(b"".join([cache[data[i:j]] for i, j in zip(edges[:-1], edges[1:])]))
        return out

    def offsets(self, ids: bytes) -> np.ndarray:
        """Byte offset at which each token's bytes begin in the decoded text, and their end."""
        return np.concatenate(([0], np.cumsum(self.lengths[np.frombuffer(ids, "<u4")])))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def worker_codec(rank_file: bytes) -> Codec:
    """The codec of this Python worker, with the merges that earlier tasks of the same worker have met."""
    kept = sys.modules.setdefault("_byte_bpe_codecs", types.ModuleType("_byte_bpe_codecs")).__dict__
    key = hashlib.md5(rank_file).hexdigest()
    if key not in kept:
        kept[key] = Codec(rank_file)
    return kept[key]


def _each(batches: Iterator[pa.RecordBatch], codec: Codec):
    for batch in pieces(batches, "text", 1_000_000):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        yield batch, codec.encode(texts)


def _lists(encoded: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // 4 for x in encoded])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<i4"), pa.int32()))


def encode(docs: DataFrame, rank_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, offsets``: ids of each whole text, and the byte offsets of its tokens (one more than ids).

    ``rank_file``: content of a rank file (under 1 MB; it travels with the task). Null text: as empty, no ids and one offset.
    A text may be of any length; a piece's merges take n log n steps. Rows are encoded alone: nulls in the id, repeated rows and other columns
    change nothing. Empty table: no rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(rank_file)
        for batch, encoded in _each(batches, codec):
            offsets = [codec.offsets(x) for x in encoded]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(encoded), pa.array(offsets, pa.list_(pa.int64()))], ["doc_id", "ids", "offsets"])

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows_in.mapInArrow(rows, "doc_id long, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, rank_file: bytes, most: int = 500_000) -> DataFrame:
    """``doc_id, ids, data``: the bytes of the ids. Null ids: none.

    Bytes are looked up in an Arrow column of all tokens, for rows of about ``most`` ids at once, one row at least."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {i: b for b, i in read_ranks(rank_file).items()}
        tokens = pa.array([known.get(i) for i in range(max(known) + 1)], pa.binary())
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)
            begun = (np.cumsum(lengths) - lengths) // most
            edges = [0, *(np.flatnonzero(np.diff(begun)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                ends = np.concatenate(([0], np.cumsum(lengths[a:b])))
                found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens.take(pa.compute.list_flatten(part.column("ids"))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.compute.binary_join(found, pa.scalar(b"", pa.binary()))], ["doc_id", "ids", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, ids array<int>, data binary")


def round_trip(docs: DataFrame, rank_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, n_tokens, decoded_sha256``: as ``encode``, then ``decode`` within the task, so that ids are moved once
    and one Python worker serves a task. Nulls, long texts, repeated rows and other columns as in ``encode``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(rank_file)
        for batch, encoded in _each(batches, codec):
            back = [hashlib.sha256(codec.decode(x)).hexdigest() for x in encoded]
            n = pa.array([len(x) // 4 for x in encoded], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(encoded), n, pa.array(back, pa.string())], ["doc_id", "ids", "n_tokens", "decoded_sha256"])

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows_in.mapInArrow(rows, "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string")


def digests(docs: DataFrame, rank_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoding and decoding in one pass, without moving the ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(rank_file)
        for batch, encoded in _each(batches, codec):
            sha = [hashlib.sha256(x).hexdigest() for x in encoded]
            back = [hashlib.sha256(codec.decode(x)).hexdigest() for x in encoded]
            n = pa.array([len(x) // 4 for x in encoded], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, pa.array(sha), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows_in.mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def public_ranks(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> bytes:
    """A rank file of the public tokenizers, read on the driver; ``folder`` overrides where they are."""
    if folder is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    else:
        path = f"{folder}/{name}"
    with open(path, "rb") as file:
        return file.read()


@query()
def op9_byte_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"), public_ranks())
