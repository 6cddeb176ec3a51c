"""Whole texts through the libraries of public tokenizers, each distinct stretch between blanks encoded once."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
from collections.abc import Callable

import numpy as np

# A space before white space: cutting at every space could split a run of blanks that is one token.
_WHITE = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_SPACE_AND_WHITE = [" " + c for c in _WHITE]
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")
_MOST_IDS = 2_000_000
_MOST_CHARS = 16_000_000

Encode = Callable[[list[str]], list[list[int]]]


def tokenizer_file(name: str, folder: str | None = None) -> bytes:
    """A file of the public tokenizers, read on the driver; ``folder`` overrides where they are."""
    if folder is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    else:
        path = f"{folder}/{name}"
    with open(path, "rb") as file:
        return file.read()


def _has_runs(text: str) -> bool:
    return any(pair in text for pair in _SPACE_AND_WHITE)


def stretches(text: str) -> list[str]:
    """Cut a text that begins with a space into stretches that do too, given without that space.

    No token of the byte-level or of the piece vocabulary holds a blank after another sign, and what is cut off on one side
    does not change the tokens of the other, so stretches can be encoded one by one.
    """
    if _has_runs(text):
        return [part[1:] for part in _SAFE_CUT.split(text)]
    return text[1:].split(" ")


def headed(text: str) -> list[str | tuple[str]]:
    """The same for a text that is taken as it is: its first stretch, in a tuple, has no space in front."""
    if _has_runs(text):
        first, *rest = _SAFE_CUT.split(text)
        return [(first,), *[part[1:] for part in rest]]
    first, *rest = text.split(" ")
    return [(first,), *rest]


class _Numbers(dict):
    """Numbers for stretches in the order they are first met; new ones are listed in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class Ragged:
    """Lists of ids laid end to end, looked up by their numbers."""

    def __init__(self):
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def add(self, lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these lists end to end, and the size of each list."""
        starts = self.ends[numbers]
        sizes = self.ends[numbers + 1] - starts
        shift = starts - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes


class StretchEncoder:
    """Ids of texts by one or more tokenizers. Each gets a stretch with its leading space; the number of ids and characters
    kept between calls is bounded."""

    def __init__(self, *encoders: Encode):
        self.encoders = encoders
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.chars = _Numbers(), 0
        self.lists = [Ragged() for _ in self.encoders]

    def encode(self, texts: list[str], cut: Callable = stretches) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each tokenizer the ids of all texts end to end, and how many each text has. Texts begin with a space, unless ``cut`` is
        ``headed``."""
        if self.chars > _MOST_CHARS or any(len(kept.ids) > _MOST_IDS for kept in self.lists):
            self._forget()
        parts = [cut(text) for text in texts]
        found = np.fromiter((n for part in parts for n in map(self.numbers.__getitem__, part)), np.int64)
        fresh = self.numbers.fresh
        if fresh:
            whole = [" " + part if isinstance(part, str) else part[0] for part in fresh]
            for encoder, kept in zip(self.encoders, self.lists):
                kept.add(encoder(whole))
            self.chars += sum(map(len, whole))
            self.numbers.fresh = []
        edges = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)
        out = []
        for kept in self.lists:
            ids, sizes = kept.take(found)
            upto = np.concatenate([[0], np.cumsum(sizes)])[edges]
            out.append((ids, np.diff(upto)))
        return out


def byte_level(file: bytes, plain_specials: bool = True) -> tuple[Encode, list[bytes]]:
    """Encoder and bytes of each id of a byte-level BPE file. ``plain_specials``: strings of special tokens are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(file.decode())
    tokenizer.encode_special_tokens = plain_specials
    byte_of = printable_bytes()
    names = [tokenizer.id_to_token(i) or "" for i in range(max(tokenizer.get_vocab().values()) + 1)]
    data = [bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode() for name in names]
    if plain_specials and (fast := _by_ranks(json.loads(file), data)):
        return fast, data
    return lambda texts: [found.ids for found in tokenizer.encode_batch(texts, add_special_tokens=False)], data


#: Fixed value: how the byte-level split cuts text when its own pattern is used.
_BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _by_ranks(spec: dict, data: list[bytes]) -> Encode | None:
    """The same ids by the rank encoder, which is several times as fast on text it has not met, if the file allows: byte-level split
    without prefix or normaliser, and merges in the order of their ids."""
    model, split = spec["model"], spec["pre_tokenizer"]
    if spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    plain = {x for x in vocabulary.values() if len(data[x]) == 1}
    if merged != sorted(merged) or len(plain) != 256 or max(plain) > merged[0] or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    import tiktoken

    ranks = {data[i]: i for i in sorted(plain | set(merged))}
    encoding = tiktoken.Encoding("by-ranks", pat_str=_BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [encoding.encode_ordinary(text) for text in texts]


def printable_bytes() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs are themselves, the other bytes
    follow in order from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def sentence_pieces(file: bytes) -> tuple[Encode, list[bytes]]:
    """Encoder and bytes of each id of a piece model that puts a space before each text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=file)
    blank = "▁"

    def encode(texts: list[str]) -> list[list[int]]:
        # The model adds the leading space itself, but nothing to an empty text.
        found = model.encode([text[1:] for text in texts], num_threads=1)
        return [ids if len(text) > 1 else [model.piece_to_id(blank)] for ids, text in zip(found, texts)]

    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return encode, [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(blank, " ").encode() for i, name in enumerate(names)]


def in_worker(label: str, file: bytes, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept by this Python worker for later tasks over the same file."""
    kept = sys.modules.setdefault("_ticktalk_encoders", types.ModuleType("_ticktalk_encoders")).__dict__
    key = f"{label}-{hashlib.md5(file).hexdigest()}"
    if key not in kept:
        kept[key] = make()
    return kept[key]
