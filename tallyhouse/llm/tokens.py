"""Texts to token ids by a public byte-level tokenizer, with a bounded cache of pieces.

A text is cut before every space and line feed. Where the character before the cut is no
white space, no token can reach over it (the pre-tokenizer lets a token take at most the
one space before it), so the pieces' ids in a row are the text's ids. It is also cut where
punctuation follows a letter, which the pre-tokenizer always keeps apart. Pieces repeat far
more than texts, and each is encoded once while the cache holds it.
"""

from __future__ import annotations

import json
import re
import string
import sys
from array import array
from collections.abc import Callable
from itertools import compress, pairwise, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces held by one Python worker; about 200 bytes each.
MAX_CACHE = 800_000
BLOCK = 4096

#: A line feed, one word of Latin letters with its space, punctuation: three tokens' worth
#: of text that the pre-tokenizer keeps apart, so that the word can go straight to the model.
WORD = " ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
WORD_PIECE = re.compile(f"(\n?)({WORD})([!-/:-@\\[-`{{-~]*)")
LONE_WORD = re.compile(f"\n?{WORD}")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()
#: The same by byte, but a line feed stays one.
LETTER_POINTS = np.array([10 if b == 10 else ord(BYTE_LETTERS[b]) for b in range(256)], "<u4")

STARTS, PUNCTUATION, LETTER, LATIN = 1, 2, 3, 4


def _byte_kinds() -> np.ndarray:
    """Bytes that begin a piece, punctuation, letters, and first bytes of two that make a Latin letter."""
    kinds = np.zeros(256, np.uint8)
    for kind, letters in (
        (STARTS, b" \n"),
        (PUNCTUATION, string.punctuation.encode()),
        (LETTER, string.ascii_letters.encode()),
        (LATIN, bytes(range(0xC3, 0xC9))),
    ):
        kinds[list(letters)] = kind
    return kinds


BYTE_KINDS = _byte_kinds()
#: What the piece cache does not hold; None there is a piece that is open at its end.
UNKNOWN = object()


def default_tokenizer() -> str:
    """Place of the byte-level vocabulary file on this machine; executors ask for themselves."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceCache(dict):
    """A bounded map from pieces to ids in two generations.

    What is used lives in the young one, this dict. When that is full it becomes the old
    one, from which pieces come back when they are met again: common pieces survive, rare
    ones go. A piece of neither is learned when it is asked for.
    """

    def __init__(self, most: int, learn: Callable[[str], bytes | None] | None = None):
        super().__init__()
        self.half = max(1, most // 2)
        self.learn = learn
        self.old: dict[str, bytes | None] = {}

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.old[piece] if piece in self.old else self.learn(piece)
        self[piece] = ids
        return ids

    def turn(self) -> None:
        """Start a new generation if the young one is full."""
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()

    def missing(self, pieces: set[str]) -> set[str]:
        """The pieces of neither generation; those of the old one become young again."""
        fresh = pieces.difference(self)
        known = fresh.intersection(self.old)
        self.update((piece, self.old[piece]) for piece in known)
        return fresh - known


def packed(ids: list[int], dtype: np.dtype) -> bytes:
    """Ids as little-endian numbers of two or four bytes."""
    out = array("H" if dtype.itemsize == 2 else "I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """Encodes texts to little-endian ids; special strings in a text are ordinary text."""

    def __init__(self, path: str | None = None, max_cache: int = MAX_CACHE):
        from tokenizers import Tokenizer

        path = path or default_tokenizer()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache = PieceCache(max_cache, self._learn)
        self.tokenize = self.tokenizer.model.tokenize
        with open(path, encoding="utf-8") as file:
            self.by_piece = self._cuts_at_spaces(json.load(file))
        self.parts: dict[str, bytes] = {}

    @staticmethod
    def _cuts_at_spaces(config: dict) -> bool:
        before = config.get("pre_tokenizer") or {}
        return (
            config.get("normalizer") is None
            and config["model"].get("type") == "BPE"
            and not any(config["model"].get(k) for k in ("dropout", "end_of_word_suffix"))
            and before.get("type") == "ByteLevel"
            and before.get("add_prefix_space") is False
            and before.get("use_regex", True)
        )

    def _ids(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return packed(found, self.dtype)

    def _learn(self, piece: str) -> bytes | None:
        """The ids of a piece; None where what follows may change its tokens."""
        # Most are a space and a word without accents.
        if piece[:1] == " " and piece.isascii() and piece[1:].isalpha():
            return self._word(BYTE_LETTERS[32] + piece[1:])
        if found := WORD_PIECE.fullmatch(piece):
            feed, core, tail = found.groups()
            if feed or tail:
                return self._part(feed) + self.cache[core] + self._part(tail)
            return self._word(core.encode().decode("latin-1").translate(BYTE_LETTERS))
        if piece and piece[-1].isspace():
            return None
        return self._ids(piece)

    def _word(self, spelled: str) -> bytes:
        """The ids of a word written in the letters of the vocabulary."""
        return packed([t.id for t in self.tokenize(spelled)], self.dtype)

    def _part(self, text: str) -> bytes:
        """The ids of a line feed or of a run of punctuation, one token's worth of text."""
        if (ids := self.parts.get(text)) is None:
            if len(self.parts) > BLOCK:
                self.parts.clear()
            ids = self.parts[text] = self._ids(text) if text else b""
        return ids

    @staticmethod
    def _merged(pieces: list[str]) -> list[str]:
        """Pieces joined so that none but the last ends in white space."""
        out, held = [], ""
        for piece in pieces:
            held += piece
            if not held[-1:].isspace():
                out.append(held)
                held = ""
        return [*out, held] if held else out

    def _learned(self, pieces: list[str]) -> list[bytes | None]:
        """The ids of new pieces; those of all words among them are packed together."""
        are_words = [LONE_WORD.fullmatch(piece) is not None for piece in pieces]
        words = [*compress(pieces, are_words)]
        feed = np.frombuffer(self._part("\n"), self.dtype).tolist()
        ids, ends = [], [0]
        for word, spelled in zip(words, _spelled([w.removeprefix("\n") for w in words]), strict=True):
            if word[0] == "\n":
                ids += feed
            ids += [t.id for t in self.tokenize(spelled)]
            ends.append(len(ids) * self.dtype.itemsize)
        flat = packed(ids, self.dtype)
        spans = pairwise(ends)
        return [
            flat[slice(*next(spans))] if is_word else self._learn(piece)
            for piece, is_word in zip(pieces, are_words, strict=True)
        ]

    def _found(self, pieces: list[str]) -> list[bytes | None]:
        """The ids of each of different pieces, which are young in the cache from now on."""
        found = [*map(self.cache.get, pieces, repeat(UNKNOWN))]
        are_missing = [*map(is_, found, repeat(UNKNOWN))]
        missing = [*compress(pieces, are_missing)]
        known = [*map(self.cache.old.get, missing, repeat(UNKNOWN))]
        are_new = [*map(is_, known, repeat(UNKNOWN))]
        for k, ids in zip(_places(are_new), self._learned([*compress(missing, are_new)]), strict=True):
            known[k] = ids
        self.cache.update(zip(missing, known, strict=True))
        for k, ids in zip(_places(are_missing), known, strict=True):
            found[k] = ids
        return found

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text as bytes; a null text has none.

        The pieces of all texts are found, told apart and put together again in Arrow;
        Python sees each different word of the batch once, whatever punctuation follows it.
        """
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if not self.by_piece:
            return [self._ids(text) for text in column.to_pylist()]
        self.cache.turn()
        pieces, ends = _pieces(column)
        coded = pieces.dictionary_encode()
        found = self._found(_strings(coded.dictionary))
        odd = []
        if None in found:
            is_open = np.fromiter((x is None for x in found), bool, len(found))
            odd = np.flatnonzero(np.diff(_running(is_open[coded.indices.to_numpy()])[ends])).tolist()
            found = [x or b"" for x in found]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        ids = pa.array(np.frombuffer(b"".join(found), self.dtype))
        taken, starts = _listed(ids, _running(sizes), coded.indices)
        flat = taken.to_numpy().tobytes()
        out = [flat[a:b] for a, b in pairwise((starts[ends] * self.dtype.itemsize).tolist())]
        for k in odd:
            text = column[k].as_py()
            out[k] = self._ids(text) if "\0" in text else self._encode_merged(text)
        # Else Arrow keeps the room of a whole batch while the worker lives.
        pa.default_memory_pool().release_unused()
        return out

    def _encode_merged(self, text: str) -> bytes:
        """The ids of a text with runs of white space."""
        get = self.cache.__getitem__
        merged = self._merged(text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0"))
        last = get(merged[-1])
        return b"".join([*map(get, merged[:-1]), self._ids(merged[-1]) if last is None else last])


def _pieces(column: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pieces of all texts, and the number of pieces before each text and of all."""
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    first, last = int(bounds[0]), int(bounds[-1])
    data = column.buffers()[2] or pa.py_buffer(b"")
    held = np.frombuffer(data, np.uint8)[first:last]
    kinds = BYTE_KINDS[held]
    starts = kinds == STARTS
    marks = np.flatnonzero(kinds == PUNCTUATION)
    before = np.maximum(marks - 1, 0)
    # The signs of multiplication and division have these second bytes.
    latin = (kinds[np.maximum(marks - 2, 0)] == LATIN) & ~np.isin(held[before], (0x97, 0xB7))
    starts[marks[(kinds[before] == LETTER) | latin]] = True
    starts[bounds[:-1][bounds[:-1] < last] - first] = True
    cuts = np.append(np.flatnonzero(starts) + first, last)
    pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), data)
    return pieces, np.searchsorted(cuts, bounds)


def _spelled(words: list[str]) -> list[str]:
    """Words in the letters of the vocabulary."""
    if not words:
        return []
    held = np.frombuffer("\n".join(words).encode(), np.uint8)
    return LETTER_POINTS[held].tobytes().decode("utf-32-le").split("\n")


def _places(marked: list[bool]) -> list[int]:
    return np.flatnonzero(marked).tolist()


def _strings(column: pa.LargeStringArray) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _listed(ids: pa.Array, starts: np.ndarray, places: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs of ids that begin at starts, in the order of places, and where each begins."""
    runs = pa.LargeListArray.from_arrays(pa.array(starts), ids).take(places)
    return runs.flatten(), _running(np.diff(starts)[places.to_numpy()])


def _running(sizes: np.ndarray) -> np.ndarray:
    """The sums before each place, and the sum of all."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """This process's encoder; its cache lives as long as the Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
