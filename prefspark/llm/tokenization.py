"""Token ids of public tokenizers, with a bounded memory of pieces already coded.

A tokenizer that never joins characters across a space gives a text's ids piece by piece.
Texts repeat their words, so a task looks most pieces up and asks the library for the rest.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Pieces a Python worker remembers, and a quarter as many words; on reaching it, the memory starts anew.
MEMORY = 200_000
#: Bytes of pieces and ids that a worker remembers for columns of texts.
COLUMN_MEMORY = 20 << 20

_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level files: itself where visible, else the next free one."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordCoder(dict):
    """Ids, as bytes of little-endian uint32, of the space-free pieces of texts.

    For the word-end tokenizer, whose pre-tokens hold no white space: cutting at spaces and
    line feeds changes nothing, and special strings hold neither. A word of plain Latin letters
    with points after it is two pre-tokens, and goes to the library's model directly; such
    letters are their own normal form. Other Latin pieces are cut into pre-tokens by pattern,
    and all others go to the library whole.
    """

    def __init__(self, path: str, memory: int = MEMORY, column_memory: int = COLUMN_MEMORY):
        super().__init__()
        self._tokenizer = load_tokenizer(path)
        self._model = self._tokenizer.model
        self._letters = byte_letters()
        self._memory = memory
        self._words: dict[str, bytes] = {}
        self._column_memory = column_memory
        self._forget()

    def _forget(self) -> None:
        self._known, self._known_ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self._columns, self._met = 0, np.empty(0, np.int64)  # columns so far, and the last that held each known piece

    def _room(self) -> int:
        return self._known.nbytes + self._known_ids.nbytes + self._met.nbytes

    def _library(self, piece: str) -> bytes:
        return array("I", self._tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of one normalised pre-token."""
        ids = self._words.get(word)
        if ids is None:
            if len(self._words) >= self._memory // 4:
                self._words.clear()
            spelled = word if word.isascii() else "".join(map(self._letters.__getitem__, word.encode()))
            ids = self._words[word] = array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()
        return ids

    def _piece(self, piece: str) -> bytes:
        word = piece.rstrip(".,;:!?")
        lowered = word.lower()
        if lowered.isalpha() and max(lowered) < "ƀ" and max(word) < "ƀ":
            ids = self._word(lowered)
            if len(word) < len(piece):
                ids += self._word(piece[len(word) :])
            return ids
        if piece and max(piece) < "ƀ" and piece.isprintable() and "<|" not in piece:
            return b"".join(map(self._word, _WORDS.findall(piece.lower())))
        return self._library(piece)

    def __missing__(self, piece: str) -> bytes:
        ids = self._piece(piece)
        if len(self) >= self._memory:
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; a null has none."""
        if not text:
            return b""
        # Two pieces at least, so that the getter gives a tuple; the empty one has no ids.
        pieces = text.replace("\n", " ").split(" ")
        return b"".join(itemgetter("", *pieces)(self))

    def encode_column(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text, as :meth:`encode` gives them.

        Arrow cuts the texts and numbers their distinct pieces, so that a piece is coded once
        however often it occurs. Pieces of earlier columns are remembered as Arrow arrays, in
        a fifth of the room that Python's objects take; when these are full, the half that was
        not met for longest is forgotten.
        """
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), "\n", " "), " ")
        pieces = cut.flatten().dictionary_encode()
        distinct = pieces.dictionary
        # The pieces of this column are hashed, not the many that are known.
        same = pc.index_in(self._known, value_set=distinct)
        place = np.full(len(distinct), -1)
        place[same.drop_null().to_numpy()] = np.flatnonzero(same.is_valid())
        new = np.flatnonzero(place < 0)
        place[new] = len(self._known) + np.arange(len(new))
        unknown = distinct.take(pa.array(new))
        coded = pa.array([self._piece(p) for p in unknown.to_pylist()], pa.binary())
        self._known = pa.concat_arrays([self._known, unknown])
        self._known_ids = pa.concat_arrays([self._known_ids, coded])
        ids = self._known_ids.take(pa.array(place))
        self._columns += 1
        self._met = np.concatenate([self._met, np.empty(len(new), np.int64)])
        self._met[place] = self._columns
        if self._room() > self._column_memory:
            recent = np.flatnonzero(self._met > np.median(self._met))
            self._known, self._known_ids = self._known.take(pa.array(recent)), self._known_ids.take(pa.array(recent))
            self._met = self._met[recent]
            if self._room() > self._column_memory:
                self._forget()
        found = ids.take(pieces.indices)
        _, offsets, data = found.buffers()
        ends = np.frombuffer(offsets, "<i4")[cut.offsets.to_numpy()] if len(texts) else []
        data = memoryview(data or b"")
        for start, end in zip(ends[:-1], ends[1:]):
            yield bytes(data[start:end])


_CODERS: dict[str, WordCoder] = {}


def word_coder(path: str) -> WordCoder:
    """The worker's coder: later tasks of the same worker find its memory filled."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]
