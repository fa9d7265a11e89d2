"""Token ids of text columns by a public tokenizer file of the ``tokenizers`` library.

A tokenizer cuts a text before white space that follows something else and between a letter and
a sign, so the ids of a text are those of its pieces one after another. Each distinct piece is
encoded once per worker; a text's ids are put together from them. A special token that a text spells
out is one piece, as in the library.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from tidemill.llm.columns import SPACE, binary_array, codes, lower_ascii, text_bytes

# Pieces remembered by a worker; beyond that it starts afresh.
REMEMBERED = 600_000
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile(rf" ?[{LETTERS}]+")
ALPHA, SIGN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
ALPHA[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
SIGN[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at each text, at ASCII white space behind anything else, at ASCII signs
    behind a letter, and behind a line break that stands alone."""
    space = SPACE[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    turn = space[1:] & ~space[:-1] & ~((data[:-1] >= 0x1C) & (data[:-1] <= 0x1F))
    begins[1:-1] = turn
    # Wider white space (U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000) may stand in front of it.
    wide = np.flatnonzero(begins[2:-1] & (data[1:-1] >= 0x80)) + 2
    wide = wide[np.isin(data[wide - 2], (0xC2, 0x9A, 0x80, 0x81))]
    begins[wide] = False
    lines = np.flatnonzero(data == 0x0A)
    lines = lines[(lines + 1 < len(data)) & begins[lines]]
    lines = lines[ALPHA[data[np.minimum(lines + 1, len(data) - 1)]]]
    begins[lines + 1] = True
    begins[1:-1] |= SIGN[data[1:]] & ALPHA[data[:-1]]
    begins[offsets] = True
    begins[-1] = True
    return np.flatnonzero(begins)


class Encoder:
    """Encodes columns with one tokenizer file; no special tokens are added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
            raise ValueError(f"{path} has special tokens that depend on the text around them")
        self.special = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.spelled = re.compile(b"|".join(map(re.escape, self.special)))
        normalizer = self.tokenizer.normalizer
        self.lower = normalizer is not None and normalizer.normalize_str("Aa") == "aa"
        # The vocabulary's characters for the letters and the space, as its own pre-tokenizer maps them.
        chars = [chr(c) for c in range(0xC0, 0x100) if chr(c) not in "×÷"]
        self.space = self._mapped(" a")[:-1]
        self.table = {ord(c): self._mapped(c) for c in chars} | {ord(" "): self.space}
        self.known: dict[bytes, int] = {}
        self._forget()

    def _mapped(self, text: str) -> str:
        normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        return "".join(piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def _forget(self) -> None:
        self.known.clear()
        self.ids = np.zeros(0, dtype=np.uint32)
        self.bounds = np.zeros(1, dtype=np.int64)

    def _piece(self, piece: bytes) -> list[int]:
        text = piece.decode("utf-8")
        if not WORD.fullmatch(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if not text.isascii():
            text = (text.lower() if self.lower else text).translate(self.table)
        elif text[0] == " ":
            text = self.space + text[1:]
        return [t.id for t in self.tokenizer.model.tokenize(text)]

    def _learn(self, pieces: list[bytes]) -> None:
        new = list(map(self._piece, pieces))
        flat = np.array(list(chain.from_iterable(new)), dtype=np.uint32)
        sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        first = len(self.bounds) - 1
        self.ids = np.concatenate([self.ids, flat])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.known.update(zip(pieces, range(first, first + len(pieces))))

    def _special(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Begin and end of each special token that lies within a row."""
        raw, at, spans = data.tobytes(), 0, []
        if any(t in raw for t in self.special):
            while found := self.spelled.search(raw, at):
                begin, end = found.span()
                whole = end <= offsets[np.searchsorted(offsets, begin, "right")]
                spans += [(begin, end)] if whole else []
                at = end if whole else begin + 1
        return np.array(spans, dtype=np.int64).reshape(-1, 2)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in one array, and the offsets of each row's ids; nulls are empty."""
        data, offsets = text_bytes(column)
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        special = self._special(data, offsets)
        lowered = lower_ascii(data) if self.lower else data
        cuts = _cuts(lowered, offsets)
        if len(special):
            inside = np.zeros(len(data) + 1, dtype=bool)
            for begin, end in special.tolist():
                inside[begin + 1 : end] = True
            cuts = np.union1d(cuts[~inside[cuts]], special)
            inside[special[:, 0]] = True
            lowered = np.where(inside[:-1], data, lowered)
        data = lowered
        numbers, distinct = codes(binary_array(data, cuts))
        distinct = distinct.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        new = [p for p in distinct if p not in self.known]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        starts = self.bounds[place]
        sizes = (self.bounds[place + 1] - starts)[numbers]
        ends = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=ends[1:])
        index = np.arange(ends[-1]) + np.repeat(starts[numbers] - ends[:-1], sizes)
        return self.ids[index], ends[np.searchsorted(cuts[:-1], offsets)]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file, so that what it knows serves all its tasks."""
    return Encoder(path)


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids written as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
