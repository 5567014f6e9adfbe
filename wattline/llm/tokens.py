"""Token ids of whole texts with a public byte-level BPE file.

The file's pre-tokenizer never joins a blank to the character before it. A text in which every
blank stands behind a character other than white space may therefore be cut before its blanks.
Of the pieces of many texts each different one is encoded once, all in one call, and the ids are
told apart by the bytes that each id stands for. Any other text goes to the tokenizer as a whole.
Both give the ids that ``Tokenizer.encode(text, add_special_tokens=False)`` gives.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from wattline.llm import words as W

END = 0
BYTE_BPE = "byte_bpe_50k.json"
BATCH = 4 << 20
AT_ONCE = 1 << 18
PIECES_KEPT = 600_000
_SPACE = np.zeros(256, bool)
_SPACE[0x20] = True
_EXACT = W.stream(6, 256)
_ASCII_BLANK = np.zeros(256, bool)
_ASCII_BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True


def tokenizer_path(name: str = BYTE_BPE) -> str:
    return public_tokenizers.path(name)


def _unsafe(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows with a blank at either end or behind other white space."""
    at = np.flatnonzero(data == 0x20)
    row = np.searchsorted(rows, at, "right") - 1
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    # U+1680, U+2000 to 203F, U+205F and U+3000; the second block holds more than white space.
    wide |= ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & (two == 0x80))
    wide |= ((three == 0xE2) & (two == 0x81)) | ((three == 0xE3) & (two == 0x80))
    bad = _ASCII_BLANK[one] | wide | (at == rows[row]) | (at + 1 == rows[row + 1])
    found = np.zeros(len(rows) - 1, bool)
    found[row[bad]] = True
    return found


def _gather(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Slices of ``pool`` end to end."""
    behind = np.cumsum(length, dtype=np.int64)
    return pool[np.repeat(start - (behind - length), length) + np.arange(behind[-1] if len(behind) else 0)]


def _runs(limits: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of pieces of at most about AT_ONCE characters, one piece at least."""
    low = 0
    while low < len(limits) - 1:
        high = max(low + 1, int(np.searchsorted(limits, limits[low] + AT_ONCE, "right")) - 1)
        yield low, high
        low = high


class Encoder:
    """Texts to ids, two bytes each if the vocabulary allows it, else four."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.bytes_of = np.zeros(size, np.int64)
        for token, at in self.tokenizer.get_vocab().items():
            self.bytes_of[at] = len(token)  # the vocabulary writes each byte as one character
        self.known = np.zeros(0, np.uint64)
        self.pool, self.at, self.count = np.zeros(0, self.dtype), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The tokenizer's own results are some hundred bytes an id, so few texts go at a time."""
        found: list[np.ndarray] = []
        for low, high in _runs(np.cumsum([0, *map(len, texts)])):
            own = self.tokenizer.encode_batch_fast(texts[low:high], add_special_tokens=False)
            found += [np.array(x.ids, self.dtype) for x in own]
        return found

    def _pieces(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        """Ids of pieces, each with the blank before it: a pool, and each piece's slice of it."""
        runs = _runs(np.cumsum(np.append(0, length + 1)))
        texts = [_gather(data, start[a:b] - 1, length[a:b] + 1).tobytes().decode("utf-8") for a, b in runs]
        ids = np.concatenate(self.whole(texts))
        behind = np.cumsum(self.bytes_of[ids])
        ends = np.cumsum(length + 1)
        last = np.searchsorted(behind, ends)
        if not np.array_equal(behind[last], ends):
            raise ValueError("an id of this vocabulary reaches over a blank")
        count = np.diff(last + 1, prepend=0)
        return ids, last + 1 - count, count

    def _slices(self, values: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        """A pool of ids and the slice of each piece; ``values`` are the sorted hashes of the pieces."""
        place = np.searchsorted(self.known, values)
        fresh = np.ones(len(values), bool)
        inside = place < len(self.known)
        fresh[inside] = self.known[place[inside]] != values[inside]
        at, count = np.zeros(len(values), np.int32), np.zeros(len(values), np.int32)
        at[~fresh], count[~fresh] = self.at[place[~fresh]], self.count[place[~fresh]]
        pool = self.pool
        if fresh.any():
            ids, begin, count[fresh] = self._pieces(data, start[fresh], length[fresh])
            at[fresh] = begin + len(pool)
            pool = np.concatenate([pool, ids])
            if len(self.known) + int(fresh.sum()) <= PIECES_KEPT:
                self.pool, where = pool, place[fresh]
                self.known = np.insert(self.known, where, values[fresh])
                self.at = np.insert(self.at, where, at[fresh])
                self.count = np.insert(self.count, where, count[fresh])
        return pool, at, count

    def batch(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text with the end id behind them; null is the empty text."""
        end = np.array([END], self.dtype)
        found: list[np.ndarray] = [end] * len(column)
        data, rows = W.utf8(column)
        unsafe = _unsafe(data, rows)
        odd = np.flatnonzero(unsafe)
        for i, ids in zip(odd.tolist(), self.whole([column[i].as_py() for i in odd.tolist()])):
            found[i] = np.concatenate([ids, end])
        code, start, limits = W.spans(data, rows, _SPACE, _EXACT)
        size = np.diff(np.append(start, len(data)))
        # Up to the blank in front of the next piece, or to the end of the row.
        some = limits[1:] > limits[:-1]
        last = limits[1:][some] - 1
        size -= 1
        size[last] = rows[1:][some] - start[last]
        first = np.zeros(len(code), bool)
        first[limits[:-1][some]] = True
        filled = np.flatnonzero(some & ~unsafe)
        usable = ~np.repeat(unsafe, np.diff(limits))
        later = np.flatnonzero(usable & ~first)
        starts = [bytes(data[start[k] : start[k] + size[k]]).decode() for k in limits[:-1][filled]]
        heads = self.whole(starts)
        values, sample, which = np.unique(code[later], return_index=True, return_inverse=True)
        ids, at, count = self._slices(values, data, start[later[sample]], size[later[sample]])
        tail = _gather(ids, at[which], count[which])
        among = np.concatenate([[0], np.cumsum(count[which], dtype=np.int64)])
        rank = np.searchsorted(later, limits)
        for i, head in zip(filled.tolist(), heads):
            found[i] = np.concatenate([head, tail[among[rank[i]] : among[rank[i + 1]]], end])
        return found


def id_width(path: str) -> int:
    """Bytes of an id."""
    return encoder(path).dtype.itemsize


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and ids of runs of rows of bounded text size."""
    own = encoder(path)
    for low, high in W.batches(column, BATCH):
        yield low, own.batch(column.slice(low, high - low))
