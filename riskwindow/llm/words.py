"""Words of many texts at once, in numpy.

A table gives each byte a kind: part of a word, a gap between words, or a break between
pieces of text. Texts are taken as UTF-8, and every byte of a character beyond ASCII is
of one kind, so no character is cut. Long texts are taken in parts that end at a break (or, where
breaks do not matter, at a gap), so memory stays bounded by ``SPAN`` unless one piece is longer.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD, GAP, BREAK = 0, 1, 2
#: Bytes of text that are looked at together, besides the piece that crosses the limit.
SPAN = 4_000_000

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """Words in the order of the texts, each with the place of its text in the column and the number of its piece."""

    text: np.ndarray
    piece: np.ndarray
    word: pa.LargeBinaryArray


def kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[list(gaps)] = GAP
    table[list(breaks)] = BREAK
    return table


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; nulls are empty."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def _parts(flat: np.ndarray, starts: np.ndarray, table: np.ndarray, least: int, span: int) -> Iterator[tuple[int, int]]:
    """Parts of the bytes that end where a text ends or at a byte of at least this kind."""
    start = 0
    while start < len(flat):
        end = min(start + span, len(flat))
        limit = int(starts[np.searchsorted(starts, end)])
        while end < limit:
            near = np.flatnonzero(table[flat[end : min(end + 65_536, limit)]] >= least)
            if len(near):
                end += int(near[0])
                break
            end = min(end + 65_536, limit)
        yield start, end
        start = end


def words(column: pa.Array, table: np.ndarray, lower: np.ndarray = LOWER, span: int = SPAN) -> Iterator[Words]:
    """The words of a column of texts, in parts; a piece never spans two parts."""
    flat, starts = _flat(column)
    least = BREAK if (table == BREAK).any() else GAP
    for a, b in _parts(flat, starts, table, least, span):
        part = flat[a:b]
        kind = table[part]
        first = np.zeros(b - a, dtype=bool)
        inner = starts[np.searchsorted(starts, a) : np.searchsorted(starts, b)]
        first[inner - a] = True
        inside = kind == WORD
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:]
        at = np.flatnonzero(begins)
        if not len(at):
            continue
        compact = lower[part[inside]]
        offsets = np.append((np.cumsum(inside) - 1)[at], len(compact))
        piece = np.cumsum((kind == BREAK) | first)[at]
        text = np.searchsorted(starts, a + at, side="right") - 1
        word = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(compact)]
        )
        yield Words(text, piece, word)


def numbered(word: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.Array]:
    """The number of each word among the different ones, and these."""
    found = word.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary
