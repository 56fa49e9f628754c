"""Words of Arrow text arrays that end at given ASCII signs, a whole batch at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK, _BREAK = 1, 2


@dataclass(frozen=True)
class Signs:
    """What each byte does: blanks end a word, breaks also end a piece.  Bytes from 128 on are always in words."""

    kinds: np.ndarray

    @classmethod
    def of(cls, blanks: bytes, breaks: bytes = b"") -> Signs:
        kinds = np.zeros(256, dtype=np.uint8)
        kinds[list(blanks)] = _BLANK
        kinds[list(breaks)] = _BREAK
        return cls(kinds)


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, dtype=np.int32)  # a text array has less than 2^31 bytes
    np.cumsum(flags, out=out[1:])
    return out


@dataclass(frozen=True)
class Cut:
    """All words of all texts, where each text's words start, and the number of the piece that each word is in."""

    words: pa.Array
    offsets: np.ndarray
    pieces: np.ndarray


def cut(texts: pa.Array, signs: Signs) -> Cut:
    """Texts end pieces too.  A null text has no words."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return Cut(pa.array([], pa.string()), np.zeros(1, np.int64), np.zeros(0, np.int64))
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    kinds = signs.kinds[data]
    inside = kinds == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    inner = edges[:-1][edges[:-1] < len(data)]
    first[inner] = inside[inner]  # a text's first byte starts a word of its own
    starts = np.flatnonzero(first)
    breaks = _running(kinds == _BREAK)
    of_text = np.searchsorted(starts, edges)
    # word bytes alone, one word after the other
    kept = _running(inside)
    ends = np.append(kept[starts], kept[-1]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    pieces = breaks[starts] + np.repeat(np.arange(n), np.diff(of_text))
    return Cut(words, of_text, pieces)
