"""Hashed five-word shingles of Arrow text arrays, a whole batch at a time.

Words are the text's white-space runs in lower case.  A text with one to four words has one
shingle, of all its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 5
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers and their inverses; those of very long strings are not kept."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (_P, _INVERSE):
        row = np.full(1 << (n - 1).bit_length(), base, dtype=np.uint64)
        row[0] = 1
        made.append(np.multiply.accumulate(row))
    if n <= 1 << 20:
        _powers[:] = made
    return made[0][:n], made[1][:n]


def hashed(strings: pa.Array, most_bytes: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each string's bytes; ``most_bytes`` are worked on at once, or one longer string."""
    if not len(strings):
        return np.zeros(0, dtype=np.uint64)
    edges = np.frombuffer(strings.buffers()[1], dtype=np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)
    out, start = [], 0
    while start < len(strings):
        end = max(start + 1, int(np.searchsorted(edges, edges[start] + most_bytes, side="right")) - 1)
        out.append(_hashed(data[edges[start] : edges[end]], edges[start : end + 1] - edges[start]))
        start = end
    return np.concatenate(out)


def _hashed(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    up, down = _power(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)])
    own = (total[edges[1:]] - total[edges[:-1]]) * down[edges[:-1]]
    return mix(own ^ (np.diff(edges).astype(np.uint64) << np.uint64(40)))


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where each text's words start."""
    # without blanks at the end, which the splitting does not always take for blanks
    lists = pc.utf8_split_whitespace(pc.utf8_rtrim_whitespace(pc.utf8_lower(pc.fill_null(texts, ""))))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = np.asarray(pc.greater(pc.binary_length(values), 0), dtype=bool)
    hashes = hashed(values)
    if full.all():
        return hashes, offsets
    return hashes[full], np.concatenate([[0], np.cumsum(full)])[offsets]


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle, repeats included, and where each text's shingles start."""
    words, offsets = words_of(texts)
    n = np.diff(offsets)
    counts = np.where(n >= SIZE, n - SIZE + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(starts[-1]) - np.repeat(starts[:-1] - offsets[:-1], counts)  # each shingle's first word
    length = np.repeat(np.minimum(n, SIZE), counts)
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(SIZE):
        own = i < length
        if own.all():
            out = mix(out * _P + words[at + i])
        else:
            out[own] = mix(out[own] * _P + words[at[own] + i])
    return out, starts
