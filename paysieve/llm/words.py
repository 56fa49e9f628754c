"""White-space words of Arrow text arrays, and their ids by a tokenizer of the tokenizers library.

The tokenizers at hand drop white space before they merge, so that a text's ids are its
white-space words' ids in order.  Each distinct word is encoded once and looked up after.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are encoded at once; fewer cost more looks into the dictionary.
SLICE = 4 << 20
#: A word of these letters is one unit for the pre-tokenizer, whatever stands around it.
PLAIN = "^[a-z\\x{df}-\\x{f6}\\x{f8}-\\x{ff}]+$"
PLAIN_AND_MARK = "^[a-z\\x{df}-\\x{f6}\\x{f8}-\\x{ff}]+[.,;:!?]$"


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, ASCII letters in lower case, and where each text's words start.

    Words end at ASCII white space only; any other white space stays within a word for the
    tokenizer to drop.  A null text has no words.  A text that spells a special token keeps its case.
    """
    texts = pc.fill_null(texts, "")
    lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(lower)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = np.asarray(pc.greater(pc.binary_length(values), 0), dtype=bool)
    if full.all():
        return values, offsets
    before = np.concatenate([[0], np.cumsum(full)])
    return values.filter(pa.array(full)), before[offsets]


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@functools.lru_cache(maxsize=4)
def fitting(path: str) -> str:
    """The path, if the tokenizer's white-space words are independent and case does not count; else a ValueError.

    It has to lower the case, to drop white space before it merges, to end words by a mark, and to have no
    decoder and no step after the merges: what ``split`` and ``encode_words`` rely on.
    """
    import json

    with open(path, encoding="utf-8") as f:
        d = json.load(f)

    def parts(x: dict | None, name: str) -> list[dict]:
        return [] if x is None else x.get(name, [x])

    lowers = any(x["type"] == "Lowercase" for x in parts(d["normalizer"], "normalizers"))
    before = parts(d["pre_tokenizer"], "pretokenizers")
    drops = any(x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"] for x in before) and not any(x.get("add_prefix_space") for x in before)
    model = d["model"]
    if not (lowers and drops and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout") and d["decoder"] is None and d["post_processor"] is None):
        raise ValueError(f"not a lower-casing word tokenizer that drops white space: {path}")
    return path


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> list[str]:
    """Pieces by id; an id without a piece has an empty one."""
    known = tokenizer(path).get_vocab(with_added_tokens=True)
    pieces = [""] * (max(known.values()) + 1)
    for piece, i in known.items():
        pieces[i] = piece
    return pieces


@functools.lru_cache(maxsize=4)
def _last_of_word(path: str) -> np.ndarray:
    return np.array([p.endswith("</w>") for p in vocabulary(path)])


def encode_words(path: str, words: pa.Array) -> pa.ListArray:
    """The ids of each word, encoded on its own by the tokenizer."""
    n, tok = len(words), tokenizer(path)
    plain = np.asarray(pc.match_substring_regex(words, PLAIN), dtype=bool)
    lengths, parts, order = np.zeros(n, dtype=np.int64), [], []
    for chosen, joined in ((np.flatnonzero(plain), True), (np.flatnonzero(~plain), False)):
        for at in range(0, len(chosen), 20_000):
            own = chosen[at : at + 20_000]
            text = words.take(pa.array(own)).to_pylist()
            if joined:  # one call for many words: a word ends with the piece that says so
                ids = np.array(tok.encode(" ".join(text), add_special_tokens=False).ids, dtype=np.uint32)
                ends = np.flatnonzero(_last_of_word(path)[ids]) + 1
                if len(ends) == len(own) and ends[-1] == len(ids):
                    lengths[own] = np.diff(ends, prepend=0)
                    parts.append(ids)
                    order.append(own)
                    continue
            found = [e.ids for e in tok.encode_batch(text, add_special_tokens=False)]
            lengths[own] = [len(x) for x in found]
            parts.append(np.array([i for x in found for i in x], dtype=np.uint32))
            order.append(own)
    if not parts:
        return pa.ListArray.from_arrays(pa.array([0], pa.int32()), pa.array([], pa.uint32()))
    own = np.concatenate(order)
    taken = np.concatenate([[0], np.cumsum(lengths[own])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(taken), pa.array(np.concatenate(parts)))
    back = np.empty(n, dtype=np.int64)
    back[own] = np.arange(n)
    return lists.take(pa.array(back))


class Encoder:
    """Ids of texts, with a dictionary of the words met so far that is emptied at ``most_bytes``."""

    def __init__(self, path: str, most_bytes: int = 16 << 20):
        fitting(path)
        self.path, self.most_bytes = path, most_bytes
        self._empty()

    def _empty(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = encode_words(self.path, self.words)

    def _ids_of(self, stems: pa.Array) -> pa.ListArray:
        """Ids of distinct stems."""
        if self.words.nbytes + self.ids.nbytes > self.most_bytes:
            self._empty()
        at = pc.index_in(stems, self.words)
        if at.null_count:
            new = stems.filter(pc.is_null(at))
            at = pc.fill_null(at, 0).to_numpy().copy()
            at[np.asarray(pc.is_in(stems, new))] = np.arange(len(self.words), len(self.words) + len(new))
            self.ids = pa.concat_arrays([self.ids, encode_words(self.path, new)])
            self.words = pa.concat_arrays([self.words, new])
            at = pa.array(at)
        return self.ids.take(at)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids start."""
        words, offsets = split(texts)
        coded = words.dictionary_encode()
        lists = self.of_distinct(coded.dictionary)
        return spread(lists, np.asarray(coded.indices, dtype=np.int64), offsets)

    def of_distinct(self, words: pa.Array) -> pa.ListArray:
        """A mark at the end of a plain word is a unit of its own: the word's ids, then the mark's."""
        marked = np.asarray(pc.match_substring_regex(words, PLAIN_AND_MARK), dtype=bool)
        stems = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(words, 0, -1), words)
        marks = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(words, -1), pa.scalar(""))
        a, b = stems.dictionary_encode(), marks.dictionary_encode()
        stem_ids = self._ids_of(a.dictionary).take(a.indices)
        if not marked.any():
            return stem_ids
        mark_ids = self._ids_of(b.dictionary).take(b.indices)
        both = pa.concat_arrays([stem_ids, mark_ids])
        n = len(words)
        turn = np.empty(2 * n, dtype=np.int64)
        turn[0::2], turn[1::2] = np.arange(n), np.arange(n, 2 * n)
        mixed = both.take(pa.array(turn))
        ends = np.asarray(mixed.offsets)[::2]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), mixed.values)


def spread(lists: pa.ListArray, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists that ``codes`` name, one after the other, and where each text's part starts.

    Text i has the codes from offsets[i] to offsets[i + 1].
    """
    if not len(codes):
        return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
    lengths = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    taken = lists.take(pa.array(codes))
    starts = np.concatenate([[0], np.cumsum(lengths[codes])])
    return np.asarray(taken.flatten(), dtype=np.uint32), starts[offsets]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's own encoder; a reused worker keeps the words that it has met."""
    return Encoder(path)
