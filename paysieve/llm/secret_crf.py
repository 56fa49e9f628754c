"""Operator 11: secrets by fixed patterns and by a linear-chain conditional random field.

Texts are cut into tokens: runs of letters, digits and underscores, and all other signs one by one.  A field with the
states outside, begin and inside scores each token by its shape, the two tokens on either side and
features of the file (how much of it is digits, punctuation, assignments), and pairs of neighbouring states by a table.
It is trained here, by the gradient of its log-likelihood, on windows of at most ``WINDOWS`` secrets that the patterns find and
as many windows of other text; that sample is bounded, whatever the input.  Since the patterns know few shapes,
the same windows are learned again with other values in the secret's place, and without the word before it.

Tagging finds the best sequence of states of whole texts (Viterbi): the texts of a slice are one chain, cut into
pieces that are worked on side by side, exactly.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm import shared, shingles

# fixed values: the patterns, by kind in their order, and the least characters of a match or of its value
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: For Arrow's linear-time engine: every text with a match that is long enough has one of these.
_HINTS = {
    "assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
}
#: The field's own kind, after the patterns'.
FIELD = "crf"
#: Windows of text with a secret, and as many without, that teach the field.
WINDOWS = 256
_AROUND = 100

OUT, BEGIN, INSIDE = 0, 1, 2


@dataclass(frozen=True, order=True)
class Span:
    """Code points, the end exclusive.  Of an assignment, the value alone is from ``value`` on."""

    start: int
    order: int
    end: int
    value: int

    @property
    def kind(self) -> str:
        return (*KINDS, FIELD)[self.order]


def base_spans(text: str, kinds: tuple[str, ...] = KINDS) -> list[Span]:
    """The patterns' leftmost matches, not overlapping within a kind, without those that are too short."""
    out = []
    for kind in kinds:
        # a run of hex digits is as long as it can be, so short ones need no look
        pattern = re.compile(r"[0-9a-f]{24,}") if kind == "hex" else PATTERNS[kind]
        for m in pattern.finditer(text):
            value = m.start(2) if kind == "assign" else m.start()
            if m.end() - value >= LEAST[kind]:
                out.append(Span(m.start(), KINDS.index(kind), m.end(), value))
    return sorted(out)


# --- tokens and their features


_SIGN, _WORD = 1, 2
_CLASS = np.full(256, _SIGN, dtype=np.uint8)
_CLASS[[*b" \t\n\v\f\r"]] = 0
_CLASS[[*b"0123456789_abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]] = _WORD
_DIGIT, _LOWER, _UPPER, _HEX = (np.isin(np.arange(256), list(x)) for x in (b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789abcdef"))
_SORT = np.select([_DIGIT, _LOWER, _UPPER], [1, 2, 3], 0).astype(np.uint8)

_SIZES = np.array([2, 3, 4, 5, 7, 9, 13, 17, 21, 25, 33, 41, 65])
_LEXICAL, _SHAPES, _N = 1 << 14, 144, 14
#: Where each feature of a token begins in the weights' table; neighbours have the first two only.
_AT = np.cumsum([0, _LEXICAL, _SHAPES, _N * 5, _N * 2, _N * 5])
_GLUED, _FILE = int(_AT[-1]), (8, 8, 5)
_OF_FILE = _GLUED + 2 + np.cumsum([0, *_FILE])
N_SELF, N_NEAR = int(_OF_FILE[-1]), int(_AT[2]) + 1
_NOBODY = N_NEAR - 1


@dataclass(frozen=True)
class Tokens:
    """Distinct tokens' feature numbers, the tokens as numbers of distinct ones, and where they and the texts are in the bytes."""

    features: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    glued: np.ndarray
    of_file: np.ndarray
    data: np.ndarray
    edges: np.ndarray

    def point(self, text: int, byte: int) -> int:
        """The code point that a text has at a place in the bytes."""
        return int(np.count_nonzero(self.data[self.edges[text] : byte] & 0xC0 != 0x80))


def _distinct_features(words: pa.Array) -> np.ndarray:
    n = len(words)
    edges = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + n + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
    size = np.diff(edges)
    total = lambda flags: (c := np.concatenate([[0], np.cumsum(flags)]))[edges[1:]] - c[edges[:-1]]
    digits, lower, upper, hexes = (total(x[data]) for x in (_DIGIT, _LOWER, _UPPER, _HEX))
    sort = _SORT[data]
    turns = np.concatenate([[0], np.cumsum(sort[1:] != sort[:-1])]) if len(data) else np.zeros(1, np.int64)
    changes = turns[edges[1:] - 1] - turns[edges[:-1]]
    first = data[edges[:-1]]
    sign = (size == 1) & (_CLASS[first] == _SIGN)
    shape = np.where(sign, 16 + np.minimum(first, 127), (digits > 0) + 2 * (lower > 0) + 4 * (upper > 0) + 8 * (digits + lower + upper < size))
    long = np.searchsorted(_SIZES, size, side="right")
    share = np.select([digits == 0, 4 * digits < size, 2 * digits < size, digits < size], [0, 1, 2, 3], 4)
    mixed = np.select([changes == 0, 7 * changes < size, 4 * changes < size, 2 * changes < size], [0, 1, 2, 3], 4)
    short = size <= 12
    lexical = np.where(short, shingles.hashed(pc.ascii_lower(words)) % np.uint64(_LEXICAL - 1) + np.uint64(1), 0).astype(np.int64)
    return np.stack([lexical, _AT[1] + shape, _AT[2] + long * 5 + share, _AT[3] + long * 2 + (hexes == size), _AT[4] + long * 5 + mixed], axis=1)


def tokens_of(texts: pa.Array) -> Tokens:
    n = len(texts)
    edges = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    kind = _CLASS[data]
    begins = kind > 0
    begins[1:] &= (kind[1:] == _SIGN) | (kind[:-1] != _WORD)
    inner = edges[:-1][edges[:-1] < len(data)]
    begins[inner] = kind[inner] > 0
    starts = np.flatnonzero(begins)
    full = kind > 0
    kept = np.concatenate([[0], np.cumsum(full)])
    cuts = np.append(kept[starts], kept[-1])
    ends = starts + np.diff(cuts)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data[full])])
    coded = words.dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    features = _distinct_features(shared.as_array(coded.dictionary)) if len(codes) else np.zeros((0, 5), np.int64)
    offsets = np.searchsorted(starts, edges)
    glued = np.zeros(len(starts), dtype=np.int64)
    glued[1:] = starts[1:] == ends[:-1]
    glued[offsets[:-1][offsets[:-1] < len(starts)]] = 0
    # the file's features: shares of tokens with digits and of signs, and its assignments
    shape = features[:, 1] - _AT[1]
    count = np.maximum(1, np.diff(offsets))
    of = lambda flags: (c := np.concatenate([[0], np.cumsum(flags[codes])]))[offsets[1:]] - c[offsets[:-1]]
    eighth = lambda part: np.minimum(7, np.ceil(-np.log2(np.maximum(part / count, 1e-9)))).astype(np.int64)
    digits, signs, assigned = of((shape < 16) & (shape & 1 > 0)), of(shape >= 16), of(np.isin(shape, [16 + ord("="), 16 + ord(":")]))
    of_file = np.stack([_OF_FILE[0] + eighth(digits), _OF_FILE[1] + eighth(signs), _OF_FILE[2] + np.minimum(4, np.ceil(np.log2(1 + assigned))).astype(np.int64)], axis=1)
    return Tokens(features, codes, starts, ends, offsets, glued, of_file, data, edges)


# --- the field


@dataclass(frozen=True)
class Model:
    """Weights by feature and state of the token itself and of the four around it (two before, two after), of pairs of states, and of the first state."""

    own: np.ndarray
    near: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    @classmethod
    def empty(cls) -> Model:
        # the prior of a field that has learned nothing: all is outside
        first = np.array([0.0, -8.0, -8.0])
        return cls(np.zeros((N_SELF, 3)), np.zeros((4, N_NEAR, 3)), np.zeros((3, 3)), first)


_STEPS = (-1, -2, 1, 2)


def _neighbours(t: Tokens) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of the four places: which tokens have one there, and its number."""
    n = len(t.codes)
    text = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))
    at = np.arange(n)
    for k, step in enumerate(_STEPS):
        there = at + step
        inside = (there >= 0) & (there < n)
        inside[inside] = text[there[inside]] == text[inside]
        yield k, inside, there


def unary(t: Tokens, m: Model) -> np.ndarray:
    """Each token's score in each state."""
    own = m.own[t.features].sum(axis=1)
    files = m.own[t.of_file].sum(axis=1)
    out = own[t.codes] + m.own[_GLUED + t.glued] + np.repeat(files, np.diff(t.offsets), axis=0)
    for k, inside, there in _neighbours(t):
        table = np.concatenate([m.near[k][t.features[:, :2]].sum(axis=1), m.near[k][_NOBODY][None]])
        out += table[np.where(inside, t.codes[np.where(inside, there, 0)], len(table) - 1)]
    return out


def best_states(scores: np.ndarray, offsets: np.ndarray, m: Model, piece: int = 256) -> np.ndarray:
    """The best sequence of states of every text: one chain, where a text's first token does not depend on what was before."""
    n = len(scores)
    if not n:
        return np.zeros(0, dtype=np.int8)
    pieces = -(-n // piece)
    full = np.zeros((pieces * piece, 3))
    full[:n] = scores
    fresh = np.zeros(pieces * piece, dtype=bool)
    fresh[offsets[:-1][offsets[:-1] < n]] = True
    fresh[n:] = True  # what fills the last piece is a text of its own
    full, fresh = full.reshape(pieces, piece, 3).transpose(1, 0, 2), fresh.reshape(pieces, piece).T
    first = np.broadcast_to(m.first, (3, 3))
    moves = np.stack([m.pairs, first])[fresh.astype(np.int64)]  # step, piece, from, to
    # what each piece adds to each state that it is entered from
    through = np.where(np.eye(3, dtype=bool), 0.0, -np.inf)[None].repeat(pieces, axis=0)
    for s in range(piece):
        through = (through[:, :, :, None] + moves[s][:, None]).max(axis=2) + full[s][:, None]
    entered = np.zeros((pieces, 3))
    for k in range(pieces - 1):
        after = (entered[k][:, None] + through[k]).max(axis=0)
        entered[k + 1] = after - after.max()
    back = np.empty((piece, pieces, 3), dtype=np.int8)
    score = entered
    for s in range(piece):
        every = score[:, :, None] + moves[s]
        back[s] = every.argmax(axis=1)
        score = every.max(axis=1) + full[s]
    # from each state that a piece could end in back to its start, then the right one from the last piece on
    traced = np.empty((piece, pieces, 3), dtype=np.int8)
    state = np.tile(np.arange(3, dtype=np.int8), (pieces, 1))
    for s in range(piece - 1, -1, -1):
        traced[s] = state
        state = np.take_along_axis(back[s], state.astype(np.int64), axis=1)
    ends = np.empty(pieces, dtype=np.int64)
    ends[-1] = score[-1].argmax()
    for k in range(pieces - 1, 0, -1):
        ends[k - 1] = state[k, ends[k]]
    return np.take_along_axis(traced, ends[None, :, None], axis=2)[:, :, 0].T.ravel()[:n]


def spans_of(t: Tokens, states: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """By text: the code points of what is tagged; what is inside without a begin before it begins there."""
    text = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))
    tagged = np.flatnonzero(states != OUT)
    out: dict[int, list[tuple[int, int]]] = {}
    if not len(tagged):
        return out
    new = np.concatenate([[True], (np.diff(tagged) != 1) | (states[tagged[1:]] == BEGIN) | (text[tagged[1:]] != text[tagged[:-1]])])
    begins = np.flatnonzero(new)
    lasts = np.append(begins[1:], len(tagged)) - 1
    for a, b in zip(tagged[begins].tolist(), tagged[lasts].tolist(), strict=True):
        k = int(text[a])
        start = t.point(k, int(t.starts[a]))
        out.setdefault(k, []).append((start, start + int(np.count_nonzero(t.data[t.starts[a] : t.ends[b]] & 0xC0 != 0x80))))
    return out


# --- learning


def fitted(texts: list[str], places: list[list[tuple[int, int]]], *, rounds: int = 40, step: float = 0.15, decay: float = 1e-3) -> Model:
    """Weights that make the states of the texts likely: full gradients, with steps by their running mean and size (Adam)."""
    t = tokens_of(pa.array(texts, pa.string()))
    want = states_at(t, places)
    sizes = np.diff(t.offsets)
    width = int(sizes.max(initial=0))
    if not width or not want.any():
        return Model.empty()
    row, at = np.repeat(np.arange(len(texts)), sizes), np.arange(len(want)) - np.repeat(t.offsets[:-1], sizes)
    there = np.zeros((len(texts), width), dtype=bool)
    there[row, at] = True
    one = np.eye(3)[want]
    m = Model(np.zeros((N_SELF, 3)), np.zeros((4, N_NEAR, 3)), np.zeros((3, 3)), np.zeros(3))
    weights = (m.own, m.near, m.pairs, m.first)
    mean, square = ([np.zeros_like(x) for x in weights] for _ in range(2))
    follows = there[:, 1:]
    paired = np.zeros((3, 3))
    np.add.at(paired, (want[:-1][at[1:] > 0], want[1:][at[1:] > 0]), 1)
    own_features = np.concatenate([t.features[t.codes], (_GLUED + t.glued)[:, None], np.repeat(t.of_file, sizes, axis=0)], axis=1)
    near_features = [np.where(inside[:, None], t.features[t.codes[np.where(inside, where, 0)], :2], _NOBODY) for _, inside, where in _neighbours(t)]

    def summed(features: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(features.ravel(), np.repeat(rest[:, s], features.shape[1]), minlength=n)[:n] for s in range(3)], axis=1)

    for turn in range(1, rounds + 1):
        u = np.zeros((len(texts), width, 3))
        u[row, at] = m.own[own_features].sum(axis=1) + sum(m.near[k][f].sum(axis=1) for k, f in enumerate(near_features))
        a, b = np.zeros_like(u), np.zeros_like(u)
        a[:, 0] = m.first + u[:, 0]
        add = lambda x, axis: (top := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - top).sum(axis=axis))
        for i in range(1, width):
            a[:, i] = np.where(there[:, i, None], add(a[:, i - 1, :, None] + m.pairs, 1) + u[:, i], a[:, i - 1])
        for i in range(width - 2, -1, -1):
            b[:, i] = np.where(there[:, i + 1, None], add(m.pairs + (u[:, i + 1] + b[:, i + 1])[:, None], 2), 0.0)
        total = add(a[:, -1], 1)
        p = np.exp(np.minimum(0.0, a + b - total[:, None, None]))[row, at]
        both = np.exp(np.minimum(0.0, a[:, :-1, :, None] + m.pairs + (u[:, 1:] + b[:, 1:])[:, :, None] - total[:, None, None, None]))
        rest = one - p
        head = rest[at == 0].sum(axis=0)
        grads = [summed(own_features, rest, N_SELF), np.stack([summed(f, rest, N_NEAR) for f in near_features]), paired - both[follows].sum(axis=0), head]
        for x, g, g1, g2 in zip(weights, grads, mean, square, strict=True):
            g = g - decay * len(texts) * x
            g1 += 0.1 * (g - g1)
            g2 += 0.01 * (g * g - g2)
            x += step * (g1 / (1 - 0.9**turn)) / (np.sqrt(g2 / (1 - 0.99**turn)) + 1e-8)
    return m


_ALPHABETS = ("0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789_-")


def varied(windows: list[str], others: list[str], least: int = 3 * WINDOWS) -> tuple[list[str], list[list[tuple[int, int]]]]:
    """Texts with the places of their secrets: the windows, and at least ``least`` variants of them (three a window or more).

    A variant has another value, stands in its own or in another window, and is named as it was, by another name, or not at all.
    """
    texts, places = [], []
    for w in windows:
        spans = base_spans(w)
        texts.append(w)
        places.append(sorted({(s.value, s.end) for s in spans}))
        if len(places[-1]) != 1:
            continue
        rng = random.Random(zlib.crc32(w.encode("utf-8", "surrogatepass")))
        (a, b), start = places[-1][0], min(s.start for s in spans)
        for k in range(max(3, least // len(windows))):
            letters = rng.choice(_ALPHABETS)
            value = "".join(rng.choice(letters) for _ in range(rng.randrange(20, 48)))
            before, after = w[:start], w[b:]
            if k % 2 and others:
                other = rng.choice(others)
                at = other.find(" ", rng.randrange(len(other))) + 1
                before, after = other[:at], " " + other[at:]
            name = w[start:a]
            if k % 3 == 1:
                name = "".join(rng.choice(_ALPHABETS[1]) for _ in range(rng.randrange(2, 9))) + rng.choice(["=", ": ", " = "])
                after = after.lstrip("\"'")
            elif k % 3 == 2:
                name = ""
            texts.append(before + name + value + after)
            places.append([(len(before + name), len(before + name + value))])
    return texts, places


def states_at(t: Tokens, places: list[list[tuple[int, int]]]) -> np.ndarray:
    """The states of texts whose secrets are at these code points."""
    states = np.zeros(len(t.codes), dtype=np.int64)
    for k, own in enumerate(places):
        for start, end in own:
            points = np.concatenate([[0], np.cumsum(t.data[t.edges[k] : t.edges[k + 1]] & 0xC0 != 0x80)])
            mine = np.arange(t.offsets[k], t.offsets[k + 1])
            inside = mine[(points[t.starts[mine] - t.edges[k]] < end) & (points[t.ends[mine] - t.edges[k]] > start)]
            if len(inside):
                states[inside] = INSIDE
                states[inside[0]] = BEGIN
    return states


def _window(text: str, a: int, b: int) -> str:
    """Text around a place, cut at white space where there is some."""
    start, end = max(0, a - _AROUND), min(len(text), b + _AROUND)
    while 0 < start < a and not text[start - 1].isspace():
        start += 1
    while b < end < len(text) and not text[end].isspace():
        end -= 1
    return text[start:end]


def _hinted(texts: pa.Array) -> dict[str, np.ndarray]:
    return {kind: np.asarray(pc.match_substring_regex(texts, hint), dtype=bool) for kind, hint in _HINTS.items()}


def _window_rows(batches):
    """Windows with a secret, and one other window of each text at a place that a hash chooses."""
    for batch in batches:
        for own in shared.slices(batch, "text"):
            texts = own.column("text")
            hints = _hinted(texts)
            any_hint = np.logical_or.reduce(list(hints.values()))
            found = []
            for i in range(len(texts)):
                text = texts[i].as_py()
                spans = base_spans(text, tuple(k for k in KINDS if hints[k][i])) if any_hint[i] else []
                found += [(True, _window(text, s.value, s.end)) for s in spans if s.end - s.value <= 4 * _AROUND]
                at = zlib.crc32(texts[i].as_buffer()[:4096]) % (len(text) + 1)
                plain = _window(text, at, at)
                if plain and not base_spans(plain):
                    found.append((False, plain))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found]), pa.array([w for _, w in found], pa.string())], ["secret", "window"])


def learn(docs: DataFrame, *, text_col: str = "text", most: int = WINDOWS) -> Model:
    """A field from at most ``most`` distinct windows with a secret and as many without, those with the least hashes.

    Without any secret the field finds none.
    """
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("text <> ''")
    windows = texts.mapInArrow(_window_rows, "secret boolean, window string").withColumn("h", F.xxhash64("window"))
    distinct = windows.groupBy("secret", "h").agg(F.min("window").alias("window"))
    least = distinct.withColumn("at", F.row_number().over(Window.partitionBy("secret").orderBy("h"))).where(F.col("at") <= most)
    rows = sorted((r.at, r.window, r.secret) for r in least.select("at", "window", "secret").collect())
    secrets, others = ([w for _, w, s in rows if s == kind] for kind in (True, False))
    if not secrets:
        return Model.empty()
    texts, places = varied(secrets, others)
    return fitted(texts + others, places + [[] for _ in others])


# --- scanning


def _scanned(texts: pa.Array, m: Model, least: int) -> list[list[Span]]:
    hints = _hinted(texts)
    t = tokens_of(texts)
    tagged = spans_of(t, best_states(unary(t, m), t.offsets, m))
    out: list[list[Span]] = [[] for _ in range(len(texts))]
    for i in np.flatnonzero(np.logical_or.reduce(list(hints.values()))).tolist():
        out[i] = base_spans(texts[i].as_py(), tuple(k for k in KINDS if hints[k][i]))
    for i, spans in tagged.items():
        own = out[i]
        new = [Span(a, len(KINDS), b, a) for a, b in spans if b - a >= least and not any(s.start < b and a < s.end for s in own)]
        out[i] = sorted(own + new)
    return out


def scan(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", least: int = 8) -> DataFrame:
    """doc_id and ``spans`` (array of kind, start, end, value: code points, ends exclusive) of every text.

    Spans are by start, then kind: ``assign``, ``access`` and ``hex`` of the patterns, then ``crf``: what the field tags, of
    ``least`` characters or more, and no pattern covers in part.  ``value`` is where an assignment's value starts.

    A null or empty text has no spans.  Repeated rows and null or repeated ids stay rows of their own.  A text of any
    length is read whole.  An empty table gives an empty one.  Other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its size is that of the tables of weights

    def found(batches):
        for batch in batches:
            for own in shared.slices(batch, "text", most_bytes=2 << 20):
                spans = _scanned(shared.as_array(own.column("text")), sent.value, least)
                flat = [s for x in spans for s in x]
                rows = pa.StructArray.from_arrays([pa.array([s.kind for s in flat], pa.string()), *(pa.array([getattr(s, c) for s in flat], pa.int64()) for c in ("start", "end", "value"))], ["kind", "start", "end", "value"])
                edges = np.concatenate([[0], np.cumsum([len(x) for x in spans])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), pa.ListArray.from_arrays(pa.array(edges), rows)], ["doc_id", "spans"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(found, f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long, value: long>>")
