"""Operator 12: runs of words that repeat with a period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of at least
``LEAST`` words and ``TIMES`` periods, that no neighbouring word extends with that period.

The words are gone through in order by a dynamic programme on diagonals: a word's earlier occurrence at lag d
makes the diagonal d one longer, and a diagonal that ends with enough matches gives a run at once.  It is sparse in
two ways that lose no run.  A run with period q has 2q matches in a row and 16 at least.  So, with W the least of 16, 32,
64, ... that is not below q, its matches hold W words in a row that also occur q words before; and no nearer occurrence
of those W words can be less than q words away, or the run would have a smaller period.  Thus for each W a word has one
active lag, that of the nearest earlier occurrence of the W words that start with it, and lags that are no multiple of
anything are not tried: n log n steps for a text of n words, where counting all earlier occurrences of frequent words
would take n^2.  Occurrences are told by names of 1, 2, 4, ... words, put together from names of half as many, so
there is no hash that could collide.

A text's words are handled in one task: 16 M words (about 100 MB of text) take about 2 GB.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysieve.llm import cuts, shared

#: Least words and least periods of a run.
LEAST, TIMES = 24, 3
_FIRST = 16
BLANKS = cuts.Signs.of(b" \t\n\v\f\r")
#: The same in a regular expression.
BLANK = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Runs:
    """Text number, first word (within the text), words and period of each run, by text, start and period."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names 0, 1, ... of equal keys, and which keys occur twice or more."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts[names] > 1


def _diagonals(at: np.ndarray, names: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, matches and lag of the diagonals of lags up to ``width`` (from half of it on, but for the least width).

    ``at`` has the first words of all stretches of ``width`` words that occur twice, ascending, with their names.
    """
    order = np.argsort(names, kind="stable")
    lag = np.zeros(len(at), dtype=np.int64)
    same = names[order[1:]] == names[order[:-1]]
    lag[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
    active = (lag > (width // 2 if width > _FIRST else 0)) & (lag <= width)
    at, lag = at[active], lag[active]
    if not len(at):
        return at, at, lag
    # a diagonal goes on where the next word has the same lag, and ends elsewhere
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(lag) != 0)]))
    ends = np.append(begins[1:], len(at)) - 1
    return at[begins], at[ends] - at[begins] + width, lag[begins]


def runs_of(codes: np.ndarray, offsets: np.ndarray) -> Runs:
    """The runs of texts whose words are ``codes``; text i has those from offsets[i] to offsets[i + 1]."""
    lengths = np.diff(offsets)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    found = []
    if len(codes):
        # a word is told apart from the same word of another text, so that no diagonal leaves its text
        names, twice = _named(text_of * (int(codes.max()) + 1) + codes)
        at, names = np.flatnonzero(twice), names[twice]
        width = 1
        while len(at) and 2 * width <= max(_FIRST, lengths.max()):
            after = np.searchsorted(at, at + width)
            after[after == len(at)] = 0
            both = at[after] == at + width
            at, names = at[both], names[both] * (len(codes) + 1) + names[after[both]]
            names, twice = _named(names)
            at, names = at[twice], names[twice]
            width *= 2
            if width >= _FIRST and len(at):
                first, matches, lag = _diagonals(at, names, width)
                enough = matches + lag >= np.maximum(LEAST, TIMES * lag)
                found.append((first[enough] - lag[enough], matches[enough] + lag[enough], lag[enough]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Runs(none, none, none, none)
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    text = text_of[start]
    start = start - offsets[text]
    order = np.lexsort((period, start, text))
    return Runs(text[order], start[order], length[order], period[order])


def _kept(runs: Runs, offsets: np.ndarray) -> np.ndarray:
    """Which words no run contains after its first period."""
    edge = np.zeros(offsets[-1] + 1, dtype=np.int64)
    base = offsets[runs.text] + runs.start
    np.add.at(edge, base + runs.period, 1)
    np.add.at(edge, base + runs.length, -1)
    return np.cumsum(edge[:-1]) == 0


def _found(texts: pa.Array) -> list[pa.Array]:
    """n_words, runs and collapsed text of each text."""
    own = cuts.cut(texts, BLANKS)
    offsets = own.offsets.astype(np.int64)
    codes = np.asarray(own.words.dictionary_encode().indices, dtype=np.int64)
    runs = runs_of(codes, offsets)
    kept = _kept(runs, offsets)
    before = np.concatenate([[0], np.cumsum(kept)])
    words = own.words if kept.all() else own.words.filter(pa.array(kept))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(before[offsets].astype(np.int32)), words), " ")
    rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (runs.start, runs.length, runs.period)], ["start", "length", "period"])
    edges = np.searchsorted(runs.text, np.arange(len(offsets)))
    return [pa.array(np.diff(offsets), pa.int64()), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), rows), collapsed]


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start, then period) and collapsed text of every text.

    In ``collapsed`` each run has its first period only; words that any run contains after its first period are gone,
    and one space stands between words.  A null or empty text has no words and no runs, and an empty collapsed text.
    Equal texts give equal rows; repeated rows and null or repeated ids stay rows of their own.  A text of any length is
    read whole.  An empty table gives an empty one.  Other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def found(batches):
        for batch in batches:
            for own in shared.slices(batch, "text", most_bytes=2 << 20):
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), *_found(own.column("text"))], ["doc_id", "n_words", "runs", "collapsed"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(found, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts goes on periodically from some word on.

    With h the crc32 of the id in decimal and g = h div 10, a text of n words is rewritten where h mod 10 is 0: each word
    i from a = g mod n on becomes word a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8).  A null id rewrites nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, BLANK), "")
    return docs.select(
        "doc_id",
        F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), _rewritten(words, F.floor(h / 10))).otherwise(text).alias("text"),
    )


def _rewritten(words: Column, g: Column) -> Column:
    def of(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        turned = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.array_join(turned, " ")

    # the words are split once, whatever uses them
    return F.element_at(F.transform(F.array(words), of), 1)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties go to the smallest start, then period.  Null without runs."""
    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def runs_text(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
