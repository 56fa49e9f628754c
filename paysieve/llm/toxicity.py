"""Operator 8: toxicity by a weighted lexicon, matched by an Aho-Corasick automaton.

Texts are folded first: look-alike letters, digits and signs that stand for letters become plain
letters, accents are composed, invisible marks go.  Matching takes i, l and 1 for one letter, and also reads texts
without accents, and with 2, 6, 9 and signs between letters as letters.  The lexicon is learned from labelled rows: word beginnings that toxic
texts have far more often, with log-odds weights.  Matches within an exception phrase do not count.
The matched weight, divided by the text's words, gives the score through a logistic curve.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysieve.llm import shared

#: Signs that are read as the letter below them.
_LOOKS = (
    "0134578@$" + "абвгеёзикмнопрстухіјѕԁԛԝ" + "αβγεικνορτυχ" + "ı",
    "oieastbas" + "abbreezukmhonpctyxijsdqw" + "abyeikvoptux" + "i",
)
_FOLD = dict(zip(*_LOOKS, strict=True))
_GONE = dict.fromkeys(map(chr, [0xAD, 0x34F, *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF]), "")
_MARKS = dict.fromkeys(map(chr, range(0x300, 0x370)), "")
#: Digits and signs that are letters in some texts and not in others, which are read both ways.
_DIGITS = tuple({"2": "z", "6": six, "9": "g"} for six in "gb")
_BETWEEN = re.compile(r"[!|]+")

_WORD = re.compile(r"[^\W\d_]+")

#: Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = ("trash can", "clown fish", "pond scum")


def _swapped(text: str, letters: dict[str, str]) -> str:
    """Like translate, but quick where few of the letters occur.  What they become is none of them."""
    for c in letters.keys() & set(text):
        text = text.replace(c, letters[c])
    return text


def fold(text: str) -> str:
    """Lower case, composed, with look-alikes and digits read as letters."""
    if not text.isascii():
        text = _swapped(unicodedata.normalize("NFKC", _swapped(text, _GONE)).lower(), _MARKS)
    return _swapped(text.lower(), _FOLD)


@functools.lru_cache(maxsize=1 << 16)
def _bare_letter(letter: str) -> str:
    own = _swapped(unicodedata.normalize("NFC", _swapped(unicodedata.normalize("NFD", letter), _MARKS)), _FOLD)
    return own if len(own) == 1 else letter


def _bare(own: str) -> str:
    """The folded text's letters without their accents; one letter for one, so that places stay."""
    for c in set(own):
        if c > "\x7f" and (to := _bare_letter(c)) != c:
            own = own.replace(c, to)
    return own


def _signs(own: str) -> str:
    """The text with ! and | between letters read as i."""
    def read(m: re.Match) -> str:
        inner = own[m.start() - 1 : m.start()].isalnum() and own[m.end() : m.end() + 1].isalnum()
        return "i" * len(m[0]) if inner else m[0]

    return _BETWEEN.sub(read, own) if "!" in own or "|" in own else own


def readings(text: str) -> list[str]:
    """The text folded, as it is and without loose marks or any accents, with its signs as such and as letters; in the automaton's letters."""
    own = fold(text)
    out = [own]
    if not text.isascii():
        loose = _swapped(text, _MARKS)
        out = list(dict.fromkeys([own, *([fold(loose)] if loose != text else []), _bare(own)]))
    signs = [_signs(_swapped(x, digits)) for x in out for digits in (_DIGITS if "6" in own else _DIGITS[:1])]
    return [x.replace("l", "i") for x in dict.fromkeys(out + signs)]


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -3.0
    slope: float = 2.0
    _automaton: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for phrase in self.exceptions:
                own = fold(phrase).replace("l", "i")
                self._automaton.add_word(own, (len(own), None))
            # of words that are one to the automaton, the heaviest
            for word, weight in sorted(self.weights.items(), key=lambda x: x[1]):
                own = fold(word).replace("l", "i")
                self._automaton.add_word(own, (len(own), weight))
            self._automaton.make_automaton()
        return self._automaton

    def density(self, text: str) -> float:
        """log(1 + matched weight in a thousand words), as if the text had 50 words more: one weak word in a few is no proof."""
        own = fold(text)
        found, spared = set(), set()
        automaton = self.automaton()
        for read in readings(text) if len(automaton) else ():
            for end, (length, weight) in automaton.iter(read):
                start = end - length + 1
                if start and read[start - 1].isalpha():
                    continue
                (spared if weight is None else found).add((start, end + 1, weight))
        if spared:
            found = {m for m in found if not any(a <= m[0] and m[1] <= b for a, b, _ in spared)}
        total = math.fsum(m[2] for m in found)
        return math.log1p(1000 * total / (50 + len(own.split()))) if total else 0.0

    def score(self, density: float) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.bias + self.slope * density))))


def learn(labelled: DataFrame, *, most_rows: int | None = 20_000, shortest: int = 4, longest: int = 10, least_docs: int = 5, text_col: str = "text", label_col: str = "label", order: Column | None = None) -> Lexicon:
    """A lexicon from at most ``most_rows`` labelled rows, taken in the order of a hash; None takes a sample as it is.

    Candidates: beginnings of ``shortest`` to ``longest`` letters of folded words in ``least_docs`` unlike toxic
    texts at least; those stay whose log-likelihood ratio against the share of toxic rows is beyond what
    the best of so many candidates would reach by chance.  Rows with a null text or label teach nothing.  Without rows of both
    labels the lexicon is empty and every score is the curve's lowest.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), (order if order is not None else F.xxhash64(text_col)).alias("o"))
    if most_rows is not None:
        rows = rows.orderBy("o", "text", "label").limit(most_rows)
    sample = shared.written(rows.select("text", "label"), "toxicity-sample")

    def first_uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text's distinct words, with the words around the first use."""
        for batch in (part for whole in batches for part in shared.slices(whole, "text")):
            out, around, spelt, labels = [], [], [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                plain = _WORD.findall(fold(text))
                own = [w.replace("l", "i") for w in plain]
                first = dict(zip(reversed(own), range(len(own) - 1, -1, -1), strict=True))
                out += first
                around += [zlib.crc32(" ".join(own[max(0, i - 1) : i + 2]).encode()) for i in first.values()]
                spelt += [_places(plain[i]) for i in first.values()]
                labels += [label] * len(first)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(around, pa.int64()), pa.array(spelt, pa.int64()), pa.array(labels, pa.int32())], ["word", "around", "spelt", "label"])

    total = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, bad = total.get(0, 0), total.get(1, 0)
    if not good or not bad:
        return Lexicon({}, bias=-5.0)
    base = bad / (good + bad)
    # copies of a text use a word among the same others, and count once
    uses = sample.repartition(shared.partitions(sample.sparkSession)).mapInArrow(first_uses, "word string, around long, spelt long, label int").where(F.length("word") >= shortest).groupBy("word", "around", "label").agg(F.max("spelt").alias("spelt"))
    of_word = uses.groupBy("word").agg(F.sum("label").cast("long").alias("bad"), F.count("*").alias("n"), F.max("spelt").alias("spelt"))
    parts = F.transform(F.sequence(F.lit(shortest), F.least(F.lit(longest), F.length("word"))), lambda k: F.left("word", k))
    counts = of_word.select(F.explode(parts).alias("part"), "bad", "n", "spelt").groupBy("part").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.expr("max(spelt & (shiftleft(1L, length(part)) - 1))").alias("spelt")).where(f"bad >= {least_docs}")
    share = F.col("bad") / F.col("n")
    ratio = F.col("bad") * F.log(share / base) + F.when(share < 1, (F.col("n") - F.col("bad")) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    counts = shared.written(counts.where(share > base).select("part", "bad", "n", "spelt", ratio.alias("ratio")), "toxicity-counts")
    candidates = counts.count()
    kept: dict[str, tuple[int, int, int]] = {}
    # all that are beyond chance; they are beginnings of words of the bounded sample.  The best first, of equals the longest
    best = counts.where((F.col("ratio") > math.log(max(1, candidates)) + 2) & (F.col("bad") > 0.8 * F.col("n"))).orderBy(F.desc("ratio"), F.desc(F.length("part")), "part")
    for r in best.collect():
        if not any(r.part[:k] in kept for k in range(shortest, len(r.part) + 1)) and not any(k.startswith(r.part) for k in kept):
            kept[r.part] = (r.bad, r.n - r.bad, r.spelt)
    odds = math.log((good + 1) / (bad + 1))
    lexicon = Lexicon({_spelling(w, at): math.log((b + 0.5) / (g + 0.5)) + odds for w, (b, g, at) in kept.items()})

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in shared.slices(whole, "text")):
            x = [lexicon.density(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column("label")], ["x", "y"])

    seen = sample.mapInArrow(measured, "x double, y int").collect()  # two numbers of each sampled row
    lexicon.bias, lexicon.slope = logistic(np.array([r.x for r in seen]), np.array([r.y for r in seen]))
    return lexicon


def _places(word: str) -> int:
    """A bit for each l among the first letters, by which a word keeps a spelling that was met."""
    return sum(1 << i for i, c in enumerate(word[:62]) if c == "l") if "l" in word else 0


def _spelling(word: str, places: int) -> str:
    return "".join("l" if places >> i & 1 else c for i, c in enumerate(word))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[float, float]:
    """Bias and slope, at least 0, of a logistic curve; Newton steps with a small penalty on the slope."""
    b, s = 0.0, 1.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(b + s * x, -40, 40)))
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([(p - y).sum() + 1e-3 * b, ((p - y) * x).sum() + penalty * s])
        h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + penalty]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        b, s = b - step[0], max(0.0, s - step[1])
        if np.abs(step).max() < 1e-6:
            break
    return float(b), float(s)


def score_texts(docs: DataFrame, lexicon: Lexicon, *, threshold: float = 0.7, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with score (0 to 1) and predicted (1 from ``threshold`` on).

    Only the text decides.  Null and empty texts match nothing.  Repeated rows stay; texts of any length are
    scored whole; an empty table gives no rows.  Columns named score or predicted give way to the new ones.
    """
    fields = [f for f in docs.schema.fields if f.name in (keep or docs.columns) and f.name.lower() not in ("score", "predicted")]
    names = [f.name for f in fields]
    text = shared.new_name("text", docs.columns)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon.automaton()
        for batch in (part for whole in batches for part in shared.slices(whole, text)):
            score = [lexicon.score(lexicon.density(t or "")) for t in batch.column(text).to_pylist()]
            columns = [*(batch.column(n) for n in names), pa.array(score, pa.float64()), pa.array([int(x >= threshold) for x in score], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "score", "predicted"])

    lexicon._automaton = None  # built again in each task
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*names, F.col(text_col).alias(text)).mapInArrow(scored, schema)
