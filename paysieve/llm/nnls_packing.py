"""Operator 5: packing of documents into fixed windows by non-negative least squares.

Lengths are counted in units of ``unit`` tokens.  All combinations of at most three lengths
that fill a window are the columns of a matrix; their repeat counts are solved against
the histogram of lengths by non-negative least squares and rounded down; what is left
is packed greedily.  All of this works on the histogram, which has at most ``window`` rows
however many documents there are; Spark gives each piece its number within its length, and
the plan says where the piece with that number goes.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm import shared, token_files, words


def combinations(present: np.ndarray, units: int, slack: int) -> list[tuple[int, ...]]:
    """Lengths from ``present``, three at most, largest first, whose sum leaves at most ``slack`` units free."""
    have = np.zeros(units + 1, dtype=bool)
    have[present] = True
    out = []
    for a in present[::-1].tolist():
        if a >= units - slack:
            out.append((a,))
        for b in present[present <= min(a, units - a)].tolist():
            if a + b >= units - slack:
                out.append((a, b))
            for c in range(max(1, units - slack - a - b), min(b, units - a - b) + 1):
                if have[c]:
                    out.append((a, b, c))
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """x >= 0 with least |a x - b|, by the active-set method; warns where ``rounds`` end it early.

    Columns of ``a`` have few entries: gradients go through them alone, and each step solves the chosen columns'
    normal equations.
    """
    n, m = a.shape
    x, on = np.zeros(m), np.zeros(m, dtype=bool)
    if not m:
        return x
    tolerance = 1e-7 * max(1.0, float(np.abs(b).max(initial=0)))
    row, column = np.nonzero(a)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    nth = np.arange(len(row)) - np.searchsorted(column, column)
    places = np.full((m, int(nth.max(initial=0)) + 1), n)
    places[column, nth] = row
    values = np.zeros(places.shape)
    values[column, nth] = a[row, column]
    for _ in range(rounds):
        own = np.flatnonzero(on)
        rest = np.append(b - a[:, own] @ x[own], 0.0)
        w = (values * rest[places]).sum(axis=1)
        w[on] = -np.inf
        if w.max() <= tolerance:
            return x
        on[int(w.argmax())] = True
        while on.any():
            own = np.flatnonzero(on)
            chosen = a[:, own]
            square = chosen.T @ chosen
            square[np.diag_indices(len(own))] *= 1 + 1e-12
            try:
                s = np.linalg.solve(square, chosen.T @ b)
            except np.linalg.LinAlgError:
                s = np.linalg.lstsq(chosen, b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[own] = s
                break
            low = s <= 0
            step = np.min(x[own][low] / np.maximum(x[own][low] - s[low], 1e-12))
            x[own] += step * (s - x[own])
            drop = own[(x[own] <= tolerance * 1e-3) | (low & (x[own] <= 1e-9))]
            if not len(drop):
                drop = own[low][:1]
            x[drop], on[drop] = 0, False
    warnings.warn(f"least squares stopped after {rounds} rounds", stacklevel=2)
    return x


def plan(counts: np.ndarray, slack: int = 1) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a window, repeats) that use each length as often as ``counts`` has it."""
    units, left, out = len(counts) - 1, counts.astype(np.int64).copy(), []

    def use(combo: tuple[int, ...], repeats: int) -> None:
        if repeats > 0:
            for x in combo:
                left[x] -= repeats
            out.append((combo, repeats))

    use((units,), int(left[units]))
    present = np.flatnonzero(left)
    columns = [c for c in combinations(present, units, slack) if c != (units,)]
    if columns:
        row = {int(x): i for i, x in enumerate(present)}
        a = np.zeros((len(present), len(columns)))
        for j, c in enumerate(columns):
            for x in c:
                a[row[x], j] += 1
        # unused short lengths do little harm: the greedy step fits them in
        weight = np.sqrt(0.1 + present / units)
        x = nnls(a * weight[:, None], left[present] * weight)
        for j in np.argsort(-x, kind="stable").tolist():
            if x[j] < 1:
                break
            need = {v: columns[j].count(v) for v in columns[j]}
            use(columns[j], min(int(x[j]), *(int(left[v]) // k for v, k in need.items())))
    while left.any():  # each round uses up a length at least
        combo, room = [], units
        spare = left.copy()
        while room > 0 and (fits := np.flatnonzero(spare[: room + 1])).size:
            x = int(fits[-1])
            k = min(room // x, int(spare[x]))
            combo += [x] * k
            spare[x] -= k
            room -= x * k
        need = {v: combo.count(v) for v in combo}
        use(tuple(combo), min(int(left[v]) // k for v, k in need.items()))
    return out


def cut_lengths(lengths: np.ndarray, counts: np.ndarray, window: int, cut: int, unit: int) -> np.ndarray:
    """Pieces by length in units, when texts of these token lengths are cut into whole windows, then every ``cut`` tokens."""
    units = window // unit
    out = np.zeros(units + 1, dtype=np.int64)
    out[units] += int((counts * (lengths // window)).sum())
    rest = lengths % window
    if cut < window:
        out[-(-cut // unit)] += int((counts * (rest // cut)).sum())
        rest = rest % cut
    np.add.at(out, -(-rest[rest > 0] // unit), counts[rest > 0])
    return out


class Placement:
    """Where the piece with a number within its length goes: its sequence and slot."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]]):
        rows, used, sequence = [], {}, 0
        for combo, repeats in planned:
            for slot, x in enumerate(combo):
                rows.append((x, used.get(x, 0), sequence, slot))
                used[x] = used.get(x, 0) + repeats
            sequence += repeats
        rows.sort()
        self.length, self.first, self.sequence, self.slot = (np.array(c, dtype=np.int64) for c in (zip(*rows, strict=True) if rows else ([],) * 4))
        self.sequences = sequence

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.searchsorted(self.length, length, "left"), np.searchsorted(self.length, length, "right")
        while (low + 1 < high).any():  # the last row of the length that starts at or before the number
            middle = (low + high) // 2
            up = self.first[np.minimum(middle, len(self.first) - 1)] <= number
            step = low + 1 < high
            low, high = np.where(step & up, middle, low), np.where(step & ~up, middle, high)
        return self.sequence[low] + number - self.first[low], self.slot[low]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, *, window: int = 2048, unit: int = 8, most_padding: float = 0.01, group: int = 500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All texts, encoded and ended by ``end_id``, as pieces of sequences of at most ``window`` tokens.

    A piece: doc_id, start (its document's ids before it), length, doc_tokens, sequence_id,
    offset (in the sequence, gapless from 0), ids (u32, little-endian bytes).  Every id is in one
    piece.  A text is cut into whole windows and a rest; where rests pack badly (more than
    ``most_padding`` of the windows), they are also cut every half, quarter, ... window.

    A null text is empty: its only id is the end id.  Repeated rows and null or repeated
    doc_ids are documents of their own.  An empty table has no pieces.  Other columns are not read.
    """
    bits = token_files.bits_for(max(len(words.vocabulary(words.fitting(tokenizer))), end_id + 1))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = words.encoder(tokenizer)
        for batch in batches:
            for part in shared.slices(batch, "text", words.SLICE):
                ids, offsets = encode(part.column("text"))
                rows = [token_files.pack(np.append(ids[a:b], np.uint32(end_id)), bits) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                columns = [part.column("doc_id"), part.column("_row"), pa.array(np.diff(offsets) + 1), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_row", "doc_tokens", "packed"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    ids = shared.written(texts.mapInArrow(encoded, "doc_id long, _row long, doc_tokens long, packed binary"), "packing-ids")

    # by rest, how many texts, and how many whole windows they have: at most `window` rows
    rest = F.col("doc_tokens") % window
    seen = ids.groupBy(rest.alias("rest")).agg(F.count("*").alias("n"), F.sum(F.floor(F.col("doc_tokens") / window)).alias("whole")).collect()
    lengths, counts = np.array([r.rest for r in seen], dtype=np.int64), np.array([r.n for r in seen], dtype=np.int64)
    whole, tokens = sum(r.whole for r in seen), sum(r.rest * r.n for r in seen)
    best = None
    cut = window
    while cut >= 2 * unit:
        of_length = cut_lengths(lengths, counts, window, cut, unit)
        planned = plan(of_length)
        sequences = sum(k for _, k in planned)
        if best is None or sequences < best[0]:
            best = (sequences, cut, planned, of_length)
        if sequences * window - tokens <= most_padding * window * (sequences + whole) + window:
            break
        cut //= 2
    sequences, cut, planned, of_length = best
    units = window // unit
    if whole:  # texts' whole windows come after the rests
        planned = [*planned, ((units,), whole)]
        of_length[units] += whole
    place = Placement(planned)

    n, whole_of = F.col("doc_tokens"), F.floor(F.col("doc_tokens") / window)
    starts = F.transform(F.sequence(F.lit(0).cast("long"), whole_of), lambda i: F.struct((i * window).alias("start"), F.least(F.lit(window), n - i * window).alias("length")))
    pieces = ids.select("_row", F.explode(F.filter(starts, lambda p: p["length"] > 0)).alias("p")).select("_row", "p.*")
    if cut < window:
        within = F.transform(
            F.sequence(F.lit(0).cast("long"), F.when(F.col("length") == window, 0).otherwise(F.floor((F.col("length") - 1) / cut)).cast("long")),
            lambda i: F.struct((F.col("start") + i * cut).alias("start"), F.when(F.col("length") == window, window).otherwise(F.least(F.lit(cut), F.col("length") - i * cut)).cast("long").alias("length")),
        )
        pieces = pieces.select("_row", F.explode(within).alias("p")).select("_row", "p.*")
    # numbers within a length: by groups of about `group` pieces, and the groups' sizes summed up
    salts = {int(x): int(-(-of_length[x] // group)) for x in np.flatnonzero(of_length > group)}
    share = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for kv in salts.items() for v in kv)), F.col("size")), F.lit(1)) if salts else F.lit(1)
    pieces = pieces.withColumn("size", F.ceil(F.col("length") / unit).cast("int")).withColumn("salt", F.pmod(F.xxhash64("_row", "start"), share.cast("long")))
    # the groups' sizes are summed up by a thousand groups, and those once more, so that a length's groups are not one task's
    far = F.floor(F.col("salt") / 1000).alias("far")
    sizes = pieces.groupBy("size", "salt").agg(F.count("*").alias("k")).select("size", "salt", far, "k")
    summed = lambda *keys, by: F.coalesce(F.sum("k").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = sizes.groupBy("size", "far").agg(F.sum("k").alias("k")).select("size", "far", summed("size", by="far").alias("above"))
    before = sizes.select("size", "far", "salt", summed("size", "far", by="salt").alias("inner")).join(above, ["size", "far"]).select("size", "salt", (F.col("above") + F.col("inner")).alias("before"))
    numbered = pieces.withColumn("number", F.row_number().over(Window.partitionBy("size", "salt").orderBy("_row", "start")) - 1).join(before, ["size", "salt"])

    @F.pandas_udf("sequence_id long, slot int")
    def placed(size, number):
        import pandas as pd

        sequence, slot = place(size.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "slot": slot.astype("int32")})

    put = numbered.select("_row", "start", "length", placed("size", F.col("number") + F.col("before")).alias("at")).select("_row", "start", "length", "at.*")
    put = put.withColumn("offset", F.coalesce(F.sum("length").over(Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    of_row = put.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in shared.slices(batch, "packed"):
                rows = []
                for doc, tokens, packed, held in zip(own.column(0).to_pylist(), own.column(1).to_pylist(), own.column(2), own.column(3).to_pylist(), strict=True):
                    raw = token_files.unpack(memoryview(packed.as_buffer()), bits, tokens).astype("<u4").tobytes()
                    rows += [(doc, p["start"], p["length"], tokens, p["sequence_id"], p["offset"], raw[4 * p["start"] : 4 * (p["start"] + p["length"])]) for p in held]
                types = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return ids.join(of_row, "_row").select("doc_id", "doc_tokens", "packed", "pieces").mapInArrow(parts, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
