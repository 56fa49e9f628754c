"""Operator 4: document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the hash's high bits name a bin, and each bin keeps its least
hash.  An empty bin takes the value of the first filled bin in an order that is fixed for
that bin (optimal densification).  Of each bin ``bits`` low bits are kept and packed.  Likeness
is the share of equal bins, corrected for bins that agree by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm import shared, shingles

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Beyond any value of ``bits`` bits.
NONE = np.uint16(0xFFFF)
_TRIES = 24


class OnePermutation:
    def __init__(self, bins: int = 512, bits: int = 4):
        if bins & (bins - 1) or bits not in (1, 2, 4, 8) or bins * bits % 8:
            raise ValueError("bins: a power of two; bits: 1, 2, 4 or 8")
        self.bins, self.bits = bins, bits
        place = np.arange(bins, dtype=np.uint64)
        self.tries = [(shingles.mix(place + np.uint64(1000 * (t + 1) * bins)) % np.uint64(bins)).astype(np.int64) for t in range(_TRIES)]
        order = shingles.mix(place[:, None] * np.uint64(bins) + place[None, :] + np.uint64(1 << 40))
        self.rank = order.argsort(axis=1).argsort(axis=1).astype(np.int32)  # of each bin, in an empty bin's order

    def signatures(self, texts: pa.Array) -> np.ndarray:
        """A row of ``bins`` low-order values a text; a text without words has NONE everywhere."""
        hashes, starts = shingles.shingles(texts)
        n, k = len(starts) - 1, self.bins
        least = np.full(n * k, EMPTY, dtype=np.uint64)
        row = np.repeat(np.arange(n), np.diff(starts))
        shift = np.uint64(64 - k.bit_length() + 1)
        np.minimum.at(least, row * k + (hashes >> shift).astype(np.int64), hashes)
        least = least.reshape(n, k)
        filled = least != EMPTY
        some = filled.any(axis=1)
        if not filled[some].all():
            self._densify(least, filled, some)
        # a value that fills many bins has other low bits in each, so that chance agreement stays 1 in 2^bits
        out = (shingles.mix(least ^ (np.arange(k, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))) & np.uint64((1 << self.bits) - 1)).astype(np.uint16)
        out[~some] = NONE
        return out

    def _densify(self, least: np.ndarray, filled: np.ndarray, some: np.ndarray) -> None:
        rows, columns = np.nonzero(~filled & some[:, None])
        for t in self.tries:
            hit = filled[rows, t[columns]]
            least[rows[hit], columns[hit]] = least[rows[hit], t[columns[hit]]]
            rows, columns = rows[~hit], columns[~hit]
            if not len(rows):
                return
        edges = np.flatnonzero(np.diff(rows, prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):  # texts with few filled bins
            own, have = columns[a:b], np.flatnonzero(filled[rows[a]])
            least[rows[a], own] = least[rows[a], have[self.rank[own][:, have].argmin(axis=1)]]

    def packed(self, signatures: np.ndarray) -> list[str]:
        """Each signature's packed bits in hex; empty for a text without words."""
        flags = np.unpackbits(signatures.astype(np.uint8)[:, :, None], axis=2, count=self.bits, bitorder="little")
        rows = np.packbits(flags.reshape(len(signatures), self.bins * self.bits), axis=1, bitorder="little")
        return ["" if s[0] == NONE else r.tobytes().hex() for s, r in zip(signatures, rows, strict=True)]

    def likeness(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Estimated Jaccard likeness of signatures, row by row, 0 to 1."""
        chance = 1 / (1 << self.bits)
        same = ((a == b).mean(axis=1) - chance) / (1 - chance)
        empty = (a[:, 0] == NONE).astype(int) + (b[:, 0] == NONE)
        return np.where(empty == 0, np.clip(same, 0, 1), np.where(empty == 2, 1.0, 0.0))


def fingerprint_edits(docs: DataFrame, *, bins: int = 512, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    The edited text: the last floor(n/2) of n code points give way to the first as many (or all) of the
    next text in ascending doc_id order; after the last comes the first.  Columns: doc_id, n_chars,
    edited (text), fingerprint, edited_fingerprint (hex), near_edited, near_next.

    A null text is empty; its fingerprint is the empty string, which is like another empty one (1)
    and unlike any other (0).  Null doc_ids sort first; rows with one doc_id are ordered by a hash of the text.
    Texts of any length are read whole.  One row alone is its own next.  An empty table gives no rows.  Other
    columns are not read.

    Rows are dealt to ordered buckets of about one size, by doc_id and, within one that many rows repeat, by the
    texts' hash.  A bucket also gets the row that starts the next one, so no bucket waits for another.
    """
    parts = shared.partitions(docs.sparkSession)
    bounds = shared.ordered_bounds(docs, id_col, text_col, parts)
    last = bounds.buckets - 1
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the rows that start a bucket, for the bucket before; the first of all, for the last
    first = texts.agg(F.min(shared.order_key(F.col("doc_id"))).alias("k")).first().k
    of_first = shared.order_key(F.col("doc_id")) == F.lit(first)
    least = texts.where(of_first).agg(F.min(shared.text_order(F.col("text"))).alias("h")).first().h
    is_first = of_first & (shared.text_order(F.col("text")) == F.lit(least))
    starts = bounds.starts(F.col("doc_id"), F.col("text"))
    texts = texts.withColumn("_bucket", bounds.bucket_of(F.col("doc_id"), F.col("text")))
    to = F.array_compact(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("tail")), F.when(starts, F.struct((F.col("_bucket") - 1).alias("b"), F.lit(1).alias("tail"))), F.when(is_first, F.struct(F.lit(last).alias("b"), F.lit(2).alias("tail")))))
    dealt = texts.select("doc_id", "text", F.explode(to).alias("at")).select("doc_id", "text", "at.*")
    dealt = dealt.repartitionById(last + 1, F.col("b")).sortWithinPartitions("tail", "doc_id", shared.text_order(F.col("text")), "text").select("doc_id", "text", "tail")

    def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = OnePermutation(bins, bits)

        def out(rows: pa.Table) -> pa.RecordBatch:
            """Rows but the last, which is only the next of the one before."""
            own = shared.as_array(rows.column("text"))
            n = len(own) - 1
            texts = own.to_pylist()
            cut = [len(t) // 2 for t in texts[:-1]]
            edited = pa.array([t[: len(t) - c] + u[:c] for t, u, c in zip(texts[:-1], texts[1:], cut, strict=True)], pa.string())
            a, b = sketch.signatures(own), sketch.signatures(edited)
            columns = [rows.column("doc_id").slice(0, n), pc.utf8_length(own.slice(0, n)).cast(pa.int64()), edited, pa.array(sketch.packed(a[:-1]), pa.string()), pa.array(sketch.packed(b), pa.string()), pa.array(sketch.likeness(a[:-1], b)), pa.array(sketch.likeness(a[:-1], a[1:]))]
            return pa.RecordBatch.from_arrays([shared.as_array(c) for c in columns], ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        before, ended = None, False
        for batch in batches:
            for part in shared.slices(batch, "text"):
                rows = pa.Table.from_batches([part])
                tails = np.asarray(rows.column("tail"))
                if ended or not len(tails):
                    continue
                keep = int((tails == 0).sum())
                if keep < len(tails):  # one row of the next bucket is enough
                    keep, ended = keep + 1, True
                rows = rows.slice(0, keep).combine_chunks()
                rows = pa.concat_tables([before, rows]).combine_chunks() if before is not None else rows
                if rows.num_rows > 1:
                    yield out(rows)
                before = rows.slice(rows.num_rows - 1)

    return dealt.mapInArrow(fingerprinted, "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
