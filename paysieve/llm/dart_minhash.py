"""Operator 6: near-duplicate classes by DartMinHash signatures and banded joining.

An element of weight x owns the region [0, x) by [0, infinity) of a plane.  Hashed darts are thrown
at unit cells, a Poisson number each, the same for every document that has the element.  Darts
are thrown up to a rank that lets about k ln k + 2k of them in; each falls on one of k
coordinates, and the earliest dart of each coordinate is the signature.  Two documents agree on a
coordinate with the probability of their weighted Jaccard likeness.

A shingle that a text repeats weighs more, up to ``1 + repeats``: with c uses 1 + repeats (1 - 1/c).  Two texts whose
shingle sets are alike by t are then alike by t / (1 + repeats) at least in their weights, and by t where nothing repeats.

Signatures are cut into bands, and whole shingle sets decide.  First every text of some bands is compared
with one text of its band, which joins a large group of copies at the cost of its size.  Then all bands that
still hold texts of different groups are compared in blocks, where no two texts of one group meet.
With 32 bands of 4, a pair at likeness 0.8 is missed with probability 5e-8 where nothing repeats, and with 0.003 at
most (weights that differ by 1.25 in every common shingle).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm import shared, shingles
from paysieve.llm.components import components

_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


class DartMinHash:
    def __init__(self, k: int = 128, seed: int = 1, most_cells: int = 1 << 18):
        self.k, self.seed, self.most_cells = k, np.uint64(seed), most_cells
        self.darts = k * np.log(k) + 2 * k
        # a Poisson number of mean 1 from a uniform 32-bit number
        terms = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 13.0)])))
        self.steps = (terms * 2.0**32).astype(np.uint64)

    def _throw(self, rows, elements, weights, low, high, out) -> None:
        """Darts of ranks from low to high (of each row) into ``out``, one cell row of the plane after another.

        rows: of each element; weights: None for 1 each.
        """
        k = self.k
        first, last = np.floor(low[rows]).astype(np.int64), np.ceil(high[rows]).astype(np.int64)
        wide = np.ones(len(rows), dtype=np.int64) if weights is None else np.ceil(weights).astype(np.int64)
        times = (last - first) * wide
        if len(rows) > 1 and times.sum() > self.most_cells:  # in parts: a dart does not depend on the others
            parts = np.cumsum(times) // self.most_cells
            edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(rows)]
            if len(edges) == 2:
                edges = [0, len(rows) // 2, len(rows)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                self._throw(rows[a:b], elements[a:b], None if weights is None else weights[a:b], low, high, out)
            return
        at = np.repeat(np.arange(len(rows)), times)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        column, cell = nth % wide[at], first[at] + nth // wide[at]
        key = shingles.mix(elements[at] ^ self.seed ^ shingles.mix(cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)))
        number = np.searchsorted(self.steps, key >> np.uint64(32), side="right")
        for d in range(int(number.max(initial=0))):
            own = np.flatnonzero(number > d)
            dart = shingles.mix(key[own] + np.uint64((d + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
            row = rows[at[own]]
            rank = cell[own] + (dart >> np.uint64(40)).astype(np.float64) / 2.0**24
            inside = (rank >= low[row]) & (rank < high[row])
            if weights is not None:
                edge = np.flatnonzero(column[own] + 1 > weights[at[own]])  # cells that the region ends in
                place = column[own[edge]] + (shingles.mix(dart[edge]) >> np.uint64(40)).astype(np.float64) / 2.0**24
                inside[edge] &= place < weights[at[own[edge]]]
            dart, row, rank = dart[inside], row[inside], rank[inside]
            to = row * k + ((dart & np.uint64(0xFFFFF)) % np.uint64(k)).astype(np.int64)
            # rank first, then 24 bits that tell darts apart
            value = (np.minimum(rank * 2.0**16, 2.0**40 - 1).astype(np.uint64) << np.uint64(24)) | (shingles.mix(dart ^ np.uint64(7)) >> np.uint64(40))
            np.minimum.at(out, to, value)

    def signatures(self, elements: np.ndarray, starts: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """A row of k values for each document; a document without elements has the same value everywhere.

        elements: distinct hashes of a document's elements, one document after the other.  weights: above 0.  Coordinates
        that no dart has met up to the last rank (documents of tiny weight) get a value of the document's own elements, so
        that unlike documents do not agree there.
        """
        n = len(starts) - 1
        rows = np.repeat(np.arange(n), np.diff(starts))
        total = np.diff(starts).astype(float) if weights is None else np.bincount(rows, weights, n)
        out = np.full(n * self.k, _FAR, dtype=np.uint64)
        low = np.zeros(n)
        high = np.minimum(self.darts / np.maximum(total, 1e-9), 2.0**23)
        left = np.flatnonzero(total > 0)
        while len(left):
            chosen = np.isin(rows, left)
            self._throw(rows[chosen], elements[chosen], None if weights is None else weights[chosen], low, high, out)
            short = (out.reshape(n, self.k)[left] == _FAR).any(axis=1)
            left = left[short & (high[left] < 2.0**23)]
            low[left], high[left] = high[left], 2 * high[left]
        out = out.reshape(n, self.k)
        row, coordinate = np.nonzero((out == _FAR) & (total > 0)[:, None])
        if len(row):
            own = np.zeros(n, dtype=np.uint64)
            np.bitwise_xor.at(own, rows, shingles.mix(elements ^ self.seed))
            out[row, coordinate] = shingles.mix(own[row] + coordinate.astype(np.uint64))
        return out

    def bands(self, signatures: np.ndarray, rows_per_band: int) -> np.ndarray:
        """A key for each band of each signature; keys of different bands differ."""
        n = len(signatures)
        parts = signatures.reshape(n, self.k // rows_per_band, rows_per_band)
        key = shingles.mix(np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]) + np.uint64(11))
        for i in range(rows_per_band):
            key = shingles.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
        return key


def weights_of(times: np.ndarray, repeats: float) -> np.ndarray | None:
    """The weight of shingles that a text uses so many times; None for 1 each."""
    return 1 + repeats * (1 - 1 / times) if repeats and (times > 1).any() else None


def linked(sets: list[np.ndarray], labels: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs (i, j), as few as connect the same groups, with Jaccard likeness of at least ``least``.

    Sets that share a label count as connected already.  Each set in turn is compared with all
    sets that are not yet in its group.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    starts = np.append(np.flatnonzero(new), len(flat))
    group = np.empty(len(flat), dtype=np.int64)
    group[order] = np.cumsum(new) - 1  # of each set's elements, in the order of the sets
    edges = np.concatenate([[0], np.cumsum(sizes)])
    names = np.unique(labels, return_inverse=True)[1].astype(np.int64)
    out = []
    for i in range(n):
        other = names != names[i]
        if not other.any():
            break
        own = group[edges[i] : edges[i + 1]]
        counts = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        common = np.bincount(owner[at], minlength=n)
        near = np.flatnonzero(other & (common >= least * (sizes + sizes[i] - common) - 1e-9) & (sizes > 0))
        for j in near.tolist():
            if names[j] != names[i]:
                out.append((i, j))
                names[names == names[j]] = names[i]
    return out


def near_duplicates(docs: DataFrame, *, threshold: float = 0.8, k: int = 128, rows_per_band: int = 4, repeats: float = 0.25, star_bands: int = 8, star_elements: int = 1 << 22, block: int = 1024, block_elements: int = 1 << 19, hot_rows: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the least doc_id of its class), keep (one row of each class) and node (the text's hash) of every row of ``docs``.

    A class: texts connected by five-word-shingle Jaccard likeness of ``threshold`` or more, and their copies.
    Texts are told apart by a 64-bit hash.  A block has ``block`` texts or ``block_elements`` shingles at most, or one
    longer text; each pair of blocks is compared in a task of its own.  What may be hot is joined in several tasks: a band's key, a class
    or a text's copies of over ``hot_rows`` rows, and a band's first text whose partners hold over ``star_elements`` shingles.
    ``repeats`` says how much more a repeated shingle weighs in the signatures; whole shingle sets decide.

    Null texts are empty; texts without words are in a class only with their exact copies.  Rows of
    equal text are one class; the least doc_id is kept, of rows that repeat it one.  A class whose
    doc_ids are all null has a null class_id.  Texts of any length are compared whole.  An empty table gives no
    rows.  Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumns({"node": F.xxhash64("text"), "row": F.monotonically_increasing_id()})

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = DartMinHash(k)
        for batch in batches:
            for part in shared.slices(batch, "text", row_bytes=512):
                elements, starts, times = distinct(*shingles.shingles(part.column("text")))
                keys = minhash.bands(minhash.signatures(elements, starts, weights_of(times, repeats)), rows_per_band).view(np.int64)
                full = np.diff(starts) > 0
                edges = np.concatenate([[0], np.cumsum(np.where(full, keys.shape[1], 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(keys[full].ravel()))
                columns = [part.column("doc_id"), part.column("node"), part.column("row"), pa.array(np.diff(starts)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "row", "size", "bands"])

    signed_rows = shared.written(texts.mapInArrow(signed, "doc_id long, node long, row long, size long, bands array<long>"), "signatures")
    # copies become one row before any band is looked at
    nodes = shared.written(signed_rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.count("*").alias("copies")), "distinct-texts")
    placed = nodes.select("node", "size", F.posexplode("bands").alias("band", "key"))
    full = placed.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("b"), F.count("*").alias("rows")).where("pivot <> b").select("key", "pivot", "rows")
    held = shared.written(shared.joined_by_key(placed, full, "key", "node", hot_rows).select("node", "size", "band", "key", "pivot"), "band-members")
    # whole sets of those texts, from one row of each
    wanted = held.select("node").distinct().join(nodes.select("node", "first"), "node")
    chosen = texts.join(wanted, (texts.node == wanted.node) & texts.doc_id.eqNullSafe(wanted["first"])).select(texts.node, "text")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.slices(batch, "text"):
                elements, starts, _ = distinct(*shingles.shingles(part.column("text")))
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "elements"])

    sets = shared.written(chosen.mapInArrow(sets_of, "node long, elements array<long>").dropDuplicates(["node"]), "shingle-sets")

    stars = held.where((F.col("band") < star_bands) & (F.col("node") != F.col("pivot"))).select("node", "size", "pivot").distinct()
    # a pivot's partners in shares of so many shingles; its own set goes to each of them
    shares = stars.groupBy("pivot").agg(F.count("*").alias("rows"), F.ceil(F.sum("size") / star_elements).cast("int").alias("shares"))
    share_of = F.pmod(F.xxhash64("node"), F.col("shares")).cast("int").alias("share")
    stars = shared.written(shared.joined_by_key(stars, shares, "pivot", "node", hot_rows).select("node", "pivot", share_of), "stars")
    asked = stars.select("pivot", "share").distinct().join(sets.select(F.col("node").alias("pivot"), F.col("elements").alias("others")), "pivot")
    met = stars.join(sets, "node").join(asked, ["pivot", "share"])
    common = F.size(F.array_intersect("elements", "others"))
    near = common >= threshold * (F.size("elements") + F.size("others") - common) - 1e-9
    first = shared.written(met.where(near).select(F.col("pivot").alias("a"), F.col("node").alias("b")), "links")

    labels = components(first, hot_rows=hot_rows)
    members = held.join(labels, "node", "left").select("node", "size", "key", F.coalesce("component", "node").alias("label"))
    # a key's largest group, and all others together; the texts of the largest do not meet one another
    of_label = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    of_key = of_label.groupBy("key").agg(F.count("*").alias("labels"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.struct("n", "s", "label")).alias("top")).where("labels > 1")
    blocks = lambda n, s: F.greatest(F.ceil(n / block), F.ceil(s / block_elements)).cast("int")
    sizes = of_key.select("key", F.col("top.label").alias("top"), blocks(F.col("top.n"), F.col("top.s")).alias("tops"), blocks(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("rests"), F.col("n").alias("rows"))
    is_top = F.col("label") == F.col("top")
    share = F.xxhash64("node", "key")
    own = shared.joined_by_key(members, sizes, "key", "node", hot_rows).withColumn("own", F.when(is_top, F.col("rests") + F.pmod(share, F.col("tops"))).otherwise(F.pmod(share, F.col("rests"))).cast("int"))
    others = F.sequence(F.lit(0), F.when(is_top, F.col("rests")).otherwise(F.col("rests") + F.col("tops")) - 1)
    pairs = F.transform(others, lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    dealt = own.select("node", "label", "key", F.explode(pairs).alias("at")).select("node", "label", "key", "at.i", "at.j")

    def compared(key, rows):
        lists = shared.as_array(rows.column("elements"))
        edges = np.asarray(lists.offsets)
        values = np.asarray(lists.values)
        found = [values[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        node = np.asarray(rows.column("node"))
        pairs = linked(found, np.asarray(rows.column("label")), threshold)
        a, b = (np.array(x, dtype=np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
        return pa.table([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    more = dealt.join(sets, "node").groupBy("key", "i", "j").applyInArrow(compared, "a long, b long")
    classes = components(first.union(more), hot_rows=hot_rows)
    of_node = nodes.join(classes, "node", "left").select("node", "first", "copies", F.coalesce("component", "node").alias("class"))
    class_of = of_node.groupBy("class").agg(F.min("first").alias("class_id"), F.count("*").alias("rows"))
    named = shared.joined_by_key(of_node, class_of, "class", "node", hot_rows).select("node", "class", "class_id", F.col("copies").alias("rows"))
    rows = signed_rows.select("doc_id", "node", "row")
    classed = shared.written(shared.joined_by_key(rows, shared.written(named, "classes"), "node", "row", hot_rows), "class-members")
    # the row to keep: of the class's first doc_id, any one of its copies
    kept = classed.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class").agg(F.min(F.struct("node", "row")).alias("m")).select("m.row", F.lit(True).alias("keep"))
    return classed.join(kept, "row", "left").select("doc_id", "class_id", F.coalesce("keep", F.lit(False)).alias("keep"), "node")


def kept_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps: one of each class.

    Nulls, empty texts and ties are as there.  Of rows that repeat the kept doc_id and text one stays, whichever comes.
    """
    of, own = (shared.new_name(n, docs.columns) for n in ("kept_id", "node"))
    kept = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("keep").select(F.col("doc_id").alias(of), F.col("node").alias(own))
    node = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    joined = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(of)) & (node == F.col(own)))
    return joined.dropDuplicates([of, own]).select(docs.columns)


def distinct(elements: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's elements without repeats, in ascending order, and how often each occurs."""
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((elements, rows))
    elements, rows = elements[order], rows[order]
    new = np.ones(len(elements), dtype=bool)
    new[1:] = (elements[1:] != elements[:-1]) | (rows[1:] != rows[:-1])
    counts = np.bincount(rows[new], minlength=len(starts) - 1)
    return elements[new], np.concatenate([[0], np.cumsum(counts)]), np.diff(np.append(np.flatnonzero(new), len(new)))
