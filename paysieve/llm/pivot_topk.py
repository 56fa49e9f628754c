"""Operator 7: exact top-k by inner product through a pivot-distance index.

With one more component, chosen to give every vector the same norm, the highest inner product is the
least Euclidean distance.  Each vector is keyed by its nearest pivot and its distance to it;
a pivot's vectors are cut by distance into annuli, and annuli into blocks of bounded size.  For a query
at distance D of a pivot, the triangle inequality keeps all of an annulus [r, s] at distance
max(D - s, r - D) at least.  Each query sorts the annuli by that bound and expands them in two looks: the nearest ones
first; the k-th best score in them then rules out the annuli beyond it, by that bound and by the largest norm of
an annulus, and all others are scored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm import shared

_log = logging.getLogger(__name__)

#: Where a vector's square is below, every float64 sum of products is exact; beyond, sums are of 64-bit integers.
EXACT = 2.0**53
#: Scores are long: no vector's square may reach this (with room for the rounding of the square).
MOST = 2.0**63 * (1 - 1e-9)


def quantised(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """floor(256 x) of every component; shorter vectors end in zeros."""
    sizes = np.asarray(pc.list_value_length(vectors), dtype=np.int64)
    out = np.zeros((len(vectors), dims))
    rows = np.repeat(np.arange(len(vectors)), sizes)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = np.floor(256.0 * np.asarray(vectors.flatten(), dtype=np.float64))
    return out


def farthest_first(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` distinct rows, each the farthest from those before."""
    if not len(sample):
        return sample
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


@dataclass
class Pivots:
    points: np.ndarray  # in whole components
    norm: float  # that every vector has with one more component

    def more(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Of vectors to pivots."""
        inner = x @ self.points.T + self.more(x)[:, None] * self.more(self.points)[None, :]
        return np.sqrt(np.maximum(2 * self.norm**2 - 2 * inner, 0))

    def scaled(self, q: np.ndarray) -> np.ndarray:
        size = np.sqrt((q * q).sum(axis=1))
        return np.divide(self.norm, size, out=np.zeros_like(size), where=size > 0)

    def query_distances(self, q: np.ndarray) -> np.ndarray:
        """Of queries, stretched to the common norm, to pivots."""
        return np.sqrt(np.maximum(2 * self.norm**2 - 2 * self.scaled(q)[:, None] * (q @ self.points.T), 0))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, of equal ones the least ids, in that order."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        own = np.flatnonzero(scores >= least)
        return own[np.lexsort((ids[own], -scores[own]))][:k]
    return np.lexsort((ids, -scores))[:k]


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, pivots: int = 32, annuli: int = 16, annulus_rows: int = 256, block_bytes: int = 4 << 20, tile: int = 256, first_annuli: int = 2, sample: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k highest inner products of floor(256 x).

    Queries are the rows where ``is_query`` holds; candidates are all rows but the query's own.  Ties go to
    the lesser id; with fewer candidates all are given.  Pivots come from ``sample`` rows at most; every row is
    indexed, and the result is exact.  A pivot has at most ``annuli`` annuli, of about ``annulus_rows`` rows at least; a query's first
    look is at ``first_annuli``.  Queries go to blocks of about ``block_bytes`` of codes, in tiles of ``tile``.

    Rows with a null id, a null vector, or a null or non-finite component take no part.  Shorter
    vectors are as if they ended in zeros.  Rows that repeat an id are separate candidates, of each other too, and
    separate queries, each with its own k rows.  Components of any size count as they are; where a
    score could be beyond a long the query fails.  An empty table gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    x = F.col(vector_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & whole).select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"), x.cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    size = valid.agg(F.max(F.size("v")).alias("d"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    dims = size.d
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, dims)
    most = 256.0 * (size.most or 0.0) + 1
    if most * most >= MOST:
        raise ValueError("a component is so large that scores do not fit a long")
    kind = "<i4" if most < 2**31 else "<i8"

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = quantised(batch.column("v"), dims)
            rows = [c.tobytes() for c in codes.astype(kind)]
            yield pa.RecordBatch.from_arrays([*batch.select(["rid", "vec_id", "q"]).columns, pa.array(rows, pa.binary()), pa.array((codes * codes).sum(axis=1))], ["rid", "vec_id", "q", "code", "square"])

    rows = shared.written(valid.mapInArrow(coded, "rid long, vec_id long, q boolean, code binary, square double"), "codes")

    def matrix(column, as_type=np.float64) -> np.ndarray:
        data = b"".join(x.as_buffer() for x in column)
        return np.frombuffer(data, dtype=kind).reshape(-1, dims).astype(as_type)

    some = rows.orderBy(F.xxhash64("vec_id"), "code").limit(sample).select("code").collect()
    points = farthest_first(np.unique(np.array([np.frombuffer(bytes(r.code), kind) for r in some], dtype=np.float64).reshape(-1, dims), axis=0), pivots)
    extent = rows.agg(F.max("square").alias("square"), F.count("*").alias("n")).first()
    square = extent.square
    annuli = min(annuli, -(-extent.n // (len(points) * annulus_rows)))
    block = max(1, block_bytes // (dims * np.dtype(kind).itemsize))
    if square >= MOST:
        raise ValueError("a vector is so long that scores do not fit a long")
    summed = np.float64 if square < EXACT else np.int64
    index = Pivots(points, float(np.sqrt(square)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = index.distances(matrix(batch.column("code")))
            near = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(near)), near])], ["rid", "vec_id", "q", "code", "square", "pivot", "far"])

    placed = shared.written(rows.mapInArrow(keyed, "rid long, vec_id long, q boolean, code binary, square double, pivot int, far double"), "pivot-distances")
    # annuli of each pivot by its vectors' distances: `pivots` rows
    cuts = {p: np.zeros(0) for p in range(len(points))} if annuli < 2 else {r.pivot: np.unique(r.cuts) for r in placed.groupBy("pivot").agg(F.percentile_approx("far", [i / annuli for i in range(1, annuli)], 1000).alias("cuts")).collect()}
    ring_of = F.pandas_udf(lambda p, d: _ring(cuts, p, d), "int")
    ringed = placed.withColumn("ring", ring_of("pivot", "far"))
    rings = sorted(ringed.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high"), F.sqrt(F.max("square")).alias("norm")).collect())  # pivots x annuli rows
    owner, low, high, norms = (np.array([r[c] for r in rings]) for c in ("pivot", "low", "high", "norm"))
    number = F.create_map(*(F.lit(v) for i, r in enumerate(rings) for v in (r.pivot * 1000 + r.ring, i)))
    parts_of = F.array(*(F.lit(int(-(-r.n // block))) for r in rings))
    ringed = ringed.withColumn("annulus", number[F.col("pivot") * 1000 + F.col("ring")])
    part = F.pmod(F.xxhash64("rid"), F.get(parts_of, F.col("annulus"))).cast("int")
    blocks = ringed.groupBy("annulus", part.alias("part")).agg(F.collect_list(F.struct("rid", "vec_id", "code")).alias("rows"))

    # queries in tiles: alike ones together, few ones of several pivots in one
    asked = placed.where("q").select("rid", "vec_id", "code", "pivot")
    first, shares, filled = {}, {}, 0
    for r in asked.groupBy("pivot").agg(F.count("*").alias("n")).orderBy("pivot").collect():  # `pivots` rows
        first[r.pivot], shares[r.pivot] = filled // tile, -(-r.n // tile)
        filled += r.n
    if not filled:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    of_pivot = lambda d: F.create_map(*(F.lit(int(x)) for kv in d.items() for x in kv))[F.col("pivot")]
    tiles = asked.withColumn("tile", of_pivot(first) + F.pmod(F.xxhash64("rid"), of_pivot(shares))).groupBy("tile").agg(F.collect_list(F.struct("rid", "vec_id", "code")).alias("queries"))
    tiles = shared.written(tiles, "query-tiles")

    def bounds(q: np.ndarray) -> np.ndarray:
        """Least distance that a vector of each annulus can have to each query; nothing for a zero query."""
        d = index.query_distances(q)[:, owner]
        out = np.maximum(0, np.maximum(d - high, low - d))
        out[(q * q).sum(axis=1) == 0] = 0
        return out

    def parsed(rows, as_type=np.float64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = rows.values
        return np.asarray(held.field("rid")), np.asarray(held.field("vec_id")), matrix(held.field("code"), as_type)

    def expanded(width: int):
        """Of each tile, the annuli that come next: for each query the nearest ``width`` within its reach that are not seen yet."""

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                to = []
                for i in range(batch.num_rows):
                    rids, _, q = parsed(batch.column("queries")[i])
                    known = dict(zip(batch.column("rids")[i].as_py() or [], batch.column("least")[i].as_py() or [], strict=True))
                    least = np.array([known.get(r, -np.inf) for r in rids.tolist()], dtype=np.float64)
                    reach = 2 * index.norm**2 - 2 * np.where(np.isfinite(least), index.scaled(q) * np.where(np.isfinite(least), least, 0), -np.inf)
                    reach = np.sqrt(np.maximum(reach, 0)) * (1 + 1e-9) + 1e-6 * max(1.0, index.norm)
                    bound = bounds(q)
                    near = np.where(bound <= reach[:, None], bound + 1e-9 * index.query_distances(q)[:, owner], np.inf)
                    # no product is larger than that of the norms
                    norm = np.sqrt((q * q).sum(axis=1))
                    near[norm[:, None] * norms[None, :] * (1 + 1e-9) < least[:, None]] = np.inf
                    near[:, batch.column("seen")[i].as_py() or []] = np.inf
                    order = np.argsort(near, axis=1, kind="stable")[:, :width]
                    to.append(np.unique(order[np.isfinite(np.take_along_axis(near, order, axis=1))]).tolist())
                yield pa.RecordBatch.from_arrays([batch.column("tile"), pa.array(to, pa.list_(pa.int32()))], ["tile", "to"])

        return of

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qrids, qids, q = parsed(batch.column("queries")[i], summed)
                rids, ids, v = parsed(batch.column("rows")[i], summed)
                scores = q @ v.T
                out = []
                for j in range(len(qids)):
                    other = np.flatnonzero(rids != qrids[j])
                    top = other[best(scores[j, other], ids[other], k)]
                    out.append((np.full(len(top), qrids[j]), np.full(len(top), qids[j]), rids[top], ids[top], scores[j, top].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query", "query_id", "rid", "vec_id", "score"])

    blocks = shared.written(blocks, "index-blocks")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "rid")
    tops = spark.createDataFrame([], "query long, query_id long, rid long, vec_id long, score long, rank int")
    seen = tiles.select("tile", F.array().cast("array<int>").alias("seen"))
    for width in (first_annuli, len(rings)):
        least = tops.where(F.col("rank") == k).select(F.col("query").alias("rid"), F.col("score").alias("least"))
        of_tile = tiles.select("tile", F.explode("queries.rid").alias("rid")).join(least, "rid").groupBy("tile").agg(F.collect_list(F.struct("rid", "least")).alias("m")).select("tile", F.col("m.rid").alias("rids"), F.col("m.least").alias("least"))
        state = tiles.join(seen, "tile").join(of_tile, "tile", "left").select("tile", "queries", "seen", "rids", "least")
        step = shared.written(state.mapInArrow(expanded(width), "tile long, to array<int>").where(F.size("to") > 0), "annuli-asked")
        if step.isEmpty():
            break
        parts = F.sequence(F.lit(0), F.get(parts_of, F.col("annulus")) - 1)
        pairs = step.select("tile", F.explode("to").alias("annulus")).select("tile", "annulus", F.explode(parts).alias("part"))
        # a tile's queries multiply in the join, which no estimate knows: they are shuffled, never broadcast
        met = pairs.join(tiles.hint("merge"), "tile").join(blocks.hint("merge"), ["annulus", "part"]).select("queries", "rows")
        found = tops.drop("rank").union(met.mapInArrow(scored, "query long, query_id long, rid long, vec_id long, score long"))
        tops = shared.written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best-scores")
        seen = shared.written(seen.join(step, "tile", "left").select("tile", F.array_union("seen", F.coalesce("to", F.array().cast("array<int>"))).alias("seen")), "annuli-seen")
    looked = seen.agg(F.sum(F.size("seen")).alias("looked"), F.count("*").alias("tiles")).first()
    _log.info("tiles looked into %d of %d annuli", looked.looked or 0, looked.tiles * len(rings))
    return tops.select("query_id", "rank", "vec_id", "score")


def _ring(cuts: dict[int, np.ndarray], pivots, distances):
    import pandas as pd

    p, d = pivots.to_numpy(), distances.to_numpy()
    out = np.zeros(len(p), dtype=np.int32)
    for own in np.unique(p):
        at = p == own
        out[at] = np.searchsorted(cuts[int(own)], d[at], side="left")
    return pd.Series(out)


SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (SELECT q.rid AS q, q.vec_id AS query_id, v.vec_id, v.rid, list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2]))::BIGINT AS score
          FROM v q JOIN v ON q.rid <> v.rid WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, rid) AS r FROM pairs)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
"""
