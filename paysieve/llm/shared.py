"""What several operators need: scratch tables, slices of Arrow batches, bounds of ordered buckets."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDER: list[str] = []
_MADE: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as ``spark.checkpoint.dir`` names it.

    Only where all tasks run in the driver's process (local mode, tests) a temporary folder may take its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append("file://" + tempfile.mkdtemp(prefix="paysieve-"))
    return _OWN_FOLDER[0]


def new_path(spark: SparkSession, name: str) -> str:
    _MADE.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def delete(spark: SparkSession, paths: list[str]) -> int:
    """Deletes tables that nothing reads any more; how many there were."""
    gone = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def clear(spark: SparkSession) -> int:
    """Deletes the tables that this process has written so far; how many there were.  Results that still read them fail afterwards."""
    paths = list(_MADE)
    _MADE.clear()
    return delete(spark, paths)


def new_name(name: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` is, whatever their case."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def written(df: DataFrame, name: str, by: list[str] | None = None, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when executors are lost.  A name with a slash is a whole path."""
    path = name if "/" in name else new_path(df.sparkSession, name)
    writer = (df.write.partitionBy(*by) if by else df.write).options(**options)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_by_key(many: DataFrame, few: DataFrame, key: str, by: str, most: int = 1 << 20) -> DataFrame:
    """``many`` joined with ``few``, which has one row a ``key`` and in ``rows`` how many rows of ``many`` have it.

    A key of over ``most`` rows is dealt to several tasks by a hash of ``by``, and its row of ``few`` is repeated for each.
    Such keys are broadcast: there are at most (rows of ``many``) / ``most``, 100,000 short rows for 10^11.  Null keys
    are joined with nothing.
    """
    shares = F.ceil(F.col("rows") / F.lit(most)).cast("int")
    hot = few.where(F.col("rows") > most).select(key, shares.alias("_shares"))
    dealt = many.join(F.broadcast(hot), key, "left").withColumn("_share", F.coalesce(F.pmod(F.xxhash64(by), F.col("_shares")).cast("int"), F.lit(0))).drop("_shares")
    repeated = few.withColumn("_share", F.explode(F.sequence(F.lit(0), F.greatest(shares, F.lit(1)) - 1))).drop("rows")
    return dealt.join(repeated, [key, "_share"]).drop("_share")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20, row_bytes: int = 64) -> Iterator[pa.RecordBatch]:
    """Runs of rows of ``batch`` with about ``most_bytes`` of text each; a longer text comes alone.

    row_bytes: what a row costs besides its text.  What Arrow holds unused is given back after each batch, since a worker lives on.
    """
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = (np.cumsum(sizes + row_bytes) - 1) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(start, end - start)
    pa.default_memory_pool().release_unused()


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


@dataclass(frozen=True)
class Bounds:
    """Ordered buckets of rows by (id, hash of the text): a bucket starts with its bound, which occurs in the data.

    Null ids are one id before all others.  Few bounds have a hash: those within an id that fills several buckets.
    """

    ids: np.ndarray
    hashes: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.ids) + 1

    def bucket_of(self, key: Column, text: Column) -> Column:
        """How many bounds are not above the row."""
        ids, hashes = self.ids, self.hashes
        hot = np.unique(ids[hashes > _LEAST])

        @F.pandas_udf("int")
        def find(keys, own):
            import pandas as pd

            k = keys.to_numpy(dtype="int64")
            out = np.searchsorted(ids, k, side="right")
            for x in hot:  # within the id's bounds, by hash
                at = np.flatnonzero(k == x)
                first = int(np.searchsorted(ids, x))
                out[at] = first + np.searchsorted(hashes[ids == x], own.to_numpy(dtype="int64")[at], side="right")
            return pd.Series(out.astype("int32"))

        return find(order_key(key), text_order(text) if len(hot) else F.lit(0).cast("long"))

    def starts(self, key: Column, text: Column) -> Column:
        """Whether the row is equal to a bound; of rows that are, a bucket has its first."""
        plain = [int(k) for k, h in zip(self.ids, self.hashes, strict=True) if h == _LEAST]
        exact = [(int(k), int(h)) for k, h in zip(self.ids, self.hashes, strict=True) if h > _LEAST]
        out = order_key(key).isin(plain) if plain else F.lit(False)
        for k in sorted({k for k, _ in exact}):
            out = out | ((order_key(key) == k) & text_order(text).isin([h for x, h in exact if x == k]))
        return out


_LEAST = np.int64(-(2**63))


def order_key(key: Column) -> Column:
    """By which rows are ordered: ids, null before all others."""
    return F.coalesce(key.cast("long"), F.lit(int(_LEAST)))


def text_order(text: Column) -> Column:
    """A hash of 52 bits, which Spark's percentiles, being of doubles, keep exactly."""
    return F.shiftrightunsigned(F.xxhash64(text), 12)


def ordered_bounds(df: DataFrame, key: str, text: str, parts: int) -> Bounds:
    """Up to ``parts - 1`` bounds that cut the rows into buckets of about one size.

    An id that fills several buckets is cut by its texts' hashes.  Only the bounds come to the driver, as
    with Spark's own range partitioning.
    """
    if parts < 2:
        return Bounds(np.zeros(0, np.int64), np.zeros(0, np.int64))
    shares = [i / parts for i in range(1, parts)]
    keys = df.select(order_key(F.col(key)).alias("k"))
    row = keys.agg(F.percentile_approx("k", shares, 20 * parts).alias("b"), F.min("k").alias("first"), F.max(F.when(F.col("k") > int(_LEAST), F.abs("k"))).alias("most")).first()
    found = row["b"] or []
    if (row["most"] or 0) >= 1 << 53:  # percentiles are of doubles: the least id at or after each
        cuts = F.array(*(F.lit(x) for x in sorted(set(found))))
        passed = keys.select("k", F.size(F.filter(cuts, lambda c: c <= F.col("k"))).alias("n")).groupBy("n").agg(F.min("k").alias("k"))
        of = sorted(Counter(found).items())
        times = Counter({r.k: of[r.n - 1][1] for r in passed.where("n > 0").collect()})
    else:
        times = Counter(found)
    out = {(x, int(_LEAST)) for x in times if x > row["first"]}
    hot = [x for x, n in times.items() if n > 1]
    if hot:
        found = df.where(order_key(F.col(key)).isin(hot)).groupBy(order_key(F.col(key)).alias("k")).agg(F.percentile_approx(text_order(F.coalesce(F.col(text), F.lit(""))), shares, 20 * parts).alias("h"), F.min(text_order(F.coalesce(F.col(text), F.lit("")))).alias("first"))
        for r in found.collect():  # a row for each id that fills two buckets or more
            step = max(1, len(r.h) // (times[r.k] + 1))
            out |= {(r.k, h) for h in r.h[step - 1 :: step] if h > r["first"]}
    bounds = np.array(sorted(out), dtype=np.int64).reshape(-1, 2)
    return Bounds(bounds[:, 0], bounds[:, 1])


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: this package on the executors, and Arrow batches that fit their memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:  # the session's own choice stands
        spark.conf.set(key, str(8 << 20))
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's files, unless Python's path in the environment has them already."""
    import os
    import zipfile
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    known = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    sc = spark.sparkContext
    name = f"{root.name}-{sc.applicationId}.zip"
    if str(root.parent) in known or any(str(f).endswith(name) for f in sc.listFiles):
        return
    path = Path(tempfile.mkdtemp(prefix="paysieve-")) / name
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(path))
