"""Connected components of an edge table, by joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm import shared


def components(edges: DataFrame, most_rounds: int = 60, hot_rows: int = 1 << 20) -> DataFrame:
    """node and component (its least node) of every node that ``edges`` (a, b) name.

    Each round links every node's neighbours to the least of them, first those above the
    node, then those below, until only stars are left; the rounds grow with the logarithm
    of the longest path.  Loops and repeated edges do no harm.  A node of over ``hot_rows``
    neighbours is dealt to several tasks.
    """
    # equal by their number and two sums of hashes: no shuffle of the edges to tell that they are the same
    code = F.xxhash64("a", "b")
    mark = (F.count("*"), F.bit_xor(code), F.sum(code.cast("decimal(20,0)")))
    own = shared.written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    known = own.agg(*mark).first()
    for _ in range(most_rounds):
        both = own.union(own.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("rows"))
        large = shared.joined_by_key(both.where("b > a"), least, "a", "b", hot_rows).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows"))
        small = shared.joined_by_key(large, down, "a", "b", hot_rows)
        joined = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        # (a, b) with b < a on both sides; as (least, greatest) for the next round
        new = shared.written(joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        own, before, known = new, known, new.agg(*mark).first()
        if known == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return own.select(F.col("b").alias("node"), F.col("a").alias("component")).union(own.select(F.col("a"), F.col("a"))).distinct()
