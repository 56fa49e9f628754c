"""Landing, structured and cleansed layers as incremental streams that drain what is new and stop."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.operators import cleanse, ingest
from paysieve.params import Params
from paysieve.sources.tables import Drained, Store, Table, text_lines

LANDING_TABLE, BRONZE_TABLE, SILVER_TABLE, QUARANTINE_TABLE = ("landing", "lines"), ("bronze", "transactions"), ("silver", "transactions"), ("quarantine", "rejects")
#: Beside the cleansed rows: their ids, the rows that came too late, and a row for each run's begin and end.
IDS_TABLE, LATE_TABLE, RUNS_TABLE = ("silver", "transaction_ids"), ("silver", "late_rows"), ("silver", "cleansing_runs")


def land(spark: SparkSession, store: Store, folder: str, run_id: str, **options: str) -> Drained:
    """New lines of text files, untouched, with their file."""
    return store.table(spark, LANDING_TABLE).drain(ingest.landed(text_lines(spark, folder, **options), run_id), "landing")


def structure(spark: SparkSession, store: Store, run_id: str) -> Drained:
    """New landed lines, parsed; partitioned by ingest date."""
    lines = store.table(spark, LANDING_TABLE).news(schemas.LANDING)
    rows = ingest.structured(lines, run_id).select(*schemas.BRONZE.names)
    return store.table(spark, BRONZE_TABLE).drain(rows, "bronze", by=("ingest_date",))


#: Files that a batch writes of a day.
FILES_A_DAY = 4


def by_day(rows: DataFrame) -> DataFrame:
    """A day's rows in few tasks, for a table in folders by day: else each task writes a file of each day."""
    return rows.repartition("event_date", F.pmod(F.xxhash64("transaction_id"), F.lit(FILES_A_DAY)))


def deduplicated(rows: DataFrame, p: Params) -> DataFrame:
    """One row of each id within the watermark.  Rows older than it are dropped, and counted as late."""
    return rows.withWatermark("event_time", p.watermark).dropDuplicatesWithinWatermark(["transaction_id"])


def cleanse_new(spark: SparkSession, store: Store, p: Params, salt: str, *, dedupe: str = "watermark", id_buckets: int = 64) -> dict[str, Drained]:
    """New structured rows into the cleansed and the quarantine table, by streams with checkpoints of their own.

    Copies are collapsed after rejection, so that a bad copy never hides a good one.  dedupe: ``watermark``
    keeps bounded state and drops late rows, which go to a table of their own; ``table`` compares with the stored ids and drops
    none.  A store keeps the way that it began with, since neither knows what the other has seen.
    """
    if dedupe not in ("watermark", "table"):
        raise ValueError(f"dedupe: {dedupe}")
    runs = store.table(spark, RUNS_TABLE)
    begun = _begun(runs, dedupe, id_buckets)
    news = store.table(spark, BRONZE_TABLE).news(schemas.BRONZE)
    good = cleanse.accepted(cleanse.standardised(news, p, salt), p)
    if dedupe == "watermark":
        kept = store.table(spark, SILVER_TABLE).drain(by_day(deduplicated(good, p)), "silver", by=("event_date",))
        if kept.late or begun.pending:
            _append_late(spark, store, good, None if begun.pending else kept.watermark)
    else:
        kept = _append_unseen(spark, store, good, begun.id_buckets)
    runs.append(_run_row(spark, dedupe, begun.id_buckets, ended=True))
    return {"cleansed": kept, "quarantined": store.table(spark, QUARANTINE_TABLE).drain(cleanse.rejected(cleanse.standardised(news, p, salt, hidden=False)), "silver_quarantine")}


@dataclass(frozen=True)
class _Begun:
    """The store's hash buckets, and whether a run before this one did not come to its end."""

    id_buckets: int
    pending: bool


def _run_row(spark: SparkSession, dedupe: str, id_buckets: int, *, ended: bool) -> DataFrame:
    return spark.createDataFrame([(dedupe, id_buckets, ended)], "dedupe string, id_buckets int, ended boolean").coalesce(1)


def _begun(runs: Table, dedupe: str, id_buckets: int) -> _Begun:
    """Marks a run's begin.  The store's first run decides how copies are collapsed, and the number of hash buckets."""
    before = runs.rows().agg(F.first("dedupe").alias("dedupe"), F.first("id_buckets").alias("id_buckets"), F.sum(F.when(F.col("ended"), -1).otherwise(1)).alias("open")).first() if runs.there() else None
    if before and before.dedupe != dedupe:
        raise ValueError(f"this store collapses copies by {before.dedupe!r}: start another store to do it by {dedupe!r}")
    own = before.id_buckets if before else id_buckets
    runs.append(_run_row(runs.spark, dedupe, own, ended=False))
    # a run that did not end leaves its begin without an end: from then on all batches look for late rows
    return _Begun(own, bool(before and before.open > 0))


def id_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("transaction_id"), F.lit(buckets)).cast("int")


def _append_unseen(spark: SparkSession, store: Store, good: DataFrame, buckets: int) -> Drained:
    """Append rows whose id is not stored yet.

    Ids are stored beside the rows, in folders by hash bucket; a batch reads the folders of its own ids.  The batch's ids are
    stored first, under its number.  A batch that is run again so finds that it began before, looks for its rows in the cleansed
    table, and adds those that are missing.  (A batch's number is the checkpoint's, which the store has one of.)
    """
    written = 0
    silver, ids = store.table(spark, SILVER_TABLE), store.table(spark, IDS_TABLE)

    def append(batch: DataFrame, batch_id: int) -> None:
        nonlocal written
        own = cleanse.one_per_id(batch).withColumn("id_bucket", id_bucket(buckets)).persist()
        try:
            again = False
            if ids.there():
                touched = [r.id_bucket for r in own.select("id_bucket").distinct().collect()]  # at most ``buckets``
                known = ids.rows(schemas.IDS).where(F.col("id_bucket").isin(touched))
                again = not known.where(F.col("batch_id") == batch_id).isEmpty()
                unseen = own.join(known.where(F.col("batch_id") != batch_id), ["id_bucket", "transaction_id"], "left_anti")
            else:
                unseen = own
            if again:
                unseen = unseen.join(silver.rows(schemas.SILVER, or_empty=True).select("transaction_id"), "transaction_id", "left_anti")
            else:
                # a bucket's ids are one file a batch
                mine = unseen.select("transaction_id", F.lit(batch_id).cast("long").alias("batch_id"), "id_bucket")
                ids.append(mine.repartition(F.col("id_bucket")), by=("id_bucket",))
            written += silver.append(by_day(unseen.select(*schemas.SILVER.names)), by=("event_date",))
        finally:
            own.unpersist()

    silver.drain_batches(good, "silver", append)
    return Drained(written)


def _append_late(spark: SparkSession, store: Store, good: DataFrame, watermark: str | None) -> None:
    """The rows, one of each id, that the watermark kept out: good, not after the watermark, and not in the cleansed table.

    From a checkpoint of its own, so that what came before is made good; without a watermark all rows are looked for.
    """
    silver, late = store.table(spark, SILVER_TABLE), store.table(spark, LATE_TABLE)

    def append(batch: DataFrame, batch_id: int) -> None:
        old = batch if watermark is None else batch.where(F.col("event_time") <= F.to_timestamp(F.lit(watermark)))
        stored = silver.rows(schemas.SILVER, or_empty=True).select("transaction_id")
        own = cleanse.one_per_id(old.join(stored, "transaction_id", "left_anti")).withColumn("late_batch", F.lit(batch_id).cast("long"))
        # a folder a batch, replaced as a whole: a repeated batch writes the same rows again
        late.replace_parts(own.select(*schemas.LATE.names), by=("late_batch",))

    late.drain_batches(good, "silver_late", append)
