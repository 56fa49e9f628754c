"""Gold tables that go on from what is there: only days that new rows can have changed are scored again.

A new row changes the rows of its own day and of those that its payer's windows reach; the rows of addresses whose number
of payers it changes, on whatever day; and, where it moves the amount threshold, rows with amounts between the old and
the new one.  All these days are found from small tables that are kept beside the fact, then scored from the
cleansed rows of those days and of the days before them that their windows look back to, and put in the place of the old ones.
The tables are the same as after one run over everything.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.operators import features, kpis, scoring
from paysieve.params import Params
from paysieve.sources.tables import Store
from paysieve.streaming import stages

FACT, ALERTS, DAILY, DIMENSION = ("gold", "fact"), ("gold", "fraud_alerts"), ("gold", "kpi_daily"), ("gold", "kpi_by_dimension")
DIMENSION_DAYS, DAY_AMOUNTS, LINKS, LIMITS = ("gold", "dimension_days"), ("gold", "day_amounts"), ("gold", "ip_links"), ("gold", "limits")
#: Hash buckets of the addresses.
BUCKETS = 64


@dataclass
class Refreshed:
    """What a run did: rows scored, days scored, days of cleansed rows that were read for it."""

    scored: int = 0
    days: int = 0
    days_read: int = 0


def _around(days: set[str], before: int, after: int) -> set[str]:
    return {(date.fromisoformat(d) + timedelta(days=k)).isoformat() for d in days for k in range(-before, after + 1)}


def _days(df: DataFrame) -> set[str]:
    """The days of some rows; a history has a few thousand."""
    return {r.event_date for r in df.select("event_date").distinct().collect() if r.event_date is not None}


def _bucket() -> Column:
    return F.pmod(F.xxhash64("ip_hash"), F.lit(BUCKETS)).cast("int")


class _Gold:
    def __init__(self, spark: SparkSession, store: Store, p: Params, run_id: str):
        self.spark, self.store, self.p, self.run_id = spark, store, p, run_id
        self.done = Refreshed()
        #: a window reaches so many days at most, and local days may be a part of one longer
        self.reach = -(-max(p.velocity_seconds, p.fanout_seconds) // 86_400) + 1

    def _table(self, where):
        return self.store.table(self.spark, where)

    def _silver(self, days: set[str]) -> DataFrame:
        return self._table(stages.SILVER_TABLE).rows(schemas.SILVER).where(F.col("event_date").isin(sorted(days)))

    def _limit(self, days: set[str], batch_id: int) -> tuple[float, float | None]:
        """The threshold with the batch, and the one before it; the days' amounts are counted anew."""
        rows = self._silver(days)
        own = features.day_amounts(rows) if self.p.exact_fence else features.day_amount_sketches(rows)
        schema = schemas.DAY_AMOUNTS if self.p.exact_fence else schemas.DAY_SKETCHES
        table = self._table(DAY_AMOUNTS)
        table.replace_parts(own.select(*schema.names[1:], "event_date"), by=("event_date",))
        new = features.merged_threshold(table.rows(schema, or_empty=True), self.p).first().threshold
        limits = self._table(LIMITS)
        before = limits.rows(schemas.LIMITS, or_empty=True).where(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()
        limits.append(self.spark.createDataFrame([(batch_id, new)], schemas.LIMITS).coalesce(1))
        return new, before and before.threshold

    def _days_of_changed_addresses(self, batch: DataFrame, batch_id: int) -> set[str]:
        """Stores the batch's links, and finds the days with addresses that have other numbers of payers now."""
        new = batch.select(_bucket().alias("ip_bucket"), "ip_hash", "payer_key", "event_date").distinct().withColumn("batch_id", F.lit(batch_id).cast("long"))
        links = self._table(LINKS)
        if self.p.null_keys != "group":
            new = new.where(F.isnotnull("ip_hash"))
        links.append(new.select("ip_hash", "payer_key", "event_date", "batch_id", "ip_bucket").repartition(F.col("ip_bucket")), by=("ip_bucket",))
        stored = links.rows(schemas.LINKS)
        mine = stored.where(F.col("batch_id") == batch_id)
        touched = [r.ip_bucket for r in new.select("ip_bucket").distinct().collect()]  # at most BUCKETS
        near = stored.where(F.col("ip_bucket").isin(touched) & (F.col("batch_id") <= batch_id))
        addresses = mine.select(F.col("ip_hash").alias("_ip")).distinct()
        near = near.join(addresses, F.col("ip_hash").eqNullSafe(F.col("_ip")), "left_semi")
        old = F.when(F.col("batch_id") < batch_id, F.col("payer_key"))
        changed = near.groupBy(F.col("ip_hash").alias("_ip")).agg((F.count_distinct(old) != F.count_distinct("payer_key")).alias("_changed")).where("_changed")
        return _days(near.join(changed, F.col("ip_hash").eqNullSafe(F.col("_ip")), "left_semi"))

    def _days_between(self, limit: float, before: float | None) -> set[str]:
        """The days of the fact with amounts that one threshold lets pass and the other does not."""
        fact = self._table(FACT)
        if before is None or before == limit or not fact.there():
            return set()
        amount = F.col("amount")
        return _days(fact.rows().select(F.col("event_date").cast("string").alias("event_date"), "amount").where((amount > min(limit, before)) & (amount <= max(limit, before))))

    def refresh(self, batch: DataFrame, batch_id: int) -> None:
        """A batch that comes again does the same again."""
        days = _days(batch)
        if not days:
            return
        limit, before = self._limit(days, batch_id)
        stale = _around(days, 0, self.reach) | self._days_of_changed_addresses(batch, batch_id) | self._days_between(limit, before)
        read = _around(stale, self.reach, 0)
        links = self._table(LINKS).rows(schemas.LINKS)
        own = scoring.scored(features.with_features(self._silver(read), self.p, links), self.p, F.lit(limit)).drop("event_epoch").where(F.col("event_date").isin(sorted(stale)))
        own = own.withColumns({"scored_at": F.current_timestamp(), "scoring_run_id": F.lit(self.run_id)})
        fact = self._table(FACT)
        fact.replace_parts(stages.by_day(own.select(*(c for c in own.columns if c != "event_date"), "event_date")), by=("event_date",))
        fresh = fact.rows(own.schema).where(F.col("event_date").isin(sorted(stale)))
        for where, df in ((ALERTS, scoring.alerts(fresh)), (DAILY, kpis.daily(fresh)), (DIMENSION_DAYS, kpis.dimension_days(fresh))):
            self._replace_days(where, df, stale)
        self._table(DIMENSION).replace(kpis.of_dimension_days(self._table(DIMENSION_DAYS).rows(schemas.DIMENSION_DAYS)))
        self.done.scored += fresh.count()
        self.done.days += len(stale)
        self.done.days_read += len(read)

    def _replace_days(self, where: tuple[str, str], df: DataFrame, stale: set[str]) -> None:
        """The days' rows anew.  A day that has none now keeps none: an alert that is gone leaves a partition without rows."""
        table = self._table(where)
        columns = [c for c in df.columns if c != "event_date"]
        own = df.select(*columns, "event_date")
        table.replace_parts(stages.by_day(own) if where == ALERTS else own, by=("event_date",))
        if where == ALERTS:
            kept = _days(df)
            table.drop_parts("event_date", sorted(stale - kept))


def refresh_gold(spark: SparkSession, store: Store, p: Params, run_id: str) -> dict[str, float]:
    """The gold tables after the cleansed rows that came since the last call; with the numbers of what it took."""
    gold = _Gold(spark, store, p, run_id)
    rows = store.table(spark, stages.SILVER_TABLE).news(schemas.SILVER)
    store.table(spark, FACT).drain_batches(rows, "gold", gold.refresh)
    return {"scored": gold.done.scored, "days": gold.done.days, "days_read": gold.done.days_read}
