"""Whole runs: the stages in order, and the gold tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.operators import alerts, features, kpis, panels, quality, scoring
from paysieve.params import Params
from paysieve.plans.increments import ALERTS, DAILY, DIMENSION, FACT, refresh_gold
from paysieve.sources import tables
from paysieve.sources.tables import Store
from paysieve.streaming import stages

#: The alerts' search index: grams by hash bucket, and how many alerts have each.
GRAMS, GRAM_COUNTS = ("gold", "alert_grams"), ("gold", "alert_gram_counts")
GRAM_BUCKETS = 64
STAGES = ("landing", "bronze", "silver", "gold")


def build_gold(spark: SparkSession, store: Store, p: Params, run_id: str) -> dict[str, float]:
    """The scored fact, written once; alerts and metrics from what was written."""
    cleansed = store.table(spark, stages.SILVER_TABLE).rows(schemas.SILVER, or_empty=True)
    limit = features.threshold(cleansed, p).first().threshold
    own = scoring.fact(cleansed, p, F.lit(limit)).withColumns({"scored_at": F.current_timestamp(), "scoring_run_id": F.lit(run_id)})
    table = store.table(spark, FACT)
    table.replace(stages.by_day(own), by=("event_date",))
    fact = table.rows(own.schema)
    for where, df in ((ALERTS, scoring.alerts(fact)), (DAILY, kpis.daily(fact)), (DIMENSION, kpis.by_dimension(fact))):
        store.table(spark, where).replace(df)
    counts = fact.agg(F.count(F.lit(1)).alias("scored"), F.count_if(F.col("risk_band") == "HIGH").alias("alerts")).first()
    return {"scored": counts.scored, "alerts": counts.alerts, "high_amount_threshold": limit}


def _gram_bucket() -> Column:
    return F.pmod(F.xxhash64("gram"), F.lit(GRAM_BUCKETS)).cast("int")


def index_alerts(spark: SparkSession, store: Store) -> None:
    """The search index of the stored alerts, in folders by gram and in order within."""
    own = alerts.grams(store.table(spark, ALERTS).rows(schemas.ALERTS)).withColumn("bucket", _gram_bucket())
    table = store.table(spark, GRAMS)
    # a common gram has as many entries as there are alerts: they are dealt by day, too
    table.replace(own.repartition("bucket", "event_date").sortWithinPartitions("bucket", "gram"), by=("bucket",))
    store.table(spark, GRAM_COUNTS).replace(alerts.gram_counts(table.rows()))


def search_alerts(spark: SparkSession, store: Store, *, rules: list[str] | None = None, bank: str | None = None, text: str | None = None) -> DataFrame:
    """Stored alerts by ``alerts.indexed_search``: of the index only the folders of the text's grams are read."""
    wanted = text.strip().lower() if text else ""
    own = [wanted[i : i + alerts.GRAM] for i in range(len(wanted) - alerts.GRAM + 1)]
    index = store.table(spark, GRAMS).rows()
    if own:
        of = spark.createDataFrame([(g,) for g in own], "gram string").select(_gram_bucket().alias("bucket")).distinct()
        index = index.where(F.col("bucket").isin([r.bucket for r in of.collect()]))
    return alerts.indexed_search(store.table(spark, ALERTS).rows(schemas.ALERTS), index.select("gram", F.col("event_date").cast("string").alias("event_date"), "transaction_id"), store.table(spark, GRAM_COUNTS).rows(), rules=rules, bank=bank, text=text)


def run_pipeline(spark: SparkSession, store: Store, p: Params, *, folder: str, salt: str, which: tuple[str, ...] = STAGES, run_id: str | None = None, dedupe: str = "watermark", incremental: bool = False) -> dict[str, dict]:
    """The named stages in their order, with the seconds and counts of each.  incremental: gold goes on from what is there."""
    run_id = run_id or uuid.uuid4().hex[:12]
    steps = {
        "landing": lambda: {"landed": stages.land(spark, store, folder, run_id).rows},
        "bronze": lambda: {"ingested": stages.structure(spark, store, run_id).rows},
        "silver": lambda: {k: v for name, d in stages.cleanse_new(spark, store, p, salt, dedupe=dedupe).items() for k, v in ((name, d.rows), (f"{name}_late", d.late))},
        "gold": lambda: (refresh_gold if incremental else build_gold)(spark, store, p, run_id),
    }
    unknown = set(which) - set(steps)
    if unknown:
        raise ValueError(f"no such stage: {sorted(unknown)}")
    out = {}
    for name in (s for s in STAGES if s in which):
        began = time.monotonic()
        out[name] = steps[name]() | {"run_id": run_id, "seconds": round(time.monotonic() - began, 3)}
    return out


def export_panels(spark: SparkSession, store: Store, p: Params, folder: str, *, labels: DataFrame, environment: str, most_alerts: int | None = None) -> list[str]:
    """JSON files of each panel; one scan of the fact counts for five panels, and each other one reads its own few columns.

    Alerts without a cap are many files.
    """
    of = lambda where, schema=None: store.table(spark, where).rows(schema, or_empty=schema is not None)
    fact = of(FACT)
    bronze, rejects = of(stages.BRONZE_TABLE, schemas.BRONZE), of(stages.QUARANTINE_TABLE, schemas.QUARANTINE)
    own = panels.counted(fact, p)
    counts = spark.createDataFrame(own.collect(), own.schema)  # as few rows as the panels have
    out = {
        "headline": panels.headline(fact, labels, p),
        "funnel": panels.funnel(of(stages.LANDING_TABLE, schemas.LANDING), bronze, rejects, of(stages.SILVER_TABLE, schemas.SILVER), fact),
        "quarantine": quality.reason_counts(rejects),
        "unparseable": panels.unparseable(bronze),
        "daily": kpis.with_flagged_share(of(DAILY).orderBy("event_date")),
        "dimensions": of(DIMENSION).orderBy("dimension", F.desc("total_amount"), "dimension_value"),
        **panels.of_counted(counts, p),
        "amounts": panels.amount_stats(fact, p),
        "detection": quality.with_alerted_share(quality.detection(fact, labels)),
        "alerts": scoring.capped(scoring.alerts(fact), most_alerts),
    }
    for name, df in out.items():
        whole = name == "alerts" and most_alerts is None
        tables.write_panel(df, f"{folder}/{name}", one_file=not whole, environment=environment, engine="Spark", store=store.format)
    return list(out)
