"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.functions import columns as C
from paysieve.operators import alerts as A
from paysieve.operators import cleanse, features, ingest, kpis, panels, quality, scoring
from paysieve.params import Params
from paysieve.plans import pipeline
from paysieve.sources import feeds, scratch, tables
from paysieve.sources.feeds import FEED_PARAMS, SALT
from paysieve.streaming import stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.read(spark, sf_dir, "events")


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.transactions(_events(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str, p: Params = FEED_PARAMS) -> DataFrame:
    return scoring.fact(_feed(spark, sf_dir), p)


def _stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact, written once, for queries that aggregate it several times."""
    own = _fact(spark, sf_dir)
    path = scratch.new_folder(spark, "fact")
    own.write.parquet(path)
    return spark.read.schema(own.schema).parquet(path)


def _reasons_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_join("reasons", ","))


def _structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.raw_lines(_events(spark, sf_dir)).withColumnRenamed("value", "raw_payload")
    return ingest.parsed(lines, "event_id").withColumns({"source_file": F.lit("feed"), "ingested_at": F.current_timestamp()})


def _standardised(spark: SparkSession, sf_dir: str, p: Params = FEED_PARAMS) -> DataFrame:
    return cleanse.standardised(_structured(spark, sf_dir), p, SALT)


@query
def parse_lines(spark, sf_dir):
    own = _structured(spark, sf_dir)
    return own.select("event_id", "is_parseable", "transaction_id", "event_time", C.number(F.col("amount")).alias("amount"), "status", "currency", "payer_vpa", "city", "latency_ms", "raw_payload")


STANDARD = ("transaction_id", "amount", "status", "currency", "txn_type", "payer_bank", "app", "city", "latency_ms", "payer_vpa_masked", "payee_vpa_masked", "payer_phone_masked", "payer_key", "payee_key", "device_hash", "ip_hash", "reject_reason")


@query
def standardise(spark, sf_dir):
    return _standardised(spark, sf_dir).select("event_id", F.unix_seconds("event_time").alias("event_epoch"), *STANDARD)


@query
def silver_rows(spark, sf_dir):
    own = cleanse.accepted(_standardised(spark, sf_dir), FEED_PARAMS)
    return own.select("transaction_id", F.unix_seconds("event_time").alias("event_epoch"), "event_date", "amount", "status", "payer_key", "ip_hash")


@query
def quarantine(spark, sf_dir):
    return cleanse.rejected(_standardised(spark, sf_dir)).select("transaction_id", "event_time", "status", "currency", "reject_reason", "raw_payload")


@query
def quarantine_by_reason(spark, sf_dir):
    return quality.reason_counts(cleanse.rejected(_standardised(spark, sf_dir)))


@query
def masking(spark, sf_dir):
    return _standardised(spark, sf_dir).select("event_id", "payer_vpa_masked", "payer_phone_masked", "payer_key", "device_hash")


@query
def dedupe(spark, sf_dir):
    lines = feeds.resent_lines(_events(spark, sf_dir)).withColumnRenamed("value", "raw_payload")
    rows = ingest.parsed(lines, "event_id").withColumns({"source_file": F.lit("feed"), "ingested_at": F.current_timestamp()})
    own = cleanse.one_per_id(cleanse.accepted(cleanse.standardised(rows, FEED_PARAMS, SALT), FEED_PARAMS))
    return own.select("transaction_id", F.unix_seconds("event_time").alias("event_epoch"), "amount", "status")


@query
def velocity(spark, sf_dir):
    own = features.payer_windows(_feed(spark, sf_dir).withColumn("event_epoch", F.unix_seconds("event_time")), FEED_PARAMS)
    return own.select("transaction_id", "txns_in_window")


@query
def fanout(spark, sf_dir):
    own = features.payer_windows(_feed(spark, sf_dir).withColumn("event_epoch", F.unix_seconds("event_time")), FEED_PARAMS)
    return own.select("transaction_id", "distinct_payees_in_window")


@query
def shared_ip(spark, sf_dir):
    return features.payers_on_ip(_feed(spark, sf_dir), FEED_PARAMS).select("transaction_id", F.col("payers_on_ip").cast("long").alias("payers_on_ip"))


@query
def threshold(spark, sf_dir):
    return features.threshold(_feed(spark, sf_dir), FEED_PARAMS).select("q1", "q3", *(C.rounded(F.col(c), 4).alias(c) for c in ("fence", "threshold")))


#: Approximate percentiles, at an accuracy that makes them exact on tables of up to a million rows.
APPROXIMATE = replace(FEED_PARAMS, exact_fence=False, fence_accuracy=1_000_000)


@query
def threshold_approx(spark, sf_dir):
    return features.threshold(_feed(spark, sf_dir), APPROXIMATE).select("q1", "q3", *(C.rounded(F.col(c), 4).alias(c) for c in ("fence", "threshold")))


@query
def amount_stats_approx(spark, sf_dir):
    return panels.amount_stats(_feed(spark, sf_dir), APPROXIMATE)


@query
def threshold_orders(spark, sf_dir):
    p = Params(exact_fence=True)
    return features.threshold(feeds.orders_feed(spark, sf_dir), p).select("q1", "q3", *(C.rounded(F.col(c), 2).alias(c) for c in ("fence", "threshold")))


@query
def scored(spark, sf_dir):
    own = _reasons_as_text(_fact(spark, sf_dir))
    return own.select("transaction_id", "event_hour", "txns_in_window", "distinct_payees_in_window", "payers_on_ip", "fraud_score", "reasons", "risk_band")


@query
def scored_floor(spark, sf_dir):
    """With the floor of the amount rule, which no event reaches."""
    own = _reasons_as_text(_fact(spark, sf_dir, replace(FEED_PARAMS, fence_floor=50_000.0)))
    return own.groupBy("risk_band", "reasons").agg(F.count(F.lit(1)).alias("transactions"))


ALERT = ("transaction_id", "event_date", "amount", "status", "payer_bank", "app", "city", "ip_hash", "fraud_score", "reasons")


@query
def alerts(spark, sf_dir):
    return _reasons_as_text(scoring.alerts(_fact(spark, sf_dir))).select(*ALERT)


@query
def alerts_topk(spark, sf_dir):
    return _reasons_as_text(scoring.capped(scoring.alerts(_fact(spark, sf_dir)), 15)).select(*ALERT, "truncated")


@query
def alert_page(spark, sf_dir):
    """The second page of the latest alerts."""
    own = scoring.alerts(_fact(spark, sf_dir))
    return _reasons_as_text(A.page(own, sort="event_time", number=1)).select(*ALERT)


@query
def alert_search(spark, sf_dir):
    own = scoring.alerts(_fact(spark, sf_dir))
    return _reasons_as_text(A.search(own, rules=["shared_ip", "high_amount"], bank="B0", text=" C0 ")).select(*ALERT)


@query
def score_breakdown(spark, sf_dir):
    return A.breakdown(scoring.alerts(_fact(spark, sf_dir)), FEED_PARAMS)


@query
def alert_facets(spark, sf_dir):
    return A.facets(scoring.alerts(_fact(spark, sf_dir)))


@query
def alert_banks(spark, sf_dir):
    return A.banks(scoring.alerts(_fact(spark, sf_dir)))


@query
def kpi_daily(spark, sf_dir):
    return kpis.daily(_fact(spark, sf_dir))


@query
def kpi_daily_share(spark, sf_dir):
    return kpis.with_flagged_share(kpis.daily(_fact(spark, sf_dir))).select("event_date", "flagged_share")


@query
def kpi_by_dimension(spark, sf_dir):
    return kpis.by_dimension(_fact(spark, sf_dir))


@query
def kpi_orders(spark, sf_dir):
    """Orders by segment, priority and nation; none is flagged, as only payments are scored."""
    return kpis.by_dimension(feeds.orders_feed(spark, sf_dir).withColumn("risk_band", F.lit("LOW")))


@query
def top_banks(spark, sf_dir):
    return kpis.top_banks(kpis.by_dimension(_fact(spark, sf_dir)), 3)


LABELS_A_FILE = 20_000


def _label_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's labels, written as map files by Spark and read again."""
    own = feeds.labels(_feed(spark, sf_dir))
    folder = scratch.new_folder(spark, "labels")
    # a file for about so many ids; the second run's files name some ids again, and are later
    shares = own.count() // LABELS_A_FILE + 1
    share = F.pmod(F.xxhash64("transaction_id"), F.lit(shares))
    packed = lambda df, at: df.groupBy(share.alias("s")).agg(F.map_from_entries(F.collect_list(F.struct("transaction_id", "injected_type"))).alias("labels")).select(F.lit(at).alias("generated_at"), "labels")
    first = packed(own.withColumn("injected_type", F.when(F.col("injected_type") == "odd_hour", "unknown").otherwise(F.col("injected_type"))), "2026-01-01T00:00:00Z")
    second = packed(own.where("injected_type = 'odd_hour'"), "2026-01-02T00:00:00Z")
    first.unionByName(second).write.option("maxRecordsPerFile", 1).json(folder)
    return quality.labels_of(tables.label_files(spark, folder))


@query
def label_scan(spark, sf_dir):
    return _label_scan(spark, sf_dir)


@query
def detection(spark, sf_dir):
    return quality.with_alerted_share(quality.detection(_fact(spark, sf_dir), feeds.labels(_feed(spark, sf_dir))))


@query
def precision(spark, sf_dir):
    return quality.precision(_fact(spark, sf_dir), feeds.labels(_feed(spark, sf_dir)))


@query
def bands(spark, sf_dir):
    return quality.band_counts(_fact(spark, sf_dir))


@query
def score_hist(spark, sf_dir):
    return panels.score_histogram(_fact(spark, sf_dir), FEED_PARAMS)


@query
def rule_counts(spark, sf_dir):
    return panels.rule_counts(_fact(spark, sf_dir))


@query
def combinations(spark, sf_dir):
    return panels.combinations(_fact(spark, sf_dir), FEED_PARAMS)


@query
def amount_stats(spark, sf_dir):
    return panels.amount_stats(_feed(spark, sf_dir), FEED_PARAMS)


@query
def amount_hist(spark, sf_dir):
    return panels.amount_histogram(_feed(spark, sf_dir))


@query
def headline(spark, sf_dir):
    return panels.headline(_stored_fact(spark, sf_dir), feeds.labels(_feed(spark, sf_dir)), FEED_PARAMS)


@query
def funnel(spark, sf_dir):
    # written once, as every layer counts it; a line is landed for each event
    own = _standardised(spark, sf_dir).select("transaction_id", "is_parseable", "reject_reason")
    path = scratch.new_folder(spark, "funnel")
    own.write.parquet(path)
    rows = spark.read.schema(own.schema).parquet(path)
    kept = cleanse.one_per_id(rows.where(F.isnull("reject_reason")))
    return panels.funnel(_events(spark, sf_dir), rows, rows.where(F.isnotnull("reject_reason")), kept, kept)


@query
def unparseable(spark, sf_dir):
    return panels.unparseable(_structured(spark, sf_dir))


@query
def reconcile(spark, sf_dir):
    fact = _stored_fact(spark, sf_dir)
    return quality.reconciliation(fact, kpis.daily(fact), kpis.by_dimension(fact))


@query
def accounting(spark, sf_dir):
    rows = _standardised(spark, sf_dir)
    return quality.accounting(rows, cleanse.one_per_id(cleanse.accepted(rows, FEED_PARAMS)), cleanse.rejected(rows))


@query
def disclosure_scan(spark, sf_dir):
    """Raw identifiers in the cleansed layer: none."""
    return quality.disclosures(cleanse.accepted(_standardised(spark, sf_dir), FEED_PARAMS))


@query
def disclosure_texts(spark, sf_dir):
    """Raw identifiers in conversations."""
    return quality.disclosures(feeds.read(spark, sf_dir, "conversations").select("role", "text"))


def _drained(spark: SparkSession, sf_dir: str) -> tables.Store:
    """The feed as text files, landed and structured in a store of its own."""
    folder = scratch.new_folder(spark, "stream")
    feeds.resent_lines(_events(spark, sf_dir)).select("value").write.text(f"{folder}/raw")
    store = tables.Store(f"{folder}/store")
    stages.land(spark, store, f"{folder}/raw", "run-1")
    return store


@query
def stream_landing(spark, sf_dir):
    store = _drained(spark, sf_dir)
    return store.table(spark, stages.LANDING_TABLE).rows().select("raw_payload", "landing_run_id")


@query
def landing_provenance(spark, sf_dir):
    """Each landed line with the folder of the file that it came in."""
    folder = scratch.new_folder(spark, "stream")
    feeds.raw_lines(_events(spark, sf_dir)).select("value", (F.col("event_id") % 2).alias("half")).write.partitionBy("half").text(f"{folder}/raw")
    store = tables.Store(f"{folder}/store")
    stages.land(spark, store, f"{folder}/raw", "run-1")
    own = store.table(spark, stages.LANDING_TABLE).rows()
    return own.select("raw_payload", F.regexp_extract("source_file", r"/half=(\d)/part-[^/]*$", 1).alias("half"), F.isnotnull("landed_at").alias("timed"))


@query
def stream_silver(spark, sf_dir):
    store = _drained(spark, sf_dir)
    stages.structure(spark, store, "run-1")
    stages.cleanse_new(spark, store, FEED_PARAMS, SALT)
    return store.table(spark, stages.SILVER_TABLE).rows().select("transaction_id", F.unix_seconds("event_time").alias("event_epoch"), "amount", "status")


def _store(spark: SparkSession, folder: str, *, catalog: bool = False) -> tables.Store:
    """A store below the folder, or in a catalog whose schemas no other run uses."""
    return tables.Store(f"{folder}/store", catalog="spark_catalog", prefix=f"run_{folder.rpartition('-')[2]}_") if catalog else tables.Store(f"{folder}/store")


def _run_all(spark: SparkSession, batches: list[DataFrame], dedupe: str, *, catalog: bool = False, gold: bool = False) -> tuple[tables.Store, list[dict]]:
    """A store after one run of the streams (and of incremental gold) for each batch of files, and the runs' reports."""
    folder = scratch.new_folder(spark, "runs")
    store, reports = _store(spark, folder, catalog=catalog), []
    for lines in batches:
        lines.select("value").write.mode("append").text(f"{folder}/raw")
        reports.append(pipeline.run_pipeline(spark, store, FEED_PARAMS, folder=f"{folder}/raw", salt=SALT, which=pipeline.STAGES[: 3 + gold], dedupe=dedupe, incremental=gold))
    return store, reports


def _run_counts(spark: SparkSession, reports: list[dict]) -> DataFrame:
    rows = [(i, r["landing"]["landed"], r["bronze"]["ingested"], r["silver"]["cleansed"], r["silver"]["cleansed_late"], r["silver"]["quarantined"]) for i, r in enumerate(reports, 1)]
    return spark.createDataFrame(rows, "run int, landed long, ingested long, cleansed long, late long, quarantined long")


def _three_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """A run, a second one over new files that also repeat lines of the first, and one over nothing new."""
    events = _events(spark, sf_dir)
    return [feeds.raw_lines(events.where(some)) for some in ("event_id % 3 <> 0", "event_id % 3 = 0 or event_id % 67 = 0", "false")]


def _even_then_odd(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The second run's rows are late where they are older than the first run's watermark."""
    events = _events(spark, sf_dir)
    return [feeds.raw_lines(events.where(f"event_id % 2 = {half}")) for half in (0, 1)]


@query
def stream_runs(spark, sf_dir):
    return _run_counts(spark, _run_all(spark, _three_batches(spark, sf_dir), "table")[1])


@query
def stream_runs_catalog(spark, sf_dir):
    """The same with tables in a catalog's schemas."""
    return _run_counts(spark, _run_all(spark, _three_batches(spark, sf_dir), "table", catalog=True)[1])


@query
def stream_ids(spark, sf_dir):
    """The ids that the exact collapsing of copies has stored, with the run that brought each."""
    store, _ = _run_all(spark, _three_batches(spark, sf_dir), "table")
    return store.table(spark, stages.IDS_TABLE).rows(schemas.IDS).select("transaction_id", (F.col("batch_id") + 1).cast("int").alias("run"))


@query
def stream_late_rows(spark, sf_dir):
    return _run_counts(spark, _run_all(spark, _even_then_odd(spark, sf_dir), "watermark")[1])


@query
def late_rows(spark, sf_dir):
    """The rows that were kept out as late, themselves."""
    store, _ = _run_all(spark, _even_then_odd(spark, sf_dir), "watermark")
    return store.table(spark, stages.LATE_TABLE).rows(schemas.LATE).select("transaction_id", F.unix_seconds("event_time").alias("event_epoch"), "amount", "status", "payer_key")


@query
def stream_accounting(spark, sf_dir):
    """Every structured row is cleansed, quarantined, late or a copy, with rows that repeat and rows that are late."""
    lines = feeds.raw_lines(_events(spark, sf_dir))
    store, _ = _run_all(spark, [lines.where("event_id % 2 = 0"), lines.where("event_id % 2 = 1 or event_id % 67 = 0")], "watermark")
    of = lambda where, schema: store.table(spark, where).rows(schema)
    return quality.accounting(of(stages.BRONZE_TABLE, schemas.BRONZE), of(stages.SILVER_TABLE, schemas.SILVER), of(stages.QUARANTINE_TABLE, schemas.QUARANTINE), late=of(stages.LATE_TABLE, schemas.LATE))


@query
def layer_lineage(spark, sf_dir):
    """The run and the times that each layer's rows carry, counted."""
    folder = scratch.new_folder(spark, "lineage")
    store = _store(spark, folder)
    feeds.raw_lines(_events(spark, sf_dir)).select("value").write.text(f"{folder}/raw")
    pipeline.run_pipeline(spark, store, FEED_PARAMS, folder=f"{folder}/raw", salt=SALT, which=pipeline.STAGES[:3], run_id="run-5")
    counted = lambda layer, where, schema, run, at: store.table(spark, where).rows(schema).groupBy(F.lit(layer).alias("layer"), run.alias("run_id"), F.isnotnull(at).alias("timed")).agg(F.count(F.lit(1)).alias("rows"))
    none = F.lit(None).cast("string")
    return (
        counted("bronze", stages.BRONZE_TABLE, schemas.BRONZE, F.col("ingest_run_id"), "ingested_at")
        .union(counted("silver", stages.SILVER_TABLE, schemas.SILVER, none, "cleansed_at"))
        .union(counted("quarantine", stages.QUARANTINE_TABLE, schemas.QUARANTINE, none, "rejected_at"))
    )


@query
def tables_there(spark, sf_dir):
    """Which tables of a store exist after the streams, and their rows; 0 of those that do not."""
    store, _ = _run_all(spark, _three_batches(spark, sf_dir)[:1], "table")
    names = {"landing": stages.LANDING_TABLE, "bronze": stages.BRONZE_TABLE, "silver": stages.SILVER_TABLE, "late": stages.LATE_TABLE, "fact": pipeline.FACT}
    found = [(name, (t := store.table(spark, where)).there(), t.count()) for name, where in names.items()]
    return spark.createDataFrame(found, "name string, there boolean, rows long")


@query
def gold_lineage(spark, sf_dir):
    """The run that scored each row of the fact."""
    store = tables.Store(scratch.new_folder(spark, "gold"))
    silver = cleanse.one_per_id(cleanse.accepted(_standardised(spark, sf_dir), FEED_PARAMS))
    store.table(spark, stages.SILVER_TABLE).replace(silver, by=("event_date",))
    pipeline.build_gold(spark, store, FEED_PARAMS, "run-7")
    return store.table(spark, pipeline.FACT).rows().select("transaction_id", "scoring_run_id", F.isnotnull("scored_at").alias("timed"))


@query
def panel_daily(spark, sf_dir):
    """The daily panel as written to JSON and read back."""
    own = kpis.with_flagged_share(kpis.daily(_fact(spark, sf_dir)))
    path = scratch.new_folder(spark, "panel")
    tables.write_panel(own, path, environment="test", engine="Spark", store="parquet")
    return tables.read_panel(spark, path, "event_date string, txn_count long, total_amount double, flagged_share double, source struct<environment: string, engine: string>").select("event_date", "txn_count", "total_amount", "flagged_share", "source.environment", "source.engine")


@query
def gold_daily(spark, sf_dir):
    """A whole run from files to gold: landing, structuring, cleansing, scoring, metrics."""
    folder = scratch.new_folder(spark, "run")
    feeds.resent_lines(_events(spark, sf_dir)).select("value").write.text(f"{folder}/raw")
    store = tables.Store(f"{folder}/store")
    pipeline.run_pipeline(spark, store, FEED_PARAMS, folder=f"{folder}/raw", salt=SALT)
    return store.table(spark, pipeline.DAILY).rows()


@query
def gold_incremental(spark, sf_dir):
    """The days' metrics after two runs, of which the second scores only what it changes: those of one run over everything."""
    store, _ = _run_all(spark, _even_then_odd(spark, sf_dir), "table", gold=True)
    return store.table(spark, pipeline.DAILY).rows(schemas.KPI_DAILY)


@query
def gold_incremental_dimensions(spark, sf_dir):
    store, _ = _run_all(spark, _even_then_odd(spark, sf_dir), "table", gold=True)
    return store.table(spark, pipeline.DIMENSION).rows(schemas.KPI_DIMENSION)


#: Shares that the sketches of amounts are asked for, and how far the rank of what they answer may be off.
SKETCHED, RANK_ERROR = {"q1": 0.25, "median": 0.5, "q3": 0.75, "percentile_995": 0.995}, 0.005


@query
def quantile_sketches(spark, sf_dir):
    """For each share: whether the days' sketches together answer within the error, and the rows behind them."""
    feed = _feed(spark, sf_dir)
    found = features.merged_quantiles(features.day_amount_sketches(feed), SKETCHED).first()  # one row
    counts = {n: F.struct(F.lit(n).alias("name"), F.lit(s).alias("share"), F.count_if(F.col("amount") < found[n]).alias("below"), F.count_if(F.col("amount") <= found[n]).alias("upto")) for n, s in SKETCHED.items()}
    each = feed.where("status = 'SUCCESS'").agg(F.count(F.lit(1)).alias("rows"), F.array(*counts.values()).alias("each")).select("rows", F.inline("each"))
    rank = F.col("share") * F.col("rows")
    most = RANK_ERROR * F.col("rows") + 1
    return each.select("name", "rows", ((F.col("below") <= rank + most) & (F.col("upto") >= rank - most)).alias("within"))


@query
def payer_sketches(spark, sf_dir):
    """Each address's distinct payers, exactly, and whether its days' sketches together say so to 5 %."""
    feed = _feed(spark, sf_dir)
    exact = feed.groupBy("ip_hash").agg(F.count_distinct("payer_key").alias("payers"))
    found = features.merged_payers(features.payer_sketches(feed, "ip_hash", "event_date"), "ip_hash").withColumnRenamed("payers", "estimate")
    return exact.join(found, "ip_hash").select("ip_hash", "payers", (F.abs(F.col("estimate") - F.col("payers")) <= 0.05 * F.col("payers")).alias("within"))


@query
def payer_sketches_daily(spark, sf_dir):
    """The same of each day, and of all days."""
    feed = _feed(spark, sf_dir)
    exact = feed.groupBy("event_date").agg(F.count_distinct("payer_key").alias("payers")).union(feed.agg(F.lit("all"), F.count_distinct("payer_key")))
    days = features.payer_sketches(feed, "event_date")
    found = features.merged_payers(days, "event_date").union(features.merged_payers(days.select(F.lit("all").alias("event_date"), "payers"), "event_date")).withColumnRenamed("payers", "estimate")
    return exact.join(found, "event_date").select("event_date", "payers", (F.abs(F.col("estimate") - F.col("payers")) <= 0.05 * F.col("payers")).alias("within"))


def _stored_alerts(spark: SparkSession, sf_dir: str) -> tables.Store:
    """Alerts by day, their search index and its counts, in a store."""
    store = tables.Store(scratch.new_folder(spark, "alerts"))
    store.table(spark, pipeline.ALERTS).replace(scoring.alerts(_fact(spark, sf_dir)), by=("event_date",))
    pipeline.index_alerts(spark, store)
    return store


@query
def alert_search_indexed(spark, sf_dir):
    """A search by the index of grams."""
    return _reasons_as_text(pipeline.search_alerts(spark, _stored_alerts(spark, sf_dir), text=" 0042")).select(*ALERT)


@query
def alert_grams(spark, sf_dir):
    """How many alerts have each run of three letters."""
    store = _stored_alerts(spark, sf_dir)
    return store.table(spark, pipeline.GRAM_COUNTS).rows()


@query
def alert_page_after(spark, sf_dir):
    """The second page of the latest alerts, from the last row of the first."""
    own = scoring.alerts(_fact(spark, sf_dir))
    first = A.page_after(own, sort="event_time").collect()  # a page
    return _reasons_as_text(A.page_after(own, first[-1] if first else None, sort="event_time")).select(*ALERT)


@query
def panels_at_once(spark, sf_dir):
    """The counts of five panels by one scan."""
    return panels.counted(_fact(spark, sf_dir), FEED_PARAMS)


@query
def panels_exported(spark, sf_dir):
    """Panels of a whole export, as read back from their files."""
    store = tables.Store(scratch.new_folder(spark, "export"))
    own = _fact(spark, sf_dir)
    table = store.table(spark, pipeline.FACT)
    table.replace(own)
    fact = table.rows(own.schema)  # scored once, as gold is
    for where, df in ((pipeline.DAILY, kpis.daily(fact)), (pipeline.DIMENSION, kpis.by_dimension(fact))):
        store.table(spark, where).replace(df)
    folder = scratch.new_folder(spark, "panels")
    pipeline.export_panels(spark, store, FEED_PARAMS, folder, labels=feeds.labels(_feed(spark, sf_dir)), environment="test", most_alerts=15)
    read = lambda name, key, of: tables.read_panel(spark, f"{folder}/{name}", f"{key} string, {of} long").select(F.lit(name).alias("panel"), F.col(key).alias("key"), F.col(of).alias("rows"))
    return read("bands", "risk_band", "transactions").union(read("histogram", "bucket", "transactions")).union(read("rules", "rule", "fired")).union(read("daily", "event_date", "txn_count")).union(read("dimensions", "dimension_value", "txn_count")).union(read("detection", "injected_type", "injected")).union(read("alerts", "transaction_id", "fraud_score"))
