"""Transaction feeds projected from the ``events`` and ``orders`` tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from paysieve.functions import columns as C
from paysieve.params import Params

#: Events are sparse, so that the feeds are scored over whole days.
FEED_PARAMS = Params(fence_floor=0.0, velocity_seconds=86_400, velocity_most=6, fanout_seconds=86_400, fanout_most=6, exact_fence=True)
SALT = "feed-salt"
#: A fixed offset stands for the feeds' zone in SQL; it has had no other since 1945.
OFFSET_MINUTES = 330


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table.  Times stored as instants are wall clocks of UTC, as those stored without a zone are, whatever the session's zone is."""
    own = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return own.withColumns({f.name: C.local(F.col(f.name), "UTC") for f in own.schema if isinstance(f.dataType, TimestampType)})


def _instant(ts):
    """An NTZ time as the instant that it is in UTC, also where the session's zone leaves that time out."""
    return F.concat(ts.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def transactions(events: DataFrame) -> DataFrame:
    """A cleansed-shaped feed, one row an event."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    local = F.col("ts").cast("timestamp_ntz") + F.expr(f"INTERVAL {OFFSET_MINUTES} MINUTES")
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("TXN"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("transaction_id"),
        _instant(F.col("ts")).alias("event_time"),
        C.day(local).alias("event_date"),
        F.col("value").alias("amount"),
        F.when(kind == "error", "FAILED").when(kind == "signup", "PENDING").otherwise("SUCCESS").alias("status"),
        F.lit("INR").alias("currency"),
        F.when(k % 2 == 0, "P2P").otherwise("P2M").alias("txn_type"),
        user.cast("string").alias("payer_key"),
        k.cast("string").alias("payee_key"),
        F.concat(F.lit("B"), (user % 8).cast("string")).alias("payer_bank"),
        kind.alias("app"),
        F.concat(F.lit("C"), (user % 5).cast("string")).alias("city"),
        F.when(user % 10 == 0, F.concat(F.lit("shared-"), (user % 3).cast("string"))).otherwise(F.concat(F.lit("ip-"), user.cast("string"))).alias("ip_hash"),
        "event_id",
        "user_id",
    )


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments by market segment and nation: a second feed of other amounts."""
    people = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    own = read(spark, sf_dir, "orders").join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "P", "PENDING").otherwise("FAILED")
    return own.select(
        F.concat(F.lit("ORD"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("transaction_id"),
        _instant(F.col("o_orderdate")).alias("event_time"),
        C.day(F.col("o_orderdate").cast("timestamp_ntz")).alias("event_date"),
        F.col("o_totalprice").alias("amount"),
        status.alias("status"),
        F.col("o_custkey").cast("string").alias("payer_key"),
        F.col("c_mktsegment").alias("payer_bank"),
        F.col("o_orderpriority").alias("app"),
        F.col("n_name").alias("city"),
    )


def _once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns, computed once, whatever reads them: projections are merged, a generator is not.

    Several of them in a row are several generated methods, each short enough (8000 bytes) for the JVM to compile.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def raw_lines(events: DataFrame) -> DataFrame:
    """NDJSON lines with planted defects: value and event_id."""
    e, user = F.col("event_id"), F.col("user_id")
    # a file of few row groups is few tasks; lines are much work for few bytes
    feed = transactions(events.repartition("event_id")).withColumn("_t", F.unix_seconds("event_time"))
    every = lambda n, r=0: e % n == r
    utc = C.local(F.timestamp_seconds("_t"), "UTC")
    iso = F.concat(F.translate(utc.cast("string"), " ", "T"), F.lit("Z"))
    shown = (utc + F.expr(f"INTERVAL {OFFSET_MINUTES} MINUTES")).cast("string")
    here = F.concat(shown.substr(9, 2), F.lit("-"), shown.substr(6, 2), F.lit("-"), shown.substr(1, 4), shown.substr(11, 9))
    time = F.when(every(127), None).when(every(131), "yesterday").when(every(5, 1), (F.col("_t") * 1000).cast("string")).when(every(5, 2), here).otherwise(iso)
    plain = F.col("amount").cast("decimal(18,2)")
    amount = F.when(every(109), None).when(every(137), F.lit("abc")).when(every(101), (-plain).cast("string")).when(every(139), F.lit("0")).when(every(149), F.lit("7250000")).otherwise(plain.cast("string"))
    quoted = every(137) | every(3) & ~every(101) & ~every(139) & ~every(149)
    status = F.when(every(151), "ON_HOLD").when(every(7), F.concat(F.lit("  "), F.lower("status"), F.lit("  "))).otherwise(F.col("status"))
    currency = F.when(every(157), "USD").when(every(11), " inr ").otherwise("INR")
    sent_id = F.when(every(113), None).otherwise(F.col("transaction_id"))
    valued = _once(feed, "event_id", "user_id", sent_id.alias("transaction_id"), time.alias("_time"), amount.alias("_amount"), status.alias("status"), currency.alias("currency"), "txn_type", "payee_key", "payer_bank", "app", "city")
    text = {
        "transaction_id": F.col("transaction_id"),
        "event_time": F.col("_time"),
        "payer_vpa": F.concat(F.lit("user"), F.lpad(user.cast("string"), 6, "0"), F.lit("@okb"), (user % 8).cast("string")),
        "payee_vpa": F.concat(F.lit("merchant"), F.lpad("payee_key", 5, "0"), F.lit("@ybl")),
        "currency": F.col("currency"),
        "status": F.col("status"),
        "txn_type": F.col("txn_type"),
        "payer_bank": F.col("payer_bank"),
        "app": F.col("app"),
        "device_id": F.concat(F.lit("DEV-"), user.cast("string")),
        "ip_address": F.concat(F.lit("10.0."), (user % 250).cast("string"), F.lit(".1")),
        "city": F.col("city"),
        "payer_phone": F.concat(F.lit("9"), F.lpad(user.cast("string"), 9, "0")),
    }
    members = lambda names: F.concat_ws(",", *(F.concat(F.lit(f'"{n}":'), F.coalesce(F.concat(F.lit('"'), text[n], F.lit('"')), F.lit("null"))) for n in names))
    names = list(text)
    halves = _once(valued, "event_id", members(names[:6]).alias("_first"), members(names[6:]).alias("_second"), "_amount")
    amount_json = F.when(F.isnull("_amount"), "null").when(quoted, F.concat(F.lit('"'), "_amount", F.lit('"'))).otherwise(F.col("_amount"))
    numbers = F.concat(F.lit('"amount":'), amount_json, F.lit(',"latency_ms":'), (e % 900).cast("string"))
    line = F.concat(F.lit("{"), F.concat_ws(",", "_first", "_second", numbers), F.lit("}"))
    return _once(halves, F.when(every(163), F.left(line, F.lit(30))).otherwise(line).alias("value"), "event_id")


def resent_lines(events: DataFrame) -> DataFrame:
    """``raw_lines``, and a second copy of some."""
    return raw_lines(events).unionAll(raw_lines(events.where("event_id % 67 = 0")))


def labels(feed: DataFrame) -> DataFrame:
    """Labels of the ``transactions`` feed by a rule."""
    hour = F.hour(C.local(F.col("event_time"), "UTC") + F.expr(f"INTERVAL {OFFSET_MINUTES} MINUTES"))
    kind = F.when(F.col("amount") > 200, "high_amount").when((F.col("user_id") % 10 == 0) & (F.col("event_id") % 4 == 0), "velocity").when((hour < 5) & (F.col("event_id") % 6 == 0), "odd_hour")
    return feed.select("transaction_id", kind.alias("injected_type")).where("injected_type is not null")


# The same feeds in SQL for DuckDB.

TRANSACTIONS_SQL = """
SELECT 'TXN' || lpad(event_id::VARCHAR, 12, '0') AS transaction_id, ts AS event_time, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d') AS event_date,
    hour(ts + INTERVAL 330 MINUTE)::INTEGER AS event_hour, epoch_us(ts) // 1000000 AS event_epoch, value AS amount,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'SUCCESS' END AS status,
    CASE WHEN json_extract_string(props, '$.k')::INT % 2 = 0 THEN 'P2P' ELSE 'P2M' END AS txn_type,
    user_id::VARCHAR AS payer_key, json_extract_string(props, '$.k') AS payee_key, 'B' || (user_id % 8) AS payer_bank, event_type AS app, 'C' || (user_id % 5) AS city,
    CASE WHEN user_id % 10 = 0 THEN 'shared-' || (user_id % 3) ELSE 'ip-' || user_id END AS ip_hash, event_id, user_id
FROM events
"""
