"""Rules, score, reasons and risk bands."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.operators import features
from paysieve.params import FANOUT, HIGH, HIGH_AMOUNT, LOW, MEDIUM, ODD_HOUR, SHARED_IP, VELOCITY, Params


def rules(p: Params, limit: Column) -> dict[str, Column]:
    """Each rule's condition, in the order of the weights."""
    hour = F.col("event_hour")
    own = {
        HIGH_AMOUNT: F.col("amount") > limit,
        SHARED_IP: F.col("payers_on_ip") >= p.ip_payers,
        VELOCITY: F.col("txns_in_window") > p.velocity_most,
        FANOUT: F.col("distinct_payees_in_window") > p.fanout_most,
        ODD_HOUR: hour.between(p.odd_from, p.odd_to - 1),
    }
    return {name: own[name] for name, _ in p.weights}


def scored(rows: DataFrame, p: Params, limit: Column) -> DataFrame:
    """``reasons`` (rules that fire, in order, never null), ``fraud_score`` and ``risk_band``."""
    fired = rules(p, limit)
    marked = rows.withColumn("reasons", F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in fired.items()))))
    points = reduce(add, (F.array_contains("reasons", n).cast("int") * w for n, w in p.weights))
    out = marked.withColumn("fraud_score", points.cast("int"))
    score = F.col("fraud_score")
    return out.withColumn("risk_band", F.when(score < p.medium_from, LOW).when(score < p.high_from, MEDIUM).otherwise(HIGH))


def fact(rows: DataFrame, p: Params, limit: Column | None = None) -> DataFrame:
    """Features and scores of cleansed rows.  ``limit`` defaults to a scalar subquery over the same rows."""
    limit = features.threshold(rows, p).select("threshold").scalar() if limit is None else limit
    return scored(features.with_features(rows, p), p, limit).drop("event_epoch")


def alerts(fact_rows: DataFrame) -> DataFrame:
    """HIGH rows, the highest score and amount first; ids break ties."""
    own = fact_rows.where(F.col("risk_band") == HIGH).select(*(c for c in schemas.ALERTS.names if c in fact_rows.columns))
    return own.orderBy(F.desc("fraud_score"), F.desc("amount"), "transaction_id")


def capped(ordered: DataFrame, most: int | None) -> DataFrame:
    """The first ``most`` alerts, each with whether more were left out: one pass, which takes one alert more."""
    if most is None:
        return ordered.withColumn("truncated", F.lit(False))
    some = ordered.limit(most + 1)
    rank = F.struct(-F.col("fraud_score"), -F.col("amount"), "transaction_id")
    place = Window.partitionBy()  # over most + 1 rows
    numbered = some.withColumns({"_at": F.row_number().over(place.orderBy(rank)), "_all": F.count(F.lit(1)).over(place)})
    return numbered.where(F.col("_at") <= most).withColumn("truncated", F.col("_all") > most).drop("_at", "_all").orderBy(F.desc("fraud_score"), F.desc("amount"), "transaction_id")
