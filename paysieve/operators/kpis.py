"""Business metrics by day and by dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysieve.functions import columns as C
from paysieve.params import LOW

DIMENSIONS = ("payer_bank", "app", "city")


def successful() -> Column:
    return F.col("status") == "SUCCESS"


def total(amount: str, where: Column) -> Column:
    """Exact sum of amounts where the condition holds, 0 without any."""
    return C.rounded(F.coalesce(F.sum(F.when(where, C.money(F.col(amount)))), F.lit(0)), 2)


def mean(amount: str, where: Column) -> Column:
    """Mean of amounts where the condition holds, null without any."""
    return C.ratio(F.sum(F.when(where, C.money(F.col(amount)))), F.count_if(where), 2)


def flagged() -> Column:
    return F.col("risk_band") != LOW


def daily(fact: DataFrame) -> DataFrame:
    """A row a day.  Volume is of successful payments only: the others move no money."""
    own = fact.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("txn_count"),
        total("amount", successful()).alias("total_amount"),
        F.count_if(successful()).alias("success_count"),
        C.ratio(F.count_if(successful()), F.count(F.lit(1)), 4).alias("success_rate"),
        mean("amount", successful()).alias("avg_ticket"),
        F.count_distinct("payer_key").alias("distinct_payers"),
        F.count_if(flagged()).alias("flagged_count"),
        total("amount", flagged()).alias("flagged_amount"),
    )
    return own.orderBy("event_date")


def _by_sets(fact: DataFrame, *first: str) -> DataFrame:
    """By ``first`` and each dimension: counts and exact sums, which add up over groups of rows."""
    names = [F.col(d) for d in DIMENSIONS]
    own = fact.groupingSets([[*map(F.col, first), c] for c in names], *map(F.col, first), *names).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(successful()).alias("success_count"),
        F.sum(F.when(successful(), C.money(F.col("amount")))).cast("decimal(38,2)").alias("success_amount"),
        F.count_if(flagged()).alias("flagged_count"),
    )
    # the set's number has a 0 bit for the column that it groups by
    at = {0b011: DIMENSIONS[0], 0b101: DIMENSIONS[1], 0b110: DIMENSIONS[2]}
    pick = lambda of: F.coalesce(*(F.when(F.col("_set") == bits, of(d)) for bits, d in at.items()))
    return own.select(*first, pick(F.lit).alias("dimension"), pick(F.col).alias("dimension_value"), "txn_count", "success_count", "success_amount", "flagged_count")


def _of_sums(own: DataFrame) -> DataFrame:
    amount, good = F.col("success_amount"), F.col("success_count")
    named = own.select(
        "dimension",
        "dimension_value",
        "txn_count",
        C.rounded(F.coalesce(amount, F.lit(0)), 2).alias("total_amount"),
        C.ratio(amount, good, 2).alias("avg_ticket"),
        C.ratio(good, F.col("txn_count"), 4).alias("success_rate"),
        "flagged_count",
    )
    return named.orderBy("dimension", F.desc("total_amount"), "dimension_value")


def by_dimension(fact: DataFrame) -> DataFrame:
    """A row a dimension and value, by grouping sets: one scan and one shuffle for all dimensions."""
    return _of_sums(_by_sets(fact))


def dimension_days(fact: DataFrame) -> DataFrame:
    """What ``by_dimension`` is made of, by day."""
    return _by_sets(fact, "event_date")


def of_dimension_days(days: DataFrame) -> DataFrame:
    """``by_dimension`` from its days."""
    sums = (F.sum(c).alias(c) for c in ("txn_count", "success_count", "flagged_count"))
    return _of_sums(days.groupBy("dimension", "dimension_value").agg(*sums, F.sum("success_amount").cast("decimal(38,2)").alias("success_amount")))


def with_flagged_share(days: DataFrame) -> DataFrame:
    return days.withColumn("flagged_share", C.rounded(F.col("flagged_count") / F.greatest("txn_count", F.lit(1)), 4))


def top_banks(dimensions: DataFrame, most: int = 10) -> DataFrame:
    return dimensions.where("dimension = 'payer_bank'").orderBy(F.desc("total_amount"), "dimension_value").limit(most)
