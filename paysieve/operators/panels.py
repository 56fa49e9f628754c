"""Aggregates behind the report and its panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.functions import columns as C
from paysieve.operators import features, kpis, quality
from paysieve.params import HIGH, Params


def headline(fact: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """One row: volume, success, payers, alerts, threshold and precision, in one pass over the fact."""
    good = kpis.successful()
    own = fact.agg(
        F.count(F.lit(1)).alias("scored"),
        kpis.total("amount", good).alias("volume"),
        F.count_if(good).alias("success_count"),
        C.rounded(F.coalesce(F.try_divide(F.count_if(good), F.count(F.lit(1))), F.lit(0)), 4).alias("success_rate"),
        F.coalesce(kpis.mean("amount", good), F.lit(0.0)).alias("avg_ticket"),
        F.count_distinct("payer_key").alias("distinct_payers"),
        F.count_if(F.col("risk_band") == HIGH).alias("alerts"),
        F.count_if(kpis.flagged()).alias("flagged"),
    )
    limit = features.threshold(fact, p).select(C.rounded(F.col("threshold"), 4)).scalar()
    hits = quality.precision(fact, labels).select("true_positives").scalar()
    return own.withColumns({"high_amount_threshold": limit, "true_positives": hits})


def funnel(landing: DataFrame, structured: DataFrame, rejects: DataFrame, cleansed: DataFrame, fact: DataFrame) -> DataFrame:
    """position, step, detail and rows: the layers in order, and beside them where rows went.

    The steps that are no layer: unparseable lines, quarantined rows, one for each reason, and the copies
    and late rows between what was good and what was kept.
    """
    none = F.lit(None).cast("string")
    entry = lambda at, step, rows, detail=none: F.struct(F.lit(at).alias("position"), F.lit(step).alias("step"), detail.alias("detail"), rows.alias("rows"))
    count = F.count(F.lit(1))
    one = lambda df, *entries: df.agg(F.array(*entries).alias("e")).select(F.inline("e"))
    reasons = rejects.groupBy("reject_reason").agg(count.alias("rows")).select(F.lit(3).alias("position"), F.lit("quarantined").alias("step"), F.col("reject_reason").alias("detail"), "rows")
    bronze = one(structured, entry(1, "bronze", count), entry(2, "unparseable", F.count_if(~F.col("is_parseable"))))
    counted = one(landing, entry(0, "landing", count)).union(bronze).union(reasons).union(one(cleansed, entry(4, "silver", count))).union(one(fact, entry(6, "gold", count)))
    # each layer is counted once; the other totals are over these few rows, and come with one of them
    whole = Window.partitionBy()
    total = lambda step: F.coalesce(F.sum(F.when(F.col("step") == step, F.col("rows"))).over(whole), F.lit(0))
    # what is neither quarantined nor kept was collapsed
    gone = F.greatest(total("bronze") - total("quarantined") - total("silver"), F.lit(0))
    summed = counted.withColumns({"_bad": total("quarantined"), "_gone": gone})
    own = F.struct("position", "step", "detail", "rows")
    more = F.array(own, entry(3, "quarantined", F.col("_bad")), entry(5, "deduplicated", F.col("_gone")))
    every = summed.select(F.inline(F.when(F.col("step") == "landing", more).otherwise(F.array(own))))
    return every.orderBy("position", F.col("detail").asc_nulls_first())


def unparseable(structured: DataFrame) -> DataFrame:
    return structured.agg(F.count_if(~F.col("is_parseable")).alias("unparseable"))


def score_histogram(fact: DataFrame, p: Params) -> DataFrame:
    bucket = (F.floor(F.col("fraud_score") / p.score_bucket) * p.score_bucket).cast("long")
    return fact.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("transactions")).orderBy("bucket")


def rule_counts(fact: DataFrame) -> DataFrame:
    """How often each rule fired, and how often within an alert."""
    each = fact.select((F.col("risk_band") == HIGH).alias("alert"), F.explode("reasons").alias("rule"))
    return each.groupBy("rule").agg(F.count(F.lit(1)).alias("fired"), F.count_if("alert").alias("in_alerts")).orderBy(F.desc("fired"), "rule")


def combinations(fact: DataFrame, p: Params) -> DataFrame:
    """The most common combinations of rules by band, with the number of rows in all others."""
    named = fact.where(F.size("reasons") > 0).select(F.array_join(F.array_sort("reasons"), " + ").alias("combination"), "risk_band")
    counts = named.groupBy("combination", "risk_band").agg(F.count(F.lit(1)).alias("transactions"))
    # the windows are over a row for each combination and band, which the rules bound
    whole = Window.partitionBy()
    shown = counts.withColumn("every", F.sum("transactions").over(whole)).orderBy(F.desc("transactions"), "combination", "risk_band").limit(p.top_combinations)
    return shown.withColumn("other", F.col("every") - F.sum("transactions").over(whole)).drop("every").orderBy(F.desc("transactions"), "combination", "risk_band")


def amount_stats(fact: DataFrame, p: Params) -> DataFrame:
    """One row: quartiles, median, 99.5th percentile, maximum, fence, floor and the threshold in use."""
    good = fact.where(kpis.successful())
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75, "percentile_995": 0.995, "max": 1.0}
    own = features.amount_quantiles(good, shares, p)
    fence = F.col("q3") + p.fence_k * (F.col("q3") - F.col("q1"))
    floor = F.lit(p.fence_floor)
    return own.withColumns({"tukey_fence": C.rounded(fence, 4), "floor": floor, "applied_threshold": C.rounded(F.greatest(fence, floor), 4)})


def _half_decades() -> Column:
    """The amount's half decade; of 0, which has no logarithm in Spark, the lowest."""
    return F.when(F.col("amount") == 0, F.lit(float("-inf"))).otherwise(F.floor(2 * F.log10("amount")))


def _amount_bucket(half: Column) -> Column:
    """The least amount of a half decade; 0 for all under a half of the last digit."""
    return C.rounded(F.pow(F.lit(10.0), half / 2), 4)


def amount_histogram(fact: DataFrame) -> DataFrame:
    """Successful amounts by half decades, and those of 0."""
    return fact.where(kpis.successful()).groupBy(_amount_bucket(_half_decades()).alias("bucket")).agg(F.count(F.lit(1)).alias("transactions")).orderBy("bucket")


COUNTED = ("bands", "histogram", "rules", "combinations", "amount_histogram")


def counted(fact: DataFrame, p: Params) -> DataFrame:
    """The counts of all panels that count rows, in one scan and one aggregate: panel, key, risk_band, transactions, in_alerts.

    A row counts in each panel that it belongs to: in that of its band, its score's bucket, each rule that fired, its combination
    of rules, and its amount's half decade.  Keys are text.  The rules and buckets bound the result.
    """
    bucket = (F.floor(F.col("fraud_score") / p.score_bucket) * p.score_bucket).cast("long")
    # whole numbers, but for amounts of 0
    half = F.when(F.col("amount") == 0, _half_decades().cast("string")).otherwise(_half_decades().cast("long").cast("string"))
    combination = F.array_join(F.array_sort("reasons"), " + ")
    entry = lambda panel, key, band=None: F.struct(F.lit(panel).alias("panel"), key.cast("string").alias("key"), (F.lit(None).cast("string") if band is None else band).alias("band"))
    own = F.array(
        entry("bands", F.col("risk_band")),
        entry("histogram", bucket),
        F.when(F.size("reasons") > 0, entry("combinations", combination, F.col("risk_band"))),
        F.when(kpis.successful(), entry("amount_histogram", half)),
    )
    every = F.concat(F.array_compact(own), F.transform("reasons", lambda r: entry("rules", r)))
    each = fact.select((F.col("risk_band") == HIGH).alias("_alert"), F.explode(every).alias("_e"))
    return each.groupBy("_e.panel", "_e.key", F.col("_e.band").alias("risk_band")).agg(F.count(F.lit(1)).alias("transactions"), F.count_if("_alert").alias("in_alerts"))


def of_counted(counts: DataFrame, p: Params) -> dict[str, DataFrame]:
    """The panels ``COUNTED`` from ``counted``, as each would be on its own."""
    of = lambda panel: counts.where(F.col("panel") == panel)
    whole = Window.partitionBy()  # over a row for each combination and band
    pairs = of("combinations").select(F.col("key").alias("combination"), "risk_band", "transactions")
    shown = pairs.withColumn("every", F.sum("transactions").over(whole)).orderBy(F.desc("transactions"), "combination", "risk_band").limit(p.top_combinations)
    return {
        "bands": of("bands").select(F.col("key").alias("risk_band"), "transactions").orderBy("risk_band"),
        "histogram": of("histogram").select(F.col("key").cast("long").alias("bucket"), "transactions").orderBy("bucket"),
        "rules": of("rules").select(F.col("key").alias("rule"), F.col("transactions").alias("fired"), "in_alerts").orderBy(F.desc("fired"), "rule"),
        "combinations": shown.withColumn("other", F.col("every") - F.sum("transactions").over(whole)).drop("every").orderBy(F.desc("transactions"), "combination", "risk_band"),
        "amount_histogram": of("amount_histogram").groupBy(_amount_bucket(F.col("key").cast("double")).alias("bucket")).agg(F.sum("transactions").alias("transactions")).orderBy("bucket"),
    }
