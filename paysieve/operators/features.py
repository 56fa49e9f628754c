"""Behavioural features over event time, and the robust amount threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.functions import columns as C
from paysieve.params import Params


#: Windows are worked on in buckets of time of so many times the longer window.
_BUCKET = 8


def bucket_seconds(p: Params) -> int:
    """Seconds of a bucket: no window of the sweep has more rows than this and one, whatever a payer does."""
    return _BUCKET * (max(p.velocity_seconds, p.fanout_seconds) + 1)


def moments(keys: DataFrame, p: Params) -> DataFrame:
    """A row for each payer and second at which a count changes: _payer, _bucket, _at, payments, and what both counts change by.

    A payment counts for its payer from its second on and no more after the window.  For distinct payees it counts as long as it
    is the latest of its payer to its payee; the next one to the same payee takes over.  So both counts are the
    sum of changes up to a second.  A payment that counts across the end of a bucket is counted anew at the start of the next, so that
    buckets are independent of one another.
    """
    size = bucket_seconds(p)
    at = F.col("event_epoch")
    bucket = F.floor(at / size)
    seconds = keys.where(F.isnotnull(at)).groupBy("payer_key", "payee_key", at).agg(F.count(F.lit(1)).alias("n"))
    # a payee's first seconds in a bucket may take over from the bucket before
    early = F.isnotnull("payee_key") & (at - bucket * size <= p.fanout_seconds)
    dealt = seconds.withColumn("_bucket", F.explode(F.when(early, F.array(bucket, bucket - 1)).otherwise(F.array(bucket))))
    after = F.lead(at).over(Window.partitionBy("payer_key", "payee_key", "_bucket").orderBy("event_epoch"))
    own = dealt.withColumn("_next", after).where(F.col("_bucket") == bucket)
    n, one, none = F.col("n"), F.isnotnull("payee_key").cast("long"), F.lit(0).cast("long")
    # what ends at this very second ends in the next bucket, so it is counted anew there, too
    start = (F.col("_bucket") + 1) * size
    paid = at + (p.velocity_seconds + 1)
    met = F.least(at + (p.fanout_seconds + 1), F.col("_next"))
    change = lambda when, here, v, f: F.struct(when.cast("long").alias("_at"), here.alias("payments"), v.alias("dv"), f.alias("df"))
    changes = F.array_compact(
        F.array(
            change(at, n, n, one),
            change(paid, none, -n, none),
            F.when(one > 0, change(met, none, none, -one)),
            F.when(paid >= start, change(start, none, n, none)),
            F.when((one > 0) & (met >= start), change(start, none, none, one)),
        )
    )
    events = own.select(F.col("payer_key").alias("_payer"), F.inline(changes)).withColumn("_bucket", F.floor(F.col("_at") / size))
    return events.groupBy("_payer", "_bucket", "_at").agg(*(F.sum(c).alias(c) for c in ("payments", "dv", "df")))


def payer_counts(keys: DataFrame, p: Params) -> DataFrame:
    """_payer, _at, txns_in_window, distinct_payees_in_window: for each payer and second with a payment; a null second meets null seconds only."""
    upto = Window.partitionBy("_payer", "_bucket").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    swept = moments(keys, p).withColumns({"txns_in_window": F.sum("dv").over(upto), "distinct_payees_in_window": F.sum("df").over(upto).cast("int")})
    timed = swept.where("payments > 0").select("_payer", "_at", "txns_in_window", "distinct_payees_in_window")
    untimed = keys.where(F.isnull("event_epoch")).groupBy(F.col("payer_key").alias("_payer")).agg(F.count(F.lit(1)).alias("txns_in_window"), F.count_distinct("payee_key").cast("int").alias("distinct_payees_in_window"))
    return timed.unionByName(untimed.withColumn("_at", F.lit(None).cast("long")))


def payer_windows(rows: DataFrame, p: Params) -> DataFrame:
    """``txns_in_window`` and ``distinct_payees_in_window``, over trailing whole seconds, both ends included.

    A sweep over changes (``moments``) instead of a frame for each row: payments are counted by payer and second before any
    window, so a busy payer's window has a row a second at most, and no row carries a set.  Counts come back by payer and second.
    """
    keys = rows.select("payer_key", "payee_key", F.col("event_epoch").cast("long").alias("event_epoch"))
    grouped = p.null_keys == "group"
    counts = payer_counts(keys if grouped else keys.where(F.isnotnull("payer_key")), p)
    payer = rows["payer_key"].eqNullSafe(counts["_payer"]) if grouped else rows["payer_key"] == counts["_payer"]
    joined = rows.join(counts, payer & rows["event_epoch"].eqNullSafe(counts["_at"]), "left")
    zero = {"txns_in_window": F.lit(0).cast("long"), "distinct_payees_in_window": F.lit(0)}
    return joined.select(*(rows[c] for c in rows.columns), *(F.coalesce(c, z).alias(c) for c, z in zero.items()))


def payers_on_ip(rows: DataFrame, p: Params, links: DataFrame | None = None) -> DataFrame:
    """``payers_on_ip``: distinct payers of each address over all rows, or over ``links`` of addresses and payers.

    Counted in two phases and joined back, so that no row carries a set and a busy address is
    not gathered in one task.
    """
    counts = (rows if links is None else links).groupBy("ip_hash").agg(F.count_distinct("payer_key").alias("payers_on_ip"))
    if p.null_keys == "group":
        same = rows["ip_hash"].eqNullSafe(F.col("_ip"))
        return rows.join(counts.withColumnRenamed("ip_hash", "_ip"), same, "left").drop("_ip")
    joined = rows.join(counts.where(F.isnotnull("ip_hash")), "ip_hash", "left")
    return joined.withColumn("payers_on_ip", F.coalesce("payers_on_ip", F.lit(0)))


def with_features(rows: DataFrame, p: Params, links: DataFrame | None = None) -> DataFrame:
    """All features, and the epoch second and local hour of the event; payers behind addresses are those of ``links``, if given."""
    timed = rows.withColumns({"event_epoch": F.unix_seconds("event_time"), "event_hour": C.local_hour(F.col("event_time"), p.tz)})
    return payers_on_ip(payer_windows(timed, p), p, links)


def quantiles(rows: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row: for each name the least value that its share of the non-null values does not exceed; null without values.

    Exact.  Values are counted first; a histogram of about a thousandth's width, whose rows do not grow with the
    input, says which bin holds each rank, and only those bins' values are looked through.
    """
    return counted_quantiles(rows.select(F.col(column).cast("double").alias("value"), F.lit(1).alias("n")), shares)


def counted_quantiles(rows: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``quantiles`` of values (``value``) that occur ``n`` times."""
    value = F.col("value")
    bin_of = (F.signum(value) * F.floor(F.log1p(F.abs(value)) * 1000)).cast("long")
    counts = rows.where("value is not null and n > 0").groupBy("value").agg(F.sum("n").alias("n")).withColumn("bin", bin_of)
    bins = counts.groupBy("bin").agg(F.sum("n").alias("n"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = bins.select("bin", F.sum("n").over(upto).alias("upto"), "n", F.sum("n").over(Window.partitionBy()).alias("all"))
    ranks = F.array(*(F.struct(F.lit(name).alias("name"), F.greatest(F.ceil(F.col("all") * share), F.lit(1)).alias("rank")) for name, share in shares.items()))
    wanted = placed.select("bin", (F.col("upto") - F.col("n")).alias("before"), "upto", F.explode(ranks).alias("r")).where("before < r.rank and r.rank <= upto").select("bin", "before", "r.name", "r.rank")
    # a row a share
    within = counts.join(F.broadcast(wanted), "bin").withColumn("reached", F.col("before") + F.sum("n").over(Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    found = within.where("reached >= rank")
    return found.agg(*(F.min(F.when(F.col("name") == name, value)).alias(name) for name in shares))


def amount_quantiles(rows: DataFrame, shares: dict[str, float], p: Params) -> DataFrame:
    """``quantiles`` of the amounts, exact or in one pass of bounded state, as the parameters say."""
    if p.exact_fence:
        return quantiles(rows, "amount", shares)
    return rows.agg(*(F.percentile_approx("amount", share, p.fence_accuracy).alias(name) for name, share in shares.items()))


def threshold(rows: DataFrame, p: Params) -> DataFrame:
    """One row: q1, q3, fence and threshold of successful amounts; the floor where there are none.

    Quartiles stay put when a few per cent of the amounts are extreme, so the fence does too.
    """
    return fence(amount_quantiles(rows.where(F.col("status") == "SUCCESS"), {"q1": 0.25, "q3": 0.75}, p), p)


def fence(found: DataFrame, p: Params) -> DataFrame:
    """Of q1 and q3: q1, q3, fence and threshold."""
    fenced = found.withColumn("fence", F.col("q3") + p.fence_k * (F.col("q3") - F.col("q1")))
    return fenced.withColumn("threshold", F.greatest("fence", F.lit(p.fence_floor)))


def day_amounts(rows: DataFrame) -> DataFrame:
    """event_date, value and n: how often each amount of a successful payment occurs in a day.  Days add up exactly."""
    good = rows.where(F.col("status") == "SUCCESS")
    return good.groupBy("event_date", F.col("amount").cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def day_amount_sketches(rows: DataFrame, k: int = 2000) -> DataFrame:
    """event_date and amounts: a mergeable sketch (KLL) of a day's successful amounts; ranks are within about 2.3 / k ** 0.9 of their own."""
    good = rows.where((F.col("status") == "SUCCESS") & F.isnotnull("amount"))
    return good.groupBy("event_date").agg(F.kll_sketch_agg_double(F.col("amount").cast("double"), k).alias("amounts"))


def merged_quantiles(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """One row: the quantiles of all days' sketches together; null where there are none."""
    whole = sketches.agg(F.kll_merge_agg_double("amounts").alias("all"), F.count(F.lit(1)).alias("days"))
    return whole.select(*(F.when(F.col("days") > 0, F.kll_sketch_get_quantile_double("all", F.lit(share))).alias(name) for name, share in shares.items()))


def merged_threshold(parts: DataFrame, p: Params) -> DataFrame:
    """``threshold`` of days' counted amounts (``day_amounts``) or of their sketches (``day_amount_sketches``)."""
    shares = {"q1": 0.25, "q3": 0.75}
    return fence(counted_quantiles(parts, shares) if "n" in parts.columns else merged_quantiles(parts, shares), p)


def payer_sketches(rows: DataFrame, *by: str, lg_k: int = 12) -> DataFrame:
    """The columns ``by`` and payers: a mergeable sketch (HLL) of each group's distinct payers; relative errors of about 1.04 / 2 ** (lg_k / 2)."""
    return rows.where(F.isnotnull("payer_key")).groupBy(*by).agg(F.hll_sketch_agg("payer_key", lg_k).alias("payers"))


def merged_payers(sketches: DataFrame, *by: str) -> DataFrame:
    """The columns ``by`` and payers: the distinct payers that the sketches together estimate."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("payers")).alias("payers"))
