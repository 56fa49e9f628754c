"""Search, paging and explanation of alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from paysieve.params import Params

#: Fields that a search looks into.
SEARCHED = ("transaction_id", "payer_vpa_masked", "payee_vpa_masked", "city", "app")


def searched_text(alerts: DataFrame) -> Column:
    """What a search looks into, in lower case."""
    fields = [F.coalesce(F.col(c), F.lit("")) for c in SEARCHED if c in alerts.columns]
    return F.lower(F.concat_ws(" ", *fields))


def search(alerts: DataFrame, *, rules: list[str] | None = None, bank: str | None = None, text: str | None = None) -> DataFrame:
    """Alerts with any of ``rules``, of ``bank``, and with ``text`` in one of the searched fields; what is not given filters nothing."""
    out = alerts
    if rules:
        out = out.where(F.arrays_overlap("reasons", F.array(*map(F.lit, rules))))
    if bank:
        out = out.where(F.col("payer_bank") == bank)
    if text and text.strip():
        out = out.where(searched_text(alerts).contains(text.strip().lower()))
    return out


#: Letters of a gram, and how many of a text's rarest grams a search looks up.
GRAM, LOOKED_UP = 3, 3


def grams(alerts: DataFrame) -> DataFrame:
    """The search index: gram, event_date and transaction_id for each distinct run of three letters of an alert's searched text.

    Written by gram, a search reads few row groups of it.
    """
    own = alerts.select("event_date", "transaction_id", searched_text(alerts).alias("_text")).where(F.length("_text") >= GRAM)
    runs = F.transform(F.sequence(F.lit(1), F.length("_text") - (GRAM - 1)), lambda i: F.substring("_text", i, F.lit(GRAM)))
    return own.select(F.explode(F.array_distinct(runs)).alias("gram"), "event_date", "transaction_id")


def gram_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("gram").agg(F.count(F.lit(1)).alias("alerts"))


def indexed_search(alerts: DataFrame, index: DataFrame, counts: DataFrame, *, rules: list[str] | None = None, bank: str | None = None, text: str | None = None) -> DataFrame:
    """What ``search`` finds, by the index: the alerts that have the text's rarest grams are looked up by day and id, then confirmed.

    A text that is shorter than a gram is looked for in all alerts.
    """
    wanted = text.strip().lower() if text else ""
    if len(wanted) < GRAM:
        return search(alerts, rules=rules, bank=bank, text=text)
    own = sorted({wanted[i : i + GRAM] for i in range(len(wanted) - GRAM + 1)})
    known = {r.gram: r.alerts for r in counts.where(F.col("gram").isin(own)).collect()}  # a row a gram of the text
    rarest = sorted(own, key=lambda g: (known.get(g, 0), g))[:LOOKED_UP]
    hits = index.where(F.col("gram").isin(rarest)).distinct().groupBy("event_date", "transaction_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(rarest))
    found = alerts.join(hits.drop("_n"), ["event_date", "transaction_id"], "left_semi")
    return search(found, rules=rules, bank=bank, text=text)


#: The keys of the three orders, the latest or largest first; the id breaks ties.
ORDERS = {"fraud_score": ("fraud_score", "amount"), "amount": ("amount",), "event_time": ("event_time",)}


def page(alerts: DataFrame, *, sort: str = "fraud_score", number: int = 0, size: int = 40) -> DataFrame:
    """A page by its number; ``page_after`` is quicker from page to page."""
    return alerts.orderBy(*map(F.desc, ORDERS[sort]), "transaction_id").offset(number * size).limit(size)


def page_after(alerts: DataFrame, last: Row | None = None, *, sort: str = "fraud_score", size: int = 40) -> DataFrame:
    """The page after the row ``last``, the first one without: rows before it are filtered out, not sorted and skipped.

    New alerts between two calls do not move rows to another page.  Null keys are last, as they are smallest.
    """
    keys = ORDERS[sort]
    own = alerts
    if last is not None:
        schema = {f.name: f.dataType for f in alerts.schema.fields}
        here, there = F.struct(*keys), F.struct(*(F.lit(last[k]).cast(schema[k]).alias(k) for k in keys))
        own = alerts.where((here < there) | (here == there) & (F.col("transaction_id") > last["transaction_id"]))
    return own.orderBy(*map(F.desc, keys), "transaction_id").limit(size)


def breakdown(alerts: DataFrame, p: Params) -> DataFrame:
    """transaction_id, reason and weight: what each alert's score is made of."""
    weights = F.create_map(*(F.lit(x) for pair in p.weights for x in pair))
    return alerts.select("transaction_id", F.explode("reasons").alias("reason")).withColumn("weight", weights[F.col("reason")])


def facets(alerts: DataFrame) -> DataFrame:
    """Alerts by rule."""
    return alerts.select(F.explode("reasons").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("alerts")).orderBy("rule")


def banks(alerts: DataFrame) -> DataFrame:
    return alerts.select("payer_bank").distinct().orderBy("payer_bank")
