from dataclasses import replace
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paysieve.operators import alerts, features, kpis, panels, quality, scoring
from paysieve.params import Params

NOON = datetime(2026, 8, 9, 7, 30, tzinfo=UTC)  # 13:00 in Kolkata
SCHEMA = "transaction_id string, event_time timestamp, event_date string, amount double, status string, payer_bank string, app string, city string, payer_key string, payee_key string, ip_hash string"
P = Params()


def rows(spark, *changes):
    base = {"event_time": NOON, "amount": 100.0, "status": "SUCCESS", "payer_bank": "B1", "app": "A", "city": "C", "payer_key": "p", "payee_key": "m", "ip_hash": "ip"}
    out = []
    for i, c in enumerate(changes):
        r = base | {"transaction_id": f"T{i:04}"} | c
        out.append((r["transaction_id"], r["event_time"], r["event_time"].strftime("%Y-%m-%d"), *(r[k] for k in ("amount", "status", "payer_bank", "app", "city", "payer_key", "payee_key", "ip_hash"))))
    return spark.createDataFrame(out, SCHEMA)


def reasons(spark, *changes, p=P):
    return {r.transaction_id: r.reasons for r in scoring.fact(rows(spark, *changes), p).collect()}


def test_fence_is_unmoved_by_outliers(spark):
    usual = [{"amount": 100.0 + i % 50} for i in range(1000)]
    p = replace(P, fence_floor=0.0, exact_fence=True)
    plain = features.threshold(rows(spark, *usual), p).first()
    dirty = features.threshold(rows(spark, *usual, *({"amount": 1e6},) * 10), p).first()
    assert abs(plain.threshold - dirty.threshold) < 5 and plain.threshold < 300


def test_threshold_floor_failed_and_empty(spark):
    assert features.threshold(rows(spark, {"amount": 5.0}), P).first().threshold == 50_000
    assert features.threshold(rows(spark, {"amount": 9e5, "status": "FAILED"}), P).first().threshold == 50_000
    assert features.threshold(rows(spark, {}).limit(0), P).first().threshold == 50_000


@pytest.mark.parametrize(("n", "fires"), [(4, False), (5, True)])
def test_shared_ip(spark, n, fires):
    got = reasons(spark, *({"payer_key": f"p{i}", "payee_key": f"m{i}"} for i in range(n)))
    assert all(("shared_ip" in r) == fires for r in got.values())


@pytest.mark.parametrize(("mode", "fires"), [("zero", False), ("group", True)])
def test_null_addresses_are_no_group_unless_asked(spark, mode, fires):
    got = reasons(spark, *({"payer_key": f"p{i}", "ip_hash": None} for i in range(6)), p=replace(P, null_keys=mode))
    assert all(("shared_ip" in r) == fires for r in got.values())


@pytest.mark.parametrize(("mode", "fires"), [("zero", False), ("group", True)])
def test_rows_without_a_payer(spark, mode, fires):
    got = reasons(spark, *({"payer_key": None, "event_time": NOON + timedelta(seconds=i)} for i in range(12)), p=replace(P, null_keys=mode))
    assert ("velocity" in got["T0011"]) == fires


def test_velocity_counts_time_not_rows(spark):
    slow = reasons(spark, *({"event_time": NOON + timedelta(days=i)} for i in range(20)))
    assert not any("velocity" in r for r in slow.values())
    fast = reasons(spark, *({"event_time": NOON + timedelta(seconds=10 * i)} for i in range(12)))
    assert "velocity" not in fast["T0000"] and "velocity" in fast["T0010"] and "velocity" in fast["T0011"]


def test_window_holds_both_ends_and_ties(spark):
    p = replace(P, velocity_most=1)
    got = reasons(spark, {}, {"event_time": NOON + timedelta(seconds=300)}, {"event_time": NOON + timedelta(seconds=601)}, {"event_time": NOON + timedelta(seconds=601, milliseconds=400)}, p=p)
    assert ["velocity" in got[f"T{i:04}"] for i in range(4)] == [False, True, True, True]


def test_fanout_counts_distinct_payees(spark):
    at = lambda i: {"event_time": NOON + timedelta(minutes=i)}
    assert not any("fanout" in r for r in reasons(spark, *(at(i) for i in range(25))).values())
    wide = reasons(spark, *(at(i) | {"payee_key": f"m{i}"} for i in range(25)))
    assert "fanout" not in wide["T0014"] and "fanout" in wide["T0015"]


def test_odd_hour_is_local(spark):
    got = reasons(spark, {"event_time": datetime(2026, 8, 8, 21, 30, tzinfo=UTC)}, {}, {"event_time": datetime(2026, 8, 8, 23, 30, tzinfo=UTC)})
    assert list(got.values()) == [["odd_hour"], [], []]


def test_no_rule_alone_is_high_and_three_add_up(spark):
    assert max(w for _, w in P.weights) < P.high_from
    same = [{"event_time": NOON + timedelta(seconds=i), "payee_key": f"m{i}", "amount": 60_000.0 if i == 19 else 10.0} for i in range(20)]
    last = {r.transaction_id: r for r in scoring.fact(rows(spark, *same), P).collect()}["T0019"]
    assert (last.fraud_score, last.reasons, last.risk_band) == (80, ["high_amount", "velocity", "fanout"], "HIGH")


def test_metrics_and_panels(spark):
    fact = scoring.fact(rows(spark, {}, {"amount": 50.0, "status": "FAILED", "payer_key": "q"}, {"amount": 60_000.0, "city": None}), replace(P, fence_k=-1.0))
    day = kpis.daily(fact).first()
    assert (day.txn_count, day.total_amount, day.success_count, day.success_rate, day.avg_ticket, day.distinct_payers, day.flagged_count, day.flagged_amount) == (3, 60_100.0, 2, 0.6667, 30_050.0, 2, 1, 60_000.0)
    parts = kpis.by_dimension(fact).collect()
    assert {d: sum(r.txn_count for r in parts if r.dimension == d) for d in kpis.DIMENSIONS} == dict.fromkeys(kpis.DIMENSIONS, 3)
    assert any(r.dimension == "city" and r.dimension_value is None for r in parts)
    assert {r.missing for r in quality.reconciliation(fact, kpis.daily(fact), kpis.by_dimension(fact)).collect()} == {0}
    assert kpis.daily(rows(spark, {"status": "FAILED"}).withColumn("risk_band", F.lit("LOW"))).first().avg_ticket is None
    assert [tuple(r) for r in panels.amount_histogram(fact).collect()] == [(100.0, 1), (31622.7766, 1)]


def test_detection_precision_and_search(spark):
    burst = [{"event_time": NOON + timedelta(seconds=i), "payee_key": f"m{i}", "amount": 60_000.0} for i in range(20)]
    fact = scoring.fact(rows(spark, *burst), P)
    labels = spark.createDataFrame([("T0019", "burst"), ("T0000", "burst"), ("gone", "burst")], "transaction_id string, injected_type string")
    assert tuple(quality.detection(fact.union(fact), labels).first()) == ("burst", 3, 1, 1, 1, 0.5)
    found = scoring.alerts(fact)
    assert found.count() == 5
    assert tuple(quality.precision(fact, labels).first()) == (1, found.count())
    assert alerts.search(found, rules=["fanout"], bank="B1", text=" t0019 ").count() == 1 and alerts.search(found, bank="B2").count() == 0 and alerts.search(found).count() == found.count()
    own = alerts.breakdown(found, P).where("transaction_id = 'T0019'").agg(F.sum("weight")).first()[0]
    assert own == 50
    capped = scoring.capped(found, 2).collect()
    assert len(capped) == 2 and all(r.truncated for r in capped)
    assert [r.transaction_id for r in alerts.page(found, sort="event_time", number=1, size=3).collect()] == ["T0016", "T0015"]


def test_latest_label_file_wins(spark):
    files = spark.createDataFrame([("2026-01-02", {"a": "new", "b": "x"}), ("2026-01-01", {"a": "old"})], "generated_at string, labels map<string,string>")
    assert {tuple(r) for r in quality.labels_of(files).collect()} == {("a", "new"), ("b", "x")}


@pytest.mark.parametrize("share", [0.0001, 0.25, 0.5, 0.995, 1.0])
def test_quantiles_are_exact(spark, share):
    import math
    import random

    rng = random.Random(int(share * 1000))
    values = [rng.choice([rng.uniform(-5, 5), rng.lognormvariate(6, 3), 100.0, -1e12, 0.0]) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert features.quantiles(df, "x", {"q": share}).first().q == sorted(values)[max(1, math.ceil(share * 3001)) - 1]
    assert features.quantiles(df.limit(0), "x", {"q": share}).first().q is None


def test_a_payers_windows_reach_over_the_spans(spark):
    import random

    rng = random.Random(3)
    p = replace(P, velocity_seconds=90, fanout_seconds=200)
    at = sorted(rng.randrange(2000) for _ in range(300))
    own = rows(spark, *({"event_time": NOON + timedelta(seconds=t), "payee_key": f"m{t % 7}", "payer_key": f"p{i % 2}" if i % 10 else None} for i, t in enumerate(at)))
    own = own.withColumn("event_epoch", F.unix_seconds("event_time"))
    found = {r.transaction_id: r for r in features.payer_windows(own, p).collect()}
    assert len(found) == 300
    for i, t in enumerate(at):
        same = [j for j in range(300) if i % 10 and j % 10 and j % 2 == i % 2]
        got = found[f"T{i:04}"]
        assert got.txns_in_window == sum(t - 90 <= at[j] <= t for j in same)
        assert got.distinct_payees_in_window == len({at[j] % 7 for j in same if t - 200 <= at[j] <= t})


def many_alerts(spark, n=300):
    import random

    rng = random.Random(11)
    own = [(f"T{rng.randrange(200):03}", f"2026-08-{rng.randrange(1, 9):02}", float(rng.choice([5, 7, 9])), rng.choice([50, 60, None]), NOON + timedelta(hours=rng.randrange(4)), rng.choice(["Pune", "Paris", None]), rng.choice(["PayQ", "", "ab"]), rng.choice([["fanout"], ["velocity"]])) for _ in range(n)]
    return spark.createDataFrame(own, "transaction_id string, event_date string, amount double, fraud_score int, event_time timestamp, city string, app string, reasons array<string>").dropDuplicates(["transaction_id"])


def test_indexed_search_finds_what_a_scan_finds(spark):
    found = many_alerts(spark).cache()
    index = alerts.grams(found).cache()
    counts = alerts.gram_counts(index).cache()
    for text in ["t01", "T0", " pune", "paris payq", "une a", "zzz", "", None, "e", "199 pune", "%", "payq\\"]:
        want = sorted(r.transaction_id for r in alerts.search(found, text=text).collect())
        assert sorted(r.transaction_id for r in alerts.indexed_search(found, index, counts, text=text).collect()) == want, text
    assert alerts.indexed_search(found, index, counts, text="pune", rules=["fanout"]).count() == alerts.search(found, text="pune", rules=["fanout"]).count()


def test_search_reads_few_folders_of_a_stored_index(spark, tmp_path):
    from paysieve.plans import pipeline
    from paysieve.sources.tables import Store

    store = Store(str(tmp_path))
    fact = scoring.fact(rows(spark, *({"event_time": NOON + timedelta(seconds=i), "payee_key": f"m{i}", "amount": 60_000.0} for i in range(40))), P)
    store.table(spark, pipeline.ALERTS).replace(scoring.alerts(fact), by=("event_date",))
    pipeline.index_alerts(spark, store)
    found = pipeline.search_alerts(spark, store, text="t0039")
    assert [r.transaction_id for r in found.collect()] == ["T0039"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[-1] + plan
    assert pipeline.search_alerts(spark, store, text="nothing").count() == 0


@pytest.mark.parametrize("sort", ["fraud_score", "amount", "event_time"])
def test_pages_after_one_another_are_the_whole_order(spark, sort):
    found = many_alerts(spark).cache()
    keys = alerts.ORDERS[sort]
    want = [r.transaction_id for r in found.orderBy(*map(F.desc, keys), "transaction_id").collect()]
    got, last = [], None
    while page := alerts.page_after(found, last, sort=sort, size=37).collect():
        got += [r.transaction_id for r in page]
        last = page[-1]
    assert got == want and len(set(r.amount for r in found.collect())) < 4


def test_panels_of_one_scan_are_each_panels_own(spark):
    burst = [{"event_time": NOON + timedelta(seconds=i), "payee_key": f"m{i}", "amount": 60_000.0 if i % 3 else 0.5, "status": "FAILED" if i % 5 == 0 else "SUCCESS"} for i in range(40)]
    fact = scoring.fact(rows(spark, *burst, *({"payer_key": f"p{i}"} for i in range(9))), P).cache()
    found = panels.of_counted(panels.counted(fact, P), P)
    own = {"bands": quality.band_counts(fact), "histogram": panels.score_histogram(fact, P), "rules": panels.rule_counts(fact), "combinations": panels.combinations(fact, P), "amount_histogram": panels.amount_histogram(fact)}
    assert set(found) == set(own) == set(panels.COUNTED)
    for name, df in own.items():
        assert found[name].columns == df.columns and [tuple(r) for r in found[name].collect()] == [tuple(r) for r in df.collect()], name


def test_a_busy_payer_has_a_row_a_second(spark):
    """Half the rows are one payer's: no window has more rows than a bucket has seconds, and both counts are right."""
    import time

    n = 40_000
    hot = spark.range(n).select(F.lit("p").alias("payer_key"), (F.col("id") * 7919 % 30_000).cast("string").alias("payee_key"), F.floor(F.col("id") * 3600 / n).alias("event_epoch"), F.col("id").cast("string").alias("transaction_id"))
    most = features.moments(hot, P).groupBy("_payer", "_bucket").count().agg(F.max("count")).first()[0]
    assert most <= min(features.bucket_seconds(P) + 1, 3 * 3600)
    features.payer_windows(hot, P).count()
    began = time.monotonic()
    got = features.payer_windows(hot, P).where("event_epoch = 3599").select("txns_in_window", "distinct_payees_in_window").distinct().collect()
    assert time.monotonic() - began < 15  # a fraction of this on an idle machine; a set for each row takes minutes
    at = [i * 3600 // n for i in range(n)]
    assert [tuple(r) for r in got] == [(sum(3299 <= t for t in at), len({i * 7919 % 30_000 for i in range(n)}))]


def test_sketches_of_days_add_up(spark):
    own = rows(spark, *({"amount": float(i), "event_time": NOON + timedelta(days=i % 5), "payer_key": f"p{i % 700}"} for i in range(3000)))
    found = features.merged_quantiles(features.day_amount_sketches(own), {"a": 0.25, "b": 0.995}).first()
    assert abs(found.a - 750) <= 15 and abs(found.b - 2985) <= 15
    assert features.merged_quantiles(features.day_amount_sketches(own.limit(0)), {"a": 0.25}).first().a is None
    assert features.merged_threshold(features.day_amounts(own), replace(P, fence_floor=0.0)).first().threshold == features.threshold(own, replace(P, fence_floor=0.0, exact_fence=True)).first().threshold
    assert features.merged_threshold(features.day_amount_sketches(own.limit(0)), P).first().threshold == 50_000
    assert abs(features.merged_payers(features.payer_sketches(own, "event_date")).first().payers - 700) <= 35


def test_label_files_of_one_time_are_told_apart_by_name(spark):
    files = spark.createDataFrame([("2026", "b.json", {"x": "late"}), ("2026", "a.json", {"x": "early"}), ("2025", "c.json", {"x": "old"})], "generated_at string, file string, labels map<string,string>")
    assert [tuple(r) for r in quality.labels_of(files).collect()] == [("x", "late")]
    assert [tuple(r) for r in quality.labels_of(files.drop("file")).collect()] == [("x", "late")]


def test_amounts_of_nothing_have_a_bucket(spark):
    fact = rows(spark, *({"amount": a} for a in (0.0, 0.0, 0.00001, 0.5, 100.0))).withColumns({"risk_band": F.lit("LOW"), "fraud_score": F.lit(0), "reasons": F.array().cast("array<string>")})
    want = [(0.0, 3), (0.3162, 1), (100.0, 1)]
    assert [tuple(r) for r in panels.amount_histogram(fact).collect()] == want
    assert [tuple(r) for r in panels.of_counted(panels.counted(fact, P), P)["amount_histogram"].collect()] == want


def edge(spark, seconds, *offsets):
    """Counts of one payer's payments, which are so many seconds from a bucket's begin."""
    start = 60_000 * features.bucket_seconds(P)
    own = spark.createDataFrame([("p", f"m{payee}", start + at, str(i)) for i, (at, payee) in enumerate(offsets)], "payer_key string, payee_key string, event_epoch long, transaction_id string")
    return [r[seconds] for r in features.payer_windows(own, P).orderBy(F.col("transaction_id").cast("int")).collect()]


def test_payments_whose_window_ends_with_a_bucket(spark):
    assert edge(spark, "txns_in_window", (-P.velocity_seconds - 1, 1), (0, 2), (7, 3)) == [1, 1, 2]


def test_payees_who_leave_with_a_bucket(spark):
    # by the end of the window, and by the next payment to the same payee
    assert edge(spark, "distinct_payees_in_window", (-P.fanout_seconds - 1, 1), (0, 2), (7, 3)) == [1, 1, 2]
    assert edge(spark, "distinct_payees_in_window", (-100, 1), (0, 1), (7, 3)) == [1, 1, 2]


def test_scores_of_windows_that_end_with_a_bucket(spark):
    p = replace(P, velocity_most=1, fanout_most=1)
    start = datetime.fromtimestamp(60_000 * features.bucket_seconds(p), UTC)
    at = lambda s, payee: {"event_time": start + timedelta(seconds=s), "payee_key": payee}
    got = reasons(spark, at(-p.fanout_seconds - 1, "a"), at(-p.velocity_seconds - 1, "b"), at(0, "c"), at(9, "d"), p=p)
    assert [[r for r in got[f"T{i:04}"] if r in ("velocity", "fanout")] for i in range(4)] == [[], ["fanout"], ["fanout"], ["velocity", "fanout"]]
