import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.operators import cleanse, ingest, panels, quality
from paysieve.params import Params
from paysieve.plans import queries

GOOD = {"transaction_id": "P-77", "event_time": "2025-03-02T05:06:07Z", "payer_vpa": "asha.k@bankx", "amount": 310.25, "status": "pending", "currency": "inr", "payer_phone": "7012345678", "ip_address": "172.16.9.40", "device_id": "DEV-31"}


def run(spark, *lines, p=Params()):
    rows = spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "raw_payload string")
    rows = ingest.parsed(rows).withColumns({"source_file": F.lit("f"), "ingested_at": F.current_timestamp()})
    return cleanse.standardised(rows, p, "salt")


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None), ({"transaction_id": None}, "missing_transaction_id"), ({"transaction_id": "\t "}, None), ({"transaction_id": "   "}, "missing_transaction_id"), ({"event_time": None}, "missing_event_time"), ({"event_time": "soon"}, "unparseable_event_time"),
        ({"amount": None}, "missing_amount"), ({"amount": "ten"}, "unparseable_amount"), ({"amount": 0.0}, "non_positive_amount"), ({"amount": -0.01}, "non_positive_amount"), ({"amount": 500000.01}, "amount_exceeds_limit"),
        ({"amount": "NaN"}, "amount_exceeds_limit"), ({"amount": "Infinity"}, "amount_exceeds_limit"), ({"status": "lost"}, "invalid_status"), ({"currency": "EUR"}, "invalid_currency"), ({"status": None}, None),
        ({"amount": 500000}, None), ({"transaction_id": None, "amount": -3}, "missing_transaction_id"), ({"status": "lost", "currency": "EUR"}, "invalid_status"),
    ],
)
def test_reject_reason(spark, change, reason):
    assert run(spark, GOOD | change).first().reject_reason == reason


def test_strict_enums_reject_nulls(spark):
    assert run(spark, GOOD | {"status": None}, p=replace(Params(), strict_enums=True)).first().reject_reason == "invalid_status"


@pytest.mark.parametrize(
    ("line", "reason"),
    [("", "missing_transaction_id"), ("null", "malformed_json"), ("[]", "malformed_json"), ('"x"', "malformed_json"), ('{"transaction_id": "T', "malformed_json"), ('{"transaction_id":"a"} trailing', "missing_event_time"), ('{"transaction_id":"","transaction_id":"b"}', "missing_event_time")],
)
def test_odd_lines(spark, line, reason):
    row = run(spark, line).first()
    assert (row.reject_reason, row.raw_payload) == (reason, line)


def test_every_row_goes_one_way_and_raw_identifiers_stay_behind(spark):
    rows = run(spark, GOOD, GOOD | {"amount": -8}, "{broken")
    good, bad = cleanse.accepted(rows, Params()), cleanse.rejected(rows)
    assert (good.columns, bad.columns) == (schemas.SILVER.names, schemas.QUARANTINE.names)
    assert (good.count(), bad.count()) == (1, 2)
    assert {r.matches for r in quality.disclosures(good.drop("source_file")).collect()} == {0}
    found = {r.pattern for r in quality.disclosures(bad.select("raw_payload")).collect() if r.matches}
    assert found == {"vpa", "phone", "ipv4", "device"}
    row = good.first()
    assert (row.status, row.event_date, row.payer_vpa_masked, row.payer_phone_masked) == ("PENDING", "2025-03-02", "as***@bankx", "XXXXXX5678")
    assert [r[:] for r in quality.reason_counts(bad).collect()] == [("malformed_json", 1), ("non_positive_amount", 1)]


def test_empty_input(spark):
    rows = run(spark, GOOD).limit(0)
    assert cleanse.accepted(rows, Params()).count() == cleanse.rejected(rows).count() == 0


def test_a_line_is_parsed_once_in_each_branch(spark):
    rows = run(spark, GOOD)
    good, bad = cleanse.accepted(rows, Params()), cleanse.rejected(rows)
    for df, branches in ((good, 1), (bad, 1), (good.select("transaction_id").union(bad.select("transaction_id")), 2)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") <= branches


def test_no_generated_method_is_too_long_to_be_compiled(spark, tmp_path):
    spark.range(1000).selectExpr("id as event_id", "timestamp_ntz'2024-01-01' as ts", "id as user_id", "'view' as event_type", "1.0d as value", "'{\"k\": 1}' as props").write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = queries._standardised(spark, str(tmp_path))._jdf.queryExecution().debug().codegenToSeq()
        assert found.length() >= 2
        assert max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.length())) <= 8000  # HotSpot's limit
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_funnel_counts_each_layer_once(spark, tmp_path):
    spark.range(9).selectExpr("id % 2 = 0 as is_parseable", "if(id < 4, 'bad', null) as reject_reason", "id").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    own = panels.funnel(rows, rows, rows.where("reject_reason is not null"), rows.where("id > 4"), rows.where("id > 5"))
    assert own._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 5
    assert [tuple(r) for r in own.collect()] == [(0, "landing", None, 9), (1, "bronze", None, 9), (2, "unparseable", None, 4), (3, "quarantined", None, 4), (3, "quarantined", "bad", 4), (4, "silver", None, 4), (5, "deduplicated", None, 1), (6, "gold", None, 3)]
    empty = panels.funnel(*[rows.limit(0)] * 5)
    assert [r.rows for r in empty.collect()] == [0] * 7


def test_rejection_needs_no_masks_and_no_keys(spark):
    rows = spark.createDataFrame([(json.dumps(x),) for x in (GOOD, GOOD | {"amount": -1}, GOOD | {"status": "x"})], "raw_payload string")
    rows = ingest.parsed(rows).withColumns({"source_file": F.lit("f"), "ingested_at": F.current_timestamp()})
    bare, whole = (cleanse.rejected(cleanse.standardised(rows, Params(), "salt", hidden=h)).drop("rejected_at", "ingested_at") for h in (False, True))
    assert sorted(map(tuple, bare.collect())) == sorted(map(tuple, whole.collect())) and bare.count() == 2
    assert "sha2(" not in bare._jdf.queryExecution().optimizedPlan().toString().lower()
