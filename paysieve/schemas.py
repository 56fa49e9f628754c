"""Explicit schemas of all layers; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed names, in order: the payload of a raw line, all read as text.
PAYLOAD_FIELDS = (
    "transaction_id", "event_time", "payer_vpa", "payee_vpa", "amount", "currency", "status", "txn_type", "payer_bank", "payee_bank",
    "app", "device_id", "ip_address", "city", "state", "payer_phone", "merchant_category", "latency_ms",
)
CORRUPT = "_corrupt_record"


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(), "timestamp": T.TimestampType(), "date": T.DateType(), "boolean": T.BooleanType(),
    "decimal(38;2)": T.DecimalType(38, 2), "binary": T.BinaryType(), "array<string>": T.ArrayType(T.StringType()), "map<string;string>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """Of "name type, name type"; needs no session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in spec.split(","))])


_PAYLOAD = ", ".join(f"{f} string" for f in PAYLOAD_FIELDS)
PAYLOAD = _struct(f"{_PAYLOAD}, {CORRUPT} string")
LANDING = _struct("raw_payload string, source_file string, landed_at timestamp, landing_run_id string")
BRONZE = _struct(f"{_PAYLOAD}, is_parseable boolean, raw_payload string, source_file string, landed_at timestamp, landing_run_id string, ingested_at timestamp, ingest_run_id string, ingest_date date")
SILVER = _struct(
    "transaction_id string, event_time timestamp, event_date string, amount double, currency string, status string, txn_type string, payer_bank string, payee_bank string, "
    "app string, city string, state string, merchant_category string, latency_ms int, payer_vpa_masked string, payee_vpa_masked string, payer_phone_masked string, "
    "payer_key string, payee_key string, device_hash string, ip_hash string, ingested_at timestamp, cleansed_at timestamp, source_file string"
)
QUARANTINE = _struct("transaction_id string, event_time string, amount string, status string, currency string, reject_reason string, rejected_at timestamp, raw_payload string, source_file string, ingested_at timestamp")
#: Ids of the cleansed rows, by hash bucket, with the micro-batch that brought them.
IDS = _struct("id_bucket int, transaction_id string, batch_id bigint")
#: Rows that the watermark kept out of the cleansed layer.
LATE = _struct(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER.fields) + ", late_batch bigint")
ALERTS = _struct("transaction_id string, event_time timestamp, event_date string, amount double, status string, payer_vpa_masked string, payee_vpa_masked string, payer_bank string, app string, city string, ip_hash string, fraud_score int, reasons array<string>")
KPI_DAILY = _struct("event_date string, txn_count bigint, total_amount double, success_count bigint, success_rate double, avg_ticket double, distinct_payers bigint, flagged_count bigint, flagged_amount double")
KPI_DIMENSION = _struct("dimension string, dimension_value string, txn_count bigint, total_amount double, avg_ticket double, success_rate double, flagged_count bigint")
#: What gold keeps to go on from: by day the sums of dimensions and the amounts (counted, or as a sketch), by
#: hash bucket the payers and days of each address, and the amount threshold after each batch.
DIMENSION_DAYS = _struct("event_date string, dimension string, dimension_value string, txn_count bigint, success_count bigint, success_amount decimal(38;2), flagged_count bigint")
DAY_AMOUNTS = _struct("event_date string, value double, n bigint")
DAY_SKETCHES = _struct("event_date string, amounts binary")
LINKS = _struct("ip_bucket int, ip_hash string, payer_key string, event_date string, batch_id bigint")
LIMITS = _struct("batch_id bigint, threshold double")
LABEL_FILE = _struct("generated_at string, labels map<string;string>")
