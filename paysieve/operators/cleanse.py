"""Standardising, rejecting and splitting of structured rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.functions import columns as C
from paysieve.params import Params


def reject_reason(p: Params) -> Column:
    """The first of ten failures, or null.  Comparisons with null fail nothing, unless ``strict_enums`` says so."""
    def outside(name: str, valid: tuple[str, ...]) -> Column:
        own = ~F.col(name).isin(*(v.upper() for v in valid))
        return F.coalesce(own, F.lit(True)) if p.strict_enums else own

    # fixed values: the reasons, in order of precedence
    failures = (
        ("malformed_json", ~F.col("is_parseable")),
        ("missing_transaction_id", F.isnull("transaction_id")),
        ("missing_event_time", F.isnull("event_time_raw")),
        ("unparseable_event_time", F.isnull("event_time")),
        ("missing_amount", F.isnull("amount_raw")),
        ("unparseable_amount", F.isnull("amount")),
        ("non_positive_amount", F.col("amount") <= 0),
        ("amount_exceeds_limit", F.col("amount") > p.max_amount),
        ("invalid_status", outside("status", p.statuses)),
        ("invalid_currency", outside("currency", p.currencies)),
    )
    return F.coalesce(*(F.when(failed, F.lit(name)) for name, failed in failures))


#: The columns that hide an identifier; each takes hashing or cutting that no rule of rejection looks at.
HIDDEN = ("payer_vpa_masked", "payee_vpa_masked", "payer_phone_masked", "payer_key", "payee_key", "device_hash", "ip_hash")


def standardised(rows: DataFrame, p: Params, salt: str, *, hidden: bool = True) -> DataFrame:
    """Trimmed, case-folded, typed and masked columns and ``reject_reason``; no row is dropped.

    Without ``hidden`` the masks and keys are left out, for rows that are only to be rejected.
    """
    raw = {f: F.col(f) for f in schemas.PAYLOAD_FIELDS}
    new = {
        "transaction_id": C.present(raw["transaction_id"]),
        "event_time_raw": C.present(raw["event_time"]),
        "event_time": C.instant(C.present(raw["event_time"]), p.tz),
        "amount_raw": C.present(raw["amount"]),
        "amount": C.number(C.present(raw["amount"])),
        **{f: C.folded(raw[f]) for f in ("status", "currency", "txn_type", "payer_bank", "payee_bank", "state")},
        **{f: C.present(raw[f]) for f in ("app", "merchant_category")},
        "city": C.titled(raw["city"]),
        "latency_ms": C.whole(C.present(raw["latency_ms"])),
        "payer_vpa_masked": C.masked_address(C.present(raw["payer_vpa"])),
        "payee_vpa_masked": C.masked_address(C.present(raw["payee_vpa"])),
        "payer_phone_masked": C.masked_phone(C.present(raw["payer_phone"])),
        "payer_key": C.keyed(C.present(raw["payer_vpa"]), salt),
        "payee_key": C.keyed(C.present(raw["payee_vpa"]), salt),
        "device_hash": C.keyed(C.present(raw["device_id"]), salt),
        "ip_hash": C.keyed(C.present(raw["ip_address"]), salt),
    }
    whole = rows.withColumns({name: c for name, c in new.items() if hidden or name not in HIDDEN})
    # a filter on the reason passes projections, which would then parse the line once for each use, but no generator; the
    # reason is outside, as the JVM compiles no generated method of over 8000 bytes
    return whole.select(F.inline(F.array(F.struct(*(F.col(c) for c in whole.columns))))).withColumn("reject_reason", reject_reason(p))


def accepted(rows: DataFrame, p: Params) -> DataFrame:
    """Rows without a reason, in the cleansed layer's columns; copies are still in."""
    own = rows.where(F.isnull("reject_reason")).withColumns({"event_date": C.local_date(F.col("event_time"), p.tz), "cleansed_at": F.current_timestamp()})
    return own.select(*schemas.SILVER.names)


def rejected(rows: DataFrame) -> DataFrame:
    """Rows with a reason: trimmed values, and the line as it came."""
    own = rows.where(F.isnotnull("reject_reason")).withColumns({"event_time": F.col("event_time_raw"), "amount": F.col("amount_raw"), "rejected_at": F.current_timestamp()})
    return own.select(*schemas.QUARANTINE.names)


def one_per_id(rows: DataFrame) -> DataFrame:
    """The batch form of the streaming dedupe: one row of each transaction id."""
    return rows.dropDuplicates(["transaction_id"])
