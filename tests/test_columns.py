import pytest
from pyspark.sql import functions as F

from paysieve.functions import columns as C


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_time_formats_are_one_instant_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text in ("2024-12-31T20:00:30Z", "1735675230000", "1735675230", "01-01-2025 01:30:30", "2025-01-01T01:30:30", "2024-12-31T17:00:30-03:00"):
            assert one(spark, text, lambda c: F.unix_seconds(C.instant(c, "Asia/Kolkata"))) == 1735675230, text
        at = F.timestamp_seconds(F.lit(1735675230))
        assert spark.range(1).select(C.local_hour(at, "Asia/Kolkata"), C.local_date(at, "Asia/Kolkata")).first()[:] == (1, "2025-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("text", ["later", "2025.01.01", "2025-02-30T00:00:00Z", "31-02-2025 10:00:00", "32-01-2025 00:00:00", None, "173567523"])
def test_bad_times_are_null(spark, text):
    assert one(spark, text, lambda c: C.instant(c, "Asia/Kolkata")) is None


@pytest.mark.parametrize(("text", "want"), [("17.05", 17.05), ("17.050", 17.05), ("1e3", 1000.0), ("-4", -4.0), ("4,5", None), ("", None), (None, None)])
def test_amounts(spark, text, want):
    assert one(spark, text, C.number) == want


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (C.masked_address, "meera.rao@bankx", "me***@bankx"), (C.masked_address, "q@b", "q***@b"), (C.masked_address, None, None), (C.masked_phone, "7012345678", "XXXXXX5678"), (C.masked_phone, None, None),
        (C.folded, " Pending ", "PENDING"), (C.titled, " new delhi", "New Delhi"), (C.present, " Wallet ", "Wallet"), (C.present, "   ", None), (C.whole, "-7", -7), (C.whole, "7.5x", None),
    ],
)
def test_text(spark, f, text, want):
    assert one(spark, text, f) == want


def test_keys_are_stable_and_salted(spark):
    import hashlib

    key = one(spark, "user@ok", lambda c: C.keyed(c, "s"))
    assert key == hashlib.sha256(b"suser@ok").hexdigest()[:16]
    assert one(spark, "user@ok", lambda c: C.keyed(c, "t")) != key
    assert one(spark, None, lambda c: C.keyed(c, "s")) is None


def test_scratch_folders_can_be_cleared(spark):
    from pathlib import Path

    from paysieve.sources import scratch

    folder = scratch.new_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    assert Path(folder.removeprefix("file://")).exists() and scratch.clear(spark) >= 1
    assert not Path(folder.removeprefix("file://")).exists() and scratch.clear(spark) == 0
