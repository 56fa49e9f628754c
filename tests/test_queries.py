"""Every query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from paysieve.plans.oracle import ORACLE_SQL
from paysieve.plans.queries import QUERIES
from paysieve.sources import tables
from tests.compare import same_rows

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, name):
    same_rows(QUERIES[name](spark, DATA), ORACLE_SQL[name], DATA)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_scores_where_summer_time_begins_and_ends(spark, tmp_path, zone):
    # a payment every 11 minutes of days that have an hour twice or leave one out in some zone
    days = "unnest([TIMESTAMP '2024-03-10', TIMESTAMP '2024-03-31', TIMESTAMP '2024-10-27', TIMESTAMP '2024-11-03']) d(day), range(131) r(i)"
    events = f"SELECT row_number() OVER () AS event_id, day + to_minutes(11 * i) AS ts, i % 7 AS user_id, 'view' AS event_type, (i % 90)::DOUBLE AS value, '{{\"k\": ' || (i % 13) || '}}' AS props FROM {days}"
    duckdb.sql(f"COPY ({events}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in ("scored", "velocity", "fanout", "parse_lines", "kpi_daily", "label_scan"):
            same_rows(QUERIES[name](spark, str(tmp_path)), ORACLE_SQL[name], tmp_path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_scores_of_times_stored_as_instants(spark, tmp_path, zone):
    # the same times without a zone, for the SQL, and as instants
    days = "unnest([TIMESTAMP '2024-01-05', TIMESTAMP '2024-03-10', TIMESTAMP '2024-11-03']) d(day), range(131) r(i)"
    events = f"SELECT row_number() OVER () AS event_id, day + to_minutes(11 * i) AS ts, i % 7 AS user_id, 'view' AS event_type, (i % 90)::DOUBLE AS value, '{{\"k\": ' || (i % 13) || '}}' AS props FROM {days}"
    plain, instants = tmp_path / "plain", tmp_path / "instants"
    plain.mkdir()
    duckdb.sql(f"COPY ({events}) TO '{plain}/events.parquet' (FORMAT parquet)")
    spark.read.parquet(f"{plain}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{instants}/events.parquet")  # the session is in UTC
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert dict(spark.read.parquet(f"{instants}/events.parquet").dtypes)["ts"] == "timestamp"
        for name in ("scored", "velocity", "fanout", "parse_lines", "kpi_daily", "label_scan"):
            same_rows(QUERIES[name](spark, str(instants)), ORACLE_SQL[name], plain)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")
def test_an_export_scores_once(spark, monkeypatch):
    """Only the fact is made of events; metrics are made of the stored fact."""
    read, own = {}, tables.Table.replace

    def replace(self, df, **options):
        read[self.address.rpartition("/")[2]] = df.inputFiles()
        own(self, df, **options)

    monkeypatch.setattr(tables.Table, "replace", replace)
    QUERIES["panels_exported"](spark, DATA)
    assert [name for name, files in read.items() if any("events.parquet" in f for f in files)] == ["fact"] and len(read) == 3
