import json
import random
from dataclasses import replace
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.params import Params
from paysieve.plans import increments, pipeline
from paysieve.sources import tables
from paysieve.sources.tables import Store
from paysieve.streaming import stages

AT = datetime(2026, 8, 9, 12, tzinfo=UTC)


def line(i, hours=0.0, **change):
    return json.dumps({"transaction_id": f"T{i}", "event_time": (AT - timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%SZ"), "payer_vpa": f"user{i}@ok", "amount": 5, "status": "SUCCESS", "currency": "INR"} | change)


@pytest.fixture
def place(tmp_path):
    (tmp_path / "raw").mkdir()

    def put(name, *lines):
        Path(tmp_path / "raw" / name).write_text("\n".join(lines) + "\n")

    return Store(str(tmp_path / "store")), str(tmp_path / "raw"), put


def run(spark, place, which=pipeline.STAGES, **options):
    return pipeline.run_pipeline(spark, place[0], Params(), folder=place[1], salt="s", which=which, **options)


def test_runs_are_incremental_and_late_rows_are_counted(spark, place):
    store, _, put = place
    put("a.txt", line(1), line(1), line(2, amount=-1), "broken", line(3))
    first = run(spark, place)
    assert (first["landing"]["landed"], first["bronze"]["ingested"], first["silver"]["cleansed"], first["silver"]["quarantined"], first["gold"]["scored"]) == (5, 5, 2, 2, 2)
    assert run(spark, place, pipeline.STAGES[:3])["silver"]["cleansed"] == 0
    put("b.txt", line(4), line(5, hours=30))
    second = run(spark, place, pipeline.STAGES[:3])
    assert (second["silver"]["cleansed"], second["silver"]["cleansed_late"]) == (1, 1)
    assert sorted(r.transaction_id for r in store.table(spark, stages.SILVER_TABLE).rows().collect()) == ["T1", "T3", "T4"]
    assert store.table(spark, pipeline.FACT).count() == 2 and store.table(spark, ("gold", "nothing")).count() == 0
    run(spark, place, ("gold",))
    assert store.table(spark, pipeline.FACT).count() == 3
    files = {r.source_file.rpartition("/")[2] for r in store.table(spark, stages.LANDING_TABLE).rows().collect()}
    assert files == {"a.txt", "b.txt"}


def test_table_dedupe_drops_no_late_row(spark, place):
    store, _, put = place
    put("a.txt", line(1), line(1), line(3))
    run(spark, place, dedupe="table", which=pipeline.STAGES[:3])
    put("b.txt", line(1), line(4), line(5, hours=30))
    assert run(spark, place, dedupe="table", which=pipeline.STAGES[:3])["silver"]["cleansed"] == 2
    assert sorted(r.transaction_id for r in store.table(spark, stages.SILVER_TABLE).rows().collect()) == ["T1", "T3", "T4", "T5"]


def test_panels_are_files_without_nan(spark, place, tmp_path):
    store, _, put = place
    put("a.txt", line(1), line(2))
    run(spark, place)
    labels = spark.createDataFrame([("T1", "x")], "transaction_id string, injected_type string")
    names = pipeline.export_panels(spark, store, Params(), str(tmp_path / "panels"), labels=labels, environment="test")
    for name in names:
        for file in (tmp_path / "panels" / name).glob("*.json"):
            for row in file.read_text().splitlines():
                assert json.loads(row, parse_constant=lambda x: pytest.fail(x))["source"]["environment"] == "test"


def test_a_broken_table_is_an_error_not_an_empty_one(spark, place):
    store, _, _ = place
    own = store.table(spark, ("gold", "broken"))
    assert not own.there() and own.rows("a int", or_empty=True).count() == 0
    own.replace(spark.range(3))
    for file in Path(own.address).glob("*.parquet"):
        file.write_bytes(b"no parquet")
    with pytest.raises(Exception, match="CANNOT_READ|FAILED_READ|parquet"):
        own.rows().count() if own.there() else None


def test_uncapped_alerts_are_not_one_file(spark, place, tmp_path):
    tables.write_panel(spark.range(0, 100, 1, 4), str(tmp_path / "p"), one_file=False, environment="e", engine="s", store="f")
    assert len(list((tmp_path / "p").glob("*.json"))) == 4


def test_unknown_stage(spark, place):
    with pytest.raises(ValueError, match="no such stage"):
        run(spark, place, which=("landing", "moon"))


def ids(spark, store, where=stages.SILVER_TABLE):
    return sorted(r.transaction_id for r in store.table(spark, where).rows().collect())


@pytest.mark.parametrize("catalog", [None, "spark_catalog"])
@pytest.mark.parametrize("dedupe", ["watermark", "table"])
def test_both_ways_in_a_folder_and_in_a_catalog(spark, place, catalog, dedupe):
    store = Store(place[0].root, catalog=catalog, prefix=f"t_{dedupe}_")
    here = (store, *place[1:])
    place[2]("a.txt", line(1), line(1), line(2, amount=-1), line(3))
    run(spark, here, dedupe=dedupe)
    place[2]("b.txt", line(1), line(4), line(5, hours=30))
    second = run(spark, here, dedupe=dedupe)["silver"]
    late = dedupe == "watermark"
    assert (second["cleansed"], second["cleansed_late"]) == ((1, 1) if late else (2, 0))
    assert ids(spark, store) == ["T1", "T3", "T4"] + ["T5"] * (not late)
    assert store.table(spark, stages.LATE_TABLE).there() == late
    assert set(store.table(spark, stages.SILVER_TABLE).rows().columns) == set(schemas.SILVER.names)
    assert store.table(spark, pipeline.FACT).count() == len(ids(spark, store))


def test_a_store_keeps_its_way(spark, place):
    place[2]("a.txt", line(1))
    run(spark, place, pipeline.STAGES[:3], dedupe="table")
    with pytest.raises(ValueError, match="collapses copies by 'table'"):
        run(spark, place, pipeline.STAGES[:3], dedupe="watermark")
    with pytest.raises(ValueError, match="dedupe: never"):
        run(spark, place, pipeline.STAGES[:3], dedupe="never")


def test_a_batch_reads_the_folders_of_its_own_ids(spark, place):
    store = place[0]
    place[2]("a.txt", *(line(i) for i in range(200)))
    run(spark, place, pipeline.STAGES[:3], dedupe="table")
    folders = list(Path(store.root, "silver", "transaction_ids").glob("id_bucket=*"))
    assert len(folders) > 50
    one = spark.createDataFrame([("T7",)], "transaction_id string").select(stages.id_bucket(64)).first()[0]
    for folder in folders:  # a batch of one id must not look into the other folders
        if folder.name != f"id_bucket={one}":
            for file in folder.glob("*.parquet"):
                pq.write_table(pa.table({"transaction_id": [1.5]}), file)  # fails when its rows are read
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    place[2]("b.txt", line(7))
    assert run(spark, place, pipeline.STAGES[:3], dedupe="table")["silver"]["cleansed"] == 0


@pytest.mark.parametrize("fails_at", [stages.IDS_TABLE, stages.SILVER_TABLE])
def test_a_batch_that_failed_midway_is_made_good(spark, place, monkeypatch, fails_at):
    store = place[0]
    place[2]("a.txt", line(1), line(2))
    run(spark, place, pipeline.STAGES[:3], dedupe="table")
    place[2]("b.txt", line(2), line(3), line(4))
    address, append = store.table(spark, fails_at).address, tables.Table.append

    def failing(self, df, **options):
        if self.address == address:
            raise OSError("the executor's folder is gone")
        return append(self, df, **options)

    monkeypatch.setattr(tables.Table, "append", failing)
    with pytest.raises(Exception, match="folder is gone"):
        run(spark, place, pipeline.STAGES[:3], dedupe="table")
    assert ids(spark, store) == ["T1", "T2"]
    monkeypatch.undo()
    assert run(spark, place, pipeline.STAGES[:3], dedupe="table")["silver"]["cleansed"] == 2
    assert ids(spark, store) == ["T1", "T2", "T3", "T4"]
    # and once more, as if the rows had been written and the end not been noted
    for name in ("commits/1",):
        Path(store.root, "checkpoints", "silver", name).unlink()
        Path(store.root, "checkpoints", "silver", "commits", ".1.crc").unlink(missing_ok=True)
    assert run(spark, place, pipeline.STAGES[:3], dedupe="table")["silver"]["cleansed"] == 0
    assert ids(spark, store) == ["T1", "T2", "T3", "T4"]


def test_late_rows_of_a_run_that_failed_come_with_the_next(spark, place, monkeypatch):
    store = place[0]
    place[2]("a.txt", line(1), line(9, hours=1))
    run(spark, place, pipeline.STAGES[:3])
    place[2]("b.txt", line(2, hours=30), line(2, hours=30), line(1), line(3, hours=31))
    with monkeypatch.context() as m:
        m.setattr(stages, "_append_late", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            run(spark, place, pipeline.STAGES[:3])
    assert run(spark, place, pipeline.STAGES[:3])["silver"]["cleansed"] == 0
    assert ids(spark, store, stages.LATE_TABLE) == ["T2", "T3"]
    place[2]("c.txt", line(4, hours=50))
    run(spark, place, pipeline.STAGES[:3])
    assert ids(spark, store, stages.LATE_TABLE) == ["T2", "T3", "T4"] and ids(spark, store) == ["T1", "T9"]


def gold_rows(spark, store, where, schema=None):
    drop = {"scored_at", "scoring_run_id"}
    df = store.table(spark, where).rows(schema)
    df = df.select(*(F.col(c).cast("string").alias(c) for c in sorted(set(df.columns) - drop)))
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("exact", [True, False])
def test_incremental_gold_is_the_whole_runs(spark, tmp_path, exact):
    """Runs that move windows, addresses' payers and the threshold of days before."""
    rng = random.Random(5)
    p = replace(Params(), fence_floor=0.0, exact_fence=exact, velocity_most=2, fanout_most=2, ip_payers=3)

    def silver(n, days):
        rows = []
        for i in range(n):
            at = AT + timedelta(days=rng.choice(days), seconds=rng.choice([0, 30, 43_000, rng.randrange(86_400)]))
            local = (at + timedelta(minutes=330)).strftime("%Y-%m-%d")
            rows.append((f"R{rng.random()}", at, local, float(rng.choice([5, 10, 20, 900, 4000])), rng.choice(["SUCCESS", "FAILED"]), rng.choice(["p1", "p2", "p3", "p4", None]), rng.choice(["m1", "m2", "m3", "m4"]), rng.choice(["i1", "i2", None, f"i{n}"])))
        own = spark.createDataFrame(rows, "transaction_id string, event_time timestamp, event_date string, amount double, status string, payer_key string, payee_key string, ip_hash string")
        return own.select(*(F.col(c) if c in own.columns else F.lit("x" if f == "string" else None).cast(f).alias(c) for c, f in ((x.name, x.dataType.simpleString()) for x in schemas.SILVER.fields)))

    store, whole = Store(str(tmp_path / "a")), Store(str(tmp_path / "b"))
    for n, days in ((60, range(0, 10)), (20, range(8, 12)), (1, [30]), (15, range(-3, 2))):
        new = silver(n, list(days)).cache()
        for s in (store, whole):
            s.table(spark, stages.SILVER_TABLE).append(new, by=("event_date",))
        done = increments.refresh_gold(spark, store, p, "r")
        pipeline.build_gold(spark, whole, p, "r")
        if exact:
            for where, schema in ((pipeline.FACT, None), (pipeline.ALERTS, None), (pipeline.DAILY, schemas.KPI_DAILY), (pipeline.DIMENSION, None)):
                assert gold_rows(spark, store, where, schema) == gold_rows(spark, whole, where, schema), (where, n)
        else:
            assert store.table(spark, pipeline.FACT).count() == whole.table(spark, pipeline.FACT).count()
    assert done["days"] > 0 and increments.refresh_gold(spark, store, p, "r")["scored"] == 0


def test_incremental_gold_reads_few_days(spark, place):
    place[2]("a.txt", *(line(i, hours=24 * i, ip_address=f"10.0.0.{i}") for i in range(40)))
    run(spark, place, dedupe="table", incremental=True)
    place[2]("b.txt", line(100, hours=24 * 20, ip_address="10.0.1.1"))
    gold = run(spark, place, dedupe="table", incremental=True)["gold"]
    assert gold["days"] <= 4 and gold["days_read"] <= 6 and gold["scored"] <= 4
    assert place[0].table(spark, pipeline.FACT).count() == 41
    place[2]("c.txt", line(101, hours=24 * 5, ip_address="10.0.0.30"))  # another payer on an address of an earlier day
    assert run(spark, place, dedupe="table", incremental=True)["gold"]["days"] <= 8
    counts = {r.transaction_id: r.payers_on_ip for r in place[0].table(spark, pipeline.FACT).rows().collect()}
    assert counts["T30"] == counts["T101"] == 2 and counts["T29"] == 1


def test_a_day_is_written_in_few_files(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 40).selectExpr("concat('T', id) as transaction_id", "concat('2026-08-0', id % 3 + 1) as event_date")
    stages.by_day(rows).write.partitionBy("event_date").parquet(f"{tmp_path}/days")
    assert spark.read.parquet(f"{tmp_path}/days").count() == 4000
    assert all(len(list(d.glob("*.parquet"))) <= stages.FILES_A_DAY for d in tmp_path.glob("days/event_date=*"))


def test_exact_collapsing_writes_a_day_in_few_files(spark, place):
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        place[2]("a.txt", *(line(i, hours=24 * (i % 2)) for i in range(400)))
        run(spark, place, dedupe="table", incremental=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    for name in ("silver/transactions", "gold/fact"):
        days = list(Path(place[0].root).glob(f"{name}/event_date=*"))
        assert len(days) == 2 and all(len(list(d.glob("*.parquet"))) <= stages.FILES_A_DAY for d in days), name
    assert place[0].table(spark, pipeline.FACT).count() == 400
