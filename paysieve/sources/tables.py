"""Tables of the layers, file sources and panel files."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from paysieve import schemas

#: Of a table that is not there yet: no folder, or nothing committed in it.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST"}


@dataclass(frozen=True)
class Drained:
    """Rows that a stream's run wrote, rows that its state dropped as too late, and its last watermark, if it had one."""

    rows: int
    late: int = 0
    watermark: str | None = None


@dataclass
class _Report:
    rows: int = 0
    late: int = 0
    watermark: str | None = None
    ended: threading.Event = field(default_factory=threading.Event)


class _Reports(StreamingQueryListener):
    """Adds up every micro-batch's report of the queries that run meanwhile, whatever their number."""

    def __init__(self) -> None:
        self.of: dict[str, _Report] = defaultdict(_Report)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p, own = event.progress, self.of[str(event.progress.runId)]
        if "written" in p.observedMetrics:
            own.rows += p.observedMetrics["written"]["rows"]
        own.late += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        own.watermark = max(filter(None, (own.watermark, p.eventTime.get("watermark"))), default=None)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.of[str(event.runId)].ended.set()


def _finished(spark: SparkSession, start: Callable[[], StreamingQuery]) -> _Report:
    """Waits for the end of the query that ``start`` starts, and for its last report."""
    reports = _Reports()
    spark.streams.addListener(reports)
    try:
        run = start()
        run.awaitTermination()
        own = reports.of[str(run.runId)]
        if not own.ended.wait(timeout=60):
            raise TimeoutError("the stream's reports have not come")
        return own
    finally:
        spark.streams.removeListener(reports)


@dataclass(frozen=True)
class Store:
    """Where tables and checkpoints are: below ``root``, or in a catalog's schemas when ``catalog`` is set.

    In a catalog a zone's schema is ``prefix`` and the zone; checkpoints are below ``root`` all the same.
    """

    root: str
    format: str = "parquet"
    catalog: str | None = None
    prefix: str = ""

    def table(self, spark: SparkSession, where: tuple[str, str]) -> Table:
        """The table of a (zone, name); the zone's schema is made where a catalog has none."""
        zone, name = where
        if self.catalog:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.catalog}.{self.prefix}{zone}")
        return Table(spark, self, f"{self.catalog}.{self.prefix}{zone}.{name}" if self.catalog else f"{self.root}/{zone}/{name}")


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    store: Store
    address: str

    def there(self) -> bool:
        """Whether anything was written; a table that is there and cannot be read is an error, not an absence."""
        if self.store.catalog:
            return self.spark.catalog.tableExists(self.address)
        try:
            self.rows()
        except AnalysisException as e:
            if e.getCondition() not in ABSENT:
                raise
            return False
        return True

    def rows(self, schema: T.StructType | None = None, *, or_empty: bool = False) -> DataFrame:
        """All rows; with ``or_empty`` none of ``schema`` where there is no table."""
        if or_empty and not self.there():
            return self.spark.createDataFrame([], schema)
        if self.store.catalog:
            self.spark.catalog.refreshTable(self.address)  # a stream's batches write in a session of their own
            return self.spark.table(self.address)
        source = self.spark.read.format(self.store.format)
        return (source if schema is None else source.schema(schema)).load(self.address)

    def count(self) -> int:
        """Rows of the table, 0 if there is none."""
        return self.rows().count() if self.there() else 0

    def news(self, schema: T.StructType, **options: str) -> DataFrame:
        """A stream of the rows that came since its reader's checkpoint."""
        source = self.spark.readStream.options(**options)
        return source.table(self.address) if self.store.catalog else source.format(self.store.format).schema(schema).load(self.address)

    def replace(self, df: DataFrame, *, by: tuple[str, ...] = ()) -> None:
        """The whole table anew.  Never of a table that a stream writes."""
        sink = df.write.format(self.store.format).mode("overwrite").partitionBy(*by)
        if self.store.format == "delta":
            sink = sink.option("overwriteSchema", "true")
        sink.saveAsTable(self.address) if self.store.catalog else sink.save(self.address)

    def append(self, df: DataFrame, *, by: tuple[str, ...] = ()) -> int:
        """More rows, by a batch; how many.  Never to a table that a stream writes."""
        seen = Observation("appended")
        sink = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(self.store.format).mode("append").partitionBy(*by)
        sink.saveAsTable(self.address) if self.store.catalog else sink.save(self.address)
        return seen.get["rows"]

    def replace_parts(self, df: DataFrame, *, by: tuple[str, ...]) -> None:
        """The partitions that ``df`` has rows of, anew; the others stay."""
        if not self.there():
            self.replace(df, by=by)
        elif self.store.catalog:
            own = df.select(*self.rows().columns)
            own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self.address)
        else:
            df.write.format(self.store.format).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(self.address)

    def drop_parts(self, column: str, values: list[str]) -> None:
        """The partitions of these values go, if they are there."""
        if not values or not self.there():
            return
        if self.store.catalog:
            self.spark.sql(f"ALTER TABLE {self.address} DROP IF EXISTS " + ", ".join(f"PARTITION ({column} = '{v}')" for v in values))
            return
        jvm = self.spark._jvm
        for v in values:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.address}/{column}={v}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drain(self, df: DataFrame, stage: str, *, by: tuple[str, ...] = ()) -> Drained:
        """Append what is new in the stream ``df``, exactly once by the stage's checkpoint, and wait for the end.

        Rows are counted where they are written: file sinks report no number of their own.
        """
        sink = df.observe("written", F.count(F.lit(1)).alias("rows")).writeStream.format(self.store.format).outputMode("append").partitionBy(*by)
        sink = self._at(sink, stage)
        own = _finished(self.spark, lambda: sink.toTable(self.address) if self.store.catalog else sink.start(self.address))
        return Drained(own.rows, own.late, own.watermark)

    def drain_batches(self, df: DataFrame, stage: str, write: Callable[[DataFrame, int], None]) -> None:
        """Hand what is new in the stream ``df`` to ``write``, batch by batch; a batch comes again if it failed midway."""
        _finished(self.spark, self._at(df.writeStream.foreachBatch(write), stage).start)

    def _at(self, sink, stage: str):
        return sink.option("checkpointLocation", f"{self.store.root}/checkpoints/{stage}").trigger(availableNow=True)


def text_lines(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """New lines of text files as they come: value, and the file source's _metadata."""
    return spark.readStream.format("text").options(**options).load(folder).select("value", "_metadata")


def label_files(spark: SparkSession, pattern: str) -> DataFrame:
    """generated_at, labels (a map) and the file's path."""
    return spark.read.schema(schemas.LABEL_FILE).json(pattern, multiLine=True).withColumn("file", F.col("_metadata.file_path"))


def panel(df: DataFrame, *, environment: str, engine: str, store: str, digits: int = 4) -> DataFrame:
    """``df`` ready for a JSON file: NaN and infinities null, doubles rounded, times as text, and where it came from."""
    def clean(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(F.abs(c) < float("inf"), F.round(c, digits))
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        return F.date_format(c, "yyyy-MM-dd") if isinstance(f.dataType, T.DateType) else c

    source = F.struct(F.lit(environment).alias("environment"), F.lit(engine).alias("engine"), F.lit(store).alias("store"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"))
    return df.select(*(clean(f).alias(f.name) for f in df.schema.fields), source.alias("source"))


def write_panel(df: DataFrame, path: str, *, one_file: bool = True, **source: str) -> None:
    """JSON lines: one file of a small aggregate, or as many as Spark has partitions."""
    out = panel(df, **source)
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_panel(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
