"""From raw lines to structured rows; a malformed line is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve import schemas


def landed(lines: DataFrame, run_id: str) -> DataFrame:
    """Lines (``value`` and the file source's ``_metadata``) with their provenance."""
    source = F.col("_metadata.file_path") if "_metadata" not in lines.columns else F.col("_metadata")["file_path"]
    return lines.select(F.col("value").alias("raw_payload"), source.alias("source_file"), F.current_timestamp().alias("landed_at"), F.lit(run_id).alias("landing_run_id"))


def parsed(landing: DataFrame, *passed_on: str) -> DataFrame:
    """The payload's fields as text, ``is_parseable``, the raw line and the columns ``passed_on``.

    A blank line counts as parseable, with all fields null; of repeated JSON keys the last stands.
    """
    fields = F.from_json("raw_payload", schemas.PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT})
    whole = landing.withColumn("_p", fields)
    return whole.select(*(F.col(f"_p.{f}").alias(f) for f in schemas.PAYLOAD_FIELDS), F.isnull(f"_p.{schemas.CORRUPT}").alias("is_parseable"), "raw_payload", *passed_on)


def structured(landing: DataFrame, run_id: str) -> DataFrame:
    """``parsed`` with ingest time, run and date."""
    own = parsed(landing, "source_file", "landed_at", "landing_run_id")
    return own.withColumns({"ingested_at": F.current_timestamp(), "ingest_run_id": F.lit(run_id), "ingest_date": F.current_date()})
