"""The corpus pipeline: toxic documents go, then boilerplate lines, then near-duplicates; the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next
stage's docs.  All but the last return the columns of ``documents``.

In all stages nulls are allowed in any column, texts of any length are read whole, repeated rows are rows of
their own unless a stage says otherwise, further columns are not read, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve.llm import dart_minhash, line_dedup, nnls_packing, queries, shared, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not call toxic; it learns from all labelled documents, ``TRAINING_ROWS`` at most.

    Null and empty texts match nothing and stay; a score of exactly the threshold goes.  Without labels of both
    kinds all documents stay.
    """
    shared.prepare(spark)
    lexicon = queries.trained_lexicon(spark, sf_dir, all_rows=True)
    return toxicity.score_texts(docs.select(COLUMNS), lexicon).where("predicted = 0").select(COLUMNS)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's boilerplate lines.

    Null and empty sources are one site.  A null text stays null; one that loses all its lines is empty and stays.
    A line at exactly the ratio stays.  n_chars is counted anew where lines went.
    """
    shared.prepare(spark)
    out = line_dedup.drop_boilerplate(docs.select(COLUMNS), **queries.BOILERPLATE)
    text = F.when(F.col("n_dropped") > 0, F.col("clean_text")).otherwise(F.col("text"))
    return out.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_dropped") > 0, F.length("clean_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least doc_id.

    Null texts are empty, and all empty texts are one class.  Of rows that repeat the least doc_id one stays.  A null
    doc_id is after all others, and stays only where its class has no other.
    """
    shared.prepare(spark)
    return dart_minhash.kept_documents(docs.select(COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 2048 tokens.

    A null text is empty: its one id is the end id.  Null and repeated doc_ids are documents of their own.
    """
    shared.prepare(spark)
    pieces = nnls_packing.pack_documents(docs, queries.tokenizer_path(), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: The learned lexicon, the near-duplicate classes and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
