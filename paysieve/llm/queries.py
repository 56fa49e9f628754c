"""The operators' queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve.llm import bpe_table, collocations, dart_minhash, line_dedup, nnls_packing, oph, periodic_runs, pivot_topk, secret_crf, shared, token_files, toxicity, url_filter, warc_fixity

#: A vocabulary file of the public_tokenizers package.
TOKENIZER = "word_bpe_49k.json"
#: At most so many labelled rows teach the toxicity lexicon.
TRAINING_ROWS = 20_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shared.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rules for urls: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: A line of two pages at least, which shows that it recurs, on more than 6 % of its site's.
BOILERPLATE = {"ratio": 0.06, "min_pages": 2}


def op1_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC files of 256 records, against a replica that is damaged by a rule."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.floor(F.col("page_id") / 256).alias("file"), "url", "html")
    first, second = (
        warc_fixity.leaves(x.select("file", "page_id", warc_fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record")), file_col="file", id_col="page_id", record_col="record")
        for x in (pages, warc_fixity.damaged(pages))
    )
    return warc_fixity.audit(first, second)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=2)
    return token_files.token_index(token_files.read_token_files(spark, path))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), **BOILERPLATE)
    return out.select("doc_id", "clean_text", "n_dropped")


def op4_oph_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = oph.fingerprint_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op5_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = nnls_packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def trained_lexicon(spark: SparkSession, sf_dir: str, *, all_rows: bool = False) -> toxicity.Lexicon:
    """Learned from the labelled documents; unless ``all_rows``, without those that op8 holds out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where("label is not null")
    if not all_rows:
        labels = labels.where(~held_out())
    order = F.xxhash64("doc_id")
    # the bound on rows comes before the texts: only the sample's texts are joined
    sample = labels.orderBy(order, "doc_id").limit(TRAINING_ROWS)
    labelled = table(spark, sf_dir, "documents").select("doc_id", "text").join(sample, "doc_id")
    return toxicity.learn(labelled, most_rows=None)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = trained_lexicon(spark, sf_dir)
    out = toxicity.score_texts(table(spark, sf_dir, "documents"), lexicon, keep=("doc_id",))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_bpe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_table.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), decode=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_crf.scan(docs, secret_crf.learn(docs))
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != secret_crf.FIELD)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secret_crf.KINDS),
        F.sha2(named(base).cast("binary"), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")))
    best = out.withColumns({"best": periodic_runs.strongest(F.col("runs")), "lines": periodic_runs.runs_text(F.col("runs"))})
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: Phrases of 30 occurrences at least, and the first 2000 of each language.
PHRASES = {"least": 30, "most": 2000}


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), **PHRASES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_fixity,
        op2_token_files,
        op3_line_dedup,
        op4_oph_fingerprints,
        op5_nnls_packing,
        op6_dart_minhash,
        op7_pivot_topk,
        op8_toxicity,
        op9_url_filter,
        op10_bpe_table,
        op11_secret_crf,
        op12_periodic_runs,
        op13_collocations,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc_fixity": warc_fixity.SQL,
    "op3_line_dedup": line_dedup.SQL.format(**BOILERPLATE),
    "op7_pivot_topk": pivot_topk.SQL,
    "op9_url_filter": url_filter.SQL,
    "op13_collocations": collocations.SQL.format(**PHRASES),
}
