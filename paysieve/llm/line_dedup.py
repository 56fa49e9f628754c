"""Operator 3: line deduplication by site-relative frequency, in DataFrame functions only.

A line's share is the number of a site's pages that contain it, divided by the site's pages.
Lines whose share exceeds a ratio are boilerplate of that site and are dropped from its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysieve.llm import shared


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col), F.lit(""))


def _keys(lines: Column) -> Column:
    """The md5 of every line without blanks at its ends."""
    return F.transform(lines, lambda x: F.md5(F.trim(x)))


def boilerplate_lines(pages: DataFrame, *, ratio: float = 0.06, min_pages: int = 1, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """host, line (md5 of the trimmed line), n_pages and host_pages of lines over the ratio.

    A page counts once for a line, however often it has it.  A site has at most (lines per page) / ratio such lines.
    """
    lines = F.filter(F.split(F.col(text_col), "\n"), lambda x: F.trim(x) != "")
    keys = F.array_distinct(_keys(lines))
    counts = pages.select(_host(host_col).alias("host"), F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages)
    totals = pages.groupBy(_host(host_col).alias("host")).agg(F.count("*").alias("host_pages"))
    return counts.join(totals, "host").where(F.col("n_pages") / F.col("host_pages") > ratio)


def drop_boilerplate(pages: DataFrame, *, ratio: float = 0.06, min_pages: int = 1, host_col: str = "source", text_col: str = "text", out_col: str = "clean_text", dropped_col: str = "n_dropped") -> DataFrame:
    """``pages`` with the text without its site's boilerplate lines, and how many lines went.

    A line is boilerplate when more than ``ratio`` of its site's pages, and ``min_pages`` at least, have it;
    lines are compared without blanks at their ends, and blank lines stay.  Null and empty sites are
    one site.  A null text stays null and counts as a page; repeated rows count each.  A text that
    loses nothing is unchanged, and one that loses all its lines is empty.  Texts of any length are read
    whole.  An empty table gives no rows.  Other columns pass through; a clash with the two new names replaces the
    old column.
    """
    host, known, gone = (shared.new_name(n, pages.columns) for n in ("host", "known", "gone"))
    # one row a site; written, so that its size is known where the join is planned
    of_host = boilerplate_lines(pages, ratio=ratio, min_pages=min_pages, host_col=host_col, text_col=text_col)
    of_host = shared.written(of_host.groupBy("host").agg(F.collect_set("line").alias("lines")).select(F.col("host").alias(host), F.col("lines").alias(known)), "boilerplate")
    lines = F.split(F.col(text_col), "\n")
    # Spark intersects strings through a hash set; only what the page itself has of its site's lines is then looked for
    joined = pages.join(of_host, _host(host_col) == F.col(host), "left").withColumn(gone, F.array_intersect(_keys(lines), F.col(known)))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(gone), F.md5(F.trim(x))))
    changed = joined.withColumn(known, F.when(F.size(gone) > 0, kept))
    text = F.when(F.col(known).isNotNull(), F.array_join(known, "\n")).otherwise(F.col(text_col))
    n_gone = F.coalesce(F.size(lines) - F.size(known), F.lit(0)).cast("long")
    passed = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in (out_col.lower(), dropped_col.lower())]
    return changed.select(*passed, text.alias(out_col), n_gone.alias(dropped_col))


SQL = """
WITH pages AS (SELECT doc_id, coalesce(source, '') AS host, text, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT host, count(*) AS host_pages FROM pages GROUP BY host),
found AS (SELECT host, unnest(list_distinct(list_filter(list_transform(lines, lambda x: trim(x, ' ')), lambda x: x <> ''))) AS line FROM pages),
counts AS (SELECT host, line, count(*) AS n_pages FROM found GROUP BY host, line HAVING count(*) >= {min_pages}),
boiler AS (SELECT c.host, list(c.line) AS gone FROM counts c JOIN totals t ON c.host = t.host
           WHERE c.n_pages::DOUBLE / t.host_pages::DOUBLE > {ratio}::DOUBLE GROUP BY c.host),
kept AS (SELECT p.doc_id, p.text, p.lines, CASE WHEN b.gone IS NULL THEN p.lines ELSE list_filter(p.lines, lambda x: NOT list_contains(b.gone, trim(x, ' '))) END AS rest
         FROM pages p LEFT JOIN boiler b ON p.host = b.host)
SELECT doc_id, CASE WHEN len(rest) < len(lines) THEN array_to_string(rest, chr(10)) ELSE text END AS clean_text,
       coalesce(len(lines) - len(rest), 0)::BIGINT AS n_dropped
FROM kept
"""
