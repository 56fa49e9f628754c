"""Operator 1: Merkle fixity audit of WARC archives.

A record is a WARC record of a page at an offset of an archive file.  Leaves are records' digests;
a node over them is an ordered range of offsets of a file, then ranges of ranges, whole files and
ranges of files, up to one root.  Two replicas' roots are compared; where they differ, only the
children of differing nodes are compared, level by level, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm import shared

FILE, OFFSET, LENGTH, RECORD, DIGEST = "file", "offset", "length", "record_id", "digest"


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """A WARC/1.1 resource record as text; null parts are empty."""
    content = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]", " "),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(content).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, content, F.lit("\r\n\r\n"))


def leaves(records: DataFrame, *, file_col: str, id_col: str, record_col: str, unfiled: int = 256) -> DataFrame:
    """file, offset, length, record_id and digest of WARC records; a file's records stand in the order of their ids.

    A file is of bounded size, as archives are.  Files are counted from 0; records without one, or with a negative
    one, are dealt by a hash to files -1 to -``unfiled``, since they may be many.  A null record is an empty one, and a
    record of any length has one digest.  Records with one id, or none, are ordered by digest.
    """
    record = F.coalesce(F.col(record_col).cast("binary"), F.lit(b""))
    none = -1 - F.pmod(F.xxhash64(F.col(id_col).cast("long"), record), F.lit(unfiled))
    file = F.col(file_col).cast("long")
    own = records.select(F.when(file >= 0, file).otherwise(none).alias(FILE), F.col(id_col).cast("long").alias(RECORD), F.length(record).cast("long").alias(LENGTH), F.sha2(record, 256).alias(DIGEST))
    order = Window.partitionBy(FILE).orderBy(F.col(RECORD).asc_nulls_first(), DIGEST)
    before = F.coalesce(F.sum(LENGTH).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.withColumn(OFFSET, before).withColumn("nth", F.row_number().over(Window.partitionBy(FILE, RECORD).orderBy(OFFSET)))


def depth(of: list[DataFrame], span: int, fan_out: int) -> tuple[int, int]:
    """Levels above the ranges until every file is one node, and from there until one root, over all replicas."""
    tops = [x.agg(F.max(OFFSET).alias("o"), F.max(_place(F.col(FILE))).alias("f")).first() for x in of]
    within, files = max((t.o or 0) // span for t in tops), max(t.f or 0 for t in tops)
    up = lambda n: next(k for k in range(64) if n // fan_out**k == 0)
    return up(within), up(files)


def tree(of: DataFrame, levels: tuple[int, int], *, span: int, fan_out: int) -> list[DataFrame]:
    """Nodes (file, node, hash) from ranges of ``span`` bytes of a file up to the root, each over ``fan_out`` nodes at most.

    A node's hash is over its children's places and hashes, in order.  A range holds no more records than fit in
    its bytes, so no node gathers an unbounded group.
    """
    entry = F.concat_ws(":", F.lpad(F.col(OFFSET).cast("string"), 20, "0"), F.col(LENGTH).cast("string"), F.coalesce(F.col(RECORD).cast("string"), F.lit("")), F.col(DIGEST))
    over = lambda e: F.sha2(F.concat_ws("|", F.sort_array(F.collect_list(e))), 256).alias("hash")
    out = [shared.written(of.groupBy(FILE, _range(span).alias("node")).agg(over(entry)), "merkle")]
    for i in range(sum(levels)):
        key = _parent(i, levels, fan_out)
        child = F.concat_ws(":", F.lpad(F.col(FILE).cast("string"), 20, "0"), F.lpad(F.col("node").cast("string"), 20, "0"), "hash")
        out.append(shared.written(out[-1].groupBy(*(c.alias(n) for c, n in zip(key, (FILE, "node"), strict=True))).agg(over(child)), "merkle"))
    return out


def _range(span: int) -> Column:
    return F.floor(F.col(OFFSET) / span)


def _parent(level: int, levels: tuple[int, int], fan_out: int) -> tuple[Column, Column]:
    """The key one level up; files are counted from 0 once their ranges are one node."""
    if level < levels[0]:
        return F.col(FILE), F.floor(F.col("node") / fan_out)
    return F.floor((_place(F.col(FILE)) if level == levels[0] else F.col(FILE)) / fan_out), F.lit(0).cast("long")


def _place(file: Column) -> Column:
    """Files in one row from 0 on: 0, -1, 1, -2, 2, ..., so that negative ones meet the others under one root."""
    return F.when(file >= 0, 2 * file).otherwise(-2 * file - 1)


def audit(first: DataFrame, second: DataFrame, *, span: int = 1 << 16, fan_out: int = 16) -> DataFrame:
    """The records in which two replicas' leaves differ, found from their roots down.

    file, record_id, status, offset, replica_offset, digest, replica_digest; status: corrupt (another content), moved
    (the same content at another offset), missing (only in the first), extra (only in the second).
    Records with one id are told apart by their order.  Equal or empty replicas give no rows.
    """
    first, second = shared.written(first, "leaves"), shared.written(second, "leaves")
    levels = depth([first, second], span, fan_out)
    a, b = (tree(x, levels, span=span, fan_out=fan_out) for x in (first, second))
    names = [FILE, "node"]

    def differing(x: DataFrame, y: DataFrame) -> DataFrame:
        both = x.withColumnRenamed("hash", "x").join(y.withColumnRenamed("hash", "y"), names, "full")
        return both.where(~F.col("x").eqNullSafe(F.col("y"))).select(*names)

    wrong = differing(a[-1], b[-1])
    for i in range(len(a) - 2, -1, -1):
        key = _parent(i, levels, fan_out)
        above = wrong.select(F.col(FILE).alias("_file"), F.col("node").alias("_node"))
        below = [x[i].join(above, (key[0] == F.col("_file")) & (key[1] == F.col("_node")), "left_semi") for x in (a, b)]
        wrong = shared.written(differing(*below), "mismatches")
    under = wrong.select(FILE, F.col("node").alias("_node"))
    x, y = (z.withColumn("_node", _range(span)).join(under, [FILE, "_node"], "left_semi").select(FILE, RECORD, "nth", F.col(OFFSET).alias(f"{n}_offset"), F.col(DIGEST).alias(f"{n}_digest")) for z, n in ((first, "x"), (second, "y")))
    left, right = x.alias("l"), y.alias("r")
    same = (F.col(f"l.{FILE}") == F.col(f"r.{FILE}")) & F.col(f"l.{RECORD}").eqNullSafe(F.col(f"r.{RECORD}")) & (F.col("l.nth") == F.col("r.nth"))
    joined = left.join(right, same, "full")
    status = F.when(F.col("y_digest").isNull(), "missing").when(F.col("x_digest").isNull(), "extra").when(F.col("x_digest") != F.col("y_digest"), "corrupt").when(F.col("x_offset") != F.col("y_offset"), "moved")
    out = joined.select(F.coalesce(f"l.{FILE}", f"r.{FILE}").alias(FILE), F.coalesce(f"l.{RECORD}", f"r.{RECORD}").alias(RECORD), status.alias("status"), F.col("x_offset").alias(OFFSET), F.col("y_offset").alias("replica_offset"), F.col("x_digest").alias(DIGEST), F.col("y_digest").alias("replica_digest"))
    return out.where(F.col("status").isNotNull())


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` (page_id, file, url, html) with bit rot, a longer record here and there, and cut-off files."""
    pages = pages.withColumn("html", F.coalesce("html", F.lit("")))
    rot = F.concat(F.lit("\u0000"), F.substring(F.col("html"), 2, 1 << 30))
    html = F.when((F.col("page_id") % 97 == 5) & (F.length("html") > 0), rot).when(F.col("page_id") % 1009 == 8, F.concat("html", F.lit("\u0000"))).otherwise(F.col("html"))
    return pages.withColumn("html", html).where(~((F.col("file") % 31 == 3) & (F.col("page_id") % 256 >= 250)))


SQL = """
WITH pages_of AS (SELECT page_id, page_id // 256 AS file, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
bad AS (SELECT page_id, file, url, CASE WHEN page_id % 97 = 5 AND length(html) > 0 THEN chr(0) || substr(html, 2)
        WHEN page_id % 1009 = 8 THEN html || chr(0) ELSE html END AS html FROM pages_of WHERE NOT (file % 31 = 3 AND page_id % 256 >= 250)),
both_of AS (SELECT 'x' AS r, * FROM pages_of UNION ALL SELECT 'y', * FROM bad),
records AS (SELECT r, page_id, file, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10),
    'WARC-Target-URI: ', replace(replace(url, chr(13), ' '), chr(10), ' '), chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen(html), chr(13), chr(10), chr(13), chr(10),
    html, chr(13), chr(10), chr(13), chr(10)) AS record FROM both_of),
placed AS (SELECT r, page_id, file, sha256(record) AS digest,
    coalesce(sum(strlen(record)) OVER (PARTITION BY r, file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM records)
SELECT x.file::BIGINT AS file, x.page_id AS record_id,
       CASE WHEN y.digest IS NULL THEN 'missing' WHEN x.digest <> y.digest THEN 'corrupt' ELSE 'moved' END AS status,
       x.place AS "offset", y.place AS replica_offset, x.digest, y.digest AS replica_digest
FROM (SELECT * FROM placed WHERE r = 'x') x LEFT JOIN (SELECT * FROM placed WHERE r = 'y') y ON x.page_id = y.page_id
WHERE y.digest IS NULL OR x.digest <> y.digest OR x.place <> y.place
"""
