"""Operator 13: phrases of two to four words that occur together more often than apart.

Words have ids by falling frequency, so that frequent pairs of ids lie near the origin of the square of all pairs.  A block of
text counts its pairs of neighbours by direct addressing: the square is cut into tiles of ``TILE`` x ``TILE`` cells; a
tile with many pairs is counted by one bincount over its cells, and what falls into sparse tiles is sorted into
coordinates with counts.  Spark adds up the blocks' counts.  The frequent pairs are then ranked as the words were, and their ids
put in the place of the words; neighbouring pairs are counted the same way, which gives phrases of three words, and again
of four.  A phrase that occurs often enough has only parts that do, so no other pairs need be counted.

Blocks meet the table of ids in a shuffle by the word (or pair), in both directions, so that no table of words or phrases is
broadcast or held whole by a task; a block's own share of it is bounded by the block.  A word of one group (language) is another than
the same word of a second one; ids follow each other by (group, falling count, word), so each group has its own dense corner.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm import cuts, shared

TILE = 256
#: Pairs that fall into a tile from which on it is counted by bincount; below, sorting them is cheaper than its cells.
DENSE = TILE * TILE // 8
LONGEST = 4
SIGNS = cuts.Signs.of(b" \t", b".,;:!?\n\v\f\r")
_BREAK = -1
#: Ids are below this, so that a pair of them is one long.
_MOST = 1 << 31


def counted_pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, as first * 2^31 + second, and how often each occurs; in no given order."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = int(second.max()) // TILE + 1
    tile = (first // TILE) * wide + second // TILE
    tiles, of_tile, sizes = np.unique(tile, return_inverse=True, return_counts=True)
    keys, counts = [], []
    dense = sizes >= DENSE
    if dense.any():
        # all dense tiles in one array of cells, one tile after the other
        slot = np.cumsum(dense) - 1
        for a in range(0, int(dense.sum()), 256):  # at most 256 tiles, 128 MB of counts, at once
            mine = dense[of_tile] & (slot[of_tile] >= a) & (slot[of_tile] < a + 256)
            cell = (slot[of_tile[mine]] - a) * TILE**2 + first[mine] % TILE * TILE + second[mine] % TILE
            found = np.bincount(cell)
            full = np.flatnonzero(found)
            where = tiles[np.flatnonzero(dense)[a + full // TILE**2]]
            own = full % TILE**2
            keys.append((where // wide * TILE + own // TILE) * _MOST + where % wide * TILE + own % TILE)
            counts.append(found[full])
    rest = ~dense[of_tile]
    if rest.any():
        coordinates, n = np.unique(first[rest] * _MOST + second[rest], return_counts=True)
        keys.append(coordinates)
        counts.append(n)
    return np.concatenate(keys), np.concatenate(counts)


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers from -1 (a break) on, the like bytes of all together, compressed; a break becomes 0, so that high bytes are mostly 0."""
    planes = np.ascontiguousarray((numbers - _BREAK).astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _spread_out(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), dtype=np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64) + _BREAK


@dataclass(frozen=True)
class _Words:
    """Words of texts, the group and the piece of each."""

    words: pa.Array
    groups: pa.Array
    pieces: np.ndarray


def _words_in_blocks(batches, most_bytes: int) -> Iterator[list[_Words]]:
    """The words of about ``most_bytes`` of text at a time; a longer text comes alone."""
    block, size = [], 0
    for batch in batches:
        for own in shared.slices(batch, "text", most_bytes=1 << 20):
            found = cuts.cut(pc.ascii_lower(shared.as_array(own.column("text"))), SIGNS)
            groups = shared.as_array(own.column("group")).dictionary_encode()
            of_word = pa.DictionaryArray.from_arrays(pa.array(np.repeat(np.asarray(groups.indices), np.diff(found.offsets)), pa.int32()), groups.dictionary)
            block.append(_Words(found.words, of_word, found.pieces.astype(np.int32)))
            size += own.nbytes
            if size >= most_bytes:
                yield block
                block, size = [], 0
    if block:
        yield block


def _coded(arrays: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """Distinct values of all arrays, and the number of each value."""
    whole = pa.chunked_array(arrays)
    if not pa.types.is_dictionary(whole.type):
        whole = whole.dictionary_encode()
    whole = whole.unify_dictionaries().combine_chunks()
    one = shared.as_array(whole)
    return one.dictionary, np.asarray(one.indices, dtype=np.int64)


def _words_of_block(block: list[_Words]) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Group and word of each distinct (group, word), how often it occurs, and the numbers of the words in order, with breaks."""
    words, code = _coded([x.words for x in block])
    groups, group = _coded([x.groups for x in block])
    n_words = max(1, len(words))
    flat = group * n_words + code
    ends = np.flatnonzero(np.concatenate([np.append(np.diff(x.pieces) != 0, True)[: len(x.pieces)] for x in block])) + 1
    # numbers by direct addressing, where that is no larger than the words
    if len(groups) * n_words <= 4 * len(flat) + 1024:
        counts = np.bincount(flat, minlength=1)
        full = np.flatnonzero(counts)
        number = np.zeros(len(counts), dtype=np.int64)
        number[full] = np.arange(len(full))
        codes, counts = number[flat], counts[full]
    else:
        full, codes, counts = np.unique(flat, return_inverse=True, return_counts=True)
    return groups.take(pa.array(full // n_words)), words.take(pa.array(full % n_words)), counts, np.insert(codes, ends, _BREAK)


def _block_id(n: int) -> int:
    """Of a task's n-th block; a task has less than 2^11, of which each is of megabytes."""
    if n >= 1 << 11:
        raise ValueError("a partition has too many blocks: use larger blocks or smaller partitions")
    return (TaskContext.get().partitionId() << 11) + n


#: Rows of a block: one for each distinct key, at its place (block * 2^32, for words with the word's code added), and one at -1 - block
#: that has the words' codes, or the ids of which the pairs are made, in order.
_ROW = ["key", "place", "n", "codes"]


def _rows(block: int, key: pa.Array, counts: np.ndarray, codes: np.ndarray | None, *, numbered: bool = True, at_once: int = 1 << 16):
    n = len(key)
    whole = pa.RecordBatch.from_arrays([key, pa.array((block << 32) + np.arange(n) * numbered), pa.array(counts, pa.int64()), pa.nulls(n, pa.binary())], _ROW)
    for a in range(0, n, at_once):
        yield whole.slice(a, at_once)
    if codes is not None:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, key.type), pa.array([-1 - block]), pa.array([len(codes)], pa.int64()), pa.array([_squeezed(codes)], pa.binary())], _ROW)


def _word_rows(batches, most_bytes: int):
    """The key of a word is its group, a space and the word; that of all words of a group is the group and a space."""
    for i, block in enumerate(_words_in_blocks(batches, most_bytes)):
        group, word, counts, codes = _words_of_block(block)
        del block
        yield from _rows(_block_id(i), pc.binary_join_element_wise(group, word, " "), counts, codes)
        of_group = group.dictionary_encode()
        sums = np.bincount(np.asarray(of_group.indices, dtype=np.int64), weights=counts, minlength=0).astype(np.int64)
        yield from _rows(_block_id(i), pc.binary_join_element_wise(of_group.dictionary, "", " "), sums, None)
        pa.default_memory_pool().release_unused()


def _pair_rows(block: int, ids: np.ndarray, *, with_ids: bool):
    """The key of a pair is first * 2^31 + second; its place is that of its block, whose last row has the ids themselves."""
    keys, counts = counted_pairs(*_neighbours(ids)[1:])
    order = np.argsort(keys)
    keys = pa.array(keys[order], pa.int64())
    yield from _rows(block, keys, counts[order], ids if with_ids else None, numbered=False)


def _neighbours(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where an id and the next one are no breaks, and both."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    return at, ids[at], ids[at + 1]


def _one_break(ids: np.ndarray) -> np.ndarray:
    """Breaks in a row become one."""
    gone = ids < 0
    gone[1:] &= gone[:-1].copy()
    gone[:1] = False
    return ids[~gone]


def _ids_of_words(codes: np.ndarray, number: np.ndarray, id_of: np.ndarray) -> np.ndarray:
    """The ids of the codes; a code without an id is a break."""
    table = np.full(max(codes.max(initial=0), number.max(initial=0)) + 2, _BREAK, dtype=np.int64)
    table[number] = id_of
    return _one_break(table[codes])  # a break's code, -1, is the last entry


def _ids_of_pairs(ids: np.ndarray, keys: np.ndarray, id_of: np.ndarray) -> np.ndarray:
    """The ids of neighbours, at the place of the first; a pair without an id is a break."""
    out = np.full(len(ids), _BREAK, dtype=np.int64)
    if len(keys):
        order = np.argsort(keys)
        keys, id_of = keys[order], id_of[order]
        at, first, second = _neighbours(ids)
        wanted = first * _MOST + second
        near = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[near] == wanted
        out[at[hit]] = id_of[near[hit]]
    return _one_break(out)


def _found_often(keyed: DataFrame, least: int, name: str) -> DataFrame:
    """place, n and key of the keys that occur ``least`` times or more, and f at the first place of each, written.

    One shuffle by key serves the count and the way back to the places.  A key has a row a block at most.
    """
    # both ways read all three columns; were one left out, Spark would shuffle the rows once for each
    rows = keyed.where("place >= 0 and key is not null").select("key", "place", "n").repartition("key")
    often = rows.groupBy("key").agg(F.sum("n").alias("f"), F.min("place").alias("_first")).where(F.col("f") >= least)
    found = rows.join(often.hint("shuffle_hash"), "key").select("key", "place", "n", F.when(F.col("place") == F.col("_first"), F.col("f")).alias("f"))
    return shared.written(found, name, **_PACKED)


def _counts(places: DataFrame) -> DataFrame:
    """key and f of each key."""
    return places.where(F.isnotnull("f")).select("key", "f")


def _pairs_of_blocks(keyed: DataFrame, places: DataFrame, table: DataFrame, *, of_words: bool, with_ids: bool) -> DataFrame:
    """Rows of neighbouring ids, where the blocks' words (or pairs) are replaced by their ids of ``table``; others are breaks."""
    number = F.col("place").bitwiseAND((1 << 32) - 1) if of_words else F.col("key")
    found = places.select("key", "place").join(table.select("key", "id"), "key").select(F.shiftright("place", 32).alias("block"), number.alias("number"), "id")
    blocks = keyed.where("place < 0").select((-1 - F.col("place")).alias("own_block"), "n", "codes")
    replaced = _ids_of_words if of_words else _ids_of_pairs

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise ValueError("a block is not written once")
        ids = replaced(_spread_out(left.column("codes")[0].as_py(), left.column("n")[0].as_py()), right.column("number").to_numpy(), right.column("id").to_numpy())
        out = pa.Table.from_batches(_pair_rows(left.column("own_block")[0].as_py(), ids, with_ids=with_ids), schema=_PAIR_SCHEMA)
        pa.default_memory_pool().release_unused()
        return out

    # a block has no more numbers than words, so a group is bounded by the block
    return blocks.groupBy("own_block").cogroup(found.groupBy("block")).applyInArrow(joined, "key long, place long, n long, codes binary")


_PAIR_SCHEMA = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("codes", pa.binary())])
#: Ascending numbers are stored as small differences.
_PACKED = {"compression": "zstd", "parquet.writer.version": "v2"}


def ranked(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """``df`` with ``id`` 0, 1, ... in this order, written; no task has more than a range of the rows."""
    df = shared.written(df, f"{name}-unordered")  # range partitioning reads it twice
    rows = shared.written(df.repartitionByRange(shared.partitions(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    # a row a partition
    return rows.join(F.broadcast(before), part == F.col("_part")).withColumn("id", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")


def frequent_phrases(docs: DataFrame, *, group_col: str = "lang", text_col: str = "text", least: int = 30, block_bytes: int = 16 << 20) -> tuple[DataFrame, list[DataFrame]]:
    """(group, n), all words of each group; and for one to four words the table of the phrases that occur ``least`` times or more.

    A table has group, phrase, f (occurrences), ``id``, for more than one word ``a`` and ``b`` (the ids, one size
    below, of the phrase without its last and without its first word), and ``heads`` and ``tails``: the occurrences of the first k and
    of the other words, for k = 1, 2, ...
    """
    texts = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("group"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spark = docs.sparkSession
    paths = [shared.new_path(spark, "words"), shared.new_path(spark, "places-1")]
    keyed = shared.written(texts.mapInArrow(lambda b: _word_rows(b, block_bytes), "key string, place long, n long, codes binary"), paths[0], **_PACKED)
    word = F.substring_index("key", " ", -1)
    group = F.expr("left(key, length(key) - length(substring_index(key, ' ', -1)) - 1)")
    totals = shared.written(keyed.where("key like '% '").groupBy(group.alias("group")).agg(F.sum("n").alias("n")), "totals")
    keyed = keyed.where("key is null or key not like '% '")
    places = _found_often(keyed, least, paths[1])
    named = _counts(places).select("key", "f", group.alias("group"), word.alias("phrase"))
    none = F.array().cast("array<long>")
    table = ranked(named, "phrases-1", [F.col("group"), F.desc("f"), F.col("phrase")]).withColumns({"heads": none, "tails": none})
    tables = [table]
    for size in range(2, LONGEST + 1):
        read, paths = paths, [shared.new_path(spark, f"pairs-{size}"), shared.new_path(spark, f"places-{size}")]
        keyed = shared.written(_pairs_of_blocks(keyed, places, table, of_words=size == 2, with_ids=size < LONGEST), paths[0], **_PACKED)
        # nothing reads the blocks of the size below again
        shared.delete(spark, read)
        if size < LONGEST:
            places = _found_often(keyed, least, paths[1])
            pairs = _counts(places)
        else:
            pairs = keyed.groupBy("key").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        pairs = pairs.withColumns({"a": F.shiftright("key", 31), "b": F.col("key").bitwiseAND(_MOST - 1)})
        first = table.select("group", F.col("phrase").alias("_first"), F.col("id").alias("a"), F.array_append("heads", F.col("f")).alias("heads"))
        second = table.select(F.substring_index("phrase", " ", -1).alias("_last"), F.col("id").alias("b"), F.array_prepend("tails", F.col("f")).alias("tails"))
        whole = pairs.join(first, "a").join(second, "b").withColumn("phrase", F.concat_ws(" ", "_first", "_last")).drop("_first", "_last")
        table = ranked(whole, f"phrases-{size}", [F.col("group"), F.desc("f"), F.col("phrase")])
        tables.append(table)
    if any((t.agg(F.max("id")).first()[0] or 0) >= _MOST for t in tables):
        raise ValueError(f"over {_MOST} frequent phrases of one size: raise the least number of occurrences")
    return totals, tables


def _cut(k: Column, f: Column, left: Column, right: Column) -> Column:
    """The score of a cut after k words first, for the least; exact beyond 64 bits."""
    score = F.call_function("div", f.cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)"), (left + right).cast("decimal(20,0)"))
    return F.struct(score.cast("long").alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))


def collocations(docs: DataFrame, *, group_col: str = "lang", text_col: str = "text", least: int = 30, most: int = 2000, share: tuple[int, int] = (4, 5), block_bytes: int = 16 << 20) -> DataFrame:
    """The ``most`` best phrases of two to four words of each group: lang, rank, phrase, a, l, r, n, score.

    ASCII letters are folded.  Pieces end at ``.,;:!?``, line ends, vertical tabs and form feeds; words at spaces and
    tabs; a phrase lies in one piece.  Candidates occur ``least`` times or more.  A phrase is as good as its worst cut in two:
    2,000,000 * a / (l + r), rounded down.  One whose words lie in a longer candidate with at
    least ``share`` of its occurrences goes.  Ties go to more occurrences, then to the phrase that is first in byte order.

    Null groups are ``und``; null and empty texts have no words.  Repeated rows count each time.  A text of any length is read whole.
    An empty table, or one without a candidate, gives an empty one.  Other columns are not read.
    """
    totals, tables = frequent_phrases(docs, group_col=group_col, text_col=text_col, least=least, block_bytes=block_bytes)
    out = []
    for i, table in enumerate(tables[1:], 1):
        own = table
        if i + 1 < len(tables):
            # a phrase within one two words longer is within one a word longer that occurs as often at least
            longer = tables[i + 1].select(F.explode(F.array("a", "b")).alias("id"), F.col("f").alias("_f")).groupBy("id").agg(F.max("_f").alias("_f"))
            part, of = share
            own = own.join(longer, "id", "left").where(F.isnull("_f") | (F.col("_f") * of < F.col("f") * part))
        cuts_of = F.transform(F.sequence(F.lit(1), F.lit(i)), lambda k: _cut(k, F.col("f"), F.element_at("heads", k), F.element_at("tails", k)))
        out.append(own.select("group", "phrase", F.col("f").alias("a"), F.array_min(cuts_of).alias("cut")))
    every = out[0]
    for x in out[1:]:
        every = every.union(x)
    every = every.select(F.col("group").alias("lang"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # of each of several shares of a group first, so that no task sorts a whole group
    shares = max(1, round(shared.partitions(docs.sparkSession) ** 0.5))
    dealt = every.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    few = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*best))).where(F.col("rank") <= most)
    top = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= most)
    return top.join(totals.withColumnRenamed("group", "lang"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: One statement from the definitions, with n-grams by position.
SQL = """
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, row_number() OVER () AS d FROM documents),
pieces AS (SELECT lang, d, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM cut, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= {least}),
parts AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS j FROM c),
cuts AS (SELECT p.lang, p.phrase, p.k, p.a, p.j, x.a AS l, y.a AS r, (2000000::HUGEINT * p.a // (x.a + y.a))::BIGINT AS score FROM parts p
    JOIN f x ON x.lang = p.lang AND x.k = p.j AND x.phrase = array_to_string(p.w[1:p.j], ' ') JOIN f y ON y.lang = p.lang AND y.k = p.k - p.j AND y.phrase = array_to_string(p.w[p.j + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, j) = 1),
inner_parts AS (SELECT c.lang, c.a, m.m AS m, unnest(list_transform(range(1, c.k - m.m + 2), lambda i: array_to_string(c.w[i:i + m.m - 1], ' '))) AS phrase FROM c, (SELECT unnest([2, 3]) AS m) m WHERE m.m < c.k),
longest AS (SELECT lang, m AS k, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
kept AS (SELECT w.* FROM worst w LEFT JOIN longest o ON o.lang = w.lang AND o.k = w.k AND o.phrase = w.phrase WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang)
QUALIFY rank <= {most}
"""
