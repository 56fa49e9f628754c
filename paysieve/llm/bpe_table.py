"""Operator 10: encoding through a table of distinct words, decoding through an id-to-piece join.

Texts are split into white-space words in blocks of some MB.  A block keeps, for each position,
the number of its word among the block's distinct words; the distinct words themselves are dealt
out by a hash into shares, so that all blocks' uses of a word meet in one task, where the word is
encoded once.  The ids go back to each block and are joined to the positions by number.
Decoding joins ids with the vocabulary's pieces, a table that the vocabulary bounds.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm import shared, shingles, words


def _blocks(batches: Iterator[pa.RecordBatch], most_bytes: int, shares: int) -> Iterator[tuple[int, pa.Table, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Block id, rows, distinct words by share, where shares start, each position's word, where texts start.

    The blocks follow from a partition's rows alone, so a repeated task makes the same ones.
    """
    part, k = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0

    def block():
        rows = pa.Table.from_batches(held).combine_chunks()
        at, offsets = words.split(shared.as_array(rows.column("text")))
        coded = at.dictionary_encode()
        distinct = coded.dictionary
        share = (shingles.hashed(distinct) % np.uint64(shares)).astype(np.int32)
        order = np.argsort(share, kind="stable")
        number = np.empty(len(order), dtype=np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        codes = number[np.asarray(coded.indices)] if len(order) else np.zeros(0, np.int32)
        starts = np.searchsorted(share[order], np.arange(shares + 1))
        return (part << 32) + k, rows, distinct.take(pa.array(order)), starts, codes, offsets

    for batch in batches:
        for own in shared.slices(batch, "text", 1 << 20):
            held.append(own)
            size += own.nbytes
            if size >= most_bytes:
                yield block()
                held, size, k = [], 0, k + 1
                pa.default_memory_pool().release_unused()
    if held:
        yield block()


def _word_rows(batches, most_bytes: int, shares: int):
    """A row for each block and share, with the share's words in one text."""
    for block, _, distinct, starts, _, _ in _blocks(batches, most_bytes, shares):
        full, lists = _by_share(distinct, starts)
        texts = pc.binary_join(lists, " ")
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(full), block)), pa.array(full.astype(np.int32)), texts], ["block", "share", "words"])


def _position_rows(batches, most_bytes: int, shares: int):
    for block, rows, distinct, starts, codes, offsets in _blocks(batches, most_bytes, shares):
        columns = [[block], [rows.column("doc_id").to_pylist()], [np.diff(offsets).tolist()], [len(distinct)], [_stamp(pc.binary_join(_by_share(distinct, starts)[1], " "))], [_squeezed(codes)]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["block", "doc_ids", "n_words", "n_distinct", "stamp", "codes"])


def _by_share(distinct: pa.Array, starts: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    full = np.flatnonzero(np.diff(starts))
    return full, pa.ListArray.from_arrays(pa.array(np.append(starts[full], starts[-1]).astype(np.int32)), distinct)


def _stamp(texts: pa.Array) -> int:
    """Of a block's words, share by share; tells whether both passes over the texts met the same block."""
    return sum(zlib.crc32(t.as_buffer()) for t in texts)


def _squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers below 2^32, the like bytes of all together, compressed; the count comes first."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(numbers) else b"")


def _spread_out(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, dtype=np.uint32)
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd", asbytes=True), dtype=np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def encode_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, block_bytes: int = 12 << 20) -> DataFrame:
    """doc_id, n_tokens and ids (u32, little-endian bytes) of every text, as the tokenizer gives them; with ``decode`` also decoded.

    ``docs`` is read twice and has to come in the same partitions both times, as a table's do: write what
    comes from a shuffle first.  If it does not, the query fails; it never gives other ids.

    A null text is empty and has no ids.  Repeated rows and null or repeated doc_ids stay rows of
    their own.  A word of any length is encoded whole.  Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words.fitting(tokenizer)
    parts = shared.partitions(docs.sparkSession)

    def encoded(batches):
        encode = words.Encoder(tokenizer)  # of this share alone: its distinct words are met once, as far as they fit
        for batch in batches:
            for own in shared.slices(batch, "words"):
                lists = pc.ascii_split_whitespace(own.column("words"))
                coded = lists.flatten().dictionary_encode()
                table = encode.of_distinct(coded.dictionary)
                starts = np.asarray(lists.offsets, dtype=np.int64) - lists.offsets[0].as_py()
                ids, edges = words.spread(table, np.asarray(coded.indices, dtype=np.int64), starts)
                sizes = np.asarray(pc.list_value_length(table), dtype="<u4")[np.asarray(coded.indices)]
                rows = [_squeezed(sizes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                found = [_squeezed(ids[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                stamps = [zlib.crc32(t.as_buffer()) for t in own.column("words")]
                columns = [own.column("block"), own.column("share"), pa.array(stamps, pa.int64()), pa.array(rows, pa.binary()), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "share", "stamp", "sizes", "ids"])
            pa.default_memory_pool().release_unused()

    distinct = texts.mapInArrow(lambda b: _word_rows(b, block_bytes, parts), "block long, share int, words string")
    table = distinct.repartitionById(parts, F.col("share")).mapInArrow(encoded, "block long, share int, stamp long, sizes binary, ids binary")
    positions = texts.mapInArrow(lambda b: _position_rows(b, block_bytes, parts), "block long, doc_ids array<long>, n_words array<long>, n_distinct long, stamp long, codes binary")

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("share").combine_chunks()
        n_words = np.array(left.column("n_words")[0].as_py(), dtype=np.int64)
        sizes = np.concatenate([np.zeros(0, np.uint32), *map(_spread_out, right.column("sizes").to_pylist())])
        flat = np.concatenate([np.zeros(0, np.uint32), *map(_spread_out, right.column("ids").to_pylist())])
        if left.num_rows != 1 or len(sizes) != left.column("n_distinct")[0].as_py() or sum(right.column("stamp").to_pylist()) != left.column("stamp")[0].as_py():
            raise ValueError("a block's words and positions differ")
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
        codes = _spread_out(left.column("codes")[0].as_py()).astype(np.int64)
        ids, edges = words.spread(lists, codes, np.concatenate([[0], np.cumsum(n_words)]))
        body = pa.py_buffer(ids.astype("<u4").tobytes())
        packed = pa.Array.from_buffers(pa.large_binary(), len(n_words), [None, pa.py_buffer((4 * edges).astype(np.int64).tobytes()), body]).cast(pa.binary())
        doc_ids = left.column("doc_ids")[0].as_py()
        pa.default_memory_pool().release_unused()
        columns = [pa.array(doc_ids, pa.int64()), pa.array(np.diff(edges), pa.int64()), packed]
        return pa.table(columns + [_decoded(ids, edges, tokenizer)] * decode, names)

    names = ["doc_id", "n_tokens", "ids", *["decoded"] * decode]
    return positions.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(joined, "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode)


@functools.lru_cache(maxsize=4)
def _pieces(tokenizer: str) -> pa.Array:
    return pa.array([p + " " for p in words.vocabulary(tokenizer)], pa.large_string())


def _decoded(ids: np.ndarray, edges: np.ndarray, tokenizer: str) -> pa.Array:
    """Texts of the ids between edges: each id is joined with its piece."""
    out = []
    for a in range(0, len(edges) - 1, 1000):
        own = edges[a : a + 1001]
        taken = _pieces(tokenizer).take(pa.array(ids[own[0] : own[-1]].astype(np.int64)))
        places = np.asarray(pa.Array.from_buffers(pa.int64(), len(taken) + 1, [None, taken.buffers()[1]]))[own - own[0]]
        body = memoryview(taken.buffers()[2]) if len(taken) else b""
        out.append(pa.array([str(body[x : max(x, y - 1)], "utf-8") for x, y in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)], pa.string()))
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with ``decoded``: each id joined with its piece, the pieces with a blank between.

    This is how the tokenizers library decodes for a tokenizer that has no decoder.  No ids decode to the empty text.
    """
    def decoded(batches):
        for batch in batches:
            for own in shared.slices(batch, "ids"):
                raw = [x.as_buffer() for x in own.column("ids")]
                edges = np.concatenate([[0], np.cumsum([x.size // 4 for x in raw])]).astype(np.int64)
                texts = _decoded(np.frombuffer(b"".join(raw), dtype="<u4"), edges, tokenizer)
                yield pa.RecordBatch.from_arrays([*own.columns, texts], [*own.schema.names, "decoded"])
            pa.default_memory_pool().release_unused()

    from pyspark.sql import types as T

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(decoded, schema)
