"""Operator 2: token ids in fixed-width bit-packed files.

A file holds segments, one after the other; a segment holds whole documents::

    magic "BPK2" | u32 bits, u32 ids per block, u64 bucket, u64 number in the bucket, u64 documents, u64 ids, u64 blocks
    i64 doc_id[documents] | u8 doc_id is null[documents] | u64 ids before[documents + 1]
    u64 byte offset[blocks + 1] | packed ids | "\\n"

All numbers are little-endian.  Id k of a block has bits k * bits onwards of the block,
lowest bit first, so any block can be unpacked by numpy on its own, and any id range
through the block offsets.  Documents are in ascending doc_id order within a segment, and across segments by
their bucket and their number in it; names of files have no meaning.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysieve.llm import shared, words

MAGIC, HEAD, BLOCK = b"BPK2", struct.Struct("<4sIIQQQQQ"), 4096


def bits_for(vocabulary: int) -> int:
    """The least bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width bits of ids, lowest bit first, filled up to whole bytes."""
    if bits in (8, 16, 32):  # the same layout, without single bits
        return ids.astype(f"<u{bits // 8}").tobytes()
    place = np.arange(bits, dtype=np.uint32)
    out = []
    for at in range(0, len(ids), 1 << 16):  # a multiple of 8 ids, so whole bytes
        part = ids[at : at + (1 << 16)].astype(np.uint32)
        out.append(np.packbits(((part[:, None] >> place) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes | memoryview, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    out, place = np.empty(count, dtype=np.uint32), np.uint32(1) << np.arange(bits, dtype=np.uint32)
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, count, 1 << 16):
        n = min(1 << 16, count - at)
        part = raw[at * bits // 8 : at * bits // 8 + (n * bits + 7) // 8]
        flags = np.unpackbits(part, bitorder="little", count=n * bits).reshape(n, bits)
        out[at : at + n] = (flags * place).sum(axis=1, dtype=np.uint32)
    return out


def segment(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int, place: tuple[int, int] = (0, 0)) -> bytes:
    """A segment of whole documents, without the end of line; place: its bucket, and its number there."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = -(-len(ids) // BLOCK)
    packed = pack(ids, bits)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * np.uint64(BLOCK * bits // 8), np.uint64(len(packed)))
    return b"".join(
        (
            HEAD.pack(MAGIC, bits, BLOCK, *place, len(doc_ids), len(ids), blocks),
            np.array([0 if x is None else x for x in doc_ids], dtype="<i8").tobytes(),
            np.array([x is None for x in doc_ids], dtype="u1").tobytes(),
            np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes(),
            offsets.astype("<u8").tobytes(),
            packed,
        )
    )


class Segment:
    """A segment at a place of a buffer or memory map; ids are unpacked when asked for."""

    def __init__(self, data: memoryview, at: int = 0):
        magic, self.bits, self.block, self.bucket, self.number, documents, self.ids, blocks = HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a segment of packed ids")
        at += HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", documents, at)
        at += 8 * documents
        self.null = np.frombuffer(data, "u1", documents, at).astype(bool)
        at += documents
        self.before = np.frombuffer(data, "<u8", documents + 1, at).astype(np.int64)
        at += 8 * (documents + 1)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        at += 8 * (blocks + 1)
        self.packed = data[at : at + int(self.offsets[-1])]
        self.end = at + int(self.offsets[-1]) + 1

    def range(self, start: int, count: int) -> np.ndarray:
        """Ids start to start + count: only the blocks that hold them are unpacked."""
        if count <= 0:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // self.block, (start + count - 1) // self.block
        held = min(self.ids, (last + 1) * self.block) - first * self.block
        part = self.packed[self.offsets[first] : self.offsets[last + 1]]
        return unpack(part, self.bits, held)[start - first * self.block :][:count]

    def document(self, k: int) -> np.ndarray:
        return self.range(int(self.before[k]), int(self.before[k + 1] - self.before[k]))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text", segment_ids: int = 2_000_000, segments_per_file: int = 8) -> None:
    """Encode every text, append ``end_id`` and write packed files under ``path`` in ascending id order.

    A null text is empty: its only id is the end id.  A null doc_id sorts first and stays null;
    rows that repeat a doc_id are all written, next to each other, in the order of a hash of their texts, by which
    they are also dealt to several buckets where they are many.  An empty table writes no segment.  Texts of any length stay whole.  Other columns are not read.
    """
    bits = bits_for(max(len(words.vocabulary(words.fitting(tokenizer))), end_id + 1))
    parts = shared.partitions(docs.sparkSession)
    bounds = shared.ordered_bounds(docs, id_col, text_col, parts)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = words.encoder(tokenizer)
        bucket, written = TaskContext.get().partitionId(), 0
        names: list = []
        counts: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            nonlocal written
            row = segment(names, np.concatenate(counts), np.concatenate(held), bits, (bucket, written))
            written += 1
            for x in (names, counts, held):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["segment"])

        for batch in batches:
            for part in shared.slices(batch, "text", words.SLICE):
                ids, offsets = encode(part.column("text"))
                names += part.column("doc_id").to_pylist()
                counts.append(np.diff(offsets) + 1)
                held.append(np.insert(ids, offsets[1:], end_id))
                if sum(map(len, held)) >= segment_ids:
                    yield out()
        if names:
            yield out()

    placed = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .withColumn("_bucket", bounds.bucket_of(F.col("doc_id"), F.col("text")))
        .repartitionById(bounds.buckets, F.col("_bucket"))
        .sortWithinPartitions("doc_id", shared.text_order(F.col("text")), "text")
        .select("doc_id", "text")
    )
    rows = placed.mapInArrow(segments, "segment binary")
    # a string column carries bytes as they are, so the text writer commits binary lines
    rows.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", segments_per_file).option("compression", "none").text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, bucket and number (of the segment), place (in it), n_tokens and ids (u32, little-endian bytes) of every document in the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data, at = memoryview(content.as_buffer()), 0
                while at < len(data):
                    own = Segment(data, at)
                    at, n = own.end, len(own.doc_ids)
                    for i in range(0, n, 500):
                        j = min(n, i + 500)
                        ids = own.range(int(own.before[i]), int(own.before[j] - own.before[i])).astype("<u4")
                        edges = (4 * (own.before[i : j + 1] - own.before[i])).astype(np.int32)
                        packed = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(ids.tobytes())])
                        columns = [pa.array(own.doc_ids[i:j], mask=own.null[i:j]), pa.array(np.full(j - i, own.bucket)), pa.array(np.full(j - i, own.number)), pa.array(own.before[i:j]), pa.array(np.diff(own.before[i : j + 1])), packed]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "bucket", "number", "place", "n_tokens", "ids"])
            pa.default_memory_pool().release_unused()

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(documents, "doc_id long, bucket long, number long, place long, n_tokens long, ids binary")


def token_index(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of documents as read from files; start counts the ids of all segments before."""
    own = shared.written(read.select("doc_id", "bucket", "number", "place", "n_tokens", F.crc32("ids").alias("ids_crc32")), "token-index")
    of_segment = own.groupBy("bucket", "number").agg(F.sum("n_tokens").alias("n"))
    before = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    inner = of_segment.select("bucket", "number", F.coalesce(F.sum("n").over(before(Window.partitionBy("bucket").orderBy("number"))), F.lit(0)).alias("inner"))
    # a row a bucket, of which there are no more than shuffle partitions, whatever the input
    of_bucket = of_segment.groupBy("bucket").agg(F.sum("n").alias("n"))
    outer = of_bucket.select("bucket", F.coalesce(F.sum("n").over(before(Window.orderBy("bucket"))), F.lit(0)).alias("outer"))
    starts = inner.join(outer, "bucket").select("bucket", "number", (F.col("inner") + F.col("outer")).alias("before"))
    return own.join(starts, ["bucket", "number"]).select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
