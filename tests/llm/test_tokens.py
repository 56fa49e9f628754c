"""Operators 2, 5 and 10 against the tokenizers library, and exact round trips."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from paysieve.llm import bpe_table, nnls_packing, queries, shared, token_files, words

PATH = queries.tokenizer_path()
TEXTS = ["", None, "  \n ", "the of the", "It's DON'T. é É. 12,3 ... a.. b!?", "<|endoftext|> hi<|ENDOFTEXT|>", "İstanbul ǅ ﬁ. ß. 漢字。 テスト 😀!", "a\x1c b\x85 c\u00a0d\u3000e", "x" * 5000, "wörd. " * 3000, "the of the"]


@pytest.fixture(scope="module")
def docs(spark):
    shared.prepare(spark)
    rows = [(i * 3, t, "clash", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id int, text string, ids string, number int").repartition(3)


def ids_of(text):
    return words.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_encoder_gives_the_librarys_ids_also_when_its_dictionary_is_emptied():
    for most in (1 << 20, 30):
        encode = words.Encoder(PATH, most)
        for _ in range(2):
            ids, edges = encode(pa.array(TEXTS))
            assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)] == [ids_of(t) for t in TEXTS]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 20, 32])
def test_bits_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 20_001, dtype=np.uint64).astype(np.uint32)
    assert (token_files.unpack(token_files.pack(ids, bits), bits, len(ids)) == ids).all()
    own = token_files.Segment(memoryview(token_files.segment([5, None], np.array([20_000, 1]), ids, bits) + b"\n"))
    assert own.null.tolist() == [False, True] and own.end == own.end
    for start, count in ((0, 1), (4095, 2), (8192, 4096), (19_999, 2), (7, 0)):
        assert (own.range(start, count) == ids[start : start + count]).all()
    assert own.document(1).tolist() == ids[20_000:].tolist()
    assert len(own.packed) == (len(ids) * bits + 7) // 8


def test_vocabulary_bits():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]
    with pytest.raises(ValueError, match="more than 2 bits"):
        token_files.segment([1], np.array([1]), np.array([4], dtype=np.uint32), 2)


def test_token_files(spark, docs):
    path = shared.new_path(spark, "test")
    token_files.write_token_files(docs, path, PATH, 2, segment_ids=50, segments_per_file=2)
    read = token_files.read_token_files(spark, path)
    rows = {r.doc_id: r for r in token_files.token_index(read).collect()}
    start = 0
    for i, t in enumerate(TEXTS):
        own = [*ids_of(t), 2]
        assert tuple(rows[3 * i]) == (3 * i, start, len(own), crc(own))
        start += len(own)


def test_token_files_of_odd_tables(spark, docs):
    for rows, want in (([], 0), ([(None, "a"), (7, "b"), (7, "b"), (None, None)], 4)):
        path = shared.new_path(spark, "test")
        token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, 2)
        found = sorted(token_files.token_index(token_files.read_token_files(spark, path)).collect(), key=lambda r: r.start)
        assert len(found) == want and [r.doc_id for r in found] == [None, None, 7, 7][:want]


def check_packing(rows, docs):
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    for i, text in docs.items():
        own = sorted(of[i], key=lambda r: r.start)
        ids = np.array([*ids_of(text), 1], dtype="<u4")
        assert b"".join(r.ids for r in own) == ids.tobytes()
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert {r.doc_tokens for r in own} == {len(ids)}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in own) <= 2048
    return sequences


def test_packing(spark, docs):
    rows = nnls_packing.pack_documents(docs, PATH, 1).collect()
    check_packing(rows, {3 * i: t for i, t in enumerate(TEXTS)})


def test_packing_of_odd_tables(spark, docs):
    assert nnls_packing.pack_documents(docs.limit(0), PATH, 1).count() == 0
    rows = nnls_packing.pack_documents(spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string"), PATH, 1).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", 2), ("1", 2), ("None", 2)]


def test_lengths_that_do_not_fit_together_are_cut(spark, docs):
    own = spark.createDataFrame([(i, "the " * 1199) for i in range(300)], "doc_id long, text string")
    sequences = check_packing(nnls_packing.pack_documents(own, PATH, 1).collect(), {i: "the " * 1199 for i in range(300)})
    assert 300 * 1200 / (2048 * len(sequences)) > 0.9


def test_plan_uses_every_length_as_often_as_it_occurs():
    rng = np.random.default_rng(3)
    for counts in (np.zeros(65, int), np.bincount(rng.integers(1, 65, 3000), minlength=65), np.eye(65, dtype=int)[40] * 77, np.eye(65, dtype=int)[64] * 5):
        counts[0] = 0
        planned = nnls_packing.plan(counts)
        used = np.zeros(65, int)
        for combo, k in planned:
            assert sum(combo) <= 64 and k > 0
            for x in combo:
                used[x] += k
        assert (used == counts).all()
        place = nnls_packing.Placement(planned)
        length = np.repeat(np.arange(65), counts)
        number = np.concatenate([np.arange(c) for c in counts]).astype(int)
        sequence, slot = place(length, number)
        assert len(set(zip(sequence.tolist(), slot.tolist(), strict=True))) == len(length)
        assert np.bincount(sequence, weights=length, minlength=1).max(initial=0) <= 64


def test_nnls_solves_a_known_system():
    a = np.array([[1.0, 0, 1], [0, 1, 1], [1, 1, 0]])
    assert np.allclose(nnls_packing.nnls(a, a @ [2.0, 0.0, 3.0]), [2, 0, 3], atol=1e-6)
    assert (nnls_packing.nnls(a, np.array([-1.0, -1, -1])) == 0).all()


def test_distinct_word_table(spark, docs):
    for block in (64, 1 << 20):
        docs = shared.written(docs, "texts")
        own = bpe_table.encode_documents(docs, PATH, decode=True, block_bytes=block)
        found = own.collect()
        again = bpe_table.decode_documents(own.drop("decoded"), PATH)
        assert again.exceptAll(own).count() == 0
        rows = {r.doc_id: r for r in found}
        tok = words.tokenizer(PATH)
        for i, t in enumerate(TEXTS):
            ids = ids_of(t)
            r = rows[3 * i]
            assert (r.n_tokens, bytes(r.ids)) == (len(ids), np.array(ids, dtype="<u4").tobytes())
            assert r.decoded == tok.decode(ids, skip_special_tokens=False)


def test_distinct_word_table_of_odd_tables(spark, docs):
    assert bpe_table.encode_documents(docs.limit(0), PATH, decode=True).count() == 0
    rows = bpe_table.encode_documents(spark.createDataFrame([(None, "a"), (1, "b b"), (1, "b b"), (1, None)], "doc_id long, text string"), PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == [("1", 0), ("1", 2), ("1", 2), ("None", 1)]


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library(spark):
    """doc_id and ids of every given text, by the library alone."""
    return {r.doc_id: (r.text, ids_of(r.text)) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_query_of_token_files_against_the_library(spark, library):
    want, start = {}, 0
    for i in sorted(library):
        own = [*library[i][1], 2]
        want[i] = (i, start, len(own), crc(own))
        start += len(own)
    assert {r.doc_id: tuple(r)[:4] for r in queries.op2_token_files(spark, DATA).collect()} == want


def test_query_of_packing_against_the_library(spark, library):
    rows = queries.op5_nnls_packing(spark, DATA).collect()
    for i, (_, ids) in library.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = [*ids, 1]
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist() and sum(r.length for r in own) == len(ids)
        assert all(r.ids_crc32 == crc(ids[r.start : r.start + r.length]) and r.doc_tokens == len(ids) for r in own)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        assert [o for o, _ in sorted(own)] == np.cumsum([0, *(n for _, n in sorted(own))])[:-1].tolist() and sum(n for _, n in own) <= 2048
    assert sum(len(ids) + 1 for _, ids in library.values()) / (2048 * len(sequences)) > 0.97


def test_query_of_the_word_table_against_the_library(spark, library):
    tok = words.tokenizer(PATH)
    rows = queries.op10_bpe_table(spark, DATA).collect()
    assert len(rows) == len(library)
    for r in rows:
        ids = library[r.doc_id][1]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_tokenizers_that_do_not_fit_are_refused(spark, docs):
    other = queries.tokenizer_path("byte_bpe_50k.json")
    with pytest.raises(ValueError, match="not a lower-casing"):
        words.fitting(other)
    with pytest.raises(ValueError, match="not a lower-casing"):
        bpe_table.encode_documents(docs, other)
    with pytest.raises(ValueError, match="not a lower-casing"):
        nnls_packing.pack_documents(docs, other, 1)
    with pytest.raises(ValueError, match="not a lower-casing"):
        token_files.write_token_files(docs, shared.new_path(spark, "test"), other, 1)


def test_many_rows_of_one_id_are_cut_and_stay_in_order(spark):
    rows = [(7 if i % 3 else i, f"text {i} the") for i in range(600)] + [(None, f"n{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bounds = shared.ordered_bounds(docs, "doc_id", "text", 8)
    sizes = {r[0]: r[1] for r in docs.groupBy(bounds.bucket_of(docs.doc_id, docs.text)).count().collect()}
    assert len(sizes) >= 7 and max(sizes.values()) < 250
    path = shared.new_path(spark, "test")
    token_files.write_token_files(docs, path, PATH, 2, segment_ids=100)
    found = sorted(token_files.token_index(token_files.read_token_files(spark, path)).collect(), key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert keys == sorted(keys) and len(found) == 900
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()


def test_least_squares_that_stop_early_say_so():
    with pytest.warns(UserWarning, match="stopped"):
        nnls_packing.nnls(np.eye(5), np.arange(1.0, 6.0), rounds=2)
