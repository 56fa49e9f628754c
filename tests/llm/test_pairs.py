"""Operators 4, 6 and 7 against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysieve.llm import dart_minhash, oph, pivot_topk, queries, shared, shingles
from paysieve.llm.components import components


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    shared.prepare(spark)


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(sets(a) & sets(b)) / len(sets(a) | sets(b))


def prose(rng, n):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    texts = [prose(rng, rng.choice((3, 20, 80, 300))) for _ in range(60)]
    base = prose(rng, 200)
    texts += [edited(rng, base, s) for s in np.linspace(0, 0.06, 50)]  # a group that only its core holds together
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 60)} {passage} {prose(rng, 60)}" for _ in range(40)]  # a shared passage, otherwise unlike
    texts += [texts[0]] * 30 + ["", "", None, "   ", "one", "one", "One  ", "日本語 テスト", "x " * 3000]
    return texts


def classes(texts):
    n = len(texts)
    s = [sets(t) for t in texts]
    of = list(range(n))
    for i in range(n):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            near = s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j])
            if (same or near) and of[i] != of[j]:
                a, b = sorted((of[i], of[j]))
                of = [a if x == b else x for x in of]
    return of


@pytest.mark.parametrize("block, hot_rows, star_elements", [(1024, 1 << 20, 1 << 22), (8, 7, 900)])
def test_near_duplicates_are_the_brute_force_classes(spark, corpus, block, hot_rows, star_elements):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(corpus)], "doc_id long, text string, class_id string").repartition(5)
    found = dart_minhash.near_duplicates(docs, block=block, hot_rows=hot_rows, star_elements=star_elements).collect()
    assert {r.doc_id: r.class_id for r in found} == dict(enumerate(classes(corpus)))
    assert sorted(r.doc_id for r in found if r.keep) == sorted({r.class_id for r in found})
    kept = dart_minhash.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(classes(corpus)))


def test_near_duplicates_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert dart_minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = dart_minhash.near_duplicates(spark.createDataFrame([(None, "a b"), (4, "a b"), (4, "a b"), (None, "lone")], schema)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.keep) for r in rows if r.class_id == 4).count(("4", "4", True)) == 1
    assert sum(r.keep for r in rows) == 2
    assert dart_minhash.kept_documents(spark.createDataFrame([(4, "a b"), (4, "a b")], schema)).count() == 1


def test_dart_signatures_estimate_weighted_jaccard():
    rng, m, plain, weighted = np.random.default_rng(2), dart_minhash.DartMinHash(128), [], []
    for _ in range(120):
        n = int(rng.integers(3, 400))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        c = int(rng.integers(0, n + 1))
        b = np.concatenate([a[:c], rng.integers(0, 2**63, n - c).astype(np.uint64)])
        s = m.signatures(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        plain.append((s[0] == s[1]).mean() - c / (2 * n - c))
        x, y = rng.random(n) * 3, rng.random(n) * 3
        s = m.signatures(np.concatenate([a, a]), np.array([0, n, 2 * n]), np.concatenate([x, y]))
        weighted.append((s[0] == s[1]).mean() - np.minimum(x, y).sum() / np.maximum(x, y).sum())
    for e in (plain, weighted):
        assert abs(np.mean(e)) < 0.015 and np.std(e) < 0.06


def test_repeated_shingles_weigh_more_and_lose_no_link(spark):
    rng = random.Random(12)
    pairs = []
    for _ in range(60):  # one text of each pair says most of the other again and again: sets alike by 0.8 or more
        base = prose(rng, 120)
        pairs.append((base, " ".join([edited(rng, base, 0.01), *[base] * 4])))
    docs = [(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)]
    alike = [i for i, (a, b) in enumerate(pairs) if jaccard(a, b) >= 0.8]
    assert len(alike) > 40
    found = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [i for i in alike if found[2 * i] != found[2 * i + 1]] == []
    elements, starts, times = dart_minhash.distinct(np.array([5, 3, 5, 5, 9, 9], np.uint64), np.array([0, 4, 4, 6]))
    assert elements.tolist() == [3, 5, 9] and starts.tolist() == [0, 2, 2, 3] and times.tolist() == [1, 3, 2]
    assert np.allclose(dart_minhash.weights_of(times, 0.25), [1, 1 + 0.5 / 3, 1.125]) and dart_minhash.weights_of(times[:1], 0.25) is None


def test_signatures_of_tiny_weights_do_not_agree():
    m = dart_minhash.DartMinHash(128)
    one = np.array([11, 12, 13], dtype=np.uint64)
    s = m.signatures(np.concatenate([one, one + np.uint64(50), one]), np.array([0, 3, 6, 9]), np.full(9, 1e-7))
    assert (s[0] == s[2]).all() and (s[0] == s[1]).mean() < 0.05


@pytest.mark.parametrize("hot_rows", [1 << 20, 10])
def test_components(spark, hot_rows):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 202), (202, 200)] + [(300, 300 + rng.randrange(1, 40)) for _ in range(50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), hot_rows=hot_rows).collect()}
    assert {found[i] for i in range(61)} == {0} and found[202] == 200 and 100 not in found
    assert {v for k, v in found.items() if k >= 300} == {300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_keys_are_joined_in_several_tasks(spark):
    many = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 0), (3, 1), (None, 2)], "key int, node int")
    few = spark.createDataFrame([(1, 500, "a"), (2, 1, "b"), (4, 0, "d")], "key int, rows long, name string")
    joined = shared.joined_by_key(many, few, "key", "node", most=50)
    rows = joined.withColumn("task", F.spark_partition_id()).collect()
    assert joined.columns == ["key", "node", "name"]
    assert sorted((r.key, r.node, r.name) for r in rows) == [(1, i, "a") for i in range(500)] + [(2, 0, "b")]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_share" in plan and plan.count("Join") == 2


def test_fingerprints_of_edits(spark, corpus):
    docs = spark.createDataFrame([(i * 2, t, 0.5) for i, t in enumerate(corpus)], "doc_id long, text string, near_next double").repartition(6)
    rows = sorted(oph.fingerprint_edits(docs).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [2 * i for i in range(len(corpus))]
    errors = []
    for i, r in enumerate(rows):
        own, following = corpus[i] or "", corpus[(i + 1) % len(corpus)] or ""
        cut = len(own) // 2
        assert r.n_chars == len(own) and r.edited == own[: len(own) - cut] + following[:cut]
        for got, other in ((r.near_edited, r.edited), (r.near_next, following)):
            errors.append(got - (jaccard(own, other) if sets(own) | sets(other) else 1.0))
    assert np.abs(errors).max() < 0.16 and abs(np.mean(errors)) < 0.02
    by_text = {}
    for i, r in enumerate(rows):
        by_text.setdefault(corpus[i] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_fingerprints_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert oph.fingerprint_edits(spark.createDataFrame([], schema)).count() == 0
    one = oph.fingerprint_edits(spark.createDataFrame([(3, "ab cd")], schema)).first()
    assert (one.edited, one.near_next) == ("ab ab", 1.0)
    rows = oph.fingerprint_edits(spark.createDataFrame([(None, "x"), (None, None), (3, "b"), (3, "a")], schema)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in rows) == [("3", 1), ("3", 1), ("None", 0), ("None", 1)]


def test_shingles_do_not_depend_on_the_batch(corpus):
    import pyarrow as pa

    h, starts = shingles.shingles(pa.array(corpus))
    for i in (0, 5, 61, 110, len(corpus) - 1):
        own, edges = shingles.shingles(pa.array([corpus[i]]))
        assert own.tolist() == h[starts[i] : starts[i + 1]].tolist() and len(set(own.tolist())) == len(sets(corpus[i]))


def brute(rows, ask, k=5):
    out = set()
    q = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows}
    for i in {i for i in q if ask(i)}:
        scores = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=False)), j) for j in q if j != i)
        out |= {(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("kind", ["clusters", "ties", "few", "zeros"])
def test_top_k(spark, kind):
    rng = np.random.default_rng(4)
    n = 3 if kind == "few" else 400
    v = rng.normal(size=(n, 8)) * 0.3 + rng.integers(0, 3, (n, 1))
    if kind == "ties":
        v = np.round(v)
        v[: n // 3] = v[0]
    if kind == "zeros":
        v[::10] = 0
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v.astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = pivot_topk.top_k(df, F.col("vec_id") % 10 == 0, pivots=6, block_bytes=512, tile=8, annuli=4, annulus_rows=8)
    assert {tuple(r) for r in got.collect()} == brute(rows, lambda i: i % 10 == 0)


def test_top_k_leaves_out_bad_vectors(spark):
    bad = [(50, None), (1, [1.0, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    rows = [(0, [1.0, 2.0]), (100, [0.5]), (7, [1.0, 1.0])]
    got = {tuple(r) for r in pivot_topk.top_k(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()}
    assert got == {(0, 1, 7, 196608), (0, 2, 100, 32768), (100, 1, 0, 32768), (100, 2, 7, 32768)}
    assert pivot_topk.top_k(spark.createDataFrame(bad, "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_top_k_of_rows_that_repeat_an_id(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [3.0]), (5, [2.0]), (5, [2.0])], "vec_id long, embedding array<float>")
    unit = 256 * 256
    want = [(0, 1, 0, 3), (0, 1, 5, 6), (0, 2, 5, 2), (0, 2, 5, 6), (0, 3, 0, 3), (0, 3, 5, 2)]
    assert sorted(tuple(r) for r in pivot_topk.top_k(df, F.col("vec_id") == 0).collect()) == [(*r[:3], r[3] * unit) for r in want]


def test_the_bound_rules_out_most_annuli_of_clustered_vectors(spark, caplog):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 8)) * 4
    rows = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=8) * 0.02]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with caplog.at_level("INFO", logger=pivot_topk.__name__):
        got = pivot_topk.top_k(df, F.col("vec_id") % 200 == 0, pivots=40, tile=4, annulus_rows=8).collect()
    codes = np.array([[math.floor(256 * x) for x in v] for _, v in rows], dtype=np.int64)
    for q in range(0, 4000, 200):
        scores = codes @ codes[q]
        order = [i for i in np.lexsort((np.arange(4000), -scores)) if i != q][:5]
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [(i, scores[i]) for i in order]
    looked, of = caplog.records[-1].args
    assert looked < 0.5 * of


def test_sql_of_top_k(spark):
    from tests.compare import same_rows

    same_rows(queries.op7_pivot_topk(spark, "/root/testdata/sf0.001"), queries.ORACLE_SQL["op7_pivot_topk"], "/root/testdata/sf0.001")


@pytest.mark.parametrize(("scale", "most"), [(3e4, 0.0), (1e6, 0.0), (1e6, 8.5e6)])
def test_scores_of_large_components_are_exact(spark, scale, most):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5) * scale]) for i in range(60)] + [(61, [most, 0.0, 0.0, 0.0, 0.0])]
    codes = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    got = {tuple(r) for r in pivot_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, pivots=4, block_bytes=200, annulus_rows=4).collect()}
    want = set()
    for q in range(0, 60, 20):
        all_of = sorted((-sum(a * b for a, b in zip(codes[q], codes[i], strict=True)), i) for i in codes if i != q)
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(all_of[:5], 1)}
    assert got == want


def test_query_of_fingerprints_against_brute_force(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = dict(sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()))
    ids, errors = list(texts), []
    for r in queries.op4_oph_fingerprints(spark, sf).collect():
        own, following = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        cut = len(own) // 2
        changed = own[: len(own) - cut] + following[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(changed.encode()).hexdigest())
        errors += [r.near_edited - jaccard(own, changed), r.near_next - jaccard(own, following)]
    assert np.abs(errors).max() < 0.16 and abs(np.mean(errors)) < 0.02


def test_near_duplicates_of_the_given_documents_are_those_of_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    shingle = {i: sets(t) for i, t in texts.items()}
    holders, links = {}, {}
    for i, s in shingle.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in shingle.items():
        common = {}
        for x in s:
            for j in holders[x]:
                common[j] = common.get(j, 0) + 1
        links[i] = {j for j, n in common.items() if j != i and n >= 0.8 * (len(s) + len(shingle[j]) - n) - 1e-9}
    found = {r.doc_id: r.class_id for r in queries.op6_dart_minhash(spark, sf).collect()}
    pairs = [(i, j) for i, own in links.items() for j in own]
    assert len(pairs) > 50 and sum(found[i] == found[j] for i, j in pairs) >= 0.9 * len(pairs)
    root = dict.fromkeys(texts)
    for i in sorted(texts):
        stack = [i] if root[i] is None else []
        while stack:
            j = stack.pop()
            if root[j] is None:
                root[j] = i
                stack += links[j]
    # no class holds texts that no chain of links joins, but exact copies without words
    assert all(root[i] == root[c] or texts[i] == texts[c] for i, c in found.items())


def test_eight_bit_fingerprints_of_texts_are_not_taken_for_empty():
    import pyarrow as pa

    sketch = oph.OnePermutation(64, 8)
    rng = random.Random(4)
    texts = [prose(rng, 30) for _ in range(1500)]
    s = sketch.signatures(pa.array([*texts, ""]))
    assert (s[:-1, 0] == 255).any() and all(sketch.packed(s)[:-1]) and sketch.packed(s)[-1] == ""
    assert sketch.likeness(s[:-1], s[:-1]).min() == 1.0
