"""Operators 11 to 13."""

import hashlib
import itertools
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from paysieve.llm import collocations, cuts, periodic_runs, queries, secret_crf, shared
from tests.compare import same_rows

DATA = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (None, "a b"), (2, ""), (3, "é" * 300_000 + " x"), (3, " \t\r\n")]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    shared.prepare(spark)


def odd(spark, rows=ODD):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'und' as lang", "1 as n", "2 as block", "3 as spans", "4 as key")


def texts_of(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


def test_words_and_pieces():
    rng = random.Random(2)
    texts = [None, "", *("".join(rng.choice("ab .\t\n;é") for _ in range(rng.randrange(30))) for _ in range(200))]
    found = cuts.cut(pa.array(texts).slice(1), cuts.Signs.of(b" \t", b".;\n"))
    words, pieces = found.words.to_pylist(), found.pieces
    for i, text in enumerate(texts[1:]):
        own = slice(found.offsets[i], found.offsets[i + 1])
        want = [w.split() for w in text.replace(".", ";").replace("\n", ";").split(";")]
        assert words[own] == [w for p in want for w in p]
        assert [len(list(g)) for _, g in itertools.groupby(pieces[own])] == [len(p) for p in want if p]
    assert not set(pieces[found.offsets[5] : found.offsets[6]]) & set(pieces[found.offsets[6] : found.offsets[7]])


# --- 11


def naive_base(text):
    out = []
    for order, kind in enumerate(secret_crf.KINDS):
        for m in secret_crf.PATTERNS[kind].finditer(text):
            value = m.group(2) if kind == "assign" else m.group()
            if len(value) >= secret_crf.LEAST[kind]:
                out.append((m.start(), order, m.end()))
    return [f"{secret_crf.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_base_spans_are_the_patterns():
    rng = random.Random(4)
    parts = ["password", "Token", "api_key", "apikey", "secret", ":", "=", " ", '"', "AKIA", "ABC123", "abcdef0123456789", "é", "ſecret", "x", "=abc", "short", "\n", "AKIAAKIA" + "Z" * 14]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(500)]
    nothing = secret_crf.Model.empty()
    for text, spans in zip(texts, secret_crf._scanned(pa.array(texts), nothing, 8), strict=True):
        assert [f"{s.kind}:{s.start}:{s.end}" for s in spans] == naive_base(text)
    assert sum(len(naive_base(t)) for t in texts) > 200


def test_best_states_are_the_best():
    rng = np.random.default_rng(1)
    for _ in range(20):
        offsets = np.concatenate([[0], np.cumsum(rng.integers(0, 6, 5))])
        scores = rng.normal(size=(offsets[-1], 3))
        m = secret_crf.Model(np.zeros((0, 3)), np.zeros((4, 0, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
        got = secret_crf.best_states(scores, offsets, m, piece=4)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            of = lambda q: m.first[q[0]] + sum(scores[a + i, q[i]] for i in range(b - a)) + sum(m.pairs[q[i], q[i + 1]] for i in range(b - a - 1))  # noqa: B023, E731
            if b > a:
                assert tuple(got[a:b]) == max(itertools.product(range(3), repeat=int(b - a)), key=of)


def test_the_field_learns_what_makes_texts_likely():
    """After a few steps the states' likelihood, summed over all sequences by hand, is near one."""
    texts, places = ["key = zz9zz9", "no key here", "key = 1a1a1a now"], [[(6, 12)], [], [(6, 12)]]
    m = secret_crf.fitted(texts, places, rounds=60)
    t = secret_crf.tokens_of(pa.array(texts))
    u, want = secret_crf.unary(t, m), secret_crf.states_at(t, places)
    for a, b in zip(t.offsets[:-1], t.offsets[1:], strict=True):
        of = lambda q: np.exp(m.first[q[0]] + sum(u[a + i, q[i]] for i in range(b - a)) + sum(m.pairs[q[i], q[i + 1]] for i in range(b - a - 1)))  # noqa: B023, E731
        every = sum(of(q) for q in itertools.product(range(3), repeat=int(b - a)))
        assert of(tuple(want[a:b])) / every > 0.95


def test_held_out_secrets_and_clean_texts(spark):
    """Values of shapes that no pattern has, in texts that the field did not learn from."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = secret_crf.learn(docs.where("doc_id % 2 = 0"))
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    plain = [r.text for r in docs.where("doc_id % 2 = 1").collect() if r.text and not naive_base(r.text)][:300]
    texts, hidden = [], []
    for x in plain:
        at = x.find(" ", len(x) // 2) + 1
        value = "".join(rng.choice(letters) for _ in range(rng.randrange(24, 44)))
        texts.append(x[:at] + "pwd = " + value + " " + x[at:])
        hidden.append((at + 6, at + 6 + len(value)))
    found = secret_crf._scanned(pa.array(texts), m, 8)
    assert sum(h in [(s.start, s.end) for s in f] for h, f in zip(hidden, found, strict=True)) >= 0.9 * len(texts)
    clean = secret_crf._scanned(pa.array(plain), m, 8)
    assert sum(bool(f) for f in clean) <= 0.01 * len(plain)


def test_secrets_query_against_the_patterns(spark):
    got = {r.doc_id: r for r in queries.op11_secret_crf(spark, DATA).collect()}
    texts = texts_of(spark)
    assert len(got) == len(texts)
    for i, text in texts:
        base, r = naive_base(text or ""), got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b.startswith(k) for b in base) for k in secret_crf.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert [s for s in every if not s.startswith("crf")] == base


def test_secrets_of_odd_tables(spark):
    nothing = secret_crf.learn(odd(spark))
    rows = secret_crf.scan(odd(spark), nothing).collect()
    assert len(rows) == len(ODD) and all(r.spans == [] for r in rows)
    assert secret_crf.scan(odd(spark).limit(0), nothing).count() == 0
    text = "é " * 200_000 + 'token = "0123456789abcdef0123456789abcdef"'
    one = secret_crf.scan(odd(spark, [(1, text), (1, text)]), nothing).collect()
    assert one[0] == one[1] and [(s.kind, s.start, s.end, s.value) for s in one[0].spans] == [("assign", 400_000, 400_041, 400_009), ("hex", 400_009, 400_041, 400_009)]


# --- 12


def naive_runs(words):
    """All stretches with period d that cannot be extended; of those with one start and length the least period."""
    n, out = len(words), {}
    for d in range(1, n // 3 + 1):
        i = d
        while i < n:
            first = i
            while i < n and words[i] == words[i - d]:
                i += 1
            if i > first and i - first + d >= max(24, 3 * d):
                out.setdefault((first - d, i - first + d), d)
            i += 1
    return sorted((a, b, d) for (a, b), d in out.items())


def naive_row(doc_id, text, planted=True):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    if planted and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = naive_runs(words)
    gone = {i for a, b, d in runs for i in range(a + d, a + b)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{a},{b},{d}\n" for a, b, d in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_against_all_diagonals():
    rng = random.Random(1)
    texts = []
    for _ in range(300):
        n, k = rng.choice([0, 1, 5, 30, 80, 200, 400]), rng.choice([1, 2, 3, 50])
        words = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(3) if n else 0):
            a, p = rng.randrange(n), rng.randrange(1, 60)
            for i in range(a + p, min(n, a + rng.randrange(1, 200))):
                words[i] = words[i - p]
        texts.append(words)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = periodic_runs.runs_of(np.array([w for t in texts for w in t]), offsets)
    got = {i: [] for i in range(len(texts))}
    for i, *r in zip(*(x.tolist() for x in (found.text, found.start, found.length, found.period)), strict=True):
        got[i].append(tuple(r))
    assert sum(map(len, got.values())) > 50
    for i, words in enumerate(texts):
        assert got[i] == naive_runs(words)


def test_runs_query_against_brute_force(spark):
    got = sorted(tuple(r) for r in queries.op12_periodic_runs(spark, DATA).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    small = [(i, t) for i, t in texts_of(spark) if len(t or "") < 20_000]
    want = {i: naive_row(i, t) for i, t in small}
    assert sum(w[1] for w in want.values()) > 5
    assert [g for g in got if g[0] in want] == sorted(want.values()) and len(got) == len(texts_of(spark))


def test_runs_of_odd_tables(spark):
    rows = periodic_runs.find_runs(periodic_runs.with_planted_runs(odd(spark))).collect()
    assert sorted(r.n_words for r in rows) == [0, 0, 0, 0, 2, 2] and all(r.runs == [] for r in rows)
    assert periodic_runs.find_runs(odd(spark).limit(0)).count() == 0
    long = "a b " * 60_000 + "c " * 24 + "\n"
    found = periodic_runs.find_runs(odd(spark, [(1, long), (1, long), (None, "x " * 23)])).collect()
    assert [tuple(x) for x in found[0].runs] == [(0, 120_000, 2), (120_000, 24, 1)] and found[0].collapsed == "a b c" and found[0] == found[1]
    assert found[2].runs == [] and found[2].collapsed == " ".join("x" * 23)


def test_the_strongest_run_breaks_ties_by_start(spark):
    df = spark.createDataFrame([([(0, 24, 1), (50, 48, 2), (90, 49, 2)],), ([],)], "runs array<struct<start: long, length: long, period: long>>")
    from pyspark.sql import functions as F

    assert [r[0] and tuple(r[0]) for r in df.select(periodic_runs.strongest(F.col("runs"))).collect()] == [(90, 49, 2), None]


# --- 13


def test_pairs_are_counted_in_dense_and_sparse_tiles():
    rng = np.random.default_rng(3)
    first = np.concatenate([rng.integers(0, 40, 40_000), rng.integers(0, 100_000, 3000), np.full(9000, 300)])
    second = np.concatenate([rng.integers(0, 40, 40_000), rng.integers(0, 100_000, 3000), np.full(9000, 77_000)])
    keys, counts = collocations.counted_pairs(first, second)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == Counter((first * (1 << 31) + second).tolist()) and len(set(keys.tolist())) == len(keys)
    assert len(collocations.counted_pairs(first[:0], second[:0])[0]) == 0


@pytest.mark.parametrize("block_bytes", [8 << 20, 20_000])
def test_collocations_against_sql(spark, block_bytes):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    same_rows(collocations.collocations(docs, least=10, most=300, block_bytes=block_bytes), collocations.SQL.format(least=10, most=300), DATA)


@pytest.mark.parametrize("numbers", [[], [-1], [0, 5, -1, 2**31 - 2, 70000]])
def test_numbers_of_a_block_are_stored_whole(numbers):
    whole = np.array(numbers, dtype=np.int64)
    assert collocations._spread_out(collocations._squeezed(whole), len(whole)).tolist() == numbers


def test_ids_of_pairs():
    ids = np.array([4, 7, -1, 4, 7, 9, 4, 4], dtype=np.int64)
    keys = np.array([7 << 31 | 9, 4 << 31 | 7, 4 << 31 | 5], dtype=np.int64)
    assert collocations._ids_of_pairs(ids, keys, np.array([20, 10, 30])).tolist() == [10, -1, 10, 20, -1]
    assert collocations._ids_of_pairs(ids, keys[:0], keys[:0]).tolist() == [-1]
    assert collocations._ids_of_pairs(ids[:0], keys, keys).tolist() == []


def test_collocations_by_hand(spark):
    rows = [(i, t) for i, t in enumerate(["New York City! new york", "NEW YORK CITY; x new york city", "new  york\tcity.", None, ""] * 3)]
    found = {r.phrase: r for r in collocations.collocations(odd(spark, rows), least=3).collect()}
    # "york city" is in "new york city" as often, and "new york" in 12 of its 15, just 80 %
    assert set(found) == {"x new york city", "new york city"} and found["x new york city"].score == 400_000
    r = found["new york city"]
    assert (r.lang, r.rank, r.a, r.l, r.r, r.n, r.score) == ("und", 1, 12, 15, 12, 45, 888888)


def test_collocations_of_odd_tables(spark):
    assert collocations.collocations(odd(spark), least=1).count() == 2  # "a b", and the long word with "x"
    assert collocations.collocations(odd(spark).limit(0), least=1).count() == 0
    assert collocations.collocations(odd(spark).selectExpr("doc_id", "text", "cast(null as string) as lang"), least=1).select("lang").distinct().collect()[0].lang == "und"


def test_tables_can_be_cleared(spark):
    from pathlib import Path

    shared.clear(spark)
    made = shared.written(spark.range(3), "x")
    folder = Path(made.inputFiles()[0].removeprefix("file://")).parent
    assert made.count() == 3 and shared.clear(spark) == 1 and not folder.exists()
