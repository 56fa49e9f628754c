"""Operators 1, 3, 8 and 9, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paysieve.llm import line_dedup, nnls_packing, queries, shared, toxicity, url_filter, warc_fixity
from tests.compare import same_rows

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    shared.prepare(spark)


@pytest.mark.parametrize("name", ["op1_warc_fixity", "op3_line_dedup", "op9_url_filter"])
def test_against_sql(spark, name):
    same_rows(queries.QUERIES[name](spark, DATA), queries.ORACLE_SQL[name], DATA)


def records(spark, rows):
    df = spark.createDataFrame(rows, "file long, id long, url string, body string")
    return warc_fixity.leaves(df.withColumn("record", warc_fixity.warc_record(F.col("id"), F.col("url"), F.col("body"))), file_col="file", id_col="id", record_col="record")


def test_audit_finds_each_kind_of_damage(spark):
    rows = [(f, 100 * f + i, "http://a/", f"body {i} " * 50) for f in range(5) for i in range(20)]
    other = [list(r) for r in rows]
    other[3][3] = "B" + other[3][3][1:]  # rot of the same length
    other[45][3] += "x"  # longer: what follows has moved
    del other[99]
    other.append([9, 1, "http://new/", None])
    found = warc_fixity.audit(records(spark, rows), records(spark, [tuple(r) for r in other]), span=2048, fan_out=4).collect()
    by = {}
    for r in found:
        by.setdefault(r.status, []).append((r.file, r.record_id))
    assert sorted(by["corrupt"]) == [(0, 3), (2, 205)] and by["missing"] == [(4, 419)] and by["extra"] == [(9, 1)]
    assert sorted(by["moved"]) == [(2, 200 + i) for i in range(6, 20)]


def test_audit_of_odd_tables(spark):
    rows = [(0, 1, None, None), (0, 1, None, "x"), (None, 5, "u", "y"), (None, None, "u", "z"), (0, 2, "a\r\nb", "é")]
    assert warc_fixity.audit(records(spark, rows), records(spark, rows)).count() == 0
    assert warc_fixity.audit(records(spark, []), records(spark, [])).count() == 0
    gone = warc_fixity.audit(records(spark, rows), records(spark, [])).collect()
    assert len(gone) == 5 and {r.status for r in gone} == {"missing"}
    assert {r.status for r in warc_fixity.audit(records(spark, []), records(spark, rows)).collect()} == {"extra"}


def test_records_without_a_file_meet_the_others_under_one_root(spark):
    rows = [(None if i % 2 else i // 10, i, "u", f"body {i}") for i in range(60)] + [(-5, 99, "u", "x"), (3, 100, "u", None)]
    df = spark.createDataFrame(rows, "file long, id long, url string, body string").withColumn("record", F.when(F.col("id") != 7, F.col("body")))
    of = lambda x: warc_fixity.leaves(x, file_col="file", id_col="id", record_col="record", unfiled=4)
    own, other = of(df), of(df.withColumn("record", F.when(F.col("id") == 7, "new").when(F.col("id") != 12, F.col("record"))))
    assert -4 <= own.agg(F.min("file")).first()[0] < -1
    levels = warc_fixity.depth([own, other], 64, 3)
    assert warc_fixity.tree(own, levels, span=64, fan_out=3)[-1].count() == 1
    found = {(r.record_id, r.status) for r in warc_fixity.audit(own, other, span=64, fan_out=3).collect() if r.status != "moved"}
    assert {(12, "corrupt")} <= found and {i for i, _ in found} == {7, 12}
    assert warc_fixity.audit(own, of(df.repartition(3))).count() == 0


def test_a_changed_record_changes_every_node_above_it_and_no_other(spark):
    rows = [(f, 10 * f + i, "u", "b" * 40) for f in range(9) for i in range(9)]
    a, b = records(spark, rows), records(spark, [(*r[:3], "c" * 40) if r[1] == 44 else r for r in rows])
    levels = warc_fixity.depth([a, b], 256, 3)
    for x, y in zip(*(warc_fixity.tree(t, levels, span=256, fan_out=3) for t in (a, b)), strict=True):
        assert x.exceptAll(y).count() == 1
    assert x.count() == 1


def test_warc_record_length(spark):
    text = spark.range(1).select(warc_fixity.warc_record(F.lit(7), F.lit("http://x/"), F.lit("é"))).first()[0]
    assert "Content-Length: 2\r\n\r\né\r\n\r\n" in text and text.startswith("WARC/1.1\r\n")


def lines_of(spark, rows, **options):
    out = line_dedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, source string, text string, n_dropped string"), **options)
    return {r.doc_id: (r.clean_text, r.n_dropped) for r in out.collect()}


def test_boilerplate_is_relative_to_the_site(spark):
    rows = [(i, "a", f"menu\nown {i}\n\n menu ", "x") for i in range(10)] + [(10 + i, "b", "menu\nb" if i == 0 else f"b {i}", "x") for i in range(20)]
    got = lines_of(spark, rows, ratio=0.5, min_pages=5)
    assert got[3] == ("own 3\n", 2) and got[10] == ("menu\nb", 0) and got[12] == ("b 2", 0)


def test_boilerplate_edges(spark):
    rows = [(i, None if i % 2 else "", "all", "x") for i in range(6)] + [(6, "", None, "x"), (7, "c", "only", "x"), (8, "c", "", "x")]
    got = lines_of(spark, rows, ratio=0.1, min_pages=5)
    assert got[0] == got[1] == ("", 1) and got[6] == (None, 0) and got[7] == ("only", 0) and got[8] == ("", 0)
    assert lines_of(spark, [(1, "s", "at\nthe ratio", "x")] * 5 + [(2, "s", "other", "x")] * 5, ratio=0.5, min_pages=5)[1] == ("at\nthe ratio", 0)
    assert lines_of(spark, []) == {}


def test_line_dedup_of_long_repeated_and_clashing_rows(spark):
    many = "\n".join(f"line {i}" for i in range(20_000))
    rows = [(i, "s", many + f"\nown {i}", "h", "l") for i in (1, 1, 2)] + [(9, "t", "x" * 1_000_000, "h", "l")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, host string, known string")
    out = line_dedup.drop_boilerplate(df, ratio=0.9, min_pages=3)
    assert out.columns == [*df.columns, "clean_text", "n_dropped"]
    assert sorted((r.doc_id, r.clean_text[:7], r.n_dropped, r.host, r.known) for r in out.collect()) == [(1, "own 1", 20_000, "h", "l")] * 2 + [(2, "own 2", 20_000, "h", "l"), (9, "x" * 7, 0, "h", "l")]


def test_line_dedup_against_sql_where_lines_are_dropped(spark):
    sf = "/root/testdata/sf0.01"
    same_rows(queries.op3_line_dedup(spark, sf), queries.ORACLE_SQL["op3_line_dedup"], sf)
    assert queries.op3_line_dedup(spark, sf).where("n_dropped > 0").count() == 140


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "Example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "b.org", "/f"), ("allow", "b.org", "/f")]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://example.net/en/x", ("example.net", "/en/x", "example.net/en/", "allow")),
        ("https://A.Example.NET/de/?q#f", ("a.example.net", "/de/", "net/", "block")),
        ("http://net", ("net", "", None, "allow")),
        ("http://xnet/", ("xnet", "/", None, "allow")),
        ("ftp://www.example.com/de/a?x=/fr/", ("www.example.com", "/de/a", "example.com/de/", "block")),
        ("http://notexample.com/de/", ("notexample.com", "/de/", None, "allow")),
        ("http://example.net?x/en/", ("example.net", "", None, "allow")),
        ("http://Ü.org/fr/#a", ("Ü.org", "/fr/", "org/fr/", "allow")),
        ("http://b.org/fr/", ("b.org", "/fr/", "b.org/f", "allow")),
        ("http://b.org/fx", ("b.org", "/fx", "b.org/f", "allow")),
        ("http://a.net:80/", ("a.net:80", "/", None, "allow")),
        ("x://http://a.net/", ("http:", "//a.net/", None, "allow")),
        ("no scheme", ("", "", None, "allow")),
        ("://", ("", "", None, "allow")),
        (None, ("", "", None, "allow")),
    ],
)
def test_url_rules(spark, url, want):
    df = spark.createDataFrame([(1, url, "clash")], "page_id long, url string, host string")
    assert tuple(url_filter.judge_urls(df, RULES).first())[1:] == want


def test_long_urls_repeated_rows_and_clashing_names(spark):
    long = "." * 1_000_000
    rows = [(1, f"http://{long}.example.net/en/" + "x" * 100_000, "a", 1)] * 2 + [(2, "http://" + "a.b" * 300_000 + ".com/", "b", 2), (3, "://" * 100_000, None, 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict int")
    got = sorted(url_filter.judge_urls(df, RULES, keep=("page_id", "host", "verdict")).select("page_id", F.length("host"), "rule", "verdict").collect())
    assert [tuple(r) for r in got] == [(1, 1_000_012, "example.net/en/", "allow")] * 2 + [(2, 900_004, None, "allow"), (3, 1, None, "allow")]


def test_no_urls_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filter.judge_urls(df, [], default="block").first().verdict == "block"
    assert url_filter.judge_urls(df.limit(0), RULES).count() == 0


def test_a_digest_hit_counts_only_for_the_same_string(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: len(s) % 3)
    url_filter.DigestArray.write(str(tmp_path / "r"), [("block", f"h{i}.com", "/") for i in range(50)])
    array = url_filter.DigestArray(str(tmp_path / "r"))
    assert (array.find([b"h7.com/", b"nope.com/", b"h49.com/"]) >= 0).tolist() == [True, False, True]


TOXIC = ("slimeball", "ratface", "gutterbrain")


def labelled(rng, n):
    out = []
    for i in range(n):
        words = [f"{a}{b}" for a, b in zip(rng.choice(["tor", "mal", "ven", "lio", "pra"], 60), rng.choice(["ane", "ist", "ulo", "ber", "dok"], 60), strict=True)]
        if i % 8 == 0:
            for w in rng.choice(TOXIC, 2):
                words[int(rng.integers(60))] = str(w) + str(rng.choice(["", "ly", "ed"]))
        out.append((i, " ".join(words), int(i % 8 == 0)))
    return out


@pytest.fixture(scope="module")
def lexicon(spark):
    return toxicity.learn(spark.createDataFrame(labelled(np.random.default_rng(1), 600), "doc_id long, text string, label int"))


def scores(spark, lexicon, *texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    return [(r.score, r.predicted) for r in toxicity.score_texts(df, lexicon).orderBy("doc_id").collect()]


def test_lexicon_finds_held_out_texts(spark, lexicon):
    assert all(any(t.startswith(w) or w.startswith(t) for t in TOXIC) for w in lexicon.weights) and len(lexicon.weights) >= 3
    rows = labelled(np.random.default_rng(2), 200)
    assert [p for _, p in scores(spark, lexicon, *(t for _, t, _ in rows))] == [y for *_, y in rows]


def test_disguises_boundaries_and_exceptions(spark, lexicon):
    plain = "tormaber venulo " * 10
    texts = ["you slimeball", "you 5L1M3B@LL", "you ｓｌіmеball", "you slime\u200bball", "you unslimeball", plain, "", None, plain + "slimeball"]
    assert [p for _, p in scores(spark, lexicon, *texts)] == [1, 1, 1, 1, 0, 0, 0, 0, 1]
    spared = toxicity.Lexicon(dict(lexicon.weights), ("slimeball soup",), lexicon.bias, lexicon.slope)
    assert [p for _, p in scores(spark, spared, "hot slimeball soup", "slimeball")] == [0, 1]
    got = scores(spark, lexicon, "slimeball " + "venulo " * 20, "slimeball " + "venulo " * 2000)
    assert got[0][0] > got[1][0]


def naive_density(lexicon, text):
    """The same score without an automaton: every word and phrase is looked for at every place of every reading."""
    def places(read, word):
        at = read.find(word)
        while at >= 0:
            if not (at and read[at - 1].isalpha()):
                yield at, at + len(word)
            at = read.find(word, at + 1)

    found, spared = {}, []
    for read in toxicity.readings(text):
        for word, weight in lexicon.weights.items():
            own = toxicity.fold(word).replace("l", "i")
            found |= {(*at, weight): weight for at in places(read, own)}
        spared += [at for phrase in lexicon.exceptions for at in places(read, toxicity.fold(phrase).replace("l", "i"))]
    total = sum(w for (a, b, _), w in found.items() if not any(x <= a and b <= y for x, y in spared))
    return np.log1p(1000 * total / (50 + len(toxicity.fold(text).split())))


def test_the_automaton_finds_what_a_naive_search_finds():
    rng = np.random.default_rng(6)
    parts = ["trash", "can", "clown", "fish", "tr4sh", "cl0wn", "loser", "1oser", "clo", "wn", "x", "é", "!", "l"]
    own = toxicity.Lexicon({"trash": 2.0, "clown": 3.0, "loser": 1.5, "closer": 0.5, "fis": 0.25})
    for _ in range(400):
        text = "".join(str(rng.choice(parts)) + str(rng.choice(["", " ", "."])) for _ in range(int(rng.integers(0, 30))))
        assert abs(own.density(text) - naive_density(own, text)) < 1e-9, text


def test_toxicity_of_long_repeated_and_clashing_rows(spark, lexicon):
    rows = [(1, "slimeball ratface", "a")] * 3 + [(2, "venulo " * 200_000, "b"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, words string, Score string").withColumn("text", F.lit("other"))
    out = toxicity.score_texts(df, lexicon, text_col="words")
    assert sorted(out.columns) == ["doc_id", "predicted", "score", "text", "words"]
    assert sorted((r.doc_id, r.predicted) for r in out.collect()) == [(1, 1)] * 3 + [(2, 0), (3, 0)]


def test_each_sign_is_read_as_any_letter_it_stands_for():
    own = toxicity.Lexicon({"loser": 3.0, "idiot": 3.0, "worthless": 3.0, "débile": 3.0, "gangster": 3.0, "bigmouth": 3.0, "zombie": 3.0})
    for text in ("1oser", "!oser loser", "id!ot", "id|ot", "worth1ess", "wor\u0301thless", "wórthless", "z\u0335alg, lo\u0335ser", "débile", "de\u0301bile", "débi1e", "débil\u0301e", "gan9ster", "6igmouth", "bi6mouth", "2ombie", "𝐋oser", "2 idiots", "2idiots", "idiot!loser", "say!idiot"):
        assert own.density(text) > 0, text
    for text in ("closer", "id!iot", "1 !", "269", "unzombie"):
        assert own.density(text) == 0, text


def test_learned_words_keep_a_spelling_and_match_decomposed_texts(spark):
    rows = [(i, f"slíme{'ba1l' if i % 16 else 'ball'} w{i}x a{i}b" if i % 8 == 0 else f"venulo w{i}x a{i}b", int(i % 8 == 0)) for i in range(800)]
    own = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert own.weights and all("slímeball".startswith(w) for w in own.weights)
    assert [own.density(t) > 0 for t in ("sli\u0301meball", "slímeball", "s1ímebaii", "venulo")] == [True, True, True, False]


def test_learning_from_one_label_or_none(spark):
    for rows in ([], [(1, "a b", 1)], [(1, "a b", 0), (2, None, 1), (3, "x", None)]):
        own = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int"))
        assert own.weights == {} and scores(spark, own, "a b")[0][1] == 0
    assert scores(spark, toxicity.Lexicon({})) == []


def test_held_out_accuracy_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op8_toxicity(spark, sf).where("held_out").join(truth, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    # some of these labels are wrong: 9 of the 144 toxic ones are on texts of plain syllables
    assert n.get((1, 1), 0) >= 0.92 * (n.get((1, 1), 0) + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.005 * n[0, 0]


def test_pipeline_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        out = shared.written(stage(spark, docs, DATA), f"test-{name}")
        assert out.columns == docs.columns and 0.6 * before <= out.count() <= before
        docs = out
    for r in docs.collect():
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (rows[r.doc_id].lang, rows[r.doc_id].source)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, DATA).exceptAll(packed).count() == 0


def test_pipeline_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0


def test_pipeline_against_a_composed_brute_force(spark):
    from tests.llm.test_pairs import classes
    from tests.llm.test_tokens import check_packing

    docs = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    lexicon = queries.trained_lexicon(spark, DATA, all_rows=True)
    texts = {i: r.text for i, r in sorted(docs.items()) if lexicon.score(naive_density(lexicon, r.text or "")) < 0.7}
    pages, having = {}, {}
    for i, t in texts.items():
        site = docs[i].source or ""
        pages[site] = pages.get(site, 0) + 1
        for line in {x.strip(" ") for x in (t or "").split("\n")} - {""}:
            having[site, line] = having.get((site, line), 0) + 1
    gone = {k for k, n in having.items() if n >= 2 and n / pages[k[0]] > queries.BOILERPLATE["ratio"]}
    texts = {i: t if t is None else "\n".join(x for x in t.split("\n") if (docs[i].source or "", x.strip(" ")) not in gone) for i, t in texts.items()}
    of = classes(list(texts.values()))
    kept = {i: t for n, (i, t) in enumerate(texts.items()) if of[n] == n}
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in rows} == set(kept)
    whole = nnls_packing.pack_documents(spark.createDataFrame(list(kept.items()), "doc_id long, text string"), queries.tokenizer_path(), 1).collect()
    check_packing(whole, kept)
    assert {(r.doc_id, r.doc_tokens) for r in rows} == {(r.doc_id, r.doc_tokens) for r in whole}
    assert sum(r.length for r in rows) == sum(r.length for r in whole)


def test_many_path_lengths_are_probed_a_few_strings_at_a_time(tmp_path):
    """80 lengths of rules' paths and 8000 urls: 2.6 million strings, of which 32,768 are there at once."""
    import tracemalloc

    path = str(tmp_path / "rules.bin")
    rules = [("block", "example.com", "/" + "a" * k) for k in range(80)]
    url_filter.DigestArray.write(path, rules)
    parts = [(f"w{i}.x.y.example.com", "/" + "a" * (i % 90) + "b" * 10) for i in range(8000)]
    tracemalloc.start()
    found = list(url_filter._verdicts(url_filter.DigestArray(path), parts, "allow"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
    for (_, p), (rule, verdict) in list(zip(parts, found, strict=True))[::97]:
        assert verdict == "block" and rule == "example.com" + p[: min(80, len(p.rstrip("b")))]


def test_a_rule_without_a_host_is_refused(spark):
    with pytest.raises(ValueError, match="no host"):
        url_filter.judge_urls(spark.createDataFrame([(1, "http://a/")], "page_id long, url string"), [("block", None, "/")])
