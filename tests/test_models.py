"""Term weights, vectors and classifiers on small data."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from unmask.functions import text as tx
from unmask.operators import blocks, classify, semantic, text_match, weights


def test_unit_vectors_and_vocabulary(spark):
    df = spark.createDataFrame([(1, "red wine red"), (2, "White wine, dry"), (3, None), (4, "a")], "id int, text string")
    lengths = text_match.word_tfidf(df, "id", "text").groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert {r["id"] for r in lengths} == {1, 2} and all(abs(r["s"] - 1) < 1e-9 for r in lengths)
    counts = weights.term_counts(df, "id", tx.words_of_two(F.col("text")))
    kept = {r["term"] for r in weights.limit_vocabulary(counts, 3).collect()}
    assert kept == {"red", "wine", "dry"}
    assert weights.limit_vocabulary(counts, 4).select("term").distinct().count() == 4


def test_unmatched_names(spark):
    clean = spark.createDataFrame([("Acme Ltd",), ("Acme Ltd",), ("Zebra plc",)], "n string")
    messy = spark.createDataFrame([("ACME Limited",), ("ééé",), ("qqq",)], "n string")
    got = {r["original_name"]: (r["matched_name"], r["conf"]) for r in text_match.trigram_name_match(clean, "n", messy, "n").collect()}
    assert got["ACME Limited"] == ("Acme Ltd", -1.0)
    assert got["qqq"] == ("no match found", None) and got["ééé"] == ("no match found", None)


def test_cosine_many_equals_numpy(spark):
    rnd = np.random.default_rng(3)
    rows, queries = rnd.normal(size=(300, 8)), rnd.normal(size=(7, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id int, v array<double>").repartition(5)
    qs = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(queries)], "q string, v array<double>")
    got = semantic.cosine_top_k_many(df, "id", "v", qs, "q", "v", 4).collect()
    cos = (queries @ rows.T) / np.linalg.norm(queries, axis=1)[:, None] / np.linalg.norm(rows, axis=1)
    want = {(f"q{i}", n + 1): int(j) for i in range(7) for n, j in enumerate(np.argsort(-cos[i])[:4])}
    assert {(r["q"], r["rank"]): r["id"] for r in got} == want
    small = blocks.best_in_blocks(
        qs.select(F.col("q").alias("_q"), "v"), df.select(F.col("id").alias("_id"), "v"),
        lambda a, b: blocks.matrix(a["v"]) @ blocks.matrix(b["v"]).T, 4, 6, block=2,
    )
    dots = queries @ rows.T
    want = {(f"q{i}", n + 1): int(j) for i in range(7) for n, j in enumerate(np.argsort(-dots[i])[:4])}
    assert {(r["_q"], r["rank"]): r["_id"] for r in small.collect()} == want


def test_word_vectors_and_search(spark):
    rnd = random.Random(1)
    topics = [["cherry", "plum", "oak", "spice"], ["lemon", "lime", "crisp", "dry"]]
    docs = [(i, " ".join(rnd.choices(topics[i % 2], k=30))) for i in range(60)] + [(60, ""), (61, "once"), (62, None)]
    df = spark.createDataFrame(docs, "id int, text string")
    vectors = semantic.word_vectors(df, "id", "text", size=12, window=4)
    assert {r["term"] for r in vectors.collect()} == set(topics[0] + topics[1])
    near = semantic.similar_words(vectors, "plum", 3)
    assert {r["term"] for r in near.collect()} == {"cherry", "oak", "spice"}
    assert semantic.similar_words(vectors, "plum", 3, restrict_vocab=2).count() <= 2
    doc_vectors = semantic.document_vectors(df, "id", "text", vectors)
    assert doc_vectors.filter("id >= 60").count() == 0
    queries = spark.createDataFrame([(1, "cherry plum unknown"), (2, "unknown"), (3, "Lime lime dry")], "q int, text string")
    asked = semantic.query_vectors(queries, "q", "text", vectors)
    found = semantic.cosine_top_k_many(doc_vectors, "id", "vector", asked, "q", "vector", 5).collect()
    assert {r["q"] for r in found} == {1, 3}
    assert all(r["id"] % 2 == (r["q"] == 3) for r in found)


def test_ordinal_codes(spark):
    values = [f"v{i * 37 % 500:03}" for i in range(700)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(6)
    got = {r["value"]: r["code"] for r in classify.ordinal_codes(df, "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted({v for v in values if v}))}


def test_categorical_bayes_with_unseen_values(spark):
    train = spark.createDataFrame(
        [("a", "x", "p"), ("a", "x", None), ("b", "y", "p"), ("b", "y", "q"), ("b", "z", "q")], "c string, f string, g string"
    )
    test = spark.createDataFrame([(1, "x", "p"), (2, "new", None), (3, "z", "q")], "id int, f string, g string")
    got = {r["id"]: r["predicted"] for r in classify.categorical_bayes(train, test, "id", "c", ["f", "g"]).collect()}
    assert got[1] == "a" and got[3] == "b"
    # nothing known about the row: the class with the best score without any shared value
    scores = {"a": math.log(2 / 5) + math.log(1 / 5) + math.log(1 / 3), "b": math.log(3 / 5) + math.log(1 / 6) + math.log(1 / 5)}
    assert got[2] == max(scores, key=scores.get)


def test_split_is_stable(spark):
    df = spark.range(1000)
    a = classify.split_by_key(df, "id").filter("split = 'test'").count()
    b = classify.split_by_key(df.repartition(7), "id").filter("split = 'test'").count()
    assert a == b and 250 < a < 420


def test_boosting_tells_held_out_rows(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.random(), rnd.random(), rnd.random()) for i in range(900)]
    kind = F.when((F.col("x") > 0.5) & (F.col("y") > 0.4), "a").when(F.col("x") + F.col("y") < 0.6, "b").otherwise("c")
    df = classify.split_by_key(spark.createDataFrame(rows, "id long, x double, y double, z double").withColumn("kind", kind), "id")
    features = F.array("x", "y", "z")
    model = classify.boosted_model(df.filter("split = 'train'"), "kind", features, rounds=10)
    told = classify.predict(model, df.filter("split = 'test'"), "id", features, ["kind"])
    assert told.select(F.avg((F.col("kind") == F.col("predicted")).cast("double"))).first()[0] > 0.9


def test_unseen_words_are_near_their_pieces(spark):
    vectors = spark.createDataFrame(
        [("walking", 5, [1.0, 0.0, 0.0]), ("walked", 3, [0.9, 0.1, 0.0]), ("stone", 9, [0.0, 0.0, 1.0])], "term string, n long, vector array<double>"
    )
    words = spark.createDataFrame([("walker",), ("stones",), ("zz",), ("walker",)], "w string")
    got = {r["term"]: r["vector"] for r in semantic.spelled_vectors(words, "w", semantic.subword_vectors(vectors)).collect()}
    assert set(got) == {"walker", "stones"}
    assert got["stones"] == pytest.approx([0, 0, 1]) and got["walker"][0] > 0.8
    pieces = {r["piece"]: r["vector"] for r in semantic.subword_vectors(vectors).collect()}
    digest = lambda p: int(hashlib.md5(p.encode()).hexdigest()[:8], 16) % semantic.SUBWORD_PLACES
    assert pieces[digest("<wal")] == pytest.approx([(5 * 1 + 3 * 0.9) / 8, 3 * 0.1 / 8, 0])


def test_word_vectors_move_packed_pairs_once(spark, monkeypatch):
    """By either numbering and any chunks the vectors are those of plain counts; no table of pairs is written."""
    rnd, written = random.Random(8), []
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 60))) for _ in range(40)] + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(3)
    lists = [t.split() for t in texts if t]
    n = Counter(w for ws in lists for w in ws)
    lists = [[w for w in ws if n[w] >= semantic.MIN_COUNT] for ws in lists]
    both = Counter((x, y) for ws in lists for i, a in enumerate(ws) for b in ws[i + 1 : i + 11] for x, y in ((a, b), (b, a)))
    m = Counter()
    for (a, _), k in both.items():
        m[a] += k
    expected = {a: [0.0] * semantic.VECTOR_SIZE for a in m}
    for (a, b), k in both.items():
        h = int(hashlib.md5(b.encode()).hexdigest()[:8], 16)
        sign = 1.0 if h // semantic.VECTOR_SIZE % 2 == 0 else -1.0
        expected[a][h % semantic.VECTOR_SIZE] += sign * max(math.log(k * sum(m.values()) / (m[a] * m[b])), 0.0)
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (written.append(self._df.columns), write(self, *a, **k))[1])
    for settings in ({}, {"broadcast_words": 3, "chunk_words": 50}):
        got = {r["term"]: r for r in semantic.word_vectors(rows, "doc", "text", **settings).collect()}
        assert got.keys() == expected.keys()
        for term, row in got.items():
            assert row["n"] == n[term]
            assert row["vector"] == pytest.approx(expected[term], abs=1e-9)
    assert not any({"a", "b"} <= set(columns) for columns in written)


def test_document_vectors_meet_blocks_of_words(spark):
    """Any blocks and groups give the same means, and no row of a word is widened by its vector."""
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 40))) for _ in range(50)] + [None, "zzzz unknown"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(3)
    known = {c * k: [rnd.uniform(-1, 1) for _ in range(5)] for c in "abcdefgh" for k in (1, 2)}
    vectors = spark.createDataFrame(list(known.items()), "term string, vector array<double>")
    counts = weights.term_counts(rows, "doc", tx.ascii_words(F.col("text")))
    expected = {}
    for r in weights.bm25(counts).collect():
        if r["term"] in known:
            n, total = expected.get(r["id"], (0, np.zeros(5)))
            expected[r["id"]] = n + r["tf"], total + r["tf"] * r["weight"] * np.array(known[r["term"]])
    for settings in ({}, {"block": 3, "group_rows": 40}):
        out = semantic.document_vectors(rows, "doc", "text", vectors, **settings)
        assert "FlatMapCoGroupsInArrow" in out._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: r["vector"] for r in out.collect()}
        assert got.keys() == expected.keys()
        for doc, (n, total) in expected.items():
            assert got[doc] == pytest.approx((total / n).tolist(), abs=1e-9)


def test_own_weights_move_terms_twice_and_join_nothing(spark):
    rnd = random.Random(10)
    texts = [" ".join(rnd.choice(["red", "dry", "wine", "oak", "x1"]) for _ in range(rnd.randint(0, 30))) for _ in range(40)] + [None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = text_match.word_tfidf(rows, "id", "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # By document before its terms are listed, by term, by document.
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 3
    counts = text_match.word_counts(rows, "id", "text", 1, 3, None)
    joined = weights.unit_tfidf(counts, weights.smoothed_idf(counts, 40))
    by_key = lambda df: {(r["id"], r["term"]): r["weight"] for r in df.collect()}
    got, expected = by_key(out), by_key(joined)
    assert got == pytest.approx(expected, abs=1e-12) and len(got) > 1000


def test_shared_terms_are_numbered_where_they_meet(spark):
    """Weights of the terms both sides hold, by number, without a join or a table of all counts."""
    rnd = random.Random(11)
    words = ["red", "dry", "wine", "oak", "x1"]
    texts = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 9))), rnd.choice([True, False, None])) for i in range(60)]
    rows = spark.createDataFrame(texts, "id int, text string, masked boolean")
    grams = tx.word_ngrams(tx.words_of_two(F.col("text")), 1, 3)
    out = weights.shared_unit_tfidf(weights.term_counts(rows, "id", grams, ["masked"]), 60, "masked")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 3
    counts = text_match.word_counts(rows, "id", "text", 1, 3, None, ["masked"])
    idf = weights.smoothed_idf(counts, 60, F.count_if("masked").alias("n_masked"))
    joined = weights.unit_tfidf(counts, idf, (F.col("n_masked") > 0) & (F.col("n_masked") < F.col("df"))).collect()
    got: dict = {}
    for r in out.collect():
        got.setdefault(r["term"], {})[r["id"]] = r["weight"]
    want: dict = {}
    for r in joined:
        want.setdefault(r["term"], {})[r["id"]] = r["weight"]
    key = lambda held: sorted((i, round(w, 9)) for i, w in held.items())
    assert sorted(map(key, got.values())) == sorted(map(key, want.values())) and len(want) > 20
