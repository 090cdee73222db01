"""Ranked search, collocations and the quality classifier, against brute force."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from unmask.llm import collocations, factorization, lexical
from unmask.llm.split import Bitmap, Words, split_words
from unmask.llm.split import byte_table as table_of

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def ascii_lower(text):
    return (text or "").translate(LOWER)


# Ranked search


def brute_rank(docs, items, k=10):
    terms = lambda t: re.findall(lexical.TERM, ascii_lower(t))
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    total = sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = collections.Counter()
    for item, text in items:
        asked = collections.Counter(terms(text))
        scored = []
        for at, (doc_id, bag) in enumerate(bags):
            m = 25 + 75 * sum(bag.values()) * n_docs // max(total, 1)
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t, times in asked.items()
                if t in bag
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, at))
        for rank, (score, missing, doc_id, _) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, None if missing else doc_id, -score] += 1
    return out


def prose(rng, n):
    """Words of very different frequency."""
    return " ".join(f"w{min(int(rng.paretovariate(0.5)), 400)}" for _ in range(n))


@pytest.mark.parametrize(("short", "chars"), [(100, 4_000_000), (4, 3_000), (1, 3_000), (10**9, 500)])
def test_ranked_search_is_exact(spark, messy, messy_rows, short, chars):
    rng = random.Random(short)
    rows = [(1000 + i, prose(rng, rng.choice([3, 30, 200]))) for i in range(300)]
    # A third of the rows is one text, and an id stands at two texts.
    rows += [(5000 + i, rows[0][1]) for i in range(150)] + [(1000, "w1 W2 ünï-w3")]
    docs = messy.select("doc_id", "text", "rank" if "rank" in messy.columns else F.lit(1).alias("rank"), F.lit("x").alias("slice"))
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit(1), "slice": F.lit("x")}))
    items = [(i, prose(rng, rng.choice([1, 5, 40]))) for i in range(12)]
    items += [(3, rows[0][1]), (50, None), (51, ""), (52, "?!"), (None, "w1 w1 The OLD"), (53, "日本語 Σίσυφος"), (53, "nowhere")]
    asked = spark.createDataFrame([(*x, "y", 7) for x in items], "item_id long, text string, term string, item int")
    got = lexical.search(docs.repartition(3), asked, short=short, chars=chars, items_per_group=5)
    want = brute_rank([(r[0], r[1]) for r in messy_rows] + rows, items)
    assert collections.Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == want


def test_ranked_search_of_nothing(spark, empty):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(empty, items).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.filter("doc_id = 2"), items).count() == 0


def test_rows_below_the_least_score_are_only_probed():
    rows = np.arange(5_000)
    weak, strong = (rows, np.ones(5_000, dtype=np.int64), 1, 1), (np.array([7, 4_000]), np.array([50, 60]), 1, 60)
    top, score = lexical.best_rows([weak, strong], 2, 40, rows)
    assert (top.tolist(), score.tolist()) == ([4_000, 7], [61, 51])
    assert lexical.best_rows([weak], 2, 40, rows)[0].size == 0


# Collocations


def brute_collocations(rows, least, best):
    f, sizes = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        sizes[lang] += 0
        for piece in re.split(collocations.PIECE_END, ascii_lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    frequent = {x: n for x, n in f.items() if n >= least}
    out = set()
    for lang in sizes:
        kept = []
        for (own, p), a in frequent.items():
            if own != lang or len(p) < 2:
                continue
            longer = (n for (o, q), n in frequent.items() if o == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * n >= 80 * a for n in longer):
                continue
            cuts = [(2_000_000 * a // (f[lang, p[:c]] + f[lang, p[c:]]), c) for c in range(1, len(p))]
            score, c = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[lang, p[:c]], f[lang, p[c:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:best], 1):  # noqa: E741
            out.add((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return out


@pytest.mark.parametrize(("least", "best"), [(3, 2_000), (10, 7)])
def test_collocations_are_exact(spark, messy, messy_rows, least, best, monkeypatch):
    monkeypatch.setattr(collocations, "CUTS_PER_SALT", 3)
    rng = random.Random(least)
    words = [f"w{i}" for i in range(9)] + ["Über", "THE", "tab\tbed", "x y"]
    rows = []
    for i in range(260):
        text = "".join(rng.choice(words) + rng.choice([" "] * 6 + ["  ", ". ", "\n", ";"]) for _ in range(rng.choice([0, 4, 30])))
        rows.append((text, rng.choice(["en", "en", "de", None, ""])))
    # A third of the rows is one text.
    rows += [("of the old stone road, the old stone road", "en")] * 130 + [("only here twice", "zz")] * 2
    docs = spark.createDataFrame([(*r, i, "x", 1) for i, r in enumerate(rows)], "text string, lang string, k int, shard string, need int")
    docs = docs.unionByName(messy.select("text", "lang", F.lit(1).alias("k"), "shard", F.lit(1).alias("need"))).repartition(4)
    got = collocations.collocations(docs, least, best)
    want = brute_collocations(rows + [(r[1], r[2]) for r in messy_rows], least, best)
    assert set(map(tuple, got.collect())) == want
    assert any(x[0] == "en" and x[5] > x[4] for x in want)


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("a b", "en")], "text string, lang string")).count() == 0


def tallied(*args):
    found = collections.defaultdict(collections.Counter)
    for batch in collocations.counted(*args):
        for r in batch.to_pylist():
            found[r["k"]][r["lang"], r["phrase"]] += r["n"]
    return {k: {x: n for x, n in c.items() if n} for k, c in found.items()}


def test_phrases_that_share_a_hash_are_told_apart(monkeypatch):
    texts, langs = ["a b c a b d", "b c; b c", "a b"], ["en", "en", "de"]
    everything = [Bitmap(np.full(1, 2**64 - 1, dtype=np.uint64))] * 3
    right = tallied(texts, langs, everything)
    assert right[0] == {("en", ""): 10, ("de", ""): 2}
    assert right[2] == {("en", "a b"): 2, ("en", "b c"): 3, ("en", "c a"): 1, ("en", "b d"): 1, ("de", "a b"): 1}
    monkeypatch.setattr(Words, "hashes", lambda self: np.zeros(len(self.names), dtype=np.uint64))
    assert tallied(texts, langs, everything) == right


def test_bitmap_keeps_its_own(spark):
    hashes = [x * 0x9E3779B97F4A7C15 % 2**64 for x in range(1, 400)]
    signed = [(h ^ 1 << 63) - (1 << 63) for h in hashes]
    found = Bitmap.of(spark.createDataFrame([(h,) for h in signed], "h long"), bits=16)
    assert found.has(np.array(hashes, dtype=np.uint64)).all()
    assert found.has(np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64)).mean() < 0.05
    assert not Bitmap.of(spark.createDataFrame([], "h long"), bits=16).has(np.array(hashes, dtype=np.uint64)).any()


# Quality classifier


def test_machine_counts_every_pair():
    rng = np.random.default_rng(3)
    machine = factorization.Machine(0.3, rng.normal(size=len(factorization.FIGURES) + 16), rng.normal(size=(len(factorization.FIGURES) + 16, 4)))
    texts = ["one two two three", "", None, "Four | five!! 6\nFour | five!! 6", "é " * 300]
    x = factorization.vectors(texts, 16)
    raw, _ = machine.parts(x)
    for i in range(len(texts)):
        full = np.concatenate([x.dense[i], np.zeros(16)])
        for d, b, v in zip(x.doc, x.bucket, x.value, strict=True):
            full[len(factorization.FIGURES) + b] += v * (d == i)
        pairs = sum(machine.v[a] @ machine.v[b] * full[a] * full[b] for a in range(len(full)) for b in range(a))
        assert raw[i] == pytest.approx(machine.w0 + machine.w @ full + pairs)
    again = factorization.Machine.unpacked(machine.packed())
    assert (again.score(x) == machine.score(x)).all()


def test_structure_figures():
    text = "Ab ab cd\ncd 12!\n\nAb ab cd é|#"
    words = split_words([text, None], table_of(b" \t\x0b\x0c\r", b"\n"))
    got = dict(zip(factorization.FIGURES, factorization.structure([text, None], words)[0].tolist(), strict=True))
    inside = len(text.encode()) - sum(map(text.count, " \n"))
    want = {
        "upper share": 2 / 16, "digits": 2 / inside, "marks a word": 0, "calls a word": 1 / 9, "bars a word": 1 / 9,
        "symbols a word": 1 / 9, "beyond ASCII": 2 / inside, "other characters": 0, "neighbours repeated": 3 / 9,
        "distinct words": 4 / 9, "lines repeated": 0, "words a line": 3 / 100, "characters a word": inside / 90,
        "logarithm of the length": math.log1p(len(text.encode())) / 12, "empty": 0,
    }
    assert got == pytest.approx(want)


def labelled(n, seed=5):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "the of and in to stone river".split() for b in ("", "ing", "er", "s")]
    docs, labels = [], []
    for i in range(n):
        parts = [rng.choice(words) for _ in range(rng.choice([5, 40, 200]))]
        bad = rng.random() < 0.25
        if bad:
            parts = rng.choice([[w.upper() + "!!" for w in parts], [w + " |" for w in parts], [parts[0]] * 40, [w + "$$$" for w in parts]])
        docs.append((i, " ".join(parts), "en", "s", 1))
        labels.append((i, int(not bad), 0))
    return docs, labels


def test_classifier_holds_out(spark, messy, empty):
    docs, labels = labelled(1200)
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score int")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    machine = factorization.train(table, marks, "quality", ~held, epochs=8)
    got = {r.doc_id: r.score for r in factorization.score(table, machine).collect()}
    out = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= factorization.THRESHOLD) == labels[i][1] for i in out]) > 0.95
    # Labels of held-out rows, languages and sources change nothing.
    turned = marks.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert factorization.train(table.withColumn("source", F.lit("t")).repartition(3), turned, "quality", ~held, epochs=8).packed() == machine.packed()
    odd = factorization.score(messy, machine)
    assert odd.columns == [*messy.columns, "score"] and odd.count() == messy.count()
    assert all(0 <= r.score <= 1 for r in odd.collect())
    assert len({r.score for r in odd.filter("doc_id = 12").collect()}) == 1
    assert factorization.score(empty, machine).count() == 0


def test_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (None, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    for marks in (none, none.union(spark.createDataFrame([(1, 1)], none.schema))):
        machine = factorization.train(docs, marks, "quality", F.lit(True))
        assert all(0 <= r.score <= 1 for r in factorization.score(docs, machine).collect())


def test_sample_is_bounded(spark):
    docs, labels = labelled(60)
    table = spark.createDataFrame([d[:2] for d in docs + docs], "doc_id long, text string")
    marks = spark.createDataFrame([x[:2] for x in labels], "doc_id long, quality int")
    chosen = factorization._chosen(table, marks, "quality", F.lit(True), 10)
    assert chosen.count() == 10 and chosen.select("doc_id").distinct().count() == 10
