"""Exact searches against brute force, with settings that force every path."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from unmask.operators import fuzzy, sparse, structural, text_match
from unmask.operators.exact import exact_text_match
from unmask.session import durable


def brute_structural(rows, numerics, nominals):
    out = {}
    for a in rows:
        if not a["mystery"]:
            continue
        best = None
        for b in rows:
            if b["mystery"]:
                continue
            d2 = sum(((a[c] or 0.0) - (b[c] or 0.0)) ** 2 for c in numerics)
            for c in nominals:
                d2 += 0 if a[c] == b[c] else 1 if a[c] is None or b[c] is None else 2
            best = min(best or (math.inf, ""), (round(math.sqrt(d2), 6), b["code"]))
        out[a["code"]] = best
    return out


@pytest.mark.parametrize("salt", [20_000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_structural_is_exact(spark, salt, seed):
    rnd = random.Random(seed)
    rows = [
        {
            "code": f"c{i:03}",
            # a third of all rows shares one price
            "price": 10.0 if rnd.random() < 0.34 else rnd.choice([None, round(rnd.uniform(0, 60), 1)]),
            "size": rnd.choice([None, 1.0, 2.0, 5.0]),
            "kind": rnd.choice([None, "a", "b", "c"]),
            "closure": rnd.choice([None, "cork", "screw"]),
            "mystery": rnd.random() < 0.3,
        }
        for i in range(220)
    ]
    df = spark.createDataFrame(rows, "code string, price double, size double, kind string, closure string, mystery boolean")
    df = df.repartition(3)
    got = structural.nearest_known(df, "code", "mystery", ["price", "size"], ["kind", "closure"], rows_per_salt=salt)
    want = brute_structural(rows, ["price", "size"], ["kind", "closure"])
    assert {r["stockcode_x"]: (r["distance"], r["stockcode_y"]) for r in got.collect()} == want
    good = structural.nearest_known(
        df, "code", "mystery", ["price", "size"], ["kind", "closure"], good_only=True, rows_per_salt=salt
    )
    assert {r["stockcode_x"] for r in good.collect()} == {k for k, v in want.items() if v[0] < 1.8}


@pytest.mark.parametrize("n_numerics", [0, 1, 3])
def test_structural_with_many_nominals(spark, n_numerics):
    """Of 24 nominals a close pair agrees in whole groups; a far mystery and one without company are found too."""
    rnd = random.Random(n_numerics)
    numerics, nominals = [f"x{i}" for i in range(n_numerics)], [f"a{i}" for i in range(24)]
    base = [{c: rnd.choice([None, "p", "q", "r"]) for c in nominals} for _ in range(12)]
    rows = []
    for i in range(240):
        row = dict(rnd.choice(base))
        for c in rnd.sample(nominals, rnd.choice([0, 1, 2, 3, 9])):
            row[c] = rnd.choice([None, "p", "s"])
        row |= {c: rnd.choice([-7.5, 0.0, 0.25, 3.0, None]) for c in numerics}
        rows.append({"code": f"c{i:03}", "mystery": rnd.random() < 0.3, **row})
    if numerics:
        rows[0] |= {"mystery": True, "x0": 1e6}
    schema = "code string, mystery boolean, " + ", ".join([f"{c} string" for c in nominals] + [f"{c} double" for c in numerics])
    df = spark.createDataFrame([[r[f.split()[0]] for f in schema.split(", ")] for r in rows], schema)
    got = structural.nearest_known(df, "code", "mystery", numerics, nominals)
    want = brute_structural(rows, numerics, nominals)
    assert {r["stockcode_x"]: (r["distance"], r["stockcode_y"]) for r in got.collect()} == want


def test_structural_candidates_are_few(spark):
    rnd = random.Random(8)
    rows = [(i, round(rnd.uniform(0, 1000), 1), float(rnd.randint(1, 40)), rnd.choice("abcde"), i % 5 == 0) for i in range(4000)]
    df = spark.createDataFrame(rows, "code long, price double, size double, kind string, mystery boolean")
    features = structural.Features(["price", "size"], ["kind"])
    sides = [features.profiles(df.filter(c), "code", []) for c in ("mystery", "not mystery")]
    n = structural.candidates(*sides, features).count()
    assert n < 0.01 * 800 * 3200
    empty = df.limit(0)
    assert structural.nearest_known(empty, "code", "mystery", ["price"], ["kind"]).count() == 0
    assert structural.nearest_known(df.filter("mystery"), "code", "mystery", ["price"], ["kind"]).count() == 0


def test_threshold_is_strict_and_ties_go_to_smallest_code(spark):
    rows = [("m", 0.0, True), ("z", 1.8, False), ("y", -1.8, False)]
    df = spark.createDataFrame(rows, "code string, price double, mystery boolean")
    got = structural.nearest_known(df, "code", "mystery", ["price"], []).first()
    assert (got["stockcode_y"], got["match_level"]) == ("y", "Poor")


def test_structure_with_text_over_many_cells(spark):
    rnd = random.Random(4)
    words = ["red", "dry", "oak", "plum", "rich", "soft", "cork", "vine"]
    rows = [
        (f"c{i:03}", float(rnd.randint(0, 20)), " ".join(rnd.choices(words, k=rnd.randint(0, 5))), rnd.random() < 0.3)
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "code string, price double, text string, mystery boolean")
    vectors = text_match.word_tfidf(df, "code", "text", 1, 2)
    by_code: dict = {}
    for r in vectors.collect():
        by_code.setdefault(r["id"], {})[r["term"]] = r["weight"]
    want = {}
    for a in (r for r in rows if r[3]):
        options = []
        for b in (r for r in rows if not r[3]):
            va, vb = by_code.get(a[0], {}), by_code.get(b[0], {})
            dot = sum(w * vb.get(t, 0.0) for t, w in va.items())
            d2 = max(0.0, (a[1] - b[1]) ** 2 + bool(va) + bool(vb) - 2 * dot)
            options.append((round(math.sqrt(d2), 6), b[0]))
        want[a[0]] = min(options)
    for salt in (20_000, 3):
        got = structural.nearest_known(df, "code", "mystery", ["price"], [], texts=[vectors], rows_per_salt=salt).collect()
        assert {r["stockcode_x"]: r["stockcode_y"] for r in got} == {k: v[1] for k, v in want.items()}
        assert all(abs(r["distance"] - want[r["stockcode_x"]][0]) < 2e-6 for r in got)


@pytest.mark.parametrize("good_only", [False, True])
def test_far_mysteries_meet_blocks_of_cells(spark, monkeypatch, good_only):
    """Where most of 24 nominals differ, cells are compared by blocks; ties, missing values and the limit hold."""
    monkeypatch.setattr(structural, "BLOCK", 9)
    monkeypatch.setattr(structural, "PAIRS", 20)
    rnd = random.Random(7)
    nominals = [f"a{i}" for i in range(24)]
    rows = [
        {"code": f"c{i:03}", "mystery": rnd.random() < 0.3, "x": rnd.choice([0.0, 0.1, 2.5, 40.0, None]), **{c: rnd.choice([None, "p", "q"]) for c in nominals}}
        for i in range(150)
    ]
    rows += [{**rows[3], "code": "d1", "mystery": True}, {**rows[3], "code": "d2", "mystery": False}, {**rows[3], "code": "d0", "mystery": False}]
    schema = "code string, mystery boolean, x double, " + ", ".join(f"{c} string" for c in nominals)
    df = spark.createDataFrame([[r[f.split()[0]] for f in schema.split(", ")] for r in rows], schema)
    got = structural.nearest_known(df, "code", "mystery", ["x"], nominals, good_only=good_only)
    want = {k: v for k, v in brute_structural(rows, ["x"], nominals).items() if not good_only or v[0] < 1.8}
    assert {r["stockcode_x"]: (r["distance"], r["stockcode_y"]) for r in got.collect()} == want and "d1" in want


def test_dense_rows_with_texts_meet_few_others(spark, monkeypatch):
    """The reach with texts shrinks as rows grow denser; as wide as two texts' lengths it meets 29 a mystery here."""
    counts, durable = {}, structural.durable

    def counted(df, label, *more):
        out = durable(df, label, *more)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(structural, "durable", counted)
    rnd = random.Random(1600)
    rows = [
        (f"c{i:04}", rnd.uniform(0, 16), rnd.uniform(0, 16), rnd.choice("ab"), " ".join(rnd.choices(["red", "dry", "oak"], k=2)), rnd.random() < 0.3)
        for i in range(1600)
    ]
    df = spark.createDataFrame(rows, "code string, price double, size double, kind string, text string, mystery boolean")
    found = text_match.nearest_with_text(df, "code", "mystery", ["price", "size"], ["kind"], "text").count()
    assert found == sum(r[-1] for r in rows)
    assert counts["structural-pairs"] < 12 * found


def vectors_of(rnd, n, prefix):
    rows = []
    for i in range(n):
        # "the" and "of" are in most documents, and heavy in some
        terms = {t: rnd.uniform(0.1, 3) for t in ("the", "of") if rnd.random() < 0.7}
        terms |= {f"w{rnd.randint(0, 60)}": rnd.uniform(0.5, 2) for _ in range(rnd.randint(0, 5))}
        norm = math.sqrt(sum(w * w for w in terms.values()))
        rows += [(f"{prefix}{i:03}", t, w / norm) for t, w in terms.items()]
    return rows


@pytest.mark.parametrize("k,min_score,salt,seeds", [(1, 0.0, 50_000, 200), (1, 0.0, 5, 6), (3, 0.0, 5, 6), (2, 0.6, 5, 0)])
def test_sparse_search_is_exact(spark, k, min_score, salt, seeds):
    rnd = random.Random(k)
    q, d = vectors_of(rnd, 60, "q"), vectors_of(rnd, 90, "d")
    schema = "id string, term string, weight double"
    got = sparse.top_k(
        spark.createDataFrame(q, schema), spark.createDataFrame(d, schema), k, min_score, seed_rows=seeds, rows_per_salt=salt
    ).collect()
    docs: dict = {}
    for i, t, w in d:
        docs.setdefault(t, []).append((i, w))
    want = {}
    for name in {r[0] for r in q}:
        scores: dict = {}
        for _, t, w in (r for r in q if r[0] == name):
            for i, v in docs.get(t, []):
                scores[i] = scores.get(i, 0.0) + w * v
        best = sorted((-round(s, 6), i) for i, s in scores.items() if round(s, 6) >= min_score)[:k]
        for rank, (s, i) in enumerate(best, 1):
            want[(name, rank)] = (i, -s)
    assert {(r["qid"], r["rank"]): (r["did"], round(r["score"], 6)) for r in got} == want


def test_sparse_search_leaves_most_pairs_alone(spark):
    """Frequent terms are in every document, yet few documents can be the nearest."""
    rnd = random.Random(6)

    def vectors(n, prefix):
        rows = []
        for i in range(n):
            terms = {f"f{j}": rnd.uniform(0.5, 1.5) for j in range(8)} | {f"r{rnd.randint(0, 2000)}": rnd.uniform(2, 4) for _ in range(12)}
            norm = math.sqrt(sum(w * w for w in terms.values()))
            rows += [(f"{prefix}{i:04}", t, w / norm) for t, w in terms.items()]
        return spark.createDataFrame(rows, "id string, term string, weight double")

    q = vectors(200, "q").select(F.col("id").alias("qid"), "term", F.col("weight").alias("q_weight"))
    d = vectors(800, "d").select(F.col("id").alias("did"), "term", F.col("weight").alias("d_weight"))
    index = sparse._Index(q, d)
    cuts = sparse._choose_cuts(index, sparse._seed_bounds(index, 1, 0.0, 200, 50_000))
    assert sparse.candidates(index, cuts).count() < 0.25 * 200 * 800


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold", [95, 80, 70, 55])
def test_fuzzy_pairs_are_complete(spark, threshold):
    rnd = random.Random(threshold)
    base = ["".join(rnd.choices("abcd ", k=rnd.randint(1, 24))).strip() or "a" for _ in range(40)]

    def noisy(s):
        s = list(s)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(s) + 1)
            s[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "a"])
        return "".join(s) or "a"

    left, right = [noisy(b) for b in base], [noisy(b) for b in base] + ["aaaaaaaa", "aaaaaaab"]
    got = fuzzy.fuzzy_pairs(
        spark.createDataFrame([(x,) for x in left], "n string"), "n",
        spark.createDataFrame([(x,) for x in right], "n string"), "n", threshold, rows_per_salt=4,
    ).collect()
    want = {}
    for a in set(left):
        for b in set(right):
            s = math.floor(100 * (1 - levenshtein(a, b) / max(len(a), len(b))) + 0.5 + 1e-9)
            if s >= threshold:
                want[(a, b)] = s
    assert {(r["left_name"], r["right_name"]): r["score"] for r in got} == want


def test_numbered_names_meet_few_others(spark, monkeypatch):
    """Names that differ in their digits only: candidates grow with the names, not with their square."""
    met, join = [], fuzzy.salted_join

    def counted(left, right, key, salted, right_id, condition=None, rows_per_salt=fuzzy.ROWS_PER_SALT):
        met.append(join(left, right, key, salted, right_id, None, rows_per_salt).count())
        return join(left, right, key, salted, right_id, condition, rows_per_salt)

    monkeypatch.setattr(fuzzy, "salted_join", counted)
    names = [f"Customer#{i:09d}" for i in range(4000)]
    sides = [spark.createDataFrame([(n,) for n in some], "name string") for some in (names[::4], names)]
    pairs = fuzzy.fuzzy_pairs(sides[0], "name", sides[1], "name", 90)
    # Four digits, three of them with nine other values and one with three; and the name itself.
    assert pairs.count() == 1000 * (1 + 3 * 9 + 3)
    assert sum(met) < 150 * 1000


def test_fuzzy_join_lists_best_first(spark):
    left = spark.createDataFrame([("shiraz reserve",), ("nothing like it",)], "n string")
    right = spark.createDataFrame([("shiraz reserva",), ("shiraz reserve",), ("shiraz xxserve",)], "n string")
    got = {r["n"]: r["matches"] for r in fuzzy.fuzzy_join(left, "n", right, "n", 80, 2).collect()}
    assert got == {"shiraz reserve": "shiraz reserve, shiraz reserva", "nothing like it": ""}
    with pytest.raises(ValueError):
        fuzzy.fuzzy_join(left, "n", right, "n", 20)


def words_of(name):
    return [w for w in re.split(r"[^a-z0-9]+", name.lower()) if w]


@pytest.mark.parametrize("threshold", [90, 75])
def test_token_scorers_are_complete(spark, threshold):
    rnd = random.Random(threshold)
    vocabulary = ["the", "old", "red", "shiraz", "reserve", "estate", "barossa", "valley", "x", "2019"]
    names = [" ".join(rnd.sample(vocabulary, rnd.randint(1, 6))) for _ in range(60)]
    left, right = names[:30] + ["", "Red, OLD the", "--"], [n.title() + rnd.choice(["", "!", " old old", "s"]) for n in names] + ["the old red"]
    frames = [spark.createDataFrame([(x,) for x in side], "n string") for side in (left, right)]
    ratio = lambda a, b: math.floor(100 * (1 - levenshtein(a, b) / max(len(a), len(b))) + 0.5 + 1e-9)
    want = {s: {} for s in ("token_sort", "token_set", "weighted")}
    for a in set(left):
        for b in set(right):
            wa, wb = words_of(a), words_of(b)
            plain, sort, both = ratio(a, b) if a and b else 0, 0, 0
            if wa and wb:
                sort = ratio(" ".join(sorted(wa)), " ".join(sorted(wb)))
                size = lambda w: sum(map(len, w))
                both = math.floor(100 * size(set(wa) & set(wb)) / min(size(set(wa)), size(set(wb))) + 0.5)
            best = max(plain, math.floor(sort * 0.95 + 0.5), math.floor(both * 0.95 + 0.5))
            for name, score in (("token_sort", sort), ("token_set", both), ("weighted", best)):
                if score >= threshold:
                    want[name][a, b] = score
    for scorer in want:
        got = fuzzy.scored_pairs(frames[0], "n", frames[1], "n", threshold, scorer).collect()
        assert {(r["left_name"], r["right_name"]): r["score"] for r in got} == want[scorer], scorer
    with pytest.raises(ValueError):
        fuzzy.scored_pairs(frames[0], "n", frames[1], "n", threshold, "other")


TEXTS = "stockcode string, mystery boolean, rich_description string, web_description_short string, review1_text string, review2_text string"


def test_exact_text_rules(spark):
    rows = [
        ("m1", True, "deep red", "w", None, ""),
        ("m2", True, None, "  ", "[...]", "ok"),
        ("k1", False, "deep red", "w", None, ""),
        ("k2", False, "deep red", None, "[..]", None),
        ("k3", False, None, "  ", "[...]", "ok"),
        ("k4", False, "other", None, None, "ok"),
    ]
    matches, members = exact_text_match(spark.createDataFrame(rows, TEXTS))
    got = sorted((r["stockcode_x"], r["stockcode_y"], r["method"]) for r in matches.collect())
    # k2 and k3 have placeholder reviews and are out of every method; blank texts match nothing
    assert got == [("m1", "k1", "desc_match"), ("m1", "k1", "webdesc_match"), ("m2", "k4", "rev2_match")]
    listed = {(r["method"], r["stockcode"]) for r in members.collect()}
    assert listed == {("desc_match", "k1"), ("webdesc_match", "k1"), ("rev2_match", "k4")}


@pytest.mark.parametrize("n_mystery", [100, 101])
def test_groups_of_any_size_have_one_shape(spark, n_mystery):
    rows = [(f"m{i}", True, "same", None, None, None) for i in range(n_mystery)]
    rows += [(f"k{i:02}", False, "same", None, None, None) for i in range(100)]
    rows += [("m999", True, "rare", None, None, None), ("k999", False, "rare", None, None, None)]
    matches, members = exact_text_match(spark.createDataFrame(rows, TEXTS))
    got = matches.collect()
    assert len(got) == n_mystery + 1 and members.count() == 101
    assert {(r["stockcode_y"], r["n_known"]) for r in got if r["stockcode_x"] != "m999"} == {("k00", 100)}
    pairs = matches.join(members, ["method", "match_key"]).select("stockcode_x", "stockcode").distinct()
    assert pairs.count() == 100 * n_mystery + 1


def test_queries_stand_only_under_lengths_that_documents_have(spark):
    cuts = spark.createDataFrame([("a", 3, 1.0, 0.5), ("b", 3, 1.0, 0.99), ("c", 4, 0.0, 0.5), ("d", 4, 0.1, 0.9)], "qid string, cut int, q_rest double, bound double")
    cells = spark.createDataFrame([(3, 10, 1), (3, 40, 2), (3, 64, 3), (4, 64, 4)], "cut int, cell int, place long")
    got = sorted((r.qid, r.place) for r in sparse._asked_cells(cuts, cells).collect())
    assert got == [("a", 2), ("a", 3), ("b", 3)]


def test_trigrams_of_distinct_names_are_listed_in_many_tasks(spark, monkeypatch):
    plans = {}

    def written(df, label, **more):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return durable(df, label, **more)

    monkeypatch.setattr(text_match, "durable", written)
    names = spark.createDataFrame([(f"name {i} of {i * 7}",) for i in range(50)], "n string")
    found = text_match.trigram_name_match(names, "n", names.union(names), "n").collect()
    assert len(found) == 50 and all(r.original_name == r.matched_name for r in found)
    assert all("REPARTITION_BY_NUM" in plans[x] for x in ("clean-grams", "messy-grams"))
