"""Operators over whole tables and the pipeline, against brute force."""

import collections
import html
import random
import re

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from unmask.llm import crosspolytope, golay, linedup, mixing, packing, wrapper
from unmask.llm.common import word_count
from unmask.session import durable

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Packing


def brute_best_fit(lengths, window):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            best = min(fits, key=lambda i: rooms[i])
            rooms[best] -= n
        else:
            rooms.append(window - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_counts_pack_as_piece_by_piece(seed):
    rng = random.Random(seed)
    window = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, rng.choice([3, window - 1])) for _ in range(rng.choice([0, 1, 50, 400]))]
    counts = collections.Counter(lengths)
    ranges, used = packing.best_fit_decreasing(counts, window)
    placed, dealt = collections.defaultdict(list), collections.defaultdict(list)
    for n, first, many, start, offset in ranges:
        dealt[n] += range(first, first + many)
        for w in range(start, start + many):
            placed[w].append((offset, n))
    assert {n: sorted(d) for n, d in dealt.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert sorted(placed) == list(range(used))
    for pieces in placed.values():
        ends = 0
        for offset, n in sorted(pieces):
            assert offset == ends
            ends += n
        assert ends <= window
    rooms = sorted(window - sum(n for _, n in p) for p in placed.values())
    assert rooms == brute_best_fit(lengths, window)


def test_room_tree():
    tree, used, rng = packing.RoomTree(13), set(), random.Random(1)
    for _ in range(500):
        room = rng.randrange(13)
        used ^= {room}
        tree.mark(room, room in used)
        least = rng.randrange(14)
        assert tree.tightest(least) == min((r for r in used if r >= least), default=None)


@pytest.mark.parametrize("piece_rows", [20_000, 2])
def test_documents_are_packed_whole(spark, messy, messy_rows, empty, monkeypatch, piece_rows):
    monkeypatch.setattr(packing, "PIECE_ROWS", piece_rows)
    rows = packing.pack(messy, WORD_FILE, window=64).placed().collect()
    encoder = Tokenizer.from_file(WORD_FILE)
    encoder.encode_special_tokens = True
    want = collections.Counter()
    for doc_id, text, *_ in messy_rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [2]
        for at in range(0, len(ids), 64):
            want[doc_id, len(ids), at, tuple(ids[at : at + 64])] += 1
    assert collections.Counter((r.doc_id, r.doc_tokens, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 64
    assert packing.pack(empty, WORD_FILE).placed().count() == 0


def test_moved_ids_take_two_bytes(spark):
    """Of a piece whose ids fit; what is returned is the same."""
    rows = spark.createDataFrame([(1, "one two three " * 40), (2, None), (3, "four")], "doc_id long, text string")
    whole, packed = packing.pack(rows, WORD_FILE, window=64), packing.pack(rows, WORD_FILE, window=64, narrow=True)
    assert all(len(r["ids"]) == 2 * r["length"] for r in packed.pieces.collect())
    taken = ("doc_id", "start", "length", "ids")
    assert sorted(map(tuple, packed.placed(*taken).collect())) == sorted(map(tuple, whole.placed(*taken).collect()))
    # An id of three bytes stays as it is.
    wide = np.array([70_000, 1], dtype="<u4").tobytes()
    assert packing.narrowed(wide) == wide


# Mixing


def water_level(sizes, weights, ceiling=3):
    targets, open_, left = {}, dict(zip(sizes, weights, strict=True)), sum(sizes.values())
    while open_:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if share[s] > ceiling * sizes[s]]
        if not over:
            return targets | share
        for s in over:
            targets[s] = ceiling * sizes[s]
            left -= targets[s]
            del open_[s]
    return targets


def test_swap_or_not_permutes(spark):
    for n in (1, 2, 7, 100):
        col = mixing.permuted(F.col("id"), F.lit(n), [F.lit(9), F.col("id") * 0])
        out = [r[0] for r in spark.range(n).select(col).collect()]
        assert sorted(out) == list(range(n))
        assert n < 7 or out != list(range(n))


def test_targets_and_taken_words(spark, messy, messy_rows, empty):
    docs = messy.drop("size").select("*", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(docs, block_words=8, shard_slots=16)
    sizes = collections.Counter()
    for r in messy_rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = water_level({s: sizes[s] for s in order}, [(5, 2, 1)[i % 3] for i in range(len(order))])
    sources = {r.source: r for r in mixed.sources.collect()}
    assert set(sources) == set(order)
    for s in order:
        assert sources[s].source_size == sizes[s] and sources[s].target == pytest.approx(want[s])
    rows = {r[mixed.uid]: r for r in mixed.rows.collect()}
    pieces = mixed.pieces.collect()
    times = collections.Counter()
    for p in pieces:
        assert 0 <= p.word_from and p.word_from + p.n_words <= rows[p.uid]["size"] and p.n_words > 0
        for i in range(p.n_words):
            times[p.uid, p.word_from + i] += 1
    taken = collections.Counter()
    for (uid, _), n in times.items():
        assert n <= 3
        taken[rows[uid].source] += n
    for s in order:
        assert abs(taken[s] - want[s]) <= 12
    # Every slot of a full shard is used once.
    slots = collections.Counter(p.shard for p in {(p.shard, p.slot): p for p in pieces}.values())
    assert all(n <= 16 for n in slots.values()) and sum(n < 16 for n in slots.values()) <= 1
    again = mixing.mix(docs, block_words=8, shard_slots=16)
    assert collections.Counter(pieces) == collections.Counter(again.pieces.collect())
    nothing = mixing.mix(empty.drop("size").withColumn("size", F.lit(0).cast("long")))
    assert nothing.pieces.count() == 0 and nothing.sources.count() == 0
    blank = mixing.mix(docs.filter("size = 0"))
    assert blank.pieces.count() == 0 and {r.target for r in blank.sources.collect()} == {0.0}


# Nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int, query string, vec string"


def vector_rows():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[100:300] = x[100]
    x[300] = 2 * x[100]
    rows = [(i, v.tolist(), 1, "q", "v") for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 5]
    rows += [(10_000 + 50 * i, v, 2, "q", "v") for i, v in enumerate(odd)]
    return rows + [(None, [1.0] * 16, 3, "q", "v"), rows[5], rows[5]]


def exact_nearest(rows, k):
    ok = {i: np.array(v, dtype=float) for i, v, *_ in rows if i is not None and i < 10_000}
    ids = np.array(sorted(ok))
    x = np.stack([ok[i] for i in ids])
    norm = np.sqrt((x * x).sum(1))
    out = {}
    for at, i in enumerate(ids):
        if i % 50 == 0:
            score = x @ x[at] / (norm * norm[at])
            score[at] = -np.inf
            order = np.lexsort((ids, -np.round(score, 12)))[:k]
            out[int(i)] = [(int(ids[j]), score[j]) for j in order]
    return out


@pytest.mark.parametrize(("joined", "probes", "least", "block_rows"), [(1, 32, 1.0, 4_000), (2, 1_024, 1.0, 5), (1, 6, 0.9, 4_000), (2, 60, 0.9, 50)])
def test_nearest_against_brute_force(spark, joined, probes, least, block_rows):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS)
    got = collections.defaultdict(list)
    plan = [(10**9, joined, probes)]
    found = crosspolytope.search(df, F.col("vec_id") % 50 == 0, 5, plan=plan, block_rows=block_rows, rows_per_salt=20).collect()
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = exact_nearest(rows, 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= least
    assert [i for i, _ in got[150]] == [i for i, _ in want[150]] == [100, 101, 102, 103, 104]
    if least == 1.0:
        for q in want:
            assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_one_plan_holds_at_every_size(spark):
    """What a query does depends on what it meets: with few classes met it is compared with all, else its buckets decide."""
    assert len(crosspolytope.PLAN) == 1
    rows = vector_rows()
    df, want = spark.createDataFrame(rows, VECTORS), exact_nearest(rows, 5)
    shares = []
    for least in (1, 100_000):
        found = crosspolytope.search(df, F.col("vec_id") % 50 == 0, 5, plan=[(1, 2, 60)], rows_per_salt=20, least_met=least).collect()
        got = collections.defaultdict(set)
        for r in found:
            got[r.query_id].add(r.vec_id)
        shares.append(sum(len(got[q] & {i for i, _ in want[q]}) for q in want) / (5 * len(want)))
    assert shares[0] >= 0.9 and shares[1] == 1.0


def test_a_tight_cluster_makes_no_larger_groups(spark, monkeypatch):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1_500, 16))
    x[::3] = x[0] + 0.05 * rng.normal(size=(500, 16))
    rows = [(i, v.tolist(), 0, "", "") for i, v in enumerate(x.astype(np.float32))]
    score = crosspolytope.rerank

    def bounded(queries, found, k):
        assert len(queries) <= 100 and len(found) <= 100, (len(queries), len(found))
        return score(queries, found, k)

    monkeypatch.setattr(crosspolytope, "rerank", bounded)
    frame = spark.createDataFrame(rows, VECTORS)
    out = crosspolytope.search(frame, F.col("vec_id") % 5 == 0, 5, tables=2, plan=[(10**9, 1, 32)], block_rows=50, rows_per_salt=40).collect()
    got = {(r.query_id, r["rank"]): r.score for r in out}
    assert len(got) == 5 * 300
    for q, near in exact_nearest(rows, 5).items():
        assert [got[q, n + 1] for n in range(5)] == pytest.approx([s for _, s in near], abs=1e-12)


@pytest.mark.parametrize("size", [1, 3, 1_000])
def test_slices_find_the_same(monkeypatch, size):
    rng = np.random.default_rng(12)
    x = np.repeat(rng.normal(size=(20, 4)), 2, axis=0)
    frame = pd.DataFrame({"class_id": rng.permutation(40), "vec": [v.tobytes() for v in x]})
    want = crosspolytope.best_of_block(frame.rename(columns={"class_id": "query"}), frame, 3)
    monkeypatch.setattr(crosspolytope, "SLICE", size)
    got = crosspolytope.best_of_block(frame.rename(columns={"class_id": "query"}), frame, 3)
    assert got[["query", "class_id"]].equals(want[["query", "class_id"]]) and np.allclose(got["score"], want["score"])


def test_few_candidates_are_all_found(spark):
    df = spark.createDataFrame([(50 * i, [float(i), 1.0, -2.0], 0, "", "") for i in range(4)], VECTORS)
    found = crosspolytope.search(df, F.lit(True), 5, tables=1, plan=[(10**9, 1, 1)]).collect()
    assert collections.Counter(r.query_id for r in found) == {0: 3, 50: 3, 100: 3, 150: 3}
    assert crosspolytope.search(df.limit(0), F.lit(True)).count() == 0
    assert crosspolytope.search(df.limit(1), F.lit(True)).count() == 0


def test_joined_rotations_score_a_small_share():
    """Of 50,000 vectors without any structure, the production plan meets 9 in 10 neighbours and few others."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    asked = np.arange(0, 50_000, 1_000)
    joined, probes = next((j, p) for most, j, p in crosspolytope.PLAN if len(x) <= most)
    assert joined == 2
    hit = np.zeros((len(asked), len(x)), dtype=bool)
    for t in range(crosspolytope.TABLES):
        filed = np.concatenate([crosspolytope.keys(part, t, joined, 1, crosspolytope.SEED)[:, 0] for part in np.array_split(x, 50)])
        for i, probed in enumerate(crosspolytope.keys(x[asked], t, joined, probes, crosspolytope.SEED)):
            hit[i] |= np.isin(filed, probed)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -2
    near = np.argsort(-score, axis=1)[:, :5]
    assert np.take_along_axis(hit, near, 1).mean() >= 0.9 and hit.mean() < 0.2


def test_best_keys_come_first():
    x = np.random.default_rng(5).normal(size=(4, 8))
    for joined in (1, 2):
        scores = [crosspolytope.axis_scores(x, 3 * joined + r, 9) for r in range(joined)]
        sums = scores[0] if joined == 1 else (scores[0][:, :, None] + scores[1][:, None, :]).reshape(4, -1)
        want = np.argsort(-sums, axis=1, kind="stable")[:, :7]
        assert (crosspolytope.keys(x, 3, joined, 7, 9) == want).all()
        assert (crosspolytope.keys(x, 3, joined, 1, 9) == want[:, :1]).all()


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 64))
    turned = crosspolytope.axis_scores(x, 3, 9)[:, :64]
    assert np.linalg.norm(turned, axis=1) / np.linalg.norm(x, axis=1) == pytest.approx(64**1.5)


# Line runs


def brute_lines(rows, least):
    """(lines, removed, text) of each row, from the longest earlier copy at every place."""
    full = []
    for at, (_, text) in enumerate(rows):
        for no, line in enumerate((text or "").split("\n")):
            if words(line):
                full.append((at, no, line))
    gone = set()
    for i in range(len(full)):
        for j in range(i):
            n = 0
            while i + n < len(full) and full[i + n][2] == full[j + n][2] and full[i + n][0] == full[i][0] and full[j + n][0] == full[j][0]:
                n += 1
            if sum(len(words(full[i + k][2])) for k in range(n)) >= least:
                gone |= {full[i + k][:2] for k in range(n)}
    out = []
    for at, (_, text) in enumerate(rows):
        if text is None:
            out.append((0, 0, None))
            continue
        lines = text.split("\n")
        real = [no for no, line in enumerate(lines) if words(line)]
        cut = {no for no in real if (at, no) in gone}
        cut |= {no for a, b in zip(real, real[1:], strict=False) if a in cut and b in cut for no in range(a, b)}
        out.append((len(lines), len(cut), "\n".join(x for no, x in enumerate(lines) if no not in cut)))
    return out


@pytest.mark.parametrize(("seed", "least"), [(1, 3), (2, 5), (3, 1), (4, 12)])
def test_line_runs_against_brute_force(spark, seed, least):
    rng = random.Random(seed)
    pool = ["a b", "c", "d e f", "g g", "", " ", "h i j k"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(14)]
    rows += [(20, None), (21, ""), (22, rows[0][1]), (23, "\n".join(["c"] * 30))]
    got = linedup.drop_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string"), least).collect()
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got}
    assert [got[i] for i, _ in rows] == brute_lines(rows, least)


def test_passage_goes_from_the_later_document(spark, messy, messy_rows, empty):
    out = linedup.drop_repeated_runs(messy, 50)
    assert collections.Counter(out.columns) == collections.Counter([*messy.columns, "n_removed"])
    rows = out.collect()
    assert len(rows) == len(messy_rows)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[6].n_removed == 0 and by[7].text == "start of seven\nend of seven" and by[7].n_removed == 4
    assert sum(r.n_removed for r in rows) == 4
    assert linedup.drop_repeated_runs(empty).count() == 0


# Pages


def page(host, i, body, top="<nav><a href='/'>Home</a></nav>"):
    return (i, f"https://{host}/p/{i}", f"<!DOCTYPE html><html><head><title>t</title></head><body>{top}{body}</body></html>", "x")


def test_templates_are_learned_by_host(spark):
    rng = random.Random(2)

    def prose():
        return " ".join(rng.choice("red green blue white black grey brown pink".split()) for _ in range(30))

    texts = [prose() for _ in range(6)]
    rows = [page("a.example", i, f"<div class='x1'>Join our club</div><div class='x2'><p>{t}</p><p>Signed {i}</p></div><div>All about us</div>") for i, t in enumerate(texts)]
    # Copies of one article must not make it a template.
    rows += [page("b.example", 20 + i, f"<div><p>{texts[0]}</p></div>") for i in range(5)]
    rows += [page("c.example", 30, "<main><p>x &lt; y&nbsp;&amp; <b>z</b>ed<br>q</p></main>"), (31, None, None, "x"), (32, "no url", "", "x"), (33, "http://d.example/", "<p>open <i>text<p>next", "x")]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = wrapper.main_texts(df).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    by = {r.page_id: r.text for r in out}
    assert [by[i] for i in range(6)] == [f"{t} Signed {i}" for i, t in enumerate(texts)]
    assert {by[20 + i] for i in range(5)} == {texts[0]}
    assert (by[30], by[31], by[32], by[33]) == ("x < y & zed q", "", "", "open text next")
    assert wrapper.main_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("stub", ["<html><body></body></html>", "<html><body><p>Moved</p></body></html>"])
def test_a_stub_changes_no_template(spark, stub):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("red green blue white black grey brown pink".split()) for _ in range(20 + i % 9)) for i in range(60)]
    rows = [page("a.example", i, f"<div class='x1'>Join our club</div><div class='x2'><p>{t}</p></div><div>All about us</div>") for i, t in enumerate(texts)]
    rows.append((60, "https://a.example/gone", stub, "x"))
    out = wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    by = {r.page_id: r.text for r in out}
    assert [by[i] for i in range(60)] == texts


def test_what_varies_on_a_host_outweighs_names(spark):
    rng = random.Random(5)

    def prose(n):
        return " ".join(rng.choice("red green blue white black grey brown pink".split()) for _ in range(n))

    rows, want = [], {}
    for i in range(100):
        # A section of the article has a listed name and varies; the fine print does not.
        a, b, c, d = (prose(25) for _ in range(4))
        part = ["discussion", "related", "notice", "promotion"][i % 4]
        body = f"<article><h1>{a}</h1><p>{b}</p><section class='{part}'><p>{c}</p></section><div class='cookie'>Fine print</div><p>{d}</p></article>"
        rows.append((i, f"https://host{i % 4}.example/{i}", page("x", i, body + f"<div class='sidebar'><p>{prose(9)}</p></div>")[2], "x"))
        want[i] = f"{a} {b} {c} {d}"
    for i in range(100, 120):
        # The article is the same on all pages, and the story is outside of it.
        a, b = prose(25), prose(20)
        rows.append(page("story.example", i, f"<div class='story'><p>{a}</p><p>{b}</p></div><article><p>Buy one and get one</p></article>"))
        want[i] = f"{a} {b}"
    out = wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    assert {r.page_id: r.text for r in out} == want


def test_boilerplate_elements_go():
    text = wrapper.extract(
        "<body class='has-sidebar'><header><h1>Site</h1></header><div id='cookie-notice'>We use cookies</div>"
        "<article class='post'><header><h2>Title</h2></header><p>One<ul><li>a<li>b</ul><script>var x='</p>';</script>"
        "<form>f</form><div class='adBox'>Buy</div><table><tr><td>1<td>2</table>"
        "<section id='comments'><article class='comment'>rude</article></section></article>"
        "<aside>side</aside><article><a href='/x'>More to read</a></article><footer>foot"
    )
    assert text == "Title One a b 1 2"
    assert wrapper.extract("<b>" * 5_000 + "deep" + "<div>" * 5_000 + "er") == "deep er"
    nested = "<article><p>first</p>" + "<div>" * 250 + "in<nav>menu <b>x</b></nav><p>side</p>out" + "</div>" * 250 + "<p>last</p></article><p>after</p>"
    assert wrapper.extract(nested) == "first in side out last"
    assert wrapper.extract("<div>" * 300 + "<nav>" * 300 + "menu" + "</nav>" * 300 + "kept<br>on" + "</div>" * 300 + "end") == "kept on end"
    assert wrapper.extract("a < b <!-- no --> & \"<p title='x>y'>c") == 'a < b & " c'


def test_alignment_matches_most_nodes():
    ref = wrapper.Reference(wrapper.skeleton("<ul><li>a</ul><p>one</p><p>two</p><div>end</div>"))
    root = wrapper.parse("<p>zero</p><p>two</p><div>end</div><div>more</div>")
    pairs = {wrapper.own_text(n): ref.digests[r] == wrapper._digest(wrapper.own_text(n)) for n, r in ref.align(root) if n.tag != "#root"}
    assert pairs == {"zero": False, "two": True, "end": True}


# The pipeline


def test_stages_keep_columns_and_take_effect(spark, messy, messy_rows, tmp_path):
    rng = random.Random(8)
    common = "the of and to in is was for on with as at by from this that which not are be have it".split()
    stems = "water light stone paper garden market winter summer travel letter window morning evening table story".split()
    stems += "engine forest island school bridge village doctor teacher farmer sailor writer hunter singer planet".split()

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else f"{rng.choice(stems)}{rng.choice(['', 's', 'like', 'man', 'side', 'work'])}" for _ in range(n))

    passage = "\n".join(prose(30) for _ in range(3))
    base = prose(900).split()
    near = " ".join([*base, "thing"])
    rows = [
        (1, passage + "\n" + prose(80), "en", "a", 1, "k"),
        (2, prose(60) + "\n" + passage, "en", "a", 1, "k"),
        (3, passage, "en", "b", 1, "k"),
        (4, " ".join(base), "en", "b", 1, "k"),
        (5, near, "en", None, 1, "k"),
        (6, "too short", "en", "a", 1, "k"),
        (7, "THIS!! IS!! LOUD$$$ " * 30, "en", "a", 1, "k"),
        (8, None, None, None, None, None),
        *((20 + i, prose(90), "en", "ab"[i % 2], 1, "k") for i in range(20)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    stages = {n: (lambda *a, f=f: durable(f(*a), "stage")) for n, f in corpus_pipeline.STAGES}
    assert list(stages) == ["quality_rules", "line_dedup", "near_duplicates", "mix_sources", "pack_sequences"]
    kept = stages["quality_rules"](spark, docs, "")
    assert kept.schema == docs.schema
    assert {r[0] for r in rows} - {r.doc_id for r in kept.collect()} == {6, 7, 8}
    lines = stages["line_dedup"](spark, kept, "")
    by = {r.doc_id: r for r in lines.collect()}
    assert lines.schema.names == docs.schema.names and 3 not in by
    assert by[2].text == rows[1][1].split("\n")[0] and by[2].n_chars == len(by[2].text) and by[1].text == rows[0][1]
    once = stages["near_duplicates"](spark, lines, "")
    assert once.schema.names == docs.schema.names
    assert set(by) - {r.doc_id for r in once.collect()} == {5}
    mixed = stages["mix_sources"](spark, once, "")
    assert mixed.schema.names == docs.schema.names
    out = mixed.collect()
    texts = {r.doc_id: r.text for r in once.collect()}
    copies = collections.Counter(r.doc_id for r in out)
    assert max(copies.values()) <= 3 and set(copies) <= set(texts)
    for r in out:
        rest = iter(words(texts[r.doc_id]))
        assert words(r.text) and all(w in rest for w in words(r.text)) and r.n_chars == len(r.text)
    total = sum(len(words(t)) for t in texts.values())
    assert abs(sum(len(words(r.text)) for r in out) - total) < 0.15 * total
    packed = stages["pack_sequences"](spark, mixed, "").collect()
    encoder = Tokenizer.from_file(WORD_FILE)
    assert sum(r.length for r in packed) == sum(len(encoder.encode(r.text, add_special_tokens=False).ids) + 1 for r in out)

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)
    for stage in stages.values():
        assert stage(spark, docs.limit(0), "").count() == 0


def test_rows_are_told_apart_by_their_place(spark, messy, messy_rows):
    out = corpus_pipeline.near_duplicates(spark, messy, "").collect()
    ids = collections.Counter(r.doc_id for r in out)
    # Different texts of id 10 stay, copies under id 12 are one, and the clean row without an id stays.
    assert ids[10] == 2 and ids[12] == 1 and ids[None] == 1
    groups = {}
    for r in messy_rows:
        groups.setdefault(golay.fingerprint(r[1]), []).append(r)
    assert len(out) <= len(groups) and {r[1] for r in messy_rows if r[0] == 10} <= {r.text for r in out}
    rows = [(1, "alpha beta gamma"), (None, "one two three four"), (2, "red green blue yellow"), (2, "up down left right")]
    clean = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.text for r in corpus_pipeline.near_duplicates(spark, clean, "").collect()) == sorted(t for _, t in rows)


def test_stages_chain_without_tables_between(spark, messy):
    docs = messy
    for _, f in corpus_pipeline.STAGES[1:3]:
        docs = f(spark, docs, "")
    kept = {r.text for r in docs.collect()}
    assert len(kept) > 10 and max(r[1] or "" for r in messy.select("doc_id", "text").filter("doc_id = 13").collect()) in kept


def test_row_of_a_repeated_id_is_no_copy_of_another(spark):
    base = " ".join(f"{w}{i}" for i, w in enumerate(words("river stone moved under bright cold morning while people walked") * 90))
    other = " ".join(f"zz{i}" for i in range(300))
    rows = [(3, base, "k"), (5, base + " thing", "k"), (5, other, "k"), (7, other, "k")]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, first_id string"), "").collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(3, base), (5, other)]  # of the first row's group, and of the others'


def test_entities_decode_once():
    assert wrapper.extract("<p>&amp;lt; &#8217; &copy; &unknown;") == html.unescape("&amp;lt; &#8217; &copy; &unknown;")


@pytest.mark.parametrize("copied", [0, 1_000_000])
@pytest.mark.parametrize("copies", [1, 4])
def test_texts_stay_where_they_are_as_near_duplicates_go(spark, monkeypatch, copies, copied):
    # No row is near another but its own copies; with four of each the rows that stay are the shorter list.
    rng = random.Random(8)
    texts = [" ".join(str(rng.random()) for _ in range(40)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts * copies + texts[:5])]
    monkeypatch.setattr(golay, "COPIED_ROWS", copied)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = golay.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(r.doc_id for r in out.collect()) == list(range(30))
        assert ("Exchange hashpartitioning" in out._jdf.queryExecution().toString()) == (copied == 0)
        links = golay.fingerprint_links(spark.createDataFrame([(1,), (3,)], "fp long"))
        # Keys are listed once and move once, and are moved again only where several fingerprints share one.
        assert links._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow _expand") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
