"""Operators that judge, count, shuffle or encode documents, against brute force."""

import base64
import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from unmask.llm import fertility, golay, repair, sharding, unigram
from unmask.llm.queries import fertility_files
from unmask.llm.tokens import JsonEncoder
from unmask.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = st.text(alphabet=st.sampled_from(list("abE é'sß.,!?1\n\t\r İΣσ́Å日本\x1c\x85ẞ<|endoftext|>$▁𝒳 ﻿")), max_size=40)


def stored_bytes(store):
    return sum(len(chunk) + len(ids) for chunk, ids in store.items())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_encode_like_whole_texts(name):
    encoder = JsonEncoder(public_tokenizers.path(name), limit=10_000)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(ODD, max_size=4))
    def same(texts):
        want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(p, "<u4").tolist() for p in encoder.encode(texts)] == want
        assert stored_bytes(encoder.store) <= 10_000

    same()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_encoded_apart_from_marks(name):
    """The library sees each word and each mark once, not every pair of words with a mark between them."""
    encoder = JsonEncoder(public_tokenizers.path(name))
    words = [a + b for a in ("stone", "Été", "rivère", "old") for b in ("", "s", "ß", "ing", "né")]
    text = " ".join(f"{a}%{b}" for a in words for b in words)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.store) <= 3 * len(words)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_without_spaces_are_not_remembered(name):
    """Stores stay small where every text is one chunk, and hold the oldest chunks only after a task."""
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 3000))) for _ in range(100)]
    encoder = JsonEncoder(public_tokenizers.path(name))
    encoder.encode(texts)
    assert stored_bytes(encoder.store) < 10_000
    encoder.encode([" ".join(f"w{i}" for i in range(100_000))])
    assert stored_bytes(encoder.store) <= 32_000_000
    encoder.store.rest(1_000_000)
    assert 0 < stored_bytes(encoder.store) <= 1_000_000 and encoder.store.held <= 1_000_000
    ids = encoder.encode(["w3 w99999 new"])[0]
    assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode("w3 w99999 new", add_special_tokens=False).ids
    pieces, ranks = fertility.vocabularies(*fertility_files())
    for v in (pieces, ranks):
        before = stored_bytes(v.store)
        v.store.forget(v.store.learn({t.encode() for t in texts}))
        assert stored_bytes(v.store) == before
    model = unigram.model(PIECES)
    model.count(texts[0])
    assert max(map(len, model.store), default=0) <= unigram.LONGEST_CHUNK


@pytest.mark.parametrize("pattern", [[7], [1, 2, 3], [5, 5, 6], [1, 1, 1, 2]])
def test_repeats_compress(pattern):
    """Runs and periodic texts shrink to under a hundredth, also where a pair overlaps itself."""
    ids = np.array(pattern * (300_000 // len(pattern)), dtype=np.uint32)
    base, rules, tokens, symbols = repair.compress(ids)
    assert len(symbols) + 2 * len(rules) < 0.01 * len(ids)
    assert (repair.expand(symbols, base, rules) == ids).all()


def test_a_range_opens_few_rules():
    rng = np.random.default_rng(4)
    ids = np.concatenate([np.tile(rng.integers(0, 500, 200), 40) for _ in range(50)])
    packed = ids.astype("<u4").tobytes()
    block = repair.Block(repair._row(0, 0, [1], [packed]))
    assert len(block.rules) > 100
    for start, n in ((0, 10), (123_456, 10), (399_990, 50), (77, 3_000), (5, 0)):
        assert block.decode_range(start, n).tolist() == ids[start : start + n].tolist()
        if n == 10:
            assert block.opened < 60


# Quality rules


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    hit = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n


def test_quality_figures_and_verdict(spark, messy, messy_rows, empty):
    got = fertility.quality(messy, *fertility_files())
    assert got.columns[:5] == messy.columns[:5] and "kept" in got.columns
    rows = got.collect()
    assert len(rows) == len(messy_rows)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
    for r in rows:
        text = r.text or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_measures(text)
        ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", text) for i in model.encode(w)]
        if ids:
            p = np.array(list(collections.Counter(ids).values())) / len(ids)
            entropy = -(p * np.log2(p)).sum() / math.log2(min(len(ids), 256)) if len(ids) > 1 else 0
            assert r.piece_chars == pytest.approx(r.word_chars / len(ids))
            assert r.piece_fallback == pytest.approx(np.mean([model.is_byte(i) for i in ids]))
            assert r.piece_entropy == pytest.approx(entropy)
        tokens = [i for w in re.findall(r"[^\x20\x09-\x0D]+", text) for i in ranks.encode_ordinary(" " + w)]
        if tokens:
            p = np.array(list(collections.Counter(tokens).values())) / len(tokens)
            entropy = -(p * np.log2(p)).sum() / math.log2(min(len(tokens), 256)) if len(tokens) > 1 else 0
            broken = [ranks.decode_single_token_bytes(i).decode("utf-8", "replace").encode() != ranks.decode_single_token_bytes(i) for i in tokens]
            assert (r.byte_chars, r.byte_fallback) == pytest.approx((r.word_chars / len(tokens), np.mean(broken)))
            assert r.byte_entropy == pytest.approx(entropy)
        band = fertility.BANDS[r.lang if r.lang in fertility.BANDS else fertility.script_of(text)]
        inside = band.piece_chars[0] <= r.piece_chars <= band.piece_chars[1] and band.byte_chars[0] <= r.byte_chars <= band.byte_chars[1]
        inside = inside and r.piece_fallback <= band.fallback_share and r.byte_fallback <= band.byte_share
        inside = inside and all(band.entropy[0] <= e <= band.entropy[1] for e in (r.piece_entropy, r.byte_entropy))
        assert r.kept == (not r.base_failed and inside)
    assert fertility.quality(empty, *fertility_files()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=40))
def test_repeated_windows(words):
    assert fertility.repeated_words(words) == brute_measures(" ".join(words))[4]


def test_bands_reject_what_tokenizers_find_odd():
    loaded = fertility.vocabularies(*fertility_files())
    good = "The river moved slowly past the old stone bridge, and nobody on the road had ever seen it so quiet. " * 1 + (
        "A boy threw bread to the ducks while his mother read a letter that had come from the city that morning."
    )
    shouted = " ".join(f"{w.upper()}!!$$$" for w in good.split())
    noise = " ".join("xq7#kz%%vj" + str(i * 7919) for i in range(40))
    one = " ".join(["again"] * 3 + ["and", "over"] * 14)
    kept = [m[6] for m in fertility.measure([good, shouted, noise, one], ["en"] * 4, *loaded, fertility.BANDS)]
    assert kept == [True, False, False, False]
    assert fertility.script_of("тест строка") == "Cyrillic" and fertility.script_of("日本") == "Han" and fertility.script_of("12") == "Latin"


# Token counts


def library_model(pieces):
    return Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))


def test_counts_equal_the_library(spark, messy, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    library = library_model([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())])
    for r in unigram.token_counts(messy, PIECES).collect():
        text = r.text or ""
        assert r.n_tokens == (len(library.encode("▁" + text.replace(" ", "▁")).ids) if text else 0)
    assert unigram.token_counts(empty, PIECES).count() == 0


@pytest.mark.parametrize("joined", [False, True])
def test_ties_follow_the_library(joined):
    # Equal scores nearly everywhere; with "a▁b" no chunk may be solved apart.
    pieces = [("<unk>", 0.0), *((p, -1.0) for p in ["a", "b", "ab", "ba", "aab", "▁", "▁a"]), ("bb", -2.0), ("abab", -3.0)]
    pieces += [("<0x63>", -5.0)] + ([("a▁b", -1.0)] if joined else [])
    ours, library = unigram.Unigram(pieces), library_model(pieces)
    assert ours.splits is not joined

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet="abcd ", min_size=1, max_size=14))
    def same(text):
        marked = "▁" + text.replace(" ", "▁")
        assert ours.count(text)[1] == len(library.encode(marked).ids), text

    same()


# Shards


def test_shards_are_exact_and_rerun(spark, messy, messy_rows, empty):
    got = sharding.shuffle_into_shards(messy.repartition(5), 4)
    assert collections.Counter(got.columns) == collections.Counter(messy.columns)
    rows = got.collect()
    sizes = collections.Counter(r.shard for r in rows)
    assert sorted(sizes.values()) == [7, 7, 7, 8] and sum(sizes.values()) == len(messy_rows)
    for k, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(n))
    texts = collections.Counter((r.doc_id, r.text) for r in rows)
    assert texts == collections.Counter((r[0], r[1]) for r in messy_rows)
    assert sharding.shuffle_into_shards(empty, 4).count() == 0


def test_shuffle_is_uniform(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_ROWS", 8)
    df = spark.range(0, 240, 1, 6)
    first = {r.id: (r.shard, r.slot) for r in sharding.shuffle_into_shards(df, 4).collect()}
    assert first == {r.id: (r.shard, r.slot) for r in sharding.shuffle_into_shards(df, 4).collect()}
    moved = np.array([first[i][0] * 60 + first[i][1] for i in range(240)])
    assert sorted(moved) == list(range(240))
    assert abs(np.corrcoef(np.arange(240), moved)[0, 1]) < 0.25
    table = np.histogram2d(np.arange(240) // 40, moved // 60, bins=(6, 4))[0]
    assert ((table - 10) ** 2 / 10).sum() < 40


def test_hypergeometric_draws():
    rng = np.random.default_rng(1)
    ours = np.array([sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)])
    theirs = rng.hypergeometric(30, 70, 20, size=4000)
    assert abs(ours.mean() - 6) < 0.15 and abs(ours.var() - theirs.var()) < 0.4
    for good, bad, n in ((0, 5, 3), (5, 0, 3), (5, 5, 10), (3, 4, 0)):
        assert max(0, n - bad) <= sharding.hypergeometric(rng, good, bad, n) <= min(good, n)
    big = [sharding.hypergeometric(rng, 4 * 10**10, 6 * 10**10, 10**9) for _ in range(20)]
    assert abs(np.mean(big) - 4e8) < 4 * 15_500 / math.sqrt(20) * 2
    assert sum(sharding.draw(rng, [5, 0, 7], 12)) == 12


# Token shards


def test_grammars_round_trip():
    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.integers(0, 3), max_size=200), st.integers(0, 210), st.integers(0, 80))
    def same(ids, start, n):
        ids = np.array(ids * 3, dtype=np.uint32)
        base, rules, tokens, symbols = repair.compress(ids, min_count=2)
        assert (repair.expand(symbols, base, rules) == ids).all()
        for rule, size in zip(rules, tokens, strict=True):
            assert len(repair.expand(rule, base, rules)) == size
        if len(ids):
            block = repair.Block(repair._row(0, 0, [1], [ids.astype("<u4").tobytes()]))
            assert (block.decode() == ids).all()
            assert (block.decode_range(min(start, len(ids)), n) == ids[start : start + n]).all()

    same()
    ids = np.random.default_rng(3).zipf(1.3, 60_000).clip(max=300).astype(np.uint32)
    block = repair.Block(repair._row(0, 0, [1], [ids.astype("<u4").tobytes()]))
    assert len(block.symbols) < 0.8 * len(ids)
    for start in (0, 1, 1023, 30_000, 59_999):
        assert (block.decode_range(start, 2_000) == ids[start : start + 2_000]).all()


def test_shards_read_back(spark, messy, messy_rows, empty):
    path = scratch_path(spark, "shards")
    repair.write_shards(messy, path, BYTES, block_tokens=500)
    assert spark.read.parquet(path).count() > 3
    encoder = Tokenizer.from_file(BYTES)
    encoder.encode_special_tokens = True
    rows = sorted(repair.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in messy_rows), key=lambda i: (i is not None, i or 0))
    at, seen = 0, collections.Counter()
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
        seen[r.doc_id, zlib.crc32(r.ids)] += 1
    want = collections.Counter()
    for doc_id, text, *_ in messy_rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id, zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
    assert seen == want
    path = scratch_path(spark, "shards")
    repair.write_shards(empty, path, BYTES)
    assert repair.read_documents(spark, path).count() == 0


# SimHash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, ids, bits):
    low = list(ids)
    for _ in fps:
        low = [min((low[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= bits and low[j] is not None), default=None) for i in range(len(fps))]
    return low


def test_near_duplicates_of_documents(spark, messy, messy_rows, empty):
    rows = golay.near_duplicates(messy).collect()
    want_fps = [brute_fingerprint(r[1]) for r in messy_rows]
    fps = [r.fp & (1 << 64) - 1 for r in rows]
    assert collections.Counter(zip((r.doc_id for r in rows), fps, strict=True)) == collections.Counter(zip((r[0] for r in messy_rows), want_fps, strict=True))
    assert [r.component_id for r in rows] == components(fps, [r.doc_id for r in rows], 3)
    assert golay.near_duplicates(empty).count() == 0


def test_links_join_what_is_within_three_bits(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, size=40, dtype=np.int64).astype(np.uint64)
    fps = {0, int(centres[0])}
    for c in centres.tolist():
        for _ in range(25):
            # Chains of up to four bits, so some links only go through others.
            flips = rng.choice(64, size=int(rng.integers(0, 5)), replace=False)
            fps.add(c ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    docs = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "id long, fp long")
    from unmask.session import Scratch

    for block in (2_000, 3):
        links = golay.fingerprint_links(docs.select("fp"), 3, block)
        assert links.filter("bit_count(u ^ v) > 3").count() == 0
        with Scratch(spark, "t") as scratch:
            roots = {r.node: r.root for r in golay.connected(links, scratch).collect()}
        signed = [f - (1 << 64) if f >> 63 else f for f in fps]
        parent = {f: f for f in signed}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, f in enumerate(fps):
            for j in range(i):
                if (f ^ fps[j]).bit_count() <= 3:
                    a, b = find(signed[i]), find(signed[j])
                    parent[max(a, b)] = min(a, b)
        assert {f: roots.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_golay_decoder_is_perfect():
    table = golay.decoder()
    assert (np.bincount(table, minlength=4096) == 2048).all()
    words = np.random.default_rng(2).integers(0, 1 << 23, size=2000)
    keys, taken = golay.word_keys(words)
    assert set(taken.sum(axis=1).tolist()) <= {1, 6}
    flipped = words ^ (1 << 3) ^ (1 << 17)
    other, took = golay.word_keys(flipped)
    for a, t, b, u in zip(keys, taken, other, took, strict=True):
        assert set(a[t]) & set(b[u])
