"""Quality rules from tokenizer fertility, after a few base rules.

Public vocabularies were fitted to ordinary text, so they cut ordinary text into long pieces. For every
document and vocabulary three figures are taken over its words: characters per token, the share of
byte-fallback tokens (bytes that spell part of a character), and the entropy of its tokens, relative
to that of 256 different tokens or of as many as the document has. A document is rejected when a figure lies outside the band
of its language, or of its script where the language is unknown.

Scale: one pass, row by row, no shuffle. Words are encoded once and remembered up to a limit in bytes.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unmask.llm.common import cols, fresh, quoted, word_chars
from unmask.llm.tokens import Store, held

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
# Characters of text that are measured at once.
SLICE = 1_000_000
# Entropy is set against that of so many different tokens, or of as many as there are if fewer.
ENTROPY_TOKENS = 256
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """What a clean document keeps to, for the two vocabularies."""

    piece_chars: tuple[float, float]
    byte_chars: tuple[float, float]
    fallback_share: float
    byte_share: float
    entropy: tuple[float, float] = (0.70, 2.0)


# Bands by language, then by script for other languages. Pieces of the first vocabulary are mostly
# Latin; scripts it spells in bytes have wide bands, where the second vocabulary, which knows more scripts,
# bounds the share of bytes, and entropy and length still tell.
BANDS = {
    "en": Band((1.70, 8.0), (1.95, 9.0), 0.10, 0.10),
    "de": Band((1.95, 8.0), (2.00, 9.0), 0.10, 0.10),
    "fr": Band((1.60, 8.0), (1.80, 9.0), 0.10, 0.10),
    "es": Band((1.70, 8.0), (1.85, 9.0), 0.10, 0.10),
    "Latin": Band((1.3, 9.0), (1.3, 10.0), 0.20, 0.20),
    "Greek": Band((0.5, 6.0), (0.5, 8.0), 0.60, 0.30),
    "Cyrillic": Band((0.8, 7.0), (0.8, 9.0), 0.40, 0.20),
    "Han": Band((0.3, 3.0), (0.3, 5.0), 1.00, 0.60),
    "Kana": Band((0.3, 3.0), (0.3, 5.0), 1.00, 0.60),
    "Hangul": Band((0.3, 3.0), (0.3, 5.0), 1.00, 0.60),
    "other": Band((0.25, 9.0), (0.25, 10.0), 1.00, 0.80),
}
# First code points of the blocks that tell scripts apart.
_BLOCKS = [
    (0x0000, "none"), (0x0041, "Latin"), (0x005B, "none"), (0x0061, "Latin"), (0x007B, "none"), (0x00C0, "Latin"),
    (0x0250, "other"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "none"), (0x2C00, "other"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"),
    (0xD7A4, "other"), (0xF900, "Han"), (0xFB00, "other"), (0x20000, "Han"), (0x30000, "other"),
]
_SCRIPTS = sorted({name for _, name in _BLOCKS})


def script_of(text: str) -> str:
    """Script of most letters; Latin where there are none."""
    if text.isascii():
        return "Latin"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    block = np.searchsorted([start for start, _ in _BLOCKS], points, side="right") - 1
    per_block = np.bincount(block, minlength=len(_BLOCKS))
    counts = dict.fromkeys(_SCRIPTS, 0)
    for (_, name), n in zip(_BLOCKS, per_block.tolist(), strict=True):
        counts[name] += n
    del counts["none"]
    best = max(counts, key=lambda s: (counts[s], s == "Latin"))
    return best if counts[best] else "Latin"


class Pieces:
    """A sentencepiece vocabulary; its byte tokens are the fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.fallback = np.array([model.is_byte(i) or model.is_unknown(i) for i in range(model.get_piece_size())])
        self.store = Store(lambda words: map(self._pack, model.encode([w.decode("utf-8", "replace") for w in words])))

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()


class Ranks:
    """A byte-level rank vocabulary; tokens that are no whole characters are the fallback."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.zeros(max(ranks.values()) + 1, dtype=bool)
        for token, i in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                self.fallback[i] = True
        one = encoding.encode_ordinary
        self.store = Store(lambda words: (Pieces._pack(one(" " + w.decode("utf-8", "replace"))) for w in words))


def vocabularies(pieces: str, ranks: str, pattern: str) -> tuple[Pieces, Ranks]:
    """Both vocabularies, read once in a worker process."""
    return held(("fertility", pieces, ranks, pattern), lambda: (Pieces(pieces), Ranks(ranks, pattern)))


def repeated_words(words: list) -> int:
    """Words that lie in a window of eight words found twice or more in the list."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(number) == len(words):
        return 0
    # Windows are named exactly: by pairs of names of halves, three times over.
    names, width = ids, 1
    while width < WINDOW:
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        names = np.unique(pairs, return_inverse=True)[1]
        width *= 2
        # A window found again begins with shorter ones found again; most texts have none.
        again = np.bincount(names)[names] > 1
        if not _long_run(again, WINDOW + 1 - width):
            return 0
    again = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += again
    edges[WINDOW : WINDOW + n] -= again
    return int((np.cumsum(edges)[: len(words)] > 0).sum())


def _long_run(flags: np.ndarray, n: int) -> bool:
    """Are ``n`` flags in a row set?"""
    ends = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return bool(len(ends)) and int((ends[1::2] - ends[::2]).max()) >= n


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


def figures(ids: np.ndarray, fallback: np.ndarray, chars: int) -> tuple[float, float, float]:
    """Characters per token, fallback share and relative entropy of a document's tokens."""
    n = len(ids)
    if not n:
        return 0.0, 0.0, 0.0
    counts = np.unique(ids, return_counts=True)[1]
    p = counts / n
    entropy = float(-(p * np.log2(p)).sum()) / math.log2(min(n, ENTROPY_TOKENS)) if n > 1 else 0.0
    return chars / n, float(fallback[ids].mean()), entropy + 0.0


def within(band: Band, piece: tuple, byte: tuple) -> bool:
    (p_chars, p_share, p_entropy), (b_chars, b_share, b_entropy) = piece, byte
    return (
        band.piece_chars[0] <= p_chars <= band.piece_chars[1]
        and band.byte_chars[0] <= b_chars <= band.byte_chars[1]
        and p_share <= band.fallback_share
        and b_share <= band.byte_share
        and all(band.entropy[0] <= e <= band.entropy[1] + 1e-9 for e in (p_entropy, b_entropy))
    )


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, band string, piece_chars double, piece_fallback double, "
    "piece_entropy double, byte_chars double, byte_fallback double, byte_entropy double"
)


def measure(texts: list[str], langs: list[str | None], pieces: Pieces, ranks: Ranks, bands: dict[str, Band]) -> list[tuple]:
    """A row of MEASURES for each text."""
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    chunks = set().union(*split)
    passing = [(v, v.store.learn(chunks)) for v in (pieces, ranks)]
    out = []
    for text, lang, words in zip(texts, langs, split, strict=True):
        n, chars = len(words), word_chars(text)
        repeats = repeated_words(words)
        failed = n < MIN_WORDS or 100 * repeats > MAX_REPEATED_PERCENT * n
        name = lang if lang in bands else script_of(text)
        both = [figures(np.frombuffer(b"".join(map(v.store.__getitem__, words)), dtype="<u4"), v.fallback, chars) for v in (pieces, ranks)]
        kept = not failed and within(bands.get(name, bands["other"]), *both)
        symbols = sum(map(text.count, _SYMBOLS))
        out.append((n, chars, symbols, duplicate_lines(text), repeats, failed, kept, name, *both[0], *both[1]))
    for v, some in passing:
        v.store.forget(some)
    return out


def quality(docs: DataFrame, pieces: str, ranks: str, pattern: str, bands: dict[str, Band] = BANDS) -> DataFrame:
    """``docs`` (doc_id, text, lang and any others) with the columns of MEASURES added.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows of eight. ``kept``:
    not failed, and every figure within its band. A null text is an empty one and fails. Rows are
    judged one by one, so repeated rows agree, and an empty table gives an empty one. A missing or
    unknown ``lang`` takes the script's band. Input columns named as a measure are replaced.
    """
    names = [f.split()[0] for f in MEASURES.split(", ")]
    docs = docs.select(*cols(docs, names))
    lang = quoted("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    key = fresh(docs, "_measures")

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        first, second = vocabularies(pieces, ranks, pattern)
        for texts, langs in batches:
            rows = []
            texts = [t if isinstance(t, str) else "" for t in texts]
            langs = [x if isinstance(x, str) else None for x in langs]
            start = size = 0
            for i, t in enumerate(texts):
                size += len(t)
                if size > SLICE or i + 1 == len(texts):
                    rows += measure(texts[start : i + 1], langs[start : i + 1], first, second, bands)
                    start, size = i + 1, 0
            yield pd.DataFrame(rows, columns=names)
        for v in (first, second):
            v.store.rest()

    measured = F.pandas_udf(run, MEASURES)
    out = docs.withColumn(key, measured(quoted("text").cast("string"), lang))
    return out.select(*cols(docs), *(F.col(f"`{key}`.{n}") for n in names))


