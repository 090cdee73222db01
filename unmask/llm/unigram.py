"""Token counts of a unigram vocabulary without its tokens: count-only Viterbi.

An Aho-Corasick automaton over the vocabulary lists every piece that ends at each place of a text, and
dynamic programming carries the best score and its number of pieces from place to place. Nothing is
traced back.

Tie rules are those of the ``tokenizers`` library's unigram model: pieces are tried by start, then by
length, and one replaces another only if its score is strictly greater, so the earliest start stays. A
character that no one-character piece covers may be unknown, at the lowest score less ten; a run of
unknown characters counts as the bytes that spell it if the vocabulary has them all, else as one.

Where no piece goes on past the start of a word, texts fall into chunks that are solved apart, and
equal chunks once: the same count and, for scores whose sums are exact, the same ties.

Scale: one pass, row by row, no shuffle. The store of solved chunks is bounded in number and length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unmask.llm.common import cols, fresh, quoted
from unmask.llm.tokens import held

UNKNOWN_PENALTY = 10.0
# Solved chunks that a worker remembers, and the longest of them: about 40 MB.
STORE = 200_000
LONGEST_CHUNK = 32
SPACE = "▁"
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Unigram:
    """A vocabulary of (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True, store: int = STORE):
        self.automaton = ahocorasick.Automaton()
        for piece, score in reversed(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown_score = min(score for _, score in pieces) - UNKNOWN_PENALTY
        names = {piece for piece, _ in pieces}
        self.known_bytes = {b for b in range(256) if byte_fallback and f"<0x{b:02X}>" in names}
        # Pieces with a word start after another character would join chunks.
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in names)
        self.store: dict[str, tuple[float, int]] = {}
        self.limit = store

    @classmethod
    def from_file(cls, path: str) -> Unigram:
        """The pieces of a sentencepiece file with the scores it holds."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
        return cls(pieces)

    def solve(self, text: str) -> tuple[float, int]:
        """Best score of a text, and the tokens of the segmentation that the tie rules choose."""
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (length, score) in self.automaton.iter(text):
            ends[end + 1 - length].append((length, score))
        best = [None] * (n + 1)
        # Tokens so far, and the bytes of the unknown run that ends here (none: not in a run).
        count, run = [0] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for at in range(n):
            here, alone = best[at], False
            for length, score in ends[at]:
                to, value = at + length, here + score
                alone = alone or length == 1
                if best[to] is None or value > best[to]:
                    best[to], count[to], run[to] = value, count[at] + self._spelled(run[at]) + 1, None
            if not alone:
                value = here + self.unknown_score
                if best[at + 1] is None or value > best[at + 1]:
                    best[at + 1], count[at + 1] = value, count[at]
                    run[at + 1] = (run[at] or b"") + text[at].encode("utf-8", "surrogatepass")
        return best[n], count[n] + self._spelled(run[n])

    def _spelled(self, run: bytes | None) -> int:
        if run is None:
            return 0
        return len(run) if self.known_bytes.issuperset(run) else 1

    def count(self, text: str) -> tuple[float, int]:
        """Score and tokens of a whole text; spaces and its start are word starts."""
        if not text:
            return 0.0, 0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.splits:
            return self.solve(marked)
        score, tokens = 0.0, 0
        for chunk in _CHUNK.findall(marked):
            solved = self.store.get(chunk)
            if solved is None:
                solved = self.solve(chunk)
                if len(chunk) <= LONGEST_CHUNK and len(self.store) < self.limit:
                    self.store[chunk] = solved
            score += solved[0]
            tokens += solved[1]
        return score, tokens


def model(path: str) -> Unigram:
    """One model for each file and worker process."""
    return held(("unigram", path), lambda: Unigram.from_file(path))


def token_counts(docs: DataFrame, vocabulary: str, tokens: str = "n_tokens", score: str = "best_score") -> DataFrame:
    """``docs`` (text and any others) with the token count and best score of every whole text.

    A null text is an empty one: no token, score 0. Rows are counted one by one, so ties and repeated
    rows agree, and an empty table gives an empty one. Input columns named as the two are replaced.
    """
    docs = docs.select(*cols(docs, (tokens, score)))
    key = fresh(docs, "_counted")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [model(vocabulary).count(t or "") for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())], names=["n", "s"]
            )

    counted = F.arrow_udf(run, "n long, s double")
    out = docs.withColumn(key, counted(quoted("text").cast("string")))
    return out.select(*cols(docs), F.col(f"`{key}`.n").alias(tokens), F.col(f"`{key}`.s").alias(score))
