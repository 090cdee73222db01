"""Text expressions: name normaliser, tokenisers and n-grams. All of them run in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations applied to lower-cased organisation names, in this order.
NAME_ABBREVIATIONS = (
    ("&", "and"),
    ("public limited company", "plc"),
    ("limited", "ltd"),
    ("united kingdom", "uk"),
    ("community interest company", "cic"),
)
# A trade name follows these markers; only the text before them counts.
TRADE_NAME_MARKERS = ("t/a", "trading as")
# Fixed value: characters dropped from names.
DROPPED_NAME_CHARACTERS = r"[)(.|\[\]{}'\-]"

WORD = r"[\p{L}\p{N}_]"


def normalise_name(name: Column) -> Column:
    """Comparable form of an organisation name, padded by one blank on each side.

    ``public limited company`` is abbreviated before ``limited`` so that it can apply at all.
    """
    out = F.lower(name)
    for marker in TRADE_NAME_MARKERS:
        out = F.substring_index(out, marker, 1)
    out = F.regexp_replace(out, r"[^\x00-\x7F]", "")
    out = F.regexp_replace(out, DROPPED_NAME_CHARACTERS, "")
    out = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), NAME_ABBREVIATIONS, out)
    out = F.trim(F.regexp_replace(out, " +", " "))
    return F.concat(F.lit(" "), out, F.lit(" "))


def _once(value: Column, build) -> Column:
    """``build(value)`` for an array result, with ``value`` computed a single time per row.

    A lambda evaluates every expression it mentions once per element; binding the value to a
    lambda variable first keeps the n-gram functions linear in the length of the text.
    """
    return F.flatten(F.transform(F.array(value), build))


def joined_texts(*columns: str) -> Column:
    """Searchable text of a row: its texts in order, one blank between, missing and blank ones left out."""
    texts = [F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string")) for c in columns]
    return F.concat_ws(" ", *texts)


def char_ngrams(text: Column, n: int = 3) -> Column:
    """Array of the character n-grams of a text, repeats kept; empty for short texts."""
    return _once(
        text,
        lambda t: F.when(
            F.length(t) >= n,
            F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.substring(t, i, n)),
        ).otherwise(F.array().cast("array<string>")),
    )


def ascii_words(text: Column) -> Column:
    """Lower-cased words; a word with any non-ASCII letter is left out as a whole."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD}+)"), 1)
    return F.filter(words, lambda w: w.rlike("^[a-z0-9_]+$"))


def words_of_two(text: Column) -> Column:
    """Lower-cased words of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD}{{2,}})"), 1)


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def word_ngrams(words: Column, low: int = 1, high: int = 3) -> Column:
    """All n-grams of ``low`` to ``high`` consecutive words, joined by one blank."""

    def of_length(ws: Column, n: int) -> Column:
        if n == 1:
            return ws
        return F.when(
            F.size(ws) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(ws) - (n - 1)),
                lambda i: F.array_join(F.slice(ws, i, n), " "),
            ),
        ).otherwise(F.array().cast("array<string>"))

    return _once(words, lambda ws: F.concat(*[of_length(ws, n) for n in range(low, high + 1)]))
