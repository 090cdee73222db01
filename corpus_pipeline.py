"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet
and read again as the next stage's docs; scratch tables go as soon as no stage reads them. All but the last keep
the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unmask.llm import fertility, golay, linedup, mixing, packing
from unmask.llm.common import WORD, quoted, table, word_count
from unmask.llm.queries import fertility_files
from unmask.session import durable, remove, scratch_made

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ROW = "_row"


_spent: list[str] = []


def stage(fn: Stage) -> Stage:
    """A stage that first removes what the stages before have left in the scratch folder and nothing reads.

    What ``docs`` still reads stays, so stages also work one after another without a table between them.
    """

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        needed = [path for path in _spent if any(path.rsplit("/", 1)[-1] in file for file in read)]
        for path in _spent:
            if path not in needed:
                remove(spark, path)
        before = set(scratch_made())
        out = fn(spark, docs, sf_dir)
        _spent[:] = needed + [path for path in scratch_made() if path not in before]
        return out

    return run_stage


def other_columns(docs: DataFrame) -> Column:
    """All columns but the text in one, so that no operator's columns can clash with them."""
    return F.struct(*(quoted(c) for c in docs.columns if c != "text")).alias(ROW)


def with_text(rows: DataFrame, columns: list[str], text: str, changed: bool = True) -> DataFrame:
    """The rows' columns again, with the text and, if it has changed, its length in n_chars."""
    new = {"text": quoted(text)}
    if changed:
        new["n_chars"] = F.char_length(quoted(text)).cast("long")
    return rows.select(*(new.get(c, F.col(f"{ROW}.`{c.replace('`', '``')}`")).alias(c) for c in columns))


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the tokenizer-fertility bands of their language.

    A null text fails. Columns named as a measure are kept as they came in.
    """
    judged = fertility.quality(docs.select(other_columns(docs), "text", "lang"), *fertility_files())
    return with_text(judged.filter("kept"), docs.columns, "text", changed=False)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; those that lose their last word go.

    A null text stays null, and the first copy of a run stays where it is.
    """
    out = linedup.drop_repeated_runs(docs.select(other_columns(docs), "doc_id", "text"))
    out = out.filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    return with_text(out, docs.columns, "text")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Rows are told apart by their place, not by their id: a document without an id, or one whose id another
    document bears too, stays unless a near duplicate of it does. Of equal ids the first row read stays.
    """
    return golay.first_of_groups(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, at most three times.

    The n-th copy of a document holds the words that the mix takes n times or more: the whole text where
    it takes all of them, else the taken stretches in order. Documents without a word are in no block and
    go. A null source is a source of its own.
    """
    size = word_count(F.col("text")).alias("size")
    mixed = mixing.mix(docs.select(other_columns(docs), "doc_id", "source", "text", size))
    part = F.struct("word_from", "n_words", "times")
    parts = mixed.pieces.groupBy("uid", "word_from", "n_words").agg(F.count("*").cast("int").alias("times"))
    parts = parts.groupBy(F.col("uid").alias("parts_uid")).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    rows = mixed.rows.join(parts, quoted(mixed.uid) == F.col("parts_uid"))
    most = F.array_max(F.transform("parts", lambda p: p["times"]))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), most)))
    rows = rows.withColumn("taken", F.filter("parts", lambda p: p["times"] >= F.col("copy")))
    rows = rows.withColumn("n", F.aggregate("taken", F.lit(0).cast("long"), lambda n, p: n + p["n_words"]))
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    # The words are bound to a variable, as an expression would be evaluated for every stretch.
    stretch = lambda ws: F.flatten(F.transform("taken", lambda p: F.slice(ws, (p["word_from"] + 1).cast("int"), p["n_words"].cast("int"))))
    cut = F.flatten(F.transform(F.array(words), stretch))
    cut = F.regexp_replace(F.array_join(cut, ""), r"^[\x20\x09-\x0D]+", "")
    rows = rows.withColumn("cut", F.when(F.col("n") == F.col("size"), F.col("text")).otherwise(cut))
    return with_text(rows, docs.columns, "cut")


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids with their places in sequences of at most 4096 tokens.

    ``row`` tells the copies of a document apart that the mix has made.
    """
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), narrow=True)
    return packed.placed("row", "doc_id", "start", "length", "ids", "doc_tokens")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]
# Fingerprints, vocabularies and pseudorandom draws have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs
