"""Classifiers. Naive Bayes takes any number of classes; trees take an attribute with few values."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unmask.operators.blocks import best_in_blocks, matrix
from unmask.operators.order import with_position
from unmask.session import durable

SCORE_DIGITS = 6

# Fixed values of the split: share of test rows in percent and the seed.
TEST_PERCENT = 33
SPLIT_SEED = 7


def split_by_key(df: DataFrame, key: str, test_percent: int = TEST_PERCENT, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``split`` ("train" or "test") from a digest of the key; a key always lands on one side."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))


def ordinal_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): alphabetical position of each distinct value, from 0.

    Values are sorted over many tasks; a task numbers its own and adds how many lie before its range.
    """
    values = df.select(F.col(column).cast("string").alias("value")).filter("value is not null").distinct()
    return with_position(values.orderBy("value")).select("value", (F.col("position") - 1).cast("int").alias("code"))


def gaussian_model(train: DataFrame, label: str, features: Column) -> DataFrame:
    """Gaussian naive Bayes: (label, prior, mean, variance), a row for each class, of which there may be any number.

    Variances are raised by 1e-9 of the largest variance of a feature.
    """
    rows = train.select(F.col(label).cast("string").alias("label"), features.alias("x")).filter("label is not null")
    long = rows.select("label", F.posexplode("x").alias("pos", "x"))
    widest = long.groupBy("pos").agg(F.var_pop("x").alias("v")).agg(F.max("v")).first()[0] or 0.0
    parts = long.groupBy("label", "pos").agg(F.avg("x").alias("mean"), (F.var_pop("x") + F.lit(widest * 1e-9)).alias("variance"))
    listed = F.sort_array(F.collect_list(F.struct("pos", "mean", "variance")))
    arrays = parts.groupBy("label").agg(listed.alias("l")).select("label", F.col("l.mean").alias("mean"), F.col("l.variance").alias("variance"))
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    prior = F.log(F.col("n") / F.lit(float(rows.count() or 1)))
    return arrays.join(sizes.select("label", prior.alias("prior")), "label")


def gaussian_predict(model: DataFrame, df: DataFrame, key: str, features: Column, keep: list[str] | None = None) -> DataFrame:
    """(key, *keep, predicted): the most likely class; ties go to the smaller label."""

    def likelihood(rows: pd.DataFrame, classes: pd.DataFrame) -> np.ndarray:
        x, mean, variance = matrix(rows["x"]), matrix(classes["mean"]), matrix(classes["variance"])
        out = classes["prior"].to_numpy() - 0.5 * np.log(2 * np.pi * variance).sum(axis=1)
        out = np.repeat(out[None, :], len(x), axis=0)
        for d in range(x.shape[1]):
            out -= (x[:, d, None] - mean[:, d]) ** 2 / (2 * variance[:, d])
        return out

    rows = df.select(F.col(key).alias("_q"), features.alias("x"))
    best = best_in_blocks(rows, durable(model, "classes").withColumnRenamed("label", "_id"), likelihood, 1, SCORE_DIGITS)
    return df.select(key, *(keep or [])).join(best.select(F.col("_q").alias(key), F.col("_id").alias("predicted")), key)


def _indexed(df: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    text = df.withColumn("_label", F.col(label).cast("string"))
    indexer = StringIndexer(inputCol="_label", outputCol="_y", stringOrderType="alphabetAsc", handleInvalid="skip")
    model = indexer.fit(text)
    return model.transform(text), model.labels


def forest_model(train: DataFrame, label: str, features: Column, trees: int = 20, depth: int = 6, bins: int = 32) -> PipelineModel:
    """Tree ensemble for several classes; the label is an attribute with few values, as trees hold counts of all."""
    indexed, labels = _indexed(train, label)
    indexed = indexed.withColumn("_x", array_to_vector(features))
    forest = RandomForestClassifier(
        featuresCol="_x", labelCol="_y", predictionCol="_p", numTrees=trees, maxDepth=depth, maxBins=bins, seed=SPLIT_SEED
    )
    return PipelineModel([forest.fit(indexed), IndexToString(inputCol="_p", outputCol="predicted", labels=labels)])


def boosted_model(train: DataFrame, label: str, features: Column, rounds: int = 20, depth: int = 4, bins: int = 32) -> PipelineModel:
    """Boosted trees, one class against the rest at a time; the label is an attribute with few values.

    Every round fits a tree to what the rounds before it left, over all rows; the model holds the trees alone.
    """
    indexed, labels = _indexed(train, label)
    indexed = durable(indexed.select(array_to_vector(features).alias("_x"), "_y"), "boosting-rows")
    boosting = GBTClassifier(featuresCol="_x", labelCol="_y", maxIter=rounds, maxDepth=depth, maxBins=bins, stepSize=0.3, seed=SPLIT_SEED)
    rest = OneVsRest(classifier=boosting, featuresCol="_x", labelCol="_y", predictionCol="_p")
    return PipelineModel([rest.fit(indexed), IndexToString(inputCol="_p", outputCol="predicted", labels=labels)])


def predict(model: PipelineModel, df: DataFrame, key: str, features: Column, keep: list[str] | None = None) -> DataFrame:
    out = model.transform(df.withColumn("_x", array_to_vector(features)))
    return out.select(key, *(keep or []), "predicted")


def categorical_bayes(
    train: DataFrame, test: DataFrame, key: str, label: str, features: list[str], alpha: float = 1.0
) -> DataFrame:
    """(key, predicted, score): categorical naive Bayes with additive smoothing.

    A class scores ``base(class)`` as if it had never been seen with any of the row's values,
    plus a gain for each value it was seen with. So a row is compared only with the classes that
    share a value with it, and with the one class of highest base. Rows are collapsed to their
    distinct feature values first. Values not seen in training add nothing.
    """
    train = train.select(F.col(label).cast("string").alias("_c"), *[F.col(f).cast("string").alias(f) for f in features])
    train = durable(train.filter("_c is not null"), "train")
    long = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in features])).alias("p")
    seen = train.select("_c", long).select("_c", "p.f", "p.v").filter("v is not null")
    seen = durable(seen.groupBy("_c", "f", "v").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    sizes = {r["f"]: r["k"] for r in seen.groupBy("f").agg(F.count_distinct("v").alias("k")).collect()}
    classes = train.groupBy("_c").agg(F.count(F.lit(1)).alias("nc"), *[F.count(f).alias(f"n_{f}") for f in features])
    total = train.count()
    base = F.log(F.col("nc") / F.lit(float(total)))
    for f in features:
        base = base + F.log(F.lit(alpha) / (F.col(f"n_{f}") + F.lit(alpha * sizes.get(f, 1))))
    classes = classes.select("_c", base.alias("base"))
    fallback = classes.agg(F.min_by("_c", F.struct(-F.round("base", 9), F.col("_c"))).alias("_c"), F.max("base").alias("base"))
    gains = seen.select("_c", "f", "v", F.log((F.col("n") + alpha) / F.lit(alpha)).alias("gain"))

    rows = test.select(F.col(key).alias("_k"), *[F.col(f).cast("string").alias(f) for f in features])
    rows = rows.withColumn("_pid", F.md5(F.to_json(F.struct(*features), {"ignoreNullFields": "false"})))
    profiles = rows.select("_pid", *features).distinct()
    probes = profiles.select("_pid", long).select("_pid", "p.f", "p.v").filter("v is not null")
    shared = probes.join(gains, ["f", "v"]).groupBy("_pid", "_c").agg(F.sum("gain").alias("gain"))
    scored = shared.join(classes, "_c").select("_pid", "_c", (F.col("base") + F.col("gain")).alias("score"))
    top = fallback.first()
    floor_class = profiles.select("_pid", F.lit(top["_c"]).alias("_c"), F.lit(top["base"]).alias("score"))
    # the fallback class may be listed twice; its fuller score is the larger one
    both = scored.unionByName(floor_class).groupBy("_pid", "_c").agg(F.max("score").alias("score"))
    order = Window.partitionBy("_pid").orderBy(F.desc(F.round("score", 6)), "_c")
    best = both.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return rows.select("_k", "_pid").join(best, "_pid").select(
        F.col("_k").alias(key), F.col("_c").alias("predicted"), F.round("score", 4).alias("score")
    )
