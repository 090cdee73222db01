"""Edit-distance join.

Score of two names: ``round(100 * (1 - edits / longer length))``. A score threshold allows a
number of edits that grows with the length, and each edit can destroy at most q of a name's
q-grams. So two names that reach the threshold must share one of their rarest q * edits + 1
grams: the join runs on those rare grams only and checks the distance inside the join. Where one edit is
allowed at most, grams of numbered names are all frequent; such pairs are joined by what is left of both names
without one place, which few others share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unmask.operators.skew import ROWS_PER_SALT, salted_join, salted_keys
from unmask.session import durable

# Down to which threshold q-grams of a size are guaranteed to leave a name at least one survivor.
LOWEST_FOR_GRAM_SIZE = {3: 76, 2: 68, 1: 51}
LOWEST_THRESHOLD = 51
ONE_EDIT = 1


def score(edits: Column, left: Column, right: Column) -> Column:
    longer = F.greatest(F.length(left), F.length(right))
    return F.round(F.lit(100.0) * (F.lit(1.0) - edits / longer)).cast("int")


def _grams(name: Column, q: int) -> Column:
    """q-grams of the padded name, each with its occurrence number, so that none repeats."""
    padded = F.concat(F.lit("\u0001" * (q - 1)), name, F.lit("\u0002" * (q - 1)))

    def numbered(text: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.length(text) - (q - 1)), lambda i: F.substring(text, i, q))
        return F.flatten(
            F.transform(
                F.array(grams),
                lambda g: F.transform(
                    g, lambda x, i: F.concat(x, F.size(F.filter(F.slice(g, 1, i + 1), lambda y: y == x)).cast("string"))
                ),
            )
        )

    return F.flatten(F.transform(F.array(padded), numbered))


def fuzzy_pairs(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    threshold: int = 90,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """(left_name, right_name, score): all distinct name pairs that reach the threshold."""
    if not LOWEST_THRESHOLD <= threshold <= 100:
        raise ValueError(f"threshold must lie between {LOWEST_THRESHOLD} and 100")
    q = max(size for size, lowest in LOWEST_FOR_GRAM_SIZE.items() if threshold >= lowest)
    share = (100.5 - threshold) / 100.0

    def names(df: DataFrame, column: str, label: str) -> DataFrame:
        return durable(df.select(F.col(column).alias(label)).filter(F.length(label) > 0).distinct(), "names")

    left_names, right_names = names(left, left_key, "left_name"), names(right, right_key, "right_name")
    longest_left = left_names.agg(F.max(F.length("left_name"))).first()[0] or 0
    longest_right = right_names.agg(F.max(F.length("right_name"))).first()[0] or 0

    def most_edits(label: str, longest_other: int) -> Column:
        # the longer of two names that can still match, hence the most edits a match can have
        longer = F.least(F.length(label) / (1.0 - share), F.greatest(F.length(label), F.lit(longest_other)))
        return F.floor(F.lit(share) * longer + 1e-9)

    a, b = F.col("left_name"), F.col("right_name")
    allowed = F.floor(F.lit(share) * F.greatest(F.length(a), F.length(b)) + 1e-9).cast("int")
    edits = F.call_function("levenshtein", a, b, allowed)
    near = (F.abs(F.length(a) - F.length(b)) <= allowed) & (edits >= 0)

    def met(lefts: DataFrame, rights: DataFrame, key: str) -> DataFrame:
        rights = durable(rights, "right-signatures")
        salted = salted_keys(rights.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, "n", rows_per_salt)
        return salted_join(lefts, rights, key, salted, "right_name", near, rows_per_salt).select("left_name", "right_name")

    # Pairs that allow one edit: each of them agrees once a place, or none, is left out on both sides.
    def without_a_place(df: DataFrame, label: str) -> DataFrame:
        short = df.filter(F.floor(F.lit(share) * F.length(label) + 1e-9) <= ONE_EDIT)
        rest = lambda i: F.xxhash64(F.concat(F.substring(label, F.lit(1), i), F.substring(F.col(label), i + 2, F.length(label))))
        places = F.sequence(F.lit(0), F.length(label))
        return short.select(label, F.explode(F.array_distinct(F.transform(places, rest))).alias("rest"))

    by_place = met(without_a_place(left_names, "left_name"), without_a_place(right_names, "right_name"), "rest")

    # Pairs that allow more edits share a rare gram.
    def grams(df: DataFrame, label: str, longest_other: int) -> DataFrame:
        return df.filter(most_edits(label, longest_other) > ONE_EDIT).withColumn("gram", F.explode(_grams(F.col(label), q)))

    lefts = durable(grams(left_names, "left_name", longest_right), "left-grams")
    rights = durable(grams(right_names, "right_name", longest_left), "right-grams")
    frequency = durable(rights.groupBy("gram").agg(F.count(F.lit(1)).alias("df")), "gram-counts")

    def rarest(grams: DataFrame, label: str, longest_other: int) -> DataFrame:
        order = Window.partitionBy(label).orderBy("_df", "gram")
        out = grams.join(frequency, "gram", "left").withColumn("_df", F.coalesce("df", F.lit(0)))
        out = out.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= q * most_edits(label, longest_other) + 1)
        return out.filter("_df > 0").select("gram", label)

    by_gram = met(rarest(lefts, "left_name", longest_right), rarest(rights, "right_name", longest_left), "gram")
    pairs = by_place.unionByName(by_gram).distinct()
    return pairs.withColumn("score", score(F.levenshtein(a, b), a, b))


def fuzzy_join(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    threshold: int = 90,
    limit: int = 1,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Each left row with its best ``limit`` right names at or above the threshold.

    ``matches`` joins them by a comma, best first (equal scores by name); it is empty for none.
    """
    pairs = fuzzy_pairs(left, left_key, right, right_key, threshold, rows_per_salt)
    order = Window.partitionBy("left_name").orderBy(F.desc("score"), "right_name")
    best = pairs.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= limit)
    listed = best.groupBy("left_name").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_rank", "right_name"))), lambda r: r["right_name"]), ", "
        ).alias("matches"),
        F.max("score").alias("best_score"),
    )
    out = left.join(listed, left[left_key] == listed["left_name"], "left").drop("left_name")
    return out.withColumn("matches", F.coalesce("matches", F.lit("")))


# Fixed value: what a score of rearranged words counts beside one of the names as they are.
TOKEN_SHARE = 0.95
SCORERS = ("ratio", "token_sort", "token_set", "weighted")


def _tokens(name: Column) -> Column:
    """Distinct words of a name, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")))


def token_sort_pairs(left: DataFrame, left_key: str, right: DataFrame, right_key: str, threshold: int, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(left_name, right_name, score): pairs whose sorted words reach the threshold by edit distance."""

    def sides(df: DataFrame, key: str, label: str) -> DataFrame:
        words = F.filter(F.split(F.lower(F.col(key)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
        out = df.select(F.col(key).alias(label), F.array_join(F.array_sort(words), " ").alias("sorted"))
        return durable(out.filter("sorted <> ''").distinct(), "sorted-names")

    lefts, rights = sides(left, left_key, "left_name"), sides(right, right_key, "right_name")
    pairs = fuzzy_pairs(lefts, "sorted", rights, "sorted", threshold, rows_per_salt)
    pairs = pairs.select(F.col("left_name").alias("x"), F.col("right_name").alias("y"), "score")
    out = pairs.join(lefts, F.col("x") == F.col("sorted")).drop("sorted")
    return out.join(rights, F.col("y") == F.col("sorted")).select("left_name", "right_name", "score")


def token_set_pairs(left: DataFrame, left_key: str, right: DataFrame, right_key: str, threshold: int, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(left_name, right_name, score): pairs where shared words spell enough of one of the names.

    The score is 100 times the characters of the shared words, by those of the shorter spelled set. A pair that
    reaches the threshold shares a word of the shorter side's rarest ones, which are as many as spell more than
    the rest that may be missing; so those words are joined, with all words of the other side.
    """

    def sides(df: DataFrame, key: str, label: str) -> DataFrame:
        out = df.select(F.col(key).alias(label), _tokens(F.col(key)).alias("words")).filter(F.size("words") > 0)
        size = F.aggregate("words", F.lit(0), lambda s, w: s + F.length(w))
        return durable(out.distinct().withColumn("size", size), "token-sets")

    lefts, rights = sides(left, left_key, "left_name"), sides(right, right_key, "right_name")
    share = (100.5 - threshold) / 100.0
    words = [side.select(label, "words", "size", F.explode("words").alias("word")) for side, label in ((lefts, "left_name"), (rights, "right_name"))]
    counts = durable(reduce(DataFrame.unionByName, [w.select("word") for w in words]).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")

    def rarest(rows: DataFrame, label: str) -> DataFrame:
        order = Window.partitionBy(label).orderBy("n", "word").rowsBetween(Window.unboundedPreceding, -1)
        earlier = F.coalesce(F.sum(F.length("word")).over(order), F.lit(0))
        return rows.join(counts, "word").withColumn("earlier", earlier).filter(F.col("earlier") <= F.lit(share) * F.col("size")).drop("earlier", "n")

    def met(few: DataFrame, all_: DataFrame, few_label: str, all_label: str) -> DataFrame:
        few = few.select("word", few_label, F.col("words").alias("few"), F.col("size").alias("few_size"))
        all_ = durable(all_.select("word", all_label, F.col("words").alias("many"), F.col("size").alias("many_size")), "words")
        salted = salted_keys(all_.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word", "n", rows_per_salt)
        pairs = salted_join(few, all_, "word", salted, all_label, F.col("few_size") <= F.col("many_size"), rows_per_salt)
        shared = F.aggregate(F.array_intersect("few", "many"), F.lit(0), lambda s, w: s + F.length(w))
        score = F.round(F.lit(100.0) * shared / F.col("few_size")).cast("int")
        return pairs.select("left_name", "right_name", score.alias("score")).filter(F.col("score") >= threshold)

    both = met(rarest(words[0], "left_name"), words[1], "left_name", "right_name")
    both = both.unionByName(met(rarest(words[1], "right_name"), words[0], "right_name", "left_name"))
    return both.groupBy("left_name", "right_name").agg(F.max("score").alias("score"))


def scored_pairs(left: DataFrame, left_key: str, right: DataFrame, right_key: str, threshold: int, scorer: str = "weighted") -> DataFrame:
    """(left_name, right_name, score): pairs that reach the threshold under a scorer.

    ``weighted`` is the best of the edit score and ``TOKEN_SHARE`` of the two token scores, rounded.
    """
    if scorer not in SCORERS:
        raise ValueError(f"scorer must be one of {SCORERS}")
    args = (left, left_key, right, right_key)
    single = {"ratio": fuzzy_pairs, "token_sort": token_sort_pairs, "token_set": token_set_pairs}
    if scorer in single:
        return single[scorer](*args, threshold)
    # A token score counts less, so it has to be higher for the same threshold.
    needed = -int(-(threshold - 0.5) / TOKEN_SHARE // 1)
    parts = [fuzzy_pairs(*args, threshold)]
    if needed <= 100:
        lower = F.round(F.col("score") * TOKEN_SHARE).cast("int").alias("score")
        parts += [f(*args, needed).select("left_name", "right_name", lower) for f in (token_sort_pairs, token_set_pairs)]
    best = reduce(DataFrame.unionByName, parts).groupBy("left_name", "right_name").agg(F.max("score").alias("score"))
    return best.filter(F.col("score") >= threshold)
