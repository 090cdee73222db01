"""Vector and classifier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from unmask.functions import text as tx
from unmask.operators import classify, profile, semantic
from unmask.plans.queries.registry import query
from unmask.plans.standins import documents, table
from unmask.session import durable, scratch_path
from unmask.sources import readers, writers


@query(
    "vector_mean",
    """
    select label, pos::int as pos, round(avg(x), 4) as mean from (
      select label, unnest(embedding)::double as x, unnest(range(0, len(embedding))) as pos from embeddings) group by all""",
)
def vector_mean(spark, folder):
    means = semantic.vector_mean(table(spark, folder, "embeddings"), ["label"], "embedding")
    return means.select("label", F.posexplode("embedding").alias("pos", "m")).select("label", "pos", F.round("m", 4).alias("mean"))


@query(
    "cosine_topk",
    """
    with e as (select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings),
    long as (select label, unnest(v) as x, unnest(range(0, len(v))) as pos from e),
    means as (select label, pos, avg(x) as m from long group by all),
    q as (select label, list(m order by pos) as qv from means group by label),
    s as (select q.label, e.vec_id, list_cosine_similarity(qv, v) as c from q, e)
    select label, vec_id, round(c, 4) as cosine, row_number() over (partition by label order by round(c, 6) desc, vec_id)::int as rank
    from s qualify row_number() over (partition by label order by round(c, 6) desc, vec_id) <= 5""",
)
def cosine_topk(spark, folder):
    """The five vectors nearest to the mean vector of each label."""
    rows = table(spark, folder, "embeddings")
    means = semantic.vector_mean(rows, ["label"], "embedding")
    out = semantic.cosine_top_k_many(rows, "vec_id", "embedding", means, "label", "embedding", 5)
    return out.withColumn("cosine", F.round("cosine", 4))


@query(
    "cosine_single",
    """
    with e as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings),
    q as (select list(m order by pos) as qv from (
      select pos, avg(x) as m from (select unnest(v) as x, unnest(range(0, len(v))) as pos from e) group by pos))
    select vec_id, round(list_cosine_similarity(qv, v), 4) as cosine from e, q
    order by round(list_cosine_similarity(qv, v), 6) desc, vec_id limit 5""",
)
def cosine_single(spark, folder):
    rows = table(spark, folder, "embeddings")
    mean = semantic.vector_mean(rows.withColumn("one", F.lit(1)), ["one"], "embedding").first()["embedding"]
    return semantic.cosine_top_k(rows, "vec_id", "embedding", mean, 5).withColumn("cosine", F.round("cosine", 4))


WORDS_SQL = r"""
words as (
  select doc_id, unnest(w) as term, unnest(range(0, len(w))) as pos from (
    select doc_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '[a-z0-9_]+')) as w from documents)),
frequent as materialized (
  select term, n, row_number() over ()::integer as id from (select term, count(*) as n from words group by term having count(*) >= 5)),
kept as materialized (select doc_id, pos, id from words join frequent using (term)),
once as materialized (
  select a, b, count(*) as n from (
    select id as a, unnest([LEADS]) as b from kept window w as (partition by doc_id order by pos)) where b is not null group by all),
both_ways as materialized (
  select a, b, sum(n)::double as n from (select a, b, n from once union all select b, a, n from once) group by all),
margins as materialized (
  select a as id, term, sum(both_ways.n)::double as m, ('0x' || substr(md5(term), 1, 8))::bigint as h
  from both_ways join frequent on frequent.id = a group by a, term),
vectors as materialized (
  select x.term, y.h % 100 as place,
    sum((case when (y.h // 100) % 2 = 0 then 1.0 else -1.0 end)::double
      * greatest(ln(o.n * (select sum(m) from margins) / (x.m * y.m)), 0.0)) as x
  from both_ways o join margins x on x.id = o.a join margins y on y.id = o.b group by all)""".replace("LEADS", ", ".join(f"lead(id, {i}) over w" for i in range(1, 11)))


def _word_vectors(spark, folder):
    return durable(semantic.word_vectors(documents(spark, folder), "doc_id", "text"), "word-vectors")


@query(
    "similar_words",
    f"""with {WORDS_SQL},
    norms as (select term, sqrt(sum(x * x)) as norm from vectors group by term),
    top_word as (select term from frequent order by n desc, term limit 1),
    own as materialized (select place, x from vectors where term = (select term from top_word)),
    dots as (
      select v.term, sum(v.x * q.x) as dot from vectors v join own q using (place)
      where v.term <> (select term from top_word) group by v.term),
    cosines as (
      select term, dot / (norm * (select norm from norms where term = (select term from top_word))) as c
      from dots join norms using (term) where norm > 0)
    select term, round(c, 4) as cosine from cosines order by round(c, 6) desc, term limit 10""",
)
def similar_words(spark, folder):
    """The ten words nearest to the most frequent one."""
    vectors = _word_vectors(spark, folder)
    word = vectors.orderBy(F.desc("n"), "term").first()["term"]
    return semantic.similar_words(vectors, word, 10).withColumn("cosine", F.round("cosine", 4))


@query(
    "similar_frequent_words",
    f"""with {WORDS_SQL},
    norms as (select term, sqrt(sum(x * x)) as norm from vectors group by term),
    top_word as (select term from frequent order by n desc, term limit 1),
    near_words as (select term from frequent where term in (select term from vectors) order by n desc, term limit 200),
    own as materialized (select place, x from vectors where term = (select term from top_word)),
    dots as (
      select v.term, sum(v.x * q.x) as dot from vectors v join own q using (place)
      where v.term <> (select term from top_word) and v.term in (select term from near_words) group by v.term)
    select term, round(dot / (norm * (select norm from norms where term = (select term from top_word))), 4) as cosine
    from dots join norms using (term) where norm > 0
    order by round(dot / (norm * (select norm from norms where term = (select term from top_word))), 6) desc, term limit 10""",
)
def similar_frequent_words(spark, folder):
    """The same among the 200 most frequent words."""
    vectors = _word_vectors(spark, folder)
    word = vectors.orderBy(F.desc("n"), "term").first()["term"]
    return semantic.similar_words(vectors, word, 10, restrict_vocab=200).withColumn("cosine", F.round("cosine", 4))


@query(
    "unseen_words",
    f"""with {WORDS_SQL},
    cut as (
      select term, '<' || term || '>' as t from (select term from frequent where term in (select term from vectors)
      union select distinct unnest(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z0-9_]+'))) from benchmark)),
    pieces as materialized (
      select term, ('0x' || substr(md5(g), 1, 8))::bigint % 32768 as piece
      from (select distinct term, substr(t, i, k) as g from (select term, t, k, unnest(range(1, length(t) - k + 2)) as i from cut, (select unnest([3, 4, 5]) as k) where length(t) >= k))),
    weights as materialized (select piece, sum(n)::double as n from pieces join frequent using (term) where term in (select term from vectors) group by piece),
    sums as materialized (
      select piece, place, sum(n * x) as x from pieces join frequent using (term) join vectors using (term) group by all),
    unseen as (select distinct term from pieces where term not in (select term from vectors)),
    known_pieces as (select term, piece, n from unseen join pieces using (term) join weights using (piece)),
    sizes as (select term, count(*)::double as many from known_pieces group by term),
    spelled as materialized (
      select term, place, sum(x / n) / any_value(many) as x from known_pieces join sums using (piece) join sizes using (term) group by all),
    near_words as (select term from frequent where term in (select term from vectors) order by n desc, term limit 500),
    near as materialized (select term, place, x from vectors where term in (select term from near_words)),
    dots as (select a.term, b.term as other, sum(a.x * b.x) as dot from spelled a join near b using (place) group by all),
    cosines as (
      select term, other, dot / (p.norm * q.norm) as c from dots join (select term, sqrt(sum(x * x)) as norm from spelled group by term) p using (term)
      join (select term as other, sqrt(sum(x * x)) as norm from near group by term) q using (other) where p.norm > 0 and q.norm > 0)
    select term, other, round(c, 4) as cosine from cosines qualify row_number() over (partition by term order by round(c, 6) desc, other) = 1""",
)
def unseen_words(spark, folder):
    """For each benchmark word that has no vector of its own, the nearest of the 500 most frequent words, by its pieces."""
    vectors = _word_vectors(spark, folder)
    asked = table(spark, folder, "benchmark").select(F.explode(tx.ascii_words(F.col("text"))).alias("term")).distinct()
    unseen = asked.join(vectors.select("term"), "term", "left_anti")
    subwords = durable(semantic.subword_vectors(vectors), "subwords")
    spelled = durable(semantic.spelled_vectors(unseen, "term", subwords), "spelled")
    frequent = vectors.orderBy(F.desc("n"), "term").limit(500).select(F.col("term").alias("other"), "vector")
    found = semantic.cosine_top_k_many(frequent, "other", "vector", spelled, "term", "vector", 1)
    return found.select("term", "other", F.round("cosine", 4).alias("cosine"))


@query(
    "semantic_search",
    f"""with {WORDS_SQL},
    counts as (select doc_id as id, term, count(*) as tf from words group by all),
    lengths as (select id, sum(tf)::double as len from counts group by id),
    totals as (select count(*)::double as n, avg(len) as mean from lengths),
    raw as (select term, ln((select n from totals) - count(*) + 0.5) - ln(count(*) + 0.5) as r from counts group by term),
    idf as (select term, case when r < 0 then 0.25 * (select avg(r) from raw) else r end as idf from raw),
    weighted as (
      select id, term, tf, idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / (select mean from totals))) as w
      from counts join idf using (term) join lengths using (id)),
    docs as (select id, place, sum(tf * w * x) as x from weighted join vectors using (term) group by all),
    asked as (
      select item_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) as term from benchmark),
    qs as (select item_id, place, sum(x) as x from asked join vectors using (term) group by all),
    cosines as (
      select item_id, id, dot / (a.norm * b.norm) as c from (
        select item_id, id, sum(q.x * d.x) as dot from qs q join docs d using (place) group by all)
      join (select item_id, sqrt(sum(x * x)) as norm from qs group by item_id) a using (item_id)
      join (select id, sqrt(sum(x * x)) as norm from docs group by id) b using (id) where a.norm > 0 and b.norm > 0)
    select item_id, id, round(c, 4) as cosine, (row_number() over (partition by item_id order by round(c, 6) desc, id))::int as rank
    from cosines qualify row_number() over (partition by item_id order by round(c, 6) desc, id) <= 5""",
)
def semantic_search(spark, folder):
    """The five documents nearest to each benchmark text."""
    vectors = _word_vectors(spark, folder)
    docs = durable(semantic.document_vectors(documents(spark, folder), "doc_id", "text", vectors.drop("n")), "document-vectors")
    asked = semantic.query_vectors(table(spark, folder, "benchmark"), "item_id", "text", vectors)
    found = semantic.cosine_top_k_many(docs, "id", "vector", asked, "item_id", "vector", 5)
    return found.withColumn("cosine", F.round("cosine", 4))


GAUSS_SQL = """
x as (select vec_id, label, unnest(embedding)::double as v, unnest(range(0, len(embedding))) as pos from embeddings),
eps as (select max(s) * 1e-9 as e from (select var_pop(v) as s from x group by pos)),
c as (select label, pos, avg(v) as mu, var_pop(v) + (select e from eps) as s2 from x group by all),
prior as (select label, ln(count(*) / (select count(*) from embeddings)) as p from embeddings group by label),
score as (select x.vec_id, c.label, sum(-0.5 * ln(2 * pi() * s2) - (v - mu) * (v - mu) / (2 * s2)) as s
          from x join c using (pos) group by all),
best as (select vec_id, label::varchar as predicted from score join prior using (label)
         qualify row_number() over (partition by vec_id order by s + p desc, label) = 1)"""


def _gaussian(spark, folder):
    rows = table(spark, folder, "embeddings")
    features = F.col("embedding").cast("array<double>")
    model = classify.gaussian_model(rows, "label", features)
    return classify.gaussian_predict(model, rows, "vec_id", features, ["label"])


@query(
    "gaussian_nb_codes",
    """
    with x as (select p_partkey, p_type || ' ' || p_size as label, p_retailprice as v, 0 as pos from part
               union all select p_partkey, p_type || ' ' || p_size, p_size, 1 from part),
    eps as (select max(s) * 1e-9 as e from (select var_pop(v) as s from x group by pos)),
    c as (select label, pos, avg(v) as mu, var_pop(v) + (select e from eps) as s2 from x group by all),
    prior as (select label, ln(count(*) / (select count(*) from part)) as p from x where pos = 0 group by label),
    score as (select x.p_partkey, c.label, sum(-0.5 * ln(2 * pi() * s2) - (v - mu) * (v - mu) / (2 * s2)) as s from x join c using (pos) group by all)
    select p_partkey, label as predicted from score join prior using (label)
    qualify row_number() over (partition by p_partkey order by round(s + p, 6) desc, label) = 1""",
)
def gaussian_nb_codes(spark, folder):
    """A label with hundreds of values, most of them rare, as stock codes are."""
    part = table(spark, folder, "part").withColumn("label", F.concat_ws(" ", "p_type", "p_size"))
    features = F.array(F.col("p_retailprice"), F.col("p_size").cast("double"))
    return classify.gaussian_predict(classify.gaussian_model(part, "label", features), part, "p_partkey", features)


@query("gaussian_nb", f"with {GAUSS_SQL} select vec_id, label, predicted from best join embeddings using (vec_id)")
def gaussian_nb(spark, folder):
    return _gaussian(spark, folder)


@query(
    "nb_accuracy",
    f"""with {GAUSS_SQL}
    select count(*) as n_rows, count_if(label::varchar <> predicted)::bigint as n_wrong,
           round(avg((label::varchar = predicted)::int), 4) as accuracy from best join embeddings using (vec_id)""",
)
def nb_accuracy(spark, folder):
    rows = _gaussian(spark, folder).withColumn("label", F.col("label").cast("string"))
    return profile.accuracy(rows, "label", "predicted")


@query(
    "categorical_nb",
    """
    with cls as (select p_type, count(*) as nc from part group by 1),
    names as (select p_type, p_name, count(*) as n from part group by all),
    brands as (select p_type, p_brand, count(*) as n from part group by all),
    scored as (
      select p.p_partkey, cls.p_type as predicted, ln(nc / (select count(*) from part))
        + ln((coalesce(a.n, 0) + 1) / (nc + (select count(distinct p_name) from part)))
        + ln((coalesce(b.n, 0) + 1) / (nc + (select count(distinct p_brand) from part))) as s
      from part p cross join cls
      left join names a on a.p_type = cls.p_type and a.p_name = p.p_name
      left join brands b on b.p_type = cls.p_type and b.p_brand = p.p_brand)
    select p_partkey, predicted, round(s, 4) as score from scored
    qualify row_number() over (partition by p_partkey order by round(s, 6) desc, predicted) = 1""",
)
def categorical_nb(spark, folder):
    part = table(spark, folder, "part")
    return classify.categorical_bayes(part, part, "p_partkey", "p_type", ["p_name", "p_brand"])


@query(
    "train_test_split",
    """
    select vec_id, case when ('0x' || substr(md5('7:' || vec_id), 1, 8))::bigint % 100 < 33 then 'test' else 'train' end as split
    from embeddings""",
)
def train_test_split(spark, folder):
    return classify.split_by_key(table(spark, folder, "embeddings"), "vec_id").select("vec_id", "split")


@query(
    "ordinal_codes",
    "select p_brand as value, (row_number() over (order by p_brand) - 1)::int as code from (select distinct p_brand from part)",
)
def ordinal_codes(spark, folder):
    return classify.ordinal_codes(table(spark, folder, "part"), "p_brand")


@query(
    "tree_classifier",
    """select p_partkey, case when p_size <= 15 then 'small' when p_size <= 35 then 'middle' else 'large' end as size_class,
              case when p_size <= 15 then 'small' when p_size <= 35 then 'middle' else 'large' end as predicted from part""",
)
def tree_classifier(spark, folder):
    """A class that one column decides, learned by a tree with a bin for each value; saved and loaded before use."""
    size = F.col("p_size")
    label = F.when(size <= 15, "small").when(size <= 35, "middle").otherwise("large")
    part = table(spark, folder, "part").withColumn("size_class", label)
    features = F.array(size.cast("double"))
    path = scratch_path(spark, "model")
    writers.save_model(classify.forest_model(part, "size_class", features, trees=1, bins=64), path)
    return classify.predict(readers.load_model(path), part, "p_partkey", features, ["size_class"])


@query(
    "boosted_trees",
    """
    with x as (
      select p_partkey, case when p_size > 25 and p_retailprice * 10 % 100 >= 50 then 'both' when p_size > 25 or p_retailprice * 10 % 100 >= 50 then 'one' else 'none' end as kind,
        ('0x' || substr(md5('7:' || p_partkey), 1, 8))::bigint % 100 < 33 as held_out from part)
    select kind, count(*) as n_held_out, true as accurate from x where held_out group by kind""",
)
def boosted_trees(spark, folder):
    """A class that two columns decide together, learned on the train rows; is it told on 95 of 100 held-out rows of each class?"""
    size, tail = F.col("p_size"), F.col("p_retailprice") * 10 % 100
    kind = F.when((size > 25) & (tail >= 50), "both").when((size > 25) | (tail >= 50), "one").otherwise("none")
    part = classify.split_by_key(table(spark, folder, "part").withColumn("kind", kind), "p_partkey")
    features = F.array(size.cast("double"), tail.cast("double"), F.col("p_partkey").cast("double"))
    model = classify.boosted_model(part.filter("split = 'train'"), "kind", features, rounds=12, depth=3, bins=64)
    told = classify.predict(model, part.filter("split = 'test'"), "p_partkey", features, ["kind"])
    share = F.avg((F.col("kind") == F.col("predicted")).cast("double"))
    return told.groupBy("kind").agg(F.count(F.lit(1)).alias("n_held_out"), (share >= 0.95).alias("accurate"))
