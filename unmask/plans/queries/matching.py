"""Structural, exact and fuzzy matching queries with their assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from unmask.operators import assemble, exact, fuzzy, profile, structural
from unmask.operators.order import with_position
from unmask.plans import nightly
from unmask.plans.queries.registry import query
from unmask.plans.standins import documents, part_catalogue, table

CATALOGUE_SQL = """
catalogue as (
  select p_partkey::varchar as stockcode, p_name as description, p_type as varietal, p_brand as bottle_closure,
         p_retailprice as price, p_size as size, p_retailprice::decimal(12,2) as price_before,
         case when p_type <> 'PROMO' then (p_retailprice - p_size)::decimal(12,2) end as price_after,
         p_retailprice::decimal(12,2) as price_single, (p_retailprice - 2 * p_size)::decimal(12,2) as price_promo,
         p_size <= 40 as is_for_delivery, contains(p_name, 'widget') as mystery
  from part)"""

KNN_SQL = """
pairs as (
  select a.stockcode as stockcode_x, b.stockcode as stockcode_y,
         round(sqrt(power(a.price - b.price, 2) + power(a.size - b.size, 2)
               + 2 * (a.varietal <> b.varietal)::int + 2 * (a.bottle_closure <> b.bottle_closure)::int), 6) as distance
  from catalogue a, catalogue b where a.mystery and not b.mystery),
knn as (
  select stockcode_x, stockcode_y, distance, case when distance < 1.8 then 'Good' else 'Poor' end as match_level, 'KNN' as method
  from pairs qualify row_number() over (partition by stockcode_x order by distance, stockcode_y) = 1)"""


def _nearest(spark, folder, good_only=False):
    return structural.nearest_known(
        part_catalogue(spark, folder),
        "stockcode",
        "mystery",
        ["price", "size"],
        ["varietal", "bottle_closure"],
        good_only=good_only,
    )


@query("knn_structural", f"with {CATALOGUE_SQL}, {KNN_SQL} select * from knn")
def knn_structural(spark, folder):
    return _nearest(spark, folder)


@query("knn_good_only", f"with {CATALOGUE_SQL}, {KNN_SQL} select * from knn where match_level = 'Good'")
def knn_good_only(spark, folder):
    return _nearest(spark, folder, good_only=True)


@query(
    "one_hot_encoding",
    f"""with {CATALOGUE_SQL}
    select stockcode, coalesce(price_after::double, 0.0) as price_after, size::double as size,
      (varietal = 'PROMO')::int::double as varietal_PROMO, (varietal = 'SMALL')::int::double as varietal_SMALL
    from catalogue""",
)
def one_hot_encoding(spark, folder):
    encoded = structural.one_hot_columns(
        part_catalogue(spark, folder), ["price_after", "size"], {"varietal": ["PROMO", "SMALL"]}
    )
    return part_catalogue(spark, folder).select("stockcode", *encoded)


@query(
    "giveaway_filter",
    """
    with p as (select p_partkey, case when p_type = 'PROMO' then 'Wraps ' || p_name else p_name end as description,
                 nullif(case when p_size > 25 then p_name else 'Wraps of ' || p_brand end, 'blue bolt') as web_product_name,
                 p_size <= 40 as is_for_delivery from part)
    select *, 'giveaway' as method from p
    where web_product_name is not null and contains(description, 'Wraps') and not contains(web_product_name, 'Wraps') and is_for_delivery""",
)
def giveaway_filter(spark, folder):
    rows = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("Wraps "), "p_name")).otherwise(F.col("p_name")).alias("description"),
        F.nullif(
            F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.concat(F.lit("Wraps of "), "p_brand")), F.lit("blue bolt")
        ).alias("web_product_name"),
        (F.col("p_size") <= 40).alias("is_for_delivery"),
    )
    return exact.giveaway(rows)


TEXTS_SQL = """
rows as (
  select distinct doc_id, starts_with(source, 'src1') as mystery, 'desc_match' as method, sha256(text) as match_key
  from documents where trim(text) <> ''
  union all
  select distinct doc_id, starts_with(source, 'src1'), 'webdesc_match', sha256(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'))
  from documents where regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') <> '')"""
TEXT_METHODS = {"text": "desc_match", "letters": "webdesc_match"}


def _texts(spark, folder):
    return documents(spark, folder).withColumn("letters", F.regexp_replace(F.lower("text"), "[^a-z0-9]+", ""))


@query(
    "exact_text_match",
    f"""with {TEXTS_SQL},
    known as (select method, match_key, count(*) as n_known, min(doc_id) as stockcode_y from rows where not mystery group by all)
    select doc_id as stockcode_x, stockcode_y, method, 'Good' as match_level, match_key, n_known
    from rows join known using (method, match_key) where mystery""",
)
def exact_text_match(spark, folder):
    """One row for each mystery, method and shared text."""
    return exact.exact_text_match(_texts(spark, folder), "doc_id", "mystery", TEXT_METHODS)[0]


@query(
    "exact_text_members",
    f"""with {TEXTS_SQL}
    select method, match_key, doc_id as stockcode from rows
    where not mystery and (method, match_key) in (select (method, match_key) from rows where mystery)""",
)
def exact_text_members(spark, folder):
    """Every known product of the texts that mysteries share."""
    return exact.exact_text_match(_texts(spark, folder), "doc_id", "mystery", TEXT_METHODS)[1]


@query(
    "exact_text_groups",
    f"""with {TEXTS_SQL}
    select method, match_key, count_if(mystery)::bigint as n_mystery, count_if(not mystery)::bigint as n_known,
           min(case when not mystery then doc_id end) as first_known
    from rows group by method, match_key having count_if(mystery) > 0 and count_if(not mystery) > 0""",
)
def exact_text_groups(spark, folder):
    """Equal texts in linear size: one row per group of copies."""
    return exact.text_groups(_texts(spark, folder), "doc_id", "mystery", TEXT_METHODS)[1]


@query(
    "blocking_candidates",
    f"""with {CATALOGUE_SQL}
    select a.stockcode as stockcode_x, count(b.stockcode) as n_known from catalogue a left join catalogue b
      on not b.mystery and a.varietal = b.varietal and a.bottle_closure = b.bottle_closure and a.size = b.size
    where a.mystery group by 1""",
)
def blocking_candidates(spark, folder):
    return exact.candidate_counts(part_catalogue(spark, folder), "stockcode", "mystery", ["varietal", "bottle_closure", "size"])


ASSEMBLY_SQL = """
  x.stockcode as stockcode_x, k.stockcode_y, y.description, x.varietal, x.bottle_closure,
  x.price_before::double as price_before, x.price_after::double as price_after,
  round(x.price_before - x.price_after, 2)::double as savings"""


@query(
    "match_assembly",
    f"""with {CATALOGUE_SQL}, {KNN_SQL}
    select distinct {ASSEMBLY_SQL} from catalogue x join knn k on x.stockcode = k.stockcode_x and k.match_level = 'Good'
    left join catalogue y on y.stockcode = k.stockcode_y where x.is_for_delivery""",
)
def match_assembly(spark, folder):
    return assemble.assemble(part_catalogue(spark, folder), _nearest(spark, folder))


@query(
    "match_assembly_left",
    f"""with {CATALOGUE_SQL}, {KNN_SQL}
    select distinct {ASSEMBLY_SQL} from catalogue x left join knn k on x.stockcode = k.stockcode_x and k.match_level = 'Good'
    left join catalogue y on y.stockcode = k.stockcode_y where x.is_for_delivery""",
)
def match_assembly_left(spark, folder):
    return assemble.assemble(part_catalogue(spark, folder), _nearest(spark, folder), "left")


@query(
    "match_enriched",
    f"""with {CATALOGUE_SQL}, {KNN_SQL}
    select k.stockcode_x, k.stockcode_y, k.method, k.match_level, x.description as description_x, y.description as description_y,
           x.varietal as varietal_x, y.varietal as varietal_y, round(x.price_single - x.price_promo, 2)::double as savings
    from knn k join catalogue x on x.stockcode = k.stockcode_x and x.is_for_delivery join catalogue y on y.stockcode = k.stockcode_y""",
)
def match_enriched(spark, folder):
    return assemble.enrich_both(
        part_catalogue(spark, folder), _nearest(spark, folder), ["description", "varietal"], only_good=False
    )


@query(
    "match_order",
    f"""with {CATALOGUE_SQL}, {KNN_SQL}
    select k.stockcode_x, k.stockcode_y, row_number() over (
      order by k.match_level, round(x.price_single - x.price_promo, 2) desc nulls last, k.stockcode_x, k.stockcode_y) as position
    from knn k join catalogue x on x.stockcode = k.stockcode_x and x.is_for_delivery""",
)
def match_order(spark, folder):
    """The place of every match by level and savings."""
    return with_position(match_enriched(spark, folder)).select("stockcode_x", "stockcode_y", "position")


@query(
    "assembly_order",
    f"""with {CATALOGUE_SQL}, {KNN_SQL},
    rows as (
      select distinct {ASSEMBLY_SQL} from catalogue x join knn k on x.stockcode = k.stockcode_x and k.match_level = 'Good'
      left join catalogue y on y.stockcode = k.stockcode_y where x.is_for_delivery)
    select stockcode_x, stockcode_y, row_number() over (order by savings desc nulls last, stockcode_x, stockcode_y) as position from rows""",
)
def assembly_order(spark, folder):
    """The place of every result row by savings."""
    return with_position(match_assembly(spark, folder)).select("stockcode_x", "stockcode_y", "position")


@query(
    "text_match_enriched",
    """
    with rows as (select *, starts_with(source, 'src1') as mystery from documents),
    known as (select text, min(doc_id) as doc_id from rows where not mystery and trim(text) <> '' group by text)
    select a.doc_id as stockcode_x, b.doc_id as stockcode_y, 'desc_match' as method, 'Good' as match_level,
           a.lang as lang_x, b.lang as lang_y, (a.n_chars - length(a.source)) as savings
    from rows a join known k using (text) join rows b on b.doc_id = k.doc_id where a.mystery and a.n_chars > 100""",
)
def text_match_enriched(spark, folder):
    """Each mystery with the first known product of its text; the others are its members."""
    rows = documents(spark, folder).withColumn("stockcode", F.col("doc_id")).withColumn("is_for_delivery", F.col("n_chars") > 100)
    matches, _ = exact.exact_text_match(rows, "doc_id", "mystery", {"text": "desc_match"})
    return assemble.enrich_both(rows, matches, ["lang"], F.col("n_chars") - F.length("source"))


NIGHTLY_SQL = f"""{CATALOGUE_SQL}, {KNN_SQL},
texts as (
  select stockcode, mystery, 'desc_match' as method, varietal || ' ' || bottle_closure as match_key from catalogue
  union all select stockcode, mystery, 'rev_match', description || ' ' || size from catalogue)"""
NIGHTLY = nightly.MatchSettings(
    numerics=["price", "size"], nominals=["varietal", "bottle_closure"], texts={"rich_description": "desc_match", "review1_text": "rev_match"},
    closure="bottle_closure", before="price_before", after="price_after",
)


def _loads(spark, folder):
    """Two loads of the parts; the older one has other prices and no texts."""
    now = part_catalogue(spark, folder).withColumns(
        {
            "load_ts": F.lit("2024-05-02 04:00:00").cast("timestamp"),
            "rich_description": F.concat_ws(" ", "varietal", "bottle_closure"),
            "review1_text": F.concat_ws(" ", "description", "size"),
        }
    )
    blank = F.lit(None).cast("string")
    before = now.withColumns(
        {"load_ts": F.lit("2024-05-01 04:00:00").cast("timestamp"), "price": F.col("price") + 1, "rich_description": blank, "review1_text": blank}
    )
    return before.unionByName(now)


@query(
    "nightly_match",
    f"""with {NIGHTLY_SQL},
    firsts as (select method, match_key, min(stockcode) as stockcode_y from texts where not mystery group by all),
    matches as (
      select t.stockcode as stockcode_x, f.stockcode_y from texts t join firsts f using (method, match_key) where t.mystery
      union select stockcode_x, stockcode_y from knn where match_level = 'Good')
    select distinct stockcode_x, stockcode_y, y.description, x.varietal, x.bottle_closure, x.price_before::double as price_before,
           x.price_after::double as price_after, round(x.price_before - x.price_after, 2)::double as savings
    from matches m join catalogue x on x.stockcode = m.stockcode_x and x.is_for_delivery
    join catalogue y on y.stockcode = m.stockcode_y""",
)
def nightly_match(spark, folder):
    """The whole nightly run: newest load, structural and text matches in one table with savings."""
    return nightly.nightly_matches(_loads(spark, folder), NIGHTLY)[0]


@query(
    "nightly_members",
    f"""with {NIGHTLY_SQL}
    select method, sha256(match_key) as match_key, stockcode from texts
    where not mystery and (method, match_key) in (select (method, match_key) from texts where mystery)""",
)
def nightly_members(spark, folder):
    return nightly.known_members(_loads(spark, folder), NIGHTLY)


# The nominals of a product, filled from the parts: some attributes are often missing.
WIDE_NOMINALS = {
    name: f"case when p_size % {i + 2} <> 0 then substr(p_brand, 7) || '{i}' end" if i % 3 else f"substr(p_name, {i // 3 + 1}, 2) || p_size % {i + 2}"
    for i, name in enumerate(nightly.NOMINALS)
}
WIDE_SQL = ", ".join(f"{sql} as {name}" for name, sql in WIDE_NOMINALS.items())
WIDE_COST = " + ".join(
    f"(case when a.{c} is not distinct from b.{c} then 0 when a.{c} is null or b.{c} is null then 1 else 2 end)" for c in WIDE_NOMINALS
)


@query(
    "nightly_nominals",
    f"""with c as (
      select p_partkey::varchar as stockcode, contains(p_name, 'widget') as mystery, p_retailprice % 50 as price, (p_size <= 40)::int as avail, {WIDE_SQL} from part),
    pairs as (
      select a.stockcode as stockcode_x, b.stockcode as stockcode_y,
        round(sqrt(power(a.price - b.price, 2) + power(a.avail - b.avail, 2) + {WIDE_COST}), 6) as distance
      from c a, c b where a.mystery and not b.mystery)
    select stockcode_x, stockcode_y, distance, case when distance < 1.8 then 'Good' else 'Poor' end as match_level, 'KNN' as method
    from pairs qualify row_number() over (partition by stockcode_x order by distance, stockcode_y) = 1""",
)
def nightly_nominals(spark, folder):
    """The nearest known product by the nightly run's two numerics and all its 24 nominals."""
    price, avail = nightly.NUMERICS
    rows = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("stockcode"), F.contains("p_name", F.lit("widget")).alias("mystery"),
        (F.col("p_retailprice") % 50).alias(price), (F.col("p_size") <= 40).alias(avail),
        *[F.expr(sql).alias(name) for name, sql in WIDE_NOMINALS.items()],
    )
    return structural.nearest_known(rows, "stockcode", "mystery", nightly.NUMERICS, nightly.NOMINALS)


@query(
    "all_deals",
    f"""with {CATALOGUE_SQL}
    select stockcode, description, varietal, bottle_closure, price_before::double as price_before,
           price_after::double as price_after, round(price_before - price_after, 2)::double as savings
    from catalogue where mystery and is_for_delivery""",
)
def all_deals(spark, folder):
    return assemble.all_deals(part_catalogue(spark, folder))


@query(
    "closure_shortlist",
    f"with {CATALOGUE_SQL} select stockcode, description, size from catalogue where mystery and is_for_delivery and bottle_closure = 'Brand#12'",
)
def closure_shortlist(spark, folder):
    return assemble.shortlist(part_catalogue(spark, folder), "bottle_closure", "Brand#12", ["stockcode", "description", "size"])


@query(
    "solve_rate",
    f"""with {CATALOGUE_SQL}, {KNN_SQL}
    select count(*) as n_mystery, count_if(match_level = 'Good')::bigint as n_solved,
           round(count_if(match_level = 'Good') / count(*), 4)::double as solve_rate from knn""",
)
def solve_rate(spark, folder):
    return assemble.solve_rate(part_catalogue(spark, folder), _nearest(spark, folder))


@query(
    "confidence_histogram",
    f"with {CATALOGUE_SQL}, {KNN_SQL} select floor(distance / 0.25)::bigint as bucket, count(*) as n from knn group by 1",
)
def confidence_histogram(spark, folder):
    return profile.histogram(_nearest(spark, folder), F.col("distance"), 0.25)


@query(
    "fuzzy_name_join",
    """
    with l as (select distinct c_name from customer where c_mktsegment = 'HOUSEHOLD'),
    r as (select distinct c_name from customer where c_mktsegment <> 'HOUSEHOLD'),
    scored as (
      select l.c_name, r.c_name as other,
        round(100 * (1 - levenshtein(l.c_name, r.c_name) / greatest(length(l.c_name), length(r.c_name))))::int as score from l, r),
    best as (select * from scored where score >= 90 qualify row_number() over (partition by c_name order by score desc, other) <= 2),
    listed as (select c_name, string_agg(other, ', ' order by score desc, other) as matches, max(score) as best_score from best group by 1)
    select c.c_custkey, c.c_name, coalesce(matches, '') as matches, best_score
    from customer c left join listed using (c_name) where c.c_mktsegment = 'HOUSEHOLD'""",
)
def fuzzy_name_join(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    left = customers.filter("c_mktsegment = 'HOUSEHOLD'").drop("c_mktsegment")
    right = customers.filter("c_mktsegment <> 'HOUSEHOLD'").select("c_name")
    return fuzzy.fuzzy_join(left, "c_name", right, "c_name", threshold=90, limit=2)


# Two spellings of the parts' names: words in another order, and words left out.
SPELLED_SQL = r"""
l as (select distinct p_name || ' ' || p_brand as x from part where p_type = 'PROMO'),
r as (select distinct lower(p_brand) || ', ' || p_name || case when p_size % 2 = 0 then ' large' else '' end as y from part where p_type <> 'PROMO'),
names as (select x as name from l union select y from r),
cut as (select name, list_filter(regexp_split_to_array(lower(name), '[^\p{L}\p{N}]+'), lambda w: w <> '') as w from names),
parts as (select name, array_to_string(list_sort(w), ' ') as sorted, list_distinct(w) as bag, list_sum(list_transform(list_distinct(w), lambda v: length(v))) as size from cut),
pairs as (select x, y, a.sorted as sa, b.sorted as sb, a.bag as ba, b.bag as bb, a.size as za, b.size as zb from l, r, parts a, parts b where a.name = x and b.name = y),
scores as (
  select x, y,
    round(100 * (1 - levenshtein(x, y) / greatest(length(x), length(y))))::int as ratio,
    round(100 * (1 - levenshtein(sa, sb) / greatest(length(sa), length(sb))))::int as token_sort,
    round(100.0 * coalesce(list_sum(list_transform(list_intersect(ba, bb), lambda v: length(v))), 0) / least(za, zb))::int as token_set from pairs)"""


def _spelled(spark, folder):
    part = table(spark, folder, "part")
    left = part.filter("p_type = 'PROMO'").select(F.concat_ws(" ", "p_name", "p_brand").alias("x"))
    large = F.when(F.col("p_size") % 2 == 0, " large").otherwise("")
    right = part.filter("p_type <> 'PROMO'").select(F.concat(F.lower("p_brand"), F.lit(", "), "p_name", large).alias("y"))
    return left, "x", right, "y"


@query("token_sort_join", f"with {SPELLED_SQL} select x as left_name, y as right_name, token_sort as score from scores where token_sort >= 90")
def token_sort_join(spark, folder):
    """Names whose words are alike in any order."""
    return fuzzy.scored_pairs(*_spelled(spark, folder), threshold=90, scorer="token_sort")


@query("token_set_join", f"with {SPELLED_SQL} select x as left_name, y as right_name, token_set as score from scores where token_set >= 95")
def token_set_join(spark, folder):
    """Names of which one's words are nearly all in the other."""
    return fuzzy.scored_pairs(*_spelled(spark, folder), threshold=95, scorer="token_set")


@query(
    "weighted_name_join",
    f"""with {SPELLED_SQL},
    best as (select x, y, greatest(ratio, round(token_sort * 0.95::double)::int, round(token_set * 0.95::double)::int) as score from scores)
    select x as left_name, y as right_name, score from best where score >= 90""",
)
def weighted_name_join(spark, folder):
    """Names alike as they are, or by their words, which counts a little less."""
    return fuzzy.scored_pairs(*_spelled(spark, folder), threshold=90)
