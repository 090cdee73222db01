"""The registered queries of the operators, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unmask.llm import collocations, crosspolytope, factorization, fertility, golay, lexical, linedup, mixing, packing, repair, sharding, unigram, wrapper
from unmask.llm.common import table, word_count
from unmask.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHARDS = 24


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


LINES_SQL = r"""
lines as (
  select doc_id, i as line, list_extract(l, i) as x
  from (select doc_id, string_split(text, chr(10)) as l, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents)),
full_lines as (
  select doc_id, line, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) as words,
    row_number() over (partition by doc_id order by line) as no
  from lines where regexp_matches(x, '[^\x20\x09-\x0D]')),
pairs as (
  select a.doc_id, a.no, a.words, b.doc_id as other, a.no - b.no as shift
  from full_lines a join full_lines b on a.x = b.x and (b.doc_id < a.doc_id or (b.doc_id = a.doc_id and b.no < a.no))),
runs as (
  select *, no - row_number() over (partition by doc_id, other, shift order by no) as run from pairs),
long_runs as (
  select *, sum(words) over (partition by doc_id, other, shift, run) as run_words from runs),
gone as (select distinct doc_id, no from long_runs where run_words >= 50),
marked as (
  select l.doc_id, l.line, l.x, f.no, g.no is not null as gone
  from lines l left join full_lines f using (doc_id, line) left join gone g on g.doc_id = l.doc_id and g.no = f.no),
around as (
  select *, last_value(case when no is not null then gone end ignore nulls) over (partition by doc_id order by line rows between unbounded preceding and 1 preceding) as up,
    first_value(case when no is not null then gone end ignore nulls) over (partition by doc_id order by line rows between 1 following and unbounded following) as down
  from marked),
kept as (select *, coalesce(case when no is null then up and down else gone end, false) as cut from around)"""


@query
def op1_repair_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read back from the shard files."""
    path = scratch_path(spark, "token-shards")
    repair.write_shards(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return repair.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    text = F.col("text")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return sharding.shuffle_into_shards(docs, SHARDS).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op3_wrapper_induction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return wrapper.main_texts(table(spark, folder, "pages"))


@query
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    packed = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.placed("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")


@query
def op5_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest found of every vector whose id is divisible by 50."""
    return crosspolytope.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op6_viterbi_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens and best score of every document under the piece vocabulary as a unigram model."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return unigram.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


@query
def op7_multinomial_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Size, source, target and words taken of every document in the mix."""
    docs = table(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(docs)
    taken = mixed.pieces.groupBy(F.col("uid").alias("taken_uid")).agg(F.sum("n_words").alias("taken"))
    rows, sources = mixed.rows.alias("d"), mixed.sources.alias("s")
    out = rows.join(sources, F.col("d.source").eqNullSafe(F.col("s.source")))
    out = out.join(taken, F.col(f"d.{mixed.uid}") == F.col("taken_uid"), "left")
    return out.select(
        "d.doc_id", "d.size", "s.source_size", "s.target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


@query
def op8_tokenizer_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Base figures, fertility figures and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return fertility.quality(docs, *fertility_files()).drop("text", "lang")


def fertility_files() -> tuple[str, str, str]:
    path = public_tokenizers.path
    return path("piece_bpe_32k.model"), path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op9_suffix_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without later copies of repeated line runs of 50 words or more."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return linedup.drop_repeated_runs(docs)


ORACLES["op9_suffix_line_runs"] = f"""with {LINES_SQL}
select d.doc_id,
  case when d.text is null then null else coalesce(k.text, '') end as text,
  coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed
from documents d left join (
  select doc_id, string_agg(x, chr(10) order by line) filter (where not cut) as text,
    count(*) as n_lines, count(*) filter (where cut) as n_removed
  from kept group by doc_id) k using (doc_id)"""


@query
def op10_golay_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and smallest reachable doc_id of every document."""
    found = golay.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op11_hybrid_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMS_SQL = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op11_hybrid_lexical"] = f"""with
cut as (select row_number() over () as doc, doc_id, {TERMS_SQL} as terms from documents where text is not null),
docs as (select doc, doc_id, terms, len(terms) as n from cut where len(terms) > 0),
whole as (select cast(count(*) as bigint) as n_docs, cast(sum(n) as bigint) as n_terms from docs),
postings as (select doc, term, count(*) as tf from (select doc, unnest(terms) as term from docs) group by doc, term),
asked as (select item_id, term, count(*) as times from (select item_id, unnest({TERMS_SQL}) as term from benchmark) group by item_id, term),
weights as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
  from (select term, count(*) as df from postings group by term), whole),
lengths as (select doc, doc_id, 25 + ((75 * n * n_docs) // n_terms) as m from docs, whole),
scores as (
  select item_id, doc_id, doc, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from asked join weights using (term) join postings using (term) join lengths using (doc)
  group by item_id, doc_id, doc),
ranked as (
  select item_id, doc_id, score, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
  from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10"""


@query
def op12_son_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best collocations of every language."""
    return collocations.collocations(table(spark, folder, "documents"))


ORACLES["op12_son_collocations"] = rf"""with
pieces as (
  select lang, regexp_extract_all(unnest(string_split_regex(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as w
  from (select coalesce(lang, 'und') as lang, coalesce(text, '') as text from documents)),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces),
sizes as (select lang, cast(count(*) as bigint) as n from places group by lang),
grams as (
  select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase
  from places, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, cast(count(*) as bigint) as a from grams group by lang, k, phrase having count(*) >= 30),
cuts as (
  select lang, k, phrase, a, c, array_to_string(list_slice(string_split(phrase, ' '), 1, c), ' ') as p,
    array_to_string(list_slice(string_split(phrase, ' '), c + 1, k), ' ') as q
  from f, (select unnest([1, 2, 3]) as c) where k >= 2 and c < k),
scored as (
  select x.lang, x.k, x.phrase, x.a, x.c, l.a as l, r.a as r, cast((2000000::hugeint * x.a) // (l.a::hugeint + r.a) as bigint) as score
  from cuts x join f l on l.lang = x.lang and l.phrase = x.p join f r on r.lang = x.lang and r.phrase = x.q),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
subs as (
  select lang, a, array_to_string(list_slice(string_split(phrase, ' '), s, s + z - 1), ' ') as phrase
  from f, (select unnest([1, 2, 3]) as s), (select unnest([2, 3]) as z) where k > z and s + z - 1 <= k),
inside as (select lang, phrase, max(a) as within from subs group by lang, phrase),
ranked as (
  select lang, cast(row_number() over (partition by lang order by score desc, a desc, phrase) as bigint) as rank, phrase, a, l, r, n, score
  from lowest left join inside using (lang, phrase) join sizes using (lang)
  where within is null or 100 * within < 80 * a)
select * from ranked where rank <= 2000"""


@query
def op13_factorisation_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document by a model that has not seen the labels of the held-out ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    machine = factorization.train(docs, table(spark, folder, "labels"), "quality", ~held_out)
    scored = factorization.score(docs, machine)
    predicted = (F.col("score") >= factorization.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)
