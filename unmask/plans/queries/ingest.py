"""Ingest queries: nested payloads, links, files, runs and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from unmask.functions import scalars as sc
from unmask.operators import exact
from unmask.plans.queries.registry import query
from unmask.plans.queries.snapshots import SNAPSHOT_SQL
from unmask.plans.standins import documents, event_snapshot, literal_details, parsed_payload, part_payload, table
from unmask.operators.snapshots import align, latest_load_value
from unmask.session import durable, scratch_path
from unmask.sources import flatten, readers, writers
from unmask.sources import schema as sch
from unmask.streaming import ingest


@query(
    "json_fields",
    "select event_id, user_id, json_extract_string(props, '$.k')::bigint as k from events",
)
def json_fields(spark, folder):
    kind = T.StructType([T.StructField("k", T.LongType())])
    parsed = table(spark, folder, "events").withColumn("p", F.from_json("props", kind))
    return parsed.select("event_id", "user_id", F.col("p.k").alias("k"))


@query(
    "literal_cells",
    """select p_partkey as stockcode, 'varietal' as first_name, p_type as first_value, p_brand as second_value,
       cast(null as varchar) as third_value, 2 as n_details from part""",
)
def literal_cells(spark, folder):
    rows = literal_details(spark, folder).withColumn("d", flatten.literal_cell(F.col("details"), sch.DETAILS))
    return rows.select(
        "stockcode",
        flatten.nth_field(F.col("d"), 0, "Name").alias("first_name"),
        flatten.nth_field(F.col("d"), 0, "Value").alias("first_value"),
        flatten.nth_field(F.col("d"), 1, "Value").alias("second_value"),
        flatten.nth_field(F.col("d"), 2, "Value").alias("third_value"),
        F.size("d").alias("n_details"),
    )


@query(
    "exploded_details",
    """
    select p_partkey::varchar as "Stockcode", 'varietal' as "Name", p_type as "Value" from part
    union all select p_partkey::varchar, 'webbrandname', p_brand from part
    union all select p_partkey::varchar, 'webliquorsize', p_size::varchar from part""",
)
def exploded_details(spark, folder):
    return flatten.exploded_details(flatten.products(parsed_payload(part_payload(spark, folder))))


@query(
    "flatten_products",
    """
    select p_partkey::varchar as stockcode, case when p_type = 'PROMO' then 'Wraps ' || p_name else p_name end as description,
           p_size <= 40 as is_for_delivery, p_size::bigint as stock_on_hand, p_type as category, p_brand as sub_category,
           p_brand as review1_auth, p_size::varchar as review1_points, p_name as review1_text, cast(null as varchar) as review2_text,
           p_retailprice::decimal(12,2)::double as price_promoprice_before_promotion,
           (p_retailprice - p_size)::decimal(12,2)::double as price_promoprice_after_promotion,
           p_type as varietal, p_brand as webbrandname, p_size::varchar as webliquorsize, cast(null as varchar) as webwinebody,
           p_type = 'PROMO' as mystery
    from part where not contains(p_partkey::varchar, '672366')""",
)
def flatten_products(spark, folder):
    payload = parsed_payload(part_payload(spark, folder)).withColumn("line", F.lit(0))
    wide = flatten.flatten_products(flatten.products(payload, ["line"]), ["line"])
    return wide.select(
        "stockcode", "description", "is_for_delivery", "stock_on_hand", "category", "sub_category", "review1_auth",
        "review1_points", "review1_text", "review2_text", "price_promoprice_before_promotion",
        "price_promoprice_after_promotion", "varietal", "webbrandname", "webliquorsize", "webwinebody", "mystery",
    )


@query(
    "page_links",
    """select page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) as link from pages""",
)
def page_links(spark, folder):
    return readers.page_links(table(spark, folder, "pages"), "page_id", "html")


@query(
    "url_to_code",
    """
    select page_id, nullif(regexp_extract('https://shop.example/product/' || case when starts_with(url, 'https') then 'DM_' else '' end
        || regexp_extract(url, '/([0-9]+)', 1) || '/x', '/product/(?:DM_)?([^/<]+)', 1), '') as stockcode,
      nullif(regexp_extract(url, '/product/(?:DM_)?([^/<]+)', 1), '') as plain_code,
      nullif(regexp_extract(url, '/en/([^/<?#]+)', 1), '') as english_page from pages""",
)
def url_to_code(spark, folder):
    prefix = F.when(F.startswith("url", F.lit("https")), F.lit(sc.CODE_PREFIX)).otherwise(F.lit(""))
    link = F.concat(F.lit("https://shop.example/product/"), prefix, F.regexp_extract("url", "/([0-9]+)", 1), F.lit("/x"))
    return table(spark, folder, "pages").select(
        "page_id",
        sc.stock_code_from_url(link).alias("stockcode"),
        sc.stock_code_from_url(F.col("url")).alias("plain_code"),
        sc.page_code_from_url(F.col("url"), "/en/").alias("english_page"),
    )


@query("csv_round_trip", "select p_partkey, p_name, p_brand, p_retailprice from part")
def csv_round_trip(spark, folder):
    """Parts through CSV; lines with a field too many, empty or not, land beside them and are skipped."""
    path = scratch_path(spark, "csv")
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    writers.write_csv(part, path)
    text = F.col("p_partkey").cast("string")
    wide = part.select(F.concat(text, F.lit(',"a, b",c,1.0,'), F.when(F.col("p_partkey") % 2 == 0, ",v").otherwise("")).alias("value"))
    extra = scratch_path(spark, "csv-extra")
    spark.range(1).select(F.lit("p_partkey,p_name,p_brand,p_retailprice").alias("value")).union(wide).coalesce(1).write.text(extra)
    return readers.read_csv(spark, [path, extra], part.schema)


@query(
    "csv_payload",
    """
    select p_partkey::varchar as stockcode, p_name as description, p_type as category, p_brand as sub_category,
           'Beef, None, ' || p_brand as varietal, 'it''s ' || p_size || '"' as webliquorsize, p_type = 'PROMO' as mystery
    from part where not contains(p_partkey::varchar, '672366')""",
)
def csv_payload(spark, folder):
    """Products whose lists stand in CSV cells as Python literals, flattened; the last of a code's rows counts."""
    quote = F.lit("'")
    category = lambda c: F.concat(F.lit("{'UrlFriendlyName': '"), c, F.lit("', 'Id': None}"))
    detail = lambda n, v: F.concat(F.lit(f"{{'Name': '{n}', 'Value': "), v, F.lit(", 'DisplayName': None}"))
    cells = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("Stockcode"),
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("Wraps "), "p_name")).otherwise(F.col("p_name")).alias("Description"),
        F.concat(F.lit("["), category(F.col("p_type")), F.lit(", "), category(F.col("p_brand")), F.lit("]")).alias("Categories"),
        F.concat(
            F.lit("["), detail("varietal", F.concat(quote, F.lit("Beef, None, "), "p_brand", quote)), F.lit(", "),
            detail("webliquorsize", F.concat(F.lit('"it\'s '), F.col("p_size").cast("string"), F.lit('\\""'))), F.lit("]"),
        ).alias("AdditionalDetails"),
        F.lit(1).alias("line"),
    )
    older = cells.withColumn("line", F.lit(0)).withColumn("Description", F.lit("older"))
    empty = cells.withColumn("line", F.lit(2)).withColumn("AdditionalDetails", F.lit("[]"))
    path = scratch_path(spark, "csv")
    writers.write_csv(cells.unionByName(older).unionByName(empty), path)
    rows = readers.read_csv(spark, path, cells.schema)
    lists = {"Categories": sch.CATEGORIES, "AdditionalDetails": sch.DETAILS}
    rows = rows.withColumns({c: flatten.literal_cell(F.col(c), kind) for c, kind in lists.items()})
    wide = flatten.flatten_products(rows, ["line"], attributes=["varietal", "webliquorsize"])
    described = F.regexp_replace("description", "^Wraps ", "").alias("description")
    return wide.select("stockcode", described, "category", "sub_category", "varietal", "webliquorsize", "mystery")


@query(
    "latest_run_partition",
    f"""with {SNAPSHOT_SQL}
    select stockcode, varietal, strftime(load_ts, '%Y-%m-%d') as run_date from snapshot where load_ts = (select max(load_ts) from snapshot)""",
)
def latest_run_partition(spark, folder):
    path = scratch_path(spark, "runs")
    rows = event_snapshot(spark, folder)
    writers.append_run(rows.withColumn("run_date", F.to_date("load_ts")), path)
    day = F.to_date(F.lit(latest_load_value(rows)))
    return readers.read_run(spark, path, day).select("stockcode", "varietal", "run_date")


@query(
    "payload_folder",
    "select p_partkey::varchar as stockcode, p_size::bigint as stock_on_hand, p_type = 'PROMO' as masked, p_partkey % 10 = 0 and contains(p_name, 'widget') as coded from part",
)
def payload_folder(spark, folder):
    """A folder of payload files read at once; masked by description in any case, or by stock code."""
    path = scratch_path(spark, "payloads")
    part_payload(spark, folder).repartition(3, "value").write.text(path)
    rows = flatten.products(readers.read_payload(spark, path))
    is_coded = (F.col("Stockcode").cast("long") % 10 == 0) & sc.contains_text(F.col("Description"), "widget")
    code = F.when(is_coded, F.concat(F.lit(sc.MASKED_CODE), "Stockcode")).otherwise(F.col("Stockcode"))
    return rows.select(
        F.col("Stockcode").alias("stockcode"), F.col("StockOnHand").alias("stock_on_hand"),
        sc.is_masked(F.upper("Description"), rule="description_any_case").alias("masked"),
        sc.is_masked(F.col("Description"), code, rule="code").alias("coded"),
    )


@query("sitemap_products", "select url from pages where contains(url, '/en/')")
def sitemap_products(spark, folder):
    """Product links of a sitemap, several to a line."""
    path = scratch_path(spark, "sitemap")
    entry = F.concat(F.lit("<url><loc>"), "url", F.lit("</loc></url><url><loc>https://shop.example/about</loc></url>"))
    table(spark, folder, "pages").select(entry.alias("value")).write.text(path)
    return readers.read_sitemap(spark, path, "/en/")


@query(
    "replaced_run",
    """select p_partkey, p_size, '2024-05-01' as run_date from part
       union all select p_partkey, p_size + 1, '2024-05-02' from part where p_size > 10""",
)
def replaced_run(spark, folder):
    """Two runs, the later one written again with other rows: it replaces itself and nothing else."""
    path = scratch_path(spark, "runs")
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    later = part.withColumn("run_date", F.to_date(F.lit("2024-05-02")))
    writers.replace_run(part.withColumn("run_date", F.to_date(F.lit("2024-05-01"))), path)
    writers.replace_run(later, path)
    writers.replace_run(later.filter("p_size > 10").withColumn("p_size", F.col("p_size") + 1), path)
    return spark.read.parquet(path)


@query(
    "clean_identifiers",
    """select p_partkey as part_key_, p_size as size__10, p_brand as brand from part""",
)
def clean_identifiers(spark, folder):
    """Columns renamed so that no bracket or less-than sign is left."""
    rows = table(spark, folder, "part").selectExpr("p_partkey as `part[key]`", "p_size as `size<[10`", "p_brand as brand")
    return rows.toDF(*[sc.clean_identifier(c) for c in rows.columns])


@query(
    "ingest_products",
    """
    select p_partkey::varchar as stockcode, p_type as varietal, p_brand as webbrandname, cast(null as varchar) as webwinebody,
           cast(null as boolean) as is_new, p_type = 'PROMO' as mystery, '2024-05-01 04:00:00' as load_ts, '2024-05-01' as run_date
    from part where not contains(p_partkey::varchar, '672366')""",
)
def ingest_products(spark, folder):
    """Landed payload files as a stream: flattened, stamped, aligned to the wide table and appended once."""
    landed = scratch_path(spark, "landed")
    part_payload(spark, folder).repartition(2, "value").write.text(landed)
    stream = ingest.landed_files(spark, landed, sch.PAYLOAD, "json", files_per_batch=1)

    def load(batch):
        rows = flatten.products(batch.withColumn("line", F.lit(0)), ["line"])
        wide = flatten.stamp(flatten.flatten_products(rows, ["line"]), datetime(2024, 5, 1, 4))
        return align(wide, sch.snapshot_schema())

    target, checkpoint = scratch_path(spark, "wide"), scratch_path(spark, "wide-checkpoint")
    ingest.load_new_files(stream, target, checkpoint, load)
    return spark.read.parquet(target).select(
        "stockcode", "varietal", "webbrandname", "webwinebody", "is_new", "mystery", "load_ts", "run_date"
    )


@query("first_seen_stream", "select distinct user_id from events where user_id not in (select s_suppkey from supplier)")
def first_seen_stream(spark, folder):
    """Keys of a landed stream that the history does not know."""
    history = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("user_id"))
    stream = ingest.landed_files(spark, f"{folder}/event[s].parquet", table(spark, folder, "events").schema, "parquet")
    target, checkpoint = scratch_path(spark, "first-seen"), scratch_path(spark, "first-seen-checkpoint")
    ingest.load_new_files(stream, target, checkpoint, lambda b: ingest.first_seen_in_batch(b, history, "user_id"))
    return spark.read.parquet(target).select("user_id")


@query("incremental_ingest", "select event_id, user_id, event_type, value from events")
def incremental_ingest(spark, folder):
    """The landed event file as a stream, loaded once into a table and read back."""
    schema = table(spark, folder, "events").schema
    # a file stream lists folders, so a single file is given as a pattern
    stream = ingest.landed_files(spark, f"{folder}/event[s].parquet", schema, "parquet")
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-checkpoint")
    ingest.load_new_files(stream, target, checkpoint, lambda b: b.select("event_id", "user_id", "event_type", "value"))
    return spark.read.parquet(target).drop("batch_id")


@query(
    "stream_match",
    """
    with rows as (select doc_id, text, starts_with(source, 'src1') as mystery from documents where trim(text) <> ''),
    known as (select text, count(*) as n_known, min(doc_id) as stockcode_y from rows where not mystery group by text)
    select doc_id as stockcode_x, stockcode_y, 'desc_match' as method, n_known, sha256(text) as match_key
    from rows join known using (text) where mystery""",
)
def stream_match(spark, folder):
    """Landed masked documents matched batch by batch against the digests of the known ones.

    The digests are made once, not in every batch; match_key leads to the members of a text.
    """
    methods = {"text": "desc_match"}
    known = documents(spark, folder).filter("not mystery")
    known = durable(exact.known_texts(exact.text_rows(known, "doc_id", "mystery", methods)), "known-texts")
    stream = ingest.landed_files(spark, f"{folder}/document[s].parquet", table(spark, folder, "documents").schema, "parquet")
    target, checkpoint = scratch_path(spark, "matched"), scratch_path(spark, "match-checkpoint")

    def match(batch, known):
        masked = batch.withColumn("mystery", F.startswith("source", F.lit("src1"))).filter("mystery")
        return exact.match_texts(exact.text_rows(masked, "doc_id", "mystery", methods), known)

    ingest.match_new_files(stream, known, match, target, checkpoint)
    return spark.read.parquet(target).select("stockcode_x", "stockcode_y", "method", "n_known", "match_key")


@query(
    "first_seen_restarted",
    """select user_id || '_' || json_extract_string(props, '$.k') as code,
         min(case when ts < timestamp '2024-01-16' then 'early' else 'late' end) as landed from events group by 1""",
)
def first_seen_restarted(spark, folder):
    """First rows of every code over two runs of one stream: files land between them, the state goes on."""
    code = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.get_json_object("props", "$.k")).alias("code")
    rows = table(spark, folder, "events").select(code, F.col("ts").cast("timestamp").alias("ts"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    rows = rows.withColumn("landed", F.when(early, "early").otherwise("late"))
    path = {name: scratch_path(spark, name) for name in ("landed", "first-seen", "checkpoint")}
    for part in ("early", "late"):
        rows.filter(F.col("landed") == part).write.mode("append").parquet(path["landed"])
        stream = ingest.landed_files(spark, path["landed"], rows.schema, "parquet")
        ingest.keep_first_seen(stream, "code", "ts", "3650 days", path["first-seen"], path["checkpoint"])
    return spark.read.parquet(path["first-seen"]).select("code", "landed")
