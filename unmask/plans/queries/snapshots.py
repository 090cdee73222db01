"""Snapshot, difference, projection and statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from unmask.functions import scalars as sc
from unmask.operators import increments, profile
from unmask.operators import snapshots as snap
from unmask.operators.order import with_position
from unmask.plans.queries.registry import query
from unmask.plans.standins import day_of, event_snapshot, table
from unmask.session import scratch_path

SNAPSHOT_SQL = """
snapshot as (
  select 'ER_' || user_id || '_' || json_extract_string(props, '$.k') as stockcode,
         date_trunc('day', ts)::timestamp as load_ts, event_type as varietal, props as description,
         case when value >= 20 then 'save ' || event_type end as price_message,
         cast(value as decimal(12,2)) as price_before,
         case when value >= 20 then cast(floor(value) as decimal(12,2)) end as price_after,
         event_type in ('view','click','signup') as mystery, value < 100 as is_for_delivery,
         'user ' || user_id as producer, 'cork' as bottle_closure, event_type as state,
         json_extract_string(props, '$.k') as vintage
  from events)"""


@query(
    "latest_per_key",
    """
    select user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_id, event_type
    from events e where ts = (select max(ts) from events m where m.user_id = e.user_id)""",
)
def latest_per_key(spark, folder):
    out = snap.latest_per_key(table(spark, folder, "events"), "user_id", "ts")
    return out.select("user_id", "ts", "event_id", "event_type")


@query("latest_load", f"with {SNAPSHOT_SQL} select strftime(max(load_ts), '%Y-%m-%d %H:%M:%S') as load_ts from snapshot")
def latest_load(spark, folder):
    return snap.latest_load(event_snapshot(spark, folder))


@query(
    "first_seen",
    f"""with {SNAPSHOT_SQL}
    select stockcode, strftime(min(load_ts), '%Y-%m-%d %H:%M:%S') as first_seen from snapshot group by stockcode""",
)
def first_seen(spark, folder):
    return snap.first_seen(event_snapshot(spark, folder), "stockcode", "load_ts")


@query(
    "single_load_keys",
    f"""with {SNAPSHOT_SQL}
    select distinct stockcode from snapshot l where not exists
      (select 1 from snapshot m where m.stockcode = l.stockcode and m.load_ts <> l.load_ts)""",
)
def single_load_keys(spark, folder):
    return snap.single_load_keys(event_snapshot(spark, folder), "stockcode", "load_ts")


def _two_days(spark, folder):
    """The whole table as two catalogues: the latest load and everything before it."""
    events = table(spark, folder, "events").withColumn("day", day_of(F.col("ts")))
    newest = events.agg(F.max("day")).first()[0]
    return events.filter(F.col("day") < F.lit(newest)), events.filter(F.col("day") == F.lit(newest))


@query(
    "day_symmetric_diff",
    """
    with d as (select user_id, props, date_trunc('day', ts) = (select max(date_trunc('day', ts)) from events) as now
               from events)
    select user_id, props, min(case when now then 'added' else 'removed' end) as side
    from d group by user_id, props having count(*) = 1""",
)
def day_symmetric_diff(spark, folder):
    before, after = _two_days(spark, folder)
    return snap.symmetric_difference(before, after, ["user_id", "props"])


@query(
    "new_lines_antijoin",
    """
    with d as (select user_id || ' ' || props as line,
                      date_trunc('day', ts) = (select max(date_trunc('day', ts)) from events) as now from events)
    select line from d where now and not exists (select 1 from d o where not o.now and o.line = d.line)""",
)
def new_lines(spark, folder):
    line = F.concat(F.col("user_id").cast("string"), F.lit(" "), "props").alias("line")
    before, after = _two_days(spark, folder)
    return snap.new_lines(after.select(line), before.select(line), "line")


@query(
    "dedupe_keep_last",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') as shipped
    from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1""",
)
def dedupe_keep_last(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    out = snap.keep_last(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return out.withColumn("shipped", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@query(
    "dedupe_unique_only",
    "select l_orderkey, l_linenumber from lineitem group by all having count(*) = 1",
)
def dedupe_unique_only(spark, folder):
    return snap.occurring_once(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "repeated_keys",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1",
)
def repeated_keys(spark, folder):
    return snap.repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "eav_pivot",
    """
    select user_id, min(value) filter (event_type = 'click') as click, min(value) filter (event_type = 'error') as error,
           min(value) filter (event_type = 'purchase') as purchase, min(value) filter (event_type = 'signup') as signup,
           min(value) filter (event_type = 'view') as "view"
    from events group by user_id""",
)
def eav_pivot(spark, folder):
    names = ["click", "error", "purchase", "signup", "view"]
    return snap.pivot_attributes(table(spark, folder, "events"), "user_id", "event_type", "value", names)


PARTY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("nation", T.LongType()),
        T.StructField("segment", T.StringType()),
        T.StructField("rating", T.DoubleType()),
    ]
)


@query(
    "schema_align",
    """
    select c_name as name, c_nationkey::bigint as nation, c_mktsegment as segment, cast(null as double) as rating from customer
    union all select s_name, s_nationkey::bigint, null, null from supplier""",
)
def schema_align(spark, folder):
    renamed = {"c_name": "name", "c_nationkey": "nation", "c_mktsegment": "segment", "s_name": "name", "s_nationkey": "nation"}
    both = [table(spark, folder, t).withColumnsRenamed(renamed) for t in ("customer", "supplier")]
    return snap.align(snap.rolling_union(*both), PARTY)


@query(
    "rolling_catalogue",
    f"""with {SNAPSHOT_SQL}, newest as (select max(load_ts) as t from snapshot),
    u as (select stockcode, load_ts, varietal, price_after from snapshot where load_ts < (select t from newest)
          union all select stockcode, load_ts, varietal, null from snapshot where load_ts = (select t from newest))
    select stockcode, strftime(load_ts, '%Y-%m-%d %H:%M:%S') as load_ts, varietal, price_after::double as price_after
    from u where load_ts = (select max(load_ts) from u m where m.stockcode = u.stockcode)""",
)
def rolling_catalogue(spark, folder):
    """Previous catalogue and a current one that lacks a column, then the latest row per product."""
    rows = event_snapshot(spark, folder)
    newest = snap.latest_load_value(rows)
    columns = ["stockcode", "load_ts", "varietal"]
    previous = rows.filter(F.col("load_ts") < F.lit(newest)).select(*columns, "price_after")
    current = rows.filter(F.col("load_ts") == F.lit(newest)).select(*columns)
    out = snap.latest_per_key(snap.rolling_union(previous, current), "stockcode", "load_ts")
    return out.select(*columns, "price_after")


@query(
    "null_fill",
    """
    select event_id, coalesce(nullif(event_type, 'error'), 'none') as event_type,
           coalesce(case when value >= 1 then value end, 0) as value from events""",
)
def null_fill(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
    )
    return rows.na.fill({"event_type": "none", "value": 0.0})


@query(
    "null_drop",
    "select event_id, value from events where value >= 1 and event_type <> 'error'",
)
def null_drop(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
    )
    return rows.na.drop().select("event_id", "value")


@query(
    "column_profile",
    """
    select 'event_type' as column_name, 'string' as data_type, false as is_list, count(*) as n_rows, count(nullif(event_type, 'error')) as n_filled from events
    union all select 'parts', 'array<string>', true, count(*), count(props) from events
    union all select 'value', 'double', false, count(*), count(case when value >= 1 then 1 end) from events""",
)
def column_profile(spark, folder):
    rows = table(spark, folder, "events").select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.split("props", ":").alias("parts"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
    )
    return profile.column_profile(rows)


@query(
    "summary_stats",
    """
    select count(value) as n, round(avg(value), 4) as mean, round(stddev_samp(value), 4) as std,
           min(value) + 0.0 as min, max(value) + 0.0 as max from events""",
)
def summary_stats(spark, folder):
    return profile.number_summary(table(spark, folder, "events"), "value")


@query(
    "text_summary",
    """
    with c as (select event_type as v, count(*) as c from events group by 1)
    select (select sum(c) from c)::bigint as n, (select count(*) from c) as n_distinct, v as top, c as top_count
    from c order by c desc, v limit 1""",
)
def text_summary(spark, folder):
    return profile.text_summary(table(spark, folder, "events"), "event_type")


@query(
    "kept_up_latest",
    f"""with {SNAPSHOT_SQL}
    select distinct stockcode, load_ts, varietal, vintage, price_before::double as price_before,
      (select min(load_ts) from snapshot f where f.stockcode = s.stockcode) as first_seen
    from snapshot s where load_ts = (select max(load_ts) from snapshot l where l.stockcode = s.stockcode)""",
)
def kept_up_latest(spark, folder):
    """Latest rows and first loads of every code, brought up by three loads of the catalogue out of order."""
    rows = event_snapshot(spark, folder).select("stockcode", "load_ts", "varietal", "vintage", "price_before")
    path = scratch_path(spark, "kept-up")
    third = F.pmod(F.datediff(F.to_date("load_ts"), F.lit("2024-01-01")), F.lit(3))
    for part in (2, 0, 1):
        increments.apply_load(spark, path, rows.filter(third == part), "stockcode", "load_ts")
    return increments.read_buckets(spark, path, increments.table_schema(rows.schema, "load_ts")).drop(increments.BUCKET)


@query(
    "savings_sorted",
    """
    select l_orderkey, l_linenumber, l_partkey,
      round(cast(l_extendedprice as decimal(18,4)) - cast(l_extendedprice * (1 - l_discount) as decimal(18,4)), 2)::double as savings
    from lineitem""",
)
def savings_sorted(spark, folder):
    rows = table(spark, folder, "lineitem")
    after = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = rows.select("l_orderkey", "l_linenumber", "l_partkey", sc.saving(F.col("l_extendedprice"), after).alias("savings"))
    return out.orderBy(F.desc_nulls_last("savings"), "l_orderkey", "l_linenumber", "l_partkey")


@query(
    "savings_order",
    """
    select l_orderkey, l_linenumber, l_partkey,
      row_number() over (order by savings desc nulls last, l_orderkey, l_linenumber, l_partkey) as position
    from (select *, round(cast(l_extendedprice as decimal(18,4)) - cast(l_extendedprice * (1 - l_discount) as decimal(18,4)), 2)::double as savings
      from lineitem)""",
)
def savings_order(spark, folder):
    """The place of every row among the sorted savings."""
    return with_position(savings_sorted(spark, folder).drop("savings"))


@query("top_n", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def top_n(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(10)


@query("distinct_codes", "select distinct o_custkey from orders where o_orderstatus = 'F'")
def distinct_codes(spark, folder):
    return table(spark, folder, "orders").filter("o_orderstatus = 'F'").select("o_custkey").distinct()


@query(
    "category_and_deny_list",
    """
    select p_partkey, p_name, p_type from part
    where p_type in ('ECONOMY', 'SMALL', 'PROMO') and (p_brand is null or p_brand not in ('Brand#1', 'Brand#2'))
      and not contains(p_name, 'ring') and contains(lower(p_name), 'bo')""",
)
def category_and_deny_list(spark, folder):
    kept = (
        F.col("p_type").isin("ECONOMY", "SMALL", "PROMO")
        & sc.is_none_of(F.col("p_brand"), ["Brand#1", "Brand#2"])
        & ~sc.contains_text(F.col("p_name"), "ring")
        & sc.contains_any_case(F.col("p_name"), "BO")
    )
    return table(spark, folder, "part").filter(kept).select("p_partkey", "p_name", "p_type")


@query(
    "code_link",
    """
    select p_partkey, 'DM_' || nullif(p_brand, 'Brand#1') as code,
           case when p_brand = 'Brand#1' then 'None' else 'https://shop.example/product/' || p_brand end as link,
           try_cast(regexp_extract(p_type, '^([0-9]{1,4})', 1) as int) as lead,
           cast(nullif(regexp_extract(cast(p_retailprice as varchar), '^([0-9]{1,4})', 1), '') as int) as price_lead,
           try_cast(replace(p_brand, 'Brand#', '') as double) as brand_number
    from part""",
)
def code_link(spark, folder):
    code = F.nullif(F.col("p_brand"), F.lit("Brand#1"))
    return table(spark, folder, "part").select(
        "p_partkey",
        sc.prefixed_code(code).alias("code"),
        sc.product_link(code, "https://shop.example/product/").alias("link"),
        sc.leading_number(F.col("p_type")).alias("lead"),
        sc.leading_number(F.col("p_retailprice").cast("string")).alias("price_lead"),
        sc.as_number(F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("brand_number"),
    )
