"""Report queries over the snapshot and match tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from unmask.operators import snapshots as snap
from unmask.operators.order import with_position
from unmask.plans import refresh, reports
from unmask.plans.queries.registry import query
from unmask.plans.queries.snapshots import SNAPSHOT_SQL
from unmask.plans.standins import event_matches, event_snapshot, product_urls, table

MATCHES_SQL = """
matches as (
  select 'ER_' || user_id || '_' || json_extract_string(props, '$.k') as stockcode_x, 'P' || event_id as stockcode_y,
         props as description, date_trunc('day', ts)::timestamp as updated
  from events where value > 5),
latest_matches as (select * from matches where updated = (select max(updated) from matches))"""

COLUMNS_SQL = """
  r.varietal, 'DM_' || r.stockcode as mystery, 'DM_' || m.stockcode_y as solved, r.description,
  m.description as solved_description, r.price_message as promo_type, r.price_before::double as normal_price,
  r.price_after::double as promo_price, round(r.price_before - r.price_after, 2)::double as savings,
  r.bottle_closure as closure, r.producer as likely_producer, r.state, r.vintage
  from snapshot r left join latest_matches m on r.stockcode = m.stockcode_x"""


def _new_items_sql(days: int, promo: str) -> str:
    return f"""with {SNAPSHOT_SQL}, {MATCHES_SQL}
    select {COLUMNS_SQL}
    where r.load_ts = (select max(load_ts) from snapshot) and r.mystery and r.is_for_delivery {promo}
      and not exists (select 1 from snapshot o where o.stockcode = r.stockcode
                      and o.load_ts < (select max(load_ts) from snapshot) - interval {days} day)"""


@query("new_items_today", _new_items_sql(0, ""))
def new_items_today(spark, folder):
    return reports.new_items(event_snapshot(spark, folder), event_matches(spark, folder))


@query(
    "new_items_order",
    f"""with report as ({_new_items_sql(0, "")})
    select *, row_number() over (
      order by varietal desc nulls last, savings desc nulls last, mystery nulls first, solved nulls first) as position from report""",
)
def new_items_order(spark, folder):
    """The place of every row of the report: by variety, then by savings."""
    return with_position(new_items_today(spark, folder))


@query("new_items_promo", _new_items_sql(14, "and r.price_after is not null"))
def new_items_promo(spark, folder):
    return reports.new_items(event_snapshot(spark, folder), event_matches(spark, folder), window_days=14, promo=True)


@query("new_items_no_promo", _new_items_sql(14, "and r.price_after is null"))
def new_items_no_promo(spark, folder):
    return reports.new_items(event_snapshot(spark, folder), event_matches(spark, folder), window_days=14, promo=False)


@query(
    "active_with_first_seen",
    f"""with {SNAPSHOT_SQL}, {MATCHES_SQL}, first as (select stockcode as code, min(load_ts) as t from snapshot group by 1)
    select distinct first_appeared, * exclude (first_appeared) from (
      select (select strftime(t, '%Y %m %d') from first where code = r.stockcode) as first_appeared, {COLUMNS_SQL}
      where r.load_ts = (select max(load_ts) from snapshot) and r.mystery and r.is_for_delivery and r.price_after is not null)""",
)
def active_with_first_seen(spark, folder):
    return reports.active_with_first_seen(event_snapshot(spark, folder), event_matches(spark, folder))


@query(
    "single_load_items",
    f"""with {SNAPSHOT_SQL}, {MATCHES_SQL}
    select {COLUMNS_SQL}
    where r.mystery and r.is_for_delivery and r.price_after is not null
      and r.stockcode in (select stockcode from snapshot where mystery and is_for_delivery
                          and load_ts >= (select max(load_ts) from snapshot) - interval 6 day)
      and not exists (select 1 from snapshot o where o.stockcode = r.stockcode and o.load_ts <> r.load_ts)""",
)
def single_load_items(spark, folder):
    rows = event_snapshot(spark, folder)
    since = snap.latest_load_value(rows) - timedelta(days=6)
    return reports.single_load_items(rows, event_matches(spark, folder), since, promo=True)


@query(
    "refresh_list",
    f"""with {SNAPSHOT_SQL},
    urls as (select starts_with(url, 'https://') as today,
        'https://shop.example/product/' || case when regexp_extract(url, '//[^/]+/([a-z]+)', 1) = 'en' then 'DM_' else '' end
        || regexp_extract(url, '/([0-9]+)', 1)
        || case when regexp_extract(url, '//[^/]+/([a-z]+)', 1) = 'es' then '/wraps-of-red' else '/plain' end as url from pages),
    chosen as (select url from urls u where today and not exists (select 1 from urls o where not o.today and o.url = u.url)
               union all select url from urls where today and contains(lower(url), 'wraps'))
    select distinct stockcode from (
      select nullif(regexp_extract(url, '/product/(?:DM_)?([^/]+)', 1), '') as stockcode from chosen
      union all select stockcode from snapshot where mystery) where stockcode is not null""",
)
def refresh_list(spark, folder):
    today, yesterday = product_urls(spark, folder, "https"), product_urls(spark, folder, "http")
    return refresh.refresh_list(today, yesterday, event_snapshot(spark, folder))


@query(
    "offers_among_deliverable",
    """
    select g.p_partkey, g.p_name, g.p_brand, a.p_size from part g
    join (select p_partkey, p_name, p_size from part where p_size <= 40) a
      on g.p_partkey = a.p_partkey and g.p_name = a.p_name
    where contains(g.p_name, 'widget')""",
)
def offers_among_deliverable(spark, folder):
    part = table(spark, folder, "part")
    gives = part.filter(F.contains("p_name", F.lit("widget"))).select("p_partkey", "p_name", "p_brand")
    avail = part.filter("p_size <= 40").select("p_partkey", "p_name", "p_size")
    return reports.offers_among_deliverable(gives, avail)
