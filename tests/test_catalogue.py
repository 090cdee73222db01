"""Payload flattening, snapshots, reports and streams on a hand-made catalogue."""

import json
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unmask.functions import scalars as sc
from unmask.functions import text as tx
from unmask.operators import assemble, increments, snapshots as snap
from unmask.plans import nightly, refresh, reports
from unmask.sources import flatten, readers, writers
from unmask.sources import schema as sch
from unmask.streaming import ingest


def product(code, description="plain", details=True, **more):
    out = {"Stockcode": code, "Description": description, "IsForDelivery": True}
    if details is True:
        details = [{"Name": "varietal", "Value": "shiraz", "DisplayName": None}]
    if details is not None:
        out["AdditionalDetails"] = details
    return out | more


def review(author, text):
    return {"author": {"Value": author}, "text": {"Value": text}}


@pytest.fixture
def landed(tmp_path):
    first = [
        product("A1", "old text"),
        product("A2", "Red Wraps", Categories=[{"UrlFriendlyName": "red-wine"}]),
        product("A3", details=[]),
        product("A4", details=None),
        product("A5", Reviews=[review("ann", "good"), review("bob", "[...]"), review("cy", "third")],
                Categories=[{"UrlFriendlyName": c} for c in ("wine", "white-wine", "x")]),
        product(None, None),
        product("X672366Y"),
        product("ER_2000003422_RX2386"),
        product("A6", "Secret Selection 3"),
    ]
    again = [
        product("A1", "new text", Prices={"promoprice": {"BeforePromotion": 20.5, "AfterPromotion": 15.25, "Message": "sale"}}),
        product("A7", details=[{"Name": "varietal", "Value": v} for v in ("pinot", "merlot")] + [{"Name": "unseen", "Value": "u"}]),
    ]
    path = tmp_path / "landed"
    path.mkdir()
    (path / "1.json").write_text(json.dumps({"Products": first}))
    (path / "2.json").write_text(json.dumps({"Products": again}))
    return str(path)


def wide_rows(spark, landed):
    payload = readers.read_payload(spark, landed).withColumn("file", F.input_file_name())
    wide = flatten.flatten_products(flatten.products(payload, ["file"]), ["file"])
    return {r["stockcode"]: r for r in wide.collect()}


def test_flatten_rules(spark, landed):
    rows = wide_rows(spark, landed)
    assert set(rows) == {"A1", "A2", "A5", "A7", None}
    assert rows["A1"]["description"] == "new text"
    assert rows["A1"]["price_promoprice_before_promotion"] == Decimal("20.50")
    assert rows["A2"]["mystery"] and not rows["A1"]["mystery"]
    assert (rows["A2"]["category"], rows["A2"]["sub_category"]) == ("red-wine", None)
    assert (rows["A5"]["category"], rows["A5"]["sub_category"]) == ("wine", "white-wine")
    assert (rows["A5"]["review1_auth"], rows["A5"]["review2_text"], rows["A5"]["review2_points"]) == ("ann", "[...]", None)
    assert rows["A7"]["varietal"] == "merlot"
    assert rows["A7"]["webwinebody"] is None


def test_snapshot_contract(spark, landed):
    payload = readers.read_payload(spark, landed).withColumn("file", F.input_file_name())
    wide = flatten.flatten_products(flatten.products(payload, ["file"]), ["file"], sch.ATTRIBUTES + ["unseen"])
    stamped = flatten.stamp(wide, datetime(2024, 5, 1, 1, 30))
    target = sch.snapshot_schema()
    out = snap.align(stamped, target)
    assert out.columns == target.names and "unseen" in stamped.columns and "unseen" not in out.columns
    assert {r["run_date"] for r in out.collect()} == {date(2024, 5, 1)}


def test_stream_equals_batch_and_loads_once(spark, landed, tmp_path):
    def transform(batch):
        return flatten.products(batch).select("Stockcode", "Description")

    stream = ingest.landed_files(spark, landed, sch.PAYLOAD, files_per_batch=1)
    table, check = str(tmp_path / "table"), str(tmp_path / "check")
    for _ in range(2):
        ingest.load_new_files(stream, table, check, transform)
    got = sorted(map(str, spark.read.parquet(table).select("Stockcode", "Description").collect()))
    want = sorted(map(str, transform(readers.read_payload(spark, landed)).collect()))
    assert got == want
    history = spark.createDataFrame([("A1",)], "Stockcode string")
    fresh = ingest.first_seen_in_batch(spark.read.parquet(table), history, "Stockcode")
    assert "A1" not in {r[0] for r in fresh.collect()}


def test_literal_cells(spark):
    cells = [("[{'Name': 'a', 'Value': None, 'DisplayName': 'None such'}]",), ("[{'Name': 'it's'}]",), (None,)]
    df = spark.createDataFrame(cells, "cell string")
    got = [r[0] for r in df.select(flatten.literal_cell(F.col("cell"), sch.DETAILS)).collect()]
    assert got[0][0]["Value"] is None and got[0][0]["DisplayName"] == "None such"
    assert got[1:] == [None, None]
    assert flatten.failed_cells(df, "cell", sch.DETAILS).count() == 1


def test_literal_strings_stay_as_they_are(spark):
    lists = [
        [{"Name": "food", "Value": "Beef, None, Lamb", "DisplayName": None}],
        [{"Name": "x", "Value": "a\xa0b [True, False]: None,", "DisplayName": "it's \"so\""}],
        [{"Name": "y", "Value": "back\\x41 \\' tab\t line\n 'q' \x07\x00", "DisplayName": "True"}],
        [],
    ]
    df = spark.createDataFrame([(i, repr(x)) for i, x in enumerate(lists)], "i int, cell string")
    got = df.select("i", flatten.literal_cell(F.col("cell"), sch.DETAILS).alias("d")).orderBy("i").collect()
    assert [[e.asDict() for e in r["d"]] for r in got] == lists


def test_csv_rows_with_too_many_fields_are_skipped(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('a,b\n1,x\n2,"y, ""quoted""\nand more"\n3,z,extra\n4\n4,q,,v\n2,y,\n7,"p,q"\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    got = [tuple(r) for r in readers.read_csv(spark, str(path), schema).orderBy("a").collect()]
    assert got == [(1, "x"), (2, 'y, "quoted"\nand more'), (4, None), (7, "p,q")]
    with pytest.raises(Exception):
        readers.read_csv(spark, str(path), schema, strict=True).collect()


def test_urls_and_refresh(spark, tmp_path):
    base = "https://shop.example/product/"
    urls = [base + "DM_123/x", base + "456/y", base + "DM_789</loc>", "https://shop.example/about", base + "DM_5/two-wraps"]
    today = spark.createDataFrame([(u,) for u in urls], "url string")
    codes = [r[0] for r in today.select(sc.stock_code_from_url(F.col("url"))).collect()]
    assert codes == ["123", "456", "789", None, "5"]
    yesterday = spark.createDataFrame([(urls[0],), (urls[4],)], "url string")
    known = spark.createDataFrame([("M1", True), ("K1", False), ("456", True)], "stockcode string, mystery boolean")
    got = {r[0] for r in refresh.refresh_list(today, yesterday, known).collect()}
    assert got == {"456", "789", "5", "M1"}
    site = tmp_path / "map.xml"
    site.write_text(f"<urlset>\n<url><loc>{urls[0]}</loc></url><url><loc>{urls[3]}</loc></url>\n<url><loc>{urls[1]}</loc></url></urlset>")
    assert {r[0] for r in readers.read_sitemap(spark, str(site)).collect()} == {urls[0], urls[1]}


def test_names(spark):
    names = ["Acme & Co. Public Limited Company", "Foo t/a Bar", "É", "United Kingdom  Community Interest Company", "x-y (z)"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(tx.normalise_name(F.col("n"))).collect()]
    assert got == [" acme and co plc ", " foo ", "  ", " uk cic ", " xy z "]
    grams = df.select(tx.char_ngrams(F.col("n"), 3)).collect()
    assert grams[2][0] == [] and grams[1][0][0] == "Foo"


def test_latest_keeps_ties_and_is_idempotent(spark):
    rows = [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 4)]
    df = spark.createDataFrame(rows, "k string, ts int, v int")
    once = snap.latest_per_key(df, "k", "ts")
    assert sorted(r["v"] for r in once.collect()) == [2, 3, 4]
    assert sorted(snap.latest_per_key(once, "k", "ts").collect()) == sorted(once.collect())


def test_symmetric_difference(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y"), (3, "y")], "a int, b string")
    b = spark.createDataFrame([(1, None), (4, "z")], "a int, b string")
    got = sorted(map(tuple, snap.symmetric_difference(a, b, ["a", "b"]).collect()))
    # a row repeated inside one day vanishes too
    assert got == [(2, "x", "removed"), (4, "z", "added")]
    turned = sorted(map(tuple, snap.symmetric_difference(b, a, ["a", "b"]).select("a", "b").collect()))
    assert turned == [r[:2] for r in got]


SNAPSHOT = (
    "stockcode string, load_ts timestamp, varietal string, description string, price_message string, "
    "price_before decimal(12,2), price_after decimal(12,2), mystery boolean, is_for_delivery boolean, "
    "producer string, bottle_closure string, state string, vintage string"
)


def snapshot_row(code, when, after=Decimal("8.00"), mystery=True, delivery=True):
    return (code, when, "shiraz", "d " + code, "msg", Decimal("10.00"), after, mystery, delivery, "p", "cork", "s", "v")


def test_report_windows(spark):
    today = datetime(2024, 3, 2, 1, 30)
    rows = [snapshot_row("new", today), snapshot_row("nopromo", today, None), snapshot_row("known", today, mystery=False)]
    rows += [snapshot_row("away", today, delivery=False)]
    for days in (13, 14, 15):
        rows += [snapshot_row(f"d{days}", today), snapshot_row(f"d{days}", today - timedelta(days=days))]
    rows += [snapshot_row("earlier", today - timedelta(hours=1))]
    df = spark.createDataFrame(rows, SNAPSHOT)
    matches = spark.createDataFrame(
        [("new", "K1", "k one", today), ("d13", "K2", "k two", today - timedelta(days=1))],
        "stockcode_x string, stockcode_y string, description string, updated timestamp",
    )

    def codes(out):
        return {r["mystery"][3:]: r["solved"] for r in out.collect()}

    # the one-day report compares dates, so both loads of the day count
    assert codes(reports.new_items(df, matches)) == {"new": "DM_K1", "nopromo": None, "earlier": None}
    assert codes(reports.new_items(df, matches, window_days=14, promo=True)) == {"new": "DM_K1", "d13": None, "d14": None}
    assert set(codes(reports.new_items(df, matches, window_days=14, promo=False))) == {"nopromo"}
    active = {r["mystery"][3:]: r["first_appeared"] for r in reports.active_with_first_seen(df, matches).collect()}
    assert active == {"new": "2024 03 02", "d13": "2024 02 18", "d14": "2024 02 17", "d15": "2024 02 16"}


CATALOGUE = (
    "stockcode string, load_ts timestamp, description string, varietal string, bottle_closure string, price double, "
    "before decimal(12,2), after decimal(12,2), text string, mystery boolean, is_for_delivery boolean"
)


def test_nightly_matches(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    ten, eight = Decimal("10.00"), Decimal("8.00")
    rows = [
        ("m1", t0, "old", "shiraz", "cork", 99.0, ten, ten, "x", True, True),
        ("m1", t1, "Wraps", "shiraz", "cork", 10.0, ten, eight, "same text", True, True),
        ("m2", t1, "Wraps two", "merlot", "cork", 50.0, ten, None, "same text", True, None),
        ("m3", t1, "Wraps three", "malbec", "screw", 80.0, ten, None, None, True, True),
        ("k1", t1, "known one", "shiraz", "cork", 10.0, ten, ten, "other", False, True),
        ("k2", t1, "known two", "pinot", "cork", 30.0, ten, ten, "same text", None, True),
    ]
    df = spark.createDataFrame(rows, CATALOGUE)
    settings = nightly.MatchSettings(["price"], ["varietal", "bottle_closure"], {"text": "desc_match"}, 1.8, "bottle_closure", "before", "after")
    out, members = nightly.nightly_matches(df, settings, t1)
    got = [(r["stockcode_x"], r["stockcode_y"], r["description"], r["savings"], r["updated"]) for r in out.collect()]
    # m2 is not deliverable, m3 has no good match
    assert got == [("m1", "k1", "known one", Decimal("2.00"), t1), ("m1", "k2", "known two", Decimal("2.00"), t1)]
    assert [r["stockcode"] for r in members.collect()] == ["k2"]


def test_savings_sort_last_when_missing(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 2.0)], "stockcode_x string, savings double")
    df = df.withColumn("stockcode_y", F.lit("k"))
    assert [r[0] for r in assemble.by_savings(df).select("stockcode_x").collect()] == ["c", "b", "a"]


def test_runs_are_pruned_and_replaced(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", date(2024, 1, 2))], "stockcode string, run_date date")
    writers.append_run(df, path)
    writers.replace_run(df.filter("stockcode = 'b'"), path)
    one = readers.read_run(spark, path, F.lit(date(2024, 1, 2)))
    assert [r["stockcode"] for r in one.collect()] == ["b"] and spark.read.parquet(path).count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_tables(spark):
    df = spark.range(3).withColumnRenamed("id", "stockcode")
    spark.sql("drop table if exists unmask_deals")
    writers.overwrite_table(df, "unmask_deals")
    writers.append_table(df, "unmask_deals")
    assert spark.table("unmask_deals").count() == 6
    assert readers.table_columns(spark, "unmask_deals") == ["stockcode"]
    spark.sql("drop table unmask_deals")


def test_increments_equal_the_recomputation_and_touch_few_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "kept"), "code string, at timestamp, price double"
    day = lambda n: datetime(2024, 5, n)
    loads = [
        [(f"c{i}", day(2), float(i)) for i in range(40)] + [(None, day(2), 1.0)],
        [("c1", day(3), 9.0), ("c1", day(3), 9.5), ("new", day(3), 2.0)],
        [("c2", day(1), 7.0), ("c3", day(2), 3.0)],
        [],
    ]
    files = {}
    for n, rows in enumerate(loads):
        load = spark.createDataFrame(rows, schema)
        touched = increments.apply_load(spark, path, load, "code", "at", buckets=16)
        own = {r[0] for r in increments.with_bucket(load.filter("code is not null"), "code", 16).select("bucket").collect()}
        assert set(touched) == own
        now = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "kept").rglob("*.parquet")}
        if n:
            changed = {f.split("bucket=")[1].split("/")[0] for f in set(now.items()) ^ set(files.items()) for f in [f[0]]}
            assert changed == {str(b) for b in own}
        files = now
    kept = increments.read_buckets(spark, path, increments.table_schema(spark.createDataFrame([], schema).schema, "at"))
    rows = [r for load in loads for r in load if r[0]]
    newest = {c: max(t for k, t, _ in rows if k == c) for c, *_ in rows}
    first = {c: min(t for k, t, _ in rows if k == c) for c, *_ in rows}
    want = {(c, t, p, first[c]) for c, t, p in rows if t == newest[c]}
    got = [tuple(r) for r in kept.drop("bucket").collect()]
    assert set(got) == want and len(got) == len(want)
    one = increments.read_buckets(spark, path, kept.schema, [touched_bucket(spark, "c1")])
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", one._jdf.queryExecution().toString())
    files = [r[0] for r in one.select(F.input_file_name()).distinct().collect()]
    assert {f.split("bucket=")[1].split("/")[0] for f in files} == {str(touched_bucket(spark, "c1"))}


def touched_bucket(spark, code):
    return increments.with_bucket(spark.createDataFrame([(code,)], "code string"), "code", 16).first()["bucket"]


def test_first_seen_survives_a_restart_and_drops_late_rows(spark, tmp_path):
    schema = "code string, at timestamp"
    landed, table, check = (str(tmp_path / n) for n in ("landed", "table", "check"))
    at = lambda day, hour=0: datetime(2024, 5, day, hour)

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        stream = ingest.landed_files(spark, landed, spark.createDataFrame([], schema).schema, "parquet")
        ingest.keep_first_seen(stream, "code", "at", "2 days", table, check)
        return sorted(tuple(r) for r in spark.read.parquet(table).collect())

    first = run([("a", at(1)), ("a", at(1)), ("b", at(1, 5))])
    assert first == [("a", at(1)), ("b", at(1, 5))]
    # A repeat within the delay is dropped by the state of the run before; the watermark then moves on.
    second = run([("a", at(2)), ("c", at(9))])
    assert second == sorted([*first, ("c", at(9))])
    # Rows behind the watermark are late; a key whose state has ended counts as new again.
    assert run([("d", at(1)), ("c", at(9, 1)), ("a", at(10))]) == sorted([*second, ("a", at(10))])


def test_products_are_dealt_before_they_are_sorted(spark, landed):
    """Wide rows meet by code once; nothing is sorted in the tasks that read."""
    rows = flatten.products(readers.read_payload(spark, str(landed)).withColumn("line", F.lit(0)), ["line"])
    plan = flatten.flatten_products(rows, ["line"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("Aggregate") < plan.index("Exchange")


def test_csv_files_hold_a_bounded_number_of_records(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit('two\nlines, "quoted"').alias("text")).coalesce(1)
    writers.write_csv(rows, str(tmp_path / "csv"), records=300)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 4
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "csv"), rows.schema).collect())) == sorted(map(tuple, rows.collect()))
