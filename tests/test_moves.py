"""What moves: large tables go through no more exchanges than their step needs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from unmask import session
from unmask.llm import crosspolytope
from unmask.operators import semantic, structural


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_documents_move_once_to_their_vectors(spark):
    rows = spark.createDataFrame([(i, f"red wine number w{i % 7} and some more w{i % 3}") for i in range(40)] + [(None, "red wine"), (41, None)], "doc int, text string")
    words = rows.select(F.explode(F.split("text", " ")).alias("term")).distinct()
    vectors = words.select("term", F.array(F.length("term").cast("double"), F.lit(1.0)).alias("vector"))
    out = semantic.document_vectors(rows, "doc", "text", vectors, block=5, group_rows=20)
    # One join, of the vectors with what their words weigh; the words of documents meet both where they are summed.
    assert len(re.findall(r"\bJoin\b", _plan(out))) == 1 and "CoGroup" in _plan(out)
    got = {r.id: r.vector for r in out.collect()}
    assert got.keys() == set(range(40)) and all(abs(x) < 1e6 for v in got.values() for x in v)


def test_blocks_are_packed_before_they_are_copied(spark, monkeypatch):
    rnd = random.Random(5)
    monkeypatch.setattr(structural, "BLOCK", 6)
    monkeypatch.setattr(structural, "GRID", (2, 3))
    names = [f"a{i}" for i in range(6)]
    rows = [(f"k{i:03}", i % 4 == 0, rnd.randint(0, 30) / 10, *[rnd.choice([None, "x", "y", "z"]) for _ in names]) for i in range(160)]
    df = spark.createDataFrame(rows, f"k string, m boolean, p double, {', '.join(f'{n} string' for n in names)}")
    plans = []
    found = structural._Grid.best_in_blocks
    monkeypatch.setattr(structural._Grid, "best_in_blocks", lambda self, asked: plans.append(found(self, asked)) or plans[-1])
    got = {r.stockcode_x: (r.stockcode_y, r.distance) for r in structural.nearest_known(df, "k", "m", ["p"], names).collect()}

    def distance(a, b):
        parts = [0 if x == y else 1 if x is None or y is None else 2 for x, y in zip(a[3:], b[3:], strict=True)]
        return round(((a[2] - b[2]) ** 2 + sum(parts)) ** 0.5, 6)

    assert got == {a[0]: min((distance(a, b), b[0]) for b in rows if not b[1])[::-1] for a in rows if a[1]}
    plan = _plan(plans[0])
    # Both sides are packed by block under the meeting of blocks; before, copies of rows met there.
    top = plan.index("FlatMapCoGroupsInArrow")
    assert plan[top:].count("FlatMapGroupsInArrow") == 2


def test_no_table_of_the_vector_search_is_copied_through_the_driver(spark, monkeypatch):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rnd.normal(size=(400, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plans = []
    for owner, name in ((session.Scratch, "table"), (crosspolytope, "durable")):
        real = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *a, real=real, **k: plans.append(next(x for x in a if hasattr(x, "_jdf"))._jdf.queryExecution().executedPlan().toString()) or real(*a, **k))
    out = crosspolytope.search(df, F.col("vec_id") % 50 == 0, least_met=50).collect()
    assert len(out) == 40 and any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "BroadcastHashJoin" in p or "BroadcastNestedLoop" in p]
