"""Plans: no pairing of everything, no row-wise Python, pruned and pushed-down reads."""

import os
import pathlib

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry
from unmask.operators import snapshots as snap
from unmask.plans import standins

FOLDER = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parent.parent
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


SEARCHES = [
    "knn_structural", "nightly_nominals", "tfidf_with_structure", "exact_text_match", "fuzzy_name_join", "token_set_join",
    "weighted_name_join", "trigram_match", "match_assembly", "new_items_promo", "kept_up_latest", "categorical_nb", "similar_words",
]


@pytest.mark.parametrize("name", SEARCHES)
def test_no_cartesian_product_and_no_row_wise_python(spark, name, monkeypatch):
    """In the plan of every table written on the way, and in the last one."""
    plans = []
    write = DataFrameWriter.parquet

    def seen(self, *args, **kwargs):
        plans.append(plan_of(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    plans.append(plan_of(entry.queries()[name](spark, FOLDER)))
    for plan in plans:
        assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_core_has_no_shortcuts():
    pipeline = ROOT / "corpus_pipeline.py"
    for path in [*(ROOT / "unmask").rglob("*.py"), *([pipeline] if pipeline.exists() else [])]:
        text = path.read_text()
        for banned in ("crossJoin", "localCheckpoint", "toPandas", "F.udf("):
            assert banned not in text, (path, banned)


def test_reads_are_pruned_and_pushed_down(spark):
    part = standins.table(spark, FOLDER, "part")
    plan = plan_of(part.filter(F.col("p_size") <= 40).select("p_partkey"))
    assert "PushedFilters: [IsNotNull(p_size), LessThanOrEqual(p_size,40)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan


def test_latest_spreads_a_frequent_key(spark):
    events = standins.table(spark, FOLDER, "events")
    plan = plan_of(snap.latest_per_key(events, "user_id", "ts"))
    assert "Window" not in plan
