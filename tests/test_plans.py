"""What the optimiser makes of registered queries: filters and columns at the scan, few shuffles, no Python where none is needed."""

import os

import pytest

from landloom.job_queries import QUERIES

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(DIR), reason="needs the given tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(QUERIES["study_filters"](spark, DIR))
    scan = next(line for line in text.split("\n") if "FileScan" in line)
    assert "EqualTo(lang,de)" in scan and "GreaterThan(n_chars,500)" in scan and "StringContains(text,der)" in scan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,n_chars:bigint>" in scan
    assert "Exchange" not in text


@pytest.mark.parametrize(
    "name, shuffles", [("eav_latest", 1), ("eav_latest_pivot", 2), ("fact_first", 1), ("keep_one_per_key", 1), ("json_pack", 0)]
)
def test_shuffles(spark, name, shuffles):
    text = plan(QUERIES[name](spark, DIR))
    assert text.count("Exchange hashpartitioning") <= shuffles and "Python" not in text and "Pandas" not in text


def test_small_sides_are_broadcast_and_ranges_are_joined_by_block(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["org_left_join"](spark, DIR))
    text = plan(QUERIES["range_join"](spark, DIR))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["centroid", "geojson", "schema_enforce", "split_explode_count", "provision_quality"])
def test_expressions_stay_built_in(spark, name):
    assert not any(x in plan(QUERIES[name](spark, DIR)) for x in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "NestedLoop"))
