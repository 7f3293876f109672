"""Shape of the physical plans: what must not appear, and what must reach the scan."""

import re

import pytest
from pyspark.sql import functions as F

from obsframe.operators import correlate as C
from obsframe.operators import spanmetrics as M
from obsframe.operators import servicegraph as G
from obsframe.plans.session import configure, fresh_dir, shared_dir, written_once
from workload import QUERIES
from workload.views import view

# Streaming jobs and file round trips run when called; their operators are covered below.
BATCH = sorted(n for n in QUERIES if not re.match(r"s[t\d]", n))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"):
        assert bad not in text


@pytest.mark.parametrize("name", [n for n in BATCH if re.match(r"(p\d|f\d|u1)", n) and not re.match(
    r"(p1_|p17|p20|p21|p22|f0)", n)])
def test_row_operators_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["j2_match_routes", "j3_inject_errors", "j2_match_rule_table"])
def test_rules_are_met_by_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "RLIKE" not in text.split("endpoint_pattern")[0]
    # requests are joined once, to a row per path; everything before that works on distinct paths
    assert len(re.findall(r"LeftOuter", text)) == 1


@pytest.mark.parametrize("name", ["a1_span_calls", "a2_span_latency", "a5_log_count", "a9_http_metrics", "w5_instant"])
def test_counters_shuffle_once_after_a_partial_aggregate(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    path = fresh_dir(spark, "spans")
    view(spark, sf_dir, "spans").write.parquet(path)
    return spark.read.parquet(path)


def test_span_search_is_pushed_to_the_scan(stored):
    text = plan(C.find_spans(stored, "t", "bookapp", "GET /books"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("EqualTo(trace_id,t)", "EqualTo(service_name,bookapp)", "EqualTo(name,GET /books)", "In(kind"):
        assert part in pushed


def test_only_needed_columns_are_read(stored):
    assert "ReadSchema: struct<service_name:string,name:string,kind:string,status_code:string>" in plan(M.span_calls(stored))
    text = plan(G.service_edges(stored).groupBy("client", "server").count())
    assert "duration_ns" not in text and "event_target" not in text and "start_ts" not in text


def test_edges_filter_kinds_in_the_scan(stored):
    assert len(re.findall(r"PushedFilters: \[[^\]]*In\(kind", plan(G.service_edges(stored)))) == 2


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_written_once_reads_back_the_same(spark):
    df = configure(spark).range(10).withColumn("k", F.col("id") % 3)
    kept = written_once(df, "kept")
    assert kept.exceptAll(df).count() == 0 and "FileScan" in plan(kept)
