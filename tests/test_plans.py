"""What the plans of the registered queries must and must not hold."""

import pytest

from dockpulse import jobs
from dockpulse.plans import QUERIES
from dockpulse.streaming.store import StationStore

SF_DIR = "/root/testdata/sf0.001"
PLAIN = sorted(n for n in QUERIES if not n.startswith(("stream_", "gbt_", "top_k_importance", "importance_", "ts_features_split", "boosting_")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(QUERIES[name](spark, SF_DIR)) for name in PLAIN}


@pytest.mark.parametrize("node", [
    "BatchEvalPython",
    "ArrowEvalPython",
    "InPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "SinglePartition",
])
def test_no_query_runs_python_pairs_all_rows_or_gathers_them(plans, node):
    whole = {"fleet_stats", "model_metrics", "baseline_compare"}  # one-row totals
    held = {n for n, text in plans.items() if node in text}
    assert held <= (whole if node == "SinglePartition" else set())


def test_totals_are_combined_before_they_meet(plans):
    for name in ("fleet_stats", "model_metrics", "baseline_compare"):
        assert "partial_" in plans[name].split("SinglePartition")[1]


@pytest.mark.parametrize("name", ["group_avg_count", "group_avg_sum_count", "sql_group_count", "usage_rate"])
def test_groups_are_combined_before_the_shuffle(plans, name):
    assert "partial_" in plans[name].split("Exchange hashpartitioning")[-1]


def test_filters_reach_the_scan(plans):
    assert "EqualTo(user_id,42)" in plans["station_detail"]
    assert "IsNotNull(user_id)" in plans["station_list"]
    assert "LessThanOrEqual(p_size,20)" in plans["filter_compare"]
    assert "GreaterThanOrEqual(p_size,20)" in plans["filter_between_sql"]
    assert "EqualTo(c_mktsegment,BUILDING)" in plans["filter_equals"]


def test_serving_reads_its_table_once(spark, plans, tmp_path):
    assert plans["station_list"].count("FileScan") == 1
    row = spark.sql("""SELECT 'a' station_id, 'A' station_name, 1 parking_count, 2 rack_total, 't' timestamp,
      TIMESTAMP_NTZ '2024-01-01 00:00:00' observed_at, 1L seq, 1 predicted_count, 'm' model, array(1) history""")
    StationStore(spark, str(tmp_path)).write(row, "q", 0)
    assert plan(jobs.stations(spark, str(tmp_path))).count("FileScan") == 1


def test_scans_read_only_what_is_used(plans):
    assert "ReadSchema: struct<event_type:string>" in plans["sql_group_count"]
    assert "props" not in plans["ts_features_train"]
    assert "c_acctbal" not in plans["project_subset"]


def test_top_k_is_taken_without_a_full_sort(plans):
    assert "TakeOrderedAndProject" in plans["top_k"]


@pytest.mark.parametrize("name", ["ts_features_train", "ts_features_serve", "history_register", "training_matrix"])
def test_series_queries_shuffle_once(plans, name):
    assert plans[name].count("Exchange") == 1


@pytest.mark.parametrize("name", ["calendar_features", "rule_prediction", "json_decode_clean", "explode_feed", "format_time"])
def test_row_by_row_queries_do_not_shuffle(plans, name):
    assert "Exchange" not in plans[name]
