"""Every query against its SQL, on the smallest tables (DOCKPULSE_SF_DIR picks others)."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from dockpulse.sources import warehouse
from tools.check_oracle import compare, connect

SF_DIR = os.environ.get("DOCKPULSE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - {"gbt_evaluation", "boosting_evaluation"}))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name).startswith("ok")


@pytest.mark.parametrize("name", ["gbt_evaluation", "boosting_evaluation"])
def test_the_fitted_model_beats_the_rule(spark, name):
    larger = "/root/testdata/sf0.01"  # a few hundred rows are too few for a hundred trees
    assert compare(spark, connect(larger), larger, name).startswith("ok")


def test_the_rounds_end_after_the_best_one(spark):
    lines = queries()["boosting_rounds"](spark, "/root/testdata/sf0.01").orderBy("round").collect()
    kept = [r for r in lines if r["kept"]]
    assert kept == lines[: len(kept)] and len(lines) - len(kept) in (0, 5)
    assert min(r["test_rmse"] for r in lines) == kept[-1]["test_rmse"]


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()


def test_forecast_queries_cover_the_test_rows(spark):
    scored = queries()["gbt_forecast"](spark, SF_DIR)
    assert scored.where("predicted_count IS NULL OR predicted_count < 0").isEmpty()
    assert {r["model"] for r in scored.select("model").distinct().collect()} == {"xgboost"}
    assert queries()["top_k_importance"](spark, SF_DIR).count() == 5


@pytest.fixture(scope="module")
def unclean(spark, tmp_path_factory):
    """The same tables, with missing, negative and absurd counts and missing stations in ``events``."""
    folder = tmp_path_factory.mktemp("unclean")
    for name in os.listdir(SF_DIR):
        if name != "events.parquet":
            os.symlink(f"{SF_DIR}/{name}", folder / name)
    odd = """CASE event_id % 10 WHEN 0 THEN -value - 1 WHEN 1 THEN NULL WHEN 2 THEN -0.5
        WHEN 3 THEN 1e12 ELSE value END AS value"""
    station = "CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS user_id"
    duckdb.execute(
        f"""COPY (SELECT * REPLACE ({odd}, {station}) FROM '{SF_DIR}/events.parquet')
        TO '{folder}/events.parquet'"""
    )
    return str(folder)


ON_EVENTS = sorted(
    n for n, sql in oracle_sql().items() if "FROM events" in sql and not n.startswith(("gbt_", "boosting_"))
)


@pytest.mark.parametrize("name", ON_EVENTS)
def test_rows_that_are_not_clean(spark, unclean, name):
    assert compare(spark, connect(unclean), unclean, name).startswith("ok")


@pytest.mark.parametrize("name", [n for n in ON_EVENTS if n.startswith("stream_")])
def test_streams_over_a_table_of_many_files(spark, con, tmp_path, monkeypatch, name):
    for other in os.listdir(SF_DIR):
        if other != "events.parquet":
            os.symlink(f"{SF_DIR}/{other}", tmp_path / other)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").orderBy("ts", "event_id")
    events.repartitionByRange(6, "ts").sortWithinPartitions("ts", "event_id").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    monkeypatch.setattr(warehouse, "FILES", 4)
    rows = queries()[name](spark, str(tmp_path)).collect()
    assert len(rows) == con.execute(f"SELECT count(*) FROM ({oracle_sql()[name]})").fetchone()[0]


def test_a_stream_over_no_file_raises(spark, tmp_path):
    spark.range(0).selectExpr("id AS event_id").write.parquet(f"{tmp_path}/events.parquet")
    for part in (tmp_path / "events.parquet").glob("part-*"):
        os.rename(part, part.with_name("_" + part.name))
    with pytest.raises(Exception):  # noqa: B017
        warehouse.table_stream(spark, f"{tmp_path}/events.parquet")


@pytest.mark.parametrize(
    "name", ["training_split_by_time", "snapshot_csv_merge", "format_time", "calendar_features"]
)
def test_results_do_not_depend_on_the_time_zone(spark, con, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, con, SF_DIR, name).startswith("ok")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
