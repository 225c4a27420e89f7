"""The station job: carried history, replay, restart, out-of-order rows, compaction."""

import json
import time
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from conftest import START, rows
from pyspark.sql import functions as F

from dockpulse.operators.clean import clean, dedupe_stream
from dockpulse.operators.forecast import fit_forecaster
from dockpulse.operators.series import ts_features
from dockpulse.operators.serving import fleet_stats
from dockpulse.schemas import FEATURE_COLS
from dockpulse.sources.feeds import explode_feed, read_feed
from dockpulse.sources.observations import (
    decode_json,
    encode_json,
    read_observations,
    with_event_order,
)
from dockpulse.streaming import jobs
from dockpulse import jobs as run_jobs
from dockpulse.streaming import store as store_module
from dockpulse.streaming.compact import Compactor
from dockpulse.streaming.store import StationStore
from dockpulse.streaming.upsert import append_scored, read_scored, upsert_batch

SERIES = [c for c in FEATURE_COLS if c.startswith("parking_count_")]


class Site:
    """Folders of one station job, and the messages that have been sent to it."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, folder, 0
        (folder / "in").mkdir()

    def send(self, *observations):
        """One file of messages; ``(station, count, seconds)`` each."""
        lines = []
        for station, count, second in observations:
            message = {"station_id": station, "station_name": f"Stop {station}"}
            if count is not None:
                message["parking_count"] = count
            if second is not None:
                message["timestamp"] = (START + timedelta(seconds=second)).isoformat()
            lines.append(json.dumps(message))
        path = self.folder / "in" / f"{self.sent:04d}.txt"
        path.write_text("\n".join(lines))
        self.sent += 1
        time.sleep(0.02)  # files are taken in order of their age

    def stream(self):
        options = {"path": str(self.folder / "in"), "maxFilesPerTrigger": 1}
        return decode_json(read_observations(self.spark, "text", **options))

    def run(self, checkpoint="checkpoint", model=None):
        jobs.station_job(
            self.stream(),
            str(self.folder / "state"),
            str(self.folder / "obs"),
            str(self.folder / checkpoint),
            model,
            trigger=None,
        ).awaitTermination()

    @property
    def store(self):
        return StationStore(self.spark, str(self.folder / "state"))

    def state(self, *cols):
        return rows(self.store.read(), "station_id", *cols)

    def scored(self):
        return read_scored(self.spark, str(self.folder / "obs"))


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def test_history_is_carried_over_restarts(site):
    for second, count in enumerate((10, 7, 3)):
        site.send(("a", count, second))
        site.run()
    got = site.scored().orderBy("observed_at").select("parking_count", "parking_count_lag_1")
    assert [tuple(r) for r in got.collect()] == [(10, 0), (7, 10), (3, 7)]
    assert site.state("parking_count", "history") == [("a", 3, [3, 7, 10])]


def test_history_keeps_six(site):
    for second in range(8):
        site.send(("a", second, second))
    site.run()
    assert site.state("history") == [("a", [7, 6, 5, 4, 3, 2])]


def test_bad_rows_are_dropped_and_zero_is_kept(site):
    site.send(("a", 0, 1), ("a", -1, 2), ("b", None, 3), (None, 4, 4))
    site.run()
    assert site.state("parking_count") == [("a", 0)]


def batches():
    return [
        [(s, (i * 7 + len(s) * 3 + i * i) % 23, 10 * i + ord(s[0])) for s in ("a", "b", "cc")]
        + [("a", i, 10 * i + 105)] * (i % 2)
        for i in range(7)
    ]


def batch_serve(spark, site):
    """The same messages as one table, through the batch features."""
    raw = read_observations(spark, "text", streaming=False, path=str(site.folder / "in"))
    return ts_features(with_event_order(clean(decode_json(raw))), mode="serve")


@pytest.mark.parametrize("hot", [False, True])
def test_stream_features_equal_batch_features(spark, site, hot, request):
    if hot:
        request.getfixturevalue("small_pieces")
    for batch in batches():
        site.send(*batch)
    site.run()
    cols = ["station_id", "observed_at", "parking_count", *SERIES]
    assert rows(site.scored(), *cols) == rows(batch_serve(spark, site), *cols)


def test_one_batch_or_many_give_the_same(spark, site, tmp_path):
    many = batches()
    site.send(*[row for batch in many for row in batch])
    site.run()
    (tmp_path / "other").mkdir()
    other = Site(spark, tmp_path / "other")
    for batch in many:
        other.send(*batch)
    other.run()
    cols = ("parking_count", "predicted_count", "timestamp", "history")
    assert site.state(*cols) == other.state(*cols)


def decoded(spark, *observations):
    data = [(s, s, c, None, (START + timedelta(seconds=t)).isoformat()) for s, c, t in observations]
    schema = "station_id string, station_name string, parking_count int, rack_total int, timestamp string"
    return spark.createDataFrame(data, schema)


def test_a_batch_that_is_run_again_changes_nothing(spark, site):
    state, obs = str(site.folder / "state"), str(site.folder / "obs")
    for batch, count in enumerate((5, 6)):
        upsert_batch(decoded(spark, ("a", count, batch)), batch, state, obs)
    before = site.state("parking_count", "history"), rows(site.scored(), "seq")
    upsert_batch(decoded(spark, ("a", 6, 1)), 1, state, obs)
    assert (site.state("parking_count", "history"), rows(site.scored(), "seq")) == before


def test_a_batch_that_broke_off_is_done_over(spark, site):
    """Rows were written but the state was not: the rows are replaced."""
    state, obs = str(site.folder / "state"), str(site.folder / "obs")
    upsert_batch(decoded(spark, ("a", 5, 0)), 0, state, obs)
    upsert_batch(decoded(spark, ("a", 6, 1)), 1, state, obs)
    (site.folder / "state" / "manifests" / f"{site.store.versions()[-1]:012d}.json").unlink()
    assert site.state("history") == [("a", [5])]
    upsert_batch(decoded(spark, ("a", 6, 1)), 1, state, obs)
    assert site.state("history") == [("a", [6, 5])]
    assert site.scored().count() == 2


def test_an_older_observation_does_not_become_current(spark, site):
    site.send(("a", 9, 100))
    site.send(("a", 4, 50))
    site.run()
    assert site.state("parking_count", "history") == [("a", 9, [4, 9])]


def test_a_new_checkpoint_carries_on_from_the_state(site):
    site.send(("a", 5, 0))
    site.run("first")
    (site.folder / "in" / "0000.txt").unlink()
    site.send(("a", 6, 1))
    site.run("second")
    assert site.state("parking_count", "history") == [("a", 6, [6, 5])]


def test_an_empty_batch_writes_nothing(spark, site):
    upsert_batch(decoded(spark, ("a", -1, 0)), 0, str(site.folder / "state"), str(site.folder / "obs"))
    assert site.store.versions() == [] and site.store.read().isEmpty()


def test_only_touched_buckets_are_written_and_old_ones_go(spark, site, monkeypatch):
    monkeypatch.setattr(store_module, "KEEP", 3)
    state, obs = str(site.folder / "state"), str(site.folder / "obs")
    for batch in range(9):
        rows_in = decoded(spark, (f"s{batch}", batch, batch), ("a", batch, batch))
        upsert_batch(rows_in, batch, state, obs, buckets=32)
    assert site.store.versions() == [6, 7, 8]
    last, one = site.store.manifest(), site.store.manifest(7)
    assert last["buckets"] == 32 and len(last["folders"]) > 4
    moved = {b for b, f in last["folders"].items() if one["folders"].get(b) != f}
    assert 1 <= len(moved) <= 2
    kept = {f for n in (6, 7, 8) for f in site.store.manifest(n)["folders"].values()}
    assert {p.name for p in (site.folder / "state" / "data").iterdir()} == kept
    expected = [("a", 8)] + [(f"s{i}", i) for i in range(9)]
    assert site.state("parking_count") == expected


def test_a_lookup_and_a_batch_of_one_station_read_one_bucket(spark, site):
    state, obs = str(site.folder / "state"), str(site.folder / "obs")
    upsert_batch(decoded(spark, *[(f"s{i}", i, i) for i in range(100)]), 0, state, obs)
    assert len(site.store.manifest()["folders"]) == 16
    found = site.store.station("s7")
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1
    assert rows(found, "station_id", "parking_count") == [("s7", 7)]
    assert site.store.touched(found) == site.store.touched(decoded(spark, ("s7", 1, 1))) and len(site.store.touched(found)) == 1
    assert rows(run_jobs.station(spark, state, "s7"), "station_id", "parking_count") == [("s7", 7)]
    assert run_jobs.station(spark, state, "nobody").isEmpty()


def test_two_writers_lose_no_station(spark, site):
    state, obs = str(site.folder / "state"), str(site.folder / "obs")
    both = threading.Barrier(2)

    def work(me):
        for batch in range(4):
            both.wait()
            rows_in = decoded(spark, (f"{me}{batch}", batch, batch), ("shared", 10 * me + batch, 10 * batch + me))
            upsert_batch(rows_in, batch, state, obs, query=f"writer{me}", buckets=2)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(work, (1, 2)))
    expected = [(f"{me}{b}", b) for me in (1, 2) for b in range(4)] + [("shared", 23)]
    assert site.state("parking_count") == sorted(expected, key=str)
    assert site.store.versions() == list(range(8))
    assert site.store.holds("writer1", 3) and site.store.holds("writer2", 3) and not site.store.holds("writer3", 0)


def test_a_writer_that_comes_second_merges_into_the_new_state(spark, site):
    store, asked = site.store, []

    def change(before):
        asked.append(rows(before, "station_id"))
        if len(asked) == 1:
            store.write(fresh("b"), "other", 0)
        return fresh("a")

    def fresh(name):
        shown = decoded(spark, (name, 1, 1))
        return shown.selectExpr("*", "null observed_at", "1 seq", "1 predicted_count", "'m' model", "array(1) history")

    store.commit(change, list(range(16)), "q", 0)
    assert asked == [[], [("b",)]] and rows(store.read(), "station_id") == [("a",), ("b",)]


def test_a_silent_station_starts_a_new_history(spark, site):
    state, obs = str(site.folder / "state"), str(site.folder / "obs")
    batches = [[("a", 1, 0), ("a", 2, 50), ("a", 3, 200)], [("a", 4, 290), ("b", 9, 0)], [("a", 5, 500), ("a", 6, 510), ("b", 8, 100)]]
    for i, batch in enumerate(batches):
        upsert_batch(decoded(spark, *batch), i, state, obs, timeout=timedelta(seconds=100))
    found = rows(site.scored(), "station_id", "parking_count", "history")
    assert found == [
        ("a", 1, [1]), ("a", 2, [2, 1]), ("a", 3, [3]), ("a", 4, [4, 3]), ("a", 5, [5]), ("a", 6, [6, 5]),
        ("b", 8, [8, 9]), ("b", 9, [9]),
    ]


def test_bad_time_gets_the_rule_and_a_good_one_the_model(spark, site):
    train = spark.range(200).select(
        *[(F.col("id") % 10).cast("double").alias(c) for c in FEATURE_COLS],
        (F.col("id") % 10 + 50).cast("int").alias("target"),
    )
    site.send(("a", 5, 1), ("b", 20, None))
    site.run(model=fit_forecaster(train, maxIter=3))
    got = site.state("model", "predicted_count")
    assert got[0][1] == "xgboost" and got[0][2] >= 50
    assert got[1] == ("b", "simple", 17)


def test_current_and_prediction_views(site):
    site.send(("a", 10, 1))
    site.run()
    assert rows(site.store.prediction(), "station_id", "predicted_count", "model") == [("a", 8, "simple")]
    assert "predicted_count" not in site.store.current().columns


def test_plain_streams_of_one_source(spark, site):
    site.send(("a", 12, 1), ("b", 9, 2), ("c", None, 3))
    folder = str(site.folder / "plain")
    for query in jobs.plain_streams(site.stream(), "parquet", None, folder).values():
        query.awaitTermination()
    read = {n: spark.read.parquet(f"{folder}/{n}") for n in ("raw", "low_stock", "rule")}
    assert read["raw"].count() == 3
    assert rows(read["low_stock"], "station_id") == [("b",)]
    got = rows(read["rule"], "station_id", "predicted_count")
    assert got == [("a", 10), ("b", 7), ("c", None)]


def test_console_streams_start(site):
    site.send(("a", 12, 1))
    for query in jobs.plain_streams(site.stream(), "console", None).values():
        query.awaitTermination()
        assert query.exception() is None


def test_a_checkpoint_is_required(site):
    with pytest.raises(ValueError):
        jobs.build_query(site.stream(), "parquet")


def test_stream_repeats_are_dropped_also_after_a_restart(spark, site):
    def run():
        frame = with_event_order(site.stream()).withColumn("at", F.col("observed_at").cast("timestamp"))
        once = dedupe_stream(frame, ["station_id", "observed_at"], "at", "1 hour")
        folder = str(site.folder / "once")
        jobs.build_query(
            once, "parquet", None, f"{folder}/checkpoint", path=f"{folder}/rows"
        ).awaitTermination()
        return rows(spark.read.schema(once.schema).parquet(f"{folder}/rows"), "station_id", "parking_count")

    site.send(("a", 1, 1), ("a", 1, 1), ("b", 2, 1), ("a", 3, 2))
    site.send(("a", 1, 1), ("b", 4, 2))
    assert run() == [("a", 1), ("a", 3), ("b", 2), ("b", 4)]
    site.send(("a", 1, 1), ("c", 5, 3))
    assert run() == [("a", 1), ("a", 3), ("b", 2), ("b", 4), ("c", 5)]


def test_one_day_is_read_from_its_own_folder(spark, site):
    site.send(("a", 1, 0), ("a", 2, 86400))
    site.run()
    day = read_scored(spark, str(site.folder / "obs"), "2025-12-27")
    assert rows(day, "parking_count", "parking_count_lag_1") == [(2, 1)]
    assert len(day.inputFiles()) == 1


def test_order_of_arrival(spark, site):
    """The message that came last wins, whatever its time; a plain file has no such order."""
    state, obs = str(site.folder / "state"), str(site.folder / "obs")
    first = decoded(spark, ("a", 9, 100), ("a", 4, 50)).withColumn(
        "seq", F.when(F.col("parking_count") == 9, 1).otherwise(2).cast("long")
    )
    upsert_batch(first, 0, state, obs, order="arrival")
    assert site.state("parking_count", "history") == [("a", 4, [4, 9])]
    late = decoded(spark, ("a", 7, 10)).withColumn("seq", F.lit(3).cast("long"))
    upsert_batch(late, 1, state, obs, order="arrival")
    assert site.state("parking_count", "history") == [("a", 7, [7, 4, 9])]
    with pytest.raises(ValueError):
        upsert_batch(decoded(spark, ("a", 1, 1)), 2, state, obs, order="arrival")


def test_from_landed_feed_to_state(spark, site):
    """Polls land as feed documents, are published as messages, and end in the state."""
    landing, out = site.folder / "landing", site.folder / "published"
    landing.mkdir()
    for i, count in enumerate((12, 8)):
        listed = [("ST-1", "A역", count), ("ST-2", "Park", 5), ("ST-3", "B역", "x")]
        entries = [
            {"stationId": s, "stationName": n, "parkingBikeTotCnt": str(c), "rackTotCnt": "20"}
            for s, n, c in listed
        ]
        document = {"rentBikeStatus": {"row": entries}}
        (landing / f"{i}.json").write_text(json.dumps(document, ensure_ascii=False))
        time.sleep(0.02)
        polls = explode_feed(read_feed(spark, str(landing), streaming=True), "역")
        jobs.build_query(
            encode_json(polls), "text", None, str(site.folder / "published-cp"), path=str(out)
        ).awaitTermination()
    messages = read_observations(spark, "text", path=str(out))
    jobs.station_job(
        decode_json(messages),
        str(site.folder / "state"),
        str(site.folder / "obs"),
        str(site.folder / "cp"),
        trigger=None,
    ).awaitTermination()
    got = site.state("station_name", "parking_count", "rack_total", "history")
    assert got == [("ST-1", "A역", 8, 20, [8, 12])]


def test_a_long_job_leaves_no_staged_pieces(spark, site, small_pieces):
    from dockpulse.session import shared_dir
    from pathlib import Path

    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    site.send(*[("a", i, i) for i in range(40)])
    site.run()
    assert site.scored().count() == 40
    assert set(shared.iterdir()) == before


def test_copies_of_one_message_are_split_too(spark, site, small_pieces, monkeypatch):
    from dockpulse.operators import ordered
    from dockpulse.session import stage

    sizes = []

    def keep(df, name):
        laid = stage(df, name)
        if name == "pieces":
            sizes.extend(r["count"] for r in laid.groupBy("_piece").count().collect())
        return laid

    monkeypatch.setattr(ordered, "stage", keep)
    site.send(*[("a", 3, 1)] * 60)
    site.run()
    assert sum(sizes) == 60 and max(sizes) < 20
    got = site.scored().groupBy("parking_count_lag_1", "parking_count_lag_3").count()
    assert rows(got) == [(0, 0, 1), (3, 0, 2), (3, 3, 57)]
    assert site.state("history") == [("a", [3] * 6)]


def test_of_one_moment_the_new_batch_is_current(spark, site):
    site.send(("a", 9, 100))
    site.send(("a", 4, 100))
    site.run()
    assert site.state("parking_count", "history") == [("a", 4, [4, 9])]


def test_equal_times_and_offsets_in_two_partitions(spark, tmp_path):
    """The order in which messages are handed over does not matter."""
    sent = [(part, offset, 10 * part + offset) for part in (0, 1) for offset in (5, 6)]
    found = []
    for i, order in enumerate((sent, sent[::-1], sent[2:] + sent[:2])):
        rows_in = [
            (f"{part:06d}", offset, "a", "Stop", count, None, START.isoformat())
            for part, offset, count in order
        ]
        batch = spark.createDataFrame(
            rows_in,
            "source_part string, seq long, station_id string, station_name string, parking_count int, "
            "rack_total int, timestamp string",
        )
        state, obs = str(tmp_path / f"state{i}"), str(tmp_path / f"obs{i}")
        upsert_batch(batch, 0, state, obs)
        found.append(rows(StationStore(spark, state).read(), "parking_count", "history"))
        assert read_scored(spark, obs).count() == 4
    assert found == [[(16, [16, 15, 6, 5])]] * 3


def test_nothing_written_is_an_empty_table(spark, site):
    site.send(("a", -1, 0))
    site.run()
    assert site.scored().count() == 0
    assert {"day", "batch", "history", "predicted_count"} <= set(site.scored().columns)


def fan(site, results=None):
    folder = site.folder / "fan"
    query = jobs.fan_out(site.stream(), str(folder / "rows"), str(folder / "checkpoint"), None, results)
    query.awaitTermination()
    return query


def result(site, name):
    schema = jobs.RESULTS[name](site.stream()).schema
    return jobs.read_result(site.spark, str(site.folder / "fan" / "rows"), name, schema)


def test_three_results_come_from_one_read(site):
    assert result(site, "rule").count() == 0
    site.send(("a", 12, 1), ("b", 9, 2), ("c", None, 3))
    site.send(("a", 3, 4))
    query = fan(site)
    read = [p["numInputRows"] for p in query.recentProgress]
    assert sum(read) == 4  # each message once, not once per result
    assert result(site, "raw").count() == 4
    assert rows(result(site, "low_stock"), "station_id", "parking_count") == [("a", 3), ("b", 9)]
    got = rows(result(site, "rule"), "station_id", "predicted_count")
    assert got == [("a", 10), ("a", 2), ("b", 7), ("c", None)]


def test_a_batch_that_failed_half_way_writes_only_what_was_missing(site):
    def broken(decoded):
        raise RuntimeError("sink down")

    site.send(("a", 12, 1))
    with pytest.raises(Exception, match="sink down"):
        fan(site, {**jobs.RESULTS, "rule": broken})
    assert [result(site, n).count() for n in jobs.RESULTS] == [1, 1 - 1, 0]
    before = result(site, "raw").inputFiles()
    fan(site)
    assert result(site, "raw").inputFiles() == before
    assert [result(site, n).count() for n in jobs.RESULTS] == [1, 0, 1]


def test_rows_of_an_attempt_without_a_mark_are_not_read(site):
    site.send(("a", 12, 1))
    fan(site)
    torn = site.folder / "fan" / "rows" / "raw" / "batch=other-1"
    result(site, "raw").write.parquet(str(torn))
    (torn / "_SUCCESS").unlink()
    assert result(site, "raw").count() == 1


def test_kept_statistics_follow_the_state(site):
    assert tuple(site.store.stats().first()) == (0, 0, 0.0, 0.0, 0)
    for second, sent in enumerate(([("a", 9), ("b", 2)], [("a", 1)], [("c", 0), ("b", 30)])):
        site.send(*[(station, count, second) for station, count in sent])
        site.run()
        scanned = fleet_stats(site.store.current()).first()
        assert site.store.stats().first() == scanned
    assert tuple(scanned) == (3, 31, 10.3, 31 / 3, 2)
    assert not site.store.stats().inputFiles()  # no file of the state is read


def test_statistics_of_a_state_without_kept_totals_are_scanned(site):
    site.send(("a", 9, 0), ("b", 2, 0))
    site.run()
    for path in (site.folder / "state" / "manifests").glob("0*.json"):
        old = json.loads(path.read_text())
        del old["totals"]
        path.write_text(json.dumps(old))
    for crc in (site.folder / "state" / "manifests").glob(".*.crc"):
        crc.unlink()
    assert tuple(site.store.stats().first())[:2] == (2, 11)
    site.send(("a", 1, 5))
    site.run()
    assert tuple(site.store.stats().first())[:2] == (2, 3)


def compacted(site, **options):
    return Compactor(site.spark, str(site.folder / "obs")).run(site.store, **options)


def loose(site):
    return sorted(p.name for p in (site.folder / "obs").glob("day=*/batch=*"))


def test_compacted_days_hold_every_row_once(spark, site):
    for second in range(3):
        site.send(("a", second, second), ("b", second, second), ("a", 9, 86400 + second))
    site.run()
    cols = ["station_id", "observed_at", "parking_count", *SERIES, "batch"]
    before = rows(site.scored(), *cols)
    under_way = site.scored()  # planned before the run, read after it
    assert compacted(site, before="2025-12-27") == ["2025-12-26"]
    assert rows(site.scored(), *cols) == before == rows(under_way, *cols)
    assert len(read_scored(spark, str(site.folder / "obs"), "2025-12-26").inputFiles()) == 1
    assert read_scored(spark, str(site.folder / "obs"), "2026-01-01").count() == 0
    site.send(("a", 5, 10), ("b", 5, 11))  # late rows for the closed day
    site.send(("a", 6, 12))
    site.run()
    later = rows(site.scored(), *cols)
    assert len(later) == len(before) + 3
    assert compacted(site) == ["2025-12-26", "2025-12-27"]
    assert rows(site.scored(), *cols) == later
    assert compacted(site) == []  # takes away what is no longer needed
    assert loose(site) == []
    assert rows(site.scored(), *cols) == later and len(site.scored().inputFiles()) == 2
    assert site.scored().select("day").distinct().count() == 2


def test_batches_without_state_are_not_compacted(spark, site):
    """They may be run again, and would then stand beside their compacted rows."""
    site.send(("a", 1, 0))
    site.send(("a", 2, 1))
    site.run()
    rows_in = site.scored().drop("day", "batch")
    append_scored(rows_in, str(site.folder / "obs"), "other-0")
    assert compacted(site) == ["2025-12-26"]
    append_scored(rows_in, str(site.folder / "obs"), "other-0")
    assert site.scored().groupBy("batch").count().where("count > 0").count() == 3
    assert site.scored().count() == 4
    compacted(site)
    assert loose(site) == ["batch=other-0"]


def test_of_two_compactions_one_gives_up(spark, site, monkeypatch):
    site.send(("a", 1, 0))
    site.send(("a", 2, 1))
    site.run()
    slower = Compactor(spark, str(site.folder / "obs"))
    seen = slower.manifest()
    assert compacted(site) == ["2025-12-26"]
    monkeypatch.setattr(slower, "manifest", lambda: seen)
    assert slower.run(site.store) == []
    assert site.scored().count() == 2
    assert len(list((site.folder / "obs" / "_compact").glob("day=*/run=*"))) == 1
