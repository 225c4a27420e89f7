"""The jobs one after the other, as their users start them."""

import json
import os

import pytest
from conftest import rows

from dockpulse import jobs
from dockpulse.__main__ import parser, run
from dockpulse.operators.clean import merge_snapshots
from dockpulse.operators.forecast import load_model
from dockpulse.schemas import SNAPSHOT
from dockpulse.sources.observations import decode_json, read_observations
from dockpulse.sources.snapshots import read_snapshots, write_snapshot_csv
from dockpulse.streaming.store import StationStore


@pytest.fixture(scope="module")
def site(spark, tmp_path_factory):
    """Two polls have gone through publishing and the stream."""
    base = tmp_path_factory.mktemp("site")
    (base / "landing").mkdir()

    def start(*arguments):
        run(spark, parser().parse_args([str(a).replace("@", str(base)) for a in arguments]))

    for i, shift in enumerate((0, 3)):
        entries = [
            {
                "stationId": f"ST-{k}",
                "stationName": f"{name}역",
                "parkingBikeTotCnt": str(4 * k + shift),
                "rackTotCnt": "20",
            }
            for k, name in enumerate(("Elm", "Oak", "Yew"))
        ]
        entries.append({**entries[0], "stationId": "X", "stationName": "Park"})
        document = {"rentBikeStatus": {"row": entries}}
        (base / "landing" / f"{i}.json").write_text(json.dumps(document), encoding="utf-8")
        start("publish", "--landing", "@/landing", "--out", "@/messages",
              "--checkpoint", "@/cp-publish", "--trigger", "once")
        start("stream", "--messages", "@/messages", "--state", "@/state",
              "--observations", "@/observations", "--checkpoint", "@/cp", "--trigger", "once")
        start("snapshot", "--state", "@/state", "--out", f"@/snapshot_{i}.csv")
    start("merge", "--snapshots", "@/snapshot_*.csv", "--out", "@/merged.csv")
    return base


def test_state_and_stats(spark, site):
    listed = jobs.stations(spark, str(site / "state"))
    assert rows(listed, "station_id", "parking_count", "predicted_count", "change_symbol") == [
        ("ST-0", 3, 2, "▼"),
        ("ST-1", 7, 5, "▼"),
        ("ST-2", 11, 9, "▼"),
    ]
    assert tuple(jobs.stats(spark, str(site / "state")).first()) == (3, 21, 7.0, 7.0, 1)


def test_search_and_detail(spark, site):
    assert rows(jobs.stations(spark, str(site / "state"), "oAk"), "station_id") == [("ST-1",)]
    assert jobs.station(spark, str(site / "state"), "ST-2").first()["change"] == -2
    assert jobs.station(spark, str(site / "state"), "X").isEmpty()


def test_merged_snapshots_hold_both_polls(spark, site):
    merged = read_snapshots(spark, str(site / "merged.csv"))
    assert merged.count() == 6
    assert merged.select("station_id", "timestamp").distinct().count() == 6


def test_training_from_snapshot_files(spark, tmp_path):
    for i in range(12):
        data = [
            (f"s{k}", f"2025-12-26T{8 + i:02d}:00:00", (3 * k + i) % 17, 8 + i, 4, 0)
            for k in range(25)
        ]
        frame = spark.createDataFrame(data, SNAPSHOT)
        write_snapshot_csv(frame, str(tmp_path / f"snapshot_{i}.csv"))
    done = jobs.train(spark, str(tmp_path / "snapshot_*.csv"), str(tmp_path / "model"), maxIter=3)
    assert done.metrics.count() == 2 and done.importances.count() == 15
    # 12 rows a station, less 3 without lags and 2 without a target
    assert sum(r["n"] for r in done.metrics.collect()) == 25 * 7
    assert done.comparison.first()["model_mae"] is not None
    assert load_model(str(tmp_path / "model")).stages[-1].getNumTrees == 3


def test_every_station_is_written(spark, tmp_path, capsys):
    state = spark.range(1500).selectExpr(
        "CAST(id AS STRING) AS station_id", "'Stop' AS station_name", "CAST(id % 9 AS INT) AS parking_count",
        "9 AS rack_total", "'' AS timestamp", "TIMESTAMP_NTZ'2025-01-01 00:00:00' AS observed_at",
        "id AS seq", "3 AS predicted_count", "'simple' AS model", "array(1) AS history",
    )
    StationStore(spark, str(tmp_path / "state")).write(state, "q", 0)
    arguments = ["stations", "--state", str(tmp_path / "state"), "--out", str(tmp_path / "out")]
    run(spark, parser().parse_args(arguments))
    assert "1500 stations" in capsys.readouterr().out
    assert spark.read.json(str(tmp_path / "out")).select("station_id").distinct().count() == 1500


def test_polls_published_together_keep_their_times(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    for i, count in enumerate((12, 8, 5)):
        row = {"stationId": "S", "stationName": "Elm역", "parkingBikeTotCnt": str(count), "rackTotCnt": "20"}
        path = tmp_path / "landing" / f"{9 - i}.json"
        path.write_text(json.dumps({"rentBikeStatus": {"row": [row]}}), encoding="utf-8")
        os.utime(path, (1_700_000_000 + 30 * i, 1_700_000_000 + 30 * i))
    arguments = ["publish", "--landing", str(tmp_path / "landing"), "--out", str(tmp_path / "messages")]
    arguments += ["--checkpoint", str(tmp_path / "cp"), "--trigger", "once"]
    run(spark, parser().parse_args(arguments))
    decoded = decode_json(read_observations(spark, "text", streaming=False, path=str(tmp_path / "messages")))
    merged = merge_snapshots([decoded]).collect()
    assert [r["parking_count"] for r in merged] == [12, 8, 5]


def test_rounds_of_both_parts(spark, tmp_path):
    for i in range(12):
        data = [(f"s{k}", f"2025-12-26T{8 + i:02d}:00:00", (3 * k + i) % 17, 8 + i, 4, 0) for k in range(25)]
        data.append(("s0", f"2025-12-26T{8 + i:02d}:30:00", -5, 8 + i, 4, 0))
        write_snapshot_csv(spark.createDataFrame(data, SNAPSHOT), str(tmp_path / f"snapshot_{i}.csv"))
    done = jobs.train(spark, str(tmp_path / "snapshot_*.csv"), str(tmp_path / "model"), split="time", maxIter=3)
    assert {r["part"] for r in done.rounds.collect()} == {"train", "test"}
    # Seven rows a station remain; the two whose target lies in the tested part are on neither side.
    assert sum(r["n"] for r in done.metrics.collect()) == 25 * 5


def test_training_with_columns_drawn_per_tree(spark, tmp_path):
    for i in range(12):
        data = [(f"s{k}", f"2025-12-26T{8 + i:02d}:00:00", (3 * k + i) % 17, 8 + i, 4, 0) for k in range(25)]
        write_snapshot_csv(spark.createDataFrame(data, SNAPSHOT), str(tmp_path / f"snapshot_{i}.csv"))
    files, kept = str(tmp_path / "snapshot_*.csv"), str(tmp_path / "model")
    done = jobs.train(spark, files, kept, draw="tree", rounds=3, patience=None)
    lines = [(r["part"], r["round"]) for r in done.rounds.collect()]
    assert sorted(lines) == [(p, k) for p in ("test", "train") for k in (1, 2, 3)]
    last = {r["part"]: r["rmse"] for r in done.rounds.where("round = 3").collect()}
    for row in done.metrics.collect():
        assert abs(row["rmse"] - last[row["part"]]) < 1e-9
    assert len(load_model(kept).stages) == 8
    with pytest.raises(ValueError):
        jobs.train(spark, files, kept, draw="leaf")
