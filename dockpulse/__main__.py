"""``python -m dockpulse <job>``, or the same file under ``spark-submit``."""

from __future__ import annotations

import argparse

from dockpulse import jobs
from dockpulse.operators.forecast import load_model
from dockpulse.session import build_session
from dockpulse.sources.observations import decode_json, read_observations
from dockpulse.streaming.jobs import fan_out, plain_streams, station_job


SHOWN = 20


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="dockpulse")
    job = top.add_subparsers(dest="job", required=True)

    def add(name, *needed, **optional):
        one = job.add_parser(name)
        for option in needed:
            one.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            one.add_argument(f"--{option}", default=default)

    source = {"servers": None, "topic": None, "messages": None, "starting": "latest"}
    source |= {"files": 100, "offsets": 1_000_000}  # at most so many in a micro-batch
    pace = {"trigger": "30 seconds"}
    sink = {"servers": None, "topic": None, "out": None, "files": 100}
    add("publish", "landing", "checkpoint", **sink, **pace)
    kept = ("state", "observations", "checkpoint")
    add("stream", *kept, model=None, order="event", **source, **pace)
    add("plain", **source, **pace)
    add("results", "out", "checkpoint", **source, **pace)
    add("compact", "state", "observations", before=None)
    add("snapshot", "state", "out")
    add("merge", "snapshots", "out")
    add("train", "snapshots", "model", split="hash", draw="node")
    add("stations", "state", search="", out=None)
    add("station", "state", "id")
    add("stats", "state")
    return top


def messages(spark, args):
    """Decoded messages of a topic, or of a folder of text files."""
    if args.messages:
        pace = {"maxFilesPerTrigger": args.files}
        return decode_json(read_observations(spark, "text", path=args.messages, **pace))
    options = {"kafka.bootstrap.servers": args.servers, "subscribe": args.topic}
    options |= {"startingOffsets": args.starting, "maxOffsetsPerTrigger": args.offsets}
    return decode_json(read_observations(spark, "kafka", **options))


def run(spark, args) -> None:
    trigger = None if getattr(args, "trigger", None) == "once" else getattr(args, "trigger", None)
    if args.job == "publish":
        if args.out:
            sink, options = "text", {"path": args.out}
        else:
            sink = "kafka"
            options = {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
        jobs.publish_feed(
            spark, args.landing, sink, args.checkpoint, trigger=trigger, files=args.files, **options
        ).awaitTermination()
    elif args.job == "stream":
        model = load_model(args.model) if args.model else None
        station_job(
            messages(spark, args),
            args.state,
            args.observations,
            args.checkpoint,
            model,
            trigger,
            args.order,
        ).awaitTermination()
    elif args.job == "plain":
        decoded = messages(spark, args)
        decoded.printSchema()
        started = plain_streams(decoded, trigger=trigger)
        for query in started.values():
            query.awaitTermination()
    elif args.job == "results":
        fan_out(messages(spark, args), args.out, args.checkpoint, trigger).awaitTermination()
    elif args.job == "compact":
        days = jobs.compact(spark, args.state, args.observations, args.before)
        print(f"{len(days)} days compacted")
    elif args.job == "snapshot":
        jobs.collect_snapshot(spark, args.state, args.out)
    elif args.job == "merge":
        jobs.merge_files(spark, args.snapshots, args.out)
    elif args.job == "train":
        done = jobs.train(spark, args.snapshots, args.model, args.split, args.draw)
        for report in (done.metrics, done.comparison, done.importances, done.rounds):
            report.show(report.count(), truncate=False)  # one row per part, feature or round
    elif args.job == "stations":
        listed = jobs.stations(spark, args.state, args.search)
        if args.out:  # every station, as JSON lines; printing shows the first ones only
            listed.write.json(args.out)
            listed = spark.read.schema(listed.schema).json(args.out)
        print(f"{listed.count()} stations, of which the first {SHOWN}:")
        listed.orderBy("station_id").show(SHOWN, truncate=False)
    elif args.job == "station":
        jobs.station(spark, args.state, args.id).show(truncate=False)
    elif args.job == "stats":
        jobs.stats(spark, args.state).show(truncate=False)


if __name__ == "__main__":
    run(build_session(), parser().parse_args())
