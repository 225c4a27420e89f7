"""One micro-batch: features from carried history, forecast, and new state.

The history of a station travels between batches as an array in the state table and enters
a batch as a few extra rows before the station's new ones. The lags are then plain window
columns, so a station with a large part of the batch is split like any hot key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockpulse.functions.calendar import calendar_features
from dockpulse.operators.clean import clean
from dockpulse.operators.forecast import score_with_fallback
from dockpulse.operators.latest import latest_state
from dockpulse.operators.series import previous_counts, serve_columns
from dockpulse.schemas import HISTORY_DEPTH, OBSERVATION
from dockpulse.session import dropping_stages, hadoop_path
from dockpulse.sources.observations import with_event_order
from dockpulse.streaming.compact import Compactor
from dockpulse.streaming.store import BUCKETS, STATE, StationStore

ORDER = ("observed_at", "seq")
PLACE = ("source_part", "source_block", "seq")  # offsets count within a partition or file only


def order_columns(df: DataFrame, order: str) -> list[str]:
    """Columns that order a batch: by ``event`` time, or by ``arrival`` at the source.

    Messages of one time follow their place in the source, which no two messages share.
    """
    place = [c for c in PLACE if c in df.columns]
    if order == "event":
        return ["observed_at", *place]
    if order != "arrival":
        raise ValueError(f"order must be 'event' or 'arrival', not {order!r}")
    if not place:
        raise ValueError("order of arrival needs a source that numbers its messages")
    return [*(c for c in ("arrived_at",) if c in df.columns), *place]


def stateful_lags(
    batch: DataFrame,
    state: DataFrame,
    key: str = "station_id",
    order_cols: Sequence[str] = ORDER,
    value: str = "parking_count",
    depth: int = HISTORY_DEPTH,
    batch_rows: int | None = None,
    timeout: timedelta | None = None,
) -> DataFrame:
    """Add ``previous``: earlier values from this batch, then from the ``history`` in ``state``.

    Earlier batches come first whatever their times; within the batch ``order_cols`` decide.
    With ``timeout``, a station that was silent for longer starts anew: values from before the gap in
    event time do not count. A kept history has no such gap, so only the time of the state is carried.
    """
    seen = batch.select(key).distinct()
    slots = state.join(seen, key, "left_semi").select(key, "observed_at", F.posexplode("history"))
    carried = slots.select(key, "observed_at", (-F.col("pos")).alias("_slot"), F.col("col").alias(value))
    rows = batch.withColumn("_slot", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    at_most = None if batch_rows is None else batch_rows + depth
    order = ["_slot", *order_cols]
    if timeout is None:
        wide = previous_counts(rows, key, order, value, depth - 1, at_most=at_most)
        return wide.where(F.col("_slot") == 1).drop("_slot")
    timed = rows.withColumn("_seen", F.struct(F.col(value).alias("n"), F.col("observed_at").alias("at")))
    wide = previous_counts(timed, key, order, "_seen", depth - 1, at_most=at_most)
    times = F.transform("previous", lambda p: p["at"])
    later = F.concat(F.array("observed_at"), F.slice(times, 1, depth - 2))
    longest = F.lit(timeout)
    gaps = F.zip_with(later, times, lambda b, a: F.coalesce(b - a > longest, F.lit(False)))
    first_gap = F.array_position(gaps, True)
    held = F.transform(
        "previous", lambda p, i: F.when((first_gap == 0) | (i + 1 < first_gap), p["n"])
    )
    wide = wide.withColumn("previous", held)
    return wide.where(F.col("_slot") == 1).drop("_slot", "_seen")


def score_batch(
    batch: DataFrame,
    state: DataFrame,
    model: PipelineModel | None,
    order_cols: Sequence[str] = ORDER,
    batch_rows: int | None = None,
    timeout: timedelta | None = None,
) -> DataFrame:
    """Serving features, forecast and the history after each row."""
    lagged = stateful_lags(
        batch, state, order_cols=order_cols, batch_rows=batch_rows, timeout=timeout
    )
    wide = serve_columns(lagged, "parking_count")
    register = F.concat(F.array("parking_count"), F.col("previous"))
    wide = wide.withColumn("history", F.array_compact(register)).drop("previous")
    return score_with_fallback(model, calendar_features(wide, "observed_at"))


def upsert_batch(
    df: DataFrame,
    batch_id: int,
    state_path: str,
    obs_path: str,
    model: PipelineModel | None = None,
    query: str = "batch",
    buckets: int = BUCKETS,
    order: str = "event",
    timeout: timedelta | None = None,
) -> None:
    """Append the scored rows of a batch, then bring the state of its stations up to date.

    Rows go to ``day=/batch=`` folders, and a batch that is run again replaces its own; once
    its state is complete it does nothing. Only the state's buckets with stations of the batch are read
    and written again. ``timeout`` is that of ``stateful_lags``.
    """
    spark = df.sparkSession
    store = StationStore(spark, state_path, buckets)
    if store.holds(query, batch_id):
        return
    if order == "arrival":
        order_columns(df, order)  # before numbers of our own could stand in for the source's
    with dropping_stages(spark), kept(with_event_order(numbered(clean(df)))) as rows:
        order_cols = order_columns(rows, order)
        count = rows.count()
        if not count:
            return
        touched = store.touched(rows)
        before = store.read(touched)
        with kept(score_batch(rows, before, model, order_cols, count, timeout)) as scored:
            append_scored(scored, obs_path, f"{query}-{batch_id}")
            store.commit(lambda now: merge_state(now, scored, order_cols), touched, query, batch_id)


def numbered(df: DataFrame) -> DataFrame:
    """Number the rows by their place in the source files, unless the source has done so.

    Within a part of a file the numbers rise with the lines, however files are dealt to tasks, so
    (file, start of the part, number) orders the rows alike on every cluster. Copies of one message
    get numbers of their own, so that many of them can be split like other rows.
    """
    return df if "seq" in df.columns else df.withColumn("seq", F.monotonically_increasing_id())


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` held for several readers; a lost part is computed again from the source."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def append_scored(scored: DataFrame, obs_path: str, batch: str) -> None:
    """Write rows below their day, in few files, and in several where a day holds many rows."""
    dated = scored.withColumns({"day": F.to_date("observed_at"), "batch": F.lit(batch)})
    dated.hint("rebalance", "day").write.partitionBy("day", "batch").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(obs_path)


def merge_state(
    before: DataFrame, scored: DataFrame, order_cols: Sequence[str] = ORDER
) -> DataFrame:
    """New state of the stations in ``scored``.

    By event time the last observation stays current, also against the state before (of the same
    moment, the new one); by arrival the new one does. The history follows the order of arrival of the batches.
    """
    names = STATE.fieldNames()
    fresh = latest_state(scored, "station_id", order_cols).select(*names)
    known = before.join(fresh.select("station_id"), "station_id", "left_semi")
    both = fresh.withColumn("_new", F.lit(1)).unionByName(known.withColumn("_new", F.lit(0)))
    shown = [c for c in names if c not in ("station_id", "history")]
    by_event = order_cols[0] == "observed_at"
    last = F.struct("observed_at", "_new") if by_event else F.col("_new")
    return (
        both.groupBy("station_id")
        .agg(
            F.max_by(F.struct(*shown), last).alias("_row"),
            F.max_by("history", "_new").alias("history"),
        )
        .select("station_id", "_row.*", "history")
    )


def read_scored(spark, obs_path: str, day: str | None = None) -> DataFrame:
    """Scored observations so far; with ``day`` only that day's folders are listed and read.

    Each row is read once, whether its day is compacted or not. Before the first row is written the
    table is empty.
    """
    compactor = Compactor(spark, obs_path)
    found, fs = hadoop_path(spark, obs_path)
    if fs.exists(found) and compactor.manifest()["days"]:
        rows = compactor.read(day)
        return compactor.read().where(F.lit(False)) if rows is None else rows
    if not fs.exists(found):
        nothing = spark.createDataFrame([], StructType([*OBSERVATION.fields]))
        rows = with_event_order(numbered(nothing))
        scored = score_batch(rows, StationStore(spark, f"{obs_path}/none").read(), None)
        return scored.withColumns({"day": F.to_date("observed_at"), "batch": F.lit("")})
    reader = spark.read.option("basePath", obs_path)
    return reader.parquet(f"{obs_path.rstrip('/')}/day={day}" if day else obs_path)
