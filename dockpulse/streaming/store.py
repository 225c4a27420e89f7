"""The latest state of every station, laid out by key in one folder.

Stations are dealt to hash buckets. A commit writes only the buckets of the stations it changed, each whole,
below a folder of its own, and then publishes a manifest that says where every bucket stands. So a
batch reads and rewrites the buckets it touches, a lookup opens one bucket, and a reader that holds a manifest
sees one state throughout.

Manifests are numbered, and a number is taken by creating its file, which fails if it is there: of two
writers one wins, and the other reads the new state, merges its change into that and tries the next number. The
manifest also holds the last batch of each streaming query, so a batch that is run again is found and skipped.
Beside each bucket stand its totals, so the statistics of the fleet are sums over the manifest: a commit takes out
the old totals of the buckets it rewrites and puts in the new ones, and no reader scans the state for them.
The newest ``KEEP`` manifests and what they name stay, for readers under way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.operators.serving import fleet_totals, stats_of
from dockpulse.schemas import OBSERVATION
from dockpulse.session import create_once, delete_path, hadoop_path, read_text

STATE = T.StructType(
    [
        *OBSERVATION.fields,
        T.StructField("observed_at", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
        T.StructField("predicted_count", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("history", T.ArrayType(T.IntegerType())),
    ]
)

BUCKETS = 16
KEEP = 20
TOTALS = "total_stations long, total_bikes long, low_stock_count long"


class StationStore:
    """``buckets`` counts for a new folder; one that is there keeps its number."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets

    def versions(self) -> list[int]:
        """Numbers of the published manifests, oldest first."""
        root, fs = hadoop_path(self.spark, f"{self.path}/manifests")
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())

    def manifest(self, number: int | None = None) -> dict:
        """The newest manifest, or that of ``number``; before the first one an empty one."""
        if number is None:
            known = self.versions()
            if not known:
                return {"number": -1, "buckets": self.buckets, "folders": {}, "done": {}, "totals": {}}
            number = known[-1]
        return json.loads(read_text(self.spark, self._manifest_path(number)))

    def holds(self, query: str, batch: int) -> bool:
        return self.manifest()["done"].get(query, -1) >= batch

    def read(self, only: Iterable[int] | None = None, manifest: dict | None = None) -> DataFrame:
        """One row per station; with ``only``, of these buckets."""
        seen = manifest or self.manifest()
        wanted = None if only is None else set(only)
        paths = [
            self._bucket_path(folder, int(b))
            for b, folder in sorted(seen["folders"].items())
            if wanted is None or int(b) in wanted
        ]
        if not paths:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in STATE.fields]
            return self.spark.range(1).where(F.lit(False)).select(*nothing)
        return self.spark.read.schema(STATE).parquet(*paths)

    def station(self, station_id: str) -> DataFrame:
        """The row of one station, from its bucket."""
        seen = self.manifest()
        place = self.spark.range(1).select(bucket_of(F.lit(station_id), seen["buckets"])).first()[0]
        return self.read([place], seen).where(F.col("station_id") == F.lit(station_id))

    def current(self) -> DataFrame:
        return self.read().drop("predicted_count", "model", "history")

    def prediction(self) -> DataFrame:
        return self.read().select(
            "station_id", "predicted_count", "model", "timestamp", "observed_at"
        )

    def stats(self) -> DataFrame:
        """Statistics of the fleet from the totals in the manifest, without a scan of the state."""
        seen = self.manifest()
        known = seen.get("totals", {})
        if known.keys() != seen["folders"].keys():  # buckets written before totals were kept
            return stats_of(fleet_totals(self.read(manifest=seen)))
        sums = [sum(part) for part in zip(*known.values())] or [0, 0, 0]
        return stats_of(self.spark.createDataFrame([sums], TOTALS))

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that hold the stations of ``rows``; there are no more than the store has."""
        place = bucket_of(F.col("station_id"), self.manifest()["buckets"])
        return sorted(r[0] for r in rows.select(place.alias("bucket")).distinct().collect())

    def write(self, changed: DataFrame, query: str, batch: int) -> None:
        """Replace the rows of the stations in ``changed``."""
        self.commit(lambda _: changed, self.touched(changed), query, batch)

    def commit(
        self, change: Callable[[DataFrame], DataFrame], touched: list[int], query: str, batch: int
    ) -> None:
        """Publish ``change(before)``: the new rows of stations in the buckets ``touched``.

        If another writer was faster, ``change`` is asked again with the state that it left.
        """
        while True:
            seen = self.manifest()
            if seen["done"].get(query, -1) >= batch:
                return
            folder = uuid.uuid4().hex
            before = self.read(touched, seen)
            rows = replaced(before, change(before))
            dated = rows.withColumn("bucket", bucket_of(F.col("station_id"), seen["buckets"]))
            if touched:
                dated.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(
                    f"{self.path}/data/{folder}"
                )
            root, fs = hadoop_path(self.spark, f"{self.path}/data/{folder}")
            there = [b for b in touched if fs.exists(hadoop_path(self.spark, self._bucket_path(folder, b))[0])]
            done = {
                "number": seen["number"] + 1,
                "buckets": seen["buckets"],
                "folders": {**seen["folders"], **{str(b): folder for b in there}},
                "done": {**seen["done"], query: batch},
                "totals": {**seen.get("totals", {}), **self._totals(folder, there)},
            }
            if create_once(self.spark, self._manifest_path(done["number"]), json.dumps(done)):
                self._forget()
                return
            delete_path(self.spark, f"{self.path}/data/{folder}")

    def _totals(self, folder: str, buckets: list[int]) -> dict[str, list[int]]:
        """Totals of each bucket just written: one column is read, and one row per bucket comes back."""
        if not buckets:
            return {}
        schema = T.StructType([STATE["parking_count"], T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data/{folder}")
        return {str(r[0]): list(r[1:]) for r in fleet_totals(rows, "bucket").collect()}

    def _bucket_path(self, folder: str, bucket: int) -> str:
        return f"{self.path}/data/{folder}/bucket={bucket}"

    def _manifest_path(self, number: int) -> str:
        return f"{self.path}/manifests/{number:012d}.json"

    def _forget(self) -> None:
        """Remove manifests before the newest ``KEEP``, and folders that only these name."""
        numbers = self.versions()
        if len(numbers) <= KEEP:
            return
        kept = {f for n in numbers[-KEEP:] for f in self.manifest(n)["folders"].values()}
        for number in numbers[:-KEEP]:
            for folder in set(self.manifest(number)["folders"].values()) - kept:
                delete_path(self.spark, f"{self.path}/data/{folder}")
            delete_path(self.spark, self._manifest_path(number))


def bucket_of(station_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(station_id.cast("string")), F.lit(buckets)).cast("int")


def replaced(before: DataFrame, changed: DataFrame) -> DataFrame:
    """``before`` with the rows of the stations in ``changed`` in place of their own; one shuffle."""
    names = STATE.fieldNames()
    rest = [c for c in names if c != "station_id"]
    columns = [F.col(f.name).cast(f.dataType) for f in STATE.fields]
    both = before.select(*columns, F.lit(0).alias("_new")).unionByName(
        changed.select(*columns, F.lit(1).alias("_new"))
    )
    last = F.max_by(F.struct(*rest), "_new").alias("_row")
    return both.groupBy("station_id").agg(last).select("station_id", "_row.*")
