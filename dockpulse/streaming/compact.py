"""Compaction of scored observations: the many small folders of a day become a few large files.

A manifest beside the days says which compacted folder of a day stands for which batches. Readers take the
compacted folders and the batch folders that no manifest entry covers, so they see every row once, before, during
and after a run. Only batches whose state is committed are taken: these are never run again. Folders that are no
longer needed go at the next run, so that readers under way can end. One compaction of a table may publish at a
time; of two, the slower one removes what it wrote and leaves the days to the next run.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from dockpulse.session import create_once, delete_path, hadoop_path, read_text
from dockpulse.streaming.store import StationStore

HIDDEN = "_compact"  # Spark's own readers of the table skip names that start so


class Compactor:
    def __init__(self, spark: SparkSession, obs_path: str):
        self.spark = spark
        self.path = obs_path.rstrip("/")
        self.home = f"{self.path}/{HIDDEN}"

    def manifest(self) -> dict:
        """``days``: folder and batches of each compacted day; ``unused``: paths to remove at the next run."""
        numbers = sorted(n for n in self._names(f"{self.home}/manifests") if n[0].isdigit())
        if not numbers:
            return {"number": -1, "days": {}, "unused": []}
        return json.loads(read_text(self.spark, f"{self.home}/manifests/{numbers[-1]}"))

    def run(self, store: StationStore, before: str | None = None, least: int = 2) -> list[str]:
        """Compact the days before ``before`` (all if None) that have ``least`` or more new batch folders.

        Returns the days. A day that got late batches is compacted again, with what it was.
        """
        seen = self.manifest()
        for path in seen["unused"]:
            delete_path(self.spark, path)
        finished = store.manifest()["done"]
        days, unused = dict(seen["days"]), []
        for day in self._days():
            known = seen["days"].get(day, {"folder": None, "batches": []})
            there = self._batches(day)
            fresh = [b for b in there if b not in known["batches"] and is_done(b, finished)]
            if len(fresh) < least or (before is not None and day >= before):
                continue
            folder = f"{self.home}/day={day}/run={uuid.uuid4().hex}"
            loose = [f"{self.path}/day={day}/batch={b}" for b in fresh]
            rows = self._read_parts([known["folder"]] if known["folder"] else [], loose)
            rows.drop("day").hint("rebalance").write.parquet(folder)
            # names of folders that are gone need no mention any more
            days[day] = {"folder": folder, "batches": [b for b in known["batches"] if b in there] + fresh}
            unused += [*loose, *([known["folder"]] if known["folder"] else [])]
        changed = [d for d in days if days[d] != seen["days"].get(d)]
        if not changed and not seen["unused"]:
            return []
        body = {"number": seen["number"] + 1, "days": days, "unused": unused}
        target = f"{self.home}/manifests/{body['number']:012d}.json"
        if not create_once(self.spark, target, json.dumps(body)):
            for day in changed:
                delete_path(self.spark, days[day]["folder"])
            return []
        return changed

    def read(self, day: str | None = None) -> DataFrame | None:
        """Every row once; None before the first one."""
        seen = self.manifest()
        folders, loose = [], []
        for one in [day] if day else sorted({*self._days(), *seen["days"]}):
            known = seen["days"].get(one, {"folder": None, "batches": []})
            if known["folder"]:
                folders.append(known["folder"])
            loose += [
                f"{self.path}/day={one}/batch={b}"
                for b in self._batches(one)
                if b not in known["batches"]
            ]
        return self._read_parts(folders, loose)

    def _read_parts(self, folders: list[str], loose: list[str]) -> DataFrame | None:
        parts = []
        if loose:
            parts.append(self.spark.read.option("basePath", self.path).parquet(*loose))
        if folders:
            reader = self.spark.read.option("basePath", self.home)
            parts.append(reader.parquet(*folders).drop("run"))
        if len(parts) == 2:
            return parts[0].unionByName(parts[1])
        return parts[0] if parts else None

    def _days(self) -> list[str]:
        return sorted(n.removeprefix("day=") for n in self._names(self.path) if n.startswith("day="))

    def _batches(self, day: str) -> list[str]:
        names = self._names(f"{self.path}/day={day}")
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))

    def _names(self, path: str) -> list[str]:
        root, fs = hadoop_path(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def is_done(batch: str, finished: dict[str, int]) -> bool:
    """Whether the state holds the batch ``<query>-<number>``."""
    query, _, number = batch.rpartition("-")
    return finished.get(query, -1) >= int(number)
