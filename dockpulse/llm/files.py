"""Files that tasks write and range-read in the shared folder, and hashing over arrays."""

from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession

from dockpulse.session import shared_path


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address (``file:``, ``hdfs:``, ``s3:``, ``gs:``) or a local path."""
    return fs.FileSystem.from_uri(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` for files that tasks write themselves."""
    folder = shared_path(spark, name)
    system, inside = locate(folder)
    system.create_dir(inside, recursive=True)
    return folder


def attempt_path(folder: str, number: int, ending: str) -> str:
    """A name of its own for each attempt of a task: only files named in the manifest count."""
    return f"{folder}/part-{number:06d}-{uuid.uuid4().hex}{ending}"


MIX = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + MIX * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * MIX_A
        x = (x ^ (x >> np.uint64(27))) * MIX_B
        return x ^ (x >> np.uint64(31))
