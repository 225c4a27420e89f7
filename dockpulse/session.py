"""Session settings, and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "dockpulse", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def int_conf(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block only."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a session whose executor is this process may go without; it gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="dockpulse-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage and fixes values such as partition ids; survives lost executors.
    """
    path = shared_path(df.sparkSession, name)
    if _staged.get() is not None:
        _staged.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def dropping_stages(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was staged inside, for jobs that run for long."""
    mark = _staged.set([])
    try:
        yield
    finally:
        for path in _staged.get():
            delete_path(spark, path)
        _staged.reset(mark)


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever storage it is on."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    found, fs = hadoop_path(spark, path)
    fs.delete(found, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, such as a manifest, whole."""
    found, fs = hadoop_path(spark, path)
    stream = fs.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it is there; whether it was created.

    The file appears whole: it is written beside its place and then put there.
    """
    target, fs = hadoop_path(spark, path)
    draft, _ = hadoop_path(spark, f"{target.getParent().toString()}/_{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    stream = fs.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    try:
        if fs.getScheme() == "file":  # a local rename would replace what is there
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        return fs.rename(draft, target)
    except FileExistsError:
        return False
    finally:
        fs.delete(draft, False)
