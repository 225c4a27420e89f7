"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os
import zlib
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

PIECE_BYTES = 2 << 20  # text that a task holds as Python objects at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    On a cluster the package is installed, or sent along with ``--py-files``, as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def quoted(name: str) -> str:
    """A column's name for ``select``, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def release_memory() -> None:
    """Give back what a task has freed. Workers serve many tasks, and the allocators keep what they had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class SizedCache(dict):
    """Results by text, emptied at ``most`` bytes of keys and values; long texts are not kept."""

    LONGEST = 256

    def __init__(self, most: int):
        super().__init__()
        self.most, self.size = most, 0

    def keep(self, text: str | bytes, value: object, size: int) -> None:
        if len(text) > self.LONGEST:
            return
        size += len(text) + 150  # an entry and its two objects
        if self.size + size > self.most:
            self.clear()
            self.size = 0
        self[text] = value
        self.size += size


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(batch: pa.RecordBatch, column: int | str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece stay near ``PIECE_BYTES``; a row is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    start = held = 0
    for i, size in enumerate(sizes.to_pylist()):
        if held and held + size > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def annotate(
    df: DataFrame,
    into: str,
    fields: T.StructType,
    make: Callable[[], Callable[[list], Sequence[Sequence]]],
    text: str,
    keep: Sequence[str] | None = None,
    beside: Sequence[str] = (),
) -> DataFrame:
    """Append the struct column ``into``, computed from the text column of each row.

    ``make`` runs once per task and returns a function from a list of texts (None for null), and one
    list for each column of ``beside``, to one sequence of values per field. ``keep`` names the columns that are returned (all by default); one
    called like ``into`` gives way to it, see ``fresh`` for a name that is free.
    Rows are neither dropped, moved nor joined: one narrow pass, whatever other columns there are.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() != into.lower()]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(into, fields)])
    kinds = [pa.field(f.name, to_arrow_type(f.dataType)) for f in fields]

    # mapInArrow resolves names as they are, so columns travel under plain ones
    place = {c: i for i, c in enumerate(dict.fromkeys([*keep, text, *beside]))}

    def run(batches):
        work = make()
        for batch in batches:
            for part in pieces(batch, place[text]):
                values = work(*[part.column(place[c]).to_pylist() for c in (text, *beside)])
                arrays = [pa.array(v, k.type) for v, k in zip(values, kinds, strict=True)]
                made = pa.StructArray.from_arrays(arrays, fields=kinds)
                yield pa.RecordBatch.from_arrays([*(part.column(place[c]) for c in keep), made], names=[*keep, into])
        del work
        release_memory()

    return df.select(*[F.col(quoted(c)).alias(f"c{i}") for c, i in place.items()]).mapInArrow(run, schema)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4 (a null id counts as empty)."""
    text = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(None)).cast("string")
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")) % 4 == 2


def is_held_out(doc_id: object) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


SHARES = 1 << 30


def hash_place(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SHARES))


def hash_cutoff(n: int, wanted: int) -> int:
    """Below this place stand the first ``wanted`` of ``n`` rows by hash, with room to spare.

    A sample taken below it is cut down where the rows are, and is the same in any layout.
    """
    return SHARES if n <= 2 * wanted + 100 else SHARES * (2 * wanted + 100) // n
