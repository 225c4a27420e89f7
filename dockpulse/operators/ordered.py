"""Row-based windows over one key's series that stay parallel when a key is hot.

A plain ``Window.partitionBy(key)`` puts each key into one task. Here keys above a row
limit are laid out by range of (key, order) instead, so that a hot key spans many tasks.
Each piece is given copies of the few rows just outside it, and the same window columns
are computed per piece. The result is the same as the plain window, for every row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dockpulse.session import int_conf, stage

HOT_KEY_ROWS = 4_000_000  # spark.dockpulse.hotKeyRows; 0 for data known to have no hot key
PIECE_ROWS = 2_000_000  # spark.dockpulse.pieceRows
MOST_PIECES = 20_000  # pieces grow beyond PIECE_ROWS where there would be more of them

WindowColumns = Callable[[WindowSpec], list[Column]]


def series_window(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    columns: WindowColumns,
    inputs: Sequence[str],
    before: int = 0,
    after: int = 0,
    at_most: int | None = None,
) -> DataFrame:
    """Add ``columns(window)`` to every row of ``df``.

    ``order_cols`` must be a total order within a key. The columns may read ``inputs`` of at
    most ``before`` earlier and ``after`` later rows. Where it is known that no key has more
    than ``at_most`` rows, the keys need not be counted.
    """
    spark = df.sparkSession
    limit = int_conf(spark, "spark.dockpulse.hotKeyRows", HOT_KEY_ROWS)
    plain = Window.partitionBy(key).orderBy(*order_cols)
    if limit == 0 or (at_most is not None and at_most <= limit):
        return df.select("*", *columns(plain))
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows"))
    hot = counts.where(F.col("_rows") > limit)
    rows = hot.agg(F.sum("_rows")).first()[0]
    if not rows:  # nothing is written for keys that are not there
        return df.select("*", *columns(plain))
    hot = stage(hot, "hot-keys")
    # How the hot keys meet the rows is left to Spark: it knows the size of the staged table.
    same = df[key].eqNullSafe(hot["_hot"])
    calm = df.join(hot, same, "left_anti").select("*", *columns(plain))
    pieces = _pieces(columns, key, order_cols, inputs, before, after)
    return calm.unionByName(pieces(df.join(hot, same, "left_semi"), rows))


def _pieces(columns, key, order_cols, inputs, before, after):
    carried = [c for c in dict.fromkeys([*order_cols, *inputs]) if c != key]

    def run(df: DataFrame, rows: int) -> DataFrame:
        size = int_conf(df.sparkSession, "spark.dockpulse.pieceRows", PIECE_ROWS)
        size = max(size, math.ceil(rows / MOST_PIECES))
        laid = df.repartitionByRange(math.ceil(rows / size) + 1, key, *order_cols)
        # Staged, because the piece of a row must be the same for all readers below.
        laid = stage(laid.withColumn("_piece", F.spark_partition_id()), "pieces")
        body = laid.withColumn("_copy", F.lit(False))
        for count, later in ((before, False), (after, True)):
            if count:
                outside = _outside(laid, key, order_cols, carried, count, later)
                body = body.unionByName(outside, allowMissingColumns=True)
        window = Window.partitionBy(key, "_piece").orderBy(*order_cols)
        done = body.select("*", *columns(window)).where(~F.col("_copy"))
        return done.drop("_copy", "_piece")

    return run


def _outside(laid, key, order_cols, carried, count, later):
    """For each piece, copies of the ``count`` rows just before (or after) it.

    Only the rows at the edge of a piece can be wanted by another piece; the limit on
    ``_rank`` is applied before the shuffle, so few rows move.
    """
    up = [F.col(c).asc_nulls_first() for c in order_cols]
    down = [F.col(c).desc_nulls_last() for c in order_cols]
    toward, away = (down, up) if later else (up, down)
    rank = F.row_number().over(Window.partitionBy(key, "_piece").orderBy(*away))
    edge = (
        laid.select(key, "_piece", *carried)
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= count)
    )
    along = Window.partitionBy(key).orderBy(*toward)
    return (
        edge.select(
            key,
            "_piece",
            F.lag("_piece").over(along).alias("_last"),
            F.collect_list(F.struct(*carried)).over(along.rowsBetween(-count, -1)).alias("_rows"),
        )
        .where(F.col("_last") != F.col("_piece"))
        .select(key, "_piece", F.inline("_rows"))
        .withColumn("_copy", F.lit(True))
    )
