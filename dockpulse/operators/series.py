"""Lag, rolling, difference and target columns of a station's series."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from dockpulse.operators.ordered import series_window
from dockpulse.schemas import HISTORY_DEPTH, LABEL


def ts_features(
    df: DataFrame,
    key: str = "station_id",
    order_cols: Sequence[str] = ("observed_at", "seq"),
    value: str = "parking_count",
    mode: str = "train",
    lags: int = 3,
    windows: Sequence[int] = (3, 6),
    horizon_rows: int = 2,
    target_time: bool = False,
) -> DataFrame:
    """Series features in one of two forms.

    ``train``: missing predecessors stay null, means use the rows there are, a target
    ``horizon_rows`` ahead is added, and rows with a null in a base, lag, difference or
    target column are dropped. With ``target_time``, ``target_at`` is the time of the target.
    ``serve``: every row is kept, missing predecessors count as zero, means have a fixed divisor.
    """
    if mode not in ("train", "serve"):
        raise ValueError(f"mode must be 'train' or 'serve', not {mode!r}")
    train = mode == "train"
    depth = max(lags, max(windows) - 1, 2)
    horizon = horizon_rows if train else 0
    timed = target_time and train
    wide = previous_counts(df, key, order_cols, value, depth, horizon, target_time=timed)
    if not train:
        return serve_columns(wide, value, lags, windows).drop("previous")
    made = train_columns(wide, value, lags, windows).drop("previous")
    needed = [f"{value}_lag_{k}" for k in range(1, lags + 1)]
    needed += [f"{value}_diff_{k}" for k in (1, 2)]
    return made.dropna(subset=[key, *order_cols, value, *needed, LABEL])


def previous_counts(
    df: DataFrame,
    key: str,
    order_cols: Sequence[str],
    value: str,
    depth: int,
    horizon: int = 0,
    at_most: int | None = None,
    target_time: bool = False,
) -> DataFrame:
    """Add ``previous``: the ``depth`` earlier values of the key, newest first, null if missing.

    With a ``horizon``, ``target`` is the value that many rows later. Everything else is made
    from these by plain columns: offsets cost a window much less than sliding frames.
    """

    def columns(w: WindowSpec):
        made = [F.array(*_lags(w, value, depth)).alias("previous")]
        if horizon:
            made.append(F.lead(value, horizon).over(w).alias(LABEL))
        if target_time:
            made.append(F.lead(order_cols[0], horizon).over(w).alias("target_at"))
        return made

    return series_window(df, key, order_cols, columns, [value], depth, horizon, at_most)


def train_columns(
    df: DataFrame, value: str, lags: int = 3, windows: Sequence[int] = (3, 6)
) -> DataFrame:
    """Training features from the array ``previous``: nulls stay, means are of present rows."""
    now = F.col(value)
    made = {f"{value}_lag_{k}": _earlier(k) for k in range(1, lags + 1)}
    for n in windows:
        slots = [now, *[_earlier(k) for k in range(1, n)]]
        present = _sum([s.isNotNull().cast("int") for s in slots])
        made[f"{value}_ma_{n}"] = F.try_divide(_total(slots), present)
    for k in (1, 2):
        made[f"{value}_diff_{k}"] = now - _earlier(k)
    return df.withColumns(made)


def serve_columns(
    df: DataFrame, value: str, lags: int = 3, windows: Sequence[int] = (3, 6)
) -> DataFrame:
    """Serving features from the array ``previous``: a missing value counts as zero."""
    now, zero = F.col(value), F.lit(0)
    made = {f"{value}_lag_{k}": F.coalesce(_earlier(k), zero) for k in range(1, lags + 1)}
    for n in windows:
        made[f"{value}_ma_{n}"] = _total([now, *[_earlier(k) for k in range(1, n)]]) / n
    made[f"{value}_diff_1"] = now - F.coalesce(_earlier(1), zero)
    return df.withColumns(made)


def history_register(
    df: DataFrame,
    key: str = "station_id",
    order_cols: Sequence[str] = ("observed_at", "seq"),
    value: str = "parking_count",
    depth: int = HISTORY_DEPTH,
) -> DataFrame:
    """Add ``history``: the register after each row, newest value first."""

    def columns(w: WindowSpec):
        slots = F.array(F.col(value), *_lags(w, value, depth - 1))
        return [F.array_compact(slots).alias("history")]

    return series_window(df, key, order_cols, columns, [value], before=depth - 1)


def _lags(w: WindowSpec, value: str, depth: int) -> list:
    return [F.lag(value, k).over(w) for k in range(1, depth + 1)]


def _earlier(k: int) -> Column:
    return F.get("previous", F.lit(k - 1))


def _total(slots: list[Column]) -> Column:
    return _sum([F.coalesce(s, F.lit(0)).cast("double") for s in slots])


def _sum(terms: list[Column]) -> Column:
    return reduce(operator.add, terms)
