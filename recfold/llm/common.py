"""Helpers shared by the training-data operators: sizes, scratch tables and
byte-level views of Arrow text columns."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recfold.session import ensure_checkpoint_dir, materialize

__all__ = ["materialize", "scratch_path", "scan_parts", "text_pieces", "mix64", "window_min",
           "ascii_lower", "held_out", "binary", "drop_columns", "join_counted",
           "share", "release_shared"]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scan_parts(df: DataFrame, bytes_each: int) -> int:
    """Number of parts of about ``bytes_each`` stored bytes that ``df`` makes,
    from the optimizer's size estimate (file sizes for a table scan)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(65_536, math.ceil(size / bytes_each)))


def held_out(id_col: str, folds: int, fold: int):
    """crc32 of the id's decimal text modulo ``folds`` equals ``fold``; a null
    id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in {n.lower() for n in names}])


_SHARED: list = []


def share(spark: SparkSession, value):
    """A broadcast that ``release_shared`` takes back."""
    _SHARED.append(spark.sparkContext.broadcast(value))
    return _SHARED[-1]


def release_shared() -> None:
    """Drop all broadcasts of ``share`` from driver and executors. For callers that have written every result which uses
    them, such as a pipeline between its stages."""
    while _SHARED:
        try:
            _SHARED.pop().destroy()
        except Exception as gone:  # noqa: BLE001  a broadcast of a session that has ended
            if "stopped" not in str(gone).lower() and "closed" not in str(gone).lower():
                raise


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str, share: int = 1000) -> DataFrame:
    """Inner join of ``left`` with one row per key, whose ``count`` says how many rows of ``left`` have the key (the column
    is dropped). Keys with more than one in ``share`` of all rows are at most ``share`` many: they are broadcast, and only
    the others are shuffled, so no task gets a hot key."""
    total = right.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    is_hot = F.col(count) * share > F.lit(total)
    hot, cold = F.broadcast(right.filter(is_hot).drop(count)), right.filter(~is_hot).drop(count)
    rest = left.join(hot.select(*keys), keys, "left_anti").join(cold, keys)
    return left.join(hot, keys).unionByName(rest)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def text_pieces(batch: pa.RecordBatch, column: str, max_bytes: int):
    """Cut a batch into runs of whole rows of at most ``max_bytes`` text bytes
    (one row at least) and yield ``(first_row, offsets, bytes)``; a null text
    is empty. ``offsets`` start at 0 and have one entry more than rows."""
    col = batch.column(batch.schema.get_field_index(column))
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if len(col) == 0:
        return
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and off[-1] > 0 else np.zeros(0, np.uint8)
    i, n = 0, len(col)
    while i < n:
        j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, off[i:j + 1] - off[i], data[off[i]:off[j]]
        i = j


def binary(arr: np.ndarray) -> bytes:
    return np.ascontiguousarray(arr).tobytes()


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (two multiply-xorshift rounds)."""
    x = x * _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (w - span)], x[w - span:]) if span < w else x
