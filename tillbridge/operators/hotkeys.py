"""Find keys that hold many rows, ahead of a shuffle of whole rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillbridge.sinks.store import broadcast_if_small

# Counters of a task's summary, and how often to try more of them before all keys are counted.
COUNTERS = 1 << 12
_TRIES = 3


def hot_keys(rows: DataFrame, key: Column, min_rows: int) -> DataFrame:
    """Column ``k``: every key that occurs in ``min_rows`` rows or more; usually none.

    ``key`` is a bigint expression, NULL for rows to leave out. Counts combine before
    the shuffle, so a hot key sends one number per task. At most one key in ``min_rows``
    rows comes back, and it stays a frame.
    """
    return rows.select(key.alias("k")).where("k is not null").groupBy("k").agg(
        F.count("*").alias("n")).where(F.col("n") >= min_rows).select("k")


def heavy_hitters(rows: DataFrame, key: Column, min_rows: int, counters: int = COUNTERS) -> DataFrame:
    """The keys of :func:`hot_keys`, without a shuffle of all keys.

    Each task keeps at most ``counters`` counts; when there are more, all are lowered by the same
    amount and those at zero go, so a count is too low by no more than the task lowered it
    altogether. Summaries merge by adding counts and lowerings. A key that is in no summary has at
    most the sum of all lowerings: is that below ``min_rows``, no hot key is missed, and only the keys that
    can reach ``min_rows`` are counted exactly. Else the tasks keep more counts, and at last all keys
    are counted. The summary is taken when this is called; it is as large as its counters, whatever
    the input.
    """
    keys = rows.select(key.alias("k")).where("k is not null")
    for attempt in range(_TRIES):
        size = counters << (6 * attempt)
        summary = keys.mapInArrow(lambda batches: _summary(batches, size), "k long, n long, lowered long").groupBy("k").agg(
            F.sum("n").alias("n"), F.sum("lowered").alias("lowered"))
        row = summary.agg(  # the row without a key has the lowerings
            F.coalesce(F.sum("lowered"), F.lit(0)).alias("lowered"), F.max("n").alias("most")).first()
        if row.lowered >= min_rows:
            continue
        if row.most is None or row.most + row.lowered < min_rows:
            return keys.limit(0)
        likely = summary.where(F.col("k").isNotNull() & (F.col("n") + row.lowered >= min_rows)).select("k")
        if row.lowered == 0:  # the counts are exact
            return likely
        return hot_keys(keys.join(broadcast_if_small(likely), "k", "left_semi"), F.col("k"), min_rows)
    return hot_keys(keys, F.col("k"), min_rows)


def _summary(batches, size: int):
    keys, counts, lowered = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for batch in batches:
        new, seen = np.unique(batch.column(0).to_numpy(), return_counts=True)
        every, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, place, np.concatenate([counts, seen]))
        if len(every) > size:  # lower all so that at most this many stay above zero
            cut = int(np.partition(total, len(total) - size - 1)[len(total) - size - 1])
            total -= cut
            lowered += cut
            every, total = every[total > 0], total[total > 0]
        keys, counts = every, total
    yield pa.RecordBatch.from_arrays([
        pa.array([None, *keys.tolist()], pa.int64()), pa.array([None, *counts.tolist()], pa.int64()),
        pa.array([lowered, *[0] * len(keys)], pa.int64())], ["k", "n", "lowered"])
