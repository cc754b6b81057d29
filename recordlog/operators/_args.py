"""Turning small Python arguments (partition lists, positions) into DataFrames.

A Python list has a known, small size, so the DataFrame made from it may be
broadcast.  A DataFrame argument is joined as it is and Spark (with AQE at
run time) decides from its measured size.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# rows of a Python list that may be broadcast; size that a measured row counts with
BROADCAST_ROWS = 100_000
ROW_BYTES = 200


def small_frame(spark: SparkSession, rows, ddl: str) -> DataFrame:
    rows = [tuple(r) for r in rows]
    df = spark.createDataFrame(rows, ddl)
    return F.broadcast(df) if len(rows) <= BROADCAST_ROWS else df


def as_frame(df_like: DataFrame, arg, ddl: str) -> DataFrame:
    if isinstance(arg, DataFrame):
        return arg
    return small_frame(df_like.sparkSession, arg, ddl)


def broadcast_bytes(spark: SparkSession) -> int:
    """The session's broadcast threshold; 0 when broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.lstrip("-").isdigit():
        return max(0, int(text))
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def any_of(conditions: list) -> Column:
    """OR of many conditions as a balanced tree, so that long lists stay shallow."""
    if not conditions:
        return F.lit(False)
    while len(conditions) > 1:
        conditions = [a | b for a, b in zip(conditions[::2], conditions[1::2])] + conditions[len(conditions) // 2 * 2:]
    return conditions[0]


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Join a table with one row per topic-partition (or per request) to a log.

    The small side is computed once (a checkpoint in the shared folder) and measured; when
    its rows, counted with ``ROW_BYTES`` each, fit the session's broadcast threshold it is
    broadcast, so the log is not shuffled by (topic, partition_id) and a hot partition
    cannot pile up in one task.  Beyond it the join is left to the planner (sort-merge with
    AQE skew splitting).  The rows are the same either way.  ``null_safe``: null keys meet null keys."""
    from ..session import checkpoint_root
    checkpoint_root(big.sparkSession)
    small = small.checkpoint(eager=True)
    fits = small.count() * ROW_BYTES <= broadcast_bytes(big.sparkSession)
    if not null_safe:
        return big.join(F.broadcast(small) if fits else small, on, how)
    side = small.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in small.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return big.join(F.broadcast(side) if fits else side, cond, how).drop(*[f"_r_{c}" for c in on])
