"""Enough tasks for CPU-heavy row work.

A scan yields one task per file split; a few large files (or a single row
group) would leave cores idle during per-row work such as regex tokenising or
a Python function.  ``spread`` redistributes rows round-robin only when the
input has fewer partitions than the cluster has cores -- on a large input it is
a no-op and adds no shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
