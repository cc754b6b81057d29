"""Offsets: commit positions, partition bounds, the commits table, batch numbers, appends."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MAX_POLL_RECORDS
from ._args import as_frame, join_checked
from .numbering import chunk_of, floor_div, number_within

TP = ["topic", "partition_id"]
COMMITS_DDL = "consumer_group string, topic string, partition_id int, log_offset bigint, committed_at bigint"


def commit_positions(df: DataFrame, *by: str) -> DataFrame:
    """Offset to commit per topic-partition (and ``by`` columns): the greatest one seen."""
    return df.groupBy(*TP, *by).agg(F.max("log_offset").alias("log_offset"))


def partition_bounds(df: DataFrame) -> DataFrame:
    """first, last and next offset and record count of every topic-partition."""
    return (df.groupBy(*TP)
            .agg(F.min("log_offset").alias("first_offset"), F.max("log_offset").alias("last_offset"),
                 F.count(F.lit(1)).alias("n_records"))
            .withColumn("next_offset", F.col("last_offset") + 1))


_SHIFT = 10 ** 19  # > any non-negative BIGINT offset


def _pack(major: str, minor: str) -> F.Column:
    """(major BIGINT, minor non-negative BIGINT) as one DECIMAL(38,0) with the same order;
    any BIGINT pair fits (|major| * 1e19 + 1e19 < 1e38)."""
    return F.col(major).cast("decimal(38,0)") * _shift() + F.col(minor).cast("decimal(38,0)")


def _shift() -> F.Column:
    return F.lit(str(_SHIFT)).cast("decimal(38,0)")


def latest_commits(commits: DataFrame, group: str | None = None) -> DataFrame:
    """Last write wins: per (group, topic, partition) the commit with the greatest
    ``committed_at`` (ties: greatest offset).  The pair is packed into one decimal so
    a plain ``max`` aggregates in a hash map, partially before the shuffle."""
    c = commits if group is None else commits.filter(F.col("consumer_group") == group)
    g = c.groupBy("consumer_group", *TP).agg(F.max(_pack("committed_at", "log_offset")).alias("_m"))
    off = F.pmod(F.col("_m"), _shift())
    at = (F.col("_m") - off) / _shift()
    return g.select("consumer_group", *TP, off.cast("bigint").alias("log_offset"), at.cast("bigint").alias("committed_at"))


def committed(commits: DataFrame, group: str, partitions) -> DataFrame:
    """Last committed offset of each requested partition, null when never committed."""
    req = as_frame(commits, partitions, "topic string, partition_id int").select(*TP)
    last = latest_commits(commits, group).select(*TP, F.col("log_offset").alias("committed_offset"))
    return join_checked(req, last, TP, "left")


def commit(commits: DataFrame, positions: DataFrame, group: str, committed_at: int | Column) -> DataFrame:
    """Append the positions as new commits of ``group`` and return the resulting latest table."""
    at = committed_at if isinstance(committed_at, Column) else F.lit(committed_at).cast("bigint")
    new = positions.select(F.lit(group).alias("consumer_group"), *TP,
                           F.col("log_offset").cast("bigint").alias("log_offset"), at.alias("committed_at"))
    return latest_commits(commits.select(*new.columns).unionByName(new))


def with_batches(df: DataFrame, size: int = MAX_POLL_RECORDS, col: str = "batch_no") -> DataFrame:
    """Batch number of each record: ``log_offset div size`` -- a projection, no shuffle."""
    return df.withColumn(col, floor_div(F.col("log_offset"), size))


def append(df: DataFrame, log: DataFrame, seq: str = "seq", chunk: Column | None = None) -> DataFrame:
    """Give every row to append the next offsets of its topic-partition.

    Rows are ordered by ``seq`` inside a topic-partition; the first gets the
    partition's next offset (0 for a new partition).  Returns the rows with
    ``log_offset`` set -- its ``(seq, topic, partition_id, log_offset)`` part is
    the acknowledgement.  Numbering is chunked (see ``numbering``), so a large
    append to one partition still ranks in parallel."""
    nxt = log.groupBy(*TP).agg((F.max("log_offset") + 1).alias("base"))
    d = df.drop("log_offset") if "log_offset" in df.columns else df
    return number_within(d, TP, [seq], chunk if chunk is not None else chunk_of(seq), base=nxt)
