"""Queries on the fixture log stored as a segmented log: answers by its index, and streams of it."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import segments as G
from ..sources import stream as ST
from ..sources.log import flat

#: Offsets of a fixture segment; small, so that the test logs have many.
SEGMENT_ROWS = 256
_PATHS: dict[tuple, str] = {}


def segmented(fx) -> str:
    """The fixture log as a segmented log, written once per session."""
    key = (fx.spark.sparkContext.applicationId, fx.sf_dir)
    if key not in _PATHS:
        path = scratch_path(fx.spark, "segmented-log")
        G.write_segments(fx.log, path, SEGMENT_ROWS)
        _PATHS[key] = path
    return _PATHS[key]


def segment_bounds(fx) -> DataFrame:
    """AGG-8: bounds of every partition, from the index alone."""
    return G.index_bounds(G.read_index(fx.spark, segmented(fx)))


def segment_fetch(fx) -> DataFrame:
    """SRC-8/9/10: a poll after the group's commits; only the segments that can hold it are read."""
    path = segmented(fx)
    positions = G.resume_positions(fx.spark, path, fx.commits, "g1")
    return flat(G.fetch_segments(fx.spark, path, 100, 500, positions))


def segment_seek(fx) -> DataFrame:
    """SRC-5: records from the first one at or after a time on; the index says which segments to open."""
    from .catalog import SEEK_TIMES
    path = segmented(fx)
    return flat(G.read_from(fx.spark, path, G.time_positions(fx.spark, path, SEEK_TIMES)))


def segment_append(fx) -> DataFrame:
    """SNK-2: failed records appended again; offsets go on from the index, the acknowledgement is what was stored."""
    path = scratch_path(fx.spark, "segmented-append")
    G.write_segments(fx.log, path, SEGMENT_ROWS)
    again = fx.results.filter(F.col("processed") == F.lit(False)).select(
        "topic", "partition_id", "timestamp", "key", "value", "headers", F.col("event_id").alias("seq"))
    return G.append_segments(again, path, "seq", segment_rows=SEGMENT_ROWS)


def _streamed(fx, stream: DataFrame, name: str) -> DataFrame:
    from ..streaming.push import push_query
    out = scratch_path(fx.spark, f"{name}-out")
    push_query(stream, lambda df: df, out, scratch_path(fx.spark, f"{name}-ckpt"), output_mode="append").awaitTermination()
    return flat(fx.spark.read.parquet(out))


def stream_latest(fx) -> DataFrame:
    """SRC-15 / STR-4: a stream that starts at the latest record: of what is appended in two parts, the second."""
    path = scratch_path(fx.spark, "segmented-latest")
    G.write_segments(fx.log.filter("log_offset < 100"), path, SEGMENT_ROWS)
    positions = ST.starting_positions(fx.spark, path, "latest")
    G.write_segments(fx.log.filter("log_offset >= 100"), path, SEGMENT_ROWS)
    return _streamed(fx, ST.stream_segments(fx.spark, path, positions=positions), "latest")


def stream_commits(fx) -> DataFrame:
    """SRC-8 on a stream: it starts after the group's commits, partitions without one at their first record."""
    path = segmented(fx)
    return _streamed(fx, ST.stream_segments(fx.spark, path, commits=fx.commits, group="g1"), "commits")


SEGMENT_QUERIES = {f.__name__: f for f in (segment_bounds, segment_fetch, segment_seek, segment_append, stream_latest, stream_commits)}
