"""Dead-letter flows on a log: drain (read + commit), replay through a function, post failures."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DLQ_EXT, OFFSET_CHUNK
from ..operators.offsets import TP, commit, commit_positions
from ..operators.results import audit_from_results, posted_dead_letters
from ..operators.select import read_dead_letters, resume
from ..sources.reservations import append_reserved
from .consume import ConsumerConfig, run_consumer


def drain_dead_letters(log: DataFrame, commits: DataFrame, group: str, topics: str | list[str],
                       committed_at: int | Column, ext: str = DLQ_EXT) -> tuple[DataFrame, DataFrame]:
    """Dead letters of ``topics`` after the group's committed positions, and the commits
    table advanced past them.  Writing the second back makes the next call return only
    newer dead letters."""
    rows = resume(read_dead_letters(log, topics, ext), commits, group, "earliest")
    return rows, commit(commits, commit_positions(rows), group, committed_at)


def replay_dead_letters(source: Callable[[], DataFrame], topics: str | list[str], fn: Callable, cfg: ConsumerConfig,
                        max_attempts: int = 3) -> int:
    """Run the dead letters of ``topics`` (of the log stream that ``source`` gives) through ``fn`` on their last retry:
    the consume loop with its batches, rollback and commits, but what fails again is audited and not queued
    again.  Ends when the stream is drained; returns the number of attempts."""
    last = replace(cfg, last_retry=True)
    return run_consumer(lambda: read_dead_letters(source(), topics, cfg.ext), fn, last, max_attempts)


def post_failures(results: DataFrame, path: str, request_id: str, now_ms: int | Column, service_id: str = "recordlog",
                  ext: str = DLQ_EXT, segment_rows: int = OFFSET_CHUNK) -> tuple[DataFrame, DataFrame]:
    """Results posted by a caller that ran the function itself: the failed ones are appended to their dead-letter topics
    in the segmented log at ``path``, once however often the request is sent.

    Returns ``(ack, audit)``: topic, partition_id, source_offset, log_offset, error of every dead letter, and an
    ACTIVE_CONSUMER audit row of every result.  Of headers that repeat a name the first counts (the
    result's own ids come before the record's)."""
    posted = posted_dead_letters(results.filter(F.col("processed") == F.lit(False)), now_ms, ext)
    names = F.transform("header_list", lambda h: h["key"])
    first = F.filter("header_list", lambda h, i: F.array_position(names, h["key"]) == i + 1)
    rows = posted.select("topic", "partition_id", F.timestamp_millis("ts_ms").alias("timestamp"), "key", "value",
                         F.map_from_entries(first).alias("headers"), "source_offset")
    ack = append_reserved(rows, path, request_id, "source_offset", segment_rows=segment_rows)
    return (ack.select(*TP, "source_offset", "log_offset", "error"),
            audit_from_results(results, "ACTIVE_CONSUMER", service_id))
