"""The consume loop as a Structured Streaming query.

Per micro-batch (one batch of records): run the user function once and store its results,
check sizes, decide rollback on the failed share, and only
then write dead letters, audit rows and commit positions, which count together once the batch's
manifest stands (``manifest.read_batches``).  A rollback raises:
the query stops without committing the batch in its checkpoint, and a restart
reads exactly the same records again.  A batch that runs again replaces what it left.
"""
from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DLQ_EXT, ROLLBACK_THRESHOLD_PCT
from ..operators.offsets import commit_positions
from ..operators.results import (RESULT_SCHEMA, audit_from_results, process, rollback_decision, to_dead_letters)
from .manifest import BatchWriter
from .sinks import audit_rows, drop_results, store_results


class RollbackError(RuntimeError):
    """The failed share of a batch reached the threshold: nothing of it is written."""


@dataclass
class ConsumerConfig:
    out_dir: str
    checkpoint: str
    group: str = "consumer"
    threshold: float = ROLLBACK_THRESHOLD_PCT
    mode: str = "compat"
    dead_letter_enabled: bool = True
    audit_enabled: bool = True
    audit_target: str = "topic"
    audit_type: str = "REACTIVE_CONSUMER"
    last_retry: bool = False
    ext: str = DLQ_EXT
    service_id: str = "recordlog"
    result_schema: object = RESULT_SCHEMA
    input_cols: list | None = None
    match: str = "position"                # how results map to records: "position" or "key"
    # records per call of the function; None = whole Arrow batches (fastest).  Set MAX_POLL_RECORDS
    # when the function forwards to a backend that takes the original poll size.
    batch_rows: int | None = None
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
    on_batch: Callable | None = None       # observer(batch_id, results_df), e.g. for tests


def consume_batch(batch: DataFrame, batch_id: int, fn: Callable, cfg: ConsumerConfig) -> None:
    """Body of one micro-batch (also usable on a static DataFrame).  The results are stored under the
    batch id until it ends: they carry the records' keys, so commit positions come from them too."""
    results = None
    try:
        # one call of the function for each record, stored before anything is decided on the results
        results = store_results(process(batch, fn, cfg.result_schema, cfg.input_cols, cfg.match, cfg.batch_rows), cfg.out_dir, batch_id)
        if cfg.on_batch:
            cfg.on_batch(batch_id, results)
        # no row = empty batch
        decision = rollback_decision(results.withColumn("_b", F.lit(0)), ["_b"], cfg.threshold, cfg.mode).first()
        if decision is None:
            return
        if decision["rolled_back"]:
            raise RollbackError(f"batch {batch_id}: failed records {decision['failed']} of {decision['batch_size']} "
                                f"reach the threshold {cfg.threshold}%")
        now = int(time.time() * 1000)
        batch_sinks = BatchWriter(batch.sparkSession, cfg.out_dir, batch_id)
        writes = []
        if cfg.dead_letter_enabled:
            dl = to_dead_letters(results, cfg.ext, last_retry=cfg.last_retry, now_ms=F.lit(now).cast("bigint"))
            writes.append(lambda: batch_sinks.write("dead_letters", dl))
        if cfg.audit_enabled:
            audit = audit_from_results(results, cfg.audit_type, cfg.service_id)
            writes.append(lambda: batch_sinks.write("audit", *audit_rows(audit, cfg.audit_target)))
        # dead letters and audit are independent: concurrent Spark jobs; all must succeed before anything is committed
        if writes:
            with ThreadPoolExecutor(max_workers=len(writes)) as pool:
                for f in [pool.submit(w) for w in writes]:
                    f.result()
        # no reader can resume past records whose dead letters were not written: all of it counts with the manifest
        pos = commit_positions(results).select(F.lit(cfg.group).alias("consumer_group"), "topic", "partition_id",
                                             "log_offset", F.lit(now).cast("bigint").alias("committed_at"))
        batch_sinks.write("commits", pos)
        batch_sinks.commit()
    finally:
        if results is not None:
            drop_results(batch.sparkSession, cfg.out_dir, batch_id)


def consume(stream_log: DataFrame, fn: Callable, cfg: ConsumerConfig):
    """Start the consume query (``foreachBatch`` + checkpoint); returns the StreamingQuery."""
    return (stream_log.writeStream
            .foreachBatch(lambda df, bid: consume_batch(df, bid, fn, cfg))
            .option("checkpointLocation", cfg.checkpoint)
            .trigger(**cfg.trigger)
            .start())


def run_consumer(stream_factory: Callable[[], DataFrame], fn: Callable, cfg: ConsumerConfig,
                 max_attempts: int = 3) -> int:
    """Run until the source is drained (``availableNow``), restarting after a rollback.

    The restart resumes from the checkpoint, so the rolled-back batch is read
    again.  After ``max_attempts`` failed attempts the error is raised (the
    original service retried without limit; a poison batch would loop forever).
    Returns the number of attempts used."""
    for attempt in range(1, max_attempts + 1):
        q = consume(stream_factory(), fn, cfg)
        try:
            q.awaitTermination()
            if q.exception() is None:
                return attempt
        except Exception:
            if attempt == max_attempts:
                raise
        finally:
            q.stop()
    raise RuntimeError("consumer did not finish")
