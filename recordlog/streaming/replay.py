"""Replay as a stream: control records in, replayed records out (to the function or to
a destination topic), with audit rows and per-request progress."""
from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DLQ_EXT, ROLLBACK_THRESHOLD_PCT
from ..functions.names import without_suffix
from ..operators.offsets import commit_positions
from ..operators.replay import (relevant_replays, replay, replay_progress, replay_start_check, republish,
                                requests_from_control)
from ..operators.results import audit_from_replay, audit_from_results, process, rollback_decision, to_dead_letters
from .manifest import BatchWriter
from .sinks import audit_rows, drop_results, store_results


@dataclass
class ReplayConfig:
    out_dir: str
    checkpoint: str
    config_topics: str
    mode: str = "strict"
    ext: str = DLQ_EXT
    service_id: str = "recordlog"
    last_retry: bool = False
    threshold: float = ROLLBACK_THRESHOLD_PCT   # failed share at which a request's results are rolled back
    rollback_mode: str = "compat"
    dead_letter_enabled: bool = True
    audit_enabled: bool = True
    trigger: dict = field(default_factory=lambda: {"availableNow": True})


def read_replay_requests(control: DataFrame, ext: str = DLQ_EXT) -> DataFrame:
    """Control records -> replay requests.  ``request_id`` is derived from the control
    record's position (stable across re-runs); ``topic_name`` is the requested topic
    (the suffix of dead-letter replays removed again)."""
    r = requests_from_control(control)
    dlq = F.coalesce(F.col("dlq_indicator"), F.lit(False))
    return (r.withColumn("request_id", F.xxhash64("topic", "partition_id", "log_offset"))
            .withColumn("control_topic_name", F.col("topic_name"))
            .withColumn("topic_name", F.when(dlq, without_suffix("topic_name", ext)).otherwise(F.col("topic_name"))))


def replay_batch(control: DataFrame, batch_id: int, log_reader: Callable[[], DataFrame], fn: Callable | None,
                 cfg: ReplayConfig) -> None:
    control = control.persist()
    cached = [control]
    try:
        reqs = read_replay_requests(control, cfg.ext)
        rel = relevant_replays(reqs.withColumn("_named", F.col("topic_name")).withColumn("topic_name", F.col("control_topic_name")),
                               cfg.config_topics, cfg.mode, cfg.ext).withColumn("topic_name", F.col("_named")).drop("_named").persist()
        cached.append(rel)
        if rel.isEmpty():
            return
        req = rel.select("request_id", "topic_name", "control_topic_name", F.col("partition_id_req").alias("partition_id"),
                         "start_offset", "end_offset", "consumer_group", "dlq_indicator", "streaming_app",
                         "destination_topic")
        log = log_reader()
        check = replay_start_check(req, log, cfg.ext).persist()
        cached.append(check)
        ok = req.join(check.filter("ok").select("request_id"), "request_id", "left_semi")
        aborted = rel.join(check.filter("not ok").select("request_id", "error_detail"), "request_id")
        replayed = replay(ok, log, cfg.ext).persist()
        cached.append(replayed)
        out = cfg.out_dir
        sinks = BatchWriter(control.sparkSession, out, batch_id)

        def audit_of(sink: str, rows: DataFrame) -> Callable[[], None]:
            return lambda: sinks.write(sink, *audit_rows(rows))
        writes = [
            audit_of("audit_requests", audit_from_replay(rel, "SUCCESS", "", service_id=cfg.service_id)),
            audit_of("audit_aborted", audit_from_replay(aborted, "FAILURE", "start offset mismatch", service_id=cfg.service_id)),
            lambda: sinks.write("republished", republish(replayed)),
        ]
        results, failed = None, None
        if fn is not None:
            to_fn = replayed.filter(~F.coalesce(F.col("streaming_app"), F.lit(False))).select(
                "request_id", "topic", "partition_id", "log_offset", "timestamp", "key", "value", "headers",
                *[c for c in ("event_id",) if c in replayed.columns])
            # stored before anything is decided on them: a lost executor does not call the function again
            results = store_results(process(to_fn, fn, isolate="request_id"), out, batch_id)
            errors = results.filter("error IS NOT NULL").groupBy("request_id").agg(F.min("error").alias("reason"))
            # the rules of the consume loop, request by request; an error of the function fails its own request only
            decision = rollback_decision(results, ["request_id"], cfg.threshold, cfg.rollback_mode)
            state = decision.join(errors, "request_id", "left").select(
                "request_id", "reason", (F.col("rolled_back") & F.col("reason").isNull()).alias("rolled_back")).persist()
            cached.append(state)
            failed = state.filter(F.col("reason").isNotNull() | F.col("rolled_back"))
            broken = rel.join(state.filter("reason IS NOT NULL").select("request_id", "reason"), "request_id")
            undone = rel.join(state.filter("rolled_back").select("request_id"), "request_id", "left_semi")
            kept = results.join(failed.select("request_id"), "request_id", "left_anti").drop("error")
            writes.append(audit_of("audit_failed", audit_from_replay(broken, "FAILURE", F.col("reason"), service_id=cfg.service_id)))
            writes.append(audit_of("audit_rolled_back", audit_from_replay(undone, "FAILURE", "rolled back", service_id=cfg.service_id)))
            if cfg.audit_enabled:
                writes.append(audit_of("audit", audit_from_results(kept, "REACTIVE_CONSUMER", cfg.service_id)))
            if cfg.dead_letter_enabled:
                writes.append(lambda: sinks.write("dead_letters", to_dead_letters(kept, cfg.ext, last_retry=cfg.last_retry)))
        writes.append(lambda: sinks.write("progress", replay_progress(ok, replayed, failed)))
        # independent sinks: concurrent Spark jobs, all must succeed
        with ThreadPoolExecutor(max_workers=len(writes)) as pool:
            for f in [pool.submit(w) for w in writes]:
                f.result()
        if results is not None:
            pos = commit_positions(kept.join(req.select("request_id", "consumer_group"), "request_id"), "consumer_group")
            sinks.write("commits", pos.select("consumer_group", "topic", "partition_id", "log_offset",
                                              F.lit(int(time.time() * 1000)).cast("bigint").alias("committed_at")))
        sinks.commit()  # all sinks of the batch count from here on
        if results is not None:
            drop_results(control.sparkSession, out, batch_id)
    finally:
        for d in reversed(cached):
            d.unpersist()


def replay_stream(control_stream: DataFrame, log_reader: Callable[[], DataFrame], fn: Callable | None,
                  cfg: ReplayConfig):
    """Start the replay query: each micro-batch of control records is one replay job
    over the log returned by ``log_reader`` (read fresh per batch)."""
    return (control_stream.writeStream
            .foreachBatch(lambda df, bid: replay_batch(df, bid, log_reader, fn, cfg))
            .option("checkpointLocation", cfg.checkpoint)
            .trigger(**cfg.trigger).start())
