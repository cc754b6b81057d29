"""Streaming and stateful queries, registered for the rows-only check.

Each one stages its input under the shared checkpoint folder, runs the stream
to completion (``availableNow``) and returns what the stream wrote, read back
as a batch DataFrame.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.offsets import COMMITS_DDL, commit, latest_commits
from ..operators.results import fixture_results, posted_dead_letters
from ..session import scratch_path
from ..sources.log import events_as_records
from ..streaming.consume import ConsumerConfig, run_consumer
from ..streaming.deadletters import replay_dead_letters as replay
from ..streaming.manifest import read_batches
from ..streaming.push import push_query, query_state
from ..streaming.replay import ReplayConfig, replay_stream
from .fixtures import DOC_SEGMENT, NOW_MS, REPLAY_TOPICS, SERVICE_ID

LOG_COLS = ["topic", "partition_id", "log_offset", "timestamp", "key", "value", "headers", "event_id"]


def stage(df: DataFrame, name: str, n_files: int = 4) -> str:
    """Write ``df`` as ``n_files`` parquet files in a fresh folder of the shared checkpoint dir."""
    path = scratch_path(df.sparkSession, name)
    df.repartition(n_files, "topic", "partition_id").write.parquet(path)
    return path


def _stream(spark, path: str, max_files: int = 1) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def stage_in_order(df: DataFrame, ts_col: str, name: str, n_files: int = 4) -> str:
    """Write ``df`` as ``n_files`` slices of its time range, the earliest first, so that a stream
    reads them in that order, one a micro-batch."""
    path = scratch_path(df.sparkSession, name)
    t = F.unix_micros(ts_col)
    cuts = df.agg(F.percentile_approx(t, [k / n_files for k in range(1, n_files)], 1000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:]):
        part = df if low is None else df.filter(t >= low)
        part = part if high is None else part.filter(t < high)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stage_texts(df: DataFrame, name: str, batches: int = 4) -> tuple[str, int]:
    """Write ``df`` as files of about ``DOC_SEGMENT`` rows, dealt out row by row whatever the keys are.
    The folder, and how many of its files make one of ``batches`` micro-batches."""
    path = scratch_path(df.sparkSession, name)
    each = max(1, -(-df.count() // (batches * DOC_SEGMENT)))
    df.repartition(batches * each).write.parquet(path)
    return path, each


def consume_stream(fx) -> DataFrame:
    """STR-1/2: the fixture log as a 4-file stream through the consume loop; the audit topic."""
    spark = fx.spark
    path = stage(fx.log.select(*LOG_COLS), "log")
    cfg = ConsumerConfig(out_dir=scratch_path(spark, "consume-out"), checkpoint=scratch_path(spark, "consume-ckpt"),
                         group="g-stream", service_id=SERVICE_ID)
    run_consumer(lambda: _stream(spark, path), fixture_results, cfg)
    return read_batches(spark, cfg.out_dir, "audit").select("key", "value")


def consume_commits(fx) -> DataFrame:
    """STR-1 / STR-9: the commits that the consume loop leaves, joined by an older drain of the same group:
    the last write of each partition wins."""
    spark = fx.spark
    path = stage(fx.log.select(*LOG_COLS), "log")
    cfg = ConsumerConfig(out_dir=scratch_path(spark, "commits-out"), checkpoint=scratch_path(spark, "commits-ckpt"),
                         group="g-stream", service_id=SERVICE_ID, audit_enabled=False)
    drained = commit(spark.createDataFrame([], COMMITS_DDL),
                     fx.log.groupBy("topic", "partition_id").agg(F.min("log_offset").alias("log_offset")), "g-stream", NOW_MS)
    run_consumer(lambda: _stream(spark, path), fixture_results, cfg)
    cols = ["consumer_group", "topic", "partition_id", "log_offset", "committed_at"]
    streamed = read_batches(spark, cfg.out_dir, "commits").select(*cols)
    return latest_commits(drained.select(*cols).union(streamed)).drop("committed_at")


def consume_dead_letters(fx) -> DataFrame:
    """STR-1: the dead letters that the consume loop writes."""
    spark = fx.spark
    path = stage(fx.log.select(*LOG_COLS), "log")
    cfg = ConsumerConfig(out_dir=scratch_path(spark, "dlq-out"), checkpoint=scratch_path(spark, "dlq-ckpt"),
                         group="g-stream", service_id=SERVICE_ID, audit_enabled=False)
    run_consumer(lambda: _stream(spark, path), fixture_results, cfg)
    return read_batches(spark, cfg.out_dir, "dead_letters").select(
        "topic", "partition_id", F.col("key").cast("string").alias("record_key"), F.col("value").cast("string").alias("record_value"))


def replay_dead_letters(fx) -> DataFrame:
    """STR-10: the dead-letter topics streamed through the consume loop on the last retry:
    failures are audited, not queued again."""
    spark = fx.spark
    path = stage(fx.dlq.select(*LOG_COLS), "dlq")
    topics = REPLAY_TOPICS
    cfg = ConsumerConfig(out_dir=scratch_path(spark, "dlq-replay-out"),
                         checkpoint=scratch_path(spark, "dlq-replay-ckpt"), group="g-dlq", threshold=100, service_id=SERVICE_ID)
    replay(lambda: _stream(spark, path), topics, fixture_results, cfg)
    return read_batches(spark, cfg.out_dir, "audit").select("key", "value")


def replay_stream_query(fx) -> DataFrame:
    """STR-3: control records of the valid requests as a stream; each batch replays them on the log."""
    from .catalog import _control_log
    spark = fx.spark
    path = stage(_control_log(fx).select("topic", "partition_id", "log_offset", "key", "value", "headers"), "control", 2)
    cfg = ReplayConfig(out_dir=scratch_path(spark, "replay-out"), checkpoint=scratch_path(spark, "replay-ckpt"),
                       config_topics=REPLAY_TOPICS, service_id=SERVICE_ID)
    q = replay_stream(_stream(spark, path), lambda: fx.log_all, fixture_results, cfg)
    q.awaitTermination()
    from ..streaming.replay import read_replay_requests
    req = read_replay_requests(spark.read.parquet(path))
    prog = read_batches(spark, cfg.out_dir, "progress")
    return prog.join(req, "request_id").select(
        "topic_name", F.col("partition_id_req").alias("partition_id"), "start_offset", "end_offset",
        "consumer_group", "dlq_indicator", "n_records", "last_offset", "next_offset", "finished")


def push_query_q(fx) -> DataFrame:
    """STR-4: records per topic and day over the events stream, changes pushed in each of four
    micro-batches that follow in time."""
    spark = fx.spark
    recs = _stream(spark, stage_in_order(events_as_records(fx.table("events")), "timestamp", "push-log"))

    def per_day(df):
        return (df.withWatermark("timestamp", "1 hour")
                .groupBy(F.window("timestamp", "1 day").alias("w"), "topic")
                .agg(F.count(F.lit(1)).alias("n"))
                .select(F.unix_millis("w.start").alias("window_start_ms"), "topic", "n"))
    out = scratch_path(spark, "push-out")
    q = push_query(recs, per_day, out, scratch_path(spark, "push-ckpt"), output_mode="update")
    q.awaitTermination()
    from ..streaming.push import read_table
    return read_table(spark, out, ["window_start_ms", "topic"])


def query_state_q(fx) -> DataFrame:
    """STR-8: state of a running count per topic, carried over four micro-batches and read from its checkpoint."""
    spark = fx.spark
    recs = _stream(spark, stage(events_as_records(fx.table("events")), "state-log"))
    ckpt = scratch_path(spark, "state-ckpt")
    counts = recs.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))

    def sink(df, bid):
        df.count()
    q = counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", ckpt) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    st = query_state(spark, ckpt)
    first = st.schema["value"].dataType.fieldNames()[0]
    return st.select(F.col("key.topic").alias("topic"), F.col("value").getField(first).alias("n"))


def dlq_headers_q(fx) -> DataFrame:
    """PRJ-7: headers of posted dead letters, one row per header (duplicates kept, in order)."""
    posted = fx.results.filter(F.col("processed") == F.lit(False))
    d = posted_dead_letters(posted, NOW_MS)
    return d.select("topic", "partition_id", "source_offset", F.posexplode("header_list").alias("pos", "h")) \
        .select("topic", "partition_id", "source_offset", "pos", F.col("h.key").alias("key"),
                F.col("h.value").alias("value"))


def dedupe_stream_q(fx) -> DataFrame:
    """STR-6 on a stream: repeated (topic, key, value) dropped, the records coming in four micro-batches."""
    from ..operators.tables import dedupe_stream
    spark = fx.spark
    recs = _stream(spark, stage(events_as_records(fx.table("events")).select("topic", "partition_id", "key", "value", "timestamp"),
                                "dedupe-log"))
    out = scratch_path(spark, "dedupe-out")
    q = push_query(recs, lambda df: dedupe_stream(df, ["topic", "key", "value"]).select("topic", "key", "value"),
                   out, scratch_path(spark, "dedupe-ckpt"), output_mode="append")
    q.awaitTermination()
    return spark.read.parquet(out)


def word_count_stream_q(fx) -> DataFrame:
    """AGG-10 as the stateful stream it is: counts kept over four micro-batches of documents."""
    from ..operators.tables import word_count
    from ..streaming.sinks import write_batch
    spark = fx.spark
    path, each = stage_texts(fx.table("documents").select("doc_id", "text"), "words-in")
    out = scratch_path(spark, "words-out")
    # complete mode: each micro-batch replaces the whole table, so the last one is the answer
    q = (word_count(_stream(spark, path, each)).writeStream.outputMode("complete")
         .foreachBatch(lambda df, bid: write_batch(df, out, 0))
         .option("checkpointLocation", scratch_path(spark, "words-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("word", "n")


def latest_stream_q(fx) -> DataFrame:
    """AGG-5 / STR-4 as a stream: latest record per (topic, user) kept in state from the
    events stream (four micro-batches), read back as the table."""
    from ..streaming.push import materialize_latest_stream, read_table
    spark = fx.spark
    src = stage(events_as_records(fx.table("events")), "events-log")
    stream = _stream(spark, src)
    out = scratch_path(spark, "latest-changelog")
    q = materialize_latest_stream(stream, ["topic", "key"], out, scratch_path(spark, "latest-ckpt"),
                                  order=("timestamp", "partition_id", "event_id"))
    q.awaitTermination()
    t = read_table(spark, out, ["topic", "key"])
    return t.select("topic", "key", F.unix_millis("timestamp").alias("ts_ms"), "partition_id", "event_id", "value")


def agg_stream_q(fx) -> DataFrame:
    """AGG-9 as a stream: count and sum of k per (topic, key) kept in state over four
    micro-batches; the changelog compacted to the current table."""
    from ..streaming.push import push_query, read_table
    spark = fx.spark
    src = stage(fx.log.select(*LOG_COLS), "agg-src")
    k = F.get_json_object("value", "$.k").cast("int")

    def table(df):
        return df.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"), F.sum(k).cast("bigint").alias("sum_k"))
    out = scratch_path(spark, "agg-changes")
    q = push_query(_stream(spark, src), table, out, scratch_path(spark, "agg-ckpt"), output_mode="update")
    q.awaitTermination()
    return read_table(spark, out, ["topic", "key"])


def stream_static_join_q(fx) -> DataFrame:
    """JN-6 on a stream: purchase records joined with the static customer table as they arrive."""
    from ..operators.select import subscribe
    spark = fx.spark
    src = stage(fx.log.select(*LOG_COLS), "join-src")
    cust = fx.table("customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")

    def joined(df):
        return (subscribe(df, "ev.purchase").withColumn("user_id", F.col("key").cast("bigint"))
                .join(cust, "user_id").select("user_id", "partition_id", "log_offset", "c_name", "c_mktsegment"))
    out = scratch_path(spark, "join-out")
    q = push_query(_stream(spark, src), joined, out, scratch_path(spark, "join-ckpt"), output_mode="append")
    q.awaitTermination()
    return spark.read.parquet(out)


ROWS_ONLY = {
    "agg_stream": agg_stream_q,
    "stream_static_join": stream_static_join_q,
    "dedupe_stream": dedupe_stream_q,
    "word_count_stream": word_count_stream_q,
    "dlq_headers": dlq_headers_q,
    "consume_stream": consume_stream,
    "consume_commits": consume_commits,
    "consume_dead_letters": consume_dead_letters,
    "replay_stream": replay_stream_query,
    "push_query": push_query_q,
    "query_state": query_state_q,
    "replay_dead_letters": replay_dead_letters,
}
