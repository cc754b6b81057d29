"""Queries on reserved appends, stored tables and stateful streams whose records come late or from two sides."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tables import dedupe_stream, materialize_window
from ..session import scratch_path
from ..sources import reservations as R
from ..sources import segments as G
from ..sources.log import events_as_records, flat
from ..streaming import table_store as T
from ..streaming.deadletters import drain_dead_letters
from ..streaming.deadletters import post_failures as post
from ..streaming.joins import interval_join
from ..streaming.push import push_query
from .fixtures import NOW_MS, SERVICE_ID
from .segment_queries import SEGMENT_ROWS

HOUR_MS = 3_600_000
#: Users whose rows ``table_lookup`` asks for.
LOOKUP_USERS = ("1", "2", "3", "5", "8", "13", "none")


def _part(fx, t_ms: Column, n: int = 4) -> Column:
    """Which of ``n`` equal parts of the log's time a time lies in (the last one also holds what comes later)."""
    low, high = fx.log.agg(F.min(F.unix_millis("timestamp")), F.max(F.unix_millis("timestamp"))).first()
    low, high = low or 0, high or 0
    part = F.call_function("div", (t_ms - F.lit(low)) * n, F.lit(high - low + 1).cast("bigint"))
    return F.coalesce(F.greatest(F.least(part, F.lit(n - 1)), F.lit(0)), F.lit(0))


def _append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _stream(spark, path: str) -> DataFrame:
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def _arriving(fx, rows: DataFrame, transform, name: str, n: int = 4, last: DataFrame | None = None) -> DataFrame:
    """What a stream puts out whose input comes in parts (column ``part``): after each part it runs until it has
    read it, and goes on from its checkpoint with the next."""
    src, out, ckpt = (scratch_path(fx.spark, f"{name}-{x}") for x in ("in", "out", "ckpt"))
    parts = [rows.filter(F.col("part") == k).drop("part") for k in range(n)]
    for part in parts + ([last] if last is not None else []):
        _append(part, src)
        push_query(_stream(fx.spark, src), transform, out, ckpt).awaitTermination()
    return fx.spark.read.parquet(out)


def append_reserved(fx) -> DataFrame:
    """SNK-2: two requests of failed records, the first one sent again after the second: it keeps its offsets.  Every third
    record of the second names no valid partition and is refused."""
    path = scratch_path(fx.spark, "reserved-append")
    G.write_segments(fx.log, path, SEGMENT_ROWS)
    again = fx.results.filter(F.col("processed") == F.lit(False)).select(
        "topic", "partition_id", "timestamp", "key", "value", "headers", F.col("event_id").alias("seq"))
    first = again.filter("seq % 8 = 0")
    second = again.filter("seq % 8 = 4").withColumn("partition_id", F.when(F.col("seq") % 3 == 0, F.lit(-1)).otherwise(F.col("partition_id")))
    R.append_reserved(first, path, "first", segment_rows=SEGMENT_ROWS)
    of_second = R.append_reserved(second, path, "second", segment_rows=SEGMENT_ROWS)
    return R.append_reserved(first, path, "first", segment_rows=SEGMENT_ROWS).unionByName(of_second)


def _kept_table(fx, name: str) -> str:
    """The latest record per (topic, user) of the events, kept from a stream of two parts and compacted between them."""
    spark = fx.spark
    events = events_as_records(fx.table("events"))
    rows = events.withColumn("part", _part(fx, F.unix_millis("timestamp"), 2))
    src, path, ckpt = (scratch_path(spark, f"{name}-{x}") for x in ("in", "table", "ckpt"))
    for k in range(2):
        _append(rows.filter(F.col("part") == k).drop("part"), src)
        T.keep_table(_stream(spark, src), ["topic", "key"], path, ckpt, order=("timestamp", "partition_id", "event_id"),
                     buckets=8).awaitTermination()
        if k == 0:
            T.compact(spark, path)
    return path


def _flat_table(df: DataFrame) -> DataFrame:
    return df.select("topic", "key", F.unix_millis("timestamp").alias("ts_ms"), "partition_id", "event_id", "value")


def table_store(fx) -> DataFrame:
    """AGG-5 / STR-4: the stored table, its base compacted halfway and later changes on top."""
    return _flat_table(T.read_store(fx.spark, _kept_table(fx, "table-store")))


def table_lookup(fx) -> DataFrame:
    """STR-5: a pull query by key on the stored table: it reads the buckets of its keys only."""
    topics = [r[0] for r in fx.log.select("topic").distinct().limit(100).collect()]  # the fixture has one per event type
    return _flat_table(T.lookup(fx.spark, _kept_table(fx, "table-lookup"), [(t, u) for t in topics for u in LOOKUP_USERS]))


def session_stream(fx) -> DataFrame:
    """WIN-4 on a stream: sessions of a user and topic (gap 2 hours) put out as they close, the records coming in four
    parts; every 11th is 2 hours late (within the watermark of 3), some come parts later and are dropped."""
    t = F.unix_millis("timestamp")
    late = F.when(F.col("event_id") % 11 == 0, F.lit(2 * HOUR_MS)).otherwise(F.lit(0))
    rows = fx.log.select("topic", "key", "timestamp", "event_id").withColumn("part", _part(fx, t + late))
    rows = rows.withColumn("part", F.when((F.col("event_id") % 101 == 0) & (F.col("part") < 2), F.lit(3)).otherwise(F.col("part")))
    # a record long after the others closes their sessions; its own stays open
    end = fx.log.agg((F.max("timestamp") + F.expr("interval 30 days")).alias("timestamp")).select(
        F.lit("end").alias("topic"), F.lit("end").alias("key"), "timestamp", F.lit(0).cast("bigint").alias("event_id"))

    def sessions(df: DataFrame) -> DataFrame:
        return materialize_window(df, "session", "2 hours", ["key", "topic"], {"n": F.count(F.lit(1))}, watermark="3 hours")
    return _arriving(fx, rows, sessions, "sessions", last=end).select(
        "key", "topic", F.unix_millis("window_start").alias("window_start_ms"), F.unix_millis("window_end").alias("window_end_ms"), "n")


def interval_join_stream(fx) -> DataFrame:
    """JN-6 with two streams: records joined with their results as both arrive, if the result comes within 2 hours."""
    sent = fx.log.select("topic", "partition_id", "log_offset", F.col("timestamp").alias("sent_at"))
    results = fx.results.select("topic", "partition_id", "log_offset", "processed",
                                (F.col("timestamp") + F.make_dt_interval(hours=(F.col("event_id") % 5).cast("int"))).alias("result_at"))
    spark = fx.spark
    left, right, out, ckpt = (scratch_path(spark, f"interval-{x}") for x in ("sent", "results", "out", "ckpt"))
    parts = [(df.withColumn("part", _part(fx, F.unix_millis(t))), path) for df, t, path in ((sent, "sent_at", left), (results, "result_at", right))]
    for k in range(4):
        for df, path in parts:
            _append(df.filter(F.col("part") == k).drop("part"), path)
        joined = interval_join(_stream(spark, left), _stream(spark, right), ["topic", "partition_id", "log_offset"],
                               "sent_at", "result_at", "2 hours", "1 hour")
        push_query(joined, None, out, ckpt).awaitTermination()
    return spark.read.parquet(out).select("topic", "partition_id", "log_offset", "processed", F.unix_millis("sent_at").alias("sent_ms"),
                                          F.unix_millis("result_at").alias("result_ms"))


def dedupe_within(fx) -> DataFrame:
    """STR-6 with bounded state: every 5th record is sent again in the next part (dropped), every 7th of the first
    half once more half the log's time later, when its key has left the state (a new record)."""
    t = F.unix_millis("timestamp")
    rows = fx.log.select("event_id", "topic", "timestamp").withColumn("part", _part(fx, t))
    resent = rows.filter((F.col("event_id") % 5 == 0) & (F.col("part") < 3)).withColumn("part", F.col("part") + 1)
    low, high = fx.log.agg(F.min(t), F.max(t)).first()
    half = ((high or 0) - (low or 0) + 1) // 2
    later = rows.filter((F.col("event_id") % 7 == 0) & (F.col("part") < 2)).withColumn("part", F.col("part") + 2) \
        .withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + F.lit(half * 1000)))
    out = _arriving(fx, rows.unionByName(resent).unionByName(later),
                    lambda df: dedupe_stream(df, ["event_id"], "timestamp", "3 hours"), "dedupe-within")
    return out.select("event_id", "topic", F.unix_millis("timestamp").alias("ts_ms"))


def post_failures(fx) -> DataFrame:
    """STR-11: the acknowledgement of posted failures; the offsets go on from the dead letters that are there."""
    path = scratch_path(fx.spark, "posted-failures")
    G.write_segments(fx.dlq.drop("origin_topic", "source_offset", "event_id"), path, SEGMENT_ROWS)
    ack, _audit = post(fx.results, path, "posted", NOW_MS, SERVICE_ID, segment_rows=SEGMENT_ROWS)
    return ack


def _drained(fx) -> tuple[DataFrame, DataFrame]:
    """A group that has committed every 50th dead letter drains what is left of two topics."""
    commits = fx.dlq.filter(F.col("log_offset") % 50 == 49).select(
        F.lit("g5").alias("consumer_group"), "topic", "partition_id", "log_offset", F.col("log_offset").alias("committed_at"))
    return drain_dead_letters(fx.dlq, commits, "g5", "ev.click, ev.error", committed_at=NOW_MS)


def drain_resumed(fx) -> DataFrame:
    """STR-12: the dead letters after the group's commits."""
    return flat(_drained(fx)[0])


def drain_commits(fx) -> DataFrame:
    """STR-12: the commits table after a drain."""
    return _drained(fx)[1]


STATEFUL_QUERIES = {f.__name__: f for f in (append_reserved, table_store, table_lookup, session_stream, interval_join_stream,
                                            dedupe_within, post_failures, drain_resumed, drain_commits)}
