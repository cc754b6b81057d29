"""Replaying offset ranges of topics (or of their dead letters).

A *replay-requests DataFrame* has ``request_id, topic_name, partition_id,
start_offset, end_offset, consumer_group, dlq_indicator, streaming_app,
destination_topic`` -- the metadata a replay request carries.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DLQ_EXT, REPLAY_ERROR_CODE, REPLAY_RULES, REPLAY_START_MISMATCH
from ._args import broadcast_bytes
from .numbering import floor_div
from ..functions.names import base_topic, dlq_topic, is_empty, parse_topic_list, topic_in

TP = ["topic", "partition_id"]
REQUEST_DDL = ("request_id bigint, topic_name string, partition_id int, start_offset bigint, end_offset bigint, "
               "consumer_group string, dlq_indicator boolean, streaming_app boolean, destination_topic string")
CONTROL_SCHEMA = ("topicName string, partition int, startOffset bigint, endOffset bigint, consumerGroup string, "
                  "streamingApp boolean, destinationTopic string, dlqIndicator boolean")
# offsets per bucket of the range join (the least width); a request is cut into the buckets it covers
REPLAY_BUCKET = 4096
# rows the bucketed request side aims at; wider buckets when the requests cover more offsets
REPLAY_TARGET_ROWS = 2_000_000
# topics of the requests that become a filter of the scan; more are joined
MAX_TOPICS = 500
# size that a bucketed request row counts with against the broadcast threshold (names included)
REQUEST_ROW_BYTES = 400


def validate_replays(requests: DataFrame, config_topics: str | list[str], mode: str = "strict") -> DataFrame:
    """Error code and detail of the first rule a request breaks (null when valid), plus ``valid``."""
    c = F.col
    broken = {
        "empty_topic": is_empty("topic_name"),
        "topic_not_configured": ~topic_in("topic_name", config_topics, mode),
        "negative_partition": c("partition_id") < 0,
        "negative_start": c("start_offset") < 0,
        "negative_end": c("end_offset") < 0,
        "start_after_end": c("start_offset") > c("end_offset"),
        "start_equals_end": c("start_offset") == c("end_offset"),
        "empty_group": is_empty("consumer_group"),
        "no_destination": F.coalesce(c("streaming_app"), F.lit(False)) & is_empty("destination_topic"),
    }
    detail = None
    for rule, text in REPLAY_RULES:
        detail = (F.when(broken[rule], F.lit(text)) if detail is None
                  else detail.when(broken[rule], F.lit(text)))
    return requests.select("*", detail.alias("error_detail")).select(
        "*", F.when(F.col("error_detail").isNotNull(), F.lit(REPLAY_ERROR_CODE)).alias("error_code"),
        F.col("error_detail").isNull().alias("valid"))


def valid_replays(requests: DataFrame, config_topics: str | list[str], mode: str = "strict") -> DataFrame:
    return validate_replays(requests, config_topics, mode).filter("valid").drop("error_detail", "error_code", "valid")


def read_topic(ext: str = DLQ_EXT):
    """Topic a request reads: its dead-letter topic when flagged."""
    return F.when(F.coalesce(F.col("dlq_indicator"), F.lit(False)), dlq_topic("topic_name", ext, always=True)) \
        .otherwise(F.col("topic_name"))


def topic_read(requests: DataFrame, ext: str = DLQ_EXT):
    """The topic of a control record as it stands, where ``requests`` carry it, else ``read_topic``."""
    if "control_topic_name" in requests.columns:
        return F.coalesce("control_topic_name", read_topic(ext))
    return read_topic(ext)


def replay_control_record(requests: DataFrame, ext: str = DLQ_EXT) -> DataFrame:
    """Control-topic record of each request: key = topic to read, value = the metadata as JSON
    (topic name already suffixed for dead-letter replays)."""
    t = read_topic(ext)
    meta = F.struct(t.alias("topicName"), F.col("partition_id").alias("partition"),
                    F.col("start_offset").alias("startOffset"), F.col("end_offset").alias("endOffset"),
                    F.col("consumer_group").alias("consumerGroup"), F.col("streaming_app").alias("streamingApp"),
                    F.col("destination_topic").alias("destinationTopic"),
                    F.col("dlq_indicator").alias("dlqIndicator"))
    return requests.select("request_id", t.alias("key"),
                           F.to_json(meta, {"ignoreNullFields": "false"}).alias("value"))


def requests_from_control(control: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse control records back into request columns (``topic_name`` as stored, i.e. suffixed)."""
    m = F.from_json(F.col(value_col).cast("string"), CONTROL_SCHEMA).alias("m")
    keep = [c for c in control.columns if c not in (value_col,)]
    return control.select(*keep, m).select(
        *keep, F.col("m.topicName").alias("topic_name"), F.col("m.partition").alias("partition_id_req"),
        F.col("m.startOffset").alias("start_offset"), F.col("m.endOffset").alias("end_offset"),
        F.col("m.consumerGroup").alias("consumer_group"), F.col("m.streamingApp").alias("streaming_app"),
        F.col("m.destinationTopic").alias("destination_topic"), F.col("m.dlqIndicator").alias("dlq_indicator"))


def relevant_replays(control: DataFrame, config_topics: str | list[str], mode: str = "strict",
                     ext: str = DLQ_EXT) -> DataFrame:
    """Control requests this consumer handles: the topic is configured, or -- for a
    dead-letter replay -- the base topic before ``ext`` is.  ``compat`` uses the
    substring test of the original service."""
    dlq = F.coalesce(F.col("dlq_indicator"), F.lit(False))
    keep = (dlq & topic_in(base_topic("topic_name", ext), config_topics, mode)) | topic_in("topic_name", config_topics, mode)
    return control.filter(keep)


def invalid_topics(requested, configured: str | list[str]):
    """Requested topics (array column) that are not configured, in request order."""
    conf = parse_topic_list(configured) if isinstance(configured, str) else list(configured)
    r = F.col(requested) if isinstance(requested, str) else requested
    return F.array_except(r, F.array(*[F.lit(t) for t in conf]))


def replay(requests: DataFrame, log: DataFrame, ext: str = DLQ_EXT, bucket: int = REPLAY_BUCKET,
           target_rows: int = REPLAY_TARGET_ROWS) -> DataFrame:
    """All records of all requests in one pass: ``start <= log_offset < end`` on the
    requested topic-partition (its dead-letter topic when flagged; a control record's
    ``control_topic_name`` is read as it stands).

    Range join as an equi-join.  The requests are checkpointed to the shared folder and
    measured first: their topics, partitions and the hull of their offsets become filters
    of the log's scan (folders and row groups outside are skipped), and only that part of
    the log is asked for its bounds.  Requests are clamped to those bounds and cut into
    offset buckets, ``bucket`` wide or wider so that a few huge ranges stay near
    ``target_rows`` rows; log rows join on (topic, partition_id, bucket) and keep the exact
    range.  The bucketed requests are broadcast when their measured number of rows fits
    the session's broadcast threshold, so the log is not shuffled; beyond it both sides
    are shuffled by bucket, which no hot partition can pile up."""
    from ..session import checkpoint_root
    req = requests.select(
        "request_id", "consumer_group", F.col("topic_name").alias("origin_topic"), topic_read(requests, ext).alias("topic"),
        "partition_id", F.col("start_offset").cast("bigint").alias("start_offset"),
        F.col("end_offset").cast("bigint").alias("end_offset"), "streaming_app", "destination_topic")
    checkpoint_root(log.sparkSession)
    req = req.checkpoint(eager=True)
    hull = req.agg(F.min("start_offset").alias("lo"), F.max("end_offset").alias("hi"), F.min("partition_id").alias("p0"),
                   F.max("partition_id").alias("p1")).first()
    topics = [r[0] for r in req.select("topic").distinct().limit(MAX_TOPICS + 1).collect()]
    log = log.filter(F.col("log_offset").between(hull["lo"], (hull["hi"] or 0) - 1)
                     & F.col("partition_id").between(hull["p0"], hull["p1"])) if hull["lo"] is not None else log.limit(0)
    if len(topics) <= MAX_TOPICS:
        log = log.filter(F.col("topic").isin([t for t in topics if t is not None]))
    else:
        log = log.join(req.select("topic").distinct(), "topic", "left_semi")
    bounds = log.groupBy(*TP).agg(F.min("log_offset").alias("_lo"), (F.max("log_offset") + 1).alias("_hi"))
    lo = F.greatest("start_offset", "_lo")
    hi = F.least("end_offset", "_hi")
    clamped = (req.join(bounds, TP).filter(lo < hi)
               .select(*req.columns, lo.alias("_lo"), hi.alias("_hi"))).checkpoint(eager=True)
    stats = clamped.agg(F.sum(F.col("_hi") - F.col("_lo")).alias("n"), F.count("*").alias("requests")).first()
    total = int(stats["n"] or 0)
    w = max(bucket, -(-total // max(target_rows, 1)))
    r = clamped.select(*req.columns, F.explode(F.sequence(floor_div(F.col("_lo"), w), floor_div(F.col("_hi") - 1, w))).alias("_bucket"))
    rows = total // w + 2 * stats["requests"]
    if rows * REQUEST_ROW_BYTES <= broadcast_bytes(log.sparkSession):
        r = F.broadcast(r)
    clash = [c for c in req.columns if c in log.columns and c not in TP]
    keep = [c for c in log.columns if c not in clash]
    lg = log.select(*keep, floor_div(F.col("log_offset"), w).alias("_bucket"))
    return (lg.join(r, [*TP, "_bucket"])
            .filter((F.col("log_offset") >= F.col("start_offset")) & (F.col("log_offset") < F.col("end_offset")))
            .drop("_bucket"))


def replay_start_check(requests: DataFrame, log: DataFrame, ext: str = DLQ_EXT) -> DataFrame:
    """Per request: does the first record read sit exactly at the start offset?

    Offsets are unique and increasing, so the first record at or after ``start``
    is at ``start`` exactly when a record with that offset exists: an equi-join,
    not a range scan.  Nothing there means not ok."""
    from ._args import join_checked
    req = requests.select("request_id", topic_read(requests, ext).alias("topic"), "partition_id",
                          F.col("start_offset").cast("bigint").alias("log_offset"))
    # probe the log with the start positions (broadcast when few), then attach to the requests
    starts = req.select(*TP, "log_offset").distinct()
    hit = join_checked(log.select(*TP, "log_offset"), starts, [*TP, "log_offset"]).withColumn("_hit", F.lit(True))
    j = req.join(hit, [*TP, "log_offset"], "left")
    ok = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select("request_id", "topic", "partition_id", F.col("log_offset").alias("start_offset"),
                    ok.alias("ok"), F.when(~ok, F.lit(REPLAY_START_MISMATCH)).alias("error_detail"))


def replay_progress(requests: DataFrame, replayed: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Per request: records read, last offset, next offset to read and whether the range
    is done (``next >= end``).  A request that read nothing keeps ``next = start``; so does one
    listed in ``failed`` (request_id: its function failed or its results were rolled back),
    which is never finished."""
    g = replayed.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_records"),
                                           F.max("log_offset").alias("last_offset"))
    r = requests.select("request_id", F.col("start_offset").cast("bigint").alias("start_offset"),
                        F.col("end_offset").cast("bigint").alias("end_offset"))
    j = r.join(g, "request_id", "left")
    nxt = F.coalesce(F.col("last_offset") + 1, F.col("start_offset"))
    done = nxt >= F.col("end_offset")
    if failed is not None:
        j = j.join(failed.select("request_id").distinct().withColumn("_failed", F.lit(True)), "request_id", "left")
        lost = F.coalesce("_failed", F.lit(False))
        nxt, done = F.when(lost, F.col("start_offset")).otherwise(nxt), ~lost & done
    return j.select("request_id", F.coalesce("n_records", F.lit(0)).alias("n_records"), "last_offset",
                    nxt.alias("next_offset"), done.alias("finished"))


def replay_summary(replayed: DataFrame) -> DataFrame:
    """Per consumer group: records replayed and the sorted, comma-joined topics."""
    return replayed.groupBy("consumer_group").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.array_join(F.sort_array(F.collect_set("origin_topic")), ",").alias("topics"))


def republish(replayed: DataFrame) -> DataFrame:
    """Replayed records of streaming-app requests as records of their destination topic;
    only the two trace ids travel along."""
    from ..functions.headers import replay_headers
    return (replayed.filter(F.coalesce(F.col("streaming_app"), F.lit(False)))
            .select("request_id", F.col("destination_topic").alias("topic"), "key", "value",
                    replay_headers().alias("headers"),
                    F.col("topic").alias("source_topic"), "partition_id", F.col("log_offset").alias("source_offset")))


def status_table(spark) -> DataFrame:
    """The error-status dimension (code, status_code, message): fixed and small."""
    from ..config import STATUS_TABLE
    from ._args import small_frame
    return small_frame(spark, list(STATUS_TABLE), "code string, status_code int, message string")


def with_status(df: DataFrame, code_col: str = "error_code") -> DataFrame:
    """Attach status code and message of each row's error code (left join on a broadcast
    dimension; rows without a code keep nulls)."""
    st = status_table(df.sparkSession)
    return df.join(st, df[code_col] == st["code"], "left").drop("code")
