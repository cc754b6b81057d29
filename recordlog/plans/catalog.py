"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query reads the driver tables (through the fixtures derived from them)
and runs over them whole.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import STATUS_TABLE
from ..functions import headers as H
from ..functions import names as N
from ..operators import offsets as O
from ..operators import replay as R
from ..operators import results as RS
from ..operators import select as S
from ..operators import tables as TB
from ..sources import codec as C
from ..sources.json_schema import Schemas
from ..sources.log import flat, string_headers
from .fixtures import NOW_MS, REPLAY_TOPICS, SERVICE_ID, Fixtures, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FLAT = "topic, partition_id, log_offset, ts_ms, record_key, record_value"


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixtures(spark, sf_dir))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# =================================================================== sources
@query("subscribe", sql(f"SELECT {FLAT} FROM log WHERE topic IN ('ev.click', 'ev.view')"))
def _(fx):
    return flat(S.subscribe(fx.log, "ev.click, ev.view"))


@query("subscribe_pattern", sql(f"SELECT {FLAT} FROM log WHERE regexp_full_match(topic, 'ev\\.(c|v)[a-z]*')"))
def _(fx):
    return flat(S.subscribe_pattern(fx.log, r"ev\.(c|v)[a-z]*"))


ASSIGNED = [("ev.click", 0), ("ev.click", 2), ("ev.error", 1), ("ev.nope", 0)]


@query("assign", sql(f"""SELECT {FLAT} FROM log WHERE (topic = 'ev.click' AND partition_id IN (0, 2))
   OR (topic = 'ev.error' AND partition_id = 1) OR (topic = 'ev.nope' AND partition_id = 0)"""))
def _(fx):
    return flat(S.assign(fx.log, ASSIGNED))


POSITIONS = [("ev.click", 0, 100), ("ev.view", 1, 250), ("ev.error", 3, 0)]


@query("seek", sql(f"""SELECT {FLAT} FROM log WHERE (topic = 'ev.click' AND partition_id = 0 AND log_offset >= 100)
   OR (topic = 'ev.view' AND partition_id = 1 AND log_offset >= 250)
   OR (topic = 'ev.error' AND partition_id = 3 AND log_offset >= 0)"""))
def _(fx):
    return flat(S.seek(fx.log, POSITIONS))


SEEK_TIMES = [("ev.click", 0, "2024-01-15T00:00:00"), ("ev.view", 2, "2024-01-20T12:00:00"),
              ("ev.error", 1, "2030-01-01T00:00:00")]


@query("seek_timestamps", sql(
    f"SELECT l.topic, l.partition_id, l.log_offset, l.ts_ms, l.record_key, l.record_value "
    f"FROM log l JOIN s ON l.topic = s.topic AND l.partition_id = s.partition_id WHERE l.log_offset >= s.pos",
    """req(topic, partition_id, t) AS (VALUES ('ev.click', 0, 1705276800000), ('ev.view', 2, 1705752000000),
                                          ('ev.error', 1, 1893456000000)),
       s AS (SELECT l.topic, l.partition_id, min(l.log_offset) AS pos FROM log l JOIN req r
             ON l.topic = r.topic AND l.partition_id = r.partition_id WHERE l.ts_ms >= r.t GROUP BY 1, 2)"""))
def _(fx):
    return flat(S.seek_timestamps(fx.log, SEEK_TIMES))


_BOUNDS_REQ = """req(topic, partition_id) AS (VALUES ('ev.click', 0), ('ev.view', 3), ('ev.nope', 1)),
  b AS (SELECT topic, partition_id, min(log_offset) AS lo, max(log_offset) AS hi FROM log GROUP BY 1, 2)"""
BOUNDS_REQ = [("ev.click", 0), ("ev.view", 3), ("ev.nope", 1)]


@query("seek_beginning", sql("""SELECT r.topic, CAST(r.partition_id AS INT) AS partition_id,
  CAST(COALESCE(b.lo, 0) AS BIGINT) AS position FROM req r LEFT JOIN b USING (topic, partition_id)""", _BOUNDS_REQ))
def _(fx):
    return S.seek_to_beginning(fx.log, BOUNDS_REQ)


@query("seek_end", sql("""SELECT r.topic, CAST(r.partition_id AS INT) AS partition_id,
  CAST(COALESCE(b.hi + 1, 0) AS BIGINT) AS position FROM req r LEFT JOIN b USING (topic, partition_id)""", _BOUNDS_REQ))
def _(fx):
    return S.seek_to_end(fx.log, BOUNDS_REQ)


_LATEST_G1 = """lc AS (SELECT topic, partition_id, arg_max(log_offset, committed_at) AS committed
                      FROM commits WHERE consumer_group = 'g1' GROUP BY 1, 2),
  resumed AS (SELECT l.* FROM log l LEFT JOIN lc USING (topic, partition_id)
              WHERE lc.committed IS NULL OR l.log_offset > lc.committed)"""


@query("resume_committed", sql(f"SELECT {FLAT} FROM resumed", _LATEST_G1))
def _(fx):
    return flat(S.resume(fx.log, fx.commits, "g1", "earliest"))


@query("fetch_count", sql(
    f"SELECT {FLAT} FROM (SELECT *, row_number() OVER (PARTITION BY topic, partition_id ORDER BY log_offset) AS rk "
    f"FROM resumed) WHERE rk <= 100", _LATEST_G1))
def _(fx):
    return flat(S.fetch(S.resume(fx.log, fx.commits, "g1"), 100))


@query("fetch_bytes", sql(
    f"""SELECT {FLAT} FROM (
      SELECT *, sum(strlen(COALESCE(record_key, '')) + strlen(COALESCE(record_value, '')))
                  OVER (PARTITION BY topic, partition_id ORDER BY log_offset ROWS UNBOUNDED PRECEDING) AS run
      FROM (SELECT *, row_number() OVER (PARTITION BY topic, partition_id ORDER BY log_offset) AS rk FROM resumed)
      WHERE rk <= 100) WHERE rk = 1 OR run <= 500""", _LATEST_G1))
def _(fx):
    return flat(S.fetch_bytes(S.resume(fx.log, fx.commits, "g1"), max_bytes=500, max_records=100))


@query("read_dead_letters", sql(f"SELECT {FLAT} FROM log_all WHERE topic IN ('ev.click.dlq', 'ev.view.dlq')"))
def _(fx):
    return flat(S.read_dead_letters(fx.log_all, "ev.click, ev.view"))


@query("explode_batch", sql("""SELECT topic, partition_id, CAST(log_offset // 100 AS BIGINT) AS batch_no, log_offset,
  result_key AS key, processed FROM results"""))
def _(fx):
    b = O.with_batches(fx.results)
    payload = b.groupBy("topic", "partition_id", "batch_no").agg(
        F.to_json(F.collect_list(F.struct("log_offset", F.col("result_key").alias("key"), "processed")))
        .alias("body"))
    return C.explode_batch(payload, "body", "log_offset bigint, key string, processed boolean")


@query("ingest_requests", sql("""SELECT topic, partition_id, CAST(log_offset // 100 AS BIGINT) AS batch_no,
  CASE WHEN (log_offset // 100) % 3 = 0 THEN 'STRING' ELSE 'JSONSCHEMA' END AS key_format,
  'JSONSCHEMA' AS value_format, CAST(log_offset % 100 AS BIGINT) AS seq, record_key AS key, record_value AS value
  FROM log"""))
def _(fx):
    b = O.with_batches(fx.log)
    req = b.groupBy("topic", "partition_id", "batch_no").agg(F.to_json(F.struct(
        F.when(F.col("batch_no") % 3 == 0, F.lit("string")).alias("keyFormat"),
        F.sort_array(F.collect_list(F.struct("log_offset", "key", "value"))).alias("records"))).alias("request"))
    return C.ingest_requests(req).select("topic", "partition_id", "batch_no", "key_format", "value_format",
                                         "seq", "key", "value")


@query("decode", sql("""SELECT topic, partition_id, log_offset, to_base64(encode(record_key)) AS key_b64,
  record_key AS key_str, CAST(json_extract(record_value, '$.k') AS INTEGER) AS k FROM log"""))
def _(fx):
    d = C.decode(fx.log.withColumn("key_b64", C.decode_col(F.col("key"), "BINARY")), "STRING", "JSON", "k int")
    return d.select("topic", "partition_id", "log_offset", "key_b64", F.col("key").alias("key_str"),
                    F.col("value.k").alias("k"))


@query("decode_skip_corrupt", sql("""SELECT topic, partition_id, log_offset, CAST(json_extract(record_value, '$.k') AS INTEGER) AS k
  FROM (SELECT topic, partition_id, log_offset, record_value FROM log
        UNION ALL SELECT 'docs.' || lang, 0, 0, text FROM documents)
  WHERE json_valid(record_value) AND json_type(record_value) = 'OBJECT'"""))
def _(fx):
    both = S.union_topics(fx.log, fx.doc_log)
    d = C.decode(both, "STRING", "JSON", "k int", on_error="skip")
    return d.select("topic", "partition_id", "log_offset", F.col("value.k").alias("k"))


REGISTERED = Schemas([
    (1, "orders", 1, '{"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 20}}}'),
    (2, "orders", 2, '{"type": "object", "properties": {"k": {"type": ["string", "null"]}}, "additionalProperties": false}'),
    (3, "views", 1, '{"type": "object", "required": ["k", "z"]}')])


@query("decode_by_schema", sql("""SELECT topic, partition_id, log_offset, id AS schema_id, CASE WHEN error IS NULL THEN k END AS k, error
  FROM (SELECT *, CASE WHEN NOT ok THEN '$: is not JSON' WHEN id = -1 THEN '$: its schema is not registered'
      WHEN id = 1 AND json_type(v) <> 'OBJECT' THEN '$: is not object'
      WHEN id = 1 AND k IS NULL THEN '$.k: is required' WHEN id = 1 AND k < 20 THEN '$.k: is below 20'
      WHEN id = 2 AND k IS NOT NULL THEN '$.k: is not string or null' WHEN id = 3 THEN '$.z: is required' END AS error
    FROM (SELECT *, CASE WHEN ok THEN CAST(json_extract(v, '$.k') AS BIGINT) END AS k
      FROM (SELECT topic, partition_id, log_offset, CAST([1, 2, 1, 3, -1, NULL][(log_offset % 6) + 1] AS INTEGER) AS id,
          json_valid(record_value) AS ok, CASE WHEN json_valid(record_value) THEN record_value END AS v
        FROM (SELECT topic, partition_id, log_offset, record_value FROM log UNION ALL
          SELECT 'docs.' || lang, 0, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1, text FROM documents))))"""))
def _(fx):
    """Records that name their schema in each of the ways a request can, and some that name an unknown one or none."""
    way = F.col("log_offset") % 6
    text = F.when(way == 3, F.lit('{"required":["k","z"],  "type":"object"}'))
    d = S.union_topics(fx.log, fx.doc_log).withColumn("schema_id", REGISTERED.id_of(
        F.when(way == 0, 1).when(way == 4, 77), F.when(way.isin(1, 2), "orders"), F.when(way == 2, 1), text))
    d = REGISTERED.decode(d, "value", "schema_id", on_error="keep")
    return d.select("topic", "partition_id", "log_offset", "schema_id", REGISTERED.typed(F.col("value"), 1)["k"].alias("k"),
                    F.get("errors_value", F.lit(0)).alias("error"))


@query("encode", sql("""SELECT 'out.' || topic AS topic, partition_id, log_offset, record_key AS key,
  json_object('event_id', event_id, 'user', record_key, 'k', CAST(json_extract(record_value, '$.k') AS INTEGER))::VARCHAR
    AS value FROM log"""))
def _(fx):
    src = fx.log.select("topic", "partition_id", "log_offset", "key", F.struct(
        "event_id", F.col("key").alias("user"), F.get_json_object("value", "$.k").cast("int").alias("k")).alias("value"))
    out = C.to_outgoing(src, F.concat(F.lit("out."), F.col("topic")), "STRING", "JSON",
                        keep=("partition_id", "log_offset"))
    return out.select("topic", "partition_id", "log_offset", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


@query("append_ack", sql("""SELECT r.event_id AS seq, r.topic, r.partition_id,
  CAST(b.nxt + row_number() OVER (PARTITION BY r.topic, r.partition_id ORDER BY r.event_id) - 1 AS BIGINT) AS log_offset
  FROM results r JOIN (SELECT topic, partition_id, max(log_offset) + 1 AS nxt FROM log GROUP BY 1, 2) b
  USING (topic, partition_id) WHERE r.processed = FALSE"""))
def _(fx):
    again = fx.results.filter(F.col("processed") == F.lit(False)).select(
        "topic", "partition_id", "key", "value", F.col("event_id").alias("seq"))
    return O.append(again, fx.log, "seq").select("seq", "topic", "partition_id", "log_offset")


_AUDIT_COLS = """sha256(concat_ws('|', '{svc}', '{typ}', topic, CAST(partition_id AS VARCHAR), CAST(log_offset AS VARCHAR),
    CASE WHEN COALESCE(processed, FALSE) THEN 'SUCCESS' ELSE 'FAILURE' END)) AS id,
  '{svc}' AS service_id, '{typ}' AS audit_type, topic, partition_id, log_offset,
  COALESCE(hdr_correlation_id, correlation_id) AS correlation_id,
  COALESCE(hdr_traceability_id, traceability_id) AS traceability_id,
  result_key AS key, ts_ms AS audit_ts,
  CASE WHEN COALESCE(processed, FALSE) THEN 'SUCCESS' ELSE 'FAILURE' END AS audit_status,
  CAST(NULL AS VARCHAR) AS stacktrace"""


@query("audit_kv", sql("""SELECT correlation_id AS key, json_object('id', id, 'service_id', service_id,
  'audit_type', audit_type, 'topic', topic, 'partition_id', partition_id, 'log_offset', log_offset,
  'correlation_id', correlation_id, 'traceability_id', traceability_id, 'key', key, 'audit_ts', audit_ts,
  'audit_status', audit_status, 'stacktrace', stacktrace)::VARCHAR AS value FROM a""",
    "a AS (SELECT " + _AUDIT_COLS.format(svc=SERVICE_ID, typ="REACTIVE_CONSUMER") + " FROM results)"))
def _(fx):
    return RS.audit_kv(RS.audit_from_results(fx.results, "REACTIVE_CONSUMER", SERVICE_ID))


@query("records_json", sql("""SELECT json_object('topic', topic, 'key', record_key, 'value', record_value,
  'partition', partition_id, 'offset', log_offset)::VARCHAR AS json FROM log"""))
def _(fx):
    return C.records_to_json(fx.log)


@query("republish", sql("""SELECT request_id, destination_topic AS topic, record_key AS key, record_value AS value,
  NULLIF(hdr_correlation_id, '') AS hdr_correlation_id, NULLIF(hdr_traceability_id, '') AS hdr_traceability_id,
  topic AS source_topic, partition_id, log_offset AS source_offset FROM replayed WHERE streaming_app"""))
def _(fx):
    rp = R.republish(R.replay(fx.valid_requests, fx.log_all))
    return rp.select("request_id", "topic", "key", "value",
                     H.header("X-Correlation-Id").alias("hdr_correlation_id"),
                     H.header("X-Traceability-Id").alias("hdr_traceability_id"),
                     "source_topic", "partition_id", "source_offset")


# =================================================================== projections
def _user_topic_text(fx) -> DataFrame:
    """Per user a topic-list text built from the log: separators vary, every fifth user
    lists one topic with a leading blank (that one must stay untrimmed)."""
    u = fx.log.groupBy("key").agg(F.array_sort(F.collect_set("topic")).alias("ts"))
    uid = F.col("key").cast("bigint")
    sep = F.when(uid % 3 == 0, ",").when(uid % 3 == 1, ", ").otherwise(" , ")
    text = (F.when(uid % 5 == 0, F.concat(F.lit(" "), F.col("ts")[0]))
            .otherwise(F.array_join("ts", "\u0001")))
    return u.select(uid.alias("user_id"), F.replace(text, F.lit("\u0001"), sep).alias("topics_text"))


_USER_TEXT = """ut0 AS (SELECT CAST(record_key AS BIGINT) AS user_id, list_sort(list_distinct(list(topic))) AS l
    FROM log GROUP BY record_key),
  ut AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN ' ' || l[1]
                              WHEN user_id % 3 = 0 THEN array_to_string(l, ',')
                              WHEN user_id % 3 = 1 THEN array_to_string(l, ', ')
                              ELSE array_to_string(l, ' , ') END AS topics_text FROM ut0),
  tl AS (SELECT user_id, CASE WHEN contains(topics_text, ',')
                  THEN string_split(regexp_replace(topics_text, '\\s+', '', 'g'), ',')
                  ELSE [topics_text] END AS topics FROM ut)"""


@query("topic_list", sql("SELECT user_id, array_to_string(topics, '|') AS topics, CAST(len(topics) AS INT) AS n FROM tl",
                         _USER_TEXT))
def _(fx):
    t = _user_topic_text(fx).withColumn("l", N.topic_list("topics_text"))
    return t.select("user_id", F.array_join("l", "|").alias("topics"), F.size("l").alias("n"))


@query("invalid_topics", sql("""SELECT user_id, array_to_string(list_filter(topics, lambda x: x NOT IN ('ev.click', 'ev.view', 'ev.error')), '|')
  AS invalid FROM tl""", _USER_TEXT))
def _(fx):
    t = _user_topic_text(fx).withColumn("l", N.topic_list("topics_text"))
    return t.select("user_id", F.array_join(R.invalid_topics("l", "ev.click,ev.view,ev.error"), "|").alias("invalid"))


@query("dlq_topic", sql("""SELECT DISTINCT topic, CASE WHEN contains(topic, '.dlq') THEN topic ELSE topic || '.dlq' END
  AS dlq_topic FROM log_all"""))
def _(fx):
    return fx.log_all.select("topic").distinct().select("topic", N.dlq_topic("topic").alias("dlq_topic"))


@query("dlq_topic_always", sql("SELECT DISTINCT topic, topic || '.dlq' AS dlq_topic FROM log_all"))
def _(fx):
    return fx.log_all.select("topic").distinct().select("topic", N.dlq_topic("topic", always=True).alias("dlq_topic"))


@query("base_topic", sql("SELECT DISTINCT topic, split_part(topic, '.dlq', 1) AS base_topic FROM log_all"))
def _(fx):
    return fx.log_all.select("topic").distinct().select("topic", N.base_topic("topic").alias("base_topic"))


@query("audit_ids", sql("""SELECT topic, partition_id, log_offset, COALESCE(hdr_correlation_id, correlation_id) AS correlation_id,
  COALESCE(hdr_traceability_id, traceability_id) AS traceability_id FROM results"""))
def _(fx):
    return fx.results.select("topic", "partition_id", "log_offset", H.audit_correlation_id().alias("correlation_id"),
                             H.audit_traceability_id().alias("traceability_id"))


@query("dlq_ids", sql("""SELECT topic, partition_id, log_offset,
  COALESCE(NULLIF(correlation_id, ''), NULLIF(hdr_correlation_id, '')) AS correlation_id,
  COALESCE(NULLIF(traceability_id, ''), NULLIF(hdr_traceability_id, '')) AS traceability_id FROM results"""))
def _(fx):
    return fx.results.select("topic", "partition_id", "log_offset", H.dlq_correlation_id().alias("correlation_id"),
                             H.dlq_traceability_id().alias("traceability_id"))


@query("replay_headers", sql("""SELECT topic, partition_id, log_offset,
  CAST((CASE WHEN hdr_correlation_id <> '' THEN 1 ELSE 0 END) + (CASE WHEN hdr_traceability_id <> '' THEN 1 ELSE 0 END) AS INT) AS n_headers,
  NULLIF(hdr_correlation_id, '') AS correlation_id, NULLIF(hdr_traceability_id, '') AS traceability_id FROM log"""))
def _(fx):
    h = fx.log.select("topic", "partition_id", "log_offset", H.replay_headers().alias("h"))
    return h.select("topic", "partition_id", "log_offset", F.size("h").alias("n_headers"),
                    F.col("h").getItem("X-Correlation-Id").alias("correlation_id"),
                    F.col("h").getItem("X-Traceability-Id").alias("traceability_id"))


@query("carry_timestamp", sql(f"""SELECT topic, partition_id, log_offset,
  CASE WHEN ts_ms - 1704153600000 > 0 THEN ts_ms - 1704153600000 ELSE {NOW_MS} END AS ts_out FROM log"""))
def _(fx):
    # record times relative to 2024-01-02: the first day's records are <= 0 and take "now"
    rel = F.unix_millis("timestamp") - F.lit(1704153600000)
    return fx.log.select("topic", "partition_id", "log_offset", H.carry_timestamp(rel, NOW_MS).alias("ts_out"))


@query("inject_headers", sql("""SELECT topic, partition_id, log_offset,
  CAST((CASE WHEN hdr_correlation_id IS NULL THEN 0 ELSE 1 END) + (CASE WHEN hdr_traceability_id IS NULL THEN 0 ELSE 1 END)
       + 1 + 2 AS INT) AS n_headers,
  'Bearer t0k' AS authorization, 'svc-a' AS caller_id, hdr_correlation_id AS correlation_id FROM log"""))
def _(fx):
    h = fx.log.select("topic", "partition_id", "log_offset",
                      H.inject_headers("headers", "Bearer t0k", "svc-a").alias("h"))
    return h.select("topic", "partition_id", "log_offset", F.size("h").alias("n_headers"),
                    F.col("h").getItem("Authorization").alias("authorization"),
                    F.col("h").getItem("X-Caller-Id").alias("caller_id"),
                    F.col("h").getItem("X-Correlation-Id").alias("correlation_id"))


@query("audit_results", sql("SELECT " + _AUDIT_COLS.format(svc=SERVICE_ID, typ="REACTIVE_CONSUMER") + " FROM results"))
def _(fx):
    return RS.audit_from_results(fx.results, "REACTIVE_CONSUMER", SERVICE_ID)


@query("audit_posted", sql("SELECT " + _AUDIT_COLS.format(svc=SERVICE_ID, typ="ACTIVE_CONSUMER") + " FROM results"))
def _(fx):
    return RS.audit_from_results(fx.results, "ACTIVE_CONSUMER", SERVICE_ID)


_CONTROL = """ctl AS (SELECT request_id,
    CASE WHEN dlq_indicator THEN topic_name || '.dlq' ELSE topic_name END AS key,
    json_object('topicName', CASE WHEN dlq_indicator THEN topic_name || '.dlq' ELSE topic_name END,
                'partition', partition_id, 'startOffset', start_offset, 'endOffset', end_offset,
                'consumerGroup', consumer_group, 'streamingApp', streaming_app,
                'destinationTopic', destination_topic, 'dlqIndicator', dlq_indicator)::VARCHAR AS value
  FROM valid_requests)"""


def _control_log(fx) -> DataFrame:
    """Control records of the valid requests appended to topic ``replay.control``, partition 0."""
    ctl = R.replay_control_record(fx.valid_requests).select(
        F.lit("replay.control").alias("topic"), F.lit(0).alias("partition_id"), "request_id", "key", "value",
        string_headers(("X-Correlation-Id", F.concat(F.lit("rc-"), F.col("request_id").cast("string"))),
                         ("X-Traceability-Id", F.concat(F.lit("rt-"), F.col("request_id").cast("string"))))
        .alias("headers"))
    empty = ctl.limit(0).select("topic", "partition_id", F.lit(0).cast("bigint").alias("log_offset"))
    return O.append(ctl, empty, "request_id")


@query("audit_replay", sql(f"""SELECT sha256(concat_ws('|', '{SERVICE_ID}', 'STREAMING_CONSUMER', 'replay.control', '0',
    CAST(log_offset AS VARCHAR), 'SUCCESS')) AS id, '{SERVICE_ID}' AS service_id, 'STREAMING_CONSUMER' AS audit_type,
  'replay.control' AS topic, 0 AS partition_id, log_offset, 'rc-' || CAST(request_id AS VARCHAR) AS correlation_id,
  'rt-' || CAST(request_id AS VARCHAR) AS traceability_id, key, CAST({NOW_MS} AS BIGINT) AS audit_ts,
  'SUCCESS' AS audit_status, '' AS stacktrace
  FROM (SELECT *, CAST(row_number() OVER (ORDER BY request_id) - 1 AS BIGINT) AS log_offset FROM ctl)""", _CONTROL))
def _(fx):
    return RS.audit_from_replay(_control_log(fx), "SUCCESS", "", NOW_MS, SERVICE_ID)


@query("audit_write_error", sql(f"""SELECT sha256(concat_ws('|', '{SERVICE_ID}', 'PRODUCER',
    CASE WHEN contains(topic, '.dlq') THEN topic ELSE topic || '.dlq' END, CAST(partition_id AS VARCHAR),
    CAST(log_offset AS VARCHAR), 'FAILURE')) AS id,
  '{SERVICE_ID}' AS service_id, 'PRODUCER' AS audit_type,
  CASE WHEN contains(topic, '.dlq') THEN topic ELSE topic || '.dlq' END AS topic, 0 AS partition_id,
  CAST(0 AS BIGINT) AS log_offset, correlation_id, traceability_id, result_key AS key,
  CAST({NOW_MS} AS BIGINT) AS audit_ts, 'FAILURE' AS audit_status,
  COALESCE(stacktrace, 'dead letter not written') AS stacktrace
  FROM results WHERE processed IS NOT TRUE"""))
def _(fx):
    failed = RS.failed_for_dlq(fx.results)
    return RS.audit_from_write_error(failed, F.coalesce("stacktrace", F.lit("dead letter not written")),
                                     NOW_MS, service_id=SERVICE_ID)


@query("replay_control", sql("SELECT request_id, key, value FROM ctl", _CONTROL))
def _(fx):
    return R.replay_control_record(fx.valid_requests)


# =================================================================== filters
@query("failed_for_dlq", sql("SELECT topic, partition_id, log_offset, processed FROM results WHERE processed IS NOT TRUE"))
def _(fx):
    return RS.failed_for_dlq(fx.results).select("topic", "partition_id", "log_offset", "processed")


@query("relevant_replays", sql("""SELECT request_id, json_extract_string(value, '$.topicName') AS topic_name FROM ctl
  WHERE (json_extract(value, '$.dlqIndicator')::BOOLEAN
         AND split_part(json_extract_string(value, '$.topicName'), '.dlq', 1) IN ('ev.error', 'ev.view'))
     OR json_extract_string(value, '$.topicName') IN ('ev.error', 'ev.view')""", _CONTROL))
def _(fx):
    ctl = R.requests_from_control(R.replay_control_record(fx.valid_requests))
    return R.relevant_replays(ctl, "ev.error, ev.view").select("request_id", "topic_name")


@query("relevant_replays_compat", sql("""SELECT request_id, json_extract_string(value, '$.topicName') AS topic_name FROM ctl
  WHERE (json_extract(value, '$.dlqIndicator')::BOOLEAN
         AND contains('ev.views,ev.error', split_part(json_extract_string(value, '$.topicName'), '.dlq', 1)))
     OR contains('ev.views,ev.error', json_extract_string(value, '$.topicName'))""", _CONTROL))
def _(fx):
    """Relevance with the original substring test: configured ``ev.views`` also admits ``ev.view``."""
    ctl = R.requests_from_control(R.replay_control_record(fx.valid_requests))
    return R.relevant_replays(ctl, "ev.views,ev.error", mode="compat").select("request_id", "topic_name")


@query("validate_replays", sql("""SELECT request_id, CASE WHEN error_detail IS NULL THEN NULL ELSE 'ERR12218' END AS error_code,
  error_detail, error_detail IS NULL AS valid FROM validated"""))
def _(fx):
    return R.validate_replays(fx.requests, REPLAY_TOPICS).select("request_id", "error_code", "error_detail", "valid")


@query("topics_not_configured", sql("""SELECT DISTINCT topic_name AS topic FROM replay_requests
  WHERE topic_name NOT IN ('ev.error', 'ev.click', 'ev.view')"""))
def _(fx):
    return S.topics_not_configured(fx.requests.select(F.col("topic_name").alias("topic")), "ev.error,ev.click,ev.view")


# =================================================================== pull queries
_LATEST_PURCHASE = """lp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_key
    ORDER BY ts_ms DESC, partition_id DESC, log_offset DESC) AS rk FROM log WHERE topic = 'ev.purchase') WHERE rk = 1)"""


def _latest_purchase(fx) -> DataFrame:
    return TB.materialize_latest(S.subscribe(fx.log, "ev.purchase"), ["key"])


@query("pull_key", sql(f"SELECT {FLAT} FROM lp WHERE record_key = '42'", _LATEST_PURCHASE))
def _(fx):
    return flat(TB.pull_query(_latest_purchase(fx), key="42"))


@query("pull_scan", sql(f"SELECT {FLAT} FROM lp WHERE partition_id = 1", _LATEST_PURCHASE))
def _(fx):
    return flat(TB.pull_query(_latest_purchase(fx), where="partition_id = 1", table_scan=True))


# =================================================================== joins
@query("replay_range", sql("SELECT request_id, topic, partition_id, log_offset, record_key, record_value FROM replayed"))
def _(fx):
    r = R.replay(fx.valid_requests, fx.log_all)
    return r.select("request_id", "topic", "partition_id", "log_offset", F.col("key").alias("record_key"),
                    F.col("value").alias("record_value"))


@query("committed", sql("""SELECT DISTINCT l.topic, l.partition_id, c.committed AS committed_offset FROM log l
  LEFT JOIN (SELECT topic, partition_id, arg_max(log_offset, committed_at) AS committed FROM commits
             WHERE consumer_group = 'g1' GROUP BY 1, 2) c USING (topic, partition_id)"""))
def _(fx):
    return O.committed(fx.commits, "g1", fx.log.select("topic", "partition_id").distinct())


def _returned_results(fx) -> DataFrame:
    """Results as a backend might return them: some missing, some twice, some for records never sent."""
    r = fx.results
    e = F.col("event_id")
    kept = r.filter(e % 19 != 0)
    dup = r.filter(e % 23 == 0)
    alien = r.filter(e % 29 == 0).withColumn("log_offset", F.col("log_offset") + 1000000)
    return kept.unionByName(dup).unionByName(alien)


_RETURNED = """rr AS (SELECT * FROM results WHERE event_id % 19 <> 0
    UNION ALL SELECT * FROM results WHERE event_id % 23 = 0
    UNION ALL SELECT * REPLACE (log_offset + 1000000 AS log_offset) FROM results WHERE event_id % 29 = 0),
  rc AS (SELECT topic, partition_id, log_offset, count(*) AS n FROM rr GROUP BY 1, 2, 3)"""


@query("reconcile", sql("""SELECT COALESCE(s.topic, rc.topic) AS topic, COALESCE(s.partition_id, rc.partition_id) AS partition_id,
  COALESCE(s.log_offset, rc.log_offset) AS log_offset,
  CASE WHEN s.topic IS NOT NULL AND rc.n > 0 THEN 'matched' WHEN s.topic IS NOT NULL THEN 'missing_result'
       ELSE 'unexpected_result' END AS status,
  CAST(CASE WHEN s.topic IS NOT NULL THEN greatest(COALESCE(rc.n, 0) - 1, 0) ELSE rc.n END AS BIGINT) AS n_unexpected
  FROM (SELECT DISTINCT topic, partition_id, log_offset FROM log) s
  FULL OUTER JOIN rc ON s.topic = rc.topic AND s.partition_id = rc.partition_id AND s.log_offset = rc.log_offset""",
    _RETURNED))
def _(fx):
    return RS.reconcile(fx.log, _returned_results(fx))


def _status_sql() -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, int):
            return str(v)
        return "'" + v.replace("'", "''") + "'"
    rows = ", ".join(f"({lit(c)}, CAST({lit(s)} AS INT), {lit(m)})" for c, s, m in STATUS_TABLE)
    return f"st(code, status_code, message) AS (VALUES {rows})"


@query("with_status", sql("""SELECT v.request_id, 'ERR12218' AS error_code, st.status_code, st.message
  FROM validated v LEFT JOIN st ON st.code = 'ERR12218' WHERE v.error_detail IS NOT NULL""", _status_sql()))
def _(fx):
    v = R.validate_replays(fx.requests, REPLAY_TOPICS).filter(~F.col("valid"))
    return R.with_status(v).select("request_id", "error_code", "status_code", "message")


@query("materialize_join", sql("""SELECT CAST(lp.record_key AS BIGINT) AS user_id, lp.log_offset, lp.record_value AS value,
  c.c_name, c.c_mktsegment FROM lp JOIN customer c ON c.c_custkey = CAST(lp.record_key AS BIGINT)""", _LATEST_PURCHASE))
def _(fx):
    t = _latest_purchase(fx).withColumn("user_id", F.col("key").cast("bigint"))
    cust = fx.table("customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return TB.materialize_join(t, cust, "user_id").select("user_id", "log_offset", "value", "c_name", "c_mktsegment")


# =================================================================== aggregations
@query("commit_positions", sql("""SELECT topic, partition_id, log_offset // 100 AS batch_no, max(log_offset) AS log_offset
  FROM log GROUP BY 1, 2, 3"""))
def _(fx):
    return O.commit_positions(O.with_batches(fx.log), "batch_no")


def _rollback_sql(op: str) -> str:
    return sql(f"""SELECT topic, partition_id, batch_no, COUNT(*) AS batch_size,
       CAST(SUM(CASE WHEN processed = FALSE THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       SUM(CASE WHEN processed = FALSE THEN 1 ELSE 0 END) {op} CAST(30 AS DOUBLE) * COUNT(*) / CAST(100 AS DOUBLE)
         AS rolled_back
FROM (SELECT topic, partition_id, CAST(floor(CAST(log_offset AS DOUBLE) / 100) AS BIGINT) AS batch_no, processed
      FROM results) b
GROUP BY topic, partition_id, batch_no""")


@query("rollback_compat", _rollback_sql(">="))
def _(fx):
    return RS.rollback_decision(O.with_batches(fx.results), ["topic", "partition_id", "batch_no"], 30, "compat")


@query("rollback_strict", _rollback_sql(">"))
def _(fx):
    return RS.rollback_decision(O.with_batches(fx.results), ["topic", "partition_id", "batch_no"], 30, "strict")


@query("size_check", sql("""SELECT COALESCE(s.topic, r.topic) AS topic, COALESCE(s.partition_id, r.partition_id) AS partition_id,
  COALESCE(s.batch_no, r.batch_no) AS batch_no, COALESCE(s.n, 0) AS n_sent, COALESCE(r.n, 0) AS n_results,
  COALESCE(s.n, 0) = COALESCE(r.n, 0) AND COALESCE(r.n, 0) > 0 AS ok
  FROM (SELECT topic, partition_id, log_offset // 100 AS batch_no, count(*) AS n FROM log GROUP BY 1, 2, 3) s
  FULL OUTER JOIN (SELECT topic, partition_id, log_offset // 100 AS batch_no, count(*) AS n FROM rr GROUP BY 1, 2, 3) r
  ON s.topic = r.topic AND s.partition_id = r.partition_id AND s.batch_no = r.batch_no""", _RETURNED))
def _(fx):
    keys = ["topic", "partition_id", "batch_no"]
    return RS.size_check(O.with_batches(fx.log), O.with_batches(_returned_results(fx)), keys)


@query("replay_summary", sql("""SELECT consumer_group, count(*) AS n_records,
  array_to_string(list_sort(list_distinct(list(origin_topic))), ',') AS topics FROM replayed GROUP BY 1"""))
def _(fx):
    return R.replay_summary(R.replay(fx.valid_requests, fx.log_all))


@query("latest_by_key", sql(f"""SELECT {FLAT} FROM (SELECT *, row_number() OVER (PARTITION BY topic, record_key
    ORDER BY ts_ms DESC, partition_id DESC, log_offset DESC) AS rk FROM log) WHERE rk = 1"""))
def _(fx):
    return flat(TB.materialize_latest(fx.log, ["topic", "key"]))


@query("replay_start_check", sql("""SELECT r.request_id,
  CASE WHEN r.dlq_indicator THEN r.topic_name || '.dlq' ELSE r.topic_name END AS topic, r.partition_id,
  r.start_offset, l.log_offset IS NOT NULL AS ok,
  CASE WHEN l.log_offset IS NULL THEN 'For the first batch , start offset and first read offset do not match, possible error in input start offset, abort' END AS error_detail
  FROM valid_requests r LEFT JOIN log_all l
  ON l.topic = CASE WHEN r.dlq_indicator THEN r.topic_name || '.dlq' ELSE r.topic_name END
  AND l.partition_id = r.partition_id AND l.log_offset = r.start_offset"""))
def _(fx):
    return R.replay_start_check(fx.valid_requests, fx.log_all)


@query("replay_progress", sql("""SELECT r.request_id, COALESCE(g.n, 0) AS n_records, g.last_offset,
  COALESCE(g.last_offset + 1, r.start_offset) AS next_offset,
  COALESCE(g.last_offset + 1, r.start_offset) >= r.end_offset AS finished
  FROM valid_requests r LEFT JOIN (SELECT request_id, count(*) AS n, max(log_offset) AS last_offset FROM replayed
  GROUP BY 1) g USING (request_id)"""))
def _(fx):
    return R.replay_progress(fx.valid_requests, R.replay(fx.valid_requests, fx.log_all))


@query("partition_bounds", sql("""SELECT topic, partition_id, min(log_offset) AS first_offset, max(log_offset) AS last_offset,
  count(*) AS n_records, max(log_offset) + 1 AS next_offset FROM log_all GROUP BY 1, 2"""))
def _(fx):
    return O.partition_bounds(fx.log_all)


@query("materialize_agg", sql("""SELECT topic, record_key AS key, count(*) AS n,
  CAST(sum(CAST(json_extract(record_value, '$.k') AS INTEGER)) AS BIGINT) AS sum_k FROM log GROUP BY 1, 2"""))
def _(fx):
    k = F.get_json_object("value", "$.k").cast("int")
    return TB.materialize_agg(fx.log, ["topic", "key"], {"n": F.count(F.lit(1)), "sum_k": F.sum(k).cast("bigint")})


@query("word_count", sql("""SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM documents) GROUP BY 1"""))
def _(fx):
    return TB.word_count(fx.table("documents"), "text")


def _window_sql(size_ms: int, slide_ms: int) -> str:
    n = size_ms // slide_ms
    return sql(f"""SELECT window_start_ms, window_start_ms + {size_ms} AS window_end_ms, topic, count(*) AS n,
  CAST(sum(CAST(json_extract(record_value, '$.k') AS INTEGER)) AS BIGINT) AS sum_k
  FROM (SELECT *, (ts_ms // {slide_ms} - i) * {slide_ms} AS window_start_ms FROM log, range(0, {n}) AS t(i))
  GROUP BY 1, 2, 3""")


def _window(fx, kind: str, size: str, slide: str | None = None) -> DataFrame:
    k = F.get_json_object("value", "$.k").cast("int")
    w = TB.materialize_window(fx.log, kind, size, ["topic"], {"n": F.count(F.lit(1)), "sum_k": F.sum(k).cast("bigint")},
                              slide=slide)
    return w.select(F.unix_millis("window_start").alias("window_start_ms"),
                    F.unix_millis("window_end").alias("window_end_ms"), "topic", "n", "sum_k")


@query("tumbling", _window_sql(86_400_000, 86_400_000))
def _(fx):
    return _window(fx, "tumbling", "1 day")


@query("hopping", _window_sql(86_400_000, 43_200_000))
def _(fx):
    return _window(fx, "hopping", "1 day", "12 hours")


@query("session", sql("""SELECT record_key AS key, topic, min(ts_us) // 1000 AS window_start_ms,
  (max(ts_us) + 7200000000) // 1000 AS window_end_ms, count(*) AS n
  FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts_us - prev > 7200000000 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY topic, record_key ORDER BY ts_us, log_offset ROWS UNBOUNDED PRECEDING) AS sid
        FROM (SELECT *, lag(ts_us) OVER (PARTITION BY topic, record_key ORDER BY ts_us, log_offset) AS prev
              FROM (SELECT l.*, epoch_us(e.ts) AS ts_us FROM log l JOIN events e USING (event_id))))
  GROUP BY record_key, topic, sid"""))
def _(fx):
    w = TB.materialize_window(fx.log, "session", "2 hours", ["key", "topic"], {"n": F.count(F.lit(1))})
    return w.select("key", "topic", F.unix_millis("window_start").alias("window_start_ms"),
                    F.unix_millis("window_end").alias("window_end_ms"), "n")


# =================================================================== order / limit / sets
@query("log_order", sql(f"SELECT {FLAT} FROM log"))
def _(fx):
    return flat(S.log_order(fx.log))


@query("first_n", sql(f"""SELECT {FLAT} FROM (SELECT *, row_number() OVER (PARTITION BY topic, partition_id
  ORDER BY log_offset) AS rk FROM log) WHERE rk <= 10"""))
def _(fx):
    return flat(S.first_n(fx.log, 10))


@query("with_batches", sql(f"SELECT {FLAT}, CAST(log_offset // 100 AS BIGINT) AS batch_no FROM log"))
def _(fx):
    return flat(O.with_batches(fx.log), "batch_no")


@query("union_topics", sql(f"SELECT {FLAT} FROM log_all WHERE topic IN ('ev.click', 'ev.view.dlq')"))
def _(fx):
    return flat(S.union_topics(S.subscribe(fx.log, "ev.click"), S.read_dead_letters(fx.dlq, "ev.view")))


# =================================================================== UDF surface, streaming-shaped batch ops
@query("process_batch", sql("""SELECT topic, partition_id, log_offset, result_key, correlation_id, traceability_id,
  processed, stacktrace FROM results"""))
def _(fx):
    src = fx.log.select("topic", "partition_id", "log_offset", "key", "value", "event_id")
    out = RS.process(src, RS.fixture_results)
    return out.select("topic", "partition_id", "log_offset", "result_key", "correlation_id", "traceability_id",
                      "processed", "stacktrace")


@query("dedupe", sql("""SELECT topic, record_key AS key, record_value AS value, log_offset, partition_id, ts_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY topic, record_key, record_value ORDER BY log_offset, partition_id) AS rk
  FROM log) WHERE rk = 1"""))
def _(fx):
    d = TB.dedupe(fx.log.select("topic", "key", "value", "log_offset", "partition_id", "timestamp"),
                  ["topic", "key", "value"], ["log_offset", "partition_id"])
    return d.select("topic", "key", "value", "log_offset", "partition_id", F.unix_millis("timestamp").alias("ts_ms"))


@query("rekey", sql("""SELECT 'view.by_k' AS topic, CAST(k % 4 AS INT) AS partition_id,
  CAST(row_number() OVER (PARTITION BY k % 4 ORDER BY ts_us, partition_id, log_offset) - 1 AS BIGINT) AS log_offset,
  CAST(k AS VARCHAR) AS key, partition_id AS source_partition, log_offset AS source_offset
  FROM (SELECT l.*, epoch_us(e.ts) AS ts_us, CAST(json_extract(l.record_value, '$.k') AS INTEGER) AS k
        FROM log l JOIN events e USING (event_id) WHERE l.topic = 'ev.view')"""))
def _(fx):
    k = F.get_json_object("value", "$.k").cast("int")
    r = TB.rekey(S.subscribe(fx.log, "ev.view"), k, 4, "view.by_k", partitioner=lambda key, n: F.pmod(key, F.lit(n)))
    return r.select("topic", "partition_id", "log_offset", "key", "source_partition", "source_offset")


@query("commit_table", sql("""SELECT consumer_group, topic, partition_id, arg_max(log_offset, committed_at) AS log_offset,
  max(committed_at) AS committed_at FROM (
    SELECT consumer_group, topic, partition_id, log_offset, committed_at FROM commits
    UNION ALL SELECT 'g1', topic, partition_id, max(log_offset), 1000000000 FROM (
      SELECT *, row_number() OVER (PARTITION BY topic, partition_id ORDER BY log_offset) AS rk FROM resumed)
    WHERE rk <= 100 GROUP BY topic, partition_id)
  GROUP BY 1, 2, 3""", _LATEST_G1))
def _(fx):
    fetched = S.fetch(S.resume(fx.log, fx.commits, "g1"), 100)
    return O.commit(fx.commits, O.commit_positions(fetched), "g1", 1000000000)


@query("post_dead_letters", sql(f"""SELECT topic || '.dlq' AS topic, partition_id, log_offset AS source_offset,
  result_key AS key, record_value AS value, CAST({NOW_MS} AS BIGINT) AS ts_ms,
  concat_ws(';', 'X-Correlation-Id=' || correlation_id, 'X-Traceability-Id=' || traceability_id,
            'X-Stack-Trace=' || stacktrace, 'X-Correlation-Id=' || hdr_correlation_id,
            'X-Traceability-Id=' || hdr_traceability_id, 'X-Event-Type=' || hdr_event_type) AS header_text
  FROM results WHERE processed = FALSE"""))
def _(fx):
    posted = fx.results.filter(F.col("processed") == F.lit(False))
    d = RS.posted_dead_letters(posted, NOW_MS)
    return d.select("topic", "partition_id", "source_offset", "key", "value", "ts_ms",
                    F.array_join(F.transform("header_list", lambda h: F.concat(h["key"], F.lit("="), h["value"])), ";")
                    .alias("header_text"))


@query("drain_dead_letters", sql(f"SELECT {FLAT} FROM dlq WHERE topic IN ('ev.click.dlq', 'ev.error.dlq')"))
def _(fx):
    from ..streaming.deadletters import drain_dead_letters
    rows, _commits = drain_dead_letters(fx.dlq, fx.commits, "g2", "ev.click, ev.error", committed_at=NOW_MS)
    return flat(rows)


@query("ingest_results", sql("""SELECT topic, partition_id, log_offset, result_key, correlation_id, traceability_id,
  processed, stacktrace FROM results"""))
def _(fx):
    """Response bodies (one JSON list per batch of 100, the record named ``record`` in even and
    ``consumerRecord`` in odd batches) parsed back into results."""
    b = O.with_batches(fx.results)
    rec = F.struct("topic", "key", "value", F.col("partition_id").alias("partition"),
                   F.col("log_offset").alias("offset"), "headers",
                   F.unix_millis("timestamp").alias("timestamp"))
    even = F.col("batch_no") % 2 == 0
    item = F.struct(F.when(even, rec).alias("record"), F.when(~even, rec).alias("consumerRecord"), "processed",
                    "stacktrace", F.col("correlation_id").alias("correlationId"),
                    F.col("traceability_id").alias("traceabilityId"), F.col("result_key").alias("key"))
    bodies = b.groupBy("topic", "partition_id", "batch_no").agg(F.to_json(F.collect_list(item)).alias("body"))
    r = C.results_from_json(bodies.select("body"))
    return r.select("topic", "partition_id", "log_offset", "result_key", "correlation_id", "traceability_id",
                    "processed", "stacktrace")


def _produce(fx):
    from ..operators.produce import produce
    b = O.with_batches(fx.log)
    rec = F.struct("log_offset", "key", "value",
                   F.when(F.col("event_id") % 10 == 0, F.lit(2)).alias("partition"),
                   F.col("headers").getItem("X-Correlation-Id").alias("correlationId"))
    req = b.groupBy("topic", "partition_id", "batch_no").agg(
        F.min("event_id").alias("request_id"),
        F.to_json(F.struct(F.sort_array(F.collect_list(rec)).alias("records"))).alias("request"))
    return produce(req, fx.log, F.concat(F.lit("produced."), F.col("topic")), 3,
                   partitioner=lambda k, n: F.pmod(k.cast("bigint"), F.lit(n)), authorization="Bearer t0k",
                   caller_id="svc-a", service_id=SERVICE_ID, now_ms=NOW_MS)


@query("produce_ack", sql("""SELECT request_id, seq, 'produced.' || topic AS topic, p AS partition_id,
  CAST(row_number() OVER (PARTITION BY topic, p ORDER BY request_id, seq) - 1 AS BIGINT) AS log_offset,
  n_headers, correlation_id
  FROM (SELECT l.*, min(event_id) OVER (PARTITION BY topic, partition_id, log_offset // 100) AS request_id,
               CAST(log_offset % 100 AS BIGINT) AS seq,
               CAST(CASE WHEN event_id % 10 = 0 THEN 2 ELSE CAST(record_key AS BIGINT) % 3 END AS INT) AS p,
               CAST((CASE WHEN hdr_correlation_id IS NULL THEN 0 ELSE 1 END) + 2 AS INT) AS n_headers,
               hdr_correlation_id AS correlation_id
        FROM log l)"""))
def _(fx):
    """Produce path: requests of the log's batches produced to ``produced.<topic>`` (3 partitions)."""
    out, _audit = _produce(fx)
    return out.select("request_id", "seq", "topic", "partition_id", "log_offset",
                      F.size("headers").alias("n_headers"),
                      F.col("headers").getItem("X-Correlation-Id").alias("correlation_id"))


# =================================================================== oracles of the streaming queries
_AUDIT_KV_BODY = """SELECT correlation_id AS key, json_object('id', id, 'service_id', service_id,
  'audit_type', audit_type, 'topic', topic, 'partition_id', partition_id, 'log_offset', log_offset,
  'correlation_id', correlation_id, 'traceability_id', traceability_id, 'key', key, 'audit_ts', audit_ts,
  'audit_status', audit_status, 'stacktrace', stacktrace)::VARCHAR AS value FROM a"""

_DLQ_RESULTS = """rd AS (SELECT *, record_key AS result_key,
         CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 2 = 0 THEN NULL
              ELSE 'rc-' || CAST(event_id AS VARCHAR) END AS correlation_id,
         CASE WHEN event_id % 2 = 1 THEN NULL ELSE 'rt-' || CAST(event_id % 100 AS VARCHAR) END AS traceability_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 4 <> 0 END AS processed,
         CASE WHEN event_id % 4 = 0 THEN 'error happened' ELSE NULL END AS stacktrace
  FROM dlq)"""

STREAM_ORACLES = {
    "agg_stream": sql("""SELECT topic, record_key AS key, count(*) AS n,
  CAST(sum(CAST(json_extract(record_value, '$.k') AS INTEGER)) AS BIGINT) AS sum_k FROM log GROUP BY 1, 2"""),
    "stream_static_join": sql("""SELECT CAST(l.record_key AS BIGINT) AS user_id, l.partition_id, l.log_offset,
  c.c_name, c.c_mktsegment FROM log l JOIN customer c ON c.c_custkey = CAST(l.record_key AS BIGINT)
  WHERE l.topic = 'ev.purchase'"""),
    "consume_stream": sql(_AUDIT_KV_BODY, "a AS (SELECT " + _AUDIT_COLS.format(svc=SERVICE_ID, typ="REACTIVE_CONSUMER")
                          + " FROM results)"),
    "replay_dead_letters": sql(_AUDIT_KV_BODY, _DLQ_RESULTS + ",\n  a AS (SELECT "
                               + _AUDIT_COLS.format(svc=SERVICE_ID, typ="REACTIVE_CONSUMER") + " FROM rd)"),
    "query_state": sql("SELECT topic, count(*) AS n FROM log GROUP BY topic"),
    "push_query": sql("""SELECT (ts_ms // 86400000) * 86400000 AS window_start_ms, topic, count(*) AS n
  FROM log GROUP BY 1, 2"""),
    "word_count_stream": """SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM documents) GROUP BY 1""",
    "consume_commits": sql("""SELECT 'g-stream' AS consumer_group, topic, partition_id, max(log_offset) AS log_offset
  FROM log GROUP BY ALL"""),
    "consume_dead_letters": sql("""SELECT l.topic || '.dlq' AS topic, l.partition_id, l.record_key, l.record_value
  FROM results l WHERE processed IS NOT TRUE"""),
    "dedupe_stream": sql("SELECT DISTINCT topic, record_key AS key, record_value AS value FROM log"),
    # a request whose failed share reaches 30 % is rolled back: it stays at its start and is not finished
    "replay_stream": sql("""SELECT r.topic_name, r.partition_id, r.start_offset, r.end_offset, r.consumer_group,
  r.dlq_indicator, g.n AS n_records, g.last_offset,
  CASE WHEN g.rolled_back THEN r.start_offset ELSE g.last_offset + 1 END AS next_offset,
  NOT g.rolled_back AND g.last_offset + 1 >= r.end_offset AS finished
  FROM valid_requests r JOIN (
    SELECT p.request_id, count(*) AS n, max(p.log_offset) AS last_offset,
           NOT any_value(COALESCE(p.streaming_app, FALSE))
             AND count(*) FILTER (l.event_id % 11 <> 0 AND l.event_id % 4 = 0) >= 30 * count(*) / 100.0 AS rolled_back
    FROM replayed p JOIN log_all l USING (topic, partition_id, log_offset) GROUP BY 1) g USING (request_id)
  WHERE EXISTS (SELECT 1 FROM log_all l
                WHERE l.topic = CASE WHEN r.dlq_indicator THEN r.topic_name || '.dlq' ELSE r.topic_name END
                  AND l.partition_id = r.partition_id AND l.log_offset = r.start_offset)"""),
    "dlq_headers": sql("""SELECT topic || '.dlq' AS topic, partition_id, log_offset AS source_offset,
  CAST(generate_subscripts(h, 1) - 1 AS INT) AS pos, unnest(h).key AS key, unnest(h).value AS value
  FROM (SELECT *, list_filter([
      {'key': 'X-Correlation-Id', 'value': correlation_id}, {'key': 'X-Traceability-Id', 'value': traceability_id},
      {'key': 'X-Stack-Trace', 'value': stacktrace}, {'key': 'X-Correlation-Id', 'value': hdr_correlation_id},
      {'key': 'X-Traceability-Id', 'value': hdr_traceability_id}, {'key': 'X-Event-Type', 'value': hdr_event_type}],
      lambda x: x.value IS NOT NULL) AS h FROM results WHERE processed = FALSE)"""),
}


# =================================================================== flagship
def _register_flagship():
    from .flagship import ORACLE, batch_outcomes
    QUERIES["batch_outcomes"] = batch_outcomes
    ORACLES["batch_outcomes"] = ORACLE


_register_flagship()


def _register_streaming():
    from .streaming_queries import ROWS_ONLY, latest_stream_q
    for name, fn in ROWS_ONLY.items():
        query(name, STREAM_ORACLES.get(name))(fn)
    query("latest_stream", sql("""SELECT topic, record_key AS key, ts_ms, partition_id, event_id, record_value AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY topic, record_key ORDER BY ts_ms DESC, partition_id DESC,
                                     event_id DESC) AS rk FROM log) WHERE rk = 1"""))(latest_stream_q)


_register_streaming()


# =================================================================== more variants
_LATEST_G1_ONLY = """lc AS (SELECT topic, partition_id, arg_max(log_offset, committed_at) AS committed
                      FROM commits WHERE consumer_group = 'g1' GROUP BY 1, 2)"""


@query("resume_latest", sql(f"""SELECT {FLAT} FROM log l JOIN lc USING (topic, partition_id)
  WHERE l.log_offset > lc.committed""", _LATEST_G1_ONLY))
def _(fx):
    """Resume with reset 'latest': uncommitted partitions give nothing until new records arrive."""
    return flat(S.resume(fx.log, fx.commits, "g1", "latest"))


@query("pull_sql", sql(f"SELECT {FLAT} FROM lp WHERE partition_id = 2 AND ts_ms >= 1705276800000", _LATEST_PURCHASE))
def _(fx):
    """Pull query as SQL text over a registered table (the stream-SQL endpoint's pull path)."""
    t = flat(_latest_purchase(fx))
    t.createOrReplaceTempView("latest_purchase")
    return TB.sql_query(fx.spark, "SELECT * FROM latest_purchase WHERE partition_id = 2 AND ts_ms >= 1705276800000")


@query("audit_lines", sql("""SELECT json_object('id', id, 'service_id', service_id,
  'audit_type', audit_type, 'topic', topic, 'partition_id', partition_id, 'log_offset', log_offset,
  'correlation_id', correlation_id, 'traceability_id', traceability_id, 'key', key, 'audit_ts', audit_ts,
  'audit_status', audit_status, 'stacktrace', stacktrace)::VARCHAR AS value FROM a""",
    "a AS (SELECT " + _AUDIT_COLS.format(svc=SERVICE_ID, typ="ACTIVE_CONSUMER") + " FROM results)"))
def _(fx):
    """Audit rows for the log-file target: one JSON line each."""
    return RS.audit_lines(RS.audit_from_results(fx.results, "ACTIVE_CONSUMER", SERVICE_ID))


@query("timestamp_positions", sql("""SELECT l.topic, l.partition_id, min(l.log_offset) AS log_offset FROM log l JOIN
  (VALUES ('ev.click', 0, 1705276800000), ('ev.view', 2, 1705752000000), ('ev.error', 1, 1893456000000))
  AS r(topic, partition_id, t) ON l.topic = r.topic AND l.partition_id = r.partition_id WHERE l.ts_ms >= r.t
  GROUP BY 1, 2"""))
def _(fx):
    """Seek positions by time: earliest offset at or after the time per listed partition."""
    return S.timestamp_positions(fx.log, SEEK_TIMES)


# =================================================================== segmented log
def _register_segments():
    from .segment_queries import SEGMENT_QUERIES
    oracles = {
        "segment_bounds": sql("""SELECT topic, partition_id, min(log_offset) AS first_offset, max(log_offset) AS last_offset,
  count(*) AS n_records, max(log_offset) + 1 AS next_offset FROM log GROUP BY 1, 2"""),
        "segment_fetch": ORACLES["fetch_bytes"],
        "segment_seek": ORACLES["seek_timestamps"],
        "segment_append": ORACLES["append_ack"],
        "stream_latest": sql(f"SELECT {FLAT} FROM log WHERE log_offset >= 100"),
        "stream_commits": ORACLES["resume_committed"],
    }
    for name, fn in SEGMENT_QUERIES.items():
        query(name, oracles[name])(fn)


_register_segments()


# =================================================================== reserved appends, stored tables, late and paired streams
_PARTED = """span AS (SELECT min(ts_ms) AS low, max(ts_ms) AS high FROM log),
parted AS (SELECT l.*, CAST(least((ts_ms - low) * 4 // (high - low + 1), 3) AS INT) AS part FROM log l, span)"""


def _register_stateful():
    from .stateful_queries import LOOKUP_USERS, STATEFUL_QUERIES
    latest = ORACLES["latest_stream"]
    users = ", ".join(f"'{u}'" for u in LOOKUP_USERS)
    oracles = {
        "append_reserved": sql("""SELECT seq, topic, pid AS partition_id,
  CASE WHEN pid >= 0 THEN CAST(nxt + row_number() OVER (PARTITION BY topic, pid ORDER BY seq % 8, seq) - 1 AS BIGINT) END AS log_offset,
  CASE WHEN pid < 0 THEN 'partition can not be negative' END AS error
  FROM (SELECT event_id AS seq, topic, CASE WHEN event_id % 8 = 4 AND event_id % 3 = 0 THEN -1 ELSE partition_id END AS pid
        FROM results WHERE processed = FALSE) r
  LEFT JOIN (SELECT topic, partition_id AS pid, max(log_offset) + 1 AS nxt FROM log GROUP BY 1, 2) b USING (topic, pid)"""),
        "table_store": latest,
        "table_lookup": f"SELECT * FROM ({latest}) WHERE key IN ({users})",
        # records that come too late are in no session
        "session_stream": sql("""SELECT record_key AS key, topic, min(ts_us) // 1000 AS window_start_ms,
  (max(ts_us) + 7200000000) // 1000 AS window_end_ms, count(*) AS n
  FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts_us - prev > 7200000000 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY topic, record_key ORDER BY ts_us, log_offset ROWS UNBOUNDED PRECEDING) AS sid
        FROM (SELECT *, lag(ts_us) OVER (PARTITION BY topic, record_key ORDER BY ts_us, log_offset) AS prev
              FROM (SELECT l.*, epoch_us(e.ts) AS ts_us FROM log l JOIN events e USING (event_id), span
                    WHERE NOT (event_id % 101 = 0 AND (ts_ms + CASE WHEN event_id % 11 = 0 THEN 7200000 ELSE 0 END - low) * 4
                                                      // (high - low + 1) < 2))))
  GROUP BY record_key, topic, sid""", _PARTED),
        "interval_join_stream": sql("""SELECT topic, partition_id, log_offset, processed, ts_ms AS sent_ms,
  ts_ms + (event_id % 5) * 3600000 AS result_ms FROM results WHERE event_id % 5 <= 2"""),
        "dedupe_within": sql("""SELECT event_id, topic, ts_ms FROM log
  UNION ALL SELECT event_id, topic, ts_ms + (high - low + 1) // 2 FROM parted, span WHERE event_id % 7 = 0 AND part < 2""", _PARTED),
        "post_failures": sql("""SELECT r.topic || '.dlq' AS topic, r.partition_id, r.log_offset AS source_offset,
  CAST(COALESCE(b.nxt, 0) + row_number() OVER (PARTITION BY r.topic, r.partition_id ORDER BY r.log_offset) - 1 AS BIGINT) AS log_offset,
  CAST(NULL AS VARCHAR) AS error
  FROM results r LEFT JOIN (SELECT topic, partition_id, max(log_offset) + 1 AS nxt FROM dlq GROUP BY 1, 2) b
    ON b.topic = r.topic || '.dlq' AND b.partition_id = r.partition_id WHERE r.processed = FALSE"""),
        "drain_resumed": sql(f"""SELECT {FLAT} FROM dlq d WHERE topic IN ('ev.click.dlq', 'ev.error.dlq') AND log_offset >
  COALESCE((SELECT max(c.log_offset) FROM dlq c WHERE c.topic = d.topic AND c.partition_id = d.partition_id AND c.log_offset % 50 = 49), -1)"""),
        "drain_commits": sql(f"""SELECT 'g5' AS consumer_group, topic, partition_id, arg_max(log_offset, committed_at) AS log_offset,
  max(committed_at) AS committed_at FROM (
    SELECT topic, partition_id, log_offset, log_offset AS committed_at FROM dlq WHERE log_offset % 50 = 49
    UNION ALL SELECT topic, partition_id, max(log_offset), {NOW_MS} FROM dlq d
    WHERE topic IN ('ev.click.dlq', 'ev.error.dlq') AND log_offset > COALESCE((SELECT max(c.log_offset) FROM dlq c
      WHERE c.topic = d.topic AND c.partition_id = d.partition_id AND c.log_offset % 50 = 49), -1) GROUP BY 1, 2)
  GROUP BY topic, partition_id"""),
    }
    for name, fn in STATEFUL_QUERIES.items():
        query(name, oracles[name])(fn)


_register_stateful()
