"""Test fixtures derived from the driver tables, in Spark and as DuckDB CTEs.

The Spark side uses the library itself (``log_from_events`` etc.); the SQL side
states the same data independently so the two can be compared.  See FIXTURES.md.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import chunk_of, number_within
from ..operators.replay import REQUEST_DDL, valid_replays
from ..operators.results import dead_letter_log, results_from_log
from ..operators.select import union_topics
from ..sources.log import log_from_events, table, write_log

NOW_MS = 1735689600000  # fixed "now" (2025-01-01T00:00:00Z) so outputs are reproducible
REPLAY_TOPICS = "ev.error,ev.click,ev.view,ev.purchase,ev.signup"
SERVICE_ID = "svc"
# documents of one segment of the document log, or of one file of a stream of documents: these rows hold whole texts
DOC_SEGMENT = 1 << 13

# replay requests of the fixture: valid rows and one row per validation rule
FIXED_REQUESTS = [
    (1, "ev.error", 0, 10, 60, "g1", False, False, None),
    (2, "ev.click", 3, 0, 1000000, "g1", False, True, "copy.click"),
    (3, "ev.view", 1, 5, 6, "g2", True, False, None),
    (4, "", 0, 0, 10, "g1", False, False, None),
    (5, "nope", 0, 0, 10, "g1", False, False, None),
    (6, "ev.view", -1, 0, 10, "g1", False, False, None),
    (7, "ev.view", 0, -1, 10, "g1", False, False, None),
    (8, "ev.view", 0, 0, -1, "g1", False, False, None),
    (9, "ev.view", 0, 9, 3, "g1", False, False, None),
    (10, "ev.view", 0, 3, 3, "g1", False, False, None),
    (11, "ev.view", 0, 0, 10, "", False, False, None),
    (12, "ev.view", 0, 0, 10, "g1", False, True, None),
    (13, "ev.purchase", 2, 900000, 900010, "g3", False, False, None),
]


_STORED: dict[tuple, str] = {}


def stored(spark: SparkSession, key: tuple, build, segment_rows: int | None = None) -> DataFrame:
    """A derived log written once per session as parquet partitioned by topic in the shared
    checkpoint folder, then read back: later plans scan it with partition pruning, column
    pruning and pushed filters instead of re-deriving it, and its lineage is cut.
    ``segment_rows`` as in ``write_log``."""
    from ..session import scratch_path
    k = (spark.sparkContext.applicationId, *key)
    path = _STORED.get(k)
    df = None
    if path is None:
        df = build()
        path = scratch_path(spark, "-".join(str(x) for x in key[-1:]))
        write_log(df, path, segment_rows=segment_rows)
        _STORED[k] = path
        cols = df.columns
    else:
        cols = None
    got = spark.read.option("basePath", path).parquet(path)
    order = cols or [c for c in _COLUMN_ORDER.get(key[-1], []) if c in got.columns] or got.columns
    rest = [c for c in got.columns if c not in order]
    return got.select(*order, *rest)


_COLUMN_ORDER = {
    "log": ["topic", "partition_id", "log_offset", "timestamp", "key", "value", "headers", "event_id"],
    "dlq": ["topic", "partition_id", "log_offset", "timestamp", "key", "value", "headers", "origin_topic",
            "source_offset", "event_id"],
    "doc_log": ["topic", "partition_id", "log_offset", "timestamp", "key", "value", "headers", "doc_id"],
}


class Fixtures:
    """Lazily built fixture DataFrames of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def log(self) -> DataFrame:
        return stored(self.spark, (self.sf_dir, "log"), lambda: log_from_events(self.spark, self.sf_dir))

    @cached_property
    def results(self) -> DataFrame:
        return results_from_log(self.log)

    @cached_property
    def dlq(self) -> DataFrame:
        return stored(self.spark, (self.sf_dir, "dlq"), lambda: dead_letter_log(self.results))

    @cached_property
    def log_all(self) -> DataFrame:
        return union_topics(self.log, self.dlq)

    @cached_property
    def commits(self) -> DataFrame:
        return self.log.filter((F.col("log_offset") % 50 == 49) & (F.col("partition_id") != 3)).select(
            F.lit("g1").alias("consumer_group"), "topic", "partition_id", "log_offset",
            F.col("event_id").alias("committed_at"))

    @cached_property
    def requests(self) -> DataFrame:
        fixed = self.spark.createDataFrame(FIXED_REQUESTS, REQUEST_DDL)
        derived = self.commits.select(
            (F.lit(1000000) + F.col("committed_at")).alias("request_id"), F.col("topic").alias("topic_name"),
            "partition_id", (F.col("log_offset") - 49).alias("start_offset"),
            (F.col("log_offset") + 1).alias("end_offset"), F.lit("g4").alias("consumer_group"),
            (F.col("log_offset") % 200 == 199).alias("dlq_indicator"), F.lit(False).alias("streaming_app"),
            F.lit(None).cast("string").alias("destination_topic"))
        return fixed.unionByName(derived)

    @cached_property
    def valid_requests(self) -> DataFrame:
        return valid_replays(self.requests, REPLAY_TOPICS)

    @cached_property
    def doc_log(self) -> DataFrame:
        """``documents`` as a log: topic ``docs.<lang>``, one partition, offsets by doc_id.  Ranked and stored in
        segments of ``DOC_SEGMENT`` documents, so that a task reads so many texts of a topic at once however large it is."""
        d = self.table("documents").select(
            F.concat(F.lit("docs."), F.col("lang")).alias("topic"), F.lit(0).alias("partition_id"),
            F.timestamp_millis(F.lit(0)).alias("timestamp"), F.col("doc_id").cast("string").alias("key"),
            F.col("text").alias("value"), F.create_map().cast("map<string,string>").alias("headers"),
            F.col("doc_id"))
        return stored(self.spark, (self.sf_dir, "doc_log"),
                      lambda: number_within(d, ["topic", "partition_id"], ["doc_id"], chunk_of("doc_id", DOC_SEGMENT)),
                      segment_rows=DOC_SEGMENT)


# ------------------------------------------------------------------ DuckDB side
SQL_FIXTURES = r"""
WITH log AS (
  SELECT 'ev.' || event_type AS topic,
         CAST(user_id % 4 AS INT) AS partition_id,
         CAST(row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1 AS BIGINT) AS log_offset,
         epoch_us(ts) // 1000 AS ts_ms,
         CAST(user_id AS VARCHAR) AS record_key,
         props AS record_value,
         event_id,
         CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN ''
              ELSE 'hc-' || CAST(event_id AS VARCHAR) END AS hdr_correlation_id,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'ht-' || CAST(event_id % 100 AS VARCHAR) END AS hdr_traceability_id,
         event_type AS hdr_event_type,
         CAST(NULL AS VARCHAR) AS hdr_stack_trace
  FROM events
),
results AS (
  SELECT *, record_key AS result_key,
         CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 2 = 0 THEN NULL
              ELSE 'rc-' || CAST(event_id AS VARCHAR) END AS correlation_id,
         CASE WHEN event_id % 2 = 1 THEN NULL ELSE 'rt-' || CAST(event_id % 100 AS VARCHAR) END AS traceability_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 4 <> 0 END AS processed,
         CASE WHEN event_id % 4 = 0 THEN 'error happened' ELSE NULL END AS stacktrace
  FROM log
),
dlq AS (
  SELECT CASE WHEN contains(topic, '.dlq') THEN topic ELSE topic || '.dlq' END AS topic,
         partition_id,
         CAST(row_number() OVER (PARTITION BY topic, partition_id ORDER BY log_offset) - 1 AS BIGINT) AS log_offset,
         ts_ms, record_key, record_value, event_id,
         COALESCE(NULLIF(correlation_id, ''), NULLIF(hdr_correlation_id, '')) AS hdr_correlation_id,
         COALESCE(NULLIF(traceability_id, ''), NULLIF(hdr_traceability_id, '')) AS hdr_traceability_id,
         hdr_event_type, stacktrace AS hdr_stack_trace
  FROM results WHERE processed IS NOT TRUE
),
log_all AS (SELECT * FROM log UNION ALL SELECT * FROM dlq),
commits AS (
  SELECT 'g1' AS consumer_group, topic, partition_id, log_offset, event_id AS committed_at
  FROM log WHERE log_offset % 50 = 49 AND partition_id <> 3
),
replay_requests AS (
  SELECT CAST(request_id AS BIGINT) AS request_id, topic_name, CAST(partition_id AS INT) AS partition_id,
         CAST(start_offset AS BIGINT) AS start_offset, CAST(end_offset AS BIGINT) AS end_offset,
         consumer_group, dlq_indicator, streaming_app, destination_topic
  FROM (VALUES
    (1, 'ev.error',  0, 10,  60,      'g1', FALSE, FALSE, CAST(NULL AS VARCHAR)),
    (2, 'ev.click',  3, 0,   1000000, 'g1', FALSE, TRUE,  'copy.click'),
    (3, 'ev.view',   1, 5,   6,       'g2', TRUE,  FALSE, NULL),
    (4, '',          0, 0,   10,      'g1', FALSE, FALSE, NULL),
    (5, 'nope',      0, 0,   10,      'g1', FALSE, FALSE, NULL),
    (6, 'ev.view',  -1, 0,   10,      'g1', FALSE, FALSE, NULL),
    (7, 'ev.view',   0, -1,  10,      'g1', FALSE, FALSE, NULL),
    (8, 'ev.view',   0, 0,   -1,      'g1', FALSE, FALSE, NULL),
    (9, 'ev.view',   0, 9,   3,       'g1', FALSE, FALSE, NULL),
    (10, 'ev.view',  0, 3,   3,       'g1', FALSE, FALSE, NULL),
    (11, 'ev.view',  0, 0,   10,      '',   FALSE, FALSE, NULL),
    (12, 'ev.view',  0, 0,   10,      'g1', FALSE, TRUE,  NULL),
    (13, 'ev.purchase', 2, 900000, 900010, 'g3', FALSE, FALSE, NULL)
  ) AS t(request_id, topic_name, partition_id, start_offset, end_offset, consumer_group, dlq_indicator,
         streaming_app, destination_topic)
  UNION ALL
  SELECT 1000000 + committed_at, topic, partition_id, log_offset - 49, log_offset + 1, 'g4',
         log_offset % 200 = 199, FALSE, NULL
  FROM commits
),
validated AS (
  SELECT *, CASE
      WHEN COALESCE(topic_name, '') = '' THEN 'topic name can not be empty'
      WHEN topic_name NOT IN ('ev.error', 'ev.click', 'ev.view', 'ev.purchase', 'ev.signup')
        THEN 'provided topic in request must match one of the topics in consuming topic list'
      WHEN partition_id < 0 THEN 'partition can not be negative'
      WHEN start_offset < 0 THEN 'replay start offset can not be negative'
      WHEN end_offset < 0 THEN 'replay end offset can not be negative'
      WHEN start_offset > end_offset THEN 'replay end offset can not be less than start offset'
      WHEN start_offset = end_offset THEN 'replay end offset can not be equal to start offset'
      WHEN COALESCE(consumer_group, '') = '' THEN 'replay consumer group can not be empty'
      WHEN COALESCE(streaming_app, FALSE) AND COALESCE(destination_topic, '') = ''
        THEN 'Destination topic can not be empty for a streaming app'
    END AS error_detail
  FROM replay_requests
),
valid_requests AS (SELECT * EXCLUDE (error_detail) FROM validated WHERE error_detail IS NULL),
replayed AS (
  SELECT r.request_id, r.consumer_group, r.topic_name AS origin_topic, l.topic, l.partition_id, l.log_offset,
         l.record_key, l.record_value, l.hdr_correlation_id, l.hdr_traceability_id,
         r.start_offset, r.end_offset, r.streaming_app, r.destination_topic
  FROM valid_requests r JOIN log_all l
    ON l.topic = CASE WHEN r.dlq_indicator THEN r.topic_name || '.dlq' ELSE r.topic_name END
   AND l.partition_id = r.partition_id AND l.log_offset >= r.start_offset AND l.log_offset < r.end_offset
)
"""


def sql(body: str, ctes: str = "") -> str:
    """Oracle text: the fixture CTEs, optional extra CTEs (``name AS (...)`` list), then ``body``."""
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"{SQL_FIXTURES}{extra}\n{body}"
