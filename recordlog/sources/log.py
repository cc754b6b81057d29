"""The log DataFrame and its readers.

A *log DataFrame* has the columns ``topic STRING, partition_id INT,
log_offset BIGINT, timestamp TIMESTAMP, key, value, headers
MAP<STRING,STRING>`` (key and value are STRING or BINARY), batch or
streaming.  Any further column is carried along by every operator.

``log_from_events`` maps the driver's ``events`` table onto that shape: one
topic per event type, four partitions by user, dense offsets in event order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CORRELATION_HEADER, TRACEABILITY_HEADER
from ..operators.numbering import chunk_of, number_within

EVENT_TYPE_HEADER = "X-Event-Type"
N_PARTITIONS = 4

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition_id", T.IntegerType()),
    T.StructField("log_offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
])

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utc_instant(ntz: str | Column) -> Column:
    """TIMESTAMP_NTZ read as UTC wall time -> TIMESTAMP, whatever the session time zone."""
    c = F.col(ntz) if isinstance(ntz, str) else ntz
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.timestamp_micros(micros)


def string_headers(*pairs: tuple[str, Column]) -> Column:
    """MAP of the given (name, value) pairs, entries with a null value left out."""
    m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    return F.map_filter(m, lambda k, v: v.isNotNull())


def events_as_records(events: DataFrame) -> DataFrame:
    """Row-wise mapping of ``events`` to log columns, without offsets (no shuffle)."""
    eid = F.col("event_id").cast("string")
    corr = (F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
            .when(F.col("event_id") % 13 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("hc-"), eid)))
    trace = (F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("ht-"), (F.col("event_id") % 100).cast("string"))))
    return events.select(
        F.concat(F.lit("ev."), F.col("event_type")).alias("topic"),
        (F.col("user_id") % N_PARTITIONS).cast("int").alias("partition_id"),
        utc_instant("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        string_headers((CORRELATION_HEADER, corr), (TRACEABILITY_HEADER, trace),
                       (EVENT_TYPE_HEADER, F.col("event_type"))).alias("headers"),
        F.col("event_id"),
    )


def log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture log: topic ``ev.<type>``, partition ``user_id % 4``, offsets dense by event_id."""
    recs = events_as_records(table(spark, sf_dir, "events"))
    return number_within(recs, ["topic", "partition_id"], ["event_id"], chunk_of("event_id"))


def flat(df: DataFrame, *extra: str) -> DataFrame:
    """Flat projection of a log DataFrame (epoch millis, no map) for comparison and export."""
    return df.select(
        "topic", "partition_id", "log_offset",
        F.unix_millis("timestamp").alias("ts_ms"),
        F.col("key").cast("string").alias("record_key"),
        F.col("value").cast("string").alias("record_value"),
        *extra,
    )


def write_log(df: DataFrame, path: str, mode: str = "errorifexists", segment_rows: int | None = None,
              num_files: int | None = None) -> None:
    """Store a log like topic segments: one folder per topic; rows of one offset segment
    (``segment_rows`` consecutive offsets of a partition) go to one task and are
    written sorted by offset.  Topic filters then prune folders and offset predicates
    skip row groups by their min/max statistics.  Hash partitioning on the segment
    needs no sampling pass and spreads a hot partition over many tasks."""
    from ..config import OFFSET_CHUNK
    from ..operators.numbering import floor_div
    seg = floor_div(F.col("log_offset"), segment_rows or OFFSET_CHUNK)
    cols = [F.col("topic"), F.col("partition_id"), seg]
    d = df.repartition(num_files, *cols) if num_files else df.repartition(*cols)
    d.sortWithinPartitions("topic", "partition_id", "log_offset").write.mode(mode).partitionBy("topic").parquet(path)


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored log table (e.g. written partitioned by topic, so topic filters prune folders)."""
    return spark.read.format(fmt).load(path)


def stream_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a streaming source (file source, one parquet file)."""
    r = (spark.readStream.schema(EVENTS_SCHEMA)
         .option("pathGlobFilter", "events.parquet"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)


def stream_log(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA,
               max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A stored log folder as a streaming log DataFrame (bounded micro-batches)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return r.parquet(path)


def kafka_options(bootstrap: str, topics: str | None = None, pattern: str | None = None,
                  assign: dict[str, list[int]] | None = None, starting: dict | str | None = None,
                  starting_by_timestamp: dict | None = None, max_offsets_per_trigger: int | None = None) -> dict:
    """Options for ``spark.read[Stream].format("kafka")`` (the jar is not part of this library)."""
    import json
    opts = {"kafka.bootstrap.servers": bootstrap}
    if topics is not None:
        opts["subscribe"] = ",".join(t.strip() for t in topics.split(","))
    if pattern is not None:
        opts["subscribePattern"] = pattern
    if assign is not None:
        opts["assign"] = json.dumps(assign)
    if starting is not None:
        opts["startingOffsets"] = starting if isinstance(starting, str) else json.dumps(starting)
    if starting_by_timestamp is not None:
        opts["startingOffsetsByTimestamp"] = json.dumps(starting_by_timestamp)
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_kafka(spark: SparkSession, options: dict, streaming: bool = False) -> DataFrame:
    """A Kafka topic as a log DataFrame; needs the spark-sql-kafka package on the class path."""
    r = spark.readStream if streaming else spark.read
    try:
        return from_kafka(r.format("kafka").options(**options).load())
    except Exception as e:  # noqa: BLE001
        if "kafka" in str(e).lower() and ("find data source" in str(e).lower() or "DATA_SOURCE_NOT_FOUND" in str(e)):
            raise RuntimeError("the Kafka source is not on the class path (spark-sql-kafka package)") from e
        raise


def from_kafka(df: DataFrame) -> DataFrame:
    """Kafka source rows -> log DataFrame (renames; headers array -> map, the last value of a
    repeated header wins, as a map lookup of the last header would)."""
    arr = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    last = F.filter(arr, lambda h, i: ~F.exists(F.slice(arr, i + 2, F.greatest(F.size(arr), F.lit(1))),
                                                 lambda x: x["key"] == h["key"]))
    hdr = F.map_from_entries(F.transform(
        last, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))))
    return df.select(
        "topic", F.col("partition").alias("partition_id"), F.col("offset").alias("log_offset"),
        "timestamp", "key", "value", hdr.alias("headers"))
