"""The produce path: requests in, records appended with offsets, acknowledgements and
PRODUCER audit rows out."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CORRELATION_HEADER, TRACEABILITY_HEADER
from ..functions.headers import inject_headers
from ..sources.codec import ingest_requests
from .numbering import chunk_of, number_within
from .results import audit_id

TP = ["topic", "partition_id"]


def produce(requests: DataFrame, log: DataFrame, topic: str | Column, n_partitions: int,
            partitioner: Callable[[Column, int], Column] | None = None, authorization: str | None = None,
            caller_id: str | None = None, request_col: str = "request", id_col: str = "request_id",
            service_id: str = "recordlog", now_ms: int | Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Append the records of produce requests to ``topic``.

    A record goes to its own ``partition`` when given, else to
    ``partitioner(key, n_partitions)`` (default ``pmod(hash(key), n)``).  Offsets
    continue each partition of ``log`` in (request id, position) order -- chunked
    numbering, so one hot partition is still ranked in parallel.  Trace ids of a
    record become headers, then Authorization / caller id are added.

    Returns ``(records, audit)``: the appended records (their ``request_id, seq,
    topic, partition_id, log_offset`` part is the acknowledgement) and one PRODUCER
    SUCCESS audit row per record."""
    recs = ingest_requests(requests, request_col)
    part = partitioner(F.col("key"), n_partitions) if partitioner else F.pmod(F.hash("key"), F.lit(n_partitions))
    t = topic if isinstance(topic, Column) else F.lit(topic)
    trace = F.map_filter(F.create_map(F.lit(CORRELATION_HEADER), F.col("correlationId"),
                                      F.lit(TRACEABILITY_HEADER), F.col("traceabilityId")),
                         lambda k, v: v.isNotNull())
    hdr = F.map_concat(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>")), trace)
    rows = recs.select(
        F.col(id_col).alias("request_id"), "seq", t.alias("topic"),
        F.coalesce(F.col("partition"), part).cast("int").alias("partition_id"),
        "key", "value", "key_format", "value_format",
        inject_headers(hdr, authorization, caller_id).alias("headers"))
    base = log.groupBy(*TP).agg((F.max("log_offset") + 1).alias("base"))
    out = number_within(rows, TP, ["request_id", "seq"], chunk_of("request_id"), base=base)
    now = now_ms if isinstance(now_ms, Column) else (
        F.lit(now_ms).cast("bigint") if now_ms is not None else F.unix_millis(F.current_timestamp()))
    st = F.lit("SUCCESS")
    audit = out.select(
        audit_id(service_id, "PRODUCER", st, F.col("topic"), F.col("partition_id"), F.col("log_offset")).alias("id"),
        F.lit(service_id).alias("service_id"), F.lit("PRODUCER").alias("audit_type"), "topic", "partition_id",
        "log_offset", F.col("headers").getItem(CORRELATION_HEADER).alias("correlation_id"),
        F.col("headers").getItem(TRACEABILITY_HEADER).alias("traceability_id"), F.col("key"),
        now.alias("audit_ts"), st.alias("audit_status"), F.lit(None).cast("string").alias("stacktrace"))
    return out, audit
