"""Per-record processing results: the user function, audit rows, rollback decision,
dead letters, size checks and reconciliation.

A *results DataFrame* is a log DataFrame (the record) plus ``result_key,
correlation_id, traceability_id, processed, stacktrace`` -- one row per
record sent to the function.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DLQ_EXT, ROLLBACK_THRESHOLD_PCT
from ..functions.headers import (audit_correlation_id, audit_traceability_id, carry_timestamp, dlq_correlation_id,
                                 dlq_headers, dlq_traceability_id)
from ..functions.names import dlq_topic
from .numbering import chunk_of, number_within

TP = ["topic", "partition_id"]
KEY = ["topic", "partition_id", "log_offset"]
RESULT_DDL = ("result_key string, correlation_id string, traceability_id string, "
              "processed boolean, stacktrace string")
RESULT_SCHEMA = T.StructType([
    T.StructField("result_key", T.StringType()), T.StructField("correlation_id", T.StringType()),
    T.StructField("traceability_id", T.StringType()), T.StructField("processed", T.BooleanType()),
    T.StructField("stacktrace", T.StringType())])


# ----------------------------------------------------------------- UDF-1
def process(df: DataFrame, fn: Callable, result_ddl: str | T.StructType = RESULT_SCHEMA,
            input_cols: Sequence[str] | None = None, match: str = "position",
            batch_rows: int | None = None, isolate: str | None = None) -> DataFrame:
    """Run ``fn(pandas.DataFrame) -> pandas.DataFrame`` over Arrow batches of records.

    ``fn`` gets a batch of ``input_cols`` (default: all columns) and returns one
    result per record with the columns of ``result_ddl``: in input order
    (``match='position'``) or in any order carrying ``topic, partition_id,
    log_offset`` (``match='key'``, merged inside the batch -- no shuffle).  The
    records are passed through, so the output is a results DataFrame.  A batch
    whose results do not match its records one to one raises (size check).
    ``batch_rows`` caps the records per call (e.g. the poll size of 100): each Arrow
    batch is cut into such slices inside the task.  ``isolate`` names a column whose values
    (e.g. requests) never share a call: an error that ``fn`` raises, or results that do not
    match, become the text in ``error`` of that value's records (else null), which then carry
    no result; errors of the job itself are raised as ever.
    """
    import pandas as pd
    src = df.select(*input_cols) if input_cols else df
    res_schema = result_ddl if isinstance(result_ddl, T.StructType) else T._parse_datatype_string(result_ddl)
    names = [f.name for f in res_schema.fields]
    error = [T.StructField("error", T.StringType())] if isolate else []
    out_schema = T.StructType(src.schema.fields + res_schema.fields + error)

    if match not in ("position", "key"):
        raise ValueError("match must be 'position' or 'key'")

    def slices(batches):
        for pdf in batches:
            alone = [pdf] if not isolate else [g.reset_index(drop=True) for _, g in pdf.groupby(isolate, sort=False, dropna=False)]
            for part in alone:
                step = batch_rows or max(1, len(part))
                for i in range(0, len(part), step):
                    yield part if step >= len(part) else part.iloc[i:i + step].reset_index(drop=True)

    def called(pdf):
        res = fn(pdf)
        if len(res) != len(pdf):
            raise RuntimeError(f"The response size {len(res)} does not match the record size {len(pdf)}")
        if match == "key":
            merged = pdf.merge(res[KEY + names], on=KEY, how="left", validate="one_to_one", indicator=True)
            if (merged["_merge"] != "both").any():
                raise RuntimeError("results do not match the records of the batch by key")
            return merged.drop(columns="_merge")
        return pd.concat([pdf.reset_index(drop=True), res[names].reset_index(drop=True)], axis=1)

    def run(batches):
        for pdf in slices(batches):
            if not isolate:
                yield called(pdf)
                continue
            try:
                yield called(pdf).assign(error=None)
            except Exception as e:  # noqa: BLE001  the function's own error, kept with the records it was called for
                text = f"{type(e).__name__}: {e}"
                yield pdf.assign(**dict.fromkeys(names), error=text if len(text) <= 4000 else f"{text[:1000]} ... {text[-3000:]}")

    return src.mapInPandas(run, out_schema)


def fixture_results(pdf):
    """Deterministic stand-in for a backend: the result rules of the test fixture."""
    import numpy as np
    import pandas as pd
    eid = pdf["event_id"].astype("int64")
    ids = eid.astype(str)
    corr = np.where(eid % 17 == 0, "", np.where(eid % 2 == 0, None, "rc-" + ids))
    trace = np.where(eid % 2 == 1, None, "rt-" + (eid % 100).astype(str))
    processed = pd.array(np.where(eid % 11 == 0, None, (eid % 4 != 0)), dtype="boolean")
    stack = np.where(eid % 4 == 0, "error happened", None)
    return pd.DataFrame({"result_key": pdf["key"].values, "correlation_id": corr, "traceability_id": trace,
                         "processed": processed, "stacktrace": stack})


def results_from_log(log: DataFrame) -> DataFrame:
    """The same rules as ``fixture_results`` in column expressions (JVM only)."""
    e = F.col("event_id")
    return log.select(
        "*",
        F.col("key").cast("string").alias("result_key"),
        F.when(e % 17 == 0, F.lit("")).when(e % 2 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("rc-"), e.cast("string"))).alias("correlation_id"),
        F.when(e % 2 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("rt-"), (e % 100).cast("string"))).alias("traceability_id"),
        F.when(e % 11 == 0, F.lit(None).cast("boolean")).otherwise(e % 4 != 0).alias("processed"),
        F.when(e % 4 == 0, F.lit("error happened")).alias("stacktrace"),
    )


# ----------------------------------------------------------------- filters and decisions
def failed_for_dlq(df: DataFrame, enabled: bool = True, last_retry: bool = False) -> DataFrame:
    """Results that go to the dead-letter topic: dead letters enabled, not processed
    (a missing flag counts as not processed) and not the last retry."""
    if not enabled or last_retry:
        return df.limit(0)
    return df.filter(~F.coalesce(F.col("processed"), F.lit(False)))


def _check_pct(pct: float) -> None:
    if pct < 0 or pct > 100:
        raise ValueError(f"rollback threshold must be within 0..100, got {pct}")


def rollback_decision(df: DataFrame, batch_cols: Sequence[str], threshold: float = ROLLBACK_THRESHOLD_PCT,
                      mode: str = "compat") -> DataFrame:
    """Per batch: size, failed (explicit ``processed = false`` only) and whether it rolls back.

    ``compat``: ``failed >= threshold * size / 100`` (so 0 % rolls back every batch);
    ``strict``: ``failed > threshold * size / 100``."""
    g = df.groupBy(*batch_cols).agg(*batch_counts())
    return g.withColumn("rolled_back", rollback_flag(threshold, mode))


def batch_counts() -> list[Column]:
    """Aggregates behind the rollback rule: ``batch_size`` and ``failed``."""
    return [F.count(F.lit(1)).alias("batch_size"),
            F.sum(F.when(F.col("processed") == F.lit(False), 1).otherwise(0)).cast("bigint").alias("failed")]


def rollback_flag(threshold: float = ROLLBACK_THRESHOLD_PCT, mode: str = "compat",
                  failed: str = "failed", size: str = "batch_size") -> Column:
    """The rollback rule on aggregated counts."""
    _check_pct(threshold)
    if mode not in ("compat", "strict"):
        raise ValueError("mode must be 'compat' or 'strict'")
    limit = F.lit(float(threshold)) * F.col(size) / F.lit(100.0)
    return F.col(failed) >= limit if mode == "compat" else F.col(failed) > limit


def size_check(sent: DataFrame, results: DataFrame, batch_cols: Sequence[str]) -> DataFrame:
    """Per batch: records sent, results received, and ok = equal and non-zero."""
    s = sent.groupBy(*batch_cols).agg(F.count(F.lit(1)).alias("n_sent"))
    r = results.groupBy(*batch_cols).agg(F.count(F.lit(1)).alias("n_results"))
    j = s.join(r, list(batch_cols), "full_outer")
    j = j.select(*batch_cols, F.coalesce("n_sent", F.lit(0)).alias("n_sent"),
                 F.coalesce("n_results", F.lit(0)).alias("n_results"))
    return j.withColumn("ok", (F.col("n_sent") == F.col("n_results")) & (F.col("n_results") > 0))


def reconcile(sent: DataFrame, results: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Match results to sent records by identity, not by count.

    One row per key: ``matched`` (sent, >= 1 result), ``missing_result`` (sent, no
    result) or ``unexpected_result`` (result, never sent); ``n_unexpected`` counts
    the results beyond the first (duplicates) or all of them when never sent."""
    k = list(key)
    # both sides as one table with partial aggregation: one exchange, and null keys meet null keys
    rows = sent.select(*k, F.lit(1).alias("_s"), F.lit(0).alias("_r")).unionByName(
        results.select(*k, F.lit(0).alias("_s"), F.lit(1).alias("_r")))
    j = rows.groupBy(*k).agg(F.max("_s").alias("_s"), F.sum("_r").alias("_n"))
    was_sent, n = F.col("_s") == 1, F.col("_n")
    status = (F.when(was_sent & (n > 0), "matched").when(was_sent, "missing_result")
              .otherwise("unexpected_result"))
    return j.select(*k, status.alias("status"),
                    F.when(was_sent, F.greatest(n - 1, F.lit(0))).otherwise(n).cast("bigint").alias("n_unexpected"))


# ----------------------------------------------------------------- audit rows
def audit_id(service_id: str, audit_type: str | Column, status: Column, *parts: Column) -> Column:
    """Deterministic audit id (SHA-256 of its identifying fields), so retries do not duplicate."""
    at = audit_type if isinstance(audit_type, Column) else F.lit(audit_type)
    return F.sha2(F.concat_ws("|", F.lit(service_id), at, *[p.cast("string") for p in parts], status), 256)


def audit_from_results(df: DataFrame, audit_type: str = "REACTIVE_CONSUMER", service_id: str = "recordlog",
                       keep_stacktrace: bool = False) -> DataFrame:
    """One audit row per result; SUCCESS when processed, else FAILURE.  Trace ids: the
    record header when not null, else the result field.  The stack trace is dropped
    unless ``keep_stacktrace``."""
    status = F.when(F.coalesce(F.col("processed"), F.lit(False)), "SUCCESS").otherwise("FAILURE")
    ts = F.col("result_ts") if "result_ts" in df.columns else F.unix_millis("timestamp")
    return df.select(
        audit_id(service_id, audit_type, status, F.col("topic"), F.col("partition_id"), F.col("log_offset")).alias("id"),
        F.lit(service_id).alias("service_id"), F.lit(audit_type).alias("audit_type"),
        "topic", "partition_id", "log_offset",
        audit_correlation_id().alias("correlation_id"), audit_traceability_id().alias("traceability_id"),
        F.col("result_key").alias("key"), ts.alias("audit_ts"), status.alias("audit_status"),
        (F.col("stacktrace") if keep_stacktrace else F.lit(None).cast("string")).alias("stacktrace"))


def audit_from_write_error(df: DataFrame, error: str | Column, now_ms: int | Column, ext: str = DLQ_EXT,
                           service_id: str = "recordlog") -> DataFrame:
    """Audit row for a dead letter that could not be written: PRODUCER / FAILURE on the
    dead-letter topic, partition and offset 0, the error text as stack trace."""
    err = F.col(error) if isinstance(error, str) else error
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    status = F.lit("FAILURE")
    topic = dlq_topic("topic", ext)
    return df.select(
        audit_id(service_id, "PRODUCER", status, topic, F.col("partition_id"), F.col("log_offset")).alias("id"),
        F.lit(service_id).alias("service_id"), F.lit("PRODUCER").alias("audit_type"),
        topic.alias("topic"), F.lit(0).alias("partition_id"), F.lit(0).cast("bigint").alias("log_offset"),
        F.col("correlation_id"), F.col("traceability_id"), F.col("result_key").alias("key"),
        now.alias("audit_ts"), status.alias("audit_status"), err.alias("stacktrace"))


def audit_from_replay(control: DataFrame, status: str = "SUCCESS", reason: str | Column = "",
                      now_ms: int | Column | None = None, service_id: str = "recordlog") -> DataFrame:
    """Audit row of a replay request as read from the control topic: STREAMING_CONSUMER,
    position of the control record, trace ids from its headers, ``reason`` as stack trace."""
    from ..config import CORRELATION_HEADER, TRACEABILITY_HEADER
    if status not in ("SUCCESS", "FAILURE"):
        raise ValueError("status must be SUCCESS or FAILURE")
    now = now_ms if isinstance(now_ms, Column) else (
        F.lit(now_ms).cast("bigint") if now_ms is not None else F.unix_millis(F.current_timestamp()))
    st = F.lit(status)
    return control.select(
        audit_id(service_id, "STREAMING_CONSUMER", st, F.col("topic"), F.col("partition_id"),
                 F.col("log_offset")).alias("id"),
        F.lit(service_id).alias("service_id"), F.lit("STREAMING_CONSUMER").alias("audit_type"),
        "topic", "partition_id", "log_offset",
        F.col("headers").getItem(CORRELATION_HEADER).alias("correlation_id"),
        F.col("headers").getItem(TRACEABILITY_HEADER).alias("traceability_id"),
        F.col("key").cast("string").alias("key"), now.alias("audit_ts"), st.alias("audit_status"),
        (reason if isinstance(reason, Column) else F.lit(reason)).alias("stacktrace"))


def audit_kv(audit: DataFrame) -> DataFrame:
    """Audit rows as topic records: key = correlation id, value = the row as JSON (nulls kept)."""
    cols = [c for c in audit.columns]
    return audit.select(F.col("correlation_id").alias("key"),
                        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def audit_lines(audit: DataFrame) -> DataFrame:
    """Audit rows as JSON lines (the log-file target)."""
    return audit.select(F.to_json(F.struct(*audit.columns), {"ignoreNullFields": "false"}).alias("value"))


# ----------------------------------------------------------------- dead letters
def dead_letter_headers() -> Column:
    """Header map of a dead letter written by the consume path: the dead-letter trace ids
    (field first, then header, both non-empty), the stack trace, then the other record
    headers."""
    own = F.map_filter(F.create_map(
        F.lit("X-Correlation-Id"), dlq_correlation_id(),
        F.lit("X-Traceability-Id"), dlq_traceability_id(),
        F.lit("X-Stack-Trace"), F.col("stacktrace")), lambda k, v: v.isNotNull())
    names = F.array(F.lit("X-Correlation-Id"), F.lit("X-Traceability-Id"), F.lit("X-Stack-Trace"))
    rest = F.map_filter(F.col("headers"), lambda k, v: v.isNotNull() & ~F.array_contains(names, k))
    return F.map_concat(own, rest)


def to_dead_letters(results: DataFrame, ext: str = DLQ_EXT, always: bool = False,
                    now_ms: int | Column | None = None, last_retry: bool = False) -> DataFrame:
    """Outgoing dead-letter records of the failed results, not yet numbered.

    Topic: suffixed unless the name already contains ``ext`` (``always``: suffixed).
    Same partition as the source [decision: the producer's partitioner is not
    reproduced]; record time kept when > 0, else ``now``; ``source_offset`` keeps
    the origin for ordering and joins."""
    f = failed_for_dlq(results, last_retry=last_retry)
    now = now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())
    ts = carry_timestamp(F.unix_millis("timestamp"), now)
    return f.select(
        dlq_topic("topic", ext, always).alias("topic"), "partition_id",
        F.timestamp_millis(ts).alias("timestamp"), "key", "value",
        dead_letter_headers().alias("headers"),
        F.col("topic").alias("origin_topic"), F.col("log_offset").alias("source_offset"),
        *[c for c in ("event_id",) if c in results.columns])


def dead_letter_log(results: DataFrame, existing: DataFrame | None = None, ext: str = DLQ_EXT) -> DataFrame:
    """The dead letters as a log: offsets continue each dead-letter partition (from 0
    when new), in source-offset order."""
    d = to_dead_letters(results, ext)
    base = None
    if existing is not None:
        base = existing.groupBy(*TP).agg((F.max("log_offset") + 1).alias("base"))
    return number_within(d, TP, ["source_offset"], chunk_of("source_offset"), base=base)


def posted_dead_letters(results: DataFrame, now_ms: int | Column, ext: str = DLQ_EXT) -> DataFrame:
    """Dead letters posted directly by a caller: always-suffixed topic, key = result key,
    time = now, headers = ordered (key, value) array with duplicates kept."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    return results.select(
        dlq_topic("topic", ext, always=True).alias("topic"), "partition_id",
        F.col("log_offset").alias("source_offset"),
        F.col("result_key").alias("key"), "value", now.alias("ts_ms"),
        dlq_headers().alias("header_list"))
