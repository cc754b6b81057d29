"""Header and trace-id functions on log / result DataFrames."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (AUTHORIZATION_HEADER, CALLER_ID_HEADER, CORRELATION_HEADER, STACK_TRACE_HEADER,
                      TRACEABILITY_HEADER)
from .names import nonempty


def header(name: str, headers: str = "headers") -> Column:
    """Value of one header (null when the map or the entry is missing)."""
    return F.col(headers).getItem(name)


def audit_correlation_id(field: str = "correlation_id", headers: str = "headers") -> Column:
    """Audit rule: the header wins when it is not null, else the result field."""
    return F.coalesce(header(CORRELATION_HEADER, headers), F.col(field))


def audit_traceability_id(field: str = "traceability_id", headers: str = "headers") -> Column:
    return F.coalesce(header(TRACEABILITY_HEADER, headers), F.col(field))


def dlq_correlation_id(field: str = "correlation_id", headers: str = "headers") -> Column:
    """Dead-letter rule: the result field wins when non-empty, else the header when non-empty."""
    return F.coalesce(nonempty(F.col(field)), nonempty(header(CORRELATION_HEADER, headers)))


def dlq_traceability_id(field: str = "traceability_id", headers: str = "headers") -> Column:
    return F.coalesce(nonempty(F.col(field)), nonempty(header(TRACEABILITY_HEADER, headers)))


_KV = "array<struct<key:string,value:string>>"


def dlq_headers(correlation: str = "correlation_id", traceability: str = "traceability_id",
                stacktrace: str = "stacktrace", headers: str = "headers") -> Column:
    """Headers of a dead letter as an ordered array of (key, value): correlation id,
    traceability id and stack trace when not null, then every record header with a
    non-null value.  An array, because the same key may legally appear twice."""
    own = F.filter(F.array(
        F.struct(F.lit(CORRELATION_HEADER).alias("key"), F.col(correlation).alias("value")),
        F.struct(F.lit(TRACEABILITY_HEADER).alias("key"), F.col(traceability).alias("value")),
        F.struct(F.lit(STACK_TRACE_HEADER).alias("key"), F.col(stacktrace).alias("value")),
    ), lambda h: h["value"].isNotNull())
    rec = F.filter(F.coalesce(F.map_entries(F.col(headers)), F.array().cast(_KV)),
                   lambda h: h["value"].isNotNull())
    return F.concat(own.cast(_KV), rec.cast(_KV))


def replay_headers(headers: str = "headers") -> Column:
    """Only the two trace ids survive a replay to another topic, and only when non-empty."""
    keep = F.array(F.lit(CORRELATION_HEADER), F.lit(TRACEABILITY_HEADER))
    return F.map_filter(F.col(headers), lambda k, v: F.array_contains(keep, k) & (v != F.lit("")))


def carry_timestamp(ts_ms: str | Column, now_ms: int | Column) -> Column:
    """Keep the record time when it is > 0, else ``now``."""
    c = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    return F.when(c > 0, c).otherwise(now)


def inject_headers(headers: str | Column = "headers", authorization: str | Column | None = None,
                   caller_id: str | None = None) -> Column:
    """Add ``Authorization`` when given and the caller id when given (an enabled setting);
    an added header replaces one of the same name."""
    h = F.col(headers) if isinstance(headers, str) else headers
    add = []
    if authorization is not None:
        add.append((AUTHORIZATION_HEADER, authorization if isinstance(authorization, Column) else F.lit(authorization)))
    if caller_id is not None:
        add.append((CALLER_ID_HEADER, F.lit(caller_id)))
    if not add:
        return h
    names = F.array(*[F.lit(k) for k, _ in add])
    new = F.map_filter(F.create_map(*[x for k, v in add for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    base = F.coalesce(h, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(names, k)), new)
