"""Tables kept from a log: latest value per key, grouped and time-windowed tables,
joins feeding them, and pull queries on them."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numbering import floor_div, number_within

TP = ["topic", "partition_id"]
LATEST_ORDER = ("timestamp", "partition_id", "log_offset")
WORD_PATTERN = r"[\p{L}\p{N}]+"


def materialize_latest(df: DataFrame, key_cols: Sequence[str] = ("key",), order: Sequence[str] = LATEST_ORDER,
                       tombstones: bool = True) -> DataFrame:
    """Table from a stream: the latest row per key by (timestamp, partition_id, log_offset).

    ``max_by`` aggregates partially, so a hot key costs one row per map task
    before the shuffle.
    With ``tombstones`` a latest row whose value is null deletes the key."""
    keys = list(key_cols)
    rest = [c for c in df.columns if c not in keys and c not in order]
    m = F.max_by(F.struct(*[F.col(c) for c in (*order, *rest)]), F.struct(*[F.col(c) for c in order])).alias("_m")
    t = df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in (*order, *rest)])
    if tombstones and "value" in t.columns:
        t = t.filter(F.col("value").isNotNull())
    return t


def pull_query(table: DataFrame, key=None, key_col: str = "key", where: str | Column | None = None,
               table_scan: bool = False) -> DataFrame:
    """Pull query on a materialised table: a key lookup, or -- only when ``table_scan`` is
    allowed -- a scan with an optional predicate."""
    if key is None and not table_scan:
        raise ValueError("pull query without a key needs table_scan=True")
    t = table
    if key is not None:
        keys = list(key) if isinstance(key, (list, tuple, set)) else [key]
        t = t.filter(F.col(key_col).isin(keys))
    if where is not None:
        t = t.filter(F.expr(where) if isinstance(where, str) else where)
    return t


def sql_query(spark: SparkSession, sql: str) -> DataFrame:
    """Pass-through SQL over registered tables (the stream-SQL endpoint)."""
    return spark.sql(sql)


def materialize_agg(df: DataFrame, keys: Sequence[str | Column], aggs: Mapping[str, Column]) -> DataFrame:
    """GROUP BY table: ``aggs`` maps output names to aggregate expressions."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def word_count(df: DataFrame, col: str = "text", pattern: str = WORD_PATTERN) -> DataFrame:
    """Lower-cased words (maximal runs matching ``pattern``) of whole texts and their counts.

    On a stream the counts are the state: run it with output mode ``update`` or ``complete``."""
    from .parallel import spread
    texts = df.select(col)
    words = (texts if df.isStreaming else spread(texts)).select(
        F.explode(F.regexp_extract_all(F.lower(F.col(col)), F.lit(pattern), 0)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def materialize_window(df: DataFrame, kind: str, size: str, keys: Sequence[str | Column],
                       aggs: Mapping[str, Column], slide: str | None = None, ts_col: str = "timestamp",
                       watermark: str | None = None) -> DataFrame:
    """Time-windowed table: ``tumbling`` (size), ``hopping`` (size, slide) or ``session``
    (size = gap).  Output carries ``window_start`` / ``window_end`` as timestamps.
    Batch session tables use the chunked ``sessionize`` (hot keys stay parallel);
    streams use Spark's ``session_window`` with its state store."""
    if kind == "session" and not df.isStreaming and all(isinstance(k, str) for k in keys):
        from .sessions import sessionize
        return sessionize(df, keys, ts_col, size, aggs)
    d = df.withWatermark(ts_col, watermark) if watermark else df
    if kind == "tumbling":
        w = F.window(ts_col, size)
    elif kind == "hopping":
        w = F.window(ts_col, size, slide)
    elif kind == "session":
        w = F.session_window(ts_col, size)
    else:
        raise ValueError(f"unknown window kind {kind!r}")
    g = d.groupBy(w.alias("_w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    names = [k if isinstance(k, str) else k._jc.toString() for k in keys]
    return g.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    *names, *aggs.keys())


def materialize_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join feeding a materialised table (stream-static joins go through ``foreachBatch``)."""
    return left.join(right, on, how)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("log_offset",)) -> DataFrame:
    """Keep the first row (by ``order``) of every duplicate group -- deterministic, and
    partially aggregated like ``materialize_latest``."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    m = F.min_by(F.struct(*[F.col(c) for c in (*order, *rest)]), F.struct(*[F.col(c) for c in order])).alias("_m")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in (*order, *rest)])


def dedupe_stream(df: DataFrame, keys: Sequence[str], ts_col: str | None = None, within: str | None = None) -> DataFrame:
    """Streaming duplicates dropped.

    Without ``within`` every repeat is dropped, in however many micro-batches the rows come;
    the state keeps each distinct key (use a disk-backed state store).  With ``within`` the
    state is bounded: a repeat is dropped while the first copy is inside the watermark delay,
    and a key that comes again after it counts as new, so the rows then depend on how far the
    watermark had moved."""
    if within is None:
        return df.dropDuplicates(list(keys))
    return df.withWatermark(ts_col, within).dropDuplicatesWithinWatermark(list(keys))


def rekey(df: DataFrame, key: Column, n: int, topic: str | Column | None = None, partitioner=None,
          chunk_us: int = 60_000_000) -> DataFrame:
    """Re-key a log (PARTITION BY): new key, partition ``partitioner(key, n)`` (default
    ``pmod(hash(key), n)``) and dense new offsets in (timestamp, source partition, source
    offset) order.  Numbering is chunked by ``chunk_us`` of record time."""
    part = partitioner(key, n) if partitioner else F.pmod(F.hash(key), F.lit(n))
    t = F.col("topic") if topic is None else (topic if isinstance(topic, Column) else F.lit(topic))
    d = df.select(t.alias("topic"), part.cast("int").alias("partition_id"), "timestamp",
                  key.cast("string").alias("key"), "value", "headers",
                  F.col("topic").alias("source_topic"), F.col("partition_id").alias("source_partition"),
                  F.col("log_offset").alias("source_offset"))
    chunk = floor_div(F.unix_micros("timestamp"), chunk_us)
    return number_within(d, TP, ["timestamp", "source_topic", "source_partition", "source_offset"], chunk)
