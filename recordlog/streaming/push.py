"""Push queries (continuous results over a stream), reading a stream's state, and the
registry of pluggable stream applications."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_APPS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_app(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Register a stream application: a DataFrame -> DataFrame transformation."""
    _APPS[name] = fn


def apps() -> dict[str, Callable[[DataFrame], DataFrame]]:
    return dict(_APPS)


def run_app(name: str, df: DataFrame) -> DataFrame:
    return df.transform(_APPS[name])


def push_query(stream_df: DataFrame, transform: Callable[[DataFrame], DataFrame] | str | None, path: str, checkpoint: str,
               output_mode: str = "append", trigger: dict | None = None, fmt: str = "parquet"):
    """Continuous query on changes written to ``path``.  ``transform`` is a DataFrame function or
    a SQL text that names the stream as ``{changes}``.  Where to start is the source's own option (e.g.
    Kafka's ``startingOffsets``); ``availableNow`` (default) ends the query once the input is
    drained, giving a finite result."""
    if isinstance(transform, str):
        text = transform

        def transform(df: DataFrame) -> DataFrame:
            return df.sparkSession.sql(text, changes=df)
    out = transform(stream_df) if transform else stream_df
    w = out.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if output_mode in ("update", "complete") and fmt != "memory":
        # file sinks only append: write each micro-batch's changes keyed by batch id
        from .sinks import write_batch

        def changes(df, bid):
            write_batch(df, path, bid, fmt)
        w = w.foreachBatch(changes)
    else:
        w = w.format(fmt).option("path", path)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def query_state(spark: SparkSession, checkpoint: str, operator_id: int = 0, store_name: str | None = None) -> DataFrame:
    """Rows of a stateful stream's state store (``statestore`` reader on its checkpoint)."""
    r = spark.read.format("statestore").option("operatorId", operator_id)
    if store_name:
        r = r.option("storeName", store_name)
    return r.load(checkpoint)


def latest_per_key(log: DataFrame, key_cols, order=("timestamp", "partition_id", "log_offset")) -> DataFrame:
    """The greatest row per key by ``order``, tombstones kept; on a stream the state holds one row per key."""
    from pyspark.sql import functions as F
    keys = list(key_cols)
    order = [c for c in order if c in log.columns]
    rest = [c for c in log.columns if c not in keys and c not in order]
    m = F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("_m")
    return log.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in (*order, *rest)])


def materialize_latest_stream(stream_log: DataFrame, key_cols, path: str, checkpoint: str,
                              order=("timestamp", "partition_id", "log_offset"), trigger: dict | None = None):
    """Table from a stream: the state store keeps the latest row per key (``max_by`` in
    update mode, one state row per key); each micro-batch appends the keys it changed to
    a changelog under ``path`` (partitioned by batch id, idempotent on re-run).  Read the
    table with ``read_table``."""
    from .sinks import write_batch
    agg = latest_per_key(stream_log, key_cols, order)

    def changes(df, bid):
        write_batch(df, path, bid)
    return (agg.writeStream.outputMode("update").foreachBatch(changes)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_table(spark: SparkSession, path: str, key_cols, tombstones: bool = True) -> DataFrame:
    """The materialised table: per key the row of the latest change (highest batch id);
    with ``tombstones`` a latest null value deletes the key."""
    from pyspark.sql import functions as F
    log = spark.read.parquet(path)
    keys = list(key_cols)
    rest = [c for c in log.columns if c not in keys and c != "batch_id"]
    t = (log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_m"))
         .select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest]))
    if tombstones and "value" in t.columns:
        t = t.filter(F.col("value").isNotNull())
    return t
