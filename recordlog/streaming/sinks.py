"""Sinks used inside ``foreachBatch``.  One sink alone: the write is keyed by the micro-batch id and
overwrites exactly that id's folder, so a re-run batch replaces its own output, also
when it has none this time.  Several sinks that belong together: see ``manifest``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.results import audit_kv, audit_lines


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Idempotent write of one micro-batch's rows to ``path/batch_id=<id>``; no rows clear what
    an earlier attempt left there.  Readers of ``path`` see ``batch_id`` as a partition column."""
    df.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={int(batch_id)}")


def store_results(results: DataFrame, out_dir: str, batch_id: int) -> DataFrame:
    """The function's results of one micro-batch, written under its id and read back: what is decided and written from
    them afterwards does not call the function again, whatever executors are lost."""
    path = f"{out_dir}/_results/{int(batch_id)}"
    results.write.mode("overwrite").parquet(path)
    return results.sparkSession.read.schema(results.schema).parquet(path)


def drop_results(spark: SparkSession, out_dir: str, batch_id: int) -> None:
    """Delete the stored results of a micro-batch that has ended."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/_results/{int(batch_id)}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_dead_letters(dead_letters: DataFrame, path: str, batch_id: int) -> None:
    """Dead-letter records of one batch (a file table; a Kafka sink would take
    ``to_outgoing`` of the same rows)."""
    write_batch(dead_letters, path, batch_id)


def write_audit(audit: DataFrame, path: str, batch_id: int, target: str = "topic") -> None:
    """Audit rows of one batch: ``topic`` -> (key = correlation id, value = JSON) records;
    ``logfile`` -> JSON lines."""
    rows, fmt = audit_rows(audit, target)
    write_batch(rows, path, batch_id, fmt)


def audit_rows(audit: DataFrame, target: str = "topic") -> tuple[DataFrame, str]:
    """What an audit sink stores for ``target``, and its format."""
    return (audit_kv(audit), "parquet") if target == "topic" else (audit_lines(audit), "text")


class RowSubscriber:
    """``foreach`` writer pushing each row to a callback (one call per row), with
    per-partition open/close -- e.g. a connection opened once per task."""

    def __init__(self, on_row, on_open=None, on_close=None):
        self.on_row, self.on_open, self.on_close = on_row, on_open, on_close

    def open(self, partition_id, epoch_id):
        if self.on_open:
            return bool(self.on_open(partition_id, epoch_id))
        return True

    def process(self, row):
        self.on_row(row)

    def close(self, error):
        if self.on_close:
            self.on_close(error)


def push_rows(stream_df: DataFrame, subscriber: RowSubscriber, checkpoint: str, trigger: dict | None = None):
    """Push every output row of a stream to ``subscriber`` (``writeStream.foreach``)."""
    w = stream_df.writeStream.foreach(subscriber).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
