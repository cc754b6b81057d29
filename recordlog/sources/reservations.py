"""Appends by several producers at once: offsets are reserved before records are written.

``reserve`` takes the next offsets of every topic-partition of a request in one step: the versions of a
reservation log are claims (put-if-absent), each naming a request and its ranges, and a request that
loses a version reads the winner's ranges and claims the next.  So ranges never overlap, leave no
gap between them, and a request is reserved as a whole.  A request that comes again gets the ranges it
has; ``append_reserved`` then stores its records once, and acknowledges each record with its offset
or its error.  Every 64th version is folded into a table, so a reservation reads one table and
at most some 64 claims.
"""
from __future__ import annotations

import hashlib
import random
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import OFFSET_CHUNK
from ..operators.numbering import chunk_of, number_within
from ..operators.select import record_bytes
from .claims import BODY, children, claim, delete, exists, read_claim
from .segments import TP, index_bounds, index_rows, read_index, write_data, write_index

FOLD_EVERY = 64
_RANGE = "topic string, partition_id int, base bigint, n bigint"
_CLAIM_DDL = f"version bigint, request_id string, ranges array<struct<{_RANGE}>>"
_ROW_DDL = f"version bigint, request_id string, {_RANGE}"


class ReservationError(RuntimeError):
    """A request could not be reserved, or its records are not those it was reserved for."""


def _log(spark: SparkSession, path: str) -> tuple[int, int, DataFrame]:
    """(last version, last folded version, rows of all reservations); -1 where there is none."""
    root = f"{path}/reservations"
    names = children(spark, root)
    versions = [int(n) for n in names if n.isdigit()]
    folds = [int(n[6:]) for n in names if n.startswith("_fold-") and exists(spark, f"{root}/{n}/_SUCCESS")]
    folded = max(folds, default=-1)
    fresh = [f"{root}/{v:020d}/{BODY}" for v in versions if v > folded]
    rows = spark.read.schema(_ROW_DDL).parquet(f"{root}/_fold-{folded}") if folds else spark.createDataFrame([], _ROW_DDL)
    if fresh:
        # a request without records has one row without a topic: it is known, too
        more = spark.read.schema(_CLAIM_DDL).json(fresh).select("version", "request_id", F.inline_outer("ranges"))
        rows = rows.unionByName(more)
    return max(versions, default=-1), folded, rows


def reservations(spark: SparkSession, path: str) -> DataFrame:
    """All reservations of the log at ``path``: version, request_id, topic, partition_id, base, n."""
    return _log(spark, path)[2].filter(F.col("topic").isNotNull())


def reserve(spark: SparkSession, path: str, request_id: str, counts: DataFrame, attempts: int = 100) -> DataFrame:
    """The offsets of a request: topic, partition_id, base, n for its ``counts`` (topic, partition_id, n).  One row
    per topic-partition of the request passes through the driver.  The same request with other counts is
    an error; so is a request that loses ``attempts`` times."""
    wanted = {(r["topic"], r["partition_id"]): r["n"] for r in counts.select(*TP, "n").collect()}
    ddl = _RANGE
    bounds = index_bounds(read_index(spark, path)).select(*TP, F.col("next_offset").alias("end"))
    asked = spark.createDataFrame(list(wanted), "topic string, partition_id int")
    for attempt in range(attempts):
        last, folded, rows = _log(spark, path)
        known = rows.filter(F.col("request_id") == request_id).select(*TP, "base", "n").collect()
        if known:
            ranges = [tuple(r) for r in known if r["topic"] is not None]
            if {(t, p): n for t, p, _, n in ranges} != wanted:
                raise ReservationError(f"request {request_id} was reserved for other records")
            return spark.createDataFrame(ranges, ddl)
        taken = rows.filter(F.col("topic").isNotNull()).select(*TP, (F.col("base") + F.col("n")).alias("end"))
        ends = {(r["topic"], r["partition_id"]): r["end"] for r in
                taken.unionByName(bounds).join(asked, TP, "left_semi").groupBy(*TP).agg(F.max("end").alias("end")).collect()}
        ranges = [(t, p, ends.get((t, p), 0), n) for (t, p), n in sorted(wanted.items())]
        body = {"version": last + 1, "request_id": request_id,
                "ranges": [dict(zip(("topic", "partition_id", "base", "n"), r)) for r in ranges]}
        if claim(spark, f"{path}/reservations/{last + 1:020d}", body):
            if last + 1 - folded >= FOLD_EVERY:
                _fold(spark, path)
            return spark.createDataFrame(ranges, ddl)
        time.sleep(random.uniform(0, 0.05 * min(attempt + 1, 20)))
    raise ReservationError(f"request {request_id} lost {attempts} times")


def _fold(spark: SparkSession, path: str) -> None:
    """One table of all reservations up to the last version; of two that fold at once one fails, which is no harm."""
    last, _, rows = _log(spark, path)
    draft = f"{path}/reservations/_draft-fold-{uuid.uuid4().hex}"
    rows.coalesce(1 + last // 100_000).write.parquet(draft)
    target = f"{path}/reservations/_fold-{last}"
    if not exists(spark, target):
        at = spark._jvm.org.apache.hadoop.fs.Path
        at(draft).getFileSystem(spark._jsc.hadoopConfiguration()).rename(at(draft), at(target))
    delete(spark, draft)
    delete(spark, f"{target}/{draft.rsplit('/', 1)[-1]}")  # a lost race moves the draft into the winner's folder


def record_error(max_record_bytes: int | None = None) -> Column:
    """Why a record is not appended, null if it is."""
    error = F.when(F.coalesce(F.col("topic"), F.lit("")) == "", F.lit("topic name can not be empty")) \
        .when(F.col("partition_id").isNull(), F.lit("partition can not be empty")) \
        .when(F.col("partition_id") < 0, F.lit("partition can not be negative"))
    if max_record_bytes is not None:
        error = error.when(record_bytes() > max_record_bytes, F.lit(f"record is larger than {max_record_bytes} bytes"))
    return error


def append_reserved(df: DataFrame, path: str, request_id: str, seq: str = "seq", chunk: Column | None = None,
                    segment_rows: int = OFFSET_CHUNK, max_record_bytes: int | None = None) -> DataFrame:
    """Append the records of a request (topic, partition_id, timestamp, key, value, headers, ``seq``) to the segmented log.

    Returns the acknowledgement: ``seq``, topic, partition_id, log_offset, error -- an offset for each stored
    record, an error for each one that is refused; refusing one does not touch the others.  Records of a
    topic-partition are in the order of ``seq``.  A request that is repeated, also after a failure at any point, gets
    its first offsets and is stored once.  ``df`` must give the same rows each time it is read: what was
    stored is compared with what was reserved, and an append that differs raises and stays unseen."""
    spark = df.sparkSession
    checked = df.drop("log_offset") if "log_offset" in df.columns else df
    checked = checked.withColumn("_error", record_error(max_record_bytes))
    rows = checked.filter(F.col("_error").isNull()).drop("_error")
    done_at = f"{path}/appends/{hashlib.sha256(request_id.encode()).hexdigest()}"
    done = read_claim(spark, done_at)
    if done is None:
        ranges = reserve(spark, path, request_id, rows.groupBy(*TP).agg(F.count(F.lit(1)).alias("n")))
        numbered = number_within(rows, TP, [seq], chunk if chunk is not None else chunk_of(seq), base=ranges)
        write_id = uuid.uuid4().hex
        schema = write_data(numbered, path, write_id, segment_rows)
        if not _as_reserved(index_rows(spark, path, write_id, schema), ranges):
            delete(spark, f"{path}/data/write_id={write_id}")
            raise ReservationError(f"request {request_id}: the records changed between their count and their writing")
        if not claim(spark, done_at, {"request_id": request_id, "write_id": write_id, "schema": schema.json()}):
            delete(spark, f"{path}/data/write_id={write_id}")  # the same request, stored by another caller
        done = read_claim(spark, done_at)
    import json
    write_id, schema = done["write_id"], StructType.fromJson(json.loads(done["schema"]))
    if not exists(spark, f"{path}/index/{write_id}/_SUCCESS"):
        write_index(spark, path, write_id, schema)
    stored = spark.read.schema(schema).parquet(f"{path}/data/write_id={write_id}")
    refused = checked.filter(F.col("_error").isNotNull())
    return (stored.select(seq, *TP, "log_offset", F.lit(None).cast("string").alias("error"))
            .unionByName(refused.select(seq, *TP, F.lit(None).cast("bigint").alias("log_offset"), F.col("_error").alias("error"))))


def _as_reserved(index: DataFrame, ranges: DataFrame) -> bool:
    got = index.groupBy(*TP).agg(F.min("first_offset").alias("base"), F.sum("n_records").alias("n"), F.max("last_offset").alias("last"))
    want = ranges.select(*TP, "base", "n", (F.col("base") + F.col("n") - 1).alias("last"))
    cols = [*TP, "base", "n", "last"]
    return sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
