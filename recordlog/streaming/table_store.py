"""A table kept from a stream, stored by key hash: change files per micro-batch and a compacted base.

Rows lie in ``buckets`` folders by a hash of their key, in the base and in every micro-batch's changes.  A lookup
names its bucket, so the scan opens that folder of the base and of the changes since, and nothing else.
``compact`` merges base and changes into a new base; a version (put-if-absent) says which base counts and
up to which micro-batch it holds the changes, so readers see the table before or after, with the same
answers.  A micro-batch that runs again replaces its own changes.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.claims import children, claim, delete, exists, read_claim
from .push import latest_per_key

DEFAULT_BUCKETS = 64


def create_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = DEFAULT_BUCKETS) -> None:
    """Lay down an empty table.  ``buckets`` stays for its life: take so many that one bucket's rows fit a task."""
    body = {"schema": schema.json(), "keys": list(keys), "buckets": int(buckets)}
    if not claim(spark, f"{path}/table", body):
        have = read_claim(spark, f"{path}/table")
        if {k: have[k] for k in body} != body:
            raise ValueError(f"{path} holds another table")


def _table(spark: SparkSession, path: str) -> tuple[StructType, list[str], int]:
    have = read_claim(spark, f"{path}/table")
    if have is None:
        raise FileNotFoundError(f"no table in {path}")
    return StructType.fromJson(json.loads(have["schema"])), have["keys"], have["buckets"]


def _bucket(keys: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_changes(changes: DataFrame, path: str, batch_id: int) -> None:
    """The rows that a micro-batch sets, one per key (``foreachBatch`` sink)."""
    schema, keys, buckets = _table(changes.sparkSession, path)
    rows = changes.select(*schema.fieldNames()).withColumn("bucket", _bucket([F.col(k) for k in keys], buckets))
    (rows.repartition("bucket").sortWithinPartitions("bucket", *keys).write.mode("overwrite").partitionBy("bucket")
     .parquet(f"{path}/changes/batch_id={int(batch_id)}"))


def _version(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The greatest version and what it says."""
    last = max((int(n) for n in children(spark, f"{path}/versions") if n.isdigit()), default=-1)
    return last, (read_claim(spark, f"{path}/versions/{last:012d}") if last >= 0 else {"base": None, "upto": -1})


def _rows(spark: SparkSession, path: str, version: dict, schema: StructType) -> tuple[DataFrame, int]:
    """Base and later changes with ``_batch``, and the last batch among them."""
    stored = StructType([*schema.fields, StructField("bucket", LongType())])
    batches = sorted(int(n.split("=")[1]) for n in children(spark, f"{path}/changes"))
    batches = [b for b in batches if b > version["upto"] and exists(spark, f"{path}/changes/batch_id={b}/_SUCCESS")]
    frames = []
    if version["base"]:
        frames.append(spark.read.schema(stored).parquet(f"{path}/base/{version['base']}").withColumn("_batch", F.lit(-1).cast("bigint")))
    if batches:
        with_batch = StructType([*stored.fields, StructField("batch_id", LongType())])
        frames.append(spark.read.schema(with_batch).option("basePath", f"{path}/changes")
                      .parquet(*[f"{path}/changes/batch_id={b}" for b in batches]).withColumnRenamed("batch_id", "_batch"))
    if not frames:
        frames.append(spark.createDataFrame([], StructType([*stored.fields, StructField("_batch", LongType())])))
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return rows, max([version["upto"], *batches])


def _current(rows: DataFrame, keys: list[str], tombstones: bool) -> DataFrame:
    """The last row of each key (null keys are keys); of the rows of a bucket no other is asked."""
    rest = [c for c in rows.columns if c not in keys and c not in ("_batch", "bucket")]
    last = rows.groupBy("bucket", *keys).agg(F.max_by(F.struct(*rest), F.col("_batch")).alias("_m"))
    table = last.select("bucket", *keys, *[F.col("_m")[c].alias(c) for c in rest])
    return table.filter(F.col("value").isNotNull()) if tombstones and "value" in table.columns else table


def read_store(spark: SparkSession, path: str, tombstones: bool = True) -> DataFrame:
    """The whole table; a last null ``value`` deletes its key."""
    schema, keys, _ = _table(spark, path)
    rows, _ = _rows(spark, path, _version(spark, path)[1], schema)
    return _current(rows, keys, tombstones).select(*schema.fieldNames())


def lookup(spark: SparkSession, path: str, wanted: Sequence[tuple], tombstones: bool = True) -> DataFrame:
    """The rows of the ``wanted`` keys (tuples in the order of the table's keys); only their buckets are read."""
    schema, keys, buckets = _table(spark, path)
    rows, _ = _rows(spark, path, _version(spark, path)[1], schema)
    types = {f.name: f.dataType for f in schema.fields}
    found = F.lit(False)
    places = []
    for key in dict.fromkeys(wanted):
        literals = [F.lit(v).cast(types[k]) for k, v in zip(keys, key, strict=True)]
        places.append(_bucket(literals, buckets))
        same = F.lit(True)
        for k, v in zip(keys, literals):
            same = same & F.col(k).eqNullSafe(v)
        found = found | same
    rows = rows.filter(F.col("bucket").isin(places) & found) if places else rows.limit(0)
    return _current(rows, keys, tombstones).select(*schema.fieldNames())


def compact(spark: SparkSession, path: str) -> bool:
    """Merge the changes into a new base; False if there is nothing to merge or another compaction was first."""
    schema, keys, _ = _table(spark, path)
    last, version = _version(spark, path)
    rows, upto = _rows(spark, path, version, schema)
    if upto == version["upto"]:
        return False
    base = uuid.uuid4().hex
    # one shuffle: by bucket, which also serves the grouping by bucket and key
    merged = _current(rows.repartition("bucket"), keys, True).sortWithinPartitions("bucket", *keys)
    merged.write.partitionBy("bucket").parquet(f"{path}/base/{base}")
    if claim(spark, f"{path}/versions/{last + 1:012d}", {"base": base, "upto": upto}):
        return True
    delete(spark, f"{path}/base/{base}")
    return False


def drop_merged(spark: SparkSession, path: str) -> None:
    """Delete the changes and bases that the current version no longer needs, once no reader of an older one is left."""
    _, version = _version(spark, path)
    for name in children(spark, f"{path}/changes"):
        if int(name.split("=")[1]) <= version["upto"]:
            delete(spark, f"{path}/changes/{name}")
    for name in children(spark, f"{path}/base"):
        if version["base"] and name != version["base"]:
            delete(spark, f"{path}/base/{name}")


def keep_table(stream_log: DataFrame, key_cols: Sequence[str], path: str, checkpoint: str,
               order=("timestamp", "partition_id", "log_offset"), buckets: int = DEFAULT_BUCKETS, trigger: dict | None = None):
    """Keep the latest record per key of a stream in the table at ``path``: the state store holds the latest row of
    each key, and a micro-batch writes the keys it changes."""
    table = latest_per_key(stream_log, key_cols, order)
    spark = stream_log.sparkSession
    create_table(spark, path, table.schema, key_cols, buckets)
    return (table.writeStream.outputMode("update").foreachBatch(lambda df, bid: write_changes(df, path, bid))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
